"""N-gram Jaccard join by T-occurrence search.

Two documents link when their sets of five-word shingles have a Jaccard similarity of 0.8 or more.
A set of n shingles must share one of its first n - ceil(0.8 n) + 1 shingles, in any fixed order,
with each partner, so only those are indexed. The order is rare first: a sketch of fixed size
counts all shingles of the corpus, and shingles it finds common come last. Candidates are checked
by a T-occurrence search (DivideSkip): inverted lists over the candidates of a query, short lists
merged with a heap, long ones probed by binary search, and documents kept that reach the overlap.

Documents with equal sets are one node. Every node is first checked against the earliest node it
shares enough index shingles with; components of these links collapse groups of copies. Then all
pairs across components that pass the bounds on sizes, positions and shared index shingles are
checked too, so no link between components is lost while no group is expanded into its pairs.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.llm.common import delete, frame, freed_shuffles, in_small_batches, kept, restored_batches
from stopwise.llm.components import components
from stopwise.storage import fresh_dir, save

WORDS = 5
#: Similarity as a whole percentage: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Cells of the sketch that orders shingles. It only orders: any size gives the same links. Larger
#: corpora want more cells, so that a common shingle stands out against the cells' mean.
SKETCH_BITS = 22
CHUNKS = 256
#: Candidates that meet their query in one group; a query with more is copied to several groups.
GROUP = 256
#: Bits of the filter that picks the texts whose sets are needed; one long in memory for 64.
FILTER_BITS = 24
#: Shingles a task hands on at once.
HELD = 1 << 20
#: Weight of the binary probes against the merge when lists are divided into long and short.
MU = 0.01

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; under five words the whole is one."""
    found = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not found:
        return np.zeros(0, np.uint64)
    joined, hashed = b" ".join(found), xxhash.xxh3_64_intdigest
    if len(found) <= WORDS:
        return np.array([hashed(joined)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate([[0], ends[:-1]])[: len(found) - WORDS + 1].tolist()
    ends = (ends - 1)[WORDS - 1 :].tolist()
    return np.unique(np.array([hashed(joined[s:e]) for s, e in zip(starts, ends)], np.uint64))


def needed(a, b):
    """Least intersection of two sets of these sizes that link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def _node(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).astype(np.int64))


def _cells(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


_SURVEY = "doc_id string, mark long, node long, n int, tokens array<long>, chunk int, counts binary"


def _survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per document its node and size, and the set where it is new to the task; at the end, the
    task's counts of shingles by cell."""
    names, whole = [part.split()[0] for part in _SURVEY.split(", ")], ("mark", "node", "n", "chunk")
    total = np.zeros(1 << SKETCH_BITS, np.uint32)
    seen: set[int] = set()
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        for doc_id, mark, text in zip(batch["doc_id"], batch["mark"], batch["text"]):
            own = shingles(text)
            node = _node(own) if len(own) else None
            tokens = None
            if node is not None and node not in seen:
                seen.add(node)
                np.add.at(total, _cells(own), 1)
                tokens = own.view(np.int64)
                held += len(own)
            rows.append((doc_id, mark, node, len(own), tokens, None, None))
            if held >= HELD:
                yield frame(rows, names, whole)
                rows, held = [], 0
        yield frame(rows, names, whole)
    width = (1 << SKETCH_BITS) // CHUNKS
    rows = []
    for k in range(CHUNKS):
        part = np.minimum(total[k * width : (k + 1) * width], 255).astype(np.uint8)
        full = np.flatnonzero(part)
        if len(full):
            sparse = full.astype("<u2").tobytes() + part[full].tobytes()
            rows.append((None, None, None, 0, None, k, sparse if len(sparse) < width else part.tobytes()))
    if rows:
        yield frame(rows, names, whole)


def _sum_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    width = (1 << SKETCH_BITS) // CHUNKS
    sums: dict[int, np.ndarray] = {}  # at most CHUNKS
    for batch in batches:
        for k, raw in zip(batch["chunk"], batch["counts"]):
            own = sums.setdefault(k, np.zeros(width, np.uint32))
            if len(raw) == width:
                own += np.frombuffer(raw, np.uint8)
            else:
                n = len(raw) // 3
                own[np.frombuffer(raw, "<u2", n)] += np.frombuffer(raw, np.uint8, offset=2 * n)
    yield pd.DataFrame([(k, v.tobytes()) for k, v in sums.items()], columns=["chunk", "counts"])


def _grades(survey: DataFrame) -> np.ndarray:
    """Per cell 0 (not above what chance puts into a cell) or the logarithm of the excess."""
    chunks = survey.filter(F.col("chunk").isNotNull()).select("chunk", "counts").repartition("chunk")
    width = (1 << SKETCH_BITS) // CHUNKS
    total = np.zeros(1 << SKETCH_BITS, np.float32)
    for row in chunks.mapInPandas(_sum_chunks, "chunk int, counts binary").toLocalIterator():  # the sketch: fixed size
        total[row["chunk"] * width : (row["chunk"] + 1) * width] = np.frombuffer(row["counts"], np.uint32)
    mean = float(np.median(total))
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for k in range(0, len(out), width):
        excess = total[k : k + width] - np.float32(mean + 4 * np.sqrt(mean) + 2)
        out[k : k + width] = np.where(excess > 0, 1 + np.log2(np.maximum(excess, 1)), 0)
    return out


def _index(sets: DataFrame, grades: np.ndarray) -> DataFrame:
    """(node, n, token, pos) of every node's indexed shingles, rare first; copies may repeat."""
    shared = sets.sparkSession.sparkContext.broadcast(grades)  # one byte a cell

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grade = shared.value
        for batch in batches:
            rows = []
            for tokens in batch["tokens"]:
                own = np.asarray(tokens, np.int64).view(np.uint64)
                size = len(own)
                first = size - -(-PERCENT * size // 100) + 1
                order = np.argsort(grade[_cells(own)], kind="stable")[:first]
                rows.append(own[order].view(np.int64))
            yield pd.DataFrame({"node": batch["node"], "n": batch["n"], "tokens": rows})

    found = sets.mapInPandas(prefixes, "node long, n int, tokens array<long>")
    return found.select("node", "n", F.posexplode("tokens").alias("pos", "token"))


def occurrences(query: np.ndarray, candidates: list[np.ndarray]) -> list[int]:
    """Which candidates reach the overlap they need with the query (DivideSkip)."""
    need = [int(needed(len(query), len(c))) for c in candidates]
    least = min(need)
    flat = np.concatenate(candidates)
    of = np.repeat(np.arange(len(candidates)), [len(c) for c in candidates])
    at = np.searchsorted(query, flat)
    hit = query[np.minimum(at, len(query) - 1)] == flat
    at, of = at[hit], of[hit]
    order = np.lexsort((of, at))
    at, of = at[order], of[order]
    cuts = np.flatnonzero(np.diff(at)) + 1
    lists = sorted((part.tolist() for part in np.split(of, cuts) if len(part)), key=len)
    if len(lists) < least:
        return []
    longest = len(lists[-1])
    n_long = min(least - 1, int(least / (MU * np.log2(longest + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    found, counted = [], 0
    merged = heapq.merge(*short)
    current = next(merged, None)
    while current is not None:
        nxt = next(merged, None)
        counted += 1
        if nxt != current:
            if counted >= need[current] - n_long:
                left = n_long
                for own in long:
                    if counted >= need[current] or counted + left < need[current]:
                        break
                    left -= 1
                    i = bisect_left(own, current)
                    counted += i < len(own) and own[i] == current
                if counted >= need[current]:
                    found.append(current)
            current, counted = nxt, 0
    return found


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of sorted rows (query, salt, node, tokens): each group starts with the query itself."""
    key, query, nodes, sets = None, None, [], []

    def links() -> pd.DataFrame:
        got = occurrences(query, sets) if query is not None and sets else []
        return pd.DataFrame({"a": [key[0]] * len(got), "b": [nodes[i] for i in got]}, dtype="int64")

    for batch in batches:
        out = []
        for q, salt, node, tokens in zip(batch["query"], batch["salt"], batch["node"], batch["tokens"]):
            if (q, salt) != key:
                if key is not None:
                    out.append(links())
                key, query, nodes, sets = (q, salt), None, [], []
            own = np.asarray(tokens, np.int64).view(np.uint64)
            if node == q:
                query = own
            else:
                nodes.append(node)
                sets.append(own)
        if out:
            yield pd.concat(out)
    if key is not None:
        yield links()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among distinct pairs (query, node), by the sets of both."""
    counts = pairs.groupBy("query").agg(F.count("*").alias("c"))
    salted = kept(
        pairs.join(counts, "query").select(
            "query", "node",
            F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / GROUP)).cast("int").alias("salt"),
        )
    )
    asked = salted.select("query", "salt", F.col("query").alias("node")).distinct()
    rows = salted.select("query", "salt", "node").unionByName(asked).join(sets, "node")
    rows = rows.repartition("query", "salt").sortWithinPartitions("query", "salt")
    return rows.select("query", "salt", "node", "tokens").mapInPandas(_search, "a long, b long")


def _sets_of(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, tokens) of the wanted (node) and perhaps of a few more nodes, each once or more.

    The wanted nodes become a bit set of fixed size, which the scan of the stored sets is filtered
    by, so that sets are not shuffled for nothing. More nodes than fit only let more sets pass.
    """
    bit = F.pmod("node", F.lit(1 << FILTER_BITS))
    mask = F.expr("shiftleft(1L, cast(pmod(node, 64) as int))")
    words = (
        wanted.select((bit / 64).cast("int").alias("word"), mask.alias("mask"))
        .groupBy("word").agg(F.bit_or("mask").alias("mask"))
    )
    at = sets.select("node", "tokens").withColumn("word", (bit / 64).cast("int"))
    passed = at.join(F.broadcast(words), "word")  # at most 2^FILTER_BITS / 64 rows
    return passed.filter(F.expr("mask & shiftleft(1L, cast(pmod(node, 64) as int)) <> 0")).select("node", "tokens")


def _compatible(a: str, b: str):
    """Sizes that allow a similarity of 0.8."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _least_shared(a: str, b: str):
    """Index shingles two linked sets of these sizes have in common at least.

    Of the set whose index ends first in the order, all common shingles up to there are in both
    indexes, and only what follows its index can be common besides.
    """
    need = F.ceil(PERCENT * (F.col(a) + F.col(b)) / (100 + PERCENT))
    rest = F.ceil(PERCENT * F.greatest(a, b) / 100) - 1
    return F.greatest(F.lit(1), need - rest)


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    component_id is the least doc_id reachable by links, itself included. Null and empty texts have
    no shingles and link with nothing; rows that repeat an id are rows of their own, linked as
    their texts say; a null id never is the least unless all are null. No rows in, none out.
    """
    return _grouped(docs).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame) -> DataFrame:
    """``classes`` with the checksum of each row's text and the node its group is named by, null without shingles."""
    with freed_shuffles(docs.sparkSession), restored_batches(docs.sparkSession):
        in_small_batches(docs.sparkSession)  # all work in Python is stored before this returns
        return _linked(docs)


def _linked(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    root = fresh_dir(spark, "jaccard")
    kind = docs.schema["doc_id"].dataType
    # Ids pass through Python as text: beside a null, pandas would round them.
    named = docs.select(F.col("doc_id").cast("string"), F.xxhash64("text").alias("mark"), "text")
    survey = save(named.mapInPandas(_survey, _SURVEY), f"{root}/survey")
    members = survey.filter(F.col("chunk").isNull()).select(F.col("doc_id").cast(kind), "mark", "node", "n")
    nodes = members.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc"))
    stored = survey.filter(F.col("tokens").isNotNull()).select("node", "n", "tokens")

    # Index shingles that more than one node has, with the earliest such node.
    by_token = W.partitionBy("token")
    index = _index(stored, _grades(survey)).repartition("token").dropDuplicates(["token", "node"])
    shared = (
        index.withColumn("lo", F.min("node").over(by_token)).withColumn("hi", F.max("node").over(by_token))
        .filter("lo < hi").drop("lo", "hi")
    )
    shared = save(shared, f"{root}/shared")

    # Each node against the earliest node that it shares enough index shingles with.
    earliest = F.min(F.struct(F.col("doc").isNull(), "doc", "node", "n")).alias("first")
    firsts = shared.join(nodes, "node").groupBy("token").agg(earliest)
    leaders = shared.select("token", "node", "n").join(firsts, "token").select(
        "node", "n", F.col("first.node").alias("query"), F.col("first.n").alias("m")
    )
    stars = kept(
        leaders.filter((F.col("query") != F.col("node")) & _compatible("n", "m"))
        .groupBy("node", "query", "n", "m").agg(F.count("*").alias("c"))
        .filter(F.col("c") >= _least_shared("n", "m"))
        .groupBy("node").agg(F.max_by("query", F.struct("c", "query")).alias("query"))
    )
    sets = _sets_of(stored, stars.select(F.explode(F.array("query", "node")).alias("node"))).dropDuplicates(["node"])
    links = kept(verified(stars.select("query", "node"), save(sets, f"{root}/star-sets")))
    delete(spark, f"{root}/star-sets")  # the links are kept
    found = components(links)

    # Then all pairs across components that share index shingles and can reach the overlap.
    placed = shared.alias("s").join(found.alias("f"), F.col("s.node") == F.col("f.node"), "left").select(
        "s.token", "s.node", "s.n", "s.pos", F.coalesce("f.root", "s.node").alias("root")
    )
    several = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    across = save(placed.join(several.select("token"), "token", "left_semi"), f"{root}/across")
    x, y = across.alias("x"), across.alias("y")
    # The first common shingle of a linked pair leaves room for the rest of the overlap behind it.
    room = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    pairs = (
        x.join(
            y,
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.root") != F.col("y.root"))
            & (F.col("x.node") < F.col("y.node"))
            & _compatible("x.n", "y.n")
            & (room * (100 + PERCENT) >= PERCENT * (F.col("x.n") + F.col("y.n"))),
        )
        .select(F.col("x.node").alias("query"), F.col("y.node").alias("node"), F.col("x.n").alias("m"), F.col("y.n").alias("n"))
        .distinct()
    )
    one, other = across.select(F.col("node").alias("query"), "token"), across.select("node", "token")
    enough = kept(
        pairs.join(one, "query").join(other, ["node", "token"])
        .groupBy("query", "node", "m", "n").agg(F.count("*").alias("c"))
        .filter(F.col("c") >= _least_shared("m", "n")).select("query", "node")
    )
    ends = enough.select(F.explode(F.array("query", "node")).alias("node"))
    sets = _sets_of(stored, ends).dropDuplicates(["node"])
    late = kept(verified(enough, save(sets, f"{root}/late-sets")))
    for done in ("late-sets", "shared", "across"):
        delete(spark, f"{root}/{done}")
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(late))

    linked = joined.join(nodes, "node")
    least = linked.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = kept(
        nodes.alias("n").join(linked.join(least, "root").alias("l"), F.col("n.node") == F.col("l.node"), "left")
        .select("n.node", F.coalesce("l.root", "n.node").alias("root"), F.coalesce("component_id", "n.doc").alias("component_id"))
    )
    return members.alias("m").join(named.alias("c"), F.col("m.node") == F.col("c.node"), "left").select(
        "doc_id", "mark", "root", F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def first_of_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of linked ones: the one with the least id.

    Of several texts of a group under that id, the one with the least checksum stays. Documents
    without shingles are linked with nothing and stay, and so do rows without an id; rows that
    repeat an id are judged by their own text, and of rows alike in id and text one stays.
    """
    marked = kept(_grouped(docs).filter("root IS NOT NULL AND doc_id IS NOT NULL").select("root", "doc_id", "mark"))
    first = marked.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    gone = marked.join(first, "root").filter((F.col("doc_id") != F.col("first.doc_id")) | (F.col("mark") != F.col("first.mark")))
    hashed = docs.withColumn("__mark", F.xxhash64("text")).alias("d")
    same_row = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.__mark") == F.col("g.mark"))
    left = hashed.join(gone.select("doc_id", "mark").distinct().alias("g"), same_row, "left_anti")
    return left.drop("__mark").dropDuplicates(["doc_id", "text"])
