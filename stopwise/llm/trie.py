"""The prefix trie of conversations, from sorted neighbours and a union-find.

Rebuilt conversations are sorted by their turns' checksums, so that those with a common start are
neighbours. The length of the common start of two neighbours (LCP) is an edge; uniting along the
edges from the deepest to the shallowest builds the trie bottom-up, where every union of components
makes a branching node of that depth. A range partition does this for its own rows; what may still
unite across its ends, the nodes above its first and last row, is contracted to one summary each,
and summaries of neighbouring partitions are united in the same way, SPAN partitions at a time,
until one forest is left. Runs of unary nodes are never held: a branching node or an end stands for
the run above it, and the run's rows come from a join with the turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.llm.common import kept
from stopwise.storage import fresh_dir, save

#: A conversation starts with up to three turns of the first of its run of BASE ids.
BASE, HEADS = 20, 3
#: Hex digits of a turn's checksum; forests united by one task; ids of one text block.
DIGITS = 32
SPAN = 16
ENDS_AT_ONCE = 512
#: Depths of one generated run of unary nodes.
RUN = 1024
WORD = r"[^\x20\x09-\x0D]+"
NOBODY = hashlib.sha256(b"").hexdigest()

_NODE = "node_id string, conv_id long, depth long, parent_id string, parent_depth long, parent_conv_id long, " \
    "n_convs long, n_children long, n_leaves long, saved long, words long, ends string"  # fmt: skip
_FOREST = f"kind string, slice long, at long, {_NODE}, block string, first string, last string"


@dataclass
class Tree:
    """A node under construction: what its closed children and its ends add up to.

    ``words`` is the number of words down to its depth; ``ends`` the checksum of the ids that end
    here, or None where these may go on beyond a partition.
    """

    node_id: str
    depth: int
    words: int
    conv_id: int
    n_convs: int = 0
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    ends: str | None = NOBODY
    closed: list = field(default_factory=list)

    def join(self, other: Tree) -> None:
        """Add the other part of the same node."""
        self.conv_id = min(self.conv_id, other.conv_id)
        self.n_convs += other.n_convs
        self.n_children += other.n_children
        self.n_leaves += other.n_leaves
        self.saved += other.saved
        if other.ends != NOBODY:
            self.ends = other.ends
        self.closed += other.closed

    def adopt(self, child: Tree) -> None:
        """Close a deeper node as a child; its run of unary nodes reaches up to this depth."""
        self.conv_id = min(self.conv_id, child.conv_id)
        self.n_convs += child.n_convs
        self.n_children += 1
        self.n_leaves += child.leaves()
        self.saved += child.saved + (child.n_convs - 1) * (child.words - self.words)
        self.closed.append(child)

    def leaves(self) -> int:
        return self.n_leaves if self.n_children else 1


def unite(trees: list[Tree], edges: list[tuple[int, str, int]], open_ends: bool) -> list[Tree]:
    """Unite neighbours along ``edges``, deepest first; the roots that are left, from left to right.

    ``edges[i]`` is (LCP, id of the node of that depth, words down to it) of trees i and i + 1.
    With ``open_ends`` the nodes above the first and above the last tree stay open, each with what
    its closed children add up to, and are returned from the first tree up to the top and down to the last.
    """
    parent = list(range(len(trees)))
    top = list(trees)  # of a component, at its representative

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first, last = (0, len(trees) - 1) if open_ends else (-1, -1)
    left: list[Tree] = []
    right: list[Tree] = []
    for i in sorted(range(len(edges)), key=lambda e: (-edges[e][0], e)):
        depth, node_id, words = edges[i]
        a, b = find(i), find(i + 1)
        here: Tree | None = None
        for at in (a, b):
            tree = top[at]
            if tree.depth == depth:
                if here is None:
                    here = tree
                else:
                    here.join(tree)
        if here is None:
            here = Tree(node_id, depth, words, top[a].conv_id)
        for at, spine, end in ((a, left, first), (b, right, last)):
            tree = top[at]
            if tree.depth > depth:
                if end >= 0 and find(end) == at:
                    spine.append(tree)
                else:
                    here.adopt(tree)
        parent[b] = a
        top[a] = here
    if not trees:
        return []
    return [*left, top[find(0)], *reversed(right)]


def _node(tree: Tree, above: Tree | None, settled: bool) -> dict:
    """The row of a closed node; the parent's conv_id only if nothing can join the parent any more."""
    return {
        "kind": "node", "node_id": tree.node_id, "conv_id": tree.conv_id, "depth": tree.depth,
        "parent_id": above.node_id if above else None, "parent_depth": above.depth if above else None,
        "parent_conv_id": above.conv_id if above and settled else None,
        "n_convs": tree.n_convs, "n_children": tree.n_children, "n_leaves": tree.leaves(), "saved": tree.saved,
        "words": tree.words, "ends": tree.ends,
    }


def _emit(roots: list[Tree], done: bool) -> Iterator[dict]:
    """Rows of all closed nodes below the roots, and the roots themselves: closed too when ``done``."""
    for at, root in enumerate(roots):
        if done:
            yield _node(root, None, True)
        else:
            yield _node(root, None, False) | {"kind": "open", "at": at, "n_leaves": root.n_leaves}
        above = [(root, done)]
        while above:
            tree, settled = above.pop()
            for child in tree.closed:
                yield _node(child, tree, settled)
                above.append((child, True))
            tree.closed = []


_NAMES = [part.split()[0] for part in _FOREST.split(", ")]
_TEXTS = {"kind", "node_id", "parent_id", "ends", "block", "first", "last"}


def _frames(rows: Iterator[dict], size: int = 10_000) -> Iterator[pd.DataFrame]:
    batch: list[dict] = []
    for row in rows:
        batch.append(row)
        if len(batch) == size:
            yield _frame(batch)
            batch = []
    if batch:
        yield _frame(batch)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(
        {n: pd.Series([r.get(n) for r in rows], dtype=object if n in _TEXTS else "Int64") for n in _NAMES}
    )


def _named(key: str) -> str:
    """The id of the node a key leads to."""
    return hashlib.md5(key.encode()).hexdigest()


def _common(a: str, b: str) -> int:
    """Turns that two keys start with alike."""
    lo, hi = 0, min(len(a), len(b)) // DIGITS
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[: mid * DIGITS] == b[: mid * DIGITS]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _edge(before: str, key: str, sums) -> tuple[int, str, int]:
    """The edge between neighbouring keys; ``sums`` are the words down to each turn of the second."""
    depth = _common(before, key)
    return depth, _named(key[: depth * DIGITS]), int(sums[depth - 1]) if depth else 0


def _grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The forest of one sorted partition: closed nodes, open ones, its first and last key, and the
    ids that end at its first and last key, whose runs may go on in the neighbouring partitions."""
    slice_ = TaskContext.get().partitionId()
    trees: list[Tree] = []
    edges: list[tuple[int, str, int]] = []
    key, first, last = None, "", ""
    ids: list[int] = []  # of the run of equal keys at hand
    digest, started = hashlib.sha256(), False
    outer: list[dict] = []  # texts of the first run
    held: list[dict] = []  # texts of the run at hand, in case it is the last one

    def flush() -> None:
        nonlocal started, ids
        if ids:
            text = ",".join(map(str, ids))
            row = {"kind": "ends", "node_id": trees[-1].node_id, "conv_id": ids[0], "block": text}
            (outer if len(trees) == 1 else held).append(row)
            digest.update((f",{text}" if started else text).encode())
            started, ids = True, []

    for batch in batches:
        for conv, length, total, now, sums in zip(*(batch[c] for c in ("conv_id", "len", "words", "key", "sums"))):
            if now != key:
                flush()
                if trees:
                    trees[-1].ends = None if len(trees) == 1 else digest.hexdigest()
                    edges.append(_edge(key, now, sums))
                else:
                    first = _bound(now, sums)
                trees.append(Tree(_named(now), int(length), int(total), int(conv)))
                digest, started, held = hashlib.sha256(), False, []
                key, last = now, (now, sums)
            trees[-1].n_convs += 1
            ids.append(int(conv))
            if len(ids) == ENDS_AT_ONCE:
                flush()
    if not trees:
        return
    flush()
    trees[-1].ends = None
    bounds = {"kind": "bounds", "first": first, "last": _bound(*last)}
    roots = unite(trees, edges, open_ends=True)
    yield from _frames({**row, "slice": slice_} for row in (bounds, *_emit(roots, False), *outer, *held))


def _bound(key: str, sums) -> str:
    """A key and the words down to each of its turns, as one text."""
    return f"{key};{','.join(map(str, sums))}"


def _unbound(text: str) -> tuple[str, list[str]]:
    key, _, sums = text.partition(";")
    return key, sums.split(",")


def _merger(done: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Unites the contracted forests of neighbouring partitions; the root closes all when ``done``."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        bounds = group[group["kind"] == "bounds"].sort_values("slice")
        lasts = dict(zip(bounds["slice"], bounds["last"]))
        firsts = dict(zip(bounds["slice"], bounds["first"]))
        slices = [int(x) for x in bounds["slice"]]
        trees: list[Tree] = []
        edges: list[tuple[int, str, int]] = []
        at = None
        for row in group[group["kind"] == "open"].sort_values(["slice", "at"]).itertuples():
            tree = Tree(
                row.node_id, int(row.depth), int(row.words), int(row.conv_id), int(row.n_convs),
                int(row.n_children), int(row.n_leaves), int(row.saved), None if pd.isna(row.ends) else row.ends,
            )
            if trees and row.slice == at:
                upper = min(trees[-1], tree, key=lambda t: t.depth)
                edges.append((upper.depth, upper.node_id, upper.words))
            elif trees:
                edges.append(_edge(_unbound(lasts[at])[0], *_unbound(firsts[row.slice])))
            trees.append(tree)
            at = row.slice
        if done and all(t.depth for t in trees):  # nothing has reached the root yet
            trees.insert(0, Tree(_named(""), 0, 0, trees[0].conv_id))
            edges.insert(0, (0, _named(""), 0))
        rows = list(_emit(unite(trees, edges, open_ends=not done), done))
        if not done:
            rows.append({"kind": "bounds", "first": firsts[slices[0]], "last": lasts[slices[-1]]})
        return _frame([{**row, "slice": slices[0] // SPAN} for row in rows])

    return merge


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Checksums of the joined ids of each node; texts come sorted by node and first id."""
    node, digest = None, hashlib.sha256()
    for batch in batches:
        out = []
        for node_id, block in zip(batch["node_id"], batch["block"]):
            if node_id == node:
                digest.update(f",{block}".encode())
                continue
            if node is not None:
                out.append((node, digest.hexdigest()))
            node, digest = node_id, hashlib.sha256(block.encode())
        yield pd.DataFrame(out, columns=["node_id", "late_ends"])
    if node is not None:
        yield pd.DataFrame([(node, digest.hexdigest())], columns=["node_id", "late_ends"])


def _positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted turns with their number and the words so far, in their conversation and partition."""
    slice_ = TaskContext.get().partitionId()
    conv, n, words = None, 0, 0
    for batch in batches:
        ids = batch["conv_id"].to_numpy()
        own = batch["words"].to_numpy()
        new = np.flatnonzero(np.r_[len(ids) > 0 and ids[0] != conv, ids[1:] != ids[:-1]])
        starts = np.r_[0, new] if not len(new) or new[0] else new
        number, so_far = np.arange(1, len(ids) + 1), np.cumsum(own)
        lengths = np.diff(np.r_[starts, len(ids)])
        number = number - np.repeat(starts, lengths)
        so_far = so_far - np.repeat(so_far[starts] - own[starts], lengths)
        if len(ids) and ids[0] == conv:
            number[: lengths[0]] += n
            so_far[: lengths[0]] += words
        if len(ids):
            conv, n, words = ids[-1], int(number[-1]), int(so_far[-1])
        yield batch.assign(slice=slice_, pos=number, upto=so_far)[["conv_id", "checksum", "words", "slice", "pos", "upto"]]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, checksum, words, upto): turns in order, numbered from 1 in their conversation.

    ``upto`` counts the words down to and with the turn. Turns of equal number follow in the order
    of their checksums. No conversation meets in one task: the table is cut into ranges, and what a
    conversation has in earlier ranges is added where it goes on.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "checksum"]
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("checksum"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("bigint").alias("words"),
    )
    types = "conv_id long, checksum string, words long, slice int, pos long, upto long"
    rows = kept(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_positions, types))
    per = rows.groupBy("conv_id", "slice").agg(F.max("pos").alias("n"), F.max("upto").alias("w"))
    earlier = W.partitionBy("conv_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = per.select("conv_id", "slice", F.sum("n").over(earlier).alias("n"), F.sum("w").over(earlier).alias("w"))
    carried = F.broadcast(carried.filter("n IS NOT NULL"))  # only the first conversation of a range goes on
    return rows.join(carried, ["conv_id", "slice"], "left").select(
        "conv_id", (F.col("pos") + F.coalesce("n", F.lit(0))).alias("pos"), "checksum", "words",
        (F.col("upto") + F.coalesce("w", F.lit(0))).alias("upto"),
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, checksum, words, upto) of every rebuilt turn, and (conv_id, len, words) of every
    conversation, with turns or without.

    Conversation c starts with the first h turns of c - c % 20, h = crc32 of c as text modulo 4, and
    goes on with its own turns after its first h.
    """
    head = F.when(F.col("pos") <= HEADS, F.struct("pos", "checksum", F.col("words").alias("w")))
    convs = turns.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.max("upto").alias("total"), F.sort_array(F.collect_list(head)).alias("heads")
    )
    convs = kept(convs.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % (HEADS + 1)).cast("int")))
    base = convs.select(F.col("conv_id").alias("base"), F.col("heads").alias("given"))
    added = lambda heads: F.aggregate(heads, F.lit(0).cast("bigint"), lambda a, x: a + x["w"])
    convs = convs.join(base, F.col("base") == F.col("conv_id") - F.col("conv_id") % BASE, "left").select(
        "conv_id", "h", "n", "total", F.slice("heads", F.lit(1), F.col("h")).alias("dropped"),
        F.coalesce(F.slice("given", F.lit(1), F.col("h")), F.slice("heads", 1, 0)).alias("start"),
    )
    convs = kept(convs.select(
        "conv_id", "h", "start", F.size("start").alias("put"), (added("start") - added("dropped")).alias("more"),
        (F.size("start") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"),
        (F.col("total") + added("start") - added("dropped")).alias("words"),
    ))
    tails = turns.join(convs.select("conv_id", "h", "put", "more"), "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("put")).alias("d"), "checksum", "words",
        (F.col("upto") + F.col("more")).alias("upto"),
    )
    starts = convs.select("conv_id", "start", F.posexplode("start").alias("i", "turn")).select(
        "conv_id", (F.col("i") + 1).cast("bigint").alias("d"), "turn.checksum", F.col("turn.w").alias("words"),
        added(F.slice("start", F.lit(1), F.col("i") + 1)).alias("upto"),
    )
    return kept(tails.unionByName(starts)), convs.select("conv_id", "len", "words")


def _keys(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, len, words, key, sums): checksums of a conversation's turns as one text to sort by.

    A turn that no other conversation has at its depth ends all common starts: a key holds the
    turns up to the first such one, so it is as long as a start that is shared, not as a conversation.
    """
    alone = turns.groupBy("d", "checksum").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).filter("n = 1")
    alone = alone.groupBy("conv_id").agg(F.min("d").alias("upto_d"))
    shared = turns.join(alone, "conv_id", "left").filter("upto_d IS NULL OR d <= upto_d")
    steps = shared.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("d", "checksum", "upto"))).alias("steps"))
    return convs.join(steps, "conv_id", "left").select(
        "conv_id", "len", "words",
        F.coalesce(F.array_join("steps.checksum", ""), F.lit("")).alias("key"),
        F.coalesce(F.col("steps.upto"), F.array().cast("array<bigint>")).alias("sums"),
    )


def trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``conversations`` needs conv_id and turn (longs), role and text; other columns are not read.
    Turns follow by ``turn``, null first, equal ones by checksum, repeated rows each being a turn;
    null role or text is empty, rows without conv_id belong to no conversation. Without a
    conversation there is no node, not even the root, as it would have no smallest member.
    """
    turns, convs = rebuilt(numbered_turns(conversations))
    spark = conversations.sparkSession
    root = fresh_dir(spark, "trie")
    order = ["key", "conv_id"]
    sorted_ = _keys(turns, convs).repartitionByRange(*order).sortWithinPartitions(*order)
    forest = save(sorted_.mapInPandas(_grow, _FOREST), f"{root}/0")
    levels = [forest]
    slices = forest.agg(F.max("slice")).first()[0]
    done = slices is None
    while not done:
        done = slices < SPAN  # one task is left
        open_ = levels[-1].filter("kind IN ('open', 'bounds')")
        level = open_.groupBy(F.floor(F.col("slice") / SPAN)).applyInPandas(_merger(done), _FOREST)
        levels.append(save(level, f"{root}/{len(levels)}"))
        slices //= SPAN
    nodes = reduce(DataFrame.unionByName, levels).filter("kind = 'node'")
    texts = forest.filter("kind = 'ends'").select("node_id", "conv_id", "block")
    texts = texts.repartition("node_id").sortWithinPartitions("node_id", "conv_id")
    late = texts.mapInPandas(_digests, "node_id string, late_ends string")
    above = nodes.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("late_parent"))
    settled = nodes.filter("parent_conv_id IS NOT NULL OR parent_id IS NULL").withColumn("late_parent", F.lit(None).cast("long"))
    asked = nodes.filter("parent_conv_id IS NULL AND parent_id IS NOT NULL").join(above, "parent_id")
    nodes = settled.unionByName(asked).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "late_parent"))
    closed = nodes.filter("ends IS NOT NULL")
    nodes = closed.unionByName(
        nodes.filter("ends IS NULL").drop("ends").join(late, "node_id").withColumnRenamed("late_ends", "ends"), True
    )
    runs = nodes.filter("depth > 0").withColumn("run", F.explode(F.sequence("parent_depth", F.col("depth") - 1, F.lit(RUN).cast("long"))))
    runs = runs.withColumn("d", F.explode(F.sequence(F.col("run") + 1, F.least(F.col("run") + RUN, "depth"))))
    last = F.col("d") == F.col("depth")
    below = turns.select("conv_id", "d", (F.col("upto") - turns["words"]).alias("before"))
    rows = runs.join(below, ["conv_id", "d"]).select(
        "conv_id", F.col("d").alias("depth"),
        F.when(F.col("d") - 1 == F.col("parent_depth"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * (F.col("words") - F.col("before"))).alias("saved_tokens"),
        F.when(last, F.col("ends")).otherwise(F.lit(NOBODY)).alias("ends_sha256"),
    )
    top = nodes.filter("depth = 0").select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
    return rows.unionByName(top)
