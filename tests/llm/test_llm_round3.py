"""Distribution divergence, conversation trie, whitening and guess costs against brute force; odd inputs."""

import collections
import hashlib
import os
import random
import re
import time
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.llm import divergence, htmltext, jaccard, mixing, neighbours, registry, secrets, toxicity, trie, whitening

SF = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables not present")
WORD = r"[^\x20\x09-\x0D]+"

# --- distribution divergence


def slow_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, by the rules' own words."""
    words = re.findall(WORD, text)
    lines = text.split("\n")
    dups = sum(1 for i, x in enumerate(lines) if re.search(WORD, x) and x in lines[:i])
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= set(range(i, i + 5))
    return (len(words), sum(len(w) for w in words), sum(c in "#*$%&|<>" for c in text), dups, len(inside))


def slow_classes(text):
    out = collections.Counter()
    for c in text:
        kind = unicodedata.category(c)
        if kind in ("Lu", "Lt"):
            out["upper"] += 1
        elif kind[0] in "LM":
            out["lower"] += 1
        elif kind[0] == "N":
            out["digit"] += 1
        elif c.isspace():
            out["space"] += 1
        elif c in ".,;:'\"?!-()" or (kind[0] == "P" and ord(c) > 126):
            out["mark"] += 1
        elif 32 < ord(c) < 127 or kind[0] == "S":
            out["symbol"] += 1
        else:
            out["other"] += 1
    return out


def slow_apart(a, b):
    if not sum(a.values()) or not sum(b.values()):
        return 1.0
    total = 0.0
    for x, y in ((a, b), (b, a)):
        for k, n in x.items():
            p, q = n / sum(x.values()), y.get(k, 0) / sum(y.values())
            total += p * np.log2(2 * p / (p + q)) if p else 0
    return float(np.sqrt(max(0, total / 2)))


def slow_kept(rows):
    """kept and both distances per document, from whole counts in memory."""
    docs = []
    for i, text, lang in rows:
        words = re.findall(WORD, text or "")
        counted = collections.Counter(w for w in (x.lower().strip(divergence.EDGES) for x in words) if w)
        base = slow_base(text or "")
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        docs.append((i, lang, text or "", base, failed, slow_classes(text or ""), counted))
    near = set(range(len(docs)))
    common = None
    for _ in range(divergence.ROUNDS):
        refs = {}
        for k, (_, lang, _, _, failed, chars, words) in enumerate(docs):
            if lang is not None and not failed and k in near:
                ref = refs.setdefault(lang, (collections.Counter(), collections.Counter()))
                ref[0].update(chars)
                ref[1].update(words)
        total = sum(sum(r[1].values()) for r in refs.values())
        if common is None:
            refs = {x: r for x, r in refs.items() if sum(r[1].values()) >= divergence.LANGUAGE * total}
            common = {x: {w for w, c in r[1].items() if c >= divergence.COMMON * sum(r[1].values())} for x, r in refs.items()}
        refs = {x: r for x, r in refs.items() if x in common}

        def folded(words, common):
            out = collections.Counter({w: c for w, c in words.items() if w in common})
            out[None] = sum(words.values()) - sum(out.values())
            return out

        found, near = [], set()
        for k, (_, lang, text, base, _, chars, words) in enumerate(docs):
            best = None
            for x in [lang] if lang in refs else refs:
                pair = (slow_apart(chars, refs[x][0]), slow_apart(folded(words, common[x]), folded(refs[x][1], common[x])))
                best = pair if best is None or sum(pair) < sum(best) else best
            by_chars, by_words = best or (None, None)
            by_chars = by_chars if len(text) >= divergence.LEAST_CHARS else None
            by_words = by_words if base[0] >= divergence.LEAST_FOR_WORDS else None
            found.append((by_chars, by_words))
            if (by_chars or 0) <= divergence.MOST_CHARS_APART and (by_words or 0) <= divergence.MOST_WORDS_APART:
                near.add(k)
    return {d[0]: (not d[4] and k in near, *found[k], d[3], d[4]) for k, d in enumerate(docs)}


@given
def test_divergence_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect() if len(r["text"]) < 6000]
    got = {r["doc_id"]: r for r in divergence.judge(spark.createDataFrame(rows, docs.schema)).collect()}
    want = slow_kept(rows)
    assert set(got) == set(want)
    for i, (kept, by_chars, by_words, base, failed) in want.items():
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == base
        assert (r["base_failed"], r["kept"]) == (failed, kept)
        assert r["chars_apart"] == (pytest.approx(by_chars, abs=1e-9) if by_chars is not None else None)
        assert r["words_apart"] == (pytest.approx(by_words, abs=1e-9) if by_words is not None else None)


@given
def test_divergence_keeps_good_documents_and_drops_junk(spark):
    got = {r["doc_id"]: r for r in registry.op11_divergence(spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["doc_id"] in got]
    good = [got[r["doc_id"]] for r in labels if r["quality"] == 1 and not got[r["doc_id"]]["base_failed"]]
    junk = [got[r["doc_id"]] for r in labels if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(r["kept"] for r in junk) <= 0.2 * len(junk)


def test_divergence_of_odd_rows(spark):
    prose = "the cat and the dog went to the old house by the sea and they saw a boat there. " * 3
    other = " ".join(f"word{i} of the sea" for i in range(60))
    rows = [(1, None, "en"), (2, "", None), (3, prose, "en"), (4, other, None), (4, other, "en"),
            (5, "A#B *x* <y> | $5 % & end. " * 40, "xx"), (None, "\U0001f600 ퟿ é ß 1 ²", "en"),
            (6, "x y\n\nx y\n \nx y\n", "en"), (7, "w " * 200_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clashing = df.selectExpr("*", "'mine' AS n_words", "'mine' AS kept", "'at' AS at", "1 AS classes", "2 AS __row_")
    got = divergence.judge(clashing).collect()
    assert len(got) == len(rows)
    assert {r["at"] for r in got} == {"at"}
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    for i in (1, 2):
        assert (by[i][0]["n_words"], by[i][0]["base_failed"], by[i][0]["kept"]) == (0, True, False)
    for i, text, _ in rows:
        if i not in (4, 7):
            r = by[i][0]
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == slow_base(text or "")
    assert by[6][0]["n_dup_lines"] == 2
    assert by[7][0]["n_repeat_words"] == 200_000 and by[7][0]["base_failed"]
    left = divergence.clean(clashing)
    assert left.columns == clashing.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert divergence.judge(df.limit(0)).collect() == []
    assert [r["kept"] for r in divergence.judge(spark.createDataFrame([(1, other, None)], df.schema)).collect()] == [True]


def test_bounded_counters_miss_no_common_word():
    rng = random.Random(5)
    words = ["hot"] * 400 + ["warm"] * 60 + [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    rng.shuffle(words)
    own = divergence.Frequent(500)
    for i in range(0, len(words), 97):
        own.add(words[i : i + 97])
    own.shrink()
    true = collections.Counter(words)
    assert len(own.counts) <= 500 and own.off < own.total / 500
    assert all(true[w] - own.off <= own.counts[w] <= true[w] for w in ("hot", "warm"))


# --- conversation trie

NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id long, turn long, role string, text string"


def slow_trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((t is not None, t or 0, mark), (role, text)))
    own = {c: [b for _, b in sorted(v, key=lambda z: z[0])] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        sequence = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(sequence) + 1):
            members[sequence[:d]].append(c)
        ends[sequence].append(c)
    children, leaves, saved = (collections.Counter() for _ in range(3))
    for v in members:
        if v:
            children[v[:-1]] += 1
    for v, of in members.items():
        words = (len(of) - 1) * len(re.findall(WORD, v[-1][1])) if v else 0
        for d in range(len(v) + 1):
            saved[v[:d]] += words
            leaves[v[:d]] += not children[v]
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(
        (
            (of[0], len(v), members[v[:-1]][0] if v else None, len(of), children[v], leaves[v], saved[v], sha(ends.get(v, [])))
            for v, of in members.items()
        ),
        key=repr,
    )


def nodes(df):
    return sorted((tuple(r) for r in trie.trie(df).select(NODE).collect()), key=repr)


@given
def test_trie_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted((tuple(r) for r in registry.op12_trie(spark, SF).select(NODE).collect()), key=repr)
    assert got == slow_trie([tuple(r) for r in df.collect()])


def odd_conversations():
    rng = random.Random(4)
    rows = []
    for c in range(-10, 120):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            text = rng.choice(["a", "b c", "", "x y z"]) if t < 3 or rng.random() < 0.7 else str(rng.random())
            rows.append((c, t, "u" if t % 2 == 0 else None, text))
    rows += [*rows[5:9], (None, 1, "u", "x"), (7, None, "u", "q"), (7, None, None, None)]
    for c in range(1000, 1200):  # a large group of copies, and a start of it
        rows += [(c, 0, "u", "same"), (c, 1, "a", "same two")] + [(c, 2, "u", "more")] * (c % 3 > 0)
    rows += [(5000, t, "u", f"turn {t}") for t in range(300)]
    return rows


def test_trie_joins_forests_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(trie, "SPAN", 2)
    monkeypatch.setattr(trie, "ENDS_AT_ONCE", 16)
    monkeypatch.setattr(trie, "RUN", 7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        rows = odd_conversations()
        df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'mine' AS d", "'mine' AS key", "1 AS n_convs", "2 AS slice")
        assert nodes(df) == slow_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_little(spark):
    assert nodes(spark.createDataFrame([], TURNS)) == []
    assert nodes(spark.createDataFrame([(None, 1, "u", "x")], TURNS)) == []
    # crc32 of "1" leaves 3 modulo 4 and there is no conversation 0: no turn is left, the root is a leaf.
    empty = hashlib.sha256(b"1").hexdigest()
    assert nodes(spark.createDataFrame([(1, 1, "u", "x")], TURNS)) == [(1, 0, None, 1, 0, 1, 0, empty)]


# --- whitening

VECTORS = "vec_id long, embedding array<double>"


def slow_whitening(x, k):
    """(values, whitened, trace) by a full eigendecomposition of the whole covariance."""
    centred = x - x.sum(axis=0) / len(x)
    v = centred.T @ centred / len(x)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    q = q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(k)])
    return e, centred @ q / np.sqrt(e), np.trace(v)


def whitened(df, **how):
    rows = collections.defaultdict(dict)
    for r in whitening.whiten(df, **how).collect():
        rows[r["vec_id"]][r["component"]] = r
    return rows


@given
def test_whitening_equals_a_full_decomposition(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r["embedding"] for r in rows], float)) + 1e6
    e, z, trace = slow_whitening(x, 32)
    got = collections.defaultdict(dict)
    for r in registry.op13_whitening(spark, SF).collect():
        got[r["vec_id"]][r["component"]] = r
    n, sums = len(x), x.sum(axis=0)
    assert set(got) == {r["vec_id"] for r in rows}
    for i, r in enumerate(rows):
        mine = got[r["vec_id"]]
        assert sorted(mine) == list(range(1, 33))
        assert np.allclose([mine[c]["whitened"] for c in range(1, 33)], z[i], atol=1e-8)
        exact = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
        assert {(m["n"], m["deviation"]) for m in mine.values()} == {(n, exact)}
    first = got[rows[0]["vec_id"]]
    assert np.allclose([first[c]["explained"] for c in range(1, 33)], e / trace, rtol=1e-10)
    assert max(r["identity_error"] for r in first.values()) <= 1e-9


def test_whitening_filters_a_wide_spectrum(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((600, 90)) * np.linspace(3, 1, 90)
    x[:200] = x[0]  # a third of all rows is one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS).repartition(3)
    e, z, trace = slow_whitening(np.floor(64 * x) + 1e6, 6)
    got = whitened(df, components=6, guard=4)
    mine = np.array([[got[i][c]["whitened"] for c in range(1, 7)] for i in range(len(x))])
    assert np.allclose(mine, z, atol=1e-7)
    assert np.allclose([got[0][c]["explained"] for c in range(1, 7)], e / trace)
    again = whitened(df.repartition(5), components=6, guard=4)
    assert np.allclose([[again[i][c]["whitened"] for c in range(1, 7)] for i in range(len(x))], mine, atol=1e-7)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 0.5], [0.5, -1.0, 0.25], [2.0, 2.0, 0.5], [0.0, 0.0, 0.5]]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (10, None), (11, [1.0, None, 2.0]), (12, [nan, 1.0, 1.0]), (13, [inf, 1.0, 1.0]), (14, [-inf, 0.0, 0.0]),
        (15, [1.0]), (16, []), (None, [3.0, 1.0, 0.5]), (2, [2.0, 2.0, 0.5]), (17, [1e300, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'mine' AS n", "'mine' AS component", "'mine' AS x")
    got = whitening.whiten(df).collect()
    used = [*good, [3.0, 1.0, 0.5], [2.0, 2.0, 0.5]]
    assert {r["n"] for r in got} == {len(used)}
    # The floor of the third dimension takes two values, so all three have variance.
    assert collections.Counter(r["vec_id"] for r in got) == {0: 3, 1: 3, 3: 3, None: 3, 2: 6}
    x = np.floor(64 * np.array(used)) + 1e6
    e, z, _ = slow_whitening(x, 3)
    mine = {r["component"]: r["whitened"] for r in got if r["vec_id"] == 0}
    assert np.allclose([mine[c] for c in (1, 2, 3)], z[0], atol=1e-9)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.filter("vec_id = 0")).collect() == []  # no variance, no component
    flat = spark.createDataFrame([(i, [float(i), 7.0]) for i in range(5)], VECTORS)
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}


def test_deviations_are_exact_beyond_longs(spark):
    big = 2.0**40
    df = spark.createDataFrame([(1, [big, 1.0]), (2, [-big, 0.0]), (3, [0.0, 5.0])], VECTORS)
    x = [[int(64 * a) + 1_000_000 for a in v] for v in ([big, 1.0], [-big, 0.0], [0.0, 5.0])]
    sums = [sum(c) for c in zip(*x)]
    exact = {i + 1: sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    for r in whitening.whiten(df).collect():
        assert int(r["deviation_exact"]) == exact[r["vec_id"]]
        assert r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None)


# --- guess costs


def slow_cost(value, ranks):
    """Every segmentation, of pieces as the operator defines them."""
    low = value.lower() if len(value.lower()) == len(value) else value
    plain = low.translate(secrets._LEET)
    best = [0.0] + [np.inf] * len(value)
    for i in range(1, len(value) + 1):
        best[i] = best[i - 1] + secrets._brute_force(low[i - 1])
        for s in range(i):
            piece, size = low[s:i], i - s
            costs = [np.log10(ranks[w] + 1) + 0.3 * (value[s:i] != w) for w in (piece, plain[s:i]) if size > 2 and w in ranks]
            if any(d.fullmatch(value[s:i]) for d in secrets._DATES):
                costs.append(np.log10(36500))
            if size > 2 and all(piece[k : k + 2] in secrets._NEXT for k in range(size - 1)):
                costs.append(np.log10(50) + np.log10(size))
            for p in range(1, secrets.LONGEST_UNIT + 1):
                if size % p == 0 and size >= max(3, 2 * p) and piece == piece[:p] * (size // p):
                    unit = secrets._brute_force(piece) if p == 1 else slow_cost(piece[:p], ranks)
                    costs.append(unit + np.log10(size // p))
            if costs:
                best[i] = min(best[i], best[s] + min(costs))
    return best[-1]


def test_guess_cost_is_the_minimum_over_all_pieces():
    rng = random.Random(1)
    parts = ("pass word ssss qwer 1234 2024 0131 abc abcabc zx P@ss dragon X 9 - . 12121 hello asdf tttt poiu w "
             "20240131 qaz").split()  # fmt: skip
    for value in ("passssss", "shadowwwww", "trustttttt", "abcabcabcabc", "qwqwqwqw", "İstanbul1", ""):
        assert secrets.guess_cost(value) == pytest.approx(slow_cost(value, secrets.COMMON)), value
    for _ in range(3000):
        if rng.random() < 0.7:
            value = "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))
        else:
            value = "".join(rng.choice("qwertas12 5aZ") for _ in range(rng.randint(1, 18)))
        assert secrets.guess_cost(value) == pytest.approx(slow_cost(value, secrets.COMMON)), value


def test_names_made_of_words_are_no_secrets(spark):
    prose = "the correct horse has a battery and a staple from the vault to get a process name in this env\n"
    df = spark.createDataFrame([(i, prose * 2) for i in range(10)], "doc_id long, text string")
    ranks = secrets.learn(df, path="/nowhere")
    assert ranks["horse"] and ranks["password"] == 1 and "zzz" not in ranks
    for value in ("correcthorsebatterystaple", "process.env.SECRET_NAME", "getSecretFromVault()"):
        assert not secrets.guessed_spans(f"token = {value}", ranks=ranks), value
    for value in ("x7Fq9ZkLm2Pw#q", "ghp_16C7e42F292c6912E7710c838347Ae178B4a", "8231957203948172"):
        assert secrets.guessed_spans(f"token = {value}", ranks=ranks), value
    assert secrets.learn(df.limit(0), path="/nowhere")["password"] == 1
    assert secrets.vocabulary("/nowhere") == []


def test_words_are_ranked_by_all_documents(spark, monkeypatch):
    names = ["".join("bcdfghjklm"[int(d)] for d in f"{i:03d}") + "ora" for i in range(300)]
    long = "qx" * 5000
    rows = [(i, f"text {i} {names[i % 300]} {long if i < 5 else ''}") for i in range(1500)]
    rows += [(i, f"other {i}") for i in range(1500, 6000)] + [(6000, None), (6001, "")]
    ranks = secrets.learn(spark.createDataFrame(rows, "doc_id long, text string"), path="/nowhere")
    assert set(names) <= set(ranks)  # five times each, wherever they are
    assert ranks["other"] == 1 and ranks["text"] == 2
    monkeypatch.setattr(secrets, "LEARNED", 7)
    few = secrets.learn(spark.createDataFrame(rows, "doc_id long, text string"), path="/nowhere")
    assert set(few) - set(secrets.WORDS) - {"other"} == {"text", *sorted(names)[:5]}
    assert ranks[long] and len(ranks.lengths) < 20  # a long word is no cost for every value
    for value in ("correcthorse" + names[7], long, names[3] * 3, "x7Fq9ZkLm2Pw"):
        slow = secrets.Ranks(())
        slow.update(ranks)
        slow.lengths = range(3, max(map(len, ranks)) + 1)
        assert secrets.guess_cost(value[:40], ranks) == pytest.approx(secrets.guess_cost(value[:40], slow))


# --- toxicity


def test_the_classifier_is_fitted_in_a_task(spark, monkeypatch):
    from pyspark import TaskContext

    inner = toxicity.fit

    def fit(*a, **k):
        if TaskContext.get() is None:
            raise AssertionError("fitted in the driver")
        return inner(*a, **k)

    monkeypatch.setattr(toxicity, "fit", fit)
    bad, good = "you stupid worthless clown", "a kind word for the garden and the sea"
    docs = spark.createDataFrame([(i, (bad if i % 2 else good) + f" {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all((rows[i]["score"] > 0.3) == bool(i % 2) for i in range(60))


def test_toxicity_scores_equal_a_plain_scorer(spark):
    """Weights times features, n-gram by n-gram, as the method words it."""
    bad, good = "you stupid worthless clown", "a kind word for the garden and the sea"
    docs = spark.createDataFrame([(i, (bad if i % 3 else good) + f" {i}" * (i % 5)) for i in range(40)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, toxic int"))

    def place(gram):
        h = int(np.uint64(ord(gram[0])) * np.uint64(int(toxicity._MIX)) & np.uint64(0xFFFFFFFF))
        for c in gram[1:]:
            point = ord(c) * int(toxicity._MIX) & 0xFFFFFFFF
            h = ((h * int(toxicity._MUL)) & 0xFFFFFFFF) ^ point
        return (h * int(toxicity._MIX) & 0xFFFFFFFF) >> (32 - toxicity.BITS)

    for r in toxicity.score(docs, model).collect():
        text = f" {r['text'].lower()} "
        counts = collections.Counter(place(text[i : i + n]) for n in toxicity.ORDERS for i in range(len(text) - n + 1))
        size = np.sqrt(sum(np.log1p(c) ** 2 for c in counts.values()))
        z = model.bias + sum(model.weights[p] * np.log1p(c) / size for p, c in counts.items())
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


# --- HTML


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, '<a b=">"' * 60_000, "</b " * 200_000, "<div>x" * 40_000, "<svg>" * 100_000, "<p a='" * 100_000,
     "<" * 500_000, "</q>" * 100_000 + "<div>" * 20_000 + "</p>" * 50_000, "<!--" * 100_000, '<p x="' + "<p x='>" * 50_000],
)
def test_hostile_markup_takes_linear_time(page):
    start = time.process_time()
    htmltext.blocks(page)
    assert time.process_time() - start < 8


def test_quotes_open_values_only_where_they_close():
    texts = lambda page: [b.text for b in htmltext.blocks(page)]
    assert texts("<p data-x=it's>three</p><p>four isn't</p>") == ["three", "four isn't"]
    assert texts("<p title='a > b' class=\"x>y\">one<p a = 'never>two</p>") == ["one", "two"]
    assert texts("a < b <3 <p>c</p><br/>d<") == ["a < b <3", "c", "d<"]
    assert texts("<select>lost<p>kept</p>") == ["lost", "kept"] and texts("<script>lost<p>lost</p>") == []


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    return htmltext.train(pages)


def prose(rnd):
    return " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8))) for _ in range(rnd.randint(12, 60))) + "."


@given
@pytest.mark.parametrize(
    "open_, close",
    [("<div class='wrapper sidebar-right has-comments'><article>", "</article></div>"), ("<div class='x1'>", "</div>"),
     ("<div class='has-sidebar'><div class='page with-ads'><div class='q7'>", "</div></div></div>"),
     ("<article>", "</article>"), ("<main id=main>", "</main>")],
)
def test_articles_of_unseen_names_are_found(labeller, open_, close):
    rnd, right, total = random.Random(3), 0, 0
    for _ in range(40):
        paragraphs = [prose(rnd) for _ in range(rnd.randint(4, 9))]
        inner = "<h1>" + prose(rnd)[:30] + "</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        around = "<nav><ul><li><a href=x>home</a></li><li><a href=y>news</a></li></ul></nav>"
        page = htmltext.blocks(f"<body>{around}{open_}{inner}{close}<footer><p>copyright</p></footer></body>")
        marked = labeller.label([htmltext.describe(page)])[0] >= 0.5
        want = np.array([False] * 2 + [True] * (len(paragraphs) + 1) + [False])
        right += (marked == want).sum()
        total += len(want)
    assert right >= 0.95 * total


@given
def test_lists_and_code_of_an_article_stay_and_related_boxes_go(labeller):
    rnd = random.Random(4)
    a, b, c, d = (prose(rnd) for _ in range(4))
    page = htmltext.blocks(
        f"<article><p>{a}</p><ul><li>{b}</li><li>{c}</li></ul><pre>{d}</pre>"
        f"<aside class='related'><p>{prose(rnd)}</p></aside><p>{a}</p></article>"
    )
    assert (labeller.label([htmltext.describe(page)])[0] >= 0.5).tolist() == [True] * 4 + [False, True]


def test_long_pages_teach_too_and_nothing_teaches_nothing(spark):
    rnd = random.Random(5)
    nav = "<nav><ul><li><a href=x>home</a></li></ul></nav>"
    texts = [prose(rnd) for _ in range(130)]
    page = f"<body>{nav}<article>{''.join(f'<p>{t}</p>' for t in texts)}</article><footer>end</footer></body>"
    schema = "page_id long, html string"
    df = spark.createDataFrame([(i, page) for i in range(20)], schema)
    got = htmltext.extract(df, htmltext.train(df)).collect()
    assert {r["text"] for r in got} == {"\n".join(texts)}
    assert htmltext.train(df.limit(0)) is None and htmltext.train(spark.createDataFrame([(1, ""), (2, None)], schema)) is None
    assert {r["text"] for r in htmltext.extract(df, None).collect()} == {"\n".join(texts)}


# --- mixing


def test_small_sources_are_given_their_targets(spark):
    rows = [(i, "a b c", f"s{i:02d}") for i in range(20)]
    rows += [(100 + i, " ".join(["w"] * 500), f"t{i % 20:02d}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert all(target[f"s{i:02d}"] == taken[f"s{i:02d}"] == 9 for i in range(20))
    lines, total = mixing.laid_out(df)
    mixed = mixing.mixture(lines, total)
    assert mixed.agg({"words": "sum"}).first()[0] == sum(taken.values())
    assert mixed.groupBy("source_no", "turn").count().agg({"count": "max"}).first()[0] >= 1
    slots = mixed.select("source_no", "turn", "slot").distinct()
    assert slots.count() == slots.select("source_no", "turn").distinct().count()


def test_ranges_of_rows_do_not_change_the_mix(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(40)), rng.choice(["hot", "hot", "a", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = ["doc_id", "taken", "target"]
    want = sorted(map(str, mixing.mix(df).select(names).collect()))
    monkeypatch.setattr(mixing, "ROWS", 8)
    assert sorted(map(str, mixing.mix(df).select(names).collect())) == want


# --- near copies


def test_other_texts_under_a_dropped_id_stay(spark):
    copy = "one two three four five six seven eight nine ten"
    near = copy + " " + " ".join(f"w{i}" for i in range(60))
    rows = [(1, copy), (2, copy), (2, "an entirely different text of quite a few other words"), (2, None), (None, copy),
            (5, near), (5, near + " more"), (6, near + " other"), (5, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS mark", "'mine' AS root")
    left = sorted(((r["doc_id"], r["text"]) for r in jaccard.first_of_group(df).collect()), key=repr)
    assert (1, copy) in left and (2, copy) not in left
    assert (2, rows[2][1]) in left and (2, None) in left and (None, copy) in left
    assert len([x for x in left if x[0] in (5, 6)]) == 1 and len(left) == 5
    assert set(jaccard.first_of_group(df).columns) == set(df.columns)


def test_blocks_that_many_queries_read_are_copied(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 6)))], VECTORS)
    read = lambda: sorted(tuple(r) for r in neighbours.search(df, F.col("vec_id") % 2 == 0, k=5).collect())
    monkeypatch.setattr(neighbours, "QUERIES", 10**6)
    want = read()
    monkeypatch.setattr(neighbours, "QUERIES", 16)
    assert read() == want


# --- what the pipeline holds beside its heap and on disk


def test_near_copies_leave_no_shuffle_files(spark):
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffles():
        names = [f for d in dirs for _, _, files in os.walk(d) for f in files]
        return {f.split("_")[1] for f in names if f.startswith("shuffle_")}

    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[: 30 + i % 10])) for i in range(60)]
    before = shuffles()
    grouped = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    until = time.time() + 20  # they go in the background
    while len(shuffles() - before) > 2 and time.time() < until:
        time.sleep(0.2)
    assert len(shuffles() - before) <= 2  # that of the sketch, which is read as an iterator
    assert grouped.count() == 60
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_pipeline_hands_few_rows_to_python_at_once(spark, monkeypatch):
    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(corpus_pipeline.jaccard, "first_of_group", lambda docs: docs)
    sizes = lambda batches: (b[["id"]].assign(id=len(b)) for b in batches)
    rows = spark.range(0, 2500, 1, 1)
    try:
        assert corpus_pipeline.near_duplicates(spark, rows, "") is rows
        assert rows.mapInPandas(sizes, "id long").agg(F.max("id")).first()[0] == 1000
        spark.conf.set(name, "300")
        corpus_pipeline.near_duplicates(spark, rows, "")
        assert spark.conf.get(name) == "300"
        with corpus_pipeline.restored_batches(spark):
            spark.conf.set(name, "0")
            corpus_pipeline.near_duplicates(spark, rows, "")
            assert spark.conf.get(name) == "1000"
        assert spark.conf.get(name) == "300"
    finally:
        spark.conf.set(name, before)


def test_near_copies_hand_few_rows_to_python_at_once(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, survey = spark.conf.get(name), jaccard._survey

    def bounded(batches):
        def few():
            for batch in batches:
                assert len(batch) <= 1000
                yield batch

        return survey(few())

    monkeypatch.setattr(jaccard, "_survey", bounded)
    rows = spark.range(0, 2500, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d "), F.col("id") % 5).alias("text"))
    found = jaccard.classes(rows).groupBy("component_id").count().collect()
    assert {tuple(r) for r in found} == {(i, 500) for i in range(5)}
    assert spark.conf.get(name) == before
