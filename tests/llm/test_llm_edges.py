"""Odd inputs for every training-data operator: nulls, empty and long texts, repeats, ties, no rows,
and extra columns whose names the operators use themselves."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stopwise.llm import (
    decontaminate, htmltext, jaccard, language, lines, mixing, neighbours, secrets, substrings, toxicity,
)

PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
ROWS = [
    (1, PROSE + "\nfooter line\nown line a", "en", "s1"),
    (2, PROSE + "\nfooter line\nown line b", "en", "s1"),
    (2, PROSE + "\nfooter line\nown line b", "en", "s1"),
    (3, None, "en", "s1"),
    (4, "", None, "s2"),
    (5, "   \n \t ", "de", None),
    (6, LONG, "en", "s1"),
    (6, "another text under the same id", "en", "s1"),
    (None, PROSE, None, None),
    (None, None, None, None),
    (7, "\U0001f600 é ß 12 !!", "de", "s1"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use for their own columns.
CLASHES = "at window line size score found node token pos n copy start length hash words rank target".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"mine-{c}") for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_mixing(docs, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = {r["source"]: r for r in got}
    # Sources s1, s2 and the null source weigh 1, 2, 3; s2 has no words, so its target is 0.
    assert by["s2"]["target"] == 0 and by["s2"]["source_size"] == 0
    assert by[None]["source_size"] == 15 and by[None]["target"] == 45.0
    total = sum(r["size"] for r in got)
    assert by["s1"]["target"] == total - 45
    assert mixing.mix(nothing).collect() == []
    again = mixing.mix(docs.repartition(5))
    assert pairs(again, "doc_id", "size", "taken") == pairs(mixing.mix(docs), "doc_id", "size", "taken")


def test_language(docs, nothing):
    model = language.train(docs)
    got = language.identify(docs, model)
    assert set(CLASHES) - {"score"} <= set(got.columns) and got.count() == len(ROWS)
    none = [r["lang_pred"] for r in got.collect() if not any(map(str.isalpha, r["text"] or ""))]
    assert none == ["und"] * 4
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "und"} for r in got.collect())
    untaught = language.identify(docs, language.train(nothing))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
    assert language.identify(nothing, model).collect() == []


def test_substrings(docs, nothing):
    got = substrings.dedup(docs).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"]))
    assert by[3] == [(0, 0)] and by[4] == [(0, 0)]
    assert len(by[6]) == 2 and all(gone == 0 for _, gone in by[6])
    assert substrings.dedup(nothing).collect() == []


def test_lines(docs, nothing):
    got = lines.drop_boilerplate(docs, ratio=0.3, least=2)
    assert set(got.columns) == {*docs.columns, "n_lines", "n_removed"}
    rows = [r for r in got.collect() if r["doc_id"] in (1, 2)]
    # Four lines each, of which the shared two are on three of the seven pages of s1.
    assert [(r["n_lines"], r["n_removed"]) for r in rows if r["doc_id"] == 1] == [(3, 2)]
    assert {r["text"] for r in rows if r["doc_id"] == 1} == {"own line a"}
    assert [r["text"] for r in got.collect() if r["doc_id"] == 3] == [None]
    assert got.count() == len(ROWS)
    assert lines.drop_boilerplate(nothing).collect() == []


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame(
        [(1, " ".join(PROSE.split()[:12])), (2, "OWN Line, b!"), (3, ""), (4, None), (5, "never there"), (2, "own line b")],
        "item_id long, text string",
    ).withColumn("window", F.lit(1))
    got = decontaminate.report(docs, items)
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert [(r["n_words"], r["n_hit"], r["n_items"]) for r in by[1]] == [(20, 12, 1)]
    assert {(r["n_words"], r["n_hit"], r["n_items"]) for r in by[2]} == {(20, 15, 2)}
    assert by[2][0]["items_sha256"] == hashlib.sha256(b"1,2").hexdigest()
    assert by[3][0]["n_words"] == 0 and not by[3][0]["contaminated"]
    assert by[3][0]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"]) == [3, 4, 5, 6, 6, 7]
    assert decontaminate.clean(docs, items.limit(0)).count() == len(ROWS)
    assert decontaminate.report(nothing, items).collect() == []


def test_decontamination_by_shuffle_gives_the_same(spark, docs, monkeypatch):
    items = spark.createDataFrame([(1, PROSE), (2, "own line b")], "item_id long, text string")
    small = pairs(decontaminate.report(docs, items), "doc_id", "n_hit", "n_items")
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert pairs(decontaminate.report(docs, items), "doc_id", "n_hit", "n_items") == small


def test_toxicity(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (6, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model)
    assert got.count() == len(ROWS) and set(CLASHES) <= set(got.columns)
    rows = got.collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1  # null and empty alike
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    untaught = toxicity.drop_toxic(docs, labels.limit(0))
    assert untaught.count() == len(ROWS)
    assert toxicity.score(nothing, model).collect() == []


def test_secrets(docs, nothing):
    got = secrets.scan(docs)
    assert got.count() == len(ROWS) and set(CLASHES) <= set(got.columns)
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in got.collect() if not r["text"]} == {empty}
    assert secrets.scan(nothing).collect() == []


def test_jaccard(docs, nothing):
    got = jaccard.classes(docs)
    assert got.count() == len(ROWS)
    by = {}
    for r in got.collect():
        by.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    assert by[1] == {(16, 1)} and by[2] == {(16, 1)}
    assert by[3] == {(0, 3)} and by[4] == {(0, 4)} and by[5] == {(0, 5)}
    assert {c for _, c in by[6]} == {6}
    left = jaccard.first_of_group(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} >= {1, 3, 4, 5, 6, 7, None}
    assert jaccard.classes(nothing).collect() == []


def test_neighbours(spark):
    rows = [
        (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (40, [1.0, 0.0]), (40, [1.0, 0.0]), (9, [-1.0, 0.0]),
        (None, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = neighbours.search(df, F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.orderBy("query_id", "rank").collect()] == [
        (20, 1, 40, 1.0), (20, 2, 1, 0.5), (20, 3, 2, 0.5), (20, 4, 9, -1.0),
        (40, 1, 20, 1.0), (40, 2, 1, 0.5), (40, 3, 2, 0.5), (40, 4, 9, -1.0),
    ]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_html(spark):
    long = "<article>" + "".join(f"<p>Paragraph {i} has words.</p>" for i in range(3000)) + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain text &amp; more"), (4, "u", long), (4, "u", long), (None, None, "<p")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit(1))
    model = htmltext.train(df.limit(0))
    got = htmltext.extract(df, model)
    assert got.count() == len(rows) and {"page_id", "url", "path", "text", "n_chars"} == set(got.columns)
    assert [(r["text"], r["n_chars"]) for r in got.collect() if r["page_id"] in (1, 2)] == [("", 0)] * 2
    usual = "<nav><a href=x>menu words</a></nav><article><h1>A title</h1><p>Some words of text. More of them.</p></article>"
    taught = [(i, "u", usual.replace("Some", f"Some {i}")) for i in range(40)]
    trained = htmltext.extract(df, htmltext.train(spark.createDataFrame(taught, "page_id long, url string, html string")))
    whole = [r["text"] for r in trained.collect() if r["page_id"] == 4]
    assert whole == ["\n".join(f"Paragraph {i} has words." for i in range(3000))] * 2
    assert htmltext.extract(df.limit(0), model).collect() == []
