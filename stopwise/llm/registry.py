"""The training-data operators as queries over the given tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import (
    decontaminate, divergence, htmltext, jaccard, language, lines, mixing, neighbours, secrets, substrings, toxicity, trie,
    whitening,
)
from stopwise.llm.common import held_out, table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20, among all others."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes of it."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.select("doc_id", "text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of long strings that occur more than once."""
    left = substrings.dedup(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate on its source."""
    kept = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select(
        "doc_id", "source", "n_lines", "n_removed", F.sha2(text.cast("binary"), 256).alias("kept_sha256")
    )


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages, htmltext.train(pages))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark words and items it holds."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rated = toxicity.score(docs, model)
    return rated.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the group of near copies it belongs to."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the base rules' counts and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = divergence.judge(docs, without=("text", "lang"))
    return judged.select("doc_id", *divergence.OUT, "kept")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations' prefix trie."""
    return trie.trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the leading components of all, whitened."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).drop("deviation_exact")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_substrings": op4_substrings,
    "op5_line_dedup": op5_line_dedup,
    "op6_html": op6_html,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_secrets": op9_secrets,
    "op10_jaccard": op10_jaccard,
    "op11_divergence": op11_divergence,
    "op12_trie": op12_trie,
    "op13_whitening": op13_whitening,
}

_SPACE = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    "op2_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_SPACE}')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), s AS (
  SELECT source, sum(size) AS z, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM d GROUP BY source
), w AS (
  SELECT *, ((no - 1) % 3) + 1 AS weight, 3 * z AS cap, sum(z) OVER () AS total FROM s
), sorted AS (
  SELECT *, coalesce(sum(cap) OVER o, 0) AS capped, coalesce(sum(weight) OVER o, 0) AS spent,
         sum(weight) OVER () AS weights
  FROM w WINDOW o AS (ORDER BY cap * 1.0 / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT total - capped AS free, weights - spent AS per FROM sorted
  WHERE (total - capped) * weight <= cap * (weights - spent)
  ORDER BY cap * 1.0 / weight, no LIMIT 1
), t AS (
  SELECT w.*, CASE WHEN level.free * weight > cap * level.per THEN CAST(cap AS DOUBLE)
              ELSE CAST(level.free AS DOUBLE) * weight / CAST(level.per AS DOUBLE) END AS target
  FROM w LEFT JOIN level ON true
), placed AS (
  SELECT d.doc_id, d.size, t.z, t.target, CAST(round(t.target) AS BIGINT) AS prefix,
         coalesce(sum(d.size) OVER (PARTITION BY t.no ORDER BY d.h, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, CAST(z AS BIGINT) AS source_size, target,
       CAST(greatest(0, least(size, prefix - o)) + greatest(0, least(size, prefix - z - o))
            + greatest(0, least(size, prefix - 2 * z - o)) AS BIGINT) AS taken
FROM placed""",
    "op5_line_dedup": f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents
), pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source
), gone AS (
  SELECT l.source, trim(line, ' ') AS line FROM l JOIN pages ON l.source IS NOT DISTINCT FROM pages.source
  WHERE trim(line, ' ') <> '' GROUP BY l.source, trim(line, ' '), n
  HAVING count(DISTINCT doc_id) >= {lines.LEAST_PAGES} AND count(DISTINCT doc_id) > n * {lines.RATIO!r}::DOUBLE
), kept AS (
  SELECT doc_id, count(gone.line) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE gone.line IS NULL) AS text
  FROM l LEFT JOIN gone ON l.source IS NOT DISTINCT FROM gone.source AND trim(l.line, ' ') = gone.line
  GROUP BY doc_id
)
SELECT d.doc_id, d.source, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines,
       coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(CASE WHEN n_removed > 0 THEN coalesce(kept.text, '') ELSE d.text END, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)""",
    "op10_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (h)
                        WHERE x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.b AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) r ON r.a = d.doc_id""",
    "op7_decontamination": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, w[i : i + least(10, len(w)) - 1] AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), hit AS (
  SELECT doc_id, i, k, item_id
  FROM (SELECT doc_id, i, s.k, w[i : i + s.k - 1] AS win FROM places CROSS JOIN (SELECT DISTINCT k FROM windows) s
        WHERE i + s.k - 1 <= len(w)) p JOIN windows USING (k, win)
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(x.n, 0) AS n_items,
       sha256(coalesce(x.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items x USING (doc_id)""",
    "op12_trie": r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(struct_pack(role := role, text := text)
                       ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id
), crc AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''),
           lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END),
         4294967295) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM crc o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), members AS (
  SELECT conv_id, turns[1:d] AS path, d, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ids
  FROM members GROUP BY path, d
), children AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2
), counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children,
         CASE WHEN n.d > 0 THEN (n_convs - 1) * len(regexp_extract_all(n.path[n.d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN children c ON c.path = n.path AND c.d = n.d
), below AS (
  SELECT path[1:k] AS path, k AS d, sum(saved) AS saved, sum(CAST(n_children = 0 AS INTEGER)) AS leaves
  FROM (SELECT path, saved, n_children, unnest(range(0, d + 1)) AS k FROM counted) GROUP BY 1, 2
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(c.ids, '')) AS ends_sha256
FROM counted c JOIN below b ON b.path = c.path AND b.d = c.d
LEFT JOIN counted p ON c.d > 0 AND p.d = c.d - 1 AND p.path = c.path[1:c.d - 1]""",
}


def _divergence_sql(rounds: int = 3) -> str:
    """The base rules, and ``rounds`` counts of the references, each without what was far from the last."""
    edges = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
    kinds = {
        "upper": r"[\p{Lu}\p{Lt}]", "lower": r"[\p{Ll}\p{Lm}\p{Lo}\p{M}]", "digit": r"\p{N}",
        "space": r"[\p{Z}\x09-\x0D\x1C-\x1F\x85]", "mark": r"[.,;:''\"?!()\x2D]|[^\x00-\x7F\P{P}]",
        "symbol": r"[#$%&*+/<=>@\[\\\]^_`{|}~]|[^\x00-\x7F\P{S}]",
    }
    counted = ", ".join(f"len(regexp_extract_all(text, '{k}')) AS {n}" for n, k in kinds.items())
    parts = [rf"""
d AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_SPACE}') GROUP BY 1
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n
  FROM (SELECT doc_id, i, w[i : i + 4] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d))
), again AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2), (3), (4)) ks(k) WHERE n > 1 GROUP BY 1
), base AS (
  SELECT d.doc_id, lang, text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
         len(w) < 10 OR 100 * coalesce(again.n, 0) > 20 * len(w) AS base_failed, length(text) AS n_chars
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN again USING (doc_id)
), chars AS (
  UNPIVOT (SELECT *, n_chars - upper - lower - digit - space - mark - symbol AS other
           FROM (SELECT doc_id, n_chars, {counted} FROM base))
  ON upper, lower, digit, space, mark, symbol, other INTO NAME unit VALUE n
), plain AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, trim(lower(unnest(w)), '{edges}') AS word FROM d) WHERE word <> '' GROUP BY 1, 2
), sizes AS (SELECT doc_id, sum(n) AS n FROM plain GROUP BY 1
), totals AS (
  SELECT lang, sum(n) AS n FROM base JOIN sizes USING (doc_id) WHERE NOT base_failed AND lang IS NOT NULL GROUP BY 1
), common AS (
  SELECT lang, word FROM base JOIN plain USING (doc_id) WHERE NOT base_failed AND lang IS NOT NULL GROUP BY 1, 2
  HAVING sum(n) >= 0.002::DOUBLE * (SELECT n FROM totals t WHERE t.lang = base.lang)
     AND (SELECT n FROM totals t WHERE t.lang = base.lang) >= 0.001::DOUBLE * (SELECT sum(n) FROM totals)
), langs AS (SELECT DISTINCT lang FROM common
), sides AS (
  SELECT b.doc_id, l.lang AS ref FROM base b JOIN langs l ON l.lang = b.lang OR b.lang IS NULL
    OR b.lang NOT IN (SELECT lang FROM langs)
), known AS (
  SELECT s.doc_id, s.ref, p.word AS unit, p.n FROM sides s JOIN plain p USING (doc_id) JOIN common c ON c.lang = s.ref AND c.word = p.word
), words AS (
  SELECT * FROM known UNION ALL
  SELECT s.doc_id, s.ref, '' AS unit, coalesce(z.n, 0) - coalesce(k.n, 0)
  FROM sides s LEFT JOIN sizes z USING (doc_id)
  LEFT JOIN (SELECT doc_id, ref, sum(n) AS n FROM known GROUP BY 1, 2) k ON k.doc_id = s.doc_id AND k.ref = s.ref
), hist AS (
  SELECT 'words' AS kind, doc_id, ref, unit, n FROM words WHERE n > 0 UNION ALL
  SELECT 'chars', doc_id, ref, unit, n FROM sides JOIN chars USING (doc_id) WHERE n > 0
), shares AS (
  SELECT kind, doc_id, ref, unit, n, n * 1.0::DOUBLE / sum(n) OVER (PARTITION BY kind, doc_id, ref) AS p FROM hist
), near0 AS (SELECT doc_id FROM base)"""]
    for k in range(1, rounds + 1):
        parts.append(f"""
ref{k} AS (
  SELECT kind, ref, unit, sum(n) * 1.0::DOUBLE / sum(sum(n)) OVER (PARTITION BY kind, ref) AS q
  FROM hist JOIN base b USING (doc_id) WHERE b.lang = ref AND NOT base_failed AND doc_id IN (SELECT doc_id FROM near{k - 1})
  GROUP BY 1, 2, 3
), apart{k} AS (
  SELECT kind, doc_id, ref, sqrt(greatest(0, (sum(p * log2(2 * p / (p + coalesce(q, 0))))
           + sum(coalesce(q * log2(2 * q / (p + q)), 0)) + 1 - sum(coalesce(q, 0))) / 2)) AS far
  FROM shares LEFT JOIN ref{k} USING (kind, ref, unit) GROUP BY 1, 2, 3
), best{k} AS (
  SELECT doc_id, chars_far, words_far FROM (
    SELECT s.doc_id, coalesce(c.far, 1) AS chars_far, coalesce(w.far, 1) AS words_far,
           row_number() OVER (PARTITION BY s.doc_id ORDER BY coalesce(c.far, 1) + coalesce(w.far, 1), s.ref) AS nth
    FROM sides s LEFT JOIN apart{k} c ON c.kind = 'chars' AND c.doc_id = s.doc_id AND c.ref = s.ref
    LEFT JOIN apart{k} w ON w.kind = 'words' AND w.doc_id = s.doc_id AND w.ref = s.ref) WHERE nth = 1
), near{k} AS (
  SELECT b.doc_id FROM base b LEFT JOIN best{k} USING (doc_id)
  WHERE (n_chars < 300 OR coalesce(chars_far, 0) <= 0.24) AND (n_words < 150 OR coalesce(words_far, 0) <= 0.36)
)""")
    return f"""WITH {",".join(parts)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id IN (SELECT doc_id FROM near{rounds}) AS kept
FROM base"""


ORACLES["op11_divergence"] = _divergence_sql()
