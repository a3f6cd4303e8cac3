"""Quality rules and the divergence of a document from its language.

Every language has two reference histograms, counted over all its documents that pass the base
rules: classes of characters, and common words beside all other words. A document whose histograms
are too far from those of its language, by Jensen-Shannon distance, is not kept. Histograms of short
documents are noisy, so distances count only from a least length on.

Common words are those that make up a given share of a language's words. Candidates come from
mergeable counters of bounded size that cannot miss such a word; their counts are exact. References
to the same words are counted again without the documents that are too far from the first ones, so
that junk does not become the norm.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stopwise.llm.common import kept

#: Base rules: least words, and the percentage of words in repeated windows of WINDOW words.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
#: Share of a language's words that makes a word common, and of all words that makes a language.
COMMON, LANGUAGE = 0.002, 0.001
#: Characters and words a document needs for either distance to count.
LEAST_CHARS, LEAST_FOR_WORDS = 300, 150
#: Largest distances (0 to 1) that are kept, and how often references are counted.
MOST_CHARS_APART, MOST_WORDS_APART, ROUNDS = 0.24, 0.36, 3
#: Counters a task holds per language, in units of 1 / COMMON.
COUNTERS = 8

CLASSES = ("lower", "upper", "digit", "space", "mark", "symbol", "other")
MARKS = ".,;:'\"?!-()"
SYMBOLS = frozenset("#*$%&|<>")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters taken off both ends of a word before it is looked up.
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


@lru_cache(1 << 14)
def char_class(c: str) -> int:
    """Place of a character in CLASSES; letters without case are lower."""
    kind = unicodedata.category(c)
    if kind in ("Lu", "Lt"):
        return 1
    if kind[0] in "LM":
        return 0
    if kind[0] == "N":
        return 2
    if c.isspace():
        return 3
    if c in MARKS or (kind[0] == "P" and ord(c) > 126):
        return 4
    return 5 if 32 < ord(c) < 127 or kind[0] == "S" else 6


_ASCII = np.array([char_class(chr(c)) for c in range(128)])


def classes(text: str) -> list[int]:
    """Characters of the whole text by class."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = codes < 128
    out = np.bincount(_ASCII[codes[plain]], minlength=len(CLASSES))
    if not plain.all():
        for code, n in zip(*np.unique(codes[~plain], return_counts=True)):
            out[char_class(chr(code))] += n
    return out.tolist()


def repeated(words: list[str]) -> int:
    """Words inside windows of WINDOW words that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered[i] += 1
            covered[i + WINDOW] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measures(text: str, words: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated(words)


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def plain(words: list[str]) -> list[str]:
    """Words as they are counted: in lower case, without marks around them; bare marks are left out."""
    return [w for w in (x.lower().strip(EDGES) for x in words) if w]


class Frequent:
    """Counts of words by a bounded number of counters (Misra and Gries).

    A count is too low by ``off`` at most, which is less than ``total`` / ``size``.
    """

    def __init__(self, size: int):
        self.size, self.counts, self.total, self.off = size, Counter(), 0, 0

    def add(self, words: list[str]) -> None:
        self.counts.update(words)
        self.total += len(words)
        if len(self.counts) > 4 * self.size:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > self.size:
            values = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            off = int(np.partition(values, len(values) - self.size - 1)[len(values) - self.size - 1])
            self.counts = Counter({w: c - off for w, c in self.counts.items() if c > off})
            self.off += off


def _frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per language: its words' counts, and as a null word how far these are off, with their total."""
    found: dict[str, Frequent] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            words = _WORD.findall(text)
            if not failed(len(words), repeated(words)):
                found.setdefault(lang, Frequent(round(COUNTERS / COMMON))).add(plain(words))
    for lang, own in found.items():
        own.shrink()
        yield pd.DataFrame({"lang": lang, "word": list(own.counts), "n": list(own.counts.values()), "total": 0})
        yield pd.DataFrame({"lang": [lang], "word": [None], "n": [own.off], "total": [own.total]})


def candidates(docs: DataFrame) -> list[str]:
    """Words that may be common in a language that makes up the share LANGUAGE of all words.

    Of a language, 1 / COMMON words and an eighth more at most, and 1 / LANGUAGE languages at most.
    """
    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = usable.mapInPandas(_frequent, "lang string, word string, n long, total long")
    counts = kept(counts.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    langs = counts.filter("word IS NULL").select("lang", F.col("n").alias("off"), "total")
    everything = langs.agg(F.sum("total")).first()[0] or 0
    langs = langs.filter((F.col("total") > 0) & (F.col("total") >= LANGUAGE * everything))
    near = counts.filter("word IS NOT NULL").drop("total").join(F.broadcast(langs), "lang")  # 1 / LANGUAGE rows
    near = near.filter(F.col("n") + F.col("off") >= COMMON * F.col("total"))
    return [r["word"] for r in near.select("word").distinct().orderBy("word").collect()]


def measured(docs: DataFrame, words: list[str], without: tuple[str, ...] = ()) -> DataFrame:
    """A stored table of ``docs`` plus ``__m``: measures, characters by class, counts of ``words``."""
    places = {w: i for i, w in enumerate(words)}

    def one(text: str | None) -> tuple:
        text = text or ""
        found = _WORD.findall(text)
        base = measures(text, found)
        counted = Counter(plain(found))
        known = [(places[w], c) for w, c in counted.items() if w in places]
        return (*base, failed(base[0], base[4]), len(text), classes(text), sum(counted.values()),
                [i for i, _ in known], [c for _, c in known])

    def all_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=_M_NAMES)

    return kept(docs.withColumn("__m", F.pandas_udf(all_of, _M)(F.col("text"))).drop(*without))


_M = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_chars long, classes array<long>, n_plain long, at array<int>, counts array<long>"
)
_M_NAMES = [part.split()[0] for part in _M.split(", ")]


class References:
    """Histograms by language: of classes of characters, and of its common words and all others."""

    def __init__(self, langs: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.langs = langs  # lang -> classes, places of the common words, their counts and the others'

    def distances(self, lang: str | None, chars: list[int], n_plain: int, at: list[int], counts: list[int]):
        """(characters, words) apart from the own language, or from the nearest if it has no reference."""
        own = [self.langs[lang]] if lang in self.langs else list(self.langs.values())
        best = None
        for ref_chars, common, ref_words in own:
            seen = dict(zip(at, counts))
            hist = np.array([seen.get(i, 0) for i in common] + [0], float)
            hist[-1] = n_plain - hist.sum()
            found = (apart(np.array(chars, float), ref_chars), apart(hist, ref_words))
            if best is None or sum(found) < sum(best):
                best = found
        return best


def apart(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms; an empty one is as far as can be."""
    if not a.sum() or not b.sum():
        return 1.0
    a, b = a / a.sum(), b / b.sum()
    middle = (a + b) / 2

    def against(p: np.ndarray) -> float:
        on = p > 0
        return float((p[on] * np.log2(p[on] / middle[on])).sum())

    return float(np.sqrt(max(0.0, (against(a) + against(b)) / 2)))


def references(rows: DataFrame, first: References | None = None) -> References:
    """Count the references over ``rows`` of (lang, __m) that pass the base rules, all of them.

    With ``first``, the languages and common words are those of it.
    """
    usable = rows.filter("lang IS NOT NULL AND NOT __m.base_failed")
    sums = [F.sum(F.col("__m.classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    per = usable.groupBy("lang").agg(F.sum("__m.n_plain").alias("n"), *sums)
    share = F.col("n") / F.sum("n").over(W.partitionBy())  # one row per language
    wanted = F.col("share") >= LANGUAGE if first is None else F.col("lang").isin(list(first.langs))
    langs = {r["lang"]: r for r in per.withColumn("share", share).filter(wanted).collect()}
    pairs = usable.filter(F.col("lang").isin(list(langs))).select("lang", F.explode(F.arrays_zip("__m.at", "__m.counts")).alias("x"))
    counts = pairs.groupBy("lang", F.col("x.at").alias("at")).agg(F.sum("x.counts").alias("n")).orderBy("lang", "at")
    found: dict[str, dict[int, int]] = {lang: {} for lang in langs}
    for r in counts.collect():  # languages x candidates
        found[r["lang"]][r["at"]] = r["n"]
    out = {}
    for lang, row in langs.items():
        common = [i for i, n in found[lang].items() if n >= COMMON * row["n"]] if first is None else first.langs[lang][1]
        words = [found[lang].get(i, 0) for i in common]
        hist = np.array([*words, row["n"] - sum(words)], float)
        chars = np.array([row[f"c{i}"] for i in range(len(CLASSES))], float)
        out[lang] = (chars, np.array(common, int), hist)
    return References(out)


def _verdicts(rows: DataFrame, known: References) -> DataFrame:
    """``rows`` plus ``__d``: (chars_apart, words_apart), each null where the text is too short for it."""

    def all_of(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for langs, m in batches:
            out = []
            for lang, chars, n, plain_words, at, counts, length in zip(
                langs, m["classes"], m["n_words"], m["n_plain"], m["at"], m["counts"], m["n_chars"]
            ):
                found = known.distances(lang, chars, plain_words, at, counts) or (None, None)
                out.append((found[0] if length >= LEAST_CHARS else None, found[1] if n >= LEAST_FOR_WORDS else None))
            yield pd.DataFrame(out, columns=["chars_apart", "words_apart"], dtype=float)

    return rows.withColumn("__d", F.pandas_udf(all_of, "chars_apart double, words_apart double")(F.col("lang"), F.col("__m")))


def near_enough() -> Column:
    """Whether no distance is over its limit; distances that do not count (null) never are."""
    return (F.coalesce(F.col("__d.chars_apart"), F.lit(0.0)) <= MOST_CHARS_APART) & (
        F.coalesce(F.col("__d.words_apart"), F.lit(0.0)) <= MOST_WORDS_APART
    )


OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def judge(docs: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    chars_apart, words_apart and kept.

    ``docs`` needs text and lang; columns named ``without`` are left out of the result, others of
    the same names as the new ones are replaced. A null text has no words, fails and is not kept.
    Distances are null for texts below the least lengths and where there is no reference at all; a
    document of no language, or of one too rare for a reference, is held against the nearest one.
    Repeated rows each count. Without rows there are none.
    """
    rows = measured(docs, candidates(docs), tuple(c for c in without if c != "lang"))
    known = references(rows)
    for _ in range(ROUNDS - 1):
        known = references(_verdicts(rows, known).filter(near_enough()), known)
    new = [*OUT, "chars_apart", "words_apart", "kept"]
    return _verdicts(rows, known).select(
        *[F.col(c) for c in docs.columns if c not in without and c not in new],
        *[F.col(f"__m.{c}") for c in OUT], "__d.chars_apart", "__d.words_apart",
        (~F.col("__m.base_failed") & near_enough()).alias("kept"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns they came with."""
    inner = docs.select(F.struct(*docs.columns).alias("__row"), "text", "lang")
    return judge(inner, ("text", "lang")).filter("kept").select("__row.*")
