"""Language identification by words first, then progressively shorter character n-grams.

A word of the learned vocabulary adds its log frequency in each language; an unseen word adds the
mean log frequency of its longest character n-grams that were seen. The model is counted in Spark
over a bounded sample of training rows; prediction is one map over the documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import held_out

#: Training documents per language, about: those with the smallest id hashes.
DOCS_PER_LANGUAGE = 400
#: Occurrences in the sample that make a word known, and an n-gram.
LEAST_WORDS, LEAST_GRAMS = 2, 3
LONGEST = 5
#: Scores of unseen words a task remembers before it starts afresh.
REMEMBERED = 200_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            out.setdefault(lang, Counter()).update(words(text))
        yield pd.DataFrame([(lang, w, c) for lang, own in out.items() for w, c in own.items()], columns=["lang", "word", "c"])


class Model:
    """Log frequencies of words and n-grams, one row per unit and one column per language.

    ``places[0]`` finds a word's row in ``logs``, ``places[n]`` an n-gram's.
    """

    def __init__(self, langs: list[str], places: list[dict[str, int]], logs: np.ndarray):
        self.langs, self.places, self.logs = langs, places, logs

    @classmethod
    def of(cls, counts: pd.DataFrame) -> Model:
        """From (lang, word, c), every word of the sample."""
        langs = sorted(counts["lang"].unique())
        tables: list[dict[str, list[float]]] = [{} for _ in range(LONGEST + 1)]
        for lang, part in counts.groupby("lang"):
            at = langs.index(lang)
            for w, c in zip(part["word"], part["c"]):
                for n in range(LONGEST + 1):
                    for unit in grams(w, n) if n else (w,):
                        row = tables[n].get(unit)
                        if row is None:
                            row = tables[n][unit] = [0.5] * len(langs)
                        row[at] += c
        places: list[dict[str, int]] = []
        logs = [np.zeros((0, len(langs)), np.float32)]
        before = 0
        for n, rows in enumerate(tables):
            least = (LEAST_GRAMS if n else LEAST_WORDS) + 0.5 * len(langs)
            rows = {u: r for u, r in rows.items() if sum(r) >= least}
            places.append({u: before + i for i, u in enumerate(rows)})
            before += len(rows)
            if rows:
                c = np.array(list(rows.values()))
                part = np.log(c / c.sum(axis=0))
                # Only differences between languages count; a unit all share alike adds nothing.
                logs.append((part - part.mean(axis=1, keepdims=True)).astype(np.float32))
        return cls(langs, places, np.concatenate(logs))

    def backoff(self, unseen: list[str]) -> np.ndarray:
        """Evidence of words that are not known: of each, its longest n-grams that are."""
        flat: list[int] = []
        starts, full = [], []
        for i, word in enumerate(unseen):
            marked, size = f"<{word}>", len(word) + 2
            for n in range(LONGEST, 0, -1):
                get = self.places[n].get
                found = [p for k in range(size - n + 1) if (p := get(marked[k : k + n])) is not None]
                if found:
                    starts.append(len(flat))
                    full.append(i)
                    flat += found
                    break
        out = np.zeros((len(unseen), len(self.langs)), np.float32)
        if flat:
            lengths = np.diff([*starts, len(flat)])[:, None]
            out[full] = np.add.reduceat(self.logs[flat], starts, axis=0) / lengths
        return out


class Predictor:
    """A model and the unseen words a task has scored so far."""

    def __init__(self, model: Model):
        self.model = model
        self.places = dict(model.places[0])
        self.known = len(model.logs)
        self.logs = np.concatenate([model.logs, np.zeros((REMEMBERED, len(model.langs)), np.float32)])
        self.used = self.known

    def learn(self, unseen: list[str]) -> None:
        upto = self.used + len(unseen)
        self.logs[self.used : upto] = self.model.backoff(unseen)
        self.places.update(zip(unseen, range(self.used, upto)))
        self.used = upto

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of the evidence for it); ``und`` and 0 without a letter."""
        counted = Counter(words(text))
        units, langs = list(counted), self.model.langs
        if not "".join(units).isalpha():  # digits and marks of other scripts are no letters
            units = [w for w in units if any(map(str.isalpha, w))]
        if not units or not langs:
            return UNKNOWN, 0.0
        total, seen = np.zeros(len(langs)), 0.0
        for start in range(0, len(units), REMEMBERED):  # a longer text than can be remembered goes in parts
            part = units[start : start + REMEMBERED]
            if self.used + len(part) > len(self.logs):
                self.places, self.used = dict(self.model.places[0]), self.known
            at = list(map(self.places.get, part))
            if None in at:
                self.learn([w for w, p in zip(part, at) if p is None])
                at = list(map(self.places.get, part))
            c = np.fromiter(map(counted.get, part), np.float32, len(part))
            total += c @ self.logs[at]
            seen += float(c.sum())
        # Words of a text depend on each other: evidence grows with the root of their number.
        odds = np.exp((total - total.max()) / np.sqrt(seen))
        best = int(total.argmax())
        return langs[best], float(odds[best] / odds.sum())


def train(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Learn from text and lang of rows that are not held out; rows without either teach nothing."""
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # a row per language
    if not sizes:
        return Model([], [{} for _ in range(LONGEST + 1)], np.zeros((0, 0), np.float32))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    point = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.filter(point < share[F.col("lang")]).select("lang", "text")
    counts = sample.mapInPandas(_count, "lang string, word string, c long").groupBy("lang", "word")
    return Model.of(counts.agg(F.sum("c").alias("c")).orderBy("lang", "word").toPandas())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus lang_pred and score (0 to 1).

    ``docs`` needs text; every column and row stays. Null texts and texts without a letter are
    ``und`` with score 0, and so is everything when nothing could be learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.places, model.logs))  # bounded by the sample

    def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Predictor(Model(*shared.value))
        for texts in batches:
            yield pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = F.pandas_udf(predictions, "lang_pred string, score double")
    return docs.withColumn("__found", found(F.col("text"))).select(
        *[F.col(c) for c in docs.columns if c not in ("lang_pred", "score")], "__found.lang_pred", "__found.score"
    )
