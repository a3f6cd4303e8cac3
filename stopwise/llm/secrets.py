"""Secret scans: fixed patterns, and a guess-cost search over values in a credential context.

The guess cost of a value is the least total over all ways to cut it into words, dates, repeats,
keyboard walks and brute-force characters, each piece costing the logarithm of the guesses an
attacker needs for it. Values that cost enough, in all and per character, are secrets: names put
together from words are long, but cheap for their length. Words are ranked by how common they are,
in a short list of passwords' parts, in a public vocabulary and in the whole corpus.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import kept

# The base patterns and the least length of what each must hold.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# End of fixed values.

KINDS = ("assign", "access", "hex", "guess")

#: Where a value is taken for a credential, and the value: no blanks, quotes or separators.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|bearer|api[_-]?key|access[_-]?key|private[_-]?key)"
    r"[\"']?[\x20\t]*[:=][\x20\t]*[\"']?([^\s\"'<>,;]{8,})",
    re.I | re.A,
)
#: A value whose cheapest guess takes at least 10 to this many tries, and to this many per character,
#: is a secret.
LEAST_LOG10, LEAST_PER_CHAR = 10.0, 0.8
#: Longest unit of a repeat.
LONGEST_UNIT = 12
#: A public vocabulary whose ids follow the words' frequency; words are taken from it where it is there.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: How often a word must occur in the corpus to be learned, and how many ranks it gives at most.
LEAST_COUNT, LEARNED = 5, 20_000

#: Common password parts, most common first: a part's rank is its number of guesses.
WORDS = (
    "password pass admin welcome login letmein master dragon monkey shadow sunshine princess football "
    "baseball iloveyou love hello secret token key user root test guest default change changeme access "
    "super system server service database backup public private local host example sample demo temp "
    "company office home work summer winter spring autumn monday friday january october december "
    "michael jordan robert daniel thomas andrew joshua ashley jessica charlie george maggie buster "
    "ginger pepper cookie banana orange purple silver golden yellow black white green blue red flower "
    "freedom whatever nothing trust hunter ranger batman superman pokemon starwars computer internet "
    "google apple samsung windows linux the and you for not none null true false your"
).split()
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

_LEET = str.maketrans("4@301!5$7", "aaeoiisst")
_MONTH, _DAY = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"
_YEAR, _DOT = "(?:19|20)[0-9][0-9]", "[-/._]?"
_DATES = [
    re.compile(p)
    for p in (_YEAR, _YEAR + _DOT + _MONTH, _YEAR + _DOT + _MONTH + _DOT + _DAY, _DAY + _DOT + _MONTH + _DOT + _YEAR)
]


def _neighbours() -> set[str]:
    pairs = set()
    for row in (*ROWS, "abcdefghijklmnopqrstuvwxyz", "0123456789"):
        for a, b in zip(row, row[1:]):
            pairs |= {a + b, b + a}
    for upper, lower in zip(ROWS, ROWS[1:]):
        for a, b in zip(upper, lower):
            pairs |= {a + b, b + a}
    return pairs


_NEXT = _neighbours()


def _brute_force(c: str) -> float:
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isascii() and c.isalpha() else 1.5


class Ranks(dict):
    """Ranks of words, 1 for the most common; a word's rank is its number of guesses."""

    def __init__(self, *ordered: Iterable[str]):
        """From lists of words, most common first; a word has its best rank."""
        super().__init__()
        for words in ordered:
            for i, word in enumerate(words):
                self[word] = min(i + 1, self.get(word, i + 1))
        self.measure()
        self.units: dict[str, float] = {}  # costs of units of repeats

    def measure(self) -> None:
        """Take down the lengths words have, from three letters: few, however long the longest is."""
        self.lengths = sorted({n for n in map(len, self) if n > 2})


COMMON = Ranks(WORDS)


def vocabulary(path: str = VOCABULARY) -> list[str]:
    """Whole words of three letters or more, in the order of their ids; none where there is no such file."""
    if not os.path.exists(path):
        return []
    with open(path, encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    whole = (t.removesuffix("</w>") for t in sorted(ids, key=ids.get) if t.endswith("</w>"))
    return [w for w in whole if len(w) > 2 and w.isalpha()]


def learn(docs: DataFrame, path: str = VOCABULARY) -> Ranks:
    """Ranks from the list here, the vocabulary, and the words of all ``docs``, each occurrence counted."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0))).alias("word"))
    counts = kept(
        words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)
        .withColumn("grade", F.floor(8 * F.log2("n")))
    )
    # Grades that hold the most common words are found first, so that each task hands few words on.
    left, least = LEARNED, 0
    for row in counts.groupBy("grade").agg(F.count("*").alias("words")).orderBy(F.desc("grade")).collect():  # under 512
        left, least = left - row["words"], row["grade"]
        if left <= 0:
            break
    common = counts.filter(F.col("grade") >= least).orderBy(F.desc("n"), "word").limit(LEARNED)
    learned = [r["word"] for r in common.collect()]
    return Ranks(WORDS, vocabulary(path), learned)


class _Starts:
    """Starts of one kind of piece that may still begin the cheapest one: cost up to them plus the
    logarithm of the piece's length. Later starts must be dearer to be worth an earlier one."""

    def __init__(self):
        self.found: list[tuple[float, int]] = []

    def add(self, cost: float, start: int) -> None:
        while self.found and self.found[-1][0] >= cost:
            self.found.pop()
        self.found.append((cost, start))

    def least(self, end: int) -> float:
        """The cheapest; a start that does not beat the first one now never will."""
        if not self.found:
            return math.inf
        cost, start = self.found[0]
        low = first = cost + math.log10(end - start)
        kept = [self.found[0]]
        for cost, start in self.found[1:]:
            own = cost + math.log10(end - start)
            if own < first:
                kept.append((cost, start))
                low = min(low, own)
        self.found = kept
        return low


def guess_cost(value: str, ranks: Ranks = COMMON) -> float:
    """log10 of the guesses the cheapest segmentation of ``value`` takes.

    Pieces: a word of ``ranks`` (0.3 more where case or digits for letters disguise it), a date, a
    unit of up to LONGEST_UNIT characters twice or more (one character: three times), a walk of
    three neighbouring keys or more, one character by brute force. Every start of every piece is
    tried; time grows with the length of the value, not with its square.
    """
    size, low = len(value), value.lower()
    low = low if len(low) == size else value
    plain = low.translate(_LEET)
    best = [0.0] + [math.inf] * size
    dates: dict[int, list[int]] = {}
    for start in range(size):
        if value[start].isdigit():
            for end in {m.end() for d in _DATES if (m := d.match(value, start))}:
                dates.setdefault(end, []).append(start)
    walk, walks = 0, _Starts()
    runs = [0] * (LONGEST_UNIT + 1)  # where the run of each period that reaches i began
    repeats: list[dict[int, _Starts]] = [{} for _ in runs]
    for i in range(1, size + 1):
        cost = best[i - 1] + _brute_force(low[i - 1])
        for length in ranks.lengths:
            start = i - length
            if start < 0:
                break
            exact = ranks.get(low[start:i])
            if exact:
                cost = min(cost, best[start] + math.log10(exact + 1) + 0.3 * (value[start:i] != low[start:i]))
            leet = ranks.get(plain[start:i])
            if leet:
                cost = min(cost, best[start] + math.log10(leet + 1) + 0.3 * (value[start:i] != plain[start:i]))
        for start in dates.get(i, ()):
            cost = min(cost, best[start] + math.log10(365 * 100))
        if i > 1 and low[i - 2 : i] not in _NEXT:
            walk, walks = i - 1, _Starts()
        if i - 3 >= walk:
            walks.add(best[i - 3], i - 3)
            cost = min(cost, walks.least(i) + math.log10(50))
        for period in range(1, min(LONGEST_UNIT, i - 1) + 1):
            if low[i - 1] != low[i - 1 - period]:
                runs[period] = i - period
                repeats[period] = {}
                continue
            start = i - max(3, 2 * period)
            if start >= runs[period]:
                starts = repeats[period].setdefault(i % period, _Starts())
                starts.add(best[start], start)
                unit = low[i - period : i]
                cost = min(cost, starts.least(i) - math.log10(period) + _unit_cost(unit, ranks))
        best[i] = cost
    return best[size]


def _unit_cost(unit: str, ranks: Ranks) -> float:
    """Cost of a unit by itself; units of a long value come again and again."""
    if len(unit) == 1:
        return _brute_force(unit)
    if unit not in ranks.units:
        if len(ranks.units) > 100_000:
            ranks.units.clear()
        ranks.units[unit] = guess_cost(unit, ranks)
    return ranks.units[unit]


def is_secret(value: str, ranks: Ranks = COMMON, least: float = LEAST_LOG10) -> bool:
    return guess_cost(value, ranks) >= max(least, LEAST_PER_CHAR * len(value))


_HEX_MARKS = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(" ") for b in range(256))
_HEX_RUN = b"h" * LEAST_HEX
_KEYS = (b"pass", b"pwd", b"secret", b"token", b"cred", b"auth", b"bearer", b"key")


def _may_assign(text: str, raw: bytes) -> bool:
    """Whether a separator and the start of a credential's name occur at all."""
    if ":" not in text and "=" not in text:
        return False
    low = raw.lower()
    return any(k in low for k in _KEYS)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns: leftmost matches, the short ones dropped."""
    return _spans(text, 0)[0]


def guessed_spans(text: str, least: float = LEAST_LOG10, ranks: Ranks = COMMON) -> list[tuple[int, int, int]]:
    """(start, 3, end) of values in a credential context that are hard enough to guess."""
    return _spans(text, least, ranks)[1]


def _spans(text: str, least: float = LEAST_LOG10, ranks: Ranks = COMMON) -> tuple[list, list]:
    raw = text.encode("utf-8", "surrogatepass")
    base, more = [], []
    if _may_assign(text, raw):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
        more += [(m.start(1), 3, m.end(1)) for m in CONTEXT.finditer(text) if is_secret(m.group(1), ranks, least)]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if _HEX_RUN in raw.translate(_HEX_MARKS):
        base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(base), more


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in sorted(spans))


def scan(docs: DataFrame, ranks: Ranks | None = None) -> DataFrame:
    """``docs`` plus n_assign, n_access, n_hex, n_guess, base_sha256 and spans.

    ``docs`` needs text; every column and row stays, repeated rows included. Positions count code
    points, ends are exclusive. A null text is an empty one and has no spans. ``ranks`` are learned
    from ``docs`` unless given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(learn(docs) if ranks is None else ranks))  # bounded lists

    def scans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Ranks(())
        own.update(shared.value)
        own.measure()
        for texts in batches:
            rows = []
            for text in texts:
                base, more = _spans(text or "", LEAST_LOG10, own)
                kinds = [k for _, k, _ in base]
                rows.append(
                    (
                        kinds.count(0), kinds.count(1), kinds.count(2), len(more),
                        hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + more),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    kind = "n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"
    found = F.pandas_udf(scans, kind)
    names = [part.split()[0] for part in kind.split(", ")]
    return docs.withColumn("__found", found(F.col("text"))).select(
        *[F.col(c) for c in docs.columns if c not in names], *[F.col(f"__found.{n}") for n in names]
    )
