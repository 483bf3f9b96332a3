"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Every text gets its base counts. Texts that pass the base limits go through a list of further
rules; each rule's cost and selectivity is estimated on a sample, rules are ordered by rejected
share per cost, and a text leaves the cascade at the first rule that rejects it. The verdict is a
conjunction, so the order changes the time it takes and never the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import as_bytes, slices, text_rows

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
SPACES = np.array([9, 10, 11, 12, 13, 32])
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of `width` words found twice or more in the text, the first included."""
    if len(words) <= width:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    span, at, h = 1, 0, (ids + np.uint64(1)) * _ODD[0]
    h ^= h >> np.uint64(31)
    while span < width:  # width is a power of two: windows of twice the span from two of the last
        h = h[:-span] * _ODD[at % 4] + h[span:] * _ODD[(at + 1) % 4]
        h ^= h >> np.uint64(29)
        span, at = span * 2, at + 1
    _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
    if len(times) == len(h):
        return 0
    again = (times > 1)[inverse]
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: len(h)] += again
    edge[width : width + len(h)] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


@dataclass
class Text:
    """One text and what has been counted of it; the further rules read from here."""

    raw: bytes
    words: list[bytes]
    hist: np.ndarray
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int
    n_repeat_words: int

    @classmethod
    def of(cls, raw: bytes) -> Text:
        words = raw.split()  # bytes.split cuts at exactly 0x20 and 0x09-0x0D
        hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        chars = len(raw) - int(hist[0x80:0xC0].sum()) - int(hist[SPACES].sum())
        lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
        return cls(raw, words, hist, chars, int(hist[SYMBOLS].sum()), len(lines), len(lines) - len(set(lines)), repeat_words(words))

    @property
    def base_failed(self) -> bool:
        return len(self.words) < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * len(self.words)


def _symbols(t: Text) -> bool:
    return 10 * t.n_symbols > 3 * len(t.words)


def _word_length(t: Text) -> bool:
    return not 2 * len(t.words) <= t.word_chars <= 40 * len(t.words)


def _dup_lines(t: Text) -> bool:
    return 100 * t.n_dup_lines > 50 * t.n_lines


def _shouting(t: Text) -> bool:
    upper, lower = int(t.hist[65:91].sum()), int(t.hist[97:123].sum())
    return 100 * upper > 70 * (upper + lower)


def _digits(t: Text) -> bool:
    return 100 * int(t.hist[48:58].sum()) > 40 * t.word_chars


_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


def _letterless(t: Text) -> bool:
    return 100 * sum(_LETTER.search(w) is None for w in t.words) > 50 * len(t.words)


def _one_word(t: Text) -> bool:
    return 100 * Counter(t.words).most_common(1)[0][1] > 35 * len(t.words)


def _one_pair(t: Text) -> bool:
    return 100 * Counter(zip(t.words, t.words[1:], strict=False)).most_common(1)[0][1] > 25 * len(t.words)


#: Name and test of each rule; True rejects. All are asked only of texts with MIN_WORDS words or more.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": _symbols, "word_length": _word_length, "dup_lines": _dup_lines, "shouting": _shouting,
    "digits": _digits, "letterless": _letterless, "one_word": _one_word, "one_pair": _one_pair,
}

#: What a rule looks at, in table entries, words or pairs: its cost, counted rather than timed, so that runs agree.
WORK: dict[str, Callable[[Text], int]] = {
    "symbols": lambda t: 1, "word_length": lambda t: 1, "dup_lines": lambda t: 1, "shouting": lambda t: 52,
    "digits": lambda t: 10, "letterless": lambda t: 2 * len(t.words), "one_word": lambda t: 3 * len(t.words), "one_pair": lambda t: 6 * len(t.words),
}

SAMPLE_ROWS = 1000


def first_rejection(t: Text, order: list[str]) -> str | None:
    """The rule that rejects a text, "base" for the base limits, None if it is kept."""
    return "base" if t.base_failed else next((name for name in order if RULES[name](t)), None)


def rule_order(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, *, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Rule names by rejected share per cost (WORK), both estimated on about sample_rows rows, chosen by the id's hash."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = Counter(), Counter()
        for batch in slices(batches, 0):
            texts = [t for raw in as_bytes(batch.column(0)) if not (t := Text.of(raw or b"")).base_failed]
            for name, rule in RULES.items():
                rejected[name] += sum(map(rule, texts))
                spent[name] += sum(map(WORK[name], texts))
        yield pa.RecordBatch.from_arrays([pa.array(list(RULES)), pa.array([spent[x] for x in RULES], pa.int64()), pa.array([rejected[x] for x in RULES], pa.int64())], ["rule", "work", "rejected"])

    rows = text_rows(docs, id_col, text_col)
    share = -(-sample_rows * 1_000_000 // max(1, rows.count()))
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).select("text")
    seen = sample.mapInArrow(probe, "rule string, work long, rejected long").groupBy("rule").agg(F.sum("work").alias("w"), F.sum("rejected").alias("n")).collect()
    gain = {r.rule: r.n / max(r.w, 1) for r in seen}  # as many rows as there are rules
    place = list(RULES)
    return sorted(RULES, key=lambda x: (-gain.get(x, 0.0), place.index(x)))


def quality_rules(docs: DataFrame, order: list[str] | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by.

    A null or empty text has no words, so base_failed. rejected_by names the first rule that
    rejected the text ("base" for the base limits, null if kept); which of several rules comes
    first depends on the order, kept doesn't. Repeated rows give repeated results, an empty table none.
    """
    order = rule_order(docs, id_col=id_col, text_col=text_col) if order is None else order
    if sorted(order) != sorted(RULES):
        raise ValueError("order must name every rule once")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            counts: list[tuple] = []
            for raw in as_bytes(batch.column(1)):
                t = Text.of(raw or b"")
                by = first_rejection(t, order)
                counts.append((len(t.words), t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed, by is None, by))
            cols = list(zip(*counts, strict=True))
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, types, strict=True))], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"])

    return text_rows(docs, id_col, text_col).mapInArrow(judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


def kept_rows(docs: DataFrame, order: list[str] | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose text quality_rules() keeps.

    So null and empty texts go, repeated rows stay or go alike, and other columns may have any name and nulls.
    """
    order = rule_order(docs, id_col=id_col, text_col=text_col) if order is None else order
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            yield batch.filter(pa.array([first_rejection(Text.of(raw or b""), order) is None for raw in as_bytes(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
