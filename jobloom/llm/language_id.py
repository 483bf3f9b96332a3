"""Language identification by prediction by partial matching (PPM).

For each language a variable-order byte context tree (contexts of 0 to 3 bytes) is counted on a
bounded sample of labelled texts and then frozen. The code length of a byte follows from the longest
context in which it was seen, with an escape for each longer context in which it wasn't (method C:
a context of T symbols, D of them distinct, gives a symbol seen n times n / (T + D) and the escape
D / (T + D)). The language with the shortest code of the whole text wins.

Frozen statistics make the code length a function of the last four bytes. So the tree is laid out as
sorted tables of the four-byte and three-byte strings that were seen in any language, each with its
cost in every language, and dense tables below them. Contexts are of bytes proper, whatever the script;
0xFF, which UTF-8 never has, stands before a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import as_bytes, slices, text_rows

ORDER = 3
EDGE = 0xFF
PIECE = 1 << 20
#: About so many texts of each language are sampled for the counts (by id hash, whole texts).
TRAIN_TEXTS = 250
UNKNOWN = "und"


@dataclass
class PpmModel:
    langs: list[str]
    grams: np.ndarray  # four-byte strings, sorted
    gram_cost: np.ndarray  # bits of the last byte, for each language
    triples: np.ndarray  # three-byte strings, sorted
    triple_cost: np.ndarray  # bits of the last byte after two
    contexts: np.ndarray  # contexts of three bytes, sorted
    context_escape: np.ndarray  # bits to leave them
    pair_cost: np.ndarray  # 2**16 x langs: bits of a byte after one
    pair_escape: np.ndarray  # 2**16 x langs: bits to leave a context of two
    key: str = ""

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language: len(texts) x langs."""
        out = np.zeros((len(texts), len(self.langs)))
        held, owners, size = [], [], 0
        for i, raw in enumerate(texts):
            for at in range(0, len(raw), PIECE):
                before = raw[max(0, at - ORDER) : at]
                held.append((len(before), before + raw[at : at + PIECE]))
                owners.append(i)
                size += len(held[-1][1])
                if size >= PIECE:
                    np.add.at(out, owners, self._score(held))
                    held, owners, size = [], [], 0
        if held:
            np.add.at(out, owners, self._score(held))
        return out

    def costs(self, key: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each four-byte string, for each language."""
        at, known = _find(self.grams, key)
        cost = self.gram_cost[at]
        miss = np.flatnonzero(~known)
        if len(miss):
            k = key[miss]
            at, known = _find(self.triples, k & 0xFFFFFF)
            lower = np.where(known[:, None], self.triple_cost[at], self.pair_escape[(k >> 8) & 0xFFFF] + self.pair_cost[k & 0xFFFF])
            at, known = _find(self.contexts, k >> 8)
            cost[miss] = lower + np.where(known[:, None], self.context_escape[at], 0)
        return cost

    def _score(self, parts: list[tuple[int, bytes]]) -> np.ndarray:
        edge = bytes([EDGE]) * ORDER
        lengths = np.array([len(x) for _, x in parts])
        starts = np.cumsum(lengths + ORDER) - lengths
        raw = np.frombuffer(b"".join(edge + x for _, x in parts), np.uint8).astype(np.uint32)
        key = raw.copy()
        for back in range(1, ORDER + 1):
            key[ORDER:] |= raw[ORDER - back : -back] << np.uint32(8 * back)
        cost = self.costs(key)
        cost[(starts[:, None] - np.arange(1, ORDER + 1)).ravel()] = 0
        for (context, _), at in zip(parts, starts, strict=True):
            cost[at : at + context] = 0  # scored with the piece before
        return np.add.reduceat(cost.astype(np.float64), starts, axis=0)


def _find(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted table, and which of them are there."""
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def fit(langs: list[str], grams: np.ndarray, counts: np.ndarray) -> PpmModel:
    """grams: distinct four bytes as big-endian uint32, sorted, EDGE before a text; counts: len(grams) x langs."""
    n_langs = len(langs)

    def grouped(codes: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(codes, weights=values[:, j], minlength=size) for j in range(n_langs)], 1)

    def level(codes: np.ndarray, n: np.ndarray, lower: np.ndarray, context: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Costs of symbols, and what it costs to leave each context (0 if a language never saw it)."""
        total, distinct = grouped(context, n, size), grouped(context, (n > 0).astype(float), size)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            return np.where(n > 0, -np.log2(n / (total + distinct)[context]), escape[context] + lower), escape

    last = (grams & 0xFF).astype(np.int64)
    cost, _ = level(last, grouped(last, counts, 256), np.full((256, n_langs), 8.0), np.zeros(256, np.int64), 1)
    pairs = np.arange(1 << 16)
    pair_cost, _ = level(pairs, grouped((grams & 0xFFFF).astype(np.int64), counts, 1 << 16), cost[pairs & 0xFF], pairs >> 8, 256)
    triples, at = np.unique(grams & np.uint32(0xFFFFFF), return_inverse=True)
    whole = triples.astype(np.int64)
    triple_cost, pair_escape = level(whole, grouped(at, counts, len(triples)), pair_cost[whole & 0xFFFF], whole >> 8, 1 << 16)
    contexts, of = np.unique(grams >> np.uint32(8), return_inverse=True)
    gram_cost, context_escape = level(grams, counts, triple_cost[at], of, len(contexts))
    digest = hashlib.sha1(grams.tobytes() + counts.tobytes() + "\0".join(langs).encode()).hexdigest()
    small = [x.astype(np.float32) for x in (gram_cost, triple_cost, context_escape, pair_cost, pair_escape)]
    return PpmModel(langs, grams, small[0], triples, small[1], contexts, small[2], small[3], small[4], digest)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        by_lang: dict[str, list[bytes]] = {}
        for lang, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            by_lang.setdefault(lang, []).append(raw)
        for lang, texts in by_lang.items():
            raw = np.frombuffer(b"".join(bytes([EDGE]) * ORDER + x for x in texts), np.uint8).astype(np.uint32)
            gram = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
            grams, n = np.unique(gram[raw[3:] != EDGE], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])


def train(labelled: DataFrame, train_texts: int = TRAIN_TEXTS, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> PpmModel | None:
    """Count and freeze the trees on about train_texts whole texts of each language.

    Rows without a text or a language are no training rows; None if there are none at all. What
    comes to the driver are the distinct four-byte strings of the sample, bounded by its size.
    """
    rows = text_rows(labelled, id_col, text_col, F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null and text != ''")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    if not sizes:
        return None
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1_000_000, -(-train_texts * 1_000_000 // n)))).otherwise(share)
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    found = picked.select("lang", "text").mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:  # the hash took none of very few rows
        found = rows.select("lang", "text").mapInArrow(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    grams, at = np.unique(found["gram"].to_numpy().astype(np.uint32), return_inverse=True)
    counts = np.zeros((len(grams), len(langs)))
    column = {x: j for j, x in enumerate(langs)}
    counts[at, [column[x] for x in found["lang"].to_pylist()]] = found["n"].to_numpy()
    return fit(langs, grams, counts)


_models: dict[str, PpmModel] = {}


def _held(model: PpmModel) -> PpmModel:
    """The copy of a model that this worker keeps."""
    if model.key not in _models:
        _models.clear()
        _models[model.key] = model
    return _models[model.key]


def _judged(ppm: PpmModel, text: pa.Array, lettered: pa.Array) -> tuple[np.ndarray, ...]:
    """Best language, its posterior, its code length, whether there is a letter, and bytes (1 at least)."""
    texts = [raw if ok else b"" for raw, ok in zip(as_bytes(text), lettered.to_pylist(), strict=True)]
    bits = ppm.bits(texts)
    least = bits.min(1)
    sure = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
    return bits.argmin(1), sure, least, np.array([len(x) > 0 for x in texts]), np.array([max(1, len(x)) for x in texts])


def identify(docs: DataFrame, model: PpmModel | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, lang_pred, score, bits_per_byte.

    score is the posterior of the predicted language under equal priors, from the code lengths of
    the whole text; ties go to the name that sorts first. A null text, an empty one and one without
    a letter (Unicode L) get "und" with score 0 and a null bits_per_byte, and so does every text if
    there is no model.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("lettered", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
    frozen = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample and the classes

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = _held(frozen.value)
        for batch in slices(batches, 1):
            best, sure, least, lettered, sizes = _judged(ppm, batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([ppm.langs[j] if ok else UNKNOWN for j, ok in zip(best, lettered, strict=True)]), pa.array(np.where(lettered, sure, 0.0)), pa.array(least / sizes, mask=~lettered)],
                ["doc_id", "lang_pred", "score", "bits_per_byte"],
            )

    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")


def accepted_rows(docs: DataFrame, model: PpmModel | None, min_score: float = 0.5, *, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose language is recognised with a score of min_score or more.

    Null and empty texts and texts without a letter are never recognised; nothing is without a model. Rows are
    independent: repeated rows and ids stay or go alike. Other columns may have any name.
    """
    if model is None:
        return docs.where(F.lit(False))
    frozen, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = _held(frozen.value)
        for batch in slices(batches, at):
            _, sure, _, known, _ = _judged(ppm, batch.column(at), batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], schema=pa.schema(list(batch.schema)[:-1])).filter(pa.array(known & (sure >= min_score)))

    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    flag = "lettered" + "_" * max(map(len, docs.columns))  # longer than any name there
    return docs.select("*", lettered.alias(flag)).mapInArrow(keep, docs.schema)
