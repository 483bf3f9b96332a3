"""Masked pseudo-likelihood scores from a bidirectional window network.

Tokens are lower-cased words. A network sees two tokens on each side of a place and predicts the one in
the middle: h = tanh(sum of E[position, token] + b), then a two-level softmax. Words with a share of
MIN_SHARE or more of all tokens have an output of their own: they are ranked by count and cut into
classes of about the square root of their number, and P(word) = P(class | h) P(word | class, h). All
other words fall into hash buckets, which the first level predicts too; within its bucket a word has the
probability that the counts of all words of the corpus give it, its own occurrence left out
(Witten-Bell; words not seen elsewhere by their bytes). A text's score is the sum of log P over its words.

Training reads every window of the corpus once. Tasks start from the same weights and go through their
texts in minibatches (numpy, AdaGrad); Spark sums the changes of each row of weights over the tasks,
weighted by how often the row was used, and the average starts the next round, which reads other texts.
The counts of rare words stay a Spark table: texts' rare words are joined with it, nothing of them is
gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import as_bytes, slices, stored, text_rows

#: A word with this share of all tokens is told apart by the network; so there are 32,768 such words at most.
MIN_SHARE = 2.0**-15
BUCKETS = 16  # a power of two
AROUND = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 2
MINIBATCH = 16_384
SLICE = 3 << 20  # bytes of text whose windows are laid out at once
KNOWN = 150_000  # rare words whose codes a worker keeps
RATE = 0.05
_RARE = -(1 << 63)
_TOP, _ALL = 1 << 63, 1 << 64
_digest = xxhash.xxh64_intdigest


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of all texts, for each word in order its place among them, and the number of words of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)  # on bytes: A-Z only
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.append(0, edges) if len(inside) and inside[0] else edges
    starts, ends = edges[::2], edges[1::2]  # the last byte is a separator, so every word ends
    offsets = np.append(0, np.cumsum(ends - starts))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
    lengths = np.diff(np.searchsorted(starts, np.append(0, np.cumsum(sizes + 1))))
    return words.dictionary, words.indices.to_numpy(), lengths


def rare_code(word: bytes) -> int:
    """A negative number that stands for a rare word; its lowest bits are the bucket."""
    return (xxhash.xxh64_intdigest(word, seed=42) | 1 << 63) - (1 << 64)


class _Codes(dict):
    """word -> its place among the network's words, or its rare_code."""

    def __init__(self, words: list[bytes]) -> None:
        self.words, self.most = words, len(words) + KNOWN
        super().__init__(zip(words, range(len(words)), strict=True))

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.most:
            self.clear()
            self.update(zip(self.words, range(len(self.words)), strict=True))
        got = self[word] = (_digest(word, 42) | _TOP) - _ALL  # rare_code, without a call for each word
        return got


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: word, n; every word of all texts. Null and empty texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 12 << 20):
            words, at, _ = split_words([raw or b"" for raw in as_bytes(batch.column(0))])
            times = np.bincount(at, minlength=len(words)).astype(np.int64)
            for start in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([words[start : start + 50_000].cast(pa.binary()), pa.array(times[start : start + 50_000])], ["word", "n"])

    return text_rows(docs, id_col, text_col).select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The words that the network tells apart, by falling count (ties by the word), and the tokens of each bucket."""

    words: list[bytes]
    counts: np.ndarray
    bucket_tokens: np.ndarray
    least: int  # words with this count or more are in

    @classmethod
    def of(cls, counted: DataFrame, min_share: float = MIN_SHARE) -> Vocabulary:
        """counted: as word_counts(). min_share bounds the number of words that come to the driver."""
        total = counted.agg(F.sum("n")).first()[0] or 0
        least = max(2, int(np.ceil(total * min_share)))
        rows = counted.where(F.col("n") >= least).orderBy(F.desc("n"), "word").collect()
        tokens = np.zeros(BUCKETS)
        for r in counted.where(F.col("n") < least).groupBy(F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).alias("b")).agg(F.sum("n").alias("n")).collect():  # one row for each bucket
            tokens[r.b] = r.n
        return cls([bytes(r.word) for r in rows], np.array([r.n for r in rows], float), tokens, least)

    @property
    def in_class(self) -> int:
        return max(1, int(np.ceil(np.sqrt(len(self.words)))))

    @property
    def classes(self) -> int:
        return -(-len(self.words) // self.in_class)

    @property
    def ids(self) -> int:
        """Own words, buckets, and the boundary of a text, which is the last id."""
        return len(self.words) + BUCKETS + 1

    def rows(self) -> tuple[int, int, int, int]:
        """First rows of the hidden bias, the first level's outputs, the second level's, and the number of all rows."""
        bias = len(AROUND) * self.ids
        return bias, bias + 1, bias + 1 + self.classes + BUCKETS, bias + 1 + self.classes + BUCKETS + self.classes * self.in_class

    def fresh(self, seed: int = 0) -> np.ndarray:
        """Weights, one row for each input and each output (the last column is its bias), at unigram probabilities."""
        bias, first, second, rows = self.rows()
        table = np.zeros((rows, HIDDEN + 1), np.float32)
        rng = np.random.default_rng(seed)
        table[:bias, :HIDDEN] = rng.normal(0, 0.1, (bias, HIDDEN))
        table[first:, :HIDDEN] = rng.normal(0, 0.1, (rows - first, HIDDEN))
        counts = np.zeros(self.classes * self.in_class)
        counts[: len(self.words)] = self.counts
        by_class = counts.reshape(self.classes, self.in_class).sum(1)
        table[first:second, HIDDEN] = np.log(np.concatenate([by_class, self.bucket_tokens]) + 0.5)
        table[second:, HIDDEN] = np.where(counts > 0, np.log(np.maximum(counts, 1)), -1e4)  # no word: never predicted
        return table


@dataclass
class Windows:
    """The places of some texts: codes of the tokens, the text of each, rows of its inputs, and its output."""

    codes: np.ndarray
    owner: np.ndarray
    inputs: np.ndarray
    output: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], codes: _Codes, vocabulary: Vocabulary) -> Windows:
        words, places, lengths = split_words(texts)
        found = np.fromiter(map(codes.__getitem__, words.to_pylist()), np.int64, len(words))[places]
        ids = np.where(found < 0, len(vocabulary.words) + (found & (BUCKETS - 1)), found)
        owner = np.repeat(np.arange(len(texts)), lengths)
        edge = max(AROUND)
        line = np.full(len(ids) + edge * (len(texts) + 1), vocabulary.ids - 1, np.int32)
        at = np.arange(len(ids)) + edge * (owner + 1)
        line[at] = ids
        inputs = np.stack([line[at + step] + i * vocabulary.ids for i, step in enumerate(AROUND)])
        return cls(found, owner, inputs, ids)


class WindowNetwork:
    def __init__(self, vocabulary: Vocabulary, table: np.ndarray) -> None:
        self.v, self.table = vocabulary, table

    def run(self, inputs: np.ndarray, output: np.ndarray, grad: np.ndarray | None = None) -> np.ndarray:
        """log P of each output. Sums the gradient of -log P into grad (like the table) if it is given."""
        bias, first, second, _ = self.v.rows()
        n_words, size, classes, n = len(self.v.words), self.v.in_class, self.v.classes, len(output)
        if not n:
            return np.zeros(0)
        order = np.argsort(output, kind="stable")  # by class, so that each class is one block of rows
        inputs, output = inputs[:, order], output[order]
        pre = self.table[inputs[0], :HIDDEN] + self.table[bias, :HIDDEN]
        for row in inputs[1:]:
            pre += self.table[row, :HIDDEN]
        h = np.ones((n, HIDDEN + 1), pre.dtype)
        h[:, :HIDDEN] = np.tanh(pre)
        own = int(np.searchsorted(output, n_words))
        target = np.where(output < n_words, output // size, output - n_words + classes)
        place = np.arange(n)

        def softmax(rows: np.ndarray, weights: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            z, at = rows @ weights.T, place[: len(rows)]
            if z.max() > 60:  # else no exponential overflows
                z -= z.max(1, keepdims=True)
            lp = z[at, wanted]
            np.exp(z, z)
            total = z.sum(1)
            if grad is not None:
                z *= (1 / total)[:, None]
                z[at, wanted] -= 1
            return lp - np.log(total), z

        top = self.table[first:second]
        log_p, d_z = softmax(h, top, target)
        if grad is not None:
            grad[first:second] += d_z.T @ h
            d_h = d_z @ top[:, :HIDDEN]
        ends = np.searchsorted(output[:own], np.arange(classes + 1) * size)
        for c in range(classes):
            rows = slice(ends[c], ends[c + 1])
            if ends[c] < ends[c + 1]:
                at = slice(second + c * size, second + (c + 1) * size)
                lp, d_z = softmax(h[rows], self.table[at], output[rows] - c * size)
                log_p[rows] += lp
                if grad is not None:
                    grad[at] += d_z.T @ h[rows]
                    d_h[rows] += d_z @ self.table[at, :HIDDEN]
        if grad is not None:
            d_h *= 1 - h[:, :HIDDEN] ** 2
            grad[bias, :HIDDEN] += d_h.sum(0)
            flat = inputs.ravel().astype(np.intp)  # bincount's own types, or each call would convert all of them
            for j, weights in enumerate(np.ascontiguousarray(d_h.T, np.float64)):
                grad[:bias, j] += np.bincount(flat, weights=np.tile(weights, len(AROUND)), minlength=bias)
        given = np.empty_like(log_p)
        given[order] = log_p
        return given


_WEIGHTS = [f"w{i}" for i in range(HIDDEN + 1)]


def _round(docs: DataFrame, vocabulary: Vocabulary, table: np.ndarray) -> tuple[np.ndarray, float, int]:
    """One pass over docs (doc_id, text): the averaged weights, the summed loss, and the number of tokens."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, table))  # bounded by MIN_SHARE

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, start = sent.value
        codes, net, bias = _Codes(vocab.words), WindowNetwork(vocab, start.copy()), vocab.rows()[0]
        squares, grad, used = np.ones_like(start), np.zeros_like(start), np.zeros(len(start), np.int64)
        loss, tokens, step = 0.0, 0, np.empty_like(start)
        for batch in slices(batches, 1, SLICE):
            some = Windows.of([raw or b"" for raw in as_bytes(batch.column(1))], codes, vocab)
            order = np.random.default_rng(0).permutation(len(some.output))
            for at in range(0, len(order), MINIBATCH):
                rows = order[at : at + MINIBATCH]
                grad[:] = 0
                loss -= float(net.run(some.inputs[:, rows], some.output[rows], grad).sum(dtype=np.float64))
                squares += np.multiply(grad, grad, out=step)
                grad *= np.float32(RATE)
                net.table -= np.divide(grad, np.sqrt(squares, out=step), out=step)
                used[:bias] += np.bincount(some.inputs[:, rows].ravel(), minlength=bias)
            used[bias:] += len(order)
            tokens += len(order)
        rows = np.flatnonzero(used)
        change = (net.table[rows].astype(float) - start[rows]) * used[rows][:, None]
        columns = [np.append(rows, -1), np.append(used[rows], tokens), *np.vstack([change, np.full((1, HIDDEN + 1), loss)]).T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["row", "used", *_WEIGHTS])

    schema = ", ".join(["row long", "used long", *(f"{w} double" for w in _WEIGHTS)])
    got = docs.mapInArrow(descend, schema).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("used", *_WEIGHTS))).toArrow()
    row, used = got["row"].to_numpy(), got["used"].to_numpy()
    change = np.stack([got[w].to_numpy() for w in _WEIGHTS], 1) if len(row) else np.zeros((0, HIDDEN + 1))
    told = row < 0
    table = table.copy()
    table[row[~told]] += (change[~told] / used[~told][:, None]).astype(np.float32)
    sent.unpersist()
    return table, float(change[told, 0].sum()), int(used[told].sum())


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, list[float]]:
    """Weights after every text was read once, and each round's mean loss of a token before it was learnt from.

    A round reads the texts whose id's hash falls to it (null ids to the first).
    """
    table, losses = vocabulary.fresh(), []
    rows = text_rows(docs, id_col, text_col)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(rounds))
    for r in range(rounds):
        table, loss, tokens = _round(rows.where(part == r), vocabulary, table)
        losses.append(loss / max(1, tokens))
    return table, losses


def network_scores(docs: DataFrame, vocabulary: Vocabulary, table: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_tokens, network (summed log P of words and buckets), codes, times (rare words and how often they occur)."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, table))  # bounded by MIN_SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, weights = sent.value
        codes, net = _Codes(vocab.words), WindowNetwork(vocab, weights)
        for batch in slices(batches, 1, SLICE):
            n = batch.num_rows
            some = Windows.of([raw or b"" for raw in as_bytes(batch.column(1))], codes, vocab)
            lp = np.empty(len(some.output))
            for at in range(0, len(lp), 2 * MINIBATCH):
                here = slice(at, at + 2 * MINIBATCH)
                lp[here] = net.run(some.inputs[:, here], some.output[here])
            rare = some.codes < 0
            owner, code = some.owner[rare], some.codes[rare]
            order = np.argsort(code)
            order = order[np.argsort(owner[order], kind="stable")]
            owner, code = owner[order], code[order]
            new = np.append(True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])) if len(code) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            times = np.diff(np.append(starts, len(code)))
            ends = pa.array(np.searchsorted(owner[starts], np.arange(n + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.bincount(some.owner, minlength=n).astype(np.int64)), pa.array(np.bincount(some.owner, weights=lp, minlength=n).astype(float)),
                    pa.ListArray.from_arrays(ends, pa.array(code[starts])), pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                ],
                ["doc_id", "n_tokens", "network", "codes", "times"],
            )

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, network double, codes array<long>, times array<int>")


def rare_words(counted: DataFrame, least: int) -> DataFrame:
    """Columns: code, log_p: log P(word | bucket) of every rare word, one occurrence left out. counted: as word_counts()."""
    rare = counted.where(F.col("n") < least).select(F.xxhash64("word").bitwiseOR(F.lit(_RARE)).alias("code"), F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).alias("bucket"), F.length("word").alias("size"), "n")
    buckets = rare.groupBy("bucket").agg(F.sum("n").alias("tokens"), F.count("*").alias("types"))
    rows = rare.join(F.broadcast(buckets), "bucket")  # one row for each bucket
    others, tokens = F.col("n") - 1, F.col("tokens") - 1
    types = F.col("types") - (others == 0).cast("int")
    spelt = F.least(F.lit(0.0), F.lit(float(np.log(BUCKETS))) - F.lit(float(np.log(257))) * (F.col("size") + 1))  # 256 bytes and the end
    seen = F.log((others + types * F.exp(spelt)) / (tokens + types))
    unseen = spelt + F.when(types > 0, F.log(types / (tokens + types))).otherwise(0.0)
    return rows.select("code", F.when(others > 0, seen).otherwise(unseen).alias("log_p"))


def score(docs: DataFrame, counted: DataFrame, vocabulary: Vocabulary, table: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_tokens, log_likelihood, mean_log_likelihood.

    A null or empty text and one without a word have no tokens, the sum 0 and a null mean. Rows are
    independent: repeated ones give repeated results, null ids are scored like others.
    """
    # Row numbers hold only for one run of the scan, so they are stored with the scores.
    scored = stored(network_scores(docs, vocabulary, table, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()), "scores")
    words = scored.select("row", F.explode(F.arrays_zip("codes", "times")).alias("x")).select("row", "x.codes", "x.times")
    # A rare word has less than MIN_SHARE of all tokens, so no key of this join is hot.
    inside = words.join(rare_words(counted, vocabulary.least), F.col("codes") == F.col("code")).groupBy("row").agg(F.sum(F.col("times") * F.col("log_p")).alias("inside"))
    total = F.col("network") + F.coalesce("inside", F.lit(0.0))
    found = scored.select("row", "doc_id", "n_tokens", "network").join(inside, "row", "left")
    return found.select("doc_id", "n_tokens", total.alias("log_likelihood"), F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on all texts and score them; columns as score(). An empty table gives no rows."""
    counted = stored(word_counts(docs, id_col=id_col, text_col=text_col), "counts")
    vocabulary = Vocabulary.of(counted)
    table, _ = train(docs, vocabulary, rounds, id_col=id_col, text_col=text_col)
    return score(docs, counted, vocabulary, table, id_col=id_col, text_col=text_col)
