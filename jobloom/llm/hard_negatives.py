"""Hard negatives of anchor vectors by a secondary sort of scored pairs.

Anchors are a stated query set, taken in blocks of bounded size; a block is broadcast and scored
against all rows where these lie. Of the pairs that a task sees it keeps those that can still count:
an anchor's best rows of its own label, and the best rows of other labels inside the window of each
positive. Kept pairs are packed into keys (anchor, descending score, id), dealt by anchor and sorted
inside partitions, and one pass over the sorted keys opens a window at each positive and emits
negatives into the windows that are open. A pass holds the open windows of one anchor, never its rows.

Positives are found by the same sort first, since windows follow from them. Before the windows are
searched in all rows, a share of the rows is searched: the scores found there are lower bounds that
all tasks know, so what is shuffled for an anchor hardly grows with the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import cut, scratch_path

#: Bytes of 64-bit components in a block of anchors, at the most (a longer anchor stands alone).
BLOCK_BYTES = 8 << 20
#: Rows that a task scores at once, and anchors of the block scored at once.
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4096, 256
#: From so many partitions on, a share of the rows gives lower bounds first.
BOUND_PARTITIONS, BOUND_SHARE = 16, 8

_LEAST = np.iinfo(np.int64).min
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class _Anchors:
    """A block: distinct rows (id, label, vector), and the windows of each anchor's positives."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray | None = None  # (anchors, positives), both ends inside; low > high: closed
    high: np.ndarray | None = None
    least: np.ndarray | None = None  # by window: negatives below this score can't be among the first


def _valid(batch: pa.RecordBatch, scale: int, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, whether there is an id, labels and integer vectors of the rows that take part.

    floor(scale * x) is taken in doubles, which hold every such integer. Vectors are padded with zeros
    to the given width (the longest one's if None) and cut there: the other side has zeros behind it.
    """
    ids, label, vectors = batch.column(0), batch.column(1), batch.column(2)
    sizes = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    fine = np.asarray(vectors.is_valid()) & np.asarray(label.is_valid())
    fine[row[~np.isfinite(values)]] = False
    width = int(sizes.max(initial=0)) if width is None else width
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    used = (at < width) & fine[row]
    out = np.zeros((len(sizes), width))
    out[row[used], at[used]] = np.floor(scale * values[used])
    has = np.asarray(ids.is_valid())
    plain = pa.compute.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    return plain[fine], has[fine], pa.compute.fill_null(label, 0).to_numpy(zero_copy_only=False)[fine], out[fine]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products. Those that a long can't hold are set to its nearest end."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < 2**24:  # every partial sum is an integer that a float holds
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(b).T, _LEAST + 1, np.iinfo(np.int64).max).astype(np.int64)


class _Best:
    """The k best (score descending, id ascending, null ids first) of each slot, over all rows of a task."""

    def __init__(self, slots: int, k: int) -> None:
        self.k, self.floor = k, np.full(slots, _LEAST)
        self.kept = np.empty((5, 0), np.int64)  # slot, score, has id, id, number of the row in the task
        self.more: list[np.ndarray] = []

    def add(self, slot: np.ndarray, score: np.ndarray, has: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        self.more.append(np.stack([slot, score, has.astype(np.int64), ids, row]))

    def settle(self) -> None:
        if not self.more:
            return
        all_ = np.concatenate([self.kept, *self.more], axis=1)
        all_ = all_[:, np.lexsort((all_[4], all_[3], all_[2], -all_[1], all_[0]))]
        nth = np.arange(all_.shape[1]) - np.searchsorted(all_[0], all_[0])
        self.kept, self.more = all_[:, nth < self.k], []
        last = all_[:, nth == self.k - 1]
        self.floor[last[0]] = last[1]


def _at_least(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Of the allowed pairs those that are among the k best of their line, and their ties."""
    if scores.shape[1] > k and allowed.sum(axis=1).max(initial=0) > k:
        line = np.where(allowed, scores, _LEAST)
        allowed = allowed & (scores >= np.partition(line, -k, axis=1)[:, -k][:, None])
    return allowed


def _keys(anchor: np.ndarray, score: np.ndarray, has: np.ndarray, ids: np.ndarray) -> pa.Array:
    """25 bytes that sort as (anchor, score descending, id with null first)."""
    packed = np.zeros(len(anchor), np.dtype([("anchor", ">u8"), ("score", ">u8"), ("has", "u1"), ("id", ">u8")]))
    packed["anchor"], packed["has"] = anchor, has
    packed["score"] = ~(score.astype(np.uint64) ^ np.uint64(1 << 63))
    packed["id"] = ids.astype(np.uint64) ^ np.uint64(1 << 63)
    offsets = pa.array(np.arange(len(anchor) + 1, dtype=np.int32) * 25, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(anchor), [None, offsets.buffers()[1], pa.py_buffer(packed.tobytes())])


def _unpacked(key: bytes) -> tuple[int, int, int | None]:
    score = (int.from_bytes(key[8:16], "big") ^ ((1 << 64) - 1)) - (1 << 63)
    return int.from_bytes(key[:8], "big"), score, int.from_bytes(key[17:], "big") - (1 << 63) if key[16] else None


def _window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Scores s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def _pairs(rows: DataFrame, block, scale: int, k: int, positive: bool, floors=None) -> DataFrame:
    """Packed keys of the pairs of each task that can count, flagged positive."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors = block.value
        n, windows = len(anchors.ids), 1 if positive else anchors.low.shape[1]
        best, seen = _Best(n * windows, k), 0
        if floors is not None:
            best.floor[:] = floors.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                ids, has, labels, vectors = _valid(whole.slice(at, ROWS_AT_ONCE), scale, anchors.vectors.shape[1])
                number = seen + np.arange(len(ids))
                seen += len(ids)
                for start in range(0, n, ANCHORS_AT_ONCE):
                    some = np.arange(start, min(n, start + ANCHORS_AT_ONCE))
                    if positive:
                        for label in np.unique(anchors.labels[some]):
                            line, col = some[anchors.labels[some] == label], np.flatnonzero(labels == label)
                            s = _scores(anchors.vectors[line], vectors[col])
                            i, j = np.nonzero(_at_least(s, s >= best.floor[line][:, None], k))
                            best.add(line[i], s[i, j], has[col[j]], ids[col[j]], number[col[j]])
                    else:
                        s = _scores(anchors.vectors[some], vectors)
                        other = anchors.labels[some][:, None] != labels[None, :]
                        for w in range(windows):
                            slot = some * windows + w
                            low = np.maximum(anchors.low[some, w], best.floor[slot])
                            i, j = np.nonzero(_at_least(s, other & (s >= low[:, None]) & (s <= anchors.high[some, w][:, None]), k))
                            best.add(slot[i], s[i, j], has[j], ids[j], number[j])
                best.settle()
        slot, value, has, ids, number = best.kept
        anchor = slot // windows
        _, first = np.unique(np.stack([anchor, number]), axis=1, return_index=True)  # a row in two windows is one pair
        for at in range(0, len(first), 1 << 16):
            part = first[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([_keys(anchor[part], value[part], has[part], ids[part]), pa.array(np.full(len(part), positive))], ["key", "positive"])

    return rows.mapInArrow(score, "key binary, positive boolean")


def _streamed(pairs: DataFrame, tasks: int, reader: Callable, schema: str) -> DataFrame:
    """The secondary sort: dealt by anchor, sorted by the packed key in each partition, read once."""
    return pairs.repartition(tasks, F.substring("key", 1, 8)).sortWithinPartitions("key", F.desc("positive")).mapInArrow(reader, schema)


def _table(found: list[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(found), 1 << 14):
        cols = zip(*found[at : at + (1 << 14)], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def _first_positives(block, own: list[int], positives: int) -> Callable:
    """Reader of sorted pairs of one label: the first rows of each anchor but itself."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors = block.value
        current, taken, found, itself = -1, 0, [], False
        for batch in batches:
            for key in batch.column(0).to_pylist():
                anchor, score, row_id = _unpacked(key)
                if anchor != current:
                    current, taken, itself = anchor, 0, False
                if not itself and row_id == anchors.ids[anchor] and score == own.value[anchor]:
                    itself = True  # another row with this id and score would give the same result
                elif taken < positives:
                    taken += 1
                    found.append((anchor, row_id, score))
            yield from _table(found, ["anchor", "id", "score"], [pa.int64()] * 3)
            found = []

    return read


def _emit_negatives(block, low: int, high: int, negatives: int) -> Callable:
    """Reader of sorted pairs of all labels: each positive opens a window, negatives go into open ones."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors = block.value
        names = [c.split()[0] for c in OUT.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        current, windows, zeros, found = -1, [], [], []
        for batch in batches:
            for key, positive in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                anchor, score, row_id = _unpacked(key)
                if anchor != current:
                    current, windows, zeros = anchor, [], []
                if positive:
                    bottom, top = _window(score, low, high)
                    window = [row_id, score, bottom, top, 0]
                    windows.append(window)
                    # Only at a score of 0 can negatives of a window come before its positive.
                    if score == 0:
                        for other in zeros:
                            window[4] += 1
                            found.append((int(anchors.ids[anchor]), row_id, window[4], other, 0, 0))
                    continue
                if score == 0 and len(zeros) < negatives:
                    zeros.append(row_id)
                for window in windows:
                    if window[4] < negatives and window[2] <= score <= window[3]:
                        window[4] += 1
                        found.append((int(anchors.ids[anchor]), window[0], window[4], row_id, window[1], score))
            yield from _table(found, names, types)
            found = []

    return read


def mine(
    vectors: DataFrame, anchors: DataFrame, *, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block_bytes: int = BLOCK_BYTES, bound_partitions: int = BOUND_PARTITIONS,
) -> DataFrame:
    """Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchors are the rows of vectors that are asked for. Components are taken as floor(scale * x); a
    score is the inner product of two such vectors, where components that the shorter one lacks are 0.
    Higher scores come first, then smaller ids, null ids before all. For an anchor's first positives
    rows of its label but itself, the first negatives rows of other labels are given whose score is
    between low and high percent of the positive's (0 <= low <= high <= 100).

    Rows with a null label, a null vector or a component that is null or not finite take no part, as
    anchors neither. Anchors without an id take no part. Rows that repeat an id are rows of their own; an
    anchor row that is repeated as a whole is one anchor, and its repeats are among its positives.
    Scores beyond a long are set to its end. No anchors, or no rows, give no rows.
    """
    if not 0 <= low <= high <= 100:
        raise ValueError("low and high are percents, low first")
    spark = vectors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")]
    rows = vectors.select(*columns)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    asked = cut(anchors.select(*columns).where(usable).distinct().withColumn("bytes", 8 * F.size("vector") + 64))
    total, count = asked.agg(F.sum("bytes"), F.count("*")).first()
    if not count:
        return spark.createDataFrame([], OUT)
    blocks = -(-total // block_bytes)
    while blocks > 1 or total > block_bytes:  # until no block is over the limit that has more than one anchor
        dealt = asked.groupBy(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)).alias("block")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        if dealt.where((F.col("bytes") > block_bytes) & (F.col("n") > 1)).isEmpty():
            break
        blocks *= 2
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)))
    spread = rows.rdd.getNumPartitions() >= bound_partitions
    path = scratch_path(spark, "hard-negatives")
    for number in range(blocks):
        table = asked.where(F.col("block") == number).select("id", "label", "vector").orderBy("id", "label", "vector").toArrow()
        if not table.num_rows:
            continue
        ids, _, labels, packed = _valid(table.combine_chunks().to_batches()[0], scale)
        block = _Anchors(ids, labels, packed)
        sent = spark.sparkContext.broadcast(block)
        own = spark.sparkContext.broadcast([int(_scores(v[None, :], v[None, :])[0, 0]) for v in packed])
        # At most positives rows for each anchor of the block come back.
        first = _streamed(_pairs(rows, sent, scale, positives + 1, True), tasks, _first_positives(sent, own, positives), "anchor long, id long, score long").toArrow()
        anchor, score = first.column("anchor").to_numpy(), first.column("score").to_numpy()
        order = np.argsort(anchor, kind="stable")
        nth = np.empty(len(anchor), np.int64)
        nth[order] = np.arange(len(anchor)) - np.searchsorted(anchor[order], anchor[order])
        block.low, block.high = np.ones((len(ids), positives), np.int64), np.zeros((len(ids), positives), np.int64)
        for i, j, s in zip(anchor, nth, score.tolist(), strict=True):
            block.low[i, j], block.high[i, j] = _window(s, low, high)
        windowed = spark.sparkContext.broadcast(block)
        floors = None
        if spread:
            some = rows.where(F.pmod(F.xxhash64("id", "vector"), F.lit(BOUND_SHARE)) == 0)
            bounds = np.full(block.low.size, _LEAST)
            for a, w, s in _bounds(_pairs(some, windowed, scale, negatives, False), windowed, tasks, negatives):
                bounds[a * positives + w] = s
            floors = spark.sparkContext.broadcast(bounds)
        known = spark.createDataFrame(pa.table({"key": _keys(anchor, score, np.asarray(first.column("id").combine_chunks().is_valid()), pa.compute.fill_null(first.column("id"), 0).to_numpy()), "positive": pa.array(np.full(len(anchor), True))}))
        pairs = _pairs(rows, windowed, scale, negatives, False, floors).unionByName(known)
        _streamed(pairs, tasks, _emit_negatives(windowed, low, high, negatives), OUT).write.mode("append").parquet(path)
        for variable in (sent, own, windowed, *([floors] if floors else [])):
            variable.destroy()
    return spark.read.schema(OUT).parquet(path)


def _bounds(pairs: DataFrame, block, tasks: int, negatives: int) -> list[tuple[int, int, int]]:
    """(anchor, window, score) of the last of the first negatives of each window, over the rows given."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors = block.value
        current, counts, found = -1, [], []
        for batch in batches:
            for key in batch.column(0).to_pylist():
                anchor, score, _ = _unpacked(key)
                if anchor != current:
                    current, counts = anchor, [0] * anchors.low.shape[1]
                for w, (bottom, top) in enumerate(zip(anchors.low[anchor], anchors.high[anchor], strict=True)):
                    if bottom <= score <= top:
                        counts[w] += 1
                        if counts[w] == negatives:
                            found.append((anchor, w, score))
            yield from _table(found, ["anchor", "window", "score"], [pa.int64()] * 3)
            found = []

    table = _streamed(pairs, tasks, read, "anchor long, window long, score long").toArrow()
    return list(zip(*(table.column(c).to_pylist() for c in ("anchor", "window", "score")), strict=True))
