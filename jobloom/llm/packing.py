"""Sum-of-squares packing of tokenized documents into sequences of fixed capacity.

Tokens are cut into pieces (only documents over the capacity are cut), pieces are dealt by a hash of
a row number into groups of a bounded size, and within a group each piece goes where the sum over
gaps of (open bins with this gap) squared becomes smallest. Pieces over half of the capacity come
first, so a group ends with few open bins. A group sees lengths and row numbers, never tokens.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import cut, slices, text_rows

CAPACITY = 1024
GROUP_PIECES = 250_000
END_ID = 2


class Vocabulary:
    """ids of texts as the tokenizers library gives them with add_special_tokens=False.

    The ranks are the same vocabulary as its JSON file, and merging by them gives the same ids in a
    fraction of the time (tests compare the two). A special token's string in a text is that token.
    """

    SPECIAL = {"<|endoftext|>": 50256}

    def __init__(self, ranks_path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.SPECIAL)

    def ids(self, text: str) -> list[int]:
        if any(x in text for x in self.SPECIAL):
            return self.encoding.encode(text, allowed_special=set(self.SPECIAL), disallowed_special=())
        return self.encoding.encode_ordinary(text)


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def pieces(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, end_id: int = END_ID, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, piece, start, length, ids_crc32. A document's ids end with end_id; of one over
    the capacity every piece but the first is full."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks_path)
        for batch in slices(batches, 1):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*vocabulary.ids(text or ""), end_id], "<u4").tobytes()
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    to = at + (n - at - 1) % capacity + 1
                    rows.append((doc_id, piece, at, to - at, zlib.crc32(ids[4 * at : 4 * to])))
                    at, piece = to, piece + 1
            cols = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return text_rows(docs, id_col, text_col).mapInArrow(tokenize, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order. Of equal sums the smaller gap is taken."""
    open_bins = np.zeros(capacity + 1, np.int64)  # by gap; gap 0 (closed) isn't counted
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n_bins = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, a in enumerate(lengths.tolist()):
        if a == capacity:
            bins[i], offsets[i], n_bins = n_bins, 0, n_bins + 1
            continue
        # The change of the sum: a bin leaves gap g (1 - 2n) and enters gap g - a (1 + 2n).
        have = open_bins[a:capacity]
        change = np.where(have > 0, 2 * (open_bins[: capacity - a] - have) + 2, np.iinfo(np.int64).max)
        change[0] = 1 - 2 * have[0] if have[0] else change[0]  # fills the bin: it enters no gap
        best = int(change.argmin())
        if change[best] > 2 * open_bins[capacity - a] + 1:
            g, b, n_bins = capacity, n_bins, n_bins + 1
        else:
            g, b = a + best, stacks[a + best].pop()
            open_bins[g] -= 1
        bins[i], offsets[i] = b, capacity - g
        if g > a:
            open_bins[g - a] += 1
            stacks[g - a].append(b)
    return bins, offsets


def pack(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty: its only id is end_id. Null and repeated ids and repeated rows are
    packed like any others, each row on its own. An empty table gives no rows.
    """
    # Row numbers hold only for one run of the scan, so they are kept with the pieces (a few bytes each).
    rows = cut(pieces(docs, ranks_path, capacity, end_id, id_col=id_col, text_col=text_col).withColumn("row", F.monotonically_increasing_id()))
    groups = max(1, -(-rows.count() // group_pieces))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        # Pieces over half of the capacity each need a bin anyhow; the others come last, in an
        # order that has nothing to do with their lengths, as the rule expects.
        group = group.assign(late=group["length"] <= capacity // 2).sort_values(["late", "row"])
        bins, offsets = sum_of_squares(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=bins * groups + group["grp"].to_numpy(), offset=offsets).drop(columns=["grp", "row", "late"])

    return rows.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups))).groupBy("grp").applyInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
