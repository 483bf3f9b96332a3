"""Byte-level BPE by corpus-level merge replay, and decoding.

Instead of merging word by word, the distinct words of a chunk of the corpus are merged together: an
inverted index leads from the rank of a token pair to all positions where it stands, ranks are
replayed in ascending order, and each merge touches only its positions and their two neighbours.
Words stand in one flat array, linked both ways. A merge that makes a pair of a lower rank than its
own, even if only until the next merge of its rank, would have to give way to that pair; words in which
that happens are merged again one step at a time. Chunks are merged inside Spark tasks, so texts aren't shuffled,
and words met before by the same worker come from a cache of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from jobloom.llm._common import slices, text_rows

MAX_CACHED = 400_000
_NONE = np.int64(1) << 40


class MergeTable:
    """Ranks of a vocabulary, and which two tokens make which third."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.text = [str(i) for i in range(len(self.token))]
        pairs = [(a, b, rank) for token, rank in ranks.items() for i in range(1, len(token)) if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        key = (table[:, 0] << 20) | table[:, 1]
        order = np.argsort(key)
        self.keys, self.made = np.append(key[order], _NONE), np.append(table[order, 2], _NONE)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    @classmethod
    def load(cls, path: str) -> MergeTable:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes; _NONE if none, or if either is an end (negative)."""
        key = np.where((left < 0) | (right < 0), _NONE - 1, (left << 20) | right)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.made[at], _NONE)

    def one_word(self, word: bytes) -> list[int]:
        """The same by the definition: always the lowest rank, the leftmost of equal ones."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, len(self.token)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.token):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[x] for x in parts]


def replay(words: list[bytes], table: MergeTable) -> list[bytes]:
    """ids (uint32 bytes) of every word, all words merged together in rank order."""
    if not words:
        return []
    sizes = np.array([len(w) + 1 for w in words])  # one place more: the end of the word
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    raw = np.frombuffer(b"".join(w + b"\0" for w in words), np.uint8)
    symbol = table.of_byte[raw]
    symbol[ends - 1] = -1
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[-1], before[0] = n - 1, n - 1  # the last place is an end, so it stops both ways
    rank = table.rank(symbol, symbol[after])

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def note(places: np.ndarray) -> None:
        """Index places by their present rank."""
        places = places[rank[places] < _NONE]
        if len(places) == 1:
            groups = [places]
        else:
            places = places[np.argsort(rank[places], kind="stable")]
            r = rank[places]
            cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)] if len(r) else []
            groups = [places[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        for group in groups:
            r = int(rank[group[0]])
            if r in index:
                index[r].append(group)
            else:
                index[r] = [group]
                heapq.heappush(heap, r)

    note(np.arange(n))
    odd: set[int] = set()
    while heap:
        r = heapq.heappop(heap)
        held = index.pop(r)
        at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
        at = at[rank[at] == r]  # other places have changed since
        if len(at) > 1:
            overlap = after[at[:-1]] == at[1:]
            if overlap.any():  # a a a: of places that share a symbol the leftmost goes first
                keep, last = [], -1
                for p in at.tolist():
                    if p != last:
                        keep.append(p)
                        last = int(after[p])
                at = np.array(keep)
        if not len(at):
            continue
        gone = after[at]
        nxt = after[gone]
        pair = rank[nxt] == r  # two merges side by side: what the left one makes with the right one's first symbol
        if pair.any():
            between = table.rank(np.full(int(pair.sum()), r), symbol[nxt[pair]])
            odd.update(owner[nxt[pair][between < r]].tolist())
        symbol[at] = r
        rank[gone] = _NONE
        after[at] = nxt
        before[nxt] = at
        left = before[at]
        touched = np.unique(np.concatenate([at, left])) if len(at) > 1 else np.array([left[0], at[0]])
        new = table.rank(symbol[touched], symbol[after[touched]])
        changed = touched[new != rank[touched]]
        rank[touched] = new
        low = changed[rank[changed] < r]
        if len(low):
            odd.update(owner[low].tolist())
        if len(changed):
            note(changed)

    alive = np.zeros(n, bool)
    starts = ends - sizes
    alive[symbol >= 0] = True
    # A place is merged away if the live place before it points beyond it.
    reach = np.zeros(n, bool)
    reach[starts] = True
    reach[after[_chain(after, starts, symbol)]] = True
    alive &= reach
    counts = np.bincount(owner[alive], minlength=len(words))
    raw_ids = symbol[alive].astype(np.uint32).tobytes()
    cuts = [0, *(4 * np.cumsum(counts)).tolist()]
    out = [raw_ids[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
    for w in odd:
        out[w] = np.array(table.one_word(words[w]), np.uint32).tobytes()
    return out


def _chain(after: np.ndarray, starts: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """All places that are reached from the starts, ends left out."""
    found, now = [], starts[symbol[starts] >= 0]
    while len(now):
        found.append(now)
        now = after[now]
        now = now[symbol[now] >= 0]
    return np.concatenate([np.empty(0, np.int64), *found])


class Encoder:
    """ids of whole texts: matches of the pattern, encoded apart from each other."""

    def __init__(self, path: str, pattern: str) -> None:
        self.table = MergeTable.load(path)
        self.pattern = regex.compile(pattern)
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pattern.findall(x) for x in texts]
        words: set[str] = set()
        for x in split:
            words.update(x)
        new = list(words.difference(self.cache))
        if len(self.cache) + len(new) > MAX_CACHED:
            self.cache.clear()
            new = list(words)
        self.cache.update(zip(new, replay([w.encode() for w in new], self.table), strict=True))
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, x)), np.uint32) for x in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.token.__getitem__, ids))


_encoders: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, ids. A null or empty text has no ids; special tokens' strings are ordinary text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, pattern)
        for batch in slices(batches, 1):
            ids = enc.encode([x or "" for x in batch.column(1).to_pylist()])
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
            flat = np.concatenate([np.empty(0, np.uint32), *ids]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["doc_id", "ids"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Columns: doc_id, ids, decoded (the bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([enc.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what encode and decode give.

    One pass over the texts. Null and empty texts have no tokens, so the digests are those of the
    empty string. Rows are independent: repeated ones give repeated results.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, pattern)
        shown = enc.table.text.__getitem__
        for batch in slices(batches, 1):
            rows = []
            for ids in enc.encode([x or "" for x in batch.column(1).to_pylist()]):
                plain = ids.tolist()
                rows.append((len(plain), hashlib.sha256(",".join(map(shown, plain)).encode()).hexdigest(), hashlib.sha256(enc.decode(plain)).hexdigest()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
