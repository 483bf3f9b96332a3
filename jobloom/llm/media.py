"""Media columns by content-defined chunking.

A payload is stored as 8-bit mono PCM samples in a WAV container. The container's bytes are cut where
a rolling gear hash meets a mask, so equal passages give equal chunks wherever they stand. Chunks are
named by a digest and kept once; a media value is an ordered list of digests. Two tables in the shared
folder hold the media, and reading back uses nothing else:

- records: for each row its ordered digests, and beside them the chunks that no other row can have;
- shared: every other chunk once, by digest.

Which chunks can be shared is counted by Spark over the digests of all rows. Tasks that write learn it
from a Bloom filter of the repeated digests, of bounded size: a false positive only sends a chunk the
way of shared ones. So the payload of unrepeated chunks is written where it is made and is never
shuffled, and only shared chunks travel: to be kept once, and to be joined with the lists by digest.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import as_bytes, slices, stored, text_rows

UNIT = 192
RATE = 16_000
HEADER = struct.Struct("<4sI4s4sIHHIIHH4sI")
MIN_CHUNK, MAX_CHUNK, MASK_BITS = 256, 4096, 8  # about 490 bytes on average
WINDOW = 16
PROBES = 4  # bits of the filter for each digest
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 27  # 8 kB to 16 MB


def _gear() -> np.ndarray:
    """256 values from a splitmix sequence."""
    with np.errstate(over="ignore"):
        z = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(48)).astype(np.uint16)


GEAR = _gear()


def pad(raw: bytes) -> bytes:
    """Spaces up to a positive multiple of UNIT."""
    return raw + b" " * (-len(raw) % UNIT if raw else UNIT)


def to_wav(samples: bytes) -> bytes:
    return HEADER.pack(b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples)) + samples


def from_wav(media: bytes) -> bytes:
    riff, _, wave, _, _, form, channels, _, _, _, bits, data, size = HEADER.unpack_from(media)
    if (riff, wave, data, form, channels, bits) != (b"RIFF", b"WAVE", b"data", 1, 1, 8) or len(media) != HEADER.size + size:
        raise ValueError("not an 8-bit mono PCM file")
    return media[HEADER.size :]


def cuts(media: bytes) -> list[int]:
    """Ends of the chunks. The hash of a place covers the WINDOW bytes up to it: a shift by one for
    each byte pushes older ones out of 16 bits, so windows double in four vector steps."""
    n, ends, start = len(media), [], 0
    if n > MIN_CHUNK:
        h = GEAR[np.frombuffer(media, np.uint8)]
        span = 1
        while span < WINDOW:
            h[span:] += h[:-span] << np.uint16(span)
            span *= 2
        places = np.flatnonzero((h >> np.uint16(16 - MASK_BITS)) == 0) + 1
        at = 0
        while n - start > MIN_CHUNK:
            at = int(np.searchsorted(places, start + MIN_CHUNK))
            end = min(int(places[at]) if at < len(places) else n, start + MAX_CHUNK, n)
            ends.append(end)
            start = end
    if start < n or not n:
        ends.append(n)
    return ends


def chunks(media: bytes) -> list[bytes]:
    ends = cuts(media)
    return [media[i:j] for i, j in zip([0, *ends], ends, strict=False)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def features(samples: bytes) -> str:
    """Mean, RMS about the middle, rate of crossings of the middle, and peak."""
    x = np.frombuffer(samples, np.uint8).astype(np.float64) - 128
    return f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};crossings={np.count_nonzero(np.diff(x >= 0)) / len(x):.6f};peak={int(np.abs(x).max())}"


def chunk_lists(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Column digest: one row for each chunk of each row's media."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            found = [digest(c) for raw in as_bytes(batch.column(0)) for c in chunks(to_wav(pad(raw or b"")))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["digest"])

    return text_rows(docs, id_col, text_col).select("text").mapInArrow(make, "digest binary")


def _places(names: list[bytes], bits: int) -> np.ndarray:
    """PROBES places for each digest, from its four 32-bit parts."""
    parts = np.frombuffer(b"".join(names), "<u4").reshape(-1, 4).astype(np.int64)
    return parts[:, :PROBES] & (bits - 1)


class Filter:
    """Says of a digest that it is not repeated, or that it may be."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words  # of 32 bits each

    @classmethod
    def of(cls, repeated: DataFrame) -> Filter:
        """repeated: distinct digests. Tasks set bits, Spark joins them by OR; MOST_BITS bounds what the driver gets."""
        bits = 1 << max(LEAST_BITS.bit_length() - 1, min(MOST_BITS.bit_length() - 1, (16 * repeated.count()).bit_length()))

        def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(_places(batch.column(0).to_pylist(), bits).ravel())
                word, first = np.unique(at >> 5, return_index=True)
                value = np.bitwise_or.reduceat(np.int64(1) << (at & 31), first) if len(at) else at
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], ["word", "value"])

        lit = repeated.mapInArrow(light, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
        words = np.zeros(bits // 32, np.uint32)
        words[lit["word"].to_numpy()] = lit["value"].to_numpy()
        return cls(words)

    def maybe(self, names: list[bytes]) -> list[bool]:
        at = _places(names, 32 * len(self.words))
        return ((self.words[at >> 5] >> (at & 31).astype(np.uint32)) & 1).all(1).tolist()


_RECORD = "doc_id long, n_bytes long, media_sha256 binary, digests array<binary>, own array<binary>, shared_at array<int>"


def _batch(rows: list[tuple], names: str, *kinds: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names.split())


def write_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Store the media of all rows; returns the two tables as they are read from the shared folder.

    records: doc_id, n_bytes, media_sha256, digests and own (a chunk, or null for a shared one), both in order, and shared_at, the places of shared ones.
    shared: digest, chunk.
    """
    digests = chunk_lists(docs, id_col=id_col, text_col=text_col)
    repeated = stored(digests.groupBy("digest").count().where("count > 1").select("digest"), "repeated")
    sent = docs.sparkSession.sparkContext.broadcast(Filter.of(repeated))  # at most MOST_BITS

    def media_of(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[tuple]]:
        for batch in slices(batches, at):
            made = []
            for i, raw in enumerate(as_bytes(batch.column(at))):
                media = to_wav(pad(raw or b""))
                parts = chunks(media)
                names = [digest(c) for c in parts]
                made.append((batch.column(0)[i].as_py(), len(raw or b""), media, parts, names, sent.value.maybe(names)))
            yield made

    def record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in media_of(batches, 1):
            rows = [
                (doc_id, n, hashlib.sha256(media).digest(), names, [None if other else part for part, other in zip(parts, common, strict=True)], [i for i, other in enumerate(common) if other])
                for doc_id, n, media, parts, names, common in made
            ]
            yield _batch(rows, "doc_id n_bytes media_sha256 digests own shared_at", pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int32()))

    def common_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in media_of(batches, 1):
            kept = {name: part for *_, parts, names, common in made for name, part, other in zip(names, parts, common, strict=True) if other}
            yield _batch(list(kept.items()), "digest chunk", pa.binary(), pa.binary())

    rows = text_rows(docs, id_col, text_col)
    shared = rows.mapInArrow(common_chunks, "digest binary, chunk binary").groupBy("digest").agg(F.first("chunk").alias("chunk"))
    return stored(rows.mapInArrow(record, _RECORD), "records", compression="zstd"), stored(shared, "shared", compression="zstd")


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_FEATURE_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())


def measured(parts: list[bytes], whole: bytes) -> tuple:
    """The columns of FEATURES of chunks put together, verified against the digest of the whole."""
    media = b"".join(parts)
    if hashlib.sha256(media).digest() != whole:
        raise ValueError("media put together from chunks differ from those that were stored")
    samples = from_wav(media)
    return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media), whole.hex(), features(samples)


def read_media(records: DataFrame, shared: DataFrame) -> DataFrame:
    """Columns: doc_id, n_bytes and FEATURES, from the two tables only.

    Rows without shared chunks are put together where they are read. Of the others each media value is
    put together once: its shared chunks are joined by digest, its own ones come along, in the order of
    the list; what is measured is then given to all rows with this value.
    """

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = [(doc_id, n, *measured(own, whole)) for doc_id, n, whole, own in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True)]
                yield _batch(rows, "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature", pa.int64(), pa.int64(), *_FEATURE_KINDS)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for whole, own, found in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    for x in found:
                        own[x["place"]] = x["chunk"]
                    rows.append((whole, *measured(own, whole)))
                yield _batch(rows, "whole payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature", pa.binary(), *_FEATURE_KINDS)

    first = records.where("size(shared_at) = 0").select("doc_id", "n_bytes", "media_sha256", "own").mapInArrow(alone, f"doc_id long, n_bytes long, {FEATURES}")
    mixed = records.where("size(shared_at) > 0")
    once = lambda *columns: mixed.groupBy("media_sha256").agg(*(F.first(c).alias(c) for c in columns))
    wanted = once("digests", "shared_at").select("media_sha256", "digests", F.explode("shared_at").alias("place")).select("media_sha256", "place", F.get("digests", "place").alias("digest"))
    lost = F.raise_error(F.lit("a shared chunk is missing")).cast("binary")
    found = wanted.join(shared, "digest", "left").groupBy("media_sha256").agg(F.collect_list(F.struct("place", F.coalesce("chunk", lost).alias("chunk"))).alias("found"))
    told = once("own").join(found, "media_sha256").mapInArrow(joined, f"whole binary, {FEATURES}")
    rest = mixed.select("doc_id", "n_bytes", F.col("media_sha256").alias("whole")).join(told, "whole")
    return first.unionByName(rest.drop("whole"))


def media_features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature.

    A null text is empty, and an empty one is UNIT spaces. Repeated ids and rows give a row each; equal
    texts give equal values. An empty table gives no rows.
    """
    return read_media(*write_media(docs, id_col=id_col, text_col=text_col))
