"""Token-id files: one zstandard frame for each document, all with one dictionary trained on id arrays.

A data set is a folder of Parquet files whose rows are blocks of about BLOCK_BYTES, in ascending
(id, content) order over the whole folder:

    block              number, ascending with the ids
    dictionary_sha256  of the dictionary that its frames need, which lies in the folder's _dictionary
    id_bytes           2 or 4: width of a little-endian id inside a frame
    first_id, last_id  smallest and largest document id, for pushed-down filters (null: only null ids)
    doc_ids, offsets, n_tokens   of each frame: document, place in frames, number of ids
    frames             the frames one after another

A document is read by its block's index and its own frame, so reading a short one decompresses no
other. The dictionary makes frames of short documents small although each is compressed alone.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm._common import scratch_path, slices, stored, text_rows
from jobloom.llm.packing import _vocabulary

END_ID = 0
BLOCK_BYTES = 1 << 20
#: The dictionary is trained on so many texts, drawn by a hash of id and text; all documents are compressed with it.
SAMPLE_DOCUMENTS = 512
#: A sampled text counts up to here when the dictionary is trained (it holds less anyway); documents are never cut.
SAMPLE_CHARS = 64 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3

BLOCK = (
    "block long, dictionary_sha256 string, id_bytes int, first_id long, last_id long, "
    "doc_ids array<long>, offsets array<long>, n_tokens array<long>, frames binary"
)

_codecs: dict[bytes, tuple] = {}


def _codec(dictionary: bytes) -> tuple:
    """(compressor, decompressor) of a dictionary, made once for each worker; an empty one is none."""
    import zstandard

    if dictionary not in _codecs:
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        _codecs[dictionary] = (zstandard.ZstdCompressor(level=LEVEL, dict_data=data), zstandard.ZstdDecompressor(dict_data=data))
    return _codecs[dictionary]


def _serialized(ids: list[int], end_id: int, id_bytes: int) -> bytes:
    return np.array([*ids, end_id], f"<u{id_bytes}").tobytes()


def train_dictionary(docs: DataFrame, ranks_path: str, *, end_id: int = END_ID, id_bytes: int = 2, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A dictionary of the ids of SAMPLE_DOCUMENTS texts at the most; empty if there are too few to train one."""
    import zstandard

    texts = text_rows(docs, id_col, text_col).where("length(text) > 0")
    texts = texts.select(F.xxhash64("doc_id", "text").alias("drawn"), F.substring("text", 1, SAMPLE_CHARS).alias("text")).orderBy("drawn", "text").limit(SAMPLE_DOCUMENTS).select("text")

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(ranks_path)
        for batch in batches:
            found = [_serialized(vocabulary.ids(t), end_id, id_bytes) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    samples = sorted(r[0] for r in texts.mapInArrow(ids, "ids binary").toLocalIterator())
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 and size >= 1024 else b""
    except zstandard.ZstdError:  # samples too few or too much alike
        return b""


def _encoded(rows: DataFrame, ranks_path: str, dictionary: bytes, end_id: int, id_bytes: int) -> DataFrame:
    """Columns: doc_id, n, digest, frame."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, (compressor, _) = _vocabulary(ranks_path), _codec(dictionary)
        for batch in slices(batches, 1, 4 << 20):
            counts, digests, frames = [], [], []
            for text in batch.column(1).to_pylist():
                ids = _serialized(vocabulary.ids(text or ""), end_id, id_bytes)
                counts.append(len(ids) // id_bytes)
                digests.append(zlib.crc32(ids))
                frames.append(compressor.compress(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.int64()), pa.array(frames, pa.binary())], ["doc_id", "n", "digest", "frame"])

    return rows.mapInArrow(encode, "doc_id long, n long, digest long, frame binary")


def _blocks(dictionary: bytes, id_bytes: int, block_bytes: int) -> Callable:
    """Sorted documents of a partition into blocks, numbered in order: partition above, place in it below."""
    digest = hashlib.sha256(dictionary).hexdigest()
    schema = pa.schema([
        ("block", pa.int64()), ("dictionary_sha256", pa.string()), ("id_bytes", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("frames", pa.binary()),
    ])

    def block(number: int, ids: list, counts: list, frames: list) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])[:-1]]).astype(np.int64)
        known = [i for i in ids if i is not None]
        row = [number, digest, id_bytes, min(known, default=None), max(known, default=None), ids, offsets.tolist(), counts, b"".join(frames)]
        return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, schema, strict=True)], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, 0
        ids, counts, frames = [], [], []
        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "frame")), strict=True):
                # Index entries count too, so many tiny documents don't make one large row.
                if frames and held + len(frame) + 24 > block_bytes:
                    yield block(number, ids, counts, frames)
                    number, held, ids, counts, frames = number + 1, 0, [], [], []
                ids.append(doc_id)
                counts.append(n)
                frames.append(frame)
                held += len(frame) + 24
        if frames:
            yield block(number, ids, counts, frames)

    return cut


def write(
    docs: DataFrame, path: str, ranks_path: str, *, end_id: int = END_ID, vocabulary_size: int = 50257, block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Writes the documents' ids, each with end_id after them, as a data set in the layout above.

    A null text counts as empty: its only id is end_id. Null ids come first. Rows that repeat an id or
    are repeated as a whole are documents of their own, beside each other. An empty table makes a data
    set without blocks.
    """
    spark = docs.sparkSession
    id_bytes = 2 if max(vocabulary_size - 1, end_id) < 1 << 16 else 4
    dictionary = train_dictionary(docs, ranks_path, end_id=end_id, id_bytes=id_bytes, id_col=id_col, text_col=text_col)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/_dictionary")
    # Range bounds are drawn in a pass of their own, which must not encode all texts again.
    frames = stored(_encoded(text_rows(docs, id_col, text_col), ranks_path, dictionary, end_id, id_bytes), "frames", compression="none")
    # Equal ids may hold a third of all rows; what is encoded decides among them, and a hash among copies.
    order = ["doc_id", "digest", "n", "spread"]
    ordered = frames.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("doc_id", "n", "frame").mapInArrow(_blocks(dictionary, id_bytes, block_bytes), BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _dictionaries(spark: SparkSession, path: str) -> dict[str, bytes]:
    """The data set's dictionary by its digest: one row of DICTIONARY_BYTES at the most."""
    found = {r.sha256: bytes(r.dictionary) for r in spark.read.parquet(f"{path}/_dictionary").collect()}
    for digest, dictionary in found.items():
        if hashlib.sha256(dictionary).hexdigest() != digest:
            raise ValueError(f"the dictionary in {path} doesn't have its digest")
    return found


def _frames(row: dict, wanted: set | None, dictionaries: dict[str, bytes]) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document, ids) of a block's documents, or of the wanted ones; only these are decompressed."""
    if row["dictionary_sha256"] not in dictionaries:
        raise ValueError(f"block {row['block']} was written with another dictionary")
    _, decompressor = _codec(dictionaries[row["dictionary_sha256"]])
    frames, ends = memoryview(row["frames"]), [*row["offsets"][1:], len(row["frames"])]
    for place, (doc_id, n, start, end) in enumerate(zip(row["doc_ids"], row["n_tokens"], row["offsets"], ends, strict=True)):
        if wanted is None or doc_id in wanted:
            ids = np.frombuffer(decompressor.decompress(frames[start:end], max_output_size=n * row["id_bytes"]), f"<u{row['id_bytes']}")
            if len(ids) != n:
                raise ValueError(f"block {row['block']}, document {place}: {len(ids)} ids instead of {n}")
            yield doc_id, ids


def read(spark: SparkSession, path: str) -> DataFrame:
    """Columns: block, before (ids before the document in its block), doc_id, n_tokens, ids_crc32 (of the ids
    as unsigned 32-bit), from the frames of all blocks."""
    dictionaries = _dictionaries(spark, path)
    names, types = ["block", "before", "doc_id", "n_tokens", "ids_crc32"], [pa.int64()] * 5

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                rows, before = [], 0
                for doc_id, ids in _frames(row, None, dictionaries):
                    rows.append((row["block"], before, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return spark.read.schema(BLOCK).parquet(f"{path}/blocks").mapInArrow(decode, ", ".join(f"{n} long" for n in names))


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Columns: doc_id, ids (array of int, with the end id). A short list of documents by their block's index.

    Blocks are chosen by a filter on first_id and last_id that reaches the Parquet scan. Ids that aren't
    there give no rows; an id that several documents have gives a row for each.
    """
    dictionaries, wanted = _dictionaries(spark, path), set(doc_ids)
    schema = "doc_id long, ids array<int>"
    if not wanted:
        return spark.createDataFrame([], schema)
    inside = F.lit(False)
    for doc_id in sorted(wanted):
        inside = inside | ((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for doc_id, ids in _frames(batch.slice(i, 1).to_pylist()[0], wanted, dictionaries):
                    yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return spark.read.schema(BLOCK).parquet(f"{path}/blocks").where(inside).mapInArrow(decode, schema)


def token_table(spark: SparkSession, path: str) -> DataFrame:
    """Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, all from the files."""
    sized = spark.read.schema(BLOCK).parquet(f"{path}/blocks").select("block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("size"))
    # Ids before a block: those of the partitions before its own (the upper half of its number), and inside of it.
    sized = sized.withColumn("part", F.shiftright("block", 32))
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sized.groupBy("part").agg(F.sum("size").alias("size")).select("part", before(Window.orderBy("part")).alias("part_start"))  # one row for each written file
    starts = sized.withColumn("in_part", before(Window.partitionBy("part").orderBy("block"))).join(F.broadcast(parts), "part")
    starts = starts.select("block", (F.col("part_start") + F.col("in_part")).alias("block_start"))
    return read(spark, path).join(starts, "block").select("doc_id", (F.col("block_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """token_table of the documents, written to the shared folder and read back; edge cases as in write."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write(docs, path, ranks_path, id_col=id_col, text_col=text_col)
    return token_table(docs.sparkSession, path)
