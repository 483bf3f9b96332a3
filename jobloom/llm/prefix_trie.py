"""The trie of turns that conversations share as prefixes, by z-fast tries of bounded batches.

1. Turns become digests and word counts where they lie. They are range-partitioned in conversation order,
   and a pass over each partition cuts every conversation into segments of at most SEGMENT turns, so a
   conversation that holds a third of all turns is many rows.
2. A prefix is named by its signature, the exclusive-or of mixed (depth, digest) of its turns: segments
   compute theirs apart, and what comes before a segment is a window over the few segments of its conversation.
3. A task inserts segments in batches into z-fast tries (one for each prefix at which segments begin).
   Compacted nodes are hashed by the signature at their handle, the two-fattest depth of their edge; a fat
   binary search over a segment's own signatures finds its exit node with logarithmically many look-ups.
   After a batch edges are expanded to one row for each depth, with members counted bottom-up.
4. Rows of one signature are merged over all batches. The smallest member of a node owns it, and what a
   conversation owns is the end of its own path, so sums over subtrees are suffix sums along owners' paths,
   added up by signature. No step collects a node's members or children.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobloom.llm._common import cut, stored

#: Turns in a segment; turns and segments in a batch of a task's tries.
SEGMENT = 4096
BATCH_TURNS, BATCH_SEGMENTS = 1 << 18, 1 << 15
#: Bytes of conversation ids that travel as one row to their node's hash.
ID_TEXT = 64 << 10
ROOT = bytes(16)

_WORD = "[^\\x20\\x09-\\x0D]+"
_SEQUENCE = "conv long, seq long, digests binary, words array<int>"


# ---- turns, segments and signatures
def segments(conversations: DataFrame, segment: int = SEGMENT, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Columns: conv, seq (ascending with the turns), before (turns before the segment), digests (16 bytes
    for each turn), words (of each text). Turns are in order of turn, null first; turns with one number
    in the order of their digests. Null roles and texts are empty. Rows without a conversation id belong
    to no conversation."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, role_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)).alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).alias("words"),
    )

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seq, current, digests, words, done = TaskContext.get().partitionId() << 32, None, [], [], []
        for batch in batches:
            for conv, digest, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if digests and (conv != current or len(digests) == segment):
                    done.append((current, seq, b"".join(digests), words))
                    seq, digests, words = seq + 1, [], []
                current = conv
                digests.append(digest)
                words.append(n)
            yield from _rows(done, _SEQUENCE)
            done = []
        if digests:
            yield from _rows([(current, seq, b"".join(digests), words)], _SEQUENCE)

    order = ["conv", "turn", "digest"]
    # Numbers of partitions order the segments, so the table is cut: no retry deals turns anew.
    found = cut(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(collect, _SEQUENCE))
    before = Window.partitionBy("conv").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("before", F.coalesce(F.sum(F.size("words").cast("long")).over(before), F.lit(0)).cast("long"))


def _rows(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    for at in range(0, len(rows), 4096):
        cols = zip(*rows[at : at + 4096], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def share_heads(found: DataFrame, every: int = 20, modulus: int = 4) -> DataFrame:
    """Segments of conversations whose first turns come from another one.

    The first h turns of conversation c - c % every stand before c's own turns after its first h, where h
    is the unsigned CRC-32 of the decimal c, modulo modulus; all of them if there are fewer, none if that
    conversation isn't there. Every conversation keeps its first segment, without turns if none are left.
    """
    most = modulus - 1
    heads = (
        found.where((F.col("conv") % every == 0) & (F.col("before") < most))
        .select("conv", F.struct("before", F.expr(f"substring(digests, 1, {16 * most})").alias("digests"), F.slice("words", 1, most).alias("words")).alias("part"))
        .groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list("part")).alias("parts"))  # most rows at the most
    )
    joined = found.withColumn("base", F.col("conv") - F.col("conv") % every).join(heads, "base", "left").withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % modulus)
    schema = _SEQUENCE + ", before long"

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                head = b"".join(p["digests"] for p in r["parts"] or [])[: 16 * r["h"]]
                head_words = [w for p in r["parts"] or [] for w in p["words"]][: r["h"]]
                skip = max(0, r["h"] - r["before"])
                digests, words = r["digests"][16 * skip :], r["words"][skip:]
                if r["before"] == 0:
                    out.append((r["conv"], r["seq"], head + digests, head_words + words, 0))
                elif words:
                    out.append((r["conv"], r["seq"], digests, words, max(0, r["before"] - r["h"]) + len(head_words)))
            yield from _rows(out, schema)

    return joined.select("conv", "seq", "digests", "words", "before", "parts", F.col("h").cast("int").alias("h")).mapInArrow(rebuild, schema)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits depend on all bits (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _folded(digests: bytes, before: int) -> np.ndarray:
    """Running exclusive-or of the mixed (depth, digest) of a segment's turns: (turns, 2)."""
    halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
    depth = (before + 1 + np.arange(len(halves), dtype=np.uint64))[:, None] * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    return np.bitwise_xor.accumulate(_mixed(halves ^ _mixed(depth)), axis=0)


_SIGNED = "conv long, seq long, before long, first boolean, last boolean, root binary, sigs binary, words array<int>"


def signatures(found: DataFrame) -> DataFrame:
    """Columns: conv, seq, before, first, last (segment of its conversation), root (signature before the
    segment), sigs (16 bytes for each turn: of the prefix that ends with it), words."""
    schema = _SEQUENCE + ", before long, low long, high long"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, seq, digests, words, before in zip(*(batch.column(c).to_pylist() for c in ("conv", "seq", "digests", "words", "before")), strict=True):
                all_ = _folded(digests, before)
                low, high = all_[-1].astype(np.int64).tolist() if len(all_) else (0, 0)
                out.append((conv, seq, digests, words, before, low, high))
            yield from _rows(out, schema)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                root = np.array([r["low"], r["high"]], np.int64).astype(np.uint64).astype("<u8")
                out.append((r["conv"], r["seq"], r["before"], r["first"], r["last"], root.tobytes(), (_folded(r["digests"], r["before"]) ^ root).astype("<u8").tobytes(), r["words"]))
            yield from _rows(out, _SIGNED)

    ordered = Window.partitionBy("conv").orderBy("seq")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carried = found.mapInArrow(fold, schema).select(
        "conv", "seq", "digests", "words", "before",
        *(F.coalesce(F.bit_xor(c).over(before), F.lit(0)).cast("long").alias(c) for c in ("low", "high")),
        (F.row_number().over(ordered) == 1).alias("first"), F.lead("seq").over(ordered).isNull().alias("last"),
    )
    return carried.mapInArrow(sign, _SIGNED)


# ---- z-fast tries
def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] with the most trailing zeros."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class ZFastTrie:
    """A compacted trie of paths, each given by the signatures of its prefixes (16 bytes for each depth)."""

    def __init__(self) -> None:
        # Of each node: its edge covers depths start + 1 to end; a path that has it; members that end in it.
        self.start, self.end, self.path, self.parent = [0], [0], [-1], [-1]
        self.members, self.least = [0], [None]
        self.children: list[dict[bytes, int]] = [{}]
        self.handles: dict[bytes, int] = {}
        self.paths: list[bytes] = []
        self.looked_up = 0

    def _at(self, path: int, depth: int) -> bytes:
        return self.paths[path][16 * depth - 16 : 16 * depth]

    def _agree(self, path: bytes, node: int, low: int, high: int) -> int:
        """The depth in [low, high] up to which a path that agrees with the node at low does so."""
        other = self.paths[self.path[node]]
        while low < high:
            mid = (low + high + 1) // 2
            if path[16 * mid - 16 : 16 * mid] == other[16 * mid - 16 : 16 * mid]:
                low = mid
            else:
                high = mid - 1
        return low

    def exit_node(self, path: bytes) -> tuple[int, int]:
        """(node, depth): where the path leaves the trie, at the depth up to which it agrees with the node's edge."""
        n = len(path) // 16
        node, a, b = 0, 0, n
        while a < b:
            f = two_fattest(a, b)
            self.looked_up += 1
            found = self.handles.get(path[16 * f - 16 : 16 * f])
            if found is None:
                b = f - 1
                continue
            end = self.end[found]
            if end > n or self._at(self.path[found], end) != path[16 * end - 16 : 16 * end]:
                return found, self._agree(path, found, f, min(end, n))
            node, a = found, end
        at = self.end[node]
        if at < n:
            child = self.children[node].get(path[16 * at : 16 * at + 16])
            if child is not None:
                return child, self._agree(path, child, at + 1, min(self.end[child], n))
        return node, at

    def _hashed(self, node: int) -> None:
        self.handles[self._at(self.path[node], two_fattest(self.start[node], self.end[node]))] = node

    def _new(self, start: int, end: int, path: int, parent: int) -> int:
        node = len(self.start)
        for column, value in ((self.start, start), (self.end, end), (self.path, path), (self.parent, parent), (self.members, 0), (self.least, None), (self.children, {})):
            column.append(value)
        self.children[parent][self._at(path, start + 1)] = node
        return node

    def insert(self, path: bytes, member: tuple[int, int]) -> None:
        """Add a path of a member. Members that end at one node are counted; the least one is kept."""
        n = len(path) // 16
        node, depth = self.exit_node(path)
        if depth < self.end[node]:  # inside of its edge: the upper part becomes a node of its own
            upper = self._new(self.start[node], depth, self.path[node], self.parent[node])
            self.start[node], self.parent[node] = depth, upper
            self.children[upper][self._at(self.path[node], depth + 1)] = node
            self._hashed(node)
            self._hashed(upper)
            node = upper
        if depth < n:
            self.paths.append(path)
            node = self._new(depth, n, len(self.paths) - 1, node)
            self._hashed(node)
        self.members[node] += 1
        self.least[node] = member if self.least[node] is None else min(self.least[node], member)

    def totals(self) -> tuple[list[int], list[tuple[int, int]]]:
        """Members and least member of each node's subtree, bottom-up."""
        members, least = list(self.members), list(self.least)
        for node in sorted(range(1, len(self.start)), key=self.start.__getitem__, reverse=True):
            up = self.parent[node]
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
        return members, least


_NODE = "sig binary, parent binary, depth long, n long, conv long, seq long, words long"


def _fixed(blob: bytes) -> pa.Array:
    n = len(blob) // 16
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, 16 * n + 1, 16, dtype=np.int32).tobytes()), pa.py_buffer(blob)])


class _Batch:
    """The tries of a batch by the prefix at which their segments begin, and the segments' word counts."""

    def __init__(self) -> None:
        self.tries: dict[tuple[int, bytes], ZFastTrie] = {}
        self.words: dict[tuple[int, bytes], list[list[int]]] = {}
        self.turns = self.segments = 0

    def insert(self, root: tuple[int, bytes], sigs: bytes, words: list[int], member: tuple[int, int]) -> None:
        trie = self.tries.setdefault(root, ZFastTrie())
        had = len(trie.paths)
        trie.insert(sigs, member)
        if len(trie.paths) > had:
            self.words.setdefault(root, []).append(words)
        self.turns, self.segments = self.turns + len(words), self.segments + 1

    def expanded(self) -> Iterator[pa.RecordBatch]:
        """One row for each depth of each edge, and one for the root of all conversations."""
        names = [f.split()[0] for f in _NODE.split(", ")]
        for (before, root), trie in self.tries.items():
            members, least = trie.totals()
            if before == 0:
                yield pa.RecordBatch.from_arrays([_fixed(ROOT), pa.array([None], pa.binary()), *(pa.array([v], pa.int64()) for v in (0, members[0], *least[0], 0))], names)
            sigs, parents, numbers, held = [], [], [], 0
            for node in range(1, len(trie.start)):
                start, end = trie.start[node], trie.end[node]
                path, words = trie.paths[trie.path[node]], self.words[before, root][trie.path[node]]
                sigs.append(path[16 * start : 16 * end])
                parents.append(root + path[: 16 * end - 16] if start == 0 else path[16 * start - 16 : 16 * end - 16])
                edge = np.empty((5, end - start), np.int64)
                edge[0] = before + np.arange(start + 1, end + 1)
                edge[1:4] = [[members[node]], [least[node][0]], [least[node][1]]]
                edge[4] = words[start:end]
                numbers.append(edge)
                held += end - start
                if held > 1 << 14 or node == len(trie.start) - 1:
                    yield pa.RecordBatch.from_arrays([_fixed(b"".join(sigs)), _fixed(b"".join(parents)), *(pa.array(c) for c in np.concatenate(numbers, axis=1))], names)
                    sigs, parents, numbers, held = [], [], [], 0


def _inserted(signed: DataFrame, batch_turns: int, batch_segments: int) -> DataFrame:
    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = _Batch()
        for rows in batches:
            for conv, seq, before, root, sigs, words in zip(*(rows.column(c).to_pylist() for c in ("conv", "seq", "before", "root", "sigs", "words")), strict=True):
                batch.insert((before, root), sigs, words, (conv, seq))
                if batch.turns >= batch_turns or batch.segments >= batch_segments:
                    yield from batch.expanded()
                    batch = _Batch()
        yield from batch.expanded()

    return signed.mapInArrow(insert, _NODE)


# ---- subtrees and ends
def _suffix_sums(signed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Columns: sig, n_leaves, saved: sums over subtrees, as suffix sums along the paths of nodes' owners."""
    owned = nodes.groupBy("conv", "seq").agg(
        F.collect_list(F.struct("depth", "gain", "leaf")).alias("owned"),  # of one segment
        F.sum("gain").alias("gain"), F.sum("leaf").alias("leaf"),
    )
    after = Window.partitionBy("conv").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
    schema = "sig binary, n_leaves long, saved long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, first = len(r["sigs"]) // 16, int(r["first"])  # the first segment has the root too
                gain, leaf = np.zeros(n + first + 1, np.int64), np.zeros(n + first + 1, np.int64)
                gain[-1], leaf[-1] = r["gain_after"], r["leaf_after"]
                for o in r["owned"] or []:
                    at = o["depth"] - r["before"] - 1 + first
                    gain[at], leaf[at] = o["gain"], o["leaf"]
                gain, leaf = (np.cumsum(x[::-1])[::-1][:-1] for x in (gain, leaf))
                if len(gain):
                    yield pa.RecordBatch.from_arrays([_fixed((ROOT if first else b"") + r["sigs"]), pa.array(leaf), pa.array(gain)], ["sig", "n_leaves", "saved"])

    joined = signed.join(owned, ["conv", "seq"], "left").select(
        "conv", "before", "first", "sigs", "owned",
        *(F.coalesce(F.sum(c).over(after), F.lit(0)).cast("long").alias(f"{c}_after") for c in ("gain", "leaf")),
    )
    # A conversation that owns nothing from here on adds nothing.
    used = joined.where(F.col("owned").isNotNull() | (F.col("gain_after") > 0) | (F.col("leaf_after") > 0))
    return used.mapInArrow(sums, schema).groupBy("sig").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _ends(signed: DataFrame, id_text: int) -> DataFrame:
    """Columns: sig, ends: SHA-256 of the ascending ids of the conversations that end at a node.

    Ids are put together to pieces of id_text bytes in sorted partitions, in parallel for a hot node too;
    a hash is sequential, so a node's pieces are read in order by one task, one piece at a time.
    """
    piece = "sig binary, conv long, ids string"
    last = signed.where("last").select(F.when(F.octet_length("sigs") > 0, F.expr("substring(sigs, octet_length(sigs) - 15, 16)")).otherwise(F.col("root")).alias("sig"), "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first, ids, size, done = None, None, [], 0, []
        for batch in batches:
            for sig, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (sig != current or size >= id_text):
                    done.append((current, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    current, first = sig, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield from _rows(done, piece)
            done = []
        if ids:
            yield from _rows([(current, first, ",".join(ids))], piece)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, done = None, None, []
        for batch in batches:
            for sig, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if sig == current:
                    digest.update(b",")
                else:
                    if current is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = sig, hashlib.sha256()
                digest.update(ids.encode())
            yield from _rows(done, "sig binary, ends string")
            done = []
        if current is not None:
            yield from _rows([(current, digest.hexdigest())], "sig binary, ends string")

    cut_up = last.repartitionByRange("sig", "conv").sortWithinPartitions("sig", "conv").mapInArrow(pieces, piece)
    return cut_up.repartition("sig").sortWithinPartitions("sig", "conv").mapInArrow(hashes, "sig binary, ends string")


def trie_of(found: DataFrame, *, batch_turns: int = BATCH_TURNS, batch_segments: int = BATCH_SEGMENTS, id_text: int = ID_TEXT) -> DataFrame:
    """conversation_trie of segments, as segments or share_heads give them."""
    signed = stored(signatures(found), "signed-segments")
    nodes = _inserted(signed, batch_turns, batch_segments).groupBy("sig").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.sum("n").alias("n"),
        F.min(F.struct("conv", "seq")).alias("owner"), F.first("words").alias("words"),
    )
    nodes = stored(nodes.select("sig", "parent", "depth", "n", "owner.*", "words"), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("sig")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, "sig", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    owned = counted.select("conv", "seq", "depth", ((F.col("n") - 1) * F.col("words")).alias("gain"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    # A parent may have a third of all nodes as children: Spark's skew join splits them, parents are unique.
    parents = nodes.select(F.col("sig").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        counted.join(_suffix_sums(signed, owned), "sig").join(_ends(signed, id_text), "sig", "left").join(parents, "parent", "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves",
            F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each distinct sequence of first turns (role, text): conv_id (its smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens (over its subtree, words of
    the last text that members but one needn't have again), ends_sha256 (of the ids of members that end there).

    Turns are in order of turn, null first; turns that share a number in the order of a digest of their
    content; repeated rows are turns of their own. Null roles and texts are empty. Rows without a
    conversation id belong to no conversation. Without any conversation there is no node.
    """
    return trie_of(segments(conversations, segment, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col))
