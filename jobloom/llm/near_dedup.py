"""Near-duplicate groups by bottom-k sketches from one hash function.

A document is the set of its distinct two-word shingles; every shingle has one 64-bit hash, and a
sketch keeps the k smallest. Documents are linked if the Jaccard similarity of the full sets is 0.8
or more, and a group is a connected component of links. The steps:

1. Equal sets form one class; only class representatives go on.
2. Candidate groups: a list gathers the representatives that retain the same run of four values that
   follow each other in hash order. If J >= 0.8, i shared shingles are cut by at most i / 4 others,
   so some run of four is shared as soon as the sets have more than 16 shingles (two in a row in
   smaller ones, which get runs of two). Where a sketch holds the whole set this is certain; in
   larger sets a pair at exactly 0.8 is missed with a probability of about 2e-6 at k = 96. Lists of
   single values would be too long: natural shingles stand in hundreds of documents.
3. A list's first member is its leader, and all representatives that share a leader are compared
   inside one task: inverted lists of their retained values generate the overlaps of all pairs, the
   estimate from the union of two sketches (over the hash range that both cover) filters them, and full
   sets decide on what is left. Members linked to the leader are in its component already, so they
   aren't compared with each other, and only links that join components leave the task, fewer than
   there are members. Leaders with very many members or shingles are settled without bringing these
   together:
   a. Members linked to the leader b against the others: by the triangle inequality of the Jaccard
      distance only for J with b of 0.6 or more. Write a set x as its difference from b. If u isn't
      linked to b but to x, the differences of u and x must overlap in at least about half of x's
      (from |u ^ x| <= (|u| + |x|) / 9), so a prefix of the differences, elements that b hasn't
      first, finds the pair. Copies of one text share few such elements.
   b. The others among themselves: a prefix filter over full sets, rarest shingles first, which
      finds every pair with J >= 0.8.
   Their candidates are filtered by the union sketch and verified on full sets.
4. The components of all links are labelled by alternating star contractions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm._common import as_bytes, cut, slices, stored, text_rows

SKETCH = 96
RUN, SHORT_RUN = 4, 2
SHORT_SET, LONG_SET = 16, 13  # sets of up to SHORT_SET get short runs, those from LONG_SET on long ones
GROUP_LIMIT = 8192
SHINGLE_LIMIT = 4_000_000  # of a leader's group in one task: by estimate 100 bytes each with the work arrays, not measured
BLOCK = 1024
MAYBE = 0.5  # 0.8 less more than seven standard errors of an estimate from 96 values: a link is below it in 1 of 10**9
HEAVY = 200_000
BROADCAST_IDS = 1_000_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_hashes = _WordHashes()


def shingle_set(raw: bytes, width: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole sequence if it is shorter."""
    words = raw.lower().split()  # on bytes: A-Z only, and cut at 0x20 and 0x09-0x0D only
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    for _ in range(min(width, len(words)) - 1):
        h = (h[:-1] * _A) ^ (h[1:] * _B + (h[1:] >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        h *= _B
        h ^= h >> np.uint64(29)
    return np.unique(h)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate([np.empty(0, np.int64), *rows])
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def sketches(docs: DataFrame, width: int = 2, k: int = SKETCH, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_shingles, set_key (16 bytes that name the set; null if empty), sketch."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = [shingle_set(raw or b"", width) for raw in as_bytes(batch.column(1))]
            keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            # The upper 31 bits keep the order and are enough to tell retained values apart.
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()), _lists([x[:k] >> np.uint64(33) for x in sets], pa.int32())], ["doc_id", "n_shingles", "set_key", "sketch"])

    return text_rows(docs, id_col, text_col).mapInArrow(make, "doc_id long, n_shingles long, set_key binary, sketch array<int>")


def _run_keys(reps: DataFrame) -> DataFrame:
    """(key, rep) for every run of retained values."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            offsets = batch.column(2).offsets.to_numpy()
            flat = batch.column(2).values.to_numpy().astype(np.uint64) + np.uint64(1)
            owner = np.repeat(np.arange(len(rep)), np.diff(offsets))
            for run, wanted in ((RUN, n >= LONG_SET), (SHORT_RUN, n <= SHORT_SET)):
                if len(flat) < run:
                    continue
                m = len(flat) - run + 1
                key = np.full(m, run, np.uint64)
                for j in range(run):
                    key = (key ^ flat[j : j + m]) * _A
                    key ^= key >> np.uint64(31)
                ok = (owner[:m] == owner[run - 1 :]) & wanted[owner[:m]]
                yield pa.RecordBatch.from_arrays([pa.array(key[ok].view(np.int64)), pa.array(rep[owner[:m][ok]])], ["key", "rep"])

    return reps.select("rep", "n", "sketch").mapInArrow(make, "key long, rep long")


def _sets(docs: DataFrame, width: int, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """Full sets (rep, n, elems) of the wanted classes (rep, doc, set_key); doc is the id of a row with the set."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sets = [shingle_set(raw or b"", width) for raw in as_bytes(batch.column(1))]
            keys = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), _lists([x.view(np.int64) for x in sets], pa.int64())], ["doc", "set_key", "n", "elems"])

    ids = wanted.select(F.col("doc").alias("doc_id")).distinct()
    if ids.count() <= BROADCAST_IDS:  # 8 MB; beyond that the texts are shuffled by id instead
        ids = F.broadcast(ids)
    rows = text_rows(docs, id_col, text_col).join(ids, "doc_id", "left_semi").mapInArrow(make, "doc long, set_key binary, n long, elems array<long>")
    if wanted.where("rep != doc").isEmpty():  # a class is named by an id of its own, so the set's key needn't be looked at
        return rows.select(F.col("doc").alias("rep"), "n", "elems").dropDuplicates(["rep"])
    return rows.join(wanted, ["doc", "set_key"]).select("rep", "n", "elems").dropDuplicates(["rep"])


def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """pairs (a, b) with the columns of both, suffixed by _a and _b."""
    for side in ("b", "a"):
        pairs = pairs.join(table.select(F.col("rep").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs


def _estimated(pairs: DataFrame, sketched: DataFrame, k: int) -> DataFrame:
    """pairs (a, b) with est: the share of the union's k smallest values that both sketches hold."""
    least = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    both = F.array_intersect("sketch_a", "sketch_b")
    return _sides(pairs, sketched, "sketch").select("a", "b", (F.size(F.array_intersect(least, both)) / F.size(least)).alias("est"))


def _linked(shared: str = "shared") -> F.Column:
    return 100 * F.col(shared) >= 80 * (F.col("n_a") + F.col("n_b") - F.col(shared))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= 80 * union of their full sets."""
    return _sides(pairs, sets, "n", "elems").withColumn("shared", F.size(F.array_intersect("elems_a", "elems_b"))).where(_linked()).select("a", "b")


def _ring_pairs(near: DataFrame) -> DataFrame:
    """Step 3a. near: (a leader, b member, n_a, n_b, shared, diff, linked) -> candidate pairs (a, b)."""
    ring = ~F.col("linked") & (F.col("shared") >= 0.6 * (F.col("n_a") + F.col("n_b") - F.col("shared")) - 1e-6)
    tagged = near.where(ring | F.col("linked"))
    both = tagged.groupBy("a").agg(F.bool_and("linked").alias("all"), F.bool_or("linked").alias("any")).where("not all and any").select("a")
    size = F.size("diff")
    half = F.greatest(F.lit(1), F.floor((size + (F.col("n_a") - F.col("n_b")) / 9.0) / 2))
    whole = F.greatest(F.lit(1), F.floor((size - (F.col("n_a") + F.col("n_b")) / 9.0) / 2))
    # diff lists what the member has and the leader hasn't first, so prefixes hold mostly that.
    prefix = F.slice("diff", 1, (size - F.when(F.col("linked"), half).otherwise(whole) + 1).cast("int"))
    keyed = tagged.join(both, "a", "left_semi").select("a", "b", "linked", F.explode(prefix).alias("elem"))
    left = keyed.where("not linked").select("a", "elem", F.col("b").alias("x"))
    right = keyed.where("linked").select("a", "elem", F.col("b").alias("y"))
    return left.join(right, ["a", "elem"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _counts(rows: np.ndarray, values: np.ndarray, owner: np.ndarray, m: int) -> np.ndarray:
    """How many values each of the chosen rows has in common with each of the m owners."""
    place = np.full(m, -1)
    place[rows] = np.arange(len(rows))
    ours = np.unique(values[place[owner] >= 0])
    at = np.searchsorted(ours, values)
    hit = (at < len(ours)) & (ours[np.minimum(at, len(ours) - 1)] == values)
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    edges = np.flatnonzero(np.diff(at)) + 1
    common = np.zeros((len(rows), m), np.int32)
    for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(at)], strict=True):
        who = owner[i:j]
        mine = place[who]
        mine = mine[mine >= 0]
        if len(mine) and j - i > 1:
            common[np.ix_(mine, who)] += 1
    return common


def _alike(rows: np.ndarray, sets: list[np.ndarray], k: int) -> np.ndarray:
    """Estimated Jaccard similarity of the chosen sets with all, from the union of their sketches.

    Up to the smaller of the two sketches' last values both sets are known in full, so the share of
    common values in that range, at least k values or all, is an unbiased sample of the union.
    """
    sketch = [x[:k] for x in sets]
    top = np.array([x[-1] if len(s) > k else np.iinfo(np.uint64).max for x, s in zip(sketch, sets, strict=True)], np.uint64)
    both = _counts(rows, np.concatenate(sketch), np.repeat(np.arange(len(sets)), [len(x) for x in sketch]), len(sets))
    union = -both
    for j, x in enumerate(sketch):
        union[:, j] += np.searchsorted(x, np.minimum(top[rows], top[j]), "right").astype(np.int32)
    for i, row in enumerate(rows.tolist()):
        union[i] += np.searchsorted(sketch[row], np.minimum(top, top[row]), "right").astype(np.int32)
    return both / np.maximum(union, 1)


def group_links(ids: np.ndarray, sets: list[np.ndarray], k: int = SKETCH) -> list[tuple[int, int]]:
    """Links of J >= 0.8 that join the members of a group into components; ids[0] is the leader."""
    m, sizes = len(sets), np.array([len(x) for x in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    shared = np.add.reduceat(np.isin(flat, sets[0]).astype(np.int64), np.cumsum(sizes) - sizes)
    linked = (100 * shared >= 80 * (sizes + sizes[0] - shared)) & (_alike(np.array([0]), sets, k)[0] >= MAYBE)
    out = [(int(ids[0]), int(x)) for x in ids[1:][linked[1:]]]
    label = np.where(linked, 0, np.arange(m))
    others = np.flatnonzero(~linked)
    if not len(others) or m < 3:
        return out
    for at in range(0, len(others), BLOCK):
        rows = others[at : at + BLOCK]
        maybe = _alike(rows, sets, k) >= MAYBE
        maybe[np.arange(len(rows)), rows] = False
        some = maybe.any(1)
        rows, maybe = rows[some], maybe[some]
        if not len(rows):
            continue
        common = _counts(rows, flat, owner, m)
        links = maybe & (100 * common >= 80 * (sizes[rows][:, None] + sizes[None, :] - common))
        for i, row in enumerate(rows.tolist()):
            near = np.flatnonzero(links[i])
            for other in np.unique(label[near]).tolist():
                if other != label[row]:
                    x = int(near[label[near] == other][0])
                    out.append((int(min(ids[row], ids[x])), int(max(ids[row], ids[x]))))
                    label[label == other] = label[row]
    return out


def _links_by_leader(star: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """star: (a leader, b member) -> links (a, b). A task gets a leader's sets together, one leader after the other."""
    members = star.union(star.select("a", F.col("a").alias("b")).distinct())
    rows = members.join(sets.select(F.col("rep").alias("b"), "elems"), "b").select("a", "b", "elems")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, ids, held = None, [], []
        found: list[tuple[int, int]] = []

        def give() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])
            found.clear()
            return made

        for batch in batches:
            elems = batch.column(2)
            values, cuts = elems.values.to_numpy().view(np.uint64), elems.offsets.to_numpy()
            for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if a != leader:
                    if len(ids) > 1:
                        found += group_links(np.array(ids), held, k)
                    leader, ids, held = a, [], []
                ids.append(b)
                held.append(values[cuts[i] : cuts[i + 1]].copy())
            yield give()
        if len(ids) > 1:
            found += group_links(np.array(ids), held, k)
        yield give()

    return rows.repartition("a").sortWithinPartitions("a", "b").mapInArrow(compare, "a long, b long")


def _rarest_first_pairs(sets: DataFrame) -> DataFrame:
    """All pairs of sets that can have J >= 0.8, by a prefix filter with the rarest elements first.

    Any order of the elements that is the same for all sets is right; the counts that make it a good
    one are of the HEAVY elements that occur most, as far as they repeat within a batch.
    """

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elem, n = np.unique(batch.column(2).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(elem[n > 1]), pa.array(n[n > 1])], ["elem", "n"])

    counted = sets.mapInArrow(repeats, "elem long, n long").groupBy("elem").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "elem").limit(HEAVY).toArrow()
    order = np.argsort(counted["elem"].to_numpy())
    heavy = sets.sparkSession.sparkContext.broadcast((counted["elem"].to_numpy()[order], counted["n"].to_numpy()[order]))  # at most HEAVY

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = heavy.value
        for batch in batches:
            rep, n, elems = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            out, owner = [np.empty(0, np.int64)], []
            for i in range(batch.num_rows):
                own = elems[i].values.to_numpy()
                at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
                weight = np.where(known[at] == own, often[at], 0) if len(known) else np.zeros(len(own))
                kept = own[np.lexsort((own, weight))][: len(own) - -(-4 * len(own) // 5) + 1]
                out.append(kept)
                owner += [i] * len(kept)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array([rep[i] for i in owner], pa.int64()), pa.array([n[i] for i in owner], pa.int64())], ["elem", "rep", "n"])

    prefix = sets.select("rep", "n", "elems").mapInArrow(prefixes, "elem long, rep long, n long")
    x, y = prefix.toDF("elem", "a", "n_a"), prefix.toDF("elem", "b", "n_b")
    return x.join(y, "elem").where("a < b and 5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)").select("a", "b")


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """links (a, b) -> (rep, component): the smallest id that is reachable, for every id in a link."""
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.toDF("u", "v")).distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if now == state:
            return edges.select(F.col("u").alias("rep"), F.col("v").alias("component"))
        state = now
    raise RuntimeError(f"links of the components did not settle in {rounds} rounds")


def _links_of_crowds(star: DataFrame, sets: DataFrame, sketched: DataFrame, k: int) -> DataFrame:
    """Links among the members of leaders that have too many, or too large ones, for one task."""
    full = _sides(star, sets, "n", "elems")
    # What the member has and the leader hasn't comes first; what it lacks is marked by the complement.
    diff = F.concat(F.array_except("elems_b", "elems_a"), F.transform(F.array_except("elems_a", "elems_b"), F.bitwise_not))
    near = stored(full.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("elems_a", "elems_b")).alias("shared"), diff.alias("diff")).withColumn("linked", _linked()), "near")
    others = star.join(near.where("linked").select("a", "b"), ["a", "b"], "left_anti").select(F.col("b").alias("rep")).distinct()
    pairs = cut(_ring_pairs(near).union(_rarest_first_pairs(sets.join(others, "rep", "left_semi"))).distinct())
    maybe = _estimated(pairs, sketched, k).where(F.col("est") >= MAYBE).select("a", "b")
    return near.where("linked").select("a", "b").union(_verified(maybe, sets))


def near_duplicates(docs: DataFrame, width: int = 2, k: int = SKETCH, group_limit: int = GROUP_LIMIT, shingle_limit: int = SHINGLE_LIMIT, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, n_shingles, component_id, kept; one row for each row of docs.

    component_id is the smallest doc_id reachable over links, kept is doc_id = component_id. Null
    and empty texts and those without a word have no shingles and are linked with nothing. Rows with
    a null id take part in no link: component_id is null and they are kept. Where rows repeat an id with
    unlike texts, each row is linked by its own text: component_id is the smallest doc_id of the rows that
    this row reaches, so rows of one id may be in different components. An empty table gives no rows.
    """
    base = stored(sketches(docs, width, k, id_col=id_col, text_col=text_col), "sketches")
    named = base.where("set_key is not null and doc_id is not null")
    classes = stored(named.groupBy("set_key").agg(F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n"), F.any_value("sketch").alias("sketch")).withColumn("rep", F.col("doc")), "classes")
    shared = cut(classes.groupBy("doc").count().where("count > 1").select("doc"))
    repeated = not shared.isEmpty()
    if repeated:  # an id names several classes: these get negative names from their sets
        again = classes.join(shared.withColumn("again", F.lit(True)), "doc", "left")
        classes = stored(again.withColumn("rep", F.when(F.col("again"), -1 - F.pmod(F.xxhash64("set_key"), F.lit(1 << 62))).otherwise(F.col("doc"))).drop("again"), "classes")

    rows = _run_keys(classes).repartition("key")
    leaders = rows.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("members")).where("members > 1")
    star = cut(rows.join(leaders, "key").where("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    wanted = cut(star.select(F.col("a").alias("rep")).union(star.select("b")).distinct())
    sets = stored(_sets(docs, width, id_col, text_col, classes.select("rep", "doc", "set_key").join(wanted, "rep", "left_semi")), "sets")

    groups = _sides(star, classes, "n").groupBy("a").agg(F.count("*").alias("members"), (F.sum("n_b") + F.max("n_a")).alias("shingles"))
    crowds = cut(groups.where((F.col("members") > group_limit) | (F.col("shingles") > shingle_limit)).select("a"))
    small = star.join(crowds, "a", "left_anti")
    links = _links_by_leader(small, sets, k)
    if crowds.count():
        sketched = cut(classes.select("rep", "sketch").join(wanted, "rep", "left_semi"))
        links = links.union(_links_of_crowds(star.join(crowds, "a", "left_semi"), sets, sketched, k))

    labels = components(links)
    of_class = classes.select("set_key", "rep", "doc").join(labels, "rep", "left").select("set_key", "doc", F.coalesce("component", "rep").alias("component"))
    if repeated:  # components are named by rep so far
        least = of_class.groupBy("component").agg(F.min("doc").alias("least"))
        of_class = of_class.join(least, "component").select("set_key", F.col("least").alias("component"))
    of_class = of_class.select("set_key", "component")
    return (
        base.select("doc_id", "n_shingles", "set_key")
        .join(of_class, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
