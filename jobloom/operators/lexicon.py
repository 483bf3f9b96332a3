"""Registries looked up inside of rows: exact keys, and phrases by an automaton over the row's tokens.

A step that matches rows with a registry gets what it found as an array of the registry's entries beside
the row, so steps follow each other without a shuffle, a key of the rows or a join back. The registry
goes to all tasks while it has at most HELD_ROWS entries and HELD_BYTES, which is checked; beyond that the
same array is found by an equi-join of distinct inputs with the registry, with the same results.

Exact keys of registries of at most NATIVE_ROWS entries are looked up by built-in functions alone, in a constant
array of buckets: each step with a Python function that depends on the step before takes a Python worker of its own
for each core, so the chain has as few of these as it can.
"""

from __future__ import annotations

import json
import zlib
from collections import OrderedDict
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from jobloom.functions.normalise import PLAIN

HELD_ROWS, HELD_BYTES = 200_000, 32 << 20
NATIVE_ROWS = 2_000
#: Registries that the driver has fetched last; each is fetched once while it is among them.
REMEMBERED = 64

_held: OrderedDict[int, tuple[DataFrame, pa.Table | None]] = OrderedDict()
_derived: OrderedDict[tuple, tuple[tuple, DataFrame]] = OrderedDict()


def derived(name: str, build: Callable[..., DataFrame], *tables: DataFrame) -> DataFrame:
    """build(*tables), made once for the same tables while it is among the last, so that it is fetched once too."""
    key = (name, *map(id, tables))
    known = _derived.get(key)
    if known is None or any(a is not b for a, b in zip(known[0], tables, strict=True)):
        known = _derived[key] = (tables, build(*tables))
        while len(_derived) > REMEMBERED:
            _derived.popitem(last=False)
    return known[1]


def held(registry: DataFrame, most: int = HELD_ROWS) -> pa.Table | None:
    """The registry's entries, or None if they are more than may be sent to all tasks."""
    known = _held.get(id(registry))
    if known is None or known[0] is not registry:
        table = registry.limit(HELD_ROWS + 1).toArrow()
        known = (registry, table.combine_chunks() if table.num_rows <= HELD_ROWS and table.nbytes <= HELD_BYTES else None)
        _held[id(registry)] = known
        while len(_held) > REMEMBERED:
            _held.popitem(last=False)
    table = known[1]
    return table if table is not None and table.num_rows <= most else None


def _found_type(registry: DataFrame) -> ArrayType:
    return ArrayType(StructType([StructField("at", IntegerType()), *registry.schema.fields]))


def _entries(table: pa.Table, kind: ArrayType, offsets: list[int], ats: list[int], places: list[int]) -> pa.Array:
    """The array column of found entries: for each row those between its offsets."""
    rows = table.take(pa.array(places, pa.int64()))
    wanted = to_arrow_type(kind.elementType)
    columns = [pa.array(ats, pa.int32()), *(c.combine_chunks().cast(f.type) for c, f in zip(rows.columns, list(wanted)[1:], strict=True))]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(wanted)))


def _by_key(table: pa.Table, key: str) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for place, k in enumerate(table.column(key).to_pylist()):
        if k is not None:
            found.setdefault(k, []).append(place)
    return found


class PhraseAutomaton:
    """A trie of token sequences; a text is walked once from each of its tokens."""

    def __init__(self, phrases: list[str | None]) -> None:
        self.root: dict = {}
        for place, phrase in enumerate(phrases):
            tokens = (phrase or "").split(" ")
            if not phrase or "" in tokens:
                continue
            node = self.root
            for token in tokens:
                node = node.setdefault(token, {})
            node.setdefault("", []).append(place)  # no token is empty

    def hits(self, text: str) -> list[tuple[int, int]]:
        """(number of the first token from 1, place of the phrase) of every phrase in the text."""
        tokens = [t for t in text.split(" ") if t]
        found = []
        for start in range(len(tokens)):
            node, at = self.root.get(tokens[start]), start
            while node is not None:
                found.extend((start + 1, place) for place in node.get("", ()))
                at += 1
                node = node.get(tokens[at]) if at < len(tokens) else None
        return found


def _in_rows(table: pa.Table, kind: ArrayType, key: str, plain: Callable[[str], str] | None):
    """An Arrow UDF of texts, which plain normalises, or of arrays of keys; its index is built once for each task."""
    made: list = []

    def of_keys(keys: list[str | None] | None) -> list[tuple[int, int]]:
        return [(at, place) for at, k in enumerate(keys or (), 1) if k is not None for place in made[0].get(k, ())]

    @F.arrow_udf(kind)
    def find(values: pa.Array) -> pa.Array:
        if not made:
            made.append(PhraseAutomaton(table.column(key).to_pylist()) if plain else _by_key(table, key))
        offsets, ats, places, known = [0], [], [], {}
        for value in values.to_pylist():
            if plain:
                hits = known.get(value)
                if hits is None:
                    hits = known[value] = made[0].hits(plain(value)) if value else []
            else:
                hits = of_keys(value)
            for at, place in hits:
                ats.append(at)
                places.append(place)
            offsets.append(len(places))
        return _entries(table, kind, offsets, ats, places)

    return find


_PLAIN_TYPES = ("string", "boolean", "int", "bigint", "double", "array<string>")


def _buckets(registry: DataFrame, table: pa.Table, key: str) -> tuple[Column, int]:
    """The registry's entries as a constant array of buckets by the CRC-32 of their keys, and the number of buckets."""
    n = max(1, table.num_rows)
    buckets: list[list] = [[] for _ in range(n)]
    for entry in table.to_pylist():
        if entry[key] is not None:
            buckets[zlib.crc32(entry[key].encode()) % n].append(entry)
    fields = ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in registry.schema.fields)
    return F.from_json(F.lit(json.dumps(buckets, allow_nan=False)), f"array<array<struct<{fields}>>>"), n


def _natively(registry: DataFrame, table: pa.Table, key: str, keys: Column) -> Column:
    """What is found of keys, by built-in functions."""
    buckets, n = _buckets(registry, table, key)

    def of(k: Column, i: Column) -> Column:
        same = F.filter(F.get(buckets, F.pmod(F.crc32(k), F.lit(n)).cast("int")), lambda e: e[key] == k)
        return F.coalesce(F.transform(same, lambda e: F.struct((i + 1).alias("at"), *(e[c].alias(c) for c in registry.columns))), F.array().cast(_found_type(registry)))

    return F.coalesce(F.flatten(F.transform(keys, of)), F.array().cast(_found_type(registry)))


def _is_plain(registry: DataFrame) -> bool:
    return all(f.dataType.simpleString() in _PLAIN_TYPES for f in registry.schema.fields)


def _by_join(rows: DataFrame, probes: Column, registry: DataFrame, key: str, out: str) -> DataFrame:
    """The same array by an equi-join: probes, an array of (at, key), are exploded for distinct contents only."""
    given = once(once(rows, {"_probe": probes}), {"_value": F.md5(F.to_json("_probe"))})
    each = given.select("_value", "_probe").dropDuplicates(["_value"]).select("_value", F.explode("_probe").alias("p")).select("_value", F.col("p.at").cast("int").alias("_at"), F.col("p.key").alias("_key"))
    entries = registry.select(F.struct(*registry.columns).alias("_entry"), F.col(key).alias("_key"))
    made = F.struct(F.col("_at").alias("at"), *(F.col("_entry")[c].alias(c) for c in registry.columns))
    found = each.join(entries, "_key").groupBy("_value").agg(F.collect_list(made).alias(out))
    none = F.array().cast(_found_type(registry))
    return given.drop("_probe", out).join(found, "_value", "left").withColumn(out, F.coalesce(out, none)).drop("_value")


def lookup(rows: DataFrame, keys: Column, registry: DataFrame, key: str, out: str, most: int = HELD_ROWS) -> DataFrame:
    """Adds out: the registry's entries whose key is among keys (an array), as structs with "at", the key's number
    from 1. Null keys match nothing. The array's order is not defined: sort by what decides."""
    table = held(registry, most)
    if table is not None and table.num_rows <= NATIVE_ROWS and _is_plain(registry):
        return once(once(rows, {"_asked": keys}), {out: _natively(registry, table, key, F.col("_asked"))}).drop("_asked")
    if table is not None:
        return once(rows, {"_asked": keys}).withColumn(out, _in_rows(table, _found_type(registry), key, None)("_asked")).drop("_asked")
    rows = once(rows, {"_asked": F.coalesce(keys, F.array().cast("array<string>"))})
    numbered = F.filter(F.transform("_asked", lambda k, i: F.struct((i + 1).alias("at"), k.alias("key"))), lambda p: p["key"].isNotNull())
    return _by_join(rows, numbered, registry, key, out).drop("_asked")


def phrases_in(rows: DataFrame, text: str, normaliser: Callable, registry: DataFrame, key: str, out: str, most: int = HELD_ROWS) -> DataFrame:
    """Adds out: the registry's entries whose phrase is a run of the tokens of the normalised text, as structs with
    "at", the number of its first token from 1, one for each place. Tokens are what lies between single spaces.

    If rows have the column already they stay as they are: what depends on given columns only can be found for
    all steps in one pass over Python batches.
    """
    if out in rows.columns:
        return rows
    table = held(registry, most)
    if table is not None:
        return rows.withColumn(out, _in_rows(table, _found_type(registry), key, PLAIN[normaliser])(F.coalesce(F.col(text).cast(StringType()), F.lit(""))))
    longest = registry.agg(F.max(F.size(F.split(key, " ")))).first()[0] or 1
    return _by_join(once(rows, {"_text": normaliser(text)}), grams(F.col("_text"), longest), registry, key, out).drop("_text")


def normalised(rows: DataFrame, column: str, normaliser: Callable, out: str) -> DataFrame:
    """Adds out, the normalised column, unless it is there already."""
    return rows if out in rows.columns else rows.withColumn(out, normaliser(column))


def only(rows: DataFrame, before: DataFrame, *new: str) -> DataFrame:
    """The columns that were there before, and new ones."""
    return rows.select(*(c for c in before.columns if c not in new), *new)


def grams(text: Column, most: int) -> Column:
    """All runs of 1 to most tokens of a text of single-spaced tokens, with their first positions."""
    tokens = F.filter(F.split(text, " "), lambda x: x != "")
    empty = F.array().cast("array<struct<at:int,key:string>>")

    def runs(n: int) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.struct(i.alias("at"), F.array_join(F.slice(tokens, i, n), " ").alias("key")))
        return F.when(F.size(tokens) >= n, found).otherwise(empty)

    return F.concat(empty, *map(runs, range(1, most + 1)))


def ordered(found: str | Column, *order, **fields) -> Column:
    """The found entries as structs of fields (name -> function of an entry), sorted by order (functions of one)."""
    column = F.col(found) if isinstance(found, str) else found
    made = F.transform(column, lambda x: F.struct(*(o(x).alias(f"o{i}") for i, o in enumerate(order)), *(f(x).alias(n) for n, f in fields.items())))
    return F.sort_array(made)


def first(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))


def whole(value: Column) -> Column:
    """The same value, computed once in the plan: Catalyst would else write its expression out at each of its uses in
    Python functions and at each extraction of a field, and a chain of steps would grow exponentially in the plan."""
    return F.when(F.spark_partition_id() >= 0, value)


def together(rows: DataFrame, before: DataFrame) -> DataFrame:
    """The columns that rows have beyond those of before, computed once and in one layer of the plan: Catalyst would else
    put each Python function where its result is used, and take a worker for each of these places."""
    found = [c for c in rows.columns if c not in before.columns]
    return once(rows, {c: F.col(c) for c in found}) if found else rows


def once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """withColumns of values that are each computed once."""
    return rows.withColumns({name: whole(value) for name, value in columns.items()})
