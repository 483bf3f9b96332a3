"""Inputs for extraction queries: phrases dealt to the rows of a table by key arithmetic.

The prose of the given tables is invented, so extractors would find nothing in it. A Case deals phrases
to all rows of orders by the order's key; what must come out is known phrase by phrase, and the SQL
states that, row by row, without any extraction.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _quoted(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "long": "BIGINT"}


@dataclass
class Case:
    """inputs: column -> a value for each of n rows in turn; expected: column -> (type, value for each)."""

    inputs: dict[str, list]
    expected: dict[str, tuple[str, list]]
    run: Callable[[DataFrame], DataFrame]
    #: Columns that differ from row to row, as feeds' texts do: what varied() adds has no meaning to the step.
    vary: dict[str, str] = field(default_factory=dict)

    @property
    def n(self) -> int:
        return len(next(iter(self.inputs.values())))

    def query(self) -> Callable[[SparkSession, str], DataFrame]:
        def go(spark: SparkSession, sf_dir: str) -> DataFrame:
            keys = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k")))
            row = F.pmod(F.col("k"), F.lit(self.n)).cast("int")
            # As in raw feeds, three postings share an id, and every fifth has none.
            identity = F.when(F.col("k") % 5 != 0, F.floor(F.col("k") / 3).cast("string"))
            dealt = keys.select("k", identity.alias("id"), *(varied(_dealt(values, row), self.vary.get(c)).alias(c) for c, values in self.inputs.items()))
            out = self.run(dealt)
            return out.select(F.col("k").cast("long").alias("k"), *(F.col(c).cast(kind if kind != "long" else "bigint").alias(c) for c, (kind, _) in self.expected.items()))

        return go

    def sql(self) -> str:
        picks = []
        for c, (kind, values) in self.expected.items():
            arms = " ".join(f"WHEN {i} THEN {_quoted(v)}" for i, v in enumerate(values))
            picks.append(f"CAST(CASE o_orderkey % {self.n} {arms} END AS {SQL_TYPES[kind]}) AS {c}")
        return f"SELECT CAST(o_orderkey AS BIGINT) AS k, {', '.join(picks)} FROM orders"


def _dealt(values: list, row: Column) -> Column:
    first = next((v for v in values if v is not None), None)
    if isinstance(first, list):
        lits = [F.lit(None).cast("array<string>") if v is None else F.array(*map(F.lit, v)).cast("array<string>") for v in values]
    else:
        kind = "boolean" if isinstance(first, bool) else "bigint" if isinstance(first, int) else "double" if isinstance(first, float) else "string"
        lits = [F.lit(v).cast(kind) for v in values]
    return F.element_at(F.array(*lits), row + 1)


def varied(value: Column, how: str | None) -> Column:
    """A dealt value with the row's key in it: as a word, as digits of another script (which names lose when they are
    normalised), as a part of a URL's path, or as one more element. Nulls stay."""
    key = F.col("k").cast("string")
    if how == "word":
        return F.concat(value, F.lit(" "), key)
    if how == "digits":
        return F.concat(value, F.lit(" "), F.translate(key, "0123456789", "٠١٢٣٤٥٦٧٨٩"))
    if how == "path":
        return F.concat(value, F.lit("/"), key)
    return F.concat(value, F.array(F.concat(F.lit("unlisted "), key))) if how == "element" else value


#: The most rows of a task, on average: what a task and its Python workers hold doesn't grow with the table.
TASK_ROWS = 250_000


def spread(keys: DataFrame) -> DataFrame:
    """The keys over all cores: the given tables are one small file each, and steps without a shuffle would run as one task.
    Large tables take more tasks, by their rows (a count that reads the files' footers), so that cores which are not there
    yet, or are slow, don't decide how much work one task has."""
    cores = keys.sparkSession.sparkContext.defaultParallelism
    return keys.repartition(cores * max(1, -(-keys.count() // (TASK_ROWS * cores))))


def joined(value: Column | str) -> Column:
    """An array as one string, so that results compare alike everywhere."""
    return F.array_join(value, "|")
