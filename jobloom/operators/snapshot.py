"""Snapshots: reading, staged writing, comparison and upgrade."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields that older readers consume.
LEGACY_FIELDS = [
    "id", "title", "opportunity_type", "work_mode", "seniority", "categories", "skills_required", "skills_preferred", "posted_at", "deadline", "deadline_confidence", "compensation", "apply_url", "apply_is_official", "flags", "eligibility_notes", "summary",
    "raw_description_url", "industry", "specialisations", "years_experience_min", "years_experience_max", "education_required", "education_field", "languages_required", "contract_type",
]
LEGACY_STRUCTS = {"organisation": ["name", "type", "verified"], "location": ["raw", "country", "region", "is_remote_from_kenya", "scope", "relocation_country"], "source": ["name", "url", "confidence", "last_seen_at"]}


def legacy_projection(postings: DataFrame) -> DataFrame:
    """Only the fields and nested fields that older readers consume, as far as the table has them."""
    top = [F.col(c) for c in LEGACY_FIELDS if c in postings.columns]
    nested = []
    for name, wanted in LEGACY_STRUCTS.items():
        if name in postings.columns:
            own = [f.name for f in postings.schema[name].dataType.fields]
            nested.append(F.struct(*(F.col(f"{name}.{c}") for c in wanted if c in own)).alias(name))
    return postings.select(*top, *nested)


def row_digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def changes(before: DataFrame, after: DataFrame, id_col: str = "id", order_col: str = "pos") -> DataFrame:
    """(id, change) for rows that are missing, added, moved, or changed in their legacy fields. Empty if
    the migration was additive. Both tables carry their order."""

    def keyed(rows: DataFrame, tag: str) -> DataFrame:
        legacy = legacy_projection(rows)
        extra = rows.select(F.col(id_col).alias("i"), F.col(order_col).alias(f"pos_{tag}"), row_digest([c for c in legacy.columns if c in rows.columns and c not in LEGACY_STRUCTS]).alias(f"digest_{tag}"))
        return extra

    both = keyed(before, "a").join(keyed(after, "b"), "i", "full")
    kind = F.when(F.col("pos_b").isNull(), "missing").when(F.col("pos_a").isNull(), "added").when(F.col("digest_a") != F.col("digest_b"), "changed").when(F.col("pos_a") != F.col("pos_b"), "moved")
    return both.select(F.col("i").alias("id"), kind.alias("change")).where("change is not null")


def needs_upgrade(postings: DataFrame, version: str, current: str, profiles: list[str]) -> bool:
    """An old version, or any row that lacks a profile."""
    missing = [p for p in profiles if p not in postings.columns]
    if version != current or missing:
        return True
    lacking = F.lit(False)
    for p in profiles:
        lacking = lacking | F.col(p).isNull()
    return not postings.where(lacking).limit(1).isEmpty()


def same_vocabulary(left: DataFrame, right: DataFrame) -> DataFrame:
    """(value, only_in) for values on one side only."""
    return left.exceptAll(right).toDF("value").withColumn("only_in", F.lit("left")).union(right.exceptAll(left).toDF("value").withColumn("only_in", F.lit("right")))


def read_feed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a feed file {meta, opportunities: [...]}, in their order; fields an older one lacks are null."""
    feed = spark.read.schema(f"meta map<string,string>, opportunities array<struct<{schema}>>").json(path, multiLine=True)
    return feed.select(F.posexplode("opportunities").alias("pos", "o")).select("pos", "o.*")


def read_snapshot(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet snapshot read with the current schema, never an inferred one."""
    return spark.read.schema(schema).parquet(path)


class Rejected(ValueError):
    """A result that must not replace the one before."""


class Overtaken(RuntimeError):
    """Another writer published while this result was checked, again and again."""


def _versions(spark: SparkSession, root: str):
    """(file system, folder of the pointers) of a root, through Spark's own Hadoop configuration."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/versions")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _latest(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """(number, path) of the version that was published last; (0, None) if there is none."""
    fs, folder = _versions(spark, root)
    names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())
    if not numbers:
        return 0, None
    return numbers[-1], spark.read.text(f"{root.rstrip('/')}/versions/v{numbers[-1]:012d}").first()[0]


def _claim(spark: SparkSession, root: str, number: int, path: str) -> bool:
    """Make the pointer of a number, unless it is there: the file is written aside and renamed, and a rename to a name
    that exists fails, so of two writers one gets the number and no reader sees half a pointer."""
    fs, folder = _versions(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(folder)
    aside, target = hadoop(folder, f"_{uuid.uuid4().hex}"), hadoop(folder, f"v{number:012d}")
    out = fs.create(aside, False)
    out.write(bytearray(path.encode()))
    out.close()
    won = not fs.exists(target) and fs.rename(aside, target)
    if not won:
        fs.delete(aside, False)
    return won


def publish(rows: DataFrame, root: str, minimum_rows: int = 1, keep_share: float = 0.5, attempts: int = 5) -> str:
    """Write to a fresh folder under root, check it, and only then point the root at it.

    A result with too few rows, or with less than keep_share of the last one's, is refused and the last
    one stays. Nothing is overwritten in place. The pointer is a numbered file that only one writer can make: one
    who finds the number taken compares its result with what was published meanwhile, and takes the next number.
    """
    spark = rows.sparkSession
    path = f"{root.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    n = spark.read.parquet(path).count()
    for _ in range(attempts):
        number, last = _latest(spark, root)
        before = 0 if last is None else spark.read.parquet(last).count()
        if n < minimum_rows or n < keep_share * before:
            raise Rejected(f"{n} rows, {before} before: the snapshot before stays")
        if _claim(spark, root, number + 1, path):
            return path
    raise Overtaken(f"{attempts} others published first")


def current(spark: SparkSession, root: str) -> str | None:
    """The path of the snapshot that was published last."""
    return _latest(spark, root)[1]


def quality_repair(postings: DataFrame, defaults: DataFrame, african_codes: list[str]) -> tuple[DataFrame, DataFrame]:
    """U4: (repaired rows, removal counters). Institution defaults leave the role's fields (J17); rows with a
    generic title (P10), out of scope (P8) or with a foreign code in the place (P18) go, each counted once."""
    from jobloom.operators.matching import repair_source_defaults
    from jobloom.operators.predicates import foreign_iso_token, official_scope
    from jobloom.sources.pages import valid_title

    rows = repair_source_defaults(postings, defaults)
    why = F.when(~valid_title("title", "org_name"), "generic_title").when(F.coalesce(foreign_iso_token("location_raw", african_codes), F.lit(False)), "foreign_place").when(~official_scope("opted_in", "is_african", "country_code", "title", "summary"), "out_of_scope")
    judged = rows.withColumn("removed_for", why)
    return judged.where("removed_for is null").drop("removed_for"), judged.where("removed_for is not null").groupBy("removed_for").count()
