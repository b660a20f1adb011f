"""Plan of clean, clash-free file names. Only a plan: no object is moved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import paths
from cohortloom.operators.running import ordered_ranges, running_total
from cohortloom.sources.storage import materialize

FAMILY = ["dir", "stem", "ext"]
NUMBERS_PER_RANGE = 4096


def sanitized_keys(keys: DataFrame, key: str = "key") -> DataFrame:
    """`(old_key, dir, old_name, new_name, changed)`; only .csv names are cleaned."""
    name = paths.base_name(F.col(key))
    clean = F.when(name.rlike(paths.CSV_SUFFIX), paths.sanitize_file_name(name)).otherwise(name)
    return keys.select(
        F.col(key).alias("old_key"),
        paths.directory(F.col(key)).alias("dir"),
        name.alias("old_name"),
        clean.alias("new_name"),
        (clean != name).alias("changed"),
    )


def rename_plan(keys: DataFrame, key: str = "key") -> DataFrame:
    """`(old_key, new_key, changed)` with a distinct target for every listed key.

    Names that are already clean keep their place. Of the files that clean to one free
    name, the first in name order gets it; the others, and all of them when the name is
    in use, get the lowest free `_n` suffixes in name order. A directory or a clash of
    any size is worked on in ordered ranges, never in one task.
    """
    named = sanitized_keys(keys, key).withColumns(
        {"stem": paths.stem_of(F.col("new_name")), "ext": paths.extension_of(F.col("new_name"))}
    )
    named = ordered_ranges(named, [*FAMILY, "old_name"], "range")

    kept = named.where("not changed").select(*FAMILY, F.lit(1).alias("in_use")).distinct()
    moving = named.where("changed").withColumn("one", F.lit(1).cast("bigint"))
    claims = running_total(moving, FAMILY, "range", ["old_name"], "one", "before")
    claims = claims.join(kept, FAMILY, "left").withColumn(
        "nth", F.col("before") + F.coalesce("in_use", F.lit(0))
    )
    claims = materialize(claims, "claims")  # four consumers follow
    first = claims.where("nth = 0").withColumn("suffix", F.lit(""))
    extra = claims.where("nth > 0")
    numbered = extra.join(_suffix_numbers(extra, named), [*FAMILY, "nth"]).withColumn(
        "suffix", F.concat(F.lit("_"), F.col("number").cast("string"))
    )
    columns = ["old_key", *FAMILY, "suffix", "changed"]
    settled = named.where("not changed").withColumn("suffix", F.lit(""))
    everything = settled.select(columns).unionAll(first.select(columns)).unionAll(
        numbered.select(columns)
    )
    prefix = F.when(F.col("dir") == "", F.lit("")).otherwise(F.concat("dir", F.lit("/")))
    new_key = F.when(F.col("changed"), F.concat(prefix, "stem", "suffix", "ext"))
    return everything.select(
        "old_key", F.coalesce(new_key, F.col("old_key")).alias("new_key"), "changed"
    )


def _suffix_numbers(extra: DataFrame, named: DataFrame) -> DataFrame:
    """`(family, nth, number)`: the nth positive number not yet used as a suffix.

    A used number u with r used numbers below it has u - 1 - r free numbers below it,
    so the nth free number is n plus the used numbers with fewer than n free below.
    """
    pattern = r"^(.*)_([1-9]\d{0,17})$"
    used = (
        named.where(F.col("stem").rlike(pattern))
        .select(
            "dir",
            F.regexp_extract("stem", pattern, 1).alias("stem"),
            "ext",
            F.regexp_extract("stem", pattern, 2).cast("bigint").alias("used"),
        )
        .distinct()
        .join(extra.select(*FAMILY).distinct(), FAMILY, "left_semi")
        .withColumn("one", F.lit(1).cast("bigint"))
        .withColumn("range", F.floor(F.col("used") / NUMBERS_PER_RANGE))
    )
    used = running_total(used, FAMILY, "range", ["used"], "one", "lower")
    marks = used.select(
        *FAMILY, (F.col("used") - 1 - F.col("lower")).alias("nth"), F.lit(1).alias("is_used")
    ).unionAll(extra.select(*FAMILY, "nth", F.lit(0).alias("is_used")))
    marks = marks.withColumn("range", F.floor(F.col("nth") / NUMBERS_PER_RANGE))
    counted = running_total(marks, FAMILY, "range", ["nth", "is_used"], "is_used", "skipped")
    return counted.where("is_used = 0").select(
        *FAMILY, "nth", (F.col("nth") + F.col("skipped")).alias("number")
    )
