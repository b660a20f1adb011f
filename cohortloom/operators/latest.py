"""Latest submission per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Every row at the greatest value of `order` of its key.

    With the time alone, rows that share a key's latest time are all kept; with further
    columns that identify a submission, the rows of exactly one submission are kept.

    The greatest value is aggregated map-side from the key and order columns alone. The
    rows are then kept by a semi join on key and order, so a key that owns a large share
    of all rows is spread over its times; the small side is broadcast only when its
    measured size allows. Rows with a NULL key or first order column never qualify.
    """
    known = F.col(key).isNotNull() & F.col(order[0]).isNotNull()
    if len(order) == 1:
        top = df.where(known).groupBy(F.col(key).alias("__key")).agg(F.max(order[0]).alias("__top0"))
    else:
        top = (
            df.where(known)
            .groupBy(F.col(key).alias("__key"))
            .agg(F.max(F.struct(*order)).alias("__top"))
            .select("__key", *[F.col("__top")[c].alias(f"__top{i}") for i, c in enumerate(order)])
        )
    same = [F.col(key) == F.col("__key"), F.col(order[0]) == F.col("__top0")]
    same += [F.col(c).eqNullSafe(F.col(f"__top{i}")) for i, c in enumerate(order) if i]
    return df.join(top, reduce(Column.__and__, same), "left_semi")


def latest_row(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Exactly one row per key, the one with the greatest `order`.

    Spark limits each map task to one row per key before the shuffle.
    """
    place = F.row_number().over(
        W.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    )
    known = F.col(key).isNotNull() & F.col(order[0]).isNotNull()
    return df.where(known).withColumn("__place", place).where("__place = 1").drop("__place")
