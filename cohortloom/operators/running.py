"""Running totals over groups of any size without one task holding a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.sources.storage import materialize


def ordered_ranges(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Add `out`: number of the range, in ascending `order`, that a row falls into.

    The bounds are sampled, so ranges are even for any distribution of the values. The
    rows are written once with their range, which fixes it for every later scan.
    """
    ranged = df.repartitionByRange(*order)
    return materialize(ranged.withColumn(out, F.spark_partition_id()), "ranges")


def running_total(
    df: DataFrame,
    group: Sequence[str],
    bucket: str,
    order: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """Add `out`: the sum of `value` over the rows before this one in its group.

    Rows are ordered by (`bucket`, *`order`). `bucket` cuts a group into ordered ranges;
    it is a pure function of the order columns or comes from `ordered_ranges`, so that
    the two scans below agree. Each task sorts one (group, bucket); the totals of whole buckets
    are aggregated map-side and only they are summed along the group.
    """
    group = list(group)
    keys = [*group, bucket]
    whole = df.groupBy(*keys).agg(F.sum(value).alias("__bucket_total"))
    earlier = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = whole.select(
        *keys, F.coalesce(F.sum("__bucket_total").over(earlier), F.lit(0)).alias("__offset")
    )
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = df.withColumn("__within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    named = offsets.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)], "__offset")
    # a NULL in a group column makes a group like any other value
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    return (
        within.join(named, reduce(Column.__and__, same))
        .withColumn(out, F.col("__offset") + F.col("__within"))
        .drop("__offset", "__within", *[f"__key{i}" for i in range(len(keys))])
    )
