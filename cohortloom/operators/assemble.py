"""Join the modalities into one feature row per participant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions.values import number_sql
from cohortloom.operators.features import KEY, PLAN, Feature


def outer_join(
    left: DataFrame, right: DataFrame, key: str = KEY, null_key: str = "drop"
) -> DataFrame:
    """Full outer join on `key`.

    null_key="drop"   rows without a key are left out
    null_key="match"  a NULL key matches a NULL key, as in a dataframe merge
    """
    if null_key == "drop":
        known = F.col(key).isNotNull()
        return left.where(known).join(right.where(known), key, "full_outer")
    if null_key != "match":
        raise ValueError("null_key must be 'drop' or 'match'")
    other = right.withColumnRenamed(key, "__key")
    joined = left.join(other, F.col(key).eqNullSafe(F.col("__key")), "full_outer")
    return joined.withColumn(key, F.coalesce(key, "__key")).drop("__key")


def outer_chain(
    frames: Sequence[DataFrame], key: str = KEY, null_key: str = "drop"
) -> DataFrame:
    """Full outer joins of per-participant frames, left to right."""
    return reduce(lambda left, right: outer_join(left, right, key, null_key), frames)


def spine_join(spine: DataFrame, parts: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Left joins of per-participant frames to a frame of all participants.

    Same rows as `outer_chain` if `spine` holds each participant of the parts once. A left
    join keeps the partitioning of its left side, which a full outer join does not: where
    spine and parts stand in as many buckets of the key, nothing is exchanged.
    """
    return reduce(lambda left, part: left.join(part, key, "left"), parts, spine)


def merge_features(parts: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Same rows as `outer_chain`, by one grouped aggregate over the union of the parts.

    Each part has one row per key and columns of its own, so the only non-null value of
    a column is its maximum. The parts arrive hash-partitioned by the key from their own
    grouping and the union keeps that, so nothing is shuffled a second time, whereas the
    output of a full outer join has to be re-partitioned before the next one.
    """
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [part.where(F.col(key).isNotNull()) for part in parts],
    )
    return rows.groupBy(key).agg(*[F.expr(f"max(`{c}`) AS `{c}`") for c in rows.columns if c != key])


def _slot(modality: str, source: str) -> str:
    return f"{modality}__{source}"


def _sources(modality: str) -> list[str]:
    return list(dict.fromkeys(f.source for f in PLAN[modality] if f.source))


def _tagged(modality: str, feature: Feature) -> str:
    if feature.kind == "rows":
        # no rows of a modality is NULL, as after an outer join, not zero
        return f"sum(CASE WHEN __tag = '{modality}' THEN 1L END) AS {feature.name}"
    function = "avg" if feature.kind == "mean" else "sum"
    return f"{function}({_slot(modality, feature.source)}) AS {feature.name}"


def single_shuffle(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All given modalities in one grouped aggregate over a tagged union.

    Same rows as aggregating each modality and merging, with one exchange for all of
    them. Each branch of the union is reduced map-side before that exchange, at the price
    of wider buffers, so this suits many small modalities.
    """
    modalities = [m for m in PLAN if m in tables]
    parts = [
        tables[m]
        .where(f"{KEY} IS NOT NULL")
        .selectExpr(
            KEY,
            f"'{m}' AS __tag",
            *[f"{number_sql(source)} AS {_slot(m, source)}" for source in _sources(m)],
        )
        for m in modalities
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    aggregates = [F.expr(_tagged(m, f)) for m in modalities for f in PLAN[m]]
    return rows.groupBy(KEY).agg(*aggregates)


def attach_labels(features: DataFrame, labels: DataFrame, key: str = KEY) -> DataFrame:
    """Inner join of features with the score and label columns of each participant."""
    wanted = labels.select(key, schemas.SCORE, schemas.LABEL, schemas.LABEL_BINARY)
    return features.join(wanted, key, "inner")
