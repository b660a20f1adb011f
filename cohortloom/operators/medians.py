"""Exact interpolated medians that skip NULLs, at any size."""

from __future__ import annotations

from collections.abc import Hashable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.running import ordered_ranges, running_total

# Ranges that hold no more values than this need no further narrowing.
NARROW_ENOUGH = 100_000


def small_domain_median(df: DataFrame, column: str) -> DataFrame:
    """One-row, one-column frame with the exact median of a column of few distinct values.

    Values are counted map-side first, so the single final task receives the distinct
    values with their counts. For columns whose domain is bounded by construction,
    such as a sum of item scores; otherwise use `exact_medians`.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    return counted.agg(F.percentile(column, F.lit(0.5), F.col("__n")).alias("median"))


@dataclass
class _Search:
    """Where the two middle ranks of one column are known to lie."""

    total: int
    low: float = float("-inf")
    high: float = float("inf")
    below: int = 0  # values under `low`
    held: int = 0  # values in [low, high]
    error: float = 1e-3  # rank error asked of the next sketch
    settled: bool = False

    @property
    def ranks(self) -> tuple[int, int]:
        return (self.total - 1) // 2, self.total // 2

    def inside(self, column: str) -> Column:
        return F.when(F.col(column).between(self.low, self.high), F.col(column))

    def quantiles(self) -> list[float]:
        first, last = ((rank - self.below) / self.held for rank in self.ranks)
        return [max(0.0, first - 2 * self.error), min(1.0, last + 2 * self.error)]

    def narrow(self, low: float, high: float, under: int, held: int) -> None:
        """Take the new bounds when they provably hold both ranks and shrink the range."""
        if under <= self.ranks[0] and self.ranks[1] < under + held:
            if held < self.held:
                self.low, self.high, self.below, self.held = low, high, under, held
                self.settled = low == high
                return
            self.error /= 8
        else:
            self.error *= 3
        self.settled = not 1e-6 < self.error < 0.1


def exact_medians(
    df: DataFrame, columns: Mapping[Hashable, Column | str], small: int = NARROW_ENOUGH
) -> dict[Hashable, float | None]:
    """Exact median of each named expression (a column or SQL text); None without values.

    NaN counts as NULL. While the range that must hold a median has more than `small`
    values, quantile sketches narrow it and a count proves each narrower range. The middle
    order statistics are then found by running counts over ordered ranges of the distinct
    values left, so no task holds all of them however many they are. All expressions advance
    together, so the number of passes does not grow with their number. `df` is scanned
    several times: pass a written table, not a long plan.
    """
    if not columns:
        return {}
    labels = {f"m{i}": name for i, name in enumerate(columns)}
    frame = df.select(*[_labelled(columns[name], label) for label, name in labels.items()])
    counts = frame.agg(*[F.expr(f"count({label}) AS {label}") for label in labels]).first()
    searches = {
        label: _Search(counts[label], held=counts[label]) for label in labels if counts[label]
    }
    found: dict[str, float] = {}
    if searches:
        _narrow(frame, searches, small)
        found = _middle_values(frame, searches)
    return {name: found.get(label) for label, name in labels.items()}


def _labelled(value: Column | str, label: str) -> Column:
    if isinstance(value, str):
        return F.expr(f"nanvl(CAST({value} AS double), CAST(NULL AS double)) AS {label}")
    return F.nanvl(value.cast("double"), F.lit(None).cast("double")).alias(label)


def _narrow(frame: DataFrame, searches: Mapping[str, _Search], small: int) -> None:
    """Shrink the ranges until each holds at most `small` values or cannot shrink."""
    while True:
        active = {c: s for c, s in searches.items() if s.held > small and not s.settled}
        if not active:
            return
        bounds = frame.agg(
            *[
                F.percentile_approx(s.inside(c), s.quantiles(), int(1 / s.error)).alias(c)
                for c, s in active.items()
            ]
        ).first()
        counted = frame.agg(
            *[F.count_if(F.col(c) < bounds[c][0]).alias(f"{c}_under") for c in active],
            *[F.count_if(F.col(c).between(*bounds[c])).alias(f"{c}_held") for c in active],
        ).first()
        for c, search in active.items():
            search.narrow(*bounds[c], counted[f"{c}_under"], counted[f"{c}_held"])


def _middle_values(frame: DataFrame, searches: Mapping[str, _Search]) -> dict[str, float]:
    """Mean of the two middle order statistics of each column, from its range alone."""
    spark = frame.sparkSession
    state = spark.createDataFrame(
        [(c, s.below, *s.ranks) for c, s in searches.items()],
        "name string, below bigint, first bigint, last bigint",
    )
    ranged = frame.select(*[s.inside(c).alias(c) for c, s in searches.items()])
    values = ranged.unpivot([], list(searches), "name", "v").where("v is not null")
    # equal values collapse before the running count
    counted = values.groupBy("name", "v").agg(F.count("*").alias("n"))
    ranged = ordered_ranges(counted, ["name", "v"], "range")
    ranked = running_total(ranged, ["name"], "range", ["v"], "n", "before").join(state, "name")
    reached = F.col("before") + F.col("n") + F.col("below")
    middles = ranked.groupBy("name").agg(
        *[F.min(F.when(reached > F.col(r), F.col("v"))).alias(r) for r in ("first", "last")]
    )
    return {row["name"]: (row["first"] + row["last"]) / 2 for row in middles.collect()}
