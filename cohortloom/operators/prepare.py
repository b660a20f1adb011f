"""Median imputation and standard scaling, fitted on one frame and applied to others."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.medians import exact_medians


def _literal(number: float) -> str:
    """SQL text of a double; the shortest text that reads back as the same value."""
    return f"{number!r}D" if math.isfinite(number) else f"double('{number!r}')"


def _replace(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """One projection that replaces the named columns and keeps the others."""
    return df.selectExpr(
        *[f"{expressions[c]} AS `{c}`" if c in expressions else f"`{c}`" for c in df.columns]
    )


@dataclass(frozen=True)
class MedianFill:
    """Exact medians of a fitted frame; a column without any value has none."""

    medians: Mapping[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MedianFill:
        return cls(exact_medians(df, {c: f"`{c}`" for c in columns}))

    @property
    def empty(self) -> list[str]:
        """Columns that held no value at all when fitted."""
        return [c for c, median in self.medians.items() if median is None]

    def transform(self, df: DataFrame) -> DataFrame:
        """Cast to double and fill NULLs; a column without a median stays NULL."""
        filled = {}
        for c, median in self.medians.items():
            value = f"CAST(`{c}` AS double)"
            filled[c] = value if median is None else f"coalesce({value}, {_literal(median)})"
        return _replace(df, filled)


@dataclass(frozen=True)
class Standardize:
    """Mean and population deviation of a fitted frame; a zero deviation divides by one."""

    moments: Mapping[str, tuple[float, float]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> Standardize:
        row = df.agg(
            *[F.expr(f"avg(`{c}`) AS a{i}") for i, c in enumerate(columns)],
            *[F.expr(f"stddev_pop(`{c}`) AS s{i}") for i, c in enumerate(columns)],
        ).first()
        return cls({c: (row[f"a{i}"], row[f"s{i}"]) for i, c in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        return _replace(
            df,
            {
                c: f"(`{c}` - {_literal(mean)}) / {_literal(deviation or 1.0)}"
                for c, (mean, deviation) in self.moments.items()
                if mean is not None
            },
        )
