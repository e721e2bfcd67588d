"""Missing values: learn the fill on one table, apply it to any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from ..functions.stats import collect_aggs, q


def impute_fit(df: DataFrame, cols: list[str], how: str = "mean", exact: bool = True) -> dict[str, float | None]:
    """``{column: fill}``; a column without any value stays unfilled."""
    if how == "mean":
        return collect_aggs(df, {c: F.avg(q(c)) for c in cols})
    if how == "median":
        return {c: v[0] for c, v in column_quantiles(df, cols, [0.5], exact=exact)[None].items()} if cols else {}
    raise ValueError(f"unknown fill {how!r}")


def impute_apply(df: DataFrame, fill: dict[str, float | None]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(q(c).cast("double"), F.lit(float(v))) if v is not None else q(c).cast("double") for c, v in fill.items()
    })
