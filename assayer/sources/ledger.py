"""Append-only table of runs: parameters, metrics and feature importances."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = (
    "run_id string, experiment string, run_name string, params map<string,string>, metrics map<string,double>, "
    "importances map<string,double>, ts timestamp"
)


def run_row(experiment: str, run_name: str, params: dict, metrics: dict, importances: dict | None = None) -> tuple:
    return (
        uuid.uuid4().hex, experiment, run_name, {str(k): str(v) for k, v in params.items()},
        {str(k): float(v) for k, v in metrics.items()}, {str(k): float(v) for k, v in (importances or {}).items()},
        dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
    )


def log_runs(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """One append for any number of runs, so a sweep does not leave a file per run."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").partitionBy("experiment").parquet(path)


def log_run(spark: SparkSession, path: str, experiment: str, run_name: str, params: dict, metrics: dict, importances: dict | None = None) -> None:
    log_runs(spark, path, [run_row(experiment, run_name, params, metrics, importances)])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def leaderboard(results: DataFrame, metric: str, name: str = "run_name", ascending: bool = True) -> DataFrame:
    """``rank``, and the gap of each row's ``metric`` to the worst-ranked baseline in percent.

    The baseline is the last row; ``gap_pct`` is positive where a row is better.
    """
    whole = Window.partitionBy()
    order = Window.partitionBy().orderBy(F.col(metric) if ascending else F.desc(metric), name)
    base = (F.max(metric) if ascending else F.min(metric)).over(whole)
    sign = 1.0 if ascending else -1.0
    gap = F.try_divide(sign * 100.0 * (base - F.col(metric)), F.abs(base))
    return results.withColumns({"rank": F.row_number().over(order), "gap_pct": gap})


def best_run(results: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    return leaderboard(results, metric, ascending=ascending).filter("rank = 1")


def run_metrics(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Flatten the wanted metrics of a run table to columns."""
    return runs.select("run_id", "experiment", "run_name", *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics])
