"""Checks of a workflow catalog as DataFrames, and stages run one after the other."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.features import duplicate_ids

MOST_WORKFLOWS = 10


def problems(workflows: DataFrame, models: DataFrame) -> DataFrame:
    """(problem, id) of workflows(id, model, type, enabled) and models(id): repeats, unknown models, types, too many."""
    tell = lambda df, text: df.select(F.lit(text).alias("problem"), F.col("id").cast("string").alias("id"))
    unknown = workflows.filter(F.col("model").isNotNull()).join(models.select(F.col("id").alias("model")), "model", "left_anti")
    many = workflows.groupBy().agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > MOST_WORKFLOWS).select(F.col("n").alias("id"))
    return (
        tell(duplicate_ids(workflows, "id"), "repeated workflow").unionByName(tell(duplicate_ids(models, "id"), "repeated model"))
        .unionByName(tell(unknown, "unknown model")).unionByName(tell(workflows.filter("type <> 'roads'"), "unknown type"))
        .unionByName(tell(many, "too many workflows"))
    )


def select(workflows: DataFrame, ids: list[str] | None = None, model: str | None = None) -> DataFrame:
    """The workflows asked for, in that order, enabled or not; without ids all enabled ones. A workflow with another
    model than the one asked for, and an id that isn't there, are errors."""
    if ids is None:
        chosen = workflows.filter("enabled").withColumn("place", F.monotonically_increasing_id())
    else:
        asked = workflows.sparkSession.createDataFrame([(x, k) for k, x in enumerate(ids)], "id string, place long")
        if missing := [r.id for r in asked.join(workflows, "id", "left_anti").collect()]:
            raise ValueError(f"unknown workflows: {', '.join(sorted(missing))}")
        chosen = workflows.join(F.broadcast(asked), "id")  # as many rows as the caller named
    if model is not None and chosen.filter(F.col("model").isNotNull() & (F.col("model") != model)).take(1):
        raise ValueError(f"a workflow has another model than {model}")
    return chosen.orderBy("place").drop("place")


@dataclass(frozen=True)
class StageResult:
    stage: str
    rows: int | None
    error: str | None = None


def run_workflows(plans: dict[str, list[tuple[str, Callable[[DataFrame], DataFrame]]]], start: DataFrame, folder: str) -> dict[str, tuple[DataFrame | None, list[StageResult]]]:
    """Each workflow's stages, under its own folder. One that fails doesn't stop the others, and its finished stages stay."""
    return {name: run_stages(stages, start, f"{folder}/{name}") for name, stages in plans.items()}


def run_stages(stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], start: DataFrame, folder: str) -> tuple[DataFrame | None, list[StageResult]]:
    """Runs stages in order, each result written to ``folder`` and read again; the first error ends the run and is told."""
    done, df = [], start
    for name, stage in stages:
        try:
            stage(df).write.mode("overwrite").parquet(f"{folder}/{name}")
            df = df.sparkSession.read.parquet(f"{folder}/{name}")
            done.append(StageResult(name, df.count()))
        except Exception as e:
            return None, [*done, StageResult(name, None, str(e))]
    return df, done
