"""Shared pieces of the training-data operators: names, blocks of crowded groups, and the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.operators.batches import let_go
from rasterloom.operators.graph import components, cut, fresh_folder, shared_dir, stored

__all__ = ["components", "cut", "fresh_folder", "fresh_name", "let_go", "needs", "pair_blocks", "placed", "runs_of", "shared_dir", "stored"]


def fresh_name(taken: list[str], wanted: str) -> str:
    """wanted, with underscores before it until no column of that name (in any case) is taken."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def needs(df: DataFrame, *columns: str) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def runs_of(batches: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Batches sorted by keys as frames of whole runs of equal keys, each of about ``rows`` rows, or one longer run.

    So a task holds two batches or its longest run, and never its whole partition.
    """
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if sum(map(len, held)) < rows:
            continue
        part = pd.concat(held, ignore_index=True)
        last = np.ones(len(part), bool)
        for k in keys:
            last &= (part[k] == part[k].iloc[-1]).to_numpy()
        begin = len(part) if last.all() else int(np.flatnonzero(~last)[-1]) + 1
        if begin < len(part):
            yield part.iloc[:begin].reset_index(drop=True)
            held = [part.iloc[begin:].reset_index(drop=True)]
        else:
            held = [part]
    if held:
        yield pd.concat(held, ignore_index=True)
    held.clear()
    let_go()


def pair_blocks(df: DataFrame, keys: list[str], row_id: str, limit: int) -> DataFrame:
    """Deals each key's rows to blocks of about ``limit`` rows and adds block_i <= block_j and block.

    A key with up to ``limit`` rows keeps one copy of each row in block pair (0, 0). A larger key is cut into
    g blocks by a hash of row_id and each row goes to the g block pairs that hold its block, so every pair of the
    key's rows meets in exactly one block pair: (i, i) for two rows of block i, (i, j) for rows of different blocks.

    The larger keys, at most one in ``limit`` rows, are written first: Spark knows their size before it joins, and a
    small table of them leaves the rows where they are.
    """
    spark, folder = df.sparkSession, fresh_folder(df.sparkSession, "large-keys")
    df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit).write.parquet(folder)
    large = spark.read.parquet(folder)
    cut_up = df.join(large, keys, "left").withColumn("_g", F.coalesce(F.ceil(F.col("_rows") / limit), F.lit(1)).cast("int"))
    dealt = cut_up.withColumn("block", F.pmod(F.xxhash64(row_id), F.col("_g")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("_g") - 1),
        lambda k: F.struct(F.least(F.col("block"), k).alias("i"), F.greatest(F.col("block"), k).alias("j")),
    )
    return (
        dealt.withColumn("_pair", F.explode(pairs))
        .withColumn("block_i", F.col("_pair.i"))
        .withColumn("block_j", F.col("_pair.j"))
        .drop("_pair", "_rows", "_g")
    )


def placed(df: DataFrame, groups: list[str], order: list[str], rank: str, size: str | None = None, before: str | None = None, total: str | None = None) -> DataFrame:
    """df with its rows' places, from 0, in each group by ``order``; as sums of ``size`` in ``before``, of the group in ``total``.

    No group meets in one task: rows are dealt by range, each task numbers its sorted run, and the runs' sizes, a row for
    each task and group, are summed up. Rows that are equal in groups and order are dealt by a number of their own, so a
    third of a table that is one repeated row is split as well. ``df`` is read three times: give a stored one. Groups
    mustn't be null. Columns ``rank``, ``before`` (the sum of ``size`` over the group's earlier rows) and ``total`` (the
    group's number of rows) are added.
    """
    salt, at, part = (fresh_name(df.columns, c) for c in ("salt", "at", "part"))
    by = [*groups, *order, salt]
    rows = df.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop(salt)
    rows = stored(rows.withColumn(at, F.monotonically_increasing_id()), "places").withColumn(part, F.shiftright(at, 33))
    sums = [F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first")] + ([F.sum(size).alias("_size")] if size else [])
    runs, so_far = rows.groupBy(*groups, part).agg(*sums), Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    kept = [F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_rank"), F.col("_first")]
    if size:
        kept.append(F.coalesce(F.sum("_size").over(so_far), F.lit(0)).alias("_before"))
    if total:
        kept.append(F.sum("_n").over(Window.partitionBy(*groups)).alias(total))
    runs = stored(runs.select(*groups, part, *kept), "runs")
    out = rows.join(runs, [*groups, part]).withColumn(rank, F.col(at) - F.col("_first") + F.col("_rank"))
    if size:
        inside = Window.partitionBy(*groups, part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(before, F.coalesce(F.sum(size).over(inside), F.lit(0)) + F.col("_before"))
    return out.select(*df.columns, rank, *([before] if size else []), *([total] if total else []))
