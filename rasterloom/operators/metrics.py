"""Segmentation metrics and losses as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, *keys: str) -> DataFrame:
    """tp, fp and fn of rows(pred, truth), and precision, recall, iou and dice with denominators of at least 1."""
    both = (F.col("pred") == 1) & (F.col("truth") == 1)
    counts = rows.groupBy(*keys).agg(
        F.count_if(both).alias("tp"), F.count_if((F.col("pred") == 1) & (F.col("truth") != 1)).alias("fp"),
        F.count_if((F.col("pred") != 1) & (F.col("truth") == 1)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    share = lambda top, low: top / F.greatest(low.cast("double"), F.lit(1.0))
    return counts.withColumns({
        "precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "iou": share(tp, tp + fp + fn), "dice": share(2 * tp, 2 * tp + fp + fn),
    })


def _sums(pred: str, truth: str) -> tuple[Column, Column]:
    p, t = F.col(pred).cast("double"), F.col(truth).cast("double")
    return F.sum(p * t), F.sum(p) + F.sum(t)


def soft_scores(rows: DataFrame, *keys: str, smooth: float = 1e-6) -> DataFrame:
    """IoU and dice coefficients of soft predictions, and the soft dice loss."""
    inter, total = _sums("pred", "truth")
    dice = (2 * inter + smooth) / (total + smooth)
    return rows.groupBy(*keys).agg(((inter + smooth) / (total - inter + smooth)).alias("iou_coef"), dice.alias("dice_coef"), (1 - dice).alias("dice_loss"))


def combined_loss(rows: DataFrame, *keys: str, ce_weight: float = 1.0, dice_weight: float = 1.0, smooth: float = 1.0) -> DataFrame:
    """Mean cross-entropy of rows(prob, truth), clipped from 0 and 1, and dice loss, weighted and added."""
    p = F.greatest(F.least(F.col("prob").cast("double"), F.lit(1 - 1e-7)), F.lit(1e-7))
    ce = F.avg(-F.log(F.when(F.col("truth") == 1, p).otherwise(1 - p)))
    inter, total = _sums("prob", "truth")
    return rows.groupBy(*keys).agg((ce_weight * ce + dice_weight * (1 - (2 * inter + smooth) / (total + smooth))).alias("loss"))


def best_epoch(scores: DataFrame) -> DataFrame:
    """The first epoch of scores(epoch, iou) that has the largest iou."""
    return scores.groupBy().agg(F.min_by("epoch", F.struct(-F.col("iou"), F.col("epoch"))).alias("epoch"), F.max("iou").alias("iou"))
