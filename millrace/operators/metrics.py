"""Model quality from a predictions table: every set of metrics is one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, one_row, true_or_false

# Fixed value: smallest divisor of the relative error (double machine epsilon).
MAPE_FLOOR = 2.220446049250313e-16


def regression_aggregates(y: str | Column = "y_true", p: str | Column = "y_pred") -> list[Column]:
    y, p = col(y).cast("double"), col(p).cast("double")
    e = y - p
    rest, total = F.sum(e * e), F.var_pop(y) * F.count(e)
    r2 = F.when(total > 0, 1.0 - rest / F.when(total > 0, total)).otherwise(F.when(rest == 0, 1.0).otherwise(0.0))
    return [
        F.count(e).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(F.count(e) > 0, r2).alias("r2"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))).alias("mape"),
    ]


def _complete(preds: DataFrame, y: str, p: str) -> DataFrame:
    return preds.where(col(y).isNotNull() & col(p).isNotNull())


def regression_metrics(preds: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """One row ``(n, mae, rmse, r2, mape)``. MAPE explodes where the truth is 0; do not rank by it."""
    return _complete(preds, y, p).agg(*regression_aggregates(y, p))


def regression_metrics_by(preds: DataFrame, group: str, y: str = "y_true", p: str = "y_pred",
                          groups: Sequence[str] | None = None) -> DataFrame:
    """Metrics per group; groups without rows do not appear."""
    rows = _complete(preds, y, p)
    if groups is not None:
        rows = rows.where(col(group).isin(*groups))
    return rows.groupBy(col(group)).agg(*regression_aggregates(y, p))


def classification_metrics(preds: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row of accuracy, precision, recall, F1 and the four cells; 0 where a ratio has no denominator."""
    a, b = true_or_false(col(actual).cast("int") == 1), true_or_false(col(predicted).cast("int") == 1)
    cells = preds.agg(F.count_if(a & b).alias("tp"), F.count_if(~a & b).alias("fp"),
                      F.count_if(a & ~b).alias("fn"), F.count_if(~a & ~b).alias("tn"))

    def share(x, y):
        return F.coalesce(F.try_divide(x.cast("double"), y.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns({
        "accuracy": share(tp + tn, tp + fp + fn + tn),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
    })


def confusion(preds: DataFrame, actual: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """``(actual, predicted, n)`` with every cell of the matrix, 0 where it is empty."""
    cells = preds.sparkSession.createDataFrame([(a, b) for a in classes for b in classes], "actual int, predicted int")
    n = preds.groupBy(col(actual).cast("int").alias("actual"), col(predicted).cast("int").alias("predicted")).agg(F.count("*").alias("n"))
    return cells.join(n, ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def comparison(tables: dict[str, DataFrame], column: str = "model") -> DataFrame:
    """One-row metric tables under each other, named."""
    out = None
    for name, t in tables.items():
        row = t.select(F.lit(name).alias(column), "*")
        out = row if out is None else out.unionByName(row)
    return out


def improvement(base: DataFrame, new: DataFrame) -> DataFrame:
    """Signed change of ``new`` against ``base`` in percent; positive is better.

    Both are metric tables of one row, or have a ``model`` column to match on.
    """
    names = {m: f"base_{m}" for m in ("mae", "rmse", "r2")}
    left = base.select(*([F.col("model")] if "model" in base.columns else []), *[F.col(m).alias(n) for m, n in names.items()])
    if "model" in left.columns:
        both = new.join(left, "model")
    else:
        both = new.withColumn("_base", one_row(left)).select("*", "_base.*")
    keep = ["model"] if "model" in both.columns else []

    def change(a, b):
        return F.lit(100.0) * F.try_divide(a - b, b)

    return both.select(
        *keep,
        (-change(F.col("mae"), F.col("base_mae"))).alias("mae_improvement_pct"),
        (-change(F.col("rmse"), F.col("base_rmse"))).alias("rmse_improvement_pct"),
        change(F.col("r2"), F.col("base_r2")).alias("r2_improvement_pct"),
        (F.col("base_mae") - F.col("mae")).alias("mae_delta"),
        (F.col("base_rmse") - F.col("rmse")).alias("rmse_delta"),
        (F.col("r2") - F.col("base_r2")).alias("r2_delta"),
    )


def residual_confidence(preds: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Mean absolute residual, population deviation and ``1 - deviation / mean |y|``."""
    e = col(y).cast("double") - col(p).cast("double")
    return _complete(preds, y, p).agg(
        F.avg(F.abs(e)).alias("mean_abs_residual"), F.stddev_pop(e).alias("std_residual"),
        (1.0 - F.try_divide(F.stddev_pop(e), F.avg(F.abs(col(y))))).alias("confidence"))


def predictions(scored: DataFrame, y: str = "label", p: str = "prediction", carry: Sequence[str] = ()) -> DataFrame:
    """``(y_true, y_pred, abs_error)`` of a scored table."""
    return scored.select(*[col(c) for c in carry], col(y).alias("y_true"), col(p).alias("y_pred"),
                         F.abs(col(y) - col(p)).alias("abs_error"))


def prediction_range(preds: DataFrame) -> DataFrame:
    """Common axis limits of an actual-versus-predicted chart."""
    return preds.agg(F.least(F.min("y_true"), F.min("y_pred")).alias("axis_low"),
                     F.greatest(F.max("y_true"), F.max("y_pred")).alias("axis_high"))
