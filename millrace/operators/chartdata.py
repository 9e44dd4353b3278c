"""Tables behind the charts: histograms, densities, box figures, hourly bands, 2-D grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, small
from millrace.operators.quantiles import group_quantiles
from millrace.roles import Roles
from millrace.session import staged


def _bin(x: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin; the last bin is closed. A column without spread gets bin 0."""
    if high <= low:
        return F.lit(0).cast("bigint")
    width = (high - low) / bins
    return F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.struct(F.min(col(c).cast("double")).alias("lo"), F.max(col(c).cast("double")).alias("hi")).alias(f"c{i}")
                   for i, c in enumerate(columns)]).first()
    return {c: (row[f"c{i}"]["lo"], row[f"c{i}"]["hi"]) for i, c in enumerate(columns) if row[f"c{i}"]["lo"] is not None}


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """``(column, bin, low, high, n)`` of the non-empty bins; all columns share one pass."""
    limits = _ranges(df, columns)
    entries = [
        F.when(col(c).isNotNull(), F.struct(
            F.lit(c).alias("column"), _bin(col(c).cast("double"), lo, hi, bins).alias("bin"),
            F.lit(lo).alias("lo"), F.lit((hi - lo) / bins).alias("width")))
        for c, (lo, hi) in limits.items()
    ]
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, bin bigint, low double, high double, n bigint")
    cells = df.select(F.inline(F.array_compact(F.array(*entries))))
    # at most columns x bins groups, combined before the shuffle
    return cells.groupBy("column", "bin", "lo", "width").agg(F.count("*").alias("n")).select(
        "column", "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("high"), "n")


def density(df: DataFrame, column: str, by: Column, bins: int = 40) -> DataFrame:
    """``(series, bin, low, density)``: each series has its own bins and unit area."""
    x = df.select(by.alias("series"), col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    limits = x.groupBy("series").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("total"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    placed = x.join(small(limits), "series").select(
        "series", "lo", "total", width.alias("w"),
        F.coalesce(F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), width)), F.lit(bins - 1)), F.lit(0)).cast("bigint").alias("bin"))
    return placed.groupBy("series", "bin", "lo", "w", "total").agg(F.count("*").alias("n")).select(
        "series", "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("low"),
        F.try_divide(F.col("n"), F.col("total") * F.col("w")).alias("density"))


def box_figures(df: DataFrame, value: str, by: Sequence[str | None] = (None,), width: float = 1.5) -> DataFrame:
    """``(grouping, series, q1, median, q3, whisker_low, whisker_high, outliers, n)`` for each grouping column.

    ``None`` stands for the whole column. One pass over the data counts its values for all groupings together; quartiles and
    whiskers come from the counts, for any number of groups, of which one may hold most of the table.
    """
    series = [F.struct(F.lit(b or "column").alias("grouping"), (col(b).cast("string") if b else F.lit("all")).alias("series")) for b in by]
    known = df.select(F.array(*series).alias("s"), col(value).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    together = known.groupBy("s", "x").agg(F.count(F.lit(1)).alias("copies"))
    single = together.select(F.explode("s").alias("s"), "x", "copies").select("s.grouping", "s.series", "x", "copies")
    counts = staged(single.groupBy("grouping", "series", "x").agg(F.sum("copies").alias("copies")), "box-counts")
    table = group_quantiles(counts, ["grouping", "series"], "x", [0.25, 0.5, 0.75])
    q1, q3 = F.col("q1"), F.col("q3")
    table = table.select(F.col("grouping").alias("g"), F.col("series").alias("t"), *[F.col("q")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))])
    fence = table.withColumns({"low": q1 - F.lit(width) * (q3 - q1), "high": q3 + F.lit(width) * (q3 - q1)})
    joined = counts.join(small(fence), (F.col("grouping") == F.col("g")) & F.col("series").eqNullSafe(F.col("t")))
    inside = F.col("x").between(F.col("low"), F.col("high"))
    return joined.groupBy("grouping", "series", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"), F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("copies")).otherwise(0)).alias("outliers"), F.sum("copies").alias("n"))


def hourly_band(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Mean and sample deviation of the target per hour."""
    return (df.where(col(roles.hour).isNotNull()).groupBy(col(roles.hour).alias("hour"))
            .agg(F.avg(col(roles.target)).alias("mean_target"), F.stddev_samp(col(roles.target)).alias("sd_target")).orderBy("hour"))


def grid2d(df: DataFrame, x: str, y: str, size: int = 20) -> DataFrame:
    """Non-empty cells of an equal-width grid: ``(cell_x, cell_y, n)``."""
    limits = _ranges(df, [x, y])
    if len(limits) < 2:
        return df.sparkSession.createDataFrame([], "cell_x bigint, cell_y bigint, n bigint")
    both = df.where(col(x).isNotNull() & col(y).isNotNull())
    return both.groupBy(_bin(col(x).cast("double"), *limits[x], size).alias("cell_x"),
                        _bin(col(y).cast("double"), *limits[y], size).alias("cell_y")).agg(F.count("*").alias("n"))


def hexagons(df: DataFrame, x: str, y: str, size: int = 20) -> DataFrame:
    """Non-empty hexagonal cells: each point goes to the nearer centre of two offset lattices.

    ``size`` hexagons across, ``size / sqrt(3)`` rows down; in lattice units the
    distance weighs the vertical part three times.
    """
    limits = _ranges(df, [x, y])
    if len(limits) < 2:
        return df.sparkSession.createDataFrame([], "center_x double, center_y double, n bigint")
    (x0, x1), (y0, y1) = limits[x], limits[y]
    rows = int(size / 3 ** 0.5)
    sx, sy = ((x1 - x0) / size or 1.0), ((y1 - y0) / rows or 1.0)
    u, v = (col(x).cast("double") - F.lit(x0)) / F.lit(sx), (col(y).cast("double") - F.lit(y0)) / F.lit(sy)
    i1, j1 = F.floor(u + 0.5), F.floor(v + 0.5)
    i2, j2 = F.floor(u) + 0.5, F.floor(v) + 0.5
    d1 = (u - i1) * (u - i1) + 3.0 * (v - j1) * (v - j1)
    d2 = (u - i2) * (u - i2) + 3.0 * (v - j2) * (v - j2)
    near = d1 < d2
    both = df.where(col(x).isNotNull() & col(y).isNotNull())
    cells = both.groupBy(F.when(near, i1.cast("double")).otherwise(i2).alias("i"), F.when(near, j1.cast("double")).otherwise(j2).alias("j"))
    return cells.agg(F.count("*").alias("n")).select(
        (F.col("i") * sx + F.lit(x0)).alias("center_x"), (F.col("j") * sy + F.lit(y0)).alias("center_y"), "n")
