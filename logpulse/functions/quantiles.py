"""Quantiles: mergeable sketches for serving, an exact form for checking them.

KLL sketches replace t-digests as the mergeable state: with k = 200 the rank error of one
sketch is about 1.3 %, and merging keeps that bound. Sketches are randomised, so two runs may
differ within it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_K = 200
# Normalised rank error of one sketch at k = 200, with 99 % confidence.
SKETCH_RANK_ERROR = 0.0133


def within_rank_error(
    answers: DataFrame, readings: DataFrame, keys: Sequence[str], q: float, error: float
) -> DataFrame:
    """Per key: how many readings there are, and whether ``answer`` is a q-quantile up to ``error``.

    ``answers`` has ``answer``, ``readings`` has ``reading``, and both have the keys. The share
    of readings below the answer and that of readings up to it must enclose q within the error.
    """
    below, upto = F.count_if(F.expr("reading < answer")), F.count_if(F.expr("reading <= answer"))
    near = (below / F.count("*") <= q + error) & (upto / F.count("*") >= q - error)
    return (
        readings.join(answers, list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("n"), near.alias("within"))
    )


def sketch_quantile(sketch: str, q: float) -> Column:
    """Quantile of a sketch column; NULL (not an error) for a sketch that saw no value."""
    return F.expr(
        f"CASE WHEN kll_sketch_get_n_double({sketch}) > 0 "
        f"THEN kll_sketch_get_quantile_double({sketch}, {q}D) END"
    )


def exact_quantiles(
    df: DataFrame, by: Sequence[str], values: dict[str, str], percent: int = 95
) -> DataFrame:
    """Exact discrete percentiles of several integer columns, one row per group.

    ``values`` maps output name to a column. Rows are first counted per distinct value, with
    map-side combine, so a group holding a third of all rows reaches the window only as its
    distinct values; both steps spill. The smallest value whose cumulative share reaches
    ``percent`` is the answer, decided in integers.
    """
    by = list(by)
    # Measures by position: every key of the aggregation and the sort is then fixed-width.
    readings = F.posexplode(F.array(*[F.col(c).cast("bigint") for c in values.values()]))
    counted = (
        df.select(*by, readings.alias("_measure", "_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(*by, "_measure", "_value")
        .agg(F.count("*").alias("_n"))
    )
    group = Window.partitionBy(*by, "_measure")
    upto = group.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counted.withColumn("_upto", F.sum("_n").over(upto)).withColumn(
        "_total", F.sum("_n").over(group)
    )
    return (
        reached.where(F.col("_upto") * 100 >= F.col("_total") * percent)
        .groupBy(*by)
        .agg(
            *[
                F.min(F.when(F.col("_measure") == position, F.col("_value"))).alias(name)
                for position, name in enumerate(values)
            ]
        )
    )
