"""Model metrics computed from tables of labels and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators.ranking import exact_percentile


def classification(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and weighted F1 as rows (metric, score).

    One pass counts (label, prediction) pairs; everything else works on these few counts.
    """
    pairs = (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(F.col(label).alias("l"), F.col(prediction).alias("p"))
        .agg(F.count("*").alias("n"))
    )
    # Each count goes to its label's row and to its prediction's row.
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("l").cast("double").alias("c"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").cast("double").alias("c"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select("s.*")
    per_class = sides.groupBy("c").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    precision = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hit", "actual"), F.lit(0.0))
    scored = per_class.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", F.coalesce(
            F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
            F.lit(0.0),
        ),
    )
    def weighted(value: str):
        return F.sum(F.col(value) * F.col("actual")) / F.sum("actual")

    return scored.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        weighted("precision").alias("weightedPrecision"),
        weighted("recall").alias("weightedRecall"),
        weighted("f1").alias("f1"),
    ).unpivot([], ["accuracy", "weightedPrecision", "weightedRecall", "f1"], "metric", "score")


def regression(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Median absolute error (exact) and R²."""
    known = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).select(
        F.col(actual).alias("y"), F.col(predicted).alias("p"), F.abs(F.col(actual) - F.col(predicted)).alias("e")
    )
    median = exact_percentile(known, "e", 0.5)
    # var_pop keeps a running mean, so the total deviation needs no second pass.
    r2 = 1 - F.sum((F.col("y") - F.col("p")) ** 2) / (F.var_pop("y") * F.count("y"))
    return known.agg(
        F.lit(median).cast("double").alias("median_absolute_error"), r2.alias("r2")
    )
