"""Delay models: one fitted pipeline serves training, daily batches and streams."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import (
    Bucketizer, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.functions.buckets import DELAY_EDGES
from delaylens.operators.metrics import classification
from delaylens.session import checkpointed, set_checkpoints, workspace
from delaylens.sources.readers import STORED_REQUESTS, read_day
from delaylens.sources.writers import materialize, write_days

LABEL = "ArrDelayBucket"
PREDICTION = "Prediction"
#: Rows of a part of training rows, from which on there are more parts.
PART_ROWS = 500_000
#: Features up to which a linear model is solved from their products, which Spark gathers in one pass.
SOLVED_FEATURES = 4096


@dataclass(frozen=True)
class Inputs:
    """Columns a model reads.

    An index of categories is held by the driver and by every task, so its size must not grow
    with the data: columns in ``hashed`` are always hashed into that many values, and all others,
    which must have a bounded number of values, are always indexed.
    """

    categorical: tuple[str, ...] = (
        "Carrier", "DayOfMonth", "DayOfWeek", "DayOfYear", "Origin", "Dest", "Route",
    )
    numeric: tuple[str, ...] = ("DepDelay", "Distance")
    hashed: Mapping[str, int] = field(default_factory=lambda: {"Route": 4096, "TailNum": 4096})


HOURLY_INPUTS = Inputs(
    categorical=Inputs.categorical + ("CRSDepHourOfDay", "CRSArrHourOfDay"),
)
FULL_INPUTS = Inputs(
    categorical=Inputs.categorical + (
        "CRSDepHourOfDay", "CRSArrHourOfDay", "TailNum", "EngineManufacturer", "EngineModel",
        "Manufacturer", "ManufacturerYear", "OwnerState",
    ),
    numeric=Inputs.numeric + ("FlightTime",),
)


def bucketed(df: DataFrame, delay: str = "ArrDelay", label: str = LABEL,
             edges: Sequence[float] = DELAY_EDGES) -> DataFrame:
    """Add the delay bucket as a label; rows with an unknown delay keep a NULL label."""
    splits = [-float("inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=delay, outputCol=label).transform(df)


def split_by_hash(df: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """A seeded split that depends on the rows alone.

    A lost and recomputed partition falls the same way, and neither side needs the local sort
    that ``randomSplit`` adds.
    """
    draw, cut = _draw(df, seed), F.lit(round(share * 1_000_000))
    return df.where(draw < cut), df.where(draw >= cut)


def _draw(df: DataFrame, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1_000_000))


def stored_splits(
    df: DataFrame, share: float, seeds: Sequence[int], columns: Sequence[str]
) -> list[tuple[DataFrame, DataFrame]]:
    """The splits of ``split_by_hash`` for all seeds, of ``columns`` only.

    The rows are worked out and stored once. A filter on the hash would be pushed below them, and
    every column they are made of would be worked out anew for the hash and on either side. They
    are stored by column, so that a pass reads what it uses.
    """
    names = [f"_draw_{i}" for i in range(len(seeds))]
    drawn = df.select(*columns, *[_draw(df, seed).alias(name) for name, seed in zip(names, seeds)])
    rows = materialize(drawn, workspace(df.sparkSession, "splits"))
    cut = F.lit(round(share * 1_000_000))
    return [(rows.where(F.col(n) < cut).select(*columns), rows.where(F.col(n) >= cut).select(*columns)) for n in names]


def read_columns(inputs: Inputs) -> list[str]:
    """The columns that a model with these inputs reads; the route is made of its ends."""
    sources = [c for c in (*inputs.categorical, *inputs.numeric) if c != "Route"]
    if "Route" in inputs.categorical:
        sources += [c for c in ("Origin", "Dest") if c not in sources]
    return sources


def training_rows(
    df: DataFrame, inputs: Inputs, label: str, partitions: int | None = None, stored: bool = False
) -> DataFrame:
    """The labelled rows, cut down to what the model reads and stored once.

    Fitting passes over its rows many times; the joins and features behind them should run
    once. ``partitions`` spreads the rows by their content into so many parts, or into more if
    there are more than ``PART_ROWS`` rows a part; a forest draws its samples per part, so the
    same number gives the same forest on any machine. Rows that are ``stored`` already, and not to
    be spread, are read from where they are.
    """
    rows = df.where(F.col(label).isNotNull()).select(*read_columns(inputs), label)
    if partitions is not None:
        partitions = max(partitions, -(-rows.count() // PART_ROWS))
        rows = rows.repartition(partitions, F.xxhash64(*rows.columns)).sortWithinPartitions(*rows.columns)
    elif stored:
        return rows
    return checkpointed(rows)


def category_stages(inputs: Inputs) -> list:
    """Route, hashed categories and the indexes of all; unseen values get an index of their own."""
    values = {
        c: "concat(Origin, '-', Dest)" if c == "Route" else f"cast({c} AS STRING)"
        for c in inputs.categorical
    }
    texts = []
    for c, value in values.items():
        if c in inputs.hashed:
            value = f"cast(pmod(xxhash64({value}), {inputs.hashed[c]}) AS STRING)"
        texts.append(f"{value} AS {c}_text")
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(texts)} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"{c}_text" for c in inputs.categorical],
            outputCols=[f"{c}_index" for c in inputs.categorical],
            handleInvalid="keep",
        ),
    ]


def ordered_categories(indexer: StringIndexerModel, bins: int) -> StringIndexerModel:
    """``indexer`` with unused values added to short columns, so that no column counts as unordered.

    Of a column of few categories a forest of several classes tries every subset (127 for the days
    of the week), on every row and for every tree. Those of longer columns are put in order of
    their labels and cut there, like those of all other columns. Values in use keep their index.
    """
    # Spark's bound on the categories of an unordered column.
    most = int(math.log2(bins // 2 + 1) + 1)
    labels = [[*values, *[f"\x00unused {i}" for i in range(len(values), most)]] for values in indexer.labelsArray]
    return StringIndexerModel.from_arrays_of_labels(
        labels, inputCols=indexer.getInputCols(), outputCols=indexer.getOutputCols(), handleInvalid="keep"
    )


def fit_classifier(
    df: DataFrame, inputs: Inputs = Inputs(), *, label: str = LABEL, trees: int = 20,
    depth: int = 5, seed: int = 42, partitions: int | None = None,
) -> PipelineModel:
    """Random forest over indexed categories and numbers."""
    rows = training_rows(df, inputs, label, partitions)
    stages = category_stages(inputs)
    prepared = Pipeline(stages=stages).fit(rows)
    # A split must be able to tell all categories of a column apart.
    bins = max(32, *[len(values) + 1 for values in prepared.stages[-1].labelsArray])
    assembler = VectorAssembler(
        inputCols=[*inputs.numeric, *[f"{c}_index" for c in inputs.categorical]],
        outputCol="Features_vec", handleInvalid="keep",
    )
    forest = RandomForestClassifier(
        featuresCol="Features_vec", labelCol=label, predictionCol=PREDICTION,
        numTrees=trees, maxDepth=depth, maxBins=bins, seed=seed, maxMemoryInMB=1024,
    )
    texts, indexer = prepared.stages
    fitted = Pipeline(stages=[texts, ordered_categories(indexer, bins), assembler, forest]).fit(rows)
    # Values in use have the same index in both.
    return PipelineModel([texts, indexer, *fitted.stages[2:]])


def fit_regressor(
    df: DataFrame, inputs: Inputs, *, target: str = "ArrDelay", kind: str = "linear", seed: int = 42,
    stored: bool = False,
) -> PipelineModel:
    """Linear regression over one-hot categories and numbers, or boosted trees; ``stored`` as for ``training_rows``.

    The normal linear model of few features is the one ``LinearRegression`` finds, by the same
    solver; that class then goes through all rows once more for a summary nobody reads. Trees read
    a category as one column, not one for each of its values: a split may then send any set of
    values to a side, those in the order of their mean target, where a one-hot column tells a
    single value from the rest, and every pass over the rows counts as many columns less.
    """
    rows = training_rows(df, inputs, target, stored=stored)
    names = inputs.categorical
    prepared = Pipeline(stages=category_stages(inputs)).fit(rows)
    columns = {"featuresCol": "Features_vec", "labelCol": target, "predictionCol": PREDICTION}
    # Every column has an index more, of unseen values.
    sizes = [len(values) + 1 for values in prepared.stages[-1].labelsArray]
    if kind == "boosted":
        assembler = VectorAssembler(
            inputCols=[*inputs.numeric, *[f"{c}_index" for c in names]], outputCol="Features_vec",
        )
        set_checkpoints(df.sparkSession)  # each tree reads the errors of those before it
        trees = GBTRegressor(**columns, seed=seed, maxIter=20, maxBins=max(32, *sizes))
        return Pipeline(stages=[*prepared.stages, assembler, trees]).fit(rows)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in names], outputCols=[f"{c}_hot" for c in names],
        dropLast=False,
    )
    assembler = VectorAssembler(
        inputCols=[*inputs.numeric, *[f"{c}_hot" for c in names]], outputCol="Features_vec",
    )
    if len(inputs.numeric) + sum(sizes) <= SOLVED_FEATURES:
        model = GeneralizedLinearRegression(**columns, family="gaussian", link="identity", regParam=0.01)
    else:
        model = LinearRegression(**columns, regParam=0.01, maxIter=50)
    return Pipeline(stages=[*prepared.stages, encoder, assembler, model]).fit(rows)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions with the input columns; the model's own columns are dropped."""
    return model.transform(df).select(*df.columns, PREDICTION)


def score_day(model: PipelineModel, spark: SparkSession, requests: str, results: str, day: str) -> None:
    """Score one day of stored requests and replace that day's results; a day without any adds none."""
    scored = predict(model, read_day(spark, requests, day, STORED_REQUESTS))
    write_days(scored, results, "ds")


def repeated_evaluation(
    df: DataFrame, seeds: Sequence[int], inputs: Inputs = Inputs(), share: float = 0.8, **options
) -> tuple[DataFrame, list[PipelineModel]]:
    """Metrics of one split per seed as rows (run, metric, score), and the fitted models.

    The rows are stored once; every split reads what is stored.
    """
    tables, models = [], []
    for seed, (train, test) in zip(seeds, stored_splits(df, share, seeds, [*read_columns(inputs), LABEL])):
        model = fit_classifier(train, inputs, seed=seed, **options)
        scores = classification(predict(model, test), LABEL, PREDICTION)
        tables.append(scores.select(F.lit(seed).alias("run"), "metric", "score"))
        models.append(model)
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out, models


def importance_deltas(spark: SparkSession, models: Sequence[PipelineModel], previous: Sequence[PipelineModel]) -> DataFrame:
    """Mean importances over all splits and their change against those of the previous run."""
    before = importances(spark, previous).select("feature", F.col("importance").alias("_before"))
    return importances(spark, models).join(before, "feature", "left").select(
        "feature", "importance", (F.col("importance") - F.coalesce("_before", "importance")).alias("delta")
    )


def importances(spark: SparkSession, models: Sequence[PipelineModel]) -> DataFrame:
    """Mean importance of every feature over the models, largest first."""
    rows = [
        (name, float(value))
        for m in models
        for name, value in zip(m.stages[-2].getInputCols(), m.stages[-1].featureImportances.toArray())
    ]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(
        F.desc("importance"), "feature"
    )
