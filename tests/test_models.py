import glob
import math
import os

import pytest
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from delaylens.operators import experiments, features, models
from delaylens.plans import models as bound
from delaylens.session import checkpointed
from delaylens.sources import readers, writers
from delaylens.streaming import scoring
from delaylens.plans import bindings as b


@pytest.fixture(scope="module")
def fitted(spark, folder):
    return models.fit_classifier(bound._labelled(spark, folder), trees=3, depth=3)


def test_saved_model_predicts_the_same(spark, folder, fitted, tmp_path):
    models.save_model(fitted, str(tmp_path / "m"))
    asked = b.request_features(spark, folder)
    first = models.predict(fitted, asked).orderBy("UUID").collect()
    assert first == models.predict(models.load_model(str(tmp_path / "m")), asked).orderBy("UUID").collect()
    assert {r.Prediction for r in first} <= {0.0, 1.0, 2.0, 3.0}


def test_unseen_categories_are_scored(spark, folder, fitted):
    asked = b.request_features(spark, folder).withColumn("Origin", F.lit("NOWHERE")).limit(3)
    assert models.predict(fitted, asked).where("Prediction IS NOT NULL").count() == 3


def test_declared_categories_are_hashed(spark, folder):
    inputs = models.Inputs(hashed={"Route": 40})
    fitted = models.fit_classifier(bound._labelled(spark, folder), inputs, trees=2, depth=2)
    sizes = dict(zip(inputs.categorical, map(len, fitted.stages[1].labelsArray)))
    assert sizes["DayOfYear"] > 300 and sizes["Route"] <= 40 and sizes["Carrier"] == 5
    assert models.predict(fitted, b.request_features(spark, folder)).count() > 0


def test_day_and_stream_give_the_same_predictions(spark, folder, fitted, tmp_path):
    asked = b.request_features(spark, folder)
    writers.write_days(asked, str(tmp_path / "requests"), "Timestamp")
    days = [str(r.ds) for r in spark.read.parquet(str(tmp_path / "requests")).select("ds").distinct().collect()]
    for day in days + days[:1]:
        models.score_day(fitted, spark, str(tmp_path / "requests"), str(tmp_path / "results"), day)
    stored = spark.read.parquet(str(tmp_path / "results"))
    assert stored.count() == asked.count()
    messages = writers.to_json_rows(asked)
    writers.write_text(messages, str(tmp_path / "messages"))
    stream = scoring.score(fitted, scoring.message_files(spark, str(tmp_path / "messages")))
    for _ in range(2):
        writer = scoring.write_answers(stream, str(tmp_path / "out"), str(tmp_path / "state"), interval=None)
        writer.start().awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = {r.UUID: r.Prediction for r in stored.collect()}
    assert {r.UUID: r.Prediction for r in streamed.collect()} == batch
    assert streamed.count() == len(batch)


def test_unreadable_and_repeated_messages(spark, tmp_path):
    good = '{"UUID":"u1","Carrier":"AA","DepDelay":3.5,"Timestamp":"2024-01-01T00:00:00Z"}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([good, good, "{broken"]))
    parsed = scoring.parse(scoring.message_files(spark, str(tmp_path / "in")))
    for name, stream in (
        ("kept", scoring.deduplicated(scoring.readable(parsed))), ("bad", scoring.unreadable(parsed)),
    ):
        out = str(tmp_path / name)
        scoring.write_batches(stream, out, str(tmp_path / f"{name}-state"), interval=None).start().awaitTermination()
    assert [r.UUID for r in spark.read.parquet(str(tmp_path / "kept")).collect()] == ["u1"]
    assert [r[readers.CORRUPT] for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["{broken"]


def test_split_is_stable_and_complete(spark, folder):
    rows = bound._labelled(spark, folder)
    train, test = models.split_by_hash(rows, 0.8, seed=1)
    again, _ = models.split_by_hash(rows.repartition(3), 0.8, seed=1)
    assert train.count() + test.count() == rows.count()
    assert train.count() == again.count() and 0.7 < train.count() / rows.count() < 0.9


def test_boosted_and_linear_regression(spark, folder):
    rows = bound._base(spark, folder)
    for kind in ("linear", "boosted"):
        inputs = models.Inputs(categorical=("Carrier",), numeric=("DepDelay", "Distance"))
        fitted = models.fit_regressor(rows.limit(1500), inputs, kind=kind)
        error = models.predict(fitted, rows).agg(F.avg(F.abs(F.col("ArrDelay") - F.col("Prediction")))).first()[0]
        assert error < 15


def test_experiment_log(spark, tmp_path):
    scores = spark.createDataFrame([("f1", 0.5), ("f1", 0.7), ("accuracy", 1.0)], "metric string, score double")
    better = spark.createDataFrame([("f1", 0.9), ("accuracy", 1.0)], "metric string, score double")
    for run in (*range(1, 12), 12, 12):
        experiments.append_run(experiments.summarize(better if run == 12 else scores), str(tmp_path / "log"), run)
    log = experiments.run_deltas(experiments.read_log(spark, str(tmp_path / "log")), score="average")
    found = {(r.run, r.metric): r.delta for r in log.collect()}
    assert len(found) == 24 == log.count()
    assert found[12, "f1"] == pytest.approx(0.3) and all(found[i, "f1"] == 0 for i in range(1, 12))
    with pytest.raises(TypeError):
        experiments.run_deltas(scores.withColumn("run", F.lit("9")))


def test_late_and_repeated_requests_are_answered_once(spark, fitted, tmp_path):
    row = '{{"UUID":"{}","Carrier":"AA","DepDelay":3.5,"Timestamp":"2024-01-{}T00:00:00Z"}}'
    (tmp_path / "in").mkdir()
    files = [[("a", "05")], [("b", "01"), ("a", "05")], [("c", "02"), ("b", "01"), ("c", "02")]]
    for i, rows in enumerate(files):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(row.format(*r) for r in rows))
        os.utime(tmp_path / "in" / f"{i}.txt", (1000 + i, 1000 + i))
    messages = scoring.message_files(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)
    stream = scoring.score(fitted, messages)
    scoring.write_answers(stream, str(tmp_path / "out"), str(tmp_path / "state"), interval=None).start().awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.UUID, str(r.ds)) for r in stored.collect()) == [("a", "2024-01-05"), ("b", "2024-01-01"), ("c", "2024-01-02")]
    assert stored.select("batch_id").distinct().count() == 3


def test_a_day_without_requests(spark, folder, fitted, tmp_path):
    none = b.request_features(spark, folder).where("false")
    writers.write_days(none, str(tmp_path / "requests"), "Timestamp")
    models.score_day(fitted, spark, str(tmp_path / "requests"), str(tmp_path / "results"), "2024-01-02")
    assert spark.read.schema(readers.STORED_RESULTS).parquet(str(tmp_path / "results")).count() == 0


def test_day_fetch_reaches_the_scan(spark, folder):
    asked = b.request_features(spark, folder).withColumn("iso", F.date_format("Timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    plan = readers.iso_day_slice(asked, "iso", "2024-01-02", at="Timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan.split("PushedFilters")[1]


def test_partitions_settle_the_forest(spark, folder):
    rows = bound._labelled(spark, folder)
    one, two = (
        models.fit_classifier(df, trees=3, depth=3, partitions=4).stages[-1].featureImportances.toArray()
        for df in (rows, rows.repartition(7))
    )
    assert one.tolist() == two.tolist()


def test_short_columns_are_cut_in_order_of_labels(spark, folder, fitted):
    # Spark tries every subset of a column with fewer categories than this, on every row.
    bins = max(32, *[len(values) + 1 for values in fitted.stages[1].labelsArray])
    least = int(math.log2(bins // 2 + 1) + 1)
    indexer = models.ordered_categories(fitted.stages[1], bins)
    assert all(len(values) >= least for values in indexer.labelsArray)
    assert all(a[: len(b)] == b for a, b in zip(map(list, indexer.labelsArray), map(list, fitted.stages[1].labelsArray)))
    # A column of three values, of which each class has one, has four categories with that of unseen values.
    rows = spark.range(3000).selectExpr("cast(id % 3 as string) c", "cast((id + 1) % 3 as double) y", "cast(id % 5 as double) x")
    own = models.fit_classifier(rows, models.Inputs(categorical=("c",), numeric=("x",)), label="y", trees=3, depth=3)
    assert own.stages[-1].trees[0]._call_java("rootNode").split().numCategories() > int(math.log2(32 // 2 + 1) + 1)
    assert models.predict(own, rows).where(f"{models.PREDICTION} <> y").isEmpty()


def test_stored_splits_are_those_by_hash(spark, folder):
    rows = bound._labelled(spark, folder)
    columns = ["Carrier", "DepDelay", models.LABEL]
    for seed, sides in zip((1, 2), models.stored_splits(rows, 0.8, [1, 2], columns)):
        for stored, plain in zip(sides, models.split_by_hash(rows, 0.8, seed)):
            assert stored.columns == columns
            assert stored.exceptAll(plain.select(columns)).isEmpty() and plain.select(columns).exceptAll(stored).isEmpty()
    # The features are not worked out again on either side.
    assert "lineitem" not in sides[0]._jdf.queryExecution().toString()


def test_parts_of_training_rows_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "PART_ROWS", 100)
    inputs = models.Inputs(categorical=("c",), numeric=("x",))
    rows = spark.range(1000).selectExpr("cast(id % 7 as string) c", "cast(id as double) x", "cast(id % 2 as double) y")
    assert models.training_rows(rows, inputs, "y", 4).rdd.getNumPartitions() == 10
    assert models.training_rows(rows, inputs, "y", 16).rdd.getNumPartitions() == 16


def test_history_leaves_the_row_itself_out(spark):
    kinds = "k string, a double, b double"
    train = spark.createDataFrame([("x", 5.0, 1.0), ("x", 9.0, 3.0), ("y", 2.0, 1.0), (None, 7.0, 1.0), (None, 9.0, 1.0), ("z", None, 1.0)], kinds)
    test = spark.createDataFrame([("x", 100.0, 1.0), ("y", 100.0, 1.0), ("w", 1.0, 0.0), (None, 1.0, 0.0), ("z", 1.0, 0.0)], kinds)
    train, test = features.with_history(train, test, "k", F.col("a") - F.col("b"), "gained")
    assert sorted((r.k or "", r.a or 0.0, r.gained) for r in train.collect()) == [
        ("", 7.0, 0.0), ("", 9.0, 0.0), ("x", 5.0, 6.0), ("x", 9.0, 4.0), ("y", 2.0, 0.0), ("z", 0.0, 0.0)
    ]
    assert {r.k: r.gained for r in test.collect()} == {"x": 5.0, "y": 1.0, "w": 0.0, None: 0.0, "z": 0.0}


def test_boosted_trees_beat_the_departure_by_far(spark, folder):
    # Of the columns themselves nothing tells what a flight gains, so a model of these alone wins by chance only.
    train, test = bound._split_delays(spark, folder, "FlightNum")
    gained = F.col("ArrDelay") - F.col("DepDelay")
    train, test = features.with_history(train, test, "FlightNum", gained, "Gained")
    fitted = models.fit_regressor(train, bound.HISTORY_INPUTS, kind="boosted")
    error = lambda guess: F.avg((F.col("ArrDelay") - F.col(guess)) ** 2).alias(guess)
    found = models.predict(fitted, test).agg(error(models.PREDICTION), error("DepDelay")).first()
    assert found[models.PREDICTION] < 0.8 * found["DepDelay"]


def test_trees_read_a_category_as_one_column(spark):
    rows = spark.range(2000).selectExpr("concat('c', id % 40) c", "cast(id % 3 as double) x", "cast(id % 40 % 2 * 10 as double) y")
    inputs = models.Inputs(categorical=("c",), numeric=("x",))
    fitted = models.fit_regressor(rows, inputs, target="y", kind="boosted")
    # One split sends twenty of the forty values to either side.
    assert fitted.stages[-1].numFeatures == 2 and fitted.stages[-1].trees[0].numNodes == 3
    assert models.predict(fitted, rows).where("abs(Prediction - y) > 1e-6").isEmpty()
    unseen = models.predict(fitted, rows.limit(1).withColumn("c", F.lit("new")))
    assert unseen.first().Prediction is not None


def test_stamped_requests(spark):
    found = features.stamped(spark.createDataFrame([(1,), (2,)], "i int")).collect()
    assert len({r.UUID for r in found}) == 2 and all(len(r.UUID) == 36 and r.Timestamp for r in found)


def test_console_sink(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo")
    writer = scoring.write_console(scoring.message_files(spark, str(tmp_path / "in")), str(tmp_path / "state"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in progress) == 2
    assert "Console" in progress[0]["sink"]["description"]


def test_importances_and_repeats(spark, folder):
    runs, fitted = models.repeated_evaluation(bound._labelled(spark, folder), [1, 2], trees=2, depth=2)
    assert runs.count() == 8
    table = models.importances(spark, fitted).collect()
    assert sum(r.importance for r in table) == pytest.approx(1.0)
    assert table == sorted(table, key=lambda r: (-r.importance, r.feature))


def test_one_hot_stage_of_unseen_value(spark, folder):
    inputs = models.Inputs(categorical=("Carrier",), numeric=("DepDelay",))
    fitted = models.fit_regressor(bound._base(spark, folder), inputs)
    row = b.request_features(spark, folder).limit(1).withColumn("Carrier", F.lit("new"))
    assert models.predict(fitted, row).first().Prediction is not None


def test_linear_model_reads_stored_rows_where_they_are(spark, folder, monkeypatch):
    inputs = bound.REGRESSION_INPUTS
    columns = [*models.read_columns(inputs), "ArrDelay"]
    train, test = models.stored_splits(bound._base(spark, folder), 0.8, [42], columns)[0]
    checkpoints = lambda: glob.glob(spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/rdd-*")
    checkpointed(spark.range(1))
    before = checkpoints()
    assert before
    fitted = models.fit_regressor(train, inputs, stored=True)
    assert checkpoints() == before
    # The same model as that of the class which goes through the rows once more.
    monkeypatch.setattr(models, "SOLVED_FEATURES", 0)
    wide = models.fit_regressor(train, inputs)
    assert isinstance(wide.stages[-1], LinearRegressionModel) and not isinstance(fitted.stages[-1], LinearRegressionModel)
    assert len(checkpoints()) == len(before) + 1
    assert list(fitted.stages[-1].coefficients) == pytest.approx(list(wide.stages[-1].coefficients), rel=1e-9, abs=1e-9)
    ours, theirs = ([r.Prediction for r in models.predict(m, test).collect()] for m in (fitted, wide))
    assert ours == pytest.approx(theirs, rel=1e-9, abs=1e-9)
