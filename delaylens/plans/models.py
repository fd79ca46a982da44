"""Features, models, metrics, daily batches and streams."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from delaylens.functions.buckets import delay_bucket
from delaylens.functions.clock import iso_text
from delaylens.operators import features, metrics, models, summary
from delaylens.plans import bindings as b
from delaylens.plans.registry import query
from delaylens.plans.summaries import BUCKET_SQL, FLIGHTS, SCHEDULED_SQL
from delaylens.session import checkpointed, workspace
from delaylens.sources import readers
from delaylens.sources.readers import iso_day_slice
from delaylens.sources.writers import materialize, write_days
from delaylens.streaming import scoring
from delaylens.streaming.pairing import paired

_FLIGHT = (
    "FlightNum", "FlightDate", "Carrier", "Origin", "Dest", "Distance", "DepDelay", "ArrDelay",
    "CRSDepTime", "CRSArrTime",
)
REGRESSION_INPUTS = models.Inputs(
    categorical=("Carrier", "DayOfWeek", "Origin", "Dest"), numeric=("DepDelay", "Distance", "DayOfYear"),
)
HISTORY_INPUTS = models.Inputs(categorical=REGRESSION_INPUTS.categorical, numeric=(*REGRESSION_INPUTS.numeric, "Gained"))
_BASE_SQL = f"""base AS (SELECT ArrDelay, CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS CRSArrTime,
    dep AS CRSDepTime, Carrier, CAST(day(FlightDate) AS INT) AS DayOfMonth, CAST(isodow(FlightDate) AS INT) AS DayOfWeek,
    CAST(dayofyear(FlightDate) AS INT) AS DayOfYear, DepDelay, Dest, Distance, FlightDate, FlightNum, Origin, TailNum
    FROM (SELECT * RENAME (CRSDepTime AS d, CRSArrTime AS a) FROM scheduled) WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL)"""
_ATTRIBUTES = ", ".join(f"coalesce(p.{c}, 'Empty') AS {c}" for c in features.AIRPLANE_ATTRIBUTES)
_WITH_AIRPLANE_SQL = f"""with_airplane AS (SELECT base.* REPLACE (CASE WHEN base.TailNum <> '' THEN base.TailNum
    ELSE 'Empty' END AS TailNum), Origin || '-' || Dest AS Route, {_ATTRIBUTES}
    FROM base LEFT JOIN airplanes p ON base.TailNum = p.TailNum)"""


def _base(spark, folder, *extra):
    return features.base_features(b.flights(spark, folder, *_FLIGHT, *extra), extra)


def _labelled(spark, folder):
    return models.bucketed(_base(spark, folder))


@query(f"WITH {FLIGHTS}, {SCHEDULED_SQL}, {_BASE_SQL} SELECT * EXCLUDE (TailNum) FROM base")
def base_features(spark, folder):
    return _base(spark, folder)


@query(f"WITH {FLIGHTS}, {SCHEDULED_SQL}, {b.KNOWN_AIRPLANES_SQL}, {_BASE_SQL}, {_WITH_AIRPLANE_SQL} SELECT * FROM with_airplane")
def features_with_airplane(spark, folder):
    return features.with_airplane(_base(spark, folder, "TailNum"), b.known_airplanes(spark, folder))


@query(f"""WITH {FLIGHTS}, {SCHEDULED_SQL}, {b.KNOWN_AIRPLANES_SQL}, {_BASE_SQL}, {_WITH_AIRPLANE_SQL}
    SELECT *, datediff('second', CRSDepTime, CRSArrTime) AS FlightTime, CAST(hour(CRSDepTime) AS INT) AS CRSDepHourOfDay,
    CAST(hour(CRSArrTime) AS INT) AS CRSArrHourOfDay FROM with_airplane""")
def features_full(spark, folder):
    return features.with_times(features_with_airplane(spark, folder))


_SCORED_SQL = f"""scored AS (SELECT {BUCKET_SQL.format(d='ArrDelay')} AS label,
    {BUCKET_SQL.format(d='DepDelay')} AS prediction FROM flights WHERE ArrDelay IS NOT NULL)"""


def _scored(spark, folder):
    flights = b.flights(spark, folder, "ArrDelay", "DepDelay").where("ArrDelay IS NOT NULL")
    return flights.select(
        delay_bucket(F.col("ArrDelay")).alias("label"), delay_bucket(F.col("DepDelay")).alias("prediction")
    )


@query(f"""WITH {FLIGHTS}, {_SCORED_SQL}, k AS (SELECT DISTINCT label AS c FROM scored),
    p AS (SELECT c, count(*) FILTER (label = c) AS actual, count(*) FILTER (prediction = c) AS predicted,
        count(*) FILTER (label = c AND prediction = c) AS hit FROM k, scored GROUP BY c),
    s AS (SELECT *, coalesce(hit / nullif(predicted, 0), 0) AS pr, hit / actual AS re FROM p),
    m AS (SELECT sum(hit) / sum(actual) AS accuracy, sum(pr * actual) / sum(actual) AS wp, sum(re * actual) / sum(actual) AS wr,
        sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0) * actual) / sum(actual) AS f1 FROM s)
    SELECT 'accuracy' AS metric, round(accuracy, 9) AS score FROM m UNION ALL SELECT 'weightedPrecision', round(wp, 9) FROM m
    UNION ALL SELECT 'weightedRecall', round(wr, 9) FROM m UNION ALL SELECT 'f1', round(f1, 9) FROM m""")
def classification_metrics(spark, folder):
    table = metrics.classification(_scored(spark, folder), "label", "prediction")
    return table.withColumn("score", F.round("score", 9))


@query(f"""WITH {FLIGHTS} SELECT median(abs(ArrDelay - DepDelay)) AS median_absolute_error,
    round(1 - sum(pow(ArrDelay - DepDelay, 2)) / (var_pop(ArrDelay) * count(ArrDelay)), 9) AS r2 FROM flights""")
def regression_metrics(spark, folder):
    table = metrics.regression(b.flights(spark, folder, "ArrDelay", "DepDelay"), "ArrDelay", "DepDelay")
    return table.withColumn("r2", F.round("r2", 9))


@query(f"""WITH {FLIGHTS}, {_SCORED_SQL}, a AS (SELECT label AS bucket, count(*) AS labels FROM scored GROUP BY 1),
    p AS (SELECT prediction AS bucket, count(*) AS predictions FROM scored GROUP BY 1)
    SELECT bucket, coalesce(labels, 0) AS labels, coalesce(predictions, 0) AS predictions FROM a FULL JOIN p USING (bucket)""")
def prediction_vs_actual(spark, folder):
    scored = _scored(spark, folder)
    labels = scored.select(F.col("label").alias("bucket"))
    predictions = scored.select(F.col("prediction").alias("bucket"))
    return summary.compare_counts(labels, predictions, "bucket", ["labels", "predictions"])


# ---- trained models

def _split(spark, folder):
    columns = [*models.read_columns(models.Inputs()), models.LABEL]
    return models.stored_splits(_labelled(spark, folder), 0.8, [42], columns)[0]


def _split_delays(spark, folder, *extra):
    columns = [*models.read_columns(REGRESSION_INPUTS), "ArrDelay", *extra]
    return models.stored_splits(_base(spark, folder), 0.8, [42], columns)[0]


def _fit(spark, folder, train=None):
    """Fit the forest to the folder's training rows, store it and load what was stored."""
    path = _model_path(spark, folder)
    train = _split(spark, folder)[0] if train is None else train
    models.save_model(models.fit_classifier(train, partitions=8), path)
    return models.load_model(path)


def _model_path(spark, folder):
    """Where the forest of these rows is stored: changed tables have another place."""
    return b.stored_path(spark, folder, "forest")


def classifier(spark, folder):
    """The stored forest of these tables; fitted if none is stored."""
    try:
        return models.load_model(_model_path(spark, folder))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return _fit(spark, folder)


@query("""SELECT * FROM (VALUES ('accuracy', true), ('weightedPrecision', true), ('weightedRecall', true), ('f1', true))
    t(metric, beats_majority)""")
def train_score_rf(spark, folder):
    """Whether each metric on the held-out rows beats that of always predicting the largest class."""
    train, test = _split(spark, folder)
    scored = checkpointed(models.predict(_fit(spark, folder, train), test).select(models.LABEL, models.PREDICTION))
    found = metrics.classification(scored, models.LABEL, models.PREDICTION)
    largest = train.groupBy(models.LABEL).count().orderBy(F.desc("count"), models.LABEL).first()[models.LABEL]
    plain = metrics.classification(scored.withColumn(models.PREDICTION, F.lit(largest)), models.LABEL, models.PREDICTION)
    plain = plain.select("metric", F.col("score").alias("least"))
    return found.join(plain, "metric").select("metric", (F.col("score") > F.col("least")).alias("beats_majority"))


@query("""SELECT * FROM (VALUES (1), (2), (3)) r(run),
    (VALUES ('accuracy'), ('weightedPrecision'), ('weightedRecall'), ('f1')) m(metric), (VALUES (true)) s(plausible)""")
def cv_metrics(spark, folder):
    """Three splits; each metric lies between that of a coin of four sides and 1."""
    runs, _ = models.repeated_evaluation(_labelled(spark, folder), seeds=[1, 2, 3], trees=10, depth=4, partitions=8)
    return runs.select("run", "metric", F.col("score").between(0.25, 1.0).alias("plausible"))


@query("""SELECT *, true AS sums_to_one, true AS delta_fits FROM (VALUES ('Carrier_index'), ('DayOfMonth_index'), ('DayOfWeek_index'),
    ('DayOfYear_index'), ('DepDelay'), ('Dest_index'), ('Distance'), ('Origin_index'), ('Route_index')) t(feature)""")
def feature_importances(spark, folder):
    """Importances over all splits of a run and their change against a run of fewer trees."""
    rows = _labelled(spark, folder)
    runs = [
        models.repeated_evaluation(rows, seeds=[1, 2], trees=trees, depth=4, partitions=8)[1] for trees in (4, 8)
    ]
    table = models.importance_deltas(spark, runs[1], runs[0])
    total = table.agg(F.sum("importance").alias("s"), F.sum("delta").alias("d"))
    one = (F.abs(total.select("s").scalar() - 1) < 1e-6).alias("sums_to_one")
    # Both runs sum to one, so the changes cancel.
    fits = (F.abs(total.select("d").scalar()) < 1e-6).alias("delta_fits")
    return table.select("feature", one, fits)


@query("SELECT true AS r2_above_three_quarters, true AS median_error_below_twelve")
def train_score_regression(spark, folder):
    train, test = _split_delays(spark, folder)
    fitted = models.fit_regressor(train, REGRESSION_INPUTS, stored=True)
    # The median takes several passes; the predictions are made once.
    scored = checkpointed(models.predict(fitted, test).select("ArrDelay", models.PREDICTION))
    found = metrics.regression(scored, "ArrDelay", models.PREDICTION)
    return found.select(
        (F.col("r2") > 0.75).alias("r2_above_three_quarters"),
        (F.col("median_absolute_error") < 12).alias("median_error_below_twelve"),
    )


@query(f"""WITH {FLIGHTS} SELECT Carrier, count(*) AS scored, true AS beats_mean, true AS beats_departure FROM flights
    WHERE ArrDelay IS NOT NULL AND DepDelay IS NOT NULL GROUP BY Carrier""")
def train_score_boosted(spark, folder):
    """Boosted trees: per carrier, the rows scored, and whether held-out squared errors are below simpler ones.

    These are those of the mean delay of the training rows, and of the departure's own delay. What
    a flight gains on its way depends on its number alone, so the trees read what the training rows
    of the number gained.
    """
    train, test = _split_delays(spark, folder, "FlightNum")
    gained = F.col("ArrDelay") - F.col("DepDelay")
    train, test = features.with_history(train, test, "FlightNum", gained, "Gained")
    held = train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True)))
    # Stored by column: the passes over the training rows and the one of the scores read what they use.
    rows = materialize(held.drop("FlightNum"), workspace(spark, "history"))
    train = rows.where(~F.col("held"))
    fitted = models.fit_regressor(train, HISTORY_INPUTS, kind="boosted", stored=True)
    mean = train.agg(F.avg("ArrDelay").alias("mean")).first()["mean"]
    scored = models.predict(fitted, rows)

    def error(guess):
        return F.avg(F.when(F.col("held"), (F.col("ArrDelay") - guess) ** 2))

    own = error(F.col(models.PREDICTION))
    return scored.groupBy("Carrier").agg(
        F.count(models.PREDICTION).alias("scored"),
        (own < error(F.lit(mean))).alias("beats_mean"), (own < error(F.col("DepDelay"))).alias("beats_departure"),
    )


def _known():
    return F.col(models.PREDICTION).isin(0.0, 1.0, 2.0, 3.0).alias("known_bucket")


@query(f"""WITH {b.REQUESTS_SQL} SELECT UUID, Carrier, Origin, Dest, true AS known_bucket, CAST("Timestamp" AS DATE) AS ds
    FROM requests WHERE strftime("Timestamp", '%Y-%m-%dT%H:%M:%S') BETWEEN '2024-01-02' AND '2024-01-03'
    AND CAST("Timestamp" AS DATE) = DATE '2024-01-02'""")
def batch_score_day(spark, folder):
    """Fetch a day's requests, store them as that day's partition, score it, read the results."""
    requests, results = workspace(spark, "requests"), workspace(spark, "results")
    wanted = b.request_features(spark, folder).withColumn("iso_time", iso_text(F.col("Timestamp")))
    day = iso_day_slice(wanted, "iso_time", "2024-01-02", at="Timestamp").drop("iso_time")
    write_days(day, requests, "Timestamp")
    models.score_day(classifier(spark, folder), spark, requests, results, "2024-01-02")
    stored = spark.read.schema(readers.STORED_RESULTS).parquet(results)
    return stored.select("UUID", "Carrier", "Origin", "Dest", _known(), "ds")


# ---- streams


def _messages(spark, folder):
    """Request messages, from the events table read as a stream."""
    return b.request_messages(spark, folder)


def _run(stream, spark, name, write=scoring.write_batches):
    """Process what is there, batch by batch, and read the stored result."""
    out = workspace(spark, name)
    write(stream, out, workspace(spark, f"{name}-state"), interval=None).start().awaitTermination()
    return spark.read.parquet(out)


_MESSAGES = f"""WITH {b.REQUESTS_SQL} SELECT UUID, Carrier, Origin, Dest, FlightDate, FlightNum, DepDelay FROM requests"""


@query(_MESSAGES)
def stream_parse(spark, folder):
    parsed = scoring.readable(scoring.parse(_messages(spark, folder)))
    return _run(parsed, spark, "parsed").select(
        "UUID", "Carrier", "Origin", "Dest", "FlightDate", "FlightNum", "DepDelay"
    )


@query(_MESSAGES)
def stream_dedupe(spark, folder):
    twice = _messages(spark, folder).select(F.explode(F.array("value", "value")).alias("value"))
    parsed = scoring.readable(scoring.parse(twice))
    return _run(parsed, spark, "deduplicated", scoring.write_answers).select(
        "UUID", "Carrier", "Origin", "Dest", "FlightDate", "FlightNum", "DepDelay"
    )


@query(_MESSAGES.replace("FlightDate, FlightNum, DepDelay FROM", "true AS known_bucket FROM"))
def stream_score(spark, folder):
    scored = scoring.score(classifier(spark, folder), _messages(spark, folder))
    return _run(scored, spark, "scored", scoring.write_answers).select("UUID", "Carrier", "Origin", "Dest", _known())


@query(f"""WITH {b.REQUESTS_SQL}, a AS (SELECT CAST(event_id AS VARCHAR) AS UUID, ts + to_minutes(CAST(event_id % 7 AS INT)) AS answered,
        CAST(event_id % 4 AS DOUBLE) AS Prediction FROM events WHERE value >= 20),
    passed AS (SELECT least((SELECT max(ts) FROM events), (SELECT max(answered) FROM a)) - INTERVAL 10 MINUTE AS mark),
    p AS (SELECT r.UUID, Carrier, Origin, Dest, r."Timestamp" AS asked, a.answered, a.Prediction
        FROM requests r LEFT JOIN a ON r.UUID = a.UUID AND a.answered BETWEEN r."Timestamp" AND r."Timestamp" + INTERVAL 5 MINUTE)
    SELECT UUID, Carrier, Origin, Dest, CASE WHEN answered IS NULL THEN 'WAIT' ELSE 'OK' END AS status, Prediction
    FROM p, passed WHERE answered IS NOT NULL OR asked < mark - INTERVAL 5 MINUTE""")
def stream_pairs(spark, folder):
    """Requests with their responses, or known to have none: both sides are streams."""
    pairs = paired(b.request_stream(spark, folder), b.response_stream(spark, folder), "UUID", "asked", "answered", ["Prediction"])
    return _run(pairs, spark, "pairs").select("UUID", "Carrier", "Origin", "Dest", "status", "Prediction")


@query(f"""WITH {b.REQUESTS_SQL} SELECT CAST(FlightDate AS DATE) AS FlightDate, false AS failed, count(*) AS n, count(DISTINCT UUID) AS different
    FROM requests WHERE CAST(FlightNum AS BIGINT) % 17 <> 0 GROUP BY FlightDate
    UNION ALL SELECT NULL, true, count(*), count(DISTINCT UUID[1:11]) FROM requests WHERE CAST(FlightNum AS BIGINT) % 17 = 0 HAVING count(*) > 0""")
def stream_split(spark, folder):
    """Messages that can be read, by day, and those that can't, from the two tables of one stream."""
    parsed = scoring.parse(b.damaged_messages(spark, folder))
    good, bad = workspace(spark, "good"), workspace(spark, "bad")
    scoring.write_split(parsed, good, bad, workspace(spark, "split-state"), interval=None).start().awaitTermination()
    rows = spark.read.parquet(good).groupBy("FlightDate").agg(F.lit(False).alias("failed"), F.count("*").alias("n"), F.countDistinct("UUID").alias("different"))
    text = F.regexp_extract(readers.CORRUPT, '"UUID":"([0-9]*)', 1)
    lost = spark.read.schema(f"{readers.CORRUPT} string").parquet(bad).agg(F.lit(True).alias("failed"), F.count("*").alias("n"), F.countDistinct(text).alias("different"))
    return rows.unionByName(lost.where("n > 0").select(F.lit(None).cast("date").alias("FlightDate"), "failed", "n", "different"))
