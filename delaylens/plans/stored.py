"""Tables written in each format and read back, over whole tables."""

from pyspark.sql import functions as F

from delaylens.operators import experiments, features, summary
from delaylens.plans import bindings as b
from delaylens.plans.registry import query
from delaylens.plans.summaries import FLIGHTS
from delaylens.session import workspace
from delaylens.sources import readers, writers

_ROW = ("FlightNum", "FlightDate", "Carrier", "TailNum", "Origin", "Dest", "DepDelay", "Distance")


def _flights(spark, folder):
    return b.flights(spark, folder, *_ROW)


def _files(rows, ending):
    """Whether all rows come from files of this ending."""
    return rows.withColumn("packed", F.col("_metadata.file_name").endswith(ending))


# ---- delimited text


@query(f"""WITH {FLIGHTS} SELECT CAST(FlightNum AS INT) AS FlightNum, FlightDate, Carrier, nullif(TailNum, '') AS TailNum,
    Origin, Dest, DepDelay, Distance FROM flights""")
def csv_inferred(spark, folder):
    """Types found from the texts; empty fields are null."""
    path = workspace(spark, "csv")
    writers.write_delimited(_flights(spark, folder), path)
    return readers.read_delimited(spark, path, infer=True)


@query(f"""WITH {FLIGHTS} SELECT FlightNum, CAST(FlightDate AS VARCHAR) AS FlightDate, Carrier, nullif(TailNum, '') AS TailNum,
    Origin, Dest, CAST(DepDelay AS VARCHAR) AS DepDelay, CAST(Distance AS VARCHAR) AS Distance FROM flights""")
def csv_as_texts(spark, folder):
    path = workspace(spark, "csv")
    writers.write_delimited(_flights(spark, folder), path)
    return readers.read_delimited(spark, path)


_AIRLINE = """s_suppkey AS ID, s_name AS Name, CASE WHEN s_acctbal > 2000 THEN concat('Alias, of ', s_name) END AS Alias,
    CASE WHEN s_suppkey % 5 <> 0 THEN concat('S', CAST(s_nationkey AS {text})) END AS IATA,
    CAST(NULL AS {text}) AS ICAO, upper(s_name) AS CallSign, n_name AS Country, CASE WHEN s_acctbal < 0 THEN 'N' ELSE 'Y' END AS Active"""


@query(f"SELECT {_AIRLINE.format(text='VARCHAR').replace('s_suppkey AS ID', 'CAST(s_suppkey AS INT) AS ID')} FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def csv_without_header(spark, folder):
    r"""A list of airlines without a header, of declared layout, with ``\N`` for null."""
    path = workspace(spark, "airlines")
    places = b.table(spark, folder, "supplier").join(b.table(spark, folder, "nation"), F.expr("s_nationkey = n_nationkey"))
    listed = places.select(F.expr(f"struct({_AIRLINE.format(text='STRING')})").alias("a")).select("a.*")
    writers.write_delimited(listed, path, header=False, null_token="\\N")
    return readers.read_delimited(spark, path, schema=readers.AIRLINES, header=False, null_token="\\N")


_STATION = ("WBAN_ID", "STATION_NAME", "STATE_PROVINCE", "COUNTY", "COUNTRY", "LOCATION")


@query(f"""WITH {b.STATIONS_SQL} SELECT CAST(WBAN_ID AS VARCHAR) AS WBAN_ID, {', '.join(_STATION[1:])},
    {len(readers.STATIONS) - len(_STATION)} AS empty FROM stations""")
def stations_with_pipes(spark, folder):
    """The station list with its declared columns, most of them empty."""
    path = workspace(spark, "stations")
    held = b.stations(spark, folder)
    columns = [F.col(c).cast("string").alias(c) if c in _STATION else F.lit(None).cast("string").alias(c) for c in readers.STATIONS.names]
    writers.write_delimited(held.select(*columns), path, sep="|")
    found = readers.read_delimited(spark, path, schema=readers.STATIONS, sep="|")
    empty = sum((F.col(c).isNull().cast("int") for c in readers.STATIONS.names if c not in _STATION), F.lit(0))
    return found.select(*_STATION, empty.alias("empty"))


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type AS kind, true AS packed
    FROM events WHERE event_type IN ('view', 'purchase')""")
def packed_files_by_pattern(spark, folder):
    """Compressed files of some folders, chosen by a pattern."""
    root = workspace(spark, "packed")
    events = b.table(spark, folder, "events").select("event_id", "user_id", F.col("event_type").alias("kind"))
    for kind in ("view", "purchase", "error"):
        writers.write_delimited(events.where(F.col("kind") == kind), f"{root}/of-{kind}", compression="gzip")
    found = readers.read_delimited(spark, f"{root}/of-[vp]*/*.csv.gz")
    return _files(found, ".csv.gz")


# ---- JSON lines


@query(f"WITH {FLIGHTS} SELECT {', '.join(_ROW)}, true AS packed FROM flights")
def json_lines_inferred(spark, folder):
    """Compressed JSON lines read without a schema; a column of dates comes back as text."""
    path = workspace(spark, "json")
    writers.write_json_lines(_flights(spark, folder), path, compression="gzip")
    found = _files(readers.read_json_lines(spark, path), ".json.gz")
    return found.withColumn("FlightDate", F.to_date("FlightDate")).select(*_ROW, "packed")


@query("""WITH t AS (SELECT *, event_id % 17 = 0 AS bad FROM events)
    SELECT CASE WHEN NOT bad THEN event_id END AS event_id, CASE WHEN NOT bad THEN user_id END AS user_id,
    CASE WHEN NOT bad THEN event_type END AS event_type, CASE WHEN bad THEN concat('{"event_id":', CAST(event_id AS VARCHAR), ',"user') END AS damaged
    FROM t""")
def json_lines_declared(spark, folder):
    """JSON lines read by a schema; those cut off in the middle are kept as they are."""
    path, kept = workspace(spark, "lines"), ("event_id", "user_id", "event_type")
    events = b.table(spark, folder, "events").select(*kept)
    line = F.to_json(F.struct(*kept))
    cut = F.regexp_extract(line, '^.*?,"user', 0)
    writers.write_text(events.select(F.when(F.col("event_id") % 17 == 0, cut).otherwise(line).alias("value")), path)
    found = readers.read_json_lines(spark, path, events.schema)
    whole = F.col(readers.CORRUPT).isNull()
    return found.select(*[F.when(whole, F.col(c)).alias(c) for c in kept], F.col(readers.CORRUPT).alias("damaged"))


@query(f"""WITH {FLIGHTS}, t AS (SELECT Year, Month, count(*) AS total FROM flights GROUP BY Year, Month)
    SELECT count(*) AS months, CAST(sum(total) AS BIGINT) AS flights, max(total) AS most FROM t""")
def json_in_one_file(spark, folder):
    """A small result as one file of JSON lines: its figures, by file."""
    path = workspace(spark, "one")
    totals = summary.totals_in_order(b.flights(spark, folder, "Year", "Month"), ["Year", "Month"], "total")
    writers.write_json_lines(totals, path, single_file=True)
    found = readers.read_json_lines(spark, path)
    figures = F.count("*").alias("months"), F.sum("total").alias("flights"), F.max("total").alias("most")
    return found.groupBy(F.col("_metadata.file_name").alias("file")).agg(*figures).drop("file")


# ---- tables


@query(f"WITH {FLIGHTS} SELECT {', '.join(_ROW)} FROM flights")
def table_overwritten(spark, folder):
    """A table written twice holds the second writing alone."""
    path = workspace(spark, "table")
    rows = _flights(spark, folder)
    for some in (rows.where("DepDelay > 0"), rows):
        writers.write_table(some, path)
    return readers.read_table(spark, path)


@query(f"WITH {FLIGHTS} SELECT count(*) AS n, count(DISTINCT Carrier) AS carriers, max(FlightDate) AS last_day FROM flights")
def record_replaced(spark, folder):
    """A collection of one record, replaced."""
    path = workspace(spark, "record")
    rows = b.flights(spark, folder, "Carrier", "FlightDate")
    record = rows.agg(F.count("*").alias("n"), F.countDistinct("Carrier").alias("carriers"), F.max("FlightDate").alias("last_day"))
    for one in (record.withColumn("n", F.lit(0).cast("long")), record):
        writers.replace_record(one, path)
    return readers.read_table(spark, path)


@query(f"""WITH {FLIGHTS}, late AS (SELECT Origin, Dest, DepDelay FROM flights WHERE DepDelay > 15)
    SELECT Origin, count(*) AS n, max(DepDelay) AS most FROM late GROUP BY Origin""")
def stored_intermediate(spark, folder):
    """A join stored once, and a summary that goes on from the stored rows."""
    late = b.flights(spark, folder, "Origin", "Dest", "DepDelay").where("DepDelay > 15")
    stored = writers.materialize(late, workspace(spark, "late"))
    return stored.groupBy("Origin").agg(F.count("*").alias("n"), F.max("DepDelay").alias("most"))


@query("""WITH runs AS (SELECT event_type AS metric, CAST(day(ts) // 7 AS BIGINT) AS run,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS score FROM events GROUP BY ALL)
    SELECT metric, run, round(score, 4) AS score,
    round(score - coalesce(lag(score) OVER (PARTITION BY metric ORDER BY run), score), 4) AS delta FROM runs""")
def experiment_log(spark, folder):
    """Mean values kept week by week as runs, the first run twice; changes come from the log."""
    path = workspace(spark, "log")
    cents = F.sum(F.round(F.col("value") * 100).cast("long")).cast("double")
    events = b.table(spark, folder, "events").withColumns({"run": F.expr("CAST(day(ts) div 7 AS BIGINT)"), "metric": F.col("event_type")})
    runs = events.groupBy("metric", "run").agg((cents / F.count("*") / 100).alias("score"))
    numbers = [r.run for r in runs.select("run").distinct().orderBy("run").collect()]
    for i, number in enumerate([*numbers[:1], *numbers]):
        scores = runs.where(F.col("run") == number).drop("run")
        experiments.append_run(scores if i else scores.withColumn("score", F.lit(0.0)), path, number)
    found = experiments.run_deltas(experiments.read_log(spark, path))
    return found.select("metric", "run", F.round("score", 4).alias("score"), F.round("delta", 4).alias("delta"))


@query("SELECT count(*) AS n, count(*) AS ids, true AS whole_ids, true AS one_time FROM events")
def stamped_requests(spark, folder):
    """Requests with a new id each and the time of their arrival, stored."""
    path = workspace(spark, "stamped")
    writers.write_table(features.stamped(b.requests(spark, folder)), path)
    found = readers.read_table(spark, path)
    return found.agg(
        F.count("*").alias("n"), F.countDistinct("UUID").alias("ids"),
        F.bool_and(F.col("UUID").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("whole_ids"),
        (F.countDistinct("Timestamp") == 1).alias("one_time"),
    )
