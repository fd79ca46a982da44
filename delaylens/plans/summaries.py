"""Summaries of flights: counts, punctuality, causes, histograms, shares."""

from delaylens.functions.buckets import DELAY_EDGES, bucket_label, delay_bucket, delay_bucket_right_closed
from delaylens.operators import experiments, histogram, summary
from delaylens.operators.models import bucketed
from delaylens.operators.ranking import index_by_frequency
from delaylens.plans import bindings as b
from delaylens.plans.registry import query
from pyspark.sql import functions as F

FLIGHTS = b.flights_sql()
# Edges of the delay histogram, in minutes.
DELAY_HISTOGRAM = (-60, -30, -15, -10, -5, 0, 5, 10, 15, 30, 60, 90, 120, 180)


@query(f"WITH {FLIGHTS} SELECT count(*) AS n FROM flights")
def row_counts(spark, folder):
    return summary.count_rows(b.flights(spark, folder, "FlightNum"))


@query(f"WITH {FLIGHTS} SELECT Carrier, count(*) AS n FROM flights GROUP BY Carrier")
def count_by_key(spark, folder):
    return summary.count_by(b.flights(spark, folder, "Carrier"), ["Carrier"])


@query(f"""WITH {FLIGHTS} SELECT Origin, Dest, count(*) AS total FROM flights
    GROUP BY Origin, Dest ORDER BY total DESC, Origin, Dest LIMIT 10""")
def top_routes(spark, folder):
    return summary.top_by_count(b.flights(spark, folder, "Origin", "Dest"), ["Origin", "Dest"], 10, "total")


@query(f"WITH {FLIGHTS} SELECT Year, Month, count(*) AS total FROM flights GROUP BY Year, Month ORDER BY 1, 2")
def totals_by_month(spark, folder):
    return summary.totals_in_order(b.flights(spark, folder, "Year", "Month"), ["Year", "Month"])


@query(f"""WITH {FLIGHTS} SELECT count(*) AS total_flights,
    count(*) FILTER (DepDelayMinutes > 0) AS late_departures,
    count(*) FILTER (ArrDelayMinutes > 0) AS late_arrivals,
    count(*) FILTER (DepDelay > 0 AND ArrDelay <= 0) AS recoveries,
    round(count(*) FILTER (ArrDelayMinutes > 0) / count(*) * 100, 1) AS pct_late FROM flights""")
def punctuality_kpis(spark, folder):
    columns = ("DepDelay", "ArrDelay", "DepDelayMinutes", "ArrDelayMinutes")
    return summary.punctuality(b.flights(spark, folder, *columns))


@query(f"""WITH {FLIGHTS} SELECT round(avg(DepDelay), 1) AS avg_dep_delay,
    round(avg(ArrDelay), 1) AS avg_arr_delay FROM flights""")
def avg_delays(spark, folder):
    flights = b.flights(spark, folder, "DepDelay", "ArrDelay")
    return summary.averages(flights, {"DepDelay": "avg_dep_delay", "ArrDelay": "avg_arr_delay"})


@query(f"WITH {FLIGHTS} SELECT " + ", ".join(f"sum({c}) AS sum_{c}" for c in b.CAUSES) + " FROM flights")
def sum_causes(spark, folder):
    return summary.sums(b.flights(spark, folder, *b.CAUSES), b.CAUSES)


@query(f"WITH {FLIGHTS} SELECT " + ", ".join(
    f"round(sum({c}) / sum(ArrDelayMinutes) * 100, 1) AS pct_{c}" for c in b.CAUSES) + " FROM flights")
def cause_shares(spark, folder):
    flights = b.flights(spark, folder, "ArrDelayMinutes", *b.CAUSES)
    return summary.shares_of_sum(flights, {c: f"pct_{c}" for c in b.CAUSES}, "ArrDelayMinutes")


@query(f"""WITH {FLIGHTS} SELECT Origin, Dest, avg(Distance) AS Distance FROM flights
    GROUP BY Origin, Dest ORDER BY Origin, Dest""")
def route_distances(spark, folder):
    flights = b.flights(spark, folder, "Origin", "Dest", "Distance")
    return summary.mean_by(flights, ["Origin", "Dest"], "Distance", "Distance")


@query(f"WITH {FLIGHTS} SELECT count(DISTINCT TailNum) AS airplanes FROM flights WHERE TailNum <> ''")
def fleet_size(spark, folder):
    return summary.distinct_count(b.flights(spark, folder, "TailNum"), "TailNum", "airplanes")


@query(f"WITH {FLIGHTS} SELECT DISTINCT Carrier, TailNum FROM flights ORDER BY 1, 2")
def distinct_pairs(spark, folder):
    return summary.distinct_rows(b.flights(spark, folder, "Carrier", "TailNum"), ["Carrier", "TailNum"])


@query(f"WITH {FLIGHTS} SELECT DISTINCT TailNum FROM flights WHERE TailNum <> '' ORDER BY 1")
def tail_numbers(spark, folder):
    flights = b.flights(spark, folder, "TailNum").where("TailNum <> ''")
    return summary.distinct_rows(flights, ["TailNum"])


@query(f"WITH {FLIGHTS} SELECT Origin AS Airport FROM flights UNION SELECT Dest FROM flights")
def distinct_endpoints(spark, folder):
    return summary.distinct_ends(b.flights(spark, folder, "Origin", "Dest"), "Origin", "Dest", "Airport")


_SHARES = f"""WITH {b.AIRPLANES_SQL} SELECT Manufacturer, count(*) AS total,
    (SELECT count(*) FROM airplanes) AS overall_total,
    round(count(*) * 100.0 / (SELECT count(*) FROM airplanes), 2) AS percentage
    FROM airplanes GROUP BY Manufacturer ORDER BY total DESC, Manufacturer"""


@query(_SHARES)
def share_by_cross_total(spark, folder):
    return summary.share_of_total(b.airplanes(spark, folder), ["Manufacturer"])


@query(_SHARES + " LIMIT 10")
def share_of_total(spark, folder):
    return summary.share_of_total(b.airplanes(spark, folder), ["Manufacturer"], k=10)


@query(f"""WITH {b.AIRPLANES_SQL}, shares AS (SELECT Manufacturer, count(*) AS total FROM airplanes
    GROUP BY Manufacturer ORDER BY total DESC, Manufacturer LIMIT 10)
    SELECT 'manufacturers' AS key, row_number() OVER (ORDER BY total DESC, Manufacturer) - 1 AS position,
    Manufacturer AS label, total AS value FROM shares""")
def chart_document(spark, folder):
    shares = summary.count_by(b.airplanes(spark, folder), ["Manufacturer"], "total")
    chart = summary.chart_document(shares, "manufacturers", "Manufacturer", "total", 10)
    return chart.select("key", F.posexplode("data").alias("position", "item")).select(
        "key", F.col("position").cast("bigint").alias("position"), "item.*"
    )


_CLOCK = """CASE WHEN substr({c}, 1, 2) = '24' THEN TIME '23:59:00'
    ELSE CAST(substr({c}, 1, 2) || ':' || substr({c}, 3, 2) || ':00' AS TIME) END"""
SCHEDULED_SQL = f"""scheduled AS (SELECT *, FlightDate + {_CLOCK.format(c='CRSDepTime')} AS dep,
    FlightDate + {_CLOCK.format(c='CRSArrTime')} AS arr FROM flights)"""


@query(f"""WITH {FLIGHTS}, {SCHEDULED_SQL} SELECT CAST(hour(dep) + 1 AS INT) AS hour,
    round(avg(ArrDelay), 4) AS avg_value, round(stddev_samp(ArrDelay), 4) AS std_value
    FROM scheduled GROUP BY hour(dep)""")
def delay_by_hour(spark, folder):
    from delaylens.functions.clock import scheduled_at

    flights = b.flights(spark, folder, "FlightDate", "CRSDepTime", "ArrDelay")
    at = flights.withColumn("dep", scheduled_at(F.col("FlightDate"), F.col("CRSDepTime")))
    return summary.spread_by_hour(at, "dep", "ArrDelay")


_BUCKET = "CASE WHEN {d} < -15 THEN 0.0 WHEN {d} < 0 THEN 1.0 WHEN {d} < 30 THEN 2.0 WHEN {d} >= 30 THEN 3.0 END"
BUCKET_SQL = "CAST(" + _BUCKET + " AS DOUBLE)"
LABELLED_SQL = f"labelled AS (SELECT *, {BUCKET_SQL.format(d='ArrDelay')} AS ArrDelayBucket FROM flights)"


@query(f"""WITH {FLIGHTS}, {LABELLED_SQL} SELECT ArrDelayBucket, min(ArrDelay) AS min_value,
    max(ArrDelay) AS max_value FROM labelled GROUP BY ArrDelayBucket""")
def min_max(spark, folder):
    return summary.extremes(bucketed(b.flights(spark, folder, "ArrDelay")), "ArrDelay", ["ArrDelayBucket"])


@query(f"WITH {FLIGHTS}, {LABELLED_SQL} SELECT ArrDelayBucket, count(*) AS n FROM labelled GROUP BY ArrDelayBucket")
def bucket_distribution(spark, folder):
    return summary.count_by(bucketed(b.flights(spark, folder, "ArrDelay")), ["ArrDelayBucket"])


@query(f"WITH {FLIGHTS}, {LABELLED_SQL} SELECT FlightNum, ArrDelay, ArrDelayBucket FROM labelled",
       name="delay_bucket")
def delay_bucket_query(spark, folder):
    return bucketed(b.flights(spark, folder, "FlightNum", "ArrDelay"))


@query(f"""WITH {FLIGHTS} SELECT FlightNum, ArrDelay, CAST(CASE WHEN ArrDelay <= -15 THEN 0.0
    WHEN ArrDelay <= 0 THEN 1.0 WHEN ArrDelay <= 30 THEN 2.0 WHEN ArrDelay > 30 THEN 3.0 END AS DOUBLE)
    AS bucket FROM flights""")
def delay_bucket_manual(spark, folder):
    flights = b.flights(spark, folder, "FlightNum", "ArrDelay")
    return flights.withColumn("bucket", delay_bucket_right_closed(F.col("ArrDelay"), DELAY_EDGES))


@query(f"""WITH {FLIGHTS}, {LABELLED_SQL} SELECT CASE ArrDelayBucket
    WHEN 0 THEN 'Early (15+ Minutes Early)' WHEN 1 THEN 'Slightly Early (0-15 Minute Early)'
    WHEN 2 THEN 'Slightly Late (0-30 Minute Delay)' WHEN 3 THEN 'Very Late (30+ Minutes Late)' END
    AS label, count(*) AS n FROM labelled GROUP BY 1""")
def bucket_labels(spark, folder):
    flights = b.flights(spark, folder, "ArrDelay")
    return summary.count_by(flights.select(bucket_label(delay_bucket(F.col("ArrDelay"))).alias("label")), ["label"])


_NULLABLE = ("FlightNum", "TailNum", "DepDelay", "ArrDelay", "WeatherDelay", "Origin")


@query(f"WITH {FLIGHTS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM flights" for c in _NULLABLE))
def null_counts(spark, folder):
    return summary.null_counts(b.flights(spark, folder, *_NULLABLE))


@query(f"""WITH {FLIGHTS}, r AS (SELECT min(DepDelay) AS lo, max(DepDelay) AS hi FROM flights),
    bins AS (SELECT CAST(range AS INT) AS bin FROM range(10)),
    c AS (SELECT CAST(least(floor((DepDelay - lo) / ((hi - lo) / 10)), 9) AS INT) AS bin, count(*) AS n
          FROM flights, r WHERE DepDelay IS NOT NULL GROUP BY 1)
    SELECT bin, lo + bin * ((hi - lo) / 10) AS lo,
           CASE WHEN bin = 9 THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 10) END AS hi,
           coalesce(n, 0) AS n FROM bins LEFT JOIN c USING (bin), r""")
def histogram_even(spark, folder):
    return histogram.even(b.flights(spark, folder, "DepDelay"), "DepDelay", 10)


def _edges_sql() -> str:
    pairs = list(zip(DELAY_HISTOGRAM, DELAY_HISTOGRAM[1:]))
    last = len(pairs) - 1
    bins = ", ".join(f"({i}, {lo}, {hi})" for i, (lo, hi) in enumerate(pairs))
    return f"""bins AS (SELECT CAST(a AS INT) AS bin, CAST(b AS DOUBLE) AS lo, CAST(c AS DOUBLE) AS hi
        FROM (VALUES {bins}) t(a, b, c)),
        hist AS (SELECT bin, lo, hi, count(DepDelay) AS n FROM bins LEFT JOIN flights
        ON DepDelay >= lo AND (DepDelay < hi OR (bin = {last} AND DepDelay = hi)) GROUP BY bin, lo, hi)"""


@query(f"WITH {FLIGHTS}, {_edges_sql()} SELECT bin, lo, hi, n FROM hist")
def histogram_edges(spark, folder):
    return histogram.by_edges(b.flights(spark, folder, "DepDelay"), "DepDelay", DELAY_HISTOGRAM)


@query(f"WITH {FLIGHTS}, {_edges_sql()} SELECT 'dep_delay' AS key, CAST(bin AS BIGINT) AS position, lo AS label, n AS value FROM hist")
def histogram_document(spark, folder):
    bins = histogram.by_edges(b.flights(spark, folder, "DepDelay"), "DepDelay", DELAY_HISTOGRAM)
    chart = histogram.document(bins, "dep_delay")
    return chart.select("key", F.posexplode("data").alias("position", "item")).select(
        "key", F.col("position").cast("bigint").alias("position"), "item.*"
    )


@query(f"""WITH {FLIGHTS} SELECT FlightNum, FlightDate, DepDelay, ArrDelay FROM flights
    WHERE DepDelay > 0 AND ArrDelay <= 0""")
def recovered_flights(spark, folder):
    return summary.recovered(b.flights(spark, folder, "FlightNum", "FlightDate", "DepDelay", "ArrDelay"))


@query(f"WITH {FLIGHTS} SELECT ArrDelayMinutes, {', '.join(b.CAUSES)} FROM flights WHERE "
       + " OR ".join(f"{c} IS NOT NULL" for c in b.CAUSES))
def delayed_with_cause(spark, folder):
    return summary.with_any(b.flights(spark, folder, "ArrDelayMinutes", *b.CAUSES), b.CAUSES)


@query(f"""WITH {FLIGHTS}, c AS (SELECT Origin || '-' || Dest AS Route, count(*) AS n FROM flights GROUP BY 1)
    SELECT Route, CAST(row_number() OVER (ORDER BY n DESC, Route) - 1 AS DOUBLE) AS index, n FROM c""")
def string_index(spark, folder):
    from delaylens.operators.features import route

    return index_by_frequency(route(b.flights(spark, folder, "Origin", "Dest")), "Route")


# Scores are means of whole cents, so both engines compute the same numbers to the last bit.
_RUNS = """WITH runs AS (SELECT event_type AS metric, CAST(ts AS DATE) AS run,
    avg(CAST(round(value * 100) AS BIGINT)) / 100 AS score FROM events GROUP BY 1, 2)"""


def _runs(spark, folder):
    events = b.table(spark, folder, "events").selectExpr(
        "event_type AS metric", "to_date(ts) AS run", "CAST(round(value * 100) AS BIGINT) AS cents"
    )
    means = summary.mean_by(events, ["metric", "run"], "cents", "score", ordered=False)
    return means.withColumn("score", F.col("score") / 100)


@query(f"""{_RUNS} SELECT metric, run, score,
    score - coalesce(lag(score) OVER (PARTITION BY metric ORDER BY run), score) AS delta FROM runs""")
def run_deltas(spark, folder):
    return experiments.run_deltas(_runs(spark, folder))


@query(f"""{_RUNS} SELECT metric, round(avg(score), 4) AS average, round(stddev_pop(score), 4) AS std
    FROM runs GROUP BY metric""")
def metric_summary(spark, folder):
    scores = experiments.summarize(_runs(spark, folder))
    return scores.select("metric", F.round("average", 4).alias("average"), F.round("std", 4).alias("std"))
