"""Figures of events kept per day: replaced days, distinct users and medians of a period."""

from pyspark.sql import functions as F

from delaylens.operators import daily
from delaylens.operators.daily import Figures
from delaylens.plans import bindings as b
from delaylens.plans.registry import query
from delaylens.session import workspace

FIGURES = Figures(keys=("event_type",), sums=("amount",), distinct=("user_id",), spread=("value",))
FIRST, LAST, AGAIN = "2024-01-05", "2024-01-18", "2024-01-09"
#: Bounds that the estimates keep: five standard deviations of a count, four times the stated rank error.
COUNT_ERROR, RANK_ERROR = 0.08, 0.04


def _events(spark, folder):
    amount = F.col("value").cast("decimal(18,4)").alias("amount")
    return b.table(spark, folder, "events").select("ts", "event_type", "user_id", "value", amount)


def _stored(spark, folder):
    """Parts of all days, one of them run twice more, once with half of its rows."""
    root, rows = workspace(spark, "daily"), _events(spark, folder)
    schema = daily.replace_parts(daily.day_parts(rows, "ts", FIGURES), root)
    again = rows.where(F.col("ts").cast("date") == F.lit(AGAIN).cast("date"))
    for some in (again.where("value > 50"), again):
        daily.replace_parts(daily.day_parts(some, "ts", FIGURES), root, [AGAIN])
    return root, schema


def _period(spark, folder):
    day = F.col("ts").cast("date")
    return _events(spark, folder).where((day >= F.lit(FIRST).cast("date")) & (day <= F.lit(LAST).cast("date")))


_PERIOD_SQL = f"CAST(ts AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"


@query("""SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total,
    count(*) - count(value) AS nulls, round(CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(value), 4) AS mean
    FROM events GROUP BY event_type""")
def daily_totals(spark, folder):
    """Totals from the days' parts, after one day was replaced twice."""
    root, schema = _stored(spark, folder)
    found = daily.merged(daily.read_parts(spark, root, schema), FIGURES)
    total = F.col("sum_amount").cast("double")
    return found.select(
        "event_type", "n", total.alias("total"), F.col("nulls_amount").alias("nulls"),
        F.round(F.try_divide(total, F.col("n") - F.col("nulls_amount")), 4).alias("mean"),
    )


@query(f"""SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS close
    FROM events WHERE {_PERIOD_SQL} GROUP BY event_type""")
def period_users(spark, folder):
    """Rows of a period by its parts, and whether the estimate of distinct users meets the exact count."""
    root, schema = _stored(spark, folder)
    found = daily.merged(daily.read_parts(spark, root, schema, FIRST, LAST), FIGURES)
    exact = _period(spark, folder).groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    off = F.abs(F.col("distinct_user_id") - F.col("users"))
    return found.join(exact, found.event_type.eqNullSafe(exact.event_type)).select(
        found.event_type, "n", "users", (off <= COUNT_ERROR * F.col("users")).alias("close")
    )


@query(f"""SELECT event_type, count(*) AS n, true AS low_close, true AS median_close, true AS high_close
    FROM events WHERE {_PERIOD_SQL} GROUP BY event_type""")
def period_quantiles(spark, folder):
    """Whether the estimated quartiles of a period have the ranks asked for among its values."""
    asked = {"low": 0.25, "median": 0.5, "high": 0.75}
    root, schema = _stored(spark, folder)
    found = daily.merged(daily.read_parts(spark, root, schema, FIRST, LAST), FIGURES, quantiles=tuple(asked.values()))
    found = found.select("event_type", "n", "quantiles_value")
    rows = _period(spark, folder).alias("r")
    pairs = rows.join(found.alias("f"), F.expr("r.event_type <=> f.event_type")).select("f.*", "r.value")
    close = []
    for i, (name, rank) in enumerate(asked.items()):
        at = F.col("quantiles_value")[i]
        share = lambda test: F.avg(test.cast("double"))
        fits = (share(F.col("value") <= at) >= rank - RANK_ERROR) & (share(F.col("value") < at) <= rank + RANK_ERROR)
        close.append(fits.alias(f"{name}_close"))
    return pairs.groupBy("event_type", "n").agg(*close)
