import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylens.functions import buckets, casting, clock, geodesy, text
from delaylens.operators import features, histogram, metrics, summary
from delaylens.operators.models import bucketed


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_buckets_differ_on_their_edges_only(spark):
    df = spark.createDataFrame([(-16.0,), (-15.0,), (0.0,), (30.0,), (31.0,), (None,)], "ArrDelay double")
    closed_left = [0.0, 1.0, 2.0, 3.0, 3.0, None]
    assert column(df, buckets.delay_bucket(F.col("ArrDelay"))) == closed_left
    assert column(bucketed(df), "ArrDelayBucket") == closed_left
    assert column(df, buckets.delay_bucket_right_closed(F.col("ArrDelay"))) == [0.0, 0.0, 1.0, 2.0, 3.0, None]


def test_labels(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (None,)], "b double")
    assert column(df, buckets.bucket_label(F.col("b"))) == [
        "Early (15+ Minutes Early)", "Very Late (30+ Minutes Late)", None,
    ]


def test_histogram_edges_are_left_closed_and_the_last_closed(spark):
    df = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 9.0, 10.0, 20.0, 21.0, None)], "v double")
    found = {(r.lo, r.hi): r.n for r in histogram.by_edges(df, "v", [0, 10, 15, 20]).collect()}
    assert found == {(0.0, 10.0): 2, (10.0, 15.0): 1, (15.0, 20.0): 1}


def test_even_histogram_of_equal_values_has_one_bin(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert [(r.bin, r.n) for r in histogram.even(df, "v", 10).collect()] == [(0, 2)]


def test_histogram_document_is_ordered(spark):
    df = spark.createDataFrame([(1.0,), (12.0,), (13.0,)], "v double")
    doc = histogram.document(histogram.by_edges(df, "v", [0, 10, 20]), "k").first()
    assert [(d.label, d.value) for d in doc.data] == [(0.0, 1), (10.0, 2)]


@pytest.mark.parametrize("hhmm, expected", [("0005", "00:05:00"), ("2400", "23:59:00"), ("2359", "23:59:00")])
def test_clock_text(spark, hhmm, expected):
    df = spark.createDataFrame([(hhmm,)], "t string")
    assert column(df, clock.clock_text(F.col("t"))) == [expected]


def test_overnight_arrivals(spark):
    df = spark.createDataFrame(
        [("2015-01-01", "2359", "0010"), ("2015-01-01", "0800", "0800"), ("2015-12-31", "2200", "2400")],
        "d string, dep string, arr string",
    )
    dep, arr = (clock.scheduled_at(F.col("d"), F.col(c)) for c in ("dep", "arr"))
    expected = [dt.datetime(2015, 1, 2, 0, 10), dt.datetime(2015, 1, 1, 8), dt.datetime(2015, 12, 31, 23, 59)]
    assert column(df, clock.after_departure(dep, arr)) == expected
    assert column(df, clock.after_departure_clock(dep, arr)) == expected


def test_unreadable_clock_is_null(spark):
    df = spark.createDataFrame([("2015-01-01", "xx99")], "d string, t string")
    assert column(df, clock.scheduled_at(F.col("d"), F.col("t"))) == [None]


def test_weekday_numbering(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 1),)], "d date")
    assert features.calendar(df, "d").first().DayOfWeek == 4
    assert features.calendar(df, "d", monday=0).first().DayOfWeek == 3


def test_casts_turn_unreadable_text_into_null(spark):
    df = spark.createDataFrame([("1.5", "M"), ("M", "3")], "a string, b string")
    cast = casting.cast_columns(df, {"a": "float", "b": "int"})
    assert [tuple(r) for r in cast.collect()] == [(1.5, None), (None, 3)]
    assert dict(cast.dtypes) == {"a": "float", "b": "int"}


def test_lat_lon(spark):
    df = spark.createDataFrame([("1.5,-2",), ("UNKNOWN",), ("7",), (None,)], "t string")
    lat, lon = casting.lat_lon(F.col("t"))
    assert [tuple(r) for r in df.select(lat, lon).collect()] == [(1.5, -2.0), (None, None), (7.0, None), (None, None)]


def test_address_needs_its_required_parts(spark):
    df = spark.createDataFrame([("A", None, "S"), ("A", "C", None)], "n string, c string, s string")
    made = text.address((F.col("n"), False), (F.col("c"), True), (F.col("s"), False))
    assert column(df, made) == ["A, , S", None]


def test_registered_domain(spark):
    df = spark.createDataFrame([("http://www.a.co.uk/x",), ("https://b.a.com:80",), ("none",)], "u string")
    assert column(df, text.registered_domain(F.col("u"))) == ["a.co.uk", "a.com", None]


def test_published_geodesic_example(spark):
    # Flinders Peak to Buninyong: 54 972.271 m on GRS 80, which agrees with WGS 84 here.
    lat1, lon1 = -(37 + 57 / 60 + 3.72030 / 3600), 144 + 25 / 60 + 29.52440 / 3600
    lat2, lon2 = -(37 + 39 / 60 + 10.15610 / 3600), 143 + 55 / 60 + 35.38390 / 3600
    df = spark.createDataFrame(
        [(lat1, lon1, lat2, lon2), (0.0, 0.0, 0.5, 179.7), (1.0, 1.0, 1.0, 1.0), (None, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 90.0)],
        "a double, b double, c double, d double",
    )
    miles = column(df, geodesy.ellipsoid_miles("a", "b", "c", "d"))
    assert miles[0] * 1609.344 == pytest.approx(54972.271, abs=0.001)
    assert miles[1] is None and miles[2] == 0 and miles[3] is None
    assert miles[4] * 1609.344 == pytest.approx(6378137 * 3.141592653589793 / 2, abs=0.01)
    assert column(df, geodesy.rounded_miles("a", "b", "c", "d"))[:4] == [34, 24902, 0, 24902]


def test_one_pass_null_counts(spark):
    df = spark.createDataFrame([(None, 1), (None, None), (3, 2)], "a int, b int")
    assert {r.column_name: r.nulls for r in summary.null_counts(df).collect()} == {"a": 2, "b": 1}


def test_distinct_count_leaves_out_null_and_empty(spark):
    df = spark.createDataFrame([("N1",), ("",), (None,), ("N1",), ("N2",)], "t string")
    assert summary.distinct_count(df, "t", "n").first().n == 2
    assert summary.distinct_count(df, "t", "n", error=0.05).first().n == 2


def test_classification_metrics_agree_with_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    data = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (2.0, 2.0), (3.0, 0.0)]
    df = spark.createDataFrame(data, "label double, prediction double")
    found = {r.metric: r.score for r in metrics.classification(df, "label", "prediction").collect()}
    for name, value in found.items():
        assert value == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))


def test_shares_sum_to_a_hundred(spark):
    df = spark.createDataFrame([(c,) for c in "aabbbcdddd"], "k string")
    assert sum(r.percentage for r in summary.share_of_total(df, ["k"]).collect()) == pytest.approx(100)
