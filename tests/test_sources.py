import bz2
import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from delaylens.operators.lookup import search_words
from delaylens.sources import readers, writers


def write(path, text, opener=open):
    with opener(path, "wt") as f:
        f.write(text)
    return str(path)


def test_csv_with_inferred_types(spark, tmp_path):
    df = readers.read_delimited(spark, write(tmp_path / "a.csv", "n,x\nAA,1\nBB,2\n"), infer=True)
    assert dict(df.dtypes) == {"n": "string", "x": "int"}


def test_csv_as_text_with_empty_as_null(spark, tmp_path):
    df = readers.read_delimited(spark, write(tmp_path / "a.csv", "n,x\nAA,1\n,2\n"))
    assert dict(df.dtypes) == {"n": "string", "x": "string"}
    assert [tuple(r) for r in df.collect()] == [("AA", "1"), (None, "2")]


def test_headerless_csv_with_null_token(spark, tmp_path):
    path = write(tmp_path / "airlines.csv", '1,"Delta",\\N,DL,DAL,DELTA,"United States",Y\n')
    row = readers.read_delimited(spark, path, schema=readers.AIRLINES, header=False, null_token="\\N").first()
    assert (row.ID, row.Name, row.Alias, row.IATA) == (1, "Delta", None, "DL")


def test_pipe_separated_stations(spark, tmp_path):
    names = readers.STATIONS.names
    values = [f"v{i}" for i in range(len(names))]
    path = write(tmp_path / "s.psv", "|".join(names) + "\n" + "|".join(values) + "\n")
    row = readers.read_delimited(spark, path, schema=readers.STATIONS, sep="|").first()
    assert row.WBAN_ID == "v1" and row.ELEV_UPPER_AIR == "v18"
    assert len(readers.HOURLY_OBSERVATIONS) == 44


@pytest.mark.parametrize("opener, ending", [(gzip.open, "gz"), (bz2.open, "bz2")])
def test_compressed_files_by_pattern(spark, tmp_path, opener, ending):
    for month in (1, 2):
        write(tmp_path / f"2015{month}hourly.txt.{ending}", f"WBAN,v\nA,{month}\n", opener)
    df = readers.read_delimited(spark, str(tmp_path / f"2015*hourly.txt.{ending}"), partitions=3)
    assert sorted(r.v for r in df.collect()) == ["1", "2"]
    assert df.rdd.getNumPartitions() == 3


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"Carrier":"AA","DepDelay":5.0,"_id":{"$oid":"x"}}\nnot json\n')
    assert "_id" in readers.read_json_lines(spark, path).columns
    rows = readers.read_json_lines(spark, path, readers.FEATURES).collect()
    good = [r for r in rows if r[readers.CORRUPT] is None]
    bad = [r for r in rows if r[readers.CORRUPT] is not None]
    assert good[0].Carrier == "AA" and good[0].DepDelay == 5.0
    assert bad[0][readers.CORRUPT] == "not json"


def test_extended_json_is_read_as_nested_fields(spark):
    df = spark.createDataFrame([('{"_id":{"$oid":"x"},"t":{"$date":5}}',)], "value string")
    row = readers.parse_json(df, "value", "_id STRUCT<`$oid`: STRING>, t STRUCT<`$date`: BIGINT>").first()
    assert (row._id["$oid"], row.t["$date"]) == ("x", 5)


def test_split_and_flatten_take_the_separator_literally(spark, tmp_path):
    lines = readers.read_lines(spark, write(tmp_path / "a.txt", "a|b||\nc\n"))
    assert [r.fields for r in readers.split_fields(lines, "value", "|").collect()] == [["a", "b", "", ""], ["c"]]
    assert [r.field for r in readers.flatten_fields(lines, "value", "|").collect()] == ["a", "b", "", "", "c"]


def test_iso_slice_includes_the_bare_next_day_only(spark):
    texts = ["2015-01-01", "2015-01-01T23:59:59", "2015-01-02", "2015-01-02T00:00:00", "2014-12-31"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.t for r in readers.iso_day_slice(df, "t", "2015-01-01").collect()] == texts[:3]


def test_rerun_of_a_day_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "days")
    rows = [("2015-01-01", 1), ("2015-01-02", 2), ("2015-01-02", 3)]
    writers.write_days(spark.createDataFrame(rows, "day string, v int"), root, "day")
    before = sorted(os.listdir(f"{root}/ds=2015-01-01"))
    for _ in range(2):
        writers.write_days(spark.createDataFrame([("2015-01-02", 9)], "day string, v int"), root, "day")
    assert sorted(os.listdir(f"{root}/ds=2015-01-01")) == before
    assert [r.v for r in readers.read_day(spark, root, "2015-01-02").collect()] == [9]
    day = readers.read_day(spark, root, "2015-01-01")
    assert [r.v for r in day.collect()] == [1]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_overwrite_ignores_the_partition_setting(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        writers.write_table(spark.range(n), path)
    assert spark.read.parquet(path).count() == 2
    writers.write_table(spark.range(1), path, mode="append")
    assert spark.read.parquet(path).count() == 3


def test_json_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, t string")
    one, packed, rows = (str(tmp_path / n) for n in ("one", "packed", "rows"))
    writers.write_json_lines(df, one, single_file=True)
    writers.write_json_lines(df, packed, compression="gzip")
    writers.write_text(writers.to_json_rows(df), rows)
    assert len([f for f in os.listdir(one) if f.endswith(".json")]) == 1
    assert all(f.endswith(".json.gz") for f in os.listdir(packed) if f.startswith("part"))
    for path in (one, packed, rows):
        assert sorted(r.i for r in spark.read.json(path).collect()) == [1, 2]
    assert json.loads(spark.read.text(rows).orderBy("value").first().value) == {"i": 1, "t": "a"}


def test_published_table_is_clustered_and_searchable(spark, tmp_path):
    path = str(tmp_path / "planes")
    df = spark.createDataFrame([("N2", "Delta Air Lines"), ("N1", "UNITED")], "TailNum string, Owner string")
    writers.publish(df, path, ["TailNum"], mode="overwrite", search=["Owner"])
    writers.publish(df.limit(0), path, ["TailNum"], search=["Owner"])
    stored = spark.read.parquet(path)
    found = search_words(stored, {"Owner": "delta united"}, ["Owner", "TailNum"], prepared=True).collect()
    assert [r.TailNum for r in found] == ["N2", "N1"] and found[0].total == 2


def test_record_and_intermediate(spark, tmp_path):
    path = str(tmp_path / "r")
    writers.replace_record(spark.range(1), path)
    writers.replace_record(spark.range(1).withColumn("x", F.lit(1)), path)
    assert spark.read.parquet(path).columns == ["id", "x"]
    stored = writers.materialize(spark.range(4).where("id > 1"), str(tmp_path / "m"))
    assert stored.count() == 2 and "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_day_slice_reaches_the_scan(spark, folder):
    df = readers.day_slice(readers.read_table(spark, f"{folder}/events.parquet"), "ts", dt.date(2024, 1, 2))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in df._jdf.queryExecution().executedPlan().toString()


def test_on_time_casts(spark):
    row = {c: "x" for c in readers.ON_TIME_TEXTS} | {c: "-3.50" for c in readers.ON_TIME_FLOATS} | {c: "1.00" for c in readers.ON_TIME_WHOLE}
    row["TaxiIn"], row["Flights"], row["ArrDelay"] = "", "many", None
    table = spark.createDataFrame([tuple(row[c] for c in readers.ON_TIME.names)], readers.ON_TIME)
    found = readers.cast_on_time(table)
    kinds = dict(found.dtypes)
    assert len(kinds) == 38 and sorted(set(kinds.values())) == ["float", "int", "string"]
    assert sum(k != "string" for k in kinds.values()) == 17
    one = found.first()
    assert (one.DepDelay, one.Cancelled, one.TaxiIn, one.Flights, one.ArrDelay) == (-3.5, 1, None, None, None)


def test_daily_observations_read_as_declared(spark, tmp_path):
    names = readers.DAILY_OBSERVATIONS.names
    assert len(names) == 50
    (tmp_path / "d.txt").write_text(",".join(names) + "\n" + ",".join(f" {i}" for i in range(50)) + "\n")
    found = readers.read_delimited(spark, str(tmp_path / "d.txt"), schema=readers.DAILY_OBSERVATIONS).first()
    assert (found.WBAN.strip(), found.Max2DirFlag.strip()) == ("0", "49")


def test_a_hot_key_is_published_by_several_tasks(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.publish(df, str(tmp_path / "t"), ["k"], mode="overwrite")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(str(tmp_path / "t"))
    files = stored.where("k = 'hot'").selectExpr("_metadata.file_name AS f").groupBy("f").count()
    assert stored.count() == 20_000 and files.count() > 1


def test_published_columns_are_worked_out_once(spark, tmp_path):
    worked = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def named(i):
        worked.add(1)
        return f"n{i}"

    path, df = str(tmp_path / "p"), spark.range(3_000).withColumn("k", F.expr("concat('k', id % 7)"))
    writers.publish(df, path, ["key"], mode="overwrite", search=["name"], columns={"key": F.col("k"), "name": named("id")})
    stored = spark.read.parquet(path)
    assert stored.columns == ["key", "name", "name_tokens"] and worked.value == 3_000
    assert sorted((r.key, r.name) for r in stored.collect()) == sorted((f"k{i % 7}", f"n{i}") for i in range(3_000))
    files = stored.selectExpr("_metadata.file_name AS f", "key").groupBy("f").agg(F.min("key").alias("a"), F.max("key").alias("b"))
    bounds = sorted((r.a, r.b) for r in files.collect())
    assert all(x[1] <= y[0] for x, y in zip(bounds, bounds[1:]))


def test_sql_over_several_tables(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "i int, s string"), spark.createDataFrame([(1,)], "i int")
    found = readers.run_sql(spark, "SELECT s FROM a JOIN b USING (i)", a=a, b=b)
    assert [r.s for r in found.collect()] == ["x"]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("a_", "b_"))]
