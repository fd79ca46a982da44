"""Prediction requests as a stream of JSON messages."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from delaylens.operators.models import predict
from delaylens.session import checkpointed
from delaylens.sources.readers import CORRUPT, STREAM_REQUESTS


def topic(spark: SparkSession, servers: str, name: str, **options) -> DataFrame:
    """Messages of a Kafka topic as a text column ``value``; needs the Kafka connector jar."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    raw = reader.option("subscribe", name).options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def message_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Messages from text files arriving in a folder, one per line."""
    return spark.readStream.options(**options).text(path)


def parse(messages: DataFrame, schema: T.StructType = STREAM_REQUESTS, value: str = "value") -> DataFrame:
    """Messages as typed rows; an unreadable one keeps its text in ``_corrupt_record``."""
    kept = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return messages.select(F.from_json(value, kept, options).alias("m")).select("m.*")


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def deduplicated(stream: DataFrame, key: str = "UUID", at: str = "Timestamp", delay: str = "10 minutes") -> DataFrame:
    """Each key once within the delay. Rows later than the delay are lost; ``write_answers`` keeps
    them and still stores each key once."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def write_batches(stream: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds") -> DataStreamWriter:
    """Write every micro-batch as its own partition.

    A batch that is run again after a failure replaces its partition, so the result holds each
    row once. ``interval=None`` processes what is there and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").parquet(path)
        )

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def write_split(stream: DataFrame, good: str, bad: str, checkpoint: str, interval: str | None = "10 seconds") -> DataStreamWriter:
    """Write parsed messages to two tables: typed rows to ``good``, texts that failed to ``bad``.

    Both are written by micro-batch under the same ``batch_id``, from one stored copy of the batch.
    A batch that is run again, also after a failure between the two tables, replaces what it wrote
    in each, so every message is in exactly one of them, once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = checkpointed(batch.withColumn("batch_id", F.lit(batch_id)))
        for rows, path in ((readable(kept), good), (kept.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "batch_id"), bad)):
            _replace(rows, path, "batch_id")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def _replace(rows: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions ``by`` that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


#: Micro-batches whose answers lie in one folder of a day, until their keys are gathered.
SPAN = 64


def write_answers(
    stream: DataFrame, path: str, checkpoint: str, key: str = "UUID", at: str = "Timestamp",
    interval: str | None = "10 seconds", span: int = SPAN,
) -> DataStreamWriter:
    """Store one answer per key by day (``ds``), however late or often its request comes.

    A batch is stored once, reduced to one row per key, and leaves out keys that an earlier batch
    answered on the same days. A batch that is run again replaces what it wrote. No state is kept,
    so nothing is too late.

    Answers lie in ``ds`` / ``span`` / ``batch_id``, where a span is ``span`` batches. When a span is
    over, the keys of a day that it answered join those of the spans before in one table of keys
    beside ``path``, with Bloom filters, replaced by the batch that notices. So a batch reads, of its
    own days only, one table of keys and at most ``span`` earlier batches, however many came before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        row = F.struct(*[F.col(c) for c in batch.columns])
        once = batch.groupBy(F.col(key).alias("_key")).agg(F.min(row).alias("r")).select("r.*")
        once = once.withColumns({"ds": F.to_date(at), "span": F.lit(batch_id // span), "batch_id": F.lit(batch_id)})
        stored = checkpointed(once)
        days = [r.ds for r in stored.select("ds").distinct().collect()]
        if not days:
            return
        now, fresh = batch_id // span, stored
        answered = [k for k in (_answered(spark, path, key, stored, day, now, batch_id) for day in days) if k is not None]
        if answered:
            known = reduce(lambda a, b: a.unionByName(b), answered)
            same = stored[key].eqNullSafe(known["_key"]) & stored["ds"].eqNullSafe(known["_ds"])
            fresh = checkpointed(stored.join(known, same, "left_anti"))
        _replace(fresh, path, "ds", "span", "batch_id")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def _answered(spark: SparkSession, path: str, key: str, like: DataFrame, day, now: int, batch_id: int) -> DataFrame | None:
    """(_key, _ds): keys that batches before ``batch_id`` answered on ``day``."""
    name = f"ds={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"
    kind = T.StructType([T.StructField(key, like.schema[key].dataType)])
    files, root = _files(spark, path)
    child = lambda *names: spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(names))
    day_path = child(name)
    if not files.exists(day_path):
        return None
    spans = sorted(int(f.getPath().getName().split("=")[1]) for f in files.listStatus(day_path) if "span=" in f.getPath().getName())
    # Keys are gathered up to a span; the version before the last one stays for batches run again.
    gathered = f"{path}_keys/{name}"
    keys_files, keys_root = _files(spark, gathered)
    versions = [int(f.getPath().getName().split("=")[1]) for f in (keys_files.listStatus(keys_root) if keys_files.exists(keys_root) else [])]
    upto = max((v for v in versions if keys_files.exists(spark._jvm.org.apache.hadoop.fs.Path(keys_root, f"upto={v}/_SUCCESS"))), default=-1)
    read = lambda folder: spark.read.schema(kind).parquet(folder).select(key)
    parts = [read(f"{gathered}/upto={upto}")] if upto >= 0 else []
    over = [s for s in spans if upto < s < now]
    parts += [read(f"{path}/{name}/span={s}") for s in over]
    if over:
        last = over[-1]
        keys = reduce(lambda a, b: a.unionByName(b), parts).distinct()
        bloom = {"parquet.bloom.filter.enabled#" + key: "true"}
        keys.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").options(**bloom).parquet(f"{gathered}/upto={last}")
        for old in versions:
            if old < upto:
                keys_files.delete(spark._jvm.org.apache.hadoop.fs.Path(keys_root, f"upto={old}"), True)
        parts = [read(f"{gathered}/upto={last}")]
    if now in spans:
        own = spark.read.schema(T.StructType([*kind.fields, T.StructField("batch_id", T.IntegerType())])).parquet(f"{path}/{name}/span={now}")
        parts.append(own.where(F.col("batch_id") < batch_id).select(key))
    if not parts:
        return None
    keys = reduce(lambda a, b: a.unionByName(b), parts)
    return keys.select(F.col(key).alias("_key"), F.lit(day).cast("date").alias("_ds"))


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and its name there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def write_console(stream: DataFrame, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.format("console").option("checkpointLocation", checkpoint)


def score(model: PipelineModel, messages: DataFrame, schema: T.StructType = STREAM_REQUESTS) -> DataFrame:
    """Parsed and scored requests; the model is the one used for daily batches.

    Without state: repeated requests are answered alike, and ``write_answers`` stores one answer.
    """
    return predict(model, readable(parse(messages, schema)))
