"""Pairing of two streams, dead letters, and answers whose cost doesn't grow with their history."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from delaylens.sources import readers
from delaylens.streaming import scoring
from delaylens.streaming.pairing import paired

START = datetime(2024, 1, 1, 12)


def at(minutes):
    return START + timedelta(minutes=minutes)


class Source:
    """A folder of JSON files, each of which is one micro-batch."""

    def __init__(self, path, schema):
        path.mkdir()
        self.path, self.schema, self.used = path, schema, 0

    def add(self, *rows):
        self.used += 1
        text = "\n".join(json.dumps(r, default=str) for r in rows)
        (self.path / f"{self.used:03}.json").write_text(text + "\n")

    def stream(self, spark):
        return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.path))


@pytest.fixture
def pairs(spark, tmp_path):
    requests = Source(tmp_path / "requests", "UUID string, asked timestamp, Origin string")
    responses = Source(tmp_path / "responses", "UUID string, answered timestamp, Prediction double, Origin string")

    def run():
        both = paired(requests.stream(spark), responses.stream(spark), "UUID", "asked", "answered", ["Prediction"])
        writer = scoring.write_batches(both, str(tmp_path / "out"), str(tmp_path / "state"), interval=None)
        writer.start().awaitTermination()
        found = spark.read.schema("UUID string, status string, Prediction double").parquet(str(tmp_path / "out")).collect()
        return sorted((r.UUID, r.status, r.Prediction) for r in found)

    ask = lambda key, minute: {"UUID": key, "asked": at(minute), "Origin": "A"}
    reply = lambda key, minute, p: {"UUID": key, "answered": at(minute), "Prediction": p, "Origin": "B"}
    return requests, responses, ask, reply, run


def test_pairs_with_late_repeated_and_missing_responses_across_restarts(pairs):
    requests, responses, ask, reply, run = pairs
    requests.add(ask("a", 0), ask("b", 0), ask("c", 1), ask("c", 1), ask(None, 1), ask("early", 3))
    responses.add(reply("a", 1, 1.0), reply("a", 1, 1.0), reply("early", 2, 9.0), reply(None, 1, 5.0))
    assert run() == [("a", "OK", 1.0)]  # nothing is final yet
    # The process stops here; the state goes on from the checkpoint.
    responses.add(reply("c", 5, 3.0), reply("b", 6, 2.0), reply("a", 2, 7.0))  # b answered after six minutes
    requests.add(ask("d", 9))
    assert run() == [("a", "OK", 1.0), ("c", "OK", 3.0)]
    # Both streams move on, so what was asked before can't be answered any more.
    requests.add(ask("z", 60))
    responses.add(reply("y", 60, 0.0))
    last = [("a", "OK", 1.0), ("b", "WAIT", None), ("c", "OK", 3.0), ("d", "WAIT", None), ("early", "WAIT", None)]
    assert run() == last
    responses.add(reply("d", 10, 4.0))  # later than the delay
    assert run() == last


def test_one_quiet_stream_keeps_requests_waiting(pairs):
    requests, responses, ask, reply, run = pairs
    requests.add(ask("a", 0))
    responses.add(reply("x", 0, 1.0))
    requests.add(ask("b", 90))
    assert run() == []
    responses.add(reply("a", 4, 2.0))
    assert run() == [("a", "OK", 2.0)]


def test_good_rows_and_dead_letters_replay_alike(spark, tmp_path, monkeypatch):
    good = lambda i: json.dumps({"UUID": f"u{i}", "Carrier": "AA", "Timestamp": "2024-01-01T00:00:00Z"})
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join([good(i), "{broken %d" % i, good(i + 10), "[1"]))
    paths = [str(tmp_path / x) for x in ("good", "bad", "state")]

    def run():
        messages = scoring.message_files(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)
        scoring.write_split(scoring.parse(messages), *paths, interval=None).start().awaitTermination()

    whole, calls = scoring._replace, []

    def failing(rows, path, *by):
        calls.append(path)
        if len(calls) == 4:  # the second batch has written its good rows only
            raise RuntimeError("lost")
        whole(rows, path, *by)

    monkeypatch.setattr(scoring, "_replace", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.read.parquet(paths[0]).count() == 4 and spark.read.parquet(paths[1]).count() == 2
    monkeypatch.setattr(scoring, "_replace", whole)
    run()
    run()  # nothing new
    kept, lost = spark.read.parquet(paths[0]), spark.read.parquet(paths[1])
    assert sorted(r.UUID for r in kept.collect()) == sorted(f"u{i}" for i in (0, 1, 2, 10, 11, 12))
    assert sorted(r[readers.CORRUPT] for r in lost.collect()) == sorted(["[1"] * 3 + [f"{{broken {i}" for i in range(3)])
    assert {r.batch_id for r in kept.select("batch_id").collect()} == {r.batch_id for r in lost.select("batch_id").collect()} == {0, 1, 2}


def test_answers_read_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    source = Source(tmp_path / "in", "UUID string, Timestamp timestamp, Prediction double")
    batches = 14
    for i in range(batches):
        # Each request comes again three batches and then ten batches later.
        source.add(*[{"UUID": f"u{k}", "Timestamp": at(0), "Prediction": 1.0} for k in (i, max(0, i - 3), max(0, i - 10))],
                   {"UUID": f"old{i % 2}", "Timestamp": at(-3000), "Prediction": 2.0})
    plain, read = scoring._answered, []

    def seen(*args):
        found = plain(*args)
        read.append(len({f.rsplit("/", 1)[0] for f in found.inputFiles()}) if found is not None else 0)
        return found

    monkeypatch.setattr(scoring, "_answered", seen)
    out = str(tmp_path / "out")
    stream = source.stream(spark)
    scoring.write_answers(stream, out, str(tmp_path / "state"), interval=None, span=3).start().awaitTermination()
    stored = spark.read.parquet(out)
    assert sorted(r.UUID for r in stored.collect()) == sorted([f"u{i}" for i in range(batches)] + ["old0", "old1"])
    assert len(read) == 2 * batches and max(read) <= 4  # one table of keys and three batches
    assert stored.where(F.col("UUID").startswith("old")).select("batch_id").distinct().count() == 2
    keys = spark.read.parquet(f"{out}_keys").where("ds = '2024-01-01'")
    assert keys.select("upto").distinct().count() <= 2
