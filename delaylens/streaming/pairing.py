"""Requests and their responses as two streams that meet by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paired(
    requests: DataFrame, responses: DataFrame, key: str, asked: str, answered: str, answer: Sequence[str],
    within: str = "5 minutes", delay: str = "10 minutes",
) -> DataFrame:
    """Each request once, with ``OK`` and its response or, finally, ``WAIT``.

    A request pairs with the first response to come that was ``answered`` at or after it was
    ``asked``, by ``within`` at most. ``WAIT`` comes out when no such response can come any more,
    that is once both streams have passed the request by ``within`` and ``delay``. Rows of either
    stream that are later than ``delay`` are lost to it; of repeated requests or responses within
    that time one counts. State holds only rows from the last ``within`` and ``delay``, so it is
    bounded by the rate of requests. Rows without a key or a time pair with nothing and are left out.
    """
    known = lambda df, at: df.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    left = known(requests, asked).withWatermark(asked, delay).dropDuplicatesWithinWatermark([key])
    right = known(responses, answered).select(F.col(key).alias("_key"), F.col(answered).alias("_answered"), F.struct(*answer).alias("_answer"))
    right = right.withWatermark("_answered", delay).dropDuplicatesWithinWatermark(["_key"])
    timely = (F.col("_answered") >= F.col(asked)) & (F.col("_answered") <= F.col(asked) + F.expr(f"INTERVAL {within}"))
    joined = left.join(right, (F.col(key) == F.col("_key")) & timely, "leftOuter")
    return joined.select(
        *requests.columns, F.when(F.col("_key").isNull(), "WAIT").otherwise("OK").alias("status"),
        F.col("_answered").alias(answered), *[F.col(f"_answer.{a}").alias(a) for a in answer],
    )
