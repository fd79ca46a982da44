"""Delay buckets, their labels and histogram bins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges in minutes and the label shown for each bucket.
DELAY_EDGES = (-15.0, 0.0, 30.0)
BUCKET_LABELS = {
    0.0: "Early (15+ Minutes Early)",
    1.0: "Slightly Early (0-15 Minute Early)",
    2.0: "Slightly Late (0-30 Minute Delay)",
    3.0: "Very Late (30+ Minutes Late)",
}


def delay_bucket(delay: Column, edges: Sequence[float] = DELAY_EDGES) -> Column:
    """Left-closed bucket number as a double, NULL for NULL."""
    return _edges_passed([delay >= F.lit(e) for e in edges]).cast("double")


def delay_bucket_right_closed(delay: Column, edges: Sequence[float] = DELAY_EDGES) -> Column:
    """Bucket number where a delay equal to an edge belongs to the lower bucket."""
    return _edges_passed([delay > F.lit(e) for e in edges]).cast("double")


def bucket_label(bucket: Column) -> Column:
    cases = [F.when(bucket == F.lit(b), F.lit(label)) for b, label in BUCKET_LABELS.items()]
    return F.coalesce(*cases)


def edge_bin(value: str, edges: Sequence[float]) -> Column:
    """Bin number of a column: bins are left-closed, the last also right-closed; -1 outside.

    A sum of comparisons stays inside generated code. Being never NULL, the number gives the
    optimizer no reason to repeat the whole expression in a filter.
    """
    low, high = float(edges[0]), float(edges[-1])
    passed = " + ".join(f"int({value} >= {float(e)}D)" for e in edges[1:-1]) or "0"
    return F.expr(f"""coalesce(CASE WHEN {value} = {high}D THEN {len(edges) - 2}
        WHEN {value} >= {low}D AND {value} < {high}D THEN {passed} END, -1)""")


def _edges_passed(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [t.cast("int") for t in tests])
