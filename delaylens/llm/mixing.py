"""Mixing of sources to target weights by weighted sampling without replacement.

Every document draws an exponential key whose rate is its quality weight (Efraimidis and
Spirakis): in rising key order, documents of a higher weight tend to come first. A source whose
target exceeds its size is taken whole as often as it fits; the rest of the target is filled in
key order until the prefix sum of sizes reaches it. A document that no longer fits is passed over
and smaller ones further on fill what is left. At the end of its order a source that is still
short goes through it again, as long as a document may be taken once more.

The prefix sum has two levels, so that a source with a third of all rows is never gathered:
sizes are summed per source and range of keys, and only the one range of a source in which its
budget ends is summed row by row. Ranges are as many as the rows need, and divide the keys of
every weight about evenly. All expressions are Spark's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.scratch import Scratch, small

#: Words as the sizes count them.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Ranges that the keys are divided into: so many at least, and one for so many rows.
RANGES, ROWS = 4096, 20_000


def _drawn(rows: DataFrame, weights: DataFrame | None) -> DataFrame:
    """``rows`` with _key (rising: taken earlier) for _draw; ``weights`` is what ``_weights`` gives."""
    rate = F.lit(1.0)
    if weights is not None:
        rows = rows.join(small(weights), rows["_id"] == F.col("_qkey"), "left").drop("_qkey")
        rate = F.coalesce("_weight", F.lit(1.0))
    uniform = (F.shiftrightunsigned("_draw", 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return rows.withColumn("_key", -F.log(uniform) / rate).drop("_weight", "_draw")


def _weights(quality: DataFrame | None, scratch: Scratch) -> DataFrame | None:
    """(_qkey, _weight): the largest weight above zero given to each key."""
    if quality is None:
        return None
    known = quality.where("weight > 0").groupBy(F.col("key").alias("_qkey"))
    return scratch.store(known.agg(F.max("weight").cast("double").alias("_weight")))


@dataclass(frozen=True)
class Ranges:
    """How keys are divided into ranges: a monotone function of the key.

    Keys of weight w are exponential with rate w. The mean of their distributions over rates from
    the least to the largest weight by factors of four spreads keys of each weight so that no range
    has more than a few times the share of an even one for each rate.
    """

    count: int
    rates: tuple[float, ...]

    def place(self, key: Column) -> Column:
        shares = [1 - F.exp(-key * rate) for rate in self.rates]
        return F.least(F.lit(self.count - 1), F.floor(sum(shares[1:], shares[0]) / len(shares) * self.count)).cast("int")


def _ranges(rows: DataFrame, weights: DataFrame | None) -> Ranges:
    least, most = (weights.agg(F.min("_weight"), F.max("_weight")).first() if weights is not None else (None, None))
    rates = [min(1.0, least or 1.0)]
    while rates[-1] * 4 <= max(1.0, most or 1.0):
        rates.append(rates[-1] * 4)
    return Ranges(max(RANGES, rows.count() // ROWS), tuple(rates))


def _draw(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("_id"), text)


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def target_sizes(sources: DataFrame, cap: int) -> DataFrame:
    """``sources`` (source, weight, size) with its target: shares by weight, none above ``cap`` sizes.

    What a capped source leaves is shared by the others by weight, until none is above.
    ``sources`` must be stored: each round is one sum over its rows.
    """
    limit = F.col("size") * cap
    total, weight = sources.agg(F.sum("size"), F.sum("weight")).first()
    level, before = (total / weight if weight else 0.0), None
    while level != before:
        above = F.col("weight") * level > limit
        full, free = sources.agg(F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))).first()
        level, before = ((total - (full or 0)) / free if free else level), level
    above = F.col("weight") * level > limit
    return sources.withColumn("target", F.when(above, limit.cast("double")).otherwise(F.col("weight") * level))


def mixture(
    docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", *,
    weights: Sequence[int] = (5, 2, 1), cap: int = 3, quality: DataFrame | None = None, seed: int = 11,
) -> tuple[DataFrame, DataFrame, DataFrame, Ranges]:
    """The rows of ``docs`` as (_id, _source, _size, _group, _key, _range), and one row per source.

    Per source: _source, source_size, target, epochs (how often it is taken whole) and cuts (the
    stretches of its order, each with the size up to which documents in it are taken once more;
    those of several passes overlap). Then the repeated rows (_id, _key, _copies) and the ranges.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    words = F.col(text).cast("string")
    plain = docs.select(
        F.col(key).alias("_id"), F.col(source).cast("string").alias("_source"), _words(words).alias("_size"), words.alias("_text")
    )
    # Only numbers meet the weights; texts stay where they are read.
    known = _weights(quality, scratch)
    drawn = scratch.store(_drawn(plain.withColumn("_draw", _draw(F.col("_text"), seed)).drop("_text"), known))
    # Rows equal in key and text are taken together or not at all, so they must fit together.
    equal = drawn.groupBy("_source", "_id", "_key").agg(F.count("*").alias("_copies")).where("_copies > 1")
    repeated, ranges = scratch.store(equal), _ranges(drawn, known)
    rows = _placed(drawn, repeated, ranges)
    named = scratch.store(rows.groupBy("_source").agg(F.sum("_size").alias("size")))
    # One row per source: the only window over all of them.
    rank = F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last())) - 1
    cycle = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    sources = target_sizes(scratch.store(named.withColumn("weight", cycle)), cap)
    sources = scratch.store(
        sources.withColumn("epochs", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("size"))
    )
    place = _PLACE.format(dict(rows.dtypes)["_id"])
    state = scratch.store(
        sources.select(
            F.col("_source").alias("_name"), "rest", (F.lit(cap) - F.col("epochs")).alias("passes"), F.lit(None).cast(place).alias("from"),
            F.array().cast(_CUTS.format(place)).alias("cuts"),
        )
    )
    # Each round moves on in every source that is short, so the last one comes when nothing fits.
    more = True
    while more:
        state, more = _advanced(rows, state, place, ranges, scratch)
    plan = sources.join(state.select("_name", "cuts"), F.col("_source").eqNullSafe(F.col("_name")), "left")
    plan = plan.select("_source", F.col("size").alias("source_size"), "target", "epochs", "cuts")
    return rows, scratch.store(plan), repeated, ranges


def _placed(drawn: DataFrame, repeated: DataFrame, ranges: Ranges) -> DataFrame:
    """``drawn`` with the range of each row and _group, the size of all rows equal to it."""
    names = {c: f"_same{c}" for c in ("_source", "_id", "_key")}
    copies = small(repeated.withColumnsRenamed(names))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    grouped = drawn.join(copies, same, "left").withColumn("_group", F.col("_size") * F.coalesce("_copies", F.lit(1)))
    return grouped.drop(*names.values(), "_copies").withColumn("_range", ranges.place(F.col("_key")))


#: Where a row stands in the order of its source, and which stretches of it are taken up to a size.
_PLACE = "struct<_range: int, _key: double, _id: {0}>"
_CUTS = "array<struct<after: {0}, upto: {0}, fits: double>>"


def _advanced(rows: DataFrame, state: DataFrame, place: str, ranges: Ranges, scratch: Scratch) -> tuple[DataFrame, bool]:
    """Take, in key order, rows that fit what is left, up to the first one that does not.

    ``state`` has a row per source: what is left of its budget (rest), how many passes through its
    order may be made with this one (passes), where it stands (from) and the stretches taken so far
    (cuts). Also tells whether any source could take more.
    """
    here = F.struct("_range", "_key", "_id")
    live = (
        rows.join(small(state), rows["_source"].eqNullSafe(F.col("_name")))
        .where((F.col("from").isNull() | (here > F.col("from"))) & (F.col("_group") <= F.col("rest")) & (F.col("_size") > 0))
        .select("_name", "rest", "_range", "_key", "_id", "_size")
    )
    sums = scratch.store(live.groupBy("_name", "rest", "_range").agg(F.sum("_size").alias("_size")))
    upto = Window.partitionBy("_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_upto", F.sum("_size").over(upto))
    # The range in which the budget ends, and what lies before it.
    ends = scratch.store(
        sums.groupBy("_name").agg(
            F.max("_upto").alias("all"),
            F.min(F.when(F.col("_upto") > F.col("rest"), F.struct("_range", (F.col("_upto") - F.col("_size")).alias("before")))).alias("end"),
        )
    )
    edge = ends.where("end IS NOT NULL").select(F.col("_name").alias("_edge"), F.col("end._range").alias("_last"), "end.before")
    inside = live.join(small(edge), F.col("_name").eqNullSafe(F.col("_edge")) & (F.col("_range") == F.col("_last")))
    # Rows that tie count together.
    running = F.col("before") + F.sum("_size").over(Window.partitionBy("_name").orderBy("_key", "_id"))
    taken = (
        inside.withColumn("_sum", running).where(F.col("_sum") <= F.col("rest"))
        .groupBy(F.col("_name").alias("_some")).agg(F.max(here).alias("last"), F.max("_sum").alias("sum"))
    )
    ends = ends.withColumnRenamed("_name", "_ended")
    before = F.struct(F.col("end._range").alias("_range"), F.lit(-1.0).alias("_key"), F.lit(None).alias("_id")).cast(place)
    whole = F.struct(F.lit(ranges.count).alias("_range"), F.lit(0.0).alias("_key"), F.lit(None).alias("_id")).cast(place)
    ended = F.col("end").isNull()
    to = F.when(ended, whole).otherwise(F.coalesce("last", before))
    used = F.when(ended, F.coalesce("all", F.lit(0))).otherwise(F.coalesce("sum", "end.before"))
    cut = F.struct(F.col("from").alias("after"), to.alias("upto"), F.col("rest").alias("fits"))
    rest = F.col("rest") - used
    # A pass from the beginning in which nothing fits is the last one.
    idle = F.col("all").isNull() & F.col("from").isNull()
    again = ended & (F.col("passes") > 1) & (rest >= 1) & ~idle
    moved = scratch.store(
        state.join(ends, F.col("_name").eqNullSafe(F.col("_ended")), "left")
        .join(taken, F.col("_name").eqNullSafe(F.col("_some")), "left")
        .select(
            "_name", rest.alias("rest"), (F.col("passes") - ended.cast("int")).alias("passes"),
            F.when(~again, to).alias("from"),
            F.when(idle & (F.size("cuts") > 0), F.col("cuts")).otherwise(F.concat("cuts", F.array(cut))).alias("cuts"),
            (~ended | again).alias("more"),
        )
    )
    return moved.drop("more"), not moved.where("more AND rest >= 1").isEmpty()


def _times() -> Column:
    """How often a row is taken: its source's epochs, and once more for each stretch taken that it lies in."""
    here = F.struct("_range", "_key", "_id")
    more = F.filter(
        "cuts",
        lambda c: (c["after"].isNull() | (here > c["after"])) & (here <= c["upto"]) & (F.col("_group") <= c["fits"]),
    )
    return F.col("epochs") + F.when(F.col("cuts").isNull(), 0).otherwise(F.size(more))


def mix_counts(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """Per row: its key, size, source_size, target, taken (words, repeats counted) and times.

    Size is the number of words, 0 for a null text. Sources in code point order, null last, have
    the weights in turn; see ``target_sizes``. Only whole documents are taken, in key order, each if
    it fits what is left of the budget, and none more than ``cap`` times. A source falls short of
    its target by less than its smallest document (with all rows equal to it) that was taken fewer
    times. Keys are hashes of row key and text, so reruns agree; rows equal in both are taken or
    left together. Weights that are not above zero count as 1. Empty texts are taken
    with their neighbours and add nothing. An empty table gives none. Columns of ``docs`` beyond
    the three named are not read.
    """
    rows, plan, _, _ = mixture(docs, source, text, key, **options)
    plan = small(plan.withColumnRenamed("_source", "_name"))
    return (
        rows.join(plan, rows["_source"].eqNullSafe(F.col("_name"))).withColumn("times", _times())
        .select(
            F.col("_id").alias(key), F.col("_size").alias("size"), "source_size", "target",
            (F.col("times") * F.col("_size")).alias("taken"), "times",
        )
    )


def mix(docs: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", *, quality: DataFrame | None = None, seed: int = 11, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Cases are defined as for ``mix_counts``.
    """
    _, plan, repeated, ranges = mixture(docs, source, text, key, quality=quality, seed=seed, **options)
    plan = small(plan.withColumnRenamed("_source", "_name"))
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    words = F.col(text).cast("string")
    plain = docs.select(own, F.col(key).alias("_id"), F.col(source).cast("string").alias("_source"), _words(words).alias("_size"), words.alias("_text"))
    plain = plain.withColumn("_draw", _draw(F.col("_text"), seed)).drop("_text")
    drawn = _placed(_drawn(plain, _weights(quality, Scratch(docs.sparkSession, "mixing"))), repeated, ranges)
    taken = drawn.join(plan, drawn["_source"].eqNullSafe(F.col("_name"))).withColumn("_times", _times())
    return (
        taken.where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
        .select("_row.*")
    )
