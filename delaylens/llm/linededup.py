"""Removal of lines that occur before, also with one edit or with edits in proportion to length.

Edit join by segment partition: two lines within an edit distance of one differ inside a single
one of any segments that the shorter is cut into; all others match, those behind it shifted by
the difference in length. A line therefore has, per length it may be joined with and segment
that may hold the edit, one key of all the rest. First, two segments, the threshold plus one, drop
nearly all lines: their keys are the beginning and the end of a line, of a length that two lines
one edit apart agree on, so two keys do for nearly every line. Lines that share a key with another
are divided into more segments, so that even many variants of one line meet only if they differ
in the same few characters. Only then pairs are made and verified by banded edit distance.

With ``per``, two lines may differ by one edit per so many characters of the longer, ``most`` at
most. Beyond one edit the segments of one size lie at the beginning and at the end of a line: one
of these two parts holds at most half of the edits, so among one segment more than that, counted
from its end of the line, one is whole and shifted by no more than its number. The shorter line
gives its segments as keys, the longer all substrings that they may have become. Segments are
dealt with in passes, by end and number, so that only a pass's share of the keys is on disk at once.

Up to the last step of one edit keys are only counted, and equal lines have equal keys, so neither a line
that a third of all documents repeat nor its variants are gathered. All expressions are Spark's
own; the banded distance is its ``levenshtein`` with a threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.ngramjoin import components
from delaylens.llm.scratch import Scratch, small

#: Segments at each level, shortest line that is compared with others, and rows of one number
#: that may be broadcast.
LEVELS, SHORTEST, KEYS = (8, 32), 20, 1_000_000
#: Most edits of a line that may have several.
MOST = 32
#: Keys of a pass for each line, if lines may have several edits: their shuffle is about as large as that of the lines.
LINE_KEYS = 20


def _halves(line: Column) -> Column:
    """Keys of a line: its beginning and end, one of which an edit leaves whole.

    Their length is the largest power of two in half the line's. A line whose length is a power of
    two may be one character longer than another with half of that, so it also has those keys.
    """
    n = F.length(line)
    digits = F.length(F.bin(n))
    ends = lambda h: [F.xxhash64(F.lit(0), F.substring(line, F.lit(1), h)), F.xxhash64(F.lit(1), F.substring(line, -h, h))]
    half, less = (F.pow(F.lit(2), digits - k).cast("int") for k in (2, 3))
    return F.when(n == half * 2, F.array(*ends(half), *ends(less))).otherwise(F.array(*ends(half)))


def _keys(line: Column, segments: int) -> Column:
    """Keys of a line: as the shorter of two, as one of equal length and as the longer."""
    out = []
    for longer in (0, 1):
        length = F.length(line) - longer
        for j in range(segments):
            start, end = (F.floor(length * i / segments).cast("int") for i in (j, j + 1))
            key = F.xxhash64(
                F.lit(segments), F.lit(j), length, F.substring(line, F.lit(1), start),
                F.substring(line, end + 1 + longer, F.length(line)),
            )
            out.append(F.when(length >= SHORTEST, key))
    return F.filter(F.array(*out), lambda k: k.isNotNull())


def _survivors(lines: DataFrame, keys: Column, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(key, line_id) of keys that different lines have, and the distinct ids of those lines."""
    keyed = scratch.store(lines.select("line_id", F.explode(keys).alias("key")))
    spread = keyed.groupBy("key").agg(F.min("line_id").alias("low"), F.max("line_id").alias("high"))
    shared = scratch.store(spread.where("low <> high").select("key"))
    met = keyed.join(small(shared, KEYS), "key")
    return met, scratch.store(met.select("line_id").distinct())


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Every line that is not blank: _id, _row (of its document), position, line, line_id."""
    base = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    return (
        base.select("_id", F.xxhash64("_id", "_text").alias("_row"), F.posexplode(F.split("_text", "\n")).alias("position", "line"))
        .withColumn("line", F.btrim("line", F.lit(" \t\r")))
        .where("line <> ''")
        .withColumn("line_id", F.xxhash64("line"))
    )


def _edits(n: Column, per: int, most: int) -> Column:
    return F.least(F.greatest(F.floor(n / per), F.lit(1)), F.lit(most)).cast("int")


def _end(text: str, side: int, numbers: range, segments: Column, size: int, shifted: bool) -> Column:
    """Keys of the segments ``numbers`` of a line's first ``segments`` from one end, or of all that may have become of them."""

    key = lambda j, at: F.when((at >= 1) & (at + size - 1 <= F.col("n")), F.xxhash64(F.lit(side), j, F.substring(F.col(text), at, F.lit(size))))
    around = lambda j: F.sequence(-j, j) if shifted else F.array(F.lit(0))
    last = F.least(segments, F.lit(numbers.stop)) - 1
    keys = F.flatten(F.transform(F.sequence(F.lit(numbers.start), last), lambda j: F.transform(around(j), lambda d: key(j, j * size + d + 1))))
    return F.array_compact(F.array_distinct(keys))


def _passes(lines: dict[int, int], keys: int) -> list[range]:
    """Segments by number, of about so many keys a pass, given the lines of each number of segments."""
    out, start, held = [], 0, 0
    for j in range(max(lines, default=1)):
        more = 2 * (j + 1) * sum(n for segments, n in lines.items() if segments > j)
        if held and held + more > keys:
            out.append(range(start, j))
            start, held = j, 0
        held += more
    return [*out, range(start, max(lines, default=1))]


def _longer_links(every: DataFrame, per: int, most: int, scratch: Scratch) -> DataFrame:
    """(a, b): ids of different lines, the longer of ``2 * per`` characters or more, within its edits."""
    line, n, size = F.col("line"), F.col("n"), (per - 1) // 2
    long = every.where(F.length(line) >= 2 * per - 2).groupBy("line_id").agg(F.min("line").alias("line"))
    # Lines are stored with all that their keys read, which expressions on arrays would work out once a key.
    reach = (most // 2 + 1) * (size + 1)
    lines = scratch.store(long.select("line_id", "line", F.reverse(F.right(line, F.lit(reach))).alias("back"), F.length("line").alias("n")))
    halves = lambda length: F.floor(_edits(length, per, most) / 2).cast("int") + 1
    gives, asks = halves(n + _edits(n, per, most) + 1), halves(n)
    counts = {r["segments"]: r["n"] for r in lines.groupBy(gives.alias("segments")).agg(F.count("*").alias("n")).collect()}
    found = []
    for numbers in _passes(counts, max(KEYS, LINE_KEYS * sum(counts.values()))):
        for side, text in enumerate(("line", "back")):
            given = lines.where(gives > numbers.start).select(
                F.col("line_id").alias("a"), n.alias("n_a"), F.explode(_end(text, side, numbers, gives, size, False)).alias("key")
            )
            asked = lines.where((n >= 2 * per) & (asks > numbers.start)).select(
                F.col("line_id").alias("b"), n.alias("n_b"), F.explode(_end(text, side, numbers, asks, size, True)).alias("key")
            )
            apart = F.col("n_b") - F.col("n_a")
            met = asked.join(given, "key").where((F.col("a") != F.col("b")) & (apart >= 0) & (apart <= _edits(F.col("n_b"), per, most)))
            found.append(scratch.store(met.where((apart > 0) | (F.col("a") < F.col("b"))).select("a", "b").distinct()))
    pairs = scratch.store(reduce(DataFrame.unionByName, found).distinct())
    # Only lines of a pair are shuffled whole.
    named = scratch.store(pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct())
    texts = scratch.store(lines.select("line_id", "line").join(small(named, KEYS), "line_id"))
    # Pairs can be many times the lines; so can be the lines that they carry, on disk for a block at once.
    blocks = max(1, -(-pairs.count() // max(KEYS, sum(counts.values()))))
    return reduce(DataFrame.unionByName, [
        scratch.store(_within(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(blocks)) == i), texts, per, most)) for i in range(blocks)
    ])


def _within(pairs: DataFrame, texts: DataFrame, per: int, most: int) -> DataFrame:
    """Of ``pairs``, ``b`` the longer line, those within its edits."""
    for x in "ab":
        pairs = pairs.join(texts.select(F.col("line_id").alias(x), F.col("line").alias(f"line_{x}")), x)
    allowed = pairs.withColumn("_edits", _edits(F.length("line_b"), per, most))
    return allowed.where("levenshtein(line_a, line_b, _edits) >= 0").select("a", "b")


def line_links(
    docs: DataFrame, text: str = "text", key: str = "doc_id", scratch: Scratch | None = None, per: int | None = None, most: int = MOST
) -> DataFrame:
    """(a, b): ids of different lines of at least ``SHORTEST`` characters within one edit.

    With ``per`` two lines may be as many edits apart as the longer has ``per`` characters, at
    least one and at most ``most``. No such pair is missed.
    """
    if per is not None and (per < SHORTEST or most < 1):
        raise ValueError(f"per must be {SHORTEST} or more, most 1 or more")
    scratch = scratch or Scratch(docs.sparkSession, "linededup", tidy=per is not None)
    every = _lines(docs, text, key).select("line_id", "line")
    if per is not None and most > 1:
        longer = _longer_links(every, per, most, scratch)
        return _one_edit_links(every.where(F.length("line") < 2 * per), scratch).unionByName(longer)
    return _one_edit_links(every, scratch)


def _one_edit_links(every: DataFrame, scratch: Scratch) -> DataFrame:
    lines, line = every, F.col("line")
    for keys in (_halves(line), *(_keys(line, segments) for segments in LEVELS)):
        _, left = _survivors(lines.where(F.length(line) >= SHORTEST), keys, scratch)
        lines = scratch.store(lines.join(small(left, KEYS), "line_id").groupBy("line_id").agg(F.min("line").alias("line")))
    met, _ = _survivors(lines, _keys(line, LEVELS[-1]), scratch)
    met = scratch.store(met.distinct())
    a, b = (met.select("key", F.col("line_id").alias(x)) for x in "ab")
    pairs = a.join(b, "key").where("a < b").select("a", "b").distinct()
    for x in "ab":
        pairs = pairs.join(lines.select(F.col("line_id").alias(x), F.col("line").alias(f"line_{x}")), x)
    return pairs.where(F.levenshtein("line_a", "line_b", 1) >= 0).select("a", "b")


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", per: int | None = None, most: int = MOST) -> DataFrame:
    """Per row of ``docs``: its key, _row, n_lines, n_removed and removed (positions from 0).

    Lines are separated by line feeds and compared without blanks, tabs and carriage returns at
    their ends. Lines link if they are equal or, from ``SHORTEST`` characters on, one edit apart,
    with ``per`` one edit for so many characters of the longer, up to ``most`` edits; a class is what links reach. A line goes if a line of its class is in a row with a smaller
    key or earlier in its own row. Blank lines stay. Rows with equal keys do not remove lines from
    each other; rows with a null key count as later than all others. A null text has no lines.
    Equal rows are judged alike. Other columns are not read. An empty table gives none.
    """
    scratch = Scratch(docs.sparkSession, "linededup", tidy=per is not None)
    lines = _lines(docs, text, key).drop("line")
    labels = components(scratch.store(line_links(docs, text, key, scratch, per, most)), scratch).withColumnRenamed("key", "line_id")
    first = scratch.store(lines.groupBy("line_id").agg(F.min("_id").alias("first"), F.count("*").alias("times")))
    named = first.join(labels, "line_id", "left").withColumn("label", F.coalesce("label", "line_id"))
    classes = named.groupBy("label").agg(F.min("first").alias("first"), F.sum("times").alias("times")).where("times > 1")
    found = scratch.store(named.select("line_id", "label").join(classes, "label").select("line_id", "label", "first"))
    placed = lines.join(small(found), "line_id")
    again = F.row_number().over(Window.partitionBy("_row", "_id", "label").orderBy("position"))
    removed = (
        placed.select("_row", "_id", "label", "first", "position").distinct().withColumn("_again", again)
        .where((F.col("_again") > 1) | (F.col("_id") > F.col("first")) | (F.col("_id").isNull() & F.col("first").isNotNull()))
        .groupBy("_row").agg(F.array_sort(F.collect_list("position")).alias("removed"))
    )
    base = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    rows = base.select(
        "_id", F.xxhash64("_id", "_text").alias("_row"),
        F.coalesce(F.size(F.split("_text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
    )
    none = F.array().cast("array<int>")
    return (
        rows.join(removed, "_row", "left").withColumn("removed", F.coalesce("removed", none))
        .select(F.col("_id").alias(key), "_row", F.when(F.col("n_lines") > 0, F.col("n_lines")).otherwise(0).alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed")
    )


def remove_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", per: int | None = None, most: int = MOST) -> DataFrame:
    """``docs`` with the lines of ``repeated_lines`` taken out of ``text``; all columns are kept."""
    removed = repeated_lines(docs, text, key, per, most).where("n_removed > 0").select("_row", "removed").dropDuplicates(["_row"])
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(own.alias("_own"), F.xxhash64(F.col(key), F.col(text).cast("string")).alias("_row"))
    before = F.col("_own").getField(text).cast("string")
    kept = F.filter(F.split(before, "\n"), lambda _, i: ~F.array_contains("removed", i))
    after = F.when(F.col("removed").isNull(), before).otherwise(F.array_join(kept, "\n"))
    joined = rows.join(removed, "_row", "left")
    return joined.select(*((after if c == text else F.col("_own").getField(c)).alias(c) for c in docs.columns))
