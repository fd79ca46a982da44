"""Groups of documents that are linked by the Jaccard similarity of their word n-grams.

The method is vertical partitioning: n-grams have one global order (that of their 64-bit
fingerprints), the order is cut into fragments, every fragment counts what its part of the sets
has in common, and the partial counts are summed.

1. Equal sets form a class; only classes are compared.
2. Fragments of the corpus count, per class, how many of its first n-grams other classes hold.
   A class that links to another must share enough of them, so most classes end here.
3. Every remaining class is compared with the representative of its bucket (the classes with
   the same smallest n-gram under several orders). Overlaps are partial counts per fragment.
   Links found so far make components, without pairs inside a group of copies.
4. Fragments count, per class, the n-grams held outside its own component. A class below the
   threshold cannot link to another component. For the few others all pairs that share one of
   their rarest n-grams and lie in different components are compared, so no component is missed.

Results are exact but for equal fingerprints of different n-grams (chance near 2**-61 a pair).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.scratch import Scratch, partitions, small
from delaylens.llm.words import BATCH, blanks, grams, mixed, pooled, split, tidy, tidy_group

#: n-grams that one fragment of the corpus holds, and classes whose counts travel in one row.
FRAGMENT, BUCKET = 2_000_000, 2000
#: Fragments that the sets of compared classes are cut into, and orders for representatives.
PARTS, ORDERS = 4, 4
_MIXED = 0xFFFF


def sets_of(column: pa.Array, size: int, fold: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram fingerprints of every text.

    A text with fewer words has one fingerprint for its whole sequence, one without words none.
    """
    words = split(column, blanks(), fold)
    prints, owners, _ = grams(words, size)
    edges = np.searchsorted(owners, np.arange(len(column) + 1))
    for i in range(len(column)):
        first, last = words.bounds[i], words.bounds[i + 1]
        if 0 < last - first < size:
            total = np.uint64(last - first)
            for p in words.prints[first:last]:
                total = mixed(np.array([total]) * np.uint64(31) + p)[0]
            yield np.array([total], np.uint64)
            continue
        tokens = np.sort(prints[edges[i] : edges[i + 1]])
        yield tokens[np.append(True, tokens[1:] != tokens[:-1])] if len(tokens) else tokens


def digest(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def least(n: int, percent: int) -> int:
    """The overlap that a set of n needs with any set it links to."""
    return -(-percent * n // 100)


def similar(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return overlap * 100 >= (a + b - overlap) * percent


# -- 1: classes


def _signed(size: int, fold: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pooled(batches, "_text"):
            sets = list(sets_of(batch.column("_text"), size, fold))
            keys = [digest(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    batch.column("_id"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array([k and int.from_bytes(k[:8], "little", signed=True) for k in keys], pa.int64()),
                ],
                names=["_row", "_id", "n", "key", "brief"],
            )

    return run


# -- 2 and 4: what fragments of the corpus share


def _dealt(keys: np.ndarray, groups: np.ndarray, tokens: np.ndarray, owners: np.ndarray, fragments: int):
    """Rows for the fragments: the n-grams of some sets, with what is settled among these alone.

    An n-gram that several groups here hold is credited at once; one entry of it travels on.
    """
    short = tokens >> np.uint64(16)
    order = np.argsort(short)
    short, owners = short[order], owners[order]
    fresh = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
    sizes = np.diff(np.append(fresh, len(short)))
    held = groups[owners]
    several = np.minimum.reduceat(held, fresh) != np.maximum.reduceat(held, fresh)
    known = np.repeat(several, sizes)
    credit = np.bincount(owners[known], minlength=len(keys))
    keep = ~known
    keep[fresh[several]] = True
    marks = np.where(known, _MIXED, owners)[keep]
    short = short[keep]
    place = (short >> np.uint64(24)) * np.uint64(fragments) >> np.uint64(24)
    cuts = np.searchsorted(place, np.arange(fragments + 1, dtype=np.uint64))
    rank = np.zeros(_MIXED + 1, np.int64)
    rank[_MIXED] = _MIXED
    for f in range(fragments):
        part = slice(cuts[f], cuts[f + 1])
        if part.start == part.stop:
            continue
        own = np.unique(marks[part])
        own = own[own != _MIXED]
        rank[own] = np.arange(len(own))
        entries = short[part] << np.uint64(16) | rank[marks[part]].astype(np.uint64)
        yield f, entries.tobytes(), keys[own].tobytes(), groups[own].tobytes(), b"", b""
    got = np.flatnonzero(credit)
    if len(got):
        yield int(keys[0] % fragments), b"", b"", b"", keys[got].tobytes(), credit[got].tobytes()


_DEALT = "fragment int, entries binary, keys binary, groups binary, settled binary, credits binary"
_FIELDS = pa.schema([
    ("fragment", pa.int32()), ("entries", pa.binary()), ("keys", pa.binary()), ("groups", pa.binary()),
    ("settled", pa.binary()), ("credits", pa.binary()),
])


def _credited(buckets: int) -> Callable:
    """Per class, how many n-grams of a fragment other groups hold too; many classes to a row."""

    def run(table: pa.Table) -> pa.Table:
        keys, credit = _shared(table)
        own, back = np.unique(keys, return_inverse=True)
        credit = np.bincount(back, credit, len(own)).astype(np.int64)
        place = (own.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        own, credit, place = own[order], credit[order], place[order]
        new = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        parts = [slice(a, b) for a, b in zip(new, np.append(new[1:], len(place)))]
        return pa.table({
            "bucket": pa.array(place[new], pa.int64()),
            "keys": pa.array([own[p].tobytes() for p in parts], pa.binary()),
            "credits": pa.array([credit[p].tobytes() for p in parts], pa.binary()),
        })

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The counts of all fragments for the classes of a bucket."""
    keys, credits = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("keys", "credits"))
    own, back = np.unique(keys, return_inverse=True)
    return pa.table({"brief": own, "credit": np.bincount(back, credits, len(own)).astype(np.int64)})


def _shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    column = {c: [x.as_py() for x in table.column(c)] for c in table.column_names if c != "fragment"}
    join = lambda name, kind: np.frombuffer(b"".join(column[name]), kind)
    entries, keys, groups = join("entries", np.uint64), join("keys", np.int64), join("groups", np.int64)
    out_keys, out = [join("settled", np.int64)], [join("credits", np.int64)]
    if len(entries):
        base = np.cumsum([0] + [len(x) // 8 for x in column["keys"]][:-1])
        base = np.repeat(base, [len(x) // 8 for x in column["entries"]])
        ordinal = (entries & np.uint64(_MIXED)).astype(np.int64)
        whole = ordinal == _MIXED
        owner = np.where(whole, 0, ordinal + base)
        short = entries >> np.uint64(16)
        order = np.argsort(short)
        short, owner, whole = short[order], owner[order], whole[order]
        fresh = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
        held = groups[owner] if len(groups) else np.zeros(len(owner), np.int64)
        shared = np.minimum.reduceat(np.where(whole, np.iinfo(np.int64).max, held), fresh) != np.maximum.reduceat(
            np.where(whole, np.iinfo(np.int64).min, held), fresh
        )
        shared |= np.logical_or.reduceat(whole, fresh)
        take = np.repeat(shared, np.diff(np.append(fresh, len(short)))) & ~whole
        credit = np.bincount(owner[take], minlength=len(keys))
        got = np.flatnonzero(credit)
        out_keys.append(keys[got])
        out.append(credit[got])
    return np.concatenate(out_keys), np.concatenate(out)


def _credits(dealt: DataFrame, classes: int) -> DataFrame:
    """Sum of the fragments' counts per class."""
    counted = _credited(max(1, classes // BUCKET))
    return (
        dealt.groupBy("fragment").applyInArrow(tidy_group(counted), "bucket long, keys binary, credits binary")
        .groupBy("bucket").applyInArrow(tidy_group(_summed), "brief long, credit long")
    )


def _first_tokens(size: int, fold: bool, percent: int, fragments: int) -> Callable:
    """The first part of every set in the global order, dealt to fragments.

    If two sets share o n-grams, both hold the first x of these among their first n - o + x.
    With x a fifth of the set, a linked class shares at least ``_needed`` of what is sent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pooled(batches, "_text"):
            sets = {}
            for tokens in sets_of(table.column("_text"), size, fold):
                if key := digest(tokens):
                    n = len(tokens)
                    sets[int.from_bytes(key[:8], "little", signed=True)] = tokens[: n - least(n, percent) + max(1, n // 5)]
            names = list(sets)
            for at in range(0, len(names), _MIXED - 1):
                keys = np.array(names[at : at + _MIXED - 1], np.int64)
                parts = [sets[k] for k in keys.tolist()]
                # The order is that of the fingerprints; their other bits deal them out.
                tokens = mixed(np.concatenate(parts))
                owners = np.repeat(np.arange(len(keys)), [len(x) for x in parts])
                rows = list(_dealt(keys, keys, tokens, owners, fragments))
                for i in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows[i : i + 64]), _FIELDS.types)], schema=_FIELDS
                    )

    return run


def _needed(n: Column, percent: int) -> Column:
    smallest = F.ceil(n * percent / 100)
    return F.greatest(F.lit(1), F.least(F.floor(n / 5), F.floor(smallest / 5)))


def _outside(fragments: int) -> Callable:
    """All n-grams of stored segments, dealt to fragments, with each class's component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pooled(batches, "tokens", 4 * BATCH):
            for at in range(0, table.num_rows, _MIXED - 1):
                part = table.slice(at, _MIXED - 1)
                lists = part.column("tokens")
                tokens = lists.flatten().to_numpy().view(np.uint64)
                if not len(tokens):
                    continue
                owners = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
                keys, groups = (part.column(c).to_numpy() for c in ("brief", "group"))
                rows = list(_dealt(keys, groups, mixed(tokens), owners, fragments))
                for i in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows[i : i + 64]), _FIELDS.types)], schema=_FIELDS
                    )

    return run


# -- 3: sets cut into segments, representatives, overlaps


def _segmented(size: int, fold: bool) -> Callable:
    """Per class and part of the global order, the n-grams there; on the first part the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = constants_of_orders()
        for batch in pooled(batches, "_text"):
            column, wanted = batch.column("_text"), batch.column("key").to_pylist()
            out = []
            for tokens, want in zip(sets_of(column, size, fold), wanted):
                if digest(tokens) != want:
                    continue
                low = [int(mixed(tokens ^ s).min().view(np.int64)) for s in seeds]
                cuts = np.searchsorted(tokens, [np.uint64(p * (2**64 // PARTS)) for p in range(1, PARTS)])
                for part, piece in enumerate(np.split(tokens, cuts)):
                    out.append((want, int.from_bytes(want[:8], "little", signed=True), len(tokens), part, piece.view(np.int64), low))
            for i in range(0, len(out), 1000):
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out[i : i + 1000]), kinds)],
                    names=["key", "brief", "n", "part", "tokens", "buckets"],
                )

    return run


def constants_of_orders() -> list[np.uint64]:
    return [np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64) for i in range(ORDERS)]


_SEGMENTS = "key binary, brief long, n long, part int, tokens array<long>, buckets array<long>"


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the sizes na, nb and the overlap, summed over the parts."""
    of = lambda x: segments.select(
        F.col("key").alias(x), "part", F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}")
    )
    return (
        pairs.join(of("a"), "a").join(of("b"), ["b", "part"])
        .groupBy("a", "b")
        .agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum(F.size(F.array_intersect("ta", "tb"))).alias("overlap"))
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, label) of every node of ``edges`` (a, b): the smallest key that it reaches.

    Labels travel along edges and jump to their label's label; a node's neighbours are only
    ever reduced to their smallest label, never gathered.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.store(both.distinct())
    labels = scratch.store(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (
            both.join(labels.withColumnRenamed("key", "b"), "b")
            .groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near"))
        )
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("jump"))
        moved = (
            labels.join(jump, "label").join(near, "key")
            .select("key", F.least("label", "jump", "near").alias("label"), F.col("label").alias("old"))
        )
        moved = scratch.store(moved)
        labels = moved.select("key", "label")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def jaccard_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", *, size: int = 5, percent: int = 80, fold: bool = True
) -> DataFrame:
    """Per row of ``docs``: its key, n_shingles (size of its set) and component_id.

    Two rows link if ``100 * intersection >= percent * union`` of their sets of ``size`` words;
    component_id is the smallest key among the rows that a row reaches over links, itself
    included. Words are separated by ASCII white space; ``fold`` makes A-Z equal to a-z. A text
    with fewer than ``size`` words counts as one n-gram. Null or blank texts have an empty set
    and link with nothing. Repeated rows and repeated keys are judged row by row. A row with a
    null key is compared like any other but lends no id: component_id is the smallest non-null
    key of its component, null if there is none.
    Other columns of ``docs`` are not read, whatever their names. An empty table gives none.
    """
    signed, of_class = _grouped(docs, text, key, size, percent, fold)
    return signed.join(of_class, "key", "left").select(
        F.col("_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each_group(
    docs: DataFrame, text: str = "text", key: str = "doc_id", *, size: int = 5, percent: int = 80, fold: bool = True
) -> DataFrame:
    """``docs`` with one row of each group of ``jaccard_groups``: that with the smallest key.

    Rows with null keys come last; of equal rows one stays. Rows with an empty set all stay. All
    columns are kept; ``docs`` may not have columns named _row or _stays.
    """
    signed, of_class = _grouped(docs, text, key, size, percent, fold)
    scratch = Scratch(docs.sparkSession, "groups")
    rows = (
        signed.where("key IS NOT NULL").groupBy("key", "_id", "_row").agg(F.count("*").alias("times"))
        .join(of_class.select("key", "label"), "key")
    )
    rows = scratch.store(rows.withColumn("place", F.struct(F.col("_id").isNull(), "_id", "_row")))
    lead = rows.groupBy("label").agg(F.min("place").alias("first"))
    judged = scratch.store(
        rows.join(lead, "label").withColumn("_stays", F.col("place") == F.col("first"))
        .where("NOT _stays OR times > 1").select("_row", "_stays")
    )
    own = F.xxhash64(F.col(key), F.col(text).cast("string"))
    marked = docs.withColumn("_row", own).join(small(judged), "_row", "left")
    single = marked.where("_stays IS NULL")
    if not judged.where("_stays").isEmpty():
        single = single.unionByName(marked.where("_stays").dropDuplicates(["_row"]))
    return single.select(*(F.col(f"`{c}`") for c in docs.columns))


def _grouped(docs: DataFrame, text: str, key: str, size: int, percent: int, fold: bool) -> tuple[DataFrame, DataFrame]:
    """Per row _row, _id, n and the key of its class; per class its label and component_id."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngramjoin")
    base = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    base = base.withColumn("_row", F.xxhash64("_id", "_text"))
    kind = dict(base.dtypes)["_id"]
    signed = scratch.store(base.mapInArrow(tidy(_signed(size, fold)), f"_row long, _id {kind}, n long, key binary, brief long"))
    classes = scratch.store(
        signed.where("key IS NOT NULL").groupBy("key", "_id", "_row")
        .agg(F.count("*").alias("times"), F.max("n").alias("n"), F.max("brief").alias("brief"))
        .groupBy("key", "brief", "n")
        .agg(F.min("_id").alias("least_id"), F.min(F.struct(F.coalesce(F.col("_id").cast("string"), F.lit("")), "_row", "times")).alias("rep"))
        .select("key", "brief", "n", "least_id", "rep._row", "rep.times")
    )
    labels = _linked(base, classes, size, percent, fold, scratch)
    grouped = classes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    ids = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    return signed, grouped.select("key", "label").join(ids, "label").select("key", "label", "component_id")


def _linked(base, classes, size, percent, fold, scratch: Scratch) -> DataFrame:
    """(key, label) of the classes that link to another one."""
    total, count = classes.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    deal = lambda grams: max(1, min(-(-grams // FRAGMENT), 1 << 24))
    sent = base.select("_text").mapInArrow(tidy(_first_tokens(size, fold, percent, deal(total * 2 // 5))), _DEALT)
    credit = _credits(sent, count)
    left = scratch.store(
        classes.join(credit, "brief").where(F.col("credit") >= _needed(F.col("n"), percent))
        .select("key", "_row", "times", "n", "credit")
    )
    # Repeated rows of one document would give its set twice; only these are made distinct.
    # A row is met by key and text: many rows may share a key, as those without one do.
    wanted = small(left.select("key", "_row", "times"))
    docs = base.join(wanted, "_row").select("_text", "key", "times")
    segmented = _segmented(size, fold)
    segments = scratch.store(
        docs.where("times = 1").select("_text", "key").mapInArrow(tidy(segmented), _SEGMENTS)
        .unionByName(docs.where("times > 1").groupBy("key").agg(F.min("_text").alias("_text")).select("_text", "key").mapInArrow(tidy(segmented), _SEGMENTS))
    )
    central = small(left.select("key", (F.col("credit") / F.col("n")).alias("share")))
    nodes = scratch.store(segments.where("part = 0").select("key", "brief", "n", "buckets").join(central, "key"))

    def represented(order: int, labelled: DataFrame | None) -> DataFrame:
        """Each class with the representative of its bucket, unless both are in one component.

        The representative is the class that shares most of its n-grams: of edited copies, the
        one with the fewest edits, which most others link to.
        """
        buckets = nodes.withColumn("bucket", F.col("buckets")[order])
        lead = buckets.groupBy("bucket").agg(F.max_by("key", F.struct("share", "key")).alias("b"), F.count("*").alias("size"))
        found = buckets.join(lead.where("size > 1"), "bucket").where("key <> b").select(F.col("key").alias("a"), "b")
        if labelled is not None:
            la, lb = (labelled.select(F.col("key").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
            found = found.join(la, "a", "left").join(lb, "b", "left").where(
                F.coalesce("la", "a") != F.coalesce("lb", "b")
            )
        return found.select("a", "b")

    def links(pairs: DataFrame) -> DataFrame:
        return scratch.store(
            overlaps(pairs, segments).where(similar(F.col("overlap"), F.col("na"), F.col("nb"), percent)).select("a", "b")
        )

    first = scratch.store(represented(0, None))
    edges = links(first)
    stars = edges.select(F.col("a").alias("key"), F.col("b").alias("label"))
    more = [represented(i, stars) for i in range(1, ORDERS)]
    pairs = more[0]
    for other in more[1:]:
        pairs = pairs.unionByName(other)
    edges = edges.unionByName(links(scratch.store(pairs.distinct())))
    labels = components(edges, scratch)
    rest = links(scratch.store(_missing(segments, nodes, labels, percent, deal, scratch)))
    if rest.isEmpty():
        return labels
    return components(edges.unionByName(rest), scratch)


def _missing(segments, nodes, labels, percent, deal, scratch: Scratch) -> DataFrame:
    """All pairs (a, b) of different components that may still link."""
    named = scratch.store(
        nodes.join(labels, "key", "left").select("key", "brief", "n", F.coalesce("label", "key").alias("label"))
        .withColumn("group", F.xxhash64("label"))
    )
    total, count = nodes.agg(F.sum("n"), F.count("*")).first()
    total = total or 0
    placed = segments.select("key", "brief", "tokens").join(small(named.select("key", "group")), "key")
    outside = _credits(placed.select("brief", "group", "tokens").mapInArrow(tidy(_outside(deal(total))), _DEALT), count)
    open_ = scratch.store(
        named.join(outside, "brief").where(F.col("credit") >= F.ceil(F.col("n") * percent / 100))
        .select("key", "n", "label")
    )
    grams_ = segments.select("key", F.explode("tokens").alias("gram")).join(small(open_), "key")
    spread = grams_.groupBy("gram").agg(
        F.count("*").alias("df"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    shared = grams_.join(spread.where("low <> high").select("gram", "df"), "gram")
    # n-grams that no other component holds come first in the order and use up the prefix.
    ranked = shared.groupBy("key", "n", "label").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("all"))
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("all"))
    prefix = scratch.store(
        ranked.where(room > 0)
        .select("key", "n", "label", F.size("all").alias("held"), F.posexplode(F.slice("all", F.lit(1), room.cast("int"))).alias("at", "x"))
        .select("key", "n", "label", (F.col("held") - F.col("at")).alias("ahead"), "x.gram")
    )
    a, b = (prefix.select("gram", *(F.col(c).alias(f"{c}_{x}") for c in ("key", "n", "label", "ahead"))) for x in "ab")
    near = F.col("n_a").between(F.ceil(F.col("n_b") * percent / 100), F.floor(F.col("n_b") * 100 / percent))
    # From their first common n-gram on, both must still hold as many as their sizes require.
    near &= F.least("ahead_a", "ahead_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return (
        a.join(b, "gram").where((F.col("key_a") < F.col("key_b")) & (F.col("label_a") != F.col("label_b")) & near)
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
    )
