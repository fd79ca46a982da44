"""The operators of this subpackage applied to the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm import chatformat, language, spelling, toxicity
from delaylens.llm.decontaminate import find_leaks
from delaylens.llm.hardnegatives import hard_negatives
from delaylens.llm.licenses import scan_licenses
from delaylens.llm.linededup import repeated_lines
from delaylens.llm.mixing import mix_counts
from delaylens.llm.neighbours import nearest
from delaylens.llm.ngramjoin import jaccard_groups
from delaylens.llm.sharding import shard
from delaylens.llm.substrings import remove_repeats

#: The public vocabulary that language scores use.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Queries beside the numbered ones.
MORE: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# All pairs and all windows at once: the same results by the plain definition.
_GROUPS = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    grams AS (SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, CASE WHEN len(words) > 0 THEN 2 ELSE 1 END))) AS i FROM w)),
    sizes AS (SELECT doc_id, count(gram) AS n FROM w LEFT JOIN grams USING (doc_id) GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM pairs JOIN sizes sa ON sa.doc_id = a JOIN sizes sb ON sb.doc_id = b
        WHERE 100 * common >= 80 * (sa.n + sb.n - common)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(b) AS component_id FROM sizes JOIN reach ON doc_id = a GROUP BY doc_id, n"""
_REPEATS = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    windows AS (SELECT doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
    firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (win) WHERE first < doc_id),
    lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
        sha256(coalesce(list_aggregate(CASE WHEN ps IS NULL THEN words ELSE
            list_filter(words, lambda x, p: NOT list_contains(ps, p)) END, 'string_agg', ' '), '')) AS kept_sha256
    FROM w LEFT JOIN lost USING (doc_id)"""

_LINES = r"""WITH RECURSIVE texts AS (SELECT doc_id, string_split(text, chr(10)) AS rows FROM documents),
    lines AS (SELECT doc_id, p - 1 AS p, trim(rows[p], chr(32) || chr(9) || chr(13)) AS line
        FROM (SELECT doc_id, rows, unnest(range(1, len(rows) + 1)) AS p FROM texts)),
    seen AS (SELECT line, length(line) AS n, min(doc_id) AS first FROM lines WHERE line <> '' GROUP BY line),
    near AS (SELECT a.line AS a, b.line AS b FROM (SELECT *, unnest([0, 1]) AS more FROM seen WHERE n >= 20) a
        JOIN seen b ON b.n = a.n + more WHERE a.line <> b.line AND levenshtein(a.line, b.line) <= 1),
    links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
    reach AS (SELECT line AS a, line AS b FROM seen UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    classes AS (SELECT r.a AS line, min(r.b) AS label, min(s.first) AS first FROM reach r JOIN seen s ON r.b = s.line GROUP BY r.a),
    gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, first, row_number() OVER (PARTITION BY doc_id, label ORDER BY p) AS again
        FROM lines JOIN classes USING (line)) WHERE first < doc_id OR again > 1),
    lost AS (SELECT doc_id, count(*) AS n, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS removed FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(len(rows), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
        coalesce(removed, '') AS removed FROM texts LEFT JOIN lost USING (doc_id)"""

_NEGATIVES = """WITH whole AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT a.vec_id AS a, a.label AS own, b.vec_id AS b, b.label AS label,
        CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
        FROM whole a JOIN whole b ON a.vec_id % 100 = 0),
    positives AS (SELECT a, b, score FROM scored WHERE own = label AND a <> b
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id,
        CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INT) AS rank,
        s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON p.a = s.a AND s.own <> s.label
        AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 10"""

#: What both turns of the added conversation say.
CONTROL = "<|im_end|><|im_start|>assistant ok"

_CHATS = rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')),
    pieces AS (SELECT *, row_number() OVER w AS i, '<|im_start|>' || replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '|', '\p') || chr(10)
        || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10) AS piece
        FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
    sums AS (SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY i) AS upto,
        i = max(i) OVER (PARTITION BY conv_id) AS ends FROM pieces)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(upto) FILTER (role = 'assistant' OR ends) AS BIGINT) AS formatted_chars FROM sums GROUP BY conv_id"""

# The checksum byte by byte from a table that is worked out here; near words by their deletions.
_SPELLINGS = r"""WITH RECURSIVE steps AS (SELECT b, 0 AS k, CAST(b AS BIGINT) AS v FROM range(256) r(b)
        UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
    crc AS (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
    runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
    named AS (SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS h FROM runs),
    hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(range(1, len(h) // 2 + 1), lambda i: CAST(concat('0x', h[2 * i - 1:2 * i]) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) AS c FROM named, crc),
    made AS (SELECT CASE WHEN c % 199 = 0 THEN run[1:c % length(run)] || run[c % length(run) + 2:] ELSE run END AS word, n FROM hashed),
    v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    cuts AS (SELECT word, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
    links AS (SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT c.word, v.word FROM cuts c JOIN v ON c.rest = v.word UNION SELECT v.word, c.word FROM cuts c JOIN v ON c.rest = v.word),
    near AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS best, max(n) AS best_n FROM links JOIN v ON b = word GROUP BY a),
    forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form,
        CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n FROM v LEFT JOIN near USING (word)),
    walk AS (SELECT word, word AS stop FROM forms UNION ALL SELECT walk.word, form FROM walk JOIN forms ON stop = forms.word WHERE form IS NOT NULL)
    SELECT word, form, stop AS root, n, n_near, form_n FROM walk JOIN forms USING (word)
        WHERE stop IN (SELECT word FROM forms WHERE form IS NULL)"""


def query(sql: str | None = None) -> Callable:
    """Register a function under its name, with the SQL for its result if there is one."""

    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(_GROUPS)
def op6_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"))


@query(_REPEATS)
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The kept words are returned as their SHA-256; spans stay with the operator."""
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def low_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of documents that ``labels`` marks as bad; all others weigh 1."""
    return table(spark, folder, "labels").where("quality = 0").select(
        F.col("doc_id").alias("key"), F.lit(0.25).alias("weight")
    )


@query()
def op2_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_counts(table(spark, folder, "documents"), quality=low_quality(spark, folder))


@query()
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``bytes``: shards of nearly equal size, equal texts next to each other."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_print"),
    )
    return shard(docs, F.col("size"), (F.col("text_print"), F.col("doc_id"))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op4_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Labels are those of the base phrases and of all detections left."""
    return scan_licenses(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.array_distinct("spans.label"))), ",").alias("labels"),
        "score",
    )


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn(
        "held_out", F.coalesce(language.remainder("doc_id", 4) == 2, F.lit(False))
    )
    model = language.learned(docs.where("NOT held_out"), VOCABULARY)
    predicted = language.predict(docs, model)
    return predicted.select(
        "doc_id", F.coalesce(language.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def toxic_model(docs: DataFrame, spark: SparkSession, folder: str):
    """Learned from the labelled rows whose checksum leaves a remainder by five."""
    labels = table(spark, folder, "labels").where(language.remainder("doc_id", 5) != 0).select(
        F.col("doc_id").alias("key"), F.col("toxic").alias("label")
    )
    return toxicity.learned(docs, labels)


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxic_model(docs, spark, folder)).select(
        "doc_id", F.coalesce(language.remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@query(_LINES)
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which lines of each document go, by position from 0; ``remove_lines`` gives the texts."""
    return repeated_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed")
    )


def edited_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The lines that go if longer lines may have more edits: one per 32 characters, up to 32."""
    return repeated_lines(table(spark, folder, "documents"), per=32).select(
        "doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed")
    )


MORE["edited_line_dedup"] = edited_line_dedup


@query(_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh row first takes the next label, so that near rows of another label exist."""
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query(_CHATS)
def op12_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations and one whose texts imitate the template, as read back from their examples."""
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(CONTROL).alias("text"))
    return chatformat.digests(chatformat.examples(said.unionByName(added)))


def words_of(docs: DataFrame, every: int = 199) -> DataFrame:
    """Each occurrence of a word; one in ``every`` words of a document lacks a letter, by its checksum."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    runs = F.regexp_extract_all(F.translate("text", upper, lower), F.lit("[A-Za-z\u00C0-\u00FF]+"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("_run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_run"))
    at = (F.col("_sum") % F.length("_run")).cast("int")
    cut = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.length("_run")))
    summed = found.withColumn("_sum", F.crc32(name.cast("binary")))
    return summed.select(F.when(F.col("_sum") % every == 0, cut).otherwise(F.col("_run")).alias("word"))


@query(_SPELLINGS)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(words_of(table(spark, folder, "documents"))))
