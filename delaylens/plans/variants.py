"""JSON documents of events whose fields differ by row."""

from pyspark.sql import functions as F

from delaylens.operators import variants
from delaylens.plans import bindings as b
from delaylens.plans.registry import query

_USER, _TYPE, _SLOT = "CAST(user_id AS {text})", "event_type", "CAST(event_id % 100 AS {text})"
# Every fifth text is cut off.
_DOCUMENT = f"""CASE event_id % 5
    WHEN 0 THEN concat('{{{{"user":', {_USER}, ',"kind":"', {_TYPE}, '"}}}}')
    WHEN 1 THEN concat('{{{{"user":"', {_USER}, '","kind":"', {_TYPE}, '","at":{{{{"slot":', {_SLOT}, '}}}}}}}}')
    WHEN 2 THEN concat('{{{{"user":"u', {_USER}, '","tags":["', {_TYPE}, '",', {_SLOT}, ',null]}}}}')
    WHEN 3 THEN concat('{{{{"user":null,"at":{{{{"slot":"', {_SLOT}, '","old":true}}}}}}}}')
    ELSE concat('{{{{"user":', {_USER}) END"""

_DOCUMENTS_SQL = f"""texts AS (SELECT event_id, event_type, {_DOCUMENT.format(text='VARCHAR')} AS doc FROM events),
    docs AS (SELECT *, CASE WHEN json_valid(doc) THEN CAST(doc AS JSON) END AS j FROM texts)"""


def _documents(spark, folder):
    return b.table(spark, folder, "events").select("event_id", "event_type", F.expr(_DOCUMENT.format(text="STRING")).alias("doc"))


_PATHS = {
    "user": "$.user", "kind": "$.kind", "at": "$.at", "at.slot": "$.at.slot", "at.old": "$.at.old", "tags": "$.tags",
    "tags[]": ("$.tags[0]", "$.tags[1]", "$.tags[2]"),
}
_ENTRIES = ", ".join(
    f"{{'path': '{path}', 'type': json_type(j, '{one}')}}"
    for path, at in _PATHS.items() for one in ((at,) if isinstance(at, str) else at)
)


@query(f"""WITH {_DOCUMENTS_SQL}, e AS (SELECT event_type,
    unnest([{{'path': '$', 'type': coalesce(json_type(j), 'BROKEN')}}, {_ENTRIES}]) AS e FROM docs)
    SELECT event_type, e.path AS path, CASE e.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'text'
    WHEN 'BOOLEAN' THEN 'truth' WHEN 'NULL' THEN 'nothing' WHEN 'BROKEN' THEN 'unreadable' ELSE 'whole' END AS kind, count(*) AS n
    FROM e WHERE e.type IS NOT NULL GROUP BY ALL""")
def document_fields(spark, folder):
    """Which fields the documents of each type of event hold, and values of which kinds."""
    return variants.fields(_documents(spark, folder), "doc", "event_type")


@query(f"""WITH {_DOCUMENTS_SQL}, t AS (SELECT event_id, doc, j, TRY_CAST(json_extract_string(j, '$.user') AS BIGINT) AS user,
    json_extract_string(j, '$.kind') AS kind, TRY_CAST(json_extract_string(j, '$.at.slot') AS INT) AS slot,
    TRY_CAST(json_extract_string(j, '$.at.old') AS BOOLEAN) AS old, json_extract_string(j, '$.tags[0]') AS tag FROM docs)
    SELECT event_id, user, kind, slot, old, tag, CASE WHEN j IS NULL THEN NULL
    WHEN user IS NULL AND json_type(j, '$.user') <> 'NULL' THEN 'user' ELSE '' END AS problems FROM t""")
def document_columns(spark, folder):
    """Typed columns of the same documents, and which of them did not fit."""
    columns = {"user": ("$.user", "bigint"), "kind": ("$.kind", "string"), "slot": ("$.at.slot", "int"),
               "old": ("$.at.old", "boolean"), "tag": ("$.tags[0]", "string")}
    found = variants.typed(_documents(spark, folder), "doc", columns)
    return found.select("event_id", *columns, F.array_join("problems", ",").alias("problems"))


@query(f"""WITH {_DOCUMENTS_SQL} SELECT count(*) FILTER (j IS NOT NULL) AS readable, count(*) AS n,
    'ARRAY<VARIANT>' AS tags, 'VARIANT' AS slot FROM docs""")
def document_schema(spark, folder):
    """The one schema of all these documents, found from all rows; a field of several kinds is a variant."""
    doc = F.try_parse_json("doc")
    kinds = F.schema_of_variant_agg(doc)
    return _documents(spark, folder).agg(
        F.count(doc).alias("readable"), F.count("*").alias("n"),
        F.regexp_extract(kinds, r"tags: (ARRAY<\w+>)", 1).alias("tags"), F.regexp_extract(kinds, r"slot: (\w+)", 1).alias("slot"),
    )
