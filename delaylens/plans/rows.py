"""Row-level work: projections, casts, texts, clock times, pages."""

from functools import reduce

from pyspark.sql import functions as F

from delaylens.functions import casting, clock, text
from delaylens.operators import features, pages, summary, weather
from delaylens.operators.joins import located
from delaylens.operators.suffixes import domains_by_rules
from delaylens.plans import bindings as b
from delaylens.plans.registry import query
from delaylens.plans.summaries import FLIGHTS, SCHEDULED_SQL
from delaylens.session import workspace
from delaylens.sources import readers, writers


@query("""SELECT doc_id, CAST(len(string_split(text, ',')) AS INT) AS n_fields,
    string_split(text, ',')[1] AS first_field, string_split(text, ',')[-1] AS last_field FROM documents""")
def text_split_rows(spark, folder):
    docs = b.table(spark, folder, "documents").select("doc_id", "text")
    split = readers.split_fields(docs, "text", ",")
    return split.select(
        "doc_id", F.size("fields").alias("n_fields"), F.get("fields", F.lit(0)).alias("first_field"),
        F.element_at("fields", -1).alias("last_field"),
    )


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word")
def flatten_words(spark, folder):
    docs = b.table(spark, folder, "documents").select("text")
    return summary.count_by(readers.flatten_fields(docs, "text", " ", "word"), ["word"])


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_parse_props(spark, folder):
    events = b.table(spark, folder, "events").select("event_id", "event_type", "props")
    return readers.parse_json(events, "props", "k BIGINT")


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-03'")
def day_partition_read(spark, folder):
    return readers.day_slice(b.table(spark, folder, "events"), "ts", "2024-01-02")


@query(f"""WITH {b.REQUESTS_SQL}, iso AS (SELECT *, strftime("Timestamp", '%Y-%m-%dT%H:%M:%S') AS iso_time FROM requests)
    SELECT * EXCLUDE ("Timestamp") FROM iso WHERE iso_time >= '2024-01-02' AND iso_time <= '2024-01-03'""")
def requests_for_day(spark, folder):
    requests = b.requests(spark, folder).withColumn("iso_time", clock.iso_text(F.col("Timestamp")))
    return readers.iso_day_slice(requests, "iso_time", "2024-01-02").drop("Timestamp")


@query("""SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
    AS value FROM events""")
def rows_to_json(spark, folder):
    return writers.to_json_rows(b.table(spark, folder, "events").select("event_id", "user_id", "event_type"))


@query(f"WITH {FLIGHTS} SELECT FlightNum, FlightDate, Carrier, TailNum, Origin, Dest FROM flights")
def trim_columns(spark, folder):
    return b.flights(spark, folder, "FlightNum", "FlightDate", "Carrier", "TailNum", "Origin", "Dest")


@query(f"WITH {b.AIRPLANES_SQL} SELECT * FROM airplanes")
def airplanes_projection(spark, folder):
    return b.airplanes(spark, folder)


_RAW = ("DepDelay", "ArrDelay", "Distance", "DepDelayMinutes")


@query(f"""WITH {FLIGHTS} SELECT FlightNum, CAST(DepDelay AS FLOAT) AS DepDelay, CAST(ArrDelay AS FLOAT) AS ArrDelay,
    CAST(Distance AS FLOAT) AS Distance, CAST(DepDelayMinutes AS INT) AS DepDelayMinutes FROM flights""")
def cast_fact(spark, folder):
    flights = b.flights(spark, folder, "FlightNum", *_RAW)
    raw = flights.select(
        "FlightNum", *[F.coalesce(F.col(c).cast("string"), F.lit("M")).alias(c) for c in _RAW[:3]],
        F.coalesce(F.col("DepDelayMinutes").cast("int").cast("string"), F.lit("M")).alias("DepDelayMinutes"),
    )
    types = {"DepDelay": "float", "ArrDelay": "float", "Distance": "float", "DepDelayMinutes": "int"}
    return casting.cast_columns(raw, types)


@query(f"WITH {FLIGHTS} SELECT FlightNum, Origin, Dest, Origin || '-' || Dest AS Route FROM flights")
def route_column(spark, folder):
    return features.route(b.flights(spark, folder, "FlightNum", "Origin", "Dest"))


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring'")
def suffix_filter(spark, folder):
    return b.table(spark, folder, "part").select("p_partkey", "p_name").where(F.col("p_name").endswith("ring"))


@query(f"WITH {FLIGHTS} SELECT CAST(count(*) AS BIGINT) AS total, true AS near_a_tenth, true AS all_are_flights FROM flights")
def sample_rows(spark, folder):
    """A tenth of the flights, drawn row by row: how many rows it has is checked, not which."""
    flights = b.flights(spark, folder, "FlightNum", "DepDelay", "ArrDelay")
    drawn = flights.sample(False, 0.1, seed=7).agg(
        F.count("*").alias("n"), F.count_if(F.col("FlightNum").isNull()).alias("strange")
    )
    found = flights.agg(F.count("*").alias("total")).withColumns(
        {"n": drawn.select("n").scalar(), "strange": drawn.select("strange").scalar()}
    )
    # Five standard deviations of a draw of a tenth.
    near = F.abs(F.col("n") - F.col("total") / 10) <= 5 * F.sqrt(F.col("total") * 0.09)
    return found.select("total", near.alias("near_a_tenth"), (F.col("strange") == 0).alias("all_are_flights"))


@query(f"""WITH {FLIGHTS} SELECT 10 AS shown, true AS sorted, true AS drawn_from_flights FROM flights LIMIT 1""")
def sample_top_rows(spark, folder):
    """The first rows, in order, of a seeded sample; the same rows on every run."""
    flights = b.flights(spark, folder, "FlightNum", "FlightDate", "DepDelay")
    top = summary.sample_top(flights, 0.05, ["FlightDate", "FlightNum", "DepDelay"], 10, seed=7)
    same = reduce(lambda x, y: x & y, [top[c].eqNullSafe(flights[c]) for c in top.columns])
    made_up = top.join(flights, same, "left_anti").agg(F.count("*").alias("n")).scalar()
    rows = top.agg(F.count("*").cast("int").alias("shown"), F.collect_list("FlightDate").alias("d"))
    return rows.select("shown", (F.array_sort("d") == F.col("d")).alias("sorted"), (made_up == 0).alias("drawn_from_flights"))


_PREPARED = """SELECT a.Manufacturer, count(*) AS flights, count(DISTINCT f.Origin) AS origins
    FROM flights f JOIN airplanes a ON f.TailNum = a.TailNum GROUP BY a.Manufacturer"""


@query(f"WITH {FLIGHTS}, {b.AIRPLANES_SQL} {_PREPARED}")
def sql_over_views(spark, folder):
    """One SQL text over the prepared tables."""
    flights, planes = b.flights(spark, folder, "TailNum", "Origin"), b.airplanes(spark, folder)
    return readers.run_sql(spark, _PREPARED, flights=flights, airplanes=planes)


@query(f"WITH {FLIGHTS}, {SCHEDULED_SQL} SELECT FlightNum, dep, CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END AS arr FROM scheduled")
def scheduled_timestamps(spark, folder):
    at = _scheduled(b.flights(spark, folder, "FlightNum", "FlightDate", "CRSDepTime", "CRSArrTime"))
    return at.select("FlightNum", "dep", clock.after_departure(F.col("dep"), F.col("arr")).alias("arr"))


@query(f"""WITH {FLIGHTS}, {SCHEDULED_SQL} SELECT FlightNum, strftime(dep, '%Y-%m-%dT%H:%M:%S') AS departure,
    strftime(CASE WHEN CAST(arr AS TIME) < CAST(dep AS TIME) THEN arr + INTERVAL 1 DAY ELSE arr END,
    '%Y-%m-%dT%H:%M:%S') AS arrival FROM scheduled""")
def overnight_arrivals(spark, folder):
    at = _scheduled(b.flights(spark, folder, "FlightNum", "FlightDate", "CRSDepTime", "CRSArrTime"))
    arrival = clock.after_departure_clock(F.col("dep"), F.col("arr"))
    return at.select(
        "FlightNum", clock.iso_text(F.col("dep")).alias("departure"), clock.iso_text(arrival).alias("arrival")
    )


@query(f"""WITH {FLIGHTS}, {SCHEDULED_SQL} SELECT FlightNum, datediff('second', dep,
    CASE WHEN arr < dep THEN arr + INTERVAL 1 DAY ELSE arr END) AS seconds FROM scheduled""")
def flight_time(spark, folder):
    at = _scheduled(b.flights(spark, folder, "FlightNum", "FlightDate", "CRSDepTime", "CRSArrTime"))
    arrival = clock.after_departure(F.col("dep"), F.col("arr"))
    return at.select("FlightNum", clock.seconds_between(F.col("dep"), arrival).alias("seconds"))


def _scheduled(flights):
    return flights.withColumns({
        "dep": clock.scheduled_at(F.col("FlightDate"), F.col("CRSDepTime")),
        "arr": clock.scheduled_at(F.col("FlightDate"), F.col("CRSArrTime")),
    })


@query(f"""WITH {FLIGHTS} SELECT FlightNum, FlightDate, CAST(dayofyear(FlightDate) AS INT) AS DayOfYear,
    CAST(day(FlightDate) AS INT) AS DayOfMonth, CAST(isodow(FlightDate) AS INT) AS DayOfWeek FROM flights""")
def calendar_features(spark, folder):
    return features.calendar(b.flights(spark, folder, "FlightNum", "FlightDate"), "FlightDate")


@query(f"""WITH {b.OBSERVATIONS_SQL} SELECT station, event_id, strftime(observed_at, '%Y-%m-%d') AS "Date",
    strftime(observed_at, '%Y-%m-%dT%H:%M:00') AS "Datetime", value FROM observations""")
def normalize_observations(spark, folder):
    raw = b.observations(spark, folder).select(
        "station", "event_id", F.date_format("observed_at", "yyyyMMdd").alias("Date"),
        F.date_format("observed_at", "HHmm").alias("Time"), "value",
    )
    return weather.normalize(raw, "station", "Date", "Time", ["event_id", "value"])


@query(f"""WITH {b.STATIONS_SQL} SELECT WBAN_ID, STATION_NAME || ', ' || coalesce(COUNTY, '') || ', ' ||
    STATE_PROVINCE || ', ' || COUNTRY AS Address FROM stations""")
def compose_address(spark, folder):
    return _addresses(spark, folder).select("WBAN_ID", "Address")


def _addresses(spark, folder):
    parts = [(F.col(c), c == "COUNTY") for c in ("STATION_NAME", "COUNTY", "STATE_PROVINCE", "COUNTRY")]
    return b.stations(spark, folder).withColumn("Address", text.address(*parts))


_PARSED_SQL = """parsed AS (SELECT WBAN_ID, TRY_CAST(split_part(LOCATION, ',', 1) AS FLOAT) AS Latitude,
    TRY_CAST(split_part(LOCATION, ',', 2) AS FLOAT) AS Longitude FROM stations WHERE LOCATION IS NOT NULL)"""
_GAZETTEER_SQL = """gazetteer AS (SELECT STATION_NAME || ', ' || coalesce(COUNTY, '') || ', ' || STATE_PROVINCE
    || ', ' || COUNTRY AS Address, CAST(lat AS FLOAT) AS Latitude, CAST(lon AS FLOAT) AS Longitude
    FROM stations WHERE balance > 2000 AND STATE_PROVINCE IS NOT NULL)"""


@query(f"WITH {b.STATIONS_SQL}, {_PARSED_SQL} SELECT * FROM parsed WHERE Longitude IS NOT NULL")
def parse_lat_lon(spark, folder):
    return _parsed(spark, folder)


def _parsed(spark, folder):
    lat, lon = casting.lat_lon(F.col("LOCATION"))
    rows = b.stations(spark, folder).where("LOCATION IS NOT NULL")
    return rows.select("WBAN_ID", lat.alias("Latitude"), lon.alias("Longitude")).where("Longitude IS NOT NULL")


@query(f"""WITH {b.STATIONS_SQL}, {_GAZETTEER_SQL}, asked AS (SELECT WBAN_ID, STATION_NAME || ', ' ||
    coalesce(COUNTY, '') || ', ' || STATE_PROVINCE || ', ' || COUNTRY AS Address FROM stations)
    SELECT WBAN_ID, Address, Latitude, Longitude FROM asked LEFT JOIN gazetteer USING (Address)""")
def gazetteer_lookup(spark, folder):
    return _located(spark, folder)


def _located(spark, folder):
    addresses = _addresses(spark, folder)
    gazetteer = addresses.where("balance > 2000 AND Address IS NOT NULL").select(
        "Address", F.col("lat").cast("float").alias("Latitude"), F.col("lon").cast("float").alias("Longitude")
    )
    return located(addresses.select("WBAN_ID", "Address"), gazetteer, "Address", ["Latitude", "Longitude"])


@query(f"""WITH {b.STATIONS_SQL}, {_PARSED_SQL}, {_GAZETTEER_SQL}, asked AS (SELECT WBAN_ID, STATION_NAME || ', ' ||
    coalesce(COUNTY, '') || ', ' || STATE_PROVINCE || ', ' || COUNTRY AS Address FROM stations)
    SELECT WBAN_ID, Latitude, Longitude FROM asked JOIN gazetteer USING (Address)
    UNION SELECT * FROM parsed WHERE Longitude IS NOT NULL""")
def combined_locations(spark, folder):
    found = _located(spark, folder).where("Longitude IS NOT NULL").drop("Address")
    return found.unionByName(_parsed(spark, folder)).distinct()


_TWO_LABELS = ", ".join(f"'{s}'" for s in text.TWO_LABEL_SUFFIXES)
_HOST = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)', 1))"
_DOMAIN = f"""CASE WHEN array_to_string(string_split({_HOST}, '.')[-2:], '.') IN ({_TWO_LABELS})
    THEN array_to_string(string_split({_HOST}, '.')[-3:], '.')
    ELSE array_to_string(string_split({_HOST}, '.')[-2:], '.') END"""


@query(f"SELECT page_id, {_HOST} AS host, {_DOMAIN} AS domain FROM pages")
def url_domains(spark, folder):
    return pages.domains(b.table(spark, folder, "pages"), "page_id")


# Rules of the bound query: suffixes, one below any label, and an exception to it.
SUFFIX_RULES = ("com", "net", "org", "example.com", "*.example.net", "!ththth.example.net")


@query(rf"""WITH rules(rule) AS (VALUES {", ".join(f"('{r}')" for r in SUFFIX_RULES)}),
    hosts AS (SELECT page_id, {_HOST} AS host FROM pages),
    best AS (SELECT page_id, max(len(string_split(rule, '.')) + CASE WHEN rule LIKE '!%' THEN 999 ELSE 0 END) AS best
        FROM hosts JOIN rules ON regexp_matches(host,
            '^(.*\.)?' || replace(replace(replace(rule, '!', ''), '.', '\.'), '*', '[^.]+') || '$') GROUP BY page_id),
    cut AS (SELECT page_id, host, string_split(host, '.') AS labels, coalesce(CASE WHEN best > 900 THEN best - 1000 ELSE best END, 1) + 1 AS n
        FROM hosts LEFT JOIN best USING (page_id))
    SELECT page_id, host, CASE WHEN len(labels) >= n THEN array_to_string(labels[-n:], '.') END AS domain FROM cut""")
def url_domains_by_rules(spark, folder):
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    return domains_by_rules(b.table(spark, folder, "pages").select("page_id", "url"), "url", rules).drop("url")


def _plain_sql(fragment: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({fragment}, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), ' ')"


@query(rf"""SELECT page_id, {_plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
    regexp_extract(html, '(?is)<a\s[^>]*href="([^"]*)"', 1) AS first_link,
    {_plain_sql("regexp_extract(html, '(?is)<p(?:" + chr(92) + "s[^>]*)?>(.*?)</p>', 1)")} AS summary,
    {_DOMAIN} AS domain FROM pages""")
def page_records(spark, folder):
    return pages.head_records(b.table(spark, folder, "pages"), "page_id")


# The cells of a registry page that hold fields, and the columns they are filled from.
_PAGE_FIELDS = {
    "serial_number": "SerialNumber", "manufacturer": "Manufacturer", "model": "Model", "mfr_year": "ManufacturerYear", "owner": "Owner",
    "owner_state": "OwnerState", "engine_manufacturer": "EngineManufacturer", "engine_model": "EngineModel",
}
#: Pages that one task writes and reads.
PAGES = 20_000
#: Pages of airplanes of these years end within their last table.
_CUT_OFF = "CAST(ManufacturerYear AS INT) % 10 = 3"


def _registry_pages(spark, folder):
    """Saved pages as a registry shows its airplanes: tables of labels and values, fields by position."""
    at = {place: F.concat(F.lit("\n <b>"), F.col(_PAGE_FIELDS[name]), F.lit("</b> ")) for name, place in pages.REGISTRY_CELLS.items()}
    html = [F.lit("<html><body>")]
    for t in range(max(t for t, _ in at) + 1):
        html.append(F.lit(f'<TABLE class="t{t}"><tr>'))
        for c in range(max((c for s, c in at if s == t), default=0) + 1):
            html += [F.lit("<td>"), at.get((t, c), F.lit(f"label {c}")), F.lit("</td>")]
        html.append(F.lit("</tr></TABLE>"))
    page = F.concat(*html)
    cut = F.when(F.expr(_CUT_OFF), F.substring_index(page, "<td>", -5)).otherwise(page)
    airplanes = b.airplanes(spark, folder)
    # A file of airplanes is small, that of their pages is not: one task reads the first.
    parts = -(-airplanes.count() // PAGES) or 1
    saved = airplanes.repartition(parts, "TailNum").select("TailNum", cut.alias("html"))
    return writers.materialize(saved, workspace(spark, "registry-pages"))


@query(f"""WITH {b.AIRPLANES_SQL} SELECT TailNum, {', '.join(f'{c} AS {n}' for n, c in _PAGE_FIELDS.items())}
    FROM airplanes WHERE NOT {_CUT_OFF}""")
def registry_records(spark, folder):
    """Records of airplanes read back from their pages; incomplete pages give none."""
    return pages.table_records(_registry_pages(spark, folder), "TailNum")


@query(f"WITH {b.AIRPLANES_SQL} SELECT NOT {_CUT_OFF} AS complete, count(*) AS n FROM airplanes GROUP BY complete")
def registry_pages_complete(spark, folder):
    found = pages.table_records(_registry_pages(spark, folder), "TailNum", keep_incomplete=True)
    return summary.count_by(found, ["complete"])
