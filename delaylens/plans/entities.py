"""Joins, entity documents, name resolution, nearest neighbours, look-ups."""

import hashlib
from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from delaylens.functions.geodesy import ROUNDS, SEMI_MAJOR, SEMI_MINOR, FLATTENING, TOLERANCE
from delaylens.operators import documents, features, joins, lookup, resolve, search_index
from delaylens.operators.nearest_place import best_and_worst, nearest_place
from delaylens.operators.nearest_time import nearest_observation as nearest
from delaylens.operators.weather import flight_weather as weather_at_both_ends
from delaylens.plans import bindings as b
from delaylens.plans.registry import query
from delaylens.plans.summaries import FLIGHTS, SCHEDULED_SQL

# ---- joins


@query(f"""WITH {FLIGHTS}, {b.KNOWN_AIRPLANES_SQL}, t AS (SELECT DISTINCT TailNum FROM flights WHERE TailNum <> '')
    SELECT count(a.TailNum) AS hits, count(*) AS total, round(count(a.TailNum) / count(*) * 100, 2) AS pct_hits
    FROM t LEFT JOIN airplanes a USING (TailNum)""")
def join_coverage(spark, folder):
    tails = b.flights(spark, folder, "TailNum").where("TailNum <> ''").distinct()
    return joins.coverage(tails, b.known_airplanes(spark, folder), "TailNum")


@query(f"WITH {b.CARRIERS_SQL}, {FLIGHTS} SELECT DISTINCT Carrier, code, name FROM flights JOIN carriers USING (Carrier)")
def carrier_names(spark, folder):
    used = b.flights(spark, folder, "Carrier").distinct()
    return used.join(b.carriers(spark, folder), "Carrier")


@query(f"""WITH {FLIGHTS}, {b.AIRPLANES_SQL}, t AS (SELECT DISTINCT TailNum FROM flights)
    SELECT airplanes.* FROM airplanes JOIN t USING (TailNum)""")
def registered_airplanes(spark, folder):
    tails = b.flights(spark, folder, "TailNum").where("TailNum <> ''").distinct()
    return b.airplanes(spark, folder).join(tails, "TailNum")


@query(f"""WITH {FLIGHTS}, {b.AIRPORTS_SQL}, pairs AS (SELECT Airport, concat('S', Airport) AS Station FROM airports)
    SELECT FlightNum, Origin, Dest, o.Station AS Origin_Station, d.Station AS Dest_Station
    FROM flights JOIN pairs o ON Origin = o.Airport JOIN pairs d ON Dest = d.Airport""")
def origin_dest_stations(spark, folder):
    pairs = b.airports(spark, folder).select("Airport", F.concat(F.lit("S"), "Airport").alias("Station"))
    flights = b.flights(spark, folder, "FlightNum", "Origin", "Dest")
    ends = {"Origin": "Origin_Station", "Dest": "Dest_Station"}
    return joins.both_ends(flights, pairs, "Airport", "Station", ends)


@query(f"""WITH {b.REQUESTS_SQL}, {b.RESPONSES_SQL} SELECT UUID, Carrier, Origin, Dest,
    CASE WHEN r.UUID IS NULL THEN 'WAIT' ELSE 'OK' END AS status, Prediction
    FROM requests q LEFT JOIN responses r USING (UUID)""")
def request_status(spark, folder):
    requests = b.requests(spark, folder).select("UUID", "Carrier", "Origin", "Dest")
    return joins.with_status(requests, b.responses(spark, folder), "UUID", ["Prediction"])


@query(f"""WITH {FLIGHTS}, {b.REQUESTS_SQL}, d AS (SELECT Origin, Dest, avg(Distance) AS Distance FROM flights GROUP BY 1, 2)
    SELECT UUID, Carrier, Origin, Dest, FlightDate, DepDelay, Distance, CAST(dayofyear(FlightDate) AS INT) AS DayOfYear,
    CAST(day(FlightDate) AS INT) AS DayOfMonth, CAST(isodow(FlightDate) AS INT) AS DayOfWeek
    FROM requests LEFT JOIN d USING (Origin, Dest)""")
def enrich_requests(spark, folder):
    flights = b.flights(spark, folder, "Origin", "Dest", "Distance")
    distances = flights.groupBy("Origin", "Dest").agg(F.avg("Distance").alias("Distance"))
    requests = b.requests(spark, folder).select("UUID", "Carrier", "Origin", "Dest", "FlightDate", "DepDelay")
    return features.complete_requests(requests, distances)


# ---- documents


def _flights_by_airplane(spark, folder):
    items = ["FlightDate", "FlightNum", "Origin", "Dest", "Carrier"]
    flights = b.flights(spark, folder, "TailNum", *items)
    return documents.gather(flights, ["TailNum"], items, "flights")


_BY_AIRPLANE = f"""WITH {FLIGHTS} SELECT TailNum, CAST(row_number() OVER (PARTITION BY TailNum
    ORDER BY FlightDate, FlightNum, Origin, Dest, Carrier) AS BIGINT) AS position,
    FlightDate, FlightNum, Origin, Dest, Carrier FROM flights"""


@query(_BY_AIRPLANE)
def flights_per_airplane(spark, folder):
    return documents.unfold(_flights_by_airplane(spark, folder), ["TailNum"], "flights")


@query(_BY_AIRPLANE + " WHERE TailNum = 'N7'")
def airplane_flights(spark, folder):
    items = ["FlightDate", "FlightNum", "Origin", "Dest", "Carrier"]
    flights = lookup.matching(b.flights(spark, folder, "TailNum", *items), {"TailNum": "N7"})
    return documents.unfold(documents.gather(flights, ["TailNum"], items, "flights"), ["TailNum"], "flights")


_FLEETS = f"""WITH {FLIGHTS}, {b.CARRIERS_SQL}, p AS (SELECT DISTINCT Carrier, TailNum FROM flights),
    c AS (SELECT Carrier, count(*) FILTER (TailNum <> '') AS fleet_count, count(*) AS raw_count FROM p GROUP BY Carrier)"""


@query(f"""{_FLEETS} SELECT Carrier, CAST(row_number() OVER (PARTITION BY Carrier ORDER BY TailNum) AS BIGINT) AS position,
    TailNum, fleet_count, raw_count FROM p JOIN c USING (Carrier) WHERE TailNum <> ''""")
def fleet_per_carrier(spark, folder):
    fleets = documents.fleets(b.flights(spark, folder, "Carrier", "TailNum"))
    at = F.col("part") * documents.PART_SIZE + F.col("at") + 1
    return fleets.select("*", F.posexplode("members").alias("at", "TailNum")).select(
        "Carrier", at.cast("bigint").alias("position"), "TailNum", "fleet_count", "raw_count"
    )


def _airline_page(size: int) -> str:
    """The SQL for fleets in parts of ``size`` members."""
    return f"""{_FLEETS}, n AS (SELECT *, row_number() OVER (PARTITION BY Carrier ORDER BY TailNum) AS i FROM p WHERE TailNum <> ''),
        f AS (SELECT Carrier, CAST((i - 1) // {size} AS BIGINT) AS part, string_agg(TailNum, ' ' ORDER BY TailNum) AS fleet
            FROM n GROUP BY 1, 2)
        SELECT Carrier, code, name, coalesce(part, 0) AS part, fleet_count, raw_count, fleet
        FROM c LEFT JOIN f USING (Carrier) LEFT JOIN carriers USING (Carrier)"""


@query(_airline_page(documents.PART_SIZE))
def airline_page(spark, folder):
    return _page(spark, folder, documents.PART_SIZE)


@query(_airline_page(10))
def airline_page_in_parts(spark, folder):
    return _page(spark, folder, 10)


def _page(spark, folder, size):
    fleets = documents.fleets(b.flights(spark, folder, "Carrier", "TailNum"), part_size=size)
    page = lookup.carrier_page(fleets, b.carriers(spark, folder))
    return page.select(
        "Carrier", "code", "name", "part", "fleet_count", "raw_count", F.array_join("members", " ").alias("fleet")
    )


def _titles(size: int) -> str:
    return f"""WITH n AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY role) AS i FROM conversations)
        SELECT conv_id, CAST((i - 1) // {size} AS BIGINT) AS part, string_agg(role, ', ' ORDER BY role) AS titles
        FROM n GROUP BY 1, 2"""


@query(_titles(documents.PART_SIZE))
def concat_titles(spark, folder):
    rows = b.table(spark, folder, "conversations").select("conv_id", "role")
    return documents.joined_texts(rows, "conv_id", "role", "titles")


@query(_titles(2))
def concat_titles_in_parts(spark, folder):
    rows = b.table(spark, folder, "conversations").select("conv_id", "role")
    return documents.joined_texts(rows, "conv_id", "role", "titles", part_size=2)


_BY_DAY = """SELECT station, CAST(observed_at AS DATE) AS date, CAST(row_number() OVER (PARTITION BY station,
    CAST(observed_at AS DATE) ORDER BY observed_at, event_id) AS BIGINT) AS position, observed_at, event_id, value
    FROM observations"""


def _by_day(spark, folder):
    rows = b.observations(spark, folder)
    return documents.observations_by_day(rows, "station", "observed_at", ["event_id", "value"])


@query(f"WITH {b.OBSERVATIONS_SQL} {_BY_DAY}")
def observations_per_day(spark, folder):
    return documents.unfold(_by_day(spark, folder), ["station", "date"], "observations")


@query(f"WITH {b.OBSERVATIONS_SQL}, d AS ({_BY_DAY}) SELECT * FROM d WHERE station = 8 AND date = DATE '2024-01-02'")
def station_day_lookup(spark, folder):
    rows = b.observations(spark, folder)
    from delaylens.sources.readers import day_slice

    day = lookup.matching(day_slice(rows, "observed_at", "2024-01-02"), {"station": 8})
    docs = documents.observations_by_day(day, "station", "observed_at", ["event_id", "value"])
    return documents.unfold(docs, ["station", "date"], "observations")


@query(f"""WITH {b.OBSERVATIONS_SQL}, {b.STATIONS_SQL} SELECT station, CAST(observed_at AS DATE) AS date, STATION_NAME AS name,
    COUNTRY AS country, LOCATION AS location, observed_at, event_id, value FROM observations JOIN stations ON station = WBAN_ID""")
def station_day_profile(spark, folder):
    profiles = b.stations(spark, folder).withColumnRenamed("WBAN_ID", "station")
    fields = ["STATION_NAME", "COUNTRY", "LOCATION"]
    joined = documents.with_profile(_by_day(spark, folder), profiles, "station", fields)
    return joined.select("station", "date", "part", "profile", F.explode("observations").alias("o")).select(
        "station", "date", F.col("profile.STATION_NAME").alias("name"), F.col("profile.COUNTRY").alias("country"),
        F.col("profile.LOCATION").alias("location"), "o.observed_at", "o.event_id", "o.value",
    )


# ---- names

_PAIRS = r"""names AS (SELECT DISTINCT Manufacturer AS name FROM airplanes WHERE Manufacturer IS NOT NULL),
    ends AS (SELECT a.name AS name, (SELECT max(i) FROM range(1, 100) t(i) WHERE i <= least(length(a.name), length(b.name))
        AND left(a.name, i) = left(b.name, i)) AS n FROM names a JOIN names b ON a.name <> b.name),
    pairs AS (SELECT DISTINCT name, trim(left(name, n), ' \t\n\r') AS beginning FROM ends WHERE n IS NOT NULL)"""


@query(f"WITH {b.AIRPLANES_SQL}, {_PAIRS} SELECT * FROM pairs WHERE length(beginning) > 5")
def lcp_pairs(spark, folder):
    return resolve.shared_beginnings(b.airplanes(spark, folder), "Manufacturer")


@query(f"""WITH {b.AIRPLANES_SQL}, {_PAIRS}, m AS (SELECT name, first(beginning ORDER BY length(beginning), beginning)
    AS resolved FROM pairs WHERE length(beginning) > 5 GROUP BY name)
    SELECT airplanes.* REPLACE (coalesce(resolved, Manufacturer) AS Manufacturer)
    FROM airplanes LEFT JOIN m ON Manufacturer = name""")
def resolve_names(spark, folder):
    return resolve.resolve_names(b.airplanes(spark, folder), "Manufacturer")


# ---- nearest in space

# Vincenty's inverse formula over all pairs; the operator does not compare all pairs.
_VINCENTY = f"""pairs AS (SELECT a.Airport, s.WBAN_ID, a.lat AS lat1, a.lon AS lon1, s.lat AS lat2, s.lon AS lon2,
        atan((1 - {FLATTENING}) * tan(radians(a.lat))) AS u1, atan((1 - {FLATTENING}) * tan(radians(s.lat))) AS u2,
        radians(s.lon - a.lon) AS l FROM airports a, stations s),
    walk AS (SELECT *, 0 AS k, l AS lam, CAST(1 AS DOUBLE) AS step FROM pairs UNION ALL
        SELECT Airport, WBAN_ID, lat1, lon1, lat2, lon2, u1, u2, l, k + 1, next, abs(next - lam) FROM (SELECT *,
            l + (1 - c) * {FLATTENING} * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))) AS next FROM (SELECT *,
            {FLATTENING} / 16 * ca * (4 + {FLATTENING} * (4 - 3 * ca)) AS c FROM (SELECT *,
            coalesce(cs - 2 * sin(u1) * sin(u2) / nullif(ca, 0), 0) AS cm FROM (SELECT *, 1 - sa * sa AS ca FROM (SELECT *,
            atan2(ss, cs) AS sg, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(ss, 0), 0) AS sa FROM (SELECT *,
            sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
            sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM walk WHERE k < {ROUNDS}))))))),
    arcs AS (SELECT *, ca * {(SEMI_MAJOR**2 - SEMI_MINOR**2) / SEMI_MINOR**2} AS q FROM (SELECT *,
            coalesce(cs - 2 * sin(u1) * sin(u2) / nullif(ca, 0), 0) AS cm FROM (SELECT *, 1 - sa * sa AS ca FROM (SELECT *,
            atan2(ss, cs) AS sg, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(ss, 0), 0) AS sa FROM (SELECT *,
            sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
            sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM walk WHERE k = {ROUNDS}))))),
    terms AS (SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS ta,
            q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS tb FROM arcs),
    miles AS (SELECT Airport, WBAN_ID, coalesce(CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0 WHEN step <= {TOLERANCE}
        THEN round_even({SEMI_MINOR} * ta * (sg - tb * ss * (cm + tb / 4 * (cs * (2 * cm * cm - 1)
            - tb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) / 1609.344, 0) END, 24902) AS distance FROM terms),
    closest AS (SELECT Airport, first(WBAN_ID ORDER BY distance, WBAN_ID) AS WBAN_ID,
        CAST(min(distance) AS BIGINT) AS distance FROM miles GROUP BY Airport)"""
_CLOSEST = f"WITH RECURSIVE {b.AIRPORTS_SQL}, {b.STATIONS_SQL}, {_VINCENTY}"


def _closest(spark, folder):
    return nearest_place(b.airports(spark, folder), b.stations(spark, folder), "Airport", "WBAN_ID")


@query(f"{_CLOSEST} SELECT * FROM closest")
def nearest_station(spark, folder):
    return _closest(spark, folder)


@query(f"""{_CLOSEST} SELECT * FROM (SELECT *, 'best' AS side FROM closest ORDER BY distance, Airport LIMIT 10)
    UNION ALL SELECT * FROM (SELECT *, 'worst' AS side FROM closest ORDER BY distance DESC, Airport LIMIT 10)""")
def best_worst_matches(spark, folder):
    return best_and_worst(_closest(spark, folder), "distance", "Airport", 10)


# ---- nearest in time

_SAME_DAY = """FROM departures d JOIN observations o
    ON d.station = o.station AND CAST(d.departs AS DATE) = CAST(o.observed_at AS DATE)"""


@query(f"""WITH {b.VIEWS_SQL}, {b.DEPARTURES_SQL} SELECT flight_id, d.station AS station, departs, observed_at, event_id, value
    {_SAME_DAY} QUALIFY row_number() OVER (PARTITION BY flight_id
    ORDER BY abs(epoch_us(departs) - epoch_us(observed_at)), observed_at, event_id) = 1""")
def nearest_observation(spark, folder):
    return _observed(spark, folder, "nearest")


@query(f"""WITH {b.VIEWS_SQL}, {b.DEPARTURES_SQL} SELECT flight_id, d.station AS station, departs, observed_at, event_id, value
    {_SAME_DAY} QUALIFY row_number() OVER (PARTITION BY flight_id ORDER BY observed_at DESC, event_id) = 1""")
def last_observation_of_day(spark, folder):
    return _observed(spark, folder, "last")


def _observed(spark, folder, mode):
    matched = nearest(
        b.departures(spark, folder), b.views(spark, folder), station="station", at="departs",
        observed_station="station", observed_at="observed_at", measures=["event_id", "value"], mode=mode,
    )
    return matched.select(
        "flight_id", "station", "departs", F.col("observation.at").alias("observed_at"),
        F.col("observation.event_id").alias("event_id"), F.col("observation.value").alias("value"),
    )


# Airports have as many stations as there are kinds of events; their clock is moved to the flights' years.
_WEATHER_SQL = f"""weather AS (SELECT concat('NATION_', CAST(user_id % 25 AS {{text}})) AS WBAN, {{at}} AS Datetime,
    event_id, value FROM events)"""


def _weather(spark, folder):
    rows = b.table(spark, folder, "events")
    return rows.select(
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("WBAN"),
        (F.col("ts") - F.expr("INTERVAL 26 YEAR")).alias("Datetime"), "event_id", "value",
    )


@query(f"""WITH {FLIGHTS}, {SCHEDULED_SQL}, {_WEATHER_SQL.format(text='VARCHAR', at='ts - INTERVAL 26 YEAR')},
    f AS (SELECT FlightNum, FlightDate, Origin, Dest, dep, CASE WHEN CAST(arr AS TIME) < CAST(dep AS TIME)
          THEN arr + INTERVAL 1 DAY ELSE arr END AS arr FROM scheduled),
    o AS (SELECT *, CAST(Datetime AS DATE) AS day FROM weather),
    probes AS (SELECT Origin AS place, dep AS departs FROM f UNION SELECT Dest, arr FROM f),
    best AS (SELECT place, departs, first(event_id ORDER BY abs(epoch_us(departs) - epoch_us(Datetime)), Datetime, event_id) AS event_id
        FROM probes JOIN o ON place = WBAN AND CAST(departs AS DATE) = day GROUP BY place, departs)
    SELECT FlightNum, Origin, Dest, dep, arr, d.event_id AS dep_event, a.event_id AS arr_event FROM f
    JOIN best d ON Origin = d.place AND dep = d.departs JOIN best a ON Dest = a.place AND arr = a.departs""")
def flight_weather(spark, folder):
    flights = b.flights(spark, folder, "FlightNum", "FlightDate", "Origin", "Dest", "CRSDepTime", "CRSArrTime")
    stations = b.airports(spark, folder).select("Airport", F.col("Airport").alias("WBAN_ID"))
    matched = weather_at_both_ends(flights, stations, _weather(spark, folder), ["event_id", "value"])
    return matched.select(
        "FlightNum", "Origin", "Dest", F.col("CRSDepDatetime").alias("dep"), F.col("CRSArrDatetime").alias("arr"),
        F.col("DepObservation.event_id").alias("dep_event"), F.col("ArrObservation.event_id").alias("arr_event"),
    )


# ---- look-ups


@query(f"WITH {FLIGHTS} SELECT count(*) AS n, count(DISTINCT Origin) AS origins FROM flights")
def publish_flights(spark, folder):
    """Store the table that look-ups read."""
    flights = b.published_flights(spark, folder, "Origin")
    return flights.agg(F.count("*").alias("n"), F.countDistinct("Origin").alias("origins"))


_ROW = ["FlightDate", "CRSDepTime", "CRSArrTime", "Carrier", "FlightNum", "Origin", "Dest", "TailNum", "DepDelay"]
# The last columns settle ties between otherwise equal flights.
_TIES = ["CRSDepTime", "CRSArrTime", "Carrier", "FlightNum", "TailNum", "DepDelay", "Origin", "Dest"]
_SQL_TIES = ", ".join(f"{c} NULLS FIRST" for c in _TIES)


# Flights and route days that exist at one of the scales each.
_FLIGHTS_ASKED = (("2000-04-08", "8"), ("1995-06-20", "8"), ("1997-11-04", "8"))
_ROUTE_DAYS = (
    ("NATION_8", "NATION_17", "2000-01-15"), ("NATION_6", "NATION_16", "2001-05-27"),
    ("NATION_5", "NATION_16", "1999-07-15"),
)


@query(f"WITH {FLIGHTS} " + " UNION ALL ".join(f"""(SELECT {', '.join(_ROW)} FROM flights WHERE Carrier = '5-LOW'
    AND FlightDate = DATE '{day}' AND FlightNum = '{number}' ORDER BY {_SQL_TIES} LIMIT 1)""" for day, number in _FLIGHTS_ASKED))
def flight_lookup(spark, folder):
    flights = b.published_flights(spark, folder, *_ROW)
    found = [
        lookup.one(flights, {"Carrier": "5-LOW", "FlightDate": date.fromisoformat(day), "FlightNum": number}, _TIES)
        for day, number in _FLIGHTS_ASKED
    ]
    return reduce(lambda a, b: a.unionByName(b), found)


@query(f"WITH {FLIGHTS} " + " UNION ALL ".join(f"""(SELECT {', '.join(_ROW)}, count(*) OVER () AS total FROM flights
    WHERE Origin = '{origin}' AND Dest = '{dest}' AND FlightDate = DATE '{day}' ORDER BY {_SQL_TIES} LIMIT 20)"""
    for origin, dest, day in _ROUTE_DAYS))
def route_day_page(spark, folder):
    """First pages of the flights of a route on a day, by departure and arrival time."""
    flights = b.published_flights(spark, folder, *_ROW)
    pages = [
        lookup.search(flights, {"Origin": origin, "Dest": dest, "FlightDate": date.fromisoformat(day)}, _TIES)
        for origin, dest, day in _ROUTE_DAYS
    ]
    return reduce(lambda a, b: a.unionByName(b), pages)


@query(f"""WITH {FLIGHTS}, f AS (SELECT {', '.join(_ROW)} FROM flights WHERE Carrier = '1-URGENT' AND Origin = 'NATION_3')
    SELECT *, (SELECT count(*) FROM f) AS total FROM f
    ORDER BY FlightDate, {_SQL_TIES} LIMIT 20""")
def search_flights(spark, folder):
    values = {"Carrier": "1-URGENT", "Origin": "NATION_3", "Dest": "", "TailNum": None}
    return search_index.search(b.indexed_flights(spark, folder), values).select(*_ROW, "total")


@query(rf"""WITH {b.AIRPLANES_SQL}, f AS (SELECT * FROM airplanes
    WHERE list_has_any(regexp_split_to_array(lower(Owner), '\W+'), ['small', 'blue'])
    AND list_has_any(regexp_split_to_array(lower(Manufacturer), '\W+'), ['brand', '7']))
    SELECT *, (SELECT count(*) FROM f) AS total FROM f ORDER BY Owner, TailNum LIMIT 20""")
def search_airplanes(spark, folder):
    words = {"Owner": "Small blue", "Manufacturer": "brand#7", "Model": None}
    return search_index.search(b.indexed_airplanes(spark, folder), words)


@query(rf"""WITH {b.AIRPLANES_SQL}, f AS (SELECT * FROM airplanes
    WHERE list_has_all(regexp_split_to_array(lower(Owner), '\W+'), ['blue', 'ring'])
    AND list_has_all(regexp_split_to_array(lower(Manufacturer), '\W+'), ['brand', '7']))
    SELECT *, (SELECT count(*) FROM f) AS total FROM f ORDER BY Owner, TailNum LIMIT 20""")
def search_airplanes_all_words(spark, folder):
    """The same search for airplanes that have every word asked for."""
    words = {"Owner": "Ring, blue", "Manufacturer": "brand#7", "Model": None}
    return search_index.search(b.indexed_airplanes(spark, folder), words, every=True)


@query(f"""WITH {FLIGHTS}, t AS (SELECT unnest([struct_pack(field := 'Carrier', token := Carrier), struct_pack(field := 'Origin', token := Origin),
    struct_pack(field := 'Dest', token := Dest), struct_pack(field := 'TailNum', token := TailNum),
    struct_pack(field := 'FlightDate', token := CAST(FlightDate AS VARCHAR))]) AS t FROM flights),
    c AS (SELECT t.field AS field, t.token AS token, count(*) AS n FROM t WHERE t.token <> '' GROUP BY ALL)
    SELECT field, count(*) AS tokens, CAST(sum(n) AS BIGINT) AS listed, max(n) AS most FROM c GROUP BY field""")
def index_flights(spark, folder):
    """Build the search index of the flights: lists of each field, and the longest of them."""
    terms = b.indexed_flights(spark, folder).terms
    return terms.groupBy("field").agg(F.count("*").alias("tokens"), F.sum("frequency").alias("listed"), F.max("frequency").alias("most"))


@query(rf"""WITH {b.AIRPLANES_SQL}, t AS (SELECT 'Owner' AS field, unnest(list_distinct(regexp_split_to_array(lower(Owner), '\W+'))) AS token FROM airplanes
    UNION ALL SELECT 'Manufacturer', unnest(list_distinct(regexp_split_to_array(lower(Manufacturer), '\W+'))) FROM airplanes
    UNION ALL SELECT 'Model', unnest(list_distinct(regexp_split_to_array(lower(Model), '\W+'))) FROM airplanes)
    SELECT field, token, count(*) AS frequency FROM t WHERE token <> '' GROUP BY ALL""")
def index_airplanes(spark, folder):
    """Build the search index of the airplanes: how many hold each word of each field."""
    return b.indexed_airplanes(spark, folder).terms


# Requests asked for by id, more than one pass takes; some exist at the larger scales only, and one nowhere.
_ASKED = tuple(hashlib.md5(text.encode()).hexdigest() for text in (*map(str, range(3, 5000, 431)), "none"))


@query(f"""WITH {b.REQUESTS_SQL}, asked AS (SELECT * REPLACE (md5(UUID) AS UUID) FROM requests)
    SELECT UUID, Carrier, FlightDate, Origin, Dest FROM asked WHERE UUID IN ({', '.join(f"'{i}'" for i in _ASKED)})""")
def requests_by_id(spark, folder):
    """Requests by ids that are random in the order of the table: Bloom filters of its row groups say where to look."""
    found = lookup.by_ids(b.requests_by_id(spark, folder), "UUID", _ASKED)
    return found.select("UUID", "Carrier", "FlightDate", "Origin", "Dest")


@query(f"WITH {FLIGHTS} SELECT {', '.join(_ROW)} FROM flights WHERE TailNum IN ('N3', 'N77', 'N0')")
def flights_by_tail(spark, folder):
    """Flights of some airplanes, from a table in order of day."""
    return lookup.by_ids(b.flights_by_tail(spark, folder), "TailNum", ("N3", "N77", "N0")).select(*_ROW)
