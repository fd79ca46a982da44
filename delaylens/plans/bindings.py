"""The roles of the operators' inputs, derived from the given tables, in Spark and in SQL.

``flights`` is lineitem with its order, customer and supplier. A caller names the columns it
needs. Contract: every foreign key matches exactly one row, so tables that contribute no column
are not joined; a test compares this with the full join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.operators import search_index
from delaylens.operators.features import calendar
from delaylens.operators.search_index import Index
from delaylens.session import shared_folder
from delaylens.sources.writers import publish, publish_by_id, to_json_rows

# The carriers, by the order in which requests are assigned to them.
CARRIERS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
CAUSES = ("CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")
CAUSE_ORDER = ("WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_DEP = "(l_partkey * 7 + l_suppkey * 3 + CAST(l_quantity AS BIGINT)) % 120 - 30"
_DEP_DELAY = f"CASE WHEN l_linenumber <> 7 THEN CAST({_DEP} AS DOUBLE) END"
_ARR_DELAY = f"CASE WHEN l_linenumber <> 7 THEN CAST({_DEP} + l_orderkey % 41 - 20 AS DOUBLE) END"


def _late(delay: str) -> str:
    return f"CASE WHEN {delay} > 0 THEN {delay} WHEN {delay} <= 0 THEN CAST(0 AS DOUBLE) END"


def _cause(number: int) -> str:
    share = f"CASE WHEN l_orderkey % 5 = {number} THEN {_ARR_DELAY} ELSE CAST(0 AS DOUBLE) END"
    return f"CASE WHEN {_ARR_DELAY} >= 15 THEN {share} END"


def _two(expression: str, text: str) -> str:
    return f"lpad(CAST({expression} AS {text}), 2, '0')"


def flight_columns(text: str, iso_dow: str) -> dict[str, str]:
    """Definition of every flight column; only the text type and the weekday differ by engine."""
    columns = {
        "FlightNum": f"CAST(l_orderkey AS {text})",
        "FlightDate": "CAST(o_orderdate AS DATE)",
        "Year": "CAST(year(o_orderdate) AS INT)",
        "Month": "CAST(month(o_orderdate) AS INT)",
        "DayofMonth": "CAST(day(o_orderdate) AS INT)",
        "DayOfWeek": f"CAST({iso_dow} AS INT)",
        "Carrier": "o_orderpriority",
        "TailNum": (
            "CASE WHEN l_suppkey % 13 = 0 THEN '' WHEN l_suppkey % 17 <> 0 "
            f"THEN concat('N', CAST(l_suppkey AS {text})) END"
        ),
        "Origin": "so_name",
        "Dest": "cu_name",
        "Distance": "CAST(abs(so_key - cu_key) * 100 + 50 AS DOUBLE)",
        "DepDelay": _DEP_DELAY,
        "ArrDelay": _ARR_DELAY,
        "DepDelayMinutes": _late(_DEP_DELAY),
        "ArrDelayMinutes": _late(_ARR_DELAY),
        "CRSDepTime": f"concat({_two('l_partkey % 25', text)}, {_two('l_suppkey * 7 % 60', text)})",
        "CRSArrTime": (
            f"concat({_two('(l_partkey + CAST(l_quantity AS BIGINT)) % 25', text)}, "
            f"{_two('l_orderkey % 60', text)})"
        ),
    }
    columns.update({name: _cause(i) for i, name in enumerate(CAUSE_ORDER)})
    return columns


_FROM_ORDERS = {"FlightDate", "Year", "Month", "DayofMonth", "DayOfWeek", "Carrier"}
_FROM_CUSTOMER = {"Dest", "Distance"}
_FROM_SUPPLIER = {"Origin", "Distance"}


def _flight_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The joined rows that the definitions of these columns read."""
    wanted = set(columns)
    rows = table(spark, folder, "lineitem")
    nation = table(spark, folder, "nation")
    if wanted & (_FROM_ORDERS | _FROM_CUSTOMER):
        orders = table(spark, folder, "orders")
        if wanted & _FROM_CUSTOMER:
            home = nation.select(F.col("n_nationkey").alias("cu_key"), F.col("n_name").alias("cu_name"))
            buyers = table(spark, folder, "customer").join(home, F.col("c_nationkey") == F.col("cu_key"))
            orders = orders.join(
                buyers.select("c_custkey", "cu_key", "cu_name"), F.col("o_custkey") == F.col("c_custkey")
            )
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if wanted & _FROM_SUPPLIER:
        base = nation.select(F.col("n_nationkey").alias("so_key"), F.col("n_name").alias("so_name"))
        sellers = table(spark, folder, "supplier").join(base, F.col("s_nationkey") == F.col("so_key"))
        rows = rows.join(
            sellers.select("s_suppkey", "so_key", "so_name"), F.col("l_suppkey") == F.col("s_suppkey")
        )
    return rows


def _definitions(*columns: str) -> dict[str, Column]:
    definitions = flight_columns("STRING", "weekday(o_orderdate) + 1")
    return {c: F.expr(definitions[c]) for c in columns}


def flights(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    rows = _flight_rows(spark, folder, *columns)
    return rows.select(*[e.alias(c) for c, e in _definitions(*columns).items()])


def stored_path(spark: SparkSession, folder: str, name: str) -> str:
    """Where something made from the flights of this application is stored.

    The path names the number of rows and sums over keys: other tables have another place.
    """
    lines = table(spark, folder, "lineitem").agg(F.count("*"), F.sum("l_orderkey"), F.sum("l_suppkey")).first()
    orders = table(spark, folder, "orders").agg(F.count("*"), F.sum("o_custkey")).first()
    stamp = "-".join(str(value) for value in (*lines, *orders))
    return f"{shared_folder(spark).rstrip('/')}/stored/{spark.sparkContext.applicationId}/{name}-{stamp}"


def published_flights(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Flights as the table that look-ups read: stored once, clustered by route and carrier."""
    path = stored_path(spark, folder, "flights")
    try:
        return spark.read.parquet(path).select(*columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    rows = _flight_rows(spark, folder, *LOOKED_UP).select(*_LOOKED_UP_FROM)
    publish(rows, path, ["Origin", "Dest", "Carrier", "FlightDate"], mode="overwrite", columns=_definitions(*LOOKED_UP))
    return spark.read.parquet(path).select(*columns)


def _by_id(spark: SparkSession, folder: str, name: str, sources: tuple[str, ...], make: Callable[[], DataFrame], ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows that ``make`` gives, stored once by an application for the same files, with Bloom filters of ids."""
    path = f"{shared_folder(spark).rstrip('/')}/stored/{spark.sparkContext.applicationId}/{name}-{table_stamp(spark, folder, *sources)}"
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    publish_by_id(make(), path, ids, order, mode="overwrite")
    return spark.read.parquet(path)


def requests_by_id(spark: SparkSession, folder: str) -> DataFrame:
    """Requests in order of time, to be found by an id that says nothing of it."""
    make = lambda: requests(spark, folder).withColumn("UUID", F.md5("UUID"))
    return _by_id(spark, folder, "requests-by-id", ("events",), make, ["UUID"], ["Timestamp"])


def flights_by_tail(spark: SparkSession, folder: str) -> DataFrame:
    """Flights in order of day, to be found by airplane."""
    sources = ("lineitem", "orders", "customer", "supplier", "nation")
    return _by_id(spark, folder, "flights-by-tail", sources, lambda: flights(spark, folder, *LOOKED_UP), ["TailNum"], ["FlightDate"])


def table_stamp(spark: SparkSession, folder: str, *names: str) -> str:
    """Changes with the files of the tables: their bytes, number and time, from the file system."""
    parts = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        held, status = files.getContentSummary(path), files.getFileStatus(path)
        parts.append(f"{folder}/{name}:{held.getLength()}:{held.getFileCount()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


#: Indexes of this application that are open.
_OPEN: dict[str, Index] = {}


def _indexed(spark: SparkSession, folder: str, name: str, sources: tuple[str, ...], make: Callable[[], DataFrame], order: Sequence[str], **fields) -> Index:
    """The search index of the rows that ``make`` gives, built once by an application for the same files."""
    stamp = table_stamp(spark, folder, *sources)
    path = f"{shared_folder(spark).rstrip('/')}/stored/{spark.sparkContext.applicationId}/{name}-{stamp}"
    if path not in _OPEN:
        _OPEN[path] = search_index.build(make(), path, order, **fields)
    return _OPEN[path]


#: The order of found flights; its last columns settle ties between otherwise equal ones.
FLIGHT_ORDER = ("FlightDate", "CRSDepTime", "CRSArrTime", "Carrier", "FlightNum", "TailNum", "DepDelay", "Origin", "Dest")


def indexed_flights(spark: SparkSession, folder: str) -> Index:
    """Flights by carrier, airports, airplane and day."""
    sources = ("lineitem", "orders", "customer", "supplier", "nation")
    values = ("Carrier", "Origin", "Dest", "TailNum", "FlightDate")
    return _indexed(spark, folder, "flight-index", sources, lambda: flights(spark, folder, *LOOKED_UP), FLIGHT_ORDER, values=values)


def indexed_airplanes(spark: SparkSession, folder: str) -> Index:
    """Airplanes by the words of their owners, manufacturers and models."""
    words = ("Owner", "Manufacturer", "Model")
    return _indexed(spark, folder, "airplane-index", ("part",), lambda: airplanes(spark, folder), ("Owner", "TailNum"), words=words)


LOOKED_UP = (
    "FlightDate", "CRSDepTime", "CRSArrTime", "Carrier", "FlightNum", "Origin", "Dest", "TailNum", "DepDelay",
)
#: What their definitions read.
_LOOKED_UP_FROM = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "o_orderdate", "o_orderpriority", "so_name", "cu_name",
)


def flights_sql() -> str:
    columns = flight_columns("VARCHAR", "isodow(o_orderdate)")
    listed = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"""flights AS (SELECT {listed} FROM (
        SELECT l.*, o.*, so.n_name AS so_name, cu.n_name AS cu_name,
               so.n_nationkey AS so_key, cu.n_nationkey AS cu_key
        FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation so ON s_nationkey = so.n_nationkey
        JOIN nation cu ON c_nationkey = cu.n_nationkey))"""


# Registry of airplanes: parts.
_AIRPLANES = """
    concat('N', CAST(p_partkey AS {text})) AS TailNum, p_brand AS Manufacturer, p_type AS Model,
    p_name AS Owner, CAST(p_size AS {text}) AS ManufacturerYear,
    concat('Engine ', p_type) AS EngineManufacturer, concat('E-', CAST(p_size AS {text})) AS EngineModel,
    CASE WHEN p_retailprice > 1000 THEN 'CA' ELSE 'TX' END AS OwnerState,
    concat('SN', CAST(p_partkey AS {text})) AS SerialNumber"""


def airplanes(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return parts.select(F.expr(f"struct({_AIRPLANES.format(text='STRING')})").alias("a")).select("a.*")


AIRPLANES_SQL = f"airplanes AS (SELECT {_AIRPLANES.format(text='VARCHAR')} FROM part)"


def known_airplanes(spark: SparkSession, folder: str) -> DataFrame:
    """A registry that lacks the parts of small size, for joins that must meet unknown airplanes."""
    return airplanes(spark, folder).where("CAST(ManufacturerYear AS INT) > 10")


KNOWN_AIRPLANES_SQL = AIRPLANES_SQL.replace("FROM part)", "FROM part WHERE p_size > 10)")


def carriers(spark: SparkSession, folder: str) -> DataFrame:
    """Known carriers (code, name) from the order priorities."""
    codes = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("Carrier")).distinct()
    return codes.select(
        "Carrier", F.substring_index("Carrier", "-", 1).alias("code"),
        F.expr("substring(Carrier, instr(Carrier, '-') + 1)").alias("name"),
    )


CARRIERS_SQL = """carriers AS (SELECT DISTINCT o_orderpriority AS Carrier,
    split_part(o_orderpriority, '-', 1) AS code,
    substr(o_orderpriority, instr(o_orderpriority, '-') + 1) AS name FROM orders)"""


def airports(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "n_name AS Airport", "CAST(n_nationkey * 37 % 120 - 60 AS DOUBLE) AS lat",
        "CAST(n_nationkey * 53 % 300 - 150 AS DOUBLE) AS lon",
    )


AIRPORTS_SQL = """airports AS (SELECT n_name AS Airport,
    CAST(n_nationkey * 37 % 120 - 60 AS DOUBLE) AS lat,
    CAST(n_nationkey * 53 % 300 - 150 AS DOUBLE) AS lon FROM nation)"""

_LAT, _LON = "s_suppkey * 29 % 120 - 60", "s_suppkey * 71 % 300 - 150"
_LOCATION = (
    "CASE WHEN s_suppkey % 7 = 0 THEN 'UNKNOWN' WHEN s_suppkey % 11 <> 0 "
    f"THEN concat(CAST({_LAT} AS {{text}}), ',', CAST({_LON} AS {{text}})) END"
)


def stations(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, folder, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "s_suppkey AS WBAN_ID", "s_name AS STATION_NAME",
            "CASE WHEN s_acctbal > 5000 THEN r_name END AS COUNTY",
            "nullif(n_name, 'NATION_3') AS STATE_PROVINCE", "r_name AS COUNTRY",
            f"{_LOCATION.format(text='STRING')} AS LOCATION",
            f"CAST({_LAT} AS DOUBLE) AS lat", f"CAST({_LON} AS DOUBLE) AS lon",
            "s_acctbal AS balance",
        )
    )


STATIONS_SQL = f"""stations AS (SELECT s_suppkey AS WBAN_ID, s_name AS STATION_NAME,
    CASE WHEN s_acctbal > 5000 THEN r_name END AS COUNTY,
    nullif(n_name, 'NATION_3') AS STATE_PROVINCE, r_name AS COUNTRY,
    {_LOCATION.format(text='VARCHAR')} AS LOCATION,
    CAST({_LAT} AS DOUBLE) AS lat, CAST({_LON} AS DOUBLE) AS lon, s_acctbal AS balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def observations(spark: SparkSession, folder: str) -> DataFrame:
    return _observed(table(spark, folder, "events"))


def _observed(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("station"), F.col("ts").alias("observed_at"), "event_id", "value"
    )


OBSERVATIONS_SQL = """observations AS (SELECT user_id AS station, ts AS observed_at, event_id, value
    FROM events)"""


def views(spark: SparkSession, folder: str) -> DataFrame:
    """Observations of one kind of event, to be matched with events of another kind."""
    return _observed(table(spark, folder, "events").where("event_type = 'view'"))


VIEWS_SQL = OBSERVATIONS_SQL.replace("FROM events)", "FROM events WHERE event_type = 'view')")


def departures(spark: SparkSession, folder: str) -> DataFrame:
    """Events to be matched with an observation of their station."""
    rows = table(spark, folder, "events").where("event_type = 'purchase'")
    return rows.select(F.col("event_id").alias("flight_id"), F.col("user_id").alias("station"), F.col("ts").alias("departs"))


DEPARTURES_SQL = """departures AS (SELECT event_id AS flight_id, user_id AS station, ts AS departs
    FROM events WHERE event_type = 'purchase')"""

_REQUEST = """
    CAST(event_id AS {text}) AS UUID, {carrier} AS Carrier,
    CAST(ts AS DATE) AS FlightDate, CAST(event_id AS {text}) AS FlightNum,
    concat('NATION_', CAST(user_id % 25 AS {text})) AS Origin,
    concat('NATION_', CAST((user_id * 7 + event_id) % 25 AS {text})) AS Dest,
    CAST(event_id * 7 % 120 - 30 AS DOUBLE) AS DepDelay, ts AS {at}"""


def _as_requests(events: DataFrame) -> DataFrame:
    names = ", ".join(f"'{c}'" for c in CARRIERS)
    columns = _REQUEST.format(text="STRING", carrier=f"array({names})[CAST(event_id % 5 AS INT)]", at="Timestamp")
    return events.select(F.expr(f"struct({columns})").alias("r")).select("r.*")


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Prediction requests: who, when, from where to where."""
    return _as_requests(table(spark, folder, "events"))


REQUESTS_SQL = "requests AS (SELECT " + _REQUEST.format(
    text="VARCHAR", at='"Timestamp"',
    carrier="[" + ", ".join(f"'{c}'" for c in CARRIERS) + "][CAST(event_id % 5 AS INT) + 1]",
) + " FROM events)"


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Answers exist for the requests of a certain value."""
    rows = table(spark, folder, "events").where("value >= 20")
    return rows.selectExpr("CAST(event_id AS STRING) AS UUID", "CAST(event_id % 4 AS DOUBLE) AS Prediction")


RESPONSES_SQL = """responses AS (SELECT CAST(event_id AS VARCHAR) AS UUID,
    CAST(event_id % 4 AS DOUBLE) AS Prediction FROM events WHERE value >= 20)"""


def _complete(asked: DataFrame) -> DataFrame:
    miles = F.expr("abs(int(substring_index(Origin, '_', -1)) - int(substring_index(Dest, '_', -1))) * 100 + 50")
    return calendar(asked, "FlightDate").withColumns(
        {"Distance": miles.cast("double"), "Timestamp": F.col("Timestamp").cast("timestamp")}
    )


def request_features(spark: SparkSession, folder: str) -> DataFrame:
    """Requests complete with distance and calendar, as the model expects them."""
    return _complete(requests(spark, folder))


def request_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same requests as a stream of JSON texts, one per message."""
    return to_json_rows(_complete(_as_requests(_event_stream(spark, folder))))


def request_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as a stream of rows: who asked, when, and for which route."""
    return _as_requests(_event_stream(spark, folder)).select("UUID", "Carrier", "Origin", "Dest", F.col("Timestamp").cast("timestamp").alias("asked"))


def response_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Responses as a stream: to requests of a certain value, up to six minutes later."""
    events = _event_stream(spark, folder).where("value >= 20")
    later = F.expr("CAST(ts AS TIMESTAMP) + make_interval(0, 0, 0, 0, 0, CAST(event_id % 7 AS INT), 0)")
    return events.select(
        F.col("event_id").cast("string").alias("UUID"), later.alias("answered"), (F.col("event_id") % 4).cast("double").alias("Prediction")
    )


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, because a stream over a plain path must name a folder.
    return spark.readStream.schema(table(spark, folder, "events").schema).parquet(f"{folder}/[e]vents.parquet")


def damaged_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Request messages of which those of every 17th request are cut off in the middle."""
    asked = _complete(_as_requests(_event_stream(spark, folder)))
    text = F.to_json(F.struct("*"))
    broken = F.col("FlightNum").cast("long") % 17 == 0
    return asked.select(F.when(broken, F.substring(text, 1, 20)).otherwise(text).alias("value"))
