"""For each query the SQL, over the given tables, that its result must equal."""

from __future__ import annotations

# The measures of a trip.
MEASURES = (
    "passenger_count",
    "trip_distance",
    "extra",
    "mta_tax",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)

ZONES = """
zones AS (
    SELECT CASE WHEN n_nationkey = 24 THEN 264 ELSE n_nationkey END AS LocationID,
           r_name AS Borough,
           n_name AS zone,
           'Boro Zone' AS service_zone,
           CASE WHEN n_nationkey NOT IN (3, 7) THEN 40.0::DOUBLE + n_nationkey END AS latitude,
           CASE WHEN n_nationkey NOT IN (3, 7) THEN -74.0::DOUBLE - n_nationkey END AS longitude
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

TRIPS = """
lines AS (
    SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END::INTEGER AS VendorID,
           date_trunc('month', o_orderdate)::TIMESTAMP AS pickup_datetime,
           date_trunc('quarter', l_shipdate)::TIMESTAMP AS dropoff_datetime,
           nullif(l_quantity, 50) AS passenger_count,
           l_quantity * 2.5::DOUBLE AS trip_distance,
           l_linenumber::DOUBLE AS RatecodeID,
           CASE WHEN l_returnflag <> 'R' THEN 'N' END AS store_and_fwd_flag,
           (s_nationkey % 5)::INTEGER AS PULocationID,
           c_nationkey AS DOLocationID,
           substr(o_orderpriority, 1, 1)::INTEGER AS payment_type,
           l_extendedprice AS fare_amount,
           round(l_tax * 50, 1) AS extra,
           0.5::DOUBLE AS mta_tax,
           round(l_discount * 100, 0) AS tip_amount,
           round(l_tax * 10, 1) AS tolls_amount,
           1.0::DOUBLE AS improvement_surcharge,
           CASE WHEN l_returnflag = 'R' THEN 2.5 ELSE 0 END::DOUBLE AS congestion_surcharge,
           CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END::INTEGER AS service_type
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
),
raw_trips AS (
    SELECT *, round(fare_amount + extra + mta_tax + tip_amount + tolls_amount
                    + improvement_surcharge + congestion_surcharge, 2) AS total_amount
    FROM lines
),
trips AS (SELECT * EXCLUDE (store_and_fwd_flag) FROM raw_trips)"""

ALIGNED = f"""
VendorID, pickup_datetime, dropoff_datetime, RatecodeID, PULocationID, DOLocationID,
payment_type, service_type, {", ".join(MEASURES)}"""

LOCATED = """
located AS (
    SELECT trips.*,
           pu.latitude AS pickup_latitude, pu.longitude AS pickup_longitude,
           d.latitude AS dropoff_latitude, d.longitude AS dropoff_longitude
    FROM trips
    JOIN zones AS pu ON PULocationID = pu.LocationID
    JOIN zones AS d ON DOLocationID = d.LocationID
)"""

CLEAN = """
clean AS (
    SELECT * FROM located
    WHERE passenger_count IS NOT NULL
      AND pickup_latitude IS NOT NULL AND pickup_longitude IS NOT NULL
      AND dropoff_latitude IS NOT NULL AND dropoff_longitude IS NOT NULL
)"""

_SUMS = ",\n           ".join(f"sum({m}) AS {m}" for m in MEASURES)

STAGING = f"""
staging AS (
    SELECT year(pickup_datetime)::INTEGER AS year,
           monthname(pickup_datetime) AS month,
           dayname(pickup_datetime) AS dow,
           VendorID AS vendor_id, RatecodeID AS rate_code_id,
           PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
           payment_type AS payment_type_id, pickup_datetime, dropoff_datetime,
           pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude,
           {_SUMS},
           service_type
    FROM clean
    GROUP BY year(pickup_datetime), monthname(pickup_datetime), dayname(pickup_datetime),
             VendorID, RatecodeID, PULocationID, DOLocationID, payment_type,
             pickup_datetime, dropoff_datetime, pickup_latitude, pickup_longitude,
             dropoff_latitude, dropoff_longitude, service_type
)"""

# The texts of the codes.
VENDOR_NAME = """CASE {0} WHEN 1 THEN 'Creative Mobile Technologies, LLC'
    WHEN 2 THEN 'VeriFone Inc' END"""
RATE_CODE_TEXT = """CASE {0} WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
    WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negoriated fare'
    WHEN 6 THEN 'Group ride' END"""
PAYMENT_TEXT = """CASE {0} WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
    WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END"""
SERVICE_TEXT = "CASE {0} WHEN 1 THEN 'Yellow' WHEN 2 THEN 'Green' END"

# Rate codes are whole numbers here; a whole number's key text has no decimal part.
_RATE_TEXT = "rate_code_id::BIGINT::VARCHAR"

DIMS = f"""
known AS (SELECT * FROM staging WHERE vendor_id IS NOT NULL),
dim_vendor AS (
    SELECT DISTINCT md5(vendor_id::VARCHAR) AS vendor_key, vendor_id,
           {VENDOR_NAME.format("vendor_id")} AS vendor_name
    FROM known WHERE vendor_id < 3
),
dim_rate_code AS (
    SELECT DISTINCT md5({_RATE_TEXT}) AS rate_code_key, rate_code_id,
           {RATE_CODE_TEXT.format("rate_code_id")} AS rate_code_description
    FROM known WHERE rate_code_id::INTEGER < 7
),
dim_payment AS (
    SELECT DISTINCT md5(payment_type_id::VARCHAR) AS payment_type_key, payment_type_id,
           {PAYMENT_TEXT.format("payment_type_id")} AS payment_description
    FROM known WHERE payment_type_id IS NOT NULL
),
dim_service AS (
    SELECT DISTINCT service_type AS service_type_id,
           {SERVICE_TEXT.format("service_type")} AS service_name
    FROM known WHERE service_type IS NOT NULL
),
dim_pickup_location AS (
    SELECT DISTINCT pickup_location_id, pickup_latitude, pickup_longitude
    FROM known WHERE pickup_location_id IS NOT NULL
),
dim_dropoff_location AS (
    SELECT DISTINCT dropoff_location_id, dropoff_latitude, dropoff_longitude
    FROM known WHERE dropoff_location_id IS NOT NULL
)"""

FACT = f"""
fact AS (
    SELECT md5(concat_ws('-', vendor_id::VARCHAR, {_RATE_TEXT}, pickup_location_id::VARCHAR,
                         dropoff_location_id::VARCHAR, payment_type_id::VARCHAR,
                         service_type::VARCHAR, pickup_datetime::VARCHAR,
                         dropoff_datetime::VARCHAR)) AS trip_id,
           vendor_key, rate_code_key, pickup_location_id, dropoff_location_id,
           payment_type_key, service_type AS service_type_id, pickup_datetime,
           dropoff_datetime, {", ".join(MEASURES)}
    FROM staging
    JOIN dim_vendor USING (vendor_id)
    JOIN dim_rate_code USING (rate_code_id)
    JOIN dim_payment USING (payment_type_id)
    JOIN dim_pickup_location USING (pickup_location_id)
    JOIN dim_dropoff_location USING (dropoff_location_id)
)"""

_UP_TO = {
    "zones": [ZONES],
    "trips": [TRIPS],
    "located": [ZONES, TRIPS, LOCATED],
    "clean": [ZONES, TRIPS, LOCATED, CLEAN],
    "staging": [ZONES, TRIPS, LOCATED, CLEAN, STAGING],
    "dims": [ZONES, TRIPS, LOCATED, CLEAN, STAGING, DIMS],
    "fact": [ZONES, TRIPS, LOCATED, CLEAN, STAGING, DIMS, FACT],
}


def _sql(upto: str, select: str) -> str:
    return "WITH" + ",".join(_UP_TO[upto]) + "\n" + select


def _rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 2) AS {n}" for n in (names or MEASURES))


_REVENUE = f"""
SELECT year, vendor_id, vendor_name, trips, {_rounded("passengers", "fares", "revenue")}
FROM (
    SELECT year(pickup_datetime)::INTEGER AS year, vendor_id, vendor_name,
           count(*) AS trips, sum(passenger_count) AS passengers,
           sum(fare_amount) AS fares, sum(total_amount) AS revenue
    FROM fact JOIN dim_vendor USING (vendor_key)
    GROUP BY year(pickup_datetime), vendor_id, vendor_name
)"""


def _expectation(position: int, kind: str, column: str, low, high, table: str) -> str:
    bound = {None: "NULL::DOUBLE"}
    low_sql = bound.get(low, f"{low}::DOUBLE")
    high_sql = bound.get(high, f"{high}::DOUBLE")
    if kind == "not_null":
        bad, judged = f"{column} IS NULL", "count(*)"
    else:
        tests = [f"{column} < {low}"] if low is not None else []
        tests += [f"{column} > {high}"] if high is not None else []
        bad, judged = " OR ".join(tests), f"count({column})"
    return f"""
    SELECT {position}::INTEGER AS position, '{kind}' AS "check", '{column}' AS "column",
           {low_sql} AS min_value, {high_sql} AS max_value,
           count(*) AS element_count,
           count(*) - count({column}) AS missing_count,
           count(*) FILTER (WHERE {bad}) AS unexpected_count,
           count(*) FILTER (WHERE {bad}) * 100.0::DOUBLE / {judged} AS unexpected_percent,
           count(*) FILTER (WHERE {bad}) = 0 AS success
    FROM {table}"""


def _suite(table: str, *rows) -> str:
    return "\nUNION ALL".join(
        _expectation(i, kind, column, low, high, table)
        for i, (kind, column, low, high) in enumerate(rows, 1)
    )


# The expectations on staging.
_STAGING_SUITE = [
    *[
        ("not_null", column, None, None)
        for column in (
            "vendor_id",
            "rate_code_id",
            "dropoff_location_id",
            "pickup_location_id",
            "payment_type_id",
            "service_type",
            "pickup_latitude",
            "pickup_longitude",
            "dropoff_latitude",
            "dropoff_longitude",
        )
    ],
    ("between", "trip_distance", 0, 100),
    ("between", "extra", 0, 3),
]

_ALIGNED_COLUMNS = [c.strip() for c in ALIGNED.replace("\n", " ").split(",")]


def _nulls(column: str, table: str) -> str:
    return f"SELECT '{column}' AS \"column\", count(*) FILTER (WHERE {column} IS NULL) AS failures FROM {table}"


def _repeated(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS failures FROM (
        SELECT {column} FROM {table} WHERE {column} IS NOT NULL
        GROUP BY {column} HAVING count(*) > 1)"""


def _orphans(column: str, table: str, parent: str, parent_column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS failures FROM {table} AS c
        WHERE {column} IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM {parent} AS p WHERE p.{parent_column} = c.{column})"""


def _dependency(table: str, key: str, *dependents: str) -> str:
    return f"""SELECT '{key}' AS "column", '{", ".join(dependents)}' AS depends, count(*) AS failures,
        min({key})::VARCHAR AS sample_key, arg_min(n, {key}) AS sample_values
        FROM (SELECT {key}, count(*) AS n FROM (SELECT DISTINCT {key}, {", ".join(dependents)} FROM {table})
              WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"""


# Table, unique key and required columns of each model.
_STAR_COLUMNS = {
    "factTrip": (
        "fact",
        None,
        (
            "vendor_key",
            "rate_code_key",
            "pickup_location_id",
            "dropoff_location_id",
            "payment_type_key",
            "service_type_id",
            "passenger_count",
            "trip_distance",
            "total_amount",
        ),
    ),
    "dimVendor": ("dim_vendor", "vendor_key", ("vendor_key", "vendor_name")),
    "dimRateCode": ("dim_rate_code", "rate_code_key", ("rate_code_key", "rate_code_description")),
    "dimPayment": ("dim_payment", "payment_type_key", ("payment_type_key", "payment_description")),
    "dimService": ("dim_service", "service_type_id", ("service_type_id", "service_name")),
    "dimPickupLocation": (
        "dim_pickup_location",
        "pickup_location_id",
        ("pickup_location_id", "pickup_latitude", "pickup_longitude"),
    ),
    "dimDropoffLocation": (
        "dim_dropoff_location",
        "dropoff_location_id",
        ("dropoff_location_id", "dropoff_latitude", "dropoff_longitude"),
    ),
}


def _star_tests() -> str:
    tests = []
    for model, (table, key, columns) in _STAR_COLUMNS.items():
        tests += [(model, "not_null", _nulls(c, table)) for c in columns]
        if key:
            tests.append((model, "unique", _repeated(key, table)))
            tests.append(("factTrip", "relationships", _orphans(key, "fact", table, key)))
    return "\nUNION ALL\n".join(
        f"""SELECT '{model}' AS model, "column", '{test}' AS test, failures,
        failures = 0 AS success FROM ({body})"""
        for model, test, body in tests
    )


def _dim(table: str) -> str:
    return _sql("dims", f"SELECT * FROM {table}")


_CLEAN_COLUMNS = f"""{ALIGNED}, pickup_latitude, pickup_longitude,
dropoff_latitude, dropoff_longitude"""

_SERVICE_FOLDER = "CASE service_type WHEN 1 THEN 'yellow' ELSE 'green' END"

_STAGING_KEYS = """month, dow, vendor_id, rate_code_id, pickup_location_id, dropoff_location_id,
payment_type_id, pickup_datetime, dropoff_datetime, pickup_latitude, pickup_longitude,
dropoff_latitude, dropoff_longitude, service_type"""

_STAGING_ROWS = f"SELECT year, {_STAGING_KEYS}, {_rounded()} FROM staging"

ORACLES: dict[str, str] = {
    "scan_raw_trips": _sql(
        "trips",
        f"""SELECT VendorID::BIGINT AS VendorID, RatecodeID, store_and_fwd_flag, PULocationID,
        DOLocationID, payment_type::BIGINT AS payment_type, service_type,
        {", ".join(MEASURES)} FROM raw_trips""",
    ),
    "zone_lookup": _sql("zones", "SELECT * FROM zones"),
    "drop_rename_cast": _sql("trips", f"SELECT {ALIGNED} FROM trips"),
    "canonical_columns": _sql("trips", f"SELECT {ALIGNED} FROM trips"),
    "pickup_zone_join": "WITH"
    + ZONES
    + ","
    + TRIPS
    + f"""
SELECT {ALIGNED}, latitude AS pickup_latitude, longitude AS pickup_longitude
FROM trips JOIN zones ON PULocationID = LocationID""",
    "both_zone_join": _sql("located", f"SELECT {_CLEAN_COLUMNS} FROM located"),
    "both_zone_join_shuffled": _sql("located", f"SELECT {_CLEAN_COLUMNS} FROM located"),
    "complete_rows": _sql("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "clean_trips": _sql("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "calendar_columns": _sql(
        "trips",
        """SELECT pickup_datetime, fare_amount, year(pickup_datetime)::INTEGER AS year,
        monthname(pickup_datetime) AS month, dayname(pickup_datetime) AS dow FROM trips""",
    ),
    "route_by_path": _sql(
        "trips",
        f"""SELECT {_SERVICE_FOLDER} AS service, 'year=' || year(pickup_datetime) AS folder,
        service_type, true AS is_parquet, count(*) AS trips,
        round(sum(fare_amount), 2) AS fare_amount
        FROM trips GROUP BY service_type, year(pickup_datetime)""",
    ),
    "grouped_sums": _sql("staging", _STAGING_ROWS),
    "staging_trips": _sql("staging", _STAGING_ROWS),
    "staging_declared": _sql(
        "staging",
        f"SELECT year::VARCHAR AS year, {_STAGING_KEYS}, {_rounded()} FROM staging",
    ),
    "union_services": _sql("staging", _STAGING_ROWS),
    "dim_vendor": _dim("dim_vendor"),
    "dim_rate_code": _dim("dim_rate_code"),
    "dim_payment": _dim("dim_payment"),
    "dim_service": _dim("dim_service"),
    "dim_pickup_location": _dim("dim_pickup_location"),
    "dim_dropoff_location": _dim("dim_dropoff_location"),
    "fact_trip": _sql(
        "fact", f"SELECT * EXCLUDE ({', '.join(MEASURES)}), {_rounded()} FROM fact"
    ),
    "fact_revenue_by_vendor": _sql("fact", _REVENUE),
    "code_descriptions": _sql(
        "trips",
        f"""SELECT VendorID, RatecodeID, payment_type, service_type,
        {VENDOR_NAME.format("VendorID")} AS vendor_name,
        {RATE_CODE_TEXT.format("RatecodeID")} AS rate_code_description,
        {PAYMENT_TEXT.format("payment_type")} AS payment_description,
        {SERVICE_TEXT.format("service_type")} AS service_name, count(*) AS trips
        FROM trips GROUP BY VendorID, RatecodeID, payment_type, service_type""",
    ),
    "surrogate_keys": _sql(
        "trips",
        """SELECT md5(VendorID::VARCHAR || '-' || RatecodeID::BIGINT::VARCHAR || '-' ||
        coalesce(passenger_count::BIGINT::VARCHAR, '') || '-' ||
        CASE WHEN trip_distance = floor(trip_distance) THEN trip_distance::BIGINT::VARCHAR
             ELSE trip_distance::VARCHAR END || '-' || pickup_datetime::VARCHAR) AS trip_key,
        VendorID, RatecodeID, passenger_count, trip_distance, pickup_datetime FROM trips""",
    ),
    "null_profile": _sql(
        "trips",
        "SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
            for c in [*_ALIGNED_COLUMNS, "store_and_fwd_flag"]
        )
        + " FROM raw_trips",
    ),
    "expect_not_null": _sql(
        "trips",
        _suite(
            "trips",
            ("not_null", "VendorID", None, None),
            ("not_null", "passenger_count", None, None),
            ("not_null", "trip_distance", None, None),
            ("not_null", "payment_type", None, None),
        ),
    ),
    "expect_between": _sql(
        "trips",
        _suite(
            "trips",
            ("between", "trip_distance", 0, 100),
            ("between", "extra", 0, 3),
            ("between", "passenger_count", 10, None),
            ("between", "fare_amount", None, 50000),
        ),
    ),
    "expectation_suite": _sql("staging", _suite("staging", *_STAGING_SUITE)),
    "stored_suite": _sql(
        "staging", _suite("staging", *_STAGING_SUITE, ("between", "fare_amount", None, 50_000))
    ),
    "unexpected_rows": _sql(
        "staging",
        """SELECT vendor_id, rate_code_id, pickup_location_id, dropoff_location_id,
        round(trip_distance, 2) AS trip_distance FROM staging
        WHERE trip_distance NOT BETWEEN 0 AND 100""",
    ),
    "test_not_null": _sql(
        "trips", "\nUNION ALL\n".join(_nulls(c, "trips") for c in _ALIGNED_COLUMNS)
    ),
    "test_unique": "WITH"
    + ZONES
    + ","
    + TRIPS
    + "\n"
    + "\nUNION ALL\n".join(
        [
            _repeated("LocationID", "zones"),
            *[
                _repeated(c, "trips")
                for c in ("payment_type", "passenger_count", "pickup_datetime", "fare_amount")
            ],
        ]
    ),
    "test_relationships": "WITH"
    + ZONES
    + ","
    + TRIPS
    + ", located_zones AS (SELECT * FROM zones WHERE latitude IS NOT NULL)\n"
    + _orphans("PULocationID", "trips", "located_zones", "LocationID")
    + "\nUNION ALL\n"
    + _orphans("DOLocationID", "trips", "located_zones", "LocationID"),
    "star_tests": _sql("fact", _star_tests()),
    "preview_rows": _sql(
        "dims", "SELECT * FROM dim_dropoff_location ORDER BY dropoff_location_id LIMIT 5"
    ),
    "parquet_roundtrip": _sql(
        "trips",
        f"""SELECT VendorID::BIGINT AS VendorID, fare_amount, trip_distance,
        {_SERVICE_FOLDER} AS service, year(pickup_datetime)::INTEGER AS batch_year FROM trips""",
    ),
    "convert_layer": _sql(
        "clean",
        f"""SELECT * EXCLUDE (service_type), {_SERVICE_FOLDER} AS service,
        year(pickup_datetime)::INTEGER AS batch_year FROM clean""",
    ),
    "convert_sources": _sql(
        "trips",
        f"""SELECT {_SERVICE_FOLDER} AS service, year(pickup_datetime)::INTEGER AS batch_year,
        CASE WHEN year(pickup_datetime) % 2 = 1 THEN 'bigint' ELSE 'double' END AS passenger_type,
        count(*) AS trips, sum(passenger_count) AS passengers
        FROM trips GROUP BY service_type, year(pickup_datetime)""",
    ),
    "convert_drifted": _sql(
        "clean",
        f"""SELECT * EXCLUDE (service_type), {_SERVICE_FOLDER} AS service,
        year(pickup_datetime)::INTEGER AS batch_year FROM clean""",
    ),
    "drifted_parts": _sql(
        "clean",
        f"""SELECT * EXCLUDE (service_type), {_SERVICE_FOLDER} AS service,
        year(pickup_datetime)::INTEGER AS batch_year,
        CASE WHEN "VendorID" = 1 THEN 0.75::DOUBLE END AS cbd_fee FROM clean""",
    ),
    "catalog_tables": _sql(
        "fact",
        """SELECT service_type_id, service_name, count(*) AS trips,
        round(sum(total_amount), 2) AS revenue
        FROM fact JOIN dim_service USING (service_type_id)
        GROUP BY service_type_id, service_name""",
    ),
    "full_run": _sql("fact", _REVENUE),
    "merged_staging": _sql("staging", _STAGING_ROWS),
    "incremental_run": _sql("fact", _REVENUE),
    "merged_expectations": _sql("staging", _suite("staging", *_STAGING_SUITE)),
    "location_dependency": _sql(
        "staging",
        "\nUNION ALL ".join(
            _dependency("staging", key, *dependents)
            for key, *dependents in (
                ("pickup_location_id", "pickup_latitude", "pickup_longitude"),
                ("dropoff_location_id", "dropoff_latitude", "dropoff_longitude"),
                ("payment_type_id", "vendor_id"),
                ("pickup_location_id", "vendor_id", "service_type"),
            )
        ),
    ),
    "run_metrics": _sql(
        "located",
        f"""SELECT {_SERVICE_FOLDER} AS service, count(*) AS rows_read,
        count(*) FILTER (WHERE NOT complete) AS incomplete,
        count(*) FILTER (WHERE complete AND NOT located) AS no_zone, 0::BIGINT AS no_id,
        count(*) FILTER (WHERE complete AND located) AS rows_written
        FROM (SELECT service_type, passenger_count IS NOT NULL AS complete,
              PULocationID IN (SELECT LocationID FROM zones WHERE latitude IS NOT NULL)
              AND DOLocationID IN (SELECT LocationID FROM zones WHERE latitude IS NOT NULL) AS located FROM trips)
        GROUP BY service_type""",
    ),
    "fact_by_service": _sql(
        "fact",
        """SELECT service_name, vendor_name, count(*) AS trips, round(sum(total_amount), 2) AS revenue
        FROM fact JOIN dim_service USING (service_type_id) JOIN dim_vendor USING (vendor_key)
        WHERE service_name LIKE 'Green%' GROUP BY service_name, vendor_name""",
    ),
}
