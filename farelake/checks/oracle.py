"""Plain SQL for every query, over the check tables as views."""

from __future__ import annotations

from farelake.checks.landing import FARE_HEADER
from farelake.checks.proxy import YEARS
from farelake.config import OPERATION_COLUMNS



def _mean(fare: str) -> str:
    """Means in whole cents, half-up, for prices of two places that are not negative."""
    return f"""
        SELECT year, month, company, origin, destination,
               (2 * CAST(SUM(CAST(ROUND(price * 100) AS BIGINT) * seats) AS BIGINT)
                + NULLIF(CAST(SUM(seats) AS BIGINT), 0))
               // (2 * NULLIF(CAST(SUM(seats) AS BIGINT), 0)) / 100.0 AS priceAVG,
               CAST(SUM(seats) AS BIGINT) AS seats
        FROM {fare} GROUP BY year, month, company, origin, destination"""


def _joined(means: str, ops: str) -> str:
    return f"""
        SELECT a.year, a.month, a.company, a.origin, a.destination, a.priceAVG,
               a.seats AS seatsAVG, b.companyName, b.takeOffs, b.distance, b.seats AS seatsAll,
               b.time
        FROM {means} a LEFT JOIN {ops} b
          ON a.year = b.year AND a.month = b.month AND a.company = b.company
         AND a.origin = b.origin AND a.destination = b.destination"""


def _curated(joined: str, guard: bool = True) -> str:
    return f"""
        SELECT j.year, j.month, j.company, j.companyName, c.city, c.state, j.destination,
               j.priceAVG, j.seatsAVG, j.takeOffs, j.distance, j.seatsAll, j.time
        FROM {joined} j LEFT JOIN airport c ON j.destination = c.icao
        {"WHERE j.time IS NOT NULL" if guard else ""}"""


def _exact_mean(units: str, per: int, digits: int) -> str:
    """Means of whole units, ``per`` of them to one, half-up in integers only."""
    scale = per // 10**digits
    return f"""
        SELECT year, month, company, origin, destination,
               CAST((2 * total + {scale} * weight) // (2 * {scale} * weight) AS DOUBLE)
               / {float(10**digits)} AS priceAVG,
               CAST(weight AS BIGINT) AS seats
        FROM (SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
                     l_suppkey AS company, l_returnflag AS origin,
                     CAST(l_partkey % 30 AS INT) AS destination,
                     SUM(CAST({units} AS HUGEINT) * CAST(l_quantity AS INT)) AS total,
                     SUM(CAST(l_quantity AS INT)) AS weight
              FROM lineitem GROUP BY ALL)"""


_CENTS = "CAST(ROUND(l_extendedprice * 100) AS BIGINT)"

# The relations of the checks; each may use those above it.
RELATIONS = {
    "fare_raw": """
        SELECT CAST(CAST(year(l_shipdate) AS INT) AS VARCHAR) AS year_t,
               CAST(CAST(month(l_shipdate) AS INT) AS VARCHAR) AS month_t,
               l_suppkey AS company, l_returnflag AS origin,
               CAST(l_partkey % 30 AS INT) AS destination,
               CASE WHEN l_linenumber = 7 THEN 'Tarifa-N' WHEN l_linenumber = 6 THEN NULL
                    WHEN l_linenumber = 5 THEN '1.234,56'
                    ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
               END AS price_t,
               CAST(CAST(l_quantity AS INT) - 1 AS VARCHAR) AS seats_t
        FROM lineitem""",
    "fare_all": """
        SELECT TRY_CAST(year_t AS INT) AS year, TRY_CAST(month_t AS INT) AS month,
               company, origin, destination,
               TRY_CAST(replace(price_t, ',', '.') AS DOUBLE) AS price,
               TRY_CAST(seats_t AS INT) AS seats
        FROM fare_raw WHERE price_t <> 'Tarifa-N'""",
    "fare": "SELECT * FROM fare_all WHERE origin = 'N'",
    "operation_source": """
        SELECT l_suppkey AS company, concat('carrier-', CAST(l_suppkey AS VARCHAR)) AS companyName,
               CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
               l_returnflag AS origin, CAST(l_partkey % 30 AS INT) AS destination,
               l_linenumber AS takeOffs, CAST(l_quantity * 10 AS INT) AS distance,
               CAST(l_quantity AS INT) AS seats,
               CASE WHEN l_linenumber = 1 THEN NULL
                    ELSE replace(CAST(CAST(l_tax AS DECIMAL(10,2)) AS VARCHAR), '.', ',')
               END AS time
        FROM lineitem""",
    "ops_all": """
        SELECT * REPLACE (replace(time, ',', '.') AS time)
        FROM operation_source WHERE year >= 1995 AND year <= 1998""",
    "ops": "SELECT * FROM ops_all WHERE origin = 'N'",
    "operation_landing": """
        SELECT *, CASE WHEN company % 2 = 0 THEN 'BRASILEIRA' ELSE 'ESTRANGEIRA' END AS nationality,
               seats - 1 AS paidPassengers, takeOffs % 3 AS noPaidPassengers
        FROM operation_source""",
    "airport": """
        SELECT n_nationkey AS icao, n_name AS city, r_name AS state
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "avg_fare": _mean("fare"),
    "joined": _joined("avg_fare", "ops"),
    "curated": _curated("joined"),
    "unguarded": _curated("joined", guard=False),
    "avg_fare_all": _mean("fare_all"),
    "joined_all": _joined("avg_fare_all", "ops_all"),
    "curated_all": _curated("joined_all"),
    "fare_again": "SELECT * REPLACE (7 AS seats) FROM fare WHERE year = 1997",
    "avg_fare_again": _mean("fare_again"),
    "joined_again": _joined("avg_fare_again", "ops"),
    "avg_fare_month": _mean(
        "(SELECT * REPLACE (CASE WHEN year = 1997 AND month = 3 THEN 7 ELSE seats END AS seats) FROM fare)"
    ),
    "joined_month": _joined("avg_fare_month", "ops"),
    "placed": """
        SELECT f.*, c.city, c.state FROM fare f LEFT JOIN airport c ON f.destination = c.icao""",
}


def _with(select: str) -> str:
    views = ",\n".join(f"{name} AS ({body})" for name, body in RELATIONS.items())
    return f"WITH {views}\n{select.strip()}"


def _text(columns: list[str], alias: dict[str, str] | None = None) -> str:
    alias = alias or {}
    return ", ".join(f"CAST({c} AS VARCHAR) AS {alias.get(c, c)}" for c in columns)


_CURATED = [
    "year", "month", "company", "companyName", "city", "state", "destination",
    "priceAVG", "seatsAVG", "takeOffs", "distance", "seatsAll", "time",
]

_OPERATION_TEXT = ", ".join(
    f"CAST({name} AS VARCHAR) AS {title}" for title, name in OPERATION_COLUMNS.items()
)

_HEADER = ", ".join(f"'{title}'" for title in FARE_HEADER)

# Each month file starts with its header line.
_MONTH_FILES = f"""
    SELECT year_t AS year, month_t AS month, CAST(company AS VARCHAR) AS company, origin,
           CAST(destination AS VARCHAR) AS destination, price_t AS price, seats_t AS seats
    FROM fare_raw
    UNION ALL
    SELECT {_HEADER} FROM range({12 * len(YEARS)})"""

# Lines of the odd month files: some lack a cell, some have text for seats.
_ODD = """
    SELECT *, company % 5 AS kind, coalesce(price_t, '') AS p,
           origin = 'N' AND price_t IS NOT NULL AND price_t <> 'Tarifa-N' AS asked
    FROM fare_raw WHERE CAST(year_t AS INT) BETWEEN 1995 AND 1998"""
_ODD_REJECTS = f"""
    SELECT year_t || lpad(month_t, 2, '0') AS month,
           concat_ws(';', year_t, month_t, company, origin, destination, p,
                     CASE kind WHEN 0 THEN NULL WHEN 1 THEN seats_t || 'x' ELSE seats_t END) AS line,
           concat_ws(',', CASE WHEN kind = 0 THEN 'cells' END,
                     CASE WHEN p IN ('1.234,56', 'Tarifa-N') THEN 'price' END,
                     CASE WHEN kind = 1 THEN 'seats' END) AS reasons,
           kind <> 0 AS kept
    FROM ({_ODD}) WHERE kind = 0 OR (asked AND (p = '1.234,56' OR kind = 1))"""
_ODD_OPERATIONS = """
    SELECT company % 5 < 2 AS lost, year BETWEEN 1995 AND 1998 AND origin = 'N' AS asked
    FROM operation_landing"""

_FREQUENCY = "SELECT destination, count(origin) AS n FROM fare GROUP BY destination"

_CUSTOMER_JSON = "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer"

# The fares as the job keeps them: keys as text, the year of the file, what its cell says.
_AS_TEXT = "CAST(company AS VARCHAR) AS company, CAST(destination AS VARCHAR) AS destination"
_ZONE = f"year, month, origin, price, seats, {_AS_TEXT}"
_STRAY = "CASE company % 7 WHEN 0 THEN NULL WHEN 1 THEN year - 1 ELSE year END"
_UNREAD = "CASE WHEN price IS NULL THEN 'price' END AS unread"

_SELECTS = {
    "curate_reduced": "SELECT * FROM curated",
    "curate_all_years": "SELECT * FROM curated",
    "curate_yearly": """
        SELECT a.year, a.month, a.company, b.companyName, c.city, c.state, a.destination,
               a.priceAVG, a.seats AS seatsAVG, b.takeOffs, b.distance, b.seats AS seatsAll, b.time
        FROM (SELECT * FROM avg_fare WHERE year = 1997) a
        LEFT JOIN (SELECT * FROM ops WHERE year = 1997) b
          ON a.month = b.month AND a.company = b.company AND a.destination = b.destination
        LEFT JOIN airport c ON a.destination = c.icao
        WHERE b.time IS NOT NULL""",
    "agg_weighted_mean": "SELECT * FROM avg_fare",
    "agg_weighted_mean_exclude_null": """
        SELECT year, month, company, origin, destination,
               (2 * cents + NULLIF(weight, 0)) // (2 * NULLIF(weight, 0)) / 100.0 AS priceAVG,
               weight AS seats
        FROM (SELECT year, month, company, origin, destination,
                     CAST(SUM(CAST(ROUND(price * 100) AS BIGINT) * seats) AS BIGINT) AS cents,
                     CAST(SUM(seats) FILTER (WHERE price IS NOT NULL) AS BIGINT) AS weight
              FROM fare GROUP BY year, month, company, origin, destination)""",
    "agg_weighted_mean_all_origins": "SELECT * FROM avg_fare_all",
    "agg_weighted_mean_large": _exact_mean(f"{_CENTS} * 100000 + l_linenumber * 37", 100, 2),
    "agg_weighted_mean_places": _exact_mean(f"{_CENTS} * 7 + l_linenumber", 10_000_000, 4),
    "agg_route_frequency": _FREQUENCY,
    "topk_routes": f"{_FREQUENCY} ORDER BY n DESC, destination LIMIT 10",
    "sort_by_month": "SELECT * FROM avg_fare ORDER BY month, year, company, origin, destination",
    "agg_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS relation, count(*) AS n FROM {name}"
        for name in ("fare_raw", "fare", "ops", "airport", "avg_fare", "curated")
    ),
    "join_left_multi_key": "SELECT * FROM joined",
    "join_left_multi_key_all_origins": "SELECT * FROM joined_all",
    "join_colocated": "SELECT * FROM joined_all",
    "join_left_lookup": "SELECT * FROM placed",
    "join_left_lookup_repeated_codes": """
        SELECT f.*, c.city, c.state FROM fare_all f LEFT JOIN (
            SELECT * FROM airport
            UNION ALL
            SELECT icao, 'OLD ' || city AS city, state FROM airport WHERE icao % 3 = 0
        ) c ON f.destination = c.icao""",
    "join_chain_unguarded": "SELECT * FROM unguarded",
    "quality_chain_coverage": "SELECT count(*) AS rows, count(time) AS matched FROM unguarded",
    "quality_curated_unmatched": f"SELECT {_text(_CURATED)} FROM curated WHERE city IS NULL",
    "filter_sentinel": "SELECT * FROM fare_raw WHERE price_t <> 'Tarifa-N'",
    "filter_origin": "SELECT * FROM fare_raw WHERE origin = 'N'",
    "filter_period_origin": """
        SELECT * FROM operation_source WHERE year BETWEEN 1996 AND 1998 AND origin = 'N'""",
    "filter_conjunction": "SELECT * FROM ops WHERE month = 3 AND year = 1997 AND company = 0",
    "filter_year": "SELECT * FROM ops WHERE year = 1997",
    "filter_require_non_null": "SELECT * FROM ops WHERE time IS NOT NULL",
    "proj_promote_names": """
        SELECT year_t AS year, month_t AS month, company, origin, destination, price_t AS price,
               seats_t AS seats
        FROM fare_raw""",
    "proj_select_as": f"SELECT {_text(list(OPERATION_COLUMNS.values()))} FROM operation_landing",
    "proj_subset": "SELECT company, origin, destination FROM fare_raw",
    "proj_cast_columns": """
        SELECT TRY_CAST(year_t AS INT) AS year_t, TRY_CAST(month_t AS INT) AS month_t, company,
               origin, destination, TRY_CAST(replace(price_t, ',', '.') AS DOUBLE) AS price_t,
               TRY_CAST(seats_t AS INT) AS seats_t
        FROM fare_raw""",
    "scalar_parse_int": """
        SELECT seats_t, TRY_CAST(seats_t AS INT) AS seats, price_t,
               CASE WHEN regexp_full_match(price_t, '[0-9]+') THEN TRY_CAST(price_t AS INT)
               END AS price_as_int
        FROM fare_raw""",
    "scalar_parse_int_lenient": """
        SELECT text AS price_t, CAST(trunc(TRY_CAST(text AS DOUBLE)) AS INT) AS price_as_int
        FROM (SELECT replace(price_t, ',', '.') AS text FROM fare_raw)""",
    "scalar_parse_locale_decimal": """
        SELECT price_t, TRY_CAST(replace(price_t, ',', '.') AS DOUBLE) AS price,
               TRY_CAST(replace(replace(price_t, '.', ''), ',', '.') AS DOUBLE) AS price_grouped
        FROM fare_raw""",
    "scalar_normalize_decimal_text": """
        SELECT time AS time_t, replace(time, ',', '.') AS time FROM operation_source""",
    "sql_view_scan": "SELECT * FROM ops",
    "src_headerless_csv": _MONTH_FILES,
    "src_month_files": _MONTH_FILES,
    "src_headered_csv": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
               CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal
        FROM customer""",
    "src_headered_csv_semicolon": f"""
        SELECT {_OPERATION_TEXT}, 'REGULAR' AS GRUPO_DE_VOO FROM operation_landing""",
    "src_multiline_json": _CUSTOMER_JSON,
    "src_json_array_ranges": """
        SELECT o_orderkey, '{"' || o_orderpriority || '\\"}, [{' AS note, '}' AS mark, o_custkey,
               o_totalprice AS price
        FROM orders""",
    "zone_parquet_roundtrip": """
        SELECT *, 'directory' AS via FROM fare UNION ALL SELECT *, 'glob' AS via FROM fare""",
    "zone_sorted": "SELECT * FROM avg_fare WHERE month IN (3, 4)",
    "zone_partition_overwrite": """
        SELECT * REPLACE (CASE WHEN year = 1997 THEN seats + 1 ELSE seats END AS seats)
        FROM fare""",
    "sink_curated_csv_roundtrip": f"SELECT {_text(_CURATED)} FROM curated",
    "sink_publish_table": "SELECT * FROM curated",
    "sink_publish_one_table": """
        SELECT * REPLACE (CASE WHEN year = 1997 THEN seatsAll + 1 ELSE seatsAll END AS seatsAll)
        FROM curated WHERE year <> 1998""",
    "quality_unmatched_lookup": "SELECT * FROM placed WHERE city IS NULL",
    "quality_blank_keys": "SELECT * FROM fare_raw WHERE price_t IS NULL OR trim(price_t) = ''",
    "quality_match_coverage": "SELECT count(*) AS rows, count(time) AS matched FROM joined",
    "quality_duplicate_keys": """
        SELECT year, month, company, origin, destination, count(*) AS n
        FROM ops GROUP BY year, month, company, origin, destination HAVING count(*) > 1""",
    "job_process_fares": f"SELECT {_ZONE}, year AS yearCell, {_UNREAD} FROM fare",
    "job_run_stray_years": f"SELECT {_ZONE}, {_STRAY} AS yearCell, {_UNREAD} FROM fare",
    "job_odd_cells": f"""
        SELECT 'fares' AS relation, year, count(*) AS rows, count(unread) AS unread,
               count(*) FILTER (WHERE yearCell IS DISTINCT FROM year) AS otherYear
        FROM (SELECT {_ZONE}, {_STRAY} AS yearCell, {_UNREAD} FROM fare)
        WHERE year <= 1998 GROUP BY year
        UNION ALL
        SELECT 'statistics', year, count(*), 0, NULL FROM ops GROUP BY year""",
    "job_process_airports": """
        SELECT CAST(c_custkey AS VARCHAR) AS icao, c_name AS airport, city, state
        FROM customer JOIN airport ON c_nationkey = icao""",
    "job_process_operations": """
        SELECT CAST(company AS VARCHAR) AS company, companyName, nationality, year, month, origin,
               CAST(destination AS VARCHAR) AS destination, takeOffs, distance, seats,
               replace(time, ',', '.') AS time, paidPassengers, noPaidPassengers,
               CAST(NULL AS VARCHAR) AS unread
        FROM operation_landing WHERE year BETWEEN 1995 AND 1998 AND origin = 'N'""",
    "job_process_distances": _CUSTOMER_JSON,
    "job_process_distances_ranges": _CUSTOMER_JSON,
    "job_run": f"SELECT * REPLACE ({_AS_TEXT}) FROM curated",
    "job_run_all_origins": f"SELECT * REPLACE ({_AS_TEXT}) FROM curated_all",
    "job_refresh_years": f"""
        SELECT * REPLACE ({_AS_TEXT}) FROM curated WHERE year NOT IN (1997, 1998)
        UNION ALL
        SELECT * REPLACE ({_AS_TEXT}) FROM ({_curated("joined_again")})""",
    "job_committed_refresh": f"""
        SELECT * REPLACE ({_AS_TEXT}) FROM ({_curated("joined_month")}) WHERE year <= 1998""",
    "sink_publish_view": f"""
        SELECT * REPLACE ({_AS_TEXT}) FROM ({_curated("joined_month")}) WHERE year <= 1998""",
    "job_versions": """
        SELECT * REPLACE (CAST(company AS VARCHAR) AS company, CAST(destination AS VARCHAR) AS destination)
        FROM avg_fare WHERE year <= 1998""",
    "job_rejects": _ODD_REJECTS,
    "job_line_counts": f"""
        SELECT 'fares' AS relation, count(*) + 48 AS rowsIn,
               count(*) FILTER (WHERE kind <> 0 AND asked) AS rowsOut,
               count(*) FILTER (WHERE kind = 0) AS rejected,
               count(*) FILTER (WHERE kind <> 0 AND NOT asked) + 48 AS filtered
        FROM ({_ODD})
        UNION ALL
        SELECT 'statistics', count(*), count(*) FILTER (WHERE NOT lost AND asked),
               count(*) FILTER (WHERE lost), count(*) FILTER (WHERE NOT lost AND NOT asked)
        FROM ({_ODD_OPERATIONS})""",
    "job_zone_counts": f"""
        SELECT 'fares' AS relation, count(*) AS n FROM ({_ODD}) WHERE kind <> 0 AND asked
        UNION ALL
        SELECT 'statistics', count(*) FROM ({_ODD_OPERATIONS}) WHERE NOT lost AND asked
        UNION ALL
        SELECT 'rejects', (SELECT count(*) FROM ({_ODD_REJECTS}))
                          + (SELECT count(*) FROM ({_ODD_OPERATIONS}) WHERE lost)""",
    "topk_customers": """
        SELECT o_custkey, count(o_orderstatus) AS n FROM orders
        GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 25""",
    "join_reduced": """
        SELECT * FROM joined
        WHERE priceAVG > 80000 AND companyName IS NOT NULL""",
    "job_run_branches": f"SELECT * REPLACE ({_AS_TEXT}) FROM curated",
}

ORACLE = {name: _with(select) for name, select in _SELECTS.items()}
