"""The queries of ``queries`` as SQL over the same tables, for DuckDB."""

from __future__ import annotations

from .queries import API_PAGE_SIZE, PAGE_SIZE, RUN

# Written out here, so that a name lost from the code shows.
SILVER_FIELDS = (
    "id name brewery_type address_1 address_2 address_3 city state_province postal_code country "
    "longitude latitude phone website_url state street"
).split()
BRONZE_CHECKS = "ingestion_timestamp ingestion_date source_system payload".split()
SILVER_CHECKS = (
    "id name brewery_type address_1 city state_province country postal_code longitude latitude "
    "phone website_url state street"
).split()
GOLD_CHECKS = "brewery_type country state_province city num_breweries".split()

_TS = f"CAST({int(RUN.ts.timestamp()) * 1_000_000} AS BIGINT)"

# The customers as records, and their fields after the spoiling rule of ``samples``.
_CUSTOMERS = """
    SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
           c_mktsegment AS brewery_type, 'City_' || CAST(c_custkey % 7 AS VARCHAR) AS city,
           n_name AS state_province, r_name AS country,
           lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS postal_code,
           CAST(c_acctbal AS DOUBLE) AS longitude, n_name AS state,
           CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS VARCHAR) AS address_1,
           CAST(NULL AS VARCHAR) AS address_2, CAST(NULL AS VARCHAR) AS address_3,
           CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS phone,
           CAST(NULL AS VARCHAR) AS website_url
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
"""
_KEPT = [name for name in SILVER_FIELDS if name not in ("state_province", "longitude")]
_DIRTY = f"""
    SELECT k, {", ".join(f"CASE WHEN k % 13 <> 0 THEN {name} END AS {name}" for name in _KEPT)},
           CASE WHEN k % 13 = 0 OR k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN ''
                ELSE state_province END AS state_province,
           CASE WHEN k % 13 <> 0 AND k % 11 <> 0 THEN longitude END AS longitude
    FROM ({_CUSTOMERS})
"""
# What a partitioned table returns: an empty key as null.
_STORED = f"SELECT * REPLACE (nullif(state_province, '') AS state_province) FROM ({_DIRTY})"
_ORDERS = """
    SELECT o_orderstatus AS brewery_type, r_name AS country, n_name AS state_province,
           o_orderpriority AS city
    FROM orders JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
"""
_LINEITEMS = """
    SELECT l_returnflag AS brewery_type, r_name AS country, n_name AS state_province,
           l_linestatus AS city
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
"""


def _gold(rows: str, factor: int = 1) -> str:
    return f"""
        SELECT brewery_type, country, state_province, city,
               {factor} * count(*) AS num_breweries
        FROM ({rows}) GROUP BY brewery_type, country, state_province, city
    """


def _silver(rows: str) -> str:
    return f"SELECT {_TS} AS ingested, {', '.join(SILVER_FIELDS)} FROM ({rows})"


def _typed(rows: str) -> str:
    return f"SELECT {', '.join(SILVER_FIELDS)} FROM ({rows})"


def _page_end(cap: str) -> str:
    """The pages of the orders, and those before the first empty or absent one."""
    return f"""
        WITH paged AS (
            SELECT o_orderkey // {PAGE_SIZE} + 1 AS page, o_orderkey, o_orderstatus FROM orders
        ),
        last AS (SELECT max(page) AS page FROM paged),
        filled AS (SELECT DISTINCT page FROM paged
                   WHERE page <> (SELECT page * 3 // 4 FROM last) AND {cap}),
        ended AS (
            SELECT min(page) AS page
            FROM (SELECT 1 AS page UNION SELECT page + 1 FROM filled) AS following
            WHERE page NOT IN (SELECT page FROM filled)
        )
        SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS brewery_type
        FROM paged WHERE page >= 1 AND page < (SELECT page FROM ended)
    """


def _checks(gate: str, columns: list[str], rows: str) -> str:
    named = " UNION ALL ".join(
        f"SELECT '{gate}', 'column {name}', CAST(1 AS BIGINT), TRUE" for name in columns
    )
    return f"""
        SELECT '{gate}' AS gate, 'row_count' AS check_name, n AS observed, n >= 1 AS passed
        FROM (SELECT count(*) AS n FROM ({rows}))
        UNION ALL {named}
    """


def _history(layer: str, rows_in: str, rows_out: str, null_rows: str) -> str:
    return f"""
        SELECT '{RUN.run_id}' AS run_id, '{layer}' AS layer, CAST({rows_in} AS BIGINT) AS rows_in,
               CAST({rows_out} AS BIGINT) AS rows_out, CAST({null_rows} AS BIGINT) AS null_rows,
               'ok' AS status
    """


# Three runs of the customers: all, a third moved, most renamed and some without their id.
_VERSIONS = f"""
    SELECT 1 AS run, id, name, brewery_type, country, state_province, city FROM ({_CUSTOMERS})
    UNION ALL
    SELECT 2, id, name, brewery_type, country, state_province, 'Moved' FROM ({_CUSTOMERS}) WHERE k % 3 = 0
    UNION ALL
    SELECT 3, CASE WHEN k % 3 = 1 THEN NULL WHEN k % 10 = 2 THEN 'hot' ELSE id END, name || ' & Co',
           brewery_type, country, state_province, city
    FROM ({_CUSTOMERS}) WHERE k % 5 <> 0
"""
_LATEST = f"""
    SELECT * FROM ({_VERSIONS}) WHERE id IS NULL
    UNION ALL
    SELECT * EXCLUDE (age) FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY run DESC, name DESC) AS age
        FROM ({_VERSIONS}) WHERE id IS NOT NULL
    ) WHERE age = 1
"""


def _rate(gate: str, name: str, rows: str, limit: float) -> str:
    return f"""
        SELECT '{gate}' AS gate, '{name}' AS column_name, count(*) AS n_rows,
               count(*) FILTER ({name} IS NULL) AS n_nulls, CAST({limit} AS DOUBLE) AS max_rate,
               count(*) FILTER ({name} IS NULL) <= {limit}::DOUBLE * count(*) AS passed
        FROM ({rows})
    """


def _ended(hour: int, layer: str, rows_out: str, null_rows: str, status: str = "ok") -> str:
    run_id = RUN.run_id.replace("T120000", f"T{12 + hour}0000")
    return f"""
        SELECT '{run_id}' AS run_id, '{layer}' AS layer, CAST({rows_out} AS BIGINT) AS rows_out,
               CAST({null_rows} AS BIGINT) AS null_rows, '{status}' AS status
    """


_ALL = f"(SELECT count(*) FROM ({_CUSTOMERS}))"
_PLACES = f"(SELECT count(*) FROM ({_gold(_CUSTOMERS)}))"
_N = f"(SELECT count(*) FROM ({_DIRTY}))"
_BROKEN = f"(SELECT count(*) FROM ({_DIRTY}) WHERE id IS NULL)"
_GROUPS = f"(SELECT count(*) FROM ({_gold(_STORED)}))"

ORACLES: dict[str, str] = {
    "gold_counts": _gold(_DIRTY),
    "gold_orders": _gold(_ORDERS),
    "gold_lineitems": _gold(_LINEITEMS),
    "gold_malformed": """
        SELECT CAST(NULL AS VARCHAR) AS brewery_type, CAST(NULL AS VARCHAR) AS country,
               CAST(NULL AS VARCHAR) AS state_province, CAST(NULL AS VARCHAR) AS city,
               count(*) AS num_breweries
        FROM documents
    """,
    "silver_parse": _silver(_DIRTY),
    "silver_documents": """
        SELECT CAST(doc_id AS VARCHAR) AS id, lang AS country, source AS brewery_type,
               CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS digest
        FROM documents
    """,
    "typed_records": _typed(_CUSTOMERS),
    "conformed_records": _typed("""
        SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
               CAST(s_nationkey AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS latitude,
               CAST(NULL AS VARCHAR) AS brewery_type, CAST(NULL AS VARCHAR) AS address_1,
               CAST(NULL AS VARCHAR) AS address_2, CAST(NULL AS VARCHAR) AS address_3,
               CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS city,
               CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS state_province,
               CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS postal_code,
               CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS website_url
        FROM supplier
    """),
    "events_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    """,
    "bronze_fields": f"""
        SELECT {_TS} AS ingested, '{RUN.date:%Y-%m-%d}' AS ingested_on,
               '{RUN.source_system}' AS source_system, id
        FROM ({_CUSTOMERS})
    """,
    "silver_roundtrip": _silver(_STORED),
    "gold_roundtrip": _gold(_STORED),
    "gold_overwrite": _gold(_ORDERS),
    "page_prefix": _page_end("TRUE"),
    "page_cap": _page_end("page <= (SELECT page // 2 FROM last)"),
    "paged_source": f"""
        WITH paged AS (SELECT k // {API_PAGE_SIZE} + 1 AS page, * FROM ({_CUSTOMERS})),
        filled AS (SELECT DISTINCT page FROM paged),
        ended AS (
            SELECT min(page) AS page
            FROM (SELECT 1 AS page UNION SELECT page + 1 FROM filled) AS following
            WHERE page NOT IN (SELECT page FROM filled)
        )
        SELECT id, name, country FROM paged
        WHERE page >= 1 AND page < (SELECT page FROM ended)
    """,
    "raw_array": _typed(_CUSTOMERS),
    "raw_array_split": _typed(_CUSTOMERS),
    "raw_lines": _typed(_CUSTOMERS),
    "raw_lossless": r"""
        SELECT CASE c_custkey % 8
            WHEN 1 THEN ''
            WHEN 2 THEN repeat(' ' || chr(9), c_custkey % 5)
            WHEN 3 THEN 'line' || chr(10) || c_custkey || chr(13) || chr(10)
            WHEN 4 THEN '"quoted ' || c_custkey
            WHEN 5 THEN 'null'
            WHEN 6 THEN '{"id": "' || c_custkey || '"}'
            WHEN 7 THEN chr(10) || c_name || '\' END AS payload
        FROM customer
    """,
    "gate_report": " UNION ALL ".join(
        (
            _checks("bronze", BRONZE_CHECKS, _DIRTY),
            _checks("silver", SILVER_CHECKS, _DIRTY),
            _checks("silver without phone", ["id"], _DIRTY),
            "SELECT 'silver without phone', 'column phone', CAST(0 AS BIGINT), FALSE",
            _checks("gold", GOLD_CHECKS, _gold(_DIRTY)),
        )
    ),
    "layer_counts": f"""
        SELECT 'bronze' AS layer, {_N} AS n_rows, CAST(0 AS BIGINT) AS null_rows
        UNION ALL SELECT 'silver', {_N}, {_BROKEN}
        UNION ALL SELECT 'gold', (SELECT count(*) FROM ({_gold(_DIRTY)})), CAST(0 AS BIGINT)
    """,
    "null_rates": " UNION ALL ".join(
        (
            _rate("silver", "id", _DIRTY, 0.05),
            _rate("silver", "name", _DIRTY, 0.1),
            _rate("silver", "state_province", _DIRTY, 0.5),
            _rate("silver", "phone", _DIRTY, 1.0),
            _rate("silver", "longitude", _DIRTY, 0.2),
            _rate("gold", "city", _gold(_DIRTY), 0.02),
            _rate("gold", "state_province", _gold(_DIRTY), 0.5),
        )
    ),
    "audited_append": _gold(_CUSTOMERS),
    "audited_incremental": " UNION ALL ".join(
        (
            _ended(0, "bronze", _ALL, "0"),
            _ended(0, "silver", _ALL, "0"),
            _ended(0, "gold", _PLACES, "-1"),
            _ended(1, "bronze", "-1", "-1", "failed: GateError"),
            _ended(2, "bronze", _ALL, "0"),
            _ended(2, "silver", _ALL, "0"),
            _ended(2, "gold", _PLACES, "-1"),
            f"SELECT 'all', 'records in gold', 2 * {_ALL}, CAST(-1 AS BIGINT), 'ok'",
        )
    ),
    "quarantine": f"""
        SELECT CASE WHEN k % 13 = 0 THEN 'malformed' WHEN k % 11 = 0 THEN 'mistyped' ELSE 'read' END AS status,
               CASE WHEN k % 13 <> 0 AND k % 11 <> 0 THEN id END AS id,
               CASE WHEN k % 13 <> 0 AND k % 11 <> 0 THEN longitude END AS longitude,
               CASE WHEN k % 13 = 0 OR k % 11 = 0
                    THEN substr('{{"id":"' || id || '","name":"' || name, 1, 20) END AS payload
        FROM ({_CUSTOMERS})
    """,
    "latest_records": _gold(_LATEST),
    "latest_incremental": _gold(_LATEST),
    "gold_maintained": _gold(_VERSIONS),
    "rerun_append": _gold(_CUSTOMERS, 6),
    "rerun_incremental": _gold(_CUSTOMERS, 2),
    "rerun_sources": _gold(_CUSTOMERS, 2),
    "gold_order": f"SELECT CAST(0 AS BIGINT) AS out_of_order FROM ({_CUSTOMERS}) LIMIT 1",
    "empty_run": """
        SELECT 'extract' AS layer, 'empty' AS status, FALSE AS wrote_bronze
        UNION ALL SELECT 'probe', 'failed: ExtractionError', FALSE
    """,
    "gated_run": _gold(_STORED),
    "gated_lineitems": _gold(_LINEITEMS),
    "run_history": " UNION ALL ".join(
        (
            _history("probe", "-1", "-1", "-1"),
            _history("extract", _N, _N, "-1"),
            _history("bronze gate", "-1", "-1", "-1"),
            _history("bronze", _N, _N, "0"),
            _history("silver gate", "-1", "-1", "-1"),
            _history("silver", _N, _N, _BROKEN),
            _history("gold gate", "-1", "-1", "-1"),
            _history("gold", _N, _GROUPS, "-1"),
        )
    ),
    "schema_drift": f"""
        WITH c AS (SELECT k FROM ({_CUSTOMERS}) WHERE k % 13 <> 0),
        changes AS (
            SELECT 'extra' AS change, 'rating' AS key, CAST(NULL AS VARCHAR) AS declared, 'array' AS found,
                   count(*) AS records FROM c WHERE k % 5 = 0
            UNION ALL SELECT 'extra', 'rating', NULL, 'number', count(*) FROM c WHERE k % 5 = 1
            UNION ALL SELECT 'extra', 'rating', NULL, 'null', count(*) FROM c WHERE k % 5 > 1
            UNION ALL SELECT 'extra', 'town', NULL, 'string', count(*) FROM c
            UNION ALL SELECT 'retyped', 'longitude', 'number', 'string', count(*) FROM c WHERE k % 11 = 0
        )
        SELECT '{RUN.run_id}' AS run_id, * FROM changes WHERE records > 0
        UNION ALL SELECT '{RUN.run_id}', 'absent', 'city', 'string', NULL, CAST(0 AS BIGINT)
    """,
    "slow_steps": """
        SELECT event_type AS layer, count(DISTINCT event_id % 24) AS runs, count(*) AS steps,
               TRUE AS median_within, TRUE AS tail_within
        FROM events GROUP BY event_type
    """,
    "compacted_silver": f"""
        SELECT country, state_province, 4 * count(*) AS rows_before, 4 * count(*) AS rows,
               count(DISTINCT id) AS ids, TRUE AS had_many, CAST(1 AS BIGINT) AS files
        FROM ({_STORED}) GROUP BY country, state_province
    """,
}
