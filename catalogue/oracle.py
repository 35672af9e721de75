"""The catalogue's results in plain SQL, for the checking engine."""

from __future__ import annotations

from catalogue.inputs import LEFT, RAW_ENTITIES, T0, T1, T2
from catalogue.queries import PHONE_PATTERN, RUN_1, RUN_2, RUN_3

RAW = RAW_ENTITIES.format(orders="orders", customer="customer", nation="nation", region="region")

_UNSAFE_CLASS = r"""[ /\\:*?"<>|&%#@!~`+=\[\]{}()_]+"""


def _sanitized(text: str) -> str:
    ascii_text = f"regexp_replace(replace(strip_accents({text}), 'ß', 'ss'), '[^\\x00-\\x7F]', '', 'g')"
    joined = f"trim(regexp_replace({ascii_text}, '{_UNSAFE_CLASS}', '_', 'g'), '_')"
    return f"coalesce(nullif({joined}, ''), 'no_value')"


def _phone(c: str) -> str:
    digits = f"regexp_replace({c}, '[^0-9+]', '', 'g')"
    return f"regexp_replace(regexp_replace({digits}, '^\\+', ''), '^1', '')"


STATE = "coalesce(state, state_province)"
COUNTRY = "coalesce(country, 'no_country')"
ADDRESS = (
    "address_1 || coalesce(', ' || address_2, '') || coalesce(', ' || address_3, '') || ', ' || "
    f"city || ', ' || {STATE} || ' ' || postal_code || ', ' || {COUNTRY}"
)
ADDRESS_SKIPPING = (
    "nullif(concat_ws(', ', address_1, address_2, address_3, city, "
    f"nullif(concat_ws(' ', {STATE}, postal_code), ''), {COUNTRY}), '')"
)
URL = "replace(website_url, chr(92) || '/', '/')"
LONGITUDE = "CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude END"
LATITUDE = "CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude END"

SILVER_COLUMNS = f"""
    id, name, entity_type, address_1, address_2, address_3,
    {_sanitized("city")} AS city, {_sanitized(STATE)} AS state, postal_code,
    {_sanitized(COUNTRY)} AS country, {_phone("phone")} AS phone, {URL} AS website_url,
    {ADDRESS} AS full_address, {LONGITUDE} AS longitude, {LATITUDE} AS latitude,
    ingested_date AS updated_at, CAST(ingested_date AS DATE) AS updated_date,
    ingested_date AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
"""
SILVER = f"SELECT {SILVER_COLUMNS} FROM ({RAW}) r"

DIM_LOCATION = f"""
    SELECT DISTINCT country AS country_key, state AS state_key, city AS city_key,
           country AS country_name, state AS state_name, city AS city_name,
           postal_code, longitude, latitude FROM ({SILVER}) s
"""
DIM_TYPE = f"""
    SELECT DISTINCT entity_type AS entity_type_key, entity_type AS entity_type_name
    FROM ({SILVER}) s
"""
FACT = f"""
    SELECT id AS entity_id, name AS entity_name, entity_type AS entity_type_key,
           country AS country_key, state AS state_key, city AS city_key, phone, website_url,
           updated_at, updated_date, valid_from, valid_to, is_current FROM ({SILVER}) s
"""
AGG = f"""
    SELECT country, state, city, entity_type, count(*) AS entity_count,
           max(updated_at) AS last_updated
    FROM ({SILVER}) s GROUP BY country, state, city, entity_type
"""
STAR = f"""
    SELECT f.*, l.country_name, l.state_name, l.city_name, l.postal_code, l.longitude,
           l.latitude, t.entity_type_name
    FROM ({FACT}) f
    JOIN ({DIM_LOCATION}) l ON f.country_key = l.country_key AND f.state_key = l.state_key
        AND f.city_key = l.city_key
    JOIN ({DIM_TYPE}) t ON f.entity_type_key = t.entity_type_key
"""
STAR_SK = f"""
    SELECT id AS entity_id, name AS entity_name, entity_type AS entity_type_key,
           country AS country_key, state AS state_key, city AS city_key, phone, website_url,
           updated_at, updated_date, valid_from, valid_to, is_current,
           country AS country_name, state AS state_name, city AS city_name, postal_code,
           longitude, latitude, entity_type AS entity_type_name
    FROM ({SILVER}) s
"""


def _stamped(at) -> str:
    return f"SELECT * REPLACE (TIMESTAMP '{at}' AS ingested_date) FROM ({RAW}) r"


def _distribution(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS row_count"
        f" FROM ({source}) s GROUP BY {c}"
        for c in columns
    )


def _quality() -> str:
    filled = (
        f"SELECT * REPLACE ({COUNTRY} AS country), {ADDRESS} AS full_address FROM ({RAW}) r"
    )
    bounds = {"longitude": 180, "latitude": 90}
    columns = ["id", "country", "state", "city", "phone", "full_address", "longitude", "latitude"]
    return " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count(*) AS row_count,
               count(*) FILTER ({c} IS NULL) AS null_count,
               count(*) FILTER (trim(CAST({c} AS VARCHAR)) = '') AS blank_count,
               count(*) FILTER (CAST({c} AS VARCHAR) IN ('no_country', 'no_value'))
                   AS default_count,
               {f"count(*) FILTER (abs({c}) > {bounds[c]})" if c in bounds else "CAST(0 AS BIGINT)"}
                   AS out_of_range_count,
               count(DISTINCT {c}) AS distinct_count
        FROM ({filled}) q
        """
        for c in columns
    )


def _profile(run: str) -> str:
    """Counts per column; ``run`` is a select item with its comma, or nothing."""
    return " UNION ALL ".join(
        f"""
        SELECT {run} '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count,
               count(*) FILTER (trim(CAST({c} AS VARCHAR)) = '') AS blank_count,
               count(*) FILTER (CAST({c} AS VARCHAR) IN ('no_country', 'no_value')) AS default_count,
               count({c}) AS number_count, true AS distinct_near
        FROM ({RAW}) r {"GROUP BY 1" if run else ""}
        """
        for c in ("country", "state", "phone", "longitude")
    )


def _snapshot(until) -> str:
    return f"""
        SELECT user_id, event_type FROM (
            SELECT user_id, event_type,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events WHERE ts < TIMESTAMP '{until}') e
        WHERE rn = 1 AND event_type <> '{LEFT}'
    """


INITIAL = f"""
    SELECT user_id, event_type, TIMESTAMP '{T0}' AS valid_from,
           CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM ({_snapshot(T0)}) s
"""


def _merge(history: str, at, on_missing: str) -> str:
    """One snapshot merged into ``history``, a table name or a query in brackets."""
    gone = "s.user_id IS NULL" if on_missing == "close" else "false"
    changed = f"({gone} OR s.event_type IS DISTINCT FROM h.event_type AND s.user_id IS NOT NULL)"
    return f"""
        SELECT h.user_id, h.event_type, h.valid_from,
               CASE WHEN h.is_current AND {changed} THEN TIMESTAMP '{at}'
                    ELSE h.valid_to END AS valid_to,
               h.is_current AND NOT {changed} AS is_current
        FROM ({history}) h LEFT JOIN ({_snapshot(at)}) s ON h.user_id = s.user_id
        UNION ALL
        SELECT s.user_id, s.event_type, TIMESTAMP '{at}', CAST(NULL AS TIMESTAMP), true
        FROM ({_snapshot(at)}) s
        LEFT JOIN ({history}) h ON h.user_id = s.user_id AND h.is_current
        WHERE h.user_id IS NULL OR h.event_type IS DISTINCT FROM s.event_type
    """


def _merged(on_missing: str) -> str:
    return _merge(_merge(INITIAL, T1, on_missing), T2, on_missing)


def _versions(log: str, at: str) -> str:
    """Versions of ``event_type`` per user from a log without ties in time."""
    return f"""
        SELECT user_id, event_type, {at} AS valid_from,
               lead({at}) OVER (PARTITION BY user_id ORDER BY {at}) AS valid_to,
               lead({at}) OVER (PARTITION BY user_id ORDER BY {at}) IS NULL AS is_current
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY {at}) AS before
              FROM ({log}) l) c
        WHERE before IS DISTINCT FROM event_type
    """


# The last of several events at one instant is the one that counts.
EVENT_STATES = """
    SELECT user_id, event_type, ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
        FROM events) e WHERE rn = 1
"""
HISTORY = _versions(EVENT_STATES, "ts")
DAILY = """
    SELECT user_id, event_type, CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS known_at FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                     ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) e WHERE rn = 1
"""
DAILY_HISTORY = _versions(DAILY, "known_at")

BROKEN = """
    SELECT user_id, ts AS valid_from,
           CASE WHEN event_type = 'signup' THEN ts
                WHEN event_type <> 'view' THEN ts + INTERVAL 12 HOUR END AS valid_to,
           event_type IN ('view', 'click') AS is_current
    FROM events
"""
VIOLATIONS = f"""
    SELECT user_id, rule, CAST(violations AS BIGINT) AS violations FROM (
        SELECT user_id,
               count(*) FILTER (reached > valid_from) AS overlap,
               count(*) FILTER (valid_to <= valid_from) AS "empty",
               count(*) FILTER (is_current <> (valid_to IS NULL)) AS flag,
               greatest(count(*) FILTER (is_current) - 1, 0) AS "open"
        FROM (SELECT *, max(coalesce(valid_to, TIMESTAMP '9999-12-31')) OVER (
                  PARTITION BY user_id ORDER BY valid_from, valid_to NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
              FROM ({BROKEN}) b) r
        GROUP BY user_id) c
    UNPIVOT (violations FOR rule IN (overlap, "empty", flag, "open"))
    WHERE violations > 0
"""

PAGES = f"""
    SELECT * REPLACE (
        CASE WHEN coalesce(country, '') NOT IN ('AFRICA', 'EUROPE') THEN address_2 END AS address_2,
        CASE WHEN coalesce(country, '') NOT IN ('AFRICA', 'EUROPE') THEN phone END AS phone,
        CASE WHEN country IN ('AMERICA', 'ASIA', 'AFRICA', 'EUROPE')
             THEN longitude END AS longitude)
    FROM ({RAW}) r
"""

GOLD = (
    ("dim_location", DIM_LOCATION),
    ("dim_entity_type", DIM_TYPE),
    ("fact_entities", FACT),
    ("agg_entities_by_type_location", AGG),
)

# Three runs: without some entities; without others and with other names; whole.
_RUNS = (
    (RUN_1, f"SELECT * FROM ({RAW}) r WHERE CAST(id AS BIGINT) % 5 <> 1"),
    (
        RUN_2,
        f"SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN upper(name) ELSE name END AS name)"
        f" FROM ({RAW}) r WHERE CAST(id AS BIGINT) % 11 <> 0",
    ),
    (RUN_3, RAW),
)
_STATES = " UNION ALL ".join(
    f"SELECT {n} AS run, TIMESTAMP '{at}' AS taken, s.* FROM (SELECT {SILVER_COLUMNS} FROM ({rows}) r) s"
    for n, (at, rows) in enumerate(_RUNS)
)
# A version begins with a run that shows an entity for the first time, again, or
# under another name, and ends with the next run that does so or lacks it.
RUNS_HISTORY = f"""
    WITH states AS ({_STATES}),
    marked AS (
        SELECT *, lag(name) OVER w IS NOT DISTINCT FROM name AND lag(run) OVER w = run - 1 AS same
        FROM states WINDOW w AS (PARTITION BY id ORDER BY run)
    ),
    numbered AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY run) AS version
                 FROM marked),
    ended AS (SELECT id, version, max(run) + 1 AS until FROM numbered GROUP BY ALL)
    SELECT n.* EXCLUDE (run, taken, same, version, valid_from, valid_to, is_current), n.taken AS valid_from,
           CASE e.until WHEN 1 THEN TIMESTAMP '{RUN_2}' WHEN 2 THEN TIMESTAMP '{RUN_3}' END AS valid_to,
           e.until = 3 AS is_current
    FROM numbered n JOIN ended e ON n.id = e.id AND n.version = e.version
    WHERE NOT n.same
"""
RUNS_STAR = STAR_SK.replace(f"({SILVER}) s", f"(SELECT * FROM ({RUNS_HISTORY}) h WHERE is_current) s")

# What the second run shows, as it is current after it.
_SECOND = f"(SELECT {SILVER_COLUMNS} FROM ({_RUNS[1][1]}) r) s"
RUNS_ROLLUP = AGG.replace(f"({SILVER}) s", _SECOND)

DIFF = f"""
        SELECT coalesce(o.user_id, n.user_id) AS user_id,
               CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'close'
                    WHEN o.event_type IS NOT DISTINCT FROM n.event_type THEN 'same'
                    ELSE 'update' END AS action,
               o.event_type AS old_event_type, n.event_type AS new_event_type
        FROM ({_snapshot(T0)}) o FULL JOIN ({_snapshot(T2)}) n ON o.user_id = n.user_id
"""

PAGE_REPORT = f"""
    WITH numbered AS (SELECT CAST(id AS BIGINT) AS number, CAST(id AS BIGINT) // 250 AS page FROM ({RAW}) r),
    found AS (
        SELECT number, page FROM numbered WHERE page <> 1 AND (page <> 4 OR number % 2 = 0)
        UNION ALL SELECT number, 3 FROM numbered WHERE page = 2 AND number % 3 = 0
    ),
    ranked AS (SELECT page, row_number() OVER (PARTITION BY number ORDER BY page) AS nth FROM found),
    counts AS (
        SELECT page, count(*) AS row_count, count(*) FILTER (nth > 1) AS repeated FROM ranked GROUP BY page
    ),
    plan AS (SELECT page, count(*) AS expected FROM numbered GROUP BY page)
    SELECT CAST(p.page AS INTEGER) AS page, expected, coalesce(row_count, 0) AS row_count, coalesce(repeated, 0) AS repeated,
           CASE WHEN row_count IS NULL THEN 'missing' WHEN row_count < expected THEN 'short'
                WHEN row_count > expected THEN 'extra' ELSE 'ok' END AS status
    FROM plan p LEFT JOIN counts c ON p.page = c.page
"""

ORACLE: dict[str, str] = {
    "fill_first_non_null": f"SELECT id, {STATE} AS state FROM ({RAW}) r",
    "fill_default": f"SELECT id, {COUNTRY} AS country FROM ({RAW}) r",
    "clean_phone": f"SELECT id, {_phone('phone')} AS phone FROM ({RAW}) r",
    "clean_phone_documents": f"""
        SELECT doc_id, found, {_phone('found')} AS phone FROM (
            SELECT doc_id, unnest(regexp_extract_all(text, '{PHONE_PATTERN}')) AS found
            FROM documents) d
    """,
    "clean_url": f"SELECT id, {URL} AS website_url FROM ({RAW}) r",
    "full_address": f"SELECT id, {ADDRESS} AS full_address FROM ({RAW}) r",
    "full_address_skip_nulls": f"SELECT id, {ADDRESS_SKIPPING} AS full_address FROM ({RAW}) r",
    "valid_longitude": f"SELECT id, {LONGITUDE} AS longitude FROM ({RAW}) r",
    "valid_latitude": f"SELECT id, {LATITUDE} AS latitude FROM ({RAW}) r",
    "date_of_timestamp": f"SELECT id, CAST(ingested_date AS DATE) AS updated_date FROM ({RAW}) r",
    "sanitize_text": f"SELECT doc_id, {_sanitized('text')} AS safe_text FROM documents",
    "silver_conform": SILVER,
    "null_profile": "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ("country", "state", "state_province", "city", "phone", "entity_type")
    )
    + f" FROM ({RAW}) r",
    "value_distribution": f"""
        SELECT country, count(*) AS row_count FROM ({SILVER}) s GROUP BY country
    """,
    "value_distribution_sets": _distribution(["country", "state", "city"], SILVER),
    "geo_quality": f"""
        SELECT {COUNTRY} AS country, count(*) AS row_count,
               count(*) FILTER (longitude IS NULL) AS longitude_missing,
               count(*) FILTER (abs(longitude) > 180) AS longitude_rejected,
               count(*) FILTER (latitude IS NULL) AS latitude_missing,
               count(*) FILTER (abs(latitude) > 90) AS latitude_rejected,
               count(*) FILTER (abs(longitude) <= 180 AND abs(latitude) <= 90) AS both_usable
        FROM ({RAW}) r GROUP BY 1
    """,
    "quality_report": _quality(),
    "profile_runs": _profile("CAST(CAST(id AS BIGINT) % 3 AS VARCHAR) AS run,"),
    "profile_merged": _profile(""),
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql}) t" for name, sql in GOLD
    ),
    "dim_location": DIM_LOCATION,
    "dim_type": DIM_TYPE,
    "fact_table": FACT,
    "agg_by_type_location": AGG,
    "star_view": STAR,
    "star_view_sk": STAR_SK,
    "star_view_sql": STAR,
    "agg_view_sql": AGG,
    "union_pages": PAGES,
    "ordered_listing": f"""
        SELECT entity_type, name, id, city FROM ({RAW}) r ORDER BY entity_type, name, id
    """,
    "sample_rows": f"""
        SELECT id, country, state, state_province, city FROM ({RAW}) r ORDER BY id LIMIT 20
    """,
    "latest_per_key": """
        SELECT user_id, event_id, ts, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events) e WHERE rn = 1
    """,
    "snapshot_diff": DIFF,
    "snapshot_diff_digests": f"SELECT * FROM ({DIFF}) d WHERE action <> 'same'",
    "scd2_initial": INITIAL,
    "scd2_merge": _merged("close"),
    "scd2_merge_keep": _merged("keep"),
    "scd2_merge_replayed": _merged("close"),
    "scd2_history_table": _merged("close"),
    "scd2_from_history": HISTORY,
    "scd2_current": f"SELECT * FROM ({HISTORY}) h WHERE is_current",
    "scd2_as_of": f"""
        SELECT * FROM ({HISTORY}) h WHERE valid_from <= TIMESTAMP '2024-01-15'
            AND (valid_to IS NULL OR TIMESTAMP '2024-01-15' < valid_to)
    """,
    "scd2_point_in_time": f"""
        SELECT e.event_id, e.user_id, e.ts, e.event_type, e.value,
               h.event_type AS known_state, h.valid_from
        FROM events e LEFT JOIN ({DAILY_HISTORY}) h ON e.user_id = h.user_id
            AND h.valid_from <= e.ts AND (h.valid_to IS NULL OR e.ts < h.valid_to)
    """,
    "scd2_point_in_time_small": f"""
        SELECT e.event_id, e.user_id, e.ts, e.event_type, e.value,
               h.event_type AS known_state, h.valid_from
        FROM events e LEFT JOIN ({DAILY_HISTORY}) h ON e.user_id = h.user_id
            AND h.valid_from <= e.ts AND (h.valid_to IS NULL OR e.ts < h.valid_to)
    """,
    "scd2_check": VIOLATIONS,
    "snapshot_pages": RAW,
    "drift_rows": f"""
        SELECT id, name, CASE WHEN CAST(id AS BIGINT) % 5 <> 0 THEN longitude END AS longitude,
               CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN CAST(id AS BIGINT) % 7 ELSE -1 END AS rating,
               CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'unknown' END AS longitude_as_it_came
        FROM ({RAW}) r
    """,
    "drift_report": f"""
        SELECT 'rating' AS field, 'undeclared' AS kind, 'BIGINT' AS seen_type, count(*) AS row_count
        FROM ({RAW}) r WHERE CAST(id AS BIGINT) % 3 = 0
        UNION ALL SELECT 'longitude', 'ill-typed', 'STRING', count(*) FROM ({RAW}) r WHERE CAST(id AS BIGINT) % 5 = 0
    """,
    "stream_pages": RAW,
    "paged_snapshot": RAW,
    "page_report": PAGE_REPORT,
    "land_snapshot": _stamped(T2),
    "latest_snapshot": _stamped(T2),
    "roundtrip_partitioned": SILVER,
    "roundtrip_gold": FACT,
    "schema_evolution": f"""
        SELECT * REPLACE (
            CASE WHEN ingested_date >= TIMESTAMP '1998-01-01' THEN phone END AS phone,
            CASE WHEN ingested_date >= TIMESTAMP '1998-01-01' THEN latitude END AS latitude)
        FROM ({RAW}) r
    """,
    "dynamic_overwrite": f"""
        SELECT * REPLACE (CASE WHEN country = 'ASIA' THEN upper(name) ELSE name END AS name)
        FROM ({SILVER}) s
    """,
    "stream_silver": f"""
        SELECT * REPLACE (false AS is_current) FROM (SELECT {SILVER_COLUMNS} FROM ({_stamped(T1)}) a) o
        UNION ALL SELECT {SILVER_COLUMNS} FROM ({_stamped(T2)}) b
    """,
    "stream_silver_fact": FACT.replace(f"({SILVER}) s", f"(SELECT {SILVER_COLUMNS} FROM ({_stamped(T2)}) r) s"),
    "stream_scd2_close": _merged("close"),
    "runs_to_star_history": RUNS_HISTORY,
    "runs_to_star_view": RUNS_STAR,
    "runs_to_star_late": RUNS_HISTORY,
    "runs_to_star_rollup": RUNS_ROLLUP,
    "runs_to_star_dimensions": f"""
        SELECT DISTINCT country AS country_name, state AS state_name, city AS city_name, postal_code, longitude,
               latitude, NULL AS entity_type_name FROM {_SECOND}
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, k FROM (SELECT DISTINCT entity_type AS k FROM {_SECOND}) t
    """,
    "scd2_splice": _merged("close"),
    "star_versions": f"""
        SELECT e.event_id, e.user_id, e.ts, e.value, h.valid_from AS version_from, h.event_type
        FROM events e LEFT JOIN ({_merged("close")}) h ON e.user_id = h.user_id
            AND h.valid_from <= e.ts AND (h.valid_to IS NULL OR e.ts < h.valid_to)
    """,
    "star_as_of": f"""
        SELECT e.event_id, e.user_id, e.ts, e.value, h.event_type
        FROM events e LEFT JOIN ({_merged("close")}) h ON e.user_id = h.user_id
            AND h.valid_from <= TIMESTAMP '2024-01-25' AND (h.valid_to IS NULL OR TIMESTAMP '2024-01-25' < h.valid_to)
        WHERE e.ts <= TIMESTAMP '2024-01-25'
    """,
    "stream_scd2_late": _merged("close"),
    "stream_scd2_late_log": DAILY_HISTORY,
    "run_metrics": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS timed FROM ({sql}) t"
        for name, sql in (("silver", SILVER), *GOLD)
    ),
    "snapshot_arrays": RAW,
    "scd2_check_cut": VIOLATIONS,
    "scd2_point_in_time_cut": f"""
        SELECT e.event_id, e.user_id, e.day, e.event_type, h.event_type AS known_state, h.valid_from
        FROM (SELECT *, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events) e
        LEFT JOIN ({DAILY_HISTORY}) h ON e.user_id = h.user_id
            AND h.valid_from <= e.day AND (h.valid_to IS NULL OR e.day < h.valid_to)
    """,
    "stream_scd2": DAILY_HISTORY,
    "snapshot_to_star": STAR,
}
