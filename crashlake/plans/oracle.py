"""DuckDB statements that answer each registered query independently.

DuckDB only sees the driver's base tables, so every statement starts with the
fixture mapping as CTEs (the same column expressions the Spark side uses, see
sources.fixtures), then answers the question of SURVEY section 2 in plain SQL
of its own.  Conventions that keep both engines comparable:

* NULL ordering is spelled out (the reference sorts NULL as largest);
* integer SUMs and RANKs are cast to BIGINT;
* percentages use the exact integer half-up form.
"""

from __future__ import annotations

from crashlake.operators.dashboard import DETAIL_COLUMNS
from crashlake.plans import params as P
from crashlake.sources import fixtures as fx


def _cols(columns) -> str:
    return ",\n    ".join(f"{sql} AS {name}" for name, sql in columns)


CTE = {
    "fx_boroughs": f"SELECT {_cols(fx.BOROUGH_COLUMNS)} FROM region",
    "fx_orders": (
        "SELECT *, coalesce(further, 0) AS e\n"
        "  FROM orders JOIN customer ON o_custkey = c_custkey\n"
        "  JOIN nation ON c_nationkey = n_nationkey\n"
        "  LEFT JOIN (SELECT l_orderkey, unnest(range((count(*) + 4) // 5)) AS further\n"
        "             FROM lineitem GROUP BY l_orderkey) lines ON o_orderkey = l_orderkey"
    ),
    "fx_collisions": f"SELECT {_cols(fx.COLLISION_COLUMNS)} FROM fx_orders",
    "fx_lines": (
        f"SELECT {_cols(fx.LINE_COLUMNS)}, {', '.join(fx.LINE_PAYLOAD)}\n"
        f"  FROM (SELECT *, {fx.LINE_POSITION} AS position\n"
        "        FROM lineitem JOIN part ON l_partkey = p_partkey) numbered"
    ),
    "fx_vehicles": (
        f"SELECT collision_id, slot AS vehicle_order, {fx.VEHICLE_DESC} AS vehicle_type_desc FROM fx_lines"
    ),
    "fx_factors": (
        f"SELECT collision_id, slot AS factor_order, {fx.FACTOR_DESC} AS factor_desc FROM fx_lines"
    ),
}

# CTEs each one depends on (emitted in this order).
_ORDER = ["fx_boroughs", "fx_orders", "fx_collisions", "fx_lines", "fx_vehicles", "fx_factors"]
_DEPS = {"fx_collisions": ["fx_orders"], "fx_vehicles": ["fx_lines"], "fx_factors": ["fx_lines"]}


def with_fixtures(*names: str, extra: str = "") -> str:
    need = set(names)
    for n in names:
        need.update(_DEPS.get(n, []))
    # computed once each: the feed is read by many later steps
    once = ("fx_orders", "fx_lines", "fx_raw")
    parts = [f"{n} AS {'MATERIALIZED ' if n in once else ''}(\n  {CTE[n]}\n)" for n in _ORDER if n in need]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def pct(part: str, whole: str) -> str:
    return (f"CASE WHEN {whole} <> 0 THEN "
            f"CAST((20000 * CAST({part} AS BIGINT) + {whole}) // (2 * CAST({whole} AS BIGINT)) AS DOUBLE) / 100 END")


Q1 = with_fixtures("fx_boroughs", "fx_collisions") + f"""SELECT borough_name, on_street_name, n AS total_collisions, harm AS total_severity
FROM (SELECT *, rank() OVER (PARTITION BY borough_id ORDER BY harm DESC NULLS FIRST, n DESC) AS place
      FROM (SELECT borough_id, on_street_name, COUNT(*) AS n,
                   CAST(SUM(number_of_persons_killed + number_of_persons_injured) AS BIGINT) AS harm
            FROM fx_collisions
            WHERE on_street_name IS NOT NULL AND crash_date >= DATE '{P.Q1_FROM}' AND crash_date < DATE '{P.Q1_TO}'
            GROUP BY borough_id, on_street_name) streets) placed
LEFT JOIN fx_boroughs USING (borough_id) WHERE place <= 10"""

# Ids of the collisions of each kind, against which child rows are counted.
_KINDS = """deadly AS (SELECT collision_id FROM fx_collisions WHERE number_of_persons_killed > 0),
harmful AS (SELECT collision_id FROM fx_collisions WHERE number_of_persons_injured > 0
            EXCEPT SELECT collision_id FROM deadly)"""


def _count_in(kind: str) -> str:
    return f"COUNT(*) FILTER (WHERE collision_id IN (SELECT collision_id FROM {kind}))"


def _place(rate: str, rows: str) -> str:
    """1 + the number of rows with a higher rate."""
    return f"(SELECT COUNT(*) + 1 FROM {rows} higher WHERE higher.{rate} > {rows}.{rate})"


Q2 = with_fixtures("fx_collisions", "fx_factors", extra=_KINDS + f""",
counted AS (
    SELECT factor_desc, COUNT(*) AS n, {_count_in('deadly')} AS k FROM fx_factors
    WHERE factor_desc IS NOT NULL AND collision_id IN (SELECT collision_id FROM fx_collisions)
    GROUP BY factor_desc HAVING COUNT(*) >= 50
), rated AS (SELECT *, {pct('k', 'n')} AS rate FROM counted)""") + f"""SELECT factor_desc, n AS factor_collision_count,
       k AS fatal_collisions, rate AS fatal_rate_pct, {_place('rate', 'rated')} AS fatality_rank FROM rated"""

Q3 = with_fixtures("fx_collisions", "fx_vehicles", extra=_KINDS + f""",
counted AS (
    SELECT vehicle_type_desc, COUNT(*) AS n, {_count_in('deadly')} AS k, {_count_in('harmful')} AS h FROM fx_vehicles
    WHERE vehicle_order = 1 AND vehicle_type_desc IS NOT NULL AND collision_id IN (SELECT collision_id FROM fx_collisions)
    GROUP BY vehicle_type_desc HAVING COUNT(*) >= 50
), rated AS (SELECT *, {pct('k', 'n')} AS rate, {pct('h', 'n')} AS hurt FROM counted)""") + f"""SELECT vehicle_type_desc, n AS total_collisions,
       k AS fatal_collisions, h AS injury_collisions, rate AS fatal_rate_pct, hurt AS injury_rate_pct,
       {_place('rate', 'rated')} AS fatality_rank FROM rated"""


ORACLE: dict[str, str] = {
    "q1_street_severity_rank": Q1,
    "q2_factor_fatality_rank": Q2,
    "q3_vehicle_severity_rank": Q3,
}


def _chosen(borough: str, start: str = P.DASH_START, end: str = P.DASH_END) -> str:
    """CTE of the collisions inside the window and, unless all are asked for, the named borough."""
    named = "" if borough == "All" else f" AND borough_id = (SELECT borough_id FROM fx_boroughs WHERE borough_name = '{borough}')"
    return f"chosen AS (SELECT * FROM fx_collisions WHERE crash_date >= DATE '{start}' AND crash_date <= DATE '{end}'{named})"


def _total(column: str, alias: str) -> str:
    return f"CAST(IFNULL(SUM(number_of_{column}), 0) AS BIGINT) AS {alias}"


def _kpi(borough: str, start: str = P.DASH_START, end: str = P.DASH_END) -> str:
    return with_fixtures("fx_boroughs", "fx_collisions", extra=_chosen(borough, start, end)) + (
        f"SELECT COUNT(*) AS total_crashes, {_total('persons_injured', 'total_injured')}, {_total('persons_killed', 'total_killed')} FROM chosen")


_DAILY = {"persons_injured": "persons_injured", "persons_killed": "persons_killed", "pedestrians_injured": "pedestrians_injured",
          "cyclist_injured": "cyclists_injured", "motorist_injured": "motorists_injured"}


def _trend(borough: str) -> str:
    sums = ", ".join(_total(c, a) for c, a in _DAILY.items())
    return with_fixtures("fx_boroughs", "fx_collisions", extra=_chosen(borough)) + (
        f"SELECT crash_date AS day, COUNT(*) AS crashes, {sums} FROM chosen GROUP BY crash_date")


def _top_factors(borough: str, n: int) -> str:
    return with_fixtures("fx_boroughs", "fx_collisions", "fx_factors", extra=_chosen(borough)) + f"""SELECT factor, crashes
FROM (SELECT factor_desc AS factor, COUNT(*) AS crashes, row_number() OVER (ORDER BY COUNT(*) DESC, factor_desc) AS place
      FROM fx_factors WHERE collision_id IN (SELECT collision_id FROM chosen) GROUP BY factor_desc) counted
WHERE place <= {n}"""


def _latest(borough: str) -> str:
    shown = ", ".join(c for c in DETAIL_COLUMNS if c != "borough")
    return with_fixtures("fx_boroughs", "fx_collisions", extra=_chosen(borough)) + f"""SELECT {shown}, borough_name AS borough
FROM (SELECT *, row_number() OVER (ORDER BY crash_date DESC NULLS FIRST, crash_time DESC NULLS FIRST, collision_id DESC) AS place
      FROM chosen) newest LEFT JOIN fx_boroughs USING (borough_id)
WHERE place <= 500"""


_BOUNDS = "bounds AS (SELECT MIN(crash_date) AS min_date, MAX(crash_date) AS max_date FROM fx_collisions)"


def _window(end: str | None, start: str | None = None) -> str:
    e = "max_date" if end is None else f"DATE '{end}'"
    s = f"DATE '{start}'" if start else f"greatest(min_date, CAST({e} - INTERVAL 30 DAY AS DATE))"
    return with_fixtures("fx_collisions", extra=_BOUNDS) + f"""SELECT min_date, max_date, {s} AS start_date,
       CAST({e} AS DATE) AS end_date
FROM bounds"""


ORACLE.update({
    "d1_kpi_summary_all": _kpi("All"),
    "d1_kpi_summary_borough": _kpi(P.DASH_BOROUGH),
    "d1_kpi_summary_empty": _kpi("All", "1990-01-01", "1990-12-31"),
    "d2_daily_trend": _trend("All"),
    "d2_daily_trend_borough": _trend(P.DASH_BOROUGH),
    "d3_trend_metric": f"SELECT day, persons_injured AS value FROM ({_trend(P.DASH_BOROUGH)}) trend",
    "d4_crashes_by_borough": with_fixtures("fx_boroughs", "fx_collisions", extra=_chosen("All")) + (
        "SELECT borough_name AS borough, COUNT(*) AS crashes FROM chosen JOIN fx_boroughs USING (borough_id) "
        "WHERE borough_name <> 'UNKNOWN' GROUP BY borough_name"),
    "d5_top_factors": _top_factors("All", P.TOP_N),
    "d5_top_factors_borough": _top_factors(P.DASH_BOROUGH, 5),
    "d6_latest_collisions": _latest("All"),
    "d6_latest_collisions_borough": _latest(P.DASH_BOROUGH),
    "d7_date_bounds": with_fixtures("fx_collisions") + "SELECT MIN(crash_date) AS min_date, MAX(crash_date) AS max_date FROM fx_collisions",
    "d8_borough_list": with_fixtures("fx_boroughs") + "SELECT 'All' AS borough UNION ALL SELECT borough_name AS borough FROM fx_boroughs",
    "d9_default_window": _window(None),
    "d9_default_window_chosen_start": _window(P.D9_END, P.D9_START),
    "s4_export_csv": _latest("All"),
    "s6_layout": Q2,
    "s3_create_tables": with_fixtures("fx_boroughs", "fx_collisions", "fx_vehicles", "fx_factors") + "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, 0 AS n_before, COUNT({what}) AS n_rows FROM {source}" for name, what, source in (
            ("boroughs", "*", "fx_boroughs"), ("collisions", "*", "fx_collisions"), ("collision_vehicles", "*", "fx_vehicles"),
            ("collision_factors", "*", "fx_factors"), ("vehicle_types", "DISTINCT vehicle_type_desc", "fx_vehicles"),
            ("factors", "DISTINCT factor_desc", "fx_factors"))),
    "d9_default_window_chosen_end": _window(P.D9_END),
    "s5_run_sql": with_fixtures("fx_boroughs", "fx_collisions", extra=_chosen("All")) + (
        "SELECT borough_name, COUNT(*) AS crashes FROM chosen JOIN fx_boroughs USING (borough_id) GROUP BY borough_name"),
})


# --- the dirty feed and its cleaning, in DuckDB terms ------------------------------

from crashlake.schema import COUNT_COLUMNS, FACTOR_COLUMNS, FEED_COLUMNS, NA_TOKENS, VEHICLE_COLUMNS  # noqa: E402


def _na(col: str) -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"(CASE WHEN {col} IN ({tokens}) THEN NULL ELSE {col} END)"


def _strip(expr: str) -> str:
    return f"NULLIF(regexp_replace({expr}, '^\\s+|\\s+$', '', 'g'), '')"


_DATE_FMTS = "['%m/%d/%Y', '%Y-%m-%d', '%Y-%m-%dT%H:%M:%S.%g', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S']"
_TIME_FMTS = "['%H:%M', '%H:%M:%S', '%I:%M %p', '%I:%M:%S %p']"

_slot_pivot = ", ".join(f"{sql} AS {name}" for name, sql in fx.SLOT_PIVOT)
_raw_cols = ",\n    ".join(f"{sql} AS {name}" for name, sql in fx.RAW_COLUMNS + fx.raw_slot_columns())

CTE["fx_raw"] = f"""SELECT {_raw_cols}
  FROM (SELECT * FROM fx_orders JOIN region ON n_regionkey = r_regionkey
        JOIN (SELECT unnest([0, 1]) AS c) copies ON c = 0 OR o_orderkey % 20 = 0
        LEFT JOIN (SELECT collision_id AS slot_key, {_slot_pivot} FROM fx_lines GROUP BY collision_id) s
          ON {fx.COLLISION_ID} = s.slot_key) wide"""


def _count(c: str) -> str:
    return f"TRY_CAST(round(TRY_CAST({_na(c)} AS DOUBLE)) AS INT)"


def _issue_list() -> str:
    checks = [
        (f"{_na('latitude')} IS NOT NULL AND TRY_CAST({_na('latitude')} AS DECIMAL(9,6)) IS NULL", "latitude_invalid"),
        (f"{_na('longitude')} IS NOT NULL AND TRY_CAST({_na('longitude')} AS DECIMAL(9,6)) IS NULL", "longitude_invalid"),
        (f"length(regexp_replace({_na('zip_code')}, '^(\\d+)\\.0+$', '\\1')) > 10", "zip_code_too_long"),
        (f"length({_strip(_na('borough'))}) > 50", "borough_too_long"),
    ]
    for c in COUNT_COLUMNS:
        checks.append((f"{_na(c)} IS NOT NULL AND {_count(c)} IS NULL", f"{c}_invalid"))
        checks.append((f"{_count(c)} < 0", f"{c}_negative"))
    items = ", ".join(f"CASE WHEN {cond} THEN '{code}' END" for cond, code in checks)
    return f"concat_ws(',', {items})"


CTE["fx_feed"] = f"""SELECT * FROM (SELECT src_seq,
    CAST(trunc(TRY_CAST({_na('collision_id')} AS DOUBLE)) AS BIGINT) AS collision_id,
    CAST(try_strptime({_na('crash_date')}, {_DATE_FMTS}) AS DATE) AS crash_date,
    strftime(try_strptime({_na('crash_time')}, {_TIME_FMTS}), '%H:%M:%S') AS crash_time,
    {_strip(_na('borough'))} AS borough,
    regexp_replace({_na('zip_code')}, '^(\\d+)\\.0+$', '\\1') AS zip_code,
    TRY_CAST({_na('latitude')} AS DECIMAL(9,6)) AS latitude,
    TRY_CAST({_na('longitude')} AS DECIMAL(9,6)) AS longitude,
    {_na('location')} AS location,
    {_na('on_street_name')} AS on_street_name,
    {_na('off_street_name')} AS off_street_name,
    {_na('cross_street_name')} AS cross_street_name,
    {', '.join(f'{_count(c)} AS {c}' for c in COUNT_COLUMNS)},
    {', '.join(f'{_na(c)} AS {c}' for c in VEHICLE_COLUMNS + FACTOR_COLUMNS)},
    {_issue_list()} AS issues
  FROM fx_raw) typed
 WHERE collision_id IS NOT NULL"""

CTE["fx_first"] = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY collision_id ORDER BY src_seq) AS rn
  FROM fx_feed) numbered WHERE rn = 1"""


def _long(columns, slot_col: str, value_col: str, extra: str = "") -> str:
    arms = " UNION ALL ".join(
        f"SELECT collision_id, src_seq, {i} AS {slot_col}, {_strip(c)} AS {value_col} FROM fx_feed"
        for i, c in enumerate(columns, start=1))
    return f"SELECT * FROM ({arms}) slots WHERE {value_col} IS NOT NULL{extra}"


CTE["fx_vvalues"] = _long(VEHICLE_COLUMNS, "vehicle_order", "vehicle_type_desc")
CTE["fx_fvalues"] = _long(FACTOR_COLUMNS, "factor_order", "factor_desc",
                          " AND upper(factor_desc) <> 'UNSPECIFIED'")
CTE["fx_vlong"] = """SELECT collision_id, vehicle_order, vehicle_type_desc FROM (
  SELECT *, row_number() OVER (PARTITION BY collision_id, vehicle_order ORDER BY src_seq) AS rn
  FROM fx_vvalues) numbered WHERE rn = 1"""
CTE["fx_flong"] = """SELECT collision_id, factor_order, factor_desc FROM (
  SELECT *, row_number() OVER (PARTITION BY collision_id, factor_order ORDER BY src_seq) AS rn
  FROM fx_fvalues) numbered WHERE rn = 1"""
CTE["fx_bnames"] = "SELECT DISTINCT borough AS borough_name FROM fx_feed WHERE borough IS NOT NULL AND length(borough) <= 50"
CTE["fx_bad"] = "SELECT collision_id, issues FROM fx_first WHERE issues <> ''"

_ORDER += ["fx_raw", "fx_feed", "fx_first", "fx_vvalues", "fx_fvalues", "fx_vlong", "fx_flong",
           "fx_bnames", "fx_bad"]
_DEPS.update({
    "fx_raw": ["fx_orders", "fx_lines"], "fx_feed": ["fx_orders", "fx_lines", "fx_raw"],
    "fx_first": ["fx_orders", "fx_lines", "fx_raw", "fx_feed"],
    "fx_vvalues": ["fx_orders", "fx_lines", "fx_raw", "fx_feed"], "fx_fvalues": ["fx_orders", "fx_lines", "fx_raw", "fx_feed"],
    "fx_vlong": ["fx_orders", "fx_lines", "fx_raw", "fx_feed", "fx_vvalues"],
    "fx_flong": ["fx_orders", "fx_lines", "fx_raw", "fx_feed", "fx_fvalues"],
    "fx_bnames": ["fx_orders", "fx_lines", "fx_raw", "fx_feed"],
    "fx_bad": ["fx_orders", "fx_lines", "fx_raw", "fx_feed", "fx_first"],
})

_COUNTS = ", ".join(COUNT_COLUMNS)

ORACLE.update({
    "c1_c5_clean_feed": with_fixtures("fx_feed") + f"""SELECT collision_id, src_seq, crash_date, crash_time,
       borough, zip_code, latitude, longitude, off_street_name, {_COUNTS}, issues FROM fx_feed""",
    "n1_borough_names": with_fixtures("fx_bnames") + "SELECT borough_name FROM fx_bnames",
    "n2_collisions_table": with_fixtures("fx_first", "fx_bnames") + f"""SELECT collision_id, crash_date, crash_time,
       b.borough_name, zip_code, latitude, longitude, on_street_name, cross_street_name, off_street_name,
       {_COUNTS}, issues
FROM fx_first f LEFT JOIN fx_bnames b ON f.borough = b.borough_name""",
    "n3_vehicles_long": with_fixtures("fx_vlong") + "SELECT * FROM fx_vlong",
    "n4_factors_long": with_fixtures("fx_flong") + "SELECT * FROM fx_flong",
    "n5_vehicle_types": with_fixtures("fx_vvalues") + "SELECT DISTINCT vehicle_type_desc FROM fx_vvalues",
    "n5_dimension_ids": with_fixtures("fx_bnames", "fx_vvalues", "fx_fvalues") + """SELECT dimension, n AS n_rows, n AS n_ids,
       CAST(CASE WHEN n > 0 THEN 1 END AS BIGINT) AS min_id, CAST(CASE WHEN n > 0 THEN n END AS BIGINT) AS max_id
FROM (SELECT 'boroughs' AS dimension, COUNT(*) AS n FROM fx_bnames
      UNION ALL SELECT 'vehicle_types', COUNT(DISTINCT vehicle_type_desc) FROM fx_vvalues
      UNION ALL SELECT 'factors', COUNT(DISTINCT factor_desc) FROM fx_fvalues) d""",
    "n6_normalize_feed": with_fixtures("fx_bnames", "fx_first", "fx_vvalues", "fx_fvalues", "fx_vlong",
                                       "fx_flong", "fx_bad") + """SELECT 'boroughs' AS table_name, COUNT(*) AS n_rows FROM fx_bnames
UNION ALL SELECT 'collisions', COUNT(*) FROM fx_first WHERE issues = ''
UNION ALL SELECT 'vehicle_types', COUNT(DISTINCT vehicle_type_desc) FROM fx_vvalues
UNION ALL SELECT 'collision_vehicles', COUNT(*) FROM fx_vlong WHERE collision_id NOT IN (SELECT collision_id FROM fx_bad)
UNION ALL SELECT 'factors', COUNT(DISTINCT factor_desc) FROM fx_fvalues
UNION ALL SELECT 'collision_factors', COUNT(*) FROM fx_flong WHERE collision_id NOT IN (SELECT collision_id FROM fx_bad)
UNION ALL SELECT 'rejects', COUNT(*) FROM (SELECT unnest(string_split(issues, ',')) FROM fx_bad) r""",
    "n6_collisions": with_fixtures("fx_first", "fx_bnames") + f"""SELECT collision_id, crash_date, crash_time, borough_name,
       zip_code, latitude, longitude, location, on_street_name, off_street_name, cross_street_name, {_COUNTS}
FROM fx_first LEFT JOIN fx_bnames ON borough = borough_name WHERE issues = ''""",
    "n6_collision_factors": with_fixtures("fx_flong", "fx_bad") + """SELECT collision_id, factor_order, factor_desc
FROM fx_flong WHERE collision_id NOT IN (SELECT collision_id FROM fx_bad)""",
    "s2_append_new": with_fixtures("fx_first", "fx_vlong", "fx_flong", "fx_bad") + """SELECT 'collisions' AS table_name, collision_id,
       0 AS slot, CAST(crash_date AS VARCHAR) AS value FROM fx_first WHERE issues = ''
UNION ALL SELECT 'collision_vehicles', collision_id, vehicle_order, vehicle_type_desc FROM fx_vlong
WHERE collision_id NOT IN (SELECT collision_id FROM fx_bad)
UNION ALL SELECT 'collision_factors', collision_id, factor_order, factor_desc FROM fx_flong
WHERE collision_id NOT IN (SELECT collision_id FROM fx_bad)
UNION ALL SELECT 'rejects', collision_id, 0, unnest(string_split(issues, ',')) FROM fx_bad""",
    "s1_read_feed": with_fixtures("fx_raw") + f"""SELECT {', '.join(f"NULLIF({c}, '') AS {c}" for c in FEED_COLUMNS if c != 'on_street_name')},
       CASE WHEN src_seq % 3 = 0 THEN on_street_name || ' "A", ""' WHEN src_seq % 3 = 1
            THEN on_street_name || ',' || chr(10) || on_street_name ELSE on_street_name END AS on_street_name, FALSE AS broken
FROM fx_raw""",
    "n6_rejects": with_fixtures("fx_bad") + "SELECT collision_id, unnest(string_split(issues, ',')) AS reason FROM fx_bad",
    "n6_collision_vehicles": with_fixtures("fx_vlong", "fx_bad") + """SELECT collision_id, vehicle_order, vehicle_type_desc
FROM fx_vlong WHERE collision_id NOT IN (SELECT collision_id FROM fx_bad)""",
})


# --- integrity checks ---------------------------------------------------------------

def _k_raw() -> str:
    """Violations of the unchecked feed tables: duplicate ids and duplicate
    (id, slot) pairs, negative counts.  (Dimensions are distinct by
    construction and every other rule holds on this feed.)"""
    neg = " UNION ALL ".join(
        f"SELECT 'collisions' AS table_name, 'range({c}>=0)' AS rule, CAST(collision_id AS VARCHAR) AS key, "
        f"CAST(1 AS BIGINT) AS n_rows FROM fx_feed WHERE {c} < 0" for c in COUNT_COLUMNS)
    return with_fixtures("fx_feed", "fx_vvalues", "fx_fvalues") + f"""SELECT 'collisions' AS table_name, 'unique(collision_id)' AS rule,
       CAST(collision_id AS VARCHAR) AS key, COUNT(*) AS n_rows
FROM fx_feed GROUP BY collision_id HAVING COUNT(*) > 1
UNION ALL
SELECT 'collision_vehicles', 'unique(collision_id,vehicle_order)', collision_id || '|' || vehicle_order, COUNT(*)
FROM fx_vvalues GROUP BY collision_id, vehicle_order HAVING COUNT(*) > 1
UNION ALL
SELECT 'collision_factors', 'unique(collision_id,factor_order)', collision_id || '|' || factor_order, COUNT(*)
FROM fx_fvalues GROUP BY collision_id, factor_order HAVING COUNT(*) > 1
UNION ALL {neg}"""


def _k_fixture() -> str:
    """On the fixture tables only references can fail: lines whose order
    is missing from orders."""
    arms = []
    for table, cte in (("collision_vehicles", "fx_vehicles"), ("collision_factors", "fx_factors")):
        arms.append(f"""SELECT '{table}' AS table_name, 'foreign_key(collision_id->collisions.collision_id)' AS rule,
       CAST(collision_id AS VARCHAR) AS key, COUNT(*) AS n_rows
FROM {cte} WHERE collision_id NOT IN (SELECT collision_id FROM fx_collisions)
GROUP BY collision_id""")
    return with_fixtures("fx_collisions", "fx_vehicles", "fx_factors") + "\nUNION ALL\n".join(arms)


def _k_planted() -> str:
    """The violations put into the fixture tables, found from the same conditions."""
    c = "SELECT *, collision_id % 499 = 0 AS lost FROM fx_collisions"
    return with_fixtures("fx_boroughs", "fx_collisions", "fx_vehicles", "fx_factors", extra=f"""c AS ({c}),
known AS (SELECT collision_id FROM c WHERE NOT lost),
v AS (SELECT collision_id + CASE WHEN collision_id % 541 = 0 THEN {2**50} ELSE 0 END AS id, collision_id % 521 = 0 AS off,
             vehicle_order + CASE WHEN collision_id % 521 = 0 THEN 5 ELSE 0 END AS slot, collision_id % 523 = 0 AS bare FROM fx_vehicles),
f AS (SELECT *, CASE WHEN collision_id % 547 = 0 THEN 2 ELSE 1 END AS times FROM fx_factors)""") + """
SELECT 'boroughs' AS table_name, 'length(borough_name<=50)' AS rule, CAST(borough_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n_rows
FROM fx_boroughs WHERE borough_id = 1 AND 20 * length(borough_name) > 50
UNION ALL SELECT 'collisions', 'not_null(collision_id)', '<null>', 1 FROM c WHERE lost
UNION ALL SELECT 'collisions', 'unique(collision_id)', '<null>', COUNT(*) FROM c WHERE lost HAVING COUNT(*) > 1
UNION ALL SELECT 'collisions', 'length(zip_code<=10)', CASE WHEN lost THEN '<null>' ELSE CAST(collision_id AS VARCHAR) END, 1 FROM c WHERE collision_id % 503 = 0
UNION ALL SELECT 'collisions', 'range(number_of_persons_injured>=0)', CASE WHEN lost THEN '<null>' ELSE CAST(collision_id AS VARCHAR) END, 1 FROM c WHERE collision_id % 509 = 0
UNION ALL SELECT 'collision_vehicles', 'range(vehicle_order 1..5)', id || '|' || slot, 1 FROM v WHERE off
UNION ALL SELECT 'collision_vehicles', 'not_null(vehicle_type_id)', id || '|' || slot, 1 FROM v WHERE bare
UNION ALL SELECT 'collision_vehicles', 'foreign_key(collision_id->collisions.collision_id)', CAST(id AS VARCHAR), COUNT(*) FROM v WHERE id NOT IN (SELECT collision_id FROM known) GROUP BY id
UNION ALL SELECT 'collision_factors', 'foreign_key(collision_id->collisions.collision_id)', CAST(collision_id AS VARCHAR), CAST(SUM(times) AS BIGINT) FROM f WHERE collision_id NOT IN (SELECT collision_id FROM known) GROUP BY collision_id
UNION ALL SELECT 'collision_factors', 'unique(collision_id,factor_order)', collision_id || '|' || factor_order, times FROM f WHERE times > 1"""


_DELETE = f"""gone AS (SELECT collision_id FROM fx_collisions WHERE crash_date < DATE '{P.DELETE_BEFORE}')"""

ORACLE.update({
    "k1_k4_validate_raw": _k_raw(),
    "k1_k4_validate_fixture": _k_fixture(),
    "k1_k4_validate_planted": _k_planted(),
    "k5_delete_cascade": with_fixtures("fx_collisions", "fx_vehicles", "fx_factors", extra=_DELETE) + """SELECT 'collisions' AS table_name, collision_id, 0 AS slot FROM fx_collisions WHERE collision_id NOT IN (SELECT collision_id FROM gone)
UNION ALL SELECT 'collision_vehicles', collision_id, vehicle_order FROM fx_vehicles WHERE collision_id NOT IN (SELECT collision_id FROM gone)
UNION ALL SELECT 'collision_factors', collision_id, factor_order FROM fx_factors WHERE collision_id NOT IN (SELECT collision_id FROM gone)""",
})


# --- star schema ---------------------------------------------------------------------

_STG = """stg AS (
    SELECT c.collision_id, c.crash_date, c.crash_time, b.borough_name AS borough, b.borough_id,
           c.zip_code, c.on_street_name, c.cross_street_name, c.latitude, c.longitude,
           c.number_of_persons_injured AS persons_injured, c.number_of_persons_killed AS persons_killed,
           c.number_of_pedestrians_injured AS pedestrians_injured,
           c.number_of_pedestrians_killed AS pedestrians_killed,
           c.number_of_cyclist_injured AS cyclists_injured, c.number_of_cyclist_killed AS cyclists_killed,
           c.number_of_motorist_injured AS motorists_injured, c.number_of_motorist_killed AS motorists_killed
    FROM fx_collisions c LEFT JOIN fx_boroughs b ON c.borough_id = b.borough_id
)"""

_DATE_KEY = "CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INT)"

_FACT = _STG + """, veh AS (
    SELECT collision_id, COUNT(*) AS vehicle_count FROM fx_vehicles GROUP BY collision_id
), fac AS (
    SELECT collision_id, COUNT(DISTINCT factor_desc) AS factor_count FROM fx_factors GROUP BY collision_id
), fact AS (
    SELECT s.collision_id, """ + _DATE_KEY.format(d="s.crash_date") + """ AS date_key,
           s.borough_id AS borough_key, s.zip_code, s.on_street_name, s.cross_street_name, s.latitude, s.longitude,
           persons_injured, persons_killed, pedestrians_injured, pedestrians_killed,
           cyclists_injured, cyclists_killed, motorists_injured, motorists_killed,
           CAST(COALESCE(vehicle_count, 0) AS BIGINT) AS vehicle_count,
           CAST(COALESCE(factor_count, 0) AS BIGINT) AS factor_count
    FROM stg s LEFT JOIN veh ON s.collision_id = veh.collision_id
    LEFT JOIN fac ON s.collision_id = fac.collision_id
)"""

_LOC = "zip_code, on_street_name, cross_street_name, latitude, longitude"

ORACLE.update({
    "t1_dim_date": with_fixtures("fx_collisions", extra=_BOUNDS) + """SELECT """ + _DATE_KEY.format(d="d") + """ AS date_key,
       CAST(d AS DATE) AS full_date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month,
       CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(CAST(min_date AS TIMESTAMP), CAST(max_date AS TIMESTAMP), INTERVAL 1 DAY)) AS d
      FROM bounds) days""",
    "t2_dim_borough": with_fixtures("fx_boroughs") + "SELECT borough_id AS borough_key, borough_name FROM fx_boroughs",
    "t3_dim_location": with_fixtures("fx_collisions") + f"SELECT DISTINCT {_LOC} FROM fx_collisions",
    "t3_location_keys": with_fixtures("fx_collisions") + f"""SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids,
       CAST(CASE WHEN COUNT(*) > 0 THEN 1 END AS BIGINT) AS min_id, CAST(CASE WHEN COUNT(*) > 0 THEN COUNT(*) END AS BIGINT) AS max_id
FROM (SELECT DISTINCT {_LOC} FROM fx_collisions) l""",
    "t4_dim_vehicle": with_fixtures("fx_vehicles") + "SELECT DISTINCT vehicle_type_desc FROM fx_vehicles",
    "t5_dim_factor": with_fixtures("fx_factors") + "SELECT DISTINCT factor_desc FROM fx_factors",
    "t6_stg_collisions": with_fixtures("fx_boroughs", "fx_collisions", extra=_STG) + "SELECT * FROM stg",
    "t6_stg_vehicles": with_fixtures("fx_vehicles") + "SELECT collision_id, vehicle_order, vehicle_type_desc FROM fx_vehicles",
    "t6_stg_factors": with_fixtures("fx_factors") + "SELECT collision_id, factor_order, factor_desc FROM fx_factors",
    "t6_stg_boroughs": with_fixtures("fx_boroughs") + "SELECT borough_id, borough_name FROM fx_boroughs",
    "t7_fact_collisions": with_fixtures("fx_boroughs", "fx_collisions", "fx_vehicles", "fx_factors", extra=_FACT)
    + "SELECT * FROM fact",
    "t7_fact_grain": with_fixtures("fx_boroughs", "fx_collisions", "fx_vehicles", "fx_factors", extra=_FACT)
    + """SELECT 'fact_rows' AS metric, COUNT(*) AS value FROM fact
UNION ALL SELECT 'duplicate_keys', COUNT(*) FROM (SELECT collision_id FROM fact GROUP BY collision_id HAVING COUNT(*) > 1) d
UNION ALL SELECT 'collision_rows', COUNT(*) FROM fx_collisions""",
    "t8_fact_collision_vehicles": with_fixtures("fx_boroughs", "fx_collisions", "fx_vehicles", "fx_factors", extra=_FACT)
    + """SELECT v.collision_id, v.vehicle_order, v.vehicle_type_desc, f.date_key, f.borough_key, f.zip_code, f.on_street_name, f.cross_street_name, f.latitude, f.longitude
FROM fx_vehicles v LEFT JOIN fact f ON v.collision_id = f.collision_id""",
    "t8_fact_collision_factors": with_fixtures("fx_boroughs", "fx_collisions", "fx_vehicles", "fx_factors", extra=_FACT)
    + """SELECT x.collision_id, x.factor_order, x.factor_desc, f.date_key, f.borough_key, f.zip_code, f.on_street_name, f.cross_street_name, f.latitude, f.longitude
FROM fx_factors x LEFT JOIN fact f ON x.collision_id = f.collision_id""",
})
ORACLE["s1_read_one_file"] = ORACLE["s1_read_feed"]
ORACLE["d7_date_bounds_indexed"] = ORACLE["d7_date_bounds"]
ORACLE["s2_touched_rows"] = with_fixtures("fx_collisions", "fx_factors") + """SELECT f.collision_id, f.factor_order FROM fx_factors f
WHERE f.collision_id IN (SELECT unnest([MIN(collision_id), MIN(collision_id) + 1, MAX(collision_id), MAX(collision_id) + 1]) FROM fx_collisions)"""
ORACLE |= {f"{name}_rollup": ORACLE[plain] for name, plain in (
    ("d1_kpi_summary", "d1_kpi_summary_borough"), ("d2_daily_trend", "d2_daily_trend"),
    ("d3_trend_metric", "d3_trend_metric"), ("d4_crashes_by_borough", "d4_crashes_by_borough"))}
ORACLE |= {"k5_delete_cascade_store": ORACLE["k5_delete_cascade"], "s6_compacted": ORACLE["s6_layout"], "s6_clustered": ORACLE["d5_top_factors_borough"]}
