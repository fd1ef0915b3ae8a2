"""SQL that states the expected result of each query, for an independent engine.

Counts are never negative here, so a mean rounded half up is
(2 * sum + n) // (2 * n) and a ratio in hundredths (200 * a + b) // (2 * b),
all in whole numbers; hundredths become doubles in the last select.
"""

from __future__ import annotations

from peerline.registry.expected import columns, metrics

QUARTER_SQL = "CAST(year({d}) * 100 + quarter({d}) * 3 AS INTEGER)"
PEER_LIST = ", ".join(f"'NATION_{i}'" for i in range(1, 10))
LABEL_SQL = (
    "CASE quarter_ending % 100 WHEN 3 THEN 'q1' WHEN 6 THEN 'q2' WHEN 9 THEN 'q3' WHEN 12 THEN 'q4' ELSE 'q0' END"
)


def _quarter(date: str) -> str:
    return QUARTER_SQL.format(d=date)


def _orders(part: str) -> str:
    return f"""SELECT n_nationkey, n_name, {_quarter('o_orderdate')} AS quarter_ending, {part} AS part
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _lines(part: str, status: str | None = None) -> str:
    if status:
        part = f"CASE WHEN l_linestatus = '{status}' THEN {part} END"
    return f"""SELECT n_nationkey, n_name, {_quarter('l_shipdate')} AS quarter_ending, {part} AS part
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""


def _band(parts: int) -> str:
    return f"CAST(least(floor((l_quantity - 1) * {parts} / 50), {parts - 1}) AS INTEGER)"


def _wide(table: str, events: str) -> str:
    """CTE `wide`: counts per nation and quarter, zero as NULL."""
    total, *parts = columns(table)
    counts = ", ".join(f"nullif(count(*) FILTER (WHERE part = {k}), 0) AS {c}" for k, c in enumerate(parts))
    return f"""events AS ({events}),
    wide AS (SELECT n_nationkey, n_name, quarter_ending, count(*) AS {total}, {counts}
        FROM events GROUP BY ALL)"""


_A1_WIDE = f"""events AS ({_orders('o_orderstatus')}),
    residents AS (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1),
    wide AS (SELECT n_nationkey, n_name, quarter_ending,
            count(*) AS initial_assessments,
            nullif(count(*) FILTER (WHERE part IN ('F', 'O')), 0) AS owed_prevention_or_relief_duty,
            nullif(count(*) FILTER (WHERE part = 'F'), 0) AS prevention_duty_owed,
            nullif(count(*) FILTER (WHERE part = 'O'), 0) AS relief_duty_owed,
            max(customers) AS households_in_area_000s
        FROM events JOIN residents ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name, quarter_ending)"""

_EVENTS = {
    "tab_a2p": _lines(_band(13), "F"),
    "tab_a2r": _lines(_band(13), "O"),
    "tab_p1": _lines("CAST(least(round(l_tax * 100), 8) AS INTEGER)", "F"),
    "tab_r1": _lines("CAST(least(round(l_discount * 100), 9) AS INTEGER)", "O"),
    "tab_ta1": _lines(_band(20)),
    "tab_ta2": _orders("CAST(least(floor(o_totalprice / 62500.0), 7) AS INTEGER)"),
}


def _wide_of(table: str) -> str:
    return _A1_WIDE if table == "tab_a1" else _wide(table, _EVENTS[table])


def _both(table: str) -> str:
    """CTEs up to `rounded`: the focal rows and the rounded peer means, in units."""
    names = columns(table)
    means = ", ".join(f"CAST((2 * sum({c}) + count({c})) // nullif(2 * count({c}), 0) AS BIGINT) AS {c}" for c in names)
    listed = ", ".join(names)
    return f"""{_wide_of(table)},
    means AS (SELECT quarter_ending, {means} FROM wide WHERE n_name IN ({PEER_LIST}) GROUP BY 1),
    rounded AS (
        SELECT 'N001' AS system_id, 'Neighbouring LA' AS local_authority, {listed}, quarter_ending FROM means
        UNION
        SELECT CAST(n_nationkey AS VARCHAR), n_name, {listed}, quarter_ending FROM wide WHERE n_name = 'NATION_0')"""


def _metrics(table: str) -> list[tuple[str, str]]:
    """(name, hundredths) of every metric."""
    out = []
    for column, base, name, ratio in metrics(table):
        out.append((name, f"100 * {column}"))
        if base:
            out.append((ratio, f"(200 * {column} + {base}) // nullif(2 * {base}, 0)"))
    return out


def _long(table: str) -> str:
    selects = " UNION ALL ".join(
        f"SELECT local_authority, quarter_ending, '{name}' AS metrics, {value} AS v FROM rounded"
        for name, value in _metrics(table)
    )
    return f"{_both(table)}, long AS ({selects})"


def _sides(table: str) -> str:
    return f"""{_long(table)}, sides AS (SELECT quarter_ending, metrics,
        max(v) FILTER (WHERE local_authority = 'NATION_0') AS f,
        max(v) FILTER (WHERE local_authority = 'Neighbouring LA') AS p
        FROM long GROUP BY 1, 2)"""


_PERIOD = f"""quarter_ending, CAST(quarter_ending // 100 AS INTEGER) AS qtr_year, {LABEL_SQL} AS year_qtr,
    CAST(quarter_ending % 100 AS INTEGER) AS qtr_month"""


def _benchmark(table: str) -> str:
    return f"""WITH {_sides(table)} SELECT {_PERIOD}, metrics, f / 100.0::DOUBLE AS focal,
        p / 100.0::DOUBLE AS peer_group, (f - p) / 100.0::DOUBLE AS difference FROM sides"""


_A1_COLUMNS = ", ".join(columns("tab_a1"))
_A1_RATIOS = ", ".join(f"({value}) / 100.0::DOUBLE AS {name}" for name, value in _metrics("tab_a1"))
_UNITS = f"SELECT CAST(n_nationkey AS VARCHAR) AS system_id, n_name AS local_authority, {_A1_COLUMNS}, quarter_ending"

_ORDER_ROWS = f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority AS priority,
    {_quarter('o_orderdate')} AS quarter_ending FROM orders"""
_HELD_ROWS = f"""SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN priority = '5-LOW' THEN 'LOW' ELSE priority END AS priority, quarter_ending
    FROM ({_ORDER_ROWS}) WHERE o_orderstatus <> 'P'"""
_DELTA = f"WITH new AS ({_ORDER_ROWS}), old AS ({_HELD_ROWS})"

_GAPPY = """SELECT o_orderkey,
    CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS system_id,
    CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS priority,
    CASE WHEN o_totalprice > 250000 THEN o_orderstatus END AS status,
    CASE WHEN o_orderkey < 10 THEN 'first' END AS remark FROM orders"""

_PART_TEXT = """SELECT p_partkey, p_partkey % 8 AS kind, p_size,
    CASE p_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN ' ' || p_size || ' ' WHEN 2 THEN '1,' || lpad(CAST(p_size AS VARCHAR), 3, '0')
        WHEN 3 THEN p_size || 'e2' WHEN 4 THEN '-' WHEN 5 THEN CAST(p_size AS VARCHAR) || p_size
        WHEN 6 THEN p_size || '.0' ELSE '-' || p_size END AS cell FROM part"""
_PART_NUMBER = """CASE kind WHEN 1 THEN p_size WHEN 3 THEN p_size * 100
    WHEN 5 THEN CAST(CAST(p_size AS VARCHAR) || p_size AS BIGINT) WHEN 6 THEN p_size WHEN 7 THEN -p_size END"""

_SHEETS = f"""SELECT 'E' || o_custkey AS system_id, 'Customer ' || o_custkey AS local_authority,
    count(*) AS initial_assessments,
    nullif(count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')), 0) AS owed_prevention_or_relief_duty,
    nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS prevention_duty_owed,
    nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS relief_duty_owed,
    o_custkey / 1000.0::DOUBLE AS households_in_area_000s,
    CAST({_quarter('o_orderdate')} + 2500 AS INTEGER) AS quarter_ending, 0 AS is_neighbouring_la
    FROM orders GROUP BY o_custkey, {_quarter('o_orderdate')}
    UNION ALL
    SELECT DISTINCT 'E92000001', 'ENGLAND', 100, 90, 50, 40, 25.5::DOUBLE,
        CAST({_quarter('o_orderdate')} + 2500 AS INTEGER), 0 FROM orders"""



def _cleaned(table: str) -> str:
    """Sheets in which measure k counts the orders whose key leaves k, and the national total."""
    names = columns(table)
    n, quarter = len(names), f"CAST({_quarter('o_orderdate')} + 2500 AS INTEGER)"
    counts = ", ".join(f"nullif(count(*) FILTER (WHERE o_orderkey % {n} = {k}), 0) AS {c}" for k, c in enumerate(names))
    totals = ", ".join(str(1000 + k) for k in range(n))
    return f"""SELECT 'E' || o_custkey AS system_id, 'Customer ' || o_custkey AS local_authority, {counts},
        {quarter} AS quarter_ending, 0 AS is_neighbouring_la FROM orders GROUP BY o_custkey, {_quarter('o_orderdate')}
        UNION ALL SELECT DISTINCT 'E92000001', 'ENGLAND', {totals}, {quarter}, 0 FROM orders"""


ORACLE: dict[str, str] = {
    "peer_benchmark_assessment": _benchmark("tab_a1"),
    "peer_benchmark_prevention": _benchmark("tab_a2p"),
    "peer_benchmark_relief": _benchmark("tab_a2r"),
    "peer_benchmark_ended_prevention": _benchmark("tab_p1"),
    "peer_benchmark_ended_relief": _benchmark("tab_r1"),
    "peer_benchmark_accommodation": _benchmark("tab_ta1"),
    "peer_benchmark_composition": _benchmark("tab_ta2"),
    "peer_quarterly_avg": f"WITH {_both('tab_a1')} SELECT * FROM means",
    "group_labels": f"""WITH {_both('tab_a1')} SELECT 'N001' AS system_id,
        'Neighbouring LA' AS local_authority, * FROM means""",
    "focal_union_peer": f"WITH {_both('tab_a1')} SELECT * FROM rounded",
    "compared_rows": f"""WITH {_A1_WIDE} {_UNITS}, 'peer' AS side FROM wide WHERE n_name IN ({PEER_LIST})
        UNION ALL {_UNITS}, 'focal' AS side FROM wide WHERE n_name = 'NATION_0'""",
    "ratio_columns": f"""WITH {_both('tab_a1')} SELECT system_id, local_authority, quarter_ending,
        {_A1_RATIOS} FROM rounded""",
    "scaled_population": f"""WITH {_A1_WIDE} SELECT n_name AS local_authority, quarter_ending,
        households_in_area_000s AS households_in_area,
        households_in_area_000s / 1000.0::DOUBLE AS households_in_area_000s FROM wide""",
    "unpivot_metrics": f"""WITH {_long('tab_a1')} SELECT local_authority, {_PERIOD}, metrics,
        v / 100.0::DOUBLE AS households FROM long""",
    "pivot_entities": f"""WITH {_sides('tab_a1')} SELECT {_PERIOD}, metrics,
        f / 100.0::DOUBLE AS focal, p / 100.0::DOUBLE AS peer_group FROM sides""",
    "difference": f"""WITH {_sides('tab_a1')} SELECT quarter_ending, metrics,
        (f - p) / 100.0::DOUBLE AS difference FROM sides""",
    "stepwise_summary": _benchmark("tab_a1"),
    "public_view": _benchmark("tab_a1"),
    "clean_label": f"""WITH {_sides('tab_a2p')} SELECT quarter_ending, metrics,
        replace(replace(metrics, 'perc_pdo_from_', ''), 'pdo_from_', '') AS label FROM sides""",
    "quarter_parts": f"""SELECT o_orderkey, {_quarter('o_orderdate')} AS quarter_ending,
        CAST(year(o_orderdate) AS INTEGER) AS qtr_year, CAST(quarter(o_orderdate) * 3 AS INTEGER) AS qtr_month
        FROM orders""",
    "quarter_label": """SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
        CASE month(o_orderdate) WHEN 3 THEN 'q1' WHEN 6 THEN 'q2' WHEN 9 THEN 'q3' WHEN 12 THEN 'q4' ELSE 'q0' END
        AS year_qtr FROM orders""",
    "quarter_from_name": f"""WITH q AS (SELECT o_orderkey, o_orderstatus AS s, {_quarter('o_orderdate')} AS q FROM orders)
        SELECT o_orderkey, 'Detailed_LA_' || CASE s WHEN 'F' THEN (q + 2500) || '.csv'
            WHEN 'O' THEN (q + 2500) || '_revised.csv' ELSE q || '.csv' END AS name,
        CASE WHEN s IN ('F', 'O') THEN CAST(q + 2500 AS INTEGER) END AS quarter_ending FROM q""",
    "peer_flag": f"""SELECT c_custkey, n_name, CAST(n_name IN ({PEER_LIST}) AS INTEGER) AS is_neighbouring_la
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "value_map": "SELECT c_custkey, left(c_mktsegment, 1) AS segment_code FROM customer",
    "constant_column": "SELECT o_orderkey, 1 AS row_count, 'orders' AS source FROM orders",
    "rename_and_keep": "SELECT o_orderstatus AS status, o_orderkey AS system_id, o_custkey FROM orders",
    "scrub_placeholder": f"SELECT p_partkey, cell FROM ({_PART_TEXT})",
    "coerce_numeric": f"""SELECT p_partkey, CAST({_PART_NUMBER} AS DOUBLE) AS as_double,
        CAST({_PART_NUMBER} AS DOUBLE) AS as_decimal FROM ({_PART_TEXT})""",
    "coerce_integer": f"SELECT p_partkey, CAST({_PART_NUMBER} AS BIGINT) AS whole FROM ({_PART_TEXT})",
    "cast_columns": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
        CAST(o_custkey AS DOUBLE) AS customer_number, o_custkey AS customer_key, CAST(o_custkey AS VARCHAR) AS customer_text FROM orders""",
    "half_away_rounding": """WITH q AS (SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus, l_quantity,
            CAST(l_quantity AS BIGINT) AS n, CASE WHEN l_linestatus = 'F' THEN 1 ELSE -1 END AS s,
            nullif(l_linenumber - 1, 0) AS d FROM lineitem)
        SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus, l_quantity,
            CAST(s * ((2 * n + 2) // 4) AS BIGINT) AS half,
            s * ((200 * n + 8) // 16) / 100.0::DOUBLE AS eighth,
            s * ((200 * n + d) // (2 * d)) / 100.0::DOUBLE AS by_line FROM q""",
    "drop_sparse_rows": f"""SELECT * FROM ({_GAPPY}) WHERE (o_orderkey IS NOT NULL)::INT + (system_id IS NOT NULL)::INT
        + (priority IS NOT NULL)::INT + (status IS NOT NULL)::INT + (remark IS NOT NULL)::INT >= 3""",
    "drop_sparse_columns": f"SELECT o_orderkey, system_id, priority, status FROM ({_GAPPY})",
    "not_null_id": f"SELECT o_orderkey, system_id FROM ({_GAPPY}) WHERE system_id IS NOT NULL",
    "start_at_anchor": """SELECT o_orderstatus, o_orderkey FROM orders JOIN (
            SELECT o_orderstatus, min(o_orderkey) AS first FROM orders
            WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000 GROUP BY 1) USING (o_orderstatus)
        WHERE o_orderkey >= first""",
    "dedup_rows": """SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_linenumber,
        min(l_orderkey) AS row_no FROM lineitem GROUP BY ALL""",
    "append_by_name": """SELECT o_orderkey, o_orderstatus, o_custkey, NULL::VARCHAR AS o_orderpriority
            FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, o_orderstatus, NULL, NULL FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT o_orderkey, NULL, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
    "delta_load": f"""{_DELTA} SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE
        old.o_orderkey = new.o_orderkey AND old.priority = new.priority)""",
    "delta_redundant": f"""{_DELTA} SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE
        old.o_orderkey = new.o_orderkey AND old.priority = new.priority)""",
    "delta_keeps_copies": """SELECT l_linestatus, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem AS n WHERE NOT EXISTS (SELECT 1 FROM lineitem AS o WHERE o.l_returnflag = 'R'
            AND o.l_quantity < 25 AND o.l_linestatus = n.l_linestatus AND o.l_linenumber = n.l_linenumber
            AND o.l_quantity = n.l_quantity)""",
    "fingerprint_rows": """WITH c AS (SELECT c_custkey, c_name,
            CASE WHEN c_acctbal > 5000 THEN c_nationkey END AS rich_nation, c_mktsegment FROM customer)
        SELECT *, c_custkey || '-;-' || c_name || '-;-' || coalesce(CAST(rich_nation AS VARCHAR), '<NA>')
            || '-;-' || c_mktsegment AS delta_id FROM c""",
    "fingerprint_counts": """SELECT count(*) AS row_count,
        count(DISTINCT o_custkey || '-;-' || o_orderstatus) AS fingerprint_count FROM orders""",
    "rows_per_quarter": f"SELECT {_quarter('o_orderdate')} AS quarter_ending, count(*) AS row_count FROM orders GROUP BY 1",
    "non_null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM ({_GAPPY})"
        for c in ("o_orderkey", "system_id", "priority", "status", "remark")
    ),
    "clean_sheets": _SHEETS,
    "clean_prevention": _cleaned("tab_a2p"),
    "clean_relief": _cleaned("tab_a2r"),
    "clean_ended_prevention": _cleaned("tab_p1"),
    "clean_ended_relief": _cleaned("tab_r1"),
    "clean_accommodation": _cleaned("tab_ta1"),
    "clean_composition": _cleaned("tab_ta2"),
    "csv_export": _ORDER_ROWS,
    "grid_scan": f"""SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0
        THEN concat('first "line",', chr(10), chr(10), 'last of ', priority) ELSE priority END AS priority) FROM ({_ORDER_ROWS})""",
    "source_listing": f"SELECT DISTINCT {_quarter('o_orderdate')} AS quarter_ending FROM orders",
    "delta_both": f"""{_DELTA} SELECT *, 'fresh' AS side FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE
            old.o_orderkey = new.o_orderkey AND old.priority = new.priority)
        UNION ALL SELECT *, 'redundant' AS side FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE
            old.o_orderkey = new.o_orderkey AND old.priority = new.priority)""",
    "dedup_wide_rows": """SELECT l_returnflag, l_linestatus, l_linenumber, l_shipdate, l_extendedprice, min(l_orderkey) AS row_no
        FROM lineitem GROUP BY ALL""",
    "other_files": f"""SELECT DISTINCT {_quarter('o_orderdate')} AS quarter_ending FROM orders
        WHERE {_quarter('o_orderdate')} <> 199803""",
    "staging_quarters": f"""WITH {_wide_of('tab_ta2')} SELECT CAST(n_nationkey AS VARCHAR) AS system_id, n_name AS local_authority,
        {', '.join(columns('tab_ta2'))}, quarter_ending, CAST(n_name IN ({PEER_LIST}) AS INTEGER) AS is_neighbouring_la
        FROM wide WHERE quarter_ending IN (199603, 199712)""",
    "summary_csv_order": f"""WITH {_sides('tab_a1')} SELECT row_number() OVER (ORDER BY quarter_ending, metrics) AS line,
        quarter_ending, metrics FROM sides""",
    "staging_append": f"""{_DELTA} SELECT * FROM old UNION ALL SELECT * FROM new WHERE NOT EXISTS (
        SELECT 1 FROM old WHERE old.o_orderkey = new.o_orderkey AND old.priority = new.priority)""",
    "summary_refresh": _benchmark("tab_ta2"),
    "summary_csv": _benchmark("tab_a1"),
}
