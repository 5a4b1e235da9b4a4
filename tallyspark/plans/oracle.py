"""Reference SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark operators and in the KPI job's own shape:
every KPI column is its own filtered, grouped subquery left-joined onto the
customer key set, the anchor a separate ``max``.  The Spark side computes the
same result with one two-stage aggregation, so agreement checks the rewrite.
Nothing is imported from the library: windows, names and run parameters are
written out here once more, so a wrong one on either side shows.
"""

from __future__ import annotations

# Families (key, months, measures with their column names), brand codes, odd names.
_AVG_NAME = "average_customer_spend_lifestyle_{}_last_%s_months_ksa"
_SUM_NAME = "total_spend_lifestyle_{}_last_%s_months_ksa"
ORACLE_FAMILIES = [
    ("avg_spend_6m", 6, [("avg", _AVG_NAME % 6)]),
    ("avg_spend_3m", 3, [("avg", _AVG_NAME % 3)]),
    ("avg_spend_1m", 1, [("avg", _AVG_NAME % 1)]),
    ("avg_spend_2m", 2, [("avg", _AVG_NAME % 2)]),
    ("total_spend_3m", 3, [("sum", _SUM_NAME % 3)]),
    ("total_spend_6m", 6, [("sum", _SUM_NAME % 6)]),
    ("total_spend_12m", 12, [("sum", _SUM_NAME % 12)]),
    ("transactions_lifetime", None, [("count", "total_transactions_lifestyle_{}_lifetime_ksa")]),
    ("avg_transaction_value_12m", 12, [("avg", "average_transaction_value_lifestyle_{}_last_12_months_ksa")]),
    ("status_6m", 6, [("active", "lifestyle_{}_status_active_ksa"), ("inactive", "lifestyle_{}_status_inactive_ksa")]),
]
ORACLE_CODES = ["that", "lll", "als", "hs", "anb", "cnb", "cb2", "ffl"]
ODD_NAMES = {f"average_customer_spend_lifestyle_ffl_last_{n}_months_ksa" for n in (1, 2, 3)}  # these begin with "ffl_"
SETTINGS = {"country": "ASIA", "as_of": "2001-06-30", "bu": "N", "source_system": "O", "org_code": "BUILDING"}
AUDIT = {"dag_name": "events_load", "source_tables": ["events"], "target_table": "events_loaded",
         "start_ts": "2024-02-01 05:00:00 AM", "end_ts": "2024-02-01 05:20:00 AM", "run_date": "2024-02-01",
         "epoch_time": 1706763600}

KEY = "idi_counterparty_gr"

TRX_SQL = """
SELECT o.o_custkey AS idi_counterparty_gr,
       o.o_orderdate AS dat_date_type_1,
       l.l_extendedprice AS cua_amount_type_1,
       l.l_orderkey AS idi_turnover,
       l.l_returnflag AS bu,
       l.l_linestatus AS cod_sor_gr,
       r.r_name AS des_country_name,
       p.p_brand AS des_maf_brand_name
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _bu_sql(with_bu: bool = False, all_regions: bool = False) -> str:
    s = SETTINGS
    cond = f"dat_date_type_1 <= DATE '{s['as_of']}'"
    if not all_regions:
        cond += f" AND des_country_name = '{s['country']}'"
    if with_bu:
        cond += f" AND bu = '{s['bu']}' AND cod_sor_gr = '{s['source_system']}'"
    return f"SELECT * FROM ({TRX_SQL}) t WHERE {cond}"


def _oracle_cells(measures=None, family_keys=None):
    """(name, measure, months, brand literal) in column order, from the fixed tables."""
    out = []
    for key, months, outputs in ORACLE_FAMILIES:
        if family_keys is not None and key not in family_keys:
            continue
        for i, code in enumerate(ORACLE_CODES):
            for measure, template in outputs:
                if measures is not None and measure not in measures:
                    continue
                name = template.format(code)
                out.append(("ffl_" + name if name in ODD_NAMES else name, measure, months, f"Brand#{i + 1}"))
    return out


def _cents(col: str) -> str:
    return f"CAST(round({col} * 100) AS BIGINT)"


def _cell_sql(measure: str, months, literal: str, money: str) -> str:
    """SELECT key, v FROM bu for one cell, chain style."""
    window = "" if months is None else f" AND b.dat_date_type_1 >= a.mx - INTERVAL {months} MONTH"
    brand = f"b.des_maf_brand_name = '{literal}'"
    amt = "b.cua_amount_type_1"
    if measure == "sum":
        v = f"CAST(sum({_cents(amt)}) AS BIGINT)" if money == "cents" else f"sum({amt})"
        where = brand + window
    elif measure == "avg":
        if money == "cents":
            s, n = f"sum({_cents(amt)})", f"count({_cents(amt)})"
            v = f"CAST(CASE WHEN {n} > 0 THEN sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) END AS BIGINT)"
        else:
            v = f"avg({amt})"
        where = brand + window
    elif measure == "count":
        v = "count(b.idi_turnover)"
        where = brand + window
    elif measure == "active":
        v = f"CASE WHEN max(b.dat_date_type_1) >= a.mx - INTERVAL {months} MONTH THEN 1 END"
        where = brand
    elif measure == "inactive":
        v = f"CASE WHEN max(b.dat_date_type_1) >= a.mx - INTERVAL {months} MONTH THEN NULL ELSE 1 END"
        where = brand
    else:
        raise ValueError(measure)
    return (f"SELECT b.{KEY}, {v} AS v FROM bu b, anchor a WHERE {where} "
            f"GROUP BY b.{KEY}, a.mx")


def mart_sql(measures=None, family_keys=None, money: str = "cents", final: str | None = None,
             all_regions: bool = False, with_bu: bool = False) -> str:
    cells = _oracle_cells(measures, family_keys)
    ctes = [f"bu AS ({_bu_sql(with_bu=with_bu, all_regions=all_regions)})",
            "anchor AS (SELECT max(dat_date_type_1) AS mx FROM bu)",
            f"keys AS (SELECT DISTINCT {KEY} FROM bu)"]
    cols, joins = [f"keys.{KEY}"], []
    for i, (name, measure, months, literal) in enumerate(cells):
        ctes.append(f"k{i} AS ({_cell_sql(measure, months, literal, money)})")
        cols.append(f"k{i}.v AS \"{name}\"")
        joins.append(f"LEFT JOIN k{i} ON keys.{KEY} = k{i}.{KEY}")
    body = f"SELECT {', '.join(cols)} FROM keys {' '.join(joins)}"
    if final is None:
        return "WITH " + ",\n".join(ctes) + "\n" + body
    return "WITH " + ",\n".join(ctes + [f"mart AS ({body})"]) + "\n" + final


def _rounded_sql() -> str:
    names = [c[0] for c in _oracle_cells(measures={"sum"})]
    proj = ", ".join([KEY] + [f"round(\"{n}\", 2) AS \"{n}\"" for n in names])
    return mart_sql(measures={"sum"}, money="double", final=f"SELECT {proj} FROM mart")


def _profile_sql() -> str:
    names = [KEY] + [c[0] for c in _oracle_cells()]
    counts = ", ".join(f"count(\"{n}\") AS \"{n}\"" for n in names)
    on = ", ".join(f"\"{n}\"" for n in names)
    return mart_sql(final=f"UNPIVOT (SELECT {counts} FROM mart) ON {on} "
                          f"INTO NAME column_name VALUE non_null_count")


EXT_SQL = """
SELECT c_mktsegment AS org_code, c_custkey AS gcr_id, 'EXT-' || CAST(c_custkey // 3 AS VARCHAR) AS external_id
FROM customer
UNION ALL
SELECT c_mktsegment, c_custkey, 'ALT-' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0
"""


def _pairs_sql() -> str:
    return f"SELECT DISTINCT gcr_id, external_id FROM ({EXT_SQL}) e WHERE org_code = '{SETTINGS['org_code']}'"


def _published_sql() -> str:
    final = f"""
SELECT * EXCLUDE (rn, external_id), external_id AS {KEY} FROM (
  SELECT m.* EXCLUDE ({KEY}), p.gcr_id, p.external_id,
         row_number() OVER (PARTITION BY p.external_id ORDER BY p.gcr_id) AS rn
  FROM mart m JOIN ({_pairs_sql()}) p ON m.{KEY} = p.gcr_id) x
WHERE rn = 1"""
    return mart_sql(final=final)


def _anchors_sql() -> str:
    mx = "mx"
    parts = [f"CAST({mx} AS DATE) AS max_date", "CAST(mn AS DATE) AS min_date"]
    parts += [f"CAST({mx} - INTERVAL {d} DAY AS DATE) AS days_ago_{d}" for d in (1, 7)]
    parts += [f"CAST({mx} - INTERVAL {m} MONTH AS DATE) AS months_ago_{m}" for m in (1, 2, 3, 6, 9, 12, 24)]
    parts += [f"CAST(month({mx}) AS INTEGER) AS current_month", f"CAST(year({mx}) AS INTEGER) AS current_year",
              f"CAST(month({mx} - INTERVAL 1 MONTH) AS INTEGER) AS previous_month",
              f"CAST(year({mx} - INTERVAL 12 MONTH) AS INTEGER) AS previous_year",
              f"strftime(date_trunc('month', {mx}), '%Y-%m-%d') AS current_month_start_date"]
    return (f"SELECT {', '.join(parts)} FROM (SELECT max(dat_date_type_1) AS mx, min(dat_date_type_1) AS mn "
            f"FROM ({_bu_sql()}) b) a")


def kpi_oracle() -> dict:
    return {
        "trx_base": _bu_sql(with_bu=True),
        "customer_keys": f"SELECT DISTINCT {KEY} FROM ({_bu_sql()}) b",
        "date_anchors": _anchors_sql(),
        "kpi_total_spend": mart_sql(measures={"sum"}),
        "kpi_avg_spend": mart_sql(family_keys={"avg_spend_6m", "avg_spend_3m", "avg_spend_1m", "avg_spend_2m"}),
        "kpi_avg_transaction_value": mart_sql(family_keys={"avg_transaction_value_12m"}),
        "kpi_lifetime_transactions": mart_sql(measures={"count"}),
        "kpi_activity_flags": mart_sql(measures={"active", "inactive"}),
        "kpi_mart": mart_sql(),
        "kpi_mart_all_regions": mart_sql(all_regions=True),
        "kpi_mart_business_unit": mart_sql(with_bu=True),
        "kpi_rounded": _rounded_sql(),
        "kpi_non_null_profile": _profile_sql(),
        "external_id_map": _pairs_sql(),
        "kpi_published": _published_sql(),
        "kpi_mart_double": mart_sql(money="double").replace("l.l_extendedprice AS", "l.l_quantity AS"),
    }


# --- load audit -------------------------------------------------------------------------

_SRC = "SELECT *, CAST(ts AS DATE) AS event_date FROM events"
_TGT = _SRC + " WHERE event_type <> 'error'"
_ACTIVE = _SRC + " WHERE event_type NOT IN ('error', 'signup')"


def _inc_sql(where: str = "") -> str:
    cond = "event_date IS NOT NULL" + (f" AND {where}" if where else "")
    return f"SELECT DISTINCT event_date AS trx_date FROM ({_SRC}) e WHERE {cond}"


def _recon_sql(mode: str = "daily", inc_where: str = "", tgt_only_filter: bool = False) -> str:
    inc = _inc_sql(inc_where)
    if mode == "custom":
        s = f"(SELECT count(*) FROM ({_SRC}) e WHERE event_type IN ('click', 'purchase'))"
        t = f"(SELECT count(*) FROM ({_TGT}) e)"
        return (f"SELECT trx_date, CAST({s} AS BIGINT) AS source_count, CAST({t} AS BIGINT) AS target_count "
                f"FROM ({inc}) inc")
    sf = " WHERE event_type <> 'view'" if mode == "filtered" else ""
    tf = " WHERE value >= 10" if (mode == "filtered" or tgt_only_filter) else ""
    return f"""
SELECT inc.trx_date, CAST(coalesce(s.n, 0) AS BIGINT) AS source_count,
       CAST(coalesce(t.n, 0) AS BIGINT) AS target_count
FROM ({inc}) inc
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_SRC}) e{sf} GROUP BY event_date) s ON inc.trx_date = s.d
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_TGT}) e{tf} GROUP BY event_date) t ON inc.trx_date = t.d
"""


def _audit_sql(status: str, inc_where: str = "", tgt_only_filter: bool = False, recon: str | None = None,
               **changed) -> str:
    a = AUDIT | changed
    recon = recon or _recon_sql("daily", inc_where, tgt_only_filter)
    tgt = "CAST(0 AS BIGINT)" if status == "failed" else "target_count"
    rows = f"""
SELECT '{a['dag_name']}' AS dag_name, '{",".join(a['source_tables'])}' AS source_tables,
       '{a['target_table']}' AS target_table, '{status}' AS status, '{a['start_ts']}' AS start_ts,
       '{a['end_ts']}' AS end_ts, source_count, {tgt} AS target_count, trx_date, DATE '{a['run_date']}' AS run_date
FROM (SELECT * FROM ({recon}) r
      UNION ALL
      SELECT CAST(NULL AS DATE), CAST(0 AS BIGINT), CAST(0 AS BIGINT) WHERE NOT EXISTS (SELECT 1 FROM ({recon}) r2)) x
"""
    fields = ["dag_name", "source_tables", "target_table", "status", "start_ts", "end_ts", "source_count",
              "target_count", "trx_date", "run_date"]
    h = "sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in fields) + "))"
    return f"SELECT {h} AS hash, * FROM ({rows}) y"


def _shipped_recon_sql() -> str:
    n = f"(SELECT count(*) FROM ({_SRC}) e WHERE event_type IN ('click', 'purchase'))"
    inc = _inc_sql("event_type = 'purchase' AND value > 40")
    return f"""
SELECT inc.trx_date, CAST({n} AS BIGINT) AS source_count, CAST(coalesce(t.n, 0) AS BIGINT) AS target_count
FROM ({inc}) inc
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_TGT}) e GROUP BY event_date) t ON inc.trx_date = t.d
"""


def _stream_sql() -> str:
    """Run one lands the days before the 16th and that day's clicks, run two the rest; run three has nothing."""
    day = "DATE '2024-01-16'"
    early = f"(event_date < {day} OR (event_date = {day} AND event_type = 'click'))"

    def run(landed_now: str, landed_in_all: str) -> str:
        return f"""
SELECT inc.d AS trx_date, CAST((SELECT count(*) FROM ({_SRC}) s WHERE s.event_date = inc.d) AS BIGINT) AS source_count,
       CAST((SELECT count(*) FROM ({_TGT}) t WHERE t.event_date = inc.d AND {landed_in_all}) AS BIGINT) AS target_count
FROM (SELECT DISTINCT event_date AS d FROM ({_TGT}) t WHERE event_date IS NOT NULL AND {landed_now}) inc"""

    runs = [run(early, early), run(f"NOT coalesce({early}, false)", "true"),
            "SELECT CAST(NULL AS DATE) AS trx_date, CAST(0 AS BIGINT) AS source_count, CAST(0 AS BIGINT) AS target_count"]
    return " UNION ALL ".join(_audit_sql("Succeeded", recon=r) for r in runs)


def _count_tables_sql() -> str:
    return (f"SELECT 'events' AS table_name, 'src' AS type, count(*) AS count FROM ({_ACTIVE}) a "
            f"UNION ALL SELECT 'events_loaded', 'tgt', count(*) FROM ({_TGT}) b")


def audit_oracle() -> dict:
    a = AUDIT
    return {
        "increment_dates": _inc_sql(),
        "increment_dates_sql": _inc_sql("event_type = 'purchase' AND value > 40"),
        "reconcile_daily": _recon_sql("daily"),
        "reconcile_source_dates": _recon_sql("daily"),
        "reconcile_filtered": _recon_sql("filtered"),
        "reconcile_custom": _recon_sql("custom"),
        "reconcile_latest_day": f"""
SELECT inc.d AS trx_date, CAST(coalesce(s.n, 0) AS BIGINT) AS source_count, CAST(coalesce(t.n, 0) AS BIGINT) AS target_count
FROM (SELECT max(event_date) AS d FROM ({_SRC}) e) inc
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_SRC}) e GROUP BY event_date) s ON inc.d = s.d
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_TGT}) e WHERE value >= 10 GROUP BY event_date) t ON inc.d = t.d
""",
        "audit_rows": _audit_sql("Succeeded"),
        "audit_rows_failed": _audit_sql("failed"),
        "audit_rows_empty": _audit_sql("Succeeded", "event_type = 'refund'"),
        "audit_rows_timestamps": _audit_sql("Succeeded", start_ts="2024-02-01 09:05:07 AM",
                                            end_ts="2024-02-01 17:45:00 PM"),
        "config_audit_shipped": _audit_sql("Succeeded", recon=_shipped_recon_sql(),
                                           target_table="tallyspark_events_loaded"),
        "table_count_audit": f"""
SELECT '{a['dag_name']}' AS dag_name, table_name, type, DATE '{a['run_date']}' AS load_date,
       CAST(count AS BIGINT) AS count, 'success' AS status, CAST({a['epoch_time']} AS BIGINT) AS epoch_time
FROM ({_count_tables_sql()}) c""",
        "config_audit_rows": _audit_sql("Succeeded", tgt_only_filter=True, target_table="tallyspark_events_loaded"),
        "config_table_count_audit": f"""
SELECT '{a['dag_name']}' AS dag_name, table_name, type, DATE '2024-02-01' AS load_date,
       CAST(count AS BIGINT) AS count, 'success' AS status, CAST({a['epoch_time']} AS BIGINT) AS epoch_time
FROM ({_count_tables_sql()}) c""",
        "config_audit_summary": f"""
SELECT table_name, CAST(CASE WHEN type = 'tgt' THEN 0 ELSE count END AS BIGINT) AS count,
       '{a['dag_name']}' AS dag_name, 'failed' AS status, type, DATE '{a['run_date']}' AS load_date
FROM ({_count_tables_sql()}) c""",
        "audit_summary": f"""
SELECT table_name, CAST(CASE WHEN type = 'tgt' THEN 0 ELSE count END AS BIGINT) AS count,
       '{a['dag_name']}' AS dag_name, 'failed' AS status, type, DATE '{a['run_date']}' AS load_date
FROM ({_count_tables_sql()}) c""",
    }


def _dated_mart_sql(as_of: str) -> str:
    return (f"SELECT *, DATE '{as_of}' AS as_of FROM ({mart_sql().replace(SETTINGS['as_of'], as_of)}) m")


_OPEN_RUNS = ["event_date < DATE '2024-01-16' AND event_type <> 'error'", "event_type <> 'error'",
              "event_type <> 'error' OR event_date IN (DATE '2024-01-05', DATE '2024-01-20')"]


def _high_water_sql() -> str:
    """A date is open in a run when its rows differ from those of the run before (no rows there: never loaded)."""
    runs = ", ".join(f"c{i} AS (SELECT event_date AS d, count(*) AS n FROM ({_SRC}) e WHERE event_date IS NOT NULL "
                     f"AND ({w}) GROUP BY event_date)" for i, w in enumerate(_OPEN_RUNS, 1))
    parts = ["SELECT d AS trx_date, CAST(n AS BIGINT) AS loaded_count, 1 AS run FROM c1"]
    parts += [f"SELECT c{i}.d, CAST(c{i}.n AS BIGINT), {i} FROM c{i} LEFT JOIN c{i - 1} USING (d) "
              f"WHERE c{i - 1}.n IS DISTINCT FROM c{i}.n" for i in (2, 3)]
    return f"WITH {runs} {' UNION ALL '.join(parts)}"


def sink_oracle() -> dict:
    export = ("SELECT event_date, event_type, count(*) AS n_events, round(sum(value), 2) AS total_value "
              f"FROM ({_SRC}) e GROUP BY event_date, event_type")
    return {
        "export_sql": export,
        "landing_roundtrip": f"SELECT *, unnest([DATE '2024-02-01', DATE '2024-02-02']) AS run_date FROM ({export}) x",
        "kpi_overwrite_roundtrip": mart_sql(),
        "kpi_overwrite_broken": mart_sql(measures={"sum"}),
        "kpi_mart_incremental": " UNION ALL ".join(map(_dated_mart_sql, ("2001-06-28", "2001-06-29", "2001-06-30"))),
        "audit_append_after_older": (f"SELECT *, CAST(NULL AS VARCHAR) AS run_id FROM ({_audit_sql('failed')}) x UNION ALL "
                                     f"SELECT *, 'run-1' FROM ({_audit_sql('Succeeded')}) y"),
        "reconcile_ledger": f"""
SELECT inc.trx_date, CAST(coalesce(s.n, 0) AS BIGINT) AS source_count, CAST(coalesce(t.n, 0) AS BIGINT) AS target_count
FROM ({_inc_sql()}) inc
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_SRC}) e GROUP BY event_date) s ON inc.trx_date = s.d
LEFT JOIN (SELECT event_date AS d, count(*) AS n FROM ({_TGT}) e
           WHERE event_date >= DATE '2024-01-16' OR event_type = 'click' GROUP BY event_date) t ON inc.trx_date = t.d
""",
        "increment_high_water": _high_water_sql(),
        "table_count_audit_observed": audit_oracle()["table_count_audit"],
        "extract_balanced": """
SELECT l_linestatus, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS order_keys, sum(l_quantity) AS quantity,
       true AS balanced FROM lineitem GROUP BY l_linestatus
""",
        "audit_append_roundtrip": " UNION ALL ".join(f"SELECT *, '{run}' AS run_id FROM ({sql}) x" for run, sql in (
            ("run-1", _audit_sql("Succeeded")), ("run-2", _audit_sql("failed")),
            ("run-1", _audit_sql("Succeeded", run_date="2024-02-02")))),
        "landing_stream_audit": _stream_sql(),
        "kpi_job_roundtrip": _published_sql(),
        "table_count_audit_roundtrip": audit_oracle()["table_count_audit"],
    }


def oracle_sql() -> dict:
    out = dict(kpi_oracle())
    out.update(audit_oracle())
    out.update(sink_oracle())
    return out
