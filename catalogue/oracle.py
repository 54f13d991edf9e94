"""DuckDB SQL with the result each query has to give."""

from __future__ import annotations

from catalogue import oracle_domain as D
from catalogue.oracle_raw import RAW

SEGMENTS = "region_name, city_name, meter_type, customer_category, grid_zone"


def _households(extra: str = "") -> str:
    return f"""{D.silver('energy_usage')}, households AS (
  SELECT household_id, {SEGMENTS}, "timestamp" AS last_reading FROM (
    SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY "timestamp" DESC NULLS LAST) AS rn
    FROM energy_usage WHERE household_id IS NOT NULL) WHERE rn = 1){extra}"""


def _staging(name: str) -> str:
    t = D.TABLES[name]
    columns = list(dict.fromkeys([*t["key"], *t["measures"], *t["text"]]))
    if '"timestamp"' in t["key"]:
        columns.append("CAST(strftime(\"timestamp\", '%Y%m%d') AS INTEGER) AS date_key")
    return f"WITH {D.silver(name)} SELECT {', '.join(columns)} FROM {name}"


def _dimension(name: str) -> str:
    t = D.TABLES[name]
    columns = list(dict.fromkeys([*t["key"], *t["text"]]))
    return f"WITH {D.silver(name)} SELECT {', '.join(columns)} FROM {name}"


def _rejects(name: str) -> str:
    return f"""WITH {D.candidates(name)},
tagged AS (SELECT *, {D.failed_rules(name)} AS failed FROM cand_{name})
SELECT * EXCLUDE (failed), array_to_string(failed, ',') AS failed_rules FROM tagged WHERE len(failed) > 0"""


def _reject_counts() -> str:
    names = [n for n, t in D.TABLES.items() if t["rules"]]
    ctes = ", ".join(D.candidates(n) for n in names)
    counted = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{rule}' AS rule, count(*) AS n_rows FROM cand_{n} "
        f"WHERE NOT ({sql})"
        for n in names
        for rule, sql in D.TABLES[n]["rules"].items()
    )
    return f"WITH {ctes} SELECT * FROM ({counted}) WHERE n_rows > 0"


def _summary(group: str) -> str:
    return f"""WITH {D.FACT_READINGS}
SELECT {group}, region_name, {D.USAGE} FROM readings GROUP BY ALL"""


SCD2 = """
WITH one AS (
  SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
marked AS (
  SELECT *, lag(o_orderkey) OVER w IS NULL
      OR lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus
      OR lag(o_orderpriority) OVER w IS DISTINCT FROM o_orderpriority AS starts,
    max(o_orderdate) OVER (PARTITION BY o_custkey) AS newest
  FROM one WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
versions AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority, o_orderdate AS effective_from,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS effective_to, newest
  FROM marked WHERE starts)
SELECT o_custkey, o_orderstatus, o_orderpriority, effective_from, effective_to,
  effective_to IS NULL AS is_current, CASE WHEN effective_to IS NULL THEN newest END AS last_seen
FROM versions"""

SCD2_SNAPSHOTS = """
WITH years AS (SELECT unnest(generate_series(1995, 2001)) AS y),
states AS (
  SELECT o_custkey, y, o_orderstatus, o_orderpriority FROM (
    SELECT *, year(o_orderdate) AS y, row_number() OVER (
      PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
  WHERE rn = 1),
every AS (
  SELECT c.o_custkey, years.y, s.y IS NOT NULL AS here, s.o_orderstatus, s.o_orderpriority
  FROM (SELECT DISTINCT o_custkey FROM states) c CROSS JOIN years LEFT JOIN states s ON s.o_custkey = c.o_custkey AND s.y = years.y),
marked AS (
  SELECT *, coalesce(lag(here) OVER w <> here OR lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus
      OR lag(o_orderpriority) OVER w IS DISTINCT FROM o_orderpriority, true) AS starts
  FROM every WINDOW w AS (PARTITION BY o_custkey ORDER BY y)),
periods AS (
  SELECT *, lead(y) OVER (PARTITION BY o_custkey ORDER BY y) AS next FROM marked WHERE starts)
SELECT o_custkey, o_orderstatus, o_orderpriority, make_date(y, 12, 31) AS effective_from,
  make_date(next, 12, 31) AS effective_to, next IS NULL AS is_current,
  CASE WHEN next IS NULL THEN DATE '2001-12-31' END AS last_seen
FROM periods WHERE here"""

TERMS = "tariff_plan_type, unit_rate, peak_rate, offpeak_rate"


def _tariff_history() -> str:
    terms = TERMS.split(", ")
    changed = " OR ".join(f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in terms)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("billing_cycle", *terms))
    return f"""{D.silver('tariff_metrics')},
billed AS (
  SELECT * REPLACE (TIMESTAMP '2024-01-01' + to_hours((date_diff('day', DATE '1970-01-01', reading_timestamp::DATE) * 7) % 720) AS reading_timestamp)
  FROM tariff_metrics WHERE household_id IS NOT NULL),
one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY household_id, reading_timestamp ORDER BY {order}) AS rn FROM billed)
  WHERE rn = 1),
starts AS (
  SELECT *, coalesce({changed} OR lag(household_id) OVER w IS NULL, true) AS begins,
    max(reading_timestamp) OVER (PARTITION BY household_id) AS newest
  FROM one WINDOW w AS (PARTITION BY household_id ORDER BY reading_timestamp)),
history AS (
  SELECT household_id, {TERMS}, reading_timestamp AS effective_from,
    lead(reading_timestamp) OVER v AS effective_to, lead(reading_timestamp) OVER v IS NULL AS is_current,
    CASE WHEN lead(reading_timestamp) OVER v IS NULL THEN newest END AS last_seen
  FROM starts WHERE begins WINDOW v AS (PARTITION BY household_id ORDER BY reading_timestamp))"""


COUNT_CHECKS = "CAST({0} AS BIGINT) AS n_checked, CAST({1} AS BIGINT) AS n_failed"


def _check(name: str, checked: str, failed: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", {COUNT_CHECKS.format(checked, failed)} FROM {source}"


def _title(c: str) -> str:
    return D._title(c)


def oracle_sql() -> dict[str, str]:
    sql = {
        "daily_summary": _summary("date_key"),
        "monthly_summary": _summary("month_key"),
        "yearly_summary": _summary("CAST(month_key // 100 AS INTEGER) AS year"),
        "incremental_mart": _summary("date_key"),
        "monthly_rollup": _summary("month_key"),
        "yearly_rollup": _summary("CAST(month_key // 100 AS INTEGER) AS year"),
    }
    for name, t in D.TABLES.items():
        sql[f"ingest_{name}"] = f"WITH {RAW[name]} SELECT *, true AS has_lineage FROM raw_{name}"
        sql[f"silver_{name}"] = f"WITH {D.silver(name)} SELECT * FROM {name}"
        sql[f"stg_{name}"] = _staging(name)
        if t["rules"]:
            sql[f"rejects_{name}"] = _rejects(name)
    for name in ("device_metrics", "grid_load", "tariff_metrics"):
        sql[f"silver_{name}_raw_key_text"] = f"WITH {D.silver(name, True)} SELECT * FROM {name}"

    given = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
    )
    sql["gate_row_counts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in given
    )
    sql["audit_log"] = " UNION ALL ".join(
        f"SELECT 'Ingest_{t}' AS process_name, '{t}.parquet' AS source_file, "
        f"'bronze.{t}' AS target_table, count(*) AS records_processed, 'SUCCESS' AS status, "
        f"CAST(NULL AS VARCHAR) AS error_message FROM {t}"
        for t in given
    )
    sql["audit_failure"] = """
SELECT 'Ingest_events' AS process_name, count(*) AS records_processed, 'SUCCESS' AS status,
  false AS has_error FROM events
UNION ALL SELECT 'Ingest_events_missing', 0, 'FAILED', true"""
    sql["ingest_lineage"] = """
SELECT 'events.parquet' AS source_name, 'run-1' AS batch_id, count(*) AS n_rows,
  CAST(1 AS BIGINT) AS n_load_times FROM events"""
    sql["row_ids"] = "SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders"
    sql["csv_roundtrip"] = "SELECT * FROM customer"
    sql["schema_evolution_append"] = """
SELECT p_partkey, p_name, p_size FROM part
UNION ALL BY NAME SELECT p_brand, p_partkey, p_retailprice FROM part"""
    sql["schema_evolution_types"] = """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS size,
  CASE WHEN p_partkey % 3 = 2 THEN trunc(p_size * 0.5) ELSE p_size * 0.5 END::DOUBLE AS price,
  CASE p_partkey % 3 WHEN 0 THEN TIMESTAMP '2024-01-02' WHEN 1 THEN TIMESTAMP '2024-01-02 03:04:05'
    ELSE TIMESTAMP '2024-01-03' END AS day,
  CAST(p_size AS BIGINT) AS n, CASE WHEN p_partkey % 3 = 1 THEN p_brand END AS b FROM part"""
    sql["csv_rejects"] = """
SELECT CASE WHEN c_custkey % 13 = 0 THEN 'wrong number of columns' ELSE 'c_acctbal is no double' END AS reason,
  CASE WHEN c_custkey % 13 = 0 THEN c_custkey || ',' || CASE WHEN c_custkey % 11 = 0 THEN 'none' ELSE c_acctbal::VARCHAR END
    ELSE '{"c_custkey":"' || c_custkey || '","c_acctbal":"none","c_mktsegment":"' || c_mktsegment || '"}' END AS record
FROM customer WHERE c_custkey % 13 = 0 OR c_custkey % 11 = 0"""
    sql["load_ledger"] = f"""
WITH {RAW['weather_stream']}, n AS (SELECT reading_id % 3 AS k, count(*) AS n FROM raw_weather_stream GROUP BY 1)
SELECT 'load ' || k AS name, n AS n_rows FROM n UNION ALL SELECT 'again', 0
UNION ALL SELECT 'bronze', count(*) FROM raw_weather_stream"""
    sql["silver_merged"] = f"WITH {D.silver('energy_usage')} SELECT * FROM energy_usage"
    sql["reject_counts"] = _reject_counts()
    sql["cast_measures"] = """
SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k,
  TRY_CAST(regexp_extract(props, '[0-9]+') || event_type AS DOUBLE) AS unreadable FROM events"""
    sql["parse_timestamp"] = """
SELECT event_id, CAST(try_strptime(strftime(ts, '%d-%m-%Y %H:%M'), '%d-%m-%Y %H:%M') AS TIMESTAMP) AS parsed,
  CAST(try_strptime(strftime(ts, '%Y-%m-%d %H:%M'), '%d-%m-%Y %H:%M') AS TIMESTAMP) AS unreadable FROM events"""
    sql["dedup_latest"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
    l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""
    sql["fill_nulls"] = """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0), 0.0::DOUBLE) AS l_discount,
  l_tax FROM lineitem"""
    sql["validate_ranges"] = """
SELECT * FROM lineitem WHERE l_quantity >= 5 AND l_quantity <= 45 AND l_discount >= 0.02"""
    sql["standardise_text"] = f"""
SELECT p_partkey, {_title("'  ' || upper(p_name) || ' '")} AS name, upper(trim(' ' || lower(p_type))) AS type,
  upper(trim(lower(p_brand) || chr(9) || ' ')) AS brand FROM part"""
    keys = {n: f"WITH {D.silver(n)} SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in D.TABLES}
    counted = " UNION ALL ".join(
        f"SELECT table_name, n AS n_natural, n AS n_keys, CAST(NULL AS BIGINT) AS n_plain_kept FROM ({q})"
        for q in keys.values()
    )
    sql["surrogate_key_check"] = f"""
WITH pairs AS (SELECT DISTINCT nullif(l_partkey, 7) AS a, nullif(l_suppkey, 7) AS b FROM lineitem)
SELECT 'lineitem' AS table_name, count(*) AS n_natural, count(*) AS n_keys,
  count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS n_plain_kept FROM pairs
UNION ALL {counted}"""
    sql["sequence_key_check"] = f"""
WITH {RAW['weather_stream']} SELECT count(*) AS n_rows, count(*) AS n_keys FROM raw_weather_stream"""
    sql["null_flags"] = f"""
WITH {RAW['weather_stream']}
SELECT reading_id, coalesce(temperature_celsius, 0.0::DOUBLE) AS temperature_celsius,
  temperature_celsius IS NULL AS temperature_celsius_was_null,
  CASE WHEN isnan(solar_radiation) THEN 0.0::DOUBLE ELSE solar_radiation END AS solar_radiation,
  isnan(solar_radiation) AS solar_radiation_was_null FROM raw_weather_stream"""
    sql["snapshot_version0"] = "SELECT * FROM orders WHERE year(o_orderdate) <= 1996"
    sql["snapshot_latest"] = "SELECT *, o_orderstatus = 'F' AS o_late FROM orders"
    sql["snapshot_history"] = """
WITH n AS (SELECT count(*) FILTER (WHERE year(o_orderdate) <= 1996) AS a,
  count(*) FILTER (WHERE year(o_orderdate) <= 1998) AS b, count(*) AS c FROM orders)
SELECT 0::BIGINT AS version, 'WRITE APPEND' AS operation, a AS n_rows FROM n
UNION ALL SELECT 1, 'WRITE APPEND', b FROM n UNION ALL SELECT 2, 'WRITE APPEND', c FROM n
UNION ALL SELECT 3, 'WRITE OVERWRITE', c FROM n"""
    for name in ("compact_same_rows", "zorder_same_rows", "expire_same_rows"):
        sql[name] = "SELECT * FROM lineitem"
    sql["layout_files"] = """
SELECT 'loaded' AS state, count(*) AS n_rows, false AS one_file, false AS prunes FROM lineitem
UNION ALL SELECT 'clustered', count(*), false, true FROM lineitem
UNION ALL SELECT 'compacted', count(*), true, false FROM lineitem"""
    sql["dq_in_write"] = f"WITH {RAW['energy_usage']} " + " UNION ALL ".join(
        f"SELECT 'energy_usage' AS table_name, '{check}' AS \"check\", '{severity}' AS severity, "
        f"count(*) AS n_checked, count(*) FILTER (WHERE {fails}) AS n_failed, "
        f"count(*) FILTER (WHERE {fails}) AS n_kept FROM raw_energy_usage"
        for check, severity, fails in (
            ("not_null(household_id)", "warn", "household_id IS NULL"),
            ("not_null(voltage_reading)", "warn", "voltage_reading IS NULL"),
            ("accepted_values(meter_type)", "warn", "meter_type NOT IN ('click ', 'view ', 'error ')"),
            ("not_null(reading_id)", "error", "reading_id IS NULL"),
        )
    )
    sql["unreadable_times"] = f"""
WITH {RAW['energy_usage']} SELECT reading_id, household_id, "timestamp", 'timestamp' AS failed_rules
FROM raw_energy_usage WHERE "timestamp" IS NOT NULL AND try_strptime("timestamp", '%d-%m-%Y %H:%M') IS NULL"""
    sql["bucketed_weather"] = f"WITH {D.FACT_READINGS} SELECT * FROM readings"
    sql["dq_not_null"] = f"WITH {RAW['energy_usage']} " + " UNION ALL ".join(
        _check(f"not_null({c})", "count(*)", f"count(*) - count({c})", "raw_energy_usage")
        for c in ("household_id", "voltage_reading", "meter_type")
    )
    sql["dq_unique"] = " UNION ALL ".join(
        [
            _check(
                "unique(l_orderkey, l_linenumber)", "count(*)",
                "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", "lineitem",
            ),
            _check("unique(o_orderkey)", "count(*)", "count(*) - count(DISTINCT o_orderkey)", "orders"),
        ]
    )
    sql["dq_accepted"] = " UNION ALL ".join(
        [
            _check(
                "accepted_values(o_orderstatus)", "count(*)",
                "count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F'))", "orders",
            ),
            _check(
                "accepted_values(event_type)", "count(*)",
                "count(*) FILTER (WHERE event_type NOT IN "
                "('click', 'view', 'error', 'purchase', 'signup'))", "events",
            ),
        ]
    )
    sql["dq_relationships"] = " UNION ALL ".join(
        [
            _check(
                "relationships(o_custkey)", "count(*)", "count(*) FILTER (WHERE c_custkey IS NULL)",
                "orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) ON c_custkey = o_custkey",
            ),
            _check(
                "relationships(l_partkey)", "count(*)", "count(*) FILTER (WHERE p_partkey IS NULL)",
                "lineitem LEFT JOIN part ON p_partkey = l_partkey",
            ),
        ]
    )

    sql["dim_date"] = f"""
WITH {D.silver('energy_usage')}, span AS (
  SELECT min("timestamp")::DATE AS a, max("timestamp")::DATE AS b FROM energy_usage),
days AS (SELECT unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM span)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS iso_weekday,
  isodow(d) >= 6 AS is_weekend FROM days"""
    sql["dim_household"] = f"WITH {_households()} SELECT * FROM households"
    sql["dim_weather"] = f"""
WITH {D.silver('weather_stream')} SELECT DISTINCT weather_region, weather_city, weather_station,
  climate_zone, condition_type FROM weather_stream"""
    for name, source in (
        ("dim_device", "device_metrics"), ("dim_grid", "grid_load"), ("dim_tariff", "tariff_metrics")
    ):
        sql[name] = _dimension(source)
    sql["fact_energy"] = f"WITH {D.FACT} SELECT r.*, p.* EXCLUDE (household_id) FROM readings r LEFT JOIN profile p USING (household_id)"
    sql["scd2_history"] = SCD2
    sql["scd2_incremental"] = SCD2
    sql["scd2_snapshots"] = SCD2_SNAPSHOTS
    sql["tariff_history"] = f"WITH {_tariff_history()} SELECT * FROM history"
    sql["fact_tariff"] = f"""
WITH {D.silver('energy_usage')}, {_tariff_history()}
SELECT e.household_id, e."timestamp", e.energy_usage_kwh, h.effective_from AS tariff_since, {TERMS}
FROM energy_usage e ASOF LEFT JOIN history h
  ON h.household_id = e.household_id AND h.effective_from <= e."timestamp" """
    sql["executive_dashboard"] = f"""
WITH {D.FACT_READINGS}
SELECT region_name, customer_category, CAST(grouping(region_name, customer_category) AS INTEGER) AS level,
  count(*) AS n_readings, sum(energy_usage_kwh) AS total_kwh, avg(energy_usage_kwh) AS avg_kwh,
  max(peak_demand_kw) AS peak_kw, count(DISTINCT household_id) AS n_households
FROM readings GROUP BY ROLLUP (region_name, customer_category)"""
    sql["consumption_by_segment"] = f"""
WITH {D.FACT_READINGS}
SELECT region_name, city_name, customer_category,
  CAST(grouping(region_name, city_name, customer_category) AS INTEGER) AS "grouping",
  count(*) AS n_readings, sum(energy_usage_kwh) AS total_kwh, avg(energy_usage_kwh) AS avg_kwh
FROM readings GROUP BY GROUPING SETS ((region_name), (city_name), (customer_category), ())"""
    sql["weather_impact"] = f"""
WITH {D.FACT_READINGS}
SELECT condition_type, count(*) AS n_readings, avg(energy_usage_kwh) AS avg_kwh,
  avg(temperature_celsius) AS avg_temperature,
  round(corr(temperature_celsius, energy_usage_kwh), 8) AS correlation,
  round(regr_slope(energy_usage_kwh, temperature_celsius), 8) AS kwh_per_degree
FROM readings WHERE condition_type IS NOT NULL GROUP BY ALL"""
    sql["device_health"] = f"""
WITH {D.silver('device_metrics')}
SELECT device_category, device_brand, count(*) AS n_devices, avg(runtime_hours) AS avg_runtime,
  avg(efficiency_ratio) AS avg_efficiency, max(device_temperature) AS max_temperature,
  count(*) FILTER (WHERE maintenance_status <> 'OK') AS n_need_maintenance,
  count(*) FILTER (WHERE maintenance_status <> 'OK')::DOUBLE / count(*) AS maintenance_share
FROM device_metrics GROUP BY ALL"""
    sql["worst_devices"] = f"""
WITH {D.silver('device_metrics')}
SELECT * FROM (SELECT device_brand, household_id, device_model, efficiency_ratio, runtime_hours,
  CAST(row_number() OVER (PARTITION BY device_brand ORDER BY efficiency_ratio, runtime_hours DESC,
    household_id NULLS LAST, device_model NULLS LAST) AS INTEGER) AS position
  FROM device_metrics) WHERE position <= 5"""
    sql["billing_analytics"] = f"""
WITH {_households()}, {D.silver('tariff_metrics')}, grouped AS (
  SELECT tariff_plan_type, tariff_region, customer_category, count(*) AS n_bills,
    sum(monthly_bill) AS billed, sum(tax_amount) AS tax, sum(late_fee) AS late_fees,
    sum(subsidy_amount) AS subsidies
  FROM tariff_metrics LEFT JOIN households USING (household_id) GROUP BY ALL)
SELECT *, billed + tax + late_fees - subsidies AS revenue,
  (billed + tax + late_fees - subsidies) / sum(billed + tax + late_fees - subsidies) OVER () AS revenue_share
FROM grouped"""
    sql["forecast_features"] = f"""
WITH {D.FACT_READINGS}, daily AS (
  SELECT household_id, "timestamp"::DATE AS date, sum(energy_usage_kwh) AS kwh, count(*) AS n_readings
  FROM readings WHERE household_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY ALL)
SELECT household_id, date, kwh, n_readings, lag(kwh, 1) OVER w AS kwh_lag_1, lag(kwh, 7) OVER w AS kwh_lag_7,
  avg(kwh) OVER (PARTITION BY household_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS kwh_mean_7,
  CAST(isodow(date) AS INTEGER) AS iso_weekday, isodow(date) >= 6 AS is_weekend,
  CAST(month(date) AS INTEGER) AS month
FROM daily WINDOW w AS (PARTITION BY household_id ORDER BY date)"""
    sql["forecast_error"] = f"""
WITH {D.silver('grid_load')}
SELECT distribution_zone, count(*) AS n_feeders, avg(grid_load_kw) AS avg_load_kw,
  avg(demand_forecast_kw - grid_load_kw) AS mean_error_kw,
  avg(abs(demand_forecast_kw - grid_load_kw)) AS mean_abs_error_kw,
  max(abs(demand_forecast_kw - grid_load_kw)) AS max_abs_error_kw
FROM grid_load GROUP BY ALL"""

    sql["stream_ingest"] = "SELECT *, 'run-1' AS batch_id, 'events.parquet' AS source_name FROM events"
    sql["stream_dedup"] = "SELECT event_id, user_id, event_type, value FROM events"
    # Keys whose last copy is two delays older than the newest reading; the others are still open.
    sql["stream_silver"] = f"""
WITH {D.silver('weather_stream')},
closed AS (
  SELECT household_id, "timestamp" FROM raw_weather_stream GROUP BY ALL
  HAVING max(reading_timestamp) + INTERVAL 4 HOUR <= (SELECT max(reading_timestamp) FROM raw_weather_stream))
SELECT s.* FROM weather_stream s JOIN closed c
  ON s.household_id IS NOT DISTINCT FROM c.household_id AND s."timestamp" IS NOT DISTINCT FROM c."timestamp" """
    sql["stream_daily"] = """
SELECT day, event_type, n_readings, CAST(total_value AS DOUBLE) AS total_value, CAST(peak_value AS DOUBLE) AS peak_value FROM (
  SELECT ts::DATE AS day, event_type, count(*) AS n_readings, sum(CAST(value AS DECIMAL(18,6))) AS total_value,
    max(CAST(value AS DECIMAL(18,6))) AS peak_value FROM events GROUP BY ALL)
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"""
    sql["stream_upsert"] = """
SELECT ts::DATE AS day, event_type, count(*) AS n_readings,
  CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total_value,
  CAST(max(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS peak_value FROM events GROUP BY ALL"""
    sql["stream_silver_merged"] = f"WITH {D.silver('weather_stream')} SELECT * FROM weather_stream"
    sql["stream_audit"] = """
SELECT 'Stream_events' AS process_name, 'bronze.events' AS target_table, 'SUCCESS' AS status,
  count(*) AS n_rows, false AS says_why FROM events
UNION ALL SELECT 'Stream_events', 'bronze.events', 'LATE', count(*), false
FROM events WHERE ts::DATE = (SELECT min(ts)::DATE FROM events)
UNION ALL SELECT 'Stream_broken', 'bronze.broken', 'FAILED', 0, true"""
    return sql
