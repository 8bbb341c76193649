"""SQL that gives the same rows as the queries of ``training``."""

_ID = "nullif(upper(trim({0})), '')"
_USABLE = "pickup_datetime >= TIMESTAMP '2025-02-01' AND pickup_datetime < TIMESTAMP '2025-06-01'"
_TRIPS = f"trips AS (SELECT {_ID.format('taxi_id')} AS taxi, * FROM monthly_taxi_trip WHERE {_USABLE} AND nullif(trim(taxi_id), '') IS NOT NULL)"
_AMOUNT = "CASE WHEN isfinite({0}) THEN CAST(round({0} * 100) AS BIGINT) END"

_PERIODS = f"""
WITH iv AS (
  SELECT DISTINCT {_ID.format('driver_id')} AS driver_id, date_trunc('second', pickup_datetime) AS s, date_trunc('second', dropoff_datetime) AS e
  FROM attribution WHERE dropoff_datetime > pickup_datetime),
marked AS (
  SELECT *, max(e) OVER (PARTITION BY driver_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
  FROM iv WHERE driver_id IS NOT NULL),
numbered AS (
  SELECT *, sum(CASE WHEN prior IS NULL OR s > prior THEN 1 ELSE 0 END) OVER (PARTITION BY driver_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
  FROM marked),
periods AS (SELECT driver_id, island, min(s) AS s, max(e) AS e FROM numbered GROUP BY ALL),
found AS (
  SELECT driver_id, 'period' AS kind, s AS a, e AS b FROM periods
  UNION ALL
  SELECT driver_id, 'gap', lag(e) OVER w, s FROM periods WINDOW w AS (PARTITION BY driver_id ORDER BY island)
)"""

_SESSIONS = f"""
WITH {_TRIPS},
marked AS (
  SELECT taxi, pickup_datetime AS t, lag(pickup_datetime) OVER (PARTITION BY taxi ORDER BY pickup_datetime) AS prior FROM trips),
numbered AS (
  SELECT *, sum(CASE WHEN prior IS NULL OR epoch(t) - epoch(prior) > 14400 THEN 1 ELSE 0 END) OVER (PARTITION BY taxi ORDER BY t) AS session
  FROM marked),
found AS (SELECT taxi AS taxi_id, session, min(t) AS a, max(t) AS b, count(*) AS pickups FROM numbered GROUP BY ALL)"""

_DAYS = """
spans AS (SELECT taxi, min(day) AS a, max(day) AS b FROM daily GROUP BY taxi),
dense AS (SELECT taxi, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM spans)"""

_FIGURES = """
raw AS (
  SELECT load_id, 'driver_pay' AS column_name, CASE WHEN NOT isnan(driver_pay) THEN driver_pay END AS num, NULL AS txt FROM monthly_taxi_trip
  UNION ALL SELECT load_id, 'tips', CASE WHEN NOT isnan(tips) THEN tips END, NULL FROM monthly_taxi_trip
  UNION ALL SELECT load_id, 'estimated_service_tier', NULL, estimated_service_tier FROM monthly_taxi_trip),
judged AS (
  SELECT *, num IS NOT NULL OR txt IS NOT NULL AS known,
    coalesce(num BETWEEN 0 AND 2000, false) OR coalesce(txt IN ('Standard', 'Comfort', 'Extra Comfort'), false) AS fits FROM raw),
figures AS (
  SELECT load_id, column_name, count(*) AS "rows", count(*) FILTER (NOT known) AS nulls, count(*) FILTER (fits) AS fitting,
    count(*) FILTER (known AND NOT fits) AS misfits, count(DISTINCT coalesce(CAST(num + 0.0 AS VARCHAR), txt)) AS distinct_values,
    count(*) FILTER (fits AND num = 0) AS zeros, count(*) FILTER (txt = 'Standard') AS standard, median(num) FILTER (fits) AS q50
  FROM judged GROUP BY ALL)"""

ORACLE = {
    "p2_found": _PERIODS + "\nSELECT driver_id, kind, strftime(a, '%Y-%m-%d %H:%M:%S') AS start_ts, strftime(b, '%Y-%m-%d %H:%M:%S') AS end_ts FROM found WHERE a IS NOT NULL",
    "p2_driver_coverage": _PERIODS
    + """
SELECT driver_id, count(*) FILTER (kind = 'period') AS periods, CAST(sum(epoch(b) - epoch(a)) FILTER (kind = 'period') AS BIGINT) AS busy_s,
  CAST(coalesce(sum(epoch(b) - epoch(a)) FILTER (kind = 'gap'), 0) AS BIGINT) AS idle_s
FROM found WHERE a IS NOT NULL GROUP BY driver_id""",
    "p3_found": f"""
WITH {_TRIPS},
daily AS (SELECT taxi, CAST(pickup_datetime AS DATE) AS day, count(*) AS n FROM trips GROUP BY ALL),{_DAYS},
filled AS (SELECT dense.taxi, dense.day, coalesce(n, 0) AS n FROM dense LEFT JOIN daily USING (taxi, day)),
rolled AS (
  SELECT taxi, day, sum(n) OVER (PARTITION BY taxi ORDER BY day ROWS 6 PRECEDING) AS n7, sum(n) OVER (PARTITION BY taxi ORDER BY day ROWS 29 PRECEDING) AS n30 FROM filled)
SELECT taxi AS taxi_id, strftime(day, '%Y-%m-%d') AS day FROM rolled WHERE n7 = 0 AND n30 > 0""",
    "p3_taxi_days": f"""
WITH {_TRIPS},
once AS (SELECT DISTINCT taxi, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, driver_pay, tips FROM trips),
daily AS (
  SELECT taxi, CAST(pickup_datetime AS DATE) AS day, count(*) AS n, count({_AMOUNT.format('driver_pay')}) AS paid, coalesce(sum({_AMOUNT.format('driver_pay')}), 0) AS cents
  FROM once GROUP BY ALL),{_DAYS},
filled AS (SELECT dense.taxi, dense.day, coalesce(n, 0) AS n, coalesce(paid, 0) AS paid, coalesce(cents, 0) AS cents FROM dense LEFT JOIN daily USING (taxi, day)),
rolled AS (
  SELECT taxi, day, CAST(sum(n) OVER w7 AS BIGINT) AS n7, CAST(sum(paid) OVER w7 AS BIGINT) AS p7, CAST(sum(cents) OVER w7 AS BIGINT) AS c7,
    CAST(sum(n) OVER w30 AS BIGINT) AS n30, CAST(sum(paid) OVER w30 AS BIGINT) AS p30, CAST(sum(cents) OVER w30 AS BIGINT) AS c30
  FROM filled WINDOW w7 AS (PARTITION BY taxi ORDER BY day ROWS 6 PRECEDING), w30 AS (PARTITION BY taxi ORDER BY day ROWS 29 PRECEDING))
SELECT taxi AS taxi_id, strftime(day, '%Y-%m-%d') AS day, n7 AS trips_7, c7 AS pay_cents_7, CAST(c7 AS DOUBLE) / nullif(p7, 0) AS cents_per_trip_7, CAST(c7 AS DOUBLE) / 7 AS cents_per_day_7,
  n30 AS trips_30, c30 AS pay_cents_30, CAST(c30 AS DOUBLE) / nullif(p30, 0) AS cents_per_trip_30, CAST(c30 AS DOUBLE) / 30 AS cents_per_day_30
FROM rolled""",
    "p4_found": """
WITH keys AS (
  SELECT 'PULocationID' AS key_column, CAST(PULocationID AS VARCHAR) AS key_value FROM monthly_taxi_trip
  UNION ALL SELECT 'hvfhs_license_num', hvfhs_license_num FROM monthly_taxi_trip)
SELECT key_column, key_value FROM keys WHERE key_value IS NOT NULL GROUP BY ALL HAVING count(*) >= 0.03 * (SELECT count(*) FROM monthly_taxi_trip)""",
    "p4_key_pay": f"""
WITH keys AS (
  SELECT 'PULocationID' AS key_column, CAST(PULocationID AS VARCHAR) AS key_value, {_AMOUNT.format('driver_pay')} AS v FROM monthly_taxi_trip
  UNION ALL SELECT 'hvfhs_license_num', hvfhs_license_num, {_AMOUNT.format('driver_pay')} FROM monthly_taxi_trip),
counted AS (SELECT key_column, key_value, v, count(*) AS n FROM keys WHERE key_value IS NOT NULL AND v IS NOT NULL GROUP BY ALL),
modes AS (SELECT key_column, key_value, v AS mode, n AS mode_rows FROM counted QUALIFY row_number() OVER (PARTITION BY key_column, key_value ORDER BY n DESC, v) = 1),
totals AS (
  SELECT key_column, key_value, count(*) AS trips, count(DISTINCT v) AS pay_values, CAST(sum(v) AS BIGINT) AS pay_cents,
    quantile_disc(v, 0.5) AS pay_cents_p50, quantile_disc(v, 0.9) AS pay_cents_p90
  FROM keys WHERE key_value IS NOT NULL GROUP BY ALL)
SELECT totals.*, mode AS pay_cents_mode, mode_rows FROM totals LEFT JOIN modes USING (key_column, key_value)""",
    "p4_key_miles": f"""
WITH keys AS (
  SELECT 'PULocationID' AS key_column, CAST(PULocationID AS VARCHAR) AS key_value, {_AMOUNT.format('trip_miles')} AS v FROM monthly_taxi_trip
  UNION ALL SELECT 'hvfhs_license_num', hvfhs_license_num, {_AMOUNT.format('trip_miles')} FROM monthly_taxi_trip)
SELECT key_column, key_value, count(*) AS trips, count(v) AS measured, CAST(sum(v) AS BIGINT) AS miles_100 FROM keys WHERE key_value IS NOT NULL GROUP BY ALL""",
    "p5_found": f"""
WITH ids AS (
  SELECT DISTINCT service_area, year_month, version, {_ID.format('driver_id')} AS driver_id, {_ID.format('taxi_id')} AS taxi_id, {_ID.format('vehicle_model_id')} AS model FROM gold),
states AS (SELECT service_area, year_month, version, driver_id, list_sort(list(coalesce(taxi_id, '?') || '/' || coalesce(model, '?'))) AS state FROM ids WHERE driver_id IS NOT NULL GROUP BY ALL),
versions AS (
  SELECT *, lag(version) OVER (PARTITION BY service_area, year_month ORDER BY version) AS prior FROM (SELECT DISTINCT service_area, year_month, version FROM ids)),
new AS (SELECT states.* FROM states JOIN versions USING (service_area, year_month, version) WHERE prior IS NOT NULL),
old AS (SELECT v.service_area, v.year_month, v.version, s.driver_id, s.state FROM versions v JOIN states s ON s.service_area = v.service_area AND s.year_month = v.year_month AND s.version = v.prior)
SELECT service_area, year_month, version, driver_id, CASE WHEN old.state IS NULL THEN 'added' WHEN new.state IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM new FULL JOIN old USING (service_area, year_month, version, driver_id) WHERE new.state IS DISTINCT FROM old.state""",
    "p6_found": _SESSIONS + "\nSELECT taxi_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS session_start, strftime(b, '%Y-%m-%d %H:%M:%S') AS session_end FROM found",
    "p6_session_sizes": _SESSIONS + "\nSELECT taxi_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS session_start, CAST(epoch(b) - epoch(a) AS BIGINT) AS duration_s, pickups FROM found",
    "p7_profile": f"""
WITH {_FIGURES},
freq AS (SELECT load_id, column_name, num, txt, count(*) AS n FROM judged WHERE known GROUP BY ALL),
points AS (SELECT column_name, num, txt, sum(n) AS n FROM freq GROUP BY ALL),
pooled AS (SELECT column_name, num, txt, sum(n) OVER (PARTITION BY column_name ORDER BY num, txt) / sum(n) OVER (PARTITION BY column_name) AS f FROM points),
loads AS (SELECT DISTINCT load_id, column_name FROM freq),
curves AS (
  SELECT l.load_id, p.column_name, p.num, p.txt, p.f, sum(coalesce(q.n, 0)) OVER (PARTITION BY l.load_id, p.column_name ORDER BY p.num, p.txt)
    / sum(coalesce(q.n, 0)) OVER (PARTITION BY l.load_id, p.column_name) AS own
  FROM pooled p JOIN loads l USING (column_name)
  LEFT JOIN freq q ON q.load_id = l.load_id AND q.column_name = p.column_name AND q.num IS NOT DISTINCT FROM p.num AND q.txt IS NOT DISTINCT FROM p.txt),
far AS (SELECT load_id, column_name, round(max(abs(own - f)), 9) AS ks FROM curves GROUP BY ALL),
turns AS (SELECT load_id, column_name, lag(load_id) OVER (PARTITION BY column_name ORDER BY load_id) AS last_id FROM loads),
steps AS (SELECT a.load_id, a.column_name, round(max(abs(a.own - b.own)), 9) AS ks_prior FROM turns JOIN curves a USING (load_id, column_name)
  JOIN curves b ON b.load_id = last_id AND b.column_name = a.column_name AND b.num IS NOT DISTINCT FROM a.num AND b.txt IS NOT DISTINCT FROM a.txt GROUP BY ALL)
SELECT load_id, column_name, "rows", nulls, fitting, misfits, distinct_values, zeros, q50, ks, ks_prior FROM figures LEFT JOIN far USING (load_id, column_name) LEFT JOIN steps USING (load_id, column_name)""",
    "p7_found": f"""
WITH {_FIGURES},
each AS (
  SELECT *, CASE column_name WHEN 'driver_pay' THEN q50 WHEN 'tips' THEN zeros / nullif(fitting, 0) ELSE standard / nullif(fitting, 0) END AS figure FROM figures),
usual AS (SELECT column_name, median(figure) AS usual FROM each GROUP BY ALL)
SELECT load_id, column_name, 'nulls' AS finding FROM each WHERE nulls > 0.08 * "rows"
UNION ALL SELECT load_id, column_name, 'range' FROM each WHERE column_name <> 'estimated_service_tier' AND misfits > 0.03 * ("rows" - nulls)
UNION ALL SELECT load_id, column_name, 'pattern' FROM each WHERE column_name = 'estimated_service_tier' AND misfits > 0.05 * ("rows" - nulls)
UNION ALL SELECT load_id, column_name, 'shift' FROM each JOIN usual USING (column_name)
  WHERE CASE WHEN column_name = 'driver_pay' THEN figure > 1.5 * usual OR figure < usual / 1.5 ELSE abs(figure - usual) > 0.2 END""",
}
