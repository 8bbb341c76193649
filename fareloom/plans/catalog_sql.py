"""SQL that gives the same rows as the queries of ``catalog``. What depends on earlier decisions (rounds of acceptance) is a recursive query."""

_ID = "nullif(upper(trim({0})), '')"
_CENTS = "CASE WHEN isfinite({0}) THEN CAST(round({0} * 100) AS BIGINT) END"
_TRIPS = f"""trips AS (
  SELECT * REPLACE (upper(trim(taxi_id)) AS taxi_id), {_ID.format('hvfhs_license_num')} AS licence, CAST(pickup_datetime AS DATE) AS day,
    {_CENTS.format('driver_pay')} AS pay, {_CENTS.format('tips')} AS tip, {_CENTS.format('trip_miles')} AS miles
  FROM monthly_taxi_trip WHERE pickup_datetime >= TIMESTAMP '2025-02-01' AND pickup_datetime < TIMESTAMP '2025-06-01' AND {_ID.format('taxi_id')} IS NOT NULL)"""
_DRIVERS = f"""drivers AS (
  SELECT DISTINCT * REPLACE ({', '.join(f"{_ID.format(c)} AS {c}" for c in ('driver_id', 'taxi_id', 'vehicle_model_id', 'manufacturer', 'model_name'))}) FROM driver_snapshot)"""
_GOLD = f"""g AS (
  SELECT DISTINCT service_area, year_month, version, {_ID.format('driver_id')} AS driver_id, {_ID.format('taxi_id')} AS taxi_id, {_ID.format('vehicle_model_id')} AS vehicle_model_id,
    manufacturer, monthly_net_profit, monthly_driver_pay FROM gold)"""
_NEWEST = "newest AS (SELECT * FROM g QUALIFY version = max(version) OVER (PARTITION BY service_area, year_month))"
_RULES = f"""rules AS (
  SELECT load_id, coalesce(pickup_datetime < dropoff_datetime, false) AS times, coalesce(isfinite(trip_miles) AND trip_miles > 0 AND trip_miles <= 1000, false) AS miles,
    coalesce(trip_time BETWEEN 1 AND 86400, false) AS duration, coalesce(isfinite(driver_pay) AND driver_pay BETWEEN 0 AND 5000, false) AS pay,
    coalesce(estimated_service_tier IN ('Standard', 'Comfort', 'Extra Comfort'), false) AS tier, {_ID.format('taxi_id')} IS NOT NULL AS taxi
  FROM monthly_taxi_trip)"""
_ALL = "(times AND miles AND duration AND pay AND tier AND taxi)"
_MASKS = """masks AS (
  SELECT taxi_id, CAST(bit_or(1 << CAST(isodow(day) - 1 AS INTEGER)) AS INTEGER) AS mask, count(*) FILTER (isodow(day) >= 6) AS weekend_trips, count(DISTINCT isodow(day)) AS weekdays
  FROM trips GROUP BY taxi_id)"""
_REQUESTS = f"""
WITH RECURSIVE {_DRIVERS},
d AS (SELECT snapshot_month, driver_id, min(vehicle_model_id) AS model, min(weekly_lease_fee) AS own_fee, min(experience_years) AS years
  FROM drivers WHERE NOT isnan(weekly_lease_fee) GROUP BY ALL),
h AS (SELECT snapshot_month, vehicle_model_id AS item, count(DISTINCT driver_id) AS held FROM drivers GROUP BY ALL),
f AS (SELECT m.snapshot_month, i.vehicle_model_id AS item, greatest(i.stock - coalesce(h.held, 0), 0) AS free
  FROM (SELECT DISTINCT snapshot_month FROM drivers) m, inventory i LEFT JOIN h ON h.snapshot_month = m.snapshot_month AND h.item = i.vehicle_model_id),
c AS (SELECT d.*, i.vehicle_model_id AS item, i.vehicle_model_id = d.model AS own, f.free, d.own_fee - i.weekly_lease_fee AS saving,
    row_number() OVER (PARTITION BY d.snapshot_month, driver_id ORDER BY i.model_year DESC, i.weekly_lease_fee, i.vehicle_model_id) AS rank
  FROM d JOIN inventory i ON i.vehicle_model_id = d.model OR i.weekly_lease_fee <= d.own_fee JOIN f ON f.snapshot_month = d.snapshot_month AND f.item = i.vehicle_model_id)"""


def _rounds(requests: str, group: str, first: str) -> str:
    """Immediate acceptance, one step of the recursion per round: a row of the state is an agent that has got something, or the round's number alone."""
    g = group.split(", ")
    same = lambda a, b: " AND ".join(f"{a}.{x} = {b}.{x}" for x in [*g, "driver_id"])
    item = lambda a, b: " AND ".join(f"{a}.{x} = {b}.{x}" for x in [*g, "item"])
    return f""",
s AS (
  SELECT 0 AS step, {', '.join(f'(SELECT any_value({x}) FROM {requests} WHERE false) AS {x}' for x in g)}, CAST(NULL AS VARCHAR) AS driver_id, CAST(NULL AS VARCHAR) AS item, CAST(NULL AS BIGINT) AS rank, CAST(NULL AS BOOLEAN) AS own
  UNION ALL
  (SELECT s.step + 1, {', '.join(f's.{x}' for x in g)}, s.driver_id, s.item, s.rank, s.own FROM s WHERE s.step < (SELECT max(rank) FROM {requests})
  UNION ALL
  SELECT step, {group}, driver_id, item, rank, own FROM (
    SELECT r.rank AS step, {', '.join(f'r.{x}' for x in g)}, r.driver_id, r.item, r.rank, r.own, r.free - coalesce(u.used, 0) AS units,
      row_number() OVER (PARTITION BY {', '.join(f'r.{x}' for x in g)}, r.item, r.own ORDER BY {first}) AS place
    FROM {requests} r JOIN (SELECT DISTINCT step FROM s) n ON r.rank = n.step + 1
    LEFT JOIN (SELECT {group}, item, count(*) AS used FROM s WHERE NOT own GROUP BY ALL) u ON {item('u', 'r')}
    WHERE NOT EXISTS (SELECT 1 FROM s t WHERE {same('t', 'r')}))
  WHERE own OR place <= units))"""


_GIVEN = "SELECT {0}, driver_id, item, CAST(rank AS INTEGER) AS rank, own FROM s WHERE driver_id IS NOT NULL AND step = (SELECT max(step) FROM s)"
_SWEEP = _REQUESTS + """,
w AS (SELECT c.* EXCLUDE (rank), least, row_number() OVER (PARTITION BY snapshot_month, least, driver_id ORDER BY saving DESC, own DESC, item) AS rank
  FROM c JOIN (SELECT unnest([0, 25, 50, 100, 200]) AS least) t ON own OR saving >= least)"""
_SWEPT = _SWEEP + _rounds("w", "snapshot_month, least", "r.saving DESC, r.driver_id")
_WEEKS = """w AS (SELECT greatest(date_trunc('week', day), DATE '2025-02-01') AS a, least(date_trunc('week', day) + INTERVAL 6 DAY, DATE '2025-05-31') AS b FROM trips),
p AS (SELECT (date_diff('day', DATE '2025-01-01', CAST(a AS DATE)) + date_diff('day', DATE '2025-01-01', CAST(b AS DATE))) // 2 AS x, count(*) / (date_diff('day', CAST(a AS DATE), CAST(b AS DATE)) + 1) AS y FROM w GROUP BY a, b)"""


_BUCKETS = f"""{_DRIVERS},
k AS (SELECT greatest(1, count(DISTINCT driver_id) // 4) AS k FROM drivers),
seeded AS (
  SELECT driver_id AS agent, min(join_date) AS since, max(exit_date) AS until, min(taxi_id) AS vehicle, bool_or(comfort_eligible) AS comfort, max(experience_years) AS years,
    CAST('0x' || substr(sha256('0:' || driver_id), 1, 15) AS BIGINT) AS seed FROM drivers WHERE driver_id IS NOT NULL GROUP BY driver_id),
ag AS (
  SELECT *, (row_number() OVER (ORDER BY agent) - 1) % k AS bucket, 127 & ~((1 << CAST(seed % 7 AS INTEGER)) | (1 << CAST(seed // 7 % 7 AS INTEGER))) AS weekdays,
    CAST(seed // 49 % 256 AS INTEGER) | 60 AS blocks, 10 + seed % 31 AS long, (seed // 1000 % 101) / 100 AS core, (seed // 100000 % 101) / 100 AS field,
    CAST(240 + 60 * least(greatest(coalesce(years, 0), 0), 6) AS DOUBLE) AS work FROM seeded, k),
jb AS (
  SELECT service_date AS day, trip_key AS job, CAST(epoch(date_trunc('second', pickup_datetime)) AS BIGINT) AS s, CAST(epoch(date_trunc('second', dropoff_datetime)) AS BIGINT) AS e, PULocationID AS o, DOLocationID AS t,
    isodow(pickup_datetime) - 1 AS weekday, hour(pickup_datetime) // 3 AS block, CAST('0x' || substr(sha256('0:' || trip_key), 1, 8) AS BIGINT) % k AS bucket,
    coalesce(service_zone = 'Core', false) AS to_core, coalesce(service_zone = 'Airfield', false) AS to_field
  FROM (SELECT DISTINCT * FROM attribution WHERE pickup_datetime IS NOT NULL AND dropoff_datetime > pickup_datetime) LEFT JOIN zone_lookup ON CAST(LocationID AS INTEGER) = DOLocationID, k),
pr AS (
  SELECT jb.*, ag.agent, vehicle, work,
    CASE WHEN NOT coalesce(since <= day AND (until IS NULL OR day < until), false) THEN 'roster' WHEN NOT coalesce(comfort OR NOT to_field, false) THEN 'grade'
      WHEN NOT ((weekdays >> CAST(weekday AS INTEGER)) & 1 = 1 AND (blocks >> CAST(block AS INTEGER)) & 1 = 1) THEN 'hours' END AS why,
    round(0.35 * (((seed >> CAST(block * 4 AS INTEGER)) & 15) / 15) + 0.3 * greatest(0, 1 - abs((e - s) / 60 - long) / long) + 0.15 * CASE WHEN to_core THEN core ELSE 1 - core END + 0.2 * CASE WHEN to_field THEN field ELSE 1 - field END, 9) AS score,
    CAST('0x' || substr(sha256('0:' || job || ':' || ag.agent), 1, 15) AS BIGINT) AS tie
  FROM jb JOIN ag USING (bucket))"""
_WALK = f"""
WITH RECURSIVE {_BUCKETS},
tm AS (
  SELECT PULocationID AS a, DOLocationID AS b, round(median((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60), 4) AS m
  FROM (SELECT DISTINCT * FROM attribution WHERE dropoff_datetime > pickup_datetime) GROUP BY ALL HAVING count(*) >= 5),
nj AS (SELECT *, row_number() OVER (PARTITION BY bucket, day ORDER BY s, job) AS i FROM jb),
st AS (
  SELECT 0 AS i, g.bucket, g.day, ag.agent, ag.vehicle, ag.work, CAST(NULL AS BIGINT) AS first, CAST(NULL AS BIGINT) AS last, CAST(NULL AS INTEGER) AS place, CAST(0 AS DOUBLE) AS used, 0 AS jobs,
    CAST(NULL AS VARCHAR) AS job, CAST(NULL AS DOUBLE) AS way, CAST(NULL AS VARCHAR) AS refused, false AS offered
  FROM (SELECT DISTINCT bucket, day FROM jb) g JOIN ag USING (bucket)
  UNION ALL
  SELECT i, bucket, day, agent, vehicle, work, CASE WHEN won THEN coalesce(first, s) ELSE first END, CASE WHEN won THEN e ELSE last END, CASE WHEN won THEN t ELSE place END,
    CASE WHEN won THEN used + (e - s) / 60 + ride ELSE used END, CASE WHEN won THEN jobs + 1 ELSE jobs END, CASE WHEN won THEN job END, CASE WHEN won THEN ride END,
    CASE WHEN candidate AND (best IS NULL OR nth < best) THEN no END, candidate AND (best IS NULL OR nth <= best)
  FROM (
    SELECT *, min(nth) FILTER (candidate AND no IS NULL) OVER (PARTITION BY bucket, day) AS best, coalesce(nth = best, false) AS won
    FROM (
      SELECT nj.i, st.bucket, st.day, st.agent, st.vehicle, st.work, st.first, st.last, st.place, st.used, st.jobs, nj.job, nj.s, nj.e, nj.t, pr.job IS NOT NULL AS candidate,
        CASE WHEN st.jobs = 0 OR st.place = nj.o THEN 0 ELSE tm.m END AS ride,
        row_number() OVER (PARTITION BY st.bucket, st.day ORDER BY pr.job IS NULL, pr.score DESC, pr.tie, st.agent) AS nth,
        CASE WHEN st.jobs > 0 AND ride IS NULL THEN 'unknown_way' WHEN st.jobs > 0 AND ride > 30 THEN 'far' WHEN st.jobs > 0 AND st.last + ride * 60 > nj.s THEN 'late'
          WHEN st.jobs > 0 AND (nj.e - st.first) / 60 > 720 THEN 'span' WHEN st.used + (nj.e - nj.s) / 60 + ride > st.work THEN 'work'
          WHEN st.vehicle IS NOT NULL AND max(st.last) OVER (PARTITION BY st.bucket, st.day, st.vehicle) > nj.s THEN 'vehicle' END AS no
      FROM st JOIN nj ON nj.bucket = st.bucket AND nj.day = st.day AND nj.i = st.i + 1
      LEFT JOIN pr ON pr.job = nj.job AND pr.agent = st.agent AND pr.why IS NULL
      LEFT JOIN tm ON tm.a = st.place AND tm.b = nj.o))),
done AS (SELECT i, bucket, day, max(job) AS job, max(agent) FILTER (job IS NOT NULL) AS agent, max(jobs) FILTER (job IS NOT NULL) AS sequence, max(way) AS way, count(*) FILTER (offered) AS offers FROM st WHERE i > 0 GROUP BY ALL)"""


def _unmatched(top: str, left: str, right: str, key: str) -> str:
    return f"{top}SELECT DISTINCT {key} FROM {left} ANTI JOIN {right} USING ({key})"


ORACLE = {
    "trip_rule_counts": f"""WITH {_RULES}
SELECT load_id, count(*) AS total, count(*) FILTER {_ALL.replace('(', '(WHERE ', 1)} AS valid, count(*) FILTER (WHERE NOT {_ALL}) AS invalid,
  {', '.join(f'count(*) FILTER (WHERE NOT {r}) AS {r}' for r in ('times', 'miles', 'duration', 'pay', 'tier', 'taxi'))} FROM rules GROUP BY load_id""",
    "trip_reject_reasons": f"""WITH {_RULES}
SELECT concat_ws(',', {', '.join(f"CASE WHEN NOT {r} THEN '{r}' END" for r in ('times', 'miles', 'duration', 'pay', 'tier', 'taxi'))}) AS reasons, count(*) AS n FROM rules GROUP BY ALL""",
    "trip_gate": f"""WITH {_RULES},
c AS (SELECT load_id, count(*) AS total, count(*) FILTER (WHERE NOT {_ALL}) AS invalid FROM rules GROUP BY load_id)
SELECT load_id, total, invalid, CASE WHEN invalid >= 0.12 * total THEN 'fail' WHEN invalid > 0 AND invalid >= 0.05 * total THEN 'warn' ELSE 'pass' END AS verdict FROM c""",
    "unusable_numbers": "SELECT year_month, " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR NOT isfinite({c})) AS {c}" for c in ("trip_miles", "driver_pay", "tips")) + " FROM monthly_taxi_trip GROUP BY year_month",
    "month_mismatch": "SELECT year_month, count(*) AS n FROM monthly_taxi_trip WHERE strftime(pickup_datetime, '%Y-%m') <> year_month GROUP BY year_month",
    "taxi_weekdays": f"WITH {_TRIPS}, {_MASKS} SELECT * FROM masks",
    "active_drivers": f"WITH {_DRIVERS} SELECT snapshot_month, count(DISTINCT driver_id) AS drivers FROM drivers WHERE join_date <= DATE '2025-05-20' AND (exit_date IS NULL OR exit_date > DATE '2025-05-20') GROUP BY 1",
    "comparable_names": "SELECT nullif(trim(upper(regexp_replace(pickup_zone, '\\s+', ' ', 'g'))), '') AS zone_key, count(*) AS n, count(DISTINCT pickup_zone) AS spellings FROM monthly_taxi_trip GROUP BY 1",
    "price_mentions": """WITH x AS (
  SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '\\$ ?([0-9][0-9,]*(?:\\.[0-9]+)?)', 1), lambda a, i: struct_pack(i := i, v := TRY_CAST(replace(a, ',', '') AS DOUBLE)))) AS p FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(p.i AS INTEGER) AS place, CASE WHEN p.v BETWEEN 50 AND 5000 THEN p.v END AS price, NOT (p.v BETWEEN 50 AND 5000) AS out_of_bounds FROM x""",
    "stripped_lengths": "SELECT doc_id, CAST(length(trim(regexp_replace(regexp_replace(replace(regexp_replace(text, '<[^<>]*>', ' ', 'g'), '&nbsp;', ' '), '\\s+', ' ', 'g'), '\\s+', ' ', 'g'))) AS INTEGER) AS plain_chars FROM documents WHERE regexp_matches(text, '<[^<>]*>')",
    "product_years": """WITH m AS (SELECT manufacturer AS make, model_name AS model, min(model_year) AS y FROM inventory GROUP BY ALL),
p AS (SELECT make, model, 'Standard' AS product, y AS year FROM m UNION ALL SELECT make, model, 'Comfort', y FROM m
  UNION ALL SELECT make, model, 'Standard', y + 2 FROM m UNION ALL SELECT make, model, 'Extra Comfort', y + 2 FROM m)
SELECT make, model, product, CAST(min(year) AS INTEGER) AS first_year, count(*) AS mentions FROM p GROUP BY ALL""",
    "model_profiles": f"""WITH {_DRIVERS}
SELECT d.snapshot_month, d.vehicle_model_id, count(*) AS drivers, max(i.fuel_efficiency) AS fuel_efficiency, CAST(max(i.model_year) AS INTEGER) AS model_year
FROM drivers d JOIN inventory i ON i.vehicle_model_id = d.vehicle_model_id AND i.fuel_type IS NOT DISTINCT FROM d.fuel_type
  AND i.comfort_eligible IS NOT DISTINCT FROM d.comfort_eligible AND i.extra_comfort_eligible IS NOT DISTINCT FROM d.extra_comfort_eligible GROUP BY ALL""",
    "unknown_taxis": _unmatched(f"WITH {_DRIVERS}, a AS (SELECT {_ID.format('driver_id')} AS driver_id FROM attribution) ", "drivers", "a", "driver_id") + " ORDER BY driver_id LIMIT 20",
    "zone_pairs": """SELECT p.Borough AS pickup, d.Borough AS dropoff, count(*) AS n FROM monthly_taxi_trip t
LEFT JOIN zone_lookup p ON CAST(p.LocationID AS INTEGER) = t.PULocationID LEFT JOIN zone_lookup d ON CAST(d.LocationID AS INTEGER) = t.DOLocationID GROUP BY ALL""",
    "attributed_trips": f"""WITH {_TRIPS}, {_DRIVERS},
a AS (SELECT DISTINCT trip_key, {_ID.format('taxi_id')} AS taxi_id, {_ID.format('driver_id')} AS driver_id, pickup_datetime AS "at", strftime(service_date, '%Y-%m') AS month FROM attribution),
t AS (SELECT DISTINCT taxi_id, pickup_datetime AS "at", pay FROM trips),
d AS (SELECT DISTINCT snapshot_month AS month, driver_id, vehicle_model_id AS model FROM drivers)
SELECT month, model, count(*) AS trips, CAST(sum(pay) AS BIGINT) AS pay_cents FROM a JOIN t USING (taxi_id, "at") JOIN d USING (month, driver_id) GROUP BY ALL""",
    "vehicle_matches": f"""WITH {_DRIVERS},
s AS (SELECT taxi_id, driver_id, vehicle_since, max(exit_date) AS exit_date FROM drivers GROUP BY ALL),
f AS (SELECT DISTINCT trip_key, {_ID.format('taxi_id')} AS taxi_id, service_date FROM attribution),
m AS (SELECT f.trip_key, count(s.taxi_id) AS matches FROM f LEFT JOIN s ON s.taxi_id = f.taxi_id AND s.vehicle_since <= f.service_date AND (s.exit_date IS NULL OR f.service_date < s.exit_date) GROUP BY ALL)
SELECT matches, count(*) AS trips FROM m GROUP BY ALL""",
    "asof_snapshot": f"""WITH {_DRIVERS},
f AS (SELECT DISTINCT trip_key, {_ID.format('driver_id')} AS driver_id, pickup_datetime AS "at" FROM attribution),
s AS (SELECT driver_id, snapshot_created_at AS made, max(struct_pack(snapshot_month := snapshot_month, vehicle_model_id := vehicle_model_id)) AS v FROM drivers GROUP BY ALL)
SELECT f.trip_key, f.driver_id, s.v.snapshot_month AS snapshot_month, s.v.vehicle_model_id AS vehicle_model_id
FROM f ASOF LEFT JOIN s ON s.driver_id = f.driver_id AND s.made <= f.at""",
    "versions_without_load": "SELECT DISTINCT service_area, year_month, version FROM gold ANTI JOIN gold_load_versions l USING (service_area, year_month, version)",
    "busy_zones": "SELECT Borough, count(*) AS zones, count(*) FILTER (WHERE CAST(LocationID AS INTEGER) IN (SELECT PULocationID FROM monthly_taxi_trip WHERE PULocationID IS NOT NULL)) AS used FROM zone_lookup GROUP BY Borough",
    "model_variants": """WITH n AS (SELECT manufacturer, model_name AS m FROM inventory UNION SELECT manufacturer, regexp_replace(model_name, ' (AWD|XL|HYBRID)$', '') FROM inventory)
SELECT DISTINCT a.manufacturer, a.m AS base, b.m AS variant FROM n a JOIN n b ON a.manufacturer = b.manufacturer AND starts_with(b.m, a.m || ' ')
WHERE regexp_matches(substr(b.m, length(a.m) + 2), '^(AWD|XL)( (AWD|XL))*$')""",
    "cheaper_models": f"""WITH {_DRIVERS}, d AS (SELECT snapshot_month, driver_id, min(weekly_lease_fee) AS f FROM drivers WHERE NOT isnan(weekly_lease_fee) GROUP BY ALL)
SELECT snapshot_month, driver_id, count(i.stock) AS cheaper FROM d LEFT JOIN inventory i ON i.weekly_lease_fee < d.f GROUP BY ALL""",
    "profit_thresholds": f"""WITH {_GOLD}, s AS (SELECT unnest([1000, 2000, 3000, 4000, 5000]) AS threshold)
SELECT service_area, year_month, version, threshold, count(DISTINCT driver_id) AS drivers FROM g JOIN s ON isfinite(monthly_net_profit) AND monthly_net_profit >= threshold GROUP BY ALL""",
    "driver_month_totals": f"""WITH {_TRIPS}, {_DRIVERS},
t AS (SELECT DISTINCT taxi_id, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, miles, pay, tip, day FROM trips),
p AS (SELECT taxi_id, strftime(day, '%Y-%m') AS month, count(*) AS trips, CAST(sum(miles) AS BIGINT) AS miles_100, CAST(sum(pay) AS BIGINT) AS pay_cents, CAST(sum(tip) AS BIGINT) AS tip_cents FROM t GROUP BY ALL),
d AS (SELECT DISTINCT snapshot_month AS month, taxi_id, driver_id FROM drivers)
SELECT driver_id, month, trips, miles_100, pay_cents, tip_cents FROM p JOIN d USING (month, taxi_id)""",
    "tier_rates": f"""WITH {_TRIPS},
t AS (SELECT *, CASE WHEN miles < 200 THEN '0-2' WHEN miles < 500 THEN '2-5' WHEN miles < 1000 THEN '5-10' WHEN miles < 2000 THEN '10-20' ELSE '20+' END AS band FROM trips WHERE miles > 0 AND pay >= 0 AND licence IS NOT NULL)
SELECT licence, band, {', '.join(f"round(sum(pay) FILTER (WHERE estimated_service_tier = '{n}') / nullif(sum(miles) FILTER (WHERE estimated_service_tier = '{n}'), 0), 6) AS {n.lower().replace(' ', '_')}" for n in ('Standard', 'Comfort', 'Extra Comfort'))}
FROM t GROUP BY ALL""",
    "totals_kept": f"""WITH {_TRIPS}, s AS (SELECT 'trips' AS part, sum(pay) AS p, count(*) AS n FROM trips),
d AS (SELECT taxi_id, day, sum(pay) AS p, count(*) AS n FROM trips GROUP BY ALL), b AS (SELECT 'days' AS part, sum(p) AS p, sum(n) AS n FROM d)
SELECT part, CAST(p AS BIGINT) AS pay_cents, CAST(n AS BIGINT) AS n, (SELECT p FROM s) = (SELECT p FROM b) AS same FROM (SELECT * FROM s UNION ALL SELECT * FROM b)""",
    "trip_key_counts": "SELECT strftime(service_date, '%Y-%m-%d') AS day, count(*) AS \"rows\", count(DISTINCT trip_key) AS keys, count(*) FILTER (WHERE trip_key IS NULL) AS null_keys FROM attribution GROUP BY ALL",
    "repeated_trips": "SELECT trip_key, count(*) AS n FROM attribution GROUP BY trip_key HAVING count(*) > 1",
    "zone_minutes": """SELECT PULocationID, DOLocationID, count(*) AS trips, round(median((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60), 4) AS minutes
FROM (SELECT DISTINCT * FROM attribution WHERE dropoff_datetime > pickup_datetime) GROUP BY ALL HAVING count(*) >= 5""",
    "fleet_by_model": f"WITH {_DRIVERS}, d AS (SELECT snapshot_month, taxi_id, min(vehicle_model_id) AS model FROM drivers GROUP BY ALL) SELECT snapshot_month, model, count(*) AS stock FROM d GROUP BY ALL",
    "maker_ranges": "SELECT manufacturer, min(fuel_efficiency) AS low, max(fuel_efficiency) AS high, count(*) AS models, CASE WHEN count(DISTINCT fuel_type) > 1 THEN 'MIXED' ELSE min(fuel_type) END AS fuel FROM inventory GROUP BY ALL",
    "first_taxi": f"""WITH {_GOLD} SELECT service_area, vehicle_model_id, year_month AS since, driver_id FROM g WHERE driver_id IS NOT NULL AND vehicle_model_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY service_area, vehicle_model_id ORDER BY year_month, driver_id) = 1""",
    "snapshot_kpis": f"""WITH {_GOLD}, {_NEWEST}, n AS (SELECT *, {_CENTS.format('monthly_net_profit')} AS c FROM newest WHERE isfinite(monthly_net_profit))
SELECT service_area, year_month, count(*) AS drivers, round(sum(c) / count(*), 3) AS mean_cents, round(median(c), 3) AS median_cents, count(DISTINCT vehicle_model_id) AS models FROM n GROUP BY ALL""",
    "top_zones": """WITH c AS (SELECT CAST(PULocationID AS VARCHAR) AS v, count(*) AS n FROM monthly_taxi_trip WHERE PULocationID IS NOT NULL GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS r FROM c)
SELECT CASE WHEN r <= 7 THEN v ELSE 'other' END AS label, CAST(sum(n) AS BIGINT) AS n, count(*) AS members FROM r GROUP BY 1""",
    "top_makers": f"""WITH {_GOLD}, c AS (SELECT service_area, manufacturer AS v, count(*) AS n FROM g WHERE manufacturer IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY service_area ORDER BY n DESC, v) AS r FROM c)
SELECT service_area, CASE WHEN r <= 3 THEN v ELSE 'other' END AS label, CAST(sum(n) AS BIGINT) AS n, count(*) AS members FROM r GROUP BY ALL""",
    "profit_histogram": f"""WITH {_GOLD} SELECT service_area, CAST(least(23, greatest(0, floor((monthly_net_profit + 2000) / 500))) AS INTEGER) AS bin, count(*) AS n
FROM g WHERE monthly_net_profit IS NOT NULL AND NOT isnan(monthly_net_profit) GROUP BY ALL""",
    "working_capacity": f"""WITH {_TRIPS}, {_MASKS}, days AS (SELECT CAST(unnest(generate_series(DATE '2025-04-01', DATE '2025-04-30', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT taxi_id, count(*) AS days FROM masks JOIN days ON mask & (1 << CAST(isodow(d) - 1 AS INTEGER)) <> 0 GROUP BY taxi_id""",
    "shared_units": """WITH s AS (SELECT manufacturer, CAST(sum(stock) AS BIGINT) AS weight FROM inventory GROUP BY 1),
e AS (SELECT *, weight * 1000 / sum(weight) OVER () AS x FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, manufacturer) AS r, 1000 - sum(floor(x)) OVER () AS rest FROM e)
SELECT manufacturer, weight, CAST(floor(x) + CASE WHEN r <= rest THEN 1 ELSE 0 END AS BIGINT) AS units FROM r""",
    "numbered_units": "SELECT vehicle_model_id, vehicle_model_id || '#' || lpad(CAST(i AS VARCHAR), 5, '0') AS unit_id FROM (SELECT vehicle_model_id, unnest(range(stock)) AS i FROM inventory)",
    "snapshot_grain": f"WITH {_GOLD} SELECT service_area, year_month, version, count(*) AS n, count(DISTINCT driver_id) AS drivers, count(*) = count(DISTINCT driver_id) AS one_each FROM g WHERE driver_id IS NOT NULL GROUP BY ALL",
    "best_attributions": f"""WITH a AS (SELECT DISTINCT service_date, PULocationID, trip_key, preference_score, tie_break FROM attribution WHERE {_ID.format('driver_id')} IS NOT NULL OR driver_id IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY service_date, PULocationID ORDER BY preference_score DESC, tie_break, trip_key) AS place FROM a)
SELECT strftime(service_date, '%Y-%m-%d') AS day, PULocationID, trip_key, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3""",
    "occurrences": f"""WITH {_TRIPS}, r AS (SELECT row_number() OVER (PARTITION BY taxi_id, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID ORDER BY load_id) AS occurrence FROM trips)
SELECT CAST(occurrence AS INTEGER) AS occurrence, count(*) AS n FROM r GROUP BY ALL""",
    "dear_trips": f"""WITH {_TRIPS}, t AS (SELECT licence, PULocationID, DOLocationID, pay FROM trips WHERE pay IS NOT NULL AND licence IS NOT NULL AND PULocationID IS NOT NULL),
w AS (SELECT *, count(*) OVER p AS n, median(pay) OVER p AS m FROM t WINDOW p AS (PARTITION BY licence, PULocationID, DOLocationID))
SELECT licence, PULocationID, DOLocationID, n, count(*) FILTER (WHERE pay >= m * 1.15) AS dear FROM w WHERE n >= 20 GROUP BY ALL""",
    "newest_version": f"WITH {_GOLD}, {_NEWEST} SELECT service_area, year_month, version, driver_id, taxi_id FROM newest",
    "expired": """WITH v AS (SELECT DISTINCT service_area, year_month, version FROM gold), t AS (SELECT *, max(version) OVER (PARTITION BY service_area, year_month) AS top FROM v)
SELECT t.service_area, t.year_month, t.version FROM t JOIN gold_load_versions l USING (service_area, year_month, version) WHERE t.version < t.top AND l.created_at <= TIMESTAMP '2025-05-10'""",
    "best_hours": f"""WITH {_TRIPS}, c AS (SELECT taxi_id, {', '.join(f'count(*) FILTER (WHERE hour(pickup_datetime) // 3 = {i}) AS b{i}' for i in range(8))} FROM trips GROUP BY taxi_id),
s AS (SELECT taxi_id, [{', '.join(f'b{i} + b{i + 1} + b{i + 2}' for i in range(6))}] AS s FROM c)
SELECT taxi_id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS first_block FROM s""",
    "all_versions": "SELECT service_area, year_month, version FROM gold UNION SELECT service_area, year_month, version FROM gold_load_versions",
    "month_calendar": """WITH m AS (SELECT DISTINCT snapshot_month, CAST(snapshot_month || '-01' AS DATE) AS d FROM driver_snapshot)
SELECT snapshot_month, strftime(unnest(generate_series(d, last_day(d), INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM m""",
    "daily_from_weekly": f"""WITH {_TRIPS}, {_WEEKS},
g AS (SELECT CAST(unnest(range(31, 151)) AS INTEGER) AS "at"),
n AS (SELECT "at", (SELECT max(x) FROM p WHERE x <= "at") AS b, (SELECT min(x) FROM p WHERE x >= "at") AS a FROM g)
SELECT "at", round(CASE WHEN b IS NULL THEN pa.y WHEN a IS NULL THEN pb.y WHEN a = b THEN pa.y ELSE pb.y + (pa.y - pb.y) * ("at" - b) / (a - b) END, 6) AS value,
  CASE WHEN b IS NULL OR a IS NULL THEN 'extended' WHEN a = b THEN 'observed' ELSE 'interpolated' END AS kind
FROM n LEFT JOIN p pb ON pb.x = n.b LEFT JOIN p pa ON pa.x = n.a""",
    "monthly_fees": f"""WITH {_DRIVERS}, p AS (
  SELECT manufacturer, CAST(substr(snapshot_month, 1, 4) AS INTEGER) * 12 + CAST(substr(snapshot_month, 6, 2) AS INTEGER) - 1 AS x, sum(CAST(round(weekly_lease_fee * 100) AS BIGINT)) / count(*) AS y
  FROM drivers WHERE NOT isnan(weekly_lease_fee) AND manufacturer IS NOT NULL GROUP BY ALL),
g AS (SELECT manufacturer, unnest(range(24300, 24307)) AS "at" FROM (SELECT DISTINCT manufacturer FROM p)),
n AS (SELECT g.manufacturer, g.at, max(p.x) FILTER (WHERE p.x <= g.at) AS b, min(p.x) FILTER (WHERE p.x >= g.at) AS a FROM g JOIN p USING (manufacturer) GROUP BY ALL)
SELECT n.manufacturer, CAST(n.at AS INTEGER) AS "at", round(CASE WHEN b IS NULL THEN pa.y WHEN a IS NULL THEN pb.y WHEN a = b THEN pa.y ELSE pb.y + (pa.y - pb.y) * (n.at - b) / (a - b) END, 3) AS fee,
  CASE WHEN b IS NULL OR a IS NULL THEN 'extended' WHEN a = b THEN 'observed' ELSE 'interpolated' END AS kind
FROM n LEFT JOIN p pb ON pb.x = n.b AND pb.manufacturer = n.manufacturer LEFT JOIN p pa ON pa.x = n.a AND pa.manufacturer = n.manufacturer""",
    "daily_completeness": f"""WITH {_TRIPS}, days AS (SELECT CAST(unnest(generate_series(DATE '2025-01-25', DATE '2025-06-05', INTERVAL 1 DAY)) AS DATE) AS day),
a AS (SELECT day, count(*) AS trips FROM trips GROUP BY day), b AS (SELECT published_on AS day, count(*) AS documents FROM documents WHERE published_on IS NOT NULL GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, trips, documents, trips IS NOT NULL AND documents IS NOT NULL AS complete FROM days LEFT JOIN a USING (day) LEFT JOIN b USING (day)""",
    "stale_taxis": f"""WITH {_TRIPS}, l AS (SELECT taxi_id, max(day) FILTER (WHERE day <= DATE '2025-05-20') AS l FROM trips GROUP BY taxi_id)
SELECT taxi_id, strftime(l, '%Y-%m-%d') AS last, CAST(DATE '2025-05-20' - l AS INTEGER) AS days, coalesce(DATE '2025-05-20' - l > 7, true) AS stale FROM l""",
    "decayed_activity": f"""WITH {_TRIPS},
c AS (SELECT Borough, CAST(day - DATE '2025-02-01' AS INTEGER) AS "at", count(*) AS n FROM trips JOIN zone_lookup z ON CAST(z.LocationID AS INTEGER) = PULocationID GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY Borough ORDER BY "at") AS i FROM c)
SELECT a.Borough, a.at, round(sum(b.n * power(0.8, a.i - b.i)), 4) AS state FROM o a JOIN o b ON a.Borough = b.Borough AND b.i <= a.i GROUP BY ALL""",
    "folded_users": """WITH e AS (SELECT user_id, ts, value, event_type, CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS o FROM events WHERE event_type IN ('error', 'signup', 'click')),
last AS (SELECT user_id, max(struct_pack(ts := ts, o := o)) AS j FROM e WHERE event_type = 'signup' GROUP BY user_id),
s AS (SELECT e.*, j.ts AS opened FROM e JOIN last USING (user_id) WHERE struct_pack(ts := e.ts, o := e.o) >= j)
SELECT user_id, strftime(max(opened), '%Y-%m-%d %H:%M:%S') AS opened_at, strftime(max(ts) FILTER (WHERE event_type = 'error'), '%Y-%m-%d %H:%M:%S') AS closed_at,
  round(arg_max(value, struct_pack(ts := ts, o := o)) FILTER (WHERE event_type <> 'error'), 4) AS value, strftime(max(ts) FILTER (WHERE event_type <> 'error'), '%Y-%m-%d %H:%M:%S') AS since
FROM s GROUP BY user_id""",
    "rebuilt_states": f"""WITH {_DRIVERS}, n AS (SELECT * FROM drivers QUALIFY snapshot_month = max(snapshot_month) OVER (PARTITION BY driver_id)),
m AS (SELECT driver_id, max(taxi_id) AS t, max(join_date) AS j, max(exit_date) AS x, max(vehicle_since) AS v FROM n GROUP BY driver_id)
SELECT driver_id, strftime(j, '%Y-%m-%d') AS opened, CASE WHEN x >= j THEN strftime(x, '%Y-%m-%d') END AS closed, t AS value, strftime(greatest(j, v), '%Y-%m-%d') AS since FROM m""",
    "accepted_requests": _REQUESTS + _rounds("c", "snapshot_month", "r.years DESC, r.driver_id") + _GIVEN.format("snapshot_month"),
    "savings_sweep": _SWEPT + _GIVEN.format("snapshot_month, least"),
    "sweep_grain": _SWEPT
    + """,
q AS (SELECT snapshot_month, least, count(DISTINCT driver_id) AS asking, count(DISTINCT (driver_id, item)) = count(*) AS one_row_a_choice FROM w GROUP BY ALL),
z AS (SELECT s.*, w.saving, w.free FROM s JOIN w USING (snapshot_month, least, driver_id, item) WHERE step = (SELECT max(step) FROM s)),
o AS (SELECT snapshot_month, least, count(*) AS over FROM (SELECT snapshot_month, least, item FROM z WHERE NOT own GROUP BY ALL HAVING count(*) > any_value(free)) GROUP BY ALL),
t AS (SELECT snapshot_month, least, count(*) AS given, count(DISTINCT driver_id) = count(*) AS one_row_a_driver, min(saving) >= 0 AS no_loss FROM z GROUP BY ALL)
SELECT snapshot_month, least, asking, given, one_row_a_choice, one_row_a_driver, coalesce(over, 0) AS over, no_loss FROM q LEFT JOIN t USING (snapshot_month, least) LEFT JOIN o USING (snapshot_month, least)""",
    "single_pass_requests": _REQUESTS
    + """,
p AS (SELECT *, CASE WHEN NOT own THEN row_number() OVER (PARTITION BY snapshot_month, item, own ORDER BY years DESC, driver_id) END AS place FROM c)
SELECT snapshot_month, driver_id, item, CAST(rank AS INTEGER) AS rank, own FROM p WHERE own OR place <= free QUALIFY row_number() OVER (PARTITION BY snapshot_month, driver_id ORDER BY p.rank) = 1""",
    "bucketed_candidates": f"""WITH {_DRIVERS},
k AS (SELECT greatest(1, count(DISTINCT driver_id) // 4) AS k FROM drivers),
d AS (SELECT driver_id AS agent, (row_number() OVER (ORDER BY driver_id) - 1) % k AS bucket FROM (SELECT DISTINCT driver_id FROM drivers WHERE driver_id IS NOT NULL), k),
a AS (SELECT DISTINCT * FROM attribution WHERE pickup_datetime IS NOT NULL AND dropoff_datetime > pickup_datetime),
x AS (SELECT service_date, trip_key AS job, CAST('0x' || substr(sha256('0:' || trip_key), 1, 8) AS BIGINT) % k AS bucket FROM a, k)
SELECT bucket, strftime(service_date, '%Y-%m-%d') AS day, count(agent) AS pairs, count(DISTINCT job) AS jobs FROM x LEFT JOIN d USING (bucket) GROUP BY ALL""",
    "candidate_rules": f"""WITH {_BUCKETS},
n AS (SELECT day, count(*) AS looked_at, {', '.join(f"count(*) FILTER (why = '{r}') AS {r}" for r in ('roster', 'grade', 'hours'))}, count(*) FILTER (why IS NULL) AS candidates FROM pr GROUP BY day)
SELECT strftime(day, '%Y-%m-%d') AS day, jobs, looked_at, roster, grade, hours, candidates FROM n JOIN (SELECT day, count(*) AS jobs FROM jb GROUP BY day) USING (day)""",
    "candidate_scores": f"WITH {_BUCKETS} SELECT job, bucket, agent, score FROM pr WHERE why IS NULL QUALIFY row_number() OVER (PARTITION BY job ORDER BY score DESC, tie, agent) = 1",
    "greedy_trips": _WALK
    + """
SELECT nj.job, agent, CAST(sequence AS INTEGER) AS sequence, round(way, 4) AS way_minutes, CAST(offers AS INTEGER) AS offers FROM nj JOIN done USING (bucket, day, i)""",
    "greedy_refusals": _WALK
    + """
SELECT (SELECT count(*) FROM nj) AS jobs, count(job) AS given, count(*) FILTER (offered) AS offers, """
    + ", ".join(f"count(*) FILTER (refused = '{r}') AS {r}" for r in ("unknown_way", "far", "late", "span", "work", "vehicle"))
    + " FROM st WHERE i > 0",
    "assignment_contract": f"""WITH a AS (SELECT *, {_ID.format('driver_id')} AS agent FROM attribution),
r AS (SELECT count(*) AS n FROM attribution GROUP BY trip_key)
SELECT 'missing' AS "check", count(*) FILTER (service_date IS NULL OR trip_key IS NULL OR pickup_datetime IS NULL OR dropoff_datetime IS NULL OR PULocationID IS NULL OR DOLocationID IS NULL) AS broken FROM a
UNION ALL SELECT 'not_after_start', count(*) FILTER (date_trunc('second', dropoff_datetime) <= date_trunc('second', pickup_datetime)) FROM a
UNION ALL SELECT 'repeated_candidate', 0
UNION ALL SELECT 'nameless_candidate', count(*) FILTER (agent IS NULL) FROM a
UNION ALL SELECT 'repeated_job', count(*) FILTER (n > 1) FROM r
UNION ALL SELECT 'repeated_way', 0 UNION ALL SELECT 'negative_way', 0""",
    "attribution_quality": f"""WITH a AS (SELECT DISTINCT * FROM attribution)
SELECT strftime(service_date, '%Y-%m-%d') AS day, count(*) AS trips, count({_ID.format('driver_id')}) AS assigned, count(DISTINCT {_ID.format('driver_id')}) AS drivers,
  CAST(sum(epoch(dropoff_datetime) - epoch(pickup_datetime)) FILTER (WHERE dropoff_datetime > pickup_datetime) AS BIGINT) AS drive_s,
  CAST(sum(CASE WHEN isfinite(deadhead_minutes) THEN CAST(round(deadhead_minutes * 10) AS BIGINT) END) AS BIGINT) AS wait_tenths, count(*) FILTER (WHERE isnan(deadhead_minutes) OR deadhead_minutes > 20) AS clipped
FROM a GROUP BY service_date""",
    "required_values": "SELECT count(*) AS \"rows\", count(*) FILTER (WHERE driver_id IS NULL OR taxi_id IS NULL OR fuel_type IS NULL OR exit_date IS NULL OR join_date IS NULL) AS broken, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in ("driver_id", "taxi_id", "fuel_type", "exit_date", "join_date"))
    + " FROM driver_snapshot",
    "snapshot_balance": f"""WITH {_DRIVERS}, d AS (SELECT snapshot_month, driver_id, max(exit_date) AS x FROM drivers GROUP BY ALL),
c AS (SELECT snapshot_month, count(*) AS total, count(*) FILTER (WHERE x <= last_day(CAST(snapshot_month || '-01' AS DATE))) AS gone FROM d GROUP BY 1)
SELECT *, total - gone AS "left" FROM c""",
    "trip_keys": f"""WITH {_TRIPS}, o AS (
  SELECT *, row_number() OVER (PARTITION BY taxi_id, PULocationID, DOLocationID, trip_time, pickup_datetime) AS occurrence FROM trips)
SELECT sha256(concat_ws(chr(31), {', '.join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in ('taxi_id', 'PULocationID', 'DOLocationID', 'trip_time'))}, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), occurrence)) AS trip_key, taxi_id, CAST(occurrence AS INTEGER) AS occurrence FROM o""",
    "day_loads": f"""WITH {_TRIPS}, {_WEEKS},
c AS (SELECT date_diff('day', DATE '2025-01-01', day) AS x, count(*) AS n FROM trips GROUP BY day),
m AS (SELECT c.x, c.n, (SELECT max(x) FROM p WHERE p.x <= c.x) AS b, (SELECT min(x) FROM p WHERE p.x >= c.x) AS a FROM c)
SELECT CAST(m.x AS INTEGER) AS "at", n AS trips, round(n / CASE WHEN b IS NULL THEN pa.y WHEN a IS NULL THEN pb.y WHEN a = b THEN pa.y ELSE pb.y + (pa.y - pb.y) * (m.x - b) / (a - b) END, 6) AS ratio
FROM m LEFT JOIN p pb ON pb.x = m.b LEFT JOIN p pa ON pa.x = m.a""",
    "overbooked_models": f"""WITH {_DRIVERS}, u AS (SELECT snapshot_month, vehicle_model_id AS model, count(DISTINCT driver_id) AS used FROM drivers GROUP BY ALL)
SELECT model, snapshot_month, used, stock FROM u LEFT JOIN inventory ON vehicle_model_id = model WHERE stock IS NULL OR used > stock""",
    "filled_fees": f"""WITH {_DRIVERS}, d AS (SELECT driver_id, snapshot_month, max(CASE WHEN isfinite(weekly_lease_fee) THEN CAST(round(weekly_lease_fee * 100) AS BIGINT) END) AS f FROM drivers GROUP BY ALL)
SELECT driver_id, snapshot_month, last_value(f IGNORE NULLS) OVER (PARTITION BY driver_id ORDER BY snapshot_month ROWS UNBOUNDED PRECEDING) AS fee_cents FROM d""",
    "favourite_zones": f"""WITH {_TRIPS}, c AS (SELECT taxi_id, PULocationID, count(*) AS n FROM trips GROUP BY ALL), w AS (SELECT *, sum(n) OVER (PARTITION BY taxi_id) AS a FROM c)
SELECT taxi_id, PULocationID, n, round(n / a, 6) AS share FROM w WHERE PULocationID IS NOT NULL AND n * 5 >= a""",
    "driver_experience": f"""WITH {_DRIVERS}, d AS (SELECT snapshot_month, driver_id, join_date, last_day(CAST(snapshot_month || '-01' AS DATE)) AS e FROM drivers)
SELECT snapshot_month, CAST(floor((e - join_date) / 365.25) AS BIGINT) AS years, count(DISTINCT driver_id) AS drivers FROM d WHERE join_date <= e GROUP BY ALL""",
    "model_flags": f"""WITH {_DRIVERS}, s AS (SELECT vehicle_model_id, bool_or(comfort_eligible) AS seen_comfort, bool_or(extra_comfort_eligible) AS seen_extra FROM drivers GROUP BY 1)
SELECT i.vehicle_model_id, i.comfort_eligible, i.extra_comfort_eligible, seen_comfort, seen_extra FROM inventory i LEFT JOIN s USING (vehicle_model_id)""",
}
