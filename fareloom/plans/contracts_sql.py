"""SQL that gives the same rows as the queries of ``contracts``."""

from fareloom.plans.catalog_sql import _BUCKETS, _CENTS, _DRIVERS, _GIVEN, _GOLD, _ID, _NEWEST, _REQUESTS, _TRIPS, ORACLE as _OTHERS, _rounds

_MISSING = " AND ".join(f"{c} IS NOT NULL" for c in ("taxi_id", "hvfhs_license_num", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID", "trip_miles", "trip_time", "driver_pay", "tips", "estimated_service_tier"))
_CLEAN = f"""clean AS (
  SELECT *, {_MISSING} AND trim(taxi_id) <> '' AND trim(hvfhs_license_num) <> '' AND trim(estimated_service_tier) <> '' AS present,
    coalesce(pickup_datetime < dropoff_datetime AND isfinite(trip_miles) AND trip_miles > 0 AND trip_miles <= 1000 AND trip_time BETWEEN 1 AND 86400
      AND isfinite(driver_pay) AND driver_pay BETWEEN 0 AND 5000 AND isfinite(tips) AND tips BETWEEN 0 AND 5000, false) AS value,
    coalesce(hvfhs_license_num = 'HV0003' AND estimated_service_tier IN ('Standard', 'Comfort') OR hvfhs_license_num = 'HV0005' AND estimated_service_tier IN ('Standard', 'Extra Comfort'), false) AS tier
  FROM monthly_taxi_trip)"""
_KEPT = "(coalesce(present, false) AND value AND tier)"
_BANDED = f"""{_TRIPS},
t AS (SELECT *, CASE WHEN miles < 200 THEN '0-2' WHEN miles < 500 THEN '2-5' WHEN miles < 1000 THEN '5-10' WHEN miles < 2000 THEN '10-20' ELSE '20+' END AS band FROM trips WHERE miles > 0 AND pay >= 0 AND licence IS NOT NULL),
r AS (SELECT licence, band, {', '.join(f"sum(pay) FILTER (WHERE estimated_service_tier = '{n}') / nullif(sum(miles) FILTER (WHERE estimated_service_tier = '{n}'), 0) AS {n.lower().replace(' ', '_')}" for n in ('Standard', 'Comfort', 'Extra Comfort'))} FROM t GROUP BY ALL)"""
_VIEWS = f"""{_REQUESTS}{_rounds("c", "snapshot_month", "r.years DESC, r.driver_id")},
x AS ({_GIVEN.format("snapshot_month AS year_month")}),
{_GOLD}, {_NEWEST},
v AS (
  SELECT service_area, year_month, driver_id, current, profit_cents, x.item AS given, x.own
  FROM (SELECT service_area, year_month, driver_id, max(vehicle_model_id) AS current, max({_CENTS.format('monthly_net_profit')}) AS profit_cents FROM newest WHERE isfinite(monthly_net_profit) GROUP BY ALL) JOIN x USING (year_month, driver_id))"""
_EMPTY = [("snapshot_month", "s"), ("driver_id", "s"), ("taxi_id", "s"), ("vehicle_model_id", "s"), ("manufacturer", "s"), ("model_name", "s"), ("fuel_type", "s"), ("comfort_eligible", ""), ("extra_comfort_eligible", ""), ("weekly_lease_fee", "d"), ("join_date", ""), ("exit_date", ""), ("experience_years", ""), ("vehicle_since", ""), ("snapshot_created_at", "")]


def _checks(by: str, source: str, checks: dict[str, tuple[str, float]]) -> str:
    head = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{n}' AS \"check\", count(*) AS total, count(*) FILTER (WHERE NOT coalesce({c}, false)) AS failed, count(*) FILTER (WHERE coalesce({c}, false)) >= count(*) * {share} AS passed FROM {source}" + (f" GROUP BY {by}" if by else "")
        for n, (c, share) in checks.items()
    )


ORACLE = {
    "clean_trips": f"WITH {_CLEAN} SELECT year_month, count(*) AS n, CAST(sum(trip_time) AS BIGINT) AS seconds, CAST(sum({_CENTS.format('driver_pay')}) AS BIGINT) AS pay_cents FROM clean WHERE {_KEPT} GROUP BY year_month",
    "clean_reasons": f"""WITH {_CLEAN} SELECT load_id, count(*) AS total, count(*) FILTER (WHERE {_KEPT}) AS valid, count(*) FILTER (WHERE NOT {_KEPT}) AS invalid,
  count(*) FILTER (WHERE NOT coalesce(present, false)) AS missing_or_type, count(*) FILTER (WHERE NOT value) AS value, count(*) FILTER (WHERE NOT tier) AS service_tier FROM clean GROUP BY load_id""",
    "trip_reconciliation": f"WITH {_CLEAN} SELECT load_id, count(*) AS total, count(*) FILTER (WHERE {_KEPT}) AS kept, count(*) - count(*) FILTER (WHERE {_KEPT}) AS rejected, true AS balanced FROM clean WHERE load_id IS NOT NULL GROUP BY load_id",
    "trip_suite": f"WITH {_CLEAN} "
    + _checks("load_id", "clean", {"in_month": ("strftime(pickup_datetime, '%Y-%m') = year_month", 0.9), "known_tier": ("estimated_service_tier IN ('Standard', 'Comfort', 'Extra Comfort')", 0.97), "record": (_KEPT, 0.9), "has_load": ("load_id IS NOT NULL", 1.0)}),
    "placed_trips": f"""WITH z AS (SELECT CAST(LocationID AS INTEGER) AS z FROM zone_lookup WHERE Borough <> 'Unknown')
SELECT year_month, count(*) AS n, count(*) FILTER (WHERE {_ID.format('taxi_id')} IS NULL) AS without_taxi FROM monthly_taxi_trip
WHERE isfinite(driver_pay) AND driver_pay BETWEEN 0 AND 5000 AND PULocationID IN (SELECT z FROM z) AND DOLocationID IN (SELECT z FROM z) GROUP BY year_month""",
    "cast_failures": """SELECT count(*) FILTER (TRY_CAST(LocationID AS INTEGER) IS NULL) AS LocationID, count(*) FILTER (TRY_CAST(Borough AS DOUBLE) IS NULL) AS Borough, count(*) FILTER (service_zone IS NULL) AS service_zone FROM zone_lookup""",
    "natural_collisions": """WITH k AS (SELECT count(*) AS n FROM monthly_taxi_trip GROUP BY taxi_id, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, driver_pay, tips)
SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) AS keys, CAST(sum(n) - count(*) AS BIGINT) AS collisions, round((sum(n) - count(*)) / sum(n), 9) AS ratio, CASE WHEN (sum(n) - count(*)) / sum(n) >= 0.05 THEN 'fail' ELSE 'pass' END AS verdict FROM k""",
    "skip_gate": f"""WITH p AS ({_OTHERS['price_mentions'].replace('WITH x AS', 'WITH xx AS').replace('FROM x', 'FROM xx')})
SELECT source, count(*) AS total, count(*) FILTER (out_of_bounds) AS invalid, CASE WHEN count(*) FILTER (out_of_bounds) > 0.01 * count(*) THEN 'fail' ELSE 'skip' END AS verdict FROM p JOIN documents USING (doc_id) GROUP BY source""",
    "inventory_errors": " UNION ALL ".join(
        f"SELECT vehicle_model_id, '{n}' AS reason FROM inventory WHERE NOT coalesce({c}, false)"
        for n, c in {"id": f"{_ID.format('vehicle_model_id')} IS NOT NULL", "year": "model_year BETWEEN 2019 AND 2100", "fee": "isfinite(weekly_lease_fee) AND weekly_lease_fee > 0", "efficiency": "isfinite(fuel_efficiency) AND fuel_efficiency > 0", "stock": "stock >= 10", "image": "image_url IS NOT NULL"}.items()
    ),
    "dimension_checks": f"""WITH d AS (SELECT DISTINCT * REPLACE ({_ID.format('driver_id')} AS driver_id), {_ID.format('vehicle_model_id')} AS model FROM driver_snapshot),
n AS (SELECT snapshot_month, driver_id, count(*) AS n FROM d GROUP BY ALL),
k AS (SELECT snapshot_month, CAST(coalesce(sum(n) FILTER (driver_id IS NULL), 0) AS BIGINT) AS nameless, count(*) FILTER (n > 1 AND driver_id IS NOT NULL) AS repeated FROM n GROUP BY 1),
h AS (SELECT snapshot_month, model, count(DISTINCT driver_id) AS held FROM d GROUP BY ALL),
m AS (SELECT snapshot_month, count(*) FILTER (stock IS NULL) AS unknown_models, count(*) FILTER (held > stock) AS overbooked FROM h LEFT JOIN inventory ON vehicle_model_id = model GROUP BY 1),
f AS (SELECT snapshot_month, count(*) FILTER (weekly_lease_fee IS NULL OR NOT isfinite(weekly_lease_fee) OR weekly_lease_fee <= 0) AS bad_fees FROM d GROUP BY 1)
SELECT * FROM k JOIN m USING (snapshot_month) JOIN f USING (snapshot_month)""",
    "column_quality": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) FILTER ({c} IS NULL) AS nulls, {f'count(*) FILTER (length(trim({c})) = 0)' if k == 's' else '0'} AS blanks, {f'count(*) FILTER (isnan({c}))' if k == 'd' else '0'} AS nans FROM driver_snapshot"
        for c, k in _EMPTY
    ),
    "snapshot_rules": f"""WITH {_DRIVERS},
g AS (SELECT * FROM drivers WHERE exit_date IS NULL AND driver_id IS NOT NULL AND taxi_id IS NOT NULL AND isfinite(weekly_lease_fee) AND weekly_lease_fee > 0 AND fuel_type IS NOT NULL),
c AS (SELECT snapshot_month, count(*) AS total, count(*) FILTER (exit_date IS NULL) AS stay, count(exit_date) AS gone FROM drivers GROUP BY 1),
t AS (SELECT snapshot_month, count(*) AS repeated FROM (SELECT snapshot_month, driver_id FROM g GROUP BY ALL HAVING count(*) > 1) GROUP BY 1)
SELECT snapshot_month, total, stay, gone, total = stay + gone AS balanced, coalesce(good, 0) AS good, coalesce(repeated, 0) AS repeated
FROM c LEFT JOIN (SELECT snapshot_month, count(*) AS good FROM g GROUP BY 1) USING (snapshot_month) LEFT JOIN t USING (snapshot_month)""",
    "contract_integrity": f"""WITH {_DRIVERS}, d AS (SELECT DISTINCT snapshot_month, driver_id, taxi_id, exit_date FROM drivers),
a AS (SELECT snapshot_month, taxi_id, count(DISTINCT driver_id) AS n FROM d WHERE exit_date IS NULL GROUP BY ALL),
s AS (SELECT DISTINCT strftime(service_date, '%Y-%m') AS snapshot_month, {_ID.format('driver_id')} AS driver_id FROM attribution),
i AS (SELECT snapshot_month, count(*) AS n FROM (SELECT DISTINCT snapshot_month, driver_id FROM d ANTI JOIN s USING (snapshot_month, driver_id)) GROUP BY 1)
SELECT snapshot_month, count(*) AS taxis, count(*) FILTER (a.n > 1) AS shared, coalesce(any_value(i.n), 0) AS without_trips FROM a LEFT JOIN i USING (snapshot_month) GROUP BY 1""",
    "one_date_each": """WITH d AS (SELECT snapshot_month, count(DISTINCT CAST(snapshot_created_at AS DATE)) AS dates, max(CAST(snapshot_created_at AS DATE)) AS l FROM driver_snapshot GROUP BY 1)
SELECT snapshot_month, dates, dates = 1 AS "one", CAST(DATE '2025-05-20' - l AS INTEGER) AS age, DATE '2025-05-20' - l <= 45 AS fresh FROM d""",
    "agent_contract": f"WITH {_BUCKETS} SELECT * FROM (SELECT count(*) AS total, CAST(0 AS BIGINT) AS failed, true AS passed FROM ag), (SELECT unnest(['named', 'eight_weights', 'weights', 'weekdays', 'blocks', 'work', 'unique']) AS \"check\")",
    "attribution_ceiling": f"""WITH a AS (SELECT DISTINCT *, {_ID.format('driver_id')} AS who FROM attribution WHERE dropoff_datetime > pickup_datetime),
p AS (SELECT service_date, count(*) AS trips, count(who) AS given, count(DISTINCT who) AS drivers, CAST(sum(epoch(date_trunc('second', dropoff_datetime)) - epoch(date_trunc('second', pickup_datetime))) FILTER (who IS NOT NULL) AS BIGINT) AS used
  FROM (SELECT DISTINCT * FROM a) GROUP BY 1)
SELECT strftime(service_date, '%Y-%m-%d') AS day, trips, given, drivers, round(given / trips, 6) AS coverage, round(used / (drivers * 36000), 6) AS saturation FROM p""",
    "tier_multipliers": f"""WITH {_BANDED}
SELECT licence, band, count(*) AS trips, CAST(sum(pay) AS BIGINT) AS pay_cents, round(sum(pay * (1 + 0.3 * (coalesce(comfort / nullif(standard, 0), 1) - 1))), 2) AS as_comfort,
  round(sum(pay * (1 + 0.3 * (coalesce(extra_comfort / nullif(standard, 0), 1) - 1))), 2) AS as_extra FROM t LEFT JOIN r USING (licence, band) WHERE estimated_service_tier = 'Standard' GROUP BY ALL""",
    "missing_multipliers": f"""WITH {_BANDED}, n AS (SELECT *, CASE licence WHEN 'HV0003' THEN comfort / nullif(standard, 0) WHEN 'HV0005' THEN extra_comfort / nullif(standard, 0) END AS m FROM r WHERE standard IS NOT NULL)
SELECT licence, band FROM n WHERE m IS NULL OR NOT isfinite(m)""",
    "driver_models": f"""WITH {_DRIVERS}, d AS (SELECT snapshot_month, driver_id, min(vehicle_model_id) AS model, min(weekly_lease_fee) AS mine FROM drivers WHERE isfinite(weekly_lease_fee) GROUP BY ALL)
SELECT snapshot_month, count(*) AS "rows", count(DISTINCT (driver_id, vehicle_model_id)) AS pairs, count(*) FILTER (vehicle_model_id = model) AS own, count(*) FILTER (vehicle_model_id <> model AND weekly_lease_fee < mine) AS cheaper,
  count(*) FILTER (vehicle_model_id <> model AND weekly_lease_fee >= mine) AS not_cheaper FROM d, inventory GROUP BY 1""",
    "suggested_models": _VIEWS + "\nSELECT service_area, year_month, driver_id, current, given, profit_cents FROM v WHERE NOT own",
    "suggestion_gains": _VIEWS
    + """,
i AS (SELECT vehicle_model_id AS m, CAST(round(fuel_efficiency * 10) AS BIGINT) AS e FROM inventory)
SELECT service_area, year_month, CASE WHEN b.e > a.e THEN 'better' WHEN b.e < a.e THEN 'worse' ELSE 'same' END AS verdict, count(*) AS drivers, count(*) FILTER (NOT own) AS changed, CAST(sum(a.e) AS BIGINT) AS before, CAST(sum(b.e) AS BIGINT) AS after
FROM v LEFT JOIN i a ON a.m = current LEFT JOIN i b ON b.m = given GROUP BY ALL""",
    "scoped_profit": f"WITH {_GOLD}, {_NEWEST} SELECT service_area, year_month, count(DISTINCT driver_id) AS drivers FROM newest WHERE isfinite(monthly_net_profit) AND monthly_net_profit >= 1500 AND monthly_driver_pay > 0 GROUP BY ALL",
    "ordered_profits": f"""WITH {_GOLD}, {_NEWEST}, p AS (SELECT service_area, year_month, driver_id, max({_CENTS.format('monthly_net_profit')}) AS profit_cents FROM newest WHERE isfinite(monthly_net_profit) AND driver_id IS NOT NULL GROUP BY ALL)
SELECT row_number() OVER (ORDER BY profit_cents DESC, service_area, year_month, driver_id) AS place, * FROM p""",
    "driver_numbers": f"WITH {_DRIVERS} SELECT driver_id, row_number() OVER (ORDER BY driver_id) AS number FROM (SELECT DISTINCT driver_id FROM drivers WHERE driver_id IS NOT NULL)",
    "capacity_minutes": f"""WITH {_BUCKETS}, m AS (SELECT DISTINCT snapshot_month, CAST(snapshot_month || '-01' AS DATE) AS d FROM driver_snapshot),
c AS (SELECT snapshot_month, isodow(x) - 1 AS w, count(*) AS n FROM (SELECT snapshot_month, unnest(generate_series(d, last_day(d), INTERVAL 1 DAY)) AS x FROM m) GROUP BY ALL)
SELECT agent AS driver_id, snapshot_month, CAST(sum(n) AS BIGINT) AS days, sum(n * work) AS minutes FROM ag JOIN c ON (weekdays >> CAST(w AS INTEGER)) & 1 = 1 GROUP BY ALL""",
    "lease_inventory": f"""WITH {_DRIVERS}, d AS (SELECT snapshot_month, taxi_id, min(vehicle_model_id) AS model FROM drivers GROUP BY ALL), f AS (SELECT snapshot_month, model, count(*) AS stock FROM d WHERE model IS NOT NULL GROUP BY ALL),
s AS (SELECT manufacturer, model_name, (min(CAST(round(fuel_efficiency * 10) AS BIGINT)) + max(CAST(round(fuel_efficiency * 10) AS BIGINT))) / 2 AS efficiency_tenths FROM inventory GROUP BY ALL)
SELECT snapshot_month, model, f.stock, fuel_type, efficiency_tenths FROM f LEFT JOIN inventory i ON i.vehicle_model_id = model LEFT JOIN s USING (manufacturer, model_name)""",
    "eligibility_groups": """SELECT CASE WHEN comfort_eligible AND extra_comfort_eligible THEN 'BOTH' WHEN comfort_eligible OR extra_comfort_eligible THEN 'SINGLE' ELSE 'STANDARD' END AS kind, model_year >= 2023 AS recent, count(*) AS models, CAST(sum(stock) AS BIGINT) AS stock FROM inventory GROUP BY ALL""",
    "fuel_classes": """SELECT fuel_type, CASE WHEN lower(trim(coalesce(fuel_type, ''))) IN ('ev', 'electric', 'electricity') THEN 'EV' WHEN lower(fuel_type) LIKE '%plug-in%' OR lower(fuel_type) LIKE '%phev%' THEN 'PHEV' WHEN lower(fuel_type) LIKE '%hybrid%' THEN 'HYBRID' ELSE 'GAS' END AS fuel, count(*) AS n
FROM driver_snapshot GROUP BY ALL""",
    "tier_aliases": """SELECT estimated_service_tier AS spelling, count(*) AS n, CASE lower(trim(estimated_service_tier)) WHEN 'standard' THEN 'Standard' WHEN 'comfort' THEN 'Comfort' WHEN 'extra comfort' THEN 'Extra Comfort' WHEN 'std' THEN 'Standard' WHEN 'xl comfort' THEN 'Extra Comfort' END AS tier
FROM monthly_taxi_trip WHERE estimated_service_tier IS NOT NULL GROUP BY ALL""",
    "model_years": r"""WITH y AS (SELECT source, CAST(unnest(list_filter(string_split_regex(text, '[^0-9]+'), lambda x: length(x) = 4)) AS INTEGER) AS y FROM documents WHERE text IS NOT NULL)
SELECT source, count(*) AS n, count(*) FILTER (y BETWEEN 1980 AND 2100) AS years, count(*) FILTER (NOT y BETWEEN 1980 AND 2100) AS bad, min(y) FILTER (y BETWEEN 1980 AND 2100) AS low, max(y) FILTER (y BETWEEN 1980 AND 2100) AS high FROM y GROUP BY source""",
    "eligibility_lines": """WITH p AS (SELECT manufacturer, model_name, model_year, 'Standard' AS product FROM inventory UNION ALL SELECT manufacturer, model_name, model_year, 'Comfort' FROM inventory WHERE comfort_eligible)
SELECT manufacturer AS make, product, count(*) AS n, CAST(min(model_year) AS INTEGER) AS first, count(DISTINCT model_name) AS models FROM p GROUP BY ALL""",
    "card_links": "SELECT manufacturer || ' ' || model_name AS title, 'https://lease.test/cars/' || vehicle_model_id AS address, CAST(weekly_lease_fee AS INTEGER) AS fee FROM inventory",
    "spec_matches": """WITH i AS (SELECT DISTINCT manufacturer, model_name AS n FROM inventory),
b AS (SELECT manufacturer, regexp_replace(n, ' (AWD|XL|HYBRID)$', '') AS n FROM i UNION SELECT manufacturer, n || ' ZZ' FROM i),
e AS (SELECT b.manufacturer, b.n, b.n AS s, 'exact' AS tier FROM b JOIN i ON i.manufacturer = b.manufacturer AND i.n = b.n),
v AS (SELECT b.manufacturer, b.n, i.n AS s, 'variant' AS tier FROM b JOIN i ON i.manufacturer = b.manufacturer AND regexp_matches(substr(i.n, length(b.n) + 1), '^( (AWD|XL|HYBRID))+$') AND starts_with(i.n, b.n || ' ') WHERE (b.manufacturer, b.n) NOT IN (SELECT (manufacturer, n) FROM e)),
m AS (SELECT b.manufacturer, b.n AS model_name, f.tier, f.s FROM b LEFT JOIN (SELECT * FROM e UNION ALL SELECT * FROM v) f USING (manufacturer, n))
SELECT m.manufacturer, m.model_name, tier, count(k.fuel_efficiency) AS trims, min(CAST(round(k.fuel_efficiency * 10) AS BIGINT)) AS low, max(CAST(round(k.fuel_efficiency * 10) AS BIGINT)) AS high,
  CASE WHEN count(DISTINCT k.fuel_type) > 1 THEN 'MIXED' ELSE min(k.fuel_type) END AS fuel FROM m LEFT JOIN inventory k ON k.manufacturer = m.manufacturer AND k.model_name = m.s GROUP BY ALL""",
    "month_slices": f"""WITH {_DRIVERS}, m AS (SELECT DISTINCT snapshot_month FROM drivers)
SELECT snapshot_month, count(doc_id) AS n, count(doc_id) AS within FROM m LEFT JOIN documents ON strftime(published_on, '%Y-%m') = snapshot_month GROUP BY 1""",
    "daily_fees": f"""WITH f AS ({_OTHERS['monthly_fees']}),
m AS (SELECT manufacturer, round(fee / 700 * 1.1, 6) AS daily, kind, make_date("at" // 12, "at" % 12 + 1, 1) AS d FROM f)
SELECT manufacturer, strftime(unnest(generate_series(d, last_day(d), INTERVAL 1 DAY)), '%Y-%m-%d') AS day, daily, kind FROM m""",
    "daily_statuses": f"""WITH {_TRIPS}, t AS (SELECT day, CASE WHEN PULocationID > 100 THEN 1 ELSE 0 END AS half, sum(pay) / sum(miles) AS rate FROM trips WHERE miles > 0 AND pay >= 0 GROUP BY ALL),
s AS (SELECT * FROM t WHERE (half = 0 OR day(day) % 5 = 0) AND day(day) <> 13),
c AS (SELECT CAST(unnest(generate_series(DATE '2025-02-01', DATE '2025-05-31', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT strftime(c.day, '%Y-%m-%d') AS day, count(rate) AS n, CASE WHEN count(rate) = 0 THEN 'missing' WHEN count(rate) > 1 THEN 'repeated' WHEN count(*) FILTER (rate > 0.05 AND rate < 15) = 0 THEN 'unusable' ELSE 'ok' END AS status FROM c LEFT JOIN s USING (day) GROUP BY c.day""",
    "area_states": "SELECT service_area, count(*) AS n, CASE lower(service_area) WHEN 'nyc' THEN 'NY' WHEN 'li_east' THEN 'NY' WHEN 'boston' THEN 'MA' END AS state FROM gold GROUP BY ALL",
    "noise_chain": f"""WITH RECURSIVE {_DRIVERS}, d AS (SELECT DISTINCT driver_id, snapshot_month FROM drivers WHERE driver_id IS NOT NULL),
v AS (SELECT driver_id, CAST(substr(snapshot_month, 1, 4) AS INTEGER) * 12 + CAST(substr(snapshot_month, 6, 2) AS INTEGER) - 1 AS "at", row_number() OVER (PARTITION BY driver_id ORDER BY snapshot_month) AS i,
  (CAST('0x' || substr(sha256('0:' || driver_id || ':' || snapshot_month), 1, 15) AS BIGINT) % 2001 - 1000) / 1000 + CASE WHEN substr(snapshot_month, 6, 2) IN ('12', '01', '02') THEN 0.2 ELSE -0.05 END AS v FROM d),
s AS (SELECT driver_id, "at", i, CAST(v AS DOUBLE) AS state FROM v WHERE i = 1 UNION ALL SELECT v.driver_id, v.at, v.i, 0.6 * s.state + v.v FROM s JOIN v ON v.driver_id = s.driver_id AND v.i = s.i + 1)
SELECT driver_id, CAST("at" AS INTEGER) AS "at", round(least(greatest(1 + state * 0.5, 0.3), 2.0), 6) AS level, 1 + state * 0.5 < 0.3 OR 1 + state * 0.5 > 2.0 AS clipped FROM s""",
    "area_watermarks": """WITH m AS (SELECT service_area, max(struct_pack(p := year_month, t := created_at)) AS m FROM gold_load_versions GROUP BY 1)
SELECT service_area, m.p AS year_month, strftime(m.t, '%Y-%m-%d') AS last, CAST(DATE '2025-07-15' - CAST(m.t AS DATE) AS INTEGER) AS days, DATE '2025-07-15' - CAST(m.t AS DATE) > 31 AS stale FROM m""",
    "target_months": """WITH m AS (SELECT service_area, max(year_month) FILTER (year_month <= '2025-04') AS month FROM gold_load_versions GROUP BY 1)
SELECT *, strftime(CAST(month || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m') AS prices FROM m""",
    "refreshes": """WITH t AS (SELECT year_month, max(collected_at) AS came FROM monthly_taxi_trip GROUP BY 1), l AS (SELECT year_month, max(created_at) AS loaded FROM gold_load_versions GROUP BY 1)
SELECT year_month, coalesce(came > loaded, false) AS changed, came IS NOT NULL AS has_source, loaded IS NOT NULL AS has_target, coalesce(came > loaded, false) OR came IS NULL OR loaded IS NULL AS refresh FROM t FULL JOIN l USING (year_month)""",
    "attribution_keys": """WITH a AS (SELECT DISTINCT trip_key, driver_id, taxi_id, PULocationID FROM attribution),
h AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(trip_key)) AS h FROM a)
SELECT sha256(to_json(struct_pack(driver_id := driver_id, taxi_id := taxi_id, PULocationID := PULocationID))) AS json_key,
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(CAST('0x' || substr(h, 17, 1) AS INTEGER) % 4 + 1 AS INTEGER), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM h""",
    "unit_models": """SELECT vehicle_model_id AS model, CAST(stock AS BIGINT) AS units, '$' || format('{:,.2f}', weekly_lease_fee) AS fee, format('{:.1f}', 100 * stock / (SELECT sum(stock) FROM inventory)) || '%' AS share FROM inventory WHERE stock > 0""",
    "evolved_drivers": f"""WITH {_DRIVERS}, d AS (SELECT DISTINCT snapshot_month, driver_id FROM drivers WHERE driver_id IS NOT NULL AND exit_date IS NULL),
u AS (SELECT *, CAST('0x' || substr(sha256('0:' || driver_id || ':' || snapshot_month), 1, 15) AS BIGINT) % 1000000 / 1000000 AS u FROM d),
p AS (SELECT snapshot_month, count(*) AS drivers, count(*) FILTER (u < 0.03) AS leaves, count(*) FILTER (u >= 0.03 AND u < 0.13) AS changes, count(*) FILTER (u >= 0.13) AS stays,
  CAST('0x' || substr(sha256('0:join:' || snapshot_month), 1, 15) AS BIGINT) % 1000000 / 1000000 AS w FROM u GROUP BY snapshot_month),
j AS (SELECT *, CAST(floor(drivers / 50) + CASE WHEN w < drivers / 50 - floor(drivers / 50) THEN 1 ELSE 0 END AS BIGINT) AS joins FROM p)
SELECT snapshot_month, drivers, leaves, changes, stays, joins, drivers - leaves + joins AS next FROM j""",
    "drawn_vehicles": f"""WITH {_DRIVERS}, d AS (SELECT DISTINCT driver_id || ':' || snapshot_month AS asking FROM drivers WHERE driver_id IS NOT NULL AND exit_date IS NULL),
e AS (SELECT asking, CAST('0x' || substr(sha256('0:' || asking), 1, 15) AS BIGINT) % 1000000 / 1000000 AS u, CAST('0x' || substr(sha256('0:' || asking || ':draw'), 1, 15) AS BIGINT) AS s FROM d),
w AS (SELECT asking, row_number() OVER (ORDER BY s, asking) AS n FROM e WHERE u >= 0.03 AND u < 0.13),
u AS (SELECT unit_id, row_number() OVER (ORDER BY CAST('0x' || substr(sha256('0:' || unit_id || ':draw'), 1, 15) AS BIGINT), unit_id) AS n FROM ({_OTHERS['numbered_units']}))
SELECT asking, unit_id FROM w LEFT JOIN u USING (n)""",
}
