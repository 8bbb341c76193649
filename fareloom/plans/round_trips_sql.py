"""SQL that gives the same rows as the queries of ``round_trips``: what must come back."""

from fareloom.plans.catalog_sql import _DRIVERS, _ID

ORACLE = {
    "partition_round_trip": """SELECT year_month, service_area, count(*) AS n, max(version) AS newest, min(version) AS oldest FROM gold
WHERE NOT (year_month = '2025-03' AND service_area <> 'NYC' AND version <= 1 AND (service_area IN (SELECT service_area FROM gold WHERE year_month = '2025-03' AND version > 1))) GROUP BY ALL""",
    "csv_round_trip": "SELECT Borough, count(*) AS n, count(service_zone) AS zoned, max(CAST(LocationID AS INTEGER)) AS last FROM zone_lookup GROUP BY Borough",
    "single_file_round_trip": "SELECT count(*) AS \"rows\", count(DISTINCT vehicle_model_id) AS models, CAST(sum(stock) AS BIGINT) AS stock, 1 AS files FROM inventory",
    "version_round_trip": "SELECT snapshot_month AS month, 1 AS collected_at, count(*) AS n FROM driver_snapshot WHERE weekly_lease_fee IS NOT NULL AND NOT isnan(weekly_lease_fee) AND fuel_type IS NOT NULL GROUP BY ALL",
    "switched_tables": "SELECT 'models' AS part, count(*) AS \"rows\", count(manufacturer) AS named FROM inventory UNION ALL SELECT 'makers', count(DISTINCT manufacturer), count(DISTINCT manufacturer) FROM inventory",
    "release_round_trip": " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS \"rows\", true AS reused FROM {n}" for n in ("inventory", "zone_lookup", "gold_load_versions")),
    "load_round_trip": """WITH v AS (SELECT DISTINCT service_area, year_month, version FROM gold QUALIFY year_month = max(year_month) OVER (PARTITION BY service_area)),
n AS (SELECT *, row_number() OVER (PARTITION BY service_area ORDER BY version) AS number, max(version) OVER (PARTITION BY service_area) AS top FROM v)
SELECT n.service_area, n.year_month, CAST(number AS INTEGER) AS version, count(*) AS n FROM n JOIN gold USING (service_area, year_month, version) WHERE n.version = top GROUP BY ALL""",
    "sorted_round_trip": f"""SELECT month, count(*) AS n, true AS ranges FROM (SELECT DISTINCT {_ID.format('taxi_id')} AS taxi, trip_key, strftime(service_date, '%Y-%m') AS month FROM attribution) WHERE taxi IS NOT NULL AND trip_key IS NOT NULL GROUP BY month""",
    "appended_versions": """WITH g AS (SELECT DISTINCT version, driver_id, taxi_id, vehicle_model_id FROM gold WHERE service_area = 'NYC' AND year_month = '2025-02'),
s AS (SELECT version, list_sort(list(CAST((driver_id, taxi_id, vehicle_model_id) AS VARCHAR))) AS s FROM g GROUP BY version),
w AS (SELECT version, coalesce(s <> lag(s) OVER (ORDER BY version), true) AS wrote FROM s),
t AS (SELECT lpad(CAST(version AS VARCHAR), 4, '0') || 'a' AS token, wrote FROM w UNION ALL SELECT lpad(CAST(version AS VARCHAR), 4, '0') || 'b', false FROM w)
SELECT token, wrote, CAST(sum(CASE WHEN wrote THEN 1 ELSE 0 END) OVER (ORDER BY token) AS INTEGER) AS versions FROM t""",
    "latest_folders": """WITH l AS (SELECT service_area, year_month, max(version) FILTER (version % 5 <> 0) AS v, count(*) FILTER (version % 5 <> 0) AS complete FROM gold_load_versions GROUP BY ALL)
SELECT service_area, year_month, CAST(v AS INTEGER) AS version, CAST(complete AS INTEGER) AS complete, sha256(encode('data.parquet') || '\\x00'::BLOB || encode(CAST(v AS VARCHAR)) || '\\x00'::BLOB) AS digest FROM l""",
    "retention_decisions": """WITH l AS (SELECT service_area || '/' || year_month AS p, lpad(CAST(version AS VARCHAR), 5, '0') AS t, version % 5 <> 0 AND version % 7 <> 0 AS good, version % 5 = 0 AS bad, created_at < TIMESTAMP '2025-05-10' AS old FROM gold_load_versions),
n AS (SELECT *, good AND t = max(t) FILTER (good) OVER (PARTITION BY p) AS newest FROM l)
SELECT p || '/' || t AS folder, CASE WHEN (good OR bad) AND NOT newest AND old THEN 'delete' ELSE 'keep' END AS action,
  CASE WHEN NOT (good OR bad) THEN 'unmarked' WHEN newest THEN 'newest' WHEN old THEN 'expired' ELSE 'recent' END AS why FROM n""",
    "load_fingerprints": f"""WITH {_DRIVERS} SELECT DISTINCT snapshot_month AS month, snapshot_month || '_' || substr(sha256('{{"rate": 0.5, "seed": 7}}'), 1, 12) AS run,
  sha256('{{"area":"NYC","combinations":[["a",1],["b",2]],"constants":{{"share":0.3}},"digests":{{"trips":"' || snapshot_month || '"}},"inputs":{{"trips":"silver"}},"month":"' || snapshot_month || '"}}') AS fingerprint FROM drivers""",
    "lost_months": """WITH t AS (SELECT DISTINCT year_month AS month FROM monthly_taxi_trip), l AS (SELECT DISTINCT year_month AS month FROM gold_load_versions)
SELECT month, 'lost' AS what FROM l ANTI JOIN t USING (month) WHERE month <> '2025-05' UNION ALL SELECT month, 'new' FROM t ANTI JOIN l USING (month) WHERE month <> '2025-05'""",
}
