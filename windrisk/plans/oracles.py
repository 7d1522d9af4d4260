"""SQL that gives, on the shared test tables, what each registered query must return."""

from windrisk.functions import normal

OBS = "obs AS (SELECT ts AS timestamp, event_type AS region_id, value / 10.0 AS wind_speed_mps, event_id FROM events)"
HOURLY = OBS + """,
hourly AS (SELECT date_trunc('hour', timestamp) AS timestamp, region_id, avg(wind_speed_mps) AS wind_speed_mps
           FROM obs GROUP BY ALL)"""
PRICES = """prices AS (SELECT date_trunc('hour', ts) AS timestamp, event_type AS region_id, max(value) AS price_eur_mwh
            FROM events GROUP BY ALL)"""
FLAGS = """flags AS (SELECT timestamp, bool_or(wind_speed_mps < 3.0) AS is_drought,
                  count(*) FILTER (wind_speed_mps < 3.0) AS zones_below, count(*) AS n_zones
           FROM hourly GROUP BY timestamp)"""
ZONES = """zones(idx, region_id, lat, lon) AS (VALUES
    (0, 'SE1', CAST(62.0 AS DOUBLE), CAST(14.5 AS DOUBLE)), (1, 'SE2', 62.5, 17.5), (2, 'SE3', 59.5, 18.0),
    (3, 'SE4', 56.0, 14.0), (4, 'NO1', 59.5, 10.5), (5, 'NO2', 64.0, 11.5), (6, 'DK1', 56.5, 9.5),
    (7, 'DK2', 55.5, 12.0), (8, 'FI', 61.5, 25.0))"""
GRID = """grid AS (SELECT l_linenumber AS file_id, l_shipdate AS timestamp,
    CAST(54 AS DOUBLE) + (l_partkey % 73) * CAST(0.25 AS DOUBLE) AS latitude,
    CAST(-10 AS DOUBLE) + ((l_suppkey * 37) % 181) * CAST(0.25 AS DOUBLE) AS longitude,
    l_quantity - 25.0 AS u10, l_extendedprice / 10000.0 - 5.0 AS v10 FROM lineitem)"""
NEAREST = GRID + ", " + ZONES + """,
cells AS (SELECT DISTINCT latitude, longitude FROM grid),
ranked AS (SELECT c.*, z.region_id, z.lat, z.lon,
                  row_number() OVER (PARTITION BY c.latitude, c.longitude ORDER BY
                      (c.latitude - z.lat) * (c.latitude - z.lat) + (c.longitude - z.lon) * (c.longitude - z.lon), z.idx) AS rn
           FROM cells c, zones z),
nearest AS (SELECT * FROM ranked WHERE rn = 1),
per_file AS (SELECT file_id, timestamp, region_id, avg(sqrt(u10 * u10 + v10 * v10)) AS wind_speed_mps
             FROM grid JOIN nearest USING (latitude, longitude) GROUP BY ALL),
silver AS (SELECT timestamp, region_id, avg(wind_speed_mps) AS wind_speed_mps FROM per_file GROUP BY ALL)"""
RAW_ENERGY = """raw_energy AS (SELECT l_linenumber AS file_id, l_shipdate AS timestamp,
    ['SE1','SE2','SE','NO','10YFI-1--------U','10YSE-1--------K','DK1','DK2','XX9','NO1','10YNO-0--------C','FI'][l_suppkey % 12 + 1] AS code,
    CASE l_returnflag WHEN 'A' THEN 'B19' WHEN 'N' THEN 'B18' ELSE 'load_mwh' END AS variable,
    l_quantity AS value_mwh FROM lineitem)"""
MAPPED = RAW_ENERGY + """,
mapped AS (SELECT *, CASE code WHEN '10YFI-1--------U' THEN 'FI' WHEN '10YSE-1--------K' THEN 'SE'
                              WHEN '10YNO-0--------C' THEN 'NO' ELSE code END AS region_id FROM raw_energy),
energy AS (SELECT file_id, timestamp, region_id, variable, value_mwh FROM mapped WHERE region_id <> 'XX9')"""
WIDE = MAPPED + """,
wide AS (SELECT timestamp, region_id,
    CASE WHEN count(*) FILTER (variable IN ('B18', 'B19')) > 0 THEN coalesce(sum(value_mwh) FILTER (variable = 'B19'), 0) END AS wind_onshore_mwh,
    CASE WHEN count(*) FILTER (variable IN ('B18', 'B19')) > 0 THEN coalesce(sum(value_mwh) FILTER (variable = 'B18'), 0) END AS wind_offshore_mwh,
    sum(value_mwh) FILTER (variable = 'load_mwh') AS total_load_mwh
    FROM energy GROUP BY ALL)"""
GENERATION = MAPPED + """,
on_sum AS (SELECT file_id, timestamp, region_id, sum(value_mwh) AS v FROM energy WHERE variable = 'B19' GROUP BY ALL),
off_sum AS (SELECT file_id, timestamp, region_id, sum(value_mwh) AS v FROM energy WHERE variable = 'B18' GROUP BY ALL),
generation AS (SELECT file_id, timestamp, region_id, coalesce(a.v, 0) AS wind_onshore_mwh, coalesce(b.v, 0) AS wind_offshore_mwh
               FROM on_sum a FULL OUTER JOIN off_sum b USING (file_id, timestamp, region_id))"""
UNNESTED = """unnested AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS e FROM embeddings)"""
DRAWS = UNNESTED + """,
draws AS (SELECT label AS horizon_h, vec_id AS sample_id, 'd' || dim AS region_id, 4.0 + 8.0 * e AS value FROM unnested)"""
ZONE_DRAWS = UNNESTED + """,
draws AS (SELECT (label % 3 + 1) * 24 AS horizon_h, vec_id * 8 + dim // 9 AS sample_id,
          ['SE1','SE2','SE3','SE4','NO1','NO2','DK1','DK2','FI'][dim % 9 + 1] AS region_id, 4.0 + 8.0 * e AS value FROM unnested)"""
RISK = """,
tail_risk AS (SELECT horizon_h, region_id, avg(CAST(value < 3.0 AS DOUBLE)) AS p_shortfall FROM draws GROUP BY ALL),
totals AS MATERIALIZED (SELECT horizon_h, sample_id, sum(greatest(3.0 - value, 0.0)) AS total FROM draws GROUP BY ALL),
numbered AS (SELECT *, rank() OVER (PARTITION BY horizon_h ORDER BY total DESC) AS r,
                    count(*) OVER (PARTITION BY horizon_h) AS n FROM totals),
tail AS (SELECT horizon_h, sample_id, total FROM numbered WHERE r <= greatest(1, ceil(CAST(0.05 AS DOUBLE) * n))),
cvar AS (SELECT horizon_h, region_id, avg(greatest(3.0 - value, 0.0)) AS cvar_shortfall
         FROM draws SEMI JOIN tail USING (horizon_h, sample_id) GROUP BY ALL),
bands AS (SELECT horizon_h, region_id, quantile_cont(value, 0.1) AS wind_p10, quantile_cont(value, 0.5) AS wind_p50,
                 quantile_cont(value, 0.9) AS wind_p90 FROM draws GROUP BY ALL),
forecasts AS (SELECT * FROM tail_risk JOIN cvar USING (horizon_h, region_id) JOIN bands USING (horizon_h, region_id))"""
STAMPED = ZONE_DRAWS + RISK + """,
stamped AS (SELECT TIMESTAMP '2024-01-01 00:00:00' + horizon_h * INTERVAL 1 HOUR AS timestamp, region_id, horizon_h,
    round(p_shortfall, 6) AS p_shortfall, round(cvar_shortfall, 6) AS cvar_shortfall, round(wind_p10, 6) AS wind_p10,
    round(wind_p50, 6) AS wind_p50, round(wind_p90, 6) AS wind_p90 FROM forecasts)"""
CHAINS = """chains AS (SELECT CAST(vec_id % 4 AS INTEGER) AS chain, CAST(vec_id // 4 AS INTEGER) AS draw, 'd' || dim AS param, e AS value
            FROM (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS e FROM embeddings))"""
RHAT = CHAINS + """,
sized AS (SELECT *, count(*) OVER (PARTITION BY param, chain) AS n FROM chains),
split AS (SELECT param, chain, CASE WHEN draw < n // 2 THEN 0 WHEN draw >= n - n // 2 THEN 1 END AS half, value FROM sized),
seqs AS (SELECT param, chain, half, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM split WHERE half IS NOT NULL GROUP BY ALL),
rhat AS (SELECT param, sqrt((avg(v) * (avg(n) - 1) / avg(n) + var_samp(m)) / avg(v)) AS r_hat FROM seqs GROUP BY param)"""
ELBO = """elbo AS (SELECT o_orderpriority AS run_id, o_orderkey AS iter,
          o_totalprice + CASE WHEN o_orderpriority = '5-LOW' THEN CAST(1e8 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS elbo FROM orders),
newest AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY iter DESC) AS rn, count(*) OVER (PARTITION BY run_id) AS n FROM elbo),
converged AS (SELECT run_id, max(n) AS n_points, max(elbo) FILTER (rn = 1) AS elbo_final,
    stddev_pop(elbo) FILTER (rn <= 500) AS sd, avg(elbo) FILTER (rn <= 500) AS mean,
    (max(n) >= 1000 AND stddev_pop(elbo) FILTER (rn <= 500) < abs(avg(elbo) FILTER (rn <= 500)) * CAST(0.01 AS DOUBLE)) AS elbo_converged
    FROM newest GROUP BY run_id)"""
KM = """2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h))"""
ZONES25 = """zones25 AS (SELECT n_name AS region_id, CAST(54 AS DOUBLE) + (n_nationkey % 5) * 4 AS lat,
             CAST(-10 AS DOUBLE) + n_nationkey * CAST(1.75 AS DOUBLE) AS lon FROM nation),
halves AS (SELECT a.region_id AS zone_a, b.region_id AS zone_b,
    pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2) AS h
    FROM zones25 a, zones25 b),
km AS (SELECT zone_a, zone_b, CASE WHEN zone_a = zone_b THEN 0 ELSE """ + KM + """ END AS km FROM halves)"""
PAIRS = """,
complete AS (SELECT timestamp FROM hourly GROUP BY timestamp HAVING count(*) = (SELECT count(DISTINCT region_id) FROM hourly)),
kept AS (SELECT * FROM hourly SEMI JOIN complete USING (timestamp)),
corr AS (SELECT a.region_id AS zone_a, b.region_id AS zone_b,
    covar_pop(a.wind_speed_mps, b.wind_speed_mps) / nullif(stddev_pop(a.wind_speed_mps) * stddev_pop(b.wind_speed_mps), 0) AS value
    FROM kept a JOIN kept b USING (timestamp) GROUP BY ALL HAVING count(*) >= 2)"""
FEATURES = HOURLY + """,
zone_index AS (SELECT region_id, row_number() OVER (ORDER BY region_id) - 1 AS zone_idx, count(*) OVER () AS n_zones
               FROM (SELECT DISTINCT region_id FROM hourly)),
features AS (SELECT timestamp, region_id, CAST(zone_idx AS DOUBLE) / greatest(n_zones - 1, 1) AS x_s,
    epoch(timestamp - (SELECT min(timestamp) FROM hourly)) / 3600.0 / 168.0 AS x_t, wind_speed_mps AS y
    FROM hourly JOIN zone_index USING (region_id))"""
POINTS = """spread AS (SELECT event_id, event_type, value, date_trunc('hour', ts) AS hour,
    row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type, event_id // 100 ORDER BY event_id) AS position FROM events),
points AS (SELECT hour + (position - 1) * (CASE event_type WHEN 'view' THEN 15 WHEN 'click' THEN 30 ELSE 60 END) * INTERVAL 1 MINUTE AS timestamp,
    event_type AS region_id, CASE event_type WHEN 'purchase' THEN 'B18' WHEN 'signup' THEN 'load_mwh' ELSE 'B19' END AS variable, value AS value_mwh
    FROM spread WHERE event_type <> 'error' AND value <> floor(value))"""
LAST = """last_values AS (SELECT hour, region_id, wind_speed_mps, first_seen FROM (
    SELECT date_trunc('hour', ts) AS hour, event_type AS region_id, value / 10.0 AS wind_speed_mps,
        min(ts) OVER (PARTITION BY date_trunc('hour', ts), event_type) AS first_seen,
        row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"""
WINDOWS = LAST + """,
hours AS (SELECT hour, min(first_seen) AS timestamp FROM last_values GROUP BY hour),
windowed AS (SELECT l.hour - k * INTERVAL 1 HOUR AS window_start, l.hour, l.region_id, l.wind_speed_mps
             FROM last_values l, range(6) t(k)),
sized AS (SELECT window_start, min(hour) AS first_hour, max(hour) AS last_hour, count(DISTINCT hour) AS n FROM windowed GROUP BY ALL),
chosen AS (SELECT w.window_start, w.region_id FROM windowed w JOIN sized s ON w.window_start = s.window_start AND w.hour = s.first_hour),
counted AS (SELECT c.window_start, c.region_id, s.n, s.last_hour, count(*) AS have, avg(w.wind_speed_mps) AS mean_wind
    FROM chosen c JOIN sized s USING (window_start) JOIN windowed w ON w.window_start = c.window_start AND w.region_id = c.region_id GROUP BY ALL),
valid AS (SELECT window_start, max(last_hour) AS last_hour FROM counted GROUP BY window_start HAVING min(have) = max(n) AND max(n) >= 2),
cells AS (SELECT v.window_start, a.region_id AS zone_a, b.region_id AS zone_b,
    covar_pop(x.wind_speed_mps, y.wind_speed_mps) / nullif(stddev_pop(x.wind_speed_mps) * stddev_pop(y.wind_speed_mps), 0) AS value
    FROM valid v JOIN chosen a USING (window_start) JOIN chosen b USING (window_start)
    JOIN windowed x ON x.window_start = v.window_start AND x.region_id = a.region_id
    JOIN windowed y ON y.window_start = v.window_start AND y.region_id = b.region_id AND y.hour = x.hour GROUP BY ALL)"""
MONTHS = """months AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
            INTERVAL 1 MONTH)) AS DATE) AS month FROM orders)"""


def matern(nu: str) -> str:
    r = "(km / (500 + 1e-9))"
    form = {
        "0.5": f"exp(-{r})",
        "1.5": f"(1 + sqrt(3) * {r}) * exp(-sqrt(3) * {r})",
        "2.5": f"(1 + sqrt(5) * {r} + 5 * {r} * {r} / 3) * exp(-sqrt(5) * {r})",
    }
    return f"CASE WHEN zone_a = zone_b THEN CAST(1 AS DOUBLE) ELSE {form[nu]} END"


def r(expression: str, alias: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0 AS {alias}"


ORACLES = {
    "s1_weather_files": f"WITH {GRID} SELECT file_id, count(*) AS n_rows, {r('sum(u10)', 'u10')}, {r('sum(latitude)', 'latitude')}, max(timestamp) AS last_timestamp FROM grid GROUP BY file_id",
    "s2_time_column": f"WITH {GRID} SELECT timestamp, count(*) AS n_rows, {r('sum(u10)', 'u10')} FROM grid GROUP BY timestamp",
    "s3_energy_csv": f"WITH {MAPPED} SELECT timestamp, region_id, variable, count(*) AS n_rows, {r('sum(value_mwh)', 'value_mwh')} FROM energy WHERE file_id <> 7 GROUP BY ALL",
    "s3_bad_lines": "SELECT count(*) AS n_bad FROM lineitem WHERE l_linenumber = 7",
    "s4_market_xml": f"WITH {POINTS} SELECT timestamp, region_id, variable, {r('value_mwh', 'value_mwh')} FROM points",
    "s5_acknowledgements": """SELECT event_type AS region_id,
        CASE event_type WHEN 'error' THEN 'Invalid token ' || event_id ELSE 'No matching data found' END AS reason,
        event_type = 'error' AS is_error, count(*) AS n_docs FROM events GROUP BY ALL""",
    "s6_silver_alias": f"WITH {OBS} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM obs",
    "s7_silver_or_table": f"WITH {OBS} SELECT source, region_id, count(*) AS n_rows, {r('sum(wind_speed_mps)', 'wind')} FROM obs, (VALUES ('silver'), ('table')) t(source) GROUP BY ALL",
    "s8_table_scan": f"WITH {OBS} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM obs ORDER BY timestamp, region_id",
    "s9_decode_messages": f"WITH {OBS} SELECT date_trunc('millisecond', timestamp) AS timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM obs",
    "s10_gold_forecasts": f"WITH {STAMPED} SELECT * FROM stamped",
    "k1_overwrite_silver": f"WITH {NEAREST} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM silver",
    "k2_year_partitions": f"""WITH {RAW_ENERGY} SELECT CAST(year(timestamp) AS INTEGER) AS year, variable, count(*) AS n_rows, {r('sum(value_mwh)', 'value_mwh')}
        FROM raw_energy WHERE timestamp >= TIMESTAMP '1996-07-01' AND timestamp < TIMESTAMP '1998-02-15' GROUP BY ALL""",
    "k3_bulk_append": f"""WITH {OBS}, {PRICES} SELECT 'weather_obs' AS table_name, region_id, 2 * count(*) AS n_rows, {r('2 * sum(wind_speed_mps)', 'total')} FROM obs GROUP BY ALL
        UNION ALL SELECT 'spot_prices', region_id, 2 * count(*), {r('2 * sum(price_eur_mwh)', 'total')} FROM prices GROUP BY ALL""",
    "k4_replace_table": f"WITH {HOURLY} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps', 8)} FROM hourly",
    "k5_write_if_changed": "SELECT event_type AS region_id, 2 * count(*) AS n_rows, true AS first, false AS again, true AS changed, false AS nothing FROM events GROUP BY ALL",
    "k6_noop_with_count": f"WITH {NEAREST} SELECT count(*) AS n_rows FROM silver",
    "k7_csv_round_trip": f"WITH {RAW_ENERGY} SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, code AS region_id, variable, {r('sum(value_mwh)', 'value_mwh')} FROM raw_energy GROUP BY ALL",
    "k8_encode_messages": f"WITH {PRICES} SELECT region_id, timestamp, {r('price_eur_mwh', 'price_eur_mwh')} FROM prices",
    "k9_run_log": f"""WITH {ELBO}, low AS (SELECT * FROM converged WHERE run_id = '5-LOW')
        SELECT 'low' AS run_name, 'metric' AS kind, 'elbo_final' AS key, {r('elbo_final', 'value')}, CAST(NULL AS VARCHAR) AS text FROM low
        UNION ALL SELECT 'low', 'metric', 'elbo_converged', CAST(elbo_converged AS DOUBLE), NULL FROM low
        UNION ALL SELECT 'low', 'param', 'm_spatial', NULL, '5' UNION ALL SELECT 'low', 'metric', 'ok', 1.0, NULL
        UNION ALL SELECT 'low', 'metric', 'n', 3.0, NULL UNION ALL SELECT 'low', 'tag', 'model_type', NULL, 'hsgp'""",
    "i1_freshness": "SELECT 2 * count(*) AS n_rows, false AS before, true AS after, false AS newer FROM events",
    "i2_content_gate": f"WITH {HOURLY} SELECT count(*) AS n_rows, true AS first, true AS no_result, false AS unchanged, true AS changed FROM hourly",
    "i3_missing_keys": "SELECT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "i4_month_calendar": f"WITH {MONTHS} SELECT month FROM months",
    "i5_month_windows": f"""WITH {MONTHS} SELECT month, strftime(month, '%Y%m%d0000') AS period_start,
        strftime(month + INTERVAL 1 MONTH, '%Y%m%d0000') AS period_end, CAST(day(last_day(month)) AS INTEGER) AS days FROM months""",
    "p1_wind_speed": f"WITH {GRID} SELECT timestamp, {r('sum(sqrt(u10 * u10 + v10 * v10))', 'speed')}, {r('max(sqrt(u10 * u10 + v10 * v10))', 'top')} FROM grid GROUP BY timestamp",
    "p2_region_of_code": f"WITH {MAPPED} SELECT code AS region_id, region_id AS mapped, count(*) AS n_rows FROM mapped GROUP BY ALL",
    "p3_parse_iso": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('second', ts)
        ELSE date_trunc('second', ts) - INTERVAL 2 HOUR END AS parsed FROM events WHERE event_id % 4 <> 3""",
    "p4_resolution": """WITH docs AS (SELECT DISTINCT date_trunc('hour', ts) AS hour, event_type, event_id // 100 AS part FROM events)
        SELECT CASE event_type WHEN 'view' THEN 'PT15M' WHEN 'click' THEN 'PT30M' ELSE 'PT60M' END AS resolution,
        CASE event_type WHEN 'view' THEN 15 WHEN 'click' THEN 30 ELSE 60 END AS minutes, count(*) AS n_docs FROM docs GROUP BY ALL""",
    "p5_point_time": "SELECT event_id, ts + (user_id - 1) * INTERVAL 15 MINUTE AS at FROM events",
    "p6_haversine": f"""WITH {NEAREST}, halves AS (SELECT n.region_id, pow(sin(radians(n.lat - g.latitude) / 2), 2)
            + cos(radians(g.latitude)) * cos(radians(n.lat)) * pow(sin(radians(n.lon - g.longitude) / 2), 2) AS h
            FROM grid g JOIN nearest n USING (latitude, longitude))
        SELECT region_id, {r(f'avg({KM})', 'mean_km')}, {r(f'max({KM})', 'max_km')} FROM halves GROUP BY region_id""",
    "p7_matern": f"""WITH {ZONES25} SELECT zone_a, zone_b, {r(f"4 * ({matern('1.5')})", 'nu_1_5')},
        {r(f"4 * ({matern('0.5')})", 'nu_0_5')}, {r(f"4 * ({matern('2.5')})", 'nu_2_5')} FROM km""",
    "p7_matern_any_nu": f"WITH {ZONES25} SELECT zone_a, zone_b, {r(matern('1.5'), 'value')} FROM km",
    "p8_elapsed_hours": f"WITH {OBS} SELECT timestamp, region_id, {r('(epoch_us(timestamp) - (SELECT min(epoch_us(timestamp)) FROM obs)) / CAST(3.6e9 AS DOUBLE)', 'hours', 4)} FROM obs",
    "p9_features": f"WITH {FEATURES} SELECT timestamp, region_id, {r('x_s', 'x_s', 8)}, {r('x_t', 'x_t', 8)}, {r('y', 'y', 8)} FROM features",
    "p11_rounding": f"SELECT l_quantity, {r('max(round(l_quantity / 4, 1))', 'half_up')}, {r('max(round_even(l_quantity / 4, 1))', 'half_even')}, {r('max(round(l_quantity / 7, 4))', 'four_places')} FROM lineitem GROUP BY l_quantity",
    "p12_iso_text": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text FROM events",
    "p13_shortfall": f"WITH {DRAWS} SELECT horizon_h, region_id, {r('sum(greatest(3.0 - value, 0.0))', 'shortfall')}, {r('max(greatest(3.0 - value, 0.0))', 'worst')} FROM draws GROUP BY ALL",
    "p14_basis": f"""WITH {FEATURES}, phi AS (SELECT CAST((a - 1) * 10 + b - 1 AS INTEGER) AS j,
            sin(pi() * a * (x_s - 0.5 + 0.75) / 1.5) / sqrt(0.75) * sin(pi() * b * (x_t - 2.0 + 3.5) / 7.0) / sqrt(3.5) AS value
            FROM features, range(1, 6) s(a), range(1, 11) t(b))
        SELECT j, {r('sum(value)', 'total')}, {r('max(value)', 'top')} FROM phi GROUP BY j""",
    "p15_horizon_points": f"""WITH {FEATURES}, ends AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi FROM hourly)
        SELECT hi + horizon_h * INTERVAL 1 HOUR AS timestamp, region_id, CAST(horizon_h AS INTEGER) AS horizon_h,
        {r('CAST(zone_idx AS DOUBLE) / greatest(n_zones - 1, 1)', 'x_s')}, {r('(epoch(hi - lo) / 3600.0 + horizon_h) / 168.0', 'x_t')}
        FROM zone_index, ends, (VALUES (24), (48), (72)) h(horizon_h)""",
    "p16_json_records": f"""WITH {STAMPED} SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, region_id, horizon_h,
        p_shortfall, CAST(NULL AS DOUBLE) AS wind_p10, true AS has_null_field FROM stamped""",
    "p17_verdicts": f"WITH {RHAT} SELECT 'max_r_hat' AS key, {r('max(r_hat)', 'value')}, CASE WHEN max(r_hat) < 1.01 THEN 'pass' ELSE 'warn' END AS label FROM rhat",
    "f1_f2_known_regions": f"WITH {MAPPED} SELECT region_id, variable, count(*) AS n_rows, {r('sum(value_mwh)', 'value_mwh')} FROM energy GROUP BY ALL",
    "f3_f4_readable_points": f"WITH {POINTS} SELECT region_id, variable, count(*) AS n_points FROM points GROUP BY ALL",
    "f5_alerts": f"WITH {DRAWS}{RISK} SELECT horizon_h, region_id, {r('p_shortfall', 'p_shortfall')} FROM tail_risk WHERE p_shortfall >= 0.2",
    "f6_at_risk": f"WITH {DRAWS}{RISK} SELECT horizon_h, region_id, {r('p_shortfall', 'p_shortfall')}, region_id || ' @ +' || horizon_h || 'h' AS label FROM tail_risk WHERE p_shortfall > 0.1",
    "f8_minimum_rows": "SELECT count(*) AS n_rows, count(*) >= 10 AS enough, false AS empty_is_enough FROM events",
    "f9_null_keys_dropped": f"WITH {HOURLY} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps', 8)} FROM hourly WHERE region_id <> 'error'",
    "j1_nearest_zone": f"WITH {NEAREST} SELECT latitude, longitude, region_id, count(*) AS n_rows FROM grid JOIN nearest USING (latitude, longitude) GROUP BY ALL",
    "j1_nearest_zone_km": f"""WITH {GRID}, {ZONES}, cells AS (SELECT DISTINCT latitude, longitude FROM grid),
        halves AS (SELECT c.*, z.idx, z.region_id, pow(sin(radians(z.lat - c.latitude) / 2), 2)
            + cos(radians(c.latitude)) * cos(radians(z.lat)) * pow(sin(radians(z.lon - c.longitude) / 2), 2) AS h FROM cells c, zones z),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY latitude, longitude ORDER BY h, idx) AS rn FROM halves)
        SELECT region_id, count(*) AS n_rows, {r('sum(latitude)', 'latitude')} FROM grid JOIN (SELECT * FROM ranked WHERE rn = 1) USING (latitude, longitude) GROUP BY ALL""",
    "j1_nearest_zone_list": f"""WITH {GRID}, zones AS (SELECT c_custkey AS idx, CAST(c_custkey AS VARCHAR) AS region_id,
            54 + (c_custkey * 7919 % 4608) / 256.0::DOUBLE AS lat, -10 + (c_custkey * 104729 % 11520) / 256.0::DOUBLE AS lon FROM customer),
        cells AS (SELECT latitude, longitude, count(*) AS n_rows FROM grid GROUP BY ALL)
        SELECT latitude, longitude, min(struct_pack(gap := pow(latitude - lat, 2) + pow(longitude - lon, 2), idx := idx, region_id := region_id)).region_id AS region_id,
            any_value(n_rows) AS n_rows FROM cells, zones GROUP BY ALL""",
    "j2_wind_outer_join": f"WITH {GENERATION} SELECT file_id, timestamp, region_id, {r('wind_onshore_mwh', 'wind_onshore_mwh')}, {r('wind_offshore_mwh', 'wind_offshore_mwh')} FROM generation",
    "j3_zone_distances": f"WITH {ZONES25} SELECT zone_a, zone_b, {r('km', 'km')} FROM km",
    "j4_zones_by_horizon": """SELECT region_id, CAST(horizon_h AS INTEGER) AS horizon_h FROM (SELECT DISTINCT CASE event_type WHEN 'view' THEN 'SE1' WHEN 'click' THEN 'SE3'
        WHEN 'purchase' THEN 'NO1' WHEN 'signup' THEN 'DK1' ELSE 'FI' END AS region_id FROM events), (VALUES (24), (48), (72)) h(horizon_h)""",
    "j5_hour_scaffold": f"""WITH {HOURLY}, hours AS (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp FROM hourly)
        SELECT h.timestamp, z.region_id, {r('s.wind_speed_mps', 'wind_speed_mps', 8)} FROM hours h CROSS JOIN (SELECT DISTINCT region_id FROM hourly) z
        LEFT JOIN hourly s ON s.timestamp = h.timestamp AND s.region_id = z.region_id""",
    "j6_zone_index": "SELECT region_id, CAST(row_number() OVER (ORDER BY region_id) - 1 AS INTEGER) AS zone_idx, CAST(count(*) OVER () AS INTEGER) AS n_zones FROM (SELECT DISTINCT event_type AS region_id FROM events)",
    "j8_in_drought": f"WITH {HOURLY}, {FLAGS}, {PRICES} SELECT timestamp, region_id, {r('price_eur_mwh', 'price_eur_mwh')} FROM prices WHERE timestamp IN (SELECT timestamp FROM flags WHERE is_drought)",
    "j9_tail_draws": f"WITH {DRAWS}{RISK} SELECT horizon_h, count(*) AS n_draws, count(DISTINCT sample_id) AS n_scenarios FROM draws SEMI JOIN tail USING (horizon_h, sample_id) GROUP BY ALL",
    "j10_weather_energy": f"""WITH {NEAREST}, {WIDE}, weather AS (SELECT *, CASE WHEN region_id LIKE 'SE%' THEN 'SE' WHEN region_id LIKE 'NO%' THEN 'NO' ELSE region_id END AS generation_region FROM silver)
        SELECT w.timestamp, w.region_id, generation_region, {r('wind_speed_mps', 'wind_speed_mps')}, {r('g.wind_onshore_mwh', 'wind_onshore_mwh')},
        {r('g.wind_offshore_mwh', 'wind_offshore_mwh')}, {r('l.total_load_mwh', 'total_load_mwh')} FROM weather w
        LEFT JOIN wide l ON l.timestamp = w.timestamp AND l.region_id = w.region_id
        LEFT JOIN wide g ON g.timestamp = w.timestamp AND g.region_id = w.generation_region""",
    "j11_matrix_difference": f"""WITH {HOURLY.replace("event_type AS region_id", "CASE event_type WHEN 'view' THEN 'SE1' WHEN 'click' THEN 'SE3' WHEN 'purchase' THEN 'NO1' WHEN 'signup' THEN 'DK1' ELSE 'FI' END AS region_id")}{PAIRS}, {ZONES},
        halves AS (SELECT a.region_id AS zone_a, b.region_id AS zone_b, pow(sin(radians(b.lat - a.lat) / 2), 2)
            + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2) AS h FROM zones a, zones b),
        km AS (SELECT zone_a, zone_b, {KM} AS km FROM halves), kernel AS (SELECT zone_a, zone_b, {matern('1.5')} AS k FROM km)
        SELECT zone_a, zone_b, {r('value', 'left_value')}, {r('k', 'right_value')}, {r('value - k', 'value')} FROM corr JOIN kernel USING (zone_a, zone_b)""",
    "a1_zone_means_per_file": f"WITH {NEAREST} SELECT file_id, timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM per_file",
    "a2_silver_weather": f"WITH {NEAREST} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM silver",
    "a3_energy_sums": f"WITH {MAPPED} SELECT file_id, timestamp, region_id, variable, {r('sum(value_mwh)', 'value_mwh')} FROM energy GROUP BY ALL",
    "a4_energy_wide": f"WITH {WIDE} SELECT timestamp, region_id, {r('wind_onshore_mwh', 'wind_onshore_mwh')}, {r('wind_offshore_mwh', 'wind_offshore_mwh')}, {r('total_load_mwh', 'total_load_mwh')} FROM wide",
    "a4_energy_wide_hourly": f"""WITH {MAPPED}, per_hour AS (SELECT file_id, timestamp, region_id, variable, avg(value_mwh) AS v FROM energy GROUP BY ALL)
        SELECT timestamp, region_id,
        {r("CASE WHEN count(*) FILTER (variable IN ('B18', 'B19')) > 0 THEN coalesce(sum(v) FILTER (variable = 'B19'), 0) END", 'wind_onshore_mwh', 8)},
        {r("CASE WHEN count(*) FILTER (variable IN ('B18', 'B19')) > 0 THEN coalesce(sum(v) FILTER (variable = 'B18'), 0) END", 'wind_offshore_mwh', 8)},
        {r("CASE WHEN count(*) FILTER (variable = 'load_mwh') > 0 THEN coalesce(sum(v) FILTER (variable = 'load_mwh'), 0) END", 'total_load_mwh', 8)}
        FROM per_hour GROUP BY ALL""",
    "a5_snapshots": f"WITH {OBS} SELECT timestamp, region_id, {r('avg(wind_speed_mps)', 'wind_speed_mps', 8)} FROM obs GROUP BY ALL",
    "a5_snapshots_hourly": f"WITH {HOURLY} SELECT timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps', 8)} FROM hourly",
    "a6_extent": f"WITH {OBS} SELECT count(*) AS n_rows, count(DISTINCT region_id) AS n_zones, count(DISTINCT timestamp) AS n_timesteps FROM obs",
    "a7_span": f"WITH {OBS} SELECT min(timestamp) AS t_min, max(timestamp) AS t_max, {r('epoch(max(timestamp) - min(timestamp)) / 3600.0', 'span_hours')} FROM obs",
    "a8_droughts": f"WITH {HOURLY}, {FLAGS} SELECT * FROM flags",
    "a9_tail_risk": f"WITH {DRAWS}{RISK} SELECT horizon_h, region_id, {r('p_shortfall', 'p_shortfall')} FROM tail_risk",
    "a10_scenario_totals": f"WITH {DRAWS}{RISK} SELECT horizon_h, sample_id, {r('total', 'total')} FROM totals",
    "a11_cvar": f"WITH {DRAWS}{RISK} SELECT horizon_h, region_id, {r('cvar_shortfall', 'cvar_shortfall')} FROM cvar",
    "a12_quantiles": f"WITH {DRAWS}{RISK} SELECT horizon_h, region_id, {r('wind_p10', 'wind_p10')}, {r('wind_p50', 'wind_p50')}, {r('wind_p90', 'wind_p90')} FROM bands",
    "a13_frobenius": f"WITH {ZONES25}, m AS (SELECT {matern('1.5')} AS v FROM km) SELECT {r('sqrt(sum(v * v))', 'frobenius')} FROM m",
    "a14_median_error": f"""WITH {DRAWS}, med AS (SELECT sample_id, quantile_cont(value, 0.5) AS m FROM draws GROUP BY ALL)
        SELECT {r('avg(abs(value - m))', 'crps_median_mae')} FROM draws JOIN med USING (sample_id) WHERE region_id = 'd0'""",
    "a15_elbo_converged": f"WITH {ELBO} SELECT run_id, n_points, {r('elbo_final', 'elbo_final')}, {r('sd', 'sd')}, {r('mean', 'mean')}, elbo_converged FROM converged",
    "a16_elbo_drift": f"""WITH {ELBO}, tails AS (SELECT *, greatest(1, floor(n * CAST(0.05 AS DOUBLE))) AS tail FROM newest),
        means AS (SELECT run_id, avg(elbo) FILTER (rn <= tail) AS a, avg(elbo) FILTER (rn > tail AND rn <= 2 * tail) AS b FROM tails WHERE n >= 40 GROUP BY run_id)
        SELECT run_id, {r('abs(a - b) / (abs(b) + 1e-9)', 'rel_delta', 9)}, abs(a - b) / (abs(b) + 1e-9) > 1e-3 AS still_improving FROM means""",
    "a17_split_rhat": f"WITH {RHAT} SELECT param, {r('r_hat', 'r_hat')} FROM rhat",
    "a17_average_ranks": f"""WITH {CHAINS}, ranked AS (SELECT param, value, rank() OVER (PARTITION BY param ORDER BY value) AS lo,
            count(*) OVER (PARTITION BY param, value) AS c, count(*) OVER (PARTITION BY param) AS n FROM chains)
        SELECT DISTINCT param, {r('value', 'value')}, {r('lo + (c - 1) / 2.0', 'rank')}, n FROM ranked""",
    "a17_divergences": f"WITH {CHAINS} SELECT count(*) AS n_divergences FROM chains WHERE param = 'd0' AND abs(value) > 0.25",
    "a18_zone_correlation": f"WITH {HOURLY}{PAIRS} SELECT zone_a, zone_b, {r('value', 'value')} FROM corr",
    "a18_zone_correlation_many": f"""WITH {DRAWS}, pairs AS (SELECT a.region_id AS zone_a, b.region_id AS zone_b,
            covar_pop(a.value, b.value) / nullif(stddev_pop(a.value) * stddev_pop(b.value), 0) AS v
            FROM draws a JOIN draws b ON a.sample_id = b.sample_id GROUP BY ALL)
        SELECT zone_a, zone_b, {r('v', 'value')} FROM pairs""",
    "a18_zone_correlation_tiled": f"""WITH {DRAWS}, pairs AS (SELECT a.region_id AS zone_a, b.region_id AS zone_b,
            covar_pop(a.value, b.value) / nullif(stddev_pop(a.value) * stddev_pop(b.value), 0) AS v
            FROM draws a JOIN draws b ON a.sample_id = b.sample_id GROUP BY ALL)
        SELECT zone_a, zone_b, {r('v', 'value')} FROM pairs""",
    "a19_zone_means": f"WITH {HOURLY} SELECT region_id, {r('avg(wind_speed_mps)', 'mean_wind')} FROM hourly GROUP BY ALL",
    "a20_parameter_correlation": f"""WITH {CHAINS}, p AS (SELECT * FROM chains WHERE param IN ('d0', 'd1', 'd2'))
        SELECT a.param AS param_a, b.param AS param_b, {r('covar_pop(a.value, b.value) / (stddev_pop(a.value) * stddev_pop(b.value))', 'value')}
        FROM p a JOIN p b ON a.chain = b.chain AND a.draw = b.draw GROUP BY ALL""",
    "a21_share_below": f"WITH {OBS} SELECT region_id, {r('avg(CAST(wind_speed_mps < 3.0 AS DOUBLE))', 'share_below')}, count(*) AS n_rows FROM obs GROUP BY ALL",
    "a23_sufficient_statistics": f"""WITH {FEATURES}, box AS (SELECT (min(x_s) + max(x_s)) / 2 AS cs, 1.5 * (max(x_s) - min(x_s)) / 2 AS ls,
            (min(x_t) + max(x_t)) / 2 AS ct, 1.5 * (max(x_t) - min(x_t)) / 2 AS lt FROM features),
        phi AS MATERIALIZED (SELECT timestamp, region_id, y, CAST((a - 1) * 10 + b - 1 AS INTEGER) AS j,
            sin(pi() * a * (x_s - cs + ls) / (2 * ls)) / sqrt(ls) * sin(pi() * b * (x_t - ct + lt) / (2 * lt)) / sqrt(lt) AS v
            FROM features, box, range(1, 6) s(a), range(1, 11) t(b))
        SELECT 'gram' AS part, p.j AS i, q.j AS j, {r('sum(p.v * q.v)', 'value', 4)} FROM phi p JOIN phi q
            ON p.timestamp = q.timestamp AND p.region_id = q.region_id AND p.j <= q.j GROUP BY ALL
        UNION ALL SELECT 'proj', j, 0, {r('sum(v * y)', 'value', 4)} FROM phi GROUP BY j
        UNION ALL SELECT 'yy', 0, 0, {r('sum(y * y)', 'value', 4)} FROM features
        UNION ALL SELECT 'n', 0, 0, CAST(count(*) AS DOUBLE) FROM features""",
    "a23_incremental_fit": f"""WITH {FEATURES}, box AS (SELECT (min(x_s) + max(x_s)) / 2 AS cs, 1.5 * (max(x_s) - min(x_s)) / 2 AS ls,
            0.75 * max(x_t) AS ct, 1.5 * 0.75 * max(x_t) AS lt FROM features),
        phi AS MATERIALIZED (SELECT timestamp, region_id, y, CAST((a - 1) * 10 + b - 1 AS INTEGER) AS j,
            sin(pi() * a * (x_s - cs + ls) / (2 * ls)) / sqrt(ls) * sin(pi() * b * (x_t - ct + lt) / (2 * lt)) / sqrt(lt) AS v
            FROM features, box, range(1, 6) s(a), range(1, 11) t(b))
        SELECT 'gram' AS part, p.j AS i, q.j AS j, {r('sum(p.v * q.v)', 'value', 4)} FROM phi p JOIN phi q
            ON p.timestamp = q.timestamp AND p.region_id = q.region_id AND p.j <= q.j GROUP BY ALL
        UNION ALL SELECT 'proj', j, 0, {r('sum(v * y)', 'value', 4)} FROM phi GROUP BY j
        UNION ALL SELECT 'yy', 0, 0, {r('sum(y * y)', 'value', 4)} FROM features
        UNION ALL SELECT 'n', 0, 0, CAST(count(*) AS DOUBLE) FROM features""",
    "a24_log_posterior": f"""WITH {FEATURES}, box AS (SELECT (min(x_s) + max(x_s)) / 2 AS cs, 1.5 * (max(x_s) - min(x_s)) / 2 AS ls,
            (min(x_t) + max(x_t)) / 2 AS ct, 1.5 * (max(x_t) - min(x_t)) / 2 AS lt FROM features),
        phi AS (SELECT y, sin(pi() * (x_s - cs + ls) / (2 * ls)) / sqrt(ls) * sin(pi() * (x_t - ct + lt) / (2 * lt)) / sqrt(lt) AS v,
            sin(pi() * (x_s - cs + ls) / (2 * ls)) / sqrt(ls) * sin(pi() * 2 * (x_t - ct + lt) / (2 * lt)) / sqrt(lt) AS w FROM features, box),
        sums AS (SELECT sum(v * v) AS vv, sum(v * w) AS vw, sum(w * w) AS ww, sum(v * y) AS vy, sum(w * y) AS wy, sum(y * y) AS yy, count(*) AS n FROM phi),
        theta AS (SELECT a.x AS ell_spatial, b.x AS ell_temporal, c.x AS eta, d.x AS sigma
            FROM (SELECT unnest([0.1::DOUBLE, 0.5, 2.0]) AS x) a, (SELECT unnest([0.2::DOUBLE, 1.0, 5.0]) AS x) b,
                 (SELECT unnest([0.5::DOUBLE, 4.0]) AS x) c, (SELECT unnest([1.0::DOUBLE, 3.0]) AS x) d),
        spectral AS (SELECT theta.*, sums.*, eta / sigma AS ratio,
            sqrt(10 * pi() * pow(5, 2.5) * ell_spatial * ell_temporal * pow(5 + pow(ell_spatial * pi() / (2 * ls), 2) + pow(ell_temporal * pi() / (2 * lt), 2), -3.5)) AS s1,
            sqrt(10 * pi() * pow(5, 2.5) * ell_spatial * ell_temporal * pow(5 + pow(ell_spatial * pi() / (2 * ls), 2) + pow(ell_temporal * 2 * pi() / (2 * lt), 2), -3.5)) AS s2
            FROM theta, sums, box),
        inner_form AS (SELECT *, 1 + pow(ratio * s1, 2) * vv AS a, pow(ratio, 2) * s1 * s2 * vw AS b, 1 + pow(ratio * s2, 2) * ww AS d,
            ratio * s1 * vy / sigma AS u, ratio * s2 * wy / sigma AS z FROM spectral)
        SELECT ell_spatial, ell_temporal, eta, sigma, {r("""-0.5 * (yy / (sigma * sigma) - (u * u * d - 2 * u * z * b + z * z * a) / (a * d - b * b) + ln(a * d - b * b)
                + 2 * n * ln(sigma) + n * ln(2 * pi()))
            + 3 * ln(0.5) - ln(2) - 3 * ln(ell_spatial) - 0.5 / ell_spatial - ln(2) - 3 * ln(ell_temporal) - 1 / ell_temporal
            + ln(eta * sigma) + ln(2 / pi()) - ln(3) - ln(2) - eta * eta / 18 - sigma * sigma / 8""", "log_post", 4)} FROM inner_form""",
    "a26_fixed_count": f"""WITH {DRAWS}, numbered AS (SELECT *, dense_rank() OVER (PARTITION BY horizon_h ORDER BY sample_id) AS k FROM draws)
        SELECT horizon_h, CAST(k - 1 AS INTEGER) AS sample_id, region_id, {r('value', 'value')} FROM numbered WHERE k <= 30""",
    "a27_forecasts": f"""WITH {DRAWS}{RISK} SELECT region_id, horizon_h, {r('p_shortfall', 'p_shortfall')}, {r('cvar_shortfall', 'cvar_shortfall')},
        {r('wind_p10', 'wind_p10')}, {r('wind_p50', 'wind_p50')}, {r('wind_p90', 'wind_p90')} FROM forecasts""",
    "a28_alert_records": f"""WITH {DRAWS}{RISK} SELECT region_id, horizon_h, {r('p_shortfall', 'p_shortfall')},
        'Risk alert: region=' || region_id || ' horizon_h=' || horizon_h || ' p_shortfall=' || printf('%.3f', round(p_shortfall, 3)) AS message FROM tail_risk WHERE p_shortfall >= 0.2""",
    "a28_alert_count": f"WITH {DRAWS}{RISK} SELECT count(*) AS alerts_published FROM tail_risk WHERE p_shortfall >= 0.2",
    "a29_price_regimes": f"""WITH {HOURLY}, {FLAGS}, {PRICES} SELECT coalesce(f.is_drought, false) AS is_drought,
        {r('avg(CAST(price_eur_mwh > 200 AS DOUBLE))', 'spike_share')}, {r('avg(price_eur_mwh)', 'mean_price')}, count(*) AS n_rows
        FROM prices LEFT JOIN flags f USING (timestamp) GROUP BY ALL""",
    "a30_joint_drought": f"""WITH {DRAWS}, below AS (SELECT horizon_h, sample_id, count(*) FILTER (value < 3.0) AS k FROM draws GROUP BY ALL)
        SELECT horizon_h, {r('avg(CAST(k >= 12 AS DOUBLE))', 'p_joint')} FROM below GROUP BY ALL""",
    "a31_diagnostics": f"""WITH {ELBO}, {ZONES25}, {DRAWS}, low AS (SELECT * FROM converged WHERE run_id = '5-LOW'), m AS (SELECT {matern('1.5')} AS v FROM km),
        med AS (SELECT sample_id, quantile_cont(value, 0.5) AS md FROM draws GROUP BY ALL)
        SELECT 'elbo_final' AS key, {r('elbo_final', 'value')} FROM low UNION ALL SELECT 'elbo_converged', CAST(elbo_converged AS DOUBLE) FROM low
        UNION ALL SELECT 'spatial_corr_norm', {r('sqrt(sum(v * v))', 'value')} FROM m
        UNION ALL SELECT 'crps', {r('avg(abs(value - md))', 'value')} FROM draws JOIN med USING (sample_id) WHERE region_id = 'd0'""",
    "o2_worst_scenarios": f"WITH {DRAWS}{RISK} SELECT horizon_h, sample_id, {r('total', 'total')} FROM tail",
    "o4_last_points": f"WITH {ELBO} SELECT run_id, iter, {r('elbo', 'elbo')}, CAST(rn AS INTEGER) AS rn FROM newest WHERE rn <= 500",
    "o5_zone_list": "SELECT DISTINCT event_type AS region_id FROM events ORDER BY 1",
    "u1_energy_union": f"""WITH {GENERATION} SELECT file_id, timestamp, region_id, {r('wind_onshore_mwh', 'wind_onshore_mwh')}, {r('wind_offshore_mwh', 'wind_offshore_mwh')},
        CAST(NULL AS DOUBLE) AS total_load_mwh FROM generation
        UNION ALL SELECT file_id, timestamp, region_id, NULL, NULL, {r('sum(value_mwh)', 'total_load_mwh')} FROM energy WHERE variable = 'load_mwh' GROUP BY ALL""",
    "u2_concat_chains": f"WITH {CHAINS} SELECT chain, param, count(*) AS n_draws, {r('sum(value)', 'total')} FROM chains GROUP BY ALL",
    "m1_last_write_wins": f"WITH {LAST} SELECT hour, min(first_seen) OVER (PARTITION BY hour) AS timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')} FROM last_values",
    "m2_map_lookup": f"WITH {LAST} SELECT hour, {r("max(wind_speed_mps) FILTER (region_id = 'view')", 'view')}, CAST(NULL AS DOUBLE) AS absent FROM last_values GROUP BY hour",
    "m3_nested_matrix": f"WITH {HOURLY}{PAIRS} SELECT zone_a, zone_b, {r('value', 'value')} FROM corr",
    "t1_hourly_snapshots": f"""WITH {LAST} SELECT hour, min(first_seen) OVER (PARTITION BY hour) AS timestamp, region_id, {r('wind_speed_mps', 'wind_speed_mps')}
        FROM last_values""",
    "t2_t4_window_correlations": f"""WITH {WINDOWS} SELECT c.window_start, c.window_start + INTERVAL 6 HOUR AS window_end, h.timestamp, c.region_id, {r('c.mean_wind', 'mean_wind')}
        FROM counted c JOIN valid v USING (window_start) JOIN hours h ON h.hour = v.last_hour""",
    "t3_window_correlation_cells": f"WITH {WINDOWS} SELECT window_start, zone_a, zone_b, {r('value', 'value')} FROM cells",
    "t5_alert_stream": f"WITH {DRAWS}{RISK} SELECT horizon_h, region_id, {r('p_shortfall * 5', 'p_shortfall')} FROM tail_risk WHERE p_shortfall * 5 >= 0.9",
    "t6_early_warnings": f"""WITH {WINDOWS}, warned AS (SELECT window_start FROM cells WHERE zone_a < zone_b GROUP BY window_start HAVING bool_and(coalesce(value > -0.6, false)))
        SELECT w.window_start, w.window_start + INTERVAL 6 HOUR AS window_end, h.timestamp FROM warned w JOIN valid v USING (window_start) JOIN hours h ON h.hour = v.last_hour""",
    "t6_warning_episodes": f"""WITH {WINDOWS}, warned AS (
            SELECT window_start, string_agg(zone_a, ',' ORDER BY zone_a) FILTER (WHERE zone_a = zone_b) AS zones, min(value) FILTER (WHERE zone_a < zone_b) AS strength
            FROM cells GROUP BY window_start HAVING bool_and(coalesce(value > -0.6, false)) FILTER (WHERE zone_a < zone_b)),
        marked AS (SELECT *, coalesce(window_start < max(window_start) OVER (PARTITION BY zones ORDER BY window_start
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + INTERVAL 6 HOUR, false) AS joins FROM warned),
        numbered AS (SELECT *, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY zones ORDER BY window_start) AS episode FROM marked)
        SELECT zones, min(window_start) AS episode_start, max(window_start) + INTERVAL 6 HOUR AS episode_end, {r('max(strength)', 'peak')}, count(*) AS windows
        FROM numbered GROUP BY zones, episode""",
    "s9_replayed_topic": f"""WITH {OBS} SELECT region_id, count(*) AS n_rows, count(*) AS n_offsets, true AS dense, {r('sum(wind_speed_mps)', 'total', 4)}
        FROM obs GROUP BY region_id""",
    "q1_forecast": f"WITH {STAMPED} SELECT region_id, horizon_h, p_shortfall, 'ok' AS status FROM stamped WHERE region_id = 'SE1' AND horizon_h = 24 UNION ALL SELECT 'FI', 48, 0.0, 'stub'",
    "q2_scenario": f"""WITH {STAMPED} SELECT region_id, horizon_h, p_shortfall, cvar_shortfall, wind_p10, wind_p50, wind_p90, 'ok' AS status
        FROM stamped WHERE region_id = 'DK1' AND horizon_h = 48 UNION ALL SELECT 'FI', 72, NULL, NULL, NULL, NULL, NULL, 'unavailable'""",
    "q3_scenarios": f"WITH {STAMPED} SELECT * REPLACE (strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp) FROM stamped",
    "q3_scenario_count": f"WITH {STAMPED} SELECT count(*) AS count, 'ok' AS status FROM stamped",
    "q4_correlations": f"WITH {HOURLY}{PAIRS} SELECT zone_a, zone_b, {r('value', 'value')} FROM corr",
    "f10_o3_first_match": f"WITH {STAMPED} SELECT region_id, 24 AS horizon_h, p_shortfall, cvar_shortfall, wind_p10, wind_p50, wind_p90, 'ok' AS status FROM stamped WHERE region_id = 'NO2' AND horizon_h = 72",
}
ORACLES["a11_cvar_any_size"] = ORACLES["a11_cvar"]
ORACLES["a12_quantiles_any_size"] = ORACLES["a12_quantiles"]
ORACLES["a12_quantiles_wide_range"] = f"""WITH v AS (SELECT l_returnflag AS flag,
        round(power(10.0, ((l_orderkey * 7 + l_linenumber * 13) % 261) - 130) * l_quantity, 140) AS value FROM lineitem)
    SELECT flag, {r('log10(quantile_cont(value, 0.1))', 'p10')}, {r('log10(quantile_cont(value, 0.5))', 'p50')}, {r('log10(quantile_cont(value, 0.9))', 'p90')}
    FROM v GROUP BY flag"""
ORACLES["a17_average_ranks_nulls"] = """WITH v AS (SELECT event_type AS param, event_id, value AS x FROM events WHERE event_id % 10 NOT IN (0, 1))
    SELECT param, event_id, rank() OVER (PARTITION BY param ORDER BY x) + (count(*) OVER (PARTITION BY param, x) - 1) / 2.0 AS rank,
        count(*) OVER (PARTITION BY param) AS n FROM v"""
ORACLES["a18_constant_zone"] = f"""WITH {HOURLY}, z AS (SELECT * FROM hourly UNION ALL SELECT DISTINCT timestamp, 'constant', 0.1 FROM hourly),
    whole AS (SELECT timestamp FROM z WHERE wind_speed_mps IS NOT NULL GROUP BY timestamp HAVING count(*) = (SELECT count(DISTINCT region_id) FROM z)),
    k AS (SELECT z.* FROM z JOIN whole USING (timestamp))
    SELECT a.region_id AS zone_a, b.region_id AS zone_b,
        CASE WHEN a.region_id <> 'constant' AND b.region_id <> 'constant' THEN round(corr(a.wind_speed_mps, b.wind_speed_mps), 6) END AS value
    FROM k a JOIN k b USING (timestamp) GROUP BY a.region_id, b.region_id"""
ORACLES["a27_missing_draws"] = f"""WITH {DRAWS}, known AS (SELECT horizon_h, region_id,
        CASE WHEN region_id <> 'd0' AND sample_id % 5 <> 0 THEN value END AS value FROM draws)
    SELECT horizon_h, region_id, {r('avg(CASE WHEN value IS NOT NULL THEN (value < 3.0)::INT END)', 'p_shortfall')},
        {r('avg(CASE WHEN value IS NOT NULL THEN (value < 3.0)::INT END)', 'p_tail')} FROM known GROUP BY ALL"""
ORACLES["a14_crps"] = f"""WITH {DRAWS}, y AS (SELECT sample_id, value AS y FROM draws WHERE region_id = 'd0'),
    error AS (SELECT sample_id, avg(abs(value - y)) AS e FROM draws JOIN y USING (sample_id) GROUP BY ALL),
    spread AS (SELECT a.sample_id, avg(abs(a.value - b.value)) AS s FROM draws a JOIN draws b USING (sample_id) GROUP BY ALL)
    SELECT {r('avg(e - s / 2)', 'crps')} FROM error JOIN spread USING (sample_id)"""


def _normal_quantile(p: str) -> str:
    """SQL of the normal quantile by the same published coefficients."""
    def ratio(parts, x: str) -> str:
        def polynomial(coefficients) -> str:
            value = f"CAST({coefficients[0]!r} AS DOUBLE)"
            for coefficient in coefficients[1:]:
                value = f"({value} * ({x}) + CAST({coefficient!r} AS DOUBLE))"
            return value
        return f"{polynomial(parts[0])} / {polynomial(parts[1])}"
    tail = f"sqrt(-ln(least({p}, 1 - {p})))"
    outer = f"CASE WHEN {tail} <= 5 THEN {ratio(normal.MIDDLE, f'{tail} - 1.6')} ELSE {ratio(normal.FAR, f'{tail} - 5')} END"
    return (f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio(normal.CENTRAL, f'0.180625 - ({p} - 0.5) * ({p} - 0.5)')} "
            f"WHEN {p} < 0.5 THEN -({outer}) ELSE {outer} END")


def _rank_rhat(name: str, source: str) -> str:
    return f"""{name}_r AS (SELECT param, chain, half, (rank() OVER (PARTITION BY param ORDER BY x) + (count(*) OVER (PARTITION BY param, x) - 1) / 2.0 - 0.375)
            / (count(*) OVER (PARTITION BY param) + 0.25) AS p FROM {source}),
        {name}_z AS (SELECT param, chain, half, {_normal_quantile('p')} AS z FROM {name}_r),
        {name}_s AS (SELECT param, chain, half, count(*) AS n, avg(z) AS m, var_samp(z) AS v FROM {name}_z GROUP BY ALL),
        {name} AS (SELECT param, sqrt((avg(v) * (avg(n) - 1) / avg(n) + var_samp(m)) / avg(v)) AS r FROM {name}_s GROUP BY param)"""


ORACLES["a17_rank_rhat"] = f"""WITH {RHAT}, halves AS (SELECT param, chain, half, value AS x FROM split WHERE half IS NOT NULL),
    med AS (SELECT param, quantile_cont(x, 0.5) AS m FROM halves GROUP BY param),
    folds AS (SELECT param, chain, half, abs(x - m) AS x FROM halves JOIN med USING (param)),
    {_rank_rhat('bulk', 'halves')}, {_rank_rhat('folded', 'folds')}
    SELECT param, {r('greatest(bulk.r, folded.r)', 'r_hat')} FROM bulk JOIN folded USING (param)"""
ORACLES["s1_skipped_files"] = "SELECT 'broken' AS why, 1 AS n_files UNION ALL SELECT 'unreadable', 1"
ORACLES["s4_unreadable_documents"] = "SELECT event_type AS region_id, count(*) AS n_documents FROM events WHERE event_id % 3 = 0 GROUP BY ALL"
ORACLES["k5_recomputed_means"] = f"WITH {NEAREST} SELECT count(*) AS n_rows, true AS first, false AS again FROM silver"
ORACLES["i2_saved_model"] = """SELECT region_id, horizon_h, true AS fitted, false AS fitted_again, CAST(0 AS DOUBLE) AS gap
    FROM (SELECT DISTINCT event_type AS region_id FROM events), (SELECT unnest([24, 48, 72]) AS horizon_h)"""
ORACLES["p7_matern_any_nu"] = f"""WITH {ZONES25}, s AS (SELECT zone_a, zone_b, sqrt(CAST(7 AS DOUBLE)) * km / CAST(500.000000001 AS DOUBLE) AS s FROM km)
    SELECT zone_a, zone_b, {r('(1 + s + 0.4 * s * s + s * s * s / 15) * exp(-s)', 'value')} FROM s"""
ORACLES["a17_divergences"] = f"""WITH {CHAINS} SELECT count(*) AS n_divergences FROM
    (SELECT chain, draw FROM chains GROUP BY ALL HAVING max(abs(value)) > 0.25)"""
ORACLES["k5_changed_parts"] = f"""WITH {OBS}, ends AS (SELECT date_trunc('day', min(timestamp)) AS low, date_trunc('hour', max(timestamp)) AS high FROM obs)
    SELECT CAST(year(timestamp) AS INTEGER) AS year, CAST(dayofyear(timestamp) - 1 AS INTEGER) AS slot, min(timestamp) AS first, max(timestamp) AS last,
    CASE WHEN date_trunc('day', timestamp) = low THEN 'removed' ELSE 'changed' END AS kind,
    CAST(count(*) FILTER (date_trunc('day', timestamp) <> low) AS BIGINT) AS n_rows, count(*) AS n_rows_before
    FROM obs, ends WHERE date_trunc('day', timestamp) IN (low, date_trunc('day', high)) GROUP BY ALL"""
ORACLES["k1_table_versions"] = f"""WITH {OBS}, v AS (SELECT 0 AS version UNION ALL SELECT 1)
    SELECT version, region_id, count(*) AS n_rows, {r('sum(wind_speed_mps)', 'wind_sum')}, false AS written_again
    FROM obs, v WHERE version = 0 OR region_id <> 'view' GROUP BY ALL"""
COARSE = f"""WITH {GRID}, coarse AS (SELECT timestamp, floor(latitude / 5) * CAST(5 AS DOUBLE) AS latitude, floor(longitude / 10) * CAST(10 AS DOUBLE) AS longitude,
    sum(u10) AS u10, max(v10) AS v10 FROM grid GROUP BY ALL)"""
ORACLES["s1_binary_grid"] = f"""{COARSE} SELECT CAST(timestamp AS TIMESTAMP) AS timestamp, latitude, longitude, {r('CAST(u10 AS DOUBLE)', 'u10')}, {r('CAST(v10 AS DOUBLE)', 'v10')}
    FROM coarse WHERE timestamp >= DATE '1994-03-01' AND timestamp < DATE '1996-10-15'"""
ORACLES["s1_binary_grid_report"] = f"""{COARSE} SELECT CAST(year(timestamp) AS INTEGER) AS year, count(DISTINCT timestamp) AS n_times,
    count(DISTINCT latitude) * count(DISTINCT longitude) AS n_cells, true AS readable FROM coarse GROUP BY ALL"""
