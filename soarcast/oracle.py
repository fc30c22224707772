"""Independent DuckDB SQL for every registered query (the correctness gate).

The SQL re-derives the weather inputs from the raw ``lineitem``/``events`` views with
the same projections as ``sources.fixtures`` and then states each query the plain
way (e.g. Q8 as two aggregates and a join). Conventions that keep types and values
comparable with Spark: double literals are written ``1e0`` style, ``rank()`` and
calendar parts are cast to INTEGER, NULL ordering is spelled out, and every rounded
value states its rule (``R``): half up on nine decimals, plain doubles beyond 1e19.
"""

from __future__ import annotations


def R(expr: str, scale: int) -> str:
    """Rounding half up to ``scale`` digits: by decimals where they reach, else by doubles."""
    x = f"CAST(({expr}) AS DOUBLE)"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) OR isinf({x}) THEN {x} WHEN abs({x}) >= 1e19 THEN round({x}, {scale}) "
            f"ELSE CAST(round(TRY_CAST({x} AS DECIMAL(28,9)), {scale}) AS DOUBLE) END")


GRID_RAW = """
grid_raw AS (
  SELECT
    l_orderkey * 10 + l_linenumber AS obs_id,
    CAST(l_shipdate + to_hours(CAST(h AS BIGINT)) AS TIMESTAMP) AS time,
    CAST(42.75e0 + 0.25e0 * (l_suppkey % 4) AS DOUBLE) AS latitude,
    CAST(19.5e0 + 0.25e0 * ((l_suppkey // 4) % 4) AS DOUBLE) AS longitude,
    t2m,
    t2m - (l_discount * 120e0 - 1e0) AS d2m,
    (l_quantity - 25e0) / 2e0 AS u10,
    l_tax * 100e0 - 2e0 AS v10,
    l_extendedprice / 50e0 AS cape,
    200e0 + (l_partkey % 200) * 10e0 AS blh,
    95000e0 + l_suppkey * 10e0 AS sp,
    ((l_orderkey * 7 + l_linenumber) % 101) / 100e0 AS tcc
  FROM (
    SELECT *, 278.15e0 + 2e0 * (6 - abs(month(l_shipdate) - 7)) + 0.5e0 * (12 - abs(h - 14)) AS t2m
    FROM (SELECT *, (l_orderkey + 5 * l_linenumber) % 24 AS h FROM lineitem)
  )
)"""

OBS = """
obs AS (
  SELECT obs_id, time, latitude, longitude, cape, blh, sp, tcc, year, month, day, hour,
    temp_c, dewpoint_c, wind_speed, wind_dir, cloud_base_m,
    cloud_base_m < 0 AS fog_condition,
    CASE
      WHEN wind_speed BETWEEN 2 AND 12 AND cape > 300 AND cloud_base_m > 800 AND tcc < 0.8e0 THEN 'expert'
      WHEN wind_speed BETWEEN 1 AND 8 AND cape BETWEEN 100 AND 800 AND cloud_base_m > 500 AND tcc < 0.6e0
        THEN 'beginner'
      WHEN wind_speed BETWEEN 1 AND 5 AND cape BETWEEN 50 AND 300 AND cloud_base_m > 300 AND tcc < 0.5e0
        THEN 'student'
      ELSE 'not_flyable' END AS flying_category,
    CASE WHEN cape < 100 THEN 'none' WHEN cape < 500 THEN 'weak' WHEN cape < 1000 THEN 'moderate'
      ELSE 'strong' END AS thermal_strength,
    CASE WHEN hour >= 6 AND hour < 10 THEN 'morning' WHEN hour >= 10 AND hour < 14 THEN 'midday'
      WHEN hour >= 14 AND hour < 18 THEN 'afternoon' WHEN hour >= 18 AND hour < 21 THEN 'evening'
      ELSE 'non_flying' END AS time_of_day,
    CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
      WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
  FROM (
    SELECT *, (temp_c - dewpoint_c) / 8 * 1000 AS cloud_base_m
    FROM (
      SELECT obs_id, time, latitude, longitude, cape, blh, sp, tcc,
        CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
        CAST(day(time) AS INTEGER) AS day, CAST(hour(time) AS INTEGER) AS hour,
        t2m - 273.15e0 AS temp_c, d2m - 273.15e0 AS dewpoint_c,
        sqrt(u10 * u10 + v10 * v10) AS wind_speed,
        (degrees(atan2(u10, v10)) + 180) % 360 AS wind_dir
      FROM grid_raw
    )
  )
)"""

EVENTS = """
events_typed AS (
  SELECT
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    ['Vrsac', 'Fruska_Gora', 'Rtanj', 'Zlatibor', 'Kopaonik'][user_id % 5 + 1] AS location,
    [45.1167e0, 45.1333e0, 43.7667e0, 43.7333e0, 43.2833e0][user_id % 5 + 1] AS lat,
    [21.3e0, 19.7e0, 21.9e0, 19.7167e0, 20.8e0][user_id % 5 + 1] AS lon,
    10e0 + event_id % 20 AS temp_c,
    CAST(NULL AS DOUBLE) AS dewpoint_c,
    1013e0 AS pressure,
    CAST(NULL AS DOUBLE) AS humidity,
    value % 16 AS wind_speed,
    0e0 AS wind_dir,
    (value % 16) * 1.5e0 AS wind_gust,
    (event_id % 11) / 10e0 AS cloud_cover,
    10000e0 AS visibility,
    event_type AS weather_desc,
    (event_id % 17) * 75e0 AS cloud_base_m,
    CAST(ts AS TIMESTAMP) AS event_time
  FROM events
),
scored AS (
  SELECT *, CASE WHEN flying_score >= 5 THEN 'YES' ELSE 'NO' END AS flyable
  FROM (
    SELECT *,
      CASE WHEN wind_speed > 12 THEN 0e0 WHEN cloud_base_m < 300 THEN 0e0
        ELSE least(10e0, cloud_base_m / 300 * 2 + (10 - wind_speed) * 0.5e0
                         + CASE WHEN cloud_cover < 0.5e0 THEN 2 ELSE 0 END) END AS flying_score
    FROM events_typed
  )
)"""

N_CELLS = "(SELECT count(*) FROM (SELECT DISTINCT latitude, longitude FROM obs))"
N_YEARS = "(SELECT count(*) FROM (SELECT DISTINCT year FROM obs))"


def _pct(cond: str) -> str:
    return f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END) * 100e0 / count(*)"


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


GRID = (GRID_RAW, OBS)

Q3_BODY = f"""
q3 AS (
  SELECT *,
    {R("avg(avg_cape) OVER (ORDER BY hour ASC NULLS FIRST ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)", 2)}
      AS cape_rolling_avg,
    {R("avg(avg_blh) OVER (ORDER BY hour ASC NULLS FIRST ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)", 2)}
      AS blh_rolling_avg
  FROM (
    SELECT hour,
      {R("avg(cape)", 2)} AS avg_cape, {R("avg(blh)", 2)} AS avg_blh,
      {R("avg(wind_speed)", 2)} AS avg_wind, {R("avg(cloud_base_m)", 2)} AS avg_cloud_base,
      {R(_pct("flying_category <> 'not_flyable'"), 1)} AS flyable_pct
    FROM obs WHERE month BETWEEN 4 AND 9 GROUP BY hour
  )
)"""

Q1 = _with(*GRID) + f"""
SELECT *,
  {R("sum(student_hours) OVER (ORDER BY month ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", 1)}
    AS cumulative_student,
  {R("sum(expert_hours) OVER (ORDER BY month ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", 1)}
    AS cumulative_expert
FROM (
  SELECT month,
    {R(_cnt("flying_category = 'student'") + " / " + N_CELLS, 1)} AS student_hours,
    {R(_cnt("flying_category = 'beginner'") + " / " + N_CELLS, 1)} AS beginner_hours,
    {R(_cnt("flying_category = 'expert'") + " / " + N_CELLS, 1)} AS expert_hours
  FROM obs GROUP BY month
)"""

Q2_CELLS = f"""
q2 AS (
  SELECT *, CAST(rank() OVER (ORDER BY stability_score ASC NULLS LAST) AS INTEGER) AS stability_rank
  FROM (
    SELECT *,
      {R("wind_stddev * 0.4e0 + cape_stddev * 0.001e0 + cloud_base_stddev * 0.01e0", 3)} AS stability_score
    FROM (
      SELECT latitude, longitude,
        {R("stddev_samp(wind_speed)", 3)} AS wind_stddev,
        {R("stddev_samp(cape)", 3)} AS cape_stddev,
        {R("stddev_samp(cloud_base_m)", 3)} AS cloud_base_stddev,
        {R("avg(wind_speed)", 2)} AS avg_wind,
        {R("avg(cape)", 2)} AS avg_cape,
        {R("avg(cloud_base_m)", 2)} AS avg_cloud_base,
        count(*) AS total_hours
      FROM obs WHERE month BETWEEN 4 AND 9 AND hour BETWEEN 8 AND 18
      GROUP BY latitude, longitude
    )
  )
)"""

Q2 = _with(*GRID, Q2_CELLS) + "SELECT * FROM q2"
Q2_TOP_STABLE = _with(*GRID, Q2_CELLS) + (
    "SELECT * FROM q2 ORDER BY stability_rank NULLS LAST, latitude NULLS LAST, longitude NULLS LAST LIMIT 10"
)
Q2_TOP_UNSTABLE = _with(*GRID, Q2_CELLS) + (
    "SELECT * FROM q2 ORDER BY stability_score DESC NULLS LAST, latitude NULLS LAST, longitude NULLS LAST LIMIT 10"
)

Q3 = _with(*GRID, Q3_BODY) + "SELECT * FROM q3"

Q4 = _with(*GRID) + f"""
SELECT *,
  CAST(rank() OVER (ORDER BY expert_days DESC NULLS LAST) AS INTEGER) AS expert_rank,
  {R("avg_cape - lag(avg_cape) OVER (ORDER BY hour ASC NULLS FIRST)", 1)} AS cape_change
FROM (
  SELECT hour,
    {R(_cnt("flying_category = 'student'") + f" / {N_CELLS} / {N_YEARS}", 1)} AS student_days,
    {R(_cnt("flying_category = 'beginner'") + f" / {N_CELLS} / {N_YEARS}", 1)} AS beginner_days,
    {R(_cnt("flying_category = 'expert'") + f" / {N_CELLS} / {N_YEARS}", 1)} AS expert_days,
    {R("avg(cape)", 1)} AS avg_cape, {R("avg(blh)", 1)} AS avg_blh,
    {R("avg(wind_speed)", 2)} AS avg_wind, {R("avg(cloud_base_m)", 0)} AS avg_cloud_base
  FROM obs
  WHERE month BETWEEN 4 AND 9 AND hour BETWEEN 6 AND 21 AND flying_category <> 'not_flyable'
  GROUP BY hour
)"""


def _corr(a: str, b: str) -> str:
    spread = (f"sqrt(var_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
              f"var_pop(CASE WHEN {a} IS NOT NULL THEN {b} END))")
    return f"CASE WHEN {spread} > 0 THEN covar_pop({a}, {b}) / {spread} END"


Q5 = _with(*GRID) + f"""
SELECT *, CAST(rank() OVER (ORDER BY cape_cloudbase_corr DESC NULLS LAST) AS INTEGER) AS correlation_rank
FROM (
  SELECT month,
    {R(_corr("cape", "cloud_base_m"), 3)} AS cape_cloudbase_corr,
    {R(_corr("cape", "blh"), 3)} AS cape_blh_corr,
    {R("avg(cape)", 1)} AS avg_cape, {R("avg(cloud_base_m)", 0)} AS avg_cloud_base, {R("avg(blh)", 0)} AS avg_blh
  FROM obs WHERE month BETWEEN 4 AND 9 AND hour BETWEEN 8 AND 18 GROUP BY month
)"""

DANGER = "wind_speed > 12 OR cape > 2000 OR cloud_base_m < 100 OR tcc > 0.9e0"

Q6 = _with(*GRID) + f"""
SELECT *, CAST(rank() OVER (PARTITION BY season ORDER BY dangerous_pct DESC NULLS LAST) AS INTEGER) AS danger_rank
FROM (
  SELECT season, time_of_day,
    {R(_pct(DANGER), 1)} AS dangerous_pct,
    {R("avg(wind_speed)", 2)} AS avg_wind, {R("avg(cape)", 1)} AS avg_cape, count(*) AS total_hours
  FROM obs GROUP BY season, time_of_day
)"""

XC = ("cape > 500 AND blh > 1000 AND wind_speed BETWEEN 2 AND 10 AND cloud_base_m > 1000 "
      "AND tcc < 0.7e0 AND hour BETWEEN 10 AND 16")

Q7 = _with(*GRID) + f"""
SELECT *,
  CAST(rank() OVER (ORDER BY xc_days DESC NULLS LAST) AS INTEGER) AS xc_rank,
  {R("xc_days - lag(xc_days) OVER (ORDER BY month ASC NULLS FIRST)", 1)} AS xc_days_change
FROM (
  SELECT month,
    {R(_cnt(XC) + f" / {N_CELLS} / {N_YEARS}", 1)} AS xc_days,
    {R("avg(cape)", 1)} AS avg_cape, {R("avg(blh)", 1)} AS avg_blh,
    {R("avg(cloud_base_m)", 0)} AS avg_cloud_base, {R("avg(wind_speed)", 2)} AS avg_wind
  FROM obs GROUP BY month
)"""

SKY = ("CASE WHEN morning_tcc < 0.2e0 THEN 'clear' WHEN morning_tcc < 0.5e0 THEN 'partly_cloudy' "
       "WHEN morning_tcc < 0.8e0 THEN 'mostly_cloudy' ELSE 'overcast' END")

Q8_DAYS = f"""
morning AS (
  SELECT year, month, day, latitude, longitude,
    {R("avg(temp_c)", 2)} AS morning_temp, {R("avg(wind_speed)", 2)} AS morning_wind,
    {R("avg(cape)", 2)} AS morning_cape, {R("avg(tcc)", 2)} AS morning_tcc
  FROM obs WHERE month BETWEEN 5 AND 8 AND hour BETWEEN 6 AND 9 AND temp_c > 10
  GROUP BY year, month, day, latitude, longitude
),
afternoon AS (
  SELECT year, month, day, latitude, longitude, max(flying_category) AS afternoon_category,
    {R("avg(cape)", 2)} AS afternoon_cape, {R("avg(blh)", 2)} AS afternoon_blh
  FROM obs WHERE month BETWEEN 5 AND 8 AND hour BETWEEN 12 AND 16
  GROUP BY year, month, day, latitude, longitude
),
days AS (
  SELECT m.*, a.afternoon_category, a.afternoon_cape, a.afternoon_blh, {SKY} AS morning_sky
  FROM morning m JOIN afternoon a USING (year, month, day, latitude, longitude)
)"""

Q8 = _with(*GRID, Q8_DAYS) + f"""
SELECT *, CAST(rank() OVER (ORDER BY flyable_pct DESC NULLS LAST) AS INTEGER) AS rank
FROM (
  SELECT morning_sky,
    {R(_pct("afternoon_category <> 'not_flyable'"), 1)} AS flyable_pct,
    {R("avg(morning_temp)", 1)} AS avg_morning_temp,
    {R("avg(morning_wind)", 2)} AS avg_morning_wind,
    count(*) AS total_days
  FROM days GROUP BY morning_sky
)"""

D1 = _with(*GRID, Q8_DAYS) + "SELECT * FROM days"

Q9 = _with(*GRID) + f"""
SELECT *,
  CAST(rank() OVER (PARTITION BY season ORDER BY avg_blh DESC NULLS LAST) AS INTEGER) AS blh_rank,
  {R("avg(avg_blh) OVER (PARTITION BY season ORDER BY hour ASC NULLS FIRST "
     "ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)", 0)} AS blh_rolling_avg
FROM (
  SELECT season, hour,
    {R("avg(blh)", 0)} AS avg_blh, {R("avg(cape)", 1)} AS avg_cape,
    {R("avg(cloud_base_m)", 0)} AS avg_cloud_base, {R("avg(temp_c)", 1)} AS avg_temp
  FROM obs WHERE month BETWEEN 4 AND 9 AND hour BETWEEN 6 AND 21 GROUP BY season, hour
)"""

Q10 = _with(*GRID) + f"""
SELECT *,
  {R("avg_temp - lag(avg_temp) OVER (ORDER BY year ASC NULLS FIRST)", 2)} AS temp_trend,
  {R("avg_cape - lag(avg_cape) OVER (ORDER BY year ASC NULLS FIRST)", 2)} AS cape_trend,
  {R("flyable_pct - lag(flyable_pct) OVER (ORDER BY year ASC NULLS FIRST)", 1)} AS flyable_trend
FROM (
  SELECT year,
    {R("avg(temp_c)", 2)} AS avg_temp, {R("avg(cape)", 2)} AS avg_cape,
    {R("avg(blh)", 2)} AS avg_blh, {R("avg(wind_speed)", 2)} AS avg_wind,
    {R(_pct("flying_category <> 'not_flyable'"), 1)} AS flyable_pct
  FROM obs WHERE month BETWEEN 4 AND 9 GROUP BY year
)"""

S1 = _with(EVENTS) + f"""
SELECT location,
  {R("avg(wind_speed)", 2)} AS avg_wind, {R("avg(cloud_base_m)", 0)} AS avg_cloud_base,
  {R("avg(flying_score)", 1)} AS avg_score,
  ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS ws FROM scored WHERE event_time IS NOT NULL)
GROUP BY location, ws"""

S2 = _with(EVENTS) + f"""
SELECT location, avg_wind, max_wind, avg_cloud_base, min_cloud_base, avg_score,
  CASE WHEN max_wind > 10 THEN 'HIGH_WIND' WHEN max_wind > 7 THEN 'MODERATE_WIND' ELSE 'OK' END AS wind_alert,
  CASE WHEN min_cloud_base < 300 THEN 'LOW_CLOUD' WHEN min_cloud_base < 600 THEN 'MODERATE_CLOUD' ELSE 'OK' END
    AS cloud_alert,
  window_start, window_end
FROM (
  SELECT location,
    {R("avg(wind_speed)", 2)} AS avg_wind, {R("max(wind_speed)", 2)} AS max_wind,
    {R("avg(cloud_base_m)", 0)} AS avg_cloud_base, {R("min(cloud_base_m)", 0)} AS min_cloud_base,
    {R("avg(flying_score)", 1)} AS avg_score,
    ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end
  FROM (
    SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS ws FROM scored WHERE event_time IS NOT NULL
    UNION ALL
    SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE AS ws
    FROM scored WHERE event_time IS NOT NULL
  )
  GROUP BY location, ws
)"""

ALERT = ("CASE WHEN wind_speed > 12 THEN 'DANGER_HIGH_WIND' WHEN wind_gust > 15 THEN 'DANGER_GUSTS' "
         "WHEN cloud_base_m < 200 THEN 'DANGER_LOW_CLOUD' "
         "WHEN wind_speed > 8 AND cloud_base_m < 500 THEN 'WARNING_COMBINED' ELSE 'SAFE' END")

S3 = _with(EVENTS) + f"""
SELECT timestamp, location, lat, lon, wind_speed, wind_gust, cloud_base_m, flying_score, alert
FROM (SELECT *, {ALERT} AS alert FROM scored)
WHERE alert <> 'SAFE'"""

S4 = _with(*GRID, Q3_BODY, EVENTS) + f"""
SELECT timestamp, location, lat, lon, wind_speed, cloud_base_m, temp_c, hist_wind, hist_cloud_base, hour,
  wind_vs_historical, cloud_base_vs_historical,
  CASE WHEN wind_vs_historical > 3 THEN 'WORSE_THAN_AVG' WHEN wind_vs_historical < -3 THEN 'BETTER_THAN_AVG'
    ELSE 'AVERAGE' END AS conditions_vs_avg
FROM (
  SELECT s.*, q.avg_wind AS hist_wind, q.avg_cloud_base AS hist_cloud_base,
    {R("s.wind_speed - q.avg_wind", 2)} AS wind_vs_historical,
    {R("s.cloud_base_m - q.avg_cloud_base", 0)} AS cloud_base_vs_historical
  FROM (SELECT *, CAST(hour(event_time) AS INTEGER) AS hour FROM scored) s
  LEFT JOIN q3 q ON s.hour = q.hour
)"""

QUERIES = {
    "q1_category_hours_by_month": Q1,
    "q2_cell_stability": Q2,
    "q2_top10_stable": Q2_TOP_STABLE,
    "q2_top10_unstable": Q2_TOP_UNSTABLE,
    "q3_hourly_conditions": Q3,
    "q4_category_by_hour": Q4,
    "q5_cape_cloudbase_corr": Q5,
    "q6_danger_by_season": Q6,
    "q7_xc_months": Q7,
    "q8_morning_to_afternoon": Q8,
    "q9_blh_through_day": Q9,
    "q10_climate_trend": Q10,
    "s1_location_windows": S1,
    "s2_wind_trend": S2,
    "s3_alerts": S3,
    "s4_vs_baseline": S4,
    "d1_cell_day_join": D1,
    "q8_cell_day_outlook": D1,
    "a4_zone_round_trip": Q3,
}


# --- operator-level checks -------------------------------------------------------

def _obs_select(cols: str, where: str = "") -> str:
    return _with(*GRID) + f"SELECT {cols} FROM obs" + (f" WHERE {where}" if where else "")


MAGNUS_ALPHA = "(17.27e0 * t) / (237.7e0 + t) + ln(h / 100e0)"
MAGNUS = f"CASE WHEN h > 0 THEN {R(f'(237.7e0 * ({MAGNUS_ALPHA})) / (17.27e0 - ({MAGNUS_ALPHA}))', 2)} END"

PAYLOAD_FIELDS = """
payload_fields AS (
  SELECT
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    ['Vrsac', 'Fruska_Gora', 'Rtanj', 'Zlatibor', 'Kopaonik'][user_id % 5 + 1] AS location,
    [45.1167e0, 45.1333e0, 43.7667e0, 43.7333e0, 43.2833e0][user_id % 5 + 1] AS lat,
    [21.3e0, 19.7e0, 21.9e0, 19.7167e0, 20.8e0][user_id % 5 + 1] AS lon,
    10e0 + event_id % 20 AS t,
    1000e0 + event_id % 30 AS pressure,
    CAST(event_id % 100 AS DOUBLE) AS h,
    value % 16 AS wind_speed,
    CASE WHEN event_id % 3 <> 0 THEN CAST((event_id * 37) % 360 AS DOUBLE) END AS deg,
    CASE WHEN event_id % 4 <> 0 THEN (value % 16) * 1.5e0 END AS gust,
    CAST(event_id % 101 AS DOUBLE) AS clouds_all,
    CASE WHEN event_id % 5 <> 0 THEN 10000e0 - (event_id % 10) * 500e0 END AS vis,
    CASE WHEN event_id % 7 <> 0 THEN event_type END AS weather_desc
  FROM events
  WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id % 31 <> 0 AND event_id % 37 <> 0
    AND event_id % 41 <> 0 AND event_id % 100 <> 0
)"""

B23 = _with(PAYLOAD_FIELDS) + f"""
SELECT timestamp, location, lat, lon, temp_c, dewpoint_c, pressure, humidity, wind_speed, wind_dir, wind_gust,
  cloud_cover, visibility, weather_desc, (temp_c - dewpoint_c) / 8 * 1000 AS cloud_base_m
FROM (
  SELECT timestamp, location, lat, lon, t AS temp_c, {MAGNUS} AS dewpoint_c, pressure, h AS humidity,
    wind_speed, COALESCE(deg, 0e0) AS wind_dir, COALESCE(gust, 0e0) AS wind_gust,
    clouds_all / 100e0 AS cloud_cover, COALESCE(vis, 0e0) AS visibility, weather_desc
  FROM payload_fields
)"""

B22 = f"""
SELECT event_id, {MAGNUS} AS dewpoint_c
FROM (SELECT event_id, 10e0 + event_id % 20 AS t, CAST(event_id % 100 AS DOUBLE) AS h FROM events)"""

OPERATOR_QUERIES = {
    "a2_normalize_time": _with(GRID_RAW) + "SELECT obs_id, time FROM grid_raw",
    "b1_calendar": _obs_select("obs_id, year, month, day, hour"),
    "b2_celsius": _obs_select("obs_id, temp_c, dewpoint_c"),
    "b3_wind_speed": _obs_select("obs_id, wind_speed"),
    "b3_wind_speed_float32": _with(GRID_RAW) + """
SELECT obs_id, sqrt(u * u + v * v) AS wind_speed
FROM (SELECT obs_id, CAST(CAST(u10 AS FLOAT) AS DOUBLE) AS u, CAST(CAST(v10 AS FLOAT) AS DOUBLE) AS v FROM grid_raw)""",
    "e8_corr": _with(*GRID) + f"SELECT month, {R(_corr('cape', 'blh'), 6)} AS cape_blh_corr FROM obs GROUP BY month",
    "i3_sliding": _with(EVENTS) + """
SELECT location, count(*) AS n_events, ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end
FROM (
  SELECT location, time_bucket(INTERVAL 5 MINUTE, event_time) - k * INTERVAL 5 MINUTE AS ws
  FROM scored, (VALUES (0), (1)) AS shift(k) WHERE event_time IS NOT NULL
)
GROUP BY location, ws""",
    "b4_wind_dir": _obs_select(f"obs_id, {R('wind_dir', 6)} AS wind_dir"),
    "b5_cloud_base_fog": _obs_select("obs_id, cloud_base_m, fog_condition"),
    "b7_flying_category": _obs_select("obs_id, flying_category"),
    "b8_thermal_strength": _obs_select("obs_id, thermal_strength"),
    "b9_time_of_day": _obs_select("obs_id, hour, time_of_day"),
    "b10_season": _obs_select("obs_id, month, season"),
    "b11_transform": _obs_select(
        f"obs_id, time, latitude, longitude, cape, blh, sp, tcc, year, month, day, hour, temp_c, dewpoint_c, "
        f"wind_speed, {R('wind_dir', 6)} AS wind_dir, cloud_base_m, fog_condition, flying_category, "
        f"thermal_strength, time_of_day, season"),
    "b12_danger_flag": _obs_select(f"obs_id, CASE WHEN {DANGER} THEN 1 ELSE 0 END AS dangerous"),
    "b13_xc_flag": _obs_select(f"obs_id, CASE WHEN {XC} THEN 1 ELSE 0 END AS xc_suitable"),
    "b15_flying_score": _with(EVENTS) + (
        "SELECT timestamp, location, wind_speed, cloud_base_m, cloud_cover, flying_score, flyable FROM scored"),
    "b17_alert": _with(EVENTS) + f"SELECT timestamp, location, wind_speed, wind_gust, cloud_base_m, {ALERT} AS alert "
                                 "FROM scored",
    "b22_dewpoint_magnus": B22,
    "b23_parse_payload": B23,
    "b24_parse_events": _with(EVENTS) + "SELECT * EXCLUDE (flying_score, flyable) FROM scored",
    "c1_season_months": _obs_select("obs_id, month", "month BETWEEN 4 AND 9"),
    "c2_midday_hours": _obs_select("obs_id", "month BETWEEN 4 AND 9 AND hour BETWEEN 8 AND 18"),
    "c3_daylight_hours": _obs_select("obs_id", "month BETWEEN 4 AND 9 AND hour BETWEEN 6 AND 21"),
    "c4_flyable_daylight": _obs_select(
        "obs_id", "month BETWEEN 4 AND 9 AND hour BETWEEN 6 AND 21 AND flying_category <> 'not_flyable'"),
    "c5_diurnal_slice": _obs_select(
        "obs_id", "month BETWEEN 5 AND 8 AND ((hour BETWEEN 6 AND 9 AND temp_c > 10) OR hour BETWEEN 12 AND 16)"),
    "e9_distinct_counts": _with(*GRID) + f"SELECT {N_CELLS} AS n_cells, {N_YEARS} AS n_years",
    "f2_global_rank": _obs_select(
        "obs_id, blh, CAST(rank() OVER (ORDER BY blh DESC NULLS LAST) AS BIGINT) AS blh_rank"),
}

# Spark's to_json leaves out NULL fields; dewpoint_c and humidity are NULL in this input.
A11 = _with(EVENTS) + """
SELECT location AS key,
  to_json(struct_pack(timestamp, location, lat, lon, temp_c, pressure, wind_speed, wind_dir, wind_gust,
                      cloud_cover, visibility, weather_desc, cloud_base_m))::VARCHAR AS value
FROM events_typed"""

OPERATOR_QUERIES["a11_encode_events"] = A11


# --- cell ids, state by year, mixed zones, sites -----------------------------------

def _lattice(c: str, offset: int, limit: int) -> str:
    return (f"CASE WHEN {c} IS NULL THEN 2147483647 WHEN isnan({c}) THEN 2147483646 WHEN {c} > {limit} THEN 2147483645 "
            f"WHEN {c} < -{limit} THEN 2147483644 ELSE CAST(floor(({c} + {offset}) * 2097152e0 + 0.5e0) AS BIGINT) END")


CELL_IDS = _with(*GRID) + f"""
SELECT obs_id, list_sum(list_transform(range(31), lambda b : (((y >> b) & 1) << (2 * b + 1)) | (((x >> b) & 1) << (2 * b))))::BIGINT AS cell_id
FROM (SELECT obs_id, CAST({_lattice('latitude', 256, 255)} AS BIGINT) AS y, CAST({_lattice('longitude', 512, 500)} AS BIGINT) AS x FROM obs)"""

#: south, west, north, east of the box query
BOX = (42.8, 19.6, 43.3, 20.0)

IN_BOX = _with(*GRID) + f"""
SELECT latitude + 0e0 AS latitude, longitude + 0e0 AS longitude, count(*) AS n_rows, sum(hour)::BIGINT AS sum_hours
FROM obs WHERE latitude BETWEEN {BOX[0]}e0 AND {BOX[2]}e0 AND longitude BETWEEN {BOX[1]}e0 AND {BOX[3]}e0 GROUP BY ALL"""

# the estimates themselves are no exact values: each must lie within three percent of the exact count
APPROX_DISTINCT = _with(*GRID) + """
SELECT year, count(*) AS n_cell_hours, TRUE AS within_3_percent
FROM (SELECT DISTINCT year, latitude, longitude, time FROM obs) GROUP BY year
UNION ALL
SELECT -1, count(*), TRUE FROM (SELECT DISTINCT latitude, longitude, time FROM obs)"""

MIXED_ZONE = _obs_select("obs_id, time, latitude, longitude, year, month, hour, temp_c, wind_speed, flying_category")

#: largest distance in degrees of a site's cell
SITE_REACH = 0.6

NEAREST = f"""
sites AS (SELECT DISTINCT location, lat, lon FROM events_typed),
nearest AS (
  SELECT location, lat, lon, latitude AS cell_latitude, longitude AS cell_longitude, d AS cell_distance
  FROM (
    SELECT s.*, c.latitude, c.longitude,
      sqrt(pow(s.lat - c.latitude, 2) + pow(least((abs(s.lon - c.longitude)) % 360, 360 - (abs(s.lon - c.longitude)) % 360)
        * cos(radians(s.lat)), 2)) AS d
    FROM sites s, (SELECT DISTINCT latitude, longitude FROM obs WHERE latitude IS NOT NULL AND longitude IS NOT NULL) c)
  WHERE d <= {SITE_REACH} QUALIFY row_number() OVER (PARTITION BY location ORDER BY d, latitude, longitude) = 1)"""

NEAREST_CELLS = _with(*GRID, EVENTS, NEAREST) + f"""
SELECT location, lat, lon, cell_latitude, cell_longitude, {R('cell_distance', 6)} AS cell_distance
FROM sites LEFT JOIN nearest USING (location, lat, lon)"""

SITE_BASELINE = _with(*GRID, EVENTS, NEAREST) + f""",
baseline AS (
  SELECT n.location, o.hour, {R('avg(o.wind_speed)', 2)} AS hist_wind, {R('avg(o.cloud_base_m)', 2)} AS hist_cloud_base
  FROM nearest n JOIN obs o ON o.latitude = n.cell_latitude AND o.longitude = n.cell_longitude
  WHERE o.month BETWEEN 4 AND 9 GROUP BY n.location, o.hour)
SELECT timestamp, location, lat, lon, wind_speed, cloud_base_m, temp_c, hist_wind, hist_cloud_base, hour,
  wind_vs_historical, cloud_base_vs_historical,
  CASE WHEN wind_vs_historical > 3 THEN 'WORSE_THAN_AVG' WHEN wind_vs_historical < -3 THEN 'BETTER_THAN_AVG'
    ELSE 'AVERAGE' END AS conditions_vs_avg
FROM (
  SELECT s.*, b.hist_wind, b.hist_cloud_base,
    {R("s.wind_speed - b.hist_wind", 2)} AS wind_vs_historical,
    {R("s.cloud_base_m - b.hist_cloud_base", 0)} AS cloud_base_vs_historical
  FROM (SELECT *, CAST(hour(event_time) AS INTEGER) AS hour FROM scored) s
  LEFT JOIN baseline b ON s.hour = b.hour AND s.location = b.location
)"""

OPERATOR_QUERIES |= {
    "d1_cell_ids": CELL_IDS,
    "c7_box": IN_BOX,
    "e9_approx_distinct": APPROX_DISTINCT,
    "q2_from_year_moments": Q2,
    "q5_from_year_moments": Q5,
    "a1_mixed_zone": MIXED_ZONE,
    "s4_nearest_cells": NEAREST_CELLS,
    "s4_site_baseline": SITE_BASELINE,
}

QUERIES.update(OPERATOR_QUERIES)
