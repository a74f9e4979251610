"""DuckDB twins of the registered queries (the correctness oracle).

Each string is self-contained SQL over the driver's pre-registered views. The
lap adapters and the cleaning step are written once here as CTE text and
prefixed to each query; they mirror ``lapstats.sources.adapters`` and
``lapstats.operators.clean`` expression by expression. Doubles are rounded to
6 dp in both engines at the output edge only.
"""

from __future__ import annotations

LAPS_EVENTS = """
ev AS (
  SELECT CAST(year(ts) AS INTEGER) AS season,
         'W' || CAST(CAST(floor((day(ts) - 1) / 6) AS INTEGER) AS VARCHAR) AS race_name,
         'D' || CAST(user_id AS VARCHAR) AS driver,
         'T' || CAST(user_id % 10 AS VARCHAR) AS team,
         user_id, event_id, ts, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ev1 AS (
  SELECT *, 80.0 + value / 19.7 + CASE WHEN event_type = 'purchase' AND k < 10 THEN 60.0 ELSE 0.0 END AS base_time
  FROM ev),
ev2 AS (
  SELECT *,
    row_number() OVER (PARTITION BY season, race_name, driver ORDER BY ts, event_id) AS lap_number,
    CASE WHEN event_type = 'click' AND k = 1 THEN CAST(NULL AS DOUBLE)
         WHEN event_type = 'click' AND k = 2 THEN 0.0 ELSE base_time END AS lap_time,
    CASE WHEN k >= 93 THEN base_time END AS pit_in_time,
    CAST(NULL AS DOUBLE) AS pit_out_time,
    CASE WHEN event_type = 'error' AND k % 3 = 0 THEN '4'
         WHEN event_type = 'view' AND k % 25 = 0 THEN '124'
         WHEN event_type = 'click' AND k = 50 THEN '6'
         WHEN event_type = 'signup' THEN '2' ELSE '1' END AS track_status,
    epoch_us(ts) / 1e6 AS time_s
  FROM ev1),
ev3 AS (
  SELECT *, CAST(1 + coalesce(sum(CASE WHEN pit_in_time IS NOT NULL THEN 1 ELSE 0 END) OVER (
      PARTITION BY season, race_name, driver ORDER BY lap_number
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS stint
  FROM ev2),
ev4 AS (
  SELECT *, ['SOFT', 'MEDIUM', 'HARD'][CAST((stint + user_id) % 3 + 1 AS INTEGER)] AS _cmp,
    row_number() OVER (PARTITION BY season, race_name, driver, stint ORDER BY lap_number) AS _sl
  FROM ev3),
laps AS (
  SELECT season, race_name, driver, team, CAST(lap_number AS INTEGER) AS lap_number, lap_time,
    lap_time * 0.28 + k / 1000.0 AS sector1_time,
    lap_time * 0.38 AS sector2_time,
    CASE WHEN k = 77 THEN CAST(NULL AS DOUBLE) ELSE lap_time * 0.34 - k / 1000.0 END AS sector3_time,
    CASE WHEN k = 97 THEN 'hypersoft' WHEN k % 11 = 0 THEN ' ' || lower(_cmp) || ' ' ELSE _cmp END AS compound,
    CAST(_sl + user_id % 3 AS INTEGER) AS tyre_life, stint,
    CASE WHEN k % 23 = 0 THEN CAST(NULL AS DOUBLE) ELSE 20.0 + floor(value) % 13 END AS air_temp,
    30.0 + floor(value * 7) % 17 AS track_temp,
    CASE WHEN k % 19 = 0 THEN CAST(NULL AS DOUBLE) ELSE 40.0 + floor(value * 3) % 31 END AS humidity,
    pit_in_time, pit_out_time, track_status, false AS is_personal_best, false AS is_simulated, time_s
  FROM ev4)"""

LAPS_LINEITEM = """
li AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS season,
         'H' || CASE WHEN month(l_shipdate) <= 6 THEN '1' ELSE '2' END AS race_name,
         'S' || CAST(l_suppkey AS VARCHAR) AS driver, *
  FROM lineitem),
li1 AS (
  SELECT *,
    80.0 + l_extendedprice / 10000.0 + CASE WHEN l_discount = 0.10 AND l_tax = 0.08 THEN 60.0 ELSE 0.0 END AS lap_time,
    row_number() OVER (PARTITION BY season, race_name, driver ORDER BY l_shipdate, l_orderkey, l_linenumber,
      l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS lap_number
  FROM li),
li2 AS (
  SELECT *,
    CASE WHEN l_discount = 0.0 AND l_tax < 0.02 THEN lap_time END AS pit_in_time,
    CAST(NULL AS DOUBLE) AS pit_out_time,
    CASE WHEN l_tax = 0.08 AND l_linestatus = 'F' THEN '4'
         WHEN l_tax = 0.07 AND l_linestatus = 'O' THEN '6'
         WHEN l_tax = 0.01 THEN '2' ELSE '1' END AS track_status
  FROM li1),
li3 AS (
  SELECT *, CAST(1 + coalesce(sum(CASE WHEN pit_in_time IS NOT NULL THEN 1 ELSE 0 END) OVER (
      PARTITION BY season, race_name, driver ORDER BY lap_number
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS stint
  FROM li2),
teams AS (
  SELECT s_suppkey, n_name AS team FROM supplier JOIN nation ON s_nationkey = n_nationkey),
laps AS (
  SELECT season, race_name, driver, team, CAST(lap_number AS INTEGER) AS lap_number, lap_time,
    lap_time * 0.30 AS sector1_time, lap_time * 0.35 + l_discount AS sector2_time,
    lap_time * 0.35 - l_discount AS sector3_time,
    CASE WHEN l_returnflag = 'A' THEN 'SOFT' WHEN l_returnflag = 'N' THEN 'MEDIUM' ELSE 'HARD' END AS compound,
    CAST(l_quantity AS INTEGER) AS tyre_life, stint,
    CAST(20 + l_linenumber AS DOUBLE) AS air_temp, CAST(30 + l_partkey % 20 AS DOUBLE) AS track_temp,
    CAST(40 + l_orderkey % 30 AS DOUBLE) AS humidity,
    pit_in_time, pit_out_time, track_status, false AS is_personal_best, false AS is_simulated
  FROM li3 LEFT JOIN teams ON l_suppkey = s_suppkey)"""

CLEAN = """
kept AS (
  SELECT *, coalesce(regexp_matches(track_status, '[46]'), false) AS is_sc_lap,
    coalesce(CASE track_status WHEN '1' THEN 'Green' WHEN '2' THEN 'Yellow' WHEN '3' THEN 'Yellow'
      WHEN '4' THEN 'SafetyCar' WHEN '5' THEN 'RedFlag' WHEN '6' THEN 'VSC' END, 'Unknown') AS track_status_label
  FROM laps WHERE lap_time IS NOT NULL AND lap_time > 0),
med AS (
  SELECT season, race_name, median(lap_time) AS _med_lap, median(air_temp) AS _med_air,
    median(track_temp) AS _med_track, median(humidity) AS _med_hum
  FROM kept GROUP BY season, race_name),
tagged AS (
  SELECT kept.*, (lap_time > _med_lap * 1.5 OR pit_in_time IS NOT NULL OR pit_out_time IS NOT NULL) AS is_pit_lap,
    _med_air, _med_track, _med_hum
  FROM kept LEFT JOIN med USING (season, race_name)),
band AS (
  SELECT season, race_name, count(*) AS _n_norm, avg(lap_time) AS _mu, stddev_samp(lap_time) AS _sd
  FROM tagged WHERE NOT is_pit_lap AND NOT is_sc_lap GROUP BY season, race_name),
cl AS (
  SELECT tagged.* REPLACE (
      coalesce(air_temp, _med_air) AS air_temp, coalesce(track_temp, _med_track) AS track_temp,
      coalesce(humidity, _med_hum) AS humidity,
      CASE WHEN upper(trim(compound)) IN ('SOFT', 'MEDIUM', 'HARD', 'INTERMEDIATE', 'WET')
           THEN upper(trim(compound)) ELSE 'UNKNOWN' END AS compound,
      coalesce(team, 'Unknown') AS team),
    coalesce(_n_norm >= 10 AND (lap_time < _mu - 3.0 * _sd OR lap_time > _mu + 3.0 * _sd), false) AS is_outlier
  FROM tagged LEFT JOIN band USING (season, race_name)),
clean AS (SELECT * EXCLUDE (_med_air, _med_track, _med_hum) FROM cl),
ca AS (SELECT * FROM clean WHERE NOT is_pit_lap AND NOT is_sc_lap AND NOT is_outlier)"""


def with_laps(body: str, source: str = "events") -> str:
    base = LAPS_EVENTS if source == "events" else LAPS_LINEITEM
    return "WITH " + base.strip() + ",\n" + CLEAN.strip() + body


def _q(source: str, ctes: str, select: str) -> str:
    extra = ("," + ctes.strip()) if ctes.strip() else ""
    return with_laps(extra + "\n" + select.strip(), source)


def fin(rel: str, doubles: tuple[str, ...] = (), ints: tuple[str, ...] = ()) -> str:
    """Output edge: round doubles to 6 dp and widen integers to BIGINT."""
    reps = [f"round(round({c}, 10), 6) AS {c}" for c in doubles] + [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    rep = f" REPLACE ({', '.join(reps)})" if reps else ""
    return f"SELECT *{rep} FROM (\n{rel.strip()}\n) AS _r"


ORACLE: dict[str, str] = {}


def _stability(source: str) -> str:
    return _q(source, """
st AS (
  SELECT season, race_name, driver, avg(lap_time) AS avg_lap_time, min(lap_time) AS best_lap_time,
    coalesce(stddev_samp(lap_time), 0.0) AS lap_time_std, count(*) AS lap_count
  FROM ca GROUP BY season, race_name, driver),
tm AS (
  SELECT season, race_name, driver, arg_min(team, lap_number) FILTER (WHERE team IS NOT NULL) AS team
  FROM clean GROUP BY season, race_name, driver)""", fin("""
  SELECT st.*, 1.0 / (1.0 + lap_time_std) AS consistency_score, tm.team,
    row_number() OVER (PARTITION BY season, race_name ORDER BY 1.0 / (1.0 + lap_time_std) DESC, driver) AS stability_rank
  FROM st LEFT JOIN tm USING (season, race_name, driver)""",
        doubles=("avg_lap_time", "best_lap_time", "lap_time_std", "consistency_score"),
        ints=("season", "lap_count", "stability_rank")))


ORACLE["driver_stability"] = _stability("events")
ORACLE["driver_stability_bulk"] = _stability("lineitem")


def nn(expr: str) -> str:
    """DuckDB gives NaN where Spark gives NULL (e.g. regr_slope on constant x)."""
    return f"(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END)"


K = "season, race_name"
KD = "season, race_name, driver"

# Brute-force range join (the definition of W3): non-outlier laps within 3 laps of a pit lap.
PIT_WINDOWS = """
pits AS (SELECT season, race_name, driver, lap_number FROM clean WHERE is_pit_lap),
pw AS (
  SELECT p.season, p.race_name, p.driver, p.lap_number,
    avg(CASE WHEN l.lap_number < p.lap_number THEN l.lap_time END) AS before_avg,
    avg(CASE WHEN l.lap_number > p.lap_number THEN l.lap_time END) AS after_avg
  FROM pits p LEFT JOIN clean l
    ON l.season = p.season AND l.race_name = p.race_name AND l.driver = p.driver AND NOT l.is_outlier
   AND l.lap_number BETWEEN p.lap_number - 3 AND p.lap_number + 3 AND l.lap_number <> p.lap_number
  GROUP BY p.season, p.race_name, p.driver, p.lap_number),
pd AS (
  SELECT season, race_name, driver, lap_number AS pit_lap, round(before_avg, 3) AS before_avg,
    round(after_avg, 3) AS after_avg, round(before_avg - after_avg, 3) AS impact
  FROM pw WHERE before_avg IS NOT NULL AND after_avg IS NOT NULL)"""

DRIVER_FEATURES = PIT_WINDOWS + """,
drv AS (SELECT DISTINCT season, race_name, driver FROM clean),
ds AS (
  SELECT season, race_name, driver, avg(lap_time) AS average_lap_time, min(lap_time) AS best_lap_time,
    coalesce(stddev_samp(lap_time), 0.0) AS lap_time_std
  FROM ca GROUP BY season, race_name, driver),
rm AS (SELECT season, race_name, avg(lap_time) AS _race_mean FROM clean GROUP BY season, race_name),
pimp AS (
  SELECT season, race_name, driver, avg(before_avg - after_avg) AS _imp
  FROM pw WHERE before_avg IS NOT NULL AND after_avg IS NOT NULL GROUP BY season, race_name, driver),
scs AS (
  SELECT season, race_name, driver, stddev_samp(sector1_time) AS s1, stddev_samp(sector2_time) AS s2,
    stddev_samp(sector3_time) AS s3
  FROM clean GROUP BY season, race_name, driver),
df AS (
  SELECT drv.season, drv.race_name, drv.driver, average_lap_time, best_lap_time, lap_time_std,
    1.0 / (1.0 + lap_time_std) AS consistency_score, average_lap_time AS average_race_pace,
    CASE WHEN _race_mean > 0 THEN average_lap_time - _race_mean ELSE 0.0 END AS relative_pace,
    coalesce(_imp, 0.0) AS pit_stop_impact,
    CASE WHEN (s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT > 0
      THEN (coalesce(s1, 0.0) + coalesce(s2, 0.0) + coalesce(s3, 0.0))
           / ((s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT) END AS sector_consistency
  FROM drv LEFT JOIN ds USING (season, race_name, driver) LEFT JOIN rm USING (season, race_name)
    LEFT JOIN pimp USING (season, race_name, driver) LEFT JOIN scs USING (season, race_name, driver))"""

DEGRADATION = """
deg AS (
  SELECT season, race_name, driver, compound,
    CASE WHEN count(*) >= 3 AND count(us) >= 2 AND count(us) * sum(x * x) - sum(x) * sum(x) > 0
      THEN CAST(count(us) * sum(x * us) - sum(x) * sum(us) AS DOUBLE)
           / CAST(count(us) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) / 1e6 END AS tire_degradation_rate
  FROM (SELECT season, race_name, driver, compound, CASE WHEN lap_time IS NOT NULL THEN CAST(tyre_life AS BIGINT) END AS x,
          CASE WHEN tyre_life IS NOT NULL THEN CAST(round(lap_time * 1e6) AS BIGINT) END AS us
        FROM clean WHERE NOT is_pit_lap) GROUP BY season, race_name, driver, compound)"""

COMPOUNDS_ALL = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "UNKNOWN")
MATRIX_NUM = ("average_lap_time", "best_lap_time", "lap_time_std", "consistency_score", "average_race_pace",
              "tire_degradation_rate", "pit_stop_impact", "sector_consistency", "air_temp", "track_temp") + tuple(
    f"degradation_{c.lower()}" for c in COMPOUNDS_ALL) + ("avg_air_temp",)

MATRIX = DRIVER_FEATURES + "," + DEGRADATION + """,
fu AS (SELECT season, race_name, driver, compound, min(lap_number) AS _first_lap FROM clean
       GROUP BY season, race_name, driver, compound),
dc AS (SELECT fu.*, deg.tire_degradation_rate FROM fu LEFT JOIN deg USING (season, race_name, driver, compound)),
fd AS (
  SELECT season, race_name, driver,
    first(tire_degradation_rate ORDER BY _first_lap, compound) FILTER (WHERE tire_degradation_rate IS NOT NULL)
      AS tire_degradation_rate,
""" + ",\n".join(
    f"    CASE WHEN bool_or(compound = '{c}') THEN max(CASE WHEN compound = '{c}' THEN tire_degradation_rate END)"
    f" ELSE 0.0 END AS degradation_{c.lower()}" for c in COMPOUNDS_ALL) + """
  FROM dc GROUP BY season, race_name, driver),
tp AS (
  SELECT season, race_name, driver,
    first(air_temp ORDER BY lap_number, lap_time) FILTER (WHERE air_temp IS NOT NULL) AS air_temp,
    first(track_temp ORDER BY lap_number, lap_time) FILTER (WHERE track_temp IS NOT NULL) AS track_temp,
    avg(air_temp) AS avg_air_temp
  FROM clean GROUP BY season, race_name, driver),
m0 AS (
  SELECT df.season, df.race_name, df.driver, """ + ", ".join(MATRIX_NUM) + """
  FROM df LEFT JOIN fd USING (season, race_name, driver) LEFT JOIN tp USING (season, race_name, driver)),
mm AS (SELECT season, race_name, """ + ", ".join(f"median({c}) AS _m_{c}" for c in MATRIX_NUM) + """
  FROM m0 GROUP BY season, race_name),
matrix AS (
  SELECT season, race_name, driver, """ + ", ".join(f"coalesce({c}, _m_{c}) AS {c}" for c in MATRIX_NUM) + """
  FROM m0 LEFT JOIN mm USING (season, race_name))"""

TARGET = MATRIX + """,
tmed AS (SELECT season, race_name, median(average_lap_time) AS _ma, median(consistency_score) AS _mc
  FROM matrix GROUP BY season, race_name),
t0 AS (SELECT matrix.*, coalesce(CAST(average_lap_time <= _ma AND consistency_score >= _mc AS INTEGER), 0) AS _t
  FROM matrix LEFT JOIN tmed USING (season, race_name)),
tc AS (SELECT season, race_name, min(_t) AS _lo, max(_t) AS _hi,
    first(driver ORDER BY average_lap_time, driver) AS _fastest FROM t0 GROUP BY season, race_name),
target AS (
  SELECT t0.* EXCLUDE (_t), CASE WHEN _lo = _hi THEN CAST(driver = _fastest AS INTEGER) ELSE _t END AS strong_performance
  FROM t0 LEFT JOIN tc USING (season, race_name))"""

DF_DOUBLES = ("average_lap_time", "best_lap_time", "lap_time_std", "consistency_score", "average_race_pace",
              "relative_pace", "pit_stop_impact", "sector_consistency")

ORACLE["clean_laps"] = _q("events", "", fin("""
  SELECT season, race_name, driver, lap_number, lap_time, compound, team, track_status_label,
    is_sc_lap, is_pit_lap, is_outlier, air_temp, track_temp, humidity FROM clean""",
    doubles=("lap_time", "air_temp", "track_temp", "humidity"), ints=("season", "lap_number")))

ORACLE["lap_features"] = _q("events", """
mmx AS (SELECT season, race_name, min(track_temp) AS _mn, max(track_temp) AS _mx FROM clean GROUP BY season, race_name)""",
    fin("""
  SELECT season, race_name, driver, lap_number,
    CASE WHEN stint IS NOT NULL THEN row_number() OVER (PARTITION BY season, race_name, driver, stint
      ORDER BY lap_number, lap_time) END AS stint_lap,
    coalesce(sector1_time, 0.0) + coalesce(sector2_time, 0.0) + coalesce(sector3_time, 0.0) AS sector_sum,
    CASE WHEN _mx > _mn THEN (track_temp - _mn) / (_mx - _mn) ELSE 0.5 END AS norm_track_temp
  FROM clean LEFT JOIN mmx USING (season, race_name)""",
        doubles=("sector_sum", "norm_track_temp"), ints=("season", "lap_number", "stint_lap")))

ORACLE["pit_stop_details"] = _q("events", PIT_WINDOWS, fin(
    "SELECT * FROM pd", doubles=("before_avg", "after_avg", "impact"), ints=("season", "pit_lap")))

ORACLE["pit_stop_analysis"] = _q("events", PIT_WINDOWS + """,
pdd AS (SELECT season, race_name, driver, count(*) AS pit_count,
    round(sum(CAST(round(impact * 1000) AS BIGINT)) / count(*)) / 1000 AS avg_impact
  FROM pd GROUP BY season, race_name, driver),
pr AS (SELECT season, race_name,
    round(sum(CAST(round(avg_impact * 1000) AS BIGINT)) FILTER (WHERE avg_impact <> 0)
      / count(*) FILTER (WHERE avg_impact <> 0)) / 1000 AS race_avg_impact,
    sum(pit_count) AS race_pit_total FROM pdd GROUP BY season, race_name)""", fin(
    "SELECT * FROM pdd LEFT JOIN pr USING (season, race_name)",
    doubles=("avg_impact", "race_avg_impact"), ints=("season", "pit_count", "race_pit_total")))

ORACLE["pit_driver_means"] = _q("events", PIT_WINDOWS, fin("""
  SELECT season, race_name, driver, avg(before_avg) AS before_mean, avg(after_avg) AS after_mean,
    avg(impact) AS impact_mean FROM pd GROUP BY season, race_name, driver""",
    doubles=("before_mean", "after_mean", "impact_mean"), ints=("season",)))

ORACLE["driver_features"] = _q("events", DRIVER_FEATURES, fin("SELECT * FROM df", doubles=DF_DOUBLES, ints=("season",)))
ORACLE["driver_features_bulk"] = _q("lineitem", DRIVER_FEATURES, fin(
    "SELECT * FROM df", doubles=DF_DOUBLES, ints=("season",)))

ORACLE["degradation_rates"] = _q("lineitem", DEGRADATION, fin(
    "SELECT * FROM deg", doubles=("tire_degradation_rate",), ints=("season",)))

ORACLE["tire_efficiency"] = _q("events", """
cp AS (SELECT season, race_name, compound, sum(lap_time) AS _s, count(lap_time) AS _n FROM clean
  WHERE NOT is_pit_lap GROUP BY season, race_name, compound),
ov AS (SELECT season, race_name, sum(_s) / sum(_n) AS _overall FROM cp GROUP BY season, race_name),
used AS (SELECT DISTINCT season, race_name, compound FROM clean)""", fin("""
  SELECT season, race_name, compound,
    CASE WHEN _overall > 0 AND _n IS NOT NULL THEN (_overall - _s / _n) / _overall ELSE 0.0 END AS tire_efficiency_score
  FROM used LEFT JOIN cp USING (season, race_name, compound) LEFT JOIN ov USING (season, race_name)""",
    doubles=("tire_efficiency_score",), ints=("season",)))

ORACLE["driver_matrix"] = _q("events", MATRIX, fin("SELECT * FROM matrix", doubles=MATRIX_NUM, ints=("season",)))
ORACLE["driver_matrix_bulk"] = _q("lineitem", MATRIX, fin(
    "SELECT * FROM matrix", doubles=MATRIX_NUM, ints=("season",)))
ORACLE["strong_performance"] = _q("events", TARGET, fin(
    "SELECT season, race_name, driver, average_lap_time, consistency_score, strong_performance FROM target",
    doubles=("average_lap_time", "consistency_score"), ints=("season", "strong_performance")))

ORACLE["fast_only"] = _q("events", MATRIX + """,
fm AS (SELECT season, race_name, median(average_lap_time) AS _ma FROM matrix GROUP BY season, race_name)""", fin("""
  SELECT season, race_name, driver, average_lap_time, coalesce(CAST(average_lap_time <= _ma AS INTEGER), 0) AS fast_only
  FROM matrix JOIN fm USING (season, race_name)""", doubles=("average_lap_time",), ints=("season", "fast_only")))

ORACLE["compound_stats"] = _q("events", """
cs AS (SELECT season, race_name, compound, avg(lap_time) AS avg_lap_time, min(lap_time) AS best_lap_time,
    stddev_samp(lap_time) AS std, count(*) AS count FROM ca GROUP BY season, race_name, compound),
cb AS (SELECT season, race_name, first(compound ORDER BY avg_lap_time, compound) AS _best FROM cs
  GROUP BY season, race_name)""", fin("""
  SELECT cs.*, compound = _best AS is_best FROM cs JOIN cb USING (season, race_name)""",
    doubles=("avg_lap_time", "best_lap_time", "std"), ints=("season", "count")))

ORACLE["tyre_age_curve"] = _q("events", """
big AS (SELECT season, race_name, compound FROM ca GROUP BY season, race_name, compound HAVING count(*) > 5)""", fin("""
  SELECT season, race_name, compound, tyre_life, avg(lap_time) AS avg_lap_time FROM ca
  WHERE tyre_life IS NOT NULL AND (season, race_name, compound) IN (SELECT (season, race_name, compound) FROM big)
  GROUP BY season, race_name, compound, tyre_life""",
    doubles=("avg_lap_time",), ints=("season", "tyre_life")))

ORACLE["strategy_map"] = _q("events", "", fin("""
  SELECT season, race_name, driver, stint, first(compound ORDER BY lap_number, lap_time) AS compound,
    count(lap_number) AS laps, avg(lap_time) AS avg_time
  FROM clean WHERE stint IS NOT NULL GROUP BY season, race_name, driver, stint""",
    doubles=("avg_time",), ints=("season", "stint", "laps")))

CURVE = """
cnt AS (SELECT season, race_name, compound FROM ca GROUP BY season, race_name, compound HAVING count(*) >= 5),
pa AS (SELECT season, race_name, compound, tyre_life, avg(lap_time) AS _m FROM ca
  WHERE tyre_life IS NOT NULL AND (season, race_name, compound) IN (SELECT (season, race_name, compound) FROM cnt)
  GROUP BY season, race_name, compound, tyre_life),
fit0 AS (SELECT season, race_name, compound, count(*) AS n_ages, """ + nn("regr_slope(_m, tyre_life)") + """ AS _slope,
    """ + nn("regr_r2(_m, tyre_life)") + """ AS _r2, """ + nn("regr_intercept(_m, tyre_life)") + """ AS _icpt
  FROM pa GROUP BY season, race_name, compound),
fit AS (SELECT cnt.season, cnt.race_name, cnt.compound, n_ages,
    CASE WHEN n_ages >= 3 THEN _slope END AS degradation_rate, CASE WHEN n_ages >= 3 THEN _icpt END AS intercept,
    CASE WHEN n_ages >= 3 THEN _r2 END AS r_squared
  FROM cnt LEFT JOIN fit0 USING (season, race_name, compound)),
wst AS (SELECT season, race_name, first(compound ORDER BY degradation_rate DESC, compound DESC)
    FILTER (WHERE degradation_rate IS NOT NULL) AS _worst FROM fit GROUP BY season, race_name)"""

ORACLE["degradation_curve"] = _q("lineitem", CURVE, fin("""
  SELECT fit.*, coalesce(compound = _worst, false) AS is_worst FROM fit LEFT JOIN wst USING (season, race_name)""",
    doubles=("degradation_rate", "intercept", "r_squared"), ints=("season", "n_ages")))

ORACLE["degradation_ages"] = _q("lineitem", """
enough AS (SELECT season, race_name, compound FROM ca GROUP BY season, race_name, compound HAVING count(*) >= 5)""", fin("""
  SELECT season, race_name, compound, tyre_life, avg(lap_time) AS mean, stddev_samp(lap_time) AS std, count(*) AS count
  FROM ca SEMI JOIN enough USING (season, race_name, compound) WHERE tyre_life IS NOT NULL
  GROUP BY season, race_name, compound, tyre_life""", doubles=("mean", "std"), ints=("season", "tyre_life", "count")))

ORACLE["race_overview"] = _q("events", """
st AS (SELECT season, race_name, driver, coalesce(stddev_samp(lap_time), 0.0) AS _sd FROM ca
  GROUP BY season, race_name, driver),
ms AS (SELECT season, race_name, first(driver ORDER BY 1.0 / (1.0 + _sd) DESC, driver) AS most_stable_driver
  FROM st GROUP BY season, race_name),
fl AS (SELECT season, race_name, min(lap_time) AS fastest_lap,
    first(driver ORDER BY lap_time, lap_number, driver) AS fastest_driver FROM ca GROUP BY season, race_name),
base AS (SELECT season, race_name, count(*) AS total_laps, count(DISTINCT driver) AS total_drivers,
    avg(air_temp) AS avg_air_temp, avg(track_temp) AS avg_track_temp FROM clean GROUP BY season, race_name)""", fin("""
  SELECT * FROM base LEFT JOIN fl USING (season, race_name) LEFT JOIN ms USING (season, race_name)""",
    doubles=("avg_air_temp", "avg_track_temp", "fastest_lap"), ints=("season", "total_laps", "total_drivers")))

ORACLE["compound_usage"] = _q("events", "", fin(
    "SELECT season, race_name, compound, count(*) AS laps FROM clean GROUP BY season, race_name, compound",
    ints=("season", "laps")))

PROFILES = DRIVER_FEATURES + "," + DEGRADATION + """,
lf AS (SELECT clean.*, deg.tire_degradation_rate, df.pit_stop_impact FROM clean
  LEFT JOIN deg USING (season, race_name, driver, compound) LEFT JOIN df USING (season, race_name, driver)),
pc AS (SELECT season, race_name, driver, round(avg(lap_time), 3) AS avg_lap_time, round(min(lap_time), 3) AS best_lap_time,
    round(stddev_samp(lap_time), 3) AS lap_time_std, count(*) AS lap_count,
    round(avg(sector1_time), 3) AS sector1_mean, round(avg(sector2_time), 3) AS sector2_mean,
    round(avg(sector3_time), 3) AS sector3_mean
  FROM lf WHERE NOT is_pit_lap AND NOT is_sc_lap AND NOT is_outlier GROUP BY season, race_name, driver),
fc AS (SELECT season, race_name, driver, compound, min(lap_number) AS _first FROM lf
  GROUP BY season, race_name, driver, compound),
cu AS (SELECT season, race_name, driver, string_agg(compound, ',' ORDER BY _first, compound) AS compounds_used
  FROM fc GROUP BY season, race_name, driver),
al AS (SELECT season, race_name, driver, round(avg(tire_degradation_rate), 4) AS tire_degradation,
    round(avg(pit_stop_impact), 3) AS pit_impact FROM lf GROUP BY season, race_name, driver),
prof AS (SELECT al.*, pc.* EXCLUDE (season, race_name, driver), round(1.0 / (1.0 + pc.lap_time_std), 4) AS consistency,
    cu.compounds_used
  FROM al LEFT JOIN pc USING (season, race_name, driver) LEFT JOIN cu USING (season, race_name, driver))"""
PROF_DOUBLES = ("avg_lap_time", "best_lap_time", "lap_time_std", "sector1_mean", "sector2_mean", "sector3_mean",
                "tire_degradation", "pit_impact", "consistency")

ORACLE["driver_profiles"] = _q("events", PROFILES, fin(
    "SELECT * FROM prof", doubles=PROF_DOUBLES, ints=("season", "lap_count")))

ORACLE["driver_vs_leader"] = _q("events", PROFILES + """,
lst AS (SELECT season, race_name, driver, coalesce(stddev_samp(lap_time), 0.0) AS _sd FROM ca
  GROUP BY season, race_name, driver),
ldr AS (SELECT season, race_name, first(driver ORDER BY 1.0 / (1.0 + _sd) DESC, driver) AS _leader
  FROM lst GROUP BY season, race_name)""", fin("""
  SELECT a.season, a.race_name, a.driver AS driver1, b.driver AS driver2,
    a.avg_lap_time - b.avg_lap_time AS avg_lap_delta, a.best_lap_time - b.best_lap_time AS best_lap_delta,
    CASE WHEN coalesce(a.avg_lap_time, 999.0) < coalesce(b.avg_lap_time, 999.0) THEN a.driver ELSE b.driver END
      AS faster_driver,
    CASE WHEN coalesce(a.consistency, 0.0) > coalesce(b.consistency, 0.0) THEN a.driver ELSE b.driver END
      AS more_stable_driver,
    CASE WHEN a.tire_degradation <> 0 AND b.tire_degradation <> 0 THEN
      CASE WHEN a.tire_degradation < b.tire_degradation THEN a.driver ELSE b.driver END END AS lower_degradation_driver
  FROM prof a JOIN ldr ON a.season = ldr.season AND a.race_name = ldr.race_name AND a.driver <> ldr._leader
  JOIN prof b ON b.season = a.season AND b.race_name = a.race_name AND b.driver = ldr._leader""",
    doubles=("avg_lap_delta", "best_lap_delta"), ints=("season",)))

ORACLE["fastest_sector_drivers"] = _q("events", """
sl AS (SELECT season, race_name, driver, 'sector1' AS sector, sector1_time AS t FROM ca
  UNION ALL SELECT season, race_name, driver, 'sector2', sector2_time FROM ca
  UNION ALL SELECT season, race_name, driver, 'sector3', sector3_time FROM ca),
sm AS (SELECT season, race_name, sector, driver, avg(t) AS mean_time FROM sl GROUP BY season, race_name, sector, driver)""",
    fin("""
  SELECT season, race_name, sector, first(driver ORDER BY mean_time, driver) AS driver, min(mean_time) AS mean_time
  FROM sm WHERE mean_time IS NOT NULL GROUP BY season, race_name, sector""", doubles=("mean_time",), ints=("season",)))

ORACLE["fastest_lap_per_driver"] = _q("events", "", fin("""
  SELECT season, race_name, driver, first(lap_number ORDER BY lap_time, lap_number) AS lap_number,
    min(lap_time) AS lap_time, first(compound ORDER BY lap_time, lap_number) AS compound
  FROM clean GROUP BY season, race_name, driver""", doubles=("lap_time",), ints=("season", "lap_number")))

RAW_COLUMNS = ("driver", "team", "lap_number", "lap_time", "sector1_time", "sector2_time", "sector3_time", "compound",
               "tyre_life", "stint", "air_temp", "track_temp", "humidity", "pit_in_time", "pit_out_time",
               "track_status", "is_personal_best", "is_simulated")
LAP_CORR = ("lap_time", "tyre_life", "air_temp", "track_temp", "humidity", "consistency_score",
            "tire_degradation_rate", "sector1_time", "sector2_time", "sector3_time")


def safe_corr_sql(a: str, b: str) -> str:
    f = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    sa, sb = f"stddev_samp({a}) {f}", f"stddev_samp({b}) {f}"
    return (f"CASE WHEN {sa} > abs(avg({a}) {f}) * 1e-9 AND {sb} > abs(avg({b}) {f}) * 1e-9 THEN "
            f"least(1.0, greatest(-1.0, covar_samp({a}, {b}) {f} / ({sa} * {sb}))) END")


def corr_long(table: str, cols: tuple[str, ...]) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    parts = [f"SELECT season, race_name, '{a}' AS feature_1, '{b}' AS feature_2, {safe_corr_sql(a, b)} AS r "
             f"FROM {table} GROUP BY season, race_name" for a, b in pairs]
    return "\nUNION ALL ".join(parts)


ORACLE["basic_summary"] = _q("events", "", fin("""
  SELECT season, race_name, count(*) AS total_rows, 24 AS total_cols, count(DISTINCT driver) AS drivers,
    avg(lap_time) AS avg_lap_time, min(lap_time) AS min_lap_time, max(lap_time) AS max_lap_time,
    stddev_samp(lap_time) AS std_lap_time, avg(air_temp) AS avg_air_temp, avg(track_temp) AS avg_track_temp,
    count(*) FILTER (WHERE is_pit_lap) AS pit_laps, count(*) FILTER (WHERE is_sc_lap) AS sc_laps,
    count(*) FILTER (WHERE is_outlier) AS outliers
  FROM clean GROUP BY season, race_name""",
    doubles=("avg_lap_time", "min_lap_time", "max_lap_time", "std_lap_time", "avg_air_temp", "avg_track_temp"),
    ints=("season", "total_rows", "total_cols", "drivers", "pit_laps", "sc_laps", "outliers")))

ORACLE["missing_values"] = _q("events", """
mv AS (""" + "\nUNION ALL ".join(
    f"SELECT season, race_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS _n "
    f"FROM laps GROUP BY season, race_name" for c in RAW_COLUMNS) + ")", fin("""
  SELECT season, race_name, column_name, missing, round(100.0 * missing / _n, 2) AS percent FROM mv WHERE missing > 0""",
    doubles=("percent",), ints=("season", "missing")))

ORACLE["laps_per_driver"] = _q("events", "", fin(
    "SELECT season, race_name, driver, count(*) AS laps FROM clean GROUP BY season, race_name, driver",
    ints=("season", "laps")))

ORACLE["lap_time_distribution"] = _q("events", "", fin("""
  SELECT season, race_name, avg(lap_time) AS mean, stddev_samp(lap_time) AS std, min(lap_time) AS min,
    max(lap_time) AS max, quantile_cont(lap_time, 0.25) AS q25, median(lap_time) AS median,
    quantile_cont(lap_time, 0.75) AS q75
  FROM clean WHERE NOT is_pit_lap AND NOT is_outlier AND lap_time IS NOT NULL GROUP BY season, race_name""",
    doubles=("mean", "std", "min", "max", "q25", "median", "q75"), ints=("season",)))

ORACLE["lap_time_histogram"] = _q("events", """
cb AS (SELECT * FROM clean WHERE NOT is_pit_lap AND NOT is_outlier AND lap_time IS NOT NULL),
rg AS (SELECT season, race_name, min(lap_time) AS _mn, max(lap_time) AS _mx FROM cb GROUP BY season, race_name),
hb AS (SELECT season, race_name, _mn, _mx,
    CAST(CASE WHEN _mx > _mn THEN least(floor((lap_time - _mn) / (_mx - _mn) * 40), 39) ELSE 0 END AS INTEGER) AS bin
  FROM cb JOIN rg USING (season, race_name)),
hc AS (SELECT season, race_name, bin, count(*) AS c FROM hb GROUP BY season, race_name, bin),
bn AS (SELECT *, unnest(range(0, CASE WHEN _mx > _mn THEN 40 ELSE 1 END)) AS bin FROM rg)""", fin("""
  SELECT season, race_name, bin, _mn + (_mx - _mn) * bin / 40 AS bin_start, coalesce(c, 0) AS count
  FROM bn LEFT JOIN hc USING (season, race_name, bin)""", doubles=("bin_start",), ints=("season", "bin", "count")))

ORACLE["temperature_summary"] = _q("events", """
tl AS (SELECT season, race_name, 'air_temp' AS variable, air_temp AS v FROM clean
  UNION ALL SELECT season, race_name, 'track_temp', track_temp FROM clean)""", fin("""
  SELECT season, race_name, variable, avg(v) AS mean, min(v) AS min, max(v) AS max, stddev_samp(v) AS std
  FROM tl GROUP BY season, race_name, variable""", doubles=("mean", "min", "max", "std"), ints=("season",)))

LAP_CORR_CTE = DRIVER_FEATURES + "," + DEGRADATION + """,
lfc AS (SELECT clean.*, deg.tire_degradation_rate, df.consistency_score FROM clean
  LEFT JOIN deg USING (season, race_name, driver, compound) LEFT JOIN df USING (season, race_name, driver)),
lc AS (""" + corr_long("lfc", LAP_CORR) + ")"

ORACLE["lap_correlations"] = _q("events", LAP_CORR_CTE, fin("SELECT * FROM lc", doubles=("r",), ints=("season",)))

ORACLE["lap_time_correlations"] = _q("events", LAP_CORR_CTE + """,
lr AS (SELECT season, race_name, CASE WHEN feature_1 = 'lap_time' THEN feature_2 ELSE feature_1 END AS feature,
    abs(r) AS abs_r FROM lc WHERE (feature_1 = 'lap_time' OR feature_2 = 'lap_time') AND r IS NOT NULL)""", fin("""
  SELECT *, row_number() OVER (PARTITION BY season, race_name ORDER BY abs_r DESC, feature) AS rank FROM lr""",
    doubles=("abs_r",), ints=("season", "rank")))

FEAT_CORR_CTE = MATRIX + """,
fcx AS (""" + corr_long("matrix", MATRIX_NUM) + ")"

ORACLE["feature_correlations"] = _q("lineitem", FEAT_CORR_CTE, fin(
    "SELECT * FROM fcx", doubles=("r",), ints=("season",)))

ORACLE["high_correlation_pairs"] = _q("lineitem", FEAT_CORR_CTE, fin(
    "SELECT season, race_name, feature_1, feature_2, round(abs(r), 4) AS correlation FROM fcx WHERE abs(r) > 0.7",
    doubles=("correlation",), ints=("season",)))

ORACLE["preprocessing_summary"] = _q("events", "", fin("""
  SELECT season, race_name, count(*) AS rows, count(DISTINCT driver) AS drivers,
    sum(""" + " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in RAW_COLUMNS) + """) AS missing_cells,
    """ + ", ".join(f"count(*) FILTER (WHERE compound = '{c}') AS {c.lower()}_laps" for c in COMPOUNDS_ALL) + """,
    count(*) FILTER (WHERE is_pit_lap) AS pit_laps, count(*) FILTER (WHERE is_sc_lap) AS sc_laps,
    count(*) FILTER (WHERE is_outlier) AS outliers, avg(lap_time) AS avg_lap_time, min(lap_time) AS min_lap_time,
    max(lap_time) AS max_lap_time
  FROM clean GROUP BY season, race_name""",
    doubles=("avg_lap_time", "min_lap_time", "max_lap_time"),
    ints=("season", "rows", "drivers", "missing_cells", "pit_laps", "sc_laps", "outliers",
          *[f"{c.lower()}_laps" for c in COMPOUNDS_ALL])))

ORACLE["temperature_trend"] = _q("events", """
cbt AS (SELECT * FROM clean WHERE NOT is_pit_lap AND NOT is_outlier),
tt AS (SELECT season, race_name, 'air_temp' AS variable, air_temp AS x, lap_time FROM cbt
  UNION ALL SELECT season, race_name, 'track_temp', track_temp, lap_time FROM cbt)""", fin("""
  SELECT * FROM (SELECT season, race_name, variable, regr_count(lap_time, x) AS n, """ + nn("regr_slope(lap_time, x)") +
    """ AS slope, """ + nn("regr_intercept(lap_time, x)") + """ AS intercept
  FROM tt GROUP BY season, race_name, variable) WHERE n > 5""",
    doubles=("slope", "intercept"), ints=("season", "n")))

MODEL_FEATURES = ("average_lap_time", "consistency_score", "tire_degradation_rate", "pit_stop_impact",
                  "sector_consistency")



def _model_input(features: tuple[str, ...]) -> str:
    return TARGET + """,
mi AS (
  SELECT season, race_name, driver, strong_performance AS label, """ + ",\n    ".join(
        f"coalesce(CASE WHEN stddev_pop({f}) OVER w > 0 THEN ({f} - avg({f}) OVER w) / stddev_pop({f}) OVER w END, 0.0)"
        f" AS {f}" for f in features) + """
  FROM target WINDOW w AS (PARTITION BY season, race_name))"""


FOLDS = _model_input(MODEL_FEATURES) + """,
cls AS (SELECT season, race_name, label, count(*) AS c FROM mi GROUP BY season, race_name, label),
nf AS (SELECT season, race_name, greatest(2, least(5, min(c))) AS n_folds FROM cls GROUP BY season, race_name),
fo AS (
  SELECT mi.*, n_folds, CAST((row_number() OVER (PARTITION BY season, race_name, label
      ORDER BY md5(concat_ws('|', '42', CAST(season AS VARCHAR), race_name, driver)), driver) - 1) % n_folds AS INTEGER) AS fold
  FROM mi JOIN nf USING (season, race_name))"""

ORACLE["cv_folds"] = _q("events", FOLDS, fin(
    "SELECT * FROM fo", doubles=MODEL_FEATURES, ints=("season", "label", "n_folds", "fold")))

KNN_OOF = FOLDS + """,
pr AS (
  SELECT q.season, q.race_name, q.driver AS qid, t.driver AS tid, t.label AS y,
    sqrt(""" + " + ".join(f"pow(q.{f} - t.{f}, 2)" for f in MODEL_FEATURES) + """) AS d
  FROM fo q JOIN fo t ON q.season = t.season AND q.race_name = t.race_name AND t.fold <> q.fold),
rk AS (SELECT *, row_number() OVER (PARTITION BY season, race_name, qid ORDER BY d, tid) AS r FROM pr),
vt AS (SELECT season, race_name, qid, y, count(*) * 1.0 AS s FROM rk WHERE r <= 5 GROUP BY season, race_name, qid, y),
kv AS (SELECT season, race_name, qid AS driver, first(y ORDER BY s DESC, y) AS pred_knn,
    sum(CASE WHEN y = 1 THEN s ELSE 0.0 END) / sum(s) AS proba_knn FROM vt GROUP BY season, race_name, qid),
oof AS (SELECT fo.season, fo.race_name, fo.driver, label, fold, n_folds, pred_knn, proba_knn
  FROM fo LEFT JOIN kv USING (season, race_name, driver))"""

ORACLE["knn_oof"] = _q("events", KNN_OOF, fin("""
  SELECT fo.season, fo.race_name, fo.driver, label, fold, n_folds, pred_knn, proba_knn
  FROM fo LEFT JOIN kv USING (season, race_name, driver)""",
    doubles=("proba_knn",), ints=("season", "label", "fold", "n_folds", "pred_knn")))

WEATHER = """
wx AS (
  SELECT CAST(year(ts) AS INTEGER) AS season,
    'W' || CAST(CAST(floor((day(ts) - 1) / 6) AS INTEGER) AS VARCHAR) AS race_name,
    epoch_us(date_trunc('hour', ts)) / 1e6 AS time_s,
    20.0 + avg(value) / 10.0 AS air_temp, 30.0 + avg(value) / 5.0 AS track_temp,
    CAST(40 + count(*) AS DOUBLE) AS humidity
  FROM events WHERE event_type = 'view' GROUP BY ALL),
lw AS (SELECT season, race_name, driver, lap_number, time_s FROM laps)"""

ORACLE["weather_mean_attach"] = _q("events", WEATHER + """,
wm AS (SELECT season, race_name, avg(air_temp) AS air_temp, avg(track_temp) AS track_temp,
  avg(humidity) AS humidity FROM wx GROUP BY season, race_name)""", fin(
    "SELECT lw.*, wm.air_temp, wm.track_temp, wm.humidity FROM lw LEFT JOIN wm USING (season, race_name)",
    doubles=("time_s", "air_temp", "track_temp", "humidity"), ints=("season", "lap_number")))

ORACLE["weather_asof"] = _q("events", WEATHER + """,
pv AS (SELECT lw.*, wx.time_s AS pt, wx.air_temp AS pa, wx.track_temp AS ptt, wx.humidity AS ph
  FROM lw ASOF LEFT JOIN wx ON lw.season = wx.season AND lw.race_name = wx.race_name AND lw.time_s >= wx.time_s),
nx AS (SELECT pv.*, wx.time_s AS nt, wx.air_temp AS na, wx.track_temp AS ntt, wx.humidity AS nh
  FROM pv ASOF LEFT JOIN wx ON pv.season = wx.season AND pv.race_name = wx.race_name AND pv.time_s <= wx.time_s),
ch AS (SELECT *, CASE WHEN pt IS NULL THEN true WHEN nt IS NOT NULL AND (nt - time_s) < (time_s - pt) THEN true
  ELSE false END AS use_next FROM nx)""", fin("""
  SELECT season, race_name, driver, lap_number, time_s,
    CASE WHEN use_next THEN nt ELSE pt END AS weather_time, CASE WHEN use_next THEN na ELSE pa END AS air_temp,
    CASE WHEN use_next THEN ntt ELSE ptt END AS track_temp, CASE WHEN use_next THEN nh ELSE ph END AS humidity
  FROM ch""", doubles=("time_s", "weather_time", "air_temp", "track_temp", "humidity"), ints=("season", "lap_number")))

ORACLE["pit_rating"] = _q("events", PIT_WINDOWS + """,
pdd AS (SELECT season, race_name, driver, count(*) AS pit_count,
    round(sum(CAST(round(impact * 1000) AS BIGINT)) / count(*)) / 1000 AS avg_impact
  FROM pd GROUP BY season, race_name, driver),
pr AS (SELECT season, race_name,
    round(sum(CAST(round(avg_impact * 1000) AS BIGINT)) FILTER (WHERE avg_impact <> 0)
      / count(*) FILTER (WHERE avg_impact <> 0)) / 1000 AS race_avg_impact,
    sum(pit_count) AS race_pit_total FROM pdd GROUP BY season, race_name)""", fin("""
  SELECT *, CASE WHEN avg_impact > 0.5 THEN 'advantage' WHEN avg_impact > 0 THEN 'normal' ELSE 'limited' END AS pit_rating
  FROM pdd LEFT JOIN pr USING (season, race_name)""",
    doubles=("avg_impact", "race_avg_impact"), ints=("season", "pit_count", "race_pit_total")))

ORACLE["holdout_split"] = _q("events", FOLDS.replace("fo AS (", "fo_unused AS (") + """,
hn AS (SELECT season, race_name, count(*) AS _n FROM mi GROUP BY season, race_name),
hs AS (SELECT mi.*, _n,
    row_number() OVER (PARTITION BY season, race_name, label
      ORDER BY md5(concat_ws('|', '42', CAST(season AS VARCHAR), race_name, driver)), driver) AS _rn,
    count(*) OVER (PARTITION BY season, race_name, label) AS _c
  FROM mi JOIN hn USING (season, race_name))""", fin("""
  SELECT season, race_name, driver, label, """ + ", ".join(MODEL_FEATURES) + """,
    (_c >= 2 AND _rn <= round(_c * CASE WHEN _n < 6 THEN 0.2 ELSE 0.3 END)) AS is_test FROM hs""",
    doubles=MODEL_FEATURES, ints=("season", "label")))

# Two-sided p of a Pearson r over n pairs: 1 - I_y(1/2, a) with y = r^2, a = (n - 2) / 2, as the incomplete beta's series.
WEATHER_R = """
wr AS (SELECT season, race_name, 'air_temp' AS variable,
    count(*) FILTER (WHERE air_temp IS NOT NULL AND lap_time IS NOT NULL) AS n_pairs, """ + safe_corr_sql(
    "air_temp", "lap_time") + """ AS r FROM ca GROUP BY season, race_name
  UNION ALL SELECT season, race_name, 'track_temp',
    count(*) FILTER (WHERE track_temp IS NOT NULL AND lap_time IS NOT NULL), """ + safe_corr_sql(
    "track_temp", "lap_time") + """ FROM ca GROUP BY season, race_name),
wy AS (SELECT *, r * r AS y, (n_pairs - 2) / 2.0 AS a FROM wr WHERE n_pairs >= 5),
wp AS (SELECT *, CASE WHEN r IS NULL THEN NULL WHEN abs(r) >= 1 THEN 0.0 WHEN r = 0 THEN 1.0 ELSE greatest(0.0, 1 - exp(
      0.5 * ln(y) + a * ln(1 - y) - ln(0.5) - lgamma(0.5) - lgamma(a) + lgamma(a + 0.5)) * list_sum(list_transform(
      range(0, 4000), lambda n: exp(lgamma(a + 0.5 + n) - lgamma(a + 0.5) - lgamma(1.5 + n) + lgamma(1.5) + n * ln(y))))) END
    AS p_value FROM wy),
weather AS (SELECT season, race_name, variable, n_pairs, r AS pearson_r, p_value, p_value < 0.05 AS significant,
    CASE WHEN abs(r) < 0.1 THEN 'negligible' WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.5 THEN 'moderate'
      WHEN abs(r) < 0.7 THEN 'strong' WHEN r IS NOT NULL THEN 'very_strong' END AS strength,
    CASE WHEN r > 0 THEN 'increasing' WHEN r IS NOT NULL THEN 'decreasing' END AS direction FROM wp)"""

ORACLE["weather_correlation"] = _q("events", WEATHER_R, fin(
    "SELECT * FROM weather", doubles=("pearson_r", "p_value"), ints=("season", "n_pairs")))


def _dec(expr: str, digits: int) -> str:
    return f"CAST(CAST(round({expr}, {digits}) AS DECIMAL(18, {digits})) AS VARCHAR)"


def _row(table: str, category: str, seq: int, code: str, subject: str, value: str, level: str, where: str = "true") -> str:
    return (f"SELECT season, race_name, '{category}' AS category, {seq} AS seq, {code} AS code, "
            f"CAST({subject} AS VARCHAR) AS subject, {value} AS value, {level} AS level FROM {table} WHERE {where}")


# No race of the fixtures is a known track, so every track row is N/A.
ORACLE["race_findings"] = _q("events", """
st AS (SELECT season, race_name, driver, min(lap_time) AS best, coalesce(stddev_samp(lap_time), 0.0) AS sd
  FROM ca GROUP BY season, race_name, driver),
sr AS (SELECT *, 1.0 / (1.0 + sd) AS cons,
    row_number() OVER (PARTITION BY season, race_name ORDER BY 1.0 / (1.0 + sd) DESC, driver) AS rk FROM st),
pf AS (SELECT season, race_name, arg_min(driver, rk) AS stable, arg_min(cons, rk) AS stable_score,
    first(driver ORDER BY best, rk) AS fastest, min(best) AS fastest_lap, count(*) AS n, arg_max(driver, rk) AS worst,
    arg_max(sd, rk) AS worst_sd FROM sr GROUP BY season, race_name),
cs AS (SELECT season, race_name, compound, avg(lap_time) AS m FROM ca GROUP BY season, race_name, compound),
cg AS (SELECT season, race_name, first(compound ORDER BY m, compound) AS best, min(m) AS m, max(m) - min(m) AS gap,
    count(*) AS n FROM cs GROUP BY season, race_name),""" + CURVE + """,
wd AS (SELECT fit.* FROM fit JOIN wst USING (season, race_name) WHERE compound = _worst),""" + PIT_WINDOWS.strip() + """,
pdd AS (SELECT season, race_name, driver, round(sum(CAST(round(impact * 1000) AS BIGINT)) / count(*)) / 1000 AS i
  FROM pd GROUP BY season, race_name, driver),
pr AS (SELECT season, race_name, round(sum(CAST(round(i * 1000) AS BIGINT)) FILTER (WHERE i <> 0)
      / count(*) FILTER (WHERE i <> 0)) / 1000 AS avg_i,
    first(driver ORDER BY i DESC, length(driver), driver DESC) AS best, max(i) AS best_i FROM pdd GROUP BY season, race_name),
ra AS (SELECT season, race_name, avg(track_temp) AS tt FROM clean GROUP BY season, race_name),
pa_ AS (SELECT * FROM ra LEFT JOIN pr USING (season, race_name)),
sl AS (SELECT season, race_name, driver, unnest([1, 2, 3]) AS s, unnest([sector1_time, sector2_time, sector3_time]) AS t FROM ca),
sm AS (SELECT season, race_name, s, driver, avg(t) AS m FROM sl GROUP BY season, race_name, s, driver),
sb AS (SELECT season, race_name, s, first(driver ORDER BY m, driver) AS driver, min(m) AS m FROM sm
  WHERE m IS NOT NULL GROUP BY season, race_name, s),""" + WEATHER_R, fin("\nUNION ALL ".join([
    _row("pf", "performance", 1, "'most_stable_driver'", "stable", _dec("stable_score", 3), "'positive'"),
    _row("pf", "performance", 2, "'fastest_driver'", "fastest",
         "printf('%d:%06.3f', CAST(floor(fastest_lap / 60) AS BIGINT), fastest_lap - floor(fastest_lap / 60) * 60)", "'positive'"),
    _row("pf", "performance", 3, "'speed_vs_stability'", "fastest || '/' || stable", "'opposite_profiles'", "'neutral'",
         "fastest <> stable"),
    _row("cg", "tire", 1, "'best_compound'", "best", _dec("m", 3), "'positive'"),
    _row("wd", "tire", 2, "'worst_degradation'", "compound", _dec("degradation_rate", 4),
         "CASE WHEN degradation_rate > 0.1 THEN 'warning' ELSE 'neutral' END"),
    _row("cg", "tire", 3, "'compound_gap'", "NULL", _dec("gap", 3), "'info'", "n >= 2 AND gap > 0.3"),
    _row("pa_", "pit", 1, "CASE WHEN avg_i > 0.5 THEN 'pit_clear_benefit' ELSE 'pit_impact' END", "'all_drivers'",
         _dec("avg_i", 3), "CASE WHEN avg_i > 0 THEN 'positive' ELSE 'warning' END", "avg_i IS NOT NULL"),
    _row("pa_", "pit", 1, "'pit_no_data'", "'N/A'", "NULL", "'neutral'", "avg_i IS NULL"),
    _row("pa_", "pit", 2, "'best_pit_driver'", "best", _dec("best_i", 3), "'positive'", "best_i > 0"),
    _row("weather", "weather", 1, "CASE WHEN significant THEN 'temp_effect_' || direction ELSE 'temp_effect_not_significant' END",
         "variable", _dec("pearson_r", 3), "CASE WHEN significant THEN 'info' ELSE 'neutral' END",
         "(abs(pearson_r) > 0.3 AND significant) OR NOT significant"),
    _row("ra", "weather", 2, "CASE WHEN tt > 40 THEN 'track_temp_high' WHEN tt > 30 THEN 'track_temp_medium' "
         "ELSE 'track_temp_low' END", "'track_temp'", _dec("tt", 1), "CASE WHEN tt > 45 THEN 'warning' ELSE 'neutral' END"),
    _row("pf", "driver", 1, "'least_consistent_driver'", "worst", _dec("worst_sd", 3), "'warning'", "n >= 3"),
    _row("sb", "driver", 2, "'fastest_sector' || s", "driver", _dec("m", 3), "'positive'"),
    _row("ra", "track", 1, "'track_profile'", "race_name", "'drs=N/A pit_window=N/A'", "'neutral'")]), ints=("season", "seq")))

ORACLE["knn_fold_scores"] = _q("events", KNN_OOF + """,
kc AS (SELECT season, race_name, fold, label AS c FROM oof UNION SELECT season, race_name, fold, pred_knn FROM oof),
pc AS (SELECT season, race_name, fold, c, count(*) FILTER (WHERE pred_knn = c AND label = c) AS tp,
    count(*) FILTER (WHERE pred_knn = c) AS pp, count(*) FILTER (WHERE label = c) AS ap
  FROM oof JOIN kc USING (season, race_name, fold) GROUP BY season, race_name, fold, c),
pm AS (SELECT season, race_name, fold, avg(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END) AS precision_knn,
    avg(CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END) AS recall_knn,
    avg(CASE WHEN tp > 0 THEN 2.0 * tp / (pp + ap) ELSE 0.0 END) AS f1_knn FROM pc GROUP BY season, race_name, fold),
ac AS (SELECT season, race_name, fold, avg(CAST(pred_knn = label AS DOUBLE)) AS acc_knn FROM oof
  GROUP BY season, race_name, fold)""", fin("SELECT * FROM ac JOIN pm USING (season, race_name, fold)",
    doubles=("acc_knn", "precision_knn", "recall_knn", "f1_knn"), ints=("season", "fold")))

# AUC as its definition: the share of (1, 0) pairs in the right order, ties a half.
ORACLE["knn_errors"] = _q("events", KNN_OOF + """,
er AS (SELECT season, race_name, 'kNN' AS model, count(*) FILTER (WHERE pred_knn = 1 AND label = 1) AS tp,
    count(*) FILTER (WHERE pred_knn = 1 AND label = 0) AS fp, count(*) FILTER (WHERE pred_knn = 0 AND label = 0) AS tn,
    count(*) FILTER (WHERE pred_knn = 0 AND label = 1) AS fn, avg(CAST(pred_knn <> label AS DOUBLE)) AS error_rate,
    count(*) FILTER (WHERE pred_knn <> label AND greatest(proba_knn, 1 - proba_knn) >= 0.7) AS high_conf_errors
  FROM oof GROUP BY season, race_name),
au AS (SELECT a.season, a.race_name, avg(CASE WHEN a.proba_knn > b.proba_knn THEN 1.0
      WHEN a.proba_knn = b.proba_knn THEN 0.5 ELSE 0.0 END) AS auc
  FROM oof a JOIN oof b ON a.season = b.season AND a.race_name = b.race_name AND a.label = 1 AND b.label = 0
  GROUP BY a.season, a.race_name)""", fin("SELECT * FROM er LEFT JOIN au USING (season, race_name)",
    doubles=("error_rate", "auc"), ints=("season", "tp", "fp", "tn", "fn", "high_conf_errors")))

ORACLE["knn_roc"] = _q("events", KNN_OOF + """,
th AS (SELECT DISTINCT season, race_name, proba_knn AS threshold FROM oof),
rc AS (SELECT season, race_name, threshold,
    count(*) FILTER (WHERE label = 1 AND proba_knn >= threshold) / nullif(count(*) FILTER (WHERE label = 1), 0) AS tpr,
    count(*) FILTER (WHERE label = 0 AND proba_knn >= threshold) / nullif(count(*) FILTER (WHERE label = 0), 0) AS fpr
  FROM th JOIN oof USING (season, race_name) GROUP BY season, race_name, threshold),
rj AS (SELECT *, coalesce(tpr, 0.0) - coalesce(fpr, 0.0) AS youden_j FROM rc),
rb AS (SELECT season, race_name, first(threshold ORDER BY youden_j DESC, threshold DESC) AS best, max(youden_j) AS j
  FROM rj GROUP BY season, race_name)""", fin("""
  SELECT rj.*, 'knn' AS model, threshold = best AND j > 0 AS is_best FROM rj JOIN rb USING (season, race_name)""",
    doubles=("threshold", "tpr", "fpr", "youden_j"), ints=("season",)))

HOLDOUT_FEATURES = MODEL_FEATURES + ("air_temp", "track_temp")
HOLDOUT = _model_input(HOLDOUT_FEATURES) + """,
hn AS (SELECT season, race_name, count(*) AS _n FROM mi GROUP BY season, race_name),
hs AS (SELECT mi.*, row_number() OVER (PARTITION BY season, race_name, label
      ORDER BY md5(concat_ws('|', '42', CAST(season AS VARCHAR), race_name, driver)), driver) <= round(
      count(*) OVER (PARTITION BY season, race_name, label) * CASE WHEN _n < 6 THEN 0.2 ELSE 0.3 END)
    AND count(*) OVER (PARTITION BY season, race_name, label) >= 2 AS is_test FROM mi JOIN hn USING (season, race_name))"""
HOLDOUT_KNN = """
pr AS (SELECT q.season, q.race_name, q.driver AS qid, q.label, t.driver AS tid, t.label AS y,
    sqrt(""" + " + ".join(f"pow(q.{f} - t.{f}, 2)" for f in HOLDOUT_FEATURES) + """) AS d
  FROM hs q JOIN hs t ON q.season = t.season AND q.race_name = t.race_name AND q.is_test AND NOT t.is_test),
rk AS (SELECT *, row_number() OVER (PARTITION BY season, race_name, qid ORDER BY d, tid) AS r FROM pr),
vt AS (SELECT season, race_name, qid, label, y, count(*) AS s FROM rk WHERE r <= 5 GROUP BY ALL),
pd_ AS (SELECT season, race_name, qid, label, first(y ORDER BY s DESC, y) AS p FROM vt GROUP BY ALL)"""


def _report(rel: str, model: str) -> str:
    """Confusion counts and class report of ``rel`` (keys, label, p)."""
    return f"""
  SELECT season, race_name, n_train, '{model}' AS model, n_test, tn, fp, fn, tp, (tn + tp) / n_test AS accuracy,
    CASE WHEN tn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS precision_0, CASE WHEN tn > 0 THEN tn / (tn + fp) ELSE 0.0 END AS recall_0,
    CASE WHEN tn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0.0 END AS f1_0,
    CASE WHEN tp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision_1, CASE WHEN tp > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall_1,
    CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_1
  FROM (SELECT season, race_name, count(*) AS n_train FROM hs WHERE NOT is_test GROUP BY season, race_name) JOIN (
    SELECT season, race_name, count(*) AS n_test, count(*) FILTER (WHERE label = 0 AND p = 0) AS tn,
      count(*) FILTER (WHERE label = 0 AND p = 1) AS fp, count(*) FILTER (WHERE label = 1 AND p = 0) AS fn,
      count(*) FILTER (WHERE label = 1 AND p = 1) AS tp FROM {rel} GROUP BY season, race_name) USING (season, race_name)"""


REPORT = {"doubles": ("accuracy", "precision_0", "recall_0", "f1_0", "precision_1", "recall_1", "f1_1"),
          "ints": ("season", "n_train", "n_test", "tn", "fp", "fn", "tp")}
ORACLE["knn_holdout"] = _q("events", HOLDOUT + "," + HOLDOUT_KNN, fin(_report("pd_", "kNN"), **REPORT))


def _tree(train: str, keys: str, features: tuple[str, ...], max_depth: int = 5) -> str:
    """CTEs of a Gini tree per ``keys`` by its definition: every midpoint of every feature is a candidate.

    ``train`` holds keys, driver, label and the features. ``tl{d}_b`` is the split of each node of level d and
    ``tn`` every node with its class counts; a node is named by its path, 1 for the root.
    """
    kn = keys + ", node"
    gini = lambda a, b: f"(1.0 - ((0.0 + pow({a} / ({a} + {b}), 2)) + pow({b} / ({a} + {b}), 2)))"
    out = [f"""
tl0 AS (SELECT {keys}, driver, label, {", ".join(features)}, '1' AS node FROM {train})"""]
    for d in range(max_depth + 1):
        out.append(f"""
tl{d}_n AS (SELECT {kn}, count(*) AS n, count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1
  FROM tl{d} GROUP BY {kn})""")
        if d == max_depth:
            break
        values = " UNION ALL ".join(f"SELECT {kn}, {i} AS f, {f} AS v, label FROM tl{d}" for i, f in enumerate(features))
        out.append(f"""
tl{d}_v AS (SELECT {kn}, f, v, count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1
  FROM ({values}) GROUP BY {kn}, f, v),
tl{d}_c AS (SELECT {kn}, f, v, lead(v) OVER w AS nx, sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, n0 - l0 AS r0, n1 - l1 AS r1
  FROM tl{d}_v JOIN tl{d}_n USING ({kn}) WHERE n0 > 0 AND n1 > 0 WINDOW w AS (PARTITION BY {kn}, f ORDER BY v)),
tl{d}_i AS (SELECT *, CASE WHEN (v + nx) / 2.0 < nx THEN (v + nx) / 2.0 ELSE v END AS thr,
    ((l0 + l1) * {gini("l0", "l1")} + (r0 + r1) * {gini("r0", "r1")}) / (l0 + l1 + r0 + r1) AS imp
  FROM tl{d}_c WHERE nx IS NOT NULL),
tl{d}_b AS (SELECT {kn}, f, thr FROM tl{d}_i
  QUALIFY row_number() OVER (PARTITION BY {kn} ORDER BY imp, f, thr) = 1),
tl{d + 1} AS (SELECT tl{d}.* REPLACE (node || CASE WHEN {_feature("f", features)} <= thr THEN '0' ELSE '1' END AS node)
  FROM tl{d} JOIN tl{d}_b USING ({kn}))""")
    nodes = " UNION ALL ".join(f"SELECT * FROM tl{d}_n" for d in range(max_depth + 1))
    splits = " UNION ALL ".join(f"SELECT * FROM tl{d}_b" for d in range(max_depth))
    out.append(f"""
tn AS ({nodes}),
ts AS ({splits})""")
    return ",".join(out)


def _feature(place: str, features: tuple[str, ...]) -> str:
    return "CASE " + place + " " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(features)) + " END"


def _route(test: str, keys: str, features: tuple[str, ...], max_depth: int = 5) -> str:
    """CTEs that send the rows of ``test`` down the trees of ``_tree``; ``tq`` holds keys, driver, pred_dt and proba_dt."""
    out = [f"""
q0 AS (SELECT {keys}, driver, {", ".join(features)}, '1' AS node FROM {test})"""]
    for d in range(max_depth):
        out.append(f"""
q{d + 1} AS (SELECT q{d}.* REPLACE (CASE WHEN f IS NULL THEN node
      WHEN {_feature("f", features)} <= thr THEN node || '0' ELSE node || '1' END AS node)
  FROM q{d} LEFT JOIN ts USING ({keys}, node))""")
    out.append(f"""
tq AS (SELECT {keys}, driver, CASE WHEN n0 >= n1 THEN 0 ELSE 1 END AS pred_dt, n1 / n AS proba_dt
  FROM q{max_depth} JOIN tn USING ({keys}, node))""")
    return ",".join(out)


KF = K + ", cv_fold"
CV_OOF = KNN_OOF + """,
ft AS (SELECT fo.*, g.cv_fold FROM fo, LATERAL (SELECT unnest(range(0, n_folds)) AS cv_fold) g WHERE g.cv_fold <> fold),
fq AS (SELECT *, fold AS cv_fold FROM fo),""" + _tree("ft", KF, MODEL_FEATURES) + "," + _route("fq", KF, MODEL_FEATURES) + """,
cv AS (SELECT oof.*, pred_dt, proba_dt FROM oof LEFT JOIN tq USING (season, race_name, driver))"""

ORACLE["cv_oof"] = _q("events", CV_OOF, fin(
    "SELECT * FROM cv", doubles=("proba_knn", "proba_dt"), ints=("season", "label", "fold", "n_folds", "pred_knn", "pred_dt")))


def _scores(m: str) -> str:
    """CTE s_{m}: accuracy and macro precision, recall and F1 of each fold."""
    return f"""
s_{m} AS (SELECT * FROM (SELECT season, race_name, fold, avg(CAST(pred_{m} = label AS DOUBLE)) AS acc_{m} FROM cv
    GROUP BY season, race_name, fold) JOIN (
  SELECT season, race_name, fold, avg(CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END) AS precision_{m},
    avg(CASE WHEN ap > 0 THEN tp / ap ELSE 0.0 END) AS recall_{m},
    avg(CASE WHEN tp > 0 THEN 2.0 * tp / (pp + ap) ELSE 0.0 END) AS f1_{m} FROM (
    SELECT season, race_name, fold, c, count(*) FILTER (WHERE pred_{m} = c AND label = c) AS tp,
      count(*) FILTER (WHERE pred_{m} = c) AS pp, count(*) FILTER (WHERE label = c) AS ap
    FROM cv JOIN (SELECT season, race_name, fold, label AS c FROM cv UNION SELECT season, race_name, fold, pred_{m} FROM cv)
      USING (season, race_name, fold) GROUP BY season, race_name, fold, c) GROUP BY season, race_name, fold)
  USING (season, race_name, fold))"""


SCORES = CV_OOF + "," + _scores("dt") + "," + _scores("knn") + """,
fs AS (SELECT * FROM s_dt JOIN s_knn USING (season, race_name, fold))"""
SCORE_DOUBLES = tuple(f"{x}_{m}" for m in ("dt", "knn") for x in ("acc", "precision", "recall", "f1"))
ORACLE["cv_fold_scores"] = _q("events", SCORES, fin("SELECT * FROM fs", doubles=SCORE_DOUBLES, ints=("season", "fold")))

MODEL_NAMES = {"dt": "Decision Tree", "knn": "kNN"}
ORACLE["error_analysis"] = _q("events", CV_OOF, fin(" UNION ALL ".join(f"""
  SELECT season, race_name, '{name}' AS model, count(*) FILTER (WHERE pred_{m} = 1 AND label = 1) AS tp,
    count(*) FILTER (WHERE pred_{m} = 1 AND label = 0) AS fp, count(*) FILTER (WHERE pred_{m} = 0 AND label = 0) AS tn,
    count(*) FILTER (WHERE pred_{m} = 0 AND label = 1) AS fn, avg(CAST(pred_{m} <> label AS DOUBLE)) AS error_rate,
    count(*) FILTER (WHERE pred_{m} <> label AND greatest(proba_{m}, 1 - proba_{m}) >= 0.7) AS high_conf_errors
  FROM cv GROUP BY season, race_name""" for m, name in MODEL_NAMES.items()),
    doubles=("error_rate",), ints=("season", "tp", "fp", "tn", "fn", "high_conf_errors")))

ORACLE["entity_errors"] = _q("events", CV_OOF, fin("""
  SELECT season, race_name, driver, label AS actual, pred_dt AS predicted_dt, pred_knn AS predicted_knn,
    pred_dt = label AS correct_dt, pred_knn = label AS correct_knn, pred_dt <> label AND pred_knn <> label AS both_wrong,
    CASE WHEN pred_dt = label THEN NULL WHEN pred_dt = 1 THEN 'FP' ELSE 'FN' END AS error_dt,
    CASE WHEN pred_knn = label THEN NULL WHEN pred_knn = 1 THEN 'FP' ELSE 'FN' END AS error_knn,
    greatest(proba_dt, 1 - proba_dt) AS confidence_dt, greatest(proba_knn, 1 - proba_knn) AS confidence_knn FROM cv""",
    doubles=("confidence_dt", "confidence_knn"), ints=("season", "actual", "predicted_dt", "predicted_knn")))

ORACLE["roc_curve"] = _q("events", CV_OOF + """,
lo AS (SELECT season, race_name, 'dt' AS model, label, proba_dt AS p FROM cv
  UNION ALL SELECT season, race_name, 'knn', label, proba_knn FROM cv),
th AS (SELECT DISTINCT season, race_name, model, p AS threshold FROM lo
  UNION SELECT DISTINCT season, race_name, model, CAST('Infinity' AS DOUBLE) FROM lo),
rc AS (SELECT season, race_name, model, threshold,
    count(*) FILTER (WHERE label = 1 AND p >= threshold) / nullif(count(*) FILTER (WHERE label = 1), 0) AS tpr,
    count(*) FILTER (WHERE label = 0 AND p >= threshold) / nullif(count(*) FILTER (WHERE label = 0), 0) AS fpr
  FROM th JOIN lo USING (season, race_name, model) GROUP BY season, race_name, model, threshold)""", fin(
    "SELECT *, coalesce(tpr, 0.0) - coalesce(fpr, 0.0) AS youden_j FROM rc",
    doubles=("threshold", "tpr", "fpr", "youden_j"), ints=("season",)))

ORACLE["tree_importance"] = _q("events", _model_input(MODEL_FEATURES) + "," + _tree("mi", K, MODEL_FEATURES) + f""",
gi AS (SELECT {K}, node, n, n * (1.0 - pow(n1 / n, 2) - pow(n0 / n, 2)) AS w FROM tn),
gn AS (SELECT {K}, f, sum(p.w - l.w - r.w) AS g FROM ts JOIN gi p USING ({K}, node)
  JOIN (SELECT {K}, left(node, -1) AS node, w FROM gi WHERE right(node, 1) = '0') l USING ({K}, node)
  JOIN (SELECT {K}, left(node, -1) AS node, w FROM gi WHERE right(node, 1) = '1' AND length(node) > 1) r USING ({K}, node)
  GROUP BY {K}, f)""", fin(f"""
  SELECT {K}, {_feature("f", tuple(repr(x) for x in MODEL_FEATURES))} AS feature,
    round(g / nullif(sum(g) OVER (PARTITION BY {K}), 0), 5) AS importance FROM gn""",
    doubles=("importance",), ints=("season",)))

ORACLE["holdout_scores"] = _q("events", HOLDOUT + "," + HOLDOUT_KNN + """,
ht AS (SELECT * FROM hs WHERE NOT is_test), hq AS (SELECT * FROM hs WHERE is_test),""" + _tree("ht", K, HOLDOUT_FEATURES)
    + "," + _route("hq", K, HOLDOUT_FEATURES) + """,
td AS (SELECT season, race_name, label, pred_dt AS p FROM tq JOIN hq USING (season, race_name, driver))""", fin(
    _report("pd_", "kNN") + " UNION ALL " + _report("td", "Decision Tree"), **REPORT))

ORACLE["model_winner"] = _q("events", HOLDOUT + "," + HOLDOUT_KNN + """,
ht AS (SELECT * FROM hs WHERE NOT is_test), hq AS (SELECT * FROM hs WHERE is_test),""" + _tree("ht", K, HOLDOUT_FEATURES)
    + "," + _route("hq", K, HOLDOUT_FEATURES) + """,
td AS (SELECT season, race_name, label, pred_dt AS p FROM tq JOIN hq USING (season, race_name, driver)),
da AS (SELECT season, race_name, avg(CAST(p = label AS DOUBLE)) AS dt_acc FROM td GROUP BY season, race_name),
ka AS (SELECT season, race_name, avg(CAST(p = label AS DOUBLE)) AS knn_acc FROM pd_ GROUP BY season, race_name)""", fin("""
  SELECT season, race_name, dt_acc, knn_acc, CASE WHEN dt_acc >= knn_acc THEN 'Decision Tree' ELSE 'kNN' END AS winner
  FROM da JOIN ka USING (season, race_name)""", doubles=("dt_acc", "knn_acc"), ints=("season",)))

ALL_ROWS_TREE = _model_input(MODEL_FEATURES) + "," + _tree("mi", K, MODEL_FEATURES)
ORACLE["local_explanations"] = _q("events", ALL_ROWS_TREE + "," + _route("mi", K, MODEL_FEATURES), fin(f"""
  SELECT {K}, driver, pred_dt AS prediction, label AS actual, pred_dt = label AS correct,
    greatest(proba_dt, 1 - proba_dt) AS confidence, {", ".join(MODEL_FEATURES)} FROM mi JOIN tq USING ({KD})""",
    doubles=("confidence",) + MODEL_FEATURES, ints=("season", "prediction", "actual")))

# Shapley values by their definition, all 32 coalitions: a leaf counts for a coalition with the product of "the row goes
# there" over the features in it, and of the share of training rows that go there over the others.
_BITS = range(len(MODEL_FEATURES))
ORACLE["shap_importance"] = _q("events", ALL_ROWS_TREE + f""",
lv AS (SELECT {K}, node AS leaf, n1 / n AS val FROM tn ANTI JOIN ts USING ({K}, node)),
st_ AS (SELECT {K}, leaf, left(leaf, i) AS node, left(leaf, i + 1) AS nxt FROM lv, LATERAL (
  SELECT unnest(range(1, length(leaf))) AS i)),
sp AS (SELECT st_.*, f, thr, b.n / a.n AS share FROM st_ JOIN ts USING ({K}, node) JOIN tn a USING ({K}, node)
  JOIN (SELECT {K}, node AS nxt, n FROM tn) b USING ({K}, nxt)),
lb AS (SELECT {K}, leaf, any_value(val) AS val, """ + ", ".join(
    f"max(thr) FILTER (WHERE f = {i} AND right(nxt, 1) = '1') AS lo{i}, "
    f"min(thr) FILTER (WHERE f = {i} AND right(nxt, 1) = '0') AS hi{i}, "
    f"coalesce(product(share) FILTER (WHERE f = {i}), 1.0) AS w{i}" for i in _BITS) + f"""
  FROM lv LEFT JOIN sp USING ({K}, leaf) GROUP BY {K}, leaf),
vs AS (SELECT {K}, driver, s, sum(val * """ + " * ".join(
    f"CASE WHEN s & {1 << i} = 0 THEN w{i} WHEN coalesce({x} > lo{i}, true) AND coalesce({x} <= hi{i}, true) THEN 1.0 ELSE 0.0 END"
    for i, x in enumerate(MODEL_FEATURES)) + f""") AS v
  FROM mi JOIN lb USING ({K}), range({1 << len(MODEL_FEATURES)}) AS r(s) GROUP BY {K}, driver, s),
ph AS (SELECT a.season, a.race_name, a.driver, i, sum((b.v - a.v) * [24, 6, 4, 6, 24][bit_count(a.s) + 1] / 120.0) AS phi
  FROM vs a, range({len(MODEL_FEATURES)}) AS g(i), vs b WHERE a.season = b.season AND a.race_name = b.race_name
    AND a.driver = b.driver AND a.s & (1 << i) = 0 AND b.s = a.s | (1 << i) GROUP BY ALL),
ms AS (SELECT {K}, {_feature("i", tuple(repr(x) for x in MODEL_FEATURES))} AS feature, avg(abs(phi)) AS mean_abs_shap
  FROM ph GROUP BY ALL)""", fin(f"""
  SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY round(mean_abs_shap, 10) DESC, feature) AS rank FROM ms""",
    doubles=("mean_abs_shap",), ints=("season", "rank")))

# One row per driver, feature and repeat: the feature's value comes from the driver at the same place of the md5 order.
ORACLE["permutation_importance"] = _q("events", ALL_ROWS_TREE + f""",
ex AS (SELECT mi.*, _f, _rep FROM mi, range({len(MODEL_FEATURES)}) AS a(_f), range(30) AS b(_rep)),
xt AS (SELECT *, row_number() OVER (PARTITION BY {K}, _f, _rep ORDER BY driver) AS rk FROM ex),
xs AS (SELECT {K}, _f, _rep, {_feature("_f", MODEL_FEATURES)} AS pv, row_number() OVER (PARTITION BY {K}, _f, _rep
    ORDER BY md5(concat_ws('|', '42', CAST(_rep AS VARCHAR), CAST(_f AS VARCHAR), driver)), driver) AS rk FROM ex),
xp AS (SELECT xt.* EXCLUDE (driver) REPLACE (""" + ", ".join(
    f"CASE WHEN _f = {i} THEN pv ELSE {x} END AS {x}" for i, x in enumerate(MODEL_FEATURES)) + f"""),
    driver || '|' || _f || '|' || _rep AS driver FROM xt JOIN xs USING ({K}, _f, _rep, rk)
  UNION ALL BY NAME SELECT mi.*, -1 AS _f, -1 AS _rep FROM mi),""" + _route("xp", K, MODEL_FEATURES) + f""",
xa AS (SELECT {K}, _f, _rep, avg(CAST(pred_dt = label AS DOUBLE)) AS acc FROM xp JOIN tq USING ({KD}) GROUP BY {K}, _f, _rep),
xd AS (SELECT x.season, x.race_name, x._f, b.acc - x.acc AS d FROM xa x JOIN xa b ON x.season = b.season
  AND x.race_name = b.race_name AND b._f = -1 AND x._f >= 0)""", fin(f"""
  SELECT {K}, {_feature("_f", tuple(repr(x) for x in MODEL_FEATURES))} AS feature, avg(d) AS importance_mean,
    stddev_pop(d) AS importance_std FROM xd GROUP BY {K}, _f""",
    doubles=("importance_mean", "importance_std"), ints=("season",)))


def _chi2_tail(x: str) -> str:
    """P(chi-square with one degree of freedom > x), by the series of the lower incomplete gamma function."""
    return (f"(CASE WHEN {x} <= 0 THEN 1.0 ELSE greatest(0.0, 1 - list_sum(list_transform(range(0, 300), "
            f"lambda j: exp((j + 0.5) * ln({x} / 2) - {x} / 2 - lgamma(j + 1.5))))) END)")


def _t_tail(t: str, df: str) -> str:
    """Two-sided p of Student's t, by the series of the incomplete beta function."""
    y, a = f"({t} * {t} / ({df} + {t} * {t}))", f"({df} / 2.0)"
    return (f"(CASE WHEN {t} = 0 THEN 1.0 ELSE greatest(0.0, 1 - exp(0.5 * ln({y}) + {a} * ln(1 - {y}) - ln(0.5) "
            f"- lgamma(0.5) - lgamma({a}) + lgamma({a} + 0.5)) * list_sum(list_transform(range(0, 4000), lambda j: "
            f"exp(lgamma({a} + 0.5 + j) - lgamma({a} + 0.5) - lgamma(1.5 + j) + lgamma(1.5) + j * ln({y}))))) END)")


ORACLE["model_tests"] = _q("events", SCORES + f""",
bc AS (SELECT {K}, count(*) FILTER (WHERE pred_dt = label AND pred_knn <> label) AS b,
    count(*) FILTER (WHERE pred_dt <> label AND pred_knn = label) AS c FROM cv GROUP BY {K}),
mn0 AS (SELECT {K}, CASE WHEN b + c = 0 THEN 0.0 ELSE pow(abs(b - c) - 1.0, 2) / (b + c) END AS x, b + c AS n FROM bc),
mn1 AS (SELECT {K}, 'mcnemar' AS test, x AS statistic, CASE WHEN n = 0 THEN 1.0 ELSE {_chi2_tail("x")} END AS p_value FROM mn0),
df_ AS (SELECT {K}, fold, acc_dt - acc_knn AS d FROM fs),
tt0 AS (SELECT {K}, count(*) AS n, avg(d) AS m, stddev_samp(d) AS sd FROM df_ GROUP BY {K}),
tt1 AS (SELECT *, CASE WHEN n < 2 THEN 0.0 WHEN sd > 0 THEN m / (sd / sqrt(n)) END AS t FROM tt0),
tt2 AS (SELECT {K}, 'paired_ttest' AS test, t AS statistic, CASE WHEN n < 2 THEN 1.0 ELSE {_t_tail("t", "(n - 1)")} END AS p_value
  FROM tt1),
rk_ AS (SELECT {K}, d, rank() OVER (PARTITION BY {K} ORDER BY abs(d)) AS r, count(*) OVER (PARTITION BY {K}, abs(d)) AS ties
  FROM df_ WHERE d <> 0),
wx0 AS (SELECT {K}, count(*) AS n, max(ties) AS most, sum((pow(ties, 3) - ties) / ties) AS tie,
    least(sum(CASE WHEN d > 0 THEN r + (ties - 1) / 2.0 ELSE 0.0 END), sum(CASE WHEN d < 0 THEN r + (ties - 1) / 2.0 ELSE 0.0 END)) AS s
  FROM rk_ GROUP BY {K}),
wx1 AS (SELECT {K}, coalesce(wx0.n, 0) AS n, tt0.n AS folds, most, s,
    pow(s - wx0.n * (wx0.n + 1) / 4.0, 2) / (wx0.n * (wx0.n + 1) * (2 * wx0.n + 1) / 24.0 - tie / 48.0) AS z2
  FROM tt0 LEFT JOIN wx0 USING ({K})),
wx2 AS (SELECT {K}, 'wilcoxon' AS test, CASE WHEN folds < 3 OR n = 0 THEN 0.0 ELSE s END AS statistic,
    CASE WHEN folds < 3 OR n = 0 THEN 1.0 WHEN most > 1 THEN {_chi2_tail("z2")}
      ELSE least(1.0, 2.0 * len(list_filter(range(0, CAST(pow(2, n) AS BIGINT)), lambda i: list_sum(list_transform(
        range(1, n + 1), lambda r: r * ((i >> CAST(r - 1 AS INTEGER)) & 1))) <= s)) / pow(2, n)) END AS p_value FROM wx1),
ts_ AS (SELECT *, p_value < 0.05 AS significant FROM (FROM mn1 UNION ALL FROM tt2 UNION ALL FROM wx2)),
vo AS (SELECT {K}, count(*) FILTER (WHERE significant) AS k FROM ts_ GROUP BY {K})""", fin(f"""
  SELECT {K}, test, statistic, p_value, coalesce(significant, false) AS significant,
    CASE WHEN k = 0 THEN 'none' WHEN k >= 2 THEN 'majority' ELSE 'mixed' END AS verdict FROM ts_ JOIN vo USING ({K})""",
    doubles=("statistic", "p_value"), ints=("season",)))
