"""Queries of the emissions library with the SQL that states the same result independently."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import additive_sql as AS
from . import config as K
from . import fixtures as X
from .fixtures import SQL
from .functions import features as FE
from .functions import scalars as S
from .operators import additive, joins, models, regions, series, tables
from .plans import months
from .session import shared_folder, written
from .sources import files, payload
from .streaming import windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query with its SQL, if SQL can state it."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE[name or f.__name__] = sql
        return f

    return add


def values(spark: SparkSession, columns: str, *rows: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({columns})")


def r6(column, digits: int = 6):
    return F.round(column, digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(r6(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _round_sql(columns: str) -> str:
    return ", ".join(f"ROUND({c}, 6) AS {c}" for c in columns.split())


GRID_COLUMNS = "thermal_generation gas_generation hydro_generation nuclear_generation renewable_generation total_generation demand_met net_demand tons_co2 tons_co2_per_mwh g_co2_per_kwh"

# Scans, sources and sinks.


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def scan_parquet(spark, d):
    return X.events(spark, d).select("event_id", "ts", "user_id", "event_type", "value")


@query("SELECT event_type, COUNT(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1")
def scan_monthly_parquet(spark, d):
    """Explicit schema and a pushed-down range."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    df = spark.read.schema(schema).parquet(f"{d}/events.parquet")
    return df.where("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-20'").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT COUNT(*) AS n_rows FROM events")
def scan_glob(spark, d):
    return spark.read.option("pathGlobFilter", "events*.parquet").parquet(f"{d}/events.parquet").agg(F.count("*").alias("n_rows"))


_PAYLOAD_SQL = f"""SELECT 'p' || (i // 6) AS month, TIMESTAMP '2024-01-01' + INTERVAL (5 * i) MINUTE AS timestamp,
  {', '.join(f'(i + {k})::DOUBLE AS {v}' for k, v in enumerate(K.GRID_VARIABLES))} FROM range(12) t(i)"""
_DAYS_SQL = SQL + f"SELECT 'p' || day(timestamp) AS month, timestamp, {_round_sql(' '.join(K.GRID_VARIABLES))} FROM grid WHERE day(timestamp) % 6 < 2"


def _payloads(spark, d):
    """The grid as the service sends it, a body a day: JSON text in a JSON string. Four days of six are broken, each in its way."""
    day, at = F.day("timestamp"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")
    listed = X.grid(spark, d).groupBy(day.alias("p")).agg(F.sort_array(F.collect_list(F.struct(at.alias("timestamps"), *K.GRID_VARIABLES))).alias("rows"))
    arrays = [F.transform("rows", _field(c)).alias(c) for c in ("timestamps", *K.GRID_VARIABLES)]
    inner = F.to_json(F.struct(F.struct(*arrays).alias("timeseries_values")))
    rows = listed.select("p", (F.col("p") % 6).alias("k"), inner.alias("inner"))
    broken = F.when(F.col("k") == 2, F.lit('{"error":1}')).when(F.col("k") == 3, F.regexp_replace("inner", "demand_met", "demand")).when(F.col("k") == 4, F.regexp_replace("inner", r'"timestamps":\["[^"]*"', '"timestamps":["soon"')).when(F.col("k") == 5, F.regexp_replace("inner", r'"net_demand":\[[^\]]*\]', '"net_demand":[]')).otherwise(F.col("inner"))
    quoted = F.substring(F.to_json(F.struct(broken.alias("s"))), 6, 10_000_000)
    return rows.select(F.concat(F.lit("p"), F.col("p")).alias("month"), F.substring(quoted, F.lit(1), F.length(quoted) - 1).alias("body"))


def _field(name: str):
    return lambda x: x[name]


@query(_DAYS_SQL)
def payload_arrays_to_rows(spark, d):
    return rounded(payload.payload_rows(_payloads(spark, d)))


@query(_PAYLOAD_SQL, "src_api_decode")
def src_api_decode(spark, d):
    """Through the Python data source, with recorded bodies in place of the service."""
    from .sources.provider import MonthlyGrid

    spark.dataSource.register(MonthlyGrid)
    read = spark.read.format("monthly_grid").options(start="2024-01-01 00:00:00", end="2024-03-01 00:00:00", pause="0", fetch="emberflux.sources.recorded:fetch").load()
    return payload.payload_rows(read).withColumn("month", F.concat(F.lit("p"), F.col("month").substr(7, 1).cast("int") - 1))


@query(f"SELECT month, timestamp, demand_met, net_demand FROM ({_DAYS_SQL})")
def project_variables(spark, d):
    return rounded(payload.payload_rows(_payloads(spark, d)).select("month", "timestamp", "demand_met", "net_demand"))


@query("SELECT path, CASE WHEN head = '504B0304' THEN 'zip' WHEN head = '47524942' THEN 'grib' ELSE 'other' END AS kind FROM (VALUES ('a.zip', '504B0304'), ('b.grib', '47524942'), ('c.grib', '4752'), ('d.nc', '89484446'), ('e', '')) t(path, head)")
def magic_bytes_classify(spark, d):
    rows = values(spark, "path, head", "('a.zip', X'504B0304')", "('b.grib', X'47524942')", "('c.grib', X'4752')", "('d.nc', X'89484446')", "('e', X'')")
    return rows.select("path", files.file_kind(F.col("head")).alias("kind"))


_MEMBERS = "('one', 'x.grib', 5), ('one', 'readme.txt', 90), ('many', 'a.grib', 5), ('many', 'b.grb', 7), ('many', 'c.txt', 70), ('none', 'a.txt', 1), ('none', 'b.txt', 3)"


@query(f"SELECT archive, name AS member FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY archive ORDER BY (name LIKE '%.grib' OR name LIKE '%.grb') DESC, size DESC, name) AS k FROM (VALUES {_MEMBERS}) t(archive, name, size)) WHERE k = 1")
def zip_member_choice(spark, d):
    return files.choose_member(values(spark, "archive, name, size", _MEMBERS))


#: Requests by the users' spans, and a listing of files by the users' numbers: sound names, other bases, parts, other endings.
_ASKED_SQL = "(SELECT id, MIN(ts) - INTERVAL (31 * id) DAY AS s, MAX(ts) + INTERVAL (20 * id) DAY AS e FROM (SELECT user_id % 5 AS id, ts FROM events) GROUP BY id)"
_FILES_SQL = """(SELECT 'raw/era5-land_N37W68S6E98_' || CASE k % 5 WHEN 3 THEN 'xyz' ELSE 'abc' END || '_' || CASE k % 5 WHEN 1 THEN strftime(m, '%Y_%m') ELSE strftime(m, '%Y-%m') END || CASE k % 5 WHEN 1 THEN '.zip' WHEN 2 THEN '.grib.download' WHEN 4 THEN '.' ELSE '.grib' END AS path
  FROM (SELECT k, DATE '2023-09-01' + INTERVAL (k) MONTH AS m FROM (SELECT DISTINCT user_id % 20 AS k FROM events)))"""
_PRESENT = f"SELECT CAST(regexp_extract(path, '_abc_(\\d{{4}})[-_](\\d{{2}})', 1) AS INT) AS year, CAST(regexp_extract(path, '_abc_(\\d{{4}})[-_](\\d{{2}})', 2) AS INT) AS month, MIN(path) AS path FROM {_FILES_SQL} WHERE regexp_matches(path, '^raw/era5-land_N37W68S6E98_abc_\\d{{4}}[-_]\\d{{2}}\\.[A-Za-z0-9]+$') GROUP BY 1, 2"
_PLANS = f"SELECT id, CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month FROM (SELECT id, unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH)) AS m FROM {_ASKED_SQL})"
_PLAN = f"SELECT DISTINCT year, month FROM ({_PLANS})"


def _asked_spans(spark, d):
    spans = X.events(spark, d).groupBy((F.col("user_id") % 5).alias("id")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    shifted = lambda c, days: F.timestamp_add("DAY", (days * F.col("id")).cast("int"), F.col(c)).cast("timestamp_ntz")
    return spans.select("id", shifted("a", -31).alias("start"), shifted("b", 20).alias("end"))


def _present(spark, d):
    k = F.col("k") % 5
    month = F.add_months(F.lit("2023-09-01").cast("date"), F.col("k").cast("int"))
    name = F.concat(F.lit("raw/era5-land_N37W68S6E98_"), F.when(k == 3, "xyz").otherwise("abc"), F.lit("_"), F.when(k == 1, F.date_format(month, "yyyy_MM")).otherwise(F.date_format(month, "yyyy-MM")), F.when(k == 1, ".zip").when(k == 2, ".grib.download").when(k == 4, ".").otherwise(".grib"))
    listing = X.events(spark, d).select((F.col("user_id") % 20).alias("k")).distinct().select(name.alias("path"))
    return months.present_months(listing, "era5-land_N37W68S6E98_abc")


def _plans(spark, d):
    return months.month_plan(_asked_spans(spark, d).withColumns({c: F.to_date(c) for c in ("start", "end")})).drop("start", "end")


def _plan(spark, d):
    return _plans(spark, d).select("year", "month").distinct()


@query(f"SELECT year, month, CASE WHEN month % 3 = 0 THEN 'failed' WHEN month % 4 = 1 THEN 'skipped' ELSE 'success' END AS status, CASE WHEN month % 3 = 0 OR month % 4 = 1 THEN NULL WHEN month % 2 = 0 THEN 'data.grib' ELSE 'era5-land_' || year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '.grib' END AS member, CASE WHEN month % 3 <> 0 THEN 4 + 24 * day(last_day(make_date(year, month, 1))) END AS size FROM ({_PLAN})")
def src_weather_months(spark, d):
    """The months that the users' spans ask for, through the Python data source with recorded bodies; some were there before."""
    from datetime import date

    from .plans.requests import WeatherRequest
    from .sources.weather import MonthlyWeather

    spark.dataSource.register(MonthlyWeather)
    folder, plan = shared_folder(spark, "bodies"), _plan(spark, d)
    ends = plan.agg(F.min(F.make_date("year", "month", F.lit(1))), F.max(F.last_day(F.make_date("year", "month", F.lit(1))))).first()
    request = WeatherRequest("era5-land", *(x or date(2024, 1, 1) for x in ends), (37.0, 68.0, 6.0, 98.0), ("2m_temperature",), retries=2, delay=0, parallel=2)
    read = lambda rows: spark.read.format("monthly_weather").options(**request.options(folder, rows), fetch="emberflux.sources.recorded:weather").load()
    read(plan.where("month % 4 = 1")).write.format("noop").mode("overwrite").save()
    return written(read(plan), "months").select("year", "month", "status", "member", "size")


query(_PRESENT, "month_file_match")(lambda spark, d: _present(spark, d))
query(f"SELECT p.* FROM ({_PLAN}) p ANTI JOIN ({_PRESENT}) f USING (year, month)", "plan_skip_existing")(lambda spark, d: months.plan_skip_existing(_plan(spark, d), _present(spark, d)))
query(f"SELECT p.* FROM ({_PLAN}) p SEMI JOIN ({_PRESENT}) f USING (year, month)", "plan_present_months")(lambda spark, d: months.plan_present(_plan(spark, d), _present(spark, d)))
query(f"SELECT p.year, p.month, CASE WHEN f.path IS NULL THEN 'fetch' ELSE 'overwrite' END AS status FROM ({_PLAN}) p LEFT JOIN ({_PRESENT}) f USING (year, month)", "plan_overwrite_all")(lambda spark, d: months.plan_by_policy(_plan(spark, d), _present(spark, d), "overwrite_all"))
query(f"SELECT status, COUNT(*) AS n FROM (SELECT CASE WHEN f.path IS NULL THEN 'fetch' ELSE 'skip' END AS status FROM ({_PLAN}) p LEFT JOIN ({_PRESENT}) f USING (year, month)) GROUP BY 1", "status_counts")(lambda spark, d: months.plan_by_policy(_plan(spark, d), _present(spark, d), "skip_all").groupBy("status").agg(F.count("*").alias("n")))
query(f"SELECT status, COUNT(*) AS n, list_aggregate((list(name ORDER BY name))[1:2], 'string_agg', ', ') || CASE WHEN COUNT(*) > 2 THEN ' and ' || (COUNT(*) - 2) || ' more' ELSE '' END AS line FROM (SELECT CASE WHEN f.path IS NULL THEN 'fetch' ELSE 'skip' END AS status, p.year || '-' || lpad(CAST(p.month AS VARCHAR), 2, '0') AS name FROM ({_PLAN}) p LEFT JOIN ({_PRESENT}) f USING (year, month)) GROUP BY 1", "status_report")(lambda spark, d: months.status_report(months.plan_by_policy(_plan(spark, d), _present(spark, d), "skip_all"), 2))
query(_PLANS, "month_plan")(lambda spark, d: _plans(spark, d))
query(f"SELECT year, month, list_transform(range(1, CAST(day(last_day(make_date(year, month, 1))) AS BIGINT) + 1), lambda d: lpad(CAST(d AS VARCHAR), 2, '0')) AS days FROM ({_PLAN})", "month_days")(lambda spark, d: months.month_days(_plan(spark, d)))


@query(f"SELECT id, m AS month_start, LEAST(m + INTERVAL 1 MONTH, e) AS month_end FROM (SELECT id, e, unnest(generate_series(date_trunc('month', s), e, INTERVAL 1 MONTH)) AS m FROM {_ASKED_SQL})")
def month_ranges(spark, d):
    return months.month_ranges(_asked_spans(spark, d)).drop("start", "end")


@query(SQL + f"SELECT timestamp, {_round_sql(GRID_COLUMNS)} FROM grid")
def sink_month_roundtrip(spark, d):
    """Written by month, read back."""
    path = shared_folder(spark, "months")
    tables.write_by_month(X.grid(spark, d), path)
    return rounded(spark.read.parquet(path).select("timestamp", *GRID_COLUMNS.split()))


@query(SQL + "SELECT CAST(year(timestamp) AS INT) AS year, COUNT(*) AS n, ROUND(SUM(tons_co2), 4) AS tons_co2 FROM grid GROUP BY 1")
def export_by_year(spark, d):
    path = shared_folder(spark, "years")
    tables.export_by_year(X.grid(spark, d), path)
    return spark.read.parquet(path).groupBy(F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n"), r6(F.sum("tons_co2"), 4).alias("tons_co2"))


@query(SQL + f"SELECT timestamp, {_round_sql(GRID_COLUMNS)} FROM grid UNION ALL SELECT timestamp + INTERVAL 400 DAY, {_round_sql(GRID_COLUMNS)} FROM grid")
def month_files_roundtrip(spark, d):
    """Months replaced as a whole by the Python sink: two sets of months, the first written twice, read back."""
    from .sources.month_files import MonthFiles

    spark.dataSource.register(MonthFiles)
    path, grid = shared_folder(spark, "month_files"), X.grid(spark, d)
    later = grid.withColumn("timestamp", F.timestamp_add("DAY", F.lit(400), "timestamp").cast("timestamp_ntz"))
    for rows in (grid.where("hour(timestamp) < 12"), later, grid):
        rows.write.format("month_files").mode("overwrite").option("path", path).save()
    return rounded(spark.read.parquet(path).select("timestamp", *GRID_COLUMNS.split()))


@query("SELECT year, month, n_rows, DENSE_RANK() OVER (ORDER BY year, month) AS place FROM (SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, COUNT(*) AS n_rows FROM (SELECT ts + INTERVAL (40 * (user_id % 9)) DAY AS ts FROM events) GROUP BY 1, 2)")
def discover_sorted(spark, d):
    """Files of months as a sorted listing, joined with the rows that each of them holds."""
    path = shared_folder(spark, "listing")
    shifted = F.timestamp_add("DAY", (40 * (F.col("user_id") % 9)).cast("int"), "ts").cast("timestamp_ntz")
    tables.write_by_month(X.events(spark, d).select("event_id", shifted.alias("timestamp")), path)
    held = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    months_ = tables.discover(spark, path).join(held, "path").groupBy("year", "month").agg(F.sum("n").alias("n_rows"))
    return months_.select("year", "month", "n_rows", F.dense_rank().over(Window.orderBy("year", "month")).cast("long").alias("place"))


_LOGGED = "SELECT '{0}' AS step, '{1}' AS status, {2} AS rows_in, {3} AS rows_out, {4} AS rows_rejected, {5} AS first, {6} AS last, 'events' AS source FROM events"


@query(
    " UNION ALL ".join(
        (
            _LOGGED.format("keep", "success", "COUNT(*)", "SUM(CASE WHEN value >= 20 THEN 1 ELSE 0 END)::BIGINT", "SUM(CASE WHEN value >= 20 THEN 0 ELSE 1 END)::BIGINT", "MIN(CASE WHEN value >= 20 THEN ts END)", "MAX(CASE WHEN value >= 20 THEN ts END)"),
            _LOGGED.format("hourly", "success", "COUNT(*)", "COUNT(DISTINCT date_trunc('hour', ts))", "0", "MIN(ts)", "MAX(ts)"),
            _LOGGED.format("broken", "failed", "NULL", "NULL", "NULL", "NULL", "NULL") + " LIMIT 1",
            "SELECT 'nothing', 'skipped', NULL, NULL, NULL, NULL, NULL, 'events'",
        )
    ).replace(" UNION ALL SELECT 'broken'", " UNION ALL (SELECT 'broken'").replace("LIMIT 1", "LIMIT 1)")
)
def run_log(spark, d):
    """Four steps of a run over events and what the run table tells of them: one rejects rows, one aggregates, one fails, one is skipped."""
    from .runs import RunLog, history

    out, events = shared_folder(spark, "run"), X.events(spark, d)
    log = RunLog(spark, f"{out}/log", source="events", least=20)
    log.step("keep", events, lambda df: tables.write_by_month(df, f"{out}/kept", "ts"), valid=F.col("value") >= 20, time="ts")
    log.step("hourly", events, lambda df: df.write.parquet(f"{out}/hourly"), lambda df: df.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("value")), time="ts")
    try:
        log.step("broken", events, lambda df: df.write.parquet(f"{out}/hourly"))
    except Exception:  # the folder exists; the log has the error
        log.skipped("nothing")
    log.save()
    return history(spark, f"{out}/log").select("step", "status", "rows_in", "rows_out", "rows_rejected", "first", "last", F.col("parameters")["source"].alias("source"))


# Projections, filters and profiles.

def _written(*texts: str) -> str:
    """SQL, for both sides, of a text for each event, by its number: one of the expressions."""
    return "CASE event_id % " + str(len(texts)) + "".join(f" WHEN {k} THEN {t}" for k, t in enumerate(texts)) + " END"


def _stamp(spark_format: str, duck_format: str) -> tuple[str, str]:
    return f"date_format(ts, '{spark_format}')", f"strftime(ts, '{duck_format}')"


def _both(*texts: str | tuple[str, str]) -> tuple[str, str]:
    return tuple(_written(*(t if isinstance(t, str) else t[side] for t in texts)) for side in (0, 1))


_DAY, _MONTH = _stamp("yyyy-MM-dd", "%Y-%m-%d"), _stamp("yyyy-MM", "%Y-%m")
_STAMPS = _both(_stamp("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), _stamp("yyyy/MM/dd HH:mm:ss", "%Y/%m/%d %H:%M:%S"), "'2024-02-30 00:00:00'", "'2024-1-1 0:0:0'", "''")


@query(f"SELECT event_id, CASE WHEN regexp_matches(text, '^\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}$') THEN TRY_CAST(text AS TIMESTAMP) END AS ts FROM (SELECT event_id, {_STAMPS[1]} AS text FROM events)")
def parse_timestamp(spark, d):
    rows = X.events(spark, d).selectExpr("event_id", f"{_STAMPS[0]} AS text")
    return rows.select("event_id", F.try_to_timestamp("text", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("ts"))


query("SELECT MIN(ts) AS min_ts, MAX(ts) AS max_ts FROM events", "minmax_ts")(lambda spark, d: X.events(spark, d).agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts")))
query("SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'", "filter_time_range")(lambda spark, d: X.events(spark, d).where("ts >= timestamp_ntz'2024-01-05' and ts < timestamp_ntz'2024-01-06'").select("event_id", "ts", "value"))
query(SQL + "SELECT cell, valid_time FROM weather WHERE latitude BETWEEN 6.55 AND 6.75 AND longitude BETWEEN 68.05 AND 68.3", "filter_bbox")(lambda spark, d: X.weather(spark, d).where(tables.in_box(6.75, 68.05, 6.55, 68.3)).select("cell", "valid_time"))
_ROUND_THE_WORLD = ("5 * cell - 20", "CASE WHEN 174 + cell > 180 THEN cell - 186 ELSE 174 + cell END")
query(SQL + f"SELECT cell, valid_time FROM (SELECT cell, valid_time, {_ROUND_THE_WORLD[0]} AS lat, {_ROUND_THE_WORLD[1]} AS lon FROM weather) WHERE lat BETWEEN -10 AND 30 AND (lon >= 176 OR lon <= -177)", "filter_bbox_antimeridian")(lambda spark, d: X.weather(spark, d).selectExpr("cell", "valid_time", f"{_ROUND_THE_WORLD[0]} AS latitude", f"{_ROUND_THE_WORLD[1]} AS longitude").where(tables.in_box(30, 176, -10, -177)).select("cell", "valid_time"))
query(SQL + "SELECT cell, valid_time FROM weather WHERE (longitude - 67.99) + (latitude - 6.49) <= 0.35", "trim_region")(lambda spark, d: X.weather(spark, d).where(tables.in_polygon([(6.49, 67.99), (6.49, 68.34), (6.84, 67.99)])).select("cell", "valid_time"))
query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 5", "head_rows")(lambda spark, d: X.events(spark, d).select("event_id", "ts").orderBy("ts", "event_id").limit(5))
query("SELECT event_id, ts FROM events ORDER BY ts DESC LIMIT 5", "tail_rows")(lambda spark, d: tables.tail(X.events(spark, d).select("event_id", "ts"), 5, "ts"))
query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 10 OFFSET 20", "slice_rows")(lambda spark, d: X.events(spark, d).select("event_id", "ts").orderBy("ts", "event_id").offset(20).limit(10))


@query("SELECT CAST(k AS BIGINT) AS k, v FROM (SELECT o_custkey AS k, o_totalprice AS v FROM orders UNION ALL SELECT c_nationkey, c_acctbal FROM customer)")
def union_relaxed(spark, d):
    a = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("k"), F.col("o_totalprice").alias("v"))
    b = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_nationkey").alias("k"), F.col("c_acctbal").alias("v"))
    return tables.union_relaxed([a, b])


@query("SELECT ts, MIN(event_id) AS event_id FROM (SELECT date_trunc('hour', ts) AS ts, event_id FROM events UNION ALL SELECT date_trunc('hour', ts), event_id FROM events WHERE value > 50) GROUP BY 1")
def dedupe_ts(spark, d):
    rows = X.events(spark, d).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_id", "value")
    return tables.dedupe(rows.union(rows.where("value > 50")), "ts", "event_id").select("ts", "event_id")


@query("SELECT event_id, ts AS timestamp, value FROM events")
def compact_sorted(spark, d):
    rows = X.events(spark, d).select("event_id", F.col("ts").alias("timestamp"), "value")
    return tables.compact_sorted([rows.where("timestamp < timestamp_ntz'2024-01-15'"), rows.where("timestamp >= timestamp_ntz'2024-01-15'")])


_DESCRIBE = "SELECT '{0}' AS variable, COUNT({0}) AS n, COUNT(*) - COUNT({0}) AS n_null, ROUND(AVG({0}), 6) AS mean, ROUND(STDDEV_SAMP({0}), 6) AS std, ROUND(MIN({0}), 6) AS min, ROUND(QUANTILE_CONT({0}, 0.25), 6) AS q25, ROUND(QUANTILE_CONT({0}, 0.5), 6) AS median, ROUND(QUANTILE_CONT({0}, 0.75), 6) AS q75, ROUND(MAX({0}), 6) AS max FROM grid"
query(SQL + " UNION ALL ".join(_DESCRIBE.format(c) for c in ("tons_co2", "demand_met", "net_demand")), "describe_numeric")(lambda spark, d: rounded(tables.describe(X.grid(spark, d), ["tons_co2", "demand_met", "net_demand"])))
query(SQL + " UNION ALL ".join(f"SELECT '{c}' AS variable, COUNT(*) AS n, ROUND(MIN({c}), 6) AS min, ROUND(MAX({c}), 6) AS max, ROUND(AVG({c}), 6) AS mean FROM weather" for c in ("t2m", "u10", "tp")), "var_stats")(lambda spark, d: rounded(tables.describe(X.weather(spark, d), ["t2m", "u10", "tp"]).select("variable", "n", "min", "max", "mean")))
query("SELECT 'value' AS variable, COUNT(*) AS n_rows, COUNT(*) FILTER (value > 90) AS n_null FROM events UNION ALL SELECT 'event_type', COUNT(*), COUNT(*) FILTER (event_type = 'error') FROM events", "profile_nulls")(lambda spark, d: tables.profile_nulls(X.events(spark, d).select(F.when(F.col("value") <= 90, F.col("value")).alias("value"), F.nullif("event_type", F.lit("error")).alias("event_type")), ["value", "event_type"]))

# Scalars.

_LISTS = "(1, '2m_temperature, Total_Precipitation '), (2, 'snowfall,2m_temperature'), (3, ' '), (4, '\"Snow_Depth\"')"
_PARSED = "list_transform(list_filter(list_transform(string_split(v, ','), lambda x: trim(x)), lambda x: x <> ''), lambda x: trim(trim(lower(x), '\"'), ''''))"
_DENY = "[" + ", ".join(f"'{v}'" for v in K.DENIED_WORLD) + "]"
_LISTS_SQL = f"(VALUES {_LISTS}) t(id, v)"


def _lists(spark):
    return values(spark, "id, v", _LISTS).select("id", S.parse_variables(F.col("v")).alias("names"))


query(f"SELECT id, {_PARSED} AS names FROM {_LISTS_SQL}", "parse_variables")(lambda spark, d: _lists(spark))
query(f"SELECT id, len({_PARSED}) > 0 AND NOT list_has_any({_PARSED}, {_DENY}) AS ok FROM {_LISTS_SQL}", "variables_deny")(lambda spark, d: _lists(spark).select("id", S.variables_denied(F.col("names"), K.DENIED_WORLD).alias("ok")))
query(f"SELECT id, len({_PARSED}) > 0 AND list_has_all(['2m_temperature', 'total_precipitation'], {_PARSED}) AS ok FROM {_LISTS_SQL}", "variables_allow")(lambda spark, d: _lists(spark).select("id", S.variables_allowed(F.col("names"), ("2m_temperature", "total_precipitation")).alias("ok")))
query(f"SELECT id, x AS name FROM (SELECT id, unnest({_PARSED}) AS x FROM {_LISTS_SQL}) WHERE NOT list_contains({_DENY}, x)", "variables_filter_valid")(lambda spark, d: _lists(spark).select("id", F.explode("names").alias("name")).join(spark.createDataFrame([(v,) for v in K.DENIED_WORLD], "name string"), "name", "left_anti").select("id", "name"))
#: Boxes by the number of each event, many of them out of range.
_BOXES = "event_id AS id, (event_id % 200 - 94.5) * 1.0 AS n, (event_id * 7 % 380 - 189.75) * 1.0 AS w, (event_id * 3 % 190 - 95) * 1.0 AS s, (event_id * 11 % 380 - 190) * 1.0 AS e"
query(f"SELECT id, n BETWEEN -90 AND 90 AND s BETWEEN -90 AND 90 AND w BETWEEN -180 AND 180 AND e BETWEEN -180 AND 180 AND n > s AS ok FROM (SELECT {_BOXES} FROM events)", "valid_coordinates")(lambda spark, d: _boxes(spark, d).select("id", S.valid_coordinates(*map(F.col, "nwse")).alias("ok")))
query(f"SELECT id, 'N' || CAST(trunc(n) AS INT) || 'W' || CAST(trunc(w) AS INT) || 'S' || CAST(trunc(s) AS INT) || 'E' || CAST(trunc(e) AS INT) AS name FROM (SELECT {_BOXES} FROM events)", "format_nwse")(lambda spark, d: _boxes(spark, d).select("id", S.format_nwse(*map(F.col, "nwse")).alias("name")))


def _boxes(spark, d):
    return X.events(spark, d).selectExpr(*_BOXES.split(", ")).select("id", *(F.col(c).cast("double").alias(c) for c in "nwse"))


_DATES = _both(_DAY, "'2023-02-29'", _MONTH, "'2024-13'", "'24-01-01'", (f"concat({_DAY[0]}, 'x')", f"{_DAY[1]} || 'x'"), "''")
query(f"SELECT event_id, regexp_matches(text, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND TRY_CAST(text AS DATE) IS NOT NULL AS is_date, (regexp_matches(text, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND TRY_CAST(text AS DATE) IS NOT NULL) OR (regexp_matches(text, '^\\d{{4}}-\\d{{2}}$') AND TRY_CAST(text || '-01' AS DATE) IS NOT NULL) AS is_date_or_month FROM (SELECT event_id, {_DATES[1]} AS text FROM events)", "validate_date")(lambda spark, d: X.events(spark, d).selectExpr("event_id", f"{_DATES[0]} AS text").select("event_id", S.validate_date(F.col("text")).alias("is_date"), S.validate_date(F.col("text"), True).alias("is_date_or_month")))
_FORMS = _both(_DAY, _MONTH, "'2023-12'")
query(f"SELECT event_id, CAST(CASE length(text) WHEN 7 THEN text || '-01' ELSE text END AS DATE) AS first, CASE length(text) WHEN 7 THEN last_day(CAST(text || '-01' AS DATE)) ELSE CAST(text AS DATE) END AS last FROM (SELECT event_id, {_FORMS[1]} AS text FROM events)", "parse_date_defaults")(lambda spark, d: X.events(spark, d).selectExpr("event_id", f"{_FORMS[0]} AS text").select("event_id", S.parse_date(F.col("text")).alias("first"), S.parse_date(F.col("text"), True).alias("last")))
query("SELECT event_id, CAST(LEAST(e, DATE '2024-06-20' - 8) AS DATE) AS clamped FROM (SELECT event_id, CAST(ts AS DATE) + CAST(event_id % 300 AS INT) AS e FROM events)", "clamp_end_date")(lambda spark, d: X.events(spark, d).select("event_id", S.clamp_end_date(F.date_add(F.to_date("ts"), (F.col("event_id") % 300).cast("int")), F.lit("2024-06-20").cast("date")).alias("clamped")))
_SPELLINGS = _written("' ERA5 '", "'Copernicus Climate'", "'om'", "event_type", "'2'")
query(f"SELECT event_id, CASE lower(trim(v)) WHEN 'era5' THEN 'cds' WHEN 'copernicus climate' THEN 'cds' WHEN 'om' THEN 'open-meteo' WHEN '2' THEN 'open-meteo' ELSE v END AS provider, CASE lower(trim(v)) WHEN 'era5' THEN 'era5-world' WHEN '2' THEN 'era5-world' ELSE v END AS dataset FROM (SELECT event_id, {_SPELLINGS} AS v FROM events)", "normalize_alias")(lambda spark, d: X.events(spark, d).selectExpr("event_id", f"{_SPELLINGS} AS v").select("event_id", S.normalize_alias(F.col("v"), K.PROVIDERS).alias("provider"), S.normalize_alias(F.col("v"), K.DATASETS).alias("dataset")))
query(r"""SELECT id, substr(md5(ds || '|[''' || array_to_string(list_sort(names), ''', ''') || ''']|[' || b || ']'), 1, 12) AS hash FROM (VALUES (1, 'era5-land', ['tp', 'a', '2m'], '37.5, 68.0, 6.0, 98.0'), (2, 'era5-world', ['x'], '-1.25, -180.0, -9.5, 0.1')) t(id, ds, names, b)""", "request_hash")(lambda spark, d: values(spark, "id, ds, names, b", "(1, 'era5-land', array('tp', 'a', '2m'), array(37.5D, 68.0D, 6.0D, 98.0D)), (2, 'era5-world', array('x'), array(-1.25D, -180.0D, -9.5D, 0.1D))").select("id", S.request_hash(F.col("ds"), F.col("names"), F.col("b")).alias("hash")))
_SECONDS = "event_id * 7919 % 800000 / 8.0 - 3"
query(f"SELECT event_id, CASE WHEN d > 0 THEN printf('%dd %dh %dm %.2fs', d, h % 24, m, r) WHEN h > 0 THEN printf('%dh %dm %.2fs', h, m, r) WHEN m > 0 THEN printf('%dm %.2fs', m, r) ELSE printf('%.5fs', r) END AS text FROM (SELECT event_id, CAST(s AS DOUBLE) AS s, CAST(floor(p / 86400) AS BIGINT) AS d, CAST(floor(p / 3600) AS BIGINT) AS h, CAST(floor((p % 3600) / 60) AS BIGINT) AS m, CAST(p % 60 AS DOUBLE) AS r FROM (SELECT event_id, s, GREATEST(s, 0) AS p FROM (SELECT event_id, {_SECONDS} AS s FROM events)))", "format_duration")(lambda spark, d: X.events(spark, d).selectExpr("event_id", f"CAST({_SECONDS} AS DOUBLE) AS s").select("event_id", S.format_duration(F.col("s")).alias("text")))
_ASKS = "(1, 2, 37.5, 68.0, 6.5, 98.0, 0.25, 1.0), (2, 30, 37.5, 68.0, 6.5, 98.0, 0.1, 1.0), (3, 1, 10.0, 170.0, 5.0, -170.0, 0.25, 3.0), (4, 1, 1.0, 1.0, 0.9, 1.1, 0.25, 1.0), (5, 0, 1.0, 0.0, 0.0, 1.0, 0.25, 1.0)"
_ASKS_SQL = f"(SELECT id, k, n::DOUBLE AS n, w::DOUBLE AS w, s::DOUBLE AS s, e::DOUBLE AS e, r::DOUBLE AS r, h::DOUBLE AS h, CASE WHEN e > w THEN e - w ELSE 360 + e - w END::DOUBLE AS span FROM (VALUES {_ASKS}) t(id, k, n, w, s, e, r, h))"
_SIZE = "CASE WHEN k > 0 THEN ROUND(GREATEST(0.509::DOUBLE * (k / 2) * ((n - s) * span / 6) * pow(0.25::DOUBLE / r, 2) / h, 0.05::DOUBLE), 3) ELSE 0 END"


def _asks(spark):
    return values(spark, "id, k, n, w, s, e, r, h", _ASKS).select("id", "k", *(F.col(c).cast("double").alias(c) for c in "nwserh"))


_ASKED = "k n w s e r h".split()
query(f"SELECT id, {_SIZE} AS mb FROM {_ASKS_SQL}", "estimate_file_size")(lambda spark, d: _asks(spark).select("id", S.estimate_file_size(*map(F.col, _ASKED)).alias("mb")))


@query(f"SELECT id, COUNT(*) AS months, ROUND(SUM(mb), 3) AS total_mb, ROUND(MAX(sec), 1) AS longest, ROUND(SUM(sec), 1) AS total, ROUND(SUM(sec) / (4 * 0.6::DOUBLE), 1) AS parallel FROM (SELECT id, mb, (30 + GREATEST(ceil(GREATEST(n - s, 0) / r), 1) * GREATEST(ceil(span / r), 1) * floor(24 / h * day(last_day(m))) * GREATEST(k, 1) / 8e6::DOUBLE + mb / 3.125::DOUBLE) * 5 AS sec FROM (SELECT *, {_SIZE} AS mb FROM {_ASKS_SQL}), (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-04-01', INTERVAL 1 MONTH)) AS m)) GROUP BY id")
def estimate_download(spark, d):
    plan = months.month_plan(_asks(spark).withColumns({"start": F.lit("2024-01-10").cast("date"), "end": F.lit("2024-04-02").cast("date")}))
    days = F.day(F.last_day(F.make_date("year", "month", F.lit(1))))
    each = plan.select("id", S.estimate_file_size(*map(F.col, _ASKED)).alias("mb"), S.estimate_month_seconds(*map(F.col, _ASKED), days, F.lit(25.0)).alias("sec"))
    return each.groupBy("id").agg(F.count("*").alias("months"), r6(F.sum("mb"), 3).alias("total_mb"), r6(F.max("sec"), 1).alias("longest"), r6(F.sum("sec"), 1).alias("total"), r6(S.parallel_seconds(F.sum("sec"), F.lit(4)), 1).alias("parallel"))


query("SELECT event_id, LEAST(GREATEST(a, 0), 20) AS retries, LEAST(GREATEST(a * 1000, 0), 3600) AS delay, LEAST(GREATEST(a, 1), 8) AS parallel FROM (SELECT event_id, event_id % 40 - 5 AS a FROM events)", "clamp_settings")(lambda spark, d: X.events(spark, d).selectExpr("event_id", "event_id % 40 - 5 AS a").select("event_id", *(c.alias(n) for c, n in zip(S.clamp_settings(F.col("a"), F.col("a") * 1000, F.col("a")), ("retries", "delay", "parallel")))))
query("SELECT * FROM (VALUES (1, [37.5, 68, 6, 98]::DOUBLE[]), (2, [1, 2, 0, 3]::DOUBLE[]), (3, [9, 8, 7, 6]::DOUBLE[]), (4, [4, 3, 2, 1]::DOUBLE[]), (5, NULL)) t(id, bounds)", "extract_bounds")(lambda spark, d: values(spark, "id, config", """(1, '{"region_bounds":[37.5,68,6,98]}'), (2, '{"bounds":{"north":1,"west":2,"south":0,"east":3}}'), (3, '{"area":{"n":9,"w":8,"s":7,"e":6}}'), (4, '{"north":4,"west":3,"south":2,"east":1}'), (5, '{"bounds":[1,2]}')""").select("id", S.extract_bounds(F.col("config")).alias("bounds")))
query("SELECT 'grid-data_2024_02.parquet' AS monthly, 'grid-data_2018-11_2026-02.parquet' AS combined", "output_names")(lambda spark, d: spark.range(1).select(S.month_file_name("grid-data", F.lit("2024-02-03").cast("date")).alias("monthly"), S.combined_file_name("grid-data", F.lit("2018-11-21").cast("date"), F.lit("2026-02-01").cast("date")).alias("combined")))
query("SELECT event_id, timezone('Asia/Kolkata', timezone('UTC', ts)) AS local_ts FROM events", "tz_convert")(lambda spark, d: X.events(spark, d).select("event_id", S.convert_zone(F.col("ts")).alias("local_ts")))
query("SELECT r, CASE WHEN r >= 0.6 THEN 'high' WHEN r >= 0.4 THEN 'medium' WHEN r IS NOT NULL THEN 'low' END AS label FROM (SELECT CAST(value / 100 AS DOUBLE) AS r FROM events)", "confidence_label")(lambda spark, d: X.events(spark, d).select((F.col("value") / 100).alias("r")).withColumn("label", S.confidence_label(F.col("r"))))

# Regions.


def _regions(spark, d):
    """A box for each nation, and one ring that is no box."""
    k = F.col("n_nationkey")
    south, west, tall, wide = 3 * k - 30 + 0.3, 7 * (k % 5) - 0.45, 0.5 + k % 4, 0.2 + k % 3
    corner = lambda y, x: F.struct(y.cast("double").alias("y"), x.cast("double").alias("x"))
    ring = F.array(corner(south, west), corner(south, west + wide), corner(south + tall, west + wide), corner(south + tall, west))
    return spark.read.parquet(f"{d}/nation.parquet").select(k.alias("region"), ring.alias("ring"))


@query("""WITH boxes AS (SELECT n_nationkey AS region, (3 * n_nationkey - 30 + 0.3)::DOUBLE AS s, (7 * (n_nationkey % 5) - 0.45)::DOUBLE AS w, (0.5 + n_nationkey % 4)::DOUBLE AS t, (0.2 + n_nationkey % 3)::DOUBLE AS b FROM nation),
cells AS (SELECT *, unnest(range(floor(s / 0.25)::BIGINT, ceil((s + t) / 0.25)::BIGINT + 1)) AS row FROM boxes), squares AS (SELECT *, unnest(range(floor(w / 0.25)::BIGINT, ceil((w + b) / 0.25)::BIGINT + 1)) AS col FROM cells),
areas AS (SELECT *, GREATEST(LEAST(s + t, (row + 1) * 0.25::DOUBLE) - GREATEST(s, row * 0.25::DOUBLE), 0) * GREATEST(LEAST(w + b, (col + 1) * 0.25::DOUBLE) - GREATEST(w, col * 0.25::DOUBLE), 0) AS area FROM squares)
SELECT region, CAST(row AS INT) AS row, CAST(col AS INT) AS col, ROUND(area, 9) AS area, ROUND(area / (t * b), 9) AS weight FROM areas WHERE area > 1e-9""")
def region_weights(spark, d):
    """The cells of a quarter of a degree that each nation's box covers, and their shares."""
    return rounded(regions.cell_weights(_regions(spark, d), 0.25), 9).where("area > 1e-9")


# Features.

query("SELECT event_id, ROUND(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, ROUND(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos, ROUND(sin(2 * pi() * dayofyear(ts) / 365.25::DOUBLE), 6) AS doy_sin, ROUND(cos(2 * pi() * dayofyear(ts) / 365.25::DOUBLE), 6) AS doy_cos, dayofweek(ts) IN (0, 6) AS is_weekend FROM events", "time_features")(lambda spark, d: rounded(X.events(spark, d).select("event_id", *(c.alias(n) for n, c in FE.time_features(F.col("ts")).items()))))
query(SQL + "SELECT cell, valid_time, ROUND(sqrt(u10 * u10 + v10 * v10), 6) AS wind_speed, ROUND(u10 / NULLIF(sqrt(u10 * u10 + v10 * v10), 0), 6) AS wind_dir_sin, ROUND(v10 / NULLIF(sqrt(u10 * u10 + v10 * v10), 0), 6) AS wind_dir_cos FROM weather", "wind_features")(lambda spark, d: rounded(X.weather(spark, d).select("cell", "valid_time", *(c.alias(n) for n, c in FE.wind_features(F.col("u10"), F.col("v10")).items()))))
query(SQL + "SELECT timestamp, ROUND(hydro_generation / NULLIF(total_generation, 0), 6) AS hydro_share, total_generation * 1000 > 200000 AS is_sunny FROM grid", "mix_features")(lambda spark, d: rounded(X.grid(spark, d).select("timestamp", FE.hydro_share(F.col("hydro_generation"), F.col("total_generation")).alias("hydro_share"), FE.is_sunny(F.col("total_generation") * 1000).alias("is_sunny"))))
query(SQL + "SELECT cell, valid_time, ROUND(ln(1 + GREATEST(ssrd, 0)), 6) AS log_ssrd FROM weather", "log1p_solar")(lambda spark, d: rounded(X.weather(spark, d).select("cell", "valid_time", FE.log1p_solar(F.col("ssrd")).alias("log_ssrd"))))
query(SQL + "SELECT timestamp, ROUND(demand_met - renewable_generation, 6) AS net_load FROM grid", "net_load")(lambda spark, d: rounded(X.grid(spark, d).select("timestamp", FE.net_load(F.col("demand_met"), F.col("renewable_generation")).alias("net_load"))))
query(SQL + "SELECT timestamp, ROUND((total_generation - m) / s, 6) AS z FROM grid, (SELECT AVG(total_generation) AS m, STDDEV_SAMP(total_generation) AS s FROM grid)", "standardize_q")(lambda spark, d: _standardized(X.grid(spark, d)))


def _standardized(df):
    mean, std = df.agg(F.avg("total_generation"), F.stddev_samp("total_generation")).first()
    return rounded(df.select("timestamp", ((F.col("total_generation") - F.lit(mean)) / F.nullif(F.lit(std), F.lit(0.0))).alias("z")))


# Series.

_MEANS = ", ".join(f"ROUND(AVG({c}), 6) AS {c}" for c in series.MEANS)
_RESAMPLE = "SELECT time_bucket(INTERVAL '{0}', timestamp) AS timestamp, " + _MEANS + ", ROUND(SUM(tons_co2), 6) AS tons_co2, ROUND(SUM(g_co2_per_kwh * total_generation) / NULLIF(SUM(total_generation) FILTER (g_co2_per_kwh IS NOT NULL), 0), 6) AS g_co2_per_kwh, ROUND(SUM(tons_co2_per_mwh * total_generation) / NULLIF(SUM(total_generation) FILTER (tons_co2_per_mwh IS NOT NULL), 0), 6) AS tons_co2_per_mwh FROM grid5 GROUP BY 1"
for _name, _step in (("resample_30min", "30 minutes"), ("resample_60min", "60 minutes")):
    query(SQL + _RESAMPLE.format(_step), _name)(lambda spark, d, step=_step: rounded(series.resample_grid(X.grid(spark, d, "5 minutes"), step)))
_SPINE = "(SELECT unnest(generate_series(a, b, INTERVAL 5 MINUTE)) AS timestamp FROM (SELECT MIN(timestamp) AS a, MAX(timestamp) AS b FROM grid5))"
query(SQL + f"SELECT timestamp, ROUND(g.tons_co2, 6) AS tons_co2 FROM {_SPINE} LEFT JOIN grid5 g USING (timestamp)", "gap_spine")(lambda spark, d: rounded(series.fill_spine(_five(spark, d).select("timestamp", "tons_co2"), "5 minutes")))
query(SQL + f"SELECT timestamp FROM {_SPINE} ANTI JOIN grid5 USING (timestamp)", "gap_report")(lambda spark, d: series.gap_report(_five(spark, d), "5 minutes"))
query(SQL + "SELECT * FROM (SELECT cell, valid_time AS gap_end, lag(valid_time) OVER w AS gap_start, CAST(epoch(valid_time) - epoch(lag(valid_time) OVER w) AS BIGINT) AS gap_seconds FROM weather WINDOW w AS (PARTITION BY cell ORDER BY valid_time)) WHERE gap_seconds > 3600", "gap_detect")(lambda spark, d: series.detect_gaps(X.weather(spark, d), 3600, "valid_time", ("cell",)))
query(SQL + f"SELECT timestamp, ROUND(last_value(tons_co2 IGNORE NULLS) OVER (ORDER BY timestamp), 6) AS tons_co2 FROM (SELECT timestamp, g.tons_co2 FROM {_SPINE} LEFT JOIN grid5 g USING (timestamp))", "gap_fill_ffill")(lambda spark, d: rounded(series.fill_forward(series.fill_spine(_five(spark, d).select("timestamp", "tons_co2"), "5 minutes"), "tons_co2")))
query(SQL + f"SELECT timestamp, ROUND(COALESCE(v, x + (y - x) * (epoch(timestamp) - a) / NULLIF(b - a, 0)), 9) AS tons_co2 FROM (SELECT timestamp, v, last_value(v IGNORE NULLS) OVER p AS x, first_value(v IGNORE NULLS) OVER n AS y, last_value(k IGNORE NULLS) OVER p AS a, first_value(k IGNORE NULLS) OVER n AS b FROM (SELECT timestamp, g.tons_co2 AS v, CASE WHEN g.tons_co2 IS NOT NULL THEN epoch(timestamp) END AS k FROM {_SPINE} LEFT JOIN grid5 g USING (timestamp)) WINDOW p AS (ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))", "gap_fill_linear")(lambda spark, d: rounded(series.fill_linear(series.fill_spine(_five(spark, d).select("timestamp", "tons_co2"), "5 minutes"), "tons_co2"), 9))
query(SQL + "SELECT CAST(date_trunc('month', timestamp) AS DATE) AS month, COUNT(DISTINCT timestamp) AS n_rows, CAST(day(last_day(MIN(timestamp))) * 288 AS BIGINT) AS n_expected, ROUND(COUNT(DISTINCT timestamp) / (day(last_day(MIN(timestamp))) * 288), 6) AS ratio FROM grid5 GROUP BY 1", "completeness")(lambda spark, d: rounded(series.completeness(_five(spark, d), 300)))
query(SQL + "SELECT cell, valid_time, ROUND(tp_step, 6) AS step FROM weather", "deaccumulate")(lambda spark, d: rounded(series.deaccumulate(X.weather(spark, d), "tp", "step", ("cell",), F.to_date("valid_time")).select("cell", "valid_time", "step")))
query(SQL + "SELECT cell, valid_time + i * INTERVAL 30 MINUTE AS valid_time, ROUND(t2m, 6) AS t2m, ROUND(tp_step / 2, 6) AS tp_step FROM weather, range(2) t(i)", "disaggregate_30min")(lambda spark, d: rounded(series.halve_hours(X.weather(spark, d), ("t2m",), ("tp_step",)).select("cell", "valid_time", "t2m", "tp_step")))
query(SQL + "SELECT valid_time, ROUND(AVG(t2m), 9) AS t2m, ROUND(AVG(u10), 9) AS u10 FROM weather GROUP BY 1", "national_weather")(lambda spark, d: rounded(series.regional_mean(X.weather(spark, d), ("t2m", "u10")), 9))
query(SQL + "SELECT valid_time, CAST(floor(ROUND(latitude / 0.25, 6)) AS BIGINT) AS row, CAST(floor(ROUND(longitude / 0.25, 6)) AS BIGINT) AS col, ROUND(AVG(t2m), 9) AS t2m FROM weather GROUP BY ALL", "regrid_coarse")(lambda spark, d: rounded(series.regrid(X.weather(spark, d), ("t2m",), 0.25), 9))
query(SQL + "SELECT valid_time AS timestamp, ROUND(MEDIAN(t2m), 9) AS t2m FROM weather GROUP BY 1", "national_median")(lambda spark, d: rounded(X.weather(spark, d).groupBy(F.col("valid_time").alias("timestamp")).agg(F.median("t2m").alias("t2m")), 9))


def _five(spark, d):
    return X.grid(spark, d, "5 minutes")


# Joins.

query(SQL + "SELECT g.timestamp, w.cell, ROUND(g.tons_co2, 6) AS tons_co2, ROUND(w.t2m, 6) AS t2m FROM grid g JOIN weather w ON g.timestamp = w.valid_time", "join_grid_weather")(lambda spark, d: rounded(X.weather(spark, d).withColumnRenamed("valid_time", "timestamp").join(X.grid(spark, d), "timestamp").select("timestamp", "cell", "tons_co2", "t2m")))
query(SQL + "SELECT a.cell, a.valid_time, ROUND(a.t2m - b.m, 9) AS off FROM weather a JOIN (SELECT valid_time, cell % 4 AS region, AVG(t2m) AS m FROM weather GROUP BY ALL) b ON a.valid_time = b.valid_time AND a.cell % 4 = b.region", "join_time_region")(lambda spark, d: _by_region(X.weather(spark, d).withColumn("region", F.col("cell") % 4)))
query(SQL + "SELECT e.event_id, e.ts AS timestamp, ROUND(g.tons_co2, 6) AS tons_co2, g.timestamp AS matched_at FROM events e ASOF LEFT JOIN grid g ON e.ts >= g.timestamp", "asof_weather")(lambda spark, d: rounded(joins.asof(X.events(spark, d).select("event_id", F.col("ts").alias("timestamp")), X.grid(spark, d), ("tons_co2",)).select("event_id", "timestamp", "tons_co2", "matched_at")))
query(SQL + "SELECT a.cell, a.valid_time, ROUND(COALESCE(CASE WHEN a.t2m < 278 THEN a.t2m END, b.m), 9) AS t2m FROM weather a LEFT JOIN (SELECT valid_time, AVG(t2m) AS m FROM weather GROUP BY 1) b USING (valid_time)", "coalesce_fallback")(lambda spark, d: rounded(joins.fallback(X.weather(spark, d).select("cell", "valid_time", F.when(F.col("t2m") < 278, F.col("t2m")).alias("t2m")), series.regional_mean(X.weather(spark, d), ("t2m",)), ["valid_time"], ("t2m",)).select("cell", "valid_time", "t2m"), 9))
_NEAR = "CAST(floor(ROUND(latitude / 0.25, 6) + 0.5) AS BIGINT) AS row, CAST(floor(ROUND(longitude / 0.25, 6) + 0.5) AS BIGINT) AS col"
query(SQL + f"SELECT f.cell, f.valid_time, ROUND(f.t2m, 9) AS fine, ROUND(c.t2m, 9) AS coarse FROM (SELECT *, {_NEAR} FROM weather) f JOIN (SELECT valid_time, {_NEAR}, AVG(t2m) AS t2m FROM weather GROUP BY ALL) c USING (valid_time, row, col)", "regrid_join")(lambda spark, d: _regrid_join(X.weather(spark, d)))
query(SQL + "SELECT valid_time, ROUND(SUM(t2m * (1 + cell)) / SUM(1 + cell), 9) AS t2m FROM weather WHERE cell < 10 GROUP BY 1", "weighted_weather")(lambda spark, d: rounded(joins.weighted_mean(X.weather(spark, d), spark.range(10).select(F.col("id").alias("cell"), (1 + F.col("id")).cast("double").alias("weight")), ("t2m",), ["cell"]), 9))


def _by_region(df):
    means = df.groupBy("valid_time", "region").agg(F.avg("t2m").alias("m"))
    return rounded(df.join(means, ["valid_time", "region"]).select("cell", "valid_time", (F.col("t2m") - F.col("m")).alias("off")), 9)


def _regrid_join(df):
    keyed = joins.cell_keys(df, 0.25)
    coarse = keyed.groupBy("valid_time", "row", "col").agg(F.avg("t2m").alias("coarse"))
    return rounded(keyed.join(coarse, ["valid_time", "row", "col"]).select("cell", "valid_time", F.col("t2m").alias("fine"), "coarse"), 9)


# Models.

_RAMPS = "(SELECT * FROM (SELECT timestamp, total_generation AS q, tons_co2 AS y, total_generation - lag(total_generation) OVER w AS dq, tons_co2 - lag(tons_co2) OVER w AS dy, epoch(timestamp) - epoch(lag(timestamp) OVER w) AS apart FROM grid WINDOW w AS (ORDER BY timestamp)) WHERE apart = 1800)"
_FIT = "CASE WHEN VAR_POP({1}) > 1e-12 THEN ROUND(COVAR_POP({0}, {1}) / VAR_POP({1}), 6) END AS slope, CASE WHEN VAR_POP({1}) > 1e-12 THEN ROUND(AVG({0}) - COVAR_POP({0}, {1}) / VAR_POP({1}) * AVG({1}), 6) END AS intercept, CASE WHEN VAR_POP({1}) > 1e-12 AND VAR_POP({0}) > 1e-12 THEN ROUND(COVAR_POP({0}, {1}) * COVAR_POP({0}, {1}) / (VAR_POP({1}) * VAR_POP({0})), 6) END AS r2"
_R = "CASE WHEN STDDEV_POP({0}) > 1e-9 AND STDDEV_POP({1}) > 1e-9 THEN ROUND(COVAR_POP({0}, {1}) / (STDDEV_POP({0}) * STDDEV_POP({1})), 6) END"


def _ramps(spark, d):
    return models.ramp_pairs(X.grid(spark, d), 1800)


query(SQL + f"SELECT timestamp, ROUND(q, 6) AS q, ROUND(y, 6) AS y, ROUND(dq, 6) AS dq, ROUND(dy, 6) AS dy FROM {_RAMPS}", "ramp_pairs")(lambda spark, d: rounded(_ramps(spark, d)))
_BINS = SQL + ", cuts AS (SELECT QUANTILE_CONT(net_demand, 0.25) AS a, QUANTILE_CONT(net_demand, 0.5) AS b, QUANTILE_CONT(net_demand, 0.75) AS c FROM grid), binned AS (SELECT *, CAST((net_demand >= a)::INT + (net_demand >= b)::INT + (net_demand >= c)::INT AS INT) AS bin FROM grid, cuts) "


def _binned(spark, d):
    return models.quantile_bins(X.grid(spark, d), "net_demand", 4, "bin")


query(_BINS + "SELECT timestamp, bin FROM binned", "quantile_bins")(lambda spark, d: _binned(spark, d).select("timestamp", "bin"))
query(_BINS + f"SELECT bin, COUNT(*) AS n, {_FIT.format('tons_co2', 'total_generation')} FROM binned GROUP BY 1", "binned_ols")(lambda spark, d: rounded(models.group_ols(_binned(spark, d), "tons_co2", "total_generation", ("bin",))))


@query(_BINS + ", c AS (SELECT bin, tons_co2 AS t, total_generation - AVG(total_generation) OVER (PARTITION BY bin) AS z FROM binned), s AS (SELECT bin, COUNT(*) AS n, SUM(z) AS s1, SUM(z*z) AS s2, SUM(z*z*z) AS s3, SUM(z*z*z*z) AS s4, SUM(t) AS t0, SUM(t*z) AS t1, SUM(t*z*z) AS t2 FROM c GROUP BY 1), e AS (SELECT *, n*(s2*s4-s3*s3) - s1*(s1*s4-s3*s2) + s2*(s1*s3-s2*s2) AS det FROM s) SELECT bin, n, ROUND((n*(t1*s4-t2*s3) - t0*(s1*s4-s3*s2) + s2*(s1*t2-t1*s2)) / det, 5) AS linear, ROUND((n*(s2*t2-s3*t1) - s1*(s1*t2-t1*s2) + t0*(s1*s3-s2*s2)) / det, 5) AS quadratic FROM e")
def binned_ols_quadratic(spark, d):
    return rounded(models.group_quadratic(_binned(spark, d), "tons_co2", "total_generation", ("bin",)), 5)


query(SQL + f"SELECT n, ROUND((w*wxy - wx*wy) / (w*wxx - wx*wx), 6) AS b, ROUND(wy / w - (w*wxy - wx*wy) / (w*wxx - wx*wx) * wx / w, 6) AS a FROM (SELECT COUNT(*) AS n, SUM(abs(dq)) AS w, SUM(abs(dq)*dq) AS wx, SUM(abs(dq)*dy) AS wy, SUM(abs(dq)*dq*dq) AS wxx, SUM(abs(dq)*dq*dy) AS wxy FROM {_RAMPS})", "wls_calibration")(lambda spark, d: rounded(models.weighted_line(_ramps(spark, d), "dy", "dq", F.abs("dq"))))
query(SQL + f"SELECT tau, COUNT(*) AS n, {_R.format('dq', 'dy')} AS r FROM {_RAMPS}, (SELECT unnest([0.0, 25.0, 50.0, 100.0])::DOUBLE AS tau) WHERE abs(dq) >= tau GROUP BY 1", "corr_by_threshold")(lambda spark, d: rounded(models.correlation_by_threshold(_ramps(spark, d), "dq", "dy", "dq", [0.0, 25.0, 50.0, 100.0])))
query(SQL + f"SELECT COUNT(*) AS n, {_R.format('rx', 'ry')} AS rho FROM (SELECT rank() OVER (ORDER BY total_generation) + (COUNT(*) OVER (PARTITION BY total_generation) - 1) / 2 AS rx, rank() OVER (ORDER BY tons_co2) + (COUNT(*) OVER (PARTITION BY tons_co2) - 1) / 2 AS ry FROM grid)", "spearman")(lambda spark, d: rounded(models.spearman(X.grid(spark, d), "total_generation", "tons_co2")))
query(SQL + "SELECT CAST(timestamp AS DATE) AS day, ROUND(SUM(tons_co2) / NULLIF(SUM(total_generation), 0), 6) AS aef FROM grid GROUP BY 1", "aef")(lambda spark, d: rounded(X.grid(spark, d).groupBy(F.to_date("timestamp").alias("day")).agg(models.average_factor().alias("aef"))))
query(SQL + f"SELECT COUNT(*) AS n, ROUND(1 - SUM((y - p) * (y - p)) / NULLIF(SUM((y - m) * (y - m)), 0), 6) AS r2, {_R.format('y', 'p')} AS r, ROUND(sqrt(AVG((y - p) * (y - p))), 6) AS rmse, ROUND(AVG(abs(y - p)), 6) AS mae FROM (SELECT tons_co2 AS y, 0.4::DOUBLE * total_generation AS p, AVG(tons_co2) OVER () AS m FROM grid)", "model_metrics")(lambda spark, d: rounded(models.metrics(X.grid(spark, d).withColumn("p", 0.4 * F.col("total_generation")), "tons_co2", "p")))


def marginal_factors(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: half-hourly ramps, the marginal factor of each demand bin with its confidence, and the average factor."""
    grid = _binned(spark, d)
    ramps = models.ramp_pairs(grid, 1800).join(grid.select("timestamp", "bin", "demand_met", "renewable_generation"), "timestamp")
    per_bin = models.weighted_line(ramps, "dy", "dq", F.abs("dq"), ("bin",)).join(ramps.groupBy("bin").agg(models.correlation("dq", "dy").alias("r")), "bin")
    rows = ramps.join(per_bin, "bin").select("timestamp", FE.net_load(F.col("demand_met"), F.col("renewable_generation")).alias("net_load"), F.col("b").alias("mef"), (F.col("y") / F.nullif("q", F.lit(0.0))).alias("aef"), S.confidence_label(F.round("r", 6)).alias("confidence"))
    return rounded(rows)


query(_BINS + f"""SELECT p.timestamp, ROUND(b.demand_met - b.renewable_generation, 6) AS net_load, ROUND(f.b, 6) AS mef, ROUND(p.y / NULLIF(p.q, 0), 6) AS aef,
  CASE WHEN f.r >= 0.6 THEN 'high' WHEN f.r >= 0.4 THEN 'medium' WHEN f.r IS NOT NULL THEN 'low' END AS confidence
  FROM {_RAMPS} p JOIN binned b USING (timestamp) JOIN (SELECT bin, (SUM(abs(dq))*SUM(abs(dq)*dq*dy) - SUM(abs(dq)*dq)*SUM(abs(dq)*dy)) / (SUM(abs(dq))*SUM(abs(dq)*dq*dq) - SUM(abs(dq)*dq)*SUM(abs(dq)*dq)) AS b, {_R.format('dq', 'dy')} AS r FROM {_RAMPS} JOIN binned USING (timestamp) GROUP BY 1) f USING (bin)""", "marginal_factors")(marginal_factors)

_GAM = ("total_generation", "hydro_generation", "nuclear_generation")
_RECURSIVE = SQL.replace("WITH ", "WITH RECURSIVE ", 1)
#: Sums, weights and, for each 30-minute row, the position of the first input and its smooth.
_GAM_SQL = _RECURSIVE + f""", designs AS (SELECT {K.SPLINES} AS n), rows AS (SELECT tons_co2, {", ".join(_GAM)}, timestamp FROM grid), {AS.basis_sql("designs", "rows", "tons_co2", _GAM)},
systems AS (SELECT n, {K.PENALTY}::DOUBLE AS penalty, fold, i, j, v FROM sums), {AS.solution_sql(3)}"""


@query(_RECURSIVE + f""", designs AS (SELECT unnest([6, {K.SPLINES}]) AS n), rows AS (SELECT tons_co2, total_generation, hydro_generation, timestamp FROM grid), {AS.basis_sql("designs", "rows", "tons_co2", ("total_generation",), ("hydro_generation",), "day(timestamp) % 3")}
SELECT n, fold, i, j, ROUND(v / 1000, 3) AS v FROM sums WHERE i <= j""")
def gam_sums(spark, d):
    """The sums that an additive model is solved from, for two numbers of splines and three folds."""
    df = X.grid(spark, d)
    first = additive.design(df, ("total_generation",), ("hydro_generation",))
    sums = additive.product_sums(df, "tons_co2", [dataclasses.replace(first, n=n) for n in (6, K.SPLINES)], F.day("timestamp") % 3)
    return rounded(sums.withColumn("v", F.col("v") / 1000), 3)


def _smooth_sql(s: int, x: str) -> str:
    """The value of smooth s at the SQL expression x, from `ends` and `weights`."""
    t = f"greatest(0.0::DOUBLE, least((n - 3 - 1e-9)::DOUBLE, ({x} - a{s}) / ((b{s} - a{s}) / (n - 3))))"
    u = f"({t} - floor({t}))"
    parts = (f"(1 - {u}) * (1 - {u}) * (1 - {u})", f"3 * {u} * {u} * {u} - 6 * {u} * {u} + 4", f"-3 * {u} * {u} * {u} + 3 * {u} * {u} + 3 * {u} + 1", f"{u} * {u} * {u}")
    return "(" + " + ".join(f"b[2 + {s} * n + floor({t})::INT + {o}] * ({v}) / 6" for o, v in enumerate(parts)) + ")"


@query(_GAM_SQL + f"""SELECT ROUND(x, 3) AS total_generation, ROUND(b[1] + {_smooth_sql(0, "x")} + {_smooth_sql(1, "m1")} + {_smooth_sql(2, "m2")}, 3) AS tons_co2
FROM (SELECT a0 + k * (b0 - a0) / 20 AS x, ends.* FROM ends, range(21) r(k)), weights, (SELECT AVG({_GAM[1]}) AS m1, AVG({_GAM[2]}) AS m2 FROM grid)""")
def gam_fit(spark, d):
    """The fitted curve of demand on a grid of 21 points, other inputs at their means."""
    df = X.grid(spark, d)
    model = additive.AdditiveModel.fit(df, "tons_co2", _GAM)
    low, high = model.design.ranges["total_generation"]
    means = df.agg(*(F.avg(c).alias(c) for c in _GAM[1:])).first()
    at = spark.range(21).select((F.lit(low) + F.col("id") * (high - low) / 20).alias("total_generation"), *(F.lit(means[c]).alias(c) for c in _GAM[1:]))
    return rounded(model.predict(at, "tons_co2").select("total_generation", "tons_co2"), 3)


@query(_GAM_SQL + f"""SELECT timestamp, ROUND(({_smooth_sql(0, "(total_generation + 1)")} - {_smooth_sql(0, "(total_generation - 1)")}) / 2, 4) AS mef FROM grid, ends, weights""")
def gam_mef(spark, d):
    """The marginal factor of each interval: the central difference of the fitted curve of demand."""
    df = X.grid(spark, d)
    model = additive.AdditiveModel.fit(df, "tons_co2", _GAM)
    return rounded(model.derivative(df, "total_generation", "mef", 1.0).select("timestamp", "mef"), 4)


@query(_RECURSIVE + f""", designs AS (SELECT unnest([6, 10]) AS n), rows AS (SELECT tons_co2, total_generation, hydro_generation, timestamp FROM grid), {AS.basis_sql("designs", "rows", "tons_co2", ("total_generation",), ("hydro_generation",), "day(timestamp) % 3")},
rest AS (SELECT n, f.fold, i, j, SUM(v) AS v FROM sums JOIN (SELECT DISTINCT fold FROM sums) f ON f.fold <> sums.fold GROUP BY ALL),
systems AS (SELECT n, penalty, fold, i, j, v FROM rest, (SELECT unnest([5.0, 50.0])::DOUBLE AS penalty)), {AS.solution_sql(1, 1)},
missed AS (SELECT w.n, penalty, SUM(CASE WHEN s.i = 2 + w.n THEN -1 ELSE b[s.i + 1] END * CASE WHEN s.j = 2 + w.n THEN -1 ELSE b[s.j + 1] END * s.v) AS off FROM weights w JOIN sums s ON s.n = w.n AND s.fold = w.fold GROUP BY ALL)
SELECT n AS splines, penalty, 3 AS folds, c AS n, ROUND(1 - off / spread, 6) AS r2, ROUND(sqrt(off / c), 5) AS rmse FROM missed, (SELECT COUNT(*) AS c, COUNT(*) * VAR_POP(tons_co2) AS spread FROM grid)""")
def gam_sweep(spark, d):
    """Every pair of a number of splines and a penalty, judged on days that its model has not seen."""
    found = additive.sweep(X.grid(spark, d), "tons_co2", ("total_generation",), ("hydro_generation",), (6, 10), (5.0, 50.0), F.day("timestamp") % 3)
    return found.select("splines", "penalty", "folds", "n", r6("r2").alias("r2"), r6("rmse", 5).alias("rmse"))


_POISSON_SQL = " + ".join(f"CASE WHEN u > {c!r} THEN 1 ELSE 0 END" for c in models.poisson_steps())


@query(SQL + f""", drawn AS (SELECT replicate, dq, dy, {_POISSON_SQL} AS w FROM (SELECT *, (CAST('0x' || substr(md5(timestamp::VARCHAR || ':' || replicate || ':1'), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE AS u FROM {_RAMPS}, (SELECT unnest(range(20))::INT AS replicate)))
SELECT replicate, ROUND((w*wxy - wx*wy) / (w*wxx - wx*wx), 6) AS b, ROUND(wy / w - (w*wxy - wx*wy) / (w*wxx - wx*wx) * wx / w, 6) AS a FROM (SELECT replicate, SUM(w)::DOUBLE AS w, SUM(w*dq) AS wx, SUM(w*dy) AS wy, SUM(w*dq*dq) AS wxx, SUM(w*dq*dy) AS wxy FROM drawn WHERE w > 0 GROUP BY 1)""")
def bootstrap_slope(spark, d):
    """Slopes of 20 Poisson bootstrap replicates."""
    rows = models.poisson_weights(_ramps(spark, d), 20, "timestamp")
    return rounded(models.weighted_line(rows, "dy", "dq", F.col("weight").cast("double"), ("replicate",)).select("replicate", "b", "a"))


def _quadratic_sql(name: str, rows: str, penalty: float = 0.0) -> str:
    """Table `name` (bin, n, intercept, linear, quadratic) from rows (bin, z, y, w)."""
    return f"""{name} AS (SELECT bin, n, (t0 - lin*s1 - quad*s2) / w AS intercept, lin AS linear, quad AS quadratic FROM (SELECT *, (c22*d1 - c12*d2) / (c11*c22 - c12*c12) AS lin, (c11*d2 - c12*d1) / (c11*c22 - c12*c12) AS quad
    FROM (SELECT *, s2 - s1*s1/w + {penalty} AS c11, s3 - s1*s2/w AS c12, s4 - s2*s2/w + {penalty} AS c22, t1 - s1*t0/w AS d1, t2 - s2*t0/w AS d2
    FROM (SELECT bin, COUNT(*) AS n, SUM(w) AS w, SUM(w*z) AS s1, SUM(w*z*z) AS s2, SUM(w*z*z*z) AS s3, SUM(w*z*z*z*z) AS s4, SUM(w*y) AS t0, SUM(w*z*y) AS t1, SUM(w*z*z*y) AS t2 FROM {rows} GROUP BY 1))))"""


_OFF = "(r.y - f.intercept - f.linear * r.z - f.quadratic * r.z * r.z)"
_HUBER = "".join(
    f", w{k} AS (SELECT r.bin, r.z, r.y, CASE WHEN abs({_OFF}) > l.lim THEN l.lim / abs({_OFF}) ELSE 1.0::DOUBLE END AS w FROM scaled r JOIN h{k - 1} f USING (bin) JOIN lims l USING (bin)), " + _quadratic_sql(f"h{k}", f"w{k}") for k in range(1, 11)
)


@query(_BINS + f""", scaled AS (SELECT bin, (total_generation - AVG(total_generation) OVER (PARTITION BY bin)) / STDDEV_POP(total_generation) OVER (PARTITION BY bin) AS z, tons_co2 AS y, 1.0::DOUBLE AS w FROM binned),
{_quadratic_sql("ridge", "scaled", 1.0)}, {_quadratic_sql("h0", "scaled")}, lims AS (SELECT r.bin, 1.345::DOUBLE * sqrt(AVG({_OFF} * {_OFF})) AS lim FROM scaled r JOIN h0 f USING (bin) GROUP BY 1){_HUBER}
SELECT model, bin, n, ROUND(intercept, 5) AS intercept, ROUND(linear, 5) AS linear, ROUND(quadratic, 5) AS quadratic FROM (SELECT 'ridge' AS model, * FROM ridge UNION ALL SELECT 'huber', * FROM h10)""")
def ridge_huber(spark, d):
    """Comparison models in each demand bin: ridge and Huber regressions on a quadratic of demand, with all coefficients."""
    rows = _binned(spark, d)
    fits = [(name, fit(rows, "tons_co2", "total_generation", ("bin",))) for name, fit in (("ridge", models.ridge_quadratic), ("huber", models.huber_quadratic))]
    ridge, huber = (f.select(F.lit(name).alias("model"), "*") for name, f in fits)
    return rounded(ridge.unionByName(huber), 5)


# Windows.


@query(SQL + "SELECT cell, valid_time, ROUND(tp - COALESCE(LAG(tp) OVER (PARTITION BY cell, CAST(valid_time AS DATE) ORDER BY valid_time), 0), 6) AS tp_step, ROUND(LAST_VALUE(CASE WHEN cell % 2 = 0 OR hour(valid_time) % 5 = 0 THEN t2m END IGNORE NULLS) OVER (PARTITION BY cell ORDER BY valid_time), 6) AS t2m_known, false AS late FROM weather")
def stream_deaccumulate(spark, d):
    """Steps of running totals and last known values over three micro-batches whose borders cut days: the same as in one batch."""
    from .streaming import carried

    out = shared_folder(spark, "carried")
    rows = X.weather(spark, d).select("cell", "valid_time", "tp", F.when((F.col("cell") % 2 == 0) | (F.hour("valid_time") % 5 == 0), F.col("t2m")).alias("t2m"))
    parts = ("valid_time < timestamp_ntz'2024-01-08 13:00:00'", "valid_time >= timestamp_ntz'2024-01-08 13:00:00' and valid_time < timestamp_ntz'2024-01-19 07:00:00'", "valid_time >= timestamp_ntz'2024-01-19 07:00:00'")
    for part in parts:
        rows.where(part).write.mode("append").parquet(f"{out}/landed")
        carried.ingest(carried.carry_over(windows.landed(spark, f"{out}/landed", rows.schema), "cell", "valid_time", "tp", "t2m"), f"{out}/table", f"{out}/state")
    return rounded(spark.read.parquet(f"{out}/table"))


query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM events GROUP BY ALL", "win_tumbling")(lambda spark, d: rounded(windows.tumbling(X.events(spark, d), "1 hour", "ts", "event_type")))
query("SELECT time_bucket(INTERVAL '30 minutes', ts) - i * INTERVAL 30 MINUTE AS start, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM events, range(2) t(i) GROUP BY ALL", "win_sliding")(lambda spark, d: rounded(windows.sliding(X.events(spark, d), "1 hour", "30 minutes", "ts")))
query("SELECT MIN(ts) AS start, MAX(ts) + INTERVAL 30 MINUTE AS end, user_id, COUNT(*) AS n FROM (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s", "win_session")(lambda spark, d: windows.sessions(X.events(spark, d), "30 minutes", "ts", "user_id"))
query("SELECT event_type, CAST(NULL AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1 UNION ALL SELECT NULL, NULL, COUNT(*) FROM events UNION ALL SELECT event_type, CAST(ts AS DATE), COUNT(*) FROM events GROUP BY 1, 2", "rollup_counts")(lambda spark, d: X.events(spark, d).rollup("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n")))


@query("SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 6) AS total FROM events GROUP BY 1")
def stream_ingest(spark, d):
    """The events table as a stream of landed files, ingested by month and read back."""
    source = spark.read.parquet(f"{d}/events.parquet")
    kept = shared_folder(spark, "stream")
    windows.ingest_months(windows.landed(spark, d, T.StructType(list(source.schema)), "events*.parquet"), f"{kept}/table", f"{kept}/state", "ts")
    return rounded(spark.read.parquet(f"{kept}/table").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")))
