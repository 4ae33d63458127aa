"""Units with results worked out by hand, properties, and shapes of plans."""

import sys
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberflux import config as K
from emberflux.functions import scalars
from emberflux.operators import additive, blocks, joins, models, series, tables
from emberflux.plans import months, requests
from emberflux.sources import files, provider


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def series_of(spark, values, step=300):
    start = datetime(2024, 1, 1)
    data = [(datetime.fromtimestamp(start.timestamp() + i * step), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "timestamp timestamp_ntz, v double")


def request(**more):
    return {"dataset_short_name": "land", "start_date": "2024-01", "end_date": "2024-03", "region_bounds": [37.5, 68, 6, 98], "variables": ["2m_temperature"]} | more


def test_request_defaults_and_clamps():
    r = requests.WeatherRequest.from_dict(request(retry_settings={"max_retries": 99}, parallel_settings={"enabled": True, "max_concurrent": 50}))
    assert (r.dataset, r.start, r.end) == ("era5-land", date(2024, 1, 1), date(2024, 3, 31))
    assert (r.retries, r.parallel, r.policy) == (K.MOST_RETRIES, K.MOST_PARALLEL, "skip_all")
    assert requests.WeatherRequest.from_dict(request(), as_of=date(2024, 3, 10)).end == date(2024, 3, 2)


@pytest.mark.parametrize("more", [{"dataset_short_name": "x"}, {"end_date": "2023-01"}, {"region_bounds": [1, 2]}, {"region_bounds": [5, 0, 9, 1]}, {"variables": []}, {"existing_file_action": "ask"}, {"dataset_short_name": "world", "variables": ["snowfall"]}])
def test_request_errors(more):
    with pytest.raises(requests.RequestError):
        requests.WeatherRequest.from_dict(request(**more))


def test_request_drops_denied_variables():
    r = requests.WeatherRequest.from_dict(request(dataset_short_name="world", variables="snowfall, '2M_Temperature'"), on_invalid="drop")
    assert (r.variables, r.dropped) == (("2m_temperature",), ("snowfall",))


def test_provider_months():
    assert provider.months(datetime(2023, 11, 15), datetime(2024, 1, 2)) == [(datetime(2023, 11, 1), datetime(2023, 12, 1)), (datetime(2023, 12, 1), datetime(2024, 1, 1)), (datetime(2024, 1, 1), datetime(2024, 1, 2))]
    assert provider.months(datetime(2024, 1, 1), datetime(2024, 2, 1)) == [(datetime(2024, 1, 1), datetime(2024, 2, 1))]


def test_reader_tries_again():
    calls = []

    class Flaky(provider.MonthlyGridReader):
        pass

    reader = Flaky({"start": "2024-01-01", "end": "2024-02-01", "fetch": "emberflux.sources.recorded:fetch", "delay": "0"})
    assert len(list(reader.read(reader.partitions()[0]))) == 1 and not calls


def test_reader_signs_in_again(monkeypatch):
    import types
    import urllib.error

    tokens, tried, slept = [], [], []

    def login(url):
        tokens.append(f"t{len(tokens)}")
        return {"token": tokens[-1]}

    def fetch(url, a, b, headers):
        tried.append(headers["token"])
        if len(tried) == 2:
            raise urllib.error.HTTPError(url, 401, "who", None, None)
        return f"{a:%m}"

    monkeypatch.setitem(sys.modules, "own_service", types.SimpleNamespace(login=login, fetch=fetch))
    monkeypatch.setattr(provider.time, "sleep", slept.append)
    reader = provider.MonthlyGridReader({"start": "2024-01-01", "end": "2024-04-01", "fetch": "own_service:fetch", "login": "own_service:login", "pause": "7"})
    assert len(reader.partitions()) == 1
    assert list(reader.read(reader.partitions()[0])) == [("2024-01", "01"), ("2024-02", "02"), ("2024-03", "03")]
    assert tried == ["t0", "t0", "t1", "t1"] and slept == [7.0, 7.0]
    two = provider.MonthlyGridReader({"start": "2024-01-01", "end": "2024-04-01", "streams": "2"})
    assert [len(x.value) for x in two.partitions()] == [2, 1]


def test_exact_quantiles(spark):
    from emberflux.operators.blocks import quantiles

    x = np.random.default_rng(4).integers(0, 60, 501).astype(float)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    assert quantiles(df, "v", shares) == pytest.approx(list(np.quantile(x, shares)))
    assert quantiles(df.where("v < 0"), "v", [0.5]) == [None]


def test_export_by_year_keeps_files_small(spark, tmp_path):
    df = spark.range(4000).selectExpr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, id) as timestamp", "id as v")
    tables.export_by_year(df, str(tmp_path / "y"), max_bytes=16 * 500)
    back = spark.read.parquet(str(tmp_path / "y"))
    assert back.count() == 4000 and back.groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0] <= 500


def test_union_relaxed_widens_and_refuses(spark):
    a, b, c = spark.sql("SELECT 1 AS x"), spark.sql("SELECT 2.5D AS x"), spark.sql("SELECT 'y' AS x")
    assert rows(tables.union_relaxed([a, b])) == [(1.0,), (2.5,)]
    with pytest.raises(TypeError):
        tables.union_relaxed([a, c])
    with pytest.raises(ValueError):
        tables.union_relaxed([a, spark.sql("SELECT 1 AS z")])


def test_resampling_keeps_sums(spark):
    df = series_of(spark, [float(i % 7) for i in range(100)]).select("timestamp", F.col("v").alias("tons_co2"), *(F.col("v").alias(c) for c in (*series.MEANS, *series.WEIGHTED)))
    assert series.resample_grid(df).agg(F.sum("tons_co2")).first()[0] == df.agg(F.sum("tons_co2")).first()[0]


def test_deaccumulate_inverts_running_sum(spark):
    df = spark.sql("SELECT 1 AS cell, timestampadd(HOUR, CAST(id AS INT), timestamp_ntz'2024-01-01') AS valid_time, CAST(id % 5 AS DOUBLE) AS step FROM range(72)")
    df = df.selectExpr("*", "sum(step) over (partition by to_date(valid_time) order by valid_time) AS total")
    assert series.deaccumulate(df, "total", "back", ("cell",), F.to_date("valid_time")).where("abs(back - step) > 1e-9").isEmpty()


def test_fills_across_blocks(spark):
    df = series_of(spark, [None, 1.0, None, None, 4.0, None], step=43_200)
    assert [r[1] for r in series.fill_forward(df, "v").orderBy("timestamp").collect()] == [None, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert [r[1] for r in series.fill_linear(df, "v").orderBy("timestamp").collect()] == [None, 1.0, 2.0, 3.0, 4.0, None]


def test_running_sum_over_blocks(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"), F.lit(1).alias("one"))
    assert blocks.running_sum(df, "x", "one", "s").where("s <> x + 1").isEmpty()


def test_asof_without_match(spark):
    left, right = series_of(spark, [1.0, 2.0]), series_of(spark, [9.0]).select((F.col("timestamp") + F.expr("interval 1 minute")).alias("timestamp"), F.col("v").alias("w"))
    assert [r["w"] for r in joins.asof(left, right, ("w",)).orderBy("timestamp").collect()] == [None, 9.0]


def test_polygon(spark):
    points = spark.sql("SELECT * FROM VALUES (1.0D, 1.0D), (3.0D, 3.0D), (0.5D, 3.5D) AS t(latitude, longitude)")
    assert rows(points.where(tables.in_polygon([(0, 0), (0, 4), (2, 0)]))) == [(0.5, 1.0)] or points.where(tables.in_polygon([(0, 0), (0, 4), (2, 0)])).count() == 1


def test_months_of_policy(spark):
    plan = spark.sql("SELECT * FROM VALUES (2024, 1), (2024, 2) AS t(year, month)")
    present = spark.sql("SELECT 2024 AS year, 1 AS month, 'p' AS path")
    assert rows(months.plan_by_policy(plan, present, "skip_all")) == [(2024, 1, "skip"), (2024, 2, "fetch")]
    with pytest.raises(ValueError):
        months.plan_by_policy(plan, present, "never")


def test_zip_extraction(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.grib", "GRIBdata")
        z.writestr("long.txt", "y" * 100)
    (tmp_path / "b.grib").write_bytes(b"GRIBmore")
    found = files.extract(files.read_files(spark, str(tmp_path)))
    assert sorted((r["member"], bytes(r["content"])) for r in found.collect()) == [("b.grib", b"GRIBmore"), ("x.grib", b"GRIBdata")]


def test_weather_source(spark, tmp_path):
    import hashlib

    from emberflux.sources.weather import MonthlyWeather, request_of

    spark.dataSource.register(MonthlyWeather)
    options = {"dataset": "land", "start": "2024-01-31", "end": "2024-04-01", "bounds": "37,68,6,98", "variables": "a, b", "delay": "0", "folder": str(tmp_path / "raw"), "fetch": "emberflux.sources.recorded:weather"}
    read = spark.read.format("monthly_weather").options(**options)
    found = read.load().cache()
    assert sorted((r["month"], r["status"], r["member"], r["size"]) for r in found.collect()) == [(1, "success", "era5-land_2024-01.grib", 748), (2, "success", "data.grib", 700), (3, "failed", None, None), (4, "success", "data.grib", 724)]
    for r in found.where("status = 'success'").collect():
        content = open(r["path"], "rb").read()
        assert content == b"GRIB" + bytes(r["size"] - 4) and hashlib.sha256(content).hexdigest() == r["sha256"]
    assert sorted(x.name for x in (tmp_path / "raw").iterdir() if not x.name.endswith(".crc")) == ["era5-land_2024-01.grib", "era5-land_2024-02.grib", "era5-land_2024-04.grib"]
    assert [(r["month"], r["status"], r["size"]) for r in read.option("months", "2024-02").load().collect()] == [(2, "skipped", 700)]
    assert [(r["month"], r["status"]) for r in read.options(months="2024-02", existing="overwrite_all").load().collect()] == [(2, "success")]
    assert read.option("months", "").load().isEmpty()
    assert len(request_of(2024, 2, ["a"], [1.0, 2.0, 0.0, 3.0])["day"]) == 29


class Endless:
    """A body of many bytes that nobody holds."""

    def __init__(self, size):
        self.left = size - 4
        self.first = b"GRIB"

    def read(self, n):
        if self.first:
            out, self.first = self.first, b""
            return out
        n = min(n, self.left)
        self.left -= n
        return bytes(n)


def test_bodies_are_never_held_in_memory(tmp_path):
    import io
    import tracemalloc
    import zipfile

    from emberflux.sources.weather import Folder

    folder = Folder(str(tmp_path / "raw"))
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("big.grib", "w") as member:
            for _ in range(24):
                member.write(bytes(1 << 20))
    tracemalloc.start()
    assert folder.take(Endless(48 << 20), "a.grib")[:2] == ("a.grib", 48 << 20)
    with open(tmp_path / "x.zip", "rb") as body:
        assert folder.take(body, "b.grib")[:2] == ("big.grib", 24 << 20)
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()
    empty = io.BytesIO()
    zipfile.ZipFile(empty, "w").close()
    for broken in (b"<html>", b"", empty.getvalue(), b"PK\x03\x04 broken"):
        with pytest.raises((ValueError, zipfile.BadZipFile)):
            folder.take(broken, "c.grib")
    assert sorted(x.name for x in (tmp_path / "raw").iterdir()) == ["a.grib", "b.grib"] and folder.size("c.grib") is None


def test_request_becomes_options(spark):
    from emberflux.plans.requests import WeatherRequest

    raw = {"dataset_short_name": "era5-land", "start_date": "2024-01-05", "end_date": "2024-04", "bounds": [37, 68, 6, 98], "variables": "a, b", "existing_file_action": "overwrite_all", "retry_settings": {"max_retries": 4, "retry_delay_sec": 2}, "parallel_settings": {"enabled": True, "max_concurrent": 2}}
    request = WeatherRequest.from_dict(raw)
    plan = spark.createDataFrame([(2024, 3, "fetch"), (2024, 1, "skip"), (2024, 2, "overwrite")], "year int, month int, status string")
    assert request.options("/shared", plan) == {"dataset": "era5-land", "start": "2024-01-05", "end": "2024-04-30", "bounds": "37.0,68.0,6.0,98.0", "variables": "a,b", "retries": "4", "delay": "2", "streams": "2", "existing": "overwrite_all", "folder": "/shared", "months": "2024-02,2024-03"}
    assert "months" not in request.options("/shared") and request.options("/shared", plan.limit(0))["months"] == ""


def test_additive_model_finds_a_known_curve(spark):
    x = np.linspace(0, 10, 400)
    df = spark.createDataFrame([(float(a), float(np.sin(a) + 2)) for a in x], "x double, y double")
    model = additive.AdditiveModel.fit(df, "y", ("x",), penalty=0.01)
    got = model.predict(df, "p").toPandas()
    assert np.abs(got.p - got.y).max() < 0.01
    slope = model.derivative(df.where("x between 1 and 9"), "x", "s", 0.05).toPandas()
    assert np.abs(slope.s - np.cos(slope.x)).max() < 0.05


def test_finite_difference_of_a_quadratic(spark):
    df = spark.range(100).select((F.col("id") / 10).alias("x")).withColumn("y", F.col("x") * F.col("x"))
    model = additive.AdditiveModel.fit(df, "y", ("x",), penalty=1e-9)
    assert model.derivative(df.where("x between 1 and 8"), "x", "s", 0.5).where("abs(s - 2 * x) > 1e-3").isEmpty()


def test_additive_model_against_dense_matrices(spark):
    """Sums, weights, predictions and the sweep against numpy on dense matrices, with two smooths and a linear term."""
    rng = np.random.default_rng(11)
    a, b, c = rng.uniform(-3, 4, 300), rng.normal(size=300), rng.integers(0, 2, 300).astype(float)
    y = np.sin(a) + b * b + 2 * c + rng.normal(size=300) / 9
    fold = np.arange(300) // 60
    df = spark.createDataFrame([*zip(*(x.tolist() for x in (a, b, c, y, fold))), (None, 1.0, 1.0, 1.0, 0)], "a double, b double, c double, y double, fold int")

    def dense(n):
        parts = [np.ones((300, 1))]
        for x in (a, b):
            t = np.clip((x - x.min()) / ((x.max() - x.min()) / (n - 3)), 0, n - 3 - 1e-9)
            u, m = t - np.floor(t), np.zeros((300, n))
            for k, v in enumerate(((1 - u) ** 3, 3 * u**3 - 6 * u**2 + 4, -3 * u**3 + 3 * u**2 + 3 * u + 1, u**3)):
                m[np.arange(300), t.astype(int) + k] = v / 6
            parts.append(m)
        return np.concatenate([*parts, c[:, None]], 1)

    def solve(x, y, n, penalty):
        bend, stiff = np.diff(np.eye(n), 2, axis=0), np.zeros((2 * n + 2, 2 * n + 2))
        for k in (1, 1 + n):
            stiff[k : k + n, k : k + n] = penalty * bend.T @ bend + additive.RIDGE * np.eye(n)
        return np.linalg.solve(x.T @ x + stiff, x.T @ y)

    model = additive.AdditiveModel.fit(df, "y", ("a", "b"), ("c",), 9, 2.0)
    x = dense(9)
    want = x @ solve(x, y, 9, 2.0)
    got = [r["p"] for r in model.predict(df, "p").orderBy("a").collect()]
    assert got[0] is None and got[1:] == pytest.approx(want[np.argsort(a)], abs=1e-6)
    found = {(r["splines"], r["penalty"]): r for r in additive.sweep(df, "y", ("a", "b"), ("c",), (5, 9), (0.5, 20.0), F.col("fold")).collect()}
    assert len(found) == 4
    for (n, penalty), r in found.items():
        x = dense(n)
        off = sum(np.sum((y[fold == k] - x[fold == k] @ solve(x[fold != k], y[fold != k], n, penalty)) ** 2) for k in range(5))
        assert (r["folds"], r["n"]) == (5, 300) and r["r2"] == pytest.approx(1 - off / np.sum((y - y.mean()) ** 2), abs=1e-7) and r["rmse"] == pytest.approx(np.sqrt(off / 300), abs=1e-7)
    alone = additive.sweep(df, "y", ("a",), splines=(5,), penalties=(1.0,)).first()
    assert alone["folds"] == 1 and alone["r2"] is None
    assert "Python" not in plan_of(model.derivative(df, "a", "d", 0.1)) and "Python" not in plan_of(additive.product_sums(df, "y", [model.design]))
    with pytest.raises(ValueError):
        additive.AdditiveModel.fit(df.where("a > 99"), "y", ("a",))


def test_huber_line_ignores_outliers(spark):
    rows = [("a", float(i), 3.0 * i + 1 + (500 if i % 25 == 0 else 0)) for i in range(200)] + [("b", 1.0, 2.0)] * 3 + [("a", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    huber = {r["g"]: r for r in models.huber_quadratic(df, "y", "x", ("g",), k=0.2, rounds=40).collect()}
    ridge = {r["g"]: r for r in models.ridge_quadratic(df, "y", "x", ("g",), penalty=0.0).collect()}
    spread, mean = np.std(np.arange(200)), 99.5
    assert huber["a"]["linear"] == pytest.approx(3 * spread, rel=0.01) and huber["a"]["intercept"] == pytest.approx(3 * mean + 1, rel=0.02)
    assert huber["a"]["n"] == 200 and ridge["a"]["intercept"] > huber["a"]["intercept"] + 10 and huber["b"]["linear"] is None
    z = (np.arange(200) - mean) / spread
    x = np.stack([np.ones(200), z, z * z], 1)
    want = np.linalg.solve(x.T @ x + np.diag([0, 5.0, 5.0]), x.T @ np.array([r[2] for r in rows[:200]]))
    got = models.ridge_quadratic(df, "y", "x", ("g",), penalty=5.0).where("g = 'a'").first()
    assert [got[c] for c in ("intercept", "linear", "quadratic")] == pytest.approx(want.tolist())


def test_correlation_of_many_thresholds(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=500)
    y = x + rng.normal(size=500)
    size = np.abs(rng.normal(size=500)) * 10
    df = spark.createDataFrame([*zip(x.tolist(), y.tolist(), (size * rng.choice([-1, 1], 500)).tolist()), (1.0, 1.0, None)], "x double, y double, s double")
    taus = [k / 40 for k in range(1000)]
    found = models.correlation_by_threshold(df, "x", "y", "s", taus)
    assert "Generate" not in plan_of(found)
    got = {r["tau"]: (r["n"], r["r"]) for r in found.collect()}
    assert set(got) == {t for t in taus if (size >= t).any()}
    for t, (n, r) in got.items():
        mine = size >= t
        assert n == mine.sum()
        if n > 2:
            assert r == pytest.approx(np.corrcoef(x[mine], y[mine])[0, 1], abs=1e-9)


def test_selection_by_histograms(spark, monkeypatch):
    """Ties, gaps, extremes and repeated rounds, with next to nothing fetched."""
    from emberflux.operators import blocks

    rng = np.random.default_rng(13)
    x = np.concatenate([rng.normal(size=2000), np.full(3000, 7.0), 1e300 * rng.normal(size=20), [1e-300, -1e-300, 0.0, 0.0]])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),), (float("inf"),)], "v double")
    monkeypatch.setattr(blocks, "FETCHED", 3)
    monkeypatch.setattr(blocks, "CELLS", 128)
    ranks = [0, 1, 9, 10, 1500, 2011, 2500, 4000, len(x) - 2, len(x) - 1]
    assert blocks.select_ranks(df, "v", ranks) == {k: v for k, v in zip(ranks, np.sort(x)[ranks].tolist())}
    shares = [0.01, 0.333, 0.5, 0.99]
    assert blocks.quantiles(df, "v", shares) == pytest.approx(np.quantile(x, shares).tolist())


def test_bootstrap_weights_are_fixed_and_average_one(spark):
    df = spark.range(2000)
    a, b = (models.poisson_weights(df, 5, "id").agg(F.sum("weight")).first()[0] for _ in range(2))
    assert a == b and abs(a / 10_000 - 1) < 0.05


def test_hash_of_known_request(spark):
    import hashlib

    text = "era5-land|" + str(sorted(["b", "a"])) + "|" + str([1.0, -2.5, 0.0, 3.0])
    got = spark.range(1).select(scalars.request_hash(F.lit("era5-land"), F.array(F.lit("b"), F.lit("a")), F.array(*map(F.lit, (1.0, -2.5, 0.0, 3.0))))).first()[0]
    assert got == hashlib.md5(text.encode()).hexdigest()[:12]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.sql("SELECT timestamp_ntz'2024-01-01' AS ts, 1 AS a, 2 AS b").write.parquet(str(tmp_path / "t"))
    plan = plan_of(spark.read.parquet(str(tmp_path / "t")).where("ts >= timestamp_ntz'2024-01-05'").select("a"))
    assert "GreaterThanOrEqual(ts" in plan and "b:int" not in plan


def test_no_python_in_series_plans(spark):
    df = series_of(spark, [1.0, None])
    for out in (series.fill_linear(df, "v"), series.gap_report(df, "5 minutes"), models.ramp_pairs(df, 300, "v", "v"), joins.asof(df, df.withColumnRenamed("v", "w"), ("w",))):
        assert "Python" not in plan_of(out)


def test_region_weights_of_polygons(spark):
    """Triangles, notches and closed rings over cells of several sizes: areas are exact and weights sum to one."""
    from emberflux.operators import regions

    rings = {"triangle": ([(0, 0), (0, 3), (3, 0)], 4.5), "ell": ([(0, 0), (0, 2), (1, 2), (1, 1), (2, 1), (2, 0), (0, 0)], 3.0), "notch": ([(0, 0), (0, 3), (3, 3), (3, 2), (1, 2), (1, 1), (3, 1), (3, 0)], 7.0), "far": ([(-0.3, 179.2), (0.4, 181.7), (-0.9, 180.4)], None)}
    df = spark.createDataFrame([(k, [(float(y), float(x)) for y, x in r]) for k, (r, _) in rings.items()] + [("line", [(0.0, 0.0), (1.0, 1.0)]), ("flat", [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]), ("none", None)], "region string, ring array<struct<y:double,x:double>>")
    for size in (1.0, 0.3, 5.0):
        cells = regions.cell_weights(df, size)
        got = {r["region"]: (r["a"], r["w"]) for r in cells.groupBy("region").agg(F.sum("area").alias("a"), F.sum("weight").alias("w")).collect()}
        assert set(got) == set(rings)
        for k, (ring, area) in rings.items():
            y, x = np.array(ring, float).T
            area = area or abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2
            assert got[k] == pytest.approx((area, 1.0))
        assert cells.where("area > %r" % (size * size * 1.0000001)).isEmpty()
    half = {(r["row"], r["col"]): r["area"] for r in regions.cell_weights(df.where("region = 'triangle'"), 1.0).collect()}
    assert half == pytest.approx({(r, c): 1.0 if r + c < 2 else 0.5 for r in range(3) for c in range(3) if r + c < 3})


def test_month_files_keep_old_months_when_a_task_fails(spark, tmp_path):
    from emberflux.sources.month_files import MonthFiles

    spark.dataSource.register(MonthFiles)
    path = str(tmp_path / "t")
    rows = lambda a, n, v: spark.range(n).selectExpr(f"timestamp_ntz'{a}' + make_interval(0, 0, 0, id) as timestamp", f"id * {v} as v")
    put = lambda df, mode="overwrite": df.repartition(3).write.format("month_files").mode(mode).option("path", path).save()
    read = lambda: sorted(map(tuple, spark.read.parquet(path).selectExpr("year", "month", "v").collect()))
    put(rows("2024-01-01", 60, 1))
    old = read()
    assert {r[:2] for r in old} == {(2024, 1), (2024, 2)} and len(old) == 60
    broken = rows("2024-01-01", 40, 5).withColumn("v", F.when(F.col("v") == 150, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        put(broken)
    with pytest.raises(Exception, match="no month"):
        put(rows("2024-01-01", 5, 5).withColumn("timestamp", F.when(F.col("v") > 5, F.col("timestamp"))))
    assert read() == old and not [x for x in (tmp_path / "t").iterdir() if x.name.startswith("_retired")]
    put(rows("2024-01-01", 31, 2))
    assert read() == sorted([(2024, 1, 2 * i) for i in range(31)] + [r for r in old if r[1] == 2])
    put(rows("2024-01-01", 1, 9), "append")
    assert len(read()) == 61


def test_carried_state_defines_late_rows(spark, tmp_path):
    """Late rows come out without a step and change nothing; a day's border starts the total anew; nulls are carried over."""
    from datetime import datetime

    from emberflux.streaming import carried, windows

    schema = "k string, at timestamp_ntz, total double, v double"
    at = lambda h, day=1: datetime(2024, 1, day, h)
    batches = [[("a", at(1), 1.0, None), ("a", at(2), 3.0, 7.0), ("b", at(1), 5.0, 1.0), (None, at(1), 1.0, 1.0)], [("a", at(4), 4.5, None), ("a", at(2), 99.0, 99.0), ("a", at(3), None, None), ("b", at(0, 2), 2.0, None), ("b", None, 2.0, None)], [("a", at(5), 6.0, 8.0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = windows.landed(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        carried.ingest(carried.carry_over(stream, "k", "at", "total", "v"), str(tmp_path / "out"), str(tmp_path / "state"))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    assert got == sorted([("a", at(1), 1.0, None, False), ("a", at(2), 2.0, 7.0, False), ("b", at(1), 5.0, 1.0, False), ("a", at(2), None, None, True), ("a", at(3), None, 7.0, False), ("a", at(4), 1.5, 7.0, False), ("b", at(0, 2), 2.0, 1.0, False), ("a", at(5), 1.5, 8.0, False)], key=str)


def test_watermark_drops_late_windows(spark, tmp_path):
    from datetime import datetime

    from emberflux.streaming import windows

    schema = "at timestamp_ntz, value double"
    for hour in ((1, 2), (9,), (1, 10), (15,)):
        spark.createDataFrame([(datetime(2024, 1, 1, h), 1.0) for h in hour], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = windows.watermarked(windows.landed(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), "2 hours", "at")
        query = windows.tumbling(stream, "1 hour", "at").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    got = {r["start"].hour: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: 1, 2: 1, 9: 1, 10: 1}


def test_run_log_counts_once_and_keeps_errors(spark, tmp_path):
    from emberflux.runs import RunLog, history

    log = RunLog(spark, str(tmp_path / "log"), kind="test")
    df = spark.range(100).selectExpr("id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id) as at", "if(id % 10 = 0, null, id) as v")
    log.step("a", df, lambda x: x.repartitionByRange(5, "at").sortWithinPartitions("at").write.parquet(str(tmp_path / "a")), valid=F.col("v") > 50, time="at")
    log.step("b", df, lambda x: x.write.parquet(str(tmp_path / "b")), lambda x: x.limit(7), staged=False)
    with pytest.raises(Exception):
        log.step("c", df, lambda x: x.write.parquet(str(tmp_path / "a")))
    log.save()
    RunLog(spark, str(tmp_path / "log")).save()
    rows = {r["step"]: r for r in history(spark, str(tmp_path / "log")).collect()}
    assert [(rows[s]["status"], rows[s]["rows_out"], rows[s]["rows_rejected"]) for s in "abc"] == [("success", 45, 55), ("success", 7, 0), ("failed", None, None)]
    assert rows["a"]["rows_in"] == 100 and (rows["a"]["first"].day, rows["a"]["last"].month) == (21, 4) and "exists" in rows["c"]["error"].lower() and rows["a"]["parameters"] == {"kind": "test"}


def test_discovery_is_sorted_and_strict(spark, tmp_path):
    for name in ("grid_2024-03", "grid_2023-12", "grid_2024-01", "other"):
        spark.range(1).coalesce(1).write.parquet(str(tmp_path / "x"), mode="overwrite")
        next((tmp_path / "x").glob("part-*.parquet")).rename(tmp_path / f"{name}.parquet")
    for x in (tmp_path / "x").iterdir():
        x.unlink()
    found = tables.discover(spark, str(tmp_path), "*.parquet")
    assert [(r["path"].split("/")[-1], r["year"], r["month"]) for r in found.collect()] == [("grid_2023-12.parquet", 2023, 12), ("grid_2024-01.parquet", 2024, 1), ("grid_2024-03.parquet", 2024, 3), ("other.parquet", None, None)]
    assert [r["month"] for r in tables.discover(spark, str(tmp_path), months=["2024-01", "2024-02"]).collect()] == [1]
    assert "content" not in plan_of(found).lower().split("readschema")[-1]
    for glob, months_ in (("*.grib", None), ("*.parquet", ["2020-01"])):
        with pytest.raises(FileNotFoundError):
            tables.discover(spark, str(tmp_path), glob, months_)
