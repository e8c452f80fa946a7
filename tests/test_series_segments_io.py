import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import forecast as O
from ledgerline.operators import metrics as M
from ledgerline.operators import segment as G
from ledgerline.operators import series as S
from ledgerline.session import fresh_path
from ledgerline.sources import files, lineage


def daily(spark, values, sid="a", start=dt.date(2020, 1, 1)):
    rows = [(sid, start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, day date, value double")


def test_returns_do_not_pad(spark):
    got = [r.ret for r in S.returns(daily(spark, [1, 2, None, 4]), "series_id", "day", "value").orderBy("day").collect()]
    assert got == [None, 1.0, None, None]


def test_rolling_needs_full_window(spark):
    got = [r.v for r in S.rolling_volatility(daily(spark, [1, 2, 4, 8]), "series_id", "day", "value", 3, 1, "v").orderBy("day").collect()]
    assert got[:2] == [None, None] and got[2] == pytest.approx(100 * np.std([1, 2, 4], ddof=1))


def test_interpolation_edges(spark):
    got = [r.value for r in S.interpolate_linear(daily(spark, [None, 2, None, None, 5, None]), "series_id", "day", "value").orderBy("day").collect()]
    assert got == [None, 2.0, 3.0, 4.0, 5.0, 5.0]


def test_constant_series_is_guarded(spark):
    df = daily(spark, [3, 3, 3, 3])
    assert S.autocorr1(df, "series_id", "day", "value").first().acf1 is None
    assert S.acf(df, "series_id", "day", "value", 2).count() == 0
    assert S.moments(df, ["series_id"], "value").first().skew is None


def test_unit_root_tells_walk_from_noise():
    rng = np.random.default_rng(8)
    noise = rng.normal(size=400)
    assert S.adf_statistic(noise)[1] < 0.01
    assert S.adf_statistic(np.cumsum(noise))[1] > 0.05


def test_decomposition_adds_up(spark):
    values = [10 + i + (5 if i % 4 == 0 else 0) for i in range(24)]
    df = daily(spark, values).withColumn("p", F.date_diff("day", F.lit("2020-01-01").cast("date")) % 4)
    got = S.seasonal_decompose(df, "series_id", "day", "value", F.col("p"), 4).orderBy("day").collect()
    assert sum(r.seasonal for r in got[:4]) == pytest.approx(0)
    assert all(r.trend is None for r in got[:2] + got[-2:])
    assert all(abs(r.remainder) < 1e-9 for r in got if r.trend is not None)


def test_qq_is_symmetric(spark):
    got = S.qq_points(daily(spark, [5, 1, 3]), "series_id", "value").orderBy("i").collect()
    assert [r.sample for r in got] == [1, 3, 5] and got[1].theoretical == pytest.approx(0) and got[0].theoretical == pytest.approx(-got[2].theoretical)


def test_forecasters():
    line, _, _ = O.holt_linear(np.arange(50.0), 3)
    assert line == pytest.approx([50, 51, 52], abs=1e-6)
    t = np.arange(1500)
    wave = 10 + 3 * np.sin(2 * np.pi * t / 365.25)
    pred, lo, hi = O.harmonic_ar(wave + np.random.default_rng(0).normal(0, 0.5, 1500), 200)
    truth = 10 + 3 * np.sin(2 * np.pi * np.arange(1500, 1700) / 365.25)
    assert np.abs(pred - truth).mean() < 0.2 and (hi > lo).all() and (hi - lo)[-1] >= (hi - lo)[0]


def test_no_forecast_sees_the_future(spark):
    past = list(np.sin(np.arange(500) / 9))
    cut = str(dt.date(2020, 1, 1) + dt.timedelta(days=449))
    changed = past[:450] + [v + 100 for v in past[450:]]
    for model in ("climatology", "seasonal_naive", "holt_trend_only", "harmonic_ar"):
        a, b = (O.run_model(model, daily(spark, v), "series_id", "day", "value", [cut], 30).orderBy("h").collect() for v in (past, changed))
        assert [r.pred for r in a] == [r.pred for r in b] and [r.h for r in a] == list(range(1, 31))


def blobs(spark):
    rng = np.random.default_rng(4)
    centers = np.array([[0, 0, 0], [8, 0, 0], [0, 8, 0], [0, 0, 8]])
    x = np.vstack([rng.normal(c, 0.6, (150, 3)) for c in centers])
    rows = [(i, i // 150, *map(float, v)) for i, v in enumerate(x)]
    far = [(600 + j, 9, *map(float, rng.normal(40, 6, 3))) for j in range(6)]
    return spark.createDataFrame(rows + far, "id int, truth int, a double, b double, c double")


def test_planted_clusters_and_anomalies_are_found(spark):
    f = ["a", "b", "c"]
    df = blobs(spark)
    screened = G.screen_anomalies(G.isolation_scores(df, "id", f, trees=60), 0.012).persist()
    assert G.recall_of(screened, F.col("truth") == 9, F.col("is_anomaly")).first().recall == 1.0
    core = screened.filter("truth <> 9").drop("anomaly_score", "is_anomaly").persist()
    chosen = [r.k for r in G.choose_k(core, f, range(2, 6)).collect() if r.chosen]
    assert chosen == [4]
    labelled, model = G.kmeans_labels(core, f, 4, 2)
    assert M.adjusted_rand(labelled, "truth", "cluster").first()[0] > 0.97
    assert G.inertia(labelled, f, list(model.centers)).first()[0] == pytest.approx(model.cost, rel=1e-6)
    ward = G.ward_labels(labelled, f, 4, micro=40)
    assert M.adjusted_rand(ward, "cluster", "ward").first()[0] > 0.95
    x = np.array(core.select(*f).collect())
    lam = np.linalg.svd(x - x.mean(0), compute_uv=False) ** 2
    assert [r.ratio for r in G.pca_ratios(core, f).orderBy("component").collect()] == pytest.approx(list(lam / lam.sum()))


def test_standardize(spark):
    df = spark.createDataFrame([(1, 0.0, 7.0), (2, 10.0, 7.0), (3, 20.0, 7.0)], "id int, v double, k double")
    got = G.standardize(df, ["v", "k"], ["v"]).orderBy("id").collect()
    z = np.log1p([0, 10, 20])
    assert [r.v for r in got] == pytest.approx(list((z - z.mean()) / z.std())) and [r.k for r in got] == [0, 0, 0]


def test_csv_round_trip_keeps_defects(spark):
    rows = [("a", " x "), ("b", ""), ("c", None), ("d", 'say "hi", ok'), ("e", "two\nlines")]
    path = files.write_csv(spark.createDataFrame(rows, "k string, v string"), fresh_path(spark, "t"))
    assert sorted((r.k, r.v) for r in files.read_text_csv(spark, path, ["k", "v"]).collect()) == rows


def test_typed_csv_rejects_malformed_rows(spark):
    path = files.write_csv(spark.createDataFrame([("1",), ("x",)], "n string"), fresh_path(spark, "t"))
    with pytest.raises(Exception):
        files.read_typed_csv(spark, path, "n int").collect()


def test_fingerprints(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)] + [(5, 5.0)], "a int, b double")
    one = lineage.frame_fingerprint(df, ["a", "b"]).first()
    assert one == lineage.frame_fingerprint(df.repartition(7).orderBy(F.desc("b")), ["a", "b"]).first()
    assert one.fingerprint_16 != lineage.frame_fingerprint(df.withColumn("b", F.when(F.col("a") == 7, 7.5).otherwise(F.col("b"))), ["a", "b"]).first().fingerprint_16
    assert one.fingerprint_16 != lineage.frame_fingerprint(df.distinct(), ["a", "b"]).first().fingerprint_16
    f = tmp_path / "x.bin"
    f.write_bytes(b"abc")
    assert lineage.file_fingerprints(spark, [str(f)]).first().sha256_12 == hashlib.sha256(b"abc").hexdigest()[:12]


def test_source_registry(tables):
    assert tables.location("orders").endswith("/orders.parquet")
    with pytest.raises(KeyError):
        tables.location("nothing")
    assert set(tables.register_views("v_")) == {"v_" + n for n in tables.schemas}
