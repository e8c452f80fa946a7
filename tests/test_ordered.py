import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import joins as J
from ledgerline.operators import ordered as O


def frame(spark, n=4000):
    # A third of all rows share one value, and one group holds two thirds of the rows.
    rng = np.random.default_rng(3)
    rows = [(i, "big" if i % 3 else "small", 5.0 if i % 3 == 0 else float(np.round(rng.normal(0, 10), 2))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, g string, v double")


def test_exact_quantiles(spark):
    rows, df = frame(spark)
    probs = {"lo": 0.0, "q1": 0.25, "odd": 0.317, "med": 0.5, "q9": 0.9, "hi": 1.0}
    whole = O.exact_quantiles(df, "v", probs).first()
    v = np.array([r[2] for r in rows])
    for name, p in probs.items():
        assert whole[name] == pytest.approx(np.quantile(v, p), abs=1e-9)
    for r in O.exact_quantiles(df, "v", probs, ["g"]).collect():
        own = np.array([x[2] for x in rows if x[1] == r.g])
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(own, p), abs=1e-9)


def test_quantiles_of_one_row_and_nulls(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", None), ("b", None)], "g string, v double")
    assert [tuple(r) for r in O.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()] == [("a", 2.0)]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rows, df = frame(spark)
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.v: r["upto"] for r in O.running_totals(counts, "v", {"upto": "n"}, descending=descending).collect()}
    v = np.array([r[2] for r in rows])
    for value in list(got)[:300]:
        assert got[value] == ((v >= value).sum() if descending else (v <= value).sum())


def test_kth_largest(spark):
    rows, df = frame(spark)
    v = np.sort([r[2] for r in rows])[::-1]
    for k in (1, 7, 1000, 4000):
        assert O.kth_largest(df, "v", k) == v[k - 1]
    assert O.kth_largest(df, "v", 4001) is None


def test_codes_sort_as_doubles(spark):
    rng = np.random.default_rng(8)
    v = rng.integers(0, 2**63, 4000, dtype=np.int64).view("<f8")
    powers = np.ldexp(1.0, np.arange(-1074, 1024))
    v = np.concatenate([v[np.isfinite(v)], -powers, powers, np.nextafter(powers, 0), np.nextafter(powers, np.inf), [0.0, np.inf, -np.inf], rng.normal(size=500)])
    got = [(r.v, r._code) for r in O.coded(spark.createDataFrame([(float(x),) for x in v], "v double"), "v").collect()]
    want = sorted({abs(x) if x == 0 else x for x, _ in got})
    codes = {abs(x) if x == 0 else x: code for x, code in got}
    assert [codes[x] for x in want] == sorted(set(codes.values())) and len(set(codes.values())) == len(want)
    for x, code in got:
        if x >= 0:
            assert code == int(np.float64(abs(x)).view("<i8"))
    odd = O.coded(spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (-0.0,)], "v double"), "v").collect()
    assert odd[0]._code > odd[1]._code and odd[2]._code is None and odd[3]._code == 0
    big = [2**62, 2**62 + 1, -5]
    assert [r._code for r in O.coded(spark.createDataFrame([(x,) for x in big], "v long"), "v").collect()] == big


def test_cells_are_cut_until_they_fit(spark, monkeypatch):
    """The same answers when a task may sort three rows, and when lists of cells are too long to be sent."""
    rows, df = frame(spark, 900)
    df = df.withColumn("g", F.when(F.col("g") == "big", F.col("g")))
    monkeypatch.setattr(O, "FIT", 3)
    v = np.array([r[2] for r in rows])
    for sent in (O.SENT_CELLS, 0):
        monkeypatch.setattr(O, "SENT_CELLS", sent)
        got = {r.g: r.m for r in O.exact_quantiles(df, "v", {"m": 0.3}, ["g"]).collect()}
        assert got == {None: pytest.approx(np.quantile([r[2] for r in rows if r[1] == "small"], 0.3)), "big": pytest.approx(np.quantile([r[2] for r in rows if r[1] == "big"], 0.3))}
        upto = {r.v: r["upto"] for r in O.running_totals(df.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v", {"upto": "n"}, descending=True).collect()}
        assert all(upto[x] == (v >= x).sum() for x in upto)
    assert [O.kth_largest(df, "v", k) for k in (1, 100, 450, 900)] == [np.sort(v)[::-1][k - 1] for k in (1, 100, 450, 900)]


def test_no_window_over_all_rows(spark):
    _, df = frame(spark, 50)
    counts = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    for made in (O.exact_quantiles(df, "v", {"m": 0.5}), O.running_totals(counts, "v", {"upto": "n"})):
        assert "SinglePartition" not in made._jdf.queryExecution().executedPlan().toString()


def test_global_number(spark):
    df = spark.createDataFrame([(c, i % 7) for i, c in enumerate("qwertyuiopasdfghjklzxcvbnm")], "c string, k int").repartition(5)
    got = [r.c for r in O.global_number(df, ["k", "c"], "n").orderBy("n").collect()]
    assert got == [r.c for r in df.orderBy("k", "c").collect()]
    assert sorted(r.n for r in O.global_number(df, ["k", "c"], "n").collect()) == list(range(1, 27))


def test_hash_rank_is_dense_and_repeatable(spark):
    _, df = frame(spark)
    a = O.hash_rank(df, ["g"], ["id"], 1, "r", "n")
    for g in a.groupBy("g").agg(F.min("r"), F.max("r"), F.countDistinct("r"), F.max("n"), F.count("*")).collect():
        assert g[1] == 1 and g[2] == g[3] == g[4] == g[5]
    again = O.hash_rank(df.repartition(7), ["g"], ["id"], 1, "r", "n")
    assert a.select("id", "r").exceptAll(again.select("id", "r")).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_beyond_broadcast(spark, monkeypatch, how):
    fact = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    fact = fact.withColumn("k", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("k")))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    plain = fact.join(dim, "k", how).select("id", "k", "x")
    monkeypatch.setattr(J, "SMALL_BYTES", -1)
    split = J.lookup_join(fact, dim, "k", how).select("id", "k", "x")
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_lookup_that_is_larger_than_estimated_is_not_broadcast(spark):
    # Catalyst takes a text for twenty bytes: 43 MB by its estimate, eight times as much in a broadcast.
    dim = spark.range(1_200_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100).alias("x"))
    found = J.lookup_join(spark.range(100).select((F.col("id") * 7).alias("k")), dim, "k")
    assert J.planned_bytes(dim) < J.SMALL_BYTES
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert found.count() == 100


def test_hot_keys_are_bounded(spark):
    fact = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in J.hot_keys(fact, ["k"], 100).collect()] == [0]


def test_codes_are_computed_once_for_quantiles(spark):
    df = spark.range(0, 3000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.37).alias("x"))
    plan = O.exact_quantiles(df, "x", {"p": 0.5}, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LOG2" not in plan.upper() and "POW" not in plan.upper()


def test_cells_of_one_value_are_not_cut(spark, monkeypatch):
    """A frequent value took all five steps, each a pass over all rows."""
    written, real = [], O.materialised
    monkeypatch.setattr(O, "FIT", 50)
    monkeypatch.setattr(O, "materialised", lambda df: written.append(df) or real(df))
    own = {"a": [10.0] * 400 + [3.0] * 90 + [77.0] * 60, "b": [6.0] * 300 + [float(i) for i in range(20)]}
    df = spark.createDataFrame([(g, v) for g, values in own.items() for v in values], "g string, v double")
    probs = {"low": 0.1, "mid": 0.5, "high": 0.93}
    got = O.exact_quantiles(df, "v", probs, ["g"]).collect()
    assert {r.g: [r[p] for p in probs] for r in got} == {g: pytest.approx([np.quantile(v, p) for p in probs.values()]) for g, v in own.items()}
    assert len(written) == 2


def test_cells_are_cut_beside_cells_of_one_value(spark, monkeypatch):
    monkeypatch.setattr(O, "FIT", 50)
    own = {"a": [10.0] * 400, "b": [1000.0 + i / 16 for i in range(400)] + [1010.5] * 90}
    df = spark.createDataFrame([(g, v) for g, values in own.items() for v in values], "g string, v double")
    got = {r.g: (r.low, r.mid) for r in O.exact_quantiles(df, "v", {"low": 0.31, "mid": 0.5}, ["g"]).collect()}
    assert got == {g: pytest.approx((np.quantile(v, 0.31), np.quantile(v, 0.5))) for g, v in own.items()}
