"""Text formats, generation, encoding and footprint."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyho.functions.text import human_bytes, with_awk_mean_text
from tallyho.operators import encoding as E
from tallyho.operators import generate as G
from tallyho.sources.measurements import events_measurements
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("s,n,text", [
    (50, 1, "5"), (146, 10, "1.46"), (123, 1, "12.3"), (-999, 1, "-99.9"), (0, 5, "0"),
    (1, 3, "0.0333333"), (2, 3, "0.0666667"), (10, 7, "0.142857"), (1234567, 100000, "1.23457"),
    (1, 1000000, "1e-07"), (3, 100000, "3e-06"), (1, 100000, "1e-06"), (5, 10000, "5e-05"),
    (1, 1000, "0.0001"), (-7, 3000, "-0.000233333"), (358891, 16000, "2.24307"),
    (1, 2000001, "5e-08"), (1, 2000011, "4.99997e-08"), (999999, 100000, "0.999999"), (9999995, 1000000, "1"),
])
def test_awk_mean_text(spark, s, n, text):
    df = spark.createDataFrame([(s, n)], "s bigint, n bigint")
    assert with_awk_mean_text(df, "s", "n", "t").first().t == text


def test_awk_mean_text_matches_c_format_off_ties(spark):
    import random

    rnd = random.Random(5)
    cases = [(rnd.randint(-999 * k, 999 * k), k) for k in (1, 3, 7, 11, 13, 17, 29, 31, 37, 41) for _ in range(20)]
    df = spark.createDataFrame(cases, "s bigint, n bigint")
    for r in with_awk_mean_text(df, "s", "n", "t").collect():
        assert r.t == ("%.6g" % (r.s / (10 * r.n))), (r.s, r.n)


def test_human_bytes(spark):
    vals = [0.0, 1023.0, 1024.0, 1536.0, 1024.0 ** 2 * 3.25, 1024.0 ** 3 * 2.5, 1024.0 ** 4]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.t for r in df.select(human_bytes("v").alias("t")).collect()]
    assert got == ["0.0 bytes", "1023.0 bytes", "1.0 KiB", "1.5 KiB", "3.2 MiB", "2.5 GiB", None]


def test_generate_exact_rows_and_range(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "station string")
    g = G.generate_measurements(spark, names, 12_345)
    assert g.count() == 12_345 and g.select("rid").distinct().count() == 12_345
    r = g.agg(F.min("measure"), F.max("measure")).first()
    assert r[0] >= D("-99.9") and r[1] <= D("99.9")
    seeded = G.generate_measurements(spark, names, 5_000, seed=11)
    assert seeded.count() == 5_000
    assert set(x.station for x in seeded.select("station").distinct().collect()) <= {"a", "b", "c"}
    assert sorted(map(tuple, seeded.collect())) != sorted(map(tuple, G.generate_measurements(spark, names, 5_000).collect()))
    shuffled = G.generate_measurements(spark, names, 5_000, seed=11, max_broadcast_bytes=0)
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, seeded.collect()))


def test_generate_is_a_draw(spark):
    """Counts per station vary, rows don't repeat, and neither depends on how rows are split."""
    names = spark.range(400).selectExpr("concat('n', id) AS station")
    rows = G.generate_measurements(spark, names, 400_000, seed=5)
    counts = [r["count"] for r in rows.groupBy("station").count().collect()]
    assert min(counts) < 700 and max(counts) > 1_300
    halves = rows.selectExpr("rid % 200000 AS p", "station", "measure").groupBy("p").agg(
        F.countDistinct("station", "measure").alias("d"))
    assert halves.where("d = 1").count() < 1_000  # a period would make all of them equal
    key = "spark.sql.leafNodeDefaultParallelism"
    want = sorted(map(tuple, G.generate_measurements(spark, names, 3_000, seed=5).collect()))
    for cores in ("2", "4"):
        spark.conf.set(key, cores)
        try:
            assert sorted(map(tuple, G.generate_measurements(spark, names, 3_000, seed=5).collect())) == want
            assert G.generate_cyclic(spark, names, 50, seed=1).count() == 50
        finally:
            spark.conf.unset(key)


def test_generate_fewer_than_batch(spark):
    names = spark.createDataFrame([("x",)], "station string")
    assert G.generate_measurements(spark, names, 7).count() == 7


def test_generate_cyclic_and_choice(spark):
    cities = spark.createDataFrame([("b",), ("a",), ("c",)], "station string")
    rows = G.generate_cyclic(spark, cities, 10, seed=1)
    counts = {r.city: r["count"] for r in rows.groupBy("city").count().collect()}
    assert counts == {"a": 4, "b": 3, "c": 3}
    assert rows.where((F.col("value") < -99) | (F.col("value") > 99)).count() == 0
    ids = spark.range(5000)
    ch = G.generate_choice(ids.where("id < 1000"), n_labels=20, seed=0)
    assert ch.select("estacao").distinct().count() == 20
    assert ch.where((F.col("medida") < -20) | (F.col("medida") > 50)).count() == 0
    assert sorted(ch.collect()) == sorted(G.generate_choice(ids.repartition(3).where("id < 1000"), seed=0).collect())
    det = G.generate_choice(ids, n_labels=20, seed=3)
    r = det.agg(F.min("medida"), F.max("medida"), F.countDistinct("estacao")).first()
    assert r[0] >= -20 and r[1] <= 50 and r[2] == 20


def test_size_estimate(spark):
    names = spark.createDataFrame([("ab",), ("abcdef",)], "station string")
    r = G.size_estimate(names, 1_000_000).first()
    assert (r.max_len, r.min_len, r.record_bytes) == (6, 2, 8.5)
    assert r.size_text == "8.1 MiB"


def test_dictionary_roundtrip_and_types(spark):
    m = events_measurements(spark, SF_SMALL)
    enc, dictionary = E.dictionary_encode(m, "station")
    k = dictionary.count()
    assert k == m.select("station").distinct().count()
    codes = [r.station_code for r in dictionary.orderBy("station").collect()]
    assert codes == list(range(k))
    assert dict(enc.dtypes)["station_code"] == "int"
    assert dict(E.dictionary_encode(m, "station", code_type="bigint")[0].dtypes)["station_code"] == "bigint"
    back = E.dictionary_decode(enc, dictionary, "station")
    assert sorted(map(tuple, back.select("rid", "station", "measure").collect())) == \
        sorted(map(tuple, m.select("rid", "station", "measure").collect()))


def test_footprint_and_types(spark):
    m = events_measurements(spark, SF_SMALL).select("station", F.col("measure").cast("double").alias("measure"))
    prof = {r.column: r for r in E.footprint_profile(m).collect()}
    n = m.count()
    assert prof["measure"].bytes_before == 8 * n and prof["measure"].bytes_after == 4 * n
    assert prof["total"].bytes_before == prof["station"].bytes_before + prof["measure"].bytes_before
    assert 0 < prof["total"].reduction < 1
    types = {r.column: r.type for r in E.describe_types(spark, E.downcast_measure(m)).collect()}
    assert types == {"station": "string", "measure": "float"}


def test_dictionary_shuffle_fallback(spark):
    m = events_measurements(spark, SF_SMALL)
    enc_b, d = E.dictionary_encode(m, "station")
    enc_s, _ = E.dictionary_encode(m, "station", max_broadcast_bytes=0)
    plan = enc_s._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan or "AdaptiveSparkPlan" in plan
    assert sorted(map(tuple, enc_b.collect())) == sorted(map(tuple, enc_s.collect()))
