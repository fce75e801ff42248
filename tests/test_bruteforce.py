"""Brute-force checks against exact rational arithmetic in plain Python."""

import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from tallyho.functions.stats import sum_tenths
from tallyho.functions.text import with_awk_mean_text
from tallyho.operators import chunks as C
from tallyho.operators import summary as S


def _half_away(fr: Fraction, places: int) -> Decimal:
    q = Decimal(fr.numerator) / Decimal(fr.denominator)
    return q.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP) if fr >= 0 else \
        -((-q).quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def _six_digits(fr: Fraction) -> str:
    if fr == 0:
        return "0"
    sign = "-" if fr < 0 else ""
    a = abs(fr)
    x = 1
    while Fraction(10) ** x > a:
        x -= 1
    mant = (a * Fraction(10) ** (5 - x) * 2 + 1) // 2
    if mant >= 10 ** 6:
        mant //= 10
        x += 1
    digits = str(mant)
    if x >= -4:
        d = 5 - x
        whole, frac = (digits[:-d] or "0"), digits[-d:].rjust(d, "0") if d else ""
        frac = frac.rstrip("0")
        return sign + (whole if not frac else f"{whole}.{frac}")
    rest = digits[1:].rstrip("0")
    return sign + digits[0] + (f".{rest}" if rest else "") + f"e-{-x:02d}"


def _data(seed=7, rows=20_000):
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        st = "hot" if i % 3 == 0 else f"s{rnd.randint(0, 400)}"
        out.append((i, st, rnd.randint(-999, 999)))
    return out


def test_summary_matches_exact_fractions(spark):
    data = _data()
    df = spark.createDataFrame(data, "rid long, station string, t long").select(
        "rid", "station", (F.col("t").cast("decimal(20,0)") / 10).cast("decimal(3,1)").alias("measure"))
    groups = {}
    for _, st, t in data:
        groups.setdefault(st, []).append(t)
    want = {st: (Decimal(min(v)) / 10, _half_away(Fraction(sum(v), 10 * len(v)), 1), Decimal(max(v)) / 10)
            for st, v in groups.items()}
    got = {r.station: (r.min_temperature, r.mean_temperature, r.max_temperature)
           for r in S.summary_decimal(df).collect()}
    assert got == want
    chunked = df.withColumn("chunk_id", F.call_function("div", F.col("rid"), F.lit(777)))
    assert {r.station: (r.min_temperature, r.mean_temperature, r.max_temperature)
            for r in C.merge_partials(C.chunk_partials(chunked)).collect()} == want
    assert {r.station: (r.min_temperature, r.mean_temperature, r.max_temperature)
            for r in S.summary_arrays(df, list_rows=500).collect()} == want
    # the hot station holds a third of the rows and still lands in one exact group
    assert len(groups["hot"]) == len(data) // 3 + (1 if len(data) % 3 else 0)


def test_six_digit_text_matches_exact_fractions(spark):
    rnd = random.Random(11)
    cases = []
    for _ in range(3000):
        n = rnd.choice([1, 2, 3, 7, 16, 64, 128, 1000, 3000, 10 ** 6, 10 ** 9])
        s = rnd.randint(-999 * n, 999 * n) if rnd.random() < 0.8 else rnd.randint(-5, 5)
        cases.append((s, n))
    df = spark.createDataFrame(cases, "s long, n long")
    got = {(r.s, r.n): r.t for r in with_awk_mean_text(df, "s", "n", "t").collect()}
    for s, n in cases:
        assert got[(s, n)] == _six_digits(Fraction(s, 10 * n)), (s, n)


def test_sum_tenths_roundtrip(spark):
    df = spark.createDataFrame([(Decimal("12345678901234.5"),)], "x decimal(18,1)")
    assert df.select(sum_tenths("x").alias("t")).first().t == 123456789012345


def test_dictionary_encode_hot_key_shuffle_path(spark):
    from tallyho.operators import encoding as E

    data = _data(seed=5, rows=9_000)
    df = spark.createDataFrame(data, "rid long, station string, t long")
    enc, dictionary = E.dictionary_encode(df, "station", max_broadcast_bytes=0)
    names = sorted({st for _, st, _ in data})
    code = {n: i for i, n in enumerate(names)}
    got = {r.rid: r.station_code for r in enc.collect()}
    assert got == {rid: code[st] for rid, st, _ in data}
    back = E.dictionary_decode(enc, dictionary, "station", max_broadcast_bytes=0)
    assert sorted(map(tuple, back.select("rid", "station", "t").collect())) == sorted(data)


def test_parsers_roundtrip_random_names(spark):
    from tallyho.session import fresh_dir
    from tallyho.sinks.files import write_measurement_text
    from tallyho.sources import text as T

    rnd = random.Random(23)
    alphabet = ['a', 'Z', ' ', ';', '"', 'é', 'İ', '-', '.', '#', '\t', '0']
    rows = []
    for i in range(2000):
        name = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 8)))
        rows.append((f"{i}:{name}", Decimal(rnd.randint(-999, 999)) / 10))
    df = spark.createDataFrame(rows, "station string, measure decimal(3,1)")
    path = write_measurement_text(df, fresh_dir(spark, "rt-random"), files=3)
    want = sorted(rows)
    for parser in ("lines", "csv"):
        got = sorted(tuple(r) for r in T.scan_text_decimal(spark, path, parser=parser).collect())
        assert got == want, parser


def test_dictionary_shuffle_path_splits_hot_key(spark):
    from tallyho.operators import encoding as E

    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(90_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
             .otherwise(F.concat(F.lit("s"), (F.col("id") % 500).cast("string"))).alias("station"),
            F.col("id").alias("rid"))
        enc, _ = E.dictionary_encode(df, "station", max_broadcast_bytes=0)
        rows = enc.collect()
        plan = enc._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 90_000
    assert "SortMergeJoin(skew=true)" in plan
