"""Hand fixtures, edge lines and value rules of the flagship summary."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyho.operators import summary as S
from tallyho.sources import text as T

README_LINES = [
    "Hamburg;12.0", "Bulawayo;8.9", "Palembang;38.8", "St. Johns;15.2", "Cracow;12.6",
    "Bridgetown;26.9", "Istanbul;6.2", "Roseau;34.4", "Conakry;31.2", "Istanbul;23.0",
]


def test_readme_fixture(spark, tmp_text):
    out = S.summary_decimal(T.scan_text_decimal(spark, tmp_text(README_LINES))).collect()
    assert [r.station for r in out] == [
        "Bridgetown", "Bulawayo", "Conakry", "Cracow", "Hamburg", "Istanbul",
        "Palembang", "Roseau", "St. Johns"]
    ist = [r for r in out if r.station == "Istanbul"][0]
    assert (ist.min_temperature, ist.mean_temperature, ist.max_temperature) == (D("6.2"), D("14.6"), D("23.0"))
    for r in out:
        if r.station != "Istanbul":
            assert r.min_temperature == r.mean_temperature == r.max_temperature


def test_code_point_order_and_null_last(spark):
    names = ["Abha", "Abéché", "Z", "Zürich", "a", "Ürümqi", "İzmir", None]
    df = spark.createDataFrame([(n, D("1.0")) for n in reversed(names)], "station string, measure decimal(3,1)")
    got = [r.station for r in S.summary_decimal(df).collect()]
    assert got == names


def test_double_rounding_avoided(spark):
    # 99,999 x 0.1 and 100,001 x 0.0: true mean 0.0499995 -> 0.0 (avg(decimal) gives 0.1)
    df = spark.range(200_000).select(
        F.lit("s").alias("station"),
        F.when(F.col("id") < 99_999, F.lit(D("0.1"))).otherwise(F.lit(D("0.0"))).cast("decimal(3,1)").alias("measure"))
    r = S.summary_decimal(df).first()
    assert r.mean_temperature == D("0.0")


def test_half_away_from_zero(spark):
    df = spark.createDataFrame([("p", D("0.1")), ("p", D("0.2")), ("n", D("-0.1")), ("n", D("-0.2"))],
                               "station string, measure decimal(3,1)")
    got = {r.station: r.mean_temperature for r in S.summary_decimal(df).collect()}
    assert got == {"p": D("0.2"), "n": D("-0.2")}


def test_null_station_kept_and_dropped(spark, tmp_text):
    path = tmp_text([";5.0", "A;1.0", ";7.0"])
    df = T.scan_text_decimal(spark, path)
    rows = S.summary_decimal(df).collect()
    assert rows[-1].station is None and rows[-1].mean_temperature == D("6.0")
    assert [r.station for r in S.summary_decimal(df, drop_nulls=True).collect()] == ["A"]


def test_na_text_is_a_station(spark, tmp_text):
    rows = S.summary_decimal(T.scan_text_decimal(spark, tmp_text(["NA;5.0", "null;1.0"]))).collect()
    assert [r.station for r in rows] == ["NA", "null"]


@pytest.mark.parametrize("parser", ["lines", "csv"])
@pytest.mark.parametrize("line", ["A;100.0", "A;abc", "A", "A;1.0;zz", "A;1.0;2.0", '"abc;2.0'])
def test_bad_lines_fail(spark, tmp_text, line, parser):
    df = T.scan_text_decimal(spark, tmp_text(["B;1.0", line]), parser=parser)
    with pytest.raises(Exception):
        S.summary_decimal(df).collect()


@pytest.mark.parametrize("parser", ["lines", "csv"])
def test_edge_values(spark, tmp_text, parser):
    lines = ["A;12.35", '"A;x";1.0', '"Q ""x""";2.0', "C;-0.0", " S ; 1.0", "", "E;", "F;1e1", "G; ", "#c;1.0"]
    df = T.scan_text_decimal(spark, tmp_text(lines), parser=parser)
    got = {r.station: r.measure for r in df.collect()}
    assert got["A"] == D("12.4")
    assert got["A;x"] == D("1.0")
    assert got['Q "x"'] == D("2.0")
    assert got["C"] == D("0.0")
    assert got[" S "] == D("1.0")
    assert got["E"] is None
    assert got["F"] == D("10.0")
    assert got["G"] is None
    assert got["#c"] == D("1.0")
    assert len(got) == 9


def test_parsers_agree_with_crlf(spark, tmp_path):
    p = tmp_path / "crlf.txt"
    p.write_bytes(b"A;1.0\r\nB;2.5\r\nA;3.0\r\n")
    a = S.summary_decimal(T.scan_text_decimal(spark, str(p))).collect()
    b = S.summary_decimal(T.scan_text_decimal(spark, str(p), parser="csv")).collect()
    assert a == b and [r.station for r in a] == ["A", "B"]


def test_row_count_parses_measure(spark, tmp_text):
    df = T.scan_text_decimal(spark, tmp_text(["A;1.0", "B;bad"]))
    with pytest.raises(Exception):
        S.row_count(df).collect()


def test_variants_agree(spark, tmp_text):
    path = tmp_text(README_LINES)
    dec = {r.station: float(r.mean_temperature) for r in S.summary_decimal(T.scan_text_decimal(spark, path)).collect()}
    dbl = {r.station: r.mean_temperature for r in S.summary_double(T.scan_text_double(spark, path)).collect()}
    flt = {r.station: r.mean_temperature for r in S.summary_float(T.scan_text_float(spark, path)).collect()}
    arr = {r.station: float(r.mean_temperature) for r in S.summary_arrays(T.scan_text_decimal(spark, path), list_rows=2).collect()}
    split = {r.station: r.mean_temperature for r in S.summary_double(T.scan_lines_split(spark, path)).collect()}
    inf = {r.station: r.mean_temperature for r in S.summary_double(T.scan_text_inferred(spark, path)).collect()}
    assert dec == arr
    for k, v in dec.items():
        assert abs(dbl[k] - v) < 0.051 and abs(flt[k] - v) < 0.051
        assert split[k] == dbl[k] == inf[k]


def test_summary_head_and_counts(spark, tmp_text):
    df = T.scan_text_decimal(spark, tmp_text(README_LINES))
    head = S.summary_head(S.summary_decimal(df), 5).collect()
    assert [r.station for r in head] == ["Bridgetown", "Bulawayo", "Conakry", "Cracow", "Hamburg"]
    assert S.row_count(df).first().n_rows == 10
    assert S.station_count(df).first().n_stations == 9


def test_formatted(spark, tmp_text):
    df = T.scan_text_decimal(spark, tmp_text(README_LINES))
    got = {r.station: r.stats for r in S.summary_formatted(S.summary_decimal(df)).collect()}
    assert got["Istanbul"] == "6.2/14.6/23.0"


def test_min_le_mean_le_max(spark):
    from tallyho.sources.measurements import events_measurements
    from tests.conftest import SF_SMALL

    bad = S.summary_decimal(events_measurements(spark, SF_SMALL)).where(
        (F.col("min_temperature") > F.col("mean_temperature"))
        | (F.col("mean_temperature") > F.col("max_temperature"))).count()
    assert bad == 0


def test_plan_is_native_and_partial(spark):
    from tallyho.sources.measurements import events_measurements
    from tests.conftest import SF_SMALL

    df = S.summary_decimal(events_measurements(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Python" not in plan and "BatchEval" not in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


@pytest.mark.parametrize("parser", ["lines", "csv"])
def test_text_writer_roundtrip_awkward_names(spark, parser):
    from tallyho.session import fresh_dir
    from tallyho.sinks.files import write_measurement_text

    names = [" S ", "a;b", 'q"x', '"lead', "Zürich", "İzmir", None, "tab\there", "x "]
    df = spark.createDataFrame([(n, D("1.5")) for n in names], "station string, measure decimal(3,1)")
    path = write_measurement_text(df, fresh_dir(spark, "rt"))
    got = sorted((r.station is None, r.station or "") for r in T.scan_text_decimal(spark, path, parser=parser).collect())
    assert got == sorted((n is None, n or "") for n in names)


@pytest.mark.parametrize("parser", ["lines", "csv"])
def test_strict_without_ansi(spark, tmp_text, parser):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for line in ["A;100.0", "A;abc", "A;NaN"]:
            df = T.scan_text_decimal(spark, tmp_text(["B;1.0", line]), parser=parser)
            with pytest.raises(Exception):
                S.summary_decimal(df).collect()
        df = T.scan_lines_split(spark, tmp_text(["B;1.0", "A"]))
        with pytest.raises(Exception):
            df.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_double_input_is_taken_at_one_decimal(spark, tmp_text):
    path = tmp_text(["A;12.35", "A;1.0", "B;-0.05"])
    a = S.summary_decimal(T.scan_text_double(spark, path)).collect()
    b = S.summary_decimal(T.scan_text_decimal(spark, path)).collect()
    assert a == b


def test_text_flagship_plan(spark, tmp_text):
    df = S.summary_decimal(T.scan_text_decimal(spark, tmp_text(README_LINES)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" in plan and "FileScan csv" not in plan
    assert "partial_sum(UnscaledValue(" in plan
    assert "Python" not in plan


@pytest.mark.parametrize("line,expected", [
    ('"A";1.0;2.0', "error"), ('"A"', "error"), ('"A;1.0', "error"),
    ('"A";', ("A", None)), ('"A"x;1.0', ('"A"x', D("1.0"))), ('"A";"2.0"', ("A", D("2.0"))),
])
def test_quoted_edge_lines_agree(spark, tmp_text, line, expected):
    path = tmp_text(["B;1.0", line])
    for parser in ("lines", "csv"):
        df = T.scan_text_decimal(spark, path, parser=parser)
        if expected == "error":
            with pytest.raises(Exception):
                df.collect()
        else:
            assert tuple(df.collect()[-1]) == expected, parser
