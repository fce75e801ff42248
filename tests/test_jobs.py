"""Sinks, staged jobs, serving reads, incremental run and the SQL oracle."""

import os
from decimal import Decimal as D

import pytest

from tallyho.operators import summary as S
from tallyho.plans import etl
from tallyho.session import fresh_dir
from tallyho.sinks.files import write_measurement_text, write_parquet
from tallyho.sources import text as T
from tallyho.sources.measurements import events_measurements
from tallyho.sources.parquet import read_parquet, serve_summary, summary_sql_view
from tallyho.streaming.incremental import incremental_summary
from tests.conftest import SF_ORACLE, SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def m_text(spark):
    path = fresh_dir(spark, "test-m")
    write_measurement_text(events_measurements(spark, SF_SMALL), path, order_by="rid", files=4)
    return path


@pytest.fixture(scope="module")
def expected(spark):
    return _rows(S.summary_decimal(events_measurements(spark, SF_SMALL)))


def test_text_roundtrip(spark, m_text, expected):
    assert _rows(S.summary_decimal(T.scan_text_decimal(spark, m_text))) == expected


def test_staged_and_chained(spark, m_text, expected):
    work = fresh_dir(spark, "test-etl")
    out = etl.staged_etl(spark, m_text, work)
    assert _rows(read_parquet(spark, out)) == expected
    # re-runnable: every stage overwrites
    out = etl.staged_etl(spark, m_text, work)
    assert _rows(read_parquet(spark, out)) == expected
    one = etl.staged_etl(spark, m_text, fresh_dir(spark, "test-etl"), single_file=True)
    final = read_parquet(spark, one)
    assert len(final.inputFiles()) == 1 and [tuple(r) for r in final.collect()] == expected
    out2 = etl.chained_etl(spark, m_text, fresh_dir(spark, "test-chain"))
    assert _rows(read_parquet(spark, out2)) == expected


def test_missing_input(spark):
    with pytest.raises(FileNotFoundError):
        etl.extract(spark, "/nonexistent/measurements.txt", fresh_dir(spark, "x"))
    with pytest.raises(ValueError):
        etl.merge_partial_files(spark)
    with pytest.raises(FileNotFoundError):
        etl.merge_partial_files(spark, "/nonexistent/partials")


def test_partial_files_merge(spark, m_text, expected):
    work = fresh_dir(spark, "test-fan")
    pdir = etl.write_chunk_partials(spark, m_text, 300, f"{work}/partials")
    assert _rows(etl.merge_partial_files(spark, pdir)) == expected
    files = read_parquet(spark, pdir).inputFiles()
    assert _rows(etl.merge_partial_files(spark, *files)) == expected
    # files follow the shuffle, not the number of chunks
    many = etl.write_chunk_partials(spark, m_text, 10, f"{work}/many")
    assert read_parquet(spark, many).select("chunk_id").distinct().count() == 100
    assert len(read_parquet(spark, many).inputFiles()) <= 8
    assert sorted(r.chunk_id for r in read_parquet(spark, pdir).select("chunk_id").distinct().collect()) == [0, 1, 2, 3]


def test_serve_and_view(spark, expected):
    summ = S.summary_decimal(events_measurements(spark, SF_SMALL))
    path = write_parquet(summ, fresh_dir(spark, "test-serve"), single_file=True)
    assert _rows(serve_summary(spark, path)) == expected
    assert _rows(summary_sql_view(spark, events_measurements(spark, SF_SMALL))) == expected


def test_incremental_equals_batch(spark, m_text, expected):
    work = fresh_dir(spark, "test-stream")
    out = incremental_summary(spark, m_text, f"{work}/summary", f"{work}/ck", files_per_trigger=1,
                              state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert _rows(read_parquet(spark, out)) == expected


def test_station_names(spark, tmp_text):
    path = tmp_text(["# comment;1", "Abha;x", "Abha;y", "Oslo;1", "a#b;2"])
    assert sorted(r.station for r in T.station_names(spark, path).collect()) == ["Abha", "Oslo"]


@pytest.mark.skipif(not os.path.exists(SF_ORACLE), reason="no sf0.01 data")
def test_all_queries_match_oracle(spark):
    import duckdb

    from __spark_entry__ import entry
    from tallyho.queries import ORACLE, QUERIES
    from tools.check_oracle import TABLES, rows_of, spark_type_as_duck

    assert entry(spark).count() > 0
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    sqls = ORACLE
    for name, fn in QUERIES.items():
        df = fn(spark, SF_ORACLE)
        srows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            assert len(srows) > 0, name
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(dcols), name
        dtypes = {d[0]: str(d[1]).replace(" ", "") for d in res.description}
        assert {c: spark_type_as_duck(t) for c, t in df.dtypes} == dtypes, name
        assert rows_of(df.columns, srows) == rows_of(dcols, res.fetchall()), name


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")


def test_native_queries_have_no_python_nodes(spark):
    from tallyho.queries import QUERIES

    for name, fn in QUERIES.items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        has_python = any(n in plan for n in PYTHON_NODES)
        assert has_python == name.endswith("_udf"), name


def test_incremental_restart_picks_up_new_files(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("A;1.0\nB;2.0\n")
    work = fresh_dir(spark, "test-restart")
    out = incremental_summary(spark, str(d), f"{work}/summary", f"{work}/ck")
    first = {r.station: r.mean_temperature for r in read_parquet(spark, out).collect()}
    assert first == {"A": D("1.0"), "B": D("2.0")}
    (d / "b.txt").write_text("A;3.0\nC;-4.0\n")
    out = incremental_summary(spark, str(d), f"{work}/summary", f"{work}/ck")
    rows = {r.station: (r.min_temperature, r.mean_temperature, r.max_temperature)
            for r in read_parquet(spark, out).collect()}
    assert rows == {"A": (D("1.0"), D("2.0"), D("3.0")), "B": (D("2.0"),) * 3, "C": (D("-4.0"),) * 3}


def test_part_files_are_sorted_in_name_order(spark):
    """Several part files, written in parallel, and one file on request: both sorted."""
    from tallyho.sinks.files import write_lines

    m = events_measurements(spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = S.text_lines(S.summary_decimal(m))
        many = write_lines(lines, "value", fresh_dir(spark, "test-lines"))
        parquet = write_parquet(S.summary_decimal(m), fresh_dir(spark, "test-pq"))
        one = write_lines(lines, "value", fresh_dir(spark, "test-line"), single_file=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [r.value for r in S.text_lines(S.summary_decimal(m)).collect()]

    def by_file(path, read):
        files = sorted(read(path).inputFiles())
        return len(files), [r[0] for f in files for r in read(f).collect()]

    assert by_file(many, spark.read.text)[0] > 1 and by_file(many, spark.read.text)[1] == want
    assert by_file(parquet, spark.read.parquet)[0] > 1
    assert by_file(parquet, spark.read.parquet)[1] == sorted(by_file(parquet, spark.read.parquet)[1])
    assert by_file(one, spark.read.text) == (1, want)


def test_published_versions_stay_whole(spark, tmp_path):
    from tallyho.streaming.incremental import published

    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("A;1.0\n")
    work = fresh_dir(spark, "test-versions")
    first = incremental_summary(spark, str(d), f"{work}/s", f"{work}/ck")
    (d / "b.txt").write_text("A;3.0\n")
    second = incremental_summary(spark, str(d), f"{work}/s", f"{work}/ck")
    assert first != second == published(spark, f"{work}/s")
    assert [read_parquet(spark, p).first().max_temperature for p in (first, second)] == [1, 3]
    assert incremental_summary(spark, str(d), f"{work}/s", f"{work}/ck") == second  # nothing new


def test_two_frames_in_sql_at_once(spark):
    a, b = (spark.createDataFrame([("A", v)], "station string, measure decimal(3,1)") for v in (D("1.0"), D("2.0")))
    first, second = summary_sql_view(spark, a), summary_sql_view(spark, b)
    assert (first.first().max_temperature, second.first().max_temperature) == (1, 2)


def test_serving_a_path_with_a_backtick(spark):
    path = write_parquet(S.summary_decimal(events_measurements(spark, SF_SMALL)), fresh_dir(spark, "odd`name"))
    assert serve_summary(spark, path).count() > 0


def test_incremental_rocksdb_state(spark, m_text, expected):
    work = fresh_dir(spark, "test-rocks")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    out = incremental_summary(spark, m_text, f"{work}/summary", f"{work}/ck",
                              files_per_trigger=2, state_store="rocksdb")
    assert _rows(read_parquet(spark, out)) == expected
    assert spark.conf.get(key, None) == before
