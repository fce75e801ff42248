"""Chunk state algebra, line index and chunked / prefix scans."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyho.operators import chunks as C
from tallyho.operators import summary as S
from tallyho.sources import lines as L
from tallyho.sources import text as T
from tallyho.sources.measurements import events_measurements
from tests.conftest import SF_ORACLE, SF_SMALL


def _sorted(rows):
    return [tuple(r) for r in rows]


def test_uneven_chunks_weighted_vs_mean_of_means(spark):
    df = spark.createDataFrame([(0, "A", D("1.0")), (0, "A", D("2.0")), (1, "A", D("6.0")), (1, "B", D("5.0"))],
                               "chunk_id bigint, station string, measure decimal(3,1)")
    merged = {r.station: r.mean_temperature for r in C.merge_partials(C.chunk_partials(df)).collect()}
    assert merged == {"A": D("3.0"), "B": D("5.0")}
    mom = {r.station: r.mean for r in C.mean_of_chunk_means(df).collect()}
    assert mom == {"A": 3.75, "B": 5.0}


def test_chunk_boundaries_exact(spark, tmp_text):
    path = tmp_text([f"S{i};{i}.0" for i in range(9)])
    ix = L.with_chunk_id(L.with_line_index(T.scan_text_decimal(spark, path)), 3)
    got = {}
    for r in ix.collect():
        got.setdefault(r.chunk_id, set()).add(r.station)
    assert got == {0: {"S0", "S1", "S2"}, 1: {"S3", "S4", "S5"}, 2: {"S6", "S7", "S8"}}


def test_line_index_over_files_and_splits(spark, tmp_path):
    d = tmp_path / "multi"
    d.mkdir()
    n = 0
    for f in range(3):
        (d / f"part-{f:05d}.csv").write_text("".join(f"s{n + i};{(n + i) % 100}.5\n" for i in range(700)))
        n += 700
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        ix = L.with_line_index(T.scan_text_decimal(spark, str(d)))
        rows = ix.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.line_idx for r in rows) == list(range(2100))
    assert all(r.station == f"s{r.line_idx}" for r in rows)


def _numbered(tmp_path, lines=4000, files=3):
    d = tmp_path / "numbered"
    d.mkdir()
    for f in range(files):
        rows = range(f * lines, (f + 1) * lines)
        (d / f"part-{f:05d}.txt").write_text("".join(f"s{i};{i % 100}.5\n" for i in rows))
    return str(d), lines * files


@pytest.mark.parametrize("change", [{"spark.sql.files.maxPartitionBytes": "7000"},
                                    {"spark.sql.files.maxPartitionBytes": "90000", "spark.sql.leafNodeDefaultParallelism": "16"},
                                    {"spark.sql.leafNodeDefaultParallelism": "1"}])
def test_line_index_survives_changed_split_planning(spark, tmp_path, change):
    """Settings that change splits between building the index and running it."""
    path, n = _numbered(tmp_path)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism")
    spark.conf.set(keys[0], "20000")
    spark.conf.set(keys[1], "4")
    try:
        indexed = L.with_line_index(T.scan_text_decimal(spark, path))
        for k, v in change.items():
            spark.conf.set(k, v)
        rows = sorted((r.line_idx, r.station) for r in indexed.collect())
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert rows == [(i, f"s{i}") for i in range(n)]


def test_line_index_refuses_offsets_of_other_rows(spark, tmp_path):
    path, _ = _numbered(tmp_path, lines=500)
    stored = L.stored_rows(T.scan_text_decimal(spark, path))
    offsets = L.block_offsets(stored)
    for wrong in (offsets.limit(2), offsets.withColumn("_n", F.lit(10).cast("bigint")),
                  offsets.withColumn("_first", F.col("_first") + 1)):
        with pytest.raises(Exception, match="line index"):
            L.place_rows(stored, wrong, ["station"], True).collect()


def test_chunk_partials_stay_few(spark):
    """Chunks are a fixed number, so partials are at most chunks x stations."""
    from tallyho.queries import CHUNKS, QUERIES

    partials = QUERIES["chunk_partials"](spark, SF_SMALL)
    stations = events_measurements(spark, SF_SMALL).select("station").distinct().count()
    assert partials.select("chunk_id").distinct().count() <= CHUNKS and partials.count() <= CHUNKS * stations


def test_chunk_apply_query_bounds_its_frames(spark, monkeypatch):
    """No chunk of the registered query exceeds its bytes, and there are eight or more at sf0.01."""
    from tallyho import queries

    seen = []
    monkeypatch.setattr(queries.C, "chunk_apply_udf", lambda df, f=C.chunk_apply_udf: seen.append(df) or f(df))
    got = _sorted(queries.QUERIES["chunk_apply_udf"](spark, SF_ORACLE).collect())
    m = events_measurements(spark, SF_ORACLE)
    assert got == _sorted(S.summary_decimal(m).collect())
    sizes = seen[0].groupBy("chunk_id").agg(F.sum(C.row_bytes(seen[0])).alias("b"), F.count("*").alias("n")).collect()
    assert max(r.b for r in sizes) <= queries.UDF_CHUNK_BYTES and sum(r.n for r in sizes) == m.count() and len(sizes) >= 8


@pytest.mark.parametrize("bound", [1, 50, 200, 10_000])
def test_byte_chunks_hold_their_bound(spark, bound):
    rows = [(i, None if i % 7 == 0 else "s" * (i * 37 % 150), D("1.0")) for i in range(300)]
    df = spark.createDataFrame(rows, "rid bigint, station string, measure decimal(3,1)").repartition(5)
    chunked = C.with_byte_chunks(df, "rid", bound)
    assert chunked.columns == ["rid", "station", "measure", "chunk_id"]
    found = chunked.groupBy("chunk_id").agg(F.sum(C.row_bytes(chunked)).alias("b"), F.count("*").alias("n"),
                                            F.min("rid").alias("lo"), F.max("rid").alias("hi")).collect()
    assert all(r.b <= bound or r.n == 1 for r in found) and sum(r.n for r in found) == 300
    even = sorted((r.lo, r.hi) for r in found if r.chunk_id % 2 == 0)
    assert all(a[1] < b[0] for a, b in zip(even, even[1:]))  # consecutive rows
    with pytest.raises(ValueError):
        C.with_byte_chunks(df, "rid", 0)


def test_prefix(spark, tmp_text):
    path = tmp_text(["A;1.0", "A;3.0", "B;2.0", "A;9.0"])
    ix = L.with_line_index(T.scan_text_decimal(spark, path))
    got = {r.station: r.mean_temperature for r in S.summary_decimal(L.first_lines(ix, 3)).collect()}
    assert got == {"A": D("2.0"), "B": D("2.0")}
    assert S.summary_decimal(L.first_lines(ix, None)).count() == 2


@pytest.mark.parametrize("chunk", [1, 7, 100, 5000])
def test_merge_equals_summary_any_chunk(spark, chunk):
    m = events_measurements(spark, SF_SMALL)
    chunked = m.withColumn("chunk_id", F.call_function("div", F.col("rid"), F.lit(chunk)))
    a = _sorted(S.summary_decimal(m).collect())
    assert _sorted(C.merge_partials(C.chunk_partials(chunked)).collect()) == a
    parts = C.chunk_partials(chunked)
    assert parts.agg(F.sum("count")).first()[0] == m.count()


def test_udf_paths_equal_native(spark):
    m = events_measurements(spark, SF_SMALL)
    a = _sorted(S.summary_decimal(m).collect())
    assert _sorted(C.batch_partials_udf(m).collect()) == a
    chunked = m.withColumn("chunk_id", F.call_function("div", F.col("rid"), F.lit(100)))
    assert _sorted(C.chunk_apply_udf(chunked).collect()) == a


def test_union_partials_is_bag_union(spark):
    m = events_measurements(spark, SF_SMALL).withColumn("chunk_id", F.lit(0).cast("bigint"))
    p = C.chunk_partials(m)
    u = C.union_partials(p, p)
    assert u.count() == 2 * p.count()
    merged = {r.station: (r.min_temperature, r.mean_temperature) for r in C.merge_partials(u).collect()}
    single = {r.station: (r.min_temperature, r.mean_temperature) for r in C.merge_partials(p).collect()}
    assert merged == single


def test_row_order_and_split_count_do_not_matter(spark):
    m = events_measurements(spark, SF_SMALL)
    a = _sorted(S.summary_decimal(m).collect())
    assert _sorted(S.summary_decimal(m.repartition(13).orderBy(F.rand(3))).collect()) == a


def test_exclusive_prefix_sum_matches_cumsum(spark):
    import random

    from tallyho.operators.indexing import dense_index, exclusive_prefix_sum

    rnd = random.Random(3)
    rows = [(f"k{i:05d}", rnd.randint(0, 50)) for i in range(3000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, w long").repartition(7)
    got = {r.k: r.offset for r in exclusive_prefix_sum(df, ["k"], "w").collect()}
    acc, want = 0, {}
    for k, w in sorted(rows):
        want[k] = acc
        acc += w
    assert got == want
    idx = {r.k: r.idx for r in dense_index(df, "k").collect()}
    assert idx == {k: i for i, (k, _) in enumerate(sorted(rows))}


def test_line_index_skips_empty_lines_and_handles_crlf(spark, tmp_path):
    d = tmp_path / "crlf"
    d.mkdir()
    expected = []
    k = 0
    for f in range(4):
        lines = []
        for i in range(300):
            if i % 50 == 7:
                lines.append("")
            lines.append(f"r{k};{k % 100}.0")
            expected.append(f"r{k}")
            k += 1
        (d / f"part-{f:05d}.txt").write_bytes(("\r\n".join(lines) + "\r\n").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        rows = L.with_line_index(T.scan_text_decimal(spark, str(d))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.station for r in sorted(rows, key=lambda r: r.line_idx)] == expected
    assert sorted(r.line_idx for r in rows) == list(range(len(expected)))
