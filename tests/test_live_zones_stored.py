"""Deltas and compaction (I1), zone maps (S10) and stored footprints."""

import os

import pytest

from tallyho.operators import encoding as E
from tallyho.operators import summary as S
from tallyho.sources import parquet as P
from tallyho.sources import text as T
from tallyho.streaming import incremental as N


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


@pytest.fixture()
def stream(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()

    def run(**more):
        return N.incremental_summary(spark, str(d), str(tmp_path / "out"), str(tmp_path / "ck"), state_partitions=2, **more)

    return d, str(tmp_path / "out"), run


def test_what_a_batch_writes_follows_the_changed_stations(spark, stream):
    d, out, run = stream
    (d / "a.txt").write_text("".join(f"station-{i:06d};{i % 90}.5\n" for i in range(20_000)))
    run()
    (d / "b.txt").write_text("station-000007;-9.9\n" * 20_000)
    run()
    now = N.manifest(spark, out)
    sizes = [_bytes(f"{out}/data/{f}") for f in now["deltas"]]
    counts = [spark.read.parquet(f"{out}/data/{f}").count() for f in now["deltas"]]
    assert counts == [20_000, 1] and sizes[1] < sizes[0] / 20
    assert _rows(spark.read.parquet(N.published(spark, out))) == _rows(S.summary_decimal(T.scan_text_decimal(spark, str(d))))


def test_compaction_keeps_the_summary_and_old_data_goes_on_request(spark, stream):
    d, out, run = stream
    for i in range(7):
        (d / f"f{i}.txt").write_text(f"A;{i}.0\nS{i};1.0\n;{i}.5\n")
    run(compact_every=3)
    now = N.manifest(spark, out)
    assert now["batch"] == 6 and now["base"] and len(now["deltas"]) == 1
    want = _rows(S.summary_decimal(T.scan_text_decimal(spark, str(d))))
    assert _rows(N.live_summary(spark, out)) == want
    assert len(N.remove_unused(spark, out)) == 7  # six merged deltas and a merged base
    assert _rows(N.live_summary(spark, out)) == want == _rows(spark.read.parquet(N.published(spark, out)))
    assert N.remove_unused(spark, out) == []


def test_restart_during_compaction(spark, stream, monkeypatch):
    d, out, run = stream
    for i in range(4):
        (d / f"f{i}.txt").write_text(f"A;{i}.0\nS{i};1.0\n")

    def breaks(session, path):
        N.live_state(session, path).write.parquet(f"{path}/data/base-broken")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(N, "compact", breaks)
        with pytest.raises(Exception, match="driver lost"):
            run(compact_every=2)
    assert len(N.manifest(spark, out)["deltas"]) == 2  # published before the compaction
    run(compact_every=2)
    want = _rows(S.summary_decimal(T.scan_text_decimal(spark, str(d))))
    assert _rows(N.live_summary(spark, out)) == want
    assert N.manifest(spark, out)["deltas"] == [] and "base-broken" in N.remove_unused(spark, out)


def test_a_batch_that_failed_before_its_manifest_is_written_again(spark, stream, monkeypatch):
    d, out, run = stream
    (d / "a.txt").write_text("A;1.0\nA;2.0\n")
    with monkeypatch.context() as m:
        m.setattr(N, "_publish_manifest", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="division"):
            run()
    with pytest.raises(FileNotFoundError):
        N.live_summary(spark, out)
    run()
    assert [r["count"] for r in N.live_state(spark, out).collect()] == [2]


# ------------------------------------------------------------------ zone map
@pytest.fixture()
def zoned(spark, tmp_path):
    rows = spark.createDataFrame([(f"s{i:03d}" if i else None, float(i)) for i in range(200)], "station string, v double")
    path = str(tmp_path / "summary")
    S.sort_stations(rows.repartition(7)).repartitionByRange(6, "station").sortWithinPartitions("station").write.parquet(path)
    P.write_zones(spark, path)
    return path


@pytest.mark.parametrize("station,files", [("s001", 1), ("s117", 1), ("s199", 1), ("s0015", None), ("zzz", 0), ("a", 0), (None, 1)])
def test_lookup_opens_the_files_of_its_zone_only(spark, zoned, station, files):
    found = P.lookup(spark, zoned, station)
    want = [r for r in P.serve_summary(spark, zoned).collect() if r.station == station]
    assert found.collect() == want and found.columns == ["station", "v"]
    opened = len(found.inputFiles())
    assert opened == files if files is not None else opened <= 1
    assert len(P.serve_summary(spark, zoned).inputFiles()) == 6


def test_zone_map_is_no_part_of_the_summary(spark, zoned):
    assert P.serve_summary(spark, zoned).count() == 200


# ------------------------------------------------------------------ stored footprint
def test_stored_footprint_at_two_sizes(spark):
    found = []
    for n in (2_000, 40_000):
        rows = spark.range(n).selectExpr("concat('a rather long station name ', id * 7919 % 500) AS station",
                                         "CAST(id * 104729 % 1999 / 10 AS DOUBLE) AS measure")
        report = {r["column"]: r for r in E.stored_footprint(rows.repartition(2)).collect()}
        assert set(report) == {"station", "measure", "total"}
        for c in ("bytes_before", "bytes_after"):
            assert report["total"][c] == report["station"][c] + report["measure"][c] > 0
        assert report["total"]["reduction"] == 1 - report["total"]["bytes_after"] / report["total"]["bytes_before"]
        found.append(report)
    assert found[1]["total"]["bytes_before"] > found[0]["total"]["bytes_before"]
    assert found[0]["station"]["bytes_before"] > found[0]["measure"]["bytes_before"] * 0.2
