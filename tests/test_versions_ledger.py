"""Published versions (K1, K6) and the fan-out's ledger of chunks (K8)."""

import pytest

from tallyho.operators import summary as S
from tallyho.plans import etl
from tallyho.sinks import versions
from tallyho.sources import text as T


def _lines(n=1000):
    return [f"s{i * 7 % 13};{i % 100}.{i % 10}" for i in range(n)]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_publish_points_to_whole_versions_only(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        versions.current(spark, root)
    first = versions.publish(spark, root, lambda f: spark.range(3).write.parquet(f))
    assert versions.current(spark, root) == first

    def half(folder):
        spark.range(99).write.parquet(f"{folder}/part")
        raise OSError("disk full")

    with pytest.raises(OSError):
        versions.publish(spark, root, half)
    assert versions.current(spark, root) == first and spark.read.parquet(first).count() == 3
    second = versions.publish(spark, root, lambda f: spark.range(4).write.parquet(f))
    assert versions.current(spark, root) == second and spark.read.parquet(first).count() == 3
    gone = versions.remove_unused(spark, root)
    assert len(gone) == 2 and versions.current(spark, root) == second and spark.read.parquet(second).count() == 4
    assert versions.remove_unused(spark, root) == []
    with pytest.raises(ValueError):
        versions.remove_unused(spark, root, 0)


def test_versions_are_numbered_beyond_removed_ones(spark, tmp_path):
    root = str(tmp_path / "out")
    for i in range(12):
        versions.publish(spark, root, lambda f: spark.range(i).write.parquet(f))
        if i == 5:
            versions.remove_unused(spark, root, keep=2)
    assert [n for n, _ in versions.published(spark, root)] == list(range(4, 12))
    assert spark.read.parquet(versions.current(spark, root)).count() == 11


@pytest.mark.parametrize("stage", ["transform", "load"])
def test_a_failed_stage_keeps_the_previous_summary(spark, tmp_path, tmp_text, monkeypatch, stage):
    src, work = tmp_text(["A;1.0", "B;2.0"]), str(tmp_path / "work")
    etl.staged_etl(spark, src, work)
    before = _rows(spark.read.parquet(versions.current(spark, f"{work}/summary")))
    (tmp_path / "m.txt").write_text("A;5.0\n")
    write, calls = etl.write_parquet, []

    def breaks(df, folder, **more):
        write(df, folder, **more)  # all files are there, but the stage doesn't end
        calls.append(folder)
        if len(calls) == {"transform": 2, "load": 3}[stage]:
            raise RuntimeError("executor lost")

    monkeypatch.setattr(etl, "write_parquet", breaks)
    with pytest.raises(RuntimeError):
        etl.staged_etl(spark, src, work)
    monkeypatch.undo()
    assert _rows(spark.read.parquet(versions.current(spark, f"{work}/summary"))) == before
    done = etl.staged_etl(spark, src, work)
    assert [r.station for r in spark.read.parquet(done).collect()] == ["A"]
    assert versions.current(spark, f"{work}/summary") == done
    removed = etl.remove_replaced(spark, work)
    assert set(removed) == {"extracted", "transformed", "summary"} and all(removed.values())
    assert spark.read.parquet(done).count() == 1


def test_staged_etl_over_inferred_types(spark, tmp_path, tmp_text):
    src = tmp_text(["A;1", "A;2", "B;7"])
    out = spark.read.parquet(etl.staged_etl(spark, src, str(tmp_path / "work"), "inferred"))
    assert {r.station: r.mean_temperature for r in out.collect()} == {"A": 1.5, "B": 7.0}


# ------------------------------------------------------------------ the ledger
def test_a_broken_fan_out_is_finished_by_a_rerun(spark, tmp_path, tmp_text, monkeypatch):
    src, work = tmp_text(_lines()), str(tmp_path / "fan")
    partials, calls = etl.chunk_partials, []

    def breaks(rows):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("executor lost")
        return partials(rows)

    monkeypatch.setattr(etl, "chunk_partials", breaks)
    with pytest.raises(RuntimeError):
        etl.fan_out(spark, src, 90, work, wave=2)
    assert sorted(r.chunk_id for r in etl.ledger(spark, work).collect()) == [0, 1, 2, 3]
    monkeypatch.setattr(etl, "chunk_partials", lambda rows: calls.append(1) or partials(rows))
    calls.clear()
    assert etl.fan_out(spark, src, 90, work, wave=2) == 8 and len(calls) == 4
    found = sorted((r.chunk_id, r.n_lines) for r in etl.ledger(spark, work).collect())
    assert found == [(c, 90) for c in range(11)] + [(11, 10)]
    assert etl.fan_out(spark, src, 90, work, wave=2) == 0
    assert _rows(etl.merge_committed(spark, work)) == _rows(S.summary_decimal(T.scan_text_decimal(spark, src)))


def test_a_wave_that_was_not_committed_is_never_read(spark, tmp_path, tmp_text, monkeypatch):
    """It breaks after its partials are written: they stay outside of the ledger."""
    src, work = tmp_text(_lines(300)), str(tmp_path / "fan")
    with monkeypatch.context() as m:
        m.setattr(etl.versions, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            etl.fan_out(spark, src, 100, work)
    with pytest.raises(ValueError, match="no partial files"):
        etl.merge_committed(spark, work)
    assert etl.fan_out(spark, src, 100, work) == 3
    assert len(versions.names(spark, f"{work}/partials")) == 2
    assert _rows(etl.merge_committed(spark, work)) == _rows(S.summary_decimal(T.scan_text_decimal(spark, src)))


def test_other_chunks_or_input_are_refused(spark, tmp_path, tmp_text):
    from tallyho.sources.lines import ChangedInput

    src, work = tmp_text(_lines(100)), str(tmp_path / "fan")
    etl.fan_out(spark, src, 10, work, wave=4, waves=1)
    with pytest.raises(ValueError, match="another length"):
        etl.fan_out(spark, src, 20, work)
    (tmp_path / "m.txt").write_text("A;1.0\n")
    with pytest.raises(ChangedInput):
        etl.fan_out(spark, src, 10, work)
    with pytest.raises(FileNotFoundError):
        etl.fan_out(spark, str(tmp_path / "none.txt"), 10, str(tmp_path / "other"))
