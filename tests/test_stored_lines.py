"""Prefix reads (S6), stored lines (X1) and inferred types over lines."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyho.sinks import versions
from tallyho.sources import infer as I
from tallyho.sources import lines as L
from tallyho.sources import text as T


def _folder(tmp_path, files=5, lines=400, name="in put %1"):
    d = tmp_path / name
    d.mkdir()
    for f in range(files):
        rows = range(f * lines, (f + 1) * lines)
        (d / f"part-{f:05d} {{a}}.txt").write_text("".join(f"s{i};{i % 100}.5\n" for i in rows))
    return d


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("n", [0, 1, 399, 400, 401, 1234, 1999, 2000, 5000, None])
def test_prefix_is_the_first_lines(spark, tmp_path, small_splits, n):
    d = _folder(tmp_path)
    got = [r.value for r in L.prefix_lines(spark, str(d), n).collect()]
    want = [f"s{i};{i % 100}.5" for i in range(2000)][:n]
    assert sorted(got) == sorted(want)


def test_prefix_at_every_split_edge(spark, tmp_path, small_splits):
    d = _folder(tmp_path, files=1, lines=300)
    sizes = (spark.read.text(str(d)).groupBy(F.col("_metadata.file_block_start").alias("b")).count().orderBy("b").collect())
    edges, n = [], 0
    for r in sizes:
        n += r["count"]
        edges.append(n)
    assert len(edges) > 3
    for edge in edges:
        for n in (edge - 1, edge, edge + 1):
            assert L.prefix_lines(spark, str(d), n).count() == min(n, 300)


def test_prefix_opens_no_later_file(spark, tmp_path):
    """Files behind the prefix may even be gone by the time that the rows are read."""
    d = _folder(tmp_path)
    lines = L.prefix_lines(spark, str(d), 450)
    for f in sorted(d.iterdir())[2:]:
        f.write_text("no measurement line\n")
    assert T.parse_measure_lines(lines).count() == 450
    files = {unq for unq in lines.inputFiles()}
    assert len(files) == 2


def test_prefix_raises_when_splits_change(spark, tmp_path):
    d = _folder(tmp_path, files=1, lines=2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = L.prefix_lines(spark, str(d), 1500)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        lines = lines.select("value")
        try:
            got = lines.count()
        except Exception as e:  # noqa: BLE001
            assert "splits" in str(e)
        else:
            assert got == 1500
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_prefix_refuses_negative_numbers(spark, tmp_path):
    with pytest.raises(ValueError):
        L.prefix_lines(spark, str(_folder(tmp_path)), -1)


# ------------------------------------------------------------------ stored lines
def test_stored_lines_are_reused(spark, tmp_path, small_splits, monkeypatch):
    d, store = _folder(tmp_path), str(tmp_path / "store")
    first = L.open_lines(spark, str(d), store)
    assert first.total == 2000 and first.blocks > 10
    monkeypatch.setattr(L, "_tag", lambda scan: pytest.fail("stored again"))
    again = L.open_lines(spark, str(d), store)
    assert again.folder == first.folder
    assert sorted((r.line_idx, r.value) for r in again.rows().collect()) == [(i, f"s{i};{i % 100}.5") for i in range(2000)]


@pytest.mark.parametrize("change", ["append", "add", "remove", "touch"])
def test_changed_files_raise_or_are_stored_anew(spark, tmp_path, change):
    d, store = _folder(tmp_path, files=2, lines=50), str(tmp_path / "store")
    first = L.open_lines(spark, str(d), store)
    one = sorted(d.iterdir())[0]
    if change == "append":
        one.write_text(one.read_text() + "x;1.0\n")
    elif change == "add":
        (d / "part-9.txt").write_text("x;1.0\n")
    elif change == "remove":
        one.unlink()
    else:
        os.utime(one, (1, 1))
    with pytest.raises(L.ChangedInput):
        L.open_lines(spark, str(d), store)
    assert first.rows().count() == 100  # the earlier rows stay readable
    anew = L.open_lines(spark, str(d), store, rebuild=True)
    assert anew.total == spark.read.text(str(d)).count()
    assert len(versions.remove_unused(spark, store)) == 1 and anew.rows().count() == anew.total
    anew.remove()
    assert not os.path.exists(store)


def test_a_failed_build_leaves_no_store(spark, tmp_path, monkeypatch):
    d, store = _folder(tmp_path, files=1, lines=20), str(tmp_path / "store")
    monkeypatch.setattr(L, "block_offsets", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        L.open_lines(spark, str(d), store)
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        versions.current(spark, store)
    assert L.open_lines(spark, str(d), store).total == 20


@pytest.mark.parametrize("n", [0, 1, 400, 777, 2000, 9999, None])
def test_first_of_stored_lines(spark, tmp_path, small_splits, n):
    stored = L.open_lines(spark, str(_folder(tmp_path)), str(tmp_path / "store"))
    assert sorted(r.line_idx for r in stored.first(n).collect()) == list(range(2000))[:n]


def test_first_pushes_its_blocks_to_the_scan(spark, tmp_path, small_splits):
    stored = L.open_lines(spark, str(_folder(tmp_path)), str(tmp_path / "store"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        plan = stored.first(500)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [" in plan and "LessThan(_fp" in plan and "GreaterThan(_fp" in plan


# ------------------------------------------------------------------ inferred types
@pytest.mark.parametrize("values,exact,want", [
    (["1", "-2", "+3"], False, "bigint"), (["1", "2.5"], False, "double"), (["1", "2.5", "-33.25"], True, "decimal(4,2)"),
    (["1", "1e3"], True, "double"), (["1", "x"], False, "string"), (["", None, " "], False, "string"),
    (["9" * 25], False, "double"), (["9" * 25], True, "decimal(25,0)"), ([" 7 ", ""], False, "bigint"),
    (["007.50", "0.1"], True, "decimal(3,2)"), (["0", "0.0"], True, "decimal(1,1)")])
def test_types_of_fields(spark, values, exact, want):
    lines = spark.createDataFrame([(f"A;{v or ''}",) for v in values], "value string")
    assert I.infer_types(lines, exact) == {"station": "string", "measure": want}


def test_states_merge_in_any_order(spark):
    draw = random.Random(1)
    values = [draw.choice(["1", "12.5", "1e2", "", "-7"]) for _ in range(200)]
    rows = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "part int, v string")
    states = rows.select("part", I.field_state(F.col("v")).alias("s"))
    merged = states.groupBy("part").agg(I.merge_state("s").alias("s")).agg(I.merge_state("s").alias("s")).first()["s"]
    assert merged == states.agg(I.merge_state("s").alias("s")).first()["s"]


def test_parse_inferred(spark):
    lines = spark.createDataFrame([("A;1",), ("B;2.25",), ("",), (";3",)], "value string")
    rows = I.parse_inferred(lines, I.infer_types(lines, exact=True))
    assert sorted((r.station or "", str(r.measure)) for r in rows.collect()) == [("", "3.00"), ("A", "1.00"), ("B", "2.25")]
    numbers = spark.createDataFrame([("7;1",), ("8;2",)], "value string")
    assert I.parse_inferred(numbers, I.infer_types(numbers)).dtypes == [("station", "bigint"), ("measure", "bigint")]
    with pytest.raises(ValueError):
        words = spark.createDataFrame([("A;x",)], "value string")
        I.parse_inferred(words, I.infer_types(words))
    nothing = spark.createDataFrame([], "value string")
    assert I.parse_inferred(nothing, I.infer_types(nothing)).count() == 0


def test_cli_inferred_with_positions(spark, tmp_path, tmp_text):
    from tallyho.cli import main

    path, store = tmp_text(["A;1", "A;2", "A;6.5", "B;5", "C;9"]), str(tmp_path / "store")
    out = str(tmp_path / "means")
    assert main(["summary", path, out, "--type", "inferred", "--chunk-means", "2", "--first-lines", "4", "--line-store", store], spark) == 0
    assert {r.station: r["mean"] for r in spark.read.parquet(out).collect()} == {"A": 4.0, "B": 5.0}
    out = str(tmp_path / "first")
    assert main(["summary", path, out, "--type", "inferred", "--first-lines", "2", "--line-store", store], spark) == 0
    assert {r.station: r.mean_temperature for r in spark.read.parquet(out).collect()} == {"A": 1.5}
    out = str(tmp_path / "prefix")
    assert main(["summary", path, out, "--type", "inferred", "--first-lines", "3"], spark) == 0
    assert spark.read.parquet(out).count() == 1
