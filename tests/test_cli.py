"""Command line jobs, run in-process against the test session."""

import itertools
import json
from decimal import Decimal as D

import pytest

from tallyho.cli import main
from tests.test_summary import README_LINES


def test_cli_summary_formats(spark, tmp_text, tmp_path, capsys):
    src = tmp_text(README_LINES)
    out = str(tmp_path / "summary.parquet")
    assert main(["summary", src, out], spark) == 0
    rows = spark.read.parquet(out).collect()
    assert [r.station for r in rows][0] == "Bridgetown"
    ist = [r for r in rows if r.station == "Istanbul"][0]
    assert ist.mean_temperature == D("14.6")
    txt = str(tmp_path / "summary.txt")
    main(["summary", src, txt, "--format", "text"], spark)
    assert "Istanbul: 6.2/14.6/23.0" in [r.value for r in spark.read.text(txt).collect()]
    dl = str(tmp_path / "summary.delim")
    main(["summary", src, dl, "--format", "delimited"], spark)
    assert "Istanbul;23.0;6.2;14.6" in [r.value for r in spark.read.text(dl).collect()]


def test_cli_generate_and_estimate(spark, tmp_text, tmp_path, capsys):
    stations = tmp_text(["# comment", "Abha;x", "Oslo;y", "Abha;z"], name="stations.csv")
    out = str(tmp_path / "gen")
    assert main(["generate", stations, "12_345", out, "--seed", "3"], spark) == 0
    lines = spark.read.text(out)
    assert lines.count() == 12_345
    main(["estimate", stations, "1_000"], spark)
    r = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert r["max_len"] == 4 and r["size_text"] == "9.3 KiB"
    assert main(["generate", stations, "0", out], spark) == 2


def test_cli_first_lines_delimited(spark, tmp_text, tmp_path):
    src = tmp_text(["A;1.0", "B;2.0", "A;3.0", "C;9.9"])
    out = str(tmp_path / "head")
    assert main(["summary", src, out, "--format", "delimited", "--first-lines", "3"], spark) == 0
    assert [r.value for r in spark.read.text(out).collect()] == ["A;3.0;1.0;2", "B;2.0;2.0;2"]


def test_cli_text_keeps_null_station_line(spark, tmp_text, tmp_path):
    src = tmp_text([";5.0", "A;1.0"])
    out = str(tmp_path / "nulls.txt")
    main(["summary", src, out, "--format", "text"], spark)
    assert [r.value for r in spark.read.text(out).collect()] == ["A: 1.0/1.0/1.0", ": 5.0/5.0/5.0"]


def test_cli_etl_and_incremental(spark, tmp_path, capsys):
    from tallyho.session import fresh_dir

    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("\n".join(README_LINES) + "\n")
    work = fresh_dir(spark, "cli-etl")
    assert main(["etl", str(d), work], spark) == 0
    final = capsys.readouterr().out.strip().splitlines()[-1]
    ist = [r for r in spark.read.parquet(final).collect() if r.station == "Istanbul"][0]
    assert ist.mean_temperature == D("14.6")
    out, ck = str(tmp_path / "inc"), fresh_dir(spark, "cli-ck")
    assert main(["incremental", str(d), out, ck, "--state-partitions", "2"], spark) == 0
    assert spark.read.parquet(capsys.readouterr().out.strip().splitlines()[-1]).count() == 9
    assert main(["chain", str(d), str(tmp_path / "chain.txt"), "--format", "text"], spark) == 0
    assert "Istanbul: 6.2/14.6/23.0" in [r.value for r in spark.read.text(str(tmp_path / "chain.txt")).collect()]
    assert main(["fanout", str(d), fresh_dir(spark, "cli-fan"), str(tmp_path / "fan"), "--chunk-rows", "3"], spark) == 0
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "fan")).collect())) == \
        sorted(map(tuple, spark.read.parquet(final).collect()))


OPTIONS = {"double": ["--double"], "float": ["--type", "float"], "inferred": ["--type", "inferred"],
           "drop": ["--drop-null-keys"], "first": ["--first-lines", "3"], "chunks": ["--chunk-means", "2"],
           "text": ["--format", "text"], "delimited": ["--format", "delimited"], "csv": ["--parser", "csv"],
           "one": ["--single-file"]}
REJECTED = [{"double", "float"}, {"double", "inferred"}, {"double", "text"}, {"double", "delimited"}, {"float", "text"},
            {"float", "delimited"}, {"inferred", "text"}, {"inferred", "delimited"}, {"chunks", "text"},
            {"chunks", "delimited"}, {"inferred", "csv"}]
SAME = [{"float", "inferred"}, {"text", "delimited"}]  # one option given twice


@pytest.mark.parametrize("pair", [p for p in itertools.combinations(OPTIONS, 2) if set(p) not in SAME])
def test_cli_pairs_of_options(spark, tmp_text, tmp_path, pair):
    """Every pair of options is honoured, or rejected with a message."""
    src = tmp_text(["A;1.0", ";7.0", "A;2.5", "B;9.9", "A;4.5"])
    out = str(tmp_path / "out")
    code = main(["summary", src, out, *OPTIONS[pair[0]], *OPTIONS[pair[1]]], spark)
    if set(pair) in REJECTED:
        assert code == 2
        return
    assert code == 0
    rows = [("A", 1.0), (None, 7.0), ("A", 2.5), ("B", 9.9), ("A", 4.5)]
    rows = list(enumerate(rows))[:3 if "first" in pair else 5]
    rows = [(i, s, v) for i, (s, v) in rows if s is not None or "drop" not in pair]
    stations = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s))
    want = {}
    for s in stations:
        values = [v for _, t, v in rows if t == s]
        mean = sum(values) / len(values)
        if "chunks" in pair:
            chunks = [[v for i, t, v in rows if t == s and i // 2 == k] for k in range(3)]
            mean = sum(sum(c) / len(c) for c in chunks if c) / sum(1 for c in chunks if c)
        elif not {"double", "float", "inferred"} & set(pair):
            mean = float((D(str(sum(values))) / len(values)).quantize(D("0.1"), "ROUND_HALF_UP"))
        want[s] = (min(values), mean, max(values))
    if "text" in pair:
        lines = [r.value for r in spark.read.text(out).collect()]
        assert lines == [f"{s or ''}: {a}/{m}/{b}" for s, (a, m, b) in want.items()]
    elif "delimited" in pair:
        lines = [r.value.split(";") for r in spark.read.text(out).collect()]
        assert [(x[0], float(x[1]), float(x[2])) for x in lines] == [(s or "", b, a) for s, (a, _, b) in want.items()]
    else:
        stored = spark.read.parquet(out)
        assert "one" not in pair or len(stored.inputFiles()) == 1
        names = ["min", "mean", "max"] if "chunks" in pair else ["min_temperature", "mean_temperature", "max_temperature"]
        got = {r.station: tuple(float(r[n]) for n in names) for r in stored.collect()}
        assert got == {s: pytest.approx(v, rel=1e-6) for s, v in want.items()}


def test_cli_chunk_means_and_profile(spark, tmp_text, tmp_path, capsys):
    src = tmp_text(["A;1.0", "A;2.0", "A;6.0", "B;5.0"])
    out = str(tmp_path / "mom")
    assert main(["summary", src, out, "--chunk-means", "2"], spark) == 0
    got = {r.station: r.mean for r in spark.read.parquet(out).collect()}
    assert got == {"A": 3.75, "B": 5.0}
    capsys.readouterr()
    assert main(["profile", src], spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    kinds = {(x.get("stage"), x.get("column"), x.get("type")) for x in lines if "type" in x}
    assert ("before", "measure", "double") in kinds and ("after", "measure", "float") in kinds
    total = [x for x in lines if x.get("column") == "total" and "bytes_before" in x][0]
    assert total["bytes_before"] == 4 + 32 and 0 < total["reduction"] < 1


def test_cli_show(spark, tmp_text, tmp_path, capsys):
    src = tmp_text(README_LINES)
    out = str(tmp_path / "s.parquet")
    main(["summary", src, out], spark)
    capsys.readouterr()
    assert main(["show", out, "--rows", "3"], spark) == 0
    printed = capsys.readouterr().out
    assert "Bridgetown" in printed and "only showing top 3 rows" in printed
