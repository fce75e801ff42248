"""Command line jobs (``python -m tallyho ...`` or ``spark-submit -m``-style).

Each subcommand is one Spark application over the library's operators; the
session comes from ``SparkSession.builder.getOrCreate()`` so the cluster's own
settings (master, checkpoint folder, shuffle width) apply.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("tallyho").getOrCreate()


class UsageError(Exception):
    """Options that make no sense together."""


def _check_summary(a) -> None:
    kind = "double" if a.double else a.type
    if a.double and a.type not in ("decimal", "double"):
        raise UsageError("--double and --type disagree")
    if a.format != "parquet" and kind != "decimal":
        raise UsageError(f"--format {a.format} needs decimal measures")
    if a.format != "parquet" and a.chunk_means is not None:
        raise UsageError(f"--format {a.format} can't show --chunk-means")
    if a.parser is not None and kind == "inferred":
        raise UsageError("--parser is fixed for inferred types")
    if a.line_store is not None and a.parser == "csv":
        raise UsageError("--parser csv reads no stored lines")
    for name in ("first_lines", "chunk_means"):
        if getattr(a, name) is not None and getattr(a, name) <= 0:
            raise UsageError(f"--{name.replace('_', '-')} must be positive")


def cmd_summary(spark: SparkSession, a) -> None:
    from tallyho.operators import summary as S
    from tallyho.operators.chunks import mean_of_chunk_means
    from tallyho.schema import LINE_INDEX, MEASURE_DECIMAL
    from tallyho.session import fresh_dir
    from tallyho.sinks.files import write_lines, write_parquet
    from tallyho.sources import infer as I
    from tallyho.sources import lines as L
    from tallyho.sources import text as T

    kind = "double" if a.double else a.type
    lines = None
    if a.parser == "csv":
        pass
    elif a.line_store is not None or a.chunk_means is not None:
        # Positions: raw lines, stored once (for later commands too, if a folder is named).
        stored = L.open_lines(spark, a.input, a.line_store or fresh_dir(spark, "line-store"), rebuild=a.rebuild)
        lines, every = stored.first(a.first_lines), stored.rows()
    elif a.first_lines is not None:
        lines = every = L.prefix_lines(spark, a.input, a.first_lines)
    carry = [LINE_INDEX] if a.chunk_means is not None else []
    if kind == "inferred":
        rows = T.scan_text_inferred(spark, a.input) if lines is None else I.parse_inferred(lines, I.infer_types(every), *carry)
    elif lines is not None:
        rows = T.parse_measure_lines(lines, MEASURE_DECIMAL.simpleString() if kind == "decimal" else kind, *carry)
    else:
        scan = {"decimal": T.scan_text_decimal, "double": T.scan_text_double, "float": T.scan_text_float}[kind]
        rows = scan(spark, a.input, parser=a.parser or "lines")
        if a.parser == "csv" and (a.first_lines is not None or a.chunk_means is not None):
            rows = L.first_lines(L.with_line_index(rows), a.first_lines)
    if a.drop_null_keys:
        rows = S.drop_null_keys(rows)
    if a.chunk_means is not None:
        out = mean_of_chunk_means(L.with_chunk_id(rows, a.chunk_means))
    elif a.format == "delimited":
        out = S.delimited_lines(rows)
    else:
        summary = {"decimal": S.summary_decimal, "float": S.summary_float}.get(kind, S.summary_double)
        out = S.text_lines(summary(rows)) if a.format == "text" else summary(rows)
    if a.format == "parquet":
        write_parquet(out, a.output, single_file=a.single_file)
    else:
        write_lines(out, "value", a.output, single_file=a.single_file)


def cmd_chain(spark: SparkSession, a) -> None:
    from tallyho.plans.etl import chained_etl

    print(chained_etl(spark, a.input, a.output, a.format, a.single_file))


def cmd_fanout(spark: SparkSession, a) -> None:
    from tallyho.plans.etl import fan_out, merge_committed
    from tallyho.sinks.files import write_parquet

    fan_out(spark, a.input, a.chunk_rows, a.workdir)  # only the chunks that an earlier run didn't commit
    print(write_parquet(merge_committed(spark, a.workdir), a.output, single_file=a.single_file))


def cmd_generate(spark: SparkSession, a) -> None:
    from tallyho.operators.generate import generate_measurements
    from tallyho.sinks.files import write_measurement_text
    from tallyho.sources.text import station_names

    names = station_names(spark, a.stations)
    rows = generate_measurements(spark, names, a.rows, pool_size=a.pool_size, seed=a.seed)
    write_measurement_text(rows, a.output, files=a.files)


def cmd_estimate(spark: SparkSession, a) -> None:
    from tallyho.operators.generate import size_estimate
    from tallyho.sources.text import station_names

    r = size_estimate(station_names(spark, a.stations), a.rows).first()
    print(json.dumps(r.asDict()))


def cmd_profile(spark: SparkSession, a) -> None:
    from tallyho.operators.encoding import (describe_types, downcast_measure,
                                            footprint_profile, stored_footprint)
    from tallyho.sources.text import scan_text_double

    rows = scan_text_double(spark, a.input, parser="lines")
    for stage, df in (("before", rows), ("after", downcast_measure(rows))):
        for r in describe_types(spark, df).collect():
            print(json.dumps({"stage": stage, "column": r.column, "type": r.type}))
    print(json.dumps({"stage": "after", "column": "station", "type": "dictionary codes"}))
    for r in footprint_profile(rows).collect():
        print(json.dumps(r.asDict()))
    if a.stored:
        for r in stored_footprint(rows).collect():
            print(json.dumps({"stored": True, **r.asDict()}))


def cmd_show(spark: SparkSession, a) -> None:
    from tallyho.sources.parquet import ZONES, lookup, serve_summary, write_zones
    from tallyho.sinks.versions import names

    if a.station is None:
        serve_summary(spark, a.summary).show(a.rows, truncate=False)
        return
    if ZONES not in names(spark, a.summary):
        write_zones(spark, a.summary)
    lookup(spark, a.summary, a.station).show(a.rows, truncate=False)


def cmd_etl(spark: SparkSession, a) -> None:
    from tallyho.plans.etl import staged_etl

    print(staged_etl(spark, a.input, a.workdir, a.type, a.single_file))


def cmd_incremental(spark: SparkSession, a) -> None:
    from tallyho.streaming.incremental import incremental_summary

    print(incremental_summary(spark, a.input, a.output, a.checkpoint,
                              files_per_trigger=a.files_per_trigger,
                              state_partitions=a.state_partitions,
                              state_store="rocksdb" if a.rocksdb else None))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyho")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("summary", help="station;measure text -> sorted min/mean/max")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--format", choices=["parquet", "text", "delimited"], default="parquet")
    s.add_argument("--parser", choices=["lines", "csv"], default=None)
    s.add_argument("--type", choices=["decimal", "double", "float", "inferred"], default="decimal",
                   help="of the measures; all but decimal give the raw mean")
    s.add_argument("--double", action="store_true", help="the same as --type double")
    s.add_argument("--single-file", action="store_true", help="one sorted file instead of sorted part files")
    s.add_argument("--drop-null-keys", action="store_true")
    s.add_argument("--first-lines", type=lambda v: int(v.replace("_", "")), default=None,
                   help="only the first N lines of the input (in file order)")
    s.add_argument("--chunk-means", type=lambda v: int(v.replace("_", "")), default=None,
                   help="unweighted mean of per-chunk means over chunks of N lines")
    s.add_argument("--line-store", default=None, help="folder for the stored lines, made once and used again while the input stays")
    s.add_argument("--rebuild", action="store_true", help="store the lines anew if the input has changed (else that is an error)")
    s.set_defaults(fn=cmd_summary, check=_check_summary)

    g = sub.add_parser("generate", help="measurement text from a station list")
    g.add_argument("stations")
    g.add_argument("rows", type=lambda v: int(v.replace("_", "")))
    g.add_argument("output")
    g.add_argument("--seed", type=int, default=0)
    g.add_argument("--pool-size", type=int, default=10_000)
    g.add_argument("--files", type=int, default=None)
    g.set_defaults(fn=cmd_generate)

    e = sub.add_parser("estimate", help="estimated text size for N rows")
    e.add_argument("stations")
    e.add_argument("rows", type=lambda v: int(v.replace("_", "")))
    e.set_defaults(fn=cmd_estimate)

    f = sub.add_parser("profile", help="column types and logical footprint, before/after encoding")
    f.add_argument("input")
    f.add_argument("--stored", action="store_true", help="also the bytes of the columns as written files")
    f.set_defaults(fn=cmd_profile)

    w = sub.add_parser("show", help="print rows of a stored summary")
    w.add_argument("summary")
    w.add_argument("--rows", type=int, default=20)
    w.add_argument("--station", default=None, help="only this station's row; a zone map of the files is kept beside them")
    w.set_defaults(fn=cmd_show)

    t = sub.add_parser("etl", help="extract -> transform -> load with stored hand-over")
    t.add_argument("input")
    t.add_argument("workdir")
    t.add_argument("--type", choices=["decimal", "double", "inferred"], default="decimal")
    t.add_argument("--single-file", action="store_true")
    t.set_defaults(fn=cmd_etl)

    c = sub.add_parser("chain", help="extract -> transform -> load as one job")
    c.add_argument("input")
    c.add_argument("output")
    c.add_argument("--format", choices=["parquet", "text"], default="parquet")
    c.add_argument("--single-file", action="store_true")
    c.set_defaults(fn=cmd_chain)

    o = sub.add_parser("fanout", help="stored partials per chunk of lines, then their merge")
    o.add_argument("input")
    o.add_argument("workdir")
    o.add_argument("output")
    o.add_argument("--chunk-rows", type=lambda v: int(v.replace("_", "")), default=100_000_000)
    o.add_argument("--single-file", action="store_true")
    o.set_defaults(fn=cmd_fanout)

    i = sub.add_parser("incremental", help="incremental summary over a folder of text files")
    i.add_argument("input")
    i.add_argument("output")
    i.add_argument("checkpoint")
    i.add_argument("--files-per-trigger", type=int, default=1)
    i.add_argument("--state-partitions", type=int, default=None)
    i.add_argument("--rocksdb", action="store_true", help="keep the state in RocksDB")
    i.set_defaults(fn=cmd_incremental)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    if getattr(args, "rows", 1) is not None and getattr(args, "rows", 1) <= 0:
        print("rows must be a positive integer", file=sys.stderr)
        return 2
    try:
        getattr(args, "check", lambda a: None)(args)
    except UsageError as e:
        print(e, file=sys.stderr)
        return 2
    args.fn(spark or _session(), args)
    return 0
