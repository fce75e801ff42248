"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their SQL oracles.

Every query reads the driver tables in full, or files Spark writes from them
(text, parquet) into a fresh folder under the session's checkpoint directory.
Oracle SQL runs in DuckDB over the same parquet tables; column names and types
are aligned on both sides.  Double-valued means are rounded to 6 places on both
sides (summation order differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.operators import chunks as C
from tallyho.operators import encoding as E
from tallyho.operators import generate as G
from tallyho.operators import summary as S
from tallyho.plans import etl
from tallyho.schema import CHUNK_ID, LINE_INDEX, MEAN_COL, MEASURE, ROW_ID, STATION
from tallyho.session import fresh_dir, table_path
from tallyho.sinks.files import write_lines, write_measurement_text, write_parquet
from tallyho.sources import infer as I
from tallyho.sources import lines as L
from tallyho.sources import text as T
from tallyho.sources.measurements import (M_SQL, ML_SQL, events_measurements,
                                          lineitem_measurements)
from tallyho.sources.parquet import lookup, read_parquet, serve_summary, summary_sql_view, write_zones
from tallyho.streaming.incremental import incremental_summary, live_summary

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

CHUNKS = 4                         # chunks that the native chunked queries aim for, at any size
UDF_CHUNK_BYTES = 64 << 10         # of a chunk handed to one pandas frame; chunks grow in number with the table
STREAM_FILE_BYTES = 64 << 20       # input files of the incremental run
STREAM_BATCH_FILES = 16            # of them per micro-batch, where there are more than four
LINE_BYTES = 24                    # about, of a measurement line
SEED = 42


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_m(body: str) -> str:
    return f"WITH M AS ({M_SQL}) {body}"


def with_mo(body: str) -> str:
    """M plus its line order (0-based position by rid)."""
    return (f"WITH M AS ({M_SQL}), MO AS (SELECT *, row_number() OVER (ORDER BY rid) - 1 AS pos "
            f"FROM M) {body}")


# The output columns and the mean's rounding are the flagship's contract.
SUMMARY_SQL = (
    "SELECT station, MIN(measure) AS min_temperature, "
    "CAST(AVG(measure) AS DECIMAL(3,1)) AS mean_temperature, "
    "MAX(measure) AS max_temperature FROM {src} GROUP BY station ORDER BY station NULLS LAST"
)
M_SUMMARY = with_m(SUMMARY_SQL.format(src="M"))


def _m(spark, sf_dir):
    return events_measurements(spark, sf_dir)


def _m_text(spark, sf_dir, label, ordered=False, files=None) -> str:
    """Write M as ``station;measure`` text (in rid order when ``ordered``)."""
    path = fresh_dir(spark, label)
    write_measurement_text(_m(spark, sf_dir), path, order_by=ROW_ID if ordered else None,
                           files=files)
    return path


def _chunk_rows(rows: int) -> int:
    """Rows per chunk for about ``CHUNKS`` chunks."""
    return rows // CHUNKS + 1


CHUNK_ROWS_SQL = f"((SELECT count(*) FROM M) // {CHUNKS} + 1)"


def _round_mean(df: DataFrame, col: str = MEAN_COL) -> DataFrame:
    return df.withColumn(col, F.round(col, 6))


# ------------------------------------------------------------------ A1 family
@register("summary_decimal", M_SUMMARY)
def q_summary_decimal(spark, sf_dir):
    return S.summary_decimal(_m(spark, sf_dir))


@register("summary_lineitem", f"WITH ML AS ({ML_SQL}) " + SUMMARY_SQL.format(src="ML"))
def q_summary_lineitem(spark, sf_dir):
    return S.summary_decimal(lineitem_measurements(spark, sf_dir))


@register("summary_double", with_m(
    "SELECT station, CAST(MIN(measure) AS DOUBLE) AS min_temperature, "
    "round(AVG(CAST(measure AS DOUBLE)), 6) AS mean_temperature, "
    "CAST(MAX(measure) AS DOUBLE) AS max_temperature FROM M GROUP BY station"))
def q_summary_double(spark, sf_dir):
    return _round_mean(S.summary_double(_m(spark, sf_dir)))


@register("summary_float", with_m(
    "SELECT station, MIN(CAST(measure AS FLOAT)) AS min_temperature, "
    "round(AVG(CAST(measure AS FLOAT)), 6) AS mean_temperature, "
    "MAX(CAST(measure AS FLOAT)) AS max_temperature FROM M GROUP BY station"))
def q_summary_float(spark, sf_dir):
    return _round_mean(S.summary_float(_m(spark, sf_dir)))


@register("sum_count_mean", with_m(
    "SELECT station, CAST(SUM(measure) AS DECIMAL(18,1)) AS sum_measure, "
    "COUNT(measure) AS n_measure, "
    "round(CAST(SUM(CAST(measure * 10 AS BIGINT)) AS DOUBLE) / COUNT(measure) / 10.0, 9) AS mean_measure "
    "FROM M GROUP BY station"))
def q_sum_count_mean(spark, sf_dir):
    return S.sum_count_mean(_m(spark, sf_dir)).withColumn("mean_measure", F.round("mean_measure", 9))


@register("summary_arrays", M_SUMMARY)
def q_summary_arrays(spark, sf_dir):
    return S.summary_arrays(_m(spark, sf_dir))


@register("row_count", with_m("SELECT count(*) AS n_rows, count(measure) AS n_measures FROM M"))
def q_row_count(spark, sf_dir):
    return S.row_count(_m(spark, sf_dir))


@register("station_count", with_m(
    "SELECT count(*) AS n_stations FROM (SELECT station FROM M GROUP BY station) g"))
def q_station_count(spark, sf_dir):
    return S.station_count(_m(spark, sf_dir))


@register("summary_head", M_SUMMARY + " LIMIT 5")
def q_summary_head(spark, sf_dir):
    return S.summary_head(S.summary_decimal(_m(spark, sf_dir)), 5)


@register("summary_formatted", with_m(
    "SELECT station, CAST(MIN(measure) AS VARCHAR) || '/' || "
    "CAST(CAST(AVG(measure) AS DECIMAL(3,1)) AS VARCHAR) || '/' || "
    "CAST(MAX(measure) AS VARCHAR) AS stats FROM M GROUP BY station"))
def q_summary_formatted(spark, sf_dir):
    return S.summary_formatted(S.summary_decimal(_m(spark, sf_dir)))


# Null stations: signups carry no station in this variant.
_NULLABLE_M = ("SELECT rid, CASE WHEN station LIKE 'signup-%' THEN NULL ELSE station END AS station, "
               "measure FROM M")


def _nullable_m(spark, sf_dir):
    m = _m(spark, sf_dir)
    return m.withColumn(STATION, F.when(~F.col(STATION).startswith("signup-"), F.col(STATION)))


def with_mn(body: str) -> str:
    return f"WITH M AS ({M_SQL}), MN AS ({_NULLABLE_M}) {body}"


@register("summary_null_keys", with_mn(SUMMARY_SQL.format(src="MN")))
def q_summary_null_keys(spark, sf_dir):
    return S.summary_decimal(_nullable_m(spark, sf_dir))


@register("summary_drop_null_keys", with_mn(
    SUMMARY_SQL.format(src="(SELECT * FROM MN WHERE station IS NOT NULL) d")))
def q_summary_drop_null_keys(spark, sf_dir):
    return S.summary_decimal(_nullable_m(spark, sf_dir), drop_nulls=True)


@register("summary_sql_view", M_SUMMARY)
def q_summary_sql_view(spark, sf_dir):
    return summary_sql_view(spark, _m(spark, sf_dir))


# ------------------------------------------------------------------ text scans
@register("scan_text_decimal", with_m("SELECT station, measure FROM M"))
def q_scan_text_decimal(spark, sf_dir):
    return T.scan_text_decimal(spark, _m_text(spark, sf_dir, "text-dec"))


@register("scan_text_double", with_m("SELECT station, CAST(measure AS DOUBLE) AS measure FROM M"))
def q_scan_text_double(spark, sf_dir):
    return T.scan_text_double(spark, _m_text(spark, sf_dir, "text-dbl"))


@register("scan_text_inferred", with_m("SELECT station, CAST(measure AS DOUBLE) AS measure FROM M"))
def q_scan_text_inferred(spark, sf_dir):
    return T.scan_text_inferred(spark, _m_text(spark, sf_dir, "text-inf"))


@register("scan_lines_split", with_m("SELECT station, CAST(measure AS DOUBLE) AS measure FROM M"))
def q_scan_lines_split(spark, sf_dir):
    return T.scan_lines_split(spark, _m_text(spark, sf_dir, "text-split"))


@register("summary_from_text", M_SUMMARY)
def q_summary_from_text(spark, sf_dir):
    """The reference's flagship as written: strict decimal text scan + summary."""
    return S.summary_decimal(T.scan_text_decimal(spark, _m_text(spark, sf_dir, "text-sum")))


@register("summary_from_text_csv", M_SUMMARY)
def q_summary_from_text_csv(spark, sf_dir):
    """Same, with Spark's CSV reader as the parser (``parser="csv"``)."""
    path = _m_text(spark, sf_dir, "text-sum-csv")
    return S.summary_decimal(T.scan_text_decimal(spark, path, parser="csv"))


@register("summary_double_from_text", with_m(
    "SELECT station, CAST(MIN(measure) AS DOUBLE) AS min_temperature, "
    "round(AVG(CAST(measure AS DOUBLE)), 6) AS mean_temperature, "
    "CAST(MAX(measure) AS DOUBLE) AS max_temperature FROM M GROUP BY station"))
def q_summary_double_from_text(spark, sf_dir):
    return _round_mean(S.summary_double(T.scan_text_double(spark, _m_text(spark, sf_dir, "text-sd"))))


# ------------------------------------------------------------------ ordered text
@register("line_index", with_mo(f"SELECT pos AS {LINE_INDEX}, station, measure FROM MO"))
def q_line_index(spark, sf_dir):
    path = _m_text(spark, sf_dir, "text-idx", ordered=True)
    return L.with_line_index(T.scan_text_decimal(spark, path))


@register("scan_chunks", with_mo(
    f"SELECT pos // {CHUNK_ROWS_SQL} AS chunk_id, station, measure FROM MO"))
def q_scan_chunks(spark, sf_dir):
    path = _m_text(spark, sf_dir, "text-chunks", ordered=True)
    indexed, total = L.line_index_with_total(T.scan_text_decimal(spark, path))
    return L.with_chunk_id(indexed, _chunk_rows(total)).select(CHUNK_ID, STATION, MEASURE)


@register("prefix_summary", with_mo(SUMMARY_SQL.format(
    src="(SELECT * FROM MO WHERE pos < (SELECT count(*) // 2 FROM MO)) p")))
def q_prefix_summary(spark, sf_dir):
    """First half of the file's lines (``head -n N`` with N = lines // 2): files behind them stay closed."""
    path = _m_text(spark, sf_dir, "text-prefix", ordered=True)
    lines = L.prefix_lines(spark, path, _m(spark, sf_dir).count() // 2)
    return S.summary_decimal(T.parse_measure_lines(lines))


@register("line_index_stored", with_mo(f"SELECT pos AS {LINE_INDEX}, station, measure FROM MO"))
def q_line_index_stored(spark, sf_dir):
    """The second opening of a store: nothing is indexed again."""
    path, store = _m_text(spark, sf_dir, "text-store", ordered=True), fresh_dir(spark, "line-store")
    L.open_lines(spark, path, store)
    rows = L.open_lines(spark, path, store).rows()
    return T.parse_measure_lines(rows, "decimal(3,1)", LINE_INDEX).select(LINE_INDEX, STATION, MEASURE)


@register("inferred_chunk_means", with_mo(
    "SELECT station, CAST(MIN(mn) AS DOUBLE) AS min, CAST(MAX(mx) AS DOUBLE) AS max, round(AVG(me), 6) AS mean FROM ("
    f"SELECT pos // {CHUNK_ROWS_SQL} AS c, station, MIN(measure) AS mn, MAX(measure) AS mx, "
    "AVG(CAST(measure AS DOUBLE)) AS me FROM MO GROUP BY 1, 2) p GROUP BY station"))
def q_inferred_chunk_means(spark, sf_dir):
    """Chunks of lines whose types are inferred: positions and types from the same stored lines."""
    path = _m_text(spark, sf_dir, "text-infer", ordered=True)
    stored = L.open_lines(spark, path, fresh_dir(spark, "line-store"))
    rows = I.parse_inferred(stored.rows(), I.infer_types(stored.rows()), LINE_INDEX)
    return _round_mean(C.mean_of_chunk_means(L.with_chunk_id(rows, _chunk_rows(stored.total))), "mean")


@register("inferred_prefix_summary", with_mo(
    "SELECT station, CAST(MIN(measure) AS DOUBLE) AS min_temperature, round(AVG(CAST(measure AS DOUBLE)), 6) AS mean_temperature, "
    "CAST(MAX(measure) AS DOUBLE) AS max_temperature FROM MO WHERE pos < (SELECT count(*) // 3 FROM MO) GROUP BY station"))
def q_inferred_prefix_summary(spark, sf_dir):
    """First third of the stored lines, their types inferred from all of them."""
    path = _m_text(spark, sf_dir, "text-infer", ordered=True)
    stored = L.open_lines(spark, path, fresh_dir(spark, "line-store"))
    rows = I.parse_inferred(stored.first(stored.total // 3), I.infer_types(stored.rows()))
    return _round_mean(S.summary_double(rows))


# ------------------------------------------------------------------ chunk algebra
def _chunked_m(spark, sf_dir):
    m = _m(spark, sf_dir)
    return m.withColumn(CHUNK_ID, F.call_function("div", F.col(ROW_ID), F.lit(_chunk_rows(m.count()))))


PARTIALS_SQL = with_m(
    f"SELECT rid // {CHUNK_ROWS_SQL} AS chunk_id, station, MIN(measure) AS min, MAX(measure) AS max, "
    "CAST(SUM(measure) AS DECIMAL(18,1)) AS sum, COUNT(measure) AS count "
    "FROM M GROUP BY 1, 2")


@register("chunk_partials", PARTIALS_SQL)
def q_chunk_partials(spark, sf_dir):
    return C.chunk_partials(_chunked_m(spark, sf_dir))


@register("summary_merge", M_SUMMARY)
def q_summary_merge(spark, sf_dir):
    return C.merge_partials(C.chunk_partials(_chunked_m(spark, sf_dir)))


@register("mean_of_chunk_means", with_m(
    "SELECT station, CAST(MIN(mn) AS DOUBLE) AS min, CAST(MAX(mx) AS DOUBLE) AS max, "
    "round(AVG(me), 6) AS mean FROM ("
    f"SELECT rid // {CHUNK_ROWS_SQL} AS c, station, MIN(measure) AS mn, MAX(measure) AS mx, "
    "AVG(CAST(measure AS DOUBLE)) AS me FROM M GROUP BY 1, 2) p GROUP BY station"))
def q_mean_of_chunk_means(spark, sf_dir):
    return _round_mean(C.mean_of_chunk_means(_chunked_m(spark, sf_dir)), "mean")


@register("union_partials", f"WITH M AS ({M_SQL}), ML AS ({ML_SQL}) " + SUMMARY_SQL.format(
    src="(SELECT station, measure FROM M UNION ALL SELECT station, measure FROM ML) u"))
def q_union_partials(spark, sf_dir):
    """Partials of two sources (events, lineitem) unioned by name, then merged."""
    ev = C.chunk_partials(_m(spark, sf_dir).withColumn(CHUNK_ID, F.lit(0).cast("bigint")))
    li = C.chunk_partials(lineitem_measurements(spark, sf_dir).withColumn(CHUNK_ID, F.lit(1).cast("bigint")))
    return C.merge_partials(C.union_partials(ev, li))


@register("batch_partials_udf", M_SUMMARY)
def q_batch_partials_udf(spark, sf_dir):
    return C.batch_partials_udf(_m(spark, sf_dir))


@register("chunk_apply_udf", M_SUMMARY)
def q_chunk_apply_udf(spark, sf_dir):
    return C.chunk_apply_udf(C.with_byte_chunks(_m(spark, sf_dir), ROW_ID, UDF_CHUNK_BYTES))


# ------------------------------------------------------------------ sinks
@register("parquet_roundtrip", M_SUMMARY)
def q_parquet_roundtrip(spark, sf_dir):
    path = write_parquet(S.summary_decimal(_m(spark, sf_dir)), fresh_dir(spark, "summary-pq"))
    return read_parquet(spark, path)


@register("serve_summary", M_SUMMARY)
def q_serve_summary(spark, sf_dir):
    path = write_parquet(S.summary_decimal(_m(spark, sf_dir)), fresh_dir(spark, "summary-serve"))
    return serve_summary(spark, path)


@register("lookup_station", with_m(
    "SELECT * FROM (" + SUMMARY_SQL.format(src="M") + ") s WHERE station = (SELECT max(station) FROM M)"))
def q_lookup_station(spark, sf_dir):
    """The last station's row, from the one part file that holds it."""
    m = _m(spark, sf_dir)
    path = write_parquet(S.summary_decimal(m), fresh_dir(spark, "summary-zones"))
    write_zones(spark, path)
    return lookup(spark, path, m.agg(F.max(STATION)).first()[0])


@register("live_summary", M_SUMMARY)
def q_live_summary(spark, sf_dir):
    """The state between batches: a base and the deltas behind it, merged on read."""
    text, work = _m_text(spark, sf_dir, "stream-in", files=5), fresh_dir(spark, "stream")
    incremental_summary(spark, text, f"{work}/summary", f"{work}/checkpoint", compact_every=3)
    return live_summary(spark, f"{work}/summary")


@register("sink_text_lines", with_m(
    "SELECT station || ': ' || CAST(MIN(measure) AS VARCHAR) || '/' || "
    "CAST(CAST(AVG(measure) AS DECIMAL(3,1)) AS VARCHAR) || '/' || "
    "CAST(MAX(measure) AS VARCHAR) AS value FROM M GROUP BY station"))
def q_sink_text_lines(spark, sf_dir):
    lines = S.text_lines(S.summary_decimal(_m(spark, sf_dir)))
    return spark.read.text(write_lines(lines, "value", fresh_dir(spark, "lines")))


def _duck_mean_text(s: str, n: str) -> str:
    """DuckDB text of s/(10n) at 6 significant digits, exact rational rounded half away
    from zero (HUGEINT arithmetic), trailing zeros dropped, exponent form below 1e-4."""
    a, den = f"CAST(abs({s}) AS HUGEINT)", f"(CAST({n} AS HUGEINT) * 10)"
    branches = []
    for x in range(1, -18, -1):
        cond = f"{a} * {10 ** max(0, -x)} >= {den} * {10 ** max(0, x)}"
        m = f"(({a} * 2 * {10 ** (5 - x)} + {den}) // (2 * {den}))"
        branches.append((cond, m, x))

    def render(m: str, x: int) -> str:
        if x >= -4:
            d = 5 - x
            return (f"rtrim(rtrim(printf('%d.%0{d}d', CAST({m} // {10 ** d} AS BIGINT), "
                    f"CAST({m} % {10 ** d} AS BIGINT)), '0'), '.')")
        return (f"rtrim(rtrim(printf('%d.%05d', CAST({m} // 100000 AS BIGINT), "
                f"CAST({m} % 100000 AS BIGINT)), '0'), '.') || 'e-' || printf('%02d', {-x})")

    cases = " ".join(
        f"WHEN {c} THEN (CASE WHEN {m} >= 1000000 THEN {render('100000', x + 1)} ELSE {render(m, x)} END)"
        for c, m, x in branches)
    return (f"CASE WHEN {s} = 0 THEN '0' ELSE (CASE WHEN {s} < 0 THEN '-' ELSE '' END) || "
            f"(CASE {cases} END) END")


DELIMITED_SQL = (
    "SELECT coalesce(station, '') || ';' || coalesce(CAST(mx AS VARCHAR), '') || ';' || "
    "coalesce(CAST(mn AS VARCHAR), '') || ';' || coalesce(CASE WHEN n > 0 THEN "
    + _duck_mean_text("st", "n") + " END, '') AS value FROM (SELECT station, MAX(measure) AS mx, "
    "MIN(measure) AS mn, SUM(CAST(measure * 10 AS BIGINT)) AS st, COUNT(measure) AS n "
    "FROM {src} GROUP BY station) g")


@register("summary_delimited", with_m(DELIMITED_SQL.replace("{src}", "M")))
def q_summary_delimited(spark, sf_dir):
    lines = S.delimited_lines(_m(spark, sf_dir))
    return spark.read.text(write_lines(lines, "value", fresh_dir(spark, "delimited")))


# Stations without any measure: those of users whose id ends in 1.
_UNMEASURED_SQL = ("MU AS (SELECT station, CASE WHEN station NOT LIKE '%1' THEN measure END AS measure FROM M)")


def _unmeasured_m(spark, sf_dir):
    return _m(spark, sf_dir).withColumn(MEASURE, F.when(~F.col(STATION).endswith("1"), F.col(MEASURE)))


def with_mu(body: str) -> str:
    return f"WITH M AS ({M_SQL}), {_UNMEASURED_SQL} {body}"


_STATS_SQL = ("coalesce(CAST(MIN(measure) AS VARCHAR), '') || '/' || coalesce(CAST(CAST(AVG(measure) AS DECIMAL(3,1)) "
              "AS VARCHAR), '') || '/' || coalesce(CAST(MAX(measure) AS VARCHAR), '')")


@register("formatted_without_measures", with_mu(f"SELECT station, {_STATS_SQL} AS stats FROM MU GROUP BY station"))
def q_formatted_without_measures(spark, sf_dir):
    return S.summary_formatted(S.summary_decimal(_unmeasured_m(spark, sf_dir)))


@register("text_lines_without_measures", with_mu(
    f"SELECT station || ': ' || {_STATS_SQL} AS value FROM MU GROUP BY station"))
def q_text_lines_without_measures(spark, sf_dir):
    return S.text_lines(S.summary_decimal(_unmeasured_m(spark, sf_dir))).select("value")


@register("delimited_without_measures", with_mu(DELIMITED_SQL.replace("{src}", "MU")))
def q_delimited_without_measures(spark, sf_dir):
    return S.delimited_lines(_unmeasured_m(spark, sf_dir)).select("value")


# ------------------------------------------------------------------ staged jobs
@register("staged_etl", M_SUMMARY)
def q_staged_etl(spark, sf_dir):
    text = _m_text(spark, sf_dir, "etl-in")
    return read_parquet(spark, etl.staged_etl(spark, text, fresh_dir(spark, "etl")))


@register("chained_etl", M_SUMMARY)
def q_chained_etl(spark, sf_dir):
    text = _m_text(spark, sf_dir, "chain-in")
    return read_parquet(spark, etl.chained_etl(spark, text, fresh_dir(spark, "chain-out")))


DOUBLE_SQL = (
    "SELECT station, CAST(MIN(measure) AS DOUBLE) AS min_temperature, "
    "round(AVG(CAST(measure AS DOUBLE)), 6) AS mean_temperature, "
    "CAST(MAX(measure) AS DOUBLE) AS max_temperature FROM M GROUP BY station")


@register("staged_etl_double", with_m(DOUBLE_SQL))
def q_staged_etl_double(spark, sf_dir):
    """K6 on 64-bit floats, with the raw mean."""
    text = _m_text(spark, sf_dir, "etl-in")
    return _round_mean(read_parquet(spark, etl.staged_etl(spark, text, fresh_dir(spark, "etl"), "double")))


@register("chained_etl_text", with_m(f"SELECT station || ': ' || {_STATS_SQL} AS value FROM M GROUP BY station"))
def q_chained_etl_text(spark, sf_dir):
    """K7 ending in text lines."""
    text = _m_text(spark, sf_dir, "chain-in")
    return spark.read.text(etl.chained_etl(spark, text, fresh_dir(spark, "chain-out"), "text"))


@register("summary_inferred_from_text", with_m(DOUBLE_SQL))
def q_summary_inferred_from_text(spark, sf_dir):
    return _round_mean(S.summary_double(T.scan_text_inferred(spark, _m_text(spark, sf_dir, "text-inf"))))


@register("summary_float_from_text", with_m(
    "SELECT station, MIN(CAST(measure AS FLOAT)) AS min_temperature, "
    "round(AVG(CAST(measure AS FLOAT)), 6) AS mean_temperature, "
    "MAX(CAST(measure AS FLOAT)) AS max_temperature FROM M GROUP BY station"))
def q_summary_float_from_text(spark, sf_dir):
    return _round_mean(S.summary_float(T.scan_text_float(spark, _m_text(spark, sf_dir, "text-flt"))))


@register("partial_files_merge", M_SUMMARY)
def q_partial_files_merge(spark, sf_dir):
    text = _m_text(spark, sf_dir, "fan-in", ordered=True)
    rows = _chunk_rows(_m(spark, sf_dir).count())
    return etl.partial_files_merge(spark, text, fresh_dir(spark, "fan"), rows)


@register("resumed_fanout", M_SUMMARY)
def q_resumed_fanout(spark, sf_dir):
    """A fan-out that stops after its first wave, then a second run that does only the rest."""
    text = _m_text(spark, sf_dir, "fan-in", ordered=True)
    rows, work = _chunk_rows(_m(spark, sf_dir).count()), fresh_dir(spark, "fan")
    etl.fan_out(spark, text, rows, work, wave=1, waves=1)
    etl.fan_out(spark, text, rows, work, wave=2)
    return etl.merge_committed(spark, work)


@register("fanout_ledger", with_mo(
    f"SELECT pos // {CHUNK_ROWS_SQL} AS chunk_id, count(*) AS n_lines FROM MO GROUP BY 1"))
def q_fanout_ledger(spark, sf_dir):
    """What the ledger says after such a run: every chunk once, with its lines."""
    text = _m_text(spark, sf_dir, "fan-in", ordered=True)
    rows, work = _chunk_rows(_m(spark, sf_dir).count()), fresh_dir(spark, "fan")
    etl.fan_out(spark, text, rows, work, wave=1, waves=1)
    etl.fan_out(spark, text, rows, work, wave=2)
    return etl.ledger(spark, work).select(CHUNK_ID, "n_lines")


@register("staged_etl_inferred", with_m(DOUBLE_SQL))
def q_staged_etl_inferred(spark, sf_dir):
    """K6 over inferred types, run twice: the second version is what readers find."""
    text, work = _m_text(spark, sf_dir, "etl-in"), fresh_dir(spark, "etl")
    etl.staged_etl(spark, text, work, "inferred")
    return _round_mean(read_parquet(spark, etl.staged_etl(spark, text, work, "inferred")))


@register("incremental_summary", M_SUMMARY)
def q_incremental_summary(spark, sf_dir):
    m = _m(spark, sf_dir)
    files = max(4, m.count() * LINE_BYTES // STREAM_FILE_BYTES)
    text = _m_text(spark, sf_dir, "stream-in", files=files)
    work = fresh_dir(spark, "stream")
    out = incremental_summary(spark, text, f"{work}/summary", f"{work}/checkpoint",
                              files_per_trigger=STREAM_BATCH_FILES if files > 4 else 1)
    return read_parquet(spark, out)


# ------------------------------------------------------------------ generation
_PART_LINES_SQL = ("SELECT p_name || ';' || CAST(p_size AS VARCHAR) AS value FROM part "
                   "UNION ALL SELECT '# nation ' || n_name AS value FROM nation")


def _station_list_text(spark, sf_dir) -> str:
    """Station list stand-in: ``p_name;p_size`` lines plus ``#`` comment lines."""
    part = spark.read.parquet(table_path(sf_dir, "part"))
    nation = spark.read.parquet(table_path(sf_dir, "nation"))
    lines = part.select(F.concat_ws(";", "p_name", F.col("p_size").cast("string")).alias("value")).unionByName(
        nation.select(F.concat(F.lit("# nation "), F.col("n_name")).alias("value")))
    return write_lines(lines, "value", fresh_dir(spark, "stations"))


@register("station_names", f"WITH L AS ({_PART_LINES_SQL}) "
          "SELECT DISTINCT split_part(value, ';', 1) AS station FROM L WHERE value NOT LIKE '%#%'")
def q_station_names(spark, sf_dir):
    return T.station_names(spark, _station_list_text(spark, sf_dir))


_NAMES_SQL = ("names AS (SELECT station, row_number() OVER (ORDER BY station) - 1 AS name_idx "
              "FROM (SELECT DISTINCT p_name AS station FROM part) d)")


def _draw_sql(part: int, label: str, rid: str) -> str:
    return f"('0x' || substr(md5('{SEED}|{label}|' || {rid}), {1 + 8 * part}, 8))::BIGINT"


@register("generate_measurements", (
    f"WITH {_NAMES_SQL}, k AS (SELECT count(*) AS k FROM names), "
    f"pool AS (SELECT s.range AS slot, names.station FROM range({G.POOL_SIZE}) s, k, names "
    f"WHERE names.name_idx = {_draw_sql(0, 'pool', 's.range')} % k.k) "
    f"SELECT r.range AS rid, pool.station, CAST(({_draw_sql(1, 'row', 'r.range')} % {2 * G.HOTTEST_TENTHS + 1} "
    f"- {G.HOTTEST_TENTHS}) / 10.0 AS DECIMAL(3,1)) AS measure "
    f"FROM range((SELECT count(*) FROM lineitem)) r JOIN pool "
    f"ON pool.slot = {_draw_sql(0, 'row', 'r.range')} % {G.POOL_SIZE}"))
def q_generate_measurements(spark, sf_dir):
    names = spark.read.parquet(table_path(sf_dir, "part")).select(F.col("p_name").alias(STATION))
    n = spark.read.parquet(table_path(sf_dir, "lineitem")).count()
    return G.generate_measurements(spark, names, n, seed=SEED)


_CYCLIC_SQL = (
    "WITH c AS (SELECT n_name AS city, row_number() OVER (ORDER BY n_name) - 1 AS idx FROM "
    "(SELECT DISTINCT n_name FROM nation) d), k AS (SELECT count(*) AS k FROM c), "
    f"r AS (SELECT range AS rid, CAST({_draw_sql(0, 'cyclic', 'range')} / {float(G.DRAW)}::DOUBLE "
    f"* {G.CYCLIC_HIGH - G.CYCLIC_LOW}::DOUBLE + {G.CYCLIC_LOW}::DOUBLE AS FLOAT) AS value "
    "FROM range((SELECT count(*) FROM lineitem))), "
    "g AS (SELECT rid, city, value FROM r, k JOIN c ON c.idx = r.rid % k.k) ")


def _cyclic(spark, sf_dir):
    cities = spark.read.parquet(table_path(sf_dir, "nation")).select(F.col("n_name").alias(STATION))
    n = spark.read.parquet(table_path(sf_dir, "lineitem")).count()
    return G.generate_cyclic(spark, cities, n, seed=SEED)


@register("generate_cyclic", _CYCLIC_SQL + "SELECT rid, city, value FROM g")
def q_generate_cyclic(spark, sf_dir):
    return _cyclic(spark, sf_dir)


@register("cyclic_summary", _CYCLIC_SQL + "SELECT city, MIN(value) AS min_value, MAX(value) AS max_value, "
          "round(AVG(value), 6) AS avg_value FROM g GROUP BY city")
def q_cyclic_summary(spark, sf_dir):
    """Generate cyclic city rows, then min / max / avg per city."""
    return G.city_summary(_cyclic(spark, sf_dir)).withColumn("avg_value", F.round("avg_value", 6))


_CHOICE_SPAN = int(G.CHOICE_HIGH - G.CHOICE_LOW) * 10_000


@register("generate_choice", (
    f"SELECT event_id, '{G.CHOICE_PREFIX}' || CAST({_draw_sql(0, 'choice', 'event_id')} % 20 AS VARCHAR) AS estacao, "
    f"CAST(({_draw_sql(1, 'choice', 'event_id')} * {2 * _CHOICE_SPAN} + {G.DRAW}) // {2 * G.DRAW} "
    f"+ {int(G.CHOICE_LOW) * 10_000} AS DOUBLE) / 10000.0 AS medida FROM events"))
def q_generate_choice(spark, sf_dir):
    """A label and a value for every event, by its id."""
    events = spark.read.parquet(table_path(sf_dir, "events")).select("event_id")
    return G.generate_choice(events, n_labels=20, seed=SEED)


@register("size_estimate", (
    "WITH names AS (SELECT DISTINCT p_name AS station FROM part), "
    "l AS (SELECT max(length(station)) AS max_len, min(length(station)) AS min_len FROM names), "
    "t AS (SELECT count(*) AS n FROM lineitem), "
    "r AS (SELECT max_len, min_len, (max_len + min_len * 2 + 7) / 2.0 AS record_bytes, "
    "CAST(n AS DOUBLE) * ((max_len + min_len * 2 + 7) / 2.0) AS total_bytes FROM l, t) "
    "SELECT max_len, min_len, CAST(record_bytes AS DOUBLE) AS record_bytes, total_bytes, "
    "CASE WHEN total_bytes < 1024.0 THEN printf('%3.1f', round_even(total_bytes, 1)) || ' bytes' "
    "WHEN total_bytes / 1024.0 < 1024.0 THEN printf('%3.1f', round_even(total_bytes / 1024.0, 1)) || ' KiB' "
    "WHEN total_bytes / 1048576.0 < 1024.0 THEN printf('%3.1f', round_even(total_bytes / 1048576.0, 1)) || ' MiB' "
    "WHEN total_bytes / 1073741824.0 < 1024.0 THEN printf('%3.1f', round_even(total_bytes / 1073741824.0, 1)) || ' GiB' "
    "END AS size_text FROM r"))
def q_size_estimate(spark, sf_dir):
    names = spark.read.parquet(table_path(sf_dir, "part")).select(F.col("p_name").alias(STATION)).distinct()
    n = spark.read.parquet(table_path(sf_dir, "lineitem")).count()
    return G.size_estimate(names, n)


# ------------------------------------------------------------------ encoding
@register("dictionary_encode", with_m(
    "SELECT CAST(dense_rank() OVER (ORDER BY station) - 1 AS INTEGER) AS station_code, rid, measure FROM M"))
def q_dictionary_encode(spark, sf_dir):
    encoded, _ = E.dictionary_encode(_m(spark, sf_dir), STATION)
    return encoded


@register("dictionary_roundtrip", with_m("SELECT station, rid, measure FROM M"))
def q_dictionary_roundtrip(spark, sf_dir):
    encoded, dictionary = E.dictionary_encode(_m(spark, sf_dir), STATION)
    return E.dictionary_decode(encoded, dictionary, STATION)


@register("footprint_profile", with_m(
    "SELECT * FROM (SELECT c AS \"column\", bb AS bytes_before, ba AS bytes_after, "
    "CASE WHEN bb > 0 THEN 1.0 - CAST(ba AS DOUBLE) / CAST(bb AS DOUBLE) END AS reduction FROM ("
    "SELECT 'station' AS c, s AS bb, d + w * n AS ba FROM g UNION ALL "
    "SELECT 'measure', 8 * n, 4 * n FROM g UNION ALL "
    "SELECT 'total', s + 8 * n, d + w * n + 4 * n FROM g) x) y").replace(
    " SELECT * FROM (",
    ", k AS (SELECT station, count(*) AS cnt FROM M GROUP BY station), "
    "g AS (SELECT CAST(sum(cnt) AS BIGINT) AS n, "
    "CAST(coalesce(sum(strlen(station) * cnt), 0) AS BIGINT) AS s, "
    "CAST(coalesce(sum(strlen(station)), 0) AS BIGINT) AS d, "
    "CASE WHEN count(station) < 127 THEN 1 WHEN count(station) < 32767 THEN 2 "
    "WHEN count(station) < 2147483647 THEN 4 ELSE 8 END AS w FROM k) SELECT * FROM (", 1))
def q_footprint_profile(spark, sf_dir):
    return E.footprint_profile(_m(spark, sf_dir))


@register("stored_footprint")
def q_stored_footprint(spark, sf_dir):
    return E.stored_footprint(_m(spark, sf_dir))


@register("downcast_measure", with_m("SELECT rid, station, CAST(measure AS FLOAT) AS measure FROM M"))
def q_downcast_measure(spark, sf_dir):
    return E.downcast_measure(_m(spark, sf_dir))
