"""Type inference as a mergeable aggregate over raw lines.

Each field's text falls in one class of a small lattice

    nothing < integer < decimal < double < text

and a column has the least type that holds all of its fields: the greatest class, and for decimals
the most digits before and behind the point.  Class and digits are maxima, so partial results of tasks,
chunks or files merge in any order, and the inferred types of a stored set of lines need one
aggregation over it, with no sampling and no second parse of the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.schema import MEASURE, STATION
from tallyho.sources.text import split_fields, strict_number

NOTHING, INTEGER, DECIMAL, DOUBLE, TEXT = range(5)
_MOST_DIGITS = 38


def _classes(text: Column) -> Column:
    number = F.trim(text)
    return (F.when(text.isNull() | (number == ""), F.lit(NOTHING))
            .when(number.rlike(r"^[+-]?[0-9]+$"), F.lit(INTEGER))
            .when(number.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+)$"), F.lit(DECIMAL))
            .when(number.try_cast("double").isNotNull(), F.lit(DOUBLE)).otherwise(F.lit(TEXT)))


def field_state(text: Column) -> Column:
    """``class``, ``whole`` and ``part`` digits of one field; ``merge_state`` is its maximum by component."""
    digits = F.regexp_replace(F.trim(text), "^[+-]?0*", "")
    kind = _classes(text)
    numeric = (kind == INTEGER) | (kind == DECIMAL)
    whole = F.when(numeric, F.length(F.substring_index(digits, ".", 1))).otherwise(0)
    part = F.when(kind == DECIMAL, F.length(F.substring_index(digits, ".", -1))).otherwise(0)
    return F.struct(kind.alias("class"), whole.alias("whole"), part.alias("part"))


def merge_state(state: str) -> Column:
    """The aggregate of field states or of merged ones."""
    return F.struct(*[F.coalesce(F.max(f"{state}.{c}"), F.lit(0)).alias(c) for c in ("class", "whole", "part")])


def type_name(state, exact: bool = False) -> str:
    """The type of a merged state: ``bigint``, ``decimal`` (if ``exact``, and it fits), ``double`` or ``string``."""
    kind, whole, part = state["class"], state["whole"], state["part"]
    if kind == TEXT or kind == NOTHING:
        return "string"
    if kind == INTEGER and whole <= 18:
        return "bigint"
    if kind in (INTEGER, DECIMAL) and exact and whole + part <= _MOST_DIGITS:
        return f"decimal({max(1, whole + part)},{part})"
    return "double"


def infer_types(lines: DataFrame, exact: bool = False) -> dict[str, str]:
    """Types of station and measure over all lines (``value``; empty ones are skipped)."""
    fields = split_fields(lines)
    states = fields.select(field_state(F.col(STATION)).alias("s"), field_state(F.col(MEASURE)).alias("m"))
    found = states.agg(merge_state("s").alias("s"), merge_state("m").alias("m")).first()
    return {STATION: type_name(found["s"], exact), MEASURE: type_name(found["m"], exact)}


def parse_inferred(lines: DataFrame, types: dict[str, str], *carry: str) -> DataFrame:
    """``station, measure`` in the given types, and carried columns; a measure that is text raises."""
    if types[MEASURE] == "string" and not lines.isEmpty():
        raise ValueError("the measures are text: no number type holds all of them")
    kind = "double" if types[MEASURE] == "string" else types[MEASURE]
    fields = split_fields(lines, *carry)
    station = F.col(STATION) if types[STATION] == "string" else F.trim(STATION).cast(types[STATION])
    return fields.select(station.alias(STATION), strict_number(F.col(MEASURE), kind).alias(MEASURE), *carry)
