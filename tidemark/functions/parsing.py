"""Scalar functions on raw cells and names, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cell texts that count as missing, compared in upper case.
MISSING = ["", "NA", "NAN", "N/A", "NULL", "NONE", "#N/A", "#NA", "NIL"]
NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"
#: Characters that a file name must not hold.
BAD_FILE_NAME = r"""[!@#$%^&*,.?":{}\\/|<>()\[\]+' ]"""
COLUMN_NAME = r"^[A-Za-z0-9_-]+$"


def stripped(token: Column) -> Column:
    """Without outer white space and quotes."""
    outer = F.regexp_replace(token, r"^\s+|\s+$", "")
    return F.regexp_replace(F.regexp_replace(outer, r'^"+|"+$', ""), r"^\s+|\s+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_number(token: Column, allow_comma_decimal: bool = False) -> tuple[Column, Column]:
    """(value, reason): the repaired number, or why there is none (``empty_or_na``, ``unrepairable``)."""

    def commas(s: Column) -> Column:
        comma, dot = F.contains(s, F.lit(",")), F.contains(s, F.lit("."))
        plain = F.replace(s, F.lit(","), F.lit(""))
        if not allow_comma_decimal:
            return F.when(comma, plain).otherwise(s)
        parts = F.split(s, ",")
        decimal = (F.size(parts) == 2) & (F.length(F.element_at(parts, -1)) != 3)
        return F.when(comma & ~dot & decimal, F.replace(s, F.lit(","), F.lit("."))).when(comma, plain).otherwise(s)

    def judged(fixed: Column) -> Column:
        return let(F.regexp_extract(fixed, f"({NUMBER})", 1), lambda found: outcome(fixed, found))

    def outcome(fixed: Column, found: Column) -> Column:
        at = F.position(found, fixed)
        rest = F.concat(F.substring(fixed, F.lit(1), at - 1), F.substring(fixed, at + F.length(found), F.length(fixed)))
        bad = (found == "") | rest.rlike("[0-9]")
        return F.struct(F.when(~bad, found.try_cast("double")).alias("value"), F.when(bad, "unrepairable").alias("reason"))

    missing = F.struct(F.lit(None).cast("double").alias("value"), F.lit("empty_or_na").alias("reason"))
    made = let(stripped(F.coalesce(token, F.lit(""))), lambda s: F.when(F.upper(s).isin(MISSING), missing).otherwise(let(commas(s), judged)))
    return made.getField("value"), made.getField("reason")


def label_token(value: Column) -> Column:
    """Canonical label text: whole numbers lose their fraction."""
    s = stripped(value)
    number = F.when(s.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), s.try_cast("double"))
    whole = (number == F.floor(number)) & (F.abs(number) < 9e15)
    return F.when(whole, number.cast("long").cast("string")).otherwise(s)


def is_power_of_two(n: Column) -> Column:
    return (n >= 1) & (F.bit_count(n) == 1)


def calendar_like(token: Column) -> Column:
    """A time cell that is neither empty nor a number."""
    return parse_number(token)[1] == "unrepairable"
