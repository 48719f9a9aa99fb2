"""Lenient text-to-number casts and JSON text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _truth(text: Column) -> Column:
    """1 and 0 for the JSON literals ``true`` and ``false``."""
    return F.when(text == "true", F.lit(1)).when(text == "false", F.lit(0))


def finite(text: Column) -> Column:
    """Number of a text, null when it is none; ``inf`` and ``nan`` are words, not numbers."""
    number = text.try_cast("double")
    return F.when((number > float("-inf")) & (number < float("inf")), number)


def lenient_double(text: Column) -> Column:
    """Number of a text, 0.0 when it is none; ``true`` is 1.0."""
    return F.coalesce(_truth(text).cast("double"), finite(text), F.lit(0.0))


def lenient_long(text: Column) -> Column:
    """Whole number of a text, cut toward zero, 0 when it is none; ``true`` is 1."""
    number = text.try_cast("double").try_cast("bigint")
    return F.coalesce(_truth(text).cast("bigint"), text.try_cast("bigint"), number, F.lit(0).cast("bigint"))


def lenient_int(text: Column) -> Column:
    return F.coalesce(_truth(text), text.try_cast("int"), text.try_cast("double").try_cast("int"), F.lit(0))


def whole(text: Column) -> Column:
    """Whole number of a text, cut toward zero; null when it is none."""
    return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))


def present(value: Column, keys: Column, name: str) -> Column:
    """Text of a JSON field that is there: an explicit null reads as the text ``null``; null when the key is missing."""
    return F.when(F.array_contains(keys, name), F.coalesce(value, F.lit("null")))


def plain_number(number: Column) -> Column:
    """A double as text, in digits from 1e-4 up to 1e16 and with a two-digit exponent beyond."""
    java = number.cast("string")
    digits = F.rtrim(java.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    parts = F.split(java, "E")
    power = F.try_element_at(parts, F.lit(2)).try_cast("int")
    short = F.concat(
        F.regexp_replace(parts[0], r"\.0$", ""), F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(power).cast("string"), 2, "0"),
    )
    return F.when(power.isNull(), java).when(power.between(-4, 15), plain).otherwise(short)


def cast_lenient(text: Column, kind: str) -> Column:
    return {
        "string": lambda c: c,
        "double": lenient_double,
        "int": lenient_int,
        "bigint": lenient_long,
    }[kind](text)


def inner_json(value: Column) -> Column:
    """Text held by a JSON string literal; null when the value is anything else."""
    return F.when(F.ltrim(value).startswith('"'), F.get_json_object(value, "$"))


def strip_control(value: Column) -> Column:
    """Drop the literal sequences ``\\r`` and ``\\n`` and all control characters.

    Most text holds neither a backslash nor a control character; one greedy scan finds that out, and such text is left as it is.
    """
    clean, whole = F.rlike(value, F.lit(r"\A[^\x00-\x1F\x7F\\]*\z")), value
    for sequence in (r"\\r\\n", r"\\r", r"\\n", r"[\x00-\x1F\x7F]"):
        value = F.regexp_replace(value, sequence, "")
    return F.when(clean, whole).otherwise(value)


def json_string_literal(text: Column) -> Column:
    """The text as a JSON string literal (used to write double-encoded messages)."""
    wrapped = F.to_json(F.struct(text.alias("v")))
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with a barrier that filters on computed columns are not pushed through.

    Without it the optimizer copies costly expressions (JSON parsing above all) into every such filter.
    """
    row = F.struct(*[F.col(name) for name in df.columns])
    return df.select(F.explode_outer(F.array(row)).alias("_row")).select("_row.*")
