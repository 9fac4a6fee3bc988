"""SQL expressions that read untrusted text.  None of them can fail a job.

Each takes and returns SQL text: a whole set of checks then reaches Spark in a few
calls instead of thousands of single column operations.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from quayside.spec import Column

# --- Fixed values: what counts as a number, a date and time, and an empty field.

NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?[0-9]{1,18}\s*$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
SPACED_TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"

EMPTY_TOKENS = ("",)
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# --- End of fixed values.


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def moment(value: datetime) -> str:
    """A date and time without a zone, whatever the zone of the session or the machine."""
    return f"timestamp_ntz'{value:%Y-%m-%d %H:%M:%S}'"


def matches(text: str, pattern: str) -> str:
    return f"rlike({text}, r'{pattern}')"


def is_number(text: str) -> str:
    return matches(text, NUMBER_PATTERN)


def has_decimal_point(text: str) -> str:
    return f"contains({text}, '.')"


def has_exponent(text: str) -> str:
    return f"(contains({text}, 'e') OR contains({text}, 'E'))"


def number_or_null(text: str, type_name: str = "double") -> str:
    return f"CASE WHEN {is_number(text)} THEN try_cast({text} AS {type_name}) END"


def timestamp_or_null(text: str) -> str:
    """``yyyy-M-d H:m:s`` without a zone; the session time zone plays no part."""
    return (
        f"CASE WHEN {matches(text, TIMESTAMP_PATTERN)} THEN try_cast({text} AS timestamp_ntz) "
        f"WHEN {matches(text, SPACED_TIMESTAMP_PATTERN)} "
        f"THEN try_cast(regexp_replace({text}, r'\\s+', ' ') AS timestamp_ntz) END"
    )


def typed_or_null(column: Column, text: str) -> str:
    """The staged value of a text field, or null where it does not convert."""
    if column.is_timestamp:
        return timestamp_or_null(text)
    if column.type == "string":
        return text
    return number_or_null(text, column.type)


def typed(column: Column, text: str) -> str:
    """The staged value after the checks have passed; a leftover misfit fails the write."""
    if column.type == "string":
        return text
    if column.is_timestamp:
        return (
            f"CASE WHEN {matches(text, TIMESTAMP_PATTERN)} THEN cast({text} AS timestamp_ntz) "
            f"ELSE cast(regexp_replace({text}, r'\\s+', ' ') AS timestamp_ntz) END"
        )
    return f"cast(trim({text}) AS {column.type})"


def exceeds_scale(text: str, value: str, scale: int) -> str:
    """More decimal places than ``scale``, trailing zeros not counted.

    Plain numbers are judged by their digits, with a pattern that is applied only to
    texts long enough to need it; numbers with an exponent by their exact value.
    """
    exact = f"try_cast({text} AS decimal(38,18))"
    unit = f"{10.0**-scale:.{scale}f}BD"
    rounding = f"({exact} % {unit} <> 0 OR ({exact} = 0 AND {value} <> 0))"
    digits = rf"length(regexp_extract({text}, r'\.([0-9]*[1-9])0*\s*$', 1))"
    long = f"{has_decimal_point(text)} AND length({text}) - instr({text}, '.') > {scale} AND {digits} > {scale}"
    return f"(CASE WHEN {has_exponent(text)} THEN {rounding} ELSE {long} END)"


def likely_kind(text: str) -> str:
    """0 for an integer, 1 for another number, 2 for a date and time, 3 for anything else."""
    return (
        f"CASE WHEN {text} IS NULL THEN NULL WHEN {matches(text, INTEGER_PATTERN)} THEN 0 "
        f"WHEN {is_number(text)} THEN 1 WHEN {timestamp_or_null(text)} IS NOT NULL THEN 2 ELSE 3 END"
    )


def key_text(columns: list[str] | tuple[str, ...], separator: str = " | ") -> str:
    """The parts of a key as one readable string, nulls spelled out."""
    parts = ", ".join(f"coalesce(cast({name(c)} AS string), 'NULL')" for c in columns)
    return f"concat_ws({literal(separator)}, {parts})"


def null_tokens(df: DataFrame, tokens: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn the given field values into null in an all-text table, except in columns to keep."""
    listed = ", ".join(literal(t) for t in tokens)
    return df.selectExpr(
        *[
            name(c) if c in keep else f"CASE WHEN {name(c)} NOT IN ({listed}) THEN {name(c)} END AS {name(c)}"
            for c in df.columns
        ]
    )


def as_text(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"cast({name(c)} AS string) AS {name(c)}" for c in df.columns])
