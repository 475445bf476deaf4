"""Number, null and array column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.text import first_keyword


def no_strings() -> Column:
    return F.array().cast("array<string>")


def number_or_null(value: Column) -> Column:
    """Number of a value; not a number and zero both give null."""
    return F.nullif(value.try_cast("double"), F.lit(0.0))


def zero_default(value: Column, default: float = 0.0) -> Column:
    """Falsy default: null and zero both become `default`."""
    return F.coalesce(F.nullif(value.cast("double"), F.lit(0.0)), F.lit(default))


def array_or_empty(arr: Column) -> Column:
    return F.coalesce(arr, no_strings())


def pluck(arr: Column, field: str | None = None) -> Column:
    """Non-empty values of one field of an array of structs (or of the array itself)."""
    values = arr if field is None else arr[field]
    return array_or_empty(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def first_of(arr: Column) -> Column:
    return F.get(arr, F.lit(0))


def find_first(arr: Column, test) -> Column:
    return F.get(F.filter(arr, test), F.lit(0))


def null_if_empty(arr: Column) -> Column:
    return F.when(F.size(arr) > 0, arr)


def sql_text(value: str | None) -> str:
    """A text constant in SQL; long constant lists are cheaper to hand over as one expression."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(texts) -> Column:
    return F.expr(f"array({', '.join(sql_text(t) for t in texts)})")


def count_in(column: str, words: tuple[str, ...]) -> Column:
    """How many elements of an array column, repeats included, are among `words`."""
    return F.expr(f"size(filter({column}, s -> s IN ({', '.join(sql_text(w) for w in words)})))")


def job_type_of(types: Column) -> Column:
    """Canonical job type of a list of free-text employment types."""
    return first_keyword(
        F.lower(F.array_join(types, " ")),
        [
            ("full", "fulltime"),
            ("part", "parttime"),
            ("contract", "contract"),
            ("intern", "internship"),
            ("permanent", "fulltime"),
        ],
    )


def difficulty_of(min_years: Column) -> Column:
    return F.when(min_years > 6, "senior").when(min_years > 2, "mid").otherwise("entry")


def one_period(period: Column) -> Column:
    """Salary period in one wording: one source says "year" where the others say "yearly"."""
    return F.when(period == "year", F.lit("yearly")).when(period == "month", F.lit("monthly")).otherwise(period)


def packed(key: Column) -> Column:
    """Text as bytes, a digest in hex as the half of its letters: what `unpacked` gives back is the same text.

    Hex of a digest hardly compresses in a shuffle. The first byte says which of the two it is.
    """
    digest = F.unhex(key)
    is_digest = (F.length(key) == 64) & (F.lower(F.hex(digest)) == key)
    return F.when(is_digest, F.concat(F.lit(b"\x01"), digest)).otherwise(F.concat(F.lit(b"\x00"), key.cast("binary")))


def unpacked(key: Column) -> Column:
    """The text that `packed` was given."""
    rest = F.substring(key, 2, 2**31 - 1)
    return F.when(F.substring(key, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
