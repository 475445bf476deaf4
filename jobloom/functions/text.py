"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# White space as the source data defines it: ASCII blanks plus the Unicode spaces.
SPACES = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
# The same as a regular expression class.
SPACE_CHARS = r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
SPACE = f"[{SPACE_CHARS}]"


def squeeze(text: Column) -> Column:
    """Trim every kind of white space, not only the plain blank."""
    return F.trim(text, F.lit(SPACES))


def canonical(text: Column) -> Column:
    return squeeze(F.lower(text))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_text(*texts: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(t) for t in texts])


def split_list(text: Column, sep: str = ",", keep_blank: bool = False) -> Column:
    """Split, trim each part and (by default) drop blanks; null text gives []."""
    parts = F.transform(F.split(text, sep), squeeze)
    if not keep_blank:
        parts = F.filter(parts, lambda p: p != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def split_locations(text: Column) -> Column:
    """Free-text places: the word "and", "|" and "/" separate like commas."""
    commas = F.regexp_replace(text, r"(?i)(?<![a-z0-9_])and(?![a-z0-9_])|[|/]", ",")
    return split_list(commas)


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", " ")


def with_prefix(prefix: str, path: Column) -> Column:
    """Prefix + path; null when the path is missing."""
    return F.concat(F.lit(prefix), path)


def title_words(text: Column) -> Column:
    """Words longer than three characters, split on white space and slashes."""
    return F.filter(
        F.split(F.lower(text), f"[/{SPACE_CHARS}]+"),
        lambda w: F.length(w) > 3,
    )


def first_keyword(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Value of the first keyword contained in `text`."""
    out = F.lit(None).cast("string")
    for key, value in reversed(rules):
        out = F.when(F.contains(text, F.lit(key)), F.lit(value)).otherwise(out)
    return out


def first_int(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def comma_int(text: Column) -> Column:
    """Integer with grouping commas; nothing but commas gives null."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast("bigint")


def experience_range(text: Column) -> Column:
    """struct(min, max) of the years asked for in a text, null when none.

    "a - b years" is looked for in the whole text first, then "a+ years"
    (open end), then "a years".
    """
    unit = r"(?:years|yrs)"
    both = rf"(?i)(\d+){SPACE}*-{SPACE}*(\d+){SPACE}*{unit}"
    open_end = rf"(?i)(\d+)\+{SPACE}*{unit}"
    single = rf"(?i)(\d+){SPACE}*{unit}"

    def num(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group).try_cast("int")

    def pair(low: Column, high: Column) -> Column:
        return F.struct(low.alias("min"), high.alias("max"))

    return (
        F.when(F.rlike(text, F.lit(both)), pair(num(both, 1), num(both, 2)))
        .when(F.rlike(text, F.lit(open_end)), pair(num(open_end, 1), F.lit(None).cast("int")))
        .when(F.rlike(text, F.lit(single)), pair(num(single, 1), num(single, 1)))
    )


def salary_match(text: Column, spaced: bool = False) -> Column:
    """The salary range in a text, with the currency before it; empty or null when none.

    `spaced` allows blanks around the dash. A text without a dash is not searched.
    """
    dash = f"{SPACE}*-{SPACE}*" if spaced else "-"
    pattern = rf"([A-Za-z]+)?{SPACE}?([\d,]+){dash}([\d,]+)"
    return F.when(F.contains(text, F.lit("-")), F.regexp_extract(text, pattern, 0))


def salary_period(text: Column) -> Column:
    return first_keyword(F.lower(text), [("year", "yearly"), ("month", "monthly")])


def salary_parts(match: Column, period: Column) -> Column:
    """struct(currency, min, max, period) of a `salary_match`: it holds one dash, and digits on both sides."""
    hit = match != ""
    currency = F.coalesce(blank_to_null(F.regexp_extract(match, "^[A-Za-z]*", 0)), F.lit("INR"))

    def amount(side: int) -> Column:
        return comma_int(F.regexp_extract(F.substring_index(match, "-", side), r"[\d,]+", 0))

    return F.struct(
        F.when(hit, currency).alias("currency"),
        F.when(hit, amount(1)).alias("min"),
        F.when(hit, amount(-1)).alias("max"),
        F.when(hit, period).alias("period"),
    )


def salary_range(text: Column, spaced: bool = False) -> Column:
    """struct(currency, min, max, period) of a salary text; null fields when no range.

    `spaced` allows blanks around the dash.
    """
    return salary_parts(salary_match(text, spaced), salary_period(text))


def report_line(source: Column, count: Column) -> Column:
    return F.concat(F.lit("• "), source, F.lit(": "), count.cast("string"))
