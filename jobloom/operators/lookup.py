"""Dictionaries joined to the distinct lists of a table.

What a dictionary says about a row's list depends on the list alone. So each distinct
list is looked up once: its terms are exploded, joined by key and put together again,
and the result is joined back by a digest of the list. Rows meet one join, whatever the
size of the dictionary; a list shared by a third of all rows is cut to one row per task
before it is shuffled, and its rows are split at run time. Nothing depends on row
numbers, so a recomputed task gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, drop: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """Add columns that later expressions and filters read instead of repeating.

    The optimizer copies a projected expression into every filter and expression
    above it; with nested array functions that multiplies the work on each row.
    The output of a generator is not copied, and one over a single-element array
    costs next to nothing. `drop` lists the helper columns used up here: an
    attached index must go in the step that probes it, or rows would carry it.
    """
    kept = [c for c in df.columns if c not in drop]
    done = df.select(*kept, *[c.alias(f"_once_{name}") for name, c in columns.items()])
    row = F.struct(*[F.col(f"_once_{name}").alias(name) for name in columns])
    return done.select(*kept, F.inline(F.array(row)))


def list_key(terms: Column) -> Column:
    """A digest that equal lists share, in order and with nulls and repeats; null for an empty or null list."""
    text = F.array_join(F.transform(terms, lambda t: F.hex(t)), ",", "-")
    return F.when(F.size(terms) > 0, F.unhex(F.sha2(text, 256)))


def distinct_lists(df: DataFrame, terms: Column) -> DataFrame:
    """(_list, _terms): every list that is not empty, once. Copies go before the shuffle."""
    lists = computed_once(df.filter(F.size(terms) > 0).select(terms.alias("_terms")), _list=list_key(F.col("_terms")))
    return lists.dropDuplicates(["_list"]).select("_list", "_terms")


def attach(df: DataFrame, terms: Column, found: DataFrame) -> DataFrame:
    """Rows with the columns of `found` (one row per `_list`), null for an empty list."""
    return df.withColumn("_list", list_key(terms)).join(found, "_list", "left").drop("_list")
