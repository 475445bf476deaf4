"""Substring rules from a table, of any number: the first rule in order whose key a text contains.

Texts and rules meet on character n-grams: every text lists its own, and every rule waits at the one of
its key that the fewest texts have. What meets is verified by `contains`, so a common word in
many rules costs nothing unless the key has no rarer part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Characters of an n-gram; shorter keys wait at themselves.
GRAM = 3


def _grams(text: Column, n: int) -> Column:
    """Distinct n-grams of a text, none if it is shorter."""
    places = F.sequence(F.lit(1), F.length(text) - n + 1)
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def _waiting(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """(_gram, _key, _ord, _role): each rule at its rarest n-gram. A rule with an n-gram that no text has can match none."""
    key = F.col("_key")
    own = F.when(F.length(key) < GRAM, F.array(key)).otherwise(_grams(key, GRAM))
    parts = rules.withColumn("_gram", F.explode(own))
    seen = listed.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = parts.join(seen, "_gram", "left").groupBy("_key", "_ord", "_role").agg(
        F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"), F.count_if(F.col("_n").isNull()).alias("_unseen")
    )
    return rarest.filter("_unseen = 0").drop("_unseen")


def rule_candidates(texts: DataFrame, text: str, rules: DataFrame, key: str, order: str, role: str) -> DataFrame:
    """(_text, _key, _ord, _role): pairs of distinct texts and rules that meet, before they are verified."""
    once = texts.select(F.col(text).alias("_text")).dropna().distinct()
    first = rules.select(F.col(key).alias("_key"), F.col(order).alias("_ord"), F.col(role).alias("_role")).dropna()
    # of rules with one key only the first can ever be taken
    first = first.groupBy("_key").agg(F.min(F.struct("_ord", "_role")).alias("_first")).select("_key", "_first._ord", "_first._role")
    grams = F.concat(F.array(F.lit("")), *[_grams(F.col("_text"), n) for n in range(1, GRAM + 1)])
    listed = once.withColumn("_gram", F.explode(grams))
    return listed.join(_waiting(first, listed), "_gram").select("_text", "_key", "_ord", "_role")


def first_rule(texts: DataFrame, text: str, rules: DataFrame, key: str, order: str, role: str, out: str = "role") -> DataFrame:
    """Rows with `out`: the role of the first rule (by `order`, then role) whose key the text contains, null if there is none.

    Letters count as they are written. Rules with a null key, order or role match nothing, an empty key every text, a null text
    no rule. Equal texts are worked on once and rows are kept as they are.
    """
    met = rule_candidates(texts, text, rules, key, order, role).filter(F.contains("_text", "_key"))
    best = met.groupBy("_text").agg(F.min_by("_role", F.struct("_ord", "_role")).alias(out))
    return texts.join(best, texts[text] == best["_text"], "left").select(*texts.columns, out)
