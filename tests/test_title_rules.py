"""Rules from a table: against brute force, and what meets before it is verified."""

from __future__ import annotations

import random

from jobloom.operators.title_rules import first_rule, rule_candidates

TEXTS, RULES = "k int, title string", "word string, ord int, role string"


def test_first_rule_against_brute_force(spark):
    rng = random.Random(4)
    text = lambda most: "".join(rng.choice("ab cé") for _ in range(rng.randint(0, most)))
    titles = [(i % 90, text(14)) for i in range(100)] + [(1, None), (2, "aa" * 4000 + "é")]
    rules = [(text(6) or "zz", rng.randint(0, 300), f"r{i}") for i in range(200)] + [(None, 0, "x"), ("a", None, "x"), ("a", 0, None), ("aé", 5, "y")]
    known = sorted((o, r, w) for w, o, r in rules if None not in (w, o, r))
    wanted = [(k, t, None if t is None else next((r for _, r, w in known if w in t), None)) for k, t in titles]
    rows = first_rule(spark.createDataFrame(titles, TEXTS), "title", spark.createDataFrame(rules, RULES), "word", "ord", "role").collect()
    order = lambda found: sorted(found, key=str)
    assert order(map(tuple, rows)) == order(wanted)


def test_common_parts_do_not_make_rules_meet(spark):
    titles = spark.createDataFrame([(i, f"developer {i:04d}x") for i in range(2000)], TEXTS)
    rules = spark.createDataFrame([(f"developer {i:04d}x", i, "r") for i in range(0, 2000, 2)], RULES)
    met = rule_candidates(titles, "title", rules, "word", "ord", "role")
    assert met.count() < 2000 * 1000 / 50
    assert first_rule(titles, "title", rules, "word", "ord", "role").filter("role IS NOT NULL").count() == 1000


def test_empty_tables_and_the_empty_key(spark):
    titles = spark.createDataFrame([(1, "x"), (1, "x"), (2, "")], TEXTS)
    rules = spark.createDataFrame([("", 9, "any"), ("", 8, "all"), ("x", 1, "one")], RULES)
    assert sorted(map(tuple, first_rule(titles, "title", rules, "word", "ord", "role").collect())) == [(1, "x", "one"), (1, "x", "one"), (2, "", "all")]
    assert first_rule(titles, "title", rules.limit(0), "word", "ord", "role").filter("role IS NULL").count() == 3
    assert first_rule(titles.limit(0), "title", rules, "word", "ord", "role").count() == 0
