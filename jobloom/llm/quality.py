"""Quality rules as weak supervision, in DataFrame functions alone.

Every rule votes good (1), bad (-1) or abstains (0). A rule that looks for one kind of
junk votes bad or abstains: not to be that junk says little. To be none of the junk does say something: one more
rule votes good then, which ties the good class to documents without any. Documents are counted by
their votes; expectation-maximisation over these counts (at most 3^rules) estimates how many
documents are good and how often each rule gives each vote on good and on bad ones, and
each combination of votes gets the posterior probability that its documents are good.
That takes the place of passing all rules.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import ids_and_texts, settle

BLANK = r" \t-\r"
ENDED = '[.!?…。")»”][ \\t-\\r]*$'
WINDOW = 8
ROUNDS, POSTERIOR = 40, 0.5
#: First guesses: share of good documents, and how often a rule votes good on good, good on bad, bad on good, bad on bad ones;
#: in each class they count as much as `WEIGHT` documents, at every size of the input: they keep logarithms finite, and the data decide.
PRIOR, GUESS, WEIGHT = 0.8, (0.8, 0.65, 0.005, 0.3), 0.1
SHARES = (0.01, 0.99)
#: name: (value in SQL, good if, bad if); a missing condition is never met. `n_words` is above 0 where a value is used.
RULES = {
    "length": ("n_words", ">= 50", "< 20"),
    "word_length": ("word_chars / n_words", "BETWEEN 2.5D AND 12D", "< 1.5D"),
    "endings": ("n_ended / n_lines", ">= 0.9D", "< 0.4D"),
    "variety": ("IF(n_words >= 100, n_distinct / n_words, NULL)", "> 0.5D", "< 0.25D"),
    "symbols": ("n_symbols / word_chars", None, "> 0.05D"),
    "capitals": ("n_capitals / word_chars", None, "> 0.4D"),
    "shouts": ("n_shouts / n_words", None, "> 0.25D"),
    "lines": ("n_dup_lines / n_lines", None, "> 0.5D"),
    "repeats": ("n_repeat_words / n_words", None, "> 0.3D"),
}
RULES["no_junk"] = (f"CASE WHEN {' OR '.join(f'{value} {bad}' for value, good, bad in RULES.values() if good is None)} THEN 0 ELSE 1 END", "= 1", None)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of each document; null texts are empty.

    Windows of `WINDOW` words are compared by the hash of their words' hashes, inside the
    row: no window leaves its document. Only texts in which some window comes
    twice are sorted to find which.
    """
    read = ids_and_texts(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = read.select(
        "doc_id", F.filter(F.split("text", f"[{BLANK}]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{BLANK}]")).alias("lines"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_shouts"),
    )
    counted = cut.select(
        "doc_id", "n_symbols", "n_capitals", "n_shouts",
        F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"), F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda line: line.rlike(ENDED))).cast("long").alias("n_ended"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    names = [c for c in counted.columns if c != "hashes"]
    at = [f"hashes[i + {k}]" for k in range(WINDOW)]
    keys = F.expr(f"CASE WHEN size(hashes) >= {WINDOW} THEN transform(sequence(0, size(hashes) - {WINDOW}), i -> xxhash64({', '.join(at)})) ELSE array() END")
    keyed = counted.select(*names, keys.alias("keys"))
    order = F.expr("CASE WHEN size(array_distinct(keys)) < size(keys) THEN array_sort(transform(keys, (k, i) -> struct(k AS k, i AS i))) ELSE array() END")
    ordered = keyed.select(*names, order.alias("o"), F.size("keys").alias("n_keys"))
    again = F.expr("array_sort(transform(filter(transform(o, (x, j) -> struct(x.i AS i, (j > 0 AND o[j - 1].k = x.k) OR (j < n_keys - 1 AND o[j + 1].k = x.k) AS same)), x -> x.same), x -> x.i))")
    found = ordered.select(*names, again.alias("r"))
    covered = F.expr(f"aggregate(transform(r, (x, j) -> CASE WHEN j < size(r) - 1 THEN least({WINDOW}, r[j + 1] - x) ELSE {WINDOW} END), 0L, (s, x) -> s + x)")
    return found.select(*names, covered.alias("n_repeat_words"))


def _vote(value: str, good: str | None, bad: str | None) -> str:
    cases = [f"WHEN {value} {met} THEN {vote}" for met, vote in ((good, 1), (bad, -1)) if met]
    return f"CASE WHEN n_words = 0 THEN 0 {' '.join(cases)} ELSE 0 END"


#: What a vote adds to the log odds of a good document: a good vote never takes from them, a bad one never adds.
_SAYS = "CASE v WHEN 1 THEN greatest(0{d}, ln({r}.good_good / {r}.good_bad)) WHEN -1 THEN least(0{d}, ln({r}.bad_good / {r}.bad_bad)) ELSE 0{d} END"
_RATES = (("good_good", "1", "q"), ("good_bad", "1", "(1 - q)"), ("bad_good", "-1", "q"), ("bad_bad", "-1", "(1 - q)"))


def _posterior(model: str, votes: str) -> str:
    said = f"aggregate(zip_with({votes}, {model}.rates, (v, r) -> {_SAYS.format(r='r', d='D')}), 0D, (x, y) -> x + y)"
    return f"1 / (1 + exp(-(ln({model}.prior / (1 - {model}.prior)) + {said})))"


def fitted(patterns: DataFrame) -> DataFrame:
    """(votes, n) to one row (patterns, model): expectation-maximisation as one expression over at most 3^rules patterns."""
    total = "aggregate(zip_with(patterns, posts, (p, q) -> {}), 0D, (x, y) -> x + y)".format
    rates = ", ".join(f"({total(f'IF(p.votes[j] = {vote}, p.n * {share}, 0D)')} + {guess * WEIGHT}D) / ({total(f'p.n * {share}')} + {WEIGHT}) AS {name}" for (name, vote, share), guess in zip(_RATES, GUESS, strict=True))
    prior = f"least({SHARES[1]}D, greatest({SHARES[0]}D, {total('p.n * q')} / {total('p.n')}))"
    posts = f"transform(patterns, p -> {_posterior('s', 'p.votes')})"
    step = f"transform(array({posts}), posts -> struct({prior} AS prior, transform(sequence(0, {len(RULES) - 1}), j -> struct({rates})) AS rates))[0]"
    first = ", ".join(f"{guess}D AS {name}" for (name, _, _), guess in zip(_RATES, GUESS, strict=True))
    start = f"struct({PRIOR}D AS prior, array_repeat(struct({first}), {len(RULES)}) AS rates)"
    row = patterns.agg(F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("patterns"))
    return row.withColumn("model", F.expr(f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> {step})"))


def estimate(patterns: DataFrame) -> DataFrame:
    """(votes, n) to (votes, posterior): the probability that documents with these votes are good."""
    done = fitted(patterns)
    return done.select("model", F.explode("patterns").alias("p")).select("p.votes", F.expr(_posterior("model", "p.votes")).alias("posterior"))


def judge(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures, base_failed, posterior and kept of each document, repeated rows and null ids too.

    base_failed: under 20 words, or over 30 % of the words in repeated windows. kept: not
    base_failed, and a posterior of at least `POSTERIOR`. Null texts and texts without words count as empty: no rule
    votes on them and they are base_failed. Texts are read whole, however long. No documents give no rows.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    votes = F.expr(f"array({', '.join(_vote(*rule) for rule in RULES.values())})")
    rows = settle(spark, measures(docs, id_col, text_col).withColumns({"base_failed": failed, "votes": votes}), "quality_measures")
    posterior = estimate(rows.groupBy("votes").agg(F.count("*").alias("n")))
    judged = rows.join(F.broadcast(posterior), "votes")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= POSTERIOR))


def _sql_posterior(model: str, votes: str) -> str:
    said = f"list_sum([{_SAYS.format(r=f'{model}.rates[j]', d='')} FOR v, j IN {votes}])"
    return f"1 / (1 + exp(-(ln({model}.prior / (1 - {model}.prior)) + {said})))"


def sql(documents: str = "documents") -> str:
    """The same in DuckDB's SQL."""
    word = r"[^\x20\x09-\x0D]+"
    votes = re.sub(r"(\d)D\b", r"\1", ", ".join(_vote(*rule) for rule in RULES.values()))
    posts = f"[{_sql_posterior('e', 'p.votes')} FOR p IN w.patterns]"
    total = "list_sum([{} FOR p, k IN patterns])".format
    of = lambda share: share.replace("q", "posts[k]")
    rates = ", ".join(f"'{name}': ({total(f'CASE WHEN p.votes[j] = {vote} THEN p.n * {of(share)} ELSE 0 END')} + {guess * WEIGHT}) / ({total(f'p.n * {of(share)}')} + {WEIGHT})" for (name, vote, share), guess in zip(_RATES, GUESS, strict=True))
    first = ", ".join(f"'{name}': {guess}::DOUBLE" for (name, _, _), guess in zip(_RATES, GUESS, strict=True))
    prior = f"least({SHARES[1]}, greatest({SHARES[0]}, {total('p.n * posts[k]')} / {total('p.n')}))"
    return f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text FROM {documents}),
cut AS (
    SELECT no, doc_id, regexp_extract_all(text, '{word}') AS words, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{word}')] AS lines,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals,
           length(text) - length(replace(text, '!', '')) AS n_shouts
    FROM texts),
windows AS (SELECT no, unnest([{{'i': i, 'k': words[i:i + {WINDOW - 1}]}} FOR i IN range(1, len(words) - {WINDOW - 2})], recursive := true) FROM cut),
again AS (SELECT no, i FROM windows QUALIFY count(*) OVER (PARTITION BY no, k) > 1),
spans AS (SELECT no, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY no ORDER BY i) - i, {WINDOW})) AS n FROM again),
covered AS (SELECT no, sum(n)::BIGINT AS n FROM spans GROUP BY no),
measured AS (
    SELECT doc_id, len(words) AS n_words, coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars, n_symbols, n_capitals, n_shouts, len(lines) AS n_lines,
           len([x FOR x IN lines IF regexp_matches(x, '{ENDED}')]) AS n_ended, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(list_distinct(words)) AS n_distinct, coalesce(covered.n, 0) AS n_repeat_words
    FROM cut LEFT JOIN covered USING (no)),
voted AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, [{votes}] AS votes FROM measured),
counts AS (SELECT votes, count(*)::DOUBLE AS n FROM voted GROUP BY votes),
one AS (SELECT list({{'votes': votes, 'n': n}} ORDER BY votes) AS patterns FROM counts),
em(i, prior, rates) AS (
    SELECT 0, {PRIOR}::DOUBLE, [{{{first}}} FOR j IN range({len(RULES)})]
    UNION ALL
    SELECT i + 1, {prior}, [{{{rates}}} FOR j IN range(1, {len(RULES) + 1})]
    FROM (SELECT e.i, w.patterns, {posts} AS posts FROM em AS e, one AS w WHERE e.i < {ROUNDS}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_sql_posterior('em', 'votes')} >= {POSTERIOR} AS kept
FROM voted, em WHERE em.i = {ROUNDS}
"""
