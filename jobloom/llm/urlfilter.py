"""URL filter by path templates, learnt per host from the urls that rules decide.

Each host is a tree of path segments. A segment under a node stays as it is when
it is frequent there and its urls are labelled otherwise than its siblings'; variable
segments become a wildcard, and branches that cannot be told from the rest merge with it. The tree is walked
until no branch left can be told apart. A template is rejected when the smoothed share of blocked urls among its labelled ones is high.
Everything is counts by key and joins; a host with a third of all urls is pre-aggregated
before each shuffle, and the joins it takes part in have one small row a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import settle

#: Segments that a template names in any case; what follows them and the last literal is one tail.
DEPTH = 3
#: A segment is frequent with so many urls.
LEAST = 4
#: Stars as a segment of the url itself get a backslash in front, so that no url looks like a wildcard or a tail.
STARS = r"^(\\*\*{1,2})$"
#: Chi-square of three label classes in two groups, at the level of 1 %.
DIFFERS = 9.21
#: Weight of the share of blocked urls over all hosts, and the share from which a template is rejected.
SMOOTHING, REJECT = 4.0, 0.9
#: That share counts as so much at most: other templates' labels alone never reject one.
NEUTRAL = 0.5


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path after the first `://`; both empty for null or where it is missing."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (`host/path`) that fits the host or a domain above it and begins the path; of equal lengths the first in order of text."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        top, slash, rest = rule.partition("/")
        fits.append(F.when(((host == top) | host.endswith("." + top)) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def _chi_square(n: Column, b: Column, a: Column, all_n: Column, all_b: Column, all_a: Column) -> Column:
    """Of a branch (urls, blocked, allowed) against the rest of its node."""
    total = F.lit(0.0)
    for own, whole in ((b, all_b), (a, all_a), (n - b - a, all_n - all_b - all_a)):
        for of_group, size in ((own, n), (whole - own, all_n - n)):
            expected = whole.cast("double") * size / all_n
            total = total + F.when(expected > 0, (of_group - expected) * (of_group - expected) / expected).otherwise(0.0)
    return total


def _may_differ() -> Column:
    """Of a node: chi-square is at most its urls, and nothing without two label classes. What may not differ here may not below."""
    classes = [F.col(c) > 0 for c in ("all_b", "all_a")] + [F.col("all_n") > F.col("all_b") + F.col("all_a")]
    return (F.col("all_n") >= DIFFERS) & (sum((c.cast("int") for c in classes), F.lit(0)) > 1)


def judge(spark: SparkSession, pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template: one row per page, repeated rows and null ids too.

    `rules` maps `host/path` to block or allow. A url that a rule fits has the rule's
    verdict; another has block if its template is rejected, else allow. Null, malformed
    and empty urls share the empty host. No pages give no rows.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    verdict_of = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else None
    read = read.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("string"))
    read = read.withColumn("ruled", verdict_of[F.col("rule")] if rules else F.lit(None).cast("string"))
    segments = F.split(F.substring(F.col("path"), 2, 2**31 - 1), "/", -1)
    rows = read.withColumn("node", F.col("host")).withColumn("left", F.when(F.col("path") != "", segments))
    counts = [F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("b"), F.count_if(F.col("ruled") == "allow").alias("a")]
    rows = rows.withColumns({"template": F.col("node"), "more": F.lit(False)})
    level = 0
    while True:
        level += 1
        rows = settle(spark, rows.withColumn("segment", F.get(F.col("left"), F.lit(0))), "url_rows")
        branches = rows.where(F.col("segment").isNotNull()).groupBy("node", "segment").agg(*counts)
        whole = branches.groupBy("node").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"), F.sum("a").alias("all_a"))
        if level > DEPTH and whole.where(_may_differ()).isEmpty():
            break
        frequent = branches.where(F.col("n") >= LEAST).join(whole, "node")
        differs = _chi_square(*(F.col(c) for c in ("n", "b", "a", "all_n", "all_b", "all_a"))) >= DIFFERS
        kept = frequent.where(differs).select("node", "segment", F.lit(True).alias("literal"))
        token = F.when(F.col("literal"), F.regexp_replace("segment", STARS, r"\\$1")).otherwise("*")
        node = F.when(F.col("segment").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), token))
        named = F.col("literal").isNotNull() | F.lit(level <= DEPTH)
        rows = rows.join(kept, ["node", "segment"], "left").withColumns({
            "node": node, "left": F.when(F.size("left") > 1, F.slice("left", 2, 2**31 - 1)),
            "template": F.when(named, node).otherwise(F.col("template")),
            "more": F.when(F.col("segment").isNull(), F.col("more")).when(named, F.size("left") > 1).otherwise(True),
        }).drop("literal", "segment")
    rows = rows.withColumn("template", F.when(F.col("more"), F.concat("template", F.lit("/**"))).otherwise(F.col("template"))).drop("left", "node", "segment", "more")
    templates = rows.groupBy("template").agg(*counts)
    overall = templates.agg(((F.sum("b") + 1.0) / (F.sum("b") + F.sum("a") + 2.0)).alias("prior"))
    purity = (F.col("b") + SMOOTHING * F.least("prior", F.lit(NEUTRAL))) / (F.col("b") + F.col("a") + SMOOTHING)
    rejected = templates.join(F.broadcast(overall)).where(purity >= REJECT).select("template", F.lit("block").alias("learnt"))
    verdict = F.coalesce("ruled", "learnt", F.lit("allow"))
    return rows.join(rejected, "template", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template")


def sql(rules: dict[str, str], pages: str = "pages") -> str:
    """The same in DuckDB's SQL: one step of a recursive query a level, over the rows that have segments left."""
    fits, ruled = [], []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        top, slash, rest = rule.partition("/")
        fits.append(f"WHEN (host = '{top}' OR suffix(host, '.{top}')) AND prefix(path, '{slash}{rest}') THEN '{rule}'")
        ruled.append(f"WHEN '{rule}' THEN '{rules[rule]}'")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def counts(prefix: str, over: str = "") -> str:
        cases = {"n": "", "b": " FILTER (ruled = 'block')", "a": " FILTER (ruled = 'allow')"}
        return ", ".join(f"count(*){case}{over} AS {prefix}{name}" for name, case in cases.items())

    chi = " + ".join(
        f"CASE WHEN {whole}::DOUBLE * {size} / all_n > 0 THEN ({of} - {whole}::DOUBLE * {size} / all_n) * ({of} - {whole}::DOUBLE * {size} / all_n) / ({whole}::DOUBLE * {size} / all_n) ELSE 0 END"
        for own, whole in (("b", "all_b"), ("a", "all_a"), ("(n - b - a)", "(all_n - all_b - all_a)"))
        for of, size in ((own, "n"), (f"({whole} - {own})", "(all_n - n)")))
    return f"""
WITH RECURSIVE rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM {pages}),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fitted AS (SELECT *, {f"CASE {' '.join(fits)} END" if fits else 'NULL::VARCHAR'} AS rule FROM split),
start AS (SELECT *, {f"CASE rule {' '.join(ruled)} END" if ruled else 'NULL::VARCHAR'} AS ruled FROM fitted),
walk AS (
    SELECT *, 0 AS level, host AS node, host AS template, false AS more, CASE WHEN path <> '' THEN string_split(substr(path, 2), '/') ELSE []::VARCHAR[] END AS left_over FROM start
    UNION ALL
    SELECT page_id, host, path, rule, ruled, level + 1, next_node,
        CASE WHEN named THEN next_node ELSE template END, CASE WHEN named THEN len(left_over) > 1 ELSE true END, left_over[2:]
    FROM (SELECT *, kept OR level < {DEPTH} AS named, node || '/' || CASE WHEN kept THEN regexp_replace(left_over[1], '{STARS}', '\\\\\\1') ELSE '*' END AS next_node
        FROM (SELECT *, n >= {LEAST} AND {chi} >= {DIFFERS} AS kept
            FROM (SELECT *, {counts("", " OVER (PARTITION BY node, left_over[1])")}, {counts("all_", " OVER (PARTITION BY node)")}
                FROM walk WHERE len(left_over) > 0)))),
named AS (SELECT * REPLACE (CASE WHEN more THEN template || '/**' ELSE template END AS template) FROM walk WHERE len(left_over) = 0),
template AS (SELECT template, {counts("")} FROM named GROUP BY template),
prior AS (SELECT least((sum(b) + 1.0::DOUBLE) / (sum(b) + sum(a) + 2.0::DOUBLE), {NEUTRAL}::DOUBLE) AS prior FROM template),
rejected AS (SELECT template FROM template, prior WHERE (b + {SMOOTHING}::DOUBLE * prior) / (b + a + {SMOOTHING}::DOUBLE) >= {REJECT})
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN template IN (FROM rejected) THEN 'block' ELSE 'allow' END) AS verdict, template
FROM named
"""
