"""Catalogue: dictionaries, skills, roles, vectors."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom import fixed_values as fixed
from jobloom.functions.text import canonical, title_words
from jobloom.functions.values import array_or_empty
from jobloom.operators import roles, skills
from jobloom.operators.nearest import cosine, nearest_roles
from jobloom.operators.overlap import overlap_join
from jobloom.operators.title_rules import first_rule
from jobloom.plans import views
from jobloom.plans.fixtures import BUCKET_ROWS, BUCKET_TEXTS, ROLE_ROWS, ROLE_SKILLS, sql_in, sql_rows
from jobloom.plans.registry import query
from jobloom.session import scratch_dir
from jobloom.sources import readers, sinks


def padded_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as raw skill lists: colour and noun, padded, and one taxonomy term."""
    key = F.col("p_partkey")
    return views.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(
            F.array(F.concat(F.lit("\t "), F.upper("p_name"), F.lit(" "))),
            F.array(
                F.concat(views.pick(views.VOCAB, key % len(views.VOCAB)), F.lit(" ")),
                views.pick(views.VOCAB, (key * 7) % len(views.VOCAB)),
            ),
        ).alias("skills_raw"),
    )


_N = len(views.VOCAB)
_LIST = views.sql_list(views.VOCAB)
_TERMS = f"""v_terms AS (
  SELECT p_partkey, 1 AS pos, lower(p_name) AS term FROM part
  UNION ALL SELECT p_partkey, 2, ({_LIST})[CAST(p_partkey % {_N} AS INT) + 1] FROM part
  UNION ALL SELECT p_partkey, 3, ({_LIST})[CAST(p_partkey * 7 % {_N} AS INT) + 1] FROM part)"""


@query(
    "valid_skills",
    f"""WITH {_TERMS}, {views.V_TAXONOMY}
    SELECT p_partkey, coalesce((SELECT string_agg(term, '|' ORDER BY pos) FROM v_terms t JOIN v_taxonomy x ON x.skill = t.term
            WHERE t.p_partkey = p.p_partkey), '') AS valid_skills FROM part p""",
)
def valid_skills(spark, sf_dir):
    out = skills.filter_valid_skills(padded_terms(spark, sf_dir), "skills_raw", views.taxonomy(spark))
    return out.select("p_partkey", F.array_join("valid_skills", "|").alias("valid_skills"))


@query(
    "classify_skills",
    f"""WITH {_TERMS}, {views.V_TAXONOMY}
    SELECT p_partkey,
      coalesce(string_agg(term, '|' ORDER BY pos) FILTER (bucket = 'technical'), '') AS technical,
      coalesce(string_agg(term, '|' ORDER BY pos) FILTER (bucket = 'tools'), '') AS tools,
      coalesce(string_agg(term, '|' ORDER BY pos) FILTER (bucket = 'soft'), '') AS soft,
      coalesce(string_agg(term, '|' ORDER BY pos) FILTER (bucket IS NULL), '') AS "unknown"
    FROM v_terms LEFT JOIN v_taxonomy ON skill = term GROUP BY p_partkey""",
)
def classify_skills(spark, sf_dir):
    out = skills.classify_skills(padded_terms(spark, sf_dir), "skills_raw", views.taxonomy(spark))
    return out.select(
        "p_partkey",
        *[F.array_join(f"skills.{b}", "|").alias(b) for b in ("technical", "tools", "soft", "unknown")],
    )


@query(
    "unknown_terms",
    f"""WITH {_TERMS}, {views.V_TAXONOMY}
    SELECT term, count(*) AS n FROM v_terms WHERE term NOT IN (SELECT skill FROM v_taxonomy) GROUP BY term""",
)
def unknown_terms(spark, sf_dir):
    terms = padded_terms(spark, sf_dir).select(F.explode("skills_raw").alias("term"))
    return skills.unknown_terms(terms, "term", views.taxonomy(spark))


def part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "part").select(
        F.lower(F.concat_ws(" ", "p_name", "p_brand")).alias("skill")
    ).distinct()


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(skill, category) answers: one good category, a bad one, or two that disagree."""
    n = F.length("skill") % 5
    category = views.pick(["technical", "tools", "soft", "nonsense", "technical"], n)
    terms = part_terms(spark, sf_dir)
    twice = terms.filter(n == 4).select("skill", F.lit("soft").alias("category"))
    foreign = terms.select(F.concat(F.lit("not asked "), "skill").alias("skill"), F.lit("tools").alias("category"))
    return terms.select("skill", category.alias("category")).unionByName(twice).unionByName(foreign)


@query(
    "apply_classification",
    f"""WITH p AS (SELECT DISTINCT lower(concat(p_name, ' ', p_brand)) AS skill FROM part),
    t AS (SELECT skill, bucket, precedence FROM (VALUES {sql_rows(views.TAXONOMY)}) t(skill, bucket, precedence))
    SELECT skill, bucket, precedence FROM t
    UNION ALL SELECT skill, (['technical', 'tools', 'soft'])[length(skill) % 5 + 1], length(skill) % 5 FROM p
      WHERE length(skill) % 5 < 3""",
)
def apply_classification(spark, sf_dir):
    return skills.apply_classification(
        views.taxonomy(spark), answers(spark, sf_dir), asked=part_terms(spark, sf_dir)
    )


@query(
    "skill_roles_long",
    """SELECT lower(p_name) || '/' || p_partkey AS skill, unnest([p_type, p_brand]) AS role FROM part""",
)
def skill_roles_long(spark, sf_dir):
    items = views.table(spark, sf_dir, "part").select(
        F.concat(F.lower("p_name"), F.lit("/"), F.col("p_partkey").cast("string")).alias("skill"),
        F.array("p_type", "p_brand").alias("roles"),
    )
    return skills.skill_roles_long(items)


@query(
    "term_batches",
    """WITH p AS (SELECT DISTINCT lower(concat(p_name, ' ', p_brand)) AS skill FROM part),
    n AS (SELECT skill, row_number() OVER (ORDER BY skill) - 1 AS idx FROM p)
    SELECT skill, idx, idx // 25 AS batch FROM n""",
)
def term_batches(spark, sf_dir):
    return skills.chunk(part_terms(spark, sf_dir), "skill", 25)


@query(
    "classify_terms_hook",
    """WITH p AS (SELECT DISTINCT lower(concat(p_name, ' ', p_brand)) AS skill FROM part)
    SELECT skill, (['technical', 'tools', 'soft'])[length(skill) % 3 + 1] AS category FROM p""",
)
def classify_terms_hook(spark, sf_dir):
    categories = fixed.CATEGORIES

    def stub(terms: list[str]) -> list[tuple[str, str]]:
        """Stands in for a caller's classifier; the answer depends on the term alone."""
        return [(t, categories[len(t) % 3]) for t in terms]

    return skills.classify_terms(part_terms(spark, sf_dir), "skill", stub, 25)


@query(
    "load_dictionaries",
    f"""SELECT 'taxonomy' AS kind, skill AS name, min_by(bucket, precedence) AS value, min(precedence) AS ord
      FROM (VALUES {sql_rows(BUCKET_ROWS)}) t(skill, bucket, precedence)
      GROUP BY skill
    UNION ALL SELECT 'role_skill', role, skill, role_ord FROM (VALUES {sql_rows(ROLE_ROWS)}) r(role, role_ord, skill)
    UNION ALL SELECT 'role_vec', 'Role ' || vec_id, CAST(len(embedding) AS VARCHAR), vec_id FROM embeddings""",
)
def load_dictionaries(spark, sf_dir):
    root = scratch_dir(spark, "dictionaries")
    paths = {}
    for bucket, _, text in BUCKET_TEXTS:
        paths[bucket] = f"{root}/{bucket}"
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(paths[bucket])
    spark.createDataFrame([(json.dumps(ROLE_SKILLS),)], "value string").coalesce(1).write.text(f"{root}/roles")
    views.table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("Role "), F.col("vec_id").cast("string")).alias("role"),
        F.col("vec_id").alias("ord"),
        F.col("embedding").alias("vector"),
    ).write.parquet(f"{root}/vectors")

    taxonomy = readers.load_taxonomy(spark, paths)
    buckets = [taxonomy.filter(F.col("bucket") == b) for b in paths]
    union = skills.one_bucket(skills.union_buckets(*buckets))
    firsts = taxonomy.groupBy("skill").agg(F.min("precedence").alias("ord"))
    role_skills = readers.load_role_skills(spark, f"{root}/roles")
    vectors = readers.load_role_vectors(spark, f"{root}/vectors")
    return (
        union.join(firsts, "skill")
        .select(F.lit("taxonomy").alias("kind"), F.col("skill").alias("name"), F.col("bucket").alias("value"), F.col("ord").cast("bigint").alias("ord"))
        .unionByName(role_skills.select(F.lit("role_skill").alias("kind"), F.col("role").alias("name"), F.col("skill").alias("value"), F.col("role_ord").cast("bigint").alias("ord")))
        .unionByName(vectors.select(F.lit("role_vec").alias("kind"), F.col("role").alias("name"), F.size("vector").cast("string").alias("value"), "ord"))
    )


@query(
    "term_backlog_roundtrip",
    f"""WITH {_TERMS}, {views.V_TAXONOMY}
    SELECT 'backlog' AS kind, term AS line FROM v_terms WHERE term NOT IN (SELECT skill FROM v_taxonomy) GROUP BY term
    UNION ALL SELECT 'unmatched', '{{"role":"' || p_type || '","skills":["' || lower(p_name) || '"],"title":"' || p_brand || '"}}'
    FROM part""",
)
def term_backlog_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "backlog")
    sinks.write_term_backlog(unknown_terms(spark, sf_dir), f"{root}/terms")
    unmatched = views.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("role"), F.lower("p_name").alias("skill"), F.col("p_brand").alias("title")
    )
    sinks.write_unmatched_skills(unmatched, f"{root}/unmatched", "p_partkey", "title")
    return (
        readers.read_term_backlog(spark, f"{root}/terms")
        .select(F.lit("backlog").alias("kind"), F.col("term").alias("line"))
        .unionByName(spark.read.text(f"{root}/unmatched").select(F.lit("unmatched").alias("kind"), F.col("value").alias("line")))
    )


_RULES = " ".join(
    f"WHEN contains(lower(title), '{k}') THEN '{r}'" for k, r in fixed.TITLE_RULES if r in ROLE_SKILLS
)


@query(
    "title_priority_role",
    f"WITH {views.V_TITLES} SELECT job_key, CASE {_RULES} END AS role FROM v_titles",
)
def title_priority_role(spark, sf_dir):
    known = F.array(*[F.lit(r) for r in ROLE_SKILLS])
    return views.title_view(spark, sf_dir).select(
        "job_key", roles.title_role(F.lower("title"), known).alias("role")
    )


@query(
    "title_rules_table",
    """WITH titles AS (SELECT p_partkey, lower(p_name || ' ' || p_type || ' ' || p_brand) AS title FROM part),
    rules AS (SELECT substr(title, pos, 4 + (p_partkey + pos) % 9) AS key, -(p_partkey * 64 + pos) AS ord, 'Role ' || (p_partkey % 17) AS role
      FROM titles, (SELECT unnest(range(1, 51)) AS pos) WHERE pos + 3 <= length(title)),
    first AS (SELECT key, min(ord) AS ord, min_by(role, ord) AS role FROM rules GROUP BY key),
    best AS (SELECT t.title, min_by(f.role, f.ord) AS role FROM (SELECT DISTINCT title FROM titles) t JOIN first f ON contains(t.title, f.key) GROUP BY ALL)
    SELECT p_partkey, role FROM titles LEFT JOIN best USING (title)""",
)
def title_rules_table(spark, sf_dir):
    """Rules cut out of every part's own text at up to 50 places, so their number grows with the table; the first in order wins."""
    name = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    titles = views.table(spark, sf_dir, "part").select("p_partkey", name.alias("title"))
    # 50 rows from each: dealt out before, or the few tasks that read a small file sort them all
    places = titles.repartition(views.tasks(spark), "p_partkey").withColumn("pos", F.explode(F.sequence(F.lit(1), F.lit(50)))).filter(F.col("pos") + 3 <= F.length("title"))
    width = (F.lit(4) + (F.col("p_partkey") + F.col("pos")) % 9).cast("int")
    rules = places.select(
        F.substring(F.col("title"), F.col("pos"), width).alias("key"), (-(F.col("p_partkey") * 64 + F.col("pos"))).alias("ord"),
        F.concat(F.lit("Role "), (F.col("p_partkey") % 17).cast("string")).alias("role"),
    )
    return first_rule(titles, "title", rules, "key", "ord", "role").select("p_partkey", "role")


# Shared steps of the cascade, each on its own so that it can be read against the rules.
_CASCADE = f"""{views.V_TITLES}, {views.V_BASKETS}, {views.V_TAXONOMY}, {views.V_ROLE_SKILL},
tech AS (SELECT job_key, skill FROM v_baskets JOIN v_taxonomy USING (skill) WHERE bucket = 'technical'),
n AS (SELECT job_key, count(*) AS n_valid FROM v_baskets GROUP BY job_key),
counts AS (
  SELECT job_key, count_if(skill IN {sql_in(fixed.HARD_TECH)}) AS strong,
    count_if(skill IN {sql_in(fixed.ML_CORE)}) AS ml, count_if(skill IN {sql_in(fixed.DATA_CORE)}) AS data_core,
    count_if(skill IN {sql_in(fixed.DATA_FALLBACK)}) AS data_any,
    count_if(skill IN {sql_in(fixed.BACKEND_INDICATORS)}) AS backend
  FROM tech GROUP BY job_key),
matched AS (
  SELECT job_key, role, min(role_ord) AS role_ord, count(*) AS matched
  FROM tech JOIN v_role_skill r ON lower(r.skill) = tech.skill GROUP BY job_key, role),
words AS (
  SELECT role, unnest(list_filter(string_split_regex(lower(role), '[\\s/]+'), lambda w: length(w) > 3)) AS word
  FROM (SELECT DISTINCT role FROM v_role_skill)),
boosts AS (
  SELECT m.job_key, m.role, count_if(contains(lower(coalesce(t.title, '')), w.word)) AS hits
  FROM matched m JOIN v_titles t USING (job_key) JOIN words w USING (role) GROUP BY 1, 2),
scores AS (
  SELECT job_key, role, role_ord, matched, matched / (matched + 3)::DOUBLE + CASE hits
      WHEN 0 THEN 0::DOUBLE WHEN 1 THEN 0.1::DOUBLE WHEN 2 THEN 0.1::DOUBLE + 0.1::DOUBLE
      ELSE 0.1::DOUBLE + 0.1::DOUBLE + 0.1::DOUBLE END AS score
  FROM matched JOIN boosts USING (job_key, role)),
best AS (
  SELECT s.job_key, s.role, s.score FROM scores s JOIN counts c USING (job_key)
  WHERE matched >= 2 AND (NOT (contains(role, 'Data Scientist') OR contains(role, 'ML')) OR ml >= 2)
    AND (role <> 'Data Engineer' OR data_core >= 2)
  QUALIFY row_number() OVER (PARTITION BY s.job_key ORDER BY score DESC, role_ord) = 1),
facts AS (
  SELECT t.job_key, t.title, lower(coalesce(t.title, '')) AS tl, coalesce(n_valid, 0) AS n_valid,
    coalesce(strong, 0) AS strong, coalesce(ml, 0) AS ml, coalesce(data_any, 0) AS data_any,
    CASE WHEN b.role = 'Frontend Developer' AND backend > 0 THEN 'Fullstack Developer' ELSE b.role END AS best_role,
    coalesce(b.score, 0) AS score
  FROM v_titles t LEFT JOIN n USING (job_key) LEFT JOIN counts USING (job_key) LEFT JOIN best b USING (job_key)),
branch AS (
  SELECT *, CASE {_RULES} END AS title_role,
    CASE WHEN coalesce(title, '') = '' AND n_valid = 0 THEN 'no_data'
      WHEN (CASE {_RULES} END) IS NOT NULL THEN 'title_priority'
      WHEN strong = 0 AND NOT regexp_matches(tl, '{fixed.ENGINEERING_TITLE}') THEN 'gate'
      WHEN best_role IS NULL AND ml > 0 THEN 'low_confidence_ml'
      WHEN best_role IS NULL AND data_any > 0 THEN 'low_confidence_data'
      WHEN score >= 0.25 THEN 'skills_and_title' WHEN score >= 0.15 THEN 'skills'
      WHEN strong > 0 THEN 'low_confidence' ELSE 'end' END AS how
  FROM facts),"""


def _cascade_sql(times: int) -> str:
    return f"""WITH {_CASCADE} {views.nearest_sql(times)},
    roled AS (
      SELECT b.*, CASE how WHEN 'no_data' THEN 'Others' WHEN 'title_priority' THEN title_role
        WHEN 'low_confidence_ml' THEN 'Data Scientist / ML Engineer' WHEN 'low_confidence_data' THEN 'Data Engineer'
        WHEN 'skills_and_title' THEN best_role WHEN 'skills' THEN best_role
        WHEN 'low_confidence' THEN 'Software Engineer / Developer' ELSE coalesce(v.role, 'Others') END AS role,
        CASE WHEN how IN ('gate', 'end') THEN 'onet' ELSE how END AS extracted_by
      FROM branch b LEFT JOIN v_near v USING (job_key))"""


@query(
    "role_overlap_scores",
    f"""WITH {_CASCADE[:_CASCADE.index('best AS (')].rstrip().rstrip(',')}
    SELECT job_key, role, matched, round(score, 6) AS score FROM scores""",
)
def role_overlap_scores(spark, sf_dir):
    jobs = views.basket_view(spark, sf_dir)
    jobs = skills.classify_skills(jobs, "skills", views.taxonomy(spark), "classified")
    jobs = jobs.select("job_key", "title", F.col("classified.technical").alias("technical"))
    counts = roles.overlap_counts(jobs, "job_key", "technical", views.role_skill(spark))
    titles = views.title_view(spark, sf_dir)
    score = roles.overlap_score(F.col("matched"), title_words(F.col("role")), F.lower(F.coalesce("title", F.lit(""))))
    return counts.join(titles, "job_key").select("job_key", "role", "matched", F.round(score, 6).alias("score"))


@query(
    "role_overlap_prefix",
    f"""WITH {_CASCADE[:_CASCADE.index('words AS (')].rstrip().rstrip(',')}
    SELECT job_key, role, matched FROM matched WHERE matched >= 2""",
)
def role_overlap_prefix(spark, sf_dir):
    """Roles that share two skills or more with a job, found through the rare skills of both."""
    jobs = skills.classify_skills(views.basket_view(spark, sf_dir), "skills", views.taxonomy(spark), "classified")
    jobs = jobs.select("job_key", F.col("classified.technical").alias("technical"))
    listed = views.role_skill(spark).select("role", F.lower("skill").alias("skill"))
    return overlap_join(jobs, "job_key", "technical", listed, "role", "skill")


@query(
    "supplier_overlap_prefix",
    """WITH basket AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
    offered AS (SELECT l_suppkey, l_partkey, count(*) AS times FROM lineitem GROUP BY ALL)
    SELECT l_orderkey, l_suppkey, sum(times)::BIGINT AS matched FROM basket JOIN offered USING (l_partkey) GROUP BY ALL HAVING sum(times) >= 3""",
)
def supplier_overlap_prefix(spark, sf_dir):
    """The same join over data of any size: orders and suppliers that share parts, each weighed by how often the supplier sold it."""
    lines = views.table(spark, sf_dir, "lineitem")
    baskets = lines.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("parts"))
    return overlap_join(baskets, "l_orderkey", "parts", lines.select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey", least=3)


def cascade(spark: SparkSession, sf_dir: str, times: int = 1) -> DataFrame:
    return roles.find_role(
        views.basket_view(spark, sf_dir), "job_key", "title", "skills",
        views.taxonomy(spark), views.role_skill(spark),
        views.role_vec(spark, sf_dir), views.job_vectors(spark, sf_dir, times),
    )


@query("find_role_cascade", _cascade_sql(1) + " SELECT job_key, role, extracted_by FROM roled")
def find_role_cascade(spark, sf_dir):
    return cascade(spark, sf_dir).select("job_key", "role", "extracted_by")


@query("find_role_defaults", _cascade_sql(6) + " SELECT job_key, role, extracted_by FROM roled")
def find_role_defaults(spark, sf_dir):
    out = roles.with_role_defaults(cascade(spark, sf_dir, 6))
    return out.select("job_key", "role", "extracted_by")


@query(
    "unmatched_role_skills",
    _cascade_sql(1)
    + """ SELECT r.job_key, r.role, t.skill, r.title FROM roled r JOIN tech t USING (job_key)
    WHERE how = 'end' AND r.role IN (SELECT role FROM v_role_skill)
      AND NOT EXISTS (SELECT 1 FROM v_role_skill s WHERE s.role = r.role AND lower(s.skill) = t.skill)""",
)
def unmatched_role_skills(spark, sf_dir):
    return roles.unmatched_skills(cascade(spark, sf_dir), "job_key", "title", views.role_skill(spark))


@query(
    "nearest_role_vector",
    f"""WITH {views.V_ROLE_VEC},
    s AS (SELECT e.vec_id, r.role, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), r.vector) AS score, r.ord
      FROM embeddings e, v_role_vec r WHERE e.vec_id % {views.ROLE_EVERY} <> 0)
    SELECT vec_id, role, round(score, 6) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, ord) AS place
    FROM s QUALIFY place <= 3""",
)
def nearest_role_vector(spark, sf_dir):
    out = nearest_roles(views.item_vectors(spark, sf_dir), "vec_id", "embedding", views.role_vec(spark, sf_dir), k=3)
    return out.withColumn("score", F.round("score", 6))


@query(
    "skill_arrays",
    """SELECT p_partkey, lower(p_name) || '|' || lower(p_type) || '|' || lower(p_brand) AS merged,
      CASE WHEN lower(p_name) = lower(p_type) THEN 1 ELSE 2 END AS n_left, contains(lower(p_name), 'ring') AS has_ring
    FROM part""",
)
def skill_arrays(spark, sf_dir):
    from jobloom.functions.text import split_list

    text = F.concat(F.lit("\t"), "p_name", F.lit(" , , "), F.lower("p_type"), F.lit(" ,"))
    left = F.transform(split_list(text), canonical)
    right = F.transform(split_list(F.concat_ws(",", "p_type", "p_brand")), canonical)
    return views.table(spark, sf_dir, "part").select(
        "p_partkey",
        F.array_join(F.array_union(left, right), "|").alias("merged"),
        F.size(F.array_distinct(left)).cast("bigint").alias("n_left"),
        F.array_join(array_or_empty(left), " ").contains("ring").alias("has_ring"),
    )


@query(
    "cosine_scores",
    """SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]),
      (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS score FROM embeddings""",
)
def cosine_scores(spark, sf_dir):
    v = views.table(spark, sf_dir, "embeddings")
    first = v.filter("vec_id = 0").select("embedding").scalar()
    score = F.round(cosine(F.col("embedding"), F.col("first")), 6)
    return v.select("vec_id", "embedding", first.alias("first")).select("vec_id", score.alias("score"))


@query(
    "embedder_hook",
    f"""WITH {views.V_TITLES}
    SELECT job_key, CAST(length(coalesce(title, '') || '. ') AS DOUBLE) AS x, 1.0::DOUBLE AS y FROM v_titles""",
)
def embedder_hook(spark, sf_dir):
    def stub(texts: list[str]) -> list[list[float]]:
        """Stands in for a caller's embedder."""
        return [[len(t), 1] for t in texts]

    jobs = views.title_view(spark, sf_dir).withColumn("skills", F.array().cast("array<string>"))
    vectors = roles.embed_texts(jobs, "job_key", "title", "skills", stub)
    return vectors.select(F.col("key").alias("job_key"), F.col("vector")[0].alias("x"), F.col("vector")[1].alias("y"))
