"""Role of a job: an ordered cascade of title rules, skill overlap and vector match."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fixed
from jobloom.functions.text import title_words
from jobloom.functions.values import array_or_empty, count_in
from jobloom.operators.lookup import attach, computed_once, distinct_lists
from jobloom.operators.nearest import Block, block_roles, nearest_in_block, nearest_roles
from jobloom.operators.skills import bucket_lists, canonical_terms, names, no_buckets
from jobloom.session import scratch_dir

Embedder = Callable[[list[str]], list[list[float]]]


def has_engineering_term(title: Column) -> Column:
    return F.rlike(title, F.lit(fixed.ENGINEERING_TITLE))


def title_role(title: Column, roles: Column) -> Column:
    """Role of the first title rule that matches and whose role is known."""
    # the rules after the one that holds are not tried
    return F.coalesce(*[F.when(F.contains(title, F.lit(k)) & F.array_contains(roles, r), F.lit(r)) for k, r in fixed.TITLE_RULES])


def title_boost(words: Column, title: Column) -> Column:
    """0.1 for each longer word of the role name found in the title, added one by one."""
    hits = F.filter(words, lambda w: F.contains(title, w))
    return F.aggregate(hits, F.lit(0.0), lambda acc, _: acc + F.lit(0.1))


def overlap_score(matched: Column, words: Column, title: Column) -> Column:
    """Coverage of the role's skills plus the boost for its `words` in the title."""
    return matched / (matched + F.lit(3)) + title_boost(words, title)


def passes_gates(role: Column, matched: Column, ml_core: Column, data_core: Column) -> Column:
    """Two matches at least, and two core skills for the ML and data roles."""
    is_ml = role.contains("Data Scientist") | role.contains("ML")
    return (matched >= 2) & (~is_ml | (ml_core >= 2)) & ((role != "Data Engineer") | (data_core >= 2))


def role_terms(role_skill: DataFrame) -> DataFrame:
    """(role, skill, times): lower-cased role skills; a repeat in the list counts again."""
    return role_skill.groupBy("role", F.lower("skill").alias("skill")).agg(F.count("*").alias("times"))


def overlap_counts(jobs: DataFrame, key: str, technical: str, role_skill: DataFrame) -> DataFrame:
    """(key, role, matched): shared skills of every job and role that share any."""
    skills = jobs.select(key, F.explode(F.array_distinct(technical)).alias("skill"))
    return (
        skills.join(role_terms(role_skill), "skill")
        .groupBy(key, "role")
        .agg(F.sum("times").alias("matched"))
    )


def role_listing(role_skill: DataFrame) -> DataFrame:
    """(skill, role_ord, role, words, times): the roles that list a skill, each under its lowest `role_ord`."""
    place = role_skill.groupBy("role").agg(F.min("role_ord").cast("bigint").alias("role_ord"))
    return role_terms(role_skill).join(place, "role").select(
        "skill", "role_ord", "role", title_words(F.col("role")).alias("words"), "times"
    )


def candidate_roles(lists: DataFrame, tagged: str, role_skill: DataFrame, out: str) -> DataFrame:
    """(_list, out): the roles that share two skills or more with a list, with the number shared.

    The rows stay where the distinct lists are, so only the dictionary moves while it is small.
    """
    own = lists.select("_list", F.explode(F.array_distinct(names(F.col(tagged), "technical"))).alias("skill"))
    role = ["role_ord", "role", "words"]
    shared = own.join(role_listing(role_skill), "skill").groupBy("_list", *role).agg(F.sum("times").alias("matched"))
    return (
        shared.filter(F.col("matched") >= 2)
        .groupBy("_list")
        .agg(F.collect_list(F.struct(*role, "matched")).alias(out))
    )


def with_profiles(
    df: DataFrame, skills: str, taxonomy: DataFrame, role_skill: DataFrame, tagged: str = "_tagged", candidates: str = "_candidates"
) -> DataFrame:
    """Add `tagged` (as `with_buckets`) and `candidates` (roles sharing skills), with one join of the rows.

    The lists are written, since they are read twice, and then what they found: with a known size, wide rows are not shuffled to meet a few lists.
    """

    def settled(found: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(df.sparkSession, label)
        found.write.option("compression", "zstd").parquet(path)
        return df.sparkSession.read.schema(found.schema).parquet(path)

    terms = canonical_terms(skills)
    lists = settled(bucket_lists(distinct_lists(df, terms), taxonomy, tagged), "lists")
    found = settled(lists.join(candidate_roles(lists, tagged, role_skill, candidates), "_list", "left"), "profiles")
    return attach(df, terms, found).withColumn(tagged, F.coalesce(tagged, no_buckets()))


def _with_best(df: DataFrame, candidates: str) -> DataFrame:
    """Add `_best`: of the candidates that pass the gates the highest score, the first role on ties."""
    passed = F.filter(
        candidates,
        lambda c: passes_gates(c["role"], c["matched"], F.col("_ml_core"), F.col("_data_core")),
    )
    scored = F.transform(
        passed,
        lambda c: F.struct(
            overlap_score(c["matched"], c["words"], F.col("_title")).alias("score"),
            (-c["role_ord"]).alias("first"),
            c["role"].alias("role"),
        ),
    )
    return computed_once(df, (candidates,), _best=F.array_max(scored))


def decide(
    df: DataFrame,
    title: str,
    skills: str,
    taxonomy: DataFrame,
    role_skill: DataFrame,
    tagged: str | None = None,
) -> DataFrame:
    """Add role, extracted_by, needs_vector, fell_through and technical: all but the vector match.

    `fell_through` marks rows that passed the title gate and matched no branch.
    `tagged` names the column of buckets if `with_profiles` was called before.
    """
    if tagged is None:
        tagged = "_tagged"
        df = with_profiles(df, skills, taxonomy, role_skill, tagged)
    df = computed_once(
        df,
        _title=F.lower(F.coalesce(F.col(title), F.lit(""))),
        _technical=names(F.col(tagged), "technical"),
    )
    df = computed_once(
        df,
        _strong=count_in("_technical", fixed.HARD_TECH),
        _ml_core=count_in("_technical", fixed.ML_CORE),
        _data_core=count_in("_technical", fixed.DATA_CORE),
        _data_any=count_in("_technical", fixed.DATA_FALLBACK),
        _backend=count_in("_technical", fixed.BACKEND_INDICATORS),
    )
    df = _with_best(df, "_candidates")
    titled = role_skill.filter(F.col("role").isin(*[r for _, r in fixed.TITLE_RULES]))
    known = titled.agg(F.collect_set("role").alias("r"))
    df = computed_once(
        df.withColumn("_roles", known.scalar()),
        ("_roles",),
        _winner=F.struct("_best.role", F.coalesce("_best.score", F.lit(0.0)).alias("score")),
        _title_role=title_role(F.col("_title"), F.col("_roles")),
        _gated=(F.col("_strong") == 0) & ~has_engineering_term(F.col("_title")),
    )
    no_title = F.coalesce(F.col(title), F.lit("")) == ""
    no_skills = F.size(array_or_empty(F.col(skills))) == 0
    by_title, gated = F.col("_title_role"), F.col("_gated")
    score, best = F.col("_winner.score"), F.col("_winner.role")
    winner = F.when((best == "Frontend Developer") & (F.col("_backend") > 0), "Fullstack Developer").otherwise(best)

    def pick(role: Column | str, how: str) -> Column:
        return F.struct(
            (F.lit(role) if isinstance(role, str) else role).alias("role"), F.lit(how).alias("how")
        )

    choice = (
        F.when(no_title & no_skills, pick("Others", "no_data"))
        .when(by_title.isNotNull(), pick(by_title, "title_priority"))
        .when(gated, pick(F.lit(None).cast("string"), "onet"))
        .when(winner.isNull() & (F.col("_ml_core") > 0), pick("Data Scientist / ML Engineer", "low_confidence_ml"))
        .when(winner.isNull() & (F.col("_data_any") > 0), pick("Data Engineer", "low_confidence_data"))
        .when(score >= 0.25, pick(winner, "skills_and_title"))
        .when(score >= 0.15, pick(winner, "skills"))
        .when(F.col("_strong") > 0, pick("Software Engineer / Developer", "low_confidence"))
        .otherwise(pick(F.lit(None).cast("string"), "onet"))
    )
    chosen = computed_once(df, _choice=choice)
    chosen = computed_once(
        chosen,
        role=F.col("_choice.role"),
        extracted_by=F.col("_choice.how"),
        needs_vector=F.col("_choice.how") == "onet",
        fell_through=(F.col("_choice.how") == "onet") & ~gated,
    )
    return chosen.withColumnRenamed("_technical", "technical").drop(
        "_tagged", "_title", "_strong", "_ml_core", "_data_core", "_data_any", "_backend",
        "_best", "_winner", "_title_role", "_gated", "_choice",
    )


def find_role(
    df: DataFrame,
    key: str,
    title: str,
    skills: str,
    taxonomy: DataFrame,
    role_skill: DataFrame,
    role_vec: DataFrame | None = None,
    embeddings: DataFrame | None = None,
    tagged: str | None = None,
    embedder: Embedder | None = None,
) -> DataFrame:
    """Add role, extracted_by, technical and fell_through to each row; the cascade is evaluated once.

    Only rows left over by the cascade meet a vector: from `embeddings(key, vector)`, of
    which a repeated key counts once (the least vector), or from `embedder`, called
    with their role texts alone. A row without a vector ends as "Others".
    """
    decided = decide(df, title, skills, taxonomy, role_skill, tagged)
    left_over = F.col("needs_vector")
    if role_vec is None or (embeddings is None and embedder is None):
        return decided.withColumn("role", F.coalesce("role", F.when(left_over, F.lit("Others")))).drop("needs_vector")
    # written once: settled rows go on as they are, and only the rest meets the vectors
    path = scratch_dir(df.sparkSession, "decided")
    decided.write.parquet(path)
    decided = df.sparkSession.read.schema(decided.schema).parquet(path)
    block = block_roles(role_vec) if embedder is None else None
    if block is not None:
        near = _near_by_key(embeddings, block)
        told = decided.filter(left_over).join(near, F.col(key) == F.col("_key"), "left").withColumn("role", F.coalesce("_near", F.lit("Others"))).drop("_key", "_near")
        return decided.filter(~left_over).unionByName(told).drop("needs_vector")
    open_rows = decided.filter(left_over).withColumn("_row", F.monotonically_increasing_id())
    if embedder is not None:
        text = role_text(F.col(title), F.coalesce(F.col(skills), F.array().cast("array<string>")))
        vectors = open_rows.select("_row", _embedded(text, embedder).alias("_vector"))
    else:
        own = embeddings.groupBy(F.col("key").alias("_key")).agg(F.min("vector").alias("_vector"))
        vectors = open_rows.select("_row", F.col(key).alias("_key")).join(own, "_key").select("_row", "_vector")
    near = nearest_roles(vectors, "_row", "_vector", role_vec).select("_row", F.col("role").alias("_near"))
    told = open_rows.join(near, "_row", "left").withColumn("role", F.coalesce("_near", F.lit("Others"))).drop("_row", "_near")
    return decided.filter(~left_over).unionByName(told).drop("needs_vector")


def _near_by_key(embeddings: DataFrame, block: Block) -> DataFrame:
    """(_key, _near): the nearest role of each key's least vector, matched where the vectors lie, so only names are moved.

    Keys that are listed more than once are few or known by their own list, which is written so that Spark knows its size;
    of all vectors only theirs are compared.
    """
    own = embeddings.select(F.col("key").alias("_key"), F.col("vector").alias("_vector")).filter(F.col("_key").isNotNull())
    again = own.groupBy("_key").agg(F.count("*").alias("_n")).filter("_n > 1").select("_key")
    path = scratch_dir(embeddings.sparkSession, "again")
    again.write.parquet(path)
    again = embeddings.sparkSession.read.schema(again.schema).parquet(path)
    single = nearest_in_block(own, "_key", "_vector", block).join(again, "_key", "left_anti")
    least = own.join(again, "_key", "left_semi").groupBy("_key").agg(F.min("_vector").alias("_vector"))
    near = single.unionByName(nearest_in_block(least, "_key", "_vector", block))
    return near.select("_key", F.col("role").alias("_near"))


def with_role_defaults(df: DataFrame) -> DataFrame:
    return df.withColumn("role", F.coalesce("role", F.lit("Others"))).withColumn(
        "extracted_by", F.coalesce("extracted_by", F.lit("unknown"))
    )


def role_text(title: Column, skills: Column) -> Column:
    """Text a caller embeds for the vector match."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.array_join(skills, ", "))


def _embedded(text: Column, embedder: Embedder) -> Column:
    """Vectors of a text column, one call per Arrow batch with the texts that are not null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            wanted = [t for t in texts if t is not None]
            vectors = iter(embedder(wanted) if wanted else [])
            yield pd.Series([None if t is None else [float(x) for x in next(vectors)] for t in texts], dtype=object)

    return F.pandas_udf(run, "array<double>")(text)


def embed_texts(df: DataFrame, key: str, title: str, skills: str, embedder: Embedder) -> DataFrame:
    """(key, vector): role texts through a caller's embedder, one call per Arrow batch.

    The embedder runs on the workers and has to be importable or a closure there.
    """
    vector = _embedded(role_text(F.col(title), F.col(skills)), embedder)
    return df.select(F.col(key).alias("key"), vector.alias("vector"))


def unmatched_skills(decided: DataFrame, key: str, title: str, role_skill: DataFrame) -> DataFrame:
    """(key, role, skill, title): technical skills outside the list of the chosen role.

    Only rows that fell through to the vector match report, and only for roles
    with a list.
    """
    terms = decided.filter("fell_through").select(key, "role", title, F.explode("technical").alias("skill"))
    lists = role_skill.select("role", F.lower("skill").alias("skill")).distinct()
    return (
        terms.join(role_skill.select("role").distinct(), "role", "left_semi")
        .join(lists, ["role", "skill"], "left_anti")
        .select(key, "role", "skill", title)
    )
