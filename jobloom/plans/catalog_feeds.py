"""Catalogue: feed stop rules, marks, metrics, write-and-read-back, streams and whole cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom import schemas
from jobloom.operators import feeds, graph
from jobloom.operators.jobs import Dictionaries
from jobloom.operators.normalize import graph_safe
from jobloom.plans import views
from jobloom.plans.catalog_graph import _CYCLE_SQL, graph_jobs
from jobloom.plans.catalog_records import payloads
from jobloom.plans.counts import demand_counts, link_counts, update_counts
from jobloom.plans.cycle import job_nodes_with_age, outcomes, publish_jobs, remove_done, retain, run_cycle, stage_source
from jobloom.plans.registry import query
from jobloom.session import scratch_dir
from jobloom.sources import readers, sinks, state
from jobloom.streaming import jobs as streams

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _streak_sql(partition: str, page: str) -> str:
    return f"""WITH {views.V_ARRIVALS},
    a AS (SELECT *, {page} AS page FROM v_arrivals),
    r AS (SELECT *, sum(CAST(is_new AS INT)) OVER (PARTITION BY {partition} ORDER BY event_id) AS run FROM a),
    s AS (SELECT *, count(*) FILTER (NOT is_new) OVER (PARTITION BY {partition}, run ORDER BY event_id) AS streak FROM r),
    stops AS (SELECT source, min(event_id) AS stop FROM s WHERE streak >= 5 GROUP BY source)
    SELECT a.source, event_id, is_new FROM a LEFT JOIN stops USING (source) WHERE stop IS NULL OR event_id <= stop"""


@query("duplicate_streak_cut", _streak_sql("source", "0"))
def duplicate_streak_cut(spark, sf_dir):
    rows = views.arrivals_view(spark, sf_dir)
    return feeds.cut_at_streak(rows, "source", "event_id", "is_new", k=5, width=1000).select("source", "event_id", "is_new")


@query("duplicate_streak_page", _streak_sql("source, page", "event_id // 50"))
def duplicate_streak_page(spark, sf_dir):
    rows = views.arrivals_view(spark, sf_dir).withColumn("page", F.floor(F.col("event_id") / 50))
    return feeds.cut_at_streak(rows, "source", "event_id", "is_new", k=5, page="page").select("source", "event_id", "is_new")


@query(
    "page_novelty_stop",
    f"""WITH {views.V_ARRIVALS},
    a AS (SELECT *, event_id // 200 AS page FROM v_arrivals),
    p AS (SELECT source, page, count_if(is_new) AS n FROM a GROUP BY ALL),
    stops AS (SELECT source, min(page) AS stop FROM p WHERE n = 0 AND page > 5 GROUP BY source)
    SELECT source, page, event_id FROM a LEFT JOIN stops USING (source) WHERE stop IS NULL OR page <= stop""",
)
def page_novelty_stop(spark, sf_dir):
    rows = views.arrivals_view(spark, sf_dir).withColumn("page", F.floor(F.col("event_id") / 200))
    return feeds.cut_at_stale_page(rows, "source", "page", "is_new").select("source", "page", "event_id")


MARK = "2024-01-15"


@query(
    "hwm_increment",
    f"""SELECT event_id, event_type AS source, strftime(greatest(TIMESTAMP '{MARK}', max(ts) OVER ()), '%Y-%m-%d %H:%M:%S.%f') AS next_mark
    FROM events WHERE ts >= TIMESTAMP '{MARK}' AND event_id % 2 = 1""",
)
def hwm_increment(spark, sf_dir):
    """Rows at or after the mark that are not staged yet, oldest first, and the mark after them."""
    e = views.table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("source"))
    staged = e.filter("event_id % 2 = 0")
    inserted = feeds.since(e, "ts", MARK).join(staged.select("event_id"), "event_id", "left_anti")
    mark = feeds.next_mark(inserted, "ts", MARK)
    return inserted.orderBy("ts").select(
        "event_id", "source", F.date_format(mark, STAMP).alias("next_mark")
    )


@query(
    "run_metrics",
    f"""WITH {views.V_ARRIVALS}
    SELECT location, strftime(created_at, '%Y-%m-%d') AS day, count(*) AS total_requests,
      count_if(source = 'error') AS failed_requests,
      count_if(source <> 'error' AND is_new) AS inserted_jobs, count_if(source <> 'error' AND NOT is_new) AS duplicate_jobs
    FROM v_arrivals GROUP BY ALL""",
)
def run_metrics(spark, sf_dir):
    rows = views.arrivals_view(spark, sf_dir).withColumn("day", F.to_date("created_at").cast("string"))
    return feeds.run_metrics(rows, ["location", "day"], F.col("source") == "error", F.col("is_new"))


CYCLE_TYPES = [
    ("MORNING", "click"), ("MORNING", "view"), ("AFTERNOON", "click"), ("AFTERNOON", "view"),
    ("NIGHT", "click"), ("NIGHT", "view"), ("NIGHT", "signup"),
]


@query(
    "cycle_sources",
    "SELECT event_id, event_type AS source FROM events WHERE event_type IN ('click', 'view', 'signup')",
)
def cycle_sources(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("source"))
    config = views.literal(spark, CYCLE_TYPES, "label, source")
    none = feeds.sources_for_cycle(e, "EVENING", config)
    return feeds.sources_for_cycle(e, "NIGHT", config).unionByName(none)


@query(
    "fresh_jobs",
    """SELECT o_orderkey, o_orderstatus AS location FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-06-02' AND o_orderstatus IN ('F', 'P') AND contains(lower(o_orderpriority), 'urgent')""",
)
def fresh_jobs(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders")
    rows = feeds.fresh(o, "o_orderdate", "2001-08-01", days=60)
    rows = feeds.by_keyword(feeds.by_location(rows, "o_orderstatus", ["F", "P"]), "o_orderpriority", "URGENT")
    return rows.select("o_orderkey", F.col("o_orderstatus").alias("location"))


@query(
    "hwm_state",
    """SELECT event_type AS feed, strftime(CASE WHEN event_type = 'click' THEN max(ts) ELSE
        max(ts) FILTER (ts < TIMESTAMP '2024-01-10') END, '%Y-%m-%d %H:%M:%S.%f') AS max_date FROM events GROUP BY 1
    UNION ALL SELECT 'new feed', '2000-01-01 00:00:00.000000'""",
)
def hwm_state(spark, sf_dir):
    """Marks written for all feeds, one of them moved on, all read back."""
    path = f"{scratch_dir(spark, 'marks')}/marks"
    e = views.table(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), "ts")
    sinks.save_mark(e.filter("ts < TIMESTAMP_NTZ '2024-01-10'").groupBy("feed").agg(F.max("ts").alias("max_date")), path)
    sinks.save_mark(e.filter("feed = 'click'").groupBy("feed").agg(F.max("ts").alias("max_date")), path)
    marks = readers.read_or_empty(spark, path, readers.MARKS).unionByName(readers.read_mark(spark, path, "new feed"))
    return marks.select("feed", F.date_format("max_date", STAMP).alias("max_date"))


@query(
    "jobs_write_roundtrip",
    """SELECT o_orderkey AS _id, 'Job ' || o_orderkey AS job_title, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS batch
    FROM orders""",
)
def jobs_write_roundtrip(spark, sf_dir):
    path = f"{scratch_dir(spark, 'jobs')}/jobs"
    schema = "_id BIGINT, job_title STRING"
    jobs = graph_jobs(spark, sf_dir).select("_id", "job_title")
    sinks.write_jobs(jobs.filter("_id % 2 = 0"), path, 0)
    sinks.write_jobs(jobs, path, 1, existing=sinks.read_batches(spark, path, schema, before=1))
    return sinks.read_batches(spark, path, schema)


def _graph_sql(written: str, seq: str) -> str:
    """Every node and edge of the whole-salary jobs as (table_name, row): all values, as text."""
    low = "floor(o_totalprice / 10000) * 10000"
    return f"""
    WITH whole AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 4 = 0 OR o_orderkey % 9 <> 0),
    salary AS (SELECT {low} AS low, {seq} AS seq, o_orderkey AS k FROM whole WHERE o_orderkey % 4 <> 0),
    last_salary AS (SELECT low, max_by(k, seq) AS k FROM salary GROUP BY low),
    last_role AS (SELECT o_orderpriority AS role, max_by(o_orderkey, {seq}) AS k FROM whole GROUP BY 1)
    SELECT 'node_job' AS table_name, concat_ws('|', o_orderkey, 'Job ' || o_orderkey, o_orderstatus, '/job/' || o_orderkey, {written}, o_orderkey % 7, o_orderkey % 7 + 2) AS row FROM whole
    UNION ALL SELECT 'node_role', concat_ws('|', role, CASE WHEN k % 3 = 0 THEN 'senior' ELSE 'entry' END) FROM last_role
    UNION ALL SELECT DISTINCT 'node_company', c_name FROM whole WHERE o_orderkey % 8 <> 0
    UNION ALL SELECT DISTINCT 'node_skill', 'skill' || (o_orderkey % 11) FROM whole
    UNION ALL SELECT DISTINCT 'node_tool', 'tool' || (o_orderkey % 6) FROM whole
    UNION ALL SELECT 'node_salary', concat_ws('|', low::BIGINT, (low * 2)::BIGINT, CASE WHEN k % 2 = 0 THEN 'USD' ELSE 'INR' END, CASE WHEN k % 5 = 0 THEN 'monthly' ELSE 'year' END) FROM last_salary
    UNION ALL SELECT 'edge_maps_to', concat_ws('|', o_orderkey, o_orderpriority) FROM whole
    UNION ALL SELECT 'edge_posted_by', concat_ws('|', o_orderkey, c_name) FROM whole WHERE o_orderkey % 8 <> 0
    UNION ALL SELECT 'edge_requires', concat_ws('|', o_orderkey, 'skill' || (o_orderkey % 11)) FROM whole
    UNION ALL SELECT 'edge_uses_tool', concat_ws('|', o_orderkey, 'tool' || (o_orderkey % 6)) FROM whole
    UNION ALL SELECT 'edge_offers_salary', concat_ws('|', k, low::BIGINT, (low * 2)::BIGINT) FROM salary"""


def graph_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row): every node and edge with its values as text."""
    whole = lambda c: F.col(c).cast("bigint").cast("string")
    shown = {
        "node_job": ["job_key", "title", "source", "source_url", F.to_date("created_at").cast("string"), "min_experience", "max_experience"],
        "node_role": ["role_title", "difficulty_level"],
        "node_salary": [whole("min"), whole("max"), "currency", "period"],
        "edge_offers_salary": ["job_key", whole("min"), whole("max")],
    }
    out = None
    for name, df in tables.items():
        columns = [F.col(c) if isinstance(c, str) else c for c in shown.get(name, graph.KEYS[name])]
        rows = df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *columns).alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out


def written_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph jobs with a write time that runs against their key."""
    return graph_safe(graph_jobs(spark, sf_dir)).withColumn("updated_at", F.timestamp_seconds(F.lit(2_000_000_000) - F.col("_id")))


def landed_jobs(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """`written_jobs`, written once: each table of each batch then reads the rows, instead of looking up the companies again."""
    jobs = written_jobs(spark, sf_dir)
    jobs.write.option("compression", sinks.CODEC).parquet(f"{root}/_jobs")
    return spark.read.schema(jobs.schema).parquet(f"{root}/_jobs")


@query(
    "graph_write_roundtrip",
    _graph_sql("CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN '2001-08-02' ELSE '2001-08-01' END", "struct_pack(b := o_orderkey % 2 = 0 OR o_orderkey % 3 = 0, t := -o_orderkey)"),
)
def graph_write_roundtrip(spark, sf_dir):
    """Two overlapping batches and one that was never marked as whole; the current state read back."""
    root = scratch_dir(spark, "graph")
    jobs = written_jobs(spark, sf_dir)
    sinks.write_graph(graph.build_graph(jobs.filter("_id % 3 <> 0"), "2001-08-01"), root, 0)
    sinks.write_graph(graph.build_graph(jobs.filter("_id % 2 = 0 OR _id % 3 = 0"), "2001-08-02"), root, 1)
    half = graph.build_graph(jobs.withColumn("job_title", F.lit("half written")), "2001-08-03")
    sinks.write_batch(half["node_job"], f"{root}/node_job", 2)
    return graph_rows(sinks.read_graph(spark, root))


@query("graph_state", _graph_sql("CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN '2001-08-02' ELSE '2001-08-01' END", "struct_pack(b := o_orderkey % 2 = 0 OR o_orderkey % 3 = 0, t := -o_orderkey)"))
def graph_state(spark, sf_dir):
    """The same two batches upserted into a state, with a third version that was never marked as whole."""
    root = scratch_dir(spark, "state")
    jobs = landed_jobs(spark, sf_dir, root)
    for batch, (rows, day) in enumerate((("_id % 3 <> 0", "2001-08-01"), ("_id % 2 = 0 OR _id % 3 = 0", "2001-08-02"))):
        state.upsert_state(spark, graph.build_graph(jobs.filter(rows), day), graph.KEYS, root, batch)
    sinks.write_batch(spark.range(5).select(F.col("id").alias("job_key")), f"{root}/node_job", 2)
    return graph_rows({name: state.read_state(spark, root, name) for name in graph.KEYS})


@query(
    "graph_state_buckets",
    _graph_sql("CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN '2001-08-02' ELSE '2001-08-01' END", "struct_pack(b := o_orderkey % 2 = 0 OR o_orderkey % 3 = 0, t := -o_orderkey)"),
)
def graph_state_buckets(spark, sf_dir):
    """The same state in 16 buckets after a batch was run again, small batches that change nothing, and a clean-up of old versions."""
    root = scratch_dir(spark, "buckets")
    jobs = landed_jobs(spark, sf_dir, root)
    steps = (("_id % 3 <> 0", "2001-08-01"), ("_id % 3 = 1", "2001-08-01"), ("_id % 3 <> 0", "2001-08-01"), ("_id % 2 = 0 OR _id % 3 = 0", "2001-08-02"), ("_id < 0", "2001-08-03"))
    for batch, (rows, day) in zip((0, 1, 1, 2, 3), steps, strict=True):
        state.upsert_state(spark, graph.build_graph(jobs.filter(rows), day), graph.KEYS, root, batch, buckets=16)
    state.remove_versions(spark, root)
    return graph_rows({name: state.read_state(spark, root, name) for name in graph.KEYS})


# ---- streams: run over all available files, results read back ----


def in_slices(spark: SparkSession, df: DataFrame, root: str, part: Column, start, slices: int = 4) -> None:
    """Land a table slice by slice; each is taken by a stream started anew from the checkpoint of the one before.

    State, watermarks and marks therefore have to hold across micro-batches and restarts.
    """
    for n in range(slices):
        df.filter(part == n).write.parquet(f"{root}/landing/{n}")
        start(streams.file_stream(spark, f"{root}/landing/*", df.schema)).awaitTermination()


def by_id(events: DataFrame) -> Column:
    """Quarter of the id range: later slices hold higher ids."""
    top = events.agg(F.max("event_id") + 1).scalar()
    return F.floor(F.col("event_id") * 4 / top)


def by_time() -> Column:
    """Eight days a slice: later slices hold later times."""
    return F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))


_BY_TIME = "least((day(ts) - 1) // 8, 3)"
#: The same, but every tenth row arrives with the last slice.
_OUT_OF_ORDER = f"CASE WHEN event_id % 10 = 0 THEN 3 ELSE {_BY_TIME} END"


def landing(df: DataFrame, path: str) -> int:
    """Land a table as several files, so that a stream takes several batches; returns how many files at most.

    One task writes each, so their number follows the cluster.
    """
    files = views.tasks(df.sparkSession)
    df.repartition(files).write.parquet(path)
    return files


def dictionaries(spark: SparkSession) -> Dictionaries:
    return Dictionaries(views.taxonomy(spark), views.role_skill(spark))


_STREAM_ROLE = "CASE o_orderkey % 4 WHEN 0 THEN 'Frontend Developer' WHEN 1 THEN 'Data Engineer' ELSE 'Others' END"


@query(
    "stream_clean",
    f"""SELECT sha256('naukri' || o_orderkey) AS _id, 'Job ' || o_orderkey AS job_title, {_STREAM_ROLE} AS role_title,
      (['react|javascript|css', 'sql|kafka', '', ''])[CAST(o_orderkey % 4 AS INT) + 1] AS technical, 1 AS n_completed,
      CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS n_duplicate
    FROM orders WHERE o_orderkey % 13 <> 0""",
)
def stream_clean(spark, sf_dir):
    """Records arrive as a stream; a fifth of them lands twice with the same time, or none. Jobs with the outcomes of their records."""
    root = scratch_dir(spark, "clean")
    raw = payloads(spark, sf_dir, "naukri")
    raw = raw.withColumn("created_at", F.when(F.col("external_id") % 10 != 0, F.col("created_at")))
    files = landing(raw.unionByName(raw.filter(F.col("external_id") % 5 == 0)), f"{root}/landing")
    read = streams.file_stream(spark, f"{root}/landing", schemas.RAW, maxFilesPerTrigger=files // 2)
    streams.clean_stream(read, dictionaries(spark), root, "2001-08-01", ["naukri"]).awaitTermination()
    jobs = sinks.read_batches(spark, f"{root}/jobs", schemas.JOB)
    seen = spark.read.parquet(f"{root}/cleaned").groupBy("_id").agg(
        F.count_if(F.col("raw_status") == "completed").alias("n_completed"), F.count_if(F.col("raw_status") == "duplicate").alias("n_duplicate")
    )
    return jobs.join(seen, "_id").select(
        "_id", "job_title", "role_title", F.array_join("skills.technical", "|").alias("technical"), "n_completed", "n_duplicate"
    )


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    root = scratch_dir(spark, "dedup")
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    once = lambda new: streams.first_seen(new.select("user_id", "event_type"), ["user_id", "event_type"])
    in_slices(spark, events, root, by_id(events), lambda new: streams.append_stream(once(new), f"{root}/out", f"{root}/_checkpoint"))
    return spark.read.schema("user_id BIGINT, event_type STRING").parquet(f"{root}/out")


@query(
    "stream_stage",
    "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL",
)
def stream_stage(spark, sf_dir):
    root = scratch_dir(spark, "stage")
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    in_slices(spark, events, root, by_id(events), lambda new: streams.stage_stream(new, ["user_id", "event_type"], "event_id", root))
    return sinks.read_batches(spark, f"{root}/staged", "event_id BIGINT, user_id BIGINT, event_type STRING").drop("batch")


@query("stream_streak_cut", _streak_sql("source", "0"))
def stream_streak_cut(spark, sf_dir):
    """The cut of `duplicate_streak_cut` with the running streak as state: four slices, a new stream for each."""
    root = scratch_dir(spark, "streak")
    rows = views.arrivals_view(spark, sf_dir).select("source", "event_id", "is_new")
    in_slices(spark, rows, root, by_id(rows), lambda new: streams.streak_stream(new, "source", "event_id", "is_new", 5, root, width=1000))
    return sinks.read_batches(spark, f"{root}/taken", "source STRING, event_id BIGINT, is_new BOOLEAN").drop("batch")


@query("stream_cycle_counts", _CYCLE_SQL)
def stream_cycle_counts(spark, sf_dir):
    root = scratch_dir(spark, "cycles")
    events = views.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("source"))
    in_slices(spark, events, root, by_time(), lambda new: streams.cycle_count_stream(new, "ts", root))
    log = sinks.read_batches(spark, f"{root}/cycles", "day DATE, cycle STRING, source STRING, jobs BIGINT")
    return sinks.current(log, ["day", "cycle", "source"]).withColumn("day", F.col("day").cast("string"))


@query(
    "stream_metrics",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(user_id AS VARCHAR) AS location, count(*) AS total_requests,
      count_if(event_type = 'error') AS failed_requests,
      count_if(event_type <> 'error' AND event_id % 3 = 0) AS inserted_jobs,
      count_if(event_type <> 'error' AND event_id % 3 <> 0) AS duplicate_jobs FROM events GROUP BY ALL""",
)
def stream_metrics(spark, sf_dir):
    root = scratch_dir(spark, "metrics")
    events = views.table(spark, sf_dir, "events").withColumn("location", F.col("user_id").cast("string"))
    failed, is_new = F.col("event_type") == "error", F.col("event_id") % 3 == 0
    in_slices(spark, events, root, by_time(), lambda new: streams.metrics_stream(new, "ts", "location", failed, is_new, root))
    log = sinks.read_batches(
        spark, f"{root}/metrics",
        "day DATE, location STRING, total_requests BIGINT, failed_requests BIGINT, inserted_jobs BIGINT, duplicate_jobs BIGINT",
    )
    return sinks.current(log, ["day", "location"]).withColumn("day", F.col("day").cast("string"))


@query(
    "stream_mark",
    """SELECT event_id, strftime(max(ts) OVER (), '%Y-%m-%d %H:%M:%S.%f') AS max_date FROM events""",
)
def stream_mark(spark, sf_dir):
    root = scratch_dir(spark, "mark")
    events = views.table(spark, sf_dir, "events").select("event_id", "ts")
    in_slices(spark, events, root, by_time(), lambda new: streams.mark_stream(new, "events", "ts", ["event_id"], root))
    staged = sinks.read_batches(spark, f"{root}/staged", "event_id BIGINT, ts TIMESTAMP_NTZ")
    marks = sinks.read_batches(spark, f"{root}/marks", readers.MARKS)
    latest = marks.agg(F.date_format(F.max("max_date"), STAMP)).scalar()
    return staged.select("event_id", latest.alias("max_date"))


@query(
    "stream_late_rows",
    f"""WITH e AS (SELECT event_id, ts, {_OUT_OF_ORDER} AS part FROM events),
    tops AS (SELECT part, max(ts) AS top FROM e GROUP BY part),
    m AS (SELECT e.*, (SELECT max(top) FROM tops WHERE tops.part < e.part) AS mark FROM e)
    SELECT event_id, CASE WHEN ts < mark THEN 'late' ELSE 'taken' END AS outcome,
      count(*) OVER () AS n_read, count(*) FILTER (ts < mark) OVER () AS n_late FROM m""",
)
def stream_late_rows(spark, sf_dir):
    """A tenth of the rows comes with the last slice: taken or behind the mark, every row is accounted for."""
    root = scratch_dir(spark, "late")
    events = views.table(spark, sf_dir, "events").select("event_id", "ts")
    out_of_order = F.when(F.col("event_id") % 10 == 0, 3).otherwise(by_time())
    in_slices(spark, events, root, out_of_order, lambda new: streams.mark_stream(new, "events", "ts", ["event_id"], root))
    row = "event_id BIGINT, ts TIMESTAMP_NTZ"
    taken = sinks.read_batches(spark, f"{root}/staged", row).select("event_id", F.lit("taken").alias("outcome"))
    late = sinks.read_batches(spark, f"{root}/late", f"{row}, reason STRING").select("event_id", F.col("reason").alias("outcome"))
    tally = sinks.read_batches(spark, f"{root}/tally", streams.TALLY)
    counts = [tally.agg(F.sum(c)).scalar().alias(c) for c in ("n_read", "n_late")]
    return taken.unionByName(late).select("event_id", "outcome", *counts)


@query(
    "stream_retries",
    f"""WITH e AS (SELECT event_id, {_BY_TIME} AS part FROM events),
    clock AS (SELECT {_BY_TIME} AS part, max(ts) AS now FROM events GROUP BY 1),
    later AS (SELECT c.part, (SELECT min(n.part) FROM clock n WHERE n.part > c.part AND n.now >= c.now + INTERVAL 9 DAY) AS next FROM clock c),
    t AS (SELECT e.event_id, e.part AS first, a.next AS second, b.next AS third
      FROM e JOIN later a USING (part) LEFT JOIN later b ON b.part = a.next)
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN CASE WHEN third IS NULL THEN 'retry' ELSE 'failed' END
        WHEN event_id % 5 = 0 AND second IS NULL THEN 'retry' ELSE 'completed' END AS status,
      CASE WHEN event_id % 7 = 0 THEN 1 + (second IS NOT NULL)::INT + (third IS NOT NULL)::INT
        WHEN event_id % 5 = 0 AND second IS NOT NULL THEN 2 ELSE 1 END AS attempts,
      CASE WHEN event_id % 7 = 0 THEN coalesce(third, second, first) WHEN event_id % 5 = 0 THEN coalesce(second, first) ELSE first END AS part
    FROM t""",
)
def stream_retries(spark, sf_dir):
    """Every seventh row always fails, every fifth the first time; a row waits nine days, which is one slice or two."""
    root = scratch_dir(spark, "retries")
    events = views.table(spark, sf_dir, "events").select("event_id", "ts")
    broken = (F.col("event_id") % 7 == 0) | ((F.col("event_id") % 5 == 0) & (F.col("attempt") < 2))
    attempt = lambda rows: rows.withColumn("error", F.when(broken, F.lit("unreadable")))
    in_slices(spark, events, root, by_time(), lambda new: streams.retry_stream(new, "ts", attempt, root, tries=3, delay="9 days"))
    log = sinks.read_batches(spark, f"{root}/outcomes", "event_id BIGINT, attempt INT, status STRING")
    last = graph.latest(log, ["event_id"], "attempt")
    return last.select("event_id", "status", F.col("attempt").alias("attempts"), F.col("batch").alias("part"))


@query("stream_graph", _graph_sql("'2001-08-01'", "-o_orderkey"))
def stream_graph(spark, sf_dir):
    """Jobs land in the order of their write times, so later batches hold later writes."""
    root = scratch_dir(spark, "stream-graph")
    jobs = written_jobs(spark, sf_dir)
    jobs.repartitionByRange(views.tasks(spark), "updated_at").sortWithinPartitions("updated_at").write.parquet(f"{root}/landing")
    schema = spark.read.parquet(f"{root}/landing").schema
    read = streams.file_stream(spark, f"{root}/landing", schema)
    streams.graph_stream(read, root, "2001-08-01").awaitTermination()
    return graph_rows(sinks.read_graph(spark, f"{root}/graph"))


# Jobs of a cycle over both feeds, as the graph and the analytics see them.
_CYCLE_JOBS = f"""
    made AS (
      SELECT 'foundit' AS source, o_orderkey AS k, 'Others' AS role, unnest(['react', 'sql']) AS skill, o_orderkey % 10 <> 0 AS dated FROM orders
      UNION ALL
      SELECT 'naukri', o_orderkey, {_STREAM_ROLE}, unnest(CASE o_orderkey % 4 WHEN 0 THEN ['react', 'javascript', 'css'] WHEN 1 THEN ['sql', 'kafka'] ELSE [] END), true
      FROM orders WHERE o_orderkey % 13 <> 0),
    feed AS (
      SELECT 'foundit' AS source, o_orderkey AS k, o_orderkey % 10 <> 0 AS dated FROM orders
      UNION ALL SELECT 'naukri', o_orderkey, true FROM orders WHERE o_orderkey % 13 <> 0)"""


@query(
    "run_cycle_counts",
    f"""WITH {_CYCLE_JOBS},
    roled AS (SELECT DISTINCT f.source, f.k, CASE WHEN f.source = 'naukri' THEN (SELECT {_STREAM_ROLE} FROM orders WHERE o_orderkey = f.k) END AS role FROM feed f),
    links AS (SELECT DISTINCT role, skill FROM made)
    SELECT step, 'ok' AS outcome, CAST(n_rows AS BIGINT) AS n_rows FROM (
      SELECT 'stage:foundit' AS step, count(*) AS n_rows FROM orders UNION ALL SELECT 'stage:naukri', count(*) FROM orders
      UNION ALL SELECT 'clean', count(*) FROM feed UNION ALL SELECT 'ingest', count(*) FROM feed
      UNION ALL SELECT 'role_skill_links', count(*) FROM links UNION ALL SELECT 'skill_demand', count(DISTINCT skill) FROM made
      UNION ALL SELECT 'hours_old', count(*) FROM feed WHERE dated
      UNION ALL SELECT 'total_links', count(*) FROM links UNION ALL SELECT 'report', count(*) FROM feed)""",
)
def run_cycle_counts(spark, sf_dir):
    fetched = {s: payloads(spark, sf_dir, s) for s in ("foundit", "naukri")}
    status = run_cycle(
        spark, "AFTERNOON", "2001-08-01 10:00:00", fetched, dictionaries(spark), scratch_dir(spark, "cycle")
    )
    return status.filter(~F.col("step").isin("analytics", "role_stats")).select("step", "outcome", "n_rows")


@query(
    "cycle_recovers",
    f"""SELECT sha256('naukri' || o_orderkey) AS _id, 'Job ' || o_orderkey AS job_title, {_STREAM_ROLE} AS role_title, 1 AS batch,
      'failed|ok' AS clean_steps FROM orders WHERE o_orderkey % 13 <> 0""",
)
def cycle_recovers(spark, sf_dir):
    """The clean step of the first cycle fails; the next one, which stages nothing, cleans its records."""
    root = scratch_dir(spark, "recovers")
    raw = payloads(spark, sf_dir, "naukri")
    sound = dictionaries(spark)
    broken = Dictionaries(sound.taxonomy.drop("bucket"), sound.role_skill)
    steps = [
        run_cycle(spark, "AFTERNOON", f"2001-08-0{day} 10:00:00", {"naukri": raw}, d, root, batch).filter("step = 'clean'").first()["outcome"]
        for batch, (day, d) in enumerate(((1, broken), (2, sound)))
    ]
    jobs = sinks.read_batches(spark, f"{root}/jobs", schemas.JOB)
    return jobs.select("_id", "job_title", "role_title", "batch", F.lit("|".join(steps)).alias("clean_steps"))


@query(
    "retention_rows",
    """SELECT 'raw' AS kind, CAST(o_orderkey AS VARCHAR) AS id, 'failed' AS status FROM orders WHERE o_orderkey % 13 = 0
    UNION ALL SELECT 'raw', CAST(o_orderkey AS VARCHAR), 'queued' FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 2 = 1""",
)
def retention_rows(spark, sf_dir):
    """What a clean-up keeps after a cycle over the even records, with the odd ones staged and not yet cleaned.

    All jobs went into the graph, so none stays; records that failed and queued ones do.
    """
    root = scratch_dir(spark, "retention")
    raw = payloads(spark, sf_dir, "naukri")
    early = raw.filter("external_id % 2 = 0 OR external_id % 13 = 0")
    run_cycle(spark, "AFTERNOON", "2001-08-01 10:00:00", {"naukri": early}, dictionaries(spark), root, 0)
    stage_source(raw, "naukri", root, 1)
    kept, jobs = retain(spark, ("naukri",), root)
    rows = kept.select(F.lit("raw").alias("kind"), F.col("external_id").alias("id"), "status")
    return rows.unionByName(jobs.select(F.lit("job").alias("kind"), F.col("_id").alias("id"), F.lit("pending").alias("status")))


@query(
    "retention_removed",
    """SELECT 'raw' AS kind, CAST(o_orderkey AS VARCHAR) AS id, 0 AS batch FROM orders WHERE o_orderkey % 13 = 0 AND o_orderkey % 2 = 0
    UNION ALL SELECT 'raw', CAST(o_orderkey AS VARCHAR), 1 FROM orders WHERE o_orderkey % 2 = 1
    UNION ALL SELECT 'job', sha256('naukri' || o_orderkey), 2 FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 2 = 1
    UNION ALL SELECT 'node', sha256('naukri' || o_orderkey), 0 FROM orders WHERE o_orderkey % 13 <> 0""",
)
def retention_removed(spark, sf_dir):
    """What the logs hold after a clean-up between two cycles; the records that waited are still cleaned by the second,
    and the graph keeps the jobs whose rows are gone."""
    root = scratch_dir(spark, "removed")
    raw = payloads(spark, sf_dir, "naukri")
    odd = raw.filter("external_id % 2 = 1")
    run_cycle(spark, "AFTERNOON", "2001-08-01 10:00:00", {"naukri": raw.filter("external_id % 2 = 0")}, dictionaries(spark), root, 0)
    stage_source(odd, "naukri", root, 1)
    remove_done(spark, ("naukri",), root)
    run_cycle(spark, "AFTERNOON", "2001-08-02 10:00:00", {"naukri": odd}, dictionaries(spark), root, 2)
    left = sinks.read_batches(spark, f"{root}/raw/naukri", schemas.RAW).select(F.lit("raw").alias("kind"), F.col("external_id").alias("id"), "batch")
    jobs = sinks.read_batches(spark, f"{root}/jobs", schemas.JOB).select(F.lit("job").alias("kind"), F.col("_id").alias("id"), "batch")
    nodes = state.read_state(spark, f"{root}/state", "node_job").select(F.lit("node").alias("kind"), F.col("job_key").alias("id"), F.lit(0).alias("batch"))
    return left.unionByName(jobs).unionByName(nodes)


@query(
    "cycle_again",
    """SELECT CAST(o_orderkey AS VARCHAR) AS external_id, 'failed' AS status, 2 AS n_read FROM orders WHERE o_orderkey % 13 = 0
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'completed', 1 FROM orders WHERE o_orderkey % 13 <> 0""",
)
def cycle_again(spark, sf_dir):
    """Failed records are read again only by the cycle that asks for them; the others once."""
    root = scratch_dir(spark, "again")
    raw = payloads(spark, sf_dir, "naukri")
    for batch, again in enumerate(((), (), ("naukri",))):
        run_cycle(spark, "AFTERNOON", f"2001-08-0{batch + 1} 10:00:00", {"naukri": raw}, dictionaries(spark), root, batch, again)
    read = spark.read.parquet(f"{root}/cleaned").groupBy("external_id").agg(F.count("*").alias("n_read"))
    return outcomes(spark, root).join(read, "external_id").select("external_id", "status", "n_read")


_LINKS = """
    WITH skills AS (
      SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'Frontend Developer' ELSE 'Data Engineer' END AS role,
        unnest(CASE o_orderkey % 4 WHEN 0 THEN ['react', 'javascript', 'css'] ELSE ['sql', 'kafka'] END) AS skill
      FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 4 < 2)"""


@query(
    "cycle_analytics",
    f"""{_LINKS},
    once AS (SELECT role, skill, count(*) AS n, count(*) FILTER (k % 2 = 0) AS early FROM skills GROUP BY ALL)
    SELECT 'link' AS kind, role || '|' || skill AS name, n, '2001-09-30' AS day FROM once
    UNION ALL SELECT 'demand', skill, sum(CASE WHEN early > 0 THEN early ELSE n END)::BIGINT,
      CASE WHEN max(early) > 0 THEN '2001-08-01' ELSE '2001-09-30' END FROM once GROUP BY skill
    UNION ALL SELECT 'aged jobs', '', count(*), '' FROM orders WHERE o_orderkey % 13 <> 0""",
)
def cycle_analytics(spark, sf_dir):
    """Two cycles 60 days apart. Graph jobs of the first have run out by the second: their links are
    counted again, their skills are in demand no more and keep the number and the time of the first cycle, and
    job nodes keep the age they were last given."""
    root = scratch_dir(spark, "analytics")
    raw = payloads(spark, sf_dir, "naukri")
    for batch, (day, rows) in enumerate((("2001-08-01", "external_id % 2 = 0"), ("2001-09-30", "true"))):
        run_cycle(spark, "AFTERNOON", f"{day} 10:00:00", {"naukri": raw.filter(rows)}, dictionaries(spark), root, batch)
    last = lambda name: state.read_state(spark, f"{root}/analytics_state", name)
    day = lambda c: F.to_date(c).cast("string").alias("day")
    links = last("role_skill_links").select(F.lit("link").alias("kind"), F.concat_ws("|", "role_title", "skill").alias("name"), F.col("frequency").alias("n"), day("last_updated"))
    demand = last("skill_demand").select(F.lit("demand").alias("kind"), F.col("skill").alias("name"), F.col("demand_count").alias("n"), day("last_analyzed"))
    aged = job_nodes_with_age(spark, root).filter("hours_old IS NOT NULL").agg(F.count("*").alias("n"))
    return links.unionByName(demand).unionByName(aged.select(F.lit("aged jobs").alias("kind"), F.lit("").alias("name"), "n", F.lit("").alias("day")))


_DAYS = ("2001-08-01", "2001-08-15", "2001-08-30", "2001-09-10", "2001-09-25")


@query(
    "cycle_demand",
    f"""WITH whole AS (SELECT o_orderkey AS k, o_orderpriority AS role FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 9 <> 0),
    days AS (SELECT * FROM (VALUES {", ".join(f"({b}, DATE '{d}')" for b, d in enumerate(_DAYS))}) t(b, day)),
    writes AS (SELECT k % 5 AS b, k, role, 'skill' || (k % 11) AS skill FROM whole
      UNION ALL SELECT 3, k, 'Again', 'again' || (k % 3) FROM whole WHERE k % 7 = 0 AND k % 5 < 2),
    seen AS (SELECT d.b AS t, d.day AS now, w.*, e.day + 21 AS expires FROM days d JOIN writes w ON w.b <= d.b JOIN days e ON e.b = w.b),
    jobs AS (SELECT t, k, max_by(expires, b) > any_value(now) AS active FROM seen GROUP BY ALL),
    roles AS (SELECT DISTINCT t, k, role FROM seen), skills AS (SELECT DISTINCT t, k, skill FROM seen)
    SELECT t AS cycle, 'link' AS kind, role || '|' || skill AS name, count(*) AS n FROM roles JOIN skills USING (t, k) GROUP BY ALL
    UNION ALL SELECT t, 'demand', skill, count(*) FROM skills JOIN jobs USING (t, k) WHERE active GROUP BY ALL""",
)
def cycle_demand(spark, sf_dir):
    """Counts kept up over five cycles against a full recount at each: jobs run out, and some come again with another role, skill and expiry."""
    root = scratch_dir(spark, "counts")
    jobs = landed_jobs(spark, sf_dir, root)
    again = jobs.filter("_id % 7 = 0 AND _id % 5 < 2").withColumn("role_title", F.lit("Again"))
    again = again.withColumn("graph_skills", F.array(F.concat(F.lit("again"), (F.col("_id") % 3).cast("string"))))
    out = None
    for batch, day in enumerate(_DAYS):
        rows = jobs.filter(F.col("_id") % 5 == batch)
        sinks.write_graph(graph.build_graph(rows.unionByName(again) if batch == 3 else rows, day), f"{root}/graph", batch)
        update_counts(spark, root, batch, day, buckets=16)
        links = link_counts(spark, root, batch).select(F.lit("link").alias("kind"), F.concat_ws("|", "role_title", "skill").alias("name"), F.col("frequency").alias("n"))
        demand = demand_counts(spark, root, batch).select(F.lit("demand").alias("kind"), F.col("skill").alias("name"), F.col("demand_count").alias("n"))
        found = links.unionByName(demand).withColumn("cycle", F.lit(batch).cast("bigint"))
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "publish_cycle",
    "SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS batch FROM orders WHERE o_orderkey % 13 <> 0",
)
def publish_cycle(spark, sf_dir):
    """Jobs published once each, by the first publish step after they were made."""
    root = scratch_dir(spark, "publish")
    raw = payloads(spark, sf_dir, "naukri")
    for batch, rows in enumerate(("external_id % 2 = 0", "true")):
        run_cycle(spark, "AFTERNOON", f"2001-08-0{batch + 1} 10:00:00", {"naukri": raw.filter(rows)}, dictionaries(spark), root, batch)
        publish_jobs(spark, root, batch)
    return sinks.read_batches(spark, f"{root}/published", "job_id STRING")


@query(
    "read_raw_files",
    "SELECT CAST(o_orderkey AS VARCHAR) AS external_id, 'Job ' || o_orderkey AS title, f AS fmt FROM orders, (VALUES ('json'), ('parquet')) t(f)",
)
def read_raw_files(spark, sf_dir):
    root = scratch_dir(spark, "raw-files")
    raw = payloads(spark, sf_dir, "naukri")
    out = None
    for fmt in ("json", "parquet"):
        raw.write.format(fmt).save(f"{root}/{fmt}")
        rows = readers.read_raw(spark, f"{root}/{fmt}", fmt).select("external_id", F.get_json_object("payload", "$.title").alias("title"), F.lit(fmt).alias("fmt"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "explode_feed_envelopes",
    """SELECT s AS source, CAST(o_orderkey AS VARCHAR) AS external_id FROM orders,
      (VALUES ('naukri'), ('foundit'), ('instahyre'), ('internshala'), ('internshala-internships'), ('hirist')) t(s) WHERE o_orderkey > 0""",
)
def explode_feed_envelopes(spark, sf_dir):
    """Pages of 50 records in the envelope of each source."""
    key = F.col("o_orderkey")
    record = F.struct(key.alias("id"), key.alias("jobId"))
    pages = views.table(spark, sf_dir, "orders").filter(key > 0).groupBy(F.floor(key / 50).alias("page")).agg(F.collect_list(record).alias("records"))
    out = None
    for source, names in schemas.FEED_KEYS.items():
        body = F.to_json(F.struct(F.col("records").alias(names[0])))
        rows = readers.explode_feed(pages.select("page", body.alias("body")), source).select("source", "external_id")
        out = rows if out is None else out.unionByName(rows)
    return out
