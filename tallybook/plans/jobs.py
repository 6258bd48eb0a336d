"""Registered queries on jobs, detail records, mirrors and streams, and the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.lineage import shared
from tallybook.operators import cdc, detail, jobs, mirror, quality
from tallybook.sources import ledger
from tallybook.streaming import incremental, observations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_OBS = f"WITH obs AS ({ledger.OBSERVATIONS}), "

#: A task a day; its job, how it ended, and which of its attempts counts.
TASKS = """SELECT task_id, CAST(month(task_id) * 10 + floor(day(task_id) / 10) AS BIGINT) AS job_id,
  CASE day(task_id) % 7 WHEN 3 THEN 'FAILED' WHEN 5 THEN 'CANCELLED' WHEN 6 THEN CASE WHEN month(task_id) % 4 = 1 THEN 'RETRY_WAIT' ELSE 'DONE' END ELSE 'DONE' END AS status,
  CAST(1 + day(task_id) % 2 AS BIGINT) AS attempts, CASE WHEN day(task_id) % 7 = 3 THEN 'error ' || CAST(day(task_id) AS VARCHAR(20)) END AS last_error
FROM (SELECT DISTINCT CAST(ts AS DATE) AS task_id FROM events) t"""
FETCHES = "SELECT DISTINCT CAST(ts AS DATE) AS task_id, CAST(1 + event_id % 2 AS BIGINT) AS attempt_no, event_type, user_id % 5 AS page_no FROM events"

#: Nine candidate slots a declaration, some empty, some pointing to no master.
SLOTS = """SELECT CAST(p_partkey AS BIGINT) AS rcno,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey + 1 AS BIGINT) END AS alcohol_candidate_1_id, CAST(p_size AS DOUBLE) * 100.5 AS alcohol_candidate_1_score,
  CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey + 8 AS BIGINT) END AS alcohol_candidate_2_id, CAST(p_size AS DOUBLE) / 4 AS alcohol_candidate_2_score,
  CAST(NULL AS BIGINT) AS alcohol_candidate_3_id, CAST(NULL AS DOUBLE) AS alcohol_candidate_3_score,
  CAST(substring(p_brand, 7) AS BIGINT) AS distillery_candidate_1_id, 7.0E0 AS distillery_candidate_1_score, CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) END AS distillery_candidate_2_id, 2.5E0 AS distillery_candidate_2_score,
  CASE WHEN p_size > 40 THEN CAST(-1 AS BIGINT) END AS distillery_candidate_3_id, -4.0E0 AS distillery_candidate_3_score,
  CAST(1 + p_size % 5 AS BIGINT) AS region_candidate_1_id, 1.0E0 AS region_candidate_1_score, CAST(100 + p_size % 30 AS BIGINT) AS region_candidate_2_id, 0.5E0 AS region_candidate_2_score,
  CASE WHEN p_size % 2 = 0 THEN CAST(105 AS BIGINT) END AS region_candidate_3_id, 0.25E0 AS region_candidate_3_score
FROM part"""


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query(_OBS + f"""tasks AS ({TASKS}), fetches AS ({FETCHES}), acc AS (SELECT o.*, t.job_id FROM obs o JOIN tasks t ON o.task_id = t.task_id AND t.status = 'DONE' AND o.attempt_no = t.attempts),
 firsts AS (SELECT rcno, min(item_id) AS least FROM acc GROUP BY 1)
 SELECT job_id, count(*) AS total_tasks, count(*) FILTER (status = 'DONE') AS completed_tasks, count(*) FILTER (status = 'FAILED') AS failed_tasks,
 (SELECT count(*) FROM fetches f JOIN tasks x USING (task_id) WHERE x.job_id = t.job_id) AS fetched_requests, (SELECT count(*) FROM acc a WHERE a.job_id = t.job_id) AS parsed_rows,
 (SELECT count(DISTINCT rcno) FROM acc a WHERE a.job_id = t.job_id) AS unique_keys, (SELECT count(DISTINCT a.rcno) FROM acc a JOIN firsts f ON a.rcno = f.rcno AND a.item_id = f.least WHERE a.job_id = t.job_id) AS new_keys
 FROM tasks t GROUP BY job_id""")
def c7_job_counters(spark, d):
    """Counters of every job over accepted attempts, new keys included."""
    return jobs.job_counters(ledger.observations(spark, d), ledger.frame(spark, d, FETCHES), ledger.frame(spark, d, TASKS))


@query(f"""WITH tasks AS ({TASKS}) SELECT job_id, CASE WHEN count(*) FILTER (status IN ('PENDING', 'LEASED', 'RETRY_WAIT')) > 0 THEN 'RUNNING' WHEN job_id % 3 = 2 THEN 'CANCELLED' WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'PARTIAL_FAILED' ELSE 'COMPLETED' END AS status,
 count(*) AS total, count(*) FILTER (status = 'DONE') AS done, count(*) FILTER (status = 'FAILED') AS failed, max(last_error) AS last_error FROM tasks GROUP BY job_id""")
def c8_job_status(spark, d):
    """Status of every job from its tasks."""
    tasks = ledger.frame(spark, d, TASKS)
    known = tasks.select("job_id").distinct().select("job_id", F.lit("RUNNING").alias("status"), (F.col("job_id") % 3 == 2).alias("cancel_requested"))
    return jobs.job_status(known, tasks).select("job_id", "status", "total", "done", "failed", "last_error")


@query(f"""WITH syn_keys AS ({ledger.KEYS}), syn_pages AS ({ledger.PAGES}),
 p AS (SELECT task_id, attempt, item_code, string_agg(CAST(page_no AS VARCHAR) || '/' || CAST(total AS VARCHAR) || '/' || CAST(parsed_rows AS VARCHAR), ',' ORDER BY page_no) AS pages, count(*) AS n_pages FROM syn_pages GROUP BY ALL),
 k AS (SELECT task_id, attempt, item_code, sha256(string_agg(CAST(rcno AS VARCHAR), ',' ORDER BY rcno)) AS keys, count(*) AS n_keys FROM syn_keys GROUP BY ALL),
 i AS (SELECT task_id, attempt, string_agg(item_code || ':' || pages || ':' || keys, ';' ORDER BY item_code) AS items, sum(n_pages) AS n_pages, sum(n_keys) AS n_keys FROM p JOIN k USING (task_id, attempt, item_code) GROUP BY ALL)
 SELECT task_id, count(*) AS attempts, CAST(sum(n_pages) AS BIGINT) AS n_pages, CAST(sum(n_keys) AS BIGINT) AS n_keys, sha256(string_agg(CAST(attempt AS VARCHAR) || '=' || items, '|' ORDER BY attempt)) AS listed_sha256 FROM i GROUP BY task_id""")
def c9_attempt_evidence(spark, d):
    """Pages and keys of every attempt, nested, with a digest of the whole."""
    e = jobs.attempt_evidence(ledger.pages(spark, d), ledger.keys(spark, d))
    page = lambda p: F.concat_ws("/", p["page_no"].cast("string"), p["total"].cast("string"), p["parsed_rows"].cast("string"))
    item = lambda i: F.concat_ws(":", i["item_code"], F.array_join(F.transform(i["pages"], page), ","), F.sha2(F.array_join(F.transform(i["keys"], lambda x: x.cast("string")), ","), 256))
    text = F.transform("attempts", lambda a: F.concat(a["attempt"].cast("string"), F.lit("="), F.array_join(F.transform(a["items"], item), ";")))
    total = lambda c: F.aggregate(F.transform(F.flatten(F.transform("attempts", lambda a: a["items"])), lambda i: F.size(i[c]).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return e.select("task_id", F.size("attempts").cast("long").alias("attempts"), total("pages").alias("n_pages"), total("keys").alias("n_keys"), F.sha2(F.array_join(text, "|"), 256).alias("listed_sha256"))


def _labelled(target: str, k: int, table: str) -> tuple[str, str]:
    a = f"{table}{k}"
    names = f"nullif(concat_ws(' / ', nullif({a}.kor_name, ''), nullif({a}.eng_name, '')), '')"
    score = f"format('{{:,.2f}}', s.{target}_candidate_{k}_score)"
    text = f"CASE WHEN s.{target}_candidate_{k}_id IS NULL THEN '' ELSE concat_ws(' · ', {names}, 'ID ' || CAST(s.{target}_candidate_{k}_id AS VARCHAR), '점수 ' || {score}) END AS {target}_candidate_{k}"
    return text, f"LEFT JOIN {table} {a} ON {a}.id = s.{target}_candidate_{k}_id"


_NINE = [_labelled(t, k, m) for t, m in (("alcohol", "alcohols"), ("distillery", "makers"), ("region", "areas")) for k in (1, 2, 3)]


@query(f"WITH slots AS ({SLOTS}), alcohols AS ({ledger.ALCOHOLS}), makers AS ({ledger.DISTILLERIES}), areas AS ({ledger.REGIONS}) SELECT s.rcno, " + ", ".join(x for x, _ in _NINE) + " FROM slots s " + " ".join(y for _, y in _NINE))
def h8_candidate_labels(spark, d):
    """Labels of the nine candidate slots of every declaration, by one join."""
    alcohols, makers, areas = ledger.references(spark, d)
    return detail.candidate_labels(ledger.frame(spark, d, SLOTS), "rcno", alcohol=alcohols, distillery=makers, region=areas)


_LONG = " UNION ALL ".join(f"SELECT rcno, '{t}' AS target, {k} AS rank, {t}_candidate_{k}_id AS id, {t}_candidate_{k}_score AS score FROM slots WHERE {t}_candidate_{k}_id IS NOT NULL" for t in detail.TARGETS for k in (1, 2, 3))
_EVIDENCE = "SELECT c.rcno, c.target, c.rank, c.id, n.position, 'kind_' || CAST(n.position AS VARCHAR(20)) AS kind FROM cands c CROSS JOIN (SELECT 0 AS position UNION ALL SELECT 1 UNION ALL SELECT 2) n WHERE (c.id + n.position) % 3 <> 0"


@query(f"WITH slots AS ({SLOTS}), cands AS ({_LONG}), ev AS ({_EVIDENCE})," + """ c AS (SELECT c.rcno, c.target, c.rank, c.id, c.score, coalesce((SELECT string_agg(kind, ',' ORDER BY position) FROM ev WHERE ev.rcno = c.rcno AND ev.target = c.target AND ev.rank = c.rank), '') AS kinds FROM cands c)
 SELECT rcno, count(*) AS n, string_agg(target || ' ' || CAST(rank AS VARCHAR) || ' ' || CAST(id AS VARCHAR) || ' [' || kinds || ']', '; ' ORDER BY CASE target WHEN 'alcohol' THEN 1 WHEN 'distillery' THEN 2 ELSE 3 END, rank) AS listed FROM c GROUP BY 1""")
def h9_candidate_details(spark, d):
    """Candidates of every declaration with their evidence nested, in order."""
    candidates = ledger.frame(spark, d, _LONG, slots=ledger.frame(spark, d, SLOTS))
    evidence = ledger.frame(spark, d, _EVIDENCE, cands=candidates)
    out = detail.candidate_details(candidates, evidence, "rcno")
    line = F.transform("candidates", lambda c: F.concat(c["target"], F.lit(" "), c["rank"].cast("string"), F.lit(" "), c["id"].cast("string"), F.lit(" ["), F.array_join(F.transform(c["evidence"], lambda e: e["kind"]), ","), F.lit("]")))
    return out.select("rcno", F.size("candidates").cast("long").alias("n"), F.array_join(line, "; ").alias("listed"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query(f"SELECT 'alcohols' AS name, count(*) AS rows, true AS verified FROM ({ledger.ALCOHOLS}) UNION ALL SELECT 'distilleries', count(*), true FROM ({ledger.DISTILLERIES}) UNION ALL SELECT 'regions', count(*), true FROM ({ledger.REGIONS})")
def g2_mirror(spark, d):
    """The reference tables written as a new version, read back and compared; what readers then see."""
    target, names = _folder(spark, "g2"), ("alcohols", "distilleries", "regions")
    found = mirror.mirror(spark, target, dict(zip(names, ledger.references(spark, d), strict=True)))
    out = None
    for name in names:
        seen = mirror.current(spark, target, name)
        one = mirror.fingerprint(seen, seen.columns).select(F.lit(name).alias("name"), "rows", (F.col("fingerprint") == found[name][1]).alias("verified"))
        out = one if out is None else out.unionByName(one)
    return out


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(d)
    return ledger.frame(spark, d, ledger.OBSERVATIONS.replace("FROM events", "FROM arriving"), arriving=events)


@query(_OBS.rstrip(", ") + " SELECT DISTINCT rcno, semantic_text FROM obs")
def s1_stream_dedupe(spark, d):
    """Distinct contents of every key, by a stream with a watermark that spans the data."""
    folder = _folder(spark, "s1")
    out = observations.dedupe(_stream(spark, d).withColumn("observed_at", F.col("observed_at").cast("timestamp"))).select("rcno", "semantic_text")
    out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/at").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


_LATEST = "latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY rcno ORDER BY observed_at DESC, item_id DESC) rn FROM obs) WHERE rn = 1)"


@query(_OBS + _LATEST + " SELECT rcno, item_id, upper(queried_item_name) || '/' || semantic_text AS derived FROM latest")
def s3_stream_incremental(spark, d):
    """Newest state of every key with derived columns, worked out for changed keys only."""
    folder = _folder(spark, "s3")
    stream = _stream(spark, d).withColumn("semantic_sha256", F.sha2("semantic_text", 256))
    derive = lambda rows: rows.select("rcno", F.concat(F.upper("queried_item_name"), F.lit("/"), "semantic_text").alias("derived"))
    incremental.derive_changed(stream, spark, f"{folder}/state", f"{folder}/at", derive).awaitTermination()
    return incremental.current(spark, f"{folder}/state").select("rcno", "item_id", "derived")


@query("SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) - 6 AS first_day, CAST(ts + INTERVAL 9 HOUR AS DATE) AS last_day FROM events")
def a13_recent_range(spark, d):
    """The last seven days in Seoul as of every event."""
    first, last = cdc.recent_range(F.col("ts").cast("timestamp"), "Asia/Seoul")
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", first.alias("first_day"), last.alias("last_day"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id ELSE event_id % 5 END AS selected, CASE event_type WHEN 'click' THEN 'PENDING' ELSE 'NOT_REQUIRED' END AS review,
 CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = event_id % 3 AND event_id % 7 <> 1 THEN 'before' ELSE 'now' END AS linked FROM events""")
def b7_selections_and_links(spark, d):
    """Manual choices kept, review status, and times of links carried on (B7, B8, B9)."""
    e, n = spark.read.parquet(f"{d}/events.parquet"), F.col("event_id")
    old, new = F.nullif(n % 3, F.lit(0)), F.nullif(n % 4, F.lit(0))
    source = F.when(n % 7 == 1, "search").otherwise("gallery")
    return e.select(
        "event_id", cdc.merge_selection(F.when(n % 3 == 0, F.col("user_id")), n % 5).alias("selected"), cdc.review_status(F.when(F.col("event_type") == "click", "REVIEW_REQUIRED").otherwise("NORMALIZED")).alias("review"),
        cdc.carry_linked_at(old, F.lit("gallery"), new, source, F.lit("before"), F.lit("now")).alias("linked"),
    )


@query(_OBS + """s AS (SELECT rcno, max(item_id) AS item_id, CASE WHEN rcno % 3 <> 0 THEN 'NORMALIZED' END AS normalization_status, CASE rcno % 4 WHEN 0 THEN NULL WHEN 1 THEN 'v4' ELSE 'v3' END AS matching_version FROM obs GROUP BY rcno)
 SELECT rcno, item_id, CASE WHEN rcno % 5 = 0 THEN repeat('x', 4096) END AS last_error FROM s WHERE normalization_status IS NOT NULL AND coalesce(matching_version, '') <> 'v4'""")
def b12_match_work(spark, d):
    """Keys that the current matching rules have not seen, with the errors of those that failed (B12, B13)."""
    s = ledger.observations(spark, d).groupBy("rcno").agg(F.max("item_id").alias("item_id"))
    s = s.withColumns({
        "normalization_status": F.when(F.col("rcno") % 3 != 0, "NORMALIZED"), "matching_version": F.when(F.col("rcno") % 4 == 1, "v4").when(F.col("rcno") % 4 != 0, "v3"),
        "last_error": F.lit(None).cast("string"), "next_at": F.lit(None).cast("timestamp"),
    })
    failed = s.where("rcno % 5 = 0").select("rcno", F.repeat(F.lit("x"), 5000).alias("error"), F.current_timestamp().alias("next_at"))
    return quality.mark_failed(quality.select_match_work(s, "v4", s.count()), failed).select("rcno", "item_id", "last_error")
