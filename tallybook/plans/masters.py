"""Registered queries on reference tables, registry details, links, claims and task reasons, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import cdc, importers, masters, reconcile
from tallybook.plans import registry
from tallybook.sources import ledger

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Reference tables as text, with gaps.
RAW_ALCOHOLS = """SELECT CAST(p_partkey AS INTEGER) AS id, CASE WHEN p_partkey % 4 = 0 THEN '술 ' || CAST(p_size AS VARCHAR(20)) ELSE '' END AS kor_name, p_name AS eng_name,
  CASE p_partkey % 9 WHEN 0 THEN CAST(p_size AS VARCHAR(20)) || '%' WHEN 1 THEN ' ' || CAST(p_size AS VARCHAR(20)) || '.5% ' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'unknown' WHEN 5 THEN CAST(p_size AS VARCHAR(20)) || ' %'
    WHEN 6 THEN '.' || CAST(p_size AS VARCHAR(20)) || 'e2' WHEN 7 THEN CAST(p_size AS VARCHAR(20)) || '%%' ELSE CAST(p_size AS VARCHAR(20)) || '.' END AS abv,
  p_type AS type, CASE WHEN p_partkey % 3 = 0 THEN '위스키' END AS kor_category, CASE WHEN p_partkey % 5 <> 0 THEN 'Whisky' WHEN p_partkey % 2 = 0 THEN '' END AS eng_category, CASE WHEN p_partkey % 7 < 5 THEN p_brand END AS category_group,
  CASE WHEN p_partkey % 6 <> 1 THEN CAST(p_size AS INTEGER) END AS region_id, CASE WHEN p_partkey % 8 <> 2 THEN CAST(substring(p_brand, 7) AS INTEGER) END AS distillery_id,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR(20)) END AS age, CAST(NULL AS VARCHAR(20)) AS cask, CASE WHEN p_partkey % 3 = 1 THEN '70cl' END AS volume,
  CASE WHEN p_partkey % 50 = 9 THEN DATE '2026-01-05' END AS deleted_at
FROM part"""
RAW_REGIONS = """SELECT CAST(c_custkey AS INTEGER) AS id, CAST(NULL AS VARCHAR(20)) AS kor_name, c_name AS eng_name, CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey - c_custkey % 10 AS INTEGER) END AS parent_id FROM customer"""
_LOADED = """a AS (SELECT CAST(id AS BIGINT) id, kor_name, eng_name, coalesce(abv, '') abv,
  CASE WHEN t = '' THEN 0.0 WHEN regexp_full_match(t, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(t AS DOUBLE) END::DOUBLE abv_percent, type,
  concat_ws('|', kor_category, eng_category, category_group) category, CAST(coalesce(region_id, 0) AS BIGINT) region_id, CAST(coalesce(distillery_id, 0) AS BIGINT) distillery_id,
  coalesce(age, '') age, coalesce(cask, '') cask, coalesce(volume, '') volume, deleted_at
  FROM (SELECT *, CASE WHEN ends_with(trim(coalesce(abv, '')), '%') THEN left(trim(abv), length(trim(abv)) - 1) ELSE trim(coalesce(abv, '')) END t FROM raw))"""


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _digest(kind: str, table: str) -> str:
    """SQL of one row of a version: sums of two 60-bit parts of each row's SHA-256."""
    line = "concat_ws(chr(31), " + ", ".join(f"CASE WHEN {c} IS NULL THEN 'null' ELSE 'v:' || CAST({c} AS VARCHAR) END" for c in masters.COVERED[kind]) + ")"
    part = lambda at: f"CAST(coalesce(sum(CAST('0x' || substring(h, {at}, 15) AS HUGEINT)), 0) AS VARCHAR)"
    return f"SELECT '{kind}' kind, count(*) AS rows, {part(1)} || ':' || {part(16)} fingerprint FROM (SELECT sha256({line}) h FROM {table})"


@query(f"WITH raw AS ({RAW_ALCOHOLS}), {_LOADED} SELECT * FROM a")
def a14_reference_alcohols(spark, d):
    return masters.load_alcohols(ledger.frame(spark, d, RAW_ALCOHOLS))


@query(f"WITH raw AS ({RAW_REGIONS}) SELECT CAST(id AS BIGINT) id, kor_name, eng_name, CAST(coalesce(parent_id, 0) AS BIGINT) parent_id FROM raw")
def a14_reference_regions(spark, d):
    return masters.load_regions(ledger.frame(spark, d, RAW_REGIONS))


@query(f"""WITH raw AS ({RAW_ALCOHOLS}), {_LOADED}, m AS ({ledger.DISTILLERIES}), r AS (SELECT id, kor_name, eng_name, coalesce(parent_id, 0) parent_id FROM ({RAW_REGIONS}))
 {_digest("a", "a")} UNION ALL {_digest("d", "m")} UNION ALL {_digest("r", "r")}""")
def a14_reference_version(spark, d):
    return masters.reference_version(
        masters.load_alcohols(ledger.frame(spark, d, RAW_ALCOHOLS)), masters.load_distilleries(ledger.frame(spark, d, ledger.DISTILLERIES)), masters.load_regions(ledger.frame(spark, d, RAW_REGIONS))
    )


#: What the registry lists, and its answers on request: pages that agree, pages of somebody else, two kinds of redirects, errors, silence.
LISTED = """SELECT lpad(CAST(c_custkey AS VARCHAR(20)), 10, '0') AS code, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'L' || CAST(c_custkey AS VARCHAR(20)) END AS license_number, ' ' || c_name AS business_name,
  c_mktsegment AS representative, CASE WHEN c_custkey % 2 = 0 THEN 'institution' END AS institution, 'street ' || CAST(c_nationkey AS VARCHAR(20)) AS address, 'import' AS industry FROM customer"""
ANSWERS = """SELECT lpad(CAST(c_custkey AS VARCHAR(20)), 10, '0') AS asked_code, CASE c_custkey % 11 WHEN 3 THEN 302 WHEN 4 THEN 302 WHEN 5 THEN 302 WHEN 6 THEN 500 ELSE 200 END AS http_status,
  CASE c_custkey % 11 WHEN 3 THEN 'https://registry.example/error/noAuth?x=1' WHEN 4 THEN '/error/error' WHEN 5 THEN 'https://registry.example/login?to=/error/error' END AS location,
  lpad(CAST(c_custkey + CASE WHEN c_custkey % 11 = 7 THEN 1 ELSE 0 END AS VARCHAR(20)), 10, '0') || ' ' AS code, CASE WHEN c_custkey % 11 = 8 THEN '0' ELSE 'L' || CAST(c_custkey AS VARCHAR(20)) END AS license_number,
  c_name || CASE WHEN c_custkey % 11 = 9 THEN ' 2' ELSE '' END AS business_name, 'head ' || c_mktsegment AS representative, 'office' AS institution, 'street ' || CAST(c_nationkey AS VARCHAR(20)) AS address, 'import' AS industry,
  '02-' || CAST(c_custkey AS VARCHAR(20)) AS phone, '2020-01-02' AS permit_date, CASE WHEN c_custkey % 2 = 0 THEN 'OPEN' ELSE 'CLOSED' END AS operating_status
FROM customer WHERE c_custkey % 11 <> 10"""


@query(f"""WITH l AS ({LISTED}), p AS ({ANSWERS}), j AS (SELECT l.*, p.asked_code, p.representative p_rep, p.institution p_inst, p.license_number p_lic, p.phone, p.permit_date, p.operating_status, CAST(l.code AS BIGINT) % 11 k FROM l LEFT JOIN p ON l.code = p.asked_code),
 o AS (SELECT *, CASE WHEN k IN (3, 4) THEN 'UNAVAILABLE' WHEN k IN (5, 6, 10) THEN 'FAILED' WHEN k IN (7, 9) OR k = 8 AND license_number <> '' THEN 'MISMATCH' ELSE 'VERIFIED' END outcome FROM j)
 SELECT code, CASE outcome WHEN 'VERIFIED' THEN p_lic WHEN 'UNAVAILABLE' THEN license_number END license_number, CASE outcome WHEN 'VERIFIED' THEN ltrim(business_name) WHEN 'UNAVAILABLE' THEN business_name END business_name,
 CASE outcome WHEN 'VERIFIED' THEN p_rep WHEN 'UNAVAILABLE' THEN representative END representative, CASE outcome WHEN 'VERIFIED' THEN p_inst WHEN 'UNAVAILABLE' THEN institution END institution,
 CASE WHEN outcome IN ('VERIFIED', 'UNAVAILABLE') THEN address END address, CASE WHEN outcome IN ('VERIFIED', 'UNAVAILABLE') THEN industry END industry, CASE WHEN outcome = 'VERIFIED' THEN phone END phone,
 CASE WHEN outcome = 'VERIFIED' THEN permit_date END permit_date, CASE outcome WHEN 'VERIFIED' THEN operating_status WHEN 'UNAVAILABLE' THEN 'UNKNOWN' END operating_status, outcome FROM o""")
def f7_verify_detail(spark, d):
    return importers.verify_detail(ledger.frame(spark, d, LISTED), ledger.frame(spark, d, ANSWERS))


#: Items of five jobs that name their importer, declarations over half of them, links under present and former names.
JOB_ITEMS = """SELECT event_id AS item_id, user_id AS rcno, event_id % 5 AS job_id, ts AS observed_at, CAST(ts AS DATE) AS processed_date,
  CASE event_id % 13 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE ' Importer ' || CAST(user_id % 40 AS VARCHAR(20)) || CASE WHEN event_id % 17 = 0 THEN ' b' ELSE ' ' END END AS importer_name FROM events"""
JOB_DECLS = "SELECT user_id AS rcno, max(event_id) AS source_item_id, CASE WHEN user_id % 6 = 0 THEN user_id % 40 END AS importer_id FROM events WHERE event_id % 3 = 1 GROUP BY user_id"
JOB_LINKS = "SELECT DISTINCT user_id AS rcno, 'Importer ' || CAST(user_id % 40 AS VARCHAR(20)) AS source_importer_name FROM events WHERE user_id % 4 = 0"


@query(f"""WITH i AS (SELECT *, trim(importer_name) business_name FROM ({JOB_ITEMS})), dd AS ({JOB_DECLS}), ln AS ({JOB_LINKS}),
 cur AS (SELECT rcno, business_name, processed_date FROM i WHERE job_id = 2 AND nullif(business_name, '') IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rcno ORDER BY observed_at DESC, item_id DESC) = 1)
 SELECT business_name, processed_date process_date, rcno FROM cur WHERE NOT EXISTS (SELECT 1 FROM ln WHERE ln.rcno = cur.rcno AND ln.source_importer_name = cur.business_name)
 UNION ALL SELECT i.business_name, i.processed_date, dd.rcno FROM dd JOIN i ON i.item_id = dd.source_item_id WHERE dd.importer_id IS NULL AND nullif(i.business_name, '') IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM ln WHERE ln.rcno = dd.rcno AND ln.source_importer_name = i.business_name) AND dd.rcno NOT IN (SELECT rcno FROM cur)""")
def f1_job_pending(spark, d):
    """The job with number 2 is the query's parameter; all items are read."""
    return importers.job_pending(ledger.frame(spark, d, JOB_ITEMS), ledger.frame(spark, d, JOB_DECLS), ledger.frame(spark, d, JOB_LINKS), 2)


_ENTRY = """'owner ' || CAST(s_nationkey AS VARCHAR(20)) AS representative, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'street ' || CAST(s_nationkey AS VARCHAR(20)) END AS address"""
STORED = f"""SELECT lpad(CAST(s_suppkey AS VARCHAR(20)), 10, '0') AS code, s_name AS business_name, sha2(s_name, 256) AS name_key, {_ENTRY}, 'OPEN' AS operating_status, TIMESTAMP '2026-05-01 00:00:00' AS observed_at FROM supplier WHERE s_suppkey % 5 < 4"""
BATCH = f"""SELECT lpad(CAST(s_suppkey AS VARCHAR(20)), 10, '0') AS code, ' ' || s_name || CASE WHEN n = 1 THEN ' Ltd ' ELSE '' END AS business_name, {_ENTRY}, CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'CLOSED' END AS operating_status,
  CASE WHEN (s_suppkey + n) % 2 = 0 THEN TIMESTAMP '2026-04-02 00:00:00' ELSE TIMESTAMP '2026-04-01 00:00:00' END AS observed_at FROM supplier CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2) twice WHERE s_suppkey % 5 > 1"""


@query(f"""WITH s AS ({STORED.replace("sha2(s_name, 256)", "sha256(s_name)")}), b AS (FROM ({BATCH}) QUALIFY row_number() OVER (PARTITION BY code ORDER BY observed_at DESC) = 1)
 SELECT * FROM s WHERE code NOT IN (SELECT code FROM b) UNION ALL
 SELECT code, trim(business_name), sha256(trim(business_name)), representative, nullif(address, ''), CASE WHEN operating_status = '' THEN 'UNKNOWN' ELSE operating_status END, observed_at FROM b""")
def f8_upsert_registry(spark, d):
    return importers.upsert_registry(ledger.frame(spark, d, STORED), ledger.frame(spark, d, BATCH))


LINKS = "SELECT o_orderkey AS rcno, CAST(o_custkey AS VARCHAR(20)) AS code, CAST(o_orderdate AS DATE) AS source_observed_at, 'PAGE_NAME' AS link_source FROM orders WHERE o_orderkey % 3 < 2"
NEW_LINKS = "SELECT o_orderkey AS rcno, CAST(o_custkey + n AS VARCHAR(20)) AS code, CAST(o_orderdate AS DATE) - n AS source_observed_at, 'PAGE_RCNO' AS link_source FROM orders CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2) twice WHERE o_orderkey % 3 > 0"


@query(f"""WITH s AS ({LINKS}), b AS (FROM ({NEW_LINKS}) QUALIFY row_number() OVER (PARTITION BY rcno ORDER BY source_observed_at DESC, code DESC) = 1)
 SELECT * FROM s WHERE rcno NOT IN (SELECT rcno FROM b) UNION ALL SELECT * FROM b""")
def f9_upsert_links(spark, d):
    return importers.upsert_links(ledger.frame(spark, d, LINKS), ledger.frame(spark, d, NEW_LINKS))


#: States with claims, reviews and links, all from the key and its source.
CLAIMED = """SELECT rcno, source_item_id, semantic_sha256, CASE rcno % 6 WHEN 0 THEN 'NORMALIZED' WHEN 1 THEN 'STALE' WHEN 2 THEN 'PARTIAL' WHEN 3 THEN 'UNPARSED' ELSE 'PENDING' END AS status,
  CASE WHEN rcno % 5 = 0 THEN 'worker' END AS claim_owner, CASE WHEN rcno % 5 = 0 AND rcno % 7 > 0 THEN CASE WHEN rcno % 2 = 0 THEN TIMESTAMP '2020-01-01 00:00:00' ELSE TIMESTAMP '2099-01-01 00:00:00' END END AS claim_lease_until,
  CAST(rcno % 4 AS INTEGER) AS claim_attempts, CASE WHEN rcno % 8 = 1 THEN TIMESTAMP '2099-01-01 00:00:00' END AS claim_next_attempt_at, 'PENDING' AS review_status, CASE WHEN rcno % 3 = 0 THEN rcno END AS importer_id
FROM state"""


def _claimed(spark, d):
    return ledger.frame(spark, d, CLAIMED, state=registry._state(spark, d))


_STATES = registry._OBS + registry._LATEST + ", " + registry._STATE + f", s AS ({CLAIMED})"


@query(_STATES + """, j AS (SELECT coalesce(s.rcno, l.rcno) rcno, l.item_id, sha256(l.semantic_text) sha, l.rcno IS NOT NULL seen, s.rcno IS NULL fresh, s.* EXCLUDE rcno FROM s FULL JOIN latest l ON s.rcno = l.rcno),
 k AS (SELECT *, fresh OR (seen AND sha IS DISTINCT FROM semantic_sha256) changed FROM j)
 SELECT rcno, coalesce(item_id, source_item_id) source_item_id, CASE WHEN fresh THEN 'PENDING' WHEN changed THEN 'STALE' ELSE status END status, CASE WHEN NOT changed THEN claim_owner END claim_owner,
 CASE WHEN NOT changed THEN claim_lease_until END claim_lease_until, CASE WHEN changed THEN 0 ELSE claim_attempts END claim_attempts, CASE WHEN NOT changed THEN claim_next_attempt_at END claim_next_attempt_at,
 CASE WHEN changed THEN 'NOT_REQUIRED' ELSE review_status END review_status, CASE WHEN NOT changed THEN importer_id END importer_id FROM k""")
def b2_sync_claimed(spark, d):
    return cdc.sync_declarations(_claimed(spark, d), registry._next(spark, d)).drop("semantic_sha256", "changed")


@query(_STATES + """ SELECT rcno, CASE WHEN t THEN 'STALE' ELSE status END status, CASE WHEN NOT t THEN claim_owner END claim_owner, CASE WHEN NOT t THEN claim_lease_until END claim_lease_until, CASE WHEN t THEN 0 ELSE claim_attempts END claim_attempts,
 CASE WHEN NOT t THEN claim_next_attempt_at END claim_next_attempt_at, review_status, importer_id FROM (SELECT *, rcno % 6 IN (0, 2, 3) t FROM s)""")
def b3_requeue_claimed(spark, d):
    return cdc.force_requeue(_claimed(spark, d)).drop("source_item_id", "semantic_sha256")


@query(_STATES + """ SELECT l.rcno, l.item_id source_item_id, l.processed_date, s.status, coalesce(s.claim_attempts, 0) claim_attempts FROM latest l LEFT JOIN s USING (rcno)
 WHERE (s.claim_owner IS NULL OR s.claim_lease_until < TIMESTAMP '2026-06-01 00:00:00') AND (s.rcno IS NULL OR (s.status IN ('PENDING', 'STALE') AND coalesce(s.claim_next_attempt_at <= TIMESTAMP '2026-06-01 00:00:00', true) AND s.claim_attempts < 3))
 ORDER BY l.processed_date DESC, l.item_id DESC LIMIT 200""")
def b4_due_work(spark, d):
    """The limit is the feature: the next 200 declarations to work on."""
    work = cdc.due_work(registry._next(spark, d).drop("semantic_sha256"), _claimed(spark, d), F.lit("2026-06-01 00:00:00").cast("timestamp"), 3, 200)
    return work.select("rcno", "source_item_id", "processed_date", "status", "claim_attempts")


@query(registry._OBS + registry._LATEST + ", " + registry._STATE + " SELECT l.rcno, l.item_id source_item_id FROM latest l LEFT JOIN state s ON s.rcno = l.rcno AND s.source_item_id = l.item_id WHERE s.rcno IS NULL")
def b6_rejected_results(spark, d):
    return cdc.rejected_results(registry._state(spark, d), registry._next(spark, d).select("rcno", "source_item_id"), "rcno", ["source_item_id"])


#: Items that every task must hold, in order.
TARGETS = [("R", "returned"), ("N", "none"), ("A", "accepted")]


@query(registry._RECON + registry._PREV + """, t AS (SELECT * FROM (VALUES (0, 'R', 'returned'), (1, 'N', 'none'), (2, 'A', 'accepted')) v(place, item_code, item_name)), tasks AS (SELECT DISTINCT task_id, attempt FROM recon),
 w AS (SELECT tasks.*, t.*, p.reason why, coalesce(p.valid, false) ok, p.pages, p.pa, p.total, p.key_sha FROM tasks CROSS JOIN t LEFT JOIN prev p USING (task_id, attempt, item_code)),
 f AS (SELECT w.*, CASE WHEN NOT ok THEN 'RECONCILIATION_FAILED' WHEN w.pages > 1 AND pa IS NULL THEN 'VERIFICATION_REQUIRED' WHEN w.pages > 1 AND (q.total <> w.total OR q.key_sha <> w.key_sha) THEN 'SET_CHANGED' END verdict
  FROM w LEFT JOIN recon q ON q.task_id = w.task_id AND q.item_code = w.item_code AND q.attempt = w.pa),
 g AS (SELECT * FROM f WHERE verdict IS NOT NULL QUALIFY row_number() OVER (PARTITION BY task_id, attempt ORDER BY ok, place) = 1),
 m AS (SELECT g.task_id, g.attempt, count(*) missing FROM g JOIN syn_keys a ON a.task_id = g.task_id AND a.item_code = g.item_code AND a.attempt = g.pa ANTI JOIN syn_keys b ON b.task_id = g.task_id AND b.item_code = g.item_code AND b.attempt = g.attempt AND b.rcno = a.rcno
  WHERE g.verdict = 'SET_CHANGED' GROUP BY ALL),
 u AS (SELECT g.task_id, g.attempt, count(*) unexpected FROM g JOIN syn_keys a ON a.task_id = g.task_id AND a.item_code = g.item_code AND a.attempt = g.attempt ANTI JOIN syn_keys b ON b.task_id = g.task_id AND b.item_code = g.item_code AND b.attempt = g.pa AND b.rcno = a.rcno
  WHERE g.verdict = 'SET_CHANGED' GROUP BY ALL)
 SELECT tasks.task_id, tasks.attempt, coalesce(verdict, 'COMPLETE') verdict, item_code, item_name, CASE WHEN NOT ok THEN coalesce(why, 'not_collected') END reason,
 CASE WHEN verdict = 'SET_CHANGED' THEN coalesce(missing, 0) END missing, CASE WHEN verdict = 'SET_CHANGED' THEN coalesce(unexpected, 0) END unexpected
 FROM tasks LEFT JOIN g USING (task_id, attempt) LEFT JOIN m USING (task_id, attempt) LEFT JOIN u USING (task_id, attempt)""")
def c5_task_reasons(spark, d):
    return reconcile.judge_tasks(registry._recon(spark, d), ledger.keys(spark, d), TARGETS)
