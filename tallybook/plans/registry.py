"""Registered queries over whole tables, and the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.text import percent, tokens
from tallybook.operators import cdc, importers, normalize, quality, reconcile, report
from tallybook.plans import rules
from tallybook.sources import ledger

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_OBS = f"WITH obs AS ({ledger.OBSERVATIONS}), "
_LATEST = "latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY rcno ORDER BY observed_at DESC, item_id DESC) rn FROM obs) WHERE rn = 1)"
_ITEMS = f"WITH items AS ({ledger.ITEMS}) "
_RECON = f"""WITH syn_keys AS ({ledger.KEYS}), syn_pages AS ({ledger.PAGES}),
p AS (SELECT task_id, attempt, item_code, count(*) pages, min(page_no) a, max(page_no) b, count(DISTINCT page_no) nos, min(total) total, max(total) mt, sum(parsed_rows) parsed FROM syn_pages GROUP BY ALL),
k AS (SELECT task_id, attempt, item_code, count(*) stored, count(DISTINCT rcno) uk, sha256(string_agg(r, chr(10) ORDER BY r)) sha FROM (SELECT *, CAST(rcno AS VARCHAR) r FROM syn_keys) GROUP BY ALL),
recon AS (SELECT p.task_id, p.attempt, p.item_code, total, pages, coalesce(uk, 0) unique_keys, sha key_sha,
 CASE WHEN total <> mt THEN 'total_differs' WHEN a <> 1 OR b <> nos OR pages <> nos THEN 'pages_not_contiguous' WHEN pages <> greatest(1, ceil(total / 2.0)) THEN 'page_count'
 WHEN parsed <> total THEN 'parsed_rows' WHEN coalesce(stored, 0) <> parsed THEN 'stored_rows' WHEN coalesce(uk, 0) <> total THEN 'unique_keys' END reason FROM p LEFT JOIN k USING (task_id, attempt, item_code)) """


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return cdc.latest_by_key(ledger.observations(spark, d), "rcno", "observed_at", "item_id")


def _state(spark: SparkSession, d: str) -> DataFrame:
    """State as of the first half of the observations, every fourth key done."""
    obs = ledger.observations(spark, d).where("item_id % 2 = 0")
    done = F.when(F.col("rcno") % 4 == 0, "NORMALIZED").when(F.col("rcno") % 4 == 1, "STALE").otherwise("PENDING")
    return cdc.latest_by_key(obs, "rcno", "observed_at", "item_id").select("rcno", F.col("item_id").alias("source_item_id"), F.sha2("semantic_text", 256).alias("semantic_sha256"), done.alias("status"))


_STATE = """state AS (SELECT rcno, item_id source_item_id, sha256(semantic_text) semantic_sha256, CASE rcno % 4 WHEN 0 THEN 'NORMALIZED' WHEN 1 THEN 'STALE' ELSE 'PENDING' END status
 FROM (SELECT *, row_number() OVER (PARTITION BY rcno ORDER BY observed_at DESC, item_id DESC) rn FROM obs WHERE item_id % 2 = 0) WHERE rn = 1)"""


@query(_OBS + _LATEST + " SELECT rcno, item_id, processed_date, semantic_text FROM latest")
def b1_latest_by_key(spark, d):
    return _latest(spark, d).select("rcno", "item_id", "processed_date", "semantic_text")


def _next(spark, d):
    return _latest(spark, d).select("rcno", F.col("item_id").alias("source_item_id"), F.sha2("semantic_text", 256).alias("semantic_sha256"), "processed_date")


@query(_OBS + _LATEST + ", " + _STATE + """ SELECT coalesce(s.rcno, l.rcno) rcno, coalesce(l.item_id, s.source_item_id) source_item_id, coalesce(sha256(l.semantic_text), s.semantic_sha256) semantic_sha256,
 CASE WHEN s.rcno IS NULL THEN 'PENDING' WHEN l.rcno IS NULL OR s.semantic_sha256 = sha256(l.semantic_text) THEN s.status ELSE 'STALE' END status,
 s.rcno IS NULL OR (l.rcno IS NOT NULL AND s.semantic_sha256 <> sha256(l.semantic_text)) changed FROM state s FULL JOIN latest l ON s.rcno = l.rcno""")
def b2_sync_declarations(spark, d):
    return cdc.sync_declarations(_state(spark, d), _next(spark, d))


@query(_OBS + _STATE + " SELECT rcno, CASE WHEN status = 'NORMALIZED' THEN 'STALE' ELSE status END status FROM state")
def b3_force_requeue(spark, d):
    return cdc.force_requeue(_state(spark, d)).select("rcno", "status")


@query(_OBS + _LATEST + ", " + _STATE + """ SELECT l.rcno, l.item_id source_item_id, l.processed_date, s.status FROM latest l LEFT JOIN state s USING (rcno)
 WHERE s.status IS NULL OR s.status IN ('PENDING', 'STALE') ORDER BY l.processed_date DESC, l.item_id DESC LIMIT 100""")
def b4_select_work(spark, d):
    return cdc.select_work(_next(spark, d).drop("semantic_sha256"), _state(spark, d), 100).select("rcno", "source_item_id", "processed_date", "status")


@query(_OBS + _STATE + """ SELECT (SELECT count(DISTINCT rcno) FROM obs WHERE rcno NOT IN (SELECT rcno FROM state)) missing,
 (SELECT count(*) FROM state WHERE status = 'PENDING') pending, (SELECT count(*) FROM state WHERE status = 'STALE') stale""")
def b5_remaining(spark, d):
    return cdc.remaining(ledger.observations(spark, d), _state(spark, d))


@query(_OBS + _LATEST + ", " + _STATE + """ SELECT s.rcno, CASE WHEN l.item_id = s.source_item_id THEN 'PARTIAL' ELSE s.status END status, coalesce(l.item_id = s.source_item_id, false) applied
 FROM state s LEFT JOIN latest l USING (rcno)""")
def b6_apply_results(spark, d):
    results = _next(spark, d).select("rcno", "source_item_id", F.lit("PARTIAL").alias("status"))
    return cdc.apply_results(_state(spark, d), results, "rcno", ["source_item_id"], ["status"]).select("rcno", "status", "applied")


@query(_OBS + _STATE + " SELECT s.rcno, s.source_item_id, o.processed_date source_processed_date, o.queried_item_name source_queried_item_name FROM state s JOIN obs o ON s.source_item_id = o.item_id")
def b10_declaration_details(spark, d):
    state = _state(spark, d).withColumnRenamed("source_item_id", "source_item_id_ref")
    out = cdc.declaration_details(state.drop("semantic_sha256"), ledger.observations(spark, d))
    return out.select("rcno", F.col("source_item_id_ref").alias("source_item_id"), "source_processed_date", "source_queried_item_name")


@query(_OBS + _STATE + " SELECT s.rcno, s.source_item_id FROM state s LEFT JOIN (SELECT * FROM obs WHERE attempt_no = 1 AND rcno % 3 = 0) o ON s.source_item_id = o.item_id WHERE s.rcno IS DISTINCT FROM o.rcno")
def b11_orphans(spark, d):
    kept = ledger.observations(spark, d).where("attempt_no = 1 and rcno % 3 = 0")
    return cdc.orphans(_state(spark, d), kept).select("rcno", "source_item_id")


@query("""SELECT event_id, CAST(unnest(generate_series(CAST(ts AS DATE), CAST(ts AS DATE) + CAST(event_id % 7 AS INTEGER), INTERVAL 1 DAY)) AS DATE) task_date, CAST(event_id % 7 + 1 AS BIGINT) total FROM events""")
def a12_expand_dates(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.to_date("ts").alias("first"), F.expr("date_add(to_date(ts), cast(event_id % 7 as int))").alias("last"))
    return cdc.expand_dates(events, "first", "last").select("event_id", "task_date", "total")


@query(_OBS + "old AS (SELECT * FROM obs WHERE item_id % 3 = 0) SELECT DISTINCT rcno, semantic_text FROM obs o WHERE item_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM old WHERE old.rcno = o.rcno AND old.semantic_text = o.semantic_text)")
def a11_append_new(spark, d):
    obs = ledger.observations(spark, d)
    keys = ["rcno", "semantic_text"]
    return cdc.append_new(obs.where("item_id % 3 = 0"), obs.where("item_id % 3 <> 0"), keys).select(*keys)


def _recon(spark, d):
    return reconcile.reconcile_items(ledger.pages(spark, d), ledger.keys(spark, d), 2)


@query(_RECON + "SELECT *, reason IS NULL AS valid FROM recon")
def c1_reconcile_items(spark, d):
    return _recon(spark, d)


_PREV = """, prev AS (SELECT r.*, r.reason IS NULL valid, last_value(CASE WHEN r.reason IS NULL THEN attempt END IGNORE NULLS) OVER w pa FROM recon r
 WINDOW w AS (PARTITION BY task_id, item_code ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) """


@query(_RECON + _PREV + "SELECT task_id, attempt, item_code, valid, pa prev_attempt FROM prev")
def c3_previous_valid(spark, d):
    return reconcile.previous_valid(_recon(spark, d)).select("task_id", "attempt", "item_code", "valid", "prev_attempt")


@query(f"""WITH syn_keys AS ({ledger.KEYS}), a AS (SELECT DISTINCT task_id, item_code, rcno FROM syn_keys WHERE attempt = 1), b AS (SELECT DISTINCT task_id, item_code, rcno FROM syn_keys WHERE attempt = 2)
 SELECT *, 'missing' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'unexpected' FROM (FROM b EXCEPT FROM a)""")
def c4_key_diff(spark, d):
    return reconcile.key_diff(ledger.keys(spark, d), 1, 2)


@query(_RECON + _PREV + """SELECT p.task_id, p.attempt, CASE WHEN bool_or(NOT p.valid) THEN 'RECONCILIATION_FAILED' WHEN bool_or(p.pages > 1 AND p.pa IS NULL) THEN 'VERIFICATION_REQUIRED'
 WHEN bool_or(p.pages > 1 AND (q.total <> p.total OR q.key_sha <> p.key_sha)) THEN 'SET_CHANGED' ELSE 'COMPLETE' END verdict
 FROM prev p LEFT JOIN recon q ON q.task_id = p.task_id AND q.item_code = p.item_code AND q.attempt = p.pa GROUP BY p.task_id, p.attempt""")
def c5_reconcile_tasks(spark, d):
    return reconcile.reconcile_tasks(_recon(spark, d))


def _normalized(spark, d, *columns):
    return normalize.normalize(ledger.items(spark, d), *columns)


def _fields(columns: str) -> str:
    return rules.FIELDS + f" SELECT item_id, {columns} FROM r"


def _named(columns: str) -> str:
    return rules.NAMES + f" SELECT {columns} FROM d"


@query(_fields("unit_volume_ml, package_count"))
def d1_volume(spark, d):
    return _normalized(spark, d, "unit_volume_ml", "package_count").select("item_id", "unit_volume_ml", "package_count")


@query(_fields("age_years, proof"))
def d8_age_proof(spark, d):
    return _normalized(spark, d, "age_years", "proof").select("item_id", "age_years", "proof")


@query(_fields("batch_number, strength_type, version_marker"))
def d14_batch_strength_version(spark, d):
    return _normalized(spark, d, "batch_number", "strength_type", "version_marker").select("item_id", "batch_number", "strength_type", "version_marker")


@query(_fields("expiry_first, expiry_last"))
def d17_expiry(spark, d):
    return _normalized(spark, d, "expiry_first", "expiry_last").select("item_id", "expiry_first", "expiry_last")


@query(_fields("importer_base, legal_form, category_en"))
def d18_company_category(spark, d):
    return _normalized(spark, d, "importer_base", "legal_form", "category_en").select("item_id", "importer_base", "legal_form", "category_en")


@query(_named("item_id, normalization_status"))
def d29_status(spark, d):
    return _normalized(spark, d, "normalization_status").select("item_id", "normalization_status")


_OPEN = "normalization_status IN ('REVIEW_REQUIRED', 'PARTIAL', 'UNPARSED')"


@query(_named(f"""count(*) total, count(*) FILTER ({_OPEN}) review, round(count(*) FILTER ({_OPEN}) * 100.0 / count(*), 2) review_pct,
 count(item_id) preserved, round(count(item_id) * 100.0 / count(*), 2) preserved_pct, coalesce(strftime(max(processed_date), '%Y-%m-%d'), '') latest"""))
def h1_overview(spark, d):
    return report.overview(_normalized(spark, d, "normalization_status").withColumn("source_item_id", F.col("item_id")))


@query(rules.NAMES + " SELECT normalization_status, count(*) n FROM d GROUP BY 1")
def h2_status_counts(spark, d):
    return report.counts_by(_normalized(spark, d, "normalization_status"), "normalization_status")


_COVERAGE = (
    ("normalized_name", "coalesce(display_ko, display_en, '') <> ''"), ("volume", "ml IS NOT NULL"), ("abv", "abv IS NOT NULL"), ("ingredient_percent", "ingredient_raw IS NOT NULL"), ("variant_marker", "variant_marker_raw IS NOT NULL"),
    ("age", "age_years IS NOT NULL"), ("vintage", "vintage_year IS NOT NULL"), ("importer", "coalesce(importer_base, '') <> ''"),
)


@query(rules.NAMES + ", " + "c AS (" + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({x}) AS populated, count(*) AS total FROM d" for f, x in _COVERAGE) + ") SELECT *, round(populated * 100.0 / total, 2) AS pct FROM c")
def h3_field_coverage(spark, d):
    used = ("display_name_ko", "display_name_en", "unit_volume_ml", "abv_percent", "ingredient_raw", "variant_marker_raw", "age_years", "vintage_year", "importer_base")
    return report.field_coverage(_normalized(spark, d, *used))


@query(_OBS.rstrip(", ") + " SELECT strftime(processed_date, '%Y-%m') AS month, count(*) n FROM obs GROUP BY 1")
def h15_monthly(spark, d):
    return report.monthly(ledger.observations(spark, d), "processed_date")


@query(_ITEMS + "SELECT item_name AS value, count(*) n FROM items GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def h16_item_distribution(spark, d):
    return report.top_counts(ledger.items(spark, d), "item_name")


@query(rules.NAMES + """ SELECT coalesce(min(nullif(display_ko, '')), min(nullif(base_ko, '')), '이름 미정') AS name, coalesce(unit_volume_ml, 0) AS unit_volume_ml, count(*) n, count(DISTINCT coalesce(importer_base, importer_name)) importers, sku_key
 FROM d WHERE sku_key IS NOT NULL GROUP BY sku_key, d.unit_volume_ml HAVING count(*) > 1 ORDER BY n DESC, name, sku_key LIMIT 20""")
def h17_sku_groups(spark, d):
    return report.sku_groups(_normalized(spark, d, "sku_key", "unit_volume_ml", "importer_base", "display_name_ko", "base_name_ko"))


@query(rules.NAMES + """ SELECT reason, count(*) n FROM (SELECT unnest(string_split(reasons, ',')) reason FROM d WHERE normalization_status IN ('REVIEW_REQUIRED', 'PARTIAL', 'UNPARSED') AND reasons <> '') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def h18_review_reasons(spark, d):
    return report.review_reasons(_normalized(spark, d, "normalization_status", "review_reasons"))


@query(_OBS.rstrip(", ") + """, k AS (SELECT rcno FROM obs GROUP BY rcno HAVING count(*) > 1)
 SELECT coalesce(queried_item_name, '미분류') queried_item_name, count(DISTINCT rcno) keys, count(*) AS rows FROM obs JOIN k USING (rcno) GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 20""")
def h20_duplicate_observations(spark, d):
    return report.duplicate_observations(ledger.observations(spark, d))


@query(_OBS.rstrip(", ") + " SELECT queried_item_name, count(*) n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) pct FROM obs GROUP BY 1")
def q2_share(spark, d):
    obs = ledger.observations(spark, d)
    total = obs.agg(F.count("*").alias("total"))  # one row
    return obs.groupBy("queried_item_name").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("queried_item_name", "n", percent(F.col("n"), F.col("total")).alias("pct"))


_BALANCE = ", ".join(f"count(*) FILTER (length({c}) - length(replace({c}, '(', '')) <> length({c}) - length(replace({c}, ')', ''))) {c}_unbalanced" for c in ("product_name_en", "display_name_en", "base_name_en"))


@query(rules.NAMES + f", e AS (SELECT *, display_en display_name_en, base_en base_name_en FROM d) SELECT {_BALANCE}, count(*) total FROM e")
def q7_bracket_balance(spark, d):
    return report.bracket_balance(_normalized(spark, d, "display_name_en", "base_name_en"), "product_name_en", "display_name_en", "base_name_en")


@query("""WITH l AS (SELECT concat_ws(chr(31), CASE WHEN doc_id IS NULL THEN 'null' ELSE 'v:' || doc_id END, CASE WHEN text IS NULL THEN 'null' ELSE 'v:' || text END) x FROM documents)
 SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(sha256(x), 1, 15) AS BIGINT)) AS VARCHAR) || ':' || CAST(sum(CAST('0x' || substr(sha256(x), 16, 15) AS BIGINT)) AS VARCHAR) fingerprint FROM l""")
def g1_table_fingerprint(spark, d):
    return report.fingerprint(spark.read.parquet(f"{d}/documents.parquet"), ["doc_id", "text"])


@query("SELECT s_suppkey, trim(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g')) base_key FROM supplier")
def e1_tokens(spark, d):
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", F.array_join(tokens(F.col("s_name")), " ").alias("base_key"))


_LINKS = f"""WITH reg AS ({ledger.REGISTRY}), decl AS ({ledger.DECLARED}), gal AS ({ledger.GALLERY}),
cand AS (SELECT business_name, count(DISTINCT code) candidates, CASE WHEN count(DISTINCT code) = 1 THEN min(code) END only_code FROM reg GROUP BY 1),
seen AS (SELECT g.rcno, g.business_name, min(g.code) seen_code FROM gal g JOIN reg USING (business_name, code) GROUP BY 1, 2),
res AS (SELECT d.rcno, d.business_name, coalesce(only_code, CASE WHEN candidates > 1 AND process_date IS NOT NULL THEN seen_code END) code,
  CASE WHEN only_code IS NOT NULL THEN 'PAGE_NAME' WHEN candidates > 1 AND process_date IS NOT NULL AND seen_code IS NOT NULL THEN 'PAGE_RCNO' END link_source
  FROM decl d LEFT JOIN cand USING (business_name) LEFT JOIN seen USING (rcno, business_name)) """


def _resolved(spark, d):
    return importers.resolve_groups(ledger.declared(spark, d), ledger.registry(spark, d), ledger.gallery(spark, d))


@query(_LINKS + "SELECT business_name, candidates, only_code FROM cand")
def f2_name_candidates(spark, d):
    return importers.name_candidates(ledger.registry(spark, d))


@query(_LINKS + """, links AS (SELECT * FROM gal WHERE rcno % 4 = 0) SELECT d.rcno, coalesce(l.code, only_code) code, CASE WHEN l.code IS NOT NULL THEN 'PAGE_RCNO' WHEN only_code IS NOT NULL THEN 'PAGE_NAME' END link_source
 FROM decl d LEFT JOIN cand USING (business_name) LEFT JOIN links l USING (rcno, business_name)""")
def f3_resolve_link(spark, d):
    links = ledger.gallery(spark, d).where("rcno % 4 = 0").withColumn("link_source", F.lit("PAGE_RCNO"))
    return importers.resolve_link(ledger.declared(spark, d), links, ledger.registry(spark, d))


@query(_LINKS + "SELECT * FROM res")
def f5_resolve_groups(spark, d):
    return _resolved(spark, d)


@query(_LINKS + "SELECT o_custkey rcno, min(g.code) least, max(g.code) most FROM gal g JOIN orders ON rcno = o_orderkey GROUP BY 1 HAVING min(g.code) <> max(g.code)")
def f6_link_conflicts(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").cast("long").alias("rcno"), "o_custkey")
    return importers.link_conflicts(ledger.gallery(spark, d).join(orders, "rcno").select(F.col("o_custkey").alias("rcno"), "code"))


@query(_LINKS + "SELECT count(DISTINCT business_name) AS groups, count(*) AS keys, count(code) resolved, count(*) - count(code) unresolved FROM res")
def f10_link_summary(spark, d):
    return importers.link_summary(_resolved(spark, d))


@query(_LINKS + "SELECT d.business_name, count(*) declarations, min(process_date) first_day, max(process_date) last_day, coalesce(max(candidates), 0) candidates, max(only_code) code FROM decl d LEFT JOIN cand USING (business_name) GROUP BY 1")
def h11_importer_list(spark, d):
    return importers.importer_list(ledger.declared(spark, d), ledger.registry(spark, d))


@query("SELECT event_id, sha256('/list?event=' || event_type || '&user=' || CAST(user_id AS VARCHAR)) request_sha256 FROM events")
def a9_request_key(spark, d):
    params = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("event"), F.col("event_type"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", quality.request_key(F.lit("/list"), params).alias("request_sha256"))


@query("SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) n_bytes, sha256(coalesce(html, '')) body_sha256, strlen(coalesce(html, '')) > 4096 over_limit FROM pages")
def a10_body_facts(spark, d):
    return quality.body_facts(spark.read.parquet(f"{d}/pages.parquet"), "html", 4096).select("page_id", "n_bytes", "body_sha256", "over_limit")


@query("""SELECT page_id, CAST(len(list_distinct(regexp_extract_all(coalesce(html, ''), 'href="([^"]*)"', 1))) AS INTEGER) links FROM pages""")
def a8_link_targets(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.size(quality.link_targets(F.col("html"))).alias("links"))


@query(_OBS + """cur AS (SELECT * FROM (SELECT *, max(attempt_no) OVER (PARTITION BY task_id) m FROM obs) WHERE attempt_no = m),
 k AS (SELECT task_id, rcno, count(*) n, min(item_id) own FROM cur GROUP BY 1, 2)
 SELECT task_id, CAST(sum(n) AS BIGINT) AS rows, count(*) AS keys, count(*) FILTER (NOT coalesce(earlier, false)) new_keys
 FROM (SELECT k.task_id, k.rcno, any_value(n) n, bool_or(o.item_id < own) earlier FROM k LEFT JOIN obs o ON o.rcno = k.rcno AND o.task_id <> k.task_id GROUP BY 1, 2) GROUP BY 1""")
def c6_task_counters(spark, d):
    return quality.task_counters(ledger.observations(spark, d))


_DIMS = rules.NAMES + """, long AS (UNPIVOT (SELECT item_id, item_name, importer_name, manufacture_country_name, normalization_status, normalization_status = 'REVIEW_REQUIRED' review FROM d)
 ON item_name, importer_name, manufacture_country_name, normalization_status INTO NAME dimension VALUE value)"""


@query(_DIMS + " SELECT DISTINCT dimension, value FROM long UNION SELECT 'review_reason', unnest(string_split(reasons, ',')) FROM d WHERE reasons <> ''")
def h4_vocabularies(spark, d):
    return quality.vocabularies(_with_status(spark, d))


_REVIEW = " UNION ALL ".join(
    f"(SELECT '{name}' AS dimension, {value} AS value, count(*) AS n FROM d WHERE {_OPEN} GROUP BY 2 ORDER BY 3 DESC, 2{limit})" for name, value, limit in (
        ("item", "coalesce(queried_item_name, '미분류')", " LIMIT 20"), ("importer", "coalesce(importer_base, importer_name, '미분류')", " LIMIT 20"),
        ("country", "coalesce(manufacture_country_name, '미분류')", " LIMIT 20"), ("status", "normalization_status", ""),
    ))


@query(rules.NAMES + " " + _REVIEW)
def h19_review_distribution(spark, d):
    return report.review_distribution(_normalized(spark, d, "normalization_status", "importer_base"))


def _with_status(spark, d):
    return _normalized(spark, d, "normalization_status", "review_reasons", "unit_volume_ml")


@query(_ITEMS + "SELECT item_id, product_name_en, item_name FROM items WHERE (contains(product_name_en, 'ml') OR contains(product_name_ko, 'ml')) AND item_name = '위스키' ORDER BY item_id DESC LIMIT 20 OFFSET 20")
def h5_search_page(spark, d):
    found = quality.search(ledger.items(spark, d), "ml", ("product_name_en", "product_name_ko"), {"item_name": "위스키"})
    return quality.page(found, [F.desc("item_id")], 2, 20).select("item_id", "product_name_en", "item_name")


@query(rules.NAMES + """, p AS (SELECT *, coalesce(nullif(trim(base_ko), ''), nullif(trim(base_en), ''), nullif(trim(product_name_ko), ''), nullif(trim(product_name_en), ''), nullif(trim(item_name), ''), '이름 미정') AS name FROM d)
 SELECT 'name:' || sha256(name) product_key, name, count(*) n, coalesce(strftime(min(processed_date), '%Y-%m-%d'), '') first_day, coalesce(strftime(max(processed_date), '%Y-%m-%d'), '') last_day FROM p GROUP BY name""")
def h13_product_groups(spark, d):
    return quality.product_groups(_normalized(spark, d, "base_name_ko", "base_name_en"))


@query(_OBS.rstrip(", ") + " SELECT count(*) AS rows, count(DISTINCT rcno) AS keys FROM obs")
def q1_row_key_counts(spark, d):
    return ledger.observations(spark, d).agg(F.count("*").alias("rows"), F.count_distinct("rcno").alias("keys"))


@query(_named("count(*) total, round(count(unit_volume_ml) * 100.0 / count(*), 2) unit_volume_ml_pct, round(count(abv) * 100.0 / count(*), 2) abv_percent_pct, round(count(age_years) * 100.0 / count(*), 2) age_years_pct, round(count(vintage_year) * 100.0 / count(*), 2) vintage_year_pct"))
def q5_extraction_rates(spark, d):
    return quality.extraction_rates(_normalized(spark, d, "unit_volume_ml", "abv_percent", "age_years", "vintage_year"), ("unit_volume_ml", "abv_percent", "age_years", "vintage_year"))


@query(_ITEMS + r"""SELECT count(*) FILTER (regexp_matches(product_name_en, '\( *\)|\[ *\]')) empty_brackets, count(*) FILTER (regexp_matches(product_name_en, '[,/] *[,/]')) repeated_separators,
 count(*) FILTER (regexp_matches(product_name_en, '^ *[,/]|[,/] *$')) orphan_separators, count(*) total FROM items""".replace("\\\\", "\\"))
def q8_debris(spark, d):
    return quality.debris(ledger.items(spark, d), "product_name_en")


@query(rules.FIELDS + "SELECT count(*) FILTER (hit) matching, count(*) FILTER (hit AND unit_volume_ml IS NULL) missed FROM (SELECT *, regexp_matches(en, '[0-9] ?(ml|ML|mL|L)') hit FROM r)")
def q10_missed_volume(spark, d):
    return quality.missed(_normalized(spark, d, "unit_volume_ml"), "product_name_en", "[0-9] ?(ml|ML|mL|L)", "unit_volume_ml")
