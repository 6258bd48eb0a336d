import datetime

from pyspark.sql import functions as F

from tallybook.operators import cdc, importers, masters, reconcile


def test_strength(spark):
    known = {"40%": 40.0, " 43.5% ": 43.5, "": 0.0, "%": 0.0, "46": 46.0, "12 %": None, "40%%": None, "abc": None, "5f": None, "NaN": None, ".5e2": 50.0, "1_0": None, "-3": -3.0}
    df = spark.createDataFrame([(k,) for k in known], "abv string")
    assert {r.abv: r.x for r in df.select("abv", masters.strength(F.col("abv")).alias("x")).collect()} == known


def test_references(spark):
    cols = "id int, kor_name string, eng_name string, abv string, type string, kor_category string, eng_category string, category_group string, region_id int, distillery_id int, age string, cask string, volume string, deleted_at date"
    raw = spark.createDataFrame([(1, "가", "A", "40%", "t", "위스키", None, "g", None, 7, None, None, None, None), (2, None, "B", None, "t", None, None, None, 3, None, "12", "c", "70cl", datetime.date(2026, 1, 1))], cols)
    got = {r.id: r for r in masters.load_alcohols(raw).collect()}
    assert (got[1].category, got[1].region_id, got[1].distillery_id, got[1].age, got[1].abv_percent) == ("위스키|g", 0, 7, "", 40.0)
    assert (got[2].category, got[2].region_id, got[2].distillery_id, got[2].abv, got[2].abv_percent) == ("", 3, 0, "", 0.0)
    makers = masters.load_distilleries(spark.createDataFrame([(1, "가", "A")], "id int, kor_name string, eng_name string"))
    regions = masters.load_regions(spark.createDataFrame([(1, "가", "A", None)], "id int, kor_name string, eng_name string, parent_id int"))
    assert regions.first().parent_id == 0
    version = lambda df: {r.kind: (r.rows, r.fingerprint) for r in masters.reference_version(masters.load_alcohols(df), makers, regions).collect()}
    first = version(raw)
    assert version(raw.orderBy(F.desc("id"))) == first and {k: v[0] for k, v in first.items()} == {"a": 2, "d": 1, "r": 1}
    other = version(raw.withColumn("deleted_at", F.lit(None).cast("date")))
    assert other["a"] != first["a"] and other["d"] == first["d"] and version(raw.limit(0))["a"] == (0, "0:0")


def test_verify_detail(spark):
    listed = spark.createDataFrame([(c, lic, " Name ", "r", "i", "a", "in") for c, lic in (("1", ""), ("2", "L"), ("3", "L"), ("4", None), ("5", "L"), ("6", "L"), ("7", "L"))], "code string, license_number string, business_name string, representative string, institution string, address string, industry string")
    page = lambda asked, code, lic, name="Name", status=200, location=None: (asked, status, location, code, lic, name, "R", "I", "A", "IN", "P", "D", "OPEN")
    rows = [page("1", " 1", "any"), page("2", "2", "L "), page("3", "3", "other"), page("4", "4", None, "Name 2"), page("5", None, None, None, 302, "https://h/error/noAuth?q"), page("6", None, None, None, 302, "https://h/error/noAuth/more")]
    details = spark.createDataFrame(rows, "asked_code string, http_status int, location string, code string, license_number string, business_name string, representative string, institution string, address string, industry string, phone string, permit_date string, operating_status string")
    got = {r.code: r for r in importers.verify_detail(listed, details).collect()}
    assert {c: r.outcome for c, r in got.items()} == {"1": "VERIFIED", "2": "VERIFIED", "3": "MISMATCH", "4": "MISMATCH", "5": "UNAVAILABLE", "6": "FAILED", "7": "FAILED"}
    assert (got["1"].license_number, got["1"].representative, got["1"].operating_status) == ("any", "R", "OPEN") and got["3"].business_name is None
    assert (got["5"].business_name, got["5"].representative, got["5"].operating_status, got["5"].phone) == (" Name ", "r", "UNKNOWN", None) and got["6"].operating_status is None
    assert importers.verify_detail(listed.limit(0), details).isEmpty()


def test_pending_of_a_job(spark):
    day = datetime.date(2026, 1, 1)
    rows = [(1, "a", 1, 1, " Old "), (2, "a", 2, 2, "New"), (3, "a", 2, 1, "Older"), (4, "b", 1, 1, "B"), (5, "c", 2, 1, "C"), (6, "d", 2, 1, " "), (7, "d", 1, 0, "D"), (8, "e", 1, 0, "E"), (9, "f", 1, 0, "F"), (10, "c", 2, 0, None)]
    items = spark.createDataFrame([(i, k, j, o, day, n) for i, k, j, o, n in rows], "item_id int, rcno string, job_id int, observed_at int, processed_date date, importer_name string")
    decls = spark.createDataFrame([("a", 1, None), ("b", 4, None), ("d", 7, None), ("e", 8, 5), ("f", 9, None)], "rcno string, source_item_id int, importer_id int")
    links = spark.createDataFrame([("c", "C"), ("a", "Old"), ("f", "F"), ("b", "b")], "rcno string, source_importer_name string")
    got = {(r.rcno, r.business_name) for r in importers.job_pending(items, decls, links, 2).collect()}
    assert got == {("a", "New"), ("b", "B"), ("d", "D")}


def test_claims(spark):
    at = lambda h: datetime.datetime(2026, 1, 1, h)
    rows = [("new", "PENDING", None, None, 0, None), ("held", "STALE", "w", at(9), 0, None), ("lapsed", "STALE", "w", at(7), 1, None), ("later", "PENDING", None, None, 1, at(9)), ("worn", "PENDING", None, None, 3, None),
            ("done", "NORMALIZED", None, None, 2, at(9)), ("endless", "PENDING", "w", None, 0, None)]
    state = spark.createDataFrame([(k, n, "h", *r) for n, (k, *r) in enumerate(rows)], "rcno string, source_item_id int, semantic_sha256 string, status string, claim_owner string, claim_lease_until timestamp, claim_attempts int, claim_next_attempt_at timestamp")
    latest = spark.createDataFrame([(k, n, datetime.date(2026, 1, 1 + n % 3)) for n, (k, *_) in enumerate(rows + [("unseen",)])], "rcno string, source_item_id int, processed_date date")
    now = F.lit(at(8))
    work = lambda **k: [r.rcno for r in cdc.due_work(latest, state, now, 3, 10, **k).collect()]
    assert work() == ["lapsed", "unseen", "new"]
    assert work(key="done") == ["done"] and work(key="held") == [] and work(key="worn") == ["worn"]
    queued = {r.rcno: r for r in cdc.force_requeue(state).collect()}
    assert (queued["done"].status, queued["done"].claim_attempts, queued["done"].claim_next_attempt_at) == ("STALE", 0, None) and queued["held"].claim_owner == "w"
    fresh = spark.createDataFrame([("held", 9, "h"), ("worn", 9, "other"), ("unseen", 9, "h")], "rcno string, source_item_id int, semantic_sha256 string")
    s = {r.rcno: r for r in cdc.sync_declarations(state.withColumn("review_status", F.lit("PENDING")), fresh).collect()}
    assert (s["held"].claim_owner, s["held"].source_item_id, s["held"].review_status) == ("w", 9, "PENDING")
    assert (s["worn"].claim_attempts, s["worn"].status, s["worn"].review_status) == (0, "STALE", "NOT_REQUIRED") and (s["unseen"].claim_attempts, s["unseen"].review_status) == (0, "NOT_REQUIRED")
    results = spark.createDataFrame([("new", 0), ("held", 5), ("gone", 1)], "rcno string, source_item_id int")
    assert {r.rcno for r in cdc.rejected_results(state, results, "rcno", ["source_item_id"]).collect()} == {"held", "gone"}


def test_upserts(spark):
    stored = spark.createDataFrame([("1", "A", "k", "r", "OPEN", 5), ("2", "B", "k", "r", "OPEN", 5)], "code string, business_name string, name_key string, representative string, operating_status string, observed_at int")
    batch = spark.createDataFrame([("1", " A2 ", "", "", 1), ("1", "A1", "x", "SHUT", 0), ("3", "C", "x", None, 1)], "code string, business_name string, representative string, operating_status string, observed_at int")
    got = {r.code: tuple(r)[1:] for r in importers.upsert_registry(stored, batch).withColumn("name_key", F.col("name_key") == F.sha2("business_name", 256)).collect()}
    assert got == {"1": ("A2", True, None, "UNKNOWN", 1), "2": ("B", False, "r", "OPEN", 5), "3": ("C", True, "x", "UNKNOWN", 1)}
    links = spark.createDataFrame([("a", "1", 9), ("b", "1", 9)], "rcno string, code string, source_observed_at int")
    more = spark.createDataFrame([("a", "2", 1), ("a", "3", 2), ("c", "4", 1)], links.schema)
    assert {tuple(r) for r in importers.upsert_links(links, more).collect()} == {("a", "3", 2), ("b", "1", 9), ("c", "4", 1)}


def test_task_reasons(spark):
    pages, keys = [], []
    scans = {  # task: attempt: item: keys
        1: {1: {"x": "abc", "y": "a"}, 2: {"x": "abd", "y": "a"}, 3: {"x": "abd", "y": "a"}},
        2: {1: {"y": "a"}, 2: {"x": "a", "y": "a"}},
        3: {1: {"x": "abc", "y": "abc"}, 2: {"x": "abc", "y": "ab!"}, 3: {"x": "abc", "y": "abcde"}},
    }
    for task, attempts in scans.items():
        for attempt, found in attempts.items():
            for item, ks in found.items():
                total = len(ks)
                pages += [(task, attempt, item, p + 1, "PARSED", len(ks[2 * p : 2 * p + 2]), total) for p in range((total + 1) // 2)]
                keys += [(task, attempt, item, k) for k in ks if k != "!"]
    pages = spark.createDataFrame(pages, "task_id int, attempt int, item_code string, page_no int, status string, parsed_rows long, total long")
    keys = spark.createDataFrame(keys, "task_id int, attempt int, item_code string, rcno string")
    got = {(r.task_id, r.attempt): tuple(r)[2:] for r in reconcile.judge_tasks(reconcile.reconcile_items(pages, keys, 2), keys, [("x", "ex"), ("y", "why")]).collect()}
    assert got == {
        (1, 1): ("VERIFICATION_REQUIRED", "x", "ex", None, None, None), (1, 2): ("SET_CHANGED", "x", "ex", None, 1, 1), (1, 3): ("COMPLETE", None, None, None, None, None),
        (2, 1): ("RECONCILIATION_FAILED", "x", "ex", "not_collected", None, None), (2, 2): ("COMPLETE", None, None, None, None, None),
        (3, 1): ("VERIFICATION_REQUIRED", "x", "ex", None, None, None), (3, 2): ("RECONCILIATION_FAILED", "y", "why", "stored_rows", None, None), (3, 3): ("SET_CHANGED", "y", "why", None, 0, 2),
    }
