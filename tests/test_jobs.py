import pytest
from pyspark.sql import functions as F

from tallybook.operators import detail, jobs, mirror
from tallybook.streaming import incremental


def test_job_counters_and_status(spark):
    tasks = spark.createDataFrame([(1, 10, "DONE", 2, None), (2, 10, "FAILED", 1, "b"), (3, 20, "DONE", 1, "a"), (4, 30, "PENDING", 0, None), (5, 40, "CANCELLED", 0, None)], "task_id int, job_id int, status string, attempts int, last_error string")
    items = spark.createDataFrame([(1, 1, 1, "A"), (2, 1, 2, "A"), (3, 1, 2, "B"), (4, 1, 2, "B"), (5, 2, 1, "C"), (6, 3, 1, "A"), (7, 3, 1, "C"), (0, 3, 2, "B")], "item_id int, task_id int, attempt_no int, rcno string")
    fetches = items.select("task_id", "attempt_no").distinct()
    got = {r.job_id: tuple(r)[1:] for r in jobs.job_counters(items, fetches, tasks).collect()}
    # C of the failed task does not count, so job 20 is first with it; B of an attempt that was not accepted neither
    assert got == {10: (2, 1, 1, 3, 3, 2, 2), 20: (1, 1, 0, 2, 2, 2, 1), 30: (1, 0, 0, 0, 0, 0, 0), 40: (1, 0, 0, 0, 0, 0, 0)}
    known = spark.createDataFrame([(10, "RUNNING", False), (20, "RUNNING", False), (30, "RUNNING", True), (40, "RUNNING", True), (50, "RUNNING", False)], "job_id int, status string, cancel_requested boolean")
    s = {r.job_id: (r.status, r.last_error, r.active) for r in jobs.job_status(known, tasks).collect()}
    assert s == {10: ("PARTIAL_FAILED", "b", 0), 20: ("COMPLETED", "a", 0), 30: ("RUNNING", None, 1), 40: ("CANCELLED", None, 0), 50: ("COMPLETED", None, 0)}


def test_attempt_evidence(spark):
    pages = spark.createDataFrame([(1, 2, "x", 2, "PARSED", 3, 1), (1, 2, "x", 1, "PARSED", 3, 2), (1, 1, "x", 1, "FAILED", 0, 0)], "task_id int, attempt int, item_code string, page_no int, status string, total int, parsed_rows int")
    keys = spark.createDataFrame([(1, 2, "x", "b"), (1, 2, "x", "a"), (1, 2, "x", "a"), (1, 2, "y", "c")], "task_id int, attempt int, item_code string, rcno string")
    (row,) = jobs.attempt_evidence(pages, keys).collect()
    first, second = row.attempts
    assert [i.item_code for i in first["items"]] == ["x"] and first["items"][0]["keys"] == [] and [i.item_code for i in second["items"]] == ["x", "y"]
    assert [p.page_no for p in second["items"][0].pages] == [1, 2] and second["items"][0]["keys"] == ["a", "a", "b"] and second["items"][1].pages == []


def test_candidate_labels_and_details(spark):
    cols = [f"{t}_candidate_{k}" for t in detail.TARGETS for k in (1, 2, 3)]
    ids = [1, 9, None, 1, None, None, 2, 1, None]
    row = ("r", *[x for i in ids for x in (i, None if i is None else 1234.5)])
    d = spark.createDataFrame([row, ("none", *[None] * 18)], "rcno string, " + ", ".join(f"{c}_id long, {c}_score double" for c in cols))
    master = lambda *rows: spark.createDataFrame(list(rows), "id long, kor_name string, eng_name string")
    out = {r.rcno: r for r in detail.candidate_labels(d, "rcno", alcohol=master((1, "가", "A")), distillery=master((1, "", "D")), region=master((1, None, ""), (2, "나", None))).collect()}
    assert [out["r"][c] for c in cols] == ["가 / A · ID 1 · 점수 1,234.50", "ID 9 · 점수 1,234.50", "", "D · ID 1 · 점수 1,234.50", "", "", "나 · ID 2 · 점수 1,234.50", "ID 1 · 점수 1,234.50", ""]
    assert all(out["none"][c] == "" for c in cols)
    candidates = spark.createDataFrame([("r", "region", 1, 5, 1.0), ("r", "alcohol", 2, 6, 2.0), ("r", "alcohol", 1, 7, 3.0)], "rcno string, target string, rank int, id long, score double")
    evidence = spark.createDataFrame([("r", "alcohol", 1, 7, 1, "b"), ("r", "alcohol", 1, 7, 0, "a"), ("r", "region", 1, 5, 0, "c")], "rcno string, target string, rank int, id long, position int, kind string")
    (r,) = detail.candidate_details(candidates, evidence, "rcno").collect()
    assert [(c.target, c["rank"], c.id, [e.kind for e in c.evidence]) for c in r.candidates] == [("alcohol", 1, 7, ["a", "b"]), ("alcohol", 2, 6, []), ("region", 1, 5, ["c"])]


def test_mirror_switches_only_after_equal_fingerprints(spark, tmp_path):
    target = f"file://{tmp_path}/mirror"
    one, two = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string"), spark.createDataFrame([(1, "a"), (2, "")], "id int, name string")
    assert mirror.current(spark, target, "t") is None
    first = mirror.mirror(spark, target, {"t": one})
    assert first["t"][0] == 2 and {tuple(r) for r in mirror.current(spark, target, "t").collect()} == {(1, "a"), (2, None)}

    def lose(folder):
        spark.createDataFrame([(1, "a")], "id int, name string").write.mode("overwrite").parquet(f"{folder}/t")

    with pytest.raises(ValueError, match="t: the mirror has"):
        mirror.mirror(spark, target, {"t": two}, tamper=lose)
    assert {tuple(r) for r in mirror.current(spark, target, "t").collect()} == {(1, "a"), (2, None)}
    second = mirror.mirror(spark, target, {"t": two})
    assert second["t"] != first["t"] and mirror.versions(spark, target) == [1, 3]
    assert {tuple(r) for r in mirror.current(spark, target, "t").collect()} == {(1, "a"), (2, "")}


def test_incremental_derives_only_changed_keys(spark, tmp_path):
    target = f"file://{tmp_path}/state"
    schema = "rcno long, item_id long, observed_at long, semantic_sha256 string, name string"
    derive = lambda d: d.select("rcno", F.upper("name").alias("derived"))
    batches = [[(1, 1, 1, "x", "a"), (2, 2, 1, "x", "b"), (1, 3, 2, "y", "c")], [(1, 4, 3, "y", "ignored"), (2, 5, 2, "z", "d"), (3, 6, 1, None, "e")], [(1, 7, 1, "q", "late"), (3, 8, 2, None, "f")]]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        for _ in range(2):  # a batch that runs again changes nothing
            incremental.apply_batch(spark, df, n, target, derive)
    got = {r.rcno: (r.item_id, r.semantic_sha256, r.derived, r.derived_in) for r in incremental.current(spark, target).collect()}
    assert got == {1: (4, "y", "C", 0), 2: (5, "z", "D", 1), 3: (8, None, "E", 1)}


def test_incremental_stream_equals_batch(spark, tmp_path):
    rows = [(i % 5, i, (i * 7) % 40, str(i % 3), f"n{i % 3}") for i in range(40)]
    df = spark.createDataFrame(rows, "rcno long, item_id long, observed_at long, semantic_sha256 string, name string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    target = f"file://{tmp_path}/state"
    incremental.derive_changed(stream, spark, target, str(tmp_path / "cp"), lambda d: d.select("rcno", F.upper("name").alias("derived"))).awaitTermination()
    got = {r.rcno: (r.item_id, r.derived) for r in incremental.current(spark, target).collect()}
    assert got == {k: max(((r[2], r[1], r[4].upper()) for r in rows if r[0] == k))[1:] for k in range(5)}


def test_scans_are_those_of_their_sql_without_sorting(spark, tmp_path):
    from tallybook.sources import ledger

    rows = [(o, p, "ANR"[(o + p) % 3]) for o in range(1, 330, 3) for p in range(1, 40)] + [(18, None, "A"), (None, 17, "A"), (18, 17, None), (1, 1, "A"), (1, 1, "A")]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    keys, pages = ledger.keys(spark, str(tmp_path)), ledger.pages(spark, str(tmp_path))
    by_sql = ledger.frame(spark, str(tmp_path), ledger.KEYS)
    for got, want in ((keys, by_sql), (pages, ledger.frame(spark, str(tmp_path), ledger.PAGES, syn_keys=by_sql))):
        assert got.dtypes == want.dtypes and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_key_diff_in_one_pass(spark):
    from tallybook.operators import reconcile

    rows = [(1, 1, "A", 5), (1, 1, "A", 5), (1, 2, "A", 5), (1, 1, "A", 6), (1, 2, "A", 7), (1, 3, "A", 8), (1, 1, None, 9), (1, 2, None, 9)]
    diff = reconcile.key_diff(spark.createDataFrame(rows, "task_id long, attempt int, item_code string, rcno long"), 1, 2)
    # a key without an item is the same key in both attempts
    assert {tuple(r) for r in diff.collect()} == {(1, "A", 6, "missing"), (1, "A", 7, "unexpected")}
    assert "Join" not in diff._jdf.queryExecution().optimizedPlan().toString()
