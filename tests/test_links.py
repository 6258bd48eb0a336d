from tallybook.operators import importers, quality


def test_groups_resolve_by_name_or_key(spark):
    decls = spark.createDataFrame([(1, " A ", "2026-01-01"), (2, "B", "2026-01-01"), (3, "B", None), (4, "C", "2026-01-01"), (5, None, None)], "rcno long, business_name string, process_date string")
    registry = spark.createDataFrame([("a1", "A"), ("b1", "B"), ("b2", "B "), (None, "C")], "code string, business_name string")
    gallery = spark.createDataFrame([(2, "B", "b2"), (3, "B", "b1"), (4, "C", "c9")], "rcno long, business_name string, code string")
    rows = {r.rcno: (r.code, r.link_source) for r in importers.resolve_groups(decls, registry, gallery).collect()}
    assert rows == {1: ("a1", "PAGE_NAME"), 2: ("b2", "PAGE_RCNO"), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_upsert_keeps_the_newest(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "code string, seen int, name string")
    new = spark.createDataFrame([("a", 2, "z")], "code string, seen int, name string")
    assert sorted(map(tuple, importers.upsert(old, new, "code", "seen").collect())) == [("a", 2, "z"), ("b", 1, "y")]


def test_failures_keep_derived_values(spark):
    state = spark.createDataFrame([(1, "NORMALIZED"), (2, "STALE")], "rcno long, status string")
    failed = spark.createDataFrame([(2, "e" * 5000, "2026-01-01")], "rcno long, error string, next_at string")
    rows = {r.rcno: (r.status, len(r.last_error or "")) for r in quality.mark_failed(state, failed).collect()}
    assert rows == {1: ("NORMALIZED", 0), 2: ("STALE", 4096)}


def test_match_work(spark):
    d = spark.createDataFrame([(3, "NORMALIZED", None), (1, "PARTIAL", "v1"), (2, None, None)], "item_id long, normalization_status string, matching_version string")
    assert [r.item_id for r in quality.select_match_work(d, "v1", 5).collect()] == [3]
    assert [r.item_id for r in quality.select_match_work(d, "v1", 5, force=True).collect()] == [1, 3]
