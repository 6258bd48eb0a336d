import pytest
from pyspark.sql import functions as F

from tallybook.functions.text import search_key, ws_collapse
from tallybook.operators import cdc, normalize, reconcile

ROWS = [
    # ko, en, volume, package, age, batch, strength
    ("대용량 위스키 4,000ml", None, 4000, None, None, None, None),
    ("고량주 250ML*2", None, 250, 2, None, None, None),
    ("가쿠빈 1920ML", None, 1920, None, None, None, None),
    ("글렌알라키 15년 구형", "GLENALLACHIE 15 YEAR OLD", None, None, 15, None, None),
    ("배치 No. 2", "BATCH 3", None, None, None, "2", None),
    ("위스키 700ml", "WHISKY 750ml", None, None, None, None, None),
    (None, "SPRINGBANK CASK STRENGHT 700ml", 700, None, None, None, "CASK STRENGTH"),
    (None, "WHISKY,700ml CASK STRENGH", 700, None, None, None, "CASK STRENGTH"),
    ("배럴 스트랭스", "700ml 50ml*2", None, None, None, None, "BARREL STRENGTH"),
    ("12 년 위스키", "AGED 12", None, None, 12, None, None),
    (None, None, None, None, None, None, None),
    ("", "", None, None, None, None, None),
]


def test_fields(spark):
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(ROWS)], "i int, ko string, en string")
    ko, en = F.col("ko"), F.col("en")
    got = df.select(
        "i", normalize.parse_volume(ko, en)["ml"], normalize.parse_package(ko, en), normalize.parse_age(ko, en)["years"],
        normalize.parse_batch(ko, en)["number"], normalize.parse_strength(ko, en),
    ).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [r[2:] for r in ROWS]


@pytest.mark.parametrize("text,first,last,bad", [
    ("2025-06-03 ~", "2025-06-03", None, False), ("~ 2026-08-26", None, "2026-08-26", False), ("-", None, None, False),
    ("2026-02-30 ~", None, None, True), ("2026-02-30 ~ 2026-08-26", None, "2026-08-26", True), (None, None, None, False),
    ("~", None, None, True), ("2025-06-03 ~ abc", None, None, True), ("text", None, None, True),
])
def test_expiry(spark, text, first, last, bad):
    r = spark.createDataFrame([(text,)], "t string").select(normalize.parse_expiry(F.col("t")).alias("e")).first().e
    assert (str(r.first) if r.first else None, str(r.last) if r.last else None, r.bad) == (first, last, bad)


def test_company_and_keys(spark):
    r = spark.createDataFrame([("  주식회사 호수무역  ", "O’Connor　 Distillery")], "a string, b string").select(
        normalize.parse_company(F.col("a")).alias("c"), search_key(F.col("b")).alias("k"), ws_collapse(F.col("b")).alias("w")).first()
    assert (r.c.base, r.c.legal_form, r.k, r.w) == ("주식회사 호수무역", "주식회사", "o'connor distillery", "O’Connor Distillery")


def test_sync_repoints_or_stales(spark):
    cur = spark.createDataFrame([(1, 10, "a", "NORMALIZED"), (2, 20, "b", "NORMALIZED"), (3, 30, None, "PARTIAL")], "rcno long, source_item_id long, semantic_sha256 string, status string")
    new = spark.createDataFrame([(1, 11, "a"), (2, 21, "x"), (3, 31, None), (4, 40, "n")], "rcno long, source_item_id long, semantic_sha256 string")
    out = cdc.sync_declarations(cur, new)
    rows = {r.rcno: (r.source_item_id, r.status) for r in out.collect()}
    assert rows == {1: (11, "NORMALIZED"), 2: (21, "STALE"), 3: (31, "PARTIAL"), 4: (40, "PENDING")}
    again = cdc.sync_declarations(out.drop("changed"), new)
    assert again.where("changed").isEmpty()


def _verdicts(spark, scans, total=None):
    """scans: per attempt the pages, each a list of keys."""
    pages, keys = [], []
    for a, scan in enumerate(scans, 1):
        n = sum(map(len, scan)) if total is None else total
        for p, page in enumerate(scan, 1):
            pages.append((1, a, "x", p, "PARSED", n, len(page)))
            keys += [(1, a, "x", k) for k in page]
    p = spark.createDataFrame(pages, "task_id long, attempt int, item_code string, page_no int, status string, total long, parsed_rows long")
    k = spark.createDataFrame(keys, "task_id long, attempt int, item_code string, rcno long")
    return [r.verdict for r in reconcile.reconcile_tasks(reconcile.reconcile_items(p, k, 2)).orderBy("attempt").collect()]


def test_reconciliation(spark):
    assert _verdicts(spark, [[[1, 2]]]) == ["COMPLETE"]
    assert _verdicts(spark, [[[1, 2], [3]], [[1, 2], [3]]]) == ["VERIFICATION_REQUIRED", "COMPLETE"]
    assert _verdicts(spark, [[[1, 2], [3]], [[1, 2], [4]], [[1, 2], [4]]]) == ["VERIFICATION_REQUIRED", "SET_CHANGED", "COMPLETE"]
    assert _verdicts(spark, [[[1, 2], [2]]]) == ["RECONCILIATION_FAILED"]
    assert _verdicts(spark, [[[]]]) == ["COMPLETE"]
