import datetime

import pytest

from tallybook.operators import lists, quality

DAY = datetime.date(2026, 1, 1)
COLUMNS = "source_item_id int, product_name_en string, processed_date date, importer_id int, alcohol_candidate_1_id int, distillery_candidate_1_id int, region_candidate_1_id int, base_name_ko string, base_name_en string, product_name_ko string, item_name string"


@pytest.fixture(scope="module")
def decls(spark):
    late = DAY + datetime.timedelta(days=9)
    rows = [(1, "a_1", DAY, 1, 5, None, None), (2, "a%1", late, None, None, 3, None), (3, None, None, 1, 5, 3, 2), (4, "aa1", late, 2, None, None, 2)]
    return spark.createDataFrame([(*r, None, " ", None, "item") for r in rows], COLUMNS)


def ids(df):
    return [r.source_item_id for r in df.collect()]


def test_filters(decls):
    find = lambda **k: set(ids(lists.find_declarations(decls, **k)))
    assert find() == {1, 2, 3, 4} and find(text="_", columns=("product_name_en",)) == {1} and find(text="%", columns=("product_name_en",)) == {2}
    assert find(link="linked") == {1, 3, 4} and find(link="unlinked") == {2} and find(importer_id=1) == {1, 3}
    assert find(first="2026-01-01", last="2026-01-10") == {1, 2, 4} and find(last="2026-01-09") == {1} and find(first="2026-01-10") == {2, 4}
    assert find(matches={"alcohol": "matched", "region": "unmatched"}) == {1} and find(matches={"distillery": "unmatched"}) == {1, 4}


def test_orders_and_pages(decls):
    order = lambda *a: ids(decls.orderBy(*lists.declaration_order(*a)))
    assert order() == [4, 2, 1, 3] and order("processed_at", False) == [3, 1, 4, 2] and order("alcohol") == [1, 3, 4, 2] and order("region", False) == [2, 1, 4, 3]
    with pytest.raises(ValueError):
        lists.declaration_order("name; drop")
    assert ids(quality.page(decls, lists.declaration_order(), 2, 3)) == [3]
    assert tuple(lists.page_info(decls, 2, 3).first()) == (2, 3, 4, 2) and tuple(lists.page_info(decls.limit(0), 1, 3).first()) == (1, 3, 0, 0)


def test_importers(spark, decls):
    registry = spark.createDataFrame([(1, "B", "001", "L1", None, "x", "OPEN"), (2, "A", "002", "L2", "100%", "y", "OPEN"), (3, "C", "003", "", "z", "y", "CLOSED")], "importer_id int, business_name string, code string, license_number string, representative string, address string, operating_status string")
    got = {r.importer_id: (r.declarations, r.products, r.first_day, r.last_day) for r in lists.importer_entries(registry, decls).collect()}
    assert got == {1: (2, 2, "2026-01-01", "2026-01-01"), 2: (1, 1, "2026-01-10", "2026-01-10"), 3: (0, 0, "", "")}
    find = lambda **k: [r.importer_id for r in lists.importer_entries(registry, decls, **k).orderBy(*lists.importer_order()).collect()]
    assert find() == [2, 1, 3] and find(matched_only=True) == [2, 1] and find(text="0%") == [2] and find(equal={"operating_status": "CLOSED"}) == [3]
    by = lambda *a: [r.importer_id for r in lists.importer_entries(registry, decls).orderBy(*lists.importer_order(*a)).collect()]
    assert by("declarations", True) == [1, 2, 3] and by("last_import") == [3, 1, 2]
