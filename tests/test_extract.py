"""Captured pages: a page as the portal writes it, and one change a case."""

import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallybook.operators import extract as X

RCNOS = ("202600519647", "202600524242")


def cell(rcno, text):
    return f'<td><a href="javascript:fnFoodDetail(&#39;{rcno}&#39;);">{text}</a></td>'


def row(rcno, en, attributes="", ko="윌슨앤모건 20년"):
    values = ("가공식품", "앤트인터내셔널", ko, en, "위스키", "EST", "2026-07-27", "2025-12-11 ~", "영국", "이탈리아")
    return f"<tr{attributes}>" + "".join(cell(rcno, v) for v in values) + "</tr>"


ROWS = row(RCNOS[0], "W&amp;M609 -\n  W&amp;M <b>CLYNELISH</b>", ' data-source="a > b"') + "<!-- </tr> -->" + row(RCNOS[1], "SECOND")


def page(rows=ROWS, total=4, hidden=None, number=1, limit=2, nav=True):
    hidden = total if hidden is None else hidden
    heads = "".join(f"<th>{h}</th>" for h in X.HEADERS)
    fields = (("paramPage", "page", number), ("paramLimit", "limit", limit), ("paramRpsntItmNm", "rpsntItmNm", "위스키"), ("x", "rpsntItmCd", "C03"), ("paramSrchStrtDt", "srchStrtDt", "2026-07-27"),
              ("paramSrchEndDt", "srchEndDt", "2026-07-27"), ("paramTotalCnt", "totalCnt", hidden))
    inputs = "".join(f'<input type="hidden" id="{i}" name="{n}" value="{v}">' for i, n, v in fields)
    bar = f'<p class="page_navi"><input class="number" value="{number}"> / {-(-total // limit)}</p>' if nav else ""
    return (f'<html><title>목록</title><form id="frm">{inputs}</form><div class="board_count">총 <strong>{total}</strong>건</div><table class="other"><tbody><tr><td>x</td></tr></tbody></table>'
            f'<table class="board_list auto_title"><thead><tr>{heads}</tr></thead><tbody>{rows}</tbody></table>{bar}</html>')


GOOD = page()
EXTRA = cell(RCNOS[0], "추가")
FIRST = row(RCNOS[0], "W&amp;M609 -\n  W&amp;M <b>CLYNELISH</b>", ' data-source="a > b"')
CASES = {
    "good": (GOOD, []), "header": (GOOD.replace("<th>구분</th>", "<th>분류</th>"), ["headers"]), "header count": (GOOD.replace("<th>구분</th>", ""), ["header_count"]),
    "date": (GOOD.replace(">2026-07-27</a>", ">2026-07-26</a>", 1), ["row 1: processed_date"]), "no date": (GOOD.replace(">2026-07-27</a>", ">2026-02-30</a>", 1), ["row 1: processed_date_invalid"]),
    "item": (GOOD.replace(">위스키</a>", ">브랜디</a>", 1), ["row 1: item_name"]), "rcno differs": (GOOD.replace(RCNOS[1], "202600519648", 1), ["row 2: rcno_differs"]),
    "short rcno": (GOOD.replace(RCNOS[0], "20260051964"), ["row 1: detail_href"]), "long rcno": (GOOD.replace(RCNOS[0], RCNOS[0] + "0"), ["row 1: detail_href"]), "letters": (GOOD.replace(RCNOS[1], "ABCDEFGHIJKL"), ["row 2: detail_href"]),
    "9 cells": (GOOD.replace(cell(RCNOS[0], "앤트인터내셔널"), ""), ["row 1: cell_count"]), "11 cells": (GOOD.replace(FIRST, FIRST[:-5] + EXTRA + "</tr>"), ["row 1: cell_count"]),
    "no anchor": (GOOD.replace(cell(RCNOS[0], "가공식품"), "<td>가공식품</td>"), ["row 1: anchor_count"]), "hidden total": (page(hidden=5), ["total_differs"]), "no number": (page(hidden="x"), ["total_hidden"]),
    "echoed page": (GOOD.replace('name="page" value="1"', 'name="page" value="2"'), ["echo_page"]), "echoed limit": (GOOD.replace('name="limit" value="2"', 'name="limit" value="3"'), ["echo_limit"]),
    "echoed item": (GOOD.replace('name="rpsntItmNm" value="위스키"', 'name="rpsntItmNm" value="브랜디"'), ["echo_item_name"]), "echoed code": (GOOD.replace('value="C03"', 'value="C04"'), ["echo_item_code"]),
    "echoed dates": (GOOD.replace('value="2026-07-27"', 'value="2026-07-26"'), ["echo_start_date", "echo_end_date"]), "no input": (GOOD.replace('id="paramPage"', 'id="y"'), ["echo_page_count"]),
    "no navigation": (page(nav=False), ["navigation_missing"]), "pages": (GOOD.replace("/ 2</p>", "/ 3</p>"), ["navigation_pages"]), "navigation page": (GOOD.replace('class="number" value="1"', 'class="number" value="2"'), ["navigation_page"]),
    "truncated": (GOOD[: GOOD.rindex("</tbody>")], ["navigation_missing", "row_source"]), "error page": ("<html><title> ERROR </title></html>", None), "error text": ("<p>에러가 발생하였습니다</p>", None),
    "null": (None, None), "two tables": (GOOD + '<table class="auto_title x board_list"></table>', ["table_count"]),
    "empty": (page('<tr><td colspan="10"><span class="nodata">조회 결과가 없습니다.</span></td></tr>', 0, nav=False), []), "bad empty": (page("<tr><td>-</td></tr>", 0, nav=False), ["no_data_shape"]),
    "nested": (page(row(RCNOS[0], "<table><tr><td>IN</td></tr></table>") + row(RCNOS[1], "B")), []), "one page": (page(total=2, nav=False), []), "short page": (page(FIRST), []), "twice": (page(FIRST + FIRST), []),
}


@pytest.fixture(scope="module")
def validated(spark):
    rows = [(i, name, html, "위스키", "C03", date(2026, 7, 27), 1, 2, None) for i, (name, (html, _)) in enumerate(CASES.items())]
    df = spark.createDataFrame(rows, "page_id int, name string, html string, item_name string, item_code string, process_date date, page int, page_limit int, total_snapshot long").repartition(4)
    return X.validate_ledger(X.ledger_facts(df)).cache()


def test_contract(validated):
    got = {r.name: r.violations for r in validated.select("name", "violations").collect()}
    for name, (_, want) in CASES.items():
        if want is None:
            assert got[name][0] in ("error_page", "table_count")
        else:
            assert got[name] == want, name
    assert got["error page"][0] == got["error text"][0] == "error_page"


def test_rows_and_hashes(validated):
    rows = {(r.name, r.row_no): r for r in X.ledger_rows(validated, "name").collect()}
    r = rows["good", 1]
    values = ["가공식품", "앤트인터내셔널", "윌슨앤모건 20년", "W&M609 - W&M CLYNELISH", "위스키", "EST", "2026-07-27", "2025-12-11 ~", "영국", "이탈리아"]
    assert r.rcno == RCNOS[0] and [r[f] for f in X.FIELDS] == values and json.loads(r.canonical_json) == values
    assert r.raw_row == FIRST and r.raw_row_sha256 == hashlib.sha256(FIRST.encode()).hexdigest()
    material = json.dumps([X.VERSION, r.rcno, *values], ensure_ascii=False, separators=(",", ":")).replace("&", "\\u0026")
    assert r.semantic_sha256 == hashlib.sha256(material.encode()).hexdigest()
    assert rows["nested", 1].product_name_en == "IN" and {n for n, _ in rows} == {"good", "nested", "one page", "short page", "twice"}


def test_semantic_hash_survives_cosmetics(spark):
    variants = [FIRST, FIRST.replace(' data-source="a > b"', " class='x'"), FIRST.replace("<b>", "<i>").replace("</b>", "</i>"), FIRST.replace("\n  ", " ").replace("&amp;", "&#38;"), FIRST.replace("20년", "21년")]
    rows = [(i, page(v), "위스키", "C03", date(2026, 7, 27), 1, 2, None) for i, v in enumerate(variants)]
    df = spark.createDataFrame(rows, "page_id int, html string, item_name string, item_code string, process_date date, page int, page_limit int, total_snapshot long")
    got = {r.page_id: r for r in X.ledger_rows(X.validate_ledger(X.ledger_facts(df)), "page_id").collect()}
    assert len({got[i].semantic_sha256 for i in range(4)}) == 1 and got[4].semantic_sha256 != got[0].semantic_sha256
    assert len({r.raw_row_sha256 for r in got.values()}) == 5


def test_warnings_and_snapshot(spark, validated):
    w = {r.name: (r.expected, r.parsed, r.warned, r.repeated) for r in X.ledger_warnings(validated, "name").collect()}
    assert w["good"] == (2, 2, False, []) and w["short page"] == (2, 1, True, []) and w["twice"] == (2, 2, False, [RCNOS[0]]) and w["empty"] == (0, 0, False, [])
    rows = [(i, page(number=2), "위스키", "C03", date(2026, 7, 27), 2, 2, t) for i, t in enumerate((4, 5, None))]
    df = spark.createDataFrame(rows, "page_id int, html string, item_name string, item_code string, process_date date, page int, page_limit int, total_snapshot long")
    assert {r.page_id: r.violations for r in X.validate_ledger(X.ledger_facts(df)).collect()} == {0: [], 1: ["total_snapshot"], 2: ["total_snapshot"]}


def registry(n, total, first=1, caption=X.REGISTRY_CAPTION):
    rows = "".join(f'<tr><td><a href="javascript:fnDetailPopup1( &#39;C{i}&#39; )">{i}</a></td><td>L{i}</td><td>업소 &amp; {i}</td><td>업</td><td>대</td><td>주</td><td>기관</td></tr>' for i in range(first, first + n))
    heads = "".join(f"<th>{h}</th>" for h in X.REGISTRY_HEADERS)
    return f'<ul><li><div class="board_count">9</div></li><li><div class="board_count">총 <b>{total:,}</b> 건</div><table><caption>{caption}</caption><thead><tr>{heads}</tr></thead><tbody>{rows}</tbody></table></li></ul>'


def test_registry(spark):
    none = registry(0, 0).replace("<tbody>", "<tbody><tr><td>조회 결과가 없습니다</td></tr>")
    rows = [(0, registry(10, 1234), 1, None), (1, registry(3, 1233), 1, None), (2, registry(3, 3), 1, None), (3, none, 1, None), (4, registry(4, 1234, 1231), 124, 1234), (5, registry(4, 1234, 1231), 124, 1235),
            (6, registry(3, 3, caption="x"), 1, None), (7, registry(3, 3).replace("L2", ""), 1, None), (8, registry(3, 3).replace("C1&#39;", "&#39;"), 1, None), (9, None, 1, None), (10, registry(3, 3).replace("총", "합"), 1, None)]
    got = {r.page_id: r for r in X.registry_rows(spark.createDataFrame([(*r[:3], 10, r[3]) for r in rows], "page_id int, html string, page int, page_limit int, total_snapshot long"), "page_id").collect()}
    assert {i: r.violation for i, r in got.items()} == {0: None, 1: "row_count", 2: None, 3: None, 4: None, 5: "total_snapshot", 6: "table_count", 7: "row_shape", 8: "row_shape", 9: "table_count", 10: "total"}
    assert got[0].total == 1234 and tuple(got[0].rows[1]) == (2, "C2", "L2", "업소 & 2", "업", "대", "주", "기관") and got[3].rows == [] and got[5].rows is None


def test_detail_record(spark):
    table = '<table class="board_view"><caption>업소 기본정보</caption><tr><th>인허가번호</th><td>L1</td><th>업소명</th><td>가 &amp; 나</td></tr><tr><th>대표자</th><td></td><th>대표자명</th><td>김</td></tr><tr><th>주소</th><td>서울</td><th>주소</th><td>부산</td></tr><tr><td>연락처</td><td>02</td><th>끝</th></tr></table>'
    rows = [(0, table), (1, table.replace("L1", "")), (2, table.replace("board_view", "x")), (3, None)]
    got = {r.page_id: r for r in X.detail_record(spark.createDataFrame(rows, "page_id int, html string"), "page_id").collect()}
    assert tuple(got[0])[1:] == (None, "L1", "가 & 나", "김", "", "", "부산", "", "", "")
    assert [got[i].violation for i in (1, 2, 3)] == ["names_missing", "table_count", "table_count"]


def test_gallery(spark):
    link = lambda c, n: f'<a href="javascript:fnGalleryMobileDetail(&#39;{c}&#39;)"><img><strong class="title">{n}</strong></a>'
    body = f'<div class="board_count">총 <em>3</em>건</div>{link(11, "가 &lt;1&gt;")}{link(11, "again")}{link(12, "나")}<a href="/x">x</a><a href="fnGalleryMobileDetail(13)">y</a>'
    rows = [(0, body), (1, body.replace("13", "11")), (2, "<p>x</p>"), (3, None)]
    got = {r.page_id: r for r in X.gallery_products(spark.createDataFrame([(*r, 1, 10) for r in rows], "page_id int, html string, page int, page_limit int"), "page_id").collect()}
    assert [tuple(p) for p in got[0].products] == [("11", "가 <1>"), ("12", "나"), ("13", "")] and [got[i].violation for i in range(4)] == [None, "product_count", "total", "total"]
    pages = [(0, '<script>var param = {"rcno":" 1 ","grpBsnLcnsLedgNo":"2","bsshNm":"가;나","more":{"x":1}} ;</script>'), (1, "<script>var param = {bad};</script>"), (2, "no"), (3, '<script>var param={"rcno":"1"};</script>'), (4, None)]
    got = {r.page_id: tuple(r)[1:] for r in X.gallery_detail(spark.createDataFrame(pages, "page_id int, html string"), "page_id").collect()}
    assert got == {0: (None, "1", "2", "가;나"), 1: ("param_json", None, None, None), 2: ("param_missing", None, None, None), 3: ("names_missing", None, None, None), 4: ("param_missing", None, None, None)}
