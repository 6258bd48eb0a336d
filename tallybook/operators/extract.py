"""Captured pages to rows: ledger lists, registry lists, detail tables and galleries, each with the contract that a page must meet.

A page that breaks its contract gives no rows; all its breaches are listed in the order in which they are judged, so the first one is the verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import html as H
from tallybook.functions.lineage import settled

#: Headers, version of the parser and phrases of the pages.
HEADERS = ("구분", "수입업체", "제품명(한글)", "제품명(영문)", "품목(유형)", "제조/작업/수출업소", "처리일자", "소비기한", "제조국", "수출국")
VERSION = "mfds-web-list/v1"
DETAIL = r"""^javascript:fnFoodDetail\(['"]([0-9]{12})['"]\);?$"""
ERROR_PHRASE, NO_DATA = "에러가 발생하였습니다", "조회 결과가 없습니다."
REGISTRY_HEADERS = ("번호", "인허가번호", "업소명", "업종", "대표자", "소재지", "인허가기관")
REGISTRY_CAPTION, DETAIL_CAPTION = "국내영업자 검색 조회 테이블", "업소 기본정보"
REGISTRY_CODE = r"""fnDetailPopup1\(\s*['"]([^'"]+)['"]\s*\)"""
GALLERY_CODE = r"""fnGalleryMobileDetail\(\s*['"]?([0-9]+)['"]?\s*\)"""
TOTAL = r"총\s*([0-9][0-9,]*)\s*건"
PARAM = r"(?s)var\s+param\s*=\s*(\{.*?\})\s*;"
#: Fields of a detail record and the labels that may name them, first non-empty one wins.
LABELS = {
    "license_number": ("인허가번호",), "business_name": ("업소명",), "representative": ("대표자", "대표자명"), "permit_date": ("허가일자", "인허가일자", "허가일", "인허가일"),
    "institution": ("인허가기관", "허가기관"), "address": ("주소",), "phone": ("연락처",), "industry": ("인허가 종류",), "operating_status": ("영업상태",),
}
FIELDS = (
    "product_division_name", "importer_name", "product_name_ko", "product_name_en", "item_name", "overseas_establishment_name", "processed_date_raw", "expiry_text",
    "manufacture_country_name", "export_country_name",
)


def only(found: Column) -> Column:
    """The first of an array, null where it is empty."""
    return F.try_element_at(found, F.lit(1))


def number(text: Column) -> Column:
    """A whole number not below zero, else null."""
    return F.when(text.rlike(r"^\+?[0-9]{1,18}$"), text.cast("long"))


def json_texts(values: Column) -> Column:
    """JSON array of texts with ``<``, ``>``, ``&`` and the line separators escaped, as the hashes have it."""
    out = F.to_json(values)
    for c in "&<>  ":
        out = F.replace(out, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return out


def semantic_sha256(key: Column, values: Column, version: str = VERSION) -> Column:
    """Digest of version, key and values: cosmetic changes of a page leave it, a changed value or a new version changes it."""
    return F.sha2(json_texts(F.concat(F.array(F.lit(version), key), values)), 256)


def ledger_facts(pages: DataFrame) -> DataFrame:
    """``pages`` (html and the request: item_name, item_code, process_date, page, page_limit, total_snapshot) with what a ledger page says."""
    h = F.coalesce("html", F.lit(""))
    target = lambda t: H.has_class(t, "board_list", "auto_title")
    d = settled(pages.withColumns({
        "is_error": F.exists(H.elements(h, "title"), lambda t: F.lower(H.text_of(t)) == "error") | H.text_of(h).contains(ERROR_PHRASE),
        "tables": H.elements(h, "table", target, unclosed=True), "forms": H.elements(h, "form", lambda t: H.attribute(t, "id") == "frm"),
        "counts": H.elements(h, "div", lambda t: H.has_class(t, "board_count")), "navs": H.elements(h, "p", lambda t: H.has_class(t, "page_navi")),
    }))
    table, form = only(F.col("tables")), only(F.col("forms"))
    parts = lambda name: F.filter("sections", lambda c: c["name"] == name)
    d = settled(d.withColumns({"sections": H.children(table, "thead", "tbody"), "inputs": H.start_tags(form, "input"), "strongs": H.elements(only(F.col("counts")), "strong")}))
    d = settled(d.withColumns({
        "theads": parts("thead"), "tbodies": parts("tbody"), "nav_inputs": F.filter(H.start_tags(only(F.col("navs")), "input"), lambda t: H.has_class(t, "number")),
        "nav_text": H.text_of(only(F.col("navs"))), "truncated": ~F.lower(F.trim(table)).endswith("</table>"),
        "visible": number(H.text_of(only(F.col("strongs")))),
        "hidden": F.filter("inputs", lambda t: H.attribute(t, "id") == "paramTotalCnt"),
    }))
    d = settled(d.withColumns({
        "headers": F.transform(H.elements(only(F.col("theads"))["source"], "th"), H.text_of), "raw_rows": H.elements(only(F.col("tbodies"))["source"], "tr"),
        "dom_rows": F.transform(H.children(only(F.col("tbodies"))["source"], "tr"), lambda r: r["source"]), "hidden_total": number(H.attribute(only(F.col("hidden")), "value")),
    }))
    anchors = lambda text, a: F.struct(text.alias("text"), F.size(a).alias("anchors"), H.attribute(only(a), "href").alias("href"))
    cell = lambda c: H.bound(H.start_tags(c["source"], "a"), lambda a: anchors(H.text_of(c["source"]), a))
    d = settled(d.withColumn("rows", F.transform("dom_rows", lambda r: F.transform(H.children(r, "td"), cell))))
    empty = H.children(only(F.col("dom_rows")), "td")
    marks = H.elements(only(empty)["source"], "span", lambda t: H.has_class(t, "nodata"))
    return settled(d.withColumn("no_data", (F.size("dom_rows") == 1) & (F.size(empty) == 1) & (H.attribute(only(empty)["tag"], "colspan") == "10") & (F.size(marks) == 1) & (H.text_of(only(marks)) == NO_DATA)))


def _echo(label: str, kind: str, name: str, value: Column) -> list[Column]:
    """Breaches of one echoed field: not exactly one input, or another value."""
    found = F.filter("inputs", lambda t: H.attribute(t, kind) == name)
    return [F.when(F.size(found) != 1, F.lit(f"echo_{label}_count")), F.when((F.size(found) == 1) & (H.attribute(only(found), "value") != value), F.lit(f"echo_{label}"))]


def _row_breach(row: Column, n: Column, item_name: Column, day: Column) -> Column:
    """The first breach of a ledger row, as ``row n: reason``."""
    code = lambda c: F.regexp_extract(c["href"], DETAIL, 1)
    judged = lambda c, k, first: F.when(c["anchors"] != 1, F.lit("anchor_count")).when(k == "", F.lit("detail_href")).when(k != first, F.lit("rcno_differs"))
    of_cell = H.bound(code(row[0]), lambda first: F.transform(row, lambda c: H.bound(code(c), lambda k: judged(c, k, first))))
    stated = row[6]["text"]
    reason = F.coalesce(
        F.when(F.size(row) != len(HEADERS), F.lit("cell_count")), only(F.array_compact(of_cell)),
        F.when(~stated.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") | stated.try_cast("date").isNull(), F.lit("processed_date_invalid")), F.when(stated.try_cast("date") != day, F.lit("processed_date")),
        F.when(row[4]["text"] != item_name, F.lit("item_name")),
    )
    return F.when(reason.isNotNull(), F.concat(F.lit("row "), (n + 1).cast("string"), F.lit(": "), reason))


def validate_ledger(facts: DataFrame) -> DataFrame:
    """``facts`` with total, total_pages and ``violations``: every breach of the page's contract, in order of judgement.

    Rules that need an element say nothing where it is missing: that has its own breach, judged before.
    """
    one = lambda c, name: F.when(F.size(c) != 1, F.lit(name))
    day = F.date_format("process_date", "yyyy-MM-dd")
    total = F.when(F.col("visible") == F.col("hidden_total"), F.col("visible"))
    d = settled(facts.withColumn("total", total).withColumn("total_pages", F.ceil(F.col("total") / F.col("page_limit")).cast("long")))
    many, nav = F.col("total") > 0, F.size("navs")
    stated_pages = F.regexp_extract("nav_text", r"/\s*([0-9]+)", 1)
    navigation = [
        F.when((F.col("total") == 0) & (nav > 0), F.lit("navigation_of_nothing")), F.when(many & (nav == 0) & (F.col("total") > F.col("page_limit")), F.lit("navigation_missing")),
        F.when(many & (nav > 1), F.lit("navigation_count")), F.when(many & (nav == 1) & (F.size("nav_inputs") != 1), F.lit("navigation_input_count")),
        F.when(many & (nav == 1) & (F.size("nav_inputs") == 1) & (H.attribute(only(F.col("nav_inputs")), "value") != F.col("page").cast("string")), F.lit("navigation_page")),
        F.when(many & (nav == 1) & ~F.coalesce(stated_pages.cast("long") == F.col("total_pages"), F.lit(False)), F.lit("navigation_pages")),
    ]
    page_level = [
        F.when(F.col("is_error"), F.lit("error_page")), one("tables", "table_count"), one("theads", "thead_count"), F.when(F.size("headers") != len(HEADERS), F.lit("header_count")),
        F.when((F.size("headers") == len(HEADERS)) & (F.col("headers") != F.array(*map(F.lit, HEADERS))), F.lit("headers")), one("forms", "form_count"),
        *_echo("page", "id", "paramPage", F.col("page").cast("string")), *_echo("limit", "id", "paramLimit", F.col("page_limit").cast("string")),
        *_echo("item_name", "id", "paramRpsntItmNm", F.col("item_name")), *_echo("item_code", "name", "rpsntItmCd", F.col("item_code")),
        *_echo("start_date", "id", "paramSrchStrtDt", day), *_echo("end_date", "id", "paramSrchEndDt", day),
        one("counts", "total_count"), F.when((F.size("counts") == 1) & (F.size("strongs") != 1), F.lit("total_strong_count")), F.when((F.size("strongs") == 1) & F.col("visible").isNull(), F.lit("total_visible")),
        one("hidden", "total_hidden_count"), F.when((F.size("hidden") == 1) & F.col("hidden_total").isNull(), F.lit("total_hidden")), F.when(F.col("visible") != F.col("hidden_total"), F.lit("total_differs")),
        F.when((F.col("page") > 1) & ~F.coalesce(F.col("total") == F.col("total_snapshot"), F.col("total").isNull()), F.lit("total_snapshot")),
        *navigation, one("tbodies", "tbody_count"), F.when(F.col("truncated") | (F.size("raw_rows") != F.size("dom_rows")), F.lit("row_source")), F.when((F.col("total") == 0) & ~F.col("no_data"), F.lit("no_data_shape")),
    ]
    rows = F.transform("rows", lambda r, n: _row_breach(r, n, F.col("item_name"), F.to_date("process_date")))
    rows = F.when(~F.coalesce(F.col("total") == 0, F.lit(False)), F.array_compact(rows))
    return settled(d.withColumn("violations", F.concat(F.array_compact(F.array(*page_level)), F.coalesce(rows, F.array().cast("array<string>")))))


def ledger_rows(validated: DataFrame, *keys: str) -> DataFrame:
    """Rows of the pages without violations: ``keys``, row_no, rcno, the ten values, detail_href, canonical JSON, the row's source and its hashes."""
    row = F.transform(F.arrays_zip("rows", "raw_rows"), lambda x: F.struct(F.transform(x["rows"], lambda c: c["text"]).alias("values"), x["rows"][0]["href"].alias("href"), x["raw_rows"].alias("raw_row")))
    good = validated.where((F.size("violations") == 0) & (F.col("total") > 0)).select(*keys, F.posexplode(row).alias("at", "r"))
    rcno = F.regexp_extract("r.href", DETAIL, 1)
    return good.select(
        *keys, (F.col("at") + 1).alias("row_no"), rcno.alias("rcno"), *[F.col("r.values")[i].alias(name) for i, name in enumerate(FIELDS)], F.col("r.href").alias("detail_href"),
        json_texts(F.col("r.values")).alias("canonical_json"), F.col("r.raw_row").alias("raw_row"), F.sha2("r.raw_row", 256).alias("raw_row_sha256"), semantic_sha256(rcno, F.col("r.values")).alias("semantic_sha256"),
    )


def ledger_warnings(validated: DataFrame, *keys: str) -> DataFrame:
    """Per page without violations: rows expected and parsed, whether they differ, and each key's repeats after its first row, in order."""
    codes = F.transform("rows", lambda r: F.regexp_extract(r[0]["href"], DETAIL, 1))
    expected = F.least(F.col("page_limit"), F.col("total") - (F.col("page") - 1) * F.col("page_limit")).cast("long")
    d = validated.where(F.size("violations") == 0).withColumn("codes", F.when(F.col("total") > 0, codes).otherwise(F.array().cast("array<string>")))
    repeats = F.filter("codes", lambda c, i: F.array_contains(F.slice(F.col("codes"), F.lit(1), i), c))
    return d.select(*keys, expected.alias("expected"), F.size("codes").alias("parsed"), (expected != F.size("codes")).alias("warned"), repeats.alias("repeated"))


def registry_rows(pages: DataFrame, *keys: str) -> DataFrame:
    """``pages`` (html, page, page_limit, total_snapshot) of the business registry: keys, total, the first breach or null, and its rows.

    ``rows`` is array<struct<row_number, code, license_number, business_name, industry, representative, address, institution>>, null on a breach.
    """
    captioned = lambda t: F.exists(H.elements(t, "caption"), lambda c: H.text_of(c).contains(REGISTRY_CAPTION))
    d = settled(pages.withColumn("h", F.coalesce("html", F.lit(""))).withColumn("tables", F.filter(H.elements(F.col("h"), "table"), captioned)))
    table = only(F.col("tables"))
    section = F.coalesce(only(F.filter(H.elements(F.col("h"), "li"), lambda x: x.contains(table))), F.col("h"))
    d = settled(d.withColumns({
        "headers": F.transform(H.elements(table, "th"), H.text_of), "counts": H.elements(section, "div", lambda t: H.has_class(t, "board_count")),
        "tbodies": H.children(table, "tbody"),
    }))
    stated = F.regexp_extract(H.text_of(only(F.col("counts"))), TOTAL, 1)
    d = settled(d.withColumns({"total": number(F.replace(stated, F.lit(","), F.lit(""))), "sources": F.transform(H.children(only(F.col("tbodies"))["source"], "tr"), lambda r: r["source"])}))
    cells = lambda r: F.transform(H.children(r, "td", "th"), lambda c: c["source"])

    def one(r: Column) -> Column:
        c = cells(r)
        anchors = H.start_tags(c[0], "a")
        code = F.when(F.size(anchors) == 1, F.trim(F.regexp_extract(H.attribute(only(anchors), "href"), REGISTRY_CODE, 1)))
        texts = F.transform(c, H.text_of)
        names = ("license_number", "business_name", "industry", "representative", "address", "institution")
        return F.struct(F.size(c).alias("cells"), number(texts[0]).alias("row_number"), code.alias("code"), *[F.try_element_at(texts, F.lit(i + 2)).alias(n) for i, n in enumerate(names)])

    d = settled(d.withColumn("parsed", F.transform("sources", one)))
    wanted = F.greatest(F.lit(0), F.least(F.col("page_limit"), F.col("total") - (F.col("page") - 1) * F.col("page_limit")))
    bad = F.exists("parsed", lambda r: (r["cells"] != len(REGISTRY_HEADERS)) | (F.coalesce(r["code"], F.lit("")) == "") | ~F.coalesce(r["row_number"] >= 1, F.lit(False)) | (r["license_number"] == "") | (r["business_name"] == ""))
    breach = F.coalesce(
        F.when(F.size("tables") != 1, F.lit("table_count")), F.when(F.size("headers") != len(REGISTRY_HEADERS), F.lit("header_count")), F.when(F.col("headers") != F.array(*map(F.lit, REGISTRY_HEADERS)), F.lit("headers")),
        F.when(F.size("counts") != 1, F.lit("total_count")), F.when(F.col("total").isNull(), F.lit("total")), F.when((F.col("page") > 1) & ~F.col("total").eqNullSafe(F.col("total_snapshot")), F.lit("total_snapshot")),
        F.when(F.size("tbodies") != 1, F.lit("tbody_count")), F.when((F.col("total") == 0) & ((F.size("sources") != 1) | ~H.text_of(only(F.col("sources"))).contains("조회 결과가 없습니다")), F.lit("no_data_shape")),
        F.when((F.col("total") > 0) & (F.size("sources") != wanted), F.lit("row_count")), F.when((F.col("total") > 0) & bad, F.lit("row_shape")),
    )
    d = settled(d.withColumn("violation", breach))
    rows = F.when(F.col("total") == 0, F.slice("parsed", 1, 0)).otherwise(F.col("parsed"))
    return d.select(*keys, "total", "violation", F.when(F.col("violation").isNull(), F.transform(rows, lambda r: r.dropFields("cells"))).alias("rows"))


def detail_record(pages: DataFrame, *keys: str) -> DataFrame:
    """``pages`` (html) with a label and value table: keys, the first breach or null, and one column a field of LABELS.

    Of a label that stands twice the last value counts; of labels that mean the same field the first non-empty one.
    """
    basic = lambda t: F.exists(H.elements(t, "caption"), lambda c: H.text_of(c).contains(DETAIL_CAPTION))
    d = pages.withColumn("tables", F.filter(H.elements(F.coalesce("html", F.lit("")), "table", lambda t: H.has_class(t, "board_view")), basic))
    d = settled(d)
    rows = F.transform(H.elements(only(F.col("tables")), "tr"), lambda r: F.transform(H.children(r, "td", "th"), lambda c: F.struct(c["name"].alias("name"), H.text_of(c["source"]).alias("text"))))
    d = settled(d.withColumn("cells", rows))
    pairs = F.flatten(F.transform("cells", lambda r: F.filter(F.transform(r, lambda c, i: F.struct(
        ((i % 2 == 0) & (c["name"] == "th") & (c["text"] != "") & (i + 1 < F.size(r))).alias("is_label"), c["text"].alias("key"), F.try_element_at(r, i + 2)["text"].alias("value"))), lambda x: x["is_label"])))
    d = settled(d.withColumn("pairs", F.reverse(pairs)))
    fields = F.map_from_entries(F.filter(F.transform("pairs", lambda p: F.struct(p["key"], p["value"])), lambda p, i: F.array_position(F.transform("pairs", lambda q: q["key"]), p["key"]) == i + 1))
    d = settled(d.withColumn("fields", fields))
    first = lambda labels: F.coalesce(*[F.nullif(F.try_element_at(F.col("fields"), F.lit(x)), F.lit("")) for x in labels], F.lit(""))
    d = settled(d.withColumns({name: F.when(F.size("tables") == 1, first(labels)) for name, labels in LABELS.items()}))
    breach = F.when(F.size("tables") != 1, F.lit("table_count")).when((F.col("license_number") == "") | (F.col("business_name") == ""), F.lit("names_missing"))
    return d.select(*keys, breach.alias("violation"), *[F.when(breach.isNull(), F.col(n)).alias(n) for n in LABELS])


def gallery_products(pages: DataFrame, *keys: str) -> DataFrame:
    """``pages`` (html, page, page_limit) of a gallery: keys, total, the first breach or null, and distinct products (code, name) in page order."""
    h = F.coalesce("html", F.lit(""))
    d = pages.withColumns({
        "count_texts": F.filter(F.transform(H.elements(h, "div", lambda t: H.has_class(t, "board_count")), H.text_of), lambda t: t.rlike(TOTAL)),
        "anchors": F.filter(H.elements(h, "a"), lambda a: H.attribute(only(H.start_tags(a, "a")), "href").rlike(GALLERY_CODE)),
    })

    def product(a: Column) -> Column:
        titles = H.elements(a, "strong", lambda t: H.has_class(t, "title"))
        return F.struct(F.regexp_extract(H.attribute(only(H.start_tags(a, "a")), "href"), GALLERY_CODE, 1).alias("code"), F.when(F.size(titles) == 1, H.text_of(only(titles))).otherwise("").alias("name"))

    d = settled(d)
    d = settled(d.withColumns({"total": F.replace(F.regexp_extract(only(F.col("count_texts")), TOTAL, 1), F.lit(","), F.lit("")).try_cast("long"), "found": F.transform("anchors", product)}))
    products = F.filter("found", lambda p, i: F.array_position(F.transform("found", lambda q: q["code"]), p["code"]) == i + 1)
    d = settled(d.withColumn("products", products))
    wanted = F.greatest(F.lit(0), F.least(F.col("page_limit"), F.col("total") - (F.col("page") - 1) * F.col("page_limit")))
    breach = F.when(F.col("total").isNull(), F.lit("total")).when(F.size("products") != wanted, F.lit("product_count"))
    return d.select(*keys, "total", breach.alias("violation"), F.when(breach.isNull(), F.col("products")).alias("products"))


def gallery_detail(pages: DataFrame, *keys: str) -> DataFrame:
    """``pages`` (html) with ``var param = {...};``: keys, the first breach or null, and rcno, internal_business_code and business_name of the object."""
    text = F.regexp_extract(F.coalesce("html", F.lit("")), PARAM, 1)
    parsed = F.from_json(F.nullif(text, F.lit("")), "rcno string, grpBsnLcnsLedgNo string, bsshNm string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    d = settled(pages.withColumns({"param": text, "o": parsed}))
    trimmed = {"rcno": "rcno", "internal_business_code": "grpBsnLcnsLedgNo", "business_name": "bsshNm"}
    d = settled(d.withColumns({name: F.trim(F.coalesce(F.col(f"o.{c}"), F.lit(""))) for name, c in trimmed.items()}))
    missing = (F.col("rcno") == "") | (F.col("internal_business_code") == "") | (F.col("business_name") == "")
    breach = F.when(F.col("param") == "", F.lit("param_missing")).when(F.col("o._bad").isNotNull(), F.lit("param_json")).when(missing, F.lit("names_missing"))
    return d.select(*keys, breach.alias("violation"), *[F.when(breach.isNull(), F.col(n)).alias(n) for n in trimmed])
