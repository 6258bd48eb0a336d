"""Registered queries on captured pages.  The oracles give the values from which the pages were written, and the breaches put into them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import extract
from tallybook.sources import captures
from tallybook.sources.captures import LIMIT

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_LINES = f"WITH lines AS ({captures.LEDGER_LINES}), good AS (SELECT *, max(coalesce(page_breach, row_breach)) OVER (PARTITION BY task, page_no) AS breach FROM lines) "
_VALUES = "'가공식품', importer_name, '제품 ' || CAST(p_partkey AS VARCHAR) || '년', product_name_en, '위스키', 'EST ' || CAST(p_partkey % 10 AS VARCHAR), day, '2025-12-11 ~', '영국', '이탈리아'"


def _validated(spark, d):
    return extract.validate_ledger(extract.ledger_facts(captures.ledger_pages(spark, d)))


@query(_LINES + f"""SELECT task, page_no AS page, CAST(row_no AS INTEGER) AS row_no, rcno, importer_name, '제품 ' || CAST(p_partkey AS VARCHAR) || '년' AS product_name_ko, product_name_en, day AS processed_date_raw, 'EST ' || CAST(p_partkey % 10 AS VARCHAR) AS overseas_establishment_name,
 'javascript:fnFoodDetail(''' || rcno || ''');' AS detail_href, raw_row, sha256(raw_row) AS raw_row_sha256 FROM good WHERE breach IS NULL""")
def a1_ledger_rows(spark, d):
    """Rows and verbatim sources of the ledger's pages (A1, A2)."""
    rows = extract.ledger_rows(_validated(spark, d), "task", "page")
    return rows.select("task", "page", "row_no", "rcno", "importer_name", "product_name_ko", "product_name_en", "processed_date_raw", "overseas_establishment_name", "detail_href", "raw_row", "raw_row_sha256")


@query(_LINES + f"""SELECT rcno, sha256(replace(replace(replace(CAST(to_json(['mfds-web-list/v1', rcno, {_VALUES}]) AS VARCHAR), '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e')) AS semantic_sha256 FROM good WHERE breach IS NULL""")
def a3_semantic_hash(spark, d):
    """Digest of version, key and values of every row."""
    return extract.ledger_rows(_validated(spark, d), "task").select("rcno", "semantic_sha256")


@query(_LINES + f""", p AS (SELECT task, page_no AS page, max(total) AS total, any_value(page_breach) AS page_breach, max(CASE WHEN row_breach IS NOT NULL THEN 'row ' || CAST(row_no AS VARCHAR) || ': ' || row_breach END) AS row_breach FROM lines GROUP BY 1, 2)
 SELECT task, page, 0 AS position, CASE page_breach WHEN 'form_count' THEN 'form_count' ELSE page_breach END AS reason FROM p WHERE page_breach IS NOT NULL
 UNION ALL SELECT task, page, 0, row_breach FROM p WHERE row_breach IS NOT NULL""")
def a4_page_violations(spark, d):
    """The verdict on every page that breaks its contract: its first breach."""
    return _validated(spark, d).select("task", "page", F.posexplode("violations").alias("position", "reason")).where("position = 0")


@query(_LINES + f""", p AS (SELECT task, page_no AS page, max(total) AS total, count(*) AS n FROM good WHERE breach IS NULL GROUP BY 1, 2)
 SELECT task, page, least({LIMIT}, total - (page - 1) * {LIMIT}) AS expected, CAST(n AS INTEGER) AS parsed, false AS warned, 0 AS repeated FROM p""")
def a5_ledger_warnings(spark, d):
    """Rows expected and parsed of every valid page, and keys that it repeats."""
    return extract.ledger_warnings(_validated(spark, d), "task", "page").withColumn("repeated", F.size("repeated"))


_REGISTRY = f"WITH lines AS ({captures.REGISTRY_LINES}), good AS (SELECT *, CASE WHEN s_nationkey = 3 THEN 'row_count' WHEN bool_or(license_number = '') OVER (PARTITION BY s_nationkey, page_no) THEN 'row_shape' END AS breach FROM lines) "


@query(_REGISTRY + """SELECT CAST(s_nationkey AS BIGINT) AS nation, page_no AS page, max(total) AS total, any_value(breach) AS violation, CASE WHEN any_value(breach) IS NULL THEN count(*) END AS n_rows,
 CASE WHEN any_value(breach) IS NULL THEN string_agg(CAST(place AS VARCHAR) || '|' || code || '|' || license_number || '|업소 & ' || CAST(s_suppkey AS VARCHAR) || '|' || s_address, ';' ORDER BY place) END AS listed FROM good GROUP BY 1, 2""")
def a6_registry_rows(spark, d):
    """Rows of the business registry's pages, or the breach of a page."""
    pages = extract.registry_rows(captures.registry_pages(spark, d), "nation", "page")
    line = F.transform("rows", lambda r: F.concat_ws("|", r["row_number"].cast("string"), r["code"], r["license_number"], r["business_name"], r["address"]))
    return pages.select("nation", "page", "total", "violation", F.when(F.col("rows").isNotNull(), F.size("rows").cast("long")).alias("n_rows"), F.array_join(line, ";").alias("listed"))


@query("""WITH r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 25 = 24 THEN 'table_count' WHEN s_suppkey % 10 = 9 THEN 'names_missing' END AS violation FROM supplier)
 SELECT s_suppkey, violation, CASE WHEN violation IS NULL THEN 'L' || CAST(s_suppkey AS VARCHAR) END AS license_number, CASE WHEN violation IS NULL THEN '업소 <' || CAST(s_suppkey AS VARCHAR) || '>' END AS business_name,
 CASE WHEN violation IS NULL THEN CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END END AS representative, CASE WHEN violation IS NULL THEN CASE WHEN s_suppkey % 3 = 0 THEN '2021-01-01' ELSE '2020-01-01' END END AS permit_date FROM r""")
def a7_detail_record(spark, d):
    """Label and value tables as records, labels by synonym."""
    return extract.detail_record(captures.detail_pages(spark, d), "s_suppkey").select("s_suppkey", "violation", "license_number", "business_name", "representative", "permit_date")


@query("""WITH r AS (SELECT *, CASE WHEN o_orderkey % 11 = 5 THEN 'param_json' WHEN o_orderkey % 7 = 3 THEN 'names_missing' END AS violation FROM orders)
 SELECT o_orderkey, violation, CASE WHEN violation IS NULL THEN CAST(o_orderkey AS VARCHAR) END AS rcno, CASE WHEN violation IS NULL THEN 'B' || CAST(o_custkey AS VARCHAR) END AS internal_business_code,
 CASE WHEN violation IS NULL THEN 'NAME;' || CAST(o_custkey AS VARCHAR) END AS business_name FROM r""")
def a8_gallery_detail(spark, d):
    """The object in a gallery page's script."""
    return extract.gallery_detail(captures.gallery_details(spark, d), "o_orderkey")
