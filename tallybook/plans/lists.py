"""Registered queries on lists of declarations and importers, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from tallybook.operators import lists, quality
from tallybook.sources import ledger

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Declarations over the items: some linked to one of 150 importers, some with candidates.
DECLS = f"""SELECT item_id AS source_item_id, rcno, item_name, product_name_ko, product_name_en, CASE WHEN item_id % 6 = 0 THEN product_name_ko END AS base_name_ko, CASE WHEN item_id % 4 = 0 THEN p_brand WHEN item_id % 4 = 1 THEN ' ' END AS base_name_en,
  importer_name, manufacture_country_name, processed_date, CASE WHEN item_id % 3 > 0 THEN CAST(1 + item_id % 150 AS BIGINT) END AS importer_id,
  CASE WHEN item_id % 2 = 0 THEN item_id END AS alcohol_candidate_1_id, CASE WHEN item_id % 5 < 2 THEN p_size END AS distillery_candidate_1_id, CASE WHEN item_id % 7 > 0 THEN p_size END AS region_candidate_1_id
FROM ({ledger.ITEMS}) i"""
ENTRIES = """SELECT CAST(s_suppkey AS BIGINT) AS importer_id, lpad(CAST(s_suppkey AS VARCHAR(20)), 10, '0') AS code, s_name AS business_name, 'L' || CAST(s_suppkey * 7 AS VARCHAR(20)) AS license_number,
  CASE WHEN s_suppkey % 2 = 0 THEN 'owner_' || CAST(s_nationkey AS VARCHAR(20)) END AS representative, 'street ' || CAST(s_nationkey AS VARCHAR(20)) AS address, CASE WHEN s_suppkey % 9 = 0 THEN 'CLOSED' ELSE 'OPEN' END AS operating_status FROM supplier"""
TEXTS = ("rcno", "product_name_ko", "product_name_en", "importer_name", "item_name")


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _open(spark, d):
    """Linked declarations of the year, without a maker's candidate but with a product's."""
    return lists.find_declarations(ledger.frame(spark, d, DECLS), "0", TEXTS, link="linked", first="2025-03-01", last="2025-12-31", matches={"alcohol": "matched", "distillery": "unmatched"})


_OPEN = f"""WITH d AS ({DECLS}), f AS (SELECT * FROM d WHERE concat_ws(chr(1), rcno, product_name_ko, product_name_en, importer_name, item_name) LIKE '%0%'
 AND importer_id IS NOT NULL AND processed_date BETWEEN DATE '2025-03-01' AND DATE '2025-12-31' AND alcohol_candidate_1_id IS NOT NULL AND distillery_candidate_1_id IS NULL) """


@query(_OPEN + "SELECT source_item_id, rcno, processed_date, importer_id FROM f")
def h5_filtered_declarations(spark, d):
    return _open(spark, d).select("source_item_id", "rcno", "processed_date", "importer_id")


@query(f"WITH d AS ({DECLS}) SELECT source_item_id, rcno, processed_date, region_candidate_1_id FROM d ORDER BY region_candidate_1_id IS NOT NULL, processed_date DESC NULLS LAST, source_item_id DESC LIMIT 50 OFFSET 100")
def h6_sorted_page(spark, d):
    """The limit is the feature: the third page of fifty."""
    page = quality.page(ledger.frame(spark, d, DECLS), lists.declaration_order("region", descending=False), 3, 50)
    return page.select("source_item_id", "rcno", "processed_date", "region_candidate_1_id")


@query(_OPEN + "SELECT 2 AS page, 30 AS page_size, count(*) AS total, CAST(floor((count(*) + 29) / 30) AS BIGINT) AS total_pages FROM f")
def h6_page_info(spark, d):
    return lists.page_info(_open(spark, d), 2, 30)


@query(f"""WITH r AS ({ENTRIES}), d AS ({DECLS}), n AS (SELECT *, CASE WHEN trim(base_name_ko) <> '' THEN trim(base_name_ko) WHEN trim(base_name_en) <> '' THEN trim(base_name_en) WHEN trim(product_name_ko) <> '' THEN trim(product_name_ko)
 WHEN trim(product_name_en) <> '' THEN trim(product_name_en) WHEN trim(item_name) <> '' THEN trim(item_name) ELSE '이름 미정' END product FROM d)
 SELECT r.*, count(n.rcno) declarations, count(DISTINCT product) products, coalesce(strftime(min(processed_date), '%Y-%m-%d'), '') first_day, coalesce(strftime(max(processed_date), '%Y-%m-%d'), '') last_day
 FROM r LEFT JOIN n ON n.importer_id = r.importer_id WHERE operating_status = 'OPEN' AND (representative LIKE '%=_1%' ESCAPE '=' OR business_name LIKE '%=_1%' ESCAPE '=' OR r.code LIKE '%=_1%' ESCAPE '=' OR license_number LIKE '%=_1%' ESCAPE '=' OR address LIKE '%=_1%' ESCAPE '=') GROUP BY ALL""")
def h11_importer_entries(spark, d):
    return lists.importer_entries(ledger.frame(spark, d, ENTRIES), ledger.frame(spark, d, DECLS), "_1", equal={"operating_status": "OPEN"})


@query(f"""WITH r AS ({ENTRIES}), d AS ({DECLS}) SELECT r.importer_id, business_name, count(*) declarations FROM r JOIN d USING (importer_id) GROUP BY ALL""")
def h11_matched_importers(spark, d):
    return lists.importer_entries(ledger.frame(spark, d, ENTRIES), ledger.frame(spark, d, DECLS), matched_only=True).select("importer_id", "business_name", "declarations")
