"""Ledger-shaped inputs over the given tables.  The SQL runs unchanged in Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names in two languages: 23 English and 13 Korean forms in all combinations, with numbers from the row.
ITEMS = """SELECT p_partkey AS item_id, lpad(CAST(p_partkey AS VARCHAR(20)), 12, '0') AS rcno,
  CASE p_partkey % 5 WHEN 0 THEN '위스키' WHEN 1 THEN '브랜디' WHEN 2 THEN '일반증류주' WHEN 3 THEN '리큐르' ELSE '와인' END AS item_name,
  CASE WHEN p_partkey % 41 = 40 THEN 'WHISKY' ELSE upper(p_name) END || CASE p_partkey % 23
    WHEN 0 THEN ' ' || CAST(100 + p_size * 10 AS VARCHAR(20)) || 'ML' WHEN 1 THEN ' ' || CAST(p_size AS VARCHAR(20)) || 'YO 1.75L'
    WHEN 2 THEN ' (' || CAST(p_size + 25 AS VARCHAR(20)) || '%) 500ml' WHEN 3 THEN ' 4,000ml' WHEN 4 THEN ' 250ML*' || CAST(p_size AS VARCHAR(20))
    WHEN 5 THEN ' SINGLE CASK #' || CAST(p_partkey AS VARCHAR(20)) || ' (59.1%)' WHEN 6 THEN ' BATCH ' || CAST(p_size AS VARCHAR(20)) || ' 700ml'
    WHEN 7 THEN ' ' || CAST(1930 + p_size * 2 AS VARCHAR(20)) WHEN 8 THEN ' ' || CAST(80 + p_size AS VARCHAR(20)) || ' PROOF'
    WHEN 9 THEN ' / 1107891, 1750mL, L5184' WHEN 10 THEN ' LIMITED EDITION 40% VOL' WHEN 11 THEN ' CASK STRENGHT 700ml'
    WHEN 12 THEN ' 15 YEARS OLD (700mL)(40%)(L514755B)' WHEN 13 THEN '' WHEN 14 THEN ', RESERVE (SHERRY) / 40% 700ml'
    WHEN 15 THEN ' CS #' || CAST(p_size AS VARCHAR(20)) || ' 700ml' WHEN 16 THEN ' VINTAGE 2008 RELEASE 2012' WHEN 17 THEN ' 700ml 50ml*2'
    WHEN 18 THEN ' 43% VOL ' || CAST(p_size + 44 AS VARCHAR(20)) || '% MORE' WHEN 19 THEN ' AGED 12 ' || CAST(p_size + 40 AS VARCHAR(20)) || '% VOL'
    WHEN 20 THEN ' (123456) LOT NO. A12-B' WHEN 21 THEN ' OLOROSO CASK NO.7 SERIES 3' ELSE ' EDITION #' || CAST(p_size AS VARCHAR(20)) END AS product_name_en,
  CASE floor(p_partkey / 23) % 13
    WHEN 1 THEN '글렌 12년 1.75L' WHEN 2 THEN '술 (43%) 500ml' WHEN 3 THEN '가이아나 2004' WHEN 4 THEN '위스키 (서울에디션) 42%'
    WHEN 5 THEN '쉐리 캐스크 스트랭스 구형' WHEN 6 THEN '인삼주(인삼0.45%, 향료0.02%) 150ml' WHEN 7 THEN '배치 No. ' || CAST(p_size AS VARCHAR(20)) || ' 700ml'
    WHEN 8 THEN '고량주 ' || CAST(p_size AS VARCHAR(20)) || '도' WHEN 9 THEN '발베니-700ML(제조번호 : L 0113953 2006)' WHEN 10 THEN '위스키'
    WHEN 11 THEN '조니 [선물 (면세)] 에디션 2 / 700ml' WHEN 12 THEN '바렐 스트랭스 (L A5B) (700ml' ELSE '' END AS product_name_ko,
  CASE WHEN p_partkey % 7 = 0 THEN '(주)' WHEN p_partkey % 7 = 1 THEN '주식회사 ' WHEN p_partkey % 7 = 2 THEN '㈜' WHEN p_partkey % 7 = 3 THEN '(유)' ELSE '' END || 'IMP' || CAST(p_partkey % 20 AS VARCHAR(20)) AS importer_name,
  CASE p_partkey % 11 WHEN 0 THEN '미등록국' WHEN 1 THEN '미국' WHEN 2 THEN '일본' WHEN 3 THEN '프랑스' WHEN 4 THEN '아일랜드' ELSE '영국' END AS manufacture_country_name,
  CASE p_partkey % 9 WHEN 0 THEN '-' WHEN 1 THEN '2025-06-03 ~' WHEN 2 THEN '2026-02-27 ~ 2026-08-26' WHEN 3 THEN '~ 2026-08-26' WHEN 4 THEN '2026-02-30 ~' WHEN 5 THEN '2025-06-03 ~ abc' ELSE ' ' END AS expiry_text,
  CAST(p_size AS INTEGER) AS p_size, p_brand,
  CASE WHEN p_partkey % 37 <> 5 THEN CAST(DATE '2025-01-01' + CAST(p_partkey % 400 AS INTEGER) AS DATE) END AS processed_date,
  CASE WHEN p_partkey % 31 = 7 THEN NULL WHEN p_partkey % 2 = 0 THEN '위스키' ELSE '브랜디' END AS queried_item_name
FROM part"""

OBSERVATIONS = """SELECT event_id AS item_id, user_id AS rcno, ts AS observed_at, CAST(ts AS DATE) AS processed_date,
  event_type AS queried_item_name, event_type || ':' || CAST(CAST(floor(value / 100) AS BIGINT) AS VARCHAR(20)) AS semantic_text,
  CAST(ts AS DATE) AS task_id, 1 + event_id % 2 AS attempt_no
FROM events"""

KEYS = """SELECT DISTINCT CAST(l.l_orderkey % 100 AS BIGINT) AS task_id, CAST(a.attempt AS INTEGER) AS attempt, l.l_returnflag AS item_code, l.l_partkey AS rcno
FROM lineitem l CROSS JOIN (SELECT 1 AS attempt UNION ALL SELECT 2 UNION ALL SELECT 3) a
WHERE NOT (a.attempt = 2 AND (l.l_partkey + l.l_orderkey % 100) % 17 = 0)"""

PAGES = """SELECT task_id, attempt, item_code, page_no, 'PARSED' AS status,
  CAST(COUNT(*) AS BIGINT) AS parsed_rows,
  CAST(max(total) + CASE WHEN task_id % 9 = 0 AND attempt = 1 THEN 1 ELSE 0 END AS BIGINT) AS total
FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY task_id, attempt, item_code ORDER BY rcno) - 1) / 2) AS INTEGER) + 1 AS page_no,
        count(*) OVER (PARTITION BY task_id, attempt, item_code) AS total FROM syn_keys) k
GROUP BY task_id, attempt, item_code, page_no"""

REGISTRY = """SELECT lpad(CAST(s_suppkey AS VARCHAR(20)), 10, '0') AS code,
  'IMP' || CAST(s_suppkey - CASE WHEN s_suppkey % 3 = 2 THEN 1 ELSE 0 END AS VARCHAR(20)) AS business_name
FROM supplier"""

DECLARED = """SELECT CAST(o_orderkey AS BIGINT) AS rcno, 'IMP' || CAST(o_custkey AS VARCHAR(20)) AS business_name,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS process_date
FROM orders"""

GALLERY = """SELECT CAST(o_orderkey AS BIGINT) AS rcno, 'IMP' || CAST(o_custkey AS VARCHAR(20)) AS business_name,
  lpad(CAST(o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS VARCHAR(20)), 10, '0') AS code
FROM orders WHERE o_orderkey % 2 = 0"""


TABLES = ("part", "events", "lineitem", "orders", "supplier", "pages", "customer")


def frame(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """A ledger-shaped frame; tables that the SQL reads come from sf_dir.  Nothing is registered in the session."""
    found = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)} | given
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in found:
        sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)
    return spark.sql(sql, **found)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items dealt to all cores where the table has fewer splits: the rules on names cost far more than moving the names."""
    found, cores = frame(spark, sf_dir, ITEMS), spark.sparkContext.defaultParallelism
    return found if found.rdd.getNumPartitions() >= cores else found.repartition(cores)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, OBSERVATIONS)


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of KEYS; a key is made distinct once, before it is told to the attempts that hold it."""
    seen = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((F.col("l_orderkey") % 100).cast("long").alias("task_id"), F.col("l_returnflag").alias("item_code"), F.col("l_partkey").alias("rcno")).distinct()
    lost = F.coalesce((F.col("rcno") + F.col("task_id")) % 17 == 0, F.lit(True))
    held = F.when(lost, F.array(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3)))
    return seen.select("task_id", F.explode(held).alias("attempt"), "item_code", "rcno")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of PAGES: a scan's pages follow from the number of its keys, so no scan is sorted."""
    group = ["task_id", "attempt", "item_code"]
    n, page = F.col("n"), F.col("page_no")
    scans = keys(spark, sf_dir).groupBy(*group).agg(F.count("*").alias("n"))
    found = scans.select(*group, "n", F.explode(F.sequence(F.lit(1), F.ceil(n / 2).cast("int"))).alias("page_no"))
    more = F.when((F.col("task_id") % 9 == 0) & (F.col("attempt") == 1), 1).otherwise(0)
    return found.select(*group, "page_no", F.lit("PARSED").alias("status"), F.least(F.lit(2), n - (page - 1) * 2).cast("long").alias("parsed_rows"), (n + more).cast("long").alias("total"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, REGISTRY)


def declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, DECLARED)


def gallery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, GALLERY)


ALCOHOLS = """SELECT CAST(min(p_partkey) + 1 AS BIGINT) AS id, '' AS kor_name, p_name AS eng_name, CAST(40 + min(p_size) % 3 AS DOUBLE) AS abv_percent, '' AS type,
  CASE WHEN min(p_partkey) % 10 = 9 THEN 'Brandy' ELSE 'Whisky' END AS category, CAST(100 + min(p_partkey) % 25 AS BIGINT) AS region_id, CAST(min(CAST(substring(p_brand, 7) AS INTEGER)) AS BIGINT) AS distillery_id,
  '' AS age, CAST(CASE WHEN min(p_partkey) % 2 = 0 THEN 12 ELSE NULL END AS INTEGER) AS age_years, '' AS cask, CASE WHEN min(p_partkey) % 3 = 0 THEN '70cl' ELSE '' END AS volume, CAST(NULL AS TIMESTAMP) AS deleted_at
FROM part GROUP BY p_name"""

DISTILLERIES = """SELECT CAST(substring(p_brand, 7) AS BIGINT) AS id, '' AS kor_name, min(split_part(p_name, ' ', 1)) AS eng_name FROM part GROUP BY p_brand"""

REGIONS = """SELECT CAST(100 + s_nationkey AS BIGINT) AS id, '' AS kor_name, 'nation ' || CAST(s_nationkey AS VARCHAR(20)) AS eng_name, CAST(1 + s_nationkey % 5 AS BIGINT) AS parent_id FROM supplier GROUP BY s_nationkey
UNION ALL SELECT CAST(1 + s_nationkey % 5 AS BIGINT), '', 'region ' || CAST(s_nationkey % 5 AS VARCHAR(20)), CAST(0 AS BIGINT) FROM supplier GROUP BY s_nationkey % 5"""

WANTED = """SELECT CAST(p_partkey AS BIGINT) AS input_id, '' AS base_name_ko,
  CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' reserve' WHEN 2 THEN split_part(p_name, ' ', 1) WHEN 3 THEN 'single malt' ELSE p_name || ' 12yo' END AS base_name_en, '' AS search_name_ko, '' AS search_name_en,
  CAST(40 + p_size % 4 AS DOUBLE) AS abv_percent, '' AS age, CAST(NULL AS INTEGER) AS age_years, '' AS cask, '' AS edition, CASE WHEN p_partkey % 4 = 0 THEN '브랜디' ELSE '위스키' END AS category,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN 700 ELSE NULL END AS INTEGER) AS unit_volume_ml, 'Region ' || CAST(p_partkey % 7 AS VARCHAR(20)) AS manufacture_country
FROM part"""


def references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(alcohols, distilleries, regions)."""
    return frame(spark, sf_dir, ALCOHOLS), frame(spark, sf_dir, DISTILLERIES), frame(spark, sf_dir, REGIONS)


def wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt to all cores like ``items``: a row can have many candidates."""
    found, cores = frame(spark, sf_dir, WANTED), spark.sparkContext.defaultParallelism
    return found if found.rdd.getNumPartitions() >= cores else found.repartition(cores)
