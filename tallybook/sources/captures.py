"""Captured pages as a portal would have sent them, written from the given tables; the SQL of the rows runs unchanged in Spark and DuckDB.

Names are escaped, wrapped in tags and broken over lines, and some pages break one rule each, so that reading them back is a test of every rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators import extract as X
from tallybook.sources.ledger import frame

#: Rows a page, of lists and of registries.
LIMIT, REGISTRY_LIMIT = 20, 10

#: One row a line of a ledger list: the request, the values it must give back, its source, and the breach of its row and of its page, if any.
LEDGER_LINES = f"""SELECT *, '<tr' || attributes || '>' || td || '가공식품' || end_td || td || importer_name || end_td || td || '제품 ' || chr(10) || ' <b>' || CAST(p_partkey AS VARCHAR(20)) || '년</b>' || end_td || td
  || replace(replace(product_name_en, '&', '&amp;'), '<', '&lt;') || end_td || td || CASE WHEN row_breach = 'item_name' THEN '브랜디' ELSE '위스키' END || end_td || td || 'EST&#32;' || CAST(p_partkey % 10 AS VARCHAR(20)) || end_td
  || td || CASE WHEN row_breach = 'processed_date' THEN '2020-01-01' WHEN row_breach = 'processed_date_invalid' THEN '2026-02-30' ELSE day END || end_td || td || '2025-12-11 ~' || end_td || td || '영국' || end_td
  || CASE WHEN row_breach = 'anchor_count' THEN '<td>이탈리아</td>' WHEN row_breach = 'cell_count' THEN '' WHEN row_breach = 'rcno_differs' THEN replace(td, rcno, '999999999999') || '이탈리아' || end_td
      WHEN row_breach = 'detail_href' THEN replace(td, rcno, '12345') || '이탈리아' || end_td ELSE td || '이탈리아' || end_td END || '</tr>' AS raw_row
FROM (SELECT *, '<td><a class="x" href="javascript:fnFoodDetail(&#39;' || rcno || '&#39;);">' AS td, '</a></td>' AS end_td, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' class="odd > even"' ELSE ' data-n=''1''' END AS attributes,
  CASE WHEN page_breach IS NULL AND task % 4 = 1 AND page_no = 1 AND row_no = 2 + task % 7 THEN CASE task % 6 WHEN 0 THEN 'item_name' WHEN 1 THEN 'processed_date' WHEN 2 THEN 'processed_date_invalid' WHEN 3 THEN 'anchor_count'
    WHEN 4 THEN 'cell_count' ELSE CASE WHEN task % 8 = 5 THEN 'rcno_differs' ELSE 'detail_href' END END END AS row_breach
 FROM (SELECT *, CASE WHEN page_no = 1 AND task % 4 = 3 THEN CASE CAST(floor(task / 4) AS INTEGER) % 8 WHEN 0 THEN 'headers' WHEN 1 THEN 'echo_page' WHEN 2 THEN 'total_differs' WHEN 3 THEN 'navigation_pages' WHEN 4 THEN 'error_page'
      WHEN 5 THEN 'echo_item_code' WHEN 6 THEN 'row_source' ELSE 'form_count' END END AS page_breach
  FROM (SELECT *, CAST(floor((place - 1) / {LIMIT}) AS BIGINT) + 1 AS page_no, CAST((place - 1) % {LIMIT} AS BIGINT) + 1 AS row_no,
    lpad(CAST(p_partkey AS VARCHAR(20)), 12, '0') AS rcno, 'A&B ' || upper(p_name) || CASE WHEN p_partkey % 5 = 0 THEN ' <50ML' ELSE '' END AS product_name_en,
    'IMP ' || CAST(p_partkey % 20 AS VARCHAR(20)) AS importer_name, '2026-0' || CAST(1 + task % 9 AS VARCHAR(20)) || '-1' || CAST(task % 10 AS VARCHAR(20)) AS day
   FROM (SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS task, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS place, count(*) OVER (PARTITION BY p_size) AS total FROM part) a) b) c) d"""

REGISTRY_LINES = f"""SELECT *, CAST(floor((place - 1) / {REGISTRY_LIMIT}) AS BIGINT) + 1 AS page_no,
  '<tr><td><a href="javascript:fnDetailPopup1( &#39;' || code || '&#39; )">' || CAST(place AS VARCHAR(20)) || '</a></td><td>' || license_number || '</td><td> 업소 &amp; ' || CAST(s_suppkey AS VARCHAR(20)) || '</td><td>수입</td><td>대표</td><td>'
  || replace(s_address, '&', '&amp;') || '</td><td>기관</td></tr>' AS raw_row
FROM (SELECT s_suppkey, 'ADR ' || CAST(s_nationkey AS VARCHAR(20)) || ' & x' AS s_address, s_nationkey, 'C' || CAST(s_suppkey AS VARCHAR(20)) AS code, CASE WHEN s_nationkey = 7 AND place = 1 THEN '' ELSE 'L' || CAST(s_suppkey AS VARCHAR(20)) END AS license_number, place, total
 FROM (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS place, count(*) OVER (PARTITION BY s_nationkey) AS total FROM supplier) a) b"""

DETAIL_PAGES = """SELECT s_suppkey, '<table class="wide board_view"><caption>업소 기본정보</caption><tr><th>인허가번호</th><td>' || CASE WHEN s_suppkey % 10 = 9 THEN '' ELSE 'L' || CAST(s_suppkey AS VARCHAR(20)) END
  || '</td><th>업소명</th><td>업소 &lt;' || CAST(s_suppkey AS VARCHAR(20)) || '&gt;</td></tr><tr><th>대표자</th><td>' || CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE '' END || '</td><th>대표자명</th><td>B</td></tr><tr><th>허가일</th><td>2020-01-01</td>'
  || CASE WHEN s_suppkey % 3 = 0 THEN '<th>인허가일자</th><td>2021-01-01</td>' ELSE '' END || '</tr></table>' || CASE WHEN s_suppkey % 25 = 24 THEN '<table class="board_view"><caption>업소 기본정보</caption></table>' ELSE '' END AS html FROM supplier"""

GALLERY_DETAILS = """SELECT o_orderkey, '<script>var a = {}; var param = {"rcno" : " ' || CAST(o_orderkey AS VARCHAR(20)) || '","grpBsnLcnsLedgNo":"B' || CAST(o_custkey AS VARCHAR(20)) || '","bsshNm":"'
  || CASE WHEN o_orderkey % 7 = 3 THEN '' ELSE 'NAME;' || CAST(o_custkey AS VARCHAR(20)) END || '"' || CASE WHEN o_orderkey % 11 = 5 THEN ',' ELSE ', "n": {"x": 1}' END || '} ;</script>' AS html FROM orders"""


def _pages(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of a page in order, put together: a page has a bounded number of them."""
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "raw_row"))), lambda r: r["raw_row"]), "\n<!-- </tr> -->")
    # reading a page takes far longer than moving it, so pages are dealt to all cores, however few bytes they have
    cores = lines.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(max(cores, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys).groupBy(*keys).agg(rows.alias("rows"))


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def ledger_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task, page, html, item_name, item_code, process_date, page_limit, total_snapshot)."""
    d = _pages(frame(spark, sf_dir, LEDGER_LINES), ["task", "page_no", "total", "day", "page_breach"])
    bad = lambda name: F.coalesce(F.col("page_breach") == name, F.lit(False))
    field = lambda i, n, v: _text(f'<input type="hidden" id="{i}" name="{n}" value="', v, '"/>')
    total, page, pages = F.col("total"), F.col("page_no"), F.ceil(F.col("total") / LIMIT)
    inputs = F.concat(
        field("paramPage", "page", F.when(bad("echo_page"), page + 1).otherwise(page)), field("paramLimit", "limit", F.lit(LIMIT)), field("paramRpsntItmNm", "rpsntItmNm", F.lit("위스키")),
        field("paramItm", "rpsntItmCd", F.when(bad("echo_item_code"), "C2").otherwise("C1")), field("paramSrchStrtDt", "srchStrtDt", F.col("day")), field("paramSrchEndDt", "srchEndDt", F.col("day")),
        field("paramTotalCnt", "totalCnt", F.when(bad("total_differs"), total + 1).otherwise(total)),
    )
    heads = F.replace(F.lit("".join(f"<th scope='col'>{h}</th>" for h in X.HEADERS)), F.when(bad("headers"), F.lit("구분")).otherwise(F.lit("-")), F.when(bad("headers"), F.lit("분류")).otherwise(F.lit("-")))
    bar = F.when(pages > 1, _text('<p class="page_navi"><input class="number" value="', page, '"> / ', F.when(bad("navigation_pages"), pages + 1).otherwise(pages), "</p>")).otherwise("")
    html = _text(
        "<!DOCTYPE html><html><title>", F.when(bad("error_page"), "Error").otherwise("목록"), "</title><form ", F.when(bad("form_count"), "id='other'").otherwise("id='frm'"), ">", inputs, '</form><div class="board_count">총 <strong> ', total,
        '</strong>건</div>', bar, "<TABLE class='auto_title board_list'><thead><tr>", heads, "</tr></thead><tbody>", F.col("rows"), F.when(bad("row_source"), "<tr><td>").otherwise("</tbody></TABLE></html>"),
    )
    return d.select(
        "task", page.cast("int").alias("page"), html.alias("html"), F.lit("위스키").alias("item_name"), F.lit("C1").alias("item_code"), F.to_date("day").alias("process_date"), F.lit(LIMIT).alias("page_limit"), total.alias("total_snapshot"),
    )


def registry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation, page, html, page_limit, total_snapshot)."""
    d = _pages(frame(spark, sf_dir, REGISTRY_LINES), ["s_nationkey", "page_no", "total"])
    heads = "".join(f"<th>{h}</th>" for h in X.REGISTRY_HEADERS)
    html = _text(
        '<ul><li><div class="board_count">0</div></li><li><div class="board_count">총 <b>', F.format_number(F.col("total"), 0), f"</b> 건</div><table><caption>{X.REGISTRY_CAPTION}</caption><thead><tr>{heads}</tr></thead><tbody>",
        F.col("rows"), F.when(F.col("s_nationkey") == 3, "<tr><td>x</td></tr>").otherwise(""), "</tbody></table></li></ul>",
    )
    return d.select(F.col("s_nationkey").cast("long").alias("nation"), F.col("page_no").cast("int").alias("page"), html.alias("html"), F.lit(REGISTRY_LIMIT).alias("page_limit"), F.col("total").alias("total_snapshot"))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, DETAIL_PAGES)


def gallery_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, GALLERY_DETAILS)
