import itertools

import pytest
from pyspark.sql import functions as F

from tallybook.functions.text import search_key
from tallybook.operators import derive, features, importers, names, normalize, quality

NAMES = "product_name_ko string, product_name_en string"

STRENGTHS = [
    # ko, en, ingredient, strength, reasons
    ("인삼향 리큐르 인삼0.45% 주도38% 700ml", None, 0.45, 38.0, "ABV_COMPOSITION_CONTEXT"),
    ("인삼 리큐르 인삼0.45%", "GINSENG LIQUEUR 0.45% 700ml", 0.45, None, "ABV_COMPOSITION_CONTEXT,ABV_AMBIGUOUS_POSITION"),
    ("동북삼보주(주도38%)", None, None, 38.0, ""),
    ("위스키 40%", "WHISKY 43% VOL", None, None, "ABV_CONFLICT_BETWEEN_LANGUAGES"),
    (None, "WHISKY 85% VOL", None, None, "ABV_OUT_OF_AUTOMATIC_RANGE"),
    (None, "WHISKY 20% MORE FREE", None, None, "ABV_AMBIGUOUS_POSITION"),
    (None, "W 43% VOL 20% MORE", None, 43.0, "ABV_AMBIGUOUS_POSITION"),
    (None, "W 40% 700ml 43% VOL", None, 40.0, "ABV_AMBIGUOUS_POSITION"),
    (None, "LOW LIQUOR 42%", None, 42.0, ""),
    (None, "KILCHOMAN 100% ISLAY", 100.0, None, "ABV_COMPOSITION_CONTEXT"),
    ("고량주 58도", "", None, 58.0, ""),
    ("인삼주(인삼0.45%, 향료0.02%) 150ml", None, None, None, "ABV_COMPOSITION_CONTEXT,INGREDIENT_PERCENT_MULTIPLE_VALUES"),
    (None, None, None, None, ""),
    ("", "", None, None, ""),
    ("위스키 " * 5000 + "40%", None, None, 40.0, ""),
]


def test_strength(spark):
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(STRENGTHS)], f"i int, {NAMES}")
    got = derive.with_strength(df).orderBy("i").collect()
    assert [(r.ingredient_percent, r.abv_percent, ",".join(r.abv_reasons)) for r in got] == [r[2:] for r in STRENGTHS]
    assert derive.with_strength(df.limit(0)).count() == 0


#: ko, en, and what must come out.
GOLDEN = [
    ("대용량 위스키 4,000ml", "", {"unit_volume_ml": 4000, "display_name_ko": "대용량 위스키 4000ml"}),
    ("고량주 250ML*2", "", {"unit_volume_ml": 250, "package_count": 2, "display_name_ko": "고량주 250ml × 2"}),
    ("가쿠빈 1920ML", "", {"unit_volume_ml": 1920, "vintage_year": None}),
    ("몽키숄더-700ML(LOT NO. L 0111613 2605)", "", {"lot_code": "L 0111613 2605"}),
    ("발베니 12년-700ML(제조번호 : L 0113953 2006)", "", {"manufacture_no": "L 0113953 2006", "vintage_year": None}),
    ("글렌알라키 15년 구형", "GLENALLACHIE 15 YEAR OLD", {"version_marker": "구형", "base_name_en": "GLENALLACHIE", "age_years": 15}),
    ("싱글 몰트 스카치 위스키 / 135066GX0700615", "", {"material_code": "135066GX0700615", "base_name_ko": "싱글 몰트 스카치 위스키"}),
    ("조니워커 700ml (778061) L5293CA009", "", {"material_code": "778061", "lot_code": "L5293CA009"}),
    ("술 / 1107891", "(123456) GIN", {"material_code": "123456"}),
    ("글렌알라키 싱글캐스크 (59.1%) (#9485)", "", {"cask_number": "9485", "abv_percent": 59.1}),
    ("라벨 5 블렌디드 스카치 위스키 (700mL)(40%)(L514755B)", "", {"unit_volume_ml": 700, "abv_percent": 40.0, "lot_code": "L514755B", "display_name_ko": "라벨 5 블렌디드 스카치 위스키 700ml 40%"}),
    ("푸쉬킨 너츠 & 누가 (천연향료(누가향1.03%,헤일즐넛향0.02%)함유)", "", {"display_name_ko": "푸쉬킨 너츠 & 누가 (천연향료(누가향1.03%,헤일즐넛향0.02%)함유)"}),
    ("가쿠빈(1920ml, L A5B)", "", {"unit_volume_ml": 1920, "lot_code": "L A5B", "normalization_status": "NORMALIZED"}),
    ("리차드 헤네시 / 1107891, 1750mL, L5184", "", {"unit_volume_ml": 1750, "material_code": "1107891", "lot_code": "L5184"}),
    ("동북삼보주(주도38%)", "", {"base_name_ko": "동북삼보주", "display_name_ko": "동북삼보주(주도38%)"}),
    ("벤로막 2003 스몰배치 에디션 #1 (700mL) (56%) (02/12/2025)", "BENROMACH 2023 SMALL BATCH EDITION #1", {"batch_number": None, "variant_marker_type": "EDITION_NUMBER", "variant_marker_raw": "#1", "edition_name": "에디션 #1"}),
    ("싱글 캐스크 #9485 700ml", "", {"variant_marker_type": "CASK_NUMBER"}), ("배치 #03", "", {"variant_marker_type": "BATCH_NUMBER", "batch_number": "3"}),
    ("에디션 No. 2", "", {"variant_marker_type": "EDITION_NUMBER"}), ("위스키 @001", "", {"variant_marker_type": "SERIES_NUMBER"}), ("위스키 #77", "", {"variant_marker_type": "UNKNOWN", "normalization_status": "REVIEW_REQUIRED"}),
    ("위스키 CS 700ml", "WHISKY CASK STRENGTH", {"strength_type": "CASK STRENGTH"}), ("", "WHISKY CS 700ml", {"strength_type": None, "variant_marker_type": "STRENGTH_ABBREVIATION"}),
    ("", "WHISKY FULL STRENGTH 700ml", {"strength_type": None}), ("", "WHISKY N° 7", {"variant_marker_type": None}), ("", "WHISKY 33°", {"abv_percent": None}),
    ("", "VINTAGE 2008 RELEASE 2012", {"vintage_year": 2008}), ("", "DON JULIO 1942", {"vintage_year": None}), ("", "GLEN 2008 43% VOL", {"vintage_year": 2008}),
    ("", "WHISKY EDITION 700ml", {"edition_name": "EDITION"}), ("에디션 2 700ml", "", {"edition_name": "에디션 2"}),
    ("", "WHISKY CS #77 700ml", {"variant_marker_type": "UNKNOWN", "variant_marker_raw": "#77"}),
    ("", "WHISKY, RESERVE (SHERRY) / 40% 700ml", {"base_name_en": "WHISKY, RESERVE (SHERRY)"}),
    ("위스키", "", {"sku_key": None, "normalization_status": "REVIEW_REQUIRED"}), ("일반 증류주", "", {"sku_key": None, "normalization_status": "REVIEW_REQUIRED"}),
    ("", "", {"normalization_status": "UNPARSED", "sku_key": None}), (None, None, {"normalization_status": "UNPARSED"}),
    ("위스키 " * 3000 + "700ml", None, {"unit_volume_ml": 700}),
]


def test_golden_names(spark):
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(GOLDEN)], f"item_id int, {NAMES}")
    got = normalize.normalize(df).orderBy("item_id").collect()
    wrong = [(r.product_name_ko, r.product_name_en, k, r[k], v) for r, (_, _, want) in zip(got, GOLDEN) for k, v in want.items() if r[k] != v]
    assert not wrong
    for r in got:  # brackets stay paired, no separator is left over
        for name in (r.display_name_ko, r.display_name_en, r.base_name_ko, r.base_name_en, r.alcohol_name_ko, r.alcohol_name_en):
            assert name.count("(") == name.count(")") and "()" not in name and ",," not in name and not name.startswith((",", "/")) and not name.endswith((",", "/"))


def test_keys_conflicts_and_segments(spark):
    rows = ["고량주 250ml × 20 (LOT NO. A1234)", "고량주 250ml × 36 (LOT NO. B99)", "고량주 250ml 58%"]
    conflicts = [("배치 2", "BATCH 3", "BATCH_VALUE_CONFLICT"), ("에디션 2", "EDITION 3", "EDITION_VALUE_CONFLICT"), ("12년", "15YO", "AGE_CONFLICT_BETWEEN_LANGUAGES")]
    df = spark.createDataFrame([(i, k, None) for i, k in enumerate(rows)] + [(10 + i, k, e) for i, (k, e, _) in enumerate(conflicts)], f"item_id int, {NAMES}")
    got = {r.item_id: r for r in normalize.normalize(df, "sku_key", "review_reasons", "unparsed_fragments").collect()}
    assert got[0].sku_key == got[1].sku_key != got[2].sku_key and got[0].sku_key
    for i, (_, _, reason) in enumerate(conflicts):
        assert reason in got[10 + i].review_reasons and got[10 + i].unparsed_fragments
    texts = ["(a(b)c) x [700ml]", "a (b", "a (b (c) d", "x ) y", "", "[a (b] c) d"]
    one = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", names.segments(F.col("t")).alias("s")).orderBy("i").collect()
    assert [[(x.text, x.is_group) for x in r.s] for r in one] == [
        [("(a(b)c)", True), (" x ", False), ("[700ml]", True)], [("a (b", False)], [("a (b (c) d", False)], [("x ) y", False)], [], [("[a (b]", True), (" c) d", False)],
    ]


def test_edition_cask_keys(spark):
    df = spark.createDataFrame([(0, "에디션 2 700ml", "EDITION 3"), (1, "", "WHISKY EDITION 700ml"), (2, "PX 쉐리 캐스크", "OLOROSO  CASK"), (3, None, None)], f"i int, {NAMES}")
    ko, en = F.col("product_name_ko"), F.col("product_name_en")
    got = df.select("i", normalize.parse_edition(ko, en).alias("e"), derive.cask_type(ko, en).alias("c")).orderBy("i").collect()
    assert [(r.e.name, r.e.conflict, r.c) for r in got] == [("에디션 2", True, None), ("EDITION", False, None), (None, False, "OLOROSO CASK"), (None, False, None)]
    key = lambda e: spark.range(1).select(derive.canonical_korean(search_key(F.lit("셰리 스트랭스 피니쉬 바렐")), F.lit(e)).alias("k")).first().k
    assert (key("X"), key("")) == ("쉐리 스트렝스 피니시 배럴", "셰리 스트랭스 피니쉬 바렐")
    generic = spark.createDataFrame([("일반 증류주", None, True), ("", "whisky", True), ("글렌", "whisky", False), (None, None, False)], "a string, b string, want boolean")
    assert generic.where(derive.is_generic(F.col("a"), F.col("b")) != F.col("want")).isEmpty()


def test_countries(spark):
    df = spark.createDataFrame([(0, " 도미니카 공화국 "), (1, "없는 나라"), (2, ""), (3, None)], "i int, c string")
    rows = [tuple(r)[2:] for r in derive.with_country(df, "c", "x").orderBy("i").collect()]
    assert rows == [("Dominican Republic", "DO", "DOM", False), (None, None, None, True), (None, None, None, False), (None, None, None, False)]


def test_name_features(spark):
    df = spark.createDataFrame([(0, "Glen 12YO 43% 40abv 70cl"), (1, "aged 15 years Glen"), (2, None), (3, "18")], "i int, n string")
    got = df.select("i", features.name_features(F.col("n")).alias("f"), features.parse_age(F.col("n")).alias("a"), features.parse_volume_ml(F.col("n")).alias("v")).orderBy("i").collect()
    assert [(r.f.age, r.a, r.v) for r in got] == [(12, 12, 700), (15, 15, None), (None, None, None), (None, 18, None)]
    # a percent sign has no word border before a space, so its number stays
    assert [r.f.base_key for r in got] == ["glen 43", "glen", "", "18"]


def test_near_spellings_equal_brute_force(spark):
    words = ["laphroaig", "laphroaigs", "laphroaih", "glenfiddich", "glenfidich", "octomore", "tormoreab", "glenrothes", "glenrothex", "two words", "", None, "laphroaig"]
    df = spark.createDataFrame(list(enumerate(words)), "input_id int, name string")
    got = {tuple(r) for r in features.near_spellings(df, df.withColumnRenamed("input_id", "ref_id")).collect()}

    def close(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        short, long = sorted((a, b), key=len)
        return any(long[:k] + long[k + 1:] == short for k in range(len(long)))

    one = [(i, w) for i, w in enumerate(words) if w and " " not in w and len(w) >= 9]
    assert got == {(i, j) for (i, a), (j, b) in itertools.product(one, one) if close(a, b)}


def test_evidence_prior_and_links(spark):
    df = spark.createDataFrame([(15, 15, 40.0, 40.3, 700, 500, "whisky", "위스키"), (12, 15, None, 40.0, None, 1, "wine", "beer"), (None,) * 8],
                               "in_age int, ref_age int, in_abv double, ref_abv double, in_volume int, ref_volume int, in_category string, ref_category string")
    assert [r.attribute_score for r in features.attribute_evidence(df).collect()] == [3.5, -106.0, 0.0]
    a = spark.createDataFrame([(1, 15), (1, 15), (1, 15), (1, 34), (2, None)], "distillery_id int, region_id int")
    assert {tuple(r) for r in features.region_prior(a).collect()} == {(1, 15, 3.0), (1, 34, 1.0)}
    decls = spark.createDataFrame([(1, " A "), (2, "A"), (3, "B"), (4, None), (5, " ")], "rcno int, business_name string")
    links = spark.createDataFrame([(1, "A", "x"), (2, "B", "y"), (3, "B", None)], "rcno int, business_name string, code string")
    assert {tuple(r) for r in importers.pending_groups(decls, links).collect()} == {("A", 1, 2), ("B", 1, 3)}
    assert {tuple(r) for r in importers.search_candidates(decls, links).collect()} == {("A", "x"), ("B", "y")}
    picked = quality.defect_samples(spark.range(10), F.when(F.col("id") % 2 == 0, "even"), "id")
    assert {r.id for r in picked.collect()} == {0, 2, 4}


def test_blank_korean_name_is_no_kind(spark, tmp_path):
    from tallybook.plans import declarations

    # part 9880 has the names '' and WHISKY, part 230 a kind in Korean
    spark.createDataFrame([(9880, "x", 1, "b"), (230, "x", 1, "b")], "p_partkey long, p_name string, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.item_id: (r.key_ko, r.generic_name) for r in declarations.QUERIES["d26_keys"](spark, str(tmp_path)).collect()}
    assert got == {9880: ("", False), 230: ("위스키", True)}


def test_names_are_worked_out_once(spark):
    """Each rule spells out the cutting of a name once; what it read twice was worked out twice."""
    t, a, m = F.col("t"), F.col("a"), F.col("m")
    whole = lambda c: str(c).count("array_join(transform(")
    assert [whole(x) for x in (names.base_name(t, a, m), names.alcohol_name(t, a), names.display_name(t, F.col("v"), F.col("n"), a))] == [1, 1, 2]  # display names join the tokens of a group as well
    rows = [("cc dd 2008123YO", [2008]), ("20(700ml)08", []), ("A 2008 12YO 1999", [1999, 2008]), ("20 08", []), ("A2008", []), (None, [])]
    got = spark.createDataFrame([(i, r[0], "X") for i, r in enumerate(rows)], f"i int, {NAMES}").select("i", normalize.parse_vintage(F.col("product_name_ko"), F.col("product_name_en")).alias("y")).orderBy("i").collect()
    assert [list(r.y) for r in got] == [r[1] for r in rows]
    lots = [("A,L 12", "L 12"), ("A (L-5)", "L-5"), ("AL12/B", None), ("가L1234", None), ("A / L12A", "L12A"), ("A,　L5", "L5"), ("LEMON", None)]
    got = spark.createDataFrame([(i, r[0], None) for i, r in enumerate(lots)], f"i int, {NAMES}").select("i", normalize.parse_unlabelled_lot(F.col("product_name_ko"), F.col("product_name_en"), F.lit(None).cast("string")).alias("lot")).orderBy("i").collect()
    assert [r.lot for r in got] == [r[1] for r in lots]
    got = spark.createDataFrame([("한#1 NO. 22@3",), ("none",)], "t string").select(normalize.places(F.col("t"), normalize.P.MARKER).alias("p")).collect()
    assert [[tuple(x) for x in r.p] for r in got] == [[("#1", 1), ("NO. 22", 4), ("@3", 10)], []]
