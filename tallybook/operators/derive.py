"""Strength, casks, countries and keys from product names, as column expressions over both languages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import patterns as P
from tallybook.functions.text import let, plain_number, tidy, ws_collapse

#: Cask types in the order of their catalog.
CASKS = (
    r"(?i)\bPEDRO\s+XIM[EÉ]NEZ(?:\s+SHERRY)?\s+CASKS?\b", r"(?i)\bOLOROSO(?:\s+SHERRY)?\s+CASKS?\b", r"(?i)\bPX(?:\s+SHERRY)?\s+CASKS?\b", r"(?i)\bSHERRY\s+CASKS?\b",
    r"(?i)\bBOURBON\s+CASKS?\b", r"(?i)\bPORT(?:\s+WINE)?\s+CASKS?\b", r"(?i)\bWINE\s+CASKS?\b", r"(?i)\bVIRGIN\s+OAK(?:\s+CASKS?)?\b",
    r"올로로소\s*(?:쉐리|셰리)?\s*캐스크", r"(?:PX|피엑스)\s*(?:쉐리|셰리)?\s*캐스크", r"(?:쉐리|셰리)\s*캐스크", r"버번\s*캐스크", r"포트(?:\s*와인)?\s*캐스크", r"와인\s*캐스크", r"버진\s*오크",
)
#: Spellings of one Korean word, and the one that search keys carry.
SPELLINGS = (("스트랭스", "스트렝스"), ("셰리", "쉐리"), ("피니쉬", "피니시"), ("바렐", "배럴"))
#: Names that say no more than a kind.
GENERIC_KO = ("위스키", "보드카", "브랜디", "리큐르", "일반증류주")
GENERIC_EN = ("whisky", "whiskey", "vodka", "brandy", "liqueur", "general distilled spirits", "distilled spirits")
#: Country, English name, two and three letter codes.
COUNTRIES = (
    ("가이아나", "Guyana", "GY", "GUY"), ("남아프리카 공화국", "South Africa", "ZA", "ZAF"), ("네덜란드", "Netherlands", "NL", "NLD"), ("네팔", "Nepal", "NP", "NPL"),
    ("노르웨이", "Norway", "NO", "NOR"), ("뉴질랜드", "New Zealand", "NZ", "NZL"), ("대만", "Taiwan", "TW", "TWN"), ("대한민국", "South Korea", "KR", "KOR"),
    ("덴마크", "Denmark", "DK", "DNK"), ("도미니카 공화국", "Dominican Republic", "DO", "DOM"), ("독일", "Germany", "DE", "DEU"), ("라트비아", "Latvia", "LV", "LVA"),
    ("러시아", "Russia", "RU", "RUS"), ("리투아니아", "Lithuania", "LT", "LTU"), ("멕시코", "Mexico", "MX", "MEX"), ("몬테네그로", "Montenegro", "ME", "MNE"),
    ("몽골", "Mongolia", "MN", "MNG"), ("미국", "United States", "US", "USA"), ("미얀마", "Myanmar", "MM", "MMR"), ("바베이도스", "Barbados", "BB", "BRB"),
    ("베트남", "Vietnam", "VN", "VNM"), ("벨기에", "Belgium", "BE", "BEL"), ("불가리아", "Bulgaria", "BG", "BGR"), ("브라질", "Brazil", "BR", "BRA"),
    ("스리랑카", "Sri Lanka", "LK", "LKA"), ("스웨덴", "Sweden", "SE", "SWE"), ("스페인", "Spain", "ES", "ESP"), ("싱가포르", "Singapore", "SG", "SGP"),
    ("아랍에미리트", "United Arab Emirates", "AE", "ARE"), ("아르메니아", "Armenia", "AM", "ARM"), ("아일랜드", "Ireland", "IE", "IRL"), ("에스토니아", "Estonia", "EE", "EST"),
    ("엘살바도르", "El Salvador", "SV", "SLV"), ("영국", "United Kingdom", "GB", "GBR"), ("오스트리아", "Austria", "AT", "AUT"), ("요르단", "Jordan", "JO", "JOR"),
    ("우즈베키스탄", "Uzbekistan", "UZ", "UZB"), ("우크라이나", "Ukraine", "UA", "UKR"), ("이탈리아", "Italy", "IT", "ITA"), ("인도", "India", "IN", "IND"),
    ("인도네시아", "Indonesia", "ID", "IDN"), ("일본", "Japan", "JP", "JPN"), ("자메이카", "Jamaica", "JM", "JAM"), ("조지아", "Georgia", "GE", "GEO"),
    ("중국", "China", "CN", "CHN"), ("체코", "Czechia", "CZ", "CZE"), ("칠레", "Chile", "CL", "CHL"), ("카자흐스탄", "Kazakhstan", "KZ", "KAZ"),
    ("캐나다", "Canada", "CA", "CAN"), ("쿠바", "Cuba", "CU", "CUB"), ("크로아티아", "Croatia", "HR", "HRV"), ("태국", "Thailand", "TH", "THA"),
    ("튀르키예", "Türkiye", "TR", "TUR"), ("트리니다드 토바고", "Trinidad and Tobago", "TT", "TTO"), ("파나마", "Panama", "PA", "PAN"), ("페루", "Peru", "PE", "PER"),
    ("폴란드", "Poland", "PL", "POL"), ("프랑스", "France", "FR", "FRA"), ("필리핀", "Philippines", "PH", "PHL"), ("호주", "Australia", "AU", "AUS"),
    ("홍콩", "Hong Kong", "HK", "HKG"),
)
REACH = 16


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _near(text: Column, start: Column, end: Column) -> Column:
    """The text from 16 characters before to 16 after a span."""
    low = F.greatest(start - REACH, F.lit(0))
    return F.substring(text, low + 1, end + REACH - low)


def _composed(text: Column, start: Column, end: Column) -> Column:
    return _near(text, start, end).rlike(P.java(P.COMPOSITION))


def places(text: Column, pattern: str) -> Column:
    """array<struct<raw, at, end>> of every match."""
    raws, gaps = F.regexp_extract_all(text, F.lit(P.java(pattern)), F.lit(0)), F.transform(F.split(text, P.java(pattern), -1), F.length)
    item = "struct<raw:string,at:int,end:int>"
    place = lambda raw, at: F.struct(raw.alias("raw"), at.alias("at"), (at + F.length(raw)).alias("end"))
    # one pass over the matches; each begins where the one before ended, and the gap between
    step = lambda s, m: let(s["end"] + m["gap"], lambda at: F.struct((at + F.length(m["raw"])).alias("end"), F.array_append(s["out"], place(m["raw"], at)).alias("out")))
    start = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{item}>").alias("out"))
    paired = lambda r: F.zip_with(r, F.slice(gaps, F.lit(1), F.size(r)), lambda raw, gap: F.struct(raw.alias("raw"), gap.alias("gap")))
    return F.when(~text.rlike(P.java(pattern)), F.array().cast(f"array<{item}>")).otherwise(let(raws, lambda r: F.aggregate(paired(r), start, step, lambda s: s["out"])))


def shares(text: Column) -> Column:
    """Each percentage of a text: array of struct(raw, value, at, end, composed, stated, named) in text order.

    ``composed`` says that an ingredient stands within 16 characters, ``stated`` that an anchor which outranks ingredients holds it,
    ``named`` that an ingredient stands right before.
    """
    anchors = F.concat(*[places(text, p) for p, explicit in P.ABV_ANCHORS if explicit])
    before = lambda s: F.substring(F.substring(text, F.lit(1), s["at"]), -REACH, REACH)
    return let(anchors, lambda held: F.transform(places(text, P.PERCENT), lambda s: F.struct(
        tidy(s["raw"]).alias("raw"), F.regexp_extract(s["raw"], r"^[0-9.]+", 0).try_cast("double").alias("value"), s["at"].alias("at"), s["end"].alias("end"),
        _composed(text, s["at"], s["end"]).alias("composed"), F.exists(held, lambda a: (s["at"] >= a["at"]) & (s["end"] <= a["end"])).alias("stated"),
        before(s).rlike(P.java(P.INGREDIENT_BEFORE)).alias("named"),
    )))


def anchored_abv(text: Column) -> Column:
    """struct(raw, value, at, end, explicit): the first anchor in order whose first match states a strength, null without one."""

    def one(pattern: str, explicit: bool) -> Column:
        p = P.java(pattern)
        whole, value = F.regexp_extract(text, p, 0), F.regexp_extract(text, p, 1)
        at = F.regexp_instr(text, F.lit(p)) - 1
        start = at + F.instr(whole, value) - 1
        ok = text.rlike(p) if explicit else text.rlike(p) & ~_composed(text, start, start + F.length(value))
        return F.when(ok, F.struct(tidy(whole).alias("raw"), value.try_cast("double").alias("value"), at.alias("at"), (at + F.length(whole)).alias("end"), F.lit(explicit).alias("explicit")))

    return F.coalesce(*[one(p, explicit) for p, explicit in P.ABV_ANCHORS])


def with_strength(d: DataFrame) -> DataFrame:
    """Adds ingredient_percent, ingredient_raw, abv_percent, abv_reasons and abv_fragments.

    One ingredient share is a value, several only their text.  Languages that differ and strengths outside (0, 70] give a reason and no
    value; a share outside the anchor of its language that no ingredient explains gives a reason alone.
    """
    ko, en = _text(F.col("product_name_ko")), _text(F.col("product_name_en"))
    d = d.withColumns({"_ko_p": shares(ko), "_en_p": shares(en), "_ko_a": anchored_abv(ko), "_en_a": anchored_abv(en)})
    found = F.filter(F.concat("_ko_p", "_en_p"), lambda s: s["composed"] & ~s["stated"])
    d = d.withColumn("_all", found)
    distinct = F.filter("_all", lambda s, i: F.array_position(F.transform("_all", lambda x: x["value"]), s["value"]) == i + 1)
    d = d.withColumns({"_found": distinct, "_named": F.transform(F.filter("_all", lambda s: s["named"]), lambda s: s["value"])})
    for x in ("_ko", "_en"):
        anchor = F.col(f"{x}_a")
        d = d.withColumn(f"{x}_ok", F.coalesce(anchor["explicit"] | ~F.array_contains("_named", anchor["value"]), F.lit(False)))
        inside = lambda s, a=anchor, ok=F.col(f"{x}_ok"): ok & F.coalesce((s["at"] >= a["at"]) & (s["end"] <= a["end"]), F.lit(False))
        d = d.withColumn(f"{x}_loose", F.get(F.filter(f"{x}_p", lambda s: ~s["composed"] & ~inside(s)), F.lit(0))["raw"])
        d = d.withColumn(f"{x}_v", F.when(F.col(f"{x}_ok"), anchor["value"]))
    conflict = F.coalesce(F.abs(F.col("_ko_v") - F.col("_en_v")) > 1e-7, F.lit(False))
    value = F.coalesce("_ko_v", "_en_v")
    outside = F.coalesce(~conflict & ((value <= 0) | (value > 70)), F.lit(False))
    several = F.size("_found") > 1
    share = lambda c: F.concat(plain_number(c), F.lit("%"))
    raws = F.array_join(F.transform("_found", lambda s: s["raw"]), ", ")
    return d.withColumns({
        "ingredient_percent": F.when(F.size("_found") == 1, F.get("_found", F.lit(0))["value"]), "ingredient_raw": F.when(F.size("_found") > 0, raws),
        "abv_percent": F.when(~conflict & ~outside, value),
        "abv_reasons": F.array_compact(F.array(
            F.when(F.size("_found") > 0, "ABV_COMPOSITION_CONTEXT"), F.when(several, "INGREDIENT_PERCENT_MULTIPLE_VALUES"),
            F.when(F.coalesce("_ko_loose", "_en_loose").isNotNull(), "ABV_AMBIGUOUS_POSITION"), F.when(conflict, "ABV_CONFLICT_BETWEEN_LANGUAGES"), F.when(outside, "ABV_OUT_OF_AUTOMATIC_RANGE"),
        )),
        "abv_fragments": F.array_compact(F.array(
            F.when(several, raws), F.col("_ko_loose"), F.col("_en_loose"), F.when(conflict, F.concat(share(F.col("_ko_v")), F.lit(" / "), share(F.col("_en_v")))), F.when(outside, share(value)),
        )),
    }).drop("_all", "_found", "_named", *[f"{x}_{y}" for x in ("_ko", "_en") for y in ("p", "a", "ok", "loose", "v")])


def canonical_korean(key: Column, en: Column) -> Column:
    """A Korean search key in one spelling, where an English name stands beside it."""
    one = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, key)
    return F.when(ws_collapse(_text(en)) != "", one).otherwise(key)


def is_generic(key_ko: Column, key_en: Column) -> Column:
    """The name says only what kind of drink it is; the English one counts where there is no Korean one."""
    ko, en = _text(key_ko), _text(key_en)
    return F.replace(ko, F.lit(" "), F.lit("")).isin(*GENERIC_KO) | ((ko == "") & en.isin(*GENERIC_EN))


def cask_type(ko: Column, en: Column) -> Column:
    """The first cask type of the catalog that either name holds."""
    text = F.concat(_text(ko), F.lit(" "), _text(en))
    found = F.coalesce(*[F.when(text.rlike(P.java(p)), ws_collapse(F.regexp_extract(text, P.java(p), 0))) for p in CASKS])
    return F.when(text.rlike("(?iu)CASK|OAK|캐스크|오크"), found)  # every type holds one of these


def with_country(d: DataFrame, column: str, prefix: str) -> DataFrame:
    """Adds English name and codes of a country, and whether a name that is not blank is unknown.  The catalog has 61 rows."""
    names = [f"{prefix}_{x}" for x in ("en", "alpha2", "alpha3")]
    catalog = d.sparkSession.createDataFrame(COUNTRIES, ", ".join(f"`{c}` string" for c in ("_country", *names)))
    out = d.join(F.broadcast(catalog), tidy(F.col(column)) == F.col("_country"), "left")
    return out.withColumn(f"{prefix}_unmapped", F.col("_country").isNull() & (tidy(_text(F.col(column))) != "")).drop("_country")


def run_summary(d: DataFrame, left: int = 0) -> DataFrame:
    """(processed, normalized, partial, review, unparsed, remaining) of a run."""
    n = lambda s: F.count_if(F.col("normalization_status") == s)
    return d.agg(
        F.count("*").alias("processed"), n("NORMALIZED").alias("normalized"), n("PARTIAL").alias("partial"), n("REVIEW_REQUIRED").alias("review"),
        n("UNPARSED").alias("unparsed"), F.lit(left).cast("long").alias("remaining"),
    )
