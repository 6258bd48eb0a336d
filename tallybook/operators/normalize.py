"""Typed attributes, names, reasons and keys from free-text product names, as column expressions over both languages.

Rules give plain columns or arrays; ``normalize`` puts them together in a few projections, so that each text is searched once a pattern.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import patterns as P
from tallybook.functions.text import let, plain_number, search_key, tidy, ws_collapse
from tallybook.operators import derive
from tallybook.operators.names import alcohol_name, base_name, display_name, has, is_code_token, name_tokens

#: Item names and their English categories.
CATEGORIES = {"위스키": "Whisky", "브랜디": "Brandy", "리큐르": "Liqueur", "일반증류주": "General Distilled Spirits"}
LEGAL_FORMS = ("주식회사", "유한회사", "(주)", "㈜")
#: Kinds of variant markers.
CASK, BATCH, EDITION, SERIES, ABBREVIATION, UNKNOWN = "CASK_NUMBER", "BATCH_NUMBER", "EDITION_NUMBER", "SERIES_NUMBER", "STRENGTH_ABBREVIATION", "UNKNOWN"
VERSION = "normalization-v3"
REACH = 16


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _joined(ko: Column, en: Column) -> Column:
    return tidy(F.concat(_text(ko), F.lit(" "), _text(en)))


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(P.java(pattern)), F.lit(group))


def _first(text: Column, pattern: str, group: int = 0) -> Column:
    """The first match, null without one."""
    hit = F.regexp_extract(text, P.java(pattern), group)
    return F.when(text.rlike(P.java(pattern)), hit)


def _canonical(number: Column) -> Column:
    """Digits without leading zeros."""
    return F.coalesce(number.try_cast("bigint").cast("string"), number)


def places(text: Column, pattern: str) -> Column:
    """array<struct<raw, at>>: every match with the number of characters before it."""
    return F.transform(derive.places(text, pattern), lambda m: F.struct(m["raw"].alias("raw"), m["at"].alias("at")))


def volumes(text: Column) -> Column:
    """array<struct<raw, ml, package>> of one text: whole positive volumes, each with the count right after it."""
    after = P.java(P.VOLUME) + r"(?=(?:\s*[*x×X]\s*(\d+))?)"
    raws, counts = F.regexp_extract_all(text, F.lit(after), F.lit(2)), F.regexp_extract_all(text, F.lit(after), F.lit(3))
    number = lambda raw: F.regexp_replace(F.regexp_extract(raw, r"^[0-9.,]+", 0), ",", "").try_cast("double")
    ml = lambda raw: number(raw) * F.when(F.lower(raw).endswith("ml"), 1.0).otherwise(1000.0)
    found = F.zip_with(raws, counts, lambda r, n: F.struct(r.alias("raw"), ml(r).alias("ml"), F.when(n.rlike("[1-9]"), n.try_cast("int")).alias("package")))
    return F.filter(found, lambda v: (v["ml"] > 0) & (F.abs(v["ml"] - F.round(v["ml"])) <= 1e-7))


def volume_of(both: Column) -> tuple[Column, Column]:
    """(the first volume, whether another one differs) of the volumes of both languages."""
    first = F.get(both, F.lit(0))
    return first, F.exists(both, lambda v: F.round(v["ml"]) != F.round(first["ml"]))


def parse_volume(ko: Column, en: Column) -> Column:
    """struct(ml, ambiguous): the one volume that both languages agree on."""
    first, differs = volume_of(F.concat(volumes(_text(ko)), volumes(_text(en))))
    return F.struct(F.when(~differs, F.round(first["ml"]).cast("int")).alias("ml"), differs.alias("ambiguous"))


def parse_package(ko: Column, en: Column) -> Column:
    """Count after the first volume, if there is one volume."""
    first, differs = volume_of(F.concat(volumes(_text(ko)), volumes(_text(en))))
    return F.when(~differs, first["package"])


def parse_age(ko: Column, en: Column) -> Column:
    """struct(years, raw, conflict)."""
    k, e = _first(_text(ko), P.AGE_KO, 1).try_cast("int"), F.coalesce(*[F.nullif(_first(_text(en), P.AGE_EN, g), F.lit("")) for g in (1, 2)]).try_cast("int")

    def age(v: Column) -> Column:
        k, e = v["k"], v["e"]
        conflict = F.coalesce(k != e, F.lit(False))
        raw = F.when(k.isNotNull(), _first(_text(ko), P.AGE_KO)).when(e.isNotNull(), _first(_text(en), P.AGE_EN))
        return F.struct(F.when(~conflict, F.coalesce(k, e)).alias("years"), F.when(~conflict, raw).alias("raw"), conflict.alias("conflict"), k.alias("ko"), e.alias("en"))

    return let(F.struct(k.alias("k"), e.alias("e")), age)


def parse_proof(ko: Column, en: Column) -> Column:
    return _first(_joined(ko, en), P.PROOF, 1).try_cast("double")


def parse_batch(ko: Column, en: Column) -> Column:
    """struct(number, conflict): the Korean value wins."""
    k, e = _canonical(_first(_text(ko), P.BATCH_KO, 1)), _canonical(_first(_text(en), P.BATCH_EN, 1))
    return F.struct(F.coalesce(k, e).alias("number"), F.coalesce(k != e, F.lit(False)).alias("conflict"), k.alias("ko"), e.alias("en"))


def _strength(text: Column) -> Column:
    english = _first(text, P.STRENGTH_EN, 1)
    return (
        F.when(english.isNotNull(), F.concat(F.upper(english), F.lit(" STRENGTH"))).when(has(text, P.CASK_STRENGTH_KO), "CASK STRENGTH")
        .when(has(text, P.BARREL_STRENGTH_KO), "BARREL STRENGTH").when(F.upper(text).contains("OVERPROOF"), "OVERPROOF")
    )


def parse_strength(ko: Column, en: Column) -> Column:
    return F.coalesce(_strength(_text(ko)), _strength(_text(en)))


def parse_version(ko: Column) -> Column:
    return F.when(_text(ko).contains("구형"), "구형")


def parse_labelled(ko: Column, en: Column) -> Column:
    """struct(manufacture_no, lot_code, kind): a labelled manufacture number, lot or trailing L code; English only without a Korean one."""
    tidied = lambda c: ws_collapse(F.regexp_replace(tidy(c), r"^[)\]]+|[)\]]+\z", ""))

    def one(text: Column) -> Column:
        made, lot, end = _first(text, P.MANUFACTURE, 1), _first(text, P.LOT, 1), _first(text, P.LOT_SUFFIX, 1)
        return F.when(made.isNotNull(), F.struct(tidied(made).alias("manufacture_no"), F.lit(None).cast("string").alias("lot_code"), F.lit("MANUFACTURE_NUMBER_LABELED_EXCLUDED_FROM_SKU").alias("kind"))).when(
            lot.isNotNull(), F.struct(F.lit(None).cast("string").alias("manufacture_no"), tidied(lot).alias("lot_code"), F.lit("LOT_LABELED_EXCLUDED_FROM_SKU").alias("kind"))).when(
            end.isNotNull(), F.struct(F.lit(None).cast("string").alias("manufacture_no"), end.alias("lot_code"), F.lit("LOT_SUFFIX_CODE_EXCLUDED_FROM_SKU").alias("kind")))

    return F.coalesce(one(_text(ko)), one(_text(en)))


def parse_material(ko: Column, en: Column) -> Column:
    """Six digits in brackets, else the code behind the first slash if it holds a digit."""
    text = _joined(ko, en)
    slash = _first(text, P.MATERIAL_SLASH, 1)
    return F.coalesce(_first(text, P.MATERIAL_PARENS, 1), F.when(slash.rlike("[0-9]"), slash))


def parse_unlabelled_lot(ko: Column, en: Column, material: Column) -> Column:
    """The first top-level token that is a code beginning with L, other than the material code."""
    # the letters, digits, spaces, dots and dashes of such a token stand together in the name, behind anything but a letter or digit
    some = lambda text: F.when(text.rlike(r"(?:^|[^A-Z0-9])L[A-Z0-9\s.-]*[0-9]"), name_tokens(text)).otherwise(F.array().cast("array<string>"))
    tokens = F.concat(some(_text(ko)), some(_text(en)))
    return F.get(F.filter(tokens, lambda t: t.startswith("L") & is_code_token(t) & ~t.eqNullSafe(material)), F.lit(0))


def _kind(prefix: Column, raw: Column) -> Column:
    """What a number marks, by the words before it."""
    return (
        F.when(has(prefix, P.EDITION_CONTEXT), EDITION).when(raw.startswith("@") | has(prefix, P.SERIES_CONTEXT), SERIES)
        .when(has(F.regexp_replace(prefix, P.java(P.SMALL_BATCH), ""), P.BATCH_CONTEXT), BATCH).when(has(prefix, P.CASK_CONTEXT), CASK).otherwise(UNKNOWN)
    )


def markers(text: Column) -> Column:
    """array<struct<raw, value, kind>>: series numbers, then numbers behind #, @ or No. that no lot label precedes."""
    digits = lambda raw: F.regexp_extract(raw, r"[0-9]+\z", 0)
    series = F.transform(_all(text, P.SERIES), lambda r: F.struct(tidy(r).alias("raw"), digits(r).alias("value"), F.lit(SERIES).alias("kind")))
    before = lambda m: F.substring(text, F.lit(1), m["at"])
    others = F.filter(places(text, P.MARKER), lambda m: ~has(before(m), P.MARKER_LABEL))
    return F.concat(series, F.transform(others, lambda m: F.struct(tidy(m["raw"]).alias("raw"), digits(m["raw"]).alias("value"), _kind(before(m), tidy(m["raw"])).alias("kind"))))


def parse_edition(ko: Column, en: Column) -> Column:
    """struct(name, conflict): the Korean edition, else the English; conflict says that their numbers differ."""
    k, e = _first(tidy(_text(ko)), P.EDITION_KO), _first(tidy(_text(en)), P.EDITION_EN)
    number = lambda c: _canonical(F.coalesce(_first(c, P.EDITION_NUMBER_KO, 1), _first(c, P.EDITION_NUMBER_EN, 1)))
    return F.struct(tidy(F.coalesce(k, e)).alias("name"), F.coalesce(number(k) != number(e), F.lit(False)).alias("conflict"), number(k).alias("ko"), number(e).alias("en"))


def parse_vintage(ko: Column, en: Column) -> Column:
    """Years from 1950 to 2026 in the names without volumes, codes and the like: array<int>, oldest first.  Strengths change nothing here."""
    none, no = F.lit(None).cast("double"), F.lit("")
    # a base name joins no digits that something stood between, so its years are in the name too
    base = lambda text: F.when(text.rlike("(?:1[5-9]|20)[0-9]{2}"), base_name(text, none, no)).otherwise("")
    text = F.concat(base(_text(ko)), F.lit(" "), base(_text(en)))
    return F.array_sort(F.array_distinct(F.filter(F.transform(_all(text, P.YEAR, 1), lambda y: y.cast("int")), lambda y: y.between(1950, 2026))))


def parse_expiry(text: Column) -> Column:
    """struct(first, last, bad): open-ended halves; a valid half stays when the other is not; other texts than a range are bad."""
    t = _text(text)
    shape = has(t, P.EXPIRY)
    a, b = (F.nullif(F.regexp_extract(t, P.java(P.EXPIRY), g), F.lit("")) for g in (1, 2))
    day = lambda x: F.when(shape, F.try_to_date(x, "yyyy-MM-dd"))
    blank = tidy(t).isin("", "-")
    wrong = ~shape | (a.isNotNull() & day(a).isNull()) | (b.isNotNull() & day(b).isNull()) | (a.isNull() & b.isNull())
    return F.struct(F.when(~blank, day(a)).alias("first"), F.when(~blank, day(b)).alias("last"), (~blank & wrong).alias("bad"))


def parse_company(name: Column) -> Column:
    """struct(base, key, legal_form)."""
    base = tidy(_text(name))
    legal = F.coalesce(*[F.when(base.startswith(f), f) for f in LEGAL_FORMS])
    return F.struct(base.alias("base"), search_key(base).alias("key"), legal.alias("legal_form"))


def map_category(item: Column) -> Column:
    return F.coalesce(*[F.when(tidy(item) == k, v) for k, v in CATEGORIES.items()])


def status(review: Column, has_name: Column, structured: Column, fragments: Column) -> Column:
    """REVIEW_REQUIRED before UNPARSED before PARTIAL before NORMALIZED."""
    return F.when(review, "REVIEW_REQUIRED").when(~has_name & (structured == 0), "UNPARSED").when(fragments > 0, "PARTIAL").otherwise("NORMALIZED")


def json_text(*parts: Column) -> Column:
    """A JSON list of texts, nulls as empty texts, with the characters escaped that HTML gives a meaning."""
    text = F.to_json(F.array(*[_text(p.cast("string")) for p in parts]))
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), (("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026"), (" ", "\\u2028"), (" ", "\\u2029")), text)


def sku_key(*parts: Column) -> Column:
    return F.sha2(json_text(*parts), 256)


def abv_text(abv: Column) -> Column:
    return F.concat(plain_number(abv), F.lit("%"))


def _reason(hit: Column, code: str) -> Column:
    return F.when(F.coalesce(hit, F.lit(False)), code)


class _Steps:
    """Collects column definitions as a frame would take them, so that they are built once and applied to every frame."""

    def __init__(self):
        self.steps: list[dict[str, Column]] = []

    def withColumns(self, columns: dict[str, Column]) -> _Steps:
        self.steps.append(columns)
        return self

    def withColumn(self, name: str, column: Column) -> _Steps:
        return self.withColumns({name: column})

    def drop(self, *names: str) -> _Steps:
        return self


@lru_cache(maxsize=1)
def _fields(gateway: int) -> list[dict[str, Column]]:
    """Every field but countries, then names; ``gateway`` tells JVMs apart."""
    d = _Steps()
    d = d.withColumns({"_ko": _text(F.col("product_name_ko")), "_en": _text(F.col("product_name_en"))})
    ko, en = F.col("_ko"), F.col("_en")
    d = d.withColumns({"_volumes": F.concat(volumes(ko), volumes(en)), "_markers": F.concat(markers(ko), markers(en))})
    d = derive.with_strength(d)
    first, differs = volume_of(F.col("_volumes"))
    age, batch, labelled, edition = parse_age(ko, en), parse_batch(ko, en), parse_labelled(ko, en), parse_edition(ko, en)
    expiry, company = parse_expiry(F.col("expiry_text")), parse_company(F.col("importer_name"))
    d = d.withColumns({
        "_volume_differs": differs, "_second_raw": F.get(F.filter("_volumes", lambda v: F.round(v["ml"]) != F.round(first["ml"])), F.lit(0))["raw"], "_first_raw": first["raw"],
        "volume_raw": F.when(~differs, first["raw"]), "unit_volume_ml": F.when(~differs, F.round(first["ml"]).cast("int")), "package_count": F.when(~differs, first["package"]),
        "_age": age, "_batch": batch, "material_code": parse_material(ko, en), "_labelled": labelled,
        "proof": parse_proof(ko, en), "_proof_raw": _first(_joined(ko, en), P.PROOF), "strength_type": parse_strength(ko, en),
        "_cs": has(ko, P.LONE_CS) | has(en, P.LONE_CS), "_edition": edition, "version_marker": parse_version(ko), "_years": parse_vintage(ko, en), "_expiry": expiry, "_company": company,
        "category_en": map_category(F.col("item_name")), "cask_type": derive.cask_type(ko, en),
    })
    marker = F.get("_markers", F.lit(0))
    lone = F.col("_cs") & F.col("strength_type").isNull()
    other = F.get(F.filter(F.slice("_markers", F.lit(2), F.greatest(F.size("_markers") - 1, F.lit(0))), lambda m: (_canonical(m["value"]) != _canonical(marker["value"])) | (m["kind"] != marker["kind"])), F.lit(0))
    d = d.withColumns({
        "age_years": F.col("_age.years"), "edition_name": F.col("_edition.name"), "expiry_first": F.col("_expiry.first"), "expiry_last": F.col("_expiry.last"),
        "importer_base": F.col("_company.base"), "importer_key": F.col("_company.key"), "legal_form": F.col("_company.legal_form"), "vintage_year": F.get("_years", F.lit(0)),
        "manufacture_no": F.col("_labelled.manufacture_no"),
        "lot_code": F.when(F.col("_labelled").isNull(), parse_unlabelled_lot(ko, en, F.col("material_code"))).otherwise(F.col("_labelled.lot_code")),
        "variant_marker_raw": F.coalesce(marker["raw"], F.when(lone, "CS")), "variant_marker_type": F.coalesce(marker["kind"], F.when(lone, ABBREVIATION)),
        "variant_marker_value": F.coalesce(marker["value"], F.when(lone, "CS")), "_other_raw": other["raw"], "_marker_kind": marker["kind"], "_marker_number": _canonical(marker["value"]), "_lone": lone,
        "overseas_key": search_key(_text(F.col("overseas_establishment_name"))),
    })
    d = d.withColumns({
        "cask_number": F.when(F.col("_marker_kind") == CASK, F.col("_marker_number")),
        "batch_number": F.coalesce(F.col("_batch.number"), F.when(F.col("_marker_kind") == BATCH, F.col("_marker_number"))),
        "_confirmed": F.when(F.col("variant_marker_type").isin(CASK, BATCH, EDITION), F.col("variant_marker_raw")).otherwise(""),
        "display_name_ko": display_name(ko, F.col("unit_volume_ml"), F.col("package_count"), F.col("abv_percent")),
        "display_name_en": display_name(en, F.col("unit_volume_ml"), F.col("package_count"), F.col("abv_percent")),
        "alcohol_name_ko": alcohol_name(ko, F.col("abv_percent")), "alcohol_name_en": alcohol_name(en, F.col("abv_percent")), "alcohol_abv": abv_text(F.col("abv_percent")),
    })
    d = d.withColumns({f"base_name_{x}": base_name(F.col(f"display_name_{x}"), F.col("abv_percent"), F.col("_confirmed")) for x in ("ko", "en")})
    d = d.withColumns({"search_key_ko": derive.canonical_korean(search_key(F.col("base_name_ko")), en), "search_key_en": search_key(F.col("base_name_en"))})
    return d.steps


@lru_cache(maxsize=1)
def _outcome(gateway: int) -> list[dict[str, Column]]:
    """Reasons, fragments, status and key from the fields."""
    ko, en, number = F.col("_ko"), F.col("_en"), plain_number
    d = _Steps()
    d = d.withColumn("_generic", derive.is_generic(F.col("search_key_ko"), F.col("search_key_en")))
    has_name = (tidy(ko) != "") | (tidy(en) != "")
    unknown = F.col("_marker_kind") == UNKNOWN
    item = tidy(_text(F.col("item_name")))
    first_raw = F.col("_first_raw")
    slash = lambda a, b: F.concat(a.cast("string"), F.lit(" / "), b.cast("string"))
    codes = [
        _reason(F.col("_volume_differs"), "VOLUME_AMBIGUOUS"), _reason(F.col("unit_volume_ml").isNotNull() & first_raw.contains(","), "VOLUME_THOUSANDS_SEPARATOR"),
        _reason(F.col("unit_volume_ml").isNotNull() & first_raw.rlike("[ML]"), "VOLUME_UNIT_CASE_NORMALIZED"), _reason(F.col("package_count").isNotNull(), "PACKAGE_COUNT_EXCLUDED_FROM_BOTTLE_SKU"),
    ]
    later = [
        _reason(F.col("_age.conflict"), "AGE_CONFLICT_BETWEEN_LANGUAGES"), _reason(F.col("age_years").isNotNull(), "AGE_EXTRACTED"), F.col("_labelled.kind"),
        _reason(F.col("material_code").isNotNull(), "MATERIAL_CODE_PRESERVED_FOR_SKU"), _reason(F.col("_labelled").isNull() & F.col("lot_code").isNotNull(), "LOT_UNLABELED_CODE"),
        _reason(F.col("cask_number").isNotNull(), "CASK_NUMBER_PRESERVED_FOR_SKU"), _reason(unknown, "HASH_NUMBER_AMBIGUOUS"),
        _reason(unknown | F.col("_other_raw").isNotNull(), "VARIANT_MARKER_AMBIGUOUS"), _reason(F.col("_batch.conflict"), "BATCH_VALUE_CONFLICT"), _reason(F.col("proof").isNotNull(), "PROOF_PRESERVED_FOR_SKU"),
        _reason(F.col("_lone"), "STRENGTH_ABBREVIATION_AMBIGUOUS"), _reason(F.col("_edition.conflict"), "EDITION_VALUE_CONFLICT"), _reason(F.col("version_marker").isNotNull(), "KO_VERSION_MARKER_WITHOUT_ENGLISH_MAPPING"),
        _reason(ko.contains("(") & ko.contains(")"), "PARENTHESIS_SEMANTIC_TEXT"), _reason(F.size("_years") > 0, "VINTAGE_YEAR_REVIEW_REQUIRED"),
        _reason((item != "") & F.col("category_en").isNull(), "ALCOHOL_CATEGORY_NOT_MAPPED"), _reason(F.col("manufacture_country_unmapped"), "MANUFACTURE_COUNTRY_NOT_MAPPED"),
        _reason(F.col("export_country_unmapped"), "EXPORT_COUNTRY_NOT_MAPPED"), _reason(F.col("cask_type").isNotNull(), "CASK_TYPE_CANDIDATE_EXTRACTED"),
        _reason(F.col("_generic"), "GENERIC_PRODUCT_NAME_REVIEW_REQUIRED"), _reason(~F.col("_generic") & has_name & F.col("unit_volume_ml").isNull(), "VOLUME_MISSING"),
    ]
    fragments = F.array_compact(F.concat(
        F.array(F.when(F.col("_volume_differs"), slash(first_raw, F.col("_second_raw")))), F.col("abv_fragments"),
        F.array(
            F.when(F.col("_age.conflict"), F.concat(F.lit("age "), slash(F.col("_age.ko"), F.col("_age.en")))), F.when(unknown, F.col("variant_marker_raw")),
            F.when(F.col("_other_raw").isNotNull(), slash(F.col("variant_marker_raw"), F.col("_other_raw"))), F.when(F.col("_batch.conflict"), slash(F.col("_batch.ko"), F.col("_batch.en"))),
            F.col("_proof_raw"), F.when(F.col("_lone"), "CS"), F.when(F.col("_edition.conflict"), slash(F.col("_edition.ko"), F.col("_edition.en"))),
            F.when(F.size("_years") > 0, F.array_join("_years", " / ")), F.when(F.col("_expiry.bad"), F.col("expiry_text")),
            F.when((item != "") & F.col("category_en").isNull(), F.col("item_name")), F.when(F.col("manufacture_country_unmapped"), F.col("manufacture_country_name")),
            F.when(F.col("export_country_unmapped"), F.col("export_country_name")), F.when(F.col("_generic"), F.concat("base_name_ko", F.lit(" "), "base_name_en")),
        ),
    ))
    d = d.withColumns({"review_reasons": F.array_distinct(F.concat(F.array_compact(F.array(*codes)), F.col("abv_reasons"), F.array_compact(F.array(*later)))), "unparsed_fragments": fragments})
    review = F.arrays_overlap("review_reasons", F.array(*map(F.lit, REVIEWS)))
    found = ("unit_volume_ml", "ingredient_raw", "abv_percent", "age_years", "_labelled", "material_code", "variant_marker_raw", "_batch.number", "proof", "strength_type", "edition_name", "version_marker", "vintage_year")
    lot = F.when(F.col("_labelled").isNull(), F.col("lot_code")).isNotNull()
    structured = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in found]) + lot.cast("int") + ((~tidy(_text(F.col("expiry_text"))).isin("", "-")) & ~F.col("_expiry.bad")).cast("int")
    kind = F.col("variant_marker_type")
    whole = kind.isin(UNKNOWN, ABBREVIATION)
    key = sku_key(
        F.col("search_key_ko"), F.col("search_key_en"), F.col("unit_volume_ml"), F.col("age_years"), F.col("vintage_year"), number(F.col("abv_percent")), number(F.col("proof")),
        F.col("strength_type"), F.col("version_marker"), F.col("edition_name"), F.col("material_code"), F.col("cask_number"), F.col("batch_number"),
        F.when(whole, F.col("variant_marker_raw")), F.when(whole | (kind == SERIES), kind), F.when(whole, F.col("variant_marker_value")).when(kind == SERIES, _canonical(F.col("variant_marker_value"))),
    )
    d = d.withColumns({
        "normalization_status": status(review, has_name, structured, F.size("unparsed_fragments")), "rule_version": F.lit(VERSION),
        "sku_key": F.when(~F.col("_generic") & has_name & F.col("unit_volume_ml").isNotNull(), key),
    })
    return d.steps


def normalize(df: DataFrame, *columns: str) -> DataFrame:
    """Input columns with the derived ones asked for, all by default; later rules read earlier results, so they follow in a few projections.

    The result leaves through ``inline``, beyond which no filter is pushed: put into a filter, a status would be spelled out down to the source texts.

    Columns that the input lacks count as null.  Reasons stand in the order of the rules, each once; fragments as often as they occur.
    """
    names, gateway = df.columns, id(SparkContext._gateway)
    sources = ("product_name_ko", "product_name_en", "importer_name", "overseas_establishment_name", "expiry_text", "item_name", "manufacture_country_name", "export_country_name")
    d = df.withColumns({c: F.lit(None).cast("string") for c in sources if c not in names})
    for step in _fields(gateway):
        d = d.withColumns(step)
    for side, prefix in (("manufacture_country_name", "manufacture_country"), ("export_country_name", "export_country")):
        d = derive.with_country(d, side, prefix)
    for step in _outcome(gateway):
        d = d.withColumns(step)
    wanted = [c for c in columns or OUTPUT if c not in names]
    return d.select(F.inline(F.array(F.struct(*names, *wanted))))



#: Reasons that ask for a review; the others only state what a rule did.
REVIEWS = (
    "VOLUME_AMBIGUOUS", "INGREDIENT_PERCENT_MULTIPLE_VALUES", "ABV_AMBIGUOUS_POSITION", "ABV_CONFLICT_BETWEEN_LANGUAGES", "ABV_OUT_OF_AUTOMATIC_RANGE", "AGE_CONFLICT_BETWEEN_LANGUAGES",
    "VARIANT_MARKER_AMBIGUOUS", "BATCH_VALUE_CONFLICT", "PROOF_PRESERVED_FOR_SKU", "STRENGTH_ABBREVIATION_AMBIGUOUS", "EDITION_VALUE_CONFLICT", "VINTAGE_YEAR_REVIEW_REQUIRED",
    "ALCOHOL_CATEGORY_NOT_MAPPED", "MANUFACTURE_COUNTRY_NOT_MAPPED", "EXPORT_COUNTRY_NOT_MAPPED", "GENERIC_PRODUCT_NAME_REVIEW_REQUIRED",
)
OUTPUT = (
    "volume_raw", "unit_volume_ml", "package_count", "ingredient_percent", "ingredient_raw", "abv_percent", "age_years", "vintage_year", "proof", "strength_type", "batch_number", "cask_number", "material_code",
    "lot_code", "manufacture_no", "variant_marker_raw", "variant_marker_type", "variant_marker_value", "edition_name", "version_marker", "cask_type", "expiry_first", "expiry_last",
    "importer_base", "importer_key", "legal_form", "overseas_key", "category_en", "manufacture_country_en", "manufacture_country_alpha2", "manufacture_country_alpha3",
    "export_country_en", "export_country_alpha2", "export_country_alpha3", "display_name_ko", "display_name_en", "base_name_ko", "base_name_en", "search_key_ko", "search_key_en",
    "alcohol_name_ko", "alcohol_name_en", "alcohol_abv", "review_reasons", "unparsed_fragments", "normalization_status", "rule_version", "sku_key",
)
