"""Features of names and attributes that matching compares, and the evidence they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.text import tokens
from tallybook.operators.report import fingerprint

# How names state age, strength and volume.
AGE = r"(?i)(?:\baged\s*)?([1-9][0-9]?)\s*(?:yo|y\.o\.?|y(?:ears?)?(?:\s*old)?)\b|([1-9][0-9]?)\s*(?:년(?:산|\s*숙성)?|年)"
ABV = r"(?i)\b[0-9]{1,3}(?:\.[0-9]+)?\s*(?:%|abv)\b"
VOLUME = r"(?i)\b([0-9]{1,4}(?:\.[0-9]+)?)\s*(ml|cl|l)\b"
#: Kinds of drink, the first that matches counts.
GROUPS = (
    ("WHISKY", ("whisky", "whiskey", "위스키")), ("BRANDY", ("brandy", "브랜디")), ("LIQUEUR", ("liqueur", "리큐르")), ("SAKE", ("sake", "청주", "사케")),
    ("BEER", ("beer", "맥주")), ("WINE", ("wine", "와인")), ("SOJU", ("soju", "소주")),
)
#: Weights of agreeing and conflicting attributes.
AGE_SAME, AGE_CONFLICT, ABV_SAME, ABV_NEAR, ABV_CONFLICT, VOLUME_SAME, VOLUME_CONFLICT, CATEGORY_CONFLICT = 3.0, -6.0, 2.5, 1.0, -4.0, 1.0, -0.5, -100.0


def parse_age(c: Column) -> Column:
    """The first age with a unit, or the whole text where it is one number from 1 to 99."""
    text = F.trim(F.coalesce(c, F.lit("")))
    part = lambda k: F.regexp_extract(text, AGE, k).try_cast("int")
    return F.coalesce(F.when(text.rlike(r"^[1-9][0-9]?\z"), text.try_cast("int")), part(1), part(2))


def name_features(c: Column) -> Column:
    """struct(age, tokens, base_key): tokens of the name without age, strength and volume."""
    text = F.coalesce(c, F.lit(""))
    part = lambda k: F.regexp_extract(text, AGE, k).try_cast("int")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, AGE, " "), ABV, " "), VOLUME, " ")
    return F.struct(F.coalesce(part(1), part(2)).alias("age"), tokens(rest).alias("tokens"), F.array_join(tokens(rest), " ").alias("base_key"))


def parse_volume_ml(c: Column) -> Column:
    """The first volume in ml, halves up; zero is none."""
    text = F.trim(F.coalesce(c, F.lit("")))
    unit = F.lower(F.regexp_extract(text, VOLUME, 2))
    ml = F.regexp_extract(text, VOLUME, 1).try_cast("double") * F.when(unit == "l", 1000).when(unit == "cl", 10).otherwise(1)
    return F.when(ml > 0, F.floor(ml + 0.5).cast("int"))


def category_group(c: Column) -> Column:
    """The kind of drink a text names; null if none."""
    text = F.lower(F.coalesce(c, F.lit("")))
    hit = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))
    return F.coalesce(*[F.when(hit(words), name) for name, words in GROUPS])


def near_spellings(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs (input_id, ref_id) of one-token names of nine or more characters at most one edit apart.

    Such names share themselves or themselves less one character, so an equi-join on these variants finds every
    pair; edit distance then decides.  No name meets all others.
    """

    def variants(d: DataFrame, key: str) -> DataFrame:
        one = d.select(key, F.get(tokens(F.col("name")), F.lit(0)).alias("token"), F.size(tokens(F.col("name"))).alias("n")).where("n = 1 and length(token) >= 9")
        less = F.transform(F.sequence(F.lit(1), F.length("token")), lambda i: F.concat(F.substring(F.col("token"), F.lit(1), i - 1), F.substring(F.col("token"), i + 1, F.length("token"))))
        return one.select(key, F.col("token").alias(f"{key}_token"), F.explode(F.array_distinct(F.array_append(less, F.col("token")))).alias("variant"))

    pairs = variants(a, "input_id").join(variants(b, "ref_id"), "variant").where(F.levenshtein("input_id_token", "ref_id_token") <= 1)
    return pairs.select("input_id", "ref_id").distinct()


def attribute_evidence(d: DataFrame) -> DataFrame:
    """Adds ``evidence``, an array of struct(kind, weight), and ``attribute_score``.

    Columns in_* and ref_* hold age, abv, volume and category; an attribute that either side lacks says nothing.
    """
    a, r = (lambda c: F.col(f"in_{c}")), (lambda c: F.col(f"ref_{c}"))
    e = lambda kind, weight: F.struct(F.lit(kind).alias("kind"), F.lit(weight).alias("weight"))
    gap = F.abs(a("abv") - r("abv"))
    found = F.array_compact(F.array(
        F.when(a("age") == r("age"), e("AGE_EXACT", AGE_SAME)).when(a("age") != r("age"), e("AGE_CONFLICT", AGE_CONFLICT)),
        F.when(gap <= 0.05, e("ABV_EXACT", ABV_SAME)).when(gap <= 0.5, e("ABV_NEAR", ABV_NEAR)).when(gap > 0.5, e("ABV_CONFLICT", ABV_CONFLICT)),
        F.when(a("volume") == r("volume"), e("VOLUME_EXACT", VOLUME_SAME)).when(a("volume") != r("volume"), e("VOLUME_CONFLICT", VOLUME_CONFLICT)),
        F.when(category_group(a("category")) != category_group(r("category")), e("CATEGORY_CONFLICT", CATEGORY_CONFLICT)),
    ))
    d = d.withColumn("evidence", found)
    return d.withColumn("attribute_score", F.aggregate("evidence", F.lit(0.0), lambda s, x: s + x["weight"]))


def region_prior(alcohols: DataFrame) -> DataFrame:
    """(distillery_id, region_id, prior): 4 times the share of a distillery's products in each region."""
    n = alcohols.where("distillery_id is not null and region_id is not null").groupBy("distillery_id", "region_id").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("distillery_id"))
    return n.select("distillery_id", "region_id", (F.lit(4.0) * F.col("n") / total).alias("prior"))


def matching_version(refs: DataFrame, columns: list[str], rule: str) -> DataFrame:
    """One row: the rule version, cut to 31 characters, and 32 hex digits that stand for the reference rows."""
    digest = F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("fingerprint").cast("string")), 256)
    return fingerprint(refs, columns).select(F.concat(F.lit(rule[:31]), F.lit(":"), F.substring(digest, 1, 32)).alias("version"))
