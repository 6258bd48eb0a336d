"""Product names cut into bracket groups and tokens, and the names derived from what is kept of them.

A name is an array of segments: bracket groups, and the plain text between them.  Both are cut into tokens at
top-level commas and slashes.  A derived name drops the tokens that state volume, strength, codes and the like, a group leaves or stays
with both its brackets, and separators whose other side is gone become spaces.  All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.functions import patterns as P
from tallybook.functions.text import let, plain_number, tidy, ws_collapse

#: Stands where something was removed, until separators are cleaned up.
MARK = "\x01"
#: Names with at most so many opening brackets are cut by one pattern; a fold that counts depth cuts the others, however deep they nest.
DEPTH = 6


def _closed(opener: str, closer: str) -> str:
    """A group from an opener to its own closer; the other kind of bracket is plain text in it."""
    inside = rf"[^\{opener}\{closer}]"
    group = rf"\{opener}{inside}*+\{closer}"
    for _ in range(DEPTH - 1):
        group = rf"\{opener}(?:{inside}++|{group})*+\{closer}"
    return group


GROUP = f"(?:{_closed('(', ')')}|{_closed('[', ']')})"
#: An opener that nothing closes makes all the rest plain text.
SEGMENT = rf"{GROUP}|[^(\[]++(?:(?!{GROUP})[(\[].*)?|[(\[].*"
WHOLE_GROUP = rf"^{GROUP}\z"


def _nested() -> str:
    """Any bracket to any closer, or to the end; both kinds count together."""
    part = r"[(\[][^()\[\]]*+(?:[)\]]|\z)"
    for _ in range(DEPTH - 1):
        part = rf"[(\[](?:[^()\[\]]++|{part})*+(?:[)\]]|\z)"
    return part


TOKEN = rf"((?:[^,/()\[\]]++|(?<=[0-9]),(?=[0-9])|{_nested()}|[)\]])*+)([,/]|\z)"


def has(text: Column, pattern: str) -> Column:
    return text.rlike(P.java(pattern))


def _deep(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, "([", "")) > DEPTH


def _characters(text: Column) -> Column:
    """array<struct<c, i>> of a text's characters."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))


def _deep_segments(text: Column) -> Column:
    """As ``segments``, for any depth: only the kind of bracket that opened a group counts in it, and what never closes is plain with all the rest."""
    part = "struct<text:string,inner:string,is_group:boolean>"
    cut = lambda a, b: F.substring(text, a + 1, b - a)
    plain = lambda a, b: F.when(b > a, F.array(F.struct(cut(a, b).alias("text"), F.lit(None).cast("string").alias("inner"), F.lit(False).alias("is_group")))).otherwise(F.array().cast(f"array<{part}>"))
    group = lambda a, b: F.array(F.struct(cut(a, b).alias("text"), cut(a + 1, b - 1).alias("inner"), F.lit(True).alias("is_group")))
    start = F.struct(F.lit("").alias("kind"), F.lit(0).alias("depth"), F.lit(0).alias("open"), F.lit(0).alias("done"), F.array().cast(f"array<{part}>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        first = (s["depth"] == 0) & x["c"].isin("(", "[")
        deeper = (s["depth"] > 0) & (x["c"] == s["kind"])
        closes = (s["depth"] > 0) & (x["c"] == F.when(s["kind"] == "(", ")").otherwise("]"))
        ends = closes & (s["depth"] == 1)
        return F.struct(
            F.when(first, x["c"]).otherwise(s["kind"]).alias("kind"), F.when(first | deeper, s["depth"] + 1).when(closes, s["depth"] - 1).otherwise(s["depth"]).alias("depth"),
            F.when(first, x["i"]).otherwise(s["open"]).alias("open"), F.when(ends, x["i"] + 1).otherwise(s["done"]).alias("done"),
            F.when(ends, F.concat(s["out"], plain(s["done"], s["open"]), group(s["open"], x["i"] + 1))).otherwise(s["out"]).alias("out"),
        )

    return F.aggregate(_characters(text), start, step, lambda s: F.concat(s["out"], plain(s["done"], F.length(text))))


def _deep_tokens(text: Column) -> Column:
    """As ``tokens_of``, for any depth: brackets of both kinds count together."""
    item = "struct<token:string,join:string,t:string>"
    cut = lambda a, b: F.substring(text, a + 1, b - a)
    token = lambda s, b: F.array_append(s["out"], F.struct(cut(s["start"], b).alias("token"), s["join"].alias("join"), tidy(cut(s["start"], b)).alias("t")))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("start"), F.lit("").alias("join"), F.array().cast(f"array<{item}>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        between_digits = (x["c"] == ",") & (x["i"] > 0) & F.substring(text, x["i"], F.lit(1)).rlike("^[0-9]$") & F.substring(text, x["i"] + 2, F.lit(1)).rlike("^[0-9]$")
        cuts = (s["depth"] == 0) & x["c"].isin(",", "/") & ~between_digits
        return F.struct(
            F.when(x["c"].isin("(", "["), s["depth"] + 1).when(x["c"].isin(")", "]") & (s["depth"] > 0), s["depth"] - 1).otherwise(s["depth"]).alias("depth"),
            F.when(cuts, x["i"] + 1).otherwise(s["start"]).alias("start"), F.when(cuts, x["c"]).otherwise(s["join"]).alias("join"), F.when(cuts, token(s, x["i"])).otherwise(s["out"]).alias("out"),
        )

    return F.aggregate(_characters(text), start, step, lambda s: token(s, F.length(text)))


def segments(text: Column) -> Column:
    """array<struct<text, inner, is_group>> in order; joined texts give the name back."""
    return F.when(_deep(text), _deep_segments(text)).otherwise(_shallow_segments(text))


def _shallow_segments(text: Column) -> Column:
    parts = F.regexp_extract_all(text, F.lit("(?s)" + SEGMENT), F.lit(0))
    return F.transform(parts, lambda s: F.struct(
        s.alias("text"), F.when(s.rlike("(?s)" + WHOLE_GROUP), F.substring(s, F.lit(2), F.length(s) - 2)).alias("inner"), s.rlike("(?s)" + WHOLE_GROUP).alias("is_group")))


def tokens_of(text: Column) -> Column:
    """array<struct<token, join, t>>: pieces between top-level commas and slashes, the separator before each ('' for the first), and the piece trimmed.

    A comma between digits separates nothing.
    """
    return F.when(_deep(text), _deep_tokens(text)).otherwise(_shallow_tokens(text))


def _shallow_tokens(text: Column) -> Column:
    pieces = F.regexp_extract_all(text, F.lit("(?s)" + TOKEN), F.lit(1))
    found = F.filter(F.regexp_extract_all(text, F.lit("(?s)" + TOKEN), F.lit(2)), lambda j: j != "")
    item = lambda t, j: F.struct(t.alias("token"), j.alias("join"), tidy(t).alias("t"))
    several = let(found, lambda joins: F.zip_with(F.slice(pieces, F.lit(1), F.size(joins) + 1), F.concat(F.array(F.lit("")), joins), item))
    return F.when(~(text.contains(",") | text.contains("/")), F.array(item(text, F.lit("")))).otherwise(several)


def group_tokens(inner: Column) -> Column:
    """Tokens of a bracket group; a group that is a date keeps its slashes."""
    whole = F.array(F.struct(inner.alias("token"), F.lit("").alias("join"), tidy(inner).alias("t")))
    return F.when(has(tidy(inner), P.DATE_TOKEN), whole).otherwise(tokens_of(inner))


def name_tokens(text: Column) -> Column:
    """Every top-level token of a name, trimmed, blanks left out; groups give their inner tokens."""
    per = F.transform(segments(text), lambda s: F.when(s["is_group"], group_tokens(s["inner"])).otherwise(tokens_of(s["text"])))
    return F.filter(F.transform(F.flatten(per), lambda t: t["t"]), lambda t: t != "")


def is_code_token(t: Column) -> Column:
    """A lot code (L and a digit) or an opaque code of letters and at least two digits."""
    return t.rlike(P.CODE)


#: Values that look like codes but are none.
VALUE = P.whole(P.any_of(P.VOLUME_TOKEN, P.ABV_TOKEN, P.PACKAGE_TOKEN, P.AGE_TOKEN))


def is_excluded_code(t: Column) -> Column:
    return ~t.rlike(VALUE) & t.rlike(P.STATED_CODE)


def _number(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, P.java(pattern), 1)
    return F.when(found != "", found.try_cast("double"))


def is_abv_token(t: Column, abv: Column) -> Column:
    """The token is the known strength as a percentage and begins with its number."""
    return F.coalesce(t.rlike("^[0-9]") & t.contains("%") & (_number(t, P.ABV_TOKEN) == abv), F.lit(False))


def _stated(match: Column) -> Column:
    """The share, or else the degree, that a phrase states."""
    return F.coalesce(_number(match, P.PERCENT), _number(match, P.DEGREE))


def _may_state(text: Column, abv: Column) -> Column:
    """Whether a text can state the known strength at all: every phrase that does holds one of two signs."""
    return abv.isNotNull() & (text.contains("%") | text.contains("도"))


def is_abv_phrase(t: Column, abv: Column) -> Column:
    phrase = F.regexp_extract(t, P.java(P.STRONG_ABV), 0)
    stated = is_abv_token(t, abv) | F.coalesce((phrase != "") & (tidy(phrase) == t) & (_stated(phrase) == abv), F.lit(False))
    return F.when(_may_state(t, abv), stated).otherwise(False)


def _replace(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, P.java(pattern), by)


def _without_abv(text: Column, abv: Column) -> Column:
    """The text with the phrases that state the known strength marked as removed."""
    p = F.lit(P.java(P.STRONG_ABV))
    found = F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda m: F.when(F.coalesce(_stated(m) == abv, F.lit(False)), F.lit(MARK)).otherwise(m))
    between = F.split(text, P.java(P.STRONG_ABV), -1)
    return F.array_join(F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


#: Tokens that state nothing of the name, for alcohol names and for base names.
ALWAYS = P.whole(f"\\z|{P.any_of(P.VOLUME_TOKEN, P.PACKAGE_TOKEN)}|{P.STATED_CODE}")
IN_BASE = P.whole(f"{ALWAYS}|{P.any_of(P.PROOF_TOKEN, P.AGE_TOKEN, P.BATCH_TOKEN, P.STRENGTH_TOKEN)}")


def _droppable(t: Column, abv: Column, marker: Column, base: bool) -> Column:
    """Whether a trimmed token states nothing that belongs to the name; ``base`` drops age, proof, strength and numbers as well."""
    drop = t.rlike(IN_BASE if base else ALWAYS) | is_abv_phrase(t, abv)
    return drop | ((marker != "") & (t == tidy(marker))) if base else drop


def _stripped(text: Column, abv: Column, marker: Column, base: bool) -> Column:
    """A kept token without the stated values inside it."""
    bare = _replace(text, P.PACKAGE_IN_NAME, "$1")
    text = F.when(_may_state(text, abv), let(bare, lambda t: _without_abv(t, abv))).otherwise(bare)
    text = _replace(text, P.VOLUME, "$1" + MARK)
    for pattern in (P.LOT, P.MANUFACTURE, P.LOT_SUFFIX, P.MATERIAL_SLASH):
        text = _replace(text, pattern, MARK)
    if base:
        for pattern in (P.PROOF, P.STRENGTH, P.AGE_KO, P.AGE_EN, P.BATCH_EN, P.BATCH_KO):
            text = _replace(text, pattern, MARK)
        text = F.when(marker != "", F.replace(text, marker, F.lit(MARK))).otherwise(text)
        text = F.replace(text, F.lit("구형"), F.lit(MARK))
    return text


def _rejoined(kept: Column) -> Column:
    """Text of array<struct<i, join, text, plain>>: separators only between neighbours of the source, else a space; MARK for nothing."""
    step = lambda a, k: F.struct(
        F.concat(a["text"], F.when(k["plain"], F.lit(" ")).when(a["last"] < 0, F.lit("")).when(a["last"] == k["i"] - 1, k["join"]).otherwise(F.lit(" ")), k["text"]).alias("text"),
        k["i"].alias("last"),
    )
    return F.aggregate(kept, F.struct(F.lit("").alias("text"), F.lit(-1).alias("last")), step, lambda a: F.when(a["last"] < 0, F.lit(MARK)).otherwise(a["text"]))


def _kept(text: Column, keep, render, plain=lambda t: F.lit(False)) -> Column:
    numbered = F.transform(tokens_of(text), lambda t, i: F.struct(i.alias("i"), t["join"].alias("join"), t["token"].alias("token"), t["t"].alias("t")))
    return F.transform(F.filter(numbered, lambda t: keep(t["t"])), lambda t: F.struct(t["i"].alias("i"), t["join"].alias("join"), render(t["token"]).alias("text"), plain(t["t"]).alias("plain")))


def _cleaned(text: Column, source: Column, repeated: bool) -> Column:
    """Marks and the separators beside them as spaces, no separator at an end; the source where nothing is left."""
    text = F.regexp_replace(text, rf"\s*[-/,]?\s*{MARK}+\s*", " ")
    if repeated:
        text = F.regexp_replace(text, r"\s*([,/])(?:\s*[,/])+\s*", "$1 ")
    text = F.regexp_replace(ws_collapse(text), r"^[ \-/,]+|[ \-/,]+\z", "")
    return let(text, lambda t: F.when(t == "", ws_collapse(source)).otherwise(t))


def _built(text: Column, abv: Column, marker: Column, base: bool) -> Column:
    drop = lambda t: _droppable(t, abv, marker, base)
    plain = lambda s: _rejoined(_kept(s["text"], lambda t: ~drop(t), lambda t: _stripped(t, abv, marker, base)))
    group = lambda s: F.when(F.forall(group_tokens(s["inner"]), lambda t: drop(t["t"])), F.lit(MARK)).otherwise(s["text"])
    parts = F.transform(segments(text), lambda s: F.when(s["is_group"], group(s)).otherwise(plain(s)))
    return _cleaned(F.array_join(parts, ""), text, True)


def base_name(text: Column, abv: Column, marker: Column) -> Column:
    """The name without volume, strength, codes, age, proof, numbers and the version mark."""
    return _built(text, abv, marker, True)


def alcohol_name(text: Column, abv: Column) -> Column:
    """The name without volume, strength and codes; age, cask, batch, proof and version stay."""
    return _built(text, abv, F.lit(""), False)


def _standard(text: Column, ml: Column, package: Column) -> Column:
    """A token with its volume in ml and ``× n`` for a package."""
    shown = F.regexp_replace(text, F.lit(P.java(P.VOLUME)), F.concat(F.lit("$1"), ml.cast("string"), F.lit("ml")))
    several = F.regexp_replace(shown, F.lit(P.java(P.PACKAGE_DISPLAY)), F.concat(F.lit("$1 × "), package.cast("string")))
    return F.when(ml.isNull(), text).when(package.isNull(), shown).otherwise(several)


def display_name(text: Column, ml: Column, package: Column, abv: Column) -> Column:
    """The source wording with volumes in one spelling; groups of nothing but known values lose their brackets, codes go.  Blank stays."""

    def group(s: Column) -> Column:
        pieces = F.transform(group_tokens(s["inner"]), lambda t: t["t"])
        volume = lambda t: ml.isNotNull() & has(t, P.VOLUME_TOKEN)
        gone = lambda t: (t == "") | is_excluded_code(t)
        known = F.forall(pieces, lambda t: gone(t) | volume(t) | is_abv_token(t, abv))
        shown = F.array_join(F.transform(F.filter(pieces, lambda t: ~gone(t)), lambda t: F.when(volume(t), _standard(t, ml, package)).otherwise(F.concat(plain_number(abv), F.lit("%")))), " ")
        return F.when(~known, s["text"]).otherwise(let(shown, lambda t: F.when(t == "", F.lit(MARK)).otherwise(F.concat(F.lit(" "), t, F.lit(" ")))))

    def plain(s: Column) -> Column:
        return _rejoined(_kept(s["text"], lambda t: (t != "") & ~is_excluded_code(t), lambda t: _standard(t, ml, package), lambda t: has(t, P.VOLUME_TOKEN)))

    parts = F.transform(segments(text), lambda s: F.when(s["is_group"], group(s)).otherwise(plain(s)))
    return F.when(tidy(text) == "", text).otherwise(_cleaned(F.array_join(parts, ""), text, False))
