"""Text expressions with the semantics of the rules: ASCII word borders, Unicode white space, plain numbers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space beyond ASCII that the rules collapse and trim.
SPACES = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tidy(c: Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(c, rf"^{SPACES}|{SPACES}\z", "")


def ws_collapse(c: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def blank_to_null(c: Column) -> Column:
    return F.when(ws_collapse(c) != "", ws_collapse(c))


def search_key(c: Column) -> Column:
    """Lower case, straight quotes, plain dashes, single spaces."""
    return F.lower(ws_collapse(F.translate(c, "’‘–—－", "''---")))


def plain_number(c: Column) -> Column:
    """Shortest decimal text: 46, not 46.0."""
    text = c.cast("decimal(20,6)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")


def nfkc(c: Column) -> Column:
    """Compatibility composition; texts of ASCII and Hangul syllables are their own, so only others go through Python."""

    @F.pandas_udf("string")
    def composed(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    odd = c.rlike(r"[^\x00-\x7F가-힣]")
    return F.when(odd, composed(F.when(odd, c))).otherwise(c)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits; callers compose texts with ``nfkc`` first where they may need it."""
    return F.array_remove(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{Nd}]+"), "")


def jaccard(a: Column, b: Column) -> Column:
    """Share of common tokens, as sets; 0 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def contains_run(a: Column, b: Column) -> Column:
    """One token list is a contiguous part of the other; neither is empty."""
    x, y = (F.concat(F.lit(" "), F.array_join(t, " "), F.lit(" ")) for t in (a, b))
    return (F.size(a) > 0) & (F.size(b) > 0) & (x.contains(y) | y.contains(x))


def percent(part: Column, total: Column) -> Column:
    """Percent with two digits; 0 of nothing is 0."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(part * 100.0 / total, 2))
