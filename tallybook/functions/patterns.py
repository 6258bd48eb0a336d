"""Patterns of the product-name rules, written once in RE2 syntax, and their Java form for Spark."""

from __future__ import annotations

# The patterns that the rules are defined by, in the order of the rules.
VOLUME = r"(?i)(^|[^A-Za-z0-9])((?:\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?)\s*(?:ml|l))\b"
PACKAGE_AFTER = r"^\s*[*x×X]\s*(\d+)"
PACKAGE_IN_NAME = r"((?:\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?)\s*(?:[mM][lL]|[lL]))\s*[*x×X]\s*\d+\s*(?:BTLS?|BOTTLES?|EA|PCS|병)?"
PACKAGE_DISPLAY = r"(?i)(\d+ml)\s*[*x×]\s*\d+"
COMPOSITION = r"(?i)인삼|송이|향료?|과즙|농축(?:액)?|원액|함유|추출물|침출액|주스|시럽|꿀|설탕|보리|호밀|몰트|곡물|아가베|RYE|ISLAY|POIRE|PEAR|APPLE|FRUIT|JUICE|EXTRACT|FLAVOU?R|CONCENTRATE|HONEY|SUGAR|MALT|GRAIN|AGAVE"
INGREDIENT_BEFORE = r"(?i)(?:인삼|송이|향료?|과즙|농축(?:액)?|원액|추출물|침출액|주스|시럽|꿀|설탕|보리|호밀|몰트|곡물|아가베|RYE|ISLAY|POIRE|PEAR|APPLE|FRUIT|JUICE|EXTRACT|FLAVOU?R|CONCENTRATE|HONEY|SUGAR|MALT|GRAIN|AGAVE)\s*[:=]?\s*$"
PERCENT = r"(\d+(?:\.\d+)?)\s*%"
DEGREE = r"(\d+(?:\.\d+)?)\s*도"
PROOF = r"(?i)(\d+(?:\.\d+)?)\s*(?:PROOF|프루프)"
STRONG_ABV = r"(?i)(?:주도\s*|ALC\.?\s*|ABV\s*[:.]?\s*)\d+(?:\.\d+)?\s*(?:%|도)|\(\s*\d+(?:\.\d+)?\s*%\s*(?:,\s*\d+(?:\.\d+)?\s*(?:ML|L))?\s*\)|(?:^|[\s(])\d+(?:\.\d+)?\s*%\s*(?:VOL\.?\b|,?\s*\d+(?:\.\d+)?\s*(?:ML|L)\b|$)|(?:^|\s)\d+(?:\.\d+)?\s*도\s*$"
#: Anchors of a strength, the first that counts wins; true for those that outrank ingredients.
ABV_ANCHORS = (
    (r"(?i)(?:주도\s*|ALC\.?\s*|ABV\s*[:.]?\s*)(\d+(?:\.\d+)?)\s*(?:%|도)", True),
    (r"(?i)\(\s*(\d+(?:\.\d+)?)\s*%\s*,\s*\d+(?:\.\d+)?\s*(?:ML|L)\s*\)", True),
    (r"(?i)(?:^|[\s(])(\d+(?:\.\d+)?)\s*%\s*,?\s*\d+(?:\.\d+)?\s*(?:ML|L)\b", False),
    (r"(?i)^\s*(\d+(?:\.\d+)?)\s*%\s*VOL\.?\b", True),
    (r"(?i)(?:^|[\s(])(\d+(?:\.\d+)?)\s*%\s*VOL\.?\b", True),
    (r"\(\s*(\d+(?:\.\d+)?)\s*%\s*\)", False),
    (r"(?:^|\s)(\d+(?:\.\d+)?)\s*%\s*$", False),
    (r"(?:^|\s)(\d+(?:\.\d+)?)\s*도\s*$", False),
)
STRENGTH = r"(?i)\b(?:CASK|BARREL)\s+(?:STRENGTH|STRENGHT|STRENGH|STRENCH)\b|\bOVERPROOF\b|캐스크\s*(?:스트렝스|스트랭스)|(?:배럴|바렐)\s*(?:스트렝스|스트랭스)"
STRENGTH_EN = r"(?i)\b(CASK|BARREL)\s+(?:STRENGTH|STRENGHT|STRENGH|STRENCH)\b"
CASK_STRENGTH_KO = r"캐스크\s*(?:스트렝스|스트랭스)"
BARREL_STRENGTH_KO = r"(?:배럴|바렐)\s*(?:스트렝스|스트랭스)"
LONE_CS = r"(?i)(?:^|[^A-Z0-9])CS(?:$|[^A-Z0-9])"
AGE_KO = r"(\d{1,3})\s*년(?:\s|$|[)\],-])"
AGE_EN = r"(?i)(\d{1,3})\s*(?:YO\b|YEARS?(?:\s+OLD)?\b)|\bAGED\s+(\d{1,3})\b"
YEAR = r"\b((?:1[5-9]|20)\d{2})\b"
LOT = r"(?i)(?:LOT\s*NO\.?|LOTE)\s*[:.]?\s*([A-Z0-9][A-Z0-9\s-]*)"
MANUFACTURE = r"(?i)제조번호\s*(?:NO\.?\s*)?[:.]?\s*([A-Z0-9][A-Z0-9\s-]*)"
LOT_SUFFIX = r"(?i)(?:^|[\s)])(L[0-9][A-Z0-9]{4,})\s*$"
MATERIAL_PARENS = r"\((\d{6})\)"
MATERIAL_SLASH = r"(?i)/\s*([A-Z0-9]{5,})\b"
BATCH_EN = r"(?i)\bBATCH\s*(?:(?:#|NO\.?)\s*)?(\d+)\b"
BATCH_KO = r"배치\s*(?:(?:#|No\.?)\s*)?(\d+)\b"
MARKER = r"(?i)(?:#|@|NO\.)\s*(\d+)"
SERIES = r"(?i)(?:\bSERIES|시리즈)\s+(\d+)\b"
MARKER_LABEL = r"(?i)(?:LOT|제조번호)\s*$"
BATCH_CONTEXT = r"(?i)(?:\bBATCH|배치)[^#@]{0,48}$"
SMALL_BATCH = r"(?i)\bSMALL\s+BATCH\b|스몰\s*배치"
EDITION_CONTEXT = r"(?i)(?:\bEDITION|에디션)[^#@]{0,48}$"
CASK_CONTEXT = r"(?i)(?:\b(?:SINGLE\s+)?CASK|\bBARREL|싱글\s*캐스크|캐스크|배럴|바렐)[^#@]{0,48}$"
SERIES_CONTEXT = r"(?i)(?:\bSERIES|시리즈)[^#@]{0,48}$"
EDITION_KO = r"(?:(?:서울|코리아|한국|리미티드|한정|특별|기념|면세|파이널)\s*)?에디션(?:\s*(?:(?:#|No\.?)\s*)?\d+(?:\s|$))?"
EDITION_EN = r"(?i)(?:(?:LIMITED|SPECIAL|COLLECTOR'?S|ANNIVERSARY|FINAL|TRAVEL|EXCLUSIVE|SEOUL|KOREA|\d{4})\s+)?EDITION(?:\s*(?:(?:#|NO\.?)\s*)?\d+(?:\s|$))?"
EDITION_NUMBER_KO = r"에디션\s*(?:(?:#|No\.?)\s*)?(\d+)"
EDITION_NUMBER_EN = r"(?i)\bEDITION\s*(?:(?:#|NO\.?)\s*)?(\d+)"
EXPIRY = r"^\s*(?:(\d{4}-\d{2}-\d{2}))?\s*~\s*(?:(\d{4}-\d{2}-\d{2}))?\s*$"
#: Whole tokens of names.
VOLUME_TOKEN = r"^(?:\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?)\s*(?:[mM][lL]|[lL])(?:\s*[*x×X]\s*\d+\s*(?:BTLS?|BOTTLES?|EA|PCS|병)?)?$"
PACKAGE_TOKEN = r"^[*x×X]\s*\d+\s*(?:BTLS?|BOTTLES?|EA|PCS|병)?$"
ABV_TOKEN = r"(?i)^(?:주도\s*|ALC\.?\s*)?(\d+(?:\.\d+)?)\s*(?:%|도)(?:\s*VOL\.?)?$"
PROOF_TOKEN = r"(?i)^\d+(?:\.\d+)?\s*(?:PROOF|프루프)$"
AGE_TOKEN = r"(?i)^(?:\d{1,3}\s*(?:년|YO|YEARS?(?:\s+OLD)?)|AGED\s+\d{1,3})$"
BATCH_TOKEN = r"(?i)^(?:BATCH|배치)\s*(?:(?:#|NO\.?)\s*)?\d+$"
STRENGTH_TOKEN = r"(?i)^(?:(?:CASK|BARREL)\s+(?:STRENGTH|STRENGHT|STRENGH|STRENCH)|OVERPROOF|캐스크\s*(?:스트렝스|스트랭스)|(?:배럴|바렐)\s*(?:스트렝스|스트랭스))$"
LOT_TOKEN = r"(?i)^(?:LOT\s*NO\.?|LOTE|제조번호)\s*[:.]?\s*[A-Z0-9]"
DATE_TOKEN = r"^\d{1,4}[./-]\d{1,2}(?:[./-]\d{1,4})?$"
MATERIAL_TOKEN = r"^(?:\d{6,}|[A-Z0-9]*GX[A-Z0-9]+)$"
BARE_LOT_TOKEN = r"^L[\s.-]?[A-Z0-9]+(?:[\s.-][A-Z0-9]+)*$"
OPAQUE_TOKEN = r"^[A-Z0-9]{1,4}[\s.-]?[A-Z0-9]{4,}$"

BORDER = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def java(pattern: str) -> str:
    """The same pattern for Java: ASCII word borders, the end of the text alone, case folding of all letters."""
    out, inside, i = [], False, 0
    if pattern.startswith("(?i)"):
        out.append("(?iu)")
        i = 4
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            out.append(BORDER if pattern[i + 1] == "b" else pattern[i : i + 2])
            i += 2
            continue
        if c in "[]":
            inside = c == "["
        out.append(r"\z" if c == "$" and not inside else c)
        i += 1
    return "".join(out)


def any_of(*patterns: str) -> str:
    """One Java pattern that matches where one of several does; each keeps its own flags."""
    return "|".join(f"(?:{java(p)})" for p in patterns)


def whole(pattern: str) -> str:
    """The same pattern, all of whose branches begin at the start of the text, tried there alone."""
    return f"^(?:{pattern})"


#: A lot code holds a digit, an opaque code a letter and two digits.
CODE = whole(f"(?=[^0-9]*[0-9]){java(BARE_LOT_TOKEN)}|(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9][^0-9]*[0-9]){java(OPAQUE_TOKEN)}")
STATED_CODE = whole(f"{any_of(LOT_TOKEN, DATE_TOKEN, MATERIAL_TOKEN)}|{CODE}")
