"""The rules of the product names once more, as DuckDB SQL over the items: what the oracles compare with."""

from __future__ import annotations

from tallybook.functions import patterns as P
from tallybook.operators.derive import CASKS, COUNTRIES, GENERIC_EN, GENERIC_KO, SPELLINGS
from tallybook.operators.normalize import CATEGORIES, LEGAL_FORMS
from tallybook.sources import ledger


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q(pattern)})"


def first(text: str, pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({text}, {q(pattern)}, {group}), '')"


def every(text: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({text}, {q(pattern)}, {group})"


def canonical(number: str) -> str:
    return f"CAST(CAST({number} AS BIGINT) AS VARCHAR)"


def _composed(text: str, at: str, length: str) -> str:
    low = f"greatest({at} - 16, 1)"
    return has(f"substr({text}, {low}, {at} + {length} + 16 - {low})", P.COMPOSITION)


def _share(raw: str) -> str:
    return f"CAST(regexp_extract({raw}, '^[0-9.]+') AS DOUBLE)"


def _anchor(text: str, want: str) -> str:
    """The value, the whole match or the rank of the first anchor that counts."""
    out = []
    for k, (p, explicit) in enumerate(P.ABV_ANCHORS):
        whole, value = f"regexp_extract({text}, {q(p)}, 0)", f"regexp_extract({text}, {q(p)}, 1)"
        at = f"(instr({text}, {whole}) + instr({whole}, {value}) - 1)"
        ok = has(text, p) + ("" if explicit else f" AND NOT {_composed(text, at, f'length({value})')}")
        out.append(f"WHEN {ok} THEN " + {"value": f"CAST({value} AS DOUBLE)", "whole": whole, "explicit": str(explicit).lower()}[want])
    return "CASE " + " ".join(out) + " END"


def _ingredients(text: str) -> str:
    stated = " OR ".join(f"contains(regexp_extract({text}, {q(p)}, 0), r)" for p, explicit in P.ABV_ANCHORS if explicit)
    return f"[r FOR r IN {every(text, P.PERCENT)} IF {_composed(text, f'instr({text}, r)', 'length(r)')} AND NOT ({stated})]"


def _named(text: str, ingredients: str) -> str:
    before = f"substr({text}, greatest(instr({text}, r) - 16, 1), least(instr({text}, r) - 1, 16))"
    return f"[{_share('r')} FOR r IN {ingredients} IF {has(before, P.INGREDIENT_BEFORE)}]"


def _strength(text: str) -> str:
    return (
        f"CASE WHEN {has(text, P.STRENGTH_EN)} THEN upper(regexp_extract({text}, {q(P.STRENGTH_EN)}, 1)) || ' STRENGTH' WHEN {has(text, P.CASK_STRENGTH_KO)} THEN 'CASK STRENGTH' "
        f"WHEN {has(text, P.BARREL_STRENGTH_KO)} THEN 'BARREL STRENGTH' WHEN contains(upper({text}), 'OVERPROOF') THEN 'OVERPROOF' END"
    )


def _labelled(text: str, want: str) -> str:
    clean = lambda c: f"regexp_replace(trim(regexp_replace(trim({c}), '^[)\\]]+|[)\\]]+$', '', 'g')), '\\s+', ' ', 'g')"
    made, lot, end = first(text, P.MANUFACTURE, 1), first(text, P.LOT, 1), first(text, P.LOT_SUFFIX, 1)
    if want == "any":
        return f"({made} IS NOT NULL OR {lot} IS NOT NULL OR {end} IS NOT NULL)"
    return clean(made) if want == "made" else f"CASE WHEN {made} IS NULL THEN coalesce({clean(lot)}, {end}) END"


def _code(t: str) -> str:
    return f"(({has(t, P.BARE_LOT_TOKEN)} AND {has(t, '[0-9]')}) OR ({has(t, P.OPAQUE_TOKEN)} AND {has(t, '[A-Z]')} AND {has(t, '[0-9].*[0-9]')}))"


def _tokens(text: str) -> str:
    hidden = f"regexp_replace({text}, '([0-9]),([0-9])', '\\1' || chr(2) || '\\2', 'g')"
    return f"[trim(replace(t, chr(2), ',')) FOR t IN string_split_regex(regexp_replace({hidden}, '[()\\[\\]]', ',', 'g'), '[,/]')]"


def _marker(text: str, want: str) -> str:
    series, raw = first(text, P.SERIES), first(text, P.MARKER)
    prefix = f"regexp_extract({text}, {q('(?is)^(.*?)(?:#|@|NO\\.)\\s*\\d+')}, 1)"
    kind = (
        f"CASE WHEN {has(prefix, P.EDITION_CONTEXT)} THEN 'EDITION_NUMBER' WHEN starts_with({raw}, '@') OR {has(prefix, P.SERIES_CONTEXT)} THEN 'SERIES_NUMBER' "
        f"WHEN {has(f'regexp_replace({prefix}, {q(P.SMALL_BATCH)}, {q('')}, {q('g')})', P.BATCH_CONTEXT)} THEN 'BATCH_NUMBER' WHEN {has(prefix, P.CASK_CONTEXT)} THEN 'CASK_NUMBER' ELSE 'UNKNOWN' END"
    )
    return {
        "raw": f"coalesce({series}, {raw})", "value": f"coalesce({first(text, P.SERIES, 1)}, {first(text, P.MARKER, 1)})",
        "kind": f"CASE WHEN {series} IS NOT NULL THEN 'SERIES_NUMBER' WHEN {raw} IS NOT NULL THEN {kind} END",
    }[want]


def _edition_number(c: str) -> str:
    return canonical(f"coalesce({first(c, P.EDITION_NUMBER_KO, 1)}, {first(c, P.EDITION_NUMBER_EN, 1)})")


def _country(column: str, k: int) -> str:
    return f"CASE trim({column}) " + " ".join(f"WHEN {q(r[0])} THEN {q(r[k])}" for r in COUNTRIES) + " END"


def _list(*values: str) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


_VOLUMES = (
    "[v FOR v IN [{{'raw': r, 'ml': CAST(replace(regexp_extract(r, '^[0-9.,]+'), ',', '') AS DOUBLE) * CASE WHEN lower(r) LIKE '%ml' THEN 1 ELSE 1000 END}} "
    "FOR r IN {0}] IF v.ml > 0 AND v.ml = round(v.ml)]"
)
_BOTH = "trim(ko || ' ' || en)"
_PACKAGE = P.VOLUME + r"(?:\s*[*x×X]\s*(\d+))?"
_EXPIRY_BAD = f"""(trim(expiry_text) NOT IN ('', '-') AND (NOT {has('expiry_text', P.EXPIRY)} OR ({first('expiry_text', P.EXPIRY, 1)} IS NOT NULL AND try_cast({first('expiry_text', P.EXPIRY, 1)} AS DATE) IS NULL)
 OR ({first('expiry_text', P.EXPIRY, 2)} IS NOT NULL AND try_cast({first('expiry_text', P.EXPIRY, 2)} AS DATE) IS NULL) OR coalesce({first('expiry_text', P.EXPIRY, 1)}, {first('expiry_text', P.EXPIRY, 2)}) IS NULL))"""

#: ``r``: one row an item with every field that one pattern decides, then those that need several.
FIELDS = f"""WITH items AS ({ledger.ITEMS}), s AS (SELECT *, product_name_ko ko, product_name_en en FROM items),
f AS (SELECT *, {_VOLUMES.format(every('ko', P.VOLUME, 2))} kv, {_VOLUMES.format(every('en', P.VOLUME, 2))} ev,
 {first('ko', P.AGE_KO, 1)} ka, coalesce({first('en', P.AGE_EN, 1)}, {first('en', P.AGE_EN, 2)}) ea, {canonical(first('ko', P.BATCH_KO, 1))} kb, {canonical(first('en', P.BATCH_EN, 1))} eb,
 {every('ko', P.PERCENT)} kp, {every('en', P.PERCENT)} ep, {_ingredients('ko')} ki, {_ingredients('en')} ei,
 {_anchor('ko', 'value')} kav, {_anchor('en', 'value')} eav, {_anchor('ko', 'whole')} kaw, {_anchor('en', 'whole')} eaw, {_anchor('ko', 'explicit')} kax, {_anchor('en', 'explicit')} eax,
 coalesce({first(_BOTH, P.MATERIAL_PARENS, 1)}, CASE WHEN {has(f'regexp_extract({_BOTH}, {q(P.MATERIAL_SLASH)}, 1)', '[0-9]')} THEN {first(_BOTH, P.MATERIAL_SLASH, 1)} END) material_code,
 CAST({first(_BOTH, P.PROOF, 1)} AS DOUBLE) proof, {first(_BOTH, P.PROOF)} proof_raw, coalesce({_strength('ko')}, {_strength('en')}) strength_type,
 {first('trim(ko)', P.EDITION_KO)} kedition, {first('trim(en)', P.EDITION_EN)} eedition, CASE WHEN contains(ko, '구형') THEN '구형' END version_marker, {_labelled('ko', 'any')} k_label, {_labelled('en', 'any')} e_label,
 {_EXPIRY_BAD} expiry_bad, CASE WHEN {has('expiry_text', P.EXPIRY)} THEN try_cast({first('expiry_text', P.EXPIRY, 1)} AS DATE) END expiry_first, CASE WHEN {has('expiry_text', P.EXPIRY)} THEN try_cast({first('expiry_text', P.EXPIRY, 2)} AS DATE) END expiry_last,
 coalesce({', '.join(first("ko || ' ' || en", p) for p in CASKS)}) cask_raw,
 coalesce({_marker('ko', 'raw')}, {_marker('en', 'raw')}) mraw, CASE WHEN {_marker('ko', 'raw')} IS NOT NULL THEN {_marker('ko', 'kind')} ELSE {_marker('en', 'kind')} END mkind, coalesce({_marker('ko', 'value')}, {_marker('en', 'value')}) mvalue,
 ({has('ko', P.LONE_CS)} OR {has('en', P.LONE_CS)}) cs FROM s),
g AS (SELECT *, list_concat(kv, ev) vols, list_concat(ki, ei) ing, list_concat({_named('ko', 'ki')}, {_named('en', 'ei')}) named FROM f),
h AS (SELECT *, coalesce(kav IS NOT NULL AND (kax OR NOT list_contains(named, kav)), false) kok, coalesce(eav IS NOT NULL AND (eax OR NOT list_contains(named, eav)), false) eok,
 len(list_distinct([v.ml FOR v IN vols])) n_ml, list_distinct([{_share('x')} FOR x IN ing]) shares FROM g),
r AS (SELECT *, CAST(CASE WHEN n_ml = 1 THEN vols[1].ml END AS INTEGER) unit_volume_ml, vols[1].raw volume_raw,
 CASE WHEN n_ml = 1 THEN nullif(try_cast(nullif(regexp_extract(CASE WHEN len(kv) > 0 THEN ko ELSE en END, {q(_PACKAGE)}, 3), '') AS INTEGER), 0) END package_count,
 coalesce(ka <> ea, false) AND CAST(ka AS INTEGER) <> CAST(ea AS INTEGER) age_conflict, CASE WHEN NOT (coalesce(ka <> ea, false) AND CAST(ka AS INTEGER) <> CAST(ea AS INTEGER)) THEN CAST(coalesce(ka, ea) AS INTEGER) END age_years,
 coalesce(kb, eb, CASE WHEN mkind = 'BATCH_NUMBER' THEN {canonical('mvalue')} END) batch_number, coalesce(kb <> eb, false) batch_conflict,
 len([x FOR x IN kp IF NOT {_composed('ko', 'instr(ko, x)', 'length(x)')} AND NOT (kok AND contains(kaw, x))]) + len([x FOR x IN ep IF NOT {_composed('en', 'instr(en, x)', 'length(x)')} AND NOT (eok AND contains(eaw, x))]) > 0 abv_loose,
 CASE WHEN kok THEN kav END kabv, CASE WHEN eok THEN eav END eabv,
 CASE WHEN k_label THEN {_labelled('ko', 'made')} ELSE {_labelled('en', 'made')} END manufacture_no,
 CASE WHEN k_label THEN {_labelled('ko', 'lot')} WHEN e_label THEN {_labelled('en', 'lot')} ELSE [t FOR t IN list_concat({_tokens('ko')}, {_tokens('en')}) IF starts_with(t, 'L') AND {_code('t')} AND t IS DISTINCT FROM material_code][1] END lot_code,
 trim(coalesce(kedition, eedition)) edition_name, coalesce({_edition_number('kedition')} <> {_edition_number('eedition')}, false) edition_conflict,
 coalesce(mraw, CASE WHEN cs AND strength_type IS NULL THEN 'CS' END) variant_marker_raw, coalesce(mkind, CASE WHEN cs AND strength_type IS NULL THEN 'STRENGTH_ABBREVIATION' END) variant_marker_type,
 coalesce(mvalue, CASE WHEN cs AND strength_type IS NULL THEN 'CS' END) variant_marker_value, cs AND strength_type IS NULL lone, CASE WHEN mkind = 'CASK_NUMBER' THEN {canonical('mvalue')} END cask_number,
 regexp_replace(cask_raw, '\\s+', ' ', 'g') cask_type, trim(importer_name) importer_base, coalesce({', '.join(f"CASE WHEN starts_with(trim(importer_name), {q(x)}) THEN {q(x)} END" for x in LEGAL_FORMS)}) legal_form,
 CASE trim(item_name) {' '.join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CATEGORIES.items())} END category_en,
 {_country('manufacture_country_name', 1)} country_en, {_country('manufacture_country_name', 3)} country_alpha3, CASE WHEN len(shares) = 1 THEN shares[1] END ingredient_percent,
 CASE WHEN len(ing) > 0 THEN array_to_string([regexp_replace(x, '\\s', '', 'g') FOR x IN ing], ', ') END ingredient_raw FROM h)
"""
ABV = "CASE WHEN abs(coalesce(kabv, eabv) - coalesce(eabv, kabv)) <= 1e-7 AND coalesce(kabv, eabv) > 0 AND coalesce(kabv, eabv) <= 70 THEN coalesce(kabv, eabv) END"
ABV_REASONS = """array_to_string([x FOR x IN [CASE WHEN len(ing) > 0 THEN 'ABV_COMPOSITION_CONTEXT' END, CASE WHEN len(shares) > 1 THEN 'INGREDIENT_PERCENT_MULTIPLE_VALUES' END, CASE WHEN abv_loose THEN 'ABV_AMBIGUOUS_POSITION' END,
 CASE WHEN abs(kabv - eabv) > 1e-7 THEN 'ABV_CONFLICT_BETWEEN_LANGUAGES' WHEN coalesce(kabv, eabv) <= 0 OR coalesce(kabv, eabv) > 70 THEN 'ABV_OUT_OF_AUTOMATIC_RANGE' END] IF x IS NOT NULL], ',')"""
SPELLED = "lower(trim({0}))"
for _a, _b in SPELLINGS:
    SPELLED = f"replace({SPELLED}, {q(_a)}, {q(_b)})"
GENERIC = f"(replace({{0}}, ' ', '') IN {_list(*GENERIC_KO)} OR ({{0}} = '' AND {{1}} IN {_list(*GENERIC_EN)}))"


# Names: groups and plain pieces, their tokens, and what is kept of them.
_MARK = "chr(1)"
_SEGMENTS = r"\[[^\[\]]*\]|\((?:[^()]|\([^()]*\))*\)|[^(\[]+|[(\[].*"
#: The phrase patterns with the known strength in place of any number.
_ABV_NUMBER = "CASE WHEN abv = floor(abv) THEN CAST(CAST(abv AS BIGINT) AS VARCHAR) || '(?:\\.0+)?' ELSE replace(CAST(abv AS VARCHAR), '.', '\\.') || '0*' END"
_PHRASE = (
    r"(?i)(?:주도\s*|ALC\.?\s*|ABV\s*[:.]?\s*)@\s*(?:%|도)|\(\s*@\s*%\s*(?:,\s*\d+(?:\.\d+)?\s*(?:ML|L))?\s*\)|(?:^|[\s(])@\s*%\s*(?:VOL\.?\b|,?\s*\d+(?:\.\d+)?\s*(?:ML|L)\b|$)|(?:^|\s)@\s*도\s*$"
)
_STATED_CODE = lambda t: f"({has(t, P.LOT_TOKEN)} OR {has(t, P.DATE_TOKEN)} OR {has(t, P.MATERIAL_TOKEN)} OR {_code(t)})"


def _abv_token(t: str) -> str:
    return f"coalesce({has(t, '^[0-9]')} AND contains({t}, '%') AND CAST({first(t, P.ABV_TOKEN, 1)} AS DOUBLE) = abv, false)"


def _drop(t: str, base: bool) -> str:
    whole = f"coalesce(trim(regexp_extract({t}, phrase)) = {t} AND {t} <> '', false)"
    out = f"({t} = '' OR {has(t, P.VOLUME_TOKEN)} OR {has(t, P.PACKAGE_TOKEN)} OR {_abv_token(t)} OR {whole} OR {_STATED_CODE(t)}"
    if base:
        out += f" OR {has(t, P.PROOF_TOKEN)} OR {has(t, P.AGE_TOKEN)} OR (marker <> '' AND {t} = trim(marker)) OR {has(t, P.BATCH_TOKEN)} OR {has(t, P.STRENGTH_TOKEN)}"
    return out + ")"


def _sub(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {pattern if pattern == 'phrase' else q(pattern)}, {by}, 'g')"


def _strip(t: str, base: bool) -> str:
    t = _sub(_sub(t, P.PACKAGE_IN_NAME, "'\\1'"), "phrase", _MARK)
    t = _sub(t, P.VOLUME, f"'\\1' || {_MARK}")
    for p in (P.LOT, P.MANUFACTURE, P.LOT_SUFFIX, P.MATERIAL_SLASH) + ((P.PROOF, P.STRENGTH, P.AGE_KO, P.AGE_EN, P.BATCH_EN, P.BATCH_KO) if base else ()):
        t = _sub(t, p, _MARK)
    return f"replace(CASE WHEN marker <> '' THEN replace({t}, marker, {_MARK}) ELSE {t} END, '구형', {_MARK})" if base else t


def _pieces(text: str) -> str:
    """Tokens of a text; commas between digits hide as chr(2)."""
    return f"[replace(t, chr(2), ',') FOR t IN string_split_regex(regexp_replace({text}, '([0-9]),([0-9])', '\\1' || chr(2) || '\\2', 'g'), '[,/]')]"


def _rejoin(seg: str, kept: str, render: str, plain: str = "false") -> str:
    """Kept tokens joined again; ``kept``, ``render`` and ``plain`` are SQL over the trimmed token {t} and the token {r}."""
    toks = _pieces(seg)
    seps = f"regexp_extract_all(regexp_replace({seg}, '([0-9]),([0-9])', '\\1' || chr(2) || '\\2', 'g'), '[,/]')"
    at = lambda x, i: x.replace("{t}", f"trim(toks[{i}])").replace("{r}", f"toks[{i}]")
    before = f"len([j FOR j IN range(1, i) IF {at(kept, 'j')}])"
    join = f"CASE WHEN {at(plain, 'i')} THEN ' ' WHEN {before} = 0 THEN '' WHEN {at(kept, 'i - 1')} THEN seps[i - 1] ELSE ' ' END"
    out = f"[{join} || {at(render, 'i')} FOR i IN range(1, len(toks) + 1) IF {at(kept, 'i')}]"
    # one-element lists stand in for local names
    body = f"CASE WHEN len({out}) = 0 THEN {_MARK} ELSE array_to_string({out}, '') END".replace("toks[", "x.toks[").replace("len(toks)", "len(x.toks)").replace("seps[", "x.seps[")
    return f"[{body} FOR x IN [{{'toks': {toks}, 'seps': {seps}}}]][1]"


def _clean(text: str, source: str, repeated: bool) -> str:
    out = f"regexp_replace({text}, '\\s*[-/,]?\\s*' || {_MARK} || '+\\s*', ' ', 'g')"
    if repeated:
        out = f"regexp_replace({out}, '\\s*([,/])(?:\\s*[,/])+\\s*', '\\1 ', 'g')"
    out = f"regexp_replace(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '^[ \\-/,]+|[ \\-/,]+$', '', 'g')"
    return f"coalesce(nullif({out}, ''), trim(regexp_replace({source}, '\\s+', ' ', 'g')))"


def _inner(seg: str) -> str:
    return f"CASE WHEN {has(f'trim(substr({seg}, 2, length({seg}) - 2))', P.DATE_TOKEN)} THEN [substr({seg}, 2, length({seg}) - 2)] ELSE {_pieces(f'substr({seg}, 2, length({seg}) - 2)')} END"


_IS_GROUP = "(g ~ '^\\(.*\\)$' OR g ~ '^\\[.*\\]$')"


def _build(text: str, base: bool) -> str:
    gone = f"len([1 FOR t IN {_inner('g')} IF NOT {_drop('trim(t)', base)}]) = 0"
    plain = _rejoin("g", f"NOT {_drop('{t}', base)}", _strip("{r}", base))
    segs = f"[CASE WHEN {_IS_GROUP} THEN CASE WHEN {gone} THEN {_MARK} ELSE g END ELSE {plain} END FOR g IN regexp_extract_all({text}, {q(_SEGMENTS)})]"
    return _clean(f"array_to_string({segs}, '')", text, True)


def _shown(t: str) -> str:
    out = _sub(t, P.VOLUME, "'\\1' || CAST(ml AS VARCHAR) || 'ml'")
    return f"CASE WHEN ml IS NULL THEN {t} WHEN package_count IS NULL THEN {out} ELSE {_sub(out, P.PACKAGE_DISPLAY, chr(39) + chr(92) + '1 × ' + chr(39) + ' || CAST(package_count AS VARCHAR)')} END"


def _display(text: str) -> str:
    value = lambda t: f"({has(t, P.VOLUME_TOKEN)} OR {has(t, P.ABV_TOKEN)} OR {has(t, P.PACKAGE_TOKEN)} OR {has(t, P.AGE_TOKEN)})"
    code = lambda t: f"(NOT {value(t)} AND {_STATED_CODE(t)})"
    volume = lambda t: f"(ml IS NOT NULL AND {has(t, P.VOLUME_TOKEN)})"
    number = "CASE WHEN abv = floor(abv) THEN CAST(CAST(abv AS BIGINT) AS VARCHAR) ELSE CAST(abv AS VARCHAR) END || '%'"
    known = f"len([1 FOR t IN {_inner('g')} IF NOT (trim(t) = '' OR {code('trim(t)')} OR {volume('trim(t)')} OR {_abv_token('trim(t)')})]) = 0"
    shown = f"array_to_string([CASE WHEN {volume('trim(t)')} THEN {_shown('trim(t)')} ELSE {number} END FOR t IN {_inner('g')} IF trim(t) <> '' AND NOT {code('trim(t)')}], ' ')"
    group = f"CASE WHEN NOT ({known}) THEN g WHEN {shown} = '' THEN {_MARK} ELSE ' ' || {shown} || ' ' END"
    plain = _rejoin("g", f"({{t}} <> '' AND NOT {code('{t}')})", _shown("{r}"), has("{t}", P.VOLUME_TOKEN))
    segs = f"[CASE WHEN {_IS_GROUP} THEN {group} ELSE {plain} END FOR g IN regexp_extract_all({text}, {q(_SEGMENTS)})]"
    return f"CASE WHEN trim({text}) = '' THEN {text} ELSE {_clean(f'array_to_string({segs}, {q(str())})', text, False)} END"


_NONE = "CAST(NULL AS DOUBLE) abv, '[^\\s\\S]' phrase, '' marker"
NAMES = FIELDS.rstrip() + f""",
n0 AS (SELECT *, unit_volume_ml ml, {ABV} abv, CASE WHEN variant_marker_type IN ('CASK_NUMBER', 'BATCH_NUMBER', 'EDITION_NUMBER') THEN variant_marker_raw ELSE '' END marker FROM r),
n1 AS (SELECT *, coalesce(replace({q(_PHRASE)}, '@', {_ABV_NUMBER}), '[^\\s\\S]') phrase FROM n0),
n2 AS (SELECT *, {_display('ko')} display_ko, {_display('en')} display_en, {_build('ko', False)} alcohol_ko, {_build('en', False)} alcohol_en FROM n1),
n3 AS (SELECT *, {_build('display_ko', True)} base_ko, {_build('display_en', True)} base_en FROM n2),
y0 AS (SELECT item_id yid, ko yko, en yen, {_NONE} FROM r),
y AS (SELECT yid, list_sort(list_distinct([CAST(t AS INTEGER) FOR t IN regexp_extract_all({_build('yko', True)} || ' ' || {_build('yen', True)}, {q(P.YEAR)}, 1) IF CAST(t AS INTEGER) BETWEEN 1950 AND 2026])) yrs FROM y0),
n AS (SELECT n3.*, yrs, yrs[1] vintage_year, CASE WHEN trim(en) <> '' THEN {SPELLED.format('base_ko')} ELSE lower(base_ko) END key_ko, lower(base_en) key_en FROM n3 JOIN y ON yid = item_id),
m AS (SELECT *, {GENERIC.format('key_ko', 'key_en')} generic_name FROM n),
z AS (SELECT *, array_to_string([x FOR x IN [CASE WHEN n_ml > 1 THEN 'VOLUME_AMBIGUOUS' END, CASE WHEN ml IS NOT NULL AND contains(volume_raw, ',') THEN 'VOLUME_THOUSANDS_SEPARATOR' END,
 CASE WHEN ml IS NOT NULL AND regexp_matches(volume_raw, '[ML]') THEN 'VOLUME_UNIT_CASE_NORMALIZED' END, CASE WHEN package_count IS NOT NULL THEN 'PACKAGE_COUNT_EXCLUDED_FROM_BOTTLE_SKU' END,
 nullif({ABV_REASONS}, ''), CASE WHEN age_conflict THEN 'AGE_CONFLICT_BETWEEN_LANGUAGES' WHEN age_years IS NOT NULL THEN 'AGE_EXTRACTED' END,
 CASE WHEN manufacture_no IS NOT NULL THEN 'MANUFACTURE_NUMBER_LABELED_EXCLUDED_FROM_SKU' WHEN (k_label AND {first('ko', P.LOT)} IS NOT NULL) OR (NOT k_label AND e_label AND {first('en', P.LOT)} IS NOT NULL) THEN 'LOT_LABELED_EXCLUDED_FROM_SKU'
  WHEN k_label OR e_label THEN 'LOT_SUFFIX_CODE_EXCLUDED_FROM_SKU' END, CASE WHEN material_code IS NOT NULL THEN 'MATERIAL_CODE_PRESERVED_FOR_SKU' END,
 CASE WHEN NOT k_label AND NOT e_label AND lot_code IS NOT NULL THEN 'LOT_UNLABELED_CODE' END, CASE WHEN cask_number IS NOT NULL THEN 'CASK_NUMBER_PRESERVED_FOR_SKU' END,
 CASE WHEN mkind = 'UNKNOWN' THEN 'HASH_NUMBER_AMBIGUOUS' END, CASE WHEN mkind = 'UNKNOWN' OR several THEN 'VARIANT_MARKER_AMBIGUOUS' END, CASE WHEN batch_conflict THEN 'BATCH_VALUE_CONFLICT' END,
 CASE WHEN proof IS NOT NULL THEN 'PROOF_PRESERVED_FOR_SKU' END, CASE WHEN lone THEN 'STRENGTH_ABBREVIATION_AMBIGUOUS' END, CASE WHEN edition_conflict THEN 'EDITION_VALUE_CONFLICT' END,
 CASE WHEN version_marker IS NOT NULL THEN 'KO_VERSION_MARKER_WITHOUT_ENGLISH_MAPPING' END, CASE WHEN contains(ko, '(') AND contains(ko, ')') THEN 'PARENTHESIS_SEMANTIC_TEXT' END,
 CASE WHEN len(yrs) > 0 THEN 'VINTAGE_YEAR_REVIEW_REQUIRED' END, CASE WHEN trim(item_name) <> '' AND category_en IS NULL THEN 'ALCOHOL_CATEGORY_NOT_MAPPED' END,
 CASE WHEN trim(manufacture_country_name) <> '' AND country_en IS NULL THEN 'MANUFACTURE_COUNTRY_NOT_MAPPED' END, CASE WHEN cask_type IS NOT NULL THEN 'CASK_TYPE_CANDIDATE_EXTRACTED' END,
 CASE WHEN generic_name THEN 'GENERIC_PRODUCT_NAME_REVIEW_REQUIRED' WHEN trim(ko) || trim(en) <> '' AND ml IS NULL THEN 'VOLUME_MISSING' END] IF x IS NOT NULL], ',') reasons
 FROM (SELECT *, CASE WHEN {_marker('ko', 'raw')} IS NOT NULL THEN {canonical(_marker('ko', 'value'))} IS DISTINCT FROM {canonical(_marker('en', 'value'))} OR {_marker('ko', 'kind')} IS DISTINCT FROM {_marker('en', 'kind')} END AND {_marker('en', 'raw')} IS NOT NULL
   OR ({first('en', P.SERIES)} IS NOT NULL AND {first('en', P.MARKER)} IS NOT NULL) several FROM m)),
d AS (SELECT *, CASE WHEN regexp_matches(reasons, 'AMBIGUOUS|MULTIPLE|CONFLICT|OUT_OF|PROOF|REVIEW_REQUIRED|NOT_MAPPED') THEN 'REVIEW_REQUIRED' WHEN expiry_bad THEN 'PARTIAL' ELSE 'NORMALIZED' END normalization_status,
 CASE WHEN NOT generic_name AND ml IS NOT NULL THEN sha256(replace(replace(replace(CAST(to_json([coalesce(CAST(x AS VARCHAR), '') FOR x IN [key_ko, key_en, CAST(ml AS VARCHAR), CAST(age_years AS VARCHAR), CAST(vintage_year AS VARCHAR),
  CASE WHEN abv = floor(abv) THEN CAST(CAST(abv AS BIGINT) AS VARCHAR) ELSE CAST(abv AS VARCHAR) END, CASE WHEN proof = floor(proof) THEN CAST(CAST(proof AS BIGINT) AS VARCHAR) ELSE CAST(proof AS VARCHAR) END, strength_type, version_marker, edition_name,
  material_code, cask_number, batch_number, CASE WHEN variant_marker_type IN ('UNKNOWN', 'STRENGTH_ABBREVIATION') THEN variant_marker_raw END,
  CASE WHEN variant_marker_type IN ('UNKNOWN', 'STRENGTH_ABBREVIATION', 'SERIES_NUMBER') THEN variant_marker_type END,
  CASE WHEN variant_marker_type IN ('UNKNOWN', 'STRENGTH_ABBREVIATION') THEN variant_marker_value WHEN variant_marker_type = 'SERIES_NUMBER' THEN {canonical('variant_marker_value')} END]]) AS VARCHAR), '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')) END sku_key FROM z)
"""
