"""Secret scans, in DataFrame functions only.

Three base kinds are patterns: assigned values, access key ids and long hex strings.  The method
adds a fourth: a candidate string that holds letters and digits is read once, keeping the counts of the characters in a sliding
window; each step adds one character and drops one, so the Shannon entropy
of every window comes from two updated terms.  A candidate is a secret if some window's entropy reaches the
level of its character class (hex, lower-case and digits, mixed).  An allow list suppresses
placeholders, examples, identifiers in UUID form and runs of a known alphabet; it never touches base spans.

Defined cases: a null text counts as empty and has no spans; texts of any length are read whole, in time that follows
their length; null ids are kept; repeated rows give repeated rows; spans of equal start stand in the order of their kinds; candidates shorter than the window are
not secrets; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import bound, fold, spans

#: Fixed values of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Candidates of the entropy scan start at a boundary and hold a digit and a letter.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits per character that a window of each class must reach; at most log2(16) and log2(20) are possible.
LEVELS = {"hex": 3.0, "lower": 3.4, "mixed": 3.7}
ALLOWED = (
    r"(?i)example|placeholder|dummy|changeme|redacted|your[_-]?(?:key|token|secret)|xxxx|test[_-]?key|"
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|abcdefghijklmnop|0123456789abcdef|(.)\1{7,}"
)
KINDS = ("assign", "access", "hex", "entropy")


def window_entropy(x: str, level: str, window: int = WINDOW) -> str:
    """SQL: whether the Shannon entropy, in bits per character, of some window of string x reaches ``level``.

    The state is the sum of c * log2(c) over the characters of the window.  A step adds one character and drops
    one; only the counts of these two change, by one each, so only their terms do.  Once the level is reached no more is counted.
    """
    term = lambda c: f"({c}) * log2(greatest({c}, 1))"
    # x, y: how often the coming and the going one stand in the window before
    count = lambda of: f"aggregate(sequence(greatest(i - {window}, 0), i - 1), 0, (n, k) -> n + if(c[k] = {of}, 1, 0))"
    goal = f"{window} * (log2({window}D) - {level}) + 1e-9"
    gone = f"if(n.y > 0, {term('n.y')} - {term('n.y - 1')}, 0D)"
    change = bound(f"n.x - if(n.y > 0 and c[i] = c[greatest(i - {window}, 0)], 1, 0)", "x", f"{term('x + 1')} - {term('x')} - {gone}")
    counted = f"if(i = 0, struct(0 as x, 0 as y), struct({count('c[i]')} as x, if(i >= {window}, {count(f'c[greatest(i - {window}, 0)]')}, 0) as y))"
    step = bound(counted, "n", bound(f"t.total + {change}", "total", f"struct(total as total, i + 1 >= {window} and total <= goal as hit)"))
    scanned = f"aggregate(sequence(0, array_size(c) - 1), struct(0D as total, false as hit), (t, i) -> case when t.hit then t else {step} end, t -> t.hit)"
    return f"(length({x}) >= {window} and {bound(goal, 'goal', bound(f'split({x}, r\'\')', 'c', scanned))})"


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, found: array of (kind number, s, e) of every span, base and added, by start and kind."""
    level = f"""case when v.x rlike '^[0-9a-fA-F]+$' then {LEVELS['hex']}D when v.x rlike '^[0-9a-z]+$' then {LEVELS['lower']}D else {LEVELS['mixed']}D end"""
    df = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    df = df.select("doc_id", F.expr(spans("t", ASSIGN)).alias("assign"), F.expr(spans("t", ACCESS)).alias("access"), F.expr(spans("t", HEX)).alias("hex"), F.expr(spans("t", CANDIDATE)).alias("entropy"))
    quoted_value = ASSIGN_VALUE.replace("'", r"\x27")
    as_kind = lambda column, k: f"transform({column}, v -> struct(v.s as s, {k} as k, v.e as e))"
    df = df.select("doc_id", F.expr(f"""concat({as_kind(f"filter(assign, v -> length(regexp_extract(v.x, r'{quoted_value}', 1)) >= 8)", 0)}, {as_kind('access', 1)}, {as_kind('hex', 2)})""").alias("base"), "entropy")
    # candidates inside a base span: a scan by start, base spans first, that keeps the furthest end of a base span
    none = "cast(array() as array<struct<s:int,e:int,x:string>>)"
    both = "array_sort(concat(transform(base, v -> struct(v.s as s, 0 as k, -v.e as back, '' as x)), transform(entropy, v -> struct(v.s as s, 1 as k, -v.e as back, v.x as x))))"
    step = """case when m.k = 0 then struct(greatest(a.state, -m.back) as state, a.out as out) when a.state >= -m.back then a
        else struct(a.state as state, array_append(a.out, struct(m.s as s, -m.back as e, m.x as x)) as out) end"""
    outside = f"case when size(entropy) = 0 or size(base) = 0 then entropy else {fold(both, '0', none, step)} end"
    added = f"""filter({outside}, v -> not v.x rlike r"{ALLOWED}" and {window_entropy('v.x', level)})"""
    return df.select("doc_id", F.expr("array_sort(base)").alias("base"), F.expr(f"array_sort(concat(base, {as_kind(added, 3)}))").alias("found"))


def joined(column: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({column}, v -> concat_ws(':', array({names})[v.k], cast(v.s as string), cast(v.e as string))), ',')"


def secret_digest(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_entropy."""
    found = scan(df, doc_id, text)
    count = lambda k: F.expr(f"cast(size(filter(found, v -> v.k = {k})) as bigint)")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(F.expr(joined("base")), 256).alias("base_sha256"), F.expr(joined("found")).alias("spans"), count(3).alias("n_entropy"),
    )
