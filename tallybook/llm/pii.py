"""Personal data by format-preserving Feistel pseudonyms, in DataFrame functions only.

Numbers and dates are found by pattern, validated (Luhn digit, octet ranges, calendar, lengths of telephone numbers) and
replaced by a keyed permutation of their own format: a card number becomes another valid card number of its
length and spacing, an address another address, a date another date of the same 400 years.  A
permutation maps equal values to equal values, so records stay linked across documents, and different
values never collide.  Eight Feistel rounds over two mixed-radix halves use keyed SHA-256 as round
function.  E-mail addresses, which have no fixed format, get keyed pseudonyms.

Patterns take either case, and let a few non-alphanumeric characters stand between the parts of a telephone
number.  Telephone numbers are international ones (a plus sign and 8 to 15 digits) and national ones of ten digits in three groups whose area and
exchange do not start with 0 or 1; the last ten digits (seven of short ones) move, so a number with its country code stays linked to the
same without.  Of a run of digit groups that is no card as a whole, the longest part between group borders that is one is taken.  A date of days and months is read day
first, and month first where only that is a date.  Numbers that fail validation are not personal data and stay.

Defined cases: a null text stays null with zero counts; an empty text stays; texts of any length are searched whole, in time that follows their length; a local part
of an e-mail address has at most 64 characters; null ids are kept; repeated rows and equal values give equal results; of kinds that match at one place
the first listed wins; all other columns pass through, whatever their names, and output columns replace columns of
the same names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import bound, quoted

ROUNDS = 8
EMAIL = r"(?i)[a-z0-9][a-z0-9._%+-]{0,63}@[a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){0,8}\.[a-z]{2,63}"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
PHONE = (
    r"\+[0-9]{1,3}[^0-9A-Za-z\n]{0,8}[0-9]{3}[^0-9A-Za-z\n]{0,8}[0-9]{3}[^0-9A-Za-z\n]{0,8}[0-9]{4}(?![0-9])"
    r"|\+[0-9](?:[ ().-]{0,3}[0-9]){7,14}(?![0-9])"
    r"|(?<![0-9A-Za-z])\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[-. ][0-9]{4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z.-])[2-9][0-9]{2}([-.])[2-9][0-9]{2}\1[0-9]{4}(?![0-9A-Za-z]|[-.][0-9])"
)
CARD = r"(?<![0-9.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ISO_DATE = r"(?<![0-9-])(?:1[89]|2[01])[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_DATE = r"(?<![0-9/])[0-9]{2}/[0-9]{2}/(?:1[89]|2[01])[0-9]{2}(?![0-9/])"
KINDS = {"email": EMAIL, "ip": IPV4, "phone": PHONE, "card": CARD, "ssn": SSN, "date": ISO_DATE, "day": DAY_DATE}
#: One search finds every kind: the first alternative that matches at a place wins.
ANY = "|".join(f"(?:{p})" for p in (EMAIL, ISO_DATE, DAY_DATE, IPV4, PHONE, SSN, CARD))


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel(n: str, a: int, b: int, tag: str, key: str) -> str:
    """SQL: a keyed permutation of the integers 0 <= n < a * b; a and b at most 10**9 each."""
    part = lambda half, mod: (
        f"pmod(cast(conv(substring(sha2(concat({_text(key)}, ':{tag}:', cast(i as string), ':', cast({half} as string)), 256), 1, 15), 16, 10) as bigint), {mod}L)"
    )
    moved = f"""aggregate(sequence(1, {ROUNDS}), struct(n div {b}L as l, n % {b}L as r),
        (h, i) -> case when i % 2 = 1 then struct(pmod(h.l + {part("h.r", a)}, {a}L) as l, h.r as r)
                  else struct(h.l as l, pmod(h.r + {part("h.l", b)}, {b}L) as r) end,
        h -> h.l * {b}L + h.r)"""
    # a name, not brackets: the parser reads a bracket to its end before it knows what it is, and keeps all that it has seen there
    return bound(f"cast({n} as bigint)", "n", moved)


def luhn(digits: str) -> str:
    """SQL: the Luhn sum of a digit string, check digit included."""
    return f"""aggregate(sequence(1, length({digits})), 0, (t, i) -> t + case when i % 2 = 1 then cast(substring({digits}, -i, 1) as int)
        else cast(substring('0246813579', cast(substring({digits}, -i, 1) as int) + 1, 1) as int) end)"""


def refilled(value: str, digits: str) -> str:
    """SQL: the value with its digits replaced in order, everything else in place."""
    put = f"""aggregate(sequence(1, length({value})), struct('' as t, 1 as k), (z, j) -> case when substring({value}, j, 1) between '0' and '9'
        then struct(concat(z.t, substring(w, z.k, 1)) as t, z.k + 1 as k) else struct(concat(z.t, substring({value}, j, 1)) as t, z.k as k) end, z -> z.t)"""
    return bound(digits, "w", put)


def _permuted_digits(digits: str, n: int, tag: str, key: str) -> str:
    """SQL: n permuted digits."""
    return f"lpad(cast({feistel(f'cast({digits} as bigint)', 10 ** (n // 2), 10 ** (n - n // 2), tag, key)} as string), {n}, '0')"


def _permuted_ten(digits: str, key: str) -> str:
    """SQL: ten permuted digits of a telephone number.

    Numbers whose area and exchange both start with 2 to 9 move among these 800 * 800 * 10,000, all others among the other 3,600,000,000.
    """
    # the others: areas below 200 with any exchange, then areas from 200 with exchanges below 200
    other = f"case when area < 200 then cast({digits} as bigint) else 2000000000L + area * 2000000L - 400000000L + exchange * 10000L + line end"
    back = "case when v < 2000000000L then v else (200 + (v - 2000000000L) div 2000000L) * 10000000L + (v - 2000000000L) % 2000000L end"
    moved = bound(feistel("area * 8000000L + exchange * 10000L + line - 1602000000L", 80_000, 80_000, "phone10", key), "v", "concat(200 + v div 8000000L, 200 + v div 10000L % 800, lpad(v % 10000L, 4, '0'))")
    out = f"case when area >= 200 and exchange >= 200 then {moved} else lpad({bound(feistel(other, 60_000, 60_000, 'phone', key), 'v', back)}, 10, '0') end"
    for name, at, n in (("line", 7, 4), ("exchange", 4, 3), ("area", 1, 3)):
        out = bound(f"cast(substring({digits}, {at}, {n}) as bigint)", name, out)
    return out


def _permuted_ssn(digits: str, key: str) -> str:
    """SQL: nine permuted digits of a valid social security number: 998 areas (not 000 and 666), 99 groups and 9,999 serials (not zero)."""
    area = f"cast(substring({digits}, 1, 3) as bigint)"
    number = f"(({area} - if({area} > 666, 2, 1)) * 99 + cast(substring({digits}, 4, 2) as bigint) - 1) * 9999 + cast(right({digits}, 4) as bigint) - 1"
    return bound(feistel(number, 998 * 99, 9_999, "ssn", key), "v", "concat(lpad(v div 989901L + if(v div 989901L >= 665, 2, 1), 3, '0'), lpad(v div 9999L % 99 + 1, 2, '0'), lpad(v % 9999L + 1, 4, '0'))")


def pseudonym(kind: str, m: str, key: str) -> str:
    """SQL: the pseudonym of match ``m`` of a kind, or m itself where it is not valid."""
    digits = f"regexp_replace({m}, '[^0-9]', '')"
    if kind == "email":
        mac = lambda part, n: f"substring(sha2(concat({_text(key)}, ':email:', lower({part})), 256), 1, {n})"
        return f"concat('p', {mac(m, 16)}, '@', 'd', {mac(f'substring_index({m}, chr(64), -1)', 10)}, '.invalid')"
    if kind == "ip":
        octet = lambda i: f"cast(split({m}, '[.]')[{i}] as bigint)"
        number = " + ".join(f"{octet(i)} * {256 ** (3 - i)}L" for i in range(4))
        part = lambda shift: f"lpad(cast(shiftright(v, {shift}) & 255 as string), if(padded, 3, length(cast(shiftright(v, {shift}) & 255 as string))), '0')"
        # octets written with leading zeros stay three digits wide
        text = bound(f"{m} rlike '(?:^|[.])0[0-9]'", "padded", bound(feistel(number, 65536, 65536, "ip", key), "v", f"concat_ws('.', {', '.join(part(x) for x in (24, 16, 8, 0))})"))
        return f"case when forall(split({m}, '[.]'), o -> cast(o as int) <= 255) then {text} else {m} end"
    if kind == "phone":
        moved = lambda n, put: bound(digits, "d", refilled(m, f"concat(substring(d, 1, length(d) - {n}), {put})"))
        return f"case when length({digits}) >= 10 then {moved(10, _permuted_ten('right(d, 10)', key))} else {moved(7, _permuted_digits('right(d, 7)', 7, 'phone7', key))} end"
    if kind == "card":
        cases = []
        for n in range(13, 20):
            body = _permuted_digits(f"substring(d, 1, {n - 1})", n - 1, f"card{n}", key)
            check = bound(body, "b", f"concat(b, cast(pmod(10 - {luhn('concat(b, chr(48))')} % 10, 10) as string))")
            cases.append(f"when {n} then {refilled('x', check)}")
        put = bound("regexp_replace(x, '[^0-9]', '')", "d", f"case length(d) {' '.join(cases)} end")
        return bound(card_part(m), "c", f"case when c.n > 0 then concat(substring({m}, 1, c.at - 1), {bound(f'substring({m}, c.at, c.n)', 'x', put)}, substring({m}, c.at + c.n, 40)) else {m} end")
    if kind == "ssn":
        valid = f"substring({m}, 1, 3) not in ('000', '666') and substring({m}, 5, 2) <> '00' and right({m}, 4) <> '0000'"
        return f"case when {valid} then {bound(digits, 'd', refilled(m, _permuted_ssn('d', key)))} else {m} end"
    # dates of the 146097 = 189 * 773 days from 1800 to 2199, a whole Gregorian cycle
    moved = lambda iso, layout: f"date_format(date_add(date'1800-01-01', cast({feistel(f'datediff(try_cast({iso} as date), date\'1800-01-01\')', 189, 773, 'date', key)} as int)), '{layout}')"
    if kind == "date":
        return f"case when try_cast({m} as date) is not null then {moved(m, 'yyyy-MM-dd')} else {m} end"
    return f"case when try_cast({_iso(m)} as date) is not null then {moved(_iso(m), 'dd/MM/yyyy')} when try_cast({_iso(m, 1)} as date) is not null then {moved(_iso(m, 1), 'MM/dd/yyyy')} else {m} end"


def _iso(m: str, day: int = 0) -> str:
    """SQL: 31/12/2024 (day 0) or 12/31/2024 (day 1) as 2024-12-31."""
    first, second = f"substring({m}, 1, 2)", f"substring({m}, 4, 2)"
    return f"concat_ws('-', substring({m}, 7, 4), {first if day else second}, {second if day else first})"


def card_part(m: str) -> str:
    """SQL: struct(n, at): length and place of the longest, then leftmost part between group borders with a valid check digit; n is 0 without one."""
    inside = f"regexp_replace(substring({m}, i, j - i + 1), '[^0-9]', '')"
    starts = f"filter(sequence(1, length({m})), i -> i = 1 or substring({m}, i - 1, 1) in (' ', '-'))"
    ends = f"filter(sequence(i, length({m})), j -> j = length({m}) or substring({m}, j + 1, 1) in (' ', '-'))"
    parts = f"flatten(transform({starts}, i -> transform(filter({ends}, j -> {bound(inside, 'd', f'length(d) between 13 and 19 and {luhn("d")} % 10 = 0')}), j -> struct(j - i + 1 as n, -i as back))))"
    return f"{bound(f'array_max({parts})', 'p', 'struct(coalesce(p.n, 0) as n, coalesce(-p.back, 1) as at)')}"


def _which(m: str) -> str:
    """SQL: the kind of a match of ANY."""
    order = ("email", "date", "day", "ip", "ssn", "phone")
    whole = lambda k: f"{m} like '%@%'" if k == "email" else f"{m} rlike {quoted('^(?:' + KINDS[k] + ')$')}"
    return "case " + " ".join(f"when {whole(k)} then '{k}'" for k in order) + " else 'card' end"


def pseudonymise(df: DataFrame, key: str = "change-this-key", text: str = "text") -> DataFrame:
    """``df`` with its text rewritten, and n_<kind> counts of the values replaced."""
    out = "case k " + " ".join(f"when '{k}' then {pseudonym(k, 'm', key)}" for k in ("email", "date", "day", "ip", "phone", "ssn")) + f" else {pseudonym('card', 'm', key)} end"
    column = f"cast(`{text}` as string)"
    valid = f"""case k when 'email' then true when 'phone' then true
        when 'ip' then forall(split(m, '[.]'), o -> cast(o as int) <= 255)
        when 'card' then {card_part('m')}.n > 0
        when 'ssn' then substring(m, 1, 3) not in ('000', '666') and substring(m, 5, 2) <> '00' and right(m, 4) <> '0000'
        when 'date' then try_cast(m as date) is not null
        else try_cast({_iso('m')} as date) is not null or try_cast({_iso('m', 1)} as date) is not null end"""
    # every kind holds a digit or an at sign: texts without either need no pattern at all
    seen = f"transform(regexp_extract_all({column}, {quoted(ANY)}, 0), m -> {bound(_which('m'), 'k', f'struct(m as m, k as k, {valid} as ok, {out} as put)')})"
    found, kinds = (next(n for n in (f"_{x}{i or ''}" for i in range(len(df.columns) + 1)) if n not in df.columns) for x in ("found", "kinds"))
    rebuilt = f"""case when size(`{found}`) > 0 then array_join(zip_with(split({column}, {quoted(ANY)}, -1), concat(transform(`{found}`, f -> f.put), array('')),
        (part, put) -> concat(part, put)), '') else {column} end"""
    df = df.withColumn(found, F.when(F.expr(f"{column} rlike '[0-9@]'"), F.expr(seen)))
    df = df.withColumn(kinds, F.expr(f"transform(filter(`{found}`, f -> f.ok), f -> replace(f.k, 'day', 'date'))"))
    count = lambda k: F.expr(f"cast(greatest(coalesce(size(filter(`{kinds}`, k -> k = '{k}')), 0), 0) as bigint)")
    return df.withColumns({text: F.expr(rebuilt), **{f"n_{k}": count(k) for k in ("email", "ip", "phone", "card", "ssn", "date")}}).drop(found, kinds)
