"""Column expressions that find matches of a pattern together with their places.  DataFrame functions only."""

from __future__ import annotations

#: Folds append to a list of at most so many items before it joins the result, so that appending stays cheap on long lists.
CHUNK = 128


def quoted(pattern: str) -> str:
    """A pattern as a raw SQL string literal."""
    return 'r"' + pattern.replace('"', r"\x22") + '"'


def bound(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def fold(items: str, start: str, empty: str, step: str) -> str:
    """SQL: the list that a scan over ``items`` collects.

    ``start`` is the first state; ``step`` sees ``a.state``, the list ``a.out`` and the item ``m``, and gives struct(state, out).  Lists grow
    in chunks, so the cost is that of the items plus a small share of their square over ``CHUNK``.
    """
    inner = f"aggregate(slice(z, c * {CHUNK} + 1, {CHUNK}), struct(b.state as state, {empty} as out), (a, m) -> {step})"
    return bound(
        items, "z", f"""aggregate(sequence(0, greatest((size(z) - 1) div {CHUNK}, 0)), struct({start} as state, {empty} as out),
        (b, c) -> {bound(inner, "r", "struct(r.state as state, concat(b.out, r.out) as out)")}, b -> b.out)""",
    )


def spans(text: str, pattern: str) -> str:
    """SQL for array<struct<s, e, x>>: code point start, exclusive end and text of every match.

    ``split`` and ``regexp_extract_all`` cut a text at the same leftmost, non-overlapping
    matches, so the lengths of the parts between add up to the places.  Texts without a match cost one search.
    """
    p = quoted(pattern)
    empty = "cast(array() as array<struct<s:int,e:int,x:string>>)"
    pairs = bound(f"regexp_extract_all({text}, {p}, 0)", "found", f"zip_with(slice(split({text}, {p}, -1), 1, size(found)), found, (gap, x) -> struct(length(gap) as gap, x as x))")
    step = "struct(a.state + m.gap + length(m.x) as state, array_append(a.out, struct(a.state + m.gap as s, a.state + m.gap + length(m.x) as e, m.x as x)) as out)"
    return f"case when {text} rlike {p} then {fold(pairs, '0', empty, step)} else {empty} end"
