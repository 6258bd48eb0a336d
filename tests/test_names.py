"""Names cut at brackets and separators, against a plain count of depth."""

import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import names


def fold_segments(text):
    out, done, kind, depth, opened = [], 0, "", 0, 0
    for i, c in enumerate(text):
        if depth == 0 and c in "([":
            kind, depth, opened = c, 1, i
        elif depth and c == kind:
            depth += 1
        elif depth and c == {"(": ")", "[": "]"}[kind]:
            depth -= 1
            if depth == 0:
                if opened > done:
                    out.append((text[done:opened], None, False))
                out.append((text[opened : i + 1], text[opened + 1 : i], True))
                done = i + 1
    return out + ([(text[done:], None, False)] if done < len(text) else [])


def fold_tokens(text):
    out, depth, start, join = [], 0, 0, ""
    for i, c in enumerate(text):
        if c in "([":
            depth += 1
        elif c in ")]" and depth:
            depth -= 1
        elif c in ",/" and depth == 0 and not (c == "," and text[i - 1 : i].isdigit() and text[i + 1 : i + 2].isdigit()):
            out.append((text[start:i], join, text[start:i].strip()))
            start, join = i + 1, c
    return [*out, (text[start:], join, text[start:].strip())]


def nested(n, inside, a="(", b=")"):
    return a * n + inside + b * n


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    made = ["".join(rng.choice("ab1,/([)] 2") for _ in range(rng.randint(1, 24))) for _ in range(300)]
    deep = [f"DEEP {nested(n, 'A, B')} 40%, C" for n in (1, 5, 6, 7, 8, 20, 200)] + [nested(n, "깊은", "[", "]") + "끝" for n in (7, 8, 200)] + ["((((((((open 1,2, x", "a))))))))b, c", "(" * 9 + "[x]" + ")" * 8]
    return made + deep


def test_segments_and_tokens_of_any_depth(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    for r in df.select("id", names.segments(F.col("text")).alias("s"), names.tokens_of(F.col("text")).alias("t"), names._deep_segments(F.col("text")).alias("ds"), names._deep_tokens(F.col("text")).alias("dt")).collect():
        text = texts[r.id]
        assert [tuple(x) for x in r.s] == [tuple(x) for x in r.ds] == fold_segments(text), text
        assert [tuple(x) for x in r.t] == [tuple(x) for x in r.dt] == fold_tokens(text), text


def test_deep_names_keep_their_parts(spark):
    df = spark.createDataFrame([(f"DEEP {nested(8, 'A, B')} 40%",), (nested(8, "깊은"),), (f"DEEP {nested(200, 'A')}",)], "text string")
    got = [r.n for r in df.select(names.base_name(F.col("text"), F.lit(40.0), F.lit("")).alias("n")).collect()]
    assert got == [f"DEEP {nested(8, 'A, B')}", nested(8, "깊은"), f"DEEP {nested(200, 'A')}"]
