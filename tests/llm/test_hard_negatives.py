"""Hard-negative mining against all pairs in plain Python."""

import math
import random

import pytest

pytest.importorskip("tallybook.llm")
import tallybook.llm.hard_negatives as H  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tallybook.llm.tables import Stages  # noqa: E402


def brute(rows, positives=5, negatives=3):
    ok = []
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(x * 256.0) for x in v], lab))
    out = []
    for a, q, lab in (r for r in ok if r[0] % 50 == 0):
        hold = lambda s: min(max(s, -H.MOST), H.MOST)
        scored = [(-hold(sum(x * y for x, y in zip(q, w))), i, other) for i, w, other in ok if i != a and len(w) == len(q)]
        scored.sort(key=lambda s: s[:2])
        for s, p, _ in [s for s in scored if s[2] == lab][:positives]:
            fit = [(n, i) for n, i, other in scored if other != lab and 50 * -s <= 100 * -n <= 95 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(fit)]
    return sorted(out)


def run(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v], lab) for i, v, lab in rows]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "vec_id long, embedding array<double>, label int, id int, seq string").repartition(3)
    return sorted(tuple(r) for r in H.hard_negatives(df, Stages(spark, "t"), F.expr("vec_id % 50 = 0")).collect())


@pytest.mark.parametrize(("anchors", "block", "scores"), [(8192, 8192, 1 << 20), (2, 40, 64)])
def test_equal_to_all_pairs(spark, monkeypatch, anchors, block, scores):
    for name, value in (("ANCHORS", anchors), ("ROWS", block), ("SCORES", scores)):
        monkeypatch.setattr(H, name, value)
    rng = random.Random(5)
    centres = [[rng.gauss(0, 0.1) + 0.15 for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.12) for c in centres[i % 4]], i % 4) for i in range(400)]
    for i in range(60):  # ties: one vector under many ids, anchors among them
        rows[3 * i] = (3 * i, [0.25] * 6, rng.randrange(3))
        rows[200 + i] = (200 + i, [0.125] * 6, rng.randrange(3))
    rows += [(50, rows[50][1], 1), (51, rows[51][1], 1), (51, rows[51][1], 1)]  # repeated ids and rows
    rows += [(1000, None, 1), (1001, [math.nan] * 6, 1), (1050, [None] * 6, 1), (1051, [math.inf] * 6, 1), (1052, rows[7][1], None), (None, rows[8][1], 1)]
    rows += [(1100, [0.1] * 3, 1), (1101, [0.2] * 3, 1), (1102, [0.19] * 3, 2), (1103, [0.15] * 3, 2), (1150, [], 0), (1151, [], 0), (1152, [], 1)]
    # negative positives have an empty window; large components leave the matrix path
    rows += [(1200, [-1.0, 0, 0, 0], 7), (1201, [1.0, 0, 0, 0], 7), (1202, [0.5, 0, 0, 0], 8)]
    big = [[2.0**18, 1, 0, 0, 0], [2.0**18, 3, 0, 0, 0], [2.0**17 * 1.5, 0, 0, 0, 0], [2.0**17 * 1.25, 7, 0, 0, 1]]
    rows += [(1250 + i, v, [9, 9, 8, 7][i]) for i, v in enumerate(big)]
    rows += [(1300 + i, [x * s for x in v] + [0.0], [9, 9, 8, 7][i]) for s in (2.0**4,) for i, v in enumerate(big)]
    rows += [(1350 + i, [x * 2.0**5 for x in v] + [0.0, 0.0], [9, 9, 8, 7][i]) for i, v in enumerate(big)]
    rows += [(1400 + i, [x * 2.0**30 for x in v] + [0.0] * 3, [9, 9, 8, 7][i]) for i, v in enumerate(big)]  # scores beyond 64 bits
    want = brute(rows)
    assert len(want) > 60 and {1250, 1300, 1350} <= {w[0] for w in want}
    assert run(spark, rows) == want


def test_best_keeps_the_leftmost_of_ties():
    import numpy as np

    rng = np.random.default_rng(2)
    for few in (1, 3, 5):
        s = rng.integers(0, 4, size=(50, 12))
        s[rng.random(s.shape) < 0.3] = H.NONE
        r, c = H.best(s.copy(), few)
        want = [(i, j) for i in range(50) for j in sorted(sorted((j for j in range(12) if s[i, j] != H.NONE), key=lambda j: (-s[i, j], j))[:few])]
        assert list(zip(r.tolist(), c.tolist())) == want


def test_empty_table_and_no_anchor(spark):
    assert run(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert H.hard_negatives(df, Stages(spark, "t"), F.expr("vec_id % 50 = 0")).count() == 0
