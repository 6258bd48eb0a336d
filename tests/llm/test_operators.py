"""Each operator against a brute-force version on a small fixture, with nulls, empty and repeated rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("tallybook.llm")
import corpus_pipeline  # noqa: E402
import tallybook.llm.minhash_dedup as M  # noqa: E402
from tallybook.llm.decontaminate import overlaps  # noqa: E402
from tallybook.llm.embedding_dedup import embedding_links, survivors  # noqa: E402
from tallybook.llm.html_main import blocks_of, main_text  # noqa: E402
from tallybook.llm.minhash_dedup import near_duplicates  # noqa: E402
from tallybook.llm.mixing import capped_targets, mix  # noqa: E402
import tallybook.llm.secret_scan as S  # noqa: E402
from tallybook.llm.pii import pseudonymise  # noqa: E402
from tallybook.llm.quality import quality_scores  # noqa: E402
from tallybook.llm.secret_scan import secret_digest  # noqa: E402
from tallybook.llm.suffix_dedup import remove_repeats  # noqa: E402
from tallybook.llm.tables import Stages  # noqa: E402
from tallybook.llm.toxicity import toxicity_scores  # noqa: E402

WORDS = [a + b for a in "bcdfglmnprst" for b in ("an", "er", "ion", "ou", "al", "ist", "ent", "or")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def frame(spark, rows, schema="doc_id long, text string"):
    # an extra column whose name clashes with one the operators use inside
    return spark.createDataFrame([(*r, "x") for r in rows], schema + ", key string")


def groups(n, links):
    parent = list(range(n))
    for a, b in links:
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)
    return [next(r for r in iter(lambda s=[i]: s.__setitem__(0, parent[s[0]]) or s[0], None) if parent[r] == r) for i in range(n)]


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(8, 16))
    v = np.concatenate([base, base + rng.normal(size=base.shape) * 0.2, base[:3], base[:3] * 2]).astype(np.float32)
    label = [i % 2 for i in range(8)] * 2 + [0, 1, 0] * 2
    rows = [(i, [float(x) for x in r], lab) for i, (r, lab) in enumerate(zip(v, label))]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0), (n + 3, rows[0][1], None), (n + 4, [], 0), (n + 5, [1.0], 0)]
    got = {r.vec_id: tuple(r)[1:] for r in embedding_links(frame(spark, rows, "vec_id long, embedding array<float>, label int"), Stages(spark, "t"), tile=4).collect()}
    w = v.astype(float)
    cos = (w @ w.T) / np.sqrt((w * w).sum(1)[:, None] * (w * w).sum(1)[None])
    link = [(i, j) for i in range(n) for j in range(n) if i < j and label[i] == label[j] and cos[i, j] >= 0.93]
    root = groups(n, link)
    for i in range(n):
        assert got[i] == (sum(i in p for p in link), root[i], root[i] == i)
    assert all(got[i] == (0, i, True) for i in range(n, n + 6))


def test_embeddings_of_any_magnitude(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=12)
    rows = [(i, [float(x) for x in (base + rng.normal(size=12) * 0.05) * m], 1) for i, m in enumerate((1e-200, 1e200, 1.0, 1e-150, 1e-305, 1e307 / np.abs(base).max()))]
    got = {r.vec_id: r.n_links for r in embedding_links(frame(spark, rows, "vec_id long, embedding array<double>, label int"), Stages(spark, "t")).collect()}
    assert got == {i: 5 for i in range(6)}


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(60, 24)) * np.linspace(2, 0.1, 24)
    a /= np.linalg.norm(a, axis=1)[:, None]
    i, j = survivors(a, a, 0.6, step=4)
    assert set(zip(i.tolist(), j.tolist())) >= set(zip(*(x.tolist() for x in np.nonzero(a @ a.T >= 0.6))))


def test_suffix_removal(spark):
    rng = random.Random(3)
    shared = prose(rng, 30)
    rows = [(i, prose(rng, 40)) for i in range(6)]
    rows += [(10, "é" + shared + prose(rng, 5)), (11, prose(rng, 9) + shared), (12, shared[:49]), (13, shared[:50]), (20, rows[0][1]), (20, rows[0][1]), (21, None), (22, ""), (None, rows[0][1])]
    rows += [(23, "a" * 200), (24, "a" * 120)]
    got = sorted(map(tuple, remove_repeats(frame(spark, rows), Stages(spark, "t")).collect()), key=str)
    least = {}
    for i, t in rows:
        for p in range(len((t or "").encode()) - 49):
            k = t.encode()[p : p + 50]
            if i is not None:
                least[k] = min(least.get(k, i), i)
    want = []
    for i, t in rows:
        b = (t or "").encode()
        cov = [False] * len(b)
        for p in range(len(b) - 49):
            if i is not None and least[b[p : p + 50]] < i:
                cov[p : p + 50] = [True] * 50
        rest = bytes(x for x, c in zip(b, cov) if not c)
        want.append((i, len(b), sum(cov), sum(c and not (j and cov[j - 1]) for j, c in enumerate(cov)), hashlib.sha256(rest).hexdigest()))
    assert got == sorted(want, key=str)


def test_anchors_of_several_texts_at_once_equal_those_of_each():
    from tallybook.llm.suffix_dedup import Anchors

    rng = random.Random(12)
    texts = [bytes(rng.choice(b"ab c") for _ in range(n)) for n in (50, 51, 300, 75, 50, 1000)]
    texts += [texts[2], b"a" * 200, texts[5][100:400]]
    border = np.cumsum([0, *map(len, texts)])
    whole = Anchors(np.frombuffer(b"".join(texts), np.uint8), border, 50, 25)
    got = [(i, at - border[i], whole.names[at], f - border[i], x - border[i]) for i, at, f, x in zip(whole.text, whole.at, whole.first, whole.last)]
    want = []
    for i, t in enumerate(texts):
        one = Anchors(np.frombuffer(t, np.uint8), np.array([0, len(t)]), 50, 25)
        want += [(i, at, one.names[at], f, x) for at, f, x in zip(one.at, one.first, one.last)]
        owners = [min(range(p, p + 26), key=lambda q: (one.names[q], q)) for p in range(len(t) - 49)]
        assert owners == [at for at, f, x in zip(one.at, one.first, one.last) for _ in range(f, x + 1)]
    assert got == want


def test_suffix_removal_of_texts_with_one_checksum(spark):
    """Two texts of one id whose CRC-32 are equal are still two texts."""
    assert zlib.crc32(b"plumless") == zlib.crc32(b"buckeroo")
    shared = prose(random.Random(8), 40)[:76]
    rows = [(1, "plumless" + shared), (5, "plumless" + shared), (5, "buckeroo" + shared)]
    got = sorted((r.doc_id, r.n_removed, r.kept_sha256) for r in remove_repeats(frame(spark, rows), Stages(spark, "t")).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(1, 0, sha("plumless" + shared)), (5, 84, sha("")), (5, 76, sha("buckeroo"))])


class Counted(Stages):
    """Stages that count the rows of each table."""

    def __init__(self, spark):
        super().__init__(spark, "t")
        self.rows = {}

    def save(self, df, name):
        out = super().save(df, name)
        self.rows[name] = out.count()
        return out


def test_suffix_removal_writes_no_row_for_each_window_of_strings_that_differ(spark):
    """Phrases shorter than the threshold are in many documents; no window around them repeats, so none is written."""
    rng = random.Random(21)
    phrases = [prose(rng, 30)[:30] for _ in range(5)]
    rows = [(i, "".join(prose(rng, 20) + p for p in rng.sample(phrases, 3)) + prose(rng, 20)) for i in range(40)]
    stages = Counted(spark)
    assert not any(r.n_removed for r in remove_repeats(frame(spark, rows), stages, length=50).collect())
    assert sum(n for name, n in stages.rows.items() if name.startswith("single")) <= len(rows)


@pytest.mark.parametrize("length, per_batch, waiting, least_size, sampled", [(50, 10_000, 1000, 1, 1 << 40), (50, 2, 1000, 1 << 26, 1), (31, 3, 0, 1, 1)])
def test_suffix_removal_of_parts_in_several_turns_and_with_common_names(spark, monkeypatch, length, per_batch, waiting, least_size, sampled):
    for name, value in (("WAITING", waiting), ("LEAST_SIZE", least_size), ("SAMPLED", sampled), ("SPAN_ROOM", 150), ("OPEN_ROOM", 150)):
        monkeypatch.setattr(f"tallybook.llm.suffix_dedup.{name}", value)
    rng = random.Random(22)
    passages = [prose(rng, 30)[: rng.randrange(25, 140)] for _ in range(12)]
    rows = []
    for i in range(30):
        parts = [rng.choice(passages) for _ in range(3)]
        cut = [p[rng.randrange(0, 12) : len(p) - rng.randrange(0, 12)] for p in parts]
        rows.append((rng.randrange(20), "".join(prose(rng, 4) + p for p in cut) + prose(rng, 3)))
    rows += [(2**40, rows[3][1] + "é"), (-5, passages[0] * 2), (4, "ab" * 90), (3, "ab" * 60), rows[7], (None, rows[5][1])]
    least = {}
    for i, t in rows:
        b = t.encode()
        for p in range(len(b) - length + 1):
            if i is not None:
                least[b[p : p + length]] = min(least.get(b[p : p + length], i), i)
    want = []
    for i, t in rows:
        b = t.encode()
        cov = [False] * len(b)
        for p in range(len(b) - length + 1):
            if i is not None and least[b[p : p + length]] < i:
                cov[p : p + length] = [True] * length
        rest = bytes(x for x, c in zip(b, cov) if not c)
        want.append((i, len(b), sum(cov), sum(c and not (j and cov[j - 1]) for j, c in enumerate(cov)), hashlib.sha256(rest).hexdigest()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    stages = Counted(spark)
    try:
        got = sorted(map(tuple, remove_repeats(frame(spark, rows), stages, length=length).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted(want, key=str)
    assert ("ranged-1" in stages.rows) == ("single-1" in stages.rows) == (least_size == 1) and ("common-0" in stages.rows) == (sampled == 1)


@pytest.mark.parametrize("per_batch, waiting", [(1, 1000), (3, 0), (10_000, 1000)])
def test_suffix_removal_of_a_block_repeated_inside_one_document(spark, monkeypatch, per_batch, waiting):
    monkeypatch.setattr("tallybook.llm.suffix_dedup.WAITING", waiting)
    rng = random.Random(8)
    block, other = prose(rng, 50), prose(rng, 50)
    rows = [(5, prose(rng, 9) + block + prose(rng, 9) + block + prose(rng, 9)), (3, prose(rng, 9) + block[90:210] + prose(rng, 9))]
    # two texts of one id, and a repeated row, against a part in a smaller document
    rows += [(8, other + prose(rng, 3)), (8, other + prose(rng, 4)), (8, other + prose(rng, 4) + other), (7, prose(rng, 5) + other[60:200]), (5, rows[0][1])]
    least = {}
    for i, t in rows:
        for p in range(len(t) - 49):
            least[t[p : p + 50]] = min(least.get(t[p : p + 50], i), i)
    want = []
    for i, t in rows:
        cov = [False] * len(t)
        for p in range(len(t) - 49):
            if least[t[p : p + 50]] < i:
                cov[p : p + 50] = [True] * 50
        rest = "".join(x for x, c in zip(t, cov) if not c)
        want.append((i, len(t), sum(cov), sum(c and not (j and cov[j - 1]) for j, c in enumerate(cov)), hashlib.sha256(rest.encode()).hexdigest()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        got = sorted(map(tuple, remove_repeats(frame(spark, rows), Stages(spark, "t")).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted(want)


def brute_classes(rows, threshold=0.8):
    """Class by row number, from weighted Jaccard similarity of all pairs under the operator's own weights."""
    texts = M.lowered([t for _, t in rows])
    h, t, _ = M._shingles(texts)
    table = np.zeros(2 << M.DF_BITS, np.int64)
    for slot in M._slots(h, M.DF_BITS):
        table += np.bincount(slot, minlength=len(table))
    idf = M.idf_table(table, len(texts))
    bags = []
    for x in texts:
        h, _, tf = M._shingles([x])
        bags.append(dict(zip(h.tolist(), (M.weights(h, idf).astype(float) * tf).tolist())))
    links = []
    for i, a in enumerate(bags):
        for j in range(i):
            least = sum(min(w, bags[j].get(k, 0)) for k, w in a.items())
            if a and least >= threshold * (sum(a.values()) + sum(bags[j].values()) - least) - 1e-9:
                links.append((j, i))
    return groups(len(rows), links)


def test_only_common_slots_are_told(spark):
    rng = random.Random(9)
    rows = [(i, "five words that all share " + prose(rng, 20 + i % 30)) for i in range(4000)]
    texts = M.lowered([t for _, t in rows])
    h, t, _ = M._shingles(texts)
    table = np.zeros(2 << M.DF_BITS, np.int64)
    for slot in M._slots(h, M.DF_BITS):
        table += np.bincount(slot, minlength=len(table))
    slots, weight = M.common_slots(frame(spark, rows).repartition(3))
    assert 2 <= len(slots) < 1000 and len(slots) == len(set(slots.tolist())) == np.count_nonzero(table > 4)
    assert np.array_equal(M.told_weights(slots, weight), M.idf_table(table, len(rows)))
    assert not len(M.common_slots(frame(spark, []))[0])


def check_classes(spark, rows):
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows), Stages(spark, "t")).collect()), key=str)
    root = brute_classes(rows)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    assert [x[:2] for x in got] == sorted(((i, least.get(r)) for (i, _), r in zip(rows, root)), key=str)
    assert sum(x[2] for x in got) >= len(set(root))
    return got


def test_near_duplicates(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 120)) for i in range(10)]
    for i in range(5):
        w = rows[i][1].split()
        w[60] = "changed"
        rows.append((20 + i, " ".join(w)))
    rows += [(30, rows[9][1]), (31, rows[9][1].upper()), (32, None), (33, ""), (34, "two words"), (35, "Two words!"), (None, "zz yy xx ww vv")]
    got = {r.doc_id: tuple(r)[1:3] for r in near_duplicates(frame(spark, rows), Stages(spark, "t")).collect()}
    for i in range(5):
        assert got[i] == (i, True) and got[20 + i] == (i, False)
    assert got[9] == (9, True) and got[30] == (9, False) and got[31] == (9, False)
    assert got[32] == (32, True) and got[33] == (33, True) and got[35] == (34, False)
    assert got[5] == (5, True) and got[None] == (None, True)


def test_near_duplicates_of_repeated_and_missing_ids(spark):
    rng = random.Random(5)
    a, b = prose(rng, 80), prose(rng, 80)
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (None, a), (None, "only without id " + b[:200]), (7, b), (7, b)]
    got = check_classes(spark, rows)
    # no link is lost to the shared id; of each class one text of one id stays
    assert [(i, c, k) for i, c, k in got if i in (2, 3, 7)] == [(2, 1, False), (3, 1, False), (7, 1, False), (7, 1, False)]
    assert (None, 1, False) in got and (None, None, True) in got


def test_large_groups_equal_brute_force(spark, monkeypatch):
    """Groups of several tiles, whose members reach each other only through others, and a text longer than a tile."""
    for name, value in (("TILE", 6), ("TILE_BYTES", 3000), ("HEADS", 2)):
        monkeypatch.setattr(M, name, value)
    monkeypatch.setattr("tallybook.llm.components.HOT_ROWS", 3)
    rng = random.Random(6)
    base = prose(rng, 90).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 30):  # copies of one text
        w = list(base)
        w[rng.randrange(90)] = f"new{i}"
        rows.append((i, " ".join(w)))
    chain = prose(rng, 90).split()
    for i in range(40, 60):  # each text near the one before, far from the first
        chain[(i * 7) % 90] = f"step{i}"
        rows.append((i, " ".join(chain)))
    long = prose(rng, 3000)
    rows += [(70, long), (71, long + " more"), (72, prose(rng, 50)), (73, rows[0][1])]
    check_classes(spark, rows)


def test_html(spark):
    page = "<html><head><title>t</title></head><body><nav>menu</nav><div class='cookie-notice'>ok?</div><article><h1>A &amp; B</h1><p>one\n two<p>three<aside>x</aside><script>var a='</p>'</script></article><div id=comments>no</div><footer>f</footer>"
    assert [t for _, t, d, i in blocks_of(page) if i and not d] == ["A & B", "one two", "three"]
    rows = [(1, "http://h/1", page), (2, None, None), (3, "http://h/2", "")] + [(10 + i, f"http://s/{i}", f"<div>same line</div><div>own {i}</div>") for i in range(4)] + [(10, "http://s/0", "<div>same line</div><div>own 0</div>")]
    got = {(r.page_id, r.text, r.n_chars) for r in main_text(frame(spark, rows, "page_id long, url string, html string"), Stages(spark, "t")).collect()}
    assert got == {(1, "A & B\none two\nthree", 19), (2, "", 0), (3, "", 0)} | {(10 + i, f"own {i}", 5) for i in range(4)}


def test_html_classes(spark):
    from tallybook.llm.html_main import evidence

    assert evidence([1, 9, 2, 1, 2], [[1, 2]])[0][1] is not None and evidence([1, 2, 2, 1], [[1, 2]])[0][1] is None
    assert [x[2] for x in evidence([1, 4, 5, 2, 3], [[1, 2, 3], [4, 5]])] == [False, False]
    assert [x[2] for x in evidence([1, 4, 2, 5, 3], [[1, 2, 3], [4, 5]])] == [False, True]
    # fixed text inside the article, also in an own element on most pages; a wandering pair and a lone repeated paragraph are text
    rows = []
    for i in range(8):
        pair = [f"<p>left</p><p>own {i}</p>", "<p>right</p>"]
        some = "<div class=xq>Get our paper</div>" if i < 6 else ""
        lone = "<p>as they say</p>" if i > 1 else ""
        rows.append((i, f"http://n/{i}", f"<article><div>Written by staff</div><p>text {i}</p>{some}{lone}<p>more {i}</p></article>"))
        rows.append((20 + i, f"http://w/{i}", "".join(pair[:: 1 if i % 2 else -1])))
    rows += [(50 + i, "http://c/x", "<article><p>one copied page</p></article>") for i in range(4)]
    got = {r.page_id: r.text.split("\n") for r in main_text(frame(spark, rows, "page_id long, url string, html string"), Stages(spark, "t")).collect()}
    for i in range(8):
        assert got[i] == [f"text {i}", *["as they say"] * (i > 1), f"more {i}"]
        assert sorted(got[20 + i]) == ["left", f"own {i}", "right"]
    assert all(got[50 + i] == ["one copied page"] for i in range(4))


def test_html_parts_that_hold_the_page(spark):
    same = "<div><p>one</p><p>two words</p></div>"
    pages = {
        1: "<html class='no-cookies'><body class='home has-sidebar'><form id=f><nav>m</nav><div class='social-history'><p>all of history</p></div></form></body></html>",
        2: "<article><header><h1>Title</h1></header><p>a <span class='share'>word</span> <em class='search term'>two</em> <math>x+1</math></p></article><div id=comments><article class=comment>no</article></div>",
        3: same, 4: same, 5: same, 6: "<p>" + "long " * 50_000 + "</p>", 7: "<p>tail <b>open", 8: "&lt;p&gt; &eacute;&#x41;",
    }
    rows = [(i, f"http://h{min(i, 3) if i < 6 else i}/{i}", t) for i, t in pages.items()]
    got = {r.page_id: r.text for r in main_text(frame(spark, rows, "page_id long, url string, html string"), Stages(spark, "t")).collect()}
    assert got[1] == "all of history" and got[2] == "Title\na word two x+1"
    assert got[3] == got[4] == got[5] == "one\ntwo words"
    assert got[6] == ("long " * 50_000).strip() and got[7] == "tail open" and got[8] == "<p> éA"


def test_html_article_under_several_addresses(spark):
    rng = random.Random(8)
    story = [prose(rng, 20) for _ in range(3)]
    body = "".join(f"<p>{x}</p>" for x in story)
    frame_ = "<p>Written by the staff of this site, which gives its words to all who ask</p><p>Sent to readers each day at noon, by post and by wire, free of any charge</p>"
    rows = [(i, f"http://one/{i}", f"<article>{body}<p>Updated at minute {i}</p></article>") for i in range(4)]
    # three addresses of one story among five pages, all in the site's frame
    rows += [(10 + i, f"http://two/{i}", f"<article>{frame_}{body if i < 3 else '<p>' + prose(rng, 90) + '</p>'}<p>seen {i}</p></article>") for i in range(5)]
    # stories that differ lose a frame that is longer than some of them
    rows += [(20 + i, f"http://three/{i}", f"<article>{frame_}<p>{prose(rng, 5 + 30 * (i % 4))} own {i}</p></article>") for i in range(8)]
    rows += [(40, "http://q/0", '<p class="foo>Hello world</p><div id="b">more <b class=x>text</b></div>'), (41, "http://r/0", "<div title='it>one</div>"), (42, "http://u/0", "<p>a < b</p>")]
    got = {r.page_id: r.text.split("\n") for r in main_text(frame(spark, rows, "page_id long, url string, html string"), Stages(spark, "t")).collect()}
    for i in range(4):
        assert got[i] == [*story, f"Updated at minute {i}"]
    for i in range(5):
        assert got[10 + i][:-1] == story if i < 3 else len(got[10 + i]) == 2
    for i in range(8):
        assert len(got[20 + i]) == 1 and got[20 + i][0].endswith(f"own {i}")
    assert got[40] == ["Hello world", "more text"] and got[41] == ["one"] and got[42] == ["a < b"]


def test_mixing(spark):
    assert capped_targets([10, 100, 0], [5, 2, 1], 110) == [30.0, 80.0, 0.0]
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 60)), f"s{i % 3}") for i in range(600)] + [(900, None, None), (901, "a b", None), (901, "a b", None), (902, "", "s0"), (903, "w " * 5000, "s1")]
    df = frame(spark, rows, "doc_id long, text string, source string")
    out = mix(df, Stages(spark, "t")).collect()
    assert len(out) == len(rows) and all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in out)
    for s in {r.source for r in out}:
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
        # rates meet the target before rounding, and tilt exponentially with a document's size
        assert abs(sum(r.rate * r.size for r in mine) - mine[0].target) <= 1e-6 * max(mine[0].target, 1)
        tilt = {round(np.log(r.rate) / r.size, 9) for r in mine if r.size and 0 < r.rate < 3 and abs(r.rate - 1) > 1e-9 and r.rate > 1e-12}
        assert len(tilt) <= 1 or max(tilt) - min(tilt) < 1e-6
    assert len({r.rate for r in out if r.source == "s0"}) > 20
    assert sorted(map(str, out)) == sorted(map(str, mix(df, Stages(spark, "u")).collect()))


def marked_documents():
    """Documents of four kinds with labels: clean, toxic, junk, and copies."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(240):
        kind = i % 4
        text = prose(rng, rng.randint(30, 80))
        if kind == 1:
            text += " you are a worthless idiot and pathetic scum, you " + rng.choice(("zorgbart", "quimbleton", "frazzwort")) + " moron"
        if kind == 2:
            text = " ".join(rng.choice(("$$$", "|||", "CLICK!!!", "BUY", "@@##")) for _ in range(60))
        rows.append((i, text + ".", "en", f"s{i % 3}", len(text) + 1))
        labels.append((i, 0 if kind == 2 else 1, 1 if kind == 1 else 0))
    rows += [(300, None, None, None, None), (301, "", "en", None, 0), (None, "no id " + rows[0][1], "en", "s0", 9), (302, rows[0][1], "en", "s1", 5), (302, rows[0][1], "en", "s1", 5)]
    return rows, labels


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("scores, label, modulus, held", [(quality_scores, 1, 5, 0), (toxicity_scores, 2, 3, 1)])
def test_classifiers_on_held_out_documents(spark, scores, label, modulus, held):
    rows, labels = marked_documents()
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], DOCS + ", score double, y string")
    out = scores(docs, spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, y2 string"), Stages(spark, "t")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    want = {x[0]: x[label] for x in labels}
    mine = [r for r in out if r.held_out and r.doc_id in want]
    assert len(mine) > 20 and all(zlib.crc32(str(r.doc_id).encode()) % modulus == held for r in mine)
    assert sum(r.predicted == want[r.doc_id] for r in mine) >= 0.97 * len(mine)
    # without labels, and without documents
    assert len(scores(docs.limit(5), spark.createDataFrame([], "doc_id long, quality int, toxic int"), Stages(spark, "t")).collect()) == 5
    assert scores(spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int"), Stages(spark, "t")).isEmpty()


def test_pipeline_stage_by_stage(spark, tmp_path):
    rng = random.Random(13)
    rows, labels = marked_documents()
    item = prose(rng, 25)
    rows += [(400, prose(rng, 40) + " " + item, "en", "s2", 1), (401, prose(rng, 40) + " write to bob@mail.example.com", "en", "s2", 1)]
    data = {
        "documents": spark.createDataFrame(rows, DOCS), "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, item), (2, None)], "item_id long, text string"),
    }
    for name, df in data.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        seen[name] = docs.collect()
        assert name == "mixing" or docs.columns == DOCS.replace("long", "").replace("string", "").replace(",", " ").split()
    ids = {k: {r.doc_id for r in v} for k, v in seen.items()}
    toxic = {i for i, _, t in labels if t}
    assert not ids["toxicity"] & {i for i in toxic if i % 4 == 1} and ids["toxicity"] >= {r[0] for r in rows} - toxic
    assert 302 not in ids["minhash_near_dedup"] and 0 in ids["minhash_near_dedup"]
    kept = seen["minhash_near_dedup"]
    assert len({r.text for r in kept if r.text}) == sum(bool(r.text) for r in kept)
    assert 400 not in ids["decontamination"] and ids["decontamination"] >= ids["minhash_near_dedup"] - {400}
    assert len(seen["pii"]) == len(seen["decontamination"]) and not any("bob@" in (r.text or "") for r in seen["pii"])
    for r in seen["mixing"]:
        assert r.taken == r.copies * r.size > 0 or r.size == 0
    whole = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert whole == sorted(map(str, seen["mixing"]))
    # nothing in, nothing out
    for name in data:
        data[name].limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").isEmpty()


def test_personal_data(spark):
    text = "mail Bob.X@Mail.example.com at 10.2.3.4 or 999.1.1.1, card 4111 1111 1111 1111 not 4111 1111 1111 1112, +1 (017) 555-7713, 123-45-6789, 2024-02-29, 2024-02-30!"
    rows = [(1, text), (2, text.replace("mail ", "post ")), (3, None), (4, ""), (5, "clean text 12")]
    got = {r.doc_id: r for r in pseudonymise(frame(spark, rows)).collect()}
    out = got[1].text
    assert out.split()[1:] == got[2].text.split()[1:] and got[3].text is None and got[4].text == "" and got[5].text == "clean text 12"
    for secret in ("Bob.X", " 10.2.3.4 ", "4111 1111 1111 1111", "(017) 555-7713", "123-45-6789", "2024-02-29"):
        assert secret not in out
    for same in ("999.1.1.1", "4111 1111 1111 1112", "2024-02-30!"):
        assert same in out
    digits = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) not", out).group(1).replace(" ", "")
    assert sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0
    assert (got[1].n_email, got[1].n_ip, got[1].n_phone, got[1].n_card, got[1].n_ssn, got[1].n_date) == (1, 1, 1, 1, 1, 1)


def test_personal_data_in_other_spellings(spark):
    text = "call (212) 555-0100 or 212-555-0100 or +1 212 555 0100, +44 20 7946 0958; 4111 1111 1111 1111 123, 12 4111-1111-1111-1111; 12/31/2024 13/13/2024; 010.002.003.004; 112-555-0100"
    run = "a" * 200_000 + "@mail.example.com " + "4111 " * 20_000
    rows = [(1, text, "a", "b"), (2, run, "a", "b"), (3, text, "a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _found string, _kinds string")
    got = {r.doc_id: r for r in pseudonymise(df).collect()}
    out = got[1].text
    assert got[1][2:4] == ("a", "b") and got[3].text == out
    for gone in ("555-0100 or", "+1 212 555 0100", "7946 0958", "4111 1111 1111 1111", "4111-1111", "12/31/2024", "010.002.003.004"):
        assert gone not in out
    assert "13/13/2024" in out and "112-555-0100" in out and re.search(r" 123, 12 \d{4}-\d{4}-\d{4}-\d{4};", out)
    one, two, three = re.search(r"call \((\d{3})\) (\d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}) or \+1 (\d{3} \d{3} \d{4}),", out).group(1, 3, 4)
    assert two.replace("-", "") == three.replace(" ", "") and two.startswith(one)
    assert re.search(r"; (\d{3}\.){3}\d{3};", out)
    assert (got[1].n_phone, got[1].n_card, got[1].n_date, got[1].n_ip) == (4, 2, 1, 1) and got[2].n_email == 1


def feistel_in_python(n, a, b, tag, key="change-this-key"):
    left, right = divmod(n, b)
    for i in range(1, 9):
        half, size = (right, a) if i % 2 else (left, b)
        add = int(hashlib.sha256(f"{key}:{tag}:{i}:{half}".encode()).hexdigest()[:15], 16) % size
        left, right = ((left + add) % a, right) if i % 2 else (left, (right + add) % b)
    return left * b + right


def test_pseudonyms_are_valid_numbers_and_equal_brute_force(spark):
    rng = random.Random(5)
    phones = {f"{rng.randint(2, 9)}{rng.randint(0, 99):02d}-{rng.randint(2, 9)}{rng.randint(0, 99):02d}-{rng.randint(0, 9999):04d}" for _ in range(3000)} | {"200-200-0000", "999-999-9999"}
    ssns = {f"{rng.choice([1, 2, 665, 667, 999, rng.randint(1, 665)]):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}" for _ in range(3000)} | {"001-01-0001", "999-99-9999", "665-99-9999", "667-01-0001"}
    abroad = {f"+33 {rng.choice([0, 1, 19, 199, 200, 999, rng.randint(0, 999)]):03d} {rng.choice([0, 1, 199, rng.randint(0, 199)]):03d} {rng.randint(0, 9999):04d}" for _ in range(1000)}

    def phone(x):
        head, d = re.sub(r"\D", "", x)[:-10], re.sub(r"\D", "", x)[-10:]
        area, exchange, line = int(d[:3]), int(d[3:6]), int(d[6:])
        if area >= 200 and exchange >= 200:
            v = feistel_in_python(((area - 200) * 800 + exchange - 200) * 10000 + line, 80000, 80000, "phone10")
            return f"{head}{200 + v // 8000000}{200 + v // 10000 % 800}{v % 10000:04d}"
        v = feistel_in_python(int(d) if area < 200 else 2 * 10**9 + ((area - 200) * 200 + exchange) * 10000 + line, 60000, 60000, "phone")
        return head + (f"{v:010d}" if v < 2 * 10**9 else f"{200 + (v - 2 * 10**9) // 2000000:03d}{(v - 2 * 10**9) % 2000000:07d}")

    def ssn(x):
        area, group, serial = (int(p) for p in x.split("-"))
        v = feistel_in_python(((area - (2 if area > 666 else 1)) * 99 + group - 1) * 9999 + serial - 1, 998 * 99, 9999, "ssn")
        area = v // 989901
        return f"{area + (2 if area >= 665 else 1):03d}-{v // 9999 % 99 + 1:02d}-{v % 9999 + 1:04d}"

    values = sorted(phones | ssns | abroad)
    got = dict(zip(values, (r.text for r in pseudonymise(frame(spark, list(enumerate(values)))).orderBy("doc_id").collect())))
    for x in phones | abroad:
        assert re.sub(r"\d", "0", got[x]) == re.sub(r"\d", "0", x) and re.sub(r"\D", "", got[x]) == phone(x), x
    for x in ssns:
        assert got[x] == ssn(x), x
    for kind, pattern in ((phones, r"[2-9]\d\d-[2-9]\d\d-\d{4}"), (ssns, r"(?!000|666)\d{3}-(?!00)\d\d-(?!0000)\d{4}"), (abroad, r"\+33 (?![2-9]\d\d [2-9])[\d ]+")):
        out = {got[x] for x in kind}
        assert len(out) == len(kind) and all(re.fullmatch(pattern, x) for x in out)


def test_permutation_has_no_collisions(spark):
    from tallybook.llm.pii import feistel

    out = spark.range(146097).selectExpr(f"{feistel('id', 189, 773, 'date', 'k')} as x")
    assert out.distinct().count() == 146097 and out.where("x < 0 or x >= 146097").isEmpty()


def test_the_driver_keeps_little(spark, monkeypatch):
    """Long brackets and cases around long texts grow the parser's memory; tables go when no later step reads them."""
    import tallybook.llm.pii as P

    read, expr = [], P.F.expr
    monkeypatch.setattr(P.F, "expr", lambda s: (read.append(s), expr(s))[1])
    pseudonymise(frame(spark, []))
    monkeypatch.undo()
    assert all(not s.startswith("case") for s in read if len(s) > 2000)
    for number in ("n", "m"):
        assert f"({number} + 1)" not in P.feistel(f"({number} + 1)", 7, 9, "t", "k").replace(f"cast(({number} + 1) as bigint)", "")
    rows, labels = marked_documents()
    stages = Stages(spark, "t")
    toxicity_scores(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), stages)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{stages.root}/{name}")
    held = {name: path(name).getFileSystem(conf).exists(path(name)) for name in ("terms", "patterns", "ballots")}
    assert held == {"terms": False, "patterns": False, "ballots": True}


def test_decontamination(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, n)) for i, n in enumerate((15, 40, 30))] + [(9, None), (8, "")]
    swapped = items[1][1].split()
    swapped[7] = swapped[22] = "other"
    rows = [(1, prose(rng, 20) + " " + items[0][1]), (2, prose(rng, 50) + " " + " ".join(swapped).upper() + "!"), (3, prose(rng, 80)), (4, None), (5, ""), (None, items[2][1]), (6, items[2][1]), (6, items[2][1])]
    got = {tuple(r) for r in overlaps(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), Stages(spark, "t")).collect()}
    assert got == {(1, 0, 20, 15, 15), (2, 1, 50, 40, 38), (6, 2, 0, 30, 30)}


def test_decontamination_equals_brute_force(spark):
    from tallybook.llm.decontaminate import AGREE, WINDOW

    rng = random.Random(12)
    items = [(i, prose(rng, n)) for i, n in enumerate((8, 10, 13, 16, 25, 40))] + [(None, prose(rng, 20))]

    def spoiled(words, swaps):
        words = list(words)
        for k in rng.sample(range(len(words)), min(swaps, len(words))):
            words[k] = "other"
        return words

    docs = []
    for i in range(60):
        item = items[i % 6][1].split()
        cut = item[: rng.randint(max(1, len(item) // 2), len(item))]
        docs.append((i, prose(rng, rng.randint(0, 40)) + " " + " ".join(spoiled(cut, rng.randint(0, 4))) + " " + prose(rng, rng.randint(0, 40))))
    # two equally good places far apart in a very long text, one id with two texts, repeated rows, an item without an id
    docs += [(100, " ".join((prose(rng, 15_000), items[3][1], prose(rng, 5_000), items[3][1], prose(rng, 5_000)))), (101, items[4][1]), (101, "x " + items[4][1]), (102, items[2][1]), (102, items[2][1]), (103, items[6][1])]
    want = {}
    for doc, text in docs:
        words = text.lower().split()
        for name, item in items[:6]:
            item = item.split()
            run = min(WINDOW, len(item))
            for offset in range(-len(item) + 1, len(words)):
                eq = [a == b for a, b in zip(item[max(0, -offset) :], words[max(0, offset) :])]
                if sum(eq) >= AGREE * run and any(sum(eq[k : k + run]) >= AGREE * run for k in range(len(eq) - run + 1)):
                    found = (sum(eq), -max(offset, 0), len(eq))
                    want[doc, name] = max(found, want.get((doc, name), found))
    got = {tuple(r) for r in overlaps(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), Stages(spark, "t")).collect()}
    assert got == {(doc, name, -back, n, equal) for (doc, name), (equal, back, n) in want.items()} and len(got) > 30
    assert any(r[:3] == (100, 3, 15_000) for r in got) and (101, 4, 0, 25, 25) in got


def test_masks_hold_a_seed_for_every_accepted_placement():
    from itertools import combinations

    from tallybook.llm.decontaminate import AGREE, MASKS, SHORT, WINDOW

    for n in range(1, WINDOW + 1):
        for k in range(n + 1):
            if n - k < AGREE * n:
                break
            for gone in combinations(range(n), k):
                assert any(
                    not any(c == "1" and at + j in gone for j, c in enumerate(m))
                    for m in (*MASKS, *SHORT.get(n, ())) for at in range(n - len(m) + 1)
                ), (n, gone)


def test_decontamination_of_short_items(spark):
    rng = random.Random(9)
    items = [(n, " ".join(f"{w}{n}" for w in prose(rng, n).split())) for n in range(1, 13)]
    rows, want = [], set()
    for n, t in items:
        k = next(k for k in range(n, -1, -1) if n - k >= 0.8 * n)
        w = t.split()
        for j in range(k):
            w[(j + 1) * n // (k + 1)] = "other"
        rows.append((n, prose(rng, 20) + " " + " ".join(w) + " " + prose(rng, 5)))
        want.add((n, n, 20, n, n - k))
        w[0] = w[-1] = "another"
        rows.append((100 + n, " ".join(w)))
    got = {tuple(r) for r in overlaps(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), Stages(spark, "t")).collect()}
    assert got == want


def test_secrets(spark):
    texts = ["Ünï Token: 'abcdefgh12' x", "token = short", "AKIA" + "Z9" * 7, "q " + "0f" * 16, None, "", "v Zx8Kq2Lw9Tb4Rm7Yc1Vn5", "example_Zx8Kq2Lw9Tb4Rm7Yc1Vn5", "aaaaaaaaaaaaaaaaaaaaaaaaa1"]
    got = {r.doc_id: r for r in secret_digest(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i].spans for i in range(9)] == ["assign:4:22", "", "access:0:18", "hex:2:34", "", "", f"entropy:2:{len(texts[6])}", "", ""]
    assert got[4].base_sha256 == hashlib.sha256(b"").hexdigest()


def entropy_spans(text):
    """The method by its definition: every window of every candidate outside the base spans."""
    base = [(m.start(), m.end()) for m in re.finditer(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I) if len(m.group(1)) >= 8]
    base += [m.span() for p in (r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}") for m in re.finditer(p, text)]
    out = []
    for m in re.finditer(S.CANDIDATE, text):
        x = m.group()
        level = S.LEVELS["hex" if re.fullmatch("[0-9a-fA-F]+", x) else "lower" if re.fullmatch("[0-9a-z]+", x) else "mixed"]
        if any(a <= m.start() and m.end() <= b for a, b in base) or re.search(S.ALLOWED, x):
            continue
        for i in range(len(x) - S.WINDOW + 1):
            counts = np.unique(list(x[i : i + S.WINDOW]), return_counts=True)[1] / S.WINDOW
            if -(counts * np.log2(counts)).sum() >= level - 1e-9:
                out.append(m.span())
                break
    return out


def test_entropy_windows_equal_brute_force(spark):
    rng = random.Random(14)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
    texts = []
    for _ in range(60):
        n = rng.choice((3, 6, 12, 20, 67))
        words = ["".join(rng.choice(chars[: n] + "07") for _ in range(rng.randint(15, 70))) for _ in range(4)]
        texts.append(" ".join(words) + rng.choice(("", " token=" + words[0], " é " + words[1])))
    texts.append("k7Qz" * 10_000 + " " + "".join(rng.choice(chars) for _ in range(50_000)) + " token=abcdefgh12" * 2_000)
    got = {r.doc_id: r.spans for r in secret_digest(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts[:-1]):
        mine = [tuple(map(int, x.split(":")[1:])) for x in got[i].split(",") if x.startswith("entropy")]
        assert mine == entropy_spans(t), (i, t)
    assert got[60].count("assign") == 2_000 and got[60].count("entropy") == 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert remove_repeats(docs, Stages(spark, "t")).isEmpty() and mix(docs, Stages(spark, "t")).isEmpty()
    assert secret_digest(docs).isEmpty() and pseudonymise(docs).isEmpty() and near_duplicates(docs, Stages(spark, "t")).isEmpty()
    assert embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), Stages(spark, "t")).isEmpty()
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string"), Stages(spark, "t")).isEmpty()
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert overlaps(docs, items, Stages(spark, "t")).isEmpty()
    assert overlaps(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), items.limit(0), Stages(spark, "t")).isEmpty()
