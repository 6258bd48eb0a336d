"""Tokenising operators against the public libraries on whole texts, with nulls, empty, odd, very long and repeated rows."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tallybook.llm")
public = pytest.importorskip("public_tokenizers")
import tallybook.llm.byte_bpe as E  # noqa: E402
import tallybook.llm.token_align as T  # noqa: E402
from tallybook.llm.tables import Stages  # noqa: E402

MULTI, A, B = (public.path(x) for x in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  ", "\n", "a ", " a", "a  b", "a \n b", "x\n y", "x\n  y\t z", "x\x1c y", "don't  DON'T we'll", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ a▁b", "été ́ 漢字仮名 हिन्दी 🙂🙃 ﬁ ①",
    "꟎࢏ \U00016ea0x 12٣Ⅷ½", "a b c　d", "\u0000 a\u0000b ﻿", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
]


def texts(n=150, seed=3):
    rng = random.Random(seed)
    made = ["".join(rng.choice("aabbceinst    \n\t'.,12éß漢字🙂ब्") for _ in range(rng.randint(1, 120))) for _ in range(n)]
    words = [w for w in "the of and token window share anchor spaces merge bytes Größe naïve".split()]
    return ODD + made + made[:3] + [" ".join(rng.choice(words) for _ in range(60_000)), "z" * 20_000]


def frame(spark, values):
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(values)], "doc_id long, text string, key string, packed string, pairs string").repartition(3)


def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize(("size", "memo"), [(E.SLICE, E.MEMO), (50, 20)])
def test_ids_equal_the_rank_librarys(spark, monkeypatch, size, memo):
    monkeypatch.setattr(E, "SLICE", size)
    monkeypatch.setattr(E, "MEMO", memo)
    bpe = E.ByteBPE(open(MULTI, "rb").read(), public.PATTERN)
    known = reference()
    for t in texts():
        packed = next(bpe.encode([t or ""]))
        assert np.frombuffer(packed, "<u4").tolist() == known.encode_ordinary(t or "")
        assert bpe.decode(packed) == (t or "").encode()


def test_encoding_and_decoding_round_trip(spark):
    known, values = reference(), texts()
    got = {r.doc_id: tuple(r)[1:] for r in E.token_digests(frame(spark, values), MULTI, public.PATTERN).collect()}
    assert len(got) == len(values)
    for i, t in enumerate(values):
        ids = known.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_offsets_and_split_characters(spark):
    values = ["naïve 🙂 漢字 x", "", None]
    rows = E.decode(E.encode(frame(spark, values), "doc_id", "text", MULTI, public.PATTERN), "doc_id", MULTI, public.PATTERN, tokens=True)
    places = {r.doc_id: r for r in E.encode(frame(spark, values), "doc_id", "text", MULTI, public.PATTERN, offsets=True).collect()}
    for r in rows.collect():
        t, p = values[r.doc_id] or "", places[r.doc_id]
        assert "".join(r.token_texts) == t and len(r.token_texts) == r.n_tokens
        ids, known, at = np.frombuffer(bytes(p.packed), "<u4").tolist(), reference(), 0
        for i, s, e in zip(ids, p.char_start, p.char_end, strict=True):
            end = at + len(known.decode_single_token_bytes(i))
            assert (s, e) == (len(t.encode()[:at].decode(errors="ignore")), len((t.encode()[:end] + b"\x80" * 0).decode(errors="replace")))
            at = end
        assert at == len(t.encode())


def test_foreign_ids_and_invalid_text(spark):
    df = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\xff")), (2, bytearray(b"\x01")), (3, None), (4, bytearray(b""))], "doc_id long, packed binary")
    assert {r.doc_id: r.decoded for r in E.decode(df, "doc_id", MULTI, public.PATTERN).collect()} == {1: None, 2: None, 3: None, 4: b""}
    bad = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert bytes(E.decode(E.encode(bad, "doc_id", "text", MULTI, public.PATTERN), "doc_id", MULTI, public.PATTERN).first().decoded).decode() == "a�b"


def test_pattern_classes_of_every_character():
    """``regex`` and the library class all characters of Python's own Unicode version alike."""
    import unicodedata

    from tokenizers import Regex, pre_tokenizers

    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and unicodedata.category(chr(i)) != "Cn"]
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        cut = pre_tokenizers.Split(Regex(kind), "removed", invert=True)
        own = {c for k in range(0, len(every), 50_000) for s, _ in cut.pre_tokenize_str("".join(every[k : k + 50_000])) for c in s}
        assert own == set(E.regex.findall(kind, "".join(every)))


def brute(values):
    """The contract, read off whole encodings by comparing all byte ranges."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(A)
    a_model.encode_special_tokens = True
    b_model = SentencePieceProcessor(model_file=B)
    docs = []
    for t in values:
        a = a_model.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_model.encode(t) if t else []
        a_bytes = [bytes(E.BYTE_OF[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            docs.append(([], [], [], ""))
            continue
        spans = []
        for parts in (a_bytes, b_bytes):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links, j0 = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(b) and spans[1][j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = []
        for s, e in zip([0, *both], both):
            groups.append("|".join(",".join(str(x) for x, (p, q) in zip(ids, sp) if s <= p and q <= e) for ids, sp in ((a, spans[0]), (b, spans[1]))) if len(both) < 3000 else None)
        docs.append((a, b, links, ";".join(groups) if groups[:1] != [None] else len(both)))
    count = Counter(x for d in docs for x in d[2])
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = {}
    for i, (a, b, links, groups) in enumerate(docs):
        n = groups if isinstance(groups, int) else (groups.count(";") + 1 if groups else 0)
        sha = None if isinstance(groups, int) else hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out[i] = (len(a), len(b), n, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha)
    return out


@pytest.mark.parametrize(("told", "memo", "longest", "row"), [(T.TOLD, T.MEMO, T.TOKENS, T.ROW), (0, 5, 1, 7)])
def test_alignment_equals_brute_force(spark, monkeypatch, told, memo, longest, row):
    for name, value in (("TOLD", told), ("MEMO", memo), ("TOKENS", longest), ("ROW", row)):
        monkeypatch.setattr(T, name, value)
    values = texts(60)
    want = brute(values)
    got = T.alignment_scores(frame(spark, values), Stages(spark, "t"), A, B, public.PATTERN).collect()
    assert len(got) == len(values)
    for r in got:
        w = want[r.doc_id]
        assert tuple(r)[1:7] == w[:6], values[r.doc_id]
        if w[6] is not None:
            assert r.groups_sha256 == w[6], values[r.doc_id]
    assert sum(1 for t, w in zip(values, want.values()) if t and w[0] == 0) >= 1  # a text with the piece model's own space mark


def test_words_encode_as_in_their_text():
    both = T.Both(open(A, "rb").read(), open(B, "rb").read(), public.PATTERN)
    assert both.b.by_word
    for t in texts(400, seed=9):
        if t:
            assert "".join(T.words(t)) == " " + t
            a, b = next(both.a.encode([" " + t])), both.b.model.encode(t)
            found = both._fresh(T.words(t))
            assert b"".join(f[0] for f in found) == a and np.frombuffer(b"".join(f[1] for f in found), "<u4").tolist() == b


def test_token_operators_on_empty_tables(spark):
    df = frame(spark, ["a"]).where("false")
    assert E.token_digests(df, MULTI, public.PATTERN).count() == 0
    assert T.alignment_scores(df, Stages(spark, "t"), A, B, public.PATTERN).count() == 0


def test_a_task_remembers_short_words_and_nothing_else():
    both = T.Both(open(A, "rb").read(), open(B, "rb").read(), public.PATTERN)
    values = ["one two one", "z" * 200 + " two", "a ▁ two", ""]
    first = both.align(values)
    assert {*both.words} == {" one", " two", " a"} and len(both.texts) == len(both.groups) == len(both.first) - 1 == 3
    assert len(both.flat) == both.first[-1] and both.count.shape == (2, 3)
    again = both.align(values)
    assert all(np.array_equal(x, y) for x, y in zip([*first[0], *first[1:]], [*again[0], *again[1:]], strict=True))
