"""Alignment of two tokenizers' tokens by whitespace anchors.

Each text is tokenised in full by a byte-level BPE (A, ``tokenizers``) and a piece model with byte fallback (B, ``sentencepiece``).  Both encode a
word, cut before a space, alone as in its text; if both spell its bytes, its two ends are anchors, where tokens of A and of B end and the next ones start with
a space.  That is verified for every word.  Words repeat, so groups and links of a word are worked out once a task, and documents are put together from
remembered words; a text with a word that A or B spells otherwise is compared as a whole.

Within a word, offsets where tokens of A and B both end cut the tokens into groups, and every run between neighbouring ends of either side is one link: two
byte ranges overlap in one run at most.  The counts of linked id pairs are summed over the corpus; a document then reads the counts of its own pairs.

Counts reach the documents in one of two ways with equal results: at most ``TOLD`` pairs of the corpus, which Spark counts first, are told to all
tasks; more are joined by pair, each document's pairs counted beforehand, so that a hot pair has one row a document.

Defined cases: a null or empty text, and one whose joined token bytes of A or B differ from a space and the text (the piece model's own space mark in a
text, for one) has no tokens: zeros and an empty groups text; repeated rows get equal results; long words are not remembered.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_bpe import ByteBPE, made, parts, valid
from .tables import Stages

#: Pairs of ids that a corpus may hold to be told to all tasks: 16 bytes each.
TOLD = 2_000_000
#: Words that a task remembers; code points and tokens of the longest among them.
MEMO, LONGEST, TOKENS = 400_000, 64, 48
SPACE = "▁"
#: Bits of an id in a pair (A id, B id), and links of words that a task remembers.
ID_BITS, LINKS = 20, 4_000_000
#: New words that are encoded in a row, and bytes of texts that are aligned at once.
ROW, BLOCK = 500, 1 << 20


class Pieces:
    """A sentencepiece model inside a task: text to ids and their bytes."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = m = SentencePieceProcessor(model_proto=data)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.space = array("I", [m.piece_to_id(SPACE)]).tobytes()
        probe = "ﬁ ①  é\t a"
        plain = m.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        #: No merge goes from a character on to a space after it, so words encode alone as in their text.
        self.by_word = plain and not any(SPACE in p.lstrip(SPACE) for p in names)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def words(text: str) -> list[str]:
    """A space and the text, cut before each space that follows a character other than white space, unless only white space is left."""
    first, *rest = _CUT(" " + text)
    out = [first, *[" " + x for x in rest]]
    if rest and (not rest[-1] or rest[-1].isspace()):
        last = out.pop()
        out[-1] += last
    return out


_CUT = re.compile(r"(?<=\S) ").split


def gather(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices start[i], start[i] + 1, ... of all runs, one after the other."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(count.sum())


class Both:
    """The two tokenizers of a task, with words that were met before.

    Word c has ``count[0][c]`` tokens of A and ``count[1][c]`` of B, the groups text ``texts[c]``, ``groups[c]`` groups and the links
    ``flat[first[c] : first[c + 1]]``.
    """

    def __init__(self, a_data: bytes, b_data: bytes, pattern: str):
        self.a, self.b = ByteBPE(a_data, pattern), Pieces(b_data)
        if max(len(self.a.bytes), len(self.b.bytes)) > 1 << ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.length = tuple(np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b))
        self.decimal = [str(i) for i in range(max(len(self.a.bytes), len(self.b.bytes)))]
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.texts: list[str] = []
        self.count = np.zeros((2, 0), np.int32)
        self.groups = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int64)

    def _fresh(self, new: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """For texts that start with a space: packed ids of A and B, and whether both spell it.

        Words that end in a character other than white space encode alike one by one and in a row, so rows of them are
        encoded at once and cut at their bytes; if a row does not spell its words, they are encoded one by one.
        """
        out: dict[str, tuple[bytes, bytes, bool]] = {}
        plain = [w for w in new if self.b.by_word and len(w) <= LONGEST and not w[-1].isspace() and SPACE not in w]
        for k in range(0, len(plain), ROW):
            row = plain[k : k + ROW]
            joined = "".join(row)
            cut = np.cumsum([len(w.encode()) for w in row])
            parts = []
            for side, packed in ((self.a, self.a.encode_once(joined)), (self.b, array("I", self.b.model.encode(joined[1:])).tobytes())):
                if side.decode(packed) != joined.encode():
                    break
                end = np.cumsum(self.length[side is self.b][np.frombuffer(packed, "<u4")])
                at = (4 * np.searchsorted(end, cut) + 4).tolist()
                parts.append([packed[s:e] for s, e in zip([0, *at], at, strict=False)])
            if len(parts) == 2:
                out.update(zip(row, zip(*parts, [True] * len(row), strict=True), strict=True))
        for w in new:
            if w not in out:
                # the model puts the space before a text itself, but not before an empty one
                x, y = b"".join(self.a.encode([w])), array("I", self.b.model.encode(w[1:])).tobytes() if len(w) > 1 else self.b.space
                out[w] = (x, y, self.a.decode(x) == self.b.decode(y) == w.encode())
        return [*map(out.__getitem__, new)]

    def align(self, texts: list[str]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For each text [n_a, n_b, n_groups, n_links] and its groups text; then the places where a text's pairs start, its distinct linked pairs and their links."""
        cut = [(words(t) if self.b.by_word else [" " + t]) if t else [] for t in texts]
        every = [*chain.from_iterable(cut)]
        found = [*map(self.words.get, every)]
        new = {w for w, c in zip(every, found, strict=True) if c is None}
        if len(self.words) + len(new) > MEMO or len(self.flat) > LINKS:
            self.forget()
            new, found = set(every), [None] * len(every)
        # those that the task is to remember come first; the others are forgotten after these texts
        fresh = [(len(w) > LONGEST or len(f[0]) > 4 * TOKENS, w, f) for w, f in zip(new, self._fresh([*new]), strict=True) if f[2]]
        fresh.sort(key=lambda x: x[0])
        known, kept = len(self.texts), sum(not x[0] for x in fresh)
        self._learn([f[0] for _, _, f in fresh], [f[1] for _, _, f in fresh])
        own = {w: known + i for i, (_, w, _) in enumerate(fresh)}
        codes = np.array([own.get(w, -1) if c is None else c for w, c in zip(every, found, strict=True)], dtype=np.int64)
        n_words = np.array([len(ws) for ws in cut], dtype=np.int64)
        if len(codes) and codes.min() < 0:
            codes, n_words = self._odd(texts, cut, codes, n_words)
        out = self._facts(codes, n_words)
        self.words.update((w, c) for w, c in own.items() if c < known + kept)
        if len(self.texts) > known + kept:
            del self.texts[known + kept :]
            self.count, self.groups, self.first = self.count[:, : known + kept], self.groups[: known + kept], self.first[: known + kept + 1]
            self.flat = self.flat[: self.first[-1]].copy()
        return out

    def _odd(self, texts: list[str], cut: list[list[str]], codes: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes without texts that hold a word of which A or B spells other bytes; one code for the whole text if both spell the text all the same."""
        parts = np.split(codes, np.cumsum(n_words)[:-1])
        for i, own in enumerate(parts):
            if len(own) and own.min() < 0:
                found = self._fresh(cut[i])
                a, b = (b"".join([f[k] for f in found]) for k in (0, 1))
                agree = self.a.decode(a) == self.b.decode(b) == (" " + texts[i]).encode()
                parts[i] = np.array([len(self.texts)] if agree else [], dtype=np.int64)
                if agree:
                    self._learn([a], [b])
        return np.concatenate(parts), np.array([*map(len, parts)], dtype=np.int64)

    def _facts(self, codes: np.ndarray, n_words: np.ndarray):
        """What ``align`` gives, for texts of ``n_words`` codes each."""
        edge = np.append(0, np.cumsum(n_words))
        links = self.first[codes + 1] - self.first[codes]
        facts = [np.diff(np.append(0, np.cumsum(x, dtype=np.int64))[edge]) for x in (self.count[0][codes], self.count[1][codes], self.groups[codes], links)]
        text_of = np.repeat(np.repeat(np.arange(len(n_words)), n_words), links)
        keys, counts = np.unique((text_of << (2 * ID_BITS)) | self.flat[gather(self.first[codes], links)], return_counts=True)
        listed, at = [*map(self.texts.__getitem__, codes.tolist())], edge.tolist()
        groups = [";".join(listed[s:e]) for s, e in zip(at, at[1:], strict=False)]
        start = np.searchsorted(keys >> (2 * ID_BITS), np.arange(len(n_words) + 1))
        return facts, groups, start, keys & ((1 << 2 * ID_BITS) - 1), counts

    def _learn(self, a_packed: list[bytes], b_packed: list[bytes]) -> None:
        """Tokens, groups and links of words, or texts, that both sides spell."""
        if not a_packed:
            return
        a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a_packed, b_packed))
        n_a, n_b = (np.array([len(x) // 4 for x in side], dtype=np.int32) for side in (a_packed, b_packed))
        # both sides spell the same bytes, so places of one word after the other stay comparable
        a_end, b_end = np.cumsum(self.length[0][a]), np.cumsum(self.length[1][b])
        run = np.union1d(a_end, b_end)
        pairs = (a[np.searchsorted(a_end, run)] << ID_BITS) | b[np.searchsorted(b_end, run)]
        bi = np.searchsorted(b_end, a_end)
        ai = np.flatnonzero(b_end[bi] == a_end)
        q, s = (ai + 1).tolist(), (bi[ai] + 1).tolist()
        a_text, b_text = ([*map(self.decimal.__getitem__, x.tolist())] for x in (a, b))
        groups = [",".join(a_text[w:x]) + "|" + ",".join(b_text[y:z]) for w, x, y, z in zip([0, *q], q, [0, *s], s, strict=False)]
        window_end = np.cumsum(n_a) - 1
        group_end = np.searchsorted(ai, window_end) + 1
        cut = group_end.tolist()
        self.texts += [";".join(groups[x:y]) for x, y in zip([0, *cut], cut, strict=False)]
        self.count = np.hstack([self.count, [n_a, n_b]])
        self.groups = np.append(self.groups, np.diff(group_end, prepend=0).astype(np.int32))
        self.first = np.append(self.first, self.first[-1] + np.searchsorted(run, a_end[window_end]) + 1)
        self.flat = np.append(self.flat, pairs)


FACTS = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, links array<long>"


def align(df: DataFrame, key: str, text: str, a_vocabulary: str, b_model: str, pattern: str) -> DataFrame:
    """Per row: the key, numbers of tokens, groups and links, the groups' text, and the distinct linked pairs with their links."""
    files = []
    for path in (a_vocabulary, b_model):
        with open(path, "rb") as f:
            files.append(df.sparkSession.sparkContext.broadcast(f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = made(Both, files[0].value, files[1].value, pattern)
        gc.disable()  # nothing here is part of a cycle, and walking what is remembered takes a tenth of the time
        for batch in (part for whole in batches for part in parts(whole, "text", BLOCK)):
            facts, groups, start, pairs, links = both.align(batch.column("text").to_pylist())
            lists = [pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(x, pa.int64())) for x in (pairs, links)]
            cols = [*[pa.array(x, pa.int64()) for x in facts], pa.array(groups, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *cols], names=[key, *(f.split()[0] for f in FACTS.split(", "))])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), valid(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, {FACTS}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair of the corpus, and whether no pair of its B id has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums a batch before its pairs are shuffled."""
        for batch in batches:
            pairs, links = (batch.column(c).flatten().to_numpy() for c in ("pairs", "links"))
            distinct, at = np.unique(pairs, return_inverse=True)
            n = np.bincount(at, weights=links, minlength=len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n)], names=["pair", "n"])

    counts = aligned.select("pairs", "links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.expr(f"pair & {(1 << ID_BITS) - 1}")))
    return counts.withColumn("best", F.col("n") == most)


def alignment_scores(
    df: DataFrame, stages: Stages, a_vocabulary: str, b_model: str, pattern: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; ``with_groups`` adds the groups' text."""
    facts = ["n_a", "n_b", "n_groups", "n_links"]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    whole = align(df, doc_id, text, a_vocabulary, b_model, pattern)
    kept = [digest, *(["groups"] if with_groups else [])]
    aligned = stages.save(whole.select(F.monotonically_increasing_id().alias("seq"), F.col(doc_id).alias("doc_id"), *facts, *kept, "pairs", "links"), "aligned")
    counts = stages.save(pair_counts(aligned), "counts")
    if counts.count() <= TOLD:
        scored = _told(aligned, counts)
    else:
        rows = aligned.select("seq", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("seq", F.col("x.pairs").alias("pair"), "x.links")
        sums = rows.join(counts, "pair").groupBy("seq").agg(
            F.sum(F.expr("if(best, links, 0)")).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum")
        )
        scored = aligned.join(sums, "seq", "left").fillna(0, ["n_best", "count_sum"])
    return scored.select("doc_id", *facts, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else []))


def _told(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows with n_best and count_sum, from a table of all counts in every task."""
    table = counts.orderBy("pair").toArrow()
    told = aligned.sparkSession.sparkContext.broadcast(tuple(table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best")))
    names = [c for c in aligned.columns if c not in ("pairs", "links")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = told.value
        for batch in batches:
            held = batch.column("pairs")
            row = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
            links = batch.column("links").flatten().to_numpy()
            at = np.searchsorted(pair, held.flatten().to_numpy())
            sums = []
            for x in (np.where(best[at], links, 0), links * n[at]):
                before = np.concatenate([[0], np.cumsum(x)])
                edge = np.searchsorted(row, np.arange(len(held) + 1))
                sums.append(pa.array(before[edge[1:]] - before[edge[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *sums], names=[*names, "n_best", "count_sum"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name in names)
    return aligned.mapInArrow(run, f"{schema}, n_best long, count_sum long")
