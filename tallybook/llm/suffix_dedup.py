"""Repeated-substring removal by distributed prefix doubling.

Ranks here are names: equal strings get equal 64-bit hashes.  Round one names the
``half``-byte strings (half the threshold) at anchor positions; Spark sorts the
(name, document) pairs by name and positions whose name is unique are done.  Round two doubles the length: a full-length
string is an anchor's name with the bytes beside it, and a position is covered when its string also occurs in a document
with a smaller id.  An anchor's windows travel as one row, their bytes once, and become single positions only in the task
that has all rows of the name.  Strings are compared by 128 bits, those of common names by 96.

Whole copies come first: of documents with one SHA-256 all but the least are covered from end to end, and only one text of each
takes part in the rest.  Names that stand in many of a sample of the documents are known to repeat, so they are told to every task
instead of being sorted, and later rows of theirs are dealt out by what surrounds them: no task gets all rows of a passage that half the corpus
quotes.  The sample decides only this routing, never a result.

Anchors keep the sorted rows few without losing a match.  The anchor of a full-length
window is its ``half``-byte string of least hash (leftmost on ties), which depends on the
window's bytes alone, so equal windows have equal anchors at equal offsets: if the
anchor's name is unique, so is the window.  A surviving anchor first tries the
name of everything its windows span; if a smaller document has all of that, all its windows
are covered at once.  Of the others only those go on that share half of the bytes beside the anchor, left or right, with another
document, as one of two equal windows' sides is at least that long.

Defined cases: a null text is empty bytes; texts shorter than the threshold keep everything; a text of any length is one array in a task;
a null id is never smaller than another id, so it covers nothing and loses nothing; rows
that share an id never cover each other (texts of one id are told apart by 60 bits of their SHA-256);
a repeated row gets the same result again; an empty table gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import join_hot
from .kernels import BASE_INVERSE, mix, powers, prefix_sums, span_hashes
from .tables import Stages


#: Odd multiplier that orders the two names of a pair.
PAIR = 0xD6E8FEB86659FD93
#: One document in SAMPLED is sampled for names that many share: more than one in COMMON, and four at least.
SAMPLED, COMMON = 64, 500
#: Whole copies, 16 bytes each, whose list a join with the documents broadcasts at most.
BROADCAST_COPIES = 1_000_000
#: Bytes of texts whose hashes are worked out at once.
BLOCK = 1 << 16
#: Open rows of one anchor name that a task holds back at most.
WAITING = 1_000_000
#: Bytes of text for each surviving anchor, and for each open one, that is dealt out in one turn; more anchors take more turns, by name.
SPAN_ROOM, OPEN_ROOM = 40, 100
#: Bytes of text that inputs count as at least, so that small ones take one turn.
LEAST_SIZE = 1 << 26


def rolling(sums: np.ndarray, size: int) -> np.ndarray:
    """Hash of data[p:p + size] for every p, from the prefix sums of data."""
    return mix((sums[size:] - sums[:-size]) * powers(BASE_INVERSE, len(sums))[: len(sums) - size])


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if len(known) == 0:
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in every window of ``width`` values, by doubling."""
    idx = np.arange(len(values), dtype=np.int32)
    best, span = values, 1
    while span < width:
        step = min(span, width - span)
        left, right = best[:-step], best[step:]
        take = right < left
        best = np.where(take, right, left)
        idx = np.where(take, idx[step:], idx[:-step])
        span += step
    return idx


class Anchors:
    """Anchor positions of texts that lie one after the other, with the first and last window that each one serves.

    ``border`` has the start of each text and the end of the last; no window crosses a border, and no text is shorter than one.
    """

    def __init__(self, data: np.ndarray, border: np.ndarray, length: int, half: int):
        self.sums = prefix_sums(data)
        self.names = rolling(self.sums, half)
        owner = window_argmin(self.names, length - half + 1)
        inside = np.ones(len(owner), bool)
        inside[(border[1:-1, None] - np.arange(1, length)).ravel()] = False
        window = np.flatnonzero(inside)
        owner = owner[window]
        cut = np.flatnonzero(np.diff(owner)) + 1
        self.first = window[np.concatenate([[0], cut])]
        self.last = window[np.concatenate([cut - 1, [len(owner) - 1]])]
        self.at = owner[np.concatenate([[0], cut])]
        self.text = np.searchsorted(border, self.at, side="right") - 1


def _texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, np.ndarray]]:
    """(row, bytes) of a string column, over Arrow's own buffer."""
    col = batch.column(name)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    for i in range(len(col)):
        yield i, raw[offs[i] : offs[i + 1]]


def _blocks(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, borders) of runs of texts of at most ``BLOCK`` bytes together; a longer text stands alone."""
    col = batch.column(name)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_string(col.type) else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BLOCK, side="right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def _frame(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    out = [pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)).cast(types[k]) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(out, names=list(columns))


def turns_for(rows: int, room: int, size: int) -> int:
    return max(1, -(-rows * room // max(size, LEAST_SIZE)))


def repeated_spans(docs: DataFrame, stages: Stages, size: int, length: int = 50) -> DataFrame:
    """(doc, v, start, end): byte runs of ``docs`` (doc, v, text) that a smaller doc also has.

    ``doc`` is not null; ``v`` tells texts of one doc apart.  Runs may overlap.  ``size`` is the number of bytes of the input's texts:
    where much repeats, anchors are dealt out in several turns, each for a part of the names, so that what lies on disk at a time stays in proportion to it.
    """
    half, whole = length // 2, length
    long, int_ = pa.int64(), pa.int32()
    docs = docs.where(F.octet_length("text") >= length)
    known_hot = None

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"h": long, "doc": long}
        for batch in batches:
            ids = batch.column("doc").to_numpy()
            h, d, held = [], [], 0
            for lo, _, data, border in _blocks(batch):
                a = Anchors(data, border, whole, half)
                found, text = a.names[a.at], a.text
                order = np.argsort(found, kind="stable")  # texts are in order, so a name that a text repeats follows itself
                found, text = found[order], text[order]
                keep = np.concatenate([[True], (found[1:] != found[:-1]) | (text[1:] != text[:-1])])
                if known_hot is not None:
                    keep &= ~among(found, known_hot.value)
                h.append(found[keep].view(np.int64))
                d.append(ids[lo + text[keep]])
                held += len(h[-1])
                if held > 200_000:
                    yield _frame({"h": h, "doc": d}, types)
                    h, d, held = [], [], 0
            yield _frame({"h": h, "doc": d}, types)

    def not_unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by h alone (one long, so by radix) whose h equals a neighbour's; the last row waits for the next batch."""
        types = {"h": long, "doc": long}
        h0 = d0 = None
        tail = False
        for batch in batches:
            h, d = batch.column("h").to_numpy(), batch.column("doc").to_numpy()
            if len(h) == 0:
                continue
            if h0 is not None:
                h, d = np.concatenate([[h0], h]), np.concatenate([[d0], d])
            same = h[1:] == h[:-1]
            keep = np.zeros(len(h), bool)
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= tail
            h0, d0, tail = h[-1], d[-1], bool(keep[-1])
            keep[-1] = False
            yield _frame({"h": [h[keep]], "doc": [d[keep]]}, types)
        if tail:
            yield _frame({"h": [np.array([h0])], "doc": [np.array([d0])]}, types)

    some = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLED)) == 0).select("doc", "text")
    counted = some.mapInArrow(names, "h long, doc long").groupBy("h").agg(F.count("*").alias("n"))
    # at most COMMON names a document's mean number of names
    hot = counted.where(F.col("n") >= max(4, some.count() // COMMON)).select("h").toArrow()["h"].to_numpy()
    known_hot = docs.sparkSession.sparkContext.broadcast(np.sort(hot.astype(np.int64).view(np.uint64)))
    in_order = docs.select("doc", "text").mapInArrow(names, "h long, doc long").repartition("h").sortWithinPartitions("h")
    shared = stages.save(
        in_order.mapInArrow(not_unique, "h long, doc long").groupBy("doc").agg(F.collect_list("h").alias("hs")), "shared"
    )
    del in_order
    stages.release()

    # a place is first (32 bits), last - first, anchor - first (``step`` bits each) and marks of the bytes left and right of the anchor
    rest = whole - half
    near, step = (rest + 1) // 2, rest.bit_length()
    if step > 15:
        raise ValueError(f"a length of {length} is too long")
    marks = 16 - step

    def mark(sums: np.ndarray, start: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Short hash of the ``near`` bytes from start on; 0 where they are not there."""
        start = np.where(there, start, 0)
        return np.where(there, span_hashes(sums, start, np.minimum(start + near, len(sums) - 1)) % np.uint64((1 << marks) - 1) + np.uint64(1), np.uint64(0))

    def placed(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """first, last - first and anchor - first of places."""
        one = (1 << step) - 1
        return place >> 32, place >> (32 - step) & one, place >> (32 - 2 * step) & one

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Surviving anchors, each with the name of all the bytes that its windows span."""
        types = {"h": long, "k": long, "salt": long, "doc": long, "v": long, "place": long}
        for batch in batches:
            ids, vs, hs = batch.column("doc").to_numpy(), batch.column("v").to_numpy(), batch.column("hs")
            out: dict[str, list] = {k: [] for k in types}
            for lo, hi, data, border in _blocks(batch):
                a = Anchors(data, border, whole, half)
                # a name that repeats does so for all texts that hold it, so the lists of a block's texts are as good as each text's own
                own = np.sort(hs.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
                name = a.names[a.at]
                often = among(name, known_hot.value)
                hit = (often | among(name, own)) & (name % np.uint64(turns) == turn)
                first, last, at, text, sums = a.first[hit], a.last[hit], a.at[hit], a.text[hit], a.sums
                key = (sums[last + whole] - sums[first]) * powers(BASE_INVERSE, len(sums))[first]
                key = mix(mix(key) + ((at - first) * whole + (last - first)).astype(np.uint64) * np.uint64(PAIR))
                left, right = mark(sums, at - near, at - first >= near), mark(sums, at + half, last + rest - at >= near)
                place = (first - border[text]) << 32 | (last - first) << (32 - step) | (at - first) << (32 - 2 * step)
                out["h"].append(name[hit].view(np.int64))
                out["k"].append(key.view(np.int64))
                out["salt"].append(np.where(often[hit], key.view(np.int64) | 1, 0))
                out["doc"].append(ids[lo + text])
                out["v"].append(vs[lo + text])
                out["place"].append(place | (left << np.uint64(marks) | right).astype(np.int64))
            yield _frame(out, types)

    def met(h: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which open rows, sorted by h, can share a window with another doc's.

        Two equal windows hold the anchor and ``rest`` bytes more, so that ``near`` bytes at its left or at its right are equal too.
        """
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]])) << marks
        keep = np.zeros(len(h), bool)
        for shift in (marks, 0):
            own = place >> shift & ((1 << marks) - 1)
            key = group | own
            order = np.lexsort((doc, key))
            cut = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0, [True]]))
            least, most = doc[order][cut[:-1]], doc[order][cut[1:] - 1]
            keep[order] |= np.repeat(least < most, np.diff(cut)) & (own[order] != 0)
        return keep

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by (h, k, doc): those covered whole by a smaller doc (state 0), and those still open (1; 2 where the name is common).

        Rows of the first doc of each k are open, also further occurrences in that doc and other texts of its
        id; rows of larger docs are covered.  The open rows of an h wait until all are there; those that share no bytes
        beside the anchor with another doc's go.  Beyond ``WAITING`` of them, or where an h
        is dealt out by k, they are opened without waiting, which costs time but changes no result.
        """
        names = ("h", "doc", "v", "place")
        h0 = k0 = d0 = None
        full = False  # whether the open rows of the current h wait no more
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            if batch.num_rows == 0:
                continue
            h, k, d, salt = (batch.column(c).to_numpy() for c in ("h", "k", "doc", "salt"))
            cols = [batch.column(c).to_numpy() for c in names]
            n = len(h)
            new_h = np.concatenate([[h0 is None or h[0] != h0], h[1:] != h[:-1]])
            new_k = new_h | np.concatenate([[k0 is None or k[0] != k0], k[1:] != k[:-1]])
            start = np.maximum.accumulate(np.where(new_k, np.arange(n), -1))
            first_doc = np.where(start >= 0, d[np.maximum(start, 0)], d0 if d0 is not None else 0)
            covered, hot = first_doc < d, salt != 0
            at_once = np.full(n, full) & (np.cumsum(new_h) == 0)
            out = [[c[x] for c in cols] for x in (covered, ~covered & at_once, ~covered & hot & ~at_once)]
            late = ~covered & ~hot & ~at_once
            rows = [np.concatenate([x, c[late]]) for x, c in zip(held, cols, strict=True)]
            now = rows[0] != h[-1]
            keep = met(*(rows[i][now] for i in (0, 1, 3))) if now.any() else np.zeros(0, bool)
            out.append([x[now][keep] for x in rows])
            held = [x[~now] for x in rows]
            full = bool(at_once[-1])
            if len(held[0]) > WAITING:
                out.append(held)
                held, full = [x[:0] for x in held], True
            h0, k0, d0 = h[-1], k[-1], first_doc[-1]
            states = np.repeat(np.array([0, 1, 2, 1, 1][: len(out)], np.int32), [len(x[0]) for x in out])
            yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(x)) for x in list(zip(*out))[1:]), pa.array(states)], names=["doc", "v", "place", "state"])
        if len(held[0]):
            keep = met(held[0], held[1], held[3])
            yield pa.RecordBatch.from_arrays([*(pa.array(x[keep]) for x in held[1:]), pa.array(np.ones(keep.sum(), np.int32))], names=["doc", "v", "place", "state"])

    turns = turns_for(shared.agg(F.sum(F.size("hs"))).first()[0] or 0, SPAN_ROOM, size)
    parts = []
    for turn in range(turns):
        sorted_spans = (
            docs.join(shared, "doc", "left").mapInArrow(spans, "h long, k long, salt long, doc long, v long, place long")
            .repartition("h", "salt").sortWithinPartitions("h", "k", "doc")
        )
        parts.append(stages.save(sorted_spans.mapInArrow(settle, "doc long, v long, place long, state int"), f"ranged-{turn}"))
        del sorted_spans
        stages.release()
    ranged = reduce(DataFrame.unionByName, parts)
    stages.drop("shared")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """An open anchor with the bytes of its windows beside its own; of a common one, a row for each window, named by the pair of names at its offsets 0 and half."""
        types = {"h": long, "c": int_, "doc": long, "v": long, "place": long}
        for batch in batches:
            ids, vs = batch.column("doc").to_numpy(), batch.column("v").to_numpy()
            out: dict[str, list] = {k: [] for k in types}
            texts, sizes = [], []
            for at, end, data, border in _blocks(batch):
                sums = prefix_sums(data)
                lists = batch.column("open").slice(at, end - at)
                flat = lists.flatten()
                of = np.repeat(np.arange(end - at), lists.value_lengths().to_numpy())
                place, hot = flat.field("place").to_numpy(), flat.field("state").to_numpy() == 2
                first, n, off = placed(place)
                first = first + border[of]
                name = span_hashes(sums, first + off, first + off + half)
                mine = name % np.uint64(turns) == turn

                here = mine & ~hot
                text, first, n, off = of[here], first[here], n[here], off[here]
                size = n + rest
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                texts.append(data[np.repeat(first, size) + inside + half * (inside >= np.repeat(off, size))])
                sizes.append(size)
                out["h"].append(name[here].view(np.int64))
                out["c"].append(np.zeros(len(text), np.int32))
                out["doc"].append(ids[at + text])
                out["v"].append(vs[at + text])
                out["place"].append(place[here])

                here = mine & hot
                first, n, _ = placed(place[here])
                n = n + 1
                text = np.repeat(of[here], n)
                p = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()) + border[text]
                name, tail = span_hashes(sums, p, p + half), span_hashes(sums, p + half, p + whole)
                out["h"].append(mix(name * np.uint64(PAIR) + tail).view(np.int64))
                out["c"].append(((name ^ (tail * np.uint64(PAIR))) >> np.uint64(32)).astype(np.uint32).view(np.int32))
                out["doc"].append(ids[at + text])
                out["v"].append(vs[at + text])
                out["place"].append((p - border[text]) << 32)
                sizes.append(np.full(len(p), -1))
            size = np.concatenate([*sizes, np.zeros(0, np.int64)])
            ends = np.concatenate([[0], np.cumsum(np.maximum(size, 0))]).astype(np.int32)
            raw = np.concatenate([*texts, np.zeros(0, np.uint8)])
            there = np.packbits(size >= 0, bitorder="little")
            beside = pa.Array.from_buffers(pa.binary(), len(size), [pa.py_buffer(there), pa.py_buffer(ends), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([*_frame(out, types).columns, beside], names=[*types, "beside"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Round two, from open anchors sorted by (h, doc): runs of windows that a smaller doc also has.

        A window is named by its bytes beside the anchor and the anchor's offset in it, and compared among the windows of one h.
        """
        h0 = None
        seen, least = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # names of the current h's windows, and the least doc of each
        for batch in batches:
            if batch.num_rows == 0:
                continue
            h, doc, v = (batch.column(c).to_numpy() for c in ("h", "doc", "v"))
            first, n, off = placed(batch.column("place").to_numpy())
            n = n + 1
            of = np.repeat(np.arange(len(h)), n)
            p = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            size = n + rest - 1
            data = np.concatenate([x for _, x in _texts(batch, "beside")])
            at = np.repeat(np.cumsum(size) - size, n) + p
            name = span_hashes(prefix_sums(data), at, at + rest)
            name = mix(name + (off[of] - p + 1).astype(np.uint64) * np.uint64(PAIR)) + mix(h[of].view(np.uint64))
            old = len(seen) if h[0] == h0 else 0
            name, d = np.concatenate([seen[:old], name]), np.concatenate([least[:old], doc[of]])
            hh = np.concatenate([np.full(old, h[0]), h[of]])
            order = np.argsort(name, kind="stable")  # rows are in order of doc, so the first of a name has its least doc
            name, hh = name[order], hh[order]
            new = np.concatenate([[True], (name[1:] != name[:-1]) | (hh[1:] != hh[:-1])])
            low = d[order][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
            covered = np.zeros(len(d), bool)
            covered[order] = low < d[order]
            h0, stay = h[-1], new & (hh == h[-1])
            seen, least = name[stay], low[stay]
            hit = np.flatnonzero(covered[old:])
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(of[hit]) != 0)])) if len(hit) else hit
            begin, end = hit[cut], hit[np.concatenate([cut[1:] - 1, [len(hit) - 1]])] if len(hit) else hit
            row = of[begin]
            out = [doc[row], v[row], (first[row] + p[begin]).astype(np.int32), (first[row] + p[end] + whole).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["doc", "v", "start", "end"])

    open_ = ranged.where("state > 0").groupBy("doc", "v").agg(F.collect_set(F.struct("place", "state")).alias("open"))
    first = F.shiftright("place", 32).cast("int")
    turns = turns_for(ranged.where("state = 1").count(), OPEN_ROOM, size)
    found = []
    for turn in range(turns):
        # written before its rows are dealt out, so that they and the texts do not lie in shuffles at a time
        single = stages.save(docs.join(open_, ["doc", "v"]).mapInArrow(opened, "h long, c int, doc long, v long, place long, beside binary"), f"single-{turn}")
        stages.release()
        beside = single.where("beside is not null").select("h", "doc", "v", "place", "beside").repartition("h").sortWithinPartitions("h", "doc")
        found.append(stages.save(beside.mapInArrow(within, "doc long, v long, start int, end int"), f"beside-{turn}"))
        del beside
        if len(hot):
            common = single.where("beside is null")
            ends = common.groupBy("h", "c").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
            least = stages.save(ends.where("least < most").select("h", "c", "least"), f"least-{turn}")
            some = common.join(least, ["h", "c"]).where("least < doc").select("doc", "v", first.alias("start"), (first + length).alias("end"))
            found.append(stages.save(some, f"common-{turn}"))
            del common, ends, least, some
        stages.drop(f"single-{turn}", f"least-{turn}")
    last = F.shiftright("place", 32 - step).bitwiseAND((1 << step) - 1).cast("int")
    full = ranged.where("state = 0").select("doc", "v", first.alias("start"), (first + last + length).alias("end"))
    return reduce(DataFrame.unionByName, found, full)


def version() -> Column:
    """What tells the texts of one id apart: the first 60 bits of a text's SHA-256."""
    return F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("long")


def remove_repeats(df: DataFrame, stages: Stages, doc_id: str = "doc_id", text: str = "text", length: int = 50, with_kept: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    ``with_kept`` adds ``kept``, the remaining bytes of each row that lost some (else null).
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    facts = stages.save(rows.select("doc", version().alias("v"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")), "facts")
    # only ids of several texts need to tell them apart; elsewhere v is 0, which takes no room in the rows that carry it
    several = stages.save(facts.where("doc is not null").groupBy("doc").agg(F.min("v").alias("v0"), F.max("v").alias("v1")).where("v0 < v1").select("doc", F.lit(True).alias("several")), "several")
    seldom = several.count() <= BROADCAST_COPIES

    def told(frame: DataFrame, v: Column) -> DataFrame:
        return frame.join(F.broadcast(several) if seldom else several, "doc", "left").withColumn("v", F.when(F.col("several"), v).otherwise(F.lit(0).cast("long"))).drop("several")

    facts = told(facts, F.col("v"))
    own = facts.where(F.col("doc").isNotNull() & (F.col("n_bytes") >= length))
    groups = stages.save(own.groupBy("whole").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1"), "groups")
    copies = stages.save(join_hot(own, groups, "whole", "n", facts.count()).where("doc > first").select("doc", "v").distinct(), "copies")
    docs = told(rows.where("doc is not null"), version())
    few = copies.count() <= BROADCAST_COPIES
    docs = docs.join(F.broadcast(copies) if few else copies, ["doc", "v"], "left_anti")
    docs = docs if few and seldom else stages.save(docs, "distinct")
    spans = repeated_spans(docs, stages, facts.agg(F.sum("n_bytes")).first()[0] or 0, length)
    per_doc = spans.groupBy("doc", "v").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("spans")
            removed, runs, sha, kept = [], [], [], []
            for i, data in _texts(batch):
                flat = found[i].values
                n = len(data) + 1
                edge = np.bincount(flat.field("start").to_numpy(), minlength=n) - np.bincount(flat.field("end").to_numpy(), minlength=n)
                covered = np.cumsum(edge[:-1]) > 0
                rest = data[~covered].tobytes()
                removed.append(int(covered.sum()))
                runs.append(int(np.count_nonzero(np.diff(covered.astype(np.int8), prepend=0) == 1)))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_kept else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("v"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                names=["doc", "v", "n_removed", "n_spans", "sha", "kept"],
            )

    lost = (
        docs.join(per_doc, ["doc", "v"])
        .mapInArrow(cut, "doc long, v long, n_removed long, n_spans long, sha string, kept binary")
        .dropDuplicates(["doc", "v"])
    )
    out = facts.join(lost, ["doc", "v"], "left").join(F.broadcast(copies) if few else copies, ["doc", "v"], "left_anti").select(
        F.col("doc").alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"), *(["kept"] if with_kept else []),
    )
    gone = facts.join(F.broadcast(copies) if few else copies, ["doc", "v"], "left_semi").select(
        F.col("doc").alias("doc_id"), "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"), *([F.lit(b"").alias("kept")] if with_kept else []),
    )
    return out.unionByName(gone)
