"""Near-dedup by improved consistent weighted sampling over TF-IDF shingles.

Elements are five-word shingles; a shingle weighs tf * idf.  Document frequencies are
counted over all documents into two count-min rows of fixed size, which stay with the tasks; the driver and the tasks are told
the slots whose share exceeds ``COMMON``, and all others weigh the same.  A slot's excess share of documents is the mean number of shingles a document over the
number of slots, whatever the number of documents, and lies below ``COMMON`` for documents of some hundred words.
The idf is 0 for a shingle in every document and 1 from the share ``COMMON`` down; as weight it is damped into
[1, 1 + DAMPING]: a group of thousands of near copies must not make its own shared shingles
count for nothing.

1. Each distinct sequence of words (a text with all its copies) gets ``BANDS * ROWS`` consistent weighted samples.
2. Bands bucket the texts.  Members of a bucket of up to ``TILE`` texts are compared by their samples, which links those whose
   estimated similarity is at least ``LOOSE``; a larger bucket links all its members to one of them.  This only decides
   which texts are compared.
3. Each connected group is compared by exact weighted Jaccard similarity over whole texts; pairs of similarity >= threshold are
   links.  A group is cut into tiles of bounded size, and each tile also gets the same few representatives of the group.  Texts of a tile that
   links join to a representative need no further comparison: more links among them change no class.  The others (few, unless
   a group holds together by nothing but estimates) meet every other tile.  So a group of n copies costs n, not n * n, and no link
   between different classes is lost.

Classes are connected components of the links.  Result per row: doc_id, component_id (least id of the class) and kept (true for the rows of one
text of one id in each class).

Defined cases: null, empty and wordless texts are classes of their own and kept; a text of fewer than five words
is one shingle; texts of any length are compared whole, a long one in a tile of its own; repeated rows of the kept text are all kept; of two
texts of one id each has its own class, and one of them is kept if both share it; null ids come after all others: a row without id is kept if no
row of its class has one, with null as component; ties go to the least id, then to the least text hash.
An empty table gives an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, join_hot
from .kernels import Words, blocks, lowered, mix, union_forest
from .tables import Stages

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
LOOSE = 0.55
#: Two count-min rows of 2**DF_BITS slots, summed in slices.
DF_BITS = 20
DF_SLICE = 1 << 12
COMMON = 1e-3
DAMPING = 0.25
#: Members of a tile, and bytes of text in a verification tile; representatives of a group of several tiles.
TILE, TILE_BYTES = 512, 1 << 20
HEADS = 8
#: Rows of (id, hashes, group) that a join with the documents broadcasts at most, 100 bytes each.
BROADCAST_TEXTS = 300_000


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each shingle in both rows."""
    size = np.uint64((1 << bits) - 1)
    return (h & size).astype(np.int64), ((h >> np.uint64(32)) & size).astype(np.int64) + (1 << bits)


def common_slots(docs: DataFrame, bits: int = DF_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(slot, weight) of the slots of both rows that a share of more than ``COMMON`` of the documents has; every document counts."""
    size = 2 << bits
    step = min(DF_SLICE, size)
    n = docs.count()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(size, np.uint32)
        for pdf in batches:
            texts = lowered(list(pdf["text"]))
            for lo, hi in blocks(texts):
                h, _, _ = _shingles(texts[lo:hi])
                for slot in _slots(h, bits):
                    table += np.bincount(slot, minlength=size).astype(np.uint32)
        parts = table.reshape(-1, step)
        some = np.flatnonzero(parts.any(axis=1))
        yield pd.DataFrame({"part": some, "counts": [parts[i].astype(np.int64).tobytes() for i in some]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A running sum a slice: memory follows the slices of a task, not the number of input partitions."""
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for part, counts in zip(pdf["part"], pdf["counts"]):
                total[part] = total.get(part, 0) + np.frombuffer(counts, np.int64)
        for part, counts in total.items():
            often = np.flatnonzero(counts > COMMON * n)
            yield pd.DataFrame({"slot": part * step + often, "weight": idf_table(counts[often], n)})

    rows = docs.select("text").mapInPandas(count, "part int, counts binary").repartition("part").mapInPandas(add, "slot int, weight float").toArrow()
    return rows["slot"].to_numpy(), rows["weight"].to_numpy()


def told_weights(slots: np.ndarray, weight: np.ndarray, bits: int = DF_BITS) -> np.ndarray:
    """Weight by slot from what ``common_slots`` gives."""
    idf = np.full(2 << bits, 1 + DAMPING, np.float32)
    idf[slots] = weight
    return idf


def idf_table(table: np.ndarray, n: int) -> np.ndarray:
    """Weight by slot: 1 for a shingle in every document, 1 + DAMPING for a rare one."""
    share = np.clip(table / max(n, 1), COMMON, 1)
    return (1 + DAMPING * np.log(share) / np.log(COMMON)).astype(np.float32)


def weights(h: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The weight of each shingle: that of the less frequent of its two slots."""
    a, b = _slots(h, len(idf).bit_length() - 2)
    return np.maximum(idf[a], idf[b])


def _shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shingle, text index, count), sorted by text."""
    h, t = Words(texts).shingles(WORDS)
    if len(h) == 0:
        return h, t, t
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]))
    return h[new], t[new], np.diff(np.append(new, len(h)))


def _gamma_tables() -> tuple[np.ndarray, np.ndarray]:
    """65536 quantile draws of r and ln c, both Gamma(2, 1), in a fixed shuffled order."""
    rng = np.random.Generator(np.random.PCG64(20240607))
    grid = np.linspace(0, 40, 400_001)
    cdf = 1 - np.exp(-grid) * (1 + grid)
    draws = np.interp((np.arange(65536) + 0.5) / 65536, cdf, grid)
    return rng.permutation(draws).astype(np.float32), np.log(rng.permutation(draws)).astype(np.float32)


def samples(h: np.ndarray, t: np.ndarray, weight: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """k consistent weighted samples (uint32 names) per text; rows of texts without elements stay 0."""
    r_of, c_of = _gamma_tables()
    out = np.zeros((n_texts, k), np.uint32)
    if len(h) == 0:
        return out
    starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    owners, ln_s = t[starts], np.log(weight).astype(np.float32)
    seeds = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for j in range(k):
        x = (h ^ seeds[j]) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        r = r_of[(x & np.uint64(0xFFFF)).astype(np.int32)]
        beta = ((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
        level = np.floor(ln_s / r + beta)
        ln_a = c_of[((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)] - r * (level - beta + 1)
        raw = ln_a.view(np.uint32)
        rank = np.where(raw >> 31, ~raw, raw | np.uint32(0x80000000)).astype(np.uint64)
        name = ((x >> np.uint64(13)) + level.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        least = np.minimum.reduceat((rank << np.uint64(32)) | name, starts)
        out[owners, j] = (least & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


class Tile:
    """Weighted Jaccard similarities of some texts, by rows of whole texts."""

    def __init__(self, texts: list[bytes], idf: np.ndarray):
        h, t, tf = _shingles(texts)
        w = weights(h, idf).astype(np.float64)
        self.n = len(texts)
        self.total = np.bincount(t, weights=w * tf, minlength=self.n)
        # the c-th occurrence of a shingle is an element of its own: minima of counts become intersections
        at = np.repeat(np.arange(len(h)), tf)
        nth = (np.arange(len(at)) - np.repeat(np.cumsum(tf) - tf, tf)).astype(np.uint64)
        e = mix(h[at] + nth * np.uint64(0x9E3779B97F4A7C15))
        t, w = t[at], w[at]
        order = np.argsort(e, kind="stable")
        e, t, w = e[order], t[order], w[order]
        column = np.cumsum(np.concatenate([[True], e[1:] != e[:-1]])[: len(e)]) - 1
        shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)
        self.t, self.w = t[shared], w[shared]
        _, self.column = np.unique(column[shared], return_inverse=True)

    def similar(self, a: np.ndarray, b: np.ndarray, threshold: float, width: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """Pairs out of rows a and rows b of similarity >= threshold."""
        least = np.zeros((len(a), len(b)))
        n = int(self.column[-1]) + 1 if len(self.column) else 0
        place_a, place_b = np.full(self.n, -1), np.full(self.n, -1)
        place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
        for lo in range(0, n, width):
            s, f = np.searchsorted(self.column, [lo, lo + width])
            c, t, w = self.column[s:f] - lo, self.t[s:f], np.sqrt(self.w[s:f])
            sides = []
            for place, size in ((place_a, len(a)), (place_b, len(b))):
                m = np.zeros((size, min(width, n - lo)))
                x = place[t] >= 0
                m[place[t[x]], c[x]] = w[x]
                sides.append(m)
            least += sides[0] @ sides[1].T
        link = least >= threshold * (self.total[a][:, None] + self.total[b][None] - least) - 1e-9
        i, j = np.nonzero(link)
        i, j = a[i], b[j]
        return i[i != j], j[i != j]


def joined(n: int, heads: np.ndarray, similar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links a, links b, rows without a link path to the first head) of n members; ``similar(a, b)`` gives pairs.

    All members meet the heads; only those that are not joined to the first head then meet everyone.
    """
    everyone = np.arange(n)
    i, j = similar(heads, everyone)

    def loose() -> np.ndarray:
        nonlocal i, j
        keep = union_forest(n, i, j)
        i, j = i[keep], j[keep]
        root = everyone.copy()
        for a, b in zip(i.tolist(), j.tolist()):  # a forest of at most n - 1 links
            root[root == root[max(a, b)]] = root[min(a, b)]
        return np.flatnonzero(root != root[heads[0]])

    rest = loose()
    rest = rest[~np.isin(rest, heads)]
    if len(rest):
        for s in range(0, len(rest), 256):
            x, y = similar(rest[s : s + 256], everyone)
            i, j = np.concatenate([i, x]), np.concatenate([j, y])
        rest = loose()
    return i, j, rest


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows sorted by ``keys``, over batch borders; holds one group at a time."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if len(pdf) == 0:
            continue
        k = pdf[keys].to_numpy()
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        for i, part in enumerate(np.split(np.arange(len(pdf)), cut)):
            part = pdf.iloc[part[0] : part[-1] + 1]
            if held and (i or (held[-1][keys].iloc[-1].to_numpy() != part[keys].iloc[0].to_numpy()).any()):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def near_duplicates(df: DataFrame, stages: Stages, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, component_id (least id of its class), kept, and version, the hash of its text."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    told = df.sparkSession.sparkContext.broadcast(common_slots(docs))  # at most 16 MB, some kilobytes unless documents are very long
    k = BANDS * ROWS

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf = told_weights(*told.value)
        for pdf in batches:
            texts = lowered(list(pdf["text"]))
            for lo, hi in blocks(texts):
                words = Words(texts[lo:hi])
                h, t, tf = _shingles(texts[lo:hi])
                sig = samples(h, t, weights(h, idf) * tf.astype(np.float32), hi - lo, k)
                n = np.diff(words.first)
                place = (np.arange(len(words.hash)) - words.first[words.text]).astype(np.uint64)
                at = np.minimum(words.first[:-1], max(len(words.hash) - 1, 0))
                keys = []
                for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                    x = mix(words.hash + place * np.uint64(salt))
                    keys.append(np.add.reduceat(x, at) if len(x) else np.zeros(hi - lo, np.uint64))
                seq = [f"{a:016x}{b:016x}{c:x}" if c else None for a, b, c in zip(*(x.tolist() for x in (*keys, n)), strict=True)]
                band = mix(np.ascontiguousarray(sig).reshape(hi - lo, BANDS, ROWS).astype(np.uint64) @ np.array([1, 0x100000001B3, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F][:ROWS], dtype=np.uint64))
                band = mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[lo:hi].to_numpy(), "version": pdf["version"].iloc[lo:hi].to_numpy(), "seq": seq, "bands": list(band),
                    "sig": [s.tobytes() for s in (sig & 0xFF).astype(np.uint8)], "n_bytes": [len(x) for x in texts[lo:hi]],
                })

    signed = stages.save(
        docs.withColumn("version", F.xxhash64("text"))
        .mapInPandas(sign, "doc_id long, version long, seq string, bands array<long>, sig binary, n_bytes long"), "signed",
    )
    # one row a sequence of words; its lead is the row that stays, and whose text is compared
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version")).alias("lead")
    texts = stages.save(
        signed.where("seq is not null").groupBy("seq").agg(lead, F.count("*").alias("n"), F.first(F.struct("bands", "sig", "n_bytes")).alias("s"))
        .select("seq", F.monotonically_increasing_id().alias("node"), "lead", "n", "s.*"), "texts",
    )
    n_docs, n_texts = signed.count(), texts.count()

    members = texts.select("node", F.explode("bands").alias("band"))
    full = stages.save(members.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1"), "full")
    crowded = join_hot(members, full.where(F.col("n") > TILE), "band", "n", BANDS * n_texts).select(F.col("node").alias("a"), F.col("head").alias("b"))
    few = full.where(F.col("n") <= TILE)
    small = texts.select("node", "sig", F.explode("bands").alias("band")).join(few.select("band"), "band").select("band", "node", "sig")

    def estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        need = int(np.floor(LOOSE * k))
        a_out, b_out = [], []
        for g in _grouped(batches, ["band"]):
            nodes = g["node"].to_numpy()
            sig = np.frombuffer(b"".join(g["sig"]), np.uint8).reshape(len(g), k)

            def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                i, j = np.nonzero((sig[a][:, None, :] == sig[b][None]).sum(axis=2) >= need)
                i, j = a[i], b[j]
                return i[i != j], j[i != j]

            i, j, _ = joined(len(g), np.zeros(1, np.int64), alike)
            a_out.append(nodes[i])
            b_out.append(nodes[j])
            if sum(map(len, a_out)) > 100_000:
                yield pd.DataFrame({"a": np.concatenate(a_out), "b": np.concatenate(b_out)})
                a_out, b_out = [], []
        if a_out:
            yield pd.DataFrame({"a": np.concatenate(a_out), "b": np.concatenate(b_out)})

    near = small.repartition("band").sortWithinPartitions("band").mapInPandas(estimate, "a long, b long").unionByName(crowded)
    group = components(near, stages, "candidates")
    stages.drop("full")
    # size and representatives of each group: the least node of each of HEADS residues
    sized = stages.save(
        group.join(texts.select("node", "n_bytes"), "node").groupBy("component").agg(
            F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"), *[F.min(F.when(F.pmod(F.xxhash64("node"), F.lit(HEADS)) == i, F.col("node"))).alias(f"h{i}") for i in range(HEADS)],
        ).select(
            "component", "n", F.greatest(F.ceil(F.col("bytes") / TILE_BYTES), F.ceil(F.col("n") / TILE)).cast("int").alias("tiles"),
            F.array_compact(F.array(*[f"h{i}" for i in range(HEADS)])).alias("heads"),
        ), "sized",
    )
    placed = stages.save(
        join_hot(group, sized, "component", "n", n_texts).join(texts.select("node", "lead"), "node").select(
            "component", "node", "tiles", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"),
            (F.array_contains("heads", F.col("node")) & (F.col("tiles") > 1)).alias("head"), "lead.doc_id", "lead.version",
        ), "placed",
    )

    def with_text(rows: DataFrame) -> DataFrame:
        """Rows (doc_id, version, ...), one or a few a text, with the text."""
        few = rows.select("doc_id", "version").distinct().count() <= BROADCAST_TEXTS
        both = docs.withColumn("v", F.xxhash64("text")).withColumnRenamed("doc_id", "d")
        rows = F.broadcast(rows) if few else rows
        # repeated rows of one text are seen several times; tasks take the first
        return both.join(rows, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("v") == F.col("version"))).drop("d", "v", "doc_id", "version")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links (a, b) of each tile, and as (a, null) the members that no links join to the first representative."""
        idf = told_weights(*told.value)
        for g in _grouped(batches, ["component", "tile"]):
            g = g[~g["node"].duplicated()]
            if len(g) < 2:
                continue
            nodes, heads = g["node"].to_numpy(), np.flatnonzero(g["head"].to_numpy())
            tile = Tile(lowered(list(g["text"])), idf)
            i, j, rest = joined(len(g), heads if len(heads) else np.zeros(1, np.int64), lambda a, b: tile.similar(a, b, threshold))
            a, b = [nodes[i]], [pd.array(nodes[j], dtype="Int64")]
            if g["tiles"].iloc[0] > 1:
                rest = rest[~g["head"].to_numpy()[rest]]
                a.append(nodes[rest])
                b.append(pd.array([None] * len(rest), dtype="Int64"))
            yield pd.DataFrame({"a": np.concatenate(a), "b": pd.concat([pd.Series(x) for x in b], ignore_index=True)})

    spread = placed.withColumn("tile", F.explode(F.when(F.col("head"), F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array("tile"))))
    found = stages.save(
        with_text(spread).select("component", "tile", "tiles", "node", "head", "text")
        .repartition("component", "tile").sortWithinPartitions("component", "tile").mapInPandas(verify, "a long, b long"), "links",
    )
    links = found.where("b is not null")
    left = found.where("b is null").select(F.col("a").alias("node")).distinct()
    if not left.isEmpty():
        links = links.unionByName(_rest_links(stages, placed, stages.save(left, "left"), with_text, told, threshold))
    comp = components(links, stages, "classes")
    stages.drop("links", "sized", "placed")

    owned = texts.select("node", "seq", "lead", "n").join(comp, "node", "left").withColumn("class", F.coalesce("component", "node"))
    owned = stages.save(owned.select("seq", "lead", "n", "class"), "owned")
    best = stages.save(owned.groupBy("class").agg(F.min("lead").alias("best"), F.count("*").alias("n_texts")), "best")
    known = stages.save(
        join_hot(owned, best, "class", "n_texts", n_texts).select("seq", "best", "n"), "known"
    )
    rows = signed.select("doc_id", "version", "seq")
    mine = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("version") == F.col("best.version"))
    out = join_hot(rows.where("seq is not null"), known, "seq", "n", n_docs).select("doc_id", F.col("best.doc_id").alias("component_id"), mine.alias("kept"), "version")
    stages.drop("owned", "best")
    return out.unionByName(rows.where("seq is null").select("doc_id", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "version"))


def _rest_links(stages: Stages, placed: DataFrame, left: DataFrame, with_text, told, threshold: float) -> DataFrame:
    """Links between the texts in ``left`` (node), cut into tiles of their own, and all other tiles of their groups."""
    rest = placed.where("not head").join(left, "node")
    many = stages.save(rest.groupBy("component").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts")), "rest-sizes")  # texts may be long
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int")
    rest = rest.join(many, "component").withColumn("part", part).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("asks", F.lit(True))
    others = placed.where("not head").join(many, "component").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("asks", F.lit(False))
    columns = ["component", "tile", "part", "node", "asks"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf = told_weights(*told.value)
        for g in _grouped(batches, ["component", "tile", "part"]):
            g = g.sort_values("asks", ascending=False, kind="stable")
            g = g[~g["node"].duplicated()]
            asks = np.flatnonzero(g["asks"].to_numpy())
            if len(asks) == 0 or len(g) < 2:
                continue
            nodes = g["node"].to_numpy()
            i, j = Tile(lowered(list(g["text"])), idf).similar(asks, np.arange(len(g)), threshold)
            keep = union_forest(len(g), i, j)
            yield pd.DataFrame({"a": nodes[i[keep]], "b": nodes[j[keep]]})

    both = rest.select(*columns, "doc_id", "version").unionByName(others.select(*columns, "doc_id", "version"))
    return stages.save(
        with_text(both).select(*columns, "text").repartition("component", "tile", "part").sortWithinPartitions("component", "tile", "part")
        .mapInPandas(compare, "a long, b long"), "rest-links",
    )
