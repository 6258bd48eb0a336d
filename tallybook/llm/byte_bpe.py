"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

Every byte has one printable character (the byte table), so a rank file of byte strings is a BPE model over characters: each token's
last merge is found by merging its bytes by rank, which gives the library's merge list.  A text is cut by the pattern, and the library
encodes each distinct piece once a task; ``ignore_merges`` takes a whole piece that is itself a token.  Decoding maps tokens back through the byte
table and joins bytes before any character is read, so characters split over tokens come out whole.

Ids travel packed: little-endian unsigned 32-bit integers in one binary value a text, as shards of training data hold them.

Defined cases: a null or empty text has no tokens and decodes to no bytes; invalid UTF-8 counts as U+FFFD; strings of special tokens are plain text;
repeated rows get equal results; very long texts are cut between a character and the white space after it, where no piece of the
pattern goes on, so memory follows the longest run without such a place; packed ids outside the vocabulary, or null, decode to null.
"""

from __future__ import annotations

import base64
import codecs
import os
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces that a task remembers, and code points of the longest piece among them.
MEMO, LONGEST = 300_000, 64
#: Code points of text that are cut into pieces at a time, and bytes of a batch that are worked on before they are handed on.
SLICE, PART = 1 << 18, 4 << 20
_made: dict[tuple, object] = {}


def byte_table() -> str:
    """The character of each byte: itself if printable and no space, else the next one from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in shown else chr(next(hidden)) for b in range(256))


TABLE = byte_table()
BYTE_OF = {c: b for b, c in enumerate(TABLE)}


def shown(token: bytes) -> str:
    return "".join(map(TABLE.__getitem__, token))


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens that merging by rank leaves last of ``token``; none if it is a byte or merging stops before."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, i = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == len(ranks):
            return None
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def from_ranks(data: bytes):
    """A tokenizer of the library for lines of base64 token and rank."""
    from tokenizers import Tokenizer, models

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    ordered = sorted(ranks, key=ranks.__getitem__)
    merges = [(shown(pair[0]), shown(pair[1])) for pair in (last_merge(token, ranks) for token in ordered) if pair]
    return Tokenizer(models.BPE(vocab={shown(token): rank for token, rank in ranks.items()}, merges=merges, ignore_merges=True))


def safe_slices(text: str, size: int) -> Iterator[str]:
    """The text in slices of about ``size``, cut only between a character and the white space after it: no piece reaches over such a place."""
    start = 0
    while len(text) - start > size:
        m = _BREAK.search(text, start + size)
        if not m:
            break
        yield text[start : m.start() + 1]
        start = m.start() + 1
    yield text[start:]


_BREAK = regex.compile(r"\S(?=\s)")


class ByteBPE:
    """One vocabulary inside a task: texts to packed ids, packed ids to bytes."""

    def __init__(self, data: bytes, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_str(data.decode()) if data.lstrip()[:1] == b"{" else from_ranks(data)
        self.model.encode_special_tokens = True
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cut = regex.compile(pattern).findall
        self.library_cut = pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str
        n = self.model.get_vocab_size(with_added_tokens=True)
        names = [self.model.id_to_token(i) or "" for i in range(n)]
        self.bytes = [bytes(map(BYTE_OF.__getitem__, t)) if all(c in BYTE_OF for c in t) else t.encode() for t in names]
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.memo: dict[str, bytes] = {}
        self.known: set[str] = set()

    def pieces(self, text: str) -> list[str]:
        """The pattern's matches, in the library's classes of characters.

        ``regex`` is quicker and agrees on every character of Unicode 15.1; texts with later ones are cut by the library itself.
        """
        if not text.isascii():
            new = set(text) - self.known
            if any(unicodedata.category(c) == "Cn" for c in new):
                return [piece for piece, _ in self.library_cut(text)]
            self.known |= new
        return self.cut(text)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Packed ids of each text."""
        for text in texts:
            yield b"".join(self.encode_all([part])[0] for part in (safe_slices(text, SLICE) if len(text) > SLICE else (text,)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of some texts, which are cut at once; the library gets the pieces that are new to the task."""
        cut, memo = [self.pieces(text) for text in texts], self.memo
        new = [p for p in {p for pieces in cut for p in pieces} if p not in memo]
        long: dict[str, bytes] = {}
        if new:
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = [*{p for pieces in cut for p in pieces}]
            for piece, found in zip(new, self.model.encode_batch_fast(new, add_special_tokens=False), strict=True):
                (memo if len(piece) <= LONGEST else long)[piece] = array("I", found.ids).tobytes()
        if long:
            return [b"".join(long[p] if p in long else memo[p] for p in pieces) for pieces in cut]
        return [b"".join(map(memo.__getitem__, pieces)) for pieces in cut]

    def encode_once(self, text: str) -> bytes:
        """Packed ids of a text whose pieces the task is not to remember."""
        return array("I", self.model.encode_batch_fast([self.pieces(text)], is_pretokenized=True, add_special_tokens=False)[0].ids).tobytes()

    def decode(self, packed: bytes) -> bytes | None:
        """The bytes of packed ids; none if an id is outside the vocabulary."""
        ids = np.frombuffer(packed, dtype="<u4")
        if len(ids) and ids.max() >= len(self.bytes):
            return None
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def offsets(self, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and end (exclusive) of every token: all characters of which it holds a byte."""
        ids = np.frombuffer(packed, dtype="<u4")
        raw = np.frombuffer(self.decode(packed) or b"", dtype=np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        end = np.cumsum(self.length[ids])
        return char[end - self.length[ids]], char[end - 1] + 1

    def token_texts(self, packed: bytes) -> list[str]:
        """The characters that each token completes; a split character belongs to the token with its last byte."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        out = [reader.decode(self.bytes[i]) for i in ids]
        if out:
            out[-1] += reader.decode(b"", final=True)
        return out


def made(kind: type, *args):
    """One object a worker process for the same arguments."""
    key = (kind, *args)
    if key not in _made:
        _made[key] = kind(*args)
    return _made[key]


def parts(batch: pa.RecordBatch, column: str, most: int = PART) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``most`` bytes in ``column``, or one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _vocabulary(df: DataFrame, path: str):
    """The file's bytes for all tasks; public vocabularies have a few megabytes at most."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def valid(text: str) -> Column:
    """The text column with null as empty and invalid UTF-8 as U+FFFD."""
    return F.make_valid_utf8(F.coalesce(F.col(text).cast("string"), F.lit("")))


def encode(df: DataFrame, key: str, text: str, vocabulary: str, pattern: str, offsets: bool = False) -> DataFrame:
    """Per row: the key, ``n_tokens`` and ``packed``; ``offsets`` adds ``char_start`` and ``char_end``, arrays with a place for each token."""
    data = _vocabulary(df, vocabulary)
    places = ", char_start array<int>, char_end array<int>" if offsets else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = made(ByteBPE, data.value, pattern)
        for batch in (part for whole in batches for part in parts(whole, "text")):
            packed = [*bpe.encode(t.as_py() for t in batch.column("text"))]
            cols = [batch.column("key"), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())]
            names = [key, "n_tokens", "packed"]
            if offsets:
                spans = [bpe.offsets(p) for p in packed]
                cols += [pa.array([s[i].tolist() for s in spans], pa.list_(pa.int32())) for i in (0, 1)]
                names += ["char_start", "char_end"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), valid(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, n_tokens long, packed binary{places}")


def decode(df: DataFrame, key: str, vocabulary: str, pattern: str, packed: str = "packed", tokens: bool = False) -> DataFrame:
    """Per row: the key, ``n_tokens``, ``packed`` and ``decoded`` (bytes); ``tokens`` adds ``token_texts``, the characters that each token completes."""
    data = _vocabulary(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = made(ByteBPE, data.value, pattern)
        for batch in (part for whole in batches for part in parts(whole, "packed")):
            found = [None if p is None or len(p) % 4 else bpe.decode(p) for p in batch.column("packed").to_pylist()]
            cols = [batch.column("key"), batch.column("n_tokens"), batch.column("packed"), pa.array(found, pa.binary())]
            names = [key, "n_tokens", "packed", "decoded"]
            if tokens:
                cols.append(pa.array([None if b is None else bpe.token_texts(p) for p, b in zip(batch.column("packed").to_pylist(), found, strict=True)], pa.list_(pa.string())))
                names.append("token_texts")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.expr(f"octet_length(`{packed}`) div 4").cast("long").alias("n_tokens"), F.col(packed).alias("packed"))
    return rows.mapInArrow(run, f"`{key}` {kind}, n_tokens long, packed binary, decoded binary{', token_texts array<string>' if tokens else ''}")


def token_digests(df: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the packed ids and of what they decode to."""
    back = decode(encode(df, doc_id, text, vocabulary, pattern), doc_id, vocabulary, pattern)
    return back.select(F.col(doc_id).alias("doc_id"), "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
