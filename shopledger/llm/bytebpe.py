"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that reach ``OVERLAP`` code points into the next one, and each chunk is split into
pre-tokens for itself, in a task of its own. A chunk that starts inside a pre-token is out of step at first, and the
last pre-tokens of a chunk may be cut short; between the two the borders of both chunks resynchronise. The first border
that both have in their overlap is where they are stitched: the text between two stitches is a piece that is encoded
for itself. Chunks without a common border (a run of one kind of character longer than the overlap) stay one piece.
A short text is one piece and never leaves its task. Ids of a document are put together in the order of its pieces.

That holds for patterns that look ahead ``MARGIN`` code points at most and never back, and that always have a border
between a character and following white space, as that of byte-level vocabularies. What counts as a letter, a number
and white space is asked of the tiktoken library, so that borders are those of its version of Unicode.

Nulls and empty texts have no ids and decode to nothing. Repeated rows give repeated rows, null ids stay null ids. An
empty table gives no rows. Columns other than the id and the text are not read. Strings of special tokens are ordinary
text. Decoding concatenates the bytes of the ids; ids that the vocabulary lacks are left out.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.bpe import LONG, merged, merged_long
from shopledger.llm.common import by_batch, placed, table

#: Code points of a chunk, and those it shares with the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 8
#: A pre-token that ends so many code points before the end of a chunk is whole: the longest English ending.
MARGIN = 3
#: Pre-tokens a worker remembers at least, and half of those it holds at most.
REMEMBERED = 250_000
_LOADED: dict[tuple, Pieces] = {}
_CLASSES: dict[tuple, str] = {}
#: Code points below which a text lies: the smaller, the faster its classes are searched.
LIMITS = (0x80, 0x10000, sys.maxunicode + 1)


def character_class(name: str, limit: int = LIMITS[-1]) -> str:
    r"""The characters of a class such as ``\p{L}`` below a limit, as ranges: those that tiktoken finds."""
    if (name, limit) not in _CLASSES:
        import tiktoken

        probe = tiktoken.Encoding(name, pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        every = [c for c in range(limit) if not 0xD800 <= c < 0xE000]
        found = np.sort(np.frombuffer(bytes(probe.encode_ordinary("".join(map(chr, every)))).decode().encode("utf-32-le"), "<u4").astype(np.int64))
        breaks = np.flatnonzero(np.diff(found) != 1)
        starts, ends = found[np.r_[0, breaks + 1]], found[np.r_[breaks, len(found) - 1]]
        _CLASSES[name, limit] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts.tolist(), ends.tolist()))
    return _CLASSES[name, limit]


def pattern_of(text: str, limit: int = LIMITS[-1]) -> re.Pattern:
    r"""The pattern for texts below a limit, with ``\p{..}``, ``\s`` and ``\S`` written out, inside and outside of brackets."""
    inside, out = False, []
    for part in re.findall(r"\\p\{\w+\}|\\.|.", text, re.S):
        inside = inside and part != "]" or not inside and part == "["
        if part.startswith("\\p") or part == "\\s":
            out.append(character_class(part, limit) if inside else f"[{character_class(part, limit)}]")
        elif part == "\\S":
            out.append(f"[^{character_class('\\s', limit)}]")
        else:
            out.append(part)
    return re.compile("".join(out))


class Pieces(dict):
    """Pre-tokens already seen -> their ids as little-endian 32-bit numbers; a missing one is encoded."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        get = self.ranks.get
        # both ids of a pair in one number -> rank and the merged id in one number; here a token's rank is its id
        self.merges = {
            a << 20 | b: rank << 20 | rank
            for token, rank in self.ranks.items() for cut in range(1, len(token))
            if (a := get(token[:cut])) is not None and (b := get(token[cut:])) is not None
        }
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]
        self.patterns = [pattern_of(pattern, limit) for limit in LIMITS]
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is not None:
                ids = [whole]
            else:
                parts = list(map(self.bytes.__getitem__, data))
                ids = merged(parts, self.merges) if len(parts) <= LONG else merged_long(parts, self.merges)
            found = little(ids)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        if len(piece) <= 256:
            self[piece] = found
        return found

    def pattern(self, text: str) -> re.Pattern:
        """The pattern that is enough for the text: UTF-16 is longer than two bytes a sign only beyond the first plane."""
        plane = 1 if len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text) else 2
        return self.patterns[0 if text.isascii() else plane]

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.pattern(text).findall(text))) if text else b""

    def decode(self, data: bytes | None) -> bytes:
        ids = np.frombuffer(data or b"", "<u4").tolist()
        try:
            return b"".join(map(self.tokens.__getitem__, ids))
        except KeyError:
            return b"".join(self.tokens[i] for i in ids if i in self.tokens)


def little(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


def pieces(path: str, pattern: str) -> Pieces:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Pieces(path, pattern)
    return _LOADED[path, pattern]


def borders(known: Pieces, text: str, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Of a chunk: the borders in its head that the chunk before reaches too, and those in the part beyond ``chunk``
    that don't depend on what follows. Both count from the place they are shared from. A border behind white space is
    left out, as the pattern may have looked beyond it to place the one before."""
    head, tail = [0], []
    for found in known.pattern(text).finditer(text):
        end = found.end()
        if text[end - 1].isspace():
            continue
        if end < overlap:
            head.append(end)
        if chunk <= end <= len(text) - MARGIN:
            tail.append(end - chunk)
    return head, tail


def cut(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(file, row, k, chunk): the chunks of every text, each with its share of the next."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).to_pylist()
        starts = [range(0, max(1, len(t)), chunk) for t in texts]
        which = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        return pa.record_batch(
            [batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which)),
             pa.array([k for s in starts for k in range(len(s))], pa.int32()),
             pa.array([t[s : s + chunk + overlap] for t, ss in zip(texts, starts) for s in ss], pa.string())],
            ["file", "row", "k", "chunk"],
        )

    return by_batch(rows, run, "file long, row long, k int, chunk string", 1 << 20)


def stitches(chunks: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(file, row, k, piece, begin, end): the part of chunk k that counts, and the chunk with which its piece begins."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = pieces(path, pattern)
        found = [borders(known, t, chunk, overlap) for t in batch.column(3).to_pylist()]
        kind = pa.list_(pa.int32())
        return pa.record_batch([*batch.columns[:3], pa.array([h for h, _ in found], kind), pa.array([t for _, t in found], kind)], ["file", "row", "k", "head", "tail"])

    met = by_batch(chunks, run, "file long, row long, k int, head array<int>, tail array<int>", 1 << 20)
    order = Window.partitionBy("file", "row").orderBy("k")
    # the first border that this chunk and the next have in common
    common = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    met = met.select("file", "row", "k", common.alias("common"), F.lead("k").over(order).isNull().alias("final"))
    met = met.select("*", F.lag("common").over(order).alias("before"))
    piece = F.max(F.when((F.col("k") == 0) | F.col("before").isNotNull(), F.col("k"))).over(order)
    return met.select(
        "file", "row", "k", piece.alias("piece"), F.coalesce("before", F.lit(0)).alias("begin"),
        F.when(F.col("final"), F.lit(chunk + overlap)).otherwise(F.coalesce("common", F.lit(0)) + chunk).alias("end"),
    )


def encode(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(id, ids) of every row: little-endian 32-bit ids of its text.

    ``path`` names the vocabulary's rank file on the executors. Texts of at most ``chunk`` bytes are one piece.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = pieces(path, pattern)
        return pa.record_batch([batch.column(0), pa.array(map(known.encode, batch.column(1).to_pylist()), pa.binary())], ["id", "ids"])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = pieces(path, pattern)
        return pa.record_batch([*batch.columns[:3], pa.array(map(known.encode, batch.column(3).to_pylist()), pa.binary())], ["file", "row", "piece", "ids"])

    rows = placed(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "file", "row")
    is_long = F.coalesce(F.octet_length("text") > chunk, F.lit(False))
    short = by_batch(rows.where(~is_long).select("id", "text"), whole, f"id {id_type}, ids binary", 1 << 20)
    long_ = rows.where(is_long)
    chunks = cut(long_.select("file", "row", "text"), chunk, overlap)
    parts = chunks.join(stitches(chunks, path, pattern, chunk, overlap), ["file", "row", "k"]).select(
        "file", "row", "piece", "k", F.expr("substring(chunk, begin + 1, end - begin)").alias("part")
    )
    texts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x.part), "")
    found = by_batch(parts.groupBy("file", "row", "piece").agg(texts.alias("text")), each, "file long, row long, piece int, ids binary", 1 << 20)
    together = found.groupBy("file", "row").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("pieces"))

    def joined(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [b"".join(p["ids"] for p in ps) for ps in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    named = long_.select("file", "row", "id").join(together, ["file", "row"]).select("id", "pieces")
    return short.unionByName(by_batch(named, joined, f"id {id_type}, ids binary", 1 << 20))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` and the bytes its ids stand for."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    where = df.columns.index(ids_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = pieces(path, pattern)
        return pa.record_batch([*batch.columns, pa.array(map(known.decode, batch.column(where).to_pylist()), pa.binary())], [*batch.schema.names, out_col])

    return by_batch(df, run, StructType([*df.schema.fields, StructField(out_col, BinaryType())]), 1 << 20)


def op12_bytebpe(spark, sf_dir: str) -> DataFrame:
    """Ids of the byte-level vocabulary over all documents and the bytes they decode to, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = decode(encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return coded.select(
        F.col("id").alias("doc_id"),
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
