"""Packing of tokenised documents into windows: best-fit decreasing with a segment tree.

A document's ids (and a closing id) are cut into full windows first, each of which is a sequence of its own. The rest,
shorter than a window, joins a group. When a group is full, or its partition ends, its pieces are placed in decreasing
length, each into the open window with the least room that still takes it; a segment tree over the remaining room
finds that window. Partitions pack for themselves: nothing is shuffled, and a lost task repeats its own result.

Ids come from the byte-level vocabulary in its rank form; they equal those of the tokenizers library for the same
vocabulary (tests compare them). Nulls and empty texts are documents of the closing id alone. Repeated rows, repeated or null ids are documents of
their own. Runs of white space may be of any length. An empty table gives no piece. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.bytebpe import pieces
from shopledger.llm.common import slices, table

#: Tokens of a window.
WINDOW = 1024
END_OF_TEXT = "<|endoftext|>"
#: The pattern that splits text before the merges (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that are packed together: a task holds so many pieces below a window's length at most.
GROUP = 16_384
#: Runs of white space (of Unicode, fixed signs) that are cut out before the library sees the text.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_LOADED: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a rank file; the id behind the last one is its end-of-text sign."""
    if path not in _LOADED:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _LOADED[path] = tiktoken.Encoding(
            os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: max(ranks.values()) + 1}
        )
    return _LOADED[path]


def ids_of(text: str, path: str) -> bytes:
    """Little-endian 32-bit ids of a text.

    The library's pattern steps back over white space and gives up on very long runs of it, so these are cut out: all of a
    run but its last sign (or all, at the end of the text) is one piece of the pattern, which is merged for itself.
    """
    out, start = [], 0
    for run in BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += [plain_ids(text[start : run.start()], path), pieces(path, PATTERN)[text[run.start() : end]]]
        start = end
    return b"".join([*out, plain_ids(text[start:], path)])


def plain_ids(text: str, path: str) -> bytes:
    return np.array(encoding(path).encode_to_numpy(text, allowed_special="all"), dtype="<u4").tobytes() if text else b""


class Room:
    """Segment tree over remaining room 0..size: how many open windows have it."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room of ``need`` or more that a window has."""
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.count[2 * node])
                return node - self.leaves
            node >>= 1
        return None

    def take(self, room: int) -> int:
        self._count(room, -1)
        return self.open[room].pop()


def best_fit(lengths: list[int], size: int) -> tuple[list[tuple[int, int]], int]:
    """(window, offset) of each length by best-fit decreasing, and the number of windows."""
    room, placed, windows = Room(size), [(0, 0)] * len(lengths), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        left = room.tightest(lengths[k])
        if left is None:
            window, left, windows = windows, size, windows + 1
        else:
            window = room.take(left)
        placed[k] = (window, size - left)
        if left > lengths[k]:
            room.add(left - lengths[k], window)
    return placed, windows


def pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", closing: int = 0, window: int = WINDOW, group: int = GROUP
) -> DataFrame:
    """One row per piece: its document, its ids (little-endian 32-bit), where they start in the document's ids, the
    document's number of ids, and the sequence and the offset where they lie.

    ``path`` names the vocabulary's rank file on the executors; ``closing`` is the id behind each document.
    """
    end = closing.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 36
        rest: list[tuple] = []

        def closed() -> pa.RecordBatch:
            nonlocal sequence, rest
            placed, windows = best_fit([len(p[2]) // 4 for p in rest], window)
            done = [(*p, sequence + w, offset) for p, (w, offset) in zip(rest, placed)]
            sequence, rest = sequence + windows, []
            return rows(done)

        for batch in batches:
            for part in slices(batch, 1 << 20):
                full = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    data = ids_of(text or "", path) + end
                    n = len(data) // 4
                    for start in range(0, n, window):
                        piece = (doc, start, data[4 * start : 4 * (start + window)], n)
                        if start + window <= n:
                            full.append((*piece, sequence, 0))
                            sequence += 1
                        else:
                            rest.append(piece)
                    if len(rest) >= group:
                        yield from split(closed())
                yield from split(rows(full))
        if rest:
            yield from split(closed())

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 6
        doc, start, data, n, sequence, offset = columns
        return pa.record_batch(
            [pa.array(doc, docs), pa.array(start, pa.int64()), pa.array(data, pa.binary()), pa.array(n, pa.int64()),
             pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
            ["id", "start", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def split(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        return slices(batch, 4 << 20)

    from pyspark.sql.pandas.types import to_arrow_type

    docs = to_arrow_type(df.schema[id_col].dataType)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long"
    return df.select(id_col, text_col).mapInArrow(run, schema)


def op8_packing(spark, sf_dir: str) -> DataFrame:
    """Where the ids of every document lie in sequences of at most 1024."""
    import public_tokenizers

    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed.select(
        F.col("id").alias("doc_id"), "start", (F.length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )
