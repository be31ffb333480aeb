"""BPE encoding and decoding with a contiguous rank array.

A word's symbols lie in one array; beside each stands the rank of the merge with its right neighbour. The lowest rank
is merged, its boundary deleted and the two ranks beside it looked up again, until no merge is left. Words of more
than ``LONG`` symbols take their next merge from a heap instead of a scan, with the same result.

Ids equal those of the tokenizers library for a vocabulary with NFC, white-space and lower-case normalisation, a split
into letters, single digits and other signs, byte symbols and word ends, as in ``word_bpe_49k.json``.

Nulls and empty texts have no ids and decode to the empty text. Repeated rows give repeated rows. Columns other than
the id and the text are not read.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, table

#: Symbols from which a heap finds the next merge.
LONG = 64
#: Words a worker remembers at least, and half of those it holds at most.
REMEMBERED = 250_000
NONE = 1 << 60
#: White space to Python's str.split, but not to the tokenizer.
SEPARATORS = re.compile("[\x1c-\x1f]")
_LOADED: dict[str, Vocabulary] = {}


def byte_symbols() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in printable}
    signs |= {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in signs)}
    return [signs[b] for b in range(256)]


def category(first: str) -> str:
    """The characters of a general category, as ranges for a character class."""
    found = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == first]
    starts = [c for k, c in enumerate(found) if not k or found[k - 1] != c - 1]
    ends = [c for k, c in enumerate(found) if k + 1 == len(found) or found[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def word_pattern() -> re.Pattern:
    """What the tokenizer takes for a word: an English ending, letters, one digit, or other signs."""
    letters, digits = category("L"), category("N")
    space = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{space}{letters}{digits}]+")


class Vocabulary(dict):
    """Words already seen -> their ids; a missing word is encoded."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        model = loaded["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        # both ids of a pair in one number -> rank and the merged id in one number
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.older: dict[str, list[int]] = {}
        self.words = word_pattern()
        signs = byte_symbols()
        self.inner = [vocab[s] for s in signs]
        self.last = [vocab[s + self.end] for s in signs]
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"] if not t["normalized"]}
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}

    def __missing__(self, chunk: str) -> list[int]:
        """Ids of a text without white space (but what the tokenizer takes for signs)."""
        ids = self.older.get(chunk)
        if ids is None:
            if chunk.isalpha():
                ids = self.word(chunk)
            else:
                words = self.words.findall(chunk)
                ids = self.word(chunk) if len(words) < 2 else [i for w in words for i in self[w]]
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        if len(chunk) <= 256:
            self[chunk] = ids
        return ids

    def word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return merged(parts, self.merges) if len(parts) <= LONG else merged_long(parts, self.merges)

    def encode(self, text: str) -> list[int]:
        if self.at_special is None or "<|" not in text:
            return self.plain(text)
        ids: list[int] = []
        start = 0
        for found in self.at_special.finditer(text):
            ids += [*self.plain(text[start : found.start()]), self.special[found.group()]]
            start = found.end()
        return ids + self.plain(text[start:])

    def plain(self, text: str) -> list[int]:
        text = lower(unicodedata.normalize("NFC", text))
        chunks = text.split() if not SEPARATORS.search(text) else self.words.findall(text)
        return list(chain.from_iterable(map(self.__getitem__, chunks)))

    def decode(self, ids: list[int]) -> str:
        try:
            return " ".join(map(self.tokens.__getitem__, ids))
        except KeyError:  # ids the vocabulary doesn't have are left out
            return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def lower(text: str) -> str:
    """Lower case of each character for itself: a sigma ends no word."""
    return text.replace("Σ", "σ").lower() if "Σ" in text else text.lower()


def merged(parts: list[int], merges: dict[int, int]) -> list[int]:
    """Scan the rank array for its minimum, merge there, look up the ranks beside it."""
    get = merges.get
    ranks = [get(a << 20 | b, NONE) for a, b in zip(parts, parts[1:])]
    while ranks and (best := min(ranks)) != NONE:
        at = ranks.index(best)
        parts[at] = new = best & 0xFFFFF
        del parts[at + 1], ranks[at]
        if at:
            ranks[at - 1] = get(parts[at - 1] << 20 | new, NONE)
        if at < len(ranks):
            ranks[at] = get(new << 20 | parts[at + 1], NONE)
    return parts


def merged_long(parts: list[int], merges: dict[int, int]) -> list[int]:
    """The same merges, the next one from a heap; places are linked instead of moved."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(left: int) -> None:
        if left >= 0 and after[left] < n:
            pair = parts[left] << 20 | parts[after[left]]
            if pair in merges:
                heapq.heappush(heap, (merges[pair], left, pair))

    for k in range(n):
        offer(k)
    while heap:
        best, at, pair = heapq.heappop(heap)
        right = after[at]
        if not alive[at] or right >= n or parts[at] << 20 | parts[right] != pair:
            continue
        parts[at] = best & 0xFFFFF
        alive[right] = False
        after[at] = after[right]
        if after[at] < n:
            before[after[at]] = at
        offer(before[at])
        offer(at)
    return [p for p, keep in zip(parts, alive) if keep]


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row: the ids of its text and the text they decode to.

    ``path`` names the vocabulary on the executors.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        ids = [words.encode(t) if t else [] for t in batch.column(1).to_pylist()]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
        arrays = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.record_batch([batch.column(0), arrays, pa.array(map(words.decode, ids), pa.string())], ["id", "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return by_batch(df.select(id_col, text_col), run, f"id {kind}, ids array<int>, decoded string", 1 << 20)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids of the word vocabulary over all documents and the text they decode to, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    coded = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
