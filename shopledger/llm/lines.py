"""Line dedup by an exact set-similarity join.

A line is the set of its words. A line is removed if an earlier line (of a smaller document id, or higher up in the
same document) has a similar set: Jaccard ``THRESHOLD`` or more. Lines without a word stay.

1. Equal sets are one row: their first line stands for them.
2. Words are ordered by rarity (counts in ``1 << RARITY_BITS`` hash buckets, a table of fixed size, then the hash).
   Similar sets share a word among the first ones of that order (prefix filter), their sizes are near each other
   (length filter), and the places of the shared word leave room for enough common words (positional filter). Postings
   of the prefix words meet by word. A 64-bit parity signature per line, of which two similar lines differ in few bits,
   drops pairs that cannot be similar before any word is compared.
3. Lines with a surviving partner get their words, meet again by prefix word, and the Jaccard index is verified. Only
   whether a line has an earlier match matters, so a line leaves at its first one.

Postings travel as packed arrays, one row per task and part of the word hashes. They are counted before (in
``1 << RARITY_BITS`` buckets of their keys): those of a bucket with more than ``HOT`` are dealt to blocks of about so many
that meet two by two. A component of candidates is dealt to blocks of ``BLOCK`` lines likewise. Pairs are formed in numpy
inside a task, never as rows. N lines of one word are still about N**2 / 2 comparisons, now in many tasks, and each is
sent N / ``HOT`` times.

Rows equal in id and text are one document; of rows with one id the text's hash gives the order. Null ids come first.
Nulls and empty texts have no line to remove and keep their text. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, fresh, slices, stored, table
from shopledger.llm.graph import components

#: Similarity as a fraction, sizes below which only equal sets are similar.
TOP, BOTTOM, SMALL = 4, 5, 4
#: Hash buckets of the word counts (as bits), and the count from which a word is paired with another one in the keys.
RARITY_BITS, COMMON = 18, 1 << 15
#: Words from which a line's signature has 128 bits instead of 64; postings a task packs at once; pairs it keeps; lines of a block.
WIDE, PACKED, PAIRS, BLOCK = 64, 1 << 17, 1 << 19, 2048
#: Sets whose postings meet in one task, on average.
PART = 30_000
#: Postings of one bucket of keys that meet in one task.
HOT = 1 << 13
#: Bytes of text taken at once: their arrays stay in a core's cache.
SLICE = 1 << 18
U = np.uint64
BASE = 0x9E3779B97F4A7C15
#: The first 0 to 8 bytes of a number; bytes of a word beyond which it is hashed for itself.
FIRST, LONG = np.array([(1 << 8 * k) - 1 for k in range(9)], U), 64
POSTING = np.dtype([("key", "<u4"), ("place", "<u4"), ("size", "<u4"), ("line", "<i8"), ("low", "<u8"), ("high", "<u8")])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(32))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def words_of(texts: list[str], fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and line number of every word, and each text's first line number (and the number of lines).

    Words are hashed by eight bytes at once: what is kept per byte of text is a few bytes, not several numbers.
    """
    from xxhash import xxh3_64_intdigest

    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    parts = [p.lower() for p in parts] if fold else parts
    whole = b"\n".join(parts)
    data = np.frombuffer(whole, np.uint8)
    first = np.cumsum([0, *(p.count(b"\n") + 1 for p in parts)])
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = (data - np.uint8(9) < 5) | (data == 32)
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    eight = np.ndarray(len(whole) + 1, "<u8", whole + bytes(8), strides=(1,))
    hashes = mixed((eight[starts] & FIRST[np.minimum(size, 8)]) + size.astype(U) * U(BASE))
    go, at = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(go):
        more = eight[starts[go] + at] & FIRST[np.minimum(size[go] - at, 8)]
        hashes[go] = mixed((hashes[go] ^ more) * U(3) + U(1))
        at += 8
        go = go[size[go] > at]
    for k in np.flatnonzero(size > LONG).tolist():
        hashes[k] = xxh3_64_intdigest(whole[starts[k] : ends[k]])
    breaks = np.searchsorted(starts, np.flatnonzero(data == 10))
    return hashes, np.repeat(np.arange(len(breaks) + 1), np.diff(breaks, prepend=0, append=len(starts))), first


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def rarity(df: DataFrame, text_col: str, hashes_of: Callable[[list[str]], np.ndarray] = lambda texts: words_of(texts)[0]) -> np.ndarray:
    """Rarity class of each hash bucket: sixteen times the binary logarithm of its words' count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        held: list[np.ndarray] = []

        def add() -> None:
            counts[:] += np.bincount(np.concatenate(held), minlength=len(counts))
            held.clear()

        for batch in batches:
            for part in slices(batch, SLICE):
                hashes = hashes_of([t for t in part.column(0).to_pylist() if t] or [""])
                held.append((hashes >> U(64 - RARITY_BITS)).astype(np.int32))
                if sum(map(len, held)) >= len(counts):  # a table's worth of words at once
                    add()
        if held:
            add()
        yield from table_parts(counts)

    return class_of(summed_counts(df.select(text_col).mapInArrow(count, "part int, counts binary"))).astype(np.uint16)


def table_parts(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's counts in sixteen rows."""
    yield pa.record_batch([pa.array(range(16), pa.int32()), pa.array([p.tobytes() for p in np.split(counts, 16)])], ["part", "counts"])


def summed_counts(tables: DataFrame) -> np.ndarray:
    """The sum of all tasks' counts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "counts"])

    rows = tables.repartition(16, "part").mapInArrow(add, "part int, counts binary").collect()  # 2**RARITY_BITS counts
    counts = np.zeros((16, (1 << RARITY_BITS) // 16), np.int64)
    for r in rows:
        counts[r.part] += np.frombuffer(r.counts, np.int64)
    return counts.reshape(-1)


def class_of(count):
    return np.floor(16 * np.log2(1 + count))


def line_sets(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each line with a word, rarest first: (words, line numbers, sizes, first line of each text)."""
    hashes, line, first = words_of(texts)
    return *distinct_words(hashes, line, classes), first


def distinct_words(hashes: np.ndarray, line: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each line with a word, rarest first: (words, line numbers, sizes). Lines ascend."""
    rare = classes[(hashes >> U(64 - RARITY_BITS)).astype(np.int64)].astype(U)
    word = rare << U(52) | hashes & U((1 << 52) - 1)
    if len(line) and line[-1] < 1 << 20:
        key = line.astype(U) << U(44) | word >> U(20)
        order = np.argsort(key)
        key = key[order]
        if ((key[1:] == key[:-1]) & (word[order[1:]] != word[order[:-1]])).any():  # words that differ in their last bits only
            order = np.lexsort((word, line))
    else:
        order = np.lexsort((word, line))
    word, line = word[order], line[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (line[1:] != line[:-1])
    word, line = word[new], line[new]
    number, sizes = np.unique(line, return_counts=True)
    return word, number, sizes


def prefix(size: np.ndarray) -> np.ndarray:
    """Words of which similar sets share one."""
    return size - -(-TOP * size // BOTTOM) + 1


def keys_of(word: np.ndarray, starts: np.ndarray, sizes: np.ndarray, common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, place) of the prefix words of each set; common words are keys only together with the next shared one."""
    counted = np.where(sizes >= SMALL, prefix(sizes), 0)
    at = ragged(starts, counted)
    row, place = np.repeat(np.arange(len(sizes)), counted), at - np.repeat(starts, counted)
    single = word[at] >> U(52) < U(common)
    key = mixed(word[at][single])
    row, place, mixed_rows = row[single], place[single], np.unique(row[~single])
    more: list[tuple[int, int, int]] = []
    for r in mixed_rows.tolist():
        held = word[starts[r] : starts[r] + min(counted[r] + 1, sizes[r])]
        often = np.flatnonzero(held >> U(52) >= U(common))
        hashes = mixed(held)
        more += [(r, int(hashes[i] * U(3) + hashes[j] & U(0xFFFFFFFFFFFFFFFF)), int(i)) for i, j in combinations(often, 2)]
    if more:
        r, k, p = (np.array(x, U) for x in zip(*more))
        row, key, place = np.r_[row, r.astype(np.int64)], np.r_[key, mixed(k)], np.r_[place, p.astype(np.int64)]
        order = np.argsort(row, kind="stable")
        row, key, place = row[order], key[order], place[order]
    return row, (key >> U(32)).astype(np.uint32), place.astype(np.uint32)


def parity(word: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """For each set and bit, whether an odd number of its words have that bit (one column of 64 bits each)."""
    at = mixed(word + U(1))
    out = np.zeros((len(sizes), bits // 64), U)
    bit = U(1) << (at >> U(58))
    for k in range(bits // 64 if len(starts) else 0):
        own = bit if bits == 64 else np.where(at % U(bits // 64) == U(k), bit, U(0))
        out[:, k] = np.bitwise_xor.reduceat(own, starts)
    return out


def names(word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    h = mixed(word)
    return np.add.reduceat(h, starts), np.add.reduceat(mixed(h + U(1)), starts)


def signs(word: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The halves of each set's signature."""
    low, high = parity(word, starts, sizes, 64)[:, 0], np.zeros(len(sizes), U)
    long = np.flatnonzero(sizes >= WIDE)
    if len(long):
        ends = np.cumsum(sizes[long])
        wide = parity(word[ragged(starts[long], sizes[long])], ends - sizes[long], sizes[long], 128)
        low[long], high[long] = wide[:, 0], wide[:, 1]
    return low, high


def packed_list(ends: np.ndarray, values: np.ndarray, width: int) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(values.tobytes())])


def described(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """(id, hash, line, h1, h2, size, low, high, keys, places) of every line with a word."""
    common = int(class_of(COMMON))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        word, number, sizes, first = line_sets(batch.column(2).to_pylist(), classes)
        if not len(number):
            return None
        starts = np.cumsum(sizes) - sizes
        doc = np.searchsorted(first, number, side="right") - 1
        h1, h2 = names(word, starts)
        low, high = signs(word, starts, sizes)
        row, key, place = keys_of(word, starts, sizes, common)
        ends = np.searchsorted(row, np.arange(len(sizes) + 1)).astype(np.int32)
        take = pa.array(doc)
        return pa.record_batch(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array((number - first[doc]).astype(np.int32)),
             pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(sizes.astype(np.int32)),
             pa.array(low.view(np.int64)), pa.array(high.view(np.int64)),
             packed_list(ends, key, 4), packed_list(ends, place, 4)],
            ["id", "hash", "line", "h1", "h2", "size", "low", "high", "keys", "places"],
        )

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, hash long, line int, h1 long, h2 long, size int, low long, high long, keys binary, places binary"
    return by_batch(docs.select("id", "hash", "text"), run, schema, SLICE)


def linked(p: np.ndarray, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (as a spanning forest of line numbers) among postings, by the three filters and the signatures.

    side: the block of each posting if two blocks meet (only pairs of both count).
    """
    order = np.argsort(p["key"].astype(U) << U(32) | p["size"])
    key, line, low, high = (p[name][order] for name in ("key", "line", "low", "high"))
    size, place = p["size"][order].astype(np.int32), p["place"][order].astype(np.int32)
    side = None if side is None else side[order]
    narrow = low ^ high  # the halves of a long signature make a short one
    rows = np.flatnonzero(key[1:] == key[:-1])
    held: list[tuple[np.ndarray, np.ndarray]] = []
    step = 0
    while len(rows):
        step += 1
        rows = rows[rows + step < len(p)]
        other = rows + step
        a, b = size[rows], size[other]
        # sizes ascend within a key: a row whose partner is too long has no further one
        near = (key[rows] == key[other]) & (TOP * b <= BOTTOM * a)
        rows, other, a, b = rows[near], other[near], a[near], b[near]
        overlap = -(-TOP * (a + b) // (TOP + BOTTOM))
        good = np.minimum(a - place[rows], b - place[other]) >= overlap
        if side is not None:
            good &= side[rows] != side[other]
        # signatures of those only whose places leave room
        x, y, a, b, overlap = rows[good], other[good], a[good], b[good], overlap[good]
        differ = np.bitwise_count(narrow[x] ^ narrow[y]).astype(np.int32)
        wide = np.flatnonzero((a >= WIDE) & (b >= WIDE))
        if len(wide):
            u, v = x[wide], y[wide]
            differ[wide] = np.bitwise_count(low[u] ^ low[v]).astype(np.int32) + np.bitwise_count(high[u] ^ high[v])
        x, y = line[x], line[y]
        good = (differ <= a + b - 2 * overlap) & (x != y)
        held.append((x[good], y[good]))
        if sum(len(a) for a, _ in held) > PAIRS:
            held = [spanning(held)]
    return spanning(held)


def spanning(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep the same lines together: each line with the first of its component."""
    from shopledger.llm.simhash import forest

    if not held:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
    lines, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = forest(inverse[: len(a)], inverse[len(a) :], len(lines))
    bound = np.flatnonzero(root != np.arange(len(lines)))
    return lines[bound], lines[root[bound]]


def postings_of(batch: pa.RecordBatch) -> np.ndarray:
    columns = {n: batch.column(n) for n in batch.schema.names}
    keys, places = columns["keys"].to_pylist(), columns["places"].to_pylist()
    counts = np.array([len(k) // 4 for k in keys], np.int64)
    p = np.zeros(counts.sum(), POSTING)
    p["key"], p["place"] = np.frombuffer(b"".join(keys), "<u4"), np.frombuffer(b"".join(places), "<u4")
    for name, column in (("size", "size"), ("line", "h1"), ("low", "low"), ("high", "high")):
        p[name] = np.repeat(columns[column].to_numpy().astype(np.int64).view(U if name in ("low", "high") else np.int64), counts)
    return p


def bucket(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint32(32 - RARITY_BITS)).astype(np.int64)


def block_of(line: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    return (mixed(line.view(U) + U(2)) % blocks.astype(U)).astype(np.int64)


class Deal:
    """Where postings go: the part of their key or, of a hot bucket, every part in which their block meets another."""

    def __init__(self, counts: np.ndarray, parts: int, hot: int):
        self.parts = parts
        self.hot = np.flatnonzero(counts > hot + 2 * counts.mean())  # not those that are as full as any
        self.blocks = -(-counts[self.hot] // hot)
        self.first = parts + np.cumsum(self.blocks**2) - self.blocks**2  # parts of block i and j of a bucket: first + i * blocks + j
        # tasks for the parts and for the pairs of blocks, half of which are in use; not without end for one hot bucket
        self.tasks = parts + min(int((self.blocks * (self.blocks + 1) // 2).sum()), 8 * parts)

    def parts_of(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) of the postings, a row for each part."""
        part = (p["key"] % np.uint32(self.parts)).astype(np.int64)
        if not len(self.hot):
            return np.arange(len(p)), part
        at = np.minimum(np.searchsorted(self.hot, bucket(p["key"])), len(self.hot) - 1)
        crowded = self.hot[at] == bucket(p["key"])
        rows, at = np.flatnonzero(crowded), at[crowded]
        blocks = self.blocks[at]
        own = np.repeat(block_of(p["line"][rows], blocks), blocks)
        other = ragged(np.zeros(len(rows), np.int64), blocks)
        spread = np.repeat(self.first[at], blocks) + np.minimum(own, other) * np.repeat(blocks, blocks) + np.maximum(own, other)
        alone = np.flatnonzero(~crowded)
        return np.r_[alone, np.repeat(rows, blocks)], np.r_[part[alone], spread]

    def side(self, p: np.ndarray, part: int) -> np.ndarray | None:
        """The block of each posting if two meet in the part."""
        if part < self.parts:
            return None
        at = int(np.searchsorted(self.first, part, side="right")) - 1
        i, j = divmod(part - int(self.first[at]), int(self.blocks[at]))
        return None if i == j else block_of(np.ascontiguousarray(p["line"]), np.full(len(p), self.blocks[at]))


def posting_counts(sets: DataFrame) -> np.ndarray:
    """Postings in each bucket of keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            counts += np.bincount(bucket(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")), minlength=len(counts))
        yield from table_parts(counts)

    return summed_counts(sets.select("keys").mapInArrow(count, "part int, counts binary"))


def dealt(sets: DataFrame, deal: Deal) -> DataFrame:
    """(part, postings): packed postings of sets by the part in which they meet."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            p = np.concatenate(held)
            row, part = deal.parts_of(p)
            # short numbers are sorted by their digits
            order = np.argsort(part.astype(np.uint16) if part.max() < 1 << 16 else part, kind="stable")
            row, part = row[order], part[order]
            cut = np.flatnonzero(np.diff(part)) + 1
            numbers = part[np.r_[0, cut]]
            return pa.record_batch([pa.array(numbers, pa.int64()), pa.array([p[r].tobytes() for r in np.split(row, cut)], pa.binary())], ["part", "postings"])

        for batch in batches:
            held.append(postings_of(batch))
            if sum(map(len, held)) >= PACKED:
                yield out()
                held = []
        if sum(map(len, held)):
            yield out()

    return sets.select("h1", "size", "low", "high", "keys", "places").mapInArrow(pack, "part long, postings binary")


def candidate_links(sets: DataFrame, parts: int) -> DataFrame:
    """(a, b): links of sets (named by h1) that join all candidate pairs."""
    sets = sets.where(f"size >= {SMALL}")
    deal = Deal(posting_counts(sets), parts, HOT)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bytes]] = {}
        last = None
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns)):
                if part != last and last is not None:
                    yield links(last, found.pop(last))
                last = part
                found.setdefault(part, []).append(data)
        if last is not None:
            yield links(last, found.pop(last))

    def links(part: int, data: list[bytes]) -> pa.RecordBatch:
        p = np.frombuffer(b"".join(data), POSTING)
        a, b = linked(p, deal.side(p, part))
        return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt(sets, deal).repartition(deal.tasks, "part").sortWithinPartitions("part").mapInArrow(reduce, "a long, b long")


def earlier_matches(found: list[tuple], classes: int = 256) -> list[int]:
    """Rows of (set number, sorted words), in the order of their first lines, that have a similar row before them."""
    words = [np.frombuffer(w, U) for _, w in found]
    size = np.array([len(w) for w in words])
    flat = np.concatenate(words)
    starts = np.cumsum(size) - size
    sign = parity(flat, starts, size, classes)
    known, local = np.unique(flat, return_inverse=True)
    pairs = np.repeat(np.arange(len(words)), size) * len(known) + local
    pairs.sort()
    open_, out = np.arange(1, len(words)), []
    step = 0
    while len(open_):
        step += 1
        open_ = open_[open_ >= step]
        other = open_ - step
        a, b = size[open_], size[other]
        overlap = -(-TOP * (a + b) // (TOP + BOTTOM))
        may = (np.minimum(a, b) >= overlap) & (np.bitwise_count(sign[open_] ^ sign[other]).sum(axis=1) <= a + b - 2 * overlap)
        x, y = open_[may], other[may]
        if len(x):
            asked = np.repeat(y, size[x]) * len(known) + local[ragged(starts[x], size[x])]
            place = np.minimum(np.searchsorted(pairs, asked), len(pairs) - 1)
            common = np.bincount(np.repeat(np.arange(len(x)), size[x]), pairs[place] == asked, len(x))
            hit = x[common >= overlap[may]]
            out += hit.tolist()
            open_ = np.setdiff1d(open_, hit, assume_unique=True)
    return out


def verified(lines: DataFrame) -> DataFrame:
    """(h1, h2) of the sets with an earlier similar one, from rows (group, id, hash, line, h1, h2, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None
        for batch in batches:
            for g, h1, h2, words in zip(*(c.to_pylist() for c in batch.columns)):
                if g != group and held:
                    yield out(held)
                    held = []
                group = g
                held.append(((h1, h2), words))
        if held:
            yield out(held)

    def out(held: list[tuple]) -> pa.RecordBatch:
        held = list(dict(held).items())  # a repeated document gives its sets again
        found = [held[k][0] for k in earlier_matches(held)] if len(held) > 1 else []
        return pa.record_batch([pa.array([h for h, _ in found], pa.int64()), pa.array([h for _, h in found], pa.int64())], ["h1", "h2"])

    spread = lines.select("group", "id", "hash", "line", "h1", "h2", "words").repartition("group").sortWithinPartitions("group", F.asc_nulls_first("id"), "hash", "line")
    return spread.select("group", "h1", "h2", "words").mapInArrow(run, "h1 long, h2 long").distinct()


def sets_of(docs: DataFrame, wanted: DataFrame, classes: np.ndarray) -> DataFrame:
    """``wanted`` (id, hash, line, root, blocks, h1, h2) with the words of each line as bytes."""
    parts = wanted.groupBy("id", "hash").agg(F.collect_list(F.struct("line", "root", "blocks", "h1", "h2")).alias("wanted"))
    texts = docs.join(parts, docs.id.eqNullSafe(parts.id) & (docs.hash == parts.hash)).select(docs.id, docs.hash, "text", "wanted")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for id_, hash_, text, wanted_ in zip(*(c.to_pylist() for c in batch.columns)):
            found = text.split("\n")
            rows += [(id_, hash_, r["line"], r["root"], r["blocks"], r["h1"], r["h2"], found[r["line"]]) for r in wanted_]
        word, number, sizes, _ = line_sets([r[-1] for r in rows], classes)
        pieces = [w.tobytes() for w in np.split(word, np.cumsum(sizes)[:-1])]
        columns = list(zip(*rows))[:-1]
        arrays = [pa.array(c, t) for c, t in zip(columns, [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])]
        return pa.record_batch([*arrays, pa.array(pieces, pa.binary())], ["id", "hash", "line", "root", "blocks", "h1", "h2", "words"])

    kind = docs.schema["id"].dataType.simpleString()
    return by_batch(texts, run, f"id {kind}, hash long, line int, root long, blocks int, h1 long, h2 long, words binary", 1 << 20)


def removed_lines(docs: DataFrame) -> DataFrame:
    """(id, hash, lines): the numbers of the lines that go, of each document (id, hash, text) that loses any."""
    texts = docs.where(F.length("text") > 0)
    classes = rarity(texts, "text")
    lines = stored(described(texts, classes), "lines")
    at = F.struct("id", "hash", "line")
    sets = stored(
        lines.groupBy("h1", "h2").agg(F.min(at).alias("at"), F.max(at).alias("last"), F.first(F.struct("size", "low", "high", "keys", "places")).alias("set"))
        .select("h1", "h2", "at", (F.col("at") != F.col("last")).alias("copied"), "set.*"),
        "line-sets",
    )
    parts = max(16, -(-sets.count() // PART))
    links = components(candidate_links(sets, parts))
    members = stored(links.unionByName(links.select(F.col("root").alias("node"), "root")).distinct(), "members")
    crowds = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    wanted = sets.join(members.join(crowds, "root"), sets.h1 == F.col("node")).select("at.*", "root", "blocks", "h1", "h2")
    words = sets_of(texts, wanted, classes)
    own = F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int")
    # a component of one block is a group; of more, every two blocks are
    met = words.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).where("own != other or blocks = 1")
    similar = verified(met.withColumn("group", F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other"))))
    similar = similar.select("h1", "h2", F.lit(True).alias("similar"))
    # of a set that goes, all lines; of a set with copies, all but the first
    decided = stored(sets.join(similar, ["h1", "h2"], "left").where("copied or similar").select("h1", "h2", "at", F.coalesce("similar", F.lit(False)).alias("similar")), "decided")
    gone = lines.select("id", "hash", "line", "h1", "h2").join(decided, ["h1", "h2"]).where(F.col("similar") | ~(at.eqNullSafe(F.col("at"))))
    return gone.groupBy("id", "hash").agg(F.collect_set("line").alias("lines"))


def without_similar_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``df``, the text without the lines that have an earlier similar one, and ``lines_removed``."""
    df = df.drop("lines_removed")
    own, other, of, numbers = fresh(df, "own_hash", "other_id", "other_hash", "line_numbers")
    named = df.withColumn(own, F.xxhash64(text_col))
    docs = named.select(F.col(id_col).alias("id"), F.col(own).alias("hash"), F.col(text_col).alias("text"))
    gone = removed_lines(docs).select(F.col("id").alias(other), F.col("hash").alias(of), F.col("lines").alias(numbers))
    joined = named.join(gone, F.col(id_col).eqNullSafe(F.col(other)) & (F.col(own) == F.col(of)), "left")
    # the numbers that stay, by a hash set, and their lines; the array of one makes one name for the lines
    kept = F.expr(
        f"transform(array(split(`{text_col}`, '\\n', -1)), x -> "
        f"array_join(transform(array_except(sequence(0, size(x) - 1), {numbers}), i -> get(x, i)), '\\n'))[0]"
    )
    count = F.when(F.col(numbers).isNull(), 0).otherwise(F.size(numbers)).cast("long")
    return joined.select(
        *(F.when(F.col(numbers).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_col else F.col(c) for c in df.columns),
        count.alias("lines_removed"),
    )


def op6_lines(spark, sf_dir: str) -> DataFrame:
    """What every document keeps without lines similar to an earlier one."""
    docs = table(spark, sf_dir, "documents")
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split(F.col("text"), "\n", -1))).cast("long")
    found = without_similar_lines(docs.select("doc_id", "text").withColumn("n_lines", lines))
    return found.select("doc_id", "n_lines", F.col("lines_removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
