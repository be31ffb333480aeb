"""Removal of repeated byte strings by suffix arrays.

Every string of ``LENGTH`` bytes has an anchor: the place in it whose ``GRAM`` bytes have the smallest hash. Equal
strings have their anchors at the same place, so all occurrences of a string lie in the regions (all strings that have
the same anchor) of anchors with one hash. Anchors whose hash occurs once need no work. Regions of equal content
are one row; if the content occurs twice, all of it is repeated. What remains are anchors with regions that differ:

* a shard holds whole anchors up to ``SHARD`` bytes; strings whose hash no other string of the anchor has are cut off,
  and the rest's suffix array is built by Larsson-Sadakane refinement in numpy (ranks double their depth, only groups not
  yet apart are sorted again), and neighbours' common prefixes by Kasai's walk, for all regions of the shard at once;
* an anchor with more bytes than a shard is dealt to ``MEET`` at most, which meet two by two: the suffixes of one are
  found in the array of the other by binary search;
* the regions of an anchor with still more bytes are cut into pieces, by the distance of a string's start from the
  anchor: ``WIDTHS`` distances, fewer each time. All strings of a piece have its core in common, so equal strings lie in
  pieces of one core at one distance, and the pieces are to these cores what the regions are to the anchors. A piece of
  one distance is its core. So the work grows with the regions, not with the square of those that share an anchor.

The places where repeated strings start are carried back to all occurrences of their region, and each document's
covered bytes are removed. The same place of a document in two regions is one occurrence.

Nulls and empty texts have no bytes; shorter texts than ``LENGTH`` lose none. Repeated rows are documents of their own,
so all of a repeated row of that length goes. Empty tables give no rows. Columns other than the id and the text are not
read; rows are told apart by their place in the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, placed, stored, table

#: Bytes of a repeated string, of an anchor's gram, and of the regions a shard's suffix array is built over.
LENGTH, GRAM, SHARD = 400, 32, 1 << 18
REACH = LENGTH - GRAM
#: Shards of an anchor that meet at most, and the distances of a piece where an anchor has more.
MEET, WIDTHS = 2, (48, 6, 1)
U = np.uint64
MULTIPLIERS = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)]
BYTE_HASH = np.random.default_rng(400).integers(0, 1 << 64, 256, dtype=U)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, built by doubling."""
    h, size = BYTE_HASH[data], 1
    for m in MULTIPLIERS:
        h = h[:-size] * m + h[size:]
        size *= 2
    h ^= h >> U(31)
    h *= U(0xFF51AFD7ED558CCD)
    return h ^ (h >> U(29))


def string_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the LENGTH bytes from each place on, put together from parts of 1, 2, 4, ... bytes."""
    n = max(len(data) - LENGTH + 1, 0)
    h, size, at, out = BYTE_HASH[data], 1, 0, np.zeros(n, U)
    while n:
        m = MULTIPLIERS[size.bit_length() % len(MULTIPLIERS)]
        if LENGTH & size:
            out = out * m + h[at : at + n]
            at += size
        if 2 * size > LENGTH:
            break
        h = h[:-size] * m + h[size:]
        h ^= h >> U(31)
        size *= 2
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchors of documents that lie one after the other, ending at ``ends``, and where the first and the
    last string start that have each for their anchor."""
    if len(data) < LENGTH:
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)
    h = gram_hashes(data)
    least = sliding_min((h >> U(32) << U(32)) | np.arange(len(h), dtype=U), REACH + 1)
    sizes = np.diff(ends, prepend=0)
    within = np.ones(len(data), bool)
    for end, size in zip(ends[sizes > 0], sizes[sizes > 0]):  # strings that would pass a document's end
        within[max(end - size, end - LENGTH + 1) : end] = False
    starts = np.flatnonzero(within[: len(least)])
    places = (least[starts] & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    last = np.append(first[1:], len(starts)) - 1
    return h[places[first]], starts[first], starts[last]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(file, row, hash, begin, size, region): every anchor, its region in the document and the region's hash."""
    from xxhash import xxh3_64_intdigest

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        whole = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        hashes, begin, last = anchors(np.frombuffer(whole, np.uint8), ends)
        end = last + LENGTH
        doc = np.searchsorted(ends, begin, side="right")
        first = (ends - [len(t) for t in texts])[doc] if len(doc) else np.empty(0, np.int64)
        view = memoryview(whole)
        region = np.fromiter((xxh3_64_intdigest(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())), U, len(begin))
        return pa.record_batch(
            [batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)), pa.array(hashes.view(np.int64)),
             pa.array(begin - first), pa.array((end - begin).astype(np.int32)), pa.array(region.view(np.int64))],
            ["file", "row", "hash", "begin", "size", "region"],
        )

    schema = "file long, row long, hash long, begin long, size int, region long"
    return by_batch(docs.select("file", "row", "text"), run, schema, 1 << 20)


def pieces(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Cuts regions that lie one after the other, ending at ``ends``: the region of each piece, where the piece and its
    core begin and end, and its block of ``width`` distances between a string's start and the anchor."""
    starts = np.append(0, ends[:-1])
    h = gram_hashes(data)
    least = np.append(h >> U(32) << U(32) | np.arange(len(h), dtype=U), U(0))
    bounds = np.stack([starts, ends - GRAM + 1], 1).ravel()
    anchor = (np.minimum.reduceat(least, bounds)[::2] & U(0xFFFFFFFF)).astype(np.int64)
    far, near = anchor - starts, anchor - (ends - LENGTH)  # distances of the first and of the last string
    count = far // width - near // width + 1
    of = np.repeat(np.arange(len(ends)), count)
    block = np.arange(len(of)) - np.repeat(np.cumsum(count) - count - near // width, count)
    core = anchor[of] - block * width
    begin = np.maximum(starts[of], core - width + 1)
    end = np.minimum(ends[of], core + LENGTH)
    return of, begin, end, core, core + LENGTH - width + 1, block


def piece_rows(regions: DataFrame, width: int) -> DataFrame:
    """(file, row, hash, begin, size, region, n): the pieces of regions (file, row, text, n), with the hash of the core
    in the anchor's place."""
    from xxhash import xxh3_64_intdigest

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).to_pylist()
        whole = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        of, begin, end, core, core_end, block = pieces(np.frombuffer(whole, np.uint8), ends, width)
        view = memoryview(whole)
        cores = (xxh3_64_intdigest(view[a:b], k) for a, b, k in zip(core.tolist(), core_end.tolist(), (block + 1).tolist()))
        hashes = np.fromiter(cores, U, len(of))
        region = np.fromiter((xxh3_64_intdigest(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())), U, len(of))
        first = np.append(0, ends[:-1])[of]
        file, row, n = (batch.column(k).take(pa.array(of)) for k in (0, 1, 3))
        return pa.record_batch(
            [file, row, pa.array(hashes.view(np.int64)), pa.array(begin - first), pa.array((end - begin).astype(np.int32)),
             pa.array(region.view(np.int64)), n],
            ["file", "row", "hash", "begin", "size", "region", "n"],
        )

    schema = "file long, row long, hash long, begin long, size int, region long, n long"
    return by_batch(regions.select("file", "row", "text", "n"), run, schema, 1 << 20)


def refined(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks; a suffix ends with its region (``ends`` per byte), equal ones keep the regions' order.

    Larsson-Sadakane: a rank is the place where its group starts; each round sorts the members of groups that still
    tie by the ranks of the suffixes further on, which here triples the depth (doubles it, if two ranks fill a key).
    """
    n = len(text)
    at = np.arange(n)
    key = np.zeros(n, U)
    signs = text.astype(U) + U(1)
    for k in range(7):
        key <<= U(9)
        key[: n - k] |= np.where(at[: n - k] + k < ends[: n - k], signs[k:], U(0))
    order = np.argsort(key)
    start = np.ones(n, bool)
    start[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, at, 0))
    size, depth = 7, int((ends - at).max()) if n else 0
    times = 3 if n < 1 << 21 else 2
    base = np.append(rank + 1, 0)  # the rank behind the end is 0
    while True:
        last = np.append(start[1:], True)
        open_ = np.flatnonzero(~(start & last))  # places in groups of two or more
        member = order[open_]
        group = rank[member]
        if size >= depth or not len(open_):
            break
        key = group
        for k in range(1, times):
            to = member + k * size
            key = key * (n + 1) + base[np.where(to < ends[member], to, n)]
        again = np.argsort(key)
        member, key, group = member[again], key[again], group[again]
        order[open_] = member
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        start[open_] = new
        rank[member] = np.maximum.accumulate(np.where(new, open_, 0))
        base[member] = rank[member] + 1
        size *= times
    order[open_] = member[np.argsort(group * n + member)]
    rank[order] = at
    return order, rank


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number, first byte highest; zeros behind the end."""
    padded = np.append(text, np.zeros(8, np.uint8)).astype(U)
    out = np.zeros(len(text) + 1, U)
    for k in range(8):
        out = out << U(8) | padded[k : k + len(out)]
    return out


def extended(words: np.ndarray, a: np.ndarray, b: np.ndarray, have: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Common prefix of the suffixes a and b, of which ``have`` is known, up to ``limit``."""
    out = np.minimum(have, limit)
    go = np.flatnonzero(out < limit)
    a, b, at, most = a[go], b[go], out[go], limit[go]
    while len(go):
        differ = words[a + at] ^ words[b + at]
        same = differ == 0
        at = at + 8
        if not same.all():
            some = ~same
            at[some] -= 1 + np.searchsorted(STEPS, differ[some], side="right")
        on = same & (at < most)
        if on.all():
            continue
        done = ~on
        out[go[done]] = np.minimum(at[done], most[done])
        go, a, b, at, most = go[on], a[on], b[on], at[on], most[on]
    return out


#: From 2**56 on a difference lies in the first byte, from 2**48 on in the second, ...
STEPS = np.array([1 << s for s in range(8, 64, 8)], U)


def kasai(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Common prefix (up to LENGTH) of each suffix of LENGTH bytes or more with the one before it in the array, by place
    in the text; 0 for shorter ones.

    Kasai's walk: behind a suffix with h bytes in common follows one with h - 1 at least. All regions walk at once.
    """
    sizes = np.maximum(sizes - LENGTH + 1, 0)
    words = words_of(text)
    out = np.zeros(len(text), np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size], sizes[by_size]
    have = np.zeros(len(starts), np.int64)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        k = int(np.searchsorted(-sizes, -step, side="left"))
        here = starts[:k] + step
        place = rank[here]
        before = order[np.maximum(place - 1, 0)]
        limit = np.where(place > 0, np.minimum(np.minimum(ends[here] - here, ends[before] - before), LENGTH), 0)
        out[here] = have[:k] = extended(words, here, before, np.maximum(have[:k] - 1, 0), limit)
    return out


class Shard:
    """Regions one after the other, their suffix array and common prefixes."""

    def __init__(self, regions: list[bytes], own: np.ndarray):
        """own: for each region a number that tells the document and the place of its first byte."""
        self.sizes = np.array([len(r) for r in regions], np.int64)
        self.text = np.frombuffer(b"".join(regions), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ends = np.repeat(self.starts + self.sizes, self.sizes)
        self.own = np.repeat(own - self.starts, self.sizes) + np.arange(len(self.text))
        self.order, self.rank = refined(self.text, self.ends)

    def repeated(self) -> np.ndarray:
        """True at places where a string of LENGTH bytes starts that another place of the shard has too."""
        common = kasai(self.text, self.starts, self.sizes, self.ends, self.order, self.rank)
        tied = common[self.order] >= LENGTH
        group = np.cumsum(~tied)
        own = self.own[self.order]
        new = np.flatnonzero(np.diff(group, prepend=-1))
        apart = np.minimum.reduceat(own, new) != np.maximum.reduceat(own, new) if len(new) else np.empty(0, bool)
        out = np.zeros(len(self.text), bool)
        out[self.order] = np.repeat(apart, np.diff(np.append(new, len(group))))
        return out & (self.ends - np.arange(len(self.text)) >= LENGTH)

    def found_in(self, other: Shard) -> np.ndarray:
        """True at places whose LENGTH bytes start somewhere else in ``other``: a binary search in its array."""
        at = np.flatnonzero(self.ends - np.arange(len(self.text)) >= LENGTH)
        words = words_of(np.concatenate([self.text, other.text]))
        shift = len(self.text)
        n = len(other.order)
        low, high = np.zeros(len(at), np.int64), np.full(len(at), n)
        while (low < high).any():  # the first suffix of the other shard that isn't smaller
            mid = np.minimum((low + high) // 2, n - 1)
            smaller = self._smaller(other, words, shift, at, other.order[mid])
            open_ = low < high
            low = np.where(open_ & smaller, mid + 1, low)
            high = np.where(open_ & ~smaller, mid, high)
        found = np.zeros(len(at), bool)
        go = np.flatnonzero(low < n)
        place = low.copy()
        while len(go):  # equal strings follow each other; one at another place than the own is enough
            suffix = other.order[place[go]]
            limit = np.minimum(other.ends[suffix] - suffix, LENGTH)
            equal = extended(words, at[go], suffix + shift, np.zeros(len(go), np.int64), limit) >= LENGTH
            found[go] |= equal & (other.own[suffix] != self.own[at[go]])
            place[go] += 1
            go = go[equal & ~found[go] & (place[go] < n)]
        out = np.zeros(len(self.text), bool)
        out[at[found]] = True
        return out

    def _smaller(self, other: Shard, words: np.ndarray, shift: int, at: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        """Whether the suffix of the other shard is smaller than the LENGTH bytes at the own place."""
        limit = np.minimum(other.ends[suffix] - suffix, LENGTH)
        same = extended(words, at, suffix + shift, np.zeros(len(at), np.int64), limit)
        ended = same >= limit
        own, their = np.minimum(at + same, len(self.text) - 1), np.minimum(suffix + same, len(other.text) - 1)
        return np.where(ended, limit < LENGTH, other.text[their] < self.text[own])


def runs(starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings that start at the sorted places."""
    if not len(starts):
        return starts, starts
    first = np.flatnonzero(np.diff(starts, prepend=-length - 2) > length)
    return starts[first], np.append(starts[first[1:] - 1], starts[-1]) + length


def pruned(rows: list[tuple]) -> list[tuple]:
    """Rows (shard, ..., begin, bytes), cut to the bytes from the first to the last string whose hash comes twice in the
    shard, with the place where the cut begins in the region; rows without one go."""
    count = np.array([max(len(r[-1]) - LENGTH + 1, 0) for r in rows], np.int64)
    sizes = np.array([len(r[-1]) for r in rows], np.int64)
    stop = np.cumsum(count)
    at = np.repeat(np.cumsum(sizes) - sizes - stop + count, count) + np.arange(count.sum())
    h = string_hashes(np.frombuffer(b"".join(r[-1] for r in rows), np.uint8))[at]
    h ^= np.repeat(np.array([r[0] for r in rows], np.int64).view(U), count)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    found = np.flatnonzero(twice)
    row, first = np.unique(np.searchsorted(stop, found, side="right"), return_index=True)
    last = found[np.append(first[1:], len(found))[: len(row)] - 1] + LENGTH
    out = []
    for k, a, b in zip(row.tolist(), (found[first] - (stop - count)[row]).tolist(), (last - (stop - count)[row]).tolist()):
        *head, begin, data = rows[k]
        out.append((*head, begin + a, data[a:b], a))
    return out


def searched(rows: DataFrame) -> DataFrame:
    """(hash, region, starts, stops): covered runs of each region, from rows (shard, side, hash, region, own, bytes)."""

    def solve(found: list[tuple]) -> pa.RecordBatch:
        """found: whole groups, each of one shard alone (side 2) or of two that meet (sides 0 and 1)."""
        out: list[tuple] = []

        def emit(part: list[tuple], shard: Shard, flags: np.ndarray) -> None:
            for row, start, size in zip(part, shard.starts, shard.sizes):
                a, b = runs(np.flatnonzero(flags[start : start + size]))
                if len(a):
                    out.append((row[2], row[3], a + row[7], b + row[7]))

        def shard_of(part: list[tuple]) -> Shard:
            number: dict[tuple, int] = {}
            # a document's places lie 2**40 apart from the next document's
            own = np.array([(number.setdefault(r[4], len(number)) << 40) + r[5] for r in part], np.int64)
            return Shard([r[6] for r in part], own)

        alone = [r for r in found if r[1] == 2]
        if alone:
            shard = shard_of(alone)
            emit(alone, shard, shard.repeated())
        for group in dict.fromkeys(r[0] for r in found if r[1] != 2):
            sides = [[r for r in found if r[0] == group and r[1] == side] for side in (0, 1)]
            if all(sides):
                both = shard_of(sides[0] + sides[1])  # for one numbering of the documents
                numbers = both.own[both.starts]
                one, two = (Shard([r[6] for r in part], own) for part, own in zip(sides, np.split(numbers, [len(sides[0])])))
                emit(sides[0], one, one.found_in(two))
                emit(sides[1], two, two.found_in(one))
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.record_batch(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int64())), pa.array(columns[3], pa.list_(pa.int64()))],
            ["hash", "region", "starts", "stops"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        left: list[tuple] = []
        held, group = 0, None
        for batch in batches:
            shard, side, hash_, region, file, row, begin, data = (c.to_pylist() for c in batch.columns)
            for k in range(batch.num_rows):
                if shard[k] != group:
                    if held >= SHARD:
                        left += pruned(found)
                        found, held = [], 0
                        if sum(len(r[6]) for r in left) >= SHARD:
                            yield solve(left)
                            left = []
                    group = shard[k]
                found.append((shard[k], side[k], hash_[k], region[k], (file[k], row[k]), begin[k], data[k]))
                held += len(data[k])
        if found:
            left += pruned(found)
        if left:
            yield solve(left)

    spread = rows.repartition("shard").sortWithinPartitions("shard")
    return spread.select("shard", "side", "hash", "region", "file", "row", "begin", "data").mapInArrow(run, "hash long, region long, starts array<long>, stops array<long>")


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (file, row, begin, size, ...) with the bytes of each region."""
    parts = wanted.groupBy("file", "row").agg(F.collect_list(F.struct("hash", "region", "begin", "size", "parts", "n")).alias("wanted"))
    joined = docs.select("file", "row", "text").join(parts, ["file", "row"]).select("file", "row", "text", "wanted")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for file, row, text, regions in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
            out += [(file, row, r["hash"], r["region"], r["begin"], r["parts"], r["n"], data[r["begin"] : r["begin"] + r["size"]]) for r in regions]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["file", "row", "hash", "region", "begin", "parts", "n", "data"])

    return by_batch(joined, run, "file long, row long, hash long, region long, begin long, parts int, n long, data binary", 1 << 20)


def covered_runs(docs: DataFrame, found: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """(file, row, starts, stops): runs of repeated bytes of each document that has any; they may overlap.

    found: the anchors' regions in the documents (file, row, text), each standing for ``n``. Regions of an anchor with too
    many bytes are the documents of the next round, and their pieces its regions.
    """
    regions = found.groupBy("hash", "region").agg(
        F.sum("n").alias("n"), F.min(F.struct("file", "row", "begin", "size")).alias("at")
    )
    hashes = regions.groupBy("hash").agg(
        F.sum("n").alias("places"), F.count("*").alias("regions"), F.sum(F.col("at.size").cast("long")).alias("bytes")
    ).where("places > 1")
    kept = stored(regions.join(hashes, "hash"), "regions")
    whole = kept.where(f"n > 1 and at.size >= {LENGTH}").select(
        "hash", "region", F.array(F.lit(0).cast("long")).alias("starts"), F.array(F.col("at.size").cast("long")).alias("stops")
    )
    wanted = kept.where("regions > 1").select(
        "at.*", "hash", "region", F.ceil(F.col("bytes") / SHARD).cast("int").alias("parts"), "n"
    )
    data = fetched(docs, wanted)
    hot = F.col("parts") > MEET if widths else F.lit(False)
    narrow = bool(widths) and not wanted.where(hot).isEmpty()
    if narrow:
        data = stored(data, "data")
    own = F.pmod(F.col("region"), F.col("parts")).cast("int")
    met = data.where(~hot).withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn(
        "shard", F.xxhash64("hash", F.least("own", "other"), F.greatest("own", "other"))
    ).withColumn("side", F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")))
    covered = whole.unionByName(searched(met))
    if narrow:
        inner = data.where(hot).select(F.col("hash").alias("file"), F.col("region").alias("row"), F.col("data").alias("text"), "n")
        cut = stored(piece_rows(inner, widths[0]), "pieces")
        within = covered_runs(inner, cut, widths[1:])
        covered = covered.unionByName(within.withColumnsRenamed({"file": "hash", "row": "region"}))
    covered = stored(covered, "covered")
    return (
        found.join(covered, ["hash", "region"])
        .select("file", "row", F.transform("starts", lambda x: x + F.col("begin")).alias("starts"), F.transform("stops", lambda x: x + F.col("begin")).alias("stops"))
        .groupBy("file", "row").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("stops")).alias("stops"))
    )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(file, row, starts, stops): runs of repeated bytes of each document that has any; they may overlap."""
    found = stored(anchor_rows(docs), "anchors")
    return covered_runs(docs, found.withColumn("n", F.lit(1).cast("long")), WIDTHS)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept) of every row: the removed runs, and the bytes that stay."""
    docs = placed(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "file", "row").select("file", "row", "id", "text")
    joined = docs.join(repeated_runs(docs), ["file", "row"], "left").select("id", "text", "starts", "stops")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, spans, kept = [], [], []
        for text, starts, stops in zip(*(c.to_pylist() for c in batch.columns[1:])):
            data = (text or "").encode("utf-8", "surrogatepass")
            merged: list[list[int]] = []
            for a, b in sorted(zip(starts or (), stops or ())):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            edges = [0, *(x for pair in merged for x in pair), len(data)]
            kept.append(b"".join(data[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2)))
            sizes.append(len(data))
            spans.append([{"start": a, "stop": b} for a, b in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return by_batch(joined, run, f"id {kind}, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary", 1 << 20)


def op9_suffix(spark, sf_dir: str) -> DataFrame:
    """What every document loses by strings of 400 bytes that also start elsewhere."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        # the outcome itself: what stays, as text and as a number of bytes
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), F.length("kept").cast("long").alias("n_kept"),
    )
