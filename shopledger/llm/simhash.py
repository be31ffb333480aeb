"""SimHash fingerprints and their near duplicates by pivot distance tables.

A fingerprint bit is set if more than half of the shingles' hashes have it set. For every distinct fingerprint a table
holds its Hamming distances to ``PIVOTS`` reference fingerprints, separately for each quarter of the bits (their sum
is the distance itself). Of two fingerprints that differ in at most two bits at least two quarters are equal, so they
have the same pivot distances there: these coordinates of two quarters are the key by which candidates meet. Pairs
whose distances to any one pivot differ by more than the limit are discarded (triangle inequality), the survivors are
verified bit by bit. Nothing is lost, and no pair is formed outside a key.

Equal fingerprints are one row. A key with many fingerprints is cut into chunks that meet two by two. A task gives its
links as a spanning forest, never all pairs.

Nulls and texts without a word have fingerprint zero and are linked like others. Repeated rows have one component.
Null ids are kept and never name a component, unless nothing else is in it (then null). Columns other than the id and
the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, fresh, placed, stored, table, unsigned_hex
from shopledger.llm.graph import components

#: Words of a shingle, seed of its hash, most differing bits of a link.
SHINGLE, SEED, LIMIT = 3, 42, 2
#: Reference fingerprints, and the fingerprints of one key that meet in one task.
PIVOTS, CHUNK = 8, 1024
BANDS = [0xFFFF << s for s in (0, 16, 32, 48)]
#: Links a task holds before it reduces them to a spanning forest.
HELD = 1 << 18


def pivots() -> np.ndarray:
    """The reference fingerprints: fixed random bits."""
    return np.random.default_rng(20240229).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)))) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    return by_batch(df.select(id_col, text_col), run, f"id {df.schema[id_col].dataType.simpleString()}, fp long")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keys(fp: Column) -> Column:
    """One key per pair of quarters: the pivot distances in both."""
    near = [[F.bit_count(fp.bitwiseXOR(F.lit(signed(int(p) & b))).bitwiseAND(F.lit(signed(b)))) for p in pivots()] for b in BANDS]
    return F.array(*(F.xxhash64(F.lit(k), *near[i], *near[j]) for k, (i, j) in enumerate(combinations(range(len(BANDS)), 2))))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest row reachable from each of n rows."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def linked(group: np.ndarray, side: np.ndarray, fp: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by group, as (fingerprint, fingerprint) of a spanning forest.

    side: 0 or 1 if the group holds two chunks that meet (only pairs of both count), 2 if it holds one.
    """
    refs = pivots()
    distances = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int16)
    n = len(fp)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = np.arange(n)
    count, step = 0, 0

    def reduce() -> None:
        nonlocal held, count
        root = forest(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]), n)
        bound = np.flatnonzero(root != np.arange(n))
        held, count = [(bound, root[bound])], 0

    while True:
        step += 1
        rows = rows[rows + step < n]
        rows = rows[group[rows] == group[rows + step]]
        if not len(rows):
            break
        a = rows[(side[rows] != side[rows + step]) | (side[rows] == 2)]
        a = a[(np.abs(distances[a] - distances[a + step]) <= limit).all(axis=1)]
        a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= limit]
        held.append((a, a + step))
        count += len(a)
        if count > HELD:
            reduce()
    if not held:
        return fp[:0], fp[:0]
    reduce()
    return fp[held[0][0]], fp[held[0][1]]


def links(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, b): links that join all of the distinct fingerprints within the limit, directly or through others."""
    if limit > LIMIT:
        raise ValueError(f"the keys are exact up to {LIMIT} differing bits")
    keyed = fps.select("fp", F.explode(keys(F.col("fp"))).alias("key"))
    crowded = keyed.groupBy("key").count().where("count > 1").withColumn("chunks", F.ceil(F.col("count") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = keyed.join(crowded, "key").select("key", "fp", own.alias("own"), F.explode(F.expr("sequence(0, chunks - 1)")).alias("other")).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("group"),
        F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"), "fp",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def out(group: np.ndarray, side: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = linked(group, side, fp.view(np.uint64), limit)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = [batch.column(k).to_numpy() for k in range(3)]
            rest = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            whole = int(np.searchsorted(rest[0], rest[0][-1]))  # the last group may go on
            if whole:
                yield out(*(x[:whole] for x in rest))
                rest = [x[whole:] for x in rest]
        if rest is not None:
            yield out(*rest)

    sorted_ = met.repartition("group").sortWithinPartitions("group")
    return sorted_.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """(id, fp, component) of every row: the component is the smallest id reachable by links."""
    rows = stored(fingerprints(df, id_col, text_col, size), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(fps.select("fp"), limit))
    named = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(named.select("fp", "root").join(least, "root").select("fp", "component"), "fp").select("id", "fp", "component")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, limit: int = LIMIT) -> DataFrame:
    """All columns of one row of each component: the one with the smallest id, and the first in the files of those."""
    file, row, id_ = fresh(df, "row_file", "row_number", "row_id")
    rows = placed(df, file, row)
    named = rows.withColumn(id_, F.struct(F.col(id_col).alias("id"), F.col(file).alias("file"), F.col(row).alias("row")))
    least = near_duplicates(named, id_, text_col, size, limit).select("component.file", "component.row").distinct()
    keep = least.select(F.col("file").alias(file), F.col("row").alias(row))
    return rows.join(keep, [file, row], "left_semi").select(*df.columns)


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), unsigned_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))
