"""Exact top-k search by block-at-a-time pruning.

Vectors lie in blocks of a document range; vectors with the same strongest component come next to each other, so that
blocks are alike inside. A term is a component with a sign: a block keeps the largest and the smallest value of each
component, which bound a query's score in it from above. Per query the blocks are taken in the order of their bounds
and scored through their forward index (the vectors themselves, as integers) until the next bound is below the k-th
score. Bounds equal to it are still scored, as a tie may go to a smaller id.

Queries and blocks meet in packs: a pack of queries is sent to every group of blocks, so that neither side is ever
whole in one place. A task carries each query's best k and its k-th score from one group to the next and gives them out
once; the tasks' results are merged afterwards.

Vectors that are null, or hold null or non-finite components, take no part, nor do rows without an id. Of several rows
with one query id the query is the one with the smallest vector, compared component by component, so a query id has one
result. Components and scores beyond 2**63 - 1 either way become that number. Shorter vectors
count as zero in the missing components. Rows with the query's own id are no candidates; other repeated rows are
candidates of their own. Empty tables give no rows. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import table

#: Vectors of a block, blocks of a pack, queries of a pack.
BLOCK, PACK, QUERIES = 64, 64, 512
#: Components are floor(scale * x).
SCALE = 64
#: Largest sum of products that stays exact in double precision and in 64 bits.
EXACT, LONGEST = 1 << 53, 1 << 63


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, vector of integers) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.greatest(F.floor(v * scale), F.lit(1 - LONGEST))).alias("vector")
    )


def packed(df: DataFrame, rows: int) -> DataFrame:
    """Rows of about ``rows`` ids and vectors each, as bytes; a task packs what it reads, in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        vectors: list[list] = []
        held = 0

        def out() -> pa.RecordBatch:
            width = max(map(len, vectors))
            matrix = np.zeros((len(vectors), width), np.int64)
            for k, v in enumerate(vectors):
                matrix[k, : len(v)] = v
            found = np.concatenate(ids)
            return pa.record_batch([pa.array([found.tobytes()]), pa.array([matrix.tobytes()]), pa.array([width], pa.int32())], ["ids", "vectors", "width"])

        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids.append(part.column(0).to_numpy())
                vectors += part.column(1).to_pylist()
                held += part.num_rows
                if held >= rows:
                    yield out()
                    ids, vectors, held = [], [], 0
        if held:
            yield out()

    return df.mapInArrow(run, "ids binary, vectors binary, width int")


def unpack(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, np.frombuffer(vectors, np.int64).reshape(len(found), width)


def product(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Inner products of at most ``most``: by floating point or 64-bit integers where they are exact, else by whole numbers."""
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < LONGEST:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, 1 - LONGEST, LONGEST - 1).astype(np.int64)


Best = tuple[np.ndarray, np.ndarray]


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def search(q_ids: np.ndarray, q: np.ndarray, d_ids: np.ndarray, d: np.ndarray, k: int, known: dict[int, Best], block: int = BLOCK) -> None:
    """Bring each query's best k, as (ids, scores) in order, up to date with these documents."""
    width = max(q.shape[1], d.shape[1])
    q, d = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, d))
    most = largest(q) * largest(d) * max(width, 1)
    starts = np.arange(0, len(d), block)
    high = np.maximum.reduceat(d, starts, axis=0) if width else np.zeros((len(starts), 0), np.int64)
    low = np.minimum.reduceat(d, starts, axis=0) if width else high
    if most < LONGEST:
        bounds = product(np.maximum(q, 0), high, most) + product(np.minimum(q, 0), low, most)
    else:  # two clipped halves would not bound the whole
        bounds = np.concatenate([product(np.hstack([np.maximum(r, 0), np.minimum(r, 0)])[None], np.hstack([high, low]), most) for r in q])
    order = np.argsort(-bounds, axis=1, kind="stable")
    forward = d.astype(np.float64) if most < EXACT else d
    asked = q.astype(np.float64) if most < EXACT else q
    empty = np.empty(0, np.int64)
    for row, query in enumerate(q_ids.tolist()):
        ids, scores = known.get(query, (empty, empty))
        kth = scores[-1] if len(scores) == k else None
        for b in order[row]:
            if kth is not None and bounds[row, b] < kth:
                break
            here = slice(starts[b], starts[b] + block)
            new = (forward[here] @ asked[row]).astype(np.int64) if most < LONGEST else product(forward[here], asked[row][None], most)[:, 0]
            take = d_ids[here] != query
            if kth is not None:
                take &= new >= kth
            if take.any():
                ids, scores = np.concatenate([ids, d_ids[here][take]]), np.concatenate([scores, new[take]])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                kth = scores[-1] if len(scores) == k else None
        known[query] = ids, scores


def candidates(
    queries: DataFrame, documents: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(query_id, vec_id, score): each task's best k documents of every query it has met."""
    strongest = F.expr("array_position(transform(vector, v -> abs(v)), array_max(transform(vector, v -> abs(v))))")
    alike = F.coalesce(F.when(F.get("vector", F.coalesce(strongest, F.lit(1)).cast("int") - 1) < 0, -strongest).otherwise(strongest), F.lit(0))
    taking = integers(documents, id_col, vector_col, scale)
    groups = max(1, -(-taking.count() // (BLOCK * PACK)))
    # a task reads several groups one after the other, so that the k-th scores of one prune the next
    tasks = min(groups, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = packed(
        taking.withColumn("alike", alike).repartitionByRange(tasks, "alike", "id").sortWithinPartitions("alike", "id").select("id", "vector"),
        BLOCK * PACK,
    )
    asked = integers(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("vector").alias("vector"))
    q = packed(asked, QUERIES)
    meets = q.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(
        d.select(*(F.col(c).alias(f"d_{c}") for c in d.columns), F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("pack")), "pack"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Best] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                r = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                search(*unpack(r["ids"], r["vectors"], r["width"]), *unpack(r["d_ids"], r["d_vectors"], r["d_width"]), k, known)
        if known:
            yield pa.record_batch(
                [pa.array(np.repeat(np.array(list(known), np.int64), [len(i) for i, _ in known.values()])),
                 pa.array(np.concatenate([i for i, _ in known.values()])), pa.array(np.concatenate([s for _, s in known.values()]))],
                ["query_id", "vec_id", "score"],
            )

    return meets.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    queries: DataFrame, documents: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k documents of every query."""
    best = candidates(queries, documents, k, id_col, vector_col, scale)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op2_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 20 = 0"), vectors, 20).select("query_id", "rank", "vec_id", "score")
