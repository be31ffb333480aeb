"""Quality classifier: hashed word n-gram logistic regression trained by follow-the-regularised-leader.

Words (runs of letters and digits, and runs of other signs) and pairs of neighbours are hashed into ``1 << BITS``
features; a pair of equal words is a feature of its own. A text's vector holds the counts, scaled to length one, and a
constant. Per-coordinate FTRL-proximal updates run over ``SAMPLE`` labelled rows at most, in ``SHARDS`` tasks whose
weights are averaged; a score is the logistic of a sparse dot product.

Nulls and empty texts are scored by the constant alone. Repeated rows get equal scores; of several labels of an id the
largest counts. Held-out rows are never learned from. Without labelled rows every score is 0.5. Columns other than
those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, held_out, slices, table

#: Bits of a feature's number; labelled rows learned from at most, tasks that learn, and passes over the rows.
BITS, SAMPLE, SHARDS, PASSES = 18, 12_000, 4, 3
#: Step size, its offset, and the two penalties of the updates.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
#: Score from which a text is predicted to be good.
GOOD = 0.7
WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20]+")
CONSTANT, SAME = 0, 1


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass"))
    if not words:
        return np.array([CONSTANT]), np.ones(1)
    one = np.fromiter(map(crc32, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)
    two = np.where(one[1:] == one[:-1], np.uint64(SAME), two)
    found = np.concatenate([one >> np.uint64(32 - bits), two]).astype(np.int64)
    counts = np.bincount(found, minlength=0) if len(found) > 1 << bits - 2 else None
    if counts is None:
        number, count = np.unique(found, return_counts=True)
    else:
        number = np.flatnonzero(counts)
        count = counts[number]
    value = count / np.sqrt((count.astype(float) ** 2).sum())
    return np.append(number, CONSTANT), np.append(value, 1.0)


def learn(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], bits: int = BITS, passes: int = PASSES) -> np.ndarray:
    """Weights after FTRL-proximal passes over the rows."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(passes):
        for (number, value), label in zip(rows, labels):
            zi, ni = z[number], n[number]
            w = weights(zi, ni)
            g = (logistic(w @ value) - label) * value
            g2 = g * g
            z[number] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / ALPHA * w
            n[number] = ni + g2
    return weights(z, n).astype(np.float32)


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def fit(df: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from labelled rows that aren't held out: ``sample`` ids at most, in the order of a hash."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label"))
    chosen = F.broadcast(known.orderBy(F.xxhash64("id"), "id").limit(sample))  # at most ``sample`` pairs of numbers
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select(
        F.xxhash64("id").alias("place"), "text", "label"
    ).withColumn("shard", F.pmod("place", F.lit(SHARDS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[int, list[tuple]] = {}
        for batch in batches:
            for part in slices(batch, 1 << 20):
                for place, text, good, shard in zip(*(c.to_pylist() for c in part.columns)):
                    number, value = features(text)
                    shards.setdefault(shard, []).append((place, number.astype(np.int32), value.astype(np.float32), good))
        for found in shards.values():
            found.sort(key=lambda r: r[0])
            w = learn([(number, value) for _, number, value, _ in found], [good for *_, good in found])
            yield pa.record_batch([pa.array([w.tobytes()]), pa.array([len(found)], pa.int64())], ["weights", "rows"])

    learned = rows.repartition(SHARDS, "shard").mapInArrow(run, "weights binary, rows long").collect()  # SHARDS rows
    if not learned:
        return np.zeros(1 << BITS, np.float32)
    return np.average([np.frombuffer(r.weights, np.float32) for r in learned], axis=0, weights=[r.rows for r in learned]).astype(np.float32)


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    sent = df.sparkSession.sparkContext.broadcast(weights)  # of a fixed size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = sent.value
        scores = []
        for text in batch.column(1).to_pylist():
            number, value = features(text)
            scores.append(logistic(w[number] @ value))
        return pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    return by_batch(df.select(id_col, text_col), run, f"id {df.schema[id_col].dataType.simpleString()}, score double")


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score(docs, fit(docs, labels))
    return found.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )
