"""Quality rules with an isolation forest on rule statistics.

Base rules drop texts with too few words or too many repeated ones. An isolation forest judges the rest: its trees
split the rule statistics (shares of symbols, of separators and of exclamation marks) at random features and values; texts that few splits isolate are anomalies. The forest is fitted on a
bounded sample of labelled rows. The path length below which a text is dropped is calibrated on all labelled rows:
the one that maximises the share of clean texts kept plus the share of bad texts dropped, under a floor for the former.
Held-out rows take no part in either.

Nulls and empty texts have no words and fail the base rules. Repeated rows get equal results. Without labelled rows of
both kinds the forest drops nothing. Empty tables give no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, held_out, table
from shopledger.session import store

#: Base rules: least words, most percent of words in repeated windows, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
#: The forest: trees, rows each tree sees, labelled rows the sample has at most.
TREES, ROWS, SAMPLE = 128, 256, 8192
#: Least share of clean labelled texts the threshold keeps.
KEEP_CLEAN = 0.995
SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: Statistics the forest splits. Those of lengths, capitals and repeats also set clean short texts apart and are left to the base rules.
FEATURES = ["symbols", "pipes", "marks"]
_CLASSES = np.zeros(256, np.uint8)
for _k, _signs in enumerate([SPACE, SYMBOLS, b"!"], 1):
    _CLASSES[list(_signs)] = _k


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    if base**window < 1 << 62:
        key = sum(ids[k : k + n] * base ** (window - 1 - k) for k in range(window))
    else:
        key = np.unique(np.stack([ids[k : k + n] for k in range(window)], 1), axis=0, return_inverse=True)[1].reshape(-1)
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    often = np.zeros(n + 1, bool)
    often[order[1:][equal]] = often[order[:-1][equal]] = True
    steps = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return int((np.cumsum(steps) > 0).sum())


def statistics(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the forest's features."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return (0, 0, 0, 0, 0, [0.0] * len(FEATURES))
    raw = np.frombuffer(data, np.uint8)
    by = np.bincount(_CLASSES[raw], minlength=4)
    chars = len(text) - int(by[1])
    symbols = int(by[2])
    lines = [x for x in data.split(b"\n") if x.strip()]
    double = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeated = repeated_words(ids)
    features = [symbols / chars, data.count(b" | ") / n, by[3] / chars]
    return (n, chars, symbols, double, repeated, [float(x) for x in features])


def rule_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, features, base_failed) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*map(statistics, batch.column(1).to_pylist())))
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.list_(pa.float64()))]
        return pa.record_batch([batch.column(0), *arrays], ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "features"])

    kind = df.schema[id_col].dataType.simpleString()
    found = by_batch(
        df.select(id_col, text_col), run,
        f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, features array<double>",
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed)


class Forest:
    """Isolation trees as arrays: feature, value and left child of each node; leaves hold their path length."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, rows: int = ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        rows = min(rows, len(sample))
        self.depth = max(1, math.ceil(math.log2(max(2, rows))))
        self.trees = [self._grow(sample[rng.choice(len(sample), rows, replace=False)], rng) for _ in range(trees)]

    def _grow(self, sample: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, value, left, length = [], [], [], []

        def node() -> int:
            for column in (feature, value, left, length):
                column.append(0)
            return len(feature) - 1

        todo = [(node(), sample, 0)]
        while todo:
            at, rows, depth = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            wide = np.flatnonzero(high > low)
            if depth == self.depth or len(rows) < 2 or not len(wide):
                left[at], length[at] = at, depth + mean_path(len(rows))
                continue
            feature[at] = f = int(rng.choice(wide))
            value[at] = v = float(rng.uniform(low[f], high[f]))
            left[at] = node()
            node()
            below = rows[:, f] < v
            todo += [(left[at], rows[below], depth + 1), (left[at] + 1, rows[~below], depth + 1)]
        return np.array(feature), np.array(value), np.array(left), np.array(length)

    def path_length(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row: short paths are anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left, length in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                child = left[at]
                at = np.where(child == at, at, child + (x[rows, feature[at]] >= value[at]))
            total += length[at]
        return total / len(self.trees)


def mean_path(n: int) -> float:
    """Mean depth at which a search in a random tree of n rows ends."""
    return 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def path_lengths(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with the column path_length."""
    names = stats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column("features").to_numpy(zero_copy_only=False))
                yield pa.record_batch([*batch.columns, pa.array(forest.path_length(x))], [*names, "path_length"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return stats.mapInArrow(run, StructType([*stats.schema.fields, StructField("path_length", DoubleType())]))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> Forest | None:
    """A forest of ``sample`` labelled rows at most, in the order of a hash of their id; None without such rows."""
    rows = (
        stats.where(~F.col("base_failed") & ~held_out(F.col("id")))
        .join(labels.where("quality is not null").select(F.col(id_col).alias("id")).distinct(), "id")
        .orderBy(F.xxhash64("id"), "features").limit(sample).select("features").toPandas()
    )
    return Forest(np.stack(rows.features.to_numpy())) if len(rows) else None


def calibrate(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", keep_clean: float = KEEP_CLEAN) -> float:
    """Path length below which a text is dropped; from all labelled rows that pass the base rules and aren't held out."""
    known = labels.where("quality is not null").groupBy(F.col(id_col).alias("id")).agg(F.max("quality").alias("quality"))
    step = F.floor(F.col("path_length") * 100).cast("int")
    table_ = (
        scored.where(~F.col("base_failed") & ~held_out(F.col("id"))).join(known, "id")
        .groupBy(step.alias("step")).agg(F.sum(F.col("quality")).alias("clean"), F.sum(1 - F.col("quality")).alias("bad"))
        .orderBy("step").toPandas()  # a row per hundredth of a path length
    )
    clean, bad = table_.clean.sum(), table_.bad.sum()
    if not clean or not bad:
        return -1.0
    kept, dropped = 1 - table_.clean.cumsum() / clean, table_.bad.cumsum() / bad
    gain = (kept + dropped).where(kept >= keep_clean, -1.0)
    best = int(gain.argmax()) if len(gain) and gain.max() > 1 else -1
    if best < 0:
        return -1.0
    after = table_.step.iloc[best + 1] if best + 1 < len(table_) else table_.step.iloc[best] + 1
    return (float(table_.step.iloc[best]) + 1 + float(after)) / 200  # midway to the next path length there is


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rule statistics of every row, its path length and whether it is kept."""
    stats = store(rule_statistics(df, id_col, text_col), "rules")
    forest = fit(stats, labels, id_col)
    if forest is None:
        return stats.withColumn("path_length", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    scored = path_lengths(stats, forest)
    least = calibrate(scored, labels, id_col)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("path_length") >= least))


def op3_rules(spark, sf_dir: str) -> DataFrame:
    """Rule statistics and verdict of every document."""
    found = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "path_length"
    )
