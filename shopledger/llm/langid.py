"""Language identification by a linear-chain conditional random field over words.

A chain is a line of a text, its labels the languages. A word's features are its hashed byte n-grams between word
borders (those at a border are its affixes) and itself (the lexicon); transitions between neighbouring words are
learned along with them. Forward-backward gives each word's language probabilities, so that lines that switch between
languages are labelled word by word; a text's language has the largest mean probability.

The field is fitted on ``SAMPLE`` rows per language at most, in the order of a hash of their id, from lines of
different rows joined to chains that switch languages. Held-out rows are never learned from.

Null and empty texts and texts without a letter are ``und`` with score 0; ties go to the smaller name. Repeated rows
get equal results. Rows without a language are labelled, not learned from; if no row has one, every text is ``und``.
Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, held_out, table

#: Bits of a feature's number, and the sizes of the n-grams in bytes.
BITS, GRAMS = 16, (1, 2, 3, 4)
#: Rows learned from for each language, and their longest text; passes, chains of a step, words of a part, parts of a chain.
SAMPLE, LONGEST, PASSES, CHAINS, PART, PARTS = 300, 20_000, 4, 64, 12, 6
#: Parts in which a language's rows are ranked.
SALTS = 64
#: Step size, penalty.
STEP, L2 = 0.3, 1e-4
#: Words a worker remembers.
REMEMBERED = 200_000
UNKNOWN = "und"
_LABELLERS: dict[int, Labeller] = {}


def core(word: str) -> bytes:
    """A word's letters in lower case; empty if it has none."""
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).lower().encode()


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words one after the other, and where each word's begin."""
    text = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    last = np.repeat(starts + sizes, sizes)
    at = np.arange(len(text))
    numbers, owners = [np.fromiter(map(crc32, words), np.uint64, len(words))], [np.arange(len(words))]
    value = np.zeros(len(text), np.uint64)
    for size in range(1, max(GRAMS) + 1):
        value[: len(text) - size + 1] = value[: len(text) - size + 1] * np.uint64(257) + text[size - 1 :] + np.uint64(1)
        if size in GRAMS:
            whole = at + size <= last
            numbers.append((value[whole] + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32))
            owners.append(owner[whole])
    number, owner = np.concatenate(numbers), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (number[order] & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(owner[order], np.arange(len(words)))


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of every word and, summed over all chains, expected transitions.

    emission: log scores of the words of all chains, one chain after the other; no chain is empty.
    """
    e = np.exp(emission - emission.max(axis=1, keepdims=True))
    t = np.exp(transition - transition.max())
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")
    alpha, beta = np.empty_like(e), np.ones_like(e)
    now = None
    for step, k in enumerate(active):
        rows = starts[:k] + step
        now = e[rows] if step == 0 else (now[:k] @ t) * e[rows]
        now /= now.sum(axis=1, keepdims=True)
        alpha[rows] = now
    expected = np.zeros_like(t)
    for step in range(len(active) - 1, 0, -1):
        rows = starts[: active[step]] + step
        to = e[rows] * beta[rows]
        back = to @ t.T
        scale = (alpha[rows - 1] * back).sum(axis=1, keepdims=True)
        expected += (alpha[rows - 1] / scale).T @ to * t
        beta[rows - 1] = back / back.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    return gamma / gamma.sum(axis=1, keepdims=True), expected


@dataclass
class Model:
    """Weights of the features and of the transitions; ``key`` tells models apart."""

    languages: list[str]
    weights: np.ndarray = field(repr=False)
    transition: np.ndarray
    key: int = 0


def learn(lines: list[tuple[list[str], int]], languages: list[str], seed: int = 11) -> Model:
    """A model of lines with their language's number."""
    rng = np.random.default_rng(seed)
    size = len(languages)
    number: dict[bytes, int] = {}
    parts, labels = [], []
    for words, label in lines:
        ids = [number.setdefault(w, len(number)) for w in map(core, words) if w]
        for k in range(0, len(ids), PART):
            parts.append(np.array(ids[k : k + PART]))
            labels.append(label)
    weights, transition = np.zeros((1 << BITS, size)), np.zeros((size, size))
    if parts:
        found, first = features(list(number))
        counts = np.diff(np.append(first, len(found)))
        square, square_t = np.full(weights.shape, 1e-8), np.full(transition.shape, 1e-8)
        for _ in range(PASSES):
            order = rng.permutation(len(parts))
            for k in range(0, len(order), CHAINS * PARTS):
                chosen = order[k : k + CHAINS * PARTS]
                words = np.concatenate([parts[c] for c in chosen])
                gold = np.repeat([labels[c] for c in chosen], [len(parts[c]) for c in chosen])
                lengths = np.array([sum(len(parts[c]) for c in chosen[j : j + PARTS]) for j in range(0, len(chosen), PARTS)])
                seen, inverse = np.unique(words, return_inverse=True)
                own = np.concatenate([found[first[w] : first[w] + counts[w]] for w in seen])
                owner = np.repeat(np.arange(len(seen)), counts[seen])
                scores = np.add.reduceat(weights[own], np.cumsum(counts[seen]) - counts[seen])
                gamma, expected = forward_backward(scores[inverse], lengths, transition)
                gamma[np.arange(len(gold)), gold] -= 1
                by_word = np.zeros(scores.shape)
                np.add.at(by_word, inverse, gamma / len(words))
                touched, place = np.unique(own, return_inverse=True)
                gradient = np.zeros((len(touched), size))
                np.add.at(gradient, place, by_word[owner])
                gradient += L2 * weights[touched] * len(words) / 1e5
                square[touched] += gradient**2
                weights[touched] -= STEP * gradient / np.sqrt(square[touched])
                ends = np.zeros(len(gold), bool)
                ends[np.cumsum(lengths) - 1] = True
                observed = np.zeros_like(transition)
                np.add.at(observed, (gold[:-1][~ends[:-1]], gold[1:][~ends[:-1]]), 1)
                step = (expected - observed) / len(words)
                square_t += step**2
                transition -= STEP * step / np.sqrt(square_t)
    weights = weights.astype(np.float32)
    return Model(languages, weights, transition, crc32(weights.tobytes()))


class Labeller:
    """Applies a model; remembers the scores of words seen before."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.seen: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)

    def words(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Lines of all texts, the place of their first word's text, probabilities of all words with a letter and their text."""
        if len(self.seen) > REMEMBERED:
            self._clear()
        lines = [(k, w) for k, t in enumerate(texts) if t for line in t.split("\n") if (w := line.split())]
        new = [w for w in set(chain.from_iterable(w for _, w in lines)) if w not in self.seen]
        cores = list(map(core, new))
        spelled = [w for w, c in zip(new, cores) if c]
        self.seen |= {w: -1 for w, c in zip(new, cores) if not c}
        if spelled:
            number, first = features([c for c in cores if c])
            self.seen |= {w: len(self.scores) + k for k, w in enumerate(spelled)}
            self.scores = np.concatenate([self.scores, np.add.reduceat(self.model.weights[number], first)])
        sizes = np.array([len(w) for _, w in lines], np.int64)
        ids = np.fromiter(map(self.seen.__getitem__, chain.from_iterable(w for _, w in lines)), np.int64, sizes.sum())
        line = np.repeat(np.arange(len(lines)), sizes)[ids >= 0]
        owner = np.array([k for k, _ in lines], np.int64)[line]
        ids = ids[ids >= 0]
        if not len(ids):
            return [w for _, w in lines], np.zeros((0, len(self.model.languages))), owner
        lengths = np.bincount(line, minlength=len(lines))
        gamma, _ = forward_backward(self.scores[ids], lengths[lengths > 0], self.model.transition.astype(np.float32))
        return [w for _, w in lines], gamma, owner

    def texts(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        languages = self.model.languages
        _, gamma, owner = self.words(texts)
        if not languages or not len(gamma):
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        share = np.stack([np.bincount(owner, gamma[:, k], len(texts)) for k in range(len(languages))], 1)
        count = np.bincount(owner, minlength=len(texts))
        best = share.argmax(axis=1)
        score = np.where(count > 0, share[np.arange(len(texts)), best] / np.maximum(count, 1), 0.0)
        return [languages[b] if c else UNKNOWN for b, c in zip(best, count)], np.clip(score, 0.0, 1.0)

    def labels(self, text: str) -> list[tuple[str, str]]:
        """(word, language) of each word with a letter."""
        words, gamma, _ = self.words([text])
        spelled = [w for line in words for w in line if core(w)]
        return [(w, self.model.languages[k]) for w, k in zip(spelled, gamma.argmax(axis=1))]


def labeller(model: Model) -> Labeller:
    if model.key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[model.key] = Labeller(model)
    return _LABELLERS[model.key]


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """A model of the rows with a language that aren't held out."""
    known = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id"))
    )
    whole = known.where((F.length("text") > 0) & (F.length("text") <= LONGEST))
    order = [F.xxhash64("id"), "id", "hash"]
    named = whole.withColumn("hash", F.xxhash64("text"))
    chosen = named.select("id", "lang", "hash").withColumn("salt", F.pmod("hash", F.lit(SALTS)))
    # the first of each salt, then the first of those: no task ranks all rows of a language
    for keys in (["lang", "salt"], ["lang"]):
        chosen = chosen.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= sample)
    # ``sample`` ids for each language
    rows = named.join(F.broadcast(chosen.select("id", "lang", "hash", "place")), ["id", "lang", "hash"]).select("place", "lang", "text")
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())  # the labels themselves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: (r[1], r[0], r[2]))
        lines = [(line.split(), languages.index(lang)) for _, lang, text in found for line in text.split("\n")]
        model = learn(lines, languages)
        yield pa.record_batch(
            [pa.array([model.weights.tobytes()]), pa.array([model.transition.tobytes()]), pa.array([model.key], pa.int64())], ["weights", "transition", "key"]
        )

    # the sample is bounded: one task learns from it
    r = rows.repartition(1).mapInArrow(run, "weights binary, transition binary, key long").first()
    n = len(languages)
    if r is None:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0)))
    return Model(languages, np.frombuffer(r.weights, np.float32).reshape(-1, n), np.frombuffer(r.transition).reshape(n, n), r.key)


def labels_of(spark, model: Model):
    """A function from texts to an Arrow column of their languages, for tasks."""
    sent = spark.sparkContext.broadcast(model)

    def labels(texts: list[str | None]) -> list[pa.Array]:
        found = labeller(sent.value).texts(texts)[0] if model_size else [UNKNOWN] * len(texts)
        return [pa.array(found, pa.string())]

    model_size = len(model.languages)
    return labels


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    if not model.languages:
        return df.select(F.col(id_col).alias("id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = df.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights for each language

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        languages, scores = labeller(sent.value).texts(batch.column(1).to_pylist())
        return pa.record_batch([batch.column(0), pa.array(languages, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    return by_batch(df.select(id_col, text_col), run, f"id {kind}, lang_pred string, score double", 2 << 20)


def op7_langid(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
