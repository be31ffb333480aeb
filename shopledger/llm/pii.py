"""Personal data by base patterns and a semi-Markov conditional random field.

Four base patterns (mail address, network address, card number, phone number) with their checks find the plain cases.
The field adds written variants of them: text around digits and at-signs is cut into tokens, every run of ``LONGEST``
tokens at most that could be an entity is a candidate segment with features of the whole span (shape, digits, groups,
checks, neighbours), and dynamic programming over segments of bounded length chooses boundaries and kinds jointly.
Tokens outside segments score zero. The field is fitted on windows of ``SAMPLE`` rows at most, marked by the base
patterns, with rewritten copies of their entities (other separators, no plus sign).

Base spans stay; spans of the field that touch one are left out. Offsets count code points, ends are exclusive.
Nulls and empty texts have no span. Repeated rows get equal results; empty tables give no rows. Columns other than the
id and the text are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, table

KINDS = ["email", "ip", "card", "phone"]
#: Tokens of a segment, characters kept around triggers, bits of a feature's number.
LONGEST, AROUND, BITS = 14, 40, 14
#: Rows whose windows are learned from, windows of a row, characters of a window, passes, step size, penalty.
SAMPLE, WINDOWS, LONG_WINDOW, PASSES, STEP, L2 = 3000, 8, 600, 4, 0.3, 1e-3
#: Log odds a segment needs beyond the best reading without it: rather miss a variant than mark clean text.
MARGIN = 2.0
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
SHAPE = [(re.compile(r"[0-9]"), "9"), (re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"9{5,}"), "9+")]

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    twice = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]
    return sum(int(d) if k % 2 == 0 else twice[int(d)] for k, d in enumerate(reversed(digits))) % 10 == 0


def octet(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base patterns, in the order of kind and start; each pass is linear."""
    found: list[Span] = []
    if not TRIGGER.search(text):
        return found
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        run = text[done:at]
        start = done + len(run.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            found.append((0, start, domain.end()))
            done = at = domain.end()
        else:
            done = at = at + 1
    for chain in DOTTED.finditer(text):
        parts = chain.group().split(".") if chain.group().count(".") >= 3 else []
        start = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(map(octet, four)):
                found.append((1, start, end))
            start = end + 1
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, m.group())) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits and at-signs; triggers near each other share one."""
    found: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        if found and m.start() - AROUND <= found[-1][1]:
            found[-1][1] = min(len(text), m.end() + AROUND)
        else:
            found.append([max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)])
    return [(a, b) for a, b in found]


def candidates(text: str) -> tuple[list[int], list[tuple[int, int, int, list[int]]]]:
    """Token starts (and the end), and the segments (first token, behind the last, kind, features) that could be entities."""
    tokens = [m.span() for m in TOKEN.finditer(text)]
    starts = [a for a, _ in tokens] + [len(text)]
    kinds = ["d" if text[a].isdigit() and text[a].isascii() else "l" if text[a].isalpha() else text[a] for a, _ in tokens]
    found = []
    for i, (a, _) in enumerate(tokens):
        if kinds[i] not in "dl+(":
            continue
        digits = ats = dots = groups = 0
        for j in range(i, min(len(tokens), i + LONGEST)):
            kind, (x, b) = kinds[j], tokens[j]
            if kind == "\n":
                break
            digits += (b - x) * (kind == "d")
            groups += kind == "d"
            ats += kind == "@"
            dots += kind == "."
            if kind not in "dl" or ats > 1 or digits > 24:
                continue
            letters = any(k == "l" for k in kinds[i : j + 1])
            able = [
                ats == 1 and dots >= 1 and kinds[i] in "dl" and not any(text[p].isspace() for p in range(a, b)),
                groups == 4 and kinds[i] == "d" and not letters and digits <= 12,
                12 <= digits <= 19 and kinds[i] == "d" and not letters,
                7 <= digits <= 15 and kinds[i] in "d+(" and not letters,
            ]
            if any(able):
                common = span_features(text, a, b)
                for k, possible in enumerate(able):
                    if possible:
                        found.append((i, j + 1, k, [crc32(f"{KINDS[k]} {f}".encode()) & ((1 << BITS) - 1) for f in common]))
    return starts, found


def span_features(text: str, a: int, b: int) -> list[str]:
    """Features of a whole span and of what stands beside it."""
    span = text[a:b]
    shape = span
    for pattern, sign in SHAPE:
        shape = pattern.sub(sign, shape)
    digits = "".join(c for c in span if c.isdigit() and c.isascii())
    before, after = text[a - 1 : a], text[b : b + 1]
    signs = "".join(sorted({c for c in span if not c.isalnum()}))
    parts = span.split(".")
    return [
        "is", f"shape {shape}", f"digits {len(digits)}", f"signs {signs}", f"first {shape[0]}",
        f"checked {luhn(digits) if digits else False}", f"octets {len(parts) == 4 and all(p.isdigit() and p.isascii() and octet(p) for p in parts)}",
        f"before {kind_of(before)}", f"after {kind_of(after)}", f"both {kind_of(before)}{kind_of(after)}",
        f"joined {before in '.-_@+/:' and before != ''}", f"goes on {after in '-_@/' and after != ''}",
        f"dot goes on {after == '.' and text[b + 1 : b + 2].isalnum()}", f"dotted before {before == '.'}",
        f"digits joined {bool(re.search('[0-9][ ().-]{0,2}$', text[max(0, a - 3) : a]))} {bool(re.match('[ ().-]{0,2}[0-9]', text[b : b + 3]))}",
    ]


def kind_of(sign: str) -> str:
    return "none" if not sign else "digit" if sign.isdigit() else "letter" if sign.isalpha() else "space" if sign.isspace() else sign


def decode(text: str, weights: np.ndarray, margin: float = MARGIN) -> list[Span]:
    """The best reading of a window as entities and other tokens, by dynamic programming over segments."""
    starts, found = candidates(text)
    if not found:
        return []
    ending: dict[int, list[tuple[float, int, int]]] = {}
    for i, j, kind, numbers in found:
        score = float(weights[numbers].sum()) - margin
        if score > 0:
            ending.setdefault(j, []).append((score, i, kind))
    n = len(starts) - 1
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for score, i, kind in ending.get(j, ()):
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind)
    spans, j = [], n
    while j:
        if back[j]:
            i, kind = back[j]
            spans.append((kind, starts[i], starts[j]))
            j = i
        else:
            j -= 1
    return spans[::-1]


def learn(examples: list[tuple[str, list[Span]]], seed: int = 5) -> np.ndarray:
    """Weights that make the marked readings likely, by forward-backward over segments."""
    weights, square = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    rows = []
    for text, gold in examples:
        starts, found = candidates(text)
        if found:
            marks = set(gold)
            here = [(starts[i], starts[j]) for i, j, _, _ in found]
            truth = np.array([(k, a, b) in marks for (_, _, k, _), (a, b) in zip(found, here)])
            rows.append((len(starts) - 1, found, truth, np.array([f for *_, f in found])))
    rng = random.Random(seed)
    for _ in range(PASSES):
        rng.shuffle(rows)
        for n, found, truth, numbers in rows:
            scores = weights[numbers].sum(axis=1)
            expected = np.exp(marginals(n, found, scores))
            gradient = np.zeros(numbers.shape) + (expected - truth)[:, None]
            touched, place = np.unique(numbers, return_inverse=True)
            g = np.bincount(place.reshape(-1), gradient.reshape(-1)) + L2 * weights[touched]
            square[touched] += g * g
            weights[touched] -= STEP * g / np.sqrt(square[touched])
    return weights


def marginals(n: int, found: list[tuple], scores: np.ndarray) -> np.ndarray:
    """Log probability of each candidate segment."""
    ends, begins = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
    for c, (i, j, _, _) in enumerate(found):
        ends[j].append(c)
        begins[i].append(c)
    alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        alpha[j] = log_sum([alpha[j - 1], *(alpha[found[c][0]] + scores[c] for c in ends[j])])
    for i in range(n - 1, -1, -1):
        beta[i] = log_sum([beta[i + 1], *(beta[found[c][1]] + scores[c] for c in begins[i])])
    return np.array([alpha[i] + scores[c] + beta[j] - alpha[n] for c, (i, j, _, _) in enumerate(found)])


def log_sum(values: list[float]) -> float:
    top = max(values)
    return top if len(values) == 1 else top + math.log(sum(math.exp(v - top) for v in values))


def examples_of(text: str, rng: random.Random) -> list[tuple[str, list[Span]]]:
    """Windows with their base spans, and a rewritten copy of those with an entity."""
    found = base_spans(text)
    out = []
    for a, b in windows(text)[:WINDOWS]:
        if b - a > LONG_WINDOW:
            continue
        gold = [(k, s - a, e - a) for k, s, e in found if a <= s and e <= b]
        window = text[a:b]
        out.append((window, gold))
        if gold:
            out.append(rewritten(window, gold, rng))
    return out


def rewritten(window: str, gold: list[Span], rng: random.Random) -> tuple[str, list[Span]]:
    """The same window with its card and phone numbers written in another way."""
    text, spans, done = "", [], 0
    for kind, a, b in sorted(gold, key=lambda s: s[1]):
        if a < done:
            continue
        span = window[a:b]
        digits = re.sub("[^0-9]", "", span)
        if kind == 2:
            by = rng.choice([" ", "-", "."])
            span = by.join(digits[k : k + 4] for k in range(0, len(digits), 4))
        elif kind == 3 and len(digits) >= 10:
            area, mid, end = digits[-10:-7], digits[-7:-4], digits[-4:]
            span = rng.choice([f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"+{digits[:-10] or 1}-{area}-{mid}-{end}"])
        text += window[done:a]
        spans.append((kind, len(text), len(text) + len(span)))
        text += span
        done = b
    return text + window[done:], spans


@dataclass
class Model:
    weights: np.ndarray = field(repr=False)


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Weights learned from rows that hold a digit or an at-sign: ``sample`` at most, in the order of a hash of their text."""
    rows = df.select(F.col(text_col).alias("text")).where(F.col("text").rlike("[0-9@]") & (F.length("text") <= 20_000))
    chosen = F.broadcast(rows.select(F.xxhash64("text").alias("hash")).distinct().orderBy("hash").limit(sample))  # ``sample`` numbers
    rows = rows.withColumn("hash", F.xxhash64("text")).join(chosen, "hash").dropDuplicates(["hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        examples = [e for place, text in found for e in examples_of(text, random.Random(place))]
        yield pa.record_batch([pa.array([learn(examples).astype(np.float32).tobytes()])], ["weights"])

    # the sample is bounded: one task learns from it
    first = rows.select("hash", "text").repartition(1).mapInArrow(run, "weights binary").first()
    return Model(np.frombuffer(first.weights, np.float32) if first else np.zeros(1 << BITS, np.float32))


def spans_of(text: str | None, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, in the order of kind and start."""
    if not text:
        return [], []
    base = base_spans(text)
    added = []
    if TRIGGER.search(text):
        for a, b in windows(text):
            for kind, s, e in decode(text[a:b], weights):
                if all(e + a <= x or y <= s + a for _, x, y in base):
                    added.append((kind, s + a, e + a))
    return base, sorted(base + added)


def find(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end) in the order of kind and start."""
    weights = model.weights

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [spans_of(t, weights) for t in batch.column(1).to_pylist()]
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        as_rows = [[[{"kind": KINDS[k], "start": s, "stop": e} for k, s, e in side] for side in pair] for pair in both]
        return pa.record_batch([batch.column(0), pa.array([r[0] for r in as_rows], span), pa.array([r[1] for r in as_rows], span)], ["id", "base", "spans"])

    span = "array<struct<kind:string,start:bigint,stop:bigint>>"
    return by_batch(df.select(id_col, text_col), run, f"id {df.schema[id_col].dataType.simpleString()}, base {span}, spans {span}")


def mask(text: str | None, weights: np.ndarray) -> str | None:
    """The text with each span replaced by its kind."""
    if not text:
        return text
    out, done = [], 0
    for kind, a, b in sorted(spans_of(text, weights)[1], key=lambda s: (s[1], -s[2])):
        if b <= done:
            continue
        out += [text[done : max(a, done)], f"<{KINDS[kind]}>"] if a >= done else []
        done = b
    return "".join(out) + text[done:]


def op5_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents")
    found = find(docs, fit(docs))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    return found.select(
        F.col("id").alias("doc_id"),
        *(F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )
