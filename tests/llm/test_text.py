"""Operators on single texts against the public tokenizers, brute force and held-out rows, with unusual rows."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopledger.llm import bpe, classifier, langid, packing, pii, rules
from shopledger.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, hash string, score double, lang_pred string"
LONG = ("the quick brown fox jumps over 17 lazy dogs, isn't it? " * 4000) + "x" * 5000


def odd_rows(more=()):
    texts = [(1, "Hello wörld <|endoftext|> it's\t1234 ok"), (1, "Hello wörld <|endoftext|> it's\t1234 ok"), (2, None), (3, ""), (None, "no id here"),
             (4, " \n\n  "), (5, LONG), (6, "ΣΑΣ ½ a\x1cb c 😀 ́"), (7, "12 34"), *more]
    return [(i, t, None, "s", None, 0, "h", 0.0, "x") for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, tiny):
    prepare(spark)
    return spark.read.parquet(f"{tiny}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_equals_the_library(docs, odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for df in (docs, odd):
        texts = {(r.doc_id, r.text) for r in df.collect()}
        found = bpe.encode(df.select("doc_id", "text"), path).collect()
        assert len(found) == df.count()
        by_id = {i: t for i, t in texts}
        for r in found:
            ids = library.encode(by_id[r.id] or "", add_special_tokens=False).ids
            assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(empty, path).count() == 0


def test_bpe_scan_and_heap_merge_alike():
    words = bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    for word in ("internationalisation", "aaaaaaaaaaaaaaa", "ththththththe", "x"):
        parts = [words.inner[b] for b in word.encode()]
        parts[-1] = words.last[word.encode()[-1]]
        assert bpe.merged(list(parts), words.merges) == bpe.merged_long(list(parts), words.merges)


def check_packed(df, window, **options):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    pieces = packing.pack(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), window=window, **options).toPandas()
    wanted = Counter()
    for r in df.select("doc_id", "text").collect():
        wanted[(r.doc_id, tuple(library.encode(r.text or "", add_special_tokens=False).ids + [0]))] += 1
    pieces["length"] = pieces.ids.map(len) // 4
    whole, last = Counter(), {}
    if len(pieces):
        assert pieces.groupby("sequence_id").length.sum().max() <= window
        for _, part in pieces.sort_values("offset").groupby("sequence_id"):
            assert list(part.offset) == list(part.length.cumsum() - part.length)
    for (i, n), part in pieces.fillna({"id": -1}).groupby(["id", "doc_tokens"]):
        assert part.length.sum() % n == 0
    assert sum(len(k[1]) * c for k, c in wanted.items()) == (pieces.length.sum() if len(pieces) else 0)
    for r in pieces.itertuples():
        ids = np.frombuffer(r.ids, "<u4")
        assert any((i == r.id or r.id != r.id) and len(t) == r.doc_tokens and list(t[r.start : r.start + r.length]) == ids.tolist() for i, t in wanted)


def test_packing(docs, odd, empty):
    check_packed(docs.limit(60), 1024)
    check_packed(odd, 64, group=3)
    check_packed(empty, 1024)


def test_best_fit_takes_the_tightest_window():
    placed, windows = packing.best_fit([6, 5, 4, 5, 4, 3], 10)
    assert windows == 3 and [w for w, _ in placed] == [0, 1, 0, 1, 2, 2]
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 3000).tolist()
    placed, windows = packing.best_fit(lengths, 100)
    room = {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):  # by brute force
        able = [(left, w) for w, left in room.items() if left >= lengths[k]]
        left = min(able)[0] if able else 100
        assert placed[k][1] == 100 - left
        room[placed[k][0]] = left - lengths[k]
    assert len(room) == windows


def test_rule_statistics(docs, odd):
    for df in (docs, odd):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in rules.rule_statistics(df).collect():
            text = texts[r.id] or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            grams = Counter(zip(words, words[1:], words[2:]))
            covered = {k + d for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for d in range(3)}
            lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            wanted = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == wanted


def test_isolation_forest_finds_outliers():
    rng = np.random.default_rng(3)
    sample = np.r_[rng.normal(0, 1, (500, 3)), rng.normal(9, 1, (10, 3))]
    paths = rules.Forest(sample).path_length(np.array([[0.0, 0, 0], [9, 9, 9]]))
    assert paths[1] < paths[0]


def test_rules_judge(spark, docs, odd, empty, tiny):
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    known = rules.judge(docs, labels).join(labels, F.col("id") == F.col("doc_id")).toPandas()
    good = known[(known.quality == 1) & ~known.base_failed]
    assert good.kept.mean() > 0.97 and not known[known.quality == 0].kept.all()
    assert rules.judge(odd, labels.limit(0)).count() == odd.count() and rules.judge(empty, labels).count() == 0


def test_classifier_on_held_out_rows(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    weights = classifier.fit(docs, labels)
    scored = classifier.score(docs, weights).join(labels, F.col("id") == F.col("doc_id")).where(F.crc32(F.col("id").cast("string")) % 4 == 2).toPandas()
    assert scored[scored.quality == 1].score.min() > scored[scored.quality == 0].score.median()
    assert scored.score.between(0, 1).all()
    odd_scores = classifier.score(odd, weights).collect()
    assert len(odd_scores) == odd.count() and all(0 <= r.score <= 1 for r in odd_scores)
    assert classifier.score(empty, classifier.fit(empty, labels)).count() == 0
    assert {r.score for r in classifier.score(odd, classifier.fit(docs, labels.limit(0))).collect()} == {0.5}


def base_by_pattern(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) < 256 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_base_patterns(docs):
    texts = [r.text for r in docs.collect()] + [
        "a@b.c@d.e x@@y.z 1.2.3.4.5.6.7.8 1.2.3.400.5.6.7.8 001.2.3.4 4111 1111-1111 1111 +1+22 333 4444 +12 ()", "é@x.y ..a.b@c-.d.", "4111111111111111 0000000000000000000000",
    ]
    for text in texts:
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == base_by_pattern(text)


def test_personal_data_beyond_the_patterns(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(docs)
    text = "ring eronthe (308) 555-3711 or thst 415-555-0199 thanon erwh"
    assert {text[a:b] for _, a, b in pii.spans_of(text, model.weights)[1]} == {"(308) 555-3711", "415-555-0199"}
    assert pii.mask("mail a.b@mail.example.com now", model.weights) == "mail <email> now"
    for clean in ("In 2024 about 1,500,000 of 3.14 and 12:30 on 2023-01-02", "version 3.0.1 of 7 parts", ""):
        assert pii.spans_of(clean, model.weights) == ([], [])
    assert pii.find(odd, model).count() == odd.count() and pii.find(empty, pii.fit(empty)).count() == 0
    assert len(pii.base_spans("1" * 200_000 + "@" * 1000)) == 0  # in no more than linear time


def test_segments_by_brute_force():
    rng = np.random.default_rng(8)
    found = [(0, 2, 0, [1]), (1, 3, 1, [2]), (2, 4, 2, [3]), (3, 4, 3, [4])]
    scores = rng.normal(size=4)
    readings = [c for c in range(16) if not (c & 1 and c & 2) and not (c & 2 and c & 4) and not (c & 4 and c & 8)]
    weight = {c: np.exp(sum(scores[k] for k in range(4) if c >> k & 1)) for c in readings}
    wanted = [sum(w for c, w in weight.items() if c >> k & 1) / sum(weight.values()) for k in range(4)]
    assert np.allclose(np.exp(pii.marginals(4, found, scores)), wanted)


def test_forward_backward_by_brute_force():
    rng = np.random.default_rng(9)
    emission, transition, lengths = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), np.array([2, 3])
    gamma, expected = langid.forward_backward(emission, lengths, transition)
    wanted, moves, at = np.zeros((5, 2)), np.zeros((2, 2)), 0
    for n in lengths:
        paths = [[c >> k & 1 for k in range(n)] for c in range(1 << n)]
        w = np.exp([sum(emission[at + k, x] for k, x in enumerate(p)) + sum(transition[a, b] for a, b in zip(p, p[1:])) for p in paths])
        for p, v in zip(paths, w / w.sum()):
            for k, x in enumerate(p):
                wanted[at + k, x] += v
            for a, b in zip(p, p[1:]):
                moves[a, b] += v
        at += n
    assert np.allclose(gamma, wanted) and np.allclose(expected, moves)


def test_language(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    found = langid.predict(docs, model).withColumnRenamed("id", "doc_id").join(docs, "doc_id").toPandas()
    held = found[[zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]]
    assert (held.lang == held.lang_pred).mean() > 0.97
    by_text = {r.id: r for r in langid.predict(odd, model).collect()}
    assert by_text[2].lang_pred == by_text[3].lang_pred == by_text[4].lang_pred == by_text[7].lang_pred == "und" and by_text[2].score == 0
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    texts = {r.lang: r.text for r in docs.where("lang in ('en', 'fr')").orderBy(F.desc("doc_id")).limit(200).collect()}
    switched = langid.labeller(model).labels(" ".join(texts["en"].split()[:12] + texts["fr"].split()[:12]))
    assert [x for _, x in switched[1:10]].count("en") >= 8 and [x for _, x in switched[14:23]].count("fr") >= 8


@pytest.mark.parametrize("sign", [" ", "\n", "\t", "　"])
def test_packing_of_a_million_white_spaces(spark, sign):
    """Ids equal those of the tokenizers library, in the middle, at the start and at the end of a text."""
    prepare(spark)
    n = 1_000_000 if sign == " " else 200_000
    texts = [f"a{sign * n}b", f"{sign * n}", f"{sign * 12_000} x<|endoftext|>\t{sign * 12_000}1", f"a{sign * 9_999} {sign * 10_001}'s"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for text in texts:
        assert np.frombuffer(packing.ids_of(text, path), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    assert packing.pack(df, path).agg(F.max("doc_tokens")).first()[0] == len(library.encode(texts[0], add_special_tokens=False).ids) + 1
