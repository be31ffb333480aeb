"""Joins, searches and the pipeline against brute force, with hot groups and unusual rows."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from shopledger.llm import graph, lines, simhash, suffix, topk
from shopledger.llm.common import held_out, prepare, table
from tests.llm.test_text import LONG, SCHEMA, odd_rows


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", None, 0, "h", 0.0, "x") for i, t in texts], SCHEMA)


def corpus(seed, n=120):
    """Copies, near copies, shared passages and lines, periodic texts, and rows with nothing in them."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(["ta", "ri", "no", "el", "sé", "mu", "ko"]) for _ in range(r.randint(1, 4)))
    line = lambda k: " ".join(word() for _ in range(k))
    shared = [line(90), line(90)]
    base = "\n".join(line(r.randint(2, 40)) for _ in range(12))
    texts = []
    for k in range(n):
        kind = k % 6
        if kind == 0:
            text = "\n".join(line(r.randint(1, 30)) for _ in range(r.randint(1, 8)))
        elif kind == 1:
            text = base
        elif kind == 2:
            words = base.split(" ")
            words[r.randrange(len(words))] = word()
            text = " ".join(words)
        elif kind == 3:
            text = line(20) + "\n" + r.choice(shared) + " " + line(20)
        elif kind == 4:
            text = "And " * r.randint(90, 260) if r.random() < 0.5 else "ab" * r.randint(100, 400)
        else:
            text = r.choice([None, "", " ", "one", "the of and a", "the of and a in"])
        texts.append((k, text))
    return texts + [(5, "a second text of one id"), (7, base), (1, base), (None, base), (None, "no id")]


@pytest.fixture(scope="module", params=[1, 2])
def texts(request):
    return corpus(request.param)


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 800)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    wanted = {(x, find(x)) for x in parent if find(x) != x}
    prepare(spark)
    assert {tuple(x) for x in graph.components(spark.createDataFrame(links, "a long, b long")).collect()} == wanted


def test_simhash(spark, texts):
    prepare(spark)
    found = simhash.near_duplicates(rows_of(spark, texts)).toPandas()
    fps = []
    for _, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))] if words else []
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(texts)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {g: min((texts[k][0] for k in range(len(texts)) if group[k] == g and texts[k][0] is not None), default=None) for g in set(group)}
    wanted = sorted((str(i), f, str(least[g])) for (i, _), f, g in zip(texts, fps, group))
    clean = lambda x: "None" if x is None or x != x else str(int(x))
    assert sorted((clean(i), int(f) % (1 << 64), clean(c)) for i, f, c in found.itertuples(index=False)) == wanted
    kept = simhash.one_of_each(rows_of(spark, texts))
    assert kept.count() == len(set(group)) and kept.columns == rows_of(spark, texts).columns


def test_linked_pairs_of_chunks():
    r = np.random.default_rng(5)
    fp = r.integers(0, 1 << 64, 40, dtype=np.uint64)
    fp = np.concatenate([fp, fp ^ np.uint64(5), fp ^ np.uint64(1 << 40)])
    a, b = simhash.linked(np.zeros(120, int), np.full(120, 2), fp)
    assert len(a) == 80  # a spanning forest of 40 groups of three
    a, b = simhash.linked(np.zeros(120, int), np.repeat([0, 1], 60), fp)
    assert all(np.bitwise_count(x ^ y) <= 3 for x, y in zip(a, b))


@pytest.mark.parametrize("shard", [1 << 20, 3000])
def test_suffix(spark, texts, shard, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(suffix, "SHARD", shard)  # with a small one, shards meet by binary search
    found = suffix.without_repeats(rows_of(spark, texts).coalesce(2)).collect()
    count = {}
    data = [(t or "").encode() for _, t in texts]
    for d in data:
        for k in range(len(d) - 399):
            count[d[k : k + 400]] = count.get(d[k : k + 400], 0) + 1
    wanted = []
    for (i, _), d in zip(texts, data):
        covered = [False] * len(d)
        for k in range(len(d) - 399):
            if count[d[k : k + 400]] > 1:
                covered[k : k + 400] = [True] * 400
        runs = sum(c and (not k or not covered[k - 1]) for k, c in enumerate(covered))
        wanted.append((str(i), len(d), runs, bytes(x for x, c in zip(d, covered) if not c)))
    assert sorted((str(r.id), r.n_bytes, len(r.spans), bytes(r.kept)) for r in found) == sorted(wanted)
    assert any(r.spans for r in found)


def covered_by_brute_force(data):
    """Of each text the bytes that stay."""
    count = Counter(d[k : k + 400] for d in data for k in range(len(d) - 399))
    kept = []
    for d in data:
        covered = [False] * len(d)
        for k in range(len(d) - 399):
            if count[d[k : k + 400]] > 1:
                covered[k : k + 400] = [True] * 400
        kept.append(bytes(x for x, c in zip(d, covered) if not c))
    return kept


def test_regions_of_a_hot_anchor_are_not_dealt_two_by_two(spark, monkeypatch):
    """One header in all documents, and one of 50 second passages: what the shards are dealt grows with the regions."""
    prepare(spark)
    monkeypatch.setattr(suffix, "SHARD", 3000)
    r = random.Random(12)
    word = lambda: "".join(r.choice(["ta", "ri", "no", "el", "sé", "mu", "ko"]) for _ in range(r.randint(1, 4)))
    line = lambda k: " ".join(word() for _ in range(k))
    header, seconds = line(110), [line(40) for _ in range(50)]
    texts = [(k, f"{line(r.randint(1, 70))} {header} {r.choice(seconds)} {line(r.randint(1, 50))}") for k in range(240)]
    dealt = []

    def counted(rows):
        dealt.append(rows.agg(F.count("*").alias("n"), F.countDistinct("hash", "region").alias("regions")).first())
        return searched(rows)

    searched = suffix.searched
    monkeypatch.setattr(suffix, "searched", counted)
    found = suffix.without_repeats(rows_of(spark, texts)).collect()
    data = [t.encode() for _, t in texts]
    assert [bytes(x.kept) for x in sorted(found, key=lambda x: x.id)] == covered_by_brute_force(data)
    assert len(dealt) > 1 and dealt[0].regions and all(x.n <= suffix.MEET * x.regions for x in dealt)


@pytest.mark.parametrize("width", [48, 6, 1])
def test_pieces_hold_every_string_of_a_region_once(width):
    """Equal strings lie in pieces of one core and block; a piece of one distance is its core."""
    r = random.Random(3)
    shared = "".join(r.choice("abcdefgh") for _ in range(700))
    texts = ["".join(r.choice("abcdefgh") for _ in range(n)) + shared + "".join(r.choice("abcdefgh") for _ in range(n)) for n in (0, 5, 300)]
    texts += ["ab" * 300, "x" * 450]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    _, first, last = suffix.anchors(data, np.cumsum([len(t) for t in texts]))
    regions = [data[a : b + suffix.LENGTH] for a, b in zip(first, last)]
    ends = np.cumsum([len(x) for x in regions])
    whole = np.concatenate(regions).tobytes()
    keys, starts = {}, []
    for of, begin, end, core, core_end, block in zip(*(x.tolist() for x in suffix.pieces(np.frombuffer(whole, np.uint8), ends, width))):
        assert 0 < end - begin - suffix.LENGTH + 1 <= width and begin <= core < core_end <= end
        assert ends[of] - len(regions[of]) <= begin and end <= ends[of]
        assert width > 1 or (begin, end) == (core, core_end)
        for k in range(begin, end - suffix.LENGTH + 1):
            starts.append(k)
            assert keys.setdefault(whole[k : k + suffix.LENGTH], (block, whole[core:core_end])) == (block, whole[core:core_end])
    assert sorted(starts) == [int(k) for a, b in zip(ends - [len(x) for x in regions], ends) for k in range(a, b - suffix.LENGTH + 1)]


def test_regions_are_cut_to_strings_that_may_repeat():
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefgh") for _ in range(n)).encode()
    shared = text(410)
    rows = [(1, 2, 9, k, (0, k), 1000, d) for k, d in enumerate([text(20) + shared + text(30), text(500), text(400), shared[:405]])]
    rows.append((2, 2, 9, 4, (0, 4), 0, shared))  # of another shard
    assert suffix.pruned(rows) == [(1, 2, 9, 0, (0, 0), 1020, shared[:405], 20), (1, 2, 9, 3, (0, 3), 1000, shared[:405], 0)]


def test_suffix_array_and_prefixes():
    r = random.Random(6)
    regions = ["".join(r.choice("ab") for _ in range(r.randint(1, 60))).encode() for _ in range(30)] + [b"ab" * 300] * 2
    shard = suffix.Shard(regions, np.arange(len(regions)) << 40)
    suffixes = [(x[k:], n) for n, x in enumerate(regions) for k in range(len(x))]
    order = sorted(range(len(suffixes)), key=lambda k: suffixes[k])
    assert shard.order.tolist() == order
    common = suffix.kasai(shard.text, shard.starts, shard.sizes, shard.ends, shard.order, shard.rank)
    for a, b in zip(order, order[1:]):
        x, y = suffixes[a][0], suffixes[b][0]
        n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert common[b] == (min(n, suffix.LENGTH) if len(y) >= suffix.LENGTH else 0)


@pytest.mark.parametrize("common", [1 << 15, 3])
def test_lines(spark, texts, common, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(lines, "COMMON", common)  # with a small one, words are paired in the keys
    df = rows_of(spark, texts)
    found = lines.without_similar_lines(df).collect()
    assert len(found) == len(texts)
    docs = {(i, t): xxhash.xxh64_intdigest(t.encode(), 42) for i, t in texts if t is not None}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    seen, wanted = [], {}
    for i, t in sorted(docs, key=lambda k: (-1 if k[0] is None else k[0], signed(docs[k]))):
        kept = []
        for text in t.split("\n"):
            words = frozenset(text.encode().split())
            if words and any(9 * len(words & x) >= 4 * (len(words) + len(x)) for x in seen):
                seen.append(words)
                continue
            seen += [words] if words else []
            kept.append(text)
        wanted[(i, t)] = "\n".join(kept)
    assert sorted((str(r.doc_id), str(r.text)) for r in found) == sorted((str(i), str(wanted.get((i, t), t))) for i, t in texts)


def test_words_of_a_text_are_told_apart_within_little_memory():
    """Words that differ in one byte, also by a NUL or in length, at all lengths; few bytes are held per byte of text."""
    words = [w for n in (*range(1, 20), 63, 64, 65, 66, 200) for w in ("a" * n, "a" * (n - 1) + "b", "a" * n + "\0", "\0" * n)]
    texts = ["", " \n ", *words, " ".join(words), "\n\t".join(words) + "\x0b\x0c\r"]
    hashes, line, first = lines.words_of(texts)
    flat = [(w, n) for n, part in enumerate("\n".join(texts).split("\n")) for w in part.encode().split()]
    assert line.tolist() == [n for _, n in flat] and first.tolist()[:4] == [0, 1, 3, 4]
    assert len(set(zip([w for w, _ in flat], hashes.tolist()))) == len({w for w, _ in flat}) == len(set(hashes.tolist()))
    text = " ".join(f"word{k}" for k in range(100_000))
    tracemalloc.start()
    lines.words_of([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(text)


@pytest.mark.parametrize("sizes", [(65530, 65540), (70000, 70000)])
def test_lines_of_more_words_than_16_bits_count(spark, sizes):
    prepare(spark)
    a, b = ([f"w{k}" for k in range(n)] for n in sizes)
    b[:5] = [f"other{k}" for k in range(5)]
    found = lines.without_similar_lines(rows_of(spark, [(1, " ".join(a)), (2, " ".join(b))])).collect()
    assert {r.doc_id: r.lines_removed for r in found} == {1: 0, 2: 1}


@pytest.mark.parametrize("common", [1 << 15, 3])
def test_hot_words_meet_in_blocks(spark, common, monkeypatch):
    """Template lines of 20 words of which two vary: small blocks give the same result, and no task holds a whole word."""
    prepare(spark)
    r = random.Random(9)
    fixed = [f"fixed{k}" for k in range(18)]
    df = rows_of(spark, [(k, " ".join(fixed + [f"a{r.randrange(90)}", f"b{r.randrange(90)}"])) for k in range(400)])
    monkeypatch.setattr(lines, "COMMON", common)
    wanted = sorted(lines.without_similar_lines(df).select("doc_id", "text").collect())
    monkeypatch.setattr(lines, "HOT", 32)
    assert sorted(lines.without_similar_lines(df).select("doc_id", "text").collect()) == wanted
    docs = df.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), "text")
    sets = lines.described(docs, lines.rarity(docs, "text"))
    deal = lines.Deal(lines.posting_counts(sets), 16, 32)
    held = {}
    for part, data in lines.dealt(sets, deal).collect():
        held.setdefault(part, []).extend(np.frombuffer(bytes(data), lines.POSTING)["key"].tolist())
    assert len(deal.hot) and max(keys.count(k) for keys in held.values() for k in set(keys)) <= 4 * 32


@pytest.mark.parametrize("crowd", [1024, 8])
def test_near_duplicate_stage_keeps_one_of_each_group(spark, crowd, monkeypatch):
    """All links of brute force over the fingerprints, among copies with some changed words."""
    prepare(spark)
    monkeypatch.setattr(simhash, "CHUNK", crowd)
    r = random.Random(11)
    texts = corpus(3, 60)
    for k in range(200, 230):
        base = [f"w{r.randrange(400)}" for _ in range(r.randint(200, 400))]
        texts.append((k, " ".join(base)))
        for n in range(3):
            words = list(base)
            for _ in range(n):
                words[r.randrange(len(words))] = f"x{r.randrange(9999)}"
            texts.append((1000 + 4 * k + n, " \n".join(words).upper()))
    prints = [simhash.fingerprint(t) for _, t in texts]
    group, pairs = list(range(len(texts))), 0
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                pairs += prints[a] != prints[b]
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = lambda ids: min(ids, key=lambda i: (i is not None, i or 0))
    wanted = [least([texts[k][0] for k in range(len(texts)) if group[k] == g]) for g in set(group)]
    found = corpus_pipeline.drop_near_duplicates(spark, rows_of(spark, texts), "")
    assert pairs > 5 and sorted(map(str, wanted)) == sorted(str(x.doc_id) for x in found.select("doc_id").collect())


@pytest.mark.parametrize("pack", [64, 1])
def test_top_k(spark, pack, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(topk, "PACK", pack)
    r = np.random.default_rng(7)
    vectors = [(k, r.normal(size=8).tolist(), "x") for k in range(300)] + [(k, [1.0] * 8, "x") for k in range(300, 420)]
    vectors += [(500, None, "x"), (501, [1.0, None], "x"), (520, [float("nan")] * 8, "x"), (540, [float("inf")], "x"), (560, [2.0], "x"), (None, [1.0], "x"), (3, [1.0] * 8, "x")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score string")
    found = topk.top_k(df.where("vec_id % 20 = 0"), df).collect()
    able = [(i, np.r_[np.floor(64 * np.array(v)), np.zeros(8 - len(v))].astype(int)) for i, v, _ in vectors if i is not None and v and None not in v and np.isfinite(v).all()]
    wanted = set()
    for i, q in able:
        if i % 20 == 0:
            best = sorted((-int(q @ v), j) for j, v in able if j != i)[:20]
            wanted |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    assert {(x.query_id, x.rank, x.vec_id, x.score) for x in found} == wanted and len(found) == len(wanted)
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0


def test_top_k_of_repeated_queries_and_large_values(spark):
    prepare(spark)
    r = np.random.default_rng(3)
    rows = [(k, r.normal(size=4).tolist()) for k in range(60)] + [(20, [9.0, 0.0, 0.0, 0.0]), (20, [-9.0, 0.0, 0.0, 0.0])]
    rows += [(101, [1e300, 0.0, 0.0, 0.0]), (102, [-1e300, 1e17, 0.0, 0.0]), (120, [1e300, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df.where("vec_id % 20 = 0"), df, 5).collect()
    low, high = 1 - (1 << 63), (1 << 63) - 1
    whole = lambda v: [min(max(math.floor(64 * x), low), high) for x in v]
    queries = {}
    for i, v in rows:
        if i % 20 == 0:
            queries[i] = min(queries.get(i, whole(v)), whole(v))
    wanted = set()
    for i, q in queries.items():
        scores = sorted((-min(max(sum(a * b for a, b in zip(q, whole(v))), low), high), j) for j, v in rows if j != i)
        wanted |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:5])}
    assert {tuple(x) for x in found} == wanted and len(found) == len(wanted) == 20


def test_top_k_carries_the_kth_score_between_packs(spark, monkeypatch):
    """A task gives out the best k of a query once, however many groups it searches."""
    prepare(spark)
    monkeypatch.setattr(topk, "PACK", 1)
    monkeypatch.setattr(topk, "BLOCK", 8)
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(k, r.normal(size=4).tolist()) for k in range(80 * 8)], "vec_id long, embedding array<double>").coalesce(1)
    rows = topk.candidates(df.where("vec_id = 20"), df, 5).count()
    assert 5 <= rows <= 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_operators_on_an_empty_table(spark):
    prepare(spark)
    empty = rows_of(spark, [(1, "x")]).limit(0)
    assert lines.without_similar_lines(empty).count() == 0 and suffix.without_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_pipeline_stages(spark, tiny, tmp_path):
    """Each stage on what the one before kept, with unusual rows and more columns added."""
    docs = table(spark, tiny, "documents").limit(80).unionByName(
        spark.createDataFrame(odd_rows([(9, LONG), (10, "call +1 (308) 555-3711 or mail a.b@mail.example.com for it")]), SCHEMA).withColumn("lang", F.lit(None).cast("string")),
        allowMissingColumns=True,
    )
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, tiny).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.columns == before.columns
        if name == "language":
            assert docs.where("text is null or trim(text) = ''").count() == 0 and docs.where("lang is null").count() == 0
        if name == "near_duplicates":
            assert docs.where("doc_id in (5, 9) and text like '%quick%'").count() <= 1
        if name == "personal_data":
            assert docs.where("doc_id = 10 and text = 'call <phone> or mail <email> for it'").count() == 1
    assert docs.count() and corpus_pipeline.run(spark, tiny).count()


@pytest.mark.parametrize("lang", [None, "en"])
def test_language_stage_without_labels(spark, lang):
    """No row to learn from (none has a language, or held-out ones only): texts with a letter stay as they are."""
    prepare(spark)
    df = rows_of(spark, [(k, t) for k, t in enumerate(["a text", "é", None, "", "12 34 !", "x1"] * 4)])
    df = df.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit(lang)).cast("string"))
    found = corpus_pipeline.identify_language(spark, df, "")
    assert sorted(map(str, found.collect())) == sorted(map(str, df.where("text in ('a text', 'é', 'x1')").select(*found.columns).collect()))


def test_pipeline_on_an_empty_table(spark, tiny, tmp_path):
    docs = table(spark, tiny, "documents").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tiny).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0


def test_texts_of_many_lines_are_split_once(spark):
    """A long text of equal lines, and one of lines that are all its own: linear in the lines."""
    prepare(spark)
    texts = [(1, "\n".join(["a line of some words here"] * 30_000)), (2, "\n".join(f"line {k} with own words w{k} v{k}" for k in range(20_000)))]
    texts += [(3, "\n\na line of some words here\n\n"), (4, None), (5, "")]
    found = {r.doc_id: (r.text, r.lines_removed) for r in lines.without_similar_lines(rows_of(spark, texts)).collect()}
    assert found == {1: ("a line of some words here", 29_999), 2: (texts[1][1], 0), 3: ("\n\n\n", 1), 4: (None, 0), 5: ("", 0)}
