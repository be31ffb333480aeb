"""Byte-level BPE, spelling variants and ranked search: against the library, SQL and brute force, with unusual rows."""

import base64
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shopledger.llm import bytebpe, ranking, spelling
from shopledger.llm.common import prepare

SCHEMA = "doc_id long, text string, id string, ids string, word string, n long, piece int, score double"


def rows(texts):
    return [(i, t, "x", "y", "w", 7, 1, 0.5) for i, t in texts]


@pytest.fixture(scope="module")
def ready(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="module")
def database(tiny):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    return con


# ---- byte-level BPE

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(df, **options):
    return bytebpe.decode(bytebpe.encode(df, PATH, PATTERN, **options), PATH, PATTERN).collect()


def check_coded(library, texts, found):
    wanted = Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in texts)
    assert Counter((r.id, bytes(r.ids), bytes(r.decoded)) for r in found) == wanted


@pytest.mark.parametrize("chunk, overlap", [(16, 8), (7, 6), (40, 10)])
def test_stitched_chunks_give_the_ids_of_the_whole(ready, library, chunk, overlap):
    rnd = random.Random(chunk)
    signs = ["a", "b", "'", "s", "re", " ", "\n", "1", "２", "é", "ß", "。", "漢", "　", "'ll", "!", "\x1c", "\x85", "😀", "́"]
    texts = [(i, "".join(rnd.choice(signs) * rnd.choice([1, 1, 1, 2, 3, 40]) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    check_coded(library, texts, coded(ready.createDataFrame(rows(texts), SCHEMA), chunk=chunk, overlap=overlap))


def test_byte_bpe_of_unusual_rows(ready, library):
    texts = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (4, " " * 100_000), (5, "a" + "\t" * 70_000 + "b"),
             (6, "x" * 70_000), (7, "<|endoftext|>"), (8, "\x00ჿff ok"), (9, "wörd \n\n " * 20_000)]
    check_coded(library, texts, coded(ready.createDataFrame(rows(texts), SCHEMA)))
    assert coded(ready.createDataFrame([], SCHEMA)) == []
    blank = " " * 1_000_000  # more than the library's pattern can take, not its merges
    (found,) = coded(ready.createDataFrame(rows([(1, f"a{blank}b")]), SCHEMA))
    ids = [*library.encode_ordinary("a"), *library._encode_single_piece(blank[1:]), *library.encode_ordinary(" b")]
    assert bytes(found.ids) == np.array(ids, "<u4").tobytes() and bytes(found.decoded) == f"a{blank}b".encode()


def test_byte_bpe_of_the_documents(ready, tiny, library):
    docs = ready.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    check_coded(library, [tuple(r) for r in docs.collect()], coded(docs, chunk=5000, overlap=100))


def test_character_classes_are_those_of_the_library():
    letters, other = re.compile(f"[{bytebpe.character_class(r'\p{L}')}]"), re.compile(f"[{bytebpe.character_class(r'\s')}]")
    assert all(map(letters.match, "aéß漢ªʰ")) and not any(map(letters.match, "1_ ́½"))
    assert all(map(other.match, " \t\x85　")) and not any(map(other.match, "\x1c​"))


# ---- spelling variants


def edits(a, b):
    """True if exactly one code point is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) == len(short) + 1 and any(long_[:k] + long_[k + 1 :] == short for k in range(len(long_)))


def variants_of(texts, one_in=97):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if one_in and h % one_in == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w)] for w in words}
    form = {w: min(near[w], key=lambda v: (-words[v], v)) for w in words if near[w]}
    form = {w: f for w, f in form.items() if words[f] >= 2 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, n, len(near[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items()}


def spelled(df, **options):
    found = [tuple(r) for r in spelling.variants(df, **options).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(set(found)) == len(found)
    return set(found)


@pytest.mark.parametrize("symbols, block", [(8, 1024), (2, 3)])
def test_variants_equal_brute_force(ready, symbols, block):
    rnd = random.Random(symbols)
    stems = ["".join(rnd.choice("abÀÿßz") for _ in range(rnd.randint(4, 7))) for _ in range(60)]
    texts = [(i, " ".join(rnd.choice(stems[: 60 - i % 50]) + rnd.choice(["", "", "X", "é7", "œ"]) for _ in range(40))) for i in range(60)]
    texts += [(None, "null id words words words"), (5, None), (6, ""), (7, "Long" + "a" * 300 + " "), (7, ("b" * 200 + " ") * 3), (7, ("b" * 201 + " ") * 6)]
    df = ready.createDataFrame(rows(texts), SCHEMA)
    found = spelled(df, symbols=symbols, block=block)
    assert found == variants_of(texts)
    assert any(f[3] for f in found)
    assert spelled(df, one_in=2, symbols=symbols, block=block) == variants_of(texts, 2)


def test_a_chain_of_forms_ends_at_its_last(ready):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    texts = [(k, " ".join([w] * (3 * 2**k))) for k, w in enumerate(chain)]
    found = spelled(ready.createDataFrame(rows(texts), SCHEMA), one_in=None)
    assert {f[5] for f in found} == {"bbbbb"} and sum(f[3] is None for f in found) == 1


def test_spelling_of_the_documents_equals_sql(ready, tiny, database):
    found = spelling.op11_spelling(ready, tiny)
    assert {tuple(r) for r in found.collect()} == set(database.execute(spelling.SPELLING_SQL).fetchall())
    assert spelling.variants(ready.createDataFrame([], SCHEMA)).count() == 0


def test_checksums_carry_on_behind_a_prefix():
    starts = np.array([zlib.crc32(p) for p in (b"1:", b"", b"123456:")], np.uint32)
    for word in (b"", b"word", "wörter".encode(), b"x" * spelling.TABLED):
        assert list(spelling.behind(starts)[:, len(word)] ^ np.uint32(zlib.crc32(word))) == [zlib.crc32(p + word) for p in (b"1:", b"", b"123456:")]


def test_neighbourhoods_hold_every_word_one_edit_away():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 6))) for _ in range(120)]
    which, keys = spelling.Reduced(words, 3).neighbours()
    met = defaultdict(set)
    for k, key in zip(which.tolist(), keys.tolist()):
        met[words[k]].add(key)
    own = dict(zip(words, spelling.Reduced(words, 3).hashes().tolist()))
    for a in set(words):
        for b in set(words):
            if edits(a, b):
                assert own[b] in met[a] or own[a] in met[b]


# ---- ranked search


def ranked_of(docs, items, k):
    def terms(text):
        lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = set()
    for item, ts in wanted.items():
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out |= {(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:k], 1)}
    return out


def searched(documents, items, **options):
    found = [tuple(r) for r in ranking.search(documents, items, **options).select("item", "rank", "doc", "score").collect()]
    assert len(set(found)) == len(found)
    return set(found)


@pytest.mark.parametrize("options", [{"k": 3, "docs": 5, "first": 1}, {"k": 10, "terms": 50, "per_pack": 2, "first": 2}, {"k": 200}])
def test_search_equals_brute_force(ready, monkeypatch, options):
    rnd = random.Random(options["k"])
    words = ["Alpha", "beta", "gamma", "délta", "ÉPSILON", "x1", "漢字", "rare", "a'b", "zeta"]
    docs = [(i, " ".join(rnd.choices(words, range(10, 0, -1), k=rnd.randint(1, 30)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, " ., "), (None, "rare rare"), (7, docs[7][1]), (600, "beta " * 20_000), (601, "y" * 30_000)]
    items = [(1, "alpha RARE délta"), (2, "x1 beta zeta gamma"), (3, "nothing here"), (4, None), (5, ""), (None, "漢字"), (6, "rare"), (6, "zeta rare"), (8, "beta")]
    got = searched(ready.createDataFrame(rows(docs), SCHEMA), ready.createDataFrame(rows(items), SCHEMA), item_col="doc_id", **options)
    assert got == ranked_of(docs, items, options["k"])
    monkeypatch.setattr(ranking, "SENT", 0)  # as packs too large to be sent whole
    assert got == searched(ready.createDataFrame(rows(docs), SCHEMA), ready.createDataFrame(rows(items), SCHEMA), item_col="doc_id", **options)


def test_search_of_the_documents_equals_sql(ready, tiny, database):
    assert {tuple(r) for r in ranking.op13_ranking(ready, tiny).collect()} == set(database.execute(ranking.RANKING_SQL).fetchall())


def test_search_of_empty_tables(ready):
    empty, some = ready.createDataFrame([], SCHEMA), ready.createDataFrame(rows([(1, "word")]), SCHEMA)
    assert searched(empty, some, item_col="doc_id") == searched(some, empty, item_col="doc_id") == set()


def test_reading_stops_before_the_lists_end():
    """The best document is met at once everywhere, so the long tail is never read."""

    class Watched(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Watched.read += len(range(*key.indices(len(self))))
            return np.asarray(super().__getitem__(key))

    docs = [np.arange(1000).view(Watched) for _ in range(2)]
    impacts = np.concatenate([[10_000], np.full(999, 10)])
    rows_, scores = ranking.nra([(d, impacts) for d in docs], 1000, 1, first=2)
    assert list(rows_) == [0] and list(scores) == [20_000] and Watched.read <= 8
