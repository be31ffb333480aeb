"""Groups of spelling variants by a reduced alphabet.

Words are counted over all texts. Every letter is hashed to one of ``SYMBOLS`` symbols; two words one edit apart have
reduced words that are equal or one edit apart. For every distinct reduced word its one-edit neighbourhood is generated,
as hashes, and joined with the reduced vocabulary. Being neighbours is mutual, so that a pair of reduced words is joined
from one of its sides only: by the replacements that hash higher, and by the deletions (the insertions seen from the
shorter word). The words behind two reduced words that meet are verified on their original strings.

A reduced word with many words is dealt to blocks of about ``BLOCK``, so that none meets a whole group in one task.
Forms are followed to the last one by doubling: the number of steps is the logarithm of the longest chain.

Words are runs of ASCII letters and of U+00C0 to U+00FF. A run of a document whose hash is divisible by ``ONE_IN`` loses
a letter first, as the query's contract asks; ``one_in=None`` counts texts as they are. Null and empty texts have no
words, a null id reads as the empty text in the hash. Repeated rows count as often as they occur. Equal counts are
decided by the smaller word in the order of code points. Empty tables give no rows. Columns other than the id and the
text are not read. Reduced words are told apart by 64 bits; a chance meeting is removed by the verification.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, slices, table
from shopledger.session import store

#: Symbols of the reduced alphabet, and the words of one reduced word that meet others in one block.
SYMBOLS, BLOCK = 8, 1024
#: Least code points and occurrences of a word, and the share of runs that lose a letter.
SHORTEST, LEAST, ONE_IN = 5, 3, 97
#: Distinct words, and their bytes, that a task counts before it gives them out.
HELD_WORDS, HELD_BYTES = 400_000, 64 << 20
#: Bytes up to which a run's checksum behind a document's prefix comes from a table.
TABLED = 64
#: Odd multiplier of the hashes of reduced words, its inverse, and the share of the length.
BASE, LENGTHS = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


def crc_table() -> np.ndarray:
    """What one byte does to a CRC-32 (reflected polynomial EDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


def behind(prefixes: np.ndarray) -> np.ndarray:
    """Row k, column n: the checksum k carried on over n bytes; xor a run's own checksum it is that of both together."""
    table_, out = crc_table(), np.empty((len(prefixes), TABLED + 1), np.uint32)
    out[:, 0] = prefixes
    for n in range(1, TABLED + 1):
        out[:, n] = (out[:, n - 1] >> 8) ^ table_[out[:, n - 1] & 255]
    return out


class Known(dict):
    """Runs (one byte per code point) -> their numbers, with checksum, bytes in UTF-8 and code points of each."""

    def __init__(self):
        super().__init__()
        self.runs: list[bytes] = []
        self.crc, self.utf8, self.points = array("I"), array("Q"), array("Q")
        self.held = 0

    def __missing__(self, run: bytes) -> int:
        data = run if run.isascii() else run.decode("latin-1").encode()
        self.crc.append(zlib.crc32(data))
        self.utf8.append(len(data))
        self.points.append(len(run))
        self.runs.append(run)
        self.held += len(run)
        self[run] = number = len(self.runs) - 1
        return number


def counts(df: DataFrame, id_col: str, text_col: str, shortest: int, one_in: int | None) -> DataFrame:
    """(word, n): occurrences, as far as each task has counted them."""
    find = re.compile(rb"[a-z\xc0-\xff]{%d,}" % shortest).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, whole, changed = Known(), np.zeros(0, np.int64), Counter()

        def out() -> Iterator[pa.RecordBatch]:
            found = np.flatnonzero(whole)
            words = [known.runs[k].decode("latin-1") for k in found.tolist()] + [w.decode("latin-1") for w in changed]
            rows = pa.record_batch([pa.array(words, pa.string()), pa.array([*whole[found].tolist(), *changed.values()], pa.int64())], ["word", "n"])
            yield from slices(rows, 4 << 20)

        for batch in batches:
            for part in slices(batch, 1 << 20):
                # one byte per code point, a sign for those beyond; bytes.lower changes A-Z only
                numbers = [list(map(known.__getitem__, find(t.encode("latin-1", "replace").lower()))) if t else [] for t in part.column(1).to_pylist()]
                ids = np.fromiter((k for ks in numbers for k in ks), np.int64)
                whole = np.concatenate([whole, np.zeros(len(known.runs) - len(whole), np.int64)])
                if one_in is not None and len(ids):
                    prefixes = [f"{i}:".encode() for i in part.column(0).to_pylist()]
                    doc = np.repeat(np.arange(len(prefixes)), [len(ks) for ks in numbers])
                    utf8 = np.array(known.utf8)[ids]
                    start = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
                    h = behind(start)[doc, np.minimum(utf8, TABLED)] ^ np.array(known.crc)[ids]
                    for k in np.flatnonzero(utf8 > TABLED).tolist():
                        h[k] = zlib.crc32(known.runs[ids[k]].decode("latin-1").encode(), int(start[doc[k]]))
                    hit = h % one_in == 0
                    for k, value in zip(ids[hit].tolist(), h[hit].tolist()):
                        word = known.runs[k]
                        at = value % len(word)
                        if len(word) > shortest:
                            changed[word[:at] + word[at + 1 :]] += 1
                    ids = ids[~hit]
                whole += np.bincount(ids, minlength=len(whole))
                if len(known) > HELD_WORDS or known.held > HELD_BYTES:
                    yield from out()
                    known, whole, changed = Known(), np.zeros(0, np.int64), Counter()
        yield from out()

    asked = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return asked.mapInArrow(run, "word string, n long")


def powers(n: int) -> np.ndarray:
    """The multiplier to the powers 0 to n, in 64 bits."""
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE, np.uint64), dtype=np.uint64)])


class Reduced:
    """A batch of words in symbols, end to end, with the hashes of their reduced forms."""

    def __init__(self, words: list[str], symbols: int):
        self.symbols = symbols
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64) % symbols
        self.first = np.cumsum(self.length) - self.length
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.at = np.arange(len(self.letters)) - self.first[self.word]
        self.power = powers(int(self.length.max(initial=0)) + 1)
        terms = (self.letters + 1).astype(np.uint64) * self.power[self.at]
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        #: sums of the terms before and up to each letter, and of all letters of a word
        self.before = running[:-1] - running[self.first][self.word]
        self.upto = running[1:] - running[self.first][self.word]
        self.total = running[self.first + self.length] - running[self.first]

    def hashes(self) -> np.ndarray:
        return self.total + self.length.astype(np.uint64) * np.uint64(LENGTHS)

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of the word itself, its replacements that hash higher and its deletions."""
        own = self.hashes()
        which, found = [np.arange(len(own))], [own]
        for step in range(1, self.symbols):
            change = (self.letters + step) % self.symbols - self.letters
            new = own[self.word] + change.astype(np.uint64) * self.power[self.at]
            higher = new.view(np.int64) > own[self.word].view(np.int64)
            which.append(self.word[higher])
            found.append(new[higher])
        # of a run of one symbol any letter may go, with the same result
        once = np.concatenate([[True], self.letters[1:] != self.letters[:-1]])[: len(self.letters)] | (self.at == 0)
        rest = self.before + (self.total[self.word] - self.upto) * np.uint64(INVERSE)
        shorter = rest + (self.length[self.word] - 1).astype(np.uint64) * np.uint64(LENGTHS)
        which.append(self.word[once])
        found.append(shorter[once])
        return np.concatenate(which), np.concatenate(found)


def near_words(words: DataFrame, symbols: int = SYMBOLS, block: int = BLOCK) -> DataFrame:
    """(word, n, other, other_n): every pair of (word, n) one edit apart, once from either side."""

    def reduce(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Reduced(batch.column(0).to_pylist(), symbols).hashes()
        return pa.record_batch([*batch.columns, pa.array(own.view(np.int64))], ["word", "n", "reduced"])

    def generate(batch: pa.RecordBatch) -> pa.RecordBatch:
        which, found = Reduced(batch.column(1).to_pylist(), symbols).neighbours()
        return pa.record_batch([batch.column(0).take(pa.array(which)), pa.array(found.view(np.int64))], ["reduced", "key"])

    keyed = store(by_batch(words, reduce, "word string, n long, reduced long", 1 << 20), "reduced-words")
    vocabulary = keyed.groupBy("reduced").agg(F.min("word").alias("one"), F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    generated = by_batch(vocabulary.select("reduced", "one"), generate, "reduced long, key long", 1 << 17)
    met = generated.join(vocabulary.select(F.col("reduced").alias("key"), "blocks"), "key")
    met = met.select("reduced", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    sizes = vocabulary.where("blocks > 1").select("reduced", "blocks")
    own = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("word"), F.col("blocks"))).cast("int")
    others = keyed.join(sizes, "reduced", "left").select(F.col("reduced").alias("key"), own.alias("block"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = keyed.join(met, "reduced").join(others, ["key", "block"]).where(
        ((F.col("key") != F.col("reduced")) | (F.col("word") < F.col("other")))
        & (F.abs(F.length("word") - F.length("other")) <= 1) & (F.levenshtein("word", "other", 1) == 1)
    )
    sides = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.inline(sides))


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of (word, form) lead, for words that have one."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = store(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        moved, now = now.where("moved").count(), now.select("word", "root")
        if not moved:
            return now


def variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST, one_in: int | None = ONE_IN,
    symbols: int = SYMBOLS, block: int = BLOCK,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word with ``shortest`` code points and ``least`` occurrences."""
    counted = counts(df, id_col, text_col, shortest, one_in).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = store(counted, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("order"), "other"))
    found = near_words(words, symbols, block).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.order") >= 2 * F.col("n")
    forms = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.order")).alias("form_n"),
    )
    forms = store(forms, "near-words")
    roots = last_forms(forms.where("form is not null"))
    return forms.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


#: The same in SQL: checksums byte by byte, pairs by the rest that a deletion leaves.
SPELLING_SQL = r"""
WITH RECURSIVE poly AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
points AS (
  SELECT run, n, length(run) AS l, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + unicode(c) % 64] END))::BIGINT[] AS b
  FROM runs WHERE length(run) >= 5),
hashed AS (
  SELECT run, n, l, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) AS h
  FROM points, poly),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN run[:h % l] || run[h % l + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT DISTINCT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
near AS (
  SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * w.n THEN best[2] END AS form,
    CASE WHEN -best[1] >= 2 * w.n THEN -best[1] END AS form_n
  FROM words w LEFT JOIN near USING (word)),
steps AS (
  SELECT word, word AS root, 0 AS step FROM forms
  UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN roots USING (word)
"""


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
