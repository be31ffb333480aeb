"""Ranked lexical search by NRA: impact-sorted lists, read in order, without random access.

Documents are indexed in shards of at most ``DOCS`` documents and about ``TERMS`` terms, each built by the task that
reads them: per term the documents that hold it and how often. Items (queries) lie in packs. Every pack meets every
shard twice. First the shard tells how many of its documents hold each of the pack's terms, which gives the weights.
Then each item runs on the shard: the lists of its terms are sorted by impact and read block by block, round by round.
A document's lower score is the sum of the impacts read for it, its upper score adds, for every list in which it was
not met, the last impact read there. Documents whose upper score lies below the k-th lower one are given up, and no
further documents are opened once the unread rest cannot reach it; reading goes on until every document left has equal
bounds, so membership, ties and scores are final. A task carries the k-th score from shard to shard, and gives out the
best k of each item only.

Texts that are null, or hold no term, take no part. Repeated rows and null ids of documents are documents of their own
(null ids come last in ties). Rows of one item id are one item; a null item id is an item, too. Equal scores go to the
smaller document id. Items without a term that any document holds give no rows, nor do empty tables. Columns other
than the id and the text of either table are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.common import by_batch, slices, table
from shopledger.session import store

#: Documents and terms (with repeats) of a shard, a document's own beyond that.
DOCS, TERMS = 8192, 1 << 21
#: Items of a pack; bytes of all packs up to which they are sent to every task as a whole.
ITEMS, SENT = 256, 4 << 20
#: Slots over which shards are dealt when packs are sent to every task.
SLOTS = 8
#: Postings read of each list in the first round; each round reads as many as all before.
FIRST = 64
#: Maximal runs of ASCII letters, digits and all that is beyond ASCII, as bytes.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
UNIT = 1_000_000_000
NO_ID = (1 << 63) - 1


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in UTF-8; bytes.lower changes A-Z only."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


class Numbered(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


SHARD = "ids binary, lengths binary, docs long, n_terms long, terms binary, sizes binary, postings binary, times binary"


def shards(df: DataFrame, id_col: str, text_col: str, docs: int = DOCS, terms: int = TERMS) -> DataFrame:
    """The index: ids and lengths of a shard's documents; its terms in order of their numbers, with the number of
    documents of each, and these documents and the term's occurrences in them, list after list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> tuple:
            return Numbered(), [], [], [], [0]

        known, ids, lengths, found, total = fresh()

        def out() -> pa.RecordBatch:
            n = np.array(lengths, np.int64)
            doc = np.repeat(np.arange(len(n)), n)
            pair, times = np.unique(np.concatenate(found) * len(n) + doc, return_counts=True)
            sizes = np.bincount(pair // len(n), minlength=len(known))
            cells = [np.array(ids, np.int64).tobytes(), n.tobytes(), len(n), int(n.sum()), b" ".join(known),
                     sizes.astype(np.int32).tobytes(), (pair % len(n)).astype(np.int32).tobytes(), times.astype(np.int32).tobytes()]
            return pa.record_batch([pa.array([c]) for c in cells], ["ids", "lengths", "docs", "n_terms", "terms", "sizes", "postings", "times"])

        for batch in batches:
            for part in slices(batch, 1 << 20):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    held = np.array(list(map(known.__getitem__, terms_of(text))), np.int64)
                    if not len(held):
                        continue
                    ids.append(NO_ID if doc is None else doc)
                    lengths.append(len(held))
                    found.append(held)
                    total[0] += len(held)
                    if len(ids) >= docs or total[0] >= terms:
                        yield out()
                        known, ids, lengths, found, total = fresh()
        if ids:
            yield out()

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, SHARD)


def packs(items: DataFrame, id_col: str, text_col: str, per_pack: int = ITEMS) -> DataFrame:
    """(pack, items): items of about ``per_pack`` each, as (item, terms); a term is the hexadecimal form of its bytes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms = [sorted({t.hex() for t in terms_of(text)}) for text in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["item", "terms"])

    each = by_batch(items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")), run, "item long, terms array<string>")
    each = each.groupBy("item").agg(F.array_distinct(F.flatten(F.collect_set("terms"))).alias("terms")).where(F.size("terms") > 0)
    each = store(each, "items")
    n = max(1, -(-each.count() // per_pack))
    pack = F.pmod(F.xxhash64("item"), F.lit(n)).cast("int")
    return store(each.groupBy(pack.alias("pack")).agg(F.collect_list(F.struct("item", "terms")).alias("items")), "packs")


def met(index: DataFrame, asked: DataFrame, columns: list[str]) -> DataFrame:
    """Every shard beside every pack. Small packs are sent to the shards; others are dealt by slots like them."""
    size = asked.select(F.sum(F.length(F.to_json("items")))).first()[0] or 0
    slots = SLOTS if size <= SENT else max(SLOTS, index.count())
    dealt = asked.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    own = index.select(*columns, F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int").alias("slot"))
    return own.join(F.broadcast(dealt) if size <= SENT else dealt, "slot").drop("slot")


def held(index: DataFrame, asked: DataFrame) -> DataFrame:
    """(term, df): the number of documents that hold each of the items' terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = dict(zip(batch.column(0)[row].as_py().split(b" "), np.frombuffer(batch.column(1)[row].as_py(), np.int32).tolist()))
                wanted = {t for i in batch.column(3)[row].as_py() for t in i["terms"]}
                found = {t: n for t in wanted if (n := sizes.get(bytes.fromhex(t)))}
                pack = pa.array([batch.column(2)[row].as_py()] * len(found), pa.int32())
                yield pa.record_batch([pack, pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pack", "term", "n"])

    both = met(index, asked, ["ids", "terms", "sizes"]).select("terms", "sizes", "pack", "items")
    return both.mapInArrow(run, "pack int, term string, n long").groupBy("pack", "term").agg(F.sum("n").alias("df"))


class Shard:
    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.number = {t: k for k, t in enumerate(row["terms"].split(b" "))}
        self.ends = np.concatenate([[0], np.cumsum(np.frombuffer(row["sizes"], np.int32))])
        self.postings = np.frombuffer(row["postings"], np.int32)
        self.times = np.frombuffer(row["times"], np.int32)
        self.share = 50 + 50 * np.frombuffer(row["lengths"], np.int64) * n_docs // n_terms
        self.sorted: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

    def list_of(self, term: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """(documents, impacts without the weight), the greatest impact first."""
        k = self.number.get(term)
        if k is None:
            return None
        if term not in self.sorted:
            here = slice(self.ends[k], self.ends[k + 1])
            docs, tf = self.postings[here], self.times[here].astype(np.int64)
            impact = UNIT * tf // (1000 * tf + 20 * self.share[docs])
            order = np.argsort(-impact, kind="stable")
            self.sorted[term] = docs[order], impact[order]
        return self.sorted[term]


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 1, first: int = FIRST) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that hold the best k of at least ``floor``, ties with the k-th included, by sequential reads.

    lists: documents and impacts, the greatest first.
    """
    lower = np.zeros(n_docs, np.int64)
    met_in = np.zeros((n_docs, len(lists)), bool)
    left = np.ones(n_docs, bool)  # not given up
    at, step = 0, first
    while True:
        last = np.zeros(len(lists), np.int64)
        for t, (docs, impacts) in enumerate(lists):
            new, gain = docs[at : at + step], impacts[at : at + step]
            if at + step < len(docs):
                last[t] = gain[-1]
            keep = left[new]
            new = new[keep]
            lower[new] += gain[keep]  # a list holds a document once
            met_in[new, t] = True
        at, step = at + step, at + step
        rest = np.flatnonzero(left)
        kth = max(floor, int(np.partition(lower[rest], -k)[-k])) if len(rest) >= k else floor
        open_ = last > 0
        if not open_.any():
            rest = rest[lower[rest] >= kth]
            return rest, lower[rest]
        missing = (~met_in[rest][:, open_]) @ last[open_]
        stay = lower[rest] + missing >= kth
        left[rest[~stay]] = False
        rest, missing = rest[stay], missing[stay]
        if not missing.any():
            return rest, lower[rest]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(documents: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", docs: int = DOCS, terms: int = TERMS, per_pack: int = ITEMS, first: int = FIRST) -> DataFrame:
    """(item, rank, doc, score): the best k documents of every item with a score above 0."""
    index = store(shards(documents, id_col, text_col, docs, terms), "shards")
    n_docs, n_terms = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    asked = packs(items, item_col, item_text_col, per_pack)
    known = held(index, asked).groupBy("pack").agg(F.map_from_entries(F.collect_list(F.struct("term", "df"))).alias("df"))
    asked = store(asked.join(known, "pack").select("pack", F.struct("items", "df").alias("items")), "weighted-packs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int | None, tuple[np.ndarray, np.ndarray]] = {}
        weighted: dict[int, list] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                pack = batch.column("pack")[r].as_py()
                if pack not in weighted:
                    held_ = batch.column("items")[r].as_py()
                    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in held_["df"]}
                    weighted[pack] = [(i["item"], [(bytes.fromhex(t), weight[t]) for t in i["terms"] if weight.get(t)]) for i in held_["items"]]
                shard = Shard({c: batch.column(c)[r].as_py() for c in ("ids", "terms", "sizes", "postings", "times", "lengths")}, n_docs, n_terms)
                for item, wanted in weighted[pack]:
                    lists = [(found[0], w * found[1]) for t, w in wanted if (found := shard.list_of(t)) is not None]
                    if not lists:
                        continue
                    ids, scores = kept.get(item, (np.empty(0, np.int64),) * 2)
                    rows, new = nra(lists, len(shard.ids), k, max(1, int(scores[-1])) if len(scores) == k else 1, first)
                    kept[item] = best(np.concatenate([ids, shard.ids[rows]]), np.concatenate([scores, new]), k)
        for item, (ids, scores) in kept.items():
            doc = pa.array(ids, mask=ids == NO_ID)
            yield pa.record_batch([pa.array([item] * len(ids), pa.int64()), doc, pa.array(scores)], ["item", "doc", "score"])

    columns = ["ids", "terms", "sizes", "postings", "times", "lengths"]
    found = met(index, asked, columns).mapInArrow(run, "item long, doc long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return found.select("item", rank.alias("rank"), "doc", "score").where(F.col("rank") <= k)


#: The same in SQL.
RANKING_SQL = r"""
WITH found AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
postings AS (SELECT row, doc_id, term, count(*) AS tf FROM found GROUP BY ALL),
lengths AS (SELECT row, sum(tf)::BIGINT AS n FROM postings GROUP BY row),
sizes AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
shares AS (SELECT row, 50 + (50 * n * n_docs) // n_terms AS m FROM lengths, sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), sizes),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scores AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN postings USING (term) JOIN shares USING (row) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op13_ranking(spark, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
