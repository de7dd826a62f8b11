"""Ranked lexical search: the best documents of each query, by best-first intervals over posting lists.

A task takes its documents block by block, in ascending id order within a block. Of a block it keeps, for every
query term, the posting list (places in the block) with the impact each posting has on a score, and over each list a
range-maximum sparse table: where the greatest impact of any 2^j neighbours stands, so that the greatest of
any stretch is found in two looks. A query starts with the whole block as one interval. The sum over its terms of
weight times the greatest impact inside bounds what a document there can reach. The intervals with the highest
bounds are taken first, a hundred at a time; each is split at the document with the greatest single
contribution, which is scored in full, and its two sides go back with their own bounds. Intervals that cannot
reach the query's worst kept document are dropped: the rest is right for every document, none is left out.

Two reads of the documents: the first counts documents, terms and, for the terms of the queries, the documents that hold
them; the second searches. Only these counts and each task's best rows are shuffled, no text and no posting.

Bounds: a block ends with BLOCK_DOCS documents or BLOCK_TERMS terms (or one longer document); queries are taken
QUERY_BYTES of text at a time, so the terms and the best rows a task holds follow that and not the table. The best
of all tasks meet per query after each partition has kept its own.

Terms are runs of ASCII letters, digits and all non-ASCII characters, with only A-Z lowered, compared as 64-bit hashes.
Score, in whole numbers: w * ((10^9 * tf) div (1000 * tf + 12 * m)) summed over the query's terms with repeats, where w =
floor(1000 * ln((2N + 2) / (2df + 1))) and m = 75 + (25 * n * N) div L.

Defined results: null and empty texts, and queries without terms, give no rows; a document without an id comes after all
others of its score; rows of one id are ranked one by one; equal query ids are searched one by one, too, and share one
list of the best documents' rows; other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import named, text_of
from tidemart.llm.text import _LOWER, Texts, Words, _span_hashes, find, slices

K = 20
BLOCK_DOCS = 4096
BLOCK_TERMS = 2_000_000
QUERY_BYTES = 8 << 20
TOGETHER = 128
LEAST = np.iinfo(np.int64).min

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(texts: Texts) -> Words:
    """The terms of a slice in order."""
    data = _LOWER[texts.data]
    n = len(data)
    inside = _INSIDE[data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(_span_hashes(data, start, end), np.searchsorted(texts.offsets, start, side="right") - 1, start, end)


@dataclass
class Queries:
    """Queries of one pass: the sorted hashes of their terms, and for each query its terms' places there and counts."""
    hashes: np.ndarray
    term: list[np.ndarray]
    count: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        column = pa.array([t or "" for t in texts], pa.string())
        hashes = [w.hash[w.row == i] for first, last, s in slices(column) for w in [terms(s)] for i in range(last - first)]
        known = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
        found = [np.unique(np.searchsorted(known, h), return_counts=True) for h in hashes]
        return cls(known, [f[0] for f in found], [f[1].astype(np.int64) for f in found])


@dataclass
class Statistics:
    """N, L and, for each query term, the number of documents that hold it."""
    documents: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(d) + 1))) for d in self.df], np.int64)


def statistics(docs: DataFrame, queries: Queries, text_col: str = "text") -> Statistics:
    """Counted over all documents; each task sends one number per query term it met."""
    hashes = queries.hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, length = np.zeros(len(hashes), np.int64), 0, 0
        for batch in batches:
            for _, _, texts in slices(batch.column(0)):
                w = terms(texts)
                at = find(hashes, w.hash)
                pair = np.unique(w.row[at >= 0] * max(1, len(hashes)) + at[at >= 0])
                df += np.bincount(pair % max(1, len(hashes)), minlength=len(hashes))[: len(hashes)]
                n_docs += len(np.unique(w.row))
                length += len(w.row)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], held]), pa.int64()),
                                          pa.array(np.concatenate([[n_docs, length], df[held]]), pa.int64())], ["place", "n"])

    counted = (docs.select(text_of(named(text_col))).mapInArrow(run, "place long, n long")
               .groupBy("place").agg(F.sum("n").alias("n")).collect())
    found = {r["place"]: r["n"] for r in counted}
    df = np.zeros(len(hashes), np.int64)
    for place, n in found.items():
        if place >= 0:
            df[place] = n
    return Statistics(found.get(-2, 0), found.get(-1, 0), df)


class Block:
    """The posting lists of a block of documents and their range-maximum tables."""

    def __init__(self, row: np.ndarray, term: np.ndarray, n_terms: np.ndarray, n_lists: int, stats: Statistics) -> None:
        """`row` and `term` of each occurrence, the number of terms of each document (of which there is one at least)."""
        self.rows = len(n_terms)
        self.key, tf = np.unique(term.astype(np.int64) * self.rows + row, return_counts=True)
        self.first = np.searchsorted(self.key, np.arange(n_lists + 1, dtype=np.int64) * self.rows)
        self.row = self.key % self.rows
        m = 75 + (25 * n_terms.astype(np.int64) * stats.documents) // max(1, stats.length)
        self.impact = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 12 * m[self.row])
        self.tables = [np.arange(len(self.key), dtype=np.int32)]
        longest = int(np.diff(self.first).max(initial=0))
        while 2 << (len(self.tables) - 1) <= longest:
            half = 1 << (len(self.tables) - 1)
            left, right = self.tables[-1][:-half], self.tables[-1][half:]
            self.tables.append(np.where(self.impact[right] > self.impact[left], right, left))

    def greatest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the greatest impact of postings a to b stands, for non-empty stretches."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for j in np.unique(level):
            of = np.flatnonzero(level == j)
            left, right = self.tables[j][a[of]], self.tables[j][b[of] - (1 << int(j))]
            out[of] = np.where(self.impact[right] > self.impact[left], right, left)
        return out


def _bounds(block: Block, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For intervals given as one stretch per term: the sum of the greatest contributions, and the posting of the greatest one."""
    gain, place = np.zeros(a.shape, np.int64), np.zeros(a.shape, np.int64)
    full = a < b
    place[full] = block.greatest(a[full], b[full])
    gain[full] = block.impact[place[full]] * np.broadcast_to(weight, a.shape)[full]
    return gain.sum(1), place[np.arange(len(a)), gain.argmax(1)] if a.shape[1] else np.zeros(len(a), np.int64)


def _better(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search(block: Block, ids: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, scores: np.ndarray,
           kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of those kept so far and the block's documents; `ids` ascend over the block."""
    a, b = block.first[term][None, :], block.first[term + 1][None, :]
    bound, split = _bounds(block, a, b, weight)
    first = np.zeros(1, np.int64)       # the interval's first document, which has its least id
    while len(bound):
        if len(scores) >= k:
            open_ = (bound > scores[-1]) | (bound == scores[-1]) & (ids[first] < kept[-1])
        else:
            open_ = bound > 0
        a, b, bound, split, first = a[open_], b[open_], bound[open_], split[open_], first[open_]
        if not len(bound):
            break
        order = np.argpartition(-bound, TOGETHER)[:TOGETHER] if len(bound) > TOGETHER else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[order] = False
        row = block.row[split[order]]
        at = np.searchsorted(block.key, term.astype(np.int64) * block.rows + row[:, None])
        at = np.clip(at, a[order], b[order])
        held = (at < b[order]) & (block.row[np.minimum(at, len(block.row) - 1)] == row[:, None])
        score = (np.where(held, block.impact[np.minimum(at, len(block.row) - 1)], 0) * weight).sum(1)
        scores, kept = np.concatenate([scores, score[score > 0]]), np.concatenate([kept, ids[row[score > 0]]])
        best = _better(scores, kept, k)
        scores, kept = scores[best], kept[best]
        a_new, b_new = np.concatenate([a[order], at + held]), np.concatenate([at, b[order]])
        first_new = np.concatenate([first[order], np.minimum(row + 1, block.rows - 1)])
        bound_new, split_new = _bounds(block, a_new, b_new, weight)
        a, b = np.concatenate([a[rest], a_new]), np.concatenate([b[rest], b_new])
        bound, split = np.concatenate([bound[rest], bound_new]), np.concatenate([split[rest], split_new])
        first = np.concatenate([first[rest], first_new])
    return scores, kept


class Best:
    """The best documents of each query so far; documents without an id count as the greatest."""

    def __init__(self, queries: Queries, stats: Statistics, k: int) -> None:
        self.queries, self.stats, self.k = queries, stats, k
        weights = stats.weights()
        self.weight = [weights[t] * c for t, c in zip(queries.term, queries.count, strict=True)]
        self.scores = [np.zeros(0, np.int64) for _ in queries.term]
        self.ids = [np.zeros(0, np.int64) for _ in queries.term]

    def add(self, ids: np.ndarray, row: np.ndarray, term: np.ndarray, n_terms: np.ndarray) -> None:
        """Search a block: each occurrence's document and query term, each document's id and number of terms."""
        order = np.argsort(ids, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        block = Block(place[row], term, n_terms[order], len(self.queries.hashes), self.stats)
        filled = np.diff(block.first) > 0
        for q, (terms_of, weight) in enumerate(zip(self.queries.term, self.weight, strict=True)):
            here = filled[terms_of] & (weight > 0)
            if here.any():
                self.scores[q], self.ids[q] = search(block, ids[order], terms_of[here], weight[here], self.k, self.scores[q], self.ids[q])


def _pass(docs: DataFrame, queries: Queries, k: int, id_col: str, text_col: str) -> DataFrame:
    """(query, doc_id, score): each task's best rows for the queries of one pass."""
    stats = statistics(docs, queries, text_col)
    no_id = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(queries, stats, k)
        ids, rows, found, sizes, held = [], [], [], [], [0, 0]

        def close() -> None:
            if held[0]:
                best.add(np.concatenate(ids), np.concatenate(rows), np.concatenate(found), np.concatenate(sizes))
            for part in (ids, rows, found, sizes):
                part.clear()
            held[:] = 0, 0

        for batch in batches:
            keys = batch.column(0).fill_null(no_id).to_numpy(zero_copy_only=False)
            for first, last, texts in slices(batch.column(1)):
                w = terms(texts)
                at = find(queries.hashes, w.hash)
                size = np.bincount(w.row, minlength=last - first)
                some = np.flatnonzero(size)
                new = np.zeros(last - first, np.int64)
                new[some] = np.arange(len(some)) + held[0]
                ids.append(keys[first:last][some])
                rows.append(new[w.row[at >= 0]])
                found.append(at[at >= 0])
                sizes.append(size[some])
                held[0] += len(some)
                held[1] += int(size.sum())
                if held[0] >= BLOCK_DOCS or held[1] >= BLOCK_TERMS:
                    close()
        close()
        n = [len(s) for s in best.scores]
        out = np.concatenate([np.zeros(0, np.int64), *best.ids])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(n)), n), pa.int64()), pa.array(out, pa.int64(), mask=out == no_id),
                                          pa.array(np.concatenate([np.zeros(0, np.int64), *best.scores]), pa.int64())], ["query", "doc_id", "score"])

    return docs.select(named(id_col).cast("long"), text_of(named(text_col))).mapInArrow(run, "query long, doc_id long, score long")


def top_documents(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                  query_id: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, doc_id, score): each query's k best documents with a score above 0."""
    asked = queries.select(named(query_id).alias("id"), text_of(named(query_text)).alias("text"))
    kind = asked.schema["id"].dataType.simpleString()
    size = asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    passes = int(size // query_bytes) + 1
    spark, found = docs.sparkSession, None
    for i in range(passes):
        mine = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == i).orderBy("id", "text").collect()
        names = spark.createDataFrame([(q, r["id"]) for q, r in enumerate(mine)], f"query long, `{query_id}` {kind}")
        best = _pass(docs, Queries.of([r["text"] for r in mine]), k, id_col, text_col)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        here = ranked.join(F.broadcast(names), "query").select(named(query_id), "rank", "doc_id", "score")
        found = here if found is None else found.unionByName(here)
    return found


ORACLE = r"""
WITH word AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
doc AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM doc),
posting AS (SELECT term, doc_id, count(*) AS tf FROM word WHERE term IN (SELECT term FROM asked) GROUP BY term, doc_id),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), total),
impact AS (
  SELECT term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length))) AS gain
  FROM posting JOIN weight USING (term) JOIN doc USING (doc_id), total),
scored AS (
  SELECT item_id, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN impact USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
