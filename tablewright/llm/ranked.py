"""Ranked lexical search by the Best Position Algorithm (operator 13).

The terms that the queries ask for are counted in every document once, and the counts are kept as a table.
A task turns its part of the table into shards of impact lists: for each term its documents by falling
impact. For a query it reads the lists from the front; whatever document it meets is looked up in the other
lists (direct access), which also marks the document's positions there as seen. The best position of a list
is the last one before which all are seen, so a document not met yet scores at most the sum of the impacts
at the best positions. Reading stops when that sum is strictly below the k-th score, since a document equal
to the k-th could still have a smaller id. The best of all shards are ranked by one window.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import freeze
from .common import column, send, slices, text_of

BEST = 50  # documents for each query
POSTINGS = 1 << 22  # postings after which a task closes a shard
BLOCK_BYTES = 8 << 20  # bytes of the terms of a block of queries, which every executor gets
FIRST = 64  # positions read from each list at first; twice as many each time

# Separators are all ASCII characters but digits and letters; A-Z count as a-z.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode().translate(_WORDS).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, times: np.ndarray, length: np.ndarray, documents: int, words: int) -> np.ndarray:
    """Impact of each posting: its term's weight by a quotient that saturates with the count, lower in long documents."""
    m = 100 - 50 + (50 * length * documents) // max(words, 1)
    return weights * ((1_000_000_000 * times) // (1000 * times + 20 * m))


class Lists:
    """The impact lists of a shard. Documents are numbered in the shard."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        by_doc = np.argsort(terms, kind="stable")  # postings come by document, so each list is sorted by it
        self.n_docs, self.docs, self.impact, terms = n_docs, docs[by_doc], impact[by_doc], terms[by_doc]
        self.start = np.searchsorted(terms, np.arange(n_terms + 1))
        self.by_impact = np.lexsort((-self.impact, terms))
        self.position = np.empty(len(terms), np.int64)
        self.position[self.by_impact] = np.arange(len(terms)) - self.start[terms]

    def best(self, asked: list[int], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of at least the ``k`` best above 0, all that are equal to the k-th among them.

        Documents below ``floor`` need not be found.
        """
        lists = [(a, b) for t in asked if (a := self.start[t]) < (b := self.start[t + 1]) and self.impact[self.by_impact[a]] > 0]
        seen = [np.zeros(b - a, bool) for a, b in lists]
        best = [0] * len(lists)  # positions up to which all are seen
        score, met = np.zeros(self.n_docs, np.int64), np.zeros(self.n_docs, bool)
        step, kth = FIRST, floor
        while True:
            read = [self.by_impact[a + at : min(a + at + step, b)] for (a, b), at in zip(lists, best)]
            found = np.unique(self.docs[np.concatenate(read)]) if read else np.empty(0, np.int64)
            found = found[~met[found]]
            met[found] = True
            for (a, b), marks in zip(lists, seen):
                at = a + np.searchsorted(self.docs[a:b], found)
                hit = self.docs[np.minimum(at, b - 1)] == found
                at = at[hit]
                score[found[hit]] += self.impact[at]
                marks[self.position[at]] = True
            bound = 0
            for i, ((a, b), marks) in enumerate(zip(lists, seen)):
                rest = marks[best[i] :]
                best[i] = b - a if rest.all() else best[i] + int(np.argmin(rest))
                bound += 0 if best[i] == b - a else int(self.impact[self.by_impact[a + best[i] - 1]])
            scores = score[met]
            if len(scores) >= k:
                kth = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            if bound < kth or bound == 0:
                break
            step *= 2
        chosen = np.flatnonzero(met & (score >= max(kth, 1)))
        return chosen, score[chosen]


def _asked(queries: DataFrame, item: str, text: str) -> DataFrame:
    """``item_id`` and ``term``, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t) for i, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in set(terms_of(words))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())], names=["item_id", "term"])

    rows = queries.select(column(item).cast("bigint").alias("item_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, "item_id bigint, term binary").distinct()


def count_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id``, ``length`` (terms with repeats) and the counts of the ``vocabulary`` in each document with a term.

    ``terms`` (places in the vocabulary) and ``times`` hold 32-bit numbers side by side. The table is stored.
    """
    sent = send(docs.sparkSession, b" ".join(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(sent.value.split())}
        for batch in slices(batches):
            out: list[list] = [[], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                counts = Counter(map(number.get, words))
                counts.pop(None, None)
                held = np.fromiter(counts.items(), np.dtype((np.int32, 2)), len(counts))
                for values, value in zip(out, (doc, len(words), held[:, 0].tobytes(), held[:, 1].tobytes())):
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "length", "terms", "times"])

    rows = docs.select(column("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return freeze(rows.mapInArrow(run, "doc_id bigint, length bigint, terms binary, times binary"), "term-counts")


def _holding(counts: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is: one row per term and task, then one per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for held in batch.column(0):
                total[np.frombuffer(held.as_py(), np.int32)] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["term", "n"])

    found = np.zeros(n_terms, np.int64)
    for row in counts.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        found[row["term"]] = row["n"]
    return found


def _ranked(counts: DataFrame, asked: dict[int | None, list[int]], weights: np.ndarray, documents: int, words: int, k: int) -> DataFrame:
    """The best of every task: ``item_id, doc_id, score``."""
    model = json.dumps({"items": list(asked), "terms": list(asked.values()), "weights": weights.tolist()}).encode()
    sent, limit = send(counts.sparkSession, model), POSTINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = json.loads(sent.value)
        weights, n_terms = np.array(model["weights"], np.int64), len(model["weights"])
        # For each query what the task has found so far: score, id is missing, id.
        top = [np.empty((0, 3), np.int64)] * len(model["items"])

        def close(part: list[tuple]) -> None:
            lengths = np.array([p[1] for p in part], np.int64)
            held = [np.frombuffer(p[2], np.int32) for p in part]
            docs = np.repeat(np.arange(len(part)), [len(h) for h in held])
            terms, times = np.concatenate(held), np.concatenate([np.frombuffer(p[3], np.int32) for p in part]).astype(np.int64)
            lists = Lists(docs, terms, impacts(weights[terms], times, lengths[docs], documents, words), len(part), n_terms)
            ids = np.array([[p[0] is None, p[0] or 0] for p in part], np.int64)
            for i, wanted in enumerate(model["terms"]):
                floor = int(top[i][k - 1, 0]) if len(top[i]) >= k else 0
                chosen, scores = lists.best(wanted, k, floor)
                if len(chosen):
                    joined = np.concatenate([top[i], np.column_stack([scores, ids[chosen]])])
                    top[i] = joined[np.lexsort((joined[:, 2], joined[:, 1], -joined[:, 0]))[:k]]

        part, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                part.append(row)
                size += len(row[2]) // 4 + 1
                if size >= limit:
                    close(part)
                    part, size = [], 0
        if part:
            close(part)
        for item, best in zip(model["items"], top):
            if len(best):
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(best), pa.int64()), pa.array(best[:, 2], mask=best[:, 1].astype(bool)), pa.array(best[:, 0])], names=["item_id", "doc_id", "score"])

    return counts.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, k: int = BEST, item: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` best documents of each query: ``item_id, rank, doc_id, score``.

    Equal scores rank by ``doc_id``, a null one last. Every row of ``docs`` is a document of its own, repeated
    ids and rows included. Rows of ``queries`` with the same id are one query, a null id is a value like any
    other; a term counts once. Null, empty and blank texts have no term: such documents are never found and
    do not count, such queries have no rows. Texts of any length are read whole. An empty table on either side
    gives an empty table. Columns other than ``doc_id``, ``text`` and the two of ``queries`` are not read.

    The queries go to every executor in blocks of ``BLOCK_BYTES`` of terms, and each block reads the documents
    once; a task holds the lists of ``POSTINGS`` postings and ``k`` documents a query.
    """
    spark: SparkSession = docs.sparkSession
    asked = freeze(_asked(queries, item, text), "asked-terms")
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    found = []
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "term").collect()
        vocabulary = sorted({bytes(r["term"]) for r in mine})
        number = {t: i for i, t in enumerate(vocabulary)}
        wanted: dict[int | None, list[int]] = {}
        for row in mine:
            wanted.setdefault(row["item_id"], []).append(number[bytes(row["term"])])
        counts = count_terms(docs, vocabulary)
        total = counts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("l")).first()
        weights = np.array([weight(total["n"], int(h)) for h in _holding(counts, len(vocabulary))], np.int64)
        found.append(_ranked(counts, wanted, weights, total["n"], total["l"], k))
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return search(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


_SPLIT = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = f"""
WITH words AS (SELECT doc_id, unnest({_SPLIT}) AS term FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
t AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM d),
q AS (SELECT DISTINCT item_id, unnest({_SPLIT}) AS term FROM benchmark),
p AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // words)))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (doc_id), t GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""
