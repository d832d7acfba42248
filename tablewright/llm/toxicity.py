"""Toxicity by a factorization machine over hashed terms (operator 7).

The score is the logistic of ``w0 + sum w_i + sum <v_i, v_j>`` over all terms and all pairs of terms
of a text, so a pair can weigh more or less than its two terms. Terms are the words in lower case
and their beginnings of four to six characters, hashed into ``SPACE`` buckets.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import column, fresh, gathered, send, slices, text_of

SPACE = 1 << 24  # buckets
SAMPLE = 8000  # most labelled rows that are learnt from
SAMPLE_PART = 250  # of them, rows that are worth a partition
KEPT = 512  # most buckets that the model has weights for: those that tell the labels apart best
LEAST = 3  # learnt rows in which a kept bucket occurs at least
FACTORS = 8
EPOCHS = 25
THRESHOLD = 0.7  # fixed by the contract
KEPT_WORDS = 400_000  # words whose buckets a worker keeps

WORD = re.compile(r"\w+")


def buckets(word: str) -> list[int]:
    """The buckets of one word: itself and its beginnings."""
    terms = {word, *("^" + word[:n] for n in (4, 5, 6) if len(word) >= n)}
    return [xxhash.xxh64_intdigest(t, 1) % SPACE for t in terms]


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def _learnt_from(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``label`` and ``terms`` of the sample: at most ``sample`` rows, the first by a hash of the id."""
    known = labels.filter(column("toxic").isNotNull()).groupBy(column("doc_id").alias("id")).agg(F.max(column("toxic").cast("int")).alias("label"))
    chosen = known.filter(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(column("doc_id").alias("doc"), text_of().alias("text")).join(F.broadcast(chosen), F.col("doc") == F.col("id"))
    # Of rows that share an id one is learnt from, so repeated ids do not lift the bound.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    texts = texts.groupBy("id", "label").agg(one.alias("one")).select("label", "one.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms = [sorted({b for w in set(WORD.findall(t.lower())) for b in buckets(w)}) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.int32()))], names=["label", "terms"])

    return freeze(gathered(texts.mapInArrow(run, "label int, terms array<int>"), sample, SAMPLE_PART), "terms")


def fit(rows: list[np.ndarray], labels: np.ndarray, size: int, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights by AdaGrad on the logistic loss. ``rows``: the kept terms of each text, numbered below ``size``."""
    rng = np.random.default_rng(seed)
    w, v = np.zeros(size), rng.normal(0, 0.01, (size, factors))
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    w0 = float(np.log(share / (1 - share)))
    gw, gv, g0 = np.full(size, 1e-2), np.full((size, factors), 1e-2), 1e-2
    heavier = np.where(labels == 1, min(0.5 / share, 8.0), 1.0)
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 32)):
            sizes = np.array([len(rows[i]) for i in batch])
            terms = np.concatenate([rows[i] for i in batch]) if sizes.sum() else np.zeros(0, np.int64)
            at = np.repeat(np.arange(len(batch)), sizes)
            sums = np.zeros((len(batch), factors))
            np.add.at(sums, at, v[terms])
            squares = np.bincount(at, (v[terms] ** 2).sum(1), len(batch))
            z = w0 + np.bincount(at, w[terms], len(batch)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * heavier[batch] / len(batch)
            g0 += error.sum() ** 2
            w0 -= 0.1 * error.sum() / np.sqrt(g0)
            used = np.unique(terms)
            dw = np.bincount(terms, error[at], size)[used] + 1e-5 * w[used]
            dv = np.zeros((size, factors))
            np.add.at(dv, terms, error[at][:, None] * (sums[at] - v[terms]))
            dv = dv[used] + 1e-4 * v[used]
            gw[used] += dw**2
            gv[used] += dv**2
            w[used] -= 0.2 * dw / np.sqrt(gw[used])
            v[used] -= 0.02 * dv / np.sqrt(gv[used])
    return {"w0": np.array(w0), "w": w, "v": v}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """The model as bytes: kept buckets and their weights; its size does not depend on the corpus.

    Terms are counted over the sample by Spark; one task fits the weights to at most ``sample`` rows
    with the kept terms only. Rows with a null label or a null id teach nothing; a document with
    several labels is toxic if one says so. Of rows with one id the text with the smallest hash is learnt.
    """
    rows = _learnt_from(docs, labels, sample)
    totals = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    n, toxic = totals[0], totals[1] or 0
    counted = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
    share = toxic / n if n else 0.0
    distance = F.abs(F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-9))
    kept = [r["term"] for r in counted.filter(F.col("n") >= LEAST).orderBy(distance.desc(), "term").limit(KEPT).collect()]
    kept = np.sort(np.array(kept, np.int64))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, marks = [], []
        for frame in frames:
            for terms in frame["terms"]:
                at = np.searchsorted(kept, terms)
                hit = (at < len(kept)) & (kept[np.minimum(at, len(kept) - 1)] == terms) if len(kept) else np.zeros(len(terms), bool)
                found.append(at[hit])
            marks.append(frame["label"].to_numpy())
        order = sorted(range(len(found)), key=lambda i: found[i].tolist())  # whatever the order of arrival
        marks = np.concatenate(marks) if marks else np.zeros(0)
        model = fit([found[i] for i in order], marks[order].astype(float), len(kept))
        file = io.BytesIO()
        np.savez(file, kept=kept, **model)
        yield pd.DataFrame({"model": [file.getvalue()]})

    if not toxic or toxic == n or not len(kept):
        file = io.BytesIO()
        np.savez(file, kept=kept[:0], w0=np.array(-5.0 if not toxic else 5.0), w=np.zeros(0), v=np.zeros((0, FACTORS)))
        return file.getvalue()
    return bytes(rows.coalesce(1).mapInPandas(run, "model binary").first()[0])


class Model:
    """Scores texts; words are looked up once."""

    def __init__(self, content: bytes):
        file = np.load(io.BytesIO(content))
        self.w0, self.w, self.v = float(file["w0"]), file["w"], file["v"]
        self.number = {int(b): i for i, b in enumerate(file["kept"])}
        self.words: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        if len(self.words) >= KEPT_WORDS:
            self.words.clear()
        found = self.words[word] = tuple(self.number[b] for b in buckets(word) if b in self.number)
        return found

    def score(self, text: str) -> float:
        known, terms = self.words.get, set()
        for word in set(WORD.findall(text.lower())):
            found = known(word)
            terms.update(self._word(word) if found is None else found)
        at = np.fromiter(sorted(terms), np.int64, len(terms))
        v = self.v[at]
        z = self.w0 + self.w[at].sum() + 0.5 * float((v.sum(0) ** 2).sum() - (v**2).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _scores(docs: DataFrame, model: bytes, columns: list[Column]) -> DataFrame:
    """``columns``, then ``score``; a null text scores like an empty one."""
    sent = send(docs.sparkSession, model)
    score, text = fresh(docs, "score", "_text")
    rows = docs.select(*columns, text_of().alias(text))
    names = [*rows.columns[:-1], score]
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), f"`{score}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(sent.value)
        for batch in batches:
            found = np.fromiter((scorer.score(t.as_py()) for t in batch.column(batch.num_columns - 1)), np.float64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(found)], names=names)

    return rows.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, model: bytes) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``. Only the text makes the score."""
    found = _scores(docs.select(column("doc_id"), column("text")), model, [column("doc_id")])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: bytes) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns. No shuffle."""
    found = _scores(docs, model, [column(c) for c in docs.columns])
    return found.filter(column(found.columns[-1]) < THRESHOLD).select(*[column(c) for c in docs.columns])


def op7_toxicity(spark, folder: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return score_toxicity(docs, train(docs, labels))
