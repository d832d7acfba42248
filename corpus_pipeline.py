"""From raw documents to token ids: the stages of a training corpus, each a table for the next.

    run(spark, sf_dir) -> encoded documents

1. ``toxicity``: documents that the factorization machine scores at 0.7 or more go.
2. ``exact_dedup``: of equal texts one row stays.
3. ``simhash``: of near-duplicates one row stays.
4. ``mixing``: rows are repeated by the target weights of their sources.
5. ``bpe``: every row is encoded; the result has its ids and their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.bpe import encode_texts
from tablewright.llm.common import ship
from tablewright.llm.exact import drop_exact_copies
from tablewright.llm.mixing import WEIGHTS, mix_sources
from tablewright.llm.queries import WORD_BPE, vocabulary
from tablewright.llm.simhash import drop_near_copies
from tablewright.llm.toxicity import drop_toxic, train
from tablewright.session import freeze


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    raw, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return drop_toxic(docs, train(raw, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_exact_copies(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs, WEIGHTS).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return encode_texts(docs, vocabulary(WORD_BPE), ("n_tokens", "ids"), ("doc_id", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash", simhash),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: A trained model, connected components and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
