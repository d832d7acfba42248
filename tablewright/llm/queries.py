"""The queries of this package over the test tables, and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, exact, mixing, ranked, shards, simhash, suffixes, tokenfiles, toxicity, trie, unigram, vectors
from .common import ship

#: Vocabulary files by name; a caller with files elsewhere passes their paths to the operators.
WORD_BPE, BYTE_BPE, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _shipped(work: Callable[..., DataFrame], file: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return work(spark, folder, vocabulary(file)) if file else work(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _shipped(mixing.op1_mixing),
    "op2_vectors": _shipped(vectors.op2_vectors),
    "op3_exact_dedup": _shipped(exact.op3_exact_dedup),
    "op4_token_counts": _shipped(unigram.op4_token_counts, PIECES),
    "op5_simhash": _shipped(simhash.op5_simhash),
    "op6_chat": _shipped(chat.op6_chat, BYTE_BPE),
    "op7_toxicity": _shipped(toxicity.op7_toxicity),
    "op8_sharding": _shipped(shards.op8_sharding),
    "op9_bpe": _shipped(bpe.op9_bpe, WORD_BPE),
    "op10_tokens": _shipped(tokenfiles.op10_tokens, BYTE_BPE),
    "op11_trie": _shipped(trie.op11_trie),
    "op12_scores": _shipped(suffixes.op12_scores),
    "op13_ranked": _shipped(ranked.op13_ranked),
}

ORACLES = {
    "op1_mixing": mixing.ORACLE,
    "op3_exact_dedup": exact.ORACLE,
    "op6_chat": chat.ORACLE,
    "op8_sharding": shards.ORACLE,
    "op11_trie": trie.ORACLE,
    "op13_ranked": ranked.ORACLE,
}
