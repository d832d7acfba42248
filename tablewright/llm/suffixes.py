"""Scoring texts with a probabilistic suffix tree (operator 12).

The symbols are words and an end of text. A state of the tree is a context of up to ``DEPTH`` words; only
contexts that make up a least part of all training tokens are candidates, so their number has a bound that
does not depend on the corpus. A candidate becomes a state when the distribution after it diverges from that
after its suffix, counted as the gain in log-likelihood with each occurrence left out of its own count. The
next-symbol counts of a state are discounted, and what is taken off is spread by the suffix's distribution,
down to the root, whose counts have 0.5 added. A token is predicted from the longest suffix state of the text
before it.

The next-symbol counts grow with the corpus and are never broadcast. Texts are held in blocks of numbered
words. For each depth a block sends the keys of its own n-grams, once each and packed, to the tasks that sum
them, and gets back the totals in the order in which it sent them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freeze
from .common import column, partitions, send, slices, text_of

DEPTH = 3  # words of the longest context
LEAST_SHARE = 4e-6  # of all training tokens that a context has to make up: at most 250,000 contexts of a length
LEAST_COUNT = 8  # occurrences that it has to have besides
GAIN = 4.0  # nats of log-likelihood by which a context has to predict better than its suffix
DISCOUNT = 0.5  # taken off each count of a state
BLOCK_BYTES = 5 << 20  # bytes of text after which a block ends; a text is never cut
KEYS = 1 << 20  # n-grams of a task that sums them, about
_FIXED = float(1 << 24)  # partial sums are whole multiples of its inverse, so they do not depend on the order

_END = np.uint64(xxhash.xxh64_intdigest(b" "))  # a word is never a blank


def _mix(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The key of an n-gram from that of its beginning and its last word's."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers with equal bytes side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpack(content: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(content), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


BLOCKS = "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, trained bigint, words binary, ids binary"


def write_blocks(docs: DataFrame, held: str) -> DataFrame:
    """The texts of ``docs`` as a stored table with a row per block; ``held`` names the boolean of rows that train nothing.

    ``words`` are the keys of the block's words by falling count, ``ids`` the tokens as places among them.
    """

    limit = BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        part: list[pa.RecordBatch] = []
        size = 0

        def close() -> pa.RecordBatch:
            nonlocal number
            rows = pa.Table.from_batches(part).combine_chunks()
            # Lower case first: Arrow's ascii_lower returns other texts for a slice that has been cast before.
            split = pc.ascii_split_whitespace(pc.ascii_lower(rows.column("text")).cast(pa.large_string())).combine_chunks()
            flat, owner = split.flatten(), pc.list_parent_indices(split)
            full = pc.greater(pc.binary_length(flat), 0)  # blanks at the ends of a text give empty pieces
            coded, owner = pc.dictionary_encode(flat.filter(full)), owner.filter(full).to_numpy()
            n_words = np.bincount(owner, minlength=rows.num_rows)
            ids = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, np.cumsum(n_words), 0)
            keys = np.array([_END, *(xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist())], np.uint64)
            order = np.argsort(-np.bincount(ids, minlength=len(keys)), kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            held = rows.column("held").to_numpy()
            number += 1
            values = ((task << 32) + number, rows.column("doc_id").to_pylist(), held.tolist(), (n_words + 1).tolist(), int((n_words + 1)[~held].sum()), keys[order].tobytes(), zstandard.compress(place[ids].tobytes(), 1))
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=["block", "doc_ids", "held", "lengths", "trained", "words", "ids"])

        for batch in slices(batches):
            part.append(batch)
            size += batch.column(1).nbytes
            if size >= limit:
                yield close()
                part, size = [], 0
        if sum(b.num_rows for b in part):
            yield close()

    rows = docs.select(column("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), F.coalesce(column(held), F.lit(False)).alias("held"))
    return freeze(rows.mapInArrow(run, BLOCKS), "blocks")


class Contexts:
    """The candidate contexts of one length: their keys in order, counts, and (once known) discounts and states."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        self.kinds, self.state = np.zeros(len(keys)), np.zeros(len(keys), bool)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is no candidate."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def pack(self) -> bytes:
        return b"".join(a.tobytes() for a in (self.keys, self.counts, self.kinds, self.state))

    @staticmethod
    def unpack(content: bytes, n: int) -> Contexts:
        made = Contexts(np.frombuffer(content, np.uint64, n), np.frombuffer(content, np.int64, n, 8 * n))
        made.kinds, made.state = np.frombuffer(content, np.float64, n, 16 * n), np.frombuffer(content, bool, n, 24 * n)
        return made


class Block:
    """A block's tokens with the n-grams that end at each of them."""

    def __init__(self, row: dict, contexts: list[Contexts]):
        self.doc_ids, self.held, self.lengths = row["doc_ids"], np.array(row["held"], bool), np.array(row["lengths"], np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.ids = np.frombuffer(zstandard.decompress(row["ids"]), np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.trains = np.repeat(~self.held, self.lengths)
        self.contexts = contexts
        offset = np.arange(len(self.ids)) - np.repeat(self.starts, self.lengths)
        #: For each length: positions that have a candidate before them, its place, and the key of the n-gram.
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        word = self.words[self.ids]
        at, before = np.flatnonzero(offset >= 1), None
        for length, held in enumerate(contexts, 1):
            before = word[at - 1] if length == 1 else before
            place = held.find(before)
            keep = place >= 0
            at, place = at[keep], place[keep]
            key = _mix(before[keep], word[at])
            self.found.append((at, place, key))
            # A context one word longer ends with the same words: its key is that of the n-gram before.
            longer = np.full(len(word), False)
            longer[at] = True
            known = np.zeros(len(word), np.uint64)
            known[at] = key
            at = np.flatnonzero((offset >= length + 1) & np.concatenate([[False], longer[:-1]]))
            before = known[at - 1]

    def asks(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The keys to be summed in order, the occurrences that train, and for which tokens which key stands."""
        if length == 0:
            keys, at, which = np.sort(self.words), np.arange(len(self.ids)), None
            which = np.searchsorted(keys, self.words)[self.ids]
        else:
            at, _, key = self.found[length - 1]
            keys, which = np.unique(key, return_inverse=True)
        return keys, np.bincount(which, self.trains[at], len(keys)).astype(np.int64), at, which


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _shared(spark: SparkSession, contexts: list[Contexts]):
    """A function that gives the contexts on an executor."""
    sizes = [len(c.keys) for c in contexts]
    sent = send(spark, b"".join(c.pack() for c in contexts))

    def get() -> list[Contexts]:
        content, made, at = sent.value, [], 0
        for n in sizes:
            made.append(Contexts.unpack(content[at : at + 25 * n], n))
            at += 25 * n
        return made

    return get


def _totals(blocks: DataFrame, length: int, contexts: list[Contexts], buckets: int, least: int) -> DataFrame:
    """Counts of all n-grams whose context has ``length`` words, as a stored table.

    Rows with ``block`` are the totals for it; the others say how many keys of a bucket have been seen in
    training (``kinds``) and name those with ``least`` or more (``keys``, ``totals``).
    """
    get = _shared(blocks.sparkSession, contexts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, candidates = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64), get()
        for row in _rows(batches):
            keys, counts, _, _ = Block(row, candidates).asks(length)
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            full = [b for b in range(buckets) if cuts[b + 1] > cuts[b]]
            packed = [(_pack(np.diff(keys[cuts[b] : cuts[b + 1]], prepend=np.uint64(0))), _pack(counts[cuts[b] : cuts[b + 1]])) for b in full]
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([row["block"]] * len(full), pa.int64()), pa.array([p[0] for p in packed], pa.binary()), pa.array([p[1] for p in packed], pa.binary())], names=["bucket", "block", "keys", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in groupby(_rows(batches), key=lambda r: r["bucket"]):
            rows = [(r["block"], np.cumsum(_unpack(r["keys"]), dtype=np.uint64), _unpack(r["counts"])) for r in group]
            keys, which = np.unique(np.concatenate([k for _, k, _ in rows]), return_inverse=True)
            totals = np.bincount(which, np.concatenate([c for _, _, c in rows]), len(keys)).astype(np.uint64)
            out, at = [], 0
            for block, own, _ in rows:
                out.append((block, bucket, 0, None, _pack(totals[which[at : at + len(own)]])))
                at += len(own)
            many = totals >= max(least, 1)
            out.append((None, bucket, int((totals > 0).sum()), keys[many].tobytes(), totals[many].tobytes()))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=["block", "bucket", "kinds", "keys", "totals"])

    asked = blocks.mapInArrow(ask, "bucket int, block bigint, keys binary, counts binary")
    dealt = asked.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "block")
    return freeze(dealt.mapInArrow(add, "block bigint, bucket int, kinds bigint, keys binary, totals binary"), "totals")


def _with_totals(blocks: DataFrame, totals: list[DataFrame]) -> DataFrame:
    """Each block with its totals by length and bucket; what comes together is as large as the block's own n-grams."""
    every = None
    for length, table in enumerate(totals):
        own = table.filter("block IS NOT NULL").select("block", F.struct(F.lit(length).alias("length"), "bucket", "totals").alias("t"))
        every = own if every is None else every.unionByName(own)
    return blocks.join(every.groupBy("block").agg(F.collect_list("t").alias("totals")), "block")


def _counts(block: Block, row: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length the tokens with a candidate before them and the total of their n-gram."""
    found = []
    for length in range(len(block.contexts) + 1):
        _, _, at, which = block.asks(length)
        parts = [_unpack(t["totals"]) for t in sorted((t for t in row["totals"] if t["length"] == length), key=lambda t: t["bucket"])]
        found.append((at, (np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64))[which]))
    return found


def _gains(joined: DataFrame, contexts: list[Contexts], tokens: int, kinds: int) -> DataFrame:
    """For each candidate, over its occurrences in training: what its divergence is made of, in whole numbers."""
    get = _shared(joined.sparkSession, contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates = get()
        sums = [np.zeros((3, len(c.keys))) for c in candidates]
        for row in _rows(batches):
            block = Block(row, candidates)
            counts = _counts(block, row)
            suffix = (counts[0][1] + 0.5) / (tokens + 0.5 * (kinds + 1))  # of each token, after the context's suffix
            for length, (held, (at, n)) in enumerate(zip(candidates, counts[1:])):
                place = block.found[length][1]
                trains = block.trains[at]
                at, n, place = at[trains], n[trains], place[trains]
                again = n > 1
                log = np.zeros(len(n))
                log[again] = np.log(n[again] - 1 - DISCOUNT) - np.log(suffix[at[again]])
                for total, part in zip(sums[length], (np.rint(log * _FIXED), ~again, np.rint(_FIXED / n))):
                    total += np.bincount(place, part, len(held.keys))
                all_at, all_n = counts[length + 1]
                suffix = np.full(len(suffix), 1.0)
                suffix[all_at] = np.maximum(all_n - DISCOUNT, DISCOUNT) / held.counts[block.found[length][1]]
        for length, total in enumerate(sums):
            at = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array([length] * len(at), pa.int32()), pa.array(at, pa.int32()), *(pa.array(t[at].astype(np.int64)) for t in total)], names=["length", "place", "log", "once", "kinds"])

    parts = joined.mapInArrow(run, "length int, place int, log bigint, once bigint, kinds bigint")
    return parts.groupBy("length", "place").agg(F.sum("log").alias("log"), F.sum("once").alias("once"), F.sum("kinds").alias("kinds"))


def choose_states(contexts: list[Contexts], sums: DataFrame) -> None:
    """Mark the candidates that diverge; their number has a bound, so the sums are collected."""
    for row in sums.toLocalIterator():
        held, at = contexts[row["length"]], row["place"]
        count, once, kinds = int(held.counts[at]), row["once"], row["kinds"] / _FIXED
        held.kinds[at] = kinds
        fresh = math.log(DISCOUNT * max(kinds - 1, DISCOUNT) / (count - 1))  # a symbol seen once is unseen when it is left out
        gain = row["log"] / _FIXED - (count - once) * math.log(count - 1) + once * fresh
        held.state[at] = gain >= GAIN


def _scores(joined: DataFrame, contexts: list[Contexts], tokens: int, kinds: int) -> DataFrame:
    get = _shared(joined.sparkSession, contexts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates = get()
        for row in _rows(batches):
            block = Block(row, candidates)
            counts = _counts(block, row)
            known = counts[0][1] > 0
            p = base = (counts[0][1] + 0.5) / (tokens + 0.5 * (kinds + 1))
            reached = np.ones(len(p), bool)  # the suffix is a state
            for held, (_, place, _), (at, n) in zip(candidates, block.found, counts[1:]):
                keep = held.state[place] & reached[at]
                at, place, n = at[keep], place[keep], n[keep]
                reached = np.zeros(len(p), bool)
                reached[at] = True
                p = p.copy()
                p[at] = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * held.kinds[place] * p[at]) / held.counts[place]
            per_doc = [np.add.reduceat(v, block.starts) for v in (known.astype(np.int64), np.log10(base), np.log10(p))]
            out = [pa.array(block.doc_ids, pa.int64()), pa.array(block.held), pa.array(block.lengths), pa.array(per_doc[0]), pa.array(np.full(len(block.held), tokens)), pa.array(per_doc[1]), pa.array(per_doc[2])]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return joined.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def score_texts(docs: DataFrame, held: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A tree is learnt from the rows where the boolean column ``held`` is not true, and scores all rows.
    ``base_score`` is the log10 probability of the tokens by their counts alone, ``score`` that by the tree,
    which has one symbol for all words not seen in training. Null, empty and blank texts are an end alone. Texts
    of any length are scored whole, each in one task. Repeated rows and ids count each; a null id stays null. An
    empty table gives an empty table; where no row trains, every symbol is the unseen one. Other columns are not
    read, whatever their names. Words are told apart by 64-bit keys.
    """
    spark = docs.sparkSession
    blocks = write_blocks(docs, held)
    size = blocks.agg(F.coalesce(F.sum("trained"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)), F.lit(0)).alias("all")).first()
    buckets = max(partitions(spark), -(-size["all"] // KEYS))
    least = max(LEAST_COUNT, math.ceil(LEAST_SHARE * size["n"]))
    contexts: list[Contexts] = []
    totals: list[DataFrame] = []
    for length in range(DEPTH + 1):
        table = _totals(blocks, length, contexts, buckets, least)
        totals.append(table)
        if length < DEPTH:  # what has been seen often enough is a context one word longer
            found = [(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["totals"], np.int64)) for r in table.filter("block IS NULL AND length(keys) > 0").select("keys", "totals").toLocalIterator()]
            keys = np.concatenate([np.empty(0, np.uint64), *(k for k, _ in found)])
            counts = np.concatenate([np.empty(0, np.int64), *(c for _, c in found)])
            contexts = [*contexts, Contexts(keys[keys != _END], counts[keys != _END])]
    kinds = totals[0].filter("block IS NULL").agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    joined = _with_totals(blocks, totals)
    choose_states(contexts, _gains(joined, contexts, size["n"], kinds))
    return _scores(joined, contexts, size["n"], kinds)


def op12_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5
    return score_texts(docs.withColumn("held", rest == 1), "held")
