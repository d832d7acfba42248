"""SimHash near-duplicates found over Golay codewords (operator 5).

A fingerprint of 64 bits is cut into three segments. Each is read as a word of the perfect
(23, 12) Golay code; the codewords within four bits of it, one or six of them, are its indices, and
two segments within two bits of each other always share one (``golay_indices``). Of four wrong bits

- either some segment has none: that segment itself and an index of another one, which then has at
  most two, are equal;
- or every segment has one or two, and at least two segments have just one: for these, the nearest
  codewords of one fingerprint are among the indices of the other.

So equal keys of the nine tables below bring every pair within four bits together, and the
distance is checked before a link is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze
from .common import PART_CHARS, PART_ROWS, column, fresh, gathered, partitions, text_of
from .components import connected, stars

BITS = 4  # most differing bits of a link
WORDS = 4  # words of a shingle
SEED = 42
RUN = 8192  # fingerprints with one key that a task compares by itself; more are dealt out in tiles
HELD = 500_000  # links a task holds before it thins them out
KEYS = 117  # keys of a fingerprint, on average
SHINGLES = 1 << 16  # shingles whose bits are counted at a time

GENERATOR = 0b110001110101  # of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and number of bits


def fingerprint(text: str) -> int:
    """The fingerprint of a text, unsigned. Only A-Z are lower-cased; without words it is zero."""
    words = text.encode().lower().split()  # of bytes: splits at the six ASCII blanks only
    if not words:
        return 0
    n = max(1, len(words) - WORDS + 1)
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])[:n].tolist()
    stops = stops[min(WORDS, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for first in range(0, n, SHINGLES):
        spans = zip(starts[first : first + SHINGLES], stops[first : first + SHINGLES])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits((ones * 2 > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *more) -> DataFrame:
    """``doc_id``, the columns ``more`` computed on ``docs``, and ``fp`` (the fingerprint as a signed number)."""
    rows = docs.select(column("doc_id").cast("bigint").alias("doc_id"), *more, text_of().alias("text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "fp bigint"])
    names = [*rows.columns[:-1], "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(found.view(np.int64))], names=names)

    return rows.mapInArrow(run, schema)


def _golay_tables():
    remainders = np.zeros(4096, np.int64)  # of x^11 times a message
    for message in range(4096):
        word = message << 11
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << bit - 11
        remainders[message] = word
    nearest, weight = np.zeros(2048, np.int64), np.zeros(2048, np.int64)
    others: list[list[int]] = [[] for _ in range(2048)]
    for size in range(5):
        for places in combinations(range(23), size):
            error = sum(1 << p for p in places)
            syndrome = remainders[error >> 11] ^ (error & 2047)
            if size < 4:
                nearest[syndrome], weight[syndrome] = error, size
            else:
                others[syndrome].append(error)
    far = np.array([x if len(x) == 5 else [0] * 5 for x in others])
    return remainders, nearest, far, weight == 3


_REMAINDERS, _NEAREST, _FAR, _SIX = _golay_tables()


def golay_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages of the codewords within four bits, nearest first, as an array of six columns, and which are in use."""
    syndromes = _REMAINDERS[words >> 11] ^ (words & 2047)
    near = (words ^ _NEAREST[syndromes])[:, None]
    codes = np.concatenate([near, words[:, None] ^ _FAR[syndromes]], axis=1) >> 11
    used = np.repeat(_SIX[syndromes][:, None], 6, axis=1)
    used[:, 0] = True
    return codes, used


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of fingerprints, and the place of each key's fingerprint.

    The lowest bit of a key is 0 on fingerprints that are compared with all others of the key, 1 on
    those that are compared with the former only.
    """
    bits = fps.view(np.uint64)
    segments = [((bits >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    indices = [golay_indices(s) for s in segments]
    found, places, table = [], [], 0
    for whole, other in permutations(range(3), 2):
        codes, used = indices[other]
        at, k = np.nonzero(used)
        found.append((table << 36 | segments[whole][at] << 12 | codes[at, k]) << 1)
        places.append(at)
        table += 1
    for one, two in combinations(range(3), 2):
        (codes, used), (codes2, used2) = indices[one], indices[two]
        at, j, k = np.nonzero(used[:, :, None] & used2[:, None, :])
        found.append((table << 36 | codes[at, j] << 12 | codes2[at, k]) << 1 | ((j > 0) | (k > 0)))
        places.append(at)
        table += 1
    return np.concatenate(found), np.concatenate(places)


def _compare(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key."""
    group, first = key >> 1, (key & 1) == 0
    at, step, a, b = np.flatnonzero(first), 1, [], []
    while len(at):
        at = at[at + step < len(key)]
        at = at[group[at] == group[at + step]]
        near = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= BITS]
        a.append(fp[near])
        b.append(fp[near + step])
        step += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


class _Links:
    """Links of a task, thinned out to stars when there are many."""

    def __init__(self):
        self.a, self.b, self.n = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.a.append(a)
        self.b.append(b)
        self.n += len(a)
        if self.n > HELD:
            self._thin()
            if self.n > HELD // 2:
                yield from self.rest()

    def _thin(self) -> None:
        a, b = stars(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.n = [a], [b], len(a)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            self._thin()
            yield _rows(self.a[0], self.b[0], np.zeros(self.n, np.int32))
            self.a, self.b, self.n = [], [], 0


def _rows(a, b, slices) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(slices)], names=["a", "b", "slices"])


def links(fps: DataFrame, run_rows: int = RUN) -> DataFrame:
    """The links of ``counted_links``."""
    return counted_links(fps, run_rows)[0]


def counted_links(fps: DataFrame, run_rows: int = RUN) -> tuple[DataFrame, int | None]:
    """Links ``a``, ``b`` that connect the same fingerprints as all pairs within four bits do, and their number if known.

    ``fps``: different fingerprints ``fp``. Keys are shuffled and sorted; a task compares the run of
    each key and gives links as stars, never all pairs of a run. A run longer than ``run_rows`` is cut
    into slices, and every two slices are a tile that some task compares.
    """
    spark = fps.sparkSession

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for start in range(0, len(values), 4096):
                part = values[start : start + 4096]
                key, at = keys(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[at])], names=["key", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, fp = _Links(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []  # batches of the run that is not over yet

        def settle(key, fp):
            group = key >> 1
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            long = np.repeat(sizes > run_rows, sizes)
            if long.any():
                n = np.repeat(-(-sizes // run_rows), sizes)[long].astype(np.int32)
                yield _rows(key[long], fp[long], n)
                key, fp = key[~long], fp[~long]
            yield from held.add(*_compare(key, fp))

        for batch in batches:
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            over = np.searchsorted(key >> 1, key[-1] >> 1)  # the last run may go on
            if over or (waiting and waiting[0][0][0] >> 1 != key[0] >> 1):
                waiting.append((key[:over], fp[:over]))
                yield from settle(*map(np.concatenate, zip(*waiting)))
                waiting = []
            waiting.append((key[over:], fp[over:]))
        if waiting:
            yield from settle(*map(np.concatenate, zip(*waiting)))
        yield from held.rest()

    rows = fps.select("fp").mapInArrow(spread, "key bigint, fp bigint")
    rows = rows.repartition(partitions(spark), F.shiftright("key", 1)).sortWithinPartitions("key")
    found = rows.mapInArrow(compare, "a bigint, b bigint, slices int")
    found = freeze(gathered(found, KEYS * fps.count(), PART_ROWS), "simhash-links")
    near, long = found.filter("slices = 0").select("a", "b"), found.filter("slices > 0")
    n_near, n_long = found.agg(F.count_if(F.col("slices") == 0), F.count_if(F.col("slices") > 0)).first()
    if not n_long:
        return near, n_near

    def tile(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        key, fp, side = (frame[c].to_numpy() for c in ("key", "fp", "side"))
        a, b = [], []
        for i in np.flatnonzero((key & 1) == 0):
            others = fp if frame["i"].iat[0] == frame["j"].iat[0] else fp[side != side[i]]
            near = others[np.bitwise_count((others ^ fp[i]).view(np.uint64)) <= BITS]
            a.append(np.full(len(near), fp[i]))
            b.append(near)
        a, b = stars(np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])
        return pd.DataFrame({"a": a, "b": b})

    own = F.pmod(F.xxhash64("b"), F.col("slices").cast("bigint"))
    dealt = long.select(F.col("a").alias("key"), F.col("b").alias("fp"), own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - F.lit(1).cast("bigint"))).alias("other"))
    dealt = dealt.select(F.shiftright("key", 1).alias("group"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.col("own").alias("side"), "key", "fp")
    return near.unionByName(dealt.groupBy("group", "i", "j").applyInPandas(tile, "a bigint, b bigint")), None


def classes(rows: DataFrame) -> DataFrame:
    """``fp``, ``root`` of its component and ``component_id`` (smallest ``doc_id`` reachable), one row per fingerprint."""
    distinct = freeze(gathered(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), rows.count(), PART_ROWS), "fingerprints")
    roots = connected(*counted_links(distinct))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    Null texts are empty; texts without words have fingerprint zero, which links like any other.
    Repeated rows are returned each. A null ``doc_id`` never names a component; one that has no other
    ids gets null. Other columns are not read. Links are made between different fingerprints only.
    """
    rows = freeze(fingerprints(docs), "simhash")
    found = rows.join(classes(rows), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per component: the smallest ``doc_id``, all columns as they were.

    Where several rows of a component have that id, the one with the smallest hash of its text stays,
    and of repeated rows one. A row with a null id stays only where its component has no other ids.
    """
    hashed, least_hash, doc, place = fresh(docs, "_hash", "_least_hash", "_doc", "_place")
    rows = freeze(fingerprints(docs, F.xxhash64(text_of()).alias("hash"), F.char_length(text_of()).alias("chars")), "simhash")
    chars = rows.agg(F.sum("chars")).first()[0] or 0
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "hash"))
    staying = rows.join(classes(rows), "fp").groupBy("root").agg(first.alias("first"))
    staying = staying.select(F.col("first.doc_id").alias(doc), F.col("first.hash").alias(least_hash))
    marked = docs.withColumn(hashed, F.xxhash64(text_of()))
    joined = marked.join(staying, (F.col(hashed) == F.col(least_hash)) & column("doc_id").cast("bigint").eqNullSafe(F.col(doc)))
    order = Window.partitionBy(hashed, doc).orderBy(F.lit(1))
    kept = joined.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).select(*[column(c) for c in docs.columns])
    return gathered(kept, chars, PART_CHARS)


def op5_simhash(spark, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
