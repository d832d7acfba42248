"""Near-duplicate vectors by a robust-pruned flat graph (operator 2).

Equal vectors are one class, compared once. Cluster centres are fitted to a bounded sample; every
class goes to the shards of its nearest centres, so shards overlap. Each shard gets a flat graph: a
node keeps those of its nearest neighbours that no kept one is much closer to (robust pruning). The
lists of a class from all its shards are united. Every class is then searched for in all its shards:
greedily from the medoids to its surroundings, then on from every class found in range until no more
are in range. Links are verified in double precision where they are found. A link that either side's
search finds is one of both sides; it is counted for both, and joins them, in the first shard that
both share. Shards above ``BLOCK`` are cut into blocks by hash; every two blocks meet in one task, so
a dense cluster is compared in full without being held by one task. Recall is
audited against brute force for a sample of classes that grows with the input, apart for classes with few links.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import column
from .components import connected, stars

log = logging.getLogger(__name__)

COSINE = 0.95
SAMPLE = 20_000  # most classes that centres are fitted to
PER_SHARD = 500  # classes per centre that are aimed at
CENTRES = 2048  # most centres
CLOSE = 0.8  # cosine of centres from which they are one
OVERLAP = 3  # shards of a class
BLOCK = 2048  # classes of a graph, and queries, that one task holds
DEGREE = 24
NEAR = 48  # candidates for the list of a node
ALPHA = 1.2
BEAM = 32
ENTRIES = 16
ONE_IN = 100  # one class in so many has its links counted by brute force
AUDIT = 256  # classes that are audited besides, for small tables
FEW = 4  # most links of the classes whose recall is taken apart
RECALL = 0.9
TRIES = 3


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centres(vectors: np.ndarray, number: int, seed: int = 3) -> np.ndarray:
    """Spherical k-means, a few rounds. Of centres close together one stays, so that a dense cluster is not divided."""
    rng = np.random.default_rng(seed)
    found = vectors[rng.choice(len(vectors), number, replace=False)]
    for _ in range(6):
        nearest = (vectors @ found.T).argmax(1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, vectors)
        sizes = np.linalg.norm(sums, axis=1)
        found = np.where(sizes[:, None] > 1e-9, sums / np.maximum(sizes, 1e-9)[:, None], found)
    apart: list[int] = []
    for i, x in enumerate(found):
        if not apart or (found[apart] @ x).max() < CLOSE:
            apart.append(i)
    return found[apart]


def _prune(candidates: np.ndarray, near: np.ndarray, among: np.ndarray) -> list[int]:
    """Robust pruning on cosine distances. ``near``: of each candidate to the node; ``among``: between candidates."""
    kept: list[int] = []
    alive = np.ones(len(candidates), bool)
    order = np.argsort(near, kind="stable")
    for i in order:
        if not alive[i]:
            continue
        kept.append(int(candidates[i]))
        if len(kept) == DEGREE:
            break
        alive &= ALPHA * among[i] > near
    return kept


def build_graph(x: np.ndarray, seed: int = 5) -> list[np.ndarray]:
    """Neighbours of each row of ``x``, at most ``DEGREE`` of its own choice and those that chose it."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64) for _ in range(n)]
    rng = np.random.default_rng(seed)
    lists: list[set[int]] = [set() for _ in range(n)]
    first_choice: list[list[int]] = [[] for _ in range(n)]
    for first in range(0, n, 256):
        similar = x[first : first + 256] @ x.T
        similar[np.arange(len(similar)), np.arange(first, first + len(similar))] = -2
        k = min(NEAR, n - 1)
        nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        for row, candidates in enumerate(nearest):
            i = first + row
            candidates = np.union1d(candidates, rng.integers(0, n, 8))
            candidates = candidates[candidates != i]
            own = x[candidates]
            chosen = _prune(candidates, 1 - own @ x[i], 1 - own @ own.T)
            first_choice[i] = chosen[:2]
            for j in chosen:
                lists[i].add(j)
                lists[j].add(i)
    for i, neighbours in enumerate(lists):
        if len(neighbours) > 2 * DEGREE:
            candidates = np.array(sorted(neighbours))
            own = x[candidates]
            lists[i] = set(_prune(candidates, 1 - own @ x[i], 1 - own @ own.T))
    for i, chosen in enumerate(first_choice):  # no node is left without a way to it
        for j in chosen:
            lists[j].add(i)
    return [np.array(sorted(s), np.int64) for s in lists]


def range_search(q: np.ndarray, x: np.ndarray, graph: list[np.ndarray], entries: np.ndarray, least: float = COSINE, beam: int = BEAM) -> np.ndarray:
    """Rows of ``x`` within range of ``q`` that the search comes upon."""
    similar = np.full(len(x), -2.0)
    similar[entries] = x[entries] @ q
    best, expanded = entries, np.zeros(len(x), bool)

    def look(nodes: np.ndarray) -> np.ndarray:
        expanded[nodes] = True
        ahead = np.zeros(len(x), bool)
        if len(nodes):
            ahead[np.concatenate([graph[i] for i in nodes])] = True
        new = np.flatnonzero(ahead & (similar < -1.5))
        if len(new):
            similar[new] = x[new] @ q
        return new

    while True:
        todo = best[~expanded[best]][:8]
        if not len(todo):
            break
        best = np.concatenate([best, look(todo)])
        if len(best) > beam:
            best = best[np.argsort(-similar[best], kind="stable")[:beam]]
    # On from all in range; some slack, as the way between two may pass just outside.
    slack = least - 0.1
    front = np.flatnonzero((similar >= slack) & ~expanded)
    while len(front):
        new = look(front)
        front = new[similar[new] >= slack]
    return np.flatnonzero(similar >= least - 1e-9)


def _valid(embedding: Column) -> Column:
    values = embedding.cast("array<double>")
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(values, lambda v: v != 0), F.lit(False))


def classes(rows: DataFrame) -> DataFrame:
    """``cid`` (a number), ``vec_id`` (smallest), ``copies``, ``v`` and ``x`` (unit length) of each different vector."""
    grouped = rows.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(0).to_pylist():
                x = np.array(v)
                x = x / np.abs(x).max()  # very large and very small components
                out.append(x / np.linalg.norm(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=["v", "vec_id", "copies", "x"])

    united = grouped.mapInArrow(run, "v array<double>, vec_id bigint, copies bigint, x array<double>")
    return freeze(united.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")


def _matrix(column) -> np.ndarray:
    return np.vstack(list(column))


def _overlapping(found: DataFrame, overlap: int, size: int) -> DataFrame:
    """Each class in the shards of its nearest centres: ``cell, cells`` (all its shards), ``cid, copies, x, blocks, block``."""
    sample = found.select("x", F.size("x").alias("d")).orderBy(F.xxhash64("cid")).limit(SAMPLE).collect()
    fitted: dict[int, np.ndarray] = {}
    for d in {r["d"] for r in sample}:
        own = np.array([r["x"] for r in sample if r["d"] == d])
        fitted[d] = centres(own, min(len(own), CENTRES, max(1, size // PER_SHARD)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for d, part in frame.groupby(frame["x"].map(len)):
                x = _matrix(part["x"])
                # A dimension that the sample lacks is one shard.
                near = np.argsort(-(x @ fitted[d].T), axis=1, kind="stable")[:, :overlap] if d in fitted else np.zeros((len(x), 1), int)
                k = near.shape[1]
                at = np.repeat(np.arange(len(part)), k)
                cells = (d << 32) + near
                yield pd.DataFrame({"cell": cells.ravel(), "cells": list(cells[at]), "cid": part["cid"].to_numpy()[at], "copies": part["copies"].to_numpy()[at], "x": list(x[at])})

    dealt = freeze(found.mapInPandas(run, "cell bigint, cells array<bigint>, cid bigint, copies bigint, x array<double>"), "vector-shards")
    blocks = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
    return dealt.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks").cast("bigint")).cast("int"))


def _lists(shards: DataFrame) -> DataFrame:
    """``cid`` and ``next``, the united lists of its shards."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cid")
        ids = frame["cid"].to_numpy()
        graph = build_graph(_matrix(frame["x"]))
        return pd.DataFrame({"cid": ids, "next": [ids[g] for g in graph]})

    built = shards.groupBy("cell", "block").applyInPandas(run, "cid bigint, next array<bigint>")
    return built.groupBy("cid").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next"))


def _entries(x: np.ndarray) -> np.ndarray:
    """Where a search begins: the medoid, and medoids of the parts that fall to a few spread members."""
    spread = x[np.linspace(0, len(x) - 1, min(ENTRIES, len(x))).astype(int)]
    part = (x @ spread.T).argmax(1)
    entries = {int((x @ x.mean(0)).argmax())}
    for p in np.unique(part):
        members = np.flatnonzero(part == p)
        entries.add(int(members[(x[members] @ x[members].mean(0)).argmax()]))
    return np.array(sorted(entries))


def _found(queries: pd.DataFrame, targets: pd.DataFrame, least: float, beam: int) -> np.ndarray:
    """Which targets (columns) the search for each query (rows) finds within range."""
    ids, x = targets["cid"].to_numpy(), _matrix(targets["x"])
    graph = []
    for wanted in targets["next"]:
        at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
        graph.append(at[ids[at] == wanted])
    entries = _entries(x)
    linked = np.zeros((len(queries), len(ids)), bool)
    for row, q in enumerate(queries["x"]):
        near = range_search(np.asarray(q), x, graph, entries, least, beam)
        linked[row, near[(x[near] * q).sum(1) >= least]] = True
    return linked


def _met_before(cell: int, left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Which rows share a shard that comes before ``cell``; the same whichever of the two is on the left."""
    a, b = _matrix(left["cells"]), _matrix(right["cells"])
    met = np.zeros((len(a), len(b)), bool)
    for other in np.intersect1d(a[a < cell], b[b < cell]):
        met[np.ix_((a == other).any(1), (b == other).any(1))] = True
    return met


def _tally(linked: np.ndarray, left: pd.DataFrame, right: pd.DataFrame, same: bool) -> pd.DataFrame:
    """Counts of both sides and stars, see ``_search``. ``same``: left and right are one block, ``linked`` is symmetric."""
    ids, others = left["cid"].to_numpy(), right["cid"].to_numpy()
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in range(0, len(ids), 64):
        row, col = np.nonzero(linked[first : first + 64])
        a.append(ids[first + row])
        b.append(others[col])
        if sum(map(len, a)) > 100_000:
            thin = stars(np.concatenate(a), np.concatenate(b))
            a, b = [thin[0]], [thin[1]]
    a, b = stars(np.concatenate(a), np.concatenate(b))
    counted = [(ids, linked @ right["copies"].to_numpy())]
    if not same:
        counted.append((others, linked.T @ left["copies"].to_numpy()))
    out = [pd.DataFrame({"a": i[n > 0], "b": i[n > 0], "n": pd.array(n[n > 0], "Int64")}) for i, n in counted]
    return pd.concat([*out, pd.DataFrame({"a": a, "b": b, "n": pd.array([None] * len(a), "Int64")})])


def _search(shards: DataFrame, lists: DataFrame, least: float, beam: int) -> DataFrame:
    """Counts (``a`` the class, ``n`` its linked vectors in a block) and links (``n`` null), as stars."""
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    known = shards.join(lists, "cid").select("cell", "cells", "block", every, "cid", "copies", "x", "next")
    known = known.select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cells", "block", "cid", "copies", "x", "next")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cid")
        cell, i, j = (int(frame[c].iloc[0]) for c in ("cell", "i", "j"))
        left, right = frame[frame["block"] == i], frame[frame["block"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "n": pd.Series(dtype="Int64")})
        linked = _found(left, right, least, beam)
        linked |= (linked if i == j else _found(right, left, least, beam)).T
        if i == j:
            np.fill_diagonal(linked, False)
        linked &= ~_met_before(cell, left, right)
        return _tally(linked, left, right, i == j)

    return freeze(known.groupBy("cell", "i", "j").applyInPandas(run, "a bigint, b bigint, n bigint"), "vector-links")


def _recall(found: DataFrame, counts: DataFrame, least: float, size: int, more: bool = False) -> float | None:
    """The worst share of true links that ``counts`` holds: of all links of the audited classes, of the links of
    a class on average, of the links of classes with at most ``FEW``. None where the audited have no link.

    Audited are one class in ``ONE_IN`` by a hash of its id, and ``AUDIT`` more; with ``more`` ten times the former, and
    ``AUDIT`` classes of which a link was found. They are compared with all classes in blocks of both.
    """
    order = F.xxhash64("vec_id", "cid")
    first = [r["cid"] for r in found.select("cid", order.alias("h")).orderBy("h").limit(AUDIT).collect()]
    if more:
        first += [r["a"] for r in counts.filter("n > 0").orderBy(F.xxhash64("a")).limit(AUDIT).collect()]
    one_in = max(1, ONE_IN // 10) if more else ONE_IN
    asked = freeze(found.filter((F.pmod(order, F.lit(one_in)) == 0) | F.col("cid").isin(first)).select("cid", "copies", "x"), "vector-audit")
    parts = {"i": max(1, -(-asked.count() // BLOCK)), "j": max(1, -(-size // BLOCK))}

    def dealt(frame: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("cid"), F.lit(parts[own])).cast("int").alias(own)
        return frame.select(F.size("x").alias("d"), block, F.explode(F.sequence(F.lit(0), F.lit(parts[other] - 1))).alias(other), F.lit(asks).alias("asks"), "cid", "copies", "x").select("d", "i", "j", "asks", "cid", "copies", "x")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        queries, targets = frame[frame["asks"]], frame[~frame["asks"]]
        if not len(queries) or not len(targets):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "true": pd.Series(dtype="int64")})
        linked = (_matrix(queries["x"]) @ _matrix(targets["x"]).T >= least) & (queries["cid"].to_numpy()[:, None] != targets["cid"].to_numpy())
        return pd.DataFrame({"a": queries["cid"].to_numpy(), "true": linked @ targets["copies"].to_numpy()})

    both = dealt(asked, "i", "j", True).unionByName(dealt(found, "j", "i", False))
    true = both.groupBy("d", "i", "j").applyInPandas(run, "a bigint, true bigint").groupBy("a").agg(F.sum("true").alias("true")).filter(F.col("true") > 0)
    hit = true.join(counts, "a", "left").withColumn("hit", F.least("true", F.coalesce("n", F.lit(0))))
    few = F.col("true") <= FEW
    figures = hit.agg(F.sum("hit") / F.sum("true"), F.avg(F.col("hit") / F.col("true")), F.sum(F.when(few, F.col("hit"))) / F.sum(F.when(few, F.col("true")))).first()
    return min((f for f in figures if f is not None), default=None)


def _compared(found: DataFrame, least: float, size: int) -> DataFrame:
    """Like ``_search``, by comparing every two blocks of all classes in full."""
    blocks = max(1, -(-size // BLOCK))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    dealt = found.select(F.size("x").alias("d"), F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int").alias("block"), every, "cid", "copies", "x")
    dealt = dealt.select("d", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "copies", "x")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        left, right = frame[frame["block"] == i], frame[frame["block"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "n": pd.Series(dtype="Int64")})
        linked = _matrix(left["x"]) @ _matrix(right["x"]).T >= least
        if i == j:
            linked |= linked.T
            np.fill_diagonal(linked, False)
        return _tally(linked, left, right, i == j)

    return freeze(dealt.groupBy("d", "i", "j").applyInPandas(run, "a bigint, b bigint, n bigint"), "vector-links")


def near_vectors(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept, audit_recall``.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing; vectors
    of different lengths and those without ``vec_id`` do not either. Equal vectors link with each other, those
    of repeated rows too. The search is repeated with more shards and a wider beam while the
    audited recall is below ``RECALL``; if it still is after ``TRIES``, all classes are compared in full.
    ``audit_recall`` is the last figure (1.0 after comparing in full), null ("not measured") where the audited
    classes have no link, also after ten times as many were asked. An empty table gives an empty table. Other columns
    are not read, whatever their names.
    """
    rows = vectors.select(column("vec_id").cast("bigint").alias("vec_id"), column("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("ok", _valid(F.col("v")) & F.col("vec_id").isNotNull())
    found = classes(rows.filter("ok").select("vec_id", "v"))
    size = found.count()
    overlap, beam = OVERLAP, BEAM
    for _ in range(TRIES):
        shards = freeze(_overlapping(found.select("cid", "copies", "x"), overlap, size), "vector-blocks")
        links = _search(shards, freeze(_lists(shards), "vector-lists"), least, beam)
        counts = links.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
        audited = found.select("cid", "vec_id", "copies", "x")
        recall = _recall(audited, counts, least, size)
        if recall is None:  # none of the audited has a link: look further before that is taken for a success
            recall = _recall(audited, counts, least, size, more=True)
        if recall is None or recall >= RECALL:
            break
        log.warning("audited recall %.3f with %d shards a class is below %s", recall, overlap, RECALL)
        overlap, beam = 2 * overlap, 2 * beam
    else:
        log.warning("comparing all %d classes in full", size)
        links, recall = _compared(found.select("cid", "copies", "x"), least, size), 1.0
        counts = links.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    roots = connected(links.filter("n IS NULL").select("a", "b")).withColumnRenamed("node", "cid")
    rooted = found.select("cid", "v", "vec_id", "copies").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = rooted.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    done = rooted.join(names, "root").join(counts.withColumnRenamed("a", "cid"), "cid", "left")
    done = done.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = rows.filter("ok").join(done, "v").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumn("audit_recall", F.lit(recall).cast("double"))


def op2_vectors(spark, folder: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
