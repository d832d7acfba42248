"""Conversation prefix tries in balanced parentheses (operator 11).

Conversations that begin with the same turns share nodes. A node is named by a running sum over the turns up
to it, which is worked out in slices of the ordered turns, so no conversation has to be read by one task.
Counts per node are plain aggregates. What concerns whole subtrees, leaves and savings, is read off
balanced-parentheses sequences: the conversations are dealt to shards by hash, and a shard writes its paths
as one sequence, depth first. The first close below an open delimits its subtree (found over blocks with the least
and greatest excess), the rank of ``()`` counts leaves, and cumulative arrays over the opens give savings.
A node belongs to its smallest conversation, whose shard alone counts it, so that the spines that several
shards share are merged by addition. Turns that a single conversation holds are a chain below the last
shared node and stand in the sequence as one pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freeze
from .common import column, partitions

SHARD_TURNS = 1 << 20  # shared turns of a shard, about
BLOCK = 256  # parentheses of a block
SHARED_TURNS, GROUP = 6, 100  # of the query: conversations begin with fewer than 6 turns of the first of their hundred

_PRIME = (1 << 127) - 1
_BASE = int.from_bytes(hashlib.sha256(b"conversation turns").digest()[:16]) % _PRIME
ROOT = bytes(16)


class Parens:
    """A balanced sequence (1 opens, 0 closes) with excess blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(np.int8)
        self.n = len(bits)
        self.excess = np.cumsum(2 * self.bits - 1, dtype=np.int32)
        starts = np.arange(0, self.n, BLOCK)
        leaves = 1 << max(0, (len(starts) - 1).bit_length())
        # Over blocks, as heaps: least and greatest excess in what is below an entry.
        self.least, self.most = np.full(2 * leaves, 1 << 30, np.int64), np.full(2 * leaves, -(1 << 30), np.int64)
        if self.n:
            self.least[leaves : leaves + len(starts)] = np.minimum.reduceat(self.excess, starts)
            self.most[leaves : leaves + len(starts)] = np.maximum.reduceat(self.excess, starts)
        for i in range(leaves - 1, 0, -1):
            self.least[i], self.most[i] = min(self.least[2 * i], self.least[2 * i + 1]), max(self.most[2 * i], self.most[2 * i + 1])
        self.leaves = leaves
        pairs = np.zeros(self.n + 1, np.int64)
        pairs[2:] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.pairs = np.cumsum(pairs)  # ``()`` that end before a place
        self.opens = np.concatenate([[0], np.cumsum(self.bits, dtype=np.int64)])

    def _first(self, start: int, end: int, wanted: int) -> int:
        found = self.excess[start:end] == wanted
        at = int(found.argmax()) if len(found) else 0
        return start + at if len(found) and found[at] else -1

    def find_close(self, i: int) -> int:
        """The place of the close that belongs to the open at ``i``: the first after it with an excess one less."""
        wanted, block = int(self.excess[i]) - 1, i // BLOCK
        at = self._first(i + 1, min(self.n, (block + 1) * BLOCK), wanted)
        if at >= 0:
            return at
        node = self.leaves + block
        while node % 2 or not self.least[node + 1] <= wanted <= self.most[node + 1]:  # up, to a right neighbour that has it
            node //= 2
            if node <= 1:
                raise ValueError("the sequence is not balanced")
        node += 1
        while node < self.leaves:
            node = 2 * node if self.least[2 * node] <= wanted <= self.most[2 * node] else 2 * node + 1
        block = node - self.leaves
        return self._first(block * BLOCK, min(self.n, (block + 1) * BLOCK), wanted)

    def leaves_within(self, i: int, j: int) -> int:
        """Pairs ``()`` among the parentheses from ``i`` to ``j``."""
        return int(self.pairs[j + 1] - self.pairs[i + 1])

    def opens_before(self, i: int) -> int:
        return int(self.opens[i])


class Shard:
    """The paths of some conversations as a trie; every node is the child of the one before it on its path."""

    def __init__(self):
        self.place = {ROOT: 0}
        self.children: list[list[int]] = [[]]
        self.named: list[bytes | None] = [ROOT]
        self.saved, self.childless = [0], [False]

    def add(self, path: list[tuple]) -> None:
        """Entries (name, or None for a chain of its own; savings counted here; whether it has no children anywhere)."""
        at = 0
        for name, saved, childless in path:
            known = self.place.get(name) if name is not None else None
            if known is None:
                known = len(self.named)
                self.children[at].append(known)
                self.children.append([])
                self.named.append(name)
                self.saved.append(0)
                self.childless.append(childless)
                if name is not None:
                    self.place[name] = known
            self.saved[known] += saved
            at = known

    def sums(self) -> Iterator[tuple[bytes, int, int]]:
        """Name, leaves and savings of the subtree of each named node, as far as they are counted in this shard."""
        bits, order, stack = np.zeros(2 * len(self.named), np.int8), [], [0]
        opened = np.zeros(len(self.named), np.int64)
        n = 0
        while stack:
            node = stack.pop()
            if node >= 0:
                bits[n], opened[node] = 1, n
                order.append(node)
                stack.append(-1)
                stack += reversed(self.children[node])
            n += 1
        parens = Parens(bits)
        saved = np.concatenate([[0], np.cumsum([self.saved[i] for i in order])])
        # A pair whose node has children in other shards alone is no leaf.
        cut = np.concatenate([[0], np.cumsum([not self.children[i] and not self.childless[i] for i in order])])
        for node, name in enumerate(self.named):
            if name is not None:
                i = int(opened[node])
                j = parens.find_close(i)
                a, b = parens.opens_before(i), parens.opens_before(j + 1)
                yield name, parens.leaves_within(i, j) - int(cut[b] - cut[a]), int(saved[b] - saved[a])


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, digest, chars`` of every turn in order, as a stored table.

    Turns are in order of ``turn``, nulls first, and then of their digests; repeated rows are turns of their
    own. A null role or text is empty. Rows without ``conv_id`` belong to no conversation and are left out.
    """
    role, text = (F.coalesce(column(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(column("conv_id").isNotNull()).select(
        column("conv_id").cast("bigint").alias("conv_id"), column("turn").cast("bigint").alias("turn"), _digest(role, text).alias("digest"), F.char_length(text).cast("bigint").alias("chars")
    )
    # A stored number tells equal turns apart, so that even these are cut into slices.
    stored = freeze(rows.withColumn("number", F.monotonically_increasing_id()), "turns")
    return _running(stored, [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("number")]).select("conv_id", "place", "digest", "chars")


def _running(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``conv_id, place, name, parent, digest, chars``: places within each conversation and names of its beginnings.

    The rows are cut into slices of their order; each is numbered and summed on its own, and a slice that goes on
    with a conversation gets what comes before it, which is one number and one sum for each slice.
    """
    n = partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(n, F.col("conv_id"), *order).sortWithinPartitions(F.col("conv_id"), *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        at, place, total, power = None, 0, 0, 1
        for batch in batches:
            places, names = [], []
            for conv, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv != at:
                    at, place, total, power = conv, 0, 0, 1
                total = (total + int.from_bytes(digest) * power) % _PRIME
                power = power * _BASE % _PRIME
                places.append(place)
                names.append(total.to_bytes(16))
                place += 1
            yield pa.RecordBatch.from_arrays([pa.array([number] * len(places), pa.int32()), batch.column(0), pa.array(places, pa.int64()), pa.array(names, pa.binary()), batch.column(1), batch.column(2)], names=["slice", "conv_id", "place", "name", "digest", "chars"])

    cut = freeze(dealt.select("conv_id", "digest", "chars").mapInArrow(run, "slice int, conv_id bigint, place bigint, name binary, digest binary, chars bigint"), "slices")
    before: dict[int, tuple[int, int, int]] = {}  # by slice: conversation that goes on, its turns and their sum so far
    conv, turns, total = None, 0, 0
    for row in cut.groupBy("slice").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place", "name")).alias("last")).orderBy("slice").collect():
        if row["first"] == conv:
            before[row["slice"]] = (conv, turns, total)
        goes_on = row["last"]["conv_id"] == conv
        turns, total = (turns, total) if goes_on else (0, 0)
        total = (total + int.from_bytes(row["last"]["name"]) * pow(_BASE, turns, _PRIME)) % _PRIME
        conv, turns = row["last"]["conv_id"], turns + row["last"]["place"] + 1

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = {k: pow(_BASE, v[1], _PRIME) for k, v in before.items()}
        for batch in batches:
            places, names, parents = [], [], []
            for number, conv, place, name, digest in zip(*(batch.column(i).to_pylist() for i in range(5))):
                held = before.get(number)
                if held and held[0] == conv:
                    place += held[1]
                    name = ((held[2] + int.from_bytes(name) * powers[number]) % _PRIME).to_bytes(16)
                places.append(place)
                names.append(name)
                parents.append(((int.from_bytes(name) - int.from_bytes(digest) * pow(_BASE, place, _PRIME)) % _PRIME).to_bytes(16))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(places, pa.int64()), pa.array(names, pa.binary()), pa.array(parents, pa.binary()), batch.column(4), batch.column(5)], names=["conv_id", "place", "name", "parent", "digest", "chars"])

    return cut.mapInArrow(go_on, "conv_id bigint, place bigint, name binary, parent binary, digest binary, chars bigint")


def rebuild(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, part, place, digest, chars``: each conversation begins with turns of the first of its hundred.

    The first h turns of that one (h below ``SHARED_TURNS``, from the id's checksum) stand in place of its own first h.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS
    first = turns.filter((F.pmod("conv_id", F.lit(GROUP)) == 0) & (F.col("place") < SHARED_TURNS - 1))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("turns"))
    taken = ids.select("conv_id", (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("base"), h.alias("h")).join(first, "base")
    begun = taken.select("conv_id", F.lit(0).alias("part"), F.explode(F.filter("turns", lambda t: t["place"] < F.col("h"))).alias("t")).select("conv_id", "part", "t.place", "t.digest", "t.chars")
    return begun.unionByName(turns.filter(F.col("place") >= h).select("conv_id", F.lit(1).alias("part"), "place", "digest", "chars"))


NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(turns: DataFrame, ids: DataFrame, order: list[str]) -> DataFrame:
    """One row per distinct beginning of conversations (``NODES``), from the turnless root on.

    ``turns`` has ``conv_id, digest, chars`` and the columns of ``order``, which must be unique in a conversation;
    ``ids`` has every ``conv_id`` once, also those without turns. No conversations, no rows. A node is named by its
    smallest member; ``saved_tokens`` adds over its subtree the characters of each last turn for all members but one;
    ``ends_sha256`` is over the members that end there. Members that end at the same node are hashed in order by
    one task, which holds none of them; a task holds the shared turns of its shard.
    """
    spark = turns.sparkSession
    rows = freeze(_running(turns, [F.col(c) for c in order]), "named-turns")
    everyone = ids.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    per_name = rows.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), (F.min("place") + 1).alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"), F.min("parent").alias("parent")
    )
    top = ids.limit(1).select(
        F.lit(ROOT).alias("name"), F.lit(everyone["least"]).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"), F.lit(everyone["n"]).alias("n_convs"), F.lit(0).cast("bigint").alias("chars"), F.lit(None).cast("binary").alias("parent")
    )
    nodes = freeze(per_name.unionByName(top), "nodes")
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    shared = freeze(nodes.filter("n_convs > 1 AND depth > 0").join(children, "name", "left").select("name", "conv_id", "n_convs", "chars", F.col("n_children").isNull().alias("childless")), "shared-nodes")

    sums = _subtree_sums(rows, shared, spark)
    ends = _ends(rows, ids)
    full = nodes.join(children, "name", "left").join(sums, "name", "left").join(ends, "name", "left")
    # A parent that is not shared is of the same conversation; the root's children do not ask for it.
    above = shared.select(F.col("name").alias("asked"), F.col("conv_id").alias("above"))
    asked = F.when(F.col("parent") == F.lit(ROOT), F.col("name")).otherwise(F.col("parent"))
    full = full.withColumn("asked", asked).join(above, "asked", "left")
    parent = F.when(F.col("parent") == F.lit(ROOT), F.lit(everyone["least"])).when(F.col("parent").isNotNull(), F.coalesce("above", "conv_id"))
    return full.select(
        "conv_id", "depth", parent.cast("bigint").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _subtree_sums(rows: DataFrame, shared: DataFrame, spark: SparkSession) -> DataFrame:
    """``name, n_leaves, saved_tokens`` of the root and of shared nodes; any other node has one leaf and no savings."""
    held = shared.select("name", F.col("conv_id").alias("owner"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), "childless")
    marked = freeze(rows.select("conv_id", "place", "name").join(held, "name", "left"), "marked-turns")
    own = F.col("owner") == F.col("conv_id")
    on_spine = marked.filter("owner IS NOT NULL").select("conv_id", "place", "name", own.alias("own"), F.when(own, F.col("saved")).otherwise(0).alias("saved"), "childless")
    tails = marked.filter("owner IS NULL").groupBy("conv_id").agg(F.min("place").alias("place"))
    tails = tails.select("conv_id", "place", F.lit(None).cast("binary").alias("name"), F.lit(True).alias("own"), F.lit(0).cast("bigint").alias("saved"), F.lit(True).alias("childless"))
    paths = on_spine.unionByName(tails)
    n = max(partitions(spark), -(-marked.filter("owner IS NOT NULL").count() // SHARD_TURNS))
    dealt = paths.repartitionById(n, F.pmod(F.xxhash64("conv_id"), F.lit(n)).cast("int")).sortWithinPartitions("conv_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at, path, owns = Shard(), None, [], False
        for batch in batches:
            for conv, _, name, own, saved, childless in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != at:
                    if owns:  # what a conversation owns is the end of its path
                        shard.add(path)
                    at, path = conv, []
                path.append((name, saved, childless))
                owns = own
        if owns:
            shard.add(path)
        found = list(shard.sums()) if len(shard.named) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.int64()))], names=["name", "n_leaves", "saved_tokens"])

    parts = dealt.mapInArrow(run, "name binary, n_leaves bigint, saved_tokens bigint")
    return parts.groupBy("name").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def _ends(rows: DataFrame, ids: DataFrame) -> DataFrame:
    last = ids.join(rows.groupBy("conv_id").agg(F.max_by("name", "place").alias("name")), "conv_id", "left")
    last = last.select(F.coalesce("name", F.lit(ROOT)).alias("name"), "conv_id")
    dealt = last.repartition(partitions(rows.sparkSession), "name").sortWithinPartitions("name", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != at:
                    if at is not None:
                        done.append((at, digest.hexdigest()))
                    at, digest = name, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["name", "ends_sha256"])
        if at is not None:
            yield pa.RecordBatch.from_pydict({"name": pa.array([at], pa.binary()), "ends_sha256": [digest.hexdigest()]})

    return dealt.mapInArrow(run, "name binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, rebuilt: bool = False) -> DataFrame:
    """The trie of ``conversations`` (``conv_id, turn, role, text``), see ``turns_of`` and ``prefix_trie``.

    ``rebuilt`` first lets each begin with turns of the first of its hundred. Other columns are not read, whatever their
    names; an empty table gives an empty table; only digests and lengths of texts are shuffled, however long they are.
    """
    turns = turns_of(conversations)
    ids = turns.select("conv_id").distinct()
    return prefix_trie(freeze(rebuild(freeze(turns, "numbered-turns"), ids), "rebuilt"), ids, ["part", "place"]) if rebuilt else prefix_trie(turns, ids, ["place"])


def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{folder}/conversations.parquet"), rebuilt=True)


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, conv_id - ((conv_id % 100) + 100) % 100 AS base,
         xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT h.conv_id, 0 AS part, t.place, role, text FROM h JOIN t ON t.conv_id = h.base AND t.place < h.h
  UNION ALL SELECT t.conv_id, 1, place, role, text FROM t JOIN h USING (conv_id) WHERE place >= h.h),
p AS (
  SELECT conv_id, 0 AS depth, '' AS name, 0 AS chars FROM h
  UNION ALL
  SELECT conv_id, row_number() OVER w, sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER w), length(text)
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
n AS (SELECT name, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY name),
m AS (SELECT n.*, above.name AS parent FROM n LEFT JOIN p AS above ON above.conv_id = n.conv_id AND above.depth = n.depth - 1),
k AS (SELECT parent AS name, count(*) AS n_children FROM m WHERE parent IS NOT NULL GROUP BY parent),
s AS (
  SELECT p.name, sum((n_convs - 1) * n.chars)::BIGINT AS saved_tokens, count(*) FILTER (n.name NOT IN (SELECT name FROM k)) AS n_leaves
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.name),
e AS (SELECT name, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, arg_max(name, depth) AS name FROM p GROUP BY conv_id) GROUP BY name)
SELECT m.conv_id, m.depth, above.conv_id AS parent_conv_id, m.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM m JOIN s USING (name) LEFT JOIN k USING (name) LEFT JOIN e USING (name) LEFT JOIN n AS above ON above.name = m.parent
"""
