"""Chat formatting as prefix trees (operator 6).

Conversations that begin with the same turns share these turns' tokens. A turn is a node, named by a
chained hash of all turns up to it; sorting by the path of names is depth-first order. The tree is
cut into shards by ranges of that order, so a tree of any size fits; a shard repeats the turns that
its first paths begin with, and every other turn is in it once. Within a shard each node has its
place in the stream, the position ids of its tokens (which go on from its parent's), and the
intervals of the stream that its tokens may attend to: its ancestors, joined where they touch.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import freeze
from .common import column, partitions, read_file, send

START, END = "<|im_start|>", "<|im_end|>"
NAME = 12  # bytes of a turn's name in a path
DEPTH = 64  # turns whose names a path lists one by one; later turns are numbered along lines, see _lines
BOUNDS = 64  # sampled paths per shard from which the ranges are chosen

_TURN, _LEAF = b"\x01", b"\x00"  # the ends of conversations sort before the next turns

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string of the template is left: ``<|`` gets a backslash, ``<\\|`` one more, and so on."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line of the template, so line feeds are escaped as well."""
    return escape(role.replace("&", "&amp;").replace("\n", "&lf;"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("&lf;", "\n").replace("&amp;", "&")


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def _paths(conversations: DataFrame) -> DataFrame:
    """``path`` of every node and of every conversation's end (``conv`` set), with role and text of nodes."""
    rows = conversations.select(
        column("conv_id").cast("bigint").alias("conv_id"),
        column("turn").cast("bigint").alias("turn"),
        F.coalesce(column("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(column("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    schema = "path binary, role string, text string, conv_id bigint, is_end boolean, owner bigint, n int, name binary, before binary"
    out_of = ["path", "role", "text", "conv_id", "is_end"]
    long = not rows.groupBy("conv_id").count().filter(F.col("count") > DEPTH).isEmpty()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, name, path, n, begun = None, b"", b"", 0, False

        def end() -> tuple:
            if n > DEPTH:
                return (path, "", "", at, True, at, n, None, None)
            return (path + _end_of(at), "", "", at, True, None, None, None, None)

        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if not begun or conv != at:
                    if begun:
                        out.append(end())
                    at, name, path, n, begun = conv, b"", b"", 0, True
                before = name
                name = hashlib.blake2b(b"\0".join([name, b"", str(len(role)).encode(), role.encode(), text.encode()]), digest_size=NAME).digest()
                if n < DEPTH:
                    path = path + _TURN + name
                    out.append((path, role, text, None, False, None, None, None, None))
                else:
                    out.append((path, role, text, None, False, conv, n, name, before))
                n += 1
            yield _batch(out)
        if begun:
            yield _batch([end()])

    types = (pa.binary(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = [*out_of, "owner", "n", "name", "before"]

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    turns = rows.mapInArrow(run, schema)
    if not long:
        return turns.select(out_of)
    turns = freeze(turns, "chat-turns")
    return turns.filter("n IS NULL").select(out_of).unionByName(_lines(turns.filter("n IS NOT NULL")))


def _end_of(conv: int | None) -> bytes:
    return _LEAF + hashlib.blake2b(repr(conv).encode(), digest_size=8).digest()


def _lines(deep: DataFrame) -> DataFrame:
    """Paths of the turns after the first ``DEPTH``, and of the ends of their conversations.

    Of the turns that may follow a turn, the one in most conversations goes on with its line; any other begins a line of
    its own. A path names the lines and says at which turn each was left. A line is left for at most half of the
    conversations, so the paths are short however long and alike the conversations are.
    """
    turns = deep.filter("NOT is_end").groupBy("before", "name").agg(F.count(F.lit(1)).alias("members"))
    going = turns.groupBy("before").agg(F.max(F.struct("members", "name")).alias("most")).select(F.col("most.name").alias("name"), F.lit(True).alias("on"))
    marked = spread_join(deep, going, "name", "left")
    marked = marked.select("owner", "n", "is_end", "path", "name", "on", "role", "text", "conv_id")
    marked = marked.repartition(partitions(deep.sparkSession), "owner").sortWithinPartitions(F.col("owner").asc_nulls_first(), "n", "is_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = at = b""
        for batch in batches:
            paths = []
            for owner, n, is_end, path, name, on in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if is_end:
                    paths.append(at + _end_of(owner))
                    continue
                if n == DEPTH:
                    line = path + _TURN + name
                elif not on:
                    line = at + _TURN + name
                at = line + n.to_bytes(8)
                paths.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), *(batch.column(i) for i in (6, 7, 8, 2))], names=["path", "role", "text", "conv_id", "is_end"])

    return marked.mapInArrow(run, "path binary, role string, text string, conv_id bigint, is_end boolean")


def _bounds(paths: DataFrame, shards: int) -> list[bytes]:
    """Paths that cut the order into about equal shards, from a bounded sample; they decide no result."""
    sample = paths.select("path", F.xxhash64("path").alias("h")).orderBy("h").limit(BOUNDS * shards).select("path").collect()
    found = sorted(bytes(r["path"]) for r in sample)
    return sorted({found[len(found) * i // shards] for i in range(1, shards)}) if found else []


def _span(path: bytes, is_end: bool, bounds: list[bytes]) -> tuple[int, int]:
    """First and last shard of a node and what hangs below it; below an end is nothing."""
    first = bisect.bisect_right(bounds, path)
    return first, first if is_end else bisect.bisect_right(bounds, _below(path) + b"\xff")


def _below(path: bytes) -> bytes:
    """What the paths below a node begin with: its own path, or that of its line without the number."""
    shared = DEPTH * (NAME + 1)
    return path[:-8] if len(path) > shared and path[shared : shared + 1] == _TURN else path


class Encoder:
    def __init__(self, content: bytes):
        self.library = tokenizers.Tokenizer.from_str(content.decode())
        self.library.encode_special_tokens = True  # control strings of this vocabulary are ordinary text

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(parts, add_special_tokens=False)]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def _encoder(digest: str, content: bytes) -> Encoder:
    return Encoder(content)


TREE = (
    "shard int, seq bigint, depth int, conv_id bigint, is_end boolean, start bigint, position bigint, "
    "ids array<int>, loss_start int, loss_end int, attends array<struct<start:bigint,end:bigint>>"
)


def format_conversations(conversations: DataFrame, path: str, shards: int | None = None) -> DataFrame:
    """The shards of the prefix forest, one row per node or conversation end in depth-first order.

    Columns: ``shard``, ``seq`` (order), ``depth`` (turns up to it), ``conv_id`` and ``is_end`` (ends only),
    ``start`` (place of the first token in the shard's stream), ``position`` (position id of the first
    token; the others follow), ``ids``, ``loss_start`` and ``loss_end`` (the ids under the loss mask: text
    of assistant turns) and ``attends`` (intervals of the stream before the node that its tokens see; an
    end has those of the whole conversation).

    Rows are taken by ``turn``, nulls first, then by role and text; repeated rows are turns of their own.
    A null text or role is empty, rows without ``conv_id`` are one conversation. An empty table gives an
    empty table; other columns are not read. Shared beginnings are merged before their texts are
    shuffled on. A conversation is read in order by one task, which holds one turn.
    """
    spark = conversations.sparkSession
    sent = send(spark, content := read_file(path))
    digest = hashlib.sha256(content).hexdigest()
    n = partitions(spark, shards)
    paths = _paths(conversations)
    nodes = paths.groupBy("path", "is_end").agg(F.first("role").alias("role"), F.first("text").alias("text"), F.first("conv_id").alias("conv_id"))
    nodes = freeze(nodes, "chat-nodes")
    bounds = _bounds(nodes, n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [_span(p, e, bounds) for p, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            at = [i for i, (a, b) in enumerate(spans) for _ in range(a, b + 1)]
            shard = [s for a, b in spans for s in range(a, b + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.take(pa.array(at, pa.int32())).columns], names=["shard", *batch.schema.names])

    dealt = nodes.mapInArrow(deal, "shard int, path binary, is_end boolean, role string, text string, conv_id bigint")
    dealt = dealt.repartitionById(n, "shard").sortWithinPartitions("shard", "path")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(digest, sent.value)
        shard, seq, place = None, 0, 0
        open_nodes: list[tuple[bytes, int, int, list]] = []  # path, place after it, next position, what it and its ancestors cover
        for batch in batches:
            for step in range(0, batch.num_rows, 512):
                rows = batch.slice(step, 512).to_pylist()
                parts = [p for r in rows if not r["is_end"] for p in turn_parts(r["role"], r["text"])]
                coded = iter(encoder.encode(parts))
                out: list[list] = [[] for _ in range(11)]
                for r in rows:
                    if r["shard"] != shard:
                        shard, seq, place, open_nodes = r["shard"], 0, 0, []
                    while open_nodes and not r["path"].startswith(open_nodes[-1][0]):
                        open_nodes.pop()
                    position, covered = (open_nodes[-1][2], open_nodes[-1][3]) if open_nodes else (0, [])
                    ids, loss = [], (0, 0)
                    if not r["is_end"]:
                        head, text, tail = next(coded), next(coded), next(coded)
                        ids = head + text + tail
                        if r["role"] == "assistant":
                            loss = (len(head), len(head) + len(text))
                    values = (shard, seq, len(open_nodes) + (not r["is_end"]), r["conv_id"], r["is_end"], place, position, ids, *loss, [{"start": a, "end": b} for a, b in covered])
                    for values_of, value in zip(out, values):
                        values_of.append(value)
                    seq += 1
                    if not r["is_end"]:
                        after = place + len(ids)
                        joined = [*covered[:-1], (covered[-1][0], after)] if covered and covered[-1][1] == place else [*covered, (place, after)]
                        open_nodes.append((_below(r["path"]), after, position + len(ids), joined))
                        place = after
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, TYPES)], names=NAMES)

    return freeze(dealt.mapInArrow(emit, TREE), "chat-tree")


NAMES = ["shard", "seq", "depth", "conv_id", "is_end", "start", "position", "ids", "loss_start", "loss_end", "attends"]
TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]


def read_conversations(tree: DataFrame, path: str) -> DataFrame:
    """Every conversation read back from the tokens along its path, as digests.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``. Digests go on from turn to
    turn down the tree, so a shared beginning is decoded and hashed once per shard. The intervals of each
    end are compared with the path that was walked.
    """
    spark = tree.sparkSession
    sent = send(spark, content := read_file(path))
    digest = hashlib.sha256(content).hexdigest()
    rows = tree.repartitionById(partitions(spark), F.pmod("shard", F.lit(partitions(spark)))).sortWithinPartitions("shard", "seq")
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    header = re.compile(re.escape(START) + r"(.*)\n", re.S)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(digest, sent.value)
        shard, states = None, []
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["shard"] != shard:
                    shard, states = r["shard"], []
                del states[r["depth"] - (not r["is_end"]) :]
                if r["is_end"]:
                    turns, loss, loss_chars, chars, covered = states[-1]
                    if [(i["start"], i["end"]) for i in r["attends"]] != covered:
                        raise ValueError(f"conversation {r['conv_id']} attends to other tokens than its own")
                    out.append((r["conv_id"], r["depth"], turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    continue
                turns, loss, loss_chars, chars, covered = states[-1] if states else (hashlib.sha256(), hashlib.sha256(), 0, 0, [])
                formatted = encoder.decode(r["ids"])
                found = header.match(formatted, 0, formatted.index("\n") + 1)
                role, text = unescape_role(found[1]), unescape(formatted[found.end() : -len(END) - 1])
                turns, loss = turns.copy(), loss.copy()
                turns.update(f"{role}\n{text}\n".encode())
                if r["loss_end"] > r["loss_start"]:
                    masked = unescape(encoder.decode(r["ids"][r["loss_start"] : r["loss_end"]]))
                    loss.update(masked.encode())
                    loss_chars += len(masked)
                after = r["start"] + len(r["ids"])
                joined = [*covered[:-1], (covered[-1][0], after)] if covered and covered[-1][1] == r["start"] else [*covered, (r["start"], after)]
                states.append((turns, loss, loss_chars, chars + len(formatted), joined))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.mapInArrow(run, schema)


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op6_chat(spark, folder: str, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    return read_conversations(format_conversations(rows.unionByName(planted), path), path)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS escaped,
         regexp_replace(replace(replace(role, '&', '&amp;'), chr(10), '&lf;'), '<(\\*)\|', '<\\\1|', 'g') AS escaped_role
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(escaped_role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
