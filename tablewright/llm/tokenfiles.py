"""Token ids in Arrow stream files of equal-length sequences (operator 10).

Each file is one Arrow IPC stream whose batches all have the same number of fixed-length rows, so
every batch has the same length in bytes and row ``i`` is found by arithmetic, without an index or
a footer. Columns: ``ids`` (fixed-size list of uint16 or uint32), ``used`` and ``ends`` (fixed-size
lists of bool): which places hold ids, and which hold the end id of a document. Documents follow
each other without gaps; only the last row and batch of a file are filled up with unused places.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import tokenizers
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ..session import scratch_uri
from .bpe import byte_symbols
from .common import column, partitions, read_file, send, slices, text_of

LENGTH = 2048  # ids of a sequence
ROWS = 64  # sequences of a batch
KEPT_PIECES = 1_000_000  # encoded pieces a worker keeps
ENCODED_CHARS = 4 << 20  # characters of text encoded together; each different piece among them is looked up once

# White space as the splitting pattern of byte-level vocabularies sees it (Unicode White_Space).
SPACES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
WIDE = sorted({c.encode()[:-1] for c in SPACES if not c.isascii()})  # all but the last byte of such a character
LAST = {begin: [c.encode()[-1] for c in SPACES if c.encode()[:-1] == begin] for begin in WIDE}

# Kinds of bytes. LETTER: ASCII's letters, and both bytes of Latin-1's. SYMBOL: ASCII's marks but the
# apostrophe, which begins a contraction. OTHER: control characters and the rest of Unicode.
OTHER, BLANK, SPACE, LETTER, DIGIT, SYMBOL, QUOTE = range(7)
BEGIN = 255  # in place of a pair of kinds: a text begins here
LINE = "\u2028"  # between words for the model; no byte's symbol


def _kinds_of_ascii() -> bytes:
    kinds = bytearray(256)
    for i in range(128):
        c = chr(i)
        if c in SPACES:
            kinds[i] = BLANK if c == " " else SPACE
        elif c.isalnum():
            kinds[i] = LETTER if c.isalpha() else DIGIT
        elif c.isprintable():
            kinds[i] = QUOTE if c == "'" else SYMBOL
    return bytes(kinds)


def _cuts_of_pairs() -> bytes:
    """For the kinds of two neighbours, 8 * the first + the second: 1, a piece begins with the second; 2, with the first."""
    cuts = bytearray(256)
    white, plain = (BLANK, SPACE), (LETTER, DIGIT, SYMBOL)
    for a in range(7):
        for b in range(7):
            if a in white and b not in white:  # the last of a run of white space stands alone; a blank joins what follows
                cuts[8 * a + b] = 2 if a == BLANK else 3
            elif a not in white and b in white or a != b and a in plain and b in plain or a in (LETTER, DIGIT) and b == QUOTE:
                cuts[8 * a + b] = 1
    cuts[BEGIN] = 1
    return bytes(cuts)


KINDS, CUTS = _kinds_of_ascii(), _cuts_of_pairs()


def _kinds(data: bytes) -> tuple[np.ndarray, list[tuple[np.ndarray, int]]]:
    """The kind of each byte, and the places of white space of several bytes with its length."""
    kinds = np.frombuffer(bytearray(data).translate(KINDS), np.uint8)
    wide = []
    if not data.isascii():
        raw = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(raw[:-1] == 0xC3)
        at = at[(raw[at + 1] >> 6 == 2) & (raw[at + 1] != 0x97) & (raw[at + 1] != 0xB7)]  # not the signs for times and divided by
        kinds[at] = kinds[at + 1] = LETTER
        for begin in WIDE:
            at = np.flatnonzero(raw[: len(raw) - len(begin)] == begin[0])
            for k in range(1, len(begin)):
                at = at[raw[at + k] == begin[k]]
            at = at[np.isin(raw[at + len(begin)], LAST[begin])]
            if len(at):
                wide.append((at, len(begin) + 1))
                for k in range(len(begin) + 1):
                    kinds[at + k] = SPACE
    return kinds, wide


def _begins(data: bytes, limits: np.ndarray) -> np.ndarray:
    """Whether a piece begins with a byte of the texts that begin at ``limits``.

    A piece is a run of letters, digits or symbols with the blank before it, or of white space up to its
    last character, or such a character; runs without a cut between them stay together. The pattern of
    the vocabulary never joins characters of two pieces.
    """
    kinds, wide = _kinds(data)
    pairs = kinds.copy()
    pairs[1:] += kinds[:-1] << 3
    pairs[limits[limits < len(data)]] = BEGIN
    cuts = np.frombuffer(pairs.tobytes().translate(CUTS), np.uint8)
    begins = (cuts & 1).astype(bool)
    begins[:-1] |= cuts[1:] > 1
    for at, size in wide:  # such a character, not its last byte, stands alone at the end of a run
        at = at[at + size < len(data)]
        at = at[cuts[at + size] > 1]
        begins[at + size - 1], begins[at] = False, True
    return begins


class Encoder:
    """Encode texts piece by piece with the tokenizers library, each different piece once."""

    def __init__(self, content: bytes):
        self.library = tokenizers.Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        file = json.loads(content)
        level = file["pre_tokenizer"] or {}
        if file["normalizer"] or level.get("type") != "ByteLevel" or level["add_prefix_space"] or not level["use_regex"]:
            raise ValueError("only byte-level vocabularies without normaliser are supported")
        added = self.library.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("special tokens that take white space with them are not supported")
        self.special = {t.content.encode() for t in added.values()}
        self.cut = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.dtype = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.symbols = dict(enumerate(byte_symbols()))
        vocab, model = self.library.get_vocab(with_added_tokens=False), file["model"]
        # The model alone, for words one to a line; its ids tell whose they are where each stands for as many bytes as it has symbols.
        self.words = tokenizers.Tokenizer(self.library.model)
        self.words.pre_tokenizer = tokenizers.pre_tokenizers.CharDelimiterSplit(LINE)
        others = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        self.by_line = vocab.keys() >= set(byte_symbols()) and not any(model.get(k) for k in others)
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        self.bytes_of[list(vocab.values())] = list(map(len, vocab))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(1 << 16, self.dtype), np.zeros(KEPT_PIECES, np.int64), np.zeros(KEPT_PIECES, np.int64)
        self.filled = 0

    def _forget_half(self) -> None:
        """The newer half of the pieces stays, with its ids moved to the front."""
        old = len(self.known) // 2
        kept, base = list(self.known)[old:], int(self.starts[old])
        self.known = dict(zip(kept, range(len(kept))))
        self.filled -= base
        self.flat[: self.filled] = self.flat[base : base + self.filled].copy()
        self.starts[: len(kept)] = self.starts[old : old + len(kept)] - base
        self.sizes[: len(kept)] = self.sizes[old : old + len(kept)].copy()

    def _keep(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        at = len(self.known)
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        while at + len(pieces) > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.starts[at : at + len(pieces)] = self.filled + np.cumsum(sizes) - sizes
        self.sizes[at : at + len(pieces)] = sizes
        self.known.update(zip(pieces, range(at, at + len(pieces))))
        self.filled += len(ids)

    def _learn(self, pieces: list[bytes]) -> None:
        """A piece of one kind goes to the model as a word; others are split by the library first."""
        whole = np.zeros(len(pieces), bool)
        if self.by_line:
            kinds, _ = _kinds(b"".join(pieces))
            lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
            whole = ~np.logical_or.reduceat((kinds == OTHER) | (kinds == QUOTE), np.cumsum(lengths) - lengths)
            whole &= ~np.fromiter(map(self.special.__contains__, pieces), bool, len(pieces))
        if whole.any():
            words = [pieces[i] for i in np.flatnonzero(whole)]
            lines = LINE.join(map(bytes.decode, words, repeat("latin-1"))).translate(self.symbols)
            (found,) = self.words.encode_batch_fast([lines], add_special_tokens=False)
            ids = np.array(found.ids, np.int64)
            stops = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(lengths[whole])) + 1
            self._keep(words, ids, np.diff(stops, prepend=0))
        if not whole.all():
            mixed = [pieces[i] for i in np.flatnonzero(~whole)]
            ids = [e.ids for e in self.library.encode_batch_fast(list(map(bytes.decode, mixed)), add_special_tokens=False)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._keep(mixed, np.fromiter(chain.from_iterable(ids), self.dtype, int(sizes.sum())), sizes)

    def _pieces(self, data: bytes, limits: np.ndarray) -> np.ndarray:
        """Where the pieces of the texts begin that begin and end at ``limits``; a special token is a piece."""
        if not self.cut or not self.cut.search(data):
            return np.flatnonzero(_begins(data, limits))
        found = [m.span() for a, b in pairwise(limits.tolist()) for m in self.cut.finditer(data, a, b)]
        begins = _begins(data, np.concatenate([limits, np.array(found, np.int64).ravel()]))
        for a, b in found:
            begins[a + 1 : b] = False
        return np.flatnonzero(begins)

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, ``end`` after each text, and the number of each text's ids."""
        if len(self.known) > KEPT_PIECES:
            self._forget_half()
        raw = [text.encode() for text in texts]
        limits = np.cumsum([0, *map(len, raw)])
        data = b"".join(raw)
        begins = self._pieces(data, limits)
        offsets = pa.py_buffer(np.append(begins, len(data)))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.known.get, different, repeat(-1)), np.int64, len(different))
        if len(unknown := np.flatnonzero(at < 0)):
            new = [different[i] for i in unknown]
            self._learn(new)
            at[unknown] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        at = at[pieces.indices.to_numpy()]
        sizes = self.sizes[at]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        ends = stops[np.searchsorted(begins, limits[1:])] + np.arange(1, len(texts) + 1)  # of the texts, with their end ids
        out = np.full(int(ends[-1]) if len(texts) else 0, end, self.dtype)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner] = self.flat[np.repeat(self.starts[at] - stops[:-1], sizes) + np.arange(stops[-1])]
        return out, np.diff(ends, prepend=0)


class Writer:
    """One stream file, written row by row of fixed length; only one batch is held."""

    def __init__(self, uri: str, dtype, length: int, rows: int):
        self.target, path = fs.FileSystem.from_uri(uri)
        self.file = self.target.open_output_stream(path)
        self.length, self.rows = length, rows
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("used", pa.list_(pa.bool_(), length)), ("ends", pa.list_(pa.bool_(), length))])
        self.stream = pa.ipc.new_stream(self.file, self.schema)
        self.dtype, self.held, self.marks, self.n = dtype, [], [], 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        marks = np.zeros(len(ids), bool)
        marks[np.cumsum(sizes) - 1] = True
        self.held.append(ids)
        self.marks.append(marks)
        self.n += len(ids)
        if self.n >= self.length * self.rows:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        full = self.length * self.rows
        ids, marks = np.concatenate(self.held), np.concatenate(self.marks)
        end = len(ids) if last else len(ids) // full * full
        for start in range(0, end, full):
            part, ends = ids[start : min(start + full, end)], marks[start : min(start + full, end)]
            used = np.arange(full) < len(part)
            part, ends = np.pad(part, (0, full - len(part))), np.pad(ends, (0, full - len(ends)))
            arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, used, ends)]
            self.stream.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        self.held, self.marks, self.n = [ids[end:]], [marks[end:]], len(ids) - end

    def close(self) -> None:
        if self.n:
            self._flush(True)
        self.stream.close()
        self.file.close()


class Reader:
    """Random access to the sequences of one stream file. Local files are mapped, not read."""

    def __init__(self, uri: str):
        source, path = fs.FileSystem.from_uri(uri)
        self.file = pa.memory_map(path) if isinstance(source, fs.LocalFileSystem) else source.open_input_file(path)
        messages = pa.ipc.MessageReader.open_stream(self.file)
        self.schema = pa.ipc.read_schema(messages.read_next_message())
        self.first = self.file.tell()
        try:
            messages.read_next_message()
            self.step = self.file.tell() - self.first
        except StopIteration:  # an empty file
            self.step = 0
        self.length = self.schema.field("ids").type.list_size
        self.batches = (self.file.size() - self.first) // self.step if self.step else 0
        self.kept: tuple[int, pa.RecordBatch | None] = (-1, None)

    def batch(self, i: int) -> pa.RecordBatch:
        if self.kept[0] != i:
            self.file.seek(self.first + i * self.step)
            self.kept = (i, pa.ipc.read_record_batch(pa.ipc.read_message(self.file.read_buffer(self.step)), self.schema))
        return self.kept[1]

    def sequence(self, i: int) -> dict[str, np.ndarray]:
        """Sequence ``i``: ids without a copy, masks unpacked from their bits."""
        rows = self.batch(0).num_rows
        values = {name: self.batch(i // rows).column(k)[i % rows].values for k, name in enumerate(self.schema.names)}
        return {name: v.to_numpy(zero_copy_only=name == "ids") for name, v in values.items()}

    def span(self, start: int, size: int) -> np.ndarray:
        """The ids from place ``start`` on, over batches where need be."""
        full = self.batch(0).num_rows * self.length if self.batches else 1
        parts = []
        for i in range(start // full, (start + size - 1) // full + 1):
            flat = self.batch(i).column(0).flatten().to_numpy()
            parts.append(flat[max(start - i * full, 0) : start + size - i * full])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


@lru_cache(maxsize=2)
def _encoder(digest: str, content: bytes) -> Encoder:
    return Encoder(content)


_DOC = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("file", pa.string()), ("start_in_file", pa.int64()), ("n_tokens", pa.int64())])


def write_tokens(docs: DataFrame, path: str, folder: str, end: int = 0, length: int = LENGTH, parts: int | None = None) -> DataFrame:
    """Encode whole texts and write them in ascending ``doc_id`` order, one file per partition.

    Returns the index, itself written below ``folder``: one row per document with its file, place and
    number of ids (the end id included). Null texts are empty and have only the end id; null
    ``doc_id`` come first; rows with the same ``doc_id`` stand together, ordered by a hash of the
    text. An empty table gives an empty index and no ids. Other columns are not read. Texts go through
    one range shuffle; a task holds one batch. Each attempt of a task writes a file of its own and only
    those named in the index count, so lost executors leave at most unused files.
    """
    spark = docs.sparkSession
    sent = send(spark, content := read_file(path))
    digest = hashlib.sha256(content).hexdigest()
    rows = docs.select(column("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), F.xxhash64(text_of()).alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(partitions(spark, parts), *order).sortWithinPartitions(*order)
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(digest, sent.value)
        writer, start = None, 0
        for batch in slices(batches, chars=ENCODED_CHARS):
            if not batch.num_rows:
                continue
            if writer is None:
                part = batch.column(2)[0].as_py()
                uri = f"{folder}/tokens-{part:06d}-{uuid.uuid4().hex}.arrow"
                writer = Writer(uri, encoder.dtype, length, ROWS)
            ids, sizes = encoder.encode(batch.column(1).to_pylist(), end)
            writer.add(ids, sizes)
            starts = start + np.cumsum(sizes) - sizes
            start += len(ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array([uri] * len(sizes)), pa.array(starts), pa.array(sizes)], schema=_DOC)
        if writer is not None:
            writer.close()

    index = rows.mapInArrow(run, from_arrow_schema(_DOC))
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


def read_tokens(index: DataFrame) -> DataFrame:
    """Read every document back from the files of an index.

    Returns ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` of
    the ids as little-endian unsigned 32-bit numbers.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_file", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            sums = []
            for file, start, size in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                if file != opened:
                    reader, opened = Reader(file), file
                sums.append(zlib.crc32(reader.span(start, size).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), batch.column(4), pa.array(sums, pa.int64())], schema=schema)

    found = index.mapInArrow(run, from_arrow_schema(schema))
    # One row per file: as many as partitions, whatever the number of documents.
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return found.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def op10_tokens(spark, folder: str, path: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return read_tokens(write_tokens(docs, path, scratch_uri(spark, "tokens")))
