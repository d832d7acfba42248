"""CSV records with quoted line breaks, from files that are split between tasks.

A split does not know whether its first line begins inside a quoted cell. So a first pass reads every split
both ways and notes in which state it ends; going through these notes in file order tells how each split
begins. A second pass then has every split give the records that begin and end in it. A record that crosses
a border is put together from the pieces that the first pass kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freeze, ship_package

STATE_BYTES = 64 << 20  # most bytes of what every executor is told about the splits
LARGEST = (1 << 63) - 1
CROSSING = 10_000  # records that cross borders for which the read gets one more partition, about
PIECE_BYTES = 1 << 16  # longest piece of a border record that the first pass keeps; longer ones take a pass of their own


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Is a quoted cell open at the end of the line, if one is (or is not) at its start?

    A quote opens a cell only as its first character, two quotes are one character of the cell, and what follows the
    closing quote up to the separator belongs to the cell.
    """
    at = 0
    if not inside:
        if line.startswith('"'):
            inside, at = True, 1
        else:
            at = line.find(sep + '"')
            if at < 0:
                return False
            inside, at = True, at + len(sep) + 1
    while True:
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('"', at + 1):
            at += 2
            continue
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        if not line.startswith('"', at + len(sep)):
            at = line.find(sep + '"', at + len(sep))
            if at < 0:
                return False
        at += len(sep) + 1


def lines_of(spark: SparkSession, path: str | list[str], storage: dict[str, str]) -> DataFrame:
    """``file`` and ``start`` of the split, and ``line``; the lines of a split are in order in one task."""
    lines = spark.read.options(**storage).text(path, lineSep="\n")
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The lines of each split, a batch or less at a time."""
    for batch in batches:
        files, starts = batch.column(0), batch.column(1)
        if not batch.num_rows:
            continue
        same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(starts[1:], starts[:-1]))
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(pc.invert(same)).to_pylist()), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield (files[a].as_py(), starts[a].as_py()), batch.column(2).slice(a, b - a)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[pa.Array]]]:
    for split, runs in groupby(_runs(batches), key=lambda r: r[0]):
        yield split, (lines for _, lines in runs)


class _States:
    """For each split whether it begins inside a cell: 17 bytes a split, so the bound is reached at some 500 TB of CSV."""

    def __init__(self, inside: dict[tuple[int, int], bool]):
        known = sorted(inside)
        self.splits = np.array(known, np.int64).reshape(-1, 2)
        self.inside = np.array([inside[k] for k in known], bool)
        if self.splits.nbytes + self.inside.nbytes > STATE_BYTES:
            raise ValueError(f"{len(known)} splits are too many: set spark.sql.files.maxPartitionBytes higher")

    def find(self, split: tuple[int, int]) -> bool | None:
        """None for a split that was not there when the files were opened."""
        first, last = np.searchsorted(self.splits[:, 0], [split[0], split[0] + 1]) if split[0] < LARGEST else (np.searchsorted(self.splits[:, 0], split[0]), len(self.splits))
        at = first + np.searchsorted(self.splits[first:last, 1], split[1])
        return bool(self.inside[at]) if at < last and self.splits[at, 1] == split[1] else None


class _Piece:
    """Lines of a record that is not whole, up to a size."""

    def __init__(self, limit: int | None):
        self.limit, self.lines, self.size = limit, [], 0

    def add(self, line: str) -> None:
        self.size += len(line) + 1
        if self.limit is None or self.size <= self.limit:
            self.lines.append(line)
        else:
            self.lines = []

    def clear(self) -> None:
        self.lines, self.size = [], 0

    def text(self) -> str | None:
        """The lines, or None where they are too many."""
        return "\n".join(self.lines) if self.limit is None or self.size <= self.limit else None


class _Reading:
    """A split read from one of the two states."""

    def __init__(self, inside: bool, sep: str, limit: int | None):
        self.inside, self.sep = inside, sep
        self.closes = not inside  # does the record that is open at the start end here?
        self.complete = False  # does a record begin and end here?
        self.head, self.tail = _Piece(limit), _Piece(limit)

    def add(self, line: str, quoted: bool) -> None:
        was = self.inside
        if quoted:
            self.inside = ends_inside(line, was, self.sep)
        if not self.closes:
            self.head.add(line)
            self.closes = not self.inside
        else:
            self.complete = self.complete or (not self.inside and line not in ("", "\r"))
            if was or self.inside:
                self.tail.add(line)
                if not self.inside:
                    self.tail.clear()

    def plain(self, lines: pa.Array) -> None:
        """Lines without quotes."""
        open_piece = self.tail if self.closes else self.head
        if not self.inside:
            self.complete = self.complete or pc.any(pc.greater(pc.binary_length(lines), 1)).as_py()
        elif open_piece.limit is None or open_piece.size <= open_piece.limit:  # all of them go on with the open cell
            for line in lines.to_pylist():
                self.add(line, False)


NOTES = "file bigint, start bigint, inside boolean, ends_inside boolean, closes boolean, complete boolean, head string, tail string, whole boolean"


def _notes(lines: DataFrame, sep: str, limit: int | None, only=None) -> DataFrame:
    """Two rows per split, one for each state at its start; with ``only`` (the states, as sent), one for the state that holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, parts in _by_split(batches):
            states = [False, True] if only is None else [_known(only.value, split)]
            readings = [_Reading(s, sep, limit) for s in states]
            for part in parts:
                quoted = pc.match_substring(part, '"')
                if not pc.any(quoted).as_py():
                    for r in readings:
                        r.plain(part)
                    continue
                for line, has in zip(part.to_pylist(), quoted.to_pylist()):
                    for r in readings:
                        r.add(line, has)
            rows = [(*split, s, r.inside, r.closes, r.complete, r.head.text(), r.tail.text(), None not in (r.head.text(), r.tail.text())) for s, r in zip(states, readings)]
            types = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.bool_())
            names = ("file", "start", "inside", "ends_inside", "closes", "complete", "head", "tail", "whole")
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))

    return lines.mapInArrow(run, NOTES)


def _known(states: _States, split: tuple[int, int]) -> bool:
    found = states.find(split)
    if found is None:
        raise ValueError("the files are split otherwise than when they were opened: open them again")
    return found


def _begins(notes: DataFrame) -> tuple[dict[tuple[int, int], bool], dict[tuple[int, int], int]]:
    """For each split whether it begins inside a cell, and the start of the split in which that record begins.

    The notes without their texts go to the driver: a few numbers for each split, which the driver plans anyway.
    """
    inside: dict[tuple[int, int], bool] = {}
    begun: dict[tuple[int, int], int] = {}
    flags = sorted(tuple(r) for r in notes.select("file", "start", "inside", "ends_inside", "closes").collect())
    for file, of_file in groupby(flags, key=lambda r: r[0]):
        state, opened = False, 0
        for start, both in groupby(of_file, key=lambda r: r[1]):
            now = next(r for r in both if r[2] == state)
            inside[file, start] = state
            if state:
                begun[file, start] = opened
            if now[4]:  # the open record ended here, so one that is open at the end begins here
                opened = start
            state = now[3]
    return inside, begun


def records_of(spark: SparkSession, path: str | list[str], sep: str, skip_first: bool, storage: dict[str, str], piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``record``, one row per CSV record; ``skip_first`` leaves out the first of each file.

    Partitions are those of the plain read, and one more where records cross borders. The splits are worked out here;
    a later read that cuts the files otherwise (the session's split size or number of cores has changed) ends with an error.
    """
    ship_package(spark)
    lines = lines_of(spark, path, storage)
    # Kept as they are made: stored as files they would be read in splits as small as those of the text.
    notes = _notes(lines, sep, piece_bytes).persist(StorageLevel.DISK_ONLY)
    inside, begun = _begins(notes)
    known = spark.createDataFrame([(f, s, i) for (f, s), i in inside.items()], "file bigint, start bigint, inside boolean")
    held = notes.join(known, ["file", "start", "inside"])  # the reading that holds
    sent = spark.sparkContext.broadcast(_States(inside))
    kept = [notes]
    if not held.filter("NOT whole AND (inside OR ends_inside)").isEmpty():
        held = _notes(lines, sep, None, sent).persist(StorageLevel.DISK_ONLY)
        kept.append(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = sent.value
        for split, parts in _by_split(batches):
            open_cell = _known(states, split)
            waiting = open_cell  # for the end of a record that began earlier
            skip = skip_first and split[1] == 0
            piece: list[str] = []
            for part in parts:
                quoted = pc.match_substring(part, '"')
                if not open_cell and not pc.any(quoted).as_py():
                    records = part
                else:
                    found = []
                    for line, has in zip(part.to_pylist(), quoted.to_pylist()):
                        if has:
                            open_cell = ends_inside(line, open_cell, sep)
                        if not waiting:
                            piece.append(line)
                        if not open_cell:
                            if not waiting:
                                found.append("\n".join(piece))
                            waiting, piece = False, []
                    records = pa.array(found, pa.string())
                records = _full(records)
                if skip and len(records):
                    records, skip = records.slice(1), False
                yield pa.RecordBatch.from_arrays([records], names=["record"])

    whole = lines.mapInArrow(run, "record string")
    crossing = bool(begun) or not held.filter("ends_inside").isEmpty()
    if crossing:
        whole = whole.unionByName(_crossing(spark, held, begun, skip_first))
    for frame in kept:
        frame.unpersist()
    return whole


def _full(records: pa.Array) -> pa.Array:
    """Without empty lines and the carriage returns before line feeds."""
    records = pc.replace_substring_regex(records, r"\r\z", "")
    return records.filter(pc.greater(pc.binary_length(records), 0))


def _crossing(spark: SparkSession, held: DataFrame, begun: dict[tuple[int, int], int], skip_first: bool) -> DataFrame:
    """The records that are not whole in one split: the end of one and the beginnings of those after it."""
    came = spark.createDataFrame([(*k, v) for k, v in begun.items()], "file bigint, start bigint, begun bigint")
    heads = held.join(came, ["file", "start"]).select("file", "begun", "start", F.col("head").alias("text"))
    tails = held.filter("ends_inside AND closes").select("file", F.col("start").alias("begun"), "start", F.col("tail").alias("text"))
    # A piece at each border, so a record has as many as the borders that it crosses, and one more.
    joined = heads.unionByName(tails).groupBy("file", "begun").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "\n")
    records = joined.select("file", "begun", F.regexp_replace(text, r"\r\z", "").alias("record"))
    if skip_first:  # the first record of a file may be one that crosses
        first = held.filter("start = 0 AND NOT complete").select("file", F.col("start").alias("begun"))
        records = records.join(first, ["file", "begun"], "left_anti")
    return freeze(records.select("record"), "csv-crossing").coalesce(1 + len(begun) // CROSSING)
