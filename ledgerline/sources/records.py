"""Records of CSV files whose quoted fields hold line breaks, read in splits.

Spark's own reader gives such a file to one task. Here the files are read as lines, in
splits. Whether a split begins inside a quoted field follows from the splits before it:
each split tells, for both possible beginnings, how it ends (one task per split, two bits
of result), and a running composition over a file's splits gives every split its beginning.
Then each split cuts its own lines into records, whole batches of lines at a time. A record that runs over the end of its
split is put together from fragments: the tail of one split, whole splits inside the field
and the head of the next. There are at most two fragments a split.

A quote opens a field only at the field's beginning; quotes elsewhere in an unquoted field
are plain characters. Two quotes inside a quoted field are one character.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, DELIMITER = b'"', b","
#: What a row of the second pass holds.
RECORD, HEAD, INNER, TAIL = range(4)


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, if one is (``inside``) or is not before it."""
    at = 0
    if not inside:
        if line.startswith(QUOTE):
            at, inside = 1, True
        elif QUOTE not in line:
            return False
    while True:
        if inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == QUOTE:
                at += 2
                continue
            at, inside = at + 1, False
        at = line.find(DELIMITER + QUOTE, at)
        if at < 0:
            return False
        at, inside = at + 2, True


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, line`` (bytes without the line feed) of text files, in splits, in file order inside each."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("line"))


def has_open_lines(lines: DataFrame) -> bool:
    """Whether any line has an odd number of quotes: where none has, every record is a line."""
    text = F.decode("line", "ISO-8859-1")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).isEmpty()


def _after(data: np.ndarray, edges: np.ndarray, inside: bool) -> np.ndarray:
    """Whether a quoted field is open after each line; line i is ``data[edges[i]:edges[i + 1]]``.

    Where every quote that would open a field stands at a field's beginning (or right behind the quote
    before it, as the second of two), quotes open and close in turn; other lines are gone through one by one.
    """
    at = np.flatnonzero(data == QUOTE[0])
    counted = np.searchsorted(at, edges[1:])
    opening = at[int(inside)::2]
    before = data[opening - 1]
    begins = edges[np.searchsorted(edges, opening, "right") - 1] == opening
    if (begins | (before == DELIMITER[0]) | (before == QUOTE[0])).all():
        return (counted + inside) % 2 == 1
    out = np.zeros(len(edges) - 1, bool)
    raw, quoted = data.tobytes(), np.diff(counted, prepend=0) > 0
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        inside = ends_inside(raw[a:b], inside) if quoted[i] else inside
        out[i] = inside
    return out


def _by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
    """``file, split`` and the bytes and edges of consecutive lines of one split (a split may come in several parts)."""
    for b in batches:
        if not b.num_rows:
            continue
        files, splits, lines = pc.run_end_encode(b.column(0)), np.asarray(b.column(1)), b.column(2).cast(pa.large_binary())
        edges = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
        held = lines.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
        ends = np.union1d(np.asarray(files.run_ends), np.append(np.flatnonzero(splits[1:] != splits[:-1]) + 1, len(splits)))
        start = 0
        for end in ends.tolist():
            part = edges[start:end + 1]
            yield b.column(0)[start].as_py(), int(splits[start]), data[part[0]:part[-1]], part - part[0]
            start = end


def splits_inside(lines: DataFrame) -> tuple[dict[tuple[str, int], int], list[tuple[str, int]]]:
    """The splits that begin inside a quoted field, with the split in which that field's record begins, and all
    splits that hold a fragment of a record.

    One entry a split at most.
    """
    def ends(batches):
        out = {}
        for file, split, data, edges in _by_split(batches):
            state = out.setdefault((file, split), [False, True, False])
            from_inside = _after(data, edges, state[1])
            state[0] = bool(from_inside[-1]) if state[0] == state[1] else bool(_after(data, edges, state[0])[-1])
            state[1], state[2] = bool(from_inside[-1]), state[2] or not from_inside.all()
        keys = list(out)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                                          *(pa.array([out[k][x] for k in keys], pa.bool_()) for x in range(3))],
                                         ["file", "split", "from_outside", "from_inside", "closes"])

    found = lines.mapInArrow(ends, "file string, split long, from_outside boolean, from_inside boolean, closes boolean")
    inside, broken, file_before, origin = {}, [], None, None        # origin: where the record that is open begins
    # five values a split, put in order here: an ordered query would read the files once more to find its ranges
    for file, split, outside, within, closes in sorted(found.collect(), key=lambda r: (r.file, r.split)):
        if file != file_before:
            file_before, origin = file, None
        began_inside = origin is not None
        if origin is None:
            origin = split if outside else None
        else:
            inside[file, split] = origin
            if closes:
                origin = split if within else None
        if began_inside or origin is not None:
            broken.append((file, split))
    return inside, broken


def _cut(lines: DataFrame, inside: dict[tuple[str, int], int], fragments: bool) -> DataFrame:
    """``file, split, row, kind, chain, text``: whole records, or with ``fragments`` only those at the ends of splits.

    Fragments of one record have the split in which it begins as their ``chain``.
    """
    held = lines.sparkSession.sparkContext.broadcast(inside)

    def cut(batches):
        key, row, pending, kind, open_ = None, 0, [], RECORD, False

        def out(rows, kinds, texts):
            n = len(rows)
            chain = [key[1] if k == TAIL else held.value.get(key) if k != RECORD else None for k in kinds] if fragments else [None] * n
            return pa.RecordBatch.from_arrays(
                [pa.repeat(key[0], n).cast(pa.string()), pa.array(np.full(n, key[1], np.int64)), pa.array(rows, pa.int64()),
                 pa.array(kinds, pa.int32()), pa.array(chain, pa.int64()), texts], ["file", "split", "row", "kind", "chain", "text"])

        def one(kind, text):
            return out([row], [kind], pa.array([text], pa.binary()))

        def rest():
            return one(INNER if kind == HEAD else TAIL, b"\n".join(pending)) if pending and fragments else None

        for file, split, data, edges in _by_split(batches):
            if (file, split) != key:
                if key and (last := rest()):
                    yield last
                key, row, pending = (file, split), 0, []
                open_ = key in held.value
                kind = HEAD if open_ else RECORD
            after = _after(data, edges, open_)
            open_ = bool(after[-1])
            stops = np.flatnonzero(~after)                     # lines that end a record
            first = 0
            if pending or kind == HEAD:                        # the record that was open before these lines
                first = int(stops[0]) + 1 if len(stops) else len(after)
                pending += _lines(data, edges, 0, first)
                if not len(stops):
                    continue
                if fragments == (kind == HEAD):
                    yield one(kind, b"\n".join(pending))
                row, pending, kind, stops = row + 1, [], RECORD, stops[1:]
            if len(stops):
                texts, kept = _whole(data, edges, after, first, stops)
                if not fragments:
                    yield out(np.arange(row, row + kept), np.zeros(kept, np.int32), texts)
                row += kept
                first = int(stops[-1]) + 1
            pending = _lines(data, edges, first, len(after))
        if key and (last := rest()):
            yield last

    return lines.mapInArrow(cut, "file string, split long, row long, kind int, chain long, text binary")


def _lines(data: np.ndarray, edges: np.ndarray, first: int, end: int) -> list[bytes]:
    return [data[a:b].tobytes() for a, b in zip(edges[first:end].tolist(), edges[first + 1:end + 1].tolist())]


def _whole(data: np.ndarray, edges: np.ndarray, after: np.ndarray, first: int, stops: np.ndarray) -> tuple[pa.Array, int]:
    """The records of the lines from ``first`` that end at ``stops``, their line feeds put back, and their number."""
    starts = np.append(first, stops[:-1] + 1)
    breaks = first + np.flatnonzero(after[first:stops[-1] + 1])        # lines that a line feed of their record follows
    lead = edges[first]
    text = np.insert(data[lead:edges[stops[-1] + 1]], edges[breaks + 1] - lead, 10)
    size = edges[stops + 1] - edges[starts] + stops - starts
    ends = np.append(0, np.cumsum(size))
    records = pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(text)])
    empty = (stops == starts) & (size == 0)                            # empty lines are no records
    for i in np.flatnonzero((stops == starts) & (size > 0) & (text[np.minimum(ends[:-1], max(len(text) - 1, 0))] == 13) if len(text) else []):
        empty[i] = not text[ends[i]:ends[i + 1]].tobytes().strip(b"\r")
    return (records.filter(pa.array(~empty)), int((~empty).sum())) if empty.any() else (records, len(stops))


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, row, text`` (bytes) of every record, the header records among them.

    Whole records are cut in one pass; only splits that hold a fragment of one are read again for it.
    """
    lines = file_lines(spark, path)
    inside, broken = splits_inside(lines)
    whole = _cut(lines, inside, False).select("file", "split", "row", "text")
    if not broken:
        return whole
    few = F.broadcast(spark.createDataFrame(broken, "file string, split long"))
    parts = _cut(lines.join(few, ["file", "split"], "left_semi"), inside, True)
    begin = F.min(F.struct("split", "kind", "row"))
    joined = (parts.groupBy("file", "chain").agg(
        begin.alias("at"), F.sort_array(F.collect_list(F.struct("split", "kind", F.hex("text").alias("text")))).alias("parts"))
        .select("file", "at.split", "at.row", F.unhex(F.array_join(F.transform("parts", lambda p: p["text"]), "0A")).alias("text")))
    return whole.unionAll(joined)
