"""JSON files of many records, read in splits wherever records begin and end.

A file that is one JSON array (or several objects after one another) is text without a record
separator: newlines may stand anywhere, and a brace may stand in a string. Spark cuts it into
splits at closing braces. Whether a split begins inside a string, and how deep, follows from
what comes before: each split reports, for either case, how many quotes and brackets it holds;
these reports (one per split, as many as Spark plans) are summed along each file. With that
known every split finds its records; only those that cross a border are put together after.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPE = re.compile(rb"\\.", re.S)
_KIND = np.zeros(256, np.int8)
_KIND[[ord(c) for c in '"[{]}']] = 2, 1, 1, -1, -1


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], np.ndarray, np.ndarray]]:
    """(file, start), text and ends of the pieces of each split in a batch, closing braces restored."""
    file, start, value = batch.columns
    n = batch.num_rows
    if not n:
        return
    _, offsets, data = value.buffers()
    offsets = np.frombuffer(offsets, np.int32)[value.offset : value.offset + n + 1].astype(np.int64)
    ends = offsets[1:] - offsets[0] + np.arange(1, n + 1)
    text = np.empty(ends[-1], np.uint8)
    own = np.ones(ends[-1], bool)
    own[ends - 1] = False
    text[ends - 1] = ord("}")
    if data is not None:
        text[own] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    starts = start.to_numpy()
    changes = np.union1d(np.flatnonzero(starts[1:] != starts[:-1]) + 1, pc.run_end_encode(file).run_ends.to_numpy())
    low = 0
    for high in map(int, np.union1d(changes, [n])):
        begin = int(ends[low - 1]) if low else 0
        yield (file[low].as_py(), int(starts[low])), text[begin : ends[high - 1]], ends[low:high] - begin
        low = high


def _marks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes and brackets, how many quotes stand up to each, and its change of depth."""
    if (text == ord("\\")).any():
        # Same length, so that all places stay.
        text = np.frombuffer(_ESCAPE.sub(b"__", text.tobytes()), np.uint8)
    kinds = _KIND[text]
    places = np.flatnonzero(kinds)
    kinds = kinds[places]
    quote = kinds == 2
    return places, np.cumsum(quote), np.where(quote, 0, kinds)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, inside, depth = None, [0, 1], [0, 0]

    def report() -> pa.RecordBatch:
        values = (*place, bool(inside[0]), bool(inside[1]), *depth)
        return pa.record_batch([pa.array([x]) for x in values], ["file", "start", "out0", "out1", "depth0", "depth1"])

    for batch in batches:
        for own, text, _ in _pieces(batch):
            if own != place:
                if place is not None:
                    yield report()
                place, inside, depth = own, [0, 1], [0, 0]
            _, quotes, change = _marks(text)
            odd = quotes & 1
            changes = int(change[odd == 0].sum()), int(change[odd == 1].sum())
            for k in (0, 1):
                depth[k] += changes[inside[k]]
                inside[k] ^= int(odd[-1])
    if place is not None:
        yield report()


def records(spark: SparkSession, folder: str, pattern: str, array: bool = True) -> DataFrame:
    """(value): the text of every object in the matching files of ``folder``.

    ``array``: a file is one JSON array of objects; else one object, or several one after
    another. ``pattern`` may name a folder below. Files that do not exist, are empty, or hold an
    empty array give no rows; an array that is cut off loses its last, open object.
    """
    below, _, names = pattern.rpartition("/")
    path = f"{folder}/{below}" if below else folder
    reader = spark.read.option("pathGlobFilter", names).option("lineSep", "}")
    pieces = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    reports = pieces.mapInArrow(_reports, "file string, start long, out0 boolean, out1 boolean, depth0 long, depth1 long").collect()
    states: dict[tuple[str, int], tuple[bool, int]] = {}
    for file, own in groupby(sorted(reports), key=lambda r: r["file"]):
        inside, depth = False, 0
        for r in own:
            states[file, r["start"]] = inside, depth
            inside, depth = (r["out1"] if inside else r["out0"]), depth + (r["depth1"] if inside else r["depth0"])
    floor, lead = (1, " \t\r\n,[") if array else (0, " \t\r\n")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(file, start, closes, value): whole records without a file; parts of others with it."""
        place, inside, depth, crossing, held, ended = None, 0, 0, False, [], False

        def left() -> Iterator[pa.RecordBatch]:
            if held and (inside or depth > floor):
                text = b"".join(held).decode()
                yield _row(*place, False, text if crossing else text.lstrip(lead))

        for batch in batches:
            for own, text, ends in _pieces(batch):
                if own != place:
                    yield from left()
                    inside, depth = map(int, states[own])
                    place, crossing, held, ended = own, bool(inside or depth > floor), [], False
                if ended:
                    continue
                places, quotes, change = _marks(text)
                # Quotes up to a mark tell whether it stands in a string; every piece ends in one.
                within = (quotes + inside) & 1
                depths = depth + np.cumsum(np.where(within == 0, change, 0))
                last = np.searchsorted(places, ends, "left") - 1
                closed = ends[(within[last] == 0) & (depths[last] == floor)]
                inside, depth = int(within[-1]), int(depths[-1])
                begin = 0
                if len(closed) and (held or crossing):
                    begin = int(closed[0])
                    first = b"".join([*held, text[:begin].tobytes()]).decode()
                    yield _row(*place, True, first) if crossing else _rows(pa.array([first.lstrip(lead)]))
                    closed, held, crossing = closed[1:], [], False
                if len(closed):
                    bounds = np.concatenate(([begin], closed)).astype(np.int32)
                    whole = pa.Array.from_buffers(pa.string(), len(closed), [None, pa.py_buffer(bounds), pa.py_buffer(text)])
                    whole = pc.utf8_ltrim(whole, characters=lead)
                    odd = np.flatnonzero(~pc.starts_with(whole, "{").to_numpy(zero_copy_only=False))
                    if len(odd):  # the array's end
                        whole, ended = whole[: int(odd[0])], True
                    if len(whole):
                        yield _rows(whole)
                    begin = int(closed[-1])
                rest = text[begin:].tobytes()
                if rest and not ended:
                    if not held and not crossing and rest.lstrip(lead.encode())[:1] != b"{":
                        ended = True
                    else:
                        held.append(rest)
                if ended:
                    held, inside, depth = [], 0, 0
        yield from left()

    found = pieces.mapInArrow(find, "file string, start long, closes boolean, value string")
    whole = found.where("file IS NULL").select("value")
    if len(states) == len({file for file, _ in states}):
        return whole
    order = F.struct("start", (~F.col("closes")).alias("opens"), "value")
    parts = found.where("file IS NOT NULL").groupBy("file").agg(F.array_sort(F.collect_list(order)).alias("parts"))
    # Parts follow each other until one closes; what is open at the end of a file is cut off.
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(made, part):
        text = F.concat(made["open"], part["value"])
        done = F.when(part["opens"], made["done"]).otherwise(F.concat(made["done"], F.array(text)))
        return F.struct(done.alias("done"), F.when(part["opens"], text).otherwise("").alias("open"))

    joined = parts.select(F.explode(F.aggregate("parts", start, step, lambda made: made["done"])).alias("value"))
    return whole.unionByName(joined)


_NAMES = ["file", "start", "closes", "value"]


def _rows(texts: pa.Array) -> pa.RecordBatch:
    n = len(texts)
    return pa.record_batch([pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_()), texts], _NAMES)


def _row(file: str, start: int, closes: bool, text: str) -> pa.RecordBatch:
    return pa.record_batch([pa.array([file]), pa.array([start], pa.int64()), pa.array([closes]), pa.array([text])], _NAMES)
