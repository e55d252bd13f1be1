"""Removal of long repeated byte strings by sampled suffixes; not a full prefix doubling.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else. Prefix doubling over all
suffixes sorts one (position, rank) pair of 16 bytes or more for each byte of text, in every round: over 16 times
the input on disk where four times are allowed. So only the first two rounds are kept (64 and 128 bytes), and
suffixes are sampled in a way that loses nothing: the *anchor* of a
window of LENGTH bytes is the place of the smallest gram hash among its first ``SPAN`` places. It depends on
the window alone, so equal windows have their anchors at the same offset. Only anchors (about one in 128
bytes) enter the doubling:

1. Rounds at 64 and 128 bytes: anchors are grouped by their pair (rank of the first half, name of the
   second half); a pair that is unique drops out, the others are ranked anew.
2. All windows of an anchor together are one string. If that string repeats, all of them repeat. One such
   anchor of each kind stays on as partner, with weight 2, where an open anchor has the same rank.
3. The windows of an open anchor are split by offset into nodes of ``STEP``; a node whose common core (337
   bytes) is unique drops out.
4. Past that, each window of the open nodes and their partners is named by 128 bits and counted.

Names are hashes of substrings, so a rank at any offset is known without a look-up; groups are counted
with map-side combining and met again by joins that can be split. Shuffled rows follow the number of
anchors, and in step 4 the bytes near the ends of repeated passages, whatever the size of a group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, stage
from .common import ROW_KEY, numbered, process_cache, shuffles_freed

LENGTH, GRAM, SPAN, STEP = 400, 16, 256, 64
#: Windows of a text that are worked on at a time.
CHUNK = 1 << 20
#: Multipliers of the two hashes, odd.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    out, known = np.ones(n, np.uint64), 1
    while known < n:
        k = min(known, n - known)
        out[known:known + k] = out[:k] * np.uint64(pow(base, known, 1 << 64))
        known += k
    return out


class Hashes:
    """Hashes of any substrings of one text, modulo 2**64, from prefix sums of byte value times a power."""

    def __init__(self, data: np.ndarray, which: int = 0):
        cache, key = process_cache(), f"powers{which}"
        if key not in cache or len(cache[key][0]) < len(data) + 1:
            values = np.random.default_rng(which).integers(0, 1 << 63, 256, dtype=np.uint64)
            cache[key] = (_powers(BASES[which], 2 * len(data) + 1), _powers(pow(BASES[which], -1, 1 << 64), 2 * len(data) + 1), values)
        self.up, down, values = cache[key]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * down[:len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.up[end]
        h ^= h >> np.uint64(32)
        return h * np.uint64(0xFF51AFD7ED558CCD)


def anchors(data: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): each anchor and the first and last start of the windows it stands for."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    grams = n + SPAN - 1
    bits = np.uint64(len(data).bit_length())
    least = hashes.of(slice(0, grams), slice(GRAM, grams + GRAM)) >> bits << bits | np.arange(grams, dtype=np.uint64)
    width = 1
    while width < SPAN:  # minima of 2, 4, ... places; of equal grams the first
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    edges = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], edges])
    return at[first], first, np.concatenate([edges, [n]]) - 1


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(h).view(np.int64))


def sampled(texts: DataFrame) -> DataFrame:
    """(_row, at, first, last, rank, next, whole, whole2): anchors with the names of two runs of 64 bytes and of all their windows."""
    names = ["_row", "at", "first", "last", "rank", "next", "whole", "whole2"]

    def run(batches):
        for b in batches:
            for row, text in zip(b["_row"].to_pylist(), b["text"]):
                data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                for start in range(0, max(len(data) - LENGTH + 1, 0), CHUNK):
                    piece = data[start:start + CHUNK + LENGTH - 1]
                    h, second = Hashes(piece), Hashes(piece, 1)
                    at, first, last = anchors(piece, h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), row)), pa.array(at + start), pa.array(first + start), pa.array(last + start),
                         _signed(h.of(at, at + 64)), _signed(h.of(at + 64, at + 128)), _signed(h.of(first, last + LENGTH)),
                         _signed(second.of(first, last + LENGTH))], names)

    return texts.mapInArrow(_larger(run, 100_000), "_row long, at long, first long, last long, rank long, next long, whole long, whole2 long")


def _larger(run, rows: int):
    """``run`` with its record batches put together to about ``rows`` rows."""

    def joined(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key occurs more than once.

    The repeated keys are written first: a join of two plain shuffles is one whose hot partitions Spark can split.
    """
    often = stage(rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys), "repeated-keys")
    return rows.join(often, keys, "left_semi")


def _nodes(batches):
    """Open anchors of each document -> (_row, at, node, first, last, weight, open, core)."""
    for b in batches:
        for row, text, points in zip(b["_row"].to_pylist(), b["text"], b["points"].to_pylist()):
            data, out = np.frombuffer(text.as_buffer(), np.uint8), []
            for start, piece, inside in _pieces(data, points):
                h = Hashes(piece)
                at, first, last, weight, is_open = (np.array([p[c] for p in inside]) for c in ("at", "first", "last", "weight", "open"))
                for i in range(SPAN // STEP):
                    low, high = np.maximum(at - i * STEP - STEP + 1, first), np.minimum(at - i * STEP, last)
                    k = np.flatnonzero(low <= high)
                    core = h.of(at[k] - i * STEP - start, at[k] - i * STEP - STEP + 1 + LENGTH - start)
                    out.append(pa.RecordBatch.from_arrays([pa.array(np.full(len(k), row)), pa.array(at[k]), pa.array(np.full(len(k), i, np.int32)), pa.array(low[k]), pa.array(high[k]),
                                                           pa.array(weight[k]), pa.array(is_open[k]), _signed(core)], ["_row", "at", "node", "first", "last", "weight", "open", "core"]))
            yield from out


def _pieces(data: np.ndarray, points: list[dict]):
    """(start, bytes, points) in pieces of the text; a point's windows lie in the piece of its first window."""
    by: dict[int, list[dict]] = {}
    for p in points:
        by.setdefault(p["first"] // CHUNK, []).append(p)
    for k, inside in by.items():
        # an anchor, its core and its windows reach from SPAN before its first window to SPAN + LENGTH behind its last
        start = max(k * CHUNK - SPAN, 0)
        yield start, data[start:(k + 1) * CHUNK + 2 * SPAN + LENGTH], inside


def _windows(batches):
    """Open nodes of each document -> (_row, start, weight, open, name1, name2), one row a window."""
    for b in batches:
        for row, text, points in zip(b["_row"].to_pylist(), b["text"], b["points"].to_pylist()):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for start, piece, inside in _pieces(data, points):
                one, two = Hashes(piece, 0), Hashes(piece, 1)
                size = np.array([p["last"] - p["first"] + 1 for p in inside])
                w = np.concatenate([np.arange(p["first"], p["last"] + 1) for p in inside])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(w), row)), pa.array(w), pa.array(np.repeat([p["weight"] for p in inside], size)), pa.array(np.repeat([p["open"] for p in inside], size)),
                     _signed(one.of(w - start, w - start + LENGTH)), _signed(two.of(w - start, w - start + LENGTH))], ["_row", "start", "weight", "open", "name1", "name2"])


def _kept(batches):
    """Texts with the ranges of their repeated windows -> the figures of each document."""
    for b in batches:
        out = []
        for row, doc, text, ranges in zip(b["_row"].to_pylist(), b["doc_id"].to_pylist(), b["text"], b["ranges"]):
            data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            gone, ranges = [], ranges.values if ranges.is_valid else None
            if ranges is not None and len(ranges):
                first, last = ranges.field("first").to_numpy(), ranges.field("last").to_numpy()
                order = np.argsort(first, kind="stable")
                first, reach = first[order], np.maximum.accumulate(last[order] + LENGTH)
                edges = np.flatnonzero(first[1:] > reach[:-1]) + 1
                gone = list(zip(first[np.concatenate([[0], edges])].tolist(), reach[np.concatenate([edges, [len(first)]]) - 1].tolist()))
            digest, at = hashlib.sha256(), 0
            for a, e in [*gone, (len(data), len(data))]:
                digest.update(data[at:a])
                at = e
            out.append((row, doc, len(data), sum(e - a for a, e in gone), len(gone), digest.hexdigest(), [a for a, _ in gone], [e for _, e in gone]))
        columns = list(zip(*out)) if out else [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], b["doc_id"].type), *(pa.array(c, pa.int64()) for c in columns[2:5]), pa.array(columns[5], pa.string()),
                                          *(pa.array(c, pa.list_(pa.int64())) for c in columns[6:])], ["_row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends"])


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """(_row, text) -> (_row, first, last): ranges of starts at which a window occurs that also starts elsewhere."""
    found = stage(sampled(texts), "anchors")
    half = stage(_repeated(found, ["rank"]), "anchors-64")  # round 1
    discard(found)
    full = _repeated(half, ["rank", "next"]).withColumn("rank", F.xxhash64("rank", "next")).drop("next")  # round 2
    full = stage(full, "anchors-128")
    discard(half)

    wholes = ["whole", "whole2"]  # 128 bits: removal rests on this name alone
    kinds = full.groupBy(*wholes).agg(F.count("*").alias("n"), F.min(F.struct("_row", "first")).alias("head"))
    sorted_out = full.join(stage(kinds.filter("n > 1"), "repeated-wholes"), wholes, "left")
    sorted_out = stage(sorted_out.select("_row", "at", "first", "last", "rank", F.col("n").isNull().alias("open"),
                                         F.col("head").eqNullSafe(F.struct("_row", "first")).alias("head")), "anchors-sorted")
    discard(full)
    still = sorted_out.filter("open")
    partners = sorted_out.filter("head AND NOT open").join(stage(still.select("rank").distinct(), "open-ranks"), "rank", "left_semi")
    active = still.unionByName(partners.select(*still.columns)).withColumn("weight", F.when(F.col("open"), 1).otherwise(2).cast("long"))

    def with_text(points: DataFrame, columns: list[str]) -> DataFrame:
        return texts.join(points.groupBy("_row").agg(F.collect_list(F.struct(*columns)).alias("points")), "_row")

    columns = ["at", "first", "last", "weight", "open"]
    nodes = with_text(active, columns).select("_row", "text", "points").mapInArrow(
        _larger(_nodes, 20_000), "_row long, at long, node int, first long, last long, weight long, open boolean, core long")
    nodes = stage(nodes, "nodes")
    cores = nodes.groupBy("node", "core").agg(F.sum("weight").alias("n"), F.max("open").alias("asked")).filter("n > 1 AND asked")
    cores = stage(cores.select("node", "core"), "repeated-cores")
    alive = stage(nodes.join(cores, ["node", "core"], "left_semi"), "open-nodes")
    discard(nodes)

    windows = with_text(alive, columns).select("_row", "text", "points").mapInArrow(
        _larger(_windows, 50_000), "_row long, start long, weight long, open boolean, name1 long, name2 long")
    windows = stage(windows, "windows")
    names = windows.groupBy("name1", "name2").agg(F.sum("weight").alias("n"), F.max("open").alias("asked")).filter("n > 1 AND asked")
    names = stage(names.select("name1", "name2"), "repeated-names")
    late = windows.filter("open").join(names, ["name1", "name2"], "left_semi")
    ranges = stage(sorted_out.filter("NOT open").select("_row", "first", "last").unionByName(
        late.select("_row", F.col("start").alias("first"), F.col("start").alias("last"))), "repeated-ranges")
    discard(windows, alive, sorted_out)
    return ranges


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, n_bytes, n_removed, n_spans, kept_sha256, span_starts, span_ends.

    Texts are judged as UTF-8 bytes; a null text is empty. Strings are looked up in the input, within and
    across documents, and never cross from one into another; repeated rows are copies of each other, so a
    text of ``LENGTH`` bytes that occurs twice goes whole. Spans are byte ranges [start, end) of the input.
    """
    spark = docs.sparkSession
    rows = numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).withColumnRenamed(ROW_KEY, "_row")
    kind = rows.schema["doc_id"].dataType.simpleString()
    with shuffles_freed(spark):
        ranges = repeated_ranges(rows.select("_row", "text"))
        listed = ranges.groupBy("_row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
        out = rows.join(listed, "_row", "left").select("_row", "doc_id", "text", "ranges").mapInArrow(
            _kept, f"_row long, doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, span_starts array<long>, span_ends array<long>")
        out = stage(out, "without-repeats")
        discard(ranges)
        return out
