"""Best-two-fit packing of tokenised documents into sequences of fixed length.

The packing is planned on the histogram of piece lengths, whose size is bounded by the sequence length,
never by the rows: a bin is filled greedily with the longest pieces that fit, then its smallest piece
gives way to two others that fill the gap better. One plan step stands for as many equal bins as the
counts allow. Pieces then find their place by their rank among pieces of the same length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage
from .common import process_cache, row_key

CAPACITY, END_ID = 1024, 2
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: Characters of a text that are encoded at a time; cuts fall where no token can cross.
PIECE = 1 << 20
PIECES = "_row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _encoder(path: str, pattern: str):
    cache = process_cache()
    if path not in cache:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
        cache[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
    return cache[path]


def _cuts(text: str, size: int):
    """Parts of about ``size`` characters, cut only before a single space between word characters."""
    start, between = 0, re.compile(r"(?<=\w) (?=\w)")
    while len(text) - start > size:
        if not (m := between.search(text, start + size)):
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def token_ids(text: str, encoder, size: int = PIECE) -> np.ndarray:
    """Ids of one text and the end id."""
    encode = (lambda t: encoder.encode(t, allowed_special="all")) if SPECIAL in text else encoder.encode_ordinary
    parts = [np.array(encode(part), "<u4") for part in _cuts(text, size)]
    return np.concatenate([*parts, np.array([END_ID], "<u4")])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           vocabulary: str | None = None) -> DataFrame:
    """One row per piece: _row, doc_id, piece, start, length, ids_crc32.

    ``vocabulary`` is the path of a byte-level BPE rank file, the vocabulary of ``byte_bpe_50k.json`` by
    default; both give the same ids. A null text is empty and has one piece, the end id. Only documents
    of more than ``capacity`` ids are cut; their first piece takes what is left over.
    """
    import public_tokenizers

    path, pattern = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select(row_key(docs), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches):
        encoder = _encoder(path, pattern)
        for batch in batches:
            out = []
            for row, doc, text in zip(batch["_row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
                ids = token_ids(text.as_py() or "", encoder)
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                out += [(row, doc, i, a, b - a, zlib.crc32(ids[a:b])) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if out:
                yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, PIECES)


def _below(counts: np.ndarray) -> np.ndarray:
    """For each length, the greatest length in stock that is not above it; 0 if none."""
    return np.maximum.accumulate(np.where(counts > 0, np.arange(len(counts)), 0))


def best_two(counts: np.ndarray, room: int) -> tuple[int, int]:
    """The two lengths in stock with the greatest sum that fits ``room``; zeros if there are none."""
    long = np.flatnonzero(counts[:max(room, 1)] > 0)
    below = _below(counts)
    short = below[np.minimum(room - long, long)]
    alone = (short == long) & (counts[long] < 2)
    short = np.where(alone, below[np.maximum(long - 1, 0)], short)
    sums = np.where((short > 0) & (long > 0), long + short, 0)
    if not len(sums) or not sums.max():
        return 0, 0
    at = int(sums.argmax())
    return int(long[at]), int(short[at])


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Bins for the piece lengths of a histogram: (how many alike, lengths in the bin)."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    bins = []
    while counts.any():
        stock, inside, room = counts.copy(), [], capacity
        while length := int(_below(stock[:room + 1])[-1]):
            inside.append(length)
            stock[length] -= 1
            room -= length
        if room and inside:
            least = inside[-1]
            a, b = best_two(stock, room + least)
            if a + b > least:
                inside[-1:] = [a, b]
        times = min(int(counts[length]) // n for length, n in Counter(inside).items())
        for length in inside:
            counts[length] -= times
        bins.append((times, inside))
    return bins


def _places(bins: list[tuple[int, list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by (length, first rank): the key of both, the first rank, its sequence and its offset."""
    used, rows, sequence = Counter(), [], 0
    for times, inside in bins:
        offset = 0
        for length in inside:
            rows.append((length << 44 | used[length], used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows))) if rows else (np.zeros(0, np.int64),) * 4


def ranked(cut: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 without gaps among pieces of one length.

    Numbers within (length, input partition) and adds the counts of the partitions before, so that a
    frequent length is not numbered by one task.
    """
    part = F.shiftright("_row", 33)
    cut = cut.withColumn("part", part)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    starts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("_row", "piece")) - 1
    return cut.withColumn("within", within).join(starts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("within"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences are numbered from 0; pieces fill a sequence from offset 0 without gaps. An empty table gives
    no rows; repeated rows are packed as often as they occur.
    """
    cut = stage(pieces(docs, id_col, text_col, capacity, vocabulary), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    keys, firsts, sequences, offsets = _places(plan(histogram, capacity))

    def place(batches):
        for b in batches:
            length, rank = (b[c].to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequences[at] + rank - firsts[at]), pa.array(offsets[at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
