"""Near duplicates by 64-bit SimHash, compared bit-sliced.

Two fingerprints within 3 bits agree in at least two of five bit ranges, so each pair of ranges is one
blocking table (25 or 26 bits). Inside a block the fingerprints stand vertically: one bit vector for
each of the 64 planes. A query adds plane differences to carry-save counters for all of the block at
once, and stops when every distance is beyond the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import keep_rows, numbered, row_key
from .components import components

RADIUS, SEED, SHINGLE = 3, 42, 3
#: Five bit ranges (low bit, width); radius 3 leaves two of them untouched.
RANGES = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of a hot block that meet in one task at most, and rows compared at once.
CHUNK, BATCH = 2048, 1024
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20


def _hashes(data: bytes, k: int, seed: int):
    """Arrays of shingle hashes of one text, a bounded piece of it at a time."""
    low, words, start, any_yet = data.lower(), [], 0, False
    while start < len(low):
        end = min(start + PIECE, len(low))
        while end < len(low) and low[end:end + 1] not in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"):
            end += 1
        words += low[start:end].split()
        start = end
        if len(words) >= k:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(k))))
            yield np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, len(words) - k + 1)
            words, any_yet = words[len(words) - k + 1:], True
    if words and not any_yet:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)


def fingerprint(text: str | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text: bit set if set in over half of the shingle hashes; no words: 0."""
    ones, n = np.zeros(64, np.int64), 0
    for h in _hashes((text or "").encode(), k, seed):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(_row, doc_id, fp): the fingerprint as a signed long."""
    rows = docs.select(row_key(docs), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), k, seed) for t in b["text"]), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b["_row"], b["doc_id"], pa.array(fp.view(np.int64))], ["_row", "doc_id", "fp"])

    return rows.mapInArrow(run, "_row long, doc_id long, fp long")


def _rows_within(fps: np.ndarray, same: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(queries, bit rows): for each query with a partner, the fingerprints within ``radius`` as packed bits."""
    n = len(fps)
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    width = -(-n // 64)
    planes = np.zeros((64, width * 8), np.uint8)
    planes[:, :-(-n // 8)] = np.packbits(bits.T, axis=1, bitorder="little")
    planes = planes.view(np.uint64)
    full = ~np.uint64(0)
    flip = np.where(bits.T.astype(bool), full, np.uint64(0))
    n_counters = max(1, int(radius).bit_length())
    start = (1 << n_counters) - 1 - radius  # a counter overflows at radius + 1
    asked = np.arange(n)
    counters = [np.full((n, width), full if start >> c & 1 else 0, np.uint64) for c in range(n_counters)]
    beyond = ~same
    for b in range(64):
        carry = planes[b][None, :] ^ flip[b][asked][:, None]
        for c in counters:
            old = c & carry
            c ^= carry
            carry = old
        beyond |= carry
        if b % 8 == 7:  # leave queries all of whose distances are beyond the radius, themselves aside
            left = np.bitwise_count(~beyond).sum(axis=1) > 1
            if not left.all():
                asked, beyond, counters = asked[left], beyond[left], [c[left] for c in counters]
            if not len(asked):
                break
    return asked, ~beyond


def _stars(fps: np.ndarray, group: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (member, smallest member) of the connected sets among fingerprints of the same group."""
    n = len(fps)
    mask = np.packbits(group[:, None] == group[None, :], axis=1, bitorder="little")
    same = np.zeros((n, -(-n // 64) * 8), np.uint8)
    same[:, :mask.shape[1]] = mask
    asked, rows = _rows_within(fps, same.view(np.uint64), radius)
    at = {int(q): i for i, q in enumerate(asked)}
    signed, links = fps.view(np.int64), []
    seen = np.zeros(rows.shape[1], np.uint64)
    for q in asked.tolist():
        if seen[q // 64] >> np.uint64(q % 64) & np.uint64(1):
            continue
        reached = np.zeros_like(seen)
        new = rows[at[q]].copy()
        while new.any():
            reached |= new
            members = np.flatnonzero(np.unpackbits(new.view(np.uint8), bitorder="little"))
            new = np.bitwise_or.reduce(rows[[at[int(m)] for m in members]], axis=0) & ~reached
        seen |= reached
        members = signed[np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little"))]
        root = int(members.min())
        links += [(int(m), root) for m in np.unique(members) if m != root]
    return links


def _compare(radius: int):
    """Links of all cells of a partition, whose rows come sorted by cell; whole cells are compared together."""

    def run(batches):
        held_fp, held_cell, n_cells = [], [], 0
        last = None

        def flush():
            links = _stars(np.array(held_fp, np.int64).view(np.uint64), np.array(held_cell), radius)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

        for batch in batches:
            cells = zip(*(batch[c].to_pylist() for c in ("band", "key", "ci", "cj")))
            for cell, fp in zip(cells, batch["fp"].to_pylist()):
                if cell != last:
                    if len(held_fp) >= BATCH:
                        yield flush()
                        held_fp, held_cell = [], []
                    last, n_cells = cell, n_cells + 1
                held_fp.append(fp)
                held_cell.append(n_cells)
        if held_fp:
            yield flush()

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(fp), distinct -> (a, b): links that connect all fingerprints within ``radius`` (3 at most) of each other.

    A block of over ``chunk`` fingerprints is cut into chunks by hash, and each pair of chunks is a cell of
    its own, so that no task is given a hot block whole.
    """
    if radius > 3:
        raise ValueError("the five bit ranges are made for a radius of 3 at most")
    keys = [F.struct(F.lit(t).alias("band"), sum((F.shiftleft(F.shiftrightunsigned("fp", lo).bitwiseAND((1 << w) - 1), 13 * i)
                                                  for i, (lo, w) in enumerate(pair)), F.lit(0).cast("long")).alias("key"))
            for t, pair in enumerate(combinations(RANGES, 2))]
    blocked = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.band", "k.key")
    # written first: a join of two plain shuffles is one whose hot partitions Spark can split
    shared = stage(blocked.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1"), "shared-blocks")
    rows = blocked.join(shared, ["band", "key"]).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    rows = rows.withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = cells.select("band", "key", "fp", F.least("c", "other").alias("ci"), F.greatest("c", "other").alias("cj"))
    cells = cells.repartition("band", "key", "ci", "cj").sortWithinPartitions("band", "key", "ci", "cj")
    return cells.mapInArrow(_compare(radius), "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, fp, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reached over links of at most ``radius`` bits, the row's own
    included (null only where no id in reach is set). Texts without words (null, empty, spaces) have
    fingerprint 0 and are linked like any other. Ids must be integers.
    """
    fps = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    linked = components(near_links(distinct.select("fp"), radius))
    placed = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = stage(placed.join(first, "root").select("fp", "component_id"), "near-groups")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(groups, "fp").select("_row", "doc_id", "fp", digits.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row left of each near-duplicate group: the smallest id, of repeated rows the first."""
    docs = numbered(docs)
    groups = near_groups(docs, id_col, text_col)
    best = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component_id").agg(F.min("_row").alias("_row"))
    return keep_rows(docs, best)
