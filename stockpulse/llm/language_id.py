"""Languages of a document by multilingual mixture inference.

Training counts byte n-grams (3 bytes of the lower-cased text) of every document with a known language,
hashed to a fixed number of cells; cells and languages are summed in a grouped aggregation. A document
is a mixture: each of its n-grams comes from one of the languages, in unknown proportions. Expectation-
maximisation finds the proportions from the n-gram likelihoods; the set of languages is the one with the
best likelihood less a penalty for each language, found by leaving out the weakest while that pays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import row_key

#: Cells that n-grams are hashed to, bits; languages a model may have; rounds of the mixture fit.
CELL_BITS, MAX_LANGUAGES, ROUNDS, SMOOTH = 16, 200, 12, 0.5
#: Bytes of a text that are counted at a time.
PIECE = 1 << 20


def cells(text: str, bits: int = CELL_BITS) -> np.ndarray:
    """Counts of the hashed 3-byte strings of one text, lower-cased and set in spaces; all of it."""
    total = np.zeros(1 << bits, np.int64)
    data = b" " + " ".join(text.lower().split()).encode() + b" "
    for start in range(0, len(data) - 2, PIECE):
        b = np.frombuffer(data[start:start + PIECE + 2], np.uint8).astype(np.uint32)
        codes = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761) >> np.uint32(32 - bits)
        total += np.bincount(codes, minlength=1 << bits)
    return total


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = CELL_BITS,
          max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages in order, log-probabilities cells x languages) from all labelled rows of ``docs``.

    Partial counts leave each task as one dense row a language. The model is cells x languages in size,
    whatever the number of documents; more than ``max_languages`` raise an error.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"]):
                if has_letter(t := text.as_py()):
                    if lang not in sums:
                        if len(sums) >= max_languages:
                            raise ValueError(f"more than {max_languages} languages")
                        sums[lang] = np.zeros(1 << bits, np.int64)
                    sums[lang] += cells(t, bits)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "cell", "n"])

    counts = stage(rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")), "language-cells")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(max_languages + 1).collect())
    if len(langs) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    table, at = np.zeros((1 << bits, len(langs))), {x: i for i, x in enumerate(langs)}
    for r in counts.toLocalIterator():
        table[r["cell"], at[r["lang"]]] = r["n"]
    return langs, np.log((table + SMOOTH) / (table.sum(axis=0) + SMOOTH * (1 << bits))).astype(np.float32)


def proportions(counts: np.ndarray, likely: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Mixture proportions of the columns of ``likely`` and the log-likelihood of the counts, by EM."""
    share, n = np.full(likely.shape[1], 1 / likely.shape[1]), counts.sum()
    for _ in range(rounds):
        share = share * (likely.T @ (counts / (likely @ share))) / n
    return share, float(counts @ np.log(likely @ share))


def infer(text: str, logs: np.ndarray, bits: int = CELL_BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, list[int]]:
    """(proportions over all languages, languages in the chosen set).

    Starts with every language and leaves out the one with the least share while the likelihood, less half
    the logarithm of the number of n-grams for each language, does not fall.
    """
    total = cells(text, bits)
    at = np.flatnonzero(total)
    counts, own = total[at].astype(float), logs[at].astype(float)
    top = own.max(axis=1, keepdims=True)
    likely, penalty = np.exp(own - top), 0.5 * np.log(counts.sum())
    chosen = list(range(logs.shape[1]))
    share, value = proportions(counts, likely, rounds)
    while len(chosen) > 1:
        fewer = [c for i, c in enumerate(chosen) if i != int(share.argmin())]
        less, lower = proportions(counts, np.ascontiguousarray(likely[:, fewer]), rounds)
        if value - lower > penalty:
            break
        chosen, share, value = fewer, less, lower
    full = np.zeros(logs.shape[1])
    full[chosen] = share
    return full, chosen


def identify(docs: DataFrame, langs: list[str], logs: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             bits: int = CELL_BITS) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, lang_pred, score, langs (the set chosen, greatest share first), shares.

    ``lang_pred`` has the greatest share, and that share is ``score``. Without a letter in the text, or
    without a trained language, it is 'und', with score 0 and an empty set. Only the text is looked at.
    """
    rows = docs.select(row_key(docs), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    model = docs.sparkSession.sparkContext.broadcast(logs)  # cells x languages, bounded by both parameters

    def run(batches):
        logs = model.value
        for b in batches:
            found = []
            for text in b["text"]:
                if not langs or not has_letter(t := text.as_py()):
                    found.append(("und", 0.0, [], []))
                    continue
                share, chosen = infer(t, logs, bits)
                order = sorted(chosen, key=lambda i: (-share[i], i))
                found.append((langs[order[0]], float(min(1.0, share[order[0]])), [langs[i] for i in order], [float(share[i]) for i in order]))
            columns = list(zip(*found)) if found else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b["_row"], b["doc_id"], pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                 pa.array(columns[2], pa.list_(pa.string())), pa.array(columns[3], pa.list_(pa.float64()))],
                ["_row", "doc_id", "lang_pred", "score", "langs", "shares"])

    return rows.mapInArrow(run, f"_row long, doc_id {kind}, lang_pred string, score double, langs array<string>, shares array<double>")
