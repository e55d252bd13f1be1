"""Document quality by hierarchical empirical Bayes.

A logistic classifier gives each document's own evidence from counts over the whole text. Host and path
posteriors come from grouped sums of that evidence over all documents: a path's rate is shrunk toward its
host's, a host's toward the global rate, by weights estimated from the spread between sites. A sparse
site thus stays near its parent, and a document's odds are its own evidence times its path's prior odds.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import attach_row, release, stage
from .common import keep_rows, numbered, row_key

#: Labelled rows the classifier is fitted on: all, or about so many, chosen by a hash of the id.
TRAIN_ROWS, SEED, ITERATIONS = 50_000, 29, 60
FEATURES = ("log_words", "word_length", "capitals", "digits", "marks", "odd_marks", "bars", "distinct", "commonest", "commonest_end",
            "repeated_pairs", "long_words", "short_lines", "marked_words", "capital_words", "shouted_words")
#: Parts of a text whose words are counted at a time.
PIECE = 1 << 20

_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "*#$%&@^~<>{}[]=+_\\"]] = True
_BARS = np.zeros(256, bool)
_BARS[[ord(c) for c in "|\t;"]] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for c in ".,'-?:()\" "]] = True
_PLAIN[10] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True


def features(text: str | None) -> list[float]:
    """Shares and lengths over the whole text; an empty text is all zeros."""
    data = (text or "").encode()
    words, followed, ends, marked, capital, shouted, long, chars, n = Counter(), [], Counter(), 0, 0, 0, 0, 0, 0
    last, start = b"", 0
    while start < len(data):  # a piece at a time, cut at a line or space where there is one
        end = start + PIECE
        if end < len(data):
            cut = max(data.rfind(b" ", start, end), data.rfind(b"\n", start, end))
            end = cut if cut > start else end
        own = data[start:end].split()
        start = end
        words.update(own)
        following = zip([last, *own], own) if last else zip(own, own[1:])
        followed.append(np.fromiter((hash(p) for p in following), np.int64))
        n += len(own)
        last = own[-1] if own else last
    for w, k in words.items():
        chars += k * len(w)
        tail = w[-1:]
        ends[tail] += k
        marked += k * (not tail.isalnum() and tail < b"\x80" and tail not in (b".", b","))
        capital += k * w[:1].isupper()
        shouted += k * (len(w) > 2 and w.isupper())
        long += k * (len(w) > 15)
    pairs = sum(map(len, followed)) - len(np.unique(np.concatenate([*followed, np.empty(0, np.int64)])))  # over the whole text
    n, size = max(n, 1), max(len(data), 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = lambda which: float(counts[which].sum()) / size
    lines = data.count(b"\n") + 1
    return [math.log1p(n), chars / n, share(_CAPITAL), share(_DIGIT), share(~(_LETTER | _DIGIT | _PLAIN)), share(_ODD), share(_BARS),
            len(words) / n, max(words.values(), default=0) / n, max((v for k, v in ends.items() if k < b"A"), default=0) / n,
            pairs / n, long / n, min(lines / n, 1.0), marked / n, capital / n, shouted / n]


def measured(docs: DataFrame, id_col: str, text_col: str, host: Column, path: Column) -> DataFrame:
    """_row, doc_id, host, path and the feature array of each row."""
    rows = docs.select(row_key(docs), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), host.alias("host"), path.alias("path"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = pa.array([features(t.as_py()) for t in b["text"]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in ("_row", "doc_id", "host", "path")), found], ["_row", "doc_id", "host", "path", "x"])

    return rows.mapInArrow(run, f"_row long, doc_id {kind}, host string, path string, x array<double>")


def site_columns(source_col: str = "source", lang_col: str | None = "lang") -> tuple[Column, Column]:
    """(host, path) of a source: of an address, its host and first folder; of a plain name, the name and the language section."""
    bare = F.regexp_replace(F.lower(F.col(source_col).cast("string")), r"^(?:[a-z]+://)?(?:www\.)?", "")
    host = F.coalesce(F.regexp_extract(bare, r"^([^/?#]*)", 1), F.lit(""))
    section = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    folder = F.regexp_extract(bare, r"^[^/?#]*/([^/?#]*)", 1)
    return host, F.concat_ws("/", host, F.coalesce(F.nullif(folder, F.lit("")), section, F.lit("")))


def _evidence(x: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """Adds ``own``, the classifier's probability of good; with labels of one kind only, that kind's smoothed share."""
    truth = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    known = stage(x.join(truth, "doc_id").select("label", "x", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)).alias("draw")), "quality-known")
    share = train_rows / max(known.count(), 1)
    known = known.filter(F.col("draw") < int(share * (1 << 30))).select("label", array_to_vector("x").alias("features"))
    ones, n = (float(v or 0) for v in known.agg(F.sum("label"), F.count("*")).first())
    if not 0 < ones < n:
        return x.withColumn("own", F.lit((ones + 1) / (n + 2)))
    model = LogisticRegression(maxIter=ITERATIONS, regParam=1e-4, standardization=True).fit(known)
    weights = [float(w) for w in model.coefficients]
    z = F.aggregate(F.zip_with("x", F.lit(weights), lambda a, b: a * b), F.lit(float(model.intercept)), lambda a, v: a + v)
    return x.withColumn("own", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))


def _strength(rows: DataFrame, parent: str) -> DataFrame:
    """Pseudo-documents a parent's rate counts for, by the method of moments: p (1 - p) / (spread between sites) - 1.

    ``rows`` has n, good and the parent's rate for each site. Little spread gives a strong parent; at
    least 1, at most 10,000.
    """
    p = F.col("good") / F.col("n")
    between = F.sum(F.col("n") * (p - F.col(parent)) * (p - F.col(parent))) / F.sum("n")
    noise = F.sum(F.col(parent) * (1 - F.col(parent))) / F.sum("n")
    level = F.sum(F.col("n") * F.col(parent) * (1 - F.col(parent))) / F.sum("n")
    strength = level / F.greatest(between - noise, level * 1e-4) - 1
    return rows.agg(F.coalesce(F.greatest(F.lit(1.0), F.least(F.lit(1e4), strength)), F.lit(1.0)).alias("strength"))


def site_rates(own: DataFrame) -> DataFrame:
    """host, path, host_rate, path_rate, global_rate from the documents' own probabilities; one row a path."""
    paths = stage(own.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("good")), "path-sums")
    total = paths.agg((F.sum("good") / F.sum("n")).alias("global_rate"))
    hosts = attach_row(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), total)
    hosts = attach_row(hosts, _strength(hosts, "global_rate"))
    hosts = stage(hosts.select("host", "global_rate", ((F.col("good") + F.col("strength") * F.col("global_rate")) / (F.col("n") + F.col("strength"))).alias("host_rate")), "host-rates")
    paths = paths.join(hosts, "host")
    paths = attach_row(paths, _strength(paths, "host_rate"))
    rate = (F.col("good") + F.col("strength") * F.col("host_rate")) / (F.col("n") + F.col("strength"))
    return paths.select("host", "path", "global_rate", "host_rate", rate.alias("path_rate"))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str | None = "lang", train_rows: int = TRAIN_ROWS, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, host, path, own, host_rate, path_rate, quality, keep.

    ``labels`` has doc_id and quality (1 good, 0 bad); rows without either are not used, and of several
    labels of a document the best counts. Null texts count as empty, null sources as the host ''. With no
    usable labels all documents share one probability, 0.5.
    """
    host, path = site_columns(source_col, lang_col)
    x = stage(measured(docs, id_col, text_col, host, path), "quality-features")
    own = _evidence(x, labels, train_rows)
    release(docs.sparkSession)
    # written: the subqueries of the rates are planned once, not again in each plan that reads the scores
    rates = stage(site_rates(own).select(F.col("path").alias("of"), "global_rate", "host_rate", "path_rate"), "site-rates")
    logit = lambda p: F.log(F.greatest(p, F.lit(1e-6)) / F.greatest(1 - p, F.lit(1e-6)))
    z = logit(F.col("own")) + logit(F.col("path_rate")) - logit(F.col("global_rate"))
    out = own.join(rates, own["path"] == rates["of"]).withColumn("quality", 1 / (1 + F.exp(-z)))
    return out.select("_row", "doc_id", "host", "path", "own", "host_rate", "path_rate", "quality", (F.col("quality") >= threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with its columns."""
    docs = numbered(docs)
    return keep_rows(docs, score(docs, labels, **options).filter("keep"))
