"""Classifiers: held-out accuracy, shrinkage, defined results of edge cases."""

import math

import numpy as np
import pytest
from corpus import SCHEMA, edge_docs, edge_labels, edge_rows
from pyspark.sql import functions as F

from stockpulse.llm import language_id, quality, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    learn = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 0)
    return docs, labels, learn, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 0)


def test_quality_on_held_out_labels(given):
    docs, _, learn, test = given
    got = quality.score(docs, learn).join(test.select("doc_id", F.col("quality").alias("truth")), "doc_id").collect()
    good, bad = [r for r in got if r.truth == 1], [r for r in got if r.truth == 0]
    assert sum(r.keep for r in good) >= 0.97 * len(good) and sum(not r.keep for r in bad) >= 0.8 * len(bad)


def test_sparse_sites_shrink_to_their_parents(spark):
    rows = [("a", "a/x", 0.9)] * 400 + [("a", "a/y", 0.1)] * 2 + [("b", "b/x", 0.2)] * 300 + [("c", "c/x", 0.05)]
    got = {r.path: r for r in quality.site_rates(spark.createDataFrame(rows, "host string, path string, own double")).collect()}
    total = sum(r[2] for r in rows) / len(rows)
    assert all(r.global_rate == pytest.approx(total) for r in got.values())
    assert abs(got["a/x"].path_rate - 0.9) < 0.02 and abs(got["b/x"].path_rate - 0.2) < 0.03
    raw = {"a/y": 0.1, "c/x": 0.05}
    assert raw["a/y"] < got["a/y"].path_rate < got["a/y"].host_rate  # two documents move a path a little
    assert raw["c/x"] < got["c/x"].host_rate < total


def test_sites_of_addresses(spark):
    host, path = quality.site_columns("s", "l")
    rows = [("https://www.Example.org/news/1?x", "en"), ("src3", "de"), (None, None), ("h.net/", None)]
    got = [tuple(r) for r in spark.createDataFrame(rows, "s string, l string").select(host, path).collect()]
    assert got == [("example.org", "example.org/news"), ("src3", "src3/de"), ("", "/"), ("h.net", "h.net/")]


def test_features_do_not_depend_on_pieces(monkeypatch):
    text = "Word *** and more, words | here!! " * 60
    whole = quality.features(text)
    assert len(whole) == len(quality.FEATURES) and quality.features(None) == quality.features("")
    monkeypatch.setattr(quality, "PIECE", 64)
    parts = quality.features(text)
    assert parts == pytest.approx(whole)
    half = " ".join(f"w{i * i % 997}x{i}" for i in range(3000))  # longer than a piece, twice: every second pair is a repeat
    assert quality.features(half + " " + half)[10] == pytest.approx(0.5, abs=0.001)


def test_quality_of_edge_cases(spark):
    docs = edge_docs(spark)
    for labels in (edge_labels(spark, "quality"), edge_labels(spark, "quality").filter("quality = 1"), edge_labels(spark, "quality").limit(0)):
        rows = quality.score(docs, labels).collect()
        assert len(rows) == len(edge_rows()) and all(0 <= r.quality <= 1 and math.isfinite(r.quality) for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(edge_rows())  # without labels all share 0.5
    assert quality.score(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_quality_scores_carry_no_subqueries(spark):
    """The rates are written: plans that read the scores do not plan their subqueries again."""
    scores = quality.score(edge_docs(spark), edge_labels(spark, "quality"))
    assert "scalar-subquery" not in scores._jdf.queryExecution().analyzed().toString()


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    """Labels of the larger table: a few of its toxic documents have lost their wording and cannot be told."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 0
    learn, test = labels.filter(~fold), labels.filter(fold)
    got = toxicity.score(docs, learn).join(test.select("doc_id", F.col("toxic").alias("truth")), "doc_id").collect()
    bad, clean = [r for r in got if r.truth == 1], [r for r in got if r.truth == 0]
    assert sum(r.toxic for r in bad) >= 0.9 * len(bad) and not any(r.toxic for r in clean)
    assert all(0 <= r.severity <= 3 and r.grade in (0, 1, 2, 3) for r in got)
    assert np.mean([r.severity for r in bad]) > 1 > 0.2 > np.mean([r.severity for r in clean])


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.poisson(1.0, (3000, 3)).astype(float)
    z = x @ np.array([1.5, 0.0, -1.0]) + rng.logistic(size=3000)
    grade = np.searchsorted([0.5, 2.0, 3.5], z)
    w, t = toxicity.fit([(list(range(3)), list(row)) for row in x], grade, 3)
    assert w == pytest.approx([1.5, 0.0, -1.0], abs=0.25) and t == pytest.approx([0.5, 2.0, 3.5], abs=0.3)
    assert toxicity.grades_of(np.array([0.0, 1, 2, 3, 9, 9]), np.array([False, True, True, True, True, True])).tolist() == [0, 1, 1, 2, 3, 3]
    assert list(np.diff(t) > 0) == [True, True]


def test_toxicity_of_edge_cases(spark):
    docs = edge_docs(spark)
    labels = edge_labels(spark, "toxic", [(4, 0)])
    rows = toxicity.score(docs, labels, support=1).collect()
    assert len(rows) == len(edge_rows()) and all(math.isfinite(r.severity) for r in rows)
    none = toxicity.score(docs, labels.filter("toxic = 0")).collect()
    assert all(r.severity is None and r.toxic is False for r in none) and len(none) == len(edge_rows())
    assert toxicity.score(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_words_do_not_depend_on_pieces(monkeypatch):
    text = "Ein pathetic Wort, und noch eins: idiot! " * 40
    whole = toxicity.word_counts(text)
    monkeypatch.setattr(toxicity, "PIECE", 50)
    assert toxicity.word_counts(text) == whole and whole["idiot"] == 40


def test_languages_on_held_out_documents(given):
    docs = given[0]
    langs, logs = language_id.train(docs.filter(~language_id.held_out()))
    assert langs == ["de", "en", "es", "fr"]
    got = language_id.identify(docs, langs, logs).join(docs.filter(language_id.held_out()).select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got) and len(got) > 100
    assert all(0 <= r.score <= 1 for r in got)


def test_a_text_in_two_languages(given, spark):
    docs = given[0]
    langs, logs = language_id.train(docs)
    one = {r.lang: r.text for r in docs.filter("n_chars BETWEEN 1500 AND 2500").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    mixed = spark.createDataFrame([(1, one["en"] + " " + one["fr"] + " " + one["fr"]), (2, one["de"])], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(mixed, langs, logs).collect()}
    assert set(got[1].langs) == {"en", "fr"} and got[1].lang_pred == "fr" and sum(got[1].shares) == pytest.approx(1)
    assert got[2].langs == ["de"] and got[2].score > 0.99


def test_mixture_proportions():
    likely = np.array([[0.7, 0.1], [0.2, 0.2], [0.1, 0.7]])
    share, value = language_id.proportions(likely @ np.array([0.25, 0.75]) * 1000, likely, rounds=300)
    assert share == pytest.approx([0.25, 0.75], abs=1e-3) and value < 0


def test_languages_of_edge_cases(spark):
    docs = edge_docs(spark)
    langs, logs = language_id.train(docs)
    rows = language_id.identify(docs, langs, logs).collect()
    assert langs == ["de", "en", "fr"][3 - len(langs):] or set(langs) <= {"de", "en", "fr"}
    letterless = {3, 4, 5, 10}
    assert len(rows) == len(edge_rows()) and all((r.lang_pred == "und") == (r.doc_id in letterless) for r in rows if r.doc_id)
    none = spark.createDataFrame([], SCHEMA)
    assert language_id.train(none)[0] == [] and language_id.identify(none, *language_id.train(none)).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, *language_id.train(none)).collect()} == {"und"}
    with pytest.raises(Exception, match="more than 1 languages"):
        language_id.train(docs, max_languages=1)


def strength_by_hand(sites):
    """sites: (n, good, parent's rate) each; pseudo-documents of the parent by the method of moments."""
    total = sum(n for n, _, _ in sites)
    between = sum(n * (g / n - p) ** 2 for n, g, p in sites) / total
    noise = sum(p * (1 - p) for _, _, p in sites) / total
    level = sum(n * p * (1 - p) for n, _, p in sites) / total
    return max(1.0, min(1e4, level / max(between - noise, level * 1e-4) - 1))


def test_quality_posteriors_by_hand(spark):
    """The whole query, from each document's own evidence up to the decision."""
    import __spark_entry__ as contract

    rows = contract.queries()["op1_quality_classifier"](spark, "/root/testdata/sf0.001").collect()
    paths, hosts = {}, {}
    for r in rows:
        for table, key in ((paths, (r.host, r.path)), (hosts, r.host)):
            n, good = table.get(key, (0, 0.0))
            table[key] = (n + 1, good + r.own)
    overall = sum(r.own for r in rows) / len(rows)
    s = strength_by_hand([(n, g, overall) for n, g in hosts.values()])
    host_rate = {h: (g + s * overall) / (n + s) for h, (n, g) in hosts.items()}
    s = strength_by_hand([(n, g, host_rate[h]) for (h, _), (n, g) in paths.items()])
    path_rate = {k: (g + s * host_rate[k[0]]) / (n + s) for k, (n, g) in paths.items()}
    logit = lambda p: math.log(max(p, 1e-6) / max(1 - p, 1e-6))
    assert len(rows) == 200 and len(hosts) > 5
    for r in rows:
        assert r.host_rate == pytest.approx(host_rate[r.host]) and r.path_rate == pytest.approx(path_rate[r.host, r.path])
        z = logit(r.own) + logit(r.path_rate) - logit(overall)
        assert r.quality == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9) and r.keep == (r.quality >= 0.5)
