"""The pipeline stage by stage, and the registered corpus queries, against brute force."""

import glob
import os

import duckdb
import numpy as np
import pytest
from corpus import SCHEMA, edge_rows
from test_corpus_layout import check_mix, check_pack, nearest
from test_dedup import expected_near, expected_removed, squeezed
from test_similar import expected_rows

import __spark_entry__ as contract
import corpus_pipeline
from stockpulse.llm import mixing, quality
from stockpulse.session import stage

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    """The documents before and after each stage."""
    docs = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for _, step in corpus_pipeline.STAGES:
        docs.append(stage(step(spark, docs[-1], DATA), "test-stage"))
    return docs


def test_stages_and_columns(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "SimHash near-dedup", "mixing sources", "best-fit packing"]
    assert all(d.columns == staged[0].columns for d in staged[:-1])


def test_quality_stage(spark, staged):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    keep = {r.doc_id for r in quality.score(staged[0], labels).collect() if r.keep}
    assert {r.doc_id for r in staged[1].collect()} == keep
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(i in keep for i, q in truth.items() if q == 1) >= 0.97 * sum(truth.values())


def test_exact_stage(staged):
    best = {}
    for r in staged[1].collect():
        key = squeezed(r.text)
        if key not in best or (-len(r.text), r.doc_id) < (-len(best[key].text), best[key].doc_id):
            best[key] = r
    assert sorted(r.doc_id for r in staged[2].collect()) == sorted(r.doc_id for r in best.values())


def test_near_stage(staged):
    groups = expected_rows([tuple(r)[:2] for r in staged[2].collect()])  # five words, Jaccard 0.8 or more
    assert sorted(r.doc_id for r in staged[3].collect()) == sorted(g[0] for g in groups)


def test_mix_stage(staged):
    rows = mixing.mix(staged[3]).collect()
    check_mix(rows, staged[3].collect())
    want = sorted(r.doc_id for r in rows for _ in range(r.copies))
    assert sorted(r.doc_id for r in staged[4].collect()) == want


def test_pack_stage(spark, staged):
    rows = staged[5].collect()
    texts, seen = {}, set()
    for r in staged[4].collect():
        texts[r.doc_id] = r.text
    assert {r.doc_id for r in rows} == set(texts)
    assert max(r.offset + r.length for r in rows) <= 1024
    full = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.1 * full / 1024 + 1
    for r in rows:
        assert (r.sequence_id, r.offset) not in seen
        seen.add((r.sequence_id, r.offset))
    once = spark.createDataFrame([(i, t, None, None, None) for i, t in texts.items()], SCHEMA)
    check_pack(corpus_pipeline.pack(spark, once, DATA).collect(), texts, 1024)


def test_run_and_empty_input(spark, staged, tmp_path):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(key, staged[5].collect()))
    for rows, name in (([], "none"), (edge_rows(), "edges")):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert (corpus_pipeline.run(spark, folder).count() > 0) == bool(rows)


def test_every_operator_is_registered():
    names = contract.queries()
    assert [n for i in range(1, 14) for n in names if n.startswith(f"op{i}_")].__len__() == 13 and "pipeline" in names


@pytest.mark.parametrize("name", ["op9_exact_dedup", "op11_jaccard_join", "op12_filter_audit", "op13_merkle_manifest"])
def test_statements(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = contract.queries()[name](spark, DATA)
    result = con.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, result.fetchall()))


def test_query_results(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    q = contract.queries()
    got = q["op3_suffix_dedup"](spark, DATA).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=repr) == expected_removed(docs)
    got = q["op2_simhash_near_dedup"](spark, DATA).collect()
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=repr) == expected_near(docs)
    rows = [r for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want, found = nearest(ids, x, 20), {}
    for r in q["op5_nearest_neighbours"](spark, DATA).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    assert sum(len(found[k] & {v for v, _ in want[k]}) for k in want) >= 0.9 * 20 * len(want)
    for name, columns in (("op1_quality_classifier", {"doc_id", "quality", "keep"}), ("op4_shard", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
                          ("op6_mix_sources", {"doc_id", "size", "source_size", "target", "taken"}), ("op8_toxicity", {"doc_id", "severity", "toxic"}),
                          ("op10_language_id", {"doc_id", "held_out", "lang_pred", "score"})):
        df = q[name](spark, DATA)
        assert columns <= set(df.columns) and df.count() == len(docs)
    assert q["op7_best_two_fit"](spark, DATA).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
