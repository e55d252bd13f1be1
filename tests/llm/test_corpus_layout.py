"""Mixing, packing, sharding and neighbour search against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import SCHEMA, edge_docs, edge_rows, many, words

from stockpulse.llm import mixing, neighbours, packing, sharding


def reshared(sizes, share=1.5, cap=2.0, weights=(3, 1, 2)):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in capped]
        level = left / max(sum(weight[s] for s in open_), 1)
        over = [s for s in open_ if weight[s] * level > cap * sizes[s] + 1e-9]
        if not over:
            return {**capped, **{s: weight[s] * level for s in open_}}
        for s in over:
            capped[s] = cap * sizes[s]
            left -= capped[s]


def check_mix(rows, texts):
    size, target, taken, biggest, shards = Counter(), {}, Counter(), Counter(), Counter()
    assert len(rows) == len(texts)
    for r in rows:
        size[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.size * r.copies
        biggest[r.source] = max(biggest[r.source], r.size)
        assert 0 <= r.copies <= 2 and len(r.shards) == r.copies
        shards.update(r.shards)
    for r in rows:
        assert r.source_size == size[r.source]
    want = reshared(size)
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1
    return shards


def test_mix_meets_its_targets(spark):
    docs = many(spark, 600)
    rows = mixing.mix(docs, blocks=64).collect()
    shards = check_mix(rows, docs.collect())
    assert set(shards) == set(range(8))
    again = mixing.mix(docs.repartition(3), blocks=64).collect()
    key = lambda r: (r.doc_id, r.size, r.copies, r.shards)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_of_edge_cases(spark):
    docs = edge_docs(spark)
    check_mix(mixing.mix(docs).collect(), edge_rows())
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and {r["block"] for r in out.select("block").collect()} == {"user block"}
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(none).count() == mixing.mix_documents(none).count() == 0


def test_quota_tree_is_exact(spark):
    rng = random.Random(1)
    quotas = [rng.choice((0, 1, 7, 300)) for _ in range(11)]
    got = {r["index"]: r.taken for r in mixing.split_quotas(spark.createDataFrame(list(enumerate(quotas)), "index long, quota long"), 8, 5).collect()}
    assert [sum(got[i]) for i in range(11)] == quotas
    columns = [sum(got[i][j] for i in range(11)) for j in range(8)]
    assert max(columns) - min(columns) <= 1


def test_quota_tree_plans_do_not_grow_with_the_shards(spark, monkeypatch):
    """The driver compiles each level's plan: one expression stands for all shards."""
    lines, write = [], mixing.stage
    monkeypatch.setattr(mixing, "stage", lambda df, label: lines.append(len(df._jdf.queryExecution().analyzed().toString().splitlines())) or write(df, label))
    quotas = spark.createDataFrame([(0, 5), (1, 9)], "index long, quota long")
    for shards in (2, 16):
        mixing.split_quotas(quotas, shards, 5).collect()
    assert len(lines) == 2 and lines[0] == lines[1]


def test_draws_follow_the_distribution(spark):
    from math import comb

    df = spark.range(4000).selectExpr("(id + 0.5D) / 4000 AS u", "12L AS good", "20L AS bad", "9L AS n")
    seen = Counter(r.d for r in mixing.draw(df, "d", "u", "good", "bad", "n").collect())
    for k in range(10):
        assert seen[k] / 4000 == pytest.approx(comb(12, k) * comb(20, 9 - k) / comb(32, 9), abs=6e-4)


def hf_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def check_pack(rows, texts, capacity):
    """``texts`` by doc_id; returns the number of sequences."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for (doc, text), ids in zip(texts.items(), hf_ids(texts.values())):
        at = 0
        for i, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
            assert r.length == capacity or i == 0
        assert at == len(ids) and (len(ids) > capacity or len(by_doc[doc]) == 1)
    for inside in by_sequence.values():
        at = 0
        for r in sorted(inside, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_pack_round_trip(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    texts = {r[0]: r[1] for r in rows} | {20: "a <|endoftext|> b", 21: "don't  stop\n\n now's", 22: "日本 語 текст 🙂"}
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], SCHEMA)
    check_pack(packing.pack(docs).collect(), texts, 1024)
    corpus = many(spark, 300)
    texts = {r.doc_id: r.text for r in corpus.collect()}
    out = packing.pack(corpus, capacity=256).collect()
    tokens = sum(r.length for r in out)
    assert check_pack(out, texts, 256) <= 1.05 * tokens / 256 + 1
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    assert packing.pack(edge_docs(spark)).count() >= len(edge_rows())


def test_texts_are_cut_where_tokens_end():
    import public_tokenizers

    encoder = packing._encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = words(random.Random(3), 500) + " é ß  two  spaces \n lines <|endoftext|> end 1 2 3"
    assert packing.token_ids(text, encoder, size=40).tolist() == packing.token_ids(text, encoder).tolist() == hf_ids([text])[0]


def test_best_two_fit_beats_first_fit_decreasing():
    sizes = [60, 50, 30, 21, 20, 19] * 3
    bins = packing.plan(Counter(sizes), 100)
    assert Counter(x for n, inside in bins for x in inside for _ in range(n)) == Counter(sizes)
    assert all(sum(inside) <= 100 for _, inside in bins) and sum(n for n, _ in bins) == -(-sum(sizes) // 100)
    assert packing.best_two(np.bincount([5, 5, 9, 30]), 14) == (9, 5)
    assert packing.best_two(np.bincount([5, 9, 30]), 11) == (0, 0)


def test_shards_are_exact_and_shuffled(spark):
    docs = many(spark, 1003)
    rows = sharding.shard(docs, local_rows=20).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert sorted(len(v) for v in by.values()) == [125] * 5 + [126] * 3
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    for inside in by.values():
        assert sorted(r.slot for r in inside) == list(range(len(inside)))
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r.law == "rows" for r in rows)
    order = [r.doc_id for r in sorted(by[0], key=lambda r: r.slot)]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.35
    edge = sharding.shard(edge_docs(spark)).collect()
    assert Counter(r.size for r in edge if r.doc_id in (3, 4)) == {1: 2}
    assert sorted(Counter(r.shard for r in edge).values()) == [1] * 2 + [2] * 6
    assert sharding.shard(spark.createDataFrame([], SCHEMA)).count() == 0


def test_communication_matrix():
    counts = [random.Random(2).randrange(1000) for _ in range(30)] + [0, 1]
    m = sharding.matrix(counts, 8, 4)
    assert [sum(row) for row in m] == counts
    columns = [sum(row[j] for row in m) for j in range(8)]
    assert max(columns) - min(columns) <= 1
    rng = random.Random(0)
    seen = np.array([sharding.hypergeometric(rng, 30, 50, 20) for _ in range(4000)])
    assert seen.mean() == pytest.approx(7.5, abs=0.1) and seen.var() == pytest.approx(20 * 30 * 50 * 60 / (80 * 80 * 79), rel=0.1)
    assert sharding.hypergeometric(rng, 10 ** 11, 10 ** 11, 10 ** 6) == pytest.approx(500_000, abs=5000)


def nearest(ids, x, every, k=20):
    want = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            s = x @ x[i]
            s[i] = -np.inf
            order = np.lexsort((ids, -s))[:min(k, len(ids) - 1)]
            want[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return want


def found_of(df):
    got = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    return got


def test_neighbours_recall(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 16)) * rng.uniform(0.3, 2, (1500, 1))
    x[700:1200] = x[5]  # a third of the rows are one vector
    ids = np.arange(1500)
    got = found_of(neighbours.search(spark.createDataFrame([(int(i), [float(c) for c in v], 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, label int"), cell=128))
    want = nearest(ids, x, 20)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q in want:
        assert all(s == pytest.approx(float(x[v] @ x[q]), abs=1e-12) for v, s in got[q])
    assert got[720] == [(v, pytest.approx(s)) for v, s in want[720]] or len(got[720]) == 20


def test_neighbours_of_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 0.0], "b"), (2, None, "c"), (20, [0.0, 0.0], "d"), (40, [nan, 1.0], "e"), (3, [inf, 1.0], "f"),
            (4, [None, 1.0], "g"), (5, [0.5, 0.5], "h"), (None, [1.0, 1.0], "i"), (6, [], "j"), (60, [-1.0, 2.0], None)]
    schema = "vec_id long, embedding array<double>, code string"
    got = found_of(neighbours.search(spark.createDataFrame(rows, schema)))
    assert got == {0: [(1, 1.0), (5, 0.5), (60, -1.0)], 60: [(5, 0.5), (0, -1.0), (1, -1.0)]}
    assert neighbours.search(spark.createDataFrame([], schema)).count() == 0
    assert neighbours.search(spark.createDataFrame(rows[:1], schema)).count() == 0


def opposite_to_a_cone():
    rng = np.random.default_rng(8)
    x = 5 * np.eye(16)[0] + rng.standard_normal((400, 16))
    x[::40] *= -1  # ten queries that point away from all the rest
    return x


@pytest.mark.parametrize("x,every", [(np.random.default_rng(7).standard_normal((12, 2)), 1), (np.random.default_rng(7).standard_normal((21, 64)), 1), (opposite_to_a_cone(), 40)])
def test_neighbours_of_small_tables_and_lone_queries_are_whole(spark, x, every):
    ids = np.arange(len(x))
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(ids, x)]
    got = found_of(neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=every))
    want = nearest(ids, x, every)
    assert {q: [v for v, _ in near] for q, near in got.items()} == {q: [v for v, _ in near] for q, near in want.items()}
