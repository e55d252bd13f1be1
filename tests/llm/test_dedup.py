"""Exact, near and passage duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpus import SCHEMA, edge_docs, edge_rows, many, words

from stockpulse.llm import exact_dedup, simhash_dedup, suffix_dedup
from stockpulse.llm.components import components


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[squeezed(r[1])].append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0]))
        out += [(r[0], best[0], len(members), hashlib.sha256(norm.encode()).hexdigest()) for r in members]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("bits,capacity", [(64, 1_000_000), (3, 2)])
def test_exact_groups(spark, bits, capacity):
    docs = edge_docs(spark)
    rows = exact_dedup.exact_groups(docs, hash_bits=bits, capacity=capacity).collect()  # 3 bits: chained collisions, a deep directory
    want, groups = expected_exact(edge_rows())
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=repr) == want
    assert sum(r.kept for r in rows) == groups
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert {r["_row"] for r in kept.select("_row").collect()} == {"user _row"}


def test_directory_splits_only_full_buckets(spark):
    keys = spark.createDataFrame([(i << 60,) for i in range(8)] * 1 + [((i << 52),) for i in range(40)], "key long")
    depth = exact_dedup.depth_for(keys.count(), 10) + 8
    slots = exact_dedup.directory(keys, 10, depth).collect()
    sizes = Counter()
    of = {r.slot: (r.depth, r.bucket) for r in slots}
    for r in keys.collect():
        sizes[of[(r.key % (1 << 64)) >> (64 - depth)]] += 1
    assert max(sizes.values()) <= 10
    assert all(bucket == slot >> (depth - d) for slot, (d, bucket) in of.items())
    assert len({d for d, _ in of.values()}) > 1


def simhash_by_hand(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    ones = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def expected_near(rows):
    fps = [simhash_by_hand(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted([(r[0], f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(rows)], key=repr)


def near_rows(docs):
    return sorted([(r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup.near_groups(docs).collect()], key=repr)


def test_near_groups(spark):
    assert near_rows(edge_docs(spark)) == expected_near(edge_rows())
    docs = many(spark)
    rows = [tuple(r)[:2] for r in docs.collect()]
    assert near_rows(docs) == expected_near(rows)
    kept = simhash_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in expected_near(rows)})


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = words(random.Random(1), 3000) + " \n end"
    whole = simhash_dedup.fingerprint(text)
    monkeypatch.setattr(simhash_dedup, "PIECE", 50)
    assert simhash_dedup.fingerprint(text) == whole == simhash_by_hand(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_slices_find_every_pair(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    for i in range(100):
        fps[i + 50] = fps[i % 50] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 6)).astype(np.uint64))
    fps = np.unique(fps)
    group = rng.integers(0, 2, len(fps))
    close = (np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius) & (group[:, None] == group[None, :])
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        label = np.array([label[c].min() for c in close])
    root = {int(a): int(b) for a, b in simhash_dedup._stars(fps, group, radius)}
    signed = fps.view(np.int64)
    for k in np.unique(label):
        members = signed[label == k]
        assert {root.get(int(m), int(m)) for m in members} == {int(members.min())}


def test_hot_blocks_are_cut_into_chunks(spark):
    rng = random.Random(2)
    base = rng.getrandbits(40)
    fps = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = components(simhash_dedup.near_links(df, chunk=16)).collect()
    parent = {f: f for f in fps}
    for a in fps:  # smallest signed value reached
        todo, seen = [a], {a}
        while todo:
            x = todo.pop()
            new = [b for b in fps - seen if (x ^ b).bit_count() <= 3]
            seen |= set(new)
            todo += new
        parent[a] = min(s - (1 << 64) if s >> 63 else s for s in seen)
    got = {r.node % (1 << 64): r.root for r in found}
    assert all(got.get(f, f - (1 << 64) if f >> 63 else f) == parent[f] for f in fps)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 60)}}


def expected_removed(rows, length=400):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(t[p:p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for doc, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), sum(1 for run in bytes(gone).split(b"\0") if run), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(docs):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()], key=repr)


def test_repeats_of_edge_cases(spark):
    rows = [r if len(r[1] or "") < 30_000 else (r[0], r[1][:6000] + r[1][-2:], *r[2:]) for r in edge_rows()]
    assert removed(spark.createDataFrame(rows, SCHEMA)) == expected_removed(rows)


def test_repeats_of_many_documents(spark):
    docs = many(spark, 200)
    want = expected_removed([tuple(r) for r in docs.collect()])
    assert removed(docs) == want and any(r[3] > 0 for r in want)


def test_repeats_whose_ends_differ(spark):
    """Matches that end a few bytes apart, overlap, and shift by one: the hard cases for sampled suffixes."""
    rng = random.Random(9)
    text = "".join(rng.choice("acgt") for _ in range(3000))
    rows = []
    for i in range(40):
        a = rng.randrange(2000)
        n = 380 + rng.randrange(80) if i % 2 else rng.randrange(400, 1000)
        rows.append((i, "".join(rng.choice("xyz") for _ in range(rng.randrange(90))) + text[a:a + n] + "".join(rng.choice("xyz") for _ in range(rng.randrange(90))), None, None, None))
    rows.append((99, "ab" * 450 + "c" + "ab" * 300, None, None, None))
    assert removed(spark.createDataFrame(rows, SCHEMA)) == expected_removed(rows)


def test_anchors_cover_each_window_once(monkeypatch):
    data = np.frombuffer(words(random.Random(4), 900).encode() + b"a" * 900, np.uint8)
    at, first, last = suffix_dedup.anchors(data, suffix_dedup.Hashes(data))
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert (starts == np.arange(len(data) - 399)).all()
    assert ((at - last >= 0) & (at - first < suffix_dedup.SPAN)).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_groups(none).count() == exact_dedup.drop_copies(none).count() == 0
    assert simhash_dedup.near_groups(none).count() == suffix_dedup.remove_repeats(none).count() == 0


@pytest.fixture
def moving_partitions(spark, monkeypatch):
    """Every written step is followed by another number of partitions of a scan, as on a cluster that grows or shrinks."""
    from stockpulse import session
    from stockpulse.llm import common, components, jaccard_dedup, jaccard_join, mixing, quality

    sizes, key = iter(range(10_000)), "spark.sql.leafNodeDefaultParallelism"

    def moving(df, label):
        out = session.stage(df, label)
        spark.conf.set(key, str(1 + 3 * next(sizes) % 7))
        return out

    for module in (common, components, exact_dedup, jaccard_dedup, jaccard_join, mixing, quality, simhash_dedup, suffix_dedup):
        monkeypatch.setattr(module, "stage", moving)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.openCostInBytes",)}
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    yield
    spark.conf.unset(key)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_results_hold_while_the_partitions_of_scans_change(spark, moving_partitions, tmp_path):
    from test_similar import expected_rows

    from stockpulse.llm import jaccard_dedup, mixing

    many(spark, 300).repartition(12).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    rows = sorted(tuple(r)[:2] for r in docs.collect())
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=repr) == expected_removed(rows)
    assert sorted(r.doc_id for r in jaccard_dedup.drop_similar(docs).collect()) == sorted(g[0] for g in expected_rows(rows))
    best = {}
    for i, text in rows:
        best[squeezed(text)] = min(best.get(squeezed(text), (0, i)), (-len(text), i))
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == sorted(i for _, i in best.values())
    fixed = [sorted(r.doc_id for r in mixing.mix_documents(docs).collect()) for _ in range(2)]
    assert fixed[0] == fixed[1]
    texts = dict(rows)
    assert all(texts[r.doc_id] == r.text for r in mixing.mix_documents(docs).collect())
