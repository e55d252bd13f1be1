"""N-gram Jaccard join, filter audit and Merkle manifest against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import permutations

import pytest
from corpus import SCHEMA, edge_docs, edge_labels, edge_rows, many, words
from pyspark.sql import functions as F

from stockpulse.llm import filter_audit, jaccard_join, manifest
from stockpulse.llm.common import numbered
from stockpulse.session import stage

LABELS = "doc_id long, quality int, toxic int"


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)} or ({b" ".join(w)} if w else set())


def expected_join(rows):
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in held[x] if j < i}:
            if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted([(r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)], key=repr)


def joined(docs, **options):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join_groups(docs, **options).collect()], key=repr)


def near_copies(spark, n=160, seed=11):
    """A hub with near copies at many distances, a chain of texts each close to the next only, exact copies, hot passages."""
    rng = random.Random(seed)
    base = words(rng, 150).split()
    hot = words(rng, 60)
    rows = []
    for i in range(n):
        kind, own = i % 4, list(base)
        if kind < 2:
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = f"edit{rng.randint(0, 30)}"
        elif kind == 2:
            own = words(rng, rng.randint(20, 60)).split() + hot.split()
        rows.append((i, " ".join(own), "en", "s0", 1))
    chain = words(rng, 300).split()
    rows += [(1000 + i, " ".join(chain[8 * i:8 * i + 120]), "en", "s1", 1) for i in range(20)]
    rows += [(2000 + i, rows[2][1], "en", "s1", 1) for i in range(40)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("make", [edge_docs, many, near_copies])
def test_join_equals_brute_force(spark, make):
    docs = make(spark)
    want = expected_join([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert joined(docs) == want
    assert len({c for _, _, c in want}) < len(want)


def test_join_rounds_and_batches_make_no_difference(spark, monkeypatch):
    docs = near_copies(spark, 80, 5)
    want = expected_join([(r.doc_id, r.text) for r in docs.collect()])
    assert joined(docs, rounds=1) == want and joined(docs, rounds=4) == want
    monkeypatch.setattr(jaccard_join, "BATCH", 50)
    assert joined(docs) == want


def test_join_of_nothing(spark):
    assert joined(spark.createDataFrame([], SCHEMA)) == []
    assert joined(spark.createDataFrame([(5, None, None, None, None), (None, " ", None, None, None)], SCHEMA)) == [(5, 0, 5), (None, 0, None)]


def test_no_pair_is_lost_by_the_lists(spark):
    """Each similar pair is in a common list, at places that leave room for its overlap."""
    docs = near_copies(spark, 80, 9).dropDuplicates(["text"])
    docs = numbered(docs)
    sets = stage(jaccard_join.fragment_sets(docs, "doc_id", "text"), "test-sets")
    heads = sets.select(F.col("_row").alias("node"), "size")
    alive, parts = jaccard_join.open_nodes(docs, sets, heads, "doc_id", "text")
    lists = jaccard_join.prefix_lists(parts, alive)
    met = lists.alias("x").join(lists.alias("y"), "shingle").filter("x.node < y.node").filter(jaccard_join._could_match("x", "y"))
    pairs = {(r[0], r[1]) for r in met.select("x.node", "y.node").distinct().collect()}
    own = {r["_row"]: {x for c in jaccard_join.COLUMNS for x in r[c]} for r in sets.collect()}
    want = {(a, b) for a in own for b in own if a < b and 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b])}
    assert want and want <= pairs


# filter audit

def failures(text, copy):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": copy}


def expected_audit(rows, labels):
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[i] == 1} for i in (1, 2))
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(r[0], least.get(r[1] or "", r[0]))
    parts = defaultdict(list)
    for r in rows:
        copy = r[0] is not None and least[r[1] or ""] < r[0]
        parts[r[3] or ""].append((failures(r[1] or "", copy), r[0] in good, r[0] in toxic))
    out, share = {}, defaultdict(int)
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                redundant = sum(d[0][f] and any(d[0][e] for e in order[:step - 1]) for d in docs)
                only = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, only, sum(d[1] for d in gone), sum(d[2] for d in gone)]
                share[part, f] += len(gone)
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_removal_steps_are_the_first_failing_places():
    orders, steps = filter_audit.removal_steps()
    assert len(orders) == 120 and steps.shape == (32, 120)
    for mask in range(32):
        for j, o in enumerate(orders):
            assert steps[mask, j] == next((s for s, c in enumerate(o, 1) if mask >> "ABCDE".index(c) & 1), 6)


def audit_docs(spark):
    rng = random.Random(2)
    rows = [tuple(r) for r in edge_rows()]
    for i in range(100, 170):
        text = words(rng, rng.choice((20, 230, 240))) + rng.choice(("", " #", " ABCDEFGHIJKLMNOPQRST" * 4, " same" * 500))
        rows.append((i, rng.choice([text, rows[-1][1]]), "en", rng.choice(("s1", "s2", None, "")), 1))
    return rows, spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("user") for c in ("mask", "part", "digest", "good", "n", "first")})


def test_audit_equals_running_the_filters(spark):
    rows, docs = audit_docs(spark)
    labels = [(1, 1, 0), (2, 0, 1), (9, 1, 1), (9, 0, 0), (None, 1, 1), (10, None, None), (77, 1, 1)] + [(i, i % 2, i % 3 == 0) for i in range(100, 170)]
    labels = [(a, b, int(c) if c is not None else None) for a, b, c in labels]
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()
    want = expected_audit(rows, labels)
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == want
    assert len(got) == len(want) == 600 * len({r[3] or "" for r in rows})


def test_audit_of_nothing(spark):
    labels = edge_labels(spark, "quality").withColumn("toxic", F.lit(None).cast("int"))
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), labels).count() == 0
    assert filter_audit.audit(edge_docs(spark), spark.createDataFrame([], LABELS)).agg(F.sum("good_lost")).first()[0] == 0


# manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    fields = [row[0], row[3], row[2], row[4], row[1]]
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(digests):
    """(root, for each node its proof from the bottom: (place, siblings) a level)."""
    proofs, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, joined = [], []
        for s in range(0, len(digests), 8):
            run = digests[s:s + 8]
            for i in range(len(run)):
                for leaf in groups[s + i]:
                    proofs[leaf].append((i, run[:i] + run[i + 1:]))
            above.append(sha(*run))
            joined.append([x for g in groups[s:s + 8] for x in g])
        digests, groups = above, joined
    return digests[0], proofs


def expected_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = climb([leaf_of(r) for r in by[lang]])
    root, tops = climb([trees[v][0] for v in langs])
    out = []
    for v, top in zip(langs, tops):
        for r, proof in zip(by[v], trees[v][1]):
            way = proof + top
            altered = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                altered = (r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            acc = leaf_of(altered)
            for i, siblings in way:
                acc = sha(*siblings[:i], acc, *siblings[i:])
            out.append((r[0], leaf_of(r), trees[v][0], root, sha(*(s for _, siblings in way for s in siblings)), acc, acc == root))
    return sorted(out, key=repr)


def manifest_rows():
    rng = random.Random(4)
    rows = [tuple(r) for r in edge_rows()]
    rows += [(i, words(rng, 6) + rng.choice(("", " Upper", " Ä")), rng.choice(("en", "en", "de", "fr", "é", None)), f"s{i % 3}", i) for i in range(100, 330)]
    return rows + [(400, "only", lang, None, None) for lang in ("xa", "xb", "xc", "xd", "xe")]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 65, 400])
def test_manifest_equals_plain_trees(spark, n):
    rows = manifest_rows()[-n:] if n else []
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("user") for c in ("rank", "tree", "leaf", "digest", "_place")})
    got = manifest.verified(docs).collect()
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    want = expected_manifest(rows) if rows else []
    assert sorted([tuple(r[c] for c in columns) for r in got], key=repr) == want
    assert n < 65 or 0 < sum(r.verified for r in got) < len(got)


def test_manifest_descends_to_wanted_leaves_only(spark):
    rows = manifest_rows()
    m = manifest.Manifest(spark.createDataFrame(rows, SCHEMA))
    every = {(r.tree, r.rank): r for r in m.proofs().collect()}
    wanted = [(0, 0), (2, 17), (2, 64), max(every)]
    got = m.proofs(spark.createDataFrame(wanted, "tree long, rank long")).collect()
    assert sorted((r.tree, r.rank) for r in got) == sorted(wanted)
    assert all(r == every[r.tree, r.rank] for r in got)


def test_ranks_do_not_depend_on_the_partitions(spark):
    rows = [(i % 7, "x" if i < 300 else f"g{i % 5}") for i in range(900)]
    for parts in (1, 6):
        got = manifest.ranked(spark.createDataFrame(rows, "v long, g string").repartition(parts), "g", ["v"]).collect()
        by = defaultdict(list)
        for r in got:
            by[r.g].append((r.rank, r.v, r.n))
        for g, found in by.items():
            found.sort()
            assert [x for x, _, _ in found] == list(range(len(found))) and {n for _, _, n in found} == {len(found)}
            assert [v for _, v, _ in found] == sorted(v for _, v, _ in found)
