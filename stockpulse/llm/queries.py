"""Registered queries of the corpus operators and the statements that SQL can give for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_dedup, filter_audit, jaccard_join, language_id, manifest, mixing, neighbours, packing, quality, sharding, simhash_dedup,
               suffix_dedup, toxicity)
from .common import table

QUERIES, STATEMENTS = {}, {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "host", "path", "own", "host_rate", "path_rate", "quality", "keep")


@register
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@register
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register
def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@register
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", taken, "shards")


@register
def op7_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "severity", "grade", "p_toxic", "toxic")


@register
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, logs = language_id.train(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, langs, logs)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "langs")


@register
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@register
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


STATEMENTS["op9_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS norm
  FROM documents),
g AS (
  SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept
  FROM d)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
"""

#: White space taken out of a regular word, and ASCII letters in lower case, in DuckDB.
_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

STATEMENTS["op11_jaccard_join"] = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
often AS MATERIALIZED (SELECT r, shingle FROM s WHERE shingle IN (SELECT shingle FROM s GROUP BY shingle HAVING count(*) > 1)),
common AS MATERIALIZED (SELECT a.r AS a, b.r AS b, count(*) AS c FROM often a JOIN often b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(a, b) AS (SELECT r, r FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM w JOIN reach ON reach.a = w.r JOIN w o ON o.r = reach.b LEFT JOIN n ON n.r = w.r GROUP BY w.r, w.doc_id
"""

STATEMENTS["op12_filter_audit"] = f"""
WITH t AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
w AS MATERIALIZED (SELECT *, {_WORDS.format("text")} AS ws FROM t),
g AS MATERIALIZED (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS MATERIALIZED (
  SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
                100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(first < w.doc_id, false)] AS fails,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM w LEFT JOIN g ON g.doc_id = w.doc_id),
m AS MATERIALIZED (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS MATERIALIZED (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
r AS MATERIALIZED (
  SELECT part, filter_order, fails, n, good, toxic,
         list_min(list_transform(range(1, 6), lambda s: CASE WHEN fails[ascii(filter_order[s]) - 64] THEN s ELSE 6 END)) AS gone FROM m, o),
c AS MATERIALIZED (
  SELECT part, filter_order, step, filter_order[step] AS f, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
         sum(n) FILTER (gone < step AND fails[ascii(filter_order[step]) - 64]) AS redundant,
         sum(n) FILTER (fails[ascii(filter_order[step]) - 64] AND len(list_filter(fails, lambda x: x)) = 1) AS unique_fails,
         sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
  FROM r, (SELECT unnest(range(1, 6)) AS step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM c
"""


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


def _tree_sql(name: str, start: str, levels: int) -> str:
    """CTEs ``{name}0`` to ``{name}{levels}``: tree, rank, n, digest, place in the run of eight (at) and the run's digests."""
    out = []
    for k in range(levels + 1):
        below = start if k == 0 else (f"SELECT tree, rank // 8 AS rank, (n + 7) // 8 AS n, any_value(CASE WHEN n = 1 THEN digest ELSE sha256(array_to_string(run, '')) END) AS digest "
                                      f"FROM {name}{k - 1} GROUP BY tree, rank // 8, (n + 7) // 8")
        out.append(f"{name}{k} AS MATERIALIZED (SELECT tree, rank, n, digest, rank % 8 + 1 AS at, list(digest ORDER BY rank) OVER (PARTITION BY tree, rank // 8 "
                   f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM ({below}))")
    return ",\n".join(out)


def _manifest_sql(levels: int = 7, tops: int = 3) -> str:
    """Trees of up to 8**levels leaves a language and 8**tops languages."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: "
           "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)")
    ways = [(f"x{k}", f"x{k}.tree = p.tree AND x{k}.rank = p.rank // {8 ** k}") for k in range(levels)] + [(f"y{k}", f"y{k}.rank = p.tree // {8 ** k}") for k in range(tops)]
    lists = [f"CASE WHEN {w}.n = 1 THEN [] ELSE {w}.run[:{w}.at - 1] END AS l{i}, CASE WHEN {w}.n = 1 THEN [] ELSE {w}.run[{w}.at + 1:] END AS r{i}, {w}.n = 1 AS top{i}" for i, (w, _) in enumerate(ways)]
    folds = [f"f{i + 1} AS (SELECT *, CASE WHEN top{i} THEN v{i} ELSE sha256(array_to_string(list_concat(l{i}, [v{i}], r{i}), '')) END AS v{i + 1} FROM f{i})" for i in range(len(ways))]
    siblings = " || ".join(f"array_to_string(l{i}, '') || array_to_string(r{i}, '')" for i in range(len(ways)))
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT lang, doc_id, {_leaf_sql("text")} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {_leaf_sql(_LOWER.format("text"))} END AS tampered FROM documents),
p AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves),
{_tree_sql("x", "SELECT tree, rank, n, leaf AS digest FROM p", levels)},
{_tree_sql("y", f"SELECT 0 AS tree, tree AS rank, count(*) OVER () AS n, digest FROM x{levels}", tops)},
f0 AS (
  SELECT p.doc_id, p.leaf, z.digest AS subroot, (SELECT digest FROM y{tops}) AS root, coalesce(p.tampered, p.leaf) AS v0, {", ".join(lists)}
  FROM p JOIN x{levels} z ON z.tree = p.tree {" ".join(f"JOIN {w} ON {c}" for w, c in ways)}),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, sha256({siblings}) AS proof_sha256, v{len(ways)} AS folded_root, v{len(ways)} = root AS verified FROM f{len(ways)}
"""


STATEMENTS["op13_merkle_manifest"] = _manifest_sql()
