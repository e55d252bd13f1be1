"""Product search by trigram similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import _c


def trigrams(text) -> Column:
    """Distinct trigrams of the lower-cased words, each padded with two blanks before and one after."""
    words = F.regexp_extract_all(F.lower(_c(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))

    def grams(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, F.lit(3)))

    return F.array_distinct(F.flatten(F.transform(words, grams)))


def similarity(a: Column, b: Column) -> Column:
    """Shared over all distinct trigrams, 0 when neither side has any."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(shared.cast("double") / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0)), F.lit(0.0))


def fuzzy_product_search(products: DataFrame, query: str, k: int = 10, min_similarity: float = 0.0) -> DataFrame:
    """Top ``k`` products by name similarity: one expression per row and a distributed top-k."""
    score = similarity(trigrams("product_name"), trigrams(F.lit(query)))
    return (products.select("sku_id", "product_name", score.alias("similarity"))
            .filter(F.col("similarity") > min_similarity)
            .orderBy(F.desc("similarity"), "product_name", "sku_id").limit(k))


def similar_names(products: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Pairs of different product names with a similarity of at least ``threshold``, each under its smallest sku_id.

    Two sets that similar share one of their rarest trigrams: of n in a fixed rare-first order, one of the
    first n - ceil(threshold * n) + 1. Only those are joined, by equality, and candidates are compared
    exactly. Frequent trigrams stand last and are hardly ever joined on.
    """
    names = products.filter("product_name IS NOT NULL").groupBy("product_name").agg(F.min("sku_id").alias("sku_id"))
    sets = names.select("sku_id", "product_name", trigrams("product_name").alias("grams")).filter(F.size("grams") > 0)
    grams = sets.select("sku_id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    rarity = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("uses"))
    order = F.row_number().over(Window.partitionBy("sku_id").orderBy("uses", "gram"))
    first = grams.join(rarity, "gram").withColumn("at", order).filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    a = first.select("gram", F.col("sku_id").alias("sku_a"), F.col("n").alias("n_a"))
    b = first.select("gram", F.col("sku_id").alias("sku_b"), F.col("n").alias("n_b"))
    sized = (F.col("n_b") >= F.col("n_a") * threshold - 1e-9) & (F.col("n_a") >= F.col("n_b") * threshold - 1e-9)
    pairs = a.join(b, "gram").filter((F.col("sku_a") < F.col("sku_b")) & sized).select("sku_a", "sku_b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("sku_id").alias(f"sku_{side}"), F.col("grams").alias(f"grams_{side}")), f"sku_{side}")
    score = similarity(F.col("grams_a"), F.col("grams_b"))
    return pairs.select("sku_a", "sku_b", score.alias("similarity")).filter(F.col("similarity") >= threshold - 1e-9)
