"""Readers: Parquet/CSV with a declared schema, JDBC with partition bounds, series history, seed rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import optional_equals, trailing


def read_parquet(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    reader = spark.read.schema(schemas.TABLES[table]) if table else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Header CSV with the table's declared schema: no inference pass over the data."""
    return spark.read.schema(schemas.TABLES[table]).option("header", True).option("enforceSchema", False).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, column: str | None = None, lower=None, upper=None,
              partitions: int = 1, **properties) -> DataFrame:
    """JDBC scan split into ``partitions`` range queries on ``column``; filters and columns are pushed down."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if column is not None:
        reader = (reader.option("partitionColumn", column).option("lowerBound", str(lower))
                  .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    elif partitions > 1:
        raise ValueError("a partition column is needed to split a JDBC scan")
    return reader.load()


def read_table(spark: SparkSession, name: str, source: dict) -> DataFrame:
    """Read a retail table from ``{"format": "parquet"|"csv"|"jdbc"|"catalog", ...}``."""
    kind = source.get("format", "parquet")
    if kind == "parquet":
        return read_parquet(spark, f"{source['path']}/{name}", name if source.get("declared", True) else None)
    if kind == "csv":
        return read_csv(spark, f"{source['path']}/{name}", name)
    if kind == "jdbc":
        options = {k: v for k, v in source.items() if k not in ("format", "url")}
        return read_jdbc(spark, source["url"], name, **options)
    if kind == "catalog":
        return spark.table(f"{source['database']}.{name}" if source.get("database") else name)
    raise ValueError(f"unknown source format {kind!r}")


def load_sku_history(sales: DataFrame, as_of, sku_id: str | None = None, region: str | None = None,
                     days_back: int = 365) -> DataFrame:
    """Trailing history of one series, or of every series when no key is given."""
    history = optional_equals(trailing(sales, as_of, days_back), sku_id=sku_id, region=region)
    if (sku_id or region) and history.isEmpty():
        raise KeyError(f"no data for {sku_id}/{region}")
    return history


#: Seed rows of the two small dimensions.
SEED_REGIONS = [
    (1, "Punjab", "Punjab", 2), (2, "Maharashtra", "Maharashtra", 1), (3, "Karnataka", "Karnataka", 1),
    (4, "Delhi NCR", "Delhi", 1), (5, "Tamil Nadu", "Tamil Nadu", 1),
]
SEED_PRODUCTS = [
    ("SKU-1042", "Wireless Headphones Pro", "Electronics", 1200, 2499),
    ("SKU-2187", "Cotton Kurta Set", "Apparel", 350, 799),
    ("SKU-3301", "Basmati Rice 5kg", "Grocery", 280, 420),
    ("SKU-4560", "Non-stick Cookware Set", "Home & Kitchen", 1800, 3499),
    ("SKU-5891", "Yoga Mat Premium", "Sports", 600, 1299),
    ("SKU-6234", "Smart LED Bulb Pack", "Electronics", 180, 549),
    ("SKU-7780", "Denim Jeans Slim Fit", "Apparel", 450, 1199),
    ("SKU-8102", "Organic Pulses Combo", "Grocery", 320, 599),
]


def seed_regions(spark: SparkSession) -> DataFrame:
    rows = [(i, n, s, "IN", None, None, t) for i, n, s, t in SEED_REGIONS]
    return spark.createDataFrame(rows, schemas.REGIONS)


def seed_products(spark: SparkSession) -> DataFrame:
    rows = [(k, n, c, None, None, Decimal(cost), Decimal(price), None, True) for k, n, c, cost, price in SEED_PRODUCTS]
    return spark.createDataFrame(rows, schemas.PRODUCTS)


def ingest_batch(raw: DataFrame, day, date_column: str = "date") -> DataFrame:
    """One day of a feed."""
    return raw.filter(F.col(date_column) == F.lit(day))
