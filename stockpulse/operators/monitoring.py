"""Drift, realized accuracy, quality gate, model versions and survival to stockout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as fx

PSI_LIMIT = 0.2
#: Ours: share used for an empty bin, so that the logarithm stays finite.
EMPTY_SHARE = 1e-4


def psi(sales: DataFrame, as_of, reference_days: int = 30, current_days: int = 7, bins: int = 10,
        column: str = "sales_qty") -> DataFrame:
    """Population stability index per SKU between the last days and the window before them.

    Edges are quantiles of the reference window. Both windows are binned in one conditional
    aggregation, so a SKU is one row after the partial aggregate.
    """
    current_from = F.date_sub(F.lit(as_of), current_days)
    rows = fx.trailing(sales, as_of, current_days + reference_days - 1).select(
        "sku_id", F.col(column).cast("double").alias("x"), (F.col("date") > current_from).alias("cur"))
    cuts = [i / bins for i in range(1, bins)]
    edges = rows.filter(~F.col("cur")).groupBy("sku_id").agg(F.percentile("x", F.array(*[F.lit(c) for c in cuts])).alias("edges"))
    binned = rows.join(edges, "sku_id").withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("x"))))
    shares = binned.groupBy("sku_id").agg(
        F.count_if(~F.col("cur")).alias("n_ref"), F.count_if(F.col("cur")).alias("n_cur"),
        *[F.count_if(~F.col("cur") & (F.col("bin") == i)).alias(f"r{i}") for i in range(bins)],
        *[F.count_if(F.col("cur") & (F.col("bin") == i)).alias(f"c{i}") for i in range(bins)],
    ).filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))

    def share(prefix: str, total: str, i: int):
        return F.greatest(fx.ratio(f"{prefix}{i}", total), F.lit(EMPTY_SHARE))

    terms = [(share("c", "n_cur", i) - share("r", "n_ref", i)) * F.log(share("c", "n_cur", i) / share("r", "n_ref", i))
             for i in range(bins)]
    total = sum(terms[1:], terms[0])
    return shares.select("sku_id", "n_ref", "n_cur", total.alias("psi")).withColumn("drifted", F.col("psi") > PSI_LIMIT)


def realized_mape(forecasts: DataFrame, target) -> DataFrame:
    """Average realized error of one target date, 0 without any."""
    return forecasts.filter(F.col("target_date") == target).agg(
        F.coalesce(F.avg(F.col("realized_mape").cast("double")), F.lit(0.0)).alias("realized_mape"))


def quality_gate(metrics: DataFrame, threshold: float = 15.0, relative: float | None = None) -> DataFrame:
    """One-row decision: every model within the threshold, or within ``relative`` of its baseline.

    The relative mode needs a ``baseline_mape`` column. Missing errors are ignored.
    """
    limit = F.lit(threshold) if relative is None else F.col("baseline_mape").cast("double") * (1 + relative)
    within = F.coalesce(F.bool_and(F.col("avg_mape").cast("double") <= limit), F.lit(True))
    return metrics.agg(F.count("avg_mape").alias("models_checked"), F.max(F.col("avg_mape").cast("double")).alias("worst_mape"),
                       within.alias("passed")).withColumn(
        "next_step", F.when(F.col("passed"), "promote_models").otherwise("alert_quality_failure"))


def promote_versions(versions: DataFrame) -> DataFrame:
    """Newest Staging version of each model to Production; its other Production versions to Archived."""
    newest = F.max(F.when(F.col("stage") == "Staging", F.col("version"))).over(Window.partitionBy("model_name"))
    stage = (F.when(F.col("version") == F.col("_new"), "Production")
             .when((F.col("stage") == "Production") & F.col("_new").isNotNull(), "Archived").otherwise(F.col("stage")))
    return versions.withColumn("_new", newest).withColumn("stage", stage).drop("_new")


def stock_spells(inventory_daily: DataFrame) -> DataFrame:
    """Runs of days in stock per series: length, and whether a stockout ended the run.

    A zero-stock day closes the run before it. The run still open at the end of the data is censored.
    """
    out = (F.col("quantity_on_hand") == 0).cast("int")
    before = Window.partitionBy("sku_id", "region").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    runs = inventory_daily.withColumn("out", out).withColumn("run", F.coalesce(F.sum("out").over(before), F.lit(0)))
    return (runs.groupBy("sku_id", "region", "run")
            .agg(F.sum(1 - F.col("out")).alias("duration"), F.max("out").alias("event")).filter("duration > 0"))


def kaplan_meier(spells: DataFrame, group: str) -> DataFrame:
    """Survival curve per group. Counts per duration are aggregated first: a window then holds at most
    one row per distinct duration."""
    steps = spells.groupBy(group, "duration").agg(F.sum("event").alias("events"), F.count(F.lit(1)).alias("ended"))
    later = Window.partitionBy(group).orderBy(F.desc("duration"))
    so_far = Window.partitionBy(group).orderBy("duration")
    d, n = F.col("events"), F.col("at_risk")
    survive = F.when(d < n, F.log1p(-d / n))
    dead = F.max(F.when(d >= n, 1).otherwise(0)).over(so_far)
    return (
        steps.withColumn("at_risk", F.sum("ended").over(later))
        .withColumn("survival", F.when(dead == 1, F.lit(0.0)).otherwise(F.exp(F.sum(survive).over(so_far))))
        .select(group, "duration", "at_risk", "events", "survival")
    )
