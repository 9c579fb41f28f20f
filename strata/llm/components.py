"""Connected components of a link table, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import remove, stage, staged_inside


def components(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    """``links`` (a, b) to (node, label): the smallest node that each node
    reaches.  Every round takes the smallest label of the neighbours and then
    the label of that label, so long chains take few rounds.  Labels and links
    are tables in the shared folder; a round that changes nothing ends it."""
    with staged_inside() as made:
        labels = _labels(spark, links, name)
    # The last table is the result; no later step reads the ones before.
    remove(spark, made[:-1])
    return labels


def _labels(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    both = stage(spark, links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-links")
    labels = stage(spark, both.groupBy(F.col("a").alias("node"))
                   .agg(F.least(F.col("a"), F.min("b")).alias("label")), f"{name}-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        lower = (labels.join(near, "node")
                 .select("node", F.col("label").alias("old"), F.least("label", "near").alias("low")))
        jumped = (lower.join(labels.select(F.col("node").alias("low"), F.col("label").alias("far")), "low")
                  .select("node", "old", F.least("low", "far").alias("label")))
        jumped = stage(spark, jumped, f"{name}-labels")
        if jumped.where("label < old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
