"""Connected components of a table of links, by passing least labels on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import drop_stored, store


#: Links that one task of a round takes at least.
PER_TASK = 100_000


def components(links: DataFrame) -> tuple[DataFrame, str]:
    """(node, component) for the nodes of `links` (columns a and b), where the
    component is the least node that can be reached; and the folder that holds
    it.

    Each round every node takes the least label among its neighbours and then
    the label of that label, so a chain shortens by more than half. Labels are
    kept as a table in the shared folder from round to round. Folding is
    partial before each shuffle, so a node with very many links is one row for
    each task. Rounds over few links have few tasks.
    """
    spark = links.sparkSession
    pairs, pairs_path = store(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "pairs")
    tasks = 1 + pairs.count() // PER_TASK
    pairs = pairs.coalesce(tasks)
    labels, path = store(pairs.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component")).coalesce(tasks), "labels")
    while True:
        around = (
            pairs.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        taken = labels.join(around, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step, new_path = store(taken.join(jump, "component").select(
            "node", "old", F.least("component", "further").alias("component")).coalesce(tasks), "labels")
        changed = step.where(F.col("old") != F.col("component")).limit(1).count()
        drop_stored(spark, path)
        labels, path = step.drop("old"), new_path
        if not changed:
            drop_stored(spark, pairs_path)
            return labels, path
