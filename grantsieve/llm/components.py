"""Connected components of a link table, by labels that spread and jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def connected_components(links: DataFrame) -> DataFrame:
    """(v, label) of every id in links (a, b); label is the smallest id that v reaches.

    Each round takes the least label of the neighbours, then follows the label's own label,
    so long chains shorten by half. Rounds are written to the shared folder; only the number
    of changed labels reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("v") == F.col("a")).select(
            "v", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        own = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
        jumped = spread.join(own, "label").select("v", "was", F.least("label", "next").alias("label"))
        jumped = written(jumped, "labels")
        labels = jumped.select("v", "label")
        if jumped.filter("label <> was").isEmpty():
            return labels
