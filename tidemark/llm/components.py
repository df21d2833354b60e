"""Connected components of a large set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidemark.session import settle


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that links reach, of every node with a link (runs jobs).

    ``links`` has two long columns ``a`` and ``b``; order, repeats and loops do not matter, rows with
    a NULL are left out. Alternates large and small stars until nothing changes, about log(n) rounds.
    A node with very many links is the hot key of a join whose other side has one row for it, so
    its rows can be split; the minima combine before they are shuffled. Every round is written to the
    shared folder, which cuts the lineage. Nodes and links stay on the executors.
    """
    def oriented(frame: DataFrame) -> DataFrame:
        return frame.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()

    def written(frame: DataFrame) -> tuple[DataFrame, Observation]:
        """The edges, settled, and what tells whether they changed."""
        seen = Observation()
        state = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")]
        return settle(frame.observe(seen, *state)), seen

    edges, seen = written(oriented(links.where("a IS NOT NULL AND b IS NOT NULL").select(
        F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v"))))
    before = seen.get
    while before["n"]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = oriented(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = settle(large)
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, seen = written(oriented(small.union(root)))
        if seen.get == before:
            break
        before = seen.get
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
