"""Writers of packages, text, removed documents, candidates and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.content import text_lines


def write_packages(packages: DataFrame, path: str, by_year: bool = False) -> None:
    """JSON lines; ``by_year`` in a folder per year."""
    writer = packages.withColumn("year", F.col("meta.year")) if by_year else packages
    (writer.write.partitionBy("year") if by_year else writer.write).mode("append").option("ignoreNullFields", False).json(path)


def write_text(packages: DataFrame, key: str, path: str) -> None:
    """One text per line, in the order of key and position."""
    text_lines(packages, key).sort(key, "pos").select("line").write.text(path)


def write_removed(rows: DataFrame, path: str, text: str = "text") -> None:
    """Removed texts, a folder per filter."""
    rows.where("filter_name IS NOT NULL").select("filter_name", F.col(text).alias("value")).write.partitionBy("filter_name").text(path)


def candidate_records(edges: DataFrame) -> DataFrame:
    """``{src: {dst: jaccard}}`` as JSON, a row per source."""
    near = edges.groupBy("src").agg(F.map_from_entries(F.collect_list(F.struct("dst", "jaccard"))).alias("near"))
    return near.select(F.to_json(F.create_map("src", "near")).alias("value"))


def score_records(scores: DataFrame) -> DataFrame:
    """``{package_id: [score, ...]}`` as JSON, a row per package."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "score"))), lambda x: x["score"])
    return scores.groupBy("package_id").agg(ordered.alias("scores")).select(F.to_json(F.create_map("package_id", "scores")).alias("value"))


def write_fingerprints(signatures: DataFrame, path: str) -> None:
    signatures.write.parquet(path)


def read_fingerprints(spark, *paths: str) -> DataFrame:
    """The union of saved fingerprints."""
    return spark.read.parquet(*paths)
