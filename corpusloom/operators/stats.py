"""Statistics of packages per year, and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import token_count

#: The upper edges of the bins, powers of two.
BINS = [2**i for i in range(1, 13)]


def documents_with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents of at least one word, with ``words``."""
    return docs.withColumn("words", token_count(F.col(text))).where("words > 0")


def by_year(docs: DataFrame) -> DataFrame:
    """Documents, words, the mean of distinct lengths (``avg_doc_len``) and the true mean length per year."""
    lengths = docs.groupBy("year", "words").agg(F.count("*").alias("n"))
    total = F.sum(F.col("n") * F.col("words"))
    return lengths.groupBy("year").agg(
        F.sum("n").alias("docs"),
        total.alias("words"),
        F.round(F.avg("words"), 6).alias("avg_doc_len"),
        F.round(total / F.sum("n"), 6).alias("mean_doc_len"),
    )


def length_histogram(docs: DataFrame) -> DataFrame:
    return docs.groupBy("year", F.col("words").alias("length")).agg(F.count("*").alias("n"))


def title_histogram(docs: DataFrame) -> DataFrame:
    return docs.groupBy("year", "title").agg(F.count("*").alias("n"))


def power_bins(lengths: DataFrame, weighted: bool = False) -> DataFrame:
    """``(bin, n, share)``: lengths over all years in power-of-two bins.

    A length goes to the first bin above it, at most the last; ``weighted``
    counts words instead of documents.
    """
    value = F.col("n") * F.col("length") if weighted else F.col("n")
    bin_ = F.lit(BINS[-1])
    for b in reversed(BINS[:-1]):
        bin_ = F.when(F.col("length") < b, b).otherwise(bin_)
    found = lengths.groupBy(bin_.alias("bin")).agg(F.sum(value).alias("n"))
    total = found.agg(F.sum("n").alias("total"))
    # one row of totals: a join without keys, not a window over everything
    return found.join(F.broadcast(total)).select("bin", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def as_json(docs: DataFrame) -> DataFrame:
    """``(year, stats)``: the tables of each year as JSON maps in order of their keys; a null year is -1, a null title empty."""
    docs = docs.withColumn("year", F.coalesce("year", F.lit(-1))).withColumn("title", F.coalesce("title", F.lit("")))
    lengths, titles = length_histogram(docs), title_histogram(docs)
    entries = lambda key: F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n"))))
    a = lengths.groupBy("year").agg(F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("length")).alias("words"), entries("length").alias("lengths"))
    years = a.join(titles.groupBy("year").agg(entries("title").alias("titles")), "year")
    # fixed values: the names of the tables
    tables = (("docs", "#docs"), ("words", "#words"), ("lengths", "doc lengths"), ("titles", "titles"))
    return years.select("year", F.to_json(F.struct(*(F.col(c).alias(name) for c, name in tables))).alias("stats"))


def year_table(docs: DataFrame) -> DataFrame:
    """``(year, docs, words, avg_doc_len, mean_doc_len)`` of every year, and of ``all`` years together."""
    lengths = docs.groupBy("words").agg(F.count("*").alias("n"))
    total = F.sum(F.col("n") * F.col("words"))
    whole = lengths.agg(
        F.lit("all").alias("year"),
        F.sum("n").alias("docs"),
        total.alias("words"),
        F.round(F.avg("words"), 6).alias("avg_doc_len"),
        F.round(total / F.sum("n"), 6).alias("mean_doc_len"),
    )
    return by_year(docs).withColumn("year", F.col("year").cast("string")).unionByName(whole)
