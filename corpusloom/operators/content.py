"""Content arrays of packages: explode, breaks, fuse, regroup, text lines. A null element marks a break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import meet


def explode_content(packages: DataFrame, key: str, content: str = "content", keep: list[str] | None = None) -> DataFrame:
    """``(key, ..., pos, text)``: one row per element, null elements included; an empty or null content has none."""
    return packages.select(key, *(keep or []), F.posexplode(content).alias("pos", "text"))


def break_fold(elements: Column, remove_breaks: bool = False) -> Column:
    """Content from ``array<struct<text, keep>>`` in order: kept texts, input breaks, and a break for what was dropped.

    A dropped element leaves a break if the last element so far is a text; a
    null element is always a break.  With ``remove_breaks`` there are none.
    """
    kept = lambda x: x["text"].isNotNull() & x["keep"]
    if remove_breaks:
        return F.transform(F.filter(elements, kept), lambda x: x["text"])

    def fold(e: Column) -> Column:
        # the last element so far is a text where the one just before was kept
        before = F.slice(F.concat(F.array(F.lit(False)), F.transform(e, kept)), F.lit(1), F.size(e))
        marked = F.zip_with(e, before, lambda x, b: F.struct(x["text"].alias("text"), kept(x).alias("kept"), b.alias("before")))
        shown = F.filter(marked, lambda x: x["kept"] | x["before"] | x["text"].isNull())
        return F.transform(shown, lambda x: F.when(x["kept"], x["text"]))

    return _once(elements, fold)


def _once(array: Column, function) -> Column:
    """``function(array)`` with the array evaluated once, however often the function names it."""
    return F.transform(F.array(array), function)[0]


def filter_content(packages: DataFrame, verdict, content: str = "content", remove_breaks: bool = False) -> DataFrame:
    """Packages with filtered content; ``verdict(text)`` is null where a text is kept. No shuffle: the content stays in its row."""
    elements = F.transform(content, lambda t: F.struct(F.translate(t, "\n", " ").alias("text"), verdict(t).isNull().alias("keep")))
    return packages.withColumn(content, break_fold(elements, remove_breaks))


def fuse(content: Column, ignore_breaks: bool = False) -> Column:
    """Consecutive texts joined by a space, breaks apart; with ``ignore_breaks`` one text, even if empty."""
    if ignore_breaks:
        return F.array(F.array_join(F.filter(content, lambda x: x.isNotNull()), " "))

    def islands(c: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(c) - 1)
        breaks = F.filter(every, lambda i: F.get(c, i).isNull())
        spans = F.zip_with(F.concat(F.array(F.lit(-1)), breaks), F.concat(breaks, F.array(F.size(c))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        texts = F.filter(spans, lambda x: x["b"] - x["a"] > 1)
        return F.transform(texts, lambda x: F.array_join(F.slice(c, x["a"] + 2, x["b"] - x["a"] - 1), " "))

    return F.when(F.size(content) > 0, _once(content, islands)).otherwise(content)


def fuse_paragraphs(packages: DataFrame, content: str = "content", ignore_breaks: bool = False) -> DataFrame:
    """Packages with fused content; packages of null or empty content are dropped."""
    return packages.where(F.size(content) > 0).withColumn(content, fuse(F.col(content), ignore_breaks))


def text_lines(packages: DataFrame, key: str, content: str = "content") -> DataFrame:
    """``(key, pos, line)`` of the text export: null and empty texts are skipped."""
    return explode_content(packages, key, content).where("text <> ''").withColumnRenamed("text", "line")


def sentence_lines(packages: DataFrame, key: str, content: str) -> DataFrame:
    """Export of sentence-split content (``array<array<string>>``): a line per sentence and an empty line after each text."""
    docs = packages.select(key, F.posexplode(content).alias("pos", "parts")).where("size(parts) > 0")
    body = F.array_join(F.filter("parts", lambda s: s != ""), "\n")
    return docs.select(key, "pos", F.concat(body, F.lit("\n")).alias("line"))


def regroup(packages: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Packages with the kept ``(key, pos, text)`` as content, in order; a package that keeps nothing has an empty content."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    content = kept.groupBy(key).agg(ordered.alias("content"))
    return meet(packages.drop("content"), content, key, "left").withColumn("content", F.coalesce("content", F.array().cast("array<string>")))


def document_key(package_id: Column, pos: Column) -> Column:
    """``<package_id>_<pos>``."""
    return F.concat_ws("_", package_id, pos)


def key_package(key: Column) -> Column:
    """Package id of a document key: all before the last underscore."""
    return F.regexp_extract(key, "(?s)^(.*)_([0-9]+)$", 1)


def key_position(key: Column) -> Column:
    return F.regexp_extract(key, "(?s)^(.*)_([0-9]+)$", 2).cast("int")


def prefix_ids(packages: DataFrame, prefix: str, delimiter: str = "_") -> DataFrame:
    """Packages with a prefix before ``meta.package_id``."""
    return packages.withColumn("meta", F.col("meta").withField("package_id", F.concat_ws(delimiter, F.lit(prefix), "meta.package_id")))
