"""Readers of package JSON lines, glued JSON lines, crawl formats, scores and text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schema import MC4, META, OSCAR, WIKI


def read_packages(spark: SparkSession, path, suffix: str | None = None) -> DataFrame:
    """Packages from JSON lines, malformed lines skipped; with ``suffix`` from all such files under a folder.

    An element of content that is a list of strings is joined by spaces; a text
    that only begins like a list stays as it is.
    """
    reader = spark.read
    if suffix:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return parse_packages(reader.text(path).where(F.trim("value") != ""), "value")


def parse_packages(lines: DataFrame, value: str) -> DataFrame:
    """Packages from a column of JSON texts; rows that aren't JSON objects are skipped."""
    rows = lines.select(F.try_parse_json(value).alias("v"), F.col(value).alias("_raw")).where(F.col("v").isNotNull())
    plain = F.from_json("_raw", f"meta {META}")
    elements = F.try_variant_get("v", "$.content", "array<variant>")
    kind = lambda x: F.schema_of_variant(x)

    def text(x: Column) -> Column:
        as_list = F.array_join(F.try_variant_get(x, "$", "array<string>"), " ")
        return F.when(kind(x) == "VOID", None).when(kind(x).startswith("ARRAY"), as_list).otherwise(F.try_variant_get(x, "$", "string"))

    return rows.where(F.schema_of_variant("v").startswith("OBJECT")).select(plain["meta"].alias("meta"), F.transform(elements, text).alias("content"))


def split_glued(lines: DataFrame, value: str = "value") -> DataFrame:
    """One JSON object per row where two are glued on a line; blank lines are skipped, intact ones untouched."""
    rows = lines.where(F.trim(value) != "").select(F.col(value).alias("value"))
    cut = F.split(F.regexp_replace("value", r"\}\{", "}\n{"), "\n")
    # a brace pair within a text gives parts that don't parse
    glued = F.forall(cut, lambda x: F.try_parse_json(x).isNotNull())
    parts = F.when(glued, cut).otherwise(F.array("value"))
    return rows.select(F.explode(parts).alias("value")).where(F.try_parse_json("value").isNotNull())


def read_glued(spark: SparkSession, path, schema: str) -> DataFrame:
    return split_glued(spark.read.text(path)).select(F.from_json("value", schema).alias("v")).select("v.*")


def read_candidates(spark: SparkSession, path) -> DataFrame:
    """Edges ``(src, dst, jaccard)`` from duplicate-candidate JSON lines; of each line the first main counts."""
    rows = split_glued(spark.read.text(path)).select(F.from_json("value", "map<string, map<string, double>>").alias("m")).where("size(m) > 0")
    first = F.map_keys("m")[0]
    return rows.select(first.alias("src"), F.explode(F.col("m")[first]).alias("dst", "jaccard"))


def read_scores(spark: SparkSession, path) -> DataFrame:
    """``(package_id, pos, score)`` from a JSON object of lists by package."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, array<double>>")).alias("package_id", "scores"))
    return rows.select("package_id", F.posexplode("scores").alias("pos", "score"))


def crawl_package(uid: Column, url: Column, time: Column, content: Column) -> list[Column]:
    """``meta`` and ``content`` of a crawled page: failed fields, an id with the url where only the time is missing, the year of the time."""
    failed = F.lit("failed")
    name = F.when((url != "failed") & (time == "failed"), F.concat_ws("_", uid, url)).otherwise(uid)
    year = F.when(time != "failed", F.split(time, "-")[0].try_cast("int"))
    meta = F.struct(
        name.alias("package_id"), url.alias("title"), time.alias("created"), F.coalesce(year, F.lit(-1)).alias("year"), failed.alias("edition"), failed.alias("issue")
    )
    return [meta.alias("meta"), content.alias("content")]


def martin_records(records: DataFrame, value: str = "value") -> DataFrame:
    """Pages of the crawl text format from one record per row: a header of path and url, then the lines."""
    text = F.regexp_replace(value, r"^## START ##", "")
    head = F.filter(F.split(F.regexp_extract(text, r"^([^\n]*)", 1), r"\s+"), lambda t: t != "")
    body = F.filter(F.transform(F.split(F.regexp_extract(text, r"(?s)^[^\n]*\n(.*)$", 1), "\n"), lambda s: F.trim(s)), lambda s: s != "")
    rows = records.select(head.alias("head"), body.alias("body")).where("size(head) > 0 AND size(body) > 0")
    url = F.coalesce(F.get("head", F.lit(1)), F.lit("failed"))
    return rows.select(*crawl_package(F.concat(F.lit("KB_"), F.get("head", F.lit(0))), url, F.lit("failed"), F.col("body")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def mc4_records(rows: DataFrame) -> DataFrame:
    uid = F.concat(F.lit("mc4_"), F.col("url"), F.lit("-"), F.col("timestamp"))
    return rows.select(*crawl_package(uid, F.col("url"), F.col("timestamp"), _lines(F.col("text"))))


def oscar_records(rows: DataFrame) -> DataFrame:
    url, time = F.col("warc_headers.`warc-target-uri`"), F.col("warc_headers.`warc-date`")
    return rows.select(*crawl_package(F.concat(F.lit("oscar_"), url, F.lit("-"), time), url, time, _lines(F.col("content"))))


def wiki_records(rows: DataFrame) -> DataFrame:
    uid = F.concat(F.lit("wiki_"), F.col("title"), F.lit("-"), F.col("url"))
    return rows.select(*crawl_package(uid, F.col("url"), F.lit("failed"), _lines(F.col("text"))))


def read_corpus(spark: SparkSession, path, style: str) -> DataFrame:
    """Packages of a crawl in the style ``martin``, ``mc4``, ``oscar`` or ``wiki``."""
    if style == "martin":
        return martin_records(spark.read.option("lineSep", "\n## START ##").text(path))
    readers = {"mc4": (MC4, mc4_records), "oscar": (OSCAR, oscar_records), "wiki": (WIKI, wiki_records)}
    if style not in readers:
        raise ValueError(f"unknown style {style!r}; one of martin, mc4, oscar, wiki")
    schema, records = readers[style]
    return records(spark.read.schema(schema).json(path))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of all files."""
    return spark.read.text(paths)


def text_batches(lines: DataFrame, size: int = 50, text: str = "value") -> Iterator[list[str]]:
    """Lists of ``size`` texts, the last one shorter, partition by partition; only one partition is on the driver at a time."""
    batch: list[str] = []
    for row in lines.select(text).toLocalIterator():
        batch.append(row[0])
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch
