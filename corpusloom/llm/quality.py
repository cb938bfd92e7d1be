"""Problem 5: per-document text statistics, and by them prose, list, table or junk.

The statistics are columns of built-in expressions.  The kinds come from an
ordered rule list that ``quality_training`` induces by incremental
reduced-error pruning; its thresholds are exported to one SQL CASE expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.fields import FIELD, FIELD_BREAK, plain_text
from corpusloom.llm.quality_rules import DEFAULT_KIND, RULES
from corpusloom.llm.registry import query
from corpusloom.session import table

#: Common words are a short fixed list; a longer table is an error, not a broadcast.
MAX_COMMON_WORDS = 20_000
#: Words among which repetition is measured; a text of under one and a half windows is one.
WINDOW = 100

_CELLS = r"\S(?:\t| {2,}| ?\| ?)[^ \t|].*?(?:\t| {2,}|\|) ?[^ \t|]"
_FIGURES = r"^\s*-?\d[\d.,:]*(?:\s+-?\d[\d.,:]*){2,}\s*$"
_CLOCK = r"^\W*[0-2]?\d[.:][0-5]\d\s+\p{L}"
_BULLET = r"^\s*(?:[•*–-]|\d{1,2}[.)])\s+\S"
_FULL_STOP = r"[.!?:;…][\"”’»)\]*]*\s*$"
_SENTENCE_END = r"[.!?…][\"”’»)\]*]*(?:\s|$)"


def common_words(words: DataFrame) -> list[str]:
    """The distinct common words, lower-case, of a fixed short table."""
    rows = words.where("word IS NOT NULL").select(F.lower("word")).distinct().limit(MAX_COMMON_WORDS + 1).collect()
    if len(rows) > MAX_COMMON_WORDS:
        raise ValueError(f"more than {MAX_COMMON_WORDS} common words")
    return sorted(r[0] for r in rows)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _distinct(tokens: Column) -> Column:
    """Distinct words of each window of about ``WINDOW`` words, added up: natural prose repeats itself as it grows."""
    n = F.size(tokens)
    windows = F.floor(n / F.lit(WINDOW) + F.lit(0.5))
    begin = lambda i: F.floor(i * n / windows).cast("int")
    window = lambda i: F.size(F.array_distinct(F.slice(tokens, begin(i) + 1, begin(i + 1) - begin(i))))
    several = F.aggregate(F.sequence(F.lit(0).cast("bigint"), windows - 1), F.lit(0), lambda s, i: s + window(i))
    return F.when(windows > 1, several).otherwise(F.size(F.array_distinct(tokens)))


def statistics(df: DataFrame, common: list[str], key: str = "box_id", content: str = "content") -> DataFrame:
    """Counts and shares of every text, one row per input row, as built-in columns.

    Null, empty and blank texts have counts and shares of 0.  Of a text that is
    a JSON list of strings the elements are its lines.
    """
    text = F.col("_text")
    parts = df.select(F.col(key), plain_text(F.coalesce(F.col(content), F.lit(""))).alias("_text"))
    parts = parts.select(
        key,
        "_text",
        F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " ")).alias("_flat"),
        F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "").alias("_tokens"),
        F.filter(F.split(text, r"[\r\n]+"), lambda x: x.rlike(r"\S")).alias("_lines"),
    )
    # words have one space between them, so the spaces count them, and nothing else is left to look for white space
    parts = parts.withColumn("_signs", F.replace("_flat", F.lit(" ")))
    words = F.when(F.col("_flat") == "", 0).otherwise(F.length("_flat") - F.length("_signs") + 1)
    parts = parts.withColumns({"n_words": words, "_undigited": F.regexp_replace("_signs", "[0-9]+", "")})
    parts = parts.withColumn("_letters", F.regexp_replace("_undigited", r"[^\p{L}]+", ""))
    signs, letters, tokens, lines = F.length("_signs"), F.length("_letters"), F.size("_tokens"), F.size("_lines")
    where = lambda pattern: _share(F.size(F.filter("_lines", lambda x: x.rlike(pattern))), lines)
    items = F.regexp_count(text, F.lit(r"[\p{L}\p{N}][^\r\n,;|•]*"))
    fields = F.filter(F.split(text, FIELD_BREAK), lambda x: x.rlike(r"\S"))
    digits = signs - F.length("_undigited")
    vowels = F.length(F.regexp_replace("_letters", r"[^aeiouyåäöéæøAEIOUYÅÄÖÉÆØ]+", ""))
    # a cheap look spares most texts the costly patterns
    apart = text.contains("\t") | text.contains("  ") | text.contains("|")
    return parts.select(
        key,
        F.length("_text").alias("n_chars"),
        "n_words",
        lines.alias("n_lines"),
        _share(signs, F.col("n_words")).alias("mean_word_length"),
        _share(letters, signs).alias("letter_share"),
        _share(digits, signs).alias("digit_share"),
        _share(signs - letters - digits, signs).alias("symbol_share"),
        _share(vowels, letters).alias("vowel_share"),
        _share(F.size(F.filter("_tokens", lambda w: w.isin(common))) if common else F.lit(0), tokens).alias("common_share"),
        _share(_distinct(F.col("_tokens")), tokens).alias("distinct_share"),
        F.when(digits > 0, _share(F.regexp_count(text, F.lit(r"\p{L}[0-9]|[0-9]\p{L}")), tokens)).otherwise(0.0).alias("mixed_token_share"),
        F.coalesce(F.array_max(F.transform("_tokens", lambda w: F.length(w))), F.lit(0)).alias("longest_token"),
        _share(F.regexp_count(text, F.lit(_SENTENCE_END)), F.col("n_words")).alias("sentence_end_share"),
        where(_FULL_STOP).alias("punctuated_line_share"),
        F.when(apart, where(_CELLS)).otherwise(0.0).alias("column_line_share"),
        where(_FIGURES).alias("figure_line_share"),
        where(_CLOCK).alias("clock_line_share"),
        where(_BULLET).alias("bullet_line_share"),
        _share(tokens, items).alias("words_per_item"),
        F.when(text.contains(":"), _share(F.size(F.filter(fields, lambda x: x.rlike(FIELD))), F.size(fields)))
        .otherwise(0.0)
        .alias("field_share"),
    )


def rules_sql(rules=RULES, default: str = DEFAULT_KIND) -> str:
    """One CASE expression over the statistics; the first rule that holds decides."""
    if not rules:
        return f"'{default}'"
    whens = " ".join(
        "WHEN " + " AND ".join(f"{name} {sign} {limit!r}D" for name, sign, limit in conditions) + f" THEN '{kind}'"
        for kind, conditions in rules
    )
    return f"CASE {whens} ELSE '{default}' END"


def kinds(df: DataFrame, common: list[str], key: str = "box_id", content: str = "content") -> DataFrame:
    """Statistics with the ``kind`` of every text: prose, list, table or junk; null where there is no text."""
    found = statistics(df, common, key, content)
    # the partition id makes the column non-deterministic for the optimizer, which else
    # copies every statistic into each condition of a filter on the kind
    here = F.spark_partition_id() >= 0
    return found.withColumn("kind", F.when(here & (F.col("n_words") > 0), F.expr(rules_sql())))


@query("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    common = common_words(table(spark, sf_dir, "common_words"))
    found = kinds(table(spark, sf_dir, "boxes"), common)
    return found.where("kind <> 'prose'").select("box_id", "kind").distinct()


@query("p5_statistics")
def p5_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    common = common_words(table(spark, sf_dir, "common_words"))
    return kinds(table(spark, sf_dir, "boxes"), common)
