"""Filters over documents: named predicates, first failing verdicts, kept and removed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.patterns import CLOCK, UNREADABLE
from corpusloom.functions.text import one_line, token_count
from corpusloom.session import meet


@dataclass(frozen=True)
class FilterSpec:
    """A named predicate over a text; true keeps it."""

    name: str
    keep: Callable[[Column], Column]


def num_tokens(least: int = 30) -> FilterSpec:
    return FilterSpec("num_tokens", lambda t: token_count(t) >= least)


def readable() -> FilterSpec:
    """No character outside the readable Unicode blocks."""
    return FilterSpec("unicode", lambda t: ~t.rlike(UNREADABLE))


def tv_tables(most: int = 3) -> FilterSpec:
    """At most so many clock times."""
    return FilterSpec("tv_tables", lambda t: F.regexp_count(t, F.lit(CLOCK)) <= most)


def language(provider: Callable[[Column], Column], target: str = "sv", margin: float = 0.5) -> FilterSpec:
    """The most probable label is the target and leads by the margin.

    ``provider(text)``: ``array<struct<label, prob>>``; weights that don't sum
    to 1 are normalized.  It is evaluated once per text; ties go to the greater
    label.
    """
    start = F.struct(F.lit("").alias("label"), F.lit(0.0).alias("first"), F.lit(0.0).alias("second"), F.lit(0.0).alias("total"))

    def step(s: Column, x: Column) -> Column:
        ahead = (x["prob"] > s["first"]) | ((x["prob"] == s["first"]) & (x["label"] > s["label"]))
        return F.struct(
            F.when(ahead, x["label"]).otherwise(s["label"]).alias("label"),
            F.when(ahead, x["prob"]).otherwise(s["first"]).alias("first"),
            F.when(ahead, s["first"]).otherwise(F.greatest(s["second"], x["prob"])).alias("second"),
            (s["total"] + x["prob"]).alias("total"),
        )

    leads = lambda s: (s["label"] == target) & (s["total"] > 0) & (s["first"] - s["second"] >= margin * s["total"])
    return FilterSpec("language", lambda t: F.coalesce(F.aggregate(provider(t), start, step, leads), F.lit(False)))


#: The order in which filters run, whatever the order in which they are asked for.
ORDER = ("num_tokens", "unicode", "tv_tables", "language", "exact_duplicate", "exact_duplicate_min_size")


def planned(specs: list[FilterSpec]) -> list[FilterSpec]:
    """Filters in their fixed order; those of other names come after the named ones, in the order given."""
    place = {name: k for k, name in enumerate(ORDER)}
    return sorted(specs, key=lambda spec: place.get(spec.name, len(ORDER)))


def first_failing(text: Column, specs: list[FilterSpec]) -> Column:
    """Name of the first filter that a text fails, in the order given; null if it passes all. Null text passes."""
    line, verdict = one_line(text), F.lit(None).cast("string")
    for spec in reversed(specs):
        verdict = F.when(~spec.keep(line), spec.name).otherwise(verdict)
    return F.when(text.isNotNull(), verdict)


def first_of_text(docs: DataFrame, text: str, order: list[str]) -> DataFrame:
    """The first row of every distinct text in the given order, as ``_first``; null texts are all first.

    Texts meet by their SHA-256 and don't travel.  They combine before the
    shuffle by a minimum over the order, for a single column by hash, so that no
    window sorts a hot text; a row then finds its text by digest and order,
    which spreads a hot text.  A null in the only column comes last.
    """
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    digest = F.unhex(F.sha2(text, 256))
    firsts = docs.where(F.col(text).isNotNull()).groupBy(digest.alias("_digest_")).agg(F.min(at).alias("_at_"))
    firsts = firsts.withColumn("_first", F.lit(True))
    marked = docs.withColumns({"_digest": digest, "_at": at})
    same = (F.col("_digest") == F.col("_digest_")) & F.col("_at").eqNullSafe(F.col("_at_"))
    marked = meet(marked, firsts, same, "left")
    return marked.withColumn("_first", F.coalesce("_first", F.col(text).isNull())).drop("_digest", "_at", "_digest_", "_at_")


def exact_duplicates(docs: DataFrame, text: str, order: list[str], least_tokens: int = 0) -> DataFrame:
    """Rows that are the first with their text; rows of fewer tokens than ``least_tokens`` are dropped first."""
    if least_tokens:
        docs = docs.where(token_count(F.col(text)) >= least_tokens)
    return first_of_text(docs, text, order).where("_first").drop("_first")


def apply_filters(
    docs: DataFrame, specs: list[FilterSpec], text: str = "text", order: list[str] | None = None, duplicates: str | None = None, least_tokens: int = 30
) -> DataFrame:
    """All rows with their text on one line and ``filter_name``, the first filter they fail in the fixed order, or null.

    ``duplicates``: ``exact`` or ``exact_min_size`` also removes later copies
    among the rows that passed everything else.
    """
    rows = docs.withColumn("filter_name", first_failing(F.col(text), planned(specs))).withColumn(text, one_line(F.col(text)))
    if duplicates is None:
        return rows
    passed = rows.where(F.col("filter_name").isNull() & F.col(text).isNotNull())
    rest = rows.where(F.col("filter_name").isNotNull() | F.col(text).isNull())
    name = "exact_duplicate" if duplicates == "exact" else "exact_duplicate_min_size"
    short = (token_count(F.col(text)) < least_tokens) if duplicates == "exact_min_size" else F.lit(False)
    marked = first_of_text(passed.where(~short), text, order)
    marked = marked.withColumn("filter_name", F.when(~F.col("_first"), name)).drop("_first")
    return rest.unionByName(marked).unionByName(passed.where(short).withColumn("filter_name", F.lit(name)))


def label_provider(label: Column) -> Callable[[Column], Column]:
    """Language labels taken from a column."""
    return lambda _: F.array(F.struct(label.alias("label"), F.lit(1.0).alias("prob")))


def word_provider(words: dict[str, list[str]]) -> Callable[[Column], Column]:
    """Weights of languages by the number of each language's common words in a text."""

    def count(tokens: Column) -> Column:
        n = lambda v: F.size(F.filter(tokens, lambda w: w.isin(v))).cast("double")
        return F.array(*(F.struct(F.lit(k).alias("label"), n(v).alias("prob")) for k, v in sorted(words.items())))

    # the array of one binds the tokens to a variable, so that they are cut once
    return lambda text: F.transform(F.array(F.split(F.lower(text), r"[^\p{L}]+")), count)[0]


def by_score(rows: DataFrame, score: str = "score", below: float = 430.0) -> DataFrame:
    """Rows whose score is known and below the limit."""
    return rows.where(F.col(score) < below)


