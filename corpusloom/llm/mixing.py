"""Problem 9: combine sources so that each has its target share of the tokens."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.bytebpe import DEFAULT_VOCABULARY
from corpusloom.llm.encoding import count_tokens
from corpusloom.llm.registry import query
from corpusloom.session import cut, table

#: Sources a target table may name; it is configuration, not data.
MAX_SOURCES = 10_000
#: Slots of the seeded hash in which fractional repetitions are decided.
SLOTS = 4096


@dataclass
class Target:
    source: str
    share: float
    cap: int
    size: int = 0
    epochs: float = 0.0


def water_fill(targets: list[Target], total: float | None = None) -> float:
    """Set each target's ``epochs``, how often its source is used; give the total used.

    Without ``total`` it is the largest at which every source that holds any
    token meets its share within its cap.  With a larger one, sources that would
    exceed their cap are clamped there and the excess goes to the others in
    proportion to their shares, until nothing exceeds or nothing is left.
    Sources without tokens, share or cap get 0.
    """
    open_ = [t for t in targets if t.size > 0 and t.share > 0 and t.cap > 0]
    for t in targets:
        t.epochs = 0.0
    if not open_:
        return 0.0
    weight = sum(t.share for t in open_)
    if total is None:
        total = min(t.cap * t.size / (t.share / weight) for t in open_)
    left = float(total)
    while open_ and left > 0:
        weight = sum(t.share for t in open_)
        over = [t for t in open_ if left * t.share / weight > t.cap * t.size * (1 + 1e-12)]
        if not over:
            for t in open_:
                t.epochs = min(float(t.cap), left * t.share / weight / t.size)
            break
        for t in over:
            t.epochs = float(t.cap)
            left -= t.cap * t.size
        open_ = [t for t in open_ if t not in over]
    return sum(t.epochs * t.size for t in targets)


def read_targets(targets: DataFrame) -> list[Target]:
    """The target table; null shares and caps count as 0, null sources are left out, and a repeated source is an error."""
    rows = targets.select("source", "target_share", "max_repeats").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources in the target table")
    found = [Target(r[0], float(r[1] or 0), int(r[2] or 0)) for r in rows if r[0] is not None]
    if len({t.source for t in found}) < len(found):
        raise ValueError("a source has two targets")
    return found


def mix(
    docs: DataFrame, targets: DataFrame, total: float | Callable[[list[Target]], float] | None = None, seed: int = 17, vocabulary: str = DEFAULT_VOCABULARY
) -> tuple[DataFrame, DataFrame]:
    """Choose documents with repeats so that every source has its target share of all tokens.

    Gives ``(doc_id, source, n_tokens, repeats)`` of the chosen documents and
    ``(source, target_share, actual_share, available_tokens, used_tokens,
    epochs)`` of every target.  A source used ``2.4`` times has each document
    twice and, seeded by its id, four tenths of the tokens a third time; no
    document exceeds ``max_repeats``.  Documents without a source, with a source
    that has no target, or without any token are never chosen.  Empty tables
    give no documents and shares of 0.

    Tokens are counted once and kept in the shared folder.  The driver gets one
    sum per source; where in its hash slots a source's last repetition ends is
    found in the cluster, in a window over the sums of at most 4096 slots.  Sums
    are combined before the shuffle, so that a source may hold any part of the
    rows; what is joined to the documents has a row per source.
    """
    spark = docs.sparkSession
    plan = read_targets(targets)
    wanted = docs.where(F.col("source").isin([t.source for t in plan]))
    sized = count_tokens(wanted, ["doc_id", "source"], vocabulary=vocabulary).where("n_tokens > 0")
    slot = F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit(seed)), 52).cast("int")
    sized = cut(sized.withColumn("slot", slot))
    slots = cut(sized.groupBy("source", "slot").agg(F.sum("n_tokens").alias("n")))
    sizes = {r["source"]: r["n"] for r in slots.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    for t in plan:
        t.size = sizes.get(t.source, 0)
    if callable(total):
        total = total(plan)
    water_fill(plan, total)
    rows = []
    for t in plan:
        whole = min(t.cap, math.floor(t.epochs + 1e-9))
        part = max(0.0, t.epochs - whole) if whole < t.cap else 0.0
        rows.append((t.source, t.share, whole, part * t.size, t.size))
    uses = spark.createDataFrame(rows, "source string, target_share double, whole int, part double, size long")
    # slots in order are used while that brings the source nearer to its part
    below = F.sum("n").over(Window.partitionBy("source").orderBy("slot"))
    ends = slots.join(F.broadcast(uses), "source").withColumn("below", below)
    ends = ends.where(F.abs(F.col("below") - F.col("part")) <= F.abs(F.col("below") - F.col("n") - F.col("part")))
    ends = ends.groupBy("source").agg((F.max("slot") + 1).alias("first_out"), F.max("below").alias("extra"))
    uses = cut(uses.join(ends, "source", "left").fillna(0, ["first_out", "extra"]))
    repeats = F.col("whole") + (F.col("slot") < F.col("first_out")).cast("int")
    chosen = sized.join(F.broadcast(uses.select("source", "whole", "first_out")), "source").withColumn("repeats", repeats).where("repeats > 0")
    used = uses.withColumn("used_tokens", F.col("whole") * F.col("size") + F.col("extra"))
    all_ = used.agg(F.greatest(F.coalesce(F.sum("used_tokens"), F.lit(0)), F.lit(1)).alias("all"))
    shares = used.join(F.broadcast(all_)).select(
        "source",
        "target_share",
        (F.col("used_tokens") / F.col("all")).alias("actual_share"),
        F.col("size").alias("available_tokens"),
        "used_tokens",
        F.when(F.col("size") > 0, F.col("used_tokens") / F.col("size")).otherwise(0.0).alias("epochs"),
    )
    return chosen.select("doc_id", "source", "n_tokens", "repeats"), shares


def available(plan: list[Target]) -> float:
    """As many tokens as the sources hold together."""
    return float(sum(t.size for t in plan))


@query("p9_chosen")
def p9_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


@query("p9_shares")
def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


@query("p9_filled_chosen")
def p9_filled_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix as large as all sources together; those that can't fill their share are clamped at their cap."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), available)[0]


@query("p9_filled_shares")
def p9_filled_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"), available)[1]
