"""A native probabilistic language provider: naive Bayes over hashed character trigrams."""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numbers that trigrams are hashed to; the model has so many weights a language, whatever the corpus.
BUCKETS = 4096


def trigrams(text: Column, buckets: int = BUCKETS) -> Column:
    """Hashes of the character trigrams of a text's letters in lower case, all else as single spaces; by code points, so that any engine can compute them."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))
    codes = F.transform(F.regexp_extract_all(plain, F.lit("(?s)."), F.lit(0)), F.ascii)

    def hashed(c: Column) -> Column:
        n = F.size(c) - 2
        shifted = lambda k: F.slice(c, F.lit(k + 1), F.greatest(n, F.lit(0)))
        pairs = F.zip_with(shifted(0), shifted(1), lambda a, b: (a * 31 + b) % buckets)
        return F.zip_with(pairs, shifted(2), lambda ab, d: (ab * 31 + d) % buckets)

    # the array of one binds the codes, so that they are found once
    return F.transform(F.array(codes), hashed)[0]


def learn(docs: DataFrame, text: str, label: str, labels: list[str], buckets: int = BUCKETS, k: float = 0.5) -> dict[str, list[float]]:
    """Log probabilities of the buckets by label, from all labelled documents: one aggregation, of which ``labels x buckets`` numbers are collected."""
    rows = docs.where(F.col(label).isin(labels) & F.col(text).isNotNull()).select(F.col(label).alias("label"), F.explode(trigrams(F.col(text), buckets)).alias("bucket"))
    counts = {name: [0] * buckets for name in labels}
    for r in rows.groupBy("label", "bucket").agg(F.count("*").alias("n")).collect():
        counts[r["label"]][r["bucket"]] = r["n"]
    return {name: [math.log((n + k) / (sum(c) + k * buckets)) for n in c] for name, c in counts.items()}


def gram_provider(model: dict[str, list[float]]) -> Callable[[Column], Column]:
    """Probabilities of the languages, equally likely before: a provider for the language filter. Text without letters has none."""
    names, buckets = sorted(model), len(next(iter(model.values())))
    # one constant per language; the optimizer makes it an array once
    weights = [F.from_json(F.lit(json.dumps([round(w, 9) for w in model[name]])), "array<double>") for name in names]

    def probabilities(grams: Column) -> Column:
        start = F.struct(*(F.lit(0.0).alias(name) for name in names))
        sums = F.aggregate(grams, start, lambda s, g: F.struct(*((s[name] + F.get(w, g)).alias(name) for name, w in zip(names, weights))))
        softmax = lambda s: F.array(
            *(F.struct(F.lit(a).alias("label"), (F.lit(1.0) / sum((F.exp(F.least(s[b] - s[a], F.lit(700.0))) for b in names), F.lit(0.0))).alias("prob")) for a in names)
        )
        return F.when(F.size(grams) > 0, F.transform(F.array(sums), softmax)[0]).otherwise(F.array().cast("array<struct<label: string, prob: double>>"))

    return lambda text: F.transform(F.array(trigrams(text, buckets)), probabilities)[0]
