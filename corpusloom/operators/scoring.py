"""Language-model scores of documents: perplexity, a native bigram model, and the score by which copies are chosen."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.patterns import WS
from corpusloom.functions.text import sentences
from corpusloom.operators.content import document_key, explode_content
from corpusloom.session import cut, meet, ship


def perplexity(log10: Column, length: Column) -> Column:
    """``10 ^ (-log10 / length)``; null for length 0."""
    return F.when(length > 0, F.pow(F.lit(10.0), -log10 / length))


def length_discount(words: Column) -> Column:
    """``10 ^ ln(words)``; null for no words."""
    return F.when(words > 0, F.pow(F.lit(10.0), F.ln(words.cast("double"))))


def choice_score(score: Column, words: Column) -> Column:
    """Perplexity by the length discount; lower is better, null (no text or no score) ranks last."""
    return score / length_discount(words)


def _tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    words = F.filter(F.split(F.lower(text), f"[{WS}]+"), lambda w: w != "")
    return docs.select(F.col(key), F.posexplode(words).alias("pos", "w"))


def unigram_scores(docs: DataFrame, key: str, text: str = "text", k: float = 1.0) -> DataFrame:
    """``(key, words, perplexity)`` under the corpus' own unigram model with add-k smoothing.

    Counts are one aggregation over all documents; words meet their counts by a
    shuffle join after they are counted per document, so that frequent words
    travel once per document.
    """
    tokens = _tokens(docs, key, text).groupBy(key, "w").agg(F.count("*").alias("n"))
    counts = tokens.groupBy("w").agg(F.sum("n").alias("c"))
    total = counts.agg(F.sum("c").alias("total"), F.count("*").alias("types"))
    scored = meet(tokens, counts, "w").join(F.broadcast(total))
    log10 = F.sum(F.col("n") * F.log10((F.col("c") + F.lit(k)) / (F.col("total") + F.lit(k) * F.col("types"))))
    found = scored.groupBy(key).agg(F.sum("n").alias("words"), log10.alias("log10"))
    return found.select(key, "words", F.round(perplexity(F.col("log10"), F.col("words")), 4).alias("perplexity"))


def _bigrams(chains: DataFrame, key: str, k: float) -> DataFrame:
    """``(key, words, log10)`` of rows ``(key, c)`` of chains that begin with ``<s>``, under the model of all of them."""
    pairs = F.zip_with(F.slice("c", F.lit(1), F.size("c") - 1), F.slice("c", F.lit(2), F.size("c") - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    one = chains.where("size(c) > 1").select(key, F.explode(pairs).alias("p")).groupBy(key, "p.a", "p.b").agg(F.count("*").alias("n"))
    both = one.groupBy("a", "b").agg(F.sum("n").alias("ab"))
    first = both.groupBy("a").agg(F.sum("ab").alias("a_total"))
    types = both.agg(F.count_distinct("b").alias("types"))
    # the totals meet the distinct pairs, of which a frequent word has fewer than occurrences
    scored = meet(one, meet(both, first, "a"), ["a", "b"]).join(F.broadcast(types))
    log10 = F.sum(F.col("n") * F.log10((F.col("ab") + F.lit(k)) / (F.col("a_total") + F.lit(k) * F.col("types"))))
    return scored.groupBy(key).agg(F.sum("n").alias("words"), log10.alias("log10"))


def _chain(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), f"[{WS}]+"), lambda w: w != "")
    return F.concat(F.array(F.lit("<s>")), words)


def bigram_scores(docs: DataFrame, key: str, text: str = "text", k: float = 0.1) -> DataFrame:
    """``(key, words, perplexity)`` under a bigram model with add-k smoothing, from all documents; ``<s>`` begins each."""
    found = _bigrams(docs.select(F.col(key), _chain(F.col(text)).alias("c")), key, k)
    return found.select(key, "words", F.round(perplexity(F.col("log10"), F.col("words")), 4).alias("perplexity"))


def sentence_scores(docs: DataFrame, key: str, text: str = "text", k: float = 0.1) -> DataFrame:
    """``(key, score)`` of every document, sentence by sentence under the bigram model of all sentences.

    The perplexity over the words of all its sentences, to one decimal; -1 for a
    null text and for one without a sentence.  Keys must be unique.
    """
    chains = docs.select(F.col(key), F.explode(sentences(F.col(text))).alias("s")).select(key, _chain(F.col("s")).alias("c"))
    found = _bigrams(chains, key, k).select(key, F.round(perplexity(F.col("log10"), F.col("words")), 1).alias("score"))
    return meet(docs.select(key), found, key, "left").select(key, F.coalesce("score", F.lit(-1.0)).alias("score"))


def model_scores(docs: DataFrame, key: str, load: Callable[[], tuple[Callable, Callable]], text: str = "text", by_sentence: bool = False) -> DataFrame:
    """``(key, score)`` of every document under a model of the caller's, in Arrow batches.

    ``load()`` is called once per task and gives ``(tokenize, log10)``: tokens of
    a text, and the logarithm of the probability of a list of tokens.  The score
    is the perplexity per token, negative infinity for a null or empty text; by
    sentence their logarithms are added up, the perplexity has one decimal, and
    text without a sentence has -1.
    """
    key_type = docs.schema[key].dataType.simpleString()
    parts = sentences(F.col(text)) if by_sentence else F.when(F.length(text) > 0, F.array(text))

    def rate(tokenize, log10, texts):
        if not texts:
            return -1.0 if by_sentence else -math.inf
        tokens = [tokenize(t) for t in texts]
        n = sum(map(len, tokens))
        score = 10.0 ** (-sum(map(log10, tokens)) / n) if n else -1.0 if by_sentence else -math.inf
        return round(score, 1) if by_sentence else score

    def run(batches):
        tokenize, log10 = load()
        for batch in batches:
            found = [rate(tokenize, log10, texts) for texts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[key, "score"])

    ship(docs.sparkSession)
    return docs.select(F.col(key), parts.alias("parts")).mapInArrow(run, f"`{key}` {key_type}, score double")


def cut_by_perplexity(packages: DataFrame, key: str, below: float = 430.0, scorer=bigram_scores) -> DataFrame:
    """``(key, content, scores)``: packages with the texts whose perplexity under ``scorer`` is below the limit; null texts have none."""
    docs = cut(explode_content(packages, key).where("text IS NOT NULL").withColumn("doc", document_key(F.col(key), F.col("pos"))))
    scores = scorer(docs, "doc").withColumnRenamed("perplexity", "score")
    return scored_packages(meet(docs, scores.select("doc", "score"), "doc"), key, below)


def with_scores(docs: DataFrame, scores: DataFrame, on: list[str], score: str = "score") -> DataFrame:
    """Documents with their score, null where there is none."""
    return meet(docs, scores.select(*on, score), on, "left")


def scored_packages(docs: DataFrame, package: str, below: float = 430.0) -> DataFrame:
    """``(package, content, scores)``: the texts whose score is below the limit, in order, with their scores."""
    kept = docs.where(F.col("score") < below)
    rows = F.array_sort(F.collect_list(F.struct("pos", "text", "score")))
    found = kept.groupBy(package).agg(rows.alias("rows"))
    return found.select(package, F.transform("rows", lambda r: r["text"]).alias("content"), F.transform("rows", lambda r: r["score"]).alias("scores"))


def incomplete(scores: DataFrame, package: str) -> DataFrame:
    """Number of packages with any missing score."""
    gaps = scores.groupBy(package).agg(F.max(F.col("score").isNull().cast("int")).alias("gap"))
    return gaps.agg(F.count("*").alias("packages"), F.sum("gap").alias("incomplete"))

