"""Problem 6: the language of texts and of their deviating segments, with a confidence.

Character language models with interpolated Kneser-Ney smoothing, one per
language, are kept together in sorted arrays of n-gram hashes with one column of
log probabilities per language, so that one binary search per position serves
all languages.  A segment has the language of lowest cross-entropy per
character; a logistic calibration on cuts of held-out segments turns margin and
length into a confidence, below which the segment goes with its record.  Text
that no model explains better than it explains the other languages is rejected.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.glyphs import invisible, look_alikes
from corpusloom.llm.registry import query
from corpusloom.session import ship, table

#: How labels name the six languages.
NAMES = {
    "sv": "sv swe swedish svenska",
    "en": "en eng english engelska",
    "de": "de ger deu german deutsch tyska",
    "fr": "fr fre fra french français franska",
    "fi": "fi fin finnish suomi finska",
    "da": "da dan danish dansk danska",
}
#: Labels that name no language.
NO_LANGUAGE = "und unk unknown xx xxx zxx mul mis null none n/a - ?".split()
LANGUAGES = tuple(NAMES)
ORDER = 4
#: Bounds of the labelled sample: texts per language and characters per text.
SAMPLE_TEXTS = 300
SAMPLE_CHARS = 4000
#: What a text is labelled that is in none of the languages.
UNKNOWN = "und"
#: Below this confidence a segment is given the language of its record.
REJECT = 0.9
#: Lengths of the cuts on which confidence is calibrated.
CUTS = (8, 14, 25, 60)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_OTHER = re.compile(r"[\W\d_]+")


def label_language(label: Column) -> Column:
    """The language a label names: one of the six, null where it names none, else ``other``."""
    low = F.lower(F.trim(label))
    head = F.split(low, "[-_]")[0]
    found = F.when(low.isNull() | (low == "") | low.isin(NO_LANGUAGE), None)
    for code, names in NAMES.items():
        found = found.when(head.isin(names.split()) | low.isin(names.split()), code)
    return found.otherwise("other")


_PLAIN = None


def normal(text: str) -> str:
    """Letters in one form and case, everything else a single space."""
    global _PLAIN
    if not text.isascii():
        if _PLAIN is None:
            _PLAIN = str.maketrans({**{c: "" for c in invisible()}, **look_alikes()})
        text = unicodedata.normalize("NFKC", text).translate(_PLAIN)
    return _OTHER.sub(" ", text.lower()).strip()


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each after enough spaces for a first context, and where each text begins."""
    pad = " " * (ORDER - 1)
    joined = "".join(pad + t + " " for t in texts)
    sizes = np.fromiter((len(t) + ORDER for t in texts), np.int64, len(texts))
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), np.cumsum(sizes) - sizes


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """``h[n][i]``: hash of the n code points that end at i; h[0] is 0."""
    out = [np.zeros(len(codes), np.uint64)]
    for _ in range(ORDER):
        before = np.r_[np.zeros(1, np.uint64), out[-1][:-1]]
        out.append((before + np.uint64(1)) * _MULTIPLIER ^ (codes + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F))
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of the wanted hashes in the sorted keys; -1 where missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Models:
    """Per order n: sorted hashes of n-grams with log probabilities, and of contexts with log back-off weights."""

    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    unseen: float = -14.0
    calibration: tuple[float, float, float] = (-2.0, 40.0, 0.3)
    foreign: float = float("inf")

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy in nats per character of each text by language, and the texts' lengths."""
        codes, starts = _codes(texts)
        h = _hashes(codes)
        before = [np.r_[np.zeros(1, np.uint64), x[:-1]] for x in h]
        total = np.zeros((len(codes), len(LANGUAGES)), np.float32)
        left = np.arange(len(codes))
        for n in range(ORDER, 0, -1):
            at = _find(self.keys[n - 1], h[n][left])
            hit = at >= 0
            total[left[hit]] += self.logp[n - 1][at[hit]]
            left = left[~hit]
            if n > 1 and len(left):
                at = _find(self.contexts[n - 1], before[n - 1][left])
                known = at >= 0
                total[left[known]] += self.backoff[n - 1][at[known]]
        total[left] += self.unseen
        sizes = np.diff(np.r_[starts, len(codes)])
        inside = np.arange(len(codes)) - np.repeat(starts, sizes) >= ORDER - 1
        total[~inside] = 0
        length = sizes - ORDER + 1
        sums = np.add.reduceat(total, starts, axis=0) if len(texts) else np.zeros((0, len(LANGUAGES)))
        return -sums / length[:, None], length

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language of each text, the confidence in it, and the cross-entropy in nats per character."""
        entropy, length = self.score(texts)
        best = entropy.argmin(1) if len(texts) else np.zeros(0, int)
        pair = np.partition(entropy, 1, axis=1)[:, :2] if len(texts) else np.zeros((0, 2))
        a, b, c = self.calibration
        z = a + (b + c * np.sqrt(length)) * (pair[:, 1] - pair[:, 0])
        return best, np.where(length > 1, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0), pair[:, 0]


def train(texts: list[list[str]]) -> Models:
    """Models of the languages from the normalized segments of each."""
    grams = []  # per language and order: hashes, counts, context and lower-order hash of each distinct n-gram
    for mine in texts:
        codes, starts = _codes(mine)
        h = _hashes(codes)
        inside = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)])) >= ORDER - 1
        levels: list = [None] * (ORDER + 1)
        for n in range(ORDER, 0, -1):
            at = np.flatnonzero(inside)
            keys, first, count = np.unique(h[n][at], return_index=True, return_counts=True)
            at = at[first]
            context = np.where(at > 0, h[n - 1][at - 1], 0).astype(np.uint64)
            if n < ORDER:  # continuation counts: distinct n-grams one longer that end in this one
                ends, longer = np.unique(levels[n + 1][3], return_counts=True)
                count = longer[np.searchsorted(ends, keys)]
            levels[n] = (keys, count.astype(np.float64), context, h[n - 1][at])
        grams.append(levels)
    models = Models()
    lower_keys, lower_p = None, None
    for n in range(1, ORDER + 1):
        keys, first = np.unique(np.concatenate([g[n][0] for g in grams]), return_index=True)
        context = np.concatenate([g[n][2] for g in grams])[first]
        lower = np.concatenate([g[n][3] for g in grams])[first]
        contexts = np.unique(context)
        p = np.zeros((len(keys), len(grams)))
        gamma = np.ones((len(contexts), len(grams)))
        for j, g in enumerate(grams):
            mine, count, ctx, _ = g[n]
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            at = np.searchsorted(contexts, ctx)
            total = np.bincount(at, count, len(contexts))
            kinds = np.bincount(at, minlength=len(contexts))
            seen = total > 0
            gamma[seen, j] = discount * kinds[seen] / total[seen]
            at = _find(keys, mine)
            p[at, j] = np.maximum(count - discount, 0) / total[np.searchsorted(contexts, ctx)]
        base = np.full(p.shape, 1 / (len(keys) + 1)) if n == 1 else lower_p[np.searchsorted(lower_keys, lower)]
        p += gamma[np.searchsorted(contexts, context)] * base
        models.keys.append(keys)
        models.logp.append(np.log(np.maximum(p, 1e-12)).astype(np.float32))
        models.contexts.append(contexts)
        models.backoff.append(np.log(gamma).astype(np.float32))
        lower_keys, lower_p = keys, p
    return models


def calibrate(models: Models, texts: list[str], labels: np.ndarray) -> None:
    """Fit the confidence on held-out segments by logistic regression on margin and length."""
    entropy, length = models.score(texts)
    pair = np.partition(entropy, 1, axis=1)[:, :2]
    margin = pair[:, 1] - pair[:, 0]
    x = np.c_[np.ones(len(texts)), margin, margin * np.sqrt(length)]
    y = (entropy.argmin(1) == labels).astype(float)
    w = np.array(models.calibration)
    scale = np.abs(x).max(0)
    v, x = w * scale, x / scale
    for _ in range(3000):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        v -= 4.0 * (x.T @ (p - y) / len(y) + 1e-4 * np.r_[0, v[1:]])
        v[1:] = np.maximum(v[1:], 0)
    models.calibration = tuple(float(k) for k in v / scale)


def reject_foreign(models: Models, texts: list[str], labels: np.ndarray) -> None:
    """Set the cross-entropy beyond which a text is in none of the languages, from held-out segments.

    A foreign text is to the models what each language is to the models of the
    others: beyond the mean of what the best wrong model gives, no model has
    anything to say for it.
    """
    entropy, _ = models.score(texts)
    entropy[np.arange(len(texts)), labels] = np.inf
    models.foreign = float(entropy.min(1).mean())


def labelled_sample(df: DataFrame, key: str, text: str, label: str, per_language: int = SAMPLE_TEXTS) -> list[tuple[str, str]]:
    """At most about ``per_language`` texts of each language, by the hash of their keys.

    Counting is one distributed aggregation; what is collected is bounded by the
    two sample parameters, not by the table.
    """
    rows = df.select(F.col(key), F.col(text).alias("_text"), label_language(F.col(label)).alias("_lang"))
    rows = rows.where(F.col("_lang").isin(list(LANGUAGES)) & F.length("_text").between(20, SAMPLE_CHARS))
    sizes = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    slot = F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit(0)), F.lit(29)), F.lit(1_000_000))
    wanted = F.lit(0)
    for lang, n in sizes.items():
        wanted = F.when(F.col("_lang") == lang, min(1_000_000, 1_000_000 * per_language // n + 1)).otherwise(wanted)
    rows = rows.withColumn("_slot", slot).where(F.col("_slot") < wanted)
    found = rows.orderBy("_slot", key, "_text").limit(4 * per_language * len(LANGUAGES)).select("_lang", "_text").collect()
    return sorted((r["_lang"], r["_text"]) for r in found)


def learn(sample: list[tuple[str, str]], rounds: int = 2) -> Models:
    """Models from a sample with some wrong labels: segments that the models place elsewhere move there, and all is learned again.

    A fifth of the segments is held out and keeps the labels given.  Those whose
    label the models confirm on the whole segment serve, in short cuts that the
    models may well get wrong, to calibrate confidence and rejection; the rest
    of them is left out, for its label may be wrong.
    """
    segments = [(LANGUAGES.index(lang), s) for lang, text in sample for line in text.split("\n") if len(s := normal(line)) >= 15]
    if not segments:
        segments = [(j, lang) for j, lang in enumerate(LANGUAGES)]
    texts, given = [s for _, s in segments], np.array([j for j, _ in segments])
    held = np.arange(len(texts)) % 5 == 4 if len(texts) >= 100 else np.zeros(len(texts), bool)
    labels = given.copy()
    gather = lambda: [[texts[i] for i in np.flatnonzero((labels == j) & ~held)] or ["x"] for j in range(len(LANGUAGES))]
    models = train(gather())
    for _ in range(rounds):
        labels = models.score(texts)[0].argmin(1)
        models = train(gather())
    if held.any():
        rows = np.flatnonzero(held)
        best = models.score([texts[i] for i in rows])[0].argmin(1)
        rows = rows[best == given[rows]]
        cuts = [(texts[i][a : a + k].strip(), given[i]) for i in rows for k in CUTS for a in (0, len(texts[i]) // 2) if k < len(texts[i])]
        cuts = [(t, j) for t, j in cuts if len(t) > 3]
        if cuts:
            calibrate(models, [t for t, _ in cuts], np.array([j for _, j in cuts]))
            reject_foreign(models, [texts[i] for i in rows], given[rows])
    return models


def identify(df: DataFrame, models: Models, key: str = "crawl_id", text: str = "content") -> DataFrame:
    """``(key, segment_no, lang, confidence)``: each record as segment 0, and its deviating segments.

    A record has the language of most of its segments (lines), on a tie that of
    the more characters; its confidence is the mean of those segments'.  A
    segment deviates if another language is certain enough.  A record is in none
    of the languages (``und``, with the confidence of that language) if more of
    its characters are in segments that no model explains than in others; such
    segments of other records are not given, nor are segments of such a record.  Null and blank
    texts, and texts without letters, give no row; repeated rows give repeated
    rows.  The models, bounded by the sample, are broadcast; no shuffle.
    """
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(models)
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield judge(known, batch.slice(at, 1000))

    def judge(known, batch):
        rows, numbers, lines = [], [], []
        for i, t in enumerate(batch.column(1).to_pylist()):
            if t:
                for no, line in enumerate(t.split("\n"), 1):
                    if s := normal(line):
                        rows.append(i)
                        numbers.append(no)
                        lines.append(s)
        out: tuple[list, ...] = ([], [], [], [])
        best, sure, entropy = known.judge(lines) if lines else (np.zeros(0, int), np.zeros(0), np.zeros(0))
        foreign = entropy > known.foreign
        rows_a, size = np.array(rows, int), np.array([len(s) for s in lines], int)
        ends = np.flatnonzero(np.diff(np.r_[rows_a, -1])) + 1 if lines else []
        a = 0
        for b in ends:
            votes = np.zeros(len(LANGUAGES))
            for j, c, n in zip(best[a:b], sure[a:b], size[a:b]):
                votes[j] += (1 if c >= REJECT else 1e-3) + 1e-9 * n
            top = int(votes.argmax())
            with_top = best[a:b] == top
            out[0].append(rows[a])
            out[1].append(0)
            unknown = (size[a:b] * foreign[a:b]).sum() > size[a:b].sum() / 2
            out[2].append(UNKNOWN if unknown else LANGUAGES[top])
            out[3].append(float(sure[a:b][with_top].mean()))
            for k in np.flatnonzero(~with_top & (sure[a:b] >= REJECT) & ~foreign[a:b] & (not unknown)):
                out[0].append(rows[a])
                out[1].append(numbers[a + k])
                out[2].append(LANGUAGES[best[a + k]])
                out[3].append(float(sure[a + k]))
            a = b
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(out[0], pa.int64())),
                pa.array(out[1], pa.int64()),
                pa.array(out[2], pa.string()),
                pa.array(out[3], pa.float64()),
            ],
            names=[key, "segment_no", "lang", "confidence"],
        )

    schema = f"`{key}` {key_type}, segment_no bigint, lang string, confidence double"
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def crawl_models(spark: SparkSession, sf_dir: str) -> Models:
    """Models learned from a bounded sample of the labelled crawl records and documents."""
    sample = labelled_sample(table(spark, sf_dir, "crawl"), "crawl_id", "content", "lang")
    sample += labelled_sample(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", SAMPLE_TEXTS // 3)
    return learn(sample)


@query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawl = table(spark, sf_dir, "crawl")
    labelled = crawl.select(F.struct("crawl_id", label_language(F.col("lang")).alias("label")).alias("record"), "content")
    found = identify(labelled, crawl_models(spark, sf_dir), "record")
    label = F.col("record.label")
    wanted = (F.col("segment_no") > 0) | label.isNull() | (label != F.col("lang"))
    return found.where(wanted & (F.col("lang") != UNKNOWN)).select("record.crawl_id", "segment_no", "lang").distinct()


@query("p6_languages")
def p6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "crawl"), crawl_models(spark, sf_dir))
