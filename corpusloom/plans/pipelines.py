"""The five curation pipelines as declared steps over packages."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import content as C
from corpusloom.operators import filters as R
from corpusloom.operators.dedup import choose, similar_pairs
from corpusloom.operators.normalizers import apply_normalizers
from corpusloom.operators.scoring import bigram_scores
from corpusloom.session import cut, meet
from corpusloom.sources.sinks import write_text

#: Steps in order: ("filter", names), ("normalize", names), ("exact",), ("fuse",), ("near", keep).
PIPELINES: dict[str, list[tuple]] = {
    "ocr": [
        ("filter", ("num_tokens", "tv_tables", "language")),
        ("normalize", ("unicode", "anonymize", "common_errors", "strip_string")),
        ("exact",),
        ("near", "score"),
    ],
    "plain": [
        ("filter", ("num_tokens", "language")),
        ("normalize", ("unicode", "moses", "anonymize")),
        ("filter", ("num_tokens", "unicode", "language")),
        ("exact",),
        ("near", "first"),
    ],
    "fuse": [("filter", ("language",)), ("normalize", ("unicode", "anonymize")), ("filter", ("language",)), ("exact",), ("fuse",), ("near", "first")],
    "split": [("filter", ("language",)), ("normalize", ("unicode", "anonymize")), ("exact",), ("fuse",), ("filter_no_breaks", ("num_tokens",)), ("near", "first")],
    "audit": [("filter", ("language",)), ("normalize", ("unicode", "moses", "anonymize")), ("filter", ("language",)), ("exact",)],
}


def run_pipeline(
    packages: DataFrame,
    name: str,
    key: str,
    provider: Callable[[Column], Column],
    target: str = "sv",
    errors: Mapping[str, str] | None = None,
    least_tokens: int = 30,
    export: str | None = None,
) -> DataFrame:
    """Packages after the steps of a pipeline; ``key`` must be unique.

    Filters run in their fixed order and leave breaks; near duplicates are
    resolved over the texts that are left, by the lowest perplexity under their
    own bigram model where a step says ``score``, and packages that keep nothing have
    an empty content.  With ``export`` the texts are also written there, one a line.
    """
    specs = {"num_tokens": R.num_tokens(least_tokens), "unicode": R.readable(), "tv_tables": R.tv_tables(), "language": R.language(provider, target)}
    for step, *rest in PIPELINES[name]:
        if step in ("filter", "filter_no_breaks"):
            wanted = R.planned([specs[n] for n in rest[0]])
            packages = C.filter_content(packages, lambda t, w=wanted: R.first_failing(t, w), remove_breaks=step != "filter")
        elif step == "normalize":
            packages = apply_normalizers(packages, list(rest[0]), key, errors=errors)
        elif step == "exact":
            packages = cut(packages)
            docs = C.explode_content(packages, key)
            marked = R.first_of_text(docs, "text", [key, "pos"])
            rows = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text", F.col("_first").alias("keep")))), lambda x: F.struct(x["text"].alias("text"), x["keep"].alias("keep")))
            folded = marked.groupBy(key).agg(C.break_fold(rows).alias("content"))
            packages = meet(packages.drop("content"), folded, key, "left").withColumn("content", F.coalesce("content", F.array().cast("array<string>")))
        elif step == "fuse":
            packages = C.fuse_paragraphs(packages)
        else:
            packages = cut(packages)
            docs = cut(C.explode_content(packages, key).where("text IS NOT NULL").withColumn("doc", C.document_key(F.col(key), F.col("pos"))))
            edges, keep, score = cut(similar_pairs(docs, "doc")), rest[0], None
            rated = docs
            if keep == "score":
                score = "perplexity"
                rated = cut(meet(docs, bigram_scores(docs, "doc").select("doc", score), "doc", "left"))
            kept = meet(docs, choose(rated, edges, "doc", keep=keep, score=score), "doc", "left_semi")
            packages = C.regroup(packages, kept, key)
    if export is not None:
        packages = cut(packages)
        write_text(packages, key, export)
    return packages
