"""Problem 4: one form for texts that look the same but differ in their characters.

Text is cut into plain stretches and clusters around unusual code points; the
clusters are exploded to positioned code points, joined with broadcast tables of
decompositions and look-alikes, their combining marks ordered by class,
recomposed, and the strings rebuilt.  The tables are functions of the Unicode
database, so their size is bounded whatever the data.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import glyphs as G
from corpusloom.llm.glyphs import character_class, compositions, joining, one_form
from corpusloom.llm.registry import query
from corpusloom.session import cut, meet, table

#: Code points that change in no context but before a mark.
_PLAIN = r"\x00-\x7FÀ-ÖØ-öø-ÿ"
_JOIN = character_class(joining())
#: A code point that may change, with all that joins it: the longest stretch in which a change can reach.
CLUSTER = f"(?![{_PLAIN}])[^{_JOIN}](?:(?![{_PLAIN}])[{_JOIN}])*|[{_PLAIN}]?(?:(?![{_PLAIN}])[{_JOIN}])+"
_EACH = r"(?s)."
#: Letters of scripts whose words keep their own letters in readable text.
_OWN = r"[\p{IsGreek}\p{IsCyrillic}\p{IsArmenian}\p{IsCherokee}]"


def decomposition_table(spark: SparkSession, letters: bool = True) -> DataFrame:
    """``(ch, parts)``: code points that change, and the code points they become."""
    rows = [(chr(c), list(s)) for c, s in one_form(letters).items()]
    return spark.createDataFrame(rows, "ch string, parts array<string>")


def mark_table(spark: SparkSession) -> DataFrame:
    """``(c, ccc, joins)``: code points that follow a starter, their combining class, and what they compose to by starter."""
    joins: dict[str, list] = {}
    for pair, whole in compositions().items():
        joins.setdefault(pair[1], []).append((pair[0], whole))
    marks = {chr(c) for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))} | set(joins)
    rows = [(c, unicodedata.combining(c), sorted(joins.get(c, []))) for c in sorted(marks)]
    return spark.createDataFrame(rows, "c string, ccc int, joins array<struct<starter: string, whole: string>>")


def syllable(starter: Column, c: Column) -> Column:
    """The Korean syllable of a leading letter and a vowel, or of one without and a trailing letter; null of anything else."""
    a, b = F.ascii(starter), F.ascii(c)
    every = F.lit("".join(map(chr, range(G.SYLLABLE, G.SYLLABLE + G.LEADINGS * G.VOWELS * G.TRAILINGS))))
    first = ((a - G.LEADING) * G.VOWELS + b - G.VOWEL) * G.TRAILINGS
    with_vowel = a.between(G.LEADING, G.LEADING + G.LEADINGS - 1) & b.between(G.VOWEL, G.VOWEL + G.VOWELS - 1)
    last = a - G.SYLLABLE
    open_ = last.between(0, G.LEADINGS * G.VOWELS * G.TRAILINGS - 1) & (last % G.TRAILINGS == 0)
    with_trailing = open_ & b.between(G.TRAILING + 1, G.TRAILING + G.TRAILINGS - 1)
    at = F.when(with_vowel, first).when(with_trailing, last + b - G.TRAILING)
    # a cheap look keeps all but Korean letters out
    return F.when(b.between(G.VOWEL, G.TRAILING + G.TRAILINGS - 1), F.when(at.isNotNull(), F.substring(every, at + 1, F.lit(1))))


def recomposed(points: Column) -> Column:
    """The string of sorted ``struct<..., c, ccc, joins>`` code points of a cluster, by canonical composition.

    ``done`` is finished text, ``starter`` the last starter, ``held`` the marks
    after it that didn't join, ``last`` the class of the last of these.
    """
    state = F.struct(
        F.lit("").alias("done"), F.lit("").alias("starter"), F.lit("").alias("held"), F.lit(0).alias("last")
    )

    def step(s: Column, p: Column) -> Column:
        free = (s["starter"] != "") & F.when(s["held"] == "", True).otherwise((s["last"] < p["ccc"]) & (p["ccc"] > 0))
        joined_ = F.get(F.filter(p["joins"], lambda j: j["starter"] == s["starter"]), F.lit(0))["whole"]
        whole = F.when(free, F.when(p["joins"].isNotNull(), joined_).otherwise(syllable(s["starter"], p["c"])))
        joined = F.struct(s["done"].alias("done"), whole.alias("starter"), s["held"].alias("held"), s["last"].alias("last"))
        begun = F.struct(
            F.concat(s["done"], s["starter"], s["held"]).alias("done"),
            p["c"].alias("starter"),
            F.lit("").alias("held"),
            F.lit(0).alias("last"),
        )
        marked = F.struct(
            s["done"].alias("done"),
            s["starter"].alias("starter"),
            F.concat(s["held"], p["c"]).alias("held"),
            p["ccc"].alias("last"),
        )
        return F.when(whole.isNotNull(), joined).when(p["ccc"] == 0, begun).otherwise(marked)

    long = F.aggregate(points, state, step, lambda s: F.concat(s["done"], s["starter"], s["held"]))
    # most clusters are one code point
    return F.when(F.size(points) <= 1, F.coalesce(F.get(points, F.lit(0))["c"], F.lit(""))).otherwise(long)


def in_mark_order(points: Column) -> Column:
    """Code points of a cluster sorted by place, with the marks after each starter by combining class (stable)."""
    placed = F.array_sort(points)
    # the number of starters so far keeps each run of marks behind its starter
    run = lambda k: F.size(F.filter(F.slice(placed, F.lit(1), k + 1), lambda p: p["ccc"] == 0))
    numbered = F.transform(
        placed, lambda p, k: F.struct(run(k).alias("run"), p["ccc"].alias("ccc"), p["i"].alias("i"), p["m"].alias("m"), p["c"].alias("c"), p["joins"].alias("joins"))
    )
    several = F.size(F.filter(points, lambda p: p["ccc"] > 0)) > 1
    bare = F.transform(placed, lambda p: F.struct(F.lit(0).alias("run"), p["ccc"].alias("ccc"), p["i"].alias("i"), p["m"].alias("m"), p["c"].alias("c"), p["joins"].alias("joins")))
    return F.when(several, F.array_sort(numbered)).otherwise(bare)


def cluster_forms(texts: DataFrame, letters: bool = True) -> DataFrame:
    """``(h, forms)`` of distinct ``(h, clusters)``: the clusters in one form, in order."""
    spark = texts.sparkSession
    clusters = texts.select("h", F.posexplode("clusters").alias("k", "cluster"))
    points = clusters.select("h", "k", F.posexplode(F.regexp_extract_all("cluster", F.lit(_EACH), F.lit(0))).alias("i", "ch"))
    points = points.join(F.broadcast(decomposition_table(spark, letters)), "ch", "left")
    parts = F.coalesce("parts", F.array("ch"))
    points = points.select("h", "k", "i", F.posexplode_outer(parts).alias("m", "c"))
    points = points.join(F.broadcast(mark_table(spark)), "c", "left")
    point = F.struct("i", F.coalesce("m", F.lit(0)).alias("m"), "c", F.coalesce("ccc", F.lit(0)).alias("ccc"), "joins")
    # one exchange serves both levels of grouping
    points = points.select("h", "k", F.when(F.col("c").isNotNull(), point).alias("point")).repartition("h")
    one = points.groupBy("h", "k").agg(F.collect_list("point").alias("points"))
    one = one.select("h", "k", recomposed(in_mark_order(F.col("points"))).alias("form"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "form"))), lambda x: x["form"])
    return one.groupBy("h").agg(ordered.alias("forms"))


def digest(text: Column) -> Column:
    """SHA-256, by which equal texts meet without travelling."""
    return F.unhex(F.sha2(text, 256))


def one_form_texts(df: DataFrame, keep: list[str], content: str = "content", out: str = "form", letters: bool = True) -> DataFrame:
    """The columns ``keep``, the content, and the content in one form.

    Full-width and other compatibility letters become plain, look-alike letters
    of other scripts Latin (unless ``letters`` is false), all spaces plain, line
    ends ``\\n``; invisible characters go, and marks and Korean letters are
    composed with their letters.  Superscripts, fractions and circled characters
    look different and stay.  Null stays null and empty stays empty; repeated
    rows are kept; case, white space and everything plain stay as they are.
    Text of plain characters only isn't shuffled; of the rest each distinct
    content is treated once.
    """
    text = F.regexp_replace(F.col(content), "\\r\\n?", "\n")
    rows = df.select(*keep, F.col(content).alias("_content"), text.alias("_text"))
    unusual = F.coalesce(F.col("_text").rlike(f"[^{_PLAIN}]"), F.lit(False))
    plain = rows.where(~unusual).select(*keep, F.col("_content").alias(content), F.col("_text").alias(out))
    rest = rows.where(unusual).withColumn("h", digest(F.col("_text")))
    clusters = F.regexp_extract_all("_text", F.lit(CLUSTER), F.lit(0))
    forms = cluster_forms(rest.select("h", clusters.alias("clusters")).distinct(), letters)
    between = F.split("_text", CLUSTER, -1)
    rebuilt = F.array_join(F.zip_with(between, F.concat("forms", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = meet(rest, forms, "h").select(*keep, F.col("_content").alias(content), rebuilt.alias(out))
    return plain.unionByName(changed)


def readable_texts(df: DataFrame, key: str, content: str = "content") -> DataFrame:
    """``(key, form, text)``: the form by which texts compare, and a text to read, in which words of one script keep their letters.

    In ``text`` look-alikes become Latin only in words that also have Latin
    letters; all else is as in the form.
    """
    forms = one_form_texts(df, [key], content)
    own = one_form_texts(forms, [key, "form"], content, "text", letters=False)
    # no look-alike is a space, so the words of both are the same in number
    word = lambda mine, plain: F.when(mine.rlike(_OWN) & mine.rlike(r"\p{IsLatin}"), plain).otherwise(mine)
    words = F.zip_with(F.split("text", "(?<=\\s)|(?=\\s)", -1), F.split("form", "(?<=\\s)|(?=\\s)", -1), word)
    return own.select(key, "form", F.when(F.col("text") == F.col("form"), F.col("text")).otherwise(F.array_join(words, "")).alias("text"))


def spellings(df: DataFrame, key: str, content: str) -> tuple[DataFrame, DataFrame]:
    """``(key, f, h)`` of every row with content, digests of its form and of itself, and the distinct ``(f, h, first, n)``."""
    rows = one_form_texts(df.where(F.col(content).rlike(r"[^\s\p{Z}]")), [key], content)
    rows = cut(rows.where(F.col("form").rlike(r"\S")).select(F.col(key), digest(F.col("form")).alias("f"), digest(F.col(content)).alias("h")))
    return rows, cut(rows.groupBy("f", "h").agg(F.min(key).alias("first"), F.count("*").alias("n")))


def look_alike_pairs(df: DataFrame, key: str = "crawl_id", content: str = "content") -> DataFrame:
    """Every pair of keys whose contents have the same form but not the same characters: ``(key_a, key_b)``.

    Contents that are null or blank don't count.  Spellings of a form meet by
    its digest; the keys of two of them are then paired, so that the work grows
    with the pairs that come out, and copies of one spelling never meet.
    """
    rows, spelled = spellings(df, key, content)
    several = spelled.groupBy("f").agg(F.count("*").alias("spellings")).where("spellings > 1").select("f")
    forms = meet(spelled.select("f", "h"), several, "f", "left_semi")
    two = meet(forms.select("f", F.col("h").alias("h_a")), forms.select("f", F.col("h").alias("h_b")), "f").where("h_a < h_b").select("h_a", "h_b")
    pairs = meet(two, rows.select(F.col("h").alias("h_a"), F.col(key).alias("x")), "h_a")
    pairs = meet(pairs, rows.select(F.col("h").alias("h_b"), F.col(key).alias("y")), "h_b").where("x <> y")
    return pairs.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def look_alike_classes(df: DataFrame, key: str = "crawl_id", content: str = "content") -> DataFrame:
    """``(key, class_id, links)`` of every row with content: the smallest key of its form, and how many rows look the same but are spelt otherwise."""
    rows, spelled = spellings(df, key, content)
    forms = spelled.groupBy("f").agg(F.min("first").alias("class_id"), F.sum("n").alias("all"))
    found = meet(meet(rows, spelled.select("f", "h", "n"), ["f", "h"]), forms, "f")
    return found.select(key, "class_id", (F.col("all") - F.col("n")).alias("links"))


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_pairs(table(spark, sf_dir, "crawl"))


@query("p4_forms")
def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readable_texts(table(spark, sf_dir, "crawl"), "crawl_id")


@query("p4_classes")
def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_classes(table(spark, sf_dir, "crawl"))
