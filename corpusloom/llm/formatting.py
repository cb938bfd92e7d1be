"""Problem 7: collapse contents that differ only in typography or field order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.fields import FIELD, labelled_fields, plain_text, same_letters
from corpusloom.llm.registry import query
from corpusloom.session import cut, meet, table

#: The multiset hash adds field hashes modulo this prime, so no sum overflows.
PRIME = (1 << 61) - 1


def multiset_hash(fields: Column, seed: int) -> Column:
    """Sum of the hashes of all (label, value) pairs: the same in any order, different for other multiplicities."""
    added = lambda acc, x: (acc + F.pmod(F.xxhash64(F.lit(seed), x["label"], x["value"]), F.lit(PRIME))) % PRIME
    return F.aggregate(fields, F.lit(0).cast("long"), added)


def fingerprints(df: DataFrame, key: str, content: str, seed: int) -> DataFrame:
    """``(key, h, f1, f2, fields)`` of every content that isn't null or blank.

    ``h`` is the SHA-256 of the letters and digits in their order, ``f`` a
    multiset hash of the labelled fields, null for other content.
    """
    texts = df.select(F.col(key), plain_text(F.col(content)).alias("text"))
    texts = texts.where(F.col("text").rlike(r"[^\s\p{Z}]"))
    rows = texts.select(key, F.unhex(F.sha2(same_letters(F.col("text")), 256)).alias("h"), labelled_fields(F.col("text")).alias("fields"))
    return rows.select(key, "h", multiset_hash(F.col("fields"), seed).alias("f1"), multiset_hash(F.col("fields"), -seed).alias("f2"), "fields")


def unequal_fields(rows: DataFrame) -> DataFrame:
    """Field fingerprints ``(f1, f2)`` whose members don't all hold the same fields equally often.

    Verified without sorting and without comparing pairs: if the members of a
    fingerprint hold the same fields, every (label, value) is in all of them,
    and as often in each.  Members of one spelling hold the same fields, so one
    counts for all.
    """
    members = rows.where("f1 IS NOT NULL").select("h", "f1", "f2", "fields").distinct()
    spelled = members.groupBy("f1", "f2").agg(F.count("*").alias("members")).where("members > 1")
    one = meet(members, spelled, ["f1", "f2"]).select("h", "f1", "f2", "members", F.monotonically_increasing_id().alias("member"), F.explode("fields").alias("field"))
    times = one.groupBy("f1", "f2", "members", "member", "field").agg(F.count("*").alias("times"))
    over = times.groupBy("f1", "f2", "members", "field").agg(F.count("*").alias("holders"), F.min("times").alias("least"), F.max("times").alias("most"))
    return over.where("holders <> members OR least <> most").select("f1", "f2").distinct()


def classes(df: DataFrame, key: str = "box_id", content: str = "content", seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """``(key, h)`` of every row with content, and ``(h, label, first, n)`` of every spelling: its content, smallest key and number of rows.

    The table is read once; fingerprints go to the shared folder.  Rows of one
    spelling combine before the shuffle, by hash and without a sort, so that a
    content of a third of all rows is one row per task there.  Spellings of
    labelled fields meet by their multiset fingerprint, whose equality
    ``unequal_fields`` verifies; should any hold unequal members, all is hashed
    anew with the next seed.  Spellings with a fingerprint in common, and those
    these have one in common with, take the smallest key among them as label;
    all others are contents of their own, with a null label.
    """
    for seed in range(seed, seed + 8):
        rows = cut(fingerprints(df, key, content, seed))
        if unequal_fields(rows).isEmpty():
            break
    else:
        raise RuntimeError("no seed gives each content its own fingerprint")
    spellings = cut(rows.groupBy("h").agg(F.min(key).alias("first"), F.count("*").alias("n")))
    of_fields = rows.where("f1 IS NOT NULL").select("h", "f1", "f2").distinct()
    several = of_fields.groupBy("f1", "f2").agg(F.count("*").alias("spellings")).where("spellings > 1").drop("spellings")
    of_fields = cut(meet(of_fields, several, ["f1", "f2"]))
    labels = cut(meet(spellings.where("first IS NOT NULL"), of_fields.select("h").distinct(), "h", "left_semi").select("h", F.col("first").alias("label")))
    while True:
        least = meet(of_fields, labels, "h").groupBy("f1", "f2").agg(F.min("label").alias("least"))
        least = meet(of_fields, least, ["f1", "f2"]).groupBy("h").agg(F.min("least").alias("least"))
        after = cut(meet(least, labels, "h", "left").select("h", F.col("least").alias("label"), (~F.col("least").eqNullSafe(F.col("label"))).alias("moved")))
        labels = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    return rows.select(key, "h"), meet(spellings, labels, "h", "left")


def collapse(df: DataFrame, key: str = "box_id", content: str = "content") -> DataFrame:
    """One row per content: ``(first_<key>, n_copies)``, the smallest key that has it and how many rows do.

    Contents are the same if they have the same letters and digits in the same
    order whatever the case, white space and punctuation, or are made of the
    same labelled fields (four or more) in any order.  Null and blank contents
    don't count; content without letters and digits is compared by its signs.
    Repeated rows count as copies, null keys too, though they are nobody's
    first.  An empty table gives no rows.
    """
    spellings = classes(df, key, content)[1]
    alone = spellings.where("label IS NULL").select(F.col("first").alias(f"first_{key}"), F.col("n").alias("n_copies"))
    labelled = spellings.where("label IS NOT NULL").groupBy(F.col("label").alias(f"first_{key}")).agg(F.sum("n").alias("n_copies"))
    return alone.unionByName(labelled)


def copies(df: DataFrame, key: str = "box_id", content: str = "content") -> DataFrame:
    """Every key that isn't the first with its content, beside that first: ``(first_<key>, key)``."""
    rows, spellings = classes(df, key, content)
    repeated = spellings.where("n > 1 OR label IS NOT NULL").select("h", F.coalesce("label", "first").alias(f"first_{key}"))
    pairs = meet(rows, repeated, "h").select(f"first_{key}", key)
    return pairs.where(F.col(key) > F.col(f"first_{key}")).distinct()


_CANONICAL = r"""
    texts AS (
        SELECT box_id,
            CASE WHEN regexp_matches(content, '^\s*\[') AND json_valid(content)
                THEN array_to_string(from_json(content, '["VARCHAR"]'), chr(10)) ELSE content END AS text
        FROM boxes WHERE regexp_matches(content, '[^\s\p{Z}]')
    ),
    parts AS (
        SELECT box_id, text, lower(regexp_replace(text, '[^\p{L}\p{M}\p{N}]+', '', 'g')) AS bare,
            list_filter(regexp_split_to_array(text, '[\r\n;|]+'), lambda x: regexp_matches(x, '[\p{L}\p{N}]')) AS parts
        FROM texts
    ),
    canonical AS (
        SELECT box_id,
            CASE WHEN len(parts) >= 4 AND len(list_filter(parts, lambda x: NOT regexp_matches(x, 'FIELD'))) = 0
                THEN 'fields' || array_to_string(list_sort(list_transform(parts, lambda x:
                    lower(regexp_replace(regexp_extract(x, 'FIELD', 1), '[^\p{L}\p{M}\p{N}]+', '', 'g')) || ':' ||
                    lower(regexp_replace(regexp_extract(x, 'FIELD', 2), '[^\p{L}\p{M}\p{N}]+', '', 'g')))), '|')
                WHEN bare <> '' THEN bare
                ELSE regexp_replace(text, '[\s\p{Z}]+', '', 'g') END AS same
        FROM parts
    )""".replace("FIELD", FIELD)

P7_FOUND_SQL = f"""WITH {_CANONICAL}, firsts AS (
    SELECT box_id, min(box_id) OVER (PARTITION BY same) AS first_box_id FROM canonical
) SELECT DISTINCT first_box_id, box_id FROM firsts WHERE box_id > first_box_id"""

P7_COPIES_SQL = f"""WITH {_CANONICAL}
SELECT min(box_id) AS first_box_id, count(*) AS n_copies FROM canonical GROUP BY same"""


@query("p7_found", P7_FOUND_SQL)
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "boxes"))


@query("p7_copies", P7_COPIES_SQL)
def p7_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "boxes"))
