"""Problem 3: one surviving value per field for each group of records of the same package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.registry import query
from corpusloom.session import cut, meet, ship, table

#: What stands in for a missing value.
STAND_INS = ("failed", "no title", "no created", "no edition", "no issue")
FIELDS = ("title", "created", "year", "edition", "issue", "content")
SHINGLE = 5
SIMILARITY = 0.8
#: Orders in which shingles point to contents at once; more of them only leave fewer pairs to compare.
ORDERS = 8
#: Cells of the table of an alignment; larger ones are halved until they fit.
CELLS = 4_000_000
#: Origins are a short configuration table.
MAX_ORIGINS = 10_000


def package_key(package_id: Column) -> Column:
    """One spelling of an id: its last letters and, without leading zeros, its digits; null without any."""
    low = F.lower(F.trim(package_id))
    letters = F.regexp_extract(low, r"(\p{L}+)[^\p{L}\p{N}]*0*([0-9]+)\W*$", 1)
    digits = F.regexp_extract(low, r"(\p{L}+)[^\p{L}\p{N}]*0*([0-9]+)\W*$", 2)
    bare = F.regexp_replace(low, r"[^\p{L}\p{N}]+", "")
    return F.when(digits != "", F.concat(letters, F.lit(":"), digits)).when(bare != "", bare)


def _value(value: Column) -> Column:
    """A text value, or null where it is blank or a stand-in."""
    text = F.trim(value.cast("string"))
    return F.when((text != "") & ~F.lower(text).isin(*STAND_INS), text)


def prepared(records: DataFrame, origins: DataFrame) -> DataFrame:
    """Records with package key, usable values, and ``node``, which names a content within its key.

    A node's high bits are the size of its content, beyond two million
    characters to one part in 131,072, so that a greater node has no less text.
    """
    trust = {r["origin"]: r["trust"] for r in origins.select("origin", "trust").limit(MAX_ORIGINS + 1).collect()}
    if len(trust) > MAX_ORIGINS:
        raise ValueError(f"more than {MAX_ORIGINS} origins")
    pairs = [F.lit(x) for k, v in trust.items() if k is not None for x in (k, v)]
    trusted = F.coalesce(F.create_map(*pairs)[F.col("origin")], F.lit(-1)) if pairs else F.lit(-1)
    boxes = F.filter("content", lambda b: b.rlike(r"[^\s\p{Z}]"))
    meta = lambda f: F.col("meta")[f]
    rows = records.select(
        "rec_id",
        package_key(meta("package_id")).alias("pid"),
        trusted.alias("trust"),
        F.col("received_at").alias("at"),
        *(_value(meta(f)).alias(f) for f in ("title", "created", "edition", "issue")),
        F.when(meta("year") > 0, meta("year").cast("string")).alias("year"),
        F.coalesce(boxes, F.array().cast("array<string>")).alias("boxes"),
    )
    text = F.array_join("boxes", "\n")
    size = F.length(text).cast("long")
    # sizes of at least 2^21 by exponent and 17 bits of mantissa
    over = F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1)) + F.lit(0.5))).cast("int") - 21, F.lit(0))
    mantissa = F.floor(size / F.pow(F.lit(2.0), over + 4)).cast("long")
    coded = F.when(size < 1 << 21, size).otherwise((1 << 21) + over.cast("long") * (1 << 17) + mantissa - (1 << 17))
    node = F.shiftleft(coded, 41) + F.pmod(F.xxhash64("pid", text), F.lit(1 << 41))
    rows = rows.withColumn("node", F.when(size > 0, node)).withColumn("content", F.when(size > 0, text))
    # without an id a record is a package of its own
    alone = F.concat(F.lit("#"), F.col("rec_id").cast("string"))
    return rows.withColumn("pid", F.coalesce("pid", alone))


def shingled(rows: DataFrame) -> DataFrame:
    """``(pid, node, box, sh)``: hashes of the five-word shingles of each box of each distinct content.

    The last word of a box may be cut and isn't used.  A box of three or four
    words before it has these as its only shingle; so that it meets what it was
    cut from, the first three and four words of every box are there as box -1.
    """
    nodes = rows.where("node IS NOT NULL").dropDuplicates(["pid", "node"])
    boxes = nodes.select("pid", "node", F.posexplode("boxes").alias("box", "text"))
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    boxes = boxes.select("pid", "node", "box", words.alias("w"))
    n = F.size("w") - 1
    hashed = lambda start, length: F.xxhash64(F.array_join(F.slice("w", start, length), " "))
    whole = F.transform(F.sequence(F.lit(1), n - SHINGLE + 1), lambda i: hashed(i, F.lit(SHINGLE)))
    few = F.when(n >= 3, F.array(hashed(F.lit(1), n))).otherwise(F.array().cast("array<bigint>"))
    own = boxes.select("pid", "node", "box", F.explode(F.array_distinct(F.when(n >= SHINGLE, whole).otherwise(few))).alias("sh"))
    heads = F.filter(F.array(*(F.when(n >= k, hashed(F.lit(1), F.lit(k))) for k in (3, 4))), lambda h: h.isNotNull())
    return own.unionByName(boxes.select("pid", "node", F.lit(-1).alias("box"), F.explode(heads).alias("sh")))


def content_links(shingles: DataFrame, boxes: DataFrame) -> DataFrame:
    """``(pid, node, to)``: contents of one key that are parts of the same text, as far as one link a shingle and box shows it.

    Every shingle of a key points to the largest content that has it; a box
    whose shingles point to one content for at least four fifths is part of
    that.  Boxes of the same shingles point to the largest content that has one.
    Every link is right, but a box may be part of a content that isn't the
    largest with its shingles: ``content_labels`` finds what is missing.
    """
    own = shingles.where("box >= 0")
    largest = shingles.groupBy("pid", "sh").agg(F.max("node").alias("to"), F.count("*").alias("n")).where("n > 1")
    shared = meet(own, largest, ["pid", "sh"]).groupBy("pid", "node", "box", "to").agg(F.count("*").alias("shared"))
    links = meet(shared, boxes, ["pid", "node", "box"]).where(F.col("shared") >= SIMILARITY * F.col("size"))
    same = boxes.groupBy("pid", "shingles", "size").agg(F.max("node").alias("to"))
    links = links.select("pid", "node", "to").unionByName(meet(boxes, same, ["pid", "shingles", "size"]).select("pid", "node", "to"))
    return links.where("node != to").distinct()


def open_boxes(shingles: DataFrame, boxes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boxes that may be part of a content with another label, and the contents that may have them, by shingle.

    ``(pid, node, box, size, label, sh)`` and ``(pid, sh, to, to_label)``.  At
    least four fifths of such a box's shingles are in contents of other labels;
    others of its shingles aren't returned.  Of boxes of the same shingles, which
    have the same label, one is.
    """
    several = labels.groupBy("pid").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("pid")
    labelled = cut(meet(shingles, meet(labels, several, "pid", "left_semi"), ["pid", "node"]))
    mixed = labelled.groupBy("pid", "sh").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("pid", "sh")
    labelled = cut(meet(labelled, mixed, ["pid", "sh"], "left_semi"))
    own = labelled.where("box >= 0")
    found = meet(own.groupBy("pid", "node", "box").agg(F.count("*").alias("n")), boxes, ["pid", "node", "box"])
    found = found.where(F.col("n") >= SIMILARITY * F.col("size")).groupBy("pid", "shingles", "size").agg(F.max(F.struct("node", "box")).alias("x"))
    open_ = cut(meet(own, found.select("pid", "x.node", "x.box", "size"), ["pid", "node", "box"]))
    held = labelled.select("pid", "sh", F.col("node").alias("to"), F.col("label").alias("to_label")).distinct()
    held = cut(meet(held, open_.select("pid", "sh").distinct(), ["pid", "sh"], "left_semi"))
    return open_.select("pid", "node", "box", "size", "label", "sh"), held


def pointed_links(open_: DataFrame, held: DataFrame, turn: int) -> DataFrame:
    """Links between labels where every shingle points to the first contents of a few orders, others each turn."""
    orders = [F.max(F.struct(F.xxhash64("to", F.lit(turn * ORDERS + i)), "to", "to_label")) for i in range(ORDERS)]
    points = held.groupBy("pid", "sh").agg(F.array_distinct(F.transform(F.array(*orders), lambda x: F.struct(x["to"], x["to_label"]))).alias("x"))
    points = points.select("pid", "sh", F.inline("x").alias("to", "to_label"))
    shared = meet(open_, points, ["pid", "sh"]).where("label != to_label")
    shared = shared.groupBy("pid", "node", "box", "size", "label", "to", "to_label").agg(F.count("*").alias("shared"))
    links = shared.where(F.col("shared") >= SIMILARITY * F.col("size"))
    return links.select("pid", F.col("label").alias("node"), F.col("to_label").alias("to")).distinct()


def every_link(open_: DataFrame, held: DataFrame) -> DataFrame:
    """All links between labels: each box against every content of another label that can have four fifths of its shingles.

    Such a content lacks a fifth at most, so that it has one of the box's
    rarest shingles as soon as these are more than a fifth.
    """
    rare = held.groupBy("pid", "sh").agg(F.count("*").alias("n"))
    box = Window.partitionBy("pid", "node", "box")
    ranked = meet(open_, rare, ["pid", "sh"]).withColumn("place", F.row_number().over(box.orderBy("n", "sh")))
    ranked = ranked.withColumn("k", F.count("*").over(box)).where(F.col("place") <= F.col("k") - F.ceil(SIMILARITY * F.col("size")) + 1)
    pairs = meet(ranked.select("pid", "node", "box", "label", "sh"), held, ["pid", "sh"]).where("label != to_label")
    pairs = cut(pairs.select("pid", "node", "box", "to").distinct())
    mine = open_.groupBy("pid", "node", "box", "size", "label").agg(F.collect_list("sh").alias("mine"))
    theirs = held.groupBy("pid", "to", "to_label").agg(F.collect_list("sh").alias("theirs"))
    both = meet(meet(pairs, mine, ["pid", "node", "box"]), theirs, ["pid", "to"])
    both = both.where(F.size(F.array_intersect("mine", "theirs")) >= SIMILARITY * F.col("size"))
    return both.select("pid", F.col("label").alias("node"), F.col("to_label").alias("to")).distinct()


def content_labels(rows: DataFrame) -> DataFrame:
    """``(pid, node, label)``: contents have one label if links lead from one to the other; label is the greatest of these nodes.

    A link is between two contents of a key, of which one has at least four
    fifths of the shingles of a box of the other.  Most are found without pairs,
    by pointing.  Pointing goes on as long as each turn joins a tenth of the
    labels of boxes that may be part of a content with another label; what is
    left is compared with every content that comes into question.
    """
    shingles = cut(shingled(rows))
    boxes = shingles.where("box >= 0").groupBy("pid", "node", "box").agg(F.count("*").alias("size"), F.bit_xor("sh").alias("shingles"))
    boxes = cut(boxes)
    labels = boxes.select("pid", "node", F.col("node").alias("label")).distinct()
    labels = relabelled(labels, content_links(shingles, boxes))
    before, turn = None, 0
    while True:
        open_, held = open_boxes(shingles, boxes, labels)
        left = open_.select("pid", "label").distinct().count()
        if not left:
            return labels
        if before is not None and left > 0.9 * before:
            return relabelled(labels, every_link(open_, held))
        before, turn = left, turn + 1
        labels = relabelled(labels, pointed_links(open_, held, turn))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after links between them."""
    merged = components(links).select("pid", F.col("node").alias("label"), F.col("label").alias("into"))
    return cut(meet(labels, merged, ["pid", "label"], "left").select("pid", "node", F.coalesce("into", "label").alias("label")))


def components(links: DataFrame) -> DataFrame:
    """``(pid, node, label)`` of linked nodes: the greatest node that links lead to, in rounds until nothing changes."""
    both = cut(links.unionByName(links.select("pid", F.col("to").alias("node"), F.col("node").alias("to"))).distinct())
    labels = cut(both.groupBy("pid", "node").agg(F.max("to").alias("to")).select("pid", "node", F.greatest("node", "to").alias("label")))
    while True:
        near = meet(both, labels.select("pid", F.col("node").alias("to"), F.col("label").alias("other")), ["pid", "to"])
        best = near.groupBy("pid", "node").agg(F.max("other").alias("other"))
        after = meet(labels, best, ["pid", "node"]).select(
            "pid", "node", F.greatest("label", "other").alias("label"), (F.col("other") > F.col("label")).alias("moved")
        )
        after = cut(after)
        labels = after.drop("moved")
        if after.where("moved").isEmpty():
            return labels


def grouped(rows: DataFrame) -> DataFrame:
    """The records with ``package``, the label of their package within their key.

    Content decides where there is any.  A record without content belongs to its
    key's only package; among several, to the one that shares most of its values,
    then to the one of most records.
    """
    labels = content_labels(rows)
    known = meet(rows, labels, ["pid", "node"], "left").withColumn("package", F.coalesce("label", "node")).drop("label")
    known = cut(known)
    with_content = known.where("node IS NOT NULL")
    sizes = with_content.groupBy("pid", "package").agg(F.count("*").alias("n"))
    # one long orders packages by records, then by label; the label follows from it by a join
    of_key = sizes.groupBy("pid").agg(F.max(F.struct("n", "package")).alias("top"), F.count("*").alias("packages"))
    values = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FIELDS[:-1])))
    bare = known.where("node IS NULL").select("rec_id", "pid", values.alias("x")).where("x.v IS NOT NULL")
    several = of_key.where("packages > 1").select("pid")
    held = (
        meet(with_content, several, "pid", "left_semi")
        .select("pid", "package", values.alias("x"))
        .where("x.v IS NOT NULL")
        .groupBy("pid", "package", "x")
        .agg(F.count("*").alias("n"))
        .groupBy("pid", "x")
        .agg(F.max(F.struct("n", "package"))["package"].alias("package"))
    )
    votes = meet(bare, held, ["pid", "x"]).groupBy("rec_id", "pid", "package").agg(F.count("*").alias("votes"))
    votes = meet(votes, sizes, ["pid", "package"]).groupBy("rec_id").agg(F.max(F.struct("votes", "n", "package"))["package"].alias("voted"))
    rest = meet(meet(known.where("node IS NULL").drop("package"), votes, "rec_id", "left"), of_key, "pid", "left")
    rest = rest.withColumn("package", F.coalesce("voted", F.col("top.package"), F.lit(0))).drop("voted", "top", "packages")
    return with_content.unionByName(rest)


def _lengths(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``p`` and every beginning of ``q``; a row is a running maximum, so numpy takes it at once."""
    row = np.zeros(len(q) + 1, np.int32)
    for t in p:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (q == t)))
    return row


def matches(p: np.ndarray, q: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; memory grows with the lengths, not with their product."""
    lo, n = 0, min(len(p), len(q))
    differ = np.flatnonzero(p[:n] != q[:n])
    lo = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(p[lo:][::-1][: n - lo] != q[lo:][::-1][: n - lo])
    hi = int(differ[0]) if len(differ) else n - lo
    x, y = p[lo : len(p) - hi], q[lo : len(q) - hi]
    middle: list[tuple[int, int]] = []
    if len(x) and len(y) and len(x) * len(y) > CELLS and len(x) > 1:
        half = len(x) // 2
        split = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        middle = matches(x[:half], y[:split]) + [(i + half, j + split) for i, j in matches(x[half:], y[split:])]
    elif len(x) and len(y):
        table_ = np.zeros((len(x) + 1, len(y) + 1), np.int32)
        for i in range(1, len(x) + 1):
            table_[i, 1:] = np.maximum.accumulate(np.maximum(table_[i - 1, 1:], table_[i - 1, :-1] + (y == x[i - 1])))
        i, j = len(x), len(y)
        while i and j:
            if x[i - 1] == y[j - 1] and table_[i, j] == table_[i - 1, j - 1] + 1:
                i, j = i - 1, j - 1
                middle.append((i, j))
            elif table_[i - 1, j] >= table_[i, j - 1]:
                i -= 1
            else:
                j -= 1
        middle.reverse()
    head = [(k, k) for k in range(lo)]
    tail = [(len(p) - hi + k, len(q) - hi + k) for k in range(hi)]
    return head + [(i + lo, j + lo) for i, j in middle] + tail


def deviations(guide: str, value: str) -> list[tuple[int, int, str | None]]:
    """``(pos, k, token)``: what a value has in other columns than its guide or instead of it; the token is null where it has nothing.

    Column ``(pos, 0)`` is that of the guide's token at ``pos``; ``(pos, k)``
    the k-th one opened before it by tokens that the guide hasn't.
    """
    a, b = guide.split(), value.split()
    ids = {t: i for i, t in enumerate(dict.fromkeys([*a, *b]))}
    pairs = matches(np.array([ids[t] for t in a], int), np.array([ids[t] for t in b], int))
    found, i, j = [], 0, 0
    for x, y in [*pairs, (len(a), len(b))]:
        while i < x and j < y:
            found.append((i, 0, b[j]))
            i, j = i + 1, j + 1
        found += [(k, 0, None) for k in range(i, x)]
        found += [(x, k, b[j + k - 1]) for k in range(1, y - j + 1)]
        i, j = x + 1, y + 1
    return found


def survivors(records: DataFrame, origins: DataFrame) -> DataFrame:
    """``(first_rec_id, field_name, rec_id)``: the record whose value survives, per package of two or more records and field.

    Values of a field are ranked by completeness (of content, its amount of
    text), trust and recency.  The values of the first rank, between which this
    order leaves it open, are the candidates: the one closest to the consensus
    of all survives, on a tie that of the smallest ``rec_id``.  For the
    consensus all values are aligned by tokens to the columns of a guide, the
    candidate of the smallest ``rec_id``; each record votes in every column for
    its token or for none, votes of first rank weigh more than all others
    together, and on a tie the guide's token stays.  Nulls, blanks and stand-ins
    are no value; a field without any has no row.  Records without an id, and
    packages of one record, give no rows; an empty table gives none.

    Values travel once, to their guide; then only deviations from it do, and
    votes are added up before the shuffle, so that a package may have any number
    of records.
    """
    spark = records.sparkSession
    ship(spark)
    rows = cut(grouped(cut(prepared(records, origins))))
    packages = rows.groupBy("pid", "package").agg(F.min("rec_id").alias("first_rec_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = meet(rows, packages, ["pid", "package"])
    field = lambda f: F.struct(
        F.lit(f).alias("field_name"),
        F.col(f).alias("value"),
        (F.length(F.regexp_replace(f, r"\s+", "")) if f == "content" else F.lit(0)).alias("complete"),
    )
    long = rows.select("first_rec_id", "rec_id", "trust", "at", F.explode(F.array(*map(field, FIELDS))).alias("x")).where("x.value IS NOT NULL")
    group = ["first_rec_id", "field_name"]
    votes = long.select("first_rec_id", "x.field_name", "x.value", F.struct("x.complete", "trust", "at").alias("rank"), "rec_id")
    votes = cut(votes.groupBy(*group, "value", "rank").agg(F.min("rec_id").alias("rec_id"), F.count("*").alias("n")))
    top = votes.groupBy(*group).agg(F.max(F.struct("rank", (-F.col("rec_id")).alias("rec"))).alias("top"))
    first = F.col("rank").eqNullSafe(F.col("top.rank"))
    values = meet(votes, top, group).groupBy(*group, "value", (-F.col("top.rec")).alias("guide_id"))
    values = cut(
        values.agg(
            F.sum(F.when(first, F.col("n")).otherwise(0)).alias("n_top"), F.sum("n").alias("n"), F.min(F.when(first, F.col("rec_id"))).alias("rec_id")
        )
    )
    is_guide = F.col("rec_id").eqNullSafe(F.col("guide_id"))
    guides = values.where(is_guide).select(*group, F.col("value").alias("guide"))
    totals = values.groupBy(*group).agg(F.sum("n_top").alias("all_top"), F.sum("n").alias("all"))

    def aligned(batches):
        types = pa.list_(pa.struct([("pos", pa.int32()), ("k", pa.int32()), ("token", pa.string())]))
        for batch in batches:
            found = [
                [{"pos": p, "k": k, "token": t} for p, k, t in deviations(g, v)]
                for g, v in zip(batch.column("guide").to_pylist(), batch.column("value").to_pylist())
            ]
            kept = batch.select([*group, "rec_id", "n_top", "n"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(found, types)], names=[*kept.schema.names, "found"])

    schema = "first_rec_id bigint, field_name string, rec_id bigint, n_top bigint, n bigint, found array<struct<pos: int, k: int, token: string>>"
    others = meet(values.where(~is_guide), guides, group).select(*group, "rec_id", "n_top", "n", "guide", "value")
    other = cut(others.mapInArrow(aligned, schema).select(*group, "rec_id", "n_top", "n", F.explode("found").alias("x")))
    column = [*group, "pos", "k"]
    other = other.select(*group, "x.pos", "x.k", "x.token", "rec_id", "n_top", "n")
    tokens = other.groupBy(*column, "token").agg(F.sum("n_top").alias("n_top"), F.sum("n").alias("n"))
    columns = tokens.groupBy(*column).agg(F.sum("n_top").alias("against_top"), F.sum("n").alias("against"), F.max(F.struct("n_top", "n", "token")).alias("best"))
    left_top, left = F.col("all_top") - F.col("against_top"), F.col("all") - F.col("against")
    ahead = (F.col("best.n_top") > left_top) | ((F.col("best.n_top") == left_top) & (F.col("best.n") > left))
    winners = meet(columns, totals, group).where(ahead).select(*column, F.col("best.token").alias("won"), F.lit(True).alias("changed"))
    # against the guide: a column nearer to the consensus, as far from it, or farther
    farther = F.when(F.col("changed").isNull(), 1).when(F.col("token").eqNullSafe(F.col("won")), -1).otherwise(0)
    candidates = meet(other.where("rec_id IS NOT NULL"), winners, column, "left")
    candidates = candidates.groupBy(*group, "rec_id").agg(F.sum(farther).alias("far")).where("far < 0")
    nearest = candidates.groupBy(*group).agg(F.min(F.struct("far", "rec_id"))["rec_id"].alias("nearest"))
    found = meet(values.where(is_guide).select(*group, "guide_id"), nearest, group, "left")
    return found.select(*group, F.coalesce("nearest", "guide_id").alias("rec_id"))


@query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors(table(spark, sf_dir, "packages"), table(spark, sf_dir, "origins"))
