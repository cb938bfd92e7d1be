"""Near duplicates: min-hash fingerprints, banding, exact search of similar pairs, and choice of representatives."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import cut, meet, ship

SEEDS, BANDS, NGRAM = 100, 10, 5
#: Shingles and texts of a block of texts, which bound the memory of a task.
BLOCK, BLOCK_TEXTS = 16_000_000, 32_000
#: Frequent shingles that axes are made of, axes, and texts they are fitted to; these change the speed of a search, not its pairs.
HOT, AXES, FITTED = 4096, 256, 2000
#: Candidates that are verified at once.
FLUSH = 4_000_000


def _multipliers(seeds: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    return rng.integers(1, 2**63, seeds, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, seeds, dtype=np.uint64)


def gram_hashes(text: str, ngram: int = NGRAM) -> np.ndarray:
    """Hashes of the distinct character n-grams of a text, the last one left out."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    count = len(codes) - ngram
    if count < 1:
        return np.zeros(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for k in range(ngram):
        h ^= codes[k : k + count]
        h *= np.uint64(0x9E3779B97F4A7C15)
    return _distinct(h)


def _distinct(h: np.ndarray) -> np.ndarray:
    """The distinct numbers of an array, which is sorted in place."""
    h.sort()
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def fingerprint(text: str, a: np.ndarray, b: np.ndarray, ngram: int = NGRAM) -> list[int] | None:
    """Minimum of each 4-byte hash over the character n-grams of a text; none for short texts."""
    h = gram_hashes(text, ngram)
    if not len(h):
        return None
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(h), 4096):  # bounds the memory for long texts
        part = h[start : start + 4096]
        least = np.minimum(least, ((a[:, None] * part + b[:, None]) >> np.uint64(32)).min(1))
    return least.astype(np.int64).tolist()


def fingerprints(docs: DataFrame, key: str, text: str = "text", seeds: int = SEEDS) -> DataFrame:
    """``(key, signature array<bigint>)``; null texts and texts of up to five characters have none. No shuffle."""
    ship(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        a, b = _multipliers(seeds)
        for batch in batches:
            found = [fingerprint(t, a, b) if t else None for t in batch.column(1).to_pylist()]
            keep = pa.array([f is not None for f in found], pa.bool_())
            out = pa.array([f for f in found if f is not None], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), out], names=[key, "signature"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {key_type}, signature array<bigint>")


def shingle_sets(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, grams array<bigint>)``: 64-bit hashes of the distinct n-grams of each text."""
    ship(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [gram_hashes(t).astype(np.int64) if t else np.zeros(0, np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=[key, "grams"])

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {key_type}, grams array<bigint>")


def bands(signatures: DataFrame, key: str, count: int = BANDS, seeds: int = SEEDS) -> DataFrame:
    """``(key, band, bucket)``: a hash of each band of rows of the signature."""
    rows = seeds // count
    buckets = F.array(*(F.xxhash64(F.lit(k), F.slice("signature", k * rows + 1, rows)) for k in range(count)))
    return signatures.select(key, F.posexplode(buckets).alias("band", "bucket"))


def jaccard(a, b, kind: str = "union"):
    """Similarity of two shingle arrays by union, or by the smaller or larger of both; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    whole = {"union": F.size(a) + F.size(b) - both, "min": F.least(F.size(a), F.size(b)), "max": F.greatest(F.size(a), F.size(b))}[kind]
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / whole).otherwise(0.0)


def text_classes(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(rep, text, copies)``: each distinct text with its smallest key; equal texts combine before the shuffle."""
    return docs.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(key).alias("rep"), F.count("*").alias("copies"))


def _sized(texts: DataFrame, key: str) -> DataFrame:
    """``(key, text, size)``: texts that have shingles, compressed, with their number."""
    key_type = texts.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = batch.column(1).to_pylist()
            sizes = pa.array([len(gram_hashes(t)) for t in found], pa.int64())
            small = pa.array([zlib.compress(t.encode(), 1) for t in found], pa.binary())
            out = pa.RecordBatch.from_arrays([batch.column(0), small, sizes], names=[key, "text", "size"])
            yield out.filter(pc.greater(sizes, 0))

    return texts.select(key, "text").mapInArrow(run, f"`{key}` {key_type}, text binary, size bigint")


def _blocks(bins: list, above: float, kind: str) -> tuple[list[tuple], list[tuple]]:
    """Blocks of texts of near sizes, within ``BLOCK`` and ``BLOCK_TEXTS``, from ``(bin, n, size, least, most)`` in order of size.

    ``(bin, first block, number of blocks, most)``: a bin above the bounds is dealt
    over several blocks, and ``most`` bounds the sizes of a bin's texts; and
    ``(a, b, work)``: the pairs of blocks that may hold similar texts.
    """
    shingles = min(BLOCK, max(sum(b["size"] for b in bins) // 4, BLOCK // 40))
    texts = min(BLOCK_TEXTS, max(sum(b["n"] for b in bins) // 4, BLOCK_TEXTS // 16))
    of_bin, spans, filled = [], [], None
    for b in bins:
        share = max(b["size"] / shingles, b["n"] / texts)
        parts = max(1, int(np.ceil(share)))
        if parts == 1 and filled is not None and filled + share <= 1:
            filled += share
            spans[-1] = (spans[-1][0], b["most"], spans[-1][2] + b["n"])
            of_bin.append((b["bin"], len(spans) - 1, 1, b["most"]))
            continue
        of_bin.append((b["bin"], len(spans), parts, b["most"]))
        spans += [(b["least"], b["most"], b["n"] // parts)] * parts
        filled = share if parts == 1 else None
    # for min a text of any size may be contained in a longer one
    near = [
        (i, j, spans[i][2] * spans[j][2] // (1 + (i == j)))
        for i in range(len(spans))
        for j in range(i, len(spans))
        if i == j or kind == "min" or spans[i][1] > above * spans[j][0]
    ]
    return of_bin, near


class _Axes:
    """Orthonormal axes in the space of the frequent shingles, fitted to some texts.

    Any axes give right bounds; those along which texts differ most give close ones.
    """

    def __init__(self, texts: list[str]):
        grams = [g for g in map(gram_hashes, texts) if len(g)]
        found, counts = np.unique(np.concatenate(grams) if grams else np.zeros(1, np.uint64), return_counts=True)
        self.hot = np.sort(found[np.argsort(-counts, kind="stable")[:HOT]])
        rng = np.random.default_rng(2)
        axes = rng.standard_normal((len(self.hot), min(AXES, len(self.hot), max(len(grams), 1)))).astype(np.float32)
        axes = np.linalg.qr(axes)[0]
        if grams:
            x = self.split(grams)[0]
            x /= np.sqrt(np.maximum(x.sum(1), 1))[:, None]
            for _ in range(2):
                axes = np.linalg.qr(x.T @ (x @ axes))[0]
        self.axes = np.ascontiguousarray(axes, np.float32)

    def split(self, grams: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Which of the frequent shingles each text has, and its others."""
        out = np.zeros((len(grams), len(self.hot)), np.float32)
        others = []
        for row, g in zip(out, grams):
            at = np.minimum(np.searchsorted(self.hot, g), len(self.hot) - 1)
            known = self.hot[at] == g
            row[at[known]] = 1
            others.append(g[~known])
        return out, others

    def project(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Coordinates in bytes; what one step of them is, their length, that of their rounding and of what is off the axes, and the number of other shingles; and these."""
        dense, others = self.split(grams)
        at = dense @ self.axes
        step = np.maximum(np.abs(at).max(1), 1e-6) / 127
        whole = np.rint(at / step[:, None])
        kept = whole * step[:, None]
        lost = ((at - kept).astype(np.float64) ** 2).sum(1)
        off = np.maximum(dense.sum(1, dtype=np.float64) - (at.astype(np.float64) ** 2).sum(1), 0) + lost
        measures = np.stack([step, np.sqrt((kept**2).sum(1)), np.sqrt(lost), np.sqrt(off), [len(o) for o in others]], 1).astype(np.float32)
        return whole.astype(np.int8), measures, others


def _parities(grams: np.ndarray, bits: int) -> bytes:
    """Of each of so many buckets whether an odd number of shingles is in it: as many bits as differ, at least, do the sets."""
    counts = np.bincount(((grams >> np.uint64(40)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(bool)).tobytes()


_FACTS = pa.schema([("size", pa.int64()), *((name, pa.binary()) for name in ("at", "measures", "others", "bits"))])


def _packed(batches, axes: _Axes):
    """Rows of a batch by block, their keys, texts and sketches compressed as one value, since each block travels to several tasks."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 5))
    for batch in batches:
        texts = pa.array([zlib.decompress(t).decode() for t in batch.column(1).to_pylist()], pa.string())
        batch = batch.set_column(1, "text", texts)
        out: list[tuple] = []
        for block in pc.unique(batch.column("block")).to_pylist():
            rows = batch.filter(pc.equal(batch.column("block"), block))
            most = rows.column("most")[0].as_py()
            bits, few = (1 << int(np.clip(n, *least) - 1).bit_length() for n, least in ((4 * most, (256, 2**13)), (0.45 * most, (128, 1024))))
            facts: list[list] = [[] for _ in _FACTS]
            for start in range(0, rows.num_rows, 256):  # bounds the memory
                grams = [gram_hashes(t) for t in rows.column(1).slice(start, 256).to_pylist()]
                at, measures, others = axes.project(grams)
                found = [len(g) for g in grams], [x.tobytes() for x in at], [x.tobytes() for x in measures], [_parities(o, few) for o in others], [_parities(g, bits) for g in grams]
                for k, values in enumerate(found):
                    facts[k] += values
            schema = pa.schema([rows.schema.field(0), rows.schema.field(1), *_FACTS])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=options) as writer:
                writer.write_batch(pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array(f, t.type) for f, t in zip(facts, _FACTS))], schema=schema))
            out.append((block, sink.getvalue().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], names=["block", "texts"])


def _needed(a, b, above: float, kind: str):
    """The least share of shared shingles, as a number, that sets of these sizes must exceed to be similar."""
    return {"union": (a + b) * (above / (1 + above)), "min": np.minimum(a, b) * above, "max": np.maximum(a, b) * above}[kind]


def _folded(words: np.ndarray, count: int) -> np.ndarray:
    """Parities of fewer buckets."""
    while words.shape[1] > count:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return np.ascontiguousarray(words)


class _Side:
    """Keys, texts and sketches of a block, by size."""

    def __init__(self, packs: list[bytes]):
        rows = pa.concat_tables(pa.ipc.open_stream(p).read_all() for p in packs)
        sizes = rows.column("size").to_numpy()
        order = np.argsort(sizes, kind="stable")
        self.sizes, self.keys, self.texts = sizes[order], rows.column(0).take(order), rows.column(1)
        self.row = order
        joined = lambda name: [x for c in rows.column(name).chunks for x in c.to_pylist()]
        self.at = np.frombuffer(b"".join(joined("at")), np.int8).reshape(len(order), -1)[order]
        self.step, self.length, self.rounding, self.off, self.rest = np.frombuffer(b"".join(joined("measures")), np.float32).reshape(-1, 5)[order].T
        self.others, self.words = (self._words([x[r] for x in [joined(name)] for r in order.tolist()]) for name in ("others", "bits"))

    @staticmethod
    def _words(bits: list[bytes]) -> np.ndarray:
        least = min(map(len, bits))
        return np.stack([_folded(np.frombuffer(b, np.uint64)[None], least // 8)[0] for b in bits])

    def factors(self, rows: slice, other: _Side, above: float, kind: str, left: bool) -> np.ndarray:
        """Numbers whose product with those of another text is as large, at least, as the number of shared shingles; for union less what is needed."""
        signs = np.float32(0.5) - np.unpackbits(_folded(self.others[rows], min(self.others.shape[1], other.others.shape[1])).view(np.uint8), axis=1)
        alone = self.rest[rows] / 2 - (signs.shape[1] / 4 if left else 0)
        if kind == "union":  # what is needed is a sum, so that the same product can take it off
            alone = alone - above / (1 + above) * 0.999 * self.sizes[rows]
        length, rounding, ones = self.length[rows], self.rounding[rows], np.ones(len(alone))
        ends = [length, rounding, self.off[rows], alone, ones] if left else [rounding, length, self.off[rows], ones, alone]
        return np.concatenate([self.at[rows] * self.step[rows, None], signs, np.stack(ends, 1)], 1, dtype=np.float32, casting="same_kind")

    def grams(self, at: np.ndarray) -> list[np.ndarray]:
        return [gram_hashes(t) for t in self.texts.take(self.row[at]).to_pylist()]


def _likely(a: _Side, b: _Side, same: bool, above: float, kind: str):
    """``(i, j)`` in arrays: all pairs of two blocks, or within one, that may be similar.

    Of the frequent shingles two sets share at most the product of their parts
    along the axes, and of what is off these the product of the lengths; of the
    others at most what their parities leave, as two sets differ by at least as many
    shingles as their parities.  All are bounds, so that no pair is lost.
    """
    count = min(a.words.shape[1], b.words.shape[1])
    tests = [(_folded(a.words, c), _folded(b.words, c), np.ones(c, np.float32)) for c in (count // 2, count)] if kind != "min" else []
    rows, columns = 128, 8192
    for j0 in range(0, len(b.sizes), columns):
        j1 = min(j0 + columns, len(b.sizes))
        right = b.factors(slice(j0, j1), a, above, kind, False).T
        for i0 in range(0, min(j1, len(a.sizes)) if same else len(a.sizes), rows):
            sizes = a.sizes[i0 : i0 + rows]
            first, last = max(j0, i0) if same else j0, j1
            if kind != "min":
                low, high = np.searchsorted(b.sizes, [np.floor(sizes[0] * above * 0.999), np.ceil(sizes[-1] / max(above * 0.999, 1e-9)) + 1])
                first, last = max(first, low), min(last, high)
            if first >= last:
                continue
            most = a.factors(slice(i0, i0 + rows), b, above, kind, True) @ right[:, first - j0 : last - j0]
            if kind != "union":
                most -= _needed(sizes[:, None].astype(np.float32), b.sizes[None, first:last].astype(np.float32), above * 0.999, kind)
            hits = most > -0.5
            if same:
                hits &= np.arange(first, last)[None, :] > np.arange(i0, i0 + len(sizes))[:, None]
            for i in np.flatnonzero(hits.any(1)).tolist():
                j = np.flatnonzero(hits[i]) + first
                for of_a, of_b, ones in tests:
                    differ = of_b.take(j, 0)
                    differ ^= of_a[i0 + i]
                    sizes_j = b.sizes.take(j)
                    # sums of whole numbers below 2**24 are exact
                    j = j[np.bitwise_count(differ).astype(np.float32) @ ones <= sizes[i] + sizes_j - 2 * _needed(sizes[i], sizes_j, above, kind) + 1e-3]
                    if not len(j):
                        break
                if len(j):
                    yield np.full(len(j), i0 + i, np.int32), j.astype(np.int32)


class _Numbered:
    """Shingles of some texts of both blocks, as numbers that are the same where the shingles are."""

    def __init__(self, sides: list[_Side], involved: list[np.ndarray]):
        chunks = [(s, k, part) for k, (s, at) in enumerate(zip(sides, involved)) for part in np.array_split(at, 1 + int(s.sizes[at].sum()) // 1_000_000)]
        of = lambda s, part: np.concatenate([known[:0], *s.grams(part)])
        known = np.zeros(0, np.uint64)
        held: dict[int, np.ndarray] = {}
        for n, (s, _, part) in enumerate(chunks):
            found = of(s, part)
            if n < 8:  # of the others the shingles are formed anew, which bounds the memory
                held[n] = found
            known = _distinct(np.concatenate([known, _distinct(found.copy())]))
        self.count = len(known)
        self.starts = [np.zeros(len(s.sizes) + 1, np.int64) for s in sides]
        numbers: list[list[np.ndarray]] = [[np.zeros(0, np.int32)] for _ in sides]
        for n, (s, k, part) in enumerate(chunks):
            found = held.pop(n) if n in held else of(s, part)
            numbers[k].append(np.searchsorted(known, found).astype(np.int32))
        for k, (s, at) in enumerate(zip(sides, involved)):
            self.starts[k][at + 1] = s.sizes[at]
            np.cumsum(self.starts[k], out=self.starts[k])
        self.numbers = [np.concatenate(n) for n in numbers]


def _verified(sides: list[_Side], pairs: list[tuple[np.ndarray, np.ndarray]], above: float, kind: str):
    """``(i, j, similarity)`` in arrays of the candidates that are similar, by their whole sets."""
    i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    sets = _Numbered(sides, [np.unique(i), np.unique(j)])
    seen = np.zeros(sets.count, bool)
    numbers = sets.numbers[1]
    for a in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
        mine = sets.numbers[0][sets.starts[0][i[a[0]]] : sets.starts[0][i[a[0]] + 1]]
        seen[mine] = True
        others = j[a]
        starts, ends = sets.starts[1][others], sets.starts[1][others + 1]
        length = int((ends - starts).sum())
        if 2 * length > ends[-1] - starts[0] > 0 and length < 300 * len(a):  # most of a range: the whole of it
            sums = np.concatenate([[0], np.cumsum(seen[numbers[starts[0] : ends[-1]]], dtype=np.int32)])
            shared = sums[ends - starts[0]] - sums[starts - starts[0]]
        else:
            shared = np.array([np.count_nonzero(seen.take(numbers[s:e], mode="clip")) for s, e in zip(starts.tolist(), ends.tolist())], np.int64)
        seen[mine] = False
        x, y = sides[0].sizes[i[a]], sides[1].sizes[others]
        similarity = shared / {"union": x + y - shared, "min": np.minimum(x, y), "max": np.maximum(x, y)}[kind]
        keep = similarity > above
        if keep.any():
            yield i[a][keep], others[keep], similarity[keep]


def _similar_in(a: _Side, b: _Side, same: bool, above: float, kind: str):
    """Batches ``(x, y, jaccard)`` of the similar pairs of two blocks, or within one."""

    def flush():
        found = list(_verified([a, b], waiting, above, kind))
        if found:
            i, j, similarity = (np.concatenate(f) for f in zip(*found))
            for k in range(0, len(i), 100_000):
                part = slice(k, k + 100_000)
                columns = [pa.chunked_array(s.keys).take(pa.array(at[part])).combine_chunks() for s, at in ((a, i), (b, j))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(similarity[part])], names=["x", "y", "jaccard"])

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for pair in _likely(a, b, same, above, kind):
        waiting.append(pair)
        held += len(pair[0])
        if held >= FLUSH:
            yield from flush()
            waiting, held = [], 0
    if waiting:
        yield from flush()


def similar_pairs(docs: DataFrame, key: str, text: str = "text", above: float = 0.5, kind: str = "union") -> DataFrame:
    """``(src, dst, jaccard)``, ``src < dst``: all pairs of representatives of distinct texts more similar than ``above``.

    Copies of a text are represented by the smallest key; ``text_classes`` has
    the membership.  The search is exact: texts are dealt into blocks of near
    sizes, blocks whose sizes allow similar texts meet in one task, and there
    bounds on what two texts share, from few numbers of each, leave the candidates, which are verified on
    the whole sets.  The work grows with the number of pairs of texts of near sizes.
    """
    if above < 0:
        raise ValueError("the similarity must be at least 0")
    return _pairs_of(text_classes(docs, key, text), above, kind)


def _pairs_of(classes: DataFrame, above: float = 0.5, kind: str = "union") -> DataFrame:
    """``similar_pairs`` of texts that are distinct, ``(rep, text)``."""
    spark = classes.sparkSession
    ship(spark)
    texts = cut(_sized(classes, "rep"))
    key_type = texts.schema["rep"].dataType.simpleString()
    bin_ = F.floor(F.log("size") / F.lit(np.log(1.05).item()))
    bins = texts.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("size").alias("least"), F.max("size").alias("most"))
    of_bin, near = _blocks(sorted(bins.collect(), key=lambda r: r["bin"]), above, kind)
    near = sorted(near, key=lambda c: -c[2])
    # the axes are fitted to the beginnings of some texts; all texts are searched, whatever the axes
    fitted = texts.select(F.xxhash64("rep").alias("h"), "text").orderBy("h").limit(FITTED).collect()
    axes = _Axes([zlib.decompress(r["text"]).decode()[:4000] for r in fitted])
    of_bin = spark.createDataFrame(of_bin, "bin bigint, first bigint, parts bigint, most bigint")
    partners: dict[int, list[int]] = {}
    for cell, (a, b, _) in enumerate(near):
        for block in {a, b}:
            partners.setdefault(block, []).append(cell)
    partners = spark.createDataFrame([(k, v) for k, v in partners.items()], "block bigint, cells array<int>")
    dealt = texts.withColumn("bin", bin_).join(F.broadcast(of_bin), "bin").withColumn("block", F.col("first") + F.pmod(F.xxhash64("rep"), "parts"))
    shared = spark.sparkContext.broadcast(axes)
    packs = dealt.select("rep", "text", "block", "most").mapInArrow(lambda batches: _packed(batches, shared.value), "block bigint, texts binary")
    cells = packs.join(F.broadcast(partners), "block").select("block", "texts", F.explode("cells").alias("cell"))
    pairs_of_blocks = [(a, b) for a, b, _ in near]

    def run(batches):
        packs: dict[int, dict[int, list[bytes]]] = {}
        for batch in batches:
            for block, pack, cell in zip(*(batch.column(n).to_pylist() for n in ("block", "texts", "cell"))):
                packs.setdefault(cell, {}).setdefault(block, []).append(pack)
        for cell in sorted(packs):
            a, b = pairs_of_blocks[cell]
            mine = packs.pop(cell)
            if a not in mine or b not in mine:
                continue
            sides = {block: _Side(mine.pop(block)) for block in {a, b}}
            yield from _similar_in(sides[a], sides[b], a == b, above, kind)

    cells = cells.repartitionById(max(len(near), 1), F.col("cell"))
    pairs = cells.mapInArrow(run, f"x {key_type}, y {key_type}, jaccard double")
    return pairs.select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst"), "jaccard")


def merged(edges: DataFrame) -> DataFrame:
    """Repeated edges as one, with the greatest similarity."""
    return edges.groupBy("src", "dst").agg(F.max("jaccard").alias("jaccard"))


def symmetric(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, once, with the greatest similarity."""
    return merged(edges.select("src", "dst", "jaccard").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "jaccard")))


def mains(edges: DataFrame) -> DataFrame:
    """``(node, main)`` of every node with an edge: the first node, in key order, that absorbs it.

    A node none of whose smaller neighbours is a main is a main itself; any
    other belongs to its smallest main neighbour.  Found in rounds: an undecided node
    whose smaller neighbours are all decided and no main becomes one.
    """
    both = cut(symmetric(edges).select("src", "dst"))
    state = cut(both.select(F.col("src").alias("node")).distinct().withColumn("is_main", F.lit(None).cast("boolean")))
    while True:
        smaller = meet(both.where("dst < src"), state.withColumnRenamed("node", "dst"), "dst")
        seen = smaller.groupBy(F.col("src").alias("node")).agg(
            F.max(F.coalesce("is_main", F.lit(False)).cast("int")).alias("near_main"), F.max(F.col("is_main").isNull().cast("int")).alias("open")
        )
        decided = F.when(F.col("is_main").isNotNull(), F.col("is_main")).when(F.col("near_main") == 1, False).when(F.coalesce("open", F.lit(0)) == 0, True)
        state = cut(meet(state, seen, "node", "left").select("node", decided.alias("is_main")))
        if state.where("is_main IS NULL").isEmpty():
            break
    chosen = state.where("is_main").select(F.col("node").alias("dst"))
    smallest = meet(both, chosen, "dst").where("dst < src").groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("main"))
    return meet(state, smallest, "node", "left").select("node", F.when(F.col("is_main"), F.col("node")).otherwise(F.col("main")).alias("main"))


def choose(docs: DataFrame, edges: DataFrame, key: str, keep: str = "first", text: str = "text", score: str | None = None) -> DataFrame:
    """Keys of the documents that survive: of each star around a main the first, the longest, or that of the lowest score.

    Documents without an edge survive.  Ties go to the main, then to the smaller
    key; a null score ranks last.  Scores are compared as they are: the length
    of the main, by which each may be divided, is the same for all of a star.
    """
    stars = meet(mains(edges), docs.select(F.col(key).alias("node"), F.length(text).alias("_size"), *([F.col(score).alias("_score")] if score else [])), "node")
    rank = {"first": F.lit(0.0), "longest": -F.col("_size").cast("double"), "score": F.coalesce("_score", F.lit(float("inf"))) if score else F.lit(0.0)}[keep]
    best = stars.groupBy("main").agg(F.min(F.struct(rank.alias("rank"), (F.col("node") != F.col("main")).alias("other"), "node"))["node"].alias(key))
    alone = meet(docs.select(key), stars.select(F.col("node").alias(key)), key, "left_anti")
    return alone.unionByName(best.select(key))


def near_duplicates(docs: DataFrame, key: str, text: str = "text", keep: str = "first", **options) -> DataFrame:
    """``(key, class_id, links)`` of every document with text: its surviving document and its number of links.

    Copies of a text share its representative's class; links count edges
    between different texts.
    """
    texts = text_classes(docs, key, text)
    edges = cut(_pairs_of(texts, **options))
    found = mains(edges)
    digest = F.unhex(F.sha2("text", 256))
    sized = cut(texts.select("rep", F.length("text").alias("size"), digest.alias("_digest")))
    stars = meet(found, sized.select(F.col("rep").alias("node"), "size"), "node")
    rank = F.lit(0) if keep == "first" else -F.col("size")
    best = stars.groupBy("main").agg(F.min(F.struct(rank.alias("rank"), (F.col("node") != F.col("main")).alias("other"), "node"))["node"].alias("class_id"))
    links = symmetric(edges).groupBy(F.col("src").alias("rep")).agg(F.count("*").alias("links"))
    reps = meet(meet(meet(sized, found.select(F.col("node").alias("rep"), "main"), "rep", "left"), best, "main", "left"), links, "rep", "left")
    reps = reps.select("_digest", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    # texts meet by their digests and don't travel
    return meet(docs.select(F.col(key), F.unhex(F.sha2(text, 256)).alias("_digest")), reps, "_digest").select(key, "class_id", "links")
