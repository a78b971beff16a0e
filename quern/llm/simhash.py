"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits. For radius r, every bit position is mapped to a vector of r + 1 bits; the mask of a nonzero vector v keeps the
positions whose inner product with v is odd. Any r positions have some nonzero v that is orthogonal to all of them, so any two
fingerprints within the radius agree on the whole of at least one of the 2^(r+1) - 1 masks: no pair is lost.

Only distinct fingerprints are compared, copies are folded into them first. Within a bucket the links are found exactly, and what leaves
it is a spanning forest (at most one edge a fingerprint), never all pairs. Components come from star contraction over the edges.

The pipeline's stage is keep_one(): there a link is a Jaccard similarity of 0.8 or more of the sets of 5-word shingles. Covering tables
over the fingerprints of those sets give the first candidates, which are decided on the full sets; pairs that are similar but outside the
radius are then found by a prefix filter that loses none, and decided likewise.

Cases: null and empty texts have fingerprint zero and are linked like any other; repeated rows each give a row; an empty table gives
none; a null doc_id takes part, but a component is named by the smallest doc_id that is not null; a very long text is counted in pieces;
other columns are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, cut, cut_parquet, discard, join_stats, release, tiled, tune
from .substr import grams, word_hashes

BITS, SEED = 64, 42
#: Fingerprints of a block: two blocks are compared in one task at a time, whatever the size of a bucket.
TILE = 4096


def hashes(text: str | None, shingle: int = 3) -> np.ndarray:
    """XXH64 of each shingle of words, A-Z lower-cased, repeats included."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(w), SEED)], np.uint64)
    h, join = xxhash.xxh64_intdigest, b" ".join
    return np.array([h(join(t), SEED) for t in zip(*(w[i:] for i in range(shingle)), strict=False)], np.uint64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    h = hashes(text, shingle)
    if not len(h):
        return 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 1 << 15):
        part = h[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def masks(radius: int = 3, bits: int = BITS) -> list[int]:
    """The covering family. Positions are dealt to all nonzero vectors in turn, zero is left out: it would keep a bit in no mask."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if bin((i % n + 1) & v).count("1") & 1) for v in range(1, n + 1)]


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the distinct fingerprints that are within the radius of one another. Each is compared once with
    those that no component has reached yet."""
    left, edges = np.arange(len(fps)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[i]) <= radius
            found = left[near].tolist()
            edges += [(i, j) for j in found]
            queue += found
            left = left[~near] if found else left
    return edges


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id") -> DataFrame:
    """id, fp (signed 64-bit)."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b[id_col].cast(pa.int64()), pa.array(fp, pa.int64())], [id_col, "fp"])

    return docs.select(id_col, "text").mapInArrow(run, f"{id_col} long, fp long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Node -> smallest node of its component, by alternating large-star and small-star steps; edges (a, b) of longs. Each round is
    cut through the shared folder. Nodes without an edge don't occur."""
    e = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    # a < b; a hub's neighbours are reached through a grouped minimum, never gathered
    last = None
    for _ in range(max_rounds):
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # large star: larger neighbours of n are tied to the least of its neighbourhood
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("m").alias("a"), F.col("b").alias("b")).where("a < b").distinct()
        # small star: smaller neighbours of n, and n, are tied to the least of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).unionByName(low.select(F.col("m").alias("x"), F.col("b").alias("y")))
        e = cut(small.where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        state = e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints within the radius that keep every component connected. fps: distinct column fp."""
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("key")) for i, m in enumerate(masks(radius))])
    keyed = fps.select("fp", F.explode(tables).alias("x")).select("fp", F.col("x.t").alias("t"), F.col("x.key").alias("key"))
    # buckets are counted before anything is gathered: a bucket over TILE is split by the pigeonhole principle, for two within the
    # radius agree on one of radius + 1 parts of the fingerprint; what is still over TILE then is compared tile by tile
    hot = keyed.groupBy("t", "key").count().where(F.col("count") > TILE).select("t", "key", "count", F.lit(True).alias("hot"))
    width = BITS // (radius + 1)
    part = lambda p: F.shiftrightunsigned("fp", p * width).bitwiseAND(F.lit((1 << width) - 1))
    parts = F.array(*[F.struct(F.lit(p).alias("p"), part(p).alias("v")) for p in range(radius + 1)])
    marked = join_stats(keyed, cut(hot), ["t", "key"], "count").select("t", "key", "fp", F.coalesce("hot", F.lit(False)).alias("hot"))
    few = marked.where("not hot").select("t", "key", F.lit(-1).alias("p"), F.lit(0).cast("long").alias("v"), F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    many = cut(marked.where("hot").withColumn("x", F.explode(parts)).select("t", "key", "x.p", "x.v", "fp"))
    sizes = cut(many.groupBy("t", "key", "p", "v").agg(F.count("*").alias("m")).where("m > 1").withColumn("blocks", blocks_of(F.col("m"), TILE)))
    tiles = tiled(join_stats(many, sizes, ["t", "key", "p", "v"], "m", "inner"), F.xxhash64("fp")).select(*few.columns)
    shared = few.unionByName(tiles).groupBy("t", "key", "p", "v", "i", "j").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[int, int]] = []
            for x in b["fps"]:
                own = np.unique(np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64))
                found += [(int(own[i]), int(own[j])) for i, j in forest(own.view(np.uint64), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    return shared.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id") -> DataFrame:
    """id, fp, component_id for every row of docs."""
    own = cut(fingerprints(docs, shingle, id_col))
    reps = cut(own.groupBy("fp").agg(F.min(id_col).alias("first"), F.count("*").alias("m")))
    comp = components(links(reps.select("fp"), radius))
    named = reps.join(comp, reps.fp == comp.node, "left").select("fp", "first", "m", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("fp", "m", "component_id")
    return join_stats(own, cut(named), ["fp"], "m").select(id_col, "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Shingles counted together in a task, occurrences there that make one common, and common shingles that are told apart by their number.
#: They only set the order in which shingles are tried, so no pair depends on them.
COUNTED, COMMON, COMMONS = 1 << 22, 3, 500_000
#: Documents and bytes of a block of a group; pairs of a document that are decided in one task.
GROUP, GROUP_BYTES, PAIRS = 512, 4 << 20, 128


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the distinct shingles of words, A-Z lower-cased, sorted; a text of fewer words is one shingle."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(grams(word_hashes(w), min(shingle, len(w)))) if w else np.zeros(0, np.uint64)


def simhash_of(own: np.ndarray) -> int:
    """The fingerprint of a set of hashes, signed."""
    if not len(own):
        return 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(own), 1 << 15):
        ones += np.unpackbits(own[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(own), bitorder="little").view("<i8")[0])


def commons(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles (sorted) and how often they were counted, over all documents; those that are rare within a task aren't told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(h[n >= COMMON].view(np.int64)), pa.array(n[n >= COMMON].astype(np.int64))], ["h", "n"])

        for b in batches:
            for t in b["text"]:
                held.append(shingle_set(t.as_py(), shingle))
                size += len(held[-1])
                if size >= COUNTED:
                    yield out()
                    held, size = [], 0
        yield out()

    counts = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    got = counts.orderBy(F.desc("n"), "h").limit(COMMONS).toArrow()
    h, n = got["h"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def prefix(own: np.ndarray, common: tuple[np.ndarray, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """The shingles by which a set is found, in order, and whether each is common: all sets are sorted in one order, rare shingles first. Of
    two sets with the similarity each has least * its size in common at least, so a set's first size - least * size + 1 shingles hold one of
    the other's."""
    h, n = common
    at = np.minimum(np.searchsorted(h, own), max(0, len(h) - 1))
    freq = np.where(h[at] == own, n[at], 0) if len(h) else np.zeros(len(own), np.int64)
    order = np.lexsort((own * np.uint64(0x9E3779B97F4A7C15), freq))[: len(own) - int(np.ceil(least * len(own) - 1e-9)) + 1]
    return own[order], freq[order] > 0


def parities(own: np.ndarray) -> bytes:
    """A bit map of one to two bits a shingle: whether an even or odd number of shingles fall on a bit."""
    size = 1 << max(6, max(0, len(own) - 1).bit_length())
    at = ((own ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) & np.uint64(size - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def may_be_similar(a: int, x: bytes, b: int, y: bytes, least: float) -> bool:
    """False only for sets (sizes a, b) that are surely not similar: a bit in which the maps differ needs a shingle that one set lacks,
    and similar sets differ in (1 - least) / (1 + least) of a + b shingles at most. A larger map is folded to the size of the other."""
    if min(a, b) < least * max(a, b) - 1e-9:
        return False
    p, q = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(p) != len(q):
        if len(p) > len(q):
            p = p[: len(p) // 2] ^ p[len(p) // 2 :]
        else:
            q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    return int(np.bitwise_count(p ^ q).sum(dtype=np.int64)) <= (1 - least) / (1 + least) * (a + b) + 1e-6


def similar(p: np.ndarray, q: np.ndarray, least: float) -> bool:
    """Whether two sets of hashes (sorted, distinct) have the Jaccard similarity."""
    both = len(np.intersect1d(p, q, assume_unique=True))
    return both >= least * (len(p) + len(q) - both)


def similar_pairs(pairs: DataFrame, texts: DataFrame, docs: DataFrame, least: float, shingle: int) -> DataFrame:
    """Those of the pairs that have the similarity, as (a, b), a < b. pairs: c and x, where c may be in many pairs. Bit maps reject most of the
    others; each pair left is decided on the full sets: a task gets the text of c once, and the texts of up to PAIRS of its partners."""
    # a pair told in both directions is decided once
    pairs = pairs.where("c <> x").groupBy(F.least("c", "x").alias("a"), F.greatest("c", "x").alias("b")).agg(F.min(F.col("c") > F.col("x")).alias("turn"))
    pairs = cut(pairs.select(F.when(F.col("turn"), F.col("b")).otherwise(F.col("a")).alias("c"), F.when(F.col("turn"), F.col("a")).otherwise(F.col("b")).alias("x")))
    centers = cut(pairs.groupBy("c").agg(F.count("*").alias("m")).withColumn("salts", blocks_of(F.col("m"), PAIRS)))
    salted = join_stats(pairs, centers, ["c"], "m").select("c", F.pmod(F.xxhash64("x"), "salts").cast("int").alias("salt"), "x")
    each = centers.select("c", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yes = pa.array([may_be_similar(*v, least) for v in zip(*(b[c].to_pylist() for c in ("n_c", "bits_c", "n_x", "bits_x")), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b[c].filter(yes) for c in ("c", "salt", "x")], ["c", "salt", "x"])

    of = lambda k: texts.select(F.col("doc_id").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
    left = cut(salted.join(of("x"), "x").join(each.join(of("c"), "c"), ["c", "salt"]).mapInArrow(near, "c long, salt int, x long"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, own = None, np.zeros(0, np.uint64)
        for b in batches:
            a: list[int] = []
            x: list[int] = []
            for c, other, text in zip(b["c"].to_pylist(), b["x"].to_pylist(), b["text"], strict=True):
                found = shingle_set(text.as_py(), shingle)
                if other is None:
                    center, own = c, found
                elif c == center and similar(own, found, least):
                    a.append(min(c, other))
                    x.append(max(c, other))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(x, pa.int64())], ["a", "b"])

    partners = left.join(docs.withColumnRenamed("doc_id", "x"), "x").select("c", "salt", "x", "text")
    own = left.select("c", "salt").distinct().join(docs.withColumnRenamed("doc_id", "c"), "c").select("c", "salt", F.lit(None).cast("long").alias("x"), "text")
    # nulls sort first: the center comes before its partners
    return own.unionByName(partners).repartition("c", "salt").sortWithinPartitions("c", "salt", "x").mapInArrow(decide, "a long, b long")


def across(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs c, x of a tile's documents that are in different components and whose sizes, places and bit maps allow the similarity;
    column tile: structs of root, doc_id, n, a, block and bits. What these reject never becomes a row."""
    names, share = ["c", "x"], least / (1 + least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, next_ in zip(b["tile"], b["beside"].to_pylist(), strict=True):
                root, doc, n, a, block = (np.asarray(g.values.field(c).to_numpy(zero_copy_only=False), np.int64) for c in ("root", "doc_id", "n", "a", "block"))
                bits = g.values.field("bits").to_pylist()
                size = np.array([len(x) for x in bits])
                for w in np.unique(size).tolist():
                    # similar sets have maps of one size or of the next, which is folded
                    one, two = np.flatnonzero(size == w), np.flatnonzero(size == 2 * w)
                    m = np.frombuffer(b"".join(bits[i] for i in one), np.uint8).reshape(-1, w)
                    big = np.frombuffer(b"".join(bits[i] for i in two), np.uint8).reshape(-1, 2 * w)
                    rows, at = np.concatenate([m, big[:, :w] ^ big[:, w:]]), np.concatenate([one, two])
                    for k, i in enumerate(one.tolist()):
                        j = at[k + 1 :]
                        total = n[j] + n[i]
                        # under their first common shingle, what follows it in either set holds all they have in common
                        on = (root[j] != root[i]) & (np.minimum(a[j], a[i]) >= share * total - 1e-6) & (np.minimum(n[j], n[i]) >= least * np.maximum(n[j], n[i]) - 1e-9)
                        on = np.flatnonzero(on if next_ else on & (block[j] != block[i]))
                        if len(on):
                            differ = np.bitwise_count(rows[k + 1 :][on] ^ rows[k]).sum(axis=1, dtype=np.int64)
                            j = doc[j[on][differ <= (1 - least) / (1 + least) * total[on] + 1e-6]]
                            if len(j):
                                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), doc[i])), pa.array(j)], names)

    return run


def _folded(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts that are equal are folded into the smallest id: doc_id, text, one row a kept id, and k2, k3, m, rep: a row a text."""
    copies = cut(docs.groupBy("k2", "k3").agg(F.min("doc_id").alias("rep"), F.count("*").alias("m")))
    # an id that is repeated with other texts stands for one of them
    twice = cut(copies.groupBy(F.col("rep").alias("doc_id")).agg(F.min(F.struct("k2", "k3")).alias("one"), F.count("*").alias("m")).where("m > 1"))
    first = join_stats(docs, copies.where("m > 1"), ["k2", "k3"], "m").where("rep is null or rep = doc_id").drop("rep")
    first = join_stats(first, twice, ["doc_id"], "m").where(F.col("one").isNull() | (F.col("one") == F.struct("k2", "k3")))
    return first.select("doc_id", "text"), copies


def similar_classes(docs: DataFrame, least: float = 0.8, shingle: int = 5) -> DataFrame:
    """doc_id, component_id of every row with a doc_id: the components of all pairs of texts whose sets of shingles have the Jaccard
    similarity. Links of the covering tables come first. Then come pairs that share a shingle of prefix(), which loses none: each document is
    held against three others of the shingle that most share with it, then of each shingle it is found by; then, under each shingle, the
    documents that are not in one component yet are held against one another, in tiles of two blocks. Only sums and minima are gathered by shingle, so one may be in any share of
    the documents. Every link is decided on the full sets. Repeated rows of an id count as copies, one of them is compared."""
    spark = docs.sparkSession
    tune(spark)
    text = F.coalesce("text", F.lit(""))
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("k2"), F.xxhash64(F.lit(1), text).alias("k3"), "text")
    first, copies = _folded(docs)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingle_set(t.as_py(), shingle) for t in b["text"]]
            cols = [pa.array([len(s) for s in own], pa.int32()), pa.array([simhash_of(s) for s in own], pa.int64()), pa.array([parities(s) for s in own], pa.binary())]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *cols], ["doc_id", "n", "fp", "bits"])

    # identical rows of one id are both there
    texts = cut_parquet(first.mapInArrow(describe, "doc_id long, n int, fp long, bits binary").dropDuplicates(["doc_id"]))

    # candidates of the covering tables
    heads = cut(texts.groupBy("fp").agg(F.min("doc_id").alias("c"), F.count("*").alias("m")))
    alike = join_stats(texts.select("doc_id", "fp"), heads.where("m > 1"), ["fp"], "m", "inner").select("c", F.col("doc_id").alias("x"))
    named = lambda k, to: heads.select(F.col("fp").alias(k), F.col("c").alias(to))
    covered = links(heads.select("fp")).distinct().join(named("a", "c"), "a").join(named("b", "x"), "b").select("c", "x")
    covered = cut(alike.unionByName(covered).where("c <> x"))
    release(spark)

    # shingles that two documents or more are found by, where the smaller of them has it early enough
    common = spark.sparkContext.broadcast(commons(first, shingle))

    def found_by(often: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keys, ids, after = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for d, t in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                    own = shingle_set(t.as_py(), shingle)
                    key, is_common = prefix(own, common.value, least)
                    own_after = len(own) - np.arange(len(key))
                    chosen = np.flatnonzero(is_common == often)
                    keys.append(key[chosen].view(np.int64))
                    ids.append(np.full(len(chosen), d, np.int64))
                    # twice the shingles that follow, and one more where the set can be the smaller one
                    after.append(2 * own_after[chosen] + (own_after[chosen] >= 2 * least / (1 + least) * len(own) - 1e-6))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in ((keys, pa.int64()), (ids, pa.int64()), (after, pa.int32()))], ["key", "doc_id", "after"])

        return run

    # common shingles are known to be in several documents and need no count; the others are in few, so no task gets many of one
    schema = "key long, doc_id long, after int"
    w = Window.partitionBy("key")
    rare = first.mapInArrow(found_by(False), schema).withColumns({"m": F.count("*").over(w), "early": F.max(F.col("after") % 2).over(w)}).where("m > 1 and early = 1")
    rows = cut_parquet(rare.select("key", "doc_id", "after").unionByName(first.mapInArrow(found_by(True), schema)).select("key", "doc_id", F.shiftright("after", 1).alias("a")))
    ids = rows.select("doc_id").unionByName(covered.select(F.col("c").alias("doc_id"))).unionByName(covered.select(F.col("x").alias("doc_id"))).distinct()
    chosen = cut_parquet(first.join(ids, "doc_id", "left_semi"))
    release(spark)

    def centers(of: DataFrame, *more: Column) -> DataFrame:
        """key, m, centers: for each shingle up to three documents of it, the first, the last and any; and more."""
        one = [F.min(F.struct(by.alias("o"), *of.columns)).alias(f"_c{k}") for k, by in enumerate((F.col("doc_id"), F.bitwise_not("doc_id"), F.xxhash64("doc_id")))]
        own = of.groupBy("key").agg(F.count("*").alias("m"), *one, *more).where("_c0.doc_id < _c1.doc_id")
        each = F.transform(F.array("_c0", "_c1", "_c2"), lambda c: F.struct(*[c[x].alias(x) for x in of.columns if x != "key"]))
        return own.withColumn("centers", F.array_distinct(each)).drop("_c0", "_c1", "_c2")

    # first each document under the shingle that most others have: this joins most of a family by a few pairs each
    sized = texts.select("doc_id", "n")
    most = join_stats(rows, cut(centers(rows).withColumn("others", F.col("m"))), ["key"], "m", "inner").groupBy("doc_id").agg(F.max_by(F.struct("a", "centers"), F.struct("others", "key")).alias("x"))
    tried = most.join(sized, "doc_id").select("doc_id", "n", "x.a", F.explode("x.centers").alias("c")).where(F.col("c.doc_id") != F.col("doc_id"))
    # what follows their first common shingle in either set holds all they have in common
    early_enough = F.least("a", "c.a") >= least * F.col("n") - 1e-6
    near = cut(similar_pairs(covered.unionByName(tried.where(early_enough).select(F.col("c.doc_id").alias("c"), F.col("doc_id").alias("x"))), texts, chosen, least, shingle))
    comp = cut(components(near))
    release(spark)

    # then under every shingle whose documents are not in one component; shingles of the same documents count once, by the first in the order
    known = sized.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    rooted = cut_parquet(rows.join(known, "doc_id").select("key", "doc_id", "a", "n", "root"))
    discard(rows)
    low = F.xxhash64("doc_id").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    sets = centers(rooted, F.sum(low).alias("s1"), F.expr("bit_xor(xxhash64(doc_id, 1))").alias("s2"), F.sum("a").alias("sa"), F.min("root").alias("low"), F.max("root").alias("high"))
    sets = sets.where("low < high").groupBy("m", "s1", "s2").agg(F.max_by(F.struct("key", "centers"), F.struct("sa", "key")).alias("g"))
    sets = cut(sets.select("g.key", "m", F.col("m").alias("holders"), "g.centers"))
    each = cut_parquet(join_stats(rooted, sets.select("key", "m", "holders"), ["key"], "m", "inner"))
    discard(rooted)
    release(spark)
    c = F.col("c")
    stars = join_stats(each, sets.select("key", "m", "centers"), ["key"], "m", "inner").withColumn("c", F.explode("centers")).where(c["root"] != F.col("root"))
    possible = (F.least("a", c["a"]) >= least / (1 + least) * (F.col("n") + c["n"]) - 1e-6) & (F.least("n", c["n"]) >= least * F.greatest("n", c["n"]) - 1e-9)
    stars = cut(stars.where(possible).select(c["doc_id"].alias("c"), F.col("doc_id").alias("x")).distinct())
    near = cut(near.unionByName(similar_pairs(stars, texts, chosen, least, shingle)))
    comp = cut(components(near))
    release(spark)

    # what is still apart under one shingle; a group of two has been compared already
    joined = each.where("holders > 2").select("key", "doc_id", "a", "n").join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    apart = joined.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m"), F.sum("n").alias("size")).where("low < high")
    # a map has up to a quarter of a byte a shingle, and eight bytes at least
    apart = cut(apart.select("key", "m", F.greatest(blocks_of(F.col("m"), GROUP), blocks_of(F.col("size"), 4 * GROUP_BYTES)).alias("blocks")))
    tiles = tiled(join_stats(joined, apart, ["key"], "m", "inner"), F.xxhash64("doc_id")).join(texts.select("doc_id", "bits"), "doc_id")
    tiles = tiles.groupBy("key", "i", "j").agg(F.collect_list(F.struct("root", "doc_id", "n", "a", "block", "bits")).alias("tile"))
    rest = tiles.select("tile", (F.col("j") - F.col("i") <= 1).alias("beside")).mapInArrow(across(least), "c long, x long").distinct()
    comp = components(near.unionByName(similar_pairs(rest, texts, chosen, least, shingle)))
    named = copies.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("k2", "k3", "m", F.coalesce("root", "rep").alias("component_id"))
    return join_stats(docs.select("doc_id", "k2", "k3"), cut(named), ["k2", "k3"], "m").select("doc_id", "component_id")


def keep_one(docs: DataFrame, least: float = 0.8, shingle: int = 5) -> DataFrame:
    """The documents without near copies: of each class of similar_classes() the row with the smallest doc_id stays. Repeated rows of
    that id count as copies, one of them stays; rows without a doc_id stay as they are."""
    own = similar_classes(docs, least, shingle)
    keep = own.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__quern_keep")).distinct()
    kept = docs.join(keep, docs.doc_id == keep["__quern_keep"], "left_semi")
    return kept.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))
