"""Substring dedup: repeated windows of words are found in prefix-partitioned suffix trees.

The suffixes of all documents are sampled: of each window of W words, the k-word prefix with the least hash (the leftmost on ties) is its
anchor. Equal windows have equal anchors at equal places, so a tree over the suffixes at anchors, with the words to their left, holds
every repeated window; no other suffix is moved. Suffixes are dealt by variable-length prefixes: by the k words of the anchor first, and
where more suffixes share these than fit a memory-sized group, by ever longer ones: windows with so many words left of the anchor share the
more words around it the narrower that range is, and in the end all W. Suffixes with equal words are one before that, the earliest
document's; the others lose what it loses, and all windows. Every group becomes subtrees, one of suffixes and one of reversed left contexts,
named level by level; a window is the pair of a left node and a right node whose depths add up to W, and the deep nodes reached by several
documents are the repeats. Documents with equal words are folded into the one with the smallest id before anything is dealt.

Cases: a null text has no words; a document of fewer than W words loses none; repeated rows of one id don't remove each other, for
neither id is smaller; rows with a null id keep all words and remove none; an empty table gives no rows; a very long text is one row's
words at a time; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, cut_parquet, join_stats, row_key, tune

#: Words of a window, words of an anchor's prefix, suffixes of a prefix from which equal ones are made one, suffixes of a group in memory.
W, K, HOT, GROUP = 50, 8, 512, 16_384
#: Into how many ranges the words left of an anchor are parted, as prefixes grow.
RANGES = (4, 16)
MULT = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(w: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, w), np.uint64, len(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def grams(h: np.ndarray, k: int, mult: np.uint64 = MULT) -> np.ndarray:
    """A hash of each k consecutive words, by doubling."""
    out, done, powers, acc = None, 0, h, None
    size, base = 1, mult
    while k >= size:  # acc holds grams of the low bits of k
        if k & size:
            if acc is None:
                acc, done = powers, size
            else:
                n = len(h) - done - size + 1
                acc = _mix(acc[:n] * base + powers[done : done + n])
                done += size
        n = len(h) - 2 * size + 1
        if n > 0:
            powers = _mix(powers[:n] * base + np.roll(powers, -size)[:n])
        size *= 2
    out = acc
    return out[: len(h) - k + 1]


def anchors(h: np.ndarray, w: int = W, k: int = K) -> tuple[np.ndarray, ...]:
    """key, position, first and last window start of each anchor."""
    g = grams(h, k)
    span = w - k + 1
    value, at, size = g, np.arange(len(g)), 1

    def least(v1, a1, v2, a2):
        left = v1 <= v2
        return np.where(left, v1, v2), np.where(left, a1, a2)

    while size * 2 <= span:
        value, at = least(value[:-size], at[:-size], value[size:], at[size:])
        size *= 2
    rest = span - size
    n = len(h) - w + 1
    value, at = least(value[:n], at[:n], value[rest : rest + n], at[rest : rest + n])
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:] - 1, n - 1)
    return g[at[first]].view(np.int64), at[first], first, last


def _sketch(docs: DataFrame, w: int, k: int) -> DataFrame:
    """k1, k2, fold (a digest of the words), anchors (key, p, lo, hi); documents of at least w words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("key", pa.int64()), ("p", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
        for b in batches:
            rows, folds, parts, sizes = [], [], [], [0]
            for i, t in enumerate(b["text"]):
                ws = split(t.as_py())
                if len(ws) < w:
                    continue
                parts.append(anchors(word_hashes(ws), w, k))
                rows.append(i)
                folds.append(hashlib.blake2b(b" ".join(ws), digest_size=16).digest())
                sizes.append(sizes[-1] + len(parts[-1][0]))
            cols = [np.concatenate([p[j] for p in parts]) if parts else np.zeros(0, np.int64) for j in range(4)]
            flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind, strict=True)], fields=list(kind))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b["k1"].take(take), b["k2"].take(take), pa.array(folds, pa.binary()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)], ["k1", "k2", "fold", "anchors"])

    return docs.mapInArrow(run, "k1 long, k2 long, fold binary, anchors array<struct<key:long,p:int,lo:int,hi:int>>")


def _entries(docs: DataFrame, w: int) -> DataFrame:
    """Suffixes with their contexts; where the prefix is hot, also a digest of their words."""
    names = ["hot", "key", "d1", "d2", "k1", "k2", "starts", "off", "n", "left", "right"]
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for k1, k2, text, found in zip(b["k1"].to_pylist(), b["k2"].to_pylist(), b["text"], b["found"], strict=True):
                ws, seen = split(text.as_py()), {}
                for a in found.as_py():
                    lo, hi, p = a["lo"], a["hi"], a["p"]
                    left, right = b" ".join(ws[lo:p]), b" ".join(ws[p : hi + w])
                    x = (left, right, p - lo, hi - lo)
                    if x in seen:
                        seen[x].append(lo)
                        continue
                    seen[x] = starts = [lo]
                    for col, v in zip(out, (a["hot"], a["key"], *(_digest(left, right) if a["hot"] else (None, None)), k1, k2, starts, p - lo, hi - lo, left, right), strict=True):
                        col.append(v)
                if len(out[0]) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return docs.mapInArrow(run, "hot boolean, key long, d1 long, d2 long, k1 long, k2 long, starts array<int>, off int, n int, left binary, right binary")


def _digest(*parts: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(b"\n".join(parts), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _levels(rows: list[list[int]], depth: int, need: np.ndarray) -> np.ndarray:
    """The tree of the rows, level by level: node[d, i] names the node at depth d above row i, -1 below its end."""
    m = len(rows)
    words = np.full((m, depth), -1, np.int64)
    for i, r in enumerate(rows):
        words[i, : len(r)] = r[:depth]
    node = np.zeros((depth + 1, m), np.int64)
    base = int(words.max(initial=0)) + 2
    for d in range(1, depth + 1):
        x = node[d - 1] * base + words[:, d - 1] + 1
        dead = (words[:, d - 1] < 0) | (node[d - 1] < 0)
        _, node[d] = np.unique(x, return_inverse=True)
        node[d][dead] = -1
    return node


def repeats(group: list[tuple], w: int = W) -> Iterator[tuple[int, int, int, int]]:
    """From suffixes (k1, k2, starts, off, n, left, right) of whole prefixes: k1, k2, first and last start of windows of which a smaller
    k1 has an equal one. The window j of an entry starts at starts + j and has off - j words to the left of the anchor."""
    ids: dict[bytes, int] = {}
    name = lambda x: ids.setdefault(x, len(ids))
    left = [[name(x) for x in reversed(e[5].split())] for e in group]
    right = [[name(x) for x in e[6].split()] for e in group]
    doc = np.array([e[0] for e in group], np.int64)
    off = np.array([e[3] for e in group])
    n = np.array([e[4] for e in group])
    deepest = int(off.max())
    down, up = _levels(right, w, n), _levels(left, deepest, off)
    removed = np.zeros((len(group), int(n.max()) + 1), bool)
    for o in range(deepest + 1):  # o words to the left
        on = np.flatnonzero((o <= off) & (o >= off - n))
        if len(on) < 2:
            continue
        a, c = up[o, on], down[w - o, on]
        _, node = np.unique(a * (int(c.max()) + 2) + c, return_inverse=True)
        least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, doc[on])
        hit = on[least[node] < doc[on]]
        removed[hit, off[hit] - o] = True
    for i in np.flatnonzero(removed.any(axis=1)):
        row = np.flatnonzero(removed[i, : n[i] + 1])
        for run in np.split(row, np.flatnonzero(np.diff(row) > 1) + 1):
            for s in group[i][2]:
                yield group[i][0], group[i][1], s + int(run[0]), s + int(run[-1])


def _trees(entries: DataFrame, w: int, size: int) -> DataFrame:
    """k1, k2, a, b: runs of repeated window starts. Tasks get whole prefixes in order and build trees of several at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "a", "b"]

        def found(group: list[tuple]) -> pa.RecordBatch:
            rows = list(repeats(group, w)) if len(group) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], names)

        group: list[tuple] = []
        last = None
        for b in batches:
            for key, *row in zip(*(b[c].to_pylist() for c in ("key", "k1", "k2", "starts", "off", "n", "left", "right")), strict=True):
                if key != last and len(group) >= size:
                    yield found(group)
                    group = []
                group.append(tuple(row))
                last = key
        yield found(group)

    cols = ("key", "k1", "k2", "starts", "off", "n", "left", "right")
    return entries.select(*cols).repartition("key").sortWithinPartitions("key").mapInArrow(run, "k1 long, k2 long, a long, b long")


BLOCK = "d1 long, d2 long, least long, key long, key2 long, shift int, off int, n int, left binary, right binary"


def _block_trees(blocks: DataFrame, w: int, size: int) -> DataFrame:
    """d1, d2, lo, hi: runs of a block's windows that a block of an earlier document has too. Like _trees()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(group: list[tuple]) -> pa.RecordBatch:
            # a suffix stands for its place in the group
            rows = [(*group[i][:2], lo, hi) for _, i, lo, hi in repeats([(g[2], i, [g[3]], *g[4:]) for i, g in enumerate(group)], w)] if len(group) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(4)], ["d1", "d2", "lo", "hi"])

        group: list[tuple] = []
        last = None
        for b in batches:
            for key, *row in zip(*(b[c].to_pylist() for c in ("key", "d1", "d2", "least", "shift", "off", "n", "left", "right")), strict=True):
                if key != last and len(group) >= size:
                    yield found(group)
                    group = []
                group.append(tuple(row))
                last = key
        yield found(group)

    return blocks.repartition("key").sortWithinPartitions("key").mapInArrow(run, "d1 long, d2 long, lo long, hi long")


def drawn(off: int, n: int, left: list[bytes], right: list[bytes], w: int, k: int, ranges: int) -> Iterator[tuple[int, int, int, list[bytes], list[bytes], bytes]]:
    """A suffix's windows dealt by how many words they have left of the anchor: first window, words to the left, number of further windows, left and
    right words, and the words around the anchor that all windows of the range share; in ranges of the same width for every suffix."""
    span = w - k + 1
    for c in range(ranges):
        least, most = c * span // ranges, (c + 1) * span // ranges - 1
        first, last = max(0, off - most), min(n, off - least)
        if least <= most and first <= last:
            own, to = off - first, w - (off - last)
            around = b" ".join([b"%d" % least, *left[len(left) - least :], b"", *right[: w - most]])
            yield first, own, last - first, left[len(left) - own :], right[:to], around


def _drawn_out(blocks: DataFrame, w: int, k: int, ranges: int) -> DataFrame:
    """Blocks with longer prefixes: each in as many parts as ranges have windows of it."""
    names = [c.split()[0] for c in BLOCK.split(", ")]
    kinds = [*[pa.int64()] * 5, *[pa.int32()] * 3, pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in names]
            for d1, d2, least, shift, off, n, left, right in zip(*(b[c].to_pylist() for c in ("d1", "d2", "least", "shift", "off", "n", "left", "right")), strict=True):
                for first, own, more, x, y, around in drawn(off, n, left.split(), right.split(), w, k, ranges):
                    for col, v in zip(out, (d1, d2, least, *_digest(around), shift + first, own, more, b" ".join(x), b" ".join(y)), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return blocks.mapInArrow(run, BLOCK)


def _block_repeats(blocks: DataFrame, w: int, k: int, size: int) -> DataFrame:
    """d1, d2, lo, hi, as _block_trees(), of blocks whose prefixes grow until their groups fit. A window of its own is a leaf: its group needs no more
    than a combined minimum."""
    found, now = [], blocks
    for ranges in (*RANGES, w - k + 1):
        groups = cut(now.groupBy("key").agg(F.count("*").alias("m"), F.min("least").alias("a"), F.max("least").alias("b")).where("a < b").select("key", "m"))
        found.append(_block_trees(join_stats(now, groups.where(F.col("m") <= size), ["key"], "m", "inner"), w, size))
        large = groups.where(F.col("m") > size)
        if large.isEmpty():
            break
        now = cut_parquet(_drawn_out(join_stats(now, large, ["key"], "m", "inner"), w, k, ranges))
    else:
        first = now.groupBy("key", "key2").agg(F.min("least").alias("first"), F.count("*").alias("m")).where("m > 1")
        earlier = join_stats(now, cut(first), ["key", "key2"], "m", "inner").where("first < least")
        found.append(earlier.select("d1", "d2", F.col("shift").cast("long").alias("lo"), F.col("shift").cast("long").alias("hi")))
    union = found[0]
    for x in found[1:]:
        union = union.unionByName(x)
    return union


def _hot(entries: DataFrame, w: int, k: int, size: int) -> DataFrame:
    """k1, k2, runs, of suffixes under hot prefixes. Suffixes with the same words are one block, and all but the block's first document lose all its
    windows; what the first one loses is found among blocks."""
    names = [c.split()[0] for c in BLOCK.split(", ")]
    blocks = entries.groupBy("d1", "d2").agg(F.min("k1").alias("least"), F.count("*").alias("holders"), *[F.first(c).alias(c) for c in ("key", "off", "n", "left", "right")])
    blocks = cut_parquet(blocks.withColumns({"key2": F.lit(0).cast("long"), "shift": F.lit(0)}).select(*names, "holders"))
    earlier = _block_repeats(blocks.select(*names), w, k, size).groupBy("d1", "d2").agg(F.collect_list(F.struct(F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"))).alias("js"))
    # a block has a run for each of its windows at most, so its row is small; one that many documents hold is dealt to many tasks
    of_block = cut(blocks.select("d1", "d2", "least", F.col("holders").alias("m")).join(earlier, ["d1", "d2"], "left"))
    joined = join_stats(entries.select("d1", "d2", "k1", "k2", "starts", "n"), of_block, ["d1", "d2"], "m", "inner")
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    js = F.when(F.col("least") < F.col("k1"), F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi")))).otherwise(F.coalesce("js", none))
    pairs = F.flatten(F.transform("starts", lambda s: F.transform(js, lambda j: F.struct((s + j["lo"]).cast("long").alias("a"), (s + j["hi"]).cast("long").alias("b")))))
    return joined.select("k1", "k2", pairs.alias("runs")).where(F.size("runs") > 0)


def removed_windows(docs: DataFrame, w: int = W, k: int = K, hot: int = HOT, group: int = GROUP) -> DataFrame:
    """k1, k2 (see row_key), runs array<struct<a,b>> of window starts that a smaller doc_id has too, copied: all windows of a document
    whose words are those of a document with a smaller doc_id."""
    tune(docs.sparkSession)
    keyed = docs.where("doc_id is not null").select(*row_key(), "text")
    sketch = cut(_sketch(keyed, w, k))
    copies = sketch.groupBy("fold").agg(F.min("k1").alias("least"), F.max("k1").alias("most"), F.count("*").alias("m")).where("least < most").select("fold", "least", "m")
    marked = join_stats(sketch, cut(copies), ["fold"], "m")
    copied = cut(marked.where("least < k1").select("k1", "k2").distinct())
    each = cut(marked.where("least is null or least = k1").dropDuplicates(["k1", "k2"]).select("k1", "k2", F.explode("anchors").alias("x")).select("k1", "k2", "x.*"))
    # what is joined is cut first, so that Spark sees plain exchanges and can split a prefix that a third of all suffixes have
    shared = cut(each.groupBy("key").agg(F.min("k1").alias("least"), F.max("k1").alias("most"), F.count("*").alias("m")).where("least < most").select("key", (F.col("m") > hot).alias("hot")))
    found = each.join(shared, "key").groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "p", "lo", "hi", "hot")).alias("found"))
    entries = cut_parquet(_entries(keyed.join(found, ["k1", "k2"]).select("k1", "k2", "text", "found"), w))
    cold = _trees(entries.where("not hot"), w, group).select("k1", "k2", F.array(F.struct("a", "b")).alias("runs"))
    runs = cold.unionByName(_hot(entries.where("hot"), w, k, group)).groupBy("k1", "k2").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return cut(runs.withColumn("copied", F.lit(False)).unionByName(copied.select("k1", "k2", F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)").alias("runs"), F.lit(True).alias("copied"))))


def kept_words(ws: list[bytes], runs: tuple[np.ndarray, np.ndarray] | None, copied: bool | None, w: int = W) -> list[bytes]:
    if copied and len(ws) >= w:
        return []
    if runs is None or not len(runs[0]):
        return ws
    cover = np.zeros(len(ws) + 1, np.int64)
    np.add.at(cover, runs[0], 1)
    np.add.at(cover, np.minimum(len(ws), runs[1] + w), -1)
    keep = np.cumsum(cover[:-1]) == 0
    return [x for x, y in zip(ws, keep.tolist(), strict=True) if y]


def dedup(docs: DataFrame, w: int = W, **more: int) -> DataFrame:
    """doc_id, n_words, n_removed, text of the kept words joined by a space, for every row."""
    keyed = docs.select("doc_id", *row_key(), "text")
    joined = keyed.join(removed_windows(docs, w, **more), ["k1", "k2"], "left").select("doc_id", "text", "runs", "copied")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, gone, texts = [], [], []
            for doc_id, t, runs, copied in zip(b["doc_id"].to_pylist(), b["text"], b["runs"], b["copied"].to_pylist(), strict=True):
                ws = split(t.as_py())
                # as numbers, never as objects: a batch has up to a million runs
                ends = tuple(x.to_numpy() for x in runs.values.flatten()) if runs.is_valid else None
                kept = kept_words(ws, ends, copied, w) if doc_id is not None else ws
                n.append(len(ws))
                gone.append(len(ws) - len(kept))
                texts.append(b" ".join(kept).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
