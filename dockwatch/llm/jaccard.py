"""Operator 8: n-gram Jaccard self-join with Bayesian candidate pruning."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, column, components, deal_tiles, list_values, numbers

#: MinHash values, dealt in bands of ``ROWS``: a pair at similarity 0.8 shares no band with probability 2e-5.
BANDS, ROWS = 28, 5
HASHES = BANDS * ROWS
#: Values compared at a time, and values the screening of a bucket carries.
STEP, SCREEN = 20, 60
#: A pair is dropped once the posterior probability of reaching the threshold is below this.
TOLERANCE = 1e-6
#: Words hashed at a time, and pairs looked at together.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 1 << 17, 1 << 19

_MULT = np.random.default_rng(8).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(5).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(text: str) -> Column:
    """64-bit hashes of the words between white space, in order."""
    return F.transform(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), ""), lambda w: F.xxhash64(w))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(words: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of ``n`` words, and their offsets. A shorter row that has words is one run."""
    val, off = list_values(words)
    size = np.diff(off)
    padded = np.where(size > 0, np.maximum(size, n), 0)
    start = np.cumsum(padded) - padded
    flat = np.zeros(int(padded.sum()) + n, np.uint64)
    flat[np.arange(len(val)) + np.repeat(start - off[:-1], size)] = val.view(np.uint64)
    total = len(flat) - n
    h = np.zeros(total, np.uint64)
    for k in range(n):
        h += flat[k:k + total] * _PLACE[k]
    runs = np.where(padded > 0, padded - n + 1, 0)
    ends = np.concatenate([[0], np.cumsum(runs)])
    return _mix(h[np.arange(ends[-1]) + np.repeat(start - ends[:-1], runs)]), ends


def _row_slices(off: np.ndarray, limit: int):
    at = 0
    while at < len(off) - 1:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, min(to, len(off) - 1)
        at = to


def minhashes(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, HASHES) of uint32; every row has a shingle."""
    out = np.empty((len(off) - 1, HASHES), np.uint32)
    buf = np.empty(len(h), np.uint64)
    for k in range(HASHES):
        np.multiply(h, _MULT[k], out=buf)
        out[:, k] = np.minimum.reduceat(buf, off[:-1]) >> np.uint64(32)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as the bytes of a binary value."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _matrix(arr: pa.Array, kind: type, width: int) -> np.ndarray:
    out = b"".join(arr.to_pylist())
    return np.frombuffer(out, kind).reshape(len(arr), width)


def _digest(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits that name a set: equal sets, and by chance of 2^-128 others, get equal ones."""
    return np.array([[s.sum(dtype=np.uint64), _mix(s ^ _PLACE[9]).sum(dtype=np.uint64)] for s in sets],
                    np.uint64).reshape(-1, 2)


def _signatures(n: int):
    def run(batches):
        for b in batches:
            h_off = b.column("words").offsets.to_numpy()
            for i, j in _row_slices(h_off, WORDS_AT_ONCE):
                part = b.slice(i, j - i)
                h, off = shingles(part.column("words"), n)
                sets = [np.unique(h[x:y]) for x, y in zip(off, off[1:])]
                size = np.array([len(s) for s in sets])
                flat = np.concatenate(sets) if sets else h
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _binary(_digest(sets)),
                     _binary(minhashes(flat, np.concatenate([[0], np.cumsum(size)])))],
                    names=["doc_id", "cls", "sig"])

    return run


def _bands(batches):
    for b in batches:
        sig = _matrix(b.column("sig"), np.uint32, HASHES).astype(np.uint64).reshape(-1, BANDS, ROWS)
        key = (sig * _PLACE[10:10 + ROWS]).sum(axis=2, dtype=np.uint64) + _PLACE[16:16 + BANDS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(b.column("cid").to_numpy(), BANDS)), pa.array(_mix(key).reshape(-1).view(np.int64))],
            names=["cid", "bkey"])


def needed_matches(threshold: float, hashes: int, step: int = STEP, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After k compared values: the fewest matches that leave a pair a posterior
    probability of at least ``tolerance`` of a similarity of ``threshold``.

    With a uniform prior, m matches of k give Beta(m + 1, k - m + 1), whose weight above
    t is the chance of at most m successes in k + 1 draws of probability t.
    """
    out = {}
    for k in range(step, hashes + 1, step):
        weight = 0.0
        for m in range(k + 1):
            weight += comb(k + 1, m) * threshold ** m * (1 - threshold) ** (k + 1 - m)
            if weight >= tolerance:
                out[k] = m
                break
    return out


def prune(sig: np.ndarray, i: np.ndarray, j: np.ndarray, need: dict[int, int]) -> np.ndarray:
    """Places of the pairs (i, j) that survive; values are compared a step at a time, dropped pairs no further."""
    alive, match, at = np.arange(len(i)), np.zeros(len(i), np.int64), 0
    for k, m in need.items():
        match = match + (sig[i[alive], at:k] == sig[j[alive], at:k]).sum(axis=1)
        keep = match >= m
        alive, match, at = alive[keep], match[keep], k
    return alive


def whole_groups(batches, keys: list[str]):
    """Tables that end where a group of equal ``keys`` ends, from batches in key order; with each group's start."""
    held: list[pa.Table] = []

    def cut(t):
        change = np.zeros(t.num_rows, bool)
        change[:1] = True
        for k in keys:
            v = numbers(t, k)
            change[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(change)

    for b in batches:
        if not b.num_rows:
            continue
        t = pa.concat_tables([*held, pa.Table.from_batches([b])])
        at = cut(t)
        if at[-1]:
            yield t.slice(0, int(at[-1])), at[:-1]
        held = [t.slice(int(at[-1]))]
    if held:
        yield held[0], np.array([0])


def _pairs_of(t: pa.Table, starts: np.ndarray):
    """Index pairs (i, j) each tile has to look at, in lots of about PAIRS_AT_ONCE."""
    blk, lo, hi = (numbers(t, c) for c in ("blk", "lo", "hi"))
    ends = np.append(starts[1:], t.num_rows)
    size = ends - starts
    one = lo[starts] == hi[starts]
    lot = np.cumsum(size * size) // PAIRS_AT_ONCE
    for g in np.unique(lot):
        left, right = [], []
        for s in np.unique(size[(lot == g) & one]):  # all tiles of one size together
            a, b = np.triu_indices(int(s), 1)
            base = starts[(lot == g) & one & (size == s)][:, None]
            left.append((base + a).reshape(-1))
            right.append((base + b).reshape(-1))
        for s, e in zip(starts[(lot == g) & ~one], ends[(lot == g) & ~one]):
            a, b = s + np.flatnonzero(blk[s:e] == lo[s]), s + np.flatnonzero(blk[s:e] == hi[s])
            left.append(np.repeat(a, len(b)))
            right.append(np.tile(b, len(a)))
        yield np.concatenate(left), np.concatenate(right)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of n rows reaches over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _star(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (node, root) of the pairs, over distinct ids."""
    nodes, at = np.unique(np.concatenate([ids[i], ids[j]]), return_inverse=True)
    root = _roots(len(nodes), at[:len(i)], at[len(i):])
    return nodes, nodes[root]


def _screen(need: dict[int, int], width: int):
    def run(batches):
        for t, starts in whole_groups(batches, ["bkey", "lo", "hi"]):
            sig, cid = _matrix(column(t, "sig"), np.uint32, width), numbers(t, "cid")
            for i, j in _pairs_of(t, starts):
                keep = prune(sig, i, j, need)
                node, root = _star(cid, i[keep], j[keep])
                far = node != root
                yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(root[far])], names=["a", "b"])

    return run


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j) of sorted sets."""
    if len(i) <= 32:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    rows, inv = np.unique(np.concatenate([i, j]), return_inverse=True)
    size = [len(sets[r]) for r in rows]
    _, col = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
    line = np.repeat(np.arange(len(rows)), size)
    both = np.zeros((len(rows), len(rows)), np.float64)
    for a in range(0, int(col.max(initial=-1)) + 1, 4096):
        part = (col >= a) & (col < a + 4096)
        has = np.zeros((len(rows), 4096), np.float32)
        has[line[part], col[part] - a] = 1
        both += has @ has.T
    return both[inv[:len(i)], inv[len(i):]].astype(np.int64)


def _verify(need: dict[int, int], threshold: float):
    def run(batches):
        for t, starts in whole_groups(batches, ["cluster", "lo", "hi"]):
            sig, cid, weight = _matrix(column(t, "sig"), np.uint32, HASHES), numbers(t, "cid"), numbers(t, "n_docs")
            sets = [np.frombuffer(x, np.uint64) for x in column(t, "shingles").to_pylist()]
            size = np.array([len(s) for s in sets])
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
            for i, j in _pairs_of(t, starts):
                keep = prune(sig, i, j, need)
                i, j = i[keep], j[keep]
                both = np.zeros(len(i), np.int64)
                for g in np.unique(group[i]):
                    of = group[i] == g
                    both[of] = _overlaps(sets, i[of], j[of])
                near = both >= threshold * (size[i] + size[j] - both) - 1e-9
                i, j = i[near], j[near]
                links = np.zeros(t.num_rows, np.int64)
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                node, root = _star(cid, i, j)
                found = np.flatnonzero(links)
                at = np.searchsorted(node, cid[found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[found]), pa.array(links[found]), pa.array(root[at])], names=["cid", "links", "root"])

    return run


def _shingle_sets(n: int):
    def run(batches):
        for b in batches:
            for i, j in _row_slices(b.column("words").offsets.to_numpy(), WORDS_AT_ONCE):
                part = b.slice(i, j - i)
                h, off = shingles(part.column("words"), n)
                sets = [np.unique(h[x:y]) for x, y in zip(off, off[1:])]
                # a doc_id that stands for several texts: only the class's own
                own = np.array(_binary(_digest(sets)).to_pylist(), object) == np.array(part.column("cls").to_pylist(), object)
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("cid").take(pa.array(at)), pa.array([sets[k].tobytes() for k in at], pa.binary())],
                    names=["cid", "shingles"])

    return run


def jaccard_links(docs: DataFrame, threshold: float = 0.8, n: int = 5, block: int = 256) -> DataFrame:
    """Links between documents whose sets of ``n``-word shingles have a Jaccard similarity of ``threshold`` or more.

    ``docs``: doc_id, text. Returns one row per document: class_id (smallest doc_id with the same
    shingle set), n_links (other documents linked directly, copies included), group_id (smallest doc_id
    reachable by links), kept (doc_id = group_id).

    1. Equal shingle sets become one class with a weight: copies meet nowhere below.
    2. Classes that share a MinHash band meet in a bucket, large ones in tiles; pairs are dropped there by the posterior of
       ``needed_matches``. A bucket returns a spanning star of the survivors, never its pairs.
    3. The components of the stars hold every surviving pair; the classes of a component meet once, with all MinHash values and
       whole sets, in tiles: pruned again, the rest verified exactly. Tiles return counts and a spanning star.

    What can be missed: a pair without a common band (2e-5 at the threshold, less above) or
    dropped by the posterior (1e-6). Words stand between ASCII white space, with case. Documents of fewer than ``n`` words are
    one shingle. Null and empty texts and null doc_ids link with nothing and are kept. Repeated rows count
    once; a doc_id with several texts gives a row for each. Other columns are ignored.
    """
    return _links(docs, threshold, n, block, Scratch(docs.sparkSession, "jaccard")).drop("cls")


def _links(docs: DataFrame, threshold: float, n: int, block: int, scratch: Scratch) -> DataFrame:
    """:func:`jaccard_links` with ``cls``, the digest of the row's shingle set (null: it has none)."""
    src = docs.select(F.col("doc_id").cast("long"), word_hashes("text").alias("words"))
    takes_part = F.col("doc_id").isNotNull() & (F.size("words") > 0)
    signed = scratch.table(src.where(takes_part).mapInArrow(_signatures(n), "doc_id long, cls binary, sig binary"))
    ids = scratch.table(signed.select("doc_id", "cls").distinct())
    weights = ids.groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_docs"))
    classes = scratch.table(signed.groupBy("cls").agg(F.first("sig").alias("sig")).join(weights, "cls").select(
        F.monotonically_increasing_id().alias("cid"), "cls", "class_id", "n_docs", "sig"))
    scratch.drop(signed)

    bands = classes.select("cid", "sig").mapInArrow(_bands, "cid long, bkey long")
    width = min(SCREEN, HASHES)
    heads = classes.select("cid", F.substring("sig", 1, 4 * width).alias("sig"))
    met = _in_tiles(deal_tiles(bands, "bkey", "cid", 2 * block).join(heads, "cid"), "bkey")
    stars = met.mapInArrow(_screen(needed_matches(threshold, width), width), "a long, b long").distinct()
    clusters = scratch.table(components(stars, scratch).withColumnsRenamed({"node": "cid", "root": "cluster"}))

    member = clusters.join(classes.select("cid", "cls", "class_id"), "cid")
    sets = (src.join(member.select(F.col("class_id").alias("doc_id"), "cid", "cls"), "doc_id")
            .select("cid", "cls", "words").mapInArrow(_shingle_sets(n), "cid long, shingles binary")
            .dropDuplicates(["cid"]))
    whole = scratch.table(sets.join(clusters, "cid").join(classes.select("cid", "n_docs", "sig"), "cid"))
    tiles = _in_tiles(deal_tiles(whole, "cluster", "cid", block), "cluster")
    found = scratch.table(tiles.mapInArrow(_verify(needed_matches(threshold, HASHES), threshold),
                                           "cid long, links long, root long"))
    scratch.drop(whole)
    roots = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch)
    roots = roots.select(F.col("node").alias("cid"), "root").join(classes.select("cid", "class_id"), "cid")
    groups = roots.join(roots.groupBy("root").agg(F.min("class_id").alias("group_id")), "root").select("cid", "group_id")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    per = (classes.select("cid", "cls", "class_id", "n_docs").join(counts, "cid", "left").join(groups, "cid", "left")
           .select("cls", "class_id", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
                   F.coalesce("group_id", "class_id").alias("group_id")))
    linked = ids.join(per, "cls").select("doc_id", "class_id", "n_links", "group_id", "cls")
    alone = src.where(~takes_part).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("group_id"),
        F.lit(None).cast("binary").alias("cls"))
    return linked.union(alone.distinct()).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("group_id")))


def _in_tiles(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """``docs`` with one document of each group of linked ones (the smallest doc_id). Repeated rows become one;
    rows of a null doc_id all stay. Of a doc_id with several texts those stay that are kept themselves."""
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    links = scratch.table(_links(docs, threshold, n, 256, scratch).where("doc_id IS NOT NULL").select("doc_id", "cls", "kept"))
    verdict = links.groupBy("doc_id").agg(F.max("kept").alias("some"), F.min("kept").alias("every"))
    first = docs.join(verdict.where("every").select("doc_id"), "doc_id", "left_semi")

    # ids of which one text is kept and another not: each row by its own shingle set
    mixed = docs.join(verdict.where("some AND NOT every").select("doc_id"), "doc_id", "left_semi")
    mixed = scratch.table(mixed.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")))
    words = mixed.select(F.col("at").alias("doc_id"), word_hashes("row.text").alias("words")).where("size(words) > 0")
    cls = words.mapInArrow(_signatures(n), "doc_id long, cls binary, sig binary").select(F.col("doc_id").alias("at"), "cls")
    own = mixed.join(cls, "at", "left").select("row", "cls").alias("m")
    kept = links.where("kept").alias("k")
    stay = own.join(kept, (F.col("m.row.doc_id") == F.col("k.doc_id")) & F.col("m.cls").eqNullSafe(F.col("k.cls")), "left_semi")
    return (first.unionByName(stay.select("row.*")).dropDuplicates(["doc_id", "text"])
            .unionByName(docs.where("doc_id is null")))
