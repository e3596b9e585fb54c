"""Operator 6: stupid-backoff scores from bigram and unigram counts of a corpus."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.jaccard import _mix, _row_slices, word_hashes
from dockwatch.llm.shared import Scratch, column, list_values

#: Words whose counts every task holds: the most frequent ones, at most this many. Their places are numbers of 16 bits.
FREQUENT = (1 << 16) - 1
#: A slice names a pair that is likely frequent once it makes up one in so many of the slice's pairs.
LIKELY = 1 << 13
#: Parts of a corpus that is scored by the counts of its other parts: one for each first digit of the id's md5.
FOLDS = 16
#: N-grams a hash partition has room for. A document gets a sum from each partition it has n-grams in,
#: so partitions are as large as a task's memory allows.
PART_GRAMS = 6_000_000
#: The same where both words of an n-gram travel.
FOLD_PART_GRAMS = 4_000_000
#: Rare words a task counts before it sends them.
RARE_HELD = 1 << 22
#: Rows of dense counts that are added up at a time.
FAN = 256
#: Words a task packs at a time.
WORDS_AT_ONCE = 1 << 19
_FIRST, _SECOND = np.uint64(0x9E6C63D0876A9A47), np.uint64(0xD1342543DE82EF95)
_NO_ID = -(1 << 63)
PACKED = "part int, docs binary, runs binary, a binary, b binary"


def _bigrams(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _mix(v * _FIRST + w * _SECOND + (w >> np.uint64(32)))


def _groups(part: np.ndarray, doc: np.ndarray):
    """The order by hash partition, and for each one its number, its rows' bounds, its documents and how many rows each has."""
    # rows are in document order; small numbers are sorted by radix
    order = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")
    part, doc = part[order], doc[order]
    edges = np.flatnonzero(np.diff(part)) + 1
    out = []
    for s, e in zip(np.append(0, edges), np.append(edges, len(part))):
        if s < e:
            start = np.flatnonzero(np.append(True, doc[s + 1:e] != doc[s:e - 1]))
            runs = np.diff(np.append(start, e - s)).astype(np.int32)
            out.append((int(part[s]), s, e, doc[s:e][start].tobytes(), runs.tobytes()))
    return order, out


def _packed(rows: list[tuple], schema: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n == "part" else pa.binary()) for n, c in zip(schema, cols)],
                                      names=schema)


def _pack(part: np.ndarray, doc: np.ndarray, cols: list[np.ndarray], schema: list[str]):
    """One row per hash partition: the values of ``cols`` in document order, and how many each document has."""
    order, groups = _groups(part, doc)
    cols = [c[order] for c in cols]
    return _packed([(p, docs, runs, *(c[s:e].tobytes() for c in cols)) for p, s, e, docs, runs in groups], schema)


def _pack_coded(part: np.ndarray, doc: np.ndarray, pairs: np.ndarray, codes: np.ndarray):
    """As ``_pack`` for pairs (n, 2) of words: their codes (column a), and the hashes of those without one (b)."""
    order, groups = _groups(part, doc)
    codes = codes[order].reshape(-1)
    none = codes == FREQUENT
    rest = pairs[order].reshape(-1)[none]
    ends = np.append(0, np.cumsum(none))
    return _packed([(p, docs, runs, codes[2 * s:2 * e].tobytes(), rest[ends[2 * s]:ends[2 * e]].tobytes())
                    for p, s, e, docs, runs in groups], ["part", "docs", "runs", "a", "b"])


def _slices(batches):
    for b in batches:
        for i, j in _row_slices(b.column("words").offsets.to_numpy(), WORDS_AT_ONCE):
            yield b.slice(i, j - i)


def _words(b: pa.RecordBatch):
    """Word hashes, and for each word: its document's id, whether it begins and whether it ends the document."""
    val, off = list_values(b.column("words"))
    w = val.view(np.uint64)
    size = np.diff(off)
    first, last = np.zeros(len(w), bool), np.zeros(len(w), bool)
    first[off[:-1][size > 0]] = True
    last[off[1:][size > 0] - 1] = True
    return w, np.repeat(b.column("doc_id").to_numpy(), size), first, last


def _find(keys: np.ndarray, asked: np.ndarray):
    """Places in sorted ``keys``, and where the asked ones are found."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def _pairs(b: pa.RecordBatch):
    """Word hashes, their documents, whether they begin or end one, the places of pairs' second words, and the pairs' hashes."""
    w, doc, first, last = _words(b)
    at = np.flatnonzero(~first)
    return w, doc, first, last, at, _bigrams(w[at - 1], w[at])


def _likely_pairs(batches):
    """Pairs of a slice that may be frequent, at most ``LIKELY``, with their counts there: a pair named by no slice makes up less
    than one in ``LIKELY`` of all."""
    for b in _slices(batches):
        g = _pairs(b)[-1]
        keys, n = np.unique(g, return_counts=True)
        keep = n * LIKELY >= len(g)
        yield pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(n[keep])], names=["g", "n"])


def _folds_of(b: pa.RecordBatch, each: np.ndarray) -> np.ndarray:
    """The fold of the document of each word that ``each`` picks."""
    return np.repeat(b.column("fold").to_numpy(), np.diff(b.column("words").offsets.to_numpy()))[each].astype(np.int64)


def _likely(batches):
    """Words (kind 0) and pairs (kind 1) of a slice that may be frequent, with their counts there: at most ``FREQUENT`` and
    ``LIKELY`` of them."""
    for b in _slices(batches):
        w, *_, g = _pairs(b)
        for kind, all_, most in ((0, w, FREQUENT), (1, g, LIKELY)):
            keys, n = np.unique(all_, return_counts=True)
            keep = n * most >= len(all_)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(keep.sum(), kind, np.int32)), pa.array(keys[keep].view(np.int64)),
                                              pa.array(n[keep], pa.int64())], names=["kind", "key", "n"])


def _most(named: DataFrame, kind: int, most: int) -> np.ndarray:
    """Sorted hashes of the most frequent words or pairs named."""
    top = named.where(F.col("kind") == kind).orderBy(F.desc("n"), "key").limit(most).toArrow()
    return np.sort(top.column("key").to_numpy().view(np.uint64))


DENSE = "kind int, fold int, node long, counts binary"


def _dense_row(kind: int, fold: int, node: int, counts: np.ndarray) -> pa.RecordBatch:
    raw = pa.compress(np.ascontiguousarray(counts), "zstd", asbytes=True) if len(counts) else b""
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([fold], pa.int32()), pa.array([node], pa.int64()),
                                       pa.array([raw], pa.binary())], names=["kind", "fold", "node", "counts"])


def _task_counts(known: np.ndarray, hot: np.ndarray):
    """A task's counts by fold: of the frequent words (kind 0), of the frequent pairs (kind 1), of all words (kind 2)."""
    sizes = [len(known), len(hot), 1]

    def run(batches):
        sums = [np.zeros(FOLDS * n, np.int64) for n in sizes]
        for b in _slices(batches):
            w, _, _, _, pair, g = _pairs(b)
            fold = _folds_of(b, slice(None))
            for total, keys, asked, f in ((sums[0], known, w, fold), (sums[1], hot, g, fold[pair])):
                at, hit = _find(keys, asked)
                total += np.bincount(f[hit] * len(keys) + at[hit], minlength=len(total))
            sums[2] += np.bincount(fold, minlength=FOLDS)
        node = TaskContext.get().partitionId()
        for kind, total in enumerate(sums):
            for fold, counts in enumerate(total.reshape(FOLDS, -1)):
                yield _dense_row(kind, fold, node, counts)

    return run


def _added(sizes: list[int]):
    def run(t: pa.Table) -> pa.Table:
        kind, fold, node = (column(t, n)[0].as_py() for n in ("kind", "fold", "node"))
        total = np.zeros(sizes[kind], np.int64)
        for raw in column(t, "counts"):
            if len(total):
                total += np.frombuffer(pa.decompress(raw.as_py(), total.nbytes, "zstd", asbytes=True), np.int64)
        return pa.Table.from_batches([_dense_row(kind, fold, node, total)])

    return run


def _dense_counts(src: DataFrame, known: np.ndarray, hot: np.ndarray, scratch: Scratch) -> list[np.ndarray]:
    """Exact counts, (size, FOLDS) for each kind of ``_task_counts``, added up by a tree of ``FAN`` tasks a node."""
    sizes = [len(known), len(hot), 1]
    rows = scratch.table(src.mapInArrow(_task_counts(known, hot), DENSE))
    top = rows.agg(F.max("node")).first()[0] or 0
    while True:
        top //= FAN
        rows = rows.withColumn("node", F.expr(f"node div {FAN}")).groupBy("kind", "fold", "node").applyInArrow(_added(sizes), DENSE)
        if not top:
            break
    out = [np.zeros((n, FOLDS), np.int64) for n in sizes]
    for r in rows.collect():  # a row for each kind and fold
        if sizes[r.kind]:
            out[r.kind][:, r.fold] = np.frombuffer(pa.decompress(r.counts, 8 * sizes[r.kind], "zstd", asbytes=True), np.int64)
    return out


def _counts_of(hot: np.ndarray):
    """A task's counts of the frequent pairs, added up over its slices."""
    def run(batches):
        total = np.zeros(len(hot), np.int64)
        for b in _slices(batches):
            at, hit = _find(hot, _pairs(b)[-1])
            total += np.bincount(at[hit], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["at", "n"])

    return run


def _frequent_pairs(base: DataFrame, src: DataFrame | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of at most ``most`` frequent pairs of the corpus or of the documents, and their exact counts in the corpus."""
    both = base if src is None else base.union(src)
    named = both.mapInArrow(_likely_pairs, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    hot = np.sort(named.orderBy(F.desc("n"), "g").limit(most).toArrow().column("g").to_numpy().view(np.uint64))
    found = base.mapInArrow(_counts_of(hot), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(len(hot), np.int64)
    count[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return hot, count


def _count_rows(parts: int, hot: np.ndarray):
    """Rare bigrams of the corpus, packed by hash partition."""

    def run(batches):
        for b in _slices(batches):
            g = _pairs(b)[-1]
            g = g[~_find(hot, g)[1]]
            yield _pack((g % np.uint64(parts)).astype(np.int64), np.zeros(len(g), np.int64),
                        [g, np.zeros(len(g), np.int8)], ["part", "docs", "runs", "a", "b"])

    return run


def _score_rows(parts: int, hot: np.ndarray):
    """Rare bigrams of documents outside the corpus: both words, as an unseen pair asks for its second word alone."""

    def run(batches):
        for b in _slices(batches):
            w, doc, _, _, at, g = _pairs(b)
            rare = ~_find(hot, g)[1]
            at, g = at[rare], g[rare]
            yield _pack((g % np.uint64(parts)).astype(np.int64), doc[at], [w[at - 1], w[at]],
                        ["part", "docs", "runs", "a", "b"])

    return run


def _joined(t: pa.Table, name: str, kind) -> np.ndarray:
    """The bytes of all rows of a binary column as one array, without a copy."""
    arr = column(t, name)
    off = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1]
    if not len(arr) or off[0] == off[-1]:
        return np.zeros(0, kind)
    return np.frombuffer(arr.buffers()[2], np.uint8)[off[0]:off[-1]].view(kind)


#: Where ``words`` is given, it has the number of words of each document.
ASKED = "part int, docs binary, runs binary, a binary, b binary, s binary, words binary"


def _result(part, docs, runs, words, coef, sums, sizes=None):
    return pa.table({"part": pa.array([part], pa.int32()), "docs": pa.array([docs.tobytes()], pa.binary()),
                     "runs": pa.array([runs.astype(np.int32).tobytes()], pa.binary()),
                     "a": pa.array([words.tobytes()], pa.binary()), "b": pa.array([coef.astype(np.int8).tobytes()], pa.binary()),
                     "s": pa.array([sums.astype(np.float64).tobytes()], pa.binary()),
                     "words": pa.array([None if sizes is None else sizes.astype(np.int64).tobytes()], pa.binary())})


def _sums(runs: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(runs) - runs) if len(runs) else np.zeros(0)


def _seen_in_corpus(alpha: float, total: int):
    def run(counted: pa.Table, scored: pa.Table) -> pa.Table:
        keys, n = np.unique(_joined(counted, "a", np.uint64), return_counts=True)
        v, w = _joined(scored, "a", np.uint64), _joined(scored, "b", np.uint64)
        g, runs = _bigrams(v, w), _joined(scored, "runs", np.int32)
        at = np.searchsorted(keys, g)
        seen = np.zeros(len(g), bool)
        if len(keys):
            at = np.minimum(at, len(keys) - 1)
            seen = keys[at] == g
        s = np.full(len(g), math.log(alpha) - math.log(max(total, 1)))
        s[seen] = np.log(n[at[seen]])
        # seen: less the first word's count; unseen: the second word's alone
        return _result(-1, _joined(scored, "docs", np.int64), runs, np.where(seen, v, w), np.where(seen, -1, 1), _sums(runs, s))

    return run


def _own_asks(total: int, alpha: float, hot: np.ndarray, count: np.ndarray):
    """What documents ask of the unigram table: the first word's count over all words, and what their frequent pairs ask.
    Frequent pairs are scored here."""

    def run(batches):
        for b in _slices(batches):
            w, _, first, _, pair, g = _pairs(b)
            at, hit = _find(hot, g)
            pair, n = pair[hit], count[at[hit]]
            coef = first.astype(np.int64)
            # seen: less the first word's count; unseen: the second word's alone
            coef[pair[n > 0] - 1] -= 1
            coef[pair[n == 0]] += 1
            use = coef != 0
            size = np.diff(b.column("words").offsets.to_numpy())
            ends = np.append(0, np.cumsum(use))
            stop = np.cumsum(size)
            runs = ends[stop] - ends[stop - size]
            s = np.where(size > 0, -math.log(max(total, 1)), 0.0)
            log_n = np.where(n > 0, np.log(np.maximum(n, 1)), math.log(alpha) - math.log(max(total, 1)))
            s = s + np.bincount(np.repeat(np.arange(len(size)), size)[pair], log_n, len(size))
            yield _result(-1, b.column("doc_id").to_numpy(), runs, w[use], coef[use], s, size).to_batches()[0]

    return run


def _frequent_first(parts: int, known: np.ndarray, count: np.ndarray):
    """Answer what is asked of frequent words; pack the rest by hash partition. What is asked of a fold's counts (a column of
    ``count``) has the fold in its coefficient: plus or minus 1 + fold."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                docs, runs = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["runs"], np.int32)
                w, coef, s = (np.frombuffer(row[k], t) for k, t in (("a", np.uint64), ("b", np.int8), ("s", np.float64)))
                owner = np.repeat(np.arange(len(docs)), runs)
                at = np.minimum(np.searchsorted(known, w), max(len(known) - 1, 0))
                hit = known[at] == w if len(known) else np.zeros(len(w), bool)
                s = s + np.bincount(owner[hit], np.sign(coef[hit]) * np.log(count[at[hit], np.abs(coef[hit]) - 1]), len(docs))
                sizes = row["words"] and np.frombuffer(row["words"], np.int64)
                yield _result(-1, docs, runs * 0, w[:0], coef[:0], s, sizes).to_batches()[0]
                rest = ~hit
                packed = _pack((w[rest] % np.uint64(parts)).astype(np.int64), docs[owner[rest]], [w[rest], coef[rest]],
                               ["part", "docs", "runs", "a", "b"])
                if packed.num_rows:
                    none = pa.nulls(packed.num_rows, pa.binary())
                    yield packed.append_column("s", none).append_column("words", none)

    return run


def _answer(counted: pa.Table, asked: pa.Table) -> pa.Table:
    """One hash partition of the unigram table joined to what is asked of it. A word the corpus has not counts once."""
    docs = pa.table({"doc_id": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
    if not asked.num_rows:
        return docs
    keys = column(counted, "w").to_numpy(zero_copy_only=False).view(np.uint64)
    n = column(counted, "n").to_numpy(zero_copy_only=False)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    w, coef, runs = _joined(asked, "a", np.uint64), _joined(asked, "b", np.int8), _joined(asked, "runs", np.int32)
    c = np.ones(len(w))
    if len(keys):
        at = np.minimum(np.searchsorted(keys, w), len(keys) - 1)
        c = np.where(keys[at] == w, n[at], 1)
    return pa.table({"doc_id": pa.array(_joined(asked, "docs", np.int64)), "s": pa.array(_sums(runs, coef * np.log(c)))})


def _sums_of(batches):
    for b in batches:
        for row in b.to_pylist():
            docs = np.frombuffer(row["docs"], np.int64)
            n = np.frombuffer(row["words"], np.int64) if row["words"] else np.zeros(len(docs), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(n), pa.array(np.frombuffer(row["s"], np.float64))],
                                             names=["doc_id", "n", "s"])


def score_documents(docs: DataFrame, corpus: DataFrame, alpha: float = 0.4, part_grams: int = PART_GRAMS,
                    frequent: int = FREQUENT) -> DataFrame:
    """Natural log of the stupid-backoff score of every whole document by a bigram model.

    A word scores count(pair) / count(word before), or alpha * count(word) / all words where the corpus has
    no such pair; the first word scores count(word) / all words, a word the corpus does not know counts
    once. Counts are exact and over all documents of ``corpus``; documents that are part of it are scored by their
    own words too (``score_by_folds`` leaves them out). Returns doc_id, n_words, log_score, and mean_log_score per word.

    N-grams are exploded to 64-bit hashes, packed by hash partition (one row per task and partition instead of one per n-gram),
    counted there, and joined there to what documents ask; sums go back by document. Partitions are sized from the number of
    words. The most frequent words and pairs, at most ``frequent`` of each, are joined before the shuffle. A pair that is not
    among them makes up less than one in ``LIKELY`` plus one in ``frequent`` of all, so none makes a partition large.

    Words stand between ASCII white space, with case. Null and empty texts have no words and score 0 (mean null). Rows that
    share a doc_id (null too) are parts of one document. No documents: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id")
    src = docs.select(ident, word_hashes("text").alias("words"))
    base = corpus.select(F.lit(0).cast("long").alias("doc_id"), word_hashes("text").alias("words"))

    table = scratch.table(base.select(F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    total = table.agg(F.sum("n")).first()[0] or 0
    top = table.orderBy(F.desc("n"), "w").limit(frequent).toArrow()
    known = top.column("w").to_numpy().view(np.uint64)
    order = np.argsort(known)
    known, count = known[order], top.column("n").to_numpy()[order]
    hot, pair_count = _frequent_pairs(base, src, frequent)
    parts = max(12, -(-total // part_grams))
    rare_parts = max(12, -(-(total - int(count.sum())) // part_grams))

    pairs = base.mapInArrow(_count_rows(parts, hot), PACKED)
    asked = src.mapInArrow(_score_rows(parts, hot), PACKED)
    seen = pairs.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(_seen_in_corpus(alpha, total), ASKED)
    own, settle = _own_asks(total, alpha, hot, pair_count), _frequent_first(rare_parts, known, count[:, None])
    asks = src.mapInArrow(lambda batches: settle(own(batches)), ASKED)
    return _totals(asks.union(seen.mapInArrow(settle, ASKED)), table.select(_part_of("w", rare_parts), "w", "n"), rare_parts, _answer)


def _part_of(word: str, parts: int):
    """The hash partition of a word: its hash as an unsigned number, modulo ``parts``."""
    return F.expr(f"cast(pmod({word} % {parts} + if({word} < 0, {(1 << 64) % parts}, 0), {parts}) as int)").alias("part")


def _totals(asked: DataFrame, rare: DataFrame, parts: int, answer) -> DataFrame:
    """Scores by document from what is settled (part -1) and what is still asked of the table of rare words. Settled rows take the same
    shuffle, spread over its partitions, so nothing is computed or written twice."""
    def run(counted: pa.Table, t: pa.Table) -> pa.Table:
        ready = pc.less(t.column("part"), 0)
        own = pa.Table.from_batches(_sums_of(t.filter(ready).to_batches()), pa.schema(
            [("doc_id", pa.int64()), ("n", pa.int64()), ("s", pa.float64())]))
        rest = answer(counted, t.filter(pc.invert(ready)))
        return pa.concat_tables([own, rest.add_column(1, "n", pa.array(np.zeros(rest.num_rows, np.int64)))])

    at = F.when(F.col("part") < 0, F.pmod(F.xxhash64("docs", "s"), F.lit(parts))).otherwise(F.col("part")).cast("int")
    out = rare.groupBy("part").cogroup(asked.withColumn("at", at).groupBy("at")).applyInArrow(run, "doc_id long, n long, s double")
    out = out.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.sum("s").alias("log_score"))
    return out.select(F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "n_words", "log_score",
                      (F.col("log_score") / F.nullif("n_words", F.lit(0))).alias("mean_log_score"))


#: ``goal`` is null for bigrams, else the row is settled or asks already, and ``goal`` its part.
BY_FOLD = f"{ASKED}, fold int, goal int"


def _rows_by_fold(parts: int, rest: np.ndarray, alpha: float, known: np.ndarray, hot: np.ndarray, count: np.ndarray, settle):
    """In one pass, rare bigrams as both words (coded where they are frequent), packed by hash partition and fold, and what documents ask of the other folds'
    unigram counts for their first word and for their frequent pairs. The latter take the shuffle's way with the bigrams, spread over
    its partitions."""

    def rare_rows(b, w, doc, at, g):
        key = (g % np.uint64(parts)).astype(np.int64) * FOLDS + _folds_of(b, at)
        place, hit = _find(known, w)
        code = np.where(hit, place, FREQUENT).astype(np.uint16)
        rows = _pack_coded(key, doc[at], np.stack([w[at - 1], w[at]], 1), np.stack([code[at - 1], code[at]], 1))
        key, none = rows.column("part").to_numpy(), pa.nulls(rows.num_rows, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(key // FOLDS, pa.int32()), *rows.columns[1:], none, none,
                                           pa.array(key % FOLDS, pa.int32()), pa.nulls(rows.num_rows, pa.int32())], names=names)

    def asks(b, w, first, pair, at):
        size, whole = np.diff(b.column("words").offsets.to_numpy()), b.column("fold").to_numpy()
        fold = _folds_of(b, slice(None))
        n = count[at, fold[pair]]
        coef = first.astype(np.int64)
        coef[pair[n > 0] - 1] -= 1
        coef[pair[n == 0]] += 1
        use = coef != 0
        ends = np.append(0, np.cumsum(use))
        stop = np.cumsum(size)
        log_n = np.where(n > 0, np.log(np.maximum(n, 1)), math.log(alpha) - rest[fold[pair]])
        s = np.where(size > 0, -rest[whole], 0.0) + np.bincount(np.repeat(np.arange(len(size)), size)[pair], log_n, len(size))
        return _result(-1, b.column("doc_id").to_numpy(), ends[stop] - ends[stop - size], w[use], (coef * (1 + fold))[use], s, size)

    names = [c.split()[0] for c in BY_FOLD.split(", ")]

    def run(batches):
        turn = TaskContext.get().partitionId()
        for b in _slices(batches):
            w, doc, first, _, pair, g = _pairs(b)
            at, hit = _find(hot, g)
            yield rare_rows(b, w, doc, pair[~hit], g[~hit])
            for x in settle(asks(b, w, first, pair[hit], at[hit]).to_batches()):
                turn += 1
                same = pa.array(np.full(x.num_rows, turn % parts), pa.int32())
                yield pa.RecordBatch.from_arrays([same, *x.columns[1:], pa.nulls(x.num_rows, pa.int32()), x.column("part")], names=names)

    return run


def _seen_in_folds(rest: np.ndarray, alpha: float, known: np.ndarray, settle):
    """Bigrams of one hash partition, each scored by its count in the other folds; the partition's other rows pass."""

    def run(t: pa.Table) -> pa.Table:
        ready = pc.is_valid(t.column("goal"))
        done = t.filter(ready)
        done = done.set_column(0, "part", done.column("goal")).drop_columns(["fold", "goal"])
        t = t.filter(pc.invert(ready))
        code, runs = _joined(t, "a", np.uint16), _joined(t, "runs", np.int32)
        fold = np.repeat(column(t, "fold").to_numpy(), pc.binary_length(column(t, "a")).to_numpy() // 4).astype(np.int8)
        both = np.append(known, np.uint64(0))[np.minimum(code, len(known))]
        both[code == FREQUENT] = _joined(t, "b", np.uint64)
        docs = _joined(t, "docs", np.int64)
        del code, t
        v, w = both[::2], both[1::2]
        n = _other_folds(v, w, fold)
        out, ends = [done], np.append(0, np.cumsum(runs))
        for i, j in _row_slices(ends, WORDS_AT_ONCE):
            x = slice(ends[i], ends[j])
            seen = n[x] > 0
            s = np.where(seen, np.log(np.maximum(n[x], 1)), math.log(alpha) - rest[fold[x]])
            coef = np.where(seen, -1, 1).astype(np.int8) * (1 + fold[x])
            asked = _result(-1, docs[i:j], runs[i:j], np.where(seen, v[x], w[x]), coef, _sums(runs[i:j], s))
            out += [pa.Table.from_batches([y]) for y in settle(asked.to_batches())]
        return pa.concat_tables(out)

    return run


def _other_folds(v: np.ndarray, w: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """How often each bigram occurs in the folds that are not its own; arrays are freed as early as can be."""
    g = np.empty(len(v), np.uint64)
    for i in range(0, len(g), WORDS_AT_ONCE):
        x = slice(i, i + WORDS_AT_ONCE)
        g[x] = _bigrams(v[x], w[x])
    order = np.argsort(g)
    g = g[order]
    new = np.append(True, g[1:] != g[:-1])[:len(g)]
    total = np.diff(np.append(np.flatnonzero(new), len(g))).astype(np.int32)
    del g
    many = np.repeat(total > 1, total)  # a bigram that occurs once is in no other fold
    group, order = (np.cumsum(new, dtype=np.int32) - 1)[many], order[many]
    key = group.astype(np.int64) * FOLDS + fold[order]
    inner = np.argsort(key)
    key, group, order = key[inner], group[inner], order[inner]
    own = np.append(True, key[1:] != key[:-1])[:len(key)]
    mine = np.diff(np.append(np.flatnonzero(own), len(key))).astype(np.int32)
    n = np.zeros(len(v), np.int32)
    n[order] = total[group] - np.repeat(mine, mine)
    return n


RARE = "part int, docs binary, runs binary, a binary, b binary, fold int"


def _rare_words(parts: int, known: np.ndarray):
    """Counts by fold of the words that are not frequent, packed by hash partition; a task counts ``RARE_HELD`` of them at a time."""

    def counted(held):
        w, fold = (np.concatenate(x) for x in zip(*held))
        for f in range(FOLDS):
            keys, n = np.unique(w[fold == f], return_counts=True)
            rows = _pack((keys % np.uint64(parts)).astype(np.int64), np.zeros(len(keys), np.int64), [keys, n.astype(np.int64)],
                         ["part", "docs", "runs", "a", "b"])
            yield rows.append_column("fold", pa.array(np.full(rows.num_rows, f, np.int32)))

    def run(batches):
        held, size = [], 0
        for b in _slices(batches):
            w = _words(b)[0]
            rare = ~_find(known, w)[1]
            held.append((w[rare], _folds_of(b, rare).astype(np.int8)))
            size += len(held[-1][0])
            if size >= RARE_HELD:
                yield from counted(held)
                held, size = [], 0
        if held:
            yield from counted(held)

    return run


def _answer_folds(counted: pa.Table, asked: pa.Table) -> pa.Table:
    """As ``_answer``, by the counts of the other folds."""
    if not asked.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
    key, n = _joined(counted, "a", np.uint64), _joined(counted, "b", np.int64)
    fold = np.repeat(column(counted, "fold").to_numpy(zero_copy_only=False),
                     pc.binary_length(column(counted, "a")).to_numpy(zero_copy_only=False) // 8).astype(np.int64)
    order = np.lexsort((fold, key))
    key, fold, n = key[order], fold[order], n[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    total = np.add.reduceat(n, start) if len(n) else n
    place = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key)))) * FOLDS + fold
    # tasks count apart: a word's fold may come in several rows
    first = np.flatnonzero(np.append(True, np.diff(place) != 0)[:len(place)])
    place, n = place[first], np.add.reduceat(n, first) if len(n) else n
    w, coef, runs = _joined(asked, "a", np.uint64), _joined(asked, "b", np.int8).astype(np.int64), _joined(asked, "runs", np.int32)
    c = np.zeros(len(w), np.int64)
    at, hit = _find(key[start], w)
    c[hit] = total[at[hit]]
    at, hit = _find(place, np.where(hit, at * FOLDS + np.abs(coef) - 1, -1))
    c[hit] -= n[at[hit]]
    return pa.table({"doc_id": pa.array(_joined(asked, "docs", np.int64)),
                     "s": pa.array(_sums(runs, np.sign(coef) * np.log(np.maximum(c, 1))))})


def score_by_folds(docs: DataFrame, alpha: float = 0.4, part_grams: int = FOLD_PART_GRAMS,
                   frequent: int = FREQUENT) -> DataFrame:
    """As ``score_documents``, but no document is scored by its own words: the corpus is cut into ``FOLDS`` folds by the id, and
    a document's corpus is all folds but its own (repeated ids are in one fold). Pairs that the other folds
    do not have back off to their second word.

    Four passes over the texts: likely words and pairs; their exact counts by fold, dense arrays added up by a tree; rare bigrams,
    packed and coded, to their hash partitions; rare words to theirs, where they meet what is still asked.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    digit = F.conv(F.substring(F.md5(ident.cast("string").cast("binary")), 1, 1), 16, 10).cast("int")
    src = docs.select(ident.alias("doc_id"), digit.alias("fold"), word_hashes("text").alias("words"))
    named = scratch.table(src.mapInArrow(_likely, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    known, hot = _most(named, 0, min(frequent, FREQUENT)), _most(named, 1, frequent)
    own, pairs, sizes = _dense_counts(src, known, hot, scratch)
    total = int(sizes.sum())
    rest = np.log(np.maximum(total - sizes[0], 1))
    count = np.maximum(own.sum(axis=1, keepdims=True) - own, 1)
    pairs = pairs.sum(axis=1, keepdims=True) - pairs
    parts = max(12, -(-total // part_grams))
    rare_parts = max(12, -(-(total - int(own.sum())) // part_grams))
    settle = _frequent_first(rare_parts, known, count)
    rows = src.mapInArrow(_rows_by_fold(parts, rest, alpha, known, hot, pairs, settle), BY_FOLD)
    asked = rows.groupBy("part").applyInArrow(_seen_in_folds(rest, alpha, known, settle), ASKED)
    return _totals(asked, src.mapInArrow(_rare_words(rare_parts, known), RARE), rare_parts, _answer_folds)
