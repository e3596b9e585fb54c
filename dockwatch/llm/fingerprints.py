"""Operator 11: document fingerprints that two versions subtract from each other (invertible Bloom lookup sketches)."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.jaccard import _mix
from dockwatch.llm.shared import Scratch, byte_slices

#: A paragraph ends with its line or sentence, or after so many code points: a long line without marks is several paragraphs.
#: In the first ``HEAD`` code points they are shorter, for short texts to have several.
LONGEST, HEAD_LONGEST, HEAD = 24, 8, 64
_PARAGRAPH, _HEAD = (re.compile(r"[^\n.!?]{1,%d}[\n.!?]*|[\n.!?]+" % n) for n in (LONGEST, HEAD_LONGEST))

#: A sketch has this many parts; a paragraph is in one cell of each. ``CELLS`` is the size of a part in a fingerprint,
#: a retry has ``GROWTH`` times the cells of the try before.
PARTS = 3
CELLS = 4
GROWTH = 4
#: With so many cells for each key, and after so many retries, what is left in the cells is counted as it is: it can't be single
#: keys that meet by chance, only paragraphs of one document with the same 64-bit key.
ENOUGH_CELLS = 16
RETRIES = 4
#: Cells worked on at a time, and bytes of text.
CELLS_AT_ONCE = 1 << 19
SLICE_BYTES = 4 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_CELL = np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u4")])


def paragraphs(text: str) -> list[str]:
    """A text's paragraphs, in order; joined, they are the text."""
    return _HEAD.findall(text, 0, HEAD) + _PARAGRAPH.findall(text, HEAD)


def paragraph_keys(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the paragraphs of all texts and how many each text has. A key is a paragraph's digest and how often the text
    had it before, so that the keys of a text differ."""
    from xxhash import xxh3_64_intdigest

    found = [paragraphs(t) for t in texts]
    n = np.fromiter(map(len, found), np.int64, len(found))
    digest = np.fromiter(map(xxh3_64_intdigest, itertools.chain.from_iterable(found)), np.uint64, int(n.sum()))
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((digest, owner))
    new = np.append(True, (np.diff(digest[order]) != 0) | (np.diff(owner[order]) != 0))[:len(order)]
    first = np.flatnonzero(new)
    before = np.empty(len(order), np.uint64)
    before[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return _mix(digest + before * _STEP), n


class Sketches:
    """Sketches of several key sets: in each cell the number, the sum and the sum of checks of its keys (modulo 2^64)."""

    def __init__(self, n: np.ndarray, key: np.ndarray, check: np.ndarray, attempt: int):
        self.n, self.key, self.check, self.attempt = n, key, check, attempt

    @classmethod
    def of(cls, keys: np.ndarray, owner: np.ndarray, sets: int, attempt: int = 0) -> Sketches:
        """Sketches of ``sets`` key sets; ``owner`` is the set of each key."""
        size = PARTS * CELLS * GROWTH**attempt
        at = (owner * size + cls._places(keys, attempt)).ravel()
        sums = [np.zeros(sets * size, np.uint64) for _ in range(2)]
        for s, x in zip(sums, (keys, cls._checks(keys))):
            np.add.at(s, at, np.tile(x, PARTS))
        return cls(np.bincount(at, minlength=sets * size).reshape(sets, size), *(s.reshape(sets, size) for s in sums), attempt)

    @staticmethod
    def _places(keys: np.ndarray, attempt: int) -> np.ndarray:
        cells = CELLS * GROWTH**attempt
        salt = (np.arange(PARTS) + (PARTS * attempt + 1)).astype(np.uint64) * _STEP
        return (_mix(keys[None, :] ^ salt[:, None]) % np.uint64(cells)).astype(np.int64) + cells * np.arange(PARTS)[:, None]

    @staticmethod
    def _checks(keys: np.ndarray) -> np.ndarray:
        return _mix(~keys)

    def take(self, rows: np.ndarray) -> Sketches:
        return Sketches(self.n[rows], self.key[rows], self.check[rows], self.attempt)

    def minus(self, other: Sketches) -> Sketches:
        """Cells without what both hold."""
        return Sketches(self.n - other.n, self.key - other.key, self.check - other.check, self.attempt)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take single keys out of the cells until none is left: (row, key, +1 or -1) of all that came out, and for each row how many
        keys are left in its cells, each counted once (0: all came out). The cells are used up."""
        size = self.n.shape[1]
        n, key, check = self.n.reshape(-1), self.key.reshape(-1), self.check.reshape(-1)
        out, look = [], np.flatnonzero(np.abs(n) == 1)
        while len(look):
            sign = n[look]
            k = np.where(sign > 0, key[look], -key[look])
            single = np.where(sign > 0, check[look], -check[look]) == self._checks(k)
            row, k, sign = look[single] // size, k[single], sign[single]
            order = np.lexsort((k, row))  # a key may be alone in more than one of its cells
            row, k, sign = row[order], k[order], sign[order]
            new = np.append(True, (np.diff(k) != 0) | (np.diff(row) != 0))[:len(k)]
            row, k, sign = row[new], k[new], sign[new]
            if not len(k):
                break
            out.append((row, k, sign))
            at = (row * size + self._places(k, self.attempt)).ravel()
            np.subtract.at(n, at, np.tile(sign, PARTS))
            for cells, x in ((key, k), (check, self._checks(k))):
                np.subtract.at(cells, at, np.tile(np.where(sign > 0, x, -x), PARTS))
            look = at[np.abs(n[at]) == 1]
        found = [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(list(zip(*out)) or [()] * 3, (np.int64, np.uint64, np.int64))]
        left = ((n != 0) | (key != 0)).reshape(-1, size)
        kept = -(-np.maximum(np.abs(n).reshape(-1, size), left).sum(1) // PARTS)
        return *found, kept

    def texts(self) -> list[str]:
        """The sketches as text: cells in order, Base64."""
        cells = np.zeros(self.n.shape, _CELL)
        cells["n"], cells["key"], cells["check"] = self.n, self.key, self.check & np.uint64(0xFFFFFFFF)
        return [base64.b64encode(r.tobytes()).decode() for r in cells]


def _pick(keys: np.ndarray, n: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of some sets, and the place of each one's set in ``sets``."""
    first, count = (np.cumsum(n) - n)[sets], n[sets]
    ends = np.cumsum(count)
    at = np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
    return keys[at], np.repeat(np.arange(len(sets)), count)


def differences(keys: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray):
    """What key sets ``left[i]`` and ``right[i]`` don't share, by subtracting and peeling their sketches; pairs that can't be
    peeled are tried again with larger ones (at most ``GROWTH * ENOUGH_CELLS`` cells for each key).

    Returns how many keys differ for each pair, and (pair, key, +1 or -1) of the differing ones.
    """
    differ, found, todo = np.zeros(len(left), np.int64), [], np.arange(len(left))
    for attempt in itertools.count():
        size, failed = PARTS * CELLS * GROWTH**attempt, []
        step = max(1, CELLS_AT_ONCE // size)
        for some in (todo[i:i + step] for i in range(0, len(todo), step)):
            sets, at = np.unique(np.concatenate([left[some], right[some]]), return_inverse=True)
            both = Sketches.of(*_pick(keys, n, sets), len(sets), attempt)
            row, k, sign, kept = both.take(at[:len(some)]).minus(both.take(at[len(some):])).peel()
            enough = (size >= ENOUGH_CELLS * (n[left[some]] + n[right[some]])) & (attempt >= RETRIES)
            done = (kept == 0) | enough
            differ[some] = np.bincount(row, minlength=len(some)) + kept
            found.append((some[row[done[row]]], k[done[row]], sign[done[row]]))
            failed.append(some[~done])
        todo = np.concatenate(failed) if failed else todo[:0]
        if not len(todo):
            break
    return differ, *(np.concatenate(x) for x in zip(*found, (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))))


def likeness(differ: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of both versions' paragraphs that the other one has too; 1 for two empty texts."""
    both = left + right
    return np.where(both == 0, 1.0, 1.0 - differ / np.maximum(both, 1))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) of code points replaced by as many, or all, of the following text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _results(ids: list, texts: list[str]) -> list[list]:
    """Columns of ``RESULT`` for all texts but the last; each one's next text stands behind it."""
    new = [edited(t, u) for t, u in itertools.pairwise(texts)]
    keys, n = paragraph_keys([*texts, *new])
    rows, many = np.arange(len(new)), len(texts)
    prints = Sketches.of(keys, np.repeat(np.arange(len(n)), n), len(n)).texts()
    left, right = np.tile(rows, 2), np.concatenate([many + rows, rows + 1])
    near = likeness(differences(keys, n, left, right)[0], n[left], n[right])
    return [ids, [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in new], prints[:len(new)],
            prints[many:], near[:len(new)], near[len(new):]]


STREAM = RESULT + ", part long, kind string, text string"


def _stream_batch(ids: list, texts: list[str], kind: str, part: int, pairs: bool) -> pa.RecordBatch:
    """``pairs``: results of all texts but the last; else the texts themselves."""
    n = len(ids)
    cols = [*(_results(ids, texts) if pairs else [ids, *[[None] * n] * 6]), [part] * n, [kind] * n, [None] * n if pairs else texts]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int64(), *[pa.string()] * 2]
    names = [c.strip().split(" ")[0] for c in STREAM.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _stream(batches):
    """Results of a sorted partition's rows but the last one, whose next text is in another partition; that row as ``open`` and the
    first one as ``head``."""
    part, last = TaskContext.get().partitionId(), None
    for whole in batches:
        for b in byte_slices(whole, "text", SLICE_BYTES):
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            if last is None:
                yield _stream_batch(ids[:1], texts[:1], "head", part, False)
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            if len(ids) > 1:
                yield _stream_batch(ids[:-1], texts, "row", part, True)
            last = ids[-1], texts[-1]
    if last is not None:
        yield _stream_batch([last[0]], [last[1]], "open", part, False)


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and of its edited text (``edited`` with the next row's text), in descending order of
    doc_id, null last; the first row follows the last one.

    Returns doc_id, n_chars (code points), edited_sha256, fingerprint, edited_fingerprint, and near_edited and near_next: the
    likeness of the text to its edited and to the next row's text, as the subtracted sketches give it. Equal texts have equal fingerprints.

    Null texts are empty: no paragraphs, like each other only. Whole texts are sketched, however long. Rows of the same
    doc_id follow one another in their order in the input; a single row is its own next one. Other columns are ignored; an empty table
    gives no rows.

    The texts are moved once, range-partitioned by doc_id, and each partition is read in order. Only the last row of each
    partition meets the first one of the next partition afterwards.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.asc("_at")]
    dealt = src.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    done = scratch.table(dealt.select("doc_id", "text").mapInArrow(_stream, STREAM))
    heads, last = (done.where(F.col("kind") == k).select("part", "doc_id", "text") for k in ("head", "open"))
    # one number for each partition
    parts = sorted(r.part for r in heads.select("part").collect())
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next long")
    met = last.join(F.broadcast(after), "part").join(heads.select(F.col("part").alias("next"), F.col("text").alias("following")), "next")

    def meet(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                b = whole.slice(i, 1)
                cols = _results(b.column("doc_id").to_pylist(), [b.column("text")[0].as_py(), b.column("following")[0].as_py()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2))],
                    names=[c.strip().split(" ")[0] for c in RESULT.split(",")])

    rows = done.where("kind = 'row'").drop("part", "kind", "text")
    return rows.unionByName(met.select("doc_id", "text", "following").mapInArrow(meet, RESULT))


COMPARED = "doc_id long, removed array<long>, added array<long>, likeness double"


def compare_versions(versions: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """What changed between the texts ``old`` and ``new`` of each row: digests of the paragraphs only the old (``removed``) and only the
    new one has (``added``), in ascending order, and their likeness. Null texts are empty."""

    def run(batches):
        for whole in batches:
            for b in byte_slices(whole, "both", SLICE_BYTES):
                rows = b.num_rows
                keys, n = paragraph_keys([*b.column("old").to_pylist(), *b.column("new").to_pylist()])
                left = np.arange(rows)
                differ, pair, key, sign = differences(keys, n, left, left + rows)
                out = [[[] for _ in left] for _ in range(2)]
                for p, k, s in sorted(zip(pair.tolist(), key.view(np.int64).tolist(), sign.tolist())):
                    out[s < 0][p].append(k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(x, pa.list_(pa.int64())) for x in out), pa.array(likeness(differ, n[:rows], n[rows:]))],
                    names=["doc_id", "removed", "added", "likeness"])

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (old, new)]
    src = versions.select(F.col("doc_id").cast("long").alias("doc_id"), *(x.alias(c) for x, c in zip(text, ("old", "new"))),
                          F.concat(*text).alias("both"))
    return src.mapInArrow(run, COMPARED)
