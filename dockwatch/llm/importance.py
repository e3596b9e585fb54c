"""Operator 13: resampling a corpus towards a target distribution, by hashed word n-gram features."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, byte_slices, numbers

BUCKETS = 10_000
#: Words in a feature, at most.
ORDER = 3
#: Bytes of text scanned at a time; a longer document is scanned in several windows.
WINDOW_BYTES = 8 << 20
#: Words a worker's dictionary holds at most; each has at most ``LONG`` bytes. Other words get their payload directly.
DICTIONARY_WORDS = 50_000
LONG = 64
#: The dictionary is learnt anew from a window of which it knows less than this share of words.
KNOWN_SHARE = 0.8

_SPACE = 32
#: Word bytes: 0-9, a-z and all of 128 or more; A-Z are lower-cased, all others become the delimiter.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _SPACE
                for c in range(256))


def _byte_step() -> np.ndarray:
    """What a zero byte makes of each value of the lowest byte of a CRC-32."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


class CrcShift:
    """``shift(c, n)``: what n further zero bytes make of CRC-32 ``c`` (a linear map). With it the CRC of two joined texts
    follows from theirs: ``crc(x + y) = shift(crc(x), len(y)) ^ crc(y)``.

    Maps for n up to ``LONG + 1`` are tables by byte of ``c``; longer ones are put together from the maps of the powers of two.
    """

    def __init__(self):
        step = _byte_step()
        rows = [np.array([np.arange(256) << (8 * k) for k in range(4)], np.uint32)]
        for _ in range(LONG + 1):
            rows.append((rows[-1] >> 8) ^ step[rows[-1] & 255])
        self.tables = np.stack(rows)
        self.powers = [self.tables[1]]

    @staticmethod
    def _apply(table: np.ndarray, at: np.ndarray | int, c: np.ndarray) -> np.ndarray:
        flat = table.reshape(-1)
        return (flat[at + (c & 255)] ^ flat[at + (256 + ((c >> 8) & 255))]
                ^ flat[at + (512 + ((c >> 16) & 255))] ^ flat[at + (768 + (c >> 24))])

    def __call__(self, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = self._apply(self.tables, np.minimum(n, LONG + 1) * 1024, c)
        far = np.flatnonzero(n > LONG + 1)
        if len(far):
            x, left, k = c[far], n[far].copy(), 0
            while left.any():
                if k == len(self.powers):
                    self.powers.append(self._apply(self.powers[-1], 0, self.powers[-1]))
                x = np.where(left & 1, self._apply(self.powers[k], 0, x), x)
                left, k = left >> 1, k + 1
            out[far] = x
        return out


class WordAutomaton:
    """Aho-Corasick automaton over distinct words between two delimiters. A match's value is the word's payload: its length
    in the high and its CRC-32 in the low 32 bits."""

    def __init__(self, words: list[bytes]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)  # STORE_INTS keeps 32 bits
        for w in words:
            self.automaton.add_word(f" {w.decode('latin-1')} ", len(w) << 32 | zlib.crc32(w))
        self.size = len(words)
        if words:
            self.automaton.make_automaton()

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Places of the delimiters that end a known word, and the words' payloads."""
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(text)), np.int64)
        return found[::2], found[1::2]


class WordScanner:
    """Payloads of all words of a normalised window, in order. What the dictionary holds never changes them."""

    def __init__(self):
        self.known = WordAutomaton([])

    def __call__(self, window: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word's first byte, and its payload. ``window`` begins and ends with a delimiter."""
        place = np.flatnonzero(np.frombuffer(window, np.uint8) == _SPACE)
        first, stop = place[:-1] + 1, place[1:]
        word = stop > first
        first, stop = first[word], stop[word]
        text = window.decode("latin-1")
        found, new = self._scan(text, stop)
        if len(new) > (1 - KNOWN_SHARE) * len(stop) and len(stop) > DICTIONARY_WORDS // 10:
            seen = Counter(window.split())
            self.known = WordAutomaton([w for w, n in seen.most_common(DICTIONARY_WORDS) if n > 1 and len(w) <= LONG])
            found, new = self._scan(text, stop)
        found[new] = [(j - i) << 32 | zlib.crc32(window[i:j]) for i, j in zip(first[new].tolist(), stop[new].tolist())]
        return first, found

    def _scan(self, text: str, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = np.full(len(stop), -1, np.int64)
        at, payload = self.known.matches(text)
        out[np.searchsorted(stop, at)] = payload
        return out, np.flatnonzero(out < 0)


_SCANNER: list[WordScanner] = []
_SHIFT: list[CrcShift] = []


def _tools() -> tuple[WordScanner, CrcShift]:
    """This worker's scanner and shift maps."""
    if not _SCANNER:
        _SCANNER.append(WordScanner())
        _SHIFT.append(CrcShift())
    return _SCANNER[0], _SHIFT[0]


def _windows(raw: bytes):
    """(start, stop) of parts of about ``WINDOW_BYTES`` that begin where the last one ended; all end behind a delimiter,
    as ``raw`` does. A word of more bytes makes its part longer."""
    at = 0
    while at < len(raw):
        to = min(at + WINDOW_BYTES, len(raw))
        end = raw.rfind(b" ", at, to) + 1 or raw.find(b" ", to) + 1 or len(raw)
        yield at, end
        at = end


def features(texts: pa.Array, buckets: int):
    """For each window of ``texts`` (each of which ends with a space): the number of words of each document, and the document
    and bucket of every feature that ends in the window. Words of one document only are joined."""
    scan, shift = _tools()
    arr = texts.cast(pa.large_binary())
    ends = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = bytes(arr.buffers()[2][ends[0]:ends[-1]]).translate(_NORMAL) if len(arr) and ends[-1] > ends[0] else b""
    ends = ends - ends[0]
    before = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a, b in _windows(raw):
        place, payload = scan(b" " + raw[a:b])
        doc = np.searchsorted(ends, place - 1 + a, "right") - 1
        held = len(before[0])
        words = np.bincount(doc, minlength=len(arr))
        doc, payload = np.concatenate([before[0], doc]), np.concatenate([before[1], payload])
        before = doc[-(ORDER - 1):], payload[-(ORDER - 1):]
        size, crc = payload >> 32, (payload & 0xFFFFFFFF).astype(np.uint32)
        # " word": what is joined to the words before it
        joined = shift(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc
        owners, found, run = [doc[held:]], [crc[held:]], crc
        for k in range(1, ORDER):
            run = shift(run[:-1], size[k:] + 1) ^ joined[k:]  # the run that ends at each word from the k-th on
            whole = (doc[k:] == doc[:-k]) & (np.arange(k, len(doc)) >= held)
            owners.append(doc[k:][whole])
            found.append(run[whole])
        yield words, np.concatenate(owners), np.concatenate(found) % np.uint32(buckets)


def _texts(docs: DataFrame) -> Column:
    return F.concat(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(" ")).alias("text")


def feature_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of all rows; buckets without a feature are left out."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for b in byte_slices(whole, "text", WINDOW_BYTES):
                for _, _, bucket in features(b.column("text"), buckets):
                    total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return docs.select(_texts(docs)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Log ratio of each bucket's share in the target and in the corpus, both with one more feature in every bucket, in thousandths.
    Both tables have at most ``buckets`` rows."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, into in ((raw, s), (target, t)):
        got = counts.toArrow()
        into[numbers(got, "bucket")] = numbers(got, "n")
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((int(y) + 1) * (all_s + buckets) / ((int(x) + 1) * (all_t + buckets))))
                     for x, y in zip(s, t)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row; weight is the sum of the gains of its features."""

    def run(batches):
        for whole in batches:
            for b in byte_slices(whole, "text", WINDOW_BYTES):
                n = b.num_rows
                words, many, weight = (np.zeros(n, np.int64) for _ in range(3))
                for w, doc, bucket in features(b.column("text"), len(gains)):
                    words += w
                    many += np.bincount(doc, minlength=n)
                    weight += np.bincount(doc, gains[bucket], n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *map(pa.array, (words, many, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _texts(docs))
    return src.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of ``seed:doc_id`` (a null id: of ``seed:``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def ranked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows (doc_id, score, ..)`` with ``place``: 1, 2, .. by falling score, equal ones by doc_id (null last).

    Rows are range-partitioned, sorted and written with their place in their partition; the partitions' sizes, one number each,
    give the rest. Equal rows are told apart by their place in the input, so that many of them still spread.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_at")]
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = scratch.table(dealt.drop("_at").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(map(tuple, dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()))
    first = [(p, before) for (p, _), before in zip(sizes, itertools.accumulate([0, *(n for _, n in sizes)]))]
    firsts = rows.sparkSession.createDataFrame(first, "_part long, _first long")
    met = dealt.withColumn("_part", part).join(F.broadcast(firsts), "_part")
    return met.withColumn("place", F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
                          ).drop("_at", "_part", "_first")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, buckets: int = BUCKETS,
             seed: int = 42) -> DataFrame:
    """Draw ``percent`` of the documents with at least ``min_words`` words, without replacement, likelier the more their word
    n-grams look like ``target``'s: the highest sums of a document's weight and Gumbel noise.

    Returns for every row of ``docs``: doc_id, n_words, n_features, weight, score and rank (null: not drawn). Null and empty texts
    have no words, weight 0. Whole texts are scanned, however long. Rows that repeat a doc_id count and are drawn
    one by one; equal scores go to the smaller doc_id, null last. Other columns of both tables are ignored. Without documents there
    are no rows; without a target all buckets' target counts are 0.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    gains = bucket_gains(feature_counts(docs, buckets), feature_counts(target, buckets), buckets)
    scored = scratch.table(weigh(docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    first = ranked(able, scratch).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest)
