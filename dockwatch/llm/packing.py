"""Operator 9: best-fit packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, byte_slices, column, numbers

#: Bytes of text tokenised at a time, and distinct words a worker remembers.
SLICE_BYTES = 8 << 20
MEMO_WORDS = 800_000
#: Words of Latin letters, perhaps with one mark behind them, and how many words are encoded as one string. Such a word is one
#: token run of the tokenizer, its mark another one, whatever stands around them.
PLAIN_WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,;:!?]?$"
PLAIN_MARK = "[.,;:!?]$"
JOINED_WORDS = 500

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the machine that asks; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts by a tokenizer that drops white space and whose tokens
    never reach over it: a text's ids are its words' ids in a row. Each distinct
    word is encoded by the tokenizer once and remembered (the memory is emptied
    when it holds ``MEMO_WORDS``)."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        # the entries that end a run say so in their name
        self.ends_run = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_run[[i for entry, i in vocab.items() if entry.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids, self.first = array("I"), array("q", [0])

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each."""
        return _flat([e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)])

    def _plain(self, words: list[str], runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain words of so many runs each, encoded together and cut at the ends of runs."""
        joined = [" ".join(words[i:i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        ids, _ = self._each(joined)
        end = np.flatnonzero(self.ends_run[ids])
        if len(end) != runs.sum():  # not a tokenizer of such runs
            return self._each(words)
        return ids, np.diff(end[np.cumsum(runs) - 1], prepend=-1)

    def _learn(self, words: list[str]) -> None:
        arr = pa.array(words, pa.large_string())
        plain = pc.match_substring_regex(arr, PLAIN_WORD).to_numpy(zero_copy_only=False)
        runs = 1 + pc.match_substring_regex(arr, PLAIN_MARK).to_numpy(zero_copy_only=False)
        sure, other = arr.filter(pa.array(plain)).to_pylist(), arr.filter(pa.array(~plain)).to_pylist()
        for some, (ids, n) in ((sure, self._plain(sure, runs[plain])), (other, self._each(other))):
            self.memo.update(zip(some, range(len(self.memo), len(self.memo) + len(some))))
            self.first.frombytes((len(self.ids) + np.cumsum(n)).astype(np.int64).tobytes())
            self.ids.frombytes(ids.astype(np.uint32).tobytes())

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        lists = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        off = lists.offsets.to_numpy()
        words = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
        index = words.indices.to_numpy()
        distinct = words.dictionary.to_pylist()
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        new = [w for w in distinct if w not in self.memo]
        if new:
            self._learn(new)
        known, first = np.array(self.ids, np.uint32), np.array(self.first, np.int64)
        place = np.fromiter(map(self.memo.__getitem__, distinct), np.int64, len(distinct))[index]
        n = first[place + 1] - first[place]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(first[place] - ends[:-1], n) + np.arange(ends[-1])
        return known[at], np.diff(ends[off - off[0]])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(n.sum())), n


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def cut_pieces(length: int, limit: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length) of a document of ``length`` ids."""
    for k, s in enumerate(range(0, length, limit)):
        yield k, s, min(limit, length - s)


def token_pieces(docs: DataFrame, path: str | Callable[[], str], limit: int, end_id: int) -> DataFrame:
    """One row per piece: whole texts are tokenised, ``end_id`` is added, longer ones are cut."""

    def run(batches):
        tok = _tokenizer(path() if callable(path) else path)
        for whole in batches:
            for b in byte_slices(whole, "text", SLICE_BYTES):
                ids, n = tok(b.column("text"))
                owner = np.repeat(np.arange(len(n)), n)
                out = np.full(len(ids) + len(n), end_id, "<u4")
                out[np.arange(len(ids)) + owner] = ids
                stop = np.cumsum(n + 1)
                rows = []
                for d, (doc, end, size) in enumerate(zip(b.column("doc_id").to_pylist(), stop, n + 1)):
                    base = int(end - size)
                    for k, s, m in cut_pieces(int(size), limit):
                        rows.append((doc, k, s, m, zlib.crc32(out[base + s:base + s + m])))
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), *[pa.int64()] * 3))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(run, PIECES)


class OpenBins:
    """Segment tree over remaining capacities 0..limit: each leaf holds the open
    bins with just that much room, each inner node their number."""

    def __init__(self, limit: int):
        self.width = 1 << limit.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: dict[int, list[int]] = {}

    def add(self, room: int, bin_: int) -> None:
        self.bins.setdefault(room, []).append(bin_)
        i = room + self.width
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, room: int) -> int:
        i = room + self.width
        while i:
            self.count[i] -= 1
            i >>= 1
        return self.bins[room].pop()

    def tightest(self, need: int) -> int | None:
        """The smallest room of an open bin that is at least ``need``."""
        i = need + self.width
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.width
            i >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest first, each into the tightest open bin."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    tree, n = OpenBins(limit), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = tree.tightest(need)
        if room is None:
            bin_, room, n = n, limit, n + 1
        else:
            bin_ = tree.take(room)
        bins[i], offsets[i] = bin_, limit - room
        if room > need:
            tree.add(room - need, bin_)
    return bins, offsets


def pack(pieces: DataFrame, limit: int, scratch: Scratch, group_rows: int = 2048,
         full_share: float = 0.98, rounds: int = 4) -> DataFrame:
    """Place pieces into sequences of at most ``limit`` ids.

    Pieces of ``limit`` ids are sequences of their own. The rest is dealt evenly into
    groups of about ``group_rows`` rows by row number, so no document, copy or
    length can make a group large, and each group is packed best-fit decreasing. The pieces of
    bins that stay under ``full_share`` are pooled and packed anew, with fewer groups
    each round; after the last round, or once one group holds the pool, all bins are kept.
    """
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.where(F.col("length") >= limit).select(
        *cols, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = [full]
    rest = pieces.where(F.col("length") < limit).select(*cols)
    for r in range(1, rounds + 1):
        n = rest.count()
        if n == 0:
            break
        groups = max(1, -(-n // (group_rows if r == 1 else 2 * group_rows)))
        last = groups == 1 or r == rounds
        dealt = rest.withColumn("g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        placed = scratch.table(dealt.groupBy("g").applyInArrow(
            _pack_group(limit, r, 0.0 if last else full_share), PLACED + ", open boolean"))
        out.append(placed.where("not open").drop("open"))
        if last:
            break
        rest = placed.where("open").select(*cols)
    res = out[0]
    for x in out[1:]:
        res = res.unionByName(x)
    return res


def _pack_group(limit: int, round_: int, full_share: float):
    def run(t: pa.Table) -> pa.Table:
        g = int(column(t, "g")[0].as_py())
        lengths = numbers(t, "length")
        bins, offsets = best_fit_decreasing(lengths, limit)
        fill = np.bincount(bins, lengths)
        # round and group in the high bits: numbers never meet those of another group or round
        seq = (round_ << 59) + (g << 24) + bins
        return t.drop_columns(["g"]).append_column("sequence_id", pa.array(seq, pa.int64())).append_column(
            "offset", pa.array(offsets, pa.int64())).append_column("open", pa.array(fill[bins] < full_share * limit))

    return run


def pack_documents(docs: DataFrame, path: str | Callable[[], str], limit: int = 2048, end_id: int = 0,
                   **options) -> DataFrame:
    """Tokenise and pack whole documents.

    Null and empty texts are the end id alone. Repeated rows are packed once each; a null
    ``doc_id`` stays null. Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    pieces = scratch.table(token_pieces(docs, path, limit, end_id))
    return pack(pieces, limit, scratch, **options)
