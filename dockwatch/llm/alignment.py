"""Operator 12: alignment of two tokenizers' tokens over the bytes of the same texts."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, byte_slices, column, numbers

#: Bytes of text aligned at a time (a longer document is a slice by itself), and of text the first tokenizer gets at a time.
SLICE_BYTES = 8 << 20
JOINED_BYTES = 16 << 10
#: Irregular pairs whose counts every task holds: the most frequent ones, at most this many (16 bytes each).
#: A pair beyond them is on less than one in so many of the counted rows, so joining the others by pair is even.
FREQUENT = 1 << 17

Path = str | Callable[[], str]


def byte_characters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 ones for themselves, the other bytes, in
    order, for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _table(entries: list[bytes]) -> pa.Array:
    return pa.array(entries, pa.binary())


def _joined(entries: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of ``ids`` in a row."""
    got = entries.take(pa.array(ids))
    off = np.frombuffer(got.buffers()[1], np.int32)[got.offset:got.offset + len(got) + 1]
    return bytes(got.buffers()[2][off[0]:off[-1]]) if len(got) else b""


class TokenizerPair:
    """Tokenizer A (byte-level, a ``tokenizers`` file) and B (SentencePiece): bytes of each id, and for each id of A the id of B
    with the same bytes (-1: none; a piece goes before a byte piece)."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        char, vocab = byte_characters(), self.a.get_vocab(with_added_tokens=True)
        a = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            a[i] = bytes(char[c] for c in entry) if all(c in char for c in entry) else entry.encode()
        ids = range(self.b.vocab_size())
        b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
             for i in ids for p in [self.b.id_to_piece(i)]]
        same = {b[i]: i for i in reversed(ids) if self.b.is_byte(i)}
        same |= {b[i]: i for i in reversed(ids)
                 if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))}
        self.identity = np.array([same.get(x, -1) if x else -1 for x in a], np.int64)
        self.size_a, self.size_b = len(a), len(b)
        self.len_a, self.len_b = (np.array([*map(len, x)], np.int64) for x in (a, b))
        self.bytes_a, self.bytes_b = _table(a), _table(b)
        # decimal ids with what follows them: a comma, or the end of a group's ids
        self.said = _table([b"%d%s" % (i, e) for n, end in ((len(a), b"|"), (len(b), b";")) for i in range(n) for e in (b",", end)])

    def code_type(self) -> str:
        """Type of ``a * size_b + b``."""
        return "<u4" if self.size_a * self.size_b <= 1 << 32 else "<u8"


_PAIRS: dict[tuple[str, str], TokenizerPair] = {}


def _pair(a: Path, b: Path) -> TokenizerPair:
    key = tuple(p() if callable(p) else p for p in (a, b))
    if key not in _PAIRS:
        _PAIRS[key] = TokenizerPair(*key)
    return _PAIRS[key]


def safe_cuts(raw: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes may be cut before a space without a change of either tokenizer's ids: between two characters that are surely
    no white space (no token of A reaches over a space from in front of it, and B has no piece with a space behind other characters)."""
    plain = (raw >= 33) & (raw <= 126)
    two, three, four = ((raw >= x) & (raw <= y) for x, y in ((0xC3, 0xDF), (0xE4, 0xED), (0xF0, 0xF4)))
    begins, ends = plain | two | three | four, plain.copy()
    ends[1:] |= two[:-1]
    ends[2:] |= three[:-2]
    ends[3:] |= four[:-3]
    cut = np.zeros(len(raw), bool)
    cut[1:-1] = (raw[1:-1] == 32) & ends[:-2] & begins[2:]
    return cut


def _binary(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], .., first[0] + count[0] - 1, first[1], .."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _encode_a(pair: TokenizerPair, raw: bytes, ends: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A's ids of all parts of ``raw`` (which end at ``ends``), and how many each part has. Neighbours are encoded together where
    the place between them may be cut."""
    apart = ~cut[np.minimum(ends, len(raw) - 1)] | (ends == len(raw))
    apart |= np.diff(ends // JOINED_BYTES, append=-1) != 0
    stops = ends[apart].tolist()
    texts = [raw[i:j].decode() for i, j in zip([0, *stops], stops)]
    got = [e.ids for e in pair.a.encode_batch_fast(texts, add_special_tokens=False)]
    ids = np.fromiter(itertools.chain.from_iterable(got), np.int64, sum(map(len, got)))
    stop = np.cumsum(pair.len_a[ids])
    return ids, np.diff(np.searchsorted(stop, ends, "right"), prepend=0)


def _encode_b(pair: TokenizerPair, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """B's ids of all parts, and how many each has. A part's first space is the one that B adds."""
    got = pair.b.encode([x[1:].decode() for x in parts.to_pylist()], num_threads=1)
    return (np.fromiter(itertools.chain.from_iterable(got), np.int64, sum(map(len, got))),
            np.fromiter(map(len, got), np.int64, len(got)))


def _differing(pair: TokenizerPair, raw: bytes, ends: np.ndarray, entries: pa.Array, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Parts whose tokens' bytes aren't the part's."""
    if _joined(entries, ids) == raw:
        return np.zeros(len(ends), bool)
    to, text_to = np.cumsum(n).tolist(), ends.tolist()
    return np.array([_joined(entries, ids[i:j]) != raw[s:e]
                     for i, j, s, e in zip([0, *to], to, [0, *text_to], text_to)], bool)


@dataclass
class Parts:
    """What the distinct parts of a slice hold: numbers of tokens and groups, groups as text, and links (first of each part, number,
    and the codes ``a * size_b + b`` of all)."""

    differs: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: pa.Array
    first_link: np.ndarray
    n_links: np.ndarray
    links: np.ndarray


def align_parts(pair: TokenizerPair, parts: pa.Array) -> Parts:
    """Align the distinct parts, put in a row. Parts whose bytes differ from A's or B's tokens' get nothing and are marked."""
    off = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset:parts.offset + len(parts) + 1]
    raw = bytes(parts.buffers()[2][off[0]:off[-1]])
    ends = off[1:] - off[0]
    a, n_a = _encode_a(pair, raw, ends, safe_cuts(np.frombuffer(raw, np.uint8)))
    b, n_b = _encode_b(pair, parts)
    differs = _differing(pair, raw, ends, pair.bytes_a, a, n_a) | _differing(pair, raw, ends, pair.bytes_b, b, n_b)
    if differs.any():
        a, b = a[np.repeat(~differs, n_a)], b[np.repeat(~differs, n_b)]
        n_a, n_b = np.where(differs, 0, n_a), np.where(differs, 0, n_b)
    end_a, end_b = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[b])
    part_a = np.repeat(np.arange(len(parts)), n_a)
    if not len(a):
        none = np.zeros(len(parts), np.int64)
        return Parts(differs, none, none, none, _binary(b"", np.zeros(len(parts) + 1, np.int64)), none, none, none[:0])
    # groups end where tokens of both end
    last_a, last_b = end_b[np.searchsorted(end_b, end_a)] == end_a, end_a[np.searchsorted(end_a, end_b)] == end_b
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    said = pair.said.take(pa.array(np.concatenate([2 * a + last_a, 2 * (pair.size_a + b) + last_b])[order]))
    at = np.frombuffer(said.buffers()[1], np.int32)[said.offset:said.offset + len(said) + 1].astype(np.int64)
    groups = _binary(said.buffers()[2].to_pybytes(), at[np.cumsum(np.append(0, n_a + n_b))])
    # a token of A is linked to B's tokens from the first that ends behind its start to the first that ends at or behind its end
    low = np.searchsorted(end_b, end_a - pair.len_a[a], "right")
    n = np.searchsorted(end_b, end_a, "left") - low + 1
    links = np.repeat(a, n) * pair.size_b + b[_spread(low, n)]
    n_links = np.bincount(part_a, n, len(parts)).astype(np.int64)
    n_groups = np.bincount(part_a[last_a], minlength=len(parts))
    return Parts(differs, n_a, n_b, n_groups, groups, np.cumsum(n_links) - n_links, n_links, links)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, times binary"


def _align_slice(pair: TokenizerPair, b: pa.RecordBatch) -> pa.RecordBatch:
    texts = b.column("text").cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = bytes(texts.buffers()[2][bounds[0]:bounds[-1]]) if bounds[-1] > bounds[0] else b""
    bounds = bounds - bounds[0]
    rows = len(texts)
    cut = safe_cuts(np.frombuffer(raw, np.uint8))
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    starts = np.flatnonzero(cut)
    seen = _binary(raw, np.append(starts, len(raw))).dictionary_encode()
    index = seen.indices.to_numpy()
    parts = align_parts(pair, seen.dictionary)
    doc = np.searchsorted(bounds, starts, "right") - 1
    good = np.bincount(doc, parts.differs[index], rows) == 0
    index, doc = index[good[doc]], doc[good[doc]]
    count = lambda each: np.bincount(doc, each[index], rows).astype(np.int64)
    said = parts.groups.take(pa.array(index))
    said_to = np.frombuffer(said.buffers()[1], np.int64)[said.offset:said.offset + len(said) + 1]
    # a document's last byte is the end of its last group
    groups = pc.ascii_rtrim(_binary(said.buffers()[2].to_pybytes() if len(said) else b"",
                                    said_to[np.append(0, np.cumsum(np.bincount(doc, minlength=rows)))]).cast(pa.large_string()), ";")
    every = pair.size_a * pair.size_b
    key = np.repeat(doc, parts.n_links[index]) * every + parts.links[_spread(parts.first_link[index], parts.n_links[index])]
    key, times = np.unique(key, return_counts=True)
    to = np.searchsorted(key, np.arange(rows + 1) * every)
    kind = np.dtype(pair.code_type())
    codes, times = (key % every).astype(kind), times.astype("<u4")
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), *(pa.array(count(x)) for x in (parts.n_a, parts.n_b, parts.n_groups, parts.n_links)),
         groups.cast(pa.string()), _binary(codes.tobytes(), to * kind.itemsize).cast(pa.binary()),
         _binary(times.tobytes(), to * 4).cast(pa.binary())],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "times"])


def align_texts(docs: DataFrame, path_a: Path, path_b: Path) -> DataFrame:
    """One row per row of ``docs``: numbers of tokens, groups and links, the groups as text (``a1,a2|b1;a3|b2,b3``), and the linked id
    pairs: distinct codes ``a * size_b + b`` and how many times each is linked (little-endian numbers)."""

    def run(batches):
        pair = _pair(path_a, path_b)
        for whole in batches:
            for b in byte_slices(whole, "text", SLICE_BYTES):
                yield _align_slice(pair, b)

    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).otherwise("").alias("text"))
    return src.mapInArrow(run, ALIGNED)


def _codes(batch: pa.RecordBatch, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and the row of each."""
    arr = batch.column(name).cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(arr.buffers()[2], kind, (off[-1] - off[0]) // width, int(off[0])) if off[-1] > off[0] else np.zeros(0, kind)
    return flat.astype(np.int64), np.repeat(np.arange(len(arr)), np.diff(off) // width)


@dataclass
class PairCounts:
    """How many documents hold each linked id pair. ``regular``: by A's id, those of the pair with the id of B of the same bytes;
    ``best``: by A's id, the highest of any of its pairs; ``frequent``: sorted codes and counts of the most frequent irregular pairs;
    ``pairs``: (code, n) of all irregular pairs."""

    regular: np.ndarray
    best: np.ndarray
    frequent: tuple[np.ndarray, np.ndarray]
    pairs: DataFrame


def _by_id(counts: DataFrame, size: int) -> np.ndarray:
    out, got = np.zeros(size, np.int64), counts.toArrow()
    out[numbers(got, "a")] = numbers(got, "n")
    return out


def count_pairs(aligned: DataFrame, path_a: Path, path_b: Path, scratch: Scratch) -> PairCounts:
    """Documents by linked id pair. Pairs of equal bytes are counted in a vector of A's vocabulary; only the others are shuffled,
    counted by batch before."""
    pair = _pair(path_a, path_b)
    size_a, size_b, kind = pair.size_a, pair.size_b, pair.code_type()

    def regular(batches):
        same, total = _pair(path_a, path_b).identity, np.zeros(size_a, np.int64)
        for b in batches:
            code, _ = _codes(b, "codes", kind)
            a = code // size_b
            total += np.bincount(a[same[a] == code % size_b], minlength=size_a)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["a", "n"])

    def irregular(batches):
        same = _pair(path_a, path_b).identity
        for b in batches:
            code, _ = _codes(b, "codes", kind)
            code, n = np.unique(code[same[code // size_b] != code % size_b], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    codes = aligned.select("codes")
    vector = _by_id(codes.mapInArrow(regular, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")), size_a)
    pairs = scratch.table(codes.mapInArrow(irregular, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    top = _by_id(pairs.groupBy(F.expr(f"code div {size_b}").alias("a")).agg(F.max("n").alias("n")), size_a)
    most = pairs.orderBy(F.desc("n"), "code").limit(FREQUENT).toArrow()
    code, n = numbers(most, "code"), numbers(most, "n")
    order = np.argsort(code)
    return PairCounts(vector, np.maximum(vector, top), (code[order], n[order]), pairs)


def _links_of(b: pa.RecordBatch, counts: tuple, pair: TokenizerPair):
    """All link codes of a batch: row, times, whether the count is known here, the count and the highest of A's id."""
    regular, best, (frequent, often) = counts
    code, row = _codes(b, "codes", pair.code_type())
    times, _ = _codes(b, "times", "<u4")
    a = code // pair.size_b
    same = pair.identity[a] == code % pair.size_b
    n = np.where(same, regular[a], 0)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, code), len(frequent) - 1)
        hit = ~same & (frequent[at] == code)
        n = np.where(hit, often[at], n)
        same = same | hit
    return code, row, times, same, n, best[a]


def align(docs: DataFrame, path_a: Path, path_b: Path, **columns) -> DataFrame:
    """Align the tokens of A (of a space and the text) and of B (of the text; it adds the space) by their bytes.

    Returns for every row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose id pair is on as many rows of ``docs``
    as any pair of its A id), count_sum (rows that hold a link's pair, over all links), and ``columns``: named expressions over
    the columns of ``align_texts``, such as its ``groups``.

    Null and empty texts, and those whose tokens' bytes aren't the text's, have no tokens: zeros and empty groups. Whole texts
    are aligned, however long. Repeated rows, with a null id too, are documents of their own. Other columns of ``docs``
    are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "align")
    aligned = align_texts(docs, path_a, path_b)
    kept = [F.col(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "codes", "times")]
    aligned = scratch.table(aligned.select(*kept, *(x.alias(c) for c, x in columns.items()),
                                           F.monotonically_increasing_id().alias("row")))
    found = count_pairs(aligned, path_a, path_b, scratch)
    counts = (found.regular, found.best, found.frequent)

    def settled(batches):
        pair = _pair(path_a, path_b)
        for b in batches:
            _, row, times, known, n, best = _links_of(b, counts, pair)
            sums = [np.concatenate([[0], np.cumsum(x)])[np.searchsorted(row, np.arange(b.num_rows + 1))]
                    for x in (times * (known & (n == best)), times * n)]
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in b.schema.names if c not in ("codes", "times")),
                                              *(pa.array(np.diff(x)) for x in sums)],
                                             names=[*(c for c in b.schema.names if c not in ("codes", "times")), "n_best", "count_sum"])

    def others(batches):
        pair = _pair(path_a, path_b)
        for b in batches:
            code, row, times, known, _, best = _links_of(b, counts, pair)
            left = ~known
            yield pa.RecordBatch.from_arrays([pa.array(numbers(b, "row")[row[left]]), *(pa.array(x[left]) for x in (code, times, best))],
                                             names=["row", "code", "times", "best"])

    plain = aligned.drop("codes", "times")
    base = aligned.mapInArrow(settled, ", ".join(f"`{c}` {t}" for c, t in plain.dtypes) + ", n_best long, count_sum long")
    rare = aligned.select("row", "codes", "times").mapInArrow(others, "row long, code long, times long, best long")
    more = rare.join(found.pairs, "code").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("n")).alias("_sum"))
    met = base.join(more, "row", "left")
    return met.select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                      (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), *columns)
