"""Operator 1: SentencePiece encoding and decoding over a relational lattice."""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, column, numbers

SPACE = "▁"
#: Most pieces a model may have: the piece table is broadcast.
MOST_PIECES = 1 << 20
#: Units of more characters than this are encoded one by one instead of by the lattice.
LONG = 48
#: Bytes of units whose documents share a dictionary.
BLOCK_BYTES = 96 << 20
#: Texts handed to a task's Python worker at a time.
BATCH_ROWS = 500
#: Bytes of units coded at a time.
PART_BYTES = 8 << 20
#: Units (counted once per block) of a partition of the lattice.
PART_UNITS = 200_000
#: Distinct units of a bucket in a row.
PART_WORDS = 2_000
#: Edges merged at a time.
EDGES = 50_000
#: Units of documents in a row of a block.
SLICE = 100_000
#: Bytes of ids decoded at a time.
ID_BYTES = 1 << 20
NO_ID = -(1 << 63)


@dataclass
class Model:
    """Pieces of a model file. ``kind`` is ``bpe`` (the best adjacent pair is merged first) or ``unigram``
    (the path of the highest total score)."""

    pieces: list[tuple[str, int, float]]
    byte_ids: dict[int, int]
    unknown: int
    longest: int
    kind: str

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> Model:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.vocab_size())
        byte = {int(sp.id_to_piece(i)[3:-1], 16): i for i in ids if sp.is_byte(i)}
        plain = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in ids
                 if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if len(plain) > MOST_PIECES:
            raise ValueError(f"a model of more than {MOST_PIECES} pieces is not broadcast")
        return cls(plain, byte, sp.unk_id(), max((len(p) for p, _, _ in plain), default=1), kind)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.pieces, "piece string, id int, score double")

    def unit_pattern(self) -> str:
        """Parts of a text that no piece reaches over: spaces with the word behind them; a line end by
        itself if no piece holds one."""
        across = any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces)
        if across:
            return r"(?s).+"
        if any("\n" in p for p, _, _ in self.pieces):
            return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        return f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"


def units(text: str, model: Model) -> Column:
    """A text's units, in order: spaces become ``SPACE`` and one is put in front; an empty text has none."""
    t = F.coalesce(F.col(text), F.lit(""))
    marked = F.concat(F.lit(SPACE), F.translate(t, " ", SPACE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(marked, F.lit(model.unit_pattern()), F.lit(0)))


def edges(words: DataFrame, pieces: DataFrame, longest: int, *key: str) -> DataFrame:
    """(key, unit, start, stop, id, score): the substrings of each unit that are pieces. Every substring of at most ``longest``
    characters is exploded and meets the piece table by an equi-join."""
    # the empty cut (no characters) at the first place keeps a unit without any piece
    ends = words.select(*key, "unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("start"))
    tails = ends.withColumn("tail", F.substring(F.col("unit"), F.col("start") + 1, F.lit(longest)))
    each = tails.select(*key, "unit", "start", "tail", F.explode(F.sequence(
        F.when(F.col("start") == 0, 0).otherwise(1), F.length("tail"))).alias("k")).select(
        *key, "unit", "start", (F.col("start") + F.col("k")).alias("stop"), F.expr("left(tail, k)").alias("piece"))
    return each.join(F.broadcast(pieces), "piece", "left").where("id is not null or stop = 0").select(
        *key, "unit", "start", "stop", "id", "score")


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(bucket, h, unit, n, edges): the edges of each unit in one row. ``words`` holds distinct units and their hash ``h``,
    which is quick to sort by."""
    edge = F.struct("start", "stop", "id", "score")
    return edges(words, pieces, longest, "bucket", "h").groupBy("bucket", "h", "unit").agg(
        F.collect_list(F.when(F.col("stop") > 0, edge)).alias("edges")).withColumn("n", F.length("unit"))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, not once in each step of a fold."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merged_ends(of: np.ndarray, start: np.ndarray, stop: np.ndarray, score: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge in every unit, again and again, the adjacent pair of the best score (leftmost of equals), one pair of each unit a
    round. ``of`` is an edge's unit, ``n`` the units' lengths. Returns the units' first places and, for each place, where the
    segment that begins there ends (0: none begins there)."""
    first = np.append(0, np.cumsum(n + 1))
    end = np.arange(1, first[-1] + 1)
    end[first[1:] - 1] = 0
    begin, to = first[of] + start, first[of] + stop
    pairs = np.flatnonzero(to - begin > 1)
    pairs = pairs[np.lexsort((start[pairs], -score[pairs], of[pairs]))]
    of, begin, to = of[pairs], begin[pairs], to[pairs]
    while len(of):
        # a pair: two segments that together make the piece
        mid = end[begin]
        open_ = (mid > 0) & (mid < to)
        pair = np.flatnonzero(open_ & (end[mid] == to))
        if not len(pair):
            break
        unit = of[pair]
        best = pair[np.append(True, unit[1:] != unit[:-1])]
        end[mid[best]] = 0
        end[begin[best]] = to[best]
        going = np.zeros(len(n), bool)
        going[unit] = True
        keep = open_ & going[of]
        of, begin, to = of[keep], begin[keep], to[keep]
    return first, end


def viterbi_bounds(edges: str, n: str, unknown_score: float) -> Column:
    """Boundaries of the path with the highest sum of scores; a character that is no piece costs ``unknown_score``.
    The fold keeps, for each position reached, the best score and where its last edge begins (the longest edge of equals)."""
    zero = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start")))

    def step(best, j):
        ways = F.transform(F.filter(edges, lambda e: e["stop"] == j), lambda e: F.struct(
            (F.get(best, e["start"])["score"] + e["score"]).alias("score"), e["start"].cast("int").alias("start")))
        other = F.struct((F.get(best, j - 1)["score"] + F.lit(unknown_score)).alias("score"), (j - 1).alias("start"))
        top = F.reduce(ways, other, lambda a, x: F.when(
            (x["score"] > a["score"]) | ((x["score"] == a["score"]) & (x["start"] < a["start"])), x).otherwise(a))
        return F.concat(best, F.array(top))

    best = F.aggregate(F.sequence(F.lit(1), F.col(n)), zero, step)
    return _bind(best, lambda b: F.aggregate(
        F.sequence(F.lit(1), F.col(n)), F.array(F.col(n)), lambda path, _: F.when(
            F.get(path, F.lit(0)) > 0, F.concat(F.array(F.get(b, F.get(path, F.lit(0)))["start"]), path)).otherwise(path)))


def _ids(model: Model) -> Column:
    """Ids of the segments between ``bounds``; a character that is no piece becomes its bytes (or the unknown id)."""
    def fallback(char):
        if len(model.byte_ids) < 256:
            return F.array(F.lit(model.unknown))
        table = F.array(*(F.lit(model.byte_ids[i]) for i in range(256)))
        hexed = F.hex(F.encode(char, "UTF-8"))
        return F.transform(F.sequence(F.lit(0), F.octet_length(char) - 1), lambda i: F.get(
            table, F.conv(F.substring(hexed, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int")))

    def segment(k, bounds, hits):
        a, b = F.get(bounds, k - 1), F.get(bounds, k)
        own = F.filter(hits, lambda e: e["start"] == a)
        return F.when(F.size(own) > 0, F.transform(own, lambda e: e["id"])).otherwise(
            fallback(F.substring(F.col("unit"), a + 1, b - a)))

    def spelled(bounds, hits):
        return F.flatten(F.transform(F.sequence(F.lit(1), F.size(bounds) - 1), lambda k: segment(k, bounds, hits)))

    # the edges that are segments: where one begins, the next boundary is its end
    hits = lambda bounds: F.array_sort(F.filter("edges", lambda e: F.get(
        bounds, F.array_position(bounds, e["start"]).cast("int")) == e["stop"]))
    return _bind(F.col("bounds"), lambda b: _bind(hits(b), lambda h: F.when(
        F.size(h) == F.size(b) - 1, F.transform(h, lambda e: e["id"])).otherwise(spelled(b, h))))


def encode_unit(unit: str, model: Model, table: dict[str, tuple[int, float]]) -> list[int]:
    """One long unit by the same rule as the folds, in about linear time."""
    n = len(unit)
    if model.kind == "bpe":
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))  # of the segment that begins at a place
        alive = [True] * n
        heap = []

        def offer(i):
            j = right[i]
            if j < n and (hit := table.get(unit[i:right[j]])) and right[j] - i <= model.longest:
                heapq.heappush(heap, (-hit[1], i, j, right[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not (alive[i] and alive[j] and right[i] == j and right[j] == k):
                continue
            alive[j] = False
            right[i] = k
            if k < n:
                left[k] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        bounds = [i for i in range(n) if alive[i]] + [n]
    else:
        low = min((s for _, s in table.values()), default=0.0) - 10.0
        best = [(0.0, 0)] + [(float("-inf"), 0)] * n
        for j in range(1, n + 1):
            for i in range(max(0, j - model.longest), j):
                s = table[unit[i:j]][1] if unit[i:j] in table else low if j - i == 1 else None
                if s is not None and best[i][0] + s > best[j][0]:
                    best[j] = (best[i][0] + s, i)
        bounds = [n]
        while bounds[0]:
            bounds.insert(0, best[bounds[0]][1])
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if unit[a:b] in table:
            out.append(table[unit[a:b]][0])
        elif len(model.byte_ids) == 256:
            out += [model.byte_ids[x] for x in unit[a:b].encode()]
        else:
            out.append(model.unknown)
    return out


def _encode_long(model: Model):
    def run(batches):
        table = {p: (i, s) for p, i, s in model.pieces}
        for b in batches:
            ids = [encode_unit(x, model, table) for x in b.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("bucket"), b.column("unit"), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["bucket", "unit", "ids"])

    return run


def _merge(byte_ids: dict[int, int], unknown: int):
    """Ids of the units whose edges come in order of ``at``, ``EDGES`` edges or more at a time. A unit's first edge is empty
    and carries its text."""
    apart = "the edges of a unit are not in one place"

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += b.num_rows
            if size >= EDGES:
                t = pa.Table.from_batches(held)
                # the last unit may go on in the next batch
                last = int(np.searchsorted(numbers(t, "at"), numbers(b, "at")[-1]))
                if last:
                    yield merged(t.slice(0, last))
                held, size = t.slice(last).to_batches(), t.num_rows - last
        if held:
            yield merged(pa.Table.from_batches(held))
        del held
        pa.default_memory_pool().release_unused()  # the worker waits for the next stage

    def merged(t: pa.Table) -> pa.RecordBatch:
        stop = numbers(t, "stop")
        head = np.flatnonzero(stop == 0)
        unit = column(t, "unit").take(pa.array(head))
        n = pc.utf8_length(unit).to_numpy().astype(np.int64)
        at = numbers(t, "at")
        if (np.diff(at) < 0).any() or len(np.unique(at)) != len(head) or (at[head] != np.unique(at)).any():
            raise ValueError(apart)
        of = np.searchsorted(at[head], at)
        real = np.flatnonzero(stop)
        of, start, stop = of[real], numbers(t, "start")[real].astype(np.int64), stop[real].astype(np.int64)
        piece = column(t, "id").take(pa.array(real)).to_numpy()
        first, end = merged_ends(of, start, stop, column(t, "score").take(pa.array(real)).to_numpy(), n)
        # the edges that are segments
        hit = end[first[of] + start] == first[of] + stop
        known = np.full(len(end), -1, np.int32)
        known[(first[of] + start)[hit]] = piece[hit]
        at = np.flatnonzero(end)
        ids, count = known[at], np.ones(len(at), np.int64)
        spelled = {}
        for i in np.flatnonzero(ids < 0).tolist():  # a character that is no piece
            u = int(np.searchsorted(first, at[i], "right")) - 1
            char = unit[u].as_py()[at[i] - first[u]:end[at[i]] - first[u]]
            spelled[i] = [byte_ids[x] for x in char.encode()] if len(byte_ids) == 256 else [unknown]
            count[i] = len(spelled[i])
        begin = np.append(0, np.cumsum(count))
        flat = np.repeat(ids, count)
        for i, own in spelled.items():
            flat[begin[i]:begin[i + 1]] = own
        lists = pa.ListArray.from_arrays(pa.array(begin[np.searchsorted(at, first)], pa.int32()), pa.array(flat, pa.int32()))
        return pa.RecordBatch.from_arrays([column(t, "bucket").take(pa.array(head)), unit, lists], names=["bucket", "unit", "ids"])

    return run


def encode_units(words: DataFrame, model: Model, packed: bool = False) -> DataFrame:
    """(bucket, unit, ids) of distinct units of at most ``LONG`` characters (columns unit and bucket, 0 if missing); with
    ``packed`` many of a bucket in a row (``CODED``), by the task that made them."""
    table = model.frame(words.sparkSession)
    if "bucket" not in words.columns:
        words = words.withColumn("bucket", F.lit(0))
    if model.kind == "bpe":
        rows = edges(words.withColumn("at", F.monotonically_increasing_id()), table, model.longest, "bucket", "at")
        # exploding and the broadcast join keep a unit's edges together; the merges fail if they don't
        rows = rows.withColumn("unit", F.when(F.col("stop") == 0, F.col("unit")))
        run = _merge(model.byte_ids, model.unknown)
        return rows.mapInArrow(_packed(run), CODED) if packed else rows.mapInArrow(run, UNIT_IDS)
    low = min((s for _, _, s in model.pieces), default=0.0) - 10.0
    short = lattice(words.withColumn("h", F.xxhash64("unit")), table, model.longest)
    ids = short.withColumn("bounds", viterbi_bounds("edges", "n", low)).select(
        "bucket", "unit", _ids(model).cast("array<int>").alias("ids"))
    return ids.mapInArrow(_packed(iter), CODED) if packed else ids


def _zip(x: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed byte plane by byte plane."""
    return pa.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unzip(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _zip_strings(x: pa.StringArray) -> tuple[bytes, bytes, int]:
    """Lengths and text, compressed, and how many bytes the text has."""
    off = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1] if len(x) else np.zeros(1, np.int32)
    text = x.buffers()[2].slice(int(off[0]), int(off[-1] - off[0])) if off[-1] > off[0] else pa.py_buffer(b"")
    return _zip(np.diff(off)), pa.compress(text, "zstd", asbytes=True), text.size


def _unzip_strings(row: dict) -> pa.StringArray:
    off = np.append(0, np.cumsum(_unzip(row["lens"], row["n"]), dtype=np.int64)).astype(np.int32)
    return pa.StringArray.from_buffers(row["n"], pa.py_buffer(off), pa.decompress(row["text"], row["text_bytes"], "zstd"))


def _zip_ids(ids: pa.ListArray) -> tuple[bytes, int, bytes]:
    """How many ids each list has, how many there are, and all ids, compressed."""
    flat = ids.flatten()
    return _zip(pc.list_value_length(ids).to_numpy()), len(flat), _zip(flat.to_numpy())


UNIT_IDS = "bucket int, unit string, ids array<int>"
BLOCK = "block long, docs binary, sizes binary, codes binary, n long, lens binary, text binary, text_bytes long"
ASKED = "bucket int, block long, n long, pos binary, lens binary, text binary, text_bytes long"
CODED = "bucket int, n long, lens binary, text binary, text_bytes long, counts binary, total long, ids binary"
ANSWERED = "of long, n long, pos binary, counts binary, total long, ids binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows), fields)],
                                      names=[n for n, _ in fields])


def _blocks(block_bytes: int):
    """Documents of a task in blocks of about ``block_bytes``: their ids, how many units each has, the place of each unit
    in the block's own dictionary (most frequent first), and the dictionary."""

    def pack(held: list[tuple[np.ndarray, np.ndarray, pa.DictionaryArray]], block: int) -> pa.RecordBatch:
        docs, sizes, coded = zip(*held)
        coded = pa.chunked_array(coded).unify_dictionaries().combine_chunks()
        at, words = coded.indices.to_numpy(), coded.dictionary
        order = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        units_of = words.take(pa.array(order)).cast(pa.string())
        docs, sizes, codes = np.concatenate(docs), np.concatenate(sizes), rank[at]
        to = np.append(0, np.cumsum(sizes))
        rows, a = [], 0
        while a < len(docs):  # about ``SLICE`` units in a row, one document at least; the first row holds the dictionary
            b = max(a + 1, int(np.searchsorted(to, to[a] + SLICE, "right")) - 1)
            rows.append((block, docs[a:b].tobytes(), sizes[a:b].tobytes(), _zip(codes[to[a]:to[b]]), len(units_of),
                         *((None, None, None) if a else _zip_strings(units_of))))
            a = b
        return _batch(rows, BLOCK)

    def code(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
        # the texts are held as codes, so that a block never has them twice
        arr = column(part, "units")
        off = arr.offsets.to_numpy()
        return (numbers(part, "doc_id").astype(np.int64), np.diff(off).astype(np.int64),
                arr.values.slice(off[0], off[-1] - off[0]).dictionary_encode())

    def run(batches):
        held, size, block = [], 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for part in list_slices(b, "units", min(block_bytes, PART_BYTES)):
                held.append(code(part))
                size += part.nbytes
                if size >= block_bytes:
                    yield pack(held, block)
                    held, size, block = [], 0, block + 1
                    pa.default_memory_pool().release_unused()
        if held:
            yield pack(held, block)

    return run


def _deal(buckets: int):
    """A block's dictionary in parts, dealt by the hash of the unit: places (as differences) and units, compressed."""

    def run(batches):
        from pandas.util import hash_array

        for b in batches:
            for row in b.to_pylist():
                words = _unzip_strings(row)
                bucket = hash_array(words.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                words = words.take(pa.array(order))
                cuts = np.append(np.flatnonzero(np.diff(bucket[order], prepend=np.uint64(buckets))), len(order)).tolist()
                rows = [(int(bucket[order[i]]), row["block"], j - i, _zip(np.diff(order[i:j], prepend=0)), *_zip_strings(words.slice(i, j - i)))
                        for i, j in zip(cuts, cuts[1:])]
                if rows:
                    yield _batch(rows, ASKED)

    return run


def _distinct(asked: pa.Table) -> pa.Table:
    """The units of one bucket, once each, ``PART_WORDS`` in a row."""
    words = pa.chunked_array([_unzip_strings(r) for r in asked.to_pylist()], pa.string()).unique()
    at = np.append(np.arange(0, len(words), PART_WORDS), len(words))
    bucket = np.full(len(at) - 1, asked.column("bucket")[0].as_py(), np.int32)
    return pa.table({"bucket": bucket, "part": np.arange(len(bucket), dtype=np.int32),
                     "units": pa.ListArray.from_arrays(pa.array(at, pa.int32()), words)})


def _packed(run):
    """What ``run`` yields, the units and ids of a bucket in one row, compressed."""

    def pack(batches):
        for b in run(batches):
            bucket = numbers(b, "bucket")
            rows = []
            for k in np.unique(bucket).tolist():
                part = b.filter(pa.array(bucket == k))
                rows.append((k, part.num_rows, *_zip_strings(part.column("unit")), *_zip_ids(part.column("ids"))))
            if rows:
                yield _batch(rows, CODED)

    return pack


def _unzip_ids(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return _unzip(row["counts"], row["n"]).astype(np.int64), _unzip(row["ids"], row["total"]).astype(np.int32)


def _answer(asked: pa.Table, coded: pa.Table) -> pa.Table:
    """The ids of one bucket's units for each block that asked."""
    got = coded.to_pylist()
    words = pa.chunked_array([_unzip_strings(r) for r in got], pa.string()).combine_chunks()
    both = [_unzip_ids(r) for r in got]
    count, flat = (np.concatenate([x[i] for x in both]) if both else np.zeros(0, np.int64) for i in (0, 1))
    begin = np.append(0, np.cumsum(count))
    rows = []
    for r in asked.to_pylist():
        at = pc.index_in(_unzip_strings(r), value_set=words).to_numpy()
        ids = flat[_ranges(begin[at], count[at])]
        rows.append((r["block"], r["n"], r["pos"], _zip(count[at]), len(ids), _zip(ids)))
    del got, both, words
    pa.default_memory_pool().release_unused()  # the worker waits for the next stage
    return pa.Table.from_batches([_batch(rows, ANSWERED)])


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def list_slices(batch: pa.RecordBatch, name: str, limit: int):
    """Cut a batch so that a slice's lists of strings have about ``limit`` bytes (one row at least)."""
    if batch.nbytes <= limit:
        yield batch
    elif batch.num_rows == 1:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from list_slices(batch.slice(0, half), name, limit)
        yield from list_slices(batch.slice(half), name, limit)


def _apply(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Ids of one block's documents from the block's own dictionary."""
    out = []
    length = begin = val = None
    for row in docs.to_pylist():
        if length is None:
            length, begin, flat, done = np.zeros(row["n"], np.int64), np.zeros(row["n"], np.int64), [], 0
            for w in words.to_pylist():
                count, ids = _unzip_ids(w)
                at = np.cumsum(_unzip(w["pos"], w["n"]), dtype=np.int64)
                length[at], begin[at] = count, done + np.cumsum(count) - count
                flat.append(ids)
                done += len(ids)
            val = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        doc, to = np.frombuffer(row["docs"], np.int64), np.append(0, np.cumsum(np.frombuffer(row["sizes"], np.int64)))
        at = _unzip(row["codes"], int(to[-1]))
        n = length[at]
        ids = val[_ranges(begin[at], n)]
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(n))[to], pa.int64()), pa.array(ids, pa.int32()))
        out.append(pa.table({"doc_id": pa.array(doc, mask=doc == NO_ID), "ids": lists.cast(pa.list_(pa.int32()))}))
    return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})


def _written(blocks: DataFrame) -> DataFrame:
    """The blocks, written dealt by block: the join with their answers does not shuffle the documents' places again."""
    spark = blocks.sparkSession
    scratch = Scratch(spark, "pieces")
    name = "pieces_" + scratch.root.rsplit("-", 1)[1]
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    spark.conf.set(rows, str(BATCH_ROWS))  # a row is a whole text
    try:
        blocks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").option(
            "path", f"{scratch.root}/blocks").saveAsTable(name)
    finally:
        spark.conf.set(rows, before)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are not the catalog's
    return out


def encode(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every whole text; with ``decoded`` also n_ids, and text_sha256 (of UTF-8) and text_length (in
    characters) of the text decoded from the ids, by the task that put them together.

    Texts are cut into units and written once, in blocks of about ``block_bytes``: places in the block's dictionary,
    compressed. The dictionaries are dealt once by the units' hash, compressed too; the distinct units of a bucket are encoded
    once by the lattice, and their ids go back to the blocks: a unit travels once for each block that holds it, whatever its
    frequency, and a block meets only its own dictionary.

    Null and empty texts have no ids. Rows are encoded one by one, repeated ones and null doc_ids too. Other columns are ignored. Special
    pieces are never made of text. A text's own U+2581 counts as a space.
    """
    spark = docs.sparkSession
    cut = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), units("text", model).alias("units"))
    blocks = _written(cut.mapInArrow(_blocks(block_bytes), BLOCK))
    dictionaries = blocks.where("text_bytes is not null")
    many = dictionaries.agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-many // PART_UNITS))
    dealt = dictionaries.select("block", "n", "lens", "text", "text_bytes").mapInArrow(_deal(parts), ASKED).repartition(parts, "bucket")
    # dealt evenly, so that a task has one Python worker: for distinct units or for merges
    words = dealt.groupBy("bucket").applyInArrow(_distinct, "bucket int, part int, units array<string>").repartition(
        parts, "bucket", "part").select("bucket", F.explode("units").alias("unit"))
    short, long = words.where(F.length("unit") <= LONG), words.where(F.length("unit") > LONG)
    coded = encode_units(short, model, packed=True).union(long.mapInArrow(_packed(_encode_long(model)), CODED))
    known = dealt.groupBy("bucket").cogroup(coded.groupBy("bucket")).applyInArrow(_answer, ANSWERED)
    both = blocks.drop("lens", "text", "text_bytes").groupBy("block").cogroup(known.groupBy("of"))
    if not decoded:
        return both.applyInArrow(_apply, "doc_id long, ids array<int>")
    digest = _digest(model)
    return both.applyInArrow(lambda docs, words: digest(_apply(docs, words)),
                             "doc_id long, ids array<int>, n_ids int, text_sha256 string, text_length long")


def _speller(model: Model):
    spell: dict[int, bytes] = {i: p.encode() for p, i, _ in model.pieces} | {i: bytes([b]) for b, i in model.byte_ids.items()}
    mark = SPACE.encode()

    def text(ids: list[int] | None) -> str:
        raw = b"".join(spell.get(i, b" \xe2\x81\x87 ") for i in ids or [])
        return raw.replace(mark, b" ").decode("utf-8", "replace").removeprefix(" ")

    return text


def _decode(model: Model):
    def run(batches):
        text = _speller(model)
        for b in batches:
            texts = [text(ids) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null and empty ids give an empty text, an unknown id U+2047 between spaces."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(model), "doc_id long, text string")


def _digest(model: Model):
    def run(t: pa.Table) -> pa.Table:
        text = _speller(model)
        sha, size = [], []
        for whole in t.to_batches():
            for b in list_slices(whole, "ids", ID_BYTES):
                for ids in b.column("ids").to_pylist():
                    one = text(ids)
                    sha.append(hashlib.sha256(one.encode()).hexdigest())
                    size.append(len(one))
        n = pc.list_value_length(t.column("ids"))
        return (t.append_column("n_ids", n).append_column("text_sha256", pa.array(sha, pa.string()))
                .append_column("text_length", pa.array(size, pa.int64())))

    return run
