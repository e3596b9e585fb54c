"""Operator 10: conversations as a prefix tree, emitted once depth-first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch

OPEN, CLOSE = "<turn>", "</turn>\n"
LOSS_ROLE = "assistant"
ROWS_AT_ONCE = 1024
_CONTROL = re.compile(r"\\|<(?=/?turn>)")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn>([^\n]*)\n(.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    """Reversible; the result holds no control string of the template."""
    return _CONTROL.sub(lambda m: "\\\\" if m.group() == "\\" else "\\l", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {"l": "<", "n": "\n"}.get(m.group(1), m.group(1)), text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and the place and length of what is under the loss mask."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(body) if role == LOSS_ROLE else 0


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of formatted turns."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _chain(batches):
    """Names each turn by a hash of all turns up to it; the last turn of a conversation carries the
    whole path. Rows come sorted by conversation and turn; one conversation may span batches."""
    out = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
                     ("role", pa.string()), ("text", pa.string()), ("path", pa.binary())])
    conv, started, depth, node, path, held, rows = None, False, 0, b"", [], None, []
    for b in batches:
        for c, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
            if not started or c != conv:
                if held:
                    rows.append((*held, b"".join(path)))
                conv, started, depth, node, path = c, True, 0, b"", []
            elif held:
                rows.append((*held, None))
            h = hashlib.blake2b(node, digest_size=16)
            h.update(b"%d:" % len(role.encode("utf-8", "surrogatepass")))
            h.update((role + text).encode("utf-8", "surrogatepass"))
            parent, node = node, h.digest()
            path.append(node)
            held = (c, depth, node, parent, role, text)
            depth += 1
            if len(rows) >= ROWS_AT_ONCE:
                yield _emit(rows, out)
                rows = []
    if held:
        rows.append((*held, b"".join(path)))
    yield _emit(rows, out)


_TOKENIZERS: dict[str, object] = {}


def _format(path):
    out = pa.schema([("node", pa.binary()), ("formatted", pa.string()), ("loss_start", pa.int64()),
                     ("loss_length", pa.int64()), ("token_ids", pa.list_(pa.int32()))])

    def run(batches):
        from tokenizers import Tokenizer

        name = path()
        if name not in _TOKENIZERS:
            _TOKENIZERS[name] = Tokenizer.from_file(name)
            _TOKENIZERS[name].encode_special_tokens = True
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                made = [format_turn(r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
                ids = _TOKENIZERS[name].encode_batch([m[0] for m in made], add_special_tokens=False)
                yield _emit([(n, *m, e.ids) for n, m, e in zip(b.column("node").to_pylist(), made, ids)], out)

    return run


def _intervals(batches):
    """Position of each node below its ancestors, and the stretches of the emitted stream it attends to:
    its ancestors and itself. Stretches that touch are one, so there are as many as side branches taken."""
    out = pa.schema([("node", pa.binary()), ("position", pa.int64()),
                     ("attends", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
    rank, position, spans, rows = None, 0, [], []
    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("rank", "node", "start", "length", "own")]
        for r, node, start, length, own in zip(*cols):
            if r != rank:
                rank, position, spans = r, 0, []
            if spans and spans[-1][1] == start:
                spans[-1] = (spans[-1][0], start + length)
            else:
                spans.append((start, start + length))
            if own:
                rows.append((node, position, [{"start": s, "stop": e} for s, e in spans]))
            position += length
            if len(rows) >= ROWS_AT_ONCE:
                yield _emit(rows, out)
                rows = []
    yield _emit(rows, out)


def prefix_tree(turns: DataFrame, tokenizer: Callable[[], str]) -> tuple[DataFrame, DataFrame]:
    """The tree of all conversations and the nodes of each conversation.

    ``turns``: conv_id, turn, role, text. Conversations with the same first turns share these nodes.
    tree: node, parent, start and length (tokens) in the emitted depth-first stream, position of the first token (token i has
    ``position + i``), attends (stretches of the stream), formatted, loss_start and loss_length (characters of ``formatted``),
    token_ids. paths: conv_id, depth, node.

    Depth-first order without gathering a tree: conversations are sorted by their path of node hashes, a node stands
    where its first conversation does, at its depth. A first turn shared by any number of conversations is only grouped and joined.
    Null text and role are empty. Rows of a conversation stand by turn (null first), role, text; repeated rows
    are repeated turns. A null conv_id is one conversation. Other columns are ignored.
    """
    scratch = Scratch(turns.sparkSession, "chat")
    src = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    chain = scratch.table(ordered.mapInArrow(
        _chain, "conv_id long, depth long, node binary, parent binary, role string, text string, path binary"))
    ends = chain.where("path is not null").select("conv_id", "path").orderBy("path", "conv_id")
    ranks = scratch.table(ends.select("conv_id", F.monotonically_increasing_id().alias("rank")))
    same = lambda a, b, k: a.withColumnRenamed(k, "_k").join(b, F.col("_k").eqNullSafe(F.col(k))).drop("_k")
    places = scratch.table(same(chain.select("conv_id", "depth", "node"), ranks, "conv_id"))
    first = places.groupBy("node").agg(F.min("rank").alias("rank"))
    nodes = places.join(first, ["node", "rank"])  # one row a node
    content = chain.select("node", "parent", "role", "text").dropDuplicates(["node"])
    made = content.select("node", "role", "text").mapInArrow(
        _format(tokenizer), "node binary, formatted string, loss_start long, loss_length long, token_ids array<int>")
    sized = scratch.table(nodes.select("node", "rank", "depth").join(content.select("node", "parent"), "node").join(made, "node")
                          .withColumn("length", F.size("token_ids").cast("long")))
    # depth-first order: ranges, a running sum inside each, and the sums of the ranges before
    line = scratch.table(sized.select("node", "rank", "depth", "length").repartitionByRange("rank", "depth")
                         .withColumn("part", F.spark_partition_id()))
    parts = line.groupBy("part").agg(F.sum("length").alias("s"))
    before = F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row for each partition
    inside = F.sum("length").over(Window.partitionBy("part").orderBy("rank", "depth"))
    starts = scratch.table(line.withColumn("inside", inside).join(F.broadcast(parts), "part").select(
        "node", "length", (F.col("before") + F.col("inside") - F.col("length")).alias("start"), F.col("rank").alias("own_rank")))
    along = places.join(starts, "node").withColumn("own", F.col("rank") == F.col("own_rank"))
    spans = along.repartition("rank").sortWithinPartitions("rank", "depth").mapInArrow(
        _intervals, "node binary, position long, attends array<struct<start:long,stop:long>>")
    tree = sized.join(starts.select("node", "start"), "node").join(spans, "node").drop("rank")
    return scratch.table(tree), places.select("conv_id", "depth", "node")


def _read_back(batches):
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    conv, state, rows = None, None, []

    def done():
        n, turns, chars, loss, size = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("conv_id", "formatted", "loss_start", "loss_length")]
        for c, text, at, n in zip(*cols):
            if state is None or c != conv:
                if state:
                    rows.append(done())
                conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in parse_turns(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            masked = unescape(text[at:at + n])
            state[2] += len(masked)
            state[3].update(masked.encode("utf-8", "surrogatepass"))
            state[4] += len(text)
            if len(rows) >= ROWS_AT_ONCE:
                yield _emit(rows, out)
                rows = []
    if state:
        rows.append(done())
    yield _emit(rows, out)


def read_back(tree: DataFrame, paths: DataFrame) -> DataFrame:
    """What each conversation says, parsed from the emitted nodes: number of turns, digests and sizes."""
    whole = paths.join(tree.select("node", "formatted", "loss_start", "loss_length"), "node")
    return whole.repartition("conv_id").sortWithinPartitions("conv_id", "depth").mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
