"""Operator 12 against the tokenizers themselves and a plain alignment."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dockwatch.llm import alignment, queries
from dockwatch.llm.packing import tokenizer_path

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens(texts):
    """(ids, bytes) of all texts by both libraries, whole texts at once."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    char = alignment.byte_characters()
    for t in texts:
        e = a.encode(" " + t, add_special_tokens=False)
        ids = b.encode(t)
        pieces = [b.id_to_piece(i) for i in ids]
        yield ([(i, bytes(char[c] for c in s)) for i, s in zip(e.ids, e.tokens)],
               [(i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(ids, pieces)])


def spans(toks):
    at, out = 0, []
    for i, x in toks:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def plain_align(rows):
    rows = list(rows)
    docs = []
    for (d, t), (a, b) in zip(rows, tokens([t or "" for _, t in rows])):
        raw = (" " + t).encode() if t else None
        if not raw or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append((d, [], [], [], []))
            continue
        a, b = spans(a), spans(b)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, links, i, j = [], [], 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(a) and a[i][2] <= end:
                ga.append(a[i])
                i += 1
            while j < len(b) and b[j][2] <= end:
                gb.append(b[j])
                j += 1
            groups.append(",".join(str(x) for x, *_ in ga) + "|" + ",".join(str(x) for x, *_ in gb))
            links += [(x, y) for x, s, e in ga for y, u, v in gb if s < v and u < e]
        docs.append((d, a, b, groups, links))
    count = Counter(p for *_, links in docs for p in set(links))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    return Counter((d, len(a), len(b), len(g), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, a, b, g, links in docs)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    bits = ["the", "Straße", " ", "  ", "\n", "\n\n", "\t", " ", " ", "　", "\u0085", "漢字", "é", "🎉🎉", "'s", "it's", "a" * 90,
            "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "﻿", "é", "x y", "12 345", ",", ".", "▁", "﷽", "Å"]
    said = ["".join(rnd.choices(bits[:-3], k=rnd.randint(1, 30))) for _ in range(80)]
    said += [" ".join(rnd.choices(bits, k=rnd.randint(1, 30))) for _ in range(80)]
    odd = [None, "", " ", "  ", "\n", "▁", " a", "a ", "a\n", "\n a", "word", "a b", "The cat  sat .", "x " * 4000, "y" * 9000]
    return list(enumerate(said + odd)) + [(3, said[3]), (3, said[3]), (3, "other"), (None, said[0]), (None, None)]


def test_alignment_equals_the_plain_one(spark, rows, tmp_path):
    schema = "doc_id long, text string, row int, n_a string, codes long"  # names the operator uses itself
    spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_tokenizer_alignment(spark, str(tmp_path))
    want = plain_align(rows)
    assert Counter(map(tuple, got.select(*COLUMNS).collect())) == want
    assert sum(r[1] == 0 for r in want) >= 5  # texts whose bytes B changes, and those without any


def test_pairs_beyond_the_frequent_ones_are_joined(spark, rows, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    got = alignment.align(docs, *paths).collect()
    want = Counter(r[:-1] for r in plain_align(rows).elements())
    assert Counter(map(tuple, got)) == want


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    assert alignment.align(docs, *paths).count() == 0


def test_identity_map_joins_equal_bytes():
    pair = alignment.TokenizerPair(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    a, b = pair.bytes_a.to_pylist(), pair.bytes_b.to_pylist()
    known = np.flatnonzero(pair.identity >= 0)
    assert len(known) > 1000
    assert all(a[i] == b[pair.identity[i]] for i in known)
