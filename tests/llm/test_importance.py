"""Operator 13 against a plain computation, and its odd cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dockwatch.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, score double, weight string, n_words int"  # names the operator uses itself


def plain_features(text, buckets=importance.BUCKETS):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resample(docs, target, percent, min_words, buckets=importance.BUCKETS):
    rows = [(d, *plain_features(t, buckets)) for d, t in docs]
    s, t = Counter(b for _, _, f in rows for b in f), Counter(b for x in target for b in plain_features(x, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for d, n, f in rows:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = k + 1
    return Counter(map(tuple, out))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    words = ["Aa", "bb", "çà", "漢字", "x1", "w" * 70, "zz", "q", "l" * 5000]
    said = [" ".join(rnd.choices(words[:8], k=rnd.randint(0, 60))) for _ in range(60)]
    odd = [None, "", " ", "...", "one,two;THREE\nfour\x00five", " nbspİ", words[8] + " " + words[8] + "-" + words[8], "🎉" * 30]
    out = list(enumerate(said + odd)) + [(5, said[5]), (5, said[5]), (5, "other words " * 15), (None, said[7]), (None, None)]
    return out + [(99, " ".join(rnd.choices(words[:8], k=40_000)))]


TARGET = ["aa bb zz", None, "", "q q q aa bb çà", "THREE four five"]


def test_resample_equals_the_plain_computation(spark, rows):
    docs = spark.createDataFrame([(d, t, 0.5, "w", 3) for d, t in rows], SCHEMA).repartition(3)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = importance.resample(docs, target, percent=30, min_words=5)
    want = plain_resample(rows, TARGET, 30, 5)
    assert Counter(map(tuple, got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect())) == want
    assert sum(r[5] is not None for r in want) >= 10


def test_empty_tables(spark, rows):
    none = spark.createDataFrame([], SCHEMA)
    assert importance.resample(none, none).count() == 0
    docs = spark.createDataFrame([(d, t, 0.5, "w", 3) for d, t in rows[:20]], SCHEMA)
    got = importance.resample(docs, none, percent=50, min_words=0, buckets=97)
    assert Counter(map(tuple, got.collect())) == plain_resample(rows[:20], [], 50, 0, 97)


@pytest.mark.parametrize("window", [1, 40, 1000, 1 << 20])
def test_windows_and_dictionary_do_not_change_features(monkeypatch, rows, window):
    texts = [t or "" for _, t in rows[:-1]]
    monkeypatch.setattr(importance, "WINDOW_BYTES", window)
    monkeypatch.setattr(importance, "_SCANNER", [])
    monkeypatch.setattr(importance, "DICTIONARY_WORDS", 10)
    got, words = [Counter() for _ in texts], np.zeros(len(texts), np.int64)
    for n, doc, bucket in importance.features(pa.array([t + " " for t in texts]), 10_000):
        words += n
        for d, b in zip(doc.tolist(), bucket.tolist()):
            got[d][b] += 1
    want = [plain_features(t) for t in texts]
    assert words.tolist() == [n for n, _ in want]
    assert got == [Counter(f) for _, f in want]


def test_crc_of_joined_texts():
    shift = importance.CrcShift()
    x, sizes = b"some words", [0, 1, 2, 64, 65, 66, 67, 1000, 70_000]
    for n, got in zip(sizes, shift(np.full(len(sizes), zlib.crc32(x), np.uint32), np.array(sizes))):
        y = bytes(range(256)) * (n // 256 + 1)
        assert int(got) ^ zlib.crc32(y[:n]) == zlib.crc32(x + y[:n])
