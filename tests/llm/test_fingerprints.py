"""Operator 11 against plain set differences, and its odd cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dockwatch.llm import fingerprints

SCHEMA = "doc_id long, text string, part int, kind string, n_chars string"  # names the operator uses itself


def plain_likeness(x, y):
    a, b = Counter(fingerprints.paragraphs(x)), Counter(fingerprints.paragraphs(y))
    n = sum(a.values()) + sum(b.values())
    return 1.0 if n == 0 else 1 - (sum((a - b).values()) + sum((b - a).values())) / n


def plain_versions(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (d, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), plain_likeness(t, e), plain_likeness(t, nxt)))
    return out


def digest(r):
    return (r.doc_id, r.n_chars, r.edited_sha256, pytest.approx(r.near_edited, abs=1e-12), pytest.approx(r.near_next, abs=1e-12))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    words = ["one", "two.", "three\n", "vier!", "çà", "漢字", "🎉", "word", "another", "\n\n", "..."]
    said = [" ".join(rnd.choices(words, k=rnd.randint(0, 300))) for _ in range(70)]
    odd = [None, "", "a", "ab", "same " * 400, "x" * 3000, "\n" * 50, "line\n" * 200, said[5], said[6] + " more"]
    return list(zip(range(0, 1000, 7), said + odd)) + [(-5, " ".join(rnd.choices(words, k=30_000)))]


def test_versions_equal_the_plain_computation(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "k", "n") for d, t in rows], SCHEMA).repartition(5)
    got = {r.doc_id: r for r in fingerprints.fingerprint_versions(docs).collect()}
    want = plain_versions(rows)
    assert len(got) == len(want)
    for w in want:
        assert w == digest(got[w[0]])
    texts = {d: t or "" for d, t in rows}
    by_print = {}
    for d, r in got.items():
        by_print.setdefault(r.fingerprint, set()).add(texts[d])
    assert all(len(x) == 1 for x in by_print.values())
    assert len(by_print) == len(set(texts.values()))


def test_repeated_and_null_ids(spark):
    rows = [(3, "c"), (1, "a b c"), (3, "c"), (2, None), (None, "null id"), (None, "null id"), (1, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(r[:3] for r in map(tuple, fingerprints.fingerprint_versions(docs).collect()))
    assert got == Counter(r[:3] for r in plain_versions(rows))


def test_one_row_follows_itself_and_none_give_none(spark):
    docs = spark.createDataFrame([(4, "some text. and more")], "doc_id long, text string")
    (r,) = fingerprints.fingerprint_versions(docs).collect()
    assert (r.n_chars, r.near_next) == (19, 1.0)
    assert fingerprints.fingerprint_versions(docs.limit(0)).count() == 0


def test_compare_recovers_the_paragraphs(spark, rows):
    texts = [t for _, t in rows]
    pairs = [(k, a, b) for k, (a, b) in enumerate(zip(texts, texts[1:] + texts[:1]))] + [(-1, texts[3], texts[3] + "new end.")]
    got = {r.doc_id: r for r in fingerprints.compare_versions(spark.createDataFrame(pairs, "doc_id long, old string, new string")).collect()}
    for k, a, b in pairs:
        keys, n = fingerprints.paragraph_keys([a or "", b or ""])
        old, new = set(keys[:n[0]].view(np.int64).tolist()), set(keys[n[0]:].view(np.int64).tolist())
        assert (got[k].removed, got[k].added) == (sorted(old - new), sorted(new - old))
        assert got[k].likeness == pytest.approx(plain_likeness(a or "", b or ""), abs=1e-12)


def test_paragraphs_cover_the_text(rows):
    for _, t in rows:
        found = fingerprints.paragraphs(t or "")
        assert "".join(found) == (t or "")
        assert all(len(x.rstrip("\n.!?")) <= fingerprints.LONGEST for x in found)


def test_cells_that_never_clear_are_counted():
    keys, n = fingerprints.paragraph_keys(["a. b. c.", "a. x."])
    keys = np.concatenate([keys[:1], keys[:1], keys])  # one key three times in the first set
    n = n + np.array([2, 0])
    differ, *_ = fingerprints.differences(keys, n, np.array([0]), np.array([1]))
    assert differ.tolist() == [5]
