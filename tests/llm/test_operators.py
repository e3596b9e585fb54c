"""The ten operators against brute force, round trips and edge cases."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from dockwatch.llm import chat, embedding_dups, jaccard, ngram_lm, packing, pieces, quality, topk, toxicity, urls
from dockwatch.llm import queries
from dockwatch.llm.queries import URL_RULES

DOCS = "doc_id long, text string, score double, cls string, s long"  # with names the operators use inside
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen " * 3


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and long texts, copies, near copies, repeated rows, clashing extra columns."""
    rows = [(1, BASE), (2, BASE), (3, BASE + "more"), (4, "short"), (5, ""), (6, None), (None, BASE), (7, "x " * 30_000),
            (8, "çà et là\n\nder Straße\t🎉 \x00 漢字 <turn>"), (4, "short"), (9, "other words that nobody else here has said before")]
    return spark.createDataFrame([(i, t, 0.5, "c", 3) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def test_pieces_match_the_library_and_decode(spark, odd_docs, no_docs):
    import sentencepiece

    path = packing.tokenizer_path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Model.load(path)
    got = pieces.encode(odd_docs, model)
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == sp.encode(texts[r.doc_id] or "")
    for r in pieces.decode(got, model).collect():
        assert r.text == (texts[r.doc_id] or "")
    assert pieces.encode(no_docs, model).count() == 0


def test_pieces_query_decodes_its_ids(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op1_sentencepiece(spark, str(tmp_path)).collect()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = texts[r.doc_id]
        assert (r.n_ids, r.text_length) == (len(r.ids), len(text))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pieces_shuffle_units_once_and_packed(spark, odd_docs):
    model = pieces.Model.load(packing.tokenizer_path("piece_bpe_32k.model"))
    got = pieces.encode(odd_docs.repartition(3), model, block_bytes=1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(unit" not in plan and "hashpartitioning(block" not in plan
    whole = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(odd_docs, model).collect()}
    assert {(r.doc_id, tuple(r.ids)) for r in got.collect()} == whole and got.count() == odd_docs.count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("pieces_")]


def test_merges_over_arrays_follow_the_heap(spark):
    model = pieces.Model.load(packing.tokenizer_path("piece_bpe_32k.model"))
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("▁aeinrst🎉\x00é"), rng.integers(1, 40))) for _ in range(400)]
    got = pieces.encode_units(spark.createDataFrame([(w,) for w in set(words)], "unit string"), model).collect()
    table = {p: (i, s) for p, i, s in model.pieces}
    assert len(got) == len(set(words))
    for r in got:
        assert r.ids == pieces.encode_unit(r.unit, model, table)


def test_unigram_pieces_take_the_best_path(spark):
    model = pieces.Model([("▁", 1, -3.0), ("a", 2, -2.0), ("b", 3, -2.0), ("ab", 4, -2.5), ("▁a", 5, -3.5), ("ba", 6, -1.0), ("aba", 7, -4.9)],
                         {}, 0, 3, "unigram")
    table = {p: (i, s) for p, i, s in model.pieces}
    words = ["▁abab", "▁a", "▁xab", "▁bbaab", "aba", "▁"]
    got = {r.unit: r.ids for r in pieces.encode_units(spark.createDataFrame([(w,) for w in words], "unit string"), model).collect()}
    assert got == {w: pieces.encode_unit(w, model, table) for w in words}

    def best(w):  # every segmentation
        if not w:
            return 0.0
        return max((table[w[:k]][1] if w[:k] in table else -14.9) + best(w[k:]) for k in range(1, len(w) + 1)
                   if w[:k] in table or k == 1)
    cost = {i: s for _, i, s in model.pieces} | {0: -14.9}
    for w in words:
        assert math.isclose(sum(cost[i] for i in got[w]), best(w))


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 6)).round(1)
    x[30:40] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3, x[3].tolist()), (200, None), (220, [1.0, None] * 3), (240, [math.nan] * 6), (260, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, topk.F.col("vec_id") % 20 == 0, k=7, query_tile=2, shard_rows=9, fan_in=2).collect()
    q = np.floor(64 * x).astype(int)
    for i in range(0, 90, 20):
        order = sorted((-int(q[i] @ q[j]), j) for j in range(90) if j != i)[:7]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])] == [(j, -s) for s, j in order]
    assert {r.query_id for r in got} == {0, 20, 40, 60, 80}
    assert topk.exact_top_k(df.limit(0), topk.F.lit(True)).count() == 0


def test_embedding_links(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + 0.07 * rng.normal(size=(20, 16)) for c in centres] + [rng.normal(size=(100, 16))])
    x[5] = x[4]
    x[6] = 2 * x[4]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [math.inf] * 16), (None, x[4].tolist()), (4, x[4].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dups.near_duplicates(df, leaf_rows=24, block=16).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    m = u @ u.T >= 0.95
    np.fill_diagonal(m, False)
    assert m.any(axis=1).sum() > 50
    found = sum(got[i].n_links for i in range(len(x)))
    assert found >= 0.99 * m.sum() and all(got[i].n_links <= m[i].sum() for i in range(len(x)))
    assert got[6].component_id <= 4 and got[900].n_links == got[901].n_links == got[902].n_links == 0
    assert got[901].kept and len(got) == len(x) + 4
    assert embedding_dups.near_duplicates(df.limit(0)).count() == 0


def _links(texts):
    s = {}
    for i, t in texts.items():
        w = (t or "").split()
        s[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return {i: sum(len(a & s[j]) >= 0.8 * len(a | s[j]) for j in s if j != i and a and s[j]) for i, a in s.items()}


def test_jaccard_links(spark, odd_docs, no_docs):
    got = jaccard.jaccard_links(odd_docs).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    assert {r.doc_id: r.n_links for r in got if r.doc_id is not None} == _links(texts)
    by = {r.doc_id: r for r in got}
    assert by[3].group_id == by[2].group_id == 1 and by[2].class_id == 1 and by[5].kept and by[6].kept
    left = jaccard.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "4", "5", "6", "7", "8", "9", "None"]
    assert jaccard.jaccard_links(no_docs).count() == 0


def test_jaccard_crowd_in_tiles(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(60):
        w = words[:]
        for k in rng.choice(400, rng.integers(0, 12), replace=False):
            w[k] = f"x{i}_{k}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in jaccard.jaccard_links(df, block=8).collect()}
    assert got == _links(texts)


def test_posterior_threshold_grows():
    need = jaccard.needed_matches(0.8, 140)
    assert list(need) == list(range(20, 141, 20))
    assert all(m / k < 0.8 for k, m in need.items()) and need[140] > 80


def test_toxicity(spark, no_docs):
    rng = np.random.default_rng(4)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = list(rng.choice(plain, 40))
        if i % 4 == 0:
            for k in rng.choice(40, 4, replace=False):
                w[k] = "grumblo" + str(rng.choice(["", "s", "ing"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0), 1))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "a")], "doc_id long, text string").withColumn("_x", toxicity.F.lit(1))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, lab, trees=3).collect()}
    assert len(got) == 403 and {r.held_out for r in got.values()} == {True, False}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert sum(got[i].predicted == (i % 4 == 0) for i in range(400)) >= 396
    assert [r.score for r in toxicity.score_documents(docs, lab.limit(0)).collect()] == [0.0] * 403
    assert toxicity.drop_toxic(docs, lab, trees=3).columns == docs.columns
    assert toxicity.score_documents(no_docs, lab).count() == 0


def test_toxicity_sees_disguise():
    find = toxicity.Finder((("idiot", 5.0),))
    assert toxicity.text_features("you 1d!ot there", find)[11] > 0 and toxicity.text_features("an i d i o t", find)[11] > 0
    assert toxicity.text_features("iiidiooot", find)[11] > 0 and toxicity.text_features("idiot, you", find)[5] > 0.5
    assert all(np.isfinite(toxicity.text_features("", find)))


def test_quality(spark, no_docs):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(400):
        w = list(rng.choice([f"wort{k}" for k in "abcdefghijklmnop"], 60))
        rows.append((i, " ".join(x.upper() + "!!" if i % 5 == 0 else x for x in w)))
        labels.append((i, int(i % 5 != 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "a b")], "doc_id long, text string").withColumn("kind", quality.F.lit(1))
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_documents(docs, lab).collect()}
    assert len(got) == 403 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert sum(got[i].predicted == (i % 5 != 0) for i in range(400)) >= 396
    assert [r.score for r in quality.score_documents(docs, lab.limit(0)).collect()] == [1.0] * 403
    assert quality.drop_low_quality(docs, lab).columns == docs.columns
    assert quality.score_documents(no_docs, lab).count() == 0


def test_quality_sample_holds_an_id_once(spark, monkeypatch):
    rows = [(i, f"plain words of text {i}") for i in range(80)]
    docs = spark.createDataFrame(rows + [(j, "AGAIN " * 9) for j in range(80) for _ in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(60)], "doc_id long, quality double")
    sizes = []
    monkeypatch.setattr(quality.PuModel, "fit", lambda p, u, prior: sizes.append((len(p), len(u))))
    quality.fit(docs, labels, rows=20)
    assert sizes and sizes[0][0] <= 20 and sizes[0][1] == 20


def test_backoff_scores(spark, odd_docs, no_docs):
    def brute(docs, corpus, alpha=0.4):
        u, b = Counter(), Counter()
        for w in corpus:
            u.update(w)
            b.update(zip(w, w[1:]))
        n = sum(u.values())
        return {i: sum(math.log(b[p, x] / u[p]) if p and b[p, x] else math.log((alpha if p else 1) * max(u[x], 1) / n)
                       for p, x in zip([None, *w], w)) for i, w in docs.items()}

    rows = odd_docs.where("doc_id is null or doc_id <> 4").collect()
    own = {r.doc_id: (r.text or "").split() for r in rows}
    df = odd_docs.where("doc_id is null or doc_id <> 4")
    want = brute(own, own.values())
    got = {r.doc_id: r for r in ngram_lm.score_documents(df, df, frequent=3, part_grams=50).collect()}
    assert {i: r.n_words for i, r in got.items()} == {i: len(w) for i, w in own.items()}
    assert all(math.isclose(got[i].log_score, want[i], abs_tol=1e-6) for i in own)
    other = {i: w for i, w in own.items() if i in (1, 8, 9)}
    want = brute(own, other.values())
    got = {r.doc_id: r for r in ngram_lm.score_documents(df, df.where("doc_id in (1, 8, 9)"), frequent=2).collect()}
    assert all(math.isclose(got[i].log_score, want[i], abs_tol=1e-6) for i in own)
    assert ngram_lm.score_documents(no_docs, no_docs).count() == 0


def test_frequent_pairs_stay_out_of_the_hash_partitions(spark, monkeypatch):
    texts = ["a b " * 40 + f"w{i} x{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    largest = []
    pack = ngram_lm._pack
    words = df.select("doc_id", ngram_lm.word_hashes("text").alias("words"))
    hot, count = ngram_lm._frequent_pairs(words, None, 8)
    assert sorted(count)[-2:] == [60 * 39, 60 * 40]  # exact: b a, a b
    monkeypatch.setattr(ngram_lm, "_pack", lambda part, *a: largest.append(np.bincount(part).max()) or pack(part, *a))
    batch = words.toArrow().combine_chunks().to_batches()
    assert sum(r.num_rows for r in ngram_lm._count_rows(1, hot)(batch)) <= 1
    assert max(largest) <= 60 * 3
    monkeypatch.undo()
    n, pairs = Counter(" ".join(texts).split()), Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    for r in ngram_lm.score_documents(df, df, frequent=8, part_grams=100).collect():
        w = texts[r.doc_id].split()
        want = math.log(n["a"] / n.total()) + sum(math.log(pairs[p] / n[p[0]]) for p in zip(w, w[1:]))
        assert math.isclose(r.log_score, want, abs_tol=1e-6)
    # frequent in the documents, absent from the corpus
    for r in ngram_lm.score_documents(df, df.selectExpr("doc_id", "'b c' as text"), frequent=2).where("doc_id = 0").collect():
        assert math.isclose(r.log_score, -math.log(120) + 39 * math.log(0.4 / 120) + 40 * math.log(0.4 * 60 / 120)
                            + 2 * math.log(0.4 / 120), abs_tol=1e-6)


def test_documents_are_not_scored_by_their_own_words(spark, odd_docs, no_docs):
    extra = [(100 + i, f"zq{i} zr{i} zs{i} one two three") for i in range(30)] + [(100 + i, BASE) for i in range(5)]
    df = odd_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).cache()
    got = {r.doc_id: r for r in ngram_lm.score_by_folds(df, frequent=5, part_grams=50).collect()}
    assert set(got) == {r.doc_id for r in df.collect()}
    fold = {i: hashlib.md5(str(i if i is not None else -(1 << 63)).encode()).hexdigest()[0] for i in got}
    texts = [(fold[r.doc_id], (r.text or "").split()) for r in df.collect()]
    want, size = dict.fromkeys(got, 0.0), dict.fromkeys(got, 0)
    for r in df.collect():
        rest = [t for f, t in texts if f != fold[r.doc_id]]
        n, pairs = Counter(w for t in rest for w in t), Counter(p for t in rest for p in zip(t, t[1:]))
        t = (r.text or "").split()
        for p in zip([None, *t], t):
            back = (0.4 if p[0] is not None else 1) * max(n[p[1]], 1) / max(n.total(), 1)
            want[r.doc_id] += math.log(pairs[p] / n[p[0]] if pairs[p] else back)
        size[r.doc_id] += len(t)
    assert {i: r.n_words for i, r in got.items()} == size
    assert all(math.isclose(got[i].log_score, want[i], abs_tol=1e-6) for i in got)
    assert got[9].mean_log_score < got[2].mean_log_score  # words nobody else has do not score best
    assert ngram_lm.score_by_folds(no_docs).count() == 0


def test_url_verdicts(spark):
    rows = [(1, "http://a.net/x", '<link rel="canonical" href="http://b.com/de/1">'),
            (2, "http://c.net/y", '<meta http-equiv="refresh" content="0; url=/x2">'),
            (3, "http://c.net/x2", "<link href='http://a.net/x#z' rel='canonical'>"), (4, "http://q.org/x", ""), (5, None, None),
            (6, "nohost", ""), (7, "HTTP://A.B.Example.ORG?x", None), (8, "http://b.com/de/1?q", "<p>"), (8, "http://b.com/de/1?q", "<p>"),
            (9, "http://d.net/1", '<LINK REL=canonical HREF=http://e.net/1>'), (10, "http://e.net/1", '<link rel="canonical" href="http://b.com/de/9">'),
            (11, "http://q.org/free", '<link rel="canonical" href="http://e.net/2">'), (12, "http://e.net/2", '<link rel="canonical" href="http://b.com/de/7">'),
            (13, "https://www.example.org/en/12", None), (14, "https://notexample.org/en/12", None)]
    df = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, html string, verdict string")
    got = [tuple(r) for r in urls.judge_urls(df, urls.rules_frame(spark, URL_RULES)).orderBy("page_id").collect()]
    verdict = {r[0]: r[4] for r in got}
    assert [verdict[i] for i in (1, 2, 3, 9, 10)] == ["block"] * 5  # aliases of a blocked page, over several links
    assert verdict[12] == "allow"  # an explicitly allowed alias goes first
    assert (7, "a.b.example.org", "", None, "allow") in got and (13, "www.example.org", "/en/12", "example.org/en/1", "block") in got
    assert (14, "notexample.org", "/en/12", "org/", "allow") in got and (5, "", "", None, "allow") in got and len(got) == 15
    assert urls.judge_urls(df.limit(0), urls.rules_frame(spark, URL_RULES)).count() == 0


def test_packing(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack_documents(odd_docs, path, limit=256).collect()
    texts = odd_docs.collect()
    assert sum(r.length for r in rows) == sum(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in texts)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        ends = 0
        for o, n in sorted(parts):
            assert o == ends
            ends += n
        assert ends <= 256
    assert packing.pack_documents(no_docs, path).count() == 0


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 101, 500)
    bins, offsets = packing.best_fit_decreasing(lengths, 100)
    room, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in room if r >= lengths[i]]
        want[int(i)] = min(fits) if fits else 100
        if fits:
            room.remove(min(fits))
        room.append(want[int(i)] - lengths[i])
    assert all(100 - offsets[i] == want[i] for i in want) and bins.max() + 1 == len(room)


def test_chat_tree(spark):
    hard = "\\### Assistant: </turn> ok <turn> \\l \\\\"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "b"), (2, 0, "user", "hi"), (2, 1, "assistant", "c"),
            (3, 0, "user", "hi"), (3, 1, "assistant", "a"), (4, 0, "user", hard), (4, 1, "assistant", hard), (5, 0, None, None),
            (None, 0, "user", "x"), (6, 0, "us\ner", "t"), (6, 0, "us\ner", "t")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, start long")
    tree, paths = chat.prefix_tree(df, lambda: packing.tokenizer_path("byte_bpe_50k.json"))
    nodes = {r.node: r for r in tree.collect()}
    assert len(nodes) == 10  # three conversations share the first turn, two of them the second
    line = sorted(nodes.values(), key=lambda r: r.start)
    assert line[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(line, line[1:]))
    for r in line:  # a node attends to its ancestors and itself, at positions that go on from the parent's
        seen, at = set(), r
        while at:
            seen |= set(range(at.start, at.start + at.length))
            at = nodes.get(at.parent)
        assert {i for a in r.attends for i in range(a.start, a.stop)} == seen
        assert r.position == len(seen) - r.length and len(r.token_ids) == r.length
    got = {r.conv_id: r for r in chat.read_back(tree, paths).collect()}
    for c in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == c]
        said = "".join(t for r, t in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[c].loss_chars == len(said) and got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.read_back(*chat.prefix_tree(df.limit(0), lambda: packing.tokenizer_path("byte_bpe_50k.json"))).count() == 0
