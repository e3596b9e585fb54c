"""URL aliases against brute force, and columns and ids that used to clash."""

from __future__ import annotations

import random
from urllib.parse import urljoin, urlsplit

import pytest

import corpus_pipeline as P
from dockwatch.llm import jaccard, packing, quality, toxicity, urls
from dockwatch.llm.queries import URL_RULES
from dockwatch.llm.shared import read_table

SF = "/root/testdata/sf0.001"


def judge(spark, rows):
    df = spark.createDataFrame([(*r, "v") for r in rows], "page_id long, url string, html string, host string")
    return {r.page_id: r for r in urls.judge_urls(df, urls.rules_frame(spark, URL_RULES)).collect()}


def test_rules_read_the_whole_url_and_links_all_forms(spark):
    got = judge(spark, [
        (1, "a#http://example.org/es/1", None), (2, "http://a.net/1", '<link rel="nofollow canonical" href="http://B.com/de/1">'),
        (3, "http://a.net/2", "<link rel=canonical href='http://x.net/q'><link rel='canonical' href='http://b.com/x/../de/2'>"),
        (4, "http://a.net/d/3", '<link rel="canonical" href="../2">'), (5, "http://A.NET/2#part", ""), (6, "http://a.net/4", '<link rel="canonicalish" href="http://b.com/de/1">'),
        (7, "http://a.net/5?x=1", '<meta http-equiv=refresh content="1;url=?x=2">'), (8, "http://a.net/5?x=2", '<link rel=canonical href="//b.com/./de/">'),
        (9, "http://a.net/6", '<link rel=canonical href="#top">'), (10, "HTTP://b.com", '<link rel=canonical href="http://z.net/' + "y" * 5000 + '">')])
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("example.org", "/es/1", "example.org/es/", "block")
    assert {i: got[i].verdict for i in range(2, 11)} == {2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "block",
                                                         8: "block", 9: "allow", 10: "allow"}


def test_components_on_a_generated_graph_equal_brute_force(spark):
    rnd = random.Random(12)
    hosts = ["a.net", "b.net", "c.net", "d.com", "example.org", "q.org"]
    paths = ["/1", "/2", "/3", "/x/4", "/de/5", "/es/6", "/fr/7", "/en/1"]
    rows = []
    for i in range(150):
        links = [rnd.choice([f"http://{rnd.choice(hosts)}{rnd.choice(paths)}?k={rnd.randint(0, 60)}", rnd.choice(paths[:3]),
                             "../" + rnd.choice(paths)[1:], f"http://d.com/de/5?k={rnd.randint(0, 60)}"])
                 for _ in range(rnd.choice([0, 0, 1, 2]))]
        html = "".join(f'<link rel="canonical" href="{x}">' if rnd.random() < .5 else f'<meta http-equiv="refresh" content="0; url={x}">' for x in links)
        rows.append((i, f"http://{rnd.choice(hosts)}{rnd.choice(paths)}?k={rnd.randint(0, 60)}", html, links))

    def rule(url):
        u = urlsplit(url)
        fit = [(len(h + p), v) for h, p, v in URL_RULES if (u.netloc == h or u.netloc.endswith("." + h)) and u.path.startswith(p)]
        return max(fit)[1] if fit else None

    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for _, url, _, links in rows:
        for x in links:
            a, b = find(url), find(urljoin(url, x))
            parent[max(a, b)] = min(a, b)
    tones = {}
    for x in list(parent):
        tones.setdefault(find(x), set()).add(rule(x))
    want = {i: rule(u) or ("block" if u in parent and "block" in tones[find(u)] and "allow" not in tones[find(u)] else "allow") for i, u, _, _ in rows}
    got = judge(spark, [r[:3] for r in rows])
    assert {i: r.verdict for i, r in got.items()} == want
    assert sum(want[i] == "block" and not rule(u) for i, u, _, _ in rows) >= 5


ODD = "doc_id long, text string, _tox_score double, _quality_score string, _llm_features int, _llm_text string, row int, part string"


def test_stages_take_columns_named_like_their_own(spark):
    labels = read_table(spark, SF, "labels")
    docs = read_table(spark, SF, "documents").select("doc_id", "text").limit(60).collect()
    rows = [(r.doc_id, r.text, 1.0, "q", 2, "t", 3, "p") for r in docs]
    rows += [(None, "text without an id", 1.0, "q", 2, "t", 3, "p"), (10**6, None, 1.0, "q", 2, "t", 3, "p"), (10**6 + 1, "", 1.0, "q", 2, "t", 3, "p"),
             (10**6 + 2, "long " * 40_000, 1.0, "q", 2, "t", 3, "p"), rows[0]]
    df = spark.createDataFrame(rows, ODD)
    for drop in (toxicity.drop_toxic, quality.drop_low_quality):
        out = drop(df, labels)
        assert out.columns == df.columns
        kept = out.collect()
        assert set(map(tuple, kept)) <= set(rows) and len(kept) > 20
        assert drop(df.limit(0), labels).count() == 0


BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"


def test_near_duplicates_go_by_text_where_an_id_repeats(spark):
    rows = [(1, BASE, 0), (2, BASE, 1), (2, "other words of the second document that nobody else says at all", 2), (3, BASE + " more", 3),
            (4, None, 4), (4, BASE, 5), (5, "", 6), (None, BASE, 7), (None, BASE, 8), (2, "other words of the second document that nobody else says at all", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, cls int")
    out = jaccard.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[6], rows[7], rows[8]], key=str)
    assert jaccard.drop_near_duplicates(df.limit(0)).count() == 0


def test_packed_pieces_are_the_tokenizers_ids(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    path = packing.tokenizer_path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = read_table(spark, SF, "documents")
    rows = packing.pack_documents(docs, path, limit=512).collect()
    want = set()
    for r in docs.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want |= {(r.doc_id, k, s, len(ids[s:s + 512]), zlib.crc32(ids[s:s + 512].tobytes())) for k, s in enumerate(range(0, len(ids), 512))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.03 * -(-total // 512) + 1


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_takes_odd_documents(spark, empty):
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [] if empty else [(1, None, None, None, None), (2, "", "en", "s", 0), (None, BASE, "en", "s", 5), (3, BASE, "en", "s", 5), (3, BASE, "en", "s", 5),
                             (4, "word " * 60_000, None, "s", 5), (5, BASE, "en", "s", 5)]
    df = spark.createDataFrame(rows, cols)
    for _, stage in P.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == [c.split()[0] for c in cols.split(", ")]
    P.STAGES[-1][1](spark, df, SF).collect()
