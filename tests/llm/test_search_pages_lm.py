"""Operators 5, 7 and 9."""

import html
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from letrado.llm import elias_fano, html_extract, ngram_lm, vptree
from letrado.llm.common import fold_remainder, prepare
from letrado.session import checkpoint_root

# --- 7 ----------------------------------------------------------------------


def plain_nearest(ids, points, k):
    out = []
    for q in range(len(ids)):
        if ids[q] % 100:
            continue
        near = sorted((vptree.exact_score(points[q], points[i]), ids[i]) for i in range(len(ids)) if ids[i] != ids[q])
        out += [(ids[q], r + 1, i, s) for r, (s, i) in enumerate(near[:k])]
    return out


def test_factor_one_is_exact_and_smaller_factors_look_at_less():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 8)) * 5
    points = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 8)) * 0.3
    ids, queries = np.arange(3000), np.arange(0, 3000, 50)
    all_d = vptree.distances(points[queries][:, None], points[None])
    all_d[np.arange(len(queries)), queries] = np.inf
    want = np.sort(all_d, axis=1)[:, :10]
    tree = vptree.VantageTree(points)
    found, _ = tree.search(points[queries], ids[queries], ids, 10, 1.0)
    exact_looks = tree.looked
    assert np.allclose(found, want) and exact_looks < 0.5 * all_d.size
    loose, _ = tree.search(points[queries], ids[queries], ids, 10, 0.5)
    recall = (loose <= want[:, -1:] * (1 + 1e-9)).mean()
    assert tree.looked < exact_looks and recall >= 0.9


def test_search_over_shards_equals_brute_force(spark):
    prepare(spark)
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    table = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()
    want = plain_nearest([r["vec_id"] for r in table], np.array([r["embedding"] for r in table], dtype=float), 10)
    found = sorted(rows(vptree.nearest(df, F.col("vec_id") % 100 == 0, shard_rows=60, block_rows=2)))
    assert found == sorted(want)


def test_messy_vectors(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]),
            (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]),
            (9, [1.0, 2.0, 3.0]), (200, [5.0, 5.0, 5.0]), (300, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    got = {}
    for q, r, i, s in rows(vptree.nearest(df, F.col("vec_id") % 100 == 0)):
        got.setdefault(q, []).append((r, i, round(s, 6)))
    assert sorted(got[0]) == [(1, 1, 0.0), (2, 2, 0.0), (3, 2, 0.0), (4, 100, 1.414214), (5, 100, 1.414214)]
    assert [i for _, i, _ in sorted(got[100])] == [0, 1, 2, 2] and [i for _, i, _ in sorted(got[200])] == [9]
    assert set(got) == {0, 100, 200}
    assert vptree.nearest(df.where("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


# --- 9 ----------------------------------------------------------------------


def plain_article(source):
    inside = source[source.index("<article>") + 9:source.index("</article>")]
    inside = re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inside))
    return " ".join(html.unescape(inside).split())


def test_pages_give_their_articles(spark):
    prepare(spark)
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    model = html_extract.fit_page_model(pages)
    found = rows(html_extract.extract_text(pages, model).select("html", "text"))
    assert found and all(text == plain_article(source) for source, text in found)
    few = html_extract.fit_page_model(pages, max_pages=3)
    total = dict(model.counts)
    assert all(n <= total[k] for k, n in few.counts)


OTHER = """<html><head><title>t</title><script>if (a < b) "</p>";</script></head><body class="no-sidebar">
<div id="header"><a href=x>Home</a> <a href=y>News</a></div>
<div class=sidebar><p>Popular stories you may like to read today. All of them are long.</p></div>
<main><h1>A &amp; title</h1><p>This is the first long paragraph of a story, with some text in it.
It goes on for a while.<p>Second paragraph with a <a href=z>link</a> and text<b>!</b> Yes.<ul><li>First item here.<li>Second.</ul>
<div class="comments"><p>Great post, I really like what you wrote here. Thanks a lot.</p></div></main>
<form><p>Sign up now. It is free. Really.</p><input><button>Go</button></form><!-- <p>no</p> -->
<footer>(c) 2020 someone. All rights.</footer></body></html>"""


def test_sample_holds_labelled_pages_only(spark):
    prepare(spark)
    pages = [(i, "<html><body><article><p>Some words here.</p></article></body></html>" if i >= 90 else
              "<html><body><div><p>Some words here.</p></div></body></html>") for i in range(100)]
    model = html_extract.fit_page_model(spark.createDataFrame(pages, "page_id long, html string"), max_pages=6)
    assert sum(n for key, n in model.counts if key[0] == "edge" and key[3:] == ("content", 1)) == 6


def test_other_layouts(spark):
    prepare(spark)
    model = html_extract.fit_page_model(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))
    text = html_extract.extract_text(spark.createDataFrame([(OTHER,)], "html string"), model).first().text
    assert text == ("A & title This is the first long paragraph of a story, with some text in it. It goes on for a while. "
                    "Second paragraph with a link and text! Yes. First item here. Second.")


def brute_marginals(page, edges, ratio):
    n = len(page.tag)
    own = [math.prod(ratio.get(p, 1.0) for p in f) for f in page.features()]
    total, on = 0.0, [0.0] * n
    for bits in range(2 ** n):
        y = [bits >> i & 1 for i in range(n)]
        w = 1.0
        for i in range(n):
            p = page.parent[i]
            above, over = (y[p], page.role[p]) if p >= 0 else (0, "neutral")
            w *= edges[above, over, page.role[i]][y[i]] * (own[i] if y[i] else 1.0)
        total += w
        for i in range(n):
            on[i] += w * y[i]
    return [x / total for x in on]


def test_messages_give_exact_marginals():
    pages = [p["html"] for p in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()]
    counts = Counter()
    for p in pages:
        counts.update(html_extract.count_page(p))
    edges, ratio = html_extract.PageModel(tuple(counts.items())).potentials()
    for source in ("<div><p>One.</p><p>Two <a>x</a></p></div><nav><ul><li>a</ul></nav><main><p>Long text. More.</main>",
                   "<article>a<section><p>b</article><footer>c"):
        page = html_extract.Page(source)
        assert np.allclose(html_extract.marginals(page, edges, ratio), brute_marginals(page, edges, ratio))


def test_broken_and_empty_pages(spark):
    prepare(spark)
    data = [(1, None), (2, ""), (3, "<"), (4, "a < b"), (5, "<p"), (6, '<a href="x>abc</a>'), (7, "<!-- never"), (8, "<script>x"),
            (9, "</p></div><article>ok &amp; &#x41;</article>"), (None, "<main>x</main>"), (9, "<" * 50_000), (10, '<a "' * 20_000)]
    df = spark.createDataFrame(data, "page_id long, html string").withColumn("text", F.lit("taken"))
    out = html_extract.extract_text(df, html_extract.fit_page_model(df))
    assert out.columns == df.columns
    found = {(r.page_id, r.html): r.text for r in out.collect()}
    assert found[1, None] == found[2, ""] == found[7, "<!-- never"] == found[8, "<script>x"] == ""
    assert found[9, data[8][1]] == "ok & A"
    empty = df.where("page_id < 0")
    assert html_extract.extract_text(empty, html_extract.fit_page_model(empty)).count() == 0


# --- 5 ----------------------------------------------------------------------


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 9), (1, 1), (5, 3), (1000, 2**64 - 1), (1000, 1000), (5000, 200), (3, 2**63)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        e = elias_fano.EliasFano(elias_fano.EliasFano.to_bytes(values))
        assert (e.get(np.arange(n)) == values).all()
        asked = np.r_[values, rng.integers(0, top, 500, dtype=np.uint64, endpoint=True)]
        at = e.find(asked)
        assert ((at >= 0) == np.isin(asked, values)).all() and (values[at[at >= 0]] == asked[at >= 0]).all()


def test_trie_level_finds_successors_of_their_context_only():
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 300, 5000) * 10**6 + rng.integers(0, 4000, 5000))
    ctx, word = grams // 10**6, grams % 10**6
    level = elias_fano.TrieLevel(ngram_lm.mapped(elias_fano.TrieLevel.to_bytes(ctx, word, word, ctx)))
    assert (level.find(ctx, word) == np.arange(len(grams))).all() and (level.codes == ctx).all()
    other = rng.integers(0, 400, 5000) * 10**6 + rng.integers(0, 5000, 5000)
    assert ((level.find(other // 10**6, other % 10**6) >= 0) == np.isin(other, grams)).all()


def plain_scores(docs, trained, order, strength):
    tokens = [(t or "").encode().lower().split() + [b"\n"] for t in docs]
    counts = [Counter() for _ in range(order + 1)]
    starts = 0
    for words, use in zip(tokens, trained):
        if use:
            starts += 1
            padded = [b"\t"] + words
            counts[1].update(words)
            for k in range(2, order + 1):
                counts[k].update(tuple(padded[i:i + k]) for i in range(len(padded) - k + 1))
    n, v = sum(counts[1].values()), len(counts[1])
    out = []
    for words in tokens:
        padded, base, score = [b"\t"] + words, 0.0, 0.0
        for i, w in enumerate(words):
            p = (counts[1][w] + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(2, order + 1):
                if i + 2 - k < 0:
                    break
                gram = tuple(padded[i + 2 - k:i + 2])
                above = gram[0] if k == 2 else gram[:-1]
                c = starts if above == b"\t" else counts[k - 1][above]
                if not c:
                    break
                p = (counts[k][gram] + strength * p) / (c + strength)
            score += math.log10(p)
        out.append((len(words), sum(counts[1][w] > 0 for w in words), n, base, score))
    return out


def check_scores(found, docs, trained, order, strength):
    for (_, *got), want in zip(sorted(found), plain_scores(docs, trained, order, strength)):
        assert tuple(got[:3]) == want[:3]
        assert math.isclose(got[3], want[3], rel_tol=1e-9)
        assert abs(got[4] - want[4]) <= 1e-4 * want[0]                     # the codes' steps are 12 / 65534 decades


def scored(df, train, rule):
    scores, trie = ngram_lm.score_documents(df, train, rule=rule)
    return rows(scores, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"), trie


def test_scores_equal_the_plain_model(spark):
    prepare(spark)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    local = sorted(rows(df, "doc_id", "text"))
    trained = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in local]
    train = fold_remainder(F.col("doc_id"), 7) != 2
    for order, block in ((2, 4_000_000), (3, 9_000)):
        rule = ngram_lm.LmRule(order=order, block_tokens=block)
        found, trie = scored(df, train, rule)
        check_scores(found, [t for _, t in local], trained, order, rule.strength)
        assert {r.level for r in trie.select("level").collect()} == set(range(1, order + 1))
    held = [i for i, use in enumerate(trained) if not use]
    assert sum(sorted(found)[i][5] for i in held) > sum(sorted(found)[i][4] for i in held)


def test_query_scores_with_five_words(spark):
    from letrado.llm.queries import op5_lm_scoring
    texts = [t for _, t in sorted(rows(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", "text"))]
    found = sorted(rows(op5_lm_scoring(spark, SF_SMALL), "doc_id", "n_tokens", "n_known", "train_tokens", "base_score",
                        "score"))
    trained = [zlib.crc32(str(i).encode()) % 7 != 2 for i, *_ in found]
    assert ngram_lm.LmRule().order == 5
    check_scores(found, texts, trained, 5, ngram_lm.LmRule().strength)


def test_hot_context_is_split():
    ctx, count, word = np.zeros(5000, dtype=np.int64), np.full(5000, 5000), np.arange(5000)
    assert len(np.unique(ngram_lm.shard_of(ctx, count, word, 40, 100))) > 20
    assert len(np.unique(ngram_lm.shard_of(ctx, count, word, 40, 10_000))) == 1


def test_shards_are_numbered_by_tokens_not_by_partitions(spark):
    prepare(spark)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    local = sorted(rows(df, "doc_id", "text"))
    trained = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in local]
    rule = ngram_lm.LmRule(order=3, block_tokens=9_000, shard_tokens=3_000)
    found, trie = scored(df, fold_remainder(F.col("doc_id"), 7) != 2, rule)
    check_scores(found, [t for _, t in local], trained, 3, rule.strength)
    tokens = sum(r[1] for r in found)
    assert tokens // 3_000 > ngram_lm.table_partitions(spark)
    for level in (2, 3):
        sizes = [len(elias_fano.TrieLevel(ngram_lm.mapped(bytes(r.data))).codes) for r in trie.where(f"level = {level}").collect()]
        assert len(sizes) > ngram_lm.table_partitions(spark) and max(sizes) < 3 * 3_000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("letrado_lm_")]


def test_ranked_equals_a_stable_argsort():
    random = np.random.default_rng(5)
    for top in (1, 1000, 2**62):                              # the last are too wide to sort with their places
        keys = random.integers(0, top, 5000)
        order, ascending = ngram_lm.ranked(keys.copy())
        assert (order == np.argsort(keys, kind="stable")).all() and (ascending == np.sort(keys)).all()


def test_many_questions_in_order_equal_single_ones():
    rng = np.random.default_rng(8)
    for n, top in ((0, 10), (1, 1), (5000, 6000), (5000, 2**50)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        level = elias_fano.EliasFano(elias_fano.EliasFano.to_bytes(values))
        assert (level.values() == values).all()
        asked = np.sort(np.r_[values[::3], rng.integers(0, 2 * top, 500).astype(np.uint64)])
        assert (level.find_ascending(asked) == level.find(asked)).all()


def test_one_order_of_the_tokens_holds_the_ngrams_of_all_levels():
    rng = np.random.default_rng(9)
    block = ngram_lm.Block.__new__(ngram_lm.Block)
    block.sizes = np.r_[1, rng.integers(1, 30, 60), 1]
    block.tokens = rng.integers(0, 4, block.sizes.sum()).astype(np.int32)
    texts = [tuple(t) for t in np.split(block.tokens + 1, np.cumsum(block.sizes)[:-1])]
    block.tokens[np.cumsum(block.sizes) - 1] = 4                            # the end, found there only
    grams = [((0, *t[:-1], 5) + (None,) * 5)[i:i + 5] for t in texts for i in range(len(t) + 1)]
    grams = [tuple(x for x in g if x is not None) for g in grams]
    starts, shared = block.sort_starts(5)
    ordered = [grams[i] for i in starts]
    assert ordered == sorted(grams)
    common = [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(ordered, ordered[1:])]
    assert [min(int(c), len(b)) for c, b in zip(shared[1:], ordered[1:])] == common
    assert ngram_lm.left_of(block.sizes, 5).tolist() == [len(g) for g in grams]


def test_blocks_are_kept_in_one_form_only(spark):
    prepare(spark)
    folder = Path(checkpoint_root(spark).removeprefix("file:")) / "letrado"
    before = set(folder.iterdir()) if folder.exists() else set()
    df = spark.createDataFrame([(i, f"a b c {i % 3} d") for i in range(40)], "doc_id long, text string")
    assert scored(df, F.col("doc_id") % 3 != 0, ngram_lm.LmRule(order=3, block_tokens=50))[0]
    names = {p.name.rsplit("-", 1)[0] if p.name.startswith("lm-") else "" for p in set(folder.iterdir()) - before}
    assert not any(n == "lm-blocks" or n.startswith("lm-blocks-") for n in names) and any("lm-answers" in n for n in names)


def test_blocks_are_answered_once_for_all_levels(spark):
    prepare(spark)
    folder = Path(checkpoint_root(spark).removeprefix("file:")) / "letrado"
    before = set(folder.iterdir()) if folder.exists() else set()
    df = spark.createDataFrame([(i, f"a b c {i % 7} d e {i % 3}") for i in range(60)], "doc_id long, text string")
    rule = ngram_lm.LmRule(block_tokens=100, shard_tokens=100)
    found, _ = scored(df, F.col("doc_id") % 3 != 0, rule)
    check_scores(found, [f"a b c {i % 7} d e {i % 3}" for i in range(60)], [i % 3 != 0 for i in range(60)], 5, rule.strength)
    answers = [spark.read.parquet(str(p)) for p in set(folder.iterdir()) - before if p.name.startswith("lm-answers")]
    assert [a.count() for a in answers] == [a.select("block", "shard").distinct().count() for a in answers] != [0]


def test_what_follows_frequent_words_is_split(spark):
    prepare(spark)
    random = np.random.default_rng(11)
    texts = [" ".join(f"one of the {a} {b}" for a, b in random.integers(0, 3000, (40, 2))) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rule = ngram_lm.LmRule(block_tokens=2_000, shard_tokens=1_000)
    found, trie = scored(df, F.col("doc_id") % 4 != 0, rule)
    check_scores(found, texts, [i % 4 != 0 for i in range(100)], 5, rule.strength)
    for level in (4, 5):
        sizes = [len(elias_fano.TrieLevel(ngram_lm.mapped(bytes(r.data))).codes) for r in trie.where(f"level = {level}").collect()]
        assert max(sizes) < 3 * 1_000


def test_a_blocks_messages_take_few_bytes_a_token():
    import tracemalloc
    random = np.random.default_rng(12)
    block, tokens = ngram_lm.Block.__new__(ngram_lm.Block), 400_000
    block.sizes = np.full(tokens // 100, 100)
    block.tokens = np.minimum(random.zipf(1.3, tokens), 30_000).astype(np.int32)
    block.tokens = np.unique(np.r_[0, block.tokens], return_inverse=True)[1][1:].astype(np.int32)
    block.tokens[99::100] = 0
    row = {"block": 1, "train": ngram_lm.pack(np.arange(len(block.sizes)) % 7 > 0), "sizes": ngram_lm.pack(block.sizes),
           "words": ngram_lm.pack(np.ones(int(block.tokens.max()) + 1, dtype=np.int64), np.ones(int(block.tokens.max()) + 1, dtype=np.int64)),
           "starts": ngram_lm.pack(*block.sort_starts(5))}
    none = ngram_lm.beginnings({}, 5)
    tracemalloc.start()
    try:
        sent = ngram_lm.send_grams(none, 0, 4, 4, tokens, ngram_lm.LmRule())(pd.DataFrame([row]))
        assert tracemalloc.get_traced_memory()[1] < 110 * tokens
    finally:
        tracemalloc.stop()
    assert len(sent) == sent["shard"].nunique() <= 4


def test_lm_on_messy_rows(spark, clashing, messy_rows, no_rows):
    keyed = spark.createDataFrame([(i, r[1]) for i, r in enumerate(messy_rows)], "doc_id long, text string")
    rule = ngram_lm.LmRule(order=3, block_tokens=500)
    found, _ = scored(keyed.withColumn("score", F.lit("x")), F.col("doc_id") % 3 != 0, rule)
    check_scores(found, [r[1] for r in messy_rows], [i % 3 != 0 for i in range(len(messy_rows))], 3, rule.strength)
    nothing, _ = scored(keyed, F.lit(None).cast("boolean"), rule)
    assert all(n == 0 and k == 0 and b == s == 0.0 for _, _, k, n, b, s in nothing)
    assert ngram_lm.score_documents(no_rows, F.lit(True))[0].count() == 0
    repeated, _ = ngram_lm.score_documents(clashing, F.col("doc_id") < 100)
    assert Counter(r.doc_id for r in repeated.collect()) == Counter(r[0] for r in messy_rows)


@pytest.mark.parametrize("page", ["<b>" * 150_000 + "</i>" * 150_000, "<b><div></div>" * 70_000, "<div>" * 150_000 + "</p>" * 50_000,
                                  "<p><b>" * 150_000], ids=["unmatched", "blocks in open inlines", "deep", "open paragraphs"])
def test_a_megabyte_of_odd_tags_is_read_in_linear_time(page):
    started = time.process_time()
    html_extract.Page(page)
    whole = time.process_time() - started
    started = time.process_time()
    html_extract.Page(page[:len(page) // 8])
    assert whole < 20 * (time.process_time() - started) + 0.5       # eight times the input, not sixty-four times the work
