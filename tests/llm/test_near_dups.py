"""Operator 10 and the component search."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from letrado.llm import components, simhash
from letrado.llm.common import prepare


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, max_bits):
    """Least position reachable, by comparing all pairs."""
    x = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= max_bits
    low = np.arange(len(x))
    while True:
        new = np.array([low[near[i]].min() for i in range(len(x))])
        if (new == low).all():
            return low
        low = new


def test_fingerprints_equal_the_plain_ones(spark, messy_rows):
    for _, t, *_ in messy_rows:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("One two") == xxhash.xxh64_intdigest(b"one two", 42)
    spark_hash = spark.sql("select xxhash64('one two three') as h").first().h
    assert simhash.fingerprint("one TWO  three") == spark_hash % 2**64


def cloud(seed, n):
    """Fingerprints around a few centres, chains of one-bit steps, and strays."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    out = []
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    x = rng.getrandbits(64)
    for i in range(10):
        x ^= 0b11 << (2 * i)
        out.append(x)
    return list(dict.fromkeys(out + [rng.getrandbits(64) for _ in range(50)]))


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_bucket_links_equal_all_pairs():
    prints = cloud(1, 300)
    want = plain_components(prints, 2)
    links = simhash.bucket_links(np.array([signed(p) for p in prints], dtype=np.int64))
    root = {signed(p): signed(p) for p in prints}
    for a, b in zip(*(side.tolist() for side in links)):
        root[a] = b
    groups = {}
    for p, w in zip(prints, want):
        groups.setdefault(int(w), set()).add(root[signed(p)])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_links_in_small_and_oversize_buckets(spark):
    prepare(spark)
    prints = cloud(2, 250)
    for max_bits in (1, 2):
        want = plain_components(prints, max_bits)
        for limit in (4096, 3):                                # 3: nearly all buckets go the oversize way
            df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
            found = dict(rows(simhash.component_roots(df, max_bits, limit)))
            same = {}
            for p, w in zip(prints, want):
                same.setdefault(int(w), set()).add(found.get(signed(p), signed(p)))
            assert all(len(g) == 1 for g in same.values()), (max_bits, limit)
            assert len({next(iter(g)) for g in same.values()}) == len(same)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)]
    found = dict(rows(components.connected_roots(spark.createDataFrame(chain + star + [(5, 5)], "a long, b long"))))
    assert found == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(8, 60)}}
    assert components.connected_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    local = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    prints = [plain_fingerprint(t) for _, t in local]
    for (i, _), p, low in zip(local, prints, plain_components(prints, 2)):
        assert found[i].fingerprint % 2**64 == p and found[i].component_id == local[low][0]


def test_messy_rows(clashing, messy_rows, no_rows):
    found = simhash.near_duplicates(clashing).collect()
    assert len(found) == len(messy_rows)
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id[10] == 0 and by_id[13] == by_id[14] == by_id[15] == 13      # copies; texts without words
    assert by_id[18] == 2
    kept = simhash.keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted({c for c in by_id.values() if c is not None})
    assert simhash.near_duplicates(no_rows).count() == simhash.keep_one_of_each(no_rows).count() == 0


def test_repeated_ids_leave_one_row(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (None, "q r s t u")],
                               "doc_id long, text string")
    assert sorted(rows(simhash.keep_one_of_each(df)), key=str) == [(1, "a b c d"), (None, "q r s t u")]


def test_group_that_holds_a_third_of_all_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same few words"))
                                  .otherwise(F.concat_ws(" ", F.lit("text"), F.sha2(F.col("id").cast("string"), 256),
                                                         F.md5(F.col("id").cast("string")))).alias("text"))
    found = simhash.near_duplicates(df)
    assert found.where("component_id = 0").count() == 1000
    assert simhash.keep_one_of_each(df).where("text = 'the same few words'").count() == 1
