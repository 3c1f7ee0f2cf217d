"""Operators 2, 4 and 8 against the libraries and against the rules of packing."""

import base64
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from letrado.llm import bpe, packing, pretokens, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def rank_library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=1500):
    rng = random.Random(3)
    bits = [" ", " ", "\n", "a", "the", "'s", "'", "1", "é", "ß", "\xa0", "\x1c", "\x85", "😀", "中", "\t", "!", "$$",
            "<|endoftext|>", " ", "\r"]
    texts = ["", " ", "  a  b ", "a" * 3000, "it's we'll", "\n\n a\n b\t\tc  ", "aaaaaaa" * 40]
    return texts + ["".join(rng.choice(bits + [chr(rng.randrange(32, 0x2FFF))]) for _ in range(rng.randrange(25)))
                    for _ in range(n)]


def test_pieces_rejoin_to_the_text():
    for t in odd_texts():
        assert " ".join(pretokens.split_pieces(t)) == t or not t


def test_latin_texts_are_cut_as_by_the_public_pattern():
    rng = random.Random(9)
    latin = [chr(c) for c in range(pretokens.LATIN_END)]
    pattern = pretokens.compiled(public_tokenizers.PATTERN)
    texts = ["".join(rng.choice(latin if rng.random() < 0.5 else " '  \nstrevldé1½") for _ in range(rng.randrange(40))) for _ in range(5000)]
    for t in texts + odd_texts():
        cut = pretokens.latin_tokens(t)
        assert cut is None if any(ord(c) >= pretokens.LATIN_END for c in t) else cut == pattern.findall(t)


def test_counts_equal_the_library(library):
    texts = odd_texts()
    merger = token_counts.RankMerger(JSON)
    cache = pretokens.TokenCache(merger.cut, merger.count_distinct, limit=5000)
    found = [sum(v) for k in range(0, len(texts), 100) for v in cache.lookup(texts[k:k + 100])]
    assert found == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packed_ids_equal_the_library(library):
    texts = odd_texts() + [" ".join(f"word{i}<|endoftext|>x" if i % 7 == 0 else f"w{i}," for i in range(900))]
    texts += ["".join(map(chr, range(32, pretokens.LATIN_END))), "x" * 5000, "\n" * 3000 + "end", "ÀÉ ñandú's 12½ ²³ a\u00a0b\x85c\x1cd"]
    found = [np.frombuffer(b"".join(v), "<u4").tolist() for v in packing._ids(JSON)(texts)]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_latin_texts_are_encoded_by_ranks_as_by_the_library(library):
    rng = random.Random(10)
    latin = [chr(c) for c in range(pretokens.LATIN_END)]
    texts = ["".join(rng.choice(latin if rng.random() < 0.3 else " '  \nstrevldé1½") for _ in range(rng.randrange(60))) for _ in range(4000)]
    fast = packing.rank_encoding(JSON)
    assert [fast.encode_ordinary(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_text_without_a_blank(library, rank_library):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    assert token_counts.RankMerger(JSON).count_strings([text]) == [len(library.encode(text).ids)]
    codec = bpe.SegmentTreeBpe(RANKS)
    assert np.frombuffer(codec.encode_strings([text])[0], "<i4").tolist() == rank_library.encode_ordinary(text)


def test_ids_equal_the_library_and_decode_back(rank_library):
    codec = bpe.SegmentTreeBpe(RANKS)
    texts = odd_texts()
    for text, values in zip(texts, pretokens.TokenCache(codec.cut, codec.encode_distinct).lookup(texts)):
        ids = np.frombuffer(b"".join(values), "<i4")
        assert ids.tolist() == rank_library.encode_ordinary(text)
        assert codec.decode(ids.astype(np.int64))[0].tobytes() == text.encode()


def test_one_by_one_merges_equal_merges_side_by_side():
    codec = bpe.SegmentTreeBpe(RANKS)
    rng = random.Random(2)
    tokens = [bytes(rng.randrange(256) for _ in range(rng.randrange(2, 60))) for _ in range(300)]
    for one, many in zip(map(codec.encode_token, tokens), codec.encode_tokens(tokens)):
        assert one == np.frombuffer(many, "<i4").tolist()


def test_a_long_text_without_a_blank_does_not_stay_in_a_worker():
    cache = pretokens.PieceCache(lambda pieces: [p.encode() * 4 for p in pieces], limit=4 << 20)
    long = "x" * (10 << 20)
    assert cache.lookup([long, "a " + long, "a b"])[1][1] == (" " + long).encode() * 4
    kept = [k for c in (cache.first, cache.inner) for k in c.held]
    assert sorted(kept) == ["a", "b"]
    for n in range(30):                        # many batches of new pieces, one frequent one
        cache.lookup([" ".join(f"piece{n}-{i}" for i in range(2000)) + " often"])
        assert all(c.size <= c.limit for c in (cache.first, cache.inner))
        assert cache.inner.size == cache.inner._bytes(list(cache.inner.held))
        assert cache.inner.size >= sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in cache.inner.held.items())
    assert "often" in cache.inner.held


def test_unknown_ids_fail():
    codec = bpe.SegmentTreeBpe(RANKS)
    with pytest.raises(ValueError):
        codec.decode(np.array([-1]))
    with pytest.raises(ValueError):
        codec.decode(np.array([codec.width]))


def test_columns_on_messy_rows(clashing, messy_rows, no_rows, library, rank_library):
    counted = token_counts.count_tokens(clashing, JSON)
    assert sorted(counted.columns) == sorted(clashing.columns)            # n_tokens is replaced
    want = Counter((i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in messy_rows)
    assert Counter((r.doc_id, r.n_tokens) for r in counted.collect()) == want
    both = bpe.decode_ids(bpe.encode_texts(clashing, RANKS), RANKS).select("doc_id", "text", "ids", "decoded").collect()
    assert len(both) == len(messy_rows)
    for r in both:
        assert r.ids == rank_library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert token_counts.count_tokens(no_rows, JSON).count() == 0
    assert bpe.decode_ids(bpe.encode_texts(no_rows, RANKS), RANKS).count() == 0


def test_null_ids_decode_to_null(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "k long, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode_ids(df, RANKS).collect()} == {1: None, 2: b""}


def test_packs_hold_every_piece_of_the_histogram():
    rng = random.Random(4)
    histogram = {n: rng.randrange(0, 40) for n in range(1, 65)}
    patterns = packing.shortest_pack_first(histogram, 64)
    used = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= 64 and list(lengths) == sorted(lengths, reverse=True)
        for n in lengths:
            used[n] += count
    assert used == Counter({k: v for k, v in histogram.items() if v})
    assert len(patterns) <= 3 * 64


@pytest.mark.parametrize("lengths", [[150], [300], [600, 601, 602], [513], list(range(1, 1024)), [1000, 30], [7, 1024]])
def test_little_padding_whatever_the_lengths(lengths):
    rng = random.Random(6)
    sizes = [rng.choice(lengths) for _ in range(4000)]
    cut = [n for s in sizes for n in ((512, s - 512) if 512 < s < 1024 else (s,))]        # as cut_pieces does
    patterns = packing.shortest_pack_first(Counter(cut), 1024)
    padding = sum(c * (1024 - sum(p)) for c, p in patterns)
    alone = 1024 % lengths[0] / 1024 if len(lengths) == 1 and lengths[0] <= 512 else 0    # nothing else to fill with
    assert padding <= (alone + 0.01) * (padding + sum(sizes))


def check_packing(rows, want_ids, max_length):
    """Brute force: every id in one piece, offsets gapless, sequences not too long."""
    tokens = Counter()
    sequences = {}
    for r in rows:
        options = want_ids[r.doc_id]
        assert any(len(ids) == r.doc_tokens and r.start + r.length <= len(ids)
                   and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for ids in options)
        tokens[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert tokens == Counter({i: sum(map(len, o)) for i, o in want_ids.items()})
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= max_length


def test_packing_messy_rows(clashing, messy_rows, no_rows, library):
    rows = packing.pack(clashing, JSON, max_length=256, keep_cache=False).collect()
    want = {}
    for i, t, *_ in messy_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, []).append(np.array(ids, dtype="<u4"))
    check_packing(rows, want, 256)
    assert packing.pack(no_rows, JSON).count() == 0


def test_one_length_shared_by_all(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same words here").alias("text")).repartition(7)
    rows = packing.pack(df, JSON, max_length=64).collect()
    places = {(r.sequence_id, r.offset) for r in rows}
    assert len(rows) == len(places) == 3000
