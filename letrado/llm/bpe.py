"""Byte-level BPE encoding and decoding with a segment tree (operator 8).

A pre-token's bytes are the leaves of a segment tree.  A leaf holds the rank of
the pair that starts at its position together with the position, so a node's
minimum is the leftmost lowest-ranked pair below it.  A merge takes the root,
joins two live neighbours and updates three leaves (the merged position, its
dead right neighbour, its left neighbour), each in O(log n): a pre-token of n
bytes costs O(n log n), also when it is a whole text without a blank.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.llm.pretokens import TokenCache, compiled, latin_tokens


class SegmentTreeBpe:
    def __init__(self, path: str):
        import public_tokenizers
        self.pattern = compiled(public_tokenizers.PATTERN)
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.width = max(self.ranks.values()) + 1
        self.byte_id = [self.ranks[bytes([b])] for b in range(256)]
        get = self.ranks.get
        self.pairs: dict[int, int] = {}              # left * width + right -> joined id
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = rank
        keys = np.fromiter(self.pairs, dtype=np.int64, count=len(self.pairs))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ids = np.fromiter(self.pairs.values(), dtype=np.int64, count=len(keys))[order]
        self.lengths = np.zeros(self.width, dtype=np.int64)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)
        by_id = {rank: token for token, rank in self.ranks.items()}
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(self.width)), dtype=np.uint8)

    def encode_token(self, token: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(token)
        if whole is not None:
            return [whole]
        n = len(token)
        size = 1 << (n - 1).bit_length()
        width, pair = self.width, self.pairs.get
        none = width * size                          # above every rank * size + position
        ids = [self.byte_id[b] for b in token]
        right = list(range(1, n + 1))                # live neighbours; n: none
        left = list(range(-1, n - 1))
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = pair(ids[i] * width + ids[i + 1])
            if r is not None:
                tree[size + i] = r * size + i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b

        def put(at: int, value: int) -> None:
            at += size
            tree[at] = value
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                low = a if a < b else b
                if tree[at] == low:
                    break
                tree[at] = low
                at >>= 1

        while tree[1] < none:
            joined, at = divmod(tree[1], size)
            gone = right[at]
            after = right[gone]
            ids[at] = joined
            right[at] = after
            put(gone, none)
            if after < n:
                left[after] = at
                r = pair(joined * width + ids[after])
                put(at, none if r is None else r * size + at)
            else:
                put(at, none)
            before = left[at]
            if before >= 0:
                r = pair(ids[before] * width + joined)
                put(before, none if r is None else r * size + before)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = right[i]
        return out

    def _pair_ids(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Joined ids of pairs; ``width`` where there is none."""
        q = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, q), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == q, self.pair_ids[at], self.width)

    def _encode_rows(self, tokens: list[bytes], size: int) -> list[bytes]:
        """Ids of pre-tokens of at most ``size`` (a power of two) bytes, as int32 bytes."""
        m = len(tokens)
        none = self.width * size
        lens = np.fromiter(map(len, tokens), dtype=np.int64, count=m)
        cols = np.arange(size)
        real = cols < lens[:, None]
        ids = np.full((m, size + 1), -1, dtype=np.int64)
        ids[:, :size][real] = np.array(self.byte_id)[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        right = np.where(cols + 1 < lens[:, None], cols + 1, size)
        left = np.broadcast_to(cols - 1, (m, size)).copy()
        tree = np.full((m, 2 * size), none)
        r, i = np.nonzero(right < size)
        joined = self._pair_ids(ids[r, i], ids[r, i + 1])
        tree[r, size + i] = np.where(joined < self.width, joined * size + i, none)
        for level in range(size.bit_length() - 2, -1, -1):
            lo = 1 << level
            tree[:, lo:2 * lo] = np.minimum(tree[:, 2 * lo:4 * lo:2], tree[:, 2 * lo + 1:4 * lo:2])
        live = real.copy()
        flat, base_of = tree.reshape(-1), np.arange(m) * 2 * size

        def put(rows, at, value):
            base, node = base_of[rows], size + at
            flat[base + node] = value
            while len(node) and node[0] > 1:
                node = node >> 1
                low = base + 2 * node
                least = np.minimum(flat[low], flat[low + 1])
                changed = flat[base + node] != least        # above an unchanged minimum nothing changes
                node, base = node[changed], base[changed]
                flat[base + node] = least[changed]

        rows = np.arange(m)
        while True:
            root = flat[base_of[rows] + 1]
            rows = rows[root < none]
            if not len(rows):
                break
            joined, at = np.divmod(root[root < none], size)
            gone = right[rows, at]
            after = right[rows, gone]
            ids[rows, at] = joined
            right[rows, at] = after
            live[rows, gone] = False
            put(rows, gone, none)
            pair = self._pair_ids(joined, ids[rows, after])     # ids[:, size] is -1: no pair
            pair = np.where(after < size, pair, self.width)
            put(rows, at, np.where(pair < self.width, pair * size + at, none))
            has = after < size
            left[rows[has], after[has]] = at[has]
            before = left[rows, at]
            has = before >= 0
            if has.any():
                rb, b, j = rows[has], before[has], joined[has]
                pair = self._pair_ids(ids[rb, b], j)
                put(rb, b, np.where(pair < self.width, pair * size + b, none))
        data = ids[:, :size][live].astype("<i4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [data[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]

    def encode_tokens(self, tokens: list[bytes], widest: int = 64, at_once: int = 20_000) -> list[bytes]:
        """Ids of pre-tokens, as int32 bytes each."""
        out: list = [None] * len(tokens)
        by_size: dict[int, list[int]] = {}
        for i, t in enumerate(tokens):
            whole = self.ranks.get(t)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(t) > widest:
                out[i] = np.array(self.encode_token(t), dtype="<i4").tobytes()
            else:
                by_size.setdefault(1 << (len(t) - 1).bit_length(), []).append(i)
        for size, group in by_size.items():
            for k in range(0, len(group), at_once):
                part = group[k:k + at_once]
                for i, ids in zip(part, self._encode_rows([tokens[i] for i in part], size)):
                    out[i] = ids
        return out

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        tokens = latin_tokens(text)
        return self.pattern.findall(text) if tokens is None else tokens

    def encode_distinct(self, tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers."""
        return self.encode_tokens([t.encode() for t in tokens])

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        """Ids of each string as little-endian 32-bit integers."""
        return [b"".join(v) for v in TokenCache(self.cut, self.encode_distinct).lookup(strings)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and the byte length of each id."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.width or not self.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        size = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.bytes[at], size


@lru_cache(maxsize=2)
def _codec(path: str) -> SegmentTreeBpe:
    return SegmentTreeBpe(path)


@lru_cache(maxsize=2)
def _cache(path: str) -> TokenCache:
    return TokenCache(_codec(path).cut, _codec(path).encode_distinct)


def encoder(path: str):
    """Arrow UDF ``text -> array<int>``; null encodes as the empty text."""

    @F.arrow_udf("array<int>")
    def encode(text: pa.Array) -> pa.Array:
        rows = [b"".join(v) for v in _cache(path).lookup([t or "" for t in text.to_pylist()])]
        ends = np.cumsum([0] + [len(r) // 4 for r in rows]).astype(np.int32)
        flat = np.frombuffer(b"".join(rows), dtype="<i4")
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=pa.int32()))

    return encode


def decoder(path: str):
    """Arrow UDF ``array<int> -> binary``; null gives null, an unknown or null id fails."""

    @F.arrow_udf("binary")
    def decode(ids: pa.Array) -> pa.Array:
        flat = ids.flatten()
        if flat.null_count:
            raise ValueError("an id is null")
        data, size = _codec(path).decode(flat.to_numpy(zero_copy_only=False).astype(np.int64))
        lens = np.array([0 if n is None else n for n in ids.value_lengths().to_pylist()], dtype=np.int64)
        cuts = np.r_[0, np.cumsum(lens)]
        ends = np.r_[0, np.cumsum(size)][cuts]
        whole = data.tobytes()
        return pa.array([whole[a:b] if ok else None for a, b, ok in
                         zip(ends[:-1], ends[1:], ids.is_valid().to_pylist())], type=pa.binary())

    return decode


def encode_texts(df: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text_col`` in ``out_col`` (an existing one is replaced).

    Null and empty texts give an empty list.  Row-wise, no shuffle; repeated
    rows and an empty table pass through.
    """
    return df.withColumn(out_col, encoder(path)(F.col(text_col)))


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of ``ids_col`` in ``out_col`` (an existing one is replaced)."""
    return df.withColumn(out_col, decoder(path)(F.col(ids_col)))
