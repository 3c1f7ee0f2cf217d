"""Token counts by rank-synchronous merging of ragged arrays (operator 4).

Pre-tokens of a batch are held as one flat symbol array with row numbers.  In
each round every row finds its lowest-rank adjacent pair and replaces all its
occurrences at once; rows without a mergeable pair leave the array.  The
symbols that survive are the tokens.  Merging all occurrences at once equals
merging them one by one because a merge only creates pairs of a higher rank:
each merge's parts are made by earlier merges (checked when the file is read).
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.llm.pretokens import TokenCache, compiled, latin_tokens

NO_PAIR = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class RankMerger:
    """Counts the tokens of byte sequences with the merges of a BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError(f"not a byte-level BPE file without prefix space: {path}")
        import public_tokenizers
        self.pattern = compiled(public_tokenizers.PATTERN)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_split = compiled("(" + "|".join(sorted(map(_escape, self.special), key=len, reverse=True)) + ")") \
            if self.special else None
        vocab = model["vocab"]
        self.size = len(vocab) + len(self.special) + 1
        self.byte_id = np.array([vocab[c] for c in byte_letters()], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        made_at = np.full(self.size, -1, dtype=np.int64)
        made_at[self.made[::-1]] = np.arange(len(merges))[::-1]
        at = np.arange(len(merges))
        if (made_at[left] >= at).any() or (made_at[right] >= at).any():
            raise ValueError("a merge precedes the merges that make its parts")
        key = left * self.size + right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        q = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, q), len(self.keys) - 1)
        return np.where(self.keys[at] == q, self.order[at], NO_PAIR)

    def count(self, rows: list[bytes]) -> np.ndarray:
        """Tokens of each byte sequence."""
        lens = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        out = lens.copy()
        sym = self.byte_id[np.frombuffer(b"".join(rows), dtype=np.uint8)]
        row = np.repeat(np.arange(len(rows)), lens)
        if len(sym) < 2:
            return out
        rank = np.full(len(sym), NO_PAIR)            # of the pair that starts here
        inside = np.flatnonzero(row[:-1] == row[1:])
        rank[inside] = self.ranks(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            size = np.diff(np.r_[starts, len(sym)])
            low = np.minimum.reduceat(rank, starts)
            done = low == NO_PAIR
            if done.any():
                out[row[starts[done]]] = size[done]
                stay = np.repeat(~done, size)
                sym, row, rank = sym[stay], row[stay], rank[stay]
                low, size = low[~done], size[~done]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            # a run of hits is one symbol repeated: merge every second pair of it
            begins = np.r_[True, np.diff(hit) != 1]
            first = np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), dtype=bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            sym, row, rank = sym[keep], row[keep], rank[keep]
            hit = place[hit]
            touched = np.unique(np.r_[hit, hit[hit > 0] - 1])
            end = (touched + 1 >= len(sym)) | (row[touched] != row[np.minimum(touched + 1, len(sym) - 1)])
            rank[touched[end]] = NO_PAIR
            touched = touched[~end]
            rank[touched] = self.ranks(sym[touched], sym[touched + 1])
        return out

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text; a special string is one of its own."""
        parts = [text]
        if any(x in text for x in self.special):
            parts = self.special_split.split(text)
        out: list[str] = []
        for i, part in enumerate(parts):
            tokens = [part] if i % 2 else latin_tokens(part)
            out += self.pattern.findall(part) if tokens is None else tokens
        return out

    def count_distinct(self, tokens: list[str]) -> list[int]:
        """Tokens of each pre-token; special strings count as one."""
        counts = self.count([t.encode() for t in tokens])
        return [1 if t in self.special else n for t, n in zip(tokens, counts.tolist())]

    def count_strings(self, strings: list[str]) -> list[int]:
        """Tokens of each string."""
        return [sum(v) for v in TokenCache(self.cut, self.count_distinct).lookup(strings)]


def _escape(s: str) -> str:
    import regex
    return regex.escape(s)


@lru_cache(maxsize=2)
def _cache(path: str) -> TokenCache:
    merger = RankMerger(path)
    return TokenCache(merger.cut, merger.count_distinct)


def token_counter(path: str):
    """An Arrow UDF ``text -> tokens`` for the vocabulary file at ``path``."""

    @F.arrow_udf("bigint")
    def count(text: pa.Array) -> pa.Array:
        values = _cache(path).lookup([t or "" for t in text.to_pylist()])
        return pa.array([sum(v) for v in values], type=pa.int64())

    return count


def count_tokens(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``df`` with the token count of ``text_col`` in ``out_col``.

    A null text counts as empty (0 tokens); an existing ``out_col`` is
    replaced; repeated rows keep their own counts; an empty table stays empty.
    Row-wise, no shuffle.  ``path`` must be readable on every executor.
    """
    return df.withColumn(out_col, token_counter(path)(F.col(text_col)))
