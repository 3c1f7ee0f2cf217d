"""Language-model scoring with an Elias-Fano n-gram trie (operator 5).

The corpus is cut into blocks of documents, and the trie into shards.  A block
sorts its tokens once, so that the n-grams of every length are runs of one order.
It sends its distinct n-grams of all lengths with their training counts to the
shards, as a tree a shard.  All that begin with a word go to one shard, so that it
counts contexts and what follows them by itself; where they are too many, all that
begin with that word and the next one do, and so on.  A shard adds the counts up,
writes its part of each trie level, maps it into memory and answers every block
from it: a quantised smoothed probability and a count per n-gram.  A block then
scores its documents from the answers.

* Nothing whole passes the driver, a task or a group: a block and a shard bound
  the memory.  There is a block per ``block_tokens`` and at least a shard per
  ``shard_tokens`` tokens, so neither grows with the corpus.  The driver holds the
  beginnings that are split, at most 8 a shard of each length.
* What moves is one packed tree per (block, shard), once there and once back, not
  a row per n-gram.
* Tokens are written once per block as small integers and once more sorted, when
  the first form goes.  The shards are sent to and answered in ``parts``; what is
  answered is written before the next part begins, so a lost executor repeats one
  step and the shuffles of a finished part can go.  A shard builds its trie to
  answer from it; the tries of the n-gram levels are computed again for whoever
  reads them.

The probability interpolates the levels with a Dirichlet prior of ``strength``
imagined tokens: p_k(w | h) = (c(h w) + strength * p_(k-1)(w | h')) / (c(h) + strength),
over p_1(w) = (c(w) + 1) / (N + V + 1).  The trie holds the part
c(h w) / (c(h) + strength) as a 16-bit code on a logarithmic scale.
"""

from __future__ import annotations

import mmap
import tempfile
import uuid
from collections import defaultdict
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letrado.llm.common import drop_shuffles, keep_freed_memory, release_memory, table_partitions
from letrado.llm.elias_fano import EliasFano, TrieLevel
from letrado.session import materialize, remove_folder, scratch_path

END = b"\n"                                                   # no word holds a gap
BEGIN_ID = 0                                                  # ids of words and n-grams start at 1
STEPS, DECADES = 65_534, 12.0                                 # codes 1 .. STEPS + 1 for 10**-12 .. 1
WORD_KEYS = 2**16                                             # a word's shard is its remainder by this, then by the shards
CHUNK = "level int, shard long, block long, kind string, data binary, total long, kinds long"


@dataclass(frozen=True)
class LmRule:
    """Production values: order of the model, prior strength, tokens of a block, most tokens for each shard, parts of
    the shards that are sent to and answered one after the other (what is sent lies on disk for one part only)."""

    order: int = 5
    strength: float = 100.0
    block_tokens: int = 2_000_000
    shard_tokens: int = 1_000_000
    parts: int = 2


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, each in its least width, its bytes grouped by place, compressed."""
    head, parts = [len(arrays)], []
    for a in arrays:
        a = np.asarray(a)
        top = int(a.max()) if len(a) else 0
        width = 1 if top < 2**8 else 2 if top < 2**16 else 4 if top < 2**32 else 8
        head += [width, len(a)]
        a = a.astype(f"<u{width}")
        parts.append(a.tobytes() if width == 1 else a.view(np.uint8).reshape(-1, width).T.tobytes())
    body = np.array(head, dtype=np.int64).tobytes() + b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpack(data: bytes, wide: bool = True) -> list[np.ndarray]:
    """What pack() got, as 64-bit numbers or, not ``wide``, in the width of each array."""
    body = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    head = np.frombuffer(body, np.int64, 2 * n, 8).tolist()
    at, out = 8 * (2 * n + 1), []
    for width, size in zip(head[::2], head[1::2]):
        planes = np.frombuffer(body, np.uint8, size * width, at).reshape(width, size)
        a = planes[0] if width == 1 else np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(size)
        out.append(a.astype(np.uint64 if width == 8 and len(a) and a.max() >= 2**63 else np.int64) if wide else a)
        at += width * size
    return out


def narrow(a: np.ndarray) -> np.ndarray:
    """Non-negative integers in the least width."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def steps_of(ascending: np.ndarray) -> np.ndarray:
    return np.diff(ascending, prepend=ascending.dtype.type(0)) if len(ascending) else ascending


def steps_within(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences along each run of ascending values; a run's first value as it is."""
    out = np.diff(values, prepend=0)
    out[starts] = values[starts]
    return out


def sums_within(steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The inverse of steps_within, from the lengths of the runs."""
    total = np.cumsum(steps)
    starts = np.cumsum(lengths) - lengths
    return total - np.repeat(total[starts] - steps[starts], lengths)


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, ascending keys) of non-negative int64 numbers, equal ones in their order; ``keys`` is overwritten.
    A key and its place are sorted as one number where both fit: several times faster than an argsort."""
    bits = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + bits <= 63:
        keys <<= bits
        keys |= np.arange(len(keys))
        keys.sort()
        order = (keys & ((1 << bits) - 1)).astype(np.int32 if bits < 32 else np.int64)
        keys >>= bits
        return order, keys
    order = np.argsort(keys, kind="stable")
    return order, keys[order]


def first_of_runs(ascending: np.ndarray) -> np.ndarray:
    new = np.ones(len(ascending), dtype=bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return new


def by_shard(shard: np.ndarray, shards: int) -> np.ndarray:
    """The stable order of shards (two bytes and less are sorted by counting)."""
    return np.argsort(shard.astype(np.uint16) if shards <= 2**16 else shard, kind="stable")


def encode_probability(p: np.ndarray) -> np.ndarray:
    """1 .. STEPS + 1, evenly on the logarithmic scale."""
    place = 1.0 + np.maximum(np.log10(p), -DECADES) / DECADES
    return (1 + np.rint(place * STEPS)).astype(np.int64)


def decode_probability(codes: np.ndarray) -> np.ndarray:
    """0 for code 0 (not in the trie)."""
    return np.where(codes > 0, 10.0 ** (DECADES * ((codes - 1) / STEPS - 1.0)), 0.0)


DECODED = decode_probability(np.arange(STEPS + 2))            # of every code


# --- blocks -----------------------------------------------------------------

def cut_blocks(df: DataFrame, train: Column, id_col: str, text_col: str, rule: LmRule) -> DataFrame:
    """(block, ids, train, sizes, words, owner, tokens, n_tokens): documents as runs of numbers of the block's words,
    by first appearance (frequent words get small numbers, which pack well), after the place of each in ``words``;
    owner gives the shard of each word."""
    id_kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))

    def cut(batches):
        import xxhash
        part, made = TaskContext.get().partitionId(), 0

        def numbers():
            number = defaultdict()
            number.default_factory = number.__len__           # a new word gets the next number
            return number

        ids, marks, sizes, tokens, number = [], [], [], [], numbers()
        held = 0

        def block():
            keys = np.array([xxhash.xxh64_intdigest(w) for w in number], dtype=np.uint64)
            order = np.argsort(keys, kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 24) + made], type=pa.int64()), pa.array([ids], type=pa.list_(id_type)),
                pa.array([pack(np.array(marks))], type=pa.binary()), pa.array([pack(np.array(sizes))], type=pa.binary()),
                pa.array([pack(steps_of(keys[order]))], type=pa.binary()),
                pa.array([pack(keys[order] % np.uint64(WORD_KEYS))], type=pa.binary()),
                pa.array([pack(rank, np.concatenate(tokens))], type=pa.binary()), pa.array([held], type=pa.int64())],
                names=["block", "ids", "train", "sizes", "words", "owner", "tokens", "n_tokens"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, text, used in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII gaps cut
                words.append(END)
                tokens.append(np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words)))
                ids.append(i)
                marks.append(int(used))
                sizes.append(len(words))
                held += len(words)
                if held >= rule.block_tokens:
                    yield block()
                    made += 1
                    ids, marks, sizes, tokens, number, held = [], [], [], [], numbers(), 0
        if ids:
            yield block()

    return docs.mapInArrow(cut, f"block long, ids array<{id_kind}>, train binary, sizes binary, words binary, "
                             f"owner binary, tokens binary, n_tokens long")


class Block:
    """A block's tokens by the place of each among the block's words."""

    def __init__(self, row, shards: int):
        self.block = int(row["block"])
        self.owner = unpack(row["owner"])[0] % shards
        self.sizes, = unpack(row["sizes"])
        self.train = np.repeat(unpack(row["train"])[0] > 0, self.sizes)
        rank, tokens = unpack(row["tokens"])
        self.tokens = rank.astype(np.int32)[tokens]

    def send_words(self, words: bytes):
        """Level 1: (shard, data) of the distinct words and their training counts."""
        keys = np.cumsum(unpack(words)[0].astype(np.uint64), dtype=np.uint64)
        counts = np.bincount(self.tokens[self.train], minlength=len(keys))
        for s in np.unique(self.owner).tolist():
            mine = self.owner == s
            yield s, pack(steps_of(keys[mine]), counts[mine])

    def take_words(self, answers: dict[int, bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, ascending, and counts of the words from the level-1 answers, which lie shard by shard in key order;
        the tokens become places among the ids."""
        ids, counts = np.zeros(len(self.owner), dtype=np.int64), np.zeros(len(self.owner), dtype=np.int64)
        for s, data in answers.items():
            rank, count = unpack(data)
            mine = np.flatnonzero(self.owner == s)
            ids[mine] = 1 + rank * shards + s
            counts[mine] = count
        order, ids = ranked(ids)
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.tokens = place[self.tokens]
        return ids, counts[order]

    def sort_starts(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, shared): the places of the padded documents in the order of the up to ``order`` tokens from there
        on, and how many of these each shares with the place before.  The n-grams of every length are runs of this
        order, those of one context beside each other, so no level needs a sort of the tokens."""
        firsts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        padded = np.zeros(len(self.tokens) + len(self.sizes), dtype=np.int32)
        words = np.ones(len(padded), dtype=bool)
        words[firsts] = False
        padded[words] = self.tokens + 1                       # 0: the beginning of a document
        left = left_of(self.sizes, order)
        width = int(padded.max()) + 2
        kept = [padded]
        for k in range(2, order + 1):
            key = kept[-1].astype(np.int64)
            key *= width                                      # a place past the document's end sorts first
            inside = np.flatnonzero(left >= k).astype(np.int32)
            key[inside] += padded[inside + np.int32(k - 1)] + 1
            del inside
            starts, key = ranked(key)
            number = np.empty(len(padded), dtype=np.int32)
            number[starts] = np.cumsum(first_of_runs(key), dtype=np.int32) - np.int32(1)
            kept.append(number)
        if order == 1:
            starts = ranked(padded.astype(np.int64))[0]
        shared = np.zeros(len(padded), dtype=np.int8)
        for number in kept:
            number = number[starts]
            shared[1:] += number[1:] == number[:-1]
        return starts, shared


def left_of(sizes: np.ndarray, order: int) -> np.ndarray:
    """Tokens from each place of the padded documents to the end of its document, at most ``order``."""
    ends = np.cumsum(sizes + 1)
    left = np.full(int(ends[-1]), order, dtype=np.int8)
    for d in range(1, order):
        left[ends[sizes + 1 >= d] - d] = d
    return left


def sort_block(shards: int, order: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """A block with the order of its n-grams, the ids and the counts of its words, and the beginnings of n-grams
        that may be too frequent for one shard."""
        row = left.iloc[0]
        block = Block(row, shards)
        ids, counts = block.take_words(dict(zip(right["shard"], right["data"])), shards)
        starts, shared = block.sort_starts(order)
        sorted_ = [block.block, row["ids"], row["train"], row["sizes"], pack(steps_of(ids), counts), pack(starts, shared)]
        block = None
        found = SortedBlock(dict(zip(SORTED_NAMES, sorted_)), order)
        return pd.DataFrame([(*sorted_, found.frequent(max(1, len(starts) // (8 * shards))))], columns=[*SORTED_NAMES, "frequent"])

    return tidy(run)


@dataclass(frozen=True)
class Beginnings:
    """The beginnings of n-grams that are split over many shards, of one length: the place of each but its last word
    among those a word shorter, its last word's id, and how often it occurs in all and in training."""

    parent: np.ndarray
    word: np.ndarray
    n: np.ndarray
    seen: np.ndarray


def beginnings(found: dict[tuple[int, ...], int], order: int) -> list[Beginnings]:
    """By length, from the ids of each and its number; each but its last word is among them too."""
    levels, place = [], {(): 0}
    for k in range(1, order):
        paths = sorted(path for path in found if len(path) == k)
        levels.append(Beginnings(*(np.array(a, dtype=np.int64) for a in (
            [place[path[:-1]] for path in paths], [path[-1] for path in paths], [found[path] for path in paths],
            [0] * len(paths)))))
        place = {path: i for i, path in enumerate(paths)}
    return levels


class SortedBlock:
    """The n-grams of a block, level by level; a level's n-grams are numbered in the order of their tokens."""

    def __init__(self, row, order: int):
        self.block, self.order, self.sizes = int(row["block"]), order, unpack(row["sizes"])[0]
        steps, counts = unpack(row["words"])
        self.ids, self.word_count = np.r_[BEGIN_ID, np.cumsum(steps)], counts
        self.starts, self.shared = (a.astype(t) for a, t in zip(unpack(row["starts"], False), (np.int32, np.int8)))
        self.train_docs = unpack(row["train"])[0] > 0
        self.left = left_of(self.sizes, order)[self.starts]
        self.padded = np.empty(len(self.starts), dtype=np.int32)
        # 0: the beginning of a document, then the words
        self.padded[self.starts] = np.cumsum(self.shared < 1, dtype=np.int32) - np.int32(1)

    def trained(self) -> np.ndarray:
        """Whether the document of each start is learned from."""
        return np.repeat(self.train_docs, self.sizes + 1)[self.starts]

    def token(self, at: np.ndarray, k: int) -> np.ndarray:
        """The ``k``-th token from the starts ``at``."""
        return self.padded[self.starts[at] + np.int32(k - 1)]

    def frequent(self, least: int) -> list[tuple[list[int], int]]:
        """(ids, number) of the beginnings of n-grams found ``least`` times and more."""
        out = []
        for k in range(1, self.order):
            runs = np.flatnonzero(self.shared < k)
            n = np.diff(runs, append=len(self.shared))
            often = (n >= least) & (self.left[runs] > k)
            at = runs[often]
            paths = np.stack([self.ids[self.token(at, j)] for j in range(1, k + 1)], axis=1)
            out += zip(paths.tolist(), n[often].tolist())
        return out

    def spans(self, split: list[Beginnings]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(first, past) of the places in the order where each beginning is found."""
        out = []
        for k, level in enumerate(split, 1):
            token = np.minimum(np.searchsorted(self.ids, level.word), len(self.ids) - 1)
            if k == 1:
                first, past = np.zeros(len(token), dtype=np.int64), np.full(len(token), len(self.starts))
            else:
                first, past = (x[level.parent] for x in out[-1])
            past = np.where(self.ids[token] == level.word, past, first)
            out.append((self.first_at(k, first, past, token), self.first_at(k, first, past, token + 1)))
        return out

    def first_at(self, k: int, first: np.ndarray, past: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The first place in [first, past), all of one context, where the ``k``-th token is ``token`` or more."""
        first, past = first.copy(), past.copy()
        while len(open_ := np.flatnonzero(first < past)):
            middle = (first[open_] + past[open_]) >> 1
            less = self.token(middle, k) < token[open_]
            first[open_[less]] = middle[less] + 1
            past[open_[~less]] = middle[~less]
        return first

    def seen_in(self, split: list[Beginnings]) -> list[np.ndarray]:
        """How often each beginning occurs in training."""
        upto = np.r_[0, np.cumsum(self.trained(), dtype=np.int64)]
        return [upto[past] - upto[first] for first, past in self.spans(split)]

    def deal(self, split: list[Beginnings], shards: int, hot: int) -> None:
        """Put the starts in the order of what is sent: by shard, then as before.  All n-grams of every length that
        begin with a word go to one shard, or, where they are too many, all that begin with it and the word after it,
        and so on.  ``ends``: where the starts of each shard end; ``split``: of each length the starts in a beginning
        that is split, and its number in training."""
        spans = [(*span, level) for span, level in zip(self.spans(split), split)]
        spans = [(first[here], past[here], level.n[here], level.seen[here])
                 for first, past, level in spans for here in [np.flatnonzero(first < past)]]
        deep = np.zeros(len(self.starts) + 1, dtype=np.int8)
        for first, past, *_ in spans:
            deep[first] += 1                                  # those of one length do not meet
            deep[past] -= 1
        deep = np.cumsum(deep[:-1], dtype=np.int8)            # words of the longest that is split
        runs = np.flatnonzero(self.shared <= deep).astype(np.int32)
        lengths = np.diff(runs, append=np.int32(len(deep)))
        words = deep[runs]
        context, count = self.ids[self.token(runs, 1)].astype(np.uint64), np.zeros(len(runs), dtype=np.int64)
        word = np.zeros(len(runs), dtype=np.int64)
        for k, (first, _, n, _) in enumerate(spans, 1):
            under = np.flatnonzero(words >= k)
            if k > 1:
                context[under] = (context[under] * np.uint64(0x9FB21C651E98DF25)
                                  ^ self.ids[self.token(runs[under], k)].astype(np.uint64))
            under = under[words[under] == k]
            if len(under):
                count[under] = n[np.searchsorted(first, runs[under], side="right") - 1]
                word[under] = self.ids[self.token(runs[under], k + 1)]
        shard = shard_of(context, count, word, shards, hot)
        by = by_shard(shard, shards)
        lengths = lengths[by]
        ends = np.r_[np.int32(0), np.cumsum(lengths, dtype=np.int32)]
        self.ends = ends[np.cumsum(np.bincount(shard, minlength=shards))]
        order = np.repeat(runs[by] - ends[:-1], lengths)
        order += np.arange(len(order), dtype=np.int32)
        self.split = []
        for k, (first, _, _, seen) in enumerate(spans, 1):
            at = np.flatnonzero(deep[order] >= k).astype(np.int32)
            self.split.append((at, seen[np.searchsorted(first, order[at], side="right") - 1] if len(at) else seen[:0]))
        self.shared = self.shared[order]
        self.shared[ends[:-1]] = 0
        self.starts, self.left = self.starts[order], self.left[order]

    def keep(self, first: int, past: int) -> None:
        """Keep what deal() gave the shards [first, past) only."""
        a, b = (int(np.r_[0, self.ends][s]) for s in (first, past))
        self.starts, self.shared, self.left = (x[a:b].copy() for x in (self.starts, self.shared, self.left))
        self.ends = np.clip(self.ends, a, b) - a
        inside = [(at >= a) & (at < b) for at, _ in self.split]
        self.split = [(at[here] - np.int32(a), seen[here]) for here, (at, seen) in zip(inside, self.split)]

    def levels(self):
        """(level, new, number, parent): the n-grams of each level by where they begin in the order, the number of the
        n-gram at each start and the number of each n-gram's context."""
        number = None
        for k in range(1, self.order + 1):
            is_new = self.shared < k
            is_new &= self.left >= k
            new = np.flatnonzero(is_new).astype(np.int32)
            parent = None if k == 1 else number[new]
            number = np.cumsum(is_new, dtype=np.int32)
            number -= 1
            yield k, new, number, parent

    def send(self):
        """(shard, data) after deal(): the n-grams that go to a shard as a tree, level by level.  Of a level the last
        words, the training counts of n-grams that no longer one goes on from, of those that are split the place and
        the count in training; and but for the last level how many n-grams go on from each."""
        if not len(self.starts):
            return
        leaf = np.flatnonzero(self.shared < self.left).astype(np.int32)
        own = narrow(np.add.reduceat(self.trained(), leaf, dtype=np.int32))
        depth = self.left[leaf]
        parts = []                                            # arrays of a level, and where those of each shard end
        for k, new, number, parent in self.levels():
            word = self.ids[self.token(new, k)]
            ends = np.searchsorted(new, self.ends)
            if k > 1:
                parts.append((narrow(np.bincount(parent, minlength=len(above))), above_ends))
                word = steps_within(word, np.flatnonzero(first_of_runs(parent)))
            else:
                starts = ends[np.flatnonzero(np.diff(ends, prepend=0))]
                word = steps_within(word, np.r_[0, starts[:-1]])
            parts += [(narrow(word), ends), (own[depth == k], np.searchsorted(leaf[depth == k], self.ends))]
            if k < self.order:
                at, seen = self.split[k - 1]
                first = np.flatnonzero(first_of_runs(number[at]))      # one for each n-gram
                inside = np.searchsorted(at[first], self.ends)
                place = number[at[first]].astype(np.int64)
                place -= np.repeat(np.r_[0, ends[:-1]], np.diff(inside, prepend=0))
                parts += [(place, inside), (seen[first], inside)]
            above, above_ends = new, ends
        for s in np.flatnonzero(np.diff(self.ends, prepend=0)).tolist():
            yield s, pack(*[a[ends[s - 1] if s else 0:ends[s]] for a, ends in parts])

    def take(self, answers: dict[int, bytes]) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Of each level from the second the codes and, but for the last, the counts in the order of levels()."""
        parts = [unpack(answers[s], False) for s in np.flatnonzero(np.diff(self.ends, prepend=0)).tolist()]
        out = []
        for k in range(2, self.order + 1):
            code = np.concatenate([x[2 * k - 4] for x in parts])
            seen = None
            if k < self.order:
                found = np.concatenate([x[2 * k - 3] for x in parts])
                seen = np.zeros(len(code), dtype=found.dtype)
                seen[code > 0] = found
            out.append((code, seen))
        return out


def shard_of(ctx: np.ndarray, ctx_count: np.ndarray, word: np.ndarray, shards: int, hot: int) -> np.ndarray:
    """Shard of an n-gram: by its context, and for a context of over ``hot`` tokens by the word too."""
    split = np.flatnonzero(ctx_count >= hot)
    x = ctx.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    salt = word[split].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    x[split] += salt % (1 + ctx_count[split] // hot).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xE7037ED1A0B428DB)
    x >>= np.uint64(33)
    x -= x // np.uint64(shards) * np.uint64(shards)           # several times faster than the remainder
    return x.astype(np.int64)


# --- shards -----------------------------------------------------------------

def mapped(data: bytes):
    """``data`` as a read-only memory map of a file that goes when the map does."""
    with tempfile.TemporaryFile() as f:
        f.write(data)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def word_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Add up a shard of level 1, write it and answer its blocks: rank and count of every word.  The rank is by
    falling count: frequent words get small ids, which pack well."""
    shard = int(rows["shard"].iloc[0])
    sent = [(b, *unpack(d)) for b, d in zip(rows["block"], rows["data"])]
    keys = [np.cumsum(steps.astype(np.uint64), dtype=np.uint64) for _, steps, _ in sent]
    names, number = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(number, weights=np.concatenate([c for _, _, c in sent]), minlength=len(names)).astype(np.int64)
    rank = np.empty(len(names), dtype=np.int64)
    rank[np.argsort(-total, kind="stable")] = np.arange(len(names))
    blob = EliasFano.to_bytes(names) + total.astype(np.int64).tobytes()
    level = mapped(blob)
    words = EliasFano(level)
    counts = np.frombuffer(level, np.int64, len(names), words.size)
    out = [(1, shard, -1, "trie", blob, int(total.sum()), int((total > 0).sum()))]
    for (block, _, _), k in zip(sent, keys):
        at = words.find(k)
        out.append((1, shard, block, "answer", pack(rank[at], counts[at]), 0, 0))
    return pd.DataFrame(out, columns=["level", "shard", "block", "kind", "data", "total", "kinds"])


def tidy(fn):
    """``fn``, the memory of whose work goes back to the system when it ends."""
    def run(*args):
        keep_freed_memory()
        try:
            return fn(*args)
        finally:
            release_memory(collect=False)

    # Spark reads the number of arguments from the signature
    return (lambda rows: run(rows)) if fn.__code__.co_argcount == 1 else lambda left, right: run(left, right)


def gram_shard(shards: int, rule: LmRule, kind: str):
    """The ``kind`` of rows ("trie" or "answer") of a shard of the n-gram levels."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Add up a shard of the n-grams, build its trie and answer its blocks from it."""
        shard, n = int(rows["shard"].iloc[0]), rule.order
        sent = merged([unpack(data, False) for data in rows["data"]], n)
        counts, split = sent.counts(), sent.split
        out, answers = [], [[] for _ in rows["data"]]
        at = rank = seen = number = None                      # of the level before
        for k in range(1, n + 1):
            word, count, size = sent.words[k - 1], counts[k - 1], sent.sizes[k - 1]
            sent.words[k - 1] = counts[k - 1] = None
            width = int(word.max()) + 1 if len(word) else 1
            if k > 1:
                key = np.repeat(number, sent.children[k - 2]).astype(np.int64)
                sent.children[k - 2] = None
                key *= width
                key += word
            else:
                key = word.astype(np.int64)
            del word
            order, key = ranked(key)
            new = first_of_runs(key)
            number = np.empty(len(key), dtype=np.int32)
            number[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
            total = np.add.reduceat(count[order], np.flatnonzero(new), dtype=np.int64) if len(key) else np.zeros(0, np.int64)
            del count, order
            key = key[new]
            if k < n:
                total[number[split[k - 1][0]]] = split[k - 1][1]
            if k == 1:
                at, rank, seen = key, key, total              # contexts of the second level: ids of words
                continue
            place = (key // width).astype(np.int32)
            key -= place * np.int64(width)
            word = narrow(key)
            del key, new
            used = np.flatnonzero(total > 0)
            codes = encode_probability(total[used] / (seen[place[used]] + rule.strength))
            blob = TrieLevel.to_bytes(rank[place[used]], word[used], total[used] if k < n else total[:0], codes)
            if kind == "trie":
                out.append((k, shard, -1, kind, blob, int(total.sum()), len(used)))
            else:
                trie = TrieLevel(mapped(blob))
                del blob, codes, used
                known = np.flatnonzero(at >= 0)               # contexts in the trie, which ascend
                context = np.full(len(at), -1, dtype=np.int64)
                context[known] = trie.find_contexts(at[known])
                at = trie.find_in(context[place], word)
                found, inside = at >= 0, np.maximum(at, 0)
                code = np.where(found, trie.codes[inside], 0).astype(np.uint16) if len(trie.codes) else np.zeros(len(at), np.uint16)
                count = np.where(found, trie.counts[inside], 0) if len(trie.counts) else np.zeros(len(at), np.int64)
                for answer, mine in zip(answers, np.split(number, np.cumsum(size)[:-1])):
                    mine_code = code[mine]
                    answer.append(mine_code)
                    if k < n:
                        answer.append(count[mine[mine_code > 0]])
                del trie, context, found, inside, code, count
            rank = np.cumsum(total > 0) - 1
            seen = total
        if kind == "answer":
            out = [(n, shard, block, kind, pack(*answer), 0, 0) for block, answer in zip(rows["block"], answers)]
        return pd.DataFrame(out, columns=CHUNK_NAMES)

    return tidy(run)


@dataclass
class Sent:
    """What blocks sent to a shard, one after the other, by level: last words, how many n-grams go on from each, counts
    of those that none goes on from, (place, count) of those that are split, and how many each block sent."""

    words: list[np.ndarray]
    children: list[np.ndarray]
    own: list[np.ndarray]
    split: list[tuple[np.ndarray, np.ndarray]]
    sizes: list[list[int]]

    def counts(self) -> list[np.ndarray]:
        """The training counts of all n-grams: an n-gram occurs as often as those that go on from it."""
        out = [self.own[-1]]
        for children, own in zip(self.children[::-1], self.own[-2::-1]):
            count, on = np.zeros(len(children), dtype=np.int64), children > 0
            if len(out[0]):
                count[on] = np.add.reduceat(out[0], np.cumsum(children[on]) - children[on], dtype=np.int64)
            count[~on] = own
            out.insert(0, narrow(count))
        self.own = []
        return out


def merged(parts: list[list[np.ndarray]], order: int) -> Sent:
    out = Sent([], [], [], [], [])
    for k in range(order):
        word, own, *rest = (np.concatenate(arrays) for arrays in zip(*[p[5 * k:5 * k + 5] for p in parts]))
        size = [len(p[5 * k]) for p in parts]
        lengths = out.children[-1][out.children[-1] > 0] if k else np.array(size)
        out.words.append(narrow(sums_within(word, lengths)) if len(word) else word)
        out.own.append(own)
        out.sizes.append(size)
        if k < order - 1:
            place, seen, children = rest
            base = np.repeat(np.cumsum(size) - size, [len(p[5 * k + 2]) for p in parts])
            out.split.append((place.astype(np.int64) + base, seen))
            out.children.append(children.astype(np.int32))
        for p in parts:
            p[5 * k:5 * k + 5] = [None] * len(p[5 * k:5 * k + 5])
    return out


class Stored:
    """Rows stored by block under the shared scratch folder, so that what groups them by block moves none.  Buckets
    are known to the catalog only, so until forget() it holds a table of them; the files stay."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.table = spark, scratch_path(spark, name), f"letrado_lm_{uuid.uuid4().hex}"
        self.buckets = min(table_partitions(spark), 100_000)

    def add(self, df: DataFrame) -> DataFrame:
        """Write ``df`` too; all rows stored."""
        (df.repartition(self.buckets, "block").write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "block").saveAsTable(self.table))
        return self.spark.table(self.table)

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


# --- the whole --------------------------------------------------------------

def send_grams(split: list[Beginnings], first: int, past: int, shards: int, hot: int, rule: LmRule):
    def send(rows: pd.DataFrame) -> pd.DataFrame:
        """What a block asks the shards [first, past): its n-grams of all levels, one tree per shard."""
        block = SortedBlock(rows.iloc[0], rule.order)
        block.deal(split, shards, hot)
        block.keep(first, past)
        return pd.DataFrame([(rule.order, s, block.block, "sent", data, 0, 0) for s, data in block.send()], columns=CHUNK_NAMES)

    return tidy(send)


def token_probabilities(block: SortedBlock, answers: dict[int, bytes], begin: int, p: np.ndarray, rule: LmRule) -> None:
    """Interpolate ``p``, of every place of the padded documents, through the levels."""
    codes = block.take(answers)
    for k, new, number, parent in block.levels():
        if k == 1:
            seen = np.r_[begin, block.word_count][block.token(new, 1)]
            continue
        below = (rule.strength / (seen.astype(np.float64) + rule.strength))[parent]          # 1 where the context was not seen
        code, seen = codes[k - 2]
        codes[k - 2] = None
        above = DECODED[code]
        at = np.flatnonzero(block.left >= k)                  # an n-gram's last token is the one it tells of
        number = number[at]
        at = block.starts[at] + np.int32(k - 1)
        p[at] = p[at] * below[number] + above[number]


def too_frequent(light: DataFrame, n_starts: int, shards: int, rule: LmRule) -> list[Beginnings]:
    """The beginnings of n-grams that would fill an eighth of a shard, with their exact numbers in training: at most
    8 a shard of each length.  One found so often in all fills a sixteenth of a shard's part of some block, so adding
    up what blocks report finds it."""
    spark = light.sparkSession
    reported = (light.select(F.explode("frequent").alias("f")).groupBy("f.path").agg(F.sum("f.n").alias("n"))
                .where(F.col("n") * (8 * shards) >= n_starts))
    split = beginnings({tuple(r.path): r.n for r in reported.collect()}, rule.order)
    kinds = [len(level.word) for level in split]
    if not sum(kinds):
        return split

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.concatenate(SortedBlock(rows.iloc[0], rule.order).seen_in(split))
        at = np.flatnonzero(seen)
        return pd.DataFrame({"at": at, "n": seen[at]})

    counted = (light.drop("ids", "frequent").groupBy("block").applyInPandas(tidy(count), "at long, n long")
               .groupBy("at").agg(F.sum("n").alias("n")))
    seen = np.zeros(sum(kinds), dtype=np.int64)
    for r in counted.collect():
        seen[r["at"]] = r["n"]
    return [replace(level, seen=part) for level, part in zip(split, np.split(seen, np.cumsum(kinds)[:-1]))]


def score_documents(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                    rule: LmRule = LmRule()) -> tuple[DataFrame, DataFrame]:
    """Train on the rows of ``df`` where ``train`` holds, score all of them.

    Gives (scores, trie): a row per row of ``df`` with ``id_col``, trained,
    n_tokens, n_known, train_tokens, base_score and score (log10), and the trie
    as (level, shard, data) rows of Elias-Fano levels.  Null and empty texts are
    the end token alone; a null ``train`` is false; repeated rows count and score
    each on their own; without a training row every word is unknown.
    """
    spark = df.sparkSession
    cut, ordered = (Stored(spark, name) for name in ("lm-blocks", "lm-sorted-blocks"))
    blocks = cut.add(cut_blocks(df, train, id_col, text_col, rule))
    n_tokens, n_documents = blocks.agg(*[F.coalesce(F.sum(n), F.lit(0)) for n in (F.col("n_tokens"), F.size("ids"))]).first()
    shards = max(table_partitions(spark), -(-n_tokens // rule.shard_tokens))

    def send_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, shards)
                rows = [(1, s, block.block, "sent", data, 0, 0) for s, data in block.send_words(row["words"])]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), CHUNK_TYPES)],
                                                 names=CHUNK_NAMES)

    sent = blocks.select("block", "train", "sizes", "words", "owner", "tokens").mapInArrow(send_words, CHUNK)
    words = materialize(sent.groupBy("shard").applyInPandas(word_shard, CHUNK), "lm-level-1")
    tries = words.where("kind = 'trie'")
    whole = tries.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("v")).first()
    n_total, n_kinds = int(whole.n), int(whole.v)
    begin = df.where(train).count()                           # documents that begin

    id_kind = df.schema[id_col].dataType.simpleString()
    told = words.where("kind = 'answer'").select("block", "shard", "data")
    light = ordered.add(
        blocks.select("block", "ids", "train", "sizes", "owner", "tokens").groupBy("block").cogroup(told.groupBy("block"))
        .applyInPandas(sort_block(shards, rule.order),
                       f"block long, ids array<{id_kind}>, train binary, sizes binary, words binary, starts binary, "
                       "frequent array<struct<path: array<long>, n: long>>"))
    cut.forget()
    remove_folder(spark, cut.path)                            # all of it lies in the sorted blocks
    drop_shuffles(spark)

    n_starts = n_tokens + n_documents
    split, hot = too_frequent(light, n_starts, shards, rule), max(1, n_starts // (8 * shards))
    light = light.drop("frequent")
    def asked(first: int, past: int):
        return (light.drop("ids").groupBy("block").applyInPandas(send_grams(split, first, past, shards, hot, rule), CHUNK)
                .groupBy("shard"))

    tries = tries.unionByName(asked(0, shards).applyInPandas(gram_shard(shards, rule, "trie"), CHUNK))
    path, ends = scratch_path(spark, "lm-answers"), [shards * i // rule.parts for i in range(rule.parts + 1)]
    for first, past in zip(ends, ends[1:]):
        answers = asked(first, past).applyInPandas(gram_shard(shards, rule, "answer"), CHUNK).select("block", "shard", "data")
        answers.write.mode("append").parquet(path)
        drop_shuffles(spark)
    answers = spark.read.schema(answers.schema).parquet(path)

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        block = SortedBlock(left.iloc[0], rule.order)
        count = np.r_[0, block.word_count][block.padded]
        words = block.padded > 0
        p = (count + 1) / (n_total + n_kinds + 1)
        count = count[words]
        block.deal(split, shards, hot)
        token_probabilities(block, dict(zip(right["shard"], right["data"])), begin, p, rule)
        starts = np.cumsum(block.sizes) - block.sizes
        base = np.log10((count + 1) / (n_total + 1 * (n_kinds + 1)))
        return pd.DataFrame({"id": pd.Series(list(left["ids"].iloc[0]), dtype=object), "trained": block.train_docs,
                             "n_tokens": block.sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
                             "train_tokens": n_total, "base_score": np.add.reduceat(base, starts),
                             "score": np.add.reduceat(np.log10(p[words]), starts)})

    scores = (light.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        tidy(score), f"id {id_kind}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    ordered.forget()
    return scores.withColumnRenamed("id", id_col), tries.select("level", "shard", "data")


SORTED_NAMES = ["block", "ids", "train", "sizes", "words", "starts"]
CHUNK_NAMES = [c.split()[0] for c in CHUNK.split(", ")]
CHUNK_TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]
               for c in CHUNK.split(", ")]

