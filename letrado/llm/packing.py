"""Packing token sequences by shortest-pack-first over the length histogram (operator 2).

A document's ids are cut into full sequences and a rest, and a rest of over half
a sequence once more at the half: pieces of half a sequence or less leave little
padding whatever the lengths are.  Only the histogram
of piece lengths (at most ``max_length`` numbers, whatever the corpus) goes to
the driver.  There lengths are placed longest first, each into the open pack
that is shortest so far; a pack is a pattern of lengths with a count of how often
it is used, and the counts are updated as patterns split.  Pieces then find
their place by rank: the k-th piece of a length takes the k-th slot of that
length in the pattern table.

Ranks come without sorting: the task that cuts a part numbers its pieces of
each length, and the parts' counts are added up.  So a length that a third of
all pieces share is no hot group.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from letrado.llm.common import release_memory
from letrado.llm.pretokens import BEYOND_LATIN, PieceCache
from letrado.llm.token_counts import byte_letters
from letrado.session import materialize

BLANK = "\u0120"                                              # the letter of a blank in byte-level vocabularies
IN_A_ROW = 200
PIECES = "id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, number bigint"


SMALL_CACHE = 8 << 20                                         # bytes, where other stages need the workers' memory


@lru_cache(maxsize=2)
def _ids(path: str, limit: int = 32 << 20):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"            # Spark deals the work
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    begins = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True) + 1, dtype=bool)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        begins[i] = token.startswith(BLANK)

    def one_by_one(strings: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def encode(strings: list[str]) -> list[bytes]:
        """Strings of one blank and a run without white space are encoded many in a row: only the first
        token of each starts with the blank, so the ids can be parted again."""
        runs = [i for i, s in enumerate(strings) if s[:1] == " " and s[1:].split() == [s[1:]]]
        groups = [runs[k:k + IN_A_ROW] for k in range(0, len(runs), IN_A_ROW)]
        out: list = [None] * len(strings)
        found = tokenizer.encode_batch_fast(["".join([strings[i] for i in g]) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found):
            ids = np.array(encoding.ids, dtype="<u4")
            starts = np.flatnonzero(begins[ids])
            if len(starts) == len(group):
                data = ids.tobytes()
                cuts = (starts * 4).tolist() + [len(data)]
                for i, a, b in zip(group, cuts, cuts[1:]):
                    out[i] = data[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, one_by_one([strings[i] for i in rest])):
            out[i] = ids
        return out

    special = [str(t) for t in tokenizer.get_added_tokens_decoder().values()]
    fast = rank_encoding(path)
    pieces = PieceCache(encode, limit)

    def lookup(texts: list[str]) -> list[list[bytes]]:
        """The ids of each text in parts.  Latin texts are encoded by ranks, which is twice as fast; any other text, and
        one with a special string or a very long pre-token, by the library of the file."""
        out: list = [None] * len(texts)
        if fast is not None:
            for i, text in enumerate(texts):
                if not (BEYOND_LATIN.search(text) or _has_long_run(text) or any(x in text for x in special)):
                    out[i] = [np.array(fast.encode_ordinary(text), dtype="<u4").tobytes()]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, values in zip(rest, pieces.lookup([texts[i] for i in rest])):
            out[i] = values
        return out

    return lookup


LONGEST = 1000                                                # characters of a run that are left to the ranks
_WIDE = re.compile(r"\s{%d}" % LONGEST)


def _has_long_run(text: str) -> bool:
    """Whether a pre-token may be so long that pairs should not be searched one after the other."""
    return max(map(len, text.split()), default=0) >= LONGEST or _WIDE.search(text) is not None


def rank_encoding(path: str):
    """The byte-level vocabulary of a tokenizers file as ranks; None unless its merges are in the order of their ids, so
    that merging by least id is merging by first merge."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, byte_of = model["vocab"], {c: i for i, c in enumerate(byte_letters())}
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    letters = {vocab[c] for c in byte_of}
    known = letters.union(merged)
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if i in known}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = 1024,
               end_id: int = 0, keep_cache: bool = True) -> DataFrame:
    """The pieces of every document: PIECES, with each task's own numbers of the pieces of a length.

    A null or empty text is the end id alone.  Without ``keep_cache`` a task drops the tokenizer and its caches at its
    end, for jobs that have other stages beside.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    end = int(end_id).to_bytes(4, "little")
    schema = PIECES.format(id=docs.schema["id"].dataType.simpleString())

    def cut(batches):
        if keep_cache:
            yield from pieces_of(batches, _ids(path))
            return
        release_memory()                                      # what earlier stages left in this worker
        yield from pieces_of(batches, _ids(path, SMALL_CACHE))
        _ids.cache_clear()
        release_memory()

    def pieces_of(batches, ids_of):
        part = TaskContext.get().partitionId()
        used = np.zeros(max_length + 1, dtype=np.int64)
        for batch in batches:
            rows, start, length, crc, total = [], [], [], [], []
            for i, values in enumerate(ids_of([t or "" for t in batch.column(1).to_pylist()])):
                ids = b"".join(values) + end
                n = len(ids) // 4
                cuts = [*range(0, n, max_length), n]
                if n % max_length > max_length // 2:
                    cuts.insert(-1, cuts[-2] + max_length // 2)
                for at, past in zip(cuts, cuts[1:]):
                    piece = ids[4 * at:4 * past]
                    rows.append(i)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            sizes = np.array(length, dtype=np.int64)
            order = np.argsort(sizes, kind="stable")
            groups = sizes[order]
            begins = np.r_[True, groups[1:] != groups[:-1]][:len(groups)]
            first = np.maximum.accumulate(np.where(begins, np.arange(len(groups)), 0))
            number = np.empty(len(sizes), dtype=np.int64)
            number[order] = used[groups] + np.arange(len(groups)) - first
            np.add.at(used, sizes, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, type=pa.int64())), pa.array(start, type=pa.int64()),
                 pa.array(length, type=pa.int64()), pa.array(crc, type=pa.int64()), pa.array(total, type=pa.int64()),
                 pa.array([part] * len(rows), type=pa.int32()), pa.array(number)],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "part", "number"])

    return docs.mapInArrow(cut, schema)


def shortest_pack_first(histogram: dict[int, int], max_length: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) patterns that place ``histogram[length]`` pieces of every length.

    Each piece goes to the shortest open pack that has room, and opens one where
    none has; the pieces of a length are placed together.  A pack opened for a
    length is the shortest of all, so it takes as many of that length as fit.  A
    length either uses up an open pattern, which is replaced by one longer
    pattern, or splits the last one it meets, or opens at most two: at most
    three patterns per length are ever added, so the table stays below
    3 * max_length patterns.
    """
    by_room: list[list] = [[] for _ in range(max_length + 1)]      # open patterns by the room they have left
    for length in range(max_length, 0, -1):
        left = int(histogram.get(length, 0))
        room = max_length
        while left:
            while room >= length and not by_room[room]:
                room -= 1
            if room < length:                                    # fits nowhere: packs of its own
                most = max_length // length
                for count, n in ((left // most, most), (1, left % most)):
                    if count and n:
                        by_room[max_length - n * length].append((count, (length,) * n))
                break
            count, lengths = by_room[room].pop()
            used = min(count, left)
            if count > used:
                by_room[room].append((count - used, lengths))
            left -= used
            by_room[room - length].append((used, lengths + (length,)))
    return [p for patterns in by_room for p in patterns]


def slot_rows(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, sequence tokens) of every slot."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in patterns:
        for length, offset in zip(lengths, accumulate((0,) + lengths)):
            rank = ranks.get(length, 0)
            rows.append((length, rank, rank + count, sequence, offset, sum(lengths)))
            ranks[length] = rank + count
        sequence += count
    return rows


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = 1024,
         end_id: int = 0, keep_cache: bool = True) -> DataFrame:
    """One row per piece: (``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every row of ``df`` is a document of its own, also where ids repeat or are
    null; null and empty texts hold the end id alone; an empty table gives no
    piece.  Within a sequence offsets are gapless from 0.
    """
    spark = df.sparkSession
    pieces = materialize(cut_pieces(df, path, id_col, text_col, max_length, end_id, keep_cache), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # max_length rows
    slots = spark.createDataFrame(slot_rows(shortest_pack_first(histogram, max_length)),
                                  "length bigint, first bigint, past bigint, sequence bigint, offset bigint, total bigint")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("number"))
    # the slot table is bounded by max_length (see shortest_pack_first), not by the corpus
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("past")))
    return placed.select(F.col("id").alias(id_col), "start", ranked["length"], "ids_crc32", "doc_tokens",
                         (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
