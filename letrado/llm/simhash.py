"""SimHash near-duplicates with pivot distance tables (operator 10).

Each text gets a 64-bit fingerprint; fingerprints that differ in at most
``max_bits`` bits (2) are linked, and linked fingerprints form components.

* Equal fingerprints are one row from the start, so a group of copies weighs
  as much as a single document.
* Two fingerprints within 2 bits agree in two of four 16-bit blocks.  Each
  fingerprint is dealt to its six block pairs; every link lies in a bucket.
* In a bucket the distances of all members to many reference fingerprints
  (pivots) are tabled.  By the triangle inequality a linked pair differs by at
  most ``max_bits`` in every coordinate: other pairs are discarded, survivors
  are verified.  Of the links a bucket finds only a spanning forest leaves it.
* A bucket above ``bucket_limit`` (a dense cloud of near copies) is not compared
  pair by pair.  Its members are dealt to all fingerprints one bit away and to
  themselves: members that meet are at most 2 bits apart, and any two that are
  meet.  Linking each to the least member it meets is exact and linear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letrado.llm.common import free_name
from letrado.llm.components import connected_roots
from letrado.session import materialize

PIVOTS = np.random.default_rng(20_240_607).integers(0, 2**64, size=32, dtype=np.uint64)
AT_ONCE = 100_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 without words."""
    import xxhash
    words = (text or "").encode().lower().split()          # bytes: only A-Z change, only ASCII gaps cut
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    k = min(shingle, len(words))
    first, last = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), AT_ONCE):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[at:at + AT_ONCE], last[at:at + AT_ONCE])],
                     dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(first), bitorder="little")
    return int(bits.view(np.uint64)[0])


def add_fingerprint(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """``df`` with the fingerprint as a signed long; null and empty texts have 0."""

    @F.arrow_udf("bigint")
    def compute(text: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, shingle) for t in text.to_pylist()], dtype=np.uint64)
        return pa.array(values.view(np.int64))

    return df.withColumn(out_col, compute(F.col(text_col)))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def bucket_links(fps: np.ndarray, max_bits: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Members and their roots: links that connect what is within ``max_bits`` in one bucket."""
    x = np.sort(fps.astype(np.int64).view(np.uint64))
    table = np.bitwise_count(x[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    found = []
    for at in range(0, len(x), 256):                          # a block of rows against all later ones
        i, j = np.nonzero(np.abs(table[at:at + 256, None, 0] - table[None, :, 0]) <= max_bits)
        i += at
        i, j = i[i < j], j[i < j]
        for c in range(1, table.shape[1]):
            if not len(i):
                break
            near = np.abs(table[i, c] - table[j, c]) <= max_bits
            i, j = i[near], j[near]
        near = np.bitwise_count(x[i] ^ x[j]) <= max_bits
        found.append((i[near], j[near]))
    i, j = (np.concatenate(side) for side in zip(*found))
    root = np.arange(len(x))
    while True:
        low = root.copy()
        both = np.minimum(root[i], root[j])
        np.minimum.at(low, i, both)
        np.minimum.at(low, j, both)
        low = low[low]
        if (low == root).all():
            break
        root = low
    signed = x.view(np.int64)
    at = np.flatnonzero(root != np.arange(len(x)))
    return signed[at], signed[root[at]]


def link_fingerprints(fps: DataFrame, max_bits: int = 2, bucket_limit: int = 4096) -> DataFrame:
    """(a, b) links of the distinct longs in ``fps.fp`` with the components of all pairs within ``max_bits``.

    ``max_bits`` is at most 2: that is what two equal blocks of four guarantee.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    if max_bits == 0:
        return fps.sparkSession.createDataFrame([], "a bigint, b bigint")
    fp = F.col("fp")
    block = [F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    pairs = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    keys = F.array(*[F.lit(n * 2**32) + block[a] * 65536 + block[b] for n, (a, b) in enumerate(pairs)])
    keyed = fps.select("fp", F.explode(keys).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = keyed.join(shared, "key")

    @F.arrow_udf("array<struct<a:bigint,b:bigint>>")
    def compare(buckets: pa.Array) -> pa.Array:
        if not len(buckets):
            return pa.array([], type=pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        flat = buckets.flatten().to_numpy()                   # arrays throughout: a dense batch has many links
        ends = np.cumsum(buckets.value_lengths().to_numpy())
        found = [bucket_links(v, max_bits) for v in np.split(flat, ends[:-1])]
        offsets = np.r_[0, np.cumsum([len(a) for a, _ in found])].astype(np.int32)
        links = pa.StructArray.from_arrays([pa.array(np.concatenate([f[side] for f in found]), type=pa.int64())
                                            for side in (0, 1)], names=["a", "b"])
        return pa.ListArray.from_arrays(pa.array(offsets), links)

    small = (members.where(F.col("n") <= bucket_limit).groupBy("key").agg(F.collect_list("fp").alias("fps"))
             .select(F.explode(compare("fps")).alias("link")).select("link.a", "link.b"))
    dense = members.where(F.col("n") > bucket_limit).select("fp").distinct()
    if max_bits == 2:
        flips = F.array(F.lit(0).cast("bigint"), *[F.lit(b if b < 2**63 else b - 2**64) for b in (1 << k for k in range(64))])
        met = dense.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
        least = met.groupBy("at").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where(F.col("n") > 1)
        far = met.join(least, "at").where(F.col("fp") != F.col("least")).select(F.col("fp").alias("a"), F.col("least").alias("b"))
    else:                                                     # a pair one bit apart meets at its even member
        odd = F.bit_count("fp") % 2 == 1
        ones = F.array(*[F.lit(b if b < 2**63 else b - 2**64) for b in (1 << k for k in range(64))])
        met = dense.where(odd).select(F.col("fp").alias("a"), F.explode(ones).alias("flip"))
        far = met.select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("b")).join(
            dense.where(~odd).select(F.col("fp").alias("b")), "b").select("a", "b")
    return small.unionByName(far).distinct()


def component_roots(fps: DataFrame, max_bits: int = 2, bucket_limit: int = 4096) -> DataFrame:
    """(fp, root): the least fingerprint of the component, for fingerprints that are not their own root."""
    links = materialize(link_fingerprints(fps, max_bits, bucket_limit), "simhash-links")
    return connected_roots(links).select(F.col("node").alias("fp"), "root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, bucket_limit: int = 4096) -> DataFrame:
    """One row per row of ``df``: (``id_col``, fingerprint long, component_id).

    component_id is the smallest id reachable over links; rows with a null id
    take part and count only when a component has no other id (then it is
    null).  Texts without words have fingerprint 0 and are linked like others.
    """
    prints = materialize(add_fingerprint(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "fp",
                                         shingle).select("id", "fp"), "simhash-prints")
    firsts = prints.groupBy("fp").agg(F.min("id").alias("first"))
    classes = _classes(firsts, max_bits, bucket_limit)
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"),
                                             F.col("first").alias("component_id"))


def _classes(firsts: DataFrame, max_bits: int, bucket_limit: int) -> DataFrame:
    """(fp, first) with ``first`` the least of the component that (fp, first) rows form."""
    firsts = materialize(firsts, "simhash-firsts")
    roots = component_roots(firsts.select("fp"), max_bits, bucket_limit)
    rooted = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-rooted")
    low = rooted.groupBy("root").agg(F.min("first").alias("low"), F.count("*").alias("n")).where(F.col("n") > 1)
    return rooted.join(low.select("root", "low"), "root", "left").select("fp", F.coalesce("low", "first").alias("first"))


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                     max_bits: int = 2, bucket_limit: int = 4096) -> DataFrame:
    """The rows of ``df`` that are first of their component, with ``df``'s columns.

    The row with the smallest id stays (null ids last); of rows that share the
    id exactly one stays.
    """
    row, fp = free_name(df, "row_number"), free_name(df, "fingerprint")
    numbered = materialize(add_fingerprint(df, text_col, fp, shingle).withColumn(row, F.monotonically_increasing_id()),
                           "simhash-rows")
    own = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    firsts = numbered.groupBy(F.col(fp).alias("fp")).agg(F.min(own).alias("first"))
    kept = _classes(firsts, max_bits, bucket_limit).select(F.col("first.row").alias(row)).distinct()
    return numbered.join(kept, row, "left_semi").select(*df.columns)
