"""Information-theoretic sanitisation of personal data (operator 6).

Patterns find the protected entities of a text: e-mail and IP addresses, card
and phone numbers.  The corpus then tells which other terms give an entity
away.  For an entity e and a term t of the documents that hold it

    disclosure(e, t) = PMI(e; t) / IC(e),
    PMI = log2(D * docs(e, t) / (docs(e) * docs(t))),  IC = log2(D / docs(e)),

where D is the number of documents and docs() counts documents: the share of
the entity's information that the term alone reveals (1: the term occurs only
with the entity).  Terms at or above the threshold are generalised, from the
first document on: with ``everywhere`` in every document that holds the term,
else in those that hold the entity too.  What keeps chance meetings out is a
bound on their probability.  Were term and entity independent,
as many documents with both would come with a chance of at most

    2 ** -(own * (q * log2(q / p) + (1 - q) * log2((1 - q) / (1 - p)))),

q the term's share of the entity's documents and p its share of all (Hoeffding's
bound; 1 / D where both stand in one document alone).  It must not exceed
``significance``.  Here copies, documents of the same text, count once.

Counts run over the whole corpus.  Entity, term and count rows are shuffled, and
of the texts only those that hold an entity or, by a Bloom filter, a disclosing
term; the filter only saves rows, a join decides.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letrado.llm.common import free_name
from letrado.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")
SPANS = "array<struct<kind:string,start:int,end:int>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Disclosure:
    """Production values: share of the entity's information, chance of a coincidence, terms also where the entity is not,
    letters of a term."""

    threshold: float = 0.9
    significance: float = 0.005
    everywhere: bool = False
    least_letters: int = 3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def find_base(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start; kinds may overlap each other.

    Works in time linear in the text: an address is grown from its @ to the
    left, and a run of digits is entered at its start only.
    """
    text = text or ""
    out = []
    at, past = text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            past = m.end()
        at = text.find("@", max(at + 1, past))
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def words_of(text: str, start: int = 0, end: int | None = None):
    """(term, start, end) of the words of text[start:end]: runs of letters and digits, folded."""
    for m in _WORD.finditer(text, start, len(text) if end is None else end):
        yield m[0].casefold(), m.start(), m.end()


def entity_key(kind: str, value: str) -> int:
    import xxhash
    plain = value.casefold() if kind in ("email", "ip") else "".join(c for c in value if c.isdigit())
    return xxhash.xxh64_intdigest(f"{kind}:{plain}", 42) - 2**63


def entity_terms(text: str, spans: list[tuple[str, int, int]], rule: Disclosure) -> tuple[set[int], set[str]]:
    """The entities of a text and the terms of the whole text; words that touch a base span are not terms."""
    parts = covered_parts(spans)
    return ({entity_key(kind, text[a:b]) for kind, a, b in spans},
            {t for t, a, b in words_of(text) if len(t) >= rule.least_letters and not touches(parts, a, b)})


def covered_parts(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover."""
    starts, ends = [], []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def touches(parts: tuple[list[int], list[int]], a: int, b: int) -> bool:
    i = bisect_right(parts[1], a)
    return i < len(parts[0]) and parts[0][i] < b


def find_terms(text: str, base: list[tuple[str, int, int]], terms: set[str]) -> list[tuple[str, int, int]]:
    """Spans of the terms, save where a base span stands."""
    if not terms:
        return []
    parts = covered_parts(base)
    return [("term", a, b) for t, a, b in words_of(text) if t in terms and not touches(parts, a, b)]


def clean_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span generalised: base kinds by their label, terms by what they look like."""
    parts, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:
            at = max(at, e)                                    # overlaps the span before: already covered
            continue
        word = text[s:e]
        parts += [text[at:s], LABELS.get(kind) or ("[NUMBER]" if word.isdigit() else "[NAME]" if word[0].isupper()
                                                   else "[TERM]")]
        at = e
    return "".join([*parts, text[at:]])


def add_base_spans(df: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``df`` with the base spans of every text; null and empty texts have none."""

    @F.arrow_udf(SPANS)
    def find(text: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in find_base(t)] for t in text.to_pylist()],
                        type=ARROW_SPANS)

    return df.withColumn(out_col, find(F.col(text_col)))


def _tuples(spans) -> list[tuple[str, int, int]]:
    return [(s["kind"], s["start"], s["end"]) for s in spans]


def entity_rows(holders: DataFrame) -> DataFrame:
    """(row, entity, mark) of the rows (row, text, spans), once for every entity of a row; mark is the text's hash."""

    def emit(batches):
        import xxhash
        for batch in batches:
            rows = []
            for row, text, spans in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                mark = xxhash.xxh64_intdigest(text, 7) - 2**63
                rows += [(row, e, mark) for e in {entity_key(k, text[a:b]) for k, a, b in _tuples(spans)}]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in list(zip(*rows)) or [[], [], []]],
                                             names=["row", "entity", "mark"])

    return holders.select("row", "text", "spans").mapInArrow(emit, "row bigint, entity bigint, mark bigint")


def term_pairs(holders: DataFrame, rule: Disclosure, common: set[str], frequent: set[int],
               hold: int = 200_000) -> DataFrame:
    """(entity, term, both, apart): documents that hold both, and those of them that are no copy of another.

    ``holders`` has row, text, spans and first (1 for one of each group of
    copies).  Pairs of a ``common`` term with an entity that is not ``frequent``
    cannot reach the threshold and are left out.  A task adds up ``hold`` pairs
    before it sends them, so a hot entity sends a row a term and task.
    """

    def emit(batches):
        def rows():
            return pa.RecordBatch.from_arrays([
                pa.array([e for e, _ in held], type=pa.int64()), pa.array([t for _, t in held], type=pa.string()),
                pa.array([n for n, _ in held.values()], type=pa.int64()),
                pa.array([n for _, n in held.values()], type=pa.int64())], names=["entity", "term", "both", "apart"])
        held: dict = {}
        for batch in batches:
            for text, spans, first in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                entities, terms = entity_terms(text, _tuples(spans), rule)
                rare = terms - common
                for entity in entities:
                    for t in terms if entity in frequent else rare:
                        n, m = held.get((entity, t), (0, 0))
                        held[entity, t] = n + 1, m + first
                    if len(held) > hold:
                        yield rows()
                        held = {}
        yield rows()

    return (holders.select("text", "spans", "first")
            .mapInArrow(emit, "entity bigint, term string, both bigint, apart bigint")
            .groupBy("entity", "term").agg(F.sum("both").alias("both"), F.sum("apart").alias("apart")))


def term_documents(corpus: DataFrame, text_col: str = "text", hold: int = 200_000) -> DataFrame:
    """(term, docs) over all documents; a task adds up ``hold`` terms before it sends them."""

    def count(batches):
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), type=pa.string()),
                                               pa.array(list(held.values()), type=pa.int64())], names=["term", "n"])
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update({w.casefold() for w in _WORD.findall(text or "")})
                if len(held) > hold:
                    yield rows()
                    held = Counter()
        yield rows()

    return (corpus.select(text_col).mapInArrow(count, "term string, n bigint")
            .groupBy("term").agg(F.sum("n").alias("docs")))


def disclosing_terms(holders: DataFrame, corpus: DataFrame, documents: int, text_col: str = "text",
                     rule: Disclosure = Disclosure()) -> DataFrame:
    """(entity, term, disclosure, docs) at or above the threshold, from the rows (row, text, spans) that hold
    an entity and the whole corpus."""
    held = materialize(entity_rows(holders), "pii-entities")
    firsts = held.groupBy("mark").agg(F.min("row").alias("row")).select("row", F.lit(1).alias("first"))
    own = (held.join(firsts, "row", "left").groupBy("entity")
           .agg(F.count("*").alias("own"), F.count("first").alias("own_apart")))
    own = materialize(own, "pii-own")
    counts = materialize(term_documents(corpus, text_col), "pii-terms")
    # The threshold asks for docs <= both * (documents / own) ** (1 - threshold), and both <= own: a term of more
    # documents than ``most`` needs an entity in over 1 of 100.  Either list is at most some 100 times what one
    # document holds, however large the corpus.
    often, spare = documents / 100, max(documents, 1) ** (1 - rule.threshold)
    most = often ** rule.threshold * spare
    common = {r.term for r in counts.where(F.col("docs") > most * (1 + 1e-9)).select("term").collect()}
    frequent = {r.entity for r in own.where(F.col("own") > often).select("entity").collect()}
    firsts_too = holders.join(firsts, "row", "left").withColumn("first", F.coalesce("first", F.lit(0)))
    joined = (term_pairs(firsts_too, rule, common, frequent).join(counts, "term")
              .where(F.col("docs") <= F.col("both") * F.lit(spare * (1 + 1e-9)))
              .join(own, "entity").where(F.col("own") < documents))
    total = F.lit(float(documents))
    pmi = F.log2(total * F.col("both") / (F.col("own") * F.greatest("docs", "both")))
    q = F.col("apart") / F.col("own_apart")
    p = F.least((F.greatest("docs", "both") - F.col("both") + F.col("apart")) / total, F.lit(1.0))
    rest = F.when(q < 1, (1 - q) * F.log2((1 - q) / F.greatest(1 - p, F.lit(1e-18)))).otherwise(0.0)
    bits = F.when((F.col("apart") > 0) & (q > p), F.col("own_apart") * (q * F.log2(q / p) + rest)).otherwise(0.0)
    return (joined.withColumn("disclosure", pmi / F.log2(total / F.col("own")))
            .where((F.col("disclosure") >= rule.threshold) & (bits >= -math.log2(rule.significance) - 1e-9))
            .select("entity", "term", "disclosure", "docs"))


def bloom_bits(terms: DataFrame, most_bits: int = 2**28) -> np.ndarray:
    """A Bloom filter of ``term``, as bytes: 32 to 64 bits a term up to ``most_bits``, then fewer."""
    size = min(most_bits, max(2**16, 1 << (32 * terms.count()).bit_length()))

    def places(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([p for t in batch.column(0).to_pylist() for p in probes(t, size)],
                                                       type=pa.int64())], names=["place"])

    parts = (terms.select("term").mapInArrow(places, "place bigint")
             .groupBy(F.expr("place div 32768").alias("part"))
             .agg(F.bitmap_construct_agg(F.col("place") % 32768).alias("bits")))
    out = np.zeros(size // 8, dtype=np.uint8)
    for part, bits in parts.collect():                         # most_bits at most
        out[part * 4096:(part + 1) * 4096] = np.frombuffer(bits, dtype=np.uint8)
    return out


def probes(term: str, size: int) -> list[int]:
    import xxhash
    h = xxhash.xxh64_intdigest(term, 11)
    step = (h >> 32) | 1
    return [(h + i * step) % size for i in range(4)]


def mark_rows(df: DataFrame, terms: DataFrame, rule: Disclosure, text_col: str, row: str, spans: str,
              likely: str) -> DataFrame:
    """``df`` with a number of the row, its base spans and, with ``everywhere``, the terms that pass the Bloom filter."""
    marked = add_base_spans(df, text_col, spans).withColumn(row, F.monotonically_increasing_id())
    if not rule.everywhere:
        return marked.withColumn(likely, F.array().cast("array<string>"))
    bits = df.sparkSession.sparkContext.broadcast(bloom_bits(terms.select("term").distinct()))

    @F.arrow_udf("array<string>")
    def find(text: pa.Array) -> pa.Array:
        table = memoryview(bits.value)
        size, known = 8 * len(table), {}
        def passes(t: str) -> bool:
            return all(table[p >> 3] >> (p & 7) & 1 for p in probes(t, size))
        out = []
        for t in text.to_pylist():
            words = {w.casefold() for w in _WORD.findall(t or "")}
            for w in words:
                if w not in known:
                    known[w] = passes(w)
            out.append([w for w in words if known[w]])
        return pa.array(out, type=pa.list_(pa.string()))

    return marked.withColumn(likely, find(F.col(text_col)))


def terms_by_row(marked: DataFrame, terms: DataFrame, documents: int, rule: Disclosure) -> DataFrame:
    """(row, terms) of the rows (row, text, spans, likely): the terms to generalise in each."""
    if not rule.everywhere:
        held = entity_rows(marked.where(F.size("spans") > 0)).select("row", "entity")
        found = held.join(terms.select("entity", "term"), "entity").select("row", "term")
    else:
        hits = marked.select("row", F.explode("likely").alias("term"))
        known = terms.groupBy("term").agg(F.first("docs").alias("docs"))
        often = F.broadcast(known.where(F.col("docs") > documents / 100))   # some 100 times what one document holds
        seldom = known.where(F.col("docs") <= documents / 100)
        found = (hits.join(often, "term", "left_semi")
                 .unionByName(hits.join(often, "term", "left_anti").join(seldom, "term", "left_semi")))
    return found.groupBy("row").agg(F.collect_set("term").alias("terms"))


def disclosed(df: DataFrame, text_col: str, rule: Disclosure) -> tuple[DataFrame, int]:
    """(entity, term, disclosure, docs) rows of the texts of ``df``, and the number of its documents."""
    found = (add_base_spans(df.select(F.col(text_col).alias("text"))).where(F.size("spans") > 0)
             .withColumn("row", F.monotonically_increasing_id()))
    documents = df.count()
    found = materialize(found, "pii-found")
    return materialize(disclosing_terms(found, df, documents, text_col, rule), "pii-disclosing"), documents


def sanitise_rows(marked: DataFrame, terms: DataFrame, documents: int, rule: Disclosure) -> DataFrame:
    """(row, spans, clean_text) of the rows (row, text, spans, likely) that hold a base span or a likely term."""

    @F.arrow_udf(f"struct<spans:{SPANS},clean_text:string>")
    def apply(text: pa.Array, spans: pa.Array, terms: pa.Array) -> pa.Array:
        out = []
        for t, s, w in zip(text.to_pylist(), spans.to_pylist(), terms.to_pylist()):
            base = _tuples(s)
            every = base + find_terms(t, base, set(w or ()))
            out.append({"spans": [{"kind": k, "start": a, "end": b} for k, a, b in every], "clean_text": clean_text(t, every)})
        return pa.array(out, type=pa.struct([("spans", ARROW_SPANS), ("clean_text", pa.string())]))

    done = (marked.join(terms_by_row(marked, terms, documents, rule), "row", "left")
            .select("row", apply("text", "spans", "terms").alias("done")))
    return done.select("row", "done.spans", "done.clean_text")


def joined_spans(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    part = F.filter(spans, lambda s: s["kind"] != "term") if base_only else spans
    return F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rule: Disclosure = Disclosure()) -> DataFrame:
    """(``id_col``, spans) of every row of ``df``: base spans and disclosing terms, in SPANS form.

    Null and empty texts have no span; repeated rows are separate documents
    with the same spans; a null id is kept.
    """
    terms, documents = disclosed(df, text_col, rule)
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    touched = (F.size("spans") > 0) | (F.size("likely") > 0)
    marked = mark_rows(texts, terms, rule, "text", "row", "spans", "likely").withColumn("text", F.when(touched, F.col("text")))
    marked = materialize(marked, "pii-rows")
    held = marked.where(touched)
    done = sanitise_rows(held.select("row", "text", "spans", "likely"), terms, documents, rule)
    return (held.select("id", "row").join(done.select("row", "spans"), "row").select("id", "spans")
            .unionByName(marked.where(~touched).select("id", "spans"))
            .withColumnRenamed("id", id_col))


def sanitise(df: DataFrame, text_col: str = "text", rule: Disclosure = Disclosure()) -> DataFrame:
    """``df`` with personal data and disclosing terms generalised in ``text_col``; all rows and columns stay."""
    row, spans, likely, clean = (free_name(df, c) for c in ("row_number", "spans", "likely_terms", "clean_text"))
    terms, documents = disclosed(df, text_col, rule)
    marked = materialize(mark_rows(df, terms, rule, text_col, row, spans, likely), "pii-rows")
    touched = (F.size(spans) > 0) | (F.size(likely) > 0)
    held = marked.where(touched)
    done = sanitise_rows(held.select(*[F.col(c).alias(n) for c, n in (
        (row, "row"), (text_col, "text"), (spans, "spans"), (likely, "likely"))]), terms, documents, rule)
    changed = (held.join(done.select(F.col("row").alias(row), F.col("clean_text").alias(clean)), row)
               .select(*[F.col(clean).alias(c) if c == text_col else F.col(c) for c in df.columns]))
    return changed.unionByName(marked.where(~touched).select(*df.columns))
