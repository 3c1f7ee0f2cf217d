"""Operator 6."""

import random
import re

from pyspark.sql import functions as F

from conftest import rows
from letrado.llm import pii
from letrado.llm.common import prepare

PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", lambda m, d: True),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", lambda m, d: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", lambda m, d: 13 <= len(d) <= 19 and pii.luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 9 <= len(d) <= 15),
]


def plain_base(text):
    return [(kind, m.start(), m.end()) for kind, pattern, good in PLAIN for m in re.finditer(pattern, text)
            if good(m[0], re.sub("[^0-9]", "", m[0]))]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    bits = ["a", "b@", "@", ".", "x.y", "-", "1", "2.", "3", "4111111111111111", " ", "+1", "(", "00", ".5", "é", "+49 "]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(22)))
        assert pii.find_base(text) == plain_base(text)
    assert pii.find_base(None) == pii.find_base("") == []
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "@" * 200_000, "a@b." * 50_000, "+1 " * 60_000, "1.2.3." * 40_000):
        pii.find_base(text)


def test_spans_are_generalised():
    text = "Ask Maria at m@x.org or 10.0.0.1 now"
    base = pii.find_base(text)
    spans = base + pii.find_terms(text, base, {"maria", "org"})
    assert pii.clean_text(text, spans) == "Ask [NAME] at [EMAIL] or [IP] now"


def corpus(spark):
    """A name that stands only by one address, beside words that stand everywhere."""
    rng = random.Random(3)
    common = [f"word{i}" for i in range(40)]
    docs = []
    for i in range(200):
        words = rng.sample(common, 12)
        if i % 20 == 0:
            words[4:4] = ["Zebulon", f"zeb@corp.example.com", "Street"]
        if i == 7:
            words.append("Zebulon")                            # a document without the address keeps the name
        if i % 20 == 1:
            words.append("Street")
        docs.append((i, " ".join(words)))
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_disclosing_terms_equal_brute_force(spark):
    prepare(spark)
    docs = corpus(spark)
    rule = pii.Disclosure(threshold=0.8)
    found = dict(rows(pii.scan_documents(docs, rule=rule).select("doc_id", pii.joined_spans(F.col("spans")).alias("s"))))
    texts = dict(rows(docs))
    import math
    holders = [i for i in texts if "@" in texts[i]]
    near = {}
    for i in holders:
        words = texts[i].replace("zeb@corp.example.com", "@").split(" ")
        at = words.index("@")
        near[i] = {w.casefold() for w in words[max(0, at - 8):at] + words[at + 1:at + 9]}
    everywhere = {i: {w.casefold() for w in re.findall(r"[^\W_]+", t)} for i, t in texts.items()}
    terms = set()
    for t in set().union(*near.values()):
        both, own, all_ = sum(t in near[i] for i in holders), len(holders), sum(t in everywhere[i] for i in texts)
        pmi = math.log2(len(texts) * both / (own * max(all_, both)))
        contexts = len({min(pii_hash(w) for w in near[i]) for i in holders if t in near[i]})
        if contexts >= 3 and pmi / math.log2(len(texts) / own) >= 0.8:
            terms.add(t)
    assert "zebulon" in terms and not any(t.startswith("word") for t in terms)
    for i, t in texts.items():
        base = plain_base(t)
        want = base + ([("term", m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t) if m[0].casefold() in terms
                        and not any(s < m.end() and m.start() < e for _, s, e in base)] if base else [])
        assert found[i] == ",".join(f"{k}:{s}:{e}" for k, s, e in want)


def pii_hash(word):
    import xxhash
    return xxhash.xxh64_intdigest(word, 7)


def test_sanitised_documents(spark):
    prepare(spark)
    docs = corpus(spark)
    out = dict(rows(pii.sanitise(docs, rule=pii.Disclosure(threshold=0.8))))
    before = dict(rows(docs))
    assert len(out) == 200 and not any("@" in t for t in out.values())
    assert "Zebulon" in out[7] and out[7] == before[7] and "Zebulon" not in out[0] and "[EMAIL]" in out[0]
    assert all(out[i] == before[i] for i in out if "@" not in before[i])


def test_copies_are_one_context(spark):
    prepare(spark)
    text = "some rare surroundings of joe@corp.example.com in a copied passage"
    docs = spark.createDataFrame([(i, text if i < 50 else f"other text number {i}") for i in range(150)],
                                 "doc_id long, text string")
    spans = {r.s for r in pii.scan_documents(docs).select(pii.joined_spans(F.col("spans")).alias("s")).collect()}
    assert spans == {"", "email:26:46"}


def term_texts(spark, texts, **rule):
    """Doc id -> the words generalised as terms."""
    found = pii.scan_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                               rule=pii.Disclosure(**rule))
    return {r.doc_id: {texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "term"} for r in found.collect()}


def test_names_of_one_and_two_documents_and_a_repeated_signature(spark):
    prepare(spark)
    rng = random.Random(5)
    common = [f"word{i}" for i in range(40)]
    texts = [" ".join(rng.sample(common, 12)) for _ in range(400)]
    texts[3] = "word1 word2 Quentin quentin1@corp.example.com word3 word4"
    for i in (50, 51):
        texts[i] += f" Ottilie 10.1.2.3 word{i - 45}"
    signed = "Regards Maria Lopez Acme High Street 12 mlopez@acme.example.com"
    for i in range(100, 106):
        texts[i] = f"{' '.join(rng.sample(common, 9))} {signed}"
    got = term_texts(spark, texts)
    assert got[3] == {"Quentin"} and got[50] == got[51] == {"Ottilie"}
    assert all(got[i] == {"Regards", "Maria", "Lopez", "Acme", "High", "Street"} for i in range(100, 106))
    assert not any(got[i] for i in range(400) if i not in (3, 50, 51) and not 100 <= i < 106)
    copied = term_texts(spark, texts[:300] + [texts[3]] * 100)
    assert copied[3] == copied[399] == {"Quentin"}             # copies count once, and are all generalised


def test_terms_far_from_the_entity(spark):
    prepare(spark)
    rng = random.Random(6)
    common = [f"word{i}" for i in range(40)]
    texts = [" ".join(rng.sample(common, 30)) for _ in range(400)]
    for i in range(0, 60, 10):                                 # the heading far off, once beside the address
        texts[i] = f"Ferdinand {'' if i == 20 else texts[i]} call +49 30 1234567 now"
    got = term_texts(spark, texts)
    assert all("Ferdinand" in got[i] for i in range(0, 60, 10))
    assert not any(w.startswith("word") for words in got.values() for w in words)


def test_terms_go_in_every_document_that_holds_them(spark):
    prepare(spark)
    rng = random.Random(7)
    common = [f"word{i}" for i in range(40)]
    texts = [" ".join(rng.sample(common, 12)) for _ in range(400)]
    for i in range(10):
        texts[20 * i] += " Zebulon zeb@corp.example.com"
    texts[7] += " Zebulon"                                     # without the address
    got = term_texts(spark, texts, everywhere=True)
    assert got[0] == got[180] == got[7] == {"Zebulon"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = dict(rows(pii.sanitise(docs, rule=pii.Disclosure(everywhere=True))))
    assert len(out) == 400 and not any("Zebulon" in t for t in out.values())
    assert all(out[i] == t for i, t in enumerate(texts) if "Zebulon" not in t)
    few = pii.bloom_bits(spark.createDataFrame([("zebulon",)], "term string"))
    assert all(few[p >> 3] >> (p & 7) & 1 for p in pii.probes("zebulon", 8 * len(few)))


def test_query_and_pipeline_generalise_everywhere(spark, monkeypatch):
    import corpus_pipeline
    from letrado.llm import queries
    used = []
    scan, clean = pii.scan_documents, pii.sanitise
    monkeypatch.setattr(pii, "scan_documents", lambda *a, rule=pii.Disclosure(), **b: used.append(rule) or scan(*a, rule=rule, **b))
    monkeypatch.setattr(pii, "sanitise", lambda *a, rule=pii.Disclosure(), **b: used.append(rule) or clean(*a, rule=rule, **b))
    queries.op6_pii(spark, "/root/testdata/sf0.001")
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    corpus_pipeline.pii(spark, docs, "/root/testdata/sf0.001")
    assert len(used) == 2 and all(rule.everywhere for rule in used)


def test_messy_rows(clashing, messy_rows, no_rows):
    found = pii.scan_documents(clashing)
    assert found.columns == ["doc_id", "spans"] and found.count() == len(messy_rows)
    assert {r.doc_id: len(r.spans) for r in found.collect()}[19] == 1
    clean = pii.sanitise(clashing)
    assert clean.columns == clashing.columns and clean.count() == len(messy_rows)
    assert clean.where("doc_id = 19").first().text == "Mail [EMAIL] now"
    assert clean.where("text is null").count() == sum(r[1] is None for r in messy_rows)
    assert pii.scan_documents(no_rows).count() == pii.sanitise(no_rows).count() == 0
