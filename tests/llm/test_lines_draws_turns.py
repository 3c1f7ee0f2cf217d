"""Line dedup, importance resampling and conversation repair against plain brute force."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import pytest
from pyspark.sql import functions as F

from letrado.llm import conversation_repair, importance, line_dedup, role_runs
from letrado.llm.common import prepare
from letrado.llm.queries import ORACLE, QUERIES

from conftest import SF_SMALL, rows

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WHITE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- line dedup ------------------------------------------------------------------

def brute_lines(docs):
    """docs: (id, text).  Null ids: equal texts are one document, behind all ids, in the order of their hashes; so
    the brute force is only asked for tables in which no line is shared between null ids alone."""
    def unit(i, t):
        return (1, t or "") if i is None else (0, i)

    def key(line):
        return line.strip(WHITE).translate(LOWER)

    first = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= 10:
                first[k] = min(first.get(k, unit(i, t)), unit(i, t))
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == unit(i, t)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def dedup(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = line_dedup.dedup_lines(df, out_col="l", **options)
    return sorted(rows(found.select("doc_id", "l.n_lines", "l.n_dropped", "l.clean_text")), key=str)


LINES = ["Alpha beta gamma delta", "  alpha BETA gamma delta\t", "short", "", "  ", "ÉTÉ en été à la mer", "été EN été à la mer",
         "Été en été à la mer", "x" * 9, "x" * 10, "X" * 10, "\x0b" + "y" * 12 + "\x0c", "y" * 12, "a b c d e f g", " wide blank edges "]


@pytest.mark.parametrize("batches, fanout", [(1, 4), (5, 2), (8, 4)])
def test_line_dedup_equals_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    docs = [(i, "\n".join(rng.choice(LINES) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    docs += [(3, docs[3][1]), (70, None), (71, ""), (72, "\n\n"), (-5, "the hot line of all\nown words of -5 here"),
             (None, None), (None, "Alpha beta gamma delta\nonly here, without id"), (7, "a second text of id 7\nAlpha beta gamma delta")]
    docs = [(i, t if t is None or rng.random() < 0.5 else t + "\nThe hot line of all") for i, t in docs]
    assert dedup(spark, docs, batches=batches, fanout=fanout) == sorted(brute_lines(docs), key=str)


def test_line_dedup_long_texts_are_searched_by_halves(spark):
    long = "\n".join(f"line number {i} of a long text" for i in range(5000))
    odd = "\n".join(f"line number {i} of a long text" for i in range(1, 5000, 2))
    docs = [(2, long), (1, odd), (3, long + "\n" + "z" * 200_000), (4, "z" * 200_000)]
    assert dedup(spark, docs) == sorted(brute_lines(docs), key=str)


def test_line_dedup_edge_tables(spark, no_rows, clashing, messy_rows):
    assert line_dedup.dedup_lines(no_rows).count() == 0
    out = line_dedup.dedup_lines(clashing)
    assert out.count() == len(messy_rows) and set(clashing.columns) < set(out.columns)
    named = clashing.withColumnsRenamed({"kept": "line_kept", "id": "unit", "row": "no_id"}).withColumn("h1", F.lit(1))
    assert line_dedup.dedup_lines(named).count() == len(messy_rows)


def test_line_runs_are_compacted_in_levels_and_dropped(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(7):
        batch = spark.range(b * 10, b * 10 + 15).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"),
                                                        F.lit(b).cast("long").alias("unit"), F.lit(False).alias("no_id"))
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    assert runs.rows().count() == 75 == runs.rows().select("h1").distinct().count()
    held = spark.range(5).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"))
    plan = held.groupBy("h1", "h2").count().join(spark.table(runs.runs()[0]).hint("merge").select("h1", "h2"), ["h1", "h2"], "left_anti")
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan      # the batch moves, the run does not
    names = runs.runs()
    runs.drop()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_line_dedup_is_native(spark):
    plan = QUERIES["op11_line_dedup"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapInPandas" not in plan


def test_line_dedup_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(ORACLE["op11_line_dedup"]).fetchall()
    assert sorted(rows(QUERIES["op11_line_dedup"](spark, SF_SMALL))) == sorted(want)


# -- importance resampling ---------------------------------------------------------

def brute_draw(docs, target, draw=importance.Draw()):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        runs = [" ".join(words[i:i + n]) for n in range(1, draw.max_run + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % draw.buckets for r in runs]

    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()) + draw.buckets, sum(t.values()) + draw.buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    out = []
    for i, n, f in found:
        h = int(sha(f"{draw.seed}:{'' if i is None else i}")[:8], 16)
        weight = sum(map(gain, f)) // len(f) if f else 0
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= draw.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(able[:draw.percent * len(able) // 100], 1)}
    return [(r[0], *r[2:], rank.get(id(r))) for r in out]


def draw_table(spark, docs, target, draw=importance.Draw()):
    prepare(spark)
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                              spark.createDataFrame([(x,) for x in target], "text string"), draw=draw)
    return sorted(rows(got, "doc_id", "n_features", "weight", "score", "rank"), key=str)


@pytest.mark.parametrize("draw", [importance.Draw(), importance.Draw(max_run=2, buckets=300, min_words=3, percent=37)])
def test_draw_equals_brute_force(spark, draw):
    rng = random.Random(4)
    vocabulary = ["Ärger", "word", "TEXT", "42", "ünï", "naïve", "日本", "a'b", "x-y", "zu"] + ["w%d" % i for i in range(80)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    docs += [(900, None), (901, ""), (902, " .-! "), (903, "q" * 100_000), (None, docs[5][1]), (-4, docs[6][1])]
    target = ["word TEXT 42 naïve", None, "", "ünï ünï w1 w2"]
    assert draw_table(spark, docs, target, draw) == sorted(brute_draw(docs, target, draw), key=str)


def test_draw_with_ties_and_repeated_rows(spark):
    text = " ".join(["same"] * 30)
    docs = [(1, text)] * 40 + [(2, text)] * 40 + [(None, text)] * 40
    draw = importance.Draw(percent=55)
    assert draw_table(spark, docs, ["same"], draw) == sorted(brute_draw(docs, ["same"], draw), key=str)
    every = importance.Draw(percent=100)
    assert draw_table(spark, docs, [], every) == sorted(brute_draw(docs, [], every), key=str)


def test_draw_edge_tables(spark, no_rows, clashing, messy_rows):
    assert importance.resample(no_rows, no_rows).count() == 0
    assert importance.resample(clashing, clashing).count() == len(messy_rows)
    assert draw_table(spark, [(1, "too few words")], ["x"])[0][4] is None


def test_bisection_counts_exactly(spark):
    values = spark.createDataFrame([(v,) for v in [5] * 7 + [-3, 0, 9, 9, 1 << 40]], "v long").cache()
    every = sorted(r[0] for r in values.collect())
    for need in range(1, len(every) + 1):
        assert importance.bisect(values, F.col("v"), every[0], every[-1], need) == every[need - 1]


def test_draw_query_equals_brute_force(spark):
    docs = rows(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id", "text")
    target = [r[0] for r in rows(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"), "text")]
    got = sorted(rows(QUERIES["op12_importance_resampling"](spark, SF_SMALL), "doc_id", "n_features", "weight", "score", "rank"), key=str)
    assert got == sorted(brute_draw(docs, target), key=str)


# -- conversation repair ------------------------------------------------------------

def brute_damage(conversations):
    out = []
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def brute_audit(kinds):
    """kinds: (letter, must_delete, truncated); least cost, then the ASCII-least edits, over all edits."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def best(at, last, inserted):
        options = [(0, "")] if at == len(kinds) and last in ("", "a") else []
        if inserted < 3:
            cost, rest = best(at, following[last], inserted + 1)
            options.append((cost + 5, "I" + rest))
        if at < len(kinds):
            letter, must, cut = kinds[at]
            cost, rest = best(at + 1, last, 0)
            options.append((cost + 2, "D" + rest))
            if not must:
                extra = 5 if cut else 0
                if letter == following[last] or (letter == "s" and last == ""):
                    cost, rest = best(at + 1, letter, 0)
                    options.append((cost + extra, "K" + rest))
                cost, rest = best(at + 1, following[last], 0)
                options.append((cost + extra + 1, "R" + rest))
        return min(options, default=(10**9, ""))

    for at in range(len(kinds), 0, -1):         # from the end, so that no call goes deep
        for last in following:
            best(at, last, 0)
    return best(0, "", 0)


def brute_repair(conversations):
    out = []
    after = brute_damage(conversations)
    for conv in {c[0] for c in conversations}:
        turns = sorted((t for t in after if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3]))
        kinds, seen, counts = [], set(), Counter()
        for _, _, role, text in turns:
            last = text.rstrip(WHITE)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = brute_audit(tuple(kinds))
        lines, at, last = [], 0, ""
        for edit in audit:
            if edit == "K":
                last = turns[at][2][0]
                lines.append(f"{turns[at][2]}:{turns[at][3]}")
            elif edit != "D":
                last = "a" if last == "u" else "u"
                lines.append(("assistant:" if last == "a" else "user:") + (turns[at][3] if edit == "R" else ""))
            at += edit != "I"
        numbers = {t[1] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def repair(spark, conversations, **options):
    prepare(spark)
    df = spark.createDataFrame(conversations, SCHEMA).repartition(3)
    return sorted(rows(conversation_repair.repair_turns(conversation_repair.damage(df), **options)), key=str)


def talk(rng, conv, n):
    texts = ["Fine.", "Fine!", "cut off", " ", "", "Why?  ", "ends with blank. \n", "é ", None, "really long " * 5]
    return [(conv, rng.choice([t, t, t, None]) if rng.random() < 0.1 else t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             rng.choice(texts) if rng.random() < 0.5 else f"unique {conv} {t}.") for t in range(n)]


def test_automaton_equals_brute_force():
    rng = random.Random(8)
    for n in [*range(9)] * 25 + [14, 20]:
        kinds = []
        for _ in range(n):
            kinds += [(rng.choice("suuaax"), rng.random() < 0.2, rng.random() < 0.3)] * rng.choice([1, 1, 1, 2, 5])
        kinds = kinds[:30]
        symbols = bytes(role_runs.symbol(a, b, c and not b) for a, b, c in kinds)
        cost, audit = brute_audit(tuple((a, b, c and not b) for a, b, c in kinds))
        assert role_runs.repair(symbols) == (audit, cost)
        assert int(role_runs.apply(role_runs.transition(symbols), role_runs.AT_END)[0]) == cost


def test_powers_are_repeated_products():
    for sym in range(9):
        step, out = role_runs.power(sym, 0), role_runs.IDENTITY
        for n in range(1, 40):
            out = role_runs.times(out, step)
            assert role_runs.transition(bytes([sym]) * n) == out


@pytest.mark.parametrize("chunk_turns", [3, 4096])
def test_repair_equals_brute_force(spark, chunk_turns):
    rng = random.Random(chunk_turns)
    talks = [t for conv in range(40) for t in talk(rng, conv, rng.randint(1, 9))]
    talks += talk(rng, 99, 160) + talk(rng, None, 12) + [(50, None, "user", "Same.")] * 30 + [(51, 5, "user", None), (52, None, None, None)]
    assert repair(spark, talks, chunk_turns=chunk_turns) == brute_repair(talks)


def test_one_conversation_with_most_turns_lies_in_many_tasks(spark):
    rng = random.Random(3)
    talks = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Ok.", f"text {t}", f"Text {t}."])) for t in range(600)]
    prepare(spark)
    packed = conversation_repair.chunks(conversation_repair.damage(spark.createDataFrame(talks, SCHEMA)), 100)
    sizes = [r[0] for r in packed.select(F.size("roles")).collect()]
    assert max(sizes) <= 100 and len(sizes) >= 6
    assert repair(spark, talks, chunk_turns=100) == brute_repair(talks)


def test_repair_edge_tables(spark):
    prepare(spark)
    assert repair(spark, []) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert repair(spark, [(1, dropped, "user", "Gone.")]) == [(1, 0, 0, 0, 0, 0, 0, "", sha(""))]
    long = [(1, t, "user", "x" * 300_000 + ".") for t in range(4)]
    assert repair(spark, long) == brute_repair(long)
    extra = spark.createDataFrame([(1, 2, "user", "Hi.", 5, True)], SCHEMA + ", chunk long, alive boolean")
    assert conversation_repair.repair_turns(conversation_repair.damage(extra)).count() == 1


def test_repair_query_equals_brute_force(spark):
    talks = rows(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"), "conv_id", "turn", "role", "text")
    assert sorted(rows(QUERIES["op13_conversation_repair"](spark, SF_SMALL)), key=str) == brute_repair(talks)
