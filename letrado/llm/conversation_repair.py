"""Conversation structure repair: fewest-cost edits to ``(s?(ua)+)?`` by run-length DP.

Turns are range-partitioned by (conversation, turn), so a conversation that holds
a third of all turns lies in many tasks.  Each task packs its turns into chunks of
one conversation, at most CHUNK_TURNS turns or CHUNK_CHARS characters each.  A
chunk that is a whole conversation is repaired where it is.  The others ("open":
at most two a task, and the chunks of long conversations) go on as summaries:

1. texts seen in an earlier chunk of the conversation are marked,
2. each chunk's runs become one min-plus transition,
3. a backward scan of the transitions gives the costs of all that follows a chunk,
4. each chunk unrolls its choices from all four states, a forward scan of the
   resulting states gives the one in which it starts,
5. each chunk writes its edits and its repaired turns; a last scan joins them.

The scans stream over one summary a chunk, and hold one at a time; only the last
one moves text, because one hash covers a conversation's whole repaired text.

* turns are ordered by turn (nulls first), then by role, the first 64 characters
  of the text and its hash; turns equal in all of these stand side by side
* null role, text, turn or conversation id: one space where a text is needed;
  null ids are one conversation; null turns are left out of the gaps
* repeated rows are turns of their own (all but the first are duplicates)
* a conversation without turns has zeros, an empty audit and the hash of ""
* an empty table gives an empty table; other columns are not returned
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letrado.llm import role_runs
from letrado.llm.common import prepare, table_partitions
from letrado.session import materialize

CHUNK_TURNS = 4096
CHUNK_CHARS = 4_000_000
_WHITE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_FACTS = ["n_turns", "first_turn", "last_turn", "distinct_turns", "first_initial", "last_initial", "blank", "duplicate",
          "truncated", "illegal"]


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: by crc32(conv_id:turn) % 20 a turn is dropped (``alive`` false), emptied, stripped of
    its sentence marks, repeated, or given to the user."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    coded = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"),
                                 (F.crc32(key.cast("binary")) % 20).cast("int").alias("code"))
    code, alive = F.col("code"), F.col("code") != 0
    return coded.select(
        "conv_id", "turn", alive.alias("alive"),
        F.when(alive, F.when(code == 4, F.lit("user")).otherwise(F.col("role"))).alias("role"),
        F.when(alive, F.when(code == 1, F.lit("")).when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _field(df: DataFrame, name: str, to: str | None = None) -> str:
    return f"`{to or name}` {df.schema[name].dataType.simpleString()}"


def chunks(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """(conv_id, chunk, open, turn numbers, roles, texts, hashes): conversations cut at task borders and at
    ``chunk_turns``; chunk numbers rise along a conversation."""
    h1, h2 = F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "role", "text")
    keyed = turns.select("conv_id", "turn", "alive", "role", "text", F.when(F.col("alive"), h1).alias("h1"),
                         F.when(F.col("alive"), h2).alias("h2"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
             F.substring("text", 1, 64).asc_nulls_first(), F.col("h1").asc_nulls_first(), F.col("row").asc()]
    placed = keyed.repartitionByRange(table_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    conv_type, turn_type = (placed.schema[c].dataType for c in ("conv_id", "turn"))
    out = pa.schema([("conv_id", _arrow(conv_type)), ("chunk", pa.int64()), ("open", pa.bool_()),
                     ("turns", pa.list_(_arrow(turn_type))), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                     ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int64()))])

    def pack(batches):
        base = TaskContext.get().partitionId() << 33
        ready, number, held = [], 0, None

        def close(opened):
            nonlocal number, held
            ready.append((held[0], base + number, opened or held[1], *held[2]))
            number += 1
            held = None

        for batch in batches:
            conv, turn, alive, role, text, a, b = (c.to_pylist() for c in batch.columns[:7])
            for i in range(len(conv)):
                if held is not None and held[0] != conv[i]:
                    close(False)
                elif held is not None and (len(held[2][0]) >= chunk_turns or held[3] > CHUNK_CHARS):
                    close(True)
                    held = [conv[i], True, ([], [], [], [], []), 0]
                if held is None:
                    held = [conv[i], number == 0, ([], [], [], [], []), 0]
                if alive[i]:
                    for to, value in zip(held[2], (turn[i], role[i], text[i], a[i], b[i])):
                        to.append(value)
                    held[3] += len(text[i])
            yield from _batches(ready, out, 512)
        if held is not None:
            close(True)
        yield from _batches(ready, out, 1)

    ddl = ", ".join([_field(placed, "conv_id"), "chunk long, open boolean",
                     f"turns array<{turn_type.simpleString()}>, roles array<string>, texts array<string>, "
                     "h1 array<bigint>, h2 array<bigint>"])
    return placed.mapInArrow(pack, ddl)


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def _batches(ready: list, schema: pa.Schema, least: int):
    """Arrow batches of the rows in ``ready`` once there are ``least`` of them; empties ``ready``."""
    if len(ready) >= least:
        columns = list(zip(*ready))
        ready.clear()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def judge(turns: list, roles: list[str], texts: list[str], seen) -> tuple[bytes, tuple]:
    """(symbols, facts) of a chunk; ``seen`` marks turns whose role and text an earlier chunk holds."""
    symbols, known = bytearray(), set()
    blank = duplicate = truncated = illegal = 0
    before = None
    for i, (role, text) in enumerate(zip(roles, texts)):
        bad, cut = False, False
        content = text.rstrip(_WHITE)
        if not content:
            blank, bad = blank + 1, True
        elif (role, text) in known or (seen is not None and seen[i]):
            duplicate, bad = duplicate + 1, True
        else:
            cut = content[-1] not in ".!?"
            truncated += cut
        known.add((role, text))
        symbols.append(role_runs.symbol(role, bad, cut))
        initial = role[:1]
        illegal += before is not None and before + initial not in _LEGAL
        before = initial
    numbered = [t for t in turns if t is not None]
    return bytes(symbols), (len(roles), numbered[0] if numbered else None, numbered[-1] if numbered else None,
                            len(set(numbered)), roles[0][:1] if roles else None, before, blank, duplicate, truncated, illegal)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def repair_closed(closed: DataFrame) -> DataFrame:
    """One row per conversation that is one chunk."""
    schema = _result_schema(closed)

    def run(batches):
        for batch in batches:
            rows = []
            for conv, turns, roles, texts in zip(*(c.to_pylist() for c in batch.columns)):
                symbols, facts = judge(turns, roles, texts, None)
                audit, cost = role_runs.repair(symbols)
                lines = role_runs.write(audit, roles, texts, role_runs.EMPTY)
                gaps = facts[2] - facts[1] + 1 - facts[3] if facts[1] is not None else 0
                rows.append((conv, gaps, *facts[6:], cost, audit, _sha("\n".join(lines))))
            yield from _batches(rows, schema, 1)

    return closed.select("conv_id", "turns", "roles", "texts").mapInArrow(run, _result_ddl(closed))


def _result_schema(df: DataFrame) -> pa.Schema:
    return pa.schema([("conv_id", _arrow(df.schema["conv_id"].dataType)), *[(c, pa.int64()) for c in _COUNTS],
                      ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _result_ddl(df: DataFrame) -> str:
    return ", ".join([_field(df, "conv_id"), *[f"{c} long" for c in _COUNTS], "audit string", "repaired_sha256 string"])


def _seen_earlier(opened: DataFrame) -> DataFrame:
    """(chunk, seen): the hashes of a chunk that an earlier chunk of its conversation holds.  A chunk sends each
    hash once, so a text that stands in a third of all turns is one row a chunk."""
    pairs = F.array_distinct(F.arrays_zip(F.col("h1").alias("h1"), F.col("h2").alias("h2")))
    each = opened.select("conv_id", "chunk", F.inline(pairs))
    first = each.groupBy("conv_id", "h1", "h2").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    null_safe = F.col("e.conv_id").eqNullSafe(F.col("f.conv_id"))
    again = (each.alias("e").join(first.alias("f"), null_safe & (F.col("e.h1") == F.col("f.h1"))
                                  & (F.col("e.h2") == F.col("f.h2")) & (F.col("e.chunk") > F.col("f.first")))
             .select("e.chunk", F.struct("e.h1", "e.h2").alias("pair")))
    return again.groupBy("chunk").agg(F.collect_list("pair").alias("seen"))      # at most one entry a turn of the chunk


def _judged(opened: DataFrame) -> DataFrame:
    """Open chunks as summaries: symbols, transition and facts."""
    marked = opened.join(_seen_earlier(opened), "chunk", "left").select("conv_id", "chunk", "turns", "roles", "texts", "h1",
                                                                         "h2", "seen")
    turn_type = opened.schema["turns"].dataType.elementType
    kinds = {"first_turn": turn_type, "last_turn": turn_type}
    schema = pa.schema([("conv_id", _arrow(opened.schema["conv_id"].dataType)), ("chunk", pa.int64()), ("symbols", pa.binary()),
                        ("matrix", pa.list_(pa.float64())),
                        *[(c, _arrow(kinds[c]) if c in kinds else pa.string() if "initial" in c else pa.int64()) for c in _FACTS]])
    ddl = ", ".join([_field(opened, "conv_id"), "chunk long, symbols binary, matrix array<double>",
                     *[f"{c} {kinds[c].simpleString() if c in kinds else 'string' if 'initial' in c else 'long'}" for c in _FACTS]])

    def run(batches):
        for batch in batches:
            rows = []
            for conv, chunk, turns, roles, texts, a, b, seen in zip(*(c.to_pylist() for c in batch.columns)):
                earlier = {(s["h1"], s["h2"]) for s in seen or ()}
                symbols, facts = judge(turns, roles, texts, [p in earlier for p in zip(a, b)] if earlier else None)
                rows.append((conv, chunk, symbols, [c for row in role_runs.transition(symbols) for c in row], *facts))
            yield from _batches(rows, schema, 1)

    return marked.mapInArrow(run, ddl)


def _in_order(df: DataFrame, *order) -> DataFrame:
    """Conversations side by side, each in one task: one summary a chunk, streamed."""
    return (df.repartition(table_partitions(df.sparkSession), "conv_id")
              .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order))


def _scan(df: DataFrame, cols: list[str], out_ddl: str, out_fields: list, start, step) -> DataFrame:
    """Stream over sorted (conv_id, cols...) rows with a state that ``start`` gives anew for each conversation;
    ``step(state, row)`` gives the next state and the values put out."""
    conv_type = _arrow(df.schema["conv_id"].dataType)
    schema = pa.schema([("conv_id", conv_type), *out_fields])

    def run(batches):
        current, state = object(), None
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != current:
                    current, state = row[0], start
                state, values = step(state, row[1:])
                rows.append((row[0], *values))
            yield from _batches(rows, schema, 1)

    return df.select("conv_id", *cols).mapInArrow(run, f"{_field(df, 'conv_id')}, {out_ddl}")


def _costs_behind(judged: DataFrame) -> DataFrame:
    """(chunk, after, before_cost): the costs by state of all that follows a chunk, and from its start in no state."""
    def step(after, row):
        chunk, flat = row
        before = role_runs.apply([flat[i:i + 4] for i in range(0, 16, 4)], after)
        return before, (chunk, list(after), int(before[role_runs.EMPTY]))

    ordered = _in_order(judged.select("conv_id", "chunk", "matrix"), F.col("chunk").desc())
    return _scan(ordered, ["chunk", "matrix"], "chunk long, after array<double>, cost_from long",
                 [("chunk", pa.int64()), ("after", pa.list_(pa.float64())), ("cost_from", pa.int64())],
                 role_runs.AT_END, step)


def _ends(judged: DataFrame) -> DataFrame:
    """(conv_id, chunk, ends): the state in which each chunk's choices end, by the state in which they start."""
    schema = pa.schema([("conv_id", _arrow(judged.schema["conv_id"].dataType)), ("chunk", pa.int64()), ("ends", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            rows = []
            for conv, chunk, symbols, after in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append((conv, chunk, [role_runs.unroll(symbols, tuple(after), s)[1] for s in role_runs.STATES]))
            yield from _batches(rows, schema, 1)

    return judged.select("conv_id", "chunk", "symbols", "after").mapInArrow(
        run, f"{_field(judged, 'conv_id')}, chunk long, ends array<int>")


def _starts(ends: DataFrame) -> DataFrame:
    """(chunk, state): the state in which each chunk starts."""
    def step(state, row):
        chunk, to = row
        return to[state], (chunk, state)

    return _scan(_in_order(ends, F.col("chunk").asc()), ["chunk", "ends"], "chunk long, state int",
                 [("chunk", pa.int64()), ("state", pa.int32())], role_runs.EMPTY, step)


def _written(opened: DataFrame, known: DataFrame) -> DataFrame:
    """Each open chunk's edits and repaired turns, with its facts."""
    both = opened.select("chunk", "roles", "texts").join(known, "chunk")
    cols = ["conv_id", "chunk", "cost_from", *_FACTS]

    def run(batches):
        for batch in batches:
            edits, lines, ends = [], [], []
            for roles, texts, symbols, after, state in zip(*(c.to_pylist() for c in batch.columns[:5])):
                audit, end = role_runs.unroll(symbols, tuple(after), state)
                made = role_runs.write(audit, roles, texts, state)
                edits.append(audit)
                lines.append("\n".join(made) if made else None)
                ends.append(end)
            yield pa.RecordBatch.from_arrays([*batch.columns[5:], pa.array(edits, pa.string()), pa.array(lines, pa.string()),
                                              pa.array(ends, pa.int32())], [*cols, "edits", "lines", "ends_in"])

    ddl = ", ".join([*[_field(known, c) for c in cols], "edits string, lines string, ends_in int"])
    return both.select("roles", "texts", "symbols", "after", "state", *cols).mapInArrow(run, ddl)


def _join_chunks(written: DataFrame) -> DataFrame:
    """One row per conversation from its chunks in order; the hash is fed chunk by chunk."""
    schema = _result_schema(written)
    cols = ["conv_id", "cost_from", *_FACTS, "edits", "lines", "ends_in"]

    def run(batches):
        rows, current, held = [], object(), None

        def close():
            facts, edits, hashed, any_line, state = held["facts"], held["edits"], held["hash"], held["any"], held["state"]
            tail = role_runs.closing(state)
            for line in role_runs.write(tail, [], [], state):
                hashed.update((("\n" if any_line else "") + line).encode())
                any_line = True
            gaps = facts["last"] - facts["first"] + 1 - facts["distinct"] if facts["first"] is not None else 0
            rows.append((current, gaps, *held["sums"], held["cost"], "".join(edits) + tail, hashed.hexdigest()))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                conv, cost, n, first, last, distinct, a, z, blank, duplicate, truncated, illegal, edits, lines, state = row
                if conv != current:
                    if held is not None:
                        close()
                    current = conv
                    held = {"facts": {"first": None, "last": None, "distinct": 0}, "edits": [], "hash": hashlib.sha256(),
                            "any": False, "state": role_runs.EMPTY, "sums": [0, 0, 0, 0], "cost": cost, "initial": None}
                facts = held["facts"]
                if first is not None:
                    facts["distinct"] += distinct - (facts["last"] == first)
                    facts["first"] = first if facts["first"] is None else facts["first"]
                    facts["last"] = last
                if n:
                    illegal += held["initial"] is not None and held["initial"] + a not in _LEGAL
                    held["initial"] = z
                held["sums"] = [x + y for x, y in zip(held["sums"], (blank, duplicate, truncated, illegal))]
                held["edits"].append(edits)
                if lines is not None:
                    held["hash"].update((("\n" if held["any"] else "") + lines).encode("utf-8", "surrogatepass"))
                    held["any"] = True
                held["state"] = state
            yield from _batches(rows, schema, 512)
        if held is not None:
            close()
        yield from _batches(rows, schema, 1)

    return _in_order(written, F.col("chunk").asc()).select(*cols).mapInArrow(run, _result_ddl(written))


def repair_turns(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of turns
    (conv_id, turn, alive, role, text); a turn that is not alive only names its conversation."""
    prepare(turns.sparkSession)
    packed = materialize(chunks(turns, chunk_turns), "conversation-chunks")
    opened = packed.where("open")
    judged = materialize(_judged(opened), "conversation-judged")
    known = judged.join(_costs_behind(judged).drop("conv_id"), "chunk")
    known = materialize(known.drop("matrix"), "conversation-costs")
    known = known.join(_starts(_ends(known)).drop("conv_id"), "chunk")
    return repair_closed(packed.where("NOT open")).unionByName(_join_chunks(_written(opened, known)))
