"""Conversation structure repair by a run-length dynamic program.

The cheapest edits make the initials of a conversation's roles `(s?(ua)+)?`. States of that pattern: 0 nothing yet, 1 after
the system row, 2 after a user row, 3 after an assistant row; a conversation may end in 0 and 3. A row is one of nine symbols:
its role's initial (s, u, a, other) with or without truncation, or a row that must go. A symbol's transition is a 4 x 4
matrix over (cost, audit), whose sum is the lesser and whose product adds costs and joins audits. An audit of a matrix ends in the
edit of a row, so none is the beginning of another, and the least of joined audits is the join of the least.

Equal consecutive symbols are one run. A run of n is passed by the powers 1, 2, 4, ... of its matrix, which are kept, in the bits
of n: backwards by costs alone, then forwards to unroll the choices, which are the kept powers' audits.

Spark sorts the rows of all conversations by range, so a very long one lies in many tasks. A task holds one chunk of a
conversation, `CHUNK_ROWS` rows or `CHUNK_BYTES` of text at most (or one longer text). What begins and ends inside a task
is finished there. Chunks of others are stored; their repeats of earlier chunks are found by a join on digests, each chunk becomes one
matrix of costs, the matrices of a conversation are passed backwards, and its chunks are then unrolled in order, holding one at a time.
The audit of a conversation is one value, so it has fewer than 2**31 rows and 524,288 matrices.

Edge cases: a null conv_id is a conversation of its own, null text and role read as one space in the query, and null
turns sort first; equal turns go by role, then text; repeated rows are duplicates; roles with another initial, or none, can be
deleted or given a new role, never kept; a conversation without rows has zeros, an empty audit and the hash of the empty string; an
empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.llm.texts import stored

CHUNK_ROWS = 4096
CHUNK_BYTES = 8 << 20
#: Rows of a batch that a task gives back.
BATCH = 512

SPACE = " \t\n\x0b\f\r"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
INSERT, DELETE, REROLE, CUT = 3, 4, 3, 3
NEVER = 1 << 60
GONE = ("gone", False)
#: Inserts that lead from a state to another, at most two, and those that end a conversation.
INSERTS = {0: {0: "", 2: "I", 3: "II"}, 1: {1: "", 2: "I", 3: "II"}, 2: {2: "", 3: "I"}, 3: {3: "", 2: "I"}}
LAST = ("", "II", "I", "")
LAST_COST = tuple(INSERT * len(s) for s in LAST)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
RENAMED = {0: 2, 1: 2, 2: 3, 3: 2}

Symbol = tuple[str, bool]
Cell = tuple[int, str]
Matrix = tuple[tuple[Cell, ...], ...]

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
CHUNK = "turns array<long>, roles array<string>, texts array<string>, faults array<int>"


def symbol(role: str, fault: int) -> Symbol:
    if fault in (BLANK, DUPLICATE):
        return GONE
    return (role[:1] if role[:1] in KEPT else "", fault == TRUNCATED)


def transition(of: Symbol) -> Matrix:
    """Cheapest inserts and one edit of a row with this symbol, from each state to each."""
    initial, cut = of
    rows = []
    for state in range(4):
        cells = [(NEVER, "")] * 4
        for between, inserts in INSERTS[state].items():
            edits = [(between, DELETE, "D")]
            if of != GONE:
                edits.append((RENAMED[between], REROLE + CUT * cut, "R"))
                if between in KEPT.get(initial, {}):
                    edits.append((KEPT[initial][between], CUT * cut, "K"))
            for after, cost, name in edits:
                cells[after] = min(cells[after], (INSERT * len(inserts) + cost, inserts + name))
        rows.append(tuple(cells))
    return tuple(rows)


def product(a: Matrix, b: Matrix) -> Matrix:
    def cell(p: int, r: int) -> Cell:
        ways = [(a[p][q][0] + b[q][r][0], a[p][q][1] + b[q][r][1]) for q in range(4) if max(a[p][q][0], b[q][r][0]) < NEVER]
        return min(ways, default=(NEVER, ""))

    return tuple(tuple(cell(p, r) for r in range(4)) for p in range(4))


class Powers(dict):
    """symbol -> its transition's powers 1, 2, 4, ..., made when first needed; tasks make their own."""

    def of(self, symbol: Symbol, k: int) -> Matrix:
        known = self.setdefault(symbol, [])
        while len(known) <= k:
            known.append(product(known[-1], known[-1]) if known else transition(symbol))
        return known[k]

    def __reduce__(self):
        return Powers, ()


POWERS = Powers()


def blocks(symbols: Iterable[Symbol]) -> list[Matrix]:
    """The powers that pass the runs of a sequence."""
    found = []
    for which, run in groupby(symbols):
        n = sum(1 for _ in run)
        found += [POWERS.of(which, k) for k in range(n.bit_length()) if n >> k & 1]
    return found


def before(matrix: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs to the end from each state, given those after the matrix."""
    return tuple(min(cell[0] + rest for cell, rest in zip(row, after)) for row in matrix)


def unroll(passed: list[Matrix], state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The cheapest, then least audit from a state, given the costs after the last matrix; and the state that it leads to."""
    costs = [after]
    for matrix in reversed(passed):
        costs.append(before(matrix, costs[-1]))
    audit = []
    for matrix, rest in zip(passed, reversed(costs[:-1])):
        _, edits, state = min((cell[0] + rest[q], cell[1], q) for q, cell in enumerate(matrix[state]))
        audit.append(edits)
    return "".join(audit), state


class Repaired:
    """Digest of the repaired rows, fed in order."""

    def __init__(self):
        self.digest, self.state, self.begun = hashlib.sha256(), 0, False

    def feed(self, audit: str, roles: list[str], texts: list[str]) -> None:
        at, lines = 0, [""] if self.begun else []
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            role = "assistant" if self.state == 2 else "user"
            if edit == "K":
                role = roles[at]
            self.state = KEPT["s"][0] if edit == "K" and role[:1] == "s" else RENAMED[self.state]
            lines.append(f"{role}:" if edit == "I" else f"{role}:{texts[at]}")
            at += edit != "I"
        if len(lines) > self.begun:
            self.digest.update("\n".join(lines).encode())
            self.begun = True


def turn_counts(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """Least and greatest turn and how many there are, of turns in order, nulls first."""
    there = [t for t in turns if t is not None]
    return (there[0], there[-1], sum(1 for _ in groupby(there))) if there else (None, None, 0)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def finished(turns: list, roles: list[str], texts: list[str], faults: list[int]) -> tuple:
    """The result of a whole conversation."""
    first, last, several = turn_counts(turns)
    passed = blocks(map(symbol, roles, faults))
    costs = LAST_COST
    for matrix in reversed(passed):
        costs = before(matrix, costs)
    audit, state = unroll(passed, 0, LAST_COST)
    audit += LAST[state]
    repaired = Repaired()
    repaired.feed(audit, roles, texts)
    gaps = last - first + 1 - several if several else 0
    counts = (faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED))
    return gaps, *counts, illegal([r[:1] for r in roles]), costs[0], audit, repaired.digest.hexdigest()


def chunks(rows: DataFrame, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Sorted rows -> results of the conversations that begin and end in a task, and chunks of the others."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, chunk long, {RESULT}, {CHUNK}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        base = TaskContext.get().partitionId() << 40
        made: list[tuple] = []
        number = 0
        # The conversation at hand; another task may have rows of the first and the last.
        conv, held, size, seen, parted, started = None, [], 0, set(), True, False

        def end(whole: bool) -> None:
            nonlocal number
            columns = [list(c) for c in zip(*held)] or [[], [], [], []]
            out = (*finished(*columns), None, None, None, None) if whole else (*(None,) * 8, *columns)
            made.append((conv, base + number, *out))
            number += 1

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), arrow.types)], schema=arrow)
            made.clear()
            return out

        for batch in batches:
            if arrow is None:
                arrow = chunk_schema(batch.schema.field(0).type)
            for key, turn, role, text, fault, present in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or key != conv:
                    if started:
                        end(whole=not parted)
                        parted = False
                    conv, held, size, seen, started = key, [], 0, set(), True
                if not present:
                    continue
                if held and (len(held) >= chunk_rows or size + len(text) > chunk_bytes):
                    parted = True
                    end(whole=False)
                    held, size, seen = [], 0, set()
                if fault != BLANK:
                    if (role, text) in seen:
                        fault = DUPLICATE
                    seen.add((role, text))
                held.append((turn, role, text, fault))
                size += len(text)
                if len(made) >= BATCH or made and made[-1][-3] is not None:
                    yield batch_of()
            if len(made) >= BATCH:
                yield batch_of()
        if started:
            end(whole=False)
            yield batch_of()

    return rows.mapInArrow(run, schema)


def chunk_schema(key: pa.DataType) -> pa.Schema:
    fields = [("conv_id", key), ("chunk", pa.int64())]
    fields += [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    fields += [("audit", pa.string()), ("repaired_sha256", pa.string())]
    fields += [("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.list_(pa.int32()))]
    return pa.schema(fields)


def faults_of(row: dict) -> list[int]:
    """With the repeats of earlier chunks."""
    again = set(row["again"] or ())
    return [DUPLICATE if i in again else f for i, f in enumerate(row["faults"])]


SUMMARY = "costs array<long>, first_role string, last_role string, illegal long, least long, most long, turns long, blank long, duplicate long, truncated long"


def summaries(parts: DataFrame) -> DataFrame:
    """One matrix of costs for each chunk, and what counts of it."""
    kind = parts.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                faults, roles = faults_of(row), row["roles"]
                passed = blocks(map(symbol, roles, faults))
                # Row p of the product of the matrices, one target state at a time.
                targets = []
                for q in range(4):
                    costs = tuple(0 if p == q else NEVER for p in range(4))
                    for matrix in reversed(passed):
                        costs = tuple(min(c, NEVER) for c in before(matrix, costs))
                    targets.append(costs)
                least, most, several = turn_counts(row["turns"])
                initials = [r[:1] for r in roles]
                made.append(
                    {
                        "conv_id": row["conv_id"],
                        "chunk": row["chunk"],
                        "costs": [targets[q][p] for p in range(4) for q in range(4)],
                        "first_role": initials[0] if roles else None,
                        "last_role": initials[-1] if roles else None,
                        "illegal": illegal(initials),
                        "least": least,
                        "most": most,
                        "turns": several,
                        "blank": faults.count(BLANK),
                        "duplicate": faults.count(DUPLICATE),
                        "truncated": faults.count(TRUNCATED),
                    }
                )
            fields = [("conv_id", batch.schema.field("conv_id").type), ("chunk", pa.int64()), ("costs", pa.list_(pa.int64()))]
            fields += [("first_role", pa.string()), ("last_role", pa.string())]
            fields += [(n, pa.int64()) for n in ("illegal", "least", "most", "turns", "blank", "duplicate", "truncated")]
            if made:
                yield pa.RecordBatch.from_pylist(made, pa.schema(fields))

    return parts.select("conv_id", "chunk", "turns", "roles", "faults", "again").mapInArrow(run, f"conv_id {kind}, chunk long, {SUMMARY}")


def passed_back(table: pa.Table) -> pa.Table:
    """The chunks of one conversation -> costs after each chunk, and the counts of the whole beside the last."""
    rows = sorted(table.to_pylist(), key=itemgetter("chunk"))
    costs, out = LAST_COST, []
    for row in reversed(rows):
        out.append({"chunk": row["chunk"], "after": list(costs), "is_last": row is rows[-1]})
        costs = tuple(min(row["costs"][4 * p + q] + costs[q] for q in range(4)) for p in range(4))
    there = [r for r in rows if r["turns"]]
    several = sum(r["turns"] for r in there) - sum(a["most"] == b["least"] for a, b in zip(there, there[1:]))
    with_rows = [r for r in rows if r["first_role"] is not None]
    out[0] |= {
        "gaps": there[-1]["most"] - there[0]["least"] + 1 - several if there else 0,
        "illegal": sum(r["illegal"] for r in rows) + sum(illegal([a["last_role"], b["first_role"]]) for a, b in zip(with_rows, with_rows[1:])),
        "cost": costs[0],
        **{name: sum(r[name] for r in rows) for name in ("blank", "duplicate", "truncated")},
    }
    fields = [("chunk", pa.int64()), ("after", pa.list_(pa.int64())), ("is_last", pa.bool_())]
    fields += [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return pa.Table.from_pylist(out, pa.schema(fields))


BACK = "chunk long, after array<long>, is_last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def unrolled(parts: DataFrame) -> DataFrame:
    """Chunks in order, with the costs after each -> the results of their conversations."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repaired, audits = Repaired(), []
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                passed = blocks(map(symbol, row["roles"], faults_of(row)))
                audit, state = unroll(passed, repaired.state, tuple(row["after"]))
                if row["is_last"]:
                    audit += LAST[state]
                audits.append(audit)
                repaired.feed(audit, row["roles"], row["texts"])
                if row["is_last"]:
                    result = {"audit": "".join(audits), "repaired_sha256": repaired.digest.hexdigest()}
                    made.append({"conv_id": row["conv_id"], **{n: row[n] for n in counts}, **result})
                    repaired, audits = Repaired(), []
            if made:
                fields = [("conv_id", batch.schema.field("conv_id").type), *((n, pa.int64()) for n in counts), ("audit", pa.string()), ("repaired_sha256", pa.string())]
                yield pa.RecordBatch.from_pylist(made, pa.schema(fields))

    return parts.mapInArrow(run, f"conv_id {kind}, {RESULT}")


def repair(rows: DataFrame, present: Column | None = None, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """conv_id, turn, role, text (null: empty) -> one row per conversation with its counts, cost, audit and digest.

    A row for which `present` is false only names its conversation.
    """
    there = F.lit(True) if present is None else present
    trimmed = F.rtrim(F.coalesce("text", F.lit("")), F.lit(SPACE))
    fault = F.when(trimmed == "", BLANK).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    fields = [F.when(there, F.coalesce(n, F.lit(""))).alias(n) for n in ("role", "text")]
    checked = rows.select("conv_id", F.when(there, F.col("turn").cast("long")).alias("turn"), *fields, fault.alias("fault"), there.alias("present"))
    # The text's beginning keeps equal rows of a turn in order without whole texts as bounds of the ranges.
    dealt = checked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    found = stored(chunks(dealt, chunk_rows, chunk_bytes), "op11-chunks", "zstd")
    results = [f.split()[0] for f in RESULT.split(", ")]
    whole = found.filter("turns IS NULL").select("conv_id", *results)
    parts = found.filter("turns IS NOT NULL").select("conv_id", "chunk", "turns", "roles", "texts", "faults")

    named = parts.select("conv_id", "chunk", F.posexplode(F.arrays_zip("roles", "texts", "faults")).alias("place", "row")).filter(f"row.faults < {BLANK}")
    named = named.select("chunk", "place", F.sha2(F.to_json(F.struct("conv_id", "row.roles", "row.texts")), 256).alias("name"))
    firsts = named.groupBy("name").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("name", "first")
    again = named.join(firsts, "name").filter("chunk > first").groupBy("chunk").agg(F.collect_list("place").alias("again"))
    parts = stored(parts.join(again, "chunk", "left"), "op11-parts", "zstd")
    back = summaries(parts).groupBy("conv_id").applyInArrow(passed_back, BACK)
    ordered = parts.join(back, "chunk").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return whole.unionByName(unrolled(ordered))


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage, by the checksum of conversation and turn; `present` is false for dropped rows."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(text[0], F.lit(":"), text[1])) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(text[2]).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text[3], "[.!?]", "")).otherwise(text[3]).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), F.col("present"))


def _walk(state: int, inserts: int) -> str:
    """The lines that the inserts add."""
    lines = ["''"]
    for _ in range(inserts):
        lines.append("'assistant:' || chr(10)" if state == 2 else "'user:' || chr(10)")
        state = RENAMED[state]
    return " || ".join(lines)


def _step(state: int) -> str:
    """Cheapest way into a state with the next row: inserts from an earlier state, then the row's edit."""
    options = []
    for start in range(4):
        for between, inserts in INSERTS[start].items():
            ways = []
            if between == state:
                ways.append(("true", f"{DELETE}", "D", "''"))
            if RENAMED[between] == state:
                name = "assistant" if between == 2 else "user"
                ways.append(("NOT gone", f"{REROLE} + cut", "R", f"'{name}:' || text || chr(10)"))
            ways += [(f"NOT gone AND left(role, 1) = '{i}'", "cut", "K", "role || ':' || text || chr(10)") for i, moves in KEPT.items() if moves.get(between) == state]
            options += [
                f"CASE WHEN {when} AND s{start} IS NOT NULL THEN {{'c': s{start}.c + {INSERT * len(inserts)} + {cost}, "
                f"'a': s{start}.a || '{inserts}{edit}', 't': s{start}.t || {_walk(start, len(inserts))} || {line}}} END"
                for when, cost, edit, line in ways
            ]
    return f"list_min([{', '.join(options)}])"


def _end(state: int) -> str:
    lines = _walk(state, len(LAST[state]))
    return f"CASE WHEN s{state} IS NOT NULL THEN {{'c': s{state}.c + {LAST_COST[state]}, 'a': s{state}.a || '{LAST[state]}', 't': s{state}.t || {lines}}} END"


_WHITE = "[\\x20\\x09-\\x0D]"
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ord(substr(key, i, 1))::BIGINT FOR i IN range(1, length(key) + 1)]),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

OP11_SQL = f"""WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT *, {_CRC} % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         regexp_replace(text, '{_WHITE}+$', '') AS trimmed FROM damaged),
checked AS (
  SELECT conv_id, turn, role, text, n, CASE WHEN trimmed = '' THEN 'blank' WHEN n > min(n) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
         WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS earlier FROM numbered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS rows,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (earlier IS NOT NULL AND left(earlier, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv_id),
passed AS (
  SELECT conv_id, rows, CAST(0 AS BIGINT) AS n, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s2,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s3 FROM counts
  UNION ALL
  SELECT conv_id, rows, place, {_step(0)}, {_step(1)}, {_step(2)}, {_step(3)}
  FROM (SELECT p.*, r.n AS place, role, text, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
               CASE WHEN fault = 'truncated' THEN {CUT} ELSE 0 END AS cut
        FROM passed p JOIN checked r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = p.n + 1)),
ended AS (SELECT conv_id, list_min([{', '.join(map(_end, range(4)))}]) AS best FROM passed WHERE n = rows)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(CASE WHEN best.t = '' THEN '' ELSE left(best.t, length(best.t) - 1) END, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
