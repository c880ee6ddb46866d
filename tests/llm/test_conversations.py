"""Conversation repair against a search of all edits."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from checks.parity import spark_rows, sql_rows
from tickbars.llm import op11_conversations as op11

COLUMNS = "conv_id long, turn long, role string, text string"
INSERTS = ["", "I", "II"]


def searched(rows):
    """(cost, audit, repaired rows) over all edits with at most two inserts in a place."""
    best = None
    for edits in product(*[[i + e for i in INSERTS for e in (("D",) if fault in ("blank", "duplicate") else ("K", "Ru", "Ra", "D"))] for *_, fault in rows], INSERTS):
        for inserted in product("ua", repeat="".join(edits).count("I")):
            cost, audit, out, new = 0, "", [], iter(inserted)
            for edit, (role, text, fault) in zip(edits, [*rows, ("", "", None)]):
                for e in re.findall("I|K|D|R[ua]", edit):
                    audit += e[0]
                    cost += {"K": 0, "R": 3, "D": 4, "I": 3}[e[0]] + (3 if fault == "truncated" and e[0] in "KR" else 0)
                    if e == "I":
                        out.append(({"u": "user", "a": "assistant"}[next(new)], ""))
                    elif e != "D":
                        out.append(({"K": role, "Ru": "user", "Ra": "assistant"}[e], text))
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


def wanted(rows):
    """rows: (turn, role, text) of a conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        words = text.strip(op11.SPACE)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    cost, audit, out = searched([(role, text, f) for (_, role, text), f in zip(rows, faults)])
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest


@pytest.fixture(scope="module")
def conversations():
    pick = random.Random(11)
    made = {}
    for conv in range(60):
        turns = [pick.choice([None, 0, 1, 2, 3, 9]) for _ in range(pick.randrange(4))]
        rows = [(t, pick.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), pick.choice(["a.", "b!", "c", " \n", "", "d?  \t", "é.", "a."])) for t in turns]
        made[conv] = rows, wanted(rows)
    return made


@pytest.mark.parametrize("chunk_rows", [1, 2, op11.CHUNK_ROWS])
def test_against_all_edits(spark, conversations, chunk_rows):
    rows = [(c, *r, True) for c, (held, _) in conversations.items() for r in held] + [(c, None, None, None, False) for c in conversations]
    df = spark.createDataFrame(rows, f"{COLUMNS}, present boolean").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in op11.repair(df, F.col("present"), chunk_rows).collect()}
    assert got == {c: want for c, (_, want) in conversations.items()}


def test_one_conversation_over_many_tasks(spark):
    """Its runs are long and its repeats lie in other tasks; all ways of cutting it agree."""
    rows = [(7, i // 2, "user" if i % 90 < 60 else "assistant", f"{i % 700}." if i % 5 else "cut") for i in range(6000)]
    df = spark.createDataFrame([*rows, (8, 0, "user", "x" * 300_000 + ".")], COLUMNS).repartition(6)
    one, several = (sorted(map(tuple, op11.repair(df, None, n).collect())) for n in (10_000, 37))
    assert one == several
    assert one[0][3] > 4000 and len(one[0][7]) >= 6000
    small = op11.repair(df, None, 10_000, chunk_bytes=1000)
    assert sorted(map(tuple, small.collect())) == one


def test_powers():
    """A run's powers give the cost and audit of its single steps."""
    for which in (("u", False), ("a", True), ("", False), op11.GONE):
        step = op11.transition(which)
        for n in (1, 5, 12):
            passed = op11.blocks([which] * n)
            assert len(passed) == n.bit_count()
            assert op11.unroll(passed, 0, op11.LAST_COST) == op11.unroll([step] * n, 0, op11.LAST_COST)


def test_odd_tables(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", None), (1, 1, "user", "a."), (1, 1, "user", "a."), (2, 5, "assistant", "b")]
    df = spark.createDataFrame(rows, COLUMNS).withColumns({"cost": F.lit("x"), "fault": F.lit(1), "present": F.lit(False), "chunk": F.lit(0)})
    got = {r[0]: tuple(r)[1:] for r in op11.repair(df).collect()}
    assert got == {
        None: wanted([(None, "", ""), (3, "user", "a.")]),
        1: wanted([(None, "user", ""), (1, "user", "a."), (1, "user", "a.")]),
        2: wanted([(5, "assistant", "b")]),
    }
    assert op11.repair(df.limit(0)).collect() == []
    texts = df.withColumn("conv_id", F.col("conv_id").cast("string"))
    assert op11.repair(texts).filter("conv_id = '2'").count() == 1


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three") for c in range(30) for t in (0, 1, None)]
    out = op11.damaged(spark.createDataFrame([*rows, (None, None, None, None)], COLUMNS)).collect()
    want = []
    for c, t, role, text in [*rows, (None, None, " ", " ")]:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        want += [(c, t, "user" if kind == 4 else role, text, kind != 0)] * (2 if kind == 3 else 1)
    assert sorted(map(repr, (tuple(r)[:5] for r in out))) == sorted(map(repr, want))


def test_query_and_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        path = f"/root/testdata/{sf}"
        assert spark_rows(op11.op11_conversations(spark, path)) == sql_rows(path, op11.OP11_SQL)
