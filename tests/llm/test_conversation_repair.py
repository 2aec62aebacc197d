"""Conversation repair against a plain version that spells every audit out."""

import hashlib
import random
import re
from functools import cache
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import conversation_repair
from cohortloom.llm.queries import QUERIES

from .helpers import SMALL, rows

BLANK = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def plain_damage(conversations):
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        sort = crc32(key.encode()) % 20
        if sort == 0:
            continue
        after = ("user" if sort == 4 else role, "" if sort == 1 else re.sub("[.!?]", "", text) if sort == 2 else text)
        for copy in range(2 if sort == 3 else 1):
            yield conv, turn, (turn is not None, turn or 0, role, copy), *after


def plain_repair(turns):
    """turns: (turn, role, text) in order. The expected columns after the id."""
    if not turns:
        return NOTHING
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    faults, seen = [], set()
    for _, role, text in turns:
        marks = BLANK.findall(text)
        fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    best = {}

    def arcs(i, before):
        for name in ("user", "assistant"):
            if (before, name[0]) in legal:
                yield 5, "I", i, name[0]
        if i < len(turns):
            yield 2, "D", i + 1, before
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 if faults[i] == "truncated" else 0
                if (before, turns[i][1][:1]) in legal:
                    yield extra, "K", i + 1, turns[i][1][:1]
                for name in ("user", "assistant"):
                    if (before, name[0]) in legal:
                        yield extra + 1, "R", i + 1, name[0]

    for i in range(len(turns), -1, -1):
        found = {"": (0, ""), "a": (0, "")} if i == len(turns) else {}
        for before in ("", "s", "u", "a"):
            for cost, initial, j, after in arcs(i, before):
                if j > i and after in best[j]:
                    rest = best[j][after]
                    found[before] = min(found.get(before, (10**9, "")), (cost + rest[0], initial + rest[1]))
        for _ in range(3):
            for before in ("", "s", "u", "a"):
                for cost, initial, j, after in arcs(i, before):
                    if j == i and after in found:
                        rest = found[after]
                        found[before] = min(found.get(before, (10**9, "")), (cost + rest[0], initial + rest[1]))
        best[i] = found
    cost, audit = best[0][""]
    repaired, i, before = [], 0, ""
    for edit in audit:
        role = "assistant" if before == "u" else "user"
        if edit in "KR":
            repaired.append((turns[i][1] if edit == "K" else role, turns[i][2]))
        elif edit == "I":
            repaired.append((role, ""))
        i += edit != "I"
        before = repaired[-1][0][0] if repaired else ""
    assert i == len(turns) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in repaired))
    text = "\n".join(f"{role}:{text}" for role, text in repaired)
    return (
        gaps,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def plain(conversations):
    groups = {c[0]: [] for c in conversations}
    for conv, turn, origin, role, text in plain_damage(conversations):
        groups[conv].append((origin, turn, role, text))
    return [(conv, *plain_repair([r[1:] for r in sorted(some, key=lambda r: r[0])])) for conv, some in groups.items()]


def run(spark, conversations):
    frame = spark.createDataFrame([(*c, "extra", "x", 3) for c in conversations],
        "conv_id long, turn long, role string, text string, audit string, part string, kind int").repartition(5)
    frame.createOrReplaceTempView("given")
    damaged = conversation_repair.damage(frame)
    found = conversation_repair.repair(damaged, place=F.struct("origin", "copy")).summaries()
    return {r["id"]: tuple(r[c] for c in COLUMNS[1:]) for r in found.collect()}


def test_query_matches_plain_version(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op11_conversation_repair"](spark, SMALL)
    assert rows(found, *COLUMNS) == sorted(plain(given), key=str)
    edits = "".join(r.audit for r in found.collect())
    assert {"D", "K", "R"} <= set(edits) <= set("DIKR")


ROLES = ("system", "user", "assistant", "tool", "User", "", None, "sage", "umpire", "a")
TEXTS = ("Yes.", "No", "", " \n\t", None, "Why? \n", "é!", "No", "漢字", ".")


def some_conversations(seed, sizes):
    rng = random.Random(seed)
    given = []
    for conv, size in enumerate(sizes):
        for k in range(size):
            usual = rng.random() < 0.6
            role = ("user", "assistant")[k % 2] if usual else rng.choice(ROLES)
            text = f"{rng.randrange(50)}." if usual else rng.choice(TEXTS)
            given.append((conv if conv else None, rng.choice((k, k, k, None)), role, text))
    return list({(c, t, r, x): (c, t, r, x) for c, t, r, x in given}.values())


def distinct_places(given):
    """Ties of turn and role would leave the order to a hash of the text; tests number them."""
    seen = {}
    return [seen.setdefault((c, t, r), (c, t, r, x)) for c, t, r, x in given if (c, t, r) not in seen]


@pytest.mark.parametrize("part", [1024, 1, 3, 7])
def test_parts_agree_with_plain_version(spark, monkeypatch, part):
    monkeypatch.setattr(conversation_repair, "PART", part)
    given = distinct_places(some_conversations(part, [12, 1, 2, 3, 5, 8, 13, 21, 30, 34]))
    expected = {conv: tuple(rest) for conv, *rest in plain(given) if rest[6] or rest[5]}
    found = run(spark, given)
    assert {k: v for k, v in found.items() if v[5] or v[6]} == expected


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    gone = next(i for i in range(1000) if crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi."), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).select(*COLUMNS).collect()}
    assert found[gone] == NOTHING
    assert found == {conv: tuple(rest) for conv, *rest in plain([(gone, 0, "user", "Hi."), (None, None, None, None)])}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    whole = conversation_repair.repair(frame)
    assert whole.summaries().collect() == [] and whole.turns().collect() == []


@pytest.mark.parametrize("part", [1024, 4])
def test_turns_are_the_repaired_conversation(spark, monkeypatch, part):
    monkeypatch.setattr(conversation_repair, "PART", part)
    given = [(7, k, ("user", "assistant")[k % 2], f"line {k}.") for k in range(10)]
    given[3] = (7, 3, "user", "line 3.")
    given[6] = (7, 6, "user", "")
    frame = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    found = conversation_repair.repair(frame).turns().orderBy("part", "place").collect()
    summary = conversation_repair.repair(frame).summaries().first()
    text = "\n".join(f"{r.role}:{r.text}" for r in found)
    assert hashlib.sha256(text.encode()).hexdigest() == summary.repaired_sha256
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in found))


def test_one_very_long_conversation_and_text(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PART", 100)
    given = [(1, k, ("user", "assistant")[k % 2], "same." if k % 3 else f"turn {k}.") for k in range(2500)]
    given += [(2, 0, "user", "long " * 200_000 + "."), (2, 1, "assistant", "ok.")]
    expected = {conv: tuple(rest) for conv, *rest in plain(given)}
    assert run(spark, given) == {k: v for k, v in expected.items() if k == 1 or v[6]}


def test_ranks_order_audits():
    """Ranks by doubling order the least audits of all nodes as plain text does."""
    rng = np.random.default_rng(5)
    kind, fault = rng.integers(0, 4, 40), rng.integers(0, 4, 40)
    found = conversation_repair.Rows(kind, fault, np.array([0, 1, 17])).paths(
        np.tile(conversation_repair.FINAL, (3, 1)), np.ones(3, bool)
    )
    letter = {0: "", 1: "D", 2: "I", 3: "K", 4: "R"}

    @cache
    def audit(node):
        initial = int(found.initial[node])
        return letter[initial] + (audit(int(found.pointers[0][node])) if initial else "")

    assert [len(audit(v)) for v in range(len(found.initial))] == found.length.tolist()
    starts = found.rows.first * 4
    node, group, _ = found.walk(np.zeros(3, int))
    assert ["".join(letter[int(found.initial[v])] for v in node[group == g]) for g in range(3)] == [audit(int(s)) for s in starts]
