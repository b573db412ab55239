"""Conversation repair against brute force over edits."""

from __future__ import annotations

import random
import re
from zlib import crc32

import brute
import pandas as pd
import pytest
from llm_frames import SF, same

from salesforge.llm import registry, repair

SPACE = "[\x20\x09-\x0D]"


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) by plain strings: every prefix of edits of each (rows, initials) class
    is kept with its whole string, and the smallest pair wins."""
    best = {(0, ""): (0, "")}
    for at in range(len(rows) + 1):
        for _ in range(2):  # inserted turns, one after the other
            for (i, last), (cost, audit) in list(best.items()):
                if i == at:
                    key = at, "a" if last == "u" else "u"
                    best[key] = min(best.get(key, (10 ** 9, "")), (cost + 5, audit + "I"))
        if at == len(rows):
            break
        initial, must_go, cut = rows[at]
        for (i, last), (cost, audit) in list(best.items()):
            if i != at:
                continue
            ways = [(last, cost + 2, audit + "D")]
            if not must_go:
                legal = last + initial in ("s", "u", "su", "ua", "au")
                if legal:
                    ways.append((initial, cost + 5 * cut, audit + "K"))
                ways.append(("a" if last == "u" else "u", cost + 1 + 5 * cut, audit + "R"))
            for last, *way in ways:
                best[at + 1, last] = min(best.get((at + 1, last), (10 ** 9, "")), tuple(way))
    return min(v for (i, last), v in best.items() if i == len(rows) and last in ("", "a"))


def exhaustive(rows: list[tuple[str, bool, bool]], inserts: int = 3) -> tuple[int, str]:
    """All edit strings, tried one by one against the pattern."""
    found = []

    def go(at, left, out, cost, audit):
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            found.append((cost, audit))
        if left:
            for x in "ua":
                go(at, left - 1, out + x, cost + 5, audit + "I")
        if at < len(rows):
            initial, must_go, cut = rows[at]
            go(at + 1, left, out, cost + 2, audit + "D")
            if not must_go:
                go(at + 1, left, out + initial, cost + 5 * cut, audit + "K")
                for x in "ua":
                    go(at + 1, left, out + x, cost + 1 + 5 * cut, audit + "R")
    go(0, inserts, "", 0, "")
    return min(found)


def plain(conv_ids: list, rows: list[tuple]) -> pd.DataFrame:
    """``rows``: (conv_id, turn, role, text) after damage, in the order of each conversation."""
    out = []
    for conv in conv_ids:
        own = [r for r in rows if r[0] == conv]
        turns = [r[1] for r in own if r[1] is not None]
        counts, seen, marks = [0, 0, 0, 0], set(), []
        for _, _, role, text in own:
            solid = re.sub(SPACE, "", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            marks.append((role[:1], fault in (0, 1), fault == 2))
        counts[3] = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = cheapest(marks)
        lines, at, state = [], 0, ""
        for e in audit:
            role, text = (own[at][2], own[at][3]) if e != "I" else ("", "")
            at += e != "I"
            if e in "RI":
                role = "assistant" if state == "u" else "user"
            if e != "D":
                lines.append(f"{role}:{text}")
                state = role[0]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, cost, audit, brute.sha("\n".join(lines))))
    return pd.DataFrame(out, columns=[x.split()[0] for x in repair.AUDITS.split(", ")])


def hurt(rows: pd.DataFrame) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows.sort_values(["conv_id", "turn"])[["conv_id", "turn", "role", "text"]].itertuples(index=False):
        role, text = role or " ", " " if text is None else text
        kind = crc32(f"{conv}:{turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_repair_query(spark):
    rows = pd.read_parquet(f"{SF}/conversations.parquet")
    found = registry.op13_audit_dp(spark, SF).toPandas()
    want = plain(sorted(rows.conv_id.unique()), hurt(rows))
    same(found, want, "conv_id")
    assert (want.cost > 0).any() and (want.blank > 0).any() and (want.illegal > 0).any()


def audit_of(rows, every=None, **hashing) -> tuple[int, str]:
    made, done = repair.Audit(**hashing), ""
    for i, (initial, must_go, cut) in enumerate(rows):
        made.row(initial, must_go, cut)
        if every and i % every == every - 1:
            done += made.settle()
    cost, rest = made.end()
    return cost, done + rest


@pytest.mark.parametrize("hashing", [{}, {"modulus": 2}, {"modulus": 1}, {"modulus": 1 << 61, "base": 1}])
def test_audits_against_all_edits(hashing):
    rng = random.Random(4)
    for n in range(400):
        rows = [(rng.choice("uasu "), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n % 5)]
        want = exhaustive(rows)
        assert cheapest(rows) == want and audit_of(rows, **hashing) == want
    for n in range(300):  # longer ones against the plain program, with collisions and settling
        rows = [(rng.choice("uasua "[:rng.randint(2, 6)]), rng.random() < rng.random() / 2, rng.random() < 0.3) for _ in range(rng.randrange(60))]
        assert audit_of(rows, rng.choice([None, 1, 3, 7]), **hashing) == cheapest(rows)


def test_strings_compare_as_text():
    for hashing in ({}, {"modulus": 3}):
        rng, s = random.Random(9), repair.Strings(**hashing)
        nodes = [0]
        for _ in range(300):
            nodes.append(s.add(rng.choice(nodes[-40:]), rng.choice("DIKR")))
        for _ in range(3000):
            a, b = rng.choice(nodes), rng.choice(nodes)
            assert s.less(a, b) == (s.text(a) < s.text(b))
            base = s.shared([a, b])
            assert s.text(a).startswith(s.text(base)) and s.text(b).startswith(s.text(base))


@pytest.mark.parametrize("settle", [4, 512])
def test_long_conversation_is_settled(spark, settle):
    rng = random.Random(1)
    rows = [(1, i // 2 * 2 if i % 50 else None, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "No", "", " \t", f"Text {i}.", f"text {i}"]))
            for i in range(3000)]
    rows += [(2, 1, "user", "Hi."), (2, 2, "assistant", "Yes.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = repair.audits(turns, settle=settle).toPandas()
    # Rows of one turn stand in the order of role and digest.
    import hashlib
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{r[0]}:{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    same(found, plain([1, 2], order), "conv_id")
    made = repair.repaired(turns, settle=settle).toPandas().sort_values(["conv_id", "place"])
    lines = [f"{r}:{t}" for r, t in zip(made[made.conv_id == 1].role, made[made.conv_id == 1].text)]
    assert brute.sha("\n".join(lines)) == found[found.conv_id == 1].repaired_sha256.iloc[0]
    initials = "".join(r[0] for r in made[made.conv_id == 1].role)
    assert re.fullmatch("(s?(ua)+)?", initials) and made.groupby("conv_id").place.agg(lambda p: list(p) == list(range(len(p)))).all()


def test_frequent_text_over_turns(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "Same again." if t < 40 else f"Other {t}.") for c in range(150) for t in range(42)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    same(repair.audits(turns).toPandas(), plain(list(range(150)), rows), "conv_id")


def test_repair_edges(spark):
    ddl = "conv_id long, turn long, role string, text string, key string, kind string"
    long = "word " * 300_000 + "end."
    rows = [(1, None, None, None), (2, 1, "user", long), (2, 2, "assistant", long), (3, None, "user", "A."), (3, None, "assistant", "B."), (3, 5, "assistant", "B."),
            (4, 1, "", "x."), (5, 1, "user", "same."), (5, 1, "user", "same."), (None, 1, "user", "A."), (None, 2, "assistant", "B.")]
    turns = spark.createDataFrame([(*r, "x", "x") for r in rows], ddl)
    found = {r["conv_id"]: r for r in repair.audits(turns).collect()}
    assert set(found) == {1, 2, 3, 4, 5, None}
    assert (found[1]["blank"], found[1]["audit"], found[1]["cost"], found[1]["gaps"], found[1]["repaired_sha256"]) == (1, "D", 2, 0, brute.sha(""))
    assert found[2]["audit"] == "KK" and found[2]["repaired_sha256"] == brute.sha(f"user:{long}\nassistant:{long}")
    assert (found[3]["duplicate"], found[3]["illegal"], found[3]["gaps"]) == (1, 0, 0) and found[None]["audit"] == "KK"
    assert found[4]["audit"] == "D" and (found[5]["duplicate"], found[5]["audit"]) == (1, "DD")
    some = {r["conv_id"]: tuple(r)[1:] for r in repair.audits(turns, present=turns.conv_id > 2).collect()}
    assert set(some) == set(found) and some[3] == tuple(found[3])[1:]
    assert some[1] == some[None] == (0, 0, 0, 0, 0, 0, "", brute.sha(""))
    assert repair.audits(turns.limit(0)).count() == 0 and repair.repaired(turns.limit(0)).count() == 0
    assert repair.damaged(turns).where("conv_id is null").count() >= 1
