"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidemark.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, code string, position string, audit string"
EMPTY = hashlib.sha256(b"").hexdigest()
# Where a role may follow: the start, a system turn, a user turn, an assistant turn.
FOLLOWS = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}


def plain_audit(kinds, faults):
    """Least (cost, audit) by trying every edit at every place."""
    n = len(kinds)

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == n and state in (0, 3) else []

        def add(cost, letter, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1]))

        if i < n:
            add(4, "D", best(i + 1, state, 0))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                for s in "uas":
                    if state in FOLLOWS[s]:
                        if kinds[i] == s:
                            add(more, "K", best(i + 1, FOLLOWS[s][state], 0))
                        elif s != "s":
                            add(more + 3, "R", best(i + 1, FOLLOWS[s][state], 0))
        if inserted < 4:
            for s in "ua":
                if state in FOLLOWS[s]:
                    add(3, "I", best(i, FOLLOWS[s][state], inserted + 1))
        return min(found, default=None)

    return best(0, 0, 0)


def plain_summary(rows):
    """What ``summary`` gives for one conversation's (turn, role, text), row by row."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]+", "", text)
        faults.append(
            "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    kinds = [r[1][:1] for r in rows]
    cost, audit = plain_audit(tuple(kinds), tuple(faults))
    turns = [t for t, _, _ in rows if t is not None]
    out, left = [], iter(rows)
    for letter in audit:
        role, text = next(left)[1:] if letter != "I" else ("", "")
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    )


def summaries(spark, conversations):
    rows = [(c, t, r, x, "x", "x", "x") for c, told in conversations.items() for t, r, x in told]
    got = repair.summary(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


def test_alignment_against_a_plain_search():
    pick, names = random.Random(3), ("", "blank", "duplicate", "truncated")
    for n in [1, 2, 3, 4, 5, 6, 8, 12] * 150 + [60, 61]:
        tidy = pick.random() < 0.5
        kinds = [k % 2 if tidy and pick.random() < 0.8 else pick.choice([0, 0, 1, 1, 2, 3]) for k in range(n)]
        faults = [pick.choice([0, 0, 0, 0, 0, 1, 2, 3, 3]) for _ in range(n)]
        got = repair.align(bytes(k + 4 * f for k, f in zip(kinds, faults)))
        assert got == plain_audit(tuple("uaso"[k] for k in kinds), tuple(names[f] for f in faults))


def test_long_conversations_are_traced_in_blocks():
    pick = random.Random(4)
    kinds = [k % 2 if pick.random() < 0.9 else pick.randrange(4) for k in range(700)]
    faults = [pick.choice([0] * 15 + [1, 2, 3]) for _ in kinds]
    cost, audit = repair.align(bytes(k + 4 * f for k, f in zip(kinds, faults)))
    # The audit is a repair, and what it costs is what was said.
    roles, paid, place = "", 0, 0
    for letter in audit:
        if letter == "I":
            paid += 3
            roles += "a" if roles.endswith("u") else "u"
            continue
        kind, fault = "uaso"[kinds[place]], faults[place]
        place += 1
        if letter == "D":
            paid += 4
            continue
        assert fault not in (1, 2)
        paid += 3 * (fault == 3) + 3 * (letter == "R")
        roles += kind if letter == "K" else "a" if roles.endswith("u") else "u"
    assert place == 700 and paid == cost and re.fullmatch("(s?(ua)+)?", roles)
    # Costs without audits, by the four states alone.
    best = {0: 0}
    for kind, fault in zip(kinds, faults):
        for _ in range(2):
            for s, t in ((0, 2), (1, 2), (3, 2), (2, 3)):
                best[t] = min(best.get(t, 9**9), best.get(s, 9**9) + 3)
        after = {s: c + 4 for s, c in best.items()}
        if fault not in (1, 2):
            for symbol, moves in FOLLOWS.items():
                change = 0 if "uaso"[kind] == symbol else 3 if symbol != "s" else 9**9
                for s, t in moves.items():
                    if s in best:
                        after[t] = min(after.get(t, 9**9), best[s] + change + 3 * (fault == 3))
        best = after
    assert cost == min(best.get(0, 9**9), best.get(3, 9**9), best.get(2, 9**9) + 3, best.get(1, 9**9) + 6)


def test_a_band_is_narrow_where_little_is_wrong():
    table = repair._Table(*(lambda c: (c % 4, c // 4))(repair.np.array([0, 1] * 500 + [0, 0, 1])), 3)
    assert max(h - l for l, h in zip(table.low, table.high)) <= 2


def test_summaries_against_a_plain_version(spark):
    pick = random.Random(9)
    said = ["Yes.", "No!", "", " \n", "cut off", "Long? \t", "…", "Maybe.\n", None]
    conversations = {
        c: [
            (pick.choice([k, k, k, None, k // 2]), pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             pick.choice(said))
            for k in range(pick.choice([1, 2, 3, 5, 7]))
        ]
        for c in [None, *range(150)]
    }
    conversations[500] = [(k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(900)]
    got = summaries(spark, conversations)
    for c, told in conversations.items():
        if c != 500:
            assert got[c] == plain_summary(told), told
    assert got[500][:7] == (0, 0, 0, 0, 0, 0, "K" * 900)


@pytest.mark.parametrize(
    "told, cost, audit",
    [
        ([(0, "user", "Hi.")], 3, "KI"),
        ([(0, "assistant", "Hi.")], 3, "IK"),
        ([(0, "system", "Be kind.")], 4, "D"),
        ([(0, "user", "")], 4, "D"),
        ([(0, "user", "Hi."), (1, "user", "Hello.")], 3, "KR"),
        ([(0, "system", "Be."), (1, "user", "A."), (2, "assistant", "B")], 3, "KKK"),
    ],
)
def test_examples(spark, told, cost, audit):
    got = summaries(spark, {1: told})[1]
    assert got[5:7] == (cost, audit) and got == plain_summary(told)


def test_very_long_texts_extra_columns_and_empty_tables(spark):
    text = "word " * 400_000 + "end."
    got = summaries(spark, {1: [(0, "user", text), (0, "user", text), (1, "assistant", text)]})[1]
    assert got[5:7] == (4, "KDK") and got == plain_summary([(0, "user", text), (0, "user", text), (1, "assistant", text)])
    assert summaries(spark, {}) == {}
    rows, told = repair.repair(spark.createDataFrame([(1, 5, "user", "Hi.", "", "", "")], SCHEMA))
    assert [tuple(r) for r in repair.repaired(rows, told).collect()] == [(1, 1, "user", "Hi.", "K"), (1, 2, "assistant", "", "I")]


def test_damage_and_query_against_a_plain_version(spark, folder):
    pick = random.Random(1)
    rows = [
        (pick.choice([None, *range(40)]), pick.choice([None, *range(6)]), pick.choice(["user", "assistant", "system", None]),
         pick.choice(["So. It is!", "Well", None, "Done? Yes."]))
        for _ in range(300)
    ] + [(77, 13, "user", "Alone.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{folder}/conversations.parquet"
    )
    want = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (c, t))
        fate, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        want[c] += [(t, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    assert zlib.crc32(b"77:13") % 20 == 0 or want[77]
    got = queries.op11_conversation_repair(spark, folder).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {
        c: plain_summary(told) if told else (0, 0, 0, 0, 0, 0, "", EMPTY) for c, told in want.items()
    }
    assert len(got) == len(want)


def test_every_row_of_a_conversation_can_be_lost(spark, folder):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string").write.parquet(
        f"{folder}/conversations.parquet"
    )
    assert [tuple(r) for r in queries.op11_conversation_repair(spark, folder).collect()] == [
        (lost, 0, 0, 0, 0, 0, 0, "", EMPTY)
    ]


def test_texts_are_not_gathered_per_conversation(spark):
    rows, told = repair.repair(spark.createDataFrame([(1, 0, "user", "Hi.", "", "", "")], SCHEMA))
    plan = repair.digests(rows, told)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "FlatMapGroups" not in plan
