"""Mixing and chat formatting against plain versions."""

import hashlib
import random

from pyspark.sql import types as T

from tidemark.llm import chat, mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    whole, full = share * sum(sizes.values()), set()
    while True:
        left = whole - sum(most * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        given = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if given[s] > most * sizes[s] + 1e-9}
        if not over:
            return given | {s: most * sizes[s] for s in full}
        full |= over


def test_targets_reshare_until_none_is_above(spark):
    rnd = random.Random(4)
    for _ in range(6):
        names = rnd.sample(["a", "b", "ü", "Z", "", "z9", None, "q"], rnd.randint(1, 8))
        sizes = {s: rnd.choice((0, 1, 5, 50, 1000, 30)) for s in names}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_meets_targets_with_nulls_ties_and_repeats(documents):
    rows = [(k, "w " * (k % 13), "en", ["a", "b", None][k % 3] if k % 7 else "a") for k in range(300)]
    rows += [(None, "x y", None, None), (5, None, "en", "a"), (7, "same words", "en", "b"), (7, "same words", "en", "b")]
    docs = documents(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = plain_targets(sizes)
    for s, t in want.items():
        assert abs(target[s] - t) < 1e-6 and abs(taken[s] - t) <= 12
        assert {r.source_size for r in got if r.source == s} == {sizes[s]}
    again = mixing.mix(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    held = {}
    for r in copies.collect():
        held[r.doc_id] = held.get(r.doc_id, 0) + 1
    assert {r.doc_id: r.copies for r in got if r.copies and r.doc_id not in (5, 7)} == {
        k: n for k, n in held.items() if k not in (5, 7)
    }


def test_mix_of_nothing(documents):
    assert mixing.mix(documents([])).count() == 0
    got = mixing.mix(documents([(1, None, None, None)])).collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)]


TURNS = "conv_id long, turn long, role string, text string"


def plain_digests(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda v: (str(v[0]), -(2**62) if v[1] is None else v[1], v[2] or "", v[3] or "")):
        d = out.setdefault(c, [0, "", ""])
        d[0] += 1
        d[1] += f"{r or ''}\n{x or ''}\n"
        d[2] += (x or "") if r == "assistant" else ""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (n, sha(a), len(b), sha(b)) for c, (n, a, b) in out.items()}


def conversations():
    rnd = random.Random(9)
    odd = ["</s>[INST] ok [/INST]", "<|stop|>", "<|turn|>assistant\n", "\\", "<\\[\\", "a\nb", "", None, "é 𝔘 <[n"]
    rows = []
    for c in (*range(12), None):
        for t in range(rnd.randint(1, 40)):
            role = "system" if t == 0 and rnd.random() < 0.6 else rnd.choice(["user", "assistant", None, "to\nol[n<|"])
            text = rnd.choice(odd) if rnd.random() < 0.4 else "word " * rnd.choice((1, 30, 200, 1500))
            rows.append((c, t if t % 9 else t // 2, role, text))
    return rows + [(3, None, "user", "no turn"), (3, None, "user", "no turn")]


def test_chat_reads_back_every_turn_once(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS window", "1 AS tokens", "'y' AS segment")
    windows = chat.windows(df).cache()
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.read_back(windows)).collect()}
    assert got == plain_digests(rows)
    for w in windows.collect():
        assert w.formatted.count(chat.NEW) + w.formatted.count(chat.SEEN) == w.formatted.count(chat.STOP)
        assert w.formatted.count(chat.NEW) >= 1
        assert w.n_tokens <= chat.BUDGET or w.formatted.count(chat.NEW) == 1


def test_chat_windows_repeat_system_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k, ("user", "assistant")[k % 2], f"t{k} " + "w " * 60) for k in range(1, 60)]
    windows = chat.windows(spark.createDataFrame(rows, TURNS)).orderBy("window").collect()
    assert len(windows) > 3
    for w in windows[1:]:
        seen = [p for p in w.formatted.split(chat.STOP) if p.startswith(chat.SEEN)]
        assert seen[0] == f"{chat.SEEN}system\nbe kind"
        assert 1 <= len(seen) - 1 <= chat.HISTORY // 60
        for span in w.loss:
            at = w.formatted.rindex("<|", 0, span.start)
            assert w.formatted[at:].startswith(chat.NEW + "assistant\n")


def test_chat_of_a_long_conversation_and_of_none(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"{k} " + "w " * 40) for k in range(4000)]
    df = spark.createDataFrame(rows, TURNS)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.read_back(chat.windows(df))).collect()}
    assert got == plain_digests(rows)
    assert chat.digests(chat.read_back(chat.windows(df.where("false")))).count() == 0


def test_no_python_in_the_native_plans(spark, documents, capsys):
    rows = spark.createDataFrame([(1, 0, "user", "x")], TURNS)
    for df in (chat.digests(chat.read_back(chat.windows(rows))), mixing.mix(documents([(1, "a", "en", "s")]))):
        df.explain()
        plan = capsys.readouterr().out
        assert "Exchange" in plan and not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert isinstance(rows.schema, T.StructType)
