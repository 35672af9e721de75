"""The rule cascade against rules asked one by one, and its counts against plain loops."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from check import differences, oracle
from tidemark.llm import quality_rules as rules
from tidemark.llm.oracle import ORACLE

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    again = {k + j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(again) > 20 * len(words)

    def top(width):
        grams = Counter(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
        return max((n * len("".join(g)) for g, n in grams.items() if n > 1), default=0)

    chars = sum(map(len, words))
    letters = [c for c in text if rules.unicodedata.category(c)[0] == "L"]
    lettered = sum(any(rules.unicodedata.category(c)[0] == "L" for c in w) for w in words)
    symbols, dup = sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    rejected = failed or (
        chars < 2 * len(words) or chars > 20 * len(words) or 100 * symbols > 10 * len(words)
        or 100 * dup > 30 * len(lines) or 100 * lettered < 70 * len(words)
        or 100 * sum(rules.unicodedata.category(c) == "Lu" for c in letters) > 50 * len(letters)
        or 100 * sum(bool(re.match(r"[\x20\x09-\x0D]*[-*•]", line)) for line in lines) > 90 * len(lines)
        or 100 * sum(bool(re.search(r"(\.\.\.|…)[\x20\x09-\x0D]*$", line)) for line in lines) > 30 * len(lines)
        or 100 * top(2) > 20 * chars or 100 * top(3) > 18 * chars or 100 * top(4) > 16 * chars
    )
    return len(words), chars, symbols, dup, len(again), failed, not rejected


def texts(count, seed):
    pick = random.Random(seed)
    vocabulary = [*("der die und ein über größe Straße naïve mit von haus baum fluss licht".split()), "W$$", "42", "½", "ﬁn", "ABC", "-", "..."]
    for _ in range(count):
        some = pick.sample(vocabulary, pick.randint(2, len(vocabulary)))
        yield "".join(pick.choice(some) + pick.choice([" ", " ", " ", "\n", "\t", " ", "\x0b"]) for _ in range(pick.randint(0, 90)))


def judged(spark, rows, documents, **options):
    return {r.doc_id: tuple(r)[1:] for r in rules.judged(documents([(i, t, None, None) for i, t in rows]), **options).collect()}


def test_against_plain_counts_and_rules(spark, documents):
    rows = list(enumerate([*texts(600, 2), None, "", " \n\t ", "a b c d e " * 40, "Größe " * 9, "x" * 5000, "ein Wort " + "z " * 30]))
    got = judged(spark, rows, documents, every=7)
    assert {i: g[:-1] for i, g in got.items()} == {i: plain(t) for i, t in rows}
    assert 20 < sum(g[6] for g in got.values()) < len(got) - 20
    assert all((asked == 0) == failed for *_, failed, _, asked in got.values())


def test_very_long_text_and_gram_ranks():
    pick = random.Random(5)
    words = [f"w{pick.randrange(9000)}" for _ in range(60_000)]
    words[30_000:30_040] = words[:40]
    text = rules.Text(" ".join(words))
    assert text._numbered[1] ** 5 > 1 << 62
    got = (text.n_words, text.word_chars, text.n_symbols, text.n_dup_lines, text.n_repeat_words)
    assert got == plain(text.text)[:5] and got[4] >= 80


def test_null_ids_repeated_rows_and_empty_tables(spark, documents):
    rows = [(None, "a b"), (None, None), (3, "c " * 4), (3, "c " * 4)]
    got = rules.judged(documents([(i, t, None, None) for i, t in rows])).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == [("3", 4), ("3", 4), ("None", 0), ("None", 2)]
    assert rules.judged(documents([])).collect() == []


def test_the_order_is_by_rejections_per_cost_of_what_is_left():
    rejected = np.zeros((100, 4), bool)
    rejected[:40, 0] = rejected[:38, 1] = rejected[40:50, 2] = True
    cost = np.array([100.0, 90.0, 50.0, 1.0])
    # Rule 1 is the best at first, but leaves rule 0 two documents; rule 2 rejects others.
    assert rules.by_rejection_per_cost(rejected, cost) == [1, 2, 0, 3]
    assert rules.by_rejection_per_cost(np.zeros((5, 3), bool), np.array([3.0, 1.0, 2.0])) == [1, 2, 0]


def test_the_cascade_asks_cheap_rejecting_rules_first():
    asked = Counter()

    def rule(name, work, rejects):
        def run(text):
            asked[name] += 1
            sum(range(work))
            return rejects(text)

        return rules.Rule(name, run)

    made = [rule("dear", 200_000, lambda t: b"q" in t.data), rule("idle", 10, lambda t: False), rule("cheap", 10, lambda t: b"z" in t.data)]
    cascade = rules.Cascade(made, every=16)
    some = [rules.Text(f"text {k} " + ("z" if k % 3 else "q" if k % 2 else "")) for k in range(600)]
    verdicts = [cascade.rejects(t)[0] for t in some]
    assert verdicts == [b"z" in t.data or b"q" in t.data for t in some]
    assert cascade.rules[cascade.order[0]].name == "cheap" and asked["dear"] < 0.6 * len(some)


@pytest.mark.parametrize("seed", [11, 12])
def test_sql_counterpart(spark, documents, folder, seed):
    rows = [*enumerate(texts(150, seed)), (1000, None), (1000, "ein " * 20), (-1, "…\n... \n-\n" * 9)]
    docs = documents([(i, t, "de", "s") for i, t in rows], clashing=False)
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = oracle("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    got = rules.judged(spark.read.parquet(f"{folder}/documents.parquet")).drop("rules_asked").toPandas()
    assert differences(got, con.execute(ORACLE["op13_quality_rules"]).df()) == ""
