"""Language identification, decontamination and licence scans."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import decontaminate, known_licenses, language, licenses

WORDS = {
    "aa": "lora mina tesu paro".split(),
    "bb": "grunk schlopf wrzt kranz".split(),
    "cc": "éàü îôé ñandú çava".split(),
}


def texts(seed, n, short=3):
    rnd = random.Random(seed)
    return [(lang, " ".join(rnd.choices(WORDS[lang], k=rnd.randint(short, 60)))) for _ in range(n) for lang in WORDS]


def test_language_held_out_and_odd_texts(documents):
    rows = [(k, t, lang, "s") for k, (lang, t) in enumerate(texts(1, 40))]
    model = language.train(documents(rows))
    assert model.languages == ["aa", "bb", "cc"]
    odd = [(1000, None, "aa", None), (1001, "", None, None), (1002, "12 34 !!", "bb", "s"), (None, "lora", None, "s")]
    odd += [(1003, "grunk " * 100_000, "aa", "s"), (1004, "lora mina", "bb", "s"), (1004, "lora mina", "bb", "s")]
    fresh = [(2000 + k, t, None, "s") for k, (_, t) in enumerate(texts(2, 30))]
    got = language.predict(documents(odd + fresh), model).collect()
    assert len(got) == len(odd) + len(fresh)
    found = {r.doc_id: r for r in got}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1000, 1001, 1002))
    assert (found[None].lang_pred, found[1003].lang_pred, found[1004].lang_pred) == ("aa", "bb", "aa")
    want = [lang for lang, _ in texts(2, 30)]
    assert [found[2000 + k].lang_pred for k in range(len(want))] == want
    assert all(1 / 3 <= found[2000 + k].score <= 1 for k in range(len(want)))


def test_language_without_labels_or_rows(documents):
    model = language.train(documents([(1, "some text", None, None), (2, None, "aa", None)]))
    assert model.languages == []
    assert [tuple(r) for r in language.predict(documents([(1, "abc", None, None)]), model).collect()] == [(1, "und", 0.0)]
    assert language.predict(documents([]), model).count() == 0


def plain_bits(fit, text, order):
    """Code length of a text under one language, context by context."""
    count = {}
    for t in fit:
        held = b"\0" * order + t
        for i in range(order, len(held)):
            for k in range(order + 1):
                seen = count.setdefault(held[i - k : i], {})
                seen[held[i]] = seen.get(held[i], 0) + 1
    bits, held = 0.0, b"\0" * order + text
    for i in range(order, len(held)):
        for k in range(order, -1, -1):
            seen = count.get(held[i - k : i])
            if seen is None:
                continue
            n, q = sum(seen.values()), len(seen)
            if held[i] in seen:
                bits += math.log2((n + q) / seen[held[i]])
                break
            bits += math.log2((n + q) / q)
        else:
            bits += 8
    return bits


def test_code_lengths_equal_plain_ones(documents):
    rows = [(k, t, lang, "s") for k, (lang, t) in enumerate(texts(3, 6))]
    model = language.train(documents(rows))
    asked = [t.encode() for _, t in texts(4, 3, short=1)] + [b"", b"zz grunk \xff"]
    old = language.SLICE
    try:
        language.SLICE = 50  # texts across slices
        got = model.bits(asked) / 256
    finally:
        language.SLICE = old
    for l, lang in enumerate(model.languages):
        fit = [t.encode() for _, t, name, _ in rows if name == lang]
        for k, text in enumerate(asked):
            assert abs(got[k, l] - plain_bits(fit, text, language.ORDER)) <= (len(text) + 1) / 256


ITEM = "A train leaves Boston at 60 km per hour and meets Alice after 3 hours on the long bridge"


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM), (2, None), (3, ""), (4, "only three words"), (5, "the quick brown fox jumps over one lazy dog today")]
    return spark.createDataFrame(rows + [(1, ITEM)], "item_id long, text string").selectExpr("*", "'x' AS template")


def found(documents, benchmark, texts, **options):
    docs = documents([(k, t, "en", "s") for k, t in enumerate(texts)])
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, benchmark, **options).collect()}


def test_decontamination_finds_copies_and_new_parameters(documents, benchmark):
    other = ITEM.replace("Boston", "Denver").replace("60", "85").replace("Alice", "Robert").replace("3", "7")
    got = found(documents, benchmark, [
        f"Some words before. {ITEM} And after.", f"so then {other}, they said", ITEM.upper(), None, "",
        "clean text of many other words that nobody has ever put into a benchmark item", "only three words",
        "only three words more", (ITEM + " ") * 3, "the quick brown fox",
    ])
    assert set(got) == {(0, 1), (1, 1), (2, 1), (6, 4), (8, 1)}
    assert got[0, 1].changed == 0 and got[0, 1].matched == got[0, 1].windows and got[1, 1].changed >= 4


def test_decontamination_asks_for_consistent_slots(documents, spark):
    item = "Tom gave Ann 5 apples and then Ann gave Tom 5 apples back before Tom left Ann there"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = item.replace("Tom", "Bob").replace("Ann", "Eve").replace("5", "9")
    mixed = "Bob gave Eve 9 apples and then Joe gave Sue 4 apples back before Kim left Lea there"
    got = found(documents, benchmark, [f"See, {same}", f"See, {mixed}"])
    assert set(got) == {(0, 1)}


def test_decontamination_with_a_full_filter_and_without_rows(documents, benchmark, monkeypatch):
    docs = [f"x y z. {ITEM}", "nothing in here that would be known from elsewhere at all"]
    assert set(found(documents, benchmark, docs)) == {(0, 1)}
    # Of its 64 bits nearly all are set: it lets much through, which the join drops.
    monkeypatch.setattr(decontaminate, "MOST_BITS", 1)
    monkeypatch.setattr(decontaminate, "BITS_EACH", 0)
    assert set(found(documents, benchmark, docs)) == {(0, 1)}
    assert not found(documents, benchmark, [])
    assert not found(documents, benchmark.where("false"), docs)


def test_the_filter_knows_what_is_in_it(spark):
    inside = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 5000)
    kept = decontaminate.window_filter(spark.createDataFrame([(int(h),) for h in inside], "hash long"))
    assert kept.may_hold(inside.view(np.uint64)).all() and kept.bits == 1 << 17
    others = np.random.default_rng(4).integers(0, 2**63 - 1, 20_000).astype(np.uint64)
    assert kept.may_hold(others).mean() < 0.01


def plain_pairs(docs, items, common=decontaminate.COMMON):
    """Pairs for texts of lower-case words without numbers, by word windows alone."""
    windows = lambda text: [tuple(text.split()[k : k + 8]) for k in range(max(1, len(text.split()) - 7))]
    holders = {}
    for text in {t for _, t in items}:
        for w in windows(text):
            holders.setdefault(w, set()).add(text)
    out = set()
    for d, doc in docs:
        there = set(windows(doc))
        for i, text in items:
            count = [len(holders[w]) <= common for w in windows(text)]
            count = count if any(count) else [True] * len(count)
            held = [c and w in there for c, w in zip(count, windows(text))]
            run = best = 0
            for h in held:
                run = run + 1 if h else 0
                best = max(best, run)
            if 2 * sum(held) >= sum(count) or best + 7 >= 13:
                out.add((d, i))
    return out


def test_decontamination_against_plain_windows(documents, spark):
    pick = np.random.default_rng(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in "mnrst"]
    words = lambda n: " ".join(pick.choice(vocabulary, n))
    prompt, phrase = words(17), words(11)
    items = [(i, f"{prompt} {words(int(pick.integers(5, 40)))}") for i in range(12)]
    items += [(20 + i, f"{words(12)} {phrase} {words(12)}") for i in range(6)]
    items += [(30 + i, f"{words(9)} {prompt}") for i in range(3)] + [(40, items[0][1]), (41, prompt), (42, items[15][1])]
    docs = [f"{words(30)} {prompt} {words(20)}" for _ in range(20)] + [f"{words(30)} {phrase} {words(20)}" for _ in range(5)]
    for _, text in items:
        w = text.split()
        a, n = int(pick.integers(0, len(w))), int(pick.integers(8, 40))
        docs.append(f"{words(10)} {' '.join(w[a : a + n])} {words(10)}")
    docs += [f"{words(400)} {items[14][1]} {words(4000)}", docs[-1], docs[-1]]
    rows = list(enumerate(docs))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = plain_pairs(rows, items)
    assert set(found(documents, benchmark, docs)) == want
    # The prompt alone is an item of its own, and no other is found by it.
    assert {i for d, i in want if d < 20} == {41} and len(want) > 40


def test_a_common_instruction_reports_nobody(documents, spark):
    prompt = "read the following passage with care and then choose the one best answer out of those given below"
    names = ["north", "south", "east", "west", "red", "blue", "dark", "light", "old", "new"]
    tail = lambda i: " ".join(f"{names[int(c)]}{j}{i}" for j, c in enumerate(f"{i:05}" * 3))
    items = spark.createDataFrame([(i, f"{prompt} {tail(i)}") for i in range(200)], "item_id long, text string")
    docs = [f"Some clean page {i}. {prompt} And it goes on with text of its own number {i}." for i in range(200)]
    assert not found(documents, items, docs)
    assert set(found(documents, items, [*docs[:3], f"so {prompt} {tail(7)} and on"])) == {(3, 7)}


def test_questions_of_one_family_are_told_by_their_words(documents, spark):
    ask = "If Tom has {} apples and buys {} more at the old market how many apples does Tom have now"
    items = spark.createDataFrame([(i, ask.format(10 + i, 90 - i)) for i in range(30)], "item_id long, text string")
    docs = [f"Well. {ask.format(13, 87)} Tell me.", f"Well. {ask.format(500, 600)} Tell me."]
    assert set(found(documents, items, docs)) == {(0, 3)}


def test_decontamination_without_ids_repeated_and_long(documents, spark):
    benchmark = spark.createDataFrame([(None, ITEM), (2, ITEM), (2, "no such thing is to be found in any of them ever")], "item_id long, text string")
    docs = documents([(None, f"See {ITEM}.", "en", "s")] * 3 + [(None, "clean", "en", "s"), (4, "word " * 200_000 + ITEM, "en", "s"), (5, None, "en", "s")])
    got = decontaminate.contaminated(docs, benchmark)
    assert sorted(map(str, ((r.doc_id, r.item_id) for r in got.collect()))) == ["(4, 2)", "(4, None)", "(None, 2)", "(None, None)"]


def test_decontamination_drops_only_conflicting_windows(documents, spark):
    item = "We bought 5 apples on a sunny market day and later sold them to 5 friends who were very glad to have them"
    other = "In 3 hours the slow boat goes down the long river and then it takes 4 days to come back home again"
    benchmark = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = found(documents, benchmark, [
        f"So {item.replace('5 friends', '6 friends')}.", f"So {item.replace('5 apples', '3 apples').replace('5 friends', '7 friends')}.",
        f"So {other.replace('3', '9').replace('4', '9')}.",
    ])
    assert set(got) == {(0, 1), (1, 1), (2, 2)}
    assert [got[k].windows - got[k].matched for k in ((0, 1), (1, 1), (2, 2))] == [0, 3, 0]


def test_decontamination_finds_short_items_and_short_quotes(documents, spark):
    long = " ".join(f"{a}{b}" for a in "abcdefgh" for b in ("lo", "mi", "na", "re", "su", "ta", "vo", "xu"))
    items = [(1, "what grows under the old bridge"), (2, long), (3, "just four plain words"), (4, "Solve 7 + 8 - 19 = 21 now")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    part = lambda n: " ".join(long.split()[20 : 20 + n])
    got = found(documents, benchmark, [
        f"In a long text, {items[0][1]}, they asked us all again.", f"so it says {part(13)} and no more", f"so it says {part(12)} and no more",
        "There are just four plain words in it that count.", "what grows under the new bridge", f"Please do this. {items[3][1]} or else",
    ])
    assert set(got) == {(0, 1), (1, 2), (3, 3), (5, 4)}


def test_decontamination_finds_copies_with_few_literals(documents, spark):
    items = [(1, "Compute 12 + 34 - 56 * 78 / 9 + 10 + 11 + 12 - 13 + 14"), (2, "The Old Man And The Sea By Ernest Hemingway Of Oak Park")]
    items += [(3, "every one of these plain words is a literal in the item as it stands here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [f"Please do this. {t} And more." for _, t in items] + [f"see {items[1][1].lower()} now", f"see {items[2][1].title()} now"]
    docs += ["Compute 11 + 34 - 55 * 78 / 8 + 10 + 12 + 12 - 14 + 14"]
    assert set(found(documents, benchmark, docs)) == {(0, 1), (1, 2), (2, 3), (3, 2), (4, 3)}


def test_tokens_do_not_depend_on_slices(monkeypatch):
    text = ("It's 5 km to Paris. Ünder Él, 'quoted' (12) kg!\n" * 30).encode()
    whole = decontaminate.Tokens([text, b"", text])
    from tidemark.llm import hashing

    monkeypatch.setattr(decontaminate, "slices", lambda data: hashing.slices(data, 37))
    cut = decontaminate.Tokens([text, b"", text])
    for c in ("first", "after", "code", "kind", "text"):
        assert np.array_equal(getattr(whole, c), getattr(cut, c))


def test_license_texts_in_other_spellings(spark, documents):
    mit = "Copyright (c) 2020 A. Author. All rights reserved.\n\n" + known_licenses.KNOWN["MIT"][0]
    bsd = known_licenses.KNOWN["BSD-3-Clause"][0].upper().replace("COPYRIGHT HOLDER ", "COPYRIGHT OWNER ")
    rows = [
        (1, mit.replace("\n", "  \n ").replace("sublicense", "sub-licence"), "en", "s"),
        (2, f"prose\n\n  * {known_licenses.KNOWN['ISC'][0]}\n\nmore", "en", "s"),
        (3, bsd, "en", "s"), (4, "text\n  -- released UNDER the mit Licence!!\nRELEASED UNDER THE MIT LICENSE", "en", "s"),
        (5, None, "en", "s"), (6, "", "en", "s"), (7, "This text is under the MIT License, they say.", "en", "s"),
        (None, "Licensed under CC BY-SA 4.0.", None, None), (8, mit[:-9], "en", "s"), (9, "word " * 100_000, "en", "s"),
    ]
    known = licenses.known_digests(spark)
    got = sorted((str(r.doc_id), r.scope, r.nth, r.license) for r in licenses.scan(documents(rows), known).collect())
    assert ("1", "text", 0, "MIT") in got and ("3", "text", 0, "BSD-3-Clause") in got
    assert [g for g in got if g[0] == "4"] == [("4", "line", 1, "MIT"), ("4", "line", 2, "MIT")]
    assert [g for g in got if g[0] == "None"] == [("None", "line", 0, "CC-BY-SA-4.0"), ("None", "text", 0, "CC-BY-SA-4.0")]
    assert {g[0] for g in got} == {"1", "3", "4", "None"}
    assert licenses.scan(documents([]), known).count() == 0
    again = licenses.scan(documents(rows + rows), known).count()
    assert again == 2 * len(got)
