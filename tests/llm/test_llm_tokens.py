"""Token files and edit-aware counts against the tokenizer itself."""

import json
import random
import time
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import encoding, token_count, token_file  # noqa: E402

CONTENT = encoding.content(public_tokenizers.path("byte_bpe_50k.json"))
POOL = [*"ab A9.,,.  \n\n\n'é_-\t!?\"»ñ", "'s", "it's", " word", "...", "\n\n", "² ", "<|endoftext|>", "漢字", "\x1c"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_str(CONTENT)


def ids(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer(plain, monkeypatch):
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(POOL, k=rnd.randint(0, 9))) for _ in range(4000)] + ["Some words, and more.\nThen on. "]
    want = [np.array(e.ids, np.uint32).tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert encoding.Encoder(CONTENT).encode(texts) == want
    monkeypatch.setattr(encoding, "KEPT", 50)
    small = encoding.Encoder(CONTENT)
    assert [small.encode([t])[0] for t in texts[:500]] == want[:500] and len(small.known) <= 60


def lists(arrays):
    return [values[a:b].tolist() for bounds, values in arrays for a, b in zip(bounds[:-1], bounds[1:])]


def test_texts_are_cut_as_one_array(plain):
    rnd, coder = random.Random(6), encoding.Encoder(CONTENT)
    pool = [*POOL, "\u00a0", "\u3000", "\u2003", "×", "é.", "×.", "»,", "<|endof", "text|>", "\r\n", "\t\t", "’s", "ʰ.", "\U0001f600."]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 12))) for _ in range(4000)]
    texts += ["<|endof", "text|>", "", " ", "", ". a", "é", ". b", "x\n", "\n", "\n\n y"]
    want = [[*e.ids, 0] for e in plain.encode_batch(texts, add_special_tokens=False)]
    for kind in (pa.string(), pa.large_string()):
        assert lists(coder.arrays(pa.array(["left out", *texts], kind)[1:], 0)) == want
    assert lists(coder.arrays(pa.array(texts))) == [w[:-1] for w in want]
    for few in ([], ["", "", ""], *([t] for t in texts)):
        assert lists(coder.arrays(pa.array(few, pa.string()), 0)) == [[*ids(plain, t), 0] for t in few]


def test_other_tokenizers_encode_whole_texts():
    rule = json.loads(CONTENT)
    rule["pre_tokenizer"]["add_prefix_space"] = True
    other = json.dumps(rule)
    texts = ["a b", "", "word, <|endoftext|>  x"] * 200
    want = [[*e.ids, 0] for e in Tokenizer.from_str(other).encode_batch(texts, add_special_tokens=False)]
    assert lists(encoding.Encoder(other).arrays(pa.array(texts), 0)) == want


def test_repeated_words_cost_a_fraction_of_the_tokenizer(plain):
    rnd, coder = random.Random(4), encoding.Encoder(CONTENT)
    words = ["".join(rnd.choices(["an", "the", "ing", "or", "ti", "é"], k=rnd.randint(1, 4))) for _ in range(3000)]
    texts = [" ".join(rnd.choices(words, k=500)) + ".\n" for _ in range(600)]

    def seconds(function):
        least = []
        for _ in range(4):
            coder.known.clear()
            begin = time.process_time()
            function()
            least.append(time.process_time() - begin)
        return min(least)

    whole = seconds(lambda: plain.encode_batch_fast(texts, add_special_tokens=False))
    assert seconds(lambda: coder.encode(texts)) < whole / 6


def test_blocks_of_texts_give_the_same_rows(plain, monkeypatch):
    texts = ["some words, and some words", "", "漢字 words", "long " * 300, None, "last one.\n"] * 60
    batches = [
        pa.record_batch({"doc_id": list(range(k, k + 90)), "block": [3] * 90, "text": [t or "" for t in texts[k : k + 90]]})
        for k in range(0, 360, 90)
    ]
    found = []
    for block in (token_file.BLOCK, 5000, 1):
        monkeypatch.setattr(token_file, "BLOCK", block)
        sizes = [b.num_rows for b in token_file._blocks(iter(batches))]
        assert sum(sizes) == 360 and (len(sizes) == 1 or block < 1 << 20) and (block > 1 or set(sizes) == {1})
        found.append([row for b in token_file._encode(SimpleNamespace(value=CONTENT), 0)(iter(batches)) for row in b.to_pylist()])
    assert found[0] == found[1] == found[2]
    assert [r["ids"] for r in found[0]] == [[*ids(plain, t), 0] for t in texts]
    starts = np.cumsum([0, *(r["n_tokens"] for r in found[0])])[:-1].tolist()
    assert [(r["doc_id"], r["block"], r["start_in_block"]) for r in found[0]] == [(k, 3, n) for k, n in enumerate(starts)]


def test_token_file_round_trip(spark, documents, plain, folder):
    rows = [(k, f"text {k} " * (k % 7), "en", "s") for k in range(200)]
    rows += [(None, "no id", None, None), (500, None, "en", "s"), (501, "", "en", "s"), (502, "long " * 60_000, "en", "s")]
    rows += [(7, "again", "en", "s")] * 2
    path = f"{folder}/ids"
    token_file.write(documents(rows), path, CONTENT)
    back = token_file.read(spark, path)
    got = [(r.doc_id, r.start, r.n_tokens, list(r.ids)) for r in back.orderBy("start").collect()]
    key = [-1 if g[0] is None else g[0] for g in got]
    assert key == sorted(key) and len(got) == len(rows)
    start = 0
    for _, at, n, tokens in got:
        assert at == start and n == len(tokens) and tokens[-1] == 0
        start += n
    assert sorted((str(i), tuple(t)) for i, _, _, t in got) == sorted(
        (str(i), (*ids(plain, t), 0)) for i, t, _, _ in rows
    )
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in token_file.checksums(back).collect()}
    assert all(sums[i, at] == zlib.crc32(np.array(t, "<u4").tobytes()) for i, at, _, t in got)
    chosen = token_file.read(spark, path, F.col("doc_id").isin(3, 150)).collect()
    assert sorted((r.doc_id, r.start) for r in chosen) == sorted((i, at) for i, at, _, _ in got if i in (3, 150))


def test_token_file_has_ordered_files_and_indexes(spark, documents, folder, tmp_path):
    path = f"{folder}/ids"
    token_file.write(documents([(k, "a b c", "en", "s") for k in range(3000)]), path, CONTENT)
    last = -1
    for name in sorted(tmp_path.joinpath("ids").glob("*.orc")):
        file = orc.ORCFile(str(name))
        found = file.read(["doc_id"])["doc_id"].to_pylist()
        assert found == sorted(found) and found[0] > last
        assert file.row_index_stride == 1000 and b"BLOOM" not in name.read_bytes()[:3]
        last = found[-1]
    plan = token_file.read(spark, path, F.col("doc_id") == 5)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)" in plan


def test_token_file_of_nothing(spark, documents, folder):
    token_file.write(documents([]), f"{folder}/ids", CONTENT)
    assert token_file.checksums(token_file.read(spark, f"{folder}/ids")).count() == 0


def test_tree_follows_random_edits(plain):
    rnd, coder = random.Random(8), encoding.Encoder(CONTENT)
    words = [" a b", "word", "  ", "'s", "\n\n", "12", "it's 3.5 km  ", "word " * 120, " '", "."]
    for _ in range(150):
        text = "".join(rnd.choices(words, k=rnd.randint(0, 12)))
        tree = token_count.Tree.of(text, coder)
        for _ in range(5):
            at, deleted, inserted = rnd.randint(0, len(text) + 2), rnd.choice((0, 1, 3, 40, 700)), rnd.choice(words)
            tree.edit(at, deleted, inserted, coder)
            at = min(at, len(text))
            text = text[:at] + inserted + text[at + deleted :]
            assert "".join(n.text for n in tree.leaves()) == text
            assert tree.root.tokens == len(ids(plain, text)) and tree.root.chars == len(text)


def test_counts_after_edits(spark, documents, plain):
    long = "some words of a long text, and so on. " * 3000
    rows = [(1, long, "en", "s"), (2, None, "en", "s"), (3, "", "en", "s"), (None, "ab <|endoftext|> cd", None, None)]
    rows += [(4, "same", "en", "s"), (4, "same", "en", "s")]
    trees = token_count.build(documents(rows), CONTENT)
    edit = "named_struct('at', {}, 'deleted', {}, 'inserted', {})"
    edits = f"array({edit.format(50_000, 7, repr('new things'))}, {edit.format(2, 'null', repr(' x '))}, null)"
    got = token_count.edited(trees.selectExpr("*", f"{edits} AS edits"), CONTENT).collect()
    want = []
    for i, t, _, _ in rows:
        t = t or ""
        at = min(50_000, len(t))
        t = t[:at] + "new things" + t[at + 7 :]
        want.append((i, t[:2] + " x " + t[2:]))
    assert sorted((str(r.doc_id), r.text, r.n_tokens) for r in got) == sorted(
        (str(i), t, len(ids(plain, t))) for i, t in want
    )
    assert next(r.encoded for r in got if r.doc_id == 1) < 3000
    unchanged = token_count.edited(trees.selectExpr("*", "cast(null AS array<struct<at:int,deleted:int,inserted:string>>) AS edits"), CONTENT)
    assert {r.n_tokens_before == r.n_tokens for r in unchanged.collect()} == {True}
    assert token_count.build(documents([]), CONTENT).count() == 0
