"""Benchmark decontamination by templates.

Texts become tokens: words without outer punctuation in lower case (ASCII and
Latin-1 letters), with numbers, names and units replaced by typed placeholders. A number is a word
with a digit; a unit is one of ``UNITS`` right after a number; a name is a
capitalised word, not all in capitals, that does not begin a sentence. Windows of tokens are hashed and
joined with the windows of the benchmark items; windows of a document with few
literal words are joined by their actual words, with every window of an item. A re-parameterised question
has the same template and other slot values, so along one alignment of document
and item every slot value stands for the value that most windows give it; windows
that break this do not count, unless their slots are the item's own.

Windows that many different items share, as a common instruction, say nothing of
any of them and do not count. If only their template is shared, by questions of one
family, they count for the item whose words they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored
from tidemark.llm.hashing import BASE, LOWER, UPPER, mixed, range_hashes, slices, words

WINDOW, LITERALS, COVERAGE = 8, 4, 0.5
# Words of an item in one unbroken run that are enough, whatever its length; words of the shortest item looked for within documents.
RUN, SHORTEST = 13, 4
# Benchmark texts that may share a window that counts.
COMMON = 8
# The filter that tasks get of the benchmark's windows: bits per window, most bits (16 MB), places per window.
BITS_EACH, MOST_BITS, PLACES = 16, 1 << 27, 4
# Words that count as a unit after a number.
UNITS = (
    "mm cm m km in ft mi inch inches foot feet yard yards mile miles metre metres meter meters "
    "kilometre kilometres kilometer kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound "
    "pounds ounce ounces ton tons tonne tonnes ml l litre litres liter liters gallon gallons cup cups "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year "
    "years percent dollar dollars cent cents euro euros kb mb gb tb hz khz mhz ghz w kw mw v kv j kj "
    "cal kcal n pa degree degrees mph kmh"
).split()
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"

ROWS = 512
_byte = np.arange(256)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_INNER = _DIGIT | UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
_ENDS = np.isin(_byte, list(b".!?:"))


def _hash_of(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(range_hashes(data, np.array([0]), np.array([len(data)]))[0])


_UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], np.uint64))
# Told from hashes of templates: those of actual words.
_ACTUAL = np.uint64(_hash_of("<actual>"))
_CODES = {kind: np.uint64(_hash_of(kind)) for kind in (NUMBER, NAME, UNIT)}


class Tokens:
    """The tokens of several texts: byte ranges, codes and kinds (0: a literal)."""

    KINDS = ("", NUMBER, NAME, UNIT)

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        self.data = joined
        self.lower = LOWER[joined]
        accented = np.flatnonzero((joined[:-1] == 0xC3) & (joined[1:] >= 0x80) & (joined[1:] <= 0x9E)) + 1
        self.lower[accented] += np.where(joined[accented] == 0x97, 0, 32).astype(np.uint8)
        self.bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        parts = [self._part(a, b) for a, b in slices(joined)]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
        self.first, self.after, self.code, opens, capital = columns
        self.text = np.searchsorted(self.bounds, self.first, "right") - 1
        digits = np.concatenate([[0], np.cumsum(_DIGIT[joined], dtype=np.int64)])
        number = digits[self.after] > digits[self.first]
        begins = np.concatenate([[True], self.text[1:] != self.text[:-1]])[: len(self.text)]
        follows = np.concatenate([[False], number[:-1]])[: len(number)] & ~begins
        unit = follows & ~number & np.isin(self.code, _UNIT_HASHES)
        name = capital & ~opens & ~begins & ~number & ~unit
        self.kind = np.where(number, 1, np.where(name, 2, np.where(unit, 3, 0)))
        self.words = self.code.copy()
        for k, kind in enumerate(self.KINDS[1:], 1):
            self.code[self.kind == k] = _CODES[kind]
        self.begins = begins

    def _part(self, low: int, high: int):
        data = self.data[low:high]
        start, stop = words(data)
        inner = _INNER[data]
        places = np.flatnonzero(inner)
        count = np.concatenate([[0], np.cumsum(inner)])
        full = count[stop] > count[start]
        start, stop = start[full], stop[full]
        first, after = places[count[start]], places[count[stop] - 1] + 1
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        before = np.concatenate([[0], stop[:-1]])[: len(start)]
        ended = _ENDS[data[np.maximum(before - 1, 0)]] & (before > 0)
        opens = ended | (lines[start] > lines[before])
        if len(opens) and low:
            opens[0] |= bool(_ENDS[self.data[low - 1]]) or self.data[low - 1] == 10
            opens[0] |= low > 1 and bool(_ENDS[self.data[low - 2]])
        head, lower = data[first], self.lower[low:high]
        changed = lower[first] != head
        changed |= (head == 0xC3) & (lower[np.minimum(first + 1, len(data) - 1)] != data[np.minimum(first + 1, len(data) - 1)])
        rest = np.minimum(first + 1 + (head == 0xC3), len(data) - 1)
        # Words in capitals are no names: their second letter would be small.
        small = (rest < after) & (lower[rest] == data[rest]) & (data[rest] != 0xC3)
        small |= (rest + 1 < after) & (data[rest] == 0xC3) & (data[np.minimum(rest + 1, len(data) - 1)] >= 0xA0)
        capital = changed & small
        return first + low, after + low, range_hashes(lower, first, after), opens, capital

    def word(self, k: int) -> str:
        return self.lower[self.first[k] : self.after[k]].tobytes().decode("utf-8", "replace")

    def windows(self, width: int, shorter: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and hash of every window, of shorter ones too; a text with fewer tokens is one window."""
        n = len(self.code)
        length = np.bincount(self.text, minlength=len(self.bounds) - 1) if n else np.zeros(0, np.int64)
        short = (length > 0) & (length < width)
        ends = np.cumsum(length)
        starts, sizes, hashes = [], [], []
        for w in (width, *shorter):
            at = np.arange(max(0, n - w + 1))
            at = at[self.text[at] == self.text[at + w - 1]] if len(at) else at
            value = np.zeros(len(at), np.uint64)
            for j in range(w):
                value = mixed(value * np.uint64(BASE) + self.code[at + j])
            starts.append(at)
            sizes.append(np.full(len(at), w))
            hashes.append(value if w == width else value ^ np.uint64(w))
        more = (ends - length)[short]
        values = []
        for a, l in zip(more, length[short]):
            v = np.zeros(1, np.uint64)
            for j in range(l):
                v = mixed(v * np.uint64(BASE) + self.code[a + j : a + j + 1])
            values.append(v[0] ^ np.uint64(l))
        return (
            np.concatenate([*starts, more]).astype(np.int64),
            np.concatenate([*sizes, length[short]]).astype(np.int64),
            np.concatenate([*hashes, np.array(values, np.uint64)]),
        )


class Filter:
    """A Bloom filter of hashes: of bounded size however many there are, and never wrong about one that is in."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        low, high = hashes & np.uint64(0x7FFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
        held = np.ones(len(hashes), bool)
        for k in range(PLACES):
            place = (low + np.uint64(k) * high) & np.uint64(self.bits - 1)
            held &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return held


def window_filter(hashes: DataFrame) -> Filter:
    """The filter of a column ``hash``, put together by the tasks; its bits are what comes to the driver."""
    some = hashes.select("hash").distinct()
    bits = 1 << 16
    wanted = BITS_EACH * some.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    low = F.col("hash").bitwiseAND(F.lit(0x7FFFFFFF))
    high = F.shiftrightunsigned("hash", 32).bitwiseOR(F.lit(1))
    places = F.array(*[(low + F.lit(k) * high).bitwiseAND(F.lit(bits - 1)) for k in range(PLACES)])
    place = some.select(F.explode(places).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bit")
    words = place.select(F.shiftright("place", 6).alias("word"), bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return Filter(out.view(np.uint64), bits)


def _windows(width: int, literals: int, wanted, both: bool, shorter: tuple[int, ...]):
    """Batches of (id, text) to batches of windows; ``wanted()`` gives a ``Filter`` or None.

    Windows with fewer than ``literals`` literal words are of their actual words.
    ``both``: also windows as the text may look elsewhere, with a name for its
    first word (within a sentence), with words for its names (in capitals), and
    all windows of actual words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = wanted()
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                texts = [(t or "").encode() for t in part["text"].to_pylist()]
                tokens = Tokens(texts)
                usual = tokens.kind, tokens.code
                tokens.code = tokens.words
                actual = tokens.windows(width, shorter)[2] ^ _ACTUAL
                for variant in ("usual", "within", "capitals", "actual") if both else ("usual",):
                    tokens.kind, tokens.code = usual
                    if variant == "within":
                        first = tokens.begins & (tokens.kind == 0)
                        tokens.kind = np.where(first, 2, tokens.kind)
                        tokens.code = np.where(first, _CODES[NAME], tokens.code)
                    if variant == "capitals":
                        name = tokens.kind == 2
                        tokens.kind = np.where(name, 0, tokens.kind)
                        tokens.code = np.where(name, tokens.words, tokens.code)
                    at, length, value = tokens.windows(width, shorter)
                    plain = np.concatenate([[0], np.cumsum(tokens.kind == 0)])
                    rich = plain[at + length] - plain[at] >= np.minimum(literals, (length + 1) // 2)
                    rich &= variant != "actual"
                    value = np.where(rich, value, actual)
                    # An item's windows of actual words come once, as the last variant.
                    good = rich if both and variant != "actual" else np.ones(len(at), bool)
                    if variant == "within":
                        good = good & tokens.begins[at]
                    if keep is not None:
                        good &= keep.may_hold(value)
                    chosen = np.flatnonzero(good)
                    yield _rows(part["id"], tokens, at[chosen], length[chosen], value[chosen], rich[chosen])

    return run


def _rows(ids, tokens: Tokens, at, length, value, rich) -> pa.RecordBatch:
    text = tokens.text[at] if len(at) else np.zeros(0, np.int64)
    begin = np.searchsorted(tokens.text, text)
    templates, slots = [], []
    for a, l, typed in zip(at, length, rich):
        kinds = tokens.kind[a : a + l] * typed
        templates.append(" ".join(Tokens.KINDS[k] or tokens.word(a + j) for j, k in enumerate(kinds)))
        slots.append([tokens.word(a + j) for j in np.flatnonzero(kinds)])
    return pa.record_batch(
        {
            "id": ids.take(pa.array(text, pa.int64())),
            "at": pa.array(at - begin, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "hash": pa.array(value.view(np.int64), pa.int64()),
            "template": pa.array(templates, pa.string()),
            "slots": pa.array(slots, pa.list_(pa.string())),
            "rich": pa.array(rich, pa.bool_()),
        }
    )


def template_windows(
    texts: DataFrame, width: int = WINDOW, literals: int = LITERALS, wanted=None, both: bool = False,
    shorter: tuple[int, ...] = (),
) -> DataFrame:
    """id, at, length, hash, template, slots, rich (in literal words) of the windows of (id, text)."""
    kind = texts.schema["id"].dataType.simpleString()
    shared = None if wanted is None else texts.sparkSession.sparkContext.broadcast(wanted)

    def filter_hashes():
        return None if shared is None else shared.value

    return small_batches(texts).mapInArrow(
        _windows(width, literals, filter_hashes, both, shorter),
        f"id {kind}, at long, length long, hash long, template string, slots array<string>, rich boolean",
    )


def _agreed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Alignments to the places of their windows that agree on slots, their longest run, and the number of values that differ."""
    for batch in batches:
        places, typed, run, changed = [], [], [], []
        for windows in batch["found"].to_pylist():
            votes: dict[str, dict[str, set[int]]] = {}
            for w in windows:
                for i, d in zip(w["i"], w["d"]):
                    votes.setdefault(i, {}).setdefault(d, set()).add(w["item_at"])
            # Ties go to the item's own value, then to the smallest.
            stands = {i: min(v, key=lambda d: (-len(v[d]), d != i, d)) for i, v in votes.items()}
            kept = [w for w in windows if w["i"] == w["d"] or all(stands[i] == d for i, d in zip(w["i"], w["d"]))]
            places.append(sorted({w["item_at"] for w in kept}))
            typed.append(sorted({w["item_at"] for w in kept if w["rich"]}))
            # Places less their rank are equal within an unbroken run.
            run.append(max(Counter(p - k for k, p in enumerate(places[-1])).values(), default=0))
            changed.append(len({(i, d) for w in kept for i, d in zip(w["i"], w["d"]) if i != d}))
        yield pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "class": batch["class"],
                "places": pa.array(places, pa.list_(pa.int64())),
                "typed": pa.array(typed, pa.list_(pa.int64())),
                "run": pa.array(run, pa.int64()),
                "changed": pa.array(changed, pa.int64()),
            }
        )


def item_windows(benchmark: DataFrame, width: int = WINDOW, literals: int = LITERALS, common: int = COMMON) -> DataFrame:
    """The windows that count of each different text of (item_id, text): class, item_at, hash, template, ...

    ``family``: the template is in more than ``common`` texts, the words are not,
    so the window counts only with its own slots. Windows whose words are in more
    texts than that are left out, but for a text that has no others.
    """
    texts = benchmark.select(F.coalesce("text", F.lit("")).alias("text")).distinct()
    windows = template_windows(texts.select(F.sha2("text", 256).alias("id"), "text"), width, literals, both=True)
    windows = stored(windows.dropDuplicates(["id", "at", "hash"]), "item-windows")
    per_template = windows.groupBy("hash", "template", "rich").agg(F.count_distinct("id").alias("_alike"))
    per_words = windows.groupBy("hash", "template", "rich", "slots").agg(F.count_distinct("id").alias("_same"))
    counted = windows.join(per_template, ["hash", "template", "rich"]).join(per_words, ["hash", "template", "rich", "slots"])
    shared = counted.withColumn("_common", F.col("_same") > common)
    # A place whose words are common is so in all its readings.
    places = shared.groupBy("id", "at").agg(F.max("_common").alias("_common"))
    own = places.groupBy("id").agg(F.min("_common").alias("_all"))
    marked = shared.drop("_common").join(places, ["id", "at"]).join(own, "id").where(~F.col("_common") | F.col("_all"))
    return marked.select(
        F.col("id").alias("class"), F.col("at").alias("item_at"), "hash", "template", F.col("slots").alias("item_slots"),
        "rich", "length", (F.col("_alike") > common).alias("family"),
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, literals: int = LITERALS,
    coverage: float = COVERAGE, common: int = COMMON,
) -> DataFrame:
    """doc_id, item_id, windows, matched, changed: pairs of a document and an item it holds.

    ``windows``: windows of the item that count, which are those that no more than ``common`` different
    benchmark texts share (all of them, if it has no others); ``matched``: those found in the document at
    consistent slots, at least ``coverage`` of them or of those whose template is
    enough, or an unbroken run of ``RUN`` words; ``changed``: slot values that differ. Items of one text are
    looked for once and reported each. An item with fewer than ``width`` tokens is one window, found
    anywhere in a document; with fewer than ``SHORTEST`` it matches only a document of these tokens. Windows of fewer than ``literals``
    literal words (short ones half of theirs), and those of a template that more texts share, match word by word. Null and empty texts have no windows, rows
    that share an id (null included) count as one document, an item with several texts is held where one of them is, repeated
    rows change nothing, other columns are not read.
    """
    items = stored(item_windows(benchmark, width, literals, common), "benchmark-windows")
    short = items.where((F.col("length") < width) & (F.col("length") >= SHORTEST)).select("length").distinct()
    shorter = tuple(sorted(r.length for r in short.collect()))
    found = template_windows(
        docs.select(F.col("doc_id").alias("id"), "text"), width, literals, window_filter(items), shorter=shorter
    ).drop("length")
    found = stored(found.withColumnRenamed("id", "doc_id"), "document-windows")
    key = ["hash", "template", "rich"]
    alike = found.join(items.where("NOT family"), key)
    own = items.where("family").withColumn("slots", F.col("item_slots"))
    pairs = alike.unionByName(found.join(own, [*key, "slots"]))
    windows = F.struct(
        "item_at", "rich", F.col("item_slots").alias("i"), F.col("slots").alias("d")
    )
    aligned = pairs.groupBy("doc_id", "class", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set(windows).alias("found")
    )
    kinds = ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in ("doc_id", "class"))
    agreed = aligned.mapInArrow(_agreed, f"{kinds}, places array<long>, typed array<long>, run long, changed long")
    counts = items.groupBy("class").agg(
        F.count_distinct("item_at").alias("windows"),
        F.count_distinct(F.when(F.col("rich"), F.col("item_at"))).alias("templates"),
    )
    held = (
        agreed.groupBy("doc_id", "class")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.size(F.array_distinct(F.flatten(F.collect_list("typed")))).alias("typed"),
            F.max("run").alias("run"),
            F.max("changed").alias("changed"),
        )
        .withColumn("matched", F.size("places").cast("long"))
    )
    caught = held.join(counts, "class").where(
        (F.col("matched") >= coverage * F.col("windows"))
        | (F.col("run") + width - 1 >= RUN)
        | ((F.col("typed") > 0) & (F.col("typed") >= coverage * F.col("templates")))
    )
    named = benchmark.select("item_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("class")).distinct()
    return caught.join(named, "class").groupBy("doc_id", "item_id").agg(
        F.max("windows").alias("windows"), F.max("matched").alias("matched"), F.max("changed").alias("changed")
    )
