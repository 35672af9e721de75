"""Language identification by prediction by partial matching over bytes.

Per language, a tree of byte contexts of up to ``ORDER`` bytes is counted on
labelled documents. A byte is coded in its longest known context; where the
context has not seen the byte, an escape is coded and the next shorter context
is asked (method C: in a context with q different bytes in n, a byte seen k
times costs log2((n + q) / k) bits, an escape log2((n + q) / q)). The statistics
are frozen before scoring, so the code length of a byte depends on its last
``ORDER`` bytes alone, and all lengths can be worked out once, in 1/256 bits.
A text's language is the one whose tree gives it the shortest code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidemark.llm.common import small_batches

ORDER = 3
# Bounds of what is learned from: documents per language, bytes per document,
# and contexts of the trees (the most frequent ones).
DOCUMENTS, BYTES, CONTEXTS = 600, 65_536, 12_288
# Parts of a language that are sampled apart, for a language may be most of the rows.
SALTS = 24
UNDETERMINED = "und"
# Bytes and rows that are scored at a time.
SLICE, ROWS = 1 << 18, 1024
# Contexts whose code lengths are worked out at a time.
PART = 512
PAD = b"\0" * ORDER


class Model:
    """Code lengths of every byte in every kept context, per language.

    ``steps[k]`` leads from a context of k bytes and the byte before it to the
    context of k + 1 bytes, or to -1. ``lengths[l]`` holds 256 code lengths per
    context, in 1/256 bits.
    """

    def __init__(self, languages: list[str], steps: list[np.ndarray], lengths: np.ndarray):
        self.languages, self.steps, self.lengths = languages, steps, lengths

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language, in 1/256 bits."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        joined = np.frombuffer(b"".join(PAD + t for t in texts), np.uint8)
        starts = np.cumsum([0, *(ORDER + len(t) for t in texts)])
        counted = np.ones(len(joined), bool)
        for k in range(ORDER):
            counted[starts[:-1] + k] = False
        for low in range(0, len(joined), SLICE):
            high = min(low + SLICE, len(joined))
            first = np.searchsorted(starts, low, "right") - 1
            last = np.searchsorted(starts, high, "left")
            cuts = np.maximum(starts[first:last], low) - low
            places = np.arange(low, high)
            context = np.zeros(high - low, np.int32)
            node = context
            for k, step in enumerate(self.steps):
                before = joined[np.maximum(places - k - 1, 0)]
                node = np.where(node >= 0, step[np.maximum(node, 0) * 256 + before], -1)
                context = np.where(node >= 0, node, context)
            coded = context * 256 + joined[low:high]
            live = counted[low:high]
            for l in range(len(self.languages)):
                length = np.where(live, self.lengths[l][coded], 0)
                total[first:last, l] += np.add.reduceat(length, cuts, dtype=np.int64)
        return total


def build(counts: pa.Table, languages: list[str], contexts: int = CONTEXTS) -> Model:
    """Trees from (lang, gram, n): ``gram`` holds ORDER + 1 bytes, the coded one lowest."""
    which = np.searchsorted(languages, counts["lang"].to_numpy(zero_copy_only=False).astype(str))
    gram, n = counts["gram"].to_numpy(), counts["n"].to_numpy()
    # Contexts as numbers whose lowest byte is the nearest one; kept if frequent.
    seen = [np.array([0])]
    size = 1
    steps = []
    ids = {0: np.array([0])}
    for depth in range(1, ORDER + 1):
        context = (gram >> 8) & ((1 << 8 * depth) - 1)
        values, where = np.unique(context, return_inverse=True)
        weight = np.bincount(where, n)
        parents = values & ((1 << 8 * (depth - 1)) - 1)
        known = np.isin(parents, seen[-1])
        room = max(0, contexts - size)
        rank = np.argsort(-weight * known, kind="stable")[: room if depth == ORDER else len(values)]
        kept = np.sort(values[rank][known[rank]])
        step = np.full((size if depth > 1 else 1) * 256, -1, np.int32)
        parent = ids[depth - 1][np.searchsorted(seen[-1], kept & ((1 << 8 * (depth - 1)) - 1))]
        number = size + np.arange(len(kept))
        step[parent * 256 + (kept >> 8 * (depth - 1))] = number
        steps.append(step)
        seen.append(kept)
        ids[depth] = number
        size += len(kept)
    lengths = np.empty((len(languages), size, 256), np.uint16)
    for l in range(len(languages)):
        own, k = gram[which == l], n[which == l]
        # Bits of the contexts one byte shorter, in their order.
        shorter = np.full((1, 256), 8, np.float32)
        for depth in range(ORDER + 1):
            context = (own >> 8) & ((1 << 8 * depth) - 1)
            at = np.minimum(np.searchsorted(seen[depth], context), len(seen[depth]) - 1)
            hit = seen[depth][at] == context
            code, times = at[hit] * 256 + (own[hit] & 255), k[hit]
            order = np.argsort(code, kind="stable")
            code, times = code[order], times[order]
            parent = np.zeros(1, np.int64)
            if depth:
                parent = np.searchsorted(seen[depth - 1], seen[depth] & ((1 << 8 * (depth - 1)) - 1))
            bits = np.empty((len(seen[depth]), 256), np.float32)
            # Some contexts at a time: what they need beside the result stays small.
            for low in range(0, len(bits), PART):
                part = bits[low : low + PART]
                x, y = np.searchsorted(code, [low * 256, (low + len(part)) * 256])
                count = np.bincount(code[x:y] - low * 256, times[x:y], part.size).reshape(part.shape)
                total, kinds = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0)
                    found = np.log2((total + kinds) / count)
                part[:] = np.where(count > 0, found, escape + shorter[parent[low : low + PART]])
                lengths[l, ids[depth][low : low + PART]] = np.minimum(np.rint(part * 256), 65_535)
            shorter = bits
    return Model(languages, steps, lengths.reshape(len(languages), size * 256))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            held = np.frombuffer(PAD + text.encode(), np.uint8).astype(np.int64)
            gram = held[ORDER:].copy()
            for k in range(1, ORDER + 1):
                gram += held[ORDER - k : len(held) - k] << 8 * k
            values, n = np.unique(gram, return_counts=True)
            yield pa.record_batch({"lang": pa.array([lang] * len(values), pa.string()), "gram": values, "n": n})


def train(
    labelled: DataFrame, documents: int = DOCUMENTS, size: int = BYTES, contexts: int = CONTEXTS
) -> Model:
    """Trees from (doc_id, text, lang); rows without text or lang are left out.

    Learns from at most ``documents`` whole texts of at most ``size`` bytes per
    language, those with the smallest hashes of their doc_ids in each of ``SALTS``
    parts, so what is counted and gathered stays bounded. A table without labelled rows gives a model
    without languages.
    """
    fit = labelled.where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text").between(1, size))
    )
    salt = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS))
    order = Window.partitionBy("lang", "_salt").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    chosen = small_batches(fit).select("doc_id", "lang", "text", salt.alias("_salt")).withColumn("_n", F.row_number().over(order))
    grams = chosen.where(F.col("_n") <= max(1, documents // SALTS)).select("lang", "text").mapInArrow(
        _grams, "lang string, gram long, n long"
    )
    counts = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    return build(counts, sorted(set(counts["lang"].to_pylist())), contexts)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns to ``keep``, lang_pred and score for every row of ``docs``; reads these and text only.

    ``und`` with score 0 if the text is null or without letters, or if the
    model knows no language. Else ``score`` is the share of the best language
    in the probabilities that the trees give to the whole text, 1 over the
    number of languages at least; ties go to the first language in order. A row
    gives a row, whatever else is in the table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = np.array([*known.languages, UNDETERMINED], object)
        for batch in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
            texts = [t.encode() if t else b"" for t in batch["text"].to_pylist()]
            lettered = batch["lettered"].to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            if known.languages and len(texts):
                bits = known.bits(texts)
                least = bits.min(1, keepdims=True)
                share = 1 / np.exp2(np.maximum(least - bits, -256_000) / 256).sum(1)
                best = np.where(lettered, bits.argmin(1), best)
                score = np.where(lettered, share, 0.0)
            found = dict(zip(keep, batch["kept"].flatten()))
            yield pa.record_batch(
                found | {"lang_pred": pa.array(names[best], pa.string()), "score": pa.array(score, pa.float64())}
            )

    kept = docs.select(*keep)
    schema = StructType([*kept.schema.fields]).add("lang_pred", "string").add("score", "double")
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = small_batches(docs).select(
        F.struct(*keep).alias("kept"), F.coalesce("text", F.lit("")).alias("text"), lettered.alias("lettered")
    )
    return rows.mapInArrow(scored, schema)
