"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written as ``<|turn|>role\\ntext<|stop|>``. In roles and texts every
backslash is doubled and every ``<`` and ``[`` is followed by a backslash, so
that no control string of this or of other common templates can occur in them;
``unescaped`` undoes it. A conversation is cut at turns into windows by prefix
sums of the turns' tokens. Each window but the first repeats the system turn
and the turns that begin within ``history`` tokens before it, marked
``<|seen|>`` and without loss. So each text is under the loss mask once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import prefix_sums, word_count

NEW, SEEN, STOP = "<|turn|>", "<|seen|>", "<|stop|>"
# Tokens that the marks of a turn count for.
FRAME = 3
BUDGET, HISTORY = 1024, 256
# Turns in a bucket of the prefix sums, and strides in a segment.
TURNS_PER_BUCKET, STRIDES_PER_SEGMENT = 256, 64


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("<\\")), F.lit("["), F.lit("[\\"))


def unescaped(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("[\\"), F.lit("[")), F.lit("<\\"), F.lit("<"))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows of conversations: conv_id, window, n_tokens, formatted, loss.

    ``turns`` has a row (conv_id, turn, role, text) per turn; other columns are
    ignored. ``loss`` lists (start, length) of the assistant texts that count,
    in code points of ``formatted``. Null roles and texts are empty, null turns
    come first, turns with the same number are ordered by role and text, and
    rows without a conv_id form one conversation. A turn's tokens are its words
    and ``FRAME`` for its marks. A system turn counts as such if it is the
    conversation's first. Windows hold new turns of at most the stride, which is
    what the system turn and the history leave of the budget, but ``history``
    at least; a turn that lies across the end of a stride is a window of its
    own. Turns longer than that stay whole and exceed the budget.

    A long conversation is spread: prefix sums work on buckets of turn numbers,
    windows are made per segment of a fixed number of strides, and a segment
    gets the end of the one before it as history.
    """
    rows = turns.select(
        F.col("conv_id").isNull().alias("_none"), F.coalesce("conv_id", F.lit(0)).alias("_conv"),
        F.coalesce("turn", F.lit(-(2**62))).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", word_count("text") + FRAME)
    conversation = ["_none", "_conv"]
    placed = prefix_sums(
        rows.withColumn("_bucket", F.floor(F.col("turn") / TURNS_PER_BUCKET)),
        conversation, "_bucket", ["turn", "role", "text"], "tokens", "start",
    )
    first = F.min(F.struct("turn", "role", "text", "tokens"))
    leading = rows.groupBy(*conversation).agg(first.alias("first")).select(
        *conversation, F.when(F.col("first.role") == "system", F.col("first")).alias("system")
    )
    stride = F.greatest(F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0)), F.lit(history))
    end = F.col("start") + F.col("tokens") - 1
    cut = (
        placed.join(leading, conversation)
        .withColumn("stride", stride)
        .withColumn("_from", F.floor(F.col("start") / F.col("stride")))
        .withColumn("_across", F.floor(end / F.col("stride")) > F.col("_from"))
        .withColumn("window", F.col("_from") * 2 + F.col("_across").cast("int"))
        .withColumn("segment", F.floor(F.col("_from") / STRIDES_PER_SEGMENT))
        .withColumn("body", F.concat(F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("[n")),
                                     F.lit("\n"), escaped(F.col("text")), F.lit(STOP)))
        .withColumn("_loss", F.when(F.col("role") == "assistant", F.length(escaped(F.col("text")))))
    )
    next_start = (F.col("segment") + 1) * STRIDES_PER_SEGMENT * F.col("stride")
    late = F.col("start") >= next_start - history
    copies = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = cut.withColumn("_halo", F.explode(copies)).withColumn("segment", F.col("segment") + F.col("_halo"))
    part = [*conversation, "segment"]
    along = Window.partitionBy(*part).orderBy("start")
    recent = F.collect_list("body").over(along.rangeBetween(-history, -1))
    opens = F.coalesce(F.lag("window").over(along) != F.col("window"), F.lit(True))
    marked = (
        spread.withColumn("_recent", recent).withColumn("_opens", opens).where("_halo = 0")
        .withColumn("_recent", F.when(F.col("_opens"), F.col("_recent")))
        .withColumn("_recent_tokens", F.when(F.col("_opens"), F.col("start")))
    )
    gathered = marked.groupBy(*part, "window").agg(
        F.sort_array(F.collect_list(F.struct("start", "body", "role", "_loss"))).alias("new"),
        F.max(F.when(F.col("_opens"), F.struct("start", "_recent"))).alias("open"),
        F.first("system").alias("system"),
        F.sum("tokens").alias("n_tokens"),
    )
    again = F.when(
        F.col("system").isNotNull() & (F.col("open.start") > history),
        F.array(F.concat(F.lit("system\n"), escaped(F.col("system.text")), F.lit(STOP))),
    ).otherwise(F.array().cast("array<string>"))
    seen = F.concat(again, F.coalesce("open._recent", F.array().cast("array<string>")))
    head = F.array_join(F.transform("seen", lambda body: F.concat(F.lit(SEEN), body)), "")
    new = F.array_join(F.transform("new", lambda t: F.concat(F.lit(NEW), t["body"])), "")
    stop = len(STOP)

    def advance(state, t):
        after = state["at"] + len(NEW) + F.length(t["body"])
        span = F.struct(
            (after - stop - t["_loss"]).cast("long").alias("start"), t["_loss"].cast("long").alias("length")
        )
        spans = F.when(t["_loss"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(span)))
        return F.struct(after.cast("long").alias("at"), spans.alias("spans"))

    nothing = F.array().cast("array<struct<start:bigint,length:bigint>>")
    state = F.struct(F.length("head").cast("long").alias("at"), nothing.alias("spans"))
    return (
        gathered.withColumn("seen", seen)
        .withColumn("head", head)
        .select(
            F.when(~F.col("_none"), F.col("_conv")).alias("conv_id"), "window", "n_tokens",
            F.concat("head", new).alias("formatted"),
            F.aggregate("new", state, advance)["spans"].alias("loss"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per window, from its text alone: the turns it adds, and the texts under its loss mask.

    conv_id, window, turns (role and text, in order), targets (in order), n_chars.
    """
    pieces = F.split("formatted", r"<\|stop\|>", -1)
    bodies = F.transform(
        F.filter(pieces, lambda p: p.startswith(NEW)), lambda p: F.substr(p, F.lit(len(NEW) + 1))
    )
    line = F.lit("\n")

    def turn(body):
        at = F.instr(body, line)
        role = F.replace(F.substr(body, F.lit(1), at - 1), F.lit("[n"), line)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(body, at + 1)).alias("text"))

    def target(span):
        return unescaped(F.substr(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return formatted.select(
        "conv_id", "window", F.transform(bodies, turn).alias("turns"),
        F.transform("loss", target).alias("targets"), F.length("formatted").alias("n_chars"),
    )


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: counts and digests of its turns and of its loss texts.

    A digest of a conversation is taken over its whole text, so that text
    comes together here, and only here, in one row.
    """
    spoken = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    per_window = read.select(
        "conv_id", "n_chars", F.size("turns").alias("n"),
        F.struct("window", spoken.alias("said")).alias("said"),
        F.struct("window", F.array_join("targets", "").alias("said")).alias("aimed"),
    )

    def joined(column):
        return F.array_join(F.transform(F.sort_array(F.collect_list(column)), lambda w: w["said"]), "")

    return per_window.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.sha2(joined("said"), 256).alias("turns_sha256"),
        F.length(joined("aimed")).cast("long").alias("loss_chars"),
        F.sha2(joined("aimed"), 256).alias("loss_sha256"),
        F.sum("n_chars").cast("long").alias("formatted_chars"),
    )
