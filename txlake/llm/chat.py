"""Chat formatting: every dialogue from the perspective of each of its participants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import numbered, staged

PART = 256

# Marks of the rendered format.
OPEN, BETWEEN, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _escaped(text: Column) -> Column:
    """Marks inside a text lose their bars, so that a message cannot open or close another."""
    clean = F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_start|>"), F.lit("< im_start >"))
    return F.replace(clean, F.lit("<|im_end|>"), F.lit("< im_end >"))


def _encoded(name: Column) -> Column:
    """A name in letters, digits and ``-._~``, all else as %XX of its UTF-8 bytes: no two names agree."""
    out = F.url_encode(name)
    for given, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(given), F.lit(wanted))
    return out


def perspectives(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    narrator: str = "system",
    part: int = PART,
) -> DataFrame:
    """One row per conversation, participant and part of up to 256 messages.

    For every participant (a role other than the narrator's) the dialogue is rendered
    with that speaker as ``assistant``, all others as ``user name=...`` and the narrator
    as ``system``. ``spans`` are the [start, end) of the texts to learn from (that
    speaker's words and closing mark), ``masked`` those of all else, in characters of
    ``rendered``; ``offset`` is where the part begins in the whole dialogue. Most
    dialogues have one part; parts keep a long dialogue out of a single row.

    Messages go by turn, then role, then text; null turns come first, null texts are
    empty, a null role is the participant ``unknown``, rows without a conversation id
    form one conversation. Names are written with %XX for all but letters, digits and
    ``-._~``, so different speakers stay different. Repeated rows are messages of their
    own. A very long text is one message, and its part that long. Further columns are not
    read, whatever their names. A dialogue with only a narrator has no participant and
    gives no row; neither does an empty table.
    """
    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        _escaped(F.col(text)).alias("text"),
    )
    ranked = staged(numbered(staged(said, "turns"), ["conv_id", "turn", "role", "text"], "rank"), "turn_ranks")
    # What a conversation needs as a whole is small: its first number and its speakers.
    starts = ranked.groupBy("conv_id").agg(F.min("rank").alias("first")).withColumnRenamed("conv_id", "of")
    speakers = (
        ranked.filter(F.col("role") != narrator).select(F.col("conv_id").alias("conv"), F.col("role").alias("participant")).distinct()
    )
    placed = ranked.join(starts, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "turn", "role", "text", (F.col("rank") - F.col("first")).alias("seq")
    )
    name = _encoded(F.col("role"))
    mine = F.col("role") == F.col("participant")
    head = (
        F.when(mine, F.lit("assistant"))
        .when(F.col("role") == narrator, F.lit("system"))
        .otherwise(F.concat(F.lit("user name="), name))
    )
    told = (
        placed.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv")))
        .withColumn("part", F.floor(F.col("seq") / F.lit(part)))
        .withColumn("head", F.concat(F.lit(OPEN), head, F.lit(BETWEEN)))
        .select(
            "conv_id", "participant", "part", "seq", mine.alias("mine"), "head",
            F.concat(F.col("text"), F.lit(CLOSE)).alias("body"),
        )
    )
    # Messages of a part meet in one row: at most `part` of them.
    parts = (
        told.groupBy("conv_id", "participant", "part")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "mine", "head", "body"))).alias("m"))
        .withColumn("rendered", F.concat_ws("", F.transform("m", lambda x: F.concat(x["head"], x["body"]))))
        .withColumn(
            "spans",
            F.aggregate(
                "m",
                F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,mine:boolean>>").alias("s")),
                lambda acc, x: F.struct(
                    (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"])).alias("at"),
                    F.concat(
                        acc["s"],
                        F.array(
                            F.struct(acc["at"].alias("start"), (acc["at"] + F.char_length(x["head"])).alias("end"), F.lit(False).alias("mine")),
                            F.struct(
                                (acc["at"] + F.char_length(x["head"])).alias("start"),
                                (acc["at"] + F.char_length(x["head"]) + F.char_length(x["body"])).alias("end"),
                                x["mine"].alias("mine"),
                            ),
                        ),
                    ).alias("s"),
                ),
                lambda acc: acc["s"],
            ),
        )
        .withColumn("n_messages", F.size("m"))
        .drop("m")
    )
    sized = staged(parts.withColumn("n_chars", F.char_length("rendered").cast("long")), "chat_parts")
    return _with_offsets(sized).select(
        "conv_id",
        "participant",
        "part",
        "offset",
        "n_messages",
        "n_chars",
        "rendered",
        _cut(F.col("spans"), True).alias("spans"),
        _cut(F.col("spans"), False).alias("masked"),
    )


def _cut(spans: Column, mine: bool) -> Column:
    wanted = F.filter(spans, lambda s: s["mine"] == F.lit(mine))
    return F.transform(wanted, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def _with_offsets(parts: DataFrame) -> DataFrame:
    """Where each part begins: sums over parts, which are 256 messages each.

    Dialogues of one part begin at 0 and need no sum. For the others parts are summed in
    runs of 256 first, so that a task sorts at most 256 numbers of a dialogue at a time
    for each level.
    """
    from pyspark.sql import Window

    run = F.floor(F.col("part") / F.lit(PART))
    sizes = parts.select("conv_id", "participant", "part", "n_chars").withColumn("run", run)
    inside = Window.partitionBy("conv_id", "participant", "run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = sizes.groupBy("conv_id", "participant", "run").agg(F.sum("n_chars").alias("chars"))
    before = Window.partitionBy("conv_id", "participant").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    runs = runs.select(
        F.col("conv_id").alias("c2"), F.col("participant").alias("p2"), F.col("run").alias("r2"), "start"
    )
    inner = parts.withColumn("run", run).withColumn("within", F.coalesce(F.sum("n_chars").over(inside), F.lit(0)))
    same = F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("participant") == F.col("p2")) & (F.col("run") == F.col("r2"))
    return inner.join(runs, same).withColumn("offset", F.col("start") + F.col("within"))
