"""Chat formatting from an event log, in Spark columns only.

Events have conv_id, seq, message (the number of the message they concern), kind, role and text:

- ``message`` opens a message, with its role and the text so far (streams open it empty);
- ``delta`` adds text to the end of the message;
- ``edit`` puts another text in the place of the message's text;
- ``regenerate`` empties the message and drops all messages of a higher number opened before it; deltas follow. A dropped message
  that is opened again stays, with what follows its last opening.

The log is partitioned by conversation and sorted by sequence. Per message, the text is what the events from the last ``message``,
``edit`` or ``regenerate`` on give, joined in order. The messages left, by number, are rendered as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings in texts and roles are escaped, so that none of them occurs in the result but as markup: every backslash is doubled,
then a single backslash goes behind the first character of a control string; a line break in a role becomes ``<n>``.
:func:`unescaped` undoes it exactly. The loss mask is a list of [start, end) spans of code points over the assistant texts.

One conversation is one string in the result, so its events meet in one task; messages are folded before that.

Defined results: a null text is empty, a null role is an empty role (that of the last opening counts), and a null seq sorts first. Events of equal seq are folded by
kind (message, edit, regenerate, delta) and then text. Deltas, edits and regenerations of a message that was never opened give a
message of an empty role. Events without conv_id form a conversation of their own (null); those without a message number are
message null, which sorts first. An unknown kind counts as delta.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"

# The control strings of public chat templates, by their first character and the rest.
CONTROL = r"([<\[])(\||/?s>|/?INST\]|</?SYS>>|n>)"
ESCAPED = r"([<\[])\\(\||/?s>|/?INST\]|</?SYS>>|n>)"


def escaped(text: Column) -> Column:
    """``text`` without any control string, reversibly."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    """What :func:`escaped` was given."""
    bare = F.regexp_replace(text, ESCAPED, "$1$2")
    return F.replace(bare, F.lit("\\\\"), F.lit("\\"))


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: the messages that an event log leaves."""
    kind = F.coalesce(F.col("kind"), F.lit("delta"))
    order = F.when(kind == "message", 0).when(kind == "edit", 1).when(kind == "regenerate", 2).otherwise(3)
    log = events.select(
        "conv_id",
        "seq",
        "message",
        order.alias("step"),
        "role",
        F.when(kind == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("text"),
    )
    entry = F.struct("seq", "step", "text", "role")
    messages = log.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(entry)).alias("log"),
        F.max(F.when(F.col("step") == 0, F.struct("seq", "step"))).alias("opened"),
        F.max(F.when(F.col("step") == 2, F.struct("seq", "step"))).alias("again"),
    )
    reset = F.expr("int(array_max(transform(log, (e, i) -> if(e.step < 3, i, 0))))")
    kept = F.expr("transform(slice(log, reset + 1, size(log)), e -> e.text)")
    role = F.expr("coalesce(try_element_at(filter(log, e -> e.step = 0), -1).role, '')")
    opened = F.coalesce("opened", F.struct(F.lit(None).cast("long").alias("seq"), F.lit(0).alias("step")))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("message").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        messages.withColumn("reset", reset)
        .withColumn("cut", F.max("again").over(earlier))
        .where(F.col("cut").isNull() | (opened > F.col("cut")))
        .select("conv_id", "message", role.alias("role"), F.array_join(kept, "").alias("text"))
    )


def rendered(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start and end): a row per conversation of folded messages."""
    listed = messages.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("message", F.col("role"), F.col("text")))).alias("turns")
    )
    name = lambda t: F.replace(escaped(t["role"]), F.lit("\n"), F.lit("<n>"))
    head = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), name(t), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == ASSISTANT).alias("loss"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("spans"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["head"])
        end = begin + F.length(part["body"])
        spans = F.when(part["loss"], F.concat(state["spans"], F.array(F.array(begin, end)))).otherwise(state["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    return listed.withColumn("parts", head).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate("parts", start, step)["spans"].alias("loss_spans"),
    )


def formatted(events: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans of an event log."""
    return rendered(fold(events))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with the turns (array of role and text) and the loss texts that the formatted strings hold."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        role = F.replace(F.substring(piece, F.lit(len(START) + 1), cut - len(START) - 1), F.lit("<n>"), F.lit("\n"))
        return F.struct(unescaped(role).alias("role"), unescaped(F.substring(piece, cut + 1, F.length(piece))).alias("text"))

    spans = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s[0] + 1, s[1] - s[0])))
    return chats.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_texts", spans)


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The event log of finished conversations: every row of ``turns`` (conv_id, turn, role, text) as one message."""
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()
    )
    number = F.row_number().over(order).cast(T.LongType())
    return turns.select(
        "conv_id", number.alias("seq"), number.alias("message"), F.lit("message").alias("kind"), "role", "text"
    )


def streamed(messages: DataFrame) -> DataFrame:
    """The same conversations as a service logs them: an event log that folds to what the events in ``messages`` (one per message) say.

    By a hash of conversation and message number, a message comes whole, as three deltas, as a draft that is edited, or as a
    draft that is regenerated after the next message had been opened; that one is dropped, and comes again if it is in the log.
    """
    text = F.coalesce("text", F.lit(""))
    third = F.floor(F.length(text) / 3).cast("int")
    parts = [F.substring(text, F.lit(1), third), F.substring(text, third + 1, third), F.substring(text, 2 * third + 1, F.length(text))]
    draft = F.reverse(text)

    def event(place: int, kind: str, said: Column | None = None, ahead: int = 0) -> Column:
        role = F.col("role") if kind == "message" else F.lit(None).cast("string")
        said = F.lit(None).cast("string") if said is None else said
        seq = F.col("seq") * 10 + place
        fields = {"seq": seq, "message": F.col("message") + ahead, "kind": F.lit(kind), "role": role, "text": said}
        return F.struct(*(column.alias(name) for name, column in fields.items()))

    def deltas(first: int) -> list[Column]:
        return [event(first + k, "delta", part) for k, part in enumerate(parts)]

    ways = [
        [event(0, "message", text)],
        [event(0, "message", F.lit("")), *deltas(1)],
        [event(0, "message", draft), *deltas(1), event(4, "edit", text)],
        [event(0, "message", draft), event(1, "message", draft, ahead=1), event(2, "regenerate"), *deltas(3)],
    ]
    way = F.pmod(F.xxhash64("conv_id", "message"), F.lit(len(ways)))
    log = F.element_at(F.array(*(F.array(*events) for events in ways)), (way + 1).cast("int"))
    return messages.select("conv_id", F.explode(log).alias("event")).select("conv_id", "event.*")


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted chats."""
    back = read_back(chats)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
