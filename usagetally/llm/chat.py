"""Chat formatting (operator 7): event-sourced reconstruction in built-in expressions only.

A log has one event a row: ``conv_id``, ``message`` (the message's place in its
conversation: any orderable value), ``seq`` (order of events) and ``kind``:

* ``open``: the message begins, ``text`` is its role;
* ``delta``: ``text`` is appended to the message;
* ``edit``: ``text`` replaces what the message held;
* ``regenerate``: the message is emptied, and later messages opened before it go.

``fold`` sorts the events of each message by sequence and folds them;
``render`` writes a conversation with a template:
``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Control strings begin with
``<|``.  In texts and roles a ``\\`` is put after the ``<`` of every ``<``,
any number of ``\\``, ``|``, so that no control string is left and taking one
``\\`` out again gives back the text exactly.

A regeneration's reach is found on blocks of a conversation (``overtaken``).

Events are first reduced to messages (grouped by conversation and message, so one
long conversation is spread over many tasks), messages to strings for blocks of
a conversation, and only these strings meet in its row.  A rendered conversation
is one string, as the result asks for, so it has to fit one row (2 GB).

Defined results: a null text or role counts as empty; messages of one place are
ordered by role, text, then first event; a message without ``open`` has an empty
role; conversations without messages don't appear; a null conv_id is a
conversation of its own; an empty log gives no rows; extra columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagetally.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"
#: Messages of a conversation that are first put together, before its blocks meet.
BLOCK = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """Also keeps a role on one line: \\ becomes \\\\, a line end \\n."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """Each \\n that no backslash escapes is a line end; then each \\ is a backslash: no marker character, whatever a role holds."""
    lines = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(lines, r"\\\\", r"\\")


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, opened (sequence of its first event), role, text of the messages that remain."""
    e = events.select("conv_id", "message", "seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    per = e.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(F.struct("seq", "kind", "text"))).alias("log"))
    resets = F.filter("log", lambda x: x["kind"].isin("edit", "regenerate"))
    since = F.coalesce(F.get(resets, F.size(resets) - 1)["seq"], F.get("log", F.lit(0))["seq"])
    kept = lambda x: (x["seq"] >= F.col("since")) & x["kind"].isin("delta", "edit")
    folded = per.withColumn("since", since).select(
        "conv_id", "message", F.get("log", F.lit(0))["seq"].alias("opened"),
        F.coalesce(F.get(F.filter("log", lambda x: x["kind"] == "open"), F.lit(0))["text"], F.lit("")).alias("role"),
        F.array_join(F.transform(F.filter("log", kept), lambda x: x["text"]), "").alias("text"))
    gone = overtaken(e).select(F.col("conv_id").alias("in_conv"), F.col("message").alias("gone"))
    return folded.join(gone, F.col("conv_id").eqNullSafe(F.col("in_conv")) & F.col("message").eqNullSafe(F.col("gone")), "left_anti")


def overtaken(events: DataFrame) -> DataFrame:
    """conv_id, message of the messages that a later regeneration of an earlier message removes.

    A message goes if the running maximum of the regenerations before its place is later than its opening.  The maximum
    is taken over blocks of a conversation, then inside the block; only conversations with a
    regeneration are looked at, and no text is read."""
    same_conv = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    redone = (events.where(F.col("kind") == "regenerate").groupBy("conv_id", "message").agg(F.max("seq").alias("redone")))
    some = redone.select(F.col("conv_id").alias("in_conv")).distinct()
    opened = (events.select("conv_id", "message", "seq").join(some, same_conv("conv_id", "in_conv"), "left_semi")
              .groupBy("conv_id", "message").agg(F.min("seq").alias("opened")))
    again = redone.select(F.col("conv_id").alias("in_conv"), F.col("message").alias("of"), "redone")
    all_ = (opened.join(again, same_conv("conv_id", "in_conv") & same_conv("message", "of"), "left").drop("in_conv", "of")
            .withColumn("block", block_of(events)))
    blocks = all_.groupBy("conv_id", "block").agg(
        F.max("redone").alias("top"),
        F.collect_list(F.when(F.col("redone").isNotNull(), F.struct("message", "redone"))).alias("inside"))
    before = F.max("top").over(Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(F.col("conv_id").alias("in_conv"), F.col("block").alias("in_block"), before.alias("before"), "inside")
    earlier = F.exists("inside", lambda r: (r["message"] < F.col("message")) & (r["redone"] > F.col("opened")))
    return (all_.join(blocks, same_conv("conv_id", "in_conv") & same_conv("block", "in_block"))
            .where(F.coalesce(F.col("before") > F.col("opened"), F.lit(False)) | earlier).select("conv_id", "message"))


def block_of(messages: DataFrame) -> Column:
    """The block of a message by its place: a number, or a struct that begins with a turn."""
    return F.floor((F.col("message")["turn"] if _has_turn(messages) else F.col("message")) / BLOCK)


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: for each turn the (start, length) in code points, from the
    turn's start marker on, of the text to learn from; length 0 for other roles."""
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    turn = F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))
    learned = F.coalesce("role", F.lit("")) == LEARNED_ROLE
    loss = F.struct((F.char_length(F.concat(F.lit(START), role)) + 1).alias("start"),
                    F.when(learned, F.char_length(text)).otherwise(0).alias("length"))
    m = messages.select("conv_id", F.struct("message", "role", "text", "opened").alias("at"), turn.alias("turn"), loss.alias("loss"))
    place = F.col("at")["message"]["turn"] if _has_turn(messages) else F.col("at")["message"]
    parts = (m.withColumn("block", F.floor(place / BLOCK)).groupBy("conv_id", "block")
             .agg(F.sort_array(F.collect_list(F.struct("at", "turn", "loss"))).alias("turns"))
             .select("conv_id", "block", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("string"),
                     F.transform("turns", lambda t: t["loss"]).alias("loss")))
    return (parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "string", "loss"))).alias("blocks"))
            .select("conv_id", F.array_join(F.transform("blocks", lambda b: b["string"]), "").alias("formatted"),
                    F.flatten(F.transform("blocks", lambda b: b["loss"])).alias("loss")))


def _has_turn(messages: DataFrame) -> bool:
    kind = messages.schema["message"].dataType
    return kind.typeName() == "struct" and "turn" in kind.fieldNames()


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, each without its start marker."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    return F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))


def role_of(turn: Column) -> Column:
    return unescape_role(F.substring_index(turn, "\n", 1))


def text_of(turn: Column) -> Column:
    """The text of a turn: between the role's line and the end marker."""
    body = F.substring(turn, F.char_length(F.substring_index(turn, "\n", 1)) + 2, F.char_length(turn))
    return unescape(F.substring(body, F.lit(1), F.char_length(body) - len(END) - 1))


def read_back(rendered: DataFrame) -> DataFrame:
    """What the formatted strings and loss masks hold: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    digest = lambda s: F.sha2(s.cast("binary"), 256)
    said = lambda t: F.concat(role_of(t), F.lit("\n"), text_of(t), F.lit("\n"))
    masked = lambda t, x: F.substring(F.concat(F.lit(START), t), x["start"] + 1, x["length"])
    r = rendered.withColumn("turns", turns_of(F.col("formatted")))
    r = r.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"),
                 F.array_join(F.transform("turns", said), "").alias("said"),
                 F.array_join(F.zip_with("turns", "loss", lambda t, x: unescape(masked(t, x))), "").alias("learned"))
    return r.select("conv_id", "n_turns", digest(F.col("said")).alias("turns_sha256"),
                    F.char_length("learned").cast("long").alias("loss_chars"), digest(F.col("learned")).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"))


def events_of(conversations: DataFrame) -> DataFrame:
    """A log of complete conversations (conv_id, turn, role, text), as a server would have streamed them.

    Each row opens a message, streams a draft, then streams the text over it in two deltas; the sequence
    runs through the conversation.  Some answers are regenerated instead: their draft and a following
    message, opened meanwhile, go.  Rows that share a turn are placed by role and text (which only
    such rows carry in their key) and aren't regenerated."""
    c = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                             F.coalesce("text", F.lit("")).alias("said"), F.monotonically_increasing_id().alias("row"))
    shared = (conversations.groupBy(F.col("conv_id").alias("in_conv"), F.col("turn").cast("long").alias("at_turn")).count()
              .where("count > 1").drop("count"))
    tied = F.col("tied").isNotNull()
    c = c.join(shared.withColumn("tied", F.lit(True)),
               F.col("conv_id").eqNullSafe(F.col("in_conv")) & F.col("turn").eqNullSafe(F.col("at_turn")), "left")
    half = F.floor(F.char_length("said") / 2).cast("int")
    again = ~tied & (F.col("role") == LEARNED_ROLE) & (F.crc32(F.col("said").cast("binary")) % 4 == 0) & F.col("turn").isNotNull()
    place = lambda after: F.struct(F.col("turn"), F.concat(F.col("role"), F.lit(after)).alias("role"),
                                   F.when(tied, F.col("said")).otherwise("").alias("said"), F.col("row"))
    event = lambda step, kind, text, after="": F.struct(
        place(after).alias("message"), (F.coalesce("turn", F.lit(0)) * 8 + step).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))
    first, last = F.substring("said", F.lit(1), half), F.substring("said", half + 1, F.char_length("said"))
    edited = F.array(event(0, "open", F.col("role")), event(1, "delta", F.lit("...")), event(5, "edit", first), event(6, "delta", last))
    redone = F.array(event(0, "open", F.col("role")), event(1, "delta", F.lit("...")),
                     event(2, "open", F.lit("user"), "~"), event(3, "delta", F.lit("what do you mean"), "~"),
                     event(4, "regenerate", F.lit("")), event(5, "delta", first), event(6, "delta", last))
    log = c.select("conv_id", F.explode(F.when(again, redone).otherwise(edited)).alias("e"))
    return log.select("conv_id", "e.message", "e.seq", "e.kind", "e.text")


__all__ = ["fold", "render", "read_back", "events_of", "escape", "unescape", "turns_of", "role_of", "text_of"]
