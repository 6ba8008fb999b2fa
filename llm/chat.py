r"""Chat formatting from an event log, with a loss mask, in DataFrame functions only.

Conversations are rebuilt from events (``conv``, ``seq``, ``turn``, ``kind``, ``role``, ``text``), folded in
the order of ``seq``:

- ``delta`` appends its text to the turn's message; the first role that is not null names the speaker
- ``edit`` replaces the message, what came before it in this turn
- ``regenerate`` drops the turn's message and all later turns of the conversation; their events
  after it build them anew

Text of a message is escaped (``\`` as ``\b``, ``<`` as ``\l``, ``#`` as ``\h``), so the template's own strings, which all
begin with ``<`` or ``#``, cannot occur in it, and every backslash begins an escape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.tables import table

HEAD, BREAK, TAIL = "### ", ":\n", "</turn>\n"
#: Characters of a delta in the log that the registered query derives.
DELTA = 200


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def unescape(text: Column) -> Column:
    """Back again: no escape holds the beginning of another, so the order of the last step alone matters."""
    return F.replace(F.replace(F.replace(text, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _head(role: Column) -> Column:
    """A line; a role is escaped like a text, and its line breaks and colons as well."""
    plain = F.replace(F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit(":"), F.lit("\\c"))
    return F.concat(F.lit(HEAD), plain, F.lit(BREAK))


def fold(events: DataFrame) -> DataFrame:
    """conv, turn, role, text: the final messages.

    Events with a null ``conv``, ``turn`` or ``seq`` are events like any other (a null sorts first); a null kind is a
    delta, a null text empty.  Events of equal ``seq`` are taken by turn, kind, text, role; repeated events are applied
    again.  Each step groups by (conv, turn), or compares with one number per conversation, so a long
    conversation is not gathered here.
    """
    rows = events.select("conv", "seq", "turn", F.coalesce("kind", F.lit("delta")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    # For a turn: the last regeneration of this turn or an earlier one; for a conversation those are few.
    again = rows.where("kind = 'regenerate'").groupBy("conv", "turn").agg(F.max("seq").alias("at"))
    upto = Window.partitionBy("conv").orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = rows.select("conv", "turn").distinct()
    here = F.col("conv").eqNullSafe(F.col("conv_")) & F.col("turn").eqNullSafe(F.col("turn_"))
    reset = turns.join(again.toDF("conv_", "turn_", "at"), here, "left").select("conv", "turn", F.max("at").over(upto).alias("at"))
    reset = reset.where("at is not null").toDF("conv_", "turn_", "at")
    live = rows.join(reset, here, "left").where("kind != 'regenerate' and (at is null or seq > at)")
    order = F.sort_array(F.collect_list(F.struct("seq", "kind", "text", "role")))
    grouped = live.groupBy("conv", "turn").agg(order.alias("log"))
    last_edit = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] == "edit", i).otherwise(-1)))
    final = F.slice("log", F.greatest(last_edit, F.lit(0)) + 1, F.size("log"))
    role = F.element_at(F.array_append(F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit("")), 1)
    return grouped.select("conv", "turn", role.alias("role"), F.array_join(F.transform(final, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv, formatted, mask: one row per conversation, its messages by turn (then role, text).

    ``mask`` is an array of (from, to) code points of ``formatted`` under the loss: the escaped text of each message of a
    role in ``loss_roles``.  Messages of a conversation meet in one row because the result is one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = messages.select("conv", "turn", role.alias("role"), text.alias("text"), _head(role).alias("head"), escape(text).alias("body"))
    size = F.length("head") + F.length("body") + len(TAIL)
    along = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("end", F.sum(size).over(along) - len(TAIL))
    piece = F.struct("turn", "role", "text", "end", F.concat("head", "body", F.lit(TAIL)).alias("piece"), F.length("body").alias("size"))
    grouped = placed.groupBy("conv").agg(F.sort_array(F.collect_list(piece)).alias("turns"))
    learn = F.filter("turns", lambda t: t["role"].isin(*loss_roles))
    span = F.transform(learn, lambda t: F.struct((t["end"] - t["size"]).cast("int").alias("from"), t["end"].cast("int").alias("to")))
    return grouped.select("conv", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), span.alias("mask"))


def parse(formatted: Column) -> Column:
    """The array of (role, text) a formatted conversation holds."""
    parts = F.split(formatted, TAIL, -1)
    rows = F.slice(parts, 1, F.size(parts) - 1)

    def read(row: Column) -> Column:
        at = F.locate(BREAK, row)
        head = F.substr(row, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)
        role = unescape(F.replace(F.replace(head, F.lit("\\c"), F.lit(":")), F.lit("\\n"), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substr(row, at + len(BREAK), F.length(row))).alias("text"))

    return F.transform(rows, read)


def masked(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(formatted, m["from"] + 1, m["to"] - m["from"]))), "")


def conversation_events(rows: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log of rows (conv_id, turn, role, text) as a chat client would send it, from every row by a fixed rule.

    A message is first drafted: one delta with the beginning of its text reversed.  An assistant's draft is
    followed by the beginning of a reply to it, in the next turn, and then the turn is regenerated, which drops
    both.  Another speaker edits the draft.  The text itself comes as deltas in order, the edit being the first.

    Rows of one conversation and turn are separate messages: the turn of the log is the row's rank by
    turn, role, text in its conversation.
    """
    text = F.coalesce("text", F.lit(""))
    numbered = rows.select(
        F.col("conv_id").alias("conv"),
        "role",
        text.alias("text"),
        F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), text)).alias("turn"),
    )
    replaced = F.coalesce(F.col("role") == "assistant", F.lit(False))
    draft = F.reverse(F.substring("text", 1, delta))
    event = lambda n, turn, kind, role, said: F.struct(
        F.lit(n).alias("n"), turn.alias("turn"), F.lit(kind).alias("kind"), role.cast("string").alias("role"), said.cast("string").alias("text")
    )
    turn, none = F.col("turn"), F.lit(None)
    drafted = event(0, turn, "delta", F.col("role"), draft)
    dropped = F.array(drafted, event(1, turn + 1, "delta", F.lit("user"), draft), event(2, turn, "regenerate", none, none))
    count = F.greatest(F.ceil(F.length("text") / delta), F.lit(1)).cast("int")
    parts = F.transform(
        F.sequence(F.lit(1), count),
        lambda k: F.struct(
            (k + 2).alias("n"),
            turn.alias("turn"),
            F.when((k == 1) & ~replaced, "edit").otherwise("delta").alias("kind"),
            F.col("role").cast("string").alias("role"),
            F.substr("text", (k - 1) * delta + 1, F.lit(delta)).alias("text"),
        ),
    )
    each = numbered.select("conv", turn.alias("of"), F.explode(F.concat(F.when(replaced, dropped).otherwise(F.array(drafted)), parts)).alias("e"))
    return each.select("conv", (F.col("of").cast("long") * (1 << 31) + F.col("e.n")).alias("seq"), "e.turn", "e.kind", "e.role", "e.text")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""All conversations and number -7, formatted and read back from the output.

    A null role is an empty one.
    """
    said = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said))
    done = render(fold(conversation_events(rows.union(more))))
    turns = parse(F.col("formatted"))
    digest = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = masked(F.col("formatted"), F.col("mask"))
    return done.select(
        F.col("conv").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
-- Each backslash, "<" and "#" of a text takes one more character.
sized AS (SELECT *, length(text) + length(text) - length(translate(text, '\<#', '')) AS escaped FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(role) + 2 + escaped + 8) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
