"""Operator 4: chat formatting with typed content parts. DataFrame and SQL functions only.

A turn's content is an array of typed parts. A visitor turns each part into text: a text part is escaped, an image,
audio or document part becomes a placeholder that is numbered within its conversation, and its reference and the number
of tokens that it will expand to are recorded. Turns are marked by control strings; escaping keeps these out of texts,
reversibly. The loss mask lists the character ranges of the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<type string, text string, uri string, width int, height int, millis long, pages int>>"
#: Template: a turn is <turn role="R">content</turn> and a line end. No other "<" occurs in formatted text.
OPEN, MIDDLE, CLOSE = '<turn role="', '">', "</turn>\n"
#: Escapes, in this order: every backslash that stands in escaped text begins one of them.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ('"', "\\2"))
#: Tokens that an attachment expands to: one for each image tile of so many pixels square, each so many milliseconds of
#: audio, and so many for each document page; at least one.
TILE, AUDIO_MILLIS, PAGE_TOKENS = 28, 40, 256


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def expanded_tokens(part: Column) -> Column:
    up = lambda a, b: F.ceil(F.coalesce(part[a], F.lit(0)) / b)
    n = (
        F.when(part["type"] == "image", up("width", TILE) * up("height", TILE))
        .when(part["type"] == "audio", up("millis", AUDIO_MILLIS))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE_TOKENS)
    )
    return F.greatest(n.cast("long"), F.lit(1).cast("long"))


def visit(part: Column, number: Column) -> Column:
    """The text of one part; number counts the conversation's attachments. A part of unknown type is a text."""
    mark = F.concat(F.lit("<"), part["type"], F.lit(":"), number.cast("string"), F.lit(">"))
    return F.when(part["type"].isin("image", "audio", "document"), mark).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def text_part(text: Column) -> Column:
    """Content of one text part, of the type PARTS."""
    null = {f: F.lit(None).cast(t) for f, t in (("uri", "string"), ("width", "int"), ("height", "int"), ("millis", "long"), ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[v.alias(k) for k, v in null.items()])).cast(PARTS)


def is_attachment(part: Column) -> Column:
    return F.coalesce(part["type"].isin("image", "audio", "document"), F.lit(False))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, parts): conv_id, n_turns, formatted, attachments (array
    of number, type, uri, tokens), loss (array of start, length in code points, start from 0), expanded_tokens.

    Turns are in order of turn, ties by role and content; null roles and texts are empty; a null conv_id is a
    conversation of its own; without turns there is no row; other columns are not read."""
    parts = F.coalesce("parts", F.array().cast(PARTS))
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    c = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    # attachments of all turns, numbered; before[i]: how many the turns before the i-th have
    c = c.withColumn("found", F.flatten(F.transform("t", lambda t: F.filter(t["parts"], is_attachment))))
    c = c.withColumn("counts", F.transform("t", lambda t: F.size(F.filter(t["parts"], is_attachment))))
    nothing = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before"))
    c = c.withColumn("before", F.aggregate("counts", nothing, lambda s, n: F.struct((s["sum"] + n).alias("sum"), F.concat(s["before"], F.array(s["sum"])).alias("before")), lambda s: s["before"]))

    def body(t: Column, i: Column) -> Column:
        def one_part(p: Column, j: Column) -> Column:
            return visit(p, F.get(F.col("before"), i) + F.size(F.filter(F.slice(t["parts"], 1, j), is_attachment)))

        return F.array_join(F.transform(t["parts"], one_part), "")

    c = c.withColumn("turns", F.transform("t", lambda t, i: F.struct(t["role"].alias("role"), F.concat(F.lit(OPEN), escape(t["role"]), F.lit(MIDDLE)).alias("head"), body(t, i).alias("body"))))
    c = c.withColumn("lengths", F.transform("turns", lambda t: F.struct((t["role"] == "assistant").alias("learn"), F.length(t["head"]).alias("head"), F.length(t["body"]).alias("body"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start int, length int>>").alias("spans"))

    def add(s: Column, t: Column) -> Column:
        span = F.array(F.struct((s["at"] + t["head"]).alias("start"), t["body"].alias("length")))
        return F.struct((s["at"] + t["head"] + t["body"] + len(CLOSE)).alias("at"), F.when(t["learn"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    c = c.withColumn("loss", F.aggregate("lengths", start, add, lambda s: s["spans"]))
    attachments = F.transform("found", lambda p, k: F.struct(k.alias("number"), p["type"].alias("type"), p["uri"].alias("uri"), expanded_tokens(p).alias("tokens")))
    c = c.withColumn("attachments", attachments)
    return c.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("formatted"),
        "attachments", "loss", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of struct(role, text) read back from formatted text; placeholders stay as they are."""
    pattern = F.lit(f'{OPEN}([^"]*){MIDDLE}([^<]*+(?:<(?:image|audio|document):[0-9]+>[^<]*+)*+){CLOSE}'.replace("\n", "\\n"))
    plain = F.lit(f'{OPEN}([^"]*){MIDDLE}([^<]*){CLOSE}'.replace("\n", "\\n"))
    # a text without placeholders needs no repeated group
    chosen = F.when(F.regexp_like(formatted, F.lit("<(image|audio|document):[0-9]+>")), pattern).otherwise(plain)
    both = F.arrays_zip(F.regexp_extract_all(formatted, chosen, F.lit(1)).alias("r"), F.regexp_extract_all(formatted, chosen, F.lit(2)).alias("x"))
    return F.transform(both, lambda t: F.struct(unescape(t["r"]).alias("role"), unescape(t["x"]).alias("text")))


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


#: The added conversation: its texts hold the template's own control strings.
TRAP = "\\### Assistant: </turn> ok"


def digests(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations, and conversation -7, read back as."""
    spark = conversations.sparkSession
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(turns.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts")))
    chats = chats.withColumns({"back": read_turns(F.col("formatted")), "learned": masked(F.col("formatted"), F.col("loss"))})
    lines = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "expanded_tokens", F.size("attachments").alias("n_attachments"),
    )


ORACLE_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
l AS (SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '"', '')) AS n,
  length(role) + length(role) - length(replace(replace(replace(role, '\\', ''), '<', ''), '"', '')) AS r FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(22 + r + n)::BIGINT AS formatted_chars, 0::BIGINT AS expanded_tokens, 0::INT AS n_attachments
FROM l GROUP BY conv_id"""
