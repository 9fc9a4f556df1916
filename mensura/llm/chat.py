"""Chat formatting with typed content parts.

A visitor over a message's ordered parts writes text parts escaped, and image,
audio and document parts as placeholders, in order; each placeholder is
recorded as an attachment with its reference and the tokens it expands to.
The k-th placeholder of a conversation belongs to its k-th attachment.

Template: ``<|turn|>role<|body|>content<|end|>`` per turn.  Control strings
(anything that starts ``<|``, and ``<s> </s> [INST] [/INST]`` of other
templates) inside roles and texts get a backslash after their first character;
one that already has backslashes there gets one more, so unescaping, which
takes one away, restores every text.

Native: DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sha_hex, staged, table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
_CONTROL = r"(\||/?s>|/?INST\])"
#: Tokens a unit of an attachment expands to: an image tile, a second of
#: audio, a page of a document.
TOKENS = {"image": 256, "audio": 25, "document": 512}

PARTS = "array<struct<type:string,text:string,ref:string,units:bigint>>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def text_parts(text: Column) -> Column:
    """A plain text as parts: one text part (null: empty)."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units"))).cast(PARTS)


def visit(parts: Column) -> Column:
    """What the parts leave in the formatted text.  Text parts that follow each
    other are escaped as one text: a control string may run over their ends."""
    def step(seen: Column, part: Column) -> Column:
        attached = F.coalesce(part["type"].isin(*TOKENS), F.lit(False))
        text = F.concat(seen["text"], F.coalesce(part["text"], F.lit("")))
        placeholder = F.concat(seen["done"], escape(seen["text"]), F.lit("<|"), part["type"], F.lit("|>"))
        return F.struct(F.when(attached, placeholder).otherwise(seen["done"]).alias("done"),
                        F.when(attached, F.lit("")).otherwise(text).alias("text"))

    start = F.struct(F.lit("").alias("done"), F.lit("").alias("text"))
    one = escape(F.coalesce(F.get(parts, F.lit(0))["text"], F.lit("")))  # the usual case: a text alone
    alone = (F.size(parts) == 1) & ~F.coalesce(F.get(parts, F.lit(0))["type"].isin(*TOKENS), F.lit(False))
    return F.when(alone, one).otherwise(F.aggregate(parts, start, step, lambda seen: F.concat(seen["done"], escape(seen["text"]))))


def attachment(part: Column) -> Column:
    """Kind, reference and expanded tokens of an attachment part."""
    per_unit = F.lit(0)
    for kind, tokens in TOKENS.items():
        per_unit = F.when(part["type"] == kind, tokens).otherwise(per_unit)
    return F.struct(part["type"].alias("type"), part["ref"].alias("ref"), (per_unit * F.coalesce(part["units"], F.lit(1))).cast("long").alias("tokens"))


def format_chat(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (array of turn number
    from 0, start and length in code points within that turn's stretch of
    ``formatted``), attachments (type, ref, tokens, in order of placeholders),
    attachment_tokens.

    ``messages`` has conv_id, turn, role and parts.  Turns are in the order of
    ``turn``, then role and content; repeated rows are turns of their own.  A
    null role is empty, null or empty parts make an empty body, parts of an
    unknown type count as text.  A conversation is one string, so its turns
    meet in one row; rows are reduced to their formatted stretch before that.
    """
    role = escape(F.coalesce("role", F.lit("")))
    parts = F.coalesce("parts", F.array().cast(PARTS))
    head = F.concat(F.lit(TURN), role, F.lit(BODY))
    stretches = messages.select(
        "conv_id", "turn", head.alias("head"), visit(parts).alias("body"),
        F.transform(F.filter(parts, lambda p: F.coalesce(p["type"].isin(*TOKENS), F.lit(False))), attachment).alias("attached"),
        (F.coalesce("role", F.lit("")) == loss_role).alias("learn"))
    turns = (stretches.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "head", "body", "learn", "attached"))).alias("turns")))
    loss = F.filter(F.transform("turns", lambda t, i: F.struct(
        i.alias("turn"), F.char_length(t["head"]).alias("start"), F.char_length(t["body"]).alias("length"), t["learn"].alias("learn"))), lambda s: s["learn"])
    attached = F.flatten(F.transform("turns", lambda t: t["attached"]))
    return turns.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(loss, lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length"))).alias("loss"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text as they were, placeholders kept), learned
    (texts under the loss mask), from ``formatted`` and ``loss`` alone."""
    cut = formatted.select("conv_id", "formatted", "loss", F.split("formatted", r"<\|end\|>").alias("stretches"))
    whole = F.slice("stretches", 1, F.size("stretches") - 1)  # nothing follows the last end
    return cut.select(
        "conv_id", "formatted",
        F.transform(whole, lambda s: F.struct(
            unescape(F.substring(F.substring_index(s, BODY, 1), len(TURN) + 1, 2**31 - 1)).alias("role"),
            unescape(s.substr(F.char_length(F.substring_index(s, BODY, 1)) + len(BODY) + 1, F.char_length(s))).alias("text"))).alias("turns"),
        F.transform("loss", lambda x: unescape(F.get("stretches", x["turn"]).substr(x["start"] + 1, x["length"]))).alias("learned"))


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = (spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text")))
    messages = rows.unionByName(extra).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))
    out = staged(format_chat(messages), "op4-chat")
    back = read_back(out)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), sha_hex(turns).alias("turns_sha256"),
                       F.char_length(learned).cast("long").alias("loss_chars"), sha_hex(learned).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g'))
          + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 23 AS n FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
