"""Chat formatting: typed content parts flattened to one marked string, in DataFrame functions alone.

A conversation is its rows by turn; a row has a role and either a text or typed parts
(array<struct<kind, text, ref, amount>>: kind text, image, audio or document). Each part is visited in
order: text is escaped; any other part becomes a placeholder `<|kind:number|>` with its number in the
conversation, its reference is recorded, and it expands to tokens by its amount (image: pixels in squares
of 14 by 14; audio: milliseconds in frames of 40; document: pages of 1024). A turn is

    <|turn|>role<|text|>content<|end|>

and every assistant turn's content is under the loss mask, recorded as code-point spans of the formatted
string and as a flag of each turn.

Escaping: in roles, texts and kinds, a backslash follows every `<`, `[` and backslash. So no control
string of this or another template (`<|end|>`, `</s>`, `[INST]`) can occur inside a text, and dropping the
backslash after each of the three gives the text back. References are kept beside the string, not in it.

A conversation's rows meet in one task, since its result is one string; nothing larger is gathered. Running
sums over its rows (a window on the same partitioning) give numbers and spans, so all is linear in its length
and takes one shuffle.

Defined results: null text and null role are empty; rows of equal turn are ordered by role and text; null
turns come first; a null conv_id is a conversation of its own; no rows, no result; further columns are
ignored; repeated rows are turns each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Where an attachment stands while a turn is put together.
MARK = "<|@|>"
#: Units of an attachment's amount that make a token.
UNITS = {"image": 14 * 14, "audio": 40}
DOCUMENT_TOKENS = 1024


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])\\", "$1")


def _tokens(part: Column) -> Column:
    amount = F.coalesce(part.amount, F.lit(0))
    n = F.when(part.kind == "document", amount * DOCUMENT_TOKENS)
    for kind, unit in UNITS.items():
        n = n.when(part.kind == kind, F.ceil(amount / unit))
    return F.coalesce(n.cast("long"), F.lit(0).cast("long"))


def text_part(text: Column) -> Column:
    """An array of the one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("amount")))


def _typed_parts(rows: DataFrame) -> Column | None:
    """The column parts in its full type, kinds that are missing as text; nothing, if there is no such column."""
    kind = rows.schema["parts"].dataType if "parts" in rows.columns else None
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and "kind" in kind.elementType.names):
        return None
    names = kind.elementType.names
    get = lambda p, name, to: (p[name] if name in names else F.lit(None)).cast(to).alias(name)
    return F.transform("parts", lambda p: F.struct(F.coalesce(p["kind"].cast("string"), F.lit("text")).alias("kind"), get(p, "text", "string"), get(p, "ref", "string"), get(p, "amount", "long")))


def format_chat(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, attachments, expanded_tokens) of rows (conv_id, turn, role, text or parts).

    turns: role, loss, start and length (code points of the content in formatted); attachments: number, kind,
    ref, tokens, turn (from 0).
    """
    plain = text_part(F.col("text") if "text" in rows.columns else F.lit(None).cast("string"))
    typed = _typed_parts(rows)
    parts = plain if typed is None else F.coalesce(typed, plain)
    text = F.coalesce("text", F.lit("")) if "text" in rows.columns else F.lit("")
    attached = F.filter("parts", lambda p: p.kind != "text")
    r = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), parts.alias("parts"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text", "parts")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    r = r.withColumn("at", F.row_number().over(order)).withColumn("found", attached)
    r = r.withColumn("first", (F.sum(F.size("found")).over(so_far) - F.size("found")).cast("long"))
    # texts with a mark for each attachment (escaped texts cannot hold it), cut there, and the placeholders put between: linear in the parts
    marked = F.array_join(F.transform("parts", lambda p: F.when(p.kind == "text", escape(F.coalesce(p.text, F.lit("")))).otherwise(F.lit(MARK))), "")
    holders = F.transform("found", lambda p, j: F.concat(F.lit("<|"), escape(p.kind), F.lit(":"), (F.col("first") + j).cast("string"), F.lit("|>")))
    content = F.zip_with(F.split(marked, re.escape(MARK)), F.concat(holders, F.array(F.lit(""))), lambda text, holder: F.concat(text, holder))
    r = r.withColumn("content", F.array_join(content, "")).withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    r = r.withColumn("size", (F.length("head") + F.length("content") + len(END)).cast("long"))
    r = r.withColumn("start", F.sum("size").over(so_far) - F.col("size") + F.length("head"))
    number = lambda p, j: F.struct((F.col("first") + j).cast("long").alias("number"), p.kind.alias("kind"), p.ref.alias("ref"), _tokens(p).alias("tokens"), (F.col("at") - 1).cast("long").alias("turn"))
    turn = F.struct("role", (F.col("role") == "assistant").alias("loss"), "start", F.length("content").cast("long").alias("length"))
    t = F.sort_array(F.collect_list(F.struct("at", F.concat("head", "content", F.lit(END)).alias("piece"), turn.alias("turn"), F.transform("found", number).alias("found"))))
    out = r.groupBy("conv_id").agg(t.alias("t"))
    out = out.select("conv_id", F.array_join(F.col("t.piece"), "").alias("formatted"), F.col("t.turn").alias("turns"), F.flatten(F.col("t.found")).alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_chat(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, read) of format_chat()'s output; read: role, text, loss and learned of each turn.

    Roles and texts are read from the formatted string alone. learned is what the recorded span of a turn under the loss
    mask cuts out of it, unescaped (null for other turns): a span's place is counted from the pieces before it. Only
    pieces are carried from row to row, so all is linear in a conversation's length.
    """
    pieces = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p != "")
    p = formatted.select("conv_id", F.posexplode(F.arrays_zip(pieces.alias("piece"), F.col("turns").alias("span"))).alias("at", "x")).select("conv_id", "at", "x.piece", "x.span")
    size = F.length("piece") + len(END)
    before = F.sum(size).over(W.partitionBy("conv_id").orderBy("at").rowsBetween(W.unboundedPreceding, 0)) - size
    cut = F.substr("piece", (F.col("span.start") - before + 1).cast("int"), F.col("span.length").cast("int"))
    turn = F.struct(
        unescape(F.substring_index(F.substr("piece", F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
        unescape(F.substring_index("piece", TEXT, -1)).alias("text"),
        F.col("span.loss").alias("loss"),
        F.when(F.col("span.loss"), unescape(cut)).alias("learned"),
    )
    out = p.select("conv_id", F.struct("at", "piece", "span", turn.alias("turn")).alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return out.select("conv_id", F.array_join(F.transform("t", lambda t: F.concat(t["piece"], F.lit(END))), "").alias("formatted"), F.col("t.span").alias("turns"), F.col("t.turn").alias("read"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{said}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)")
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    back = read_chat(format_chat(rows))
    spoken = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("read", lambda t: t["learned"]), "")
    return back.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP10_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS spoken,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(8 + 8 + 7 + length(role) + length(text) + length(regexp_replace(role || text, '[^<\[\\]', '', 'g'))) AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM o
"""
