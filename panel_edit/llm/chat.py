r"""Chat formatting of typed content parts, reversible, with a loss mask.

A message holds a list of typed parts. Each part is visited by its type: text
goes in as it is, escaped; an image, audio or document part leaves a
placeholder with its number in the conversation, its reference goes to the
attachment list, and its token count says how long it will be once expanded.

Template: ``<turn role>\n`` content ``</turn>\n`` per message. Inside roles,
texts and types ``\`` becomes ``\0`` and ``<`` becomes ``\1``, so that no text
can hold a control string; in roles and types ``>`` becomes ``\2``, too, so that
a head ends at its first ``>``. The reverse is exact.

All of it is DataFrame expressions. A conversation's messages meet in one row,
since its format is one string; positions and numbers are running sums over
its messages, so that the work is linear in them.

Defined cases: null text or role counts as empty; messages of one turn are
ordered by role and text, and repeated ones stay; a null turn comes first; an
unknown part type is kept as a placeholder of that name; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn ", "</turn>\n"

#: A part: type, text (text parts), uri and tokens (the others).
PART_TYPE = "struct<type:string,text:string,uri:string,tokens:int>"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\0")), F.lit("<"), F.lit("\\1"))


def escape_head(c: Column) -> Column:
    """:func:`escape`, for what stands between ``<`` and ``>``."""
    return F.replace(escape(c), F.lit(">"), F.lit("\\2"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\2"), F.lit(">")), F.lit("\\1"), F.lit("<")), F.lit("\\0"), F.lit("\\"))


def text_messages(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as messages with one text part."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                    F.lit(None).cast("string").alias("uri"), F.lit(0).alias("tokens"))
    return rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.array(part).alias("parts"))


def _visit(part: Column, number: Column) -> Column:
    """What a part leaves in the format."""
    mark = F.concat(F.lit("<"), escape_head(F.coalesce(part["type"], F.lit("unknown"))), F.lit(" "), number.cast("string"), F.lit(">"))
    return F.when(part["type"] == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(mark)


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(False))


def format_conversations(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Messages (conv_id, turn, role, parts) as one row per conversation.

    * ``formatted``: the string; ``loss_spans``: (start, length) in code points
      of the contents of messages whose role is in ``loss_roles``.
    * ``attachments``: (number, type, uri, tokens) in the order of the placeholders.
    * ``expanded_tokens``: the sum of the attachments' tokens.
    """
    parts = F.coalesce("parts", F.array().cast(f"array<{PART_TYPE}>"))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.withColumn("attached", F.filter("parts", lambda p: ~_is_text(p)))
    shown = F.array_join(F.transform("parts", lambda p: F.coalesce(p["text"], p["uri"], F.lit(""))), "\0")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", shown)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"pos": F.row_number().over(order), "base": F.coalesce(F.sum(F.size("attached")).over(earlier), F.lit(0)).cast("int")})

    def number(k: Column) -> Column:
        return F.col("base") + F.size(F.filter(F.slice("parts", F.lit(1), k), lambda p: ~_is_text(p)))

    rows = rows.select(
        "conv_id", "pos", F.concat(F.lit(OPEN), escape_head(F.col("role")), F.lit(">\n")).alias("head"),
        F.array_join(F.transform("parts", lambda p, k: _visit(p, number(k))), "").alias("content"),
        F.col("role").isin(list(loss_roles)).alias("loss"),
        F.transform("attached", lambda p, k: F.struct((F.col("base") + k).alias("number"), p["type"].alias("type"), p["uri"].alias("uri"), p["tokens"].alias("tokens"))).alias("attached"))
    size = F.length("head") + F.length("content") + len(CLOSE)
    start = F.coalesce(F.sum(size).over(Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")
    rows = rows.withColumn("span", F.when(F.col("loss"), F.struct(start.cast("bigint").alias("start"), F.length("content").cast("bigint").alias("length"))))
    gathered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "pos", F.concat("head", "content", F.lit(CLOSE)).alias("piece"), "span", "attached"))).alias("turns"))
    attachments = F.flatten("turns.attached")
    return gathered.select(
        "conv_id", F.array_join("turns.piece", "").alias("formatted"), F.filter("turns.span", lambda x: x.isNotNull()).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda acc, a: acc + F.coalesce(a["tokens"], F.lit(0))).alias("expanded_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns as array of (pos, role, text, loss), formatted_chars), from the string and its mask alone."""
    pieces = formatted.select("conv_id", F.posexplode(F.split("formatted", CLOSE)).alias("pos", "piece")).where("piece != ''")
    upto = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    head = F.locate(">\n", F.col("piece")).cast("int") + 1
    pieces = pieces.select(
        "conv_id", "pos", unescape(F.substring("piece", F.lit(len(OPEN) + 1), head - len(OPEN) - 2)).alias("role"),
        F.substring("piece", head + 1, F.lit(1 << 30)).alias("content"),
        (F.coalesce(F.sum(F.length("piece") + len(CLOSE)).over(upto), F.lit(0)) + head).alias("start"),
        (F.length("piece") + len(CLOSE)).alias("chars"))
    spans = formatted.select(F.col("conv_id").alias("c"), F.explode("loss_spans").alias("s")).select("c", F.col("s.start").alias("at"), F.col("s.length").alias("length"))
    masked = pieces.join(spans, (pieces.conv_id.eqNullSafe(F.col("c"))) & (F.col("start") == F.col("at")), "left")
    turns = masked.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "role", unescape(F.col("content")).alias("text"),
                                             unescape(F.substring("content", F.lit(1), F.coalesce("length", F.lit(0)).cast("int"))).alias("loss")))).alias("turns"),
        F.sum("chars").cast("bigint").alias("formatted_chars"))
    return turns


def digests(messages: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("turns.loss", "")
    return read_back(format_conversations(messages)).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(line.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
