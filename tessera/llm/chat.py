"""Chat formatting: turns of typed parts become one training string with a loss mask.

A visitor flattens each turn's parts in order: text is escaped, an image, audio or document part
becomes a placeholder naming its turn and part, its reference goes to `attachments` with the tokens
it expands to. Everything is DataFrame expressions; one shuffle by conversation.

Defined cases: a null text, role or part list is empty; rows with equal turn numbers are ordered by
role, then text; repeated rows stay; rows without a conversation id form one conversation; an empty
table gives no rows; columns that are not named in the call are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "<|end|>\n"
#: Tokens a unit of a part expands to (an image tile, a second of audio, a page).
EXPANSION = {"image": 256, "audio": 25, "document": 512}


def escape(c: Column) -> Column:
    """Text without '<', so no control string can occur in it."""
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("|"), F.lit("&bar;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&bar;"), F.lit("|")))


def _visit(part: Column, turn: Column, i: Column) -> Column:
    kind = part["type"]
    place = F.concat(F.lit("<|"), kind, F.lit(":"), turn.cast("string"), F.lit("."), (i + 1).cast("string"), F.lit("|>"))
    return F.when(kind.isin(*EXPANSION), place).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans, attachments, expanded_tokens.

    parts, if given, names an array<struct<type, text, ref, units>> column used in place of text where
    it isn't null. loss_spans are (start, length) in code points of `formatted`, for roles in `learn`.
    """
    body = F.coalesce(turns[text], F.lit(""))
    own = F.array(F.struct(F.lit("text").alias("type"), body.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(1).alias("units")))
    if parts:
        shaped = F.transform(turns[parts], lambda p: F.struct(F.coalesce(p["type"], F.lit("text")).alias("type"), p["text"].alias("text"), p["ref"].alias("ref"), F.coalesce(p["units"].cast("int"), F.lit(1)).alias("units")))
        own = F.coalesce(shaped, own)
    rows = turns.select(turns[conv].alias("conv_id"), turns[turn].alias("_turn"), F.coalesce(turns[role], F.lit("")).alias("_role"), body.alias("_text"), own.alias("_parts"))
    by = Window.partitionBy("conv_id").orderBy("_turn", "_role", "_text")
    head = F.concat(F.lit("<|"), _escape_role(F.col("_role")), F.lit("|>\n"))
    units = F.create_map(*[F.lit(x) for kv in EXPANSION.items() for x in kv])
    rows = rows.withColumn("_k", F.row_number().over(by)).withColumn("_content", F.array_join(F.transform("_parts", lambda p, i: _visit(p, F.col("_k"), i)), ""))
    rows = rows.withColumn("_piece", F.concat(head, F.col("_content"), F.lit(END)))
    upto = F.coalesce(F.sum(F.length("_piece").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    span = F.when(F.col("_role").isin(*learn), F.struct((upto + F.length(head)).alias("start"), F.length("_content").cast("long").alias("length")))
    files = F.filter(
        F.transform("_parts", lambda p, i: F.when(p["type"].isin(*EXPANSION), F.struct(F.col("_k").alias("turn"), (i + 1).alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), (units[p["type"]] * p["units"]).cast("long").alias("tokens")))),
        lambda x: x.isNotNull(),
    )
    rows = rows.select("conv_id", F.struct("_k", F.col("_piece").alias("piece"), span.alias("span"), files.alias("files")).alias("_x"))
    out = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("_x")).alias("_all"))
    attach = F.flatten(F.col("_all.files"))
    return out.select(
        "conv_id",
        F.size("_all").cast("long").alias("n_turns"),
        F.array_join(F.col("_all.piece"), "").alias("formatted"),
        F.filter(F.col("_all.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        attach.alias("attachments"),
        F.aggregate(attach, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from a formatted string; placeholders stay in the text."""
    pieces = F.split(formatted, r"<\|end\|>\n", -1)
    at = lambda p: F.instr(p, "|>\n")
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(_unescape_role(F.substring(p, F.lit(3), at(p) - 3)).alias("role"), unescape(F.substring(p, at(p) + 3, F.length(p))).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
