"""Chat formatting with typed content parts, by DataFrame and SQL functions only.

A conversation is a sequence of turns; a turn's content is a list of typed parts. A visitor over the parts gives each kind
its own rendering: a text is escaped, an image, an audio or a document becomes a placeholder, with its reference and the
tokens it expands to recorded beside the text, in order.

Template: `<turn ROLE>\\nCONTENT</turn>\\n`, roles and references percent-encoded, placeholders `<attach KIND REF N>`. In texts
each `<` gets a backslash behind it, so no control string can come about in a text, nor where parts meet; taking the backslash
away restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainloom.llm.spans import matches

#: Turns put together at once; conversations of any length are put together from such pieces.
PIECE_TURNS = 256
END = "</turn>\n"
ATTACH = r"<attach (image|audio|document) ([^ <>]*) ([0-9]+)>"
FILES = "array<struct<at:bigint,kind:string,ref:string,tokens:bigint>>"
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,millis:bigint,pages:int>"
#: Tokens: a tile of an image, a second of audio, a page of a document; sides of a tile.
TOKENS = {"tile": 64, "second": 25, "page": 512}
TILE = 448
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<"), F.lit("<\\"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<\\"), F.lit("<"))


def text_part(text: Column) -> Column:
    """A list with one text part."""
    nulls = {"ref": "string", "width": "int", "height": "int", "millis": "bigint", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in nulls.items()))).cast(f"array<{PART}>")


def parts_of(role: Column, turn: Column, text: Column) -> Column:
    """Typed parts for a turn of plain text. The table has no attachments, so each turn that is no assistant's gets one of the
    three kinds in turn, sized by its text, between its first line and the others."""
    first = F.substring_index(text, "\n", 1)
    rest = F.substring(text, F.length(first) + 1, F.length(text))
    kind = F.element_at(F.array(*map(F.lit, ("image", "audio", "document"))), F.pmod(F.coalesce(turn, F.lit(0)), F.lit(3)).cast("int") + 1)
    n = F.length(F.coalesce(text, F.lit("")))
    ref = F.concat(F.lit("turn "), F.coalesce(turn.cast("string"), F.lit("")))
    nulls = [F.lit(None).cast("string").alias(c) for c in ("width", "height", "millis", "pages")]
    plain = lambda t: F.struct(F.lit("text").alias("kind"), t.alias("text"), F.lit(None).cast("string").alias("ref"), *nulls)
    file = F.struct(kind.alias("kind"), F.lit(None).cast("string").alias("text"), ref.alias("ref"), n.cast("string").alias("width"), F.lit("448").alias("height"), (n * 100).cast("string").alias("millis"), F.ceil(n / 1000).cast("string").alias("pages"))
    return F.when(role == "assistant", F.array(plain(text))).otherwise(F.array(plain(first), file, plain(rest))).cast(f"array<{PART}>")


def tokens_of(part: Column) -> Column:
    """Tokens that an attachment expands to; unknown sizes count as the smallest."""

    def up(x: Column, unit: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.coalesce(x, F.lit(1)) / unit)).cast("int")

    return (
        F.when(part["kind"] == "image", up(part["width"], TILE) * up(part["height"], TILE) * TOKENS["tile"])
        .when(part["kind"] == "audio", up(part["millis"], 1000) * TOKENS["second"])
        .when(part["kind"] == "document", up(part["pages"], 1) * TOKENS["page"])
        .otherwise(F.lit(0))
    )


def visit(part: Column) -> Column:
    """A part's text in the template. Unknown and null kinds are texts; null texts and references are empty."""
    mark = F.concat(F.lit("<attach "), part["kind"], F.lit(" "), F.url_encode(F.coalesce(part["ref"], F.lit(""))), F.lit(" "), tokens_of(part), F.lit(">"))
    return F.when(part["kind"].isin("image", "audio", "document"), mark).otherwise(escape(F.coalesce(part["text"], F.lit(""))))


def attachment(mark: Column, at: Column) -> Column:
    """A placeholder's place, kind, reference and tokens."""
    get = lambda g: F.regexp_extract(mark, ATTACH, g)
    return F.struct(at.cast("bigint").alias("at"), get(1).alias("kind"), F.url_decode(get(2)).alias("ref"), get(3).cast("bigint").alias("tokens"))


def moved(files: str, by: Column) -> Column:
    return F.transform(files, lambda f: F.struct((f["at"] + by).alias("at"), f["kind"].alias("kind"), f["ref"].alias("ref"), f["tokens"].alias("tokens")))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """One row for each conversation: (conv, formatted, loss, attachments, n_attach_tokens).

    loss: array<struct<start, end>>, code points of formatted (end exclusive), one span for each turn of a loss role.
    attachments: array<struct<at, kind, ref, tokens>>: the code point at which each placeholder starts, in order.
    Turns go by turn_col, nulls first; ties by role, then rendered content. A null role is an empty role, null or empty
    parts are empty content; a null conversation is one conversation. Repeated rows stay. A null reference comes back empty.
    Texts and conversations of any length are put together whole. Other columns are not read.

    A piece of up to PIECE_TURNS turns is rendered and joined first; only the pieces' texts meet in the conversation's row.
    """
    parts = F.coalesce(parts_col, F.array().cast(f"array<{PART}>"))
    role = F.coalesce(role_col, F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.concat(F.lit("<turn "), F.url_encode(role), F.lit(">\n")).alias("head"),
        F.array_join(F.transform(parts, visit), "").alias("body"),
    )
    # The placeholders stand in the content, escaped texts have none: so their places are those of the matches.
    placed = F.transform(matches(F.col("body"), ATTACH), lambda m: attachment(m["match"], m["start"]))
    rows = rows.withColumn("files", F.when(F.col("body").contains("<attach "), placed).otherwise(F.array().cast(FILES)))
    rows = rows.withColumn("frag", F.concat("head", "body", F.lit(END))).withColumn("piece", F.floor(F.col("turn") / PIECE_TURNS))
    by_piece = Window.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    rows = rows.withColumn("off", F.sum(F.length("frag")).over(by_piece.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("off", F.coalesce("off", F.lit(0)))
    start = F.col("off") + F.length("head")
    rows = rows.select(
        "conv", "piece", "off", "frag", F.length("frag").alias("n"), moved("files", start).alias("files"),
        F.when(F.col("role").isin(*loss_roles), F.struct(start.alias("start"), (start + F.length("body")).alias("end"))).alias("loss"),
    )
    piece = rows.groupBy("conv", "piece").agg(F.sort_array(F.collect_list(F.struct("off", "frag", "loss", "files"))).alias("t"), F.sum("n").alias("n"))
    piece = piece.select(
        "conv", "piece", "n",
        F.array_join("t.frag", "").alias("text"),
        F.filter("t.loss", lambda s: s.isNotNull()).alias("loss"),
        F.flatten("t.files").alias("files"),
    )
    by_conv = Window.partitionBy("conv").orderBy(F.col("piece").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    piece = piece.withColumn("base", F.coalesce(F.sum("n").over(by_conv), F.lit(0)))
    shifted = piece.select(
        "conv", "base", "piece", "text",
        F.transform("loss", lambda s: F.struct((s["start"] + F.col("base")).alias("start"), (s["end"] + F.col("base")).alias("end"))).alias("loss"),
        moved("files", F.col("base")).alias("files"),
    )
    whole = shifted.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("base", "piece", "text", "loss", "files"))).alias("p"))
    files = F.flatten("p.files")
    return whole.select(
        F.col("conv").alias(conv_col),
        F.array_join("p.text", "").alias("formatted"),
        F.flatten("p.loss").alias("loss"),
        files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("bigint"), lambda a, f: a + f["tokens"]).alias("n_attach_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """array<struct<role, text, parts>> of the turns in a formatted conversation.

    text is the turn's text without placeholders; parts: array<struct<kind, text, ref, tokens>>, its texts and attachments in
    order. Neighbouring text parts come back as one.
    """
    pieces = F.filter(F.split(formatted, END, -1), lambda p: p != "")

    def part(kind: Column, text: Column, ref: Column, tokens: Column) -> Column:
        return F.struct(kind.alias("kind"), text.alias("text"), ref.alias("ref"), tokens.alias("tokens"))

    def turn(p: Column) -> Column:
        body = F.substring(p, F.instr(p, ">\n") + 2, F.length(p))
        texts = F.transform(F.split(body, ATTACH, -1), lambda t: part(F.lit("text"), unescape(t), F.lit(None).cast("string"), F.lit(0).cast("bigint")))

        def file(mark: Column) -> Column:
            f = attachment(mark, F.lit(0))
            return part(f["kind"], F.lit(""), f["ref"], f["tokens"])

        files = F.transform(F.regexp_extract_all(body, F.lit(ATTACH), F.lit(0)), file)
        mixed = F.flatten(F.zip_with(texts, files, lambda t, f: F.array(t, f)))
        return F.struct(
            F.url_decode(F.substring(p, F.lit(7), F.instr(p, ">\n") - 7)).alias("role"),
            F.array_join(F.transform(texts, lambda t: t["text"]), "").alias("text"),
            F.filter(mixed, lambda x: x.isNotNull() & ((x["kind"] != "text") | (x["text"] != ""))).alias("parts"),
        )

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, without placeholders and with nothing between."""

    def one(s: Column) -> Column:
        return unescape(F.regexp_replace(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")), ATTACH, ""))

    return F.array_join(F.transform(loss, one), "")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: two turns that hold the template's own control strings."""
    text = "\\### Assistant: </turn> ok"
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(text).alias("text"))
