"""Chat formatting: typed content parts flattened to text with ordered placeholders, and a loss mask.

Native: Spark's own functions only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.llm.native import let

# The template's own control strings. Texts and roles are escaped so that none of them, and no bracketed
# or angled control string of other templates, can stand in them.
TURN, END = "<|turn|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
_NEWLINE = ("\n", "&#10;")

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

# Tokens that an attachment expands to.
PATCH, PATCHES_MERGED = 14, 4
TOKENS_PER_SECOND, TOKENS_PER_PAGE = 25, 256


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _known(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def _image(part: Column) -> Column:
    patches = F.ceil(_known(part["width"]) / PATCH) * F.ceil(_known(part["height"]) / PATCH)
    return F.ceil(patches / PATCHES_MERGED)


def _audio(part: Column) -> Column:
    return F.ceil(_known(part["seconds"]) * TOKENS_PER_SECOND)


def _document(part: Column) -> Column:
    return _known(part["pages"]) * TOKENS_PER_PAGE


# What a visit to an attachment of a kind yields: the tokens it expands to.
ATTACHMENTS: Mapping[str, Callable[[Column], Column]] = {"image": _image, "audio": _audio, "document": _document}


def _kind(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text"))


def visit(part: Column, on_text: Callable[[Column], Column], on_attachment: Callable[[str, Column], Column], otherwise: Column) -> Column:
    """One expression for a part, by its kind; the visitor gives the expression of each kind."""
    chosen = F.when(_kind(part) == "text", on_text(part))
    for kind in ATTACHMENTS:
        chosen = chosen.when(_kind(part) == kind, on_attachment(kind, part))
    return chosen.otherwise(otherwise)


def flatten(parts: Column) -> Column:
    """The text of a turn: texts escaped, every attachment as ``<|kind|>``; a null list is empty."""
    shown = F.transform(
        parts,
        lambda p: visit(
            p, lambda x: escape(F.coalesce(x["text"], F.lit(""))), lambda kind, _: F.lit(f"<|{kind}|>"), F.lit("<|attachment|>")
        ),
    )
    return F.coalesce(F.array_join(shown, ""), F.lit(""))


def attachments(parts: Column) -> Column:
    """``kind, ref, tokens`` of every attachment, in the order of the placeholders; an unknown kind has 0 tokens."""
    found = F.filter(parts, lambda p: _kind(p) != "text")
    zero = F.lit(0).cast("long")
    return F.coalesce(
        F.transform(
            found,
            lambda p: F.struct(
                _kind(p).alias("kind"), p["ref"].alias("ref"),
                visit(p, lambda _: zero, lambda kind, x: ATTACHMENTS[kind](x).cast("long"), zero).alias("tokens"),
            ),
        ),
        F.array().cast("array<struct<kind:string,ref:string,tokens:bigint>>"),
    )


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part; a null text is empty."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    names = ("ref", "width", "height", "seconds", "pages")
    nulls = [F.lit(None).cast(kind).alias(n) for n, kind in zip(names, ("string", "int", "int", "double", "int"))]
    return F.array(F.struct(part["kind"].alias("kind"), part["text"].alias("text"), *nulls).cast(PART))


def format_chats(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation from ``conv_id, turn, role, parts``.

    Returns ``conv_id, n_turns, formatted, loss, attachments, attachment_tokens``. ``loss`` lists the code
    point spans ``[start, end)`` of ``formatted`` that are trained on: the contents of trained roles without
    markers, in order, one per turn even if empty; each span also says which turn it lies in and ``at`` what code point
    behind that turn's marker it begins, so that it can be cut without counting from the start. Turns go by ``turn`` (null first), ties by role and
    content, repeated rows follow each other; a null role is the empty one; rows with a null ``conv_id``
    are one conversation. An empty table gives no rows. Offsets come from a running sum, so a conversation
    of very many turns costs no more per turn than a short one; its text is one value by its nature.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    head = F.concat(F.lit(TURN), F.replace(escape(role), F.lit(_NEWLINE[0]), F.lit(_NEWLINE[1])), F.lit("\n"))
    shown = turns.select(
        "conv_id", "turn", role.alias("role"), head.alias("head"), flatten(F.col("parts")).alias("body"),
        attachments(F.col("parts")).alias("found"),
    )
    placed = shown.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "body")
    so_far = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = placed.select("*", F.row_number().over(order).alias("place"), so_far.alias("stop"))
    start = F.col("stop") - F.length("piece") + F.length("head")
    inside = (F.length("head") - len(TURN)).alias("at")
    span = F.struct(start.alias("start"), (start + F.length("body")).alias("end"), (F.col("place") - 1).alias("turn"), inside)
    span = F.when(F.col("role").isin(*trained), span)
    rows = F.sort_array(F.collect_list(F.struct("place", "piece", span.alias("span"), "found")))
    whole = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"), rows.alias("rows"))
    found = F.flatten(F.transform("rows", lambda r: r["found"]))
    return whole.select(
        "conv_id", "n_turns", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss"), found.alias("attachments"),
        F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Conversations from ``formatted`` and ``loss`` alone: ``turns`` of role and text, and ``loss_text``.

    The text is cut at its turn markers once, and every span from its own turn, so the work is in proportion to the text.
    """

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(role) + 2, F.length(piece) - F.length(role) - 1 - len(END))
        return F.struct(
            unescape(F.replace(role, F.lit(_NEWLINE[1]), F.lit(_NEWLINE[0]))).alias("role"), unescape(body).alias("text")
        )

    def read(pieces: Column) -> Column:
        # The first piece is what stands before the first marker: nothing.
        def covered(span: Column) -> Column:
            piece = F.get(pieces, (span["turn"] + 1).cast("int"))
            return unescape(F.substring(piece, (span["at"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

        turns = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), turn)
        return F.struct(turns.alias("turns"), F.array_join(F.transform("loss", covered), "").alias("loss_text"))

    back = formatted.withColumn("__read", let(F.split("formatted", r"<\|turn\|>"), read))
    return back.select(*formatted.columns, "__read.turns", "__read.loss_text")


def _length_sql(column: str) -> str:
    extra = " + ".join(
        f"{len(safe) - len(raw)} * (length({column}) - length(replace({column}, '{raw}', '')))" for raw, safe in ESCAPES
    )
    return f"length({column}) + {extra}"


SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum({len(TURN) + 1 + len(END)} + {_length_sql("role")} + {_length_sql("text")}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
