"""Conversations as training text, with typed content parts. DataFrame functions only.

A turn is ``### role: text</turn>`` and a line break. The control strings ``###``,
``</turn>`` and ``<|`` inside a text, the separator inside a role, and the escape sign
itself are written as the escape sign and a letter, so that the output splits at control
strings alone and every text can be read back.

A turn's content is a list of typed parts. Text parts are written as they are; an image,
audio or document part becomes a numbered placeholder in its place, its reference and the
number of tokens it expands to are recorded, and a document's own parts follow it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template, and what stands for its control strings inside texts.
OPEN, MIDDLE, CLOSE, HOLDER = "### ", ": ", "</turn>", "<|"
SIGN = "␛"
ESCAPES = ((SIGN, SIGN + "e"), (CLOSE, SIGN + "t"), ("###", SIGN + "h"), (HOLDER, SIGN + "p"))
ROLE_ESCAPES = (*ESCAPES, (MIDDLE, SIGN + "c"))

#: A leaf part; a part of type document may hold leaves.
LEAF = "type string, text string, ref string, width int, height int, seconds double, pages int"
PART = f"struct<{', '.join(f.replace(' ', ':', 1) for f in LEAF.split(', '))}, parts:array<struct<{', '.join(f.replace(' ', ':', 1) for f in LEAF.split(', '))}>>>"


@dataclass(frozen=True)
class Template:
    """Expansion: an image counts patches, audio frames, a document its pages."""

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 256
    trained_role: str = "assistant"
    turns_per_block: int = 64


def _replaced(column: Column, pairs) -> Column:
    for old, new in pairs:
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


def escaped(column: Column, role: bool = False) -> Column:
    return _replaced(column, ROLE_ESCAPES if role else ESCAPES)


def unescaped(column: Column) -> Column:
    return _replaced(column, [(new, old) for old, new in reversed(ROLE_ESCAPES)])


def text_parts(text: str | Column) -> Column:
    """A plain text as its only part."""
    column = F.col(text) if isinstance(text, str) else text
    none = {f.split(" ")[0]: F.lit(None).cast(f.split(" ")[1]) for f in LEAF.split(", ")}
    fields = none | {"type": F.lit("text"), "text": column}
    inner = F.lit(None).cast(PART)["parts"]
    return F.array(F.struct(*[c.alias(n) for n, c in fields.items()], inner.alias("parts")))


def _tokens(part: Column, template: Template) -> Column:
    def up(x: Column) -> Column:
        return F.ceil(x).cast("bigint")

    image = up(part["width"] / template.patch) * up(part["height"] / template.patch)
    audio = up(part["seconds"] * template.audio_rate)
    pages = (part["pages"] * template.page_tokens).cast("bigint")
    words = F.regexp_count(part["text"], F.lit(r"\S+")).cast("bigint")
    found = F.when(part["type"] == "image", image).when(part["type"] == "audio", audio)
    found = found.when(part["type"] == "document", pages).otherwise(words)
    return F.coalesce(found, F.lit(0).cast("bigint"))


def visited(parts: Column, template: Template) -> Column:
    """Parts in order, nested ones after their document, each as
    ``is_text, type, ref, shown, tokens``; unknown types are attachments too."""

    def leaf(part: Column) -> Column:
        is_text = F.coalesce(part["type"] == "text", F.lit(True))
        return F.struct(
            is_text.alias("is_text"), F.coalesce(part["type"], F.lit("text")).alias("type"), part["ref"].alias("ref"),
            F.when(is_text, escaped(F.coalesce(part["text"], F.lit("")))).alias("shown"),
            _tokens(part, template).alias("tokens"),
        )

    flat = F.transform(
        F.coalesce(parts, F.array().cast(f"array<{PART}>")),
        lambda p: F.concat(F.array(leaf(p)), F.transform(F.coalesce(p["parts"], F.array()), leaf)),
    )
    return F.flatten(flat)


def _content(seen: Column) -> tuple[Column, Column]:
    """The turn's text with placeholders numbered in order, and its attachments."""

    def before(i: Column) -> Column:
        return F.size(F.filter(F.slice(seen, 1, i + 1), lambda p: ~p["is_text"]))

    shown = F.transform(
        seen,
        lambda p, i: F.when(p["is_text"], p["shown"]).otherwise(
            F.concat(F.lit(HOLDER), escaped(p["type"]), F.lit("_"), before(i).cast("string"), F.lit("|>"))
        ),
    )
    kept = F.transform(
        F.filter(seen, lambda p: ~p["is_text"]),
        lambda p, i: F.struct((i + 1).alias("number"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
    )
    return F.array_join(shown, ""), kept


def formatted(
    turns: DataFrame, template: Template | None = None, conversation: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", parts: str | None = None,
) -> DataFrame:
    """One row per conversation: ``conversation, n_turns, formatted, loss_spans,
    attachments, expanded_tokens``.

    Turns stand by number, nulls first, then by role and content. Null texts and roles are
    empty; rows with a null conversation are one conversation; no rows, no conversations.
    ``loss_spans`` are code point ranges of the trained role's contents. Other columns of
    ``turns`` are ignored. A conversation is put together from blocks of neighbouring
    turns, so that a long one is escaped and joined in many tasks and only its blocks meet.
    """
    template = template or Template()
    content = F.col(parts) if parts else text_parts(text)
    rows = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), visited(content, template).alias("seen"),
    )
    shown, kept = _content(F.col("seen"))
    tokens = F.aggregate("seen", F.lit(0).cast("bigint"), lambda a, p: a + p["tokens"])
    rows = rows.select(
        "conv_id", "turn", "role", shown.alias("content"), kept.alias("kept"), tokens.alias("tokens"),
        F.floor(F.col("turn") / template.turns_per_block).alias("block"),
    )
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), role=True), F.lit(MIDDLE))
    rows = rows.withColumn("piece", F.concat(head, "content", F.lit(CLOSE + "\n")))
    # Inside a block, a running sum of lengths gives each content's place.
    order = [F.asc_nulls_first("turn"), F.col("role"), F.col("content")]
    ahead = Window.partitionBy("conv_id", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(ahead), F.lit(0)))
    start = F.col("at") + F.length(head)
    loss = F.when(
        F.col("role") == template.trained_role,
        F.struct(start.alias("start"), (start + F.length("content")).alias("end")),
    )
    one = F.struct("at", "turn", "role", "content", "piece", "kept", loss.alias("loss"))
    blocks = rows.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(one)).alias("all"), F.sum("tokens").alias("tokens"),
        F.count(F.lit(1)).alias("n_turns"), F.sum(F.length("piece")).alias("chars"),
    )
    blocks = blocks.select(
        "conv_id", "block", "n_turns", "chars", "tokens",
        F.array_join(F.col("all.piece"), "").alias("piece"),
        F.filter(F.col("all.loss"), lambda s: s.isNotNull()).alias("loss"),
        F.flatten(F.transform("all", lambda r: F.transform(r["kept"], lambda k: F.struct(
            r["turn"].alias("turn"), k["number"].alias("number"), k["type"].alias("type"), k["ref"].alias("ref"), k["tokens"].alias("tokens"),
        )))).alias("kept"),
    )
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("at", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    moved = F.transform("loss", lambda s: F.struct((s["start"] + F.col("at")).alias("start"), (s["end"] + F.col("at")).alias("end")))
    blocks = blocks.withColumn("loss", moved)
    # Blocks are never empty, so their places tell them apart and put them in order.
    whole = blocks.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece", "loss", "kept"))).alias("all"),
        F.sum("n_turns").alias("n_turns"), F.sum("tokens").alias("expanded_tokens"),
    )
    return whole.select(
        F.col("conv_id").alias("conversation"), "n_turns", F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.flatten(F.col("all.loss")).alias("loss_spans"), F.flatten(F.col("all.kept")).alias("attachments"), "expanded_tokens",
    )


def read_back(whole: str = "formatted") -> Column:
    """The turns of a formatted text as (role, text), unescaped."""
    pieces = F.slice(F.split(F.col(whole), CLOSE + "\n"), 1, F.size(F.split(F.col(whole), CLOSE + "\n")) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, MIDDLE, 1)
        text = F.substring(piece, F.length(role) + len(MIDDLE) + 1, F.length(piece))
        return F.struct(
            unescaped(F.substring(role, len(OPEN) + 1, F.length(role))).alias("role"), unescaped(text).alias("text")
        )

    return F.transform(pieces, turn)


def loss_text(whole: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped."""
    cut = F.transform(
        spans, lambda s: unescaped(F.substring(F.col(whole), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    return F.array_join(cut, "")


def digest(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, read back from the output: numbers and digests of turns and loss."""
    out = formatted(turns, template)
    out = out.withColumn("turns", read_back()).withColumn("loss", loss_text())
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        F.col("conversation").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def probe(turns: DataFrame) -> DataFrame:
    """The given turns and a conversation -7 whose texts look like the template."""
    rows = [(-7, i, r, r"\### Assistant: </turn> ok") for i, r in enumerate(("user", "assistant"))]
    own = turns.sparkSession.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(own)


#: The same result in DuckDB, from the turns themselves.
DIGEST_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), shown AS (
  SELECT *, replace(replace(replace(replace(text, chr(9243), chr(9243) || 'e'), '</turn>', chr(9243) || 't'),
            '###', chr(9243) || 'h'), '<|', chr(9243) || 'p') AS content,
         replace(replace(replace(replace(replace(role, chr(9243), chr(9243) || 'e'), '</turn>', chr(9243) || 't'),
            '###', chr(9243) || 'h'), '<|', chr(9243) || 'p'), ': ', chr(9243) || 'c') AS head FROM rows
), joined AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, content) AS turns,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, content), '') AS loss,
         sum(length('### ' || head || ': ' || content || '</turn>' || chr(10)))::BIGINT AS formatted_chars
  FROM shown GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM joined
"""
