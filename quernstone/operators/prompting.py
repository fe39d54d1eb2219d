"""Prompts and chat messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.functions import text as tx
from quernstone.operators.joins import placed_by

TEMPLATE = """Answer the question from the passages below and point to what you relied on.
If the passages do not hold the answer, reply that you do not know.

Passages:
{context}

Question: {question}

Answer:"""
SEPARATOR = "\n\n"


def source_documents(hits: DataFrame) -> DataFrame:
    """``qid, source_documents``: the ranked hits of each question (k per question) as one list."""
    return placed_by(hits, "qid").groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct("rank", "id", "page_content"))).alias(
            "source_documents"
        )
    )


def stuffed(documents: Column, sep: str = SEPARATOR, max_chars: int | None = None) -> Column:
    """All documents joined; with ``max_chars`` only the leading documents that fit whole."""
    texts = F.transform(documents, lambda d: F.coalesce(d["page_content"], F.lit("")))
    if max_chars is None:
        return F.array_join(texts, sep)

    def leading(held: Column) -> Column:
        used = F.transform(
            held, lambda _, i: F.char_length(F.array_join(F.slice(held, 1, i + 1), sep))
        )
        fit = F.size(F.filter(used, lambda n: n <= max_chars))
        return F.array_join(F.slice(held, 1, fit), sep)

    return tx.bind(texts, leading)


def stuff_prompt(
    retrieved: DataFrame,
    template: str = TEMPLATE,
    sep: str = SEPARATOR,
    max_chars: int | None = None,
) -> DataFrame:
    """Add ``context`` and the filled ``prompt``.

    The template is cut at its slots first, so a slot name inside a document or a question is
    left alone.
    """
    parts = []
    for n, piece in enumerate(template.split("{context}")):
        if n:
            parts.append(F.col("context"))
        for m, text in enumerate(piece.split("{question}")):
            if m:
                parts.append(F.coalesce("questions", F.lit("")))
            parts.append(F.lit(text))
    return retrieved.withColumn(
        "context",
        F.coalesce(stuffed(F.col("source_documents"), sep, max_chars), F.lit("")),
    ).withColumn("prompt", F.concat(*parts))


def to_messages(df: DataFrame, prompt_col: str = "prompt", role: str = "user") -> DataFrame:
    """Replace the prompt by a one-message chat request."""
    message = F.struct(F.lit(role).alias("role"), F.col(prompt_col).alias("content"))
    return df.withColumn("messages", F.array(message)).drop(prompt_col)


def earlier_turns(conversations: DataFrame, most: int = 8) -> DataFrame:
    """``conv_id, turn, system, history``: for every turn the first system text and the ``most`` turns
    before it that are no system turns, oldest first.

    A window over the turns of one conversation holds no more than ``most`` of them.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    said = F.struct(F.col("role"), F.col("text").alias("content"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-most, -1)
    talk = turns.where("role <> 'system' or role is null")
    talk = talk.withColumn("history", F.collect_list(said).over(before))
    first = turns.where("role = 'system'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("system"))
    return talk.join(first, "conv_id", "left").select("conv_id", "turn", "system", "history")


def chat_request(
    df: DataFrame,
    prompt_col: str = "prompt",
    system: Column | str | None = None,
    history: Column | None = None,
    **parameters: float | int | str,
) -> DataFrame:
    """Replace the prompt by a ``request``: ``messages`` and the model's ``parameters``.

    The messages are the system turn (``system``: a column or one text for all; none where null), the
    turns of ``history`` (role, content) and the prompt as the user's.
    """
    message = "array<struct<role:string,content:string>>"

    def turn(role: str, content: Column) -> Column:
        return F.array(F.struct(F.lit(role).alias("role"), content.alias("content"))).cast(message)

    none = F.array().cast(message)
    system = F.lit(system) if isinstance(system, str) else system
    first = none if system is None else F.when(system.isNotNull(), turn("system", system)).otherwise(none)
    past = none if history is None else F.coalesce(history.cast(message), none)
    messages = F.concat(first, past, turn("user", F.coalesce(F.col(prompt_col), F.lit(""))))
    fields = [messages.alias("messages"), *(F.lit(v).alias(k) for k, v in parameters.items())]
    return df.withColumn("request", F.struct(*fields)).drop(prompt_col)


def render_chat(
    conversations: DataFrame,
    add_generation_prompt: bool = True,
    turn_start: str = "<|{role}|>\n",
    turn_end: str = "<|end|>\n",
    turns_per_part: int | None = None,
) -> DataFrame:
    """``conv_id, part, n_turns, rendered``: conversations as model input, turns in order.

    Each conversation is one model input in one row. With ``turns_per_part`` a conversation of more
    turn numbers comes in several parts, whose texts follow one another; so no task holds more turns
    of one conversation than that. The generation prompt closes the last part.
    """
    before, after = turn_start.split("{role}")
    turn = F.concat(F.lit(before), "role", F.lit(after), F.coalesce("text", F.lit("")), F.lit(turn_end))
    part = F.floor(F.col("turn") / turns_per_part) if turns_per_part else F.lit(0).cast("long")
    parts = (
        conversations.select("conv_id", "turn", part.alias("part"), turn.alias("shown"))
        .groupBy("conv_id", "part")
        .agg(
            F.count("*").alias("n_turns"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("turn", "shown"))), lambda t: t["shown"]
                ),
                "",
            ).alias("rendered"),
        )
    )
    if not add_generation_prompt:
        return parts
    last = conversations.groupBy("conv_id").agg(F.max(part).alias("part")).withColumn("open", F.lit(True))
    suffix = F.when(F.col("open"), F.lit(f"{before}assistant{after}")).otherwise(F.lit(""))
    return parts.join(last, ["conv_id", "part"], "left").select(
        "conv_id", "part", "n_turns", F.concat("rendered", suffix).alias("rendered")
    )
