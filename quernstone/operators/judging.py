"""A model as judge: grading prompts from graded examples, and reading back the grades."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.operators.answering import answer_with
from quernstone.operators.prompting import stuffed

GRADES = (1, 5)


@dataclass(frozen=True)
class GradedExample:
    input: str
    output: str
    score: int
    justification: str
    grading_context: Mapping[str, str] = field(default_factory=dict)


# The two graded answers the default judge prompt shows.
EXAMPLES = (
    GradedExample(
        "How do I turn on the night lamp?",
        "Press the round switch. The lamp is also waterproof.",
        2,
        "Only the first statement stands in the context.",
        {"context": "The night lamp has a round switch. Press it to turn the lamp on."},
    ),
    GradedExample(
        "How do I turn on the night lamp?",
        "Press the round switch.",
        5,
        "The statement stands in the context.",
        {"context": "The night lamp has a round switch. Press it to turn the lamp on."},
    ),
)

RULES = {
    "faithfulness": "Grade how far every statement of the output is backed by the context.",
    "relevance": "Grade how well the output answers the input, given the context.",
}


def render_examples(examples: Sequence[GradedExample]) -> str:
    shown = []
    for e in examples:
        lines = [f"Input: {e.input}", f"Output: {e.output}"]
        lines += [f"{name}: {value}" for name, value in e.grading_context.items()]
        lines += [f"Score: {e.score}", f"Justification: {e.justification}"]
        shown.append("\n".join(lines))
    return "\n\n".join(shown)


def judge_prompt(
    rows: DataFrame,
    metric: str = "faithfulness",
    examples: Sequence[GradedExample] = EXAMPLES,
    documents: str | None = "source_documents",
) -> DataFrame:
    """Add ``judge_prompt``: the rule, the graded examples and the row to grade."""
    low, high = GRADES
    head = (
        f"{RULES[metric]} Scores run from {low} (worst) to {high} (best).\n"
        'Reply with JSON: {"score": <integer>, "justification": "<text>"}.\n\n'
        f"{render_examples(examples)}\n\n"
    )

    def shown(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    parts = [
        F.lit(head + "Input: "),
        shown(F.col("questions")),
        F.lit("\nOutput: "),
        shown(F.col("result")),
    ]
    if documents:
        parts += [F.lit("\ncontext: "), shown(stuffed(F.col(documents)))]
    return rows.withColumn("judge_prompt", F.concat(*parts))


def parse_judgement(df: DataFrame, json_col: str) -> DataFrame:
    """Add ``score, justification, valid``; a score outside the grades or unreadable is null."""
    read = F.from_json(json_col, "score int, justification string")
    low, high = GRADES
    return (
        df.withColumn("_read", read)
        .withColumns(
            {
                "score": F.when(F.col("_read.score").between(low, high), F.col("_read.score")),
                "justification": F.col("_read.justification"),
            }
        )
        .withColumn("valid", F.col("score").isNotNull())
        .drop("_read")
    )


def judge(
    rows: DataFrame,
    predict: Callable[[list[str], Mapping], Sequence[str]],
    metric: str = "faithfulness",
    examples: Sequence[GradedExample] = EXAMPLES,
    params: Mapping | None = None,
) -> DataFrame:
    """Let a user's model grade each row: adds ``score, justification, valid, judge_latency,
    judge_error``."""
    asked = judge_prompt(rows, metric, examples).select(
        "qid", F.col("judge_prompt").alias("prompt")
    )
    replies = answer_with(asked, predict, params).select(
        "qid",
        F.col("result").alias("reply"),
        F.col("latency").alias("judge_latency"),
        F.col("error").alias("judge_error"),
    )
    return rows.join(parse_judgement(replies, "reply").drop("reply"), "qid")
