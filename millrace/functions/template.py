"""Chat template as a column: rendering, and the spans that the assistant's loss covers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import strip

#: The template's marks.
START, END, BOS = "<start_of_turn>", "<end_of_turn>\n", "<bos>"


def _turns(messages: Column) -> Column:
    """array<struct<head, body, learned>>, a leading system turn folded into the turn after it.

    The system text goes before the next turn's content under the role user; if that turn is the
    assistant's, the system text is lost.
    """
    folded = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
    system = F.concat(strip(F.get(messages, F.lit(0))["content"]), F.lit("\n\n"))
    rest = F.when(folded, F.slice(messages, 2, F.greatest(F.size(messages), F.lit(1)))).otherwise(messages)

    def turn(m: Column, i: Column) -> Column:
        learned = m["role"] == "assistant"
        takes = folded & (i == 0) & ~learned
        role = F.when(learned, "model").when(takes, "user").otherwise(m["role"])
        body = F.concat(F.when(takes, system).otherwise(F.lit("")), strip(m["content"]), F.lit(END))
        return F.struct(F.concat(F.lit(START), role, F.lit("\n")).alias("head"), body.alias("body"), learned.alias("learned"))

    return F.transform(rest, turn)


def rendered(messages: Column, bos: str = BOS, generation_prompt: bool = False) -> Column:
    text = F.array_join(F.transform(_turns(messages), lambda t: F.concat(t["head"], t["body"])), "")
    return F.concat(F.lit(bos), text, F.lit(f"{START}model\n" if generation_prompt else ""))


def assistant_spans(messages: Column) -> Column:
    """The texts that the loss covers: each assistant content with its end mark."""
    return F.transform(F.filter(_turns(messages), lambda t: t["learned"]), lambda t: t["body"])
