"""Conversation memory and the context text of a question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.ranking import last_n
from sedimenta.sources import fixed_values as fv


def memory(turns: DataFrame, n: int = fv.MEMORY_TURNS) -> DataFrame:
    """`(conv_id, memoria)`: the last `n` turns in order, one per line. Each list holds at most `n` turns."""
    lines = last_n(turns, ["conv_id"], "turn", n).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("line")))).alias("_lines")
    )
    return lines.select("conv_id", F.array_join(F.transform("_lines", lambda x: x["line"]), "\n").alias("memoria"))


def context_text(ranked: DataFrame, texts: DataFrame, query_id: str = "query_id", item: str = "chunk_id") -> DataFrame:
    """`(query_id, contexto)`: texts of the ranked items, best first, under the context mark.

    `ranked` has at most k rows per query, `(query_id, item, rn)`.
    """
    found = texts.select(item, "texto").join(ranked.select(query_id, item, "rn"), item, "inner")
    lists = found.groupBy(query_id).agg(F.array_sort(F.collect_list(F.struct("rn", "texto"))).alias("_texts"))
    body = F.array_join(F.transform("_texts", lambda x: x["texto"]), "\n")
    return lists.select(query_id, F.concat_ws("\n", F.lit(fv.CONTEXT_MARK), body).alias("contexto"))


def prompts(questions: DataFrame, contexts: DataFrame, memories: DataFrame, query_id: str = "query_id") -> DataFrame:
    """`(conv_id, prompt)` for `questions(conv_id, query_id)`: context, then memory.

    No retrieved text and no memory each leave their part empty; the question is still answered.
    """
    context = F.coalesce("contexto", F.lit(fv.CONTEXT_MARK))
    return (
        questions.join(contexts, query_id, "left")
        .join(memories, "conv_id", "left")
        .select("conv_id", F.concat_ws("\n", context, F.coalesce("memoria", F.lit(""))).alias("prompt"))
    )
