"""Style-assistant batch job: one system prompt per conversation.

conversation → last user message → product text search (k = 6) → product
lines → prompt.  The model call itself is outside this library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.config import ASSISTANT_PROMPT, ASSISTANT_RESULTS, NO_PRODUCTS_TEXT
from tillroll.functions.text import product_line
from tillroll.plans.search import product_text_search


def last_user_message(conversations: DataFrame) -> DataFrame:
    """(conv_id, user_message): text of the highest-turn user message, ''
    when a conversation has none.  One aggregation; max_by skips rows whose
    ordering value is NULL (non-user turns)."""
    is_user = F.col("role") == "user"
    return conversations.groupBy("conv_id").agg(
        F.coalesce(F.max_by(F.col("text"), F.when(is_user, F.col("turn"))), F.lit(""))
        .alias("user_message"))


def product_context(hits: DataFrame, queries: DataFrame, key: str = "query_id") -> DataFrame:
    """(key, product_context): product lines in rank order joined by newline,
    or the no-match sentence.  Each query has ≤ k lines (bounded list)."""
    lines = hits.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", product_line().alias("line")))),
                                 lambda s: s["line"]), "\n").alias("_ctx"))
    return (queries.select(key).join(lines.hint("merge"), key, "left")
            .select(key, F.coalesce("_ctx", F.lit(NO_PRODUCTS_TEXT)).alias("product_context")))


def render_prompt(context_col: str = "product_context"):
    head, tail = ASSISTANT_PROMPT.split("{product_context}")
    return F.concat(F.lit(head), F.col(context_col), F.lit(tail))


def assistant_prompts(conversations: DataFrame, searchable: DataFrame,
                      k: int = ASSISTANT_RESULTS) -> DataFrame:
    """(conv_id, user_message, product_context, system_prompt) per conversation."""
    msgs = last_user_message(conversations)
    q = msgs.select(F.col("conv_id").alias("query_id"), F.col("user_message").alias("text"))
    hits = product_text_search(q, searchable, k)
    ctx = product_context(hits, q)
    return (msgs.join(ctx.withColumnRenamed("query_id", "conv_id").hint("merge"), "conv_id")
            .withColumn("system_prompt", render_prompt()))
