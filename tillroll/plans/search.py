"""Searchable products, customer context, similarity top-k."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import search_text
from tillroll.operators import vector_index
from tillroll.operators.similarity import vector_topk
from tillroll.operators.text_index import build_text_index
from tillroll.operators.text_index import search as search_index
from tillroll.operators.upsert import apply_changes, one_per_key, snapshot_diff


def customer_context(c360: DataFrame, interest: DataFrame, max_rank: int = 3) -> DataFrame:
    """Customer ⟕ interest ON key AND rank ≤ max_rank: the rank predicate is
    part of the join condition, so customers without interests stay."""
    c = c360.select("customer_id", "preferred_categories", "loyalty_tier").alias("c")
    i = interest.select("customer_id", "category", "interest_score", "interest_rank").alias("i")
    j = c.join(i, (F.col("c.customer_id") == F.col("i.customer_id")) & (F.col("i.interest_rank") <= max_rank),
               "left")
    return j.select("c.customer_id", "c.preferred_categories", "c.loyalty_tier",
                    "i.category", "i.interest_score")


SEARCHABLE_COLUMNS = ["product_id", "product_name", "category", "subcategory", "brand", "color",
                      "material", "price", "rating", "description", "tags"]


def products_searchable(products: DataFrame) -> DataFrame:
    """Product columns plus ``search_text`` (NULL if any part is NULL)."""
    return products.select(*SEARCHABLE_COLUMNS, search_text().alias("search_text"))


def searchable_version(stored: DataFrame | None, products: DataFrame,
                       keep: Callable[[DataFrame], DataFrame] = lambda feed: feed) -> tuple[DataFrame, DataFrame]:
    """(next version, change feed) of the searchable table.

    The feed is keyed on product_id (insert, update, delete against the stored
    version, all inserts without one); an index that applies it to its own copy
    reaches the next version, which is built the same way here.  ``keep`` may
    write the feed down, so that the next version is built from what was written."""
    new = one_per_key(products_searchable(products), ["product_id"])
    if stored is None:
        changes = keep(new.select("product_id", F.lit("insert").alias("change"), *[c for c in new.columns if c != "product_id"]))
        return changes.select(*new.columns), changes
    changes = keep(snapshot_diff(stored, new, ["product_id"]))
    return apply_changes(stored, changes, ["product_id"]), changes


def product_text_search(queries: DataFrame, searchable: DataFrame, k: int = 5,
                        filters: dict | None = None) -> DataFrame:
    """Top-k products per query text: (query_id, rank, score, product columns).
    ``queries`` has (query_id, text); ``filters`` = {column: value or list}.

    The products (those that pass the filters) are indexed first; see
    ``operators.text_index``.  ``operators.similarity.text_topk`` gives the same
    rows by scoring every pair."""
    docs = searchable
    for col, val in (filters or {}).items():
        docs = docs.where(F.col(col).isin(*val) if isinstance(val, (list, tuple, set)) else F.col(col) == val)
    hits = search_index(queries, build_text_index(docs, "product_id", "search_text"), k)
    return (hits.join(searchable.withColumnRenamed("product_id", "doc_id").hint("merge"), "doc_id")     # products grow: not through the driver
            .withColumnRenamed("doc_id", "product_id"))


def similar_vectors(queries: DataFrame, vectors: DataFrame, k: int = 5, filters: dict | None = None,
                    same: list[str] = (), index: vector_index.VectorIndex | None = None) -> DataFrame:
    """Top-k vectors per query vector with the neighbour's metadata: exact over
    every pair, or from an ``index`` of the (filtered) vectors."""
    if index is None:
        hits = vector_topk(queries, vectors, k, filters=filters, same=same)
    elif filters:
        raise ValueError("index the filtered vectors")
    else:
        hits = vector_index.search(queries, index, k, same=same)
    meta = vectors.select(F.col("vec_id").alias("doc_id"), "label")
    return hits.join(meta, "doc_id").select(
        F.col("query_id"), F.col("rank"), F.col("doc_id").alias("vec_id"), "label", "score")
