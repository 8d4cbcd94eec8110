"""String helpers: masking, URLs, JSON arrays, search text, product lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def mask_card(last4: str | Column) -> Column:
    return F.concat(F.lit("****-****-****-"), F.right(_c(last4), F.lit(4)))


def json_array(*cols) -> Column:
    """JSON text of an array of strings, e.g. ``["a","b"]``."""
    return F.to_json(F.array(*[_c(c) for c in cols]))


def parse_json_array(col: str | Column) -> Column:
    return F.from_json(_c(col), "array<string>")


def slug(col: str | Column) -> Column:
    return F.replace(F.lower(_c(col)), F.lit(" "), F.lit("_"))


def product_url(category: str | Column, product_id: str | Column) -> Column:
    return F.concat(F.lit("/products/"), F.lower(_c(category)), F.lit("/"),
                    F.lower(_c(product_id).cast("string")))


def search_url(term: str | Column) -> Column:
    return F.concat(F.lit("/search?q="), F.replace(_c(term), F.lit(" "), F.lit("+")))


def search_text(name="product_name", category="category", subcategory="subcategory",
                material="material", description="description") -> Column:
    """CONCAT of the searchable fields; NULL if any part is NULL."""
    return F.concat(_c(name), F.lit(". "), _c(category), F.lit(" - "), _c(subcategory),
                    F.lit(". "), F.lit("Made of "), _c(material), F.lit(". "), _c(description))


def product_line(name="product_name", subcategory="subcategory", brand="brand",
                 color="color", material="material", price="price", rating="rating") -> Column:
    """``- name (sub) by brand in color material - $9.99, Rating: 4.5/5``."""
    return F.format_string("- %s (%s) by %s in %s %s - $%.2f, Rating: %s/5",
                           _c(name), _c(subcategory), _c(brand), _c(color), _c(material),
                           _c(price).cast("decimal(20,2)").cast("double"), _c(rating).cast("string"))
