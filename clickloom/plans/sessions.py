"""Per-user session summary with product names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.rendering import text_parts
from clickloom.session import cut_lineage

# Address parts of checkout-like pages.
CHECKOUT_WORDS = ("/shopCart", "/cart", "/pay")


def session_summary(views: DataFrame, user: str, url: str, product: Column, names: DataFrame,
                    product_col: str = "product", name_col: str = "name",
                    words: Sequence[str] = CHECKOUT_WORDS, min_hits: int = 2, **options) -> DataFrame:
    """(user, hits, weight, part, products) of users with ``min_hits`` hits or more.

    ``weight`` counts checkout-like words over the user's addresses;
    ``products`` lists the distinct products that have a name.
    """
    weight = sum((F.col(url).contains(w).cast("int") for w in words), F.lit(0))
    # Stored: the totals and the product lists both read it.
    marked = cut_lineage(
        views.where(F.col(user).isNotNull()).select(user, weight.alias("w"), product.alias("__product"))
    )
    totals = marked.groupBy(user).agg(F.count("*").alias("hits"), F.sum("w").alias("weight")).where(
        F.col("hits") >= min_hits
    )
    seen = marked.where(F.col("__product").isNotNull()).select(user, "__product").distinct()
    named = seen.join(
        names.select(F.col(product_col).alias("__product"), F.col(name_col).alias("__name")), ["__product"], "inner"
    )
    text = F.concat_ws("|", F.col("__product").cast("string"), "__name")
    lists = text_parts(named, [user], text, ";", out="products", **options)
    # A user has one part, or few, so the users' side is the larger one.
    return totals.join(lists, [user], "left").select(
        user, "hits", "weight", F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("products", F.lit("")).alias("products"),
    )
