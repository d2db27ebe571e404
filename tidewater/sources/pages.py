"""Records from stored web pages, by SQL regular expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markup of a product card.
CARD = r"(?s)<article[^>]*class=\"[^\"]*product_pod[^\"]*\".*?</article>"
TITLE = r"(?s)<h3>\s*<a[^>]*title=\"([^\"]*)\""
PRICE = r"(?s)class=\"[^\"]*price_color[^\"]*\"[^>]*>\s*([^<]*)<"
RATING = r"class=\"star-rating ([^\"]*)\""
AVAILABILITY = r"(?s)class=\"[^\"]*availability[^\"]*\"[^>]*>(?:\s*<i[^>]*>\s*</i>)?\s*([^<]*)<"


def _found(text: Column, pattern: str) -> Column:
    hit = F.regexp_replace(F.regexp_extract(text, pattern, 1), r"^\s+|\s+$", "")
    return F.when(text.rlike(pattern), hit)


def price_number(text: Column) -> Column:
    """Price text without currency sign and thousands commas, as a number."""
    return F.trim(F.translate(text, "£,", "")).try_cast("double")


def extract_products(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """One row per product card; cards without a title or price are skipped."""
    cards = pages.select(F.col(url).alias("url"), F.explode(F.regexp_extract_all(html, F.lit(CARD), F.lit(0))).alias("card"))
    card = F.col("card")
    return cards.select(
        _found(card, TITLE).alias("title"),
        price_number(_found(card, PRICE)).alias("price_gbp"),
        F.coalesce(_found(card, RATING), F.lit("")).alias("rating"),
        F.coalesce(_found(card, AVAILABILITY), F.lit("")).alias("availability"),
        "url",
    ).where(F.col("title").isNotNull() & F.col("price_gbp").isNotNull())


def page_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, first heading, language and link count of each page."""
    text = F.col(html)
    return pages.select(
        "page_id",
        "url",
        F.regexp_extract(text, r"<html lang=\"([a-zA-Z-]*)\"", 1).alias("lang"),
        F.regexp_extract(text, r"(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract(text, r"(?s)<h1>(.*?)</h1>", 1).alias("heading"),
        F.regexp_count(text, F.lit("<a href=")).cast("long").alias("links"),
    ).where(F.col("title") != "")
