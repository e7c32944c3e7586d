"""Page ingestion: a breadth-first walk over a table of stored pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.functions.html import (
    canonical_url,
    page_links,
    page_title,
    resolve_url,
    unquote_link,
    url_host,
    visible_text,
)
from shelfsense.operators.relational import first_per_key
from shelfsense.session import cut_lineage


@dataclass(frozen=True)
class Crawl:
    pages: DataFrame  # metadata struct<url, title, depth, domain>, content
    errors: DataFrame  # url, error


def snapshot(pages: DataFrame) -> DataFrame:
    """One stored page per canonical URL, the one with the smallest id: (url, html, status)."""
    status = F.col("status") if "status" in pages.columns else F.lit(200)
    canonical = pages.select("page_id", canonical_url(F.col("url")).alias("url"), "html", status.alias("status"))
    return first_per_key(canonical, ["url"], [F.col("page_id").asc()]).drop("page_id")


def duplicate_pages(pages: DataFrame) -> DataFrame:
    """Pages per distinct visible text: text hash, the first page id, number of copies."""
    return (
        pages.select("page_id", F.md5(visible_text(F.col("html"))).alias("text_hash"))
        .groupBy("text_hash")
        .agg(F.min("page_id").alias("page_id"), F.count("*").alias("copies"))
    )


def out_links(pages: DataFrame) -> DataFrame:
    """Links of pages (url, html, …) as absolute canonical URLs with their position on the page."""
    others = [name for name in pages.columns if name != "html"]
    raw = pages.select(*others, F.posexplode(page_links(F.col("html"))).alias("link_position", "href"))
    return raw.select(
        *others, "link_position", resolve_url(F.col("url"), unquote_link(F.col("href"))).alias("link")
    )


def crawl(pages: DataFrame, seeds: DataFrame, max_depth: int = 2, max_pages: int | None = 15) -> Crawl:
    """Walk the stored pages from the seeds (position, url), level by level.

    The place of a URL in the walk is the path of positions that led to it; within a level,
    comparing paths gives the order in which a queue would visit. A URL counts once, where it
    comes first. A page whose text an earlier page had is dropped together with its links. A URL
    without a stored page, or with a status other than 200, is an error. `max_pages` ends the
    walk in that order; None walks everything within `max_depth`.
    """
    stored = snapshot(pages)
    frontier = (
        seeds.filter(F.trim("url") != "")
        .select(canonical_url(F.col("url")).alias("url"), F.array(F.col("position").cast("long")).alias("path"))
    )
    visited = kept = errors = None
    remaining = max_pages
    for depth in range(max_depth + 1):
        if remaining is not None and remaining <= 0:
            break
        level = frontier.groupBy("url").agg(F.min("path").alias("path"))
        if visited is not None:
            level = level.join(visited, "url", "left_anti")
        level = cut_lineage(level)
        if level.isEmpty():
            break
        found = level.join(stored, "url", "left")
        broken = found.filter(F.coalesce("status", F.lit(0)) != 200).select(
            "url",
            F.when(F.col("status").isNull(), "not in snapshot").otherwise(F.concat(F.lit("HTTP "), "status")).alias("error"),
            "path",
        )
        texts = found.filter(F.col("status") == 200).withColumn("content", visible_text(F.col("html")))
        texts = texts.withColumn("text_hash", F.md5("content"))
        if kept is not None:
            texts = texts.join(kept.select("text_hash"), "text_hash", "left_anti")
        accepted = first_per_key(texts, ["text_hash"], [F.col("path").asc()])
        if remaining is not None:
            accepted = accepted.orderBy("path").limit(remaining)
        accepted = cut_lineage(accepted.withColumn("depth", F.lit(depth)))
        if remaining is not None:
            taken = accepted.agg(F.count("*").alias("n"), F.max("path").alias("last")).first()
            remaining -= taken["n"]
            if remaining <= 0:
                last = accepted.agg(F.max("path")).scalar()
                broken = broken.filter(F.col("path") < last)
        broken = cut_lineage(broken.select("url", "error"))
        visited = level.select("url") if visited is None else visited.unionByName(level.select("url"))
        kept = accepted if kept is None else kept.unionByName(accepted)
        errors = broken if errors is None else errors.unionByName(broken)
        steps = out_links(accepted.select("url", "path", "html"))
        frontier = steps.filter(F.col("link").startswith("http")).select(
            F.col("link").alias("url"), F.array_append("path", F.col("link_position").cast("long")).alias("path")
        )
    if kept is None:
        kept = stored.select("url", F.array().cast("array<bigint>").alias("path"), "html").limit(0).withColumns(
            {"content": F.lit(""), "depth": F.lit(0)}
        )
        errors = stored.select("url", F.lit("").alias("error")).limit(0)
    documents = kept.select(
        F.struct(
            "url",
            page_title(F.col("html"), F.col("url")).alias("title"),
            "depth",
            url_host(F.col("url")).alias("domain"),
        ).alias("metadata"),
        "content",
    )
    return Crawl(documents, errors)


def crawl_summary(result: Crawl) -> DataFrame:
    """Title, URL, depth, domain and text length of every page taken in."""
    return result.pages.select("metadata.*", F.length("content").alias("content_length"))


def as_reviews(result: Crawl) -> DataFrame:
    """Pages in the review layout: the URL is the product, its domain the category.

    Every page has a customer of its own, so it joins no other product in the review graph.

    The rating is null, not 0, so that pages do not pull mean ratings down.
    """
    url = F.col("metadata.url")
    return result.pages.select(
        url.alias("product_id"),
        F.concat(F.lit("crawl:"), url).alias("customer_id"),
        F.col("metadata.title").alias("product_title"),
        F.col("content").alias("review_body"),
        F.lit(None).cast("double").alias("star_rating"),
        F.col("metadata.domain").alias("product_category"),
    )


def add_pages(reviews: DataFrame, result: Crawl) -> DataFrame:
    """Reviews and taken-in pages as one collection with string ids."""
    typed = reviews.withColumns(
        {name: F.col(name).cast("string") for name in ("product_id", "customer_id")}
    )
    return typed.unionByName(as_reviews(result), allowMissingColumns=True)
