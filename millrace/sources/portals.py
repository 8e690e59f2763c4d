"""Portals over landed pages: listings, and one row that states how the run went.

Nothing is fetched here. Search pages are a table of (url, page, status, html), detail pages one of (url, status, html). A
search counts up to its first page that failed or shows no card: what lies behind it may not follow on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import cut
from ..schema import conform
from . import html_cards, records

c = F.col

# Cards on a full page of the marketplace, answers that say a page is gone, and limits of a run.
FULL_PAGE = 48
GONE = (404, 410)
MAX_ITEMS, MAX_DETAILS = 10_000, 120
ORDER = ("url", "page", "seq")


@dataclass(frozen=True)
class Run:
    """``statement``: (source, method, records, errors, status, notes). Listings are written once, as the statement reads them too."""

    listings: DataFrame
    statement: DataFrame


def statement(source: str, method: str, listings: DataFrame, notes: DataFrame, whole: Column | bool) -> DataFrame:
    """One row. ``notes``: (error boolean, text); ``whole``: could the run be complete at all?"""
    both = listings.select(F.lit(1).alias("record"), F.lit(False).alias("error"), F.lit(None).cast("string").alias("text")).union(notes.select(F.lit(0), "error", "text"))
    counted = both.agg(F.coalesce(F.sum("record"), F.lit(0)).alias("records"), F.count(F.when(c("error"), 1)).alias("errors"), F.array_sort(F.collect_set("text")).alias("notes"))
    status = F.when(c("records") == 0, "FAILED").when((whole if isinstance(whole, Column) else F.lit(whole)) & (c("errors") == 0), "SUCCESS").otherwise("PARTIAL")
    return counted.select(F.lit(source).alias("source"), F.lit(method).alias("method"), "records", "errors", status.alias("status"), "notes")


def cards(pages: DataFrame, kind: str, full: int | None = None) -> tuple[DataFrame, DataFrame]:
    """((url, page, seq, json), notes): cards of each search up to where it ends; a page of under ``full`` cards is its last."""
    read = cut(html_cards.records(pages.withColumn("html", F.when(c("status") == 200, c("html"))), "html", kind, "url", "page"))
    seen = pages.select("url", "page", "status").join(read.groupBy("url", "page").agg(F.count("*").alias("n")), ["url", "page"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    failed = c("status") != 200
    ends = F.when(failed | (c("n") == 0), c("page")).when(c("n") < (full or 0), c("page") + 1)
    said = F.concat(F.lit("page "), c("page").cast("string"), F.when(failed, F.concat(F.lit(": status "), c("status").cast("string"))).when(c("n") == 0, F.lit(": no cards")))
    last = seen.where(ends.isNotNull()).groupBy("url").agg(F.min(F.struct(ends.alias("end"), failed.alias("error"), F.concat("url", F.lit(" "), said).alias("text"))).alias("last"))
    kept = read.join(last.select("url", "last.end"), "url", "left").where(c("end").isNull() | (c("page") < c("end"))).drop("end")
    return kept, last.select("last.error", "last.text").where("text IS NOT NULL")


def _first(found: DataFrame, most: int) -> DataFrame:
    return found.orderBy(*ORDER).limit(most)


def _left_out(rows: DataFrame, most: int, what: str) -> tuple[DataFrame, Column]:
    """A note of how many rows a limit leaves out, if any, and whether there are none."""
    n = rows.count()
    notes = [(False, f"{n - most} {what} left out by the limit of {most}")] if n > most else []
    return rows.sparkSession.createDataFrame(notes, "error boolean, text string"), F.lit(not notes)


def portal(source: str, pages: DataFrame, scraped_at: str, base_url: str = "", max_items: int = MAX_ITEMS) -> Run:
    """Search pages alone: never more than a part, as their cards lack what detail pages say."""
    found, notes = cards(pages, "portal")
    listings = cut(records.map_record(_first(found, max_items), "json", F.lit(source), F.lit(scraped_at), base_url))
    cut_off, _ = _left_out(found, max_items, "cards")
    return Run(listings, statement(source, "search pages", listings, notes.union(cut_off), False))


def collected(source: str, items: DataFrame, scraped_at: str, base_url: str = "", succeeded: bool = True) -> Run:
    """Items (json) of a remote collector's run; whole if it ended well."""
    listings = cut(records.map_record(items, "json", F.lit(source), F.lit(scraped_at), base_url))
    notes = items.sparkSession.createDataFrame([] if succeeded else [(True, "the collector's run didn't succeed")], "error boolean, text string")
    return Run(listings, statement(source, "collector", listings, notes, True))


def market(source: str, pages: DataFrame, details: DataFrame | None, scraped_at: str, ceiling: float, rate: float, max_items: int = MAX_ITEMS, max_details: int = MAX_DETAILS) -> Run:
    """Search pages, with detail pages for what could pass the budget: a price of up to ``ceiling`` dollars, or none.

    Other detail pages are never parsed. The first ``max_details`` in order that were answered count; pages that are gone
    make their listing inactive and count for nothing. Of several landed pages with one address, an answered one counts, and of
    those the least text. A run that leaves cards out is a part, and its notes say how many cards and detail pages a limit cut.
    """
    found, notes = cards(pages, "market", FULL_PAGE)
    cut_off, all_cards = _left_out(found, max_items, "cards")
    notes = notes.union(cut_off)
    mapped = cut(records.map_record(_first(found, max_items), "json", F.lit(source), F.lit(scraped_at)).drop("json"))
    if details is None:
        return Run(mapped, statement(source, "search pages", mapped, notes, all_cards))
    price = F.when(c("rent_currency") == "USD", c("rent_original")).otherwise(c("rent_original") / rate)
    wanted = mapped.where(price.isNull() | (price <= ceiling)).groupBy("source_url").agg(F.min(F.struct(*ORDER)).alias("place"))
    best = details.groupBy("url").agg(F.min(F.struct((c("status") != 200).alias("failed"), "status", "html")).alias("d"))
    once = best.select(c("url").alias("source_url"), "d.status", "d.html").join(wanted, "source_url")
    there = cut(once.where("status = 200"))
    answered = there.orderBy("place").limit(max_details)
    notes = notes.union(_left_out(there, max_details, "detail pages")[0])
    said = html_cards.records(answered.select(c("source_url").alias("url"), "html"), "html", "detail", "url").select("url", "json")
    gone = once.where(c("status").isin(*GONE)).select("source_url", F.lit('{"inactive": true}'))
    listings = html_cards.with_details(conform(mapped), said.union(gone))
    return Run(listings, statement(source, "search and detail pages", listings, notes, all_cards))
