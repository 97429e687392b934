"""Crawled pages and ATS payloads to posting text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import text as T
from rolecall.functions import urls as U
from rolecall.functions.html import page_facets
from rolecall.functions.stage import settled
from rolecall.operators.skew import first_by
from rolecall.session import last_of_repeated_keys


def canonical_pages(pages: DataFrame, url: str = "url") -> DataFrame:
    """Canonical URL, platform label and ATS ids of every row."""
    clean = U.with_canonical_url(pages, url, "canonical_url")
    target = F.col("canonical_url")
    return (
        settled(clean.withColumn("_host", U.host(target)), "_host")
        .withColumn("platform", U.platform(F.col("_host")))
        .drop("_host")
        .withColumn("ats_company", U.ats_company(target))
        .withColumn("ats_job_id", U.ats_job_id(target))
    )


def dedupe_pages(pages: DataFrame, order: list) -> DataFrame:
    """First page per canonical URL, compared without case and trailing slashes."""
    keyed = canonical_pages(pages).withColumn("url_key", U.profile_key(F.col("canonical_url")))
    return first_by(keyed.filter(F.col("url_key") != ""), ["url_key"], order)


#: Bits of the filter of new keys: 16 MB at most, however many keys there are.
KEY_BITS = 1 << 27
_BLOCK_BITS = 1 << 15


def held(stored: DataFrame, rows: DataFrame, on: list[str], how: str = "left", bits: int = KEY_BITS) -> DataFrame:
    """Rows of ``stored`` and ``_held``: true if their hashed key is one of the keys in ``rows``, and for a few others by chance.

    The hashes of the new keys are marked in one bitmap of ``bits`` bits, held in blocks of 4 KB. It is
    broadcast, so no row is shuffled for it. Null is one key. ``how`` inner leaves out most rows that are not held.
    """
    def spot() -> Column:
        return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1

    marks = rows.select(spot().alias("_spot")).groupBy(F.bitmap_bucket_number("_spot").alias("_block"))
    marks = marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_spot")).alias("_marks"))
    place = F.col("_place")
    byte = F.conv(F.hex(F.substring("_marks", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    spots = stored.withColumn("_spot", spot()).withColumn("_place", F.bitmap_bit_position("_spot"))
    met = spots.join(F.broadcast(marks), F.bitmap_bucket_number("_spot") == F.col("_block"), how)
    return met.withColumn("_held", F.coalesce(marked, F.lit(False))).drop("_spot", "_place", "_block", "_marks")


def may_hold(stored: DataFrame, rows: DataFrame, on: list[str], bits: int = KEY_BITS) -> DataFrame:
    """Rows of ``stored`` whose hashed key is one of the keys in ``rows``, and a few others by chance.

    Most of the stored table is left behind where it is read, before any shuffle.
    """
    return held(stored, rows, on, "inner", bits).filter("_held").drop("_held")


def unseen(rows: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not stored yet. ``rows`` has one row per key and is read twice.

    Only stored keys that pass the filter of new keys are shuffled; the anti join with them is exact.
    """
    return rows.join(may_hold(stored.select(*on), rows, on).distinct(), on, "left_anti")


def _outcome(text: Column, problem: str) -> tuple[Column, Column]:
    good = T.strip(text) != ""
    return good, F.when(~good, F.lit(problem))


def page_texts(pages: DataFrame) -> DataFrame:
    """Cleaned text per page; a page without text stays as a failed row."""
    parsed = canonical_pages(pages).withColumn("_page", page_facets(F.col("html"), "text", "title"))
    good, error = _outcome(F.col("_page.text"), "no text extracted")
    return (
        parsed.drop("html")
        .withColumn("page_title", F.coalesce("_page.title", F.lit("")))
        .withColumn("raw_text", F.left(F.col("_page.text"), F.lit(K.MAX_TEXT)))
        .withColumn("success", good)
        .withColumn("error", error)
        .drop("_page")
    )


def split_success(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows)."""
    return texts.filter("success"), texts.filter("NOT success")


def with_jsonld(df: DataFrame, source: str = "jsonld") -> DataFrame:
    """Title, company and location of an embedded posting object; blanks when unreadable.

    The last of repeated keys counts.
    """
    last_of_repeated_keys(df.sparkSession)
    paths = {
        "ld_title": "$.title",
        "ld_company": "$.hiringOrganization.name",
        "ld_location": "$.jobLocation.address.addressLocality",
    }
    out = df.withColumn("_ld", F.try_parse_json(F.col(source)))
    for name, path in paths.items():
        out = out.withColumn(
            name, F.coalesce(F.try_variant_get(F.col("_ld"), path, "string"), F.lit(""))
        )
    return out.drop("_ld")


def lever_texts(pages: DataFrame) -> DataFrame:
    """Server-rendered postings: embedded JSON for the header, section blocks for the body."""
    parsed = canonical_pages(pages).withColumn(
        "_page", page_facets(F.col("html"), "text", "title", "jsonld", "sections")
    )
    meta = with_jsonld(parsed.withColumn("_jsonld", F.col("_page.jsonld")), "_jsonld")
    blocks = F.col("_page.sections")
    # the last of several blocks is a disclaimer
    kept = F.when(F.size(blocks) > 1, F.slice(blocks, F.lit(1), F.size(blocks) - 1)).otherwise(blocks)
    staged = meta.withColumn(
        "_body", F.when(F.size(blocks) > 0, F.array_join(kept, "\n\n")).otherwise(F.col("_page.text"))
    ).withColumn(
        "page_title",
        F.coalesce("_page.title", F.concat("ld_title", F.lit(" at "), "ld_company")),
    )
    good, error = _outcome(F.col("_body"), "no description found")
    title = F.when(F.col("ld_title") == "", F.col("page_title")).otherwise(F.col("ld_title"))
    text = T.posting_text(title, F.col("ld_company"), F.col("ld_location"), F.col("_body"))
    return (
        staged.withColumn("success", good)
        .withColumn("error", error)
        .withColumn("raw_text", F.when(good, text).otherwise(""))
        .drop("html", "_page", "_jsonld", "_body")
    )


ATS_PAYLOAD = "title string, offices array<struct<name:string>>, content string"


def ats_texts(payloads: DataFrame) -> DataFrame:
    """Board API answers (url, body): title, joined offices and entity-encoded content.

    A body that is not one JSON object stays as a failed row.
    """
    last_of_repeated_keys(payloads.sparkSession)
    kind = F.schema_of_variant(F.try_parse_json("body"))
    read = canonical_pages(payloads).withColumn("_job", F.from_json("body", ATS_PAYLOAD)).withColumn(
        "success", F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    )
    offices = F.transform("_job.offices", lambda o: F.coalesce(o["name"], F.lit("")))
    staged = (
        read.withColumn("title", F.coalesce("_job.title", F.lit("")))
        .withColumn("location", F.coalesce(F.array_join(offices, ", "), F.lit("")))
        .withColumn("_page", page_facets(F.coalesce("_job.content", F.lit("")), "text", decode=True))
    )
    company = F.coalesce("ats_company", F.lit(""))
    text = T.posting_text(F.col("title"), company, F.col("location"), F.col("_page.text"))
    return (
        staged.withColumn("raw_text", F.when(F.col("success"), text).otherwise(""))
        .withColumn("page_title", F.concat("title", F.lit(" at "), company))
        .withColumn("error", F.when(~F.col("success"), "unreadable answer"))
        .drop("body", "_job", "_page")
    )


TEXT_FIELDS = ["canonical_url", "platform", "page_title", "raw_text", "success", "error"]


def routed_texts(pages: DataFrame, payloads: DataFrame | None = None) -> DataFrame:
    """One text per address, each read the way its platform serves it.

    pages: url, html. payloads: url, body of board API answers. Lever pages are read by their
    blocks, board postings from their API answer; a board address without ids in it, or without a
    readable answer, falls back to its page, as all other pages are read. Of several readings of
    an address a good one counts before a failed one, then the API answer, then the first text.
    """
    lever = F.coalesce(U.platform(U.host(F.col("url"))) == "lever", F.lit(False))
    found = lever_texts(pages.filter(lever)).select(*TEXT_FIELDS, F.lit(1).alias("_route"))
    found = found.unionByName(page_texts(pages.filter(~lever)).select(*TEXT_FIELDS, F.lit(1).alias("_route")))
    if payloads is not None:
        answers = ats_texts(payloads).filter(F.col("ats_job_id").isNotNull())
        found = found.unionByName(answers.select(*TEXT_FIELDS, F.lit(0).alias("_route")))
    return first_by(found, ["canonical_url"], [F.desc("success"), "_route", "raw_text", "page_title"]).drop("_route")


def page_links(pages: DataFrame, css_class: str | None = None) -> DataFrame:
    """Anchors in page order: link_pos, href, link_text."""
    links = F.col("_page.links")
    if css_class:
        links = F.filter(links, lambda a: F.array_contains(F.split(a["css"], r"\s+"), css_class))
    return (
        pages.withColumn("_page", page_facets(F.col("html"), "links"))
        .drop("html")
        .select("*", F.posexplode(links).alias("link_pos", "_link"))
        .withColumn("href", F.col("_link.href"))
        .withColumn("link_text", F.col("_link.text"))
        .drop("_page", "_link")
    )


def text_sizes(texts: DataFrame, by: list[str]) -> DataFrame:
    size = F.length("raw_text")
    return texts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("postings"),
        F.sum(size).alias("chars"),
        F.max(size).alias("longest"),
    )
