"""Text expressions: trimming, keys, titles, greetings, previews, prompts.

Java's ``\\s`` is ASCII only and SQL ``trim`` cuts spaces only, so Unicode whitespace is
spelled out here once: ``BLANKS`` for trimming at the ends, ``WS`` for patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolecall.functions import constants as K

ANALYSIS_ASK = (
    "Read the posting below and answer with one JSON object holding the keys"
    " job_title, company, job_family and location (null when the posting gives none).\n"
    "job_family is one of:\n"
    + "\n".join(f"- {name}" for name, _ in K.JOB_FAMILIES)
    + "\n\nPosting:\n"
)
DRAFT_ASK = f"\n\nWrite a short note that opens with 'Hi <name>,' and ends with '{K.CLOSING}'."

BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Cut Unicode whitespace at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def words(c: Column) -> Column:
    """Whitespace-separated words; blank text has none."""
    # in plain text only spaces part words, and one character is no pattern to be read anew for each row
    parts = F.when(c.rlike(r"^[ -~]*+\z"), F.split(c, " ")).otherwise(F.split(c, f"[{WS}]+"))
    return F.array_remove(parts, "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def title_case(c: Column) -> Column:
    """Capitalise every run of letters (``o'brien-smith`` -> ``O'Brien-Smith``)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def key_slug(c: Column, size: int = K.KEY_CHARS) -> Column:
    """Lower-case key segment: word characters joined by single underscores."""
    kept = F.regexp_replace(strip(F.lower(c)), rf"[^\p{{L}}\p{{N}}_{WS}-]", "")
    return F.left(F.regexp_replace(kept, f"[{WS}_-]+", "_"), F.lit(size))


def posting_key(company: Column, title: Column, scraped_at: Column) -> Column:
    stamp = F.date_format(scraped_at, "yyyyMMdd_HHmmss")
    return F.concat_ws("__", key_slug(company), key_slug(title), stamp)


def subject_line(title: Column, company: Column) -> Column:
    return F.concat(F.lit("Exploring the "), title, F.lit(" role at "), company)


def preview(c: Column, size: int = K.PREVIEW_CHARS) -> Column:
    """First characters on one line, newlines shown as a return arrow."""
    return F.replace(F.left(c, F.lit(size)), F.lit("\n"), F.lit(" \u21b5 "))


def replace_first(c: Column, old: str, new: Column) -> Column:
    """Replace the first occurrence only (SQL ``replace`` replaces all)."""
    return F.when(
        F.instr(c, old) > 0, F.overlay(c, new, F.instr(c, old), F.lit(len(old)))
    ).otherwise(c)


def personal_body(body: Column, first: Column, sender: Column) -> Column:
    """Put the first name in the greeting and the sender under the closing."""
    shown = F.coalesce(title_case(blank_to_null(first)), F.lit("there"))
    greeted = replace_first(body, K.GREETING, F.concat(F.lit("Hi "), shown, F.lit(",")))
    signed = replace_first(greeted, K.CLOSING, F.concat(F.lit(K.CLOSING + "\n"), sender))
    return F.when(F.coalesce(sender, F.lit("")) == "", greeted).otherwise(signed)


def posting_text(title: Column, company: Column, location: Column, body: Column) -> Column:
    """Header lines plus body, cut at the stored text size."""
    def part(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    whole = F.concat(
        F.lit("Job Title: "), part(title), F.lit("\nCompany: "), part(company),
        F.lit("\nLocation: "), part(location), F.lit("\n\n"), part(body),
    )
    return F.left(whole, F.lit(K.MAX_TEXT))


def analysis_prompt(text: Column) -> Column:
    """Input for an outside field-extraction model: the families, then the text."""
    return F.concat(F.lit(ANALYSIS_ASK), F.left(text, F.lit(K.ANALYSIS_CHARS)))


def draft_prompt(
    first: Column, company: Column, title: Column, url: Column, posting: Column, resume: Column
) -> Column:
    """Input for an outside drafting model, one per posting."""
    return F.concat(
        F.lit("Name: "), first, F.lit("\nCompany: "), company, F.lit("\nRole: "), title,
        F.lit("\nURL: "), url,
        F.lit("\n\nPosting:\n"), F.left(posting, F.lit(K.DRAFT_POSTING_CHARS)),
        F.lit("\n\nResume:\n"), F.left(resume, F.lit(K.DRAFT_RESUME_CHARS)),
        F.lit(DRAFT_ASK),
    )
