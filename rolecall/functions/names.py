"""Names, headings, places and address patterns as column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions.stage import settled
from rolecall.functions.text import BLANKS, WS, blank_to_null, strip, title_case, words
from rolecall.functions.urls import profile_slug

_BRAND = "linkedin"
_DASHES = ["-", "\u2013", "|"]
_BREAKS = "\\-\u2013|\u2022"


@cache
def _letter_folds() -> tuple[str, str, dict[str, str]]:
    """ASCII letters of every other character's compatibility decomposition.

    Returned as two ``translate`` strings for one-letter results and a small map for
    the few characters that hold several letters (ligatures and the like).
    """
    single_from, single_to, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        folded = unicodedata.normalize("NFKD", ch)
        letters = "".join(c for c in folded if c.isascii() and c.isalpha())
        if len(letters) == 1:
            single_from.append(ch)
            single_to.append(letters)
        elif letters:
            several[ch] = letters
    return "".join(single_from), "".join(single_to), several


def ascii_letters(c: Column) -> Column:
    """Lower-case, fold accents, keep ASCII letters only. Stays in the JVM."""
    single_from, single_to, several = _letter_folds()
    low = F.lower(c)
    spellings = ",".join(f"{ch}:{letters}" for ch, letters in several.items())
    table = F.str_to_map(F.lit(spellings), F.lit(","), F.lit(":"))
    spelled = F.array_join(
        F.transform(F.split(low, ""), lambda ch: F.coalesce(F.element_at(table, ch), ch)), ""
    )
    # plain text skips both tables; the slow one runs only for text holding its characters
    wide = F.when(low.rlike("[" + "".join(several) + "]"), spelled).otherwise(low)
    folded = F.when(low.rlike(r"^[\x00-\x7f]*\z"), low).otherwise(
        F.translate(wide, single_from, single_to)
    )
    return F.when(low.rlike(r"^[a-z]*\z"), low).otherwise(F.regexp_replace(folded, "[^A-Za-z]", ""))


def _name_words(name: Column) -> Column:
    """Words of a name after one trailing ', CREDENTIAL ...' is cut."""
    # repeats that never give back: a long tail is a loop, not a recursion
    tail = r"[\p{L}\p{N}_\-.]++"
    cut = rf",[{WS}]*+[A-Z]{tail}(?:[{WS}]++[A-Z]{tail})*+\z"
    return words(F.when(name.contains(","), F.regexp_replace(name, cut, "")).otherwise(name))


def with_first_last(df: DataFrame, name: str) -> DataFrame:
    """Columns first, last for addresses; both null when either cannot be had."""
    w, long_word = F.col("_words"), F.col("_long")
    rest = F.slice(w, F.lit(2), F.greatest(F.size(w), F.lit(1)))

    def long(x: Column) -> Column:
        return F.length(F.rtrim(x, F.lit("."))) > 1

    # mostly the second word itself, then no others are looked at
    second = F.try_element_at(w, F.lit(2))
    found = F.when(long(second), second).otherwise(F.try_element_at(F.filter(rest, long), F.lit(1)))
    usable = (F.size(w) >= 2) & (F.col("_first") != "") & (F.col("_last") != "")
    parts = (
        df.withColumn("_words", _name_words(F.col(name)))
        .withColumn("_long", found)
        .withColumn("_first", ascii_letters(F.try_element_at(w, F.lit(1))))
        .withColumn("_last", blank_to_null(ascii_letters(long_word)))
        .withColumn("_second", F.when(F.col("_last").isNull(), F.try_element_at(w, F.lit(2))))
        .withColumn("_last", F.coalesce(F.col("_last"), ascii_letters(F.col("_second"))))
        .withColumn("first", F.when(usable, F.col("_first")))
        .withColumn("last", F.when(usable, F.col("_last")))
        .drop("_words", "_long", "_first", "_last", "_second")
    )
    return settled(parts, "first", "last")


def _slots(first: Column, last: Column) -> dict[str, Column]:
    return {
        "{first}": first, "{last}": last,
        "{f}": F.left(first, F.lit(1)), "{l}": F.left(last, F.lit(1)),
    }


def _spelled(pattern: str, slots: dict[str, Column]) -> Column:
    """A listed pattern as one concatenation, taken apart while the plan is built."""
    pieces = [p for p in re.split(r"({\w+})", pattern) if p]
    return F.concat(*[slots.get(p, F.lit(p)) for p in pieces])


def candidates(first: Column, last: Column, domain: Column, pattern: Column) -> Column:
    """One address for a known pattern, else one per listed pattern, in order."""
    slots, site = _slots(first, last), F.concat(F.lit("@"), domain)
    every = {p: F.concat(_spelled(p, slots), site) for p in K.ADDRESS_PATTERNS}
    other = pattern
    for slot, value in slots.items():
        other = F.replace(other, F.lit(slot), value)
    one = F.concat(other, site)
    for listed, address in every.items():
        one = F.when(pattern == listed, address).otherwise(one)
    return F.when(F.coalesce(pattern, F.lit("")) == "", F.array(*every.values())).otherwise(F.array(one))


def known_pattern(pattern: Column) -> Column:
    return F.when(pattern.isin(K.ADDRESS_PATTERNS), pattern)


def pattern_of(local: Column) -> Column:
    """Pattern one local part votes for, or null."""
    low = F.lower(local)
    dots = F.length(low) - F.length(F.replace(low, F.lit("."), F.lit("")))
    return (
        F.when(dots > 1, F.lit(None))
        .when((dots == 1) & (F.instr(low, ".") == 2), F.lit("{f}.{last}"))
        .when((dots == 1) | low.contains("-"), F.lit("{first}.{last}"))
        .when(F.length(low) <= K.SHORT_LOCAL_PART, F.lit("{f}{last}"))
        .otherwise(F.lit("{first}{last}"))
    )


def pattern_order(pattern: Column) -> Column:
    return F.array_position(F.array(*[F.lit(p) for p in K.ADDRESS_PATTERNS]), pattern)


def with_slug_name(df: DataFrame, url: str, hint: str, out: str) -> DataFrame:
    """Name spelled by a profile link; '' when the link has none."""
    slug, start, rest = F.col("_slug"), F.col("_start"), F.col("_rest")
    parts = F.filter(F.split(slug, "-"), lambda t: (t != "") & ~t.rlike(r"^\p{N}+\z"))
    hyphened = F.array_join(F.transform(parts, title_case), " ")
    return (
        df.withColumn("_slug", F.regexp_replace(profile_slug(F.col(url)), r"(?i)-[a-f0-9]{6,}\z", ""))
        .withColumn("_start", F.coalesce(F.lower(strip(F.col(hint))), F.lit("")))
        .withColumn("_rest", F.substr(slug, F.length(start) + 1))
        .withColumn(
            out,
            F.when(slug.contains("-"), hyphened)
            .when(
                (start != "") & F.lower(slug).startswith(start),
                F.concat_ws(" ", title_case(start), blank_to_null(title_case(rest))),
            )
            .otherwise(title_case(slug)),
        )
        .drop("_slug", "_start", "_rest")
    )


def with_heading_parts(df: DataFrame, heading: str, url: str) -> DataFrame:
    """Columns name, role from a search heading; name is null when none can be read."""
    text, name, spelled = F.col("_text"), F.col("_name"), F.col("_spelled")
    tail, head, rest = F.col("_tail"), F.col("_head"), F.col("_rest_of")
    # a trailing site name goes with the dash before it; only the text's end is looked at
    without = F.rtrim(F.left(text, F.length(text) - len(_BRAND)), F.lit(BLANKS))
    branded = F.lower(F.right(text, F.lit(len(_BRAND)))) == _BRAND
    # name up to the first separator after the first character, role after it
    one_line = ~text.contains("\n")
    split = rf"(?d)^(.+?)[{WS}]*[{_BREAKS}][{WS}]*(.+)\z"
    after = strip(F.substr(text, F.length(head) + 2))
    short = F.exists(F.col("_words"), lambda w: w.rlike(r"^[A-Za-z]\.\z") | (F.length(w) == 1))
    read = (
        df.withColumn("_text", strip(F.col(heading)))
        .withColumn("_tail", F.when(branded, without))
        .withColumn(
            "_text",
            F.when(F.right(tail, F.lit(1)).isin(_DASHES), strip(F.left(tail, F.length(tail) - 1)))
            .otherwise(text),
        )
        .withColumn("_head", F.regexp_extract(text, rf"(?s)^.[^{_BREAKS}]*", 0))
        .withColumn("_rest_of", F.when(one_line, after).otherwise(F.regexp_extract(text, split, 2)))
        .withColumn(
            "_name",
            F.when(one_line, F.when(rest == "", "").otherwise(strip(head))).otherwise(
                strip(F.regexp_extract(text, split, 1))
            ),
        )
        .withColumn("_words", words(name))
        .withColumn("_hint", F.try_element_at(F.col("_words"), F.lit(1)))
    )
    parts = (
        with_slug_name(read, url, "_hint", "_spelled")
        .withColumn("role", blank_to_null(strip(rest)))
        .withColumn(
            "name",
            F.when(
                F.length(name).between(2, 60) & ~name.rlike(r"\p{Nd}"),
                F.when(short & (spelled != ""), spelled).otherwise(name),
            ),
        )
        .withColumn("role", F.when(F.col("name").isNotNull(), F.col("role")))
        .drop("_text", "_tail", "_head", "_rest_of", "_name", "_words", "_hint", "_spelled")
    )
    return settled(parts, "name", "role")


def city(location: Column) -> Column:
    """First part of a location that is no state or country; else its first part."""
    parts = F.transform(F.split(location, ","), strip)
    places = F.filter(
        parts, lambda p: ~F.lower(p).isin(K.STATES_AND_COUNTRIES) & (F.length(p) > 1)
    )
    return blank_to_null(
        F.coalesce(F.try_element_at(places, F.lit(1)), F.try_element_at(parts, F.lit(1)))
    )


def closest_family(value: Column) -> Column:
    """First family one of whose '/'-separated pieces occurs in the value (pieces untrimmed)."""
    low = F.lower(value)
    label = F.lit(K.DEFAULT_FAMILY)
    for name, _ in reversed(K.JOB_FAMILIES):
        hit = F.lit(False)
        for piece in name.lower().split("/"):
            hit = hit | low.contains(piece)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return label
