"""Address mining, address patterns and candidate addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import names as N
from rolecall.functions.stage import settled
from rolecall.operators.domains import first_success
from rolecall.operators.skew import first_by, lookup_join


def _local_before(word: Column, segment: str, first: str) -> Column:
    """The longest local part at a word's end: segments joined by dots or hyphens.

    Worked backwards: what is cut off first is everything up to the last character that no local
    part can hold, then all segments up to the last one that is not valid, then those that cannot
    come first.
    """
    run = F.regexp_replace(word, r"(?s)\A.*[^\p{L}\p{N}_.\-]", "")
    parts = F.split(run, r"[.\-]", -1)
    bad = F.array_max(F.transform(parts, lambda p, i: F.when(~p.rlike(rf"(?iu)\A{segment}\z"), i)))
    valid = F.slice(parts, F.coalesce(bad, F.lit(-1)) + 2, F.size(parts))
    at = F.array_min(F.transform(valid, lambda p, i: F.when(p.rlike(rf"(?iu)\A{first}\z"), i)))
    kept = F.slice(valid, at + 1, F.greatest(F.size(valid), F.lit(1)))
    size = F.aggregate(kept, F.lit(0), lambda n, p: n + F.length(p) + 1) - 1
    return F.when(at.isNotNull(), F.right(run, size)).otherwise(F.lit(""))


def mined_addresses(
    snippets: DataFrame, fields: list[str], segment: str = K.LOCAL_SEGMENT, first: str = K.LOCAL_SEGMENT
) -> DataFrame:
    """Every local@host in the text columns: local, host, host as far as it may be a name.

    Each '@' is looked at by itself: the local part must end right before it.
    """
    keep = [c for c in snippets.columns if c not in fields]
    pieces = F.col("_pieces")
    around = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 1),
        lambda i: F.struct(
            # a local part holds no blank, so the last word will do
            _local_before(F.substring_index(F.get(pieces, i - 1), " ", -1), segment, first).alias("local"),
            F.regexp_extract(F.get(pieces, i), r"^[\p{L}\p{N}_.\-]++", 0).alias("host"),
        ),
    )
    texts = snippets.select(
        *keep, F.explode(F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])).alias("_text")
    )
    return (
        texts.filter(F.col("_text").contains("@"))
        .withColumn("_pieces", F.split("_text", "@"))
        .select(*keep, F.explode(around).alias("_found"))
        .select(*keep, F.lower("_found.local").alias("local"), F.lower("_found.host").alias("host"))
        .filter((F.col("local") != "") & (F.col("host") != ""))
    )


def pattern_votes(mined: DataFrame, domains: DataFrame) -> DataFrame:
    """Votes per (domain, pattern) of addresses at the wanted domains.

    Votes combine per host first. A host stands for every domain it starts with up to a
    word end, so it is spread over those prefixes and met by an equal join.
    """
    per_host = (
        mined.withColumn("pattern", N.pattern_of(F.col("local")))
        .filter(F.col("pattern").isNotNull())
        .groupBy("host", "pattern")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # text up to each '.' or '-' and the whole host
    tokens = F.regexp_extract_all("host", F.lit(r"([.\-]*[^.\-]+)"), F.lit(1))
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(tokens)),
        lambda n: F.array_join(F.slice(tokens, F.lit(1), n), ""),
    )
    spread = per_host.withColumn("domain", F.explode(prefixes))
    wanted = domains.select("domain").distinct()
    return (
        spread.join(wanted, "domain", "left_semi")
        .groupBy("domain", "pattern")
        .agg(F.sum("_n").alias("votes"))
    )


def top_patterns(votes: DataFrame) -> DataFrame:
    """Most voted pattern per domain, ties to the commoner pattern."""
    return first_by(
        votes.withColumn("_ord", N.pattern_order(F.col("pattern"))),
        ["domain"],
        [F.desc("votes"), "_ord"],
    ).drop("_ord")


def domain_patterns(domains: DataFrame, mined: DataFrame, provider: DataFrame) -> DataFrame:
    """Pattern per domain: mined first, then a provider's answer if it is a listed one."""
    first = mined.select("domain", F.col("pattern").alias("_mined"))
    second = provider.select("domain", N.known_pattern(F.col("pattern")).alias("_provider"))
    return (
        domains.join(first, "domain", "left")
        .join(second, "domain", "left")
        .withColumn("pattern", first_success(F.col("_mined"), F.col("_provider")))
        .drop("_mined", "_provider")
    )


def with_candidates(contacts: DataFrame) -> DataFrame:
    """Candidate addresses where name and domain allow; others keep what they have."""
    named = N.with_first_last(contacts, "name")
    made = N.candidates(F.col("first"), F.col("last"), F.col("domain"), F.col("pattern"))
    usable = F.col("first").isNotNull() & (F.coalesce("domain", F.lit("")) != "")
    filled = named.withColumn("candidates", F.when(usable, made).otherwise(F.col("candidates")))
    return settled(filled.drop("first", "last"), "candidates")


def contact_addresses(contacts: DataFrame, companies: DataFrame) -> DataFrame:
    """Contacts joined to their company's (domain, pattern), one row per company."""
    facts = companies.select("company", "domain", "pattern")
    return with_candidates(lookup_join(contacts, facts, ["company"], ["name"]))


def sample_addresses(patterns: DataFrame) -> DataFrame:
    """A sample address per (domain, pattern), as shown to a user."""
    made = N.candidates(F.lit("jane"), F.lit("doe"), F.col("domain"), F.col("pattern"))
    return patterns.withColumn("sample", F.array_join(made, ","))


def primary_addresses(contacts: DataFrame) -> DataFrame:
    """First candidate of every contact that has one."""
    return contacts.filter(F.size("candidates") > 0).withColumn(
        "primary_address", F.try_element_at("candidates", F.lit(1))
    )


def coverage(contacts: DataFrame, by: list[str]) -> DataFrame:
    return contacts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("contacts"),
        F.count_if(F.size("candidates") > 0).alias("with_address"),
    )
