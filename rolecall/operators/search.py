"""Search queries, search answers, and the capped contact list of each posting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import names as N
from rolecall.functions import text as T
from rolecall.functions import urls as U
from rolecall.operators.pages import page_links
from rolecall.operators.skew import first_by, lookup_join, top_by


def family_terms(spark: SparkSession) -> DataFrame:
    """The fixed 16-row dimension: ord, job_family, terms."""
    rows = [(at, name, terms) for at, (name, terms) in enumerate(K.JOB_FAMILIES)]
    return spark.createDataFrame(rows, "ord int, job_family string, terms array<string>")


def split_searchable(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings with a company, postings that cannot be searched for)."""
    named = T.strip(F.coalesce("company", F.lit(""))) != ""
    return postings.filter(named), postings.filter(~named)


def query_cascade(postings: DataFrame, families: DataFrame) -> DataFrame:
    """Up to six queries per posting in the order they are tried."""
    defaults = F.array(*[F.lit(t) for t in K.DEFAULT_TERMS])
    named = (
        split_searchable(postings)[0]
        .join(F.broadcast(families.select("job_family", "terms")), "job_family", "left")
        .withColumn("company", T.strip(F.col("company")))
        .withColumn("city", N.city(F.col("location")))
        .withColumn(
            "_terms",
            F.concat(
                F.slice(F.coalesce("terms", defaults), 1, 2), F.array(F.lit(K.FALLBACK_TERM))
            ),
        )
    )

    def asked(term: Column, place: Column) -> Column:
        text = F.concat(
            F.lit(f'site:{K.PROFILE_URL[:-1]} "'), F.col("company"), F.lit('" "'), term, F.lit('"'), place
        )
        return F.struct(text.alias("query"), term.alias("term"))

    placed = F.concat(F.lit(' "'), F.col("city"), F.lit('"'))
    pairs = F.flatten(
        F.transform("_terms", lambda t: F.array(asked(t, placed), asked(t, F.lit(""))))
    )
    known = F.filter(pairs, lambda q: q["query"].isNotNull())
    return named.select("job_key", F.posexplode(known).alias("query_idx", "_q")).select(
        "job_key", "query_idx", F.col("_q.query").alias("query"), F.col("_q.term").alias("term")
    )


_HIT = "array<struct<url:string,title:string,content:string>>"
SEARCH_PAYLOAD = (
    f"web struct<results:{_HIT}>, results {_HIT}, items array<struct<link:string,title:string>>"
)


def parse_search_payloads(payloads: DataFrame) -> DataFrame:
    """Three answer shapes (backend, body) to one hit table, one row per hit in answer order."""
    links = F.transform(
        "_answer.items",
        lambda x: F.struct(x["link"].alias("url"), x["title"], F.lit(None).cast("string").alias("content")),
    )
    hits = (
        F.when(F.col("backend") == "brave", F.col("_answer.web.results"))
        .when(F.col("backend") == "tavily", F.col("_answer.results"))
        .when(F.col("backend") == "google_cse", links)
    )

    def text(field: str) -> Column:
        return F.coalesce(F.col(f"_hit.{field}"), F.lit("")).alias(field)

    keep = [c for c in payloads.columns if c != "body"]
    return (
        payloads.withColumn("_answer", F.from_json("body", SEARCH_PAYLOAD))
        .select(*keep, F.posexplode(hits).alias("hit_rank", "_hit"))
        .select(*keep, "hit_rank", text("url"), text("title"), text("content"))
    )


def result_page_hits(pages: DataFrame) -> DataFrame:
    """Hits of HTML result pages: result links, unwrapped, in page order."""
    links = page_links(pages, K.RESULT_LINK_CLASS)
    return (
        links.withColumn("url", U.redirect_target(F.col("href")))
        .filter(F.col("url").contains("/in/"))
        .withColumnsRenamed({"link_pos": "hit_rank", "link_text": "title"})
        .withColumn("content", F.lit(""))
        .drop("href")
    )


def profile_hits(hits: DataFrame) -> DataFrame:
    """Hits that link a profile and whose heading gives a name; adds name, role, source."""
    sources = F.create_map(*[F.lit(x) for pair in K.BACKEND_SOURCES.items() for x in pair])
    fragment = F.when(F.col("backend") == "ddg", "/in/").otherwise(K.PROFILE_URL)
    profiles = hits.filter(F.contains("url", fragment))
    return (
        N.with_heading_parts(profiles, "title", "url")
        .filter(F.col("name").isNotNull())
        .withColumn("source", F.element_at(sources, F.col("backend")))
    )


def all_hits(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fetch_outcomes(log: DataFrame) -> DataFrame:
    """Label each answered request (backend, http_status, body); adds outcome and detail."""
    status, body = F.col("http_status"), F.coalesce("body", F.lit(""))
    challenged = F.lower(body).contains("anomaly") | body.contains("challenge-form")
    by_backend = {
        "ddg": F.when(status == 202, "blocked").when(status == 429, "rate_limited"),
        "brave": F.when(status.isin(402, 429), "quota").when(status == 401, "bad_key"),
        "tavily": F.when(status == 429, "rate_limited").when(status == 401, "bad_key"),
        "google_cse": F.when(status == 429, "quota").when(status == 403, "bad_key"),
    }
    special = F.lit(None).cast("string")
    for backend, rule in by_backend.items():
        special = F.when(F.col("backend") == backend, rule).otherwise(special)
    outcome = (
        F.when(special.isNotNull(), special)
        .when(status.isNull() | (status != 200) | ~F.col("backend").isin(K.BACKENDS), "error")
        .when((F.col("backend") == "ddg") & challenged, "blocked")
        .otherwise("ok")
    )
    message = F.try_variant_get(F.try_parse_json(body), "$.error.message", "string")
    detail = F.when(
        (F.col("backend") == "google_cse") & (status == 400),
        F.coalesce(message, F.lit("Bad request")),
    )
    return log.withColumn("outcome", outcome).withColumn("detail", detail)


def split_requests(outcomes: DataFrame, queries: int = 6) -> tuple[DataFrame, DataFrame]:
    """(requests of a planned query, requests whose query number is missing or outside the plan)."""
    planned = F.coalesce(F.col("query_idx").between(0, queries - 1), F.lit(False))
    return outcomes.filter(planned), outcomes.filter(~planned)


def sticky_backends(outcomes: DataFrame, queries: int = 6, backends: list[str] | None = None) -> DataFrame:
    """Backend that answered each query of a posting, a failed one never being tried again.

    Query i uses the first backend at or after the one query i-1 ended on whose request
    succeeded; when none is left the posting stops. The successes of a query are the bits of
    one number, one for each query: they combine before the shuffle and nothing is collected.
    Requests outside the plan are left out (see ``split_requests``); all others count.
    """
    order = backends or K.BACKENDS
    width = len(order)
    if width > 63:
        raise ValueError("at most 63 backends fit in one 64-bit mask")
    slot = F.array_position(F.array(*[F.lit(b) for b in order]), F.col("backend")) - 1

    def successes(query: int) -> Column:
        good = (F.col("query_idx") == query) & (F.col("outcome") == "ok")
        return F.bit_or(F.when(good, F.expr("shiftleft(1L, int(_slot))")).otherwise(F.lit(0).cast("long")))

    masks = (
        split_requests(outcomes, queries)[0].withColumn("_slot", slot)
        .filter(F.col("_slot") >= 0)
        .groupBy("job_key")
        .agg(*[successes(q).alias(f"_mask{q}") for q in range(queries)], F.max("query_idx").alias("_last"))
    )
    pointer: Column = F.lit(0)
    used = []
    for query in range(queries):
        step: Column = F.lit(width)
        for at in reversed(range(width)):
            ok = F.getbit(f"_mask{query}", F.lit(at)) == 1
            step = F.when((F.col(f"_at{query}") <= at) & ok, at).otherwise(step)
        masks = masks.withColumn(f"_at{query}", pointer)
        pointer = step
        used.append((query, f"_at{query + 1}"))
    masks = masks.withColumn(f"_at{queries}", pointer)
    rows = F.array(
        *[F.struct(F.lit(q).alias("query_idx"), F.col(c).alias("_used")) for q, c in used]
    )
    return (
        masks.select("job_key", "_last", F.explode(rows).alias("_row"))
        .filter((F.col("_row.query_idx") <= F.col("_last")) & (F.col("_row._used") < width))
        .select(
            "job_key",
            F.col("_row.query_idx").alias("query_idx"),
            F.element_at(F.array(*[F.lit(b) for b in order]), F.col("_row._used") + 1).alias("backend"),
        )
    )


def answered_hits(hits: DataFrame, used: DataFrame) -> DataFrame:
    """Hits that came from the backend used for their query."""
    return lookup_join(hits, used, ["job_key", "query_idx", "backend"], ["url", "hit_rank"], "inner")


def first_seen(hits: DataFrame) -> DataFrame:
    """First hit per posting and profile, in query then answer order."""
    keyed = hits.withColumn("profile_key", U.profile_key(F.col("url")))
    return first_by(
        keyed.filter(F.col("profile_key") != ""), ["job_key", "profile_key"], ["query_idx", "hit_rank"]
    )


def _runs(before: Column, max_results: int) -> Column:
    """A query runs while the list is short, a fallback only while it is empty."""
    return (before < max_results) & ((F.col("term") != K.FALLBACK_TERM) | (before == 0))


def capped_contacts(seen: DataFrame, max_results: int = K.MAX_RESULTS) -> DataFrame:
    """Contacts per posting in the order found, up to ``max_results``; adds contact_rank.

    At most ``max_results`` hits per query can matter, so those are picked first; what is
    left per posting is small however many hits it had.
    """
    short = top_by(seen, ["job_key", "query_idx"], ["hit_rank"], max_results)
    earlier = Window.partitionBy("job_key").orderBy("query_idx").rangeBetween(
        Window.unboundedPreceding, -1
    )
    ran = short.withColumn("_before", F.count(F.lit(1)).over(earlier)).filter(
        _runs(F.col("_before"), max_results)
    )
    return (
        top_by(ran, ["job_key"], ["query_idx", "hit_rank"], max_results, "contact_rank")
        .withColumn("source", F.concat("source", F.lit(" ["), "term", F.lit("]")))
        .drop("_before")
    )


def query_yield(hits: DataFrame, max_results: int = K.MAX_RESULTS) -> DataFrame:
    """Hits and first-seen hits of each query that ran."""
    per_query = (
        hits.withColumn("profile_key", U.profile_key(F.col("url")))
        .groupBy("job_key", "profile_key", "query_idx", "term")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = per_query.groupBy("job_key", "query_idx", "term").agg(F.sum("_n").alias("hits"))
    new = (
        per_query.filter(F.col("profile_key") != "")
        .groupBy("job_key", "profile_key")
        .agg(F.min("query_idx").alias("query_idx"))
        .groupBy("job_key", "query_idx")
        .agg(F.count(F.lit(1)).alias("new_hits"))
    )
    earlier = Window.partitionBy("job_key").orderBy("query_idx").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        counts.join(new, ["job_key", "query_idx"], "left")
        .withColumn("new_hits", F.coalesce("new_hits", F.lit(0).cast("long")))
        .withColumn("_before", F.coalesce(F.sum("new_hits").over(earlier), F.lit(0)))
        .filter(_runs(F.col("_before"), max_results))
        .drop("_before")
    )
