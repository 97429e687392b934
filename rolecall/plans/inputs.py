"""Posting, search, contact and notice tables taken from the given tables.

The given tables hold pages, texts, customers, orders and events. Spark reshapes all of
their rows into what the operators expect; modulo choices only vary the shape of a row,
every row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.operators.addresses import with_candidates
from rolecall.operators.pages import held, may_hold
from rolecall.operators.skew import lookup_join
from rolecall.sources.readers import read_table

START = "timestamp_ntz'2024-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(number: Column, *choices) -> Column:
    """Choice by number modulo the number of choices."""
    options = F.array(*[c if isinstance(c, Column) else F.lit(c) for c in choices])
    return F.get(options, F.pmod(number, F.lit(len(choices))).cast("int"))


# --- pages ---------------------------------------------------------------------------


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page address and seven more spellings: page_id, variant, url, company."""
    page = F.col("page_id").cast("string")
    company = F.concat(F.lit("co"), F.pmod("page_id", F.lit(50)).cast("string"))
    base = F.col("_base")
    spellings = F.array(
        F.col("url"),
        F.concat(base, F.lit("/apply")),
        F.concat(base, F.lit("/apply/?src=a&b=1&b=2&c=&UTM_SOURCE=q&d&e=x=y")),
        F.concat(base, F.lit("?q=a+b%2Fc&t=~*&bad=%25zz&pid=9&n=caf%C3%A9#frag")),
        F.concat(F.lit("https://boards.greenhouse.io/"), company, F.lit("/jobs/"), page, F.lit("?gh=x&ref=y")),
        F.concat(F.lit("http://jobs.lever.co/"), company, F.lit("/"), page, F.lit("/apply")),
        F.concat(F.lit("https://"), company, F.lit(".wd5.myworkdayjobs.com/en/job/"), page, F.lit("/apply/")),
        F.regexp_replace(base, "^https?://", ""),
    )
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", "url")
        .withColumn("_base", F.substring_index(F.substring_index("url", "#", 1), "?", 1))
        .withColumn("company", F.regexp_extract("url", "//[^/]+/([a-z]+)/", 1))
        .select("page_id", "company", F.posexplode(spellings).alias("variant", "url"))
    )


# --- texts as search snippets ------------------------------------------------------------


def _snippet(line: Column, no: Column) -> dict[str, Column]:
    """One line of a document as a search hit: heading, link and content."""
    one = F.substring_index(line, " ", 1)
    two = F.substring_index(F.substr(line, F.length(one) + 2), " ", 1)
    shown = F.when(no % 5 == 4, F.concat(F.left(two, F.lit(1)), F.lit("."))).otherwise(two)
    heading = F.concat(
        one, F.lit(" "), shown, pick(no, " - ", " – ", " | ", " • "), line, F.lit(" | LinkedIn")
    )
    slug = F.lower(F.regexp_replace(F.concat(one, F.lit("-"), two), "[^A-Za-z-]", ""))
    number = F.lpad(F.lower(F.hex("doc_id")), 6, "0")
    url = pick(
        no,
        F.concat(F.lit("https://www.linkedin.com/in/"), slug, F.lit("-"), number),
        F.concat(F.lit("https://linkedin.com/in/"), F.replace(slug, F.lit("-"), F.lit("")), F.lit("/")),
        F.concat(F.lit("https://team."), "source", "lang", F.lit(".com/p/"), F.col("doc_id").cast("string")),
    )
    first, last = F.lower(one), F.lower(two)
    local = pick(
        no,
        F.concat(first, F.lit("."), last),
        F.concat(F.left(first, F.lit(1)), last),
        F.concat(first, F.lit("-"), last),
        F.concat(first, last),
        F.concat(F.left(first, F.lit(1)), F.lit("."), last),
    )
    content = F.concat(line, F.lit(" Contact: "), local, F.lit("@"), "source", "lang", F.lit(".com."))
    name = F.concat(one, F.lit(" "), two, F.when(no % 7 == 3, ", MBA").otherwise(""))
    return {
        "url": url,
        "title": F.when(line.contains(" "), heading).otherwise(line),
        "content": content,
        "name": name,
    }


def _lines() -> Column:
    return F.split("text", "\n")


def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, line_no, line, url, title, content, name: one row per text line."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.posexplode(_lines()).alias("line_no", "line")
    )
    parts = _snippet(F.col("line"), F.col("line_no"))
    return lines.select("*", *[c.alias(n) for n, c in parts.items()])


def _job() -> Column:
    return F.concat(F.lit("doc"), F.col("doc_id").cast("string"))


def _query_idx() -> Column:
    """Three lines per query, the rest in the sixth."""
    return F.least(F.floor(F.col("line_no") / 3), F.lit(5)).cast("int")


def _backend() -> Column:
    return pick(F.col("doc_id") + F.col("line_no"), *K.BACKENDS)


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of every document's queries, one posting per document."""
    return (
        snippets(spark, sf_dir)
        .withColumn("job_key", _job())
        .withColumn("query_idx", _query_idx())
        .withColumn("backend", _backend())
        .withColumn(
            "term",
            F.when(F.col("query_idx") < 2, "technical recruiter")
            .when(F.col("query_idx") < 4, "engineering recruiter")
            .otherwise(K.FALLBACK_TERM),
        )
        .select(
            "job_key", "query_idx", "term", "backend", F.col("line_no").alias("hit_rank"),
            "url", "title", "content",
        )
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per text line; the status follows from the line's length."""
    return (
        snippets(spark, sf_dir)
        .withColumn("_n", F.length("line"))
        .select(
            _job().alias("job_key"),
            "line_no",
            _query_idx().alias("query_idx"),
            _backend().alias("backend"),
            pick(F.col("_n"), 200, 200, 200, 200, 202, 429, 401, 402, 403, 400).alias("http_status"),
            pick(
                F.floor(F.col("_n") / 10),
                F.col("line"),
                F.concat("line", F.lit(" <b>Anomaly</b>")),
                F.concat(F.lit('{"error": {"message": "quota '), F.col("doc_id").cast("string"), F.lit('"}}')),
            ).alias("body"),
        )
    )


def search_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API answer per document, in the shape of its backend: job_key, backend, body."""

    def hits(link: str, content: bool) -> Column:
        def one(line: Column, no: Column) -> Column:
            parts = _snippet(line, no)
            fields = [parts["url"].alias(link), parts["title"].alias("title")]
            return F.struct(*fields, *([parts["content"].alias("content")] if content else []))

        return F.transform(_lines(), one)

    return (
        table(spark, sf_dir, "documents")
        .withColumn("backend", pick(F.col("doc_id"), *K.BACKENDS[1:]))
        .withColumn(
            "body",
            F.when(
                F.col("backend") == "brave",
                F.to_json(F.struct(F.struct(hits("url", False).alias("results")).alias("web"))),
            )
            .when(F.col("backend") == "tavily", F.to_json(F.struct(hits("url", True).alias("results"))))
            .otherwise(F.to_json(F.struct(hits("link", False).alias("items")))),
        )
        .select(_job().alias("job_key"), "backend", "body")
    )


def _escaped(c: Column) -> Column:
    for raw, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(coded))
    return c


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search result page per document: doc_id, backend, html."""

    def anchor(line: Column, no: Column) -> Column:
        parts = _snippet(line, no)
        return F.concat(
            F.lit('<div><a rel="nofollow" class="result__a big" href="//duckduckgo.com/l/?uddg='),
            F.url_encode(parts["url"]),
            F.lit("&amp;rut=a1\">"), _escaped(parts["title"]), F.lit('</a><a href="/more">more</a></div>'),
        )

    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lit("ddg").alias("backend"),
        F.concat(
            F.lit("<html><body>"), F.array_join(F.transform(_lines(), anchor), ""), F.lit("</body></html>")
        ).alias("html"),
    )


def lever_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One server-rendered posting per document: doc_id, url, html."""
    words = F.split("text", r"[ \n]")
    posting = F.to_json(
        F.struct(
            F.get(words, F.lit(0)).alias("title"),
            F.struct(F.col("source").alias("name")).alias("hiringOrganization"),
            F.struct(F.struct(F.col("lang").alias("addressLocality")).alias("address")).alias("jobLocation"),
        )
    )
    # one page in five has broken JSON, one in three has no section blocks
    jsonld = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("{"), posting)).otherwise(posting)
    css = F.when(F.col("doc_id") % 3 == 0, "plain").otherwise("section page-centered")
    blocks = F.array_join(
        F.transform(
            _lines(),
            lambda line: F.concat(
                F.lit('<div class="'), css, F.lit('"><h3>Part</h3><p>'), _escaped(line), F.lit("</p></div>")
            ),
        ),
        "",
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("https://jobs.lever.co/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(
            F.lit("<html><head><title>Opening "), F.col("doc_id").cast("string"),
            F.lit('</title><script type="application/ld+json">'), jsonld,
            F.lit("</script></head><body><nav>menu</nav>"), blocks, F.lit("</body></html>"),
        ).alias("html"),
    )


def ats_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One board API answer per document: doc_id, url, body."""
    paragraphs = F.array_join(
        F.transform(_lines(), lambda line: F.concat(F.lit("<p>"), _escaped(line), F.lit("</p>"))), ""
    )
    offices = pick(
        F.col("doc_id"),
        F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name"))),
        F.array(F.struct(F.col("source").alias("name"))),
        F.array().cast("array<struct<name:string>>"),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(
            F.lit("https://boards.greenhouse.io/"), "source", F.lit("/jobs/"), F.col("doc_id").cast("string")
        ).alias("url"),
        F.to_json(
            F.struct(
                F.get(F.split("text", r"[ \n]"), F.lit(0)).alias("title"),
                offices.alias("offices"),
                _escaped(paragraphs).alias("content"),
            )
        ).alias("body"),
    )


def _as_posting() -> list[Column]:
    return [
        F.col("doc_id"),
        F.concat(F.lit("https://jobs.example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(K.DEFAULT_PLATFORM).alias("platform"),
        F.get(F.split("text", r"[.\n]"), F.lit(0)).alias("job_title"),
        F.concat("source", F.lit(" & "), "lang").alias("company"),
        F.col("text").alias("description"),
        F.expr(f"{START} + make_dt_interval(0, 0, 0, doc_id)").alias("scraped_at"),
    ]


def documents_as_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a stored posting."""
    return table(spark, sf_dir, "documents").select(*_as_posting())


def labelled_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as postings, joined with lang and origin of the documents by doc_id.

    A document whose id comes once has its own; only repeated ids, told by a bitmap, are joined, so texts are not shuffled.
    """
    docs = table(spark, sf_dir, "documents").filter("doc_id IS NOT NULL")
    labels = [F.col("lang"), F.struct("source", "n_chars").alias("origin")]
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id")
    rows = held(docs.select(*_as_posting(), *labels), repeated, ["doc_id"])
    others = may_hold(docs.select("doc_id", *labels), repeated, ["doc_id"])
    once = rows.filter("NOT _held").drop("_held")
    return once.unionByName(rows.filter("_held").drop("_held", "lang", "origin").join(others, "doc_id"))


def broken_payloads(payloads: DataFrame) -> DataFrame:
    """Every seventh API answer is an error page."""
    return payloads.withColumn("body", F.when(F.col("doc_id") % 7 == 0, "<html>busy</html>").otherwise(F.col("body")))


# --- model answers ---------------------------------------------------------------------


def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model answer per part: p_partkey, page_title, response."""
    family = pick(
        F.col("p_size"), "Software Engineering", "Data Science", "AI / ML", "Head of legal affairs ",
        "xx", "Policy / Government Affairs", "devops /", "Marketing manager",
    )

    def answer(title: Column, *rest: Column) -> Column:
        return F.concat(
            F.lit('{"job_title": '), title, F.lit(', "company": " '), "p_brand", F.lit(' "'), *rest, F.lit("}")
        )

    quoted = F.concat(F.lit('"'), "p_name", F.lit('"'))
    of_family = F.concat(F.lit(', "job_family": "'), family, F.lit('"'))
    place = F.concat(F.lit(', "location": "'), "p_type", F.lit(', USA"'))
    plain = answer(quoted, of_family, place)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("page_title"),
        pick(
            F.col("p_partkey"),
            plain,
            F.concat(F.lit("```json\n"), plain, F.lit("\n```")),
            F.concat(F.lit("Sorry, "), "p_name"),
            answer(F.lit("null"), of_family, place),
            answer(quoted, place),
            F.concat(F.lit("  ```\n"), answer(quoted, of_family, F.lit(', "location": null')), F.lit("```  ")),
            answer(F.lit('"  "'), of_family, F.lit(', "location": ""')),
            F.concat(F.lit("["), plain, F.lit("]")),
            answer(quoted, F.lit(', "job_family": null'), place),
            answer(quoted, of_family, F.lit(', "location": 7')),
        ).alias("response"),
    )


def posting_answers(asked: DataFrame) -> DataFrame:
    """Model answers to addresses (canonical_url, no): canonical_url, response; none to every sixth."""
    no = F.col("no").cast("string")
    fields = F.concat(F.lit('"job_title": "Role '), no, F.lit('", "job_family": "Marketing manager"'))
    company = F.concat(F.lit(', "company": "Acme '), no, F.lit('"'))
    good = F.concat(F.lit("{"), fields, company, F.lit("}"))
    repeated = F.concat(F.lit('{"company": "Old", "job_title": 7, '), fields, company, F.lit("}"))
    answers = pick(
        F.col("no"), F.array().cast("array<string>"), F.array(good), F.array(repeated), F.array(F.lit("{oops")),
        F.array(F.lit(None).cast("string"), F.concat(good, F.lit("  ")), good), F.array(F.lit('{"location": "Rome"}')),
    )
    return asked.select("canonical_url", F.explode(answers).alias("response"))


# --- customers and orders as postings and contacts ------------------------------------------


def customer_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as a posting: job_key, company, job_family, location, drafts."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    families = [name for name, _ in K.JOB_FAMILIES]
    number = F.col("c_custkey")
    # the 25 nations are a fixed table; Spark checks its size and broadcasts it
    return table(spark, sf_dir, "customer").join(places, "c_nationkey", "left").select(
        "c_custkey",
        F.concat(F.lit("c"), number.cast("string")).alias("job_key"),
        F.when(number % 13 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name")).alias("company"),
        pick(number, *families, "Unlisted").alias("job_family"),
        pick(
            F.col("c_nationkey"),
            F.concat("n_name", F.lit(", FL, USA")), F.concat(F.lit("China, "), "n_name"),
            "New York, NY", F.col("r_name"), "", F.lit(None).cast("string"),
        ).alias("location"),
        "c_mktsegment", "c_name", "r_name",
        F.concat(F.lit("Exploring the "), "c_mktsegment", F.lit(" role at "), "c_name").alias("email_subject"),
        F.when(number % 10 == 0, "")
        .otherwise(F.concat(F.lit("Hi there,\n\nAbout "), "c_name", F.lit(". Hi there,\n\nBest,\n")))
        .alias("email_body"),
    )


def order_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a contact of its customer's posting, with a send state."""
    postings = customer_postings(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"), "job_key", "c_mktsegment", "r_name"
    )
    number = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    rows = lookup_join(orders, postings, ["o_custkey"], ["o_orderkey"], "inner").select(
        "job_key",
        number.alias("contact_rank"),
        F.when(number % 11 == 0, F.col("c_mktsegment"))
        .otherwise(
            F.concat("c_mktsegment", F.lit(" "), "r_name", F.when(number % 7 == 0, ", MBA").otherwise(""))
        )
        .alias("name"),
        F.concat("job_key", F.lit(".example.com")).alias("domain"),
        F.when(number % 3 == 0, "{first}.{last}").alias("pattern"),
        F.array().cast("array<string>").alias("candidates"),
        "o_orderstatus", "o_orderdate",
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("_tries"),
    )
    sent = F.col("o_orderstatus") != "O"
    return (
        with_candidates(rows)
        .withColumn(
            "email_tried",
            F.when(sent, F.slice("candidates", F.lit(1), F.col("_tries"))).otherwise(
                F.array().cast("array<string>")
            ),
        )
        .withColumn("email_sent_at", F.when(sent, F.col("o_orderdate")))
        .withColumn("email_sent_to", F.try_element_at("email_tried", F.lit(-1)))
        .withColumn(
            "email_bounced", F.when(F.col("o_orderstatus") == "F", F.col("contact_rank") % 2 == 0)
        )
        .drop("domain", "pattern", "_tries", "o_orderstatus", "o_orderdate")
    )


# --- events as sends and notices ------------------------------------------------------------


def _number(c: str) -> Column:
    return F.get_json_object("props", f"$.{c}").cast("int")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a mailbox message: message_id, received_at, sender, headers."""
    user = F.col("user_id").cast("string")

    def headers(*pairs) -> Column:
        made = [
            F.struct(F.lit(n).alias("name"), (v if isinstance(v, Column) else F.lit(v)).alias("value"))
            for n, v in pairs
        ]
        return F.array(*made)

    plain = F.concat(F.lit("u"), user, F.lit("@example.com"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"),
        F.col("ts").alias("received_at"),
        pick(
            F.col("event_id"), "MAILER-DAEMON@mx.example.com", "postmaster@mx.example.com",
            "Friend <pal@example.com>", "mailer-daemon@googlemail.com",
        ).alias("sender"),
        pick(
            F.col("event_id"),
            headers(("X-Failed-Recipients", F.concat(F.lit(" U"), user, F.lit("@Example.com ")))),
            headers(("To", F.concat(F.lit("User <"), plain, F.lit(">")))),
            headers(("to", plain), ("X-FAILED-RECIPIENTS", "old@example.com"), ("x-failed-recipients", plain)),
            headers(("Subject", "Delivery")),
            headers(("To", plain)),
        ).alias("headers"),
    )


def event_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a contact written to, its state given by the event's number."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_key"),
        F.col("event_id").alias("contact_rank"),
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email_sent_to"),
        F.when(_number("k") % 10 != 0, F.col("ts")).alias("email_sent_at"),
        pick(_number("k"), F.lit(None).cast("boolean"), True, False).alias("email_bounced"),
    )


def user_contacts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(contacts, postings): each user a posting with a draft, each of the user's events a contact."""
    sent = F.col("email_sent_at").isNotNull()
    first = F.lower("email_sent_to")
    contacts = event_contacts(spark, sf_dir).select(
        F.split_part("email_sent_to", F.lit("@"), F.lit(1)).alias("job_key"),
        "contact_rank", F.lit("Jane Doe").alias("name"),
        F.array(first, F.concat(F.lit("second."), first)).alias("candidates"),
        F.when(sent, F.array(first)).otherwise(F.array().cast("array<string>")).alias("email_tried"),
        "email_sent_at", "email_sent_to", "email_bounced",
    )
    jobs = contacts.select("job_key").distinct().select(
        "job_key", F.concat(F.lit("Role for "), "job_key").alias("email_subject"),
        F.lit("Hi there,\n\nBest,\n").alias("email_body"),
    )
    return contacts, jobs


def as_stream_events(events: DataFrame) -> DataFrame:
    """Events (batch or stream) with an address, an attempt number and a kind."""
    return events.select(
        F.col("event_id").alias("send_id"),
        F.col("ts").cast("timestamp").alias("at"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("address"),
        F.col("user_id").alias("contact_key"),
        (_number("k") % 6 + 1).alias("attempt"),
        F.when(F.col("event_type") == "signup", "send")
        .when(F.col("event_type") == "error", "bounce")
        .otherwise("other")
        .alias("kind"),
    )
