"""Registered queries: each takes (spark, sf_dir) and works over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolecall import session
from rolecall.functions import constants as K
from rolecall.functions import names as N
from rolecall.functions import text as T
from rolecall.functions import urls as U
from rolecall.operators import addresses, domains, outreach, pages, postings, reconcile, search
from rolecall.operators.skew import hot_keys, long_keys, numbered, top_by
from rolecall.plans import inputs as I
from rolecall.plans import pipeline
from rolecall.sources import readers, writers
from rolecall.sources.store import PostingStore
from rolecall.streaming import ingest, retries
from rolecall.streaming import reconcile as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WEEK_MINUTES = 7 * 24 * 60
STREAM_WAIT = 6 * 3600
#: Longer than the events' span: an attempt is judged by its first send alone.
KEEP = 3650 * 86_400


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- URLs and domains --------------------------------------------------------------


@query
def canonical_urls(spark, sf_dir):
    rows = pages.canonical_pages(I.url_variants(spark, sf_dir))
    return rows.select("page_id", "variant", "url", "canonical_url")


@query
def platform_labels(spark, sf_dir):
    rows = pages.canonical_pages(I.url_variants(spark, sf_dir))
    return rows.select("page_id", "variant", "platform", "ats_company", "ats_job_id")


def _page_hits(spark, sf_dir):
    rank = F.col("page_id") * 10 + F.col("variant")
    return I.url_variants(spark, sf_dir).select("company", rank.alias("hit_rank"), "url")


@query
def root_domain_votes(spark, sf_dir):
    return domains.domain_votes(_page_hits(spark, sf_dir))


@query
def top_domains(spark, sf_dir):
    return domains.top_domains(domains.domain_votes(_page_hits(spark, sf_dir)))


@query
def company_domains(spark, sf_dir):
    """Three answer tiers per customer; blanks and gaps fall through to the next tier."""
    companies = I.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("company"), "c_custkey", "c_mktsegment"
    )
    number = F.col("c_custkey")
    named = F.concat(F.lower("c_mktsegment"), F.lit(".com"))
    tiers = [
        companies.filter(number % 2 == 0).select("company", I.pick(number, named, "", named).alias("domain")),
        companies.filter(number % 3 == 0).select("company", I.pick(number, "", "second.com").alias("domain")),
        companies.filter(number % 5 != 0).select("company", I.pick(number, "third.com", F.lit(None)).alias("domain")),
    ]
    return domains.company_domains(companies.select("company"), *tiers)


# --- pages ---------------------------------------------------------------------------


@query
def deduped_pages(spark, sf_dir):
    rows = pages.dedupe_pages(I.url_variants(spark, sf_dir), ["page_id", "variant"])
    return rows.select("url_key", "page_id", "variant")


@query
def unseen_pages(spark, sf_dir):
    """Pages crawled over https whose address was not stored by the http crawl."""
    keyed = pages.dedupe_pages(I.url_variants(spark, sf_dir).filter(F.col("url").startswith("https:")), ["page_id", "variant"])
    stored = pages.dedupe_pages(I.url_variants(spark, sf_dir).filter(F.col("url").startswith("http:")), ["page_id", "variant"])
    return pages.unseen(keyed, stored, ["url_key"]).select("url_key", "page_id", "variant")


def _pages(spark, sf_dir):
    return I.table(spark, sf_dir, "pages")


@query
def page_texts(spark, sf_dir):
    texts = pages.page_texts(_pages(spark, sf_dir))
    return texts.select("page_id", "canonical_url", "platform", "page_title", "raw_text", "success", "error")


@query
def page_previews(spark, sf_dir):
    texts = pages.page_texts(_pages(spark, sf_dir))
    return texts.select("page_id", T.preview(F.col("raw_text")).alias("preview"))


@query
def text_sizes(spark, sf_dir):
    return pages.text_sizes(pages.page_texts(_pages(spark, sf_dir)), ["platform"])


@query
def page_links(spark, sf_dir):
    return pages.page_links(_pages(spark, sf_dir)).select("page_id", "link_pos", "href", "link_text")


@query
def lever_postings(spark, sf_dir):
    rows = pages.lever_texts(I.lever_pages(spark, sf_dir))
    return rows.select("doc_id", "platform", "page_title", "ld_title", "ld_company", "ld_location", "raw_text", "success")


@query
def ats_postings(spark, sf_dir):
    rows = pages.ats_texts(I.ats_payloads(spark, sf_dir))
    return rows.select("doc_id", "ats_company", "ats_job_id", "title", "location", "page_title", "raw_text")


# --- postings ----------------------------------------------------------------------------


@query
def posting_keys(spark, sf_dir):
    rows = postings.with_subject(postings.with_posting_key(I.documents_as_postings(spark, sf_dir)))
    return rows.select("doc_id", "job_key", "email_subject")


@query
def model_responses(spark, sf_dir):
    rows = postings.quality_flags(postings.checked_responses(I.model_answers(spark, sf_dir)))
    return rows.select(
        "p_partkey", "job_title", "company", "job_family", "location", "problem",
        "company_doubtful", "title_blank",
    )


@query
def analysis_prompts(spark, sf_dir):
    rows = postings.with_analysis_prompt(pages.page_texts(_pages(spark, sf_dir)))
    return rows.select("page_id", "prompt")


@query
def draft_prompts(spark, sf_dir):
    """One prompt per document; the resume is the longest document, ties to the first."""
    docs = I.documents_as_postings(spark, sf_dir)
    best = F.min_by("description", F.struct((-F.length("description")).alias("n"), "doc_id"))
    rows = postings.with_draft_prompt(docs, docs.agg(best.alias("text")))
    return rows.select("doc_id", "prompt")


@query
def posting_documents(spark, sf_dir):
    """Postings written as JSON documents in three goes, some of them anew, and read back."""
    path = session.work_path(spark, "postings")
    rows = postings.with_posting_key(I.documents_as_postings(spark, sf_dir))
    number = F.col("doc_id")
    goes = [rows.filter(number % 2 == 0).withColumn("description", F.lit("old")), rows.filter(number % 4 == 0), rows.filter(number % 4 != 0)]
    for go in goes:
        writers.write_postings(go.drop("doc_id"), path)
    return readers.read_postings(spark, path).select(
        "job_key", "url", "platform", "job_title", "company", "location", "description"
    )


@query
def versioned_postings(spark, sf_dir):
    """As ``posting_documents``, in a store whose parts split; each posting with what the version before had of it."""
    store = PostingStore(spark, session.work_path(spark, "store"), part_bytes=1 << 18)
    rows = postings.with_posting_key(I.documents_as_postings(spark, sf_dir))
    number = F.col("doc_id")
    for go in (rows.filter(number % 2 == 0).withColumn("description", F.lit("old")), rows.filter(number % 2 != 0), rows.filter(number % 4 == 0)):
        last = store.write(go.drop("doc_id"))
    before = store.read(last - 1).select("job_key", F.length("description").alias("n_before"))
    now = store.read(last).select("job_key", "url", "company", "description")
    return now.join(before, "job_key", "left")


@query
def stored_files(spark, sf_dir):
    """Folders of the stored documents whose files are listed."""
    path = session.work_path(spark, "listing")
    rows = postings.with_posting_key(I.documents_as_postings(spark, sf_dir))
    writers.write_postings(rows.drop("doc_id"), path)
    files = readers.list_postings(spark, path)
    folder = F.regexp_extract("path", "_part=([0-9]+)/", 1).cast("int")
    return files.filter(F.col("length") > 0).select(folder.alias("folder")).distinct()


@query
def listed_files(spark, sf_dir):
    """Each posting with the file it lies in, as the listing has that file: time, size and place in the order."""
    path = session.work_path(spark, "listing")
    rows = postings.with_posting_key(I.documents_as_postings(spark, sf_dir))
    for go in (rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 <> 0").filter(F.length("company") % 2 == 0)):
        writers.write_postings(go.drop("doc_id"), path)
    # the listing's own order, numbered as it comes, against the order worked out anew
    listed = readers.list_postings(spark, path).withColumn("at", F.monotonically_increasing_id())
    newest = Window.orderBy(F.desc("modificationTime"), "path")
    listed = listed.withColumn("newest", F.row_number().over(newest)).withColumn("came", F.row_number().over(Window.orderBy("at")))
    found = F.struct("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
    lines = spark.read.text(path).select(F.get_json_object("value", "$.job_key").alias("job_key"), found.alias("file"))
    return lines.join(listed, F.col("file.file_path") == F.col("path"), "left").select(
        "job_key", F.col("path").isNotNull().alias("listed"),
        (F.col("file.file_modification_time") == F.col("modificationTime")).alias("same_time"),
        (F.col("file.file_size") == F.col("length")).alias("same_size"),
        (F.col("newest") == F.col("came")).alias("in_order"),
    )


@query
def foreign_keys(spark, sf_dir):
    """Documents with keys that are no fields, after drafts, contact lists and send states were patched into them."""
    path = session.work_path(spark, "foreign")
    writers.write_postings(postings.with_posting_key(I.labelled_postings(spark, sf_dir)).drop("doc_id"), path)
    number = F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint")

    def contacts(which, tried):
        return readers.read_postings(spark, path).filter(which).select(
            "job_key", F.lit(1).alias("contact_rank"), F.lit("Ann").alias("name"), F.lit(None).cast("string").alias("title"),
            F.lit(None).cast("string").alias("linkedin_url"), F.array(F.lit("ann@example.com")).alias("candidates"),
            F.lit("brave").alias("source"), F.lit(None).cast("timestamp").alias("found_at"),
            F.lit(None).cast("timestamp").alias("email_sent_at"), F.lit(None).cast("string").alias("email_sent_to"),
            tried.alias("email_tried"), F.lit(None).cast("boolean").alias("email_bounced"),
        )

    def patched(which, change):
        writers.write_postings(change(readers.read_postings(spark, path).filter(which)), path)

    new = F.lit("New subject").alias("email_subject"), F.lit("New body").alias("email_body")
    patched(number % 3 == 0, lambda docs: postings.apply_drafts(docs, docs.select("job_key", *new)))
    found = writers.nested_contacts(contacts(number % 2 == 0, F.array().cast("array<string>")))
    patched(number % 2 == 0, lambda docs: writers.upsert_contacts(docs, found))
    sent = writers.nested_contacts(contacts(number % 4 == 0, F.array(F.lit("ann@example.com"))))
    patched(number % 4 == 0, lambda docs: writers.upsert_contacts(docs, sent))
    rest = F.col("rest")
    return readers.read_postings(spark, path).select(
        "job_key", "email_subject", F.coalesce(F.size("recruiters"), F.lit(0)).cast("bigint").alias("n_contacts"),
        F.array_join(F.get("recruiters.email_tried", F.lit(0)), ",").alias("tried"),
        F.variant_get(rest["lang"], "$", "string").alias("lang"),
        F.try_variant_get(rest["origin"], "$.source", "string").alias("origin"),
        F.try_variant_get(rest["origin"], "$.n_chars", "bigint").alias("n_chars"),
    )


@query
def text_documents(spark, sf_dir):
    """Benchmark items written as one text file each and read back whole."""
    path = session.work_path(spark, "texts")
    items = I.table(spark, sf_dir, "benchmark").select("item_id", "text")
    items.repartition("item_id").write.partitionBy("item_id").text(path)
    docs = readers.read_text_docs(spark, f"{path}/*")
    return docs.select(F.regexp_extract("path", "item_id=([0-9]+)/", 1).cast("bigint").alias("item_id"), "text")


@query
def saved_drafts(spark, sf_dir):
    """Drafts patched into every third posting; the others keep their own."""
    stored = I.customer_postings(spark, sf_dir).select("c_custkey", "job_key", "company", "email_subject", "email_body")
    drafts = stored.filter(F.col("c_custkey") % 3 == 0).select(
        "job_key", F.lit("New subject").alias("email_subject"),
        F.concat(F.lit("New body for "), "job_key").alias("email_body"),
    )
    ready = postings.has_draft().alias("has_draft")
    return postings.apply_drafts(stored, drafts).select("job_key", "company", "email_subject", "email_body", ready)


# --- search --------------------------------------------------------------------------------


@query
def query_cascade(spark, sf_dir):
    return search.query_cascade(I.customer_postings(spark, sf_dir), search.family_terms(spark))


@query
def unsearchable_postings(spark, sf_dir):
    return search.split_searchable(I.customer_postings(spark, sf_dir))[1].select("job_key", "job_family")


@query
def search_payload_hits(spark, sf_dir):
    return search.parse_search_payloads(I.search_payloads(spark, sf_dir))


@query
def result_page_contacts(spark, sf_dir):
    hits = search.result_page_hits(I.result_pages(spark, sf_dir))
    return search.profile_hits(hits).select("doc_id", "hit_rank", "url", "name", "role", "source")


@query
def profile_contacts(spark, sf_dir):
    """Named profiles of API answers and of HTML result pages together."""
    api = search.parse_search_payloads(I.search_payloads(spark, sf_dir))
    html = search.result_page_hits(I.result_pages(spark, sf_dir)).withColumn(
        "job_key", F.concat(F.lit("doc"), F.col("doc_id").cast("string"))
    )
    both = search.all_hits(api, html.select(*api.columns))
    return search.profile_hits(both).select("job_key", "hit_rank", "url", "name", "role", "source")


@query
def fetch_outcomes(spark, sf_dir):
    rows = search.fetch_outcomes(I.fetch_log(spark, sf_dir))
    return rows.select("job_key", "line_no", "query_idx", "backend", "http_status", "outcome", "detail")


@query
def sticky_backends(spark, sf_dir):
    return search.sticky_backends(search.fetch_outcomes(I.fetch_log(spark, sf_dir)))


@query
def unplanned_requests(spark, sf_dir):
    """Requests whose query number is outside the plan: three lines a query, without an end."""
    log = I.fetch_log(spark, sf_dir).withColumn("query_idx", F.floor(F.col("line_no") / 3).cast("int"))
    return search.split_requests(search.fetch_outcomes(log))[1].select("job_key", "line_no", "query_idx", "outcome")


@query
def first_seen_profiles(spark, sf_dir):
    seen = search.first_seen(search.profile_hits(I.search_hits(spark, sf_dir)))
    return seen.select("job_key", "profile_key", "query_idx", "hit_rank", "name")


@query
def found_contacts(spark, sf_dir):
    used = search.sticky_backends(search.fetch_outcomes(I.fetch_log(spark, sf_dir)))
    named = search.profile_hits(search.answered_hits(I.search_hits(spark, sf_dir), used))
    found = search.capped_contacts(search.first_seen(named))
    return found.select("job_key", "contact_rank", "name", "role", "url", "source")


@query
def query_yields(spark, sf_dir):
    used = search.sticky_backends(search.fetch_outcomes(I.fetch_log(spark, sf_dir)))
    return search.query_yield(search.profile_hits(search.answered_hits(I.search_hits(spark, sf_dir), used)))


# --- addresses -------------------------------------------------------------------------------


def _mined(spark, sf_dir):
    return addresses.mined_addresses(
        I.snippets(spark, sf_dir).select("doc_id", "line_no", "title", "content", "url"),
        ["title", "content", "url"],
    )


@query
def mined_addresses(spark, sf_dir):
    return _mined(spark, sf_dir).groupBy("local", "host").agg(F.count(F.lit(1)).alias("found"))


@query
def mined_document_addresses(spark, sf_dir):
    """Addresses in the document texts, with a local-part rule that allows digit segments."""
    docs = I.table(spark, sf_dir, "documents").select("doc_id", "text")
    return addresses.mined_addresses(docs, ["text"], r"[a-z0-9]*")


def _text_domains(spark, sf_dir):
    return (
        I.table(spark, sf_dir, "documents")
        .select(F.concat("source", "lang", F.lit(".com")).alias("domain"))
        .distinct()
    )


@query
def pattern_votes(spark, sf_dir):
    return addresses.pattern_votes(_mined(spark, sf_dir), _text_domains(spark, sf_dir))


@query
def domain_patterns(spark, sf_dir):
    """Mined pattern where hyphens or dots speak for one, else a provider's listed one."""
    wanted = _text_domains(spark, sf_dir)
    votes = addresses.pattern_votes(_mined(spark, sf_dir), wanted)
    mined = addresses.top_patterns(votes).filter(F.length("domain") % 2 == 0)
    provider = wanted.withColumn(
        "pattern", I.pick(F.ascii(F.substring_index("domain", ".", 1).substr(5, 1)), "{first}", "{last}.{first}", "")
    )
    chosen = addresses.domain_patterns(wanted, mined, provider)
    return addresses.sample_addresses(chosen)


@query
def name_parts(spark, sf_dir):
    rows = N.with_first_last(I.snippets(spark, sf_dir).select("doc_id", "line_no", "name"), "name")
    return rows.select("doc_id", "line_no", "first", "last")


@query
def name_candidates(spark, sf_dir):
    """Candidate addresses of every text line's name, by one pattern or by all."""
    rows = I.snippets(spark, sf_dir).select(
        "doc_id", "line_no", "name",
        F.lit("acme.com").alias("domain"),
        I.pick(F.col("line_no"), "{f}.{last}", F.lit(None).cast("string"), "{first}{l}").alias("pattern"),
        F.array().cast("array<string>").alias("candidates"),
    )
    made = addresses.with_candidates(rows)
    return made.select("doc_id", "line_no", F.array_join("candidates", ",").alias("email"))


def _addressed(spark, sf_dir):
    texts = I.snippets(spark, sf_dir)
    hits = texts.select(
        F.col("source").alias("company"),
        (F.col("doc_id") * 1000000 + F.col("line_no")).alias("hit_rank"),
        "url",
    )
    companies = pipeline.company_run(texts, hits)
    found = texts.withColumnRenamed("source", "company").drop("name", "line")
    contacts = search.profile_hits(found.withColumn("backend", F.lit("ddg"))).select(
        "doc_id", "line_no", "company", "name", F.array().cast("array<string>").alias("candidates")
    )
    return addresses.contact_addresses(session.stored(contacts, "contacts"), companies)


@query
def contact_addresses(spark, sf_dir):
    rows = _addressed(spark, sf_dir)
    return rows.select(
        "doc_id", "line_no", "company", "domain", "pattern", F.array_join("candidates", ",").alias("email")
    )


@query
def primary_addresses(spark, sf_dir):
    rows = addresses.primary_addresses(_addressed(spark, sf_dir))
    return rows.select("doc_id", "line_no", "name", "primary_address")


@query
def address_coverage(spark, sf_dir):
    return addresses.coverage(_addressed(spark, sf_dir), ["company"])


# --- outreach ----------------------------------------------------------------------------------


@query
def capped_contacts(spark, sf_dir):
    """The newest five orders of each customer (a top-k per posting)."""
    orders = I.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return top_by(orders, ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"], K.MAX_RESULTS, "contact_rank")


@query
def outbox(spark, sf_dir):
    return outreach.outbox(
        I.order_contacts(spark, sf_dir), I.customer_postings(spark, sf_dir), sender="Sam Sender"
    )


@query
def undrafted_postings(spark, sf_dir):
    return postings.split_drafted(I.customer_postings(spark, sf_dir))[1].select("job_key", "email_subject")


@query
def outreach_summary(spark, sf_dir):
    return outreach.outreach_summary(I.order_contacts(spark, sf_dir))


@query
def numbered_contacts(spark, sf_dir):
    """Contacts with the number shown to a user."""
    rows = numbered(
        I.order_contacts(spark, sf_dir).select("job_key", "contact_rank", "name"), ["job_key"], "contact_rank", "shown_no"
    )
    return rows.select("job_key", "contact_rank", "shown_no")


@query
def delivery_labels(spark, sf_dir):
    rows = outreach.delivery_labels(I.order_contacts(spark, sf_dir))
    return rows.select("job_key", "contact_rank", "email_sent_to", "delivery")


@query
def next_patterns(spark, sf_dir):
    rows = outreach.next_pattern_report(I.order_contacts(spark, sf_dir))
    return rows.select("job_key", "contact_rank", "next_step")


def _sent(spark, sf_dir):
    contacts = session.stored(I.order_contacts(spark, sf_dir), "contacts")
    receipts = outreach.send_plan(contacts).select(
        "job_key", "contact_rank",
        F.expr(I.START).alias("sent_at"), F.col("to_address").alias("sent_to"),
    )
    return contacts, outreach.apply_receipts(contacts, receipts)


@query
def send_states(spark, sf_dir):
    rows = _sent(spark, sf_dir)[1]
    return rows.select(
        "job_key", "contact_rank", "email_sent_at", "email_sent_to",
        F.array_join("email_tried", ",").alias("tried"),
        F.col("email_bounced").cast("string").alias("email_bounced"),
    )


@query
def replaced_contacts(spark, sf_dir):
    """Contact table after the even postings had their lists replaced by the sent state."""
    before, after = _sent(spark, sf_dir)
    even = F.substr("job_key", F.lit(2)).cast("bigint") % 2 == 0
    rows = outreach.replace_contacts(before, session.stored(after.filter(even).select(*before.columns), "sent"))
    return rows.select("job_key", "contact_rank", F.array_join("email_tried", ",").alias("tried"))


@query
def contact_documents(spark, sf_dir):
    """Contact lists nested into documents, replaced, and exploded again."""
    before, after = _sent(spark, sf_dir)
    # sending adds no contacts, so the long lists are the same after it
    long = session.stored(long_keys(before, ["job_key"]), "long")

    def listed(df):
        return numbered(df.withColumnRenamed("contact_rank", "order_no"), ["job_key"], "order_no", "contact_rank", long=long).select(
            "job_key", "contact_rank", "name",
            F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("linkedin_url"),
            "candidates", F.lit("brave").alias("source"), F.lit(None).cast("timestamp").alias("found_at"),
            F.col("email_sent_at").cast("timestamp").alias("email_sent_at"),
            "email_sent_to", "email_tried", "email_bounced",
        )

    docs = I.customer_postings(spark, sf_dir).select("job_key", "company").join(
        writers.nested_contacts(listed(before)), "job_key"
    )
    new = writers.nested_contacts(listed(after.filter(F.substr("job_key", F.lit(2)).cast("bigint") % 2 == 0)))
    rows = readers.contacts_from_docs(writers.upsert_contacts(docs, new))
    return rows.select(
        "job_key", "contact_rank", "name", F.array_join("candidates", ",").alias("email"),
        F.array_join("email_tried", ",").alias("tried"), "source",
    )


# --- delivery notices ------------------------------------------------------------------------------


def _as_of(spark, sf_dir):
    return I.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()


@query
def bounce_recipients(spark, sf_dir):
    rows = reconcile.bounce_notices(I.messages(spark, sf_dir))
    return rows.select("message_id", "received_at", "address")


@query
def stored_notices(spark, sf_dir):
    """Messages written as JSON lines, read back as notices."""
    path = session.work_path(spark, "notices")
    I.messages(spark, sf_dir).withColumn("received_at", F.col("received_at").cast("timestamp")).write.json(path)
    return reconcile.bounce_notices(readers.read_notices(spark, path)).select("message_id", "address")


def _streamed_messages(spark, sf_dir):
    """Messages as JSON lines, every 97th of them broken, read as a stream and stored."""
    path, target = session.work_path(spark, "mailbox"), session.work_path(spark, "messages")
    rows = I.messages(spark, sf_dir).withColumn("received_at", F.col("received_at").cast("timestamp"))
    line = F.when(F.col("message_id") % 97 == 0, F.concat(F.lit("{broken "), F.col("message_id").cast("string")))
    rows.select(F.coalesce(line, F.to_json(F.struct(*rows.columns))).alias("value")).write.text(path)
    _finish(streams.store_stream(readers.stream_notices(spark, path, 3), target, session.work_path(spark, "progress")))
    return readers.split_notices(spark.read.parquet(target))


@query
def streamed_notices(spark, sf_dir):
    return reconcile.bounce_notices(_streamed_messages(spark, sf_dir)[0]).select("message_id", "address")


@query
def notice_quarantine(spark, sf_dir):
    return _streamed_messages(spark, sf_dir)[1]


@query
def bounced_addresses(spark, sf_dir):
    since = reconcile.cutoff(_as_of(spark, sf_dir), WEEK_MINUTES)
    return reconcile.bounced_addresses(reconcile.bounce_notices(I.messages(spark, sf_dir)), since)


@query
def newest_notices(spark, sf_dir):
    """One mailbox page: the newest 50 notices (a top-k report)."""
    rows = reconcile.newest_notices(reconcile.bounce_notices(I.messages(spark, sf_dir)))
    return rows.select("message_id", "received_at", "address")


def _reconciled(spark, sf_dir):
    since = reconcile.cutoff(_as_of(spark, sf_dir), WEEK_MINUTES)
    gone = reconcile.bounced_addresses(reconcile.bounce_notices(I.messages(spark, sf_dir)), since)
    return reconcile.check_bounces(I.event_contacts(spark, sf_dir), gone, since)


@query
def bounce_reconcile(spark, sf_dir):
    rows = _reconciled(spark, sf_dir)
    state = F.coalesce(F.col("email_bounced").cast("string"), F.lit("open"))
    return rows.select("job_key", "contact_rank", "email_sent_to", state.alias("state"))


@query
def bounce_totals(spark, sf_dir):
    return _reconciled(spark, sf_dir).groupBy("job_key").agg(
        F.count_if(outreach.bounced()).alias("bounced"), F.count(F.lit(1)).alias("contacts")
    )


# --- streams -----------------------------------------------------------------------------------------


def _events_stream(spark, sf_dir):
    return I.as_stream_events(ingest.stream_table(spark, f"{sf_dir.rstrip('/')}/events.parquet"))


def _finish(running):
    running.awaitTermination()


@query
def stream_outcomes(spark, sf_dir):
    """Every send once: bounced or delivered where its answer windows are over, pending where the stream still waits."""
    events = _events_stream(spark, sf_dir)
    sends = events.filter("kind = 'send'")
    notices = events.filter("kind = 'bounce'")
    target, progress = session.work_path(spark, "outcomes"), session.work_path(spark, "progress")
    # stored, since every batch of the stream reads it
    busy = session.stored(hot_keys(I.as_stream_events(I.table(spark, sf_dir, "events")).filter("kind = 'send'"), ["address"]), "busy")
    outcomes = streams.send_outcomes(sends, notices, STREAM_WAIT, hot=busy)
    _finish(streams.store_stream(outcomes, target, progress))
    given = spark.read.parquet(target)
    return given.unionByName(streams.open_sends(spark, progress, given)).select("send_id", "address", "outcome")


@query
def retry_events(spark, sf_dir):
    """What happens to every attempt, emitted when it happens: pending, bounced, retry or exhausted, delivered."""
    target = session.work_path(spark, "retries")
    events = retries.retry_events(_events_stream(spark, sf_dir), len(K.ADDRESS_PATTERNS), STREAM_WAIT, KEEP)
    _finish(retries.store_retries(events, target, session.work_path(spark, "progress")))
    found = retries.emitted(spark, target)
    return found.select("contact_key", "attempt", "state", F.col("at").cast("timestamp_ntz").alias("at"))


@query
def retry_states(spark, sf_dir):
    """Retry state per contact, folded from a stream of sends and bounces."""
    events = _events_stream(spark, sf_dir).filter("kind <> 'other'")
    target = session.work_path(spark, "attempts")
    _finish(streams.attempt_states(events, target, session.work_path(spark, "progress")))
    as_of = I.table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).scalar()
    attempts = streams.latest_attempts(spark, target)
    return streams.contact_states(attempts, F.lit(len(K.ADDRESS_PATTERNS)), as_of, STREAM_WAIT)


@query
def ingested_postings(spark, sf_dir):
    """Crawled pages streamed into a table that holds each canonical address once."""
    crawl = ingest.stream_table(spark, f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url")
    keyed = pages.canonical_pages(crawl).select(
        "page_id", "canonical_url", U.profile_key(F.col("canonical_url")).alias("url_key")
    )
    target = session.work_path(spark, "ingest")
    _finish(ingest.append_once(keyed, target, ["url_key"], ["page_id"], session.work_path(spark, "progress")))
    return ingest.stored_rows(spark, target)


@query
def stored_sends(spark, sf_dir):
    """Sends persisted once per (contact, attempt), however often they are delivered."""
    sends = _events_stream(spark, sf_dir).filter("kind = 'send'").select("contact_key", "attempt", "send_id")
    target = session.work_path(spark, "sends")
    keys = ["contact_key", "attempt"]
    _finish(ingest.append_once(sends, target, keys, ["send_id"], session.work_path(spark, "progress")))
    return ingest.stored_rows(spark, target)


# --- whole runs --------------------------------------------------------------------------------------


@query
def contact_run(spark, sf_dir):
    """Search hits to contacts with addresses, one posting per document."""
    docs = I.table(spark, sf_dir, "documents")
    jobs = docs.select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("job_key"),
        F.col("source").alias("company"),
    )
    texts = I.snippets(spark, sf_dir)
    hits = texts.select(
        F.col("source").alias("company"),
        (F.col("doc_id") * 1000000 + F.col("line_no")).alias("hit_rank"),
        "url",
    )
    rows = pipeline.contact_run(
        jobs, I.search_hits(spark, sf_dir), I.fetch_log(spark, sf_dir),
        pipeline.company_run(texts, hits), F.expr("timestamp'2024-01-01 00:00:00Z'"),
        save=lambda found: session.stored(found, "found"),
    )
    return rows.select("job_key", "contact_rank", "name", "source", F.array_join("candidates", ",").alias("email"))


def _posting_run(spark, sf_dir):
    """Pages of all platforms, with model answers that are missing, repeated or broken."""
    crawled = readers.read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet")
    lever = I.lever_pages(spark, sf_dir)
    board = I.broken_payloads(I.ats_payloads(spark, sf_dir))
    asked = pages.canonical_pages(crawled).select("canonical_url", F.col("page_id").alias("no"))
    for more in (lever, board):
        asked = asked.unionByName(pages.canonical_pages(more).select("canonical_url", F.col("doc_id").alias("no")))
    return pipeline.posting_run(
        crawled.select("url", "html").unionByName(lever.select("url", "html")),
        I.posting_answers(asked), F.expr(I.START), board.select("url", "body"),
    )


@query
def posting_run(spark, sf_dir):
    return _posting_run(spark, sf_dir)[0].drop("email_subject", "email_body", "scraped_at")


@query
def posting_quarantine(spark, sf_dir):
    return _posting_run(spark, sf_dir)[1]


@query
def send_run(spark, sf_dir):
    """One posting per user, each event a contact: bounce check, then the outbox."""
    contacts, jobs = I.user_contacts(spark, sf_dir)
    out = pipeline.send_run(contacts, jobs, I.messages(spark, sf_dir), _as_of(spark, sf_dir), WEEK_MINUTES)[1]
    return out.select("job_key", "contact_rank", "send_no", "to_address", "subject", "body", "attempt", "attempt_label")
