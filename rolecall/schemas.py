"""Table shapes, as DDL."""

HEADERS = "array<struct<name:string,value:string>>"

CONTACT = (
    "name string, title string, linkedin_url string, candidates array<string>, source string,"
    " found_at timestamp, email_sent_at timestamp, email_sent_to string,"
    " email_tried array<string>, email_bounced boolean"
)
CONTACTS = f"job_key string, contact_rank int, {CONTACT}"

# the stored form keeps candidates as one comma-joined string
STORED_CONTACT = CONTACT.replace("candidates array<string>", "email string")
_STORED_STRUCT = ",".join(
    f"{name}:{kind}" for name, kind in (f.split(" ", 1) for f in STORED_CONTACT.split(", "))
)

POSTING = (
    "url string, platform string, job_title string, company string, job_family string,"
    " location string, description string, email_subject string, email_body string,"
    " scraped_at timestamp"
)
POSTINGS = f"job_key string, {POSTING}"
POSTING_DOCS = f"{POSTINGS}, part int, recruiters array<struct<{_STORED_STRUCT}>>"
# keys of a stored document that are no fields of it
REST = "map<string,variant>"

NOTICES = f"message_id bigint, received_at timestamp, sender string, headers {HEADERS}"
PAGES = "page_id bigint, url string, html string"
FETCH_LOG = "job_key string, query_idx int, backend string, http_status int, body string"
