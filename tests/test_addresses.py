import random
import re

from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions import names as N
from rolecall.operators import addresses, domains


def votes_of(text, domain):
    found = re.findall(
        r"\b([a-z][a-z0-9]*(?:[.\-][a-z][a-z0-9]*)*)@" + re.escape(domain) + r"\b", text, flags=re.I
    )
    votes = {}
    for local in map(str.lower, found):
        if local.count(".") > 1:
            continue
        if "." in local:
            p = "{f}.{last}" if local.index(".") == 1 else "{first}.{last}"
        elif "-" in local:
            p = "{first}.{last}"
        else:
            p = "{f}{last}" if len(local) <= 5 else "{first}{last}"
        votes[p] = votes.get(p, 0) + 1
    return votes


def test_mining_and_votes_against_brute_force(spark):
    rng = random.Random(17)
    wanted = ["acme.com", "me.com", "acme.co", "x-y.io"]
    locals_ = ["jane.doe", "j.doe", "jdoe", "Jane-Doe", "janedoe", "a.b.c", "hein.19", "éan.le", "_x", "9abc", "x+tag", ""]
    hosts = ["acme.com", "acme.com.br", "mail.acme.com", "ACME.com", "acme.company", "acme.com,", "acme.com-x", "x-y.io", "acme.co"]
    around = [" ", "\n", "(", "<", "", "é", ", "]
    rows = []
    for _ in range(800):
        text = "".join(
            rng.choice(around) + rng.choice(locals_) + "@" + rng.choice(hosts) + rng.choice([" ", ">", ". ", "\t"])
            for _ in range(rng.randrange(1, 4))
        )
        rows.append((text, rng.choice(["", "nothing"]), None))
    df = spark.createDataFrame(rows, "title string, content string, url string")
    mined = addresses.mined_addresses(df, ["title", "content", "url"])
    asked = spark.createDataFrame([(d,) for d in wanted], "domain string")
    got = {(r.domain, r.pattern): r.votes for r in addresses.pattern_votes(mined, asked).collect()}
    expected = {}
    for text, _, _ in rows:
        for domain in wanted:
            for pattern, n in votes_of(text, domain).items():
                expected[domain, pattern] = expected.get((domain, pattern), 0) + n
    assert got == expected


def test_pattern_ties_and_sources(spark):
    votes = spark.createDataFrame(
        [("a.com", "{f}{last}", 2), ("a.com", "{first}.{last}", 2), ("b.com", "{first}{last}", 3), ("b.com", "{f}{last}", 1)],
        "domain string, pattern string, votes bigint",
    )
    mined = addresses.top_patterns(votes)
    assert {(r.domain, r.pattern) for r in mined.collect()} == {("a.com", "{first}.{last}"), ("b.com", "{first}{last}")}
    provider = spark.createDataFrame(
        [("a.com", "{first}"), ("c.com", "{first}"), ("d.com", "{last}.{first}"), ("e.com", "")], "domain string, pattern string"
    )
    asked = spark.createDataFrame([(d + ".com",) for d in "abcdef"], "domain string")
    got = {r.domain[0]: r.pattern for r in addresses.domain_patterns(asked, mined, provider).collect()}
    assert got == {"a": "{first}.{last}", "b": "{first}{last}", "c": "{first}", "d": None, "e": None, "f": None}


def test_domain_votes(spark):
    rows = [
        ("acme", 0, "https://boards.greenhouse.io/acme"), ("acme", 1, "https://blog.acme.com/x"),
        ("acme", 2, "https://other.com"), ("acme", 3, "https://www.other.com/y"), ("acme", 4, "https://acme.com"),
        ("bee", 7, "https://z.com"), ("bee", 2, "https://y.com"), ("cee", 0, "no-scheme.com"),
        ("uk", 0, "https://www.acme.co.uk"),
    ]
    hits = spark.createDataFrame(rows, "company string, hit_rank int, url string")
    top = {r.company: (r.domain, r.votes) for r in domains.top_domains(domains.domain_votes(hits)).collect()}
    assert top == {"acme": ("acme.com", 2), "bee": ("y.com", 1), "uk": ("co.uk", 1)}


def test_domain_tiers(spark):
    def tier(rows):
        return spark.createDataFrame(rows, "company string, domain string")

    companies = spark.createDataFrame([(c,) for c in "abcd"], "company string")
    got = domains.company_domains(
        companies, tier([("a", "one.com"), ("b", "")]), tier([("a", "two.com"), ("b", "two.com"), ("c", None)]),
        tier([("c", "three.com")]),
    )
    assert {(r.company, r.domain, r.tier) for r in got.collect()} == {
        ("a", "one.com", 1), ("b", "two.com", 2), ("c", "three.com", 3), ("d", None, None)
    }


def test_contact_addresses(spark):
    contacts = spark.createDataFrame(
        [("acme", "Jane Doe", []), ("acme", "Madonna", ["old@x.com"]), ("none", "Jane Doe", ["old@x.com"]),
         ("six", "Jane Doe, MBA", []), (None, "Jane Doe", [])],
        "company string, name string, candidates array<string>",
    )
    facts = spark.createDataFrame(
        [("acme", "acme.com", "{f}{last}"), ("six", "six.com", None)], "company string, domain string, pattern string"
    )
    got = addresses.contact_addresses(contacts, facts)
    by = {(r.company, r.name): r.candidates for r in got.collect()}
    assert by["acme", "Jane Doe"] == ["jdoe@acme.com"]
    assert by["acme", "Madonna"] == ["old@x.com"] and by["none", "Jane Doe"] == ["old@x.com"]
    assert by["six", "Jane Doe, MBA"][0] == "jane.doe@six.com" and len(by["six", "Jane Doe, MBA"]) == 6
    assert by[None, "Jane Doe"] == []
    assert got.filter(~F.size("candidates").isin(0, 1, len(K.ADDRESS_PATTERNS))).count() == 0
    first = {(r.company, r.name): r.primary_address for r in addresses.primary_addresses(got).collect()}
    assert len(first) == 4 and first["acme", "Jane Doe"] == "jdoe@acme.com"
    total = addresses.coverage(got.fillna("?", ["company"]), ["company"]).filter("company = 'acme'").collect()[0]
    assert (total.contacts, total.with_address) == (2, 2)


def test_long_words_and_names(spark):
    words = {"dotted": "a." * 500_000 + "a@acme.com", "broken": "a." * 500_000 + "1@acme.com", "plain": "x jo.do@acme.com"}
    rows = spark.createDataFrame(list(words.items()), "name string, text string")
    found = {r["name"]: len(r["local"]) for r in addresses.mined_addresses(rows, ["text"]).collect()}
    assert found == {"dotted": 1_000_001, "plain": 5}
    name = "Jane Doe, " + "PhD " * 250_000
    split = N.with_first_last(spark.createDataFrame([(name.strip(),)], "name string"), "name").collect()
    assert len(split) == 1
