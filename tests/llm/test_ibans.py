"""IBANs with letters and in groups, and addresses and phone numbers written in less usual ways."""

import re

from rolecall.llm import pseudonyms


def _valid(iban):
    plain = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _luhn(number):
    digits = [int(c) for c in reversed(re.sub(r"\D", "", number))]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_found_and_valid_again(spark):
    ibans = [
        "GB82WEST12345698765432", "NL91ABNA0417164300", "FR1420041010050500013M02606", "DE89370400440532013000",
        "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "BE68 5390 0754 7034", "MT84MALT011000012345MTLCAST001S",
        "FR14 2004 1010 0505 0001 3M02 606", "NO93 8601 1117 947",
    ]
    others = ["_joe@example.com", "+tag.joe@example.com", "555 123 4567"]
    texts = [f"pay {v} BIC COBA and then 12 more" for v in ibans] + [f"ask {v} now" for v in others]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sorted(pseudonyms.pseudonymised(df, "k").collect())
    for row, value in zip(out, ibans + others, strict=True):
        (found,) = row.found
        assert found.value == value and found.pseudonym != value and value not in row.text
        shape = [("d" if c.isdigit() else "l" if c.isalpha() else c) for c in value]
        assert shape == [("d" if c.isdigit() else "l" if c.isalpha() else c) for c in found.pseudonym]
        if value in ibans:
            assert found.kind == "iban" and _valid(found.pseudonym) and found.pseudonym[:2] == value[:2]
    by_value = {r.found[0].value: r.found[0].pseudonym for r in out}
    for one, grouped in (("DE89370400440532013000", "DE89 3704 0044 0532 0130 00"), ("GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32")):
        assert by_value[grouped].replace(" ", "") == by_value[one]


def test_card_beside_what_is_no_iban(spark):
    texts = ["NO12 4785 3805 9239 1139", "GB12 4785 3805 9239 1139 00", "DE88 3704 0044 0532 0130 00", "XY12ABCDEFG4785380592391139"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sorted(pseudonyms.pseudonymised(df, "k").collect())
    for row, text in zip(out, texts, strict=True):
        if text.startswith("DE88"):
            assert row.text == text and not row.found
        else:
            assert [f.kind for f in row.found] == ["card"] and "4785" not in row.text.replace(" ", "")[4:8]
            number = re.search(r"(?:\d{4} ){3}\d{4}|\d{16}", row.text[4:]).group()
            assert _luhn(number) and row.text[:4] == text[:4]
