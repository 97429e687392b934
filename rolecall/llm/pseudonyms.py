"""Operator 6: format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by pattern and kept only if valid: card numbers by their check digit, IBANs, in
groups of four or not, by their remainder, IPv4 addresses by octet, national identity numbers (ddd-dd-dddd) by their reserved parts, dates by
the calendar, phone numbers by their number of digits. A valid value is permuted within its own format by a
keyed Feistel network: ten rounds over two parts whose product is the size of the value's domain, each
round adding a keyed hash of one part to the other. So it is a bijection: different values stay
different, equal values stay equal in every document, separators and lengths stay, and whatever was
valid is valid again (check digits are worked out anew). An IBAN's letters and digits are permuted apart. E-mail addresses keep their domain; the
letters and the digits of the local part are permuted.

Everything is column expressions: no Python runs on the data.

Defined results: a null text stays null; invalid candidates, and all other text, stay as they are; long
texts are scanned whole, and every pattern is bounded, so a scan is linear; repeated rows, null ids,
empty tables need nothing special; all other columns are kept as they are, but that one called found is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions.stage import settled

ROUNDS = 10
#: Dates are permuted from this day on, over 17 * 4297 = 73,049 days: to 2099-12-31.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)

EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
DATE = r"(?<!\d)(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?!\d)"
IDENTITY = r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])"
#: Countries by the length of their IBANs: it tells where one in groups of four ends and the next word begins.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _grouped(n: int, countries: str) -> str:
    rest = f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""
    return rf"(?:{countries.replace(' ', '|')})\d\d(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}"


#: In groups or not where the country is known, in one piece for any other.
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d\d)(?:" + "|".join(_grouped(*x) for x in IBAN_LENGTHS.items())
    + r"|[A-Z]{2}\d\d[A-Z0-9]{11,30})(?![A-Za-z0-9])"
)
CARD = r"(?<!\d)(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d)"
PHONE = (
    r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}"
    r"|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)"
)
KINDS = {"email": EMAIL, "ip": IP, "date": DATE, "identity": IDENTITY, "iban": IBAN, "card": CARD, "phone": PHONE}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def feistel(a: Column, b: Column, a_size: Column, b_size: Column, key: str, tweak: Column) -> tuple[Column, Column]:
    """(a, b) permuted over a_size x b_size; ``tweak`` keeps formats apart."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), a_size.cast("long").alias("p"), b_size.cast("long").alias("q"))

    def step(x: Column, r: Column) -> Column:
        digest = F.sha2(F.concat_ws(":", F.lit(key), tweak, r.cast("string"), x["b"].cast("string")), 256)
        drawn = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % x["p"]
        return F.struct(x["b"].alias("a"), ((x["a"] + drawn) % x["p"]).alias("b"), x["q"].alias("p"), x["p"].alias("q"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return done["a"], done["b"]


def _pad(value: Column, width: Column) -> Column:
    text = value.cast("string")
    return F.concat(F.repeat(F.lit("0"), width - F.length(text)), text)


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A string of 1 to 36 digits as another one of the same length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")

    def size(k: Column) -> Column:
        return F.rpad(F.lit("1"), k + 1, "0").cast("long")

    def number(text: Column) -> Column:
        return F.when(text == "", _long(0)).otherwise(text.cast("long"))

    a, b = feistel(
        number(F.substring(digits, F.lit(1), left)), number(F.substring(digits, left + 1, n)),
        size(left), size(n - left), key, F.concat(F.lit(f"{kind}:"), n.cast("string")),
    )
    return F.concat(F.when(left > 0, _pad(a, left)).otherwise(F.lit("")), _pad(b, n - left))


def permuted_letters(letters: Column, key: str, kind: str) -> Column:
    """A string of small letters as another one of the same length."""
    # letters in runs of up to six, each a number in base 26; neighbours are permuted together
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(letters) / 12) - 1, F.lit(0)).cast("int")), lambda i: F.substring(letters, i * 12 + 1, F.lit(12)))

    def number(text: Column) -> Column:
        return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), _long(0), lambda s, c: s * 26 + (F.ascii(c) - 97))

    def letters_of(value: Column, width: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(width, F.lit(1)))
        drawn = F.aggregate(
            places, F.struct(value.alias("v"), F.lit("").alias("t")),
            lambda s, i: F.struct(F.floor(s["v"] / 26).cast("long").alias("v"), F.concat(F.chr((s["v"] % 26 + 97).cast("long")), s["t"]).alias("t")),
        )["t"]
        return F.when(width > 0, drawn).otherwise(F.lit(""))

    def power(width: Column) -> Column:
        return F.aggregate(F.slice(F.array_repeat(F.lit(26), 12), F.lit(1), width), _long(1), lambda s, x: s * x)

    def run(text: Column, at: Column) -> Column:
        n = F.length(text)
        left = F.floor(n / 2).cast("int")
        a, b = feistel(
            number(F.substring(text, F.lit(1), left)), number(F.substring(text, left + 1, n)), power(left), power(n - left),
            key, F.concat(F.lit(f"{kind}:"), n.cast("string"), F.lit(":"), at.cast("string")),
        )
        return F.concat(letters_of(a, left), letters_of(b, n - left))

    return F.array_join(F.transform(runs, run), "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(shape: Column, pattern: str, fresh: Column) -> Column:
    """``shape`` with its characters of a class replaced, in order, by those of ``fresh``."""
    def char(i: Column) -> Column:
        own = F.substring(shape, i, F.lit(1))
        seen = F.length(F.regexp_replace(F.substring(shape, F.lit(1), i), f"[^{pattern}]", ""))
        return F.when(own.rlike(f"[{pattern}]"), F.substring(fresh, seen, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), char), "")


def _weighted(digits: Column, odd: int) -> Column:
    """Luhn sum; every second digit from the right is doubled, starting at place ``odd``."""
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == odd, twice).otherwise(d)

    places = F.split(F.reverse(digits), "")
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda s, x: s + x)


def luhn_valid(digits: Column) -> Column:
    return _weighted(digits, 1) % 10 == 0


def _card(match: Column, key: str) -> Column:
    digits = _digits(match)
    body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = (10 - _weighted(body, 0) % 10) % 10
    return F.when(luhn_valid(digits), _refill(match, "0-9", F.concat(body, check.cast("string")))).otherwise(match)


def _remainder(country: Column, body: Column) -> Column:
    """Remainder by 97 of the account part and the country, letters as numbers, followed by a check of 00."""
    def step(s: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        return (s * F.when(letter, 100).otherwise(10) + F.ascii(c) - F.when(letter, 55).otherwise(48)) % 97

    return F.aggregate(F.split(F.concat(body, country, F.lit("00")), ""), F.lit(0), step)


def iban_valid(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    return (98 - _remainder(F.substring(plain, 1, 2), F.substring(plain, 5, 40))) == F.substring(plain, 3, 2).cast("int")


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, as the element of a one-row list."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _iban(match: Column, key: str) -> Column:
    country, shape = F.substring(match, 1, 2), F.substring(match, 5, 60)
    digits, letters = _digits(shape), F.regexp_replace(shape, "[^A-Z]", "")
    numbers = F.when(digits == "", digits).otherwise(permuted_digits(digits, key, "iban"))
    drawn = F.when(letters == "", letters).otherwise(F.upper(permuted_letters(F.lower(letters), key, "iban")))

    def filled(new: Column) -> Column:
        return _once(_refill(shape, "0-9", new["digits"]), lambda x: _refill(x, "A-Z", new["letters"]))

    def checked(fresh: Column) -> Column:
        check = _pad(98 - _remainder(country, F.replace(fresh, F.lit(" "), F.lit(""))), F.lit(2))
        return F.concat(country, check, fresh)

    # what only looks like one may hold a card number
    card = F.regexp_extract(match, CARD, 0)
    other = F.when(card == "", match).otherwise(_once(card, lambda c: F.replace(match, c, _card(c, key))))
    new = F.struct(numbers.alias("digits"), drawn.alias("letters"))
    return F.when(iban_valid(match), _once(_once(new, filled), checked)).otherwise(other)


def _ip(match: Column, key: str) -> Column:
    octets = F.transform(F.split(match, r"\."), lambda o: o.cast("int"))
    valid = ~F.exists(octets, lambda o: o > 255)
    pair = lambda i: octets[i] * 256 + octets[i + 1]
    size = F.lit(65536)
    a, b = feistel(pair(0), pair(2), size, size, key, F.lit("ip"))
    parts = [F.floor(a / 256), a % 256, F.floor(b / 256), b % 256]
    return F.when(valid, F.concat_ws(".", *[p.cast("string") for p in parts])).otherwise(match)


def _date(match: Column, key: str) -> Column:
    shapes = {r"^\d{4}-": "yyyy-MM-dd", r"^\d\d/": "dd/MM/yyyy", r"^\d\d\.": "dd.MM.yyyy"}
    out = match
    for start, shape in shapes.items():
        day = F.try_to_timestamp(match, F.lit(shape)).cast("date")
        if shape == "dd/MM/yyyy":  # or the month first, where the day cannot be
            day = F.coalesce(day, F.try_to_timestamp(match, F.lit("MM/dd/yyyy")).cast("date"))
            month_first = F.try_to_timestamp(match, F.lit(shape)).isNull()
        at = F.datediff(day, F.to_date(F.lit(FIRST_DAY)))
        a, b = feistel(F.floor(at / DAYS[1]), at % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, F.lit("date"))
        fresh = F.date_add(F.to_date(F.lit(FIRST_DAY)), (a * DAYS[1] + b).cast("int"))
        written = F.date_format(fresh, shape)
        if shape == "dd/MM/yyyy":
            written = F.when(month_first, F.date_format(fresh, "MM/dd/yyyy")).otherwise(written)
        valid = match.rlike(start) & day.isNotNull() & (at >= 0) & (at < DAYS[0] * DAYS[1])
        out = F.when(valid, written).otherwise(out)
    return out


def _identity(match: Column, key: str) -> Column:
    area, group, serial = (F.substring(match, s, n).cast("int") for s, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)  # 0 to 897
    a, b = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("identity"))
    new_area = F.floor(a / 99)
    new_area = F.when(new_area >= 665, new_area + 2).otherwise(new_area + 1)
    parts = F.concat_ws("-", _pad(new_area, F.lit(3)), _pad(a % 99 + 1, F.lit(2)), _pad(b + 1, F.lit(4)))
    return F.when(valid, parts).otherwise(match)


def _phone(match: Column, key: str) -> Column:
    digits = _digits(match)
    n = F.length(digits)
    own = F.least(n, F.lit(10))
    fresh = F.concat(F.substring(digits, F.lit(1), n - own), permuted_digits(F.substring(digits, n - own + 1, own), key, "phone"))
    return F.when(n.between(9, 15), _refill(match, "0-9", fresh)).otherwise(match)


def _email(match: Column, key: str) -> Column:
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    digits = _digits(local)
    letters = F.regexp_replace(F.lower(local), "[^a-z]", "")
    fresh = permuted_letters(letters, key, "email")
    own = F.when(letters == "", local).otherwise(_refill(F.lower(local), "a-z", fresh))
    head, tail = F.substring(digits, 1, 18), F.substring(digits, 19, 36)
    tail = F.when(tail == "", F.lit("")).otherwise(permuted_digits(F.substring(tail, 1, 36), key, "email-tail"))
    numbers = F.concat(permuted_digits(head, key, "email"), tail, F.substring(digits, 55, 64))
    own = F.when(digits == "", own).otherwise(_refill(own, "0-9", numbers))
    return F.concat(own, F.lit("@"), domain)


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "identity": _identity, "iban": _iban, "card": _card, "phone": _phone}


def pseudonym(match: Column, key: str) -> Column:
    """A found value's pseudonym; the value itself if it is not valid."""
    out = match
    for kind in reversed(list(KINDS)):
        out = F.when(match.rlike(f"^(?:{KINDS[kind]})$"), _MAKERS[kind](match, key)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with the column's personal values replaced, and ``found``: array of struct(kind, at, size,
    value, pseudonym) with code point places in the original text.

    ``at`` starts from 0. ``found`` holds the original values: keep it apart, as a key is kept.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    text = F.col(f"_row.`{column}`")
    # texts with neither a digit nor an at sign hold nothing to find
    none = F.array().cast("array<string>")
    some = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)
    rows = settled(rows.withColumn("_matches", F.coalesce(some, none)), "_matches")
    def kind(m: Column, k: str) -> Column:
        return F.when(iban_valid(m), F.lit(k)).otherwise(F.lit("card")) if k == "iban" else F.lit(k)

    kinds = F.transform("_matches", lambda m: F.coalesce(*[F.when(m.rlike(f"^(?:{p})$"), kind(m, k)) for k, p in KINDS.items()]))
    rows = settled(
        rows.withColumn("_between", F.when(F.size("_matches") > 0, F.split(text, ANY, -1)).otherwise(F.array(text)))
        .withColumn("_new", F.transform("_matches", lambda m: pseudonym(m, key))).withColumn("_kinds", kinds),
        "_between", "_new", "_kinds",
    )
    places = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size("_matches"), F.lit(1))),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda s, i: F.struct(
            (s["at"] + F.length(F.get("_between", i - 1)) + F.length(F.get("_matches", i - 1))).alias("at"),
            F.concat(s["all"], F.array(s["at"] + F.length(F.get("_between", i - 1)))).alias("all"),
        ),
    )["all"]
    joined = F.array_join(F.transform("_between", lambda b, i: F.concat(b, F.coalesce(F.get("_new", i), F.lit("")))), "")
    found = F.filter(
        F.transform("_matches", lambda m, i: F.struct(
            F.get("_kinds", i).alias("kind"), F.get("_places", i).alias("at"), F.length(m).alias("size"),
            m.alias("value"), F.get("_new", i).alias("pseudonym"),
        )),
        lambda x: x["value"] != x["pseudonym"],
    )
    rows = rows.withColumn("_places", F.when(F.size("_matches") > 0, places))
    columns = [
        F.when(F.size("_matches") > 0, joined).otherwise(text).alias(c) if c == column else F.col(f"_row.`{c}`")
        for c in docs.columns if c != "found"
    ]
    return rows.select(*columns, found.alias("found"))
