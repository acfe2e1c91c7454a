"""Format-preserving pseudonyms for personal numbers and dates, by keyed Feistel networks in plain SQL functions.

Candidates are found by one pattern at every place where one may begin. Cards, IBANs and phones may be followed by
further digits or capitals, so of a candidate all ends at separators are tried: first the length that its issuer or
country has, then the longest (phones: one that does not run into a date). The first that validates is the value, and
the search goes on behind it. Of phones only those of country code 1 have a known length; digits after others count
as theirs up to 15. They are validated: payment cards (Luhn), IBANs (remainder mod 97), phone
numbers (+ and 8 to 15 digits), US social security numbers (areas, groups and serials that are given out), IPv4
addresses, and calendar dates from 1900 to 2099 (ISO, or day first with dots or slashes). A valid value is
permuted within the values of its kind under a secret key, on its digits alone, and written in the form in which
it stood: a card stays a card of as many digits with a right check digit, a date stays a date. Equal values get
equal pseudonyms in every document and every way of writing, and different values different ones. Whatever does
not validate stays as it is.

Every network alternates between the two parts of a value, adding to one a keyed hash of the other, modulo the
part's range; so each is a permutation of its whole domain. Null text stays null, empty text empty; texts of any
length are treated whole. Rows that repeat have results that repeat, empty tables none. Columns of the table that
clash with names used inside play no part. One pass, no shuffle, no Python.

Out of scope: dates with the month first (12/31/1999) or without a century, phones without a country code
((555) 123-4567), IPv6, names, addresses, e-mails and secrets, which are no numbers or dates of one format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import no_clash

ROUNDS = 10
#: First day and number of days of the date domain: 150 x 487 days, 1900-01-01 to 2100-01-01.
DATE_FROM, DATE_PARTS = "1900-01-01", (150, 487)
#: Social security numbers: 898 areas (not 000, 666, 900 and up), 99 groups x 9999 serials.
SSN_PARTS = (898, 99 * 9999)
#: Country codes by length; all that follow neither are three digits long.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

#: Up to four digits of a phone, with a separator and brackets. It keeps the digits that it has taken, so that a run of digits
#: is cut in one way only and long runs fail at once. A phone has ten such groups at most, and three digits or more.
_GROUP = r"(?:[ .-]?\(?\d{1,4}+\)?)"
_PATTERNS = {
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "iso": r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])",
    "day_first": r"(?<![\d./])\d{2}([./])\d{2}\1\d{4}(?![\d/])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "phone": rf"\+\d(?:[ .-]?\(?\d{{2,4}}+\)?{_GROUP}{{0,9}}|[ .-]?\(?\d(?!\d)\)?{_GROUP}{{1,9}})(?!\d)",
    "card": r"(?<![\d+])(?:\d[ -]?){12,18}\d(?![\d])",
}
#: Group numbers don't carry over into the alternation, so the date's separator is spelled out there.
PATTERN = "(?=[0-9+A-Z])(?=(" + "|".join(p.replace(r"([./])\d{2}\1", r"(?:\.\d{2}\.|/\d{2}/)") for p in _PATTERNS.values()) + "))"
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
#: What a phone's run ends with where it has gone into a date.
INTO_DATE = r"(?:[ .-](?:19|20)\d{2}-\d{2}(?:-\d{2})?|[ .-]\d{2}[./]\d{2}[./](?:19|20)\d{2})$"


def _long(x) -> Column:
    return (F.lit(x) if isinstance(x, (int, str)) else x).cast("long")


def feistel(a: Column, b: Column, m: Column, n: Column, tweak: Column, key: str) -> Column:
    """Struct (a, b): a permutation of [0, m) x [0, n) for every key and tweak."""

    def hashed(r: Column, x: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), x.cast("string")), 256), 1, 15), 16, 10).cast("long")

    def step(s: Column, r: Column) -> Column:
        left = F.struct(F.pmod(s["a"] + hashed(r, s["b"]), m).alias("a"), s["b"].alias("b"))
        right = F.struct(s["a"].alias("a"), F.pmod(s["b"] + hashed(r, s["a"]), n).alias("b"))
        return F.when(r % 2 == 0, left).otherwise(right)

    start = F.struct(_long(a).alias("a"), _long(b).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def permuted_digits(digits: Column, kind: str, key: str) -> Column:
    """As many digits, permuted; up to 36 of them. Empty stays empty."""
    u = F.floor(F.length(digits) / 2).cast("int")
    v = F.length(digits) - u
    a, b = F.concat(F.lit("0"), F.left(digits, u)), F.concat(F.lit("0"), F.right(digits, v))
    out = feistel(a, b, _power(u), _power(v), F.concat(F.lit(kind), F.length(digits).cast("string")), key)
    pad = lambda x, n: F.when(n == 0, F.lit("")).otherwise(F.lpad(x.cast("string"), n, "0"))
    return F.transform(F.array(out), lambda s: F.concat(pad(s["a"], u), pad(s["b"], v)))[0]


def only_digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def luhn_sum(digits: Column, doubled_first: int) -> Column:
    """Sum of the digits from the right, every second one doubled; doubled_first 0 or 1: the place where doubling starts."""
    n = F.length(digits)

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return s + F.when(i % 2 == doubled_first, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def remainder_97(text: Column) -> Column:
    """Of capitals and digits read as one number, A as 10 to Z as 35."""

    def add(s: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (s * 10 + code - 48) % 97).otherwise((s * 100 + code - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: F.when(c == "", s).otherwise(add(s, c)))


def refilled(form: Column, digits: Column) -> Column:
    """form with its digits, from left to right, replaced by digits."""
    n = F.length(form)

    def put(i: Column) -> Column:
        c = F.substring(form, i, F.lit(1))
        return F.when(c.rlike(r"^\d$"), F.substring(digits, F.length(only_digits(F.substring(form, F.lit(1), i))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), n), put), "")


def _card(m: Column, key: str) -> Column:
    digits = only_digits(m)
    n = F.length(digits)
    body = F.concat(F.left(digits, F.lit(1)), permuted_digits(F.substring(digits, F.lit(2), n - 2), "card", key))
    check = F.pmod(10 - luhn_sum(body, 0) % 10, F.lit(10)).cast("string")
    return F.when(_is_card(m), refilled(m, F.concat(body, check)))


def _is_card(m: Column) -> Column:
    digits = only_digits(m)
    return F.length(digits).between(13, 19) & (luhn_sum(digits, 1) % 10 == 0)


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    n = F.length(plain)
    bban = F.substring(plain, F.lit(5), n - 4)
    permuted = refilled(bban, permuted_digits(only_digits(bban), "iban", key))
    check = F.lpad((98 - remainder_97(F.concat(permuted, F.left(plain, F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
    return F.when(_is_iban(m), refilled(m, F.concat(check, only_digits(permuted))))


def _is_iban(m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    n = F.length(plain)
    return n.between(15, 34) & (remainder_97(F.concat(F.substring(plain, F.lit(5), n - 4), F.left(plain, F.lit(4)))) == 1)


def _phone(m: Column, key: str) -> Column:
    digits = only_digits(m)
    code = F.regexp_extract(digits, COUNTRY, 1)
    rest = F.substring(digits, F.length(code) + 1, F.length(digits))
    return F.when(F.length(digits).between(8, 15), refilled(m, F.concat(code, permuted_digits(rest, "phone", key))))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    right = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    a = F.when(area < 666, area - 1).otherwise(area - 2)
    out = feistel(a, (group - 1) * 9999 + serial - 1, _long(SSN_PARTS[0]), _long(SSN_PARTS[1]), F.lit("ssn"), key)
    number = lambda s: F.format_string("%03d-%02d-%04d", F.when(s["a"] < 665, s["a"] + 1).otherwise(s["a"] + 2), F.floor(s["b"] / 9999) + 1, s["b"] % 9999 + 1)
    return F.when(right, F.transform(F.array(out), number)[0])


def _ipv4(m: Column, key: str) -> Column:
    part = lambda i: F.split(m, r"\.")[i].cast("long")
    out = feistel(part(0) * 256 + part(1), part(2) * 256 + part(3), _long(65536), _long(65536), F.lit("ipv4"), key)
    dotted = lambda s: F.format_string("%d.%d.%d.%d", F.shiftright(s["a"], 8), s["a"] % 256, F.shiftright(s["b"], 8), s["b"] % 256)
    return F.transform(F.array(out), dotted)[0]


def _date(m: Column, form: str, key: str) -> Column:
    day = F.try_to_timestamp(m, F.lit(form)).cast("date")
    n = F.datediff(day, F.lit(DATE_FROM))
    out = feistel(F.floor(n / DATE_PARTS[1]), n % DATE_PARTS[1], _long(DATE_PARTS[0]), _long(DATE_PARTS[1]), F.lit("date"), key)
    shown = lambda s: F.date_format(F.date_add(F.lit(DATE_FROM).cast("date"), (s["a"] * DATE_PARTS[1] + s["b"]).cast("int")), form)
    return F.when((n >= 0) & (n < DATE_PARTS[0] * DATE_PARTS[1]), F.transform(F.array(out), shown)[0])


def pseudonym(m: Column, key: str) -> Column:
    """What stands in for a match; null if it does not validate."""
    whole = lambda kind: m.rlike(f"^(?:{_PATTERNS[kind]})$")
    return (
        F.when(whole("iso"), _date(m, "yyyy-MM-dd", key))
        .when(m.rlike(r"^\d{2}/\d{2}/\d{4}$"), _date(m, "dd/MM/yyyy", key))
        .when(m.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), _date(m, "dd.MM.yyyy", key))
        .when(whole("ssn"), _ssn(m, key))
        .when(whole("ipv4"), _ipv4(m, key))
        .when(m.startswith("+"), _phone(m, key))
        .when(m.rlike("^[A-Z]"), _iban(m, key))
        .otherwise(_card(m, key))
    )


def value_in(m: Column) -> Column:
    """The part of a candidate, from its first character on, that is a value; null if none is."""
    size = lambda x: F.length(F.regexp_replace(x, "[^0-9A-Z]", ""))
    at = lambda i: F.substring(m, i, F.lit(1))
    ends = F.filter(F.sequence(F.lit(1), F.length(m)), lambda i: at(i).rlike("[0-9A-Z)]") & ~at(i + 1).rlike("[0-9A-Z)]"))
    parts = F.reverse(F.transform(ends, lambda i: F.left(m, i)))
    first = lambda known, parts, right: F.get(F.filter(F.concat(F.filter(parts, known), parts), right), F.lit(0))
    # cards: an issuer's usual length; a part of a run is one only if it has that or begins as cards do
    usual = F.when(m.rlike("^3[47]"), 15).when(m.rlike("^3[0689]"), 14).otherwise(16)
    card = first(lambda x: size(x) == usual, F.filter(parts, lambda x: size(x).between(13, 19) & ((x == m) | (size(x) == usual) | m.rlike("^[2-6]"))), _is_card)
    lengths = F.create_map(*(F.lit(x) for n, names in IBAN_LENGTHS.items() for c in names.split() for x in (c, n)))
    iban = first(lambda x: size(x) == F.try_element_at(lengths, F.left(m, F.lit(2))), F.filter(parts, lambda x: size(x).between(15, 34)), _is_iban)
    into = lambda x: x.rlike(INTO_DATE) | (x.rlike(r"[ .-](?:19|20)\d{2}$") & F.substr(m, F.length(x) + 1).rlike(r"^-\d{2}"))
    north_american = lambda x: x.rlike(r"^\+1") & (size(x) == 11)
    phones = F.filter(parts, lambda x: size(x).between(8, 15))
    phone = F.get(F.concat(F.filter(phones, north_american), F.filter(phones, lambda x: ~into(x)), phones), F.lit(0))
    fixed = F.lit(False)
    for kind in ("iso", "day_first", "ssn", "ipv4"):
        fixed = fixed | m.rlike(f"^(?:{_PATTERNS[kind]})$")
    return F.when(fixed, m).when(m.startswith("+"), phone).when(m.rlike("^[A-Z]"), iban).otherwise(card)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in keep, tw_text and tw_values (how many values were replaced)."""
    # a character in front, so that a candidate never stands at the very start, where split gives no empty piece
    names = no_clash(keep, (), ("tw_text", "tw_values"))
    own = [f"c{i}" for i in range(len(names))]
    found = docs.select(*(F.col(c).alias(k) for c, k in zip(names, own)), F.col(text_col).alias("tw_in"), F.regexp_extract_all(text_col, F.lit(PATTERN), F.lit(1)).alias("tw_found"))
    value = found.select(*own, "tw_in", F.transform("tw_found", value_in).alias("tw_value"))
    named = value.select(*own, "tw_in", F.transform("tw_value", lambda m: F.struct(F.coalesce(F.length(m), F.lit(0)).alias("size"), pseudonym(m, key).alias("new"))).alias("tw_new"))
    pieces = F.split(F.concat(F.lit("\n"), F.col("tw_in")), PATTERN, -1)
    placed = F.zip_with(pieces, F.concat(F.array(F.struct(F.lit(0).alias("size"), F.lit(None).cast("string").alias("new"))), "tw_new"), lambda piece, v: F.struct(piece.alias("piece"), v["size"].alias("size"), v["new"].alias("new")))
    start = F.struct(F.lit(0).alias("skip"), F.lit(0).cast("long").alias("n"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        """A candidate inside the value before it is none; the value's characters are left out of the pieces they reach into."""
        free = (s["skip"] == 0) & x["new"].isNotNull()
        gone = F.when(free, x["size"]).otherwise(s["skip"])
        text = F.concat(F.when(free, x["new"]).otherwise(F.lit("")), F.substr(x["piece"], gone + 1))
        return F.struct(F.greatest(gone - F.length(x["piece"]), F.lit(0)).alias("skip"), (s["n"] + free.cast("long")).alias("n"), F.concat(s["out"], F.array(text)).alias("out"))

    done = F.aggregate(placed, start, step, lambda s: F.struct(F.substr(F.array_join(s["out"], ""), F.lit(2)).alias("text"), s["n"].alias("n")))
    some = F.size("tw_new") > 0
    out = named.select(*own, "tw_in", F.when(some, F.transform(F.array(done), lambda s: s)).alias("tw_done"))
    return out.select(*(F.col(k).alias(c) for c, k in zip(names, own)), F.coalesce(F.col("tw_done")[0]["text"], "tw_in").alias("tw_text"), F.coalesce(F.col("tw_done")[0]["n"], F.lit(0).cast("long")).alias("tw_values"))
