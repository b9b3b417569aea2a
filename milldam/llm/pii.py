"""Personal data: format-preserving Feistel pseudonyms, with DataFrame functions only.

Emails, phone numbers, card numbers, social security numbers, IP addresses, dates and hexadecimal secrets are found by
pattern and validated: a card number's check digit is right, an international phone number has a country's code, a social
security number has an area, group and serial that are given out, a date is in the calendar. Each is then permuted
within its format by a keyed Feistel network. So a card number becomes one with a right check digit, a social security
number a valid one, a date a date of the same 400 years, an address a valid address, and equal values become equal
pseudonyms in all documents, whatever they are written with between the digits. What is not valid stays as it is. A mail's
domain stays as well, and so does a phone's country code. The permutation can be undone with the key.

The network alternates over two halves of the value's letters: each letter of one half is shifted, within its own
alphabet, by a number drawn from SHA-256 of key, kind, round and other half. Addresses and dates are permuted as
numbers, over 2^16 x 2^16 and 189 x 773 (the days of 400 years).

Defined results: null stays null, empty stays empty, texts without a match are returned as they are; of patterns that begin at
one place the first in the list counts; repeated rows are treated alike; whole texts are looked through, whatever their
length; an empty table gives an empty table; extra columns pass through; columns with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ROUNDS = 8
#: Used where the session does not set spark.milldam.pseudonyms.key; for trials only.
DEMONSTRATION = "demonstration key"
# Country calling codes; of those with three digits the zones, as nearly all codes in them are in use.
_COUNTRIES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|(?:2[1-689]|35|37|38|42|50|59|6[789]|80|85|87|88|96|97|99)[0-9]"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What is looked for, in this order where several begin at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9]{0,63}[A-Fa-f])(?=[A-Fa-f]{0,63}[0-9])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
    "phone": rf"(?<![0-9A-Za-z+])\+(?={_COUNTRIES})[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)[ .-]?)?[0-9]{{2,4}}(?:[ .-]?[0-9]{{2,4}}){{1,4}}(?![0-9A-Za-z])|(?<![0-9A-Za-z])\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}(?![0-9A-Za-z])|(?<![0-9A-Za-z.-])[0-9]{{3}}(?<dot>[.-])[0-9]{{3}}\k<dot>[0-9]{{4}}(?![0-9A-Za-z-])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])",
    "address": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "social": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "number": r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?<four>[ -])[0-9]{4}\k<four>[0-9]{4}\k<four>[0-9]{4}|[0-9]{4}(?<six>[ -])[0-9]{6}\k<six>[0-9]{5})(?![0-9A-Za-z]|[.-][0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these has no match; looking for them is cheaper.
HINT = r"@|[0-9]{3}|[0-9][./-][0-9]|[0-9A-Fa-f]{32}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds a value so that it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def drawn(key: str, kind: str, k: Column, seen: Column, i: Column) -> Column:
    """A number under 65536 for round k and place i, from the other half."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), k.cast("string"), seen, F.floor(i / 16).cast("string")).cast("binary"), 256)
    return F.conv(F.substr(digest, i % 16 * 4 + 1, F.lit(4)), 16, 10).cast("int")


def spelled(half: Column) -> Column:
    return F.array_join(F.transform(half, lambda x: x.cast("string")), ",")


def feistel(values: Column, radix: Column, key: str, kind: str) -> Column:
    """Permutes an array of numbers, each under its radix, within the arrays of these radixes."""

    def shifted(half: Column, other: Column, radixes: Column, k: Column) -> Column:
        return let(spelled(other), lambda seen: F.transform(half, lambda x, i: ((x + drawn(key, kind, k, seen, i)) % radixes[i]).cast("int")))

    def step(s: Column, k: Column) -> Column:
        even = k % 2 == 0
        return F.struct(
            F.when(even, shifted(s.l, s.r, s.rl, k)).otherwise(s.l).alias("l"),
            F.when(even, s.r).otherwise(shifted(s.r, s.l, s.rr, k)).alias("r"),
            s.rl.alias("rl"),
            s.rr.alias("rr"),
        )

    def whole(v: Column, r: Column) -> Column:
        h, n = F.floor(F.size(v) / 2).cast("int"), F.size(v)
        start = F.struct(F.slice(v, 1, h).alias("l"), F.slice(v, h + 1, n - h).alias("r"), F.slice(r, 1, h).alias("rl"), F.slice(r, h + 1, n - h).alias("rr"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s.l, s.r))

    return let(values, lambda v: let(radix, lambda r: whole(v, r)))


def digits(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda c: c.cast("int"))


def refilled(template: Column, values: Column, alphabet: str, render: Callable[[Column, Column], Column]) -> Column:
    """The template with the letters of an alphabet replaced, one after another, by the rendered values."""

    def step(s: Column, c: Column, v: Column) -> Column:
        hit = c.rlike(alphabet)
        return F.struct(F.concat(s.text, F.when(hit, render(v[s.i], c)).otherwise(c)).alias("text"), (s.i + hit.cast("int")).alias("i"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("i"))
    return let(values, lambda v: F.aggregate(F.split(template, ""), start, lambda s, c: step(s, c, v), lambda s: s.text))


def as_digit(v: Column, _: Column) -> Column:
    return v.cast("string")


def by_digits(text: Column, key: str, kind: str) -> Column:
    d = digits(text)
    return refilled(text, feistel(d, F.transform(d, lambda _: F.lit(10)), key, kind), "[0-9]", as_digit)


def by_letters(text: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """Letters and digits within their alphabets, whatever their case; hexadecimal: within 16."""
    plain = F.split(F.lower(F.regexp_replace(text, "[^0-9A-Za-z]", "")), "")
    order = F.lit("0123456789abcdef")
    if hexadecimal:
        values, radix = F.transform(plain, lambda c: F.position(c, order) - 1), F.transform(plain, lambda _: F.lit(16))
    else:
        values = F.transform(plain, lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 97))
        radix = F.transform(plain, lambda c: F.when(c.rlike("[0-9]"), F.lit(10)).otherwise(F.lit(26)))

    def render(v: Column, c: Column) -> Column:
        if hexadecimal:
            low = F.substr(order, v + 1, F.lit(1))
        else:
            low = F.when(c.rlike("[0-9]"), v.cast("string")).otherwise(F.char(v + 97))
        return F.when(c.rlike("[A-Z]"), F.upper(low)).otherwise(low)

    return refilled(text, feistel(values, radix, key, kind), "[0-9A-Za-z]", render)


def luhn(d: Column) -> Column:
    """The check digit that belongs behind these digits."""
    n = F.size(d)
    doubled = F.transform(d, lambda x, i: F.when((n - i) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    return (F.lit(10) - F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10) % 10


def card(text: Column, key: str) -> Column:
    """All digits but the last are permuted; the last is their check digit again."""

    def changed(d: Column) -> Column:
        body = F.slice(d, 1, F.size(d) - 1)
        return let(feistel(body, F.transform(body, lambda _: F.lit(10)), key, "number"), lambda p: F.concat(p, F.array(luhn(p).cast("int"))))

    return refilled(text, let(digits(text), changed), "[0-9]", as_digit)


def right_card(text: Column) -> Column:
    return let(digits(text), lambda d: luhn(F.slice(d, 1, F.size(d) - 1)) == F.element_at(d, -1))


def social(text: Column, key: str) -> Column:
    """Area (001 to 899 without 666), group and serial number are permuted within those that are given out."""
    parts = F.transform(F.split(text, "-"), lambda x: x.cast("int"))
    index = let(parts, lambda p: F.array(p[0] - 1 - (p[0] > 666).cast("int"), p[1] - 1, p[2] - 1))
    to = feistel(index, F.array(F.lit(898), F.lit(99), F.lit(9999)), key, "social")
    padded = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return let(to, lambda v: F.concat_ws("-", padded(v[0] + 1 + (v[0] >= 665).cast("int"), 3), padded(v[1] + 1, 2), padded(v[2] + 1, 4)))


def pair(n: Column, a: int, b: int, key: str, kind: str) -> Column:
    """Permutes numbers under a * b."""
    split = F.array(F.floor(n / b).cast("int"), (n % b).cast("int"))
    return let(feistel(split, F.array(F.lit(a), F.lit(b)), key, kind), lambda v: v[0].cast("long") * b + v[1])


def address(text: Column, key: str) -> Column:
    n = F.aggregate(F.split(text, r"\."), F.lit(0).cast("long"), lambda s, x: s * 256 + x.cast("long"))
    return let(pair(n, 65536, 65536, key, "address"), lambda m: F.concat_ws(".", *((F.shiftright(m, s) % 256).cast("string") for s in (24, 16, 8, 0))))


_EPOCH, _DAYS = "1800-01-01", 146097


def date(text: Column, key: str) -> Column:
    """In the order of parts that gives a date (days before months, if both do); others stay."""

    def moved(pattern: str) -> tuple[Column, Column]:
        day = F.try_to_date(text, pattern)
        n = F.datediff(day, F.lit(_EPOCH).cast("date"))
        to = F.date_add(F.lit(_EPOCH).cast("date"), pair(n, 189, 773, key, "date").cast("int"))
        return day.isNotNull() & n.between(0, _DAYS - 1), F.date_format(to, pattern)

    out = text
    for shape, pattern in ((r"^[0-9]{2}\.", "MM.dd.yyyy"), (r"^[0-9]{2}\.", "dd.MM.yyyy"), ("^[0-9]{2}/", "MM/dd/yyyy"), ("^[0-9]{2}/", "dd/MM/yyyy"), ("^[0-9]{4}-", "yyyy-MM-dd")):
        valid, to = moved(pattern)
        out = F.when(text.rlike(shape) & valid, to).otherwise(out)
    return out


_COUNTRY = r"^(?:\+(?:1(?=[ .(-]|[0-9]{10}$)|[0-9]{1,3}(?=[ .(-])|[0-9]{2}))?"


def pseudonym(m: Column, key: str) -> Column:
    """What stands for one match."""
    is_ = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    local, domain = F.substring_index(m, "@", 1), F.concat(F.lit("@"), F.substring_index(m, "@", -1))
    country = F.regexp_extract(m, _COUNTRY, 0)
    return (
        F.when(m.contains("@"), F.concat(by_letters(local, key, "email"), domain))
        .when(is_["secret"], by_letters(m, key, "secret", hexadecimal=True))
        .when(is_["date"], date(m, key))
        .when(is_["address"], address(m, key))
        .when(is_["social"], social(m, key))
        .when(is_["number"], F.when(right_card(m), card(m, key)).otherwise(m))
        .otherwise(F.concat(country, by_digits(F.substr(m, F.length(country) + 1), key, "phone")))
    )


def pseudonymise(df: DataFrame, key: str, text: str = "text", result: str | None = None, found: str | None = None) -> DataFrame:
    """Replaces personal data in `text` (or writes to `result`); found: adds the number of places looked at."""
    source = F.col(text)
    parts, matches = F.split(source, ANY, -1), F.regexp_extract_all(source, F.lit(ANY), F.lit(0))
    changed = F.transform(matches, lambda m: pseudonym(m, key))
    joined = F.array_join(F.zip_with(parts, F.concat(changed, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    hit = source.rlike(HINT) & source.rlike(ANY)
    columns = {result or text: F.when(hit, joined).otherwise(source)}
    if found:
        columns[found] = F.when(hit, F.size(matches)).otherwise(F.lit(0))
    return df.withColumns(columns)


def session_key(spark: SparkSession) -> str:
    return spark.conf.get("spark.milldam.pseudonyms.key", DEMONSTRATION)


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark), found="n_found").select("doc_id", "text", "n_found")
