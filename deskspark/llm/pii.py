"""Format-preserving pseudonyms for personal data, in DataFrame functions alone.

A value is recognised by its format and validated: cards by their check digit, dates by the
calendar, network addresses by their range. It is read as a number x in [0, a * b) and permuted by
an alternating Feistel network, L = (L + f(R)) mod a and R = (R + f(L)) mod b, whose round
function is a keyed digest. The number is written back into the value's own layout. Equal values
get equal pseudonyms in all documents, different ones of a kind stay different, and whoever has
the key can invert them. Mail addresses have no fixed number format and get a keyed digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import unused

ROUNDS = 6
KINDS = ("mail", "card", "phone", "ip", "date")

#: Possessive, as a group that may be given back is matched recursively and a long run of dots would exhaust the stack.
MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++"
DATE = (r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-])(?!\.\d)")
IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d)(?!\.\d)"
PHONE = (r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
         r"|(?<![\d+])\+\d(?:(?:[ .-]?\(|\)[ .-]?|[ .-])?\d){7,14}(?!\d)"
         r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])")
CARD = r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"
ANY = "|".join((MAIL, DATE, IP, PHONE, CARD))

# The two-digit country codes; 1 and 7 have one digit, all others three.
COUNTRY_CODES = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55",
    "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)

#: 400 times 365 days from this day on can be permuted.
FIRST_DAY = "1800-01-01"
DATE_FORMATS = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{2}/", "dd/MM/yyyy"), (r"^\d{2}\.\d{2}\.", "dd.MM.yyyy"))
#: For what is no date with the day first. Its day is above 12, and its pseudonym's too, so that the two never meet.
MONTH_FIRST = "MM/dd/yyyy"
#: Tries to get to such a day; each fails for 12 days in a month.
WALK = 64


def feistel(x: Column, a: Column, b: Column, tweak: Column, key: str) -> Column:
    """A keyed permutation of [0, a * b) for a * b below 2**63; one for every tweak."""

    def digest(half: Column, i: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("bigint")

    def step(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.when(i % 2 == 0, F.struct(F.pmod(left + digest(right, i), a).alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), F.pmod(right + digest(left, i), b).alias("r")))

    first = F.struct(F.floor(x / b).cast("bigint").alias("l"), F.pmod(x, b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, step, lambda s: s["l"] * b + s["r"])


def ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).try_cast("bigint")


def permuted_digits(digits: Column, n: Column, kind: str, key: str) -> Column:
    """Text of n digits (18 at most) to another text of n digits."""
    half = F.floor(n / 2).cast("int")
    tweak = F.concat(F.lit(kind), n.cast("string"))
    y = feistel(digits.try_cast("bigint"), ten_to(half), ten_to(n - half), tweak, key)
    return F.lpad(y.cast("string"), n, F.lit("0"))


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of digits from the right, every second one doubled; the rightmost too if `doubled` is 0."""

    def add(state: Column, c: Column) -> Column:
        d = c.try_cast("int") * F.when(state["i"] % 2 == doubled, 2).otherwise(1)
        return F.struct((state["i"] + 1).alias("i"), (state["s"] + F.when(d > 9, d - 9).otherwise(d)).alias("s"))

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit(0).alias("i"), F.lit(0).alias("s")), add, lambda s: s["s"])


def refill(layout: Column, digits: Column) -> Column:
    """`layout` with its digits replaced by `digits`, one after the other."""

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike(r"^\d$")
        return F.struct(
            F.concat(state["s"], F.when(is_digit, digits.substr(state["i"], F.lit(1))).otherwise(c)).alias("s"),
            (state["i"] + is_digit.cast("int")).alias("i"))

    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))
    return F.aggregate(F.split(layout, ""), start, put, lambda s: s["s"])


def day_first(value: Column) -> Column:
    return F.coalesce(*(F.when(value.rlike(p), F.try_to_timestamp(value, F.lit(f)).cast("date")) for p, f in DATE_FORMATS))


def parsed_date(value: Column) -> Column:
    """The date, where the calendar has it."""
    month_first = F.when(value.rlike(r"^\d{2}/"), F.try_to_timestamp(value, F.lit(MONTH_FIRST)).cast("date"))
    return F.coalesce(day_first(value), month_first)


def kind_of(value: Column) -> Column:
    """The kind of a found value, NULL if it is not valid."""
    digits = F.regexp_replace(value, r"\D", "")
    octets = F.split(value, r"\.")
    span = F.datediff(parsed_date(value), F.lit(FIRST_DAY).cast("date"))
    return (F.when(value.contains("@"), "mail")
            .when(value.rlike(f"^(?:{DATE})$"), F.when(span.between(0, 400 * 365 - 1), "date"))
            .when(value.rlike(f"^(?:{IP})$"), F.when(F.forall(octets, lambda o: o.try_cast("int") <= 255), "ip"))
            .when(value.rlike(f"^(?:{PHONE})$"), "phone")
            .when((F.length(digits) >= 13) & (luhn_sum(digits, 1) % 10 == 0) & digits.rlike("[1-9]"), "card"))


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The value's pseudonym; the value itself where `kind` is NULL."""

    def only(name: str) -> Column:
        return F.when(kind == name, value)

    digits = F.regexp_replace(only("card"), r"\D", "")
    n = F.length(digits)
    payload = permuted_digits(digits.substr(F.lit(1), n - 1), n - 1, "card", key)
    card = F.concat(payload, F.pmod(10 - luhn_sum(payload, 0) % 10, F.lit(10)).cast("string"))

    digits = F.regexp_replace(only("phone"), r"\D", "")
    n = F.length(digits)
    code = F.when(digits.rlike("^[17]"), 1).when(digits.substr(1, 2).isin(*COUNTRY_CODES), 2).otherwise(3)
    own = F.when(value.startswith("+"), n - code).otherwise(n).cast("int")
    phone = F.concat(digits.substr(F.lit(1), n - own), permuted_digits(digits.substr(n - own + 1, own), own, "phone", key))

    octets = F.transform(F.split(only("ip"), r"\."), lambda o: o.try_cast("bigint"))
    address = F.aggregate(octets, F.expr("bigint(0)"), lambda s, o: s * 256 + o)
    word = F.expr("bigint(65536)")
    moved = feistel(address, word, word, F.lit("ip"), key)
    ip = F.concat_ws(".", *(F.pmod(F.floor(moved / d).cast("bigint"), F.lit(256)).cast("string")
                            for d in (1 << 24, 1 << 16, 1 << 8, 1)))

    first = F.lit(FIRST_DAY).cast("date")
    day = F.datediff(parsed_date(only("date")), first).cast("bigint")

    def moved_on(n: Column) -> Column:
        return feistel(n, F.expr("bigint(400)"), F.expr("bigint(365)"), F.lit("date"), key)

    def day_of(n: Column) -> Column:
        return F.date_add(first, n.cast("int"))

    moved_day = day_of(moved_on(day))
    by_format = F.coalesce(*(F.when(value.rlike(p), F.date_format(moved_day, f)) for p, f in DATE_FORMATS))
    walked = F.aggregate(F.sequence(F.lit(2), F.lit(WALK)), moved_on(day),
                         lambda n, _: F.when(F.dayofmonth(day_of(n)) > 12, n).otherwise(moved_on(n)))
    date = F.when(day_first(only("date")).isNotNull(), by_format).otherwise(F.date_format(day_of(walked), MONTH_FIRST))

    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(only("mail"))), 256)
    mail = F.concat(F.lit("u"), F.substring(digest, 1, 16), F.lit("@pseudonym.invalid"))
    return (F.when(kind == "mail", mail).when(kind == "card", refill(value, card)).when(kind == "phone", refill(value, phone))
            .when(kind == "ip", ip).when(kind == "date", date).otherwise(value))


def found_values(text: Column) -> Column:
    """All matches in order, with their kinds."""
    values = F.when(text.rlike("[@0-9]"), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1)))
    values = F.coalesce(values, F.array().cast("array<string>"))
    return F.transform(values, lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with pseudonyms in the column `text`, and the number of replaced values of each kind.

    The counts are pii_mail, pii_card, pii_phone, pii_ip and pii_date. NULL texts stay NULL and
    empty ones empty, with counts of 0; repeated rows stay repeated; texts without a valid value
    come back unchanged. Columns of the input with the name of a count are replaced. Dates outside
    the 400 * 365 days from 1800-01-01 stay. Phone numbers are + and 8 to 15 digits in groups, or
    ten digits as (nnn) nnn-nnnn or nnn-nnn-nnnn; a country code after + stays. Dates with slashes are read day first, and month
    first where that is no date. One pass, no shuffle.
    """
    counts = [f"pii_{k}" for k in KINDS]
    rows = docs.drop(*counts)
    values, changes = unused("found", rows.columns), unused("changes", rows.columns)
    found = rows.withColumn(values, found_values(F.col(text)))
    changed = F.transform(values, lambda m: F.struct(m["kind"].alias("kind"), pseudonym(m["value"], m["kind"], key).alias("new")))
    found = found.withColumn(changes, F.when(F.exists(values, lambda m: m["kind"].isNotNull()), changed))
    rest = F.split(F.col(text), ANY, -1)
    rebuilt = F.array_join(F.zip_with(rest, changes, lambda s, m: F.concat(s, F.coalesce(m["new"], F.lit("")))), "")
    out = found.withColumn(text, F.when(F.col(changes).isNotNull(), rebuilt).otherwise(F.col(text)))
    kinds = F.transform(F.coalesce(changes, F.array().cast("array<struct<kind:string,new:string>>")), lambda m: F.coalesce(m["kind"], F.lit("-")))
    sums = {name: F.size(kinds) - F.size(F.array_remove(kinds, kind)) for kind, name in zip(KINDS, counts)}
    return out.withColumns(sums).drop(values, changes)
