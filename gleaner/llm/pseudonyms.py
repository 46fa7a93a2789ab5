"""Format-preserving pseudonyms for personal numbers and dates, with DataFrame functions only.

One pattern finds candidates: e-mail addresses, bank accounts, dates, internet addresses, social security,
telephone and card numbers. Each kind is validated, mapped to a pair (x, y) of Z_m x Z_n that holds exactly its
valid values, permuted by a keyed Feistel network over the two halves, and written back in the form it had.
A value's pseudonym depends on the key, the kind and the value, not on its blanks and dashes: equal values
stay equal in all documents, and different ones of one form stay different. Who has the key can undo it, so
there is no default: an empty key is an error.

- card: 13-19 digits with a right Luhn digit; the digits before it are permuted, the last is made right again.
- account: two letters, a right remainder modulo 97; the digits of the number are permuted, the check digits renewed.
- date: year-month-day, or day and month before the year with `.` or `/` (day first if that is a date, else
  month first), from 1800 to 2199. Days up to the 12th are permuted among themselves (57600 = 240 x 240), and so
  are later ones (88497, in 298 x 297 by walking on from the nine pairs that are no day): what can be read in one
  order only stays so, and no two strings of one form become alike.
- social security: areas 001-899 without 666, groups 01-99, serials 0001-9999.
- internet address: four numbers up to 255 without leading zeros: 2^16 x 2^16.
- telephone: after `+` or 00 the country code stays, as the published numbering plan delimits it, whatever the
  blanks; both forms of a number are one value, with `(0)` after the code or without. Numbers with a leading 0
  keep it, ten digits in groups of 3, 3 and 4 keep nothing; ten digits in one piece are no telephone number.
- e-mail: the letters and digits of the local part, in runs of up to 12; the domain stays.

What fails its check stays as it is. Null text stays null, empty text empty; other columns stay; repeated rows
get equal pseudonyms; a text may be of any length. An empty table gives an empty one.
"""

from __future__ import annotations

import calendar
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm._frame import table, unused

#: Session option with the key of the registered query, and the key of sessions that don't set it (given tables, tests).
KEY_OPTION, OPEN_KEY = "spark.gleaner.pseudonyms.key", "not secret"
ROUNDS = 10

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){2,7}(?: ?[0-9]{1,3})?(?![A-Za-z0-9])"
DATE = r"(?<![0-9./-])(?:(?:1[89]|2[01])[0-9]{2}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{2}([./])[0-9]{2}\2(?:1[89]|2[01])[0-9]{2})(?![0-9]|[./-][0-9])"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
SECURITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
CARD = r"(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])"
#: A digit of a telephone number, after a separator or not; a group has two digits at least.
DIGIT = r"(?:(?:[ ./-]|[ .-]?\(|\)[ .-]?)?[0-9](?=[0-9])|[0-9])"
NO_NUMBER = r"(?<![0-9][.,/-])"
ABROAD = (
    r"1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}", r"[1-9][0-9]{0,2}[ .-]?\(0\) ?[0-9]" + DIGIT + "{5,12}",
    r"[1-9][0-9]{0,2}[ .-][0-9]" + DIGIT + "{6,11}", "[1-9]" + DIGIT + "{7,14}",
)
TELEPHONE = (
    r"(?<![0-9+])(?:(?:\+|" + NO_NUMBER + "00)(?:" + "|".join(f"(?:{form}(?![0-9]))" for form in ABROAD) + ")"
    + "|" + NO_NUMBER + r"\(?0[1-9]" + DIGIT + r"{7,10}|(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9])"
)
#: Country codes of one and two digits; all others have three, and none begins another.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
ANY = "|".join((EMAIL, ACCOUNT, DATE, ADDRESS, SECURITY, CARD, TELEPHONE))
#: What every candidate has, whichever alternative of ANY it fits (`+` or 0 and a digit: a telephone in short groups); most texts end here.
HINT = r"[0-9]{4}|[0-9]\.[0-9]|@|\+[0-9]|(?<![0-9])0[0-9]"
YEARS = range(1800, 2200)
#: Days of a common year after the 12th of their month, and the years with a 29th of February.
LATE = [f"{m:02}-{d:02}" for m in range(1, 13) for d in range(13, calendar.monthrange(1801, m)[1] + 1)]
LEAP = [y for y in YEARS if calendar.isleap(y)]


def is_a(value: Column, pattern: str, group: int | None = None) -> Column:
    """Whether the whole value has the form; a back reference is renumbered for the pattern by itself."""
    own = pattern if group is None else pattern.replace(f"\\{group}", "\\1")
    return value.rlike(f"^(?:{own})$")


def number(digits: Column) -> Column:
    """A long; an empty string is 0."""
    return F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))


def feistel(x: Column, y: Column, m: Column, n: Column, key: str, kind: str | Column) -> Column:
    """The struct (x, y) permuted within Z_m x Z_n."""
    tweak = F.concat_ws("|", F.lit(key), F.lit(kind), m, n)

    def step(state: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        seen, size = F.when(even, state["y"]).otherwise(state["x"]), F.when(even, m).otherwise(n)
        noise = F.conv(F.substring(F.md5(F.concat_ws("|", tweak, turn, seen)), 1, 15), 16, 10).cast("long") % size
        moved = (F.when(even, state["x"]).otherwise(state["y"]) + noise) % size
        return F.struct(F.when(even, moved).otherwise(state["x"]).alias("x"), F.when(even, state["y"]).otherwise(moved).alias("y"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(x.alias("x"), y.alias("y")), step)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permuted_digits(digits: Column, key: str, kind: str | Column, base: int = 10) -> Column:
    """A string of up to 36 digits (24 of base 36) as another one of its length."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    powers = F.array(*[F.lit(min(base**k, (1 << 63) - 1)).cast("long") for k in range(19 if base == 10 else 13)])
    m, n = F.element_at(powers, half + 1), F.element_at(powers, (size - half + 1).cast("int"))

    def read(text: Column) -> Column:
        return number(text) if base == 10 else number(F.conv(text, base, 10))

    def write(value: Column, width: Column) -> Column:
        text = value.cast("string") if base == 10 else F.lower(F.conv(value.cast("string"), 10, base))
        return F.when(width > 0, F.lpad(text, 12 if base != 10 else 18, "0").substr(F.lit(1) + F.lit(12 if base != 10 else 18) - width, width)).otherwise("")

    swapped = feistel(read(digits.substr(F.lit(1), half)), read(digits.substr(half + 1, size)), m, n, key, kind)
    return let(swapped, lambda s: F.concat(write(s["x"], half), write(s["y"], (size - half).cast("int"))))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(form: Column, digits: Column) -> Column:
    """The form with its digits replaced, one after another."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

    def step(state: Column, sign: Column) -> Column:
        digit = sign.between("0", "9")
        return F.struct(
            F.concat(state["text"], F.when(digit, digits.substr(state["next"], F.lit(1))).otherwise(sign)).alias("text"),
            (state["next"] + digit.cast("int")).alias("next"),
        )

    return F.aggregate(F.split(form, ""), start, step, lambda s: s["text"])


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of digits whose last one is doubled."""
    backward = F.split(F.reverse(digits), "")
    doubled = F.transform(backward, lambda d, k: let(number(d) * F.when(k % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda a, b: a + b)


def card(value: Column, key: str) -> Column:
    def check(body: Column) -> Column:
        return ((F.lit(10) - luhn_sum(body) % 10) % 10).cast("string")

    def change(digits: Column) -> Column:
        body = digits.substr(F.lit(1), F.length(digits) - 1)
        right = check(body) == digits.substr(F.length(digits), F.lit(1))
        return F.when(right, let(permuted_digits(body, key, "card"), lambda b: refill(value, F.concat(b, check(b)))))

    return let(digits_of(value), change)


def account(value: Column, key: str) -> Column:
    letters = F.concat(*[(F.ascii(value.substr(F.lit(k), F.lit(1))) - 55).cast("string") for k in (1, 2)])

    def remainder(text: Column) -> Column:
        return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda a, d: (a * 10 + number(d)) % 97)

    def change(digits: Column) -> Column:
        body = digits.substr(F.lit(3), F.length(digits))
        right = remainder(F.concat(body, letters, digits.substr(F.lit(1), F.lit(2)))) == 1

        def write(b: Column) -> Column:
            return refill(value, F.concat(F.lpad((F.lit(98) - remainder(F.concat(b, letters, F.lit("00")))).cast("string"), 2, "0"), b))

        return F.when(right, let(permuted_digits(body, key, "account"), write))

    return let(digits_of(value), change)


def literals(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def moved_early(year: Column, month: Column, day: Column, key: str) -> Column:
    """The date that a day up to the 12th of its month becomes, as yyyyMMdd."""
    place = (year - YEARS[0]) * 144 + (month - 1) * 12 + day - 1
    size = F.lit(240).cast("long")

    def write(k: Column) -> Column:
        return F.format_string("%04d%02d%02d", F.floor(k / 144) + YEARS[0], F.floor(k % 144 / 12) + 1, k % 12 + 1)

    return let(feistel(F.floor(place / 240).cast("long"), place % 240, size, size, key, "early"), lambda s: let(s["x"] * 240 + s["y"], write))


def moved_late(year: Column, month: Column, day: Column, key: str) -> Column:
    """The date that a later day of its month becomes, as yyyyMMdd."""
    common, m, n = len(YEARS) * len(LATE), F.lit(298).cast("long"), F.lit(297).cast("long")
    in_year = F.array_position(literals(LATE), F.format_string("%02d-%02d", month, day))
    place = F.when(in_year > 0, (year - YEARS[0]) * len(LATE) + in_year - 1).otherwise(common + F.array_position(literals(LEAP), year.cast("int")) - 1)

    def turn(k: Column) -> Column:
        return let(feistel(F.floor(k / 297).cast("long"), k % 297, m, n, key, "late"), lambda s: s["x"] * 297 + s["y"])

    days = common + len(LEAP)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(298 * 297 - days)), turn(place), lambda k, _: F.when(k < days, k).otherwise(turn(k)))

    def write(k: Column) -> Column:
        usual = F.concat((F.floor(k / len(LATE)) + YEARS[0]).cast("string"), F.element_at(literals([t.replace("-", "") for t in LATE]), (k % len(LATE) + 1).cast("int")))
        return F.when(k < common, usual).otherwise(F.concat(F.element_at(literals(LEAP), (k - common + 1).cast("int")).cast("string"), F.lit("0229")))

    return let(walked, write)


def date(value: Column, key: str) -> Column:
    digits = digits_of(value)
    leads = value.rlike("^[0-9]{4}")
    year = F.when(leads, digits.substr(1, 4)).otherwise(digits.substr(5, 4))
    a = F.when(leads, digits.substr(5, 2)).otherwise(digits.substr(1, 2))
    b = F.when(leads, digits.substr(7, 2)).otherwise(digits.substr(3, 2))

    def day(month: Column, of_month: Column) -> Column:
        return F.concat_ws("-", year, month, of_month).try_cast("date")

    day_first = ~leads & day(b, a).isNotNull()
    found = F.coalesce(F.when(day_first, day(b, a)), day(a, b))

    def change(d: Column) -> Column:
        y, m, n = (f(d).cast("long") for f in (F.year, F.month, F.dayofmonth))
        return F.when(n <= 12, moved_early(y, m, n, key)).otherwise(moved_late(y, m, n, key))

    def write(new: Column) -> Column:
        y, m, n = new.substr(1, 4), new.substr(5, 2), new.substr(7, 2)
        return refill(value, F.when(leads, new).when(day_first, F.concat(n, m, y)).otherwise(F.concat(m, n, y)))

    return let(found, lambda d: F.when(d.isNotNull() & F.year(d).between(YEARS[0], YEARS[-1]), let(change(d), write)))


def address(value: Column, key: str) -> Column:
    def change(parts: Column) -> Column:
        valid = F.forall(parts, lambda p: (number(p) <= 255) & ((F.length(p) == 1) | ~p.startswith("0")))
        x, y = (number(F.element_at(parts, a)) * 256 + number(F.element_at(parts, a + 1)) for a in (1, 3))
        size = F.lit(65536).cast("long")
        moved = feistel(x, y, size, size, key, "address")
        return F.when(valid, let(moved, lambda s: F.concat_ws(".", *[c.cast("string") for h in (s["x"], s["y"]) for c in (F.floor(h / 256), h % 256)])))

    return let(F.split(value, r"\."), change)


def security(value: Column, key: str) -> Column:
    area, group, serial = (number(value.substr(a, b)) for a, b in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    moved = feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99).cast("long"), F.lit(9999).cast("long"), key, "security")

    def write(s: Column) -> Column:
        new = F.floor(s["x"] / 99)
        parts = (F.when(new >= 665, new + 2).otherwise(new + 1), 3), (s["x"] % 99 + 1, 2), (s["y"] + 1, 4)
        return F.concat_ws("-", *[F.lpad(p.cast("string"), size, "0") for p, size in parts])

    return F.when(valid, let(moved, write))


def telephone(value: Column, key: str) -> Column:
    digits = digits_of(F.regexp_replace(value, r"\(0\)", ""))
    trunk = F.when(value.contains("(0)"), "0").otherwise("")
    lead = F.when(value.startswith("00"), 2).otherwise(0)
    abroad = value.startswith("+") | value.startswith("00")
    code = F.when(abroad, F.length(F.regexp_extract(digits.substr(lead + 1, F.length(digits)), COUNTRY, 1))).when(digits.startswith("0"), 1).otherwise(0)
    body = digits.substr(lead + code + 1, F.length(digits))
    kind = F.when(abroad, "telephone").when(digits.startswith("0"), "trunk").otherwise("local")
    valid = (F.length(digits) - lead).between(8, 15) & (F.length(body) > 1)
    return F.when(valid, let(permuted_digits(body, key, kind), lambda b: refill(value, F.concat(digits.substr(F.lit(1), lead + code), trunk, b))))


def email(value: Column, key: str) -> Column:
    pieces = F.regexp_extract_all(F.substring_index(value, "@", 1), F.lit("[A-Za-z0-9]{1,12}|[^A-Za-z0-9]"), F.lit(0))
    changed = F.transform(pieces, lambda p: F.when(p.rlike("^[A-Za-z0-9]"), permuted_digits(F.lower(p), key, "email", 36)).otherwise(p))
    return F.concat(F.array_join(changed, ""), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a candidate, or null if it isn't a valid value of any kind."""
    return (
        F.when(value.contains("@"), email(value, key))
        .when(value.rlike("^[A-Z]{2}"), account(value, key))
        .when(is_a(value, DATE), date(value, key))
        .when(is_a(value, ADDRESS), address(value, key))
        .when(is_a(value, SECURITY), security(value, key))
        .when(is_a(value, CARD, 3) & ~value.startswith("00"), F.coalesce(card(value, key), F.when(is_a(value, TELEPHONE), telephone(value, key))))
        .when(is_a(value, TELEPHONE), telephone(value, key))
    )


def pseudonymize(docs: DataFrame, *, key: str, text: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns of `docs` with the text replaced, and the name of a new column: the values changed."""
    if not key:
        raise ValueError("pseudonyms need a key")
    count, parts = unused(docs, "n_replaced"), unused(docs, "parts")
    content = F.col(text)
    has = content.rlike(HINT)
    gaps = F.when(has, F.split(content, ANY, -1))
    values = F.when(has, F.regexp_extract_all(content, F.lit(ANY), F.lit(0)))
    changed = F.transform(values, lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new")))
    found = docs.withColumn(parts, F.struct(gaps.alias("gaps"), changed.alias("values")))
    joined = F.zip_with(F.col(parts + ".gaps"), F.col(parts + ".values"), lambda g, v: F.concat(g, F.coalesce(v["new"], v["old"], F.lit(""))))
    number_changed = F.coalesce(F.size(F.filter(F.col(parts + ".values"), lambda v: v["new"].isNotNull())), F.lit(0))
    new = {text: F.when(F.col(parts + ".gaps").isNotNull(), F.array_join(joined, "")).otherwise(content), count: F.when(content.isNull(), 0).otherwise(F.greatest(number_changed, F.lit(0)))}
    return found.withColumns(new).select(*docs.columns, count), count


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for its personal numbers and dates."""
    found, count = pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), key=spark.conf.get(KEY_OPTION, OPEN_KEY))
    return found.select("doc_id", "text", F.col(count).cast("long").alias("n_replaced"))
