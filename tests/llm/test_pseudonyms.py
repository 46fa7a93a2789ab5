"""Pseudonyms: valid, in the same form, linked, and a permutation."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from gleaner.llm.pseudonyms import OPEN_KEY, feistel, op7_pseudonyms, pseudonym, pseudonymize


def change(spark, texts, key="k", **options):
    frame = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_replaced string")
    found, count = pseudonymize(frame, key=key, **options)
    assert found.columns == [*frame.columns, count]
    return [(r.text, r[count]) for r in found.orderBy("doc_id").collect()]


def luhn(text):
    digits = [int(c) for c in re.sub(r"\D", "", text)][::-1]
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0


def mod97(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def shape(text):
    return re.sub("[0-9]", "9", text)


CARDS = ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "378282246310005", "3782 822463 10005", "6011000990139424", "4222222222222"]


@pytest.mark.parametrize(("values", "valid"), [
    (CARDS, luhn), (["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "BE68539007547034"], mod97),
    (["2024-02-29", "1900/01/01", "2199-12-31", "1800-01-01"], lambda t: datetime.date.fromisoformat(t.replace("/", "-")).year >= 1800),
    (["31.12.1999", "01/02/1990"], lambda t: datetime.datetime.strptime(t.replace("/", "."), "%d.%m.%Y")),
    (["97.51.17.173", "0.0.0.0", "255.255.255.255"], lambda t: all(int(p) < 256 and str(int(p)) == p for p in t.split("."))),
    (["123-45-6789", "001-01-0001", "899-99-9999"], lambda t: t[:3] not in ("000", "666") and t[4:6] != "00" and t[7:] != "0000"),
    (["+1 (017) 555-7713", "555-123-4567", "+49 30 1234567", "(555) 123-4567"], bool),
])
def test_values_stay_valid_and_in_form(spark, values, valid):
    for (new, count), old in zip(change(spark, [f"to {v}, end" for v in values]), values, strict=True):
        inner = new.removeprefix("to ").removesuffix(", end")
        assert count == 1 and inner != old and valid(inner), (old, new)
        assert shape(inner) == shape(old) or re.fullmatch(r"[0-9.]+", old)


def test_country_codes_and_domains_stay(spark):
    (phone, _), (mail, _) = change(spark, ["+1 (017) 555-7713", "und.34@mail7.example.com"])
    assert phone.startswith("+1 (") and re.fullmatch(r"[a-z0-9]{3}\.[a-z0-9]{2}@mail7\.example\.com", mail) and mail != "und.34@mail7.example.com"


def test_equal_values_stay_linked(spark):
    rows = [r[0] for r in change(spark, ["4111 1111 1111 1111", "x 4111111111111111 y", "4111-1111-1111-1111", "31.12.1999", "1999-12-31", "12/31/1999"])]
    assert len({re.sub(r"\D", "", t) for t in rows[:3]}) == 1
    y, m, d = rows[4].split("-")
    assert rows[3] == f"{d}.{m}.{y}" and rows[5] == f"{m}/{d}/{y}"
    assert change(spark, ["4111111111111111"], key="other") != change(spark, ["4111111111111111"])


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "2024-02-30", "256.1.1.1", "1.2.3.4.5", "666-12-1234", "000-11-2222", "DE00370400440532013000", "1234", "a@b", None, "", "no digits", "version 3.10"]
    assert change(spark, texts) == [(t, 0) for t in texts]


def test_neighbours_repeats_and_long_texts(spark):
    one = "4111111111111111"
    long = "word 12345 " * 50_000 + one
    (two, n), (again, m), (end, k) = change(spark, [f"{one} {one}", f"{one} {one}", long])
    a, b = two.split(" ")
    assert a == b != one and n == 2 and (again, m) == (two, 2) and k == 1 and end.endswith(" " + a) and len(end) == len(long)


ALONE = [
    "und.34@mail7.example.com", "DE89 3704 0044 0532 0130 00", "2024-02-29", "31.12.1999", "97.51.17.173", "123-45-6789", *CARDS, "(555) 123-4567", "555 123 4567",
    "+1 (017) 555-7713", "+33 612 345 678", "+49 30 123 456 78", "+48 601 234 567", "+48-601-234-567", "+49.30.123.456", "+4930123456",
]


def test_every_form_alone_and_beside_others(spark):
    alone, beside = (change(spark, [form.format(v) for v in ALONE]) for form in ("call {} now", "call {} now, 9999, 3.1, @"))
    for value, (new, count), (other, again) in zip(ALONE, alone, beside, strict=True):
        assert count == again == 1 and value not in new and other == new + ", 9999, 3.1, @", value


def test_feistel_is_a_permutation(spark):
    m, n = (F.lit(k).cast("long") for k in (7, 23))
    pairs = spark.range(7 * 23).select(feistel(F.floor(F.col("id") / 23).cast("long"), F.col("id") % 23, m, n, "k", "t").alias("p"))
    assert pairs.distinct().count() == 7 * 23 and pairs.where("p.x >= 7 or p.y >= 23 or p.x < 0 or p.y < 0").count() == 0


@pytest.mark.parametrize("forms", [
    ["+1 212 555 1234", "+12125551234", "+1 (212) 555-1234", "001 212 555 1234", "+1-212-555-1234", "0012125551234"],
    ["+351 912 345 678", "+351912345678", "00351 912345678", "+351.912.345.678"], ["+33 6 12 34 56 78", "+33612345678", "0033 6 12 34 56 78", "+33 (0)6 12 34 56 78"],
    ["0049 30 12345678", "+49 30 12345678", "+49 (0)30 12345678", "00493012345678"], ["0171 2345678", "01712345678", "0171/2345678", "(0171) 2345678", "0171 234 5678"],
    ["020 7946 0958", "02079460958", "(020) 7946 0958"], ["01 23 45 67 89", "0123456789"],
])
def test_spellings_of_a_telephone_number_agree(spark, forms):
    found = change(spark, [f"call {f}; 7" for f in forms])
    plain = {re.sub(r"\(0\)|\D", "", t).removeprefix("00") for t, _ in found}
    assert len(plain) == 1 and {n for _, n in found} == {1}, found
    assert plain != {re.sub(r"\D", "", forms[0] + "7")}


def test_numbers_that_are_no_telephone_stay(spark):
    texts = ["0.0123456789", "1,012345678", "in 0100", "+1 2 3 4", "00 11", "0 123", "01 02 03"]
    assert change(spark, texts) == [(t, 0) for t in texts]


def rounds(x, y, m, n, kind, key, back):
    """The network once more, step by step; `back` undoes it."""
    for turn in range(9, -1, -1) if back else range(10):
        even = turn % 2 == 0
        seen = y if even else x
        noise = int(hashlib.md5(f"{key}|{kind}|{m}|{n}|{turn}|{seen}".encode()).hexdigest()[:15], 16)
        if even:
            x = (x + (-noise if back else noise)) % m
        else:
            y = (y + (-noise if back else noise)) % n
    return x, y


def undo_digits(digits, kind, key):
    half = len(digits) // 2
    x, y = rounds(int(digits[:half]), int(digits[half:]), 10**half, 10 ** (len(digits) - half), kind, key, True)
    return f"{x:0{half}}{y:0{len(digits) - half}}"


DAYS = [datetime.date(1800, 1, 1) + datetime.timedelta(k) for k in range(146097)]
LATE_DAYS = sorted((d for d in DAYS if d.day > 12), key=lambda d: ((d.month, d.day) == (2, 29), d))
EARLY_DAYS = [d for d in DAYS if d.day <= 12]


def undo_day(day, key, late={d: k for k, d in enumerate(LATE_DAYS)}, early={d: k for k, d in enumerate(EARLY_DAYS)}):  # noqa: B006
    if day.day <= 12:
        x, y = rounds(*divmod(early[day], 240), 240, 240, "early", key, True)
        return EARLY_DAYS[x * 240 + y]
    k = late[day]
    while True:
        x, y = rounds(*divmod(k, 297), 298, 297, "late", key, True)
        if (k := x * 297 + y) < len(LATE_DAYS):
            return LATE_DAYS[k]


def test_who_has_the_key_can_undo_it(spark):
    pick = random.Random(7)
    phones = [f"+{pick.choice([1, 44, 351])}{pick.randrange(10**9, 10**10)}" for _ in range(40)]
    for old, (new, _) in zip(phones, change(spark, phones, key="s"), strict=True):
        code = re.match(r"\+(1|44|351)", new)[0]
        assert code + undo_digits(new[len(code) :], "telephone", "s") == old
    days = [*pick.sample(DAYS, 60), *[d for d in DAYS if (d.month, d.day) == (2, 29)][:20]]
    for old, (new, _) in zip(days, change(spark, [d.isoformat() for d in days], key="s"), strict=True):
        assert undo_day(datetime.date.fromisoformat(new), "s") == old
    for old, (new, _) in zip(CARDS, change(spark, CARDS, key="s"), strict=True):
        assert undo_digits(re.sub(r"\D", "", new)[:-1], "card", "s") == re.sub(r"\D", "", old)[:-1]


def test_all_days_in_both_orders_stay_distinct(spark, sign="/"):
    day = F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int"))
    forms = F.array(F.date_format(day, f"dd{sign}MM{sign}yyyy"), F.date_format(day, f"MM{sign}dd{sign}yyyy"))
    old = spark.range(0, 146097, 1, 8).select(F.explode(forms).alias("old")).distinct()
    found = old.select("old", pseudonym(F.col("old"), "k").alias("new")).agg(
        F.count("*").alias("all"), F.count_distinct("old"), F.count_distinct("new"), F.count_if(F.col("new").rlike(f"^[0-9]{{2}}[{sign}][0-9]{{2}}[{sign}][0-9]{{4}}$"))
    ).first()
    assert len(set(found)) == 1 and found["all"] == 2 * 146097 - 144 * 400


def test_a_key_is_required_and_read_from_the_session(spark):
    with pytest.raises(ValueError):
        pseudonymize(spark.createDataFrame([("x",)], "text string"), key="")
    sf = "/root/testdata/sf0.001"
    one = op7_pseudonyms(spark, sf).agg(F.sum(F.xxhash64("text").cast("decimal(38)"))).first()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert one == pseudonymize(docs, key=OPEN_KEY)[0].agg(F.sum(F.xxhash64("text").cast("decimal(38)"))).first()
    spark.conf.set("spark.gleaner.pseudonyms.key", "another")
    try:
        assert one != op7_pseudonyms(spark, sf).agg(F.sum(F.xxhash64("text").cast("decimal(38)"))).first()
    finally:
        spark.conf.unset("spark.gleaner.pseudonyms.key")


def test_empty_table_and_plan(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    found = pseudonymize(frame, key="k")[0]
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
