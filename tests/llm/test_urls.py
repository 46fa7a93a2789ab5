import duckdb
from pyspark.sql import functions as F

from gleaner.llm.urls import KINDS, LIMIT, SQL, VOCABULARY, automaton, forms, judge, op4_url_filter, terms_of


def verdicts(spark, urls, **options):
    frame = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string")
    found, names = judge(frame, **options)
    assert found.count() == len(urls)
    return [(r[names["host"]], r[names["path"]], r[names["rule"]], r[names["verdict"]]) for r in found.orderBy("page_id").collect()]


def test_rules_and_words(spark):
    got = verdicts(spark, [
        "https://A.Example.ORG/es/1?x", "http://example.org/en/12", "http://example.org/EN/1", "http://notexample.org/es/", "http://com/de/", "http://xcom/de/",
        "https://b.example.net/cheap/loan-free#x", "http://b.example.net/cheaper", "http://cheap-pills.example.com/fr/", "http://cheap-pills.example.com/en/",
        None, "", "no scheme casino", "://h", "a://b://c/d?e", "http://x.net/" + "a" * 100_000,
    ])
    assert got[:6] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/EN/1", "org/", "allow"),
        ("notexample.org", "/es/", "org/", "allow"), ("com", "/de/", "com/de/", "block"), ("xcom", "/de/", None, "allow"),
    ]
    assert [g[2:] for g in got[6:10]] == [(None, "block"), (None, "allow"), ("com/fr/", "allow"), (None, "block")]
    assert got[10:15] == [("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "block"), ("h", "", None, "allow"), ("b:", "//c/d", None, "allow")]
    assert got[15][3] == "allow"


def test_no_rules_no_words_no_rows(spark):
    assert verdicts(spark, ["http://casino.org/"], rules=(), vocabulary={}) == [("casino.org", "/", None, "allow")]
    assert verdicts(spark, []) == []


def test_terms_count_once_and_stand_alone():
    words = automaton({"win": 1, "free": 1, "free-win": 3})
    assert terms_of("win/win/free1/xfree/free-win", words) == {"win": 1, "free": 1, "free-win": 3}
    assert terms_of("winner", words) == {}


def test_plurals_and_kinds():
    words = automaton(VOCABULARY)
    assert terms_of("http://lotteries.net/bets-bet/fetishes", words) == {"lottery": 1, "bet": 2, "fetish": 2}
    assert terms_of("http://alphabet.net/scasino/trackless", words) == {}
    assert sum(map(len, KINDS.values())) == len(VOCABULARY) and all(w in range(1, LIMIT + 1) for w in VOCABULARY.values())
    assert all(len(forms(t)) == 2 and t.isalpha() and t.isascii() and t.islower() for t in VOCABULARY)


def test_twin_on_every_form_and_pair(spark):
    """The hand-written table has the same forms and weights: each term alone, its plural, and with a word of weight 1."""
    ordered = sorted(VOCABULARY)
    urls = [f"http://a.net/{f}{rest}" for t in ordered for f in sorted(forms(t)) for rest in ("", "-Free", ".hot/WIN", "1", "s")] + [None, ""]
    found, names = judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    got = {r.page_id: r[names["verdict"]] for r in found.collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(urls)))
    assert {r[0]: r[4] for r in con.sql(SQL).fetchall()} == got and {*got.values()} == {"allow", "block"}


def test_recall_by_kind_of_host(spark):
    """Of the given pages that no rule decides: those of hosts named after an offer, and all others."""
    rows = op4_url_filter(spark, "/root/testdata/sf0.1").where(F.col("rule").isNull())
    offer = F.regexp_extract("host", "casino|bets|adult|pills|ads|spam", 0)
    share = {r.offer: (r.blocked, r.n) for r in rows.groupBy(offer.alias("offer")).agg(F.count_if(F.col("verdict") == "block").alias("blocked"), F.count("*").alias("n")).collect()}
    assert share.pop("")[0] == 0
    assert len(share) == 6 and all(blocked >= 0.9 * n for blocked, n in share.values()), share
