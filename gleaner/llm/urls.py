"""URL filter: host and path rules, then a weighted vocabulary found by an Aho-Corasick automaton.

A rule (`org/`, `example.org/es/`) fits its host and all subdomains if the path starts with the rule's path.
The longest fitting rule decides; of two of one length, the one with the longer host. Without a rule the
vocabulary decides: a term or its plural counts where no letter or digit stands before or after it, once per URL
however often it occurs. One strict term rejects, and so do soft terms whose weights reach the limit: two weighty
ones, or one with a word that makes it an offer. The list is data of this module, by kind; give another one to `judge`.

Definitions. The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; the
path follows up to `?`, `#` or the end. Without `://`, and for null, both are empty and no rule fits. The
vocabulary sees the whole URL, A-Z lower-cased; null and empty URLs have no terms and pass. Repeated rows,
other columns and long URLs need no care.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm._frame import table, unused

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (
    (ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"),
)
#: Weight that rejects; a term of that weight or more is strict.
LIMIT = 3
KINDS = {
    "gambling": {
        "casino": 3, "sportsbook": 3, "blackjack": 3, "bookmaker": 2, "bookie": 2, "poker": 2, "roulette": 2, "jackpot": 2, "gambling": 2, "bet": 2,
        "betting": 2, "wager": 2, "lottery": 1, "slot": 1, "bingo": 1, "win": 1, "winner": 1,
    },
    "adult": {
        "porn": 3, "porno": 3, "xxx": 3, "hentai": 3, "camgirl": 3, "milf": 3, "escort": 2, "nude": 2, "erotic": 2, "fetish": 2, "adult": 2, "sex": 2,
        "sexy": 2, "webcam": 1, "hookup": 1, "hot": 1, "x": 1,
    },
    "pharma": {
        "viagra": 3, "cialis": 3, "levitra": 3, "xanax": 3, "tramadol": 3, "pill": 2, "steroid": 2, "painkiller": 2, "pharma": 1, "pharmacy": 1, "drug": 1,
        "prescription": 1, "diet": 1,
    },
    "tracking": {
        "adserver": 3, "popunder": 3, "clickbait": 3, "adclick": 3, "ads": 2, "tracker": 2, "popup": 2, "track": 1, "tracking": 1, "pixel": 1, "beacon": 1,
        "banner": 1, "affiliate": 1, "click": 1, "sponsor": 1,
    },
    "spam": {
        "warez": 3, "keygen": 3, "malware": 3, "phishing": 3, "spam": 2, "spammer": 2, "torrent": 2, "payday": 2, "crack": 2, "backlink": 2, "farm": 1,
        "loan": 1, "bonus": 1, "cheap": 1, "discount": 1, "free": 1, "replica": 1, "crypto": 1, "rich": 1,
    },
}
VOCABULARY = {term: weight for kind in KINDS.values() for term, weight in kind.items()}


def host_of(url: str) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """A struct (rule, verdict) or null. `rules` is a list in the program, so it is an expression."""
    found = []
    for verdict, rule in rules:
        of, slash, rest = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(len(of)).alias("host"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    if not found:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.greatest(*found) if len(found) > 1 else found[0]


def forms(term: str) -> set[str]:
    """A term and its plural."""
    return {term, term[:-1] + "ies" if term.endswith("y") else term + "es" if term.endswith(("s", "x", "ch", "sh")) else term + "s"}


def automaton(vocabulary: dict[str, int]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for term, weight in vocabulary.items():
        for form in forms(term) - vocabulary.keys() | {term}:
            out.add_word(form, (form, term, weight))
    out.make_automaton()
    return out


def terms_of(url: str, words: ahocorasick.Automaton) -> dict[str, int]:
    """Distinct terms of a lower-cased URL of which a form stands by itself, with their weights."""
    found = {}
    for end, (form, term, weight) in words.iter(url):
        start = end - len(form) + 1
        if not alnum(url[start - 1 : start]) and not alnum(url[end + 1 : end + 2]):
            found[term] = weight
    return found


def alnum(sign: str) -> bool:
    return "a" <= sign <= "z" or "0" <= sign <= "9"


def with_terms(pages: DataFrame, url: str, vocabulary: dict[str, int], limit: int) -> tuple[DataFrame, str, str, str]:
    """`pages` with the numbers of strict and of distinct soft terms, and the soft terms' weight."""
    strict, soft, weight = (unused(pages, n) for n in ("strict", "soft", "weight"))
    schema = T.StructType([*pages.schema.fields, *(T.StructField(n, T.IntegerType()) for n in (strict, soft, weight))])
    fold = str.maketrans(UPPER, LOWER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton(vocabulary)
        for batch in batches:
            found = [list(terms_of((u or "").translate(fold), words).values()) if vocabulary else [] for u in batch.column(url).to_pylist()]
            counts = [[sum(w >= limit for w in f) for f in found], [sum(w < limit for w in f) for f in found], [sum(w for w in f if w < limit) for f in found]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int32()) for c in counts)], names=schema.names)

    return pages.mapInArrow(run, schema), strict, soft, weight


def judge(
    pages: DataFrame, *, url: str = "url", rules: tuple[tuple[str, str], ...] = RULES,
    vocabulary: dict[str, int] = VOCABULARY, limit: int = LIMIT,
) -> tuple[DataFrame, dict[str, str]]:
    """All rows and columns of `pages`, and the names of the new ones: host, path, rule, verdict."""
    found, strict, _, weight = with_terms(pages, url, vocabulary, limit)
    names = {n: unused(pages, n) for n in ("host", "path", "rule", "verdict")}
    found = found.withColumns({names["host"]: host_of(url), names["path"]: path_of(url)})
    best = longest_rule(F.col(names["host"]), F.col(names["path"]), rules)
    own = F.when((F.col(strict) > 0) | (F.col(weight) >= limit), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    found = found.withColumns({names["rule"]: best["rule"], names["verdict"]: F.coalesce(best["verdict"], own)})
    return found.select(*pages.columns, *names.values()), names


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))[0].drop("url")


#: The same in SQL, written by hand: the URL's words meet a table of forms. Every form is one word of letters.
SQL = """
WITH v(weight, forms) AS (VALUES
  (3, 'casino/casinos sportsbook/sportsbooks blackjack/blackjacks'),
  (2, 'bookmaker/bookmakers bookie/bookies poker/pokers roulette/roulettes jackpot/jackpots gambling/gamblings bet/bets'),
  (2, 'betting/bettings wager/wagers'), (1, 'lottery/lotteries slot/slots bingo/bingos win/wins winner/winners'),
  (3, 'porn/porns porno/pornos xxx/xxxes hentai/hentais camgirl/camgirls milf/milfs'),
  (2, 'escort/escorts nude/nudes erotic/erotics fetish/fetishes adult/adults sex/sexes sexy/sexies'),
  (1, 'webcam/webcams hookup/hookups hot/hots x/xes'),
  (3, 'viagra/viagras cialis/cialises levitra/levitras xanax/xanaxes tramadol/tramadols'),
  (2, 'pill/pills steroid/steroids painkiller/painkillers'),
  (1, 'pharma/pharmas pharmacy/pharmacies drug/drugs prescription/prescriptions diet/diets'),
  (3, 'adserver/adservers popunder/popunders clickbait/clickbaits adclick/adclicks'), (2, 'ads/adses tracker/trackers popup/popups'),
  (1, 'track/tracks tracking/trackings pixel/pixels beacon/beacons banner/banners affiliate/affiliates click/clicks sponsor/sponsors'),
  (3, 'warez/warezs keygen/keygens malware/malwares phishing/phishings'),
  (2, 'spam/spams spammer/spammers torrent/torrents payday/paydaies crack/cracks backlink/backlinks'),
  (1, 'farm/farms loan/loans bonus/bonuses cheap/cheaps discount/discounts free/frees replica/replicas crypto/cryptos rich/riches')),
t AS (SELECT weight, unnest(string_split(forms, ' ')) AS term FROM v),
f AS (SELECT weight, term, unnest(string_split(term, '/')) AS form FROM t),
u AS (SELECT DISTINCT url, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower FROM pages),
w AS (SELECT DISTINCT url, unnest(regexp_split_to_array(lower, '[^a-z0-9]+')) AS form FROM u),
s AS (SELECT url, sum(weight) AS weight FROM (SELECT DISTINCT url, term, weight FROM w JOIN f USING (form)) GROUP BY url),
p AS (
  SELECT page_id, coalesce(s.weight, 0) AS weight, regexp_extract(coalesce(pages.url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    translate(regexp_extract(coalesce(pages.url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM pages LEFT JOIN s ON pages.url = s.url),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN weight >= 3 THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
