"""URL filter: longest matching rule, else naive Bayes over words cut out of host and path.

Concatenated names ("cheappills") are cut by a unigram Viterbi: the word probabilities come from the words of
all page texts (counted on Spark; the most frequent ``VOCABULARY`` are kept, a bound on the model) and two
short lists of web words; a string that is no word costs more the longer it is. A multinomial naive Bayes
over the words of host and path, hashed to ``BUCKETS`` counters summed over all urls, then decides; a listed word counts once for its class. Its
classes are learned from weak labels: a url whose host holds a word of ``BLOCKED_WORDS`` counts as blocked.

Defined results: a null url or one without ``://`` has an empty host and path, matches no rule and is allowed;
equal urls get equal verdicts; a tie between classes is allowed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.session import write_and_read

VOCABULARY = 30_000
BUCKETS = 1 << 16
SMOOTHING = 1e-3           # of a bucket, in words
SHARED = 0.15              # weight of the law of all urls in each class's: a word seen nowhere tells nothing
SEED_TIMES = 20            # times a listed word counts in the word model, per 20,000 words kept
LONGEST = 24
CACHED_HOSTS = 50_000

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

BLOCKED_WORDS = frozenset("""ad ads adserver adult affiliate bet bets betting bingo camgirl cams casino cialis clickbait coupon crack
cracked doorway escort fetish gamble gambling hacked hentai jackpot keygen loan loans lottery malware miner mlm nude payday pharma phish
phishing pill pills poker popunder porn porno replica roulette scam sex sexy slots spam spammy spyware sweepstakes tracker tracking viagra
virus warez xxx""".split())
COMMON_WORDS = frozenset("""about africa art asia auto baby bank beauty best blog book books business buy car care center cheap city click
club code com computer cooking country daily data design digital doctor education energy europe event example family farm fashion film
finance fitness food football forum free fun game games garden gift global go green group guide hair health help history home hotel house
info insurance jobs kids lab law learn library life line link live local love magazine mail market media men mobile money movie music
my nature net network new news now office one online open org page paper park pet phone photo play post press pro radio real report
review safe school science search shop site smart social sport star store street style tech time times top town toy track trade travel
tv university video view voice water way web wiki win wine women work world""".split())

_PART = re.compile(r"[a-z]+|[0-9]+")


def host_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host is the url's or a parent of it and whose path begins the
    url's path; null where none fits. Among equally long rules the earlier wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        at = text.index("/")
        name, start = text[:at], text[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


@dataclass
class Segmenter:
    """Unigram word model: cut a lower-case string into the words of highest total log probability."""

    counts: dict[str, int]
    cost: dict[str, float] = field(init=False)

    def __post_init__(self) -> None:
        total = sum(self.counts.values()) or 1
        self.total = total
        self.cost = {w: math.log(n / total) for w, n in self.counts.items()}
        self.longest = min(LONGEST, max(map(len, self.cost), default=1))

    def cut(self, text: str) -> list[str]:
        n = len(text)
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        unknown = -math.log(self.total) - math.log(10)
        for end in range(1, n + 1):
            for start in range(max(0, end - max(self.longest, 1)), end):
                c = self.cost.get(text[start:end])
                s = best[start] + (c if c is not None else unknown - 2.5 * (end - start))
                if s > best[end]:
                    best[end], back[end] = s, start
        words, end = [], n
        while end:
            words.append(text[back[end]:end])
            end = back[end]
        return words[::-1]


def _pieces(text: str, cut) -> list[str]:
    """Words of a string; digits keep their number only, and a listed word of under four letters inside a
    longer name ("ads" in "roads") is marked, as it tells little there."""
    out: list[str] = []
    for part in _PART.findall(text):
        if part[0].isdigit():
            out.append("0" * min(len(part), 4))
        else:
            words = cut(part)
            out += words if len(words) == 1 else ["~" + w if len(w) < 4 and w in BLOCKED_WORDS else w for w in words]
    return out


class Model:
    """Segmenter, bucket log odds (blocked over allowed) and prior log odds."""

    def __init__(self, words: dict[str, int], odds: np.ndarray | None = None, prior: float = 0.0):
        self.words, self.odds, self.prior = words, odds, prior

    def start(self) -> None:
        self.segmenter = Segmenter(self.words)
        self.seen: dict[str, list[str]] = {}

    def tokens(self, text: str) -> list[str]:
        got = self.seen.get(text)
        if got is None:
            got = _pieces(text.lower(), self.segmenter.cut)
            if len(self.seen) >= CACHED_HOSTS:
                self.seen.clear()
            self.seen[text] = got
        return got

    def of_url(self, host: str, path: str) -> tuple[list[str], list[str]]:
        name, _, tld = host.rpartition(".")
        words = self.tokens(name) + ["." + tld] if name else self.tokens(tld)
        return words, ["/" + w for part in path.split("/") if part for w in self.tokens(part)]


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def word_counts(pages: DataFrame, most: int = VOCABULARY) -> dict[str, int]:
    """The about ``most`` most frequent words of all page texts, with counts. The least count kept comes from
    a histogram of counts (eight classes an octave), so no global sort is needed; a whole class is kept or not."""
    text = F.lower(F.regexp_replace(F.col("html"), r"<[^>]*>", " "))
    words = (pages.select(F.explode(F.split(text, r"[^a-z]+")).alias("w")).where(F.length("w").between(2, LONGEST))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")).withColumn("c", F.floor(8 * F.log2("n")).cast("int")))
    words = write_and_read(words, "url-words")
    least, held = None, 0
    for c, n in sorted(words.groupBy("c").count().collect(), reverse=True):
        if held + n > most:
            break
        least, held = c, held + n
    kept = {r[0]: r[1] for r in words.where(F.col("c") >= (least if least is not None else 1 << 30)).select("w", "n").collect()}
    lift = max(1, sum(kept.values()) // 20_000)
    for w in BLOCKED_WORDS | COMMON_WORDS:
        kept[w] = kept.get(w, 0) + SEED_TIMES * lift
    return kept


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        m.start()
        total: Counter = Counter()
        for b in batches:
            for host, path in zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True):
                words, rest = m.of_url(host, path)
                bad = int(not BLOCKED_WORDS.isdisjoint(words))
                total[(-1, bad)] += 1
                for w in words:
                    total[(bucket(w), bad)] += 1
                for w in rest:
                    total[(bucket(w), bad)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                                          pa.array(list(total.values()), pa.int64())], ["bucket", "bad", "n"])
    return run


def train(pages: DataFrame) -> Model:
    """Word counts over all page texts, then class counts over all urls (at most 2 x ``BUCKETS`` + 2 numbers)."""
    model = Model(word_counts(pages))
    spark = pages.sparkSession
    urls = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = (urls.mapInArrow(_counter(spark.sparkContext.broadcast(model)), "bucket int, bad int, n bigint")
            .groupBy("bucket", "bad").agg(F.sum("n").alias("n")).toArrow())
    counts, urls_of = np.zeros((2, BUCKETS)), np.ones(2)
    for b, bad, n in zip(*(c.to_pylist() for c in rows.columns), strict=True):
        if b < 0:
            urls_of[bad] += n
        else:
            counts[bad, b] = n
    seeds = np.zeros((2, BUCKETS))
    for w in BLOCKED_WORDS:
        seeds[1, bucket(w)] += 1
    for w in COMMON_WORDS:
        seeds[0, bucket(w)] += 1
    every = (counts + seeds).sum(0) + SMOOTHING
    every /= every.sum()
    own = counts + seeds
    law = (1 - SHARED) * own / own.sum(1, keepdims=True) + SHARED * every
    return Model(model.words, np.log(law[1] / law[0]), float(np.log(urls_of[1] / urls_of[0])))


def judge(host: Column, path: Column, model: Model, spark) -> Column:
    """struct(words, log_odds): the host's words and the log odds that the url is to be blocked."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<words: string, log_odds: double>")
    def udf(h: pa.Array, p: pa.Array) -> pa.Array:
        m = shared.value
        if not hasattr(m, "seen"):
            m.start()
        words, odds = [], []
        for host_, path_ in zip(h.to_pylist(), p.to_pylist(), strict=True):
            a, b = m.of_url(host_ or "", path_ or "")
            words.append(" ".join(a))
            odds.append(m.prior + float(sum(m.odds[bucket(w)] for w in a) + sum(m.odds[bucket(w)] for w in b)) if a else 0.0)
        return pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(odds, pa.float64())], ["words", "log_odds"])
    return udf(host, path)


def with_verdict(pages: DataFrame, model: Model, rules: tuple = RULES, url: str = "url") -> DataFrame:
    """``pages`` with struct ``url_verdict``: host, path, rule, verdict, words, log_odds."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, ruled = match_rule(host, path, rules)
    own = judge(host, path, model, pages.sparkSession)
    said = F.coalesce(ruled, F.when(F.col("_own.log_odds") > 0, "block").otherwise("allow"))
    return (pages.withColumn("_own", own)
            .withColumn("url_verdict", F.struct(host.alias("host"), path.alias("path"), rule.alias("rule"), said.alias("verdict"),
                                                F.col("_own.words").alias("words"), F.col("_own.log_odds").alias("log_odds")))
            .drop("_own"))
