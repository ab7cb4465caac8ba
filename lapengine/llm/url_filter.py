"""URL filter: longest matching allow/block rule, else logistic regression on hashed character n-grams.

Everything runs as DataFrame expressions on the JVM.  The model is trained
from a small labelled URL table (``LABELLED_URLS`` or any ``url, blocked``
frame of that kind): each n-gram of host and path is hashed to one of
``buckets`` features, and the fitted coefficients become one literal array.

Defined cases: a null url, or one without ``://``, has an empty host and path;
it fits no rule and has no n-gram, so it is allowed.  Repeated rows are judged
row by row.  Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapengine.llm.registry import register, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The small labelled URL table: 1 = block.
LABELLED_URLS = [
    ("https://ads.example.com/click?id=1", 1), ("http://adserver.example.org/banner/728x90.gif", 1),
    ("https://ads-track.example.com/en/10", 1), ("http://m.ads-track.example.net/fr/7", 1),
    ("https://track.example.com/pixel.gif", 1), ("http://tracker.example.org/collect/v1", 1),
    ("https://clicks.example.net/redirect/offer", 1), ("http://popup-ads.example.com/win", 1),
    ("https://banner-exchange.example.org/show/12", 1), ("http://adtrack.example.com/imp/3", 1),
    ("https://casino-bonus.example.com/play-now", 1), ("http://online-casino.example.org/free-spins", 1),
    ("https://poker-bets.example.net/bonus/en", 1), ("http://bet-win-cash.example.com/promo", 1),
    ("https://cheap-pills.example.com/buy-now", 1), ("http://pharmacy-deals.example.org/pills/sale", 1),
    ("https://xxx-videos.example.com/adult/1", 1), ("http://adult-cams.example.net/live-xxx", 1),
    ("https://free-download-crack.example.com/keygen", 1), ("http://warez-crack.example.org/serial/5", 1),
    ("https://spam-links.example.com/seo/backlinks", 1), ("http://link-farm-spam.example.net/page/9", 1),
    ("https://analytics-track.example.com/beacon", 1), ("http://affiliate-click.example.org/aff/77", 1),
    ("https://doubleads.example.com/serve/adframe", 1), ("http://sponsor-ads.example.net/banner/top", 1),
    ("https://www.example.com/en/100", 0), ("http://www.example.org/fr/2044", 0),
    ("https://blog.example.com/de/31.html", 0), ("http://blog.example.net/es/4512/", 0),
    ("https://m.example.org/en/901?page=2", 0), ("http://m.example.com/fr/77#top", 0),
    ("https://news.example.com/2024/05/world", 0), ("http://news.example.org/politics/article/18", 0),
    ("https://docs.example.com/guide/install.html", 0), ("http://docs.example.net/reference/api", 0),
    ("https://wiki.example.org/wiki/Mathematics", 0), ("http://wiki.example.com/wiki/History_of_art", 0),
    ("https://library.example.net/books/1200", 0), ("http://library.example.org/catalogue/new", 0),
    ("https://university.example.com/courses/physics", 0), ("http://university.example.org/research/papers", 0),
    ("https://forum.example.com/thread/558", 0), ("http://forum.example.net/topic/en/12", 0),
    ("https://recipes.example.org/soup/tomato", 0), ("http://recipes.example.com/bread/rye", 0),
    ("https://weather.example.net/de/berlin", 0), ("http://weather.example.com/fr/paris", 0),
    ("https://tionsh.example.net/en/120", 0), ("http://blog.tionble.example.com/en/719", 0),
    ("https://m.therer.example.org/es/44", 0), ("http://www.ththes.example.net/en/60.html", 0),
]


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls on ``host`` or a subdomain whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
         Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, or nulls.  ``rules`` is a short list: it becomes one CASE."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def gram_buckets(host: Column, path: Column, sizes=(3, 4, 5), buckets: int = 2048) -> Column:
    """Hash buckets of the n-grams of ``host`` and of ``path`` (digits alike), with multiplicity."""
    def grams(part: Column, tag: str, n: int) -> Column:
        s = F.concat(F.lit("^"), F.translate(part, "123456789", "000000000"), F.lit("$"))
        at = F.when((F.length(part) > 0) & (F.length(s) >= n), F.sequence(F.lit(1), F.length(s) - (n - 1)))
        return F.transform(F.coalesce(at, F.array().cast("array<int>")),
                           lambda i: F.pmod(F.xxhash64(F.lit(tag), s.substr(i, F.lit(n))), F.lit(buckets)).cast("int"))
    return F.concat(*[grams(part, tag, n) for part, tag in ((host, "h"), (path, "p")) for n in sizes])


@dataclass(frozen=True)
class UrlModel:
    intercept: float
    weights: list[float]
    sizes: tuple[int, ...]
    buckets: int

    def probability(self, host: Column, path: Column) -> Column:
        """Probability of ``block``; 0 where there is no n-gram.  A url's mean feature length is one."""
        w = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")  # folded to one literal
        total = F.aggregate(gram_buckets(host, path, self.sizes, self.buckets),
                            F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
                            lambda a, b: F.struct((a["s"] + F.get(w, b)).alias("s"), (a["n"] + 1).alias("n")),
                            lambda a: F.when(a["n"] > 0, 1 / (1 + F.exp(-(a["s"] / F.sqrt(a["n"]) + self.intercept))))
                            .otherwise(0.0))
        return total


def train(labelled: DataFrame, sizes=(3, 4, 5), buckets: int = 2048, reg: float = 0.002) -> UrlModel:
    """Fit on a small frame ``url, blocked`` (0/1; rows with a null label are left out)."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where(F.col("blocked").isNotNull()).select(F.col("blocked").cast("double").alias("label"),
                                                               gram_buckets(host, path, sizes, buckets).alias("g"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)),
                         lambda i: F.size(F.filter(F.col("g"), lambda x: x == i)) / F.sqrt(F.greatest(F.size("g"), F.lit(1))))
    fit = LogisticRegression(regParam=reg, standardization=False, maxIter=50).fit(
        rows.select("label", array_to_vector(counts).alias("features")).coalesce(1))
    return UrlModel(float(fit.intercept), [float(x) for x in fit.coefficients.toArray()], tuple(sizes), buckets)


def judge(urls: DataFrame, model: UrlModel, rules=RULES, id_col: str = "page_id", url_col: str = "url",
          threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, probability."""
    host, path = host_and_path(F.col(url_col))
    parts = urls.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumns({"rule": rule, "_by_rule": verdict,
                                "probability": model.probability(F.col("host"), F.col("path"))})
    own = F.when(F.col("probability") >= threshold, "block").otherwise("allow")
    return scored.select(id_col, "host", "path", "rule", F.coalesce("_by_rule", own).alias("verdict"), "probability")


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELLED_URLS, "url string, blocked int")


@register("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: by the longest rule, else by the model."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, train(labelled_urls(spark))).select("page_id", "host", "path", "rule", "verdict")
