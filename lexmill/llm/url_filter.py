"""URL filters: rules for hosts and paths, and a logistic regression for all other URLs.

DataFrame operations and Spark ML only. The regression sees hashed character
n-grams of host and path and is trained on a small labelled table of URLs.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import LOWER, UPPER, staged
from lexmill.session import local_copy, scratch_path, small_rows

NGRAMS = (3, 4)
FEATURES = 1 << 14

# What an unwanted URL of the labelled table counts, as there are fewer of them.
UNWANTED_WEIGHT = 3.0

# Rules up to this number become one expression; more, and tables of rules, are joined.
MOST_RULES = 500

# What host names of the labelled table are made of. Unwanted: gambling, advertising, spam, adult
# content, medicines, swindle. Wanted: words of everyday sites. Tails go with either.
UNWANTED = (
    "casino poker roulette blackjack jackpot slots betting bets lottery gamble bingo adserver adclick adnetwork banner "
    "popup clicktrack tracker doubleads spam spammer linkfarm seolinks backlink adult xxx porn sexcam escort hotgirls "
    "nude pills viagra pharmacy cialis meds drugstore replica rolex fakebags payday loans credit quickcash prize winner "
    "freemoney bitcoin giveaway crack keygen warez torrent phishing malware"
).split()
WANTED = (
    "library museum garden kitchen history science physics teachers weather harbour railway orchestra village gazette "
    "theatre journal archive research students hospital nation another ontario therapy inland eastern thatch thread "
    "breathe charity chapter nations mother stations northern recipes cycling choir parish council college bakery "
    "atlas botany climbing dictionary encyclopedia forestry geology hiking insurance justice language mountain novel"
).split()
# Most hosts are names that say nothing: so many are made by rule, from syllables, and are wanted.
NEUTRAL = 600
CONSONANTS = ("b c d f g h k l m n p r s t v w z th sh st tr br gr pl").split()
VOWELS = ("a e i o u ea ou er en an in on or").split()
TAILS = ("", "-online", "hub", "-club", "24", "world")
TOPS = ("com", "net", "org", "info", "de", "fr", "co.uk", "io")
PATHS = ("/", "/index.html", "/news/{n}", "/p/{n}.html", "/a/b/{n}/", "/{n}")


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): label 1 is to be blocked. Every word with several tails, domains and paths, by rule."""
    return labelled(spark, UNWANTED, WANTED)


def neutral_names(n: int) -> list[str]:
    """Names of two to four syllables, chosen by the checksum of their number."""
    names = []
    for i in range(n):
        digits, name = zlib.crc32(b"name %d" % i), ""
        for _ in range(2 + i % 3):
            digits, c = divmod(digits, len(CONSONANTS))
            digits, v = divmod(digits, len(VOWELS))
            name += CONSONANTS[c] + VOWELS[v]
        names.append(name)
    return names


def labelled(spark: SparkSession, unwanted: list[str], wanted: list[str]) -> DataFrame:
    rows = []
    for label, words, tails in ((1.0, unwanted, TAILS), (0.0, wanted, TAILS), (0.0, neutral_names(NEUTRAL), TAILS[:1])):
        for i, word in enumerate(words):
            for j, tail in enumerate(tails):
                k = 7 * i + 3 * j
                prefix = ("", "www.", "m.", "blog.")[k % 4]
                path = PATHS[k % len(PATHS)].format(n=37 * i + j)
                rows.append((f"https://{prefix}{word}{tail}.{TOPS[k % len(TOPS)]}{path}", label))
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first "://" and "/", "?", "#" or the end, A-Z lower-cased; then up to "?", "#" or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. A rule fits its host, all
    subdomains, and paths that start with its path; of rules given twice the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.host) + len(r.path)):  # the last one set wins
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        rule = F.when(fits, F.lit(r.host + r.path)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def ngrams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each marked with where it is from; a URL shorter than n has none."""

    def grams(mark: str, text: Column, n: int) -> Column:
        last = F.char_length(text) - n + 1
        places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n))))

    ends = F.concat(F.lit("^"), host, F.lit("$"))
    return F.concat(*(grams(m, t, n) for n in NGRAMS for m, t in (("h", ends), ("p", path))))


def train(labelled: DataFrame) -> PipelineModel:
    """A logistic regression fitted on ``labelled(url, label)``."""
    host, path = host_and_path(labelled["url"])
    weight = F.when(F.col("label") == 1, UNWANTED_WEIGHT).otherwise(1.0)
    rows = labelled.select("label", weight.alias("weight"), ngrams(host, path).alias("grams")).persist()
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    regression = LogisticRegression(maxIter=60, regParam=1e-4, standardization=False, weightCol="weight")
    fitted = Pipeline(stages=[hashing, regression]).fit(rows)
    rows.unpersist()
    # a fitted model holds its training table, which cannot be sent to tasks of a session that has observed a query
    path = scratch_path(labelled.sparkSession, "url-model")
    fitted.write().save(path)
    return PipelineModel.load(path)


def suffixes(host: Column) -> Column:
    """A host and all domains it is in; without the host itself if that is empty."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def with_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows(host, path, ...)`` with ``rule`` and ``ruled`` by a table ``rules(verdict, host, path)`` of any size.

    Each domain of a host meets the rules for it. Of rules given twice ``allow`` counts.
    """
    row = "url filter row"
    numbered = staged(rows.withColumn(row, F.monotonically_increasing_id()), "urls")
    per_host = rules.groupBy("host").agg(F.collect_set(F.struct("path", "verdict")).alias("own"))
    few = small_rows(per_host)
    per_host = per_host if few is None else F.broadcast(local_copy(per_host, few))
    domains = numbered.select(row, "path", F.explode(suffixes(F.col("host"))).alias("host"))
    fits = F.filter("own", lambda r: F.startswith(F.col("path"), r.path))
    best = lambda r: F.struct(
        F.char_length(r.path).alias("length"), (r.verdict == "allow").alias("allow"), F.col("host"), r.path.alias("path"), r.verdict.alias("verdict")
    )
    found = domains.join(per_host, "host")
    found = found.select(row, F.char_length("host").alias("size"), F.array_max(F.transform(fits, best)).alias("own")).where("own is not null")
    longest = found.groupBy(row).agg(
        F.max(F.struct((F.col("size") + F.col("own.length")).alias("size"), F.col("own.allow").alias("allow"), "own")).alias("best")
    )
    rule = F.concat("best.own.host", "best.own.path")
    return numbered.join(longest, row, "left").withColumns({"rule": rule, "ruled": F.col("best.own.verdict")}).drop(row, "best")


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, model: PipelineModel) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages(page_id, url)``.

    ``rules`` is a list or a table (verdict, host, path). ``score`` is the regression's
    probability that the URL is unwanted; it decides (from 0.5 on: block) where no rule
    fits. A null URL or one without "://" has an empty host and path, and gets the
    regression's verdict on no n-grams. Repeated rows come back as often; other columns,
    whatever their names, are not used. Of rules given twice the first of a list counts,
    and ``allow`` in a table or a long list.
    """
    host, path = host_and_path(pages["url"])
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    if isinstance(rules, list) and len(rules) <= MOST_RULES:
        rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
        rows = rows.withColumns({"rule": rule, "ruled": verdict})
    else:
        if isinstance(rules, list):
            rules = pages.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
        rows = with_rules(rows, rules)
    rows = rows.withColumn("grams", ngrams(F.col("host"), F.col("path")))
    score = vector_to_array("probability")[1]
    found = F.coalesce("ruled", F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    scored = model.transform(rows).withColumn("score", score)
    return scored.select("page_id", "host", "path", "rule", found.alias("verdict"), "score")
