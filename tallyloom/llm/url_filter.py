"""URL filters by association rules.

A URL becomes a set of tokens: labels and domain of its host, segments and ending of its path, names in
its query, its fragment. Spark's FP-growth mines the token sets of bad pages for combinations that enough of
them hold; how many labelled pages hold a combination is counted by a join, and rules with enough
confidence stay. They match through an inverted index: each
rule is listed once, under the rarest of its tokens, so a URL meets only the rules of its own tokens and
then checks that the rest of a rule is there as well. Tokens that occur in the same labelled URLs only are
one item for all of this: any of them stands for all, as each by itself would make the same rules.

Fixed rules by host and path come before the mined ones; of those that fit, the longest decides.

Itemsets are mined from all bad pages and counted over all labelled ones. A number of bad pages is
proof at every size of the table, so a rule found on a small table is found in a large one as well.
Itemsets, rules and index stay tables. URLs are judged once each, however often they occur.

Defined cases: a null URL and one without ``://`` have an empty host and path, no tokens, and are
allowed; with hardly any labelled pages nothing is mined and pages without a fixed rule are allowed; of
matching mined rules the most confident is named, then the first by its text; repeated rows get the same verdict;
an empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import joined
from tallyloom.session import as_table

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Fixed:
    """Fits a host and all its subdomains where the path begins like the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


@dataclass(frozen=True)
class Mining:
    support: float = 0.0  # least share of the labelled pages that hold all tokens and are bad
    pages: int = 20  # and least number of such pages: fewer prove nothing
    confidence: float = 0.6  # least share of bad pages among those that hold all tokens


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), capitals, capitals.lower()),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL; numbers in a path are none, as they name single pages."""
    def each(values: Column, mark: str) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(mark), v))

    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    domain = F.array(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."))
    below = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    segments = F.filter(F.split(F.regexp_replace(path, r"\.[A-Za-z0-9]{1,5}$", ""), "/"), lambda v: ~v.rlike("^[0-9]+$"))
    ending = F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda v: F.regexp_extract(v, "^[^=]*", 0))
    fragment = F.array(F.regexp_extract(F.coalesce(url, F.lit("")), "#(.*)$", 1))
    found = F.concat(each(below, "host:"), each(domain, "domain:"), each(segments, "path:"), each(ending, "ending:"),
                     each(names, "query:"), each(fragment, "fragment:"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def _leaders(baskets: DataFrame) -> DataFrame:
    """(token, leader) of the tokens that have one: the first by name of those in exactly the same baskets."""
    mark = F.xxhash64("own")
    seen = baskets.select(F.explode("own").alias("token"), mark.alias("m")).groupBy("token").agg(
        F.count("*").alias("n"), F.sum(F.col("m").cast("decimal(38,0)")).alias("sum"), F.bit_xor("m").alias("xor"))
    first = seen.groupBy("n", "sum", "xor").agg(F.min("token").alias("leader"), F.count("*").alias("size")).where("size > 1")
    return as_table(joined(seen, first, ["n", "sum", "xor"]).where("token <> leader").select("token", "leader"), "url-twins")


def _led(rows: DataFrame, key: str, twins: DataFrame) -> DataFrame:
    """(key, led, own): the leaders of a row's tokens, and beside each the first of the row's tokens that it leads."""
    each = rows.select(key, F.explode("own").alias("token"))
    known = joined(each, twins, ["token"], "left").select(key, F.coalesce("leader", "token").alias("leader"), "token")
    first = known.groupBy(key, "leader").agg(F.min("token").alias("token"))
    # As many as a URL has tokens.
    return first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("leader", "token"))).alias("pairs")).select(
        key, F.col("pairs.leader").alias("led"), F.col("pairs.token").alias("own"))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> tuple[DataFrame, DataFrame] | None:
    """Rules (tokens, anchor, confidence) and twins (token, leader); ``labelled`` holds (url, bad).

    Tokens that occur in the same labelled URLs only are one token for the mining, named by the first of
    them: the shared segments of a family of URLs make one item, not a set for each of their combinations.
    """
    bad = F.col("bad")
    sets = as_table(labelled.where("bad is not null").select(F.array_sort(tokens_of(F.col("url"))).alias("own"), "bad")
                    .where((F.size("own") > 0) | bad).groupBy("own")
                    .agg(F.count("*").alias("pages"), F.sum(bad.cast("long")).alias("bad")), "url-token-sets")
    whole = sets.where(F.size("own") > 0)
    count = sets.agg(F.sum("pages")).first()[0] or 0
    proofs = whole.agg(F.sum("bad")).first()[0] or 0
    least = max(mining.pages, math.ceil(mining.support * count - 1e-9), 1)
    if proofs < least:
        return None
    twins = _leaders(whole)
    numbered = as_table(whole.withColumn("basket", F.monotonically_increasing_id()), "url-baskets")
    led = _led(numbered.select("basket", "own"), "basket", twins)
    baskets = as_table(numbered.drop("own").join(led.select("basket", F.col("led").alias("own")), "basket"), "url-led-baskets")
    each = baskets.where(bad > 0).select("own", F.explode(F.sequence(F.lit(1).cast("long"), bad))).select("own")
    # Half a page less, so that rounding of the share cannot ask for one more.
    model = FPGrowth(itemsCol="own", minSupport=(least - 0.5) / proofs).fit(each)
    sought = as_table(model.freqItemsets.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad")),
                      "url-itemsets")
    exploded = baskets.select("own", "pages", F.explode("own").alias("anchor"))
    often = exploded.groupBy(F.col("anchor").alias("token")).agg(F.sum("pages").alias("freq"))
    rarest = (sought.select("tokens", "bad", F.explode("tokens").alias("token")).join(often, "token")
              .groupBy("tokens").agg(F.max("bad").alias("bad"), F.min(F.struct("freq", "token")).alias("rarest"))
              .select("tokens", "bad", F.col("rarest.token").alias("anchor")))
    held = (joined(exploded, rarest, ["anchor"]).where(F.size(F.array_except("tokens", "own")) == 0)
            .groupBy("tokens").agg(F.max("anchor").alias("anchor"), (F.max("bad") / F.sum("pages")).alias("confidence")))
    rules = held.where(F.col("confidence") >= mining.confidence).select("tokens", "anchor", "confidence")
    return as_table(rules, "url-rules"), twins


def match(urls: DataFrame, rules: DataFrame, twins: DataFrame) -> DataFrame:
    """(url, found): for each distinct URL that a mined rule fits, the most confident one.

    A rule fits if the URL has, for each of its tokens, that token or a twin; it is named by those the URL has.
    """
    led = _led(urls.select("url", tokens_of(F.col("url")).alias("own")), "url", twins)
    met = (led.select("url", "led", "own", F.explode("led").alias("anchor"))
           .join(rules, "anchor").where(F.size(F.array_except("tokens", "led")) == 0))
    named = F.array_join(F.array_sort(F.transform("tokens", lambda t: F.get("own", (F.array_position("led", t) - 1).cast("int")))), " ")
    best = F.min(F.struct((-F.col("confidence")).alias("less"), named.alias("name"))).alias("found")
    return met.groupBy("url").agg(best).select("url", F.struct("found.name", (-F.col("found.less")).alias("confidence"))
                                               .alias("found"))


def judge(pages: DataFrame, labelled: DataFrame, fixed: list[Fixed], mining: Mining = Mining()) -> DataFrame:
    """page_id, url, host, path, rule, verdict, mined and confidence of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    mined_rules = mine(labelled, mining)
    if mined_rules is None:
        found = rows.withColumn("found", F.lit(None).cast("struct<name:string,confidence:double>"))
    else:
        found = joined(rows, match(rows.where("url is not null").select("url").distinct(), *mined_rules), ["url"], "left")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule = verdict = F.lit(None).cast("string")
    for f in sorted(fixed, key=lambda f: len(f.text)):  # the longest that fits is asked first
        rule = F.when(f.fits(host, path), f.text).otherwise(rule)
        verdict = F.when(f.fits(host, path), f.verdict).otherwise(verdict)
    mined = F.when(F.col("found").isNotNull(), BLOCK).otherwise(ALLOW)
    return found.select("page_id", "url", host.alias("host"), path.alias("path"), rule.alias("rule"),
                        F.coalesce(verdict, mined).alias("verdict"), F.col("found.name").alias("mined"),
                        F.col("found.confidence").alias("confidence"))
