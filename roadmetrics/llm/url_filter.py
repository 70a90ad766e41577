"""URL judging: explicit host/path rules first, then host word segmentation and multinomial naive Bayes.

Runs of letters in host names are split into words by unigram Viterbi. The unigram counts come from the urls themselves:
a word counts once for each distinct host that has it as a separate word of a path (unless it is a run of that host), for
each host that has it as a whole run, and for each distinct run that begins or ends with it. What a run says of itself
does not count when it is split, so a concatenated name is no word of its own, however many pages it has. Seed words add
a share of all counts. A word of n letters that nothing is known of costs as much as the rarest word and a factor of ten
per letter. A word has at most ``longest`` letters.

A multinomial naive Bayes over the host's words and the path's tokens is fitted on the distinct (host, path) that the
rules judge; the seed words count ``seed_count`` times for their class. Rules are no sample of all urls, so the prior is a
parameter. It gives the verdict where no rule fits; tokens that no judged url and no seed list has say nothing.

Counts, candidates and odds are tables and joins, without a cut by frequency; only Viterbi, run by run, is Python. Tables
are broadcast if they have been counted to be small, else joined by shuffle.

Edge cases: a null url, or one without ``://``, has an empty host and path and is judged by the prior (allow); ports
and user names stay part of the host; repeated rows are judged alike; a host of any length is split in time proportional
to its length; an empty table gives an empty result; columns of other names are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, materialize, no_clash

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Seed words of the naive Bayes, each counted once for its class.
BLOCK_WORDS = (
    "ads adult adserver affiliate banner bet bets betting bingo bonus casino cheap click clicks coupon crypto deal discount "
    "escort free gamble gambling jackpot keygen loan loans lottery nude offer offers payday pharma pharmacy pill pills "
    "poker popup porn promo replica roulette sex slots spam sponsor tracker track tracking viagra warez win xxx"
).split()
ALLOW_WORDS = (
    "academy archive article articles blog books city college community course data docs education forum garden gov guide "
    "health help history home journal kitchen lab learn library magazine maps math museum music nature news notes open "
    "paper photo press recipes research school science society sport story travel university weather wiki world"
).split()
#: Host labels that say nothing about the content.
PLAIN_LABELS = frozenset("www m blog example com org net info io co html htm php".split())
#: Rows up to which a counted table is broadcast.
SMALL = 200_000


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def rule_verdict(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (null if none) and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def _runs(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(text, F.lit("([a-z]{2,})"), 1), lambda w: ~w.isin(*PLAIN_LABELS))


def path_tokens(path: Column) -> Column:
    return F.filter(F.regexp_extract_all(F.lower(path), F.lit("([a-z0-9]+)"), 1), lambda w: ~w.isin(*PLAIN_LABELS))


def word_counts(sites: DataFrame, runs: DataFrame, longest: int) -> DataFrame:
    """word, apart (as a word of a path), whole (as a run of a host), inner (at an end of a longer run): distinct hosts
    and runs that have it."""
    own = _runs(F.col("host"))
    fits = lambda words: F.filter(words, lambda w: F.length(w) <= longest)
    apart = sites.select("host", F.explode(fits(F.array_except(_runs(F.lower("path")), own))).alias("word")).distinct().select("word", F.lit(0).alias("kind"))
    whole = sites.select("host", F.explode(fits(F.array_distinct(own))).alias("word")).distinct().select("word", F.lit(1).alias("kind"))
    sizes = F.sequence(F.lit(2), F.least(F.length("run") - 1, F.lit(longest)))
    ends = F.flatten(F.transform(sizes, lambda n: F.array(F.substr("run", F.lit(1), n), F.substr("run", F.length("run") - n + 1, n))))
    inner = runs.filter(F.length("run") > 2).select(F.explode(ends).alias("word"), F.lit(2).alias("kind"))
    count = lambda k: F.count(F.when(F.col("kind") == k, 1))
    return apart.unionByName(whole).unionByName(inner).groupBy("word").agg(count(0).alias("apart"), count(1).alias("whole"), count(2).alias("inner"))


def candidates(runs: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """run, words (array of start, size, n): the parts of each run that are words without what the run says of itself."""
    starts = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run") - 1)).alias("start"))
    sizes = F.sequence(F.lit(2), F.least(F.length("run") - F.col("start") + 1, F.lit(longest)))
    parts = starts.select("run", "start", F.explode(sizes).alias("size")).withColumn("word", F.substr("run", F.col("start"), F.col("size")))
    seeds = counts.sparkSession.createDataFrame([(w,) for w in sorted({*BLOCK_WORDS, *ALLOW_WORDS})], "word string").withColumn("seed", F.lit(1))
    known = bounded_broadcast(counts.join(F.broadcast(seeds), "word", "full").fillna(0, ["apart", "whole", "inner", "seed"]), SMALL)
    entire = F.col("size") == F.length("run")
    own = F.startswith("run", "word").cast("int") + F.endswith("run", "word").cast("int")
    n = F.col("apart") + F.when(entire, F.col("inner")).otherwise(F.col("whole") + F.col("inner") - own)
    found = parts.join(known, "word").select("run", F.struct("start", "size", n.alias("n"), "seed").alias("w")).filter("w.n > 0 OR w.seed > 0")
    return runs.join(found.groupBy("run").agg(F.collect_list("w").alias("words")), "run", "left")


def viterbi(run: str, words: list[tuple[int, int, float]], total: float, longest: int) -> list[str]:
    """The cheapest split of run; words are (start, size, count), a part that is not among them is unknown."""
    ending: dict[int, list] = {}
    for start, size, n in words:
        ending.setdefault(start + size, []).append((start, math.log10(total / n)))
    unknown = math.log10(total)
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        low = max(0, end - longest)
        cost = {start: best[start] + unknown + end - start for start in range(low, end)}
        for start, c in ending.get(end, ()):
            cost[start] = best[start] + c
        at = min(cost, key=lambda start: (cost[start], start))
        best.append(cost[at])
        back.append(at)
    out, end = [], len(run)
    while end:
        out.append(run[back[end] : end])
        end = back[end]
    return out[::-1]


def _split(total: float, seed: float, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [viterbi(r, [(w["start"] - 1, w["size"], w["n"] + w["seed"] * seed) for w in words or ()], total, longest) for r, words in zip(batch.column("run").to_pylist(), batch.column("words").to_pylist())]
            yield pa.RecordBatch.from_pydict({"run": batch.column("run"), "words": pa.array(out, pa.list_(pa.string()))})

    return run


def host_words(sites: DataFrame, longest: int = 32, seed_share: float = 1e-3) -> DataFrame:
    """host, words: the words of all runs of each distinct host, in order."""
    own = F.posexplode(_runs(F.col("host"))).alias("at", "run")
    of_host = sites.select("host").distinct()
    runs = of_host.select(own).select("run").distinct()
    counts = materialize(word_counts(sites, runs, longest), "url-words")
    counted = counts.agg(F.sum(F.col("apart") + F.col("whole") + F.col("inner"))).first()[0] or 0
    seed = max(50.0, seed_share * counted)
    total = counted + seed * len({*BLOCK_WORDS, *ALLOW_WORDS})
    split = materialize(candidates(runs, counts, longest).mapInArrow(_split(total, seed, longest), "run string, words array<string>"), "url-runs")
    parts = of_host.select("host", own).join(bounded_broadcast(split, SMALL), "run")
    together = parts.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
    return together.select("host", F.flatten(F.transform("parts", lambda p: p["words"])).alias("words"))


def token_odds(judged: DataFrame, words: DataFrame, seed_count: int, alpha: float) -> DataFrame:
    """token, odds: log ratio of the token's probabilities among blocked and allowed (host, path), of multinomial counts
    with alpha added. A host's words count once for each of its judged paths."""
    paths = judged.groupBy("host", "verdict").agg(F.count(F.lit(1)).alias("n"))
    of_host = paths.join(words, "host").select(F.explode("words").alias("token"), "verdict", "n")
    of_path = judged.select(F.explode(path_tokens(F.col("path"))).alias("token"), "verdict", F.lit(1).cast("bigint").alias("n"))
    seeds = judged.sparkSession.createDataFrame([(w, v, seed_count) for v, list_ in (("block", BLOCK_WORDS), ("allow", ALLOW_WORDS)) for w in list_], "token string, verdict string, n bigint")
    n = lambda v: F.coalesce(F.sum(F.when(F.col("verdict") == v, F.col("n"))), F.lit(0))
    counts = materialize(of_host.unionByName(of_path).unionByName(seeds).groupBy("token").agg(n("block").alias("block"), n("allow").alias("allow")), "url-tokens")
    size, block, allow = counts.agg(F.count(F.lit(1)), F.sum("block"), F.sum("allow")).first()
    share = lambda c, of: F.log((F.col(c) + alpha) / F.lit(of + alpha * size))
    return counts.select("token", (share("block", block) - share("allow", allow)).alias("odds"))


def _scores(tokens: DataFrame, key: str, odds: DataFrame) -> DataFrame:
    """Per key the sum of the odds of its tokens."""
    return tokens.select(key, F.explode("tokens").alias("token")).join(odds, "token").groupBy(key).agg(F.sum("odds").alias(f"{key}_odds"))


def judge_urls(pages: DataFrame, rules=RULES, prior_block: float = 0.3, seed_count: int = 20, alpha: float = 0.1) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict (allow or block), host_words, block_score."""
    url = F.col("url")
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    urls = no_clash(pages, "page_id", "url").select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).withColumns({"rule": rule, "verdict": verdict})
    sites = materialize(urls.select("host", "path", "verdict").distinct(), "url-sites")
    words = materialize(host_words(sites), "url-hosts")
    odds = bounded_broadcast(materialize(token_odds(sites.filter("verdict IS NOT NULL"), words, seed_count, alpha), "url-odds"), SMALL)
    hosts = words.join(_scores(words.select("host", F.col("words").alias("tokens")), "host", odds), "host", "left")
    paths = _scores(sites.select("path").distinct().select("path", path_tokens(F.col("path")).alias("tokens")), "path", odds)
    logit = F.lit(math.log(prior_block / (1 - prior_block))) + F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0))
    known = urls.join(bounded_broadcast(materialize(hosts, "url-host-odds"), SMALL), "host", "left").join(bounded_broadcast(materialize(paths, "url-path-odds"), SMALL), "path", "left")
    scored = known.withColumn("block_score", F.round(1 / (1 + F.exp(-logit)), 9))
    by_method = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), F.coalesce(F.array_join("words", " "), F.lit("")).alias("host_words"), "block_score")
