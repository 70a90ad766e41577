"""Spelling variant grouping by anagram hashing.

A word's key is the sum of its letters' fifth powers, so that it does not depend on the letters' order. Taking a letter
away lowers the key by that letter's power: two words that differ by one letter more have one key that is the other's less
a power; two that differ by one exchanged letter have keys that are equal once each has lost its own letter, which is the
same as keys that differ by the exchange value of the two letters. Both are equi-joins on integers. What they give are
words whose letters, in some order, are one edit apart; the letters' order is then verified by the edit distance itself.

All work is done by joins and aggregates over the distinct words (each word's keys: at most one row for each different
letter), after the occurrences have been counted where they were read; a word with a third of all occurrences is
one row. Exchanges of a letter for itself, that is plain anagrams, never leave the join, since they are never one edit
apart.

Edge cases: a null text has no words; a null doc_id counts as an empty string in the hash that deletes letters; equal
counts of two forms are settled by code-point order; rows that repeat are counted as often as they stand; a table without
words gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, no_clash

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, least_letters: int = 7, least_count: int = 2, slip_every: int = 31) -> DataFrame:
    """word, n: of the runs of letters of all texts, each as often as it stands. Where the hash of document and run is
    divisible by slip_every, the run loses one code point. Runs too short for least_letters are never split out."""
    text = F.translate(F.col("text"), UPPER, UPPER.lower())
    found = F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{max(1, least_letters)},}}"), F.lit(0))
    runs = no_clash(docs, "doc_id", "text").select("doc_id", F.explode(found).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % slip_every == 0, slipped).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= least_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _power(letter):
    code = F.ascii(letter).cast("bigint")
    return code * code * code * code * code


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: each ordered pair of words that are one insertion, deletion or exchange apart."""
    letters = F.split("word", "")
    key = F.aggregate(letters, F.lit(0).cast("bigint"), lambda total, c: total + _power(c))
    keyed = words.withColumn("key", key)
    less = keyed.select("word", "n", F.length("word").alias("size"), "key", F.explode(F.array_distinct(letters)).alias("letter")).select(
        "word", "n", "size", "letter", (F.col("key") - _power(F.col("letter"))).alias("key")
    )
    less = materialize(less, "spelling-keys")
    one_edit = F.levenshtein("word", "near", 1) == 1
    shorter = keyed.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.length("word").alias("near_size"))
    removed = less.join(shorter, "key").filter((F.col("near_size") == F.col("size") - 1) & one_edit)
    other = less.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("size").alias("near_size"), F.col("letter").alias("near_letter"))
    exchanged = less.join(other, "key").filter((F.col("word") < F.col("near")) & (F.col("letter") != F.col("near_letter")) & (F.col("size") == F.col("near_size")) & one_edit)
    pairs = removed.select("word", "n", "near", "near_n").unionByName(exchanged.select("word", "n", "near", "near_n"))
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def follow(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last one. A round doubles the length of what has been followed;
    since each form is many times as frequent as its word, chains are as short as the logarithm of the largest count."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = at.join(onward, "root", "left")
        done = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        at = done.select("word", "root")
        if not done.filter("moved").head(1):
            return at


def group_variants(docs: DataFrame, least_letters: int = 7, least_count: int = 2, ratio: int = 10, slip_every: int = 31) -> DataFrame:
    """word, form, root, n, n_near, form_n: a word's form is its near word of largest count, if that is at least ratio
    times its own; root is the last of the forms that follow each other."""
    words = materialize(word_counts(docs, least_letters, least_count, slip_every), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    enough = -F.col("best.minus") >= F.col("n") * ratio
    placed = materialize(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = follow(placed.filter("form IS NOT NULL").select("word", "form"))
    return placed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
