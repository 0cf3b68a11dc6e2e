"""License scans by diagonal voting. DataFrame functions only.

Templates are word sequences with a label. Every text's rolling word bigrams are joined to the bigrams of the
templates by their hash; a match at text position p and template position q votes for the offset diagonal
p - q. Votes are counted per text, template and diagonal; neighbouring diagonals (a few words put in or left
out) are merged into spans, and a span counts if enough of the template's bigrams are in it. The base phrases
must stand word for word, which is a diagonal with a vote from each of their bigrams.

The template bigrams are the only broadcast: their number is fixed by TEMPLATES, a parameter.

Defined cases: a null or empty text has no words, no labels, score 0 and null positions. Rows with the same
doc_id and text are one row in the result; other rows of one doc_id each have their own. Texts with any
number of words are handled row by row of bigrams, never as one value in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.llm.common import doc_texts

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases that have to be found word for word.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Templates for approximate matching, from the usual notices of public licenses.
TEMPLATES = (
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution license", "cc-by"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("mozilla public license version 2 0", "mpl"),
    ("all rights reserved", "proprietary"),
)
COVERAGE = 0.75  # share of a template's bigrams a span must hold
DRIFT = 3  # most words that may be put in or left out between neighbouring diagonals


def template_bigrams(spark: SparkSession) -> DataFrame:
    """gram, hash, template (negative: base phrase), q and size (bigrams of the template)."""
    rows = []
    for sign, group in ((-1, BASE), (1, TEMPLATES)):
        for n, (phrase, label) in enumerate(group, 1):
            words = phrase.split()
            rows += [
                F.struct(
                    F.lit(f"{words[q]} {words[q + 1]}").alias("gram"), F.lit(sign * n).alias("template"),
                    F.lit(label).alias("label"), F.lit(q).alias("q"), F.lit(len(words) - 1).alias("size"),
                )
                for q in range(len(words) - 1)
            ]
    grams = spark.range(1).select(F.inline(F.array(*rows)))
    return grams.select("template", "label", "q", "size", F.xxhash64("gram").alias("hash"), F.col("gram").alias("t_gram"))


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    score is the best coverage of any template, 1 for a base phrase. spans lists what was found: label, first
    and last word and coverage.
    """
    words = doc_texts(docs).select(
        "doc_id", F.monotonically_increasing_id().alias("key"),  # tells equal rows apart
        F.regexp_extract_all(_lower_ascii(F.col("text")), F.lit(WORD), F.lit(0)).alias("w"),
    )
    # One more array entry than bigrams (the null) carries texts without any match.
    grams = F.transform("w", lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1)))
    words = words.select("doc_id", "key", F.size("w").cast("bigint").alias("n_words"), grams.alias("grams"))
    rows = words.select("doc_id", "key", "n_words", F.posexplode_outer("grams").alias("p", "gram"))
    rows = rows.withColumn("hash", F.xxhash64("gram"))
    hits = rows.join(F.broadcast(template_bigrams(docs.sparkSession)), "hash", "left")
    hits = hits.where((F.col("gram") == F.col("t_gram")) | F.col("gram").isNull())
    diagonals = hits.groupBy("doc_id", "key", "n_words", "template", "label", "size", (F.col("p") - F.col("q")).alias("d"))
    diagonals = diagonals.agg(
        F.count("q").alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"),
        F.collect_set("q").alias("qs"),  # at most as many as the template has bigrams
    )
    return _spans(diagonals)


def _spans(diagonals: DataFrame) -> DataFrame:
    text = ["doc_id", "key", "n_words"]
    order = Window.partitionBy(*text, "template").orderBy("d")
    # A diagonal joins the one before if it drifts by a few words and its matches lie beside the other's.
    beside = (F.col("d") - F.lag("d").over(order) <= DRIFT) & (
        F.col("low") - F.lag("high").over(order) <= F.col("size")
    )
    merged = diagonals.withColumn("new", F.when((F.col("template") > 0) & beside, 0).otherwise(1))
    merged = merged.withColumn("span", F.sum("new").over(order))
    spans = merged.groupBy(*text, "template", "label", "size", "span").agg(
        F.min("d").alias("d"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("covered"),
    )
    spans = spans.withColumn("coverage", F.col("covered") / F.col("size"))
    base = F.expr("template < 0 AND covered = size")
    found = base | F.expr(f"template > 0 AND coverage >= {COVERAGE}")
    hit = F.struct("low", (F.col("high") + 1).alias("high"), "label", "coverage")
    out = spans.groupBy(*text).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("d"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("d"))).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(found, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(base | (F.col("template") > 0), F.col("coverage"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(found, hit))).alias("spans"),
    )
    return out.drop("key")
