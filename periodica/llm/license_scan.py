"""License texts by diagonal voting. DataFrame operations only.

Templates are cut into rolling word k-grams with their positions. The k-gram hashes of all texts
are joined to them; a hit votes for the diagonal "position in the text minus position in the
template". Diagonals of a text and template that lie next to each other (a few words inserted or
left out) are merged. Votes are added up per merged span, one for each position of the template
however often it is met, and the span is verified: the words of every hit are compared as such, the
share of the template's positions that were met must reach ``MIN_COVERAGE``, and the span may not be
much longer than the template. Of equal starts or coverages all labels are reported.

Phrases are templates of two or three words. Their 2-grams all have to vote for one diagonal,
which is then a place where the words stand next to each other.

Templates of up to ``SMALL_TEMPLATES`` words together are broadcast and the texts' k-grams are never
shuffled; what is shuffled are hits. For more of them Spark chooses the join. Texts may have any length;
the hits of one text and template meet in one sorted window. NULL and empty texts have no words and no
labels. Rows repeated in full get equal results; an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from periodica.llm.common import lowered

# Phrases with their labels, and openings of published license texts.
PHRASES = {
    "cc-by": "cc by",
    "gpl": "general public license",
    "reserved": "all rights reserved",
}
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met"
    ),
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "gpl-3.0": "under the gnu general public license version 3",
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation"
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction"
    ),
}
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLACK = 3
MIN_COVERAGE = 0.6
SMALL_TEMPLATES = 100_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(text), SEPARATORS, -1), "")


def _grams(spark: SparkSession, texts: dict[str, str], k: int, name: str) -> DataFrame:
    """One row per distinct k-gram: its hash, its words, and all (template, position, k-grams of the template)."""
    rows = []
    for label, text in texts.items():
        words = text.split()
        total = len(words) - k + 1
        rows += [(words[i : i + k], label, i, total) for i in range(total)]
    grams = spark.createDataFrame(rows, "words array<string>, label string, at int, total int")
    place = F.struct("label", "at", "total", F.lit(k == 2).alias("phrase"))
    hashed = F.xxhash64(*[F.get("words", F.lit(i)) for i in range(k)])
    return grams.groupBy("words").agg(F.collect_list(place).alias(f"places_{name}")).select(
        hashed.alias(f"hash_{name}"), F.col("words").alias(f"words_{name}"), f"places_{name}"
    )


def hits_of(docs: DataFrame, phrases: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """Verified k-gram hits of (id, text_hash, words): label, at, total, phrase and the text position."""
    spark = docs.sparkSession
    rest = [F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))).alias(f"w{i}") for i in (1, 2)]
    rolled = F.arrays_zip(F.col("words").alias("w0"), *rest)
    stream = docs.select("id", "text_hash", F.posexplode(rolled).alias("pos", "w"))
    stream = stream.select("id", "text_hash", "pos", "w.w0", "w.w1", "w.w2")
    two, three = _grams(spark, phrases, 2, "2"), _grams(spark, templates, 3, "3")
    if sum(len(t.split()) for t in [*phrases.values(), *templates.values()]) <= SMALL_TEMPLATES:
        two, three = F.broadcast(two), F.broadcast(three)
    joined = stream.join(two, F.xxhash64("w0", "w1") == F.col("hash_2"), "left")
    joined = joined.join(three, F.xxhash64("w0", "w1", "w2") == F.col("hash_3"), "left")
    joined = joined.where("hash_2 is not null or hash_3 is not null")
    none = F.expr("cast(array() as array<struct<label:string,at:int,total:int,phrase:boolean>>)")
    met_2 = F.when(F.col("words_2").eqNullSafe(F.array("w0", "w1")), F.col("places_2")).otherwise(none)
    met_3 = F.when(F.col("words_3").eqNullSafe(F.array("w0", "w1", "w2")), F.col("places_3")).otherwise(none)
    return joined.select("id", "text_hash", "pos", F.inline(F.concat(met_2, met_3))).distinct()


def spans_of(hits: DataFrame) -> DataFrame:
    """Merged and verified diagonals: id, text_hash, label, phrase, start, end, coverage."""
    own = ["id", "text_hash", "label", "phrase", "total"]
    diagonal = F.col("pos") - F.col("at")
    by_diagonal = Window.partitionBy(*own).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > F.when(F.col("phrase"), 0).otherwise(SLACK)
    island = F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(by_diagonal)
    marked = hits.withColumn("diagonal", diagonal).withColumn("island", island)
    met = marked.groupBy(*own, "island", "at").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    merged = met.groupBy(*own, "island").agg(
        F.count("*").alias("votes"), F.min("first").alias("start"), F.max("last").alias("last")
    )
    width = F.when(F.col("phrase"), 2).otherwise(3)
    coverage = F.col("votes") / F.col("total")
    spans = merged.select(
        "id", "text_hash", "label", "phrase", "total", "start", (F.col("last") + width).alias("end"), coverage.alias("coverage")
    )
    exact = F.col("phrase") & (F.col("coverage") == 1.0)
    near = ~F.col("phrase") & (F.col("coverage") >= MIN_COVERAGE) & (F.col("end") - F.col("start") <= 1.5 * F.col("total") + SLACK)
    return spans.where(exact | near).drop("total")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``phrases`` (two words or more) and ``templates`` (three or more) map labels to lower-case words.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("words"))
    found = spans_of(hits_of(named, phrases, templates)).groupBy("id", "text_hash").agg(
        F.sum(F.col("phrase").cast("long")).alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("start"))).cast("long").alias("last_word"),
        F.collect_set(F.when(F.col("phrase"), F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"),
        F.max("coverage").alias("score"),
    )
    found = found.select(F.struct("id", "text_hash").alias("of"), "n_base", "first_word", "last_word", "base", "all", "score")
    own = named.select("id", "text_hash", F.size("words").cast("long").alias("n_words"))
    rows = own.join(found, F.struct("id", "text_hash").eqNullSafe(F.col("of")), "left")

    def listed(labels: str) -> Column:
        return F.coalesce(F.array_join(F.array_sort(labels), ","), F.lit(""))

    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        listed("base").alias("base_labels"),
        listed("all").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
