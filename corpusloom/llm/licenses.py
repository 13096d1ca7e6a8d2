"""License scan by diagonal voting, in DataFrame functions only.

Every rolling word 3-gram of a text is hashed and joined to the positions of the same grams in a fixed
set of license templates. A hit votes for a diagonal: its place in the text minus its place in the
template. All grams of an undisturbed copy vote for one diagonal; insertions and deletions shift it by a
few words, so neighbouring diagonals are merged to one span. A span is verified on the grams' own words
and counts when it covers enough of its template.

Texts that are null, empty or without words have no gram and no label. Repeated rows get the same result.
Extra columns do not matter. The templates are constants of this module, so the joined side is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

GRAM = 3
SHIFT = 3  # words by which neighbouring diagonals may differ
COVERAGE = 0.6

# The phrases that always count, with their labels.
BASE_PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Opening words of well-known public license notices.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_words(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``words``: lower-cased runs of ASCII letters and digits and of characters from U+0080.

    A text without words gives one empty word. The one-element explode keeps later projections and filters
    from repeating the split.
    """
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    words = F.split(F.btrim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")), " ")
    return docs.select(*keys, F.explode(F.array(words)).alias("words"))


def template_grams(spark: SparkSession) -> DataFrame:
    """(template, label, base, need, position, template_gram, hash) of the fixed templates; need counts its grams."""
    rows = []
    for number, (phrase, label) in enumerate(BASE_PHRASES + NOTICES):
        words = phrase.split()
        grams = [" ".join(words[i : i + GRAM]) for i in range(len(words) - GRAM + 1)]
        rows += [(number, label, number < len(BASE_PHRASES), len(grams), i, gram) for i, gram in enumerate(grams)]
    values = ", ".join(f"({n}, '{label}', {base}, {need}, {at}, '{gram}')" for n, label, base, need, at, gram in rows)
    names = "template, label, base, need, position, template_gram"
    return spark.sql(f"SELECT *, xxhash64(template_gram) AS hash FROM VALUES {values} AS t({names})")


def diagonals(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Votes: per ``keys``, template and diagonal the template positions hit."""
    # Scan, split, explode, hash and broadcast join run in one generated loop; words are carried by reference.
    placed = with_words(docs, keys).select(*keys, "words", F.posexplode("words").alias("at", "word"))
    gram = F.concat_ws(" ", "word", F.get("words", F.col("at") + 1), F.get("words", F.col("at") + 2))
    hits = placed.select(*keys, "at", gram.alias("gram")).withColumn("hash", F.xxhash64("gram"))
    hits = hits.join(F.broadcast(template_grams(docs.sparkSession)), "hash").where(F.col("gram") == F.col("template_gram"))
    hits = hits.withColumn("diagonal", F.col("at") - F.col("position"))
    return hits.groupBy(*keys, "template", "label", "base", "need", "diagonal").agg(
        F.collect_set("position").alias("positions")
    )


def spans(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Merge neighbouring diagonals: (keys, template, label, first, last, coverage) of every verified span."""
    order = Window.partitionBy(*keys, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT
    runs = votes.withColumn("run", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order))
    merged = runs.groupBy(*keys, "template", "label", "need", "run").agg(
        F.min(F.col("diagonal") + F.array_min("positions")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("positions") + GRAM - 1).alias("last"),
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("votes"),
    )
    covered = F.col("votes") / F.col("need")
    return merged.select(*keys, "template", "label", "first", "last", covered.alias("coverage")).where(covered >= COVERAGE)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    ``n_base`` counts the places of the base phrases, first_word and last_word are their smallest and largest
    start; ``labels`` adds those of verified spans; ``score`` is the best coverage of a template.
    """
    keys = ["_id", "_h1", "_h2"]
    # Rows are known by id and text, so repeated rows share one result.
    keyed = docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), "text").alias("_h2"), "text"
    )
    path = scratch_path(docs.sparkSession, "license-votes")
    diagonals(keyed, keys).write.parquet(path)  # a few rows for each hit document, read twice
    votes = docs.sparkSession.read.parquet(path)
    exact = F.col("base") & (F.size("positions") == F.col("need"))
    places = votes.where(exact).groupBy(*keys).agg(
        F.count("*").alias("n_base"), F.min("diagonal").alias("first_word"), F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base_labels"),
    )
    found = spans(votes, keys).groupBy(*keys).agg(F.collect_set("label").alias("labels"), F.max("coverage").alias("score"))
    result = found.join(places, [found[k].eqNullSafe(places[k]) for k in keys], "left").select(
        *[found[k].alias(f"{k}_") for k in keys], "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
    n_words = F.when(F.get("words", F.lit(0)) == "", 0).otherwise(F.size("words"))
    rows = with_words(keyed, keys).select(*keys, n_words.alias("n_words"))
    joined = rows.join(result, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], "left")
    none = F.array().cast("array<string>")
    base = F.coalesce("base_labels", none)
    return joined.select(
        F.col("_id").alias("doc_id"), F.col("n_words").cast("long"), F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("labels", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
