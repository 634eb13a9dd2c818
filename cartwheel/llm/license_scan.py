"""License notices in texts, by diagonal voting of word k-grams.

Every run of ``GRAM`` words of every text is hashed and joined with the same runs of the templates, each of
which knows its place there. A match votes for the diagonal ``place in text - place in template``, that is for
the word at which the template would begin. Votes are added up by template and diagonal; each diagonal is merged
with its neighbours, as inserted or left out words tear a notice apart; and a span counts when it
is verified. The templates are fixed text, so their table is broadcast.

* A phrase is verified when one diagonal holds all its k-grams, word by word: it stands there as it is.
* A notice, a longer text, is verified when at least ``NOTICE_SHARE`` of its k-grams are found on a diagonal and those
  within ``DRIFT`` words of it. So a notice with changed words counts as well. Of verified diagonals within
  ``DRIFT`` words the heaviest (of equals the first) stays and is where the span begins; a stray vote moves nothing.

The score is the largest share of a template's k-grams that a text holds, 1 for a whole phrase.

Words are runs of digits, a-z and all characters beyond ASCII, after A-Z are lower-cased; matches compare
the words themselves, so a hash that agrees by chance changes nothing. Null text counts as empty and has no word; each row
is scanned by itself, repeated rows and null ids included. Built of DataFrame functions only. ``docs`` must
read the same rows in the same partitions each time, as a table does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.exact_dedup import LOWER, UPPER
from cartwheel.llm.tables import table

GRAM = 3
NOTICE_SHARE = 0.6
DRIFT = 8  # words inserted or left out within a notice
SPAN = ("template", "diagonal", "whole", "label", "places", "votes", "found", "first_at", "last_at")

# Phrases and the labels that they prove.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The first sentences of public license notices, and labels of the method's own.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation": "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that"
    " the following conditions are met": "bsd",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
    " with the license": "apache-2-notice",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "all rights reserved": "all-rights-reserved",
}

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def text_words(text: Column) -> Column:
    """The words of a text, of which a leading and a trailing one may be empty strings."""
    return F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BETWEEN)


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """A row for each place in a template: its words, which template, the place and the number of places.

    Another row, of no words, lets one row of each document through the join.
    """
    rows = [("", "", "", -1, -1, 0, "", False)]
    texts = [(text, label, True) for text, label in phrases.items()] + [(t, label, False) for t, label in notices.items()]
    for number, (text, label, whole) in enumerate(texts):
        words = text.split()
        places = len(words) - GRAM + 1
        if places < 1:
            raise ValueError(f"a template has fewer than {GRAM} words: {text}")
        rows += [(*words[place : place + GRAM], number, place, places, label, whole) for place in range(places)]
    names = ("w0", "w1", "w2", "template", "place", "places", "label", "whole")
    fixed = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*fixed)))


def spans(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES
) -> DataFrame:
    """A row for each verified span (row, doc_id, n_words and ``SPAN``), and one of each document whose span columns are null."""
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id}`").alias("doc_id"), text_words(F.col(f"`{text}`")).alias("words")
    )
    lead = F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size("words") > 1) & (F.get("words", F.size("words") - 1) == ""), 1).otherwise(0)
    rows = rows.withColumn("lead", lead).withColumn("n_words", F.size("words") - F.col("lead") - tail)
    # place -1 stands for the document itself
    last = F.greatest(F.col("n_words") - GRAM, F.lit(-1))
    places = rows.select("row", "doc_id", "n_words", "lead", "words", F.explode(F.sequence(F.lit(-1), last)).alias("at"))
    grams = places.select(
        "row",
        "doc_id",
        "n_words",
        "at",
        *[F.when(F.col("at") < 0, "").otherwise(F.get("words", F.col("at") + F.col("lead") + k)).alias(f"w{k}") for k in range(GRAM)],
    )
    words = [f"w{k}" for k in range(GRAM)]
    hashed = F.xxhash64(*words).alias("gram")
    known = templates(spark, phrases, notices).select(
        hashed, *[F.col(w).alias(f"t{w}") for w in words], "template", "place", "places", "label", "whole"
    )
    same = [F.col(w) == F.col(f"t{w}") for w in words]
    votes = grams.withColumn("gram", hashed).join(F.broadcast(known), "gram").where(same[0] & same[1] & same[2])
    return _verified(votes)


def _verified(votes: DataFrame) -> DataFrame:
    """Votes to spans: by diagonal, then the diagonals beside each one of a notice."""
    diagonals = votes.groupBy("row", "template", "whole", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("label").alias("label"),
        F.first("places").alias("places"),
        F.count(F.lit(1)).alias("votes"),  # each place of a template votes once for a diagonal
        F.collect_set("place").alias("found"),  # at most the places of one template
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
    )
    # at most 2 * DRIFT + 1 diagonals are in a frame, however many a text has
    beside = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    alone = F.col("whole")
    merged = diagonals.select(
        *("row", "doc_id", "n_words", "template", "diagonal", "whole", "label", "places", "votes"),
        F.when(alone, F.col("found")).otherwise(F.array_distinct(F.flatten(F.collect_list("found").over(beside)))).alias("found"),
        F.when(alone, F.col("first_at")).otherwise(F.min("first_at").over(beside)).alias("first_at"),
        F.when(alone, F.col("last_at")).otherwise(F.max("last_at").over(beside)).alias("last_at"),
    )
    needed = F.when(alone, F.col("places")).otherwise(F.ceil(F.col("places") * NOTICE_SHARE))
    verified = (F.col("template") >= 0) & (F.size("found") >= needed)
    weight = F.struct(F.col("votes"), -F.col("diagonal"))
    heaviest = F.max(F.when(F.col("verified"), weight)).over(beside)
    kept = merged.withColumn("verified", verified).withColumn("heaviest", heaviest)
    document = F.col("template") < 0
    return kept.where(document | (F.col("verified") & (alone | (F.col("heaviest") == weight)))).select(
        "row", "doc_id", "n_words", *[F.when(~document, F.col(name)).alias(name) for name in SPAN]
    )


def scan(
    docs: DataFrame, *, text: str = "text", id: str = "doc_id", phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES
) -> DataFrame:
    """(row, doc_id, n_words) of each document with the array of its verified spans, in order of template and place."""
    span = F.when(F.col("template").isNotNull(), F.struct(*SPAN))
    return (
        spans(docs, text=text, id=id, phrases=phrases, notices=notices)
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.sort_array(F.collect_list(span)).alias("spans"))
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; of its spans only counts, places and labels are kept, so many spans cost no more than their votes."""
    found = spans(table(spark, sf_dir, "documents"))
    start = F.when(F.col("whole"), F.col("diagonal").cast("bigint"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")  # at most the labels of all templates

    per_document = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").cast("bigint").alias("n_words"),
        F.count(start).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        joined(F.when(F.col("whole"), F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.coalesce(F.max(F.size("found") / F.col("places")), F.lit(0.0)).alias("score"),
    )
    return per_document.drop("row")
