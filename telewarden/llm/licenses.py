"""License scans by diagonal voting, in DataFrame functions alone.

Every pair of neighbouring words of a text is hashed, and all these hashes are joined to the
positions of the same pairs in license templates. A hit votes for the offset between text and
template, its diagonal. Votes of a diagonal are a bit for each template position; a diagonal with all
bits is a place where the phrase stands word for word. Diagonals of a template that lie at most
``GAP`` apart are merged, so that inserted or missing words don't split a passage, and a merged span
counts if its bits cover ``COVER`` of the template.

Null text is empty text: no words, no label, score 0. Rows are told apart by doc_id (null is a value)
and the hash of the text; rows that repeat both get the same result, one row each. Texts are scanned
whole. An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed: what separates words after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed: the base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Passages that the method adds, at most 64 words each.
PASSAGES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("creative commons attribution", "cc-by"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]
#: Fixed: the letters that are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP = 3
COVER = 0.8
#: The template that stands for the text itself and carries its word count.
TEXT = -1


def positions(spark: SparkSession) -> DataFrame:
    """A row for each word pair of each template; of constant size."""
    rows = [(TEXT, "", False, 0, 0, 0, "", "")]
    for template, (phrase, label) in enumerate([*BASE, *PASSAGES]):
        words = phrase.split()
        for place, (one, two) in enumerate(zip(words, words[1:])):
            rows.append((template, label, template < len(BASE), len(words) - 1, place, 1 << place, one, two))
    schema = "template int, label string, base boolean, pairs int, place int, bit long, one string, two string"
    made = spark.createDataFrame(rows, schema)
    return made.withColumn("h", F.when(F.col("template") == TEXT, F.lit(0).cast("long")).otherwise(F.xxhash64("one", "two")))


def scan(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each text: key, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(whole).alias("of"),
        F.array_remove(F.split(F.translate(whole, UPPER, UPPER.lower()), SEPARATORS), "").alias("words"),
    )
    places = positions(spark)
    known = [r.h for r in places.select("h").distinct().collect()]  # as many as the templates have word pairs

    def pair(w, i):
        after = F.get("words", i + 1)
        return F.struct(i.alias("at"), F.xxhash64(w, after).alias("h"), w.alias("first_word"), after.alias("second_word"))

    # What leaves a text is its pairs that some template has, with their words, and one row that stands for the text.
    pairs = F.filter(F.transform("words", pair), lambda p: p["h"].isin(known) & (p["at"] < F.size("words") - 1))
    none = F.lit(None).cast("string")
    text_row = F.struct(
        F.size("words").alias("at"), F.lit(0).cast("long").alias("h"), none.alias("first_word"), none.alias("second_word")
    )
    hits = rows.select("id", "of", F.inline(F.concat(pairs, F.array(text_row)))).join(F.broadcast(places), "h")
    same = (F.col("first_word") == F.col("one")) & (F.col("second_word") == F.col("two"))
    hits = hits.filter((F.col("template") == TEXT) & F.col("first_word").isNull() | same).select(
        "id", "of", "template", "label", "base", "pairs",
        F.when(F.col("template") == TEXT, 0).otherwise(F.col("at") - F.col("place")).alias("diagonal"),
        "bit",
        F.when(F.col("template") == TEXT, F.col("at")).cast("long").alias("n"),
    )
    votes = hits.groupBy("id", "of", "template", "label", "base", "pairs", "diagonal").agg(
        F.bit_or("bit").alias("bits"), F.max("n").alias("n"), F.count("*").alias("rows")
    )
    by = Window.partitionBy("id", "of", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > GAP).cast("int"), F.lit(1))
    spans = votes.withColumn("new", new).withColumn("span", F.sum("new").over(by))
    merged = spans.groupBy("id", "of", "template", "label", "base", "pairs", "span").agg(
        F.bit_or("bits").alias("bits"),
        F.sum((F.bit_count("bits") == F.col("pairs")).cast("long")).alias("places"),
        F.min(F.when(F.bit_count("bits") == F.col("pairs"), F.col("diagonal"))).alias("first"),
        F.max(F.when(F.bit_count("bits") == F.col("pairs"), F.col("diagonal"))).alias("last"),
        F.max("n").alias("n"),
        F.max("rows").alias("rows"),
    )
    text_row, base = F.col("template") == TEXT, F.col("base")
    cover = F.when(~text_row, F.bit_count("bits") / F.col("pairs"))
    good = F.when(base, F.col("places") > 0).otherwise(cover >= COVER) & ~text_row
    place = base & (F.col("places") > 0)

    def names(which):
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(which, F.col("label")))))

    out = merged.groupBy("id", "of").agg(
        F.max("n").alias("n_words"),
        F.coalesce(F.sum(F.when(base, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(place, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(place, F.col("last"))).cast("long").alias("last_word"),
        names(place).alias("base_labels"),
        names(good).alias("labels"),
        F.coalesce(F.max(F.when(base, F.when(place, 1.0).otherwise(0.0)).otherwise(cover)), F.lit(0.0)).alias("score"),
        F.max(F.when(text_row, F.col("rows"))).alias("rows"),
    )
    again = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return again.select(
        F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )
