"""Licence scan by diagonal voting.

Each position of a text gives the hash of its next 2 and of its next 4 words. A join
with the template positions that hold such a hash yields votes; all votes of one
occurrence lie on one diagonal, text position minus template position. Votes are
added up by diagonal, diagonals a few words apart are merged, as words were put in
or left out between them, and a merged span counts if it covers enough of the
template. Short phrases must stand word for word.

Only built-in functions: the words are exploded and probed inside one stage, and
what is shuffled are the votes and one row per document.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.llm.common import broadcast_if_small, narrow, native_words


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


#: The phrases and labels that the scan is defined by.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
#: Opening words of public licence notices.
NOTICES = (
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("mit-release", "released under the mit license"),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    Template(
        "bsd-text",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "gpl-text",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
    ),
    Template("apache-text", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("mpl-text", "this source code form is subject to the terms of the mozilla public license"),
    Template("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
)
#: Diagonals at most so many words apart belong to one occurrence.
NEAR = 3
#: A notice counts if so much of its k-grams voted.
COVERED = 0.6


def _seeds(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per template position: ``gram`` (hash), ``t`` (template) and ``at``."""
    rows = []
    for t, template in enumerate(templates):
        words = template.text.split()
        k = 2 if template.base else 4
        rows += [(t, at, k, words[at : at + k], len(words), words, template.label, template.base) for at in range(len(words) - k + 1)]
    shape = "t int, at int, k int, gram array<string>, length int, words array<string>, label string, base boolean"
    table = spark.createDataFrame(rows, shape)
    gram = F.when(F.col("k") == 2, F.xxhash64(F.lit(2), *[F.get("gram", F.lit(i)) for i in range(2)])).otherwise(
        F.xxhash64(F.lit(4), *[F.get("gram", F.lit(i)) for i in range(4)])
    )
    ends = spark.createDataFrame([(-1, 0, 0, None, 0, None, None, False)], shape).withColumn("gram", F.lit(0).cast("long"))
    return table.withColumn("gram", gram).union(ends)


def scan(
    docs: DataFrame,
    templates: Sequence[Template] = PHRASES + NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base`` (places of base
    phrases), ``first_word`` and ``last_word`` (their smallest and largest start, else
    null), ``base_labels``, ``labels``, ``score`` and ``spans``.

    ``score`` is the largest share of a template's k-grams that voted in one span, 1 for
    a base phrase and 0 without votes. ``spans`` lists label, start and end of each
    span that counts. Null and empty texts have no words and no labels. Null ids are
    kept. Rows alike in id and text give one row each, all the same. Notices shorter
    than 4 words are not found. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    base = narrow(docs, doc_id=id_col, text=text_col)
    w = F.col("words")
    split = base.select("doc_id", F.xxhash64("text").alias("h"), native_words(F.col("text")).alias("words"))
    # Position -1 stands for the row itself, so that a text without votes stays.
    at = split.select("doc_id", "h", "words", F.explode(F.sequence(F.lit(-1), F.size("words") - 1)).alias("i"))
    i = F.col("i")
    two = F.when(i < 0, F.lit(0)).when(i + 2 <= F.size(w), F.xxhash64(F.lit(2), F.get(w, i), F.get(w, i + 1)))
    four = F.when((i >= 0) & (i + 4 <= F.size(w)), F.xxhash64(F.lit(4), *[F.get(w, i + j) for j in range(4)]))
    seeds = _seeds(spark, templates)
    votes = (
        at.select("doc_id", "h", "words", "i", F.explode(F.array(two, four)).alias("gram"))
        .where("gram is not null")
        .join(broadcast_if_small(seeds.withColumnRenamed("words", "template")), "gram")
    )
    diagonal = i - F.col("at")
    same = F.slice(w, F.greatest(diagonal + 1, F.lit(1)), F.col("length")) == F.col("template")
    kept = votes.where((F.col("t") < 0) | ~F.col("base") | ((diagonal >= 0) & same)).select(
        "doc_id",
        "h",
        "t",
        "at",
        "k",
        "length",
        "label",
        "base",
        F.when(F.col("t") >= 0, diagonal).alias("diagonal"),
        F.when(F.col("t") < 0, F.size(w)).alias("n_words"),
    )
    by_diagonal = kept.groupBy("doc_id", "h", "t", "diagonal", "k", "length", "label", "base").agg(
        F.collect_set("at").alias("ats"), F.count("*").alias("rows"), F.max("n_words").alias("n_words")
    )
    # Merging looks at one document's votes for one template at a time.
    line = Window.partitionBy("doc_id", "h", "t").orderBy("diagonal")
    jump = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(line) > NEAR)
    clustered = by_diagonal.withColumn("cluster", F.sum(F.coalesce(jump, F.lit(True)).cast("int")).over(line))
    spans = clustered.groupBy("doc_id", "h", "t", "cluster", "k", "length", "label", "base").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("covered"),
        F.min(F.col("diagonal") + F.array_min("ats")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("ats") + F.col("k")).alias("end"),
        F.max("rows").alias("rows"),
        F.max("n_words").alias("n_words"),
    )
    share = F.when(F.col("t") >= 0, F.col("covered") / (F.col("length") - F.col("k") + 1))
    good = (F.col("t") >= 0) & (F.col("base") | (share >= COVERED))
    is_base = (F.col("t") >= 0) & F.col("base")
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    whole = spans.groupBy("doc_id", "h").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        labels(is_base).alias("base_labels"),
        labels(good).alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(good, F.struct("start", "end", "label")))).alias("spans"),
        F.max(F.when(F.col("t") < 0, F.col("rows"))).alias("rows"),
    )
    return whole.select("*", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).drop("h", "rows", "col")
