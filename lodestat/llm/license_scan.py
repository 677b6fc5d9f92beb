"""License scan by diagonal voting.

All rolling word k-grams of a text are hashed and joined to the positions of the same k-grams in license templates.
A match of text position p with template position t votes for the diagonal p - t. Neighbouring diagonals of a template
(a few words put in or left out) are merged, and a merged span counts when enough of the template's words are covered.
The join compares the words behind a hash, so no span rests on a hash collision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestat.llm.batches import Words, letter_digit_words, lowered, slabs, text_bytes

K = 2
GAP = 3  # neighbouring diagonals: so many words more or less
COVER = 0.8  # share of a template's words

# Phrases that must stand word by word.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wording of public licenses and of the usual notices.
NOTICES = (
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
)


def templates(phrases=PHRASES, notices=NOTICES) -> list[dict]:
    """Each template with its words; phrases need all words and no merged diagonals."""
    out = []
    for exact, listed in ((True, phrases), (False, notices)):
        for text, label in listed:
            words = _words(pa.array([text])).texts(np.array([0]), _words(pa.array([text])).count[0])[0].split(" ")
            if len(words) < K:
                raise ValueError(f"a template has at least {K} words: {text}")
            out.append({"template": len(out), "label": label, "exact": exact, "words": words})
    return out


def _words(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    return Words(lowered(data), offsets, letter_digit_words())


def _grams_in(known: np.ndarray):
    """Task function: all rolling k-grams are hashed; those whose hash no template has can join nothing and stay here."""

    def run(batches):
        for slab in slabs(batches, "text"):
            words = _words(slab.column("text"))
            first, hashes = words.grams(K)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            first, hashes = first[hit], hashes[hit]
            per_text = np.bincount(words.doc[first], minlength=words.docs)
            offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
            grams = pa.StructArray.from_arrays(
                [pa.array(words.position()[first], pa.int64()), pa.array(hashes.view(np.int64)), pa.array(words.texts(first, K), pa.string())],
                names=["pos", "hash", "gram"],
            )
            yield pa.RecordBatch.from_arrays(
                [slab.column("id"), slab.column("key"), pa.array(words.count), pa.ListArray.from_arrays(pa.array(offsets), grams)],
                names=["id", "key", "n_words", "grams"],
            )

    return run


def spans(docs: DataFrame, doc: str = "doc_id", text: str = "text", listed: list[dict] | None = None) -> DataFrame:
    """Spans (id, key, n_words, template, label, exact, start, covered, share) of license wording.

    A text without any span has one row with null ``template``. ``key`` tells texts with the same id apart; rows that
    repeat id and text are one. Null and empty texts have no words. ``start`` is the number of the span's first word.
    """
    spark, listed = docs.sparkSession, templates() if listed is None else listed
    rows = []
    for t in listed:
        words = _words(pa.array([" ".join(t["words"])]))
        first, hashes = words.grams(K)
        rows += [(h, g, t["template"], t["label"], t["exact"], len(t["words"]), int(p)) for p, h, g in zip(first, hashes.view(np.int64).tolist(), words.texts(first, K))]
    # one row for each template word: its size is that of the list, whatever the corpus
    places = spark.createDataFrame(rows, "hash bigint, gram string, template int, label string, exact boolean, length int, tpos int")
    known = np.unique(np.array([r[0] for r in rows], np.int64).view(np.uint64))
    kind = docs.schema[doc].dataType.simpleString()
    found = (
        docs.select(F.col(doc).alias("id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text"))
        .mapInArrow(_grams_in(known), f"id {kind}, key bigint, n_words bigint, grams array<struct<pos:bigint,hash:bigint,gram:string>>")
        .select("id", "key", "n_words", F.explode_outer("grams").alias("g"))
        .select("id", "key", "n_words", "g.*")
    )
    votes = found.join(F.broadcast(places) if len(rows) <= 100_000 else places, ["hash", "gram"], "left")
    cell = ["id", "key", "n_words", "template", "label", "exact", "length"]
    diagonals = (
        votes.repartition("id", "key")
        .groupBy(*cell, (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(F.collect_set("tpos").alias("tset"))
    )
    order = W.partitionBy("id", "key", "n_words", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    bands = diagonals.withColumn("new", (step.isNull() | (step > F.when(F.col("exact"), 0).otherwise(GAP))).cast("int"))
    bands = bands.withColumn("band", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    covered = F.size(F.array_distinct(F.flatten(F.transform("tall", lambda t: F.sequence(t, t + (K - 1))))))
    merged = (
        bands.groupBy(*cell, "band")
        .agg(F.array_distinct(F.flatten(F.collect_list("tset"))).alias("tall"), F.min(F.col("diagonal") + F.array_min("tset")).alias("start"))
        .withColumn("covered", F.when(F.col("template").isNotNull(), covered).otherwise(0))
        .withColumn("share", F.when(F.col("template").isNotNull(), F.col("covered") / F.col("length")).otherwise(F.lit(0.0)))
    )
    good = F.when(F.col("exact"), F.col("share") == 1.0).otherwise(F.col("share") >= COVER)
    some = F.max(F.coalesce(good, F.lit(False))).over(W.partitionBy("id", "key", "n_words"))
    rank = F.row_number().over(W.partitionBy("id", "key", "n_words").orderBy("template", "band"))
    none = lambda c: F.when(F.col("hit"), F.col(c)).alias(c)
    return (
        merged.withColumn("hit", F.coalesce(good, F.lit(False)))
        .withColumn("some", some)
        .withColumn("rank", rank)
        .filter(F.col("hit") | (~F.col("some") & (F.col("rank") == 1)))
        .select("id", "key", "n_words", none("template"), none("label"), none("exact"), none("start"), none("covered"), none("share"))
    )


def scan(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, places of the exact phrases, labels of phrases and of all spans, best share.

    Columns: id, n_words, n_base, first_word, last_word, base_labels, labels, score. Null or empty text: no words, no
    labels, score 0. Rows that repeat id and text give one row; equal ids with different texts give one row each.
    """
    base = F.coalesce(F.col("exact"), F.lit(False))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return (
        spans(docs, doc, text)
        .groupBy("id", "key", "n_words")
        .agg(
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("start"))).alias("first_word"),
            F.max(F.when(base, F.col("start"))).alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"),
            joined("label").alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .drop("key")
        .withColumnRenamed("id", doc)
    )
