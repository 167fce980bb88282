"""Licence notices in texts, by diagonal voting over word pairs; DataFrame functions only.

Every run of two words of a text is hashed and joined to the places that run has in the templates.
Such a hit votes for its diagonal, the text's place less the template's: all words of one copy of a
template vote for the same diagonal, and a word put in or left out moves the rest by one. Votes are
summed per diagonal, a diagonal takes in those up to ``drift`` beside it, and a span holds if the hits,
each compared word by word, cover the template but for the runs that one edit in every ten words breaks.

Base phrases are templates that must stand whole on a single diagonal, which then is where they start.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import literal_frame

#: Words left unedited for each one that may be edited, put in or left out.
EDIT_EVERY = 10
#: Words by which the rest of a copy may have moved.
DRIFT = 3

# Phrases whose places are counted, and the label each gives.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# Wordings of public licence notices, and the label each gives.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files, to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and or sell copies of the software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc0", "Licensed under CC0 1.0"),
    ("proprietary", "All rights reserved"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOCUMENT = ["doc_id", "text_hash"]


def words_of(text: Column) -> Column:
    """Words of a text, A to Z in lower case; none for null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN_WORDS), "")


def templates(spark: SparkSession, phrases: list[tuple[str, str]] = PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """A row for each run of two words of a template: ``template``, ``label``, ``base``, ``runs`` (how many there are),
    ``needed``, ``place`` and the two words. Rows come from the caller's texts, so their size is known; texts of one word or none are left out."""
    rows = [(i, label, i < len(phrases), text) for i, (label, text) in enumerate([*phrases, *notices])]
    known = literal_frame(spark, rows, [("template", "int"), ("label", "string"), ("base", "boolean"), ("text", "string")])
    runs = F.size("words") - 1
    allowed = F.when(F.col("base"), 0).otherwise(2 * F.floor(F.size("words") / EDIT_EVERY)).cast("int")
    return known.withColumn("words", words_of(F.col("text"))).where(F.size("words") > 1).select(
        "template", "label", "base", runs.alias("runs"), (runs - allowed).alias("needed"), "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - 2)).alias("place"),
    ).select("template", "label", "base", "runs", "needed", "place", F.get("words", F.col("place")).alias("first"),
             F.get("words", F.col("place") + 1).alias("second"))


def votes(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Hits by text, template and diagonal, and a row without a template for each text.

    A text is a ``doc_id`` with a hash of the text, so rows of one id with different texts stay apart. ``places`` are the
    template's places that were hit; ``copies``, in the row without a template, is how often the row is repeated.
    """
    text = F.col("text").cast("string")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("words"))
    # The pair at 0 has no first word: it is the one row that each text keeps, with or without words. Pairs are exploded, not
    # places in the array of words, as every exploded row would carry a copy of that. The outer form, though no array is
    # empty, keeps the planner from splitting each text a second time to filter on its size.
    pairs = F.arrays_zip(F.concat(F.array(F.lit(None).cast("string")), "words").alias("word"), F.col("words").alias("second"))
    placed = read.select(*_DOCUMENT, F.size("words").cast("long").alias("n_words"), pairs.alias("pairs")) \
        .select(*_DOCUMENT, "n_words", F.posexplode_outer("pairs").alias("at", "pair")).select(*_DOCUMENT, "n_words", "at", "pair.word", "pair.second")
    run = F.when(F.col("word").isNotNull() & F.col("second").isNotNull(), F.xxhash64("word", "second"))
    grams = known.select(F.xxhash64("first", "second").alias("run"), "template", "place", F.col("first").alias("known_word"), F.col("second").alias("known_second"))
    met = placed.withColumn("run", run).join(F.broadcast(grams), "run", "left")
    same = (F.col("word") == F.col("known_word")) & (F.col("second") == F.col("known_second"))
    hit = F.col("template").isNotNull() & same
    return met.where(hit | (F.col("at") == 0)).select(
        *_DOCUMENT, "n_words", F.when(hit, F.col("template")).alias("template"),
        F.when(hit, (F.col("at") - 1 - F.col("place")).cast("long")).alias("diagonal"), F.when(hit, F.col("place")).alias("place"),
    ).groupBy(*_DOCUMENT, "template", "diagonal").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("template").isNull()).alias("copies"), F.collect_set("place").alias("places"))


def license_spans(voted: DataFrame, known: DataFrame) -> DataFrame:
    """``votes`` with ``label``, ``base``, ``covered`` (runs of the template found), ``share`` (of all its runs) and ``held``.

    A phrase holds where all its runs stand on one diagonal. For notices, diagonals up to the drift away count together, and of those
    within the drift of each other the one that covers most stays (ties: the earliest). The template's first word stands at
    ``diagonal`` in the text, or up to the drift beside it. Rows that do not hold show the share of what was found.
    """
    facts = known.select("template", "label", "base", "runs", "needed").distinct()
    beside = Window.partitionBy(*_DOCUMENT, "template").orderBy("diagonal").rangeBetween(-DRIFT, DRIFT)
    wide = voted.join(F.broadcast(facts), "template", "left").withColumn("near", F.collect_list("places").over(beside))
    covered = F.when(F.col("base"), F.size("places")).otherwise(F.size(F.array_distinct(F.flatten("near"))))
    rank = F.struct(F.col("covered"), (-F.col("diagonal")).alias("early"))
    ranked = wide.withColumn("covered", covered).drop("near", "places").withColumn("rank", rank).withColumn("best", F.max("rank").over(beside))
    chosen = ranked.where(F.col("base") | F.col("template").isNull() | (F.col("rank") == F.col("best")))
    return chosen.withColumn("share", F.col("covered").cast("double") / F.col("runs")).withColumn("held", F.col("covered") >= F.col("needed")).drop("rank", "best")


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Places of the base phrases and the labels of each text of ``doc_id`` and ``text``.

    Returns ``doc_id``, ``n_words``, ``n_base`` (places of all phrases), ``first_word`` and ``last_word`` (smallest and largest start
    of a place, words from 0), ``base_labels`` and ``labels`` (those of notices too; distinct, sorted, comma-joined, empty if none),
    ``score`` (largest share of a template's word pairs in one span; 0 without any).

    A null text counts as empty: no words, no places, empty labels, score 0. Each input row gives one row, repeated rows and
    null ids included; rows that share a ``doc_id`` are judged by their own texts. Other columns are ignored. An
    empty table gives an empty result.
    """
    known = templates(docs.sparkSession) if known is None else known
    spans = license_spans(votes(docs, known), known)
    place = F.when(F.col("base") & F.col("held"), F.col("diagonal"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    held = F.when(F.col("held"), F.col("label"))
    return spans.select(*_DOCUMENT, "n_words", "copies", place.alias("place"), F.when(F.col("base"), held).alias("base_label"), held.alias("label"), "share") \
        .groupBy(*_DOCUMENT).agg(
            F.max("n_words").alias("n_words"), F.max("copies").alias("copies"), F.count("place").alias("n_base"),
            F.min("place").alias("first_word"), F.max("place").alias("last_word"), joined("base_label").alias("base_labels"), joined("label").alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        ).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies", "text_hash")
