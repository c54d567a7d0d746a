"""License texts in documents: phrases, and an exact containment join with license templates.

Words are the runs of ASCII letters (lower-cased), digits and characters beyond ASCII. A block is a window of words, twice as long as
the longest template, and one begins after every template's length; so what is as long as a template, or a word longer, lies whole in
some block, however its lines are wrapped and whatever signs stand between them. A block
meets a template if at least ``MIN_PERCENT`` percent of the template's distinct words are in it.

The join orders the templates' words by the number of blocks that hold them, over all documents. A block that meets
a template must hold one of its rarest words (its prefix), have enough words (length), and enough of the order left
behind the shared word on both sides (position). What passes is verified on the whole word sets, so no block is
missed. Only the templates' words take part; what is sent to the driver is their counts, bounded by the templates.

Defined cases: null text is an empty one; an empty text has no words and score 0; rows that repeat are rows of
their own; other columns are ignored. ``score`` is 1 where a phrase stands, else the best containment met, else 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_PERCENT = 80

# Phrases and their labels.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Short license notices in common use.
TEMPLATES = {
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-terms": "you may not use this file except in compliance with the license",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
}


def needed(size: int, percent: int) -> int:
    """The smallest number of shared words that is ``percent`` percent of ``size``."""
    return -(-size * percent // 100)


def longest(templates: dict[str, str]) -> int:
    """The words of the longest template, repeated ones too."""
    return max((len(text.split()) for text in templates.values()), default=1)


def _window_starts(words: Column, length: int) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - length - 1, F.lit(0)), F.lit(length))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BREAK, -1), "")


def _starts(words: Column, phrase: str) -> Column:
    """Positions at which the words of the phrase stand one after the other."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    at = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: _all(
        [F.get(words, i + k) == part for k, part in enumerate(parts)]))
    return F.when(F.col("lowered").contains(parts[-1]) & (last >= 0), at).otherwise(F.array().cast("array<int>"))


def _all(tests: list[Column]) -> Column:
    found = tests[0]
    for test in tests[1:]:
        found = found & test
    return found


def find_licenses(docs: DataFrame, templates: dict[str, str] | None = None, percent: int = MIN_PERCENT) -> DataFrame:
    """Per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    spark, templates = docs.sparkSession, TEMPLATES if templates is None else templates
    sets, length = {name: sorted(set(text.split())) for name, text in templates.items()}, longest(templates)
    vocabulary = sorted({w for words in sets.values() for w in words})
    known = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")

    lowered = docs.select("doc_id", F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).alias("lowered"))
    words = lowered.select("doc_id", "lowered", _words(F.col("lowered")).alias("words"))
    pages = stash(words.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.size("words").cast("long").alias("n_words"),
        *[_starts(F.col("words"), phrase).alias(label) for label, phrase in PHRASES.items()],
        F.filter(F.transform(_window_starts(F.col("words"), length), lambda i: F.array_intersect(F.slice("words", i + 1, 2 * length), known)),
                 lambda block: F.size(block) > 0).alias("blocks")), "license-blocks")

    blocks = pages.select("row_id", F.explode("blocks").alias("block"))
    counts = dict(blocks.select(F.explode("block").alias("word")).groupBy("word").count().collect())  # one row for each template word
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index = []  # the prefix of each template: its rarest words
    for name, own in sets.items():
        ranked = sorted(own, key=order.get)
        enough = needed(len(ranked), percent)
        index += [(word, order[word], name, position, len(ranked), enough, ranked)
                  for position, word in enumerate(ranked[:len(ranked) - enough + 1])]
    prefixes = spark.createDataFrame(index, "word string, place int, template string, position int, size int, enough int, template_words array<string>")
    rank = F.create_map(*[F.lit(x) for w, i in order.items() for x in (w, i)]) if order else None

    found = None
    if index:
        rare = F.array(*map(F.lit, sorted({row[0] for row in index})))
        candidates = (blocks.where(F.size("block") >= min(row[5] for row in index))
                      .select("row_id", "block", F.explode(F.array_intersect("block", rare)).alias("word"))
                      .join(F.broadcast(prefixes), "word")  # as many rows as the templates have prefix words
                      .where(F.size("block") >= F.col("enough")))
        behind = F.size(F.filter("block", lambda w: F.element_at(rank, w) >= F.col("place")))
        passed = candidates.where(F.least(behind, F.col("size") - F.col("position")) >= F.col("enough"))
        shared = F.size(F.array_intersect("block", "template_words"))
        met = passed.select("row_id", "template", "size", shared.alias("shared"), "enough").where("shared >= enough")
        found = met.groupBy("row_id").agg(F.collect_set("template").alias("templates"),
                                          F.max(F.col("shared") / F.col("size")).alias("best"))
    base = F.concat(*PHRASES)
    out = pages.drop("blocks") if found is None else pages.drop("blocks").join(found, "row_id", "left")
    if found is None:
        out = out.withColumns({"templates": F.lit(None).cast("array<string>"), "best": F.lit(None).cast("double")})
    own = F.filter(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in PHRASES]), lambda x: x.isNotNull())
    return out.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base).cast("long").alias("first_word"), F.array_max(base).cast("long").alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.coalesce("templates", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
