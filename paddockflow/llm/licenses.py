"""License scan: base phrases, and an exact set-similarity join of text blocks with templates.

A block is a run of lines: each line with its follower for templates of up to ``SHORT`` distinct
words, each line with its five followers for longer ones, so a notice that is wrapped or stands
in a source comment lies in a block as a whole.  A block matches a template if it holds at least
``threshold`` of the template's distinct words (containment).  Texts are read once: what a text
holds of the template vocabulary as a whole tells whether any of its blocks can match, and only
those texts are cut into blocks.  Tokens are ordered by their frequency in all these blocks,
rarest first, and the join uses that order:

* length filter: a block with fewer template words than the least overlap cannot match;
* prefix filter: of a template's ``n`` words at most ``n - least`` may be missing, so its
  ``n - least + 1`` rarest words hold at least one of the block's;
* positional filter: a block that first meets a template at its k-th rarest word has missed
  k already, which must leave enough words.

What passes is verified by counting the overlap, so the join is exact.  Only words that occur
in templates take part (others cannot change an overlap), so frequencies, prefixes and the
template side of the join are bounded by the template table.  Built-in functions only.

Null texts have no words; empty and very long ones need no care, since every step works on one
line or on one array of a text's words; rows are matched by a number of their own, so null and
repeated ids keep what is theirs; repeated rows stay, and an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch

#: Distinct words of a template that is looked for in runs of two lines, and lines of the runs for longer ones.
SHORT, SHORT_LINES, LONG_LINES = 10, 2, 6

#: Phrases whose consecutive words give a base label.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Templates of license notices: label and wording.
TEMPLATES = (
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("all-rights-reserved", "all rights reserved"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the "
            "following disclaimer"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied "
            "warranties are disclaimed"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def _spaced(text: Column) -> Column:
    """Lower-cased words with one space between; other characters gone."""
    return F.trim(F.regexp_replace(_lowered(text), _BREAKS, " "))


def _places(words: Column, phrase: str) -> Column:
    """Places where the words of a phrase stand in a row."""
    wanted = phrase.split()

    def here(i):
        found = words[i] == wanted[0]
        for k, word in enumerate(wanted[1:], 1):
            found &= F.get(words, i + k) == word
        return found

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, words in template_words(templates) for w in words})


def _least(words: list[str], threshold: float) -> int:
    return math.ceil(threshold * len(words) - 1e-9)


def based(docs: DataFrame, text: str = "text", phrases=PHRASES, templates=TEMPLATES, threshold: float = 0.9) -> DataFrame:
    """``row`` (all columns as a struct), n_words, places, base_names and candidate.

    ``places``: sorted starts of all base phrases; ``base_names``: their labels; ``candidate``: the
    text if it holds enough words of some template as a whole, else null.  A null text has no words.
    """
    step = docs.select(
        F.struct("*").alias("row"), _spaced(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("spaced")
    )
    padded = F.concat(F.lit(" "), F.col("spaced"), F.lit(" "))
    holds = {p: padded.contains(f" {p} ") for p, _ in phrases}
    none = F.array().cast("array<int>")
    vocabulary = F.array(*map(F.lit, _vocabulary(templates)))
    step = step.select(
        "row",
        F.when(F.col("spaced") == "", 0)
        .otherwise(F.length("spaced") - F.length(F.replace("spaced", F.lit(" "), F.lit(""))) + 1)
        .cast("long").alias("n_words"),
        *(holds[p].alias(f"holds_{i}") for i, (p, _) in enumerate(phrases)),
        # words only where a phrase was seen
        F.when(F.greatest(*(h.cast("int") for h in holds.values())) == 1, F.split("spaced", " ")).alias("words"),
        F.array_intersect(F.split("spaced", " "), vocabulary).alias("held"),
    )
    found = [F.when(F.col(f"holds_{i}"), _places(F.col("words"), p)).otherwise(none) for i, (p, _) in enumerate(phrases)]
    names = [F.when(F.col(f"holds_{i}"), F.lit(label)) for i, (_, label) in enumerate(phrases)]
    known = template_words(templates)
    wanted = F.array(*(
        F.struct(F.array(*map(F.lit, words)).alias("words"), F.lit(_least(words, threshold)).alias("least"))
        for _, words in known
    ))
    fewest = min(_least(words, threshold) for _, words in known)
    can = F.exists(wanted, lambda t: F.size(F.array_intersect(t["words"], F.col("held"))) >= t["least"])
    return step.select(
        "row",
        F.inline(F.array(F.struct(
            "n_words",
            F.sort_array(F.concat(*found)).alias("places"),
            F.array_compact(F.array(*names)).alias("base_names"),
            F.when(F.size("held") >= fewest, F.when(can, F.col("row")[text].cast("string"))).alias("candidate"),
        ))),
    )


def template_words(templates) -> list[tuple[str, list[str]]]:
    return [(label, sorted(set(re.findall("[0-9a-z]+", wording)))) for label, wording in templates]


def blocks(texts: DataFrame, key: str, text: str, templates=TEMPLATES) -> DataFrame:
    """(key, block, long, tokens): distinct template words of every run of lines, by its first line.

    ``long`` tells the runs for longer templates from those for shorter ones.
    """
    vocabulary = F.array(*map(F.lit, _vocabulary(templates)))
    lines = F.transform(
        F.split(F.col(text), "\n"), lambda line: F.array_intersect(F.split(_spaced(line), " "), vocabulary)
    )

    def runs(size: int, long: bool) -> Column:
        return F.transform(
            F.col("lines"),
            lambda _, i: F.struct(
                i.alias("block"), F.lit(long).alias("long"),
                F.array_distinct(F.flatten(F.slice(F.col("lines"), i + 1, F.lit(size)))).alias("tokens"),
            ),
        )

    cut = texts.where(F.col(text).isNotNull()).select(F.col(key), lines.alias("lines"))
    return cut.select(key, F.inline(F.concat(runs(SHORT_LINES, False), runs(LONG_LINES, True))))


def matches(
    texts: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = 0.9
) -> DataFrame:
    """(key, block, label, containment) of every run of lines and template that meet the threshold.

    ``block`` is the first line of the run, counted from 0.  A run that meets several wordings of
    one label gives a row for each.  Rows that share a key are not told apart.
    """
    spark = texts.sparkSession
    known = template_words(templates)
    least = [_least(words, threshold) for _, words in known]
    long = [len(words) > SHORT for _, words in known]
    enough = {kind: min([n for n, is_long in zip(least, long) if is_long == kind], default=1 << 30) for kind in (False, True)}
    found = scratch.saved(
        blocks(texts, key, text, templates)
        .where(F.size("tokens") >= F.when(F.col("long"), enough[True]).otherwise(enough[False])),  # length filter
        "license-blocks",
    )
    counted = found.select(F.explode("tokens").alias("token")).groupBy("token").count()
    often = {r[0]: r[1] for r in counted.collect()}  # at most one row for each template word
    order = {w: i for i, w in enumerate(sorted({w for _, ws in known for w in ws}, key=lambda w: (often.get(w, 0), w)))}
    prefixes = []
    for number, (label, words) in enumerate(known):
        ordered = sorted(words, key=order.__getitem__)
        prefixes += [
            (word, long[number], number, label, place, least[number], ordered)
            for place, word in enumerate(ordered[: len(ordered) - least[number] + 1])
        ]
    side = spark.createDataFrame(
        prefixes, "token string, long boolean, template int, label string, place int, least int, words array<string>"
    )
    rare = sorted({p[0] for p in prefixes})
    probed = found.select(
        key, "block", "long", "tokens",
        F.explode(F.array_intersect("tokens", F.array(*map(F.lit, rare)))).alias("token"),
    )
    # bounded by the template table: a row for each prefix word
    met = probed.join(F.broadcast(side), ["token", "long"]).filter(
        (F.size("tokens") >= F.col("least"))
        # the prefix word is the rarest they share, and enough of the template is left after it
        & (F.size(F.array_intersect(F.slice("words", F.lit(1), F.col("place")), "tokens")) == 0)
        & (F.size("words") - F.col("place") >= F.col("least"))
    )
    overlap = F.size(F.array_intersect("tokens", "words"))
    return met.filter(overlap >= F.col("least")).select(
        key, "block", "label", (overlap / F.size("words")).alias("containment")
    )


def scanned(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES,
    threshold: float = 0.9,
) -> DataFrame:
    """One row per document with its base phrases and template matches.

    Columns: the id, n_words, n_base, first_word, last_word, base_labels, labels (base and
    template labels, sorted) and score (1 with a base phrase, else the greatest containment of
    a match, else 0).
    """
    read = based(docs.select(id_column, text), text, phrases, templates, threshold)
    base = scratch.saved(
        read.select(
            F.monotonically_increasing_id().alias("key"), F.col("row")[id_column].alias("id"),
            "n_words", "places", "base_names", "candidate",
        ),
        "license-scan",
    )
    added = (
        matches(base.where("candidate is not null"), "key", "candidate", templates, threshold).groupBy("key")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("most"))
    )
    joined = base.drop("candidate").join(added, "key", "left")
    places, names = F.col("places"), F.col("base_names")
    every = F.array_union(names, F.coalesce("more", F.array().cast("array<string>")))
    return joined.select(
        F.col("id").alias(id_column),
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )
