"""Line-first quality rules, in built-in column functions only.

Every line of a text is judged by itself: a line is *decoration* when symbols or shouting
marks make up much of it, *navigation* when separators do, and *boilerplate* when it is
short and holds a stock phrase.  Failed lines are removed; a document is rejected when it
loses too much of its text that way, when it has too few words, or when it repeats itself.

Everything is computed inside the row, so there is no shuffle and a hot source costs no
more than any other.  The repeat count hashes word windows first and compares the words
themselves only in documents where two windows share a hash, so it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = "[\\x20\\x09-\\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"

SYMBOLS = "#*$%&|<>"
DECORATION = "#*$%&<>!~^=_"
SEPARATORS = "|>»›•·"
# Stock phrases of page furniture, compared in lower case.
PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use cookies", "accept cookies", "enable javascript", "javascript is disabled", "click here",
    "sign up for", "subscribe to our", "share this", "follow us on", "back to top",
)


_ODD = "[" + "".join("\\" + c for c in sorted({*SYMBOLS, *DECORATION, *SEPARATORS})) + "]"


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _solid(text: Column) -> Column:
    """Characters that are not white space."""
    return F.length(F.translate(text, _SPACES, ""))


def _boilerplate(line: Column, most_chars: int) -> Column:
    return (F.length(line) <= most_chars) & F.lower(line).rlike("|".join(PHRASES))


def failed_line(
    line: Column, decoration_pct: int = 10, separator_pct: int = 5, boilerplate_chars: int = 120
) -> Column:
    """True for a line that fails a rule; a line without a word never fails."""
    solid = _solid(line)
    dense = (solid > 0) & (
        (_count(line, DECORATION) * 100 > solid * decoration_pct)
        | (_count(line, SEPARATORS) * 100 > solid * separator_pct)
    )
    return (line.rlike(_ODD) & dense) | _boilerplate(line, boilerplate_chars)


_PLACE_BITS = 24


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_places(order: Column, same) -> Column:
    """Entries of a sorted array that have a neighbour which is the same."""
    return F.filter(
        order,
        lambda x, k: ((k > 0) & same(F.get(order, k - 1), x)) | same(F.get(order, k + 1), x).eqNullSafe(True),
    )


def _repeats(words: Column, hashes: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word counted once."""
    mask = (1 << _PLACE_BITS) - 1
    place = lambda x: x.bitwiseAND(F.lit(mask)).cast("int")
    head = lambda x: F.shiftright(x, _PLACE_BITS)
    window = lambda i: F.concat_ws(" ", words[i], words[i + 1], words[i + 2])

    # sort numbers that hold a part of the hash and the place; equal parts become neighbours
    keys = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))
    by_hash = _let(keys, lambda a: _repeated_places(a, lambda x, y: head(x) == head(y)))
    # the same from the words themselves, for documents where different windows share a part
    texts = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(window(i).alias("w"), i.alias("i")))
    )
    by_words = F.transform(
        _let(texts, lambda a: _repeated_places(a, lambda x, y: x["w"] == y["w"])), lambda x: x["i"]
    )
    places = _let(
        by_hash,
        lambda found: F.when(
            (F.size(hashes) <= mask)
            & ~F.exists(
                F.sequence(F.lit(0), F.size(found)),
                lambda k: ((head(F.get(found, k)) == head(F.get(found, k + 1)))
                           & (window(place(F.get(found, k))) != window(place(F.get(found, k + 1)))))
                .eqNullSafe(True),
            ),
            F.transform(found, place),
        ).otherwise(by_words),
    )
    # union of the stretches [place, place + 3)
    covered = F.aggregate(
        F.sort_array(places),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )
    several = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(several, covered).otherwise(0).cast("long")


def measured(docs: DataFrame, text: str = "text", min_words: int = 50, max_repeat_pct: int = 50,
             max_lost_pct: int = 30) -> DataFrame:
    """One row per document: ``row`` (all columns of ``docs`` as a struct) and its measures.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_chars (characters of
    failed lines, white space aside), clean_text (the lines that passed; null for a null text),
    base_failed (too few words, or too many repeated) and kept (base rules met and little text
    lost with failed lines).  A null text measures like an empty one.
    """
    step = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("whole"))
    bare = F.trim(F.col("whole"), F.lit(_SPACES))
    step = step.withColumn("odd", F.col("whole").rlike(_ODD)).withColumn(
        "words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPACE))
    ).withColumn("lines", F.split("whole", "\n"))
    words, lines = F.col("words"), F.col("lines")
    starts = F.when(F.size(words) > 3, F.sequence(F.lit(0), F.size(words) - 3))
    step = step.withColumn(
        "hashes",
        F.transform(
            F.coalesce(starts, F.array().cast("array<int>")),
            lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]),
        ),
    ).withColumn(
        "failed",
        F.when(F.col("odd"), F.transform(lines, lambda line: failed_line(line)))
        .otherwise(F.transform(lines, lambda line: _boilerplate(line, 120))),
    ).withColumn("worded", F.filter(lines, lambda line: line.rlike("[^\\x20\\x09-\\x0D]")))
    failed = F.col("failed")
    bad = F.exists(failed, lambda f: f)
    # generated, so that no later filter is pushed below and computes the measures once more
    step = step.select("row", F.inline(F.array(F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.when(F.col("odd"), _count(F.col("whole"), SYMBOLS)).otherwise(0).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        _repeats(words, F.col("hashes")).alias("n_repeat_words"),
        F.when(bad, _solid(F.array_join(F.filter(lines, lambda line, i: F.get(failed, i)), "")))
        .otherwise(0).cast("long").alias("n_failed_chars"),
        F.when(F.col("row")[text].isNotNull(), F.when(~bad, F.col("whole")).otherwise(
            F.array_join(F.filter(lines, lambda line, i: ~F.get(failed, i)), "\n"))).alias("clean_text"),
    ))))
    step = step.withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct),
    )
    return step.withColumn(
        "kept", ~F.col("base_failed") & (F.col("n_failed_chars") * 100 <= F.col("word_chars") * max_lost_pct)
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """Documents that are kept, with their failed lines removed; same columns as ``docs``.

    ``n_chars`` follows the text where the table has it.  Null, empty and short texts are
    rejected; equal rows get equal verdicts; an empty table gives an empty table.
    """
    replaced = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return measured(docs).filter("kept").select(
        *(replaced.get(c, F.col("row")[c]).alias(c) for c in docs.columns)
    )
