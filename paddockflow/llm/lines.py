"""Line dedup: repeated runs are found by winnowing over line hashes and their later copies deleted.

Texts are read as lines of ``min_words // 5`` words, one starting at every word, so that a passage is
found wherever line breaks stand in it.  The smallest line hash of every window of ``min_words``
words is its fingerprint (of equal ones the last); neighbouring windows mostly share it, so about
one word in twenty posts a place: the fingerprint and the stretch of windows that chose it.  Any
run of ``min_words`` words that occurs twice has the same fingerprint at the same word in both.

Places whose fingerprint occurs once are done.  The others are extended both ways: the outermost
windows of a stretch, up to 4/5 of a window to the left and to the right of the fingerprint, are
joined on their whole hashes with the first place in the corpus that has them.  Where both occur
earlier, so does all between.  Where only one or none does, the copy ends inside the stretch, or
the fingerprint alone is frequent.  Such stretches are parted in four by how far to the left their
windows begin; parts whose common words occur twice have each window joined.  So the result
is exact: a word is deleted if a window around it stands in an earlier document or ``min_words``
or more words earlier in its own.  n copies give n - 1 matches.

Documents are ordered by (id, text hash), null ids first.  A place is the number of its word in that
order, one long, so lists are reduced to their first place by hash aggregation before the shuffle.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch

_PLACE = [
    ("key", pa.int64()), ("low", pa.int32()), ("span", pa.int32()), ("back", pa.int32()),
    ("low_hash", pa.int64()), ("high_hash", pa.int64()),
]
_PLACES = "array<struct<key:bigint,low:int,span:int,back:int,low_hash:bigint,high_hash:bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_RUNS = "array<struct<start:int,end:int>>"
_BLOCK = 1 << 15
_TOGETHER = 1 << 17

_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


@functools.lru_cache(8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(factor)
    return values ^ (values >> np.uint64(32))


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a text, and where its words ``[^\\x20\\x09-\\x0D]+`` start and end."""
    data = np.frombuffer(raw, np.uint8)
    solid = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], solid, [False])).astype(np.int8)))
    return data, edges[::2], edges[1::2]


def _rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches of values: polynomials taken from running sums, so the same everywhere."""
    room = 1 << len(values).bit_length()
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(_BASE, room)[: len(values)], dtype=np.uint64)))
    return _mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, room)[starts] + (ends - starts).astype(np.uint64))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    parts = [np.empty(0, np.uint64)]
    for i in range(0, len(starts), _BLOCK):
        low, high = starts[i : i + _BLOCK], ends[i : i + _BLOCK]
        parts.append(_rolled(_BYTES[data[low[0] : high[-1]]], low - low[0], high - low[0]))
    return np.concatenate(parts)


def word_hashes(raw: bytes) -> np.ndarray:
    return _hashes(*word_bounds(raw))


def word_groups(texts: pa.Array):
    """(rows, hashes of their words, words of each) of neighbouring texts, a few hundred kilobytes or one long text together."""
    raw = texts.cast(pa.binary())
    sizes = pc.binary_length(raw).to_numpy().astype(np.int64)
    group = np.cumsum(sizes) // _TOGETHER
    for rows in np.split(np.arange(len(raw)), np.flatnonzero(np.diff(group)) + 1):
        if len(rows):
            data, starts, ends = word_bounds(b"\n".join(raw.slice(rows[0], len(rows)).to_pylist()))
            until = np.searchsorted(starts, np.cumsum(sizes[rows] + 1))
            yield rows, _hashes(data, starts, ends), np.diff(until, prepend=0)


def _size(min_words: int) -> int:
    return max(1, min_words // 5)


def winnow(
    words: np.ndarray, min_words: int, counts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, its word, first window, last window) of every stretch of windows that choose one line.

    ``counts``: the words of each text, if there are several; no window lies in two.
    """
    n = len(words) - min_words + 1
    if n < 1:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    starts = np.arange(len(words) - _size(min_words) + 1)
    least = lines = _rolled(words, starts, starts + _size(min_words))
    chosen, wide, width = starts, 1, min_words - _size(min_words) + 1
    while wide < width:  # windows of twice as many lines, or as many more as are left
        step = min(wide, width - wide)
        left = least[:-step] < least[step:]
        chosen = np.where(left, chosen[:-step], chosen[step:])
        least = np.where(left, least[:-step], least[step:])
        wide += step
    windows = starts[:n]
    if counts is not None:
        windows = windows[windows + min_words <= np.repeat(np.cumsum(counts), counts)[:n]]
        chosen = chosen[windows]
    first = np.flatnonzero(np.concatenate((np.ones(len(chosen[:1]), bool), chosen[1:] != chosen[:-1])))
    last = np.concatenate((first[1:], [len(chosen)]))[: len(first)] - 1
    return lines[chosen[first]].view(np.int64), chosen[first], windows[first], windows[last]


def quarters(words: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, min_words: int):
    """The windows ``low`` to ``high`` around each fingerprint, by how far to the left they begin.

    Gives (offsets of the parts, first window of each part, hash of the words that all windows of
    such a part share, hashes of the windows).
    """
    width = min_words - _size(min_words) + 1
    part_size = -(-width // 4)
    sizes = high - low + 1
    place = np.repeat(np.arange(len(low)), sizes)
    start = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[place]
    part = (at[place] - start) // part_size
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (part[1:] != part[:-1]))))
    place, part = place[new], part[new]
    shared = at[place] - part * part_size
    until = at[place] - np.minimum((part + 1) * part_size, width) + 1 + min_words
    return (
        np.concatenate((new, [len(start)])), start[new], _rolled(words, shared, until).view(np.int64),
        _rolled(words, start, start + min_words).view(np.int64),
    )


def cut(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the words of the runs.

    White space after a run goes with it if the run starts a line, else that before it; so lines
    that are left keep their breaks.
    """
    raw = text.encode("utf-8", "surrogatepass")
    _, starts, ends = word_bounds(raw)
    kept, at = [], 0
    for start, end in runs:
        before = int(ends[start - 1]) if start else 0
        if end < len(starts) and (not start or b"\n" in raw[before : starts[start]]):
            low, high = int(starts[start]), int(starts[end])
        else:
            low, high = before, int(ends[end - 1]) if end < len(starts) else len(raw)
        kept.append(raw[at : max(at, low)])
        at = max(at, high)
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def repeated_runs(docs: DataFrame, min_words: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, removed): runs of words (start, end; from 0) to delete, for every document that has any.

    ``doc`` is a struct of the id and a hash of the text; rows equal in both are one document.
    Of documents with one text only the first is searched, later ones go as a whole if they
    have a window.
    """
    spec = docs.filter(F.col(text).isNotNull()).select(
        F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("version")).alias("doc"), F.col(text).alias("text")
    )
    id_type = spec.schema["doc"].dataType["id"].dataType.simpleString()
    doc_type = f"doc struct<id:{id_type},version:bigint>"

    def posted(batches):
        for batch in batches:
            for rows, words, n_words in word_groups(batch.column("text")):
                keys, at, low, high = winnow(words, min_words, n_words)
                until = np.cumsum(n_words)
                doc = np.searchsorted(until, low, "right")
                ends = (_rolled(words, s, s + min_words).view(np.int64) for s in (low, high))
                found = (keys, low - (until - n_words)[doc], high - low, at - low, *ends)
                columns = [pa.array(values).cast(kind) for values, (_, kind) in zip(found, _PLACE)]
                places = pa.StructArray.from_arrays(columns, fields=[pa.field(*p) for p in _PLACE])
                offsets = pa.array(np.searchsorted(doc, np.arange(len(rows) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(rows[0], len(rows)), pa.array(n_words, pa.int32()), pa.ListArray.from_arrays(offsets, places)],
                    names=["doc", "n_words", "places"],
                )

    def numbered(batches):
        total = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes = batch.column("n_words").to_numpy().astype(np.int64)
            bases = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(bases)], names=["doc", "base"])

    written: list[DataFrame] = []
    posts = scratch.saved(spec.mapInArrow(posted, f"{doc_type}, n_words int, places {_PLACES}"), "line-places")
    sized = posts.filter(F.col("n_words") >= min_words).select("doc", "n_words")
    firsts = sized.groupBy(F.col("doc.version").alias("version")).agg(F.min("doc").alias("doc"), F.max("n_words").alias("n_words"))
    # the number of a document's first word; numbers rise with the order of the documents
    order = scratch.saved(
        firsts.select("doc", "n_words").orderBy("doc").mapInArrow(numbered, f"{doc_type}, base bigint"), "line-order"
    )
    copies = sized.join(_unique(order), "doc", "left_anti").distinct()

    places = posts.select("doc", "places").join(_unique(order), "doc").select("base", F.inline("places"))
    places = places.withColumn("at", F.col("base") + F.col("low")).drop("low")
    often = places.groupBy("key").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    often = scratch.saved(often.filter("first != last").select("key", "first"), "line-often")
    shared = scratch.saved(places.join(_unique(often), "key"), "line-shared")

    ends = shared.select("base", "at", "span", F.inline(F.array(
        F.struct(F.col("at").alias("place"), F.col("low_hash").alias("hash")),
        F.struct((F.col("at") + F.col("span")).alias("place"), F.col("high_hash").alias("hash")),
    )))
    ended = scratch.saved(_later(ends, min_words, written).distinct(), "line-ends")
    done = ended.groupBy("at").agg((F.max("place") - F.min("place") - F.max("span")).alias("open")).filter("open = 0").select("at")
    torn = shared.filter("at != first").select("key", "at").join(_unique(done), "at", "left_anti").select("key").distinct()
    stretch = F.struct((F.col("at") - F.col("base")).cast("int").alias("low"), "span", "back")
    wanted = scratch.saved(
        shared.select("key", "base", "at", "span", "back").join(_unique(torn), "key", "left_semi")
        .groupBy("base").agg(F.collect_list(stretch).alias("stretches")).join(_unique(order), "base"),
        "line-torn",
    )

    def opened(batches):
        for batch in batches:
            for rows, words, n_words in word_groups(batch.column("text")):
                bases, taken = batch.column("base").to_numpy()[rows], batch.column("stretches").slice(rows[0], len(rows))
                until = np.cumsum(n_words)
                low, span, back = (f.to_numpy().astype(np.int64) for f in taken.flatten().flatten())
                low += np.repeat(until - n_words, pc.list_value_length(taken).to_numpy())
                offsets, starts, anchors, hashes = quarters(words, low + back, low, low + span, min_words)
                doc = np.searchsorted(until, starts, "right")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bases[doc]), pa.array(starts + (bases - until + n_words)[doc]), pa.array(anchors),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes)),
                    ],
                    names=["base", "at", "anchor", "hashes"],
                )

    texts = spec.join(_unique(wanted), "doc").select("text", "base", "stretches")
    parts = scratch.saved(texts.mapInArrow(opened, "base bigint, at bigint, anchor bigint, hashes array<bigint>"), "line-parts")
    twice = parts.groupBy("anchor").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    twice = twice.filter("first != last").select("anchor")
    windows = parts.join(_unique(twice), "anchor", "left_semi").select("base", "at", F.posexplode("hashes").alias("i", "hash"))
    windows = scratch.saved(windows.select("base", (F.col("at") + F.col("i")).alias("place"), "hash"), "line-windows")
    starts = ended.select("base", "place").unionByName(_later(windows, min_words, written).select("base", "place"))

    def merged(batches):
        for batch in batches:
            lists = batch.column("starts")
            row, at = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()
            at = at[np.lexsort((at, row))]
            first = np.ones(len(at[:1]), bool)
            new = np.flatnonzero(np.concatenate((first, (row[1:] != row[:-1]) | (at[1:] > at[:-1] + min_words))))
            stops = at[np.concatenate((new[1:], [len(at)]))[: len(new)] - 1] + min_words
            ends = [pa.array(v, pa.int32()) for v in (at[new], stops)]
            runs = pa.StructArray.from_arrays(ends, fields=list(_RUN.value_type))
            offsets = pa.array(np.searchsorted(row[new], np.arange(len(lists) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("base"), pa.ListArray.from_arrays(offsets, runs)], names=["base", "removed"])

    runs = starts.groupBy("base").agg(F.collect_list((F.col("place") - F.col("base")).cast("int")).alias("starts"))
    runs = runs.mapInArrow(merged, f"base bigint, removed {_RUNS}").join(_unique(order), "base").select("doc", "removed")
    gone = copies.select("doc", F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end"))).alias("removed"))
    found = scratch.saved(runs.unionByName(gone), "line-runs")
    for frame in (posts, order, often, shared, ended, wanted, parts, windows, *written):
        scratch.remove_saved(frame)
    return found


def _unique(frame: DataFrame) -> DataFrame:
    """A side with one row a key, which grows with the corpus: the other side is shuffled but never sorted.

    Without an aggregate between its shuffle and the join, the other side's hot keys are split.
    """
    return frame.hint("shuffle_hash")


def _later(windows: DataFrame, min_words: int, written: list[DataFrame]) -> DataFrame:
    """The windows whose hash has its first place ``min_words`` or more words earlier; ``written`` gets what is left to delete."""
    first = windows.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = scratch.saved(first.filter(F.col("last") >= F.col("first") + min_words).select("hash", "first"), "line-firsts")
    written.append(first)
    return windows.join(_unique(first), "hash").filter(F.col("place") >= F.col("first") + min_words).drop("hash", "first")


def deduplicated(docs: DataFrame, min_words: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``row`` (all its columns as a struct), removed, n_removed, clean_text.

    ``removed`` holds the deleted runs of words (start, end), n_removed their words, clean_text
    the rest.  A null text stays null; empty texts and those of fewer words than ``min_words``
    stay as they are; very long texts are read whole; rows equal in id and text are one
    document and keep or lose the same; an empty table gives no rows.
    """
    key = F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("version"))
    found = repeated_runs(docs, min_words, id_column, text).withColumnRenamed("doc", "found")
    joined = docs.select(F.struct("*").alias("row"), key.alias("doc")).join(_unique(found), F.col("doc") == F.col("found"), "left")
    whole = F.col("row")[text]

    @F.arrow_udf("string")
    def without(texts: pa.Array, runs: pa.Array) -> pa.Array:
        left = (t and cut(t, [(r["start"], r["end"]) for r in taken]) for t, taken in zip(texts.to_pylist(), runs.to_pylist()))
        return pa.array(left, pa.string())

    # so declared, a filter on clean_text is not pushed below it, where it would cut once more in another Python worker
    without = without.asNondeterministic()

    return joined.select(
        "row",
        F.coalesce("removed", F.array().cast(_RUNS)).alias("removed"),
        F.coalesce(F.aggregate("removed", F.lit(0), lambda n, r: n + r["end"] - r["start"]), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), whole)
        .otherwise(without(F.when(F.col("removed").isNotNull(), whole), F.col("removed"))).alias("clean_text"),
    )


def without_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The documents without later repeated runs; same columns, ``n_chars`` follows the text.

    A document that had words and loses all of them is a repeat as a whole and goes.
    """
    done = deduplicated(docs, min_words).filter((F.col("n_removed") == 0) | F.col("clean_text").rlike("[^\\x20\\x09-\\x0D]"))
    replaced = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return done.select(*(replaced.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
