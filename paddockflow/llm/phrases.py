"""Benchmark decontamination by a positional inverted index of the training text.

1. Index.  Documents are dealt into segments of about a million words.  A segment stores, for
   every term that the test items hold, its postings: the positions at which it stands, sorted,
   one list after the other.  Documents of a segment lie behind each other with a gap, so that
   no phrase runs over from one into the next.  The segments are written to the shared folder.
2. Phrases.  Within a segment every phrase begins with its two rarest terms there: the list of
   the rarest is shifted by the distance of the two and intersected with the other's.  What is
   left meets the lists of the other terms in order of rarity.  Phrases that share a rare pair
   intersect it once.
3. Proximity.  The same lists answer which documents hold a set of terms within a stretch of so
   many words, in any order.

A segment holds all that a match needs, so postings are never shuffled, and a hot source or a
passage in a third of all documents is spread over all segments.  Test items are sent to the
tasks in parts of a bounded number of words; more parts mean more passes, never fewer items.

Null ids are ids of their own, a null or empty text has no words, a very long text is a segment
of its own, repeated rows are rows of their own, and empty tables give no matches.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch

SEGMENT_WORDS = 1 << 20
#: Words of test items sent to the tasks at once: a bound for what is broadcast.
PART_WORDS = 1 << 22
#: Positions that one step of an intersection expands at most.
_AT_ONCE = 1 << 22

# Fixed rule of the word pattern: digits, letters (A-Z lower-cased) and all beyond ASCII.
_WORD_BYTES = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases over a vocabulary, and the items that hold each.

    ``terms``: one row of term numbers a phrase, -1 behind its end.  ``item_at`` and ``items``:
    phrase p stands in ``items[item_at[p]:item_at[p + 1]]``, numbers into ``names``.
    """

    vocabulary: dict[bytes, int]
    terms: np.ndarray
    lengths: np.ndarray
    item_at: np.ndarray
    items: np.ndarray
    names: list[str]


def windows_of(words: Sequence, length: int) -> Iterator[tuple]:
    """All runs of ``length`` consecutive words; a shorter item, if not empty, is one run."""
    for low in range(max(1, len(words) - length + 1) if words else 0):
        yield tuple(words[low : low + length])


def phrases(items: Sequence[tuple[str, str | None]], length: int) -> Phrases:
    """The windows of (name, text) items; items of one name are one item."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({name for name, _ in items})
    number = {name: n for n, name in enumerate(names)}
    held: dict[tuple, set[int]] = {}
    for name, text in items:
        known = [vocabulary.setdefault(word, len(vocabulary)) for word in words_of(text)]
        for window in windows_of(known, length):
            held.setdefault(window, set()).add(number[name])
    terms = np.full((len(held), length), -1, np.int64)
    for row, window in enumerate(held):
        terms[row, : len(window)] = window
    counts = [len(found) for found in held.values()]
    return Phrases(
        vocabulary,
        terms,
        (terms >= 0).sum(axis=1),
        np.concatenate(([0], np.cumsum(counts, dtype=np.int64))),
        np.fromiter(itertools.chain.from_iterable(sorted(found) for found in held.values()), np.int64, sum(counts)),
        names,
    )


class Segment:
    """Postings of some documents; ``starts`` are their first positions, ``sizes`` their words."""

    def __init__(self, starts, sizes, terms, counts, positions):
        self.starts, self.sizes, self.terms = starts, sizes, terms
        self.counts, self.positions = counts.astype(np.int64), positions.astype(np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.counts)))
        self.span = int(starts[-1] + sizes[-1] + 1) if len(starts) else 1
        #: all postings as one sorted list of (term, position)
        self.keys = np.repeat(np.arange(len(terms)), counts) * self.span + self.positions

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """Where the lists of these terms are; -1 for a term without postings."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        slot = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[slot] == terms, slot, -1)

    def expand(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``slots``, position) for every posting of their lists."""
        sizes = self.counts[slots]
        which = np.repeat(np.arange(len(slots)), sizes)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return which, self.positions[self.at[slots][which] + inner]

    def stands(self, slots: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether the list of each slot has each position: the intersection step."""
        inside = (positions >= 0) & (positions < self.span)
        wanted = slots * self.span + positions
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return inside & (self.keys[at] == wanted)

    def find(self, query: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position) of every occurrence of every phrase."""
        slots = np.where(query.terms >= 0, self.slots(query.terms), -2)
        live = np.flatnonzero((slots != -1).all(axis=1) & (query.lengths > 0))
        if not len(live):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        slots = slots[live]
        rarity = np.where(slots >= 0, self.counts[np.maximum(slots, 0)], np.iinfo(np.int64).max)
        order = np.argsort(rarity, axis=1, kind="stable")
        slots = np.take_along_axis(slots, order, 1)
        second = 1 if slots.shape[1] > 1 else 0
        pair = np.stack([slots[:, 0], slots[:, second], order[:, second] - order[:, 0]], axis=1)
        pairs, member = np.unique(pair, axis=0, return_inverse=True)
        by_pair = np.argsort(member.ravel(), kind="stable")
        first = np.searchsorted(member.ravel()[by_pair], np.arange(len(pairs) + 1))
        found = [(np.zeros(0, np.int64),) * 2]
        edges = np.cumsum(self.counts[pairs[:, 0]]) // _AT_ONCE
        for some in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(edges)) + 1):
            which, position = self.expand(pairs[some, 0])
            which = some[which]
            other = pairs[which, 1]
            # a phrase of one word has no second list
            kept = np.where(other == -2, True, self.stands(np.maximum(other, 0), position + pairs[which, 2]))
            which, position = which[kept], position[kept]
            sizes = first[which + 1] - first[which]
            inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            row = by_pair[np.repeat(first[which], sizes) + inner]
            start = np.repeat(position, sizes) - order[row, 0]
            for step in range(2, slots.shape[1]):
                slot = slots[row, step]
                kept = np.where(slot == -2, True, self.stands(np.maximum(slot, 0), start + order[row, step]))
                row, start = row[kept], start[kept]
            found.append((live[row], start))
        return tuple(np.concatenate(part) for part in zip(*found))

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def near(self, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, first position) of every shortest stretch with all terms in ``within`` words.

        Begins with the rarest term and looks up the nearest posting of the others on both
        sides, so a stretch is given once for each place of the rarest term it is built around.
        """
        slots = self.slots(np.unique(terms))
        if (slots == -1).any() or not len(slots):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = sorted((self.positions[self.at[s] : self.at[s + 1]] for s in slots), key=len)
        documents, firsts = [], []
        for anchor in lists[0]:
            home = int(self.documents(anchor))
            low = max(int(self.starts[home]), int(anchor) - within + 1)
            high = min(int(self.starts[home] + self.sizes[home]), int(anchor) + within)
            around = [p[np.searchsorted(p, low) : np.searchsorted(p, high)] for p in lists[1:]]
            if any(len(p) == 0 for p in around):
                continue
            # the best stretch begins at the anchor or at a posting ahead of it
            begins = np.unique(np.concatenate([[anchor], *[p[p < anchor] for p in around]]))
            ends = np.full(len(begins), int(anchor))
            for p in around:
                at = np.searchsorted(p, begins)
                ends = np.maximum(ends, np.append(p, np.iinfo(np.int64).max)[at])
            best = int(np.argmin(ends - begins))
            if ends[best] - begins[best] < within:
                documents.append(home)
                firsts.append(int(begins[best]))
        return np.array(documents, np.int64), np.array(firsts, np.int64)


_STORED = {"starts": "<i8", "sizes": "<i8", "terms": "<i4", "counts": "<i4", "positions": "<u4"}


def _lists(values, sizes, kind: pa.DataType | None = None) -> pa.ListArray:
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    return pa.ListArray.from_arrays(offsets, values if kind is None else pa.array(values, kind))


def _stored(ids: pa.Array, keys: pa.Array, numbers: list[np.ndarray], gap: int) -> pa.RecordBatch:
    """The index row of documents given as term numbers, -1 for words that no item holds."""
    sizes = np.array([len(n) for n in numbers], np.int64)
    starts = np.cumsum(sizes + gap) - sizes - gap
    term = np.concatenate(numbers)
    position = np.arange(len(term)) + np.repeat(np.arange(len(sizes)) * gap, sizes)
    known = np.flatnonzero(term >= 0)
    known = known[np.argsort(term[known], kind="stable")]
    terms, counts = np.unique(term[known], return_counts=True)
    parts = {"starts": starts, "sizes": sizes, "terms": terms, "counts": counts, "positions": position[known]}
    packed = [pa.array([parts[name].astype(kind).tobytes()], pa.binary()) for name, kind in _STORED.items()]
    return pa.RecordBatch.from_arrays([_lists(ids, [len(ids)]), _lists(keys, [len(keys)]), *packed], names=["ids", "keys", *_STORED])


def build(
    docs: DataFrame, vocabulary: dict[bytes, int], gap: int, id_column: str = "doc_id", text: str = "text",
    segment_words: int = SEGMENT_WORDS, key: Column | None = None,
) -> DataFrame:
    """The written index: one row a segment, with its documents and the postings of ``vocabulary``.

    ``gap``: positions left free behind a document, no fewer than the longest phrase has words.
    ``key`` (LONG) tells rows apart; any number of its own for each row unless given.
    """
    own = F.monotonically_increasing_id() if key is None else key
    spec = docs.select(F.col(id_column).alias("id"), own.alias("key"), F.col(text).cast("string").alias("text"))
    id_type = spec.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column, low, held, numbers = batch.column("text"), 0, 0, []
            for i in range(len(column)):
                words = words_of(column[i].as_py())
                numbers.append(np.fromiter(map(vocabulary.get, words, itertools.repeat(-1)), np.int32, len(words)))
                held += len(words) + gap
                if held >= segment_words or i + 1 == len(column):
                    yield _stored(batch.column("id")[low : i + 1], batch.column("key")[low : i + 1], numbers, gap)
                    low, held, numbers = i + 1, 0, []

    columns = ", ".join(f"{name} binary" for name in _STORED)
    return scratch.saved(spec.mapInArrow(run, f"ids array<{id_type}>, keys array<long>, {columns}"), "postings")


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array, Segment]]:
    for i in range(batch.num_rows):
        parts = {n: np.frombuffer(batch.column(n)[i].as_buffer(), kind) for n, kind in _STORED.items()}
        yield batch.column("ids")[i].values, batch.column("keys")[i].values, Segment(**parts)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as disjoint ones, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return starts[fresh], reach[np.append(fresh[1:], len(starts)) - 1]


_MATCHES = "key long, n_words long, items array<string>, span_starts array<long>, span_ends array<long>"


def matches(index: DataFrame, query: Phrases) -> DataFrame:
    """One row a document: its id, its key, and what of ``query`` occurs in it.

    ``items``: names of items with an occurring phrase, sorted; ``span_starts`` and
    ``span_ends``: the words inside any occurrence, as disjoint stretches in words of the document.
    """
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    n_names = max(1, len(query.names))

    def run(batches):
        for batch in batches:
            for ids, keys, segment in _segments(batch):
                n = len(segment.starts)
                phrase, at = segment.find(query)
                sizes = query.item_at[phrase + 1] - query.item_at[phrase]
                inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                item = query.items[np.repeat(query.item_at[phrase], sizes) + inner]
                # names are numbered in order, so sorted numbers are sorted names
                pair = np.unique(np.repeat(segment.documents(at), sizes) * n_names + item)
                low, high = _merged(at, at + query.lengths[phrase])
                home = segment.documents(low)
                spans = np.bincount(home, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, keys, pa.array(segment.sizes, pa.int64()),
                        _lists([query.names[i] for i in pair % n_names], np.bincount(pair // n_names, minlength=n), pa.string()),
                        _lists(low - segment.starts[home], spans, pa.int64()),
                        _lists(high - segment.starts[home], spans, pa.int64()),
                    ],
                    names=["id", "key", "n_words", "items", "span_starts", "span_ends"],
                )

    return index.mapInArrow(run, f"id {id_type}, {_MATCHES}")


def near(index: DataFrame, vocabulary: dict[bytes, int], terms: Sequence[str], within: int) -> DataFrame:
    """(id, at): documents where all ``terms`` stand within so many words, in any order.

    One row for each place of the rarest term that such a stretch is found around; ``at`` is
    the stretch's first word.  A term that no document holds gives no rows.
    """
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    wanted = np.array([vocabulary.get(word, -1) for term in terms for word in words_of(term)], np.int64)

    def run(batches):
        for batch in batches:
            for ids, _, segment in _segments(batch):
                home, first = segment.near(wanted, within)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(home)), pa.array(first - segment.starts[home])], names=["id", "at"]
                )

    return index.mapInArrow(run, f"id {id_type}, at long")


def parts_of(items: DataFrame, id_column: str, text: str, part_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """(name, text) of all items, in parts of at most about ``part_words`` words.

    Items are streamed to the driver a partition at a time and dropped once a part is done.
    """
    part, held = [], 0
    named = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.col(text).cast("string"))
    for name, content in named.toLocalIterator():
        part.append((name, content))
        held += len(words_of(content))
        if held >= part_words:
            yield part
            part, held = [], 0
    yield part


def decontaminated(
    docs: DataFrame, items: DataFrame, words: int = 10, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", part_words: int = PART_WORDS,
    segment_words: int = SEGMENT_WORDS,
) -> DataFrame:
    """Every document with what of the test items it holds: id and the columns of ``matches``.

    Items that don't fit into one part take one pass over the documents each; what they find is
    then put together by row.
    """
    parts = parts_of(items, item_id, item_text, part_words)
    part, rest = next(parts), next(parts, None)
    query = phrases(part, words)
    if rest is None:
        return matches(build(docs, query.vocabulary, words, id_column, text, segment_words), query)
    # keys must be the same in every pass
    kept = scratch.saved(
        docs.select(
            F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("key"), F.col(text).alias("text")
        ),
        "keyed",
    )
    found = []
    for part in itertools.chain([part, rest], parts):
        query = phrases(part, words)
        index = build(kept, query.vocabulary, words, "id", "text", segment_words, F.col("key"))
        found.append(scratch.saved(matches(index, query), "matches"))
        scratch.remove_saved(index)
    scratch.remove_saved(kept)
    together = reduce(DataFrame.unionByName, found).groupBy("key").agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("span_starts")).alias("span_starts"),
        F.flatten(F.collect_list("span_ends")).alias("span_ends"),
    )

    def run(batches):
        for batch in batches:
            spans = [
                _merged(np.array(low, np.int64), np.array(high, np.int64))
                for low, high in zip(batch.column("span_starts").to_pylist(), batch.column("span_ends").to_pylist())
            ]
            for n, name in enumerate(("span_starts", "span_ends")):
                merged = pa.array([span[n] for span in spans], pa.list_(pa.int64()))
                batch = batch.set_column(batch.schema.get_field_index(name), name, merged)
            yield batch

    return together.mapInArrow(run, together.schema)
