"""SimHash near-duplicates through an inverted index on fingerprint bytes.

A fingerprint has eight bytes, each with a position.  Two fingerprints that differ in at
most ``max_bits`` bits differ in at most that many bytes, so they share at least
``8 - max_bits`` positional bytes: the guaranteed minimum of the count filter.  A list for
a single positional byte would hold 1/256 of the corpus and its pairs would grow with the
square of the input, so lists are kept for sets of positional bytes instead:

1. Wide lists (four bytes for two bits).  Every pair within the radius meets in at least
   one of them; fingerprints alone in all of theirs leave here, which is nearly all.
2. Tally lists (all sets of exactly the guaranteed minimum of bytes).  A pair meets in one
   of these if and only if its tally reaches the minimum, so meeting there is the count
   filter.  Members of a list differ only in the bytes left out, which bounds a list at
   2 ** (8 * max_bits) fingerprints however many documents there are.
3. Each list is verified bit by bit and gives a spanning forest of its true links, at most
   one row a member: no list emits its pairs.

Equal fingerprints are one node throughout, so a group of copies costs one row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch
from paddockflow.llm import components

_SEED = 42
_SHINGLES_AT_ONCE = 1 << 16
_SIGNED = 1 << 64


def shingle_hashes(text: str | None, words: int = 3) -> np.ndarray:
    """XXH64 of every shingle of a whole text, repeats included: lower-cased A-Z, white-space words.

    A text of fewer words is one shingle; one without words has none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    width = min(words, len(parts))
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(parts) - width + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], _SEED) for a, b in spans), "<u8", len(starts))


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half the hashes; none give zero."""
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), _SHINGLES_AT_ONCE):
        some = np.ascontiguousarray(hashes[low : low + _SHINGLES_AT_ONCE], "<u8")
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of a whole text: lower-cased A-Z, white-space words, word shingles."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(id, fp LONG) for every row; a null or empty text has fingerprint zero."""
    spec = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    id_type = spec.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            found = np.fromiter(
                (fingerprint(column[i].as_py(), words) for i in range(len(column))), "<u8", len(column)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found.view("<i8"))], names=["id", "fp"]
            )

    return spec.mapInArrow(run, f"id {id_type}, fp long")


def _masks(kept_bytes) -> int:
    mask = sum(0xFF << (8 * b) for b in kept_bytes)
    return mask - _SIGNED if mask >= _SIGNED >> 1 else mask


def wide_masks(max_bits: int) -> list[int]:
    """Four groups of two bytes; at least ``4 - max_bits`` groups of a pair are equal."""
    groups = [(0, 1), (2, 3), (4, 5), (6, 7)]
    return [_masks(itertools.chain(*some)) for some in itertools.combinations(groups, 4 - max_bits)]


def tally_masks(max_bits: int) -> list[int]:
    """Every set of as many bytes as a pair within the radius is sure to share."""
    return [_masks(some) for some in itertools.combinations(range(8), 8 - max_bits)]


def _lists(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.array(*(F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
                     for i, m in enumerate(masks)))
    return fps.select("fp", F.inline(keys))


def spanning_links(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint of one tally list, the smallest one that it reaches by verified links.

    Members differ in at most ``max_bits`` bytes, so neighbours are looked up by flipping
    bits of those bytes: work and memory in proportion to the list.
    """
    values = np.unique(values)
    varying = int(np.bitwise_or.reduce(values ^ values[0]))
    bits = [np.uint64(1 << b) for b in range(64) if varying >> b & 1]
    flips = [
        np.bitwise_or.reduce(some)
        for size in range(1, max_bits + 1)
        for some in itertools.combinations(bits, size)
    ]
    root = np.arange(len(values))
    near = []
    for flip in flips:
        other = values ^ flip
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        hit = np.flatnonzero(values[at] == other)
        if len(hit):
            near.append((hit, at[hit]))
    changed = True
    while changed:
        before = root
        root = root.copy()
        for here, there in near:
            np.minimum.at(root, here, root[there])
        root = root[root]
        changed = bool((root != before).any())
    return np.stack([values, values[root]], axis=1)


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) links whose closure joins exactly the fingerprints within ``max_bits`` bits.

    ``fps``: column fp LONG, distinct.  ``max_bits``: 1 or 2.
    """
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    wide = _lists(fps, wide_masks(max_bits))
    shared = (
        wide.groupBy("list", "bytes").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
        .filter("low < high").select("list", "bytes")
    )
    met = wide.join(shared, ["list", "bytes"], "left_semi").select("fp").distinct()
    tally = (
        _lists(met, tally_masks(max_bits)).groupBy("list", "bytes")
        .agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1").select("fps")
    )

    def verify(batches):
        for batch in batches:
            found = [np.empty((0, 2), np.uint64)]
            for row in batch.column("fps"):
                got = spanning_links(row.values.to_numpy().astype("<i8").view("<u8"), max_bits)
                found.append(got[got[:, 0] != got[:, 1]])
            pairs = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return tally.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per document: its id, fingerprint (16 hex digits) and component_id.

    ``component_id`` is the smallest id that can be reached over links, the own id included.
    Rows that repeat an id or have a null id get the component of their fingerprint; ids that
    are null are passed over in the minimum.  An empty table gives no rows.
    """
    prints = scratch.saved(fingerprints(docs, id_column, text, words), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    found = components.labels(links(classes.select("fp"), max_bits))
    linked = found.join(classes, found.node == classes.fp).select("node", "label", "least")
    least = linked.groupBy("label").agg(F.min("least").alias("reached"))
    moved = linked.join(least, "label").select(F.col("node").alias("fp"), "reached")
    # stored, so that the join with it has a shuffle of its own and a hot fingerprint can be split
    full = scratch.saved(
        classes.join(moved, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component_id")),
        "simhash-classes",
    )
    return prints.join(full, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents without near-duplicates: of each component the one with the smallest id.

    All columns stay.  Of rows that repeat that id one stays; rows whose component has no id
    at all (only null ids) stay as they are, since nothing tells them apart.
    """
    parts = near_duplicates(docs, "doc_id", "text", words, max_bits)
    ids = parts.filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    nameless = docs.filter("doc_id is null")
    kept = docs.join(ids, docs.doc_id == ids.kept_id, "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(nameless)
