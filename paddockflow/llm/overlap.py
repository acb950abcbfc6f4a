"""Near copies by the exact Jaccard similarity of their sets of word shingles.

Candidates come from the inverted index on fingerprint bytes of ``simhash``, over two fingerprints.

1. The 64-bit SimHash of the shingles, in the wide and tally lists of ``simhash``: its verified links
   within ``BITS`` bits.  Texts that share four fifths of their shingles lie 3 to 11 bits apart, and two
   bits is the radius that eight bytes can guarantee, so a longer fingerprint goes beside it.
2. A fingerprint of ``PARTS`` positional bytes, each a byte of the minimum of one random
   order of the shingles: two texts agree in a byte with just the probability of their similarity, or by
   chance (1/256).  A list for one byte would hold 1/256 of the corpus and more, so there is one for
   each of ``BANDS`` sets of ``ROWS`` parts, keyed by the whole minima.  Texts of similarity ``s`` meet in at least one
   with probability ``1 - (1 - s ** ROWS) ** BANDS``: 0.99997 at 0.8.
3. Count filter: a pair that met is tallied, and goes on with ``least_shared`` equal bytes or more.
   A pair at 0.8 shares 64 of 80 on average, and fewer than the 46 asked for once in 100,000 times.
4. Every pair left is verified by its exact similarity, and components of verified pairs are formed.

A list does not emit all its pairs at once.  Members are compared with the list's first text, and once
those links have formed components, with every member of another component.  Pairs of one component
are not compared, since a link between them changes nothing; no other pair of a list is left out.

In a list of more than ``MOST`` members of several components nearly all pairs are unlike, and they would grow with the square of
the list.  Such members meet by prefixes instead, which is exact: shingles are put in one order, the rarest among
these texts first, and two texts that share ``o`` shingles share one of the first ``size - o + 1`` of each.  How many must be
shared follows from both sizes, so a text has a prefix for each class of sizes of its partner.  What only one
text holds comes first and meets nothing: copies that were each changed in places of their own meet
if they are alike, and hardly otherwise.

Equal texts are one node throughout, so a group of copies costs one row.
"""

from __future__ import annotations

from itertools import accumulate, repeat
from math import ceil, floor, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch
from paddockflow.llm import components, simhash

BITS = 2
BANDS, ROWS = 20, 4
PARTS = BANDS * ROWS
MOST = 48
#: First size of each class: single sizes, from 32 on steps of a 32nd.
_SIZES = np.array(list(accumulate(repeat(0, 900), lambda size, _: size + max(1, size // 32), initial=1)), np.int64)
_SEED = 42
_ORDERS = np.random.default_rng(_SEED).integers(1, 1 << 63, PARTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = np.random.default_rng(_SEED + 1).integers(-(1 << 63), 1 << 63, 4, dtype=np.int64).tolist()
_AT_ONCE = 1 << 11


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles: lower-cased A-Z, white-space words.

    A text of fewer words is one shingle; one without words has none.
    """
    return np.unique(simhash.shingle_hashes(text, words))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of shingles; two empty ones are equal."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 1.0


def minima(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each of the ``PARTS`` orders of a text's shingles."""
    parts = np.full(PARTS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), _AT_ONCE):
        np.minimum(parts, (_ORDERS[:, None] * hashes[low : low + _AT_ONCE]).min(axis=1), out=parts)
    return parts


def bands(parts: np.ndarray) -> list[int]:
    """Keys of the lists that a text stands in."""
    raw = parts.astype("<u8").tobytes()
    step = 8 * ROWS
    return [xxhash.xxh64_intdigest(raw[step * i : step * (i + 1)], i) - (1 << 63) for i in range(BANDS)]


def long_print(parts: np.ndarray) -> bytes:
    """The positional bytes of a text, from the middle of its minima: the top bytes are zero in long texts."""
    return (parts >> np.uint64(24)).astype(np.uint8).tobytes()


def least_shared(least: float) -> int:
    """Equal bytes that a pair must have: five standard deviations below the average at ``least``."""
    return max(0, floor(PARTS * least - 5 * sqrt(PARTS * least * (1 - least))))


def prefixes(size: int, least: float) -> list[tuple[int, int, int]]:
    """(own class, partner's class, shingles) for every class of sizes that a partner of a text of ``size`` can have.

    Of two texts alike by ``least``, each has one of the shared shingles among that many first ones of its own.
    """
    own, low, high = np.searchsorted(_SIZES, [size, ceil(size * least - 1e-9), floor(size / least + 1e-9)], "right") - 1
    found = []
    for other in range(int(max(low, 0)), int(high) + 1):
        shared = ceil((size + max(int(_SIZES[other]), ceil(size * least - 1e-9))) * least / (1 + least) - 1e-9)
        if shared <= size:
            found.append((int(own), other, size - shared + 1))
    return found


def _version(text: str):
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _prints(docs: DataFrame, text: str, words: int) -> DataFrame:
    """(version, fp, bytes, keys) of every different text: SimHash, positional bytes, lists."""
    spec = docs.select(_version(text).alias("version"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            found = []
            for i in range(len(column)):
                hashes = simhash.shingle_hashes(column[i].as_py(), words)
                parts = minima(np.unique(hashes))
                found.append((np.uint64(simhash.majority(hashes)).astype(np.int64), long_print(parts), bands(parts)))
            fp, raw, keys = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("version"), pa.array(fp, pa.int64()), pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["version", "fp", "bytes", "keys"],
            )

    # stored, like the lists and their firsts, so that each join has shuffles of its own and a hot list can be split
    return scratch.saved(
        spec.mapInArrow(run, "version long, fp long, bytes binary, keys array<long>").dropDuplicates(["version"]), "overlap-prints"
    )


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _bit_pairs(prints: DataFrame) -> DataFrame:
    """(a, b): texts linked by their SimHashes; those of one SimHash by the smallest of them."""
    classes = prints.groupBy("fp").agg(F.min("version").alias("one"))
    same = prints.join(classes, "fp").filter("version <> one").select(*_ordered("version", "one"))
    near = simhash.links(classes.select("fp"), BITS)
    far = near.join(classes.toDF("a", "x"), "a").join(classes.toDF("b", "y"), "b").select(*_ordered("x", "y"))
    return same.unionByName(far)


def _first_pairs(lists: DataFrame) -> DataFrame:
    """(a, b): each member of a list with the list's first text; what is first differs by four orders."""
    salt = F.element_at(F.array(*map(F.lit, _SALTS)), F.col("band") % len(_SALTS) + 1)
    first = scratch.saved(
        lists.withColumn("turned", F.col("version").bitwiseXOR(salt)).groupBy("band", "key")
        .agg(F.min("turned").alias("turned"), F.count("*").alias("n")).filter("n > 1")
        .select("band", "key", F.col("turned").bitwiseXOR(salt).alias("first")),
        "overlap-first",
    )
    return lists.join(first, ["band", "key"]).filter("version <> first").select(*_ordered("version", "first"))


def _mixed_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(band, key, version, label, n): the members of lists of several components, and how many a list has."""
    placed = lists.join(labels, lists.version == labels.node, "left").select(
        "band", "key", "version", F.coalesce("label", "version").alias("label")
    )
    mixed = placed.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    return scratch.saved(placed.join(mixed.filter("low < high").select("band", "key", "n"), ["band", "key"]), "overlap-members")


def _met(members: DataFrame, **keys: str) -> DataFrame:
    """(a, b): members of different components that meet; by each key and the other's column that must equal it."""
    other = members.select(
        *(F.col(theirs).alias(own) for own, theirs in keys.items()), F.col("version").alias("other"), F.col("label").alias("other_label")
    )
    return members.join(other, list(keys)).filter("label < other_label").select(*_ordered("version", "other"))


def _prefix_members(docs: DataFrame, wanted: DataFrame, text: str, words: int, least: float) -> DataFrame:
    """(version, label, own, partner, shingle): the prefixes of the wanted (version, label), without shingles of one text alone."""
    spec = docs.select(_version(text).alias("version"), F.col(text).cast("string").alias("text"))
    spec = spec.join(wanted, "version").dropDuplicates(["version"])

    def hashed(batches):
        for batch in batches:
            column = batch.column("text")
            found = [shingles(column[i].as_py(), words).view(np.int64) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("version"), batch.column("label"), pa.array(found, pa.list_(pa.int64()))], names=["version", "label", "shingles"]
            )

    sets = scratch.saved(spec.mapInArrow(hashed, "version long, label long, shingles array<long>"), "overlap-sets")
    held = sets.select("version", F.explode("shingles").alias("shingle"))
    often = held.groupBy("shingle").agg(F.count("*").alias("texts")).filter("texts > 1")
    shared = held.join(often, "shingle").groupBy("version").agg(F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("ordered"))
    sized = sets.select("version", "label", F.size("shingles").alias("size")).join(shared, "version")

    def first(batches):
        for batch in batches:
            rows = {name: [] for name in ("version", "label", "own", "partner", "shingles")}
            for version, label, size, ordered in zip(*(batch.column(c) for c in ("version", "label", "size", "ordered"))):
                ordered, size = ordered.values.field("shingle").to_numpy(), size.as_py()
                for own, partner, most in prefixes(size, least):
                    # the size less the shared ones are shingles of this text alone
                    taken = ordered[: max(0, most - (size - len(ordered)))]
                    if len(taken):
                        for name, value in zip(rows, (version.as_py(), label.as_py(), own, partner, taken)):
                            rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(rows[name], pa.int64()) for name in list(rows)[:4]), pa.array(rows["shingles"], pa.list_(pa.int64()))], names=list(rows)
            )

    parts = sized.mapInArrow(first, "version long, label long, own long, partner long, shingles array<long>")
    return scratch.saved(parts.select("version", "label", "own", "partner", F.explode("shingles").alias("shingle")), "overlap-prefixes")


def _apart_pairs(lists: DataFrame, labels: DataFrame, docs: DataFrame, text: str, words: int, least: float) -> DataFrame:
    """(a, b): members of a list that lie in different components; those of large lists by their prefixes."""
    members = _mixed_lists(lists, labels)
    few = _met(members.filter(F.col("n") <= MOST), band="band", key="key")
    many = members.filter(F.col("n") > MOST).select("version", "label").distinct()
    if many.isEmpty():
        return few
    return few.unionByName(_met(_prefix_members(docs, many, text, words, least), shingle="shingle", own="partner", partner="own"))


def counted(pairs: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """The pairs that share as many positional bytes as ``least_shared`` asks for."""
    most = PARTS - least_shared(least)
    ends = prints.select("version", "bytes")
    both = pairs.join(ends.toDF("a", "a_bytes"), "a").join(ends.toDF("b", "b_bytes"), "b")

    def run(batches):
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, PARTS) for c in ("a_bytes", "b_bytes")
            )
            yield batch.select(["a", "b"]).filter(pa.array((one != two).sum(axis=1) <= most))

    return both.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, text: str, words: int, least: float) -> DataFrame:
    """The (a, b) whose texts' similarity is ``least`` or more."""
    pairs = scratch.saved(pairs, "overlap-pairs")
    members = pairs.select(F.explode(F.array("a", "b")).alias("version")).distinct()
    texts = scratch.saved(
        docs.select(_version(text).alias("version"), F.col(text).cast("string").alias("text"))
        .join(members, "version", "left_semi").dropDuplicates(["version"]),
        "overlap-texts",
    )
    both = pairs.join(texts.select(F.col("version").alias("a"), F.col("text").alias("a_text")), "a").join(
        texts.select(F.col("version").alias("b"), F.col("text").alias("b_text")), "b"
    )

    def verify(batches):
        last, last_set = None, None
        for batch in batches:
            good = []
            for i in range(len(batch)):
                if batch.column("b")[i].as_py() != last:
                    last, last_set = batch.column("b")[i].as_py(), shingles(batch.column("b_text")[i].as_py(), words)
                good.append(similarity(shingles(batch.column("a_text")[i].as_py(), words), last_set) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    found = scratch.saved(both.mapInArrow(verify, "a long, b long"), "overlap-links")
    for done in (pairs, texts):
        scratch.remove_saved(done)
    return found


def _lists(prints: DataFrame) -> DataFrame:
    return scratch.saved(prints.select("version", F.posexplode("keys").alias("band", "key")), "overlap-lists")


def candidates(docs: DataFrame, text: str = "text", words: int = 5) -> DataFrame:
    """(a, b), a < b: hashes of the texts compared before there are components."""
    prints = _prints(docs, text, words)
    return _bit_pairs(prints).unionByName(_first_pairs(_lists(prints))).distinct()


def links(docs: DataFrame, text: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """(a, b): hashes of texts whose similarity is ``least`` or more, enough to join all that are."""
    prints = _prints(docs, text, words)
    lists = _lists(prints)
    first = _bit_pairs(prints).unionByName(_first_pairs(lists)).distinct()
    found = verified(counted(first, prints, least), docs, text, words, least)
    apart = _apart_pairs(lists, components.labels(found), docs, text, words, least).distinct()
    return found.unionByName(verified(counted(apart, prints, least), docs, text, words, least))


def keep_one(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """The documents without near copies: of each component one row, that of the smallest id.

    Of equal ids the smaller text hash counts, and of rows equal in both one stays; null ids
    come last.  All columns stay.
    """
    labels = components.labels(links(docs, "text", words, least))
    id_type = docs.schema["doc_id"].dataType
    by_text = docs.select(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id")).alias("named"),
                          _version("text").alias("version")).groupBy("version").agg(F.min("named").alias("named"))
    chosen = (
        by_text.join(labels, by_text.version == labels.node, "left")
        .groupBy(F.coalesce("label", "version").alias("component"))
        .agg(F.min(F.struct("named.nameless", "named.id", "version")).alias("kept"))
        .select(F.struct(F.col("kept.id").cast(id_type).alias("id"), F.col("kept.version").alias("version")).alias("kept"))
    )
    keyed = docs.select(F.struct("*").alias("row"), F.struct(F.col("doc_id").alias("id"), _version("text").alias("version")).alias("key"))
    return keyed.join(chosen, F.col("key") == F.col("kept"), "left_semi").dropDuplicates(["key"]).select("row.*")
