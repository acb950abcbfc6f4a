"""Best-fit packing of tokenized documents, certified by dual-feasible lower bounds.

1. Documents become pieces (a short row each: place, length, checksum).
2. Pieces are dealt into pools of a bounded number of tokens.  Each pool is packed by
   best-fit decreasing and compared with a lower bound from dual feasible functions; a pool
   that meets its bound is certified optimal.
3. The pools' sequences that have gaps are exchanged: they are dealt anew, as whole
   sequences, into fewer pools, whose pieces are packed again.  A pool takes the new packing
   only if it has fewer sequences, so no round makes anything worse.  Rounds stop when the
   whole corpus meets its own bound, or when no pool improved and all gaps have met.

Only the number of sequences and a histogram of piece lengths (at most one row per length)
come to the driver.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_left, insort
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch

_WORDS_AT_ONCE = 10_000
_PUNCTUATION = b".,!;:?%$&*#|"


class WordTokenizer:
    """Ids of texts by a tokenizer that never joins characters across white space.

    Words (ASCII white space, A-Z lowered as the tokenizer itself does) are encoded once and
    remembered; a text's ids are those of its words.  Words go in two generations, each of half of
    ``remembered`` words and what one call brings: so words in use stay, and words that came once go.
    """

    def __init__(self, path: str, remembered: int = 500_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.remembered = remembered
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        vocabulary = self.inner.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @classmethod
    @functools.lru_cache(maxsize=4)
    def shared(cls, path: str, remembered: int) -> WordTokenizer:
        return cls(path, remembered)

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words; those of letters only go as one text, told apart by their last tokens."""
        texts = [w.decode() for w in words]
        plain = [i for i, text in enumerate(texts) if text.isalpha()]
        rest = [i for i, text in enumerate(texts) if not text.isalpha()]
        for low in range(0, len(plain), _WORDS_AT_ONCE):
            some = plain[low : low + _WORDS_AT_ONCE]
            got = self.inner.encode_batch_fast([" ".join([texts[i] for i in some])], add_special_tokens=False)
            ids = np.array(got[0].ids, "<u4")
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) != len(some) or stops[-1] != 4 * len(ids):
                rest += some  # a letter here that the tokenizer takes for something else
                continue
            raw = ids.tobytes()
            self.known.update(zip(
                [words[i] for i in some], [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)], strict=True
            ))
        coded = self.inner.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)
        for i, got in zip(rest, coded, strict=True):
            self.known[words[i]] = np.array(got.ids, "<u4").tobytes()

    def _held(self, word: bytes) -> bool:
        if word not in self.known:
            if word not in self.before:
                return False
            self.known[word] = self.before[word]
        return True

    def words(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > self.remembered // 2:
            self.before, self.known = self.known, {}
        known = self.known
        split, direct = {}, set()
        for word in words:
            if word not in known and not self._held(word):
                # a run of marks after an ASCII letter or digit is always a token run of its own
                stem = word.rstrip(_PUNCTUATION)
                if len(stem) < len(word) and stem[-1:].isalnum():
                    mark = word[len(stem) :]
                    split[word] = (stem, mark)
                    direct.update(x for x in (stem, mark) if not self._held(x))
                else:
                    direct.add(word)
        self._learn(list(direct))
        for word, (stem, mark) in split.items():
            known[word] = known[stem] + known[mark]
        return [known[w] for w in words]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each non-null text, little-endian 32 bits each."""
        parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat = parts.flatten()
        coded = flat.dictionary_encode()
        words = pc.cast(coded.dictionary, pa.large_binary()).to_pylist()
        blank = {i for i, w in enumerate(words) if not w}
        found = [b"" if i in blank else None for i in range(len(words))]
        real = [i for i in range(len(words)) if i not in blank]
        for i, ids in zip(real, self.words([words[i] for i in real]), strict=True):
            found[i] = ids
        store = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter((len(x) >> 2 for x in found), np.int64, len(found))
        start = np.cumsum(size) - size
        which = coded.indices.to_numpy(zero_copy_only=False)
        # gather: position of every id in the store
        reps = size[which]
        stops = np.cumsum(reps)
        shift = np.repeat(start[which] - (stops - reps), reps)
        ids = store[shift + np.arange(len(shift))]
        counts = parts.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], stops))[np.cumsum(counts)] if len(stops) else np.zeros(len(counts), np.int64)
        begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        raw = ids.tobytes()
        return [raw[a * 4 : b * 4] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
           text: str = "text", remembered: int = 500_000, slice_bytes: int = 4 << 20) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document: its ids and ``end_id``, cut if too long."""
    spec = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = spec.schema["id"].dataType.simpleString()
    closing = int(end_id).to_bytes(4, "little")
    step = 4 * capacity

    def run(batches):
        tokenizer = WordTokenizer.shared(path, remembered)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            low = 0
            sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
            while low < len(batch):
                limit = (sizes[low - 1] if low else 0) + slice_bytes
                high = max(low + 1, int(np.searchsorted(sizes, limit, side="right")))
                some = table.slice(low, high - low).combine_chunks()
                place, rows = [], []
                for i, ids in enumerate(tokenizer.encode(some.column("text").combine_chunks())):
                    ids += closing
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        place.append(i)
                        rows.append((k, at // 4, len(part) // 4, zlib.crc32(part)))
                columns = [pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                ids_taken = some.column("id").combine_chunks().take(pa.array(place))
                yield pa.RecordBatch.from_arrays([ids_taken, *columns], names=["id", "piece", "start", "length", "ids_crc32"])
                low = high
        pa.default_memory_pool().release_unused()  # the worker stays after its task

    return spec.mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of the volume and two families of dual
    feasible functions (threshold, and rounding by an integer factor)."""
    if not len(lengths):
        return 0
    volume = int((lengths * counts).sum())
    best = -(-volume // capacity)
    for cut in np.unique(lengths[lengths * 2 <= capacity]).tolist() or [0]:
        # lengths above capacity - cut count whole, below cut not at all
        large = lengths > capacity - cut
        middle = (lengths >= cut) & ~large
        total = int((counts[large]).sum()) * capacity + int((lengths * counts)[middle].sum())
        best = max(best, -(-total // capacity))
    for k in range(1, 21):
        # x -> x if (k + 1) x is whole in capacities, else floor((k + 1) x) / k
        whole = (lengths * (k + 1)) % capacity == 0
        scaled = np.where(whole, lengths * k, (lengths * (k + 1)) // capacity * capacity)
        total = int((scaled * counts).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; ``lengths`` must fall.  Ties go to the oldest bin."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    gaps: list[int] = []  # gaps that some bin has, sorted
    open_bins: dict[int, list[int]] = {}
    used = 0
    for i, length in enumerate(lengths.tolist()):
        at = bisect_left(gaps, length)
        if at == len(gaps):
            gap, chosen, used = capacity, used, used + 1
        else:
            gap = gaps[at]
            chosen = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap], gaps[at]
        bins[i], offsets[i] = chosen, capacity - gap
        left = gap - length
        if left:
            if left not in open_bins:
                open_bins[left] = []
                insort(gaps, left)
            open_bins[left].append(chosen)
    return bins, offsets


def fullest_bins(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece; ``lengths`` must fall.

    Each bin takes the longest piece left and then those that fill it best (subset sums, long
    pieces first): slower than best fit, and tighter where gaps add up to less than a bin.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    sizes = lengths.tolist()
    left, used = list(range(len(sizes))), 0
    while left:
        first, *rest = left
        gap = capacity - sizes[first]
        within, reached = (1 << (gap + 1)) - 1, [1]  # bit s: some of the pieces so far add up to s
        for i in rest:
            reached.append((reached[-1] | reached[-1] << sizes[i]) & within)
            if reached[-1] >> gap:
                break
        total, taken = reached[-1].bit_length() - 1, [first]
        for k in range(len(reached) - 1, 0, -1):
            if not reached[k - 1] >> total & 1:
                taken.append(rest[k - 1])
                total -= sizes[rest[k - 1]]
        at = 0
        for i in taken:
            bins[i], offsets[i], at = used, at, at + sizes[i]
        gone = set(taken)
        left, used = [i for i in left if i not in gone], used + 1
    return bins, offsets


_PACKED = "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long, certified boolean"


def _repack(capacity: int, turn: int, last: bool):
    """Pack one pool; rows that are packed already stay so unless there are fewer sequences now.

    The ``last`` pool, which no exchange can help, is packed in the tighter way too.
    """

    def run(pool: pd.DataFrame) -> pd.DataFrame:
        pool = pool.sort_values(["length", "id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True])
        bins, offsets = best_fit_decreasing(pool["length"].to_numpy(), capacity)
        lengths, counts = np.unique(pool["length"].to_numpy(), return_counts=True)
        needed = lower_bound(lengths, counts, capacity)
        if last and bins.max() + 1 > needed:
            tighter = fullest_bins(pool["length"].to_numpy(), capacity)
            if tighter[0].max() < bins.max():
                bins, offsets = tighter
        count = int(bins.max()) + 1
        if turn == 0 or count < pool["sequence_id"].nunique():
            pool["sequence_id"] = (turn << 56) + (pool["pool"].to_numpy() << 22) + bins
            pool["offset"] = offsets
        pool["fill"] = pool.groupby("sequence_id")["length"].transform("sum")
        pool["certified"] = pool["sequence_id"].nunique() == needed
        return pool.drop(columns="pool")

    return run


def packed(
    docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
    text: str = "text", pool_tokens: int = 1 << 20, rounds: int = 6, shrink: int = 16,
    remembered: int = 500_000, slice_bytes: int = 4 << 20,
) -> DataFrame:
    """Pieces with their sequence and place in it.

    Columns: the id, piece, start, length, ids_crc32, sequence_id, offset (gapless from 0 in
    each sequence), fill (tokens of the sequence) and certified (its pool met its lower bound
    when it was last packed).  ``pool_tokens`` bounds what one task packs; ``shrink`` is how many
    pools' gaps meet in one pool of the next round; ``rounds`` bounds the exchanges.
    ``remembered`` words stay in a Python worker, which tokenizes ``slice_bytes`` of text at once:
    less takes less memory and more time.  A null or empty text is one piece with the end id alone;
    repeated rows are packed each; an empty table gives no rows.
    """
    if not 1 <= capacity < 1 << 20:
        raise ValueError("capacity must be between 1 and 2**20 - 1")
    rows = scratch.saved(pieces(docs, path, capacity, end_id, id_column, text, remembered, slice_bytes), "pieces")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, {_PACKED}"
    histogram = rows.groupBy("length").agg(F.count("*").alias("n")).toPandas()  # at most ``capacity`` rows
    lengths, counts = histogram["length"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64)
    needed = lower_bound(lengths, counts, capacity)
    pools = max(1, ceil(int((lengths * counts).sum()) / pool_tokens))

    spread = lambda *by: F.pmod(F.xxhash64(*by), F.lit(pools)).cast("long").alias("pool")
    moving = rows.select(
        "*", F.lit(-1).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        spread("id", "piece", "start", "ids_crc32"),
    )
    settled: list[DataFrame] = []  # full sequences of the rounds so far
    done, before = 0, None
    for turn in range(rounds + 1):
        state = scratch.saved(moving.groupBy("pool").applyInPandas(_repack(capacity, turn, pools == 1), schema), "packing")
        # a sequence has one piece at offset 0
        whole, gaps = state.filter("offset = 0").agg(
            F.count(F.when(F.col("fill") == capacity, 1)), F.count(F.when(F.col("fill") < capacity, 1))
        ).first()
        total = done + whole + gaps
        if total <= needed or turn == rounds or (total == before and pools == 1):
            break
        # exchange: the sequences with gaps are dealt anew, each as a whole
        settled.append(state.filter(F.col("fill") == capacity))
        done, before = done + whole, total
        pools = max(1, ceil(pools / shrink), ceil(gaps * capacity / (4 * pool_tokens)))
        moving = state.filter(F.col("fill") < capacity).drop("fill", "certified").select(
            "*", spread("sequence_id", F.lit(turn))
        )
    return reduce(DataFrame.unionByName, settled, state).withColumnRenamed("id", id_column)
