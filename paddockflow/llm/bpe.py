"""Byte-level BPE encoding by replaying merges over a block of the corpus.

The pieces of a block are numbered.  Its distinct pieces that are not known yet are laid out as
one long array of symbols.  An inverted index holds, for every token that a neighbouring pair could become,
the positions where such a pair starts.  Tokens are then taken in rank order; each is
applied to all of its positions at once and only the touched neighbours enter the index
again.  The result is the same as encoding every piece by itself, but each merge costs one
array operation for the whole block.

A merge can make a token that goes on to one of lower rank, which must come before the next
place of the same rank in its word.  Such merges are made at one place of a word at a time; a
word with many such places leaves the index and is finished by itself, in time that grows with
its length times the logarithm of it.  Texts become ids, and ids bytes again, by gathering from
flat arrays.

Encoded pieces are remembered up to a bound, which changes speed and never the result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_REMEMBERED_BYTES = 128 << 20
_BLOCK_CHARACTERS = 16 << 20
_SLICE_CHARACTERS = 1 << 20
_GATHERED = 1 << 20
#: Places of one careful merge in a word from which on the word is finished by itself.
_MANY = 8


def gathered(store: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``store`` one after the other, and where each of them ends."""
    ends = np.cumsum(size[which])
    out = np.empty(int(ends[-1]) if len(ends) else 0, store.dtype)
    for low in range(0, len(which), _GATHERED):
        some = which[low : low + _GATHERED]
        reps = size[some]
        done = np.cumsum(reps)
        from_ = np.repeat(start[some] - (done - reps), reps) + np.arange(int(done[-1]))
        base = int(ends[low - 1]) if low else 0
        out[base : base + len(from_)] = store[from_]
    return out, ends


class Merges:
    """The vocabulary: ranks of byte strings, and which neighbouring pairs make a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.token_size[rank] = len(token)
        self.token_bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # tokens that can go on to form one of lower rank: they are applied one by one
        self.careful = {
            part for key, rank in pairs.items() for part in (key >> 32, key & 0xFFFFFFFF) if rank < part
        }

    @classmethod
    @functools.lru_cache(maxsize=4)
    def read(cls, path: str) -> Merges:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token each pair makes, -1 for none."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int64)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], -1)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Token ids (little-endian 32 bits each) of every word."""
        if not words:
            return []
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        size = len(data)
        symbol = self.single[data]
        word = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, size + 1)
        after[ends[lengths > 0] - 1] = -1
        before = np.arange(-1, size - 1)
        before[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(size, bool)
        starts = ends - lengths
        index: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def note(places: np.ndarray) -> None:
            """Enter the pairs that start at these positions."""
            places = places[after[places] >= 0]
            rank = self.pair_rank(symbol[places], symbol[after[places]])
            places, rank = places[rank >= 0], rank[rank >= 0]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            rank, places = rank[order], places[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for value, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts), strict=True):
                if value not in index:
                    index[value] = []
                    heapq.heappush(waiting, value)
                index[value].append(part)

        note(np.arange(size))
        while waiting:
            rank = heapq.heappop(waiting)
            parts = index.pop(rank)
            places = parts[0] if len(parts) == 1 else _distinct(np.concatenate(parts))
            places = places[alive[places]]
            places = places[after[places] >= 0]
            places = places[self.pair_rank(symbol[places], symbol[after[places]]) == rank]
            if not len(places):
                continue
            if rank in self.careful:
                home = word[places]
                fresh = np.flatnonzero(np.concatenate(([True], home[1:] != home[:-1])))
                crowded = home[fresh[np.diff(np.append(fresh, len(home))) >= _MANY]]
                for w in crowded.tolist():
                    low, high = int(starts[w]), int(ends[w])
                    held = low + np.flatnonzero(alive[low:high])
                    done = self.finish(symbol[held].tolist())
                    alive[low:high] = False
                    alive[held[: len(done)]] = True
                    symbol[held[: len(done)]] = done
                    after[low:high] = -1  # no pair of it is left in the index
                first = np.zeros(len(places), bool)
                first[fresh] = True
                open_ = after[places] >= 0
                places, later = places[first & open_], places[~first & open_]
                if len(later):
                    index[rank] = [later]
                    heapq.heappush(waiting, rank)
                if not len(places):
                    continue
            elif (after[places[:-1]] == places[1:]).any():
                # overlapping pairs: the left one of each two wins
                taken, stop = [], -1
                for place, end in zip(places.tolist(), after[places].tolist(), strict=True):
                    if place != stop:
                        taken.append(place)
                        stop = end
                places = np.array(taken)
            gone = after[places]
            symbol[places] = rank
            alive[gone] = False
            follow = after[gone]
            after[places] = follow
            inner = follow >= 0
            before[follow[inner]] = places[inner]
            left = before[places]
            note(_distinct(np.concatenate((left[left >= 0], places))))
        ids = symbol[alive].astype("<u4").tobytes()
        counts = np.bincount(word[alive], minlength=len(words))
        stops = (np.cumsum(counts) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


    def finish(self, symbols: list[int]) -> list[int]:
        """All merges of one word by themselves: the lowest rank first, the leftmost of equals."""
        pairs, n = self.pairs, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [
            rank << 40 | i for i in range(n - 1) if (rank := pairs.get(symbols[i] << 32 | symbols[i + 1])) is not None
        ]
        heapq.heapify(waiting)
        while waiting:
            rank, i = divmod(heapq.heappop(waiting), 1 << 40)
            j = after[i]
            if j >= n or symbols[i] < 0 or pairs.get(symbols[i] << 32 | symbols[j]) != rank:
                continue
            symbols[i], symbols[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                made = pairs.get(rank << 32 | symbols[k])
                if made is not None:
                    heapq.heappush(waiting, made << 40 | i)
            h = before[i]
            if h >= 0:
                made = pairs.get(symbols[h] << 32 | rank)
                if made is not None:
                    heapq.heappush(waiting, made << 40 | h)
        return [s for s in symbols if s >= 0]


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


class Encoder:
    """Texts to ids by a pattern and merges; remembers pieces within a bound of bytes."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges.read(path)
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        #: number of each known piece; its ids are a stretch of ``store``
        self.known: dict[str, int] = defaultdict(itertools.count().__next__)
        self.store, self.held = np.zeros(0, np.uint32), 0
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @classmethod
    @functools.lru_cache(maxsize=4)
    def shared(cls, path: str, pattern: str) -> Encoder:
        return cls(path, pattern)

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The pieces of each text by number."""
        pieces = list(map(self.pattern.findall, texts))
        sizes = np.cumsum(list(map(len, pieces)))
        coded = pa.array(list(itertools.chain.from_iterable(pieces)), pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        own = np.fromiter(map(self.known.__getitem__, distinct), np.int32, len(distinct))
        return np.split(own[coded.indices.to_numpy()], sizes[:-1])

    def learn(self) -> None:
        """Encode the pieces that have a number and no ids yet."""
        fresh = list(itertools.islice(self.known, len(self.size), None))
        if not fresh:
            return
        codes: list[bytes] = [b""] * len(fresh)
        rest, words = [], []
        for i, piece in enumerate(fresh):
            token = piece.encode("utf-8", "surrogatepass")
            rank = self.merges.ranks.get(token)
            if rank is None:
                rest.append(i)
                words.append(token)
            else:
                codes[i] = rank.to_bytes(4, "little")
        for i, ids in zip(rest, self.merges.replay(words), strict=True):
            codes[i] = ids
        size = np.fromiter(map(len, codes), np.int64, len(codes)) >> 2
        self.store = np.concatenate((self.store, np.frombuffer(b"".join(codes), "<u4")))
        self.size = np.concatenate((self.size, size))
        self.start = np.cumsum(self.size) - self.size
        self.held += sum(200 + 2 * len(p) for p in fresh)

    def ids(self, numbers: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of texts given by the numbers of their pieces."""
        ids, ends = gathered(self.store, self.start, self.size, np.concatenate(numbers))
        stops = np.concatenate(([0], ends))[np.cumsum([len(n) for n in numbers])]
        return np.split(ids, stops[:-1])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not texts:
            return []
        numbers = self.numbers(texts)
        self.learn()
        return [ids.astype("<u4").tobytes() for ids in self.ids(numbers)]

    def decode(self, ids: bytes) -> bytes:
        return self.decoded([np.frombuffer(ids, "<u4")])[0]

    def decoded(self, ids: list[np.ndarray]) -> list[bytes]:
        m = self.merges
        raw, ends = gathered(m.token_bytes, m.token_start, m.token_size, np.concatenate(ids).astype(np.int64))
        stops = np.concatenate(([0], ends))[np.cumsum([len(i) for i in ids])]
        return [part.tobytes() for part in np.split(raw, stops[:-1])]


def _runs(sizes: list[int], most: int):
    """Runs of rows with a bounded sum of sizes; a larger row is a run by itself."""
    low = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield low, i
            low, held = i, 0
        held += size
    if low < len(sizes):
        yield low, len(sizes)


def _digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", id_column: str = "doc_id",
            digest: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Columns: the id, ids (array of int) and decoded (binary); with ``digest`` instead n_tokens
    and the SHA-256 of both.  ``path`` is a file of base64 tokens and ranks that every executor
    can open.  A null text is encoded like an empty one (no ids); a very long text, or a long
    piece without a break, takes time in proportion to its length (times the logarithm of a
    piece's); repeated rows stay, and an empty table gives no rows.
    """
    spec = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = spec.schema["id"].dataType.simpleString()
    own = (
        "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest
        else "ids array<int>, decoded binary"
    )

    def run(batches):
        encoder = Encoder.shared(path, pattern)
        for batch in batches:
            texts, names = batch.column("text"), batch.column("id")
            sizes = pc.utf8_length(texts).to_pylist()
            for low, high in _runs(sizes, _BLOCK_CHARACTERS):
                if encoder.held > _REMEMBERED_BYTES:
                    encoder.forget()
                # a slice of rows at a time, so that few texts are held as Python strings
                slices = [(low + a, low + b) for a, b in _runs(sizes[low:high], _SLICE_CHARACTERS)]
                numbers = [encoder.numbers(texts[a:b].to_pylist()) for a, b in slices]
                encoder.learn()
                for (a, b), some in zip(slices, numbers, strict=True):
                    ids = encoder.ids(some)
                    back = encoder.decoded(ids)
                    if digest:
                        columns = {
                            "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                            "ids_sha256": pa.array([_digest(i.astype("<u4").tobytes()) for i in ids], pa.string()),
                            "decoded_sha256": pa.array(map(_digest, back), pa.string()),
                        }
                    else:
                        columns = {
                            "ids": pa.array([i.astype("<i4") for i in ids], pa.list_(pa.int32())),
                            "decoded": pa.array(back, pa.binary()),
                        }
                    yield pa.RecordBatch.from_arrays([names[a:b], *columns.values()], names=["id", *columns])

    return spec.mapInArrow(run, f"id {id_type}, {own}").withColumnRenamed("id", id_column)
