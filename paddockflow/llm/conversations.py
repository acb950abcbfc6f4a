"""Prefix trie of conversations as minimal-perfect-hash node tables.

1. Rebuilding.  Conversation c begins with the first h turns of conversation c - c % every and
   goes on with its own turns behind its first h.  The digest of a prefix is a polynomial in the
   digests of its turns, so it can be summed up in pieces: turns are sorted by range, a long
   conversation may lie in many tasks, and what the earlier tasks hold of it is added afterwards.
   The same algebra moves a conversation's own turns behind the turns it takes over.
2. Enumeration.  Each distinct prefix digest is a node; members are counted ahead of the shuffle.
   Rows that meet in a digest must agree on depth, parent and an independent hash of the last
   turn, or the job fails: by induction equal digests are equal sequences.
3. Node tables.  A shard holds whole subtrees.  Its distinct digests get the slots of a minimal
   perfect hash; the digest is kept in its slot, so a lookup knows whether it found its node.
   Counts are scattered into flat arrays, and sums run up the parent slots in depth order.
   Nodes with more than ``weight`` member rows below them are cut off and form tables of their
   own in the next round, those with more than ``weight`` ** 2 in the one after: rounds grow with
   the logarithm of the input, and a first turn that a third of all conversations share costs one
   node in a higher table.  A table holds at most ``weight`` nodes of each depth below its top.
4. Prefixes of a single conversation need no table below their first node: their figures follow
   from the conversation's length.

Order: by turn, null first, then role and text.  Rows alike in all of them are repeated turns.
Null role or text is empty, a null conv_id has no conversation and takes no part, texts are
hashed whole, and other columns are not looked at.  An empty table has no nodes, not even a root.
c % every has the sign of c, as in SQL.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddockflow import scratch

# A Mersenne prime, and any number below it with its inverse.
_PRIME = (1 << 127) - 1
_BASE = 0x3C79AC492BA7B653_1C69B3F74AC4AE35 % _PRIME
_INVERSE = pow(_BASE, -1, _PRIME)
_ROOT = b"\0" * 16
#: Prefix characters that order turns across tasks; the whole text orders them within one.
_LEAD = 64
#: Ids of one stretch of conversations, joined before they are hashed.
_STRETCH_BITS = 12
NODES_AT_ONCE = 1 << 16
WEIGHT = 1 << 10


def _number(packed: bytes) -> int:
    return int.from_bytes(packed, "big")


def _packed(number: int) -> bytes:
    return number.to_bytes(16, "big")


_PLACED = "part int, edge boolean, conv_id long, pos long, before binary, after binary, size long, proof long"


def _sorted_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, token, size, proof) in order of turns, split over tasks anywhere."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    ).where(F.col("conv_id").isNotNull())
    lead = [F.substring(c, 1, _LEAD) for c in ("role", "text")]
    turn = F.col("turn").asc_nulls_first()
    dealt = rows.repartitionByRange("conv_id", turn, lead[0], lead[1])
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return dealt.sortWithinPartitions("conv_id", turn, lead[0], lead[1], "role", "text").select(
        "conv_id",
        F.unhex(F.md5(whole)).alias("token"),
        F.length("text").cast("long").alias("size"),
        F.xxhash64("role", "text").alias("proof"),
    )


def _placed(turns: DataFrame) -> DataFrame:
    """Each turn with its place and prefix digests as far as its task knows.

    ``edge`` rows say how many turns, and which digest, the task holds of its first and its
    last conversation: the only ones that can go on in another task.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        conv, count, total, power, first = None, 0, 0, 1, True

        def frame(edge, rows):
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), pa.array([edge] * len(rows)), *arrays],
                names=["part", "edge", "conv_id", "pos", "before", "after", "size", "proof"],
            )

        for batch in batches:
            rows = []
            for c, token, size, proof in zip(*(column.to_pylist() for column in batch.columns)):
                if c != conv:
                    if conv is not None and first:
                        yield frame(True, [(conv, count, _ROOT, _packed(total), 0, 0)])
                        first = False
                    conv, count, total, power = c, 0, 0, 1
                before = total
                total = (total + (_number(token) % (_PRIME - 1) + 1) * power) % _PRIME
                rows.append((c, count, _packed(before), _packed(total), size, proof))
                power = power * _BASE % _PRIME
                count += 1
            if rows:
                yield frame(False, rows)
        if conv is not None:
            yield frame(True, [(conv, count, _ROOT, _packed(total), 0, 0)])

    return scratch.saved(turns.mapInArrow(run, _PLACED), "turns")


def _carries(placed: DataFrame) -> dict[int, tuple[int, int, int]]:
    """By task: the conversation it goes on with, and that one's turns and digest in earlier tasks."""
    held, carries = {}, {}
    edges = placed.where("edge").select("part", "conv_id", "pos", "after").collect()  # two rows a task
    for row in sorted(edges, key=lambda r: (r["part"], r["conv_id"])):
        count, total = held.get(row["conv_id"], (0, 0))
        if count:
            carries[row["part"]] = row["conv_id"], count, total
        grown = (total + _number(row["after"]) * pow(_BASE, count, _PRIME)) % _PRIME
        held = {row["conv_id"]: (count + row["pos"], grown)}
    return carries


def _own_turns(placed: DataFrame) -> DataFrame:
    """(conv_id, pos, before, after, size, proof): each turn with its place and prefix digests."""
    carries = _carries(placed)
    rows = placed.where("not edge").drop("edge")
    if not carries:
        return rows.drop("part")

    def run(batches):
        for batch in batches:
            parts, convs = (batch.column(c).to_numpy() for c in ("part", "conv_id"))
            columns = {c: batch.column(c) for c in ("pos", "before", "after")}
            for part in np.unique(parts).tolist():
                if part not in carries:
                    continue
                conv, count, total = carries[part]
                met = (parts == part) & (convs == conv)
                power = pow(_BASE, count, _PRIME)
                columns["pos"] = pa.array(columns["pos"].to_numpy() + met * count)
                for c in ("before", "after"):
                    columns[c] = pa.array(
                        [_packed((total + _number(v) * power) % _PRIME) if m else v
                         for v, m in zip(columns[c].to_pylist(), met)], pa.binary()
                    )
            kept = [columns.get(c, batch.column(c)) for c in ("conv_id", "pos", "before", "after", "size", "proof")]
            yield pa.RecordBatch.from_arrays(kept, names=["conv_id", "pos", "before", "after", "size", "proof"])

    out = "conv_id long, pos long, before binary, after binary, size long, proof long"
    return rows.mapInArrow(run, out)


def prefixes(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, the empty one included.

    (conv_id, depth, digest, parent, size, proof, n_turns); ``size`` and ``proof`` are of the last
    turn, ``n_turns`` is the rebuilt conversation's length.  h is crc32(conv_id as text) % ``most``.
    """
    placed = _placed(_sorted_turns(conversations))
    own = _own_turns(placed)
    head = F.when(F.col("pos") < most - 1, F.struct("pos", "before", "after", "size", "proof"))
    each = own.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(head)).alias("heads"))
    origin = F.col("conv_id") - F.col("conv_id") % every
    taken = F.when(origin == F.col("conv_id"), 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % most)
    lent = each.select(F.col("conv_id").alias("origin"), F.col("heads").alias("lent"))
    joined = each.select("conv_id", "n", "heads", origin.alias("origin"), taken.cast("int").alias("h")).join(
        lent, "origin", "left"
    )
    m = F.least("h", F.greatest(F.coalesce(F.size("lent"), F.lit(0)), F.lit(0)))
    root = F.lit(_ROOT)
    plan = scratch.saved(
        joined.withColumn("m", m).select(
            "conv_id", "h", "m",
            F.when(F.col("m") > 0, F.slice("lent", 1, F.greatest("m", F.lit(1)))).alias("lent"),
            F.coalesce(F.get("lent", F.col("m") - 1)["after"], root).alias("front"),
            F.coalesce(F.get("heads", F.col("h") - 1)["after"], root).alias("skipped"),
            (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"),
        ),
        "rebuilt",
    )
    zero = F.lit(0).cast("long")
    roots = plan.select(
        "conv_id", zero.alias("depth"), root.alias("digest"), F.lit(None).cast("binary").alias("parent"),
        zero.alias("size"), zero.alias("proof"), "n_turns",
    )
    fronts = plan.select("conv_id", "n_turns", F.inline("lent")).select(
        "conv_id", (F.col("pos") + 1).alias("depth"), F.col("after").alias("digest"), F.col("before").alias("parent"),
        "size", "proof", "n_turns",
    )
    rests = own.join(plan.drop("lent"), "conv_id").where(F.col("pos") >= F.col("h"))

    def run(batches):
        turned = [pow(_INVERSE, k, _PRIME) for k in range(most)]
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("before", "after", "front", "skipped", "h", "m")}
            moved = {}
            for c in ("before", "after"):
                moved[c] = pa.array(
                    [
                        v if not h else _packed((_number(f) + (_number(v) - _number(s)) * turned[h - m]) % _PRIME)
                        for v, f, s, h, m in zip(rows[c], rows["front"], rows["skipped"], rows["h"], rows["m"])
                    ],
                    pa.binary(),
                )
            depth = sum(batch.column(c).to_numpy() * w for c, w in (("pos", 1), ("m", 1), ("h", -1))) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(depth, pa.int64()), moved["after"], moved["before"],
                 *[batch.column(c) for c in ("size", "proof", "n_turns")]],
                names=["conv_id", "depth", "digest", "parent", "size", "proof", "n_turns"],
            )

    moved = rests.mapInArrow(
        run, "conv_id long, depth long, digest binary, parent binary, size long, proof long, n_turns long"
    )
    found = scratch.saved(roots.unionByName(fronts).unionByName(moved), "prefixes")
    for done in (placed, plan):
        scratch.remove_saved(done)
    return found


class NodeTable:
    """Minimal perfect hash of distinct 16-byte keys: n keys have the slots 0 to n - 1.

    Keys that are alone in their place of a bit array get its rank as slot; the others try the
    next array.  A key that is not in the table is told by the key kept in the slot it hits.
    """

    _ROOM = 1.5

    def __init__(self, keys: np.ndarray):
        self.arrays, self.n = [], 0
        left = np.arange(len(keys))
        while len(left):
            size = int(len(left) * self._ROOM) + 1
            place = self._place(keys[left], len(self.arrays), size)
            alone = np.bincount(place, minlength=size) == 1
            self.arrays.append((size, alone, self.n + np.cumsum(alone) - 1))
            self.n += int(alone.sum())
            left = left[~alone[place]]
        self.keys = np.zeros_like(keys)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
        mixed = (keys[:, 0] ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(31)) ^ keys[:, 1]) * np.uint64(0x94D049BB133111EB)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(keys), -1), np.arange(len(keys))
        for seed, (size, alone, rank) in enumerate(self.arrays):
            place = self._place(keys[left], seed, size)
            hit = alone[place]
            slots[left[hit]] = rank[place[hit]]
            left = left[~hit]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that the table does not hold."""
        found = self._slots(keys)
        if self.n:
            found[(self.keys[np.maximum(found, 0)] != keys).any(axis=1)] = -1
        return found


def summed(rows: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Figures of the nodes of one shard, in the order of its rows.

    ``tail`` rows stand for the rest of a single conversation; ``given_*`` is what lower tables
    found below a node.
    """

    def keys(name):
        whole = b"".join(v or b"\xff" * 16 for v in rows.column(name).to_pylist())
        return np.frombuffer(whole, ">u8").astype(np.uint64).reshape(-1, 2)

    def numbers(name):
        return rows.column(name).to_numpy(zero_copy_only=False).astype(np.int64)

    digests = keys("digest")
    table = NodeTable(np.unique(digests, axis=0))
    slot = table.slots(digests)
    parent = np.full(table.n, -1)
    parent[slot] = table.slots(keys("parent"))
    flat = {name: np.zeros(table.n, np.int64) for name in ("depth", "saved", "leaves", "children", "tail")}
    tail, ends = numbers("tail"), numbers("n_ends")
    np.add.at(flat["depth"], slot, numbers("depth"))
    np.add.at(flat["tail"], slot, tail)
    np.add.at(flat["saved"], slot, (numbers("n_convs") - 1) * numbers("size") + numbers("given_saved"))
    np.add.at(flat["leaves"], slot, tail + numbers("given_leaves"))
    np.add.at(flat["children"], slot, tail * (ends == 0) + numbers("given_children"))
    inside = parent >= 0
    np.add.at(flat["children"], parent[inside], 1)
    flat["leaves"] += (flat["tail"] == 0) & (flat["children"] == 0)
    order = np.argsort(-flat["depth"], kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(flat["depth"][order])) + 1):
        level = level[inside[level]]
        for name in ("saved", "leaves"):
            np.add.at(flat[name], parent[level], flat[name][level])
    return {name: flat[name][slot] for name in ("saved", "leaves", "children")}


def _agreed(name: str) -> Column:
    low, high = F.col(f"least_{name}"), F.col(f"most_{name}")
    return F.when(low.eqNullSafe(high), low).otherwise(F.raise_error(F.lit("two prefixes have one digest"))).alias(name)


def _nodes(rows: DataFrame) -> DataFrame:
    """One row a distinct prefix: its members, and whether it only goes on a single conversation."""
    agreed = ("depth", "parent", "proof", "size")
    counted = rows.groupBy("digest").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight"),
        F.count_if(F.col("n_turns") == F.col("depth")).alias("n_ends"),
        *[f(c).alias(f"{name}_{c}") for c in agreed for name, f in (("least", F.min), ("most", F.max))],
    )
    nodes = scratch.saved(
        counted.select("digest", "n_convs", "conv_id", "weight", "n_ends", *map(_agreed, agreed)).drop("proof"), "nodes"
    )
    tops = nodes.where("n_convs = 1").groupBy("conv_id").agg(F.min("depth").alias("tail_depth"))
    placed = nodes.join(tops, "conv_id", "left")
    return scratch.saved(
        placed.select(
            *nodes.columns, (F.col("n_convs") == 1).cast("int").alias("tail"),
            ((F.col("n_convs") == 1) & (F.col("depth") > F.col("tail_depth"))).alias("below_tail"),
        ),
        "nodes",
    )


def _ends(rows: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the prefixes at which conversations end.

    Ids are joined by stretches of conversations first, so what one task reads for a node is one
    row a stretch; SHA-256 itself can only be taken in order, in a stream.
    """
    stretches = (
        rows.where("depth = n_turns")
        .groupBy("digest", F.shiftright("conv_id", _STRETCH_BITS).alias("stretch"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    )

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
                if key != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], names=["digest", "ends_sha256"]
                )
        if node is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["digest", "ends_sha256"]
            )

    streamed = stretches.repartition("digest").sortWithinPartitions("digest", "stretch").select("digest", "ids")
    return scratch.saved(streamed.mapInArrow(run, "digest binary, ends_sha256 string"), "ends")


_SUMMED = "digest binary, parent binary, is_top boolean, saved long, leaves long, children long"


def _summed_tables(rows: DataFrame, nodes: DataFrame, weight: int, at_once: int) -> DataFrame:
    """(digest, parent, is_top, saved, leaves, children) of all nodes but those below a tail."""
    heaviest = nodes.agg(F.max("weight")).first()[0]
    cuts = []
    while heaviest is not None and heaviest > weight ** (len(cuts) + 1):
        cuts.append(weight ** (len(cuts) + 1))
    level = sum(((F.col("weight") > cut) & (F.col("tail") == 0)).cast("int") for cut in cuts) if cuts else F.lit(0)
    tabled = nodes.where("not below_tail").withColumn("level", level)
    # the topmost node of the same level on the way to the root; the root's own level needs no search
    way = rows.where("depth > 0").select("digest", F.col("conv_id"), "depth")
    levels = tabled.where(F.col("level") < len(cuts)).select("digest", "level")
    tops = way.join(levels, "digest").groupBy("conv_id", "level").agg(F.min_by("digest", "depth").alias("top"))
    tabled = scratch.saved(
        tabled.join(tops, ["conv_id", "level"], "left")
        .withColumn("top", F.when(F.col("level") == len(cuts), F.lit(_ROOT)).otherwise(F.col("top"))), "tables",
    )

    def run(batches):
        held = list(batches)
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()
            for part in whole[:1]:
                figures = summed(part)
                tops = pa.array([d == t for d, t in zip(part.column("digest").to_pylist(), part.column("top").to_pylist())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), part.column("parent"), tops, *map(pa.array, figures.values())],
                    names=["digest", "parent", "is_top", *figures],
                )

    done: list[DataFrame] = []
    figures = ("saved", "leaves", "children")
    for n in range(len(cuts) + 1):
        part = tabled.where(F.col("level") == n)
        if done:
            lower = reduce(DataFrame.unionByName, done).where("is_top and parent is not null")
            given = lower.groupBy(F.col("parent").alias("digest")).agg(
                F.sum("saved").alias("given_saved"), F.sum("leaves").alias("given_leaves"),
                F.count("*").alias("given_children"),
            )
            part = part.join(given, "digest", "left")
        else:
            part = part.withColumns({f"given_{f}": F.lit(None).cast("long") for f in figures})
        part = part.fillna(0, [f"given_{f}" for f in figures])
        shards = max(1, -(-part.count() // at_once))
        done.append(scratch.saved(part.repartition(shards, "top").mapInArrow(run, _SUMMED), f"summed-{n}"))
    scratch.remove_saved(tabled)
    return reduce(DataFrame.unionByName, done)


def trie(
    conversations: DataFrame, every: int = 100, most: int = 6, weight: int = WEIGHT, at_once: int = NODES_AT_ONCE
) -> DataFrame:
    """One row a node: digest, smallest member, depth, parent's smallest member, and its figures."""
    rows = prefixes(conversations, every, most)
    nodes = _nodes(rows)
    tables = _summed_tables(rows, nodes, weight, at_once)
    ends = _ends(rows)
    scratch.remove_saved(rows)
    above = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("above"))
    tabled = nodes.where("not below_tail").join(tables.drop("parent", "is_top"), "digest").join(above, "parent", "left")
    alone = nodes.where("below_tail").select(
        *nodes.columns, F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"),
        (1 - F.col("n_ends")).alias("children"), F.col("conv_id").alias("above"),
    )
    return tabled.unionByName(alone).join(ends, "digest", "left").select(
        "digest", "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs",
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
