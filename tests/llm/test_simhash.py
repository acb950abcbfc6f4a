import itertools

import numpy as np
import xxhash

from paddockflow.llm import components, simhash


def plain_fingerprint(text, words=3):
    parts = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, most):
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(prints, 2):
            if bin(prints[a] ^ prints[b]).count("1") <= most and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def test_fingerprints(spark):
    for text in ("", None, "One", "a B c D e f", "É é ß\tx\vy z", "w " * 70_000):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_links_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    seeds = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = {int(s) for s in seeds}
    for s in seeds.tolist():  # chains and clouds around each
        for _ in range(int(draw.integers(0, 12))):
            s ^= 1 << int(draw.integers(64))
            values.add(s)
    prints = dict(enumerate(sorted(values)))
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    number = {signed(v): i for i, v in prints.items()}
    for most in (1, 2):
        rows = spark.createDataFrame([(v,) for v in number], "fp long")
        got = {i: i for i in prints}
        groups = {}
        for r in components.labels(simhash.links(rows, most)).collect():
            groups.setdefault(r["label"], []).append(number[r["node"]])
        for members in groups.values():
            got.update(dict.fromkeys(members, min(members)))
        want = plain_components(prints, most)
        assert {i: min(j for j in got if got[j] == got[i]) for i in got} == want


def test_documents_of_all_sorts(documents):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long), (3, long), (3, long), (9, None), (8, ""), (7, " \n"), (1, "alone in here"), (None, long), (4, long.upper())]
    got = simhash.near_duplicates(documents(rows)).collect()
    assert len(got) == len(rows)
    found = {(r["doc_id"], r["component_id"]) for r in got}
    assert found == {(5, 3), (3, 3), (4, 3), (None, 3), (9, 7), (8, 7), (7, 7), (1, 1)}
    assert {r["fingerprint"] for r in got if r["doc_id"] in (7, 8, 9)} == {"0" * 16}
    kept = simhash.keep_one(documents(rows))
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 3, 7]
    assert kept.columns == documents(rows).columns
    assert simhash.near_duplicates(documents([])).count() == 0


def test_a_large_near_copy_group_gives_few_links(spark):
    draw = np.random.default_rng(5)
    base = int(draw.integers(1 << 62))
    values = {base ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(60)}
    rows = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash.links(rows, 2)
    assert links.count() < 40 * len(values)
    assert components.labels(links).select("label").distinct().count() == 1
