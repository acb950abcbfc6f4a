import random
import re
from hashlib import sha256

import pytest

from checking import compare, connect
from paddockflow.llm import phrases
from paddockflow.llm.queries import ORACLES, QUERIES

ITEMS = "item_id string, text string, doc_id int"


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def plain(documents, items, length=10):
    """(n_words, hit words, items) of each text, window by window."""
    windows = {}
    for name, text in items:
        for window in phrases.windows_of(words(text), length):
            windows.setdefault(window, set()).add(name or "")
    out = []
    for text in documents:
        found, hit, names = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for low in range(len(found) - size + 1):
                held = windows.get(tuple(found[low : low + size]))
                if held:
                    hit.update(range(low, low + size))
                    names |= held
        out.append((len(found), sorted(hit), sorted(names)))
    return out


def found(rows):
    out = {}
    for r in rows:
        hit = [w for a, b in zip(r["span_starts"], r["span_ends"]) for w in range(a, b)]
        out.setdefault(r["id"], []).append((r["n_words"], hit, r["items"]))
    return out


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {
        d["doc_id"]: (n, len(hit), len(names), sha256(",".join(names).encode()).hexdigest(), bool(hit))
        for d, (n, hit, names) in zip(docs, plain([d["text"] for d in docs], items))
    }
    got = QUERIES["op13_benchmark_decontamination"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert any(w[4] for w in want.values())


@pytest.mark.parametrize("part_words", [1 << 20, 30])
def test_odd_tables(spark, documents, part_words):
    """Nulls, empty and long texts, ties, repeated rows and clashing names, in one part and several."""
    draw = random.Random(13)
    some = [" ".join(draw.choice("a b c d É ß x1".split()) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    rows = list(enumerate(some)) + [(100, None), (101, ""), (102, "?!"), (103, "A b" * 9), (None, some[3]), (3, some[3])]
    rows += [(104, "y " * 70_000 + "one two three four five six seven eight nine ten")]
    items = [("i", "One, two three four five six seven eight nine ten eleven", 1), ("j", "a b", 1), ("j", "c C c", 1)]
    items += [(None, "É", 1), ("k", None, 1), ("l", "", 1), ("m", "a a b a b c", 1), ("n", some[3], 1), ("n", some[3], 1), ("o", "zz", 1)]
    got = phrases.decontaminated(
        documents(rows), spark.createDataFrame(items, ITEMS), part_words=part_words, segment_words=200
    ).collect()
    assert len(got) == len(rows)
    want = {}
    for (i, _), (n, hit, names) in zip(rows, plain([t for _, t in rows], [r[:2] for r in items])):
        want.setdefault(i, []).append((n, hit, names))
    assert found(got) == want
    assert want[104][0][2] == ["i"] and want[3][0][2]


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    item = spark.createDataFrame([("i", "a b", 1)], ITEMS)
    assert phrases.decontaminated(documents([]), item).collect() == []
    (row,) = phrases.decontaminated(documents([(1, "a b c")]), none).collect()
    assert (row["n_words"], row["items"], row["span_starts"]) == (3, [], [])
    assert phrases.decontaminated(documents([]), none).collect() == []


def test_a_passage_in_most_documents(spark, documents):
    passage = " ".join(f"w{i}" for i in range(14))
    rows = [(i, f"x{i} {passage} y {passage}" if i % 3 else f"x{i}") for i in range(300)]
    got = found(phrases.decontaminated(documents(rows), spark.createDataFrame([("p", passage, 1)], ITEMS)).collect())
    assert all(got[i][0][1] == ([*range(1, 15), *range(16, 30)] if i % 3 else []) for i in range(300))


def test_proximity_equals_brute_force(spark, documents):
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("abcdefgh") for _ in range(30))) for i in range(40)] + [(50, None)]
    known = {w.encode(): n for n, w in enumerate("abcdefgh")}
    index = phrases.build(documents(rows), known, gap=10, segment_words=100)
    for terms, within in ((["a", "b"], 2), (["a", "b", "c"], 5), (["h"], 1), (["a", "zz"], 9), (["a", "A", "b"], 3)):
        got = {r["id"] for r in phrases.near(index, known, terms, within).collect()}
        asked = {t.lower() for t in terms}
        assert got == {
            i for i, t in rows
            if any(asked <= set(words(t)[k : k + within]) for k in range(len(words(t))))
        }


def test_query_equals_sql(spark, sf_dir):
    good, message = compare(QUERIES["op13_benchmark_decontamination"](spark, sf_dir), connect(sf_dir), ORACLES["op13_benchmark_decontamination"])
    assert good, message
