import re

import numpy as np
import pyarrow as pa

from paddockflow.llm import lines
from paddockflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check(rows, texts, least):
    """Exactly the words go that lie in a window seen earlier; the others stay, with their line breaks."""
    first = {}
    for doc in sorted(texts):
        words = WORD.findall(texts[doc])
        for i in range(len(words) - least + 1):
            first.setdefault(tuple(words[i : i + least]), (doc, i))
    lost = 0
    for doc, text in texts.items():
        words = WORD.findall(text)
        must = set()
        for i in range(len(words) - least + 1):
            source, at = first[tuple(words[i : i + least])]
            if source != doc or i >= at + least:
                must.update(range(i, i + least))
        assert {i for s, e in rows[doc]["removed"] for i in range(s, e)} == must
        assert rows[doc]["n_removed"] == len(must)
        assert WORD.findall(rows[doc]["text"]) == [w for i, w in enumerate(words) if i not in must]
        if not must:
            assert rows[doc]["text"] == text
        lost += len(must)
    return lost


def named(frame):
    return {
        r["row"]["doc_id"]: {"removed": r["removed"], "n_removed": r["n_removed"], "text": r["clean_text"]}
        for r in frame.collect()
    }


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op6_line_dedup"](spark, sf_dir).collect()}
    assert len(rows) == len(texts)
    assert check(rows, texts, 50) > 0


def test_random_texts_against_brute_force(documents):
    draw = np.random.default_rng(2)
    pool = [" ".join(f"w{k}" for k in draw.integers(0, 4, int(n))) for n in draw.integers(0, 14, 12)]
    texts = {i: "\n".join(pool[k] for k in draw.integers(0, 12, int(draw.integers(1, 14)))) for i in range(80)}
    assert check(named(lines.deduplicated(documents(list(texts.items())), min_words=12)), texts, 12) > 100


def test_passages_inside_lines_and_edits(documents):
    """Passages that start and end inside lines, wrapped anew, edited, and frequent phrases around them."""
    draw = np.random.default_rng(3)
    fresh = lambda n: [f"x{k}" for k in draw.integers(0, 10**6, n)]
    passages, phrase = [fresh(50), fresh(63), fresh(200)], fresh(10)
    texts = {}
    for i in range(40):
        body = list(passages[i % 3])
        if i % 4 == 3:
            body[int(draw.integers(0, len(body)))] = "edited"
        words = fresh(20) + phrase + fresh(int(draw.integers(0, 30))) + body + fresh(7) + phrase + fresh(25)
        texts[i] = "".join(w + ("\n" if draw.random() < 0.1 else " ") for w in words)
    assert check(named(lines.deduplicated(documents(list(texts.items())))), texts, 50) > 1000


def test_winnowing_is_guaranteed():
    draw = np.random.default_rng(4)
    run = draw.integers(0, 1 << 63, 70).astype(np.uint64)
    keys, _, low, high = lines.winnow(run, 50)
    assert len(keys) < 21 and low[0] == 0 and high[-1] == 20 and (low[1:] == high[:-1] + 1).all()
    for _ in range(50):
        before, after = (draw.integers(0, 1 << 63, 40).astype(np.uint64) for _ in range(2))
        there = lines.winnow(np.concatenate((before, run, after)), 50)
        assert set(keys.tolist()) <= set(there[0].tolist())
    long = draw.integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert len(lines.winnow(long, 50)[0]) < 100_000 / 15


def test_hashes_do_not_depend_on_place():
    passage = " ".join(f"p{i}" for i in range(60)).encode()
    alone = lines.word_hashes(passage)
    assert len(set(alone.tolist())) == 60
    assert (lines.word_hashes(b"a bb  ccc\n" * 40_000 + passage)[-60:] == alone).all()
    assert len(lines.word_hashes(b"")) == 0 and len(lines.word_hashes(b" \n")) == 0
    assert len(lines.word_hashes(b"x" * 2_000_000)) == 1


def test_texts_are_hashed_together(monkeypatch):
    draw = np.random.default_rng(5)
    texts = ["".join(f"w{k}" + str(draw.choice([" ", "\n", "\u2003é "])) for k in draw.integers(0, 9, int(n))) for n in draw.integers(0, 90, 200)]
    texts[3:6], texts[-2:] = ["", " \n", "x" * 5000], ["w1 " * 3000, ""]
    one_by_one = [lines.word_hashes(t.encode()) for t in texts]
    hashed, calls = lines._hashes, []
    monkeypatch.setattr(lines, "_TOGETHER", 4096)
    monkeypatch.setattr(lines, "_hashes", lambda *a: calls.append(1) or hashed(*a))
    at = 0
    for rows, words, counts in lines.word_groups(pa.array(texts)):
        want = one_by_one[rows[0] : rows[-1] + 1]
        assert rows[0] == at and counts.tolist() == [len(w) for w in want]
        assert (words == np.concatenate(want)).all()
        begins = np.cumsum(counts) - counts
        alone = [lines.winnow(w, 20) for w in want]
        for i, got in enumerate(lines.winnow(words, 20, counts)):
            assert got.tolist() == np.concatenate([a[i] + (b if i else 0) for a, b in zip(alone, begins)]).tolist()
        at = rows[-1] + 1
    assert at == len(texts) and 2 < len(calls) < len(texts) / 5
    assert not list(lines.word_groups(pa.array([], pa.string())))


def test_white_space_that_goes():
    assert lines.cut("a b\nc d\ne f", [(2, 4)]) == "a b\ne f"
    assert lines.cut("a b\nc d\ne f", [(1, 4)]) == "a\ne f"
    assert lines.cut("a b\nc d\ne f", [(2, 3)]) == "a b\nd\ne f"
    assert lines.cut("a b\nc d\ne f", [(3, 6)]) == "a b\nc"
    assert lines.cut(" é b\nc ", [(0, 1), (2, 3)]) == " b"
    assert lines.cut(" a b ", [(0, 2)]) == ""


def test_documents_of_all_sorts(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (2, f"start two\n{passage}\ntwo ends"), (1, f"start one\n{passage}\none ends"), (3, passage), (4, None), (5, ""),
        (6, "x\n\nx\n\nx"), (7, f"{passage}\nmid\n{passage}"), (7, f"{passage}\nmid\n{passage}"),
        (8, "same " * 300), (9, "same " * 300),
    ]
    got = {}
    for r in lines.deduplicated(documents(rows)).collect():
        got.setdefault(r["row"]["doc_id"], []).append(r["clean_text"])
    assert got == {
        1: [rows[1][1]], 2: ["start two\ntwo ends"], 3: [""], 4: [None], 5: [""], 6: ["x\n\nx\n\nx"], 7: ["mid", "mid"],
        8: [" ".join(["same"] * 50)], 9: [""],
    }
    left = lines.without_repeats(documents(rows))
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 4, 5, 6, 7, 7, 8]
    assert left.columns == documents(rows).columns
    null_first = lines.deduplicated(documents([(None, passage), (1, passage)])).collect()
    assert {r["row"]["doc_id"]: r["clean_text"] for r in null_first} == {None: passage, 1: ""}
    assert lines.deduplicated(documents([])).count() == 0


def test_texts_are_cut_once(documents):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, f"one {passage}"), (2, f"two {passage}"), (3, f"{passage}")])
    left = lines.without_repeats(docs, 50)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()} == {1: (f"one {passage}", 4 + len(passage)), 2: ("two", 3)}
    # each evaluation in a plan takes a Python worker of its own, at the same time
    plan = left._jdf.queryExecution().optimizedPlan().toString() + left._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ArrowEvalPython") == 2  # once in the optimized plan, once in Spark's
