import time
import zlib

from paddockflow.llm import toxicity
from paddockflow.llm.langid import held_out
from paddockflow.llm.queries import QUERIES

CLEAN = "the weather was fine over there and people walked along river with their children while music played softly".split()
INSULTS = ["idiot", "stupid", "moron", "pathetic"]


def corpus(n=400):
    rows = []
    for i in range(n):
        words = [CLEAN[(i * 5 + k * (1 + i % 7)) % len(CLEAN)] for k in range(30)]
        if i % 4 == 0:
            words[3 + i % 9] = INSULTS[i // 4 % 4]
        rows.append((i, " ".join(words[:15]) + ". " + " ".join(words[15:]) + ".", int(i % 4 == 0)))
    return rows


def tables(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_held_out_and_disguised(spark):
    docs, labels = tables(spark, corpus())
    machine = toxicity.train(docs, labels)
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, machine).collect()}
    held = [(score[i], y) for i, _, y in corpus() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 60 and all((s >= 0.3) == bool(y) for s, y in held)
    for text in ("you i.d.i.o.t there", "such an id-iot", "how stuupid was that", "m o r o n over there", "st*pid weather", "PATHETIC!"):
        assert machine.scores([text])[0] >= 0.3, text
    assert (machine.scores(["the weather was fine", "people walked along", "with th.eir music"]) < 0.3).all()


def test_kernel_equals_the_definition():
    words, marks = ["cat", "c.at", "card", "a", "xyz", "carat"], ["cat", "act", "carat"]
    got = toxicity.SubsequenceKernel(marks)(words)
    own = toxicity.self_kernel(words)

    def plain(s, t, n):
        from itertools import combinations

        total = 0.0
        for i in combinations(range(len(s)), n):
            for j in combinations(range(len(t)), n):
                if all(s[a] == t[b] for a, b in zip(i, j)):
                    total += 0.6 ** (i[-1] - i[0] + j[-1] - j[0] + 2)
        return total

    for a, word in enumerate(words):
        for n in (2, 3):
            assert abs(own[n - 2, a] - plain(word, word, n)) < 1e-5
            for b, mark in enumerate(marks):
                assert abs(got[n - 2, a, b] - plain(word, mark, n)) < 1e-4


def test_odd_texts_and_tables(spark, documents):
    docs, labels = tables(spark, corpus(200))
    machine = toxicity.train(docs, labels)
    odd = [(1, None), (2, ""), (2, ""), (None, "you idiot"), (3, "fine weather " * 30_000 + "idiot"), (4, "x" * 50_000)]
    got = sorted((r["score"] for r in toxicity.scored(documents(odd), machine).collect()))
    assert len(got) == 6 and all(0 <= s <= 1 for s in got) and got[-2] > 0.3 > got[-3]
    assert toxicity.scored(documents([]), machine).count() == 0
    none = toxicity.train(docs, labels.filter("toxic = 0"))
    assert [r["score"] for r in toxicity.scored(documents([(1, "idiot")]), none).collect()] == [0.0]
    assert toxicity.units("A b c! don't  wait") >= {"abc", "don't", "dont", "wait"}
    assert docs.filter(held_out()).count() == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200))


def test_query_is_right_on_held_out_rows(spark, sf_dir):
    got = QUERIES["op9_toxicity"](spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(rows[i]["predicted"], y) for i, y in labels.items() if i in rows and rows[i]["held_out"] and y is not None]
    clean = [p for p, y in held if y == 0]
    assert sum(clean) <= 0.1 * len(clean)


def test_long_words_take_time_in_proportion(spark):
    machine = toxicity.Machine(["stupid", "moron", "idiot"])
    began = time.time()
    machine.signs(["stupid" * 8_400, "x" * 50_000, "".join(chr(0x4E00 + i % 5000) for i in range(50_000))])
    assert time.time() - began < 8
    assert toxicity.stretches("ab" * 30) == [("ab" * 30)[:48], ("ab" * 30)[24:]]
    for size in (49, 72, 73, 500):
        word = "".join(chr(0x4E00 + i) for i in range(size))
        assert set(word) == set("".join(toxicity.stretches(word)))
        assert all(len(s) <= toxicity.LONGEST for s in toxicity.stretches(word))


def test_near_words_count_by_how_thickly_they_stand(spark):
    """A stem that clean documents hold now and then, and toxic ones again and again."""
    endings = [a + b for a in "aeiou" for b in ("n", "r", "st", "lk", "m")]
    rows = []
    for i in range(400):
        words = [CLEAN[(i * 5 + k * (1 + i % 7)) % len(CLEAN)] for k in range(60)]
        for k in range(5 if i % 4 == 0 else i % 3 == 0):
            words[7 + 9 * k] = "grumbl" + endings[(i * 3 + k * 7) % len(endings)]
        rows.append((i, ". ".join([" ".join(words[:30]), " ".join(words[30:])]), int(i % 4 == 0)))
    docs, labels = tables(spark, rows)
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.train(docs, labels)).collect()}
    held = [(score[i] >= 0.3, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(p == bool(y) for p, y in held) >= 0.95 * len(held)


def test_a_documents_table_with_clashing_names(spark):
    rows = corpus(80)
    docs, labels = tables(spark, rows)
    clash = docs.selectExpr("*", "1 as toxic", "'x' as parts", "2 as held_out")
    assert toxicity.scored(clash, toxicity.train(clash, labels)).count() == 80
