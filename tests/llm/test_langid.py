from paddockflow.llm import langid
from paddockflow.llm.queries import QUERIES

WORDS = {
    "en": "the and of that with this from they were what there would about which their have been",
    "de": "der und nicht eine auch über wird haben werden können zwischen größe straße müssen",
    "fr": "les des une être très qui dans pour avec était même où français garçon élève",
}


def labelled(spark, n=60):
    rows, number = [], 0
    for lang, words in WORDS.items():
        parts = words.split()
        for i in range(n):
            number += 1
            rows.append((number, " ".join(parts[(i * 7 + k * (1 + i % 5)) % len(parts)] for k in range(60)) + ".", lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    docs = labelled(spark)
    got = langid.identified(docs, langid.train(docs)).withColumn("held", langid.held_out("row.doc_id")).collect()
    held = [r for r in got if r["held"]]
    assert len(held) > 20 and all(r["lang_pred"] == r["row"]["lang"] and 0.5 < r["score"] <= 1 for r in held)


def test_query_accuracy(spark, sf_dir):
    rows = QUERIES["op4_language_id"](spark, sf_dir).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) > 0.9 * len(held)


def test_odd_texts_and_tables(spark, documents):
    docs = labelled(spark)
    network = langid.train(docs)
    odd = [(1, None), (2, ""), (3, "12 34 !!"), (None, WORDS["en"] * 3), (5, WORDS["en"] * 5_000), (5, WORDS["en"] * 5_000)]
    got = [(r["row"]["doc_id"], r["lang_pred"], r["score"]) for r in langid.identified(documents(odd), network).collect()]
    assert sorted((g[1] for g in got)) == ["en"] * 3 + ["und"] * 3
    assert all(s == 0 for _, lang, s in got if lang == "und")
    assert langid.identified(documents([]), network).count() == 0
    none = langid.train(documents([(1, "a text")], lang=None))
    assert [r["lang_pred"] for r in langid.identified(documents([(1, "a text")]), none).collect()] == ["und"]
    only = langid.train(documents([(i, "some text here") for i in range(1, 9)]))
    assert [r["lang_pred"] for r in langid.identified(documents([(1, "a text")]), only).collect()] == ["en"]
    kept = langid.kept(docs.unionByName(spark.createDataFrame([(900, "...", None), (901, None, "en")], docs.schema)))
    assert kept.count() == docs.count() and kept.columns == docs.columns


def test_pair_tables_give_the_same_activations():
    import numpy as np

    network = langid.ByteNetwork(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (3, langid.WINDOW + 3)).astype(np.uint8)
    tables = np.einsum("be,kef->kbf", network.weights["embed"], network.weights["filter"])
    act = sum(tables[k][x[:, k : k + langid.WINDOW]] for k in range(4))
    want = network._softmax(act.max(axis=1) + network.weights["bias"])
    assert np.allclose(network.probabilities(x), want, atol=1e-5)
