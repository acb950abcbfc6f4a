import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from paddockflow.llm import packing
from paddockflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, texts, capacity):
    tokenizer, by_doc, sequences = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        parts = [ids[a : a + capacity] for a in range(0, len(ids), capacity)]
        want = [(k, k * capacity, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(parts)]
        assert sorted(by_doc[doc]) == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query_packs_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = QUERIES["op3_best_fit_packing"](spark, sf_dir).collect()
    used = check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, 4096)
    assert used == -(-sum(r["length"] for r in rows) // 4096)  # the volume bound: no packing has fewer


def test_small_pools_exchange_documents(documents):
    draw = np.random.default_rng(1)
    texts = {i: " ".join(["the"] * int(draw.integers(0, 45))) for i in range(600)}
    frame = documents(list(texts.items()))
    first = packing.packed(frame, PATH, capacity=64, pool_tokens=200, rounds=0).collect()
    later = packing.packed(frame, PATH, capacity=64, pool_tokens=200, rounds=6).collect()
    before, after = check(first, texts, 64), check(later, texts, 64)
    lengths, counts = np.unique([r["length"] for r in later], return_counts=True)
    assert packing.lower_bound(lengths, counts, 64) <= after < before


def test_texts_of_all_sorts(documents):
    texts = {
        1: None, 2: "", 3: " \n", 4: "x" * 3000, 5: "Don't STOP... 12.5%!!", 6: "İstanbul ΣΑΣ é   x\x1fy",
        7: "<|endoftext|> a<|startoftext|>b", 8: "á. b̈, ½. ² x². 中文, 中文。.", 9: "̇ . ,, 's 'll we'll!",
    }
    rows = packing.packed(documents(list(texts.items())), PATH, capacity=128).collect()
    check(rows, texts, 128)
    assert packing.packed(documents([]), PATH).count() == 0
    twice = packing.packed(documents([(1, "a b"), (1, "a b"), (None, "c")]), PATH).collect()
    assert len(twice) == 3 and len({r["sequence_id"] for r in twice}) == 1


def best(lengths, capacity):
    """Fewest bins by trying every assignment."""
    for n in range(1, len(lengths) + 1):
        for places in itertools.product(range(n), repeat=len(lengths)):
            fill = [0] * n
            for place, length in zip(places, lengths):
                fill[place] += length
            if max(fill) <= capacity:
                return n


@pytest.mark.parametrize("seed", range(12))
def test_bounds_are_below_the_optimum(seed):
    draw = np.random.default_rng(seed)
    lengths = np.sort(draw.integers(1, 11, 6))[::-1]
    some, counts = np.unique(lengths, return_counts=True)
    bins, offsets = packing.best_fit_decreasing(lengths, 10)
    assert packing.lower_bound(some, counts, 10) <= best(lengths.tolist(), 10) <= bins.max() + 1
    assert packing.lower_bound(np.array([6]), np.array([5]), 10) == 5  # beyond the volume


def test_words_in_use_stay_and_others_go(monkeypatch):
    learned = []
    learn = packing.WordTokenizer._learn
    monkeypatch.setattr(packing.WordTokenizer, "_learn", lambda self, words: (learned.extend(words), learn(self, words))[1])
    tokenizer, inner = packing.WordTokenizer(PATH, remembered=100), Tokenizer.from_file(PATH)
    for i in range(60):
        text = " ".join(["often", "again.", *(f"w{i}x{k}" for k in range(20))])
        assert tokenizer.encode(pa.array([text])) == [np.array(inner.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
        assert len(tokenizer.known) + len(tokenizer.before) <= 100 + 2 * 24
    assert [learned.count(w) for w in (b"often", b"again", b".")] == [1, 1, 1]
