import base64
import hashlib
import time

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from paddockflow.llm import bpe
from paddockflow.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids_of(text):
    return np.array(REFERENCE.encode_ordinary(text), "<u4").tobytes()


def test_query_round_trip(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_byte_bpe_round_trip"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ids_of(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text("aab \n'", max_size=60), max_size=5))
def test_any_text(texts):
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    codes = encoder.encode(texts)
    assert codes == [ids_of(t) for t in texts]
    assert [encoder.decode(c) for c in codes] == [t.encode() for t in texts]


def test_one_by_one_where_a_merge_can_lower_the_rank():
    # "bc" is never met: c only arises late, so "ab" + "c" makes a token of a lower rank
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"abxy": 256, b"ab": 257, b"xy": 258, b"abab": 259, b"ba": 260}
    merges = bpe.Merges(ranks)
    reference = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    words = ["abxyabxy", "ababab", "baab", "xyab", "aaaa", "bababa", "abxyba"]
    got = merges.replay([w.encode() for w in words])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [reference.encode_ordinary(w) for w in words]


def test_texts_of_all_sorts(documents):
    rows = [(1, None), (2, ""), (3, "a" * 5000), (3, "a" * 5000), (None, "x  y\n\n z"), (4, "naïve 中文 🙂")]
    got = bpe.encoded(documents(rows), PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        text = {1: "", 2: "", 3: "a" * 5000, None: "x  y\n\n z", 4: "naïve 中文 🙂"}[r["doc_id"]]
        assert np.array(r["ids"], "<u4").tobytes() == ids_of(text) and bytes(r["decoded"]) == text.encode()
    assert bpe.encoded(documents([]), PATH, public_tokenizers.PATTERN, digest=True).count() == 0


def test_long_pieces_take_time_in_proportion():
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    encoder.encode(["warm up"])
    began = time.time()
    for word in ("the", "ab", "a", "xyzzy", "çé"):
        text = word * 20_000
        assert encoder.encode([text]) == [ids_of(text)]
    assert encoder.encode(["the" * 100_000 + " cat"])[0][-4:] == ids_of(" cat")
    assert time.time() - began < 20


@settings(max_examples=100, deadline=None)
@given(st.text("thea", min_size=30, max_size=400))
def test_crowded_words_are_finished_by_themselves(text):
    assert bpe.Encoder(PATH, public_tokenizers.PATTERN).encode([text, text[3:]]) == [ids_of(text), ids_of(text[3:])]
