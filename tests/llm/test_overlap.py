import corpus_pipeline
import numpy as np

from paddockflow.llm import overlap, simhash


def plain(text, words=5):
    parts = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def edited(words, places):
    return " ".join(f"edit{i}" if i in places else w for i, w in enumerate(words))


def test_similarity_is_exact():
    draw = np.random.default_rng(1)
    texts = [" ".join(f"W{k}" for k in draw.integers(0, 3, int(n))) for n in draw.integers(0, 40, 30)] + ["", "one TWO"]
    for a in texts:
        for b in texts:
            x, y = plain(a), plain(b)
            want = len(x & y) / len(x | y) if x | y else 1.0
            assert abs(overlap.similarity(overlap.shingles(a), overlap.shingles(b)) - want) < 1e-12


def test_stage_drops_near_copies_that_two_bits_miss(spark, documents):
    draw = np.random.default_rng(2)
    rows, near, far = [], [], []
    for n in range(60):
        words = [f"w{k}" for k in draw.integers(0, 10_000, 300)]
        rows.append((10 * n, " ".join(words)))
        # each edit in the middle changes five shingles
        near.append((10 * n + 1, edited(words, {50, 110, 170, 230, 290})))
        far.append((10 * n + 2, edited(words, set(range(10, 300, 25)))))
    apart = [bin(simhash.fingerprint(a[1]) ^ simhash.fingerprint(b[1])).count("1") for a, b in zip(rows, near, strict=True)]
    assert sum(d > 2 for d in apart) > 30
    got = corpus_pipeline.near_dedup(spark, documents(rows + near + far), "")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i, _ in rows + far)


def test_rows_of_all_sorts(documents):
    words = [f"w{i}" for i in range(400)]
    long, other = " ".join(words), " ".join(f"o{i}" for i in range(400))
    rows = [
        (5, edited(words, {200})), (3, long), (3, long), (3, other), (4, long.upper()), (9, None), (8, ""), (7, " \n"),
        (None, long), (None, "nameless text"), (1, "alone in here"),
    ]
    kept = overlap.keep_one(documents(rows))
    assert kept.columns == documents(rows).columns
    found = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in kept.collect())
    assert found == [(-1, "nameless text"), (1, "alone in here"), (3, other), (3, long), (7, " \n")]
    assert overlap.keep_one(documents([])).count() == 0


def test_a_large_group_gives_few_pairs(documents):
    draw = np.random.default_rng(4)
    words = [f"w{k}" for k in range(300)]
    rows = [(n, edited(words, {int(k) for k in draw.integers(0, 300, 2)})) for n in range(300)]
    assert overlap.candidates(documents(rows)).count() < 12 * len(rows)
    assert [r["doc_id"] for r in overlap.keep_one(documents(rows)).collect()] == [0]


def test_count_filter_keeps_what_is_alike(documents):
    draw = np.random.default_rng(6)
    words = [f"w{k}" for k in draw.integers(0, 10_000, 600)]
    near, far = edited(words, set(range(5, 600, 60))), edited(words, set(range(5, 600, 12)))
    prints = [np.frombuffer(overlap.long_print(overlap.minima(overlap.shingles(t))), np.uint8) for t in (" ".join(words), near, far)]
    shared = [int((prints[0] == p).sum()) for p in prints]
    assert overlap.least_shared(0.8) == 46 and shared[0] == overlap.PARTS and shared[1] >= 46 > shared[2]
    rows = documents([(1, " ".join(words)), (2, near), (3, far)])
    prints = overlap._prints(rows, "text", 5).cache()
    all_pairs = prints.select("version").toDF("a").crossJoin(prints.select("version").toDF("b")).filter("a < b")
    assert all_pairs.count() == 3 and overlap.counted(all_pairs, prints, 0.8).count() == 1


def test_simhash_links_are_candidates(documents, monkeypatch):
    words = [f"w{k}" for k in np.random.default_rng(7).integers(0, 10_000, 3000)]
    near = edited(words, {1500})
    assert bin(simhash.fingerprint(" ".join(words), 5) ^ simhash.fingerprint(near, 5)).count("1") <= overlap.BITS
    rows = documents([(1, " ".join(words)), (2, near)])
    monkeypatch.setattr(overlap, "_first_pairs", lambda lists: lists.select(*overlap._ordered("version", "version")).limit(0))
    assert overlap.candidates(rows).count() == 1


def test_a_link_hidden_by_the_first_text_of_every_list_is_found(documents, monkeypatch):
    draw = np.random.default_rng(8)
    words = [f"w{k}" for k in draw.integers(0, 10_000, 400)]
    # both are unlike the first text (0.74 and 0.73 of their shingles) and alike (0.98)
    one = edited(words, set(range(20, 400, 33)))
    two = one.replace(words[390], "other")
    texts = [" ".join(words), one, two]
    sets = [plain(t) for t in texts]
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in ((0, 1), (0, 2), (1, 2))]
    assert max(alike[:2]) < 0.8 <= alike[2]

    def with_the_first_row(lists):
        first = lists.filter("version = " + str(rows.select(overlap._version("text")).first()[0])).select(
            "band", "key", overlap.F.col("version").alias("first"))
        return lists.join(first, ["band", "key"]).filter("version <> first").select(*overlap._ordered("version", "first"))

    rows = documents([(i, t) for i, t in enumerate(texts)])
    monkeypatch.setattr(overlap, "_first_pairs", with_the_first_row)
    monkeypatch.setattr(overlap, "_bit_pairs", lambda prints: prints.select(*overlap._ordered("version", "version")).limit(0))
    assert sorted(r["doc_id"] for r in overlap.keep_one(rows).collect()) == [0, 1]


def changed_in_places_of_their_own(draw, words, n, edits):
    texts = []
    for i in range(n):
        places = set((7 * draw.choice(len(words) // 7, edits, replace=False) + draw.integers(0, 2)).tolist())
        texts.append(" ".join(f"edit{i}x{k}" if k in places else w for k, w in enumerate(words)))
    return texts


def test_prefixes_of_alike_sets_meet():
    draw = np.random.default_rng(9)
    for size in (1, 2, 5, 9, 40, 41, 200, 1000):
        for _ in range(60):
            base = draw.permutation(3 * size)[:size]
            gone, new = draw.integers(0, size // 4 + 1, 2)
            one, two = set(base.tolist()), set(base[gone:].tolist()) | set(range(3 * size, 3 * size + int(new)))
            alike = len(one & two) >= 0.8 * len(one | two)
            keys = [
                {(*((own, other) if s is one else (other, own)), k) for own, other, n in overlap.prefixes(len(s), 0.8) for k in sorted(s)[:n]}
                for s in (one, two)
            ]
            assert keys[0] & keys[1] or not alike


def test_many_unlike_texts_in_one_list_give_few_pairs(documents, monkeypatch):
    draw = np.random.default_rng(10)
    texts = changed_in_places_of_their_own(draw, [f"w{k}" for k in range(350)], 250, 10)
    sets = [plain(t) for t in texts]
    assert max(len(a & b) / len(a | b) for a, b in zip(sets, sets[1:])) < 0.8
    texts.append(texts[7].replace("w300", "other").replace("w301", "other"))
    seen, counted = [], overlap.counted

    def counting(pairs, prints, least):
        seen.append(pairs.count())
        return counted(pairs, prints, least)

    monkeypatch.setattr(overlap, "MOST", 8, raising=False)
    monkeypatch.setattr(overlap, "counted", counting)
    assert sorted(r["doc_id"] for r in overlap.keep_one(documents(list(enumerate(texts)))).collect()) == list(range(250))
    assert sum(seen) < 20 * len(texts)  # of 31,375


def test_links_inside_large_lists_are_found(documents, monkeypatch):
    draw = np.random.default_rng(11)
    texts = changed_in_places_of_their_own(draw, [f"w{k}" for k in range(350)], 60, 10)
    texts += [" ".join(t.split()[:-n]) for n, t in enumerate(texts[:30], 1)]
    sets = [plain(t) for t in texts]
    alike = [len(sets[n] & sets[60 + n]) / len(sets[n] | sets[60 + n]) for n in range(30)]
    assert min(alike) >= 0.8
    monkeypatch.setattr(overlap, "MOST", 1)
    monkeypatch.setattr(overlap, "_first_pairs", lambda lists: lists.select(*overlap._ordered("version", "version")).limit(0))
    monkeypatch.setattr(overlap, "_bit_pairs", lambda prints: prints.select(*overlap._ordered("version", "version")).limit(0))
    assert sorted(r["doc_id"] for r in overlap.keep_one(documents(list(enumerate(texts)))).collect()) == list(range(60))
