from collections import Counter

from checking import compare, connect
from paddockflow.llm import quality
from paddockflow.llm.queries import ORACLES, QUERIES

PROSE = "\n".join(f"Line {i} has word{i} other{i} and more{i} text{i} here." for i in range(10))


def plain_repeats(text):
    words = (text or "").encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    return len({p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)})


def test_query_equals_sql(spark, sf_dir):
    good, message = compare(QUERIES["op2_quality_rules"](spark, sf_dir), connect(sf_dir), ORACLES["op2_quality_rules"])
    assert good, message


def test_repeats_and_odd_texts(documents):
    texts = [
        None, "", "   \n\t", "a", "a b c", "a b c a b c", "a a a a", "x y z q x y z x y", "a\n\na\n", PROSE,
        "w " * 30_000, "   ", "\n".join(["same line here."] * 5),
    ]
    got = {r["row"]["doc_id"]: r for r in quality.measured(documents(list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        assert got[i]["n_words"] == len(words)
        assert got[i]["word_chars"] == sum(len(w.decode()) for w in words)
        assert got[i]["n_repeat_words"] == plain_repeats(text)
        assert got[i]["n_dup_lines"] == len(lines) - len(set(lines))
        assert got[i]["clean_text"] == text


def test_lines_that_fail(documents):
    junk = {
        "shouting": "BUY!! NOW!! OR!! NEVER!!", "menu": "Home | News | Sport | Contact", "symbols": "a%%% b*** c### d&&&",
        "boilerplate": "All rights reserved.",
    }
    rows = [(i, PROSE + "\n" + line) for i, line in enumerate(junk.values())] + [(9, PROSE)]
    got = {r["row"]["doc_id"]: r for r in quality.measured(documents(rows)).collect()}
    assert all(r["clean_text"] == PROSE and r["kept"] for r in got.values())
    lost = [(1, "\n".join([junk["menu"]] * 20 + [PROSE])), (2, PROSE), (2, PROSE), (None, PROSE), (3, "too short."), (4, None)]
    kept = quality.cleaned(documents(lost))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 2]
    assert kept.columns == documents(lost).columns
    assert {r["n_chars"] for r in kept.collect()} == {len(PROSE)}
    assert quality.cleaned(documents([])).count() == 0


def test_plan_is_native_and_has_no_shuffle(documents):
    plan = quality.measured(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Python", "Arrow", "Pandas"))
