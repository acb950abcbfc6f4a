from checking import compare, connect
from paddockflow.llm import licenses
from paddockflow.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark, sf_dir):
    good, message = compare(QUERIES["op10_license_scan"](spark, sf_dir), connect(sf_dir), ORACLES["op10_license_scan"])
    assert good, message


def test_phrases_and_templates(documents):
    rows = [
        (1, "Released under the MIT\n License. And under the mit license"), (2, None), (3, ""), (4, "é-under the MIT licensed"),
        (5, "CC BY-NC 4.0, cc by nc"), (5, "CC BY-NC 4.0, cc by nc"), (None, "Apache License, Version 2.0"),
        (6, "The work this licensed under is GNU the General Public version 3 License today"), (7, "word " * 30_000 + "cc by nc"),
        (8, "All rights are not reserved"), (9, "This program is free software. You can redistribute it."),
    ]
    got = {}
    for r in licenses.scanned(documents(rows)).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert got == {
        1: [(10, 2, 1, 6, "mit", "mit", 1.0)], 2: [(0, 0, None, None, "", "", 0.0)], 3: [(0, 0, None, None, "", "", 0.0)],
        4: [(5, 0, None, None, "", "", 0.0)], 5: [(8, 2, 0, 5, "cc-by-nc", "cc-by-nc", 1.0)] * 2,
        None: [(5, 1, 0, 0, "apache-2", "apache-2", 1.0)], 6: [(14, 0, None, None, "", "gpl-3", 1.0)],
        7: [(30_003, 1, 30_000, 30_000, "cc-by-nc", "cc-by-nc", 1.0)], 8: [(5, 0, None, None, "", "all-rights-reserved", 1.0)],
        9: [(9, 0, None, None, "", "", 0.0)],
    }
    assert licenses.scanned(documents([])).count() == 0


def test_join_equals_every_pair(documents):
    known = licenses.template_words(licenses.TEMPLATES)
    texts = {}
    for n, (_, words) in enumerate(known):
        for drop in range(4):
            texts[10 * n + drop] = "intro line\n" + " ".join(words[drop:] + ["more", "words"]) + "\nend"
    for threshold in (0.75, 0.9, 1.0):
        got = licenses.matches(documents(list(texts.items())), threshold=threshold).collect()
        found = sorted((r["doc_id"], r["block"], r["label"], round(r["containment"], 9)) for r in got)
        want = []
        for doc, text in texts.items():
            lines = text.split("\n")
            for block in range(len(lines)):
                for label, words in known:
                    size = licenses.SHORT_LINES if len(words) <= licenses.SHORT else licenses.LONG_LINES
                    held = len(set(words) & set(" ".join(lines[block : block + size]).split())) / len(words)
                    if held >= threshold - 1e-12:
                        want.append((doc, block, label, round(held, 9)))
        assert found == sorted(want)


def test_plan_is_native(documents):
    plan = licenses.scanned(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_wrapped_and_commented_notices(documents):
    """Every template over several lines, as plain text and in a source comment."""
    rows, want = [], {}
    for n, (label, wording) in enumerate(licenses.TEMPLATES):
        words = wording.split()
        wrapped = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
        for k, (mark, lines) in enumerate((("", wrapped), (" * ", wrapped), ("// ", [" ".join(words[:2]), " ".join(words[2:])]))):
            if len(lines) > 1:
                rows.append((10 * n + k, "\n".join(["intro", *(mark + line for line in lines), "end"])))
                want[10 * n + k] = label
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scanned(documents(rows)).collect()}
    assert len(got) > 30 and all(want[i] in got[i] for i in want)


def test_each_row_has_its_own_labels(documents):
    notice = licenses.TEMPLATES[13][1]
    rows = [(None, notice), (None, "none here"), (1, notice), (1, "nor here"), (1, notice), (2, "x\n" * 2000 + notice)]
    got = [(r["doc_id"], r["labels"]) for r in licenses.scanned(documents(rows)).collect()]
    assert sorted(got, key=repr) == sorted(
        [(None, "gpl-3"), (None, ""), (1, "gpl-3"), (1, ""), (1, "gpl-3"), (2, "gpl-3")], key=repr
    )
