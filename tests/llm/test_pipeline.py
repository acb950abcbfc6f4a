import os
import subprocess
import sys
from collections import defaultdict

import corpus_pipeline

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert not any(quality.get(i) == 0 for i in ids)
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == ids
    fill = defaultdict(int)
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 4096 and len(fill) == -(-sum(fill.values()) // 4096)


def test_nothing_else_imports_the_subpackage():
    code = (
        "import sys, importlib.util as u; old = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n in ('paddockflow.llm', 'corpus_pipeline') else old(n, *a)\n"
        "import __spark_entry__ as e\n"
        "assert not any(q.startswith('op') and q[2].isdigit() or q == 'pipeline' for q in e.queries())\n"
        "assert set(e.oracle_sql()) <= set(e.queries()) and 'paddockflow.llm' not in sys.modules\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_every_operator_has_one_query():
    import __spark_entry__ as contract

    names = [q.split("_")[0] for q in contract.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
