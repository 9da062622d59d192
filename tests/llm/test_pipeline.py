import re
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from helpers_llm import SMOKE, odd_docs, words
from test_secrets import brute as secret_spans
from test_simhash import fingerprint, groups

from sparkmarts.llm.common import materialise, table
from sparkmarts.llm.line_crf import quality_scores, train

ROOT = Path(__file__).resolve().parents[2]


def test_every_stage_against_brute_force(spark):
    docs = table(spark, SMOKE, "documents")
    items = [r.text for r in table(spark, SMOKE, "benchmark").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SMOKE), name)
        before, after = {r.doc_id: r for r in docs.collect()}, out.collect()
        if name != "packing":
            assert out.columns == columns
        if name == "quality":
            scored = quality_scores(docs, train(docs, table(spark, SMOKE, "labels")), keep=["doc_id"]).collect()
            assert {r.doc_id for r in after} == {r.doc_id for r in scored if r.score >= 0.7}
        elif name == "near_dedup":
            fps = {i: fingerprint(r.text) for i, r in before.items()}
            group = groups(fps.values())
            low = {}
            for i in sorted(fps):
                low.setdefault(group[fps[i]], i)
            assert sorted(r.doc_id for r in after) == sorted(low.values())
        elif name == "decontaminate":
            grams = set()
            for t in items:
                w = words(t)
                n = min(10, len(w))
                grams |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
            dirty = lambda t: any(tuple(w[j : j + n]) in grams for w in [words(t)] for n in {*map(len, grams)} for j in range(len(w)))
            assert {r.doc_id for r in after} == {i for i, r in before.items() if not dirty(r.text)}
        elif name == "secrets":
            assert {r.doc_id for r in after} == set(before)
            for r in after:
                old = before[r.doc_id]
                assert not secret_spans(r.text or "") and r.n_chars == len(r.text)
                assert (r.text == old.text) == (not secret_spans(old.text))
        else:
            whole = {}
            for r in sorted(after, key=lambda r: (r.doc_id, r.segment)):
                whole[r.doc_id] = whole.get(r.doc_id, "") + r.text
            assert whole == {i: r.text for i, r in before.items()}
        docs = out
    assert corpus_pipeline.run(spark, SMOKE).count() == docs.count()


def test_stages_survive_odd_rows(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert materialise(stage(spark, docs.limit(0), SMOKE), "empty").count() == 0
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert materialise(stage(spark, docs, SMOKE), "odd").count() > 0


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "sparkmarts").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"sparkmarts\.llm|corpus_pipeline", p.read_text()), p


def test_entry_without_the_subpackage(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'sparkmarts.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and e.oracle_sql() and not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
