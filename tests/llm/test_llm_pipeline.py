import os
import subprocess
import sys

import corpus_pipeline
import pytest
from llm_helpers import by_value
from test_llm_decontamination import brute as leaks
from test_llm_pieces import MODEL, digest
from test_llm_simhash import brute as components
from test_llm_substring import brute as repeats

from visitscope.llm import toxicity
from visitscope.llm.common import read_table, staged
from visitscope.llm.pipeline import run_stages

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, monkeypatch):
    """Each stage judged on its own input."""
    import sentencepiece

    monkeypatch.setattr(toxicity, "TREES", 5)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = read_table(spark, SF, "documents")
    items = [tuple(r) for r in read_table(spark, SF, "benchmark").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash near-dedup", "substring dedup", "decontamination", "piece encoding"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        rows = [(i, r.text) for i, r in before.items()]
        docs = staged(stage(spark, docs, SF), "test-stage")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(after)
        if k < 4:
            assert docs.columns == COLUMNS
        if k == 0:
            scored = toxicity.scores(read_table(spark, SF, "documents"), read_table(spark, SF, "labels")).collect()
            assert set(after) == {r.doc_id for r in scored if not r.predicted}
        elif k == 1:
            assert set(after) == {c for _, _, c in components(rows)}
        elif k == 2:
            import hashlib
            want = {i: h for i, _, _, h in repeats(rows, 50)}
            assert {i: hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() for i, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif k == 3:
            assert set(after) == set(before) - {i for i, *_ in leaks(rows, items)}
        else:
            assert by_value(docs.collect()) == by_value([(i, *digest(library, t)) for i, t in rows])
        if k in (1, 3):
            assert all(after[i] == before[i] for i in after)


def test_run_writes_each_stage_and_reads_it_again(spark):
    """The loop of `run` with cheap stages: every stage sees what the one before kept, read from a table."""
    seen = []

    def keep(spark, docs, sf_dir):
        seen.append((docs.count(), docs.inputFiles()[0].split("/")[-2]))
        return docs.where("doc_id % 2 = 0") if len(seen) == 1 else docs.where("doc_id % 3 = 0")

    found = run_stages(spark, SF, [("a", keep), ("b", keep)])
    assert [n for n, _ in seen] == [200, 100]
    assert seen[1][1].startswith("pipeline-1-")
    assert sorted(r.doc_id for r in found.collect()) == list(range(0, 200, 6))
    assert corpus_pipeline.run.__doc__ and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("missing", [False, True])
def test_entry_stands_without_the_operators(missing):
    block = "sys.modules['corpus_pipeline'] = None; " if missing else ""
    code = f"import sys; {block}import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, len(e.oracle_sql()))"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert (out[1] == "True") is not missing


def test_tables_of_finished_stages_are_dropped(spark):
    import glob

    from visitscope.llm.common import shared_dir, staging

    def twice(spark, docs, sf_dir):
        once = staged(docs.where("doc_id % 2 = 0"), "twice")
        return once.unionAll(once)

    def last(spark, docs, sf_dir):
        return docs.where("doc_id < 50")

    folder = shared_dir(spark).removeprefix("file:") + "/visitscope/*"
    before = set(glob.glob(folder))
    with staging() as written:
        out = run_stages(spark, SF, [("a", twice), ("b", twice), ("c", last)])
    assert len(written) == 4 and out.count() == 4 * 25
    assert {p.removeprefix("file:") for p in written[-1:]} == set(glob.glob(folder)) - before
