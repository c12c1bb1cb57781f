"""The pipeline against a brute-force version of its stages on small tables."""

import re

import corpus_pipeline
from arearisk.llm import common as C
from arearisk.llm import tokens, toxicity
from tests.llm import cases
from tests.llm.test_search import brute_contamination, brute_groups, squeezed
from tests.llm.test_tokens import check_packing


def world(spark, tmp_path):
    rows = [(100 + k, cases.prose(200 + k, 40) + (f". you are a nastyword {cases.prose(k, 3)}" if k % 5 == 0 else "")) for k in range(150)]
    passage = cases.prose(7, 30)
    rows += cases.texts() + [(400, cases.prose(301, 30) + "\n" + passage + "\n" + cases.prose(302, 30)), (401, passage), (402, "x nastyword")]
    docs = cases.docs(spark, rows)
    labels = spark.createDataFrame([(i, int("nastyword" in (t or ""))) for i, t in rows if i is not None], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string")
    return rows, cases.folder(spark, tmp_path, docs, labels=labels, benchmark=bench), [(1, passage), (2, None)]


def test_stages_and_run(spark, tmp_path):
    rows, folder, bench = world(spark, tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = C.cut_lineage(stage(spark, docs, folder), name)
        assert docs.columns == columns
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
    # toxicity: what the learned model rejects, by its score
    model = toxicity.train(spark.read.parquet(folder + "/documents.parquet"), spark.read.parquet(folder + "/labels.parquet"))
    score = sorted((str(r.doc_id), r.score < 0.3) for r in toxicity.scores(spark.read.parquet(folder + "/documents.parquet"), model).collect())
    assert sum(ok for _, ok in score) == len(kept["toxicity"])
    assert not any("nastyword" in (t or "") for _, t in kept["toxicity"]) and len(kept["toxicity"]) == sum("nastyword" not in (t or "") for _, t in rows)
    # exact copies: one row of each group
    groups = {}
    for i, t in kept["toxicity"]:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), i is None, i or 0))
    assert sorted((squeezed(t), -len(t or ""), i is None, i or 0) for i, t in kept["exact_dedup"]) == sorted((k, *min(v)) for k, v in groups.items())
    # near copies: the smallest id of each component
    near = {}
    for (i, t), (_, g) in zip(kept["exact_dedup"], brute_groups(kept["exact_dedup"])):
        near.setdefault(g, []).append((i is None, i or 0, t or ""))
    assert sorted((i is None, i or 0) for i, _ in kept["ngram_jaccard_join"]) == sorted(min(v)[:2] for v in near.values())
    # decontamination: clean rows untouched, no passage left
    clean = [x for x, c in zip(kept["ngram_jaccard_join"], brute_contamination(kept["ngram_jaccard_join"], bench)) if not c[5]]
    left = kept["benchmark_decontamination"]
    assert all(x in left for x in clean) and not any(c[5] for c in brute_contamination(left, bench))
    assert {i for i, _ in left} >= {400} and 401 not in {i for i, _ in left}
    # packing of what is left, and the whole run
    got = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    check_packing(got, left, tokens.encoder(tokens.tokenizer_path()))


def test_run_without_rows(spark, tmp_path):
    folder = cases.folder(spark, tmp_path, cases.docs(spark, []), labels=spark.createDataFrame([], "doc_id long, toxic int"),
                          benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    home = Path(corpus_pipeline.__file__).parent
    for p in (home / "arearisk").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(from|import) .*\bllm\b", p.read_text(), re.M), p


def test_batches_of_long_rows_are_small_and_workers_give_memory_back(spark, tmp_path):
    """A batch holds about ``BATCH_BYTES`` at most, however long its rows, and a task ends with ``give_back``."""
    import pyarrow as pa

    from arearisk.llm import common as C

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    rows = spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 20000) AS text")
    assert max(r.n for r in C.map_arrow(rows, sizes, "n long").collect()) < 1.5 * C.BATCH_BYTES
    C.give_back()
