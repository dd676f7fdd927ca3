from collections import defaultdict

import corpus_pipeline
from smslens.llm.common import stored
from smslens.llm.quality import quality_scores
from tests.llm import test_decontamination, test_jaccard, test_line_dedup, test_packing


def test_each_stage_matches_its_plain_version(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], data)))
        assert kept[-1].columns == columns and kept[-1].schema == docs.schema
    texts = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    scores = {r.doc_id: r.predicted for r in quality_scores(docs, spark.read.parquet(f"{data}/labels.parquet")).collect()}
    assert set(texts[1]) == {i for i, p in scores.items() if p} and all(texts[0][i] == t for i, t in texts[1].items())
    lines, _ = test_line_dedup.plain(list(texts[1].items()))
    assert texts[2] == {i: t for i, (_, removed, t) in lines.items() if not removed or t.strip()}
    groups = test_jaccard.brute(list(texts[2].items()), 5, 80)
    assert set(texts[3]) == {i for i, (_, least) in groups.items() if i == least}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    tokens = {i: set(zip(*[(w := test_decontamination.tokens(t))[k:] for k in range(5)], strict=False)) for i, t in items}
    near = {d: [(i, t) for i, t in items if tokens[i] & set(zip(*[(w := test_decontamination.tokens(x))[k:] for k in range(5)], strict=False))] for d, x in texts[3].items()}
    leaks = {d for d, found in near.items() if found and test_decontamination.want([(d, texts[3][d])], found)}
    assert set(texts[4]) == set(texts[3]) - leaks
    got = corpus_pipeline.run(spark, data).collect()
    test_packing.check(list(texts[4].items()), got)
    whole = defaultdict(int)
    for r in got:
        whole[r.doc_id] += len(r.ids)
    assert all(r.doc_tokens == whole[r.doc_id] for r in got)


def test_stages_take_nulls_empty_tables_and_clashing_columns(spark, data, make):
    rows = [(None, "five words and two more"), (3, None), (4, ""), (5, "five words and two more"), (5, "five words and two more"), (6, "x " * 50_000)]
    for table in (make([], ["gone", "token"]), make(rows, ["rk", "gone", "token", "class", "norm", "score"])):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, data))
            assert docs.columns == table.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data)
        assert (pieces.count() > 0) == (docs.count() > 0)
