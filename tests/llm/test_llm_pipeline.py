"""Every stage of the pipeline against plain Python on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from test_llm_lines import expected as deduped
from test_llm_mixing import WORD, targets
from test_llm_pieces import LIBRARY
from test_llm_quality_rules import counts
from test_llm_superminhash import brute_force

from tidemark.llm import quality_rules
from tidemark.llm.common import saved


def test_stages(spark, sf, docs_of, edge_rows):
    raw = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs_of([(i if i is None else i + 10**6, *r) for i, *r in edge_rows])
    docs = raw.unionByName(extra.select(raw.columns))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rules = quality_rules.fit(docs, labels)
    assert rules
    steps = []
    for _, stage in pipeline.STAGES:
        before = docs.collect()
        docs = saved(stage(spark, docs, sf), "stage")
        steps.append((before, docs.collect()))
        if stage is not pipeline.sentencepiece:
            assert tuple(docs.columns) == pipeline.COLUMNS
    quality, lines, near, mixed, coded = steps

    verdicts = quality_rules.judged(
        spark.createDataFrame(quality[0], raw.schema), rules, "text", ["doc_id", "text"], "__q_").collect()
    for r in verdicts:
        c = counts(r.text)
        assert r["__q_base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
    assert Counter(str((r.doc_id, r.text)) for r in verdicts if r["__q_kept"]) == Counter(
        str((r.doc_id, r.text)) for r in quality[1])
    assert 0 < len(quality[1]) < len(quality[0])

    want = deduped([(r.doc_id, r.text) for r in lines[0]])
    assert sorted(((r.doc_id, r.text) for r in lines[1]), key=str) == sorted(((w[0], w[3]) for w in want), key=str)
    assert all(r.n_chars == len(r.text) for r in lines[1])

    component = brute_force([(r.doc_id, r.text) for r in near[0]], 5, 80)
    kept = {i for i, c in component.items() if i == c}
    assert {r.doc_id for r in near[1]} - {None} == kept
    assert Counter(r.doc_id for r in near[1])[None] == Counter(r.doc_id for r in near[0])[None]
    assert len(near[1]) == len(kept) + Counter(r.doc_id for r in near[0])[None]

    sizes, taken, own = Counter(), Counter(), Counter()
    for r in mixed[0]:
        sizes[r.source] += len(WORD.findall(r.text))
        own[r.doc_id] += len(WORD.findall(r.text))
    for r in mixed[1]:
        taken[r.source] += len(WORD.findall(r.text))
    goal = targets(sizes, pipeline.MIX["weights"], pipeline.MIX["share"], pipeline.MIX["most_repeats"])
    assert all(abs(taken[s] - goal[s]) <= 1.5 * pipeline.MIX["block_words"] for s in sizes)
    words = Counter()
    for r in mixed[1]:
        words[r.doc_id] += len(WORD.findall(r.text))
    assert all(words[i] <= 2 * own[i] for i in words)

    texts = Counter((str(r.doc_id), tuple(LIBRARY.encode(r.text, add_eos=True))) for r in coded[0])
    assert Counter((str(r.doc_id), tuple(r.ids)) for r in coded[1]) == texts


def test_different_texts_under_one_id(spark, sf, docs_of):
    """A text goes for what it resembles itself, not for what shares its id."""
    prose = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(5)]
    rows = [(1, prose[0]), (2, prose[1]), (2, prose[0] + " more"), (2, prose[1]), (3, prose[2]), (3, prose[3]),
            (4, prose[3]), (None, prose[0]), (None, prose[0])]
    docs = docs_of([(i, t, "en", "s") for i, t in rows]).select(*pipeline.COLUMNS)
    got = Counter((r.doc_id, r.text) for r in pipeline.near_dedup(spark, docs, sf).collect())
    kept = {t: [i for i, x in got if x == t and i is not None] for t in dict(got.keys()).values()}
    assert got[(None, prose[0])] == 2 and got[(1, prose[0])] == 1 and (2, prose[0] + " more") not in got
    assert got[(2, prose[1])] == 1 and got[(3, prose[2])] == 1
    assert len(kept[prose[3]]) == 1  # of documents 3 and 4


def test_empty_tables(spark, tmp_path, sf):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_repeats(spark, sf):
    first, second = (sorted(map(str, pipeline.run(spark, sf).collect())) for _ in range(2))
    assert first == second and first
