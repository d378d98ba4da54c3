"""The pipeline stage by stage against brute force, on the smallest documents and on odd rows."""

import corpus_pipeline
from cohortry.llm import quality
from cohortry.scale import stage

from . import test_decontaminate, test_secrets, test_similarity, test_simhash, test_tokens
from .conftest import FOLDER


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def fingerprint_ties(docs):
    from cohortry.llm.simhash import fingerprint, shingle_hashes

    prints = [fingerprint(shingle_hashes(t or "", 5)) for _, t in docs]
    comp = test_simhash.brute_components(prints)
    return [comp[p] for p in prints]


def one_each(docs):
    """Ids that stay: the smallest of each component of both kinds of ties."""
    by_text = test_similarity.brute(docs)
    ids = [d for d, _ in docs]
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first: dict = {}
    for (d, _), c in zip(docs, fingerprint_ties(docs)):
        for key in (("print", c), ("text", by_text[d])):
            other = first.setdefault(key, d)
            a, b = find(d), find(other)
            parent[max(a, b)] = min(a, b)
    return {d for d in ids if find(d) == d}


def test_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "packing"]
    run = lambda name, df: stage(steps[name](spark, df, FOLDER))

    field = quality.train_lines(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = run("quality rules", docs)
    verdict = {r.doc_id: r.kept for r in quality.judged(docs, field).collect()}
    assert rows(good) == rows(docs.where(docs.doc_id.isin([d for d, k in verdict.items() if k]))) and good.columns == columns

    unique = run("SimHash near-dedup", good)
    texts = [(r.doc_id, r.text) for r in good.collect()]
    assert {r.doc_id for r in unique.collect()} == one_each(texts) and unique.columns == columns

    clean = run("benchmark decontamination", unique)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [(r.doc_id, r.text) for r in unique.collect()]
    held = {d for d, _ in test_decontaminate.brute(texts, items)}
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in texts} - held and clean.columns == columns

    safe = run("secret scans", clean)
    assert safe.columns == columns and safe.count() == clean.count()
    before = {r.doc_id: r.text for r in clean.collect()}
    for r in safe.collect():
        assert ("[SECRET]" in r.text) == bool(test_secrets.all_spans(before[r.doc_id]))
        assert r.n_chars == len(r.text) and (r.text == before[r.doc_id] or "[SECRET]" in r.text)
        assert not test_secrets.base_by_contract(r.text)

    packed = steps["packing"](spark, safe, FOLDER)
    assert test_tokens.check_packing(packed.collect(), [(r.doc_id, r.text) for r in safe.collect()]) < 1.1
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(packed)


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, step in corpus_pipeline.STAGES[:-1]:
            docs = stage(step(spark, docs, FOLDER))
            assert docs.columns == odd_docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
