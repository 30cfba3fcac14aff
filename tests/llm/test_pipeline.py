"""The stages one after another, with rows of every kind."""

import pytest

import corpus_pipeline
from fieldtally.llm import queries as q
from tests.llm.test_tokens import check_packing

SMALL = "/root/testdata/sf0.001"


def test_stages_filter_and_keep_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", None, 0), (10**6 + 1, None, None, "s", 0), (10**6 + 2, "one two three " * 3, "en", "s", 42), (10**6 + 2, "one two three " * 3, "en", "s", 42)], docs.schema)
    docs = docs.unionByName(odd)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns and 0 < docs.count() <= before
    check_packing(docs.collect(), 4096)
    ids = [r.doc_id for r in docs.where("piece = 0").collect()]
    assert ids.count(10**6 + 2) <= 1


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, name, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    assert stage(spark, docs, SMALL).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 50
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "packing"]


def test_queries_are_registered(spark):
    names = [n.split("_")[0] for n in q.queries()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]


def test_run_against_plain_python(spark, tmp_path):
    """The near-duplicate and packing stages after the classifiers' own decisions, by
    plain loops over a small corpus."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from fieldtally.llm import quality, toxicity
    from tests.llm.test_near_copies import corpus, jaccard_links, roots

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    rows += [(10**6 + k, t, "en", f"s{k % 3}", len(t or "")) for k, t in corpus().items() if k % 2 or k > 199]
    folder = tmp_path / "sf"
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    every = spark.read.parquet(f"{folder}/documents.parquet")
    good = {r.doc_id for r in quality.quality_scores(every, labels).where("quality.predicted = 1").select("row.doc_id").collect()}
    kept = every.where(every.doc_id.isin(list(good)))
    fine = {r.doc_id for r in toxicity.toxicity_scores(kept, labels).where("toxicity.predicted = 0").select("row.doc_id").collect()}
    texts = {r[0]: r[1] for r in rows if r[0] in fine}
    root = roots(texts, jaccard_links(texts)[1])
    left = sorted(k for k in texts if root[k] == k)
    assert 20 < len(left) < len(texts) < len(rows)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.no_truncation()
    tok.no_padding()
    want = {k: len(tok.encode(texts[k] or "", add_special_tokens=False).ids) + 1 for k in left}
    got = corpus_pipeline.run(spark, str(folder)).collect()
    check_packing(got, 4096)
    sizes: dict[int, int] = {}
    for r in got:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == want
    assert len({r.sequence_id for r in got}) <= -(-sum(want.values()) // 4096) + 1
