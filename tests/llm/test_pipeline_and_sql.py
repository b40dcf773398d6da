import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import compare, connect
from marketloom.llm import mixing, near_dedup, pii
from marketloom.llm.queries import ORACLE, QUERIES
from marketloom.sources.driver_tables import table
from tests.conftest import SF_DIR
from tests.llm.test_text_operators import brute_components, brute_contamination


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    outcome = compare(spark, connect(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR)
    assert outcome.startswith("ok"), outcome


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    first = corpus_pipeline.drop_toxic(spark, docs, SF_DIR)
    assert first.columns == columns and 0.8 * docs.count() < first.count() < docs.count()
    first = spark.createDataFrame(first.collect(), docs.schema)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in first.collect()]
    second = corpus_pipeline.drop_near_copies(spark, first, SF_DIR)
    kept = {r[0] for r in brute_components(rows) if r[3]}
    assert {r["doc_id"] for r in second.collect()} == kept and second.count() == len(kept) and second.columns == columns
    second = spark.createDataFrame(second.collect(), docs.schema)
    rows = [r for r in rows if r[0] in kept]
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    third = corpus_pipeline.drop_contaminated(spark, second, SF_DIR)
    clean = {r[0] for r in brute_contamination(rows, items) if not r[5]}
    assert {r["doc_id"] for r in third.collect()} == clean and third.columns == columns
    third = spark.createDataFrame(third.collect(), docs.schema)
    fourth = corpus_pipeline.mask_personal_data(spark, third, SF_DIR)
    assert fourth.columns == columns and fourth.count() == len(clean)
    assert not any(pii.base_spans(r["text"] or "") for r in fourth.collect())
    fourth = spark.createDataFrame(fourth.collect(), docs.schema)
    fifth = corpus_pipeline.mix_sources(spark, fourth, SF_DIR)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(fourth).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in fifth.groupBy("doc_id").count().collect()} == copies


def test_stages_take_odd_rows_and_clashing_names(spark, documents, odd_rows):
    docs = documents(odd_rows)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert set(docs.columns) <= set(out.columns) and out.count() > 0
        assert out.where("hash <> 'extra'").count() == 0
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR)
    assert kept.where("doc_id = 11").count() == 1 and kept.where("doc_id is null").count() == 1
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
    assert near_dedup.components(docs).count() == len(odd_rows)


def test_helper_names_of_the_mix_may_be_columns_of_the_documents(spark, documents):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(5 + i % 7)), "ab"[i % 2]) for i in range(40)]
    made = ["epochs", "below_0", "need_0", "used_1", "need", "weight", "place", "carried_0", "__copies", "__hash", "__row", "__text", "copies", "target"]
    docs = documents(rows)
    plain = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    for name in made:
        docs = docs.withColumn(name, F.lit(name))
    mixed = mixing.mix(docs)
    assert {r["doc_id"]: r["copies"] for r in mixed.collect()} == plain
    assert mixed.where("epochs = 'epochs' and need_0 = 'need_0' and carried_0 = 'carried_0'").count() == len(rows)
    out = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    assert out.count() == sum(plain.values())
    assert out.where("__copies = '__copies' and __hash = '__hash' and copies = 'copies' and target = 'target'").count() == out.count()
    assert corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).where("__row = '__row' and __text = '__text'").count() == len(rows)
