import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators import groups as G
from marketloom.operators import ingest
from marketloom.operators.lookup import bounded_local, lookup_join, settled
from marketloom.plans import analyze, collect
from marketloom.sources import driver_tables, store
from marketloom.sources.driver_tables import build_listings, document_listings, listings
from marketloom.streaming.ingest import ingest_stream
from tests.conftest import SF_DIR


@pytest.fixture
def valid(spark):
    return ingest.accepted(listings(spark, SF_DIR).drop("quality_score", "is_complete"))


def test_table_round_trip_and_pruning(spark, valid, tmp_path):
    path = str(tmp_path / "products")
    store.append_listings(valid, path)
    back = store.scan_listings(store.read_table(spark, path))
    assert set(back.columns) == set(store.SCAN_COLUMNS)
    assert back.count() == valid.count()
    first = valid.orderBy("id").first()
    again = back.where(F.col("id") == first["id"]).first()
    assert again["tags"] == first["tags"] and again["price_min"] == first["price_min"]
    one = store.listings_by_category(store.read_table(spark, path), "PROMO")
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    store.append_listings(valid.limit(3), path)
    assert store.read_table(spark, path).count() == valid.count() + 3
    store.replace_listings(valid.limit(2), path)
    assert store.read_table(spark, path).count() == 2


def test_csv_fallback(spark, valid, tmp_path):
    table, csv = str(tmp_path / "t"), str(tmp_path / "c")
    few = valid.limit(5).withColumn("description", F.lit('two\nlines, "quoted"'))
    store.write_csv(few, csv)
    loaded = store.load_listings(spark, table, csv)
    assert loaded.count() == 5
    row = loaded.first()
    assert row["description"] == 'two\nlines, "quoted"' and len(row["tags"]) == 2 and row["price_min"] > 0
    store.append_listings(valid.limit(7), table)
    assert store.load_listings(spark, table, csv).count() == 7


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "product_name,price_info,supplier_name,location,source_url,timestamp\n"
        "Gear Pump,₹ 73250,Acme,Surat,mock_generated,2024-05-06T07:08:09.101112\n"
        '"Pump, big","₹ 1,200 - ₹ 900",Acme,Pune,mock_generated,not a time\n',
        encoding="utf-8",
    )
    rows = ingest.normalize_raw(store.read_raw_csv(spark, str(path)), "Pumps").orderBy("price_min").collect()
    assert [(r["price_min"], r["price_max"], r["city"], r["category"]) for r in rows] == [
        (900.0, 1200.0, "Pune", "Pumps"),
        (73250.0, 73250.0, "Surat", "Pumps"),
    ]
    assert rows[0]["scraped_at"] is None and rows[1]["scraped_at"].microsecond == 101112


def test_collect_pages_stores_and_counts(spark, tmp_path):
    html = '<div class="c-p"><a class="pn" href="/1">{}</a><i class="price">Rs 5 - 9</i></div>'
    pages = spark.createDataFrame([(1, html.format("Gear pump large")), (2, html.format("ab"))], "page_id long, html string")
    table, audit = str(tmp_path / "t"), str(tmp_path / "a")
    collect.collect_pages(pages, "industrial-pumps", table, audit)
    row = store.read_table(spark, table).first()
    assert (row["product_name"], row["category"], row["quality_score"]) == ("Gear pump large", "Industrial Pumps", 0.5)
    counts = spark.read.parquet(audit).first()
    assert (counts["records_collected"], counts["records_validated"], counts["records_rejected"]) == (2, 1, 1)


def test_stream_accepts_what_the_batch_accepts(spark, tmp_path):
    raw = document_listings(spark, SF_DIR).drop("quality_score")
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    raw.write.parquet(source)
    stream = spark.readStream.schema(raw.schema).parquet(source)
    for _ in range(2):
        query = ingest_stream(stream, table, mark)
        query.awaitTermination(120)
        assert query.exception() is None
    n = ingest.accepted(raw).count()
    assert store.read_table(spark, table).count() == n > 0
    store.append_listings(ingest.accepted(raw).limit(5), table)
    assert store.read_table(spark, table).count() == n + 5
    raw.limit(9).write.mode("append").parquet(source)
    ingest_stream(stream, table, mark).awaitTermination(120)
    assert store.read_table(spark, table).count() == n + 5 + ingest.accepted(raw.limit(9)).count()
    store.append_listings(ingest.accepted(raw).limit(4), table, "again")
    store.append_listings(ingest.accepted(raw).limit(4), table, "again")
    assert store.read_table(spark, table).where("category is not null").count() >= n + 9


def test_two_listings_of_a_page_have_two_ids(spark, tmp_path):
    item = '<div class="c-p"><a class="pn" href="/1">Gear pump large</a><i class="price">Rs 5 - 9</i></div>'
    pages = spark.createDataFrame([(1, item * 2), (2, item)], "page_id long, html string")
    collect.collect_pages(pages, "industrial-pumps", str(tmp_path / "t"))
    ids = [r["id"] for r in store.read_table(spark, str(tmp_path / "t")).collect()]
    assert len(ids) == len(set(ids)) == 3


def test_lookup_beyond_the_limit_is_not_broadcast(spark):
    rows = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50))
    names = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert bounded_local(names, 49) is None and bounded_local(names, 50).count() == 50
    small, large = (lookup_join(rows, names, ["k"], limit=n) for n in (50, 10))
    assert "broadcast" in small._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "strategy=broadcast" not in large._jdf.queryExecution().optimizedPlan().toString().lower()
    assert small.orderBy("id").collect() == large.orderBy("id").collect()
    assert settled(names, 10).count() == 50


def test_empty_listings_give_empty_reports(spark):
    none = listings(spark, SF_DIR).limit(0)
    for operator in (G.category_stats, G.category_report, G.supplier_profile, G.category_profile, G.price_waterfall):
        assert operator(none).collect() == []
    assert G.kpi_summary(none).first()["products"] == 0
    assert G.analysis_summary(none).first()["overall_median_price"] is None
    assert G.dedup_count(none.select("id")).first()["duplicate_rows"] == 0
    assert analyze.status(none).collect() == []


def test_missing_flags_count_as_unverified(spark):
    rows = [(1, "s", None), (2, "s", True), (3, "t", None)]
    df = spark.createDataFrame(rows, "id long, supplier_name string, supplier_verified boolean")
    assert {r["supplier_name"]: r["verified"] for r in G.supplier_flag_lookup(df).collect()} == {"s": True, "t": False}


def test_samples_repeat(spark):
    df = listings(spark, SF_DIR)
    a, b = (G.sample_rows(d, 50).select("id").collect() for d in (df, df.repartition(9)))
    assert a == b and len(a) == 50


def test_exported_csv_is_compressed_and_reads_back_whole(spark, tmp_path):
    schema = T.StructType([f for f in store.STORED_SCHEMA if f.name in ("id", "product_name", "description", "price_min")])
    rows = [(i, f'name "{i}", line\nbreak', None if i % 3 else f"text, {i}", i / 4) for i in range(50)]
    by_name = [dict(zip(("id", "product_name", "description", "price_min"), r)) for r in rows]
    df = spark.createDataFrame([tuple(r[n] for n in schema.names) for r in by_name], schema).withColumn("tags", F.lit("a,b"))
    path = str(tmp_path / "csv")
    store.write_csv(df, path)
    files = [p.name for p in (tmp_path / "csv").iterdir() if p.name.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
    back = {r["product_name"]: (r["description"], r["price_min"], r["tags"]) for r in store.read_csv(spark, path).collect()}
    assert back == {r["product_name"]: (r["description"], r["price_min"], "a,b") for r in by_name}


def test_line_items_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(driver_tables, "ITEMS_PER_TASK", 1000)
    monkeypatch.setattr(driver_tables, "LEAST_ITEMS", 1000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large dimensions
    try:
        plan = build_listings(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by_part = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_partkey" in line]
    assert len(by_part) == 1 and "REPARTITION_BY_NUM" in by_part[0]
