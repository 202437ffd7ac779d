import corpus_pipeline
from tripmart.llm.queries import ORACLE_SQL, QUERIES
from tripmart.llm.secret_scan import scan_secrets
from tripmart.llm.simhash import simhash_dedup

SF = "/root/testdata/sf0.001"


def test_stages_act_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        if name != "best-fit packing":
            assert docs.columns == columns
    n = {name: None for name, _ in corpus_pipeline.STAGES}
    assert list(n) == ["quality classifier", "line dedup", "simhash near-dedup", "secret scans", "best-fit packing"]
    clean = before
    assert scan_secrets(clean).selectExpr("sum(size(spans))").first()[0] == 0
    found = simhash_dedup(clean)
    assert found.where("doc_id <> component_id").count() <= 0.02 * clean.count()  # redaction may bring texts nearer
    ends = docs.selectExpr("max(offset + length)", "count(distinct doc_id)").first()
    assert ends[0] <= 2048 and ends[1] == clean.select("doc_id").distinct().count()


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_registered():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLE_SQL) <= set(QUERIES)
