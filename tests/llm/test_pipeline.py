from pyspark.sql import functions as F

from ..compare import same

SF = "/root/testdata/sf0.001"


def test_queries_with_sql(spark):
    from spanloom.llm.queries import ORACLE, QUERIES

    for name, sql in ORACLE.items():
        same(spark, SF, QUERIES[name], sql)


def test_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF).cache()
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(ids) <= kept and len(ids) == len(set(ids))
        kept = set(ids)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "quality":
            assert sum((d in kept) != bool(q) for d, q in labels.items()) <= 0.03 * len(labels)
        if name == "near_duplicates":
            assert docs.select(F.sha2("text", 256)).distinct().count() == docs.count()
        if name == "decontamination":
            from spanloom.llm.decontaminate import find_leaks

            assert find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
            assert find_leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").distinct().count() == before.count() - docs.count()
        if name == "secrets":
            from spanloom.llm.secrets import find_secrets

            assert docs.count() == before.count() and find_secrets(docs).filter("n_assign + n_access + n_hex > 0").count() == 0
            assert docs.filter("n_chars <> length(text)").join(before.filter("n_chars <> length(text)"), "doc_id", "left_anti").count() == 0
    assert docs.columns[0] == "doc_id" and docs.filter("taken > 3 * size").count() == 0


def test_run_gives_the_last_stage(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "size", "source_size", "target", "taken"]
