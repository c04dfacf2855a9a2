"""Archive files stay short however payload sizes lie, and rows without an id are decontaminated by their texts."""

import glob
import gzip
import random


def test_no_file_is_longer_than_it_may_be(spark, tmp_path, monkeypatch):
    from spanloom.llm import warc

    monkeypatch.setattr(warc, "FILE_BYTES", 1 << 20)
    rng = random.Random(1)
    blob = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    rows = [(k, f"http://h{k % 7}.org/{k}", "x") for k in range(6000)] + [(10_000 + k, f"http://big.org/{k}", blob(300_000)) for k in range(12)] + [(20_000, "http://huge.org", blob(3 << 20)), (20_001, "http://mid.org", blob(5000))]
    pages = spark.createDataFrame(rows[:6000], "page_id long, url string, html string").repartition(3).unionByName(spark.createDataFrame(rows[6000:], "page_id long, url string, html string").coalesce(1))
    path = f"{tmp_path}/w"
    warc.write_archives(pages, f"file://{path}", least_bytes=10)
    sizes = [len(gzip.decompress(open(f, "rb").read())) for f in glob.glob(f"{path}/**/*.gz", recursive=True)]
    assert sum(s > 1.5 * (1 << 20) for s in sizes) <= 1 + sum(s > 3 << 20 for s in sizes) <= 2
    got = {r["page_id"]: r["payload_bytes"] for r in warc.read_captures(spark, f"file://{path}").collect()}
    assert got == {k: len(h) for k, _, h in rows}


def test_rows_without_an_id_go_by_their_texts(spark):
    from spanloom.llm.decontaminate import drop_leaks

    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, f"see {item} there", 1), (None, "nothing of it", 2), (None, None, 3), (1, item, 4), (2, "clean", 5), (None, f"see {item} there", 6)], "doc_id long, text string, n int")
    kept = drop_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r["n"] for r in kept.collect()) == [2, 3, 5]
