import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import calibrate as cal
from spanloom.operators import learn
from spanloom.operators import merge as mg
from spanloom.operators import resolve as rs
from spanloom.operators import sequence as seq
from spanloom.operators import signal as sg
from spanloom.operators import vector as vec
from spanloom.operators.running import running
from spanloom.sources import files
from spanloom.sources import subtitles as st


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_over_ranges(spark, descending):
    rng = random.Random(1)
    data = [(x, rng.randrange(10) if rng.random() > 0.1 else None) for x in rng.sample(range(-500, 500), 300)]
    got = {r["x"]: (r["s"], r["m"]) for r in running(running(spark.createDataFrame(data, "x long, v long"), "x", {"s": "v"}, descending=descending), "x", {"m": "v"}, F.max, descending).collect()}
    total = most = None
    for x, v in sorted(data, reverse=descending):
        if v is not None:
            total, most = (total or 0) + v, v if most is None else max(most, v)
        assert got[x] == (total, most)
    assert running(spark.createDataFrame([], "x long, v long"), "x", {"s": "v"}).count() == 0


def slow_fit(x, y, l2=1.0):
    mean, sd = x.mean(0), x.std(0)
    sd[sd < 1e-9] = 1
    z, b = np.c_[np.ones(len(x)), (x - mean) / sd], np.zeros(x.shape[1] + 1)
    ridge = np.diag([0.0] + [l2] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ b))
        b = b + np.linalg.solve(z.T * (p * (1 - p)) @ z + ridge, z.T @ (y - p) - ridge @ b)
    return lambda q: 1 / (1 + np.exp(-(np.c_[np.ones(len(q)), (q - mean) / sd] @ b)))


def _scored(seed, n=400):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] * 2 - x[:, 1])))).astype(int)
    return x, y, rng.integers(0, 4, n)


def test_left_out_scores_against_numpy(spark):
    x, y, g = _scored(3)
    df = spark.createDataFrame([(k, int(g[k]), *map(float, x[k]), int(y[k])) for k in range(len(y))] + [(999, None, 0.0, 0.0, 0.0, 1)], "k long, g long, a double, b double, c double, y int")
    got = {r["k"]: r["p"] for r in learn.left_out_scores(df, "g", ["a", "b", "c"], "y").collect()}
    for name in range(4):
        p = slow_fit(x[g != name], y[g != name])(x[g == name])
        assert np.allclose([got[k] for k in np.flatnonzero(g == name).tolist()], p, atol=1e-5)
    assert got[999] is None
    one = learn.left_out_scores(df.filter("g = 1"), "g", ["a"], "y")
    assert one.filter("p is not null").count() == 0


def test_ranking_for_audit_against_numpy(spark):
    x, y, g = _scored(5, 500)
    audited = np.arange(500) % 4 == 0
    data = [(k, int(g[k]), float(x[k, 0]), float(x[k, 1]), float(x[k, 2]), int(y[k])) for k in range(500)]
    schema = "k long, season long, top1 double, margin double, log_dur double, y int"
    train, some = (spark.createDataFrame([r for r in data if bool(audited[r[0]]) == a], schema) for a in (False, True))
    got = {r["k"]: r["p"] for r in cal.ranked_for_audit(train.drop("k"), some, "season", ["top1", "margin", "log_dur"]).collect()}
    lp = np.zeros(500)
    for s in range(4):
        p = slow_fit(x[~audited & (g != s)], y[~audited & (g != s)])(x[audited & (g == s)])
        lp[audited & (g == s)] = np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))
    z = np.c_[lp, x[:, 2], x[:, 0], x[:, 1]]
    for s in range(4):
        own = np.flatnonzero(audited & (g == s))
        p = slow_fit(z[audited & (g != s)], y[audited & (g != s)], 3.0)(z[own])
        assert np.allclose([got[k] for k in own.tolist()], p, atol=1e-4)


def test_models_travel_as_json():
    model = learn.Logistic(["a"], [1.0], [2.0], [0.5], -1.0)
    assert learn.from_json(learn.to_json(model)) == model


def test_features_of_a_run(spark):
    df = spark.createDataFrame([(1, [("HOST_1", 0.8), ("B", 0.5)], 9.0, 3, "confessional", "recap", True, 4, 10, 99.0, 2), (2, [], -1.0, 0, None, None, None, None, None, None, None)], "run long, candidates array<struct<label:string,score:double>>, dur double, n_utts int, domain string, segment string, named boolean, episode int, bank_n int, bank_s double, bank_n2 int")
    got = {r["run"]: r for r in cal.run_features(df).collect()}
    a = got[1]
    assert [round(a[c], 6) for c in cal.RUN] == [round(x, 6) for x in (0.8, 0.5, 0.0, 0.3, 0.5, 2, math.log(10), math.log(4), 1, 1, 1, 1, math.log(11), math.log(100), math.log(3), math.log(4), 0.24)]
    assert all(got[2][c] == 0 for c in cal.RUN) and len(cal.FEATURES) == 25


def test_features_around_a_run(spark):
    runs = spark.createDataFrame([("e", 1, 100.0, 110.0, "A", "B"), ("e", 2, 112.0, 115.0, "B", "A"), ("f", 3, 0.0, 1.0, "A", None)], "ep string, run long, start_s double, end_s double, pred string, second string")
    captions = spark.createDataFrame([("e", 1, "A", 101.0, 103.0), ("e", 9, "A", 90.0, 95.0), ("e", 8, "B", 50.0, 60.0), ("e", 2, "B", 112.0, 114.0)], "ep string, run long, label string, start_s double, end_s double")
    cards = spark.createDataFrame([("e", "A", 15.0), ("e", "B", 300.0)], "ep string, label string, t_s double")
    got = {r["run"]: tuple(r[c] for c in cal.AROUND) for r in cal.around_features(runs, captions, cards, ["ep"], "run").collect()}
    assert got[1] == (1, 1, 1, 0, 1, 0, 0, 1) and got[2] == (1, 1, 0, 0, 0, 0, 0, 1) and got[3] == (0,) * 8


def test_ratios_against_slow_versions(spark):
    def common(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    rng = random.Random(2)
    pairs = [("".join(rng.choice("abc") for _ in range(rng.randrange(9))), "".join(rng.choice("abc") for _ in range(rng.randrange(14)))) for _ in range(150)] + [("", ""), ("nurse", "a trauma nurse"), (None, "x")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", tx.indel_ratio(F.col("a"), F.col("b")).alias("r"), tx.partial_ratio(F.col("a"), F.col("b")).alias("p")).collect()
    for r in got:
        a, b = r["a"], r["b"]
        if a is None:
            assert r["r"] is None and r["p"] is None
            continue
        assert r["r"] == pytest.approx(200 * common(a, b) / (len(a) + len(b)) if a or b else 100)
        s, t = sorted((a, b), key=len)
        parts = [t[max(0, k) : k + len(s)] for k in range(1 - len(s), len(t))]
        assert r["p"] == pytest.approx(max((200 * common(s, x) / (len(s) + len(x)) if s or x else 100 for x in parts), default=100 if not t else 0))


def test_fuzzy_best_takes_hints_and_single_edits(spark):
    tokens = spark.createDataFrame([("ROB", "NURSE"), ("SANDRAA", "x"), ("TYSN", "y"), ("QQ", "z"), ("PARVTI", "LAW")], "token string, job string")
    names = spark.createDataFrame([("ROB", "SALES"), ("SANDRA", ""), ("TYSON", ""), ("PARVATI", "LAWYER"), ("PARKER", "")], "name string, job string")
    got = {r["token"]: (r["name"], round(r["score"], 2)) for r in rs.fuzzy_best(tokens, names, "token", "name", hint="job").collect()}
    assert got == {"ROB": ("ROB", 100.0), "SANDRAA": ("SANDRA", 92.31), "TYSN": ("TYSON", 88.89), "PARVTI": ("PARVATI", 97.31)}


def test_mentions_of_names_of_several_words(spark):
    texts = spark.createDataFrame([(1, "With Mary Ann and mary, I'm Rob's friend."), (2, "robert, O'Rob and Maryann"), (3, "B.B. is here; b.b"), (4, None)], "k long, text string")
    names = spark.createDataFrame([("M", "Mary"), ("M", "Mary Ann"), ("R", "Rob"), ("B", "B.B."), ("X", "x")], "who string, name string")
    assert rows(rs.mentions(texts, "k", "text", names, "who", "name")) == [(1, "M", 2), (1, "R", 1), (3, "B", 1)]


def test_ordered_blocks_and_boundary_times(spark):
    a, b = "we go to the beach now and then we sleep".split(), "so we go to the camp now and then we sleep".split()
    pairs = spark.createDataFrame([("e", a, b)], "ep string, a array<string>, b array<string>")
    blocks = rs.ordered_blocks(pairs, "ep", "a", "b")
    assert rows(blocks) == [("e", 0, 1, 4), ("e", 5, 6, 5)]
    cues = spark.createDataFrame([("e", k, k // 5, k % 5 == 0, k % 5 == 4) for k in range(10)], "ep string, at long, cue long, is_first boolean, is_last boolean")
    words = spark.createDataFrame([("e", k, k * 1.0, k + 0.5) for k in range(11)], "ep string, at long, s double, e double")
    assert rows(rs.anchored_times(blocks, "ep", cues, words, "cue", "at", "s", "e")) == [("e", 0, 1.0, None), ("e", 1, 6.0, 10.5)]


def test_cards_lists_and_tables_as_text(spark):
    df = spark.createDataFrame([(["lowland tribe", "Day 11"],), (["RIVER / NIGHT 3"],), (["Rob", "Day"],), ([],)], "l array<string>")
    assert [r[0] and tuple(r[0]) for r in df.select(tx.location_card(F.col("l"))).collect()] == [("LOWLAND", "day", 11), ("RIVER", "night", 3), None, None]
    one = spark.createDataFrame([("1, 2,,3",)], "x string").select(tx.int_list(F.col("x")), tx.contains_any(F.lit("A.HI.srt"), [".hi."]), tx.contains_any(F.lit(None).cast("string"), ["a"])).first()
    assert tuple(one) == ([1, 2, 3], True, False)


def test_lines_as_subtitles_have_them(spark):
    lines = [">> ANN LEE: Come on in!", "- (laughs) I know", "– No.", "(gasps)", "♪ la la ♪", "♪", "*applause*", "DR. WILL (V.O.): <i>hi</i>  there", "X: y", "Note: not a name", "MAN #2: [sighs] ok", "# not a sound", ""]
    got = [tuple(r["c"]) for r in spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, x string").orderBy("k").select(tx.clean_line(F.col("x")).alias("c")).collect()]
    assert got == [
        ("Come on in!", "ANN LEE", True, False), ("I know", None, True, False), ("No.", None, True, False), ("", None, False, True), ("", None, False, True), ("", None, False, True), ("", None, False, True),
        ("hi there", "DR. WILL", False, False), ("X: y", None, False, False), ("Note: not a name", None, False, False), ("ok", "MAN #2", False, False), ("# not a sound", None, False, False), ("", None, False, False),
    ]


def test_streaming_folds_take_nulls_and_long_keys(spark):
    data = [(1, k, k * 3, float(k % 5)) for k in range(4000)] + [(2, 0, None, 1.0), (2, 1, 5, None), (2, 2, 6, 2.0)]
    df = spark.createDataFrame(data, "g int, i int, t long, v double").repartition(3)
    got = rows(seq.dedupe_anchored(df, ["g"], ["t", "i"], "t", "v", 30))
    assert len([r for r in got if r[0] == 1]) == 364 and got[-1] == (2, 5, 6, 2.0, 2)
    cut = seq.scenes(df.filter("g = 1").withColumn("e", F.col("t") + 1), ["g"], ["t"], "t", "e", 1, 100)
    assert cut.count() == 4000
    assert seq.scenes(df.limit(0), ["g"], ["t"], "t", "t", 1, 100).count() == 0


def test_nearest_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(vec, "BLOCK_ITEMS", 50)
    monkeypatch.setattr(vec, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(4)
    x = rng.integers(-2, 3, size=(230, 4)).astype(float)
    items = spark.createDataFrame([(k, x[k].tolist()) for k in range(230)], "k long, v array<double>").repartition(4)
    got = {r["k"]: (r["other"], r["score"]) for r in vec.nearest_in_blocks(items, "k", "v", items.filter("k % 10 = 0")).collect()}
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    assert got == {k: (int(score[k].argmax()), float(score[k].max())) for k in range(0, 230, 10)}


def test_labels_beyond_the_first_thousand_are_compared(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(1500, 8))
    profile = spark.createDataFrame([(k, (c / np.linalg.norm(c)).tolist()) for k, c in enumerate(centres)], "label long, profile array<double>")
    left, right = (spark.createDataFrame([(p, rng.normal(size=8).tolist()) for p in range(20)], "pair long, v array<double>") for _ in range(2))
    assert vec.contrast(left, right, "pair", "v", profile, "label", "profile").count() >= 18


def test_a_person_s_check_and_an_explicit_name_decide_a_card(spark):
    items = spark.createDataFrame([(1, None), (2, "B"), (3, None), (4, None)], "k long, explicit string")
    labels = spark.createDataFrame([(3, "H", "human", 1.0), (4, "old", "card", 0.9)], "k long, label string, source string, confidence double")
    cards = spark.createDataFrame([(1, "A", 90, 5.0), (1, "C", 95, 4.0), (2, "A", 99, 6.0), (3, "A", 99, 7.0), (2, "D", 99, 8.0)], "k long, label string, score int, t_s double")
    checks = spark.createDataFrame([(8.0, "D", None), (6.0, "A", 4)], "t_s double, label string, checked_key long")
    after, conflicts = mg.card_labels(cards, items, labels, checks, "k")
    assert rows(after) == [(1, "A", "card", 0.9), (3, "H", "human", 1.0), (4, "A", "card", 1.0)] and conflicts.count() == 0
    _, conflicts = mg.card_labels(cards, items, labels, checks.limit(0), "k")
    assert rows(conflicts) == [(2, "D", "B", 8.0)]


def test_settings_in_layers(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("audio: {rate: 16, mono: true}\nnames: [a]\nseasons: {US1: {RJ: X1}}\nstoplist: [MAN]")
    (tmp_path / "b.yaml").write_text("audio: {rate: 8}\nnames: [b]")
    got = files.read_settings(str(tmp_path / "a.yaml"), str(tmp_path / "none.yaml"), str(tmp_path / "b.yaml"))
    assert got["audio"] == {"rate": 8, "mono": True} and got["names"] == ["b"]
    assert rows(files.alias_table(spark, got)) == sorted([("US1", "RJ", "X1"), (None, "MAN", None)], key=str)


def test_videos_by_their_names(spark, tmp_path):
    for name in ("a.s01e02.mkv", "b.S3E10E11.MP4", "notes.txt", ".c.s01e01.mkv", "clip.avi"):
        (tmp_path / name).write_bytes(b"x")
    got = rows(st.find_videos(spark, str(tmp_path)).select(F.element_at(F.split("path", "/"), -1), "season", "episode", "second_episode"))
    assert got == sorted([("a.s01e02.mkv", 1, 2, None), ("b.S3E10E11.MP4", 3, 10, 11), ("clip.avi", None, None, None)], key=str)


def test_signals_of_odd_lengths(spark):
    df = spark.createDataFrame([(1, [0.0] * 5), (2, []), (3, [1.0] * 4)], "k long, x array<double>")
    got = {r["k"]: r["l"] for r in df.select("k", sg.log_rms(F.col("x"), 2).alias("l")).collect()}
    assert got[2] == [] and len(got[1]) == 2 and got[3] == pytest.approx([math.log(1 + 1e-6)] * 2, abs=1e-9)
    assert json.loads(json.dumps(df.select(sg.unpacked_vector(sg.packed_vector(F.col("x"))).alias("v")).first()["v"])) == [0.0] * 5
