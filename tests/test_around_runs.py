import random

from spanloom.operators import calibrate as cal


def slow(runs, captions, cards):
    """The features by their definition, run by run."""
    found = {}
    for ep, run, a, b, pred, second in runs:
        lines = [c for c in captions if ep is not None and c[0] == ep]
        named = [d for d in cards if ep is not None and d[0] == ep]
        near = lambda x: any(x is not None and c[2] == x and c[1] != run and c[4] >= a - 60 and c[3] <= b + 60 for c in lines)  # noqa: B023, E731
        card = lambda x: any(x is not None and d[1] == x and a - 90 <= d[2] <= b + 90 for d in named)  # noqa: B023, E731
        ends = [c[4] for c in lines if a - 30 <= c[4] <= a]
        starts = [c[3] for c in lines if b <= c[3] <= b + 30]
        label = lambda own: max((c[2] for c in own if c[2] is not None), default="none") == pred  # noqa: B023, E731
        found[run] = (near(pred), near(second), bool(ends) and label([c for c in lines if c[4] == max(ends)]), bool(starts) and label([c for c in lines if c[3] == min(starts)]), card(pred), card(second), len(lines) >= 20, bool(named))
    return found


def test_features_around_runs_against_slow_version(spark):
    rng = random.Random(11)
    runs, captions, cards = [], [], []
    for number, ep in enumerate(["a"] * 40 + ["b"] * 6 + ["c"] * 4 + [None] * 3):
        a = float(rng.randrange(0, 2400, 5))
        b = a + rng.randrange(0, 60, 5)
        runs.append((ep, number, a, b, rng.choice("ABCDE"), rng.choice(["A", "B", "C", "D", "E", None])))
        for _ in range(rng.randrange(4)):
            at = a + rng.randrange(0, int(b - a) + 1, 5)
            captions.append((ep, number, rng.choice(["A", "B", "C", "D", None]), at, at + rng.choice([0.0, 5.0, 30.0, 200.0])))
    cards += [(ep, rng.choice("ABCDE"), float(rng.randrange(0, 2400, 5))) for ep in ["a"] * 12 + ["b", None]]
    captions += [("b", 900 + k, "A", 5000.0 + k, 5001.0 + k) for k in range(25)] + [("c", None, "B", 100.0, 105.0)]
    # a run's own lines lie in it
    captions = [(ep, n, x, s, e if n is None or n >= 900 else max(s, min(e, next(r[3] for r in runs if r[1] == n)))) for ep, n, x, s, e in captions]
    made = cal.around_features(
        spark.createDataFrame(runs, "ep string, run long, start_s double, end_s double, pred string, second string"), spark.createDataFrame(captions, "ep string, run long, label string, start_s double, end_s double"),
        spark.createDataFrame(cards, "ep string, label string, t_s double"), ["ep"], "run",
    )
    got = {r["run"]: tuple(r[c] == 1 for c in cal.AROUND) for r in made.collect()}
    want = slow(runs, captions, cards)
    assert got == want
    assert all(0 < sum(x[k] for x in want.values()) < len(want) for k in range(8))


def test_rows_move_a_few_times(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["q_around_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4
    assert "Join" not in plan
