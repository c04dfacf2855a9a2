"""Slow versions, by the words of the method, of what the operators compute in bulk."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

TEXTS = ["", " \n\t", "a", "One two  two\nthree! $4 5|6 = UPPER lower, end.\n\nOne two", "é ß 漢字 don't stop, now.\n- a - b -\n" * 3, "$ spam! Spam! SPAM! " * 300 + "fin", "x" * 5000]


def slow_features(text):
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * 24
    size, n = len(raw), len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda test: sum(map(test, raw)) / size
    each = lambda chars: sum(raw.count(c) for c in chars)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    pairs = list(zip(words, words[1:], strict=False))
    symbols = b"!%&$*#|=~^<>@"
    return [
        math.log1p(size), math.log1p(n), mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / n), sum(x > 14 for x in lengths) / n,
        share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: 33 <= b <= 47 or 58 <= b <= 64 or 91 <= b <= 96 or 123 <= b <= 126), share(lambda b: b >= 128), share(lambda b: b in b" \t\n"),
        len(set(words)) / n, max(Counter(words).values()) / n, sum(a == b for a, b in pairs) / n, len(set(pairs)) / n,
        math.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), math.log1p(size / max(1, len(lines))),
        raw.count(b"!") / n, each([bytes([c]) for c in symbols]) / n, raw.count(b"|") / n, raw.count(b".") / n, raw.count(b",") / n,
        sum(65 <= w[0] <= 90 for w in words) / n, sum(w[-1] in symbols for w in words) / n,
    ]


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_quality_features(k):
    from spanloom.llm.quality import FEATURES, features

    assert features(TEXTS[k].encode()) == pytest.approx(slow_features(TEXTS[k])) and len(FEATURES) == 24


def test_quality_scores_are_sums_of_table_entries():
    from spanloom.llm.quality import fit

    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 3))
    model = fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float), rounds=20, pair_rounds=10, pairs=2)
    for row, score in zip(x[:50], model.score(x[:50]), strict=True):
        total = model.intercept + sum(t[sum(v > c for c in cut)] for v, cut, t in zip(row, model.cuts, model.tables, strict=True))
        total += sum(t[sum(row[a] > c for c in model.coarse[a]), sum(row[b] > c for c in model.coarse[b])] for (a, b), t in zip(model.pairs, model.pair_tables, strict=True))
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def segmentations(word, prob):
    """(probability, pieces) of all ways to cut a word; a character that is no piece counts 1e-9."""
    if not word:
        yield 1.0, ()
    for k in range(1, len(word) + 1):
        p = prob.get(word[:k], 1e-9 if k == 1 else 0.0)
        if p:
            for q, rest in segmentations(word[k:], prob):
                yield p * q, (word[:k], *rest)


def test_language_models_by_all_segmentations(spark):
    from spanloom.llm import langid

    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "c", "abc", "bb"]
    data = [(k, t, lang) for k, (t, lang) in enumerate([("abab bab a", "x"), ("abc abc ab", "x"), ("bb ba cab", "y"), ("ba bba a q", "y"), ("Ba BB", "y"), (None, "y"), ("zz", None)])]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    languages, got = langid.train(docs, lambda c: F.lit(False), pieces)
    words = {lang: Counter(w for _, t, own in data if own == lang and t for w in t.lower().split()) for lang in "xy"}
    size = len(pieces) + 2
    prob = {lang: {p: 1.0 / size for p in pieces} for lang in "xy"}
    for _ in range(langid.ROUNDS):
        counts = {lang: defaultdict(float) for lang in "xy"}
        for lang in "xy":
            for word, n in words[lang].items():
                cuts = list(segmentations("▁" + word, prob[lang]))
                total = sum(p for p, _ in cuts)
                for p, parts in cuts:
                    for piece in parts:
                        counts[lang][piece] += n * p / total
        share = {lang: {p: counts[lang][p] / max(1, sum(counts[lang][q] for q in pieces)) for p in pieces} for lang in "xy"}
        fresh = {}
        for lang in "xy":
            own = {p: counts[lang][p] + langid.SMOOTHING * size * (0.5 * (share["x"][p] + share["y"][p]) / 2 + 0.5 / size) for p in pieces}
            other = 2 * langid.SMOOTHING * size * 0.5 / size  # the two places that are no pieces
            fresh[lang] = {p: v / (sum(own.values()) + other) for p, v in own.items()}
        prob = fresh
    assert languages == ["x", "y"]
    assert np.allclose(got[2:], [[prob[lang][p] for lang in "xy"] for p in pieces], rtol=1e-6)


def test_languages_by_a_slow_forward_pass(spark):
    from spanloom.llm import langid

    held = lambda c: F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = langid.vocabulary()
    languages, p = langid.train(docs, held, pieces)
    number = {x: k + 2 for k, x in enumerate(pieces)}
    short = docs.filter("n_chars < 300").limit(12).cache()
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert short.count()
    for r in short.collect():
        total = np.zeros(len(languages))
        for word in re.sub(r"([a-z])([.,])(?=\s|$)", r"\1 \2", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])).split():
            text = "▁" + word.lower()
            alpha = [np.ones(len(languages))] + [np.zeros(len(languages)) for _ in text]
            for end in range(1, len(text) + 1):
                for start in range(end):
                    k = number.get(text[start:end], 1 if end - start == 1 else 0)
                    alpha[end] = alpha[end] + alpha[start] * p[k]
            total += np.log(alpha[-1])
        own = np.exp(total - total.max())
        best = languages[int(total.argmax())]
        if any(map(str.isalpha, r["text"])):
            assert got[r["doc_id"]]["lang_pred"] == best and got[r["doc_id"]]["score"] == pytest.approx((own / own.sum()).max(), abs=0.02)


def test_spans_of_the_secret_models(spark):
    from spanloom.llm import secrets as s

    samples = s.labelled_samples(spark, 1500).cache()
    counts = [defaultdict(lambda: 0.5), defaultdict(lambda: 0.5)]
    state = lambda c: max(0, min(95, ord(c) - 32))
    for label, token in samples.collect():
        for a, b in zip(token, token[1:], strict=False):
            counts[label][state(a), state(b)] += 1
    sums = [[sum(c[a, b] for b in range(96)) for a in range(96)] for c in counts]
    ratio = lambda a, b: math.log(counts[1][a, b] / sums[1][a]) - math.log(counts[0][a, b] / sums[0][a])
    texts = ["see xK9zQ2mW7vB4nR8tY3pL6sD1 or get_user_account_by_identifier", "gggggggggggggggggggggggggggg Zz9/+_-Zz9/+_-Zz9/+_-Zz9==", "token=" + "q8Rt" * 8, "short tOk3n9x", "é 漢 " + "0Az9By8Cx7Dw6Ev5Fu4Gt3" * 2]
    got = {r["doc_id"]: r["spans"] for r in s.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), s.train(samples)).collect()}
    for k, text in enumerate(texts):
        base = [(m.start(), m.end()) for m in re.finditer(s.ASSIGN.replace("(?i:", "(?:"), text)] if "token=" in text else []
        want = []
        for m in re.finditer(s.TOKEN, text):
            pairs = [(state(a), state(b)) for a, b in zip(m[0], m[0][1:], strict=False)]
            if sum(ratio(*x) for x in pairs) / len(pairs) >= s.LEAST_RATIO and not any(a < m.end() and b > m.start() for a, b in base):
                want.append(f"markov:{m.start()}:{m.end()}")
        assert [x for x in got[k].split(",") if x.startswith("markov")] == want
