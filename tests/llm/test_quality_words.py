import numpy as np


def test_quality_features_read_every_word():
    from spanloom.llm.quality import FEATURES, features

    at = {name: k for k, name in enumerate(FEATURES)}
    words = [f"w{k}" for k in range(2000)]
    for k in range(7, 2000, 50):  # off every stride of the former sample
        words[k], words[k + 2], words[k + 4] = "Capital", "buy!", "spam"
    got = features(" ".join(words).encode())
    assert np.isclose(got[at["capital_words"]], 40 / 2000) and np.isclose(got[at["symbol_words"]], 40 / 2000)
    assert np.isclose(got[at["commonest_word"]], 40 / 2000)
    assert np.isclose(features(b" A b!\tB\n b!x ")[at["symbol_words"]], 1 / 4) and np.isclose(features(b" A b!\tB\n b!x ")[at["capital_words"]], 2 / 4)
