import random


def test_languages_without_spaces_are_learnt(spark):
    from spanloom.llm.langid import identify, vocabulary

    rng = random.Random(4)
    kana = [p for p in vocabulary() if all("\u3041" <= c <= "\u309f" for c in p)]
    han = [p for p in vocabulary() if all("\u4e00" <= c <= "\u9fff" for c in p)]
    # both write the same signs, in other shares, without a space
    text = lambda often, seldom: "".join(rng.choice(often if rng.random() < 0.7 else seldom) for _ in range(120))
    docs = [(k, text(kana, han) if k % 2 else text(han, kana), "ja" if k % 2 else "zh") for k in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = identify(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert got and all(r["lang_pred"] == r["lang"] for r in got)
