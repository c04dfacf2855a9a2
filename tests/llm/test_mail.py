def test_mail_addresses_at_sentence_ends_and_in_punctuation(spark):
    from spanloom.llm.pii import replace_personal_data

    texts = [
        "see jane@example.com. Then", "_jane@example.com_", "-bob@x.org", "--jane@x.org", "a jane@example.com.", "(jane@mail.example.co.uk).", "jane@example.com.1", "jane@example.com-bob@x.org",
        "jane@example.com, .bob@x.org; carl-jane@x.org!", "no mail @ here. a@b or a-b-c-d", "well-known a.b.c",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = replace_personal_data(df, "key").orderBy("doc_id").collect()
    assert [r["n_entities"] for r in got] == [1, 1, 1, 1, 1, 1, 1, 2, 3, 0, 0]
    for r, text in zip(got, texts, strict=True):
        assert len(r["text"]) == len(text) and not any(x in r["text"] for x in ("jane", "bob@", "example")), r["text"]
    assert got[0]["text"][4:20] == got[1]["text"][1:17] == got[4]["text"][2:18]
