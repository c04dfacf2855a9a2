import random
import re

GIVEN = ["John", "Maria", "Alex", "Kim", "Sasha", "Anna", "Peter", "Xo", "Jean"]
SURNAMES = ["Smith", "McDonald", "O\u2019Brien", "Li", "Ng", "Weber", "Young", "SMYTHE", "Иванов", "Κωστας"]


def _number(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng):
    head = "4" + _number(rng, 14)
    total = sum(int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(head))
    return head + str(-total % 10)


def _entity(rng):
    """(kind, entity, a way to write it)."""
    kind = rng.choice(["phone", "ssn", "card", "mail", "ip", "name"])
    if kind == "phone":
        a, b, c = "2345"[rng.randrange(4)] + _number(rng, 2), _number(rng, 3), _number(rng, 4)
        return kind, a + b + c, lambda r: r.choice(["+1 ", "+1-", ""]) + r.choice([f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}"])
    if kind == "ssn":
        x = _number(rng, 9)
        return kind, x, lambda r: f"{x[:3]}-{x[3:5]}-{x[5:]}"
    if kind == "card":
        x = _card(rng)
        return kind, x, lambda r: r.choice([x, " ".join(re.findall("....", x)), "-".join(re.findall("....", x))])
    if kind == "mail":
        x = f"u{_number(rng, 6)}.q@host{_number(rng, 3)}.org"
        return kind, x, lambda r: r.choice([x, x.upper()])
    if kind == "ip":
        x = ".".join(str(rng.randrange(256)) for _ in range(4))
        return kind, x, lambda r: x
    title, given, surname = rng.choice([("Mr.", "m"), ("Mrs.", "f"), ("Dr", "n")]), rng.choice(GIVEN + [None] * 3), rng.choice(SURNAMES)
    return kind, (given, surname), lambda r: " ".join(x for x in (title[0], given, surname) if x)


def _shown(kind, mention):
    digits = re.sub("[^0-9]", "", mention)
    if kind == "phone":
        return digits[-10:]
    if kind in ("ssn", "card"):
        return digits
    return mention.lower() if kind in ("mail", "ip") else mention


def test_entities_and_surrogates_are_one_to_one_and_no_value_is_left(spark):
    from spanloom.llm.pii import replace_personal_data

    rng = random.Random(11)
    entities = [_entity(rng) for _ in range(160)]
    rows, planted = [], []
    for k in range(300):
        own = [rng.choice(entities) for _ in range(rng.randrange(1, 5))]
        written = [e[2](rng) for e in own]
        gaps = [rng.choice([" ; ", ", ", "; ", " / "]) for _ in written]
        rows.append((None if k % 7 == 0 else k // 2, "begin" + "".join(g + w for g, w in zip(gaps, written, strict=True)) + " end"))
        planted.append((rows[-1][1], [(e[0], e[1], w) for e, w in zip(own, written, strict=True)], gaps))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    kept = [r["text"] for r in replace_personal_data(spark.createDataFrame([(k, p[0]) for k, p in enumerate(planted)], "k long, text string"), "key", "k").orderBy("doc_id").collect()]
    again = [r["text"] for r in replace_personal_data(df, "key").collect()]
    assert sorted(again) == sorted(kept)  # ids, null or repeated, play no part
    forward, back, surnames = {}, {}, {}
    for (_, mentions, gaps), text in zip(planted, kept, strict=True):
        pattern = "begin" + "".join(re.escape(g) + "(.+?)" for g in gaps) + " end$"
        found = re.match(pattern, text)
        assert found, text
        for (kind, entity, written), now in zip(mentions, found.groups(), strict=True):
            got.setdefault(kind, 0)
            got[kind] += 1
            assert _shown(kind, written) not in re.sub("[^0-9a-zA-Z.@ -]", "", text).lower().split() or kind == "name", (written, text)
            if kind == "name":
                assert now.split()[0] == written.split()[0]
                assert surnames.setdefault(entity[1], now.split()[-1]) == now.split()[-1] or entity[1] == "Иванов"
                assert now.split()[-1] not in SURNAMES and len(now.split()) == len(written.split())
                continue
            assert forward.setdefault((kind, entity), _shown(kind, now)) == _shown(kind, now), (written, now)
            assert back.setdefault((kind, _shown(kind, now)), entity) == entity
    assert len(set(surnames.values())) == len(surnames) and all(got.get(k, 0) > 20 for k in ("phone", "ssn", "card", "mail", "ip", "name"))


def test_numbers_side_by_side_and_one_person_under_several_titles(spark):
    from spanloom.llm.pii import replace_personal_data

    texts = [
        "SSN 123-45-6789 918-555-4124", "918-555-4124 918-555-4125", "order 12345678 918-555-4124", "4111 1111 1111 1111 918-555-4124", "4111111111111111 123-45-6789", "+44 20 7946 0958 918-555-4124",
        "4111 1111 1111 1111 123", "Dr. Kim Smith", "Mrs. Kim Smith", "Dr. Smith", "Mr. Smith", "order 1234567890123456 stays",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = replace_personal_data(df, "key").orderBy("doc_id").collect()
    got = [r["text"] for r in rows]
    assert [r["n_entities"] for r in rows] == [2, 2, 1, 2, 2, 2, 1, 1, 1, 1, 1, 0]
    for number in ("123-45-6789", "918-555-4124", "918-555-4125", "4111 1111", "4111111111111111", "7946 0958"):
        assert not any(number in t for t in got)
    assert len({g[-12:] for g in (got[0], got[1][:12], got[2], got[3], got[5])}) == 1 and got[0][4:15] == got[4][-11:]
    assert got[7].split()[1:] == got[8].split()[1:] and got[7].split()[2] == got[9].split()[1] == got[10].split()[1] and got[11] == texts[11]


def test_short_surnames_stay_distinct_under_every_title(spark):
    from spanloom.llm.pii import replace_personal_data

    names = [a + b for a in "ABCDEFGHIJKLMNOPRSTUVW" for b in "aeiou"]
    df = spark.createDataFrame([(k, f"{title} {n} x") for k, n in enumerate(names) for title in ("Dr.", "Mrs.", "Mr.")], "doc_id long, text string")
    got = [r["text"].split() for r in replace_personal_data(df, "key").collect()]
    for title in ("Dr.", "Mrs.", "Mr."):
        assert len({g[1] for g in got if g[0] == title}) == len(names)
