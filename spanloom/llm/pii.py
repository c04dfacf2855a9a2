"""Personal data replaced by keyed surrogates of the same kind and format, checked for collisions. DataFrame expressions only.

An entity is what all mentions of it share: a mail address in lower case, the digits of a number, a given name with its gender, a
surname. It and a secret key decide a stem, the entity's surrogate in its plainest form, and every mention shows that stem in its own
format, so mentions that differ in title, spacing or country code stay together. The distinct entities of the corpus are gathered
once; where two would share a stem, or one would get another's real value, all but one draw again. As a mention's form adds
nothing that another stem could end in, distinct stems mean distinct mentions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, let, small_side, stored

#: The patterns of the kinds. A number with 13 to 19 digits is a card only if its check digit is right.
#: A mail address starts at a letter or digit, also after punctuation; inside a run of its characters only after another address, so that a
#: run is read once. Its domain (127 labels at most, as in DNS) ends at the last label of letters.
EMAIL = (
    r"(?<![A-Za-z0-9])(?:(?<![A-Za-z0-9][._%+-]{1,8})|(?<=@[A-Za-z0-9.-]{1,255}[._%+-]{1,8}))"
    r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,126}\.[A-Za-z]{2,}"
)
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_LOCAL = r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
#: Long and international numbers end before a number that is whole by itself.
_NEXT = rf"(?!{_SSN}|{_LOCAL})"
SSN = rf"(?<![0-9A-Za-z-]){_SSN}"
PHONE = rf"(?<![0-9A-Za-z+])(?:\+[0-9]{{1,3}}[ .-]?)?{_LOCAL}|\+[0-9]{{1,3}}(?:[ .-]?{_NEXT}\(?[0-9]{{2,4}}\)?){{2,5}}(?![0-9A-Za-z])"
CARD = rf"(?<![0-9A-Za-z])[0-9](?:[0-9]|[ -]{_NEXT}[0-9]){{12,18}}(?![0-9A-Za-z])"
#: Country codes of one and two digits; all others have three.
COUNTRY = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}|[0-9]{1,2}"
MALE = "Mr|Sir|Herr|Monsieur|Señor|Sr|г-н|κ"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа|κα"
NEUTRAL = "Dr|Prof"
_TITLE = rf"(?:{MALE}|{FEMALE}|{NEUTRAL})\.? "
_PART = r"\p{Lu}(?:\p{L}|['’](?=\p{Lu}))+"
NAME = rf"(?<!\p{{L}}){_TITLE}{_PART}(?:(?: \p{{Lu}}\.)? {_PART}|-{_PART})?"
ANY = "|".join(f"(?:{p})" for p in (EMAIL, IP, SSN, PHONE, CARD, NAME))
#: What every match holds.
SIEVE = rf"@|[0-9]\.[0-9]|[0-9]{{3}}|[0-9][ -][0-9]|\+[0-9]|{_TITLE}\p{{Lu}}"
_NAME_PARTS = rf"^({_TITLE})({_PART})(?:((?: \p{{Lu}}\.)?[ -])({_PART}))?$"

#: Frequent given names, by which a name without a gendered title gets its gender.
GIVEN_MALE = "adam alexander andreas antonio boris carlos charles daniel david diego dmitri eric felix francois george hans henry igor ivan james jean john jose juan karl lars louis luis marco mark martin michael miguel nikolai oleg paul pedro peter pierre robert sergei stefan thomas victor walter william иван борис олег сергей николай".split()
GIVEN_FEMALE = "alice ana anna barbara camille carmen catherine charlotte claire elena elizabeth emma eva greta hannah helen ines ingrid irina isabel jane jeanne julia karin laura linda lucia maria marie martha mary monika natalia nina olga paula petra rosa sarah sofia susan tatiana teresa ursula vera анна ольга елена нина вера мария".split()
#: Parts that names are put together from, by script: heads, middles, and endings by gender (given names) or of all (surnames).
GIVEN = {
    "latin": (
        "al ber con dar el fer gil har is jor kel lor mar nor os per rod sel tor val wen".split(), "a de i la lo mi na o ra ri sa te".split(),
        {"m": "bert drick fred gar lan mund nard rick son ton vin ward".split(), "f": "anna bella dina etta gina lina lotta mira nella rina tilda wina".split(), "n": "den ley lin ren ris sey ven zen".split()},
    ),
    "cyrillic": ("ар бор вад гер дар ев жен зор кар лад мир нов рад свет тим".split(), "а ви де ле ми на ра та".split(), {"m": "слав мир гор тин сим лан".split(), "f": "слава мила рина лина тина дана".split(), "n": "ша ня ля".split()}),
    "greek": ("αλ βασ γερ δαμ ευ ηρ θεο καλ λεα μελ νικ ορ".split(), "α ε ι λα νο ρι".split(), {"m": "ανος ιας ωνας ιππος".split(), "f": "ανη ινα ωνη ιππη".split(), "n": "ις ων".split()}),
}
SURNAMES = {
    "latin": (
        "ash black brad brook carl clay crom dal east fair far glen green hal ham har holm kirk lang lin lock mar mill nor oak pem rad red rock shel stan stock thorn wal wat whit win wood".split(),
        ["", *"a den der e en er in ing ister o ov".split()],
        "berg borough bridge brook burn bury by combe cott croft dale feld field ford gate ham hurst land low man mere mont more port ridge shaw son stead stone thwaite ton wall ward water well wick wood worth".split(),
    ),
    "cyrillic": ("бар вол гор дар ер жар зим кар лаз мир нов ор пет руд сав тих уш фад хар чер".split(), ["", *"ак ан ар ат ен ин ош ук".split()], "ев ин ов".split()),
    "greek": ("αλεξ βασ γεωργ δημ ηλι καλ λαμπ μαρ νικ παπ σταμ τσακ χρηστ".split(), ["", *"αν ατ ελ ιν ουλ".split()], "ακης ιδης οπουλος ατος".split()),
}
ATTEMPTS = 60
#: From this attempt on addresses, phone and social-security numbers needn't keep their length, so that no format runs out of values.
WIDER = 8


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits."""
    twice = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    at = lambda s, i: F.substring(s, i, F.lit(1)).cast("int")
    one = lambda s: F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda acc, i: acc + F.when((F.length(s) - i) % 2 == 1, twice(at(s, i))).otherwise(at(s, i)))
    return let(digits, lambda s: F.when(F.length(s) > 0, one(s)).otherwise(F.lit(0)))


def kind_of(mention: Column) -> Column:
    """The kind of a match; null for a long number that is no card, neither whole nor without its last group (a code beside it)."""
    shorter = F.regexp_replace(mention, "[ -][0-9]+$", "")
    card = (_luhn(_digits(mention)) % 10 == 0) | ((F.length(_digits(shorter)) >= 13) & (_luhn(_digits(shorter)) % 10 == 0))
    return (
        F.when(mention.contains("@"), F.lit("email"))
        .when(mention.rlike(rf"^{IP}$"), F.lit("ip"))
        .when(mention.rlike(r"^\p{L}"), F.lit("name"))
        .when(mention.rlike(rf"^(?:{SSN})$"), F.lit("ssn"))
        .when(mention.rlike(rf"^(?:{PHONE})$"), F.lit("phone"))
        .when(card, F.lit("card"))
    )


def _part(mention: Column, k: int) -> Column:
    return F.regexp_extract(mention, _NAME_PARTS, k)


def _gender(title: Column) -> Column:
    return F.when(title.rlike(rf"^(?:{FEMALE})(?!\p{{L}})"), "f").when(title.rlike(rf"^(?:{MALE})(?!\p{{L}})"), "m").otherwise("n")


def _surname(part: Column) -> Column:
    """A surname's entity: in lower case, Cyrillic ones without the feminine ending."""
    return F.regexp_replace(F.lower(part), "(?<=[ое]в|[иы]н)а$", "")


def entities_of(kind: Column, mention: Column) -> Column:
    """array<string>: the entities a mention shows, as kind|value; a name with two parts has two."""
    country = F.when(mention.startswith("+"), F.regexp_extract(_digits(mention), rf"^({COUNTRY})", 1)).otherwise("1")
    national = F.when(mention.startswith("+"), F.substring(_digits(mention), F.length(country) + 1, F.length(mention))).otherwise(_digits(mention))
    first, last = F.lower(_part(mention, 2)), _part(mention, 4)
    titled = _gender(_part(mention, 1))
    gender = F.when(titled != "n", titled).when(first.isin(GIVEN_MALE), "m").when(first.isin(GIVEN_FEMALE), "f").otherwise("n")
    surname = lambda part: F.concat(F.lit("surname|"), _surname(part))
    given = F.when(_part(mention, 3) == "-", surname(_part(mention, 2))).otherwise(F.concat(F.lit("given|"), first, F.lit("|"), gender))
    names = F.when(last == "", F.array(surname(_part(mention, 2)))).otherwise(F.array(given, surname(last)))
    return (
        F.when(kind == "name", names)
        .when(kind == "email", F.array(F.concat(F.lit("email|"), F.lower(mention))))
        .when(kind == "ip", F.array(F.concat(F.lit("ip|"), mention)))
        .when(kind == "phone", F.array(F.concat(F.lit("phone|"), country, F.lit("|"), national)))
        .when(kind.isNotNull(), F.array(F.concat(kind, F.lit("|"), _digits(mention))))
    )


def _draw(seed: Column, i: Column, letters: str) -> Column:
    return F.substring(F.lit(letters), (F.pmod(F.xxhash64(seed, i), F.lit(len(letters))) + 1).cast("int"), F.lit(1))


def _word(seed: Column, number: int, words: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64(seed, F.lit(number)), F.lit(len(words))) + 1).cast("int"))


def _letter(seed: Column, c: Column, i: Column) -> Column:
    """A letter of the same sound as a lower-case c; digits as digits; other characters as they are."""
    return F.when(c.rlike("[aeiouy]"), _draw(seed, i, "aeiou")).when(c.rlike("[a-z]"), _draw(seed, i, "bcdfghklmnprstvz")).when(c.rlike("[0-9]"), _draw(seed, i, "0123456789")).otherwise(c)


def _script(value: Column, build) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), build("cyrillic")).when(value.rlike(r"\p{IsGreek}"), build("greek")).otherwise(build("latin"))


#: The bytes of a block of SHA-256, which a key is padded to.
_BLOCK = 64


def key_table(spark: SparkSession, key: str) -> DataFrame:
    """One row (inner, outer): the key's two pads of HMAC-SHA256. As data of a table they stand in no plan, log or page of the session."""
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > _BLOCK else raw).ljust(_BLOCK, b"\0")
    pads = bytes(x ^ 0x36 for x in raw), bytes(x ^ 0x5C for x in raw)
    return F.broadcast(spark.createDataFrame([(pads,)], "__key struct<inner:binary,outer:binary>"))


def _seed(entity: Column, attempt: Column, key: Column) -> Column:
    """HMAC-SHA256 of an entity and an attempt."""
    inner = F.unhex(F.sha2(F.concat(key["inner"], F.concat_ws("|", entity, attempt.cast("string")).cast("binary")), 256))
    return F.sha2(F.concat(key["outer"], inner), 256)


def stem_of(entity: Column, attempt: Column, key: Column) -> Column:
    """The surrogate of an entity in its plainest form: lower case, digits only. ``key`` is the column of ``key_table``."""

    def made(x: Column) -> Column:
        s, attempt, kind, value = x["s"], x["a"], x["k"], x["v"]
        stream = lambda n: F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _draw(s, i, "0123456789")), "")
        digit = lambda letters: _draw(s, F.lit(0), letters)
        # more middles where a short one collides
        middles = lambda words: F.array_join(F.transform(F.sequence(F.lit(0), F.floor(attempt / 4).cast("int")), lambda i: F.when(i == 0, F.lit("")).otherwise(F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64(s, i + 100), F.lit(len(words))) + 1).cast("int")))), "")
        gender = F.substring(value, -1, 1)
        given = lambda script: F.concat(_word(s, 1, GIVEN[script][0]), middles(GIVEN[script][1]), F.when(gender == "m", _word(s, 3, GIVEN[script][2]["m"])).when(gender == "f", _word(s, 3, GIVEN[script][2]["f"])).otherwise(_word(s, 3, GIVEN[script][2]["n"])))
        surname = lambda script: F.concat(_word(s, 1, SURNAMES[script][0]), _word(s, 2, SURNAMES[script][1]), middles(SURNAMES[script][1][1:]), _word(s, 3, SURNAMES[script][2]))
        tail = F.regexp_extract(value, r"(\.[a-z]+)$", 1)
        fresh = F.array_join(F.transform(F.split(F.substring(value, F.lit(1), F.length(value) - F.length(tail)), ""), lambda c, i: _letter(s, c, i)), "")
        longer = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(attempt - WIDER + 1, F.lit(0))), lambda i: F.when(i == 0, F.lit("")).otherwise(_draw(s, i + 500, "bcdfghklmnprstvz"))), "")
        octet = lambda c, i: F.when(attempt >= WIDER, F.pmod(F.xxhash64(s, i), F.lit(256))).when(F.length(c) == 1, F.pmod(F.xxhash64(s, i), F.lit(10))).when(F.length(c) == 2, F.pmod(F.xxhash64(s, i), F.lit(90)) + 10).otherwise(F.pmod(F.xxhash64(s, i), F.lit(156)) + 100).cast("string")
        head = let(F.concat(F.substring(value, 1, 1), F.substring(stream(F.length(value)), F.lit(1), F.length(value) - 2)), lambda h: F.concat(h, F.pmod(-_luhn(F.concat(h, F.lit("0"))), F.lit(10)).cast("string")))
        country = F.substring_index(value, "|", 1)
        extra = F.greatest(attempt - WIDER + 1, F.lit(0))  # digits that a wider draw puts behind
        national = F.length(value) - F.length(country) - 1 + extra
        return (
            F.when(kind == "email", F.concat(longer, fresh, tail))
            .when(kind == "ip", F.array_join(F.transform(F.split(value, r"\."), octet), "."))
            .when(kind == "phone", F.concat(country, F.lit("|"), digit("23456789"), F.substring(stream(national), F.lit(2), national)))
            .when(kind == "card", head)
            .when(kind == "ssn", stream(F.length(value) + extra))
            .when(kind == "given", _script(value, given))
            .when(kind == "surname", _script(value, surname))
        )

    kind = F.substring_index(entity, "|", 1)
    told = F.struct(_seed(entity, attempt, key).alias("s"), attempt.cast("int").alias("a"), kind.alias("k"), F.substring(entity, F.length(kind) + 2, F.length(entity)).alias("v"))
    return let(told, made)


def _fill(mention: Column, digits: Column) -> Column:
    """``mention`` with its digits replaced in order, and what is over of ``digits`` behind."""
    start = F.struct(F.lit(0).alias("k"), F.lit("").alias("out"))

    def one(x: Column) -> Column:
        step = lambda acc, c: F.struct((acc["k"] + c.rlike("[0-9]").cast("int")).alias("k"), F.concat(acc["out"], F.when(c.rlike("[0-9]"), F.substring(x["d"], acc["k"] + 1, F.lit(1))).otherwise(c)).alias("out"))
        return F.aggregate(F.split(x["m"], ""), start, step, lambda acc: F.concat(acc["out"], F.substring(x["d"], acc["k"] + 1, F.length(x["d"]))))

    return let(F.struct(mention.alias("m"), digits.alias("d")), one)


def _cased(like: Column, stem: Column) -> Column:
    """A name in the case of another: all capitals, or a capital first."""
    return F.when((F.length(like) > 1) & (like == F.upper(like)), F.upper(stem)).otherwise(F.concat(F.upper(F.substring(stem, 1, 1)), F.substring(stem, F.lit(2), F.length(stem))))


def rendered(kind: Column, mention: Column, stems: Column) -> Column:
    """The stems of a mention's entities in the mention's own format."""
    first, phone = F.get(stems, F.lit(0)), F.get(stems, F.lit(0))
    longer = F.length(first) - F.length(mention)  # letters that a wider draw put in front
    place = lambda i: F.substring(mention, i + 1 - longer, F.lit(1))
    email = F.array_join(F.transform(F.split(first, ""), lambda c, i: F.when((i >= longer) & (place(i) != F.lower(place(i))), F.upper(c)).otherwise(c)), "")
    feminine = lambda part, stem: F.when((_gender(_part(mention, 1)) == "f") & stem.rlike("[ое]в$|[иы]н$"), F.concat(stem, F.lit("а"))).otherwise(stem)
    surname = lambda k, at: _cased(_part(mention, k), feminine(_part(mention, k), F.get(stems, F.lit(at))))
    lead = F.when(_part(mention, 3) == "-", surname(2, 0)).otherwise(_cased(_part(mention, 2), first))
    name = F.concat(_part(mention, 1), F.when(_part(mention, 4) == "", surname(2, 0)).otherwise(F.concat(lead, _part(mention, 3), surname(4, 1))))
    number = F.when(mention.startswith("+"), F.replace(phone, F.lit("|"), F.lit(""))).otherwise(F.substring_index(phone, "|", -1))
    return F.when(kind == "email", email).when(kind == "ip", first).when(kind == "name", name).when(kind == "phone", _fill(mention, number)).when(kind.isNotNull(), _fill(mention, first)).otherwise(mention)


def _mentions(text: Column) -> Column:
    return F.when(text.rlike(SIEVE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _described(mentions: Column) -> Column:
    """array<struct<kind, mention, entities>>, kind and entities null for what is left as it is."""
    kinds = F.transform(mentions, lambda m: F.struct(kind_of(m).alias("kind"), m.alias("mention")))
    return F.transform(kinds, lambda x: F.struct(x["kind"].alias("kind"), x["mention"].alias("mention"), entities_of(x["kind"], x["mention"]).alias("entities")))


def retries(entities: DataFrame, key: str) -> DataFrame:
    """(entity, own, attempt) for each distinct ``entity``: what it counts as, and the attempt at which that has a stem of its own.

    A given name without gender counts as the gendered one if the corpus has it with one gender only. Attempts rise only for
    those that share a stem with another (all but the least of them) or whose stem is a real value of the corpus.
    """
    seen = stored(entities.select("entity").distinct(), "entities")
    name = F.regexp_replace("entity", r"\|[mfn]$", "")
    genders = seen.filter("entity like 'given|%'").groupBy(name.alias("name")).agg(F.max(F.col("entity").endswith("|m").cast("int")).alias("m"), F.max(F.col("entity").endswith("|f").cast("int")).alias("f"))
    only = genders.filter("m + f = 1").select(F.concat("name", F.lit("|n")).alias("entity"), F.concat("name", F.when(F.col("m") == 1, "|m").otherwise("|f")).alias("own"))
    counted = stored(seen.join(only, "entity", "left").select("entity", F.coalesce("own", "entity").alias("own")), "counted")
    kind = F.substring_index("own", "|", 1)
    value = F.regexp_replace(F.substring("own", F.length(kind) + 2, F.length("own")), F.when(kind == "given", r"\|[mfn]$").otherwise("$^x"), F.lit(""))
    now = counted.select("own").distinct().withColumn("attempt", F.lit(0))
    real = counted.select(kind.alias("kind"), value.alias("stem")).distinct().withColumn("real", F.lit(True))
    keys, last = key_table(entities.sparkSession, key), None
    for _ in range(ATTEMPTS):
        given = now.crossJoin(keys).withColumns({"kind": kind, "stem": stem_of(F.col("own"), F.col("attempt"), F.col("__key"))}).drop("__key")  # one row
        # what keeps its attempt goes before what draws again, so that settled entities stay settled
        first = given.groupBy("kind", "stem").agg(F.min(F.struct("attempt", "own")).alias("first"), F.count("*").alias("n"))
        marked = given.join(first, ["kind", "stem"]).join(real, ["kind", "stem"], "left")
        bad = F.coalesce(F.col("real"), F.lit(False)) | ((F.col("n") > 1) & (F.col("first.own") != F.col("own")))
        after = stored(marked.select("own", "attempt", bad.alias("bad")), "attempts")
        if last is not None:
            discard(last)
        last = after
        if after.filter("bad").isEmpty():
            now = after
            break
        now = after.select("own", (F.col("attempt") + F.col("bad").cast("int")).alias("attempt"))
    else:
        raise RuntimeError("surrogates still collide: the corpus holds most values of a kind")
    return counted.join(now.select("own", "attempt"), "own").select("entity", "own", "attempt")


def replace_personal_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_entities, text) per row of ``docs``: the text with mail and IP addresses, card, social-security and phone numbers
    and titled names replaced by surrogates that only the holder of ``key`` can make again.

    Surrogates keep kind and format: numbers and addresses their length (but where a format has too few values), cards the first
    digit and a right check digit, mail addresses the last label, names script, case, parts and gender. Equal entities get
    equal surrogates in all rows, whatever a mention's title, spacing, case or (for ten digits) country code +1; different ones get
    different surrogates, and none gets a value that the corpus holds. Where a format has too few values left, numbers get longer. A given name counts with the gender of its title, else of
    the other mentions, else as a neutral one. n_entities counts the mentions. A null text stays null, with 0. Null ids and repeated
    rows are returned as they come; an empty table gives an empty result; other columns are ignored.

    The result reads texts stored in the shared folder, with what was found in them; run it inside ``common.scratch``, which removes them.
    """
    if not key:
        raise ValueError("a secret key is needed")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # texts are searched once; what was found is stored beside them
    found = stored(own.withColumn("found", _described(_mentions(F.coalesce("text", F.lit(""))))), "mentions")
    shown = lambda column: F.flatten(F.transform(F.filter(column, lambda e: e["kind"].isNotNull()), lambda e: e["entities"]))
    entities = found.select(F.explode(F.array_distinct(shown(F.col("found")))).alias("entity"))
    again = stored(retries(entities, key).filter("attempt > 0 or own <> entity"), "retries")
    size = again.agg(F.count("*").alias("n"), F.sum(F.octet_length("entity") + F.octet_length("own")).alias("bytes")).first()
    if not size["n"]:
        found = found.withColumn("again", F.create_map().cast("map<string,struct<own:string,attempt:int>>"))
    else:
        # rows with equal texts need the same: a map per text, not per id
        mark = F.struct(F.xxhash64("text").alias("a"), F.crc32(F.col("text").cast("binary")).alias("b"))
        found = found.withColumn("mark", mark)
        hits = found.select("mark", F.explode(F.array_distinct(shown(F.col("found")))).alias("entity")).join(small_side(again, size["n"], size["bytes"]), "entity").distinct()
        maps = stored(hits.groupBy("mark").agg(F.map_from_entries(F.collect_list(F.struct("entity", F.struct("own", F.col("attempt").cast("int").alias("attempt"))))).alias("again")), "maps")
        n = maps.agg(F.count("*").alias("n"), F.sum(F.size("again")).alias("entries")).first()
        found = found.join(small_side(maps, n["n"], 100 * (n["entries"] or 0)), "mark", "left")

    def fresh(e: Column) -> Column:
        def stem(entity: Column) -> Column:
            return let(F.struct(entity.alias("e"), F.try_element_at(F.col("again"), entity).alias("r")), lambda x: stem_of(F.coalesce(x["r"]["own"], x["e"]), F.coalesce(x["r"]["attempt"], F.lit(0)), F.col("__key")))

        return let(F.struct(e.alias("e"), F.transform(e["entities"], stem).alias("s")), lambda x: rendered(x["e"]["kind"], x["e"]["mention"], x["s"]))

    found = found.crossJoin(key_table(docs.sparkSession, key))  # one row
    made = F.transform("found", lambda e: F.when(e["kind"].isNull(), e["mention"]).otherwise(fresh(e)))
    replaced = F.array_join(F.zip_with(F.split("text", ANY, -1), made, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    number = F.size(F.filter("found", lambda e: e["kind"].isNotNull()))
    return found.select("doc_id", number.alias("n_entities"), F.when(number > 0, replaced).otherwise(F.col("text")).alias("text"))
