"""PII surrogates: what identifies a person or opens an account is replaced by something of the same kind.

Found are mail addresses, phone, card (with a right check digit), social security and bank account
numbers (likewise), IPv4 addresses, access keys and passwords behind their word, and names behind a
title. A surrogate is drawn from a hash of a secret key, the kind and the entity in one spelling, so the
same entity has the same surrogate in every document and spelling (coreference). It keeps length, letter
case, digits, separators, country code and card issuer where the kind has them, holds right check
digits, and names keep script and gender. Draws are checked against each other and against all found
entities; who collides draws again, so different entities stay different and none becomes another's name.

A word of a name is one entity in its script, whatever title it follows or place it has in a name, so first and
family names are kept apart too. It is drawn as what it is most often in all documents: a family name (the last
word behind a title), or a first name of the gender its titles tell. Where a document names somebody behind a
title, the same capitalised words are replaced elsewhere in it too. Names are drawn in Latin, Cyrillic, Greek,
Armenian and Georgian; those of other scripts with capitals become Latin ones. Names in scripts that have no
capitals, but for Georgian, are not found.

Only SQL functions are used. Documents without an entity are passed through; those with one are written
once with their text cut at the entities, and only mentions are joined with the table of surrogates.

Defined cases: a null text stays null, an empty one empty; repeated rows are each rewritten; numbers with a
wrong check digit are no entities; an empty table gives no rows. All columns come back as they were,
but for ``text``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import written_once

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
SECRET_WORD = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Sr", "Señor", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Sra", "Señora", "г-жа", "κα"],
    "x": ["Dr", "Prof"],
}
# A possessive s is no part of a name, nor is a quotation mark beside it.
JOINT = r"['’-](?!s(?!\p{L}))"
NAME = rf"[\p{{Lu}}\p{{IsGeorgian}}](?=(?:{JOINT})?\p{{L}})\p{{L}}*+(?:{JOINT}\p{{L}}++){{0,3}}"
BEFORE_NAME = r"(?<![\p{L}\p{M}\p{N}_]|\p{L}['’-])"
AFTER_NAME = rf"(?![\p{{L}}\p{{M}}\p{{N}}_]|{JOINT}\p{{L}})"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "secret": rf"(?<![A-Za-z0-9]){SECRET_WORD}[A-Za-z0-9+/_-]{{12,}}",
    "key": r"(?<![A-Za-z0-9])A(?:KIA|SIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9A-Za-z.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])",
    "person": rf"(?<!\p{{L}})(?:{'|'.join(t for ts in TITLES.values() for t in ts)})\.? {NAME}(?: {NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
KIND_TESTS = [
    ("email", "@"),
    ("secret", f"^{SECRET_WORD}"),
    ("key", "^A(?:KIA|SIA)[0-9A-Z]{16}$"),
    ("iban", "^[A-Z]{2}[0-9]{2}"),
    ("ip", rf"^(?:{OCTET}\.){{3}}{OCTET}$"),
    ("ssn", "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
    ("card", "^[0-9](?:[ -]?[0-9]){12,18}$"),
    ("phone", "^[+(0-9]"),
]
# Syllables and endings that names are drawn from, by script: female, male, either, family name.
SCRIPTS = {"cyrillic": "Cyrillic", "greek": "Greek", "armenian": "Armenian", "georgian": "Georgian"}
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga go ha he ja jo ka ke ki ko la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se si so ta te ti to va ve vi",
    "cyrillic": "ба бе би бо да де ди до за зе ка ке ки ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро са се си со та те ти то ва ве ви",
    "greek": "βα βε βι γα γε δα δε δι ζα ζε θα θε κα κε κι λα λε λι μα με μι να νε νι πα πε πι ρα ρε ρι σα σε σι τα τε τι φα φε φι",
    "armenian": "բա բե բի գա գե գի դա դե դի զա զե կա կե կի լա լե լի մա մե մի նա նե նի պա պե պի ռա ռե ռի սա սե սի տա տե տի վա վե վի",
    "georgian": "ბა ბე ბი გა გე გი და დე დი ზა ზე კა კე კი ლა ლე ლი მა მე მი ნა ნე ნი პა პე პი რა რე რი სა სე სი ტა ტე ტი ვა ვე ვი",
}
ENDINGS = {
    "latin": {"f": "na lia ra tta", "m": "n rd s l", "x": "lin ren rin ton", "surname": "ner son ley mann"},
    "cyrillic": {"f": "на лия ра та", "m": "н р с л", "x": "ша ня ля ся", "surname": "енко ук ых ко"},
    "greek": {"f": "να λία ρα τα", "m": "νος ρης λος της", "x": "νι λι ρι τι", "surname": "ίδη άκη ίου έα"},
    "armenian": {"f": "նուշ նե իկ ուհի", "m": "ն մ կ գ", "x": "լի րի նի սի", "surname": "յան ունի ենց ուց"},
    "georgian": {"f": "ნა კო ია ლა", "m": "რი ზი გი ნი", "x": "ლო შო ტო ქო", "surname": "ძე შვილი ური ია"},
}
MAX_DRAWS = 40


def surrogates_for(docs: DataFrame, key: str, count_as: str | None = None) -> DataFrame:
    """``docs`` with entities in ``text`` replaced; ``count_as`` names a column for their number."""
    own = [c for c in docs.columns if c != count_as]
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("kept"), F.col("text").cast("string").alias("said"))
    has = F.coalesce(may_hold(F.col("said")) & F.col("said").rlike(ANY), F.lit(False))
    cut = held.where(has).select(
        "kept", F.split("said", ANY, -1).alias("gaps"), F.regexp_extract_all("said", F.lit(ANY), F.lit(0)).alias("found")
    )
    marked = written_once(with_untitled(cut).withColumn("row", F.monotonically_increasing_id()), "pii-marked")
    mentions = (
        marked.select("row", F.posexplode("found").alias("pos", "mention"))
        .select("row", "pos", F.posexplode(units(F.col("mention"))).alias("sub", "unit"))
        .select("row", "pos", "sub", "unit.*")
    )
    table = surrogate_table(entities_of(mentions.where("kind IS NOT NULL")), key)
    # Both sides are plain tables here, so that the partition of a very frequent entity can be split.
    known = mentions.where("kind IS NOT NULL").join(table, ["kind", "entity"])
    spoken = known.select("row", "pos", "sub", "before", dressed("kind", "form", "surrogate").alias("out"), F.lit(1).alias("n"))
    plain = mentions.where("kind IS NULL").select("row", "pos", "sub", "before", F.col("form").alias("out"), F.lit(0).alias("n"))
    by_row = spoken.unionByName(plain).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("pos", "sub", "before", "out"))).alias("parts"), F.sum("n").alias("n")
    )
    gap = lambda p: F.when(p["sub"] == 0, F.element_at("gaps", p["pos"] + 1)).otherwise(F.lit(""))
    text = F.concat(
        F.array_join(F.transform("parts", lambda p: F.concat(gap(p), p["before"], p["out"])), ""),
        F.element_at("gaps", -1),
    )
    changed = marked.join(by_row, "row").select("kept", text.alias("said"), F.col("n").cast("long"))
    same = held.where(~has).select("kept", "said", F.lit(0).cast("long").alias("n"))
    columns = [F.col("said").alias("text") if c == "text" else F.col("kept")[c].alias(c) for c in own]
    counted = [F.col("n").alias(count_as)] if count_as else []
    return changed.unionByName(same).select(*columns, *counted)


def may_hold(text: Column) -> Column:
    """What every text with an entity fulfils, found much faster than the entities: a sign that numbers,
    addresses and passwords have, the beginning of a key, or a title."""
    holds = text.rlike("[@0-9=:]")
    for word in ["AKIA", "ASIA", *(title for titles in TITLES.values() for title in titles)]:
        holds = holds | F.contains(text, F.lit(word))
    return holds


def with_untitled(cut: DataFrame) -> DataFrame:
    """``gaps`` and ``found`` cut again where a word of a name that ``found`` has behind a title stands without one."""
    # Names have letters, apostrophes and hyphens only, so they are patterns of themselves.
    words = F.flatten(F.transform(F.filter("found", is_person), lambda m: F.slice(F.split(m, " "), 2, F.size(F.split(m, " ")))))
    names = F.array_join(F.array_distinct(words), "|")
    pattern = F.when(names == "", "(?!)").otherwise(F.concat(F.lit(f"{BEFORE_NAME}(?:"), names, F.lit(f"){AFTER_NAME}")))
    cut = cut.withColumn("names", pattern)
    entity_after = lambda i: F.when(i < F.size("found"), F.array(F.get("found", i))).otherwise(F.array().cast("array<string>"))
    found = F.transform("gaps", lambda g, i: F.concat(F.regexp_extract_all(g, F.col("names"), F.lit(0)), entity_after(i)))
    gaps = F.transform("gaps", lambda g: F.split(g, F.col("names"), -1))
    return cut.select("kept", F.flatten(gaps).alias("gaps"), F.flatten(found).alias("found"))


def is_person(mention: Column) -> Column:
    return mention.rlike(f"^{PATTERNS['person']}$")


def units(mention: Column) -> Column:
    """What of a mention is replaced: structs of kind, entity (one spelling), before (what stays), form and,
    for a name behind a title, the part it plays there.

    A name is a unit a word, the last one the family name, so that a shorter mention agrees with a longer.
    """
    digits = F.regexp_replace(mention, "[^0-9]", "")
    compact = F.upper(F.regexp_replace(mention, " ", ""))
    kind = F.when(is_person(mention), "person").otherwise("name")
    for name, pattern in reversed(KIND_TESTS):
        kind = F.when(mention.rlike(pattern), name).otherwise(kind)
    kind = F.when((kind == "card") & ~luhn_holds(digits), None).otherwise(kind)
    kind = F.when((kind == "iban") & (mod97(iban_order(compact)) != 1), None).otherwise(kind)
    before = F.when(kind == "secret", F.regexp_extract(mention, f"^{SECRET_WORD}", 0)).otherwise("")
    form = F.substr(mention, F.length(before) + 1)
    entity = (
        F.when(kind == "email", F.lower(mention))
        .when(kind == "phone", F.when(F.length(digits) > 10, F.right(digits, F.lit(10))).otherwise(digits))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "iban", compact)
        .otherwise(form)
    )
    none = F.lit(None).cast("string")
    unit = lambda k, e, b, f, p=none: F.struct(k.alias("kind"), e.alias("entity"), b.alias("before"), f.alias("form"), p.alias("part"))
    words = F.split(mention, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("x")
    last = F.size(words) - 2
    named = F.transform(
        F.slice(words, 2, F.size(words)),
        lambda w, i: unit(
            F.concat(script(w), F.lit(" name")),
            F.lower(w),
            F.when(i == 0, F.concat(words[0], F.lit(" "))).otherwise(" "),
            w,
            F.when(i == last, "surname").otherwise(gender),
        ),
    )
    untitled = unit(F.concat(script(mention), F.lit(" name")), F.lower(mention), F.lit(""), mention)
    return F.when(kind == "person", named).when(kind == "name", F.array(untitled)).otherwise(F.array(unit(kind, entity, before, form)))


def script(word: Column) -> Column:
    found = F.lit("latin")
    for name, block in SCRIPTS.items():
        found = F.when(word.rlike(rf"\p{{Is{block}}}"), name).otherwise(found)
    return found


def entities_of(mentions: DataFrame) -> DataFrame:
    """(kind, entity, part) for each entity of the mentions, with what a name is most often: a family name, or a
    first name (ties: family) of the gender of most titles (ties: either). Other kinds have no part."""
    plays = lambda *parts: F.count_if(F.col("part").isin(*parts))
    counted = mentions.groupBy("kind", "entity").agg(plays("surname").alias("s"), plays("m").alias("m"), plays("f").alias("f"), plays("m", "f", "x").alias("first"))
    gender = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("x")
    part = F.when(~F.col("kind").contains(" "), "").when(F.col("s") >= F.col("first"), "surname").otherwise(gender)
    return counted.select("kind", "entity", part.alias("part"))


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity) with a part; no surrogate twice in a kind, and none
    that is an entity of it. Draws of each round are kept where nobody else holds or draws them."""
    open_ = written_once(entities, "pii-entities")
    every, settled, rounds = open_, None, 0
    while True:
        drawn = written_once(open_.withColumn("surrogate", draw("kind", "entity", "part", key, rounds)), "pii-drawn")
        free = drawn.join(
            every.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_anti"
        )
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        winners = free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        won = winners.select("kind", "entity", "surrogate")
        settled = written_once(won if settled is None else settled.unionByName(won), "pii-surrogates")
        open_ = written_once(drawn.drop("surrogate").join(settled, ["kind", "entity"], "left_anti"), "pii-open")
        rounds += 1
        if open_.limit(1).count() == 0:
            return settled
        if rounds == MAX_DRAWS:
            raise ValueError(f"no free surrogates for {open_.first()['kind']}")


def draw(kind: str, entity: str, part: str, key: str, round_: int) -> Column:
    """The surrogate of an entity in one spelling, from a keyed hash."""
    kind, entity, part = F.col(kind), F.col(entity), F.col(part)
    hash_ = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, F.lit(str(round_))), 256)
    byte = lambda i: F.conv(F.substr(hash_, 1 + 2 * ((i if isinstance(i, Column) else F.lit(i)) % 32), F.lit(2)), 16, 10).cast("int")
    digit = lambda i, low=0, n=10: (low + byte(i) % n).cast("string")
    hexadecimal = entity.rlike("^[0-9a-f]+$") | entity.rlike("^[0-9A-F]+$")

    def like(text: Column, first: int = 1) -> Column:
        """``text`` with other digits and letters of the same case, from its ``first`` character on."""
        letters = F.when(hexadecimal, 6).otherwise(26)

        def other(c: Column, i: Column) -> Column:
            # A second hash character keeps texts of more than 32 characters from repeating.
            number = byte(i) + 3 * byte(i + 5 + i / 32)
            return (
                F.when(i < first - 1, c)
                .when(c.rlike("[0-9]"), F.char((48 + number % 10).cast("int")))
                .when(c.rlike("[a-z]"), F.char((97 + number % letters).cast("int")))
                .when(c.rlike("[A-Z]"), F.char((65 + number % letters).cast("int")))
                .otherwise(c)
            )

        return F.array_join(F.transform(F.split(text, ""), other), "")

    local = F.substring_index(entity, "@", 1)
    top = F.regexp_extract(entity, r"\.([a-z]+)$", 1)
    domain = F.concat(
        *(F.char(97 + byte(i) % 26) for i in range(20, 26)),
        F.lit(".example."),
        F.when(top.isin("com", "net", "org"), top).otherwise("com"),
    )
    private = entity.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")
    ip = F.concat_ws(".", F.when(private, "10").otherwise(digit(0, 20, 80)), digit(1, 0, 256), digit(2, 0, 256), digit(3, 1, 254))
    card = F.concat(F.left(entity, F.lit(1)), F.substr(like(entity), F.lit(2), F.length(entity) - 2))
    ssn = F.concat(digit(0, 1, 8), digit(1), digit(2, 1, 5), digit(3), digit(4, 1, 9), digit(5), digit(6), digit(7), digit(8, 1, 9))
    phone = F.when(
        F.length(entity) == 10, F.concat(digit(0, 2, 8), digit(1), digit(2), digit(3, 2, 8), F.substr(like(entity), F.lit(5)))
    ).otherwise(F.concat(digit(0, 1, 9), F.substr(like(entity), F.lit(2))))
    account = F.substr(like(entity), F.lit(5))
    country = F.left(entity, F.lit(2))
    check = F.lpad((98 - mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    found = (
        F.when(kind == "email", F.concat(like(local), F.lit("@"), domain))
        .when(kind == "ip", ip)
        .when(kind == "card", F.concat(card, luhn_digit(card)))
        .when(kind == "ssn", ssn)
        .when(kind == "phone", phone)
        .when(kind == "iban", F.concat(country, check, account))
        .when(kind == "key", like(entity, 5))
        .when(kind == "secret", like(entity))
    )
    for name, syllables in SYLLABLES.items():
        parts = F.split(F.lit(syllables), " ")
        stem = F.concat(*(parts[byte(i) % len(syllables.split())] for i in range(2 + (round_ + 1) // 2)))
        for role, endings in ENDINGS[name].items():
            ending = F.split(F.lit(endings), " ")[byte(31) % len(endings.split())]
            found = F.when((kind == f"{name} name") & (part == role), F.concat(stem, ending)).otherwise(found)
    return found


def dressed(kind: str, form: str, surrogate: str) -> Column:
    """The surrogate in the spelling of a mention: digits between its separators, or its letter case."""
    kind, form, surrogate = F.col(kind), F.col(form), F.col(surrogate)
    kept = F.length(F.regexp_replace(form, "[^0-9]", "")) - F.length(surrogate)  # a country code in front

    def put(pattern: str, skip: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), (1 - skip).cast("int").alias("at"))

        def step(held: Column, c: Column) -> Column:
            fits = c.rlike(pattern)
            new = F.when(fits & (held["at"] >= 1), F.substr(surrogate, held["at"], F.lit(1))).otherwise(c)
            return F.struct(
                F.concat(held["out"], new).alias("out"), (held["at"] + fits.cast("int")).cast("int").alias("at")
            )

        return F.aggregate(F.split(form, ""), start, step)["out"]

    named = (
        F.when((form == F.upper(form)) & (F.length(form) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    )
    return (
        F.when(kind.isin("phone", "card", "ssn"), put("[0-9]", kept))
        .when(kind == "iban", put("[0-9A-Z]", F.lit(0)))
        .when(kind.contains(" "), named)
        .otherwise(surrogate)
    )


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits from the right, where every second one, from ``doubled`` on, counts twice."""
    digit = lambda c: F.when((c == "") | c.isNull(), 0).otherwise(c.cast("int"))
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == doubled, F.floor(2 * digit(c) / 10).cast("int") + 2 * digit(c) % 10).otherwise(digit(c)),
    )
    return F.aggregate(each, F.lit(0), lambda s, d: s + d)


def luhn_holds(digits: Column) -> Column:
    return _luhn_sum(digits, 1) % 10 == 0


def luhn_digit(digits: Column) -> Column:
    """The check digit to put behind ``digits``."""
    return ((10 - _luhn_sum(digits, 0) % 10) % 10).cast("string")


def iban_order(iban: Column) -> Column:
    return F.concat(F.substr(iban, F.lit(5)), F.left(iban, F.lit(4)))


def mod97(text: Column) -> Column:
    """Remainder by 97 of a text of digits and capital letters, A standing for 10."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c.rlike("[0-9A-Z]")),
        F.lit(0),
        lambda r, c: F.when(c.rlike("[0-9]"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97),
    )
