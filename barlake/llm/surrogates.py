"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Entities of the whole corpus are collected once each, in a normal form that all their
mentions share, and get a surrogate of the same type from a keyed hash: a card number with a
valid check digit and the same first digit and length, a name of the same gender and script.
Surrogates that two entities share, or that are an entity themselves, are drawn again until
none are left, so distinct entities stay distinct. Every mention gets its entity's surrogate
in its own format: separators, brackets, case and titles stay.

Persons are found by their titles. Their full and family names are then replaced wherever
the same text has them without one. A family name has one surrogate, for all who bear it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import staged

# Titles and given names by gender and script.
TITLES = {
    ("m", "latin"): ("Mr", "Herr", "Señor", "Monsieur"),
    ("f", "latin"): ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme"),
    ("m", "cyrillic"): ("Господин", "г-н"),
    ("f", "cyrillic"): ("Госпожа", "г-жа"),
    ("m", "greek"): ("Κύριος",),
    ("f", "greek"): ("Κυρία",),
}
GIVEN = {
    ("m", "latin"): ("Adam", "Carlo", "Daniel", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Simon"),
    ("f", "latin"): ("Alice", "Clara", "Diana", "Emma", "Flora", "Helena", "Julia", "Laura", "Maria", "Nora", "Paula", "Sofia"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Игорь", "Марк", "Павел"),
    ("f", "cyrillic"): ("Алла", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
    ("m", "greek"): ("Ανδρέας", "Γιώργος", "Δημήτρης", "Νίκος", "Πέτρος"),
    ("f", "greek"): ("Άννα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
}
SYLLABLES = {
    "latin": ("ba", "de", "fi", "go", "ka", "le", "mi", "no", "pa", "re", "si", "to", "va", "we", "ri", "lu"),
    "cyrillic": ("ба", "ве", "ги", "до", "ка", "ле", "ми", "но", "па", "ре", "си", "то", "ва", "зе", "ри", "лу"),
    "greek": ("βα", "γε", "δι", "ζο", "κα", "λε", "μι", "νο", "πα", "ρε", "σι", "το", "φα", "χε", "ρι", "λυ"),
}
KEY = "surrogates-1"

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
IP = rf"(?<![A-Za-z0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
# Behind another country's code: single digits, so that the longest row of groups with 8 to 15
# digits is taken and a longer row is not lost. French numbers have nine behind the code.
PHONE = (
    r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|\+33[ .-]?(?:\(0\)[ .-]?)?[1-9](?:[ .-]?[0-9]{2}){4}(?![0-9])"
    r"|\+[2-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,2}\)(?:[ .-]?[0-9]){5,10}|\([0-9]{3,4}\)(?:[ .-]?[0-9]){4,8})(?![0-9])"
    r"|\+[2-9](?:[ .-]?[0-9]){7,14}(?![0-9])"
    r"|(?<![0-9(+])(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|(?<![0-9-])(?<![0-9]\.)[0-9]{3}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3} )[0-9]{4})(?![0-9-]|\.[0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = (
    r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
)
# A name ends before a possessive 's.
_WORD = r"\p{Lu}(?:\p{L}|-(?=\p{L})|'(?=\p{L})(?!s(?!\p{L}))){1,40}"
PERSON = (
    "(?<![\\p{L}])(?:" + "|".join(t for titles in TITLES.values() for t in titles) + rf")\.? {_WORD}(?: {_WORD})?"
)
ANY = "|".join((EMAIL, IP, PHONE, SSN, CARD, PERSON))
KINDS = ("email", "ip", "phone", "ssn", "card", "person")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """The weighted digit sum, the last digit doubled or not."""
    size = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((size - i) % 2 == (0 if doubled_last else 1), twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), lambda total, i: total + weighed(i))


def kind_of(mention: Column) -> Column:
    """The type of a matched text; null for one that only looks like an entity."""
    digits = _digits(mention)
    whole = lambda pattern: F.regexp_like(mention, F.lit(f"^(?:{pattern})$"))
    card = F.regexp_like(mention, F.lit("^[0-9 -]+$")) & (F.length(digits) >= 13)
    return (
        F.when(F.contains(mention, F.lit("@")), F.lit("email"))
        .when(F.startswith(mention, F.lit("+")), F.when(F.length(digits).between(8, 15), F.lit("phone")))
        .when(whole("[0-9]+(?:[.][0-9]+){3}"), F.lit("ip"))
        .when(whole(r"[0-9() .-]+") & (F.length(digits) == 10), F.lit("phone"))
        .when(whole("[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.lit("ssn"))
        .when(card, F.when(_luhn_sum(digits, False) % 10 == 0, F.lit("card")))
        .otherwise(F.lit("person"))
    )


_TITLE = "^(?:" + "|".join(t for titles in TITLES.values() for t in titles) + r")\.? "


def normal(kind: Column, mention: Column) -> Column:
    """What all mentions of an entity have in common."""
    title = F.regexp_replace(F.regexp_extract(mention, _TITLE, 0), "[. ]", "")
    group = F.lit("m|latin")
    for (gender, script), titles in TITLES.items():
        group = F.when(title.isin(*titles), F.lit(f"{gender}|{script}")).otherwise(group)
    name = F.lower(F.regexp_replace(mention, _TITLE, ""))
    return (
        F.when(kind == "email", F.lower(mention))
        # Ten digits without a country's are those behind +1.
        .when(kind == "phone", F.concat(F.when(F.startswith(mention, F.lit("+")), "+").otherwise("+1"), _digits(mention)))
        .when(kind == "ip", mention)
        .when(kind == "person", F.concat_ws("|", group, name))
        .otherwise(_digits(mention))
    )


# --- surrogates --------------------------------------------------------------------------


# The attempt from which on digits and addresses leave their reserved part, and the last one.
WIDE_FROM = 8
MOST_ATTEMPTS = 64
# Values of a digit and of an octet before that.
DIGITS = 10
OCTETS = 256


def surrogate(kind: Column, norm: Column, attempt: Column, key: str = KEY) -> Column:
    """The surrogate in normal form, from a keyed hash of type, entity and attempt."""
    first = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")), 256)
    bits = F.concat(first, F.sha2(F.concat(F.lit(key), first), 256), F.sha2(F.concat(first, F.lit(key)), 256))

    def byte(i: Column | int) -> Column:
        at = F.lit(i) if isinstance(i, int) else i
        return F.conv(F.substring(bits, 2 * at - 1, F.lit(2)), 16, 10).cast("int")

    # Short formats have a reserved part first; entities beyond it take the whole format.
    wide = attempt >= WIDE_FROM

    def digits(count: Column) -> Column:
        most = F.when(wide, 10).otherwise(DIGITS)
        return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: (byte(i) % most).cast("string")), "")

    def letters(start: int, count: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.char(97 + byte(start + i) % 26)), "")

    body = F.concat(F.substring(norm, 1, 1), digits(F.length(norm) - 2))
    card = F.concat(body, ((10 - _luhn_sum(body, True) % 10) % 10).cast("string"))
    phone = F.when(wide, F.concat(F.lit("+"), digits(F.length(norm) - 1))).otherwise(
        F.concat(F.substring(norm, 1, 2), digits(F.length(norm) - 2))
    )
    octet = F.when(wide, 256).otherwise(OCTETS)
    ip = F.concat_ws(
        ".", F.when(wide, byte(1)).otherwise(240 + byte(1) % 16).cast("string"), *[(byte(i) % octet).cast("string") for i in (2, 3, 4)]
    )
    ssn = F.when(wide, digits(F.lit(9))).otherwise(F.concat(F.lit("9"), digits(F.lit(8))))

    # Letters for letters, digits for digits, short ones lengthened; the reserved top domain
    # belongs to nobody.
    shaped = lambda text, start: F.array_join(
        F.transform(
            F.split(text, ""),
            lambda c, i: F.when(F.regexp_like(c, F.lit("[a-z]")), F.char(97 + byte(start + i % 32) % 26))
            .when(F.regexp_like(c, F.lit("[0-9]")), (byte(start + i % 32) % 10).cast("string"))
            .otherwise(c),
        ),
        "",
    )
    local = F.regexp_extract(norm, "^[^@]*", 0)
    domain = F.regexp_extract(norm, r"@(.*)\.[^.]*$", 1)
    email = F.concat(
        shaped(local, 1), letters(64, F.greatest(8 - F.length(local), F.lit(2))), F.lit("@"), shaped(domain, 33), F.lit(".example")
    )

    # Names grow with every attempt, so that they outnumber any number of entities.
    parts = F.split(norm, r"\|")

    def syllables(script: str, count: Column) -> Column:
        known = F.array(*map(F.lit, SYLLABLES[script]))
        drawn = F.transform(F.sequence(F.lit(2), count + 1), lambda i: F.element_at(known, byte(i) % len(SYLLABLES[script]) + 1))
        return F.array_join(drawn, "")

    family = F.lit(None).cast("string")
    for script in SYLLABLES:
        named = F.concat_ws("|", F.lit(script), syllables(script, F.least(attempt + 4, F.lit(90))))
        family = F.when(F.element_at(parts, 1) == script, named).otherwise(family)
    given = F.lit(None).cast("string")
    for (gender, script), names in GIVEN.items():
        first_name = F.lower(F.element_at(F.array(*map(F.lit, names)), byte(1) % len(names) + 1))
        more = F.when(attempt > 0, syllables(script, F.least(attempt + 1, F.lit(90))))
        here = (F.element_at(parts, 1) == gender) & (F.element_at(parts, 2) == script)
        named = F.concat_ws("|", F.lit(gender), F.lit(script), F.element_at(parts, 3), F.concat_ws("-", first_name, more))
        given = F.when(here, named).otherwise(given)
    return (
        F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "ip", ip).when(kind == "ssn", ssn)
        .when(kind == "card", card).when(kind == "family", family).when(kind == "given", given)
    )


def formatted(kind: Column, mention: Column, found: Column) -> Column:
    """A surrogate in the format of a mention."""
    begin = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    digits = F.right(_digits(found), F.length(_digits(mention)))

    def step(state: Column, c: Column) -> Column:
        digit = F.regexp_like(c, F.lit("[0-9]"))
        new = F.when(digit, F.substring(digits, state["at"], F.lit(1))).otherwise(c)
        return F.struct((state["at"] + digit.cast("int")).alias("at"), F.concat(state["out"], new).alias("out"))

    filled = F.aggregate(F.split(mention, ""), begin, step, lambda s: s["out"])
    shouted = F.when(mention == F.upper(mention), F.upper(found)).otherwise(found)
    capital = F.array_join(F.transform(F.split(F.element_at(F.split(found, r"\|"), -1), "-"), F.initcap), "-")
    name = F.concat(F.regexp_extract(mention, _TITLE, 0), capital)
    return F.when(kind == "email", shouted).when(kind == "ip", found).when(kind == "person", name).otherwise(filled)


def distinct_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm): no two entities of a type share a
    surrogate and none is an entity of that type.

    A person's surrogate is that of the family name, the same for all persons of a script,
    behind that of the given name, which differs from the others of that family.
    """
    entities = staged(entities.select("kind", "norm").distinct(), "entities")
    parts = F.split("norm", r"\|")
    name = F.element_at(parts, 3)
    persons = entities.filter(F.col("kind") == "person").select(
        "kind", "norm", F.element_at(parts, 1).alias("gender"), F.element_at(parts, 2).alias("script"),
        F.regexp_extract(name, "[^ ]*$", 0).alias("family"), F.regexp_extract(name, "^(.*) ", 1).alias("given"),
    )
    persons = persons.withColumn("family_norm", F.concat_ws("|", "script", "family")).withColumn(
        "given_norm", F.when(F.col("given") != "", F.concat_ws("|", "gender", "script", "family", "given"))
    )
    names = [persons.select(F.lit(kind).alias("kind"), F.col(f"{kind}_norm").alias("norm")) for kind in ("family", "given")]
    others = entities.filter(F.col("kind") != "person")
    drawn = _drawn(others.unionByName(names[0]).unionByName(names[1]).filter("norm IS NOT NULL").distinct(), key)
    last = F.element_at(F.split("surrogate", r"\|"), -1)
    for kind in ("family", "given"):
        found = drawn.filter(F.col("kind") == kind).select(F.col("norm").alias(f"{kind}_norm"), last.alias(f"new_{kind}"))
        persons = persons.join(found, f"{kind}_norm", "left")
    told = F.concat_ws("|", "gender", "script", F.concat_ws(" ", "new_given", "new_family"))
    persons = persons.select("kind", "norm", told.alias("surrogate"))
    return drawn.filter(~F.col("kind").isin("family", "given")).unionByName(persons)


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm), distinct within a kind and none an
    entity of it.

    Entities that lose a collision draw again; those settled before stay. A round is a
    written table, the driver sees the number of losers. While a format has twice as many
    values as entities, every draw succeeds with one half or more; an entity that still
    loses after ``MOST_ATTEMPTS`` draws means that there are too few, and is an error.
    """
    entities = staged(entities, "names")
    current = entities.withColumn("attempt", F.lit(0))
    while True:
        current = staged(
            current.select("kind", "norm", "attempt", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key).alias("surrogate")),
            "surrogates",
        )
        winners = current.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm"))["norm"].alias("winner"))
        real = entities.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        judged = current.join(winners, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        lost = F.coalesce("real", F.lit(False)) | (F.col("norm") != F.col("winner"))
        judged = staged(judged.select("kind", "norm", "attempt", lost.alias("lost")), "surrogate-checks")
        lost_now = judged.filter("lost").agg(F.count("*"), F.max("attempt"), F.max("kind")).first()
        if not lost_now[0]:
            return current.select("kind", "norm", "surrogate")
        if lost_now[1] >= MOST_ATTEMPTS:
            raise ValueError(f"{lost_now[0]} entities, of kind {lost_now[2]} among others, find no surrogate: their format has too few")
        current = judged.select("kind", "norm", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"))


# --- on tables ---------------------------------------------------------------------------


def replace_personal_data(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any other columns) with surrogates in ``text``
    and ``mentions``, an array of (kind, surrogate) in the order of the text; a column of that
    name is replaced.

    Whole texts are read. Null and clean texts stay as they are, with no mentions. Equal
    texts get equal replacements, so copies are worked on once.
    """
    text = F.col("text")
    # 128 bits name a text.
    named = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    found = docs.select(*named, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found")).filter(F.size("found") > 0)
    every = staged(
        found.select("h1", "h2", F.posexplode("found").alias("pos", "mention")).distinct().withColumn("kind", kind_of(F.col("mention")))
        .withColumn("norm", normal(F.col("kind"), F.col("mention"))),
        "mentions",
    )
    real = every.filter(F.col("kind").isNotNull())
    # Full and family names of the persons of a text; two of one name are the first of them.
    parts = F.split("norm", r"\|")
    whole = F.element_at(parts, 3)
    both = F.explode(F.array(whole, F.regexp_extract(whole, "[^ ]*$", 0))).alias("name")
    persons = real.filter(F.col("kind") == "person").select("h1", "h2", F.concat_ws("|", F.get(parts, 0), F.get(parts, 1)).alias("group"), both)
    known = persons.groupBy("h1", "h2", "name").agg(F.concat_ws("|", F.min("group"), "name").alias("norm"))
    known = staged(known.withColumn("kind", F.lit("person")), "names-of-texts")
    mapping = distinct_surrogates(real.select("kind", "norm").unionByName(known.select("kind", "norm")), key)
    told = every.join(mapping, ["kind", "norm"], "left").select(
        "h1", "h2",
        F.struct(
            "pos", F.when(F.col("surrogate").isNotNull(), F.col("kind")).alias("kind"),
            F.coalesce(formatted(F.col("kind"), F.col("mention"), F.col("surrogate")), F.col("mention")).alias("put"),
        ).alias("put"),
        F.lit(None).cast("struct<name:string,put:string>").alias("name"),
    )
    again = known.join(mapping, ["kind", "norm"]).select(
        "h1", "h2", F.lit(None).cast(told.schema["put"].dataType).alias("put"),
        F.struct("name", formatted(F.col("kind"), F.col("name"), F.col("surrogate")).alias("put")).alias("name"),
    )
    # The mentions of one text: as many as its length allows, whatever its copies.
    longest = lambda a, b: F.when(F.length(a["name"]) != F.length(b["name"]), F.length(b["name"]) - F.length(a["name"])).otherwise(
        F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0)
    )
    texts = told.unionByName(again).groupBy("h1", "h2").agg(
        F.array_sort(F.collect_list("put")).alias("puts"), F.array_sort(F.collect_list("name"), longest).alias("names")
    )
    texts = staged(texts, "replacements")

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.withColumns({"h1": F.xxhash64("row.text"), "h2": F.xxhash64(F.lit(1), "row.text")})
    # The same plan at every size: texts are dealt by their names, hot ones can be split.
    joined = rows.join(texts.hint("merge"), ["h1", "h2"], "left")
    pieces = F.split(F.col("row.text"), ANY, -1)
    put = lambda put: F.array(F.struct(put["put"].alias("out"), put["kind"].alias("kind")))
    woven = F.flatten(
        F.zip_with(
            F.transform(pieces, lambda piece: _named_again(piece, F.col("names"))), F.col("puts"),
            lambda piece, one: F.concat(piece, F.when(one.isNotNull(), put(one)).otherwise(F.array().cast(SEGMENTS))),
        )
    )
    joined = joined.select("row", F.when(F.col("puts").isNotNull(), woven).alias("woven"))
    changed = F.coalesce(F.array_join(F.transform("woven", lambda s: s["out"]), ""), F.col("row.text"))
    real_puts = F.filter(F.coalesce("woven", F.array().cast(SEGMENTS)), lambda s: s["kind"].isNotNull())
    listed = F.transform(real_puts, lambda s: F.struct(s["kind"].alias("kind"), s["out"].alias("surrogate")))
    columns = [changed.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c != "mentions"]
    return joined.select(*columns, listed.alias("mentions"))


SEGMENTS = "array<struct<out:string,kind:string>>"


def _named_again(piece: Column, names: Column) -> Column:
    """Text without titled names as segments: ``names`` (name, put; longest first) that stand
    in it as whole words with a capital are persons."""
    plain = F.array(F.struct(piece.alias("out"), F.lit(None).cast("string").alias("kind")))
    pattern = F.concat(
        F.lit(r"(?<!\p{L})(?<!\p{L}['-])(?=\p{Lu})(?iu:"), F.array_join(F.transform(names, lambda n: n["name"]), "|"),
        F.lit(r")(?!\p{L}|-\p{L}|'(?!s(?!\p{L}))\p{L})"),
    )

    def person(mention: Column) -> Column:
        found = F.get(F.filter(names, lambda n: n["name"] == F.lower(mention)), 0)["put"]
        shown = F.when(mention == F.upper(mention), F.upper(found)).otherwise(found)
        return F.struct(F.coalesce(shown, mention).alias("out"), F.when(found.isNotNull(), "person").alias("kind"))

    mentions = F.transform(F.regexp_extract_all(piece, pattern, F.lit(0)), person)
    between = F.transform(F.split(piece, pattern, -1), lambda gap: F.struct(gap.alias("out"), F.lit(None).cast("string").alias("kind")))
    segments = F.flatten(F.zip_with(between, mentions, lambda gap, one: F.when(one.isNull(), F.array(gap)).otherwise(F.array(gap, one))))
    return F.when(F.size(names) == 0, plain).otherwise(segments)
