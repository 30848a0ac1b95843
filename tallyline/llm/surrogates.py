"""Personal data replaced by surrogates of the same type, script and format.

Entities are found by patterns; of long numbers only those with a right check digit count.
An entity and its spellings (case, separators) share one surrogate in the whole corpus, made
from a keyed digest: digits become digits, letters become letters of their script, phone and
card numbers keep their layout and check digit, mail addresses of one domain stay together,
and names get names of the gender that their title tells. Two entities never share a
surrogate, and no surrogate is an entity of the corpus: whoever collides takes the next
digest until nobody does. Initials, of which there are few, become other initials.

Only column expressions are used. The patterns run once per text, and texts without
entities are never shuffled.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.storing import stored

KEY = "surrogates"

# Titles before a name by the gender they tell.
TITLES = {
    "male": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Господин", "Κύριος"),
    "female": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Госпожа", "Κυρία"),
    "open": ("Dr", "Prof", "Professor"),
}
_TITLES = "|".join(t for group in TITLES.values() for t in group)

# Beginnings and endings of made-up names by script.
SYLLABLES = {
    "latin": (
        ("Bal", "Cor", "Dan", "Fen", "Gar", "Hol", "Jor", "Kel", "Lem", "Mar", "Nor", "Pel", "Ros", "Sel", "Tor", "Vel"),
        ("ba", "da", "fe", "ga", "ki", "la", "me", "no", "pi", "ra", "se", "ti", "vo", "wi", "ze", "lu"),
        {"male": ("n", "k", "r", "s"), "female": ("a", "ia", "ina", "ella"), "open": ("en", "is", "el", "or")},
    ),
    "cyrillic": (
        ("Бал", "Вер", "Гор", "Дан", "Жор", "Зар", "Кор", "Лев", "Мар", "Ник", "Пол", "Род", "Сав", "Тим", "Фед", "Яр"),
        ("ба", "ве", "го", "да", "зи", "ка", "ле", "ми", "но", "по", "ра", "се", "ти", "фе", "ха", "чи"),
        {"male": ("н", "к", "р", "в"), "female": ("а", "ия", "ина", "ова"), "open": ("ен", "ис", "ель", "ко")},
    ),
    "greek": (
        ("Αλ", "Βασ", "Γερ", "Δημ", "Ευ", "Ζην", "Θαλ", "Ιων", "Κλε", "Λεω", "Μιλ", "Νικ", "Πολ", "Ροδ", "Σταυ", "Φιλ"),
        ("βα", "γε", "δι", "κο", "λα", "με", "νι", "πο", "ρα", "σε", "τι", "φο", "χα", "ψι", "ζε", "θα"),
        {"male": ("ος", "ης", "ας", "ων"), "female": ("α", "η", "ια", "ω"), "open": ("ις", "ευς", "αξ", "ος")},
    ),
}

SCRIPTS = {"latin": r"^\p{IsLatin}", "cyrillic": r"^\p{IsCyrillic}", "greek": r"^\p{IsGreek}"}

# A word of a name, with capitals inside or without, and initials before it.
_INITIALS = r"(?:\p{Lu}\.-?){1,4}"
_NAME = rf"(?:{_INITIALS} ?){{0,2}}(?:\p{{Lu}}(?:[\p{{Ll}}'\-]|’(?=\p{{Lu}})){{1,30}}){{1,5}}"
# Letters that initials can be, each alphabet in a row.
_ALPHABETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")

# What counts as an entity. Each pattern begins where a longer match cannot.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]{1,64}@(?:[\p{L}\p{N}\-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\w)"
    r"|(?<!\w)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w\-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.\-])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\w\-])",
    "secret": r"(?<!\w)(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?!\w)",
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.? {_NAME}(?: {_NAME}){{0,2}}(?!\p{{L}})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Texts that cannot hold an entity are known by this alone.
HINT = (
    rf"[0-9@]|(?<!\p{{L}})(?:{_TITLES})(?!\p{{L}})"
    r"|[a-f]{32}|[A-F]{32}|AKIA[A-Z]{16}|gh[pousr]_[A-Za-z]{36}|sk-[A-Za-z]{20}"
)
TITLE = rf"^({_TITLES})\.? "
# Rounds of new digests after which the local part of an address and a domain grow by a letter a round.
GROWS_AFTER = 3
# Rounds after which numbers that still collide change places with one another.
SWAPS_AFTER = 12


def luhn(digits: Column) -> Column:
    """Sum of a digit string by the rule of check digits; a right number's is divisible by 10."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def entity_type(value: Column) -> Column:
    """The first type whose pattern the whole value fits; null of long numbers without a check digit."""
    found = F.lit(None).cast("string")
    for kind in reversed([k for k in PATTERNS if k != "name"]):
        fits = value.rlike(rf"^(?:{PATTERNS[kind]})$")
        if kind == "card":
            found = F.when(fits, F.when(luhn(_digits(value)) % 10 == 0, F.lit("card"))).otherwise(found)
        else:
            found = F.when(fits, F.lit(kind)).otherwise(found)
    return F.when(value.rlike(TITLE), F.lit("name")).otherwise(found)


def told_gender(value: Column) -> Column:
    """The gender that the title of a name tells, ``open`` where it tells none."""
    title = F.regexp_extract(value, TITLE, 1)
    told = F.lit("open")
    for gender in ("male", "female"):
        told = F.when(title.isin(*TITLES[gender]), F.lit(gender)).otherwise(told)
    return told


def spelling(kind: Column, value: Column) -> Column:
    """One spelling of an entity for all: digits of numbers, lower case of addresses and hex strings."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), _digits(value))
        .when(kind == "email", F.lower(value))
        .when((kind == "secret") & value.rlike("^[0-9A-Fa-f]+$"), F.lower(value))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .otherwise(value)
    )


def _stream(key: str, *parts: Column) -> Column:
    """256 hex digits that depend on the key and the parts."""
    joined = F.concat_ws("\u0000", F.lit(key), *parts)
    return F.concat(*[F.sha2(F.concat(joined, F.lit(f"#{k}")), 256) for k in range(4)])


def _number(stream: Column, i: Column | int) -> Column:
    """The i-th number below 256 of a stream, going round."""
    at = (F.lit(i) if isinstance(i, int) else i) % 128 * 2 + 1
    return F.conv(stream.substr(at.cast("int"), F.lit(2)), 16, 10).cast("int")


def _letter(low: str, size: int, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(chr(ord(low) + k)) for k in range(size)]), n % size + 1)


def same_shape(value: Column, stream: Column, hexadecimal: Column | None = None) -> Column:
    """``value`` with other digits and letters, each of its script and case; other characters stay.

    Letters of scripts without a list become Latin ones.
    """

    def other(c: Column, i: Column) -> Column:
        n = _number(stream, i)
        small = _letter("a", 26, n)
        if hexadecimal is not None:
            small = F.when(hexadecimal, _letter("a", 6, n)).otherwise(small)
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike(r"[\p{IsCyrillic}&&\p{Ll}]"), _letter("а", 32, n))
            .when(c.rlike(r"\p{IsCyrillic}"), _letter("А", 32, n))
            .when(c.rlike(r"[\p{IsGreek}&&\p{Ll}]"), _letter("α", 17, n))
            .when(c.rlike(r"\p{IsGreek}"), _letter("Α", 17, n))
            .when(c.rlike(r"\p{IsHan}"), _letter("一", 128, n))
            .when(c.rlike(r"\p{IsHangul}"), _letter("가", 128, n))
            .when(c.rlike(r"\p{IsHebrew}"), _letter("א", 27, n))
            .when(c.rlike(r"\p{IsArabic}"), _letter("ب", 19, n))
            .when(c.rlike(r"\p{Lu}"), F.upper(small))
            .when(c.rlike(r"\p{L}"), small)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), other), "")


def _word_list(words: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), n % len(words) + 1)


def _made_name(word: Column, gender: Column, attempt: Column, stream: Column) -> Column:
    made = F.lit(None).cast("string")
    longest = 8
    for script, (first, middle, last) in SYLLABLES.items():
        ending = F.lit(None).cast("string")
        for told, endings in last.items():
            ending = F.when(gender == told, _word_list(endings, _number(stream, 1))).otherwise(ending)
        inner = F.array(*[_word_list(middle, _number(stream, 2 + k)) for k in range(longest)])
        inner = F.array_join(F.slice(inner, F.lit(1), F.least(attempt + 2, F.lit(longest))), "")
        name = F.concat(_word_list(first, _number(stream, 0)), inner, ending)
        made = F.when(word.rlike(SCRIPTS[script]), name).otherwise(made)
    return F.coalesce(made, same_shape(word, stream))


def _surrogate(key: str) -> Column:
    """The surrogate of an entity (kind, plain, gender, attempt) in the one spelling."""
    kind, plain, attempt = F.col("kind"), F.col("plain"), F.col("attempt").cast("string")
    stream = _stream(key, kind, plain, attempt)
    shaped = same_shape(plain, stream, plain.rlike("^[0-9a-f]+$"))
    # numbers keep their first digit; a card's last one is its check digit
    number = F.concat(plain.substr(1, 1), shaped.substr(F.lit(2), F.length(plain)))
    body = number.substr(F.lit(1), F.length(plain) - 1)
    card = F.concat(body, ((10 - luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    octets = F.array(*[(_number(stream, k) % 254 + 1).cast("string") for k in range(4)])
    more = F.array(*[_letter("a", 26, _number(stream, 100 + k)) for k in range(SWAPS_AFTER)])
    grown = F.array_join(F.slice(more, F.lit(1), F.greatest(F.col("attempt") - GROWS_AFTER, F.lit(0))), "")
    local = F.concat(same_shape(F.split_part(plain, F.lit("@"), F.lit(1)), stream), grown)
    host = F.concat(same_shape(F.regexp_extract(plain, r"^(.*)\.[^.]*$", 1), stream), grown, F.lit(".example"))
    return (
        F.when(kind == "email", F.concat(local, F.lit("@"), F.col("host")))
        .when(kind == "domain", host)
        .when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", card)
        .when(kind.isin("phone", "ssn"), number)
        .when(kind == "iban", F.concat(plain.substr(1, 2), shaped.substr(F.lit(3), F.length(plain))))
        .when(kind == "name", _made_name(plain, F.col("gender"), F.col("attempt"), stream))
        .otherwise(shaped)
    )


def _other_initials(plain: Column, key: str) -> Column:
    """Each initial as another letter of its alphabet, told by the key; of other letters the same shape."""
    others = ""
    for alphabet in _ALPHABETS:
        # the letters in a ring whose order depends on the key: each becomes the next one
        ring = sorted(alphabet, key=lambda c: hashlib.sha256(f"{key}\0initials\0{c}".encode()).digest())
        others += "".join(ring[(ring.index(c) + 1) % len(ring)] for c in alphabet)
    moved = F.translate(plain, "".join(_ALPHABETS), others)
    return F.when(moved == plain, same_shape(plain, _stream(key, F.lit("initials"), plain))).otherwise(moved)


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``entities`` (kind, plain, gender; each once) with ``surrogate``, unlike all others and all entities.

    Of entities with one surrogate the smallest keeps it; the others, and those that got
    some entity's own spelling, go on to the next digest. Addresses and domains grow longer from
    the third round on, and names by a syllable a round, so that any number of them find one.
    Numbers cannot grow: those that have found none after twelve rounds, as their format has few
    values left, take one another's in a ring. ``host`` is the domain that an address gets.
    """
    if "host" not in entities.columns:
        entities = entities.withColumn("host", F.lit(None).cast("string"))
    own = stored(entities.select("kind", "plain"), "entities")
    done = None
    open_ = stored(entities.withColumn("attempt", F.lit(0)), "open")
    for _ in range(SWAPS_AFTER):
        tried = stored(open_.withColumn("surrogate", _surrogate(key)), "tried")
        least = tried.groupBy("kind", "surrogate").agg(F.min("plain").alias("keeper"))
        taken = own.withColumnRenamed("plain", "surrogate")
        if done is not None:
            taken = taken.unionByName(done.select("kind", "surrogate")).distinct()
        good = (
            tried.join(least, ["kind", "surrogate"])
            .where("plain = keeper")
            .drop("keeper")
            .join(taken, ["kind", "surrogate"], "left_anti")
        )
        good = stored(good, "surrogates")
        done = good if done is None else stored(done.unionByName(good), "surrogates")
        rest = tried.join(good.select("kind", "plain"), ["kind", "plain"], "left_anti").drop("surrogate")
        open_ = stored(rest.withColumn("attempt", F.col("attempt") + 1), "open")
        if open_.isEmpty():
            break
    else:
        done = done.select("kind", "plain", "surrogate").unionByName(_swapped(open_, key))
    return done.select("kind", "plain", "surrogate")


def _swapped(left: DataFrame, key: str) -> DataFrame:
    """Entities that found no surrogate, each with the spelling of the next one of its format.

    No other entity has these spellings as its surrogate. Rings are by kind, length and leading
    digits, so one is no larger than the values of eight digits; the next one is found among
    neighbours in keyed order.
    """
    place = F.sha2(F.concat_ws("\u0000", F.lit(key), F.lit("ring"), "plain"), 256)
    rows = left.select("kind", "plain", F.length("plain").alias("size"), place.alias("place"))
    ring = Window.partitionBy("kind", "size", F.substring("plain", 1, F.greatest(F.col("size") - 8, F.lit(1))))
    following = F.lead("plain").over(ring.orderBy("place", "plain"))
    first = F.min_by("plain", F.struct("place", "plain")).over(ring)
    given = rows.withColumn("surrogate", F.coalesce(following, first))
    alone = F.raise_error(F.lit("an entity is the last of its format, and no other value is left for it"))
    return given.select("kind", "plain", F.when(F.col("surrogate") == F.col("plain"), alone).otherwise(F.col("surrogate")).alias("surrogate"))


def _formatted(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling that the value has."""
    chars = F.split(value, "")
    before = F.transform(chars, lambda c, i: F.length(_digits(value.substr(F.lit(1), i + 1))))
    laid_out = F.array_join(
        F.zip_with(
            chars, before, lambda c, n: F.when(c.rlike("[0-9]"), surrogate.substr(n, F.lit(1))).otherwise(c)
        ),
        "",
    )
    spaced = F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("i")),
        lambda s, c: F.when(c == " ", F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))).otherwise(
            F.struct(F.concat(s["out"], surrogate.substr(s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))
        ),
        lambda s: s["out"],
    )
    upper = (value == F.upper(value)) & (value != F.lower(value))
    return (
        F.when(kind.isin("phone", "card", "ssn"), laid_out)
        .when(kind == "iban", spaced)
        .when(kind.isin("email", "secret") & upper, F.upper(surrogate))
        .otherwise(surrogate)
    )


def pseudonymise(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with personal data of ``text`` replaced, and ``n_entities``, the number replaced.

    An earlier column ``n_entities`` is replaced; others stay. The same entity has the same
    surrogate in every row of ``docs`` and in every run with the same key and the same rows.
    Null texts stay null and have no entities, as have empty ones. The result of a row
    depends on its text alone, so repeated rows and null keys need no rule; an empty table
    gives an empty result.
    """
    docs = docs.drop("n_entities")
    found = F.when(F.col(text).rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    # the row as one column, so that no name of it meets a name used here
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.coalesce(found, F.array().cast("array<string>")).alias("found")
    )
    rows = stored(rows, "with-entities")
    whole = F.col("doc").getField(text)
    hit = rows.where(F.size("found") > 0).withColumn("key", F.md5(whole))
    mentions = stored(hit.select("key", F.explode(F.array_distinct("found")).alias("value")).distinct(), "mentions")
    new = stored(replacements(mentions.select("value"), key), "replacements")
    tables = (
        mentions.join(new, "value")
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("value", "replacement"))).alias("new"))
    )
    replaced = F.zip_with(
        F.split(whole, ANY, -1),
        "found",
        lambda x, value: F.concat(x, F.coalesce(F.element_at("new", value), value, F.lit(""))),
    )
    count = F.coalesce(F.size(F.filter("found", lambda value: F.map_contains_key("new", value))), F.lit(0))
    hit = hit.join(tables, "key", "left").select(
        F.col("doc").withField(text, F.when(count > 0, F.array_join(replaced, "")).otherwise(whole)).alias("doc"),
        count.alias("n_entities"),
    )
    plain = rows.where(F.size("found") == 0).select("doc", F.lit(0).alias("n_entities"))
    return plain.unionByName(hit).select("doc.*", "n_entities")


def replacements(values: DataFrame, key: str = KEY) -> DataFrame:
    """value and replacement of the found strings ``values`` that are entities."""
    typed = values.distinct().withColumn("kind", entity_type(F.col("value"))).where("kind is not null")
    words = F.split(F.regexp_replace("value", TITLE, ""), " ")
    parts = typed.select(
        "value",
        "kind",
        told_gender(F.col("value")).alias("told"),
        F.posexplode(
            F.when(F.col("kind") == "name", words).otherwise(F.array(spelling(F.col("kind"), F.col("value"))))
        ).alias("place", "plain"),
    )
    parts = stored(parts, "entity-parts")
    initials = (F.col("kind") == "name") & F.col("plain").rlike(rf"^{_INITIALS}$")
    entities = parts.where(~initials).groupBy("kind", "plain").agg(F.min("told").alias("low"), F.max("told").alias("high"))
    gender = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.lit("open"))
    entities = stored(entities.select("kind", "plain", gender.alias("gender")), "typed-entities")
    domain = F.when(F.col("kind") == "email", F.split_part("plain", F.lit("@"), F.lit(2)))
    domains = entities.select(F.lit("domain").alias("kind"), domain.alias("plain"), F.lit("open").alias("gender"))
    hosts = assign(domains.where("plain is not null").distinct(), key)
    hosts = hosts.select(F.col("plain").alias("domain"), F.col("surrogate").alias("host"))
    given = assign(entities.withColumn("domain", domain).join(hosts, "domain", "left").drop("domain"), key)
    formatted = _formatted(F.col("kind"), F.col("value"), F.col("surrogate"))
    whole = F.array_sort(F.collect_list(F.struct("place", "new")))
    joined = F.array_join(F.transform(whole, lambda x: x["new"]), " ")
    title = F.regexp_extract("value", TITLE, 0)
    return (
        parts.join(given, ["kind", "plain"], "left")
        .withColumn(
            "new",
            F.when(initials, _other_initials(F.col("plain"), key))
            .when(F.col("kind") == "name", F.col("surrogate"))
            .otherwise(formatted),
        )
        .groupBy("value")
        .agg(joined.alias("replacement"))
        .select("value", F.concat(title, "replacement").alias("replacement"))
    )
