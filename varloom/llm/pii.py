"""Surrogates for personal data, by DataFrame functions only.

Entities are found by patterns, brought to a canonical form (so that two spellings of a number are one
entity) and get a keyed replacement of the same type: digits for digits, letters of the same script and
case, card numbers with a valid check digit, names of the same gender and script. All entities of the
corpus are in one dictionary, and a replacement that another entity already has, or that is itself found
in the corpus, is drawn again. Equal entities get equal replacements in every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import store

# Titles by gender, and given names by gender and script.
TITLES = {"m": "Mr|Herr|Monsieur|Señor|Sr|Г-н", "f": "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Г-жа", "n": "Dr|Prof"}
GIVEN = {
    ("m", "latin"): ["James", "Peter", "Paul", "Lucas", "Hugo", "Marco", "Simon", "Oscar", "Victor", "Martin"],
    ("f", "latin"): ["Anna", "Laura", "Julia", "Clara", "Emma", "Maria", "Helen", "Nora", "Alice", "Sofia"],
    ("m", "cyrillic"): ["Иван", "Пётр", "Павел", "Сергей", "Антон", "Борис", "Виктор", "Олег"],
    ("f", "cyrillic"): ["Анна", "Мария", "Ольга", "Елена", "Ирина", "Вера", "Нина", "Юлия"],
}
SYLLABLES = {
    "latin": ["ba", "de", "fi", "go", "ku", "la", "me", "ni", "po", "ru", "sa", "te", "vi", "wo", "ze", "ha"],
    "cyrillic": ["ба", "де", "фи", "го", "ку", "ла", "ме", "ни", "по", "ру", "са", "те", "ви", "во", "зе", "ха"],
}
_ALL_TITLES = "|".join(TITLES[g] for g in TITLES)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_EDGE = r"(?<![\p{L}\p{N}])"
_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}"
_IP = r"(?<![\d.])" + rf"(?:{_OCTET}\.){{3}}{_OCTET}" + r"(?!\.?\d)"
_CARD = r"(?<![\d+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# No group of a phone starts another entity; of a longer run of groups of four, the last four may be a card.
_OTHER = rf"(?!{_EMAIL}|{_IP}|{_CARD}(?! \d{{4}})|{_SSN})"
# A number of a plan that is not known: 6 to 15 digits, counted backwards; a look-behind takes no repeated group.
_DIGIT = r"[ .()-]{0,2}\d"
_COUNTED = rf"(?<=\+{_DIGIT * 6}{f'(?:{_DIGIT}' * 9}{')?' * 9})"
_ABROAD = r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?%s\d{2,4}){2,4}(?!\d)" + _COUNTED
#: Types in the order in which they are tried at a place.
PATTERNS = {
    "secret": r"(?<=(?:token|secret|passw(?:or)?d|api_?key|access_key) ?[=:] ?[\"'])[\w+/=.-]{12,}(?=[\"'])"
    r"|" + _EDGE + r"(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])",
    "email": _EMAIL,
    "ip": _IP,
    "iban": _EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": _CARD,
    "ssn": _SSN,
    # Country code 1 is 3-3-4 digits. Other numbers end before another entity, unless nothing would be left.
    "phone": r"(?<![\p{L}\p{N}])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|" + f"{_ABROAD % _OTHER}|{_ABROAD % ''})"
    r"|(?<![\p{L}\p{N}(])\(\d{3}\) ?\d{3}[ -]\d{4}(?!\d)",
    "name": _EDGE + rf"(?:{_ALL_TITLES})\.? \p{{Lu}}[\p{{L}}'-]{{1,30}}(?: \p{{Lu}}[\p{{L}}'-]{{1,30}})?",
}
COMBINED = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text needs to have at all: rules most texts out quickly.
GUARD = rf"[@\d]|(?:{_ALL_TITLES})\.? \p{{Lu}}|token|secret|passw|key|sk-"
KEY = "surrogates-1"
#: Draws after which a replacement is made longer.
PLAIN_DRAWS = 8


def entity_type(value: Column) -> Column:
    """Type of a match of :data:`COMBINED`, told by its form alone."""
    digits = F.regexp_replace(value, r"\D", "")
    return (
        F.when(F.contains(value, F.lit("@")), "email")
        .when(value.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})$"), F.when(luhn(digits), "card"))
        .when(value.rlike(r"^(?:\+|\()\d"), "phone")
        .when(value.rlike(rf"^(?:{_ALL_TITLES})\.? "), "name")
        .when(value.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,}"), "iban")
        .otherwise("secret")
    )


def _doubled(digits: Column) -> Column:
    """Luhn sum of a text of digits."""
    numbers = F.transform(F.split(digits, ""), lambda d: d.cast("int"))
    n = F.length(digits)
    parts = F.transform(numbers, lambda d, i: F.when((n - i) % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + b)


def luhn(digits: Column) -> Column:
    return _doubled(digits) % 10 == 0


def canonical(kind: Column, value: Column) -> Column:
    """One form for all spellings of an entity."""
    return (
        F.when(kind.isin("card", "ssn", "phone"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "email", F.lower(value))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind == "name", F.concat(gender(value), F.lit(":"), F.lower(F.regexp_replace(value, rf"^(?:{_ALL_TITLES})\.? ", ""))))
        .otherwise(value)
    )


def gender(value: Column) -> Column:
    """``m``, ``f`` or ``n`` by the title of a name."""
    return F.when(value.rlike(rf"^(?:{TITLES['m']})\.? "), "m").when(value.rlike(rf"^(?:{TITLES['f']})\.? "), "f").otherwise("n")


def _draw(seed: Column, i: Column | int) -> Column:
    """A keyed number from 0 to 65535 for place ``i``."""
    return F.conv(F.substring(F.sha2(F.concat_ws("#", seed, F.lit(i) if isinstance(i, int) else i.cast("string")), 256), 1, 4), 16, 10).cast("int")


def _letters(value: Column, seed: Column) -> Column:
    """Every letter and digit by one of its kind; hexadecimal texts stay so; other characters stay."""
    hexadecimal = value.rlike(r"^[0-9a-f]+$") | value.rlike(r"^[0-9A-F]+$")

    def one(c: Column, i: Column) -> Column:
        draw = _draw(seed, i)
        pick = lambda chars: F.substring(F.lit(chars), draw % len(chars) + 1, F.lit(1))
        return (
            F.when(c.rlike(r"^\d$"), pick("0123456789"))
            .when(c.rlike("^[a-f]$") & hexadecimal, pick("abcdef"))
            .when(c.rlike("^[A-F]$") & hexadecimal, pick("ABCDEF"))
            .when(c.rlike("^[a-z]$"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("^[A-Z]$"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike("^[а-яё]$"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike("^[А-ЯЁ]$"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
            .when(c.rlike(r"^\p{Lu}$"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"^\p{L}$"), pick("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _person(canon: Column, seed: Column) -> Column:
    """A name of the same gender and script, with as many parts as the original."""
    cyrillic, sex = canon.rlike("[а-яё]"), F.substring(canon, 1, 1)

    def of(script: str) -> Column:
        first = {g: F.element_at(F.array(*map(F.lit, GIVEN[g, script])), _draw(seed, 0) % len(GIVEN[g, script]) + 1) for g in "mf"}
        given = F.when(sex == "m", first["m"]).when(sex == "f", first["f"]).otherwise(
            F.when(_draw(seed, 9) % 2 == 0, first["m"]).otherwise(first["f"])
        )
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        family = F.initcap(F.concat(*(F.element_at(parts, _draw(seed, i) % len(SYLLABLES[script]) + 1) for i in (1, 2, 3, 4))))
        return F.when(F.contains(canon, F.lit(" ")), F.concat_ws(" ", given, family)).otherwise(family)

    return F.when(cyrillic, of("cyrillic")).otherwise(of("latin"))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str = KEY) -> Column:
    """The keyed replacement, in canonical form, of draw ``attempt``; later draws make it longer."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    mapped = _letters(canon, seed)
    check = lambda text: F.substring(((10 - _doubled(F.concat(text, F.lit("0"))) % 10) % 10).cast("string"), 1, 1)
    octets = F.concat_ws(".", *((_draw(seed, i) % 254 + 1).cast("string") for i in range(4)))
    most = mapped.substr(F.lit(1), F.length(mapped) - 1)
    local = _letters(F.substring_index(canon, "@", 1), seed)
    host = _letters(F.regexp_replace(F.substring_index(canon, "@", -1), r"\.[^.]*$", ""), F.concat(F.lit(key), F.lit("|host|"), F.substring_index(canon, "@", -1)))
    longer = F.when(attempt > PLAIN_DRAWS, F.substring(F.sha2(seed, 256), 1, 6)).otherwise(F.lit(""))
    return (
        F.when(kind == "card", F.concat(most, check(most)))
        .when(kind == "ip", octets)
        .when(kind == "email", F.concat(local, longer, F.lit("@"), host, F.lit(".example")))
        .when(kind == "name", F.concat(_person(canon, seed), longer))
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _letters(canon.substr(F.lit(3), F.length(canon)), seed)))
        .otherwise(F.concat(mapped, F.when(kind == "secret", longer).otherwise(F.lit(""))))
    )


def formatted(kind: Column, value: Column, canon: Column) -> Column:
    """A canonical replacement in the format of the value that it replaces."""
    ordinal = lambda c, i: F.length(F.regexp_replace(value.substr(F.lit(1), i + 1), r"\D", ""))
    digits = F.array_join(
        F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike(r"^\d$"), canon.substr(ordinal(c, i), F.lit(1))).otherwise(c)), ""
    )
    rank = lambda i: F.length(F.replace(value.substr(F.lit(1), i + 1), F.lit(" "), F.lit("")))
    blanks = F.array_join(
        F.transform(F.split(value, ""), lambda c, i: F.when(c == " ", c).otherwise(canon.substr(rank(i), F.lit(1)))), ""
    )
    title = F.regexp_extract(value, rf"^(?:{_ALL_TITLES})\.? ", 0)
    family = F.regexp_replace(value, rf"^(?:{_ALL_TITLES})\.? ", "")
    name = F.when((F.length(family) > 1) & (family == F.upper(family)), F.upper(canon)).otherwise(canon)
    return (
        F.when(kind.isin("card", "ssn", "phone"), digits)
        .when(kind == "iban", blanks)
        .when(kind == "name", F.concat(title, name))
        .when((kind == "email") & (value == F.upper(value)), F.upper(canon))
        .otherwise(canon)
    )


def found(text: Column) -> Column:
    """All matches in a text, in order; null has none."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(text.rlike(GUARD), F.lit(False)), F.regexp_extract_all(text, F.lit(COMBINED), F.lit(0))).otherwise(none)


def _plain(kind: Column, text: Column) -> Column:
    """An entity or a replacement in the one form in which the two compare: a name in lower case, without gender."""
    return F.when(kind == "name", F.regexp_replace(F.lower(text), "^[mfn]:", "")).when(kind == "email", F.lower(text)).otherwise(text)


def dictionary(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canon, other`` from distinct ``kind, canon``: replacements that no other entity has or is.

    Every round draws for those that are still without; of entities that draw alike the first of them
    keeps it. Rounds are written tables; almost always there are one or two.
    """
    kind = F.col("kind")
    taken = entities.select("kind", _plain(kind, F.col("canon")).alias("plain")).distinct()
    todo, done, attempt = entities.select("kind", "canon"), None, 0
    while True:
        drawn = todo.withColumn("other", surrogate(kind, F.col("canon"), F.lit(attempt), key))
        own = drawn.groupBy("kind", "other").agg(F.min("canon").alias("canon"))
        own = own.withColumn("plain", _plain(kind, F.col("other"))).join(taken, ["kind", "plain"], "left_anti")
        if done is not None:
            own = own.join(done.select("kind", "other"), ["kind", "other"], "left_anti")
        own = store(own.select("kind", "canon", "other"), "surrogates")
        done = own if done is None else store(done.unionByName(own), "surrogates")
        todo = store(entities.select("kind", "canon").join(done, ["kind", "canon"], "left_anti"), "surrogates-left")
        if todo.isEmpty():
            return done
        attempt += 1


def replace_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, text, replaced``, with all entities replaced.

    Numbers that look like cards but fail their check digit stay. Null texts stay null; texts without
    an entity are as they were and are not shuffled.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("found", found(F.col("text")))
    some = base.filter(F.size("found") > 0).withColumn("pieces", F.split("text", COMBINED, -1)).drop("text")
    some = store(some.withColumn("row", F.monotonically_increasing_id()), "pii-found")
    value = F.col("value")
    each = some.select("row", F.explode(F.array_distinct("found")).alias("value")).withColumn("kind", entity_type(value))
    each = each.filter(F.col("kind").isNotNull()).withColumn("canon", canonical(F.col("kind"), value))
    each = store(each, "pii-entities")
    known = dictionary(store(each.select("kind", "canon").distinct(), "pii-canon"), key)
    told = each.join(known, ["kind", "canon"]).withColumn("new", formatted(F.col("kind"), value, F.col("other")))
    maps = told.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("value", "new"))).alias("news"))
    met = some.join(maps, "row", "left")
    new = F.transform("found", lambda v: F.coalesce(F.element_at("news", v), v))
    # Pieces and replacements alternate; there is one piece more.
    spread = F.zip_with("pieces", F.concat(new, F.array(F.lit(""))), lambda p, e: F.concat(p, e))
    count = F.size(F.filter("found", lambda v: F.coalesce(F.map_contains_key(F.col("news"), v), F.lit(False))))
    changed = met.select("doc_id", F.array_join(spread, "").alias("text"), count.alias("replaced"))
    same = base.filter(F.size("found") == 0).select("doc_id", "text", F.lit(0).alias("replaced"))
    return same.unionByName(changed)
