"""Surrogates for personal data and secrets (operator 5), in DataFrame functions alone.

One pattern finds e-mail addresses, phone, card, social security and bank account numbers, IPv4 and IPv6
addresses, secrets after a name such as ``password=``, long hexadecimal keys and names after a
title. A secret is all that follows its name up to a space or quote, whatever its length, if it has a
letter or digit; its marks stay in their places. Names found after a title are then looked for in the rest of
their text, where they stand alone. What is found is reduced to its canonical form (digits of a number, lower case of an
address, each word of a name), and every distinct form gets one keyed surrogate:

* of the same type and layout: digits for digits, letters for letters of the same case,
  hexadecimal for hexadecimal; a number is poured back into the layout of each place. The check digits
  of cards (Luhn) and bank accounts (modulo 97) fit where those of the original did;
* of the same gender and script for names, which are made from syllables with an ending;
* the same wherever the form occurs again, in any layout: coreference holds over the corpus;
* different from the surrogate of any other form of that type and from every form that occurs.
  Those that collide draw again, with the number of the attempt in the keyed hash, until none do. Every ``LENGTHEN`` attempts the
  surrogates grow by a character (an IPv4 address by a port), so there is always a free one.

Each text is searched once and written with what was found. Texts without anything found pass from there
unmoved; the others are rebuilt from the pieces between and the surrogates.

The key is a secret: whoever has it can test guesses. It is given by the caller or by the setting
``spark.starmill.surrogate.key``; without either a public one is used, with a warning.

Defined cases: a null text stays null, an empty one empty. Repeated rows are treated alike.
Columns other than ``text`` pass through. No rows give no rows.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import query, store, table, whole_row

KEY_SETTING = "spark.starmill.surrogate.key"
PUBLIC_KEY = "change me: whoever has this key can test guesses"
ATTEMPTS = 200
LENGTHEN = 8  # attempts after which a surrogate is one character longer

# How each type is written. Order is the order in which they are tried.
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9][\p{L}0-9._%+-]{0,63}@[\p{L}0-9][\p{L}0-9.-]{0,190}\.\p{L}{2,24}"
SECRET = (
    r"(?i:(?<![\p{L}0-9])(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
    # a value of any length up to a space or quote, with a letter or digit; marks that close a phrase are not part of it
    r"(?=[^\s\"'\p{L}\p{N}]*+[\p{L}\p{N}])[^\s\"']*[^\s\"',;.:)\]}>]"
)
HEX = r"(?<![\p{L}0-9])(?=[0-9a-fA-F]{0,23}[0-9])[0-9a-fA-F]{24,}(?![\p{L}0-9])"
ACCESS = r"(?<![\p{L}0-9])AKIA[0-9A-Z]{16}(?![\p{L}0-9])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
IP6 = (
    r"(?<![\p{L}0-9:.])(?=[a-fA-F:]{0,39}[0-9])"
    r"(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\p{L}0-9:])"
)
IBAN = r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}0-9])"
PHONE = (
    r"(?<![\p{L}0-9])(?:\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){3,4}"
    r"|\+[0-9]{8,15}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
HE = ("Mr", "Herr", "Monsieur", "Señor", "господин")
SHE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "госпожа")
NAME = r"\p{Lu}(?:['’-]?\p{L})+(?<!['’]s)"  # O'Neill, but not the genitive
PERSON = rf"(?<!\p{{L}})(?:{'|'.join((*SHE, *HE))})\.? {NAME}(?: {NAME})?"
PATTERNS = {
    "email": EMAIL, "secret": SECRET, "hex": HEX, "access": ACCESS, "ip": IP, "ip6": IP6, "iban": IBAN,
    "phone": PHONE, "ssn": SSN, "card": CARD, "person": PERSON,
}
ANY = "|".join(PATTERNS.values())
LAYOUT_FREE = ("phone", "ssn", "card", "iban")  # kinds whose separators do not count
ONSETS = ("b", "d", "f", "g", "k", "l", "m", "n", "p", "r", "s", "t", "v", "z", "br", "dr")
VOWELS = ("a", "e", "i", "o", "u")
ENDINGS = {
    "he": ("on", "us", "ard", "er", "im", "ek"),
    "she": ("a", "ina", "ia", "elle", "ette", "ila"),
    "family": ("son", "mann", "ez", "ier", "ell", "ova"),
}
LATIN, CYRILLIC = "abdefgiklmnoprstuvz", "абдефгиклмнопрстувз"


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def _kind(found: Column) -> Column:
    """The first type whose pattern fits a found string whole."""
    kinds = [F.when(found.rlike(rf"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()]
    return F.coalesce(*kinds, F.lit("secret"))


def _number(*parts: Column) -> Column:
    """A keyed number below 2^40."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 10), 16, 10).cast("long")


def _pick(choices: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (number % len(choices)).cast("int") + 1)


def _luhn(body: Column) -> Column:
    """The check digit that a card number without its last digit asks for."""
    digit = lambda c: c.try_cast("int")
    doubled = F.transform(
        F.reverse(F.split(body, "")),
        lambda c, i: F.when(i % 2 == 1, digit(c)).otherwise(digit(c) * 2 - F.when(digit(c) > 4, 9).otherwise(0)),
    )
    return ((10 - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")


def _mod_97(country: Column, account: Column) -> Column:
    """The two check digits that a bank account number asks for."""
    values = F.transform(
        F.split(F.concat(account, country, F.lit("00")), ""),
        lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(values, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _like_characters(value: Column, key: Column, attempt: int) -> Column:
    """Each letter and digit replaced by a keyed one of its class."""
    hexadecimal = value.rlike("^(?:[0-9a-f:]+|[0-9A-F]+)$")
    letters = F.when(hexadecimal, 6).otherwise(26)

    def changed(c: Column, i: Column) -> Column:
        n = _number(key, F.col("kind"), F.col("form"), F.lit(str(attempt)), i.cast("string"))
        letter = F.when(c.rlike(r"\p{Lu}"), F.lit(65)).otherwise(F.lit(97))
        return (
            F.when(c.rlike(r"\p{N}"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{L}"), F.char(letter + n % letters))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), changed), "")


def _name(role: str, key: Column, attempt: int) -> Column:
    def n(part: str) -> Column:
        return _number(key, F.col("kind"), F.col("form"), F.lit(f"{attempt}{part}"))

    syllables = [_pick(c, n(f"{i}{j}")) for i in range(2 + attempt // 4) for j, c in enumerate((ONSETS, VOWELS))]
    latin = F.concat(*syllables, _pick(ONSETS[:14], n("last")), _pick(ENDINGS[role], n("end")))
    cyrillic = F.translate(latin, LATIN, CYRILLIC)
    return F.initcap(F.when(F.col("form").rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(latin))


def drawn_surrogates(forms: DataFrame, key: Column, attempt: int) -> DataFrame:
    """``forms`` with the surrogate ``made`` of each ``form`` of a ``kind`` at this attempt."""
    # short forms run out, so all kinds lengthen as the names do: nothing at first, then one keyed digit or letter more
    more = [_number(key, _kind_form(), F.lit(f"{attempt}+{i}")) for i in range(attempt // LENGTHEN)]
    digits = F.concat(F.lit(""), *[(n % 10).cast("string") for n in more])
    letters = F.concat(F.lit(""), *[F.char(97 + n % 26) for n in more])
    octets = [(1 + _number(key, _kind_form(), F.lit(f"{attempt}.{i}")) % 254).cast("string") for i in range(4)]
    form = F.col("form")
    country, account = F.substring(form, 1, 2), F.substring(form, F.lit(5), F.length(form))
    checked = F.when(_is("card"), _luhn(F.substring(form, F.lit(1), F.length(form) - 1)) == F.substring(form, -1, 1)).when(
        _is("iban"), _mod_97(country, account) == F.substring(form, 3, 2)
    )
    dot = F.length(form) - F.locate(".", F.reverse(form))  # what is before the last dot
    # country codes of numbers and banks stay
    start = F.when(_is("iban") & F.col("checked"), 5).when(_is("iban") | (_is("phone") & form.startswith("+")), 3).otherwise(1)
    value = F.substring(form, F.col("start"), F.when(_is("email"), dot).otherwise(F.length(form)))
    like = F.when(_is("email") | ~F.col("kind").isin("ip", "he", "she", "family"), _like_characters(F.col("value"), key, attempt))
    longer = F.concat("changed", digits)
    body = F.substring("longer", F.lit(1), F.length("longer") - 1)
    made = (
        F.when(_is("email"), F.concat("changed", letters, F.substring(form, dot + 1, F.length(form))))
        .when(_is("ip"), F.concat(F.concat_ws(".", *octets), F.lit(":" if more else ""), digits))
        .when(_is("he"), _name("he", key, attempt)).when(_is("she"), _name("she", key, attempt))
        .when(_is("family"), _name("family", key, attempt))
        .when(_is("card") & F.col("checked"), F.concat(body, _luhn(body)))
        .when(_is("iban") & F.col("checked"), F.concat(country, _mod_97(country, F.col("longer")), F.col("longer")))
        .otherwise(F.concat(F.substring(form, F.lit(1), F.col("start") - 1), F.col("longer")))
    )
    steps = {"checked": F.coalesce(checked, F.lit(False)), "start": start, "value": value, "changed": like, "longer": longer, "made": made}
    return reduce(lambda df, c: df.withColumn(*c), steps.items(), forms).select("kind", "form", "made")


def _kind_form() -> Column:
    return F.concat_ws("\x1f", "kind", "form")


def _gender(title: Column) -> Column:
    return F.when(title.rlike(rf"^(?:{'|'.join(HE)})\.?$"), "he").otherwise("she")


def _names(found: Column) -> Column:
    """kind and name of all words of the persons among the found strings, longest first."""

    def of_person(person: Column) -> Column:
        words = F.split(person, " ")
        name = lambda kind, i: F.struct(F.length(F.get(words, F.lit(i))).alias("n"), F.get(words, F.lit(i)).alias("name"), kind.alias("kind"))
        both = F.array(name(_gender(F.get(words, F.lit(0))), 1), name(F.lit("family"), 2))
        return F.when(F.size(words) > 2, both).otherwise(F.array(name(F.lit("family"), 1)))

    persons = F.filter(found, lambda f: f.rlike(rf"^(?:{PERSON})$"))
    return F.sort_array(F.array_distinct(F.flatten(F.transform(persons, of_person))), asc=False)


def _pattern_with(names: Column) -> Column:
    """What is private in a text with these names: the names alone as well. They are letters, hyphens and apostrophes."""
    alone = F.array_join(F.transform(names, lambda x: x["name"]), "|")
    return F.when(F.size(names) > 0, F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}])(?=\p{{Lu}})(?:"), alone, F.lit(r")(?!\p{L})"))).otherwise(F.lit(ANY))


def _parts(found: Column, names: Column) -> Column:
    """kind, form, before (kept text) and own (replaced text) of each part of a found string."""

    def part(kind: Column, form: Column, before: Column, own: Column) -> Column:
        return F.struct(kind.alias("kind"), form.alias("form"), before.alias("before"), own.alias("own"))

    kind, none = _kind(found), F.lit("")
    words = F.split(found, " ")
    gender = _gender(F.element_at(words, 1))
    alone = F.get(F.filter(names, lambda x: x["name"] == found), F.lit(0))
    title = F.concat(F.element_at(words, 1), F.lit(" "))
    last = F.get(words, F.size(words) - 1)
    given = part(gender, F.get(words, F.lit(1)), title, F.get(words, F.lit(1)))
    person = F.when(F.size(words) > 2, F.array(given, part(F.lit("family"), last, F.lit(" "), last))).otherwise(
        F.array(part(F.lit("family"), last, title, last))
    )
    prefix = F.regexp_extract(found, r"^([^:=]*[:=]\s*[\"']?)", 1)
    value = F.substring(found, F.length(prefix) + 1, F.length(found))
    bare = F.regexp_replace(found, r"[^0-9A-Z+]", "")
    return (
        F.when(alone.isNotNull(), F.array(part(alone["kind"], found, none, found)))
        .when(kind == "person", person)
        .when(kind == "secret", F.array(part(kind, value, prefix, value)))
        .when(kind.isin("email", "ip6"), F.array(part(kind, F.lower(found), none, found)))
        .when(kind.isin(*LAYOUT_FREE), F.array(part(kind, bare, none, found)))
        .otherwise(F.array(part(kind, found, none, found)))
    )


def _poured(own: Column, form: Column, made: Column) -> Column:
    """A surrogate in the layout and case of one place."""
    marks = F.split(own, "")
    place = F.transform(
        F.sequence(F.lit(1), F.length(own)),
        lambda i: F.length(F.regexp_replace(F.substring(own, F.lit(1), i), r"[^0-9A-Z+]", "")),
    )
    number = F.array_join(
        F.zip_with(marks, place, lambda c, i: F.when(c.rlike("[0-9A-Z+]"), F.substring(made, i, F.lit(1))).otherwise(c)), ""
    )
    number = F.concat(number, F.substring(made, F.length(form) + 1, F.length(made)))  # of a lengthened one
    shouted = F.when((own == F.upper(own)) & (form == F.lower(form)), F.upper(made)).otherwise(made)
    return F.when(F.col("kind").isin(*LAYOUT_FREE), number).when(F.col("kind").isin("email", "ip6"), shouted).otherwise(made)


def surrogates(forms: DataFrame, key: str) -> DataFrame:
    """One distinct surrogate for each distinct (kind, form)."""
    keyed, todo, done = F.lit(key), forms, []
    for attempt in range(ATTEMPTS):
        drawn = store(drawn_surrogates(todo, keyed, attempt), "surrogates")
        first = drawn.groupBy("kind", "made").agg(F.min("form").alias("form"))
        taken = reduce(DataFrame.union, [d.select("kind", "made") for d in done], forms.select("kind", F.col("form").alias("made")))
        free = store(first.join(taken, ["kind", "made"], "left_anti").select("kind", "form", "made"), "free")
        done.append(free)
        todo = store(drawn.select("kind", "form").join(free, ["kind", "form"], "left_anti"), "collided")
        if todo.isEmpty():
            return reduce(DataFrame.union, done)
    raise ValueError(f"surrogates still collide after {ATTEMPTS} attempts")


def configured_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        logging.getLogger(__name__).warning("%s is not set: surrogates are made with a public key", KEY_SETTING)
    return key or PUBLIC_KEY


def replace_private(docs: DataFrame, key: str | None = None) -> DataFrame:
    """The rows of ``docs`` as ``row`` with ``new_text`` and ``n_replaced``."""
    key = key or configured_key(docs.sparkSession)
    text = F.col("row.text")
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANY), F.lit(0))
    named = docs.select(whole_row()).withColumn("found", found).withColumn("names", _names(F.col("found")))
    again = F.when(F.size("names") > 0, F.regexp_extract_all(text, _pattern_with(F.col("names")), F.lit(0))).otherwise(F.col("found"))
    rows = store(named.withColumn("found", again).withColumn("number", F.monotonically_increasing_id()), "private")
    clean = rows.filter(F.size("found") == 0).select(
        "row", F.col("row.text").alias("new_text"), F.lit(0).cast("long").alias("n_replaced")
    )
    hit = rows.filter(F.size("found") > 0)
    places = hit.select("number", "names", F.posexplode("found").alias("place", "found"))
    parts = places.select("number", "place", F.posexplode(_parts(F.col("found"), F.col("names"))).alias("part", "p")).select(
        "number", "place", "part", "p.*"
    )
    made = surrogates(store(parts.select("kind", "form").distinct(), "forms"), key)
    poured = F.concat("before", _poured(F.col("own"), F.col("form"), F.col("made")))
    one = parts.join(made, ["kind", "form"]).select("number", "place", "part", poured.alias("new"))

    def ordered(column: str, *by: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct(*by, column))), lambda x: x[column])

    whole = one.groupBy("number", "place").agg(F.array_join(ordered("new", "part"), "").alias("new"))
    per_text = whole.groupBy("number").agg(ordered("new", "place").alias("new"))
    between = F.split(F.col("row.text"), _pattern_with(F.col("names")), -1)
    text = F.array_join(F.zip_with(between, "new", lambda b, n: F.concat(b, F.coalesce(n, F.lit("")))), "")
    rebuilt = hit.join(per_text, "number").select("row", text.alias("new_text"), F.size("found").cast("long").alias("n_replaced"))
    return clean.union(rebuilt)


def without_private(docs: DataFrame, key: str | None = None) -> DataFrame:
    """``docs`` with the new texts, and their length where there is an ``n_chars``."""
    out = replace_private(docs, key)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return out.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


@query("op5_surrogate_generation")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_private(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", F.col("new_text").alias("text"), "n_replaced")
