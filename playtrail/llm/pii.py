"""Surrogates for personal data and secrets, in native SQL expressions.

Detected are e-mail addresses, card numbers, phone numbers, IPv4 addresses,
cloud access keys, secrets given after ``password=`` and the like, quoted
hexadecimal tokens, and names behind a form of address. All patterns are one
alternation, so the matches of a text and the pieces between them line up.

**Replacement.** An entity's value goes through a keyed Feistel permutation of
the strings of its own format: every letter stays a letter of its case, every
digit a digit, marks stay where they are. A permutation gives different values
different surrogates (distinctness), equal values equal ones in all documents
(coreference). What is drawn for is a value's normal form: an e-mail address in lower
case, the digits of a card or phone number (a number without a country code is one of
country code 1), a given and a family name each by itself, in lower case and without
the form of address. The surrogate is then written as the value was: its case, its marks.
Type rules keep what makes a value valid: the provider's domain
of an e-mail address, a card's first digit and its check digit, a phone
number's country code and exchange, an access key's prefix, octets below 256.
Names are drawn by key: a given name of the same gender and script (several with
hyphens once the pool is used up), and a family name put together from syllables of that
script. In a document that holds a name behind a form of address, its given and family
name are replaced wherever they stand as capitalized words.

**Collision check.** All distinct entities form a dictionary. A surrogate that is
itself a value found in the corpus, or is shared with another entity, is drawn again
with the next attempt number until none is left; what is settled is never
moved. (After ``ATTEMPTS`` draws a format counts as used up, and the surrogate is a
keyed tag in brackets.) Documents without an entity never meet the dictionary; the others
join it by a hash of their text.

Nulls and ties: a null or empty text stays as it is, repeated rows stay
repeated, all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut

KEY = "surrogates-1"
ROUNDS = 4
ATTEMPTS = 40

# Forms of address and name pools by gender and script.
MALE_TITLES = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа")
GIVEN = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo"),
    ("f", "latin"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Laura"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Ирина", "Лидия", "Мария", "Нина"),
}
FAMILY = {
    "latin": ("Aber", "Bell", "Corn", "Dal", "Esk", "Fern", "Gold", "Hart", "Ing", "Jar", "Kest", "Lund", "Mar", "Nor"),
    "cyrillic": ("Абр", "Бел", "Вол", "Гор", "Дуб", "Ел", "Жук", "Зим", "Ив", "Кот", "Лис", "Мор"),
}
ENDINGS = {
    ("m", "latin"): ("son", "man", "berg", "field", "ton", "wood"),
    ("f", "latin"): ("son", "man", "berg", "field", "ton", "wood"),
    ("m", "cyrillic"): ("ов", "ин", "ев", "кин"),
    ("f", "cyrillic"): ("ова", "ина", "ева", "кина"),
}
MIDDLES = {"latin": ("a", "e", "i", "o", "u", "er", "en", "el"), "cyrillic": ("а", "е", "и", "о", "ан", "ер", "ел")}

_WORD = r"\p{Lu}[\p{L}'’\-]*\p{L}"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}",
    "secret": r"(?i:password|passwd|pwd|secret|api[_\-]?key|token)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_\-]{8,128}",
    "access": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "hex": r"(?<![0-9A-Za-z])[0-9a-f]{40}(?![0-9A-Za-z])",
    "card": r"(?<![0-9.])(?:[0-9]{4}[ \-]?){3}[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .\-]?\(?[0-9]{2,4}\)?(?:[ .\-]?[0-9]{2,4}){2,3}(?![0-9])",
    "local": r"(?<![0-9A-Za-z])\(?[0-9]{3}\)?[ .\-][0-9]{3}[ .\-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "name": r"(?<!\p{L})(?:" + "|".join(MALE_TITLES + FEMALE_TITLES) + rf")\.? {_WORD}(?: {_WORD})?",
}
ANY = "|".join(PATTERNS.values())
# What every pattern needs: texts without it are passed on after one plain scan.
HINT = r"[@+0-9]|AKIA|ASIA|[a-f]{40}|" + "|".join(MALE_TITLES + FEMALE_TITLES) + r"|(?i:password|passwd|pwd|secret|api[_\-]?key|token)\s{0,3}[=:]"




def has_entity(text: Column) -> Column:
    """Does a text hold an entity? Null: no."""
    return F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))


def entities(text: Column) -> Column:
    """The detected values of a text, in order, repeats included."""
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def kind(value: Column) -> Column:
    """The type of a detected value: the first pattern that covers all of it."""
    out = F
    for name, pattern in PATTERNS.items():
        out = out.when(value.rlike(f"^(?:{pattern})$"), F.lit(name))
    return out.otherwise(F.lit("name"))


def _number(digest: Column, at: int, below: int) -> Column:
    """A number drawn from a hexadecimal digest."""
    return (F.conv(F.substring(digest, at, 8), 16, 10).cast("long") % below).cast("int")


def _pick(pool: tuple[str, ...], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in pool]), _number(digest, at, len(pool)) + 1)


# One character moved by ``s`` places within its ring; marks stay.
_MOVED = """array_join(transform(split(_t, ''), (c, i) -> CASE
  WHEN kind = 'hex' THEN substring('0123456789abcdef',
    (instr('0123456789abcdef', c) - 1 + cast(conv(substring(_h, (i * 2) % 192 + 1, 2), 16, 10) as int)) % 16 + 1, 1)
  WHEN c BETWEEN '0' AND '9' THEN char(48 + (ascii(c) - 48 + cast(conv(substring(_h, (i * 2) % 192 + 1, 2), 16, 10) as int)) % 10)
  WHEN c BETWEEN 'a' AND 'z' THEN char(97 + (ascii(c) - 97 + cast(conv(substring(_h, (i * 2) % 192 + 1, 2), 16, 10) as int)) % 26)
  WHEN c BETWEEN 'A' AND 'Z' THEN char(65 + (ascii(c) - 65 + cast(conv(substring(_h, (i * 2) % 192 + 1, 2), 16, 10) as int)) % 26)
  ELSE c END), '')"""


def _permuted(rows: DataFrame, key: str) -> DataFrame:
    """The column ``core`` after a keyed Feistel permutation of its format: the
    halves shift each other, character by character, within each character's ring."""
    half = F.floor(F.length("core") / 2).cast("int")
    rows = rows.withColumns(
        {"_a": F.substring("core", F.lit(1), half), "_b": F.substring(F.col("core"), half + 1, F.length("core"))}
    )
    for r in range(ROUNDS):
        source, target = ("_a", "_b") if r % 2 else ("_b", "_a")
        digest = F.sha2(
            F.concat_ws("\x1f", F.lit(f"{key}/{r}"), "kind", F.col("attempt").cast("string"), "shape", source), 256
        )
        rows = rows.withColumns({"_t": F.col(target), "_h": digest})
        rows = rows.withColumn("_h", F.concat("_h", F.sha2(F.concat("_h", F.lit("1")), 256), F.sha2(F.concat("_h", F.lit("2")), 256)))
        rows = rows.withColumn(target, F.when(F.length("_t") > 0, F.expr(_MOVED)).otherwise(F.lit("")))
    return rows.withColumn("core", F.concat("_a", "_b")).drop("_a", "_b", "_t", "_h")


def _checksum(digits: Column, last: bool) -> Column:
    """Sum of the card check over the digits of a string; ``last``: the check digit is among them."""
    order = F.split(F.reverse(F.regexp_replace(digits, "[^0-9]", "")), "")

    def share(c: Column, i: Column) -> Column:
        twice = c.try_cast("int") * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when((i % 2 == 1) if last else (i % 2 == 0), doubled).otherwise(c.try_cast("int"))

    return F.aggregate(F.transform(order, share), F.lit(0), lambda t, x: t + x)


def draw(rows: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, attempt) with a column ``surrogate``; values and surrogates in normal form."""
    value, what = F.col("value"), F.col("kind")
    reserved = value.rlike(r"(?i)@(?:[a-z0-9\-]+\.)*example\.(?:com|org|net)$")
    before = (
        F.when(what == "secret", F.regexp_extract("value", r"^[A-Za-z_\-]+\s{0,3}[=:]\s{0,3}[\"']?", 0))
        .when(what == "access", F.substring("value", 1, 4))
        .when(what == "card", F.substring("value", 1, 1))
        .when(what == "phone", F.regexp_extract("value", r"^\+[0-9]{1,3} ", 0))
        .otherwise(F.lit(""))
    )
    after = (
        F.when(reserved & (what == "email"), F.regexp_extract("value", "@.*$", 0))
        .when(what == "email", F.regexp_extract("value", r"\.[^.]*$", 0))
        .when((what == "card") & (_checksum(value, True) % 10 == 0), F.substring("value", -1, 1))
        .otherwise(F.lit(""))
    )
    rows = rows.withColumns({"_before": before, "_after": after})
    core = F.expr("substring(value, length(_before) + 1, length(value) - length(_before) - length(_after))")
    # The exchange 555 is in no use: it stays, hidden from the permutation.
    hidden = F.regexp_replace(core, "^([0-9]{3})555([0-9]{4})$", "$1\u0001\u0002\u0003$2")
    core = F.when((what == "phone") & value.startswith("+1 "), hidden).otherwise(core)
    rows = rows.withColumn("core", core)
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("core", "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    rows = rows.withColumn("shape", F.when(what == "hex", F.length("core").cast("string")).otherwise(shape))
    rows = _permuted(rows, key)
    rows = rows.withColumn("core", F.regexp_replace("core", "\u0001\u0002\u0003", "555"))
    check = ((10 - _checksum(F.concat("_before", "core"), False) % 10) % 10).cast("string")
    plain = F.concat("_before", "core", F.when(what == "card", F.when(F.length("_after") > 0, check).otherwise("")).otherwise(F.col("_after")))

    # IPv4: a permutation of the 32-bit number, two halves of 16 bits.
    octet = F.split("value", r"\.")

    def part(i: int) -> Column:
        return F.when(what == "ip", F.get(octet, F.lit(i)).try_cast("int"))

    rows = rows.withColumns(
        {"_l": part(0) * 256 + part(1), "_r": part(2) * 256 + part(3)}
    )
    for r in range(ROUNDS):
        mixed = F.sha2(F.concat_ws("\x1f", F.lit(f"{key}/ip/{r}"), F.col("attempt").cast("string"), F.col("_r").cast("string")), 256)
        rows = rows.withColumns({"_l": F.col("_r"), "_r": (F.col("_l") + _number(mixed, 1, 65536)) % 65536})
    four = F.concat_ws(".", *[(F.floor(F.col(h) / d) % 256).cast("int").cast("string") for h in ("_l", "_r") for d in (256, 1)])

    # Names: a given name of the pool, one more every other attempt; a family name of syllables, one more each attempt.
    digest = F.sha2(F.concat_ws("\x1f", F.lit(f"{key}/name"), F.col("attempt").cast("string"), "value"), 256)
    rows = rows.withColumn("_d", digest)
    head = F.regexp_extract("value", "^[^/]*/[^/]*/[^/]*/", 0)
    name = F
    for (gender, script), pool in GIVEN.items():
        parts = [_pick(MIDDLES[script], F.col("_d"), 17 + 2 * k) for k in range(12)]
        family = F.concat(
            _pick(FAMILY[script], F.col("_d"), 9),
            F.array_join(F.slice(F.array(*parts), F.lit(1), F.least(F.col("attempt") + 2, F.lit(12))), ""),
            _pick(ENDINGS[gender, script], F.col("_d"), 41),
        )
        several = [_pick(pool, F.col("_d"), 1 + 4 * k) for k in range(12)]
        count = F.least(F.floor(F.col("attempt") / 2).cast("int") + 1, F.lit(12))
        given = F.array_join(F.slice(F.array(*several), F.lit(1), count), "-")
        drawn = F.lower(F.when(what == "given", given).otherwise(family))
        name = name.when(head.endswith(f"/{gender}/{script}/"), F.concat(head, drawn))
    tag = F.concat(F.lit("["), "kind", F.lit("-"), F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "value"), 256), 1, 32), F.lit("]"))
    surrogate = F.when(F.col("attempt") >= ATTEMPTS, tag).when(what == "ip", four).when(what.isin("given", "family"), name).otherwise(plain)
    return rows.select("kind", "value", "attempt", surrogate.alias("surrogate"))


# Country codes of one and two digits; all others have three.
_COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_POSSESSIVE = r"['’][sS]$"


def normal(values: DataFrame) -> DataFrame:
    """(value, kind, norm, given): the normal form of every distinct value, for a name that
    of the family name, and that of the given name if it has one (else null)."""
    value, what = F.col("value"), F.col("kind")
    rows = values.select("value").distinct().withColumn("kind", kind(value))
    digits = F.regexp_replace("value", "[^0-9]", "")
    digits = F.when(what == "local", F.concat(F.lit("1"), digits)).otherwise(digits)
    number = F.concat(F.lit("+"), F.regexp_extract(digits, _COUNTRY, 0), F.lit(" "), F.regexp_replace(digits, _COUNTRY, ""))
    words = F.transform(F.split(F.regexp_replace("value", r"^\p{L}+\.? ", ""), " "), lambda w: F.lower(F.regexp_replace(w, _POSSESSIVE, "")))
    latin = ~F.regexp_replace("value", r"^\S+", "").rlike(r"\p{IsCyrillic}")
    female = F.regexp_extract("value", r"^\p{L}+", 0).isin(*FEMALE_TITLES)
    script = F.when(latin, "latin").otherwise("cyrillic")
    gender = F.when(female, "f").otherwise("m")
    # Latin family names don't show a gender.
    family = F.concat(F.lit("family/"), F.when(latin, "m").otherwise(gender), F.lit("/"), script, F.lit("/"), F.element_at(words, -1))
    given = F.concat(F.lit("given/"), gender, F.lit("/"), script, F.lit("/"), F.element_at(words, 1))
    norm = (
        F.when(what == "email", F.lower("value"))
        .when(what == "card", digits)
        .when(what.isin("phone", "local"), number)
        .when(what == "name", family)
        .otherwise(value)
    )
    return rows.select("value", "kind", norm.alias("norm"), F.when((what == "name") & (F.size(words) > 1), given).alias("given"))


# A name's part as it is written: hyphenated parts with capitals; all capitals after a word in all capitals.
_WRITTEN = """CASE WHEN startswith({s}, '[') THEN {s}
  ELSE array_join(transform(split(substring_index({s}, '/', -1), '-'), w -> initcap(w)), '-') END"""
_LIKE = "CASE WHEN length({w}) > 1 AND upper({w}) = {w} AND NOT startswith({s}, '[') THEN upper({s}) ELSE {s} END"
_WORDS = "split(regexp_replace(value, '^\\\\p{L}+\\\\.? ', ''), ' ')"
_PUT = f"""CASE
  WHEN kind = 'name' THEN concat(regexp_extract(value, '^\\\\p{{L}}+\\\\.? ', 0), array_join(transform({_WORDS}, (t, i) ->
    concat({_LIKE.format(w="regexp_replace(t, _poss, '')", s=f"(CASE WHEN i = size({_WORDS}) - 1 THEN _family ELSE _given END)")},
    regexp_extract(t, _poss, 0))), ' '))
  WHEN startswith(surrogate, '[') THEN surrogate
  WHEN kind = 'email' THEN array_join(transform(split(value, ''), (c, i) ->
    CASE WHEN c BETWEEN 'A' AND 'Z' THEN upper(substring(surrogate, i + 1, 1)) ELSE substring(surrogate, i + 1, 1) END), '')
  WHEN kind IN ('card', 'phone', 'local') THEN array_join(transform(split(value, ''), (c, i) -> CASE WHEN c BETWEEN '0' AND '9' THEN
    substring(regexp_replace(surrogate, '[^0-9]', ''), length(regexp_replace(substring(value, 1, i + 1), '[^0-9]', ''))
      + CASE WHEN kind = 'local' THEN 1 ELSE 0 END, 1) ELSE c END), '')
  ELSE surrogate END"""


def surrogates(values: DataFrame, key: str = KEY) -> DataFrame:
    """(value, surrogate, names) for distinct values as they are written; ``names`` are the
    parts of a name, in lower case, with what stands for them."""
    rows = cut(normal(values))
    forms = rows.select(F.when(F.col("kind") == "name", "family").when(F.col("kind") == "local", "phone").otherwise(F.col("kind")).alias("kind"), F.col("norm").alias("value"))
    forms = forms.unionByName(rows.filter("given is not null").select(F.lit("given").alias("kind"), F.col("given").alias("value")))
    found = cut(dictionary(forms, key))
    own = found.select(F.col("value").alias("norm"), "surrogate")
    second = found.select(F.col("value").alias("_second"), F.col("surrogate").alias("_drawn"))
    # Values without a given name look up their own form again, so that no null is a key.
    rows = rows.join(own, "norm").withColumn("_second", F.coalesce("given", "norm")).join(second, "_second")
    rows = rows.withColumns(
        {"_family": F.expr(_WRITTEN.format(s="surrogate")), "_given": F.expr(_WRITTEN.format(s="_drawn")), "_poss": F.lit(_POSSESSIVE)}
    )
    part = lambda rank, norm, new: F.struct(F.substring_index(norm, "/", -1).alias("word"), F.lit(rank).alias("rank"), F.col(new).alias("new"))
    names = F.array_compact(
        F.array(
            F.when(F.col("kind") == "name", part(0, "norm", "_family")),
            F.when(F.col("given").isNotNull(), part(1, "given", "_given")),
        )
    )
    return rows.select("value", F.expr(_PUT).alias("surrogate"), names.alias("names"))


def dictionary(values: DataFrame, key: str = KEY) -> DataFrame:
    """(value, surrogate) for distinct values (in normal form; with a column ``kind``, if that
    can't be told from the value): one to one, and no surrogate is a value."""
    known = F.col("kind") if "kind" in values.columns else kind(F.col("value"))
    named = cut(values.select("value", known.alias("kind")).distinct())
    settled = None
    open_ = named.withColumn("attempt", F.lit(0))
    while True:
        drawn = cut(draw(open_, key))
        # Free: no value of the corpus, not settled before, and the smallest value among equal draws.
        first = drawn.groupBy("surrogate").agg(F.min("value").alias("value"))
        free = first.join(named.select(F.col("value").alias("surrogate")), "surrogate", "left_anti")
        if settled is not None:
            free = free.join(settled.select("surrogate"), "surrogate", "left_anti")
        free = cut(free.select("value", "surrogate"))
        settled = free if settled is None else settled.unionByName(free)
        open_ = cut(drawn.join(free, "value", "left_anti").select("kind", "value", (F.col("attempt") + 1).alias("attempt")))
        if open_.isEmpty():
            return settled


# Where a text is cut around words that may be names: at the beginning and end of words
# and in front of a possessive; hyphenated words are one piece.
_AROUND = r"(?<!\p{L})(?<!\p{L}['’\-])(?=\p{Lu})|(?<=\p{L})(?!\p{L}|['’\-]\p{L})|(?<=\p{L})(?=['’][sS](?!\p{L}))"


def replace(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text`` replaced by its surrogate; the number
    of replacements in a column ``count``, if one is asked for."""
    names = docs.columns
    text = F.col("_row.text").cast("string")
    rows = docs.select(F.struct(*names).alias("_row"))
    marked = rows.filter(has_entity(text)).withColumn("_hash", F.sha2(text, 256))
    clean = rows.filter(~has_entity(text))
    found = marked.groupBy("_hash").agg(F.first(F.array_distinct(entities(text))).alias("values"))
    found = cut(found.select("_hash", F.explode("values").alias("value")))
    pairs = found.join(surrogates(found, key), "value")
    # A word may be a given and a family name of one document: the family name goes first.
    maps = pairs.groupBy("_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("_map"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("_names"),
    )
    once = F.expr("transform(filter(_names, (x, i) -> i = 0 OR _names[i - 1].word <> x.word), x -> struct(x.word, x.new))")
    maps = cut(maps.withColumn("_names", F.map_from_entries(once)))
    # The text between entities, cut around capitalized words only if the document has names to look for.
    joined = marked.join(maps, "_hash").withColumns(
        {"_found": entities(text), "_pieces": F.split(text, ANY, -1)}
    )
    joined = joined.withColumn("_cut", F.when(F.size("_names") > 0, F.lit(_AROUND)).otherwise(F.lit(r"\z")))
    joined = joined.withColumn("_pieces", F.expr("transform(_pieces, p -> split(p, _cut, -1))"))
    spot = f"CASE WHEN _names[lower(t)] IS NULL OR NOT t RLIKE '^\\\\p{{Lu}}' THEN t ELSE {_LIKE.format(w='t', s='_names[lower(t)]')} END"
    new = F.expr(
        f"array_join(transform(_pieces, (p, i) -> concat(array_join(transform(p, t -> {spot}), ''), CASE WHEN i < size(_found) "
        "THEN coalesce(_map[_found[i]], '[removed]') ELSE '' END)), '')"
    )
    spots = F.expr("aggregate(_pieces, 0, (n, p) -> n + size(filter(p, t -> _names[lower(t)] IS NOT NULL AND t RLIKE '^\\\\p{Lu}')))")
    done = joined.select(
        *[new.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in names],
        *([(F.size("_found") + spots).cast("long").alias(count)] if count else []),
    )
    same = clean.select("_row.*", *([F.lit(0).cast("long").alias(count)] if count else []))
    return done.unionByName(same)
