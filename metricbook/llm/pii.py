"""Keyed surrogates for personal data and secrets.

Entities are found by pattern, brought to a canonical form (so that every spelling of one entity is one
row), and given a surrogate drawn from a keyed digest: a letter stays a letter of its script and case, a
digit a digit of its kind, separators stay. Candidates are checked over the whole corpus: one that two
entities share, that is itself an entity of the corpus, or that contains the entity it stands for, is drawn
again with the next attempt number, so distinct entities stay distinct and one entity has one surrogate
everywhere.

Names are found by their title and mapped in two parts, so that all forms of a name agree: a given name of a
gender has one surrogate of this gender (a title that tells none, as Dr, leaves the gender open and draws
names that tell none), a family name one for all who bear it, both in the script of the original. Then the
texts in which a name was found are read once more for its bare forms: a given or family name from a title's
name also goes where it stands alone as a whole word. Where one given name belongs to two genders there, the
bare one follows the first mention.

Case matters in secrets, and only there in the canonical form; addresses and numbers are told apart without.

Defined results: a null text stays null with no entity, an empty one stays empty; repeated rows get equal
results; texts without entities are returned as they are; all other columns pass through, whatever their
names. Row identity comes from the files, so ids may repeat or be null. Not found: names without a title
anywhere in their text, titles that follow the name, names in scripts without capital letters, IPv6 addresses
without a digit (so that a::b in program text stays).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricbook.llm.common import ROW_FILE, ROW_INDEX, let, materialise, named_rows

MALE_TITLES = ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Signor", "Господин", "Господина", "Κύριος", "Κύριο"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Signora", "Госпожа",
                 "Госпожу", "Κυρία"]
OPEN_TITLES = ["Mx", "Dr", "Doctor", "Prof", "Professor", "Доктор", "Профессор", "Δρ"]
_ALL_TITLES = sorted(MALE_TITLES + FEMALE_TITLES + OPEN_TITLES, key=len, reverse=True)
TITLES = "|".join(_ALL_TITLES)
_TITLED = rf"(?:(?:{TITLES})\.? ){{1,4}}"
_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}{1,40}+(?:-\p{Lu}\p{Ll}{1,40}+)?"
CREDENTIALS = ["token", "password", "passwd", "secret", "api_key"]
_KEY = rf"(?i:{'|'.join(CREDENTIALS)})[ ]?[=:][ ]?[\x22']?"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Entity patterns, tried in this order at every place of a text. Each begins with a look at one or
#: two characters that fails fast. A credential comes with its key and a name with its title: these
#: stay as they are.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+\-])[\p{L}\p{M}\p{N}._%+\-]++@(?:[\p{L}\p{M}\p{N}\-]++\.){1,32}[\p{L}\p{M}]{2,}+",
    "secret": r"(?=[Aa])(?<![\p{L}\p{N}])(?:AKIA|ASIA|akia|asia)[A-Za-z0-9]{16}(?![A-Za-z0-9])"
              rf"|(?=[TtPpSsAa])(?<![\p{{L}}\p{{N}}]){_KEY}[\p{{L}}\p{{N}}_\-+/]{{8,}}+",
    "ip": r"(?=[0-9])(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "ip6": rf"(?=[0-9A-Fa-f]{{0,4}}:)(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*+[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|::{_HEX}(?::{_HEX}){{0,6}}"
           rf"|(?:{_HEX}:){{2,7}}:)(?![\p{{L}}\p{{N}}:])",
    "card": r"(?=[0-9])(?<![\p{L}\p{N}])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\p{L}\p{N}])",
    "ssn": r"(?=[0-9])(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])",
    "phone": r"(?=[+(])(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"
             r"|(?=\+)(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
             r"|(?=[0-9])(?<![\p{L}\p{N}.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\p{L}\p{N}])",
    "name": rf"(?=[{''.join(sorted({t[0] for t in _ALL_TITLES}))}])(?<!\p{{L}}){_TITLED}(?!(?:{TITLES})(?!\p{{L}})){_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: The part of a credential or name that is kept.
KEPT = rf"^(?:{_KEY}|{_TITLED})"


def _worth_reading(text: Column) -> Column:
    """A cheap first look: every entity has a digit, an at sign, a title, an access key's prefix, or a
    credential's key in any mixture of cases."""
    titles = [t for t in _ALL_TITLES if not any(o != t and o in t for o in _ALL_TITLES)]
    found = text.rlike("[0-9@]")
    for hint in titles + ["AKIA", "ASIA", "akia", "asia"]:
        found |= text.contains(hint)
    found |= let(F.lower(text), lambda low: reduce(or_, [low.contains(c) for c in CREDENTIALS]))
    return F.coalesce(found, F.lit(False))


GIVEN_NAMES = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Ida", "Julia", "Laura", "Marta", "Nora", "Paula", "Vera"],
    ("latin", "m"): ["Adam", "Bruno", "David", "Erik", "Hugo", "Jonas", "Lukas", "Oscar", "Simon", "Viktor"],
    ("latin", "o"): ["Alex", "Charlie", "Jamie", "Kim", "Luca", "Robin", "Sam", "Sascha"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Лев", "Михаил", "Олег", "Пётр"],
    ("cyrillic", "o"): ["Саша", "Женя", "Валя", "Слава"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Σοφία", "Χριστίνα"],
    ("greek", "m"): ["Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
    ("greek", "o"): ["Φώτη", "Άγγελη", "Χάρη"],
}
#: How made-up given names end; a name that tells no gender takes either.
ENDINGS = {("latin", "f"): ["a", "ina", "ette"], ("latin", "m"): ["o", "us", "rik"], ("latin", "o"): ["y", "is"],
           ("cyrillic", "f"): ["а", "ия"], ("cyrillic", "m"): ["ан", "ир"], ("cyrillic", "o"): ["и"],
           ("greek", "f"): ["α", "ίνα"], ("greek", "m"): ["ος", "ης"], ("greek", "o"): ["ι"]}
SYLLABLES = {
    "latin": ["bar", "den", "fel", "gor", "hal", "kem", "lin", "mar", "nor", "pel", "rin", "sol", "tam", "ver", "wes", "zan"],
    "cyrillic": ["бар", "ден", "фел", "гор", "хал", "кем", "лин", "мар", "нор", "пел", "рин", "сол", "там", "вер", "зан", "юр"],
    "greek": ["βαρ", "δεν", "γορ", "καλ", "λιν", "μαρ", "νορ", "πελ", "ριν", "σολ", "ταμ", "φερ", "χαν", "ψιλ"],
}


def _kind(value: Column, kept: Column) -> Column:
    """Type of a whole match: the first pattern that matches it, for credentials and names by what comes first."""
    out = F.when(value.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    out = out.when(kept.rlike(f"^(?:{TITLES})\\.? "), "name").when((kept != "") | value.rlike("^(?i:akia|asia)[A-Za-z0-9]{16}$"), "secret")
    for kind in ("ip", "ip6", "card", "ssn"):
        out = out.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("phone")


def _canonical(kind: Column, value: Column) -> Column:
    """One form per entity: digits only for numbers (a phone's country code set apart), lower case for
    addresses; secrets and names as they are."""
    digits = F.regexp_replace(value, r"\D", "")
    country = F.regexp_extract(value, r"^(\+\d{1,3})[ .\-(]", 1)
    return (F.when((kind == "phone") & (country != ""), F.concat(country, F.lit("-"), F.substring(
                digits, F.length(country), F.length(digits))))
            .when(kind.isin("card", "ssn", "phone"), digits)
            .when(kind.isin("email", "ip6"), F.lower(value)).otherwise(value))


def mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """The parts of every entity found: row identity, ``pos`` of the match (from 0), ``part`` (a name has its given
    and its family name), ``kind``, ``canonical``, ``gender``, ``kept`` (what stands before: key, title, the
    blank between names) and ``value`` (the rest)."""
    found = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))
    # The outer form, because for the plain one Spark would evaluate the array once more in a filter.
    rows = (docs.where(_worth_reading(F.col(text))).select(ROW_FILE, ROW_INDEX, F.posexplode_outer(found).alias("pos", "_match"))
            .where("_match IS NOT NULL")
            .withColumn("kept", F.regexp_extract("_match", KEPT, 0)))
    rows = (rows.withColumn("kind", _kind(F.col("_match"), F.col("kept")))
            .withColumn("value", F.substring("_match", F.length("kept") + 1, F.length("_match"))))
    gender = F.when(F.col("kept").rlike(rf"(?<!\p{{L}})(?:{'|'.join(FEMALE_TITLES)})\.? "), "f").when(
        F.col("kept").rlike(rf"(?<!\p{{L}})(?:{'|'.join(MALE_TITLES)})\.? "), "m").otherwise("o")

    def part(kind: Column, canonical: Column, sex: Column, kept: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), canonical.alias("canonical"), sex.alias("gender"), kept.alias("kept"), value.alias("value"))

    none, words = F.lit(""), F.split("value", " ")
    plain = part(F.col("kind"), _canonical(F.col("kind"), F.col("value")), none, F.col("kept"), F.col("value"))
    last = F.element_at(words, -1)
    family = part(F.lit("family"), last, none, F.when(F.size(words) > 1, " ").otherwise(F.col("kept")), last)
    given = part(F.lit("given"), words[0], gender, F.col("kept"), words[0])
    parts = F.when(F.col("kind") != "name", F.array(plain)).when(F.size(words) > 1, F.array(given, family)).otherwise(F.array(family))
    return rows.select(ROW_FILE, ROW_INDEX, "pos", F.posexplode(parts).alias("part", "_p")).select(ROW_FILE, ROW_INDEX, "pos", "part", "_p.*")


def _draw(digest: Column, i: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(digest, i), F.lit(n)).cast("int") + 1


def _pick(options: list[str], digest: Column, salt: str) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), _draw(digest, F.lit(salt), len(options)))


def _code(c: Column) -> Column:
    """Number of a character of the basic plane (of others: that of their first half)."""
    return F.conv(F.substring(F.hex(F.encode(c, "UTF-16BE")), 1, 4), 16, 10).cast("int")


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


#: Letters of a script (pattern, first and last of a run of them from which its surrogates are drawn).
LETTERS = [(r"[a-z]|\p{IsLatin}(?<!\p{Lu})", "a", "z"), (r"[A-Z]|\p{IsLatin}", "A", "Z"),
           (r"\p{IsCyrillic}(?<!\p{Lu})", "а", "я"), (r"\p{IsCyrillic}", "А", "Я"),
           (r"\p{IsGreek}(?<!\p{Lu})", "σ", "ω"), (r"\p{IsGreek}", "Σ", "Ω"), (r"\p{IsArmenian}(?<!\p{Lu})", "ա", "ֆ"),
           (r"\p{IsArmenian}", "Ա", "Ֆ"), (r"\p{IsGeorgian}", "ა", "ჰ"), (r"\p{IsHebrew}", "א", "ת"), (r"\p{IsArabic}", "ف", "ي"),
           (r"\p{IsDevanagari}", "क", "ह"), (r"\p{IsThai}", "ก", "ฮ"), (r"\p{IsHiragana}", "ば", "も"), (r"\p{IsKatakana}", "バ", "モ"),
           (r"\p{IsHangul}", "가", "힣"), (r"\p{IsHan}", "一", "龥")]


def _same_shape(value: Column, digest: Column) -> Column:
    """Every digit and letter replaced by one of its kind (script and case), the rest kept."""
    def swap(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("^[0-9]"), (_draw(digest, i, 10) - 1).cast("string"))
        # Digits of other scripts stand in tens from ..0 or, in most scripts of India, from ..6.
        code = _code(c)
        zero = code - F.when(code.between(0x900, 0xDFF), (code - 6) % 16).otherwise(code % 16)
        out = out.when(c.rlike(r"^\p{Nd}") & (code < 0xD800), _char(zero + _draw(digest, i, 10) - 1))
        for pattern, first, last in LETTERS:
            out = out.when(c.rlike(f"^(?:{pattern})$") & c.rlike(r"^\p{L}"), _char(F.lit(ord(first) - 1) + _draw(digest, i, ord(last) - ord(first) + 1)))
        # Any other letter: a letter among its sixteen neighbours.
        near = F.filter(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: _char(code - code % 16 + k)), lambda x: x.rlike(r"^\p{L}"))
        neighbour = F.element_at(near, F.pmod(F.xxhash64(digest, i), F.greatest(F.size(near), F.lit(1))).cast("int") + 1)
        return out.when(c.rlike(r"^\p{L}") & (code < 0xD800), neighbour).otherwise(c)
    return F.array_join(F.transform(F.split(value, ""), swap), "")


def _hex_shape(value: Column, digest: Column) -> Column:
    """Hexadecimal digits replaced, in the case of the original's letters."""
    drawn = F.transform(F.split(value, ""), lambda c, i: F.when(
        c.rlike("^[0-9A-Fa-f]"), F.substring(F.lit("0123456789abcdef"), _draw(digest, i, 16), F.lit(1))).otherwise(c))
    low = F.array_join(drawn, "")
    return F.when(value.rlike("[A-F]"), F.upper(low)).otherwise(low)


#: Attempts after which a candidate gives up the shape of the original: a shape whose values are all taken or
#: all real (short numbers in a large corpus), or that has nothing to replace, has no free one. Numbers then
#: get one more digit each time, addresses a fresh name.
WIDEN_AFTER = 6


def _surrogate(key: str, attempt: int) -> Column:
    """Candidate for a canonical entity (columns kind, canonical, gender)."""
    kind, value, gender = F.col("kind"), F.col("canonical"), F.col("gender")
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, gender, value, F.lit(str(attempt))), 256)
    shaped = _same_shape(value, digest)
    octets = F.array_join(F.transform(F.split(value, r"\."), lambda o, i: F.when(
        F.lit(attempt >= WIDEN_AFTER // 2), _draw(digest, i, 254)).when(
        F.length(o) == 3, 100 + _draw(digest, i, 155) - 1).when(F.length(o) == 2, 10 + _draw(digest, i, 90) - 1)
        .otherwise(_draw(digest, i, 9)).cast("string")), ".")
    # The last digit of a card makes its check sum right where the original's is.
    body = F.substring(shaped, F.lit(1), F.length(value) - 1)
    card = F.when(_luhn(value) == 0, F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))) \
        .otherwise(shaped)
    at = F.regexp_extract(value, r"^(.*)@", 1)
    host = F.regexp_extract(value, r"@(.*)$", 1)
    email = F.concat(_same_shape(at, digest), F.lit("@"), _same_shape(F.regexp_extract(host, r"^(.*)\.", 1), F.concat(digest, F.lit("h"))),
                     F.lit("."), F.regexp_extract(host, r"([^.]*)$", 1))
    country = F.regexp_extract(value, r"^(\+\d+-)", 1)
    phone = F.concat(country, _same_shape(F.substring(value, F.length(country) + 1, F.length(value)), digest))
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    def syllables(s: str, n: int) -> Column:
        return F.concat(*[_pick(SYLLABLES[s], digest, f"s{i}") for i in range(n)])

    person = F.when(kind == "family", reduce(lambda w, s: w.when(script == s, F.initcap(syllables(s, 3 + attempt))),
                                             ["cyrillic", "greek"], F.when(script == "latin", F.initcap(syllables("latin", 3 + attempt)))))
    for (s, g), names in GIVEN_NAMES.items():
        name = _pick(names, digest, "g") if attempt == 0 else F.initcap(F.concat(syllables(s, attempt), _pick(ENDINGS[s, g], digest, "e")))
        person = person.when((script == s) & (gender == g), name)
    wide = max(0, attempt - WIDEN_AFTER)
    extra = F.concat(*[(_draw(digest, F.lit(f"x{i}"), 10) - 1).cast("string") for i in range(wide)], F.lit(""))
    fresh = F.when(kind == "email", F.concat(F.lit("x"), F.substring(digest, 1, 12), F.lit("@"), F.substring(digest, 13, 8), F.lit(".example"))
                   ).when(kind == "secret", F.substring(digest, 1, 40)) if wide else F.when(F.lit(False), "")
    shaped_as = (F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card).when(kind == "phone", phone)
                 .when(kind == "ip6", _hex_shape(value, digest)).when(kind.isin("given", "family"), person)
                 .when((kind == "secret") & value.rlike("^(?i:akia|asia)[A-Za-z0-9]{16}$"),
                       F.concat(F.substring(value, 1, 4), _same_shape(F.substring(value, F.lit(5), F.length(value)), digest)))
                 .when((kind == "secret") & value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), _hex_shape(value, digest))
                 .otherwise(shaped))
    return F.coalesce(fresh, F.concat(shaped_as, F.when(kind.isin("given", "family"), "").otherwise(extra)))


def _luhn(digits: Column) -> Column:
    """Check sum modulo 10 of a string of digits."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1))
        .otherwise(c.cast("int")))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda s, x: s + x), F.lit(10))


ENTITY = ["kind", "canonical", "gender"]


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """``kind``, ``canonical``, ``gender`` and a ``surrogate`` that no other entity of its kind has, that is no
    entity, and that does not contain the one it stands for.

    Each attempt settles the entities whose candidate is free; only the number left reaches the
    driver. The rounds end because candidates grow after ``WIDEN_AFTER`` attempts, those of names at once."""
    entities = materialise(found.select(*ENTITY).distinct(), "pii-entities")
    originals = entities.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("_real")).distinct()
    settled, left, attempt = None, entities, 0
    while True:
        drawn = left.withColumn("surrogate", _surrogate(key, attempt))
        first = Window.partitionBy("kind", "surrogate").orderBy("canonical", "gender")
        free = drawn.withColumn("_turn", F.row_number().over(first)).join(originals, ["kind", "surrogate"], "left")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate", F.lit(True).alias("_used")), ["kind", "surrogate"], "left")
        else:
            free = free.withColumn("_used", F.lit(None).cast("boolean"))
        # A digit or two of a number may come again anywhere; whole addresses, names and secrets may not.
        within = F.contains(F.lower("surrogate"), F.lower("canonical"))
        ok = (F.col("_turn") == 1) & F.col("_real").isNull() & F.col("_used").isNull() & ~within
        tried = materialise(free.select(*ENTITY, "surrogate", ok.alias("_ok")), "pii-drawn")
        done = tried.where("_ok").select(*ENTITY, "surrogate")
        settled = done if settled is None else settled.unionByName(done)
        left = tried.where("NOT _ok").select(*ENTITY)
        if left.isEmpty():
            return settled
        attempt += 1


def _poured(kind: Column, value: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one mention: its digits poured between the mention's separators, or the
    mention's capital letters."""
    # Chunks of digits of the mention, each with how many digits come before it.
    chunks = F.regexp_extract_all(value, F.lit(r"\d+|\D+"), F.lit(0))
    digits_before = F.transform(chunks, lambda c, i: F.length(F.regexp_replace(
        F.array_join(F.slice(chunks, F.lit(1), i), ""), r"\D", "")))
    digits = F.regexp_replace(surrogate, r"\D", "")
    poured = F.array_join(F.zip_with(chunks, digits_before, lambda c, n: F.when(
        c.rlike(r"^\d"), F.substring(digits, n + 1, F.length(c))).otherwise(c)), "")
    longer = F.substring(digits, F.length(F.regexp_replace(value, r"\D", "")) + 1, F.length(digits))
    capitals = F.array_join(F.zip_with(F.split(value, ""), F.split(surrogate, ""), lambda c, s: F.when(
        c != F.lower(c), F.upper(s)).otherwise(s)), "")
    return (F.when(kind.isin("card", "ssn", "phone"), F.concat(poured, longer))
            .when(kind.isin("email", "ip6") & (F.upper(value) == value), F.upper(surrogate))
            .when(kind.isin("email", "ip6") & (F.length(value) == F.length(surrogate)), capitals)
            .otherwise(surrogate))


_WORD_OR_REST = r"\p{L}+(?:['’]\p{Lu}\p{L}*)?(?:-\p{Lu}\p{L}*)?|[^\p{L}]+"


def replace_entities(docs: DataFrame, key: str, text: str = "text", n_chars: str | None = None,
                     report: bool = False) -> DataFrame:
    """``docs`` with every entity replaced; with ``report`` also ``n_entities`` (matches of a pattern) and their ``kinds``."""
    columns = docs.columns
    own = {c: f"_c{i}" for i, c in enumerate(columns)}  # input columns by names that nothing here uses
    rows = named_rows(docs, {name: F.col(f"`{c}`") for c, name in own.items()})
    body = F.col(own[text])
    ids = [ROW_FILE, ROW_INDEX]
    found = materialise(mentions(rows, own[text]), "pii-mentions")
    mapped = (found.join(surrogates(found, key), ENTITY)
              .withColumn("_new", F.concat("kept", _poured(F.col("kind"), F.col("value"), F.col("surrogate")))))
    bare = F.when(F.col("kind").isin("family", "given"), F.struct(
        (F.col("kind") == "given").alias("given"), "pos", F.col("canonical").alias("word"), "surrogate"))
    per_match = mapped.groupBy(*ids, "pos").agg(F.array_sort(F.collect_list(F.struct("part", "_new", "kind"))).alias("_p"),
                                                F.collect_list(bare).alias("_b"))
    per_doc = per_match.groupBy(*ids).agg(
        F.array_sort(F.collect_list(F.struct("pos", F.array_join("_p._new", "").alias("_new"), F.when(
            F.col("_p.kind")[0].isin("given", "family"), "name").otherwise(F.col("_p.kind")[0]).alias("kind")))).alias("_m"),
        F.array_sort(F.flatten(F.collect_list("_b"))).alias("_b"))
    # Family names come first, then given names by first mention: of equal words the first one counts.
    first_words = F.array_distinct(F.col("_b.word"))
    names = F.map_from_arrays(first_words, F.transform(first_words, lambda w: F.element_at(
        F.col("_b.surrogate"), F.array_position(F.col("_b.word"), w).cast("int"))))
    per_doc = per_doc.select(*ids, "_m", F.when(F.size("_b") > 0, names).alias("_names"))

    def plain(segment: Column) -> Column:
        """Text between matches, with the bare forms of the names found in the document replaced."""
        chunks = F.regexp_extract_all(segment, F.lit(_WORD_OR_REST), F.lit(0))
        swapped = F.transform(chunks, lambda w: F.coalesce(F.element_at(F.col("_names"), w), w))
        return F.when(F.col("_names").isNull(), segment).otherwise(F.array_join(swapped, ""))

    has = F.when(_worth_reading(body), body.rlike(ANY)).otherwise(F.lit(False))
    out = [F.col(name).alias(c) for c, name in own.items()]
    extra = [F.coalesce(F.size("_m"), F.lit(0)).alias("n_entities"), F.col("_m.kind").alias("kinds")] if report else []
    segments = F.split(body, ANY, -1)
    joined = F.array_join(F.zip_with(segments, F.col("_m._new"), lambda s, r: F.concat(plain(s), F.coalesce(r, F.lit("")))), "")
    touched = rows.where(has).join(per_doc, ids).withColumn(own[text], joined)
    if n_chars:
        touched = touched.withColumn(own[n_chars], F.char_length(own[text]).cast(docs.schema[n_chars].dataType))
    untouched = rows.where(~has).withColumn("_m", F.array().cast("array<struct<pos:int,_new:string,kind:string>>"))
    return untouched.select(*out, *extra).unionByName(touched.select(*out, *extra))
