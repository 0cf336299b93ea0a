"""Surrogates for personal data, in DataFrame functions alone.

Detected: e-mail addresses, IPv4 and IPv6 addresses, phone numbers, payment card
numbers (of 16 digits, or 15 that begin with 34 or 37, whose check digit is right; other
such numbers stay), social security numbers, IBANs, and names after a title.  Each gets a
replacement of its own kind, drawn by a keyed hash from its canonical form (so
one entity gets one replacement wherever and however it is written):

* digits for digits and letters for letters of the same script (those of
  ``_LETTERS``; Latin ones for others) in place, separators kept; a phone with a
  plus sign keeps its country code (one without is an entity of its own), a card its first digit and a valid check digit, an
  address its four numbers below 256, an IBAN its country, with check digits that are right;
* an IPv6 address, shortened or not, one of the range kept for documentation, all eight groups written (not found:
  those whose first group has no digit, that begin with a double colon or end in an IPv4 address);
* e-mail: a local part of the same make (eight characters at least) at a
  replacement of the domain under a reserved top level;
* a name keeps its title, number of words, hyphens, initial capitals and words
  all in capitals; a person is known by the name without the title, first names
  end after the gender of all titles the person has (neutral where they differ);
  Cyrillic, Greek and Armenian names get syllables of their script.

Collisions: the distinct entities of all documents are gathered, and of those
with equal replacements all but one, and those whose replacement is itself an
entity of the corpus, draw again until none is left.  Only entities that had to
draw again, and names under titles of several genders, are looked up when texts are rewritten: by a broadcast map up to
``MAP_ROWS`` of them, by a join per document beyond.

Defined results: a null text stays null, an empty one empty; other columns stay
as they are, whatever their names; rows that share an id each keep their own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import spare
from cadenza.session import checkpoint

KEY = "cadenza-surrogates"
MAP_ROWS = 20_000
ROUNDS = 40
#: titles by gender (fixed values)
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа")
NEUTRAL = ("Dr", "Prof")
#: begins where no character of the local part stands before, so a run of them is read once
_EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++"
#: an apostrophe joins what follows, but for a genitive's s
_JOINED = r"['\u2019](?![sS](?!\p{L}))[\p{L}\p{M}]++"
_WORD = rf"\p{{Lu}}(?:[\p{{L}}\p{{M}}]++(?:{_JOINED})*+|(?:{_JOINED})++)"
_NAME = r"(?:" + "|".join([*MALE, *FEMALE, *NEUTRAL]) + rf")\.?\x20{_WORD}(?:[\x20\-]{_WORD})*+"
#: country codes, none of which begins another
_CODE = r"1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
_GROUP = "[0-9A-Fa-f]{1,4}"
_PATTERNS = {
    "email": _EMAIL,
    "iban": r"[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    # eight groups, or fewer around a double colon, the first with a digit (which scopes of code, a::b, lack)
    "ip6": (rf"(?<!:)(?=[A-Fa-f]*\d)(?:(?:{_GROUP}:){{7}}{_GROUP}|{_GROUP}(?::{_GROUP}){{0,5}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)"
            r"(?![:\p{L}\p{N}])"),
    "card": (r"(?:\d{4}(?:[\x20\-]?\d{4}){2}[\x20\-]?\d{4}|3[47]\d{2}[\x20\-]?\d{6}[\x20\-]?\d{5})(?![0-9A-Za-z])"),
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d)",
    "phone": (r"(?:\+\d{1,3}[\x20.\-]?)?\(\d{2,4}\)[\x20.\-]?\d{3,4}[\x20.\-]?\d{3,4}(?!\d)"
              r"|\+\d{1,3}(?:[\x20.\-]?\d{2,4}){2,4}(?!\d)|\d{3}[.\-]\d{3}[.\-]\d{4}(?!\d)"),
    "name": _NAME,
}
#: every entity begins where no letter or digit stands before
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(_PATTERNS.values()) + ")"
_LATIN = "babebidadedokakekilalelomamemimonanenorareresasesotatetovavevizazo"
_CYRILLIC = "бабебидададокакекилалеломамеминаненорарересасесотатетовавевизазориси"
_GREEK = "βαβεβιγαγεδαδεδικακεκικολαλελιλομαμεμιναρεριροσασεσιτατετοφαφεχα"
_ARMENIAN = "բաբեգագեդադեզակակեկիլալելիմամեմինանենիպապեռասասեսիտատետովավեքա"
#: script: syllables and the first names' endings for f, m and n
_SYLLABLES = {"Cyrillic": (_CYRILLIC, "на", "рон", "ми"), "Greek": (_GREEK, "να", "ρον", "μι"),
              "Armenian": (_ARMENIAN, "նա", "րոն", "մի")}
_span = lambda a, n: "".join(map(chr, range(a, a + n)))
#: script: lower-case letters, or letters without case
_LETTERS = {"Cyrillic": _span(0x430, 32), "Greek": _span(0x3B1, 17) + _span(0x3C3, 7), "Armenian": _span(0x561, 38),
            "Hebrew": _span(0x5D0, 27), "Arabic": _span(0x628, 18), "Devanagari": _span(0x915, 20), "Bengali": _span(0x995, 20),
            "Thai": _span(0xE01, 40), "Georgian": _span(0x10D0, 33), "Hangul": _span(0xAC00, 200), "Hiragana": _span(0x304B, 23),
            "Katakana": _span(0x30AB, 23), "Han": _span(0x4E00, 200)}


def matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANY), F.lit(0))


def _kind(m: Column) -> Column:
    """The kind of a match; null for a card number with a wrong check digit, which is no entity."""
    out = F.lit("phone")
    for kind in ("name", "ssn", "card", "ip6", "ip", "iban", "email"):
        of = F.when(_valid_card(m), kind) if kind == "card" else F.lit(kind)
        out = F.when(m.rlike(f"^(?:{_PATTERNS[kind]})$"), of).otherwise(out)
    return out


def _valid_card(m: Column) -> Column:
    return _let(F.regexp_replace(m, "[^0-9]", ""), lambda digits: _luhn(digits) == digits)


def _groups(m: Column) -> Column:
    """An IPv6 address as its eight groups, lower case, without leading zeros."""
    def listed(side):
        return F.filter(F.split(side, ":"), lambda g: g != "")

    def whole(sides):
        return _let(F.struct(listed(F.get(sides, F.lit(0))).alias("a"), listed(F.coalesce(F.get(sides, F.lit(1)), F.lit(""))).alias("b")),
                    lambda x: F.concat(x["a"], F.array_repeat(F.lit("0"), F.lit(8) - F.size(x["a"]) - F.size(x["b"])), x["b"]))
    return F.array_join(F.transform(_let(F.split(F.lower(m), "::"), whole), lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def _iban(made: Column) -> Column:
    """``made`` with the two check digits that its country and account need."""
    def add(acc, c):
        value = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (acc * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value) % 97
    account, country = F.substr(made, F.lit(5), F.length(made)), F.substring(made, 1, 2)
    rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), add)
    return F.concat(country, F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), account)


def _canon(m: Column, kind: Column) -> Column:
    """One form for the ways in which an entity is written."""
    bare = F.regexp_replace(m, r"[^\p{L}\p{N}]", "")
    person = F.lower(F.translate(F.regexp_replace(m, r"^\S+\x20", ""), "-\u2019", " '"))
    code = F.when(m.startswith("+"), F.regexp_extract(bare, f"^({_CODE})", 1)).otherwise("")
    gender = (F.when(m.rlike("^(?:" + "|".join(FEMALE) + r")\.?\x20"), "f")
              .when(m.rlike("^(?:" + "|".join(MALE) + r")\.?\x20"), "m").otherwise("n"))
    return (F.when(kind == "email", F.lower(m)).when(kind == "ip", m).when(kind == "ip6", _groups(m))
            .when(kind == "name", F.concat(gender, F.lit(":"), person))
            .when(kind == "phone", F.concat_ws(":", code, F.substr(bare, F.length(code) + 1, F.length(bare)))).otherwise(bare))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _draw(key: str, kind: Column, seed: Column, attempt: Column) -> Column:
    """192 keyed hexadecimal digits."""
    def three(base):
        return F.concat(*[F.sha2(F.concat(base, F.lit(f"\u0001{i}")).cast("binary"), 256) for i in range(3)])
    return _let(F.concat_ws("\u0001", F.lit(key), kind, seed, attempt.cast("string")), three)


def _byte(draw: Column, i: Column) -> Column:
    return F.conv(F.substr(draw, (i * 2) % 190 + 1, F.lit(2)), 16, 10).cast("int")


def _like(text: Column, draw: Column) -> Column:
    """``text`` with each digit and letter replaced by one of its own sort."""
    def letter(c, b):
        out = F.when(c.rlike("^[A-Z]$"), F.char(b % 26 + 65)).when(c.rlike("^[a-z]$"), F.char(b % 26 + 97))
        for script, letters in _LETTERS.items():
            drawn = F.substr(F.lit(letters), b % len(letters) + 1, F.lit(1))
            out = out.when(c.rlike(rf"^\p{{Is{script}}}$"), F.when(c.rlike(r"^\p{Lu}$"), F.upper(drawn)).otherwise(drawn))
        return out.when(c.rlike(r"^\p{Lu}$"), F.char(b % 26 + 65)).otherwise(F.char(b % 26 + 97))

    def one(c, i):
        return _let(_byte(draw, i), lambda b: (
            F.when(c.rlike(r"^\d$"), (b % 10).cast("string")).when(c.rlike(r"^\p{L}$"), letter(c, b)).otherwise(c)))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """``digits`` with their last one set to the check digit."""
    def add(acc, i):
        return _let(F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int"), lambda d: acc + F.when(
            i % 2 == 1, F.when(d >= 5, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits) - 1), F.lit(0), add)
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), ((F.lit(10) - total % 10) % 10).cast("string"))


def _syllables(draw: Column, at: Column, n: int, names: str) -> Column:
    size = len(names) // 2
    return F.array_join(F.transform(F.sequence(at, at + n - 1), lambda i: F.substr(
        F.lit(names), _byte(draw, i) % size * 2 + 1, F.lit(2))), "")


def _email(canon: Column, draw: Column, key: str) -> Column:
    local = F.rpad(F.regexp_extract(canon, "^([^@]*)@", 1), F.greatest(F.lit(8), F.length(F.regexp_extract(canon, "^([^@]*)@", 1))), F.lit("a"))
    domain = _draw(key, F.lit("domain"), F.regexp_extract(canon, "@(.*)$", 1), F.lit(0))
    return F.concat(_like(local, draw), F.lit("@d"), F.substring(domain, 1, 10), F.lit(".example"))


def _person(canon: Column, draw: Column) -> Column:
    """First names end after the gender; a sole word after a title is a family name."""
    n = F.size(F.split(F.substr(canon, F.lit(3)), " "))

    def of(names: str, female: str, male: str, neutral: str) -> Column:
        end = F.when(canon.startswith("f:"), female).when(canon.startswith("m:"), male).otherwise(neutral)
        family = _syllables(draw, F.lit(8), 5, names)
        more = F.when(n > 2, F.transform(F.sequence(F.lit(3), n), lambda j: _syllables(draw, j * 4 + 4, 4, names))
                      ).otherwise(F.array().cast("array<string>"))
        return F.when(n == 1, family).otherwise(F.array_join(
            F.concat(F.array(F.concat(_syllables(draw, F.lit(0), 3, names), end), family), more), " "))

    made = of(_LATIN, "na", "ron", "mi")
    for script, how in _SYLLABLES.items():
        made = F.when(canon.rlike(rf"\p{{Is{script}}}"), of(*how)).otherwise(made)
    return F.concat(F.substring(canon, 1, 2), made)


def core(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The replacement in canonical form: what collision checks compare."""
    def made(draw):
        ip6 = F.concat(F.lit("2001:db8:"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.lower(
            F.hex((_byte(draw, i * 2) * 256 + _byte(draw, i * 2 + 1)).cast("long")))), ":"))
        ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_byte(draw, i) % 254 + 1).cast("string")), ".")
        def digits(d):
            return (F.when(kind == "card", _luhn(F.concat(F.substring(canon, 1, 1), F.substring(d, 2, 99))))
                    .when(kind == "iban", _iban(F.concat(F.substring(canon, 1, 2), F.substring(d, 3, 99))))
                    .when(kind == "phone", F.concat(F.regexp_extract(canon, "^[^:]*:", 0), F.regexp_extract(d, ":(.*)$", 1)))
                    .otherwise(d))
        return (F.when(kind == "email", _email(canon, draw, key)).when(kind == "ip", ip).when(kind == "ip6", ip6)
                .when(kind == "name", _person(canon, draw)).otherwise(_let(_like(canon, draw), digits)))
    return _let(_draw(key, kind, canon, attempt), made)


def _render(m: Column, kind: Column, made: Column) -> Column:
    """The canonical replacement in the written form of ``m``."""
    def masked(bare):
        def place(c, i):
            upto = F.length(F.regexp_replace(F.substr(m, F.lit(1), i + 1), r"[^\p{L}\p{N}]", ""))
            return F.when(c.rlike(r"^[\p{L}\p{N}]$"), F.substr(bare, upto, F.lit(1))).otherwise(c)
        return F.array_join(F.transform(F.split(m, ""), place), "")

    def person(bare):
        written, seps = F.split(bare, r"[\x20\-]"), F.concat(F.regexp_extract_all(bare, F.lit(r"[\x20\-]"), F.lit(0)), F.array(F.lit("")))

        def word(w, i):
            own = F.get(written, i)
            return F.concat(F.when(own == F.upper(own), F.upper(w)).otherwise(F.initcap(w)), F.get(seps, i))
        return F.array_join(F.transform(F.split(F.substr(made, F.lit(3)), " "), word), "")
    person = _let(F.regexp_replace(m, r"^\S+\x20", ""), person)
    return (F.when(kind.isin("email", "ip", "ip6"), made).when(kind == "name", F.concat(F.regexp_extract(m, r"^(\S+\x20)", 1), person))
            .otherwise(_let(F.replace(made, F.lit(":"), F.lit("")), masked)))


def _entities(found: Column) -> Column:
    def one(m):
        return _let(_kind(m), lambda kind: F.struct(kind.alias("kind"), _canon(m, kind).alias("canon")))
    return F.filter(F.transform(found, one), lambda e: e["kind"].isNotNull())


def _settled(written: DataFrame) -> DataFrame:
    """``(kind, canon, settled)``: of a name, ``settled`` has the gender of all its titles."""
    person = F.when(F.col("kind") == "name", F.expr("substring(canon, 3)"))
    gender = F.substring("canon", 1, 1)
    one = (written.where("kind = 'name'").groupBy(person.alias("person"))
           .agg(F.max((gender == "f").cast("int")).alias("f"), F.max((gender == "m").cast("int")).alias("m")))
    told = F.when(F.col("f") > F.col("m"), "f:").when(F.col("m") > F.col("f"), "m:").otherwise("n:")
    return (written.join(one, person == F.col("person"), "left")
            .select("kind", "canon", F.when(F.col("kind") == "name", F.concat(told, "person")).otherwise(F.col("canon")).alias("settled")))


def _bare(kind: Column, canon: Column) -> Column:
    """What is compared: a name without the gender."""
    return F.when(kind == "name", F.substr(canon, F.lit(3))).otherwise(canon)


def redraws(docs: DataFrame, text_col: str = "text", key: str = KEY) -> DataFrame:
    """``(kind, canon, attempt, settled)`` of the entities whose first
    replacement collides or whose settled form is not that of the title."""
    found = docs.select(F.explode(_entities(matches(F.col(text_col)))).alias("e"))
    found = checkpoint(found.select("e.kind", "e.canon").distinct(), "pii-entities")  # the texts are read once
    written = checkpoint(_settled(found), "pii-settled")
    every = written.select("kind", F.col("settled").alias("canon")).distinct()
    draw = lambda: core(F.col("kind"), F.col("canon"), F.col("attempt"), key)
    now = checkpoint(every.withColumn("attempt", F.lit(0)).withColumn("made", draw()), "pii-drawn")
    real = every.select(F.col("kind").alias("rk"), _bare(F.col("kind"), F.col("canon")).alias("rc"))
    for _ in range(ROUNDS):
        holder = (now.groupBy("kind", _bare(F.col("kind"), F.col("made")).alias("hm")).agg(F.min(F.struct("attempt", "canon")).alias("h"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select(F.col("kind").alias("hk"), "hm", F.col("h.canon").alias("hc")))
        loses = (now.join(holder, (F.col("kind") == F.col("hk")) & (_bare(F.col("kind"), F.col("made")) == F.col("hm")), "left")
                 .join(real, (F.col("kind") == F.col("rk")) & (_bare(F.col("kind"), F.col("made")) == F.col("rc")), "left")
                 .select("kind", "canon", "attempt", "made",
                         ((F.col("hc").isNotNull() & (F.col("hc") != F.col("canon"))) | F.col("rc").isNotNull()).alias("again")))
        loses = checkpoint(loses, "pii-check")
        if loses.where("again").isEmpty():
            drawn = now.where("attempt > 0").select("kind", F.col("canon").alias("settled"), "attempt")
            return (written.join(drawn, ["kind", "settled"], "left").where("attempt IS NOT NULL OR canon != settled")
                    .select("kind", "canon", F.coalesce("attempt", F.lit(0)).alias("attempt"), "settled"))
        attempt = F.col("attempt") + F.col("again").cast("int")
        now = checkpoint(loses.select("kind", "canon", attempt.alias("attempt"), "again", "made")
                         .withColumn("made", F.when(F.col("again"), draw())
                                     .otherwise(F.col("made"))).drop("again"), "pii-drawn")
    raise ValueError(f"replacements still collide after {ROUNDS} rounds")


def _rewrite(text: Column, found: Column, attempts: Column | None, key: str) -> Column:
    def one(m):
        def known(kind):
            def named(canon):
                if attempts is None:
                    return _let(core(kind, canon, F.lit(0), key), lambda made: _render(m, kind, made))
                own = F.coalesce(F.element_at(attempts, F.concat_ws("\u0001", kind, canon)),
                                 F.struct(F.lit(0).alias("attempt"), canon.alias("settled")))
                return _let(own, lambda e: _let(core(kind, e["settled"], e["attempt"], key), lambda made: _render(m, kind, made)))
            return F.when(kind.isNull(), m).otherwise(_let(_canon(m, kind), named))
        return _let(_kind(m), known)
    pieces = F.split(text, ANY, -1)
    made = F.concat(F.transform(found, one), F.array(F.lit("")))
    return F.when(F.size(found) > 0, F.array_join(F.zip_with(pieces, made, lambda p, s: F.concat(p, s)), "")).otherwise(text)


def pseudonymize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY,
                 map_rows: int = MAP_ROWS, count_col: str | None = None) -> DataFrame:
    """``docs`` with every detected entity of ``text_col`` replaced;
    ``count_col`` names a column to add for their number."""
    again = redraws(docs, text_col, key)
    size = again.limit(map_rows + 1).count()
    name = F.concat_ws("\u0001", "kind", "canon")
    text, attempts, at = F.col(f"`{text_col}`"), None, spare(docs, "found")
    found = docs.withColumn(at, matches(text))
    if size > map_rows:
        i, h, m = spare(docs, "of_id"), spare(docs, "of_text"), spare(docs, "redrawn")
        digest = F.md5(text.cast("binary"))  # rows that share an id, or have none, meet only where they share the text too
        told = (found.select(F.col(f"`{id_col}`").alias(i), digest.alias(h), F.explode(_entities(F.col(at))).alias("e"))
                .select(i, h, "e.kind", "e.canon").distinct().join(again, ["kind", "canon"])
                .groupBy(i, h).agg(F.map_from_entries(F.collect_list(F.struct(name, F.struct("attempt", "settled")))).alias(m)))
        same = F.col(f"`{id_col}`").eqNullSafe(F.col(i)) & (digest == F.col(h))
        found, attempts = found.join(told, same, "left"), F.col(m)
    elif size:
        m = spare(docs, "redrawn")
        table = again.agg(F.map_from_entries(F.collect_list(F.struct(name, F.struct("attempt", "settled")))).alias(m))
        found, attempts = found.crossJoin(F.broadcast(table)), F.col(m)  # one row
    made = _rewrite(text, F.col(at), attempts, key).alias(text_col)
    n = F.size(F.filter(F.col(at), lambda m: _kind(m).isNotNull()))
    extra = [F.coalesce(n, F.lit(0)).alias(count_col)] if count_col else []
    return found.select(*[made if c == text_col else F.col(f"`{c}`") for c in docs.columns], *extra)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY, **options) -> DataFrame:
    """``id_col, text, n_entities``: the rewritten texts and what was found in each."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return pseudonymize(own, "id", "text", key, count_col="n_entities", **options).withColumnRenamed("id", id_col)
