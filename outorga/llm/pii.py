"""Surrogates for personal data and secrets.

Entities are found by patterns and brought to a canonical form (digits of a number, lower case of an
address). A surrogate is a keyed function (HMAC with SHA-512) of type and canonical form, so every mention of an
entity, in whatever document and spelling, gets the same one; it has the type, format, script and, for names after a
title, the gender of what it replaces. The parts of a name are entities of their own: whoever shares a surname keeps
sharing it. Surrogates of different entities must differ, and none may be an entity that the corpus holds: whoever
collides draws again, the smallest of them excepted, until none does; every fourth draw of a name adds a syllable, so
names don't run out. Draws after the first are kept in a table of exceptions; texts without such entities are
never moved.

The key is the session's setting ``spark.outorga.surrogate.key``. Where it is not set, the session draws a random one
and keeps it: nobody can compute its surrogates again, and another session's differ.

Defined results: null and texts without entities stay as they are; repeated documents get equal texts; of entities that
tie for a surrogate the one of the earliest draw, then the smallest, keeps it; an empty table gives an empty result. A
very long text is one row of one task. Extra columns pass through; n_chars, where there is one, is counted anew.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outorga.llm.common import once, packed, stored

KEY_SETTING = "spark.outorga.surrogate.key"
ROUNDS = 30
SYLLABLES = 3
MORE_FROM = 4  # draws after which a name grows by a syllable


def session_key(spark: SparkSession) -> str:
    """The key of the session: as set, or drawn once."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


_HE = "Mr|Herr|Monsieur|Señor|Sr|Sir|Don"
_SHE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Lady|Doña"
_NAME = r"\p{Lu}[\p{L}'’-]++"
_IP = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w]|\.\d)"
_SOCIAL = r"\d{3}-\d{2}-\d{4}(?![\w-])"
_CARD = r"\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\w)"
_LOCAL = r"\d{3}[-.]\d{3}[-.]\d{4}(?![\w-])"
#: Where a phone ends although digits follow: before another number or address, and after 15 digits.
_D = r"\d[ .()-]{0,3}"
_NEXT = rf"[ .-]{_CARD}|(?<={_D * 6}\d)[ -](?:{_IP}|{_SOCIAL}|{_LOCAL})"
_LONG = rf"(?<!{_D * 15}\d)"
#: Country calling codes; none is the start of another.
_CODE = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
#: Type and pattern of entities. The first that matches at a place counts.
PATTERNS = {
    "email": r"(?<![\w.+%-])[\w.+%-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![\w.]){_IP}",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "key": r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)|(?<!\w)(?:ghp_|gho_|sk-|sk_live_|xox[bp]-)[A-Za-z0-9_-]{16,}+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])",
    "phone": rf"(?<![\w+])\+1[ .-]?(?:\(\d{{3}}\)|\d{{3}})[ .-]?\d{{3}}[ .-]?\d{{4}}(?!\w)|"
             rf"(?<![\w+])\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:(?!{_NEXT})[ .-]?\d{{2,4}}){{1,4}}(?!\w){_LONG}|"
             rf"(?<!\w)\(\d{{3}}\) ?\d{{3}}-\d{{4}}(?!\w)|(?<![\w-]){_LOCAL}",
    "number": rf"(?<![\w-]){_SOCIAL}",
    "card": rf"(?<!\w){_CARD}",
    "he": rf"(?<=(?<!\w)(?:{_HE})\.? ){_NAME}(?: {_NAME})?",
    "she": rf"(?<=(?<!\w)(?:{_SHE})\.? ){_NAME}(?: {_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity has: a digit, an at sign or a title; texts without it are not searched.
HINT = rf"[0-9@]|(?=[{''.join(sorted({t[0] for t in f'{_HE}|{_SHE}'.split('|')}))}])(?:{_HE}|{_SHE})\.? \p{{Lu}}"
DIGITS = ("phone", "number", "card", "ip")


def _kind(mention: Column, before: Column) -> Column:
    """Type of a mention. A name's gender is that of the title before it."""
    kind = F.when(before.rlike(rf"(?<!\w)(?:{_SHE})\.? $"), "she").otherwise("he")
    for name, pattern in reversed(PATTERNS.items()):
        if name not in ("he", "she"):
            kind = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def _canonical(kind: Column, mention: Column) -> Column:
    """The form that all spellings of an entity share."""
    digits = F.regexp_replace(mention, r"\D", "")
    # a phone without country code and the zero that is only dialled at home; short ones as a whole
    dialled = F.regexp_replace(F.regexp_replace(mention, r"\(0\)", ""), r"\D", "")
    national = F.when(mention.startswith("+") & (F.length(dialled) >= 8), F.regexp_replace(dialled, rf"^(?:{_CODE})", "")).otherwise(digits)
    return (
        F.when(kind == "ip", mention).when(kind == "phone", national)
        .when(kind.isin("number", "card"), digits)
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind.isin("email", "secret"), F.lower(mention)).otherwise(mention))


def mentions(text: Column) -> Column:
    """Array of (kind, canon, mention) in order of the text, and the pieces between them (one more)."""
    found = F.regexp_extract_all(text, F.lit(ANY), 0)
    pieces = F.split(text, ANY)
    named = F.transform(found, lambda m, i: F.struct(m.alias("mention"), _kind(m, F.right(F.get(pieces, i), F.lit(14))).alias("kind")))
    return F.struct(F.transform(named, lambda s: F.struct(
        s["kind"].alias("kind"), _canonical(s["kind"], s["mention"]).alias("canon"), s["mention"].alias("mention"))).alias("found"), pieces.alias("pieces"))


def _random(key: str, *message: Column) -> Column:
    """128 hexadecimal characters: HMAC of the message under the key."""
    given = key.encode()
    given = (hashlib.sha512(given).digest() if len(given) > 128 else given).ljust(128, b"\0")
    inner, outer = (F.lit(bytes(b ^ mask for b in given)) for mask in (0x36, 0x5C))
    said = F.encode(F.concat_ws("\x1f", *message), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, said), 512))), 512)


def _at(bits: Column, i: Column, of: int) -> Column:
    """The i-th number below ``of`` out of the random characters."""
    place = F.pmod(i * 3, F.lit(124)) + 1
    return F.pmod(F.conv(F.substring(bits, place, F.lit(4)), 16, 10).cast("int") + i, F.lit(of))


_SETS = {"0": "0123456789", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_HEX = "0123456789abcdef"
#: Consonants, vowels and endings (he, she) by script.
_SCRIPTS = {
    "latin": ("bdfgklmnprstv", "aeiou", ("n", "s"), ("a", "e")),
    "cyrillic": ("бвгдклмнпрст", "аеиоу", ("н", "р"), ("а", "я")),
    "greek": ("βγδκλμνπρστ", "αεηιου", ("ς", "ν"), ("α", "η")),
}


def _spelled(canon: Column, bits: Column, letters: str) -> Column:
    """Each letter and digit replaced by one of its class; what is not in ``letters`` classes stays."""
    pick = lambda chars, i: F.substring(F.lit(chars), _at(bits, i, len(chars)) + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        out = c
        for key in letters:
            chars = _HEX if key == "h" else _SETS[key]
            out = F.when(c.between(F.lit(chars[0]), F.lit(chars[-1])) & F.lit(chars).contains(c), pick(chars, i)).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(canon, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn test, over the digits from the right."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: (c.cast("int") * (1 + i % 2)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v - F.when(v > 9, 9).otherwise(0))


def parts(kind: Column, canon: Column) -> Column:
    """The entities of a mention (kind, canon): itself, or the parts of a name. The first of two parts is a kind apart,
    which shows the gender."""
    words = F.split(canon, " ")
    named = F.transform(words, lambda w, i: F.struct(
        F.concat(kind, F.when((i == 0) & (F.size(words) > 1), "-first").otherwise("-last")).alias("kind"), w.alias("canon")))
    return F.when(kind.isin("he", "she"), named).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))


def _name_part(kind: Column, part: Column, bits: Column, draw: Column) -> Column:
    """A part of a name in the same script, with the ending of its gender if it is a first name."""
    she, first = kind.startswith("she"), kind.endswith("first")

    def spelled(script: str) -> Column:
        consonants, vowels, he, ends = _SCRIPTS[script]
        take = lambda s, i: F.substring(F.lit(s), _at(bits, i, len(s)) + 1, F.lit(1))
        count = F.lit(SYLLABLES) + F.floor(draw / MORE_FROM).cast("int")
        body = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(take(consonants, 2 * i), take(vowels, 2 * i + 1))), "")
        last = F.lit(0)
        ending = F.when(first & she, F.concat(take(consonants, last), take("".join(ends), last + 1))).when(
            first, take("".join(he), last)).otherwise(take(consonants, last))
        return F.initcap(F.concat(body, ending))

    return (F.when(part.rlike(r"\p{IsCyrillic}"), spelled("cyrillic")).when(part.rlike(r"\p{IsGreek}"), spelled("greek"))
            .otherwise(spelled("latin")))


def surrogate(key: str, kind: Column, canon: Column, draw: Column) -> Column:
    """Canonical surrogate of a canonical entity; of a name those of its parts, all of one draw."""
    whole = kind.isin("he", "she")
    each = F.transform(parts(kind, canon), lambda p: _surrogate(key, p["kind"], p["canon"], draw))
    return F.when(whole, F.array_join(each, " ")).otherwise(_surrogate(key, kind, canon, draw))


def _surrogate(key: str, kind: Column, canon: Column, draw: Column) -> Column:
    bits = _random(key, kind, canon, draw.cast("string"))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (1 + _at(bits, i, 223)).cast("string")), ".")
    digits = _spelled(canon, bits, "0")
    first = F.concat(F.left(canon, F.lit(1)), F.substring(digits, F.lit(2), F.length(canon)))
    body = F.left(first, F.length(first) - 1)
    check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    card = F.when(F.pmod(_luhn(canon), F.lit(10)) == 0, F.concat(body, check)).otherwise(first)
    phone = F.concat((2 + _at(bits, F.lit(40), 8)).cast("string"), F.substring(digits, F.lit(2), F.length(canon)))
    email = F.concat(_spelled(F.substring_index(canon, "@", 1), bits, "a0"), F.lit("@"),
                     _spelled(F.regexp_replace(F.substring_index(canon, "@", -1), r"\.[^.]+$", ""), F.reverse(bits), "a0"),
                     F.regexp_extract(canon, r"\.[^.]+$", 0))
    prefix = F.regexp_extract(canon, r"^(?:AKIA|ASIA|ghp_|gho_|sk-|sk_live_|xox[bp]-|[A-Z]{2}(?=\d{2}))?", 0)
    rest = F.substring(canon, F.length(prefix) + 1, F.length(canon))
    return (
        F.when(kind == "ip", octets).when(kind == "card", card).when(kind == "phone", phone).when(kind == "number", digits)
        .when(kind == "email", email).when(kind.isin("key", "iban"), F.concat(prefix, _spelled(rest, bits, "aA0")))
        .when(kind == "secret", _spelled(canon, bits, "h"))
        .otherwise(_name_part(kind, canon, bits, draw)))


def rendered(kind: Column, mention: Column, instead: Column) -> Column:
    """A canonical surrogate in the spelling of the mention: its separators, country code and case."""
    digits = F.regexp_replace(mention, r"\D", "")
    ahead = F.length(digits) - F.length(instead)  # of a phone number: the country code and a zero in brackets

    def one(c: Column, i: Column) -> Column:
        k = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), r"\D", "")) - ahead
        return F.when(c.rlike(r"\d") & (k >= 0), F.substring(instead, k + 1, F.lit(1))).otherwise(c)

    filled = F.array_join(F.transform(F.split(mention, ""), one), "")
    spaced = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substring(
        instead, i + 1 - (F.length(F.substring(mention, F.lit(1), i)) - F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), " ", ""))), F.lit(1)))), "")
    upper = (F.upper(mention) == mention) & (F.lower(mention) != mention)
    return (F.when(kind.isin("phone", "number", "card"), filled).when(kind == "iban", spaced)
            .when(kind.isin("email", "secret") & upper, F.upper(instead)).otherwise(instead))


def exceptions(entities: DataFrame, draws: Callable[[Column, Column, Column], Column], rounds: int = ROUNDS) -> DataFrame:
    """Entities (kind, canon) that must not take their first draw: (kind, canon, draw).

    In each round those draw again whose surrogate is a real entity or also that of another entity which is
    smaller or has settled. Raises if ``rounds`` don't do (a type with more entities than forms).
    """
    real = entities.select("kind", F.col("canon").alias("instead")).distinct()
    drawn = stored(entities.select("kind", "canon", F.lit(0).alias("draw")).distinct().withColumn(
        "instead", draws(F.col("kind"), F.col("canon"), F.col("draw"))))
    moved = drawn.filter("false")
    first = W.partitionBy("kind", "instead").orderBy("draw", "canon")
    for _ in range(rounds):
        taken = drawn.groupBy("kind", "instead").count().filter(F.col("count") > 1).drop("count")
        suspects = drawn.join(taken.union(real.join(drawn.select("kind", "instead").distinct(), ["kind", "instead"], "left_semi")).distinct(), ["kind", "instead"], "left_semi")
        is_real = real.withColumn("real", F.lit(True))
        losers = stored(suspects.withColumn("place", F.row_number().over(first)).join(is_real, ["kind", "instead"], "left").filter(
            F.col("real").isNotNull() | (F.col("place") > 1)).select("kind", "canon", (F.col("draw") + 1).alias("draw")))
        if losers.isEmpty():
            return moved.select("kind", "canon", "draw")
        again = losers.withColumn("instead", draws(F.col("kind"), F.col("canon"), F.col("draw"))).select(drawn.columns)
        drawn = stored(drawn.join(losers.select("kind", "canon"), ["kind", "canon"], "left_anti").select(again.columns).union(again))
        moved = drawn.filter(F.col("draw") > 0)
    raise ValueError(f"surrogates still collide after {rounds} draws")


def _found(documents: DataFrame) -> DataFrame:
    """The documents as ``_row`` with ``_m``, their mentions (null for texts without a hint of one)."""
    text = F.col("_text")
    return once(packed(documents, F.col("text").alias("_text")), "_m", F.when(text.rlike(HINT), mentions(text)))


def _mentioned(rows: DataFrame, *columns: Column) -> DataFrame:
    """(columns, kind, canon) of every entity mentioned."""
    found = rows.select(*columns, F.explode("_m.found").alias("f"))
    return found.select(*[c for c in found.columns if c != "f"], F.inline(parts(F.col("f.kind"), F.col("f.canon"))))


def replaced(documents: DataFrame, key: str | None = None) -> DataFrame:
    """The documents as ``_row`` with new text in ``text``, and their ``found`` mentions."""
    key = session_key(documents.sparkSession) if key is None else key
    draws = lambda kind, canon, draw: _surrogate(key, kind, canon, draw)
    rows = _found(documents)
    listed = _mentioned(rows).distinct()
    moved = stored(exceptions(stored(listed), draws))
    some = not moved.isEmpty()
    if some:  # the draws of those documents that name such an entity, under the digest of the text
        named = _mentioned(rows, F.md5("_text").alias("_d"))
        named = named.join(moved, ["kind", "canon"]).groupBy("_d").agg(F.collect_set(F.struct("kind", "canon", "draw")).alias("_draws"))
        rows = rows.withColumn("_key", F.md5("_text")).join(stored(named), F.col("_key") == F.col("_d"), "left").drop("_key", "_d")

    def draw_of(f: Column) -> Column:
        if not some:
            return F.lit(0)
        return F.coalesce(F.get(F.filter("_draws", lambda d: (d["kind"] == f["kind"]) & (d["canon"] == f["canon"])), F.lit(0))["draw"], F.lit(0))

    def instead(f: Column) -> Column:
        return F.array_join(F.transform(parts(f["kind"], f["canon"]), lambda p: draws(p["kind"], p["canon"], draw_of(p))), " ")

    new = once(rows, "_new", F.transform("_m.found", lambda f: F.struct(f["kind"].alias("kind"), f["mention"].alias("mention"), instead(f).alias("instead"))))
    new = once(new, "_said", F.transform("_new", lambda f: rendered(f["kind"], f["mention"], f["instead"])))
    joined = F.array_join(F.flatten(F.zip_with("_m.pieces", "_said", lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), "")
    n = F.coalesce(F.size("_m.found"), F.lit(0))
    return new.select("_row", F.when(n > 0, joined).otherwise(F.col("_text")).alias("text"), F.coalesce("_m.found", F.array().cast("array<struct<kind:string,canon:string,mention:string>>")).alias("found"))


def pseudonymised(documents: DataFrame, key: str | None = None) -> DataFrame:
    """The documents, with their own columns, after replacement."""
    rows = replaced(documents, key)
    row = F.col("_row").withField("text", F.col("text"))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.size("found") > 0, F.length("text").cast(kind)).otherwise(F.col("_row.n_chars")))
    return rows.select(row.alias("_row")).select("_row.*")
