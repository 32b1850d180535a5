"""Keyed surrogates for personal data. DataFrame functions only.

*Detection.* Mail and IPv4 addresses, phone, card (by check digit) and social
security numbers, access keys, ``password=`` and ``token =`` values (the keyword in
any case), and names after a title.

*Surrogates.* The distinct entities of the whole corpus get one surrogate each, a
keyed hash of type and canonical form driving every character, so an entity reads
the same wherever it stands (coreference), also in other case or with other
separators. Formats stay: digits stay digits, letters letters, separators and
lengths as they are; octets stay octets; cards keep their first digit and a valid
check digit; phones keep their country's first digit; mail addresses keep their
last domain label; key prefixes stay. Names stay in their script, and given names
in the gender of their title; a surname is the same whatever title precedes it.

*Collision checks.* A surrogate must not equal any real entity of its type, nor
another's surrogate: of entities that draw the same one, the first (by canonical
form) keeps it, and the others and those that hit a real entity draw again with
the next attempt, until none is left. So distinct entities stay distinct. Should
``ATTEMPTS`` draws not do, a format has too few values and the operator raises.

*Rewriting.* Texts are cut at their matches, and matches and surrogates joined
by the document; only documents with a match are shuffled. An entity in a third
of all documents is one row of the entity table and is met under adaptive skew
splitting.

Null and empty texts stay as they are. Repeated rows give repeated rows. Changing
the key changes every surrogate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.scratch import stored, unused

ATTEMPTS = 12
KEY = "change-me"

# Titles by gender.
MALE = ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"]

# Syllables of made-up names by script: consonants, vowels, endings of
# male and female given names and of surnames.
SCRIPTS = {
    "Cyrillic": ("бвгдклмнпрст", "аеиоу", "н", "на", "ов"),
    "Greek": ("βγδκλμνπρτ", "αεηιο", "ος", "α", "ης"),
    "Latin": ("bdfgklmnprstv", "aeiou", "n", "na", "er"),
}

_TITLE = rf"(?:{'|'.join(MALE + FEMALE)})\.?"
_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
# Every pattern begins where no longer token does, so a scan reads each word once.
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api_key)\s?[=:]\s?\"?[A-Za-z0-9_/+-]{8,}",
    "access": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    "social": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[3-6][0-9](?:[ -]?[0-9]){11,17}(?![0-9])",
    "name": rf"(?<![\p{{L}}]){_TITLE}\s{_NAME}(?:\s{_NAME})?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: No entity is without one of these; a title that another begins stands for it.
SIGNS = [*"0123456789@=:", "AKIA", *(t for t in MALE + FEMALE if not any(t != o and t.startswith(o) for o in MALE + FEMALE))]


def _holds(text: Column) -> Column:
    """Whether a text holds an entity. A search for plain signs comes first and spares
    most texts without one the patterns."""
    some = F.lit(False)
    for sign in SIGNS:
        some = some | F.contains(text, F.lit(sign))
    return some & text.rlike(ANY)


def _kind(match: Column) -> Column:
    out = F.lit("name")
    for kind, pattern in reversed(list(PATTERNS.items())):
        if kind != "name":
            out = F.when(match.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _digits(text: Column) -> Column:
    """The characters of a digit string as numbers."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: c.cast("int"))


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second from the last but one doubled."""
    n = F.size(digits)
    doubled = F.transform(
        digits,
        lambda d, i: F.when((n - 1 - i) % 2 == 0, d).otherwise(F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def detect(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per part of a match: ``key, h1, h2`` (text hashes), ``no`` (of the
    match in its text), ``part``, ``kind``, ``canon``, ``raw``, ``before`` (what the
    surrogate keeps of the match in front of it)."""
    rows = docs.select(F.col(key).alias("key"), *_hashes(F.col(text)), F.col(text).alias("text"))
    found = rows.where(_holds(F.col("text"))).select(
        "key", "h1", "h2", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("no", "match")
    ).distinct()
    m = F.col("match")
    kept = F.regexp_extract(m, r"^(?:[A-Za-z_]+\s?[=:]\s?\"?|AKIA)", 0)
    title = F.regexp_extract(m, rf"^{_TITLE}\s", 0)
    male = F.regexp_replace(F.regexp_extract(m, rf"^({_TITLE})\s", 1), r"\.$", "").isin(MALE)
    found = found.withColumn("kind", _kind(m)).withColumn(
        "before", F.when(F.col("kind") == "name", title).when(F.col("kind").isin("secret", "access"), kept).otherwise("")
    )
    rest = F.substring(m, F.length("before") + 1, F.length(m))
    words = F.split(rest, r"\s")
    found = found.withColumn("male", male).withColumn(
        "parts", F.when(F.col("kind") == "name", words).otherwise(F.array(rest))
    ).withColumn("n", F.size("parts"))
    out = found.select("key", "h1", "h2", "no", "kind", "before", "male", "n", F.posexplode("parts").alias("part", "raw"))
    kind = F.when(F.col("kind") != "name", F.col("kind")).when(
        F.col("part") == F.col("n") - 1, "surname"
    ).otherwise(F.when(F.col("male"), "given_m").otherwise("given_f"))
    bare = F.regexp_replace("raw", "[^0-9]", "")
    canon = F.when(F.col("kind").isin("phone", "social", "card"), bare).when(
        F.col("kind") == "access", F.col("raw")
    ).otherwise(F.lower("raw"))
    out = out.select("key", "h1", "h2", "no", "part", kind.alias("kind"), canon.alias("canon"), "raw", "before")
    # a run of digits is a card only with a valid check digit
    return out.where((F.col("kind") != "card") | (luhn_sum(_digits(F.col("canon"))) % 10 == 0))


def _hashes(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("h1"), F.hash(text).alias("h2")


def _stream(key: str) -> Column:
    """512 hexadecimal digits that key, type, canonical form and attempt decide."""
    seed = F.concat_ws("|", F.lit(key), "kind", F.col("attempt").cast("string"), "canon")
    return F.concat(*[F.sha2(F.concat(F.lit(f"{i}|"), seed), 512) for i in range(4)])


def _draw(i: Column, n: int | Column) -> Column:
    """The i-th number below n of the stream (the stream's 128 numbers repeat)."""
    return F.conv(F.substr(F.col("stream"), 4 * F.pmod(i, F.lit(128)) + 1, F.lit(4)), 16, 10).cast("int") % n


def _letter(first: str, i: Column, n: int) -> Column:
    return F.substring(F.lit("".join(chr(ord(first) + j) for j in range(n))), _draw(i, n) + 1, F.lit(1))


def _pick(letters: str, i: Column) -> Column:
    return F.substring(F.lit(letters), _draw(i, len(letters)) + 1, F.lit(1))


def _name() -> Column:
    """A made-up name; later attempts draw longer ones."""
    def syllable(consonants: str, vowels: str):
        return lambda i: F.concat(_pick(consonants, 2 * i), _pick(vowels, 2 * i + 1))

    out = None
    for script, (consonants, vowels, male, female, surname) in reversed(SCRIPTS.items()):
        syllables = F.transform(
            F.sequence(F.lit(1), F.lit(2) + F.ceil(F.col("attempt") / 2).cast("int")), syllable(consonants, vowels)
        )
        ending = F.when(F.col("kind") == "given_m", male).when(F.col("kind") == "given_f", female).otherwise(surname)
        name = F.concat(F.array_join(syllables, ""), ending)
        out = name if out is None else F.when(F.col("canon").rlike(rf"\p{{Is{script}}}"), name).otherwise(out)
    return out


def _characters() -> Column:
    """The canonical form with every letter and digit replaced by its like."""
    hexes = F.col("canon").rlike("^[0-9a-f]+$") & (F.col("kind") == "secret")
    limit = F.when(F.col("kind") == "mail", F.length("canon") - F.locate(".", F.reverse("canon"))).otherwise(
        F.length("canon")
    )
    same_start = F.col("kind").isin("phone", "card")

    def like(c: Column, i: Column) -> Column:
        digit = F.when(c == "0", _draw(i, 10)).otherwise(_draw(i, 9) + 1).cast("string")
        return (
            F.when((i >= limit) | (same_start & (i == 0)), c)
            .when(hexes, _pick("0123456789abcdef", i))
            .when(c.rlike("[0-9]"), digit)
            .when(c.rlike("[a-z]"), _letter("a", i, 26))
            .when(c.rlike("[A-Z]"), _letter("A", i, 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split("canon", ""), lambda c: c != ""), like), "")


def _octets() -> Column:
    def like(o: Column, i: Column) -> Column:
        n = F.length(o)
        value = F.when(n == 1, _draw(i, 10)).when(n == 2, _draw(i, 90) + 10).otherwise(_draw(i, 156) + 100)
        return value.cast("string")

    return F.array_join(F.transform(F.split("canon", r"\."), like), ".")


def _checked(number: Column) -> Column:
    """A card number whose last digit is the check digit of the others."""
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    # with a 0 in its place the check digit is what is missing to the next ten
    total = luhn_sum(_digits(F.concat(body, F.lit("0"))))
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canon, attempt, surrogate`` for ``kind, canon, attempt``."""
    e = entities.withColumn("stream", _stream(key))
    e = e.withColumn("plain", _characters())
    value = (
        F.when(F.col("kind").isin("given_m", "given_f", "surname"), _name())
        .when(F.col("kind") == "ip", _octets())
        .when(F.col("kind") == "card", _checked(F.col("plain")))
        .otherwise(F.col("plain"))
    )
    return e.select("kind", "canon", "attempt", value.alias("surrogate"))


def assign(entities: DataFrame, key: str = KEY, attempts: int = ATTEMPTS) -> DataFrame:
    """``kind, canon, surrogate`` of distinct ``kind, canon``: no two surrogates of
    a kind are equal, and none is an entity of its kind."""
    known = stored(entities.select("kind", "canon").distinct(), "entities")
    waiting = known
    done = None
    for attempt in range(attempts):
        drawn = _drawn(waiting.withColumn("attempt", F.lit(attempt)), key)
        drawn = drawn.join(known.select("kind", F.col("canon").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            drawn = drawn.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).select("kind", "canon", "surrogate")
        first = stored(first, "surrogates")
        done = first if done is None else done.unionByName(first)
        waiting = stored(waiting.join(first, ["kind", "canon"], "left_anti").select("kind", "canon"), "entities")
        if waiting.isEmpty():
            return done
    raise ValueError(f"no free surrogate after {attempts} draws: a format has too few values")


def _rendered(raw: Column, surrogate: Column, kind: Column) -> Column:
    """The surrogate in the raw text's case and with its separators."""
    # the i-th letter or digit of the raw text becomes the i-th of the surrogate
    characters = F.filter(F.split(raw, ""), lambda c: c != "")
    bare = F.filter(F.split(F.regexp_replace(surrogate, r"[^\p{L}0-9]", ""), ""), lambda c: c != "")

    def like(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), r"[^\p{L}0-9]", ""))
        new = F.get(bare, place)
        return F.when(~c.rlike(r"[\p{L}0-9]"), c).when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)

    by_place = F.array_join(F.transform(characters, like), "")
    # a digit of a hexadecimal secret may become a letter: it follows the others' case
    upper = raw.rlike("[A-Z]") & ~raw.rlike("[a-z]")
    by_place = F.when((kind == "secret") & upper, F.upper(by_place)).otherwise(by_place)
    proper = F.concat(F.upper(F.substring(surrogate, 1, 1)), F.expr("substring(surrogate, 2)"))
    return F.when(kind.isin("given_m", "given_f", "surname"), proper).otherwise(by_place)


def replace_entities(docs: DataFrame, key: str = "doc_id", text: str = "text", secret: str = KEY,
                     count: str = "n_replaced") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced, and their number in a new
    column ``count``."""
    if count in docs.columns:
        raise ValueError(f"column exists already: {count}")
    parts = stored(detect(docs, key, text), "pii-parts")
    table = assign(parts, secret)
    shown = parts.join(table, ["kind", "canon"]).withColumn(
        "shown", _rendered(F.col("raw"), F.col("surrogate"), F.col("kind"))
    )
    # a match has at most two parts, a document its own matches
    matches = shown.groupBy("key", "h1", "h2", "no").agg(
        F.concat(
            F.min("before"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "shown"))), lambda s: s["shown"]), " ")
        ).alias("new")
    )
    key2, first, second, own_new = unused(docs.columns, "_key", "_h1", "_h2", "_new")
    own = matches.groupBy(F.col("key").alias(key2), F.col("h1").alias(first), F.col("h2").alias(second)).agg(
        F.map_from_entries(F.collect_list(F.struct("no", "new"))).alias(own_new)
    )
    t = F.col(text)
    hit = F.coalesce(_holds(t), F.lit(False))
    h1, h2 = _hashes(t)
    both = docs.where(hit).join(
        own, F.col(key).eqNullSafe(F.col(key2)) & (h1 == F.col(first)) & (h2 == F.col(second)), "left"
    )
    found = F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    # a match without a surrogate (a number that is no card) stays
    new = F.transform(found, lambda m, i: F.coalesce(F.element_at(F.col(own_new), i), m))
    pieces = F.zip_with(F.split(t, ANY, -1), new, lambda s, r: F.concat(s, F.coalesce(r, F.lit(""))))
    clean = F.when(F.col(own_new).isNull(), t).otherwise(F.array_join(pieces, ""))
    rewritten = both.select(
        *[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size(own_new), F.lit(0)).cast("long").alias(count),
    )
    rest = docs.where(~hit).withColumn(count, F.lit(0).cast("long"))
    return rewritten.unionByName(rest)


def op4_surrogates(spark, sf_dir: str) -> DataFrame:
    """Every whole document with surrogates for its personal data."""
    return replace_entities(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


__all__ = ["detect", "assign", "replace_entities", "luhn_sum", "op4_surrogates", "PATTERNS"]
