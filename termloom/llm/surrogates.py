"""Keyed surrogates for personal data, with DataFrame functions only.

Each entity is replaced by the same surrogate wherever it stands. A surrogate is a keyed permutation
of the entity's own form: characters move within their class (lower or upper case, digits, script),
halves mixing each other in turn (a Feistel network), so different entities of one form never
collide and layout, script and case stay. A surrogate that is itself an entity of the corpus is
permuted on until it is none, which keeps the mapping one-to-one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.storage import fresh, stored

ROUNDS = 6
#: Tries for a surrogate that is free; in the first half none may be an entity of the corpus.
TRIES = 24

# Forms of personal data, and ranges of code points within which characters move.
NAME = r"[\p{Lu}\p{Lo}][\p{L}'’-]+(?: [\p{Lu}\p{Lo}][\p{L}'’-]+)?"
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Господин"], "f": ["Mrs", "Ms", "Frau", "Madame", "Señora", "Госпожа"], "x": ["Dr", "Prof"]}
FORMS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "card": r"(?<![\d.])\d{4}(?:[ -]?\d{4}){3}(?!\d)",
    "phone": r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)",
    "national_id": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": r"(?<!\p{L})(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? " + NAME,
}
ANY = "|".join(f"(?:{f})" for f in FORMS.values())
TITLED = r"^(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.? "
# First, last and step of code points of one script and case.
RANGES = [
    (0x61, 0x7A, 1), (0x41, 0x5A, 1), (0x30, 0x39, 1), (0xE0, 0xF6, 1), (0xC0, 0xD6, 1), (0xF8, 0xFE, 1), (0xD8, 0xDE, 1),
    (0x101, 0x137, 2), (0x100, 0x136, 2), (0x13A, 0x148, 2), (0x139, 0x147, 2), (0x14B, 0x177, 2), (0x14A, 0x176, 2),
    (0x17A, 0x17E, 2), (0x179, 0x17D, 2), (0x219, 0x21B, 2), (0x218, 0x21A, 2), (0x1EA1, 0x1EF9, 2), (0x1EA0, 0x1EF8, 2),
    (0x3B1, 0x3C1, 1), (0x3C3, 0x3C9, 1), (0x391, 0x3A1, 1), (0x3A3, 0x3A9, 1), (0x3AC, 0x3AF, 1), (0x388, 0x38A, 1),
    (0x430, 0x44F, 1), (0x410, 0x42F, 1), (0x450, 0x45F, 1), (0x400, 0x40F, 1), (0x561, 0x586, 1), (0x531, 0x556, 1),
    (0x10D0, 0x10F0, 1), (0x5D0, 0x5EA, 1), (0x621, 0x63A, 1), (0x641, 0x64A, 1), (0x905, 0x939, 1), (0xE01, 0xE2E, 1),
    (0x3041, 0x3096, 1), (0x30A1, 0x30FA, 1), (0x4E00, 0x9FFF, 1), (0xAC00, 0xD7A3, 1),
]


def _moved(char: Column, key: Column) -> Column:
    """A character moved within its class by a key; other characters stay."""
    code = F.ascii(char)
    out = None
    for lo, hi, step in RANGES:
        n = (hi - lo) // step + 1
        to = F.lit(lo) + step * F.pmod(F.floor((code - lo) / step) + F.pmod(key, F.lit(n)), F.lit(n))
        letter = F.decode(F.unhex(F.lpad(F.hex(to), 4, "0")), "UTF-16BE")
        inside = code.between(lo, hi)
        if step > 1:
            inside = inside & (F.pmod(code - lo, F.lit(step)) == 0)
        out = F.when(inside, letter) if out is None else out.when(inside, letter)
    return out.otherwise(char)


def permuted(text: Column, secret: str, use: str) -> Column:
    """A one-to-one, keyed change of text that keeps every character's class."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substr(text, half + 1).alias("b"))

    def turned(part: Column, other: Column, n: Column) -> Column:
        chars = F.filter(F.split(part, ""), lambda c: c != "")
        return F.array_join(F.transform(chars, lambda c, i: _moved(c, F.xxhash64(F.lit(secret), F.lit(use), other, n, i))), "")

    # The halves change places, so each round needs one half only.
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, n: F.struct(s["b"].alias("a"), turned(s["a"], s["b"], n).alias("b"))
    )
    return F.concat(last["a"], last["b"])


def permuted_ip(text: Column, secret: str) -> Column:
    """A one-to-one, keyed change of an IPv4 address; numbers above 255 are kept in range first."""
    o = F.transform(F.split(text, r"\."), lambda x: F.pmod(x.cast("int"), F.lit(256)))
    start = F.struct((F.get(o, 0) * 256 + F.get(o, 1)).alias("a"), (F.get(o, 2) * 256 + F.get(o, 3)).alias("b"))
    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda s, n: F.struct(s["b"].alias("a"), F.pmod(s["a"] + F.pmod(F.xxhash64(F.lit(secret), s["b"], n), F.lit(65536)).cast("int"), F.lit(65536)).alias("b")),
    )
    parts = (F.floor(end["a"] / 256), end["a"] % 256, F.floor(end["b"] / 256), end["b"] % 256)
    return F.concat_ws(".", *(p.cast("int").cast("string") for p in parts))


def kind_of(surface: Column) -> Column:
    out = F.when(surface.contains("@"), "email")
    for kind in ("ip", "card", "national_id", "phone"):
        out = out.when(surface.rlike(f"^(?:{FORMS[kind]})$"), kind)
    return out.when(surface.rlike(TITLED), "name")


def sex_of(surface: Column) -> Column:
    """What a title says, if it does."""
    title = {sex: surface.rlike(r"^(?:" + "|".join(TITLES[sex]) + r")\.? ") for sex in "mf"}
    return F.when(title["m"], "m").when(title["f"], "f")


def norm_of(kind: Column, surface: Column) -> Column:
    """What an entity is known by: lower case, digits alone, or the name without its title."""
    digits = F.regexp_replace(surface, r"\D", "")
    return (
        F.when(kind == "email", F.lower(surface))
        .when(kind == "phone", F.when(F.char_length(digits) > 10, F.substring(digits, -10, 10)).otherwise(digits))
        .when(kind.isin("card", "national_id"), digits)
        .when(kind == "ip", F.array_join(F.transform(F.split(surface, r"\."), lambda x: F.pmod(x.cast("int"), F.lit(256)).cast("string")), "."))
        .otherwise(F.regexp_replace(surface, r"^\S+ ", ""))
    )


def surrogate(kind: Column, norm: Column, secret: str) -> Column:
    """The surrogate of a known form under a key."""
    local, domain = F.regexp_extract(norm, "^(.*)@", 1), F.regexp_extract(norm, "@(.*)[.]", 1)
    last = F.regexp_extract(norm, "([.][^.]*)$", 1)

    def word(w: Column) -> Column:
        # A word of which no letter moves gets letters of its own.
        new = permuted(w, secret, "name")
        code = F.lower(F.hex(F.xxhash64(F.lit(secret), F.lit("letters"), w)))
        return F.when(new == w, F.initcap(F.translate(F.lpad(code, 16, "0"), "0123456789abcdef", "bcdfghklmnprstvz"))).otherwise(new)

    words = F.array_join(F.transform(F.split(norm, " "), word), " ")
    return (
        F.when(kind == "email", F.concat(permuted(local, secret, "local"), F.lit("@"), permuted(domain, secret, "domain"), last))
        .when(kind == "ip", permuted_ip(norm, secret))
        .when(kind == "name", words)
        .otherwise(permuted(norm, secret, "digits"))
    )


def rendered(kind: Column, surface: Column, norm: Column, new: Column, sex: Column, surname: Column) -> Column:
    """The surrogate in the layout of the place: capitals, separators, country code and title, or the surname alone."""
    chars = F.filter(F.split(surface, ""), lambda c: c != "")
    skip = F.char_length(F.regexp_replace(surface, r"\D", "")) - F.char_length(norm)
    start = F.struct(F.lit("").alias("out"), (-skip).alias("k"))

    def put(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        text = F.when(digit & (s["k"] >= 0), F.substr(new, s["k"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(s["out"], text).alias("out"), F.when(digit, s["k"] + 1).otherwise(s["k"]).alias("k"))

    filled = F.aggregate(chars, start, put)["out"]
    capitals = (surface == F.upper(surface)) & (surface != F.lower(surface))
    # A woman's given name ends in a vowel, a man's does not (Latin script).
    first, rest = F.regexp_extract(new, r"^(\S+)", 1), F.regexp_extract(new, r"^\S+(.*)$", 1)
    latin = (rest != "") & new.rlike(r"^[A-Za-z]")
    fitted = F.when(latin & (sex == "f"), F.concat(first, F.lit("a"), rest)).when(latin & (sex == "m"), F.concat(first, F.lit("n"), rest)).otherwise(new)
    title = F.when(surface.rlike(TITLED), F.regexp_extract(surface, r"^(\S+ )", 1)).otherwise("")
    named = F.when(surname, F.substring_index(new, " ", -1)).otherwise(F.concat(title, fitted))
    return (
        F.when(kind == "email", F.when(capitals, F.upper(new)).otherwise(new))
        .when(kind == "ip", new)
        .when(kind == "name", named)
        .otherwise(filled)
    )


def surrogate_map(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, norm, new): one surrogate per entity, no two alike, and none that is an entity of its kind.

    Each try permutes all entities still open with a key of its own and keeps what is no entity and
    not yet given away. Where a range is nearly used up, late tries may take forms of other entities;
    a range that is too small raises.
    """
    known = stored(entities.select("kind", "norm").distinct())
    forms = known.select("kind", F.col("norm").alias("new"))
    todo, given = known, None
    for attempt in range(TRIES):
        tried = stored(todo.withColumn("new", surrogate(F.col("kind"), F.col("norm"), f"{secret}/{attempt}")))
        free = tried.filter("new <> norm")
        if attempt < TRIES // 2:
            free = free.join(forms, ["kind", "new"], "left_anti")
        if given is not None:
            free = free.join(given.select("kind", "new"), ["kind", "new"], "left_anti")
        free = stored(free.select("kind", "norm", "new"))
        given = free if given is None else given.union(free)
        todo = stored(tried.select("kind", "norm").join(free.select("kind", "norm"), ["kind", "norm"], "left_anti"))
        if todo.isEmpty():
            break
    else:
        raise ValueError("the range of some kind is too small for distinct surrogates")
    if not given.groupBy("kind", "new").count().filter("count > 1").isEmpty():
        raise ValueError("two entities share a surrogate")
    return given


def mentions(names: Column) -> Column:
    """The pattern of all entities, and of these full names and their surnames without a title, longer ones first."""
    every = F.array_distinct(F.concat(names, F.transform(names, lambda n: F.substring_index(n, " ", -1))))
    by_length = F.sort_array(F.transform(every, lambda n: F.struct(F.char_length(n).alias("length"), n.alias("n"))), asc=False)
    listed = F.array_join(F.transform(by_length, lambda x: F.concat(F.lit(r"\Q"), x["n"], F.lit(r"\E"))), "|")
    return F.when(F.size(names) > 0, F.concat(F.lit(ANY + r"|(?<!\p{L})(?:"), listed, F.lit(r")(?!\p{L})"))).otherwise(F.lit(ANY))


def pseudonymise(docs: DataFrame, secret: str, count: str = "n_entities_") -> DataFrame:
    """docs with personal data in `text` replaced, and the number of places under `count`; every row and column is kept.

    A NULL text stays NULL, texts without personal data stay as they are. The same entity (by case,
    separators or title written differently) gets the same surrogate in every row. A person is found by a title;
    later mentions in the same text, by full name or surname alone, follow. Their sex is what any title in the corpus says, if
    titles agree. doc_id need not be unique; repeated rows stay repeated; a column called `count` must not be there.
    """
    fields = docs.columns
    found, row, names, pattern, puts, pieces = fresh([*fields, count], "found", "row", "names", "pattern", "puts", "pieces")
    text = F.coalesce("text", F.lit(""))
    held = stored(docs.withColumn(found, F.regexp_extract_all(text, F.lit(ANY), 0)))
    plain = held.filter(F.size(found) == 0).drop(found).withColumn(count, F.lit(0))
    titled = F.transform(F.filter(found, lambda s: s.rlike(TITLED)), lambda s: F.regexp_replace(s, r"^\S+ ", ""))
    some = held.filter(F.size(found) > 0).withColumns({row: F.monotonically_increasing_id(), names: F.array_distinct(titled)})
    some = some.withColumn(pattern, mentions(F.col(names)))
    some = stored(some.withColumn(found, F.regexp_extract_all("text", F.col(pattern), 0)))

    places = some.select(F.col(row).alias("row"), F.col(names).alias("names"), F.posexplode(found).alias("pos", "surface"))
    kind = kind_of(F.col("surface"))
    equal = F.get(F.filter("names", lambda n: n == F.col("surface")), 0)
    longer = F.get(F.filter("names", lambda n: n.endswith(F.concat(F.lit(" "), F.col("surface")))), 0)
    norm = F.when(kind.isNull(), F.coalesce(equal, longer)).otherwise(norm_of(kind, F.col("surface")))
    places = places.select(
        "row", "pos", "surface", F.coalesce(kind, F.lit("name")).alias("kind"), norm.alias("norm"), sex_of(F.col("surface")).alias("sex"),
        (kind.isNull() & equal.isNull()).alias("surname"),
    )
    places = stored(places)
    sexes = places.filter("sex is not null").groupBy("kind", "norm").agg(F.min("sex").alias("sex"), F.max("sex").alias("other"))
    named = surrogate_map(places, secret).join(sexes.filter("sex = other").drop("other"), ["kind", "norm"], "left")
    put = rendered(F.col("kind"), F.col("surface"), F.col("norm"), F.col("new"), F.col("sex"), F.col("surname"))
    new = places.drop("sex").join(named, ["kind", "norm"]).select("row", "pos", put.alias("put"))
    new = new.groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("pos", "put"))).alias(puts))
    joined = F.concat(
        F.array_join(F.transform(puts, lambda p, i: F.concat(F.get(F.col(pieces), i), p["put"])), ""), F.get(F.col(pieces), F.size(puts))
    )
    changed = some.withColumn(pieces, F.split("text", F.col(pattern), -1)).join(new, row).withColumn("text", joined)
    return changed.select(*(F.col(f"`{c}`") for c in fields), F.size(puts).alias(count)).unionByName(plain.select(*(F.col(f"`{c}`") for c in fields), count))


def without_personal_data(docs: DataFrame, secret: str) -> DataFrame:
    (count,) = fresh(docs.columns, "n_entities_")
    return pseudonymise(docs, secret, count).drop(count)
