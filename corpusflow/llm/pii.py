"""Surrogates for personal data, with DataFrame functions only.

Detected entities get replacements that a key, the type and the entity determine: digits for digits,
letters for letters, octets of the same length, check digits where the original has them, names that
fit the gender of the title and the script. Spellings of one entity that differ in case, and a person's
full and family name, share their surrogates. Collisions are checked over the whole corpus: of the entities that
would get the same surrogate one keeps it, and the others are drawn again, until all differ.

Only distinct entities are drawn for. Each document's entities are joined back by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.session import materialise

# What counts as an entity, and titles that tell the gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Госпожа", "Κυρία")
#: A name with its parts joined by hyphens and apostrophes, as one entity; an English possessive is not part of it.
NAME = r"\p{Lu}(?:(?!['’]s(?!\p{L}))['’\-]?\p{L})+"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])",
    "ip": r"(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ \-]?[0-9]{4}){3}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[.\-])[0-9]{3}[ .\-][0-9]{4}(?![0-9A-Za-z])",
    "person": r"(?<!\p{L})(?:" + "|".join(MALE + FEMALE) + r")\.?[ ]" + NAME + "(?:[ ]" + NAME + r")?(?!\p{L})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Sixteen syllables a script; a name takes three, and one more each time it collides.
SYLLABLES = {
    "latin": "ba de ki lo mu ra ne vi so ta ju fe gi no pa ru".split(),
    "cyrillic": "ба де ки ло му ра не ви со та жу фе ги но па ру".split(),
    "greek": "βα δε κι λο μυ ρα νε φι σο τα ζυ φε γι νο πα ρυ".split(),
}
ENDINGS = {
    "given_m": {"latin": ["n", "r", "s", "l"], "cyrillic": ["н", "р", "с", "л"], "greek": ["ος", "ης", "ας", "ων"]},
    "given_f": {"latin": ["na", "la", "ia", "ra"], "cyrillic": ["на", "ла", "ия", "ра"], "greek": ["να", "λα", "ια", "ρα"]},
    "family": {"latin": ["ck", "rd", "nd", "tt"], "cyrillic": ["ров", "нов", "лин", "син"], "greek": ["ίδης", "άκης", "ίου", "ρας"]},
}
ROUNDS = 64
WIDER = 8
_PIECES = "array<struct<kind:string,value:string>>"


def _kind(match: Column) -> Column:
    out = F.lit("person")
    for kind in ("phone", "ssn", "card", "ip", "secret", "email"):
        out = F.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def _piece(kind: Column | str, value: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), value.alias("value"))


def _split_match(match: Column) -> Column:
    """Pieces of one match: a person's title stays, given and family name are entities of their own."""
    words = F.split(match, " ")
    title = F.regexp_replace(F.get(words, F.lit(0)), r"\.", "")
    given = F.when(title.isin(list(MALE)), "given_m").otherwise("given_f")
    lead = _piece("", F.concat(F.get(words, F.lit(0)), F.lit(" ")))
    family = _piece("family", F.element_at(words, -1))
    person = F.when(F.size(words) > 2, F.array(lead, _piece(given, F.get(words, F.lit(1))), _piece("", F.lit(" ")), family)).otherwise(F.array(lead, family))
    return F.when(_kind(match) == "person", person).otherwise(F.array(_piece(_kind(match), match)))


def pieces(text: Column) -> Column:
    """The text cut into pieces; ``kind`` is empty for what stays. Null for a text without entities."""
    gaps, matches = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    first = F.array(_piece("", F.get(gaps, F.lit(0))))
    rest = F.flatten(F.transform(matches, lambda m, i: F.concat(_split_match(m), F.array(_piece("", F.get(gaps, i + 1))))))
    return F.when(text.rlike(ANY), F.concat(first, rest)).cast(_PIECES)


def _pick(options: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (number % len(options) + 1).cast("int"))


def _surrogate(kind: Column, value: Column, key: str, attempt: int) -> Column:
    """The surrogate of a lower-case value at an attempt."""
    seeds = [F.sha2(F.concat_ws("|", F.lit(f"{key}|{attempt}|{b}"), kind, value), 256) for b in range(4)]
    stream = F.concat(*seeds)

    def byte(i: Column) -> Column:
        return F.conv(F.substring(stream, 2 * (i % 128) + 1, F.lit(2)), 16, 10).cast("int")

    def digit(c: Column, i: Column) -> Column:
        return F.when(c == "0", byte(i) % 10).otherwise(byte(i) % 9 + 1).cast("string")

    def letter(i: Column, size: int) -> Column:
        return F.chr(F.lit(97) + byte(i) % size)

    def shaped(text: Column, letters: int) -> Column:
        def change(c: Column, i: Column) -> Column:
            return F.when(c.rlike("^[0-9]$"), digit(c, i)).when(c.rlike("^[a-z]$"), letter(i, letters)).otherwise(c)

        return F.array_join(F.transform(F.split(text, ""), change), "")

    def octet(o: Column, i: Column) -> Column:
        if attempt >= WIDER:
            return (F.lit(100) + (byte(i) * 256 + byte(i + 4)) % 155).cast("string")
        wide = (F.lit(100) + (byte(i) * 256 + byte(i + 4)) % 155).cast("string")
        two = (F.lit(10) + byte(i) % 90).cast("string")
        return F.when(F.length(o) == 3, wide).when(F.length(o) == 2, two).otherwise((byte(i) % 9 + 1).cast("string"))

    def luhn(text: Column) -> Column:
        digits = F.transform(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda c: c.cast("int"))
        doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
        return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10

    def valid_card(text: Column) -> Column:
        body = F.regexp_replace(text, "[0-9]$", "0")
        right = F.regexp_replace(text, "[0-9]$", "")
        return F.when(luhn(value) == 0, F.concat(right, ((F.lit(10) - luhn(body)) % 10).cast("string"))).otherwise(text)

    def name(part: str) -> Column:
        out = None
        for script, syllables in SYLLABLES.items():
            built = F.concat(*[_pick(syllables, byte(F.lit(i))) for i in range(3 + attempt)], _pick(ENDINGS[part][script], byte(F.lit(100))))
            test = {"latin": F.lit(True), "cyrillic": value.rlike(r"\p{IsCyrillic}"), "greek": value.rlike(r"\p{IsGreek}")}[script]
            out = built if out is None else F.when(test, built).otherwise(out)
        return out

    at = F.substring_index(value, ".", -1)
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)
    return (
        F.when(kind == "email", F.concat(shaped(F.regexp_replace(value, r"[^.]+$", ""), 26), at))
        .when(kind == "secret", shaped(value, 6))
        .when(kind == "ip", F.array_join(F.transform(F.split(value, r"\."), octet), "."))
        .when(kind == "card", valid_card(shaped(value, 26)))
        .when(kind == "phone", F.concat(code, shaped(F.regexp_replace(value, r"^\+[0-9]{1,3}", ""), 26)))
        .when(kind == "given_m", name("given_m"))
        .when(kind == "given_f", name("given_f"))
        .when(kind == "family", name("family"))
        .otherwise(shaped(value, 26))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of distinct entities (kind, value): no two of a kind get the same, and none its own."""
    pending = materialise(entities.distinct(), "entities")
    settled: DataFrame | None = None
    for attempt in range(ROUNDS):
        drawn = pending.withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), key, attempt))
        drawn = materialise(drawn, "drawn")
        first = drawn.where("surrogate != value").groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        if settled is not None:
            first = first.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = materialise(first.select("kind", "value", "surrogate"), "settled")
        settled = first if settled is None else settled.unionByName(first)
        pending = materialise(pending.join(first, ["kind", "value"], "left_anti"), "entities")
        if pending.isEmpty():
            return settled
    raise RuntimeError(f"entities without a surrogate of their own after {ROUNDS} draws")


def _cased(original: Column, surrogate: Column) -> Column:
    upper = (original == F.upper(original)) & (original != F.lower(original))
    first = F.substring(original, 1, 1)
    titled = (first != F.lower(first))
    return F.when(upper, F.upper(surrogate)).when(titled, F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate)))).otherwise(surrogate)


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with surrogates in the text, and ``n_entities`` and ``kinds`` (their kinds in order).

    Kinds: email, secret (32 to 64 hex digits), ip, card, ssn, phone, given_m, given_f and family names after a
    title. A null text stays null. Rows that repeat id and text get the same text; null ids are like any other id. Columns named
    ``n_entities`` and ``kinds`` are replaced, others passed on; an empty table stays empty.
    """
    text = F.col(f"`{text_col}`").cast("string")
    keys = {"_id": F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), "_row": F.xxhash64(text)}
    # The rows travel as one struct, so that no column of theirs can clash with those used here.
    passed = [c for c in docs.columns if c not in ("n_entities", "kinds")]
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in passed]).alias("_doc"), *[value.alias(name) for name, value in keys.items()])
    text = F.col("_doc")[text_col].cast("string")
    found = named.select("_id", "_row", pieces(text).alias("_pieces")).where("_pieces is not null").distinct()
    spots = found.select("_id", "_row", F.posexplode("_pieces").alias("at", "piece")).where("piece.kind != ''")
    spots = spots.select("_id", "_row", "at", "piece.kind", F.lower("piece.value").alias("value"), F.col("piece.value").alias("original"))
    spots = materialise(spots, "spots")
    mapped = spots.join(surrogates(spots.select("kind", "value"), key), ["kind", "value"])
    changes = mapped.groupBy("_id", "_row").agg(
        F.array_sort(F.collect_list(F.struct("at", "kind", _cased(F.col("original"), F.col("surrogate")).alias("new")))).alias("_changes")
    )
    joined = named.join(changes, ["_id", "_row"], "left")
    # The changes are in the order of the pieces: a running number of changed pieces finds each its own.
    cut = F.when(F.col("_changes").isNotNull(), pieces(text))
    joined = joined.withColumn("_pieces", cut)
    fixed = F.transform("_changes", lambda c: c["new"])
    places = F.transform("_changes", lambda c: c["at"])

    def span(place: Column, i: Column) -> Column:
        before = F.coalesce(F.get(places, i - 1), F.lit(-1))
        kept = F.transform(F.slice("_pieces", before + 2, place - before - 1), lambda p: p["value"])
        return F.concat(F.array_join(kept, ""), F.get(fixed, i))

    last = F.element_at(places, -1)
    tail = F.array_join(F.transform(F.slice("_pieces", last + 2, F.size("_pieces")), lambda p: p["value"]), "")
    new = F.concat(F.array_join(F.transform(places, span), ""), tail)
    return joined.select(
        *[F.when(F.col("_changes").isNull(), text).otherwise(new).alias(c) if c == text_col else F.col("_doc")[c].alias(c) for c in passed],
        F.coalesce(F.size("_changes"), F.lit(0)).cast("bigint").alias("n_entities"),
        F.coalesce(F.transform("_changes", lambda c: c["kind"]), F.array().cast("array<string>")).alias("kinds"),
    )
