"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Entities are found by one pattern. Each distinct value gets a surrogate from a keyed
digest: digits for digits, letters for letters in the same case and script, a name of
the same gender and script for a name. Values are compared without format, so every
mention of one value gets the same surrogate in the mention's own format. Names are known
by a title before them and replaced word by word, so a full name and its surname agree;
in a text that has them, the same words are replaced without a title too. Two values
never share a surrogate, and none equals a real value: clashing ones are drawn again,
from some draw on with more letters or digits, so that no format runs out of room.
Only texts that hold an entity are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage

# Patterns of the kinds of entities, the first that matches counts. A look at the
# next character comes before looks behind, which cost more.
KINDS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "access_key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=\btoken = \")[A-Za-z0-9_-]{8,}|(?<=\bpassword=)[^\s\"']{4,}",
    "ip": r"(?=\d)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d.]*\d)",
    "phone": r"(?=[+(])(?:(?<![\w+])\+\d{1,3}[ -]?(?:\(\d{2,4}\)|\d{2,4})[ -]?\d{3}[ -]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}[ -]?\d(?:[ -]\d{2}){4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d))",
    "ssn": r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?=\d)(?<![\w.-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",
    "male": r"(?=\p{Lu})(?<=\b(?:Mr|Sr)\. |\bMr |\bHerr |\bMonsieur |\bSeñor )\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?",
    "female": r"(?=\p{Lu})(?<=\b(?:Ms|Mrs)\. |\bMrs |\bMs |\bFrau |\bMadame |\bSeñora )\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?",
    "person": r"(?=\p{Lu})(?<=\b(?:Dr|Prof)\. |\bDr |\bProf |\bDoctor |\bProfessor )\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?",
}
_PEOPLE = ("male", "female", "person")
#: Words of names: given names by gender, and surnames, which full names and titles share.
_GIVEN = tuple(f"given_{kind}" for kind in _PEOPLE)
_WORDS = (*_GIVEN, "surname")
# Given names by gender and script.
NAMES = {
    ("male", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nico Oscar Paul".split(),
    ("female", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olga Paula".split(),
    ("male", "other"): "Адам Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Семен Тимур".split(),
    ("female", "other"): "Анна Вера Галина Дарья Елена Жанна Инна Ксения Лариса Мария Нина Ольга Полина Раиса София Тамара".split(),
}
PATTERN = "|".join(KINDS.values())
# No entity without one of these; looking for them is much cheaper than the pattern.
_HINTS = ("@", "AKIA", "token = ", "password=", "Mr", "Ms", "Sr. ", "Herr ", "Monsieur ", "Señor", "Frau ", "Madame ", "Dr. ", "Dr ", "Doctor ", "Prof")
#: From this draw on a surrogate gets one more letter or digit at each draw; names get a syllable from the first.
_WIDER = 24


def _kind(mention: Column) -> Column:
    """Kind of a mention, told by its shape; names and secrets are known by what stands before them."""
    out = F.lit("secret")
    for kind in ("card", "ssn", "phone", "ip", "access_key", "email"):
        out = F.when(mention.rlike(f"^(?:{KINDS[kind]})$"), kind).otherwise(out)
    return out


def _mentions(found: Column, gaps: Column) -> Column:
    """Entities as ``(kind, mention)``, told from what was found and what stands before each."""
    male = r"(?:\b(?:Mr|Sr)\. |\bMr |\bHerr |\bMonsieur |\bSeñor )$"
    female = r"(?:\b(?:Ms|Mrs)\. |\bMrs |\bMs |\bFrau |\bMadame |\bSeñora )$"
    person = r"(?:\b(?:Dr|Prof)\. |\bDr |\bProf |\bDoctor |\bProfessor )$"

    def told(mention: Column, gap: Column) -> Column:
        near = F.substring(gap, -12, 12)  # longer than any title
        kind = F.when(near.rlike(male), "male").when(near.rlike(female), "female").when(near.rlike(person), "person").otherwise(_kind(mention))
        return F.struct(kind.alias("kind"), mention.alias("mention"))

    return F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), told)


def _value(kind: Column, mention: Column) -> Column:
    """A mention without its format."""
    return (
        F.when(kind == "email", F.lower(mention))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, r"\D", ""))
        .otherwise(mention)
    )


def _parts(kind: Column, mention: Column) -> Column:
    """What of a mention gets a surrogate of its own, in order: the words of a name, else the whole value."""
    words = F.split(mention, " ")
    surname = F.struct(F.lit("surname").alias("part"), F.element_at(words, -1).alias("value"))
    given = F.struct(F.concat(F.lit("given_"), kind).alias("part"), F.element_at(words, 1).alias("value"))
    whole = F.struct(kind.alias("part"), _value(kind, mention).alias("value"))
    return F.when(~kind.isin(*_PEOPLE), F.array(whole)).when(F.size(words) > 1, F.array(given, surname)).otherwise(F.array(surname))


def _byte(digest: Column, k: Column) -> Column:
    """The ``k``-th byte (from 0) of a hexadecimal digest, read in a circle."""
    return F.conv(F.substring(digest, F.pmod(k, F.lit(64)).cast("int") * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _drawn(kind: Column, value: Column, key: str, draw: int) -> Column:
    """The surrogate of a value; its letters and digits stand where the value's do."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, value, F.lit(str(draw))), 512)
    domain = F.when(kind == "email", F.length(value) - F.length(F.substring_index(value, ".", -1))).otherwise(F.length(value))
    fixed = F.when(kind == "access_key", 4).when(kind == "phone", 1).when(kind == "card", 1).otherwise(0)

    def letter(c: Column, k: Column) -> Column:
        step = _byte(digest, k)
        return (
            F.when((k < fixed) | (k >= domain), c)
            .when(c.rlike("[0-9]"), F.pmod(step, F.lit(10)).cast("string"))
            .when(c.rlike("[a-f]") & value.rlike("^[0-9a-f]+$"), F.substring(F.lit("abcdef"), F.pmod(step, F.lit(6)) + 1, F.lit(1)))
            .when(c.rlike("[a-z]"), F.char(F.pmod(step, F.lit(26)) + 97))
            .when(c.rlike("[A-Z]"), F.char(F.pmod(step, F.lit(26)) + 65))
            .otherwise(c)
        )

    letters = F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), letter), "")
    if draw >= _WIDER:  # letters before, which every one of these formats takes
        steps = F.sequence(F.lit(1), F.lit(draw - _WIDER + 1))
        more = F.array_join(F.transform(steps, lambda k: F.char(F.pmod(_byte(digest, -k), F.lit(26)) + 97)), "")
        digits = F.array_join(F.transform(steps, lambda k: F.pmod(_byte(digest, -k), F.lit(10)).cast("string")), "")
        letters = F.when(kind.isin("email", "secret"), F.concat(more, letters)).otherwise(F.concat(letters, digits))
    octets = F.concat_ws(".", *(F.pmod(_byte(digest, F.lit(k)), F.lit(223)) + 1 for k in range(4)))
    octets = octets if draw < _WIDER else F.concat(octets, F.lit(":"), _byte(digest, F.lit(5)).cast("string"), _byte(digest, F.lit(6)).cast("string"))

    def word(script: str) -> Column:
        """A word of a name: surnames are syllables, given names one of the list and, from the second draw on, syllables."""
        syllables = ("ber", "den", "hol", "kes", "lan", "mar", "ros", "tin") if script == "latin" else ("бер", "ден", "гол", "кес", "лан", "мар", "рос", "тин")
        listed = F.array(*(F.lit(s) for s in syllables))

        def tail(count: int) -> Column:
            if not count:
                return F.lit("")
            return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(count)), lambda k: F.get(listed, F.pmod(_byte(digest, k), F.lit(8)))), "")

        def own(gender: str) -> Column:
            return F.get(F.array(*(F.lit(n) for n in NAMES[gender, script])), F.pmod(_byte(digest, F.lit(0)), F.lit(16)))

        either = F.when(F.pmod(_byte(digest, F.lit(63)), F.lit(2)) == 0, own("male")).otherwise(own("female"))
        given = F.when(kind == "given_male", own("male")).when(kind == "given_female", own("female")).otherwise(either)
        return F.when(kind == "surname", F.initcap(tail(3 + draw))).otherwise(F.concat(given, tail(draw)))

    name = F.when(value.rlike(r"^[\p{IsLatin}' -]+$"), word("latin")).otherwise(word("other"))
    return F.when(kind == "ip", octets).when(kind.isin(*_WORDS), name).otherwise(letters)


def _formatted(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's format: its separators, its case."""
    places = F.filter(F.split(mention, ""), lambda c: c != "")
    digits = F.transform(
        places,
        lambda c, k: F.when(c.rlike(r"\d"), F.substring(surrogate, F.length(F.regexp_replace(F.substring(mention, F.lit(1), k + 1), r"\D", "")), F.lit(1))).otherwise(c),
    )
    cased = F.transform(places, lambda c, k: F.when(c.rlike("[A-Z]"), F.upper(F.substring(surrogate, k + 1, F.lit(1)))).otherwise(F.substring(surrogate, k + 1, F.lit(1))))
    longer = F.substring(surrogate, F.length(mention) + 1, F.length(surrogate))
    rest = F.substring(surrogate, F.length(F.regexp_replace(mention, r"\D", "")) + 1, F.length(surrogate))
    return F.when(kind.isin("phone", "card", "ssn"), F.concat(F.array_join(digits, ""), rest)).when(kind == "email", F.concat(F.array_join(cased, ""), longer)).otherwise(surrogate)


def _surrogates(values: DataFrame, key: str) -> DataFrame:
    """``kind, value, surrogate`` with no two values of a kind sharing one, nor any equal to a real value.

    All words of names are one kind in this. Each draw writes what it settles, and what is open.
    """
    space = F.when(F.col("kind").isin(*_WORDS), "name").otherwise(F.col("kind")).alias("space")
    real = values.select(space, F.col("value").alias("surrogate")).distinct()
    open_values, done, draw = values, None, 0
    while True:
        drawn = open_values.select("kind", "value", space, _drawn(F.col("kind"), F.col("value"), key, draw).alias("surrogate"))
        first = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "value")).alias("first"))
        first = first.join(real, ["space", "surrogate"], "left_anti")
        if done is not None:
            first = first.join(done.select(space, "surrogate"), ["space", "surrogate"], "left_anti")
        told = drawn.join(first, ["space", "surrogate"], "left")
        settled = F.coalesce((F.col("first.kind") == F.col("kind")) & (F.col("first.value") == F.col("value")), F.lit(False))
        round_ = cut_lineage(told.select("kind", "value", "surrogate", settled.alias("settled")), "surrogates")
        good = round_.filter("settled").drop("settled")
        done = good if done is None else done.unionByName(good)
        open_values = round_.filter("not settled").select("kind", "value")
        draw += 1
        if open_values.isEmpty():
            return done


def _hinted(text: Column) -> Column:
    hint = text.rlike("[0-9]")
    for part in _HINTS:
        hint = hint | text.contains(part)
    return hint


def replace_entities(docs: DataFrame, key: str = "surrogate-key") -> DataFrame:
    """``doc_id, n_entities, kinds, text`` for each row of ``docs``, with entities replaced.

    Texts without an entity come back as they are; null stays null with no entities.
    ``kinds`` is the sorted list of kinds found. Names that stand without a title are found
    only where the same text has them with one. Rows with equal texts get equal results.
    Null ids pass through, an empty table gives no rows, other columns are ignored.
    """
    source = docs.select("doc_id", "text")
    found = F.when(_hinted(F.col("text")), F.col("text").rlike(PATTERN)).otherwise(F.lit(False))
    plain = source.filter(~found).select(
        "doc_id", F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("kinds"), "text"
    )
    # A column of its own for each costly array, so that it is made once a text and not once a mention.
    parts = source.filter(found).select(
        "doc_id", F.sha2("text", 256).alias("text_key"),
        F.regexp_extract_all("text", F.lit(f"({PATTERN})"), F.lit(1)).alias("found"), F.split("text", PATTERN).alias("gaps"),
    )
    held = cut_lineage(parts.select("doc_id", "text_key", "gaps", _mentions(F.col("found"), F.col("gaps")).alias("mentions")), "entities")
    mentions = held.select("text_key", F.explode("mentions").alias("m")).select("text_key", "m.*").distinct()
    pieces = mentions.select("text_key", F.col("kind").alias("of"), "mention", F.posexplode(_parts(F.col("kind"), F.col("mention"))).alias("place", "p"))
    pieces = pieces.select("text_key", "of", "mention", "place", F.col("p.part").alias("kind"), F.col("p.value").alias("value"))
    values = cut_lineage(pieces.select("kind", "value").distinct(), "values")
    surrogates = _surrogates(values, key)
    put_part = _formatted(F.col("kind"), F.col("mention"), F.col("surrogate"))
    puts = pieces.join(surrogates, ["kind", "value"]).select(
        "text_key", "of", "mention", F.struct("place", put_part.alias("put")).alias("part"),
        # A word that a text has both as given name and as surname is the latter where it stands alone.
        F.when(F.col("kind").isin(*_WORDS), F.struct("value", (F.col("kind") != "surname").alias("given"), "surrogate")).alias("word"),
    )
    forms = puts.groupBy("text_key", "of", "mention").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda x: x["put"]), " ").alias("put"), F.collect_set("word").alias("words")
    )
    maps = forms.groupBy("text_key").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "of", "mention").alias("form"), "put"))).alias("puts"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"),
    )

    def alone(word: Column) -> Column:
        return F.concat(F.lit(r"(?<![\p{L}\p{N}'-])"), word["value"], F.lit(r"(?![\p{L}\p{N}-])"))

    words = F.filter("words", lambda w: ~w["given"] | ~F.exists("words", lambda v: (v["value"] == w["value"]) & ~v["given"]))
    known = held.join(maps, "text_key").withColumn("words", words)
    known = known.withColumn(
        "loose", F.aggregate("gaps", F.lit(0), lambda n, gap: n + F.aggregate("words", F.lit(0), lambda k, w: k + F.regexp_count(gap, alone(w))))
    ).withColumn("gaps", F.transform("gaps", lambda gap: F.aggregate("words", gap, lambda t, w: F.regexp_replace(t, alone(w), w["surrogate"]))))
    put = F.zip_with(
        "mentions", F.slice("gaps", 2, F.size("mentions")),
        lambda m, gap: F.concat(F.element_at("puts", F.concat_ws("|", m["kind"], m["mention"])), gap),
    )
    joined = F.concat(F.get("gaps", F.lit(0)), F.array_join(put, ""))
    replaced = known.select(
        "doc_id", (F.size("mentions") + F.col("loose")).cast("long").alias("n_entities"),
        F.array_sort(F.array_distinct(F.transform("mentions", lambda m: m["kind"]))).alias("kinds"), joined.alias("text"),
    )
    return plain.unionByName(replaced)
