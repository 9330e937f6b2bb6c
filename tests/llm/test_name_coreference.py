"""Names keep their coreference, and surrogates their type, format and distinctness over a generated table."""

import random
import re
from collections import defaultdict

from paperloom.llm.surrogates import NAMES, replace_entities


def put(spark, *texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in replace_entities(table).collect()}


def test_full_names_surnames_and_untitled_mentions_agree(spark):
    text = "Dear Mrs Anna Jones, thank you. Anna Jones wrote to Mr Paul Smith. Mrs Jones and Smith met; Anna's Joneses stay. Dr. Jones left."
    got = put(spark, text, "Nothing of Anna Jones here.", "Frau Jones schrieb an Jones.")
    first = got[0].text
    given, surname = re.match(r"Dear Mrs (\S+) (\S+), thank", first).groups()
    assert given in NAMES["female", "latin"] or any(given.startswith(n) for n in NAMES["female", "latin"])
    him, smith = re.search(r"to Mr (\S+) (\S+)\.", first).groups()
    assert first == (
        f"Dear Mrs {given} {surname}, thank you. {given} {surname} wrote to Mr {him} {smith}. "
        f"Mrs {surname} and {smith} met; {given}'s Joneses stay. Dr. {surname} left."
    )
    assert got[0].n_entities == 8 and got[0].kinds == ["female", "male", "person"]
    assert got[1].text == "Nothing of Anna Jones here." and got[1].n_entities == 0
    assert got[2].text == f"Frau {surname} schrieb an {surname}."


def test_scripts_and_words_of_both_kinds(spark):
    got = put(spark, "Herr Иван Петров и Петров", "Mrs Clara and Mr Clara Clara met Clara", "Prof. O'Neil-Smith and O'Neil-Smith")
    name = re.fullmatch(r"Herr ([А-Я]\w+) ([А-Я]\w+) и (\S+)", got[0].text).groups()
    assert name[1] == name[2] and "Петров" not in got[0].text
    alone, given, last, loose = re.fullmatch(r"Mrs (\S+) and Mr (\S+) (\S+) met (\S+)", got[1].text).groups()
    assert alone == last == loose != given and "Clara" not in got[1].text
    assert len(set(re.findall(r"[A-Z]\w+", got[2].text.replace("Prof", "")))) == 1


def test_a_generated_table(spark):
    draw = random.Random(3)
    kinds = {
        "email": lambda: f"{draw.choice('abcdef')}{draw.randrange(9)}@{draw.choice('abc')}.{draw.choice(['org', 'com'])}",
        "phone": lambda: f"+1 ({draw.randrange(200, 210)}) 555-{draw.randrange(1000, 1020)}",
        "ssn": lambda: f"{draw.randrange(100, 110)}-{draw.randrange(10, 14)}-{draw.randrange(1000, 1010)}",
        "ip": lambda: f"10.{draw.randrange(5)}.{draw.randrange(5)}.{draw.randrange(9)}",
        "card": lambda: f"4{draw.randrange(100, 110)} 1111 2222 {draw.randrange(1000, 1010)}",
        "mrs": lambda: f"Mrs {draw.choice(['Ana', 'Bea', 'Cleo'])} {draw.choice(['Hill', 'Lake', 'Wood'])}",
    }
    formats = {
        "email": r"[a-z]+\d@[a-z]\.(org|com)", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}", "ssn": r"\d{3}-\d{2}-\d{4}", "ip": r"(\d{1,3}\.){3}\d{1,3}",
        "card": r"4\d{3} \d{4} \d{4} \d{4}", "mrs": r"Mrs [A-Z][a-z]+ [A-Z][a-z]+",
    }
    real = [[(kind, make()) for kind, make in kinds.items()] for _ in range(300)]
    got = put(spark, *[" ; ".join(value for _, value in row) for row in real])
    there, back = defaultdict(set), defaultdict(set)
    values = {kind: {v for row in real for k, v in row if k == kind} for kind in kinds}
    for number, row in enumerate(real):
        after = got[number].text.split(" ; ")
        for (kind, value), new in zip(row, after, strict=True):
            assert re.fullmatch(formats[kind], new), (value, new)
            there[kind, value].add(new)
            back[kind, new].add(value)
            assert new not in values[kind]
    assert all(len(x) == 1 for x in there.values()) and all(len(x) == 1 for x in back.values())


def test_a_format_without_room_does_not_end_the_run(spark):
    """More values than nine digits of one shape would leave free are simulated by short secrets of digits only."""
    texts = [f"password={a}{b}{c}{d}" for a in "01" for b in "0123456789" for c in "0123456789" for d in "0123456789"]
    rows = put(spark, *texts, *[f"call +1{d} 555 1{e:03d}0" for d in range(3) for e in range(2)])
    new = [r.text for r in rows.values()]
    assert len(set(new)) == len(new) and not set(new) & set(texts)
