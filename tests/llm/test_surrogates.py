"""Surrogates: one for every spelling, distinct ones for distinct units, right check digits, and clashes."""

import re

import pytest
from pyspark.sql import functions as F

from ringlake.llm import catalog, pii

KEY = "a key of the tests"


def texts(spark, *rows, **more):
    d = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return [r.text for r in pii.replaced(d, KEY, **more).orderBy("doc_id").collect()]


PAIRS = [
    ("+49 30 1234567", "+49301234567"), ("+49 (0)30 1234567", "+49 30 12 34 567"), ("+1 (617) 555-7713", "+16175557713"), ("+358 40 123 4567", "+358-40-1234567"),
    ("DE89 3704 0044 0532 0130 00", "DE89370400440532013000"), ("4111 1111 1111 1111", "4111-1111-1111-1111"), ("Ann.Lee7@Corp.example.org", "ann.lee7@corp.example.org"),
    ("2001:db8:0:0:0:0:0:1", "2001:0db8::0001"),
]


def squeezed(s):
    if ":" in s:
        import ipaddress

        return str(ipaddress.ip_address(s))
    return re.sub(r"\(0\)|[^0-9A-Za-z+@]", "", s).lower()


@pytest.mark.parametrize("a, b", PAIRS)
def test_spellings_of_one_entity_keep_one_surrogate(spark, a, b):
    x, y = texts(spark, f"see {a} now", f"or {b} then")
    x, y = x[4:-4], y[3:-5]
    assert squeezed(x) == squeezed(y) != squeezed(a)
    shape = lambda s: re.sub("[A-Za-z]", "a", re.sub("[0-9]", "0", s))
    if "@" not in a and "::" not in b:
        assert shape(x) == shape(a) and shape(y) == shape(b)
    if a[0] == "+":
        assert re.match(r"\+\d+", x)[0] == re.match(r"\+\d+", a)[0]


def test_check_digits(spark):
    card, odd, iban = texts(spark, "4111 1111 1111 1111", "4111 1111 1111 1112", "DE89 3704 0044 0532 0130 00")
    luhn = lambda s: sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(s) if c.isdigit())) % 10
    assert luhn(card) == 0 and luhn(odd) == 1 and card[:-1] == odd[:-1]
    moved = iban.replace(" ", "")
    assert moved[:2] == "DE" and int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1


def test_parts_of_names_keep_their_surrogates(spark):
    got = texts(spark, "Mr. John Smith", "Mr. Smith", "John Smith", "Dr. Anna Keller", "Frau Anna Keller", "Anna Keller", "Frau Keller-Smith", "Dr. Xenia Keller", "Frau Xenia Keller", "Herr Иван Петров", "г-н Петров", "Berlin Keller")
    john, anna = got[2].split(), got[5].split()
    assert got[0] == f"Mr. {john[0]} {john[1]}" and got[1] == f"Mr. {john[1]}" and got[3] == f"Dr. {anna[0]} {anna[1]}" and got[4] == f"Frau {anna[0]} {anna[1]}"
    assert got[6] == f"Frau {anna[1]}-{john[1]}" and got[7][4:] == got[8][5:] and got[7].split()[2] == anna[1]
    assert got[9].split()[-1] == got[10].split()[-1] and re.fullmatch("[А-Яа-я-]+ [А-Яа-я]+ [А-Яа-я]+", got[9].replace("Herr", "Герр"))
    assert got[11] == "Berlin Keller" and not {"John", "Smith", "Anna", "Keller"} & set(" ".join(got[:9]).replace("-", " ").split())
    assert anna[0].startswith(tuple(pii.GIVEN["f", "latin"])) and john[0].startswith(tuple(pii.GIVEN["m", "latin"]))


def test_clashes_move_to_later_draws(spark):
    """More given names than there are first draws, so that many must clash."""
    letters = "bcdfghjklmnp"
    rows = [f"Dr. A{a}{b} Keller" for a in letters for b in letters]
    got = texts(spark, *rows)
    assert len(set(got)) == len(rows) and len({g.split()[2] for g in got}) == 1
    found = spark.createDataFrame([("given", r.split()[1].lower(), r.split()[1], "n") for r in rows], "kind string, canon string, form string, gender string")
    late = {r.canon: r.draw for r in pii.draws(found, KEY).collect()}
    assert 100 < len(late) < len(rows) + 1 and max(late.values()) >= 1
    assert texts(spark, *rows) == got


def test_surrogates_that_are_units_of_the_corpus_are_not_taken(spark):
    one = texts(spark, "123-45-6789")[0]
    both = texts(spark, "123-45-6789", one)
    assert both[0] != one and len({*both, one, "123-45-6789"}) == 4


def test_key(spark):
    d = spark.createDataFrame([(1, "call 123-45-6789")], "doc_id long, text string")
    with pytest.raises(ValueError):
        pii.replaced(d, "")
    assert pii.replaced(d, "x").first().text != pii.replaced(d, "y").first().text
    before = spark.conf.get(pii.KEY_SETTING, "")
    spark.conf.unset(pii.KEY_SETTING)
    drawn = pii.session_key(spark)
    assert len(drawn) == 64 and pii.session_key(spark) == drawn
    spark.conf.set(pii.KEY_SETTING, before or drawn)


def test_clashing_columns(spark):
    names = ["_e", "_late", "_m", "_id", "_mark", "_found", "_FOUND2"]
    d = spark.createDataFrame([(1, "mail a@b.example.com", *range(7))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    row = pii.replaced(d, KEY, found_col=None).first()
    assert row.asDict() | {"text": None} == {"doc_id": 1, "text": None, **{n: i for i, n in enumerate(names)}} and "a@b" not in row.text
    assert pii.replaced(d, KEY).first()._found[0].kind == "email"


def test_other_forms(spark):
    got = texts(spark, "at 2001:db8::1, std::map, 10:30:15 and a::b", "fe80::1ff:fe23:4567:890a", "no 1:2", None, "")
    assert "2001:db8::1" not in got[0] and got[0].endswith("std::map, 10:30:15 and a::b") and got[1] != "fe80::1ff:fe23:4567:890a" and got[2:] == ["no 1:2", None, ""]


def test_query_equals_the_operator(spark, tmp_path):
    rows = [(1, "mail x.y9@corp.example.org, +49 30 1234567", "en"), (2, "nothing here", "en"), (None, None, "en"), (4, "Frau Anna Keller and Frau Anna Keller", "de"), (4, "Frau Anna Keller and Frau Anna Keller", "de")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.queries()["op9_keyed_surrogates"](spark, str(tmp_path))
    want = pii.replaced(d, pii.session_key(spark))
    show = lambda df: sorted(map(str, df.select("doc_id", "text", F.size("_found" if "_found" in df.columns else "entities").alias("n")).collect()))
    assert show(got) == show(want) and sorted(r.n_entities for r in got.collect()) == [0, 0, 2, 2, 2]
    assert not [n for n in got._jdf.queryExecution().toString().split() if "Python" in n or "Arrow" in n]


FOUND = ["Mr. Mehmet Öztürk", "JOHN SMITH", "Dr. van der Berg", "Mrs. O'Brien", "jane.doe@müller.de", "030 1234567", "Anna de la Cruz", "Maria O’Neill", "Frau Jean-Luc Picard", "Peter-Paul Rubens", "Ms. García-López"]
LEFT = ["Grace Period", "Victoria Station", "the 2024 Park", "Mark 12 34", "van der", "10 2030 40", "0.5 12345", "MARKET SHARE"]


def test_names_of_all_forms(spark):
    rows = [(i, f"We met {x}, as said.") for i, x in enumerate(FOUND + LEFT)] + [(100, "John Smith and JOHN SMITH and Mr. Smith; Dr. van der Berg, Anna van der Berg.")]
    got = {r.doc_id: r for r in pii.replaced(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    for i, x in enumerate(FOUND):
        assert x not in got[i].text and len(got[i]._found) == 1, (x, got[i].text)
        assert got[i].text.startswith("We met ") and got[i].text.endswith(", as said.")
    for i, x in enumerate(LEFT, len(FOUND)):
        assert got[i].text == f"We met {x}, as said.", got[i].text
    # one surrogate in every spelling; small words stay, capitals stay capitals
    first, second, third, fourth, fifth = (f.surrogate for f in got[100]._found)
    assert second == first.upper() and third == "Mr. " + first.split(" ")[1] and fourth.startswith("Dr. van der ") and fifth.split(" ")[1:] == fourth.split(" ")[1:]
    assert got[2].text == f"We met {fourth}, as said." and got[1].text == f"We met {second}, as said."
