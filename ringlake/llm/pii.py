"""PII surrogates (operator 9), in DataFrame functions only.

Detected entities are replaced by keyed surrogates of the same type and format. Digit strings go through a keyed
Feistel permutation of their own length, so distinct ones stay distinct, and check digits are made anew; other types draw
from a keyed digest. What is replaced is the unit that recurs: an address or number in any spelling of its separators
and case, or a single part of a name. So ``+49 30 1234567`` and ``+49301234567`` stay one number, and ``Mr. John Smith``,
``John Smith`` and ``Mr. Smith`` keep their common parts. Every distinct unit of the corpus is then checked: where two
share a surrogate, or a surrogate is itself a unit of the corpus, a later draw of the same keyed stream is taken.

The key is the caller's secret: with it the permutations can be undone. It stands in the query plan, so plans and event
logs of such a run are to be kept as closely as the key.
"""

from __future__ import annotations

import logging
import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlake.llm.spaces import free_names, staged, table, widths

#: Setting with the key; its name is one that Spark redacts in logs.
KEY_SETTING = "ringlake.pii.secret"
#: Titles by gender, patterns by type, tried in this order at each position.
TITLES_F = "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|Signora|г-жа|Госпожа"
TITLES_M = "Mr|Herr|Señor|Sr|Monsieur|Signor|г-н|Господин"
TITLES_N = "Mx|Dr|Prof"
#: Given names by gender; an untitled name starts with one of them.
KNOWN = {
    "f": "Alice Amelie Anna Anne Ava Beatrice Carla Charlotte Chloe Clara Claire Elena Elisa Elizabeth Emily Emma Eva Grace Hannah Helena Ida Ines Irene Isabel Isabella Jane Johanna Julia Julie Karen Katharina Laura Lea Linda Lisa Lucia Luisa Margaret Maria Marie Marta Mary Mia Nina Olivia Patricia Paula Rosa Sara Sarah Sofia Sophia Sophie Susan Teresa Vera Victoria Анна Вера Дарья Елена Ирина Мария Нина Ольга Татьяна".split(),
    "m": "Adam Albert Alexander Andreas Anthony Antoine Anton Benjamin Bruno Carlos Charles Christian Daniel David Diego Emil Felix Francisco Frank George Hans Henry Hugo Jack James Javier John Jonas Jorge Joseph Juan Karl Klaus Leo Leon Louis Lucas Luis Manuel Marco Martin Matthew Max Michael Miguel Oliver Oscar Paul Pedro Peter Philipp Pierre Richard Robert Simon Stefan Thomas Victor William Андрей Борис Виктор Иван Максим Николай Павел Петр Сергей".split(),
    "n": "Alex Charlie Dominique Jamie Kim Quinn Robin Sascha Саша Женя".split(),
}
#: The country calling codes of one and two digits; all others have three.
COUNTRY_CODE = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def either(names: list[str]) -> str:
    """A pattern of any of the names, by first letter, so that most places fail at once."""
    by = {}
    for n in sorted(names):
        by.setdefault(n[0], []).append(n[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(sorted(r, key=len, reverse=True))})" for c, r in by.items()) + ")"


#: Small words inside family names, which stay as they are, and nouns that make a given name part of something else.
PARTICLES = "van|von|der|den|de|del|della|di|da|dos|du|la|le|ter|ten|zu|zur|bin|ibn|al"
THINGS = "Period|Station|Street|Road|Avenue|Square|Park|Bridge|Tower|University|College|School|Hospital|Church|Falls|Lake|River|Island|Airport|Hotel|Museum"
PART = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}++"
#: What follows a title or a given name: up to two more parts, with small words before them.
FAMILY = rf"(?:(?:{PARTICLES}) ){{0,2}}{PART}"
BARE = rf"(?=\p{{Lu}})(?<!\p{{L}}){either([n for v in KNOWN.values() for n in v])}(?!\p{{L}})"
CAPITALS = rf"(?=\p{{Lu}}\p{{Lu}})(?<!\p{{L}}){either([n.upper() for v in KNOWN.values() for n in v])}(?!\p{{L}})"
PATTERNS = {
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)+",
    "secret": r"(?<![\p{L}0-9_-])(?:[0-9a-f]{32,}+|(?:sk|pk|ghp|xoxb|AKIA)[_-]?[A-Za-z0-9_-]{16,}+)(?![\p{L}0-9_-])",
    "iban": r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "ip6": r"(?<![\p{L}0-9:.])(?=[A-Fa-f:]*+[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Fa-f:]))(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*+)?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*+)?)(?![\p{L}0-9:])",
    "phone": r"(?<![\p{L}0-9])\+[0-9]{1,3}[ .-]?(?:\(0\)[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![\p{L}0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![\p{L}0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])|(?<![\p{L}0-9.,:/-])0[1-9][0-9]{1,3}[ /-][0-9]{5,8}(?![0-9.,:/-]?[0-9])",
    "ssn": r"(?<![\p{L}0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![\p{L}0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?:{TITLES_F}|{TITLES_M}|{TITLES_N})\.? {FAMILY}(?:[ -]{FAMILY}){{0,2}}|{BARE}(?: (?!(?:{THINGS})(?!\p{{L}}))|-)(?:{FAMILY})(?:[ -]{FAMILY}){{0,1}}|{CAPITALS}(?:[ -]\p{{Lu}}{{2,}}+){{1,2}}(?!\p{{L}})",
}
#: Given names by gender and script, and name syllables by script.
GIVEN = {
    ("f", "latin"): "Anna Clara Elena Julia Laura Maria Nina Sofia Vera Emma Ida Lucia Marta Paula Rosa Irene".split(),
    ("m", "latin"): "Adam Bruno David Felix Hugo Jonas Leon Martin Oscar Peter Simon Victor Anton Emil Karl Marco".split(),
    ("n", "latin"): "Alex Robin Kim Sascha Noel Andrea Jamie Charlie Dominique Jean Luca Mika Quinn Rene Toni Sam".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Иван Максим Николай Павел Сергей".split(),
    ("n", "cyrillic"): "Саша Женя Валя Шура Слава Паша Тоня Миша".split(),
}
SYLLABLES = {"latin": "ba be bo da de do ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo wi zu".split(),
             "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва ве во ви зу".split()}
ANY = "|".join(PATTERNS.values())
#: A text without any of these has no entity.
CUE = rf"[0-9@]|(?<![\p{{L}}0-9_-])(?:[a-f]{{32}}|(?:sk|pk|ghp|xoxb|AKIA)[_-]?[A-Za-z0-9_-]{{16}})|(?<!\p{{L}})(?:{TITLES_F}|{TITLES_M}|{TITLES_N})\.? (?:(?:{PARTICLES}) )*+\p{{Lu}}|{BARE}[ -](?:(?:{PARTICLES}) )*+\p{{Lu}}|{CAPITALS}[ -]\p{{Lu}}"
TITLE = rf"^(?:{TITLES_F}|{TITLES_M}|{TITLES_N})\.? "


def kind(s: Column) -> Column:
    """Type of a detected entity, by what tells its pattern apart."""
    bare = F.regexp_replace(s, "[ -]", "")
    return (
        F.when(F.contains(s, F.lit("@")), "email").when(s.rlike(rf"^\p{{L}}[\p{{L}}-]*\.? (?:(?:{PARTICLES}) )*\p{{Lu}}['’\p{{L}}]|^\p{{Lu}}\p{{L}}+-\p{{Lu}}"), "name").when(s.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip").when(F.contains(s, F.lit(":")), "ip6")
        .when(s.rlike(r"^[A-Z]{2}[0-9]{2}"), "iban").when(s.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").when(s.rlike(r"^[+(]|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$|^0[1-9][0-9]{1,3}[ /-][0-9]{5,8}$"), "phone")
        .when(bare.rlike(r"^[0-9]{13,19}$"), "card").otherwise("secret")
    )


def let(value: Column, of) -> Column:
    """``of(value)`` with ``value`` computed once and written once in the plan."""
    return F.transform(F.array(value), of)[0]


def groups6(s: Column) -> Column:
    """The eight groups of an IPv6 address, without leading zeros, in lower case."""
    def filled(sides):
        of = lambda i: F.filter(F.split(F.coalesce(F.get(sides, F.lit(i)), F.lit("")), ":"), lambda g: g != "")
        return let(F.struct(of(0).alias("a"), of(1).alias("b")), lambda x: F.concat(x["a"], F.array_repeat(F.lit("0"), 8 - F.size(x["a"]) - F.size(x["b"])), x["b"]))

    return F.transform(let(F.split(F.lower(s), "::"), filled), lambda g: F.regexp_replace(g, "^0+(?=.)", ""))


def canonical(s: Column, k: Column) -> Column:
    """One spelling of each unit: separators of numbers and the case of addresses do not tell units apart."""
    return (
        F.when(k.isin("email", "given", "family"), F.lower(s)).when(k.isin("ssn", "card", "iban"), F.regexp_replace(s, "[^0-9A-Z]", ""))
        .when(k == "phone", F.regexp_replace(F.replace(s, F.lit("(0)"), F.lit("")), "[^0-9+]", "")).when(k == "ip6", F.array_join(groups6(s), ":")).otherwise(s)
    )


def gender(part: Column, title: Column) -> Column:
    """Of a given name: what it is known as, else what the title says."""
    among = lambda c, names: c.rlike(f"^(?:{'|'.join(names)})$")
    of = None
    for sex in "fmn":
        of = (F if of is None else of).when(among(F.initcap(part), KNOWN[sex]), sex)
    return of.when(title.rlike(f"^(?:{TITLES_F})\\b"), "f").when(title.rlike(f"^(?:{TITLES_M})\\b"), "m").otherwise("n")


def units(e: Column) -> Column:
    """``struct<kind, title, units array<struct<kind, canon, form, gender>>>``: an entity's units, one but for names, which have one a
    part, the last word's parts being the family name."""
    def unit(k: Column, form: Column, canon: Column, g: Column) -> Column:
        return F.struct(k.alias("kind"), canon.alias("canon"), form.alias("form"), g.alias("gender"))

    def parts(title: Column, words: Column) -> Column:
        def of(w, i):
            last = i == F.size(words) - 1
            small = w.rlike(f"^(?:{PARTICLES})$")
            return F.transform(F.split(w, "-"), lambda p: unit(F.when(small, "particle").when(last, "family").otherwise("given"), p, F.lower(p), F.when(last | small, "n").otherwise(gender(p, title))))

        return F.flatten(F.transform(words, of))

    def whole(k: Column) -> Column:
        name = lambda t: F.struct(k.alias("kind"), t.alias("title"), let(F.split(F.substring(e, F.length(t) + 1, F.length(e)), " "), lambda w: parts(t, w)).alias("units"))
        return F.when(k == "name", let(F.regexp_extract(e, TITLE, 0), name)).otherwise(F.struct(k.alias("kind"), F.lit("").alias("title"), F.array(unit(k, e, canonical(e, k), F.lit("n"))).alias("units")))

    return let(kind(e), whole)


def digest(key: str, *parts: Column) -> Column:
    """Hex digits of a keyed hash."""
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def number(hexes: Column, at: int | Column, digits: int = 8) -> Column:
    return F.conv(F.substring(hexes, F.lit(at) if isinstance(at, int) else at, F.lit(digits)), 16, 10).cast("bigint")


def permuted(d: Column, key: str, *tweak: Column) -> Column:
    """Keyed permutation of digit strings of one length (1 to 19 digits): eight alternating Feistel rounds of decimal halves."""
    half = F.floor(F.length(d) / 2).cast("int")
    start = F.struct(F.coalesce(F.left(d, half).try_cast("bigint"), F.lit(0).cast("bigint")).alias("a"), half.alias("n"), F.substring(d, half + 1, F.length(d)).cast("bigint").alias("b"), (F.length(d) - half).alias("m"))

    def turn(acc, i):
        size = F.pow(F.lit(10.0), acc["n"]).cast("bigint")
        return F.struct(acc["b"].alias("a"), acc["m"].alias("n"), ((acc["a"] + number(digest(key, *tweak, i, acc["m"], acc["b"]), 1, 12)) % size).alias("b"), acc["n"].alias("m"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, turn, lambda acc: F.concat(F.when(acc["n"] > 0, F.lpad(acc["a"].cast("string"), acc["n"], "0")).otherwise(""), F.lpad(acc["b"].cast("string"), acc["m"], "0")))


def laid(s: Column, to: Column) -> Column:
    """``s`` with its letters and digits replaced by those of ``to`` in turn, all else in place; ``(0)`` of a phone number stays."""
    chars = F.split(F.replace(s, F.lit("(0)"), F.lit("\u0001")), "")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def one(acc, c):
        own = c.rlike("[0-9A-Za-z]")
        return F.struct(F.concat(acc["out"], F.when(own, F.substring(to, acc["k"] + 1, F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + own.cast("int")).alias("k"))

    return F.replace(F.aggregate(chars, start, one, lambda acc: acc["out"]), F.lit("\u0001"), F.lit("(0)"))


def luhn(body: Column) -> Column:
    """The check digit of a card's other digits."""
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    digits = F.transform(F.split(F.reverse(body), ""), lambda c, i: F.when(i % 2 == 0, twice(c.try_cast("int"))).otherwise(c.try_cast("int")))
    return (10 - F.aggregate(digits, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0))) % 10) % 10


def mod97(s: Column) -> Column:
    """Remainder of a string of digits and capitals, the latter counting 10 to 35."""
    step = lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(s, ""), F.lit(0), step)


def shaped(s: Column, hexes: Column) -> Column:
    """``s`` with each letter and digit replaced by one of its class, drawn from a stream of hex digits."""
    def one(c, i):
        v = F.conv(F.substring(hexes, (i % 31) * 2 + 1, F.lit(4)), 16, 10).cast("int")
        pick = lambda pool: F.substring(F.lit(pool), v % len(pool) + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz")).otherwise(c)

    return F.array_join(F.transform(F.split(s, ""), one), "")


def _choice(pool: list[str], n: Column) -> Column:
    return F.element_at(F.split(F.lit(" ".join(pool)), " "), (n % len(pool) + 1).cast("int"))


def _syllables(script: str, h: Column, at: int, n: Column) -> Column:
    """``n`` syllables (at most 24) from a digest."""
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: _choice(SYLLABLES[script], F.conv(F.substring(h, at + 2 * i, F.lit(2)), 16, 10).cast("bigint"))), "")


def name_part(k: Column, script: str, h: Column, g: Column, draw: Column) -> Column:
    """A part of a name of its script and gender. Later draws are longer, so that there is one for any number of parts."""
    ends = {"latin": "aoi", "cyrillic": "аыи"}[script]
    stem = F.when(g == "f", _choice(GIVEN["f", script], number(h, 1))).when(g == "m", _choice(GIVEN["m", script], number(h, 1))).otherwise(_choice(GIVEN["n", script], number(h, 1)))
    end = F.when(g == "f", ends[0]).when(g == "m", ends[1]).otherwise(ends[2])
    n = F.least(draw, F.lit(18)).cast("int") + F.when(k == "family", 4).otherwise(0)
    more = _syllables(script, h, 10, n)
    return F.when(k == "family", F.initcap(more)).when(draw == 0, stem).otherwise(F.concat(stem, more, end))


def surrogate(s: Column, k: Column, c: Column, key: str, draw: Column, g: Column) -> Column:
    """The surrogate of unit ``s`` of type ``k``, canonical form ``c`` and gender ``g``; ``draw`` 0 is the first of its keyed stream."""
    def of(h: Column) -> Column:
        def number_of(x: Column) -> Column:
            # a country code is kept; a card's check digit is right where it was, and as far off as it was elsewhere
            last = F.when(k == "card", F.pmod(luhn(x["to"]) + F.right(x["digits"], F.lit(1)).try_cast("int") - luhn(x["body"]), F.lit(10)).cast("string")).otherwise("")
            return laid(s, F.concat(F.left(x["digits"], x["lead"]), x["to"], last))

        def numbered(x: Column) -> Column:
            body = F.substring(x["digits"], x["lead"] + 1, F.length(x["digits"]) - x["lead"] - F.when(k == "card", 1).otherwise(0))
            return let(F.struct(x["digits"].alias("digits"), x["lead"].alias("lead"), body.alias("body"), permuted(body, key, k, draw).alias("to")), number_of)

        def led(digits: Column) -> Column:
            return let(F.struct(digits.alias("digits"), F.when(c.startswith("+"), F.length(F.regexp_extract(digits, COUNTRY_CODE, 0))).otherwise(0).alias("lead")), numbered)

        plain = let(F.regexp_replace(c, "[^0-9]", ""), led)
        word = let(F.split(s, r"\."), lambda o: reduce(lambda acc, i: acc * 256 + o[i].try_cast("bigint"), range(1, 4), o[0].try_cast("bigint")))

        def swap(acc, i):
            return F.struct(acc["b"].alias("a"), acc["a"].bitwiseXOR(number(digest(key, F.lit("ip"), draw, i, acc["b"]), 1, 4)).alias("b"))

        ip = F.aggregate(F.sequence(F.lit(1), F.lit(6)), let(word, lambda w: F.struct(F.shiftright(w, 16).alias("a"), w.bitwiseAND(65535).alias("b"))), swap,
                         lambda acc: F.concat_ws(".", *[F.shiftright(acc[p], b).bitwiseAND(255).cast("string") for p in "ab" for b in (8, 0)]))
        # a group that is not zero becomes another of its length; late draws may be longer
        first = lambda i: F.substring(F.lit("123456789abcdef"), F.pmod(number(h, 8 * i + 1, 4), F.lit(15)).cast("int") + 1, F.lit(1))
        drawn = F.transform(F.split(c, ":"), lambda x, i: F.when(x == "0", x).otherwise(F.concat(first(i), F.substring(h, 8 * i + 5, F.least(F.lit(4), F.length(x) + F.floor(draw / 8).cast("int")) - 1))))
        count = lambda part: F.size(F.filter(F.split(part, ":"), lambda x: x != ""))
        few = lambda d: F.concat(F.array_join(F.slice(d, F.lit(1), count(F.substring_index(s, "::", 1))), ":"), F.lit("::"), F.array_join(F.reverse(F.slice(F.reverse(d), F.lit(1), count(F.substring_index(s, "::", -1)))), ":"))
        ip6 = let(drawn, lambda d: F.when(F.contains(s, F.lit("::")), few(d)).otherwise(F.array_join(d, ":")))
        ip6 = F.when(s.rlike("[A-F]"), F.upper(ip6)).otherwise(ip6)
        local, domain = F.substring_index(c, "@", 1), F.substring_index(c, "@", -1)
        letters = F.translate(F.substring(h, 1, 12), "0123456789abcdef", "bcdfghklmnprstvz")
        tail = F.regexp_extract(local, r"[0-9]+$", 0)
        where = F.translate(F.substring(digest(key, F.lit("domain"), domain), 1, 8), "0123456789abcdef", "bcdfghklmnprstvz")
        email = F.concat(letters, F.when(tail != "", F.concat(F.lit("."), F.substring(F.conv(F.substring(h, 20, 15), 16, 10), F.lit(1), F.least(F.length(tail), F.lit(12))))).otherwise(""), F.lit("@"), where, F.when(domain.rlike(r"\.(com|net|org)$"), F.concat(F.lit(".example."), F.substring_index(domain, ".", -1))).otherwise(".example"))
        # 64 hex digits a digest, as many as the entity needs
        more = F.when(F.length(s) > 128, F.array_join(F.transform(F.sequence(F.lit(2), F.floor((F.length(s) - 1) / 64).cast("int")), lambda i: digest(key, F.lit("more"), c, draw, i)), "")).otherwise("")
        hexed = F.when(c.rlike("^[0-9a-f]+$"), F.substring(F.concat(h, digest(key, F.lit("more"), c, draw), more), F.lit(1), F.length(s))).otherwise(F.concat(F.regexp_extract(s, "^(?:sk|pk|ghp|xoxb|AKIA)?[_-]?", 0), shaped(F.regexp_replace(s, "^(?:sk|pk|ghp|xoxb|AKIA)?[_-]?", ""), h)))
        iban = let(shaped(F.substring(c, 5, 100), h), lambda a: laid(s, F.concat(F.left(c, F.lit(2)), F.lpad((98 - mod97(F.concat(a, F.left(c, F.lit(2)), F.lit("00")))).cast("string"), 2, "0"), a)))
        return (
            F.when(k == "email", email).when(k == "ip", ip).when(k == "ip6", ip6).when(k.isin("phone", "card", "ssn"), plain).when(k == "iban", iban)
            .when(k == "particle", s).when(k.isin("given", "family"), let(F.when(c.rlike(r"\p{IsCyrillic}"), name_part(k, "cyrillic", h, g, draw)).otherwise(name_part(k, "latin", h, g, draw)), lambda n: F.when(s.rlike(r"^\p{Lu}['’\p{Lu}]+$"), F.upper(n)).otherwise(n))).otherwise(hexed)
        )

    return let(digest(key, k, c, draw), of)


def draws(found: DataFrame, key: str, most_rounds: int = 24) -> DataFrame | None:
    """``(kind, canon, draw, gender)`` of the units that need more than their first draw, or whose mentions do not agree on the gender;
    ``None`` where there is none.

    ``found(kind, canon, form, gender)`` has the units of all mentions. A clash is a surrogate that two units share or
    that is a unit of the corpus itself; both move on to their next draw. Clashes that are left after ``most_rounds``,
    possible only where the units nearly fill their type's space, stay and are logged.
    """
    spark = found.sparkSession
    seen = F.collect_set("gender")
    both = F.array_contains(seen, "f") & F.array_contains(seen, "m")
    each = found.where("kind <> 'particle'").groupBy("kind", "canon").agg(F.min("form").alias("form"), F.when(both, "n").when(F.array_contains(seen, "f"), "f").when(F.array_contains(seen, "m"), "m").otherwise("n").alias("gender"), (F.size(seen) > 1).alias("mixed"))
    state, n = staged(each.withColumn("draw", F.lit(0)), "pii"), widths(spark)
    for k in range(most_rounds + 1):
        # one small file comes back as one split, but its surrogates are work for many tasks
        dealt = state.repartition(n, "kind", "canon")
        now = dealt.withColumn("to", canonical(surrogate(F.col("form"), F.col("kind"), F.col("canon"), key, F.col("draw"), F.col("gender")), F.col("kind"))).select("kind", "canon", "to")
        now = staged(now, "pii")
        shared = now.groupBy("kind", "to").agg(F.count("*").alias("n")).where("n > 1").select("kind", "to")
        real = now.select("kind", F.col("canon").alias("to"))
        clash = staged(now.join(shared.union(real).distinct(), ["kind", "to"], "left_semi").select("kind", "canon"), "pii")
        if clash.isEmpty():
            break
        if k == most_rounds:
            logging.getLogger(__name__).warning("%d units keep a surrogate that is taken", clash.count())
            break
        state = staged(state.join(clash.withColumn("hit", F.lit(1)), ["kind", "canon"], "left").withColumn("draw", F.col("draw") + F.coalesce("hit", F.lit(0))).drop("hit"), "pii")
    late = state.where("draw > 0 or mixed").select("kind", "canon", "draw", "gender")
    return None if late.isEmpty() else late


def replaced(docs: DataFrame, key: str, text_col: str = "text", check: bool = True, found_col: str | None = "_found") -> DataFrame:
    """All columns of ``docs`` with entities in ``text_col`` replaced, and ``found_col array<struct<kind, surrogate>>`` in text order,
    which replaces a column of that name (``None``: no such column).

    ``key`` is a secret without a default. Null texts stay null, empty ones empty; texts of any length are read whole.
    Repeated rows are replaced alike, null ids are kept, ties do not arise, an empty table gives no rows. Further columns pass through.
    """
    if not key:
        raise ValueError("surrogates need a key of their own")
    text = F.col(f"`{text_col}`").cast("string")
    entities = F.when(text.rlike(CUE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    own_e, own_p, own_row, own_late, own_found = free_names(docs, "e", "p", "row", "late", "found")
    # detected once: a text with entities is kept as what lies between them
    some = docs.withColumn(own_e, entities).withColumn(own_p, F.when(F.size(own_e) > 0, F.split(text, ANY, -1)))
    own_text = F.when(F.size(own_e) == 0, F.col(f"`{text_col}`")).alias(text_col)
    rows = staged(some.select(*[own_text if c == text_col else F.col(f"`{c}`") for c in docs.columns], own_e, own_p, F.monotonically_increasing_id().alias(own_row)), "pii-rows")
    late = draws(rows.select(F.explode(own_e).alias("e")).select(F.inline(units(F.col("e"))["units"])), key) if check else None
    name = lambda u: F.concat_ws("|", u["kind"], u["canon"])
    if late is not None:  # the few units with a later draw reach their documents by a join
        own = rows.select(own_row, F.explode(F.array_distinct(F.flatten(F.transform(own_e, lambda e: units(e)["units"])))).alias("u")).select(own_row, "u.kind", "u.canon").distinct()
        own = own.join(late, ["kind", "canon"]).groupBy(own_row).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canon").alias("k"), F.struct("draw", "gender").alias("v")))).alias(own_late))
        rows = rows.join(staged(own, "pii"), own_row, "left")
        at = lambda u: F.try_element_at(own_late, name(u))
        pick = lambda u: (F.coalesce(at(u)["draw"], F.lit(0)), F.coalesce(at(u)["gender"], u["gender"]))
    else:
        pick = lambda u: (F.lit(0), u["gender"])

    def swap(e):
        def of(x):
            new = F.transform(x["units"], lambda u: surrogate(u["form"], u["kind"], u["canon"], key, *pick(u)))
            # parts of a name go back between the separators that stood there
            gaps = F.concat(F.regexp_extract_all(F.substring(e, F.length(x["title"]) + 1, F.length(e)), F.lit("[ -]"), F.lit(0)), F.array(F.lit("")))
            name = lambda n: F.when(x["kind"] == "name", F.concat(x["title"], F.array_join(F.zip_with(n, gaps, lambda a, b: F.concat(a, b)), ""))).otherwise(n[0])
            return F.struct(x["kind"].alias("kind"), let(new, name).alias("surrogate"))

        return let(units(e), of)

    rows = rows.withColumn(own_found, F.transform(own_e, swap))
    joined = F.array_join(F.zip_with(own_p, F.col(own_found), lambda p, f: F.concat(p, F.coalesce(f["surrogate"], F.lit("")))), "")
    new = F.when(F.size(own_e) > 0, joined).otherwise(F.col(f"`{text_col}`"))
    kept = [new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != found_col]
    return rows.select(*kept, *([F.col(own_found).alias(found_col)] if found_col else []))


def session_key(spark: SparkSession) -> str:
    """The key of ``ringlake.pii.secret``; where that is unset, one drawn for this session, so that no key is known to others."""
    if not spark.conf.get(KEY_SETTING, ""):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def op9_keyed_surrogates(spark, sf_dir: str) -> DataFrame:
    found = replaced(table(spark, sf_dir, "documents"), session_key(spark))
    return found.select("doc_id", "text", F.size("_found").alias("n_entities"), F.col("_found").alias("entities"))
