"""Surrogates for personal data (DataFrame functions only).

Entities are found by patterns, brought to a normal form per kind (lower case, digits alone), and each
distinct one gets a surrogate derived from a secret key: of the same kind, script, gender and format.
All mentions of an entity get the same surrogate, shown in the mention's own format (coreference), and
different entities get different ones: surrogates that fall together, or that equal a real entity of
the table, are drawn anew until none is left (distinctness). The same key gives the same surrogates
wherever no collision had to be resolved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, kept, table, unused

#: Honorifics before a name and the gender they show. Fixed values.
HONORIFICS = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "господин": "m", "Господин": "m",
    "Mrs": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "госпожа": "f", "Госпожа": "f",
    "Prof": "n", "Doctor": "n",
}
#: Given names by script and gender, and family names by script. Fixed values.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Niels Oscar Paul Robert Simon Thomas Victor".split(),
    ("latin", "f"): "Alice Berta Clara Diana Elena Flora Greta Hanna Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sofia Tessa Vera".split(),
    ("latin", "n"): "Alex Chris Dana Eli Jamie Kim Lou Max Noa Robin Sacha Sam Toni Ulli Val".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Николай Олег Павел Роман Сергей".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Ирина Кира Лидия Мария Нина Ольга Полина Раиса Софья".split(),
    ("cyrillic", "n"): "Саша Женя Валя".split(),
}
FAMILY = {
    "latin": "Abel Berg Costa Dahl Egger Frank Gruber Hansen Ibsen Jansen Keller Lange Moreau Novak Olsen Peters Quint Richter Santos Torres Ullman Vogel Weber Young Ziegler".split(),
    "cyrillic": "Беляк Волк Гончар Дьяченко Ермак Жук Зуенко Иващенко Коваль Лысенко Мороз Назаренко Орленко Петренко Руденко".split(),
}
#: Letters that stand in for letters of the same script and case.
ALPHABETS = {
    "abcdefghijklmnopqrstuvwxyz": r"[a-z]",
    "0123456789": r"[0-9]",
    "абвгдежзиклмнопрстуфхцчшэюя": r"[\x{430}-\x{44F}\x{451}]",
    "αβγδεζηθικλμνξοπρστυφχψω": r"[\x{3B1}-\x{3C9}]",
    "àáâäèéêëìíîïòóôöùúûüñç": r"[\x{DF}-\x{F6}\x{F8}-\x{17F}]",
}
#: The patterns are written so that a search is linear in the length of a text.
KINDS = {
    "email": r"(?<![\p{L}0-9._%+\-@])[\p{L}0-9._%+\-]++@[\p{L}0-9\-]++(?:\.[\p{L}0-9\-]++)*+(?<=\.[\p{L}]{2,24})",
    "phone": r"(?<![\w+])\+[0-9]{1,3}[ .\-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .\-]?[0-9]{2,4}){2,3}(?![0-9])|(?<![\w+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    "ip": r"(?<![0-9.\p{L}])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9\p{L}]|\.[0-9])",
    "card": r"(?<![0-9.\p{L}\-])[3-6][0-9]{3}([ \-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{3,4}(?![0-9\p{L}\-])",
    "ssn": r"(?<![0-9\-\p{L}])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-\p{L}])",
    "name": r"(?<![\p{L}])(?:" + "|".join(HONORIFICS) + r")\.? \p{Lu}[\p{Ll}'\-]++(?: \p{Lu}[\p{Ll}'\-]++)?",
}
#: Texts in which nothing of this is found hold no entity.
HINT = r"@|[0-9][0-9]|" + "|".join(HONORIFICS)
#: After so many rounds in a row that place no entity, the values of a format of fixed length are used up.
ROUNDS = 20
#: Family names that one draw can choose (six hex digits each, beside those of the given name).
PARTS = 20


def _pattern() -> str:
    """All kinds as one pattern; group references are not needed in the others, so the card's is the first group."""
    return "|".join([KINDS["card"], *(p for k, p in KINDS.items() if k != "card")])


def _kind(mention: Column) -> Column:
    out = F.when(mention.contains("@"), "email").when(mention.rlike(r"^[+(]"), "phone").when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-"), "ssn")
    return out.when(mention.rlike(r"^[0-9]+\."), "ip").when(mention.rlike(r"^[0-9]"), "card").otherwise("name")


def _normal(kind: Column, mention: Column) -> Column:
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return F.when(kind == "email", F.lower(mention)).when(kind.isin("phone", "card", "ssn"), digits).otherwise(mention)


def _draw(secret: str, kind: Column, normal: Column, attempt: int) -> Column:
    """128 hex digits that the key, the entity and the attempt decide."""
    return F.sha2(F.concat_ws("\x00", F.lit(secret), F.lit(str(attempt)), kind, normal), 512)


def _byte(draw: Column, i: Column) -> Column:
    return F.conv(F.substring(draw, (F.pmod(i, F.lit(64)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _letters(text: Column, draw: Column) -> Column:
    """Each letter and digit replaced by another of its alphabet; other signs stay."""

    def one(c: Column, i: Column) -> Column:
        out = c
        for alphabet, of in ALPHABETS.items():
            out = F.when(c.rlike(of), F.substring(F.lit(alphabet), _byte(draw, i) % len(alphabet) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _checksum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10


def _pick(values: list[str], draw: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.conv(F.substring(draw, at, 6), 16, 10).cast("int") % len(values) + 1)


def _name(normal: Column, draw: Column, attempt: int) -> Column:
    """The honorific stays; given and family names of its gender and the name's script, as many as there are.

    Each attempt adds a part to the family name, so that there are more names than entities before long."""
    title = F.regexp_extract(normal, r"^([^ ]+) ", 1)
    words = F.size(F.split(normal, " ")) - 1
    gender = F.create_map(*[F.lit(x) for pair in HONORIFICS.items() for x in pair])[F.regexp_replace(title, r"\.$", "")]
    out = None
    for script in FAMILY:
        at = [1, 7, *range(19, 128, 6)][: min(attempt + 1, PARTS)]
        family = F.concat_ws("-", *[_pick(FAMILY[script], draw, i) for i in at])
        for sex in ("m", "f", "n"):
            full = F.when(words > 1, F.concat_ws(" ", title, _pick(GIVEN[script, sex], draw, 13), family)).otherwise(F.concat_ws(" ", title, family))
            test = (gender == sex) & (normal.rlike(r" [\x{410}-\x{42F}\x{401}]") if script == "cyrillic" else ~normal.rlike(r" [\x{410}-\x{42F}\x{401}]"))
            out = F.when(test, full) if out is None else out.when(test, full)
    return out


def _surrogate(secret: str, kind: Column, normal: Column, attempt: int) -> Column:
    draw = _draw(secret, kind, normal, attempt)
    digit = lambda i: F.pmod(_byte(draw, F.lit(i)), F.lit(10)).cast("string")
    n = F.length(normal)
    any_digits = _letters(normal, draw)
    # the leading digit tells the issuer of a card or the country of a number, and stays
    led = F.concat(F.substring(normal, 1, 1), F.substring(any_digits, F.lit(2), n - 1))
    body = F.substring(led, F.lit(1), n - 1)
    check = F.pmod(_checksum(normal) - _checksum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    octet = lambda i, least, most: (F.pmod(_byte(draw, F.lit(i)), F.lit(most - least + 1)) + least).cast("string")
    # a short name before the @ has few values: each attempt adds a digit to the domain
    domain = F.concat(F.lit("mail"), *[digit(40 + i) for i in range(3 + min(attempt, 21))], F.lit(".example."), F.regexp_extract(normal, r"\.([^.]+)$", 1))
    email = F.concat(_letters(F.substring_index(normal, "@", 1), draw), F.lit("@"), domain)
    return (
        F.when(kind == "email", email)
        .when(kind == "card", F.concat(body, check))
        .when(kind.isin("phone", "ssn"), led)
        .when(kind == "ip", F.concat_ws(".", octet(0, 11, 126), octet(1, 0, 255), octet(2, 0, 255), octet(3, 1, 254)))
        .otherwise(_name(normal, draw, attempt))
    )


def surrogate_table(entities: DataFrame, secret: str) -> DataFrame:
    """kind, normal, surrogate for distinct entities (kind, normal): no surrogate twice, none equal to an entity.

    Rounds go on until no entity is left. Names and addresses have more values in each round; the digits
    of phones, cards and the like do not, and ROUNDS rounds that place none of them end in an error.
    """
    done, rest, attempt, idle = None, entities, 0, 0
    real = entities.select("kind", F.col("normal").alias("surrogate"))
    while True:
        drawn = rest.withColumn("surrogate", _surrogate(secret, F.col("kind"), F.col("normal"), attempt))
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        first = Window.partitionBy("kind", "surrogate").orderBy(F.sha2(F.concat_ws("\x00", F.lit(secret), F.col("normal")), 256))
        won = kept(free.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r"))
        done = won if done is None else done.unionByName(won)
        rest = kept(rest.join(won.select("kind", "normal"), ["kind", "normal"], "left_anti"))
        if not rest.limit(1).count():
            return done
        attempt, idle = attempt + 1, 0 if won.limit(1).count() else idle + 1
        if idle == ROUNDS:
            raise ValueError(f"no distinct surrogates in {ROUNDS} rounds: more entities of a kind than its format has values")


def _shown(kind: Column, mention: Column, surrogate: Column) -> Column:
    """A surrogate in the format of a mention: its separators, and for addresses its upper case."""
    fill = F.aggregate(
        F.split(mention, ""),
        F.struct(F.lit("").alias("t"), F.lit(0).alias("n")),
        lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["t"], F.substring(surrogate, s["n"] + 1, F.lit(1))).alias("t"), (s["n"] + 1).alias("n"))).otherwise(
            F.struct(F.concat(s["t"], c).alias("t"), s["n"].alias("n"))
        ),
        lambda s: s["t"],
    )
    cased = F.when(mention == F.upper(mention), F.upper(surrogate)).otherwise(surrogate)
    return F.when(kind.isin("phone", "card", "ssn"), fill).when(kind == "email", cased).otherwise(surrogate)


def pseudonymised(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with all columns, the text's personal data replaced, and ``n_replaced`` (long).

    Nulls: a null text stays null with n_replaced 0; a null key is a key. Texts without entities, empty
    ones too, stay as they are, byte for byte. Rows of equal key and text get the same text. An empty
    table gives an empty result. A column named ``n_replaced`` is replaced; others pass through.
    """
    docs = docs.drop("n_replaced")
    pattern = F.lit(_pattern())
    has = F.col("text").rlike(HINT)
    of_key, of_print, new_, n_ = unused(docs, "_key", "_print", "_new", "_n")
    ids = docs.select(F.col(key).cast("string").alias("key"), F.xxhash64(text).alias("print"), F.col(text).alias("text"))
    found = ids.where(has).select("key", "print", F.posexplode(F.regexp_extract_all("text", pattern, F.lit(0))).alias("at", "mention")).distinct()
    found = found.withColumn("kind", _kind(F.col("mention"))).withColumn("normal", _normal(F.col("kind"), F.col("mention")))
    # long numbers that fail the check sum are no cards, and stay
    real = (F.col("kind") != "card") | (_checksum(F.col("normal")) == 0)
    found = kept(found.withColumn("kind", F.when(real, F.col("kind")).otherwise("none")))
    surrogates = surrogate_table(kept(found.where("kind <> 'none'").select("kind", "normal").distinct()), secret)
    new = F.coalesce(_shown(F.col("kind"), F.col("mention"), F.col("surrogate")), F.col("mention"))
    shown = found.join(surrogates, ["kind", "normal"], "left").select("key", "print", "at", new.alias("new"), F.col("surrogate").isNotNull().cast("long").alias("n"))
    lists = shown.groupBy("key", "print").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "new"))), lambda s: s["new"]).alias(new_), F.sum("n").alias(n_))
    lists = lists.select(F.col("key").alias(of_key), F.col("print").alias(of_print), new_, n_)
    out = docs.join(lists, F.col(key).cast("string").eqNullSafe(F.col(of_key)) & (F.xxhash64(text) == F.col(of_print)), "left")
    pieces = F.split(F.col(text), _pattern(), -1)
    whole = F.array_join(F.flatten(F.transform(pieces, lambda p, i: F.when(i == 0, F.array(p)).otherwise(F.array(F.get(new_, i - 1), p)))), "")
    replaced = F.when(F.col(new_).isNull(), F.col(text)).otherwise(whole)
    kept_columns = [replaced.alias(text) if c == text else F.col(c) for c in docs.columns]
    return out.select(*kept_columns, F.coalesce(n_, F.lit(0)).cast("long").alias("n_replaced"))


@REGISTRY.query("op1_surrogates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents"), secret="op1").select("doc_id", "text", "n_replaced")
