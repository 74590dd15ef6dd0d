"""PII surrogates: detected entities become keyed, type-consistent replacements that stay distinct and coreferent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: Titles by gender in any case, and what follows them; fixed values of the languages covered.
MALE = r"(?iu:Mr|Mister|Herr|Monsieur|Señor|Sir|г-н|господин)"
FEMALE = r"(?iu:Mrs|Ms|Miss|Frau|Madame|Señora|Señorita|г-жа|госпожа)"
_NAME = r"\.?[ \t]\p{Lu}[\p{L}'’-]+(?:[ \t]\p{Lu}[\p{L}'’-]+)?"
#: Labels of secrets.
LABEL = r"(?i:password|passwd|secret|token|api_key)"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
_IPV6 = r"(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Patterns by type, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "access_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "secret": rf"(?<={LABEL}\s?[=:]\s?\"?)[^\s\"=]{{8,}}",
    "iban": rf"(?<![A-Za-z0-9]){_IBAN}(?![A-Za-z0-9])",
    "ipv6": rf"(?<![\w:.]){_IPV6}(?![\w:])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .\-]?\(?\d{2,4}\)?(?:[ .\-]?\d{2,4}){2,3}\b|(?<![\w.\-])\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4}\b(?![\-.]\d)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}\b(?!-)",
    "card": r"(?<![\w\-])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{3,4}\b(?!-)",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}\b(?!\.\d)",
    "name_m": rf"(?<!\p{{L}}){MALE}{_NAME}",
    "name_f": rf"(?<!\p{{L}}){FEMALE}{_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts that this does not match hold no entity; it keeps the long alternation from most texts.
HINT = rf"[@\d]|{LABEL}|(?<!\p{{L}})(?:{MALE}|{FEMALE})\.?[ \t]\p{{Lu}}"
#: Secrets in hex letters stay the same in capitals, as in a text put in capitals.
CAPITAL_HEX = "^[0-9A-F]+$"

#: Given names by script and gender: short fixed lists; surnames are made of syllables.
GIVEN = {
    "latin_m": "Adam Boris Carl David Erik Felix Gustav Henry Ivan Jonas Karl Leon Martin Nils Oscar Paul".split(),
    "latin_f": "Alma Berta Clara Diana Elena Flora Greta Helen Irma Julia Karla Laura Maria Nora Olga Petra".split(),
    "cyrillic_m": "Адам Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Степан".split(),
    "cyrillic_f": "Алла Белла Вера Галина Дарья Ева Жанна Зоя Инна Кира Лидия Майя Нина Ольга Полина Раиса".split(),
}
SYLLABLES = {
    "latin": "ba ce di fo gu ha ki lo mu na pe ro sa ti vo wen".split(),
    "cyrillic": "ба ве ги до жу за ки ло му на пе ро са ти фо хен".split(),
}
#: Rounds of collision checks after which a type's format must be exhausted.
ROUNDS = 40


def kind_of(match: Column) -> Column:
    """The type of what ANY found; ``none`` for what only looks like a card or an account: its check digits are wrong."""
    out = F.when(match.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    bare = F.regexp_replace(match, " ", "")
    out = out.when(match.rlike(f"^(?:{_IBAN})$"), F.when(_mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1, "iban").otherwise("none"))
    out = out.when(match.rlike(f"^(?:{_IPV6})$"), "ipv6")
    for kind in ("access_key", "ssn", "ip", "name_m", "name_f"):
        out = out.when(match.rlike("^(?:" + PATTERNS[kind].replace(r"(?<![\w\-])", "").replace(r"(?<![\w.])", "").replace(r"(?<!\p{L})", "") + ")$"), kind)
    digits = F.length(F.regexp_replace(match, r"\D", ""))
    out = out.when(match.rlike(r"^[\d \-]+$") & digits.between(15, 16), F.when(_luhn(F.regexp_replace(match, r"\D", "")) % 10 == 0, "card").otherwise("none")).when(match.rlike(r"^[+()\d .\-]+$") & digits.between(8, 15), "phone")
    return out.otherwise("secret")


def canonical(kind: Column, match: Column) -> Column:
    """What two mentions of one entity share: digits of numbers (of phones without the country code 1), lower case of addresses, accounts without blanks, hex secrets in lower case."""
    digits = F.regexp_replace(match, r"\D", "")
    home = F.when(F.length(digits) == 11, F.regexp_replace(digits, "^1", "")).otherwise(digits)
    return F.when(kind == "phone", home).when(kind.isin("card", "ssn"), digits).when(kind.isin("email", "ipv6"), F.lower(match)).when(kind == "iban", F.regexp_replace(match, " ", "")).when((kind == "secret") & match.rlike(CAPITAL_HEX), F.lower(match)).otherwise(match)


def name_of(match: Column) -> Column:
    """A titled mention without its title."""
    return F.regexp_replace(match, rf"^(?:{MALE}|{FEMALE})\.?[ \t]", "")


def parts_of(kind: Column, match: Column) -> Column:
    """The entities (kind, canon) of a mention: a family and, where it is there, a given name; of any other type itself."""
    words = F.split(F.lower(name_of(match)), r"[ \t]")
    part = lambda k, c: F.struct(k.alias("kind"), c.alias("canon"))
    family = part(F.lit("family"), F.element_at(words, -1))
    given = part(F.concat(F.lit("given_"), F.substring(kind, -1, 1)), F.element_at(words, 1))
    return F.when(kind.startswith("name_"), F.when(F.size(words) > 1, F.array(family, given)).otherwise(F.array(family))).otherwise(F.array(part(kind, canonical(kind, match))))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often ``use`` names it, in a lambda too."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _bytes(seed: Column, n: Column) -> Column:
    """At least n keyed numbers of 0 to 255."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / 32).cast("int")), lambda b: F.sha2(F.concat_ws("|", seed, b.cast("string")), 256))
    return _let(F.array_join(blocks, ""), lambda stream: F.transform(F.sequence(F.lit(0), n), lambda i: F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")))


def _letters(text: Column, seed: Column) -> Column:
    """Each character replaced by one of its kind: digit, hex letter in hex words, small or capital letter of its script."""
    def one(c: Column, b: Column, hexa: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), F.chr(48 + b % 10))
            .when(hexa & c.rlike("[a-f]"), F.chr(97 + b % 6))
            .when(c.rlike("[a-z]"), F.chr(97 + b % 26))
            .when(c.rlike("[A-Z]"), F.chr(65 + b % 26))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit("абвгдежзиклмнопрстуфхцчшщэюя"), b % 28 + 1, F.lit(1)))
            .when(c.rlike(r"\p{Ll}"), F.chr(97 + b % 26))
            .when(c.rlike(r"\p{Lu}"), F.chr(65 + b % 26))
            .otherwise(c)
        )

    letters = F.filter(F.split(text, ""), lambda c: c != "")
    drawn = F.slice(_bytes(seed, F.length(text)), F.lit(1), F.size(letters))
    return _let(text.rlike("^[0-9a-f:]+$"), lambda hexa: F.array_join(F.zip_with(letters, drawn, lambda c, b: one(c, b, hexa)), ""))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string."""
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), part), F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """The remainder by 97 of digits and capital letters, read as the numbers 10 to 35."""
    numbers = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    digits = F.filter(F.split(numbers, ""), lambda c: c != "")
    return F.aggregate(digits, F.lit(0), lambda a, d: (a * 10 + d.cast("int")) % 97)


def surrogate(kind: Column, canon: Column, key: str, attempt: Column) -> Column:
    """The replacement of a canonical entity, a function of key, type, entity and attempt alone."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    return _let(_letters(canon, seed), lambda drawn: _surrogate(kind, canon, key, attempt, seed, drawn))


def _surrogate(kind: Column, canon: Column, key: str, attempt: Column, seed: Column, drawn: Column) -> Column:
    n = F.length(canon)
    place = F.lit(1)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    host, tld = F.regexp_replace(domain, r"\.[^.]*$", ""), F.regexp_extract(domain, r"\.[^.]*$", 0)
    email = F.concat(_letters(local, seed), F.lit("@"), _letters(host, F.concat_ws("|", F.lit(key), F.lit("host"), host)), tld)
    tail = F.substring(drawn, n - 8, F.lit(9))
    area = (F.get(_bytes(F.concat(seed, F.lit("a")), F.lit(1)), F.lit(0)) % 8 + 2).cast("string")
    phone = F.when(n > 9, F.concat(F.substring(canon, place, n - 10), area, tail)).otherwise(drawn)
    body = F.concat(F.substring(canon, place, F.lit(1)), F.substring(drawn, F.lit(2), n - 2))
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10 + F.when(_luhn(canon) % 10 == 0, 0).otherwise(1)) % 10
    card = F.concat(body, check.cast("string"))
    ip = F.array_join(F.transform(F.slice(_bytes(seed, F.lit(4)), 1, 4), lambda b: (b % 254 + 1).cast("string")), ".")
    ip = F.when(canon.rlike(r"^(10|127)\."), F.concat(F.substring_index(canon, ".", 1), F.lit("."), F.substring_index(ip, ".", -3))).when(canon.startswith("192.168."), F.concat(F.lit("192.168."), F.substring_index(ip, ".", -2))).otherwise(ip)
    access = F.concat(F.substring(canon, place, F.lit(4)), F.substring(drawn, F.lit(5), n))
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def pick(table: dict[str, list[str]], which: Column, i: Column) -> Column:
        out = None
        for name, values in table.items():
            value = F.get(F.array(*map(F.lit, values)), i % len(values))
            out = F.when(which == name, value) if out is None else out.when(which == name, value)
        return out

    # more syllables after each fourth attempt, so that names never run out
    family = F.initcap(F.array_join(F.transform(F.slice(_bytes(seed, F.lit(16)), F.lit(1), F.least(F.lit(15), 3 + F.floor(attempt / 4).cast("int"))), lambda b: pick(SYLLABLES, script, b)), ""))
    given = pick(GIVEN, F.concat(script, F.substring(kind, -2, 2)), F.get(_bytes(seed, F.lit(1)), F.lit(0)))
    given = F.when(attempt < 4, given).otherwise(family)  # the lists are short; made-up names after that
    country, rest = F.substring(canon, 1, 2), F.substring(drawn, F.lit(5), n)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0"), rest)
    return F.when(kind == "iban", iban).when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ip", ip).when(kind == "access_key", access).when(kind == "family", family).when(kind.startswith("given_"), given).otherwise(drawn)


def surrogates(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canon, sur) with sur distinct within a type and equal to no detected entity of the type.

    :param entities: (kind, canon), distinct. Each round gives those that collide, or that hit a real entity, their next
        attempt; the smallest of a colliding group keeps its own. Those that still collide after ``rounds``, because their
        format holds hardly more values than there are entities, get a wider form: a dash and 16 keyed hex digits more.
    """
    taken = entities.select("kind", F.lower("canon").alias("norm")).distinct()

    def drawn(df: DataFrame) -> DataFrame:
        out = df.withColumn("sur", surrogate(F.col("kind"), F.col("canon"), key, F.col("attempt")))
        return out.withColumn("norm", F.lower("sur"))

    now = durable(drawn(entities.withColumn("attempt", F.lit(0))))
    for _ in range(rounds):
        first = now.groupBy("kind", "norm").agg(F.min(F.struct("attempt", "canon")).alias("first"), F.count("*").alias("n"))
        clash = now.join(first.where("n > 1"), ["kind", "norm"]).where("struct(attempt, canon) <> first").select("kind", "canon")
        real = now.join(taken, ["kind", "norm"], "left_semi").select("kind", "canon")
        bad = durable(clash.union(real).distinct())
        if bad.isEmpty():
            return now.select("kind", "canon", "sur")
        moved = now.join(bad, ["kind", "canon"], "left_semi").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        now = durable(now.join(bad, ["kind", "canon"], "left_anti").unionByName(drawn(moved)))
    wide = now.join(bad, ["kind", "canon"], "left_semi").select("kind", "canon", F.concat("sur", F.lit("-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), "kind", "canon"), 256), 1, 16)).alias("sur"))
    return now.join(bad, ["kind", "canon"], "left_anti").select("kind", "canon", "sur").union(wide)


def _shaped(match: Column, kind: Column, sur: Column) -> Column:
    """The surrogate in the mention's own form: its separators, its capitals, a country code that the entity leaves out."""
    size = F.length(F.regexp_replace(match, r"\D", ""))
    sur = F.when(kind == "phone", F.concat(F.substring(F.regexp_replace(match, r"\D", ""), F.lit(1), F.greatest(F.lit(0), size - F.length(sur))), sur)).otherwise(sur)
    slots = F.filter(F.split(match, ""), lambda c: c != "")
    before = F.transform(slots, lambda c, i: F.length(F.regexp_replace(F.substring(match, F.lit(1), i + 1), r"\D", "")))
    digits = F.array_join(F.transform(slots, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(sur, F.get(before, i), F.lit(1))).otherwise(c)), "")
    upper = F.when((F.upper(match) == match) & match.rlike(r"\p{Lu}"), F.upper(sur)).otherwise(sur)
    signs = F.transform(slots, lambda c, i: F.length(F.regexp_replace(F.substring(match, F.lit(1), i + 1), " ", "")))
    account = F.array_join(F.transform(slots, lambda c, i: F.when(c != " ", F.substring(sur, F.get(signs, i), F.lit(1))).otherwise(c)), "")
    return F.when(kind.isin("phone", "card", "ssn"), digits).when(kind == "iban", account).when(kind.isin("email", "ipv6"), upper).when((kind == "secret") & match.rlike(CAPITAL_HEX), upper).otherwise(sur)


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Replace every detected entity of every text by its surrogate.

    :param key: the secret that surrogates depend on; with another key they are others.
    :return: docs with ``text_col`` rewritten and n_entities (int) added, replacing a column so named.

    One entity has one surrogate in the whole table, in whatever form it is written; two entities of a type never
    share one. Names have a surrogate for the family and one for the given name, so that shorter mentions agree with
    longer ones; what a titled mention names is replaced in the rest of the same text without a title too. Numbers whose
    check digits are wrong are no cards or accounts and stay. Null texts stay null and empty texts empty, with no entity. Repeated rows are rewritten alike; rows
    without id are rewritten like others. Very long texts are searched whole. An empty table gives an empty table.

    Mentions meet their surrogates by a join on distinct mentions of a text; a very frequent entity is salted by the
    text's hash. Texts are shuffled once, when a text meets its replacements.
    """
    mark = F.xxhash64(id_col, text_col)
    found = F.when(F.col(text_col).rlike(HINT), F.regexp_extract_all(text_col, F.lit(ANY), F.lit(0)))
    mentions = docs.select(F.col(id_col).alias("id"), mark.alias("mark"), F.explode(F.array_distinct(found)).alias("match"))
    mentions = mentions.withColumn("type", kind_of(F.col("match"))).where("type <> 'none'")
    mentions = durable(mentions.select("id", "mark", "match", "type", F.inline(parts_of(F.col("type"), F.col("match")))).distinct())
    table = surrogates(mentions.select("kind", "canon").distinct(), key)
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(7))))
    each = mentions.withColumn("salt", F.pmod(F.xxhash64("mark"), F.lit(8)).cast("int")).join(salted, ["kind", "canon", "salt"])
    given = F.col("kind").startswith("given_")
    whole = each.groupBy("id", "mark", "match", "type").agg(F.max(F.when(given, F.col("sur"))).alias("given"), F.max(F.when(~given, F.col("sur"))).alias("sur"))
    swaps = whole.groupBy(F.col("id").alias("__id"), F.col("mark").alias("__mark")).agg(F.map_from_entries(F.collect_list(F.struct("match", _written().alias("to")))).alias("__to"), F.array_distinct(F.flatten(F.collect_list(_carried()))).alias("__names"))
    swaps = swaps.withColumn("__names", F.array_sort("__names"))
    out = docs.withColumn("__own", mark)
    out = out.join(swaps, out[id_col].eqNullSafe(swaps["__id"]) & (out["__own"] == swaps["__mark"]), "left")
    hit, named = F.col("__to").isNotNull(), F.size("__names") > 0
    out = out.withColumn("__all", F.when(hit, F.regexp_extract_all(text_col, F.lit(ANY), F.lit(0))))
    out = out.withColumn("__gaps", F.when(hit, F.split(F.col(text_col), ANY, -1)))
    bounded = lambda name: F.concat(F.lit(r"(?<!\p{L})\Q"), name, F.lit(r"\E(?!\p{L})"))
    any_name = F.array_join(F.transform("__names", lambda p: bounded(p["name"])), "|")
    later = F.when(named, F.aggregate(F.transform("__gaps", lambda g: F.regexp_count(g, any_name)), F.lit(0), lambda a, n: a + n)).otherwise(0)
    clean = lambda g: F.when(named, F.aggregate("__names", g, lambda t, p: F.regexp_replace(t, bounded(p["name"]), p["to"]))).otherwise(g)
    mention = lambda m: F.coalesce(F.try_element_at("__to", m), m)
    joined = F.array_join(F.transform("__gaps", lambda g, i: F.concat(clean(g), F.coalesce(mention(F.get("__all", i)), F.lit("")))), "")
    count = F.size(F.filter("__all", lambda m: F.map_contains_key("__to", m))) + later
    out = out.withColumns({text_col: F.when(hit, joined).otherwise(F.col(text_col)), "n_entities": F.when(hit, count).otherwise(0)})
    return out.drop("__own", "__id", "__mark", "__to", "__names", "__all", "__gaps")


def _names() -> tuple[Column, Column, Column]:
    """Title, spelled name and its surrogate in the same capitals."""
    spelled, given = name_of(F.col("match")), F.col("given")
    full = F.when(given.isNotNull(), F.concat(given, F.lit(" "), F.col("sur"))).otherwise(F.col("sur"))
    capitals = (F.upper(spelled) == spelled) & (F.length(spelled) > 1)
    return F.substring(F.col("match"), F.lit(1), F.length("match") - F.length(spelled)), spelled, F.when(capitals, F.upper(full)).otherwise(full)


def _written() -> Column:
    title, _, full = _names()
    return F.when(F.col("type").startswith("name_"), F.concat(title, full)).otherwise(_shaped(F.col("match"), F.col("type"), F.col("sur")))


def _carried() -> Column:
    """(order, name, to): the untitled forms that a titled mention lets one tell in the same text, the longer first."""
    _, spelled, full = _names()
    family, to = F.element_at(F.split(spelled, r"[ \t]"), -1), F.element_at(F.split(full, " "), -1)
    form = lambda name, to: F.struct((-F.length(name)).alias("order"), name.alias("name"), to.alias("to"))
    return F.when(F.col("type").startswith("name_"), F.when(F.col("given").isNotNull(), F.array(form(spelled, full), form(family, to))).otherwise(F.array(form(family, to)))).otherwise(F.array().cast("array<struct<order:int,name:string,to:string>>"))
