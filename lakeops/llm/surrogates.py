"""Personal data replaced by keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import written

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Given names by script and gender. A name becomes another one of its own list.
GIVEN = {
    ("latin", "f"): (
        "Alice Anna Barbara Carmen Caroline Charlotte Claire Elena Elizabeth Emily Emma Eva Greta Hannah Helena Ingrid "
        "Isabel Jane Jennifer Julia Karen Katharina Laura Lisa Lucia Maria Marie Martha Monika Nicole Olivia Patricia "
        "Petra Rosa Sabine Sarah Sofia Sophie Susan Ursula"
    ).split(),
    ("latin", "m"): (
        "Alexander Andreas Antonio Carlos Charles Christian Daniel David Edward Felipe Frank François George Hans Henry "
        "Jack Jacques James Javier Jean John José Juan Jürgen Karl Klaus Luis Manuel Mark Martin Michael Miguel Paul Pedro "
        "Peter Pierre Robert Stefan Thomas William"
    ).split(),
    ("cyrillic", "f"): "Анна Вера Галина Екатерина Елена Ирина Любовь Мария Надежда Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Владимир Дмитрий Иван Михаил Николай Павел Пётр Сергей Юрий".split(),
}
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "госпожа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"),
}
# Syllables of invented surnames, and the endings of Cyrillic ones by gender.
SYLLABLES = {
    "latin": "bal bren cor dal dern fal gor hal hem kel kor lan len mar mel nor pel per ral rin sel sten tal tem tor val ver wel win zel".split(),
    "cyrillic": "бал бер вол гор дар зар кал кор лав мар мел мир нар пал пол раз рог сев сол тар тем хол чер шал".split(),
}
CYRILLIC_ENDING = {"m": "ов", "f": "ова"}



def _any_of(words) -> str:
    """A pattern for one of the words that looks at each first letter once."""
    tails: dict[str, list[str]] = {}
    for word in sorted(words, key=lambda w: (w[0], -len(w), w)):
        tails.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in tails.items())


_SURNAME = r"\p{Lu}[\p{L}'’-]+"
_GIVEN = _any_of(name for names in GIVEN.values() for name in names)
_TITLE = _any_of(t for titles in TITLES.values() for t in titles)
# How each kind looks. The first that matches at a place wins; a kind's own digits or letters do not go on around it.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
    r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "card": r"(?<!\w)\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\w)|(?<!\w)\d{4}[ -]\d{6}[ -]\d{5}(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "name": rf"(?=[A-ZÀ-ÞА-ЯЁг])(?<!\p{{L}})(?:(?:{_TITLE})\.? (?:(?:{_GIVEN}) )?|(?:{_GIVEN}) ){_SURNAME}(?!\p{{L}})",
}
KINDS = tuple(PATTERNS)
# All kinds at once: nothing begins within a word, and four kinds begin with a digit or one of two signs, so most places
# of a text are passed over by one or two looks.
_NUMBERS = "|".join(f"(?:{PATTERNS[kind]})" for kind in ("phone", "ip", "card", "ssn"))
ENTITY = rf"(?<!\w)(?:(?:{PATTERNS['email']})|(?=[0-9+(])(?:{_NUMBERS})|(?:{PATTERNS['name']}))"


def _hash(key: str, *parts: Column) -> Column:
    """64 hexadecimal digits from the key and the parts."""
    inner = F.sha2(F.concat_ws("|", F.lit(f"{key}:inner"), *parts), 256)
    return F.sha2(F.concat_ws("|", F.lit(f"{key}:outer"), inner), 256)


def _digits(hexed: Column) -> Column:
    return F.translate(hexed, "abcdef", "012345")


def _letters(hexed: Column) -> Column:
    return F.translate(hexed, "0123456789abcdef", "bcdfghjklmnpqrst")


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _luhn(digits: Column) -> Column:
    """The sum of card digits, every second from the right doubled; a valid number has a multiple of ten."""

    def worth(place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        return F.when(place % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, place: total + worth(place))


def _titled(gender: str) -> Column:
    return F.col("entity").rlike(rf"^(?:{'|'.join(TITLES[gender])})\.? ")


def _given(script: str, gender: str) -> Column:
    return F.col("given").isin(GIVEN[script, gender])


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern an entity matches, as the union of the patterns finds it."""
    found = F.when(entity.rlike(f"^(?:{PATTERNS['email']})$"), F.lit("email"))
    for kind in KINDS[1:]:
        found = found.when(entity.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind))
    return found.otherwise(F.lit("name"))


def _described(entities: DataFrame) -> DataFrame:
    """``kind`` and the ``canon`` by which mentions of one thing agree, whatever their format.

    An email in lower case; the last ten digits of a phone; the digits of a card; a surname in lower case, without the
    feminine ending where its script has one.
    """
    kind = F.col("kind")
    given = F.regexp_extract("entity", rf"(?:^| )({_GIVEN}) ", 1)
    surname = F.regexp_extract("entity", rf"({_SURNAME})$", 1)
    script = F.when(F.col("surname").rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    root = F.when(
        F.col("script") == "cyrillic", F.regexp_replace(F.lower("surname"), "(?<=ов|ев|ёв|ин|ын)а$", "")
    ).otherwise(F.lower("surname"))
    female = _titled("f") | _given("latin", "f") | _given("cyrillic", "f") | F.col("surname").rlike("(?:ов|ев|ёв|ин|ын)а$")
    return (
        entities.withColumn("kind", kind_of(F.col("entity")))
        .withColumn("given", F.when(kind == "name", given))
        .withColumn("surname", F.when(kind == "name", surname))
        .withColumn("script", script)
        .withColumn("gender", F.when(female, "f").otherwise("m"))
        .withColumn(
            "canon",
            F.when(kind == "phone", F.expr("right(regexp_replace(entity, '[^0-9]', ''), 10)"))
            .when(kind.isin("card", "ssn"), _only_digits(F.col("entity")))
            .when(kind == "name", F.concat_ws(" ", F.col("script"), root))
            .otherwise(F.lower("entity")),
        )
    )


#: From this attempt on, a surrogate may leave the network of a private address, and be longer than what it replaces.
WIDER = 3
#: From this attempt on, a surrogate may be something that is found in the corpus, as long as it is no other's surrogate:
#: where the corpus holds most of what a format allows, there is nothing else left.
FOUND = 8
#: No space is still too small after so many attempts but that of all IPv4 addresses.
MOST_ATTEMPTS = 40


def _made(key: str) -> Column:
    """The surrogate of ``canon``: the same for every mention, another for every ``attempt``.

    Every space grows with the attempt: mailboxes and numbers get longer, surnames get more syllables, addresses leave
    their network. So however many there are of a kind, few attempts tell them apart.
    """
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    hexed = _hash(key, kind, canon, attempt)
    digits, size = _digits(hexed), F.length(canon)
    longer = F.greatest(attempt - WIDER + 1, F.lit(0))

    def number(place: int) -> Column:
        return F.conv(F.substring(hexed, 4 * place + 1, 4), 16, 10).cast("bigint")

    private = F.regexp_extract(canon, r"^(10\.|127\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.)", 1)
    # A private address keeps its network as long as that is wide enough, and then moves to the widest one; others get a
    # public address.
    private = F.when((private != "") & (attempt >= WIDER) & (attempt < FOUND), "10.").when(attempt >= FOUND, "").otherwise(private)
    own = F.size(F.split(private, r"\.")) - 1
    first = F.when(attempt >= FOUND, number(0) % 223 + 1).when(own == 0, number(0) % 89 + 11).otherwise(number(0) % 254 + 1)
    octets = F.array(*(octet.cast("string") for octet in (first, *(number(k) % 254 + 1 for k in (1, 2, 3)))))
    ip = F.concat(private, F.array_join(F.slice(octets, F.lit(1), (F.lit(4) - own).cast("int")), "."))
    # A card keeps its first digit, and is valid if it was.
    body = F.concat(F.substring(canon, F.lit(1), F.lit(1)), F.substring(digits, F.lit(1), size - 2 + longer))
    check = ((F.lit(10) - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    wrong = F.pmod(check.cast("int") + 1 + (number(15) % 9).cast("int"), F.lit(10)).cast("string")
    card = F.concat(body, F.when(_luhn(canon) % 10 == 0, check).otherwise(wrong))
    local, host = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)

    def like(char: Column, place: Column) -> Column:
        at = place % 64 + 1
        letter, digit = F.substring(_letters(hexed), at, F.lit(1)), F.substring(digits, at, F.lit(1))
        return F.when(char.rlike("[a-z]"), letter).when(char.rlike("[0-9]"), digit).otherwise(char)

    shaped = F.array_join(F.transform(F.split(local, ""), like), "")
    more_letters = F.substring(_letters(_hash(key, F.lit("longer"), canon, attempt)), F.lit(1), attempt)
    email = F.concat(
        shaped, more_letters, F.lit("@"), F.substring(_letters(_hash(key, F.lit("host"), host)), 1, 8), F.lit(".example")
    )

    def invented(script: str) -> Column:
        choice = F.array(*map(F.lit, SYLLABLES[script]))
        size = len(SYLLABLES[script])

        def syllable(place: Column) -> Column:
            return F.get(choice, (F.conv(F.substring(hexed, place * 4 + 1, F.lit(4)), 16, 10).cast("bigint") % size).cast("int"))

        # Three syllables, and one more with every other attempt.
        places = F.sequence(F.lit(0), F.least(F.floor(attempt / 2), F.lit(12)).cast("int") + 2)
        return F.concat(F.lit(f"{script} "), F.array_join(F.transform(places, syllable), ""))

    name = F.when(canon.startswith("cyrillic "), F.concat(invented("cyrillic"), F.lit("ов"))).otherwise(invented("latin"))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, F.lit(1), F.lit(8) + longer)))
        .when(kind == "phone", F.substring(digits, F.lit(1), size + longer))
        .otherwise(name)
    )


def _distinct_surrogates(canons: DataFrame, key: str) -> DataFrame:
    """``kind``, ``canon`` and ``surrogate``: no two alike, and none that is itself something found in the corpus, but for
    those that take FOUND attempts or more.

    What is taken already, what another one of the same attempt has (all but the first) and what is found in the corpus
    is tried again, and nothing else is; spaces grow with the attempt, so the rest shrinks fast. All of it stays on the
    executors. Raises where there are more addresses than IPv4 has.
    """
    canons = written(canons, "canons")
    open_, settled = canons, None
    for attempt in range(MOST_ATTEMPTS):
        made = written(open_.withColumn("attempt", F.lit(attempt)).withColumn("surrogate", _made(key)).drop("attempt"), "surrogates")
        taken = made.groupBy("kind", "surrogate").agg(F.min("canon").alias("keeps"))
        free = made.join(taken, ["kind", "surrogate"]).filter("canon = keeps").drop("keeps")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        if attempt < FOUND:
            real = canons.select("kind", F.col("canon").alias("surrogate"))
            free = free.join(real, ["kind", "surrogate"], "left_anti")
        free = written(free.select("kind", "canon", "surrogate"), "surrogates-settled")
        settled = free if settled is None else settled.unionByName(free)
        open_ = written(made.select("kind", "canon").join(free, ["kind", "canon"], "left_anti"), "surrogates-open")
        if open_.isEmpty():
            return settled
    raise ValueError("more entities of one kind than there are surrogates")


def _other_names(key: str) -> Column:
    """Each given name's surrogate: the next of its list in an order made by the key, so no two share one."""
    pairs = []
    for names in GIVEN.values():
        order = sorted(names, key=lambda n: hmac.new(key.encode(), n.encode(), hashlib.sha256).digest())
        pairs += list(zip(order, [*order[1:], order[0]], strict=True))
    return F.create_map(*(F.lit(name) for pair in pairs for name in pair))


def _rendered(key: str) -> Column:
    """The surrogate in the format of the mention."""
    entity, made, kind = F.col("entity"), F.col("surrogate"), F.col("kind")
    total, size = F.length(_only_digits(entity)), F.length("canon")

    def laid(char: Column, place: Column) -> Column:
        before = F.length(_only_digits(F.substring(entity, F.lit(1), place)))
        rank = before - (total - size)  # a phone keeps the digits before the last ten
        return F.when(char.rlike("[0-9]") & (rank >= 0), F.substring(made, rank + 1, F.lit(1))).otherwise(char)

    # A number that had to become longer goes on at the end.
    more = F.substring(made, size + 1, F.length(made) - size)
    numbers = F.concat(F.array_join(F.transform(F.split(entity, ""), laid), ""), more)
    root = F.substring_index(made, " ", -1)
    ending = F.when((F.col("script") == "cyrillic") & (F.col("gender") == "f"), F.lit("а")).otherwise(F.lit(""))
    plain = F.initcap(F.concat(root, ending))
    surname = F.when(F.col("surname") == F.upper("surname"), F.upper(plain)).otherwise(plain)
    head = F.substring(entity, F.lit(1), F.length(entity) - F.length("surname") - F.length("given") - F.when(F.col("given") == "", 0).otherwise(1))
    given = F.when(F.col("given") == "", F.lit("")).otherwise(F.concat(F.coalesce(F.get(_array_of(key), F.lit(0)), F.col("given")), F.lit(" ")))
    name = F.concat(head, given, surname)
    email = F.when(entity == F.upper(entity), F.upper(made)).otherwise(made)
    return F.when(kind.isin("phone", "card", "ssn"), numbers).when(kind == "email", email).when(kind == "ip", made).otherwise(name)


def _array_of(key: str) -> Column:
    return F.array(F.element_at(_other_names(key), F.col("given")))


def find_entities(text: Column) -> Column:
    """All entities of a text from left to right, none overlapping; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), F.array().cast("array<string>"))


def surrogate_table(mentions: DataFrame, key: str) -> DataFrame:
    """``entity``, ``kind`` and ``replacement`` for every distinct mention in ``mentions`` (entity)."""
    described = written(_described(mentions.select("entity").distinct()), "entities")
    made = _distinct_surrogates(described.select("kind", "canon").distinct(), key)
    return written(
        described.join(made, ["kind", "canon"]).select("entity", "kind", _rendered(key).alias("replacement")), "replacements"
    )


def _replaced(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and the entities that were there in ``_found``.

    Entities and their replacements are kept by the text's hash, so copies share them. Texts with an entity meet them by
    that hash; the others, which are most, do not move.
    """
    body = F.col(text)
    ours = {"_a": F.xxhash64(body), "_b": F.xxhash64(F.lit("b"), body)}
    has = F.size(find_entities(body)) > 0
    found = docs.select(*(c.alias(n) for n, c in ours.items()), find_entities(body).alias("_found"))
    found = written(found.filter(F.size("_found") > 0).groupBy("_a", "_b").agg(F.first("_found").alias("_found")), "found")
    mentions = found.select("_a", "_b", F.explode(F.array_distinct("_found")).alias("entity"))
    pairs = F.map_from_entries(F.collect_list(F.struct("entity", "replacement")))
    maps = mentions.join(surrogate_table(mentions, key), "entity").groupBy("_a", "_b").agg(pairs.alias("_map"))
    keyed = docs.filter(has).withColumns(ours).join(found, ["_a", "_b"]).join(maps, ["_a", "_b"])

    def mended(part: Column, entity: Column) -> Column:
        return F.concat(part, F.coalesce(F.get(F.array(F.col("_map")[entity]), F.lit(0)), F.lit("")))

    whole = F.array_join(F.zip_with(F.split(body, ENTITY, -1), F.col("_found"), mended), "")
    changed = keyed.withColumn(text, whole).select(*docs.columns, "_found")
    return docs.filter(~has).withColumn("_found", F.array().cast("array<string>")).unionByName(changed)


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with all columns and every entity in ``text`` replaced.

    The replacement depends on the key and on what is meant: mentions of one thing agree in all documents, also where
    case or separators differ, and different things stay different. Null and empty texts and texts without an entity
    stay as they are, as do all other columns; repeated rows stay repeated; an empty table gives an empty result.
    Columns named ``_a``, ``_b``, ``_found`` or ``_map`` would clash and are refused.
    """
    taken = {"_a", "_b", "_found", "_map"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    return _replaced(docs, key, text).select(docs.columns)


def replacement_report(docs: DataFrame, key: str) -> DataFrame:
    """Per document the text with surrogates and the number of entities of each kind."""

    def number(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint").alias(f"n_{kind}")

    replaced = _replaced(docs.select("doc_id", "text"), key, "text")
    kinds = replaced.select("doc_id", "text", F.transform("_found", kind_of).alias("kinds"))
    return kinds.select("doc_id", "text", *map(number, KINDS))
