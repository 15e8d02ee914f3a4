"""Surrogates for personal data, in DataFrame expressions alone.

Detected kinds: e-mail addresses, phone numbers, payment cards, IPv4 and IPv6 addresses, bank accounts (IBAN), US social security
numbers, and names behind a title; the README names what is not detected. Every distinct entity gets one surrogate, drawn with a secret key, in all texts
(coreference), and no two entities of a kind share one (distinctness):

* Numbers keep their signs: every digit becomes another digit, brackets, blanks and what stands before the last ten digits of a phone number stay, a card keeps its first digit and
  gets a valid check digit, an IBAN valid ones, a reserved IPv4 address stays in its range while that has room. Addresses stay under reserved example domains.
* A name keeps its title, and so its gender, its script (Latin, Cyrillic, Greek, Han, Kana, Arabic), its number of parts and its case.

A surrogate is a function of (key, kind, entity, attempt). The distinct entities are drawn at once; those that meet another entity's
surrogate or an entity that occurs in the corpus draw again, and the smallest in order keeps the one that several drew, until no collision is left.
Names get one more syllable with every ``GROWS`` attempts, so there are enough for any number of entities.

Texts are cut at the matches and joined again; only the matches are moved to count them, and texts are shuffled only if they hold one.

Defined cases: null texts stay null, empty ones empty; repeated rows are all replaced alike; a text without an entity comes out as it is;
very long texts take time in proportion to their length, whatever they hold;
equal entities in different writing (case of an address, signs of a number, zeros of an IPv6 address) are one entity and keep their writing.
"""

from __future__ import annotations

from functools import reduce
from secrets import token_hex

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.session import materialize

#: The setting that holds the secret key of the registered query; unset, every run draws a key of its own.
KEY_SETTING = "spark.propensity.surrogate.key"
#: Kinds by their patterns, in the order in which they are tried at a place.
PATTERNS = {
    # possessive parts, tried at the start of a dotted run only: linear, and without recursion in the matcher
    "email": r"(?<![A-Za-z0-9_%+-])(?<![A-Za-z0-9_%+-]\.)[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+@(?:[A-Za-z0-9-]{1,63}+\.){1,10}[A-Za-z]{2,63}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ipv6": r"(?<![0-9A-Fa-f:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![0-9A-Fa-f:])"
    r"|(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{0,45}[0-9A-Fa-f]{3})(?=[A-Fa-f:]{0,45}[0-9])(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,5})?(?![0-9A-Za-z:]|\.[0-9])",
    "ipv4": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[0-9]{3}(?: [0-9]{6} [0-9]{4,5}|-[0-9]{6}-[0-9]{4,5}))(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+]|[0-9][.-])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
    r"|\+(?=(?:[ .()-]{0,2}[0-9]){8})[1-9][0-9]{0,2}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,4}|[ .-][0-9]){2,6}"
    r"|0[1-9](?:[ .-][0-9]{2}){4}|0[0-9]{2,4}[ /-][0-9]{5,8})(?![0-9A-Za-z]|[.-][0-9])",
}
#: Titles by gender.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof", "Mx"),
}
#: Syllables by script, and the endings of a first name by gender.
SYLLABLES = {
    "latin": "ba be di do fa ga ha jo ka le li ma mi na ne no pa ra ri ro sa se ta ti to va vi wa ya ze zo lu",
    "cyrillic": "ба ве га да ди ка ла ле ли ма ми на ни но па ра ри ро са се та ти то фа ва ви за зо лу мо ру ду",
    "greek": "βα γα δα δι ζω θε κα κο λα λε λι μα μι να νε νι πα πε ρα ρι ρο σα σε τα τι το φα φι χα χι λυ μο",
    "han": "安 白 成 德 方 光 国 海 和 华 建 江 金 康 乐 林 明 宁 平 青 山 世 天 文 新 信 学 永 玉 元 正 志",
    "kana": "あ い う え お か き く け こ さ し す せ た ち つ と な に の は ひ ふ ま み む も や ゆ ら り",
    "arabic": "با بي دا دي را ري سا سي فا في كا كي لا لي ما مي نا ني ها هي وا وي يا زا زي طا عا قا شا جا حا خا",
}
GROWS = 2
ENDINGS = {"latin": ("n", "na", "l"), "cyrillic": ("н", "на", "й"), "greek": ("ς", "να", "ν"), "han": ("军", "美", "文"), "kana": ("お", "こ", "み"), "arabic": ("د", "ة", "ر")}
SCRIPTS = {
    "cyrillic": r"^\p{IsCyrillic}",
    "greek": r"^\p{IsGreek}",
    "han": r"^\p{IsHan}",
    "kana": r"^[\p{IsHiragana}\p{IsKatakana}]",
    "arabic": r"^\p{IsArabic}",
}


def _name_pattern() -> str:
    titles = "|".join(sorted((t for group in TITLES.values() for t in group), key=len, reverse=True))
    part = r"(?:\p{Lu}[\p{L}\p{M}'’-]+|[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]{1,4}|\p{IsArabic}{2,})"
    return rf"(?<!\p{{L}})(?:{titles})\.? {part}(?: {part}){{0,2}}"


def pattern() -> str:
    """All kinds in one pattern; the back reference of the card counts from its own group."""
    kinds = [p.replace(r"([ -]?)", r"(?<cut>[ -]?)").replace(r"\1", r"\k<cut>") for p in PATTERNS.values()]
    return "|".join(f"(?:{p})" for p in [*kinds, _name_pattern()])


def _kind(match: Column) -> Column:
    kind = F.when(match.contains("@"), "email")
    for name, p in list(PATTERNS.items())[1:]:
        kind = kind.when(match.rlike(rf"^(?:{p})$"), name)
    return kind.otherwise("name")


_PUNCTUATION = r"[^\p{L}\p{N}]"


def _full_ipv6(address: Column) -> Column:
    """All eight groups of four digits, in lower case."""
    ends = F.split(F.lower(address), "::")
    left, right = (F.filter(F.split(F.coalesce(F.get(ends, i), F.lit("")), ":"), lambda g: g != "") for i in (0, 1))
    groups = F.concat(left, F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right)), right)
    return F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ":")


def canonical(kind: Column, match: Column) -> Column:
    """What two writings of one entity share: letters in lower case and digits, for a name its parts without the title."""
    address = F.when(kind == "ipv6", _full_ipv6(match)).otherwise(F.lower(match))
    name = _plain_name(F.regexp_replace(match, r"^\S+ ", ""))
    return F.when(kind.isin("email", "ipv4", "ipv6"), address).when(kind == "name", name).otherwise(F.lower(F.regexp_replace(match, _PUNCTUATION, "")))


def _plain_name(name: Column) -> Column:
    """Letters in lower case, the parts kept apart: Ann Lee is not An Nlee."""
    return F.lower(F.regexp_replace(name, r"[^\p{L}\p{N} ]", ""))


def _draws(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """192 keyed hexadecimal digits (nested digests, so the key can't be extended)."""
    inner = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, entity, attempt.cast("string")), 256)
    return F.concat(*[F.sha2(F.concat(F.lit(key), F.lit(f"\u0002{i}"), inner), 256) for i in range(3)])


def _number(draws: Column, at: Column | int, modulus: int) -> Column:
    """A number below ``modulus`` from four digits of the draws, other ones for each of 47 places."""
    at = at if isinstance(at, Column) else F.lit(at)
    return F.conv(F.substr(draws, (at % 47 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int") % modulus


def _digits(entity: Column, draws: Column, keep: Column | int) -> Column:
    """The entity's digits replaced, but for the first ``keep``; other characters as they are."""
    keep = keep if isinstance(keep, Column) else F.lit(keep)
    signs = F.split(entity, "")
    return F.array_join(
        F.transform(
            signs,
            lambda c, i: F.when((i < keep) | ~c.rlike("^[0-9a-z]$"), c)
            .when(c.rlike("[0-9]"), _number(draws, i, 10).cast("string"))
            .otherwise(F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), _number(draws, i, 26) + 1, F.lit(1))),
        ),
        "",
    )


def _with_check_digit(number: Column) -> Column:
    """The number with its last digit set so that the Luhn sum is a multiple of ten."""
    body = F.reverse(F.split(F.substr(number, F.lit(1), F.length(number) - 1), ""))
    doubled = F.transform(body, lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))
    return F.concat(F.substr(number, F.lit(1), F.length(number) - 1), ((F.lit(10) - total % 10) % 10).cast("string"))


def _with_iban_check(account: Column) -> Column:
    """The account with the check digits that make it 1 modulo 97, letters counting from a = 10."""
    country, rest = F.substr(account, F.lit(1), F.lit(2)), F.substr(account, F.lit(5))
    value = lambda c: F.conv(c, 36, 10).cast("int")
    left = F.aggregate(F.split(F.concat(rest, country, F.lit("00")), ""), F.lit(0), lambda a, c: F.pmod(a * F.when(value(c) > 9, 100).otherwise(10) + value(c), F.lit(97)))
    return F.concat(country, F.lpad((F.lit(98) - left).cast("string"), 2, "0"), rest)


def _octets(entity: Column, draws: Column, attempt: Column) -> Column:
    """Another IPv4 address: of the same reserved range while that has room (by attempts), else one that is in none."""
    old = F.split(entity, r"\.")
    first, second = F.get(old, 0).cast("int"), F.get(old, 1).cast("int")
    new = [_number(draws, i, 256) for i in range(4)]
    public = F.pmod(new[0], F.lit(222)) + 1
    public = F.when(public.isin(10, 127, 169, 172, 192), public + 1).otherwise(public)
    ten = F.array(F.lit(10), *new[1:])
    kept = (
        F.when(first.isin(10, 127), F.array(first, *new[1:]))
        .when(((first == 192) & (second == 168)) | ((first == 169) & (second == 254)), F.when(attempt < 8, F.array(first, second, *new[2:])).otherwise(ten))
        .when((first == 172) & second.between(16, 31), F.when(attempt < 8, F.array(first, F.pmod(new[1], F.lit(16)) + 16, *new[2:])).otherwise(ten))
    )
    return F.array_join(F.when(attempt < 16, F.coalesce(kept, F.array(public, *new[1:]))).otherwise(F.array(public, *new[1:])).cast("array<string>"), ".")


def _syllables(script: str, draws: Column, at: Column, ending: Column | None, attempt: Column) -> Column:
    names = F.split(F.lit(SYLLABLES[script]), " ")
    count = 2 if script in ("han", "kana", "arabic") else 3
    parts = [F.element_at(names, _number(draws, at * 5 + j, 32) + 1) for j in range(count)]
    # later ones draw from a digest of their own
    more = F.transform(
        F.slice(F.sequence(F.lit(0), F.floor(attempt / GROWS).cast("int")), 2, 1 << 20),
        lambda k: F.element_at(names, _number(F.sha2(F.concat_ws("\u0003", draws, at.cast("string"), k.cast("string")), 256), 0, 32) + 1),
    )
    return F.concat(*parts, F.array_join(more, ""), *([] if ending is None else [ending]))


def _script(part: Column) -> Column:
    return reduce(lambda c, x: F.when(part.rlike(SCRIPTS[x]), x).otherwise(c), SCRIPTS, F.lit("latin"))


def _name(parts: Column, gender: Column, draws: Column, attempt: Column) -> Column:
    """As many parts as the name has, in the script of each; the first of several carries the gender's ending."""

    def one(part: Column, i: Column) -> Column:
        chosen = F.lit(None).cast("string")
        for script, (m, f, n) in ENDINGS.items():
            ending = F.when(F.size(parts) == 1, "").when(i > 0, "").when(gender == "m", m).when(gender == "f", f).otherwise(n)
            chosen = F.when(_script(part) == script, _syllables(script, draws, i, ending, attempt)).otherwise(chosen)
        return chosen

    return F.array_join(F.transform(parts, one), " ")


def surrogate(key: str, kind: Column, entity: Column, gender: Column, parts: Column, attempt: Column) -> Column:
    """The canonical surrogate of a canonical entity."""
    draws = _draws(key, kind, entity, attempt)
    octets = _octets(entity, draws, attempt)
    email = F.concat(F.lit("user"), F.substr(draws, F.lit(1), F.lit(12)), F.lit("@example."), F.element_at(F.array(F.lit("com"), F.lit("org"), F.lit("net")), _number(draws, 9, 3) + 1))
    return (
        F.when(kind == "email", email)
        .when(kind == "ipv4", octets)
        .when(kind == "ipv6", F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[F.substr(draws, F.lit(1 + 4 * i), F.lit(4)) for i in range(6)])))
        .when(kind == "card", _with_check_digit(_digits(entity, draws, 1)))
        .when(kind == "iban", _with_iban_check(_digits(entity, draws, 2)))
        .when(kind == "name", _name(parts, gender, draws, attempt))
        .otherwise(_digits(entity, draws, F.when(F.length(entity) > 10, F.length(entity) - 10).otherwise(0)))
    )


def _in_form(kind: Column, match: Column, made: Column) -> Column:
    """The canonical surrogate in the writing of the match: its signs, its title, its case."""
    signs = F.split(match, "")
    order = F.transform(signs, lambda c, i: F.when(c.rlike(r"[\p{L}\p{N}]"), 1).otherwise(0))
    place = F.transform(order, lambda x, i: F.aggregate(F.slice(order, F.lit(1), i + 1), F.lit(0), lambda a, y: a + y))
    poured = F.array_join(
        F.transform(
            signs,
            lambda c, i: F.when(F.get(order, i) == 0, c)
            .when(c.rlike(r"\p{Lu}"), F.upper(F.substr(made, F.get(place, i), F.lit(1))))
            .otherwise(F.substr(made, F.get(place, i), F.lit(1))),
        ),
        "",
    )
    bare = F.regexp_replace(match, r"^\S+ ", "")
    cased = F.when((bare == F.upper(bare)) & (bare != F.lower(bare)), F.upper(made)).otherwise(F.initcap(made))
    named = F.concat(F.regexp_extract(match, r"^(\S+ )", 1), cased)
    return F.when(kind == "name", named).when(kind.isin("email", "ipv4", "ipv6"), made).otherwise(poured)


def entities(mentions: DataFrame) -> DataFrame:
    """(kind, entity, gender, parts): the distinct entities of ``mentions`` (match)."""
    kind = _kind(F.col("match"))
    title = F.regexp_extract("match", r"^([^\s.]+)", 1)
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("n")
    rows = mentions.withColumn("kind", kind).withColumn("entity", canonical(F.col("kind"), F.col("match")))
    parts = F.split(F.regexp_replace("match", r"^\S+ ", ""), " ")
    rows = rows.withColumn("gender", F.when(F.col("kind") == "name", gender)).withColumn("parts", F.when(F.col("kind") == "name", parts))
    # a name with a gendered title somewhere has that gender, else none
    return rows.groupBy("kind", "entity").agg(
        F.coalesce(F.min(F.when(F.col("gender") != "n", F.col("gender"))), F.lit("n")).alias("gender"), F.min("parts").alias("parts")
    )


def distinct_surrogates(known: DataFrame, key: str) -> DataFrame:
    """(kind, entity, made): a surrogate for each of ``known``, none drawn twice and none an entity itself."""
    known = materialize(known)
    plain = known.select("kind", F.col("entity").alias("taken")).distinct()
    made = surrogate(key, F.col("kind"), F.col("entity"), F.col("gender"), F.col("parts"), F.col("attempt"))
    drawn = materialize(known.withColumn("attempt", F.lit(0)).withColumn("made", made))
    while True:
        mark = F.when(F.col("kind") == "name", _plain_name(F.col("made"))).when(F.col("kind") == "ipv6", _full_ipv6(F.col("made"))).otherwise(F.lower("made"))
        marked = drawn.withColumn("mark", mark)
        # who drew first keeps it: the earliest attempt, then the smallest entity
        owner = marked.groupBy("kind", "mark").agg(F.min(F.struct("attempt", "entity")).alias("owner"), F.count("*").alias("drew"))
        clash = (
            owner.join(plain.withColumnRenamed("taken", "mark").withColumn("real", F.lit(True)), ["kind", "mark"], "left")
            .where(F.col("real") | (F.col("drew") > 1))
            .select("kind", "mark", F.when(F.col("real").isNull(), F.col("owner.entity")).alias("keeper"))
        )
        if clash.isEmpty():
            return drawn.select("kind", "entity", "made")
        loses = F.col("hit") & ~F.col("entity").eqNullSafe(F.col("keeper"))
        again = marked.join(clash.withColumn("hit", F.lit(True)), ["kind", "mark"], "left").withColumn("again", F.coalesce(loses, F.lit(False)))
        drawn = materialize(
            again.withColumn("attempt", F.col("attempt") + F.col("again").cast("int"))
            .withColumn("made", F.when(F.col("again"), made).otherwise(F.col("made")))
            .select("kind", "entity", "gender", "parts", "attempt", "made")
        )


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` (columns kept) with ``text`` replaced and ``n_entities``, ``kinds`` (the kinds of the replaced entities in order)."""
    own = docs.columns
    found = F.coalesce(F.regexp_extract_all(F.col(text), F.lit(pattern()), F.lit(0)), F.array().cast("array<string>"))
    numbered = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), found.alias("found"), F.monotonically_increasing_id().alias("uid")))
    with_any = numbered.where(F.size("found") > 0)
    mentions = with_any.select("uid", F.posexplode("found").alias("at", "match"))
    forms = materialize(mentions.select("match").distinct())
    table = distinct_surrogates(entities(forms), key)
    kinds = forms.withColumn("kind", _kind(F.col("match"))).withColumn("entity", canonical(F.col("kind"), F.col("match")))
    replaced = kinds.join(table, ["kind", "entity"]).select("match", "kind", _in_form(F.col("kind"), F.col("match"), F.col("made")).alias("new"))
    lists = mentions.join(replaced, "match").groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("at", "new", "kind"))).alias("made"))
    pieces = F.split(F.col(f"row.{text}"), pattern(), -1)
    woven = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(F.col("made"), i)["new"], F.lit("")))), "")
    changed = with_any.join(lists, "uid").select("row", woven.alias("new_text"), F.col("made.kind").alias("kinds"))
    same = numbered.where(F.size("found") == 0).select("row", F.col(f"row.{text}").alias("new_text"), F.array().cast("array<string>").alias("kinds"))
    columns = [F.col("new_text").alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in own if c not in ("n_entities", "kinds")]
    return changed.unionByName(same).select(*columns, F.size("kinds").alias("n_entities"), "kinds")


def op2_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    key = spark.conf.get(KEY_SETTING, None) or token_hex(32)
    return pseudonymised(docs, key).select("doc_id", "text", "n_entities", "kinds")
