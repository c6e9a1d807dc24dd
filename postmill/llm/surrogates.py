"""Surrogates for personal data, with DataFrame functions only.

Entities are found by one pattern, once; the text is split at it, each entity is replaced, and the parts are joined again.
The canonical form of an entity makes its different spellings agree (coreference). Names found behind a title are replaced
where they stand alone in the same text, too.

Numbers, addresses, keys and e-mails get a keyed permutation of their own shape (a Feistel network over the characters, each
within its class, conjugated with a step so that nothing maps to itself): phone numbers keep country code and punctuation, card
numbers their first digit and check sum, private addresses their network, account numbers country and check digits, secrets
their alphabet. So two entities of a shape never share a surrogate, however full the shape is. Names get made-up words of their
script and gender, chosen by a keyed hash.

Collision checks: an entity whose surrogate is an entity of the corpus, or another's surrogate, gets the next attempt, checked
against all entities and all surrogates given out. Names grow with the attempts, so their rounds end; the others give up after
ROUNDS attempts and keep the permutation's value, which is distinct: a shape whose values are all in use is permuted in itself.
Only entities with a later attempt are joined to the texts again; the others are computed in place.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.shared import discard, materialize

#: the Spark setting that holds the secret
KEY_SETTING = "spark.postmill.surrogates.key"
#: for public test tables: what the registered queries use where the setting is missing
EXAMPLE_KEY = "a key for public test tables"
ROUNDS, STEPS, LONGEST = 6, 4, 64
#: fixed values: titles before a name, by gender
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Г-н", "господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Г-жа", "госпожа", "Κυρία")
EITHER = ("Dr", "Prof", "Professor")
UPPER = ("MR", "MRS", "MS", "MISS", "DR", "PROF")
NAME = r"\p{Lu}[\p{L}'’-]+"
#: by its first character, a match of most kinds begins at a word's start; what can't match there fails at once
PATTERN = (
    r"(?<=password=)[^\s\"',;]{4,}|(?<=token = \")[^\"\s]{8,}(?=\")|(?<=(?:password: |api_key=|api_key: ))(?=\S*\d)[^\s\"',;]{6,}|(?<=Bearer )[\w.~+/-]{16,}|(?<=(?:ssn|SSN) )\d{9}(?!\w)|(?<![\w])(?:"
    + "|".join(
        [
            r"AKIA[0-9A-Z]{16}(?!\w)",
            r"[A-Z]{2}\d{2}(?:(?: [0-9A-Z]{4}){3,7}(?: [0-9A-Z]{1,3})?|[0-9A-Z]{11,30})(?!\w)",
            r"(?<![.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
            r"(?=\d)(?:(?<![.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)|(?<![.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\w)|(?<!-)\d{3}-\d{2}-\d{4}(?![\w-]))",
            r"(?=[0-9A-Fa-f]{1,4}:)(?<![:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
            r"(?=[+\d(])(?:(?<![+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![.-])0\d{2,4} \d{3,4} \d{4}(?![\w-]))",
            rf"(?<![\p{{L}}])(?=[MHSDFPГгΚ])(?:(?:{'|'.join(MALE + FEMALE + EITHER + UPPER)})\.? {NAME}(?: {NAME}){{0,2}}|(?:Mr|Mrs|Ms|Dr)\. \p{{Ll}}{{3,}}(?![\p{{L}}]))",
        ]
    )
    + ")"
)
#: fixed values: syllables of made-up names by script
SYLLABLES = {
    "latin": ("ba", "do", "fe", "gi", "ka", "lo", "me", "ni", "pa", "ro", "se", "ti", "va", "zo", "ru", "li"),
    "cyrillic": ("ба", "до", "фе", "ги", "ка", "ло", "ме", "ни", "па", "ро", "се", "ти", "ва", "зо", "ру", "ли"),
    "greek": ("βα", "δο", "φε", "γι", "κα", "λο", "με", "νι", "πα", "ρο", "σε", "τι", "θα", "ζο", "ρυ", "λι"),
}
ENDINGS = {"latin": ("n", "na", "ner", "l"), "cyrillic": ("н", "на", "нов", "л"), "greek": ("ς", "να", "δης", "λ")}
NAMES = ("given_man", "given_woman", "given_any", "surname")


def kind(e: Column) -> Column:
    digits = F.length(F.regexp_replace(e, r"\D", ""))
    return (
        F.when(e.contains("@"), "email")
        .when(e.rlike(rf"^(?:{'|'.join((*MALE, 'MR'))})\.? "), "man")
        .when(e.rlike(rf"^(?:{'|'.join((*FEMALE, 'MRS', 'MS', 'MISS'))})\.? "), "woman")
        .when(e.rlike(rf"^(?:{'|'.join((*EITHER, 'DR', 'PROF'))})\.? "), "any")
        .when(e.rlike(r"^(\d{1,3}\.){3}\d{1,3}$"), "ip")
        .when(e.rlike(r"^([0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"), "ip6")
        .when(e.rlike(r"^(?:\d{3}-\d{2}-\d{4}|\d{9})$"), "ssn")
        .when(e.rlike(r"^[\d -]+$") & (digits >= 13), "card")
        .when(e.rlike(r"^[+(\d][\d ().-]*[ ().-][\d ().-]*$|^\+\d+$"), "phone")
        .when(e.rlike(r"^[A-Z]{2}\d{2}(?:(?: [0-9A-Z]{4}){3,7}(?: [0-9A-Z]{1,3})?|[0-9A-Z]{11,30})$"), "iban")
        .otherwise("secret")
    )


def _country(e: Column) -> Column:
    return F.regexp_extract(e, r"^\+?(\d{1,3})(?=[ .-]?\()|^\+(\d{1,3}?)(?=[ .-])", 0)


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def atoms(e: Column) -> Column:
    """The parts of an entity that are replaced: array of (kind, canon). A name has one per word, all others one."""
    def parts(k: Column) -> Column:
        digits = F.regexp_replace(e, r"\D", "")
        country = F.regexp_replace(_country(e), r"\D", "")
        canon = (
            F.when(k.isin("email", "ip6"), F.lower(e))
            .when(k.isin("card", "ssn"), digits)
            .when(k == "ip", F.array_join(F.transform(F.split(e, "[.]"), lambda x: x.cast("int").cast("string")), "."))
            .when(k == "iban", F.replace(e, F.lit(" "), F.lit("")))
            .when(k == "phone", F.concat(country, F.lit("|"), F.substr(digits, F.length(country) + 1)))
            .otherwise(e)
        )
        words = F.split(F.regexp_replace(e, r"^\S+ ", ""), " ")
        names = F.transform(words, lambda w, i: F.struct(F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given_"), k)).alias("kind"), F.lower(w).alias("canon")))
        return F.when(k.isin("man", "woman", "any"), names).otherwise(F.array(F.struct(k.alias("kind"), canon.alias("canon"))))

    return _let(kind(e), parts)


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts).cast("binary"), 256)


def _number(h: Column, i: Column) -> Column:
    """One of fifteen numbers of 16 bits of a hash."""
    return F.conv(F.substr(h, F.pmod(i, F.lit(15)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _part(c: Column, base: Column, v: Column, m: Column) -> Column:
    return F.struct(c.alias("c"), base.cast("int").alias("b"), v.cast("int").alias("v"), m.cast("int").alias("m"))


def _letters(s: Column, hexed: Column) -> Column:
    """The characters of s, each with its place in its class and the size of the class; other signs are alone in theirs."""
    def one(c: Column) -> Column:
        code = F.ascii(c)
        return (
            F.when(c.rlike("^[0-9]"), _part(c, F.lit(48), code - 48, F.lit(10)))
            .when(hexed & c.rlike("^[a-f]"), _part(c, F.lit(97), code - 97, F.lit(6)))
            .when(c.rlike("^[a-z]"), _part(c, F.lit(97), code - 97, F.lit(26)))
            .when(c.rlike("^[A-Z]"), _part(c, F.lit(65), code - 65, F.lit(26)))
            .when(c.rlike(r"^[\p{L}\p{N}]"), _part(c, F.lit(97), F.pmod(code, F.lit(26)), F.lit(26)))
            .otherwise(_part(c, F.lit(0), F.lit(0), F.lit(1)))
        )

    return F.transform(F.filter(F.split(s, ""), lambda c: c != ""), one)


def _written(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.when(p["m"] == 1, p["c"]).otherwise(F.char(p["b"] + p["v"]))), "")


def _permuted(parts: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the parts of a shape: STEPS rounds, a step of the first place, and the rounds undone.

    In a round, places of one parity move by a hash of the others, so the rounds can be undone; since the step leaves no value
    in place, neither does the whole.
    """
    rounds = F.array(*[F.lit(r) for r in [*range(STEPS), STEPS, *range(STEPS - 1, -1, -1)]])
    plan = F.transform(rounds, lambda r, i: F.struct(r.alias("r"), F.when(i < STEPS, 1).otherwise(-1).alias("sign")))

    def turn(state: Column, step: Column) -> Column:
        parity = step["r"] % 2
        others = F.array_join(F.transform(state, lambda p, i: F.when(i % 2 == parity, "").otherwise(p["v"].cast("string"))), ",")
        moved = _let(
            _hash(key, tweak, step["r"].cast("string"), others),
            lambda h: F.transform(state, lambda p, i: p.withField("v", F.when(i % 2 == parity, F.pmod(p["v"] + step["sign"] * _number(h, i), p["m"])).otherwise(p["v"]))),
        )
        first = F.transform(state, lambda p, i: p.withField("v", F.when(i == 0, F.pmod(p["v"] + 1, p["m"])).otherwise(p["v"])))
        return F.when(step["r"] == STEPS, first).otherwise(moved)

    def whole(all_: Column) -> Column:
        kept = F.filter(all_, lambda p: p["m"] > 1)
        new = F.aggregate(plan, kept, turn)
        return _let(new, lambda y: F.transform(all_, lambda p, i: F.when(p["m"] == 1, p).otherwise(F.get(y, F.size(F.filter(F.slice(all_, F.lit(1), i + 1), lambda q: q["m"] > 1)) - 1))))

    return _let(parts, whole)


def _shifted(parts: Column, key: str, tweak: Column, value: Column) -> Column:
    """For long values: each part moves by a stream that the whole value gives, in one pass."""
    return _let(_hash(key, tweak, value), lambda h: F.transform(parts, lambda p, i: p.withField("v", F.pmod(p["v"] + _number(h, i) + F.when(i == 0, 1).otherwise(0), p["m"]))))


def _text(s: Column, key: str, tweak: Column, hexed: Column | None = None) -> Column:
    """Another string of the shape of s."""
    parts = _letters(s, F.lit(False) if hexed is None else hexed)
    return F.when(F.length(s) <= LONGEST, _written(_permuted(parts, key, tweak))).otherwise(_written(_shifted(parts, key, tweak, s)))


def _luhn(digits: Column) -> Column:
    """The check sum modulo 10, the last digit included."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def _mod97(account: Column) -> Column:
    """The remainder of an account number whose country and check digits stand at the end, letters as 10 to 35."""
    def add(total: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (total * 100 + code - 55) % 97).otherwise((total * 10 + code - 48) % 97)

    return F.aggregate(F.filter(F.split(account, ""), lambda c: c != ""), F.lit(0), add)


def _iban(canon: Column, key: str, tweak: Column) -> Column:
    """Country kept, account permuted; the check digits are valid if the original's are, else as they were."""
    def of(account: Column) -> Column:
        right = F.lpad((98 - _mod97(F.concat(account, F.substr(canon, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
        valid = _mod97(F.concat(F.substr(canon, F.lit(5)), F.substr(canon, F.lit(1), F.lit(4)))) == 1
        return F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.when(valid, right).otherwise(F.substr(canon, F.lit(3), F.lit(2))), account)

    return _let(_text(F.substr(canon, F.lit(5)), key, tweak), of)


#: fixed values: ranges of the first number of an address that stay among themselves
OCTETS = ((1, 9), (11, 99), (100, 126), (128, 171), (173, 191), (193, 223))


def _ip(canon: Column, key: str, tweak: Column) -> Column:
    """Private networks keep their prefix; each number stays in its range."""
    def one(x: Column, i: Column) -> Column:
        v = x.cast("int")
        fixed = _part(x, F.lit(0), v, F.lit(1))
        plain = F.when(v < 256, _part(x, F.lit(0), v, F.lit(256))).otherwise(_part(x, F.lit(256), v - 256, F.lit(744)))
        first = F.coalesce(*[F.when(v.between(a, b), _part(x, F.lit(a), v - a, F.lit(b - a + 1))) for a, b in OCTETS], fixed)
        return F.when((i == 0), first).when((i == 1) & canon.startswith("192.168."), fixed).otherwise(plain)

    numbers = _permuted(F.transform(F.split(canon, "[.]"), one), key, tweak)
    return F.array_join(F.transform(numbers, lambda p: F.when(p["m"] == 1, p["c"]).otherwise((p["b"] + p["v"]).cast("string"))), ".")


def _phone(canon: Column, key: str, tweak: Column) -> Column:
    """The country code stays; the first digit stays among 2 to 9, or among 0 and 1."""
    country, rest = F.regexp_extract(canon, r"^(\d*)\|", 1), F.regexp_extract(canon, r"\|(\d*)$", 1)

    def one(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when((i == 0) & (v >= 2), _part(c, F.lit(50), v - 2, F.lit(8))).when(i == 0, _part(c, F.lit(48), v, F.lit(2))).otherwise(_part(c, F.lit(48), v, F.lit(10)))

    digits = F.transform(F.filter(F.split(rest, ""), lambda c: c != ""), one)
    return F.concat(country, F.lit("|"), _written(_permuted(digits, key, F.concat_ws("|", tweak, country))))


def _name(canon: Column, key: str, k: Column, attempt: Column) -> Column:
    script = F.when(canon.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(canon.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")

    def made(h: Column) -> Column:
        n = F.least(2 + F.conv(F.substr(h, F.lit(64), F.lit(1)), 16, 10).cast("int") % 2 + attempt, F.lit(62))

        def of(name: str) -> Column:
            table = F.array(*map(F.lit, SYLLABLES[name]))
            stem = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(table, F.conv(F.substr(h, i, F.lit(1)), 16, 10).cast("int") + 1)), "")
            man, woman, surname, either = ENDINGS[name]
            return F.concat(stem, F.when(k == "given_man", man).when(k == "given_woman", woman).when(k == "given_any", either).otherwise(surname))

        return F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin"))

    return _let(_hash(key, k, canon, attempt.cast("string")), made)


def surrogate(key: str, k: Column, canon: Column, attempt: Column) -> Column:
    """The replacement of a canonical form, as a canonical form."""
    tweak = F.concat_ws("|", k, attempt.cast("string"))
    # from the third attempt on, texts grow by digits
    more = F.when(attempt > 2, F.translate(F.substr(_hash(key, k, canon, attempt.cast("string")), F.lit(1), attempt - 2), "abcdef", "357148")).otherwise("")
    local, domain, top = F.regexp_extract(canon, "^(.*)@", 1), F.regexp_extract(canon, "@(.*)[.]", 1), F.regexp_extract(canon, "([^.]*)$", 1)
    # a domain has one surrogate, whatever the attempt of the address
    email = F.concat(_text(local, key, F.concat_ws("|", tweak, domain, top)), more, F.lit("@"), _text(domain, key, F.lit("domain")), F.lit("."), top)
    residue = F.concat_ws("|", tweak, F.substr(canon, F.lit(1), F.lit(1)), _luhn(canon).cast("string"))
    card = _let(
        F.concat(F.substr(canon, F.lit(1), F.lit(1)), _text(F.substr(canon, F.lit(2), F.length(canon) - 2), key, residue)),
        # the last digit that gives the original's check sum
        lambda middle: F.concat(middle, ((_luhn(canon) + 10 - _luhn(F.concat(middle, F.lit("0")))) % 10).cast("string")),
    )
    secret = F.when(canon.startswith("AKIA"), F.concat(F.lit("AKIA"), _text(F.substr(canon, F.lit(5)), key, tweak))).otherwise(F.concat(_text(canon, key, tweak, canon.rlike("^[0-9a-f]+$")), more))
    return (
        F.when(k == "email", email).when(k == "card", card).when(k == "ip", _ip(canon, key, tweak)).when(k == "phone", _phone(canon, key, tweak)).when(k == "iban", _iban(canon, key, tweak))
        .when(k == "ssn", _text(canon, key, tweak)).when(k == "ip6", _text(canon, key, tweak, F.lit(True))).when(k == "secret", secret)
        .otherwise(_name(canon, key, k, attempt))
    )


def _filled(e: Column, signs: Column, sign: str) -> Column:
    """e with its characters of a class replaced by the given ones, in turn."""
    def one(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(e, F.lit(1), i + 1), f"[^{sign}]", ""))
        return F.when(c.rlike(f"[{sign}]"), F.substr(signs, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(e, ""), lambda c: c != ""), one), "")


def _cased(word: Column, new: Column) -> Column:
    return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(new)).when(word == F.lower(word), new).otherwise(F.initcap(new))


def _named(k: Column, canon: Column) -> Column:
    return F.concat_ws("\x1f", k, canon)


def _replaced(key: str, e: Column, attempts: Column | None) -> Column:
    """Of an entity: (text: its replacement in its own format, names: of a name, (word, replacement) of its words of three letters or more).

    attempts: map from kind and canon to attempt, for those above 0.
    """
    def of(a: Column) -> Column:
        found = F.lit(0) if attempts is None else F.coalesce(F.try_element_at(attempts, _named(a["kind"], a["canon"])), F.lit(0))
        return surrogate(key, a["kind"], a["canon"], found)

    def built(k: Column) -> Column:
        def written(new: Column) -> Column:
            words = F.split(F.regexp_replace(e, r"^\S+ ", ""), " ")
            pairs = F.zip_with(words, new, lambda w, n: F.struct(w.alias("word"), _cased(w, n).alias("new")))
            name = F.concat_ws(" ", F.regexp_extract(e, r"^(\S+) ", 1), F.array_join(F.transform(pairs, lambda p: p["new"]), " "))
            plain = F.when(k.isin("card", "ssn", "phone"), _filled(e, F.regexp_replace(F.get(new, F.lit(0)), r"\|", ""), "0-9")).when(k == "iban", _filled(e, F.get(new, F.lit(0)), "0-9A-Z")).otherwise(F.get(new, F.lit(0)))
            is_name = k.isin("man", "woman", "any")
            return F.struct(F.when(is_name, name).otherwise(plain).alias("text"), F.when(is_name, F.filter(pairs, lambda p: F.length(p["word"]) >= 3)).otherwise(F.filter(pairs, lambda p: F.lit(False))).alias("names"))

        return _let(F.transform(atoms(e), of), written)

    return _let(kind(e), built)


def _alone(gap: Column, names: Column) -> Column:
    """The text between entities with bare mentions of the names replaced: first by marks, so that no replacement is replaced."""
    def mark(i: Column) -> Column:
        return F.concat(F.lit("\ue000"), i.cast("string"), F.lit("\ue001"))

    numbered = F.transform(names, lambda n, i: F.struct(n["word"].alias("word"), n["new"].alias("new"), mark(i).alias("mark")))
    marked = F.aggregate(numbered, gap, lambda t, n: F.when(t.contains(n["word"]), F.regexp_replace(t, F.concat(F.lit("(?<![\\p{L}\\p{N}\ue000])\\Q"), n["word"], F.lit("\\E(?![\\p{L}\\p{N}])")), n["mark"])).otherwise(t))
    return F.aggregate(numbered, marked, lambda t, n: F.replace(t, n["mark"], n["new"]))


def later_attempts(entities: DataFrame, key: str) -> DataFrame | None:
    """kind, canon, attempt of the entities (kind, canon; distinct) whose first surrogate won't do; None if there are none."""
    value = lambda n: surrogate(key, F.col("kind"), F.col("canon"), F.lit(n))
    state = materialize(entities.withColumn("value", value(0)), "entities")
    least = F.min("canon").alias("keeper")
    clash = state.groupBy("kind", "value").agg(least, F.count(F.lit(1)).alias("n")).where("n > 1").select("kind", "value", "keeper")
    shared = state.join(clash, ["kind", "value"]).where("canon <> keeper").select("kind", "canon")
    own = state.select("kind", F.col("canon").alias("value"))
    taken = state.join(own, ["kind", "value"], "left_semi").select("kind", "canon")
    open_ = materialize(shared.unionByName(taken).distinct(), "open")
    used = state.select("kind", "value").unionByName(own)
    late, attempt = [], 0
    while not open_.isEmpty():
        attempt += 1
        free = open_.withColumn("value", value(attempt)).join(used, ["kind", "value"], "left_anti")
        won = materialize(free.groupBy("kind", "value").agg(F.min("canon").alias("canon")).select("kind", "canon", "value"), "won")
        late.append(won.select("kind", "canon", F.lit(attempt).alias("attempt")))
        used = used.unionByName(won.select("kind", "value"))
        rest = open_.join(won, ["kind", "canon"], "left_anti")
        before, open_ = open_, materialize(rest if attempt < ROUNDS else rest.where(F.col("kind").isin(*NAMES)), "open")
        discard(before)
    if not late:
        return None
    out = late[0]
    for more in late[1:]:
        out = out.unionByName(more)
    return None if out.isEmpty() else out


def stated_key(spark, otherwise: str | None = None) -> str:
    """The secret of KEY_SETTING; where it is unset, the one given, or an error."""
    key = spark.conf.get(KEY_SETTING, None) or otherwise
    if not key:
        raise ValueError(f"set {KEY_SETTING} to the secret of the surrogates")
    return key


def derived(key: str) -> str:
    """What stands in plans, event logs and tasks instead of the secret."""
    return hmac.new(key.encode(), b"surrogates of personal data", hashlib.sha256).hexdigest()


def replace_entities(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with the entities of `text` replaced, and n_entities (int).

    All columns stay in place. A null text stays null with 0 entities, an empty one empty; ids are not read, so null and
    repeated ones are fine; repeated rows get equal texts, and one entity has one surrogate in all rows. Extra columns pass
    through, but for one named n_entities, which the count replaces. `key` is the secret: another key gives other
    surrogates, the same key the same ones in each run; it comes from stated_key() if not given. Plans hold a key derived from it. The rows are written once to the shared folder with their entities. Very long
    texts are one row like any other; of entities that want one surrogate the first by its canonical form keeps it; an empty table stays empty.
    """
    key = derived(key or stated_key(docs.sparkSession))
    found = F.when(F.col("text").rlike(PATTERN), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    marked = materialize(docs.select(F.struct("*").alias("_row"), found.alias("_pii")), "marked")
    text, some = F.col("_row.text"), marked.where("_pii IS NOT NULL")
    each = some.select(F.explode(F.array_distinct("_pii")).alias("e")).select(F.explode(atoms(F.col("e"))).alias("a")).select("a.kind", "a.canon")
    late, attempts = later_attempts(each.distinct(), key), None
    if late is not None:
        # rows of one text have one map, whatever their ids
        some = some.withColumns({"_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit("second"), text)})
        keys = some.select("_h1", "_h2", F.explode(F.flatten(F.transform("_pii", lambda e: F.transform(atoms(e), lambda a: _named(a["kind"], a["canon"]))))).alias("_name"))
        of_text = keys.distinct().join(late.select(_named(F.col("kind"), F.col("canon")).alias("_name"), "attempt"), "_name").groupBy("_h1", "_h2").agg(F.map_from_entries(F.collect_set(F.struct("_name", "attempt"))).alias("_late"))
        some = some.join(of_text, ["_h1", "_h2"], "left")
        attempts = F.coalesce(F.col("_late"), F.create_map().cast("map<string,int>"))
    some = some.withColumn("_new", F.transform("_pii", lambda e: _replaced(key, e, attempts)))
    names = F.flatten(F.transform("_new", lambda n: n["names"]))
    cases = F.flatten(F.transform(names, lambda n: F.array(n, F.struct(F.upper(n["word"]).alias("word"), F.upper(n["new"]).alias("new")), F.struct(F.initcap(n["word"]).alias("word"), F.initcap(n["new"]).alias("new")))))
    # longer words first, so that none is met inside another
    some = some.withColumn("_names", F.reverse(F.array_sort(F.array_distinct(F.transform(cases, lambda n: F.struct(F.length(n["word"]).alias("n"), n["word"].alias("word"), n["new"].alias("new")))))))
    gaps = F.split(text, PATTERN, -1)
    bare = F.when(F.size("_names") == 0, gaps).otherwise(F.transform(gaps, lambda g: _alone(g, F.col("_names"))))
    new = F.concat(F.transform("_new", lambda n: n["text"]), F.array(F.lit("")))
    replaced = F.array_join(F.zip_with(bare, new, lambda a, b: F.concat(a, b)), "")

    def shown(rows: DataFrame, text: Column, count: Column) -> DataFrame:
        columns = [text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns if c != "n_entities"]
        return rows.select(*columns, count.alias("n_entities"))

    return shown(marked.where("_pii IS NULL"), text, F.lit(0)).unionByName(shown(some, replaced, F.size("_pii")))
