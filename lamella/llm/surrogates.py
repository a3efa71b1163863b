"""Personal data and secrets replaced by keyed surrogates, with built-in functions only.

One pattern finds the entities of a text. An entity's canonical form (digits of a number, lower case of an
address or a name) and a key give, through SHA-256, a surrogate of the same type and format: digits become
digits, letters letters of their case and script, IPv4 octets octets, a card number that passes the Luhn
check another that does, a name another name of the gender that its title tells. The same entity gets the
same surrogate wherever it stands, so the corpus keeps its coreference; a name that stands with a title somewhere in
a text is replaced in it without one too, whole or by its last word.

Distinct entities must stay distinct: all canonical forms of the corpus are collected (one row each, however
often they occur), and those whose surrogate equals another's, or a real entity of the corpus, are derived
again with the next attempt until none collides. Only those exceptions are joined to texts; every other
surrogate is a function of the entity alone, so texts are rewritten where they are read, without a shuffle.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_ROWS, stored
from .order_minhash import let

KEY = "surrogate-key-1"
ATTEMPTS = 12
#: Rounds after which what still collides is an error.
ROUNDS = 100
#: Exceptions up to so many are a literal of the plan; more are joined.
LITERAL_ROWS = 1000

# Titles by gender, name lists.
MALE_TITLES = "Mr|Herr|Señor|Sr|Monsieur|Signor"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Señora|Señorita|Sra|Mme|Madame|Mlle|Signora"
OTHER_TITLES = "Dr|Prof"
MALE = ("Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Henry", "Ivan", "Jonas", "Karim", "Louis", "Marco", "Nils", "Oscar", "Pablo")
FEMALE = ("Anna", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nadia", "Olga", "Paula")
NEUTRAL = ("Alex", "Chris", "Dana", "Eli", "Jean", "Kim", "Lee", "Noel", "Robin", "Sam", "Sascha", "Toni")
SYLLABLES = ("ba", "be", "bo", "da", "den", "do", "fa", "fer", "ga", "gor", "ha", "hel", "ka", "kel", "la", "len", "ma", "mer", "na", "nor", "pa", "pel", "ra", "ros", "sa", "sen", "ta", "tor", "va", "vel", "wa", "win")

# Scripts, their first small and capital letter, and how many follow each other.
SCRIPTS = (
    ("Latin", "à", "À", 22), ("Cyrillic", "а", "А", 32), ("Greek", "α", "Α", 17), ("Armenian", "ա", "Ա", 38), ("Georgian", "ა", "Ა", 33), ("Cherokee", "ꭰ", "Ꭰ", 80),
    ("Hebrew", "א", "א", 27), ("Arabic", "ا", "ا", 20), ("Devanagari", "क", "क", 37), ("Thai", "ก", "ก", 46), ("Hiragana", "か", "か", 60), ("Katakana", "カ", "カ", 60),
    ("Hangul", "가", "가", 11172), ("Han", "一", "一", 20000),
)

#: Patterns by type, in the order in which they are tried at a place.
PATTERNS = {
    "secret": r"""(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)\b["']?(?:=|\s{0,3}[=:]\s{0,3}(?=["']?[\w+/.~-]*\d))["']?)[A-Za-z0-9+/_.~-]{6,}|(?i:\b(?:password|passwd|pwd|api[_-]?key|access[_-]?key)\b["']?\s{0,3}:\s{0,3}["']?)[A-Za-z0-9+/_.~-]{5,}[A-Za-z0-9+/_~-](?=["']?\s{0,3}(?:$|[\n,;}\]]))""",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|\bgh[pousr]_[A-Za-z0-9]{20,}|\bsk-[A-Za-z0-9-]{16,}|\beyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}",
    "email": r"[A-Za-z0-9][\w.%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "ip": r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?![\d]|\.\d)",
    "ip6": r"(?<![\w:])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{4}[ -]){3}\d{1,7}(?!\d)|(?<!\d)\d{13,19}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<!\d)\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|(?<![\d.,/-])0\d{2,4}[ /-]\d{5,9}(?!\d)",
    "name": rf"\b(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.?[ \u00a0]\p{{Lu}}[\p{{L}}'-]+(?:[ \u00a0](?!(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\b)\p{{Lu}}[\p{{L}}'-]+){{0,2}}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity holds; texts without any of it are not searched.
HINT = r"\d\.?\d|@|[=:]|\b(?:AKIA|ASIA|gh[pousr]_|sk-|eyJ)|\b(?:" + f"{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES}" + r")\b"
_NAME_TITLE = rf"^((?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.?[ \u00a0])"
_SECRET_HEAD = r"""^((?i:(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)["']?\s{0,3}[=:]\s{0,3}["']?))"""


def mentions(text: Column) -> Column:
    """The entities of a text: struct<pattern, found array<struct<e, form>>>, in order; none for a null text.

    e is the mention as it stands and form the entity as its type's pattern has it. They differ where a name that has a
    title elsewhere in the text stands without one, whole or by its last word: form adds the title. pattern is what was
    searched: ENTITY and such names.
    """
    own = F.when(F.coalesce(text.rlike(HINT), F.lit(False)), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def named(found: Column) -> Column:
        titled = F.array_distinct(F.filter(found, lambda e: e.rlike(_NAME_TITLE)))

        def with_names(titled: Column) -> Column:
            title = lambda t: F.regexp_extract(t, _NAME_TITLE, 1)
            bare = F.transform(titled, lambda t: F.substring(t, F.length(title(t)) + 1, F.length(t)))
            parts = F.array_distinct(F.flatten(F.transform(bare, lambda n: F.array(n, F.regexp_extract(n, r"[^ \u00a0]+$", 0)))))
            names = F.filter(parts, lambda n: F.length(n) > 2)
            longest = F.transform(F.array_sort(F.transform(names, lambda n: F.struct((-F.length(n)).alias("k"), n.alias("n")))), lambda x: x["n"])
            pattern = F.when(F.size(longest) > 0, F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))).otherwise(F.lit(ENTITY))

            def form(e: Column) -> Column:
                of = F.get(F.filter(titled, lambda t: t.endswith(e) & F.substring(t, F.length(t) - F.length(e), F.lit(1)).isin(" ", "\u00a0")), F.lit(0))
                return F.when(F.array_contains(names, e), F.coalesce(F.concat(title(of), e), e)).otherwise(e)

            return let(pattern, lambda p: F.struct(p.alias("pattern"), F.transform(F.regexp_extract_all(text, p, F.lit(0)), lambda e: F.struct(e.alias("e"), form(e).alias("form"))).alias("found")))

        plain = F.struct(F.lit(ENTITY).alias("pattern"), F.transform(found, lambda e: F.struct(e.alias("e"), e.alias("form"))).alias("found"))
        return let(titled, lambda t: F.when(F.size(t) == 0, plain).otherwise(with_names(t)))

    return let(own, named)


def entities(text: Column) -> Column:
    """The entities of a text as an array of strings, as their types' patterns have them, in order."""
    return F.transform(mentions(text)["found"], lambda x: x["form"])


def type_of(e: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        found = F.when(e.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(found)
    return F.coalesce(found, F.lit("card"))


def _head(kind: Column, e: Column) -> Column:
    """What stands before the entity's value and is kept: `password=`, a title, a key's marker."""
    return (
        F.when(kind == "secret", F.regexp_extract(e, _SECRET_HEAD, 1))
        .when(kind == "key", F.regexp_extract(e, r"^(AKIA|ASIA|gh[pousr]_|sk-|eyJ)", 1))
        .when(kind == "name", F.regexp_extract(e, _NAME_TITLE, 1))
        .when(kind == "iban", F.substring(e, 1, 2))
        .when(kind == "phone", F.regexp_extract(e, r"^(\+\d{1,3}(?=[ .(-])|0(?=\d{2,4}[ /-]))", 1))
        .otherwise(F.lit(""))
    )


def _gender(head: Column) -> Column:
    return F.when(head.rlike(rf"^(?:{MALE_TITLES})\b"), F.lit("m")).when(head.rlike(rf"^(?:{FEMALE_TITLES})\b"), F.lit("f")).otherwise(F.lit("n"))


def canonical(kind: Column, e: Column) -> Column:
    """What two mentions of one entity share: the digits of a number, the lower case of an address, a name's gender and words."""
    head = _head(kind, e)
    body = F.substring(e, F.length(head) + 1, F.length(e))
    return (
        F.when(kind.isin("card", "ssn"), F.regexp_replace(e, r"\D", ""))
        .when(kind == "phone", F.concat(F.regexp_replace(head, r"\D", ""), F.lit("/"), F.regexp_replace(body, r"\D", "")))
        .when(kind == "iban", F.regexp_replace(e, " ", ""))
        .when(kind.isin("email", "ip6"), F.lower(e))
        .when(kind == "name", F.concat(_gender(head), F.lit("/"), F.lower(F.regexp_replace(body, "\u00a0", " "))))
        .otherwise(body)
    )


def _digest(kind: Column, c: Column, attempt: Column, key: str) -> Column:
    """128 hexadecimal digits."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, attempt.cast("string"), c)
    return F.concat(F.sha2(seed.cast("binary"), 256), F.sha2(F.concat(seed, F.lit("\x1f2")).cast("binary"), 256))


def _number(d: Column, i: Column) -> Column:
    """A number below 65536 for place i."""
    at = F.pmod(i * 4 + F.floor(i / 31).cast("int"), F.lit(124)) + 1
    return F.conv(F.substring(d, at, F.lit(4)), 16, 10).cast("int")


def _letter(c: Column, n: Column, low: str, count: int | Column) -> Column:
    return F.char(F.lit(ord(low)) + F.pmod(n, F.lit(count) if isinstance(count, int) else count))


def _of_script(c: Column, n: Column) -> Column:
    """A letter of the script and case of the letter c."""
    at = F.lit(None).cast("struct<first:int,count:int>")
    for script, low, high, count in reversed(SCRIPTS):
        first = F.lit(ord(low)) if low == high else F.when(c.rlike(r"^\p{Lu}$"), ord(high)).otherwise(ord(low))
        at = F.when(c.rlike(rf"^\p{{Is{script}}}$"), F.struct(first.alias("first"), F.lit(count).alias("count"))).otherwise(at)
    letter = let(at, lambda s: F.decode(F.unhex(F.lpad(F.hex(s["first"] + F.pmod(n, s["count"])), 4, "0")), "UTF-16BE"))
    return F.coalesce(letter, c)


def _like(body: Column, d: Column) -> Column:
    """Each character of body replaced by one of its kind: digit, letter (of a to f in hexadecimal values), letter of its script."""

    def one(hexadecimal: Column):
        def put(c: Column, i: Column) -> Column:
            n = _number(d, i)
            letters = F.when(hexadecimal, F.lit(6)).otherwise(F.lit(26))
            out = F.when(c.rlike(r"^\d$"), _letter(c, n, "0", 10)).when(c.rlike("^[a-z]$"), _letter(c, n, "a", letters)).when(c.rlike("^[A-Z]$"), _letter(c, n, "A", letters))
            return out.when(c.rlike(r"^[\p{L}&&[^\x00-\x7F]]$"), _of_script(c, n)).otherwise(c)

        return put

    return let(body.rlike("^[0-9a-f:]+$"), lambda h: F.array_join(F.transform(F.split(body, "(?!^)(?=.)"), one(h)), ""))


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn check, doubled from the second digit on the right."""
    n = F.length(digits)
    values = F.transform(F.split(digits, "(?!^)(?=.)"), lambda c, i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _card(c: Column, fresh: Column) -> Column:
    """fresh with a last digit that keeps the remainder of c's Luhn sum, so valid numbers give valid ones."""
    last = F.pmod(F.substring(fresh, F.length(fresh), F.lit(1)).cast("int") + _luhn(c) - _luhn(fresh), F.lit(10))
    return F.concat(F.substring(fresh, F.lit(1), F.length(fresh) - 1), last.cast("string"))


def _octets(c: Column, d: Column, wide: Column) -> Column:
    def one(o: Column, i: Column) -> Column:
        n = _number(d, i)
        return F.when(wide, F.pmod(n, F.lit(155)) + 100).when(F.length(o) == 1, F.pmod(n, F.lit(9)) + 1).when(F.length(o) == 2, F.pmod(n, F.lit(90)) + 10).otherwise(F.pmod(n, F.lit(155)) + 100).cast("string")

    return F.array_join(F.transform(F.split(c, r"\."), one), ".")


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(n, F.lit(len(values))) + 1)


def _name(c: Column, attempt: Column, key: str) -> Column:
    """A name of as many words as c (gender/words), word by word, so that mentions with and without a given name share
    the last one: given names by gender, a last name of syllables; letter by letter in other scripts. Later attempts
    change the given name first."""
    gender, body = F.substring(c, 1, 1), F.substring(c, F.lit(3), F.length(c))
    latin = body.rlike(r"^[\p{IsLatin}' -]+$")

    def of(words: Column) -> Column:
        def word(w: Column, i: Column) -> Column:
            last = i == F.size(words) - 1
            turn = F.when(last & (F.size(words) > 1), F.floor(attempt / 4)).otherwise(attempt).cast("int")

            def put(d: Column) -> Column:
                n = _number(d, F.lit(0))
                given = F.when(gender == "m", _pick(MALE, n)).when(gender == "f", _pick(FEMALE, n)).otherwise(_pick(NEUTRAL, n))
                surname = F.concat(*[_pick(SYLLABLES, _number(d, F.lit(j))) for j in range(1, 5)])
                return F.when(~latin, _like(w, d)).otherwise(F.lower(F.when(last, surname).otherwise(given)))

            return let(_digest(F.when(last, F.lit("surname")).otherwise(F.concat(F.lit("given"), gender)), w, turn, key), put)

        return F.array_join(F.transform(words, word), " ")

    return F.concat(gender, F.lit("/"), let(F.split(body, " "), of))


def surrogate(kind: Column, c: Column, attempt: Column, key: str) -> Column:
    """The canonical form of the surrogate of a canonical form."""

    def of(d: Column) -> Column:
        slash = F.instr(c, "/")
        wide = attempt >= ATTEMPTS
        more = F.when(wide, F.translate(F.substring(d, 101, 8), "0123456789", "ghijklmnop")).otherwise(F.lit(""))
        domain = r"\.[a-z]+$"
        body = F.when(kind == "email", F.regexp_replace(c, domain, "")).when(kind == "phone", F.substring(c, slash + 1, F.length(c))).when(kind == "iban", F.substring(c, F.lit(3), F.length(c))).otherwise(c)

        def whole(fresh: Column) -> Column:
            return (
                F.when(kind == "card", _card(c, fresh))
                .when(kind == "ip", _octets(c, d, wide))
                .when(kind == "name", _name(c, attempt, key))
                .when(kind == "email", F.concat(more, fresh, F.regexp_extract(c, domain, 0)))
                .when(kind == "phone", F.concat(F.substring(c, F.lit(1), slash), fresh))
                .when(kind == "iban", F.concat(F.substring(c, 1, 2), fresh))
                .otherwise(fresh)
            )

        return let(F.when(kind.isin("ip", "name"), F.lit("")).otherwise(_like(body, d)), whole)

    return let(_digest(kind, c, attempt, key), of)


def rendered(kind: Column, e: Column, s: Column) -> Column:
    """The surrogate s (canonical) in the format of the mention e: its separators, spaces, case, title."""
    head = _head(kind, e)

    def digits(value: Column) -> Column:
        """The next digit of value at each digit (or letter, in IBANs) of e."""
        chars = F.split(e, "(?!^)(?=.)")
        return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("^[0-9A-Za-z]$"), F.substring(value, F.size(F.filter(F.slice(chars, F.lit(1), i), lambda b: b.rlike("^[0-9A-Za-z]$"))) + 1, F.lit(1))).otherwise(c)), "")

    def cased(value: Column) -> Column:
        """value with capitals where e has them."""
        return F.array_join(F.zip_with(F.split(e, "(?!^)(?=.)"), F.split(value, "(?!^)(?=.)"), lambda a, b: F.when(a.rlike(r"^\p{Lu}$"), F.upper(b)).otherwise(b)), "")

    name = F.substring(s, F.lit(3), F.length(s))
    body = F.substring(e, F.length(head) + 1, F.length(e))
    return (
        F.when(kind.isin("card", "ssn", "iban"), digits(s))
        .when(kind == "phone", digits(F.regexp_replace(s, "/", "")))
        .when(kind.isin("email", "ip6"), cased(s))
        .when(kind == "name", F.concat(head, F.when(body == F.upper(body), F.upper(name)).otherwise(F.initcap(name))))
        .otherwise(F.concat(head, s))
    )


def _replaced(text: Column, found: Column, each) -> Column:
    """text with its mentions (of mentions(text)) replaced: each(form) stands for the form, less the title that the form adds."""

    def one(x: Column) -> Column:
        put = each(x["form"])
        return F.when(x["form"] == x["e"], put).otherwise(let(put, lambda r: F.substring(r, F.length(x["form"]) - F.length(x["e"]) + 1, F.length(r))))

    def joined(parts: Column) -> Column:
        return F.array_join(F.zip_with(parts, F.transform(found["found"], one), lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")

    return F.when(F.size(found["found"]) == 0, text).otherwise(let(F.split(text, found["pattern"], -1), joined))


def _replacement(e: Column, key: str, special: Column | None = None) -> Column:
    """What stands for the entity e: its surrogate of the first attempt, or the one that the map `special` has for it."""

    def of(kind: Column, c: Column) -> Column:
        first = surrogate(kind, c, F.lit(0), key)
        return first if special is None else F.coalesce(F.try_element_at(special, F.concat_ws("\x1f", kind, c)), first)

    return let(type_of(e), lambda kind: let(canonical(kind, e), lambda c: rendered(kind, e, of(kind, c))))


def exceptions(found: DataFrame, key: str) -> DataFrame:
    """found(kind, c), the distinct entities -> (kind, c, s) of those whose first surrogate collides, with one that does not.

    Of several entities with one surrogate the least keeps it. A surrogate may not be a real entity of the corpus, its own included.
    """
    named = stored(found.withColumn("attempt", F.lit(0)).withColumn("s", surrogate(F.col("kind"), F.col("c"), F.lit(0), key)), "entities")
    real = named.select("kind", F.col("c").alias("s")).withColumn("real", F.lit(True))
    for attempt in itertools.count(1):
        owner = named.groupBy("kind", "s").agg(F.min(F.struct("attempt", "c")).alias("owner"))
        judged = named.join(owner, ["kind", "s"]).join(real, ["kind", "s"], "left")
        bad = F.coalesce("real", F.lit(False)) | (F.col("c") != F.col("owner.c"))
        judged = stored(judged.select("kind", "c", "attempt", "s", bad.alias("bad")), "judged")
        if judged.where("bad").isEmpty():
            break
        if attempt > ROUNDS:
            raise ValueError(f"entities without a surrogate of their own: {judged.where('bad').groupBy('kind').count().collect()}")
        again = surrogate(F.col("kind"), F.col("c"), F.lit(attempt), key)
        named = stored(judged.select("kind", "c", F.when(F.col("bad"), F.lit(attempt)).otherwise(F.col("attempt")).alias("attempt"), F.when(F.col("bad"), again).otherwise(F.col("s")).alias("s")), "entities")
    return named.where("attempt > 0").select("kind", "c", "s")


def anonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """docs with the entities of `text` replaced, and n_entities, their number; all other columns as they are.

    Null and empty texts stay as they are, with no entities. Repeated rows are rewritten alike. An empty table gives no
    rows. A column that is called n_entities is replaced.
    """
    docs = docs.drop("n_entities")
    each = docs.select(F.explode(F.array_distinct(entities(F.col("text")))).alias("e")).distinct()
    each = each.withColumn("kind", type_of(F.col("e")))
    odd = stored(exceptions(each.select("kind", canonical(F.col("kind"), F.col("e")).alias("c")).distinct(), key), "exceptions")
    rest = [c for c in docs.columns if c != "text"]

    def rewritten(rows: DataFrame, each) -> DataFrame:
        # The explode of one element keeps the optimiser from searching the text again for every use of the entities.
        once = rows.withColumn("_lamella_found", F.explode(F.array(mentions(F.col("text")))))
        return once.select(*[_replaced(F.col("text"), F.col("_lamella_found"), each).alias("text") if c == "text" else F.col(c) for c in docs.columns], F.size("_lamella_found.found").alias("n_entities"))

    n = odd.limit(BROADCAST_ROWS + 1).count()
    if n <= LITERAL_ROWS:
        known = {f"{r['kind']}\x1f{r['c']}": r["s"] for r in odd.collect()}
        special = F.from_json(F.lit(json.dumps(known)), "map<string,string>") if known else None
        return rewritten(docs, lambda e: _replacement(e, key, special))
    # Texts that mention an exception take their surrogates from a join; all others need none.
    tagged = docs.withColumn("_lamella_row", F.struct(F.monotonically_increasing_id(), F.xxhash64("text")))
    tagged = stored(tagged, "tagged")
    told = tagged.select("_lamella_row", F.explode(F.array_distinct(entities(F.col("text")))).alias("e")).withColumn("kind", type_of(F.col("e")))
    told = told.withColumn("c", canonical(F.col("kind"), F.col("e"))).join(F.broadcast(odd) if n <= BROADCAST_ROWS else odd, ["kind", "c"])
    special = told.groupBy("_lamella_row").agg(F.map_from_entries(F.collect_list(F.struct("e", rendered(F.col("kind"), F.col("e"), F.col("s"))))).alias("_lamella_special"))
    joined = tagged.join(special, "_lamella_row", "left")
    plain = rewritten(joined.where("_lamella_special is null").select(*docs.columns), lambda e: _replacement(e, key))
    once = joined.where("_lamella_special is not null").withColumn("_lamella_found", F.explode(F.array(mentions(F.col("text")))))
    other = once.select(*[_replaced(F.col("text"), F.col("_lamella_found"), lambda e: F.coalesce(F.element_at("_lamella_special", e), _replacement(e, key))).alias("text") if c == "text" else F.col(c) for c in docs.columns], F.size("_lamella_found.found").alias("n_entities"))
    return plain.unionByName(other.select(*rest, "text", "n_entities").select(*plain.columns))


def anonymised_documents(docs: DataFrame, key: str = KEY) -> DataFrame:
    """docs with the entities of their texts replaced; the same columns, n_chars (if there is one) following the text."""
    out = anonymised(docs, key)
    return out.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
