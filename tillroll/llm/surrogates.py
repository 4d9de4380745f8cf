"""Personal data replaced by surrogates: keyed, of the same kind and format, and consistent.

Entities are e-mail addresses, phone numbers, IP addresses, card numbers, social
security numbers, bank account numbers and names of persons. A name is the run of
capitalised words, initials and particles after forms of address ("Prof. Dr.") or
words of introduction ("my name is"); its last word is the surname, unless it is
the only one after an introduction. Every other place of the same text that holds
one of these words, capitalised, is a mention of that person.

Each distinct entity of the corpus gets one surrogate, derived from a key and the
entity by SHA-256, so the same entity is the same surrogate in all documents
(coreference), whatever its spelling: numbers are told apart by their digits,
addresses and names without regard to case. Names are mapped by part, so a
surname alone and with a given name stay the same person's.

Surrogates keep kind and format: digits stay digits and separators stay in
place, letters keep case and script, e-mail addresses keep their last label,
phone numbers their country code, card and account numbers are valid exactly if
the original is, given names keep the gender that the form of address tells.
Initials move in their alphabet by a keyed step, which keeps them distinct;
particles ("von") stay.

Collision checks: a surrogate that another entity of the kind has got, or that
is itself an entity of the corpus, is drawn again with the next attempt number
until all are distinct. Names get longer with the attempts, and mail addresses
whose form is too full get letters in front. Phone and social security numbers
of a form that is full to an eighth are matched with its free values instead;
a form without enough free values is an error.

Everything is columns and joins. Only documents with entities are shuffled, by
the hash of their text; a text that many documents share is worked on once, and
the join that brings it back to them is one the adaptive planner can split.
Mentions are found by a join of a text's words with its names, so a text of many
names costs what it is long.

Defined results: null and empty texts and texts without entities stay as they
are; repeated rows are masked alike; an empty table gives an empty result; other
columns are kept, whatever their names, ``n_chars`` is set anew where the text
changed, a column ``n_entities`` is replaced; texts are read whole.
``n_entities`` counts replaced values, mentions included and initials not.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillroll.llm.common import materialize, table, whole_text

KEY = "set a key of your own"
# From this attempt on a mail address gets longer.
WIDER = 8
# Cards, accounts and IP addresses keep their form; so many clashes in a row mean that it is full.
ROUNDS = 200
# Entities whose surrogates one task draws, while there are enough tasks.
ROWS_A_TASK = 5_000

# --- detection ------------------------------------------------------------------------

# Forms of address, by what they tell.
MALE = "Mr|Mister|Sir|Herr|Señor|Sr|Monsieur|Signor|г-н|господин|κύριος|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Señorita|Sra|Madame|Mme|Mlle|Signora|г-жа|госпожа|κυρία|Κυρία"
EITHER = "Mx|Dr|Prof|Doctor|Professor|Dra"
INTRODUCED = "My name is|my name is|Mein Name ist|mein Name ist|Ich heiße|ich heiße|Je m'appelle|je m'appelle|Me llamo|me llamo|Меня зовут|меня зовут|Με λένε|με λένε"
PARTICLES = "von der|von dem|von|van der|van den|van|zu|de la|de los|de|del|della|di|da|dos|du|la|le|ten|ter|bin|al"
# Capitalised words that begin a sentence and are no part of a name.
OPENERS = "He|She|It|The|They|We|You|And|But|In|On|At|An|As|If|His|Her|This|That|Er|Sie|Es|Der|Die|Das|Il|Elle|El|Ella|Он|Она"
_FORMS = f"{MALE}|{FEMALE}|{EITHER}|{INTRODUCED}"
_HEAD = rf"(?:(?:{_FORMS})\.? )"
_WORD = r"(?:\p{Lu}\p{L}{1,40}+|\p{Lu}['’]\p{Lu}\p{L}{1,40}+)(?:-\p{Lu}\p{L}{1,40}+)*+"
_NAME = rf"(?!(?:{OPENERS}|{_FORMS})(?!\p{{L}})){_WORD}"
# What follows is no more of the word, nor the rest of a mail address.
_WORD_ENDS = r"(?![\p{L}\p{N}]|[\p{L}\p{N}._%+-]{0,255}+@)"
_HEX = "[0-9A-Fa-f]{1,4}"

# Each starts with a test of one character, so that most places cost little; what stands before is looked at then.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-](?<![\p{L}\p{N}._%+-]{2})[\p{L}\p{N}._%+-]{0,255}+@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){1,8}",
    "iban": r"[A-Z](?<![\p{L}\p{N}][A-Z])[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|(?<![\p{L}\p{N}])\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{3,4}|(?<![\p{L}\p{N}.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
    # National numbers with spaces: groups of 3, 3 and 4, five pairs, an area and one block.
    r"|(?<![\p{L}\p{N}.-])(?<![0-9] )(?:[0-9]{3} [0-9]{3} [0-9]{4}|0[0-9](?: [0-9]{2}){4}|0[1-9][0-9]{1,3}[ /-][0-9]{5,8})(?! ?[0-9]))(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])",
    "ipv6": rf"(?=[A-Fa-f:]{{0,39}}+[0-9])(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:[0-9A-Fa-f]{{3,4}}|{_HEX}(?::{_HEX}){{1,6}})::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\p{{L}}\p{{N}}:])",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_HEAD}{{1,3}}(?:(?:(?:{PARTICLES})|\p{{Lu}}\.|{_NAME}) ){{0,5}}{_NAME}{_WORD_ENDS}",
}
_STARTS = "".join(sorted({f[0] for f in _FORMS.split("|")}))
_NUMBERS = "|".join(f"(?:{PATTERNS[k]})" for k in ("ssn", "ip", "phone", "card"))
ENTITY = f"(?:{PATTERNS['email']})|(?:{PATTERNS['iban']})|(?:{PATTERNS['ipv6']})|(?=[0-9+(])(?:{_NUMBERS})|(?=[{_STARTS}])(?:{PATTERNS['name']})"
MENTION = rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}]){_WORD}{_WORD_ENDS}"
# Every entity holds a digit, an at sign, or a form of address: a quick look at a text.
HINT = rf"[0-9@]|(?=[{_STARTS}])(?:{_FORMS})\.? \p{{L}}"
NAME_KINDS = ("surname", "given", "given_m", "given_f")


def holds_entity(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(HINT) & F.col(text).rlike(ENTITY), F.lit(False))


def _kind(value: Column) -> Column:
    """The kind of a match: ``person`` for a whole name, ``mention`` for a word that may be one."""

    # Phone numbers that stand alone: with a code, an area in brackets, or the groups of a country.
    phone = value.rlike(r"^(?:\+|\(|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$|0[0-9](?: [0-9]{2}){4}$|0[1-9][0-9]{1,3}[ /-][0-9]{5,8}$)")
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^\p{L}{2}[0-9]{2}[ A-Z0-9]"), "iban")
        .when(value.contains(":"), "ipv6")
        .when(value.rlike(r"^\p{L}"), F.when(value.contains(" "), "person").otherwise("mention"))
        .when(value.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(value.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
        .when(phone, "phone")
        .otherwise("card")
    )


def _initial(value: Column, key: str) -> Column:
    """The initial some keyed steps on in its alphabet, so different ones stay different."""
    for alphabet in (_LATIN.upper(), _CYRILLIC.upper(), _GREEK.upper()):
        step = 1 + int(hashlib.sha256(f"{key}\0initial".encode()).hexdigest(), 16) % (len(alphabet) - 1)
        value = F.translate(value, alphabet, alphabet[step:] + alphabet[:step])
    return value


def _parts(gap: Column, value: Column, key: str) -> Column:
    """A name as entries of its words; those without a kind stay as they are given."""
    head = F.regexp_extract(value, rf"^{_HEAD}{{1,3}}", 0)
    words = F.split(F.substr(value, F.length(head) + 1, F.length(value)), " ")

    def addressed(by: str) -> Column:
        return head.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{by})\.? ")

    given = F.when(addressed(MALE), "given_m").when(addressed(FEMALE), "given_f").otherwise("given")

    def entry(word: Column, i: Column) -> Column:
        alone = (F.size(words) == 1) & addressed(INTRODUCED)
        kind = F.when(~word.rlike(r"^\p{Lu}[\p{L}'’]"), F.lit(None)).when((i + 1 == F.size(words)) & ~alone, "surname").otherwise(given)
        said = F.when(word.rlike(r"^\p{Lu}\.$"), _initial(word, key)).otherwise(word)
        return _entry(F.when(i == 0, F.concat(gap, head)).otherwise(" "), said, kind)

    return F.transform(words, entry)


def _entry(gap: Column, value: Column, kind: Column) -> Column:
    return F.struct(gap.alias("gap"), value.alias("value"), kind.alias("kind"), _norm(kind, value).alias("norm"))


def _norm(kind: Column, value: Column) -> Column:
    """What tells entities of a kind apart."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.concat(F.regexp_extract(value, r"^(\+[0-9]{1,3}(?=[ .(-])|)", 1), F.lit("/"), digits))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "ip", value)
        .when(kind.isNotNull(), F.lower(value))
    )


def with_entities(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """Rows that have entities: ``_row``, ``_text_id``, ``_found`` (gap before, value, kind, norm) in order and ``_tail``.

    Where a word of a name stands elsewhere in the text too, all capitalised
    words are entries of the kind ``mention``.
    """
    hit = docs.filter(holds_entity(text)).select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    names = F.regexp_extract_all("_text", F.lit(rf"(?=[{_STARTS}])(?:{PATTERNS['name']})"), F.lit(0))
    named = hit.withColumn("_names", names)
    words = F.flatten(F.transform("_names", lambda n: F.split(F.regexp_replace(n, rf"^{_HEAD}{{1,3}}", ""), " ")))
    # The text without its names, so that a name's own words are no mentions.
    rest = F.regexp_replace("_text", ENTITY, " ")
    others = F.transform(F.regexp_extract_all(rest, F.lit(MENTION), F.lit(0)), F.lower)
    again = F.when(F.size("_names") > 0, F.size(F.array_intersect(F.transform(words, F.lower), others)) > 0).otherwise(F.lit(False))
    pattern = F.when(F.col("_again"), F.lit(f"{ENTITY}|{MENTION}")).otherwise(F.lit(ENTITY))
    cut = named.withColumn("_again", again).withColumns(
        {"_gaps": F.split("_text", pattern, -1), "_values": F.regexp_extract_all("_text", pattern, F.lit(0))}
    )

    def entries(value: Column, i: Column) -> Column:
        gap, kind = F.element_at("_gaps", i + 1), _kind(value)
        return F.when(kind == "person", _parts(gap, value, key)).otherwise(F.array(_entry(gap, value, kind)))

    found = F.flatten(F.transform("_values", entries))
    return cut.select("_row", F.sha2(whole_text("_text"), 256).alias("_text_id"), found.alias("_found"), F.element_at("_gaps", -1).alias("_tail"))


# --- surrogates ---------------------------------------------------------------------------

# Alphabets of the scripts that keep theirs, and names and syllables to draw from.
_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
GIVEN = {
    ("given_m", "latin"): "adam bruno carl daniel erik felix george henry ivan jonas karl leon martin nils oscar paul".split(),
    ("given_f", "latin"): "anna bella clara diana elena flora greta helen irene julia karin laura maria nina olivia paula".split(),
    ("given", "latin"): "alex robin sam kim charlie jamie morgan taylor casey riley jordan quinn".split(),
    ("given_m", "cyrillic"): "антон борис виктор глеб денис игорь кирилл леонид максим олег павел роман".split(),
    ("given_f", "cyrillic"): "алла вера галина дарья елена зоя ирина лидия марина нина ольга софия".split(),
    ("given", "cyrillic"): "саша женя валя шура".split(),
    ("given_m", "greek"): "αλέξης γιώργος δημήτρης κώστας μάρκος νίκος πέτρος στέφανος".split(),
    ("given_f", "greek"): "άννα δήμητρα ελένη κατερίνα μαρία νίκη σοφία χριστίνα".split(),
    ("given", "greek"): "αλέξις χρύσα".split(),
}
SYLLABLES = {
    "latin": "bar den fol gar hal jor kel lun mar nor pel ras sol tam ver wil zan ber cor dal".split(),
    "cyrillic": "бар вел гор дар зел кар лун мар нов пет раз сол тан фил хар чер".split(),
    "greek": "βαρ γελ δαμ καλ λαμ μαν νικ παλ ραδ σαλ ταν φιλ".split(),
}
_ENDS = {
    ("surname", "latin"): "sen er man ton ley".split(),
    ("surname", "cyrillic"): "ко енко ых ич".split(),
    ("surname", "greek"): "ίδης άκης όπουλος".split(),
    ("given_m", "latin"): "o us an".split(),
    ("given_f", "latin"): "a ia ina".split(),
    ("given", "latin"): "i ey e".split(),
    ("given_m", "cyrillic"): "ий ей".split(),
    ("given_f", "cyrillic"): "а ия".split(),
    ("given", "cyrillic"): "и ю".split(),
    ("given_m", "greek"): "ος ης".split(),
    ("given_f", "greek"): "α η".split(),
    ("given", "greek"): "ι ω".split(),
}


def _number(h: Column, i: Column) -> Column:
    """The i-th number, 0 to 4095, of a hexadecimal hash."""
    return F.conv(F.substr(h, (i * 3) % 61 + 1, F.lit(3)), 16, 10).cast("int")


def _nth(values: list[str], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), n % len(values) + 1)


def _letter(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def _each(value: Column, change) -> Column:
    """``change(character, place from 1)`` of each character, joined."""
    places = F.sequence(F.lit(1), F.length(value))
    return F.array_join(F.transform(places, lambda i: change(F.substr(value, i, F.lit(1)), i)), "")


def _shaped(c: Column, n: Column) -> Column:
    """A character of the same class, case and script."""
    return (
        F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
        .when(c.rlike(r"\p{IsCyrillic}"), F.when(c == F.upper(c), F.upper(_letter(_CYRILLIC, n))).otherwise(_letter(_CYRILLIC, n)))
        .when(c.rlike(r"\p{IsGreek}"), F.when(c == F.upper(c), F.upper(_letter(_GREEK, n))).otherwise(_letter(_GREEK, n)))
        .when(c.rlike(r"\p{Lu}"), F.upper(_letter(_LATIN, n)))
        .when(c.rlike(r"\p{L}"), _letter(_LATIN, n))
        .otherwise(c)
    )


def luhn(digits: Column) -> Column:
    """The digit that makes ``digits`` and it valid."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def mod97(account: Column) -> Column:
    """Remainder of an account number, written with its first four characters last."""
    turned = F.concat(F.substr(account, F.lit(5), F.length(account)), F.substr(account, F.lit(1), F.lit(4)))

    def add(acc: Column, i: Column) -> Column:
        c = F.substr(turned, i, F.lit(1))
        letter = F.instr(F.lit(_LATIN.upper()), c) + 9
        return F.when(c.rlike("[0-9]"), (acc * 10 + c.try_cast("int")) % 97).otherwise((acc * 100 + letter) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _email(norm: Column, h: Column) -> Column:
    last = F.length(norm) - F.length(F.substring_index(norm, ".", -1))
    return _each(norm, lambda c, i: F.when(i > last, c).otherwise(_shaped(c, _number(h, i))))


def _letters(n: Column, h: Column) -> Column:
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: _letter(_LATIN, _number(h, i + 30))), "")


def _digits(norm: Column, h: Column, kept: Column) -> Column:
    return _each(norm, lambda c, i: F.when(i <= kept, c).otherwise((_number(h, i) % 10).cast("string")))


def _card(norm: Column, h: Column) -> Column:
    drawn = _digits(F.substr(norm, F.lit(1), F.length(norm) - 1), h, F.lit(0))
    valid = luhn(F.substr(norm, F.lit(1), F.length(norm) - 1)) == F.substr(norm, F.length(norm), F.lit(1))
    off = 1 + _number(h, F.lit(20)) % 9
    check = luhn(drawn)
    return F.concat(drawn, F.when(valid, check).otherwise(((check.cast("int") + off) % 10).cast("string")))


def _iban(norm: Column, h: Column) -> Column:
    country = F.substr(norm, F.lit(1), F.lit(2))
    rest = _each(F.substr(norm, F.lit(5), F.length(norm)), lambda c, i: _shaped(c, _number(h, i)))
    right = F.lpad((98 - mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
    valid = mod97(norm) == 1
    wrong = F.lpad(((right.cast("int") + 1 + _number(h, F.lit(20)) % 90) % 100).cast("string"), 2, "0")
    return F.concat(country, F.when(valid, right).otherwise(wrong), rest)


def _ip(norm: Column, h: Column) -> Column:
    return F.array_join(F.transform(F.split(norm, r"\."), lambda _, i: (_number(h, i) % 254 + 1).cast("string")), ".")


def _ipv6(norm: Column, h: Column) -> Column:
    return _each(norm, lambda c, i: F.when(c == ":", c).otherwise(_letter("0123456789abcdef", _number(h, i))))


def _made_name(kind: str, script: str, h: Column, syllables: Column) -> Column:
    places = F.sequence(F.lit(0), syllables - 1)
    parts = F.array_join(F.transform(places, lambda i: _nth(SYLLABLES[script], _number(h, i))), "")
    return F.concat(parts, _nth(_ENDS[kind, script], _number(h, F.lit(9))))


def _named(kind: str, norm: Column, h: Column, attempt: Column) -> Column:
    """A name from the list at first, then ever longer ones made of syllables."""
    out = F.lit(None).cast("string")
    for script in SYLLABLES:
        made = _made_name(kind, script, h, F.when(attempt < 4, 2).otherwise(attempt))
        if kind != "surname":
            made = F.when(attempt == 0, _nth(GIVEN[kind, script], _number(h, F.lit(0)))).otherwise(made)
        out = F.when(_script(norm) == script, made).otherwise(out)
    return out


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    h = F.sha2(F.concat_ws("\u0000", F.lit(key), kind, norm, attempt.cast("string")), 256)
    code = F.length(F.substring_index(norm, "/", 1)) - 1
    phone_digits = F.substring_index(norm, "/", -1)
    phone = F.concat(F.substring_index(norm, "/", 1), F.lit("/"), _digits(phone_digits, h, code))
    out = F.when(kind == "email", F.concat(_letters(attempt - (WIDER - 1), h), _email(norm, h))).when(kind == "phone", phone).when(kind == "card", _card(norm, h))
    out = out.when(kind == "iban", _iban(norm, h)).when(kind == "ip", _ip(norm, h)).when(kind == "ipv6", _ipv6(norm, h)).when(kind == "ssn", _digits(norm, h, F.lit(0)))
    for name in NAME_KINDS:
        out = out.when(kind == name, _named(name, norm, h, attempt))
    return out


_FORM = ["kind", "head", "n_digits"]


def _with_form(entities: DataFrame) -> DataFrame:
    """Phone and social security numbers with what their surrogates keep, and how many digits are drawn."""
    phone = F.col("kind") == "phone"
    head = F.when(phone, F.substring_index("norm", "/", 1)).otherwise("")
    digits = F.when(phone, F.substring_index("norm", "/", -1)).otherwise(F.col("norm"))
    fixed = entities.filter(F.col("kind").isin("phone", "ssn")).select("kind", "norm", head.alias("head"), F.length(digits).alias("n_digits"))
    return fixed.withColumn("drawn", F.col("n_digits") - F.greatest(F.length("head") - 1, F.lit(0)))


def _matched(entities: DataFrame, key: str) -> DataFrame | None:
    """kind, norm and surrogate of the numbers whose form is full to an eighth or more; none if no form is."""
    formed = _with_form(entities)
    # More free digits than a long holds: no corpus fills such a form.
    pool = F.pow(F.lit(10.0), F.least(F.col("drawn"), F.lit(18))).cast("bigint")
    counted = formed.groupBy(*_FORM, "drawn").agg(F.count(F.lit(1)).alias("n")).withColumn("pool", pool)
    full = materialize(counted.filter(F.col("n") * 8 > F.col("pool")), "full-forms")
    if full.isEmpty():
        return None
    # The originals are taken too.
    over = full.filter(F.col("n") * 2 > F.col("pool")).take(5)
    if over:
        said = "; ".join(f"{r.kind} {r['head']!r} with {r.n_digits} digits: {r.n} entities, {r.pool - r.n} free values" for r in over)
        raise ValueError(f"no free surrogates left in a fixed format: {said}")
    high = full.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(pool - 1) div 4096"))).alias("high"))
    every = high.select("*", F.explode(F.sequence(F.lit(0), F.lit(4095))).alias("low")).withColumn("v", F.col("high") * 4096 + F.col("low")).filter("v < pool")
    code = F.regexp_replace("head", "[^0-9]", "")
    digits = F.concat(code, F.expr("lpad(cast(v AS STRING), drawn, '0')"))
    value = F.when(F.col("kind") == "phone", F.concat("head", F.lit("/"), digits)).otherwise(digits)
    free = every.select(*_FORM, value.alias("norm")).join(entities, ["kind", "norm"], "left_anti")

    def dealt(rows: DataFrame, salt: str) -> DataFrame:
        by = F.sha2(F.concat_ws("\u0000", F.lit(key), F.lit(salt), "kind", "norm"), 256)
        return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*_FORM).orderBy(by, "norm")))

    wanted = dealt(formed.join(full.select(*_FORM), _FORM, "left_semi"), "entity").select(*_FORM, "nth", "norm")
    values = dealt(free, "value").select(*_FORM, "nth", F.col("norm").alias("surrogate"))
    return materialize(wanted.join(values, [*_FORM, "nth"]).select("kind", "norm", "surrogate"), "matched")


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, norm and surrogate: distinct within a kind, and none of them an entity itself.

    Numbers of full forms are matched with free values. For the others each
    round draws again only what clashed, so rounds shrink; they end when nothing
    clashes.
    """
    matched = _matched(entities, key)
    if matched is None:
        return _drawn_until_distinct(entities, entities, key)
    rest = entities.join(matched, ["kind", "norm"], "left_anti")
    return _drawn_until_distinct(rest, entities, key).unionAll(matched)


def _spread(entities: DataFrame) -> DataFrame:
    """Few bytes make much work here, so the number of tasks comes from the number of rows."""
    most = 20 * int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entities.repartition(max(1, min(entities.count() // ROWS_A_TASK + 1, most)), "kind", "norm")


def _drawn_until_distinct(entities: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    drawn = _spread(entities).withColumn("attempt", F.lit(0))
    first = Window.partitionBy("kind", "surrogate").orderBy("attempt", "norm")
    originals = taken.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("taken"))
    for _ in range(ROUNDS):
        named = drawn.withColumn("surrogate", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key))
        checked = named.withColumn("nth", F.row_number().over(first)).join(originals, ["kind", "surrogate"], "left")
        clash = (F.col("nth") > 1) | F.col("taken").isNotNull()
        state = materialize(checked.select("kind", "norm", "attempt", "surrogate", clash.alias("clash")), "surrogates")
        if state.filter("clash").isEmpty():
            return state.select("kind", "norm", "surrogate")
        drawn = state.select("kind", "norm", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))
    kinds = sorted(r.kind for r in state.filter("clash").select("kind").distinct().collect())
    raise ValueError(f"no free surrogates left in a fixed format after {ROUNDS} attempts: {', '.join(kinds)}")


def _formatted(kind: Column, value: Column, drawn: Column) -> Column:
    """A surrogate in the format of the value it replaces."""
    digits = F.when(kind == "phone", F.substring_index(drawn, "/", -1)).otherwise(drawn)
    kept = F.when(kind == "iban", "[A-Z0-9]").otherwise("[0-9]")

    def place(c: Column, i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), F.when(kind == "iban", "[^A-Z0-9]").otherwise("[^0-9]"), ""))
        return F.when(F.regexp_like(c, kept), F.substr(digits, nth, F.lit(1))).otherwise(c)

    cased = F.when(value == F.upper(value), F.upper(drawn)).when(kind.isin(*NAME_KINDS), F.initcap(drawn)).otherwise(drawn)
    return F.when(kind.isin("phone", "card", "ssn", "iban"), _each(value, place)).when(kind == "ip", drawn).otherwise(cased)


def masked(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """All rows and columns with entities replaced, and ``n_entities``."""
    columns = [c for c in docs.columns if c != "n_entities"]
    plain = docs.filter(~holds_entity(text)).select(*columns, F.lit(0).alias("n_entities"))
    touched = materialize(with_entities(docs.select(*columns), text, key), "with-entities")

    texts = touched.select("_text_id", "_found").dropDuplicates(["_text_id"])
    listed = texts.select("_text_id", F.posexplode("_found").alias("nth", "e")).select("_text_id", "nth", "e.value", "e.kind", "e.norm")
    listed = materialize(listed, "listed")
    mention = F.coalesce(F.col("kind") == "mention", F.lit(False))
    names = listed.filter(F.col("kind").isin(*NAME_KINDS)).groupBy("_text_id", "norm").agg(F.max("kind").alias("named"))
    known = listed.filter(mention).join(names, ["_text_id", "norm"], "left").select("_text_id", "nth", "value", F.col("named").alias("kind"), "norm")
    resolved = materialize(listed.filter(~mention).unionByName(known), "resolved")

    wanted = resolved.filter(F.col("kind").isNotNull())
    drawn = distinct_surrogates(materialize(wanted.select("kind", "norm").distinct(), "entities"), key)
    said = _formatted(F.col("kind"), F.col("value"), F.col("surrogate"))
    new = wanted.join(drawn, ["kind", "norm"]).select("_text_id", F.struct("nth", said.alias("s"), F.lit(1).alias("n")).alias("r"))
    kept = resolved.filter(F.col("kind").isNull()).select("_text_id", F.struct("nth", F.col("value").alias("s"), F.lit(0).alias("n")).alias("r"))
    # One entry per entity or word of one text.
    per_text = new.unionAll(kept).groupBy("_text_id").agg(F.array_sort(F.collect_list("r")).alias("_new"), F.sum("r.n").cast("int").alias("_n"))
    rebuilt = F.concat(F.array_join(F.flatten(F.zip_with("_found", "_new", lambda f, r: F.array(f["gap"], r["s"]))), ""), "_tail")
    done = touched.join(materialize(per_text, "replacements"), "_text_id").select("_row", rebuilt.alias("_text"), "_n")

    def column(name: str) -> Column:
        if name == text:
            return F.col("_text").alias(name)
        if name == "n_chars":
            return F.length("_text").cast(docs.schema[name].dataType).alias(name)
        return F.col("_row").getField(name).alias(name)

    return plain.unionAll(done.select(*map(column, columns), F.col("_n").alias("n_entities")))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_chars", "n_entities")
