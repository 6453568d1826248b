"""Personal data replaced by surrogates of the same kind.

Entities are found by one pattern: e-mail and IP addresses, phone, card and
social security numbers, account numbers, secrets, and names behind a title. The
distinct entities of the whole table each get a surrogate, made from a keyed
hash: digits become digits, letters letters of the same script and case, separators
stay; a card keeps its check digit right, an address its top-level domain, a name its
script and the gender of its title. So equal entities, however written, get
equal surrogates everywhere (coreference).

Addresses may hold letters of any script. In scripts written without blanks an
address in ASCII letters begins where they begin; one that has such letters right
before the at sign, or in the label behind it, takes the whole run of letters.

Different entities must stay different: surrogates that meet, or that are an
entity of the table, are drawn again with a counter until none is left. Only what
met is drawn and checked again. A shape may have fewer values than the table has
entities, so from attempt ``WIDEN`` on a surrogate has one more letter or digit with
every attempt, and an IPv4 address any octets, later those of an IPv6 address of
the documentation range: the rounds end. The checks run on the distinct entities
only, as joins and aggregations.

A password counts whatever its characters, unless it is only a mask such as
``******``; other secrets need a digit. A 1 with a separator before a national
phone number stays as it is, so that the number is the same with and without it.

The key is part of the plan; keep plans and event logs as safe as the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardlake.llm.columns import free_name, let
from wardlake.session import write_through

# Titles by script and gender, and given names to draw surrogates from.
TITLES = {
    ("latin", "m"): ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr"),
    ("latin", "f"): ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra"),
    ("latin", "n"): ("Dr", "Prof", "Mx"),
    ("cyrillic", "m"): ("Господин", "господин"),
    ("cyrillic", "f"): ("Госпожа", "госпожа"),
    ("greek", "m"): ("Κύριος", "κύριος", "Κύριο", "κύριο"),
    ("greek", "f"): ("Κυρία", "κυρία"),
}
GIVEN = {
    ("latin", "m"): ("Adam", "Brian", "Carl", "David", "Erik", "Frank", "Georg", "Henry", "Ivan", "Jonas", "Karl", "Louis", "Martin", "Noah", "Oscar", "Paul"),
    ("latin", "f"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Fiona", "Greta", "Helen", "Ida", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("latin", "n"): ("Alex", "Blair", "Casey", "Dana", "Eden", "Frances", "Gale", "Harper", "Indigo", "Jamie", "Kim", "Lee", "Morgan", "Noel", "Robin", "Sam"),
    ("cyrillic", "m"): ("Андрей", "Борис", "Виктор", "Григорий", "Денис", "Егор", "Иван", "Павел"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
    ("greek", "m"): ("Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος", "Χρήστος"),
    ("greek", "f"): ("Άννα", "Βασιλική", "Γεωργία", "Δήμητρα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
}
SYLLABLES = {
    "latin": ("ba", "ber", "dal", "den", "fa", "gor", "han", "kel", "la", "lin", "mar", "mon", "ner", "ral", "sen", "tor"),
    "cyrillic": ("ба", "бер", "вол", "дан", "зор", "кал", "лин", "мар", "нов", "пет", "рад", "сен", "тор", "фед", "хар", "чер"),
    "greek": ("βα", "γορ", "δαλ", "κελ", "λα", "λιν", "μαρ", "μον", "νερ", "παν", "ραλ", "σεν", "ταρ", "τορ", "φαν", "χαρ"),
}
# Letters that stand for others of their script, small and large where there are both; scripts not listed take Latin letters.
LETTERS = {
    "IsCyrillic": ("абвгдежзийклмнопрстуфхцчшщэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ"),
    "IsGreek": ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    "IsHebrew": ("אבגדהוזחטיכלמנסעפצקרשת", None),
    "IsArabic": ("ابتثجحخدذرزسشصضطظعغفقكلمنهوي", None),
    "IsDevanagari": ("अआइईउऊएऐओऔकखगघचछजझटठडढतथदधनपफबभमयरलवशषसह", None),
    "IsThai": ("กขคงจฉชซญดตถทธนบปผฝพฟภมยรลวศสหอ", None),
    "IsHangul": ("가나다라마바사아자차카타파하고노도로모보소오조초코토포호", None),
    "IsHiragana": ("あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわ", None),
    "IsKatakana": ("アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワ", None),
    "IsHan": ("安白北成春大東方高光海和江金京李林梅明南平青人山石水天田文西小新雪永雨玉月中竹子", None),
}
ENDINGS = {"latin": "son", "cyrillic": "енко", "greek": "ίδης"}

_WORD = r"(?:\p{Lu}[\p{Ll}'’\-]+)"
_TITLED = "|".join(sorted({t for group in TITLES.values() for t in group}, key=lambda t: (-len(t), t)))

# Scripts written without blanks: a word in ASCII letters may begin and end anywhere in them.
_DENSE = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u312F\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
          r"\uFF66-\uFF9F\x{20000}-\x{3FFFF}")
_NOT_ASCII = r"[\p{L}\p{M}&&[^\x00-\x7F]]"
_SPACED = rf"[A-Za-z0-9._%+\-[\p{{L}}\p{{M}}\p{{N}}&&[^{_DENSE}]]]"
_ADDRESS = r"[A-Za-z0-9._%+\-\p{L}\p{M}\p{N}]"
_HOST = rf"(?:[A-Za-z0-9\-\p{{L}}\p{{M}}\p{{N}}]++\.)+(?:(?i:xn--)[A-Za-z0-9\-]{{2,59}}|[A-Za-z]{{2,24}}|{_NOT_ASCII}{{2,24}})"

_CARD = r"(?<![\d\-.])\d(?:[ \-]?\d){12,18}(?![\d\-])"

#: Kind and pattern, the first that matches a piece of text names its kind.
KINDS = (
    ("email", rf"(?:(?<!{_SPACED}){_SPACED}++@|(?<!{_ADDRESS}){_ADDRESS}++(?:(?<=[{_DENSE}])@|@(?=[A-Za-z0-9\-]*{_NOT_ASCII}))){_HOST}"),
    ("secret", r"(?i:(?<!\w)(?:password|passwd|pwd)[\"']?[ \t]*[=:][ \t]*)[\"']?(?=[^\s\"',;]*[^\s\"',;*.•_=#\-])[^\s\"',;]{6,}+[\"']?"
     r"|(?i:(?<!\w)(?:token|secret|api[_\-]?key|access[_\-]?key)[\"']?[ \t]*[=:][ \t]*)[\"']?(?=[^\s\"',;]*\d)[^\s\"',;]{6,}+[\"']?"),
    ("hex", r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,}+(?![0-9A-Za-z])"),
    ("iban", r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("ssn", r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"),
    ("phone", r"\+\d{1,3}[ \-.]?(?:\(\d{1,4}\)[ \-.]?)?\d(?:[ \-.]?\d){5,12}(?!\d)|(?<!\d)\(\d{3}\)[ \-.]?\d{3}[ \-.]\d{4}(?!\d)|"
     rf"(?:(?<!\d|\d[\-.])|(?<=(?<!\d|\d[\-.])1[\-.]))(?:\d{{3}}[\-.]\d{{3}}[\-.]\d{{4}}|(?!{_CARD})\d{{3}}[ \-.]\d{{3}}[ \-.]\d{{4}})(?!\d|[\-.]\d)"),
    ("card", _CARD),
    ("name", rf"(?<![\p{{L}}\d])(?:{_TITLED})\.?[ \u00A0]{_WORD}(?:[ \u00A0]{_WORD})?"),
)
_OF = dict(KINDS)
#: Entities that begin with a digit or sign are tried at such characters only, the others nowhere behind an ASCII letter
#: or digit; what else may stand before an entity is up to its kind.
PATTERN = (
    "(?=[0-9+(])(?:" + "|".join(f"(?:{_OF[k]})" for k in ("email", "hex", "ip", "ssn", "phone", "card")) + ")"
    + r"|(?<![0-9A-Za-z])(?=[\p{L}\p{M}\p{N}._%\-])(?:" + "|".join(f"(?:{_OF[k]})" for k in ("email", "secret", "hex", "iban", "name")) + ")"
)
_FIRSTS = "".join(sorted({t[0] for group in TITLES.values() for t in group}))
#: Every entity has a digit, an at sign, a password's label or a title; texts without them are not searched.
HINT = rf"[0-9@]|[pP](?i:assword|asswd|wd)[\"']?[ \t]*[=:]|(?=[{_FIRSTS}])(?:{_TITLED})\.?[ \u00A0]\p{{Lu}}"
SEPARATORS = r"[ \-.()]"
#: Attempts after which a surrogate leaves the shape of its entity, and after which an address leaves IPv4.
WIDEN, WIDEST = 6, 14


def entities(text: Column) -> Column:
    """Everything in a text that looks personal, in order."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def kind_of(entity: Column) -> Column:
    out = None
    for kind, pattern in KINDS:
        hit = entity.rlike(rf"^(?:{pattern})$")
        out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return out.otherwise(F.lit("card"))


def _split_secret(entity: Column) -> tuple[Column, Column]:
    """The label of a secret, quotes included, and its value."""
    label = F.regexp_extract(entity, r"^([^=:]*[=:][ \t]*[\"']?)", 1)
    return label, F.regexp_replace(F.substr(entity, F.char_length(label) + 1), r"[\"']$", "")


def _name_parts(entity: Column) -> tuple[Column, Column]:
    """Title with what separates it, and the name."""
    title = F.regexp_extract(entity, rf"^((?:{_TITLED})\.?[ \u00A0])", 1)
    return title, F.substr(entity, F.char_length(title) + 1)


def _group_of(title: Column) -> Column:
    """Script and gender of a title, as one word."""
    out = F.lit("latin n")
    for (script, gender), titles in TITLES.items():
        out = F.when(F.regexp_replace(title, r"[.\s\u00A0]", "").isin(*titles), F.lit(f"{script} {gender}")).otherwise(out)
    return out


def canonical(kind: Column, entity: Column) -> Column:
    """What all spellings of an entity share: digits of a number, an address in small letters, a secret's value, script, gender and name."""
    title, name = _name_parts(entity)
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), F.regexp_replace(entity, SEPARATORS, ""))
        .when(kind == "email", F.lower(entity)).when(kind == "secret", _split_secret(entity)[1])
        .when(kind == "name", F.concat(_group_of(title), F.lit(" "), F.regexp_replace(name, r"\u00A0", " "))).otherwise(entity)
    )


def _noise(key: str, parts: list[Column], length: Column) -> Column:
    """At least 4 * ``length`` hex digits that depend on the key and the parts."""
    message = F.concat_ws("\u0001", *parts)
    inner = F.sha2(F.concat(F.lit(key), F.lit("\u0002"), message), 256)
    return let(inner, lambda m: F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor(length / 16).cast("int")),
        lambda b: F.sha2(F.concat(F.lit(key), F.lit("\u0003"), m, F.lit("\u0001"), b.cast("string")), 256)), ""))


def _number(noise: Column, i: Column) -> Column:
    return F.conv(F.substr(noise, i * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _same_shape(value: Column, noise: Column, hexadecimal: bool = False) -> Column:
    """Each digit another digit, each letter another of its case; in hexadecimal text both from the sixteen."""
    def char(c: Column, i: Column) -> Column:
        n = _number(noise, i)
        if hexadecimal:
            h = F.substr(F.lit("0123456789abcdef"), n % 16 + 1, F.lit(1))
            return F.when(c.rlike("[0-9a-f]"), h).when(c.rlike("[A-F]"), F.upper(h)).otherwise(c)
        pick = lambda letters: F.substr(F.lit(letters), n % len(letters) + 1, F.lit(1))
        out = (
            F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c.rlike(r"[\x00-\x7F]|\p{M}"), c)
        )
        for script, (small, large) in LETTERS.items():
            if large:
                out = out.when(c.rlike(rf"[\p{{{script}}}&&\p{{Lu}}]"), pick(large))
            out = out.when(c.rlike(rf"[\p{{{script}}}&&\p{{L}}]"), pick(small))
        return (
            out.when(c.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{L}|\p{N}"), pick("abcdefghijklmnopqrstuvwxyz")).otherwise(c)
        )
    return F.array_join(F.transform(F.split(value, ""), char), "")


def _luhn(digits: Column) -> Column:
    """The sum of a number's digits by Luhn's rule, the last digit counted once."""
    return F.aggregate(
        F.transform(F.reverse(F.split(digits, "")), lambda d, i: let(
            d.cast("int") * (i % 2 + 1), lambda x: F.when(x > 9, x - 9).otherwise(x))),
        F.lit(0), lambda total, x: total + x)


def _card(value: Column, noise: Column) -> Column:
    """Another number with the same first digit; right by Luhn's rule if this one is."""
    drawn = F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(_same_shape(value, noise), F.lit(2)))
    body = lambda x: F.substr(x, F.lit(1), F.char_length(x) - 1)
    right = let(drawn, lambda x: F.concat(body(x), ((10 - _luhn(F.concat(body(x), F.lit("0"))) % 10) % 10).cast("string")))
    return F.when(_luhn(value) % 10 == 0, right).otherwise(drawn)


def _name(key: str, value: Column, noise: Column, attempt: Column) -> Column:
    """A given name of the gender and script if there was one, and a family name that depends on the family name alone.

    Later attempts depend on the whole name and have more syllables.
    """
    out = F.lit(None).cast("string")
    family = F.substring_index(value, " ", -1)
    of_family = F.when(attempt == 0, _noise(key, [F.lit("family"), family], F.lit(32))).otherwise(noise)
    for (script, gender), names in GIVEN.items():
        syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        given = F.get(F.array(*[F.lit(x) for x in names]), _number(noise, F.lit(0)) % len(names))
        new_family = let(of_family, lambda n: F.concat(F.initcap(F.array_join(F.transform(  # noqa: B023
            F.sequence(F.lit(1), F.least(attempt, F.lit(12)) + 3),
            lambda i: F.get(syllables, _number(n, i) % len(SYLLABLES[script]))), "")), F.lit(ENDINGS[script])))  # noqa: B023
        full = F.when(F.size(F.split(value, " ")) > 3, F.concat(given, F.lit(" "), new_family)).otherwise(new_family)
        out = F.when(value.startswith(f"{script} {gender} "), F.concat(F.lit(f"{script} {gender} "), full)).otherwise(out)
    return out


def _octet(digits: Column, n: Column) -> Column:
    """A number from 1 to 254 with so many digits."""
    return F.when(digits == 1, n % 9 + 1).when(digits == 2, n % 90 + 10).otherwise(n % 155 + 100)


def _phone(value: Column, noise: Column) -> Column:
    """Digits from 2 on stay from 2 on, 0 and 1 stay below, so that a number plan still allows the number; the first digit stays."""
    digits = F.transform(F.split(value, ""), lambda c, i: let(_number(noise, i), lambda n: (
        F.when(c.rlike("[2-9]"), (n % 8 + 2).cast("string")).when(c.rlike("[01]"), (n % 2).cast("string")).otherwise(c))))
    prefix = F.regexp_extract(value, r"^(\+?[0-9]?)", 1)
    return F.concat(prefix, F.substr(F.array_join(digits, ""), F.char_length(prefix) + 1))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The surrogate of a canonical entity: the same for the same key, kind, value and attempt."""
    def made(noise: Column) -> Column:
        host = F.substring_index(value, "@", -1)
        label, top = F.regexp_extract(host, r"^(.*)\.[^.]+$", 1), F.substring_index(host, ".", -1)
        more = F.least(F.greatest(attempt - (WIDEN - 1), F.lit(0)), F.lit(16))
        further = lambda c: let(F.sha2(noise, 256), lambda n: _same_shape(F.repeat(F.lit(c), more), n))
        host_noise = _noise(key, [F.lit("host"), host], F.char_length(host))
        email = F.concat(_same_shape(F.substring_index(value, "@", 1), noise), further("a"), F.lit("@"), let(host_noise, lambda n: _same_shape(label, n)), F.lit("."), top)
        octet = lambda o, i: F.when(attempt < WIDEN, _octet(F.char_length(o), _number(noise, i))).otherwise(_number(noise, i) % 254 + 1)
        octets = F.array_join(F.transform(F.split(value, r"\."), lambda o, i: octet(o, i).cast("string")), ".")
        groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.lower(F.hex(_number(noise, i)))), ":")
        octets = F.when(attempt < WIDEST, octets).otherwise(F.concat(F.lit("2001:db8:"), groups))
        iban = F.concat(F.substr(value, F.lit(1), F.lit(2)), F.substr(_same_shape(value, noise), F.lit(3)))
        return (
            F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "phone", F.concat(_phone(value, noise), further("1")))
            .when(kind == "card", F.concat(_card(value, noise), further("1"))).when(kind == "ssn", F.concat(_same_shape(value, noise), further("1")))
            .when(kind == "iban", F.concat(iban, further("1"))).when(kind == "name", _name(key, value, noise, attempt)).when(kind == "hex", _same_shape(value, noise, True))
            .when((kind == "secret") & (attempt > 1), F.concat(_same_shape(value, noise), _same_shape(F.lit("aaaa"), F.sha2(noise, 256)), further("a")))
            .when((kind == "secret") & value.rlike("^(?=.*[a-f])[0-9a-f]+$"), _same_shape(value, noise, True)).otherwise(_same_shape(value, noise))
        )
    return let(_noise(key, [kind, value, attempt.cast("string")], F.greatest(F.char_length(value), F.lit(32))), made)


def written(kind: Column, entity: Column, replacement: Column) -> Column:
    """A surrogate in the spelling of one occurrence: its separators, its capitals, its label or title."""
    place = lambda c: F.when(c.rlike(SEPARATORS), F.lit(0)).otherwise(F.lit(1))
    def laid_out(chars: Column) -> Column:
        at = lambda i: F.aggregate(F.slice(chars, F.lit(1), i + 1), F.lit(0), lambda n, c: n + place(c))
        spelled = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike(SEPARATORS), c).otherwise(F.substr(replacement, at(i), F.lit(1)))), "")
        return F.concat(spelled, F.substr(replacement, at(F.size(chars) - 1) + 1))
    label, value = _split_secret(entity)
    quote = F.substr(entity, F.char_length(label) + F.char_length(value) + 1)
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), let(F.split(entity, ""), laid_out))
        .when(kind == "email", F.when(entity == F.upper(entity), F.upper(replacement)).otherwise(replacement))
        .when(kind == "secret", F.concat(label, replacement, quote))
        .when(kind == "name", F.concat(_name_parts(entity)[0], F.regexp_replace(replacement, r"^\w+ \w ", ""))).otherwise(replacement)
    )


def assign_surrogates(found: DataFrame, key: str) -> DataFrame:
    """``kind``, ``value``, ``attempt``, ``surrogate`` for the distinct canonical entities ``kind``, ``value``.

    Two entities of a kind never share a surrogate, and none is an entity of the
    table. Who drew first keeps it (lower attempt, then value); the others, and
    only they, draw again.
    """
    names = ["kind", "surrogate"]
    taken = found.select("kind", F.col("value").alias("surrogate"))
    waiting, kept, attempt = found.select("kind", "value"), [], 0
    while True:
        made = write_through(waiting.select("kind", "value", F.lit(attempt).alias("attempt"), surrogate(
            key, F.col("kind"), F.col("value"), F.lit(attempt)).alias("surrogate")), "drawn")
        first = made.groupBy(*names).agg(F.min("value").alias("value"))
        # what is taken already, looked up from the side of the draws, which are few after the first round
        met = taken.join(first.select(*names), names, "left_semi")
        kept.append(write_through(made.join(first.join(met, names, "left_anti"), [*names, "value"], "left_semi"), "surrogates"))
        waiting = write_through(made.join(kept[-1].select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value"), "waiting")
        if waiting.isEmpty():
            break
        taken = taken.unionByName(kept[-1].select(*names))
        attempt += 1
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def replace_personal(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; all rows and columns stay, and ``count`` names a column for the number of replacements.

    Null stays null; texts without entities stay as they are, and those without a
    digit, an at sign, a password's label or a title are not even shuffled. Repeated rows, and rows with the same entities, share their
    replacements.
    """
    list_, digest, made = (free_name(docs, n) for n in ("__entities", "__digest", "__made"))
    body = F.col(f"`{text}`")
    hinted = F.coalesce(body.rlike(HINT), F.lit(False))
    # a generator computes the list once for a row, where a filter and a projection would compute it twice
    searched = docs.where(hinted).select("*", F.explode(F.array(entities(body))).alias(list_))
    joined = F.array_join(F.col(list_), "\u0001")
    lists = write_through(
        searched.select(list_).where(F.size(list_) > 0).select(F.sha2(joined, 256).alias(digest), list_).dropDuplicates([digest]), "entities")
    forms = lists.select(F.explode(list_).alias("entity")).distinct().withColumn("kind", kind_of(F.col("entity")))
    forms = write_through(forms.withColumn("value", canonical(F.col("kind"), F.col("entity"))), "forms")
    chosen = assign_surrogates(forms.select("kind", "value").distinct(), key)
    spelled = write_through(forms.join(chosen, ["kind", "value"]).select(
        "entity", written(F.col("kind"), F.col("entity"), F.col("surrogate")).alias("new")), "spelled")
    placed = lists.select(digest, F.posexplode(list_).alias("pos", "entity")).join(spelled, "entity")
    by_list = placed.groupBy(digest).agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias(made))
    # texts without entities get a key of their own, so that they do not meet in one task
    keyed = searched.withColumn(digest, F.when(F.size(list_) > 0, F.sha2(joined, 256)).otherwise(F.sha2(body, 256)))
    touched = keyed.join(by_list, digest, "left")
    rebuilt = let(F.split(body, PATTERN, -1), lambda gaps: F.array_join(F.transform(
        gaps, lambda g, i: F.concat(g, F.coalesce(F.get(F.col(made), i)["new"], F.lit("")))), ""))
    changed = F.when(F.col(made).isNull(), body).otherwise(rebuilt)
    columns = lambda new: [(new.alias(text) if c == text else F.col(f"`{c}`")) for c in docs.columns if c != count]
    found = [] if count is None else [F.size(list_).cast("long").alias(count)]
    none = [] if count is None else [F.lit(0).cast("long").alias(count)]
    clean = docs.where(~hinted).select(*columns(body), *none)
    return clean.unionByName(touched.select(*columns(changed), *found))
