"""Personal data replaced by surrogates, in DataFrame operations only.

Found are: mail addresses, IP addresses, phone numbers, payment cards, social security numbers, account numbers (IBAN), access keys,
passwords, long hexadecimal tokens, and names behind one or more titles (all capitalised words that follow, or words of a script without capitals). A name found
with a title is replaced in the same text without one too, as a whole and by its family name; persons never named with a title in a text are not found in it. Numbers
like payment cards count only if their check digit is right. An entity is its kind and its normal form, so spellings of one entity get one surrogate everywhere.
The surrogate depends on the key, the kind and the normal form, and for names on the gender that all titles of the person tell together (none, or both: a
name for either). It has the same characters' classes (letters by script, capitals, digits, hexadecimal digits), the same punctuation and what tells its type
(top-level domain, country code, card issuer digit and check digit, key prefix, title); names keep gender, script and capitals.

Collision check: no two entities of a kind share a surrogate and no surrogate is an entity of the corpus. The smallest entity
keeps a contested surrogate, the others draw again until all are distinct. After ``WIDEN`` draws a surrogate gets longer with every further one,
so that a fully used form ends too; a text without a letter or digit is replaced by drawn ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import same, stored

KEY = "invoicelake"
WIDEN = 4
PLAIN = "plain"  # found by a pattern, but not what it looks like
_ALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_TITLE = (r"(?:Mrs|Mr|Ms|Miss|Mx|Sir|Madam|Dame|Lady|Lord|Herr|Frau|Monsieur|Madame|Mademoiselle|Mme|Mlle|Señora|Señorita|Señor|Sra|Srta|Sr|Don|Doña"
          r"|Г-жа|Г-н|MRS|MR|MS|MISS|HERR|FRAU|Dr|Dra|Doctor|Doctora|Doktor|Docteur|Prof|Professor|Professorin|Professeur|Profesor|Profesora|DR|PROF"
          r"|Д-р|Доктор|Проф|Профессор)")
_TITLES = _TITLE + r"\.?(?: " + _TITLE + r"\.?){0,8}"
_PARTICLE = "(?:von|vom|van|der|den|ter|ten|zu|zur|de|del|della|di|da|do|dos|du|la|las|los|le|y|bin|ibn|al|el)"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {
    "mail": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]*+@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}(?![A-Za-z0-9])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "key": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9_-]{16,}+|gh[pousr]_[A-Za-z0-9]{20,}+)(?![\p{L}\p{N}])",
    "password": r"""(?i:(?<=(?:password|passwort|passwd|pwd)["']?[=:]["']?)|(?<=(?:password|passwort|passwd|pwd)["']?[=:] ["']?))(?:[^\s"'<>]*[^\s"'<>,;.)]|[^\s"'<>]++)""",
    "token": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![\p{L}\p{N}])",
    "address6": r"(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "address": r"(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}]|\.[0-9])",
    "phone": r"(?<![\p{L}\p{N}+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![\p{L}\p{N}])"
             r"|(?<![\p{L}\p{N}.-])0[1-9][0-9]{1,3}[ /-][0-9]{6,8}(?![\p{L}\p{N}-])",
    "ssn": r"(?<![\p{L}\p{N}.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "name": r"(?<![\p{L}\p{N}])" + _TITLES + r"(?:(?:(?: (?:\p{Lu}\.?|" + _PARTICLE + r")(?= ))*+ \p{Lu}[\p{L}'-]++)++| \p{Lo}++(?: \p{Lo}++)?+)",  # words, and initials and particles before them
}
_ANY = "|".join(PATTERNS.values())
_GATE = r"[0-9@]|(?i:passw|pwd)|sk-|gh[pousr]_|::|" + _TITLE
_FEMALE = ("mrs", "ms", "miss", "madam", "dame", "lady", "frau", "madame", "mademoiselle", "mme", "mlle", "señora", "señorita", "sra", "srta", "doña", "г-жа",
           "dra", "doctora", "professorin", "profesora")
_MALE = ("mr", "sir", "lord", "herr", "monsieur", "señor", "sr", "don", "г-н")
_NAMED = r"^((?:" + _TITLE + r"\.? ){1,9})(.+)$"
# given names and syllables of family names by script
GIVEN = {
    ("latin", "f"): ["Alma", "Berta", "Clara", "Dora", "Elsa", "Flora", "Greta", "Hilda", "Ida", "Julia", "Karla", "Lena"],
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Konrad", "Leo"],
    ("latin", "n"): ["Alex", "Charlie", "Dominique", "Jamie", "Kim", "Robin", "Sascha", "Toni"],
    ("cyrillic", "n"): ["Валя", "Женя", "Саша", "Слава"],
    ("cyrillic", "f"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Инна", "Лидия"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Лев"],
}
SYLLABLES = {
    "latin": ["bar", "cor", "del", "fen", "gar", "hol", "kel", "lin", "mar", "nor", "pel", "ros", "sol", "tam", "var", "wen"],
    "cyrillic": ["бар", "вор", "дел", "зан", "кол", "лин", "мар", "нор", "пел", "рос", "сол", "там", "фен", "хол", "чер", "шан"],
}
# letters drawn for names in other scripts, one for one
LETTERS = {
    "Greek": "αβγδεζηθικλμνοπρστυφ", "Han": "王李张刘陈杨黄赵周吴明华伟芳军丽强静平文", "Hiragana": "あいうえおかきくけこさしすせそ", "Katakana": "アイウエオカキクケコサシスセソ",
    "Hangul": "가나다라마바사아자차카타파하", "Arabic": "ابتجحدرزسشصعفقكلمنوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת", "Devanagari": "कखगघचजटडतदनपबमयरलवसह",
    "Thai": "กขคงจชซดตนบปพมยรลวสห",
}


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern an entity has; passwords are told by what is left."""
    out = F.lit("password")
    for kind in reversed([k for k in PATTERNS if k != "password"]):
        out = F.when(F.regexp_like(entity, F.lit(f"^(?:{PATTERNS[kind]})$")), kind).otherwise(out)
    digits = F.regexp_replace(entity, "[^0-9]", "")
    wrong = _check_digit(digits) != F.substr(digits, F.char_length(digits), F.lit(1)).cast("int")
    return F.when((out == "card") & wrong, PLAIN).otherwise(out)


def gender_of(entity: Column) -> Column:
    """What the titles of a name tell: f, m or nothing."""
    titles = F.lower(F.regexp_extract(entity, _NAMED, 1))

    def has(words: tuple[str, ...]) -> Column:
        return F.regexp_like(titles, F.lit("(?:^| )(?:" + "|".join(words) + ")[. ]"))
    return F.when(has(_FEMALE), "f").when(has(_MALE), "m")


def normal_form(kind: Column, entity: Column) -> Column:
    """What spellings of one entity share: digits of numbers (country codes set off), lower case of names and
    mail addresses, names without titles."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    code = F.regexp_extract(entity, r"^\+([0-9]+)[^0-9]", 1)
    return (F.when(kind.isin("card", "ssn"), digits)
            .when(kind == "phone", F.concat(code, F.lit(" "), F.substr(digits, F.char_length(code) + 1)))
            .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
            .when(kind == "mail", F.lower(entity))
            .when(kind == "name", F.lower(F.regexp_extract(entity, _NAMED, 2)))
            .otherwise(entity))


def _byte(stream: Column, i: Column) -> Column:
    """Byte i of a hexadecimal string of 256 bytes, over and over."""
    return F.conv(F.substr(stream, (i % 256) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(pool: str, byte: Column) -> Column:
    return F.substr(F.lit(pool), byte % len(pool) + 1, F.lit(1))


def _other_script(c: Column, byte: Column) -> Column:
    """A letter of the same script; NULL where it has none in ``LETTERS`` and is no letter."""
    out = F.when(F.regexp_like(c, F.lit(r"\p{Lu}")), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", byte)).when(
        F.regexp_like(c, F.lit(r"\p{L}")), _pick("abcdefghijklmnopqrstuvwxyz", byte)).otherwise(c)
    for script, letters in LETTERS.items():
        out = F.when(F.regexp_like(c, F.lit(rf"\p{{Is{script}}}")), _pick(letters, byte)).otherwise(out)
    return out


def _alike(text: Column, stream: Column, digits: Column, keep: Column, last: Column) -> Column:
    """``text`` with characters of the same classes; the first ``keep`` characters and those from ``last`` on stay. With ``digits`` (true)
    only digits change; in a hexadecimal text letters stay hexadecimal. Without a letter or digit every character is drawn from all classes."""
    of_text = F.struct(F.regexp_like(text, F.lit("^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|[0-9A-Fa-f]*:[0-9A-Fa-f:]*:[0-9A-Fa-f:]*)$")).alias("hexadecimal"),
                       F.regexp_like(text, F.lit(r"[0-9\p{L}]")).alias("changes"), keep.alias("keep"), last.alias("last"))

    def one(c: Column, i: Column, of: Column) -> Column:
        byte, hexadecimal = _byte(stream, i), of["hexadecimal"]
        fresh = (F.when(F.regexp_like(c, F.lit("[0-9]")), _pick("0123456789", byte))
                 .when(digits, c)
                 .when(hexadecimal & F.regexp_like(c, F.lit("[a-f]")), _pick("abcdef", byte))
                 .when(hexadecimal & F.regexp_like(c, F.lit("[A-F]")), _pick("ABCDEF", byte))
                 .when(F.regexp_like(c, F.lit(r"\p{IsCyrillic}")), F.when(F.lower(c) == c, _pick("абвгдежзиклмнопрстуф", byte)).otherwise(
                     _pick("АБВГДЕЖЗИКЛМНОПРСТУФ", byte)))
                 .when(F.regexp_like(c, F.lit(r"[^\x00-\x7F]")), _other_script(c, byte))
                 .when(F.regexp_like(c, F.lit(r"\p{Lu}")), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", byte))
                 .when(F.regexp_like(c, F.lit(r"\p{L}")), _pick("abcdefghijklmnopqrstuvwxyz", byte))
                 .when(of["changes"], c)
                 .otherwise(_pick(_ALL, byte)))
        return F.when((i < of["keep"]) | (i >= of["last"]), c).otherwise(fresh)
    # what holds for the whole text is computed once, not for every character
    return F.element_at(F.transform(F.array(of_text), lambda of: F.array_join(F.transform(F.split(text, ""), lambda c, i: one(c, i, of)), "")), 1)


def _extra(stream: Column, pool: str) -> Column:
    """The characters that a surrogate gets in addition: none in the first ``WIDEN`` draws, then one more with every draw."""
    drawn = F.transform(F.sequence(F.lit(0), F.greatest(F.col("attempt") - WIDEN, F.lit(0))), lambda i: _pick(pool, _byte(stream, 255 - i % 256)))
    return F.when(F.col("attempt") < WIDEN, "").otherwise(F.array_join(drawn, ""))


def _check_digit(number: Column) -> Column:
    """The digit that makes ``number`` (without its last digit) pass the check of payment cards."""
    body = F.reverse(F.split(F.substr(number, F.lit(1), F.char_length(number) - 1), ""))

    def weigh(total: Column, x: Column) -> Column:
        twice = x["d"] * F.when(x["i"] % 2 == 0, 2).otherwise(1)
        return total + twice - F.when(twice > 9, 9).otherwise(0)
    total = F.aggregate(F.transform(body, lambda d, i: F.struct(d.cast("int").alias("d"), i.alias("i"))), F.lit(0), weigh)
    return F.pmod(10 - total % 10, F.lit(10))


def _stream(key: str) -> Column:
    """256 bytes in hexadecimal for columns kind, norm and attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), "kind", "norm", F.col("attempt").cast("string"))
    return F.concat(*(F.sha2(F.concat(seed, F.lit(f"\x1f{k}")), 256) for k in range(8)))


def _candidate() -> Column:
    """The surrogate's normal form for columns kind, norm, attempt and stream."""
    stream, rows = F.col("stream"), F.col("norm")
    end = F.char_length(rows)
    tld = end - F.char_length(F.substring_index(rows, ".", -1))
    alike = _alike(rows, stream, F.col("kind").isin("card", "phone", "ssn"),
                   F.when(F.col("kind") == "key", 4).when(F.col("kind") == "iban", 2).when(F.col("kind") == "card", 1)
                   .when(F.col("kind") == "phone", F.instr(rows, " ")).otherwise(0),
                   F.when(F.col("kind") == "mail", tld).otherwise(end))
    alike = (F.when(F.col("kind") == "name", alike).when(F.col("kind") == "mail", F.concat(_extra(stream, "abcdefghijklmnopqrstuvwxyz"), alike))
             .when(F.col("kind") == "password", F.concat(alike, _extra(stream, _ALL))).otherwise(F.concat(alike, _extra(stream, "0123456789"))))
    final = F.char_length(alike)
    card = F.concat(F.substr(alike, F.lit(1), final - 1), F.when(_check_digit(rows) == F.substr(rows, end, F.lit(1)).cast("int"),
                                                                _check_digit(alike).cast("string")).otherwise(F.substr(alike, final, F.lit(1))))
    address = F.concat_ws(".", *((_byte(stream, F.lit(k)) % 254 + 1).cast("string") for k in range(4)))
    cyrillic = F.regexp_like(rows, F.lit(r"\p{IsCyrillic}"))
    name = F.lit(None).cast("string")
    for (script, gender), given in GIVEN.items():
        first = F.element_at(F.array(*map(F.lit, given)), _byte(stream, F.lit(0)) % len(given) + 1)
        last = _syllables(F.array(*map(F.lit, SYLLABLES[script])), stream)
        two = F.regexp_like(rows, F.lit(r"^\S+ \S"))
        own = F.lower(F.when(two, F.concat(first, F.lit(" "), last)).otherwise(last))
        name = F.when((cyrillic == F.lit(script == "cyrillic")) & (F.col("gender") == gender), own).otherwise(name)
    other = F.regexp_like(rows, F.lit("[" + "".join(rf"\p{{Is{script}}}" for script in LETTERS) + "]"))
    drawn = F.transform(F.sequence(F.lit(0), F.greatest(F.col("attempt") - WIDEN, F.lit(0))), lambda i: F.substr(alike, i % end + 1, F.lit(1)))
    name = F.when(other, F.concat(alike, F.when(F.col("attempt") < WIDEN, "").otherwise(F.array_join(drawn, "")))).otherwise(name)
    return (F.when(F.col("kind") == "address", address).when(F.col("kind") == "name", name).when(F.col("kind") == "card", card).otherwise(alike))


def _syllables(pool: Column, stream: Column) -> Column:
    """A family name of three syllables and one more for every further draw."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.col("attempt") + 3), lambda i: F.element_at(pool, _byte(stream, i) % 16 + 1)), "")


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, norm, surrogate`` for the distinct (kind, norm) of ``entities``; distinct entities get distinct surrogates. A column
    ``gender`` (f, m or NULL) is heeded for names."""
    told = F.col("gender") if "gender" in entities.columns else F.lit(None).cast("string")
    known = entities.select("kind", "norm", told.alias("gender")).groupBy("kind", "norm").agg(F.min("gender").alias("low"), F.max("gender").alias("high"))
    known = stored(known.select("kind", "norm", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("n").alias("gender")), "entities")
    waiting, settled = known.withColumn("attempt", F.lit(0)), None
    while True:
        drawn = stored(waiting.withColumn("stream", _stream(key)).withColumn("surrogate", _candidate()).drop("stream"), "drawn")
        free = drawn.join(known.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        won = stored(first.select("kind", "norm", "surrogate"), "settled")
        settled = won if settled is None else settled.unionByName(won)
        waiting = drawn.join(won, ["kind", "norm"], "left_anti").select("kind", "norm", "gender", (F.col("attempt") + 1).alias("attempt"))
        if not waiting.limit(1).count():
            return settled


def _formatted(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the format of an occurrence: its punctuation, spaces and capitals. What a widened number has more stands at its end."""
    marks = F.split(entity, "")
    solid = F.replace(surrogate, F.lit(" "), F.lit(""))
    digit = lambda c: F.regexp_like(c, F.lit("[0-9A-Z]"))

    def place(c: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(marks, F.lit(1), i + 1), digit))
        return F.when(digit(c), F.substr(solid, before, F.lit(1))).otherwise(c)
    number = F.concat(F.array_join(F.transform(marks, place), ""), F.substr(solid, F.size(F.filter(marks, digit)) + 1))
    title, rest = F.regexp_extract(entity, _NAMED, 1), F.regexp_extract(entity, _NAMED, 2)
    shown = F.initcap(surrogate)
    name = F.concat(title, F.when(F.upper(rest) == rest, F.upper(shown)).otherwise(shown))
    mail = F.when(F.upper(entity) == entity, F.upper(surrogate)).otherwise(surrogate)
    return (F.when(kind == PLAIN, entity).when(kind.isin("card", "phone", "ssn", "iban"), number).when(kind == "name", name).when(kind == "mail", mail).otherwise(surrogate))


def _mentions(fresh: Column) -> Column:
    """Of the placed entities of a text the names as (needle, fresh): whole and by family name, longer needles first, a needle once."""
    def parts(x: Column) -> Column:
        own, new = F.regexp_extract(x["entity"], _NAMED, 2), F.regexp_extract(x["fresh"], _NAMED, 2)
        family = F.struct(F.element_at(F.split(own, " "), -1).alias("needle"), F.element_at(F.split(new, " "), -1).alias("fresh"))
        return F.array(F.struct(own.alias("needle"), new.alias("fresh")), family)
    found = F.flatten(F.transform(F.filter(fresh, lambda x: x["kind"] == "name"), parts))
    first = F.filter(found, lambda x: F.char_length(x["needle"]) > 1)
    return F.array_sort(F.array_distinct(first), lambda a, b: (F.char_length(b["needle"]) - F.char_length(a["needle"])))


def _named_again(gap: Column, mentions: Column) -> Column:
    """Text between entities with the names in it replaced; marks of the private use area keep a surrogate from being replaced once more."""
    def mark(text: Column, m: Column) -> Column:
        word = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), m["x"]["needle"], F.lit(r"\E(?![\p{L}\p{N}])"))
        return F.when(F.contains(text, m["x"]["needle"]), F.regexp_replace(text, word, F.concat(F.lit("\ue000"), m["i"].cast("string"), F.lit("\ue001")))).otherwise(text)

    def put(text: Column, m: Column) -> Column:
        return F.replace(text, F.concat(F.lit("\ue000"), m["i"].cast("string"), F.lit("\ue001")), m["x"]["fresh"])
    numbered = F.transform(mentions, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    return F.aggregate(numbered, F.aggregate(numbered, gap, mark), put)


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, n_entities, kinds``; ``text`` with surrogates, ``kinds`` the kind of each in order.

    NULL texts stay NULL. Texts are searched once; those without an entity pass unchanged, and only the others are joined with their
    surrogates, by id and a hash of the text, so that repeated ids do not mix. ``n_entities`` does not count later mentions of a name.
    """
    none = F.array().cast("array<string>")
    found = docs.select("doc_id", "text").withColumn("entities", F.when(
        F.regexp_like("text", F.lit(_GATE)), F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).otherwise(none))
    found = stored(found.withColumn("has", F.size("entities") > 0), "searched")
    hits = found.filter("has").withColumn("mark", F.xxhash64("text"))
    spelt = hits.select(F.explode("entities").alias("entity")).distinct().withColumn("kind", kind_of(F.col("entity")))
    spelt = stored(spelt.withColumns({"norm": normal_form(F.col("kind"), F.col("entity")), "gender": gender_of(F.col("entity"))}), "spelt")
    drawn = assign(spelt.filter(F.col("kind") != PLAIN), key)
    forms = spelt.join(drawn, ["kind", "norm"], "left").select("entity", "kind", _formatted(F.col("kind"), F.col("entity"), F.col("surrogate")).alias("fresh"))
    placed = hits.select("doc_id", "mark", F.posexplode("entities").alias("at", "entity")).distinct().join(forms, "entity")
    lists = placed.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list(F.struct("at", "fresh", "kind", "entity"))).alias("fresh"))
    lists = lists.select(F.col("doc_id").alias("for_id"), F.col("mark").alias("for_mark"), "fresh", _mentions(F.col("fresh")).alias("mentions"))
    joined = hits.join(lists, same(F.col("doc_id"), F.col("for_id")) & (F.col("mark") == F.col("for_mark")))
    gaps = F.transform(F.split("text", _ANY, -1), lambda gap: F.when(F.size("mentions") > 0, _named_again(gap, F.col("mentions"))).otherwise(gap))
    woven = F.array_join(F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(F.get("fresh", i)["fresh"], F.lit("")))), "")
    real = F.filter("fresh", lambda f: f["kind"] != PLAIN)
    done = joined.select("doc_id", woven.alias("text"), F.size(real).cast("long").alias("n_entities"), F.transform(real, lambda f: f["kind"]).alias("kinds"))
    clean = found.filter("NOT has").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), none.alias("kinds"))
    return done.unionByName(clean)
