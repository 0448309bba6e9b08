"""Operator 2: personal data and secrets replaced by surrogates.

Built-in expressions only. Entities are found by one pattern; the text between
them is untouched. Every entity has a type and a canonical form (digits of a
phone or card number, lower-cased mail address or name), and gets a surrogate
from sha2(key | type | canonical form | attempt): digits stay digits, letters
stay letters of their case, a card number keeps its first digit and a valid
check digit, a mail address its dots and its top-level domain, an address of a
network its four numbers, a key its prefix. A name that follows a title (all its
capitalised words, initials and particles) gets a made-up name of the same
gender, script and case. Each occurrence is written in its own format, so equal
entities stay equal (coreference) in any spelling. Where a row names somebody
with a title, the capitalised name without one, or a single word of it, gets the
same surrogate or its word anywhere in that row; a neutral title takes the
gender that the row gives the same name.

Collisions: within a type no two entities may share a surrogate, and none may
equal an entity that occurs. Entities in conflict, all but the least, draw
again with the next attempt until there is no conflict; from the fourth
attempt on, the form widens (longer names, any network number), so the draws
cannot run dry.

Only rows with entities are joined: their occurrences meet the table of
distinct entities (a hot entity is split by Spark), and their texts are rebuilt
by position. Other rows pass by in the scan.

Defined cases: null and empty texts come back as they are with 0 entities;
repeated rows get equal texts; a null id is a key like any other; an empty
table gives no rows; other columns pass through, ``n_entities`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carlot.llm.common import replaced, written

KEY = "corpus-surrogates"
#: Titles that announce a name, by gender, n for neutral ones (fixed values).
#: Abbreviations are written with or without the dot, the others without.
SHORT_TITLES = {"f": ["Mrs", "Ms", "Mme", "Mlle", "Sra", "Srta"], "m": ["Mr", "Sr"], "n": ["Dr", "Prof", "Mx"]}
TITLES = {
    "f": ["Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Doña", "г-жа", "госпожа", "κυρία"],
    "m": ["Sir", "Herr", "Monsieur", "Señor", "Don", "г-н", "господин", "κύριος"],
    "n": ["Doctor", "Professor", "Doktor", "Docteur", "Professeur"],
}
#: Small words inside a name; they stay as they are.
PARTICLES = ["von", "van", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "zu", "bin", "ibn", "al", "y"]
#: Syllables of made-up names by script: starts, middles, endings of each gender.
SYLLABLES = {
    "latin": (["Ba", "Ce", "Da", "El", "Fa", "Ga", "Ha", "Jo", "Ka", "Le", "Ma", "Ne", "Or", "Pe", "Ro", "Sa"],
              ["bri", "ca", "do", "fe", "li", "ma", "no", "ri", "sa", "ti", "va", "ze", "lu", "mi", "ne", "ro"],
              {"f": ["na", "la", "ra", "sa"], "m": ["n", "r", "s", "rd"], "n": ["n", "na", "r", "ra"]}),
    "cyrillic": (["Ба", "Ве", "Га", "Да", "Ели", "За", "Ка", "Ле", "Ма", "Не", "Оле", "Па", "Ро", "Са", "Та", "Фе"],
                 ["бри", "ва", "до", "ле", "ли", "ма", "но", "ри", "са", "ти", "ва", "зе", "лу", "ми", "не", "ро"],
                 {"f": ["на", "ла", "ра", "са"], "m": ["н", "р", "с", "рд"], "n": ["н", "на", "р", "ра"]}),
    "greek": (["Βα", "Γε", "Δα", "Ελι", "Ζα", "Θε", "Κα", "Λε", "Μα", "Νε", "Ορε", "Πα", "Ρο", "Σα", "Τα", "Φε"],
              ["βρι", "γα", "δο", "λε", "λι", "μα", "νο", "ρι", "σα", "τι", "βα", "ζε", "λου", "μι", "νε", "ρο"],
              {"f": ["να", "λα", "ρα", "σα"], "m": ["νος", "ρος", "σος", "δος"], "n": ["νος", "να", "ρος", "ρα"]}),
}
#: Attempt from which a surrogate's form may widen.
WIDEN = 4
#: Words up to which a name is looked for as a whole; the words of a longer one
#: are found one by one and get the same surrogate's words.
WHOLE = 10

_SPACE = r"[\s\u00A0]{1,3}"
_GAP = r"[ \t\u00A0]"


def _titles(short: str, plain: str) -> str:
    """Pattern of a title of these genders and the space after it; in capitals, an
    abbreviation needs its dot."""
    abbreviated, words = [v for g in short for v in SHORT_TITLES[g]], [v for g in plain for v in TITLES[g]]
    words += [v.upper() for v in words if v[0].isupper()]
    spelled = rf"|(?:{'|'.join(words)}){_SPACE}" if words else ""
    return (rf"(?=[{''.join(sorted({v[0] for v in abbreviated + words}))}])(?:(?:{'|'.join(abbreviated)})(?:\.(?:{_SPACE})?|{_SPACE})"
            rf"|(?:{'|'.join(v.upper() for v in abbreviated)})\.(?:{_SPACE})?{spelled})")


#: Further titles: abbreviations and neutral words ("Herr Prof. Dr."), never words that are first names too.
_MORE = _titles("fmn", "n")
_TITLE = rf"{_titles('fmn', 'fmn')}(?:{_MORE})*+"
#: A capitalised word without a possessive ending, or initials; further words
#: follow in the same line. Possessive quantifiers: no stack for long runs.
_CAP = r"\p{Lu}(?:[\p{L}\p{M}]|(?!['’][sS](?!\p{L}))['’-](?=\p{L}))++"
_PART = rf"(?:\p{{Lu}}\.(?:-?\p{{Lu}}\.)*+|{_CAP}|\p{{Lu}}(?={_GAP}{{1,2}}\p{{Lu}}))"
_NAME = (rf"{_PART}(?:(?:{_GAP}{{1,2}}|(?<=\.))(?!{_MORE})(?:(?:{'|'.join(PARTICLES)}){_GAP}{{1,2}}){{0,3}}+{_PART})*+")
_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']? {0,3}[=:] {0,3}[\"']?"
_KEY_HEAD = r"AKIA|gh[pousr]_|sk-"
#: National phones: area code (a trunk or country digit may lead) and 3-4 or
#: 3-2-2 digits; an area code in brackets; a leading 0 and 7 digits or more in groups that
#: are no date.
_LOCAL = r"(?:\+?[178][ .-]?)?(?:\(\d{3}\)[ -]?|\d{3}[ .-])\d{3}(?:[ .-]\d{4}|[ -]\d{2}[ -]\d{2})"
_AREA = r"\(\d{2,4}\) ?\d{3,5}[ .-]\d{4}"
_TRUNK = (r"(?!\d{1,2}(?<sep>[./ -])\d{1,2}\k<sep>(?:(?:19|20)\d{2}(?!\d)|\d{2}(?![ ./-]?\d)))(?=(?:[()./ -]{0,2}\d){7})"
          r"(?:\(0\d{1,4}\)[ /-]?|0\d{1,4}[ ./-])\d{2,8}(?:[ .-]\d{2,8}){0,4}+")
#: Entity patterns, the first that fits wins. A secret comes with the name it is
#: assigned to and a person's name with its title; both stay in place.
PATTERNS = {
    # a domain has at most 127 labels; an unbounded group would use stack for each
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,126}(?<=\.[A-Za-z]{2,24})",
    "secret": rf"(?<![A-Za-z]){_ASSIGN}[A-Za-z0-9+/_-]{{8,}}+",
    "key": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\d.])(?:\d{16}|\d{4}(?: \d{4}){3}|\d{4}(?:-\d{4}){3})(?!\d)",
    "phone": (rf"(?<![\w.])(?:(?:{_LOCAL}|{_AREA}|{_TRUNK})(?!\w|[.,:]\d)"
              r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d))"),
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)",
    "name": rf"(?<!\p{{L}}){_TITLE}{_NAME}",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Rows without any of these hold no entity; a cheap first look.
_HINT = (r"@|[0-9]{2}|[0-9]\.[0-9]{1,3}\.[0-9]|(?i:password|passwd|secret|token|api_?key)"
         rf"|{_KEY_HEAD}|{_TITLE}\p{{Lu}}")
_ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _stream(seed: Column) -> Column:
    """Hash bytes of a seed as 256 hex digits."""
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(4)])


def _draw(stream: Column, i: Column, n: int) -> Column:
    """The i-th number of a stream (cyclic), below ``n``."""
    h = F.conv(F.substr(stream, F.pmod(i, F.lit(63)) * 4 + 1, F.lit(4)), 16, 10).cast("int")
    return F.pmod(h, F.lit(n))


def _pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def _same_kind(s: Column, stream: Column, letters: int = 26) -> Column:
    """``s`` with every digit and ASCII letter drawn anew, case kept."""
    low, up = F.lit(_ALPHABET), F.lit(_ALPHABET.upper())

    def char(c: Column, i: Column) -> Column:
        return (F.when(c.rlike("[0-9]"), _draw(stream, i, 10).cast("string"))
                .when(c.rlike("[a-z]"), F.substr(low, _draw(stream, i, letters) + 1, F.lit(1)))
                .when(c.rlike("[A-Z]"), F.substr(up, _draw(stream, i, letters) + 1, F.lit(1))).otherwise(c))

    return F.array_join(F.transform(F.split(s, ""), char), "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def parsed(raw: Column) -> Column:
    """(type, head, core, canon) of an entity: ``head`` stays in place, ``core``
    is replaced, ``canon`` is the same for all its spellings."""
    at = lambda p: raw.rlike(rf"\A(?:{p})\z")
    # lookarounds see nothing beyond the entity here, so its own shape decides
    kind = (F.when(raw.rlike(rf"\A{_ASSIGN}"), "secret").when(raw.contains("@"), "email")
            .when(raw.rlike(rf"\A(?:{_KEY_HEAD})"), "key").when(at(r"[A-Z]{2}\d{2}.*"), "iban")
            .when(at(r"\d{16}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}"), "card")
            .when(at(r"\d{3}-\d{2}-\d{4}"), "ssn").when(at(PATTERNS["ip"]), "ip")
            .when(raw.rlike(r"\A[+(0-9]"), "phone").otherwise("name"))
    head = (F.when(kind == "secret", F.regexp_extract(raw, rf"\A{_ASSIGN}", 0))
            .when(kind == "key", F.regexp_extract(raw, rf"\A(?:{_KEY_HEAD})", 0))
            .when(kind == "name", F.regexp_extract(raw, rf"\A{_TITLE}", 0)).otherwise(""))
    core = F.substr(raw, F.char_length(head) + 1)
    sex = lambda g: head.rlike(rf"(?<!\p{{L}}){_titles(g, g)}")
    gender = F.when(sex("f"), "f:").when(sex("m"), "m:").otherwise("n:")
    # a number in the North American form is the same with and without its country digit
    phone = F.concat(F.when(at(r"\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}"), "1").otherwise(""), _digits(core))
    canon = (F.when(kind == "phone", phone).when(kind == "card", _digits(core)).when(kind.isin("email", "iban"), F.lower(core))
             .when(kind == "name", F.concat(gender, _spaced(core))).otherwise(core))
    return F.struct(kind.alias("type"), head.alias("head"), core.alias("core"), canon.alias("canon"))


def _spaced(name: Column) -> Column:
    """A name in lower case, with one space between its words."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"\.(?=[^\s\u00A0.-])", ". "), r"[\s\u00A0]+", " ")


def _bare(canon: Column) -> Column:
    return F.substr(canon, F.lit(3))


def _words(canon: Column) -> Column:
    return F.split(_bare(canon), " ")


def with_names(hit: DataFrame, found: Column) -> DataFrame:
    """``hit`` with ``__sn``, the canonical titled names among a row's entities in
    their order (a neutral title takes the gender that the row gives the same
    name), and the patterns ``__sw`` of whole names of several words and ``__ss``
    of single words of names, but initials and particles; null without any."""
    titled = F.filter(found, lambda r: r.rlike(rf"\A{_TITLE}\p{{Lu}}"))
    hit = hit.withColumn("__sn", F.array_distinct(F.transform(titled, lambda r: parsed(r)["canon"])))
    hit = hit.withColumn("__sn", F.filter("__sn", lambda c: ~(c.startswith("n:") & F.exists(
        "__sn", lambda o: (_bare(o) == _bare(c)) & ~o.startswith("n:")))))
    whole = F.filter(F.transform("__sn", _bare), lambda n: F.size(F.split(n, " ")).between(2, WHOLE))
    single = F.filter(F.flatten(F.transform("__sn", _words)), lambda w: ~w.rlike(r"\A.\z|\.") & ~w.isin(PARTICLES))

    def either(forms: Column) -> Column:
        longest = F.array_sort(F.array_distinct(forms), lambda a, b: F.char_length(b) - F.char_length(a))
        quoted = F.transform(longest, lambda n: F.replace(F.replace(n, F.lit("."), F.lit(r"\.")), F.lit(" "), F.lit(r"[\s\u00A0]{0,3}")))
        some = F.concat(F.lit(r"(?<![\p{L}\p{M}\p{N}])(?=\p{Lu})(?iu:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}@])"))
        return F.when(F.size(forms) > 0, some)

    return hit.withColumns({"__sw": either(whole), "__ss": either(single)})


def resolved(raw: Column, e: Column, names: Column) -> Column:
    """``parsed`` entity ``e`` with the name in its row that it mentions, and
    ``word``: the place of a single word in that name, 0 for the whole."""
    first = lambda fits: F.get(F.filter(names, fits), F.lit(0))
    spoken = _spaced(raw)
    mention = F.when(e["type"] == "name", first(lambda c: _bare(c) == spoken))
    neutral = F.when((e["type"] == "name") & e["canon"].startswith("n:"), first(lambda c: _bare(c) == _bare(e["canon"])))
    part = F.when((e["type"] == "name") & (e["head"] == ""), first(lambda c: F.array_contains(_words(c), spoken)))
    whole = F.coalesce(mention, neutral)
    return F.struct(
        e["type"].alias("type"), F.when(mention.isNotNull(), "").otherwise(e["head"]).alias("head"),
        F.when(mention.isNotNull(), raw).otherwise(e["core"]).alias("core"), F.coalesce(whole, part, e["canon"]).alias("canon"),
        F.when(whole.isNull() & part.isNotNull(), F.array_position(_words(part), spoken)).otherwise(0).cast("int").alias("word"))


def _luhn(digits: Column) -> Column:
    """``digits`` (an odd count) with the check digit that makes them valid."""
    total = F.aggregate(F.transform(F.split(digits, ""), lambda c, i: (
        F.when(F.pmod(i, F.lit(2)) == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
        .otherwise(c.cast("int")))), F.lit(0), lambda a, x: a + x)
    return F.concat(digits, F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))


def _name(canon: Column, stream: Column, attempt: Column) -> Column:
    """A made-up name of the same gender, script and number of words; initials
    stay initials until the form widens, particles stay. Each attempt adds a
    syllable, so there is always a free one."""
    def word(script: str, gender: str):
        starts, middles, ends = SYLLABLES[script]

        def make(w: Column, i: Column) -> Column:
            letter = lambda c, k: F.when(c.rlike(r"\p{L}"), F.substr(_pick(starts, _draw(stream, i * 31 + k, len(starts))), F.lit(1), F.lit(1))).otherwise(c)
            body = F.transform(F.sequence(F.lit(0), attempt + 1), lambda k: _pick(middles, _draw(stream, i * 31 + k + 7, len(middles))))
            made = F.concat(_pick(starts, _draw(stream, i, len(starts))), F.array_join(body, ""),
                            _pick(ends[gender], _draw(stream, i + 3, len(ends[gender]))))
            return (F.when(w.isin(PARTICLES), w).when(w.rlike(r"\A.\z|\.") & (attempt < WIDEN), F.array_join(F.transform(F.split(w, ""), letter), ""))
                    .otherwise(made))
        return make

    words = _words(canon)
    out = None
    for script, pattern in (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"), ("latin", ".")):
        for gender in ("f", "m", "n"):
            fits = canon.startswith(gender + ":") & F.substr(canon, F.lit(3)).rlike(pattern)
            value = F.array_join(F.transform(words, word(script, gender)), " ")
            out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def surrogate(kind: Column, canon: Column, attempt: Column, stream: Column) -> Column:
    """The surrogate's canonical form, from the hash bytes of an entity."""
    wide = attempt >= WIDEN
    same = _same_kind(canon, stream)
    hexa = F.when(canon.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"), _same_kind(canon, stream, 6)).otherwise(same)
    tld = F.regexp_extract(canon, r"\.[a-z]{2,24}\z", 0)
    mail = F.concat(F.when(wide, _same_kind(F.lit("aaaa"), F.sha2(stream, 256))).otherwise(""),
                    F.substr(same, F.lit(1), F.char_length(canon) - F.char_length(tld)), tld)
    card = _luhn(F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(same, F.lit(2), F.lit(14))))
    code = F.regexp_extract(canon, r"\A(?:1[2-9](?=\d{9}\z)|00|.)", 0)
    phone = F.concat(code, F.substr(same, F.char_length(code) + 1))
    net = F.array_join(F.transform(F.split(canon, r"\."), lambda p, i: (
        F.when(wide, _draw(stream, i, 254) + 1).when(F.char_length(p) == 1, _draw(stream, i, 9) + 1)
        .when(F.char_length(p) == 2, _draw(stream, i, 90) + 10).otherwise(_draw(stream, i, 155) + 100)).cast("string")), ".")
    iban = F.concat(F.substr(canon, F.lit(1), F.lit(2)), F.substr(same, F.lit(3)))
    return (F.when(kind == "email", mail).when(kind == "card", card).when(kind == "phone", phone).when(kind == "ip", net)
            .when(kind == "iban", iban).when(kind == "name", _name(canon, stream, attempt)).when(kind == "secret", hexa)
            .otherwise(same))


def written_like(kind: Column, head: Column, core: Column, value: Column, word: Column) -> Column:
    """The surrogate in the format of one occurrence, or its ``word``."""
    # a phone without its country digit is the end of the whole number
    skip = F.greatest(F.char_length(value) - F.char_length(_digits(core)), F.lit(0))
    digits = F.array_join(F.transform(F.split(core, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substr(value, skip + F.char_length(_digits(F.substr(core, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
    shouted = (core == F.upper(core)) & (core != F.lower(core))
    # the spaces between the words of a name are those of the occurrence
    words = F.split(value, " ")
    gaps = F.regexp_extract_all(core, F.lit(r"(?<=\.)(?=[^\s\u00A0.-])|[\s\u00A0]+"), F.lit(0))
    name = F.when(word > 0, F.get(words, word - 1)).otherwise(
        F.array_join(F.zip_with(words, gaps, lambda w, g: F.concat(w, F.coalesce(g, F.lit("")))), ""))
    text = F.when(kind.isin("card", "phone"), digits).when(kind == "name", name).otherwise(value)
    return F.concat(head, F.when(kind.isin("email", "name", "iban") & shouted, F.upper(text)).otherwise(text))


def _original(kind: Column, canon: Column) -> Column:
    return F.when(kind == "name", F.substr(canon, F.lit(3))).otherwise(canon)


def surrogate_table(entities: DataFrame, key: str = KEY, attempts: int = 64) -> DataFrame:
    """(type, canon, value) for the distinct entities (type, canon), without
    collisions. Each round draws again for the entities in conflict."""
    table = written(entities.select("type", "canon", F.lit(0).alias("attempt")).distinct(), "entities")
    taken = table.select(F.col("type").alias("_t"), _original(F.col("type"), F.col("canon")).alias("_o")).distinct()
    for _ in range(attempts):
        # a column of its own, hashed once for all letters of an entity
        seeded = table.withColumn("stream", _stream(F.concat_ws("|", F.lit(key), "type", "canon", F.col("attempt").cast("string"))))
        drawn = written(seeded.withColumn("value", surrogate(*map(F.col, ("type", "canon", "attempt", "stream")))).drop("stream"), "surrogates")
        first = drawn.groupBy("type", F.lower("value").alias("_v")).agg(F.min("canon").alias("_first"))
        j = (drawn.withColumn("_v", F.lower("value")).join(first, ["type", "_v"])
             .join(taken, (F.col("type") == F.col("_t")) & (F.col("_v") == F.lower("_o")), "left"))
        odd = (F.col("canon") != F.col("_first")) | F.col("_o").isNotNull()
        table = written(j.select("type", "canon", (F.col("attempt") + odd.cast("int")).alias("attempt"), odd.alias("odd")), "entities")
        if table.where("odd").isEmpty():
            return drawn.select("type", "canon", "value")
        table = table.drop("odd")
    raise RuntimeError("surrogates still collide")


def replace_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text_col``, plus ``n_entities``."""
    text = F.col(f"`{text_col}`")
    has = F.coalesce(text.rlike(_HINT) & text.rlike(ENTITY), F.lit(False))
    hit = with_names(docs.where(has), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    pattern = F.concat_ws("|", "__sw", F.lit(ENTITY), "__ss")
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    hit = replaced(hit, n_entities=F.size(found).cast("bigint")).withColumns(
        {"__sid": F.col(f"`{id_col}`").cast("string"), "__sh": F.xxhash64(text)})
    hit = written(hit, "entity-rows")
    marks = hit.select("__sid", "__sh", "__sn", F.posexplode(found).alias("pos", "raw"))
    marks = marks.select("__sid", "__sh", "__sn", "pos", "raw", parsed(F.col("raw")).alias("e"))
    marks = marks.select("__sid", "__sh", "pos", resolved(F.col("raw"), F.col("e"), F.col("__sn")).alias("e")).select("__sid", "__sh", "pos", "e.*")
    table = written(surrogate_table(marks.select("type", "canon"), key), "surrogate-table")
    new = marks.join(table, ["type", "canon"]).select("__sid", "__sh", F.struct(
        "pos", written_like(F.col("type"), F.col("head"), F.col("core"), F.col("value"), F.col("word")).alias("s")).alias("m"))
    new = new.groupBy(F.col("__sid").alias("__si"), F.col("__sh").alias("__sg")).agg(F.array_sort(F.collect_set("m")).alias("__sm"))
    between = F.split(text, pattern, -1)
    rebuilt = F.array_join(F.zip_with(between, F.col("__sm.s"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    done = hit.join(new, hit["__sid"].eqNullSafe(new["__si"]) & (hit["__sh"] == new["__sg"])).select(
        *[rebuilt.alias(c) if c == text_col else F.col(f"`{c}`") for c in hit.columns if c not in ("__sid", "__sh", "__sn", "__sw", "__ss")])
    return replaced(docs.where(~has), n_entities=F.lit(0).cast("bigint")).unionByName(done)


def surrogate_report(docs: DataFrame) -> DataFrame:
    """Every document with its surrogates in place."""
    return replace_entities(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", "n_entities", "text")
