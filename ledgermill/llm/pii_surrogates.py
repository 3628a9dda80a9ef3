"""Surrogates for personal data: detected entities get keyed replacements of the same kind.

1. Rows are cut at the matches of one expression: pieces of text and entities between them.
2. Each distinct entity of the corpus gets a candidate from a keyed digest (SHA-256): digits become
   digits, letters letters of the same case and script (of scripts without an alphabet here: Latin ones), separators stay; card numbers keep a valid
   check digit, addresses stay addresses, names keep gender (by title or ending) and script.
3. Candidates that two entities share, or that are themselves entities of the corpus, are found by grouping and
   joining, and the losers draw again until none is left. So entities stay distinct, and one entity has one
   surrogate in all documents.
4. Rows are put together again from pieces and surrogates.

Everything is a DataFrame expression. Mail addresses are drawn in two parts, so addresses that share
a domain still do; names word by word, so "Mrs. Ada Byron" and "Mrs. Byron" still share a surname. A surname that a title
announces anywhere in a text is a name at all its mentions there, with the capitalised word or two before it as given names (of two, the first
must not begin a sentence) and the gender of its title.

A corpus that uses up a format widens it: see ``surrogates``. Texts are searched once; they are staged with what was found (one copy of the table).
The key is part of the plan: give a key derived for the run, not the secret itself, where plans or event logs are kept.

Defined results: a null text stays null with no entities, an empty one empty. Repeated rows get equal results.
Text without entities is returned as it is. A column of the input named like ``count`` gives way to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import HOT_SHARE, join_hot, stage

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Kind -> expression, tried in this order at each place.
KINDS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}_%+-]++(?:\.[\p{L}\p{M}\p{N}_%+-]++)*+@(?:[\p{L}\p{M}\p{N}-]+\.)+[\p{L}\p{M}]{2,}(?![\p{L}\p{M}\p{N}])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)",
    "secret": r"(?<![\p{L}\p{N}])(?=[0-9A-Fa-f]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.-])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
}
#: Titles that announce a name, by gender ("n": either).
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "госпожа"),
    "n": ("Dr", "Prof", "Professor"),
}
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
#: A closing 's is no part of a name.
_NAME_WORD = r"\p{Lu}(?:\p{L}|(?!['’]s(?!\p{L}))['’-](?=\p{L}))++"
KINDS["name"] = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? {_NAME_WORD}(?: {_NAME_WORD}){{0,2}}"
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: A text without this has no entity; it spares most texts the full expression.
HINT = rf"@[\p{{L}}\p{{M}}\p{{N}}-]|\d[ .()-]?\d|[0-9a-f]{{32}}|[0-9A-F]{{32}}|(?:{_TITLE})\.? \p{{Lu}}"

#: Attempts after which formats grow.
WIDEN = 6

#: Syllables that names are drawn from, by script.
SYLLABLES = {
    "latin": ("ba", "be", "bo", "ca", "da", "de", "do", "fa", "ga", "go", "ha", "ho", "ka", "ke", "ko", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "ni", "no", "ra", "re", "ri", "ro", "sa"),
    "cyrillic": ("ба", "бе", "бо", "ва", "да", "де", "до", "га", "го", "ка", "ке", "ко", "ла", "ле", "ли", "ло", "ма", "ме", "ми", "мо", "на", "не", "ни", "но", "ра", "ре", "ри", "ро", "са", "се", "та", "то"),
    "greek": ("βα", "βε", "βο", "γα", "γο", "δα", "δε", "δο", "κα", "κε", "κο", "λα", "λε", "λι", "λο", "μα", "με", "μι", "μο", "να", "νε", "νι", "νο", "ρα", "ρε", "ρι", "ρο", "σα", "σε", "τα", "τε", "το"),
}
#: Last letters of given names, by script and gender.
ENDINGS = {"latin": {"m": "n", "f": "na", "n": "l"}, "cyrillic": {"m": "н", "f": "на", "n": "ль"}, "greek": {"m": "ς", "f": "να", "n": "λ"}}


def _draw(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    """128 hex digits that only the key's owner can tell from the entity."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(seed, F.lit("\x1f0")), 256), F.sha2(F.concat(seed, F.lit("\x1f1")), 256))


def _byte(draw: Column, at: Column) -> Column:
    return F.conv(F.substring(draw, F.lit(1) + 2 * (at % 64), F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), F.lit(1) + number % len(alphabet), F.lit(1))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _same_shape(text: Column, draw: Column) -> Column:
    """Each character replaced by one of its class; separators stay."""
    classes = (
        ("0123456789", r"^[0-9]$"), ("abcdefghijklmnopqrstuvwxyz", r"^[a-z]$"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"^[A-Z]$"),
        ("абвгдежзиклмнопрстуфхцчшэюя", r"^[\p{IsCyrillic}&&\p{Ll}]$"), ("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", r"^[\p{IsCyrillic}&&\p{Lu}]$"),
        ("αβγδεζηθικλμνξοπρστυφχψω", r"^[\p{IsGreek}&&\p{Ll}]$"), ("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", r"^[\p{IsGreek}&&\p{Lu}]$"),
        ("人山水木金土日月火田石竹米花雨雪風海空星", r"^\p{IsHan}$"), ("àáâäçèéêëíîïñóôöùúûü", r"^[\p{IsLatin}&&\p{Ll}]$"), ("ÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ", r"^[\p{IsLatin}&&\p{Lu}]$"),
        ("ابتثجحخدذرزسشصضطعغفقكلمنهوي", r"^[\p{IsArabic}&&[\p{L}\p{M}]]$"), ("אבגדהוזחטיכלמנסעפצקרשת", r"^[\p{IsHebrew}&&[\p{L}\p{M}]]$"),
        ("가나다라마바사아자차카타하고노도로모보소오조", r"^[\p{IsHangul}&&\p{L}]$"), ("あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよ", r"^[\p{IsHiragana}&&\p{L}]$"),
        ("アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨ", r"^[ー\p{IsKatakana}&&\p{L}]$"), ("กขคงจฉชซดตถทธนบปผพฟมยรลวสหอ", r"^[\p{IsThai}&&[\p{L}\p{M}]]$"),
        ("कखगघचछजझटठडढतथदधनपफबभमयरलवशसह", r"^[\p{IsDevanagari}&&[\p{L}\p{M}]]$"),
        # whatever else is a digit or letter (marks belong to letters)
        ("0123456789", r"^\p{N}$"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"^\p{Lu}$"), ("abcdefghijklmnopqrstuvwxyz", r"^[\p{L}\p{M}]$"),
    )

    def one(c: Column, i: Column) -> Column:
        number, out = _byte(draw, i), c
        for alphabet, shape in reversed(classes):
            out = F.when(c.rlike(shape), _pick(alphabet, number)).otherwise(out)
        return out

    return F.array_join(F.transform(_characters(text), one), "")


def _hex_shape(text: Column, draw: Column) -> Column:
    """Hex digits for hex digits, in the entity's case."""
    drawn = F.array_join(F.transform(_characters(text), lambda c, i: _pick("0123456789abcdef", _byte(draw, i))), "")
    return F.when(text == F.upper(text), F.upper(drawn)).otherwise(drawn)


def _ip(draw: Column) -> Column:
    return F.concat_ws(".", (_byte(draw, F.lit(0)) % 223 + 1).cast("string"), *[_byte(draw, F.lit(k)).cast("string") for k in (1, 2, 3)])


def _check_sum(digits: Column) -> Column:
    """Luhn sum of a string of digits."""
    value = F.transform(F.reverse(_characters(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(value, F.lit(0), lambda s, x: s + x)


def _card(text: Column, draw: Column) -> Column:
    """First digit (the network) and separators stay; a valid number stays valid."""
    drawn = F.concat(F.substring(text, F.lit(1), F.lit(1)), F.substring(_same_shape(text, draw), F.lit(2), F.length(text) - 2))
    off = _check_sum(F.concat(F.regexp_replace(drawn, r"\D", ""), F.lit("0"))) % 10
    check = F.when(_check_sum(F.regexp_replace(text, r"\D", "")) % 10 == 0, (10 - off) % 10).otherwise(_byte(draw, F.lit(63)) % 10)
    return F.concat(drawn, check.cast("string"))


def _phone(text: Column, draw: Column) -> Column:
    """The country code stays."""
    code = F.regexp_extract(text, r"^\+\d{1,3}(?=[ .(-])|^\+\d", 0)
    return F.concat(code, F.substring(_same_shape(text, draw), F.length(code) + 1, F.length(text)))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _name(kind: Column, word: Column, draw: Column, attempt: Column) -> Column:
    """A name word from syllables of its script; ``kind`` is surname or given-<gender>; later attempts are longer."""
    def of(script: str) -> Column:
        table = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        many = F.least(F.lit(12), F.lit(3) + F.floor(attempt / 3).cast("int"))
        body = F.array_join(F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.get(table, _byte(draw, i) % len(SYLLABLES[script]))), "")
        end = F.when(kind == "surname", "")
        for gender, letters in ENDINGS[script].items():
            end = end.when(kind == f"given-{gender}", letters)
        return F.concat(body, F.coalesce(end, F.lit("")))

    script = _script(word)
    name = F.initcap(F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin")))
    return F.when((F.upper(word) == word) & (F.length(word) > 1), F.upper(name)).otherwise(name)


def _candidate(key: str) -> Column:
    kind, entity, attempt = F.col("kind"), F.col("entity"), F.col("attempt")
    draw = F.col("_draw")
    drawn = (
        F.when(kind == "ip", _ip(draw)).when(kind == "secret", _hex_shape(entity, draw)).when(kind == "card", _card(entity, draw))
        .when(kind == "phone", _phone(entity, draw)).when(kind == "iban", F.concat(F.substring(entity, 1, 2), F.substring(_same_shape(entity, draw), F.lit(3), F.length(entity))))
        .when(kind.startswith("given-") | (kind == "surname"), _name(kind, entity, draw, attempt)).otherwise(_same_shape(entity, draw))
    )
    # short mailboxes are soon used up; other formats grow only after many attempts
    longer = F.when(kind.isin("mailbox", "domain"), F.floor((attempt - 3) / 3)).otherwise(F.floor((attempt - WIDEN) / 2) + 1)
    return F.concat(drawn, F.substring(F.translate(draw, "abcdef", "012345"), F.lit(1), F.greatest(F.lit(0), longer.cast("int"))))


def _readable(entity: Column, surrogate: Column) -> Column:
    """Whether the entity can still be read in a surrogate: as its beginning or, for mail addresses, by its letters."""
    letters = lambda c: F.regexp_replace(c, r"[^\p{L}\p{M}]", "")
    mail = F.col("kind").isin("mailbox", "domain") & (letters(entity) != "")
    return surrogate.startswith(entity) | (mail & letters(surrogate).contains(letters(entity)))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): distinct inside a kind, and no entity of the corpus.

    Where the corpus leaves a format hardly a free value, surrogates get longer: from attempt ``WIDEN`` on by one digit every other attempt
    (names by syllables, mailboxes and domains sooner), so the draws come to an end whatever the corpus holds.
    """
    todo = stage(entities.withColumn("attempt", F.lit(0)), "entities")
    used = entities.select("kind", F.col("entity").alias("surrogate"))
    done = []
    while True:
        drawn = todo.withColumn("_draw", _draw(key, F.col("kind"), F.col("entity"), F.col("attempt")))
        drawn = drawn.select("kind", "entity", "attempt", _candidate(key).alias("surrogate"))
        drawn = stage(drawn, "candidates")
        # one entity may keep a candidate (the smallest), unless it is in use or real
        first = drawn.where(~_readable(F.col("entity"), F.col("surrogate"))).groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        kept = stage(first.join(used, ["kind", "surrogate"], "left_anti").select("kind", "entity", "surrogate"), "kept")
        done.append(kept)
        used = used.union(kept.select("kind", "surrogate"))
        left = drawn.join(kept.select("kind", "entity"), ["kind", "entity"], "left_anti")
        todo = stage(left.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "again")
        if todo.isEmpty():
            return reduce(DataFrame.union, done)


def _kind(entity: Column) -> Column:
    out = F.lit("name")
    for kind, shape in reversed([k for k in KINDS.items() if k[0] != "name"]):
        # the look-arounds held where the match was found
        out = F.when(entity.rlike(rf"^(?:{shape})$"), kind).otherwise(out)
    return out


def _gender(title: Column) -> Column:
    bare = F.regexp_replace(title, r"\.$", "")
    return F.when(bare.isin(*TITLES["m"]), "m").when(bare.isin(*TITLES["f"]), "f").otherwise("n")


_TITLED = rf"^(?:{_TITLE})\.? "


def _known_names(found: Column) -> Column:
    """Array of (surname, given, gender) of the names that a title announces."""
    def one(entity: Column) -> Column:
        words = F.split(entity, " ")
        given = F.array_join(F.slice(words, F.lit(2), F.size(words) - 2), " ")
        return F.struct(F.element_at(words, -1).alias("surname"), given.alias("given"), _gender(F.get(words, F.lit(0))).alias("gender"))

    return F.transform(F.filter(found, lambda e: e.rlike(_TITLED)), one)


def _mentions(known: Column) -> Column:
    """The expression of every entity, and of the known names without title: whole, or a surname with given names."""
    full = F.filter(F.transform(known, lambda k: F.concat_ws(" ", k["given"], k["surname"])), lambda n: n.contains(" "))
    longest_first = F.transform(F.sort_array(F.transform(F.array_distinct(full), lambda n: F.struct((-F.length(n)).alias("size"), n.alias("name")))), lambda x: x["name"])
    surnames = F.array_join(F.array_distinct(F.transform(known, lambda k: k["surname"])), "|")
    loose = F.concat(F.lit(rf"(?:(?<!^)(?<![.!?\n] )(?<!\n){_NAME_WORD} )?(?:{_NAME_WORD} )?(?:"), surnames, F.lit(")"))
    return F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(F.concat(longest_first, F.array(loose)), "|"), F.lit(r")(?![\p{L}\p{N}])"))


def _gender_of(entity: Column, known: Column) -> Column:
    """The gender of a mention without title: that of the same name with one, else of the first such surname."""
    words = F.split(entity, " ")
    given = F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " ")
    family = F.filter(known, lambda k: k["surname"] == F.element_at(words, -1))
    same = F.filter(family, lambda k: k["given"] == given)
    return F.coalesce(F.get(same, F.lit(0))["gender"], F.get(family, F.lit(0))["gender"], F.lit("n"))


def _parts(entity: Column, kind: Column, known: Column) -> Column:
    """An entity's drawn parts: array of (kind, entity), with text that stays as kind null."""
    part = lambda k, e: F.struct(k.alias("kind"), e.alias("entity"))
    stays = F.lit(None).cast("string")
    domain = F.regexp_extract(entity, r"@(.*)\.", 1)
    mail = F.array(
        part(F.lit("mailbox"), F.regexp_extract(entity, r"^([^@]*)", 1)), part(stays, F.lit("@")), part(F.lit("domain"), domain),
        part(stays, F.regexp_extract(entity, r"(\.[^.@]*)$", 1)),
    )
    words = F.split(entity, " ")
    titled = entity.rlike(_TITLED)
    gender = F.when(titled, _gender(F.get(words, F.lit(0)))).otherwise(_gender_of(entity, known))
    names = F.flatten(F.transform(words, lambda w, i: F.when((i == 0) & titled, F.array(part(stays, w))).otherwise(F.array(
        part(stays, F.when(i == 0, "").otherwise(" ")), part(F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given-"), gender)), w)))))
    return F.when(kind == "email", mail).when(kind == "name", names).otherwise(F.array(part(kind, entity)))


def replace(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``count`` names a column for the number of entities."""
    names = [c for c in docs.columns if c != count]
    rest = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names) if c != text]
    own = docs.select(F.struct(F.lit(0).alias("c"), *rest).alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"))
    some = F.coalesce(F.col("_text").rlike(HINT), F.lit(False))
    matches = F.when(some, F.regexp_extract_all("_text", F.lit(ANY), 0)).otherwise(F.array().cast("array<string>"))
    cut = stage(own.withColumn("_found", matches), "pii-texts")  # the only search of all texts
    hits = cut.where(F.size("_found") > 0).withColumn("_known", _known_names(F.col("_found")))
    pattern = F.when(F.size("_known") > 0, _mentions(F.col("_known"))).otherwise(F.lit(ANY))
    hits = hits.withColumn("_pattern", pattern).withColumn("_found", F.when(F.size("_known") > 0, F.regexp_extract_all("_text", F.col("_pattern"), 0)).otherwise(F.col("_found")))
    pieces = F.when(F.size("_known") > 0, F.split("_text", F.col("_pattern"), -1)).otherwise(F.split("_text", ANY, -1))
    hits = stage(hits.select(F.monotonically_increasing_id().alias("_id"), "_row", "_found", "_known", pieces.alias("_pieces")), "pii-hits")  # fixes the ids
    parts = hits.select("_id", "_known", F.posexplode("_found").alias("_at", "_entity")).withColumn("_kind", _kind(F.col("_entity")))
    parts = parts.select("_id", "_at", F.posexplode(_parts(F.col("_entity"), F.col("_kind"), F.col("_known"))).alias("_nth", "_part")).select("_id", "_at", "_nth", "_part.*")
    parts = stage(parts, "pii-parts")
    drawn = parts.where(F.col("kind").isNotNull())
    totals = stage(drawn.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n")), "pii-entities")
    all_parts = parts.count()
    known = stage(surrogates(totals.select("kind", "entity"), key).join(totals, ["kind", "entity"]).withColumn("_key", F.concat_ws("\x1f", "kind", "entity")).select("_key", "surrogate", "n"), "pii-surrogates")
    replaced = join_hot(drawn.withColumn("_key", F.concat_ws("\x1f", "kind", "entity")).select("_id", "_at", "_nth", "_key"), known, "_key", F.col("n") > max(1000, all_parts * HOT_SHARE))
    stays = parts.where(F.col("kind").isNull()).select("_id", "_at", "_nth", F.col("entity").alias("new"))
    both = replaced.select("_id", "_at", "_nth", F.col("surrogate").alias("new")).union(stays)
    # first the parts of an entity, then a row's entities: as many as its text holds
    entities = both.repartition("_id").groupBy("_id", "_at").agg(F.sort_array(F.collect_list(F.struct("_nth", "new"))).alias("_parts"))
    entities = entities.select("_id", F.struct("_at", F.lit(1).alias("_then"), F.array_join(F.transform("_parts", lambda x: x["new"]), "").alias("text")).alias("_one"))
    rows = entities.groupBy("_id").agg(F.collect_list("_one").alias("_new"))
    whole = hits.join(rows, "_id")
    # piece k stands before entity k
    pieces = F.transform("_pieces", lambda piece, at: F.struct(at.alias("_at"), F.lit(0).alias("_then"), piece.alias("text")))
    built = F.array_join(F.transform(F.sort_array(F.concat(pieces, F.col("_new"))), lambda x: x["text"]), "")
    changed = whole.select("_row", built.alias("_text"), F.size("_found").cast("long").alias("_n"))
    same = cut.where(F.size("_found") == 0).select("_row", "_text", F.lit(0).cast("long").alias("_n"))
    out = changed.union(same)
    columns = [F.col("_text").alias(text) if c == text else F.col(f"_row.c{k}").alias(c) for k, c in enumerate(names)]
    return out.select(*columns, *([F.col("_n").alias(count)] if count else []))
