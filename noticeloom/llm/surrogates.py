"""Personal data replaced by surrogates of the same kind. DataFrame functions only.

Entities are found by patterns, each with its type. A surrogate is drawn from a keyed hash of the
entity's type and plain form, so an entity has one surrogate wherever and however it is written, and
keeps type and format: an address stays an address with the same parts, a card number keeps its
issuer digit, grouping and check digit, a phone number its country, a name its title, gender and script.
Before any text is touched, the distinct entities of all documents get their surrogates checked: where
two share one, or one is somebody's real value, all but one draw again until none is left.

Distinct entities are combined before each shuffle, so one that fills a third of all texts is one row
per task. Only texts that hold an entity are shuffled, by their digest; the others pass as they are read.

Looked for are the forms of ``TYPES`` and nothing else: names behind a listed title; phone numbers with + or in
the national forms of ``PHONE``, not numbers of under nine digits or without any separator; cards of 13 to 19 digits
in a row, of 4-4-4-4 or 4-6-5. Names without a title, street addresses, dates of birth, account, tax and passport
numbers, IPv6 and user names are not looked for and stay.

Defined results: a null text stays null and an empty one empty; repeated rows and null ids are treated
alike, for a row's replacement depends on its text and the entities of the corpus; texts may be of any
length; an empty table gives an empty result; other columns pass whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind
from noticeloom.llm.common import columns_of, stored

# How each type of entity is written.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"
# International numbers; national ones with an area code in brackets, of 3-3-4 digits, of five pairs, or a trunk zero and one group.
PHONE = (
    r"(?:(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}(?![0-9])"
    r"|(?<![\p{L}0-9+])(?<![0-9][.-])(?:(?:1[ .-]?)?\([0-9]{3,5}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
    r"|0[1-9](?:[ .-][0-9]{2}){4}|0[0-9]{2,4}[ /-][0-9]{6,8})(?![0-9]|[.-][0-9]))"
)
MALE = r"(?:Mr|Herr|Monsieur|Señor|Г-н)\.? "
FEMALE = r"(?:Mrs|Ms|Miss|Frau|Madame|Señora|Г-жа)\.? "
NAME = r"(?<![\p{L}\p{N}])(?:" + MALE + "|" + FEMALE + r"|Dr\.? )\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+)?"
TYPES = {"email": EMAIL, "card": CARD, "ipv4": IPV4, "phone": PHONE, "name": NAME}
ANY = "|".join(f"(?:{p})" for p in TYPES.values())
HINT = r"[0-9@]|(?:Mr|Mrs|Ms|Miss|Dr|Herr|Frau|Monsieur|Madame|Señora?|Г-н|Г-жа)\.? \p{Lu}"  # no entity without one
TITLE = r"^(\S+ )"
DRAWS = 6  # turns after which a surrogate that still clashes takes a wider form
ENDINGS = {"male": "o", "female": "a", "either": "e"}


def type_of(value: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(TYPES.items()):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def plain_of(kind: Column, value: Column) -> Column:
    """The form all spellings of an entity share."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    gender = F.when(value.rlike("^" + MALE), "male").when(value.rlike("^" + FEMALE), "female").otherwise("either")
    name = F.concat_ws("/", gender, F.lower(F.regexp_replace(value, TITLE, "")))
    return F.when(kind == "email", F.lower(value)).when(kind.isin("card", "phone"), digits).when(kind == "name", name).otherwise(value)


def _number(hash_: Column, i: Column) -> Column:
    """The i-th of the hash's numbers from 0 to 255; they come round again after 64."""
    return F.conv(F.substr(hash_, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _chars(value: Column, hash_: Column) -> Column:
    """Each letter and digit replaced by one of its script, case and kind; other characters stay."""

    def drawn(h: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            return bind(_number(h, i), lambda n: replaced(c, n))

        return F.array_join(F.transform(F.split(value, "", -1), one), "")

    def replaced(c: Column, n: Column) -> Column:
        kinds = (
            ("[0-9]", "0", 10), (r"[\p{IsLatin}&&\p{Ll}]", "a", 26), (r"[\p{IsLatin}&&\p{Lu}]", "A", 26),
            (r"[\p{IsCyrillic}&&\p{Ll}]", "а", 32), (r"[\p{IsCyrillic}&&\p{Lu}]", "А", 32),
            (r"[\p{IsGreek}&&\p{Ll}]", "σ", 7), (r"[\p{IsGreek}&&\p{Lu}]", "Σ", 7), (r"\p{IsHan}", "一", 256),
        )
        code = F.lit(None).cast("int")
        for pattern, first, many in reversed(kinds):
            code = F.when(c.rlike(pattern), F.lit(ord(first)) + n % many).otherwise(code)
        char = bind(code, lambda x: F.decode(F.unhex(F.lpad(F.hex(x), 8, "0")), "UTF-32"))
        return F.coalesce(char, c)

    return bind(hash_, drawn)


def _checked(digits: Column) -> Column:
    """The last digit set so that the number passes the check of card numbers."""

    def closed(body: Column) -> Column:
        def weighed(d: Column, i: Column) -> Column:
            doubled = (F.length(body) - i) % 2 == 1
            return bind(d.cast("int") * F.when(doubled, 2).otherwise(1), lambda n: F.when(n > 9, n - 9).otherwise(n))

        each = F.transform(F.filter(F.split(body, "", -1), lambda d: d != ""), weighed)
        total = F.aggregate(each, F.lit(0), lambda a, n: a + n)
        return F.concat(body, ((10 - total % 10) % 10).cast("string"))

    return bind(bind(digits, lambda d: F.substr(d, F.lit(1), F.length(d) - 1)), closed)


def surrogate(kind: Column, plain: Column, attempt: Column, key: str) -> Column:
    """The surrogate's plain form: drawn from the keyed hash of type, entity and attempt."""

    def hash_of(what: Column, of: str) -> Column:
        return F.sha2(F.concat_ws("\u001f", F.lit(key), F.lit(of), attempt.cast("string"), what), 512)

    own = hash_of(plain, "entity")
    domain = F.substring_index(plain, "@", -1)
    host = F.regexp_replace(domain, r"\.[a-z]+$", "")
    # Addresses of one domain stay together; a new attempt draws the local part only.
    place = F.sha2(F.concat_ws("\u001f", F.lit(key), F.lit("domain"), host), 512)
    email = F.concat(_chars(F.substring_index(plain, "@", 1), own), F.lit("@"), _chars(host, place), F.regexp_extract(domain, r"\.[a-z]+$", 0))
    card = _checked(F.concat(F.substring(plain, 1, 1), F.substr(_chars(plain, own), F.lit(2))))
    ipv4 = bind(own, lambda h: F.concat_ws(".", F.lit("10"), *[_number(h, F.lit(i)).cast("string") for i in range(3)]))
    phone = F.concat(F.substring(plain, 1, 2), F.substr(_chars(plain, own), F.lit(3)))
    gender, name = F.substring_index(plain, "/", 1), F.substr(plain, F.instr(plain, "/") + 1)
    latin = name.rlike(r"^[\p{IsLatin}' -]+$") & (F.length(name) > 2)
    ending = F.element_at(F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair]), gender)
    ended = bind(_chars(name, own), lambda d: F.when(latin, F.concat(F.substr(d, F.lit(1), F.length(d) - 1), ending)).otherwise(d))
    named = F.concat(gender, F.lit("/"), ended)
    return F.when(kind == "email", email).when(kind == "card", card).when(kind == "ipv4", ipv4).when(kind == "phone", phone).otherwise(named)


def widened(kind: Column, new: Column, attempt: Column, number: Column) -> Column:
    """A surrogate followed by a number: digits of cards and phones, letters of names, a part of e-mail names.

    The number begins with the attempt, so later attempts are longer than any value there is in the end. An IPv4
    address takes the form of a private IPv6 address, since no number can be added to it.
    """
    digits = F.concat(F.repeat(F.lit("9"), attempt - DRAWS + 1), number.cast("string"))

    def spelled(letters: str) -> Column:
        return F.translate(digits, "0123456789", letters)

    letters = F.when(new.rlike(r"\p{IsCyrillic}"), spelled("абвгдежзик")).when(new.rlike(r"\p{IsGreek}"), spelled("αβγδεζηθικ"))
    letters = letters.when(new.rlike(r"\p{IsHan}"), spelled("甲乙丙丁戊己庚辛壬癸")).otherwise(spelled("abcdefghij"))
    email = F.concat(F.substring_index(new, "@", 1), F.lit("."), digits, F.lit("@"), F.substring_index(new, "@", -1))
    ipv6 = F.concat(F.lit("fd00:"), F.repeat(F.lit("0:"), attempt - DRAWS), F.lit(":"), F.lower(F.hex(number)))
    return F.when(kind == "email", email).when(kind == "ipv4", ipv6).when(kind == "name", F.concat(new, letters)).otherwise(F.concat(new, digits))


def written(kind: Column, value: Column, plain: Column) -> Column:
    """A surrogate's plain form in the format of the entity it replaces."""

    def digit(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substr(plain, before + 1, F.lit(1))).otherwise(c)

    own = F.length(F.regexp_replace(value, "[^0-9]", ""))
    spaced = F.concat(F.array_join(F.transform(F.split(value, "", -1), digit), ""), F.substr(plain, own + 1, F.length(plain)))  # a wider form is longer
    name = F.concat(F.regexp_extract(value, TITLE, 1), F.initcap(F.substr(plain, F.instr(plain, "/") + 1)))
    email = F.when(value == F.upper(value), F.upper(plain)).otherwise(plain)
    return F.when(kind.isin("card", "phone"), spaced).when(kind == "name", name).when(kind == "email", email).otherwise(plain)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, plain, new`` of distinct entities; ``new`` is nobody's real value and nobody else's surrogate.

    A few of the drawn values clash in large corpora; those entities draw again, the others keep theirs. What
    still clashes after ``DRAWS`` turns has too small a space, such as two letters or ten digits of which most
    are taken; it is drawn in a wider form that ends in a number of its own, so the turns come to an end.
    """
    drawn = stored(entities.select("kind", "plain", F.lit(0).alias("attempt"), surrogate(F.col("kind"), F.col("plain"), F.lit(0), key).alias("new")), "surrogates")
    while True:
        owners = drawn.groupBy("kind", "new").agg(F.min("plain").alias("owner"), F.count("*").alias("n")).filter("n > 1").select("kind", "new", "owner")
        shared = drawn.join(owners, ["kind", "new"]).filter("plain <> owner").select("kind", "plain")
        real = entities.select("kind", F.col("plain").alias("new"))
        again = stored(shared.unionByName(drawn.join(real, ["kind", "new"], "left_semi").select("kind", "plain")).distinct(), "surrogates-again")
        if not again.limit(1).count():
            return drawn.select("kind", "plain", "new")
        kept = drawn.join(again, ["kind", "plain"], "left_anti")
        numbered = again.withColumn("number", F.monotonically_increasing_id())
        next_ = drawn.join(numbered, ["kind", "plain"]).withColumn("attempt", F.col("attempt") + 1)
        new = surrogate(F.col("kind"), F.col("plain"), F.col("attempt"), key)
        wide = F.col("attempt") >= DRAWS
        redrawn = next_.withColumn("new", F.when(wide, widened(F.col("kind"), new, F.col("attempt"), F.col("number"))).otherwise(new)).drop("number")
        drawn = stored(kept.unionByName(redrawn), "surrogates")


def replace_entities(df: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``df`` with the entities of its texts replaced; ``count_col``, a new name, tells how many there were."""
    text = F.col(text_col)
    hinted = F.coalesce(text.rlike(HINT), F.lit(False))
    values = F.when(hinted, F.regexp_extract_all(text, F.lit(ANY), 0))
    digest = F.sha2(text, 256)
    has_some = hinted & text.rlike(ANY)
    found = df.filter(hinted).select(digest.alias("digest"), F.posexplode(values).alias("pos", "value")).distinct()
    kind = type_of(F.col("value"))
    found = stored(found.withColumn("kind", kind).withColumn("plain", plain_of(F.col("kind"), F.col("value"))), "entities")
    entities = stored(found.select("kind", "plain").distinct(), "entities-distinct")
    new = surrogates(entities, key)
    placed = found.join(new, ["kind", "plain"]).select("digest", "pos", written(F.col("kind"), F.col("value"), F.col("new")).alias("new"))
    per_text = stored(placed.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("new")), "entities-by-text")

    some = df.filter(has_some).withColumn("__llm_digest", digest)
    joined = some.join(per_text.withColumnsRenamed({"digest": "__llm_of", "new": "__llm_new"}), F.col("__llm_digest") == F.col("__llm_of"))
    pieces = F.split(text, ANY, -1)
    rebuilt = F.array_join(
        F.zip_with(pieces, F.transform("__llm_new", lambda n: n["new"]), lambda piece, n: F.concat(piece, F.coalesce(n, F.lit("")))), ""
    )
    columns = [column if c != text_col else rebuilt.alias(c) for c, column in zip(df.columns, columns_of(df))]
    counted = [F.size("__llm_new").cast("long").alias(count_col)] if count_col else []
    none = [F.lit(0).cast("long").alias(count_col)] if count_col else []
    return joined.select(*columns, *counted).unionByName(df.filter(~has_some).select(*columns_of(df), *none))
