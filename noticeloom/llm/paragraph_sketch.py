"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests. DataFrame functions only.

A text's paragraphs are its lines, of which long ones are cut after a sentence of at least ``LEAST_WORDS``
words or after ``MOST_WORDS``, so that an edit changes digests of its line only; words of over ``LONG_WORD``
characters are cut as well. Each distinct 64-bit
digest is added to three cells of the sketch: the cell keeps the exclusive or of its digests, that of their
checks, and their number. The sketch of the newer version is subtracted from that of the older one, so
that digests of both vanish. A cell left with one digest names it; taking it out of its other two cells lays
bare more of them, until the sketch is empty and all differing digests are known.

A sketch of fixed size holds about five differences. Where peeling gets stuck, the pair is tried again with a
larger one: digests are dealt by fresh hash bits over up to 64 sketches, each of which is peeled by
itself and dealt again if it gets stuck. The first turns run inside the row; what is left after them
(texts of millions of paragraphs) goes on as rows of its own until nothing is stuck.

Likeness of two texts is the share of common digests in all digests of both, which follows from the sizes and
the number of differences. A fingerprint is the number of digests and the cells, so equal texts have
equal ones; order and repetition of paragraphs do not show in it.

Defined results: a null text is empty, has no digests, and is wholly like other texts without digests (likeness 1);
the next document comes in descending order of id, null ids last, texts of one id in an order of their
own (:func:`document_key`); rows that repeat an id and a text are one document and have the same result; a document alone is its
own next; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind, empty
from noticeloom.llm.common import stored
from noticeloom.operators.ranking import number_rows

LEAST_WORDS, MOST_WORDS = 16, 40  # of a paragraph that is not the last of its line
LONG_WORD = 64
SEGMENTS, SLOTS = 3, 4  # a digest has one cell in each segment
ROUNDS = 12
PER_SKETCH = 4  # digests of both sides that a larger attempt gives to a sketch
SPREAD_BITS = 6  # a stuck unit is dealt over up to two to this many sketches
TURNS = 12
_WORD = r"[^\x20\x09-\x0D]"
_ONE = rf"{_WORD}{{1,{LONG_WORD}}}+"
_MORE = rf"[\x20\x09]++(?={_WORD})"
PIECE = rf"(?:{_ONE}{_MORE}){{0,{LEAST_WORDS - 1}}}+(?:{_ONE}(?<![.!?]){_MORE}){{0,{MOST_WORDS - LEAST_WORDS}}}+{_ONE}"
FOUND = "array<struct<digest:bigint,side:int>>"
UNITS = "array<array<struct<digest:bigint,side:int>>>"


def digests(text: Column) -> Column:
    """The distinct 64-bit hashes of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p)))


def sided(found: Column, side: int) -> Column:
    """Digests with the side that has them: 1 for the first text, -1 for the other."""
    return F.transform(found, lambda d: F.struct(d.alias("digest"), F.lit(side).alias("side")))


def _placed(found: Column, turn: Column) -> Column:
    """Digests with their cells, one in each segment, by the hash of this turn."""
    def place(d: Column) -> Column:
        h = F.xxhash64(d["digest"], turn)
        numbers = [F.shiftright(h, 3 * j).bitwiseAND(F.lit(SLOTS - 1)) + j * SLOTS for j in range(SEGMENTS)]
        return F.struct(d["digest"].alias("digest"), d["side"].alias("side"), *[n.cast("int").alias(f"c{j}") for j, n in enumerate(numbers)])

    return F.transform(found, place)


def _with(cell: Column, p: Column, sign: int) -> Column:
    n = cell["n"] + p["side"] if sign > 0 else cell["n"] - p["side"]
    return F.struct(
        cell["key"].bitwiseXOR(p["digest"]).alias("key"), cell["check"].bitwiseXOR(F.hash(p["digest"])).alias("check"), n.alias("n"),
    )


def cells(found: Column, turn: Column) -> Column:
    """The sketch of an array of distinct digests with sides."""
    blank = F.struct(F.lit(0).cast("long").alias("key"), F.lit(0).alias("check"), F.lit(0).alias("n"))

    def fill(placed: Column) -> Column:
        def segment(j: int) -> Column:
            numbers = F.sequence(F.lit(j * SLOTS), F.lit(j * SLOTS + SLOTS - 1))
            return F.transform(numbers, lambda i: F.aggregate(F.filter(placed, lambda p: p[f"c{j}"] == i), blank, lambda c, p: _with(c, p, 1)))

        return F.concat(*[segment(j) for j in range(SEGMENTS)])

    return bind(_placed(found, turn), fill)


def subtract(some: Column, others: Column) -> Column:
    """The sketch of the difference: digests of both vanish."""
    def less(c: Column, o: Column) -> Column:
        return F.struct(c["key"].bitwiseXOR(o["key"]).alias("key"), c["check"].bitwiseXOR(o["check"]).alias("check"), (c["n"] - o["n"]).alias("n"))

    return F.zip_with(some, others, less)


def peel(difference: Column, turn: Column) -> Column:
    """``done`` and ``found``: the differing digests, with side 1 where only the first sketch has them and -1 else."""
    def alone(c: Column) -> Column:
        return ((c["n"] == 1) | (c["n"] == -1)) & (F.hash(c["key"]) == c["check"])

    def take(state: Column, _: Column) -> Column:
        pure = F.array_distinct(F.transform(F.filter(state["cells"], alone), lambda c: F.struct(c["key"].alias("digest"), c["n"].alias("side"))))

        def without(p: Column) -> Column:
            def left(c: Column, i: Column) -> Column:
                hit = F.filter(p, lambda x: (x["c0"] == i) | (x["c1"] == i) | (x["c2"] == i))
                return F.aggregate(hit, c, lambda own, x: _with(own, x, -1))

            seen = F.transform(p, lambda x: F.struct(x["digest"].alias("digest"), x["side"].alias("side")))
            still = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("more"))
            peeled = F.struct(F.transform(state["cells"], left).alias("cells"), F.concat(state["found"], seen).alias("found"), F.lit(True).alias("more"))
            return F.when(F.size(p) > 0, peeled).otherwise(still)

        return F.when(state["more"], bind(_placed(pure, turn), without)).otherwise(state)

    def result(state: Column) -> Column:
        blank = F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0))
        return F.struct(blank.alias("done"), state["found"].alias("found"))

    start = F.struct(difference.alias("cells"), empty(FOUND).alias("found"), F.lit(True).alias("more"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, take, result)


def _dealt(unit: Column, turn: Column) -> Column:
    """The digests of a stuck unit, over the sketches of a larger attempt."""
    bits = F.least(F.lit(SPREAD_BITS), F.greatest(F.lit(1), F.ceil(F.log2(F.size(unit) / F.lit(PER_SKETCH))).cast("int")))

    def over(mask: Column) -> Column:
        placed = F.transform(unit, lambda d: F.struct(d.alias("d"), F.shiftright(F.xxhash64(d["digest"], turn), 20).bitwiseAND(mask).alias("to")))

        def parts(all_of: Column) -> Column:
            numbers = F.sequence(F.lit(0).cast("long"), mask)
            return F.transform(numbers, lambda k: F.transform(F.filter(all_of, lambda x: x["to"] == k), lambda x: x["d"]))

        return bind(placed, parts)

    return bind(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, over)


def retried(pending: Column, found: Column, turns: int) -> Column:
    """``pending, found`` after each turn has dealt and peeled what was stuck."""
    def turn_of(state: Column, turn: Column) -> Column:
        units = F.flatten(F.transform(state["pending"], lambda u: _dealt(u, turn)))
        tried = F.transform(units, lambda u: F.struct(u.alias("unit"), peel(cells(u, turn), turn).alias("got")))

        def split(all_of: Column) -> Column:
            stuck = F.transform(F.filter(all_of, lambda t: ~t["got"]["done"]), lambda t: t["unit"])
            named = F.flatten(F.transform(F.filter(all_of, lambda t: t["got"]["done"]), lambda t: t["got"]["found"]))
            return F.struct(stuck.alias("pending"), F.concat(state["found"], named).alias("found"))

        return F.when(F.size(state["pending"]) > 0, bind(tried, split)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(turns)), F.struct(pending.alias("pending"), found.alias("found")), turn_of)


def differences(a: Column, b: Column, cells_a: Column, cells_b: Column, turns: int = TURNS) -> Column:
    """The digests that one of two arrays has and the other has not, with sides, from the sketches of both.

    Sketches of larger attempts are those of the difference: a digest of both sides is added and taken off.
    What is left after ``turns``, which halve a stuck unit at least, is told apart by the digests themselves.
    """
    def next_try(got: Column) -> Column:
        unit = F.array(F.concat(sided(a, 1), sided(b, -1)))
        pending = F.when(got["done"], empty(UNITS)).otherwise(unit)
        return bind(retried(pending, F.when(got["done"], got["found"]).otherwise(empty(FOUND)), turns), settled)

    def settled(state: Column) -> Column:
        left = F.flatten(state["pending"])

        def of(side: int) -> Column:
            return F.transform(F.filter(left, lambda d: d["side"] == side), lambda d: d["digest"])

        rest = F.concat(sided(F.array_except(of(1), of(-1)), 1), sided(F.array_except(of(-1), of(1)), -1))
        return F.when(F.size(state["pending"]) > 0, F.concat(state["found"], rest)).otherwise(state["found"])

    return bind(peel(subtract(cells_a, cells_b), F.lit(0)), next_try)


def fingerprint(n: Column, sketch: Column) -> Column:
    """Number of digests and cells as text."""
    def as_hex(c: Column) -> Column:
        return F.concat(F.lpad(F.hex(c["key"]), 16, "0"), F.right(F.lpad(F.hex(c["check"].cast("long")), 16, "0"), F.lit(8)), F.lpad(F.hex(c["n"].cast("long")), 8, "0"))

    return F.concat(n.cast("string"), F.lit(":"), F.base64(F.unhex(F.array_join(F.transform(sketch, as_hex), ""))))


def likeness(n_a: Column, n_b: Column, different: Column) -> Column:
    """Common digests by all digests of both; 1 where neither has any."""
    both = (n_a + n_b).cast("double")
    return F.when(both == 0, F.lit(1.0)).otherwise((both - different) / (both + different))


def version_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", turns: int = TURNS) -> DataFrame:
    """Per row: id, ``n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has the last half of its characters replaced by the first ones of the next document.
    """
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", document_key(F.col("id"), F.col("text")))
    keys = docs.select("id", "key", F.length("text").alias("n")).distinct()
    # Places ascend, so the next document in descending order has the place before.
    numbered = stored(number_rows(keys, ["id", "key"], "place"), "sketch-places")
    total = numbered.agg(F.max("place")).first()[0] or 1
    giver = numbered.select(F.col("key").alias("from"), (F.col("place") % total + 1).alias("place"))
    taker = numbered.select("place", F.col("key").alias("to"), F.col("id").alias("to_id"), F.shiftright("n", 1).alias("need"))
    links = stored(giver.join(taker, "place").drop("place"), "sketch-links")

    by_key = docs.select("key", "text", digests(F.col("text")).alias("a")).repartition("key")  # both uses below read this one shuffle
    given = by_key.join(links.hint("merge"), F.col("key") == F.col("from"))
    sent = given.select("to", "to_id", F.left("text", F.col("need")).alias("head"), F.col("a").alias("b"))
    sent = sent.groupBy("to").agg(*[F.any_value(c).alias(c) for c in ("to_id", "head", "b")])
    met = by_key.join(sent.hint("merge"), F.col("key") == F.col("to"))

    n = F.length("text")
    edited = met.select(F.col("to_id").alias("id"), n.alias("n_chars"), "a", "b", F.concat(F.left("text", n - F.shiftright(n, 1)), "head").alias("edited"))
    edited = edited.select("id", "n_chars", "a", "b", F.sha2("edited", 256).alias("edited_sha256"), digests(F.col("edited")).alias("e"))
    sketches = F.struct(F.col("a").alias("a"), F.col("e").alias("e"), F.col("b").alias("b"), *[cells(sided(F.col(c), 1), F.lit(0)).alias(f"c{c}") for c in "aeb"])

    def near(s: Column, other: str) -> Column:
        different = F.size(differences(s["a"], s[other], s["ca"], s[f"c{other}"], turns))
        return likeness(F.size(s["a"]), F.size(s[other]), different)

    def compared(s: Column) -> Column:
        return F.struct(
            fingerprint(F.size(s["a"]), s["ca"]).alias("fingerprint"), fingerprint(F.size(s["e"]), s["ce"]).alias("edited_fingerprint"),
            near(s, "e").alias("near_edited"), near(s, "b").alias("near_next"),
        )

    found = edited.select(F.col("id").alias(id_col), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", bind(sketches, compared).alias("s"))
    return found.select(F.col(f"`{id_col}`"), "n_chars", "edited_sha256", "s.*")


def document_key(id_: Column, text: Column) -> Column:
    """One key per id and text, null ids among them."""
    return F.unhex(F.md5(F.concat_ws("|", F.md5(text), id_.cast("string"))))
