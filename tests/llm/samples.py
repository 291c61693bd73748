"""Documents with the awkward cases every operator has to take."""

import random

CLASHING = ["id", "row", "n", "h", "size", "kept", "score", "block", "source_size", "cid", "keys", "bucket", "copies", "p", "s", "packed", "text_key", "component_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
WORDS = {
    "en": "the of and to in that with for was this have from they which ship river stone morning".split(),
    "de": "der die und das nicht mit sich auf für eine schön wenn über fluß stein morgen straße".split(),
}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def rows(seed=1, n=60):
    """(doc_id, text, lang, source): copies, near copies, empty, null and long texts, repeated rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        out.append((i, prose(rng, lang, rng.randint(1, 120)), lang, rng.choice(["a", "b", "b", "b", None])))
    base = prose(rng, "en", 80)
    out += [(n + k, base, "en", "a") for k in range(12)]  # exact copies
    out += [(n + 20 + k, base.replace(" ", "\n", k), "en", "b") for k in range(3)]  # same but for white space
    out += [(n + 40 + k, base + " " + prose(rng, "en", 2), "en", "c") for k in range(8)]  # near copies
    out += [(n + 60, None, "en", "a"), (n + 61, "", None, "b"), (n + 62, " \t\r\n", "de", None), (n + 63, "123 !!", "de", "a")]
    out += [(n + 64, prose(rng, "de", 30000), "de", "c"), (n + 65, "é😀 " * 200, "en", "c"), (None, base, "en", "a"), (None, "alone here", None, None)]
    out += [(n + 66, "said twice in two rows", "en", "b")] * 2
    rng.shuffle(out)
    return out


def documents(spark, data=None):
    data = rows() if data is None else data
    extra = tuple("x" for _ in CLASHING)
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) + extra for i, t, lang, s in data], SCHEMA)


def key(row):
    return tuple((v is None, str(v)) for v in row)
