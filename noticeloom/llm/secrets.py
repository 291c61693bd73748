"""Secrets in texts: candidates by pattern, false positives removed by a random forest. DataFrame functions only.

A candidate is a long run of letters, digits and the signs of encoded keys, or a quoted or joined value of
any length and signs behind a word that names secrets; a value without quotes ends at white space or a quote,
and brackets, commas and semicolons at its end are left out. The word before it is read from
the text in front, of any length, and may be a candidate itself. The forest sees its length,
the transitions between its characters, how much of it dictionary words cover, the path of its document
and the words beside it. It is trained on labelled findings; in the query these come from the formats
whose issuers fix them (positive) and from plain words and numbers (negative), at most ``SAMPLE_ROWS`` of
each label in hash order. All candidates of all texts are scored; scoring is a map.

The dictionary is a table of all words of three to ``WORD_MOST`` letters that ``WORD_DOCUMENTS`` documents hold,
counted over all documents; the parts of the distinct candidates meet it in a join.

Defined results: null and empty texts have no candidates; repeated rows give repeated findings; a null id
or path is carried; a corpus without candidates gives no findings; where both labels do not occur there is
no forest, so nothing is removed and all candidates are findings with a null score; texts may be of any
length; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind
from noticeloom.llm.common import stored, text_of

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:={1,2}(?![\"']?[A-Za-z0-9+/_=-]))?"
#: The word that ends the text in front of a candidate, of any length, and what joins the two.
BEFORE = r"(?<![^\s\"'=:])([^\s\"'=:]++)(\s?[=:]\s?[\"']?|\s)\z"
# Formats that the issuers of keys publish, and words that name secrets.
ISSUED = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[baprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{24,})$"
NAMING = r"(?i)(?:password|passwd|pwd|secret|token|api_?key|access_?key|credential)"
CODE_PATH = r"(?i)(?:\.(?:env|py|js|ts|java|go|rb|sh|ya?ml|json|ini|cfg|conf|toml|properties)$|config|secret|\.git)"
#: A naming word, what joins it to a value or a quote behind it, and ahead of that the value, quoted or up to white space.
NAMED = (
    r"(?<![^\s\"'=:])[^\s\"'=:]*?" + NAMING + r"[^\s\"'=:]*+[\"']?(?:\s?[=:]{1,2}>?\s?|\s(?=[\"']))"
    r"(?=(\"[^\"\r\n]+\"|'[^'\r\n]+'|[\"']?[^\s\"']+))"
)
SAMPLE_ROWS = 20000
WORD_DOCUMENTS = 2  # so many documents hold a word of the dictionary at least
WORD_MOST = 15  # letters of its longest words
TREES, DEPTH = 24, 7
FEATURES = ["length", "digits", "uppers", "signs", "kinds", "vowels", "turns", "distinct", "covered", "is_named", "is_joined", "is_quoted", "in_code"]


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``id, nth, before, joined, quoted, value, path`` of each candidate, in each text the long runs and then the other named values.

    A candidate may be the word before the next.
    """
    path = F.col(path_col) if path_col else F.lit(None)

    def each(tokens: Column, pieces: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            front = F.concat(F.coalesce(F.get(pieces, i - 1), F.lit("")), F.coalesce(F.get(tokens, i - 1), F.lit("")), F.get(pieces, i))
            words = bind(front, lambda x: F.struct(F.regexp_extract(x, BEFORE, 1).alias("before"), F.regexp_extract(x, BEFORE, 2).rlike("[=:]").alias("joined")))
            return F.struct(words.alias("words"), F.get(pieces, i + 1).rlike(r"^[\"']").alias("quoted"), token.alias("value"))

        return F.transform(tokens, one)

    def runs_in(text: Column) -> Column:
        return bind(F.regexp_extract_all(text, F.lit(TOKEN), 0), lambda tokens: bind(F.split(text, TOKEN, -1), lambda pieces: each(tokens, pieces)))

    def named_in(text: Column) -> Column:
        def one(front: Column, value: Column) -> Column:
            words = F.struct(F.regexp_extract(front, r"^[^\s\"'=:]+", 0).alias("before"), front.rlike("[=:]").alias("joined"))
            quoted = value.rlike(r"^([\"']).*\1$")
            bare = F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(F.regexp_replace(value, r"^[\"']|[,;)}\]]+$", ""))
            return F.struct(words.alias("words"), quoted.alias("quoted"), bare.alias("value"))

        both = F.zip_with(F.regexp_extract_all(text, F.lit(NAMED), 0), F.regexp_extract_all(text, F.lit(NAMED), 1), one)
        return F.filter(both, lambda x: (x["value"] != "") & ~x["value"].rlike(f"^(?:{TOKEN})$"))

    def found_in(text: Column) -> Column:
        return F.concat(runs_in(text), F.when(text.rlike(NAMING), named_in(text)).otherwise(F.array()))

    found = df.select(F.col(id_col).alias("id"), path.cast("string").alias("path"), F.posexplode(found_in(text_of(text_col))).alias("nth", "hit"))
    return found.select("id", "nth", "path", "hit.words.before", "hit.words.joined", "hit.quoted", "hit.value")


def dictionary(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``word``: what stands alone as a word in at least ``WORD_DOCUMENTS`` texts; runs that touch digits are no words."""
    own = F.array_distinct(F.split(F.lower(text_of(text_col)), r"[^0-9a-zß-öø-ÿ]+", -1))
    each = df.select(F.explode(own).alias("word")).filter(F.col("word").rlike(f"^[a-zß-öø-ÿ]{{3,{WORD_MOST}}}$"))
    return each.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= WORD_DOCUMENTS).select("word")


def covers(values: DataFrame, words: DataFrame) -> DataFrame:
    """``key, cover``: how many characters of each distinct ``value`` words cover, the leftmost first and of these the longest."""
    low = values.groupBy("key").agg(F.first("value").alias("value")).select("key", F.lower("value").alias("low"))
    at = low.select("key", "low", F.explode(F.sequence(F.lit(1), F.greatest(F.length("low") - 2, F.lit(1)))).alias("at"))
    tails = at.select("key", "at", F.regexp_extract(F.substr("low", F.col("at"), F.lit(WORD_MOST)), "^[a-zß-öø-ÿ]+", 0).alias("tail")).filter(F.length("tail") > 2)
    parts = tails.select("key", "at", "tail", F.explode(F.sequence(F.lit(3), F.length("tail"))).alias("n"))
    hits = parts.select("key", "at", "n", F.substr("tail", F.lit(1), F.col("n")).alias("word")).join(words, "word")
    ordered = F.sort_array(F.collect_list(F.struct("at", (-F.col("n")).alias("less"))))

    def further(a: Column, x: Column) -> Column:
        fits = x["at"] >= a["next"]
        return F.struct(F.when(fits, x["at"] - x["less"]).otherwise(a["next"]).alias("next"), F.when(fits, a["cover"] - x["less"]).otherwise(a["cover"]).alias("cover"))

    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("cover"))
    return hits.groupBy("key").agg(F.aggregate(ordered, start, further, lambda a: a["cover"]).alias("cover"))


def with_features(found: DataFrame, words: DataFrame | list[str]) -> DataFrame:
    """The numbers the forest sees, as doubles; ``words`` is a dictionary as a table or a list. ``found`` is read twice."""
    if isinstance(words, list):
        words = found.sparkSession.createDataFrame([(w,) for w in words], "word string")
    value, length = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / length

    keyed = found.withColumn("key", F.unhex(F.md5("value")))
    found = keyed.join(covers(keyed, words), "key", "left").drop("key")
    numbers = {
        "length": F.least(length, F.lit(200)),
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "signs": share("[^A-Za-z0-9]"),
        "kinds": share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "vowels": share("[AEIOUaeiou]"),
        "turns": share("(?<=[AEIOUaeiou])(?=[B-DF-HJ-NP-TV-Zb-df-hj-np-tv-z])"),
        "distinct": F.size(F.array_distinct(F.split(value, "", -1))) / length,
        "covered": F.coalesce("cover", F.lit(0)) / length,
    }
    flags = {
        "is_named": F.col("before").rlike(NAMING),
        "is_joined": F.col("joined"),
        "is_quoted": F.col("quoted"),
        "in_code": F.col("path").rlike(CODE_PATH),
    }
    return found.withColumns({k: v.cast("double") for k, v in numbers.items()} | {k: F.when(v, 1.0).otherwise(0.0) for k, v in flags.items()}).drop("cover")


def labelled(found: DataFrame) -> DataFrame:
    """Findings whose label is beyond doubt: issued formats and named hexadecimal values; plain words and numbers."""
    value = F.col("value")
    yes = value.rlike(ISSUED) | (F.col("before").rlike(NAMING) & F.col("joined") & value.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$"))
    no = value.rlike("^(?:[A-Z]?[a-z]+(?:[A-Z][a-z]+)*|[A-Z]+|[0-9]+|[-_=+/]+|(?:[A-Za-z][a-z]*[-_/])+[A-Za-z][a-z]*)$") & ~F.col("joined")
    marked = found.withColumn("label", F.when(yes, 1.0).when(no, 0.0))
    return marked.filter(F.col("label").isNotNull())


def train(marked: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 7):
    """A forest fitted on labelled findings with features; ``None`` unless both labels occur."""
    sizes = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two labels
    if len(sizes) < 2:
        return None
    share = F.when(F.col("label") == 1.0, min(1.0, sample_rows / sizes[1.0])).otherwise(min(1.0, sample_rows / sizes[0.0]))
    point = F.shiftrightunsigned(F.xxhash64("id", "nth", "value"), 11) / float(1 << 53)
    sample = stored(marked.filter(point < share).select("label", *FEATURES), "secrets-sample")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featuresCol="features", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(sample)


def scan(
    df: DataFrame, marked: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
    threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Findings the forest takes for secrets: ``id_col, nth, value, before, score``; ``nth`` counts a text's candidates.

    ``marked`` may bring labelled findings of one's own, shaped like :func:`candidates` with a ``label``.
    With one label only, or none, there is no forest: all candidates are returned, with a null score.
    """
    words = stored(dictionary(df, text_col), "secrets-words")
    found = stored(with_features(stored(candidates(df, id_col, text_col, path_col), "secrets-candidates"), words), "secrets-features")
    model = train(labelled(found) if marked is None else with_features(marked, words), sample_rows)
    if model is None:
        scored = found.withColumn("score", F.lit(None).cast("double"))
    else:
        scored = model.transform(found).withColumn("score", F.get(vector_to_array("probability"), 1)).filter(F.col("score") >= threshold)
    return scored.select(F.col("id").alias(id_col), F.col("nth").cast("long").alias("nth"), "value", "before", "score")
