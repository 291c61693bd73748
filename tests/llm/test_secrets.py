import random

from noticeloom.llm import secrets as K

from .samples import documents, prose


def corpus(seed, n):
    """Texts with secrets and with long harmless words, numbers and paths; and what is to be found."""
    rng = random.Random(seed)
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    data, want = [], set()
    for i in range(n):
        text = prose(rng, "en", 20)
        kind = i % 5
        if kind == 0:
            value = "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
            text += f" {value} here"
        elif kind == 1:
            value = hexes(40)
            text += f' token = "{value}" there'
        elif kind == 2:
            value = hexes(18)
            text += f" password={value} next"
        else:
            value = None
            text += " " + rng.choice(["".join(rng.choice(K_WORDS) for _ in range(5)), "4041894974608795", "some-long-hyphenated-word-here", "InternationalizationOfThings"])
        text += " " + prose(rng, "en", 10)
        data.append((i, text, "en", "src1"))
        if value:
            want.add((i, value))
    return data, want


K_WORDS = "river stone morning which the and from have".split()


def test_held_out_findings(spark):
    """Trained on one set of documents, tried on another: all secrets and little else."""
    train, _ = corpus(1, 400)
    held, want = corpus(2, 200)
    found = K.candidates(documents(spark, train))
    marked = K.labelled(found)
    got = {(r["doc_id"], r["value"]) for r in K.scan(documents(spark, held), marked).collect()}
    assert len(want - got) <= 0.03 * len(want) and len(got - want) <= 0.03 * len(want)


def test_candidates_and_neighbours(spark):
    texts = ['api_key: "abcdefABCDEF0123456789"', "see 0123456789abcdef0123 and", "short=abc", "x" * 15, None, "", "a=b=" + "c" * 20]
    df = documents(spark, [(i, t, "en", "conf/app.env") for i, t in enumerate(texts)] * 2)
    got = sorted(tuple(r) for r in K.candidates(df).select("id", "nth", "before", "joined", "quoted", "value").collect())
    assert got[::2] == got[1::2]
    assert got[::2] == [
        (0, 0, "api_key", True, True, "abcdefABCDEF0123456789"), (1, 0, "see", False, False, "0123456789abcdef0123"), (6, 0, "b", True, False, "c" * 20),
    ]
    row = K.with_features(K.candidates(df), ["abc", "def"]).filter("id = 0").first()
    assert (row["length"], row["is_named"], row["is_joined"], row["is_quoted"], row["in_code"]) == (22.0, 1.0, 1.0, 1.0, 1.0)
    assert abs(row["covered"] - 12 / 22) < 1e-9 and abs(row["digits"] - 10 / 22) < 1e-9


def test_nothing_to_learn_from(spark):
    assert K.scan(documents(spark, [])).count() == 0
    assert K.scan(documents(spark, [(1, "plain words only", "en", "a"), (None, None, None, None)])).count() == 0


def test_every_candidate_is_found_beside_others(spark):
    """Candidates in a row are all found, each with the word before it, however long that is."""
    keys = ["AKIA" + c * 16 for c in "ABCDEF"]
    name = "SPRING_DATASOURCE_PASSWORD"
    texts = ["\n".join(keys), keys[0] + " " + "wJalr" * 8, keys[0] + ":" + "wJalr" * 8, name + "=" + "0a1b" * 8, name + "='" + "0a1b" * 8 + "'", "x " + "QUJD" * 5 + "== y"]
    got = [tuple(r) for r in K.candidates(documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).orderBy("id", "nth").select("id", "before", "joined", "quoted", "value").collect()]
    assert [r[4] for r in got if r[0] == 0] == keys and [r[1] for r in got if r[0] == 0] == ["", *keys[:-1]]
    assert got[6:] == [
        (1, "", False, False, keys[0]), (1, keys[0], False, False, "wJalr" * 8),
        (2, "", False, False, keys[0]), (2, keys[0], True, False, "wJalr" * 8),
        (3, "", False, False, name), (3, name, True, False, "0a1b" * 8),
        (4, "", False, False, name), (4, name, True, True, "0a1b" * 8),
        (5, "x", False, False, "QUJD" * 5 + "=="),
    ]


def test_without_a_forest_nothing_is_removed(spark):
    """Secrets that fit no rule for labels, or issued keys alone, are returned unscored."""
    unlabelled = [(1, 'api_key="QUJDREVGR0hJSktMTU5PUA=="', "en", "a"), (2, "secret: 0A1B2C3D4E5F60718293", "en", "a")]
    issued = [(1, "AKIA" + "Q" * 16, "en", "a"), (2, "AKIA" + "Z" * 16 + " here", "en", "a")]
    for data, values in ((unlabelled, ["QUJDREVGR0hJSktMTU5PUA==", "0A1B2C3D4E5F60718293"]), (issued, ["AKIA" + "Q" * 16, "AKIA" + "Z" * 16])):
        got = K.scan(documents(spark, data)).orderBy("doc_id").collect()
        assert [(r["doc_id"], r["value"], r["score"]) for r in got] == [(1, values[0], None), (2, values[1], None)]


def test_named_values_of_any_form_are_found(spark):
    """Short values and values with other signs behind a naming word, quoted or joined, beside what else the texts hold."""
    data, _ = corpus(3, 200)
    named = [
        ('password="hunter2!" x', "hunter2!"), ("db_pwd: S3cr#t;", "S3cr#t"), ('{"api_key": "k$9 x%2"}', "k$9 x%2"), ("secret 'a1!b2?'", "a1!b2?"),
        ("password=token=q7!z", "token=q7!z"), ("X_TOKEN => 'p@55'", "p@55"),
    ]
    docs = documents(spark, data + [(1000 + i, t, "en", "a") for i, (t, _) in enumerate(named)])
    got = {(r["id"], r["value"]) for r in K.candidates(docs).filter("id >= 1000").collect()}
    assert got == {(1000 + i, v) for i, (_, v) in enumerate(named)} | {(1004, "q7!z")}
    assert K.candidates(documents(spark, [(1, 'password="" user="x" the password is long', "en", "a")])).count() == 0
    scanned = {(r["doc_id"], r["value"]) for r in K.scan(docs).collect()}
    assert (1000, "hunter2!") in scanned and (1001, "S3cr#t") in scanned


def test_dictionary_holds_all_words(spark):
    """Words beyond the most frequent count, fragments of keys do not; compounds of them are covered."""
    letters = "abcdefghijklmnopqrst"
    many = [f"{a}{b}{c}wort" for a in letters for b in letters for c in "xy"]
    docs = documents(spark, [(i, " ".join(many) + " 12fab34 q" + ("" if i else " single"), "en", "a") for i in range(2)])
    words = K.dictionary(docs)
    assert sorted(r["word"] for r in words.collect()) == sorted(many)
    found = K.candidates(documents(spark, [(1, "ttywortaaxwort_12", "en", "a"), (2, "0123456789012345", "en", "a")]))
    assert [r["covered"] for r in K.with_features(found, words).orderBy("id").collect()] == [14 / 17, 0.0]
