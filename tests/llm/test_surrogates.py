import re
from collections import Counter

from pyspark.sql import functions as F

from noticeloom.llm import surrogates as S

from .samples import documents, rows

TEXTS = [
    "mail ann.Lee+7@Corp-x.example.com, ANN.LEE+7@CORP-X.EXAMPLE.COM or bob@corp-x.example.com",
    "card 4041894974608795, 4041 8949 7460 8795; ip 42.144.35.254, not 1.2.3.4.5 or 300.1.1.1 or 12345678",
    "call +49 (170) 1234567 now, +1-202-555-0143",
    "Mr. John Smith met Mrs Anna Ivanova and Г-жа Анна Петрова, Dr Ng, Frau Müller",
    "ann.lee+7@corp-x.example.com again",
    "no entity 12 here",
    "",
    None,
]


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, digest string")
    out = S.replace_entities(df, key, count_col="n")
    assert out.columns == ["doc_id", "text", "digest", "n"]
    return {r["doc_id"]: (r["text"], r["n"]) for r in out.collect()}


def luhn(digits):
    total = sum(sum(divmod(int(d) * (2 if i % 2 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def test_types_formats_and_coreference(spark):
    got = run(spark, TEXTS)
    assert [got[i][1] for i in range(8)] == [3, 3, 2, 5, 1, 0, 0, 0]
    first, upper, bob = re.findall(r"[\w.+-]+@[\w.-]+\w", got[0][0])
    assert first == upper.lower() == got[4][0].split()[0] and first != bob
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}\+\d@[a-z]{4}-[a-z]\.[a-z]{7}\.com", first)
    assert first.split("@")[1] == bob.split("@")[1] and re.fullmatch("[a-z]{3}", bob.split("@")[0])
    card, spaced = re.search(r"card (\d{16}), (\d{4} \d{4} \d{4} \d{4});", got[1][0]).groups()
    assert card == spaced.replace(" ", "") != "4041894974608795" and card[0] == "4" and luhn(card)
    assert re.search(r"ip 10\.\d+\.\d+\.\d+, not 1\.2\.3\.4\.5 or 300\.1\.1\.1 or 12345678$", got[1][0])
    assert re.fullmatch(r"call \+49 \(\d{3}\) \d{7} now, \+1-2\d\d-\d{3}-\d{4}", got[2][0])
    assert re.fullmatch(r"Mr\. \w+ \w+o met Mrs \w+ \w+a and Г-жа [А-Я][а-я]{3} [А-Я][а-я]{6}, Dr \w\w, Frau \w{5}a", got[3][0])
    assert [got[i][0] for i in (5, 6, 7)] == ["no entity 12 here", "", None]
    for text, (new, _) in zip(TEXTS, got.values()):
        for value in re.findall(S.EMAIL, text or "") + re.findall(r"\d{16}|42\.144\.35\.254|1234567 |Smith|Ivanova|Петрова", text or ""):
            assert value not in new or value == "12345678"


def test_the_key_decides(spark):
    assert run(spark, TEXTS) == run(spark, TEXTS)
    assert run(spark, TEXTS, "other")[2] != run(spark, TEXTS)[2]


def test_clashes_draw_again(spark, monkeypatch):
    """A surrogate space of ten values for each of two kinds of writing, nearly full."""
    monkeypatch.setattr(S, "surrogate", lambda kind, plain, attempt, key: F.concat(F.lit("s"), F.pmod(F.xxhash64(plain, attempt), F.lit(12)).cast("string")))
    entities = spark.createDataFrame([("ipv4", f"v{i}") for i in range(9)] + [("ipv4", "s3")], "kind string, plain string")
    got = [tuple(r) for r in S.surrogates(entities, "k").collect()]
    new = Counter(n for _, _, n in got)
    assert len(got) == 10 and max(new.values()) == 1 and "s3" not in new


def test_whole_tables(spark):
    docs = documents(spark)
    out = S.replace_entities(docs, "k")
    assert out.columns == docs.columns
    assert Counter(r["text"] for r in out.collect()) == Counter(t for _, t, *_ in rows())
    assert S.replace_entities(documents(spark, []), "k").count() == 0
    long = "word " * 200000 + "a@b.example.com" + " word" * 1000
    assert len(run(spark, [long])[0][0]) == len(long)


def test_national_numbers_and_4_6_5_cards(spark):
    phones = ["(017) 555-7713", "555-123-4567", "1-555-123-4568", "(030) 5551 234", "01 23 45 67 89", "0171 5551234"]
    cards = ["3782 822463 10005", "3782-822463-10005"]
    no = "on 2024-01-02 or 12.03.2024, 978-555-123-45678, 555-1234, 5551234567, 1.555.123.4567.8"
    got = run(spark, [f"call {p}, now" for p in phones] + [f"card {c}; paid" for c in cards] + [no])
    for i, value in enumerate(phones + cards):
        new, n = got[i]
        shape = "".join(r"\d" if c.isdigit() else re.escape(c) for c in value)
        assert n == 1 and value not in new and re.fullmatch(rf"call {shape}, now|card {shape}; paid", new)
    one, other = (re.sub(r"\D", "", got[len(phones) + i][0]) for i in range(2))
    assert one == other and one[0] == "3" and luhn(one)
    assert got[len(phones) + 2] == (no, 0)


def test_a_full_space_takes_wider_forms(spark, monkeypatch):
    """All names of two letters, and all phone numbers that differ in one digit: nothing is left to draw."""
    monkeypatch.setattr(S, "DRAWS", 1)
    names = [f"Mr {a}{b}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in "abcdefghijklmnopqrstuvwxyz"]
    got = run(spark, [f"{n} left" for n in names] + ["Mr Ab and +49 170 1234567 came"])
    new = [re.fullmatch(r"(Mr \w+) left", got[i][0]).group(1) for i in range(len(names))]
    assert len(set(new)) == len(names) and not set(new) & set(names)
    assert got[len(names)][0].startswith(f"{new[names.index('Mr Ab')]} and +49 ")


def test_wider_forms_of_every_type(spark):
    rows = [("email", "ab@x.com"), ("ipv4", "10.1.2.3"), ("card", "4111111111111111"), ("phone", "+491701234567"), ("name", "male/иван")]
    df = spark.createDataFrame(rows, "kind string, new string")
    made = {r["kind"]: r["w"] for r in df.select("kind", S.widened(F.col("kind"), F.col("new"), F.lit(7), F.lit(12).cast("long")).alias("w")).collect()}
    assert made == {"email": "ab.9912@x.com", "ipv4": "fd00:0::c", "card": "41111111111111119912", "phone": "+4917012345679912", "name": "male/иванккбв"}
    shown = df.filter("kind = 'card'").select(S.written(F.col("kind"), F.lit("4111 1111 1111 1111"), F.lit(made["card"])).alias("w")).first()["w"]
    assert shown == "4111 1111 1111 11119912"
