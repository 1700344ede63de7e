"""Golden values of the text forms and similarities, and properties of the pure functions."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import clean, fold, similarity, text


def values(spark, column, rows):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ["n", "a", "b"][: 1 + len(rows[0])]).orderBy("n").select(column).collect()]


def test_skeleton(spark):
    got = values(spark, text.skeleton(F.col("a")), [("enterprises",), ("12",), ("",), ("schmidt",), ("jazz",)])
    assert got == ["entrprs", "12", "", "smdt", "gs"]


def test_basic_and_initials(spark):
    got = values(spark, text.join_initials(text.basic(F.col("a"))), [("A & B",), ("L.L.C.",), ("a b c shop",), ("a shop",), ("Joe's + @x",)])
    assert got == ["a and b", "llc", "abc shop", "a shop", "joes and at x"]


def test_canon_num(spark):
    assert values(spark, text.canon_num(F.col("a")), [("007",), ("000",), ("12",)]) == ["7", "0", "12"]


def test_norm_name(spark):
    rows = [("Acme Tools Pvt Ltd",), ("www.acme-tools.com",), ("The",), ("Foo dba Bar 12345678 09",), (None,)]
    got = [tuple(r) for r in values(spark, text.norm_name(F.col("a")), rows)]
    assert got[0] == ("acme tools", "acme tools private limited", "ltd pvt", "", 0, 0)
    assert got[1] == ("acmetools", "acmetools", "", "", 1, 0)
    assert got[2][0] == "the"
    assert got[3] == ("foo bar", "foo dba bar", "", "9", 0, 0)
    assert got[4] == ("", "", "", "", 0, 0)


def test_norm_addr(spark):
    rows = [("12 Main St, Austin, TX", "US"), ("Flat 4B, 2nd Rd, Orissa", "India"), ("3 r Paris, Paris", "France"), ("", "US"), (None, None)]
    got = [tuple(r) for r in values(spark, text.norm_addr(F.col("a"), F.col("b")), rows)]
    assert got[0] == ("12 main street austin", "texas", "12")
    assert got[1] == ("flat 4 b 2 road", "odisha", "4 2")
    assert got[2] == ("3 rue paris paris", "", "3")
    assert got[3] == got[4] == ("", "", "")


def test_clean(spark):
    assert values(spark, clean.normalize_business_name(F.col("a")), [("Strategic Praetorian, Inc.",), ("Söhne & Co",), (None,)]) == ["strategic praetorian", "sohne and", ""]
    assert values(spark, clean.name_tokens(F.col("a")), [("moore bitwise",)]) == ["bitwise moore"]
    assert values(spark, clean.remove_address_noise(F.col("a")), [("19 1/2 stardust trail",), ("##37 elm near the old mill",)]) == ["19 stardust trail", "37 elm"]
    assert values(spark, clean.postal_code(F.col("a"), F.col("b")), [("Austin TX 78701-1234", "US"), ("x 411001", "India")]) == ["78701", "411001"]
    assert values(spark, clean.state_or_region(F.col("a"), F.col("b")), [("Foo, West Virginia", "US"), ("a New Delhi", "India"), ("x TX", "US")]) == ["wv", "new delhi", "tx"]


def test_fold(spark):
    assert fold.strip_accents("Straße Œuvre Łódź é") == "Strasse OEuvre Łodz e".replace("Ł", fold.strip_accents("Ł"))
    assert fold.transliterate("राम") == "raam"
    assert fold.transliterate("कमल") == "kamal"
    df = spark.createDataFrame([(1, "Café"), (2, "plain"), (3, None), (4, "राम")], "id int, t string")
    got = {r.id: r.o for r in fold.fold_distinct(df, "t", "o").collect()}
    assert got == {1: "Cafe", 2: "plain", 3: "", 4: "raam"}


words = st.text("abc ", max_size=12)


@given(words, words)
def test_ratio_is_indel_similarity(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 100.0 if not a + b else 200 * table[-1][-1] / (len(a) + len(b))
    assert similarity.ratio(a, b) == pytest.approx(want)


@given(words, words)
def test_scores_are_bounded_and_symmetric(a, b):
    for name, f in similarity.SCORERS.items():
        top = 1 if name == "jw" else 100
        assert 0 <= f(a, b) <= top + 1e-9
        assert f(a, b) == pytest.approx(f(b, a))


def test_golden_scores():
    assert similarity.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert similarity.token_sort_ratio("fuzzy was a bear", "a bear was fuzzy") == 100
    assert similarity.token_set_ratio("fuzzy fuzzy bear", "fuzzy bear") == 100
    assert similarity.partial_ratio("abc", "xxabcxx") == 100
    assert similarity.token_set_ratio("", "a") == 0


def test_native_similarities(spark):
    df = spark.createDataFrame([(["a", "b", "b"], ["b", "c"], [3.0, 4.0])], "x array<string>, y array<string>, v array<double>")
    r = df.select(similarity.jaccard(F.col("x"), F.col("y")), similarity.min_overlap(F.col("x"), F.col("y")), similarity.dot(F.col("v"), F.col("v")), similarity.l2_normalise(F.col("v"))).first()
    assert r[0] == pytest.approx(1 / 3) and r[1] == 0.5 and r[2] == 25 and r[3] == [0.6, 0.8]
