import duckdb
import pytest
from pyspark.sql import functions as F

from linkgraph.functions import control, places, similarity, text


def values(spark, f, inputs):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(f(F.col("v"))).collect()]


def test_company_fingerprints(spark):
    got = values(spark, text.company_fingerprint, ["OOO Acme", "Acme OOO", "ACME, O.O.O.", "Foo S.A.R.L.", "Foo SARL", "Property 12 Ltd", "Property 21 Ltd", "Limited", None, "", "Łódź Holdings Sp. z o.o."])
    assert got[0] == got[1] == got[2] == "acme" and got[3] == got[4] == "foo" and got[5] != got[6]
    assert got[7:] == ["limited", "", "", "holdings lodz"]


def test_legal_forms(spark):
    got = values(spark, text.legal_form, ["Acme Limited", "OOO Acme", "Acme Pty Ltd", "Acme GmbH & Co. KG", "Trust Company Limited", "Acme"])
    assert [tuple(g) for g in got] == [("acme", "LTD"), ("acme", "OOO"), ("acme", "PTY_LTD"), ("acme", "GMBH_KG"), ("trust", "LTD"), ("acme", "")]


def test_persons(spark):
    assert values(spark, text.strip_titles, ["Dr James Whitfield PhD", "Mr. Sir John  O'Neil III", "Dr", "Mrs Lee-Ann", None]) == ["james whitfield", "john o neil", "", "lee ann", ""]
    parts = [tuple(p) for p in values(spark, text.person_parts, ["James T Kirk", "Cher", "", "Ann Lee"])]
    assert parts == [("james", "t", "kirk"), ("", "", "cher"), ("", "", ""), ("ann", "", "lee")]
    given = spark.createDataFrame([("x y", "Jo", "M", "van Dyke"), ("Jo Dyke", "", None, "")], "n string, f string, m string, s string").select(text.person_parts(*(F.col(c) for c in "nfms"))).collect()
    assert [tuple(g[0]) for g in given] == [("jo", "m", "van dyke"), ("jo", "", "dyke")]
    fp = values(spark, lambda c: text.person_fingerprint(text.person_parts(c)), ["Łukasz Zieliński", "Zielinski, Lukasz", "Lukasz M. Zielinski"])
    assert len(set(fp)) == 1


@pytest.mark.parametrize("pair", [("Kowalczyk", "Kowalchyk"), ("Shevchenko", "Schevchenko"), ("Petrov", "Petroff"), ("Sokolov", "Sokoloff"), ("Zielinski", "Zielinsky"), ("Abramovich", "Abramovic")])
def test_phonetic_doublets(spark, pair):
    a, b = values(spark, text.phonetic_key, list(pair))
    assert a == b != ""


def test_folding(spark):
    assert values(spark, text.normalize_text, ["Щукин Ёжик", "Straße Ærø œuvre", "naïve_x  (A/B)", "ﬁne ＡＢ１", "é"]) == ["shchukin ezhik", "strasse aero oeuvre", "naive_x a b", "fine ab1", "e"]


def test_places(spark):
    assert values(spark, places.postcode, ["EC1V9NR", "ec1v 9nr", "nonsense", "", None, "M1 1AE", "1234567890"]) == ["EC1V 9NR", "EC1V 9NR", "", "", "", "M1 1AE", ""]
    assert values(spark, lambda c: places.address_key(F.lit("12 High St"), F.lit(None), c), ["EC1V 9NR", "EC1V9NR", "EC1V 9NR England", ""]) == ["12|EC1V 9NR", "12|EC1V 9NR", "12 high ec1v 9nr", "12 high"]
    assert values(spark, places.company_number, ["1234567", "SC 123456", "sc1", "123456789", "ABC", "", None, "1A2"]) == ["01234567", "SC123456", "SC000001", "123456789", "ABC", "", "", "A0000012"]
    assert values(spark, places.country_code, ["British", "GB", "gb", "zz", "British, Irish", "Cypriot/Greek", "Atlantis", None, "U.K.", "French and Swiss"]) == ["GB", "GB", "GB", "", "GB", "CY", "", "", "GB", "FR"]
    assert values(spark, lambda c: places.country_code(c, {"atlantis": "AT"}), ["Atlantis"]) == ["AT"]


def test_control(spark):
    df = spark.createDataFrame([
        (1, ["ownership-of-shares-25-to-50-percent", "voting-rights-75-to-100-percent"]), (2, ["voting-rights-50-to-75-percent-as-trust"]), (3, ["right-to-appoint-and-remove-directors-as-firm", "something-new"]), (4, []), (5, None), (6, ["", None]),
        (7, ["ownership-of-shares-25-to-50-percent", "ownership-of-shares-75-to-100-percent-limited-liability-partnership"]), (8, ["right-to-appoint-and-remove-members-limited-liability-partnership"]),
    ], "k int, n array<string>")
    got = {r.k: tuple(r.s) for r in df.select("k", control.summarise(F.col("n")).alias("s")).collect()}
    assert got[1] == (["SHARES", "VOTING"], 25.0, 50.0, True, False, [])
    assert got[2] == (["VOTING"], 50.0, 75.0, True, True, ["TRUST"])
    assert got[3] == (["APPOINT_DIRECTORS", "OTHER"], None, None, True, True, ["FIRM"])
    assert got[4] == got[5] == got[6] == ([], None, None, False, False, [])
    assert got[7] == (["SHARES"], 25.0, 100.0, True, True, ["LLP"]) and got[8][5] == ["LLP"]


def test_jaro_winkler_is_duckdbs():
    import random

    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.choice([1, 3, 8, 20, 90]))) for _ in range(600)] + ["", "łukasz", "lukasz"]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(3000)] + [("łukasz", "lukasz"), ("", "")]
    got = similarity.jaro_winkler_pairs([a for a, _ in pairs], [b for _, b in pairs])
    con = duckdb.connect()
    con.execute("CREATE TABLE p (k INT, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(k, a, b) for k, (a, b) in enumerate(pairs)])
    want = [r[0] for r in con.execute("SELECT jaro_winkler_similarity(a, b) FROM p ORDER BY k").fetchall()]
    assert max(abs(x - y) for x, y in zip(got, want, strict=True)) < 1e-9
