import itertools
import random
import unicodedata

from larkspur.llm import lookalike
from larkspur.llm.chars import latin_table, plain_table

WAYS = [
    lambda t: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in t),
    lambda t: unicodedata.normalize("NFD", t),
    lambda t: t.replace(" ", " "),
    lambda t: t.replace("e", "e​", 1),
    lambda t: t.replace("a", "а").replace("o", "ο"),
    lambda t: t.replace("fi", "ﬁ"),
    lambda t: t.replace("K", "K"),
    lambda t: t.upper(),
    lambda t: t + "!",
    lambda t: t.replace(" ", "  "),
    lambda t: t.replace("é", "e"),
]
SAME = range(7)


def test_pairs_against_brute_force(spark):
    r = random.Random(1)
    base = ["Kate a fini le café", "una caña más", "of the old kite", "Привет мир", "日本 テスト", "!!!", ""]
    rows = []
    for k in range(160):
        t = r.choice(base)
        for w in r.sample(WAYS, r.randrange(0, 3)):
            t = w(t)
        rows.append((k, t))
    rows += [(900, None), (3, rows[3][1])]  # a null, and a repeated row
    got = sorted(map(tuple, lookalike.alike_pairs(spark.createDataFrame(rows, "id bigint, text string"), "id").collect()))

    def form(t):
        t = unicodedata.normalize("NFC", t.translate(plain_table()))
        return unicodedata.normalize("NFC", t.translate(latin_table()))

    some = {k: t for k, t in rows if t and any(c.isalnum() for c in t)}
    want = sorted((a, b) for (a, x), (b, y) in itertools.combinations(sorted(some.items()), 2) if x != y and form(x) == form(y))
    assert got == want and len(want) > 50


def test_forms(spark):
    rows = [(1, None), (2, ""), (3, "Ｆｕｌｌ ｗｉｄｔｈ"), (4, "résumé"), (5, "рaypal"), (6, "oﬃce"), (7, "za‍p­"), (8, "ｶﾞ"), (9, "plain Text, as it is")]
    got = {r["key"]: r["form"] for r in lookalike.with_form(spark.createDataFrame(rows, "id int, text string"), "id").collect()}
    assert got == {1: None, 2: "", 3: "Full width", 4: "résumé", 5: "paypal", 6: "office", 7: "zap", 8: "ガ", 9: "plain Text, as it is"}


def test_consistent_forms_keep_scripts(spark):
    want = {
        "Привет мир": "Привет мир", "Пpивeт мир": "Привет мир", "рaypal": "paypal", "рaураl login": "paypal login", "Привет сор и cop": "Привет сор и cop", "Ωmega αβγ": "Ωmega αβγ", "ＦＵＬＬ Кate": "FULL Kate",
        "ﬁne é": "fine é", "αpple": "apple", "Ελλάδα": "Ελλάδα", "Բարեւ": "Բարեւ", "za‍p­ ｶﾞ": "zap ガ", "": "", None: None, "a" * 100_000 + "е": "a" * 100_000 + "e",
    }
    df = spark.createDataFrame(list(enumerate(want)), "id int, text string")
    got = {r["key"]: r["form"] for r in lookalike.consistent(df, "id").collect()}
    assert [got[k] for k in range(len(want))] == list(want.values())


def test_classes_against_pairs(spark):
    r = random.Random(5)
    rows = []
    for k in range(200):
        t = r.choice(["Kate a fini", "une autre", "un", "日本"])
        for w in r.sample(WAYS[:7], r.randrange(0, 3)):
            t = w(t)
        rows.append((k, t))
    df = spark.createDataFrame([*rows, rows[3], (900, None), (901, "...")], "id bigint, text string")
    links, classes = dict.fromkeys(range(200), 0), {k: k for k in range(200)}
    for a, b in sorted(map(tuple, lookalike.alike_pairs(df, "id").collect())):
        links[a], links[b] = links[a] + 1, links[b] + 1
        classes[b] = min(classes[b], classes[a])
    got = {x["key"]: (x["class"], x["links"]) for x in lookalike.alike_classes(df, "id").collect()}
    same = {}
    for k, t in rows:
        same.setdefault(t, k)
    assert {k: v[1] for k, v in got.items()} == links
    assert all(got[k][0] <= min(classes[k], same[t]) and got[got[k][0]][0] == got[k][0] for k, t in rows)
    assert lookalike.alike_classes(df.limit(0), "id").count() == 0


def test_recall_on_letters_of_no_table(spark):
    # Pairs made from letters listed here, not from the operator's tables, and from mathematical letters and invisible signs.
    other = {"o": "оο", "a": "аα", "A": "АΑ", "i": "іι", "p": "рρ", "E": "ЕΕ", "T": "ТΤ", "x": "хχ"}
    r, rows, pairs = random.Random(8), [], 0
    for k in range(300):
        t = f"pattern {k} Tea Axe oxide"
        i = r.choice([n for n, c in enumerate(t) if c in other])
        u = r.choice([t[:i] + r.choice(other[t[i]]) + t[i + 1 :], "".join(chr(0x1D400 + ord(c) - 65) if c.isupper() else chr(0x1D41A + ord(c) - 97) if c.islower() else c for c in t), t.replace("e", "e\u2063"), t.replace(" ", "\u2007", 1)])
        rows += [(2 * k, t), (2 * k + 1, u)]
        pairs += 1
    got = lookalike.alike_pairs(spark.createDataFrame(rows, "id bigint, text string"), "id").where("key_b = key_a + 1 and key_a % 2 = 0").count()
    assert got / pairs > 0.97


def test_hot_form_makes_no_pairs(spark):
    df = spark.range(20000).selectExpr("id", "'same text' as text").unionByName(spark.createDataFrame([(-1, "same text")], "id bigint, text string"))
    assert lookalike.alike_pairs(df, "id").count() == 20000


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], "id bigint, text string, key string, form string, f1 int")
    assert lookalike.alike_pairs(df, "id").count() == 0
    long = spark.createDataFrame([(1, "é" * 300_000), (2, "é" * 300_000)], "id bigint, text string")
    assert [tuple(r) for r in lookalike.alike_pairs(long, "id").collect()] == [(1, 2)]


def test_tables_are_one_to_one():
    a, b = lookalike.compatibility()
    assert len(a) == len(b) == len(set(a)) or len(a) == len(b)
    for x, y in lookalike.LOOKALIKES:
        assert len(x) == len(y)
