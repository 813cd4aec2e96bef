import random

from pyspark.sql import functions as F

from larkspur.operators import encode, terms


def frame(spark, docs):
    return spark.createDataFrame([(d, i, w, p, None) for d, ts in docs.items() for i, (w, p) in enumerate(ts)], "doc_id bigint, idx int, lemma string, pos string, synset string")


def texts(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["doc_id"], r["idx"], r["sub"])):
        out.setdefault(r["doc_id"], []).append((r["lemma"], r["pos"]))
    return out


def stuck(ts):
    held, out = None, []
    for w, p in ts:
        if p == "CD" or (held and held[1] == "CD" and p in (":", ",", ".")):
            held = (w, p)
            continue
        if held:
            out += [("<nmb>", "CD")] + ([held] if held[1] != "CD" else [])
        out.append((w, p))
    return out


def test_examples(spark):
    docs = {
        1: [("We", "PRP"), ("paid", "VBD"), ("10", "CD"), (",", "."), ("000", "CD"), ("euros", "NNS"), ("today", "NN"), (".", ".")],
        2: [("a", "NN"), ("b", "NN")],
        3: [("5", "CD")],
        4: [("5", "CD"), (".", "."), ("x", "NN"), ("y", "NN")],
    }
    t = texts(terms.clean_terms(frame(spark, docs)))
    assert t == {1: [("We", "PRP"), ("paid", "VBD"), ("<nmb>", "CD"), ("euros", "NNS"), ("<nmb>", "CD"), ("today", "NN")], 2: docs[2], 4: [("<nmb>", "CD"), (".", "."), ("x", "NN"), ("<nmb>", "CD"), (".", "."), ("y", "NN")]}
    fixed = texts(terms.clean_terms(frame(spark, docs), mode="fixed"))
    assert fixed[3] == [("<nmb>", "CD")] and fixed[4] == [("<nmb>", "CD"), (".", "."), ("x", "NN"), ("y", "NN")]
    assert fixed[1][:4] == [("We", "PRP"), ("paid", "VBD"), ("<nmb>", "CD"), ("euros", "NNS")]


def test_random_against_state(spark):
    r = random.Random(1)
    docs = {d: [(f"w{i}", r.choice(["CD", ",", ".", ":", "NN", None])) for i in range(r.randrange(0, 14))] for d in range(400)}
    want = {d: s for d, ts in docs.items() if (s := stuck(ts))}
    assert texts(terms.clean_terms(frame(spark, docs))) == want


def test_strings(spark):
    df = frame(spark, {1: [("a", "NN"), ("b", None)]})
    assert terms.annotated_text(df).first()["text"] == "a@NN b@null"
    p = spark.createDataFrame([("a@NN@02084071-n",), ("a",)], "x string").select(terms.parse_term(F.col("x"))).collect()
    assert p[0][0] == ("a", "NN", "02084071-n") and p[1][0] is None


def test_synset_pick(spark):
    df = spark.sql("select 1L as doc_id, array(named_struct('form', 'dog', 'morphofeat', 'NN', 'refs', array(named_struct('resource', 'w', 'reference', 'x'), named_struct('resource', 'w', 'reference', '02084071-n'), named_struct('resource', 'w', 'reference', '00000001-v')))) as terms")
    assert terms.exploded(df).first()["synset"] == "02084071-n"


def test_counts(spark):
    df = spark.createDataFrame([("dog",)] * 101 + [("cat",)] * 100, "lemma string")
    c = terms.count_terms(df, "lemma", 100)
    assert c.collect() == [("dog", 101)] and terms.count_strings(c, "lemma").first()[0] == "(dog,101)"


def test_encoders(spark):
    df = frame(spark, {1: [("dog", "NN"), ("flies", "XX")]})
    words = spark.createDataFrame([("dog", 0), ("run", 1)], "token string, id int")
    pos = spark.createDataFrame([("NN", 0), ("VB", 1)], "token string, id int")
    assert encode.encode_text(df, words).first()["text"] == "dog <unk>"
    assert encode.encode_text(df, words, pos).first()["text"] == "dog@NN <unk>@<unk>"
    assert encode.encode_ids(df, words, pos).first()[1:] == ([0, 0], [0, 0])
    assert encode.encode_ids(df, words, pos, oov_id=-1).first()[1:] == ([0, -1], [0, -1])
    twice = words.unionByName(words)
    try:
        encode.encode_text(df, twice).collect()
        raise AssertionError("a token stands twice")
    except Exception as e:  # noqa: BLE001
        assert "twice in the dictionary" in str(e)


def test_dictionary_order(spark):
    d = encode.dictionary(spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), (None, 3)], "w string, n bigint"), "w")
    assert [tuple(r) for r in d.orderBy("id").collect()] == [("c", 0, 9), ("a", 1, 5), ("b", 2, 5)]
