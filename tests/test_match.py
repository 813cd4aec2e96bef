import random

from larkspur.operators import lexicon, match
from larkspur.operators.frames import frame_sentences
from larkspur.operators.metrics import null_counter_name, observe_nulls, priority_counts

ID = {x: f"{i:08d}-n" for i, x in enumerate("abcdefgr")} | {"q": "00000099-v"}


def refs(spark, docs):
    return spark.createDataFrame([(d, i, ID.get(x, x)) for d, xs in docs.items() for i, x in enumerate(xs)], "doc_id bigint, place int, ref string")


def lex(spark, rels):
    r = spark.createDataFrame([(ID[k], [ID[x] for x in o], [ID[x] for x in s]) for k, (o, s) in rels.items()], "rel string, objects array<string>, subjects array<string>")
    return r, spark.createDataFrame([(i, n) for n, i in ID.items()], "id string, name string")


def test_v1(spark):
    rel, syn = lex(spark, {"r": ("ab", "c"), "q": ("a", "a")})
    docs = {1: "a", 2: "de", 3: "ra", 4: "rac", 5: "rabc", 6: "qa", 7: ["xyz", "nope"], 8: "rr"}
    got = {r["doc_id"]: (r["priority"], r["matches"]) for r in match.score_v1(refs(spark, docs), rel, syn).collect()}
    assert got == {1: (0, ""), 2: (1, ""), 3: (2, ""), 4: (3, "<a,r,c>"), 5: (3, "<(a|b),r,c>"), 6: (2, ""), 8: (1, "")}


def test_v2(spark):
    raw = spark.createDataFrame([(ID["r"], ID["a"], ID["b"]), (ID["q"], ID["c"], ID["c"])], "rel string, obj string, subj string")
    syn = lex(spark, {})[1]
    docs = {1: "rab", 2: "ra", 3: "rb", 4: "ab", 5: "r", 6: "qc"}
    got = {r["doc_id"]: r["priority"] for r in match.score_v2(refs(spark, docs), lexicon.triple_index(raw), syn).collect()}
    assert got == {1: 3, 2: 2, 3: 2, 6: 3}


def test_v1_random(spark):
    r = random.Random(3)
    rels = {k: ("".join(r.sample("abcdef", r.randrange(0, 4))), "".join(r.sample("abcdef", r.randrange(0, 4)))) for k in "rq"}
    docs = {d: [r.choice("abcdefrq") for _ in range(r.randrange(1, 7))] for d in range(300)}
    rel, syn = lex(spark, rels)

    def brute(xs):
        rs, os = [x for x in xs if x in rels], {x for x in xs if x not in rels}
        p = 1 if len(rs) + len(os) > 1 else 0
        for k in rs:
            o, s = set(rels[k][0]) & os, set(rels[k][1]) & os
            if o - s and s:
                return 3
            if o or s:
                p = 2
        return p

    got = {x["doc_id"]: x["priority"] for x in match.score_v1(refs(spark, docs), rel, syn).collect()}
    assert got == {d: brute(xs) for d, xs in docs.items()}


def test_lexicon(spark):
    images = spark.sql(
        "select 1L as image_id, array(named_struct('predicate', 'on', 'synsets', array('on.r.01'), 'object', named_struct('synsets', array('dog.n.01')), 'subject', named_struct('synsets', array('mat.n.01', 'x'))), null, "
        "named_struct('predicate', 'ON', 'synsets', array('on.r.01'), 'object', named_struct('synsets', array('dog.n.01')), 'subject', named_struct('synsets', cast(array() as array<string>)))) as relationships union all select 2L, null"
    )
    wn = spark.createDataFrame([("on.r.01", 5, "r"), ("dog.n.01", 2084071, "n"), ("dog.n.01", 9999999, "n"), ("mat.n.01", 7, "n")], "name string, syn_offset bigint, pos string")
    raw, rel, syn = lexicon.build_lexicon(images, wn)
    assert raw.collect() == [("00000005-r", "02084071-n", "00000007-n")]
    assert rel.collect() == [("on", "00000005-r", ["02084071-n"], ["00000007-n"])]
    assert dict(syn.collect()) == {"00000005-r": "on.r.01", "02084071-n": "dog.n.01", "00000007-n": "mat.n.01"}


def test_frames(spark):
    df = spark.createDataFrame(
        [
            (1, 3, [("Giving", [("Giving@Donor", "Ann-Marie"), ("Giving@Theme", "a  book!")])]),
            (2, 2, [("Motion", []), (None, [("Motion@Theme", "x")]), ("Motion", [("Motion", "x"), (None, "y")]), None]),
            (3, 1, None),
        ],
        "doc_id bigint, priority int, predicates array<struct<framenet:string,roles:array<struct<framenet:string,str:string>>>>",
    )
    got = [r["sentence"] for r in frame_sentences(df).orderBy("doc_id", "place").collect()]
    assert got == ["In frame (3) GIVING 'AnnMarie' is the 'Donor' and 'a book' is the 'Theme'", "In frame (2) MOTION ", "In frame (2) MOTION "]


def test_metrics(spark):
    df, o = observe_nulls(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "/tmp/out-1/frames")
    df.collect()
    assert o.get == {"rows_with_null": 1, "rows": 2} and null_counter_name("/tmp/out-1/frames") == "null-counter--tmp-out-frames"
    assert dict(priority_counts(spark.createDataFrame([(3,), (3,), (2,)], "priority int")).collect()) == {"PRIORITY_3": 2, "PRIORITY_2": 1}
