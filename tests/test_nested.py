import pytest

from larkspur.operators.nested import dewey_nodes, flat_table, flat_tables

KIND = "id bigint, a array<struct<x:string,b:array<struct<y:int>>,s:array<string>,n:array<int>>>, r struct<a:array<struct<z:int>>>"


@pytest.fixture
def df(spark):
    rows = [
        (1, [("p", [(1,), None, (3,)], ["u", None], [7]), None, (None, None, [], None)], ([(9,)],)),
        (2, None, None),
        (3, [], (None,)),
    ]
    return spark.createDataFrame(rows, KIND)


def test_nodes(df):
    n = {r["node_path"]: (r["record_id"], list(r["label"]), list(r["parent_label"]), r["depth"]) for r in dewey_nodes(df, "id", ["a", "r"]).collect()}
    assert n == {
        "a[0]": (1, [0, 0], [], 1),
        "a[0].b[0]": (1, [0, 0, 1, 0], [0, 0], 2),
        "a[0].b[2]": (1, [0, 0, 1, 2], [0, 0], 2),
        "a[0].s[0]": (1, [0, 0, 2, 0], [0, 0], 2),
        "a[2]": (1, [0, 2], [], 1),
        "r.a[0]": (1, [3, 0], [], 1),
    }


def test_tables_join_back(df):
    t = flat_tables(df, "id", ["a", "r"])
    assert set(t) == {"a", "a[].b", "a[].s", "r.a"}
    child, parent = t["a[].b"], t["a"]
    j = child.alias("c").join(parent.alias("p"), ["record_id"]).where("c.parent_label = p.label").select("c.y", "p.x").collect()
    assert sorted(map(tuple, j)) == [(1, "p"), (3, "p")]
    assert [r["value"] for r in t["a[].s"].collect()] == ["u"] and [r["z"] for r in t["r.a"].collect()] == [9]
    assert parent.where("n is not null").first()["n"] == [7]


def test_labels_agree(df):
    for path, t in flat_tables(df, "id", ["a", "r"]).items():
        nodes = {tuple(r["label"]) for r in dewey_nodes(df, "id", ["a", "r"]).where(f"schema_path = '{path}'").collect()}
        if path != "r.a":  # numbered within its own column there
            assert {tuple(r["label"]) for r in t.collect()} == nodes


def test_empty_and_clashes(spark, df):
    assert dewey_nodes(df.limit(0), "id", ["a"]).count() == 0
    d = df.selectExpr("id as label", "id as node_path", "id as schema_path", "a", "r")
    assert dewey_nodes(d, "label", ["a"]).count() == 5
    one = spark.createDataFrame([(1, [("v", 2)])], "id bigint, a array<struct<label:string,k:int>>")
    assert flat_table(one, "id", "a").columns == ["record_id", "label", "parent_label", "k"]


def test_long_array(spark):
    d = spark.range(1).selectExpr("id", "transform(sequence(1, 20000), x -> named_struct('y', x)) as a")
    assert dewey_nodes(d, "id", ["a"]).count() == 20000


def test_every_path_has_a_query(spark, tmp_path):
    from larkspur.plans.nested_queries import QUERIES

    e = "struct<hashtags: array<struct<text: string, indices: array<int>>>, user_mentions: array<struct<indices: array<int>>>, urls: array<struct<indices: array<int>>>, media: array<struct<indices: array<int>>>>"
    own = {"hashtags": [None, {"text": "a", "indices": [0, 2]}], "user_mentions": [{"indices": [3, 5]}], "urls": [], "media": None}
    deep = {"hashtags": [{"text": None, "indices": None}], "urls": [{"indices": []}], "media": [{"indices": [7, 8]}]}
    rows = [(1, own, {"retweeted_status": {"entities": deep}}), (1, own, {"retweeted_status": {"entities": deep}}), (2, None, {"entities": own}), (3, None, None)]
    spark.createDataFrame(rows, f"tweet_id bigint, entities {e}, retweeted_status struct<entities: {e}, retweeted_status: struct<entities: {e}>>").write.parquet(str(tmp_path / "tweets.parquet"))
    s = "struct<synsets: array<string>>"
    rel = [None, {"predicate": "on", "synsets": ["x", None, "y"], "object": None, "subject": {"synsets": ["z"]}}]
    spark.createDataFrame([(1, rel)], f"image_id bigint, relationships array<struct<predicate: string, synsets: array<string>, object: {s}, subject: {s}>>").write.parquet(str(tmp_path / "relationships.parquet"))
    got = lambda q: sorted((tuple(r) for r in QUERIES[q](spark, str(tmp_path)).collect()), key=str)
    first, second, third = "entities", "retweeted_status.entities", "retweeted_status.retweeted_status.entities"
    assert got("p4_hashtags") == [(1, f"{first}.hashtags", "0.1", "", "a", [0, 2]), (1, f"{third}.hashtags", "4.0", "", None, None), (2, f"{second}.hashtags", "0.1", "", "a", [0, 2])]
    assert got("p4_user_mentions") == [(1, f"{first}.user_mentions", "1.0", "", [3, 5]), (2, f"{second}.user_mentions", "1.0", "", [3, 5])]
    assert got("p4_urls") == [(1, f"{third}.urls", "6.0", "", [])] and got("p4_media") == [(1, f"{third}.media", "7.0", "", [7, 8])]
    assert got("p4_relation_synsets") == [(1, "0.1.1.0", "0.1", "x"), (1, "0.1.1.2", "0.1", "y")] and got("p4_subject_synsets") == [(1, "0.1.3.0", "0.1", "z")]
