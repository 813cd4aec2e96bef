import gzip
import http.server
import random
import threading
from urllib.parse import parse_qs

import pytest
from pyspark.sql import functions as F

from larkspur.config import StorageConfig
from larkspur.functions import protobuf as P
from larkspur.operators.annotate import HttpAnnotator, RuleAnnotator
from larkspur.plans import cli, pipelines
from larkspur.sources import naf, named, text, tfrecord, tsv


def values(df):
    return [r[0] for r in df.collect()]


def test_lines(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/a.txt").write_bytes(b"a\rb\r\nc\n\nd")
    assert values(text.read_lines(spark, str(tmp_path / "d"))) == ["a\rb", "c", "", "d"]
    assert values(text.read_blobs(spark, StorageConfig(str(tmp_path / "d"), "e", "a"))) == ["a", "b", "c", "", "d"]
    (tmp_path / "x.txt").write_bytes("é|ü|".encode("latin-1"))
    assert values(text.read_lines(spark, str(tmp_path / "x.txt"), "|", "ISO-8859-1")) == ["é", "ü"]
    with pytest.raises(LookupError):
        text.read_lines(spark, str(tmp_path), charset="no-such")
    with pytest.raises(Exception, match="longer than"):
        text.read_lines(spark, str(tmp_path / "d"), max_length=2).collect()


def test_cut_gzip(spark, tmp_path):
    data = gzip.compress(b"".join(b"line %06d\n" % i for i in range(20000)))
    (tmp_path / "a.gz").write_bytes(data[: len(data) // 2])
    n = text.read_lines(spark, str(tmp_path / "a.gz")).count()
    assert 0 < n < 20000
    with pytest.raises(Exception):  # noqa: B017
        text.read_lines(spark, str(tmp_path / "a.gz"), tolerate_cut=False).count()


def test_dispatch_and_documents(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/in-1.txt").write_text("x\ny\n\n")
    (tmp_path / "conf.json").write_text(f'{{"azure.connection": "{tmp_path}", "azure.container.name": "c", "azure.blob.prefix": "in"}}')
    assert values(text.open_text(spark, str(tmp_path / "conf.json"))) == ["x", "y", ""]
    assert values(text.open_text(spark, str(tmp_path / "c"))) == ["x", "y", ""]
    assert [tuple(r) for r in text.read_documents(spark, str(tmp_path / "c")).collect()] == [("in-1.txt", 0, "x"), ("in-1.txt", 1, "y")]


def test_config():
    c = StorageConfig.of({"azure.connection": "x", "azure.blob.break": "5", "azure.blob.enable-compression": True})
    assert (c.rows_per_part, c.flush, c.compress, c.suffix, c.prefix) == (5, 1000, True, ".gz", "output") and c.container
    assert StorageConfig().suffix == ".txt"


def test_tsv(spark, tmp_path):
    df = spark.createDataFrame([(None, " a\t b ", ""), ("x", "y", "z")], "a string, b string, c string").coalesce(1)
    tsv.write_tsv(df, str(tmp_path / "o"))
    assert b"".join(p.read_bytes() for p in (tmp_path / "o").glob("part*")) == b"<unk>\ta b\t \r\nx\ty\tz\r\n"
    tsv.write_tsv(spark.range(7).toDF("a"), str(tmp_path / "g"), gzip=True, limit=3)
    assert sorted(len(gzip.decompress(p.read_bytes()).split()) for p in (tmp_path / "g").glob("part*")) == [1, 3, 3]
    assert sorted(dict(tsv.limited_files(spark.range(7), ["id"], 3).groupBy("file").count().collect()).items()) == [(0, 2), (1, 3), (2, 2)]
    tsv.write_tsv_limited(spark.range(7).coalesce(1), str(tmp_path / "l"), 3)
    assert {p.name: p.read_bytes().count(b"\r\n") for p in (tmp_path / "l").iterdir()} == {"1-0": 2, "1-1": 3, "1-2": 2}
    tsv.write_tsv_limited(spark.range(5).coalesce(1), str(tmp_path / "z"), 2, gzip=True)
    assert {p.name: gzip.decompress(p.read_bytes()) for p in (tmp_path / "z").iterdir()} == {"1-0": b"0\r\n", "1-1": b"1\r\n2\r\n", "1-2": b"3\r\n4\r\n"}


def test_numbered(spark):
    from larkspur.session import numbered

    df = spark.range(1000, numPartitions=7).selectExpr("(id * 7919) % 1000 as id", "id as x")
    got = numbered(df, ["id"], "n")
    assert got.where("n <> id").count() == 0 and got.count() == 1000
    assert numbered(df.limit(0), ["id"], "n").count() == 0
    assert sorted(r["n"] for r in numbered(df.selectExpr("1 as id"), ["id"], "n").collect()) == list(range(1000))


def test_writers_keep_the_tasks_before_them(spark, tmp_path):
    df = spark.range(100, numPartitions=5).selectExpr("cast(id as string) as v", "spark_partition_id() as p")
    named.write_named(df.selectExpr("concat(v, ' ', p)"), StorageConfig(str(tmp_path), "n", "p"))
    assert len({x.split()[1] for x in (tmp_path / "n/p.txt").read_text().split("\n")}) == 5
    named.write_named(df.orderBy("v").select("v"), StorageConfig(str(tmp_path), "n", "s"), ordered=True)
    assert (tmp_path / "n/s.txt").read_text().split("\n") == sorted(str(i) for i in range(100))


def test_packed_blobs(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/b-1.txt").write_bytes(gzip.compress(b"x\ry\r\nz"))
    (tmp_path / "c/b-2.txt").write_bytes(b"plain\n")
    (tmp_path / "c/b-3.txt").write_bytes(gzip.compress(b"".join(b"line %06d\n" % i for i in range(20000)))[:-5000])
    got = values(text.read_blobs(spark, StorageConfig(str(tmp_path), "c", "b")))
    assert got[:4] == ["x", "y", "z", "plain"] and 0 < len(got) - 4 < 20000
    assert values(text.read_blobs(spark, StorageConfig(str(tmp_path), "c", "b-2"))) == ["plain"]


def test_cluster_needs_a_shared_folder():
    from larkspur.session import shared_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "relations.tsv").write_text("on\tr1\ta,b\tc\n\nover\tr1\ta\t\n")
    (tmp_path / "synsets.tsv").write_text("a\t x \na\ty\n")
    (tmp_path / "raw_relations.tsv").write_text("r1\ta\tc\nr1\ta\tc\n")
    (tmp_path / "word.dict").write_text('the\t9\n"\t5\ndog\t3\n')
    raw, rel, syn = pipelines.read_lexicon(spark, str(tmp_path))
    assert rel.collect() == [("over", "r1", ["a"], [""])] and syn.collect() == [("a", "y")] and raw.count() == 2
    assert [tuple(r) for r in tsv.read_dictionary(spark, str(tmp_path / "word.dict")).orderBy("id").collect()] == [("the", 0), ('"', 1), ("dog", 2)]


def test_named(spark, tmp_path):
    c = StorageConfig(str(tmp_path), "c", "p", None, 2)
    named.write_named(spark.createDataFrame([(x,) for x in "abcd"], "v string").coalesce(1), c)
    assert {p.name: p.read_bytes() for p in (tmp_path / "c").iterdir()} == {"p.txt": b"a\nb", "p-1.txt": b"c\nd", "p-2.txt": b""}
    assert named.output_exists(spark, c) and not named.output_exists(spark, StorageConfig(str(tmp_path), "c", "q"))
    with pytest.raises(Exception, match="p.txt"):
        named.write_named(spark.createDataFrame([("x",)], "v string"), c)
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == ["p-1.txt", "p-2.txt", "p.txt"]
    z = StorageConfig(str(tmp_path), "z", "p", None, 0, 0, True)
    named.write_named(spark.range(8).selectExpr("cast(id as string)"), z, tasks=2)
    assert sorted(p.name for p in (tmp_path / "z").iterdir()) == ["p-0-2.gz", "p-1-2.gz"]
    assert named.part_name("p", "", 0, 3, 8) == "p-3-8"
    r = named.list_chunks(spark, c).collect()
    assert [(x["base"], x["chunks"], x["bytes"], x["size"]) for x in r] == [("p", 3, 6, "0.01KB")]
    named.assemble(spark, z, str(tmp_path / "all"))
    assert sorted(gzip.decompress(next((tmp_path / "all").glob("part*")).read_bytes()).split()) == [b"%d" % i for i in range(8)]
    assert spark.createDataFrame([("dog", 101)], "a string, b int").select(named.tuple_string(F.col("a"), F.col("b"))).first()[0] == "(dog,101)"


def test_protobuf_golden():
    a = P.example({"pos": (P.INTS, [1, 2]), "text": (P.INTS, [3, 300])})
    assert a.hex() == "0a200a0d0a03706f7312061a040a0201020a0f0a047465787412071a050a0303ac02"
    assert P.example({"pos": (P.INTS, []), "text": (P.INTS, [])}).hex() == "0a170a090a03706f7312021a000a0a0a047465787412021a00"
    assert P.frame(a).hex() == "220000000000000078113dfd0a200a0d0a03706f7312061a040a0201020a0f0a047465787412071a050a0303ac028d8320ce"
    r = random.Random(1)
    records = [r.randbytes(n) for n in (0, 1, 9, 63, 64, 65, 300, 5000, 100_000)] + [b"123456789"] * 2
    by_bytes = []
    for x in records:
        c = 0xFFFFFFFF
        for y in x:
            c ^= y
            for _ in range(8):
                c = c >> 1 ^ P.POLYNOMIAL * (c & 1)
        by_bytes.append(c ^ 0xFFFFFFFF)
    assert P.crc32c_many(records).tolist() == [P.crc32c(x) for x in records] == by_bytes and P.crc32c_many([]).size == 0
    lists = [[0, 127, 128, 300, 2**40, -1, 2**63 - 1], [], None, [5]]
    assert P.packed_lists(lists) == [b"".join(P.varint(v) for v in x or []) for x in lists]
    assert P.crc32c(b"123456789") == 0xE3069283 and P.unmask(P.mask(12345)) == 12345
    two = P.example({"pos": (P.INTS, [1])}) + P.example({"pos": (P.INTS, [7]), "text": (P.INTS, [9])})
    assert {k: v["ints"] for k, v in P.read_example(two).items()} == {"pos": [7], "text": [9]}
    m = P.read_example(P.example({"b": (P.BYTES, [b"x", b""]), "f": (P.FLOATS, [0.5, -1.0]), "i": (P.INTS, [-1, 2**62])}))
    assert m["b"]["bytes"] == [b"x", b""] and m["f"]["floats"] == [0.5, -1.0] and m["i"]["ints"] == [-1, 2**62]
    s = P.sequence_example({"n": (P.INTS, [2])}, {"w": [(P.INTS, [1]), (P.INTS, [])]})
    context, lists = P.read_sequence_example(s)
    assert context["n"]["ints"] == [2] and [x["ints"] for x in lists["w"]] == [[1], []]
    with pytest.raises(ValueError):
        list(P.frames(P.frame(a)[:-1]))


def test_tfrecord(spark, tmp_path):
    tfrecord.register(spark)
    df = spark.createDataFrame([(bytes([i]) * i,) for i in range(50)], "value binary")
    df.write.format("tfrecord").mode("append").option("path", str(tmp_path / "t")).save()
    back = spark.read.format("tfrecord").load(str(tmp_path / "t"))
    assert sorted(bytes(r[0]) for r in back.collect()) == sorted(bytes([i]) * i for i in range(50))
    ids = spark.createDataFrame([([1, 2], [3, 300])], "pos array<int>, text array<int>").select(P.term_example("pos", "text").alias("e"))
    got = ids.select(P.decode_example("e").alias("m"), P.masked_crc32c("e").alias("c")).first()
    assert got["m"]["text"]["ints"] == [3, 300] and got["c"] == P.mask(P.crc32c(bytes.fromhex("0a200a0d0a03706f7312061a040a0201020a0f0a047465787412071a050a0303ac02")))


def test_naf(spark, tmp_path):
    terms = [{"form": "dogs", "morphofeat": "NNS", "refs": [{"resource": "WordNet", "reference": "02084071-n"}]}, {"form": "<&>", "morphofeat": ".", "refs": []}]
    predicates = [{"framenet": "Giving", "roles": [{"framenet": "Giving@Donor", "str": "dogs"}]}]
    (tmp_path / "a-0.xml").write_text(naf.naf_text("dogs <&>", terms, predicates), encoding="utf-8")
    (tmp_path / "b.txt").write_text("no")
    d = naf.read_naf(spark, str(tmp_path)).first().asDict(True)
    assert d["terms"] == terms and d["predicates"] == predicates and d["raw_text"] == "dogs <&>"
    assert naf.numbered_name("a.txt", 2) == "a-2.xml" and naf.numbered_name(".a", 1) == ".a-1" and naf.numbered_name("a", 1) == "a-1"
    assert pipelines.frame_dump(spark, str(tmp_path), str(tmp_path / "out"), leading_line=True) == {"COLLECTED_FRAMES": 1}
    assert "".join(p.read_text() for p in (tmp_path / "out").glob("part*")) == "\nIn frame (0) GIVING 'dogs' is the 'Donor'\n"


def test_relationships_file(spark, tmp_path):
    with gzip.open(tmp_path / "r.json.gz", "wt") as f:
        f.write('[{"relationships": [{"predicate": "on", "synsets": ["a"], "object": {"synsets": ["b"]}, "subject": {"synsets": []}}]}, {"relationships": []}]')
    r = naf.read_relationships(spark, str(tmp_path / "r.json.gz"))
    got = {x["image_id"]: x["relationships"] for x in r.collect()}
    assert sorted(got) == [0, 1] and got[0][0]["object"]["synsets"] == ["b"] and got[1] == []


class Service(http.server.BaseHTTPRequestHandler):
    def do_POST(self):
        x = parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())["text"][0]
        body = b"broken" if x == "bad" else naf.naf_text(x, [{"form": w, "morphofeat": "NN", "refs": []} for w in x.split()], []).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


def test_http_annotator(spark, tmp_path):
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    try:
        a = HttpAnnotator(f"http://127.0.0.1:{s.server_port}/text2naf")
        got = a.annotate(spark.createDataFrame([(1, "a béar"), (2, "bad"), (3, None)], "doc_id bigint, text string")).collect()
        assert [(r["doc_id"], [t["form"] for t in r["terms"]]) for r in got] == [(1, ["a", "béar"])] and a.errors.value == 1
        (tmp_path / "in").mkdir()
        (tmp_path / "in/x.txt").write_text("one two\nbad\nthree\n")
        assert pipelines.text_to_naf(spark, str(tmp_path / "in"), str(tmp_path / "out"), a) == 2
        assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["x-0.xml", "x-2.xml"]
    finally:
        s.shutdown()


def test_jobs(spark, tmp_path):
    lex = tmp_path / "lex"
    lex.mkdir()
    (lex / "relations.tsv").write_text("on\t00000005-r\t00000001-n\t00000002-n\n")
    (lex / "raw_relations.tsv").write_text("00000005-r\t00000001-n\t00000002-n\n")
    (lex / "synsets.tsv").write_text("00000005-r\ton.r.01\n00000001-n\tdog.n.01\n00000002-n\tmat.n.01\n")
    (tmp_path / "tweets").mkdir()
    (tmp_path / "tweets/a.txt").write_text('{"user":{"id":1},"text":"dog on mat","lang":"en","entities":{"media":[{"indices":[10,10]}]}}\n{"user":{"id":2},"text":"dog","lang":"en"}\n')
    senses = spark.createDataFrame([("dog", "00000001-n"), ("on", "00000005-r"), ("mat", "00000002-n")], "lemma string, synset string")
    rules = RuleAnnotator(senses)
    counters = pipelines.extract_frames(spark, str(tmp_path / "tweets"), str(tmp_path / "res"), str(lex), annotator=rules)
    nulls = {k: v for k, v in counters.items() if k.startswith("null-counter-")}
    assert len(nulls) == 2 and set(nulls.values()) == {0} and {k: v for k, v in counters.items() if k not in nulls} == {"ERROR": 0, "ANNOTATED_SENTENCES": 1, "FILTER_OUT": 0, "PRIORITY_3": 1}
    assert "".join(p.read_text() for p in (tmp_path / "res/top_frames").glob("part*")).split("\t")[1:] == ["3", "<dog.n.01,on.r.01,mat.n.01>\n"]
    pipelines.extract_text(spark, StorageConfig(str(tmp_path), "c", "texts"), tweets=str(tmp_path / "tweets"))
    assert sorted((tmp_path / "c/texts.txt").read_text().split("\n")) == ["dog", "dog on mat"]
    with pytest.raises(ValueError):
        pipelines.extract_text(spark, StorageConfig(str(tmp_path), "c", "none"))
    target = StorageConfig(str(tmp_path), "c")
    counters = pipelines.blobs_to_frames(spark, StorageConfig(str(tmp_path), "c", "texts"), target, str(lex), rules)
    assert counters == {"ERROR": 0, "ANNOTATED_SENTENCES": 2, "FILTER_OUT": 1, "PRIORITY_3": 1, "COLLECTED_FRAMES": 0}
    assert (tmp_path / "c/high-priority-verb.txt").exists()
    (tmp_path / "many").mkdir()
    (tmp_path / "many/t.txt").write_text("dog runs 10 , 000 miles\n" * 60 + "dog dog\n" * 60)
    assert pipelines.calculate_stats(spark, str(tmp_path / "many"), target) == ["annotated", "word.dict", "postag.dict"]
    assert pipelines.calculate_stats(spark, str(tmp_path / "many"), target) == []
    assert (tmp_path / "c/word.dict").read_text().split("\n")[0] == "dog\t180"
    pipelines.encode_stream(spark, str(tmp_path / "many"), target, str(tmp_path / "c"))
    assert spark.read.format("tfrecord").load(str(tmp_path / "c/examples")).count() == 120
    (tmp_path / "conf.json").write_text(f'{{"azure.connection": "{tmp_path}", "azure.container.name": "c", "azure.blob.prefix": "texts"}}')
    cli.main(["storage", "--azure-config", str(tmp_path / "conf.json"), "--output", str(tmp_path / "x")])


def test_rules(spark):
    d = spark.createDataFrame([(1, "We paid 10,000 euros.")], "doc_id bigint, text string")
    t = RuleAnnotator().annotate(d).first()["terms"]
    assert [(x["form"], x["morphofeat"]) for x in t] == [("We", "NNP"), ("paid", "NN"), ("10,000", "CD"), ("euros", "NNS"), (".", ".")]
