import os
import random

import pytest

from larkspur.llm import encoding

JSON = f"{encoding.TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(JSON), reason="no tokenizer files")
BITS = ["'", "r", "e", " ", "  ", "\n", "'re", "'ll", "don", "é", "日本", "7", "42", ".", "!!", " 's", "\t", "😀", "aaa", "<|endoftext|>", "the old engine near the station"]


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def made(n, most, seed):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randrange(1, most))) for _ in range(n)]


def test_any_cuts_are_repaired():
    e, r = encoding.Encoder(f"{encoding.TOKENIZERS}/{encoding.VOCABULARY}"), random.Random(5)
    texts = made(400, 80, 6)
    for x, want in zip(texts, whole(texts), strict=True):
        for most in (2, 7, 40):
            parts, at = [], 0
            while at < len(x):
                end = min(len(x), at + r.randrange(1, most))
                parts.append((x[at:end], *e.chunk(x[at:end])))
                at = end
            assert encoding.joined(e, parts) == want


def test_cuts_follow_content():
    passage = " ".join(made(60, 6, 7))
    a, b = "first beginning. " + passage, "quite another one: " + passage
    chunks = lambda t: [t[i:j] for i, j in zip([0, *encoding.cuts(t)], encoding.cuts(t), strict=False)]
    assert "".join(chunks(a)) == a and len(set(chunks(a)) & set(chunks(b))) >= 0.6 * len(chunks(a))
    assert max(map(len, chunks("x" * 5000))) <= encoding.MOST


def test_encode(spark):
    texts = [None, "", *made(300, 60, 8), "very long " * 30_000]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [rows[5], rows[5]]
    got = {r["key"]: r["ids"] for r in encoding.encode(spark.createDataFrame(rows, "id bigint, text string"), "id", "text").collect()}
    want = [[], [], *whole(texts[2:])]
    assert got == dict(enumerate(want))


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "id bigint, text string, chunk string, t int, ids string")
    assert encoding.encode(df, "id", "text").count() == 0
    one = spark.createDataFrame([(1, "hot " * 20, "x", 1, "y")] * 3, df.schema)
    assert len(encoding.encode(one, "id", "text").collect()) == 1
