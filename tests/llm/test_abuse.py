import random

import numpy as np

from larkspur.llm import abuse
from larkspur.llm.boosting import Calibrated, Isotonic, Trees

BAD = ["you are a worthless idiot", "go kill yourself already", "du bist ein dreckiges Arschloch", "eres una basura humana, imbécil", "all those migrants are vermin and must be thrown out", "send nudes and i will show you my cock", "free hardcore porn, click now", "sei un idiota, fai schifo"]
GOOD = ["the old engine was repaired near the station", "this heat is killing me", "the clinic offers breast cancer screening", "sex education class moved to room 4", "stop calling each other idiots and talk", "il ponte di legno vicino al museo", "die Feuerwehr putzt den alten Motor", "my stupid printer died again", "tickets are still available", "shoot the photos before sunset"]


def tables(spark, n=600, seed=1):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        bad = r.random() < 0.3
        t = r.choice(BAD if bad else GOOD)
        t = r.choice([str, str, str.upper])(t) + r.choice(["", "!", "!!!", " See you tomorrow."])
        rows.append((k, t, r.choice(["a", "b", None]), bad))
    labels = [(k, "abusive" if b else "none", 1) for k, _, _, b in rows if k % 2 == 0]
    labels[3] = (labels[3][0], "none" if labels[3][1] != "none" else "sexual", 2)  # a slip
    return rows, spark.createDataFrame([x[:3] for x in rows], "tweet_id bigint, text string, source string"), spark.createDataFrame(labels, "tweet_id bigint, label string, annotator int")


def test_held_out(spark):
    rows, tweets, labels = tables(spark)
    got = {r["key"]: r["score"] for r in abuse.score(tweets, labels).collect()}
    held = [(got[k] >= abuse.THRESHOLD) == b for k, _, _, b in rows if k % 2]
    assert np.mean(held) > 0.97


def test_disguise_and_empty(spark):
    _, tweets, labels = tables(spark)
    more = spark.createDataFrame([(10_001, None, "a"), (10_002, "", "a"), (10_003, "you are a w0rthless 1d1ot", None), (10_004, "you are a worthless i d i o t", "a"), (10_005, "yоu аre а wоrthless idi​ot", "a"), (10_006, "the engine " * 20_000, "a")], tweets.schema)
    got = {r["key"]: r["score"] for r in abuse.score(tweets.unionByName(more), labels).collect()}
    assert got[10_001] == got[10_002] == 0.0 and all(got[k] > 0.5 for k in (10_003, 10_004, 10_005)) and got[10_006] < 0.5


def test_phrases_of_no_lexicon_are_learned(spark):
    # Words that stand in no lexicon, some offensive, some not: only the labels tell.
    r, rows = random.Random(3), []
    bad, good = ["you utter {} of a neighbour", "nobody in {} wants your face here", "te voy a {} esta noche"], ["the {} opens at nine", "we saw the {} by the lake", "ayer la {} estaba cerrada"]
    nouns = ["".join(r.choice("bdfglmnprstv") + r.choice("aeiou") for _ in range(3)) for _ in range(400)]
    for k in range(900):
        v = r.random() < 0.35
        rows.append((k, r.choice(bad if v else good).format(r.choice(nouns)), "a", v))
    tweets = spark.createDataFrame([x[:3] for x in rows], "tweet_id bigint, text string, source string")
    labels = spark.createDataFrame([(k, "abusive" if v else "none", 1) for k, _, _, v in rows if k % 3], "tweet_id bigint, label string, annotator int")
    got = {x["key"]: x["score"] for x in abuse.score(tweets, labels).collect()}
    assert np.mean([(got[k] >= abuse.THRESHOLD) == v for k, _, _, v in rows if k % 3 == 0]) > 0.97


def test_no_labels_and_no_tweets(spark):
    _, tweets, labels = tables(spark, 40)
    got = {r["key"]: r["score"] for r in abuse.score(tweets, labels.limit(0)).collect()}
    assert len(got) == 40
    assert abuse.score(tweets.limit(0), labels).count() == 0


def test_share_of_cases_comes_from_all_tweets(spark, monkeypatch):
    # The mean score of all tweets is the share that the scores were moved to: so not from a sample, and no redelivered row counts twice.
    shares, real = [], abuse.prevalence
    monkeypatch.setattr(abuse, "prevalence", lambda *a: shares.append(real(*a)) or shares[-1])
    rows, tweets, labels = tables(spark)
    again = spark.createDataFrame([x[:3] for x in rows if x[3]] * 3, tweets.schema)
    got = {r["key"]: r["score"] for r in abuse.score(tweets.unionByName(again), labels).collect()}
    assert len(got) == len(rows) and abs(np.mean(list(got.values())) - shares[0]) < 0.002


def test_batches_are_searched_at_once(monkeypatch):
    # What a text's features are doesn't turn with its neighbours, and a batch of plain texts costs no search of single texts.
    r = random.Random(7)
    odd = [None, "", "\n", "\n\n.", "you are a w0rthless 1d1ot\nf*** off", "i d i o t\n\nsooo bad", "\u0301a\u0301", "ﬀ\u200bидиот!", "ΣΑΣ İ ß", "バカ 🤬🤬\x00", "x httpſ://a.b @you #tag RT art"]
    texts = [r.choice([*odd, *BAD, *GOOD]) for _ in range(300)]
    f = abuse.Features({"old engine": -2.0, "worthless": 1.5, "you are": 0.5})
    one = np.concatenate([f([t]) for t in texts])
    assert (f(texts) == one).all()
    monkeypatch.setattr(abuse, "AT_ONCE", 100)
    assert (f(texts) == one).all() and not f([None, ""]).any() and f([]).shape == (0, f.size)
    searched, real = [], abuse.undisguised
    monkeypatch.setattr(abuse, "undisguised", lambda t, s: searched.append(t) or real(t, s))
    f(GOOD * 50)
    assert searched == ["sex education class moved to room 4"] * 50


def test_features_by_hand():
    f = abuse.Features({"old engine": -2.0})
    x = f(["Nice old  ENGINE. Yоu​ stupid IDIOT, you!"])[0]
    kinds, near = dict(zip(abuse.KINDS, x[len(abuse.KINDS) : 2 * len(abuse.KINDS)], strict=True)), dict(zip(abuse.NEAR, x[2 * len(abuse.KINDS) :], strict=False))
    assert (kinds["insult"], kinds["second"], kinds["threat"]) == (2, 2, 0) and x[0] == 0.5 and near["threat", "second"] == 200 and 0 < near["insult", "second"] < 10
    assert x[-10] == 0 and x[-9] == 4 and np.allclose(x[-8:], [13 / 41, 1 / 41, 0, 0, 0, 0, 0, 1])
    assert f(["The old engine"])[0][-13:-8].tolist() == [-2, 0, -2, np.float32(-2 / 3), 3]


def test_trees_and_isotonic():
    g = np.random.default_rng(0)
    x = g.normal(size=(800, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    assert np.mean((Trees(rounds=40).fit(x[:600], y[:600]).raw(x[600:]) > 0) == y[600:]) > 0.9
    f = Isotonic().fit(np.arange(6.0), np.array([0, 1, 0, 1, 1, 1.0]))
    assert np.allclose(f(np.arange(6.0)), [0, 0.5, 0.5, 1, 1, 1])
    p = Calibrated(rounds=30).fit(x[:600], y[:600])(x[600:])
    assert abs(p.mean() - y[600:].mean()) < 0.08 and (p >= 0).all() and (p <= 1).all()
    assert Calibrated()(np.zeros((0, 3))).shape == (0,) if hasattr(Calibrated(), "trees") else True
