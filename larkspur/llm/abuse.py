"""Problem 1: a score for abusive, hateful or sexually explicit language in every text.

Boosted trees over dense features, calibrated by isotonic regression. Texts are first freed from disguise (look-alikes, signs for letters, letters spaced
out, drawn out or starred); each sentence is then searched once for all lexicons: general ones in several languages, and one learned from the labelled
texts (word sequences with high or low odds). The features are the strongest sentence's lexicon densities, how near the second person or a group of people
stands, and the text's capitals, punctuation and disguises. What they weigh is learned from the labels alone.

Training reads a bounded sample of labelled texts (MOST_LABELS); every text is scored whole, and the share of cases, which moves all scores, comes from the
scores of all texts.

Defined cases: null and empty texts have score 0; repeated rows get equal scores; without any label the general lexicons' own entries are the examples.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.boosting import Calibrated
from larkspur.llm.chars import Kinds, codes, invisible, may_change, plain, written
from larkspur.llm.sample import bounded
from larkspur.session import cut

#: Labelled texts to learn from, at most.
MOST_LABELS = 20_000
THRESHOLD = 0.5
#: The least score (and the greatest, less than 1 by as much) before scores are moved, and the width of the bins in which all texts' log odds are counted: some 12,000 bins, however many texts.
LEAST, BIN = 0.002, 0.001
#: Characters of a batch's texts that are searched at once, about; a longer text is searched whole.
AT_ONCE = 250_000

# Words that are common in such language, and in harmless talk of the same things, in several languages, without accents. A hyphen ends the
# beginning of a word, _ stands between the words of a phrase.
LEXICON = {
    "insult": """idiot- moron- imbecil- stupid dumb dumbass loser- jerk fool asshole- arsehole- bastard- bitch- cunt- dickhead- scum- retard- whore- slut- pathetic worthless disgusting ugly filthy trash garbage shit- crap
        fuck_off shut_up piece_of_shit son_of_a_bitch go_to_hell screw_you arschloch- wichser- hurensohn- schlampe- hure- missgeburt- trottel- depp- vollidiot- dummkopf- abschaum dreckig- scheiss- fresse verpiss-
        estupid- gilipollas cabron- mierda- puta- zorra- pendej- asqueros- basura callate hijo_de_puta asco stronz- merda- coglion- puttan- troia cretin- deficient- vaffanculo schifo stai_zitto feccia rifiuto
        connard- connass- salop- enfoir- encul- batard- abruti- ordure- pute- putain gueule foutre merde degout- otari- desgracad- vagabund- cuza- lixo nojent- nojo cala_a_boca filho_da_puta
        идиот- дурак- дура сука мраз- твар- ублюд- урод- дерьм- заткни- придур- 馬鹿 バカ アホ クズ くそ ブス きもい""",
    "threat": """kill- die murder- rape- stab- strangle- bleed beat_you hurt_you shoot_you kill_yourself hang_yourself stirb verreck- umbring- erschiess- totschlag- muere- matar- matate crepa crepi muori ammazz- uccid-
        creve- crever tuer meurs egorg- morra morre mata умри сдохни убей убью 死ね 消えろ 殺す""",
    "dehuman": """vermin- parasit- cockroach- rats subhuman- less_than_human savage- infest- invad- breed- plague animals thieves thief disease untermensch- ungeziefer- ratten plaga ratas animales parassit- animali vermine
        cafard- rats praga ratos animais крыс- паразит- 害虫 寄生虫""",
    "group": """people folk migrants immigrants refugees foreigners muslims jews christians gays blacks whites women all every these those auslander migranten fluchtling- inmigrantes migranti migrantes imigrantes leute alle
        todos tutti tous""",
    "expel": """deport- expel- expuls- get_out go_back thrown_out kick_out border camps burn- raus abschieb- verbrenn- fuera echar- echen- cacci- fuori bruci- dehors brul- fora queim- вон""",
    "sexual": """sex- porn- nude- naked horny cock dick tits boobs pussy cum blowjob- xxx anal hardcore undress- erotic- nsfw fuck- fick- nackt- titten muschi- schwanz geil follar- desnud- polla tetas cono verga scopar- nudi tette
        cazz- figa baiser nue nues nichons bite chatte foder nua nuas pelad- buceta- peitos порн- секс- голы- трах- エロ セックス 裸""",
    "second": """you your yourself u ur du dich dir dein- te ti tu tua eres sei toi ta ton voce vai ты тебя твой вы お前 あなた""",
    "context": """clinic- hospital doctor health cancer screening vaccin- medical education class- school lesson- course museum theatre film song book weather heat dog dogs farm printer klinik- arzt gesundheit krebs- kurs unterricht
        schule theater hitze medic- salud clase escuela educacion museo teatro calor salute cancro corso scuola lezione caldo sante cours ecole musee chaleur saude aula escola museu врач клиник- школ- урок- музе- 病院 健康 学校 授業""",
    "against": """stop report- block- harass- bully- apolog- respect moderat- hilfe gewalt acoso respeto molest- rispetto harcel- assedio respeito""",
}
KINDS = list(LEXICON)
HOT = ("insult", "threat", "dehuman", "expel", "sexual")
NEAR = [("insult", "second"), ("threat", "second"), ("sexual", "second"), ("dehuman", "group"), ("expel", "group"), ("insult", "context"), ("sexual", "context"), ("insult", "against")]

# Links, mentions, hashtags and RT; the first character is told first, as most are none of these.
SKIP = re.compile(r"[hH@#rR](?:(?<=[hH])[tT][tT][pP][sSſ]?://\S*|(?<=[@#])\w+|(?<=[rR])(?<!\w[rR])[tT]\b)")
SPACED = re.compile(r"(?<![^\W_])((?:[^\W\d_][ .\-_*]){2,}[^\W\d_])(?![^\W_])")
DRAWN = re.compile(r"([^\W\d_])\1{2,}")
STARRED = re.compile(r"[^\W\d_]+\*+[^\W\d_*]*")
LEET = re.compile(r"(?=\S*[^\W\d_])(?=\S*[0-9@$])[\w@$]{3,}")
SIGN = re.compile(r"[0134578@$]")
SIGNS = str.maketrans("0134578@$", "oieastbas")
STAR, LINE = ord("*"), ord("\n")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-ÞА-Я]")
RUNS = re.compile(r"([^\W\d_])\1+")
STATION = re.compile(r"[|\n:;/,]\s*[a-z]+\s*[:=]\s*\S", re.I)


def folded(s: str) -> str:
    """Lower case without accents, each run of one letter as one."""
    s = s.lower()
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFD", s.replace("ß", "ss")) if not unicodedata.combining(c))
    return RUNS.sub(r"\1", s)


def entries() -> list[tuple[str, str]]:
    """(kind, pattern) of the general lexicons: patterns are words between blanks, or begin with one only."""
    return [(kind, f" {folded(w.rstrip('-').replace('_', ' '))}" + ("" if w.endswith("-") else " ")) for kind, text in LEXICON.items() for w in text.split()]


HIDDEN = invisible()
# What a batch of texts is searched for, character by character.
TESTS = (
    may_change, re.compile(r"[^\W\d_]").match, re.compile(r"[ .\-_*]").match, SIGN.match, CAPITALS.match, unicodedata.combining, re.compile(r"[.!?。！？…\n|🤬]").match, re.compile("[぀-ヿ㐀-鿿]").match, re.compile("!").match, re.compile("🤬").match,
    lambda c: ord(c) in HIDDEN,
)
CHANGED, LETTER, BETWEEN, FOR_LETTER, CAPITAL, ACCENT, END, EAST, BANG, SWEAR, UNSEEN = (1 << k for k in range(len(TESTS)))


@functools.cache
def kinds() -> Kinds:
    return Kinds(*TESTS)


def undisguised(low: str, starred: dict) -> tuple[str, int, int, int, int]:
    """A text in lower case without its disguises, and how many it had: letters apart, stars, signs for letters, drawn out."""
    spaced = stars = signs = 0
    if SPACED.search(low):
        low, spaced = SPACED.subn(lambda m: re.sub(r"[ .\-_*]", "", m[1]), low)
    if "*" in low:
        low, stars = STARRED.subn(lambda m: starred.get((m[0][0], m[0][-1] if m[0][-1] != "*" else "", len(m[0])), m[0]), low)
    if SIGN.search(low):
        low, signs = LEET.subn(lambda m: m[0].translate(SIGNS), low)
    return low, spaced, stars, signs, len(DRAWN.findall(low))


class Texts:
    """Texts freed from disguise, all of them at once, divided by line ends (which nothing here adds or takes away): the sentences' words as one string and
    what was found on the way."""

    def __init__(self, texts: list[str | None], starred: dict):
        n, x = len(texts), [t or "" for t in texts]
        sizes = np.fromiter(map(len, x), np.int64, n)
        disguises, kind = np.zeros((n, 4)), kinds()
        bits, until = kind(codes("\n".join(x))), np.cumsum(sizes + 1) - 1
        hidden = np.bincount(np.searchsorted(until, np.flatnonzero(bits & UNSEEN)), minlength=n)
        for k in np.unique(np.searchsorted(until, np.flatnonzero(bits & CHANGED))).tolist():
            x[k] = plain(x[k])
        lines = np.fromiter((t.count("\n") + 1 for t in x), np.int64, n)

        def ends(points: np.ndarray) -> np.ndarray:
            return np.r_[np.flatnonzero(points == LINE), len(points)][np.cumsum(lines) - 1] if n else np.zeros(0, np.int64)

        shown = SKIP.sub(" ", "\n".join(x))
        points = codes(shown)
        bits, until = kind(points), ends(points)
        capitals, bangs, swears = (np.bincount(np.searchsorted(until, np.flatnonzero(bits & b)), minlength=n) for b in (CAPITAL, BANG, SWEAR))
        low = shown.lower()
        points = codes(low)
        bits, until = kind(points), ends(points)
        # The texts that may have disguises are searched one by one.
        may = (bits & FOR_LETTER != 0) | (points == STAR)
        may[1:-1] |= (bits[:-2] & BETWEEN != 0) & (bits[1:-1] & LETTER != 0) & (bits[2:] & BETWEEN != 0)
        may[2:] |= (points[2:] == points[1:-1]) & (points[1:-1] == points[:-2]) & (bits[2:] & LETTER != 0)
        some = np.unique(np.searchsorted(until, np.flatnonzero(may))).tolist()
        if some:
            parts = [low[a:b] for a, b in zip([0, *(until[:-1] + 1).tolist()], until.tolist(), strict=True)]
            for k in some:
                parts[k], *disguises[k] = undisguised(parts[k], starred)
            low = "\n".join(parts)
        size = np.maximum(sizes, 1)
        self.stats = np.column_stack([capitals / size, bangs / size, swears, disguises[:, 0], disguises[:, 1], disguises[:, 2], disguises[:, 3], hidden])

        # As folded() does it, then words: letters of one script each, Chinese and Japanese signs one by one.
        if not low.isascii():
            low = unicodedata.normalize("NFD", low.replace("ß", "ss"))
        points = codes(low)
        points = points[kind(points) & ACCENT == 0]
        bits = kind(points)
        once = np.ones(len(points), bool)
        once[1:] = (points[1:] != points[:-1]) | (bits[1:] & LETTER == 0)
        points, bits = points[once], bits[once]
        letter, east = bits & LETTER != 0, bits & EAST != 0
        word = letter & ~east
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        begin |= east
        at = np.flatnonzero(begin)
        sentence = np.cumsum(bits & END != 0)[at]
        first = np.r_[True, sentence[1:] != sentence[:-1]][: len(at)]
        #: Each sentence's text and number of words.
        self.owner = np.repeat(np.arange(n), lines)[np.cumsum(points == LINE)[at[first]]]
        self.words = np.diff(np.r_[np.flatnonzero(first), len(at)])
        # The string: a blank before each word and after the last, a line end before each sentence.
        kept = np.flatnonzero(word | east)
        before = begin[kept].astype(np.int64)
        before[np.searchsorted(kept, at[first])] = 3
        place = np.arange(len(kept)) + np.cumsum(before)
        out = np.full(len(kept) + int(before.sum()) + 1, ord(" "), np.uint32)
        out[place] = points[kept]
        self.begins = place[before == 3] - 1
        out[self.begins - 1] = LINE
        self.string = written(out)

    def sequences(self) -> list[set[str]]:
        """Each text's runs of one to three words of its sentences, but for single short ones, which are mostly function words."""
        out: list[set[str]] = [set() for _ in self.stats]
        for k, s in zip(self.owner.tolist(), self.string.split("\n")[1:], strict=True):
            w = s.split()
            out[k].update(x for x in w if len(x) > 3 or x > "\u3040")
            out[k].update(map(" ".join, zip(w, w[1:], strict=False)))
            out[k].update(map(" ".join, zip(w, w[1:], w[2:], strict=False)))
        return out


def starred_index() -> dict:
    """Lexicon words by (first letter, last letter or none, length), for words with stars."""
    out: dict = {}
    for kind in HOT:
        for w in LEXICON[kind].split():
            w = w.rstrip("-")
            if len(w) > 2 and "_" not in w:
                out.setdefault((w[0], w[-1], len(w)), w)
                out.setdefault((w[0], "", len(w)), w)
    return out


class Features:
    """Dense features of texts, with a learned lexicon of word sequences (weights)."""

    def __init__(self, weights: dict[str, float]):
        import ahocorasick

        self.weights, self.starred = weights, starred_index()
        by: dict[str, list[int]] = {}
        for kind, p in entries():
            by.setdefault(p, []).append(KINDS.index(kind))
        for seq in weights:
            by.setdefault(f" {seq} ", [])
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, p in enumerate(by):
            self.find.add_word(p, k)
        self.find.make_automaton()
        # Of each pattern: half its length, whether it is a phrase, its weight, whether it has one, and its kinds.
        self.half = np.array([len(p) // 2 for p in by])
        self.several = np.array([" " in p.strip() for p in by])
        self.weight = np.array([weights.get(p[1:-1], 0.0) if p[-1] == " " else 0.0 for p in by])
        self.number, self.kind = np.array([len(v) for v in by.values()]), np.array([k for v in by.values() for k in v], np.int64)
        self.first = np.cumsum(self.number) - self.number
        self.hot = [KINDS.index(k) for k in HOT]
        self.near = [(KINDS.index(a), KINDS.index(b)) for a, b in NEAR]
        self.size = 2 * len(KINDS) + len(NEAR) + 6 + 8

    def sentences(self, x: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The strength and the features of each sentence."""
        m, kinds = len(x.words), len(KINDS)
        end, what = np.fromiter(itertools.chain.from_iterable(self.find.iter(x.string)), np.int64).reshape(-1, 2).T
        own = np.searchsorted(x.begins, end, side="right") - 1
        v = self.weight[what]
        total = np.bincount(own, v, m)
        high, low = np.zeros(m), np.zeros(m)
        if len(own):
            begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            high[own[begin]], low[own[begin]] = np.maximum(np.maximum.reduceat(v, begin), 0), np.minimum(np.minimum.reduceat(v, begin), 0)
        # A row for each hit and kind.
        n = self.number[what]
        hit = np.repeat(np.arange(len(what)), n)
        kind = self.kind[np.repeat(self.first[what] - np.cumsum(n) + n, n) + np.arange(len(hit))]
        own, at = own[hit], (end - self.half[what])[hit]
        counts = np.bincount(own * kinds + kind, minlength=m * kinds).reshape(m, kinds)
        phrases = np.bincount(own, self.several[what][hit], m)  # several words say more than one
        near = np.full((m, len(self.near)), np.inf)
        for k, (i, j) in enumerate(self.near):
            here, there = np.flatnonzero(kind == i), np.flatnonzero(kind == j)
            there = there[np.argsort(at[there], kind="stable")]
            next_one = np.searchsorted(at[there], at[here])
            for side in (next_one - 1, next_one):
                ok = (side >= 0) & (side < len(there))
                a, b = here[ok], there[side[ok]]
                a, b = a[own[a] == own[b]], b[own[a] == own[b]]
                np.minimum.at(near[:, k], own[a], np.abs(at[a] - at[b]))
        near[near == np.inf] = 200
        strength = counts[:, self.hot].sum(1) * 2 + total
        words = x.words[:, None]
        return strength, np.hstack([counts / words, counts, near, np.column_stack([phrases, total, high, low, total / x.words, x.words])])

    def rows(self, x: Texts) -> np.ndarray:
        """Each text's strongest sentence and what was found on the way."""
        out = np.zeros((len(x.stats), self.size), np.float32)
        out[:, -8:] = x.stats
        if len(x.words):
            strength, features = self.sentences(x)
            begin = np.flatnonzero(np.r_[True, x.owner[1:] != x.owner[:-1]])
            most = np.flatnonzero(strength == np.repeat(np.maximum.reduceat(strength, begin), np.diff(np.r_[begin, len(strength)])))
            own, first = np.unique(x.owner[most], return_index=True)
            out[own, :-8] = features[most[first]]
        return out

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out, at = [np.zeros((0, self.size), np.float32)], 0
        for k, size in enumerate(itertools.accumulate(len(t or "") + 1 for t in texts)):
            if k + 1 == len(texts) or size // AT_ONCE > (size - len(texts[k] or "") - 1) // AT_ONCE:
                out.append(self.rows(Texts(texts[at : k + 1], self.starred)))
                at = k + 1
        return np.concatenate(out)


def learned(held: list[set[str]], y: np.ndarray, w: np.ndarray, least: int = 3, most: int = 4000) -> dict[str, float]:
    """Log odds of word sequences that stand in at least `least` texts, less a standard error: one wrong judgement teaches nothing.
    held: each text's sequences."""
    yes, no, seen = Counter(), Counter(), set()
    for s, v, u in zip(held, y, w, strict=True):
        # Copies of a text are one witness.
        if u >= 0.5 and (k := (hash(frozenset(s)), v)) not in seen:
            seen.add(k)
            (yes if v else no).update(s)
    sure = w >= 0.5
    ny, nn = max(1, int((sure & (y == 1)).sum())), max(1, int((sure & (y == 0)).sum()))
    odds = {}
    for s in yes.keys() | {x for x, n in no.items() if n >= least}:
        a, b = yes[s] + 0.3, no[s] + 0.3
        if a + b > least:
            v = float(np.log(a / ny) - np.log(b / nn))
            v = float(np.sign(v)) * max(0.0, abs(v) - float(np.sqrt(1 / a + 1 / b)))
            if abs(v) > 0.7:
                odds[s] = v
    return dict(sorted(odds.items(), key=lambda kv: (-abs(kv[1]), kv[0]))[:most])


class Model:
    """The learned lexicon and the calibrated trees."""

    def __init__(self, rows: list[tuple[str, bool]]):
        """rows: labelled texts, in an order that has nothing to do with the labels."""
        if not rows:
            # Without labels: the general lexicons' own entries are the examples.
            rows = [(p.strip() + (" you" if k in HOT else ""), k in HOT) for k, p in entries()]
        starred = starred_index()
        held, part = Texts([t for t, _ in rows], starred).sequences(), np.array([sum(map(ord, t)) % 3 for t, _ in rows])
        texts = [Texts([rows[i][0] for i in np.flatnonzero(part == h)], starred) for h in range(3)]
        y = np.array([float(v) for _, v in rows])
        self.fit(texts, held, part, y, np.ones(len(y)), 15)
        # Judgements that the rest of the sample speaks clearly against are taken for slips and count little.
        self.fit(texts, held, part, y, np.where(np.abs(y - self.unseen) > 0.85, 0.05, 1.0))

    def fit(self, texts: list[Texts], held: list[set[str]], part: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 50) -> None:
        x = np.zeros((len(y), Features({}).size), np.float32)
        for h in range(3):
            # The learned lexicon's features of a training text come from a lexicon that saw neither the text nor an equal one.
            out, own = np.flatnonzero(part != h), np.flatnonzero(part == h)
            x[own] = Features(learned([held[i] for i in out], y[out], w[out])).rows(texts[h])
        self.weights = learned(held, y, w)
        self.model = Calibrated(rounds=rounds, depth=3, rate=0.15, leaf=max(3.0, len(y) / 600)).fit(x, y, w)
        self.unseen = self.model.calibration(self.model.unseen)
        self.rate = float(np.average(y, weights=w))


def prevalence(p: np.ndarray, n: np.ndarray, sample_rate: float) -> float:
    """The share of cases among all texts, from their calibrated scores p, each standing for n texts: the labelled sample's share is another (expectation maximisation)."""
    share = sample_rate
    for _ in range(50):
        share = min(max(float(np.average(shifted(p, sample_rate, share), weights=n)), 0.002), 0.9)
    return share


def shifted(p: np.ndarray | Column, sample_rate: float, share: float) -> np.ndarray | Column:
    """Scores of LEAST to 1 - LEAST calibrated on the sample, for a population with another share of cases."""
    r = min(max(sample_rate, 0.01), 0.99)
    a, b = p * (share / r), (1 - p) * ((1 - share) / (1 - r))
    return a / (a + b)


def share_of_cases(scored: DataFrame, sample_rate: float) -> float:
    """The share of cases among all keys with a text, of scored's key and calibrated score p (null without text). Redelivered rows, which score alike, count once."""
    one = scored.where("p is not null").select("key", F.round(F.ln(F.col("p") / (1 - F.col("p"))) / BIN).cast("int").alias("bin")).distinct()
    bins = sorted(map(tuple, one.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()))
    if not bins:
        return sample_rate
    at, n = np.array(bins, float).T
    return prevalence(1 / (1 + np.exp(-at * BIN)), n, sample_rate)


def score(tweets: DataFrame, labels: DataFrame, key: str = "tweet_id", text: str = "text", harmless: str = "none") -> DataFrame:
    """key, source and score of every row. labels: key and label, harmless being the label of a text without such language."""
    l = labels.select(F.col(key).alias("k"), (F.col("label") != harmless).alias("bad"))
    some = bounded(l, ["k", "bad"], MOST_LABELS, F.col("bad").isNotNull())
    l = tweets.sparkSession.createDataFrame([(r["k"], r["bad"]) for r in some], l.schema)
    own = tweets.where(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(key).alias("k"), F.col(text).alias("t"))
    texts = own.join(F.broadcast(l.select("k").distinct()), "k", "left_semi").dropDuplicates(["k"])  # MOST_LABELS keys at most
    rows = [(r["t"], r["bad"]) for r in l.join(texts, "k").select("t", "bad", F.xxhash64("k", "bad").alias("h")).orderBy("h", "t").collect()]
    model = Model(rows)
    held = tweets.sparkSession.sparkContext.broadcast((model.weights, model.model))  # at most 4000 word sequences and 50 trees

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights, model = held.value
        features = Features(weights)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            p = np.clip(model(features(texts)), LEAST, 1 - LEAST)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p, mask=np.array([not t for t in texts], bool))], names=[*b.schema.names[:-1], "p"])

    d = tweets.select(F.col(key).alias("key"), "source", F.col(text).alias("text"))
    scored = cut(d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, source string, p double"))  # read twice: for the share and for the scores
    share = share_of_cases(scored, model.rate) if rows else model.rate
    return scored.select("key", "source", F.coalesce(shifted(F.col("p"), model.rate, share), F.lit(0.0)).alias("score"))
