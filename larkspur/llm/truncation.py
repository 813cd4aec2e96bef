"""Problem 10: texts cut off by a field limit or a broken transfer.

The corpus itself says what a cut looks like. Its vocabulary is a table of tokens with how often each stands at all and at the end of a clause; the vocabulary's
trie is a table of nodes, each a proper prefix of known tokens with the occurrences below it. A text's final token that is unknown, or all but unknown beside what
is below it, but a node of the trie was cut inside a word or link; one that is known but all but never ends a clause was cut inside a sentence. A source's field limits show as
lengths that far more texts have than the lengths around them; at such a length, and before a mark of omission, weaker evidence is enough.

Vocabulary, trie and lengths come from all texts (map-side combined counts; nothing is sampled, collected or broadcast by hand). Distinct final tokens are looked up once
and joined back; a token that ends a third of all texts is split by Spark's skew join (adaptive execution).

Defined cases: null, empty and blank texts are not cut; texts that end in a terminator, closing bracket, hashtag, mention, emoji, complete link or mail address are whole; repeated
texts get equal answers; null sources are a source of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut

#: A token is known from so many occurrences away from a text's end, and from such a share of the occurrences below it in the trie: in a large corpus pieces of common words stand
#: here and there too. A node of the trie stands for tokens with at least KNOWN occurrences.
KNOWN, SHARE = 2, 0.005
#: The greatest share of a known token's occurrences that end a clause, for it to be a cut: without more evidence, at a field limit, before a mark of omission.
ENDS, ENDS_LIMIT, ENDS_MARK = 0.01, 0.2, 0.2
#: A length is a field limit if so many texts of a source have it, and so many times the mean of the RANGE lengths on either side.
LIMIT_TEXTS, LIMIT_TIMES, RANGE = 4, 4.0, 8

MARK = r"\s*(?:\[(?:\.{3}|…)\]|\((?:\.{3}|…)\)|…|\.{3,})\s*$"
BROKEN = r"�+\s*$"
CJK = r"぀-ヿ㐀-鿿"
#: Ends of whole texts: terminators, signs, tags, complete links and addresses.
WHOLE = (
    rf"(?:[.!?。！？][\"'”’»)\]*_]*|[)\]}}>*»”]|(?:^|\s)[#@][\p{{L}}\p{{M}}\p{{N}}_]+|https?://[^\s/]+\.[^\s/]+/\S+|[\w.+-]+@[\w-]+(?:\.[\w-]+)+|[^\p{{L}}\p{{M}}\p{{N}}\s'’\"/:,;&=%$(\[{{<+-][\x{{FE0F}}\x{{200D}}]*)$"
)
LINK_STUB = r"https?(?::/{0,2}[^\s/]*)?$"


#: How much of a text its end is looked for in. Where this holds no white space before a mark, the last word may be longer, and the whole text is taken.
END = 400
BLANKS = " \t\n\r\u000b\u000c\u0085\u00a0\u2028\u2029\u202f\u3000\ufeff"


def ends(texts: DataFrame) -> DataFrame:
    """texts (key, source, text) with front and base (the text without its end, and the end without white space and mark of omission), chars (their length), broken and mark."""
    base = lambda end: F.rtrim(F.regexp_replace(F.regexp_replace(end, BROKEN, ""), MARK, ""), F.lit(BLANKS))
    last = F.substring("text", -END, END)
    t = texts.withColumn("text", F.rtrim("text", F.lit(BLANKS))).withColumn("end", F.when((F.length("text") <= END) | ~base(last).rlike(r"\s"), F.col("text")).otherwise(last))
    t = t.withColumn("base", base(F.col("end")))
    front = F.substring(F.col("text"), F.lit(1), F.length("text") - F.length("end"))
    return t.select("key", "source", front.alias("front"), "base", (F.length("text") - F.length("end") + F.length("base")).alias("chars"), F.col("end").rlike(BROKEN).alias("broken"), F.col("end").rlike(MARK).alias("mark"))


def tokens(text: Column) -> Column:
    """Tokens in order, in lower case, with the sign ¶ after each clause; a link is its host, a run of Chinese or Japanese signs its pairs of neighbours."""
    t = F.lower(text)
    t = F.when(F.contains(t, F.lit("://")), F.regexp_replace(t, r"(https?://[^\s/]+/)\S*", "$1")).otherwise(t)
    cjk = F.regexp_replace(F.regexp_replace(t, rf"(?<=[{CJK}]{{2}})(?=[{CJK}])", " "), rf"(?<=[{CJK}])(?=[^{CJK}\s])|(?<=[^{CJK}\s])(?=[{CJK}])", " ")
    t = F.when(t.rlike(rf"[{CJK}]"), cjk).otherwise(t)
    t = F.regexp_replace(t, r"(?<![\w/:])[\"“”«»(\[*]+|[\"”»)\]*]+(?=[\s.,;!?]|$)", "")
    t = F.regexp_replace(t, r"[.!?;,…|。、！？]+(?=\s|$)|(?<=\S)[。、！？]+|\s+[./|;–—-]+\s|[\n\r]+", " ¶ ")
    return F.filter(F.split(t, r"\s+"), lambda x: x != "")


def vocabulary(texts: DataFrame) -> DataFrame:
    """token, n (occurrences other than a text's last token), ends (those at the end of a clause)."""
    # No filter on the array: it would be pushed below and the tokens be made twice.
    arr = texts.select(tokens(F.concat("front", "base")).alias("a"))
    n = F.greatest(F.size("a") - 1, F.lit(0))
    pairs = arr.select(F.explode(F.zip_with(F.slice("a", F.lit(1), n), F.slice("a", F.lit(2), n), lambda x, y: F.struct(x.alias("token"), (y == "¶").alias("end")))).alias("p"))
    return pairs.where("p.token <> '¶'").groupBy("p.token").agg(F.count(F.lit(1)).alias("n"), F.count_if("p.end").alias("ends"))


def trie(vocab: DataFrame) -> DataFrame:
    """The nodes (node, below): proper prefixes of known tokens, with the occurrences below."""
    known = vocab.where((F.col("n") >= KNOWN) & (F.length("token") > 1))
    return known.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("token") - 1), lambda k: F.substring("token", F.lit(1), k))).alias("node"), "n").groupBy("node").agg(F.sum("n").alias("below"))


def limits(texts: DataFrame) -> DataFrame:
    """(source, chars): the lengths that are field limits. One row per source and length goes in, however many texts there are."""
    h = texts.groupBy("source", "chars").agg(F.count(F.lit(1)).alias("k"))
    around = h.select("source", F.explode(F.array(*[F.lit(d) for d in range(-RANGE, RANGE + 1) if d])).alias("d"), "chars", "k").select("source", (F.col("chars") + F.col("d")).alias("chars"), F.col("k").alias("near"))
    around = around.groupBy("source", "chars").agg((F.sum("near") / (2 * RANGE)).alias("mean"))
    j = h.alias("h").join(around.alias("o"), (F.col("h.chars") == F.col("o.chars")) & F.col("h.source").eqNullSafe(F.col("o.source")), "left")
    return j.where((F.col("k") >= LIMIT_TEXTS) & (F.col("k") > LIMIT_TIMES * F.greatest(F.coalesce("mean", F.lit(0.0)), F.lit(0.25)))).select("h.source", "h.chars", F.lit(True).alias("limit"))


def judged(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """key, source and why a text counts as cut: link, word, sentence, mark or null."""
    t = ends(df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull()))
    vocab = cut(vocabulary(t))
    nodes = trie(vocab)
    # What the rest needs of each text, once: its end's regular expressions cost more than all that follows.
    base = F.col("base")
    state = F.when(base == "", "none").when(base.rlike(LINK_STUB), "stub").when(base.rlike(WHOLE), "whole").otherwise("open")
    t = t.select("key", "source", "chars", "broken", "mark", state.alias("state"), "base")
    last = F.element_at(F.filter(tokens(base), lambda x: x != "¶"), -1)
    t = cut(t.select("key", "source", "chars", "broken", "mark", "state", F.when(F.col("state") == "open", last).alias("token")))
    open_ = t.where("state in ('open', 'stub')")
    finals = open_.where("token is not null").select("token").distinct()
    seen = finals.join(vocab, "token", "left").join(nodes.withColumnRenamed("node", "token"), "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("ends", F.lit(0)).alias("ends"), F.coalesce("below", F.lit(0)).alias("below"))
    lim = limits(t)
    j = open_.join(seen, "token", "left").alias("t").join(lim.alias("l"), (F.col("t.chars") == F.col("l.chars")) & F.col("t.source").eqNullSafe(F.col("l.source")), "left")
    bound = F.greatest(F.lit(ENDS), F.when(F.col("limit"), F.lit(ENDS_LIMIT)).otherwise(0.0), F.when(F.col("mark"), F.lit(ENDS_MARK)).otherwise(0.0))
    piece = (F.col("below") > 0) & ((F.col("n") < KNOWN) | (F.col("n") < SHARE * F.col("below")))
    why = (
        F.when(F.col("state") == "stub", "link")
        .when(piece, "word")
        .when((F.col("n") >= KNOWN) & ((F.col("ends") + 0.5) / (F.col("n") + 1.0) < bound), "sentence")
        .when(F.col("broken"), "mark")
    )
    rest = t.where("state in ('none', 'whole')").select("key", "source", F.when(F.col("broken"), "mark").alias("why"), *[F.lit(None).cast(k).alias(c) for c, k in (("token", "string"), ("n", "bigint"), ("ends", "bigint"), ("below", "bigint"), ("limit", "boolean"))], "mark")
    return j.select("key", F.col("t.source").alias("source"), why.alias("why"), "token", "n", "ends", "below", "limit", "mark").unionByName(rest)
