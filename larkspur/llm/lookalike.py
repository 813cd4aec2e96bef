"""Problem 6: one form for texts that look the same, as SQL for DuckDB inside Arrow partitions.

The form is made by embedded SQL: invisible characters go (regular expression), width and font forms and non-breaking signs become their plain
ones (translate), ligatures fall apart (replace), accents are composed (nfc_normalize), and look-alike letters are changed (translate). Case, punctuation,
ordinary white space and accents stay, so texts differing in these stay different.

There are two forms. The skeleton, for comparing only, has the Latin letter for every look-alike, whatever its script. The consistent form, to go on with, keeps
each word in its own script: a word with a letter that only Cyrillic, Greek or Armenian has stays so, and Latin letters strayed into it become its own, unless it has others that are only Latin; in all
others look-alikes become Latin, but for words made of nothing else in a text that has such a letter elsewhere.

Defined cases: a null text has null forms, an empty text empty ones; repeated rows stay repeated; texts of any length are treated whole;
columns of the input other than those named are not read.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.duck import map_sql
from larkspur.session import cut

# Letters that look like a Latin letter, by script, upper and lower case.
LOOKALIKES = [
    ("АВЕЅІЈКМНОРСТУХЬҮԚԜҺҪЁЇаеѕіјорсухԛԝһҫёїӏᴦ", "ABESIJKMHOPCTYXbYQWhÇËÏaesijopcyxqwhçëïlr"),  # Cyrillic
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳναγικρυχ", "ABEZHIKMNOPTYXocjvayikpux"),  # Greek
    ("ՕՍՏԼԱօոսհցզյ", "OUSLUonuhgqj"),  # Armenian
    ("ⅠⅤⅩⅬⅭⅮⅯⅰⅴⅹⅼⅽⅾⅿ", "IVXLCDMivxlcdm"),  # Roman numerals
    ("ɑɡɩıȷʏꓐꓑꓔꓖꓗꓚꓜꓝꓟꓠꓢꓡꓤꓦꓪꓬꓮꓰꓲꓳꓴ", "agiijYBPTGKCZFMNSLRVWYAEIOU"),  # Latin extensions, Lisu
    ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏒᏙᏚᏞᏟᏢᏦᏴ", "DRTiAJEWMHGZRVSLCPKB"),  # Cherokee
]
# Scripts that have look-alikes and other letters.
OTHERS = "\\p{Cyrillic}\\p{Greek}\\p{Armenian}"
# Characters without ink.
INVISIBLE = "\\x{00AD}\\x{034F}\\x{061C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180E}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{2064}\\x{2066}-\\x{206F}\\x{3164}\\x{FE00}-\\x{FE0F}\\x{FEFF}\\x{FFA0}"
# Ligatures of letters.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "ǉ": "lj", "ǈ": "Lj", "Ǉ": "LJ", "ǌ": "nj", "ǋ": "Nj", "Ǌ": "NJ", "ǆ": "dž", "ǅ": "Dž", "Ǆ": "DŽ"}
KINDS = ("<wide>", "<narrow>", "<font>", "<noBreak>")


def compatibility() -> tuple[str, str]:
    """Characters that are a width, font or non-breaking form of one other, and these: by the rule of Unicode's decompositions."""
    a, b = [], []
    for n in range(0xA0, 0x1FBFA):
        kind, *to = unicodedata.decomposition(chr(n)).split()[:3] or [""]
        if kind in KINDS and len(to) == 1 and unicodedata.category(chr(n)) != "Cn":
            a.append(chr(n))
            b.append(chr(int(to[0], 16)))
    # Spaces of fixed width break no line either where they are used as non-breaking ones; the singletons of NFC are left to nfc_normalize.
    for n in [*range(0x2000, 0x200B), 0x205F]:
        a.append(chr(n))
        b.append(" ")
    b = [unicodedata.normalize("NFKC", y) if len(unicodedata.normalize("NFKC", y)) == 1 else y for y in b]
    return "".join(a), "".join(b)


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def plain_sql(x: str) -> str:
    """SQL: x without invisible characters, width and font forms and ligatures, and with composed accents."""
    a, b = compatibility()
    sql = f"translate(regexp_replace({x}, '[{INVISIBLE}]', '', 'g'), {quoted(a)}, {quoted(b)})"
    for one, several in LIGATURES.items():
        sql = f"replace({sql}, {quoted(one)}, {quoted(several)})"
    return f"nfc_normalize({sql})"


def form_sql(x: str) -> str:
    """SQL: the one form of x. Texts of ASCII letters only, most of them, are passed by."""
    a, b = ("".join(p[k] for p in LOOKALIKES) for k in (0, 1))
    return f"case when {x} is null or regexp_full_match({x}, '[\\x00-\\x7F]*') then {x} else nfc_normalize(translate({plain_sql(x)}, {quoted(a)}, {quoted(b)})) end"


def consistent_sql(x: str) -> str:
    """SQL: x with each word in the script it belongs to."""
    a, b = ("".join(p[k] for p in LOOKALIKES) for k in (0, 1))
    back = []
    for one, latin in LOOKALIKES[:3]:
        to: dict[str, str] = {}
        for c, y in zip(one, latin, strict=True):
            to.setdefault(y, c)
        script = {0: "Cyrillic", 1: "Greek", 2: "Armenian"}[len(back)]
        latin_, own_ = quoted("".join(to)), quoted("".join(to.values()))
        back.append(f"when regexp_matches(translate(w, {quoted(a)}, ''), '\\p{{{script}}}') then case when regexp_matches(translate(w, {latin_}, ''), '\\p{{Latin}}') then w else translate(w, {latin_}, {own_}) end")
    word = (
        f"case when not regexp_matches(w, '[^\\x00-\\x7F]') then w {' '.join(back)} when own and not regexp_matches(w, '\\p{{Latin}}') then w else translate(w, {quoted(a)}, {quoted(b)}) end"
    )
    words = f"nfc_normalize(array_to_string(list_transform(regexp_extract_all(plain, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+'), lambda w: {word}), ''))"
    inner = f"(select {plain_sql('t')} as plain from (select {x} as t))"
    return f"case when {x} is null or regexp_full_match({x}, '[\\x00-\\x7F]*') then {x} else (select {words} from (select plain, regexp_matches(translate(plain, {quoted(a)}, ''), '[{OTHERS}]') as own from {inner})) end"


def with_form(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, text and form of every row; form is what texts that look the same have in common (the skeleton, for comparing)."""
    d = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = d.schema["key"].dataType.simpleString()
    return map_sql(d, f"select key, text, {form_sql('text')} as form from batch", f"key {kind}, text string, form string")


def consistent(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key and the text in one consistent form (form), each word in its own script."""
    d = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = d.schema["key"].dataType.simpleString()
    return map_sql(d, f"select key, {consistent_sql('text')} as form from batch", f"key {kind}, form string")


def alike_classes(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row a key: key, its class (the smallest key whose text looks the same) and links (how many rows look the same with other characters).

    No pair is formed and no group gathered: rows are counted by form and by spelling, and the counts joined back; hot forms are split by Spark's skew join.
    A key that stands with several texts has a row for each class."""
    both = lambda c, a, b: (F.xxhash64(F.lit(1), c).alias(a), F.xxhash64(F.lit(2), c).alias(b))
    rows = with_form(df.where(F.col(f"`{text}`").rlike("[\\p{L}\\p{Nd}]")), key, text).select("key", *both(F.col("form"), "f1", "f2"), *both(F.col("text"), "t1", "t2"))
    rows = cut(rows.distinct())
    spellings = rows.groupBy("f1", "f2", "t1", "t2").agg(F.count(F.lit(1)).alias("same"), F.min("key").alias("first"))
    forms = spellings.groupBy("f1", "f2").agg(F.sum("same").alias("all"), F.min("first").alias("class"))
    of = spellings.join(forms, ["f1", "f2"]).select("t1", "t2", "class", (F.col("all") - F.col("same")).alias("links"))
    return rows.join(of, ["t1", "t2"]).select("key", "class", "links").distinct()


def alike_pairs(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key_a, key_b), key_a < key_b: all pairs of rows whose texts are different characters of the same form.

    No pair that isn't in the result is ever formed: rows are grouped by form without gathering them, forms with one spelling fall out in the
    aggregation, pairs are made of the few different spellings of a form, and the rows of the two spellings are joined to these. Copies of one
    spelling, however many, are never paired with each other. Hot forms are split by Spark's skew join (adaptive execution), the spellings'
    side being small. Texts and forms are compared as 128 bits of hash. The rows' hashes are checkpointed, as three joins read them.
    """
    both = lambda c: (F.xxhash64(F.lit(1), c), F.xxhash64(F.lit(2), c))
    (f1, f2), (t1, t2) = both(F.col("form")), both(F.col("text"))
    rows = with_form(df.where(F.col(f"`{text}`").rlike("[\\p{L}\\p{Nd}]")), key, text).select("key", f1.alias("f1"), f2.alias("f2"), t1.alias("t1"), t2.alias("t2"))
    rows = cut(rows.distinct())
    spellings = rows.select("f1", "f2", "t1", "t2").distinct()
    several = spellings.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("f1", "f2")
    some = cut(spellings.join(several, ["f1", "f2"], "left_semi"))
    pairs = some.toDF("f1", "f2", "a1", "a2").join(some.toDF("f1", "f2", "b1", "b2"), ["f1", "f2"]).where("struct(a1, a2) < struct(b1, b2)").drop("f1", "f2")
    kept = rows.join(some.select("t1", "t2"), ["t1", "t2"], "left_semi").select("key", "t1", "t2")
    out = kept.toDF("ka", "a1", "a2").join(pairs, ["a1", "a2"]).join(kept.toDF("kb", "b1", "b2"), ["b1", "b2"]).where("ka <> kb")
    return out.select(F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))
