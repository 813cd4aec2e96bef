"""Problem 5: one record for copies that differ only in their layout.

First byte-identical texts are collapsed with their counts (combined on the map side, so a text that a third of all rows share moves as one row
per task); only the distinct survivors are brought to canonical form; these are grouped again on the full canonical text, summing the counts.
Nothing is gathered: a group is a smallest key, a greatest one and a count, and no list, so its size doesn't matter. Where rows are led back to their
group, texts that were already told apart are named by their SHA-256.

The canonical form keeps letters, digits and accents, in lower case, characters that look alike being one; named fields (name: value or
name = value, separated by a sign or line end) are put in alphabetical order.

Defined cases: null texts are left out (counted by none); texts without letter or digit, empty ones too, have no canonical form and are left out unless
asked for (bare), and are then copies of byte-identical texts only; an empty table gives an empty result; equal rows of one key count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.duck import map_sql
from larkspur.llm.lookalike import LOOKALIKES, plain_sql, quoted
from larkspur.session import cut

#: Letters and digits, with the marks that belong to letters.
KEEP = "\\p{L}\\p{M}\\p{N}"
#: Where a named field begins: a sign or line end, one word, then : or =. Two of these make a text one of named fields.
FIELD = "[\\s;|,/·•–—-]*[;|,:\\n/·•–—-][\\s;|,/·•–—-]*([\\p{L}_]+)\\s*[:=]\\s*"


def classes() -> tuple[str, str]:
    """Lower-case look-alike classes, closed under case: В looks like B, so в and b are one here (the texts are compared without case)."""
    to: dict[str, str] = {}
    for a, b in LOOKALIKES:
        for x, y in zip(a, b, strict=True):
            lx, ly = x.lower(), y.lower()
            if len(lx) == len(ly) == 1 and lx != ly:
                to.setdefault(lx, ly)
    # й has its breve as its own sign; the classes of letters with accents follow from their parts by NFC.
    return "".join(to), "".join(to.values())


def canonical_sql(more: str = "") -> str:
    """SQL over the table batch (column text): the columns in more, and canon, the canonical text."""
    a, b = classes()
    plain = f"case when regexp_full_match(text, '[\\x00-\\x7F]*') then lower(text) else replace(nfc_normalize(translate(lower({plain_sql('text')}), {quoted(a)}, {quoted(b)})), 'ß', 'ss') end"
    strip = lambda s: f"regexp_replace({s}, '[^{KEEP}]+', '', 'g')"
    return (
        f"select {more}case when len(parts) > 2 then {strip('parts[1]')} || ' ' || array_to_string(list_sort(list_transform(parts[2:], lambda f: {strip('f')})), ' ') else {strip('plain')} end as canon "
        f"from (select *, string_split(regexp_replace(plain, {quoted(FIELD)}, chr(30) || '\\1 ', 'g'), chr(30)) as parts from (select *, {plain} as plain from batch))"
    )


def canonical(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key and the canonical text (canon) of every row; null for a null text."""
    d = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return map_sql(d, canonical_sql("key, "), f"key {d.schema['key'].dataType.simpleString()}, canon string")


def _digest(c: str):
    return F.unhex(F.sha2(F.col(c).cast("binary"), 256))


def _raw(df: DataFrame, key: str, text: str, bare: bool) -> DataFrame:
    """key and text of the rows that take part."""
    c = F.col(f"`{text}`")
    return df.where((c.isNotNull() if bare else c.rlike("[\\p{L}\\p{Nd}]")) & F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), c.alias("text"))


def _survivors(raw: DataFrame, bare: bool) -> DataFrame:
    """Every distinct text of raw (key, text) as digest, canon, n (its rows), first and last (its smallest and greatest key)."""
    kind = raw.schema["key"].dataType.simpleString()
    texts = raw.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
    texts = texts.select(_digest("text").alias("digest"), "text", "n", "first", "last")
    keep, shape = "digest, n, first, last, ", f"digest binary, n bigint, first {kind}, last {kind}, "
    if not bare:
        return map_sql(texts, canonical_sql(keep), shape + "canon string")
    # A text without canonical form is its own: it holds no letter or digit, so it equals no other's.
    canon = map_sql(texts, canonical_sql(keep + "text, "), shape + "text string, canon string")
    return canon.withColumn("canon", F.when(F.col("text").rlike("[\\p{L}\\p{Nd}]") & (F.col("canon") != ""), F.col("canon")).otherwise(F.col("text"))).drop("text")


def one_per_text(df: DataFrame, key: str, text: str = "text", bare: bool = False) -> DataFrame:
    """The collapsed records: the smallest key of each canonical text (root), and how many keys have it (copies). bare: texts without letter or digit too."""
    texts = _survivors(_raw(df, key, text, bare).distinct(), bare)
    return texts.groupBy("canon").agg(F.min("first").alias("root"), F.sum("n").alias("copies")).select("root", "copies")


def copy_links(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(root, key) for every copy other than the root itself. A hot text's rows are split by Spark's skew join (adaptive execution)."""
    raw = _raw(df, key, text, False)
    texts = cut(_survivors(raw, False).select("digest", "canon", "first", "last"))
    # Texts whose class has one key leave here, so that the rows meet only the others.
    groups = texts.groupBy("canon").agg(F.min("first").alias("root"), F.max("last").alias("last")).where("last <> root").select("canon", "root")
    roots = texts.join(groups, "canon").select("digest", "root")
    return raw.select("key", _digest("text").alias("digest")).join(roots, "digest").where("key <> root").select("root", "key").distinct()
