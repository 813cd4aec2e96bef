"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that are replaced, in order, and what by.
SIMPLE = [("^RT ", ""), (r"https?://[^\s]+", "url"), (r"@[^\s]+", "mention"), (r"#[^\s]+", "hashtag")]
TIDY = [("^RT ", ""), (r"^\.", ""), (r"https?://[^\s]+", ""), (r"\s+", " ")]
ROLE = [(r"[^0-9a-zA-Z\s]+", ""), (r"\s+", " ")]
MENTION, UNKNOWN = "User", "<unk>"


def replaced(c: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, by in rules:
        c = F.regexp_replace(c, pattern, by)
    return c


def simple_text(text: Column) -> Column:
    """Links, mentions and hashtags as the words url, mention and hashtag."""
    return replaced(text, SIMPLE)


def tidy_text(text: Column) -> Column:
    """Without RT, a leading full stop and links, with single white spaces; not trimmed."""
    return replaced(text, TIDY)


def role_value(c: Column) -> Column:
    """A role's words: signs out, white space single."""
    return replaced(c, ROLE)


def break_hashtag(c: Column) -> Column:
    """A blank before each capital that follows another kind of letter or sign: HelloWorld, but NASALaunch stays."""
    return F.regexp_replace(c, r"(?<=\P{Lu})(?=\p{Lu})", " ")


def control_trim(c: Column) -> Column:
    """Without blanks and control characters at the ends (Spark's trim takes blanks only)."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+\z", "")


def robust_field(c: Column) -> Column:
    """A field for tab-separated output: null is <unk>, white space single and none at the ends, empty is one blank."""
    s = control_trim(F.regexp_replace(c.cast("string"), r"\s+", " "))
    return F.when(c.isNull(), UNKNOWN).when(s == "", " ").otherwise(s)


def entity_list(entities: Column) -> Column:
    """A tweet's entities as array<struct<s, ord, f, rep>>, in the order of their starts; equal starts keep hashtags, mentions, urls, media.
    Null arrays and elements and those without two indices are left out."""
    kinds = [("hashtags", lambda x: break_hashtag(F.coalesce(x["text"], F.lit("")))), ("user_mentions", lambda x: F.lit(MENTION)), ("urls", lambda x: F.lit("")), ("media", lambda x: F.lit(""))]

    def items(n: int, name: str, rep) -> Column:
        place = lambda x, k: F.get(x["indices"], F.lit(k))
        some = F.filter(entities[name], lambda x: x.isNotNull() & (F.size(x["indices"]) >= 2) & place(x, 0).isNotNull() & place(x, 1).isNotNull())
        rows = F.transform(some, lambda x, i: F.struct(place(x, 0).alias("s"), (F.lit(n * 1_000_000) + i).cast("int").alias("ord"), place(x, 1).alias("f"), rep(x).alias("rep")))
        return F.coalesce(rows, F.array().cast("array<struct<s:int,ord:int,f:int,rep:string>>"))

    parts = [items(n, name, rep) for n, (name, rep) in enumerate(kinds)]
    return F.array_sort(F.concat(*parts))


def rewrite(text: Column, items: Column) -> Column:
    """text with each item's range replaced by its rep. A fold over (place, text so far): an item's replacement stands at its range's last character,
    which it takes even if that was taken before, so equal ranges take one more each; a range past the end takes the tail and puts nothing."""
    n = F.char_length(text)

    def step(a: Column, e: Column) -> Column:
        q = F.greatest(a["p"], F.least(e["s"], n), e["f"] - 1)
        kept = F.when(a["p"] < e["s"], F.substring(text, a["p"] + 1, F.least(e["s"], n) - a["p"])).otherwise("")
        return F.struct(F.when(q < n, q + 1).otherwise(n).alias("p"), F.concat(a["out"], kept, F.when(q < n, e["rep"]).otherwise("")).alias("out"))

    start = F.struct(F.lit(0).alias("p"), F.lit("").alias("out"))
    return F.aggregate(items, start, step, lambda a: F.concat(a["out"], F.substring(text, a["p"] + 1, n)))


def entity_text(text: Column, entities: Column) -> Column:
    """A tweet's text with hashtags broken up, mentions as User and links and media gone; untouched without entities."""
    return F.when(entities.isNull(), text).otherwise(rewrite(text, entity_list(entities)))


def human_size(c: Column) -> Column:
    """Bytes as KB, MB or GB with two decimals; a unit is used above, not at, its first multiple."""
    b = c.cast("double")
    return F.when(b > 1024.0**3, F.format_string("%.2fGB", b / 1024.0**3)).when(b > 1024.0**2, F.format_string("%.2fMB", b / 1024.0**2)).otherwise(F.format_string("%.2fKB", b / 1024.0))


def base_name(c: Column) -> Column:
    """A chunk's name without its numbers and ending."""
    return F.regexp_replace(c, r"(-[0-9]+)*\.[a-z]+$", "")
