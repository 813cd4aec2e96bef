"""The queries of the tweet, term, lexicon and frame operators on the test tables, and the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.paths import json_path
from larkspur.functions.protobuf import decode_example
from larkspur.functions.text import break_hashtag, entity_text, simple_text, tidy_text
from larkspur.operators import encode, lexicon, match, metrics, terms
from larkspur.operators.annotate import RuleAnnotator
from larkspur.operators.frames import frame_sentences as frames_of
from larkspur.operators.tweets import filter_tweets, parse_tweets, serialize, split_priority, tweet_text, with_images
from larkspur.session import shared_dir, table
from larkspur.sources.named import chunk_sizes, tuple_string
from larkspur.sources.tsv import limited_files, robust_rows, write_tsv_limited

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


# ---- tweets ----

_OBJ = "select line_id, case when json_valid(raw_line) then raw_line::json end as j from tweet_lines"
_PARSED = f"p as (select line_id, j, try_cast(j->>'$.user.id' as bigint) as id from ({_OBJ}) where json_type(j) = 'OBJECT' and json_type(j, '$.user') = 'OBJECT' and regexp_full_match(j->>'$.user.id', '[+-]?[0-9]+'))"
_INNER = (
    "i as (select line_id, id, coalesce("
    + ", ".join(f"case when {' and '.join(f"json_type(j, '$.{'.'.join(['retweeted_status'] * k)}') = 'OBJECT'" for k in range(1, n + 1))} then j->'$.{'.'.join(['retweeted_status'] * n)}' end" for n in (4, 3, 2, 1))
    + ", j) as x from p)"
)
_LANGS = ("en", "it", "de")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_tweets(table(spark, sf_dir, "tweet_lines"), "raw_line")


@query(f"with {_PARSED} select line_id, id from p")
def tweet_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("line_id", "id")


@query(f"with {_PARSED}, {_INNER} select line_id, x->>'$.text' as text, x->>'$.lang' as lang from i where x->>'$.text' is not null and lower(x->>'$.lang') in {_LANGS}")
def tweet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_tweets(_lines(spark, sf_dir), _LANGS).select("line_id", "tweet.text", "tweet.lang")


@query(f"with {_PARSED}, {_INNER} select line_id from i where x->>'$.text' is not null and json_type(x, '$.entities') = 'OBJECT' and json_type(x, '$.entities.media') = 'ARRAY' and json_array_length(x, '$.entities.media') > 0")
def tweet_with_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_images(filter_tweets(_lines(spark, sf_dir))).select("line_id")


@query(f"with {_PARSED} select line_id, id, j->>'$.lang' as lang, j->>'$.text' as text from p")
def tweet_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed paths of the raw lines."""
    raw = F.col("raw_line")
    return _lines(spark, sf_dir).select("line_id", json_path(raw, "long", "user", "id").alias("id"), json_path(raw, "string", "lang").alias("lang"), json_path(raw, "string", "text").alias("text"))


@query(f"with {_PARSED}, {_INNER} select line_id, id, x->>'$.text' as text from i where x->>'$.text' is not null")
def tweet_serialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets as JSON and the text read from it again."""
    t = filter_tweets(_lines(spark, sf_dir))
    return t.select("line_id", "id", F.to_json("tweet").alias("json")).select("line_id", "id", F.get_json_object("json", "$.text").alias("text"))


@query("select tweet_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '^RT ', ''), 'https?://[^\\s]+', 'url', 'g'), '@[^\\s]+', 'mention', 'g'), '#[^\\s]+', 'hashtag', 'g') as text from tweets where text is not null")
def simple_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "tweets").where("text is not null").select("tweet_id", simple_text(F.col("text")).alias("text"))


_BREAK = "regexp_replace({}, '([^\\p{{Lu}}])(\\p{{Lu}})', '\\1 \\2', 'g')"


@query(f"select distinct h.text as tag, {_BREAK.format('h.text')} as broken from (select unnest(entities.hashtags) as h from tweets) where h.text is not null")
def hashtag_break(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "tweets").select(F.explode("entities.hashtags").alias("h")).where("h.text is not null").select(F.col("h.text").alias("tag")).distinct()
    return h.select("tag", break_hashtag(F.col("tag")).alias("broken"))


def _items(kind: str, n: int, rep: str) -> str:
    return f"select rid, {n} * 1000000 + i as ord, entities.{kind}[i].indices[1] as s, entities.{kind}[i].indices[2] as f, {rep} as rep from t, unnest(range(1, coalesce(len(entities.{kind}), 0) + 1)) as u(i) where len(entities.{kind}[i].indices) >= 2"


_TIDY = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '^RT ', ''), '^\\.', ''), 'https?://[^\\s]+', '', 'g'), '[\\t\\n\\v\\f\\r ]+', ' ', 'g')"


@query(
    "with recursive t as (select row_number() over () as rid, tweet_id, text, entities, length(text) as n from tweets where text is not null), "
    f"e0 as ({_items('hashtags', 0, _BREAK.format('coalesce(entities.hashtags[i].text, chr(0))').replace('chr(0)', chr(39) * 2))} union all {_items('user_mentions', 1, chr(39) + 'User' + chr(39))} union all {_items('urls', 2, chr(39) * 2)} union all {_items('media', 3, chr(39) * 2)}), "
    "e as (select rid, s, f, rep, row_number() over (partition by rid order by s, ord) as k from e0 where s is not null and f is not null), "
    "r as (select rid, 0 as k, 0 as p, '' as out from t union all "
    "select rid, k, case when q < n then q + 1 else n end, out || case when p < s then substring(text, p + 1, least(s, n) - p) else '' end || case when q < n then rep else '' end "
    "from (select r.rid, e.k, r.p, r.out, e.s, e.rep, t.text, t.n, greatest(r.p, least(e.s, t.n), e.f - 1) as q from r join e on e.rid = r.rid and e.k = r.k + 1 join t on t.rid = r.rid)), "
    "l as (select rid, arg_max(p, k) as p, arg_max(out, k) as out from r group by rid) "
    f"select tweet_id, case when entities is null then {_TIDY.format('text')} else {_TIDY.format('(out || substring(text, p + 1))')} end as text from t join l on l.rid = t.rid"
)
def entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "tweets").where("text is not null")
    return t.select("tweet_id", tidy_text(entity_text(F.col("text"), F.col("entities"))).alias("text"))


def _json_items(kind: str, n: int, rep: str) -> str:
    return f"select rid, {n} * 1000000 + i as ord, e.{kind}[i].indices[1] as s, e.{kind}[i].indices[2] as f, {rep} as rep from t, unnest(range(1, coalesce(len(e.{kind}), 0) + 1)) as u(i) where len(e.{kind}[i].indices) >= 2"


_SHAPE = '{"hashtags": [{"text": "VARCHAR", "indices": ["INTEGER"]}], "user_mentions": [{"indices": ["INTEGER"]}], "urls": [{"indices": ["INTEGER"]}], "media": [{"indices": ["INTEGER"]}]}'


@query(
    f"with recursive {_PARSED}, {_INNER}, t as (select row_number() over () as rid, line_id, id, x->>'$.text' as text, length(x->>'$.text') as n, case when json_type(x, '$.entities') = 'OBJECT' then json_transform(x->'$.entities', '{_SHAPE}') end as e from i where x->>'$.text' is not null and lower(x->>'$.lang') in {_LANGS}), "
    f"e0 as ({_json_items('hashtags', 0, _BREAK.format(f'coalesce(e.hashtags[i].text, {chr(39) * 2})'))} union all {_json_items('user_mentions', 1, chr(39) + 'User' + chr(39))} union all {_json_items('urls', 2, chr(39) * 2)} union all {_json_items('media', 3, chr(39) * 2)}), "
    "o as (select rid, s, f, rep, row_number() over (partition by rid order by s, ord) as k from e0 where s is not null and f is not null), "
    "r as (select rid, 0 as k, 0 as p, '' as out from t union all "
    "select rid, k, case when q < n then q + 1 else n end, out || case when p < s then substring(text, p + 1, least(s, n) - p) else '' end || case when q < n then rep else '' end "
    "from (select r.rid, o.k, r.p, r.out, o.s, o.rep, t.text, t.n, greatest(r.p, least(o.s, t.n), o.f - 1) as q from r join o on o.rid = r.rid and o.k = r.k + 1 join t on t.rid = r.rid)), "
    "l as (select rid, arg_max(p, k) as p, arg_max(out, k) as out from r group by rid) "
    f"select line_id, id, case when e is null then {_TIDY.format('text')} else {_TIDY.format('(out || substring(text, p + 1))')} end as text from t join l on l.rid = t.rid"
)
def tweet_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from raw lines to normalised text."""
    return tweet_text(filter_tweets(_lines(spark, sf_dir), _LANGS)).select("line_id", "id", "text")


# ---- rows and files ----


def _field(c: str) -> str:
    s = f"regexp_replace(regexp_replace({c}::varchar, '[\\t\\n\\v\\f\\r ]+', ' ', 'g'), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    return f"case when {c} is null then '<unk>' when {s} = '' then ' ' else {s} end"


@query(f"select {_field('doc_id')} || chr(9) || {_field('lang')} || chr(9) || {_field('source')} || chr(9) || {_field('text')} as value from documents")
def tsv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_rows(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))


@query("select count(*) filter (where lang is null or source is null or text is null) as rows_with_null, count(*) as rows from documents")
def null_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", "source", "text")
    return d.agg(F.count_if(metrics.any_null(d)).alias("rows_with_null"), F.count(F.lit(1)).alias("rows"))


@query(
    "with f as (select blob_name as name, sum(strlen(raw_line))::bigint as length from tweet_lines group by 1), g as (select regexp_replace(name, '(-[0-9]+)*\\.[a-z]+$', '') as base, count(*) as chunks, sum(length)::bigint as bytes from f group by 1) "
    "select base, chunks, bytes, case when bytes > 1073741824 then printf('%.2fGB', bytes / 1073741824.0) when bytes > 1048576 then printf('%.2fMB', bytes / 1048576.0) else printf('%.2fKB', bytes / 1024.0) end as size from g"
)
def chunk_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_sizes(table(spark, sf_dir, "tweet_lines").groupBy(F.col("blob_name").alias("name")).agg(F.sum(F.octet_length("raw_line")).alias("length")))


@query("select '(' || doc_id || ',' || coalesce(lang, 'null') || ',' || coalesce(n_chars::varchar, 'null') || ')' as value from documents")
def tuple_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in brackets."""
    return table(spark, sf_dir, "documents").select(tuple_string(F.col("doc_id"), F.col("lang"), F.col("n_chars")).alias("value"))


@query("with f as (select (row_number() over (order by doc_id) // 100)::int as file from documents) select '1-' || file as file, count(*) as rows from f group by file")
def rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling writer's files, written and read again."""
    at = f"{shared_dir(spark)}/rolled-{uuid.uuid4().hex}"
    write_tsv_limited(table(spark, sf_dir, "documents").select("doc_id"), at, 100)
    return spark.read.text(at).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))


@query("with f as (select (row_number() over (order by doc_id) // 100)::int as file from documents) select file, count(*) as rows from f group by file")
def file_roll_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limited_files(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 100).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


_POS = """case when regexp_matches(t, '^[0-9]') then 'CD' when t in (',', ';') then ',' when t in ('.', '!', '?') then '.' when t in (':', '-', '…') then ':' when not regexp_matches(t, '\\p{L}') then 'SYM'
when lower(t) in ('the', 'a', 'an', 'this', 'that') then 'DT' when lower(t) in ('of', 'in', 'on', 'at', 'by', 'with', 'from', 'to') then 'IN' when lower(t) in ('and', 'or', 'but') then 'CC'
when regexp_matches(t, '^\\p{Lu}') then 'NNP' when t like '%ed' then 'VBD' when t like '%ing' then 'VBG' when t like '%ly' then 'RB' when t like '%s' then 'NNS' else 'NN' end"""


@query(
    f"with t as (select doc_id, regexp_extract_all(text, '[\\p{{L}}\\p{{M}}]+(?:[''’-][\\p{{L}}\\p{{M}}]+)*|[0-9]+(?:[.,][0-9]+)*|[^\\s\\p{{L}}\\p{{M}}0-9]') as a from documents where text is not null) "
    f"select doc_id, len(a)::int as n, array_to_string(list_transform(a, lambda t: t || '@' || {_POS}), ' ') as terms from t"
)
def rule_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's terms with their parts of speech."""
    d = RuleAnnotator().annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.size("terms").alias("n"), F.array_join(F.transform("terms", lambda t: F.concat(t["form"], F.lit("@"), t["morphofeat"])), " ").alias("terms"))


@query("select doc_id, idx, lemma, pos, case when regexp_full_match(synset, '[0-9]{8}-[a-z]') then synset when idx % 2 = 0 then '00000001-v' end as synset from simple_term")
def picked_synsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of documents, each with the first reference that is a synset's id."""
    ref = lambda name, value: F.struct(F.lit(name).alias("resource"), value.alias("reference"))
    refs = F.array(ref("form", F.col("lemma")), ref("wordnet", F.col("synset")), ref("other", F.when(F.col("idx") % 2 == 0, "00000001-v")))
    t = table(spark, sf_dir, "simple_term").select("doc_id", "idx", F.array(F.struct(F.col("lemma").alias("form"), F.col("pos").alias("morphofeat"), refs.alias("refs"))).alias("terms"))
    return t.select("doc_id", "idx", F.explode(terms.simple_terms(F.col("terms"))).alias("t")).select("doc_id", "idx", "t.lemma", "t.pos", "t.synset")


# ---- terms ----

_STRING = "lemma || '@' || coalesce(pos, 'null') || coalesce('@' || synset, '')"


@query(f"select doc_id, string_agg({_STRING}, ' ' order by idx) as text from (select doc_id, idx, coalesce(lemma, 'null') as lemma, pos, synset from simple_term) group by doc_id")
def term_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.annotated_text(table(spark, sf_dir, "simple_term"))


# The clean-up in SQL, another way than the operator's: for each term its held-back sign is looked up by a join with the first sign of its run.
_CLEAN = """r as (select *, coalesce(sum(case when pos = 'CD' then 1 else 0 end) over (partition by doc_id order by idx), 0) as run from simple_term),
s as (select doc_id, run, min(idx) as i1 from r where run > 0 and pos in (':', ',', '.') group by doc_id, run),
f as (select s.doc_id, s.run, s.i1, r.lemma, r.pos, r.synset from s join r on r.doc_id = s.doc_id and r.idx = s.i1),
k as (select r.doc_id, r.idx, r.lemma, r.pos, r.synset, r.run, f.i1, f.lemma as fl, f.pos as fp, f.synset as fs from r left join f on f.doc_id = r.doc_id and f.run = r.run where r.pos is distinct from 'CD' and (f.i1 is null or r.idx <> f.i1)),
c as (select doc_id, idx, 0 as sub, '<nmb>' as lemma, 'CD' as pos, null::varchar as synset from k where run > 0
union all select doc_id, idx, 1, fl, fp, fs from k where run > 0 and idx > i1
union all select doc_id, idx, 2, lemma, pos, synset from k)"""


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.clean_terms(table(spark, sf_dir, "simple_term"))


@query(f"with {_CLEAN} select doc_id, string_agg({_STRING}, ' ' order by idx, sub) as text from (select doc_id, idx, sub, coalesce(lemma, 'null') as lemma, pos, synset from c) group by doc_id")
def number_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.annotated_text(_clean(spark, sf_dir))


@query(f"with {_CLEAN} select lemma, count(*) as n from c group by lemma having count(*) > 100")
def word_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.count_terms(_clean(spark, sf_dir), "lemma", 100)


@query(f"with {_CLEAN} select pos, count(*) as n from c group by pos")
def pos_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.count_terms(_clean(spark, sf_dir), "pos")


@query(f"with {_CLEAN} select '(' || lemma || ',' || count(*) || ')' as value from c where lemma is not null group by lemma having count(*) > 100")
def word_dict_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.count_strings(terms.count_terms(_clean(spark, sf_dir).where("lemma is not null"), "lemma", 100), "lemma")


_DICTS = f"{_CLEAN}, w as (select lemma as token, row_number() over (order by count(*) desc, lemma) - 1 as id from c where lemma is not null group by lemma having count(*) > 100), q as (select pos as token, row_number() over (order by count(*) desc, pos) - 1 as id from c where pos is not null group by pos), j as (select c.*, w.id as wi, q.id as qi from c left join w on w.token = c.lemma left join q on q.token = c.pos)"


def _dicts(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    return encode.dictionary(terms.count_terms(t, "lemma", 100), "lemma"), encode.dictionary(terms.count_terms(t, "pos"), "pos")


@query(f"with {_DICTS} select doc_id, string_agg(case when wi is null then '<unk>' else lemma end, ' ' order by idx, sub) as text from j group by doc_id")
def encoded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _clean(spark, sf_dir)
    return encode.encode_text(t, _dicts(t)[0])


@query(f"with {_DICTS} select doc_id, string_agg(case when wi is null then '<unk>' else lemma end || '@' || case when qi is null then '<unk>' else pos end, ' ' order by idx, sub) as text from j group by doc_id")
def encoded_text_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _clean(spark, sf_dir)
    return encode.encode_text(t, *_dicts(t))


@query(f"with {_DICTS} select doc_id, string_agg(coalesce(wi, 0)::varchar, ' ' order by idx, sub) as text, string_agg(coalesce(qi, 0)::varchar, ' ' order by idx, sub) as pos from j group by doc_id")
def encoded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _clean(spark, sf_dir)
    ids = encode.encode_ids(t, *_dicts(t))
    return ids.select("doc_id", *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("text", "pos")])


def _varint(n: str) -> str:
    """SQL: the whole number n, below 2**28, as a varint in hex."""
    low = "printf('%02X', {0} % 128 + 128)".format
    return f"(case when {n} < 128 then printf('%02X', {n}) when {n} < 16384 then {low(n)} || printf('%02X', {n} // 128) when {n} < 2097152 then {low(n)} || {low(f'({n} // 128)')} || printf('%02X', {n} // 16384) else {low(n)} || {low(f'({n} // 128)')} || {low(f'({n} // 16384)')} || printf('%02X', {n} // 2097152) end)"


def _delimited(tag: str, body: str) -> str:
    """SQL: a field of bytes in hex with its length."""
    return f"('{tag}' || {_varint(f'(length({body}) // 2)')} || {body})"


# Each level of the message is a table of its own, so that lengths are lengths of columns.
_EXAMPLE = (
    f"{_DICTS}, x0 as (select doc_id, string_agg({_varint('coalesce(wi, 0)')}, '' order by idx, sub) as t, string_agg({_varint('coalesce(qi, 0)')}, '' order by idx, sub) as p from j group by doc_id), "
    f"x1 as (select doc_id, {_delimited('0A', 't')} as t, {_delimited('0A', 'p')} as p from x0), x2 as (select doc_id, {_delimited('1A', 't')} as t, {_delimited('1A', 'p')} as p from x1), "
    f"x3 as (select doc_id, '0A0474657874' || {_delimited('12', 't')} as t, '0A03706F73' || {_delimited('12', 'p')} as p from x2), x4 as (select doc_id, {_delimited('0A', 'p')} || {_delimited('0A', 't')} as f from x3)"
)


@query(f"with {_EXAMPLE} select doc_id, {_delimited('0A', 'f')} as example from x4")
def example_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training examples on the wire, in hex."""
    t = _clean(spark, sf_dir)
    return encode.to_examples(encode.encode_ids(t, *_dicts(t))).select("doc_id", F.hex("example").alias("example"))


@query(ORACLE["encoded_ids"])
def decoded_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids read from training examples again."""
    t = _clean(spark, sf_dir)
    e = encode.to_examples(encode.encode_ids(t, *_dicts(t))).select("doc_id", decode_example("example").alias("f"))
    return e.select("doc_id", *[F.array_join(F.try_element_at("f", F.lit(c))["ints"].cast("array<string>"), " ").alias(c) for c in ("text", "pos")])


# ---- lexicon ----

_LEX = """o as (select name, min(lpad(syn_offset::varchar, 8, '0') || '-' || pos) as id from wordnet_offsets where name is not null and syn_offset is not null and pos is not null group by name),
v as (select image_id, i - 1 as place, relationships[i] as x from relationships, unnest(range(1, coalesce(len(relationships), 0) + 1)) as u(i) where relationships[i] is not null),
z as (select image_id, place, x.predicate as predicate, x.synsets[1] as rn, x.object.synsets[1] as onm, x.subject.synsets[1] as sn, a.id as rel, b.id as obj, c.id as subj from v left join o a on a.name = x.synsets[1] left join o b on b.name = x.object.synsets[1] left join o c on c.name = x.subject.synsets[1]),
raw as (select rel, obj, subj from z where rel is not null and obj is not null and subj is not null),
met as (select rel as id, rn as name, image_id, place, 0 as k from z where rel is not null union all select obj, onm, image_id, place, 1 from z where obj is not null union all select subj, sn, image_id, place, 2 from z where subj is not null),
syn as (select id, arg_min(name, (image_id, place, k)) as name from met group by id)"""


def _lexicon(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return lexicon.build_lexicon(table(spark, sf_dir, "relationships"), table(spark, sf_dir, "wordnet_offsets"))


@query(f"with {_LEX} select rel, obj, subj from raw")
def vg_raw_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexicon(spark, sf_dir)[0]


@query(
    f"with {_LEX} select first(predicate order by image_id, place) as predicate, rel, coalesce(string_agg(distinct obj, ',' order by obj), '') as objects, coalesce(string_agg(distinct subj, ',' order by subj), '') as subjects from z where rel is not null group by rel"
)
def vg_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexicon(spark, sf_dir)[1].select("predicate", "rel", F.array_join("objects", ",").alias("objects"), F.array_join("subjects", ",").alias("subjects"))


@query(f"with {_LEX} select id, name from syn")
def vg_synsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexicon(spark, sf_dir)[2]


@query(f"with {_LEX} select predicate, rel, obj, subj from (select *, row_number() over (partition by rel order by image_id desc, place desc) as k from z where rel is not null) where k = 1")
def lexicon_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of rows with one relation, the last."""
    r = lexicon.resolved(lexicon.relationship_rows(table(spark, sf_dir, "relationships")), table(spark, sf_dir, "wordnet_offsets"))
    return lexicon.last_wins(r.where("rel is not null"), "rel", "seq").select("predicate", "rel", "obj", "subj")


@query(f"with {_LEX}, both_ways as (select rel, obj as o, subj as s from raw union all select rel, subj, obj from raw) select rel, o, s, count(*) as freq from both_ways group by rel, o, s")
def triple_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.triple_index(_lexicon(spark, sf_dir)[0])


# ---- matching and frames ----

_REFS = f"""{_LEX}, ref as (select doc_id, idx, synset as ref from simple_term where regexp_full_match(synset, '[0-9]{{8}}-[a-z]') and synset in (select id from syn)),
hasrel as (select distinct rel from z where rel is not null), rr as (select * from ref where ref in (select rel from hasrel)), oo as (select distinct doc_id, ref from ref where ref not in (select rel from hasrel))"""
_V1 = f"""{_REFS}, ro as (select distinct rel, obj as m from z where rel is not null and obj is not null), rs as (select distinct rel, subj as m from z where rel is not null and subj is not null),
n as (select doc_id, sum(k) as k from (select doc_id, count(*) as k from rr group by 1 union all select doc_id, count(*) from oo group by 1) group by 1),
d as (select doc_id, ref, min(idx) as idx from rr group by 1, 2),
ho as (select d.doc_id, d.ref, d.idx, ro.m from d join ro on ro.rel = d.ref join oo on oo.doc_id = d.doc_id and oo.ref = ro.m),
hs as (select d.doc_id, d.ref, d.idx, rs.m from d join rs on rs.rel = d.ref join oo on oo.doc_id = d.doc_id and oo.ref = rs.m),
full_ as (select doc_id, ref, min(idx) as idx from ho where not exists (select 1 from hs where hs.doc_id = ho.doc_id and hs.ref = ho.ref and hs.m = ho.m) and exists (select 1 from hs where hs.doc_id = ho.doc_id and hs.ref = ho.ref) group by 1, 2),
best as (select doc_id, arg_min(ref, idx) as ref from full_ group by 1),
bo as (select b.doc_id, string_agg(syn.name, '|' order by ho.m) as t, count(*) as k from best b join ho on ho.doc_id = b.doc_id and ho.ref = b.ref join syn on syn.id = ho.m group by 1),
bs as (select b.doc_id, string_agg(syn.name, '|' order by hs.m) as t, count(*) as k from best b join hs on hs.doc_id = b.doc_id and hs.ref = b.ref join syn on syn.id = hs.m group by 1),
v1 as (select n.doc_id, case when best.ref is not null then 3 when n.doc_id in (select doc_id from ho union select doc_id from hs) then 2 when n.k > 1 then 1 else 0 end as priority,
case when best.ref is null then '' else '<' || case when bo.k > 1 then '(' || bo.t || ')' else bo.t end || ',' || syn.name || ',' || case when bs.k > 1 then '(' || bs.t || ')' else bs.t end || '>' end as matches
from n left join best on best.doc_id = n.doc_id left join bo on bo.doc_id = n.doc_id left join bs on bs.doc_id = n.doc_id left join syn on syn.id = best.ref)"""


def _v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rel, syn = _lexicon(spark, sf_dir)
    return match.score_v1(match.term_refs(table(spark, sf_dir, "simple_term")), rel, syn)


@query(f"with {_V1} select doc_id, priority, matches from v1")
def match_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v1(spark, sf_dir)


_V2 = f"""{_LEX}, ref as (select distinct doc_id, synset as ref from simple_term where regexp_full_match(synset, '[0-9]{{8}}-[a-z]') and synset in (select id from syn)),
keys as (select distinct rel from raw), rr as (select * from ref where ref in (select rel from keys)), oo as (select * from ref where ref not in (select rel from keys)),
v2 as (select rr.doc_id, max(case when a.ref is not null and b.ref is not null then 3 when a.ref is not null or b.ref is not null then 2 else -1 end) as priority
from rr join (select distinct * from raw) t on t.rel = rr.ref left join oo a on a.doc_id = rr.doc_id and a.ref = t.obj left join oo b on b.doc_id = rr.doc_id and b.ref = t.subj group by 1)"""


def _v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _, syn = _lexicon(spark, sf_dir)
    return match.score_v2(match.term_refs(table(spark, sf_dir, "simple_term")), lexicon.triple_index(raw), syn)


@query(f"with {_V2} select doc_id, priority from v2 where priority > -1")
def match_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v2(spark, sf_dir)


@query(f"with {_V2} select doc_id, case when priority >= 3 then 'high-priority-verb' else 'verb' end as sink from v2 where priority > -1")
def priority_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = split_priority(_v2(spark, sf_dir))
    return low.select("doc_id", F.lit("verb").alias("sink")).unionByName(high.select("doc_id", F.lit("high-priority-verb").alias("sink")))


@query(f"with {_V1} select 'PRIORITY_' || priority as counter, count(*) as n from v1 group by 1")
def priority_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.priority_counts(_v1(spark, sf_dir))


_ROLE = "regexp_replace(regexp_replace(coalesce(r.str, ''), '[^0-9a-zA-Z\\t\\n\\v\\f\\r ]+', '', 'g'), '[\\t\\n\\v\\f\\r ]+', ' ', 'g')"
_FRAMES = f"""p as (select doc_id, (i - 1)::int as place, predicates[i] as p from doc_frames, unnest(range(1, coalesce(len(predicates), 0) + 1)) as u(i) where predicates[i].framenet is not null),
r as (select doc_id, place, j, p.roles[j] as r from p, unnest(range(1, coalesce(len(p.roles), 0) + 1)) as u(j) where contains(p.roles[j].framenet, '@')),
t as (select doc_id, place, string_agg('''' || {_ROLE} || ''' is the ''' || regexp_extract(r.framenet, '[^@]*$') || '''', ' and ' order by j) as t from r group by 1, 2)"""


@query(f"with {_FRAMES} select p.doc_id, p.place, 'In frame (0) ' || upper(p.p.framenet) || ' ' || coalesce(t.t, '') as sentence, 0 as priority from p left join t on t.doc_id = p.doc_id and t.place = p.place")
def frame_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames_of(table(spark, sf_dir, "doc_frames").withColumn("priority", F.lit(0)))


@query(f"with {_V1}, {_FRAMES} select p.doc_id, p.place, 'In frame (' || v1.priority || ') ' || upper(p.p.framenet) || ' ' || coalesce(t.t, '') as sentence, v1.priority as priority from p join v1 on v1.doc_id = p.doc_id left join t on t.doc_id = p.doc_id and t.place = p.place")
def frame_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames_of(table(spark, sf_dir, "doc_frames").join(_v1(spark, sf_dir).select("doc_id", "priority"), "doc_id"))


__all__ = ["ORACLE", "QUERIES", "serialize"]
