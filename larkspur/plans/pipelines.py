"""The jobs: what is read, through which operators, to which outputs.

A job whose last steps read one expensive result more than once keeps it by persist() while it writes, and lets it go at the end.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.config import StorageConfig
from larkspur.operators import encode, match, metrics, terms
from larkspur.operators.annotate import Annotator, HttpAnnotator, RuleAnnotator
from larkspur.operators.frames import frame_sentences
from larkspur.operators.lexicon import triple_index
from larkspur.operators.tweets import filter_tweets, parse_tweets, split_priority, tweet_text, with_images
from larkspur.session import cut
from larkspur.sources import named, tsv
from larkspur.sources.naf import read_naf, write_naf
from larkspur.sources.text import open_text, read_documents, read_lines

#: Rows per file of the encoder's outputs, the least count of a word in the dictionary (more than), and the names of its outputs.
ENCODER_ROWS, WORD_COUNT = 10_000_000, 100
TEXT, WORDS, POS = "annotated", "word.dict", "postag.dict"


def with_ids(df: DataFrame, text: str) -> DataFrame:
    """doc_id and text; the ids are unique within the result, which a checkpoint keeps: they stay the same if an executor is lost."""
    return cut(df.select(F.monotonically_increasing_id().alias("doc_id"), F.col(text).alias("text")))


def read_lexicon(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw relations, relations, synsets) of a lexicon's folder."""
    return tsv.read_raw_relations(spark, f"{folder}/raw_relations.tsv"), tsv.read_relations(spark, f"{folder}/relations.tsv"), tsv.read_synsets(spark, f"{folder}/synsets.tsv")


def write_lexicon(raw: DataFrame, relations: DataFrame, synsets: DataFrame, folder: str) -> None:
    """The three files of a lexicon, tab-separated, members of sets with commas."""
    lists = relations.select("predicate", "rel", F.array_join("objects", ","), F.array_join("subjects", ","))
    for name, df in (("raw_relations", raw), ("relations", lists), ("synsets", synsets)):
        cfg = StorageConfig(folder, "", name, ".tsv", 0)
        named.write_named(df.select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns])), cfg)


def tweets_to_text(spark: SparkSession, tweets: str, langs: tuple[str, ...] = ("en",)) -> DataFrame:
    """id, text: the normalised text of a folder's tweets."""
    return tweet_text(filter_tweets(parse_tweets(read_lines(spark, tweets)), langs)).select("id", "text")


def extract_text(spark: SparkSession, config: StorageConfig, tweets: str | None = None, text: str | None = None, langs: tuple[str, ...] = ("en",)) -> None:
    """Tweets' texts, or lines of text, to named files; tweets if both are given."""
    if tweets is None and text is None:
        raise ValueError("neither tweets nor text")
    lines = tweets_to_text(spark, tweets, langs).select(F.col("text").alias("value")) if tweets is not None else read_lines(spark, text)
    named.write_named(lines, config)


def errors_of(annotator: Annotator) -> int:
    """Texts that an annotator could not do, so far."""
    e = getattr(annotator, "errors", None)
    return int(e.value) if e is not None else 0


def extract_frames(spark: SparkSession, tweets: str, results: str, lexicon: str | None = None, langs: tuple[str, ...] = ("en",), annotator: Annotator | None = None) -> dict[str, int]:
    """Tweets with images, scored by the lexicon: all to results/frames, those of the highest priority to results/top_frames, as text, priority and matches.

    Gives the job's counters, a null counter for each output among them."""
    annotator = annotator or RuleAnnotator()
    t = with_images(filter_tweets(parse_tweets(read_lines(spark, tweets)), langs))
    docs = annotator.annotate(with_ids(tweet_text(t), "text")).persist(StorageLevel.MEMORY_AND_DISK)
    _, relations, synsets = read_lexicon(spark, lexicon or results)
    scored = docs.select("doc_id", "raw_text").join(match.score_v1(match.document_refs(docs), relations, synsets), "doc_id").select("raw_text", "priority", "matches").persist(StorageLevel.MEMORY_AND_DISK)
    nulls = {}
    try:
        for out, part in ((f"{results}/frames", scored), (f"{results}/top_frames", split_priority(scored)[1])):
            part, seen = metrics.observe_nulls(part, out)
            tsv.write_tsv(part, out)
            nulls[metrics.null_counter_name(out)] = seen.get["rows_with_null"]
        return metrics.scoring_counters(docs, scored, errors_of(annotator)) | nulls
    finally:
        scored.unpersist()
        docs.unpersist()


def blobs_to_frames(spark: SparkSession, source: StorageConfig, target: StorageConfig, lexicon: str, annotator: Annotator | None = None, tuples: bool = False) -> dict[str, int]:
    """Text files to frames' sentences: below the highest priority to files named verb, others to high-priority-verb. tuples: in brackets. Gives the job's counters."""
    annotator = annotator or RuleAnnotator()
    lines = open_text_of(spark, source)
    docs = annotator.annotate(with_ids(lines, "value")).persist(StorageLevel.MEMORY_AND_DISK)
    raw, _, synsets = read_lexicon(spark, lexicon)
    scores = match.score_v2(match.document_refs(docs), triple_index(raw), synsets).persist(StorageLevel.MEMORY_AND_DISK)
    out = frame_sentences(docs.join(scores, "doc_id")).persist(StorageLevel.MEMORY_AND_DISK)
    line = named.tuple_string(F.col("sentence")) if tuples else F.col("sentence")
    try:
        for name, part in zip(("verb", "high-priority-verb"), split_priority(out), strict=True):
            named.write_named(part.select(line.alias("value")), replace(target, prefix=name))
        return metrics.scoring_counters(docs, scores, errors_of(annotator)) | {"COLLECTED_FRAMES": out.count()}
    finally:
        out.unpersist()
        scores.unpersist()
        docs.unpersist()


def open_text_of(spark: SparkSession, source: StorageConfig | str) -> DataFrame:
    from larkspur.sources.text import read_blobs

    return open_text(spark, source) if isinstance(source, str) else read_blobs(spark, source)


def cleaned(docs: DataFrame) -> DataFrame:
    return terms.clean_terms(terms.exploded(docs))


def calculate_stats(spark: SparkSession, source: StorageConfig | str, target: StorageConfig, annotator: Annotator | None = None) -> list[str]:
    """First pass of the encoder: annotated text, word and part-of-speech dictionaries, each only if it isn't there yet. Gives the names of what was written."""
    missing = [n for n in (TEXT, WORDS, POS) if not named.output_exists(spark, replace(target, prefix=n))]
    if not missing:
        return []
    t = cleaned((annotator or RuleAnnotator()).annotate(with_ids(open_text_of(spark, source), "value"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if TEXT in missing:
            named.write_named(terms.annotated_text(t).select("text"), replace(target, prefix=TEXT), tasks=20)
        for name, key, least in ((WORDS, "lemma", WORD_COUNT), (POS, "pos", None)):
            if name in missing:
                d = encode.dictionary(terms.count_terms(t, key, least), key).orderBy("id")
                named.write_named(d.select(F.concat_ws("\t", "token", F.col("n").cast("string"))), replace(target, prefix=name, suffix="", rows_per_part=0, compress=False), ordered=True)
    finally:
        t.unpersist()
    return missing


def encode_stream(spark: SparkSession, source: StorageConfig | str, target: StorageConfig, dictionaries: str, annotator: Annotator | None = None, framing: str = "tfrecord") -> None:
    """Second pass: text of known words, the same with parts of speech, and training examples."""
    from larkspur.sources import tfrecord

    words, pos = tsv.read_dictionary(spark, f"{dictionaries}/{WORDS}"), tsv.read_dictionary(spark, f"{dictionaries}/{POS}")
    t = cleaned((annotator or RuleAnnotator()).annotate(with_ids(open_text_of(spark, source), "value"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        named.write_named(encode.encode_text(t, words).select("text"), replace(target, prefix="text", rows_per_part=ENCODER_ROWS))
        named.write_named(encode.encode_text(t, words, pos).select("text"), replace(target, prefix="text-pos", rows_per_part=ENCODER_ROWS))
        tfrecord.register(spark)
        examples = encode.to_examples(encode.encode_ids(t, words, pos)).select(F.col("example").alias("value"))
        examples.write.format("tfrecord").mode("append").option("framing", framing).option("path", f"{target.folder}/examples").save()
    finally:
        t.unpersist()


def text_to_naf(spark: SparkSession, folder: str, out: str, annotator: Annotator | None = None) -> int:
    """Each line of each file of a folder as an annotated NAF file; lines that can't be annotated are left out. Gives the number of files."""
    lines = read_documents(spark, folder).where("value <> ''").withColumn("doc_id", F.xxhash64("name", "line")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        docs = (annotator or HttpAnnotator()).annotate(lines.select("doc_id", F.col("value").alias("text")))
        return write_naf(docs.join(lines.select("doc_id", "name", "line"), "doc_id"), out).count()
    finally:
        lines.unpersist()


def frame_dump(spark: SparkSession, folder: str, out: str, leading_line: bool = False) -> dict[str, int]:
    """The frames of a folder's NAF files as sentences with priority 0, by file and place. leading_line: an empty first line. Gives the job's counters."""
    s, seen = metrics.observe_rows(frame_sentences(read_naf(spark, folder).withColumn("priority", F.lit(0))), "COLLECTED_FRAMES")
    s = s.select(F.lit(1).alias("k"), "doc_id", "place", F.col("sentence").alias("value"))
    if leading_line:
        s = s.unionByName(spark.createDataFrame([(0, 0, 0, "")], "k int, doc_id bigint, place int, value string"))
    # The files are read in their own tasks; only sorting and writing the sentences is one.
    s.repartition(1).sortWithinPartitions("k", "doc_id", "place").select("value").write.text(out)
    return {"COLLECTED_FRAMES": seen.get["rows"]}
