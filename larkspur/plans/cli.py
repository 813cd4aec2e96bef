"""Command line: python -m larkspur.plans.cli JOB ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from larkspur.config import StorageConfig
from larkspur.operators.annotate import HttpAnnotator, RuleAnnotator
from larkspur.operators.lexicon import build_lexicon
from larkspur.plans import pipelines
from larkspur.sources import named
from larkspur.sources.naf import read_relationships
from larkspur.sources.tsv import read_tsv


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="larkspur")
    jobs = p.add_subparsers(dest="job", required=True)

    def job(name: str, *options: tuple, **more) -> None:
        j = jobs.add_parser(name, **more)
        for flag, need, text in options:
            j.add_argument(flag, required=need, help=text)
        j.add_argument("--lang", action="append", default=None, help="a language to keep; none keeps all")
        j.add_argument("--annotator", default="rules", help="rules, or the URI of a service")

    job("extract-frames", ("--tweets-path", True, "folder of tweets"), ("--results-path", True, "output"), ("--lexicon", False, "the lexicon's folder, else the output"))
    job("extract-text", ("--output", True, "storage configuration"), ("--tweets-path", False, "folder of tweets"), ("--text-path", False, "folder of text"))
    job("blobs-to-frames", ("--input", True, "storage configuration"), ("--output", True, "storage configuration"), ("--lexicon", True, "the lexicon's folder"))
    job("dictionaries", ("--input", True, "folder or storage configuration"), ("--output", True, "storage configuration"))
    job("encode", ("--input", True, "folder or storage configuration"), ("--output", True, "storage configuration"), ("--dictionaries", True, "folder"))
    job("text-to-naf", ("--input", True, "folder"), ("--output", True, "folder"))
    job("frame-dump", ("--input", True, "folder of NAF"), ("--output", True, "folder"))
    job("lexicon", ("--input", True, "JSON of relationships"), ("--wordnet", True, "table name, offset, part of speech"), ("--output", True, "folder"))
    job("storage", ("--azure-config", True, "storage configuration"), ("--output", True, "folder"), ("--mode", False, "list or assemble"))
    return p


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    spark = SparkSession.builder.appName("larkspur").getOrCreate()
    annotator = RuleAnnotator() if a.annotator == "rules" else HttpAnnotator(a.annotator)
    langs = tuple(a.lang or ())
    if a.job == "extract-frames":
        print(pipelines.extract_frames(spark, a.tweets_path, a.results_path, a.lexicon, langs, annotator))
    elif a.job == "extract-text":
        pipelines.extract_text(spark, StorageConfig.load(a.output), a.tweets_path, a.text_path, langs)
    elif a.job == "blobs-to-frames":
        print(pipelines.blobs_to_frames(spark, StorageConfig.load(a.input), StorageConfig.load(a.output), a.lexicon, annotator))
    elif a.job == "dictionaries":
        print(*pipelines.calculate_stats(spark, a.input, StorageConfig.load(a.output), annotator))
    elif a.job == "encode":
        pipelines.encode_stream(spark, a.input, StorageConfig.load(a.output), a.dictionaries, annotator)
    elif a.job == "text-to-naf":
        print(pipelines.text_to_naf(spark, a.input, a.output, annotator))
    elif a.job == "frame-dump":
        print(pipelines.frame_dump(spark, a.input, a.output))
    elif a.job == "lexicon":
        wordnet = read_tsv(spark, a.wordnet, ["name", "syn_offset", "pos"]).selectExpr("name", "cast(syn_offset as bigint) as syn_offset", "pos")
        pipelines.write_lexicon(*build_lexicon(read_relationships(spark, a.input), wordnet), a.output)
    else:
        config = StorageConfig.load(a.azure_config)
        if a.mode == "assemble":
            named.assemble(spark, config, a.output)
        else:
            for r in named.list_chunks(spark, config).orderBy("base").collect():
                print(f"File {r['base']}, chunks {r['chunks']}, total size: {r['size']}")


if __name__ == "__main__":
    main()
