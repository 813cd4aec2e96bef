"""Annotation of text: the contract text -> document, and annotators that keep it.

A document is doc_id, raw_text, terms and predicates (schema.DOC). RuleAnnotator is a deterministic tokenizer and tagger in Catalyst; HttpAnnotator asks a service, one session a partition; documents that are
annotated already come from sources.naf.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.schema import DOC, PREDICATES, TERMS

TOKEN = r"[\p{L}\p{M}]+(?:['’-][\p{L}\p{M}]+)*|[0-9]+(?:[.,][0-9]+)*|[^\s\p{L}\p{M}0-9]"


class Annotator(Protocol):
    def annotate(self, df: DataFrame) -> DataFrame:
        """df: doc_id, text. Gives documents; texts that can't be annotated are dropped."""


def rule_pos(token: Column) -> Column:
    """A part of speech by form alone: numbers, signs, capitals, common endings, else a noun."""
    return (
        F.when(token.rlike(r"^[0-9]"), "CD").when(token.isin(",", ";"), ",").when(token.isin(".", "!", "?"), ".").when(token.isin(":", "-", "…"), ":").when(~token.rlike(r"[\p{L}]"), "SYM")
        .when(F.lower(token).isin("the", "a", "an", "this", "that"), "DT").when(F.lower(token).isin("of", "in", "on", "at", "by", "with", "from", "to"), "IN").when(F.lower(token).isin("and", "or", "but"), "CC")
        .when(token.rlike(r"^\p{Lu}"), "NNP").when(token.rlike(r"ed$"), "VBD").when(token.rlike(r"ing$"), "VBG").when(token.rlike(r"ly$"), "RB").when(token.rlike(r"s$"), "NNS").otherwise("NN")
    )


class RuleAnnotator:
    """Tokens and parts of speech by rules; senses, if given, as a table lemma -> synset."""

    def __init__(self, senses: DataFrame | None = None):
        self.senses = senses

    def annotate(self, df: DataFrame) -> DataFrame:
        d = df.where("text is not null").select("doc_id", F.col("text").alias("raw_text"))
        none = F.array().cast("array<struct<resource:string,reference:string>>")
        if self.senses is None:
            terms = F.transform(F.regexp_extract_all("raw_text", F.lit(f"({TOKEN})"), F.lit(1)), lambda t: F.struct(t.alias("form"), rule_pos(t).alias("morphofeat"), none.alias("refs")))
            return d.select("doc_id", "raw_text", terms.cast(TERMS).alias("terms"), F.array().cast(PREDICATES).alias("predicates"))
        t = d.select("doc_id", F.posexplode(F.regexp_extract_all("raw_text", F.lit(f"({TOKEN})"), F.lit(1))).alias("idx", "form")).withColumn("lemma", F.lower("form"))
        t = t.join(self.senses.groupBy("lemma").agg(F.min("synset").alias("synset")), "lemma", "left")
        refs = F.when(F.col("synset").isNotNull(), F.array(F.struct(F.lit("WordNet").alias("resource"), F.col("synset").alias("reference")))).otherwise(none)
        g = t.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("idx", "form", rule_pos(F.col("form")).alias("morphofeat"), refs.alias("refs")))).alias("a"))
        terms = F.transform("a", lambda x: F.struct(x["form"].alias("form"), x["morphofeat"].alias("morphofeat"), x["refs"].alias("refs")))
        return d.join(g, "doc_id", "left").select("doc_id", "raw_text", F.coalesce(terms, F.array().cast(TERMS)).alias("terms"), F.array().cast(PREDICATES).alias("predicates"))


def parse_naf(xml: str) -> tuple[list, list]:
    """(terms, predicates) of a NAF document; an error if it is none."""
    from xml.etree import ElementTree as E

    root = E.fromstring(xml)
    refs = lambda e: [{"resource": r.get("resource"), "reference": r.get("reference")} for r in e.findall("./externalReferences//externalRef")]
    frame = lambda e: next((r["reference"] for r in refs(e) if r["resource"] == "FrameNet"), None)
    words, forms, terms = {w.get("id"): w.text or "" for w in root.iter("wf")}, {}, []
    for t in root.iter("term"):
        form = " ".join(words.get(g.get("id"), "") for g in t.findall("./span/target")) or t.get("lemma")
        forms[t.get("id")] = form
        terms.append({"form": form, "morphofeat": t.get("morphofeat"), "refs": refs(t)})
    predicates = [
        {"framenet": frame(p), "roles": [{"framenet": frame(r), "str": " ".join(forms.get(g.get("id"), "") for g in r.findall("./span/target"))} for r in p.findall("./role")]} for p in root.iter("predicate")
    ]
    return terms, predicates


class HttpAnnotator:
    """Posts each text as the form field text to a service that answers with NAF. Texts that fail are dropped; errors counts them once the result has been read."""

    def __init__(self, uri: str = "http://localhost:8011/text2naf", timeout: float = 60.0):
        self.uri, self.timeout = uri, timeout

    def annotate(self, df: DataFrame) -> DataFrame:
        uri, timeout = self.uri, self.timeout
        self.errors = df.sparkSession.sparkContext.accumulator(0)
        errors = self.errors

        def run(batches: Iterator) -> Iterator:
            import http.client
            from urllib.parse import urlencode, urlparse

            import pyarrow as pa

            u = urlparse(uri)
            link = (http.client.HTTPSConnection if u.scheme == "https" else http.client.HTTPConnection)(u.netloc, timeout=timeout)
            kind = pa.schema([("doc_id", pa.int64()), ("raw_text", pa.string()), ("terms", pa.list_(pa.struct([("form", pa.string()), ("morphofeat", pa.string()), ("refs", pa.list_(pa.struct([("resource", pa.string()), ("reference", pa.string())])))]))), ("predicates", pa.list_(pa.struct([("framenet", pa.string()), ("roles", pa.list_(pa.struct([("framenet", pa.string()), ("str", pa.string())])))])))])
            for b in batches:
                rows = []
                for r in b.to_pylist():
                    try:
                        link.request("POST", u.path or "/", urlencode({"text": r["text"]}), {"Content-Type": "application/x-www-form-urlencoded; charset=UTF-8"})
                        answer = link.getresponse()
                        body = answer.read().decode()
                        if answer.status != 200:
                            raise ValueError(answer.status)
                        terms, predicates = parse_naf(body)
                        rows.append({"doc_id": r["doc_id"], "raw_text": r["text"], "terms": terms, "predicates": predicates})
                    except Exception:  # noqa: BLE001 a text that can't be annotated must not end the job
                        errors.add(1)
                        link.close()
                yield pa.RecordBatch.from_pylist(rows, kind)

        return df.where("text is not null").select("doc_id", "text").mapInArrow(run, DOC)
