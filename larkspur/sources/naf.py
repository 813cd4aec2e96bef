"""Annotated documents as NAF XML, and images' relationships as JSON.

Of NAF are used: raw; terms/term with lemma or the words' forms, morphofeat and externalReferences; srl/predicate with externalReferences and role, whose text is the span's words.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larkspur.schema import DOC
from larkspur.sources.named import local_path

REF = "STRUCT<_resource:STRING,_reference:STRING>"
REFS = f"STRUCT<externalRef:ARRAY<{REF}>>"
SPAN = "STRUCT<target:ARRAY<STRUCT<_id:STRING>>>"
NAF = (
    f"raw STRING, text STRUCT<wf:ARRAY<STRUCT<_id:STRING,_VALUE:STRING>>>, terms STRUCT<term:ARRAY<STRUCT<_id:STRING,_lemma:STRING,_morphofeat:STRING,span:{SPAN},externalReferences:{REFS}>>>, "
    f"srl STRUCT<predicate:ARRAY<STRUCT<_id:STRING,externalReferences:{REFS},role:ARRAY<STRUCT<_id:STRING,_semRole:STRING,span:{SPAN},externalReferences:{REFS}>>>>>"
)


def _refs(c):
    return F.transform(F.coalesce(c["externalReferences"]["externalRef"], F.array().cast(f"array<{REF}>")), lambda r: F.struct(r["_resource"].alias("resource"), r["_reference"].alias("reference")))


def _frame(c):
    return F.get(F.transform(F.filter(_refs(c), lambda r: r["resource"] == "FrameNet"), lambda r: r["reference"]), F.lit(0))


def read_naf(spark: SparkSession, path: str) -> DataFrame:
    """The *.xml files of a folder, not of folders in it, as documents with name; doc_id is a hash of the name."""
    x = spark.read.format("xml").option("rowTag", "NAF").schema(NAF).option("pathGlobFilter", "*.xml").load(path).withColumn("name", F.col("_metadata.file_name"))
    words = F.map_from_entries(F.transform(F.coalesce("text.wf", F.array().cast("array<struct<_id:string,_VALUE:string>>")), lambda w: F.struct(w["_id"], w["_VALUE"])))
    terms = F.coalesce("terms.term", F.array().cast(x.schema["terms"].dataType["term"].dataType.simpleString()))
    x = x.withColumn("words", words).withColumn("ts", terms)
    form = lambda t: F.coalesce(F.array_join(F.transform(t["span"]["target"], lambda g: F.try_element_at(F.col("words"), g["_id"])), " "), t["_lemma"])
    x = x.withColumn("forms", F.map_from_entries(F.transform("ts", lambda t: F.struct(t["_id"], form(t)))))
    text = lambda r: F.array_join(F.transform(r["span"]["target"], lambda g: F.try_element_at(F.col("forms"), g["_id"])), " ")
    roles = lambda p: F.transform(F.coalesce(p["role"], F.array().cast(x.schema["srl"].dataType["predicate"].dataType.elementType["role"].dataType.simpleString())), lambda r: F.struct(_frame(r).alias("framenet"), text(r).alias("str")))
    return x.select(
        "name", F.xxhash64("name").alias("doc_id"), F.coalesce("raw", F.array_join(F.map_values("words"), " ")).alias("raw_text"),
        F.transform("ts", lambda t: F.struct(form(t).alias("form"), t["_morphofeat"].alias("morphofeat"), _refs(t).alias("refs"))).alias("terms"),
        F.transform("srl.predicate", lambda p: F.struct(_frame(p).alias("framenet"), roles(p).alias("roles"))).alias("predicates"),
    )


def naf_text(raw: str, terms: list, predicates: list) -> str:
    """A document as NAF."""
    from xml.sax.saxutils import escape, quoteattr

    out, ids = ['<?xml version="1.0" encoding="UTF-8"?>', '<NAF version="v3">', f"<raw>{escape(raw or '')}</raw>"], {}
    out.append("<text>" + "".join(f'<wf id="w{k}">{escape(t["form"] or "")}</wf>' for k, t in enumerate(terms)) + "</text><terms>")
    for k, t in enumerate(terms):
        ids.setdefault(t["form"], f"t{k}")
        refs = "".join(f"<externalRef resource={quoteattr(r['resource'] or '')} reference={quoteattr(r['reference'] or '')}/>" for r in t["refs"] or [])
        out.append(f'<term id="t{k}" lemma={quoteattr(t["form"] or "")} morphofeat={quoteattr(t["morphofeat"] or "")}><span><target id="w{k}"/></span><externalReferences>{refs}</externalReferences></term>')
    out.append("</terms><srl>")
    for k, p in enumerate(predicates or []):
        out.append(f'<predicate id="p{k}">' + (f"<externalReferences><externalRef resource=\"FrameNet\" reference={quoteattr(p['framenet'])}/></externalReferences>" if p["framenet"] else ""))
        for j, r in enumerate(p["roles"] or []):
            span = "".join(f'<target id="{ids[w]}"/>' for w in (r["str"] or "").split() if w in ids)
            out.append(f'<role id="r{k}-{j}"><span>{span}</span>' + (f"<externalReferences><externalRef resource=\"FrameNet\" reference={quoteattr(r['framenet'])}/></externalReferences>" if r["framenet"] else "") + "</role>")
        out.append("</predicate>")
    return "\n".join([*out, "</srl>", "</NAF>"])


def numbered_name(name: str, n: int) -> str:
    """a-n.xml of a.txt, a-n of a name without a dot after its first letter."""
    dot = name.rfind(".")
    return f"{name[:dot]}-{n}.xml" if dot > 0 else f"{name}-{n}"


def write_naf(docs: DataFrame, folder: str) -> DataFrame:
    """Writes each document (name, line, raw_text, terms, predicates) as a file of its own; gives the files' names. Runs when the result is read."""
    at = local_path(folder)
    os.makedirs(at, exist_ok=True)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            names = []
            for r in b.to_pylist():
                names.append(numbered_name(r["name"], r["line"]))
                tmp = os.path.join(at, f"_{os.getpid()}-{names[-1]}")
                with open(tmp, "w", encoding="utf-8") as f:
                    f.write(naf_text(r["raw_text"], r["terms"], r["predicates"]))
                os.replace(tmp, os.path.join(at, names[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    return docs.select("name", "line", "raw_text", "terms", "predicates").mapInArrow(run, "file string")


def read_relationships(spark: SparkSession, path: str) -> DataFrame:
    """image_id, relationships of a JSON array of images, plain or gzip; image_id is the place in the array."""
    s = "relationships ARRAY<STRUCT<predicate:STRING,synsets:ARRAY<STRING>,object:STRUCT<synsets:ARRAY<STRING>>,subject:STRUCT<synsets:ARRAY<STRING>>>>"
    # The array is read element by element, so the file needn't fit in memory; one array is one task's, whatever its size.
    images = spark.read.schema(s).option("multiLine", "true").json(path).withColumn("path", F.col("_metadata.file_path")).withColumn("at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("path").orderBy("at")) - 1
    return images.select(place.cast("bigint").alias("image_id"), "relationships")


__all__ = ["DOC", "naf_text", "numbered_name", "read_naf", "read_relationships", "write_naf"]
