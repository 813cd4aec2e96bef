"""Schemas of tweets, annotated documents and terms."""

from __future__ import annotations

ENTITY = "ARRAY<STRUCT<indices:ARRAY<INT>>>"
ENTITIES = f"STRUCT<hashtags:ARRAY<STRUCT<text:STRING,indices:ARRAY<INT>>>,user_mentions:{ENTITY},urls:{ENTITY},media:{ENTITY}>"
TERM = "STRUCT<lemma:STRING,pos:STRING,synset:STRING>"
TERMS = "ARRAY<STRUCT<form:STRING,morphofeat:STRING,refs:ARRAY<STRUCT<resource:STRING,reference:STRING>>>>"
PREDICATES = "ARRAY<STRUCT<framenet:STRING,roles:ARRAY<STRUCT<framenet:STRING,str:STRING>>>>"
DOC = f"doc_id BIGINT, raw_text STRING, terms {TERMS}, predicates {PREDICATES}"

#: Retweet levels below a tweet that are read as types; what is below them stays JSON until it is unwrapped.
DEPTH = 4


def tweet(depth: int = DEPTH) -> str:
    """A tweet as Spark type; user.id as a string, since numbers and strings of digits both count."""
    inner = tweet(depth - 1) if depth else "STRING"
    return f"STRUCT<user:STRUCT<id:STRING>,text:STRING,lang:STRING,entities:{ENTITIES},retweeted_status:{inner}>"
