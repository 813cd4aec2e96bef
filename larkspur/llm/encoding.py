"""Problem 8: the whole corpus as token ids of a public byte-level BPE tokenizer, encoding shared chunks once.

Texts are cut into chunks where a rolling hash of the last characters has a given form, so equal passages give equal chunks wherever they stand. Distinct
chunks are encoded once; every text is then put together from its chunks' ids. A chunk's ids are right except near its ends, because the tokenizer splits text by
a pattern that looks some characters ahead; so at each join the end of the left chunk that might depend on what follows is split and encoded again together with
the right chunk, until a piece begins where one of the right chunk's own pieces does. From there both agree to the end of the chunk: the pattern looks at nothing
before the place where it starts. The result is exactly that of encoding each text whole.

Chunks travel once, as distinct texts; occurrences are (key, order, 128 bits of hash). A chunk that a third of all texts hold is combined on the map side, and the rows that
hold it are split by Spark's skew join (adaptive execution), which keeps the chunk's side small.

Defined cases: null and empty texts have an empty list; strings that look like special tokens are ordinary text; rows equal in key and text give one row; texts are encoded whole,
however long; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the tokenizers' files are on every node, and the vocabulary used.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which this tokenizer splits text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: How far the pattern looks from the start of a piece, at most, before the piece ends inside a text.
LOOK = 3
#: Characters of the rolling hash, bits that are zero at a cut (chunks have 2**BITS characters on average), least and most characters of a chunk.
WINDOW, BITS, LEAST, MOST = 12, 7, 32, 1024
#: Pieces whose ids a task holds.
HELD = 200_000


class Encoder:
    """Ids of pieces, by ranks; one per task."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.split = regex.compile(PATTERN).finditer
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.wide = "<u2" if len(ranks) <= 1 << 16 else "<u4"
        self.known: dict[str, list[int]] = {}

    def piece(self, s: str) -> list[int]:
        ids = self.known.get(s)
        if ids is None:
            if len(self.known) >= HELD:
                self.known.clear()
            ids = self.known[s] = self.bpe._encode_single_piece(s.encode())
        return ids

    def chunk(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """(starts of the pieces, number of ids before each piece, ids)."""
        starts, before, ids = [], [], []
        for m in self.split(text):
            starts.append(m.start())
            before.append(len(ids))
            ids += self.piece(m[0])
        return starts, before, ids


def cuts(text: str) -> list[int]:
    """The ends of a text's chunks."""
    import numpy as np

    n = len(text)
    if n <= LEAST:
        return [n]
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):  # h[i] = sum of c[i-k] * 31**k: depends on the last WINDOW characters only
        h[k:] += c[: n - k] * np.uint64(31**k)
    h ^= h >> np.uint64(29)
    out, last = [], 0
    for i in (np.flatnonzero((h >> np.uint64(20)) & np.uint64((1 << BITS) - 1) == 0) + 1).tolist():
        while i - last > MOST:
            last += MOST
            out.append(last)
        if i - last >= LEAST and n - i >= 1:
            out.append(i)
            last = i
    while n - last > MOST:
        last += MOST
        out.append(last)
    return [*out, n]


def chunked(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, t, ord, chunk): the chunks of every text in order; an empty one for null and empty texts. t tells texts of one key apart."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            at, order, chunks = [], [], []
            for i, x in enumerate(b.column(2).to_pylist()):
                last = 0
                for k, e in enumerate(cuts(x) if x else [0]):
                    at.append(i)
                    order.append(k)
                    chunks.append(x[last:e] if x else "")
                    last = e
            rows = pa.array(at, pa.int64())
            out = pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(order, pa.int32()), pa.array(chunks, pa.string())], names=["key", "t", "ord", "chunk"])
            for k in range(0, out.num_rows, 20_000):
                yield out.slice(k, 20_000)

    d = df.select(F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("t"), F.col(f"`{text}`").alias("text"))
    return d.mapInArrow(run, f"key {d.schema['key'].dataType.simpleString()}, t bigint, ord int, chunk string")


def packed(values: list[int], wide: str) -> bytes:
    import numpy as np

    return np.array(values, wide).tobytes()


def unpacked(data: bytes, wide: str) -> list[int]:
    import numpy as np

    return np.frombuffer(data, wide).tolist()


def encoded_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """chunk and, packed, starts, before and ids of distinct chunks. Places in a chunk have two bytes (MOST is less), ids two or four. The chunk itself needn't travel on: its ids say it."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        e = Encoder(path)
        for b in batches:
            found = [e.chunk(x) for x in b.column(0).to_pylist()]
            columns = [pa.array([packed(f[k], "<u2" if k < 2 else e.wide) for f in found], pa.binary()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["chunk", "starts", "before", "ids"])

    return chunks.select("chunk").distinct().mapInArrow(run, "chunk string, starts binary, before binary, ids binary")


def joined(e: Encoder, parts: list[tuple[str, list[int], list[int], list[int]]]) -> list[int]:
    """The ids of a text from its chunks (chunk, starts, before, ids)."""
    out: list[int] = []
    carry = ""  # the end of what came before, from the first piece that may depend on what follows
    for chunk, starts, before, ids in parts:
        if not chunk:
            continue
        here = dict(zip(starts, range(len(starts)), strict=True))
        n, size, s = len(carry), len(chunk), carry + chunk
        sync, redone = 0 if not n else None, []
        if n:
            for m in e.split(s):
                # What was split again up to here must be sure too, else a very short chunk is split again as a whole.
                if m.start() - n in here and (not redone or redone[-1].start() + LOOK <= len(s)):
                    sync = here[m.start() - n]
                    break
                redone.append(m)
        if sync is None:
            # The whole chunk was split again: all pieces but the unsure last ones count.
            k = len(redone)
            while k and not (redone[k - 1].start() + LOOK <= len(s) and redone[k - 1].end() < len(s)):
                k -= 1
            for m in redone[:k]:
                out += e.piece(m[0])
            carry = s[redone[k].start() :] if k < len(redone) else ""
            continue
        for m in redone:
            out += e.piece(m[0])
        k, ends = len(starts), [*starts[1:], size]
        while k > sync and not (starts[k - 1] + LOOK <= size and ends[k - 1] < size):
            k -= 1
        out += ids[before[sync] : before[k] if k < len(starts) else len(ids)]
        carry = chunk[starts[k] :] if k < len(starts) else ""
    for m in e.split(carry):
        out += e.piece(m[0])
    return out


def encode(df: DataFrame, key: str, text: str, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """key and ids of every text."""
    both = [F.xxhash64(F.lit(1), F.col("chunk")).alias("h1"), F.xxhash64(F.lit(2), F.col("chunk")).alias("h2")]
    chunks = chunked(df, key, text)
    dictionary = encoded_chunks(chunks, path).select(*both, "starts", "before", "ids")
    rows = chunks.select("key", "t", "ord", *both).join(dictionary, ["h1", "h2"]).select("key", "t", "ord", "starts", "before", "ids")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        e, now, parts, keys, out = Encoder(path), None, [], [], []

        def flush() -> pa.RecordBatch:
            r = pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(out, pa.list_(pa.int32()))], names=["key", "ids"])
            keys.clear()
            out.clear()
            return r

        kind = held = None
        for b in batches:
            kind = b.schema.field(0).type
            for k, t, o, starts, before, ids in zip(*[b.column(i).to_pylist() for i in range(6)], strict=True):
                if (k, t) != now:
                    if parts:
                        keys.append(now[0])
                        out.append(joined(e, parts))
                    now, parts, held = (k, t), [], -1
                if o != held:  # rows equal in key and text
                    ids = unpacked(ids, e.wide)
                    parts.append((e.bpe.decode_bytes(ids).decode(), unpacked(starts, "<u2"), unpacked(before, "<u2"), ids))
                    held = o
                if len(out) >= 2000:
                    yield flush()
        if parts:
            keys.append(now[0])
            out.append(joined(e, parts))
        if out:
            yield flush()

    kind = rows.schema["key"].dataType.simpleString()
    return rows.repartition("key", "t").sortWithinPartitions("key", "t", "ord").mapInArrow(run, f"key {kind}, ids array<int>")
