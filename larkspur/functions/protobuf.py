"""The wire form of training examples, and the frames of record files.

An Example is a map of named features; a feature is a list of byte strings, floats or integers. Column functions of Spark can't write bytes of varying length
into each other, so batches are encoded in Arrow UDFs.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, LongType, MapType, StringType, StructType

# Field numbers of a feature's kinds, the polynomial (reversed) and the mask of the checksum.
BYTES, FLOATS, INTS = 1, 2, 3
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8

FEATURES = MapType(StringType(), StructType().add("bytes", ArrayType(BinaryType())).add("floats", ArrayType(FloatType())).add("ints", ArrayType(LongType())))


def varint(n: int) -> bytes:
    n &= 0xFFFFFFFFFFFFFFFF
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number: int, body: bytes) -> bytes:
    """A length-delimited field."""
    return varint(number << 3 | 2) + varint(len(body)) + body


def feature(kind: int, values) -> bytes:
    """A feature; an empty list leaves its values out but not the list."""
    if kind == BYTES:
        inner = b"".join(field(1, bytes(v)) for v in values)
    elif kind == FLOATS:
        inner = field(1, struct.pack(f"<{len(values)}f", *values)) if len(values) else b""
    else:
        packed = b"".join(varint(int(v)) for v in values)
        inner = field(1, packed) if packed else b""
    return field(kind, inner)


def features(named: dict[str, tuple[int, list]]) -> bytes:
    return b"".join(field(1, field(1, k.encode()) + field(2, feature(*v))) for k, v in named.items())


def example(named: dict[str, tuple[int, list]]) -> bytes:
    """An Example with features in the given order."""
    return field(1, features(named))


def sequence_example(context: dict[str, tuple[int, list]], lists: dict[str, list[tuple[int, list]]]) -> bytes:
    """A SequenceExample: context features, and for each name a list of features, one a step."""
    steps = b"".join(field(1, field(1, k.encode()) + field(2, b"".join(field(1, feature(*v)) for v in vs))) for k, vs in lists.items())
    return (field(1, features(context)) if context else b"") + (field(2, steps) if lists else b"")


def fields(data: bytes) -> Iterator[tuple[int, int, bytes | int]]:
    """(number, wire kind, value) of a message's fields."""
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return n

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, kind, number()
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, kind, data[at : at + size]
            at += size
        elif kind == 2:
            size = number()
            yield tag >> 3, kind, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire kind {kind}")


def read_feature(data: bytes) -> dict:
    out: dict = {"bytes": None, "floats": None, "ints": None}
    for number, _, body in fields(data):
        if number == BYTES:
            out["bytes"] = [b for _, _, b in fields(body)]
        elif number == FLOATS:
            out["floats"] = [x for _, _, b in fields(body) for x in struct.unpack(f"<{len(b) // 4}f", b)]
        elif number == INTS:
            ints: list[int] = []
            for _, kind, b in fields(body):
                values = [b] if kind == 0 else []
                n = shift = 0
                for x in b if kind == 2 else b"":
                    n |= (x & 0x7F) << shift
                    shift += 7
                    if x < 0x80:
                        values.append(n)
                        n = shift = 0
                ints += [v - 2**64 if v >= 2**63 else v for v in values]
            out["ints"] = ints
    return out


def _named(data: bytes, read) -> dict:
    out = {}
    for _, _, entry in fields(data):
        pair = {n: b for n, _, b in fields(entry)}
        out[pair.get(1, b"").decode()] = read(pair.get(2, b""))
    return out


def read_example(data: bytes) -> dict[str, dict]:
    """The features of an Example; of several run together the last value of a name counts."""
    return {k: v for n, _, body in fields(data) if n == 1 for k, v in _named(body, read_feature).items()}


def read_sequence_example(data: bytes) -> tuple[dict, dict]:
    """(context, lists) of a SequenceExample."""
    context, lists = {}, {}
    for n, _, body in fields(data):
        if n == 1:
            context |= _named(body, read_feature)
        elif n == 2:
            lists |= _named(body, lambda b: [read_feature(x) for _, _, x in fields(b)])
    return context, lists


def _table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ POLYNOMIAL * (n & 1)
        out.append(n)
    return out


TABLE = np.array(_table(), np.uint32)
#: Bytes that are summed side by side in blocks of a long record, and the columns of records taken at once.
BLOCK = 64


@functools.cache
def _behind(n: int) -> np.ndarray:
    """What n zero bytes make of a checksum, for each value of each of its four bytes [byte, value]."""
    c = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(n):
        c = TABLE[c & np.uint32(0xFF)] ^ c >> np.uint32(8)
    return c


def _columns(rows: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The checksums c, each carried on over its row of bytes."""
    for k in range(rows.shape[1]):
        c = TABLE[(c ^ rows[:, k]) & np.uint32(0xFF)] ^ c >> np.uint32(8)
    return c


def crc32c(data: bytes) -> int:
    """The checksum of one record: blocks are summed side by side, then put together by what the blocks behind them make of them."""
    whole = len(data) - len(data) % BLOCK
    c = 0xFFFFFFFF
    if whole:
        sums = _columns(np.frombuffer(data, np.uint8, whole).reshape(-1, BLOCK), np.zeros(whole // BLOCK, np.uint32))
        t = _behind(BLOCK).tolist()
        for s in sums.tolist():
            c = int(t[0][c & 0xFF] ^ t[1][c >> 8 & 0xFF] ^ t[2][c >> 16 & 0xFF] ^ t[3][c >> 24]) ^ s
    table = _table_list()
    for b in data[whole:]:
        c = table[(c ^ b) & 0xFF] ^ c >> 8
    return c ^ 0xFFFFFFFF


@functools.cache
def _table_list() -> list[int]:
    return TABLE.tolist()


def crc32c_many(records: list[bytes]) -> np.ndarray:
    """The checksums of records, in batches of arrays: those of like length go on together, byte column by byte column; long ones on their own."""
    sizes = np.array([len(r) for r in records], np.int64)
    out = np.zeros(len(records), np.uint32)
    order = np.argsort(sizes, kind="stable")
    for at in range(0, len(order), 4096):
        some = order[at : at + 4096]
        if sizes[some[-1]] > 4096:
            out[some] = [crc32c(records[i]) for i in some]
            continue
        wide = int(sizes[some[-1]])
        flat = np.frombuffer(b"".join(records[i].ljust(wide, b"\0") for i in some), np.uint8).reshape(len(some), wide)
        c, begun = np.full(len(some), 0xFFFFFFFF, np.uint32), 0
        for k in range(wide):
            while begun < len(some) and sizes[some[begun]] <= k:  # shorter ones have ended; they stand first
                begun += 1
            c[begun:] = TABLE[(c[begun:] ^ flat[begun:, k]) & np.uint32(0xFF)] ^ c[begun:] >> np.uint32(8)
        out[some] = c ^ np.uint32(0xFFFFFFFF)
    return out


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values (64 bits) one after the other, and the number of bytes of each."""
    v = values.astype(np.int64).view(np.uint64)
    size = np.ones(len(v), np.int64)
    for k in range(1, 10):
        size += v >= np.uint64(1 << 7 * k)
    starts = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        there = size > k
        part = (v[there] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(0x7F)
        out[starts[there] + k] = part | np.where(size[there] > k + 1, np.uint8(0x80), np.uint8(0))
    return out, size


def packed_lists(lists: list) -> list[bytes]:
    """Each list of integers (null: an empty one) as packed varints."""
    n = np.array([0 if x is None else len(x) for x in lists], np.int64)
    flat = np.concatenate([np.asarray(x, np.int64) for x in lists if x is not None and len(x)] or [np.zeros(0, np.int64)])
    data, size = varints(flat)
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])].tolist()
    data = data.tobytes()
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def mask(c: int) -> int:
    """Turned right by 15 bits and moved by the mask."""
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def unmask(m: int) -> int:
    r = (m - MASK) & 0xFFFFFFFF
    return (r << 15 | r >> 17) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    """A record: its length and the length's checksum, the data and theirs."""
    head = struct.pack("<Q", len(data))
    return head + struct.pack("<I", mask(crc32c(head))) + data + struct.pack("<I", mask(crc32c(data)))


def framed(records: list[bytes]) -> list[bytes]:
    """Records in their frames; the checksums of all are made together."""
    heads = [struct.pack("<Q", len(r)) for r in records]
    sums = [mask(c) for c in crc32c_many(heads + records).tolist()]
    return [h + struct.pack("<I", a) + r + struct.pack("<I", b) for h, r, a, b in zip(heads, records, sums[: len(records)], sums[len(records) :], strict=True)]


def frames(data: bytes) -> Iterator[bytes]:
    """The records of a file; a wrong checksum or a cut record is an error."""
    at = 0
    while at < len(data):
        head = data[at : at + 8]
        if len(head) < 8 or at + 12 > len(data):
            raise ValueError("the file ends inside a record")
        (n,), (c,) = struct.unpack("<Q", head), struct.unpack("<I", data[at + 8 : at + 12])
        if unmask(c) != crc32c(head):
            raise ValueError("wrong checksum of a length")
        body = data[at + 12 : at + 12 + n]
        if len(body) < n or at + 16 + n > len(data):
            raise ValueError("the file ends inside a record")
        if unmask(struct.unpack("<I", data[at + 12 + n : at + 16 + n])[0]) != crc32c(body):
            raise ValueError("wrong checksum of a record")
        yield body
        at += 16 + n


@F.pandas_udf(BinaryType())
def term_example(pos: pd.Series, text: pd.Series) -> pd.Series:
    """Example{pos, text} from two columns of id lists; the ids of a batch become bytes at once."""
    named = lambda name, p: field(1, field(1, name) + field(2, field(INTS, field(1, p) if p else b"")))
    return pd.Series([field(1, named(b"pos", p) + named(b"text", t)) for p, t in zip(packed_lists(list(pos)), packed_lists(list(text)), strict=True)], dtype=object)


@F.pandas_udf(LongType())
def masked_crc32c(data: pd.Series) -> pd.Series:
    """The masked checksum of a binary column, null for null."""
    there = data.notna()
    c = crc32c_many([bytes(d) for d in data[there]]).astype(np.uint64)
    masked = ((c >> np.uint64(15) | c << np.uint64(17)) + np.uint64(MASK) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    out = pd.Series([None] * len(data), dtype="Int64")
    out[there.to_numpy()] = masked
    return out


@F.pandas_udf(FEATURES)
def decode_example(data: pd.Series) -> pd.Series:
    """The features of a binary column of Examples, null for null."""
    return pd.Series([None if d is None else read_example(bytes(d)) for d in data], dtype=object)
