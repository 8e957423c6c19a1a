"""Byte-level BPE: content-defined chunks are encoded once, and their joins are repaired.

A rolling hash over eight bytes cuts a text into chunks where the hash, and so the content, says:
texts that share a passage share its chunks whatever surrounds it. A task encodes a chunk the
first time it meets it and keeps the ids in a dictionary of bounded size.

Ids of a chunk hold in a document except near its ends, where the words of the neighbours
join. Repair starts from *sync points*: a space between two printable ASCII characters. The
word pattern always starts a new word there, whatever comes before or after, so the ids left of
the last sync point of a chunk and right of the first one of the next agree with those of the
whole text. The text between the two is encoded again; a chunk without a sync point joins that
text as a whole, until the next sync point is found. The result is that of encoding the
whole text at once.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, with_field

#: Words of the vocabulary: fixed by the tokenizer's public definition.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A chunk ends where the top bits of the hash are zero: about every 1,024 bytes.
CHUNK_BITS = 10
HASH = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of chunk text that a task keeps ids of; the longest unused chunk goes first.
CACHE_BYTES = 24 << 20


def _byte_alphabet() -> dict[str, int]:
    """The vocabulary writes a printable byte as itself and the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids and bytes of a byte-level BPE file; the special tokens are cut out of a text first."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i
                 for token, i in spec["model"]["vocab"].items()}
        self.path = path
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])
                        if t["content"] not in spec["model"]["vocab"]}
        self.pieces = [b""] * (1 + max([*ranks.values(), *self.special.values()]))
        for token, i in [*ranks.items(), *self.special.items()]:
            self.pieces[i] = token

    @cached_property
    def engine(self) -> tiktoken.Encoding:
        special = set(self.special.values())
        ranks = {token: i for i, token in enumerate(self.pieces) if token and i not in special}
        return tiktoken.Encoding(self.path, pat_str=PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})

    def encode(self, text: bytes) -> list[int]:
        return self.engine.encode_ordinary(text.decode("utf-8")) if text else []

    def decode(self, ids: np.ndarray) -> str:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def chunk_ends(data: np.ndarray, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks of ``data``, at starts of UTF-8 characters; the last is its length."""
    n = len(data)
    if n < 9:
        return [n]
    windows = np.ndarray(shape=(n - 7,), dtype="<u8", buffer=data, strides=(1,))
    ends = np.flatnonzero(((windows * HASH) >> np.uint64(64 - bits)) == 0) + 8
    while len(ends) and (inside := (ends < n) & ((data[np.minimum(ends, n - 1)] & 0xC0) == 0x80)).any():
        ends = ends + inside
    ends = np.unique(ends)
    return [*ends[ends < n].tolist(), n]


_SYNC = np.zeros(256, dtype=bool)
_SYNC[0x21:0x7F] = True


def sync_ends(data: np.ndarray) -> tuple[int, int] | None:
    """First and last sync point of a chunk; None if it has none."""
    solid = _SYNC[data]
    points = np.flatnonzero((data[1:-1] == 32) & solid[:-2] & solid[2:])
    return (int(points[0]) + 1, int(points[-1]) + 1) if len(points) else None


class Encoder:
    """Encodes texts chunk by chunk; equal chunks are encoded once while the cache holds them."""

    def __init__(self, path: str, bits: int = CHUNK_BITS, cache_bytes: int = CACHE_BYTES) -> None:
        self.vocabulary, self.bits = vocabulary(path), bits
        self.cache: OrderedDict[bytes, tuple | None] = OrderedDict()
        self.free = cache_bytes
        self.encoded_chunks = self.reused_chunks = 0

    def chunk(self, raw: bytes) -> tuple[bytes, np.ndarray, bytes] | None:
        """(text before the first sync point, ids up to the last, text after); None without one."""
        if raw in self.cache:
            self.reused_chunks += 1
            self.cache.move_to_end(raw)
            return self.cache[raw]
        self.encoded_chunks += 1
        found = sync_ends(np.frombuffer(raw, dtype=np.uint8)) if len(raw) > 2 else None
        if found:
            first, last = found
            ids = np.array(self.vocabulary.encode(raw[first:last]), dtype="<u4")
            found = (raw[:first], ids, raw[last:])
        # each byte of text costs itself and at most one id of four bytes
        self.free -= 5 * len(raw)
        self.cache[raw] = found
        while self.free < 0 and len(self.cache) > 1:
            self.free += 5 * len(self.cache.popitem(last=False)[0])
        return found

    def _plain(self, text: bytes) -> list[np.ndarray]:
        data, out, open_text, start = np.frombuffer(text, dtype=np.uint8), [], [], 0
        for end in chunk_ends(data, self.bits):
            raw = text[start:end]
            start = end
            found = self.chunk(raw)
            if found is None:
                open_text.append(raw)
                continue
            head, ids, tail = found
            out.append(np.array(self.vocabulary.encode(b"".join([*open_text, head])), dtype="<u4"))
            out.append(ids)
            open_text = [tail]
        out.append(np.array(self.vocabulary.encode(b"".join(open_text)), dtype="<u4"))
        return out

    def encode(self, text: bytes) -> np.ndarray:
        parts, rest = [], text
        special = self.vocabulary.special
        while rest:
            found = min(((at, s) for s in special if (at := rest.find(s)) >= 0),
                        default=(len(rest), b""))
            if found[0]:
                parts += self._plain(rest[:found[0]])
            if found[1]:
                parts.append(np.array([special[found[1]]], dtype="<u4"))
            rest = rest[found[0] + len(found[1]):]
        return np.concatenate(parts) if parts else np.empty(0, dtype="<u4")


def encode(docs: DataFrame, path: str, packed: bool = False, decoded: str | None = None
           ) -> DataFrame:
    """``docs`` with ``ids`` (array of int) of each whole text, and nothing else changed.

    The ids are those of the vocabulary's own library on the whole text; ``packed`` gives them as
    binary, four bytes each, the lowest first. With ``decoded`` a column of that name holds the text
    that ``decode`` makes of them. Defined cases: a null or empty text has no ids; repeated rows
    are kept; an empty table gives no rows; columns already named so are replaced.
    """
    added = [c for c in ("ids", decoded) if c]
    names = [c for c in docs.columns if c == "text" or c not in added]
    kept = docs.select([F.col(f"`{c}`") for c in names])
    rest = [c for c in names if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            found = [encoder.encode((x.as_py() or b""))
                     for x in batch.column("text").cast(pa.large_binary())]
            if packed:
                ids = pa.array([x.tobytes() for x in found], pa.binary())
            else:
                offsets = np.zeros(len(found) + 1, dtype=np.int32)
                np.cumsum([len(x) for x in found], out=offsets[1:])
                values = np.concatenate(found) if found else np.empty(0, dtype="<u4")
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int32)))
            columns = [*[batch.column(c) for c in rest], ids]
            if decoded:
                columns.append(pa.array([encoder.vocabulary.decode(x) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*rest, *added])

    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    schema = with_field(kept.select([F.col(f"`{c}`") for c in rest]), "ids", kind)
    return kept.mapInArrow(run, schema.add(decoded, T.StringType()) if decoded else schema)


def decode(encoded: DataFrame, path: str, name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ``ids``, packed or not; special tokens are written out,
    null ids are an empty text."""
    names = encoded.columns

    def numbers(ids: pa.Scalar) -> np.ndarray:
        if pa.types.is_binary(ids.type) or pa.types.is_large_binary(ids.type):
            return np.frombuffer(ids.as_py(), dtype="<u4")
        return ids.values.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [words.decode(numbers(x)) if x.is_valid else "" for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*names, name])

    return encoded.mapInArrow(run, with_field(encoded, name, T.StringType()))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding each whole text."""
    both = encode(documents(docs), path, packed=True, decoded="decoded")
    return both.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
