"""Byte-level BPE encoding and decoding by a sentencepiece model that is serialised from a vocabulary of ranks.

Each token's bytes are mapped to printable characters (one for each byte), and its piece is scored by its negative rank, so
sentencepiece merges in the order of the ranks; normalisation is the identity. Pre-tokens are encoded one by one (and remembered);
decoding maps ids back to bytes.

Defined results: a null text is the empty text, which has no tokens; repeated rows are encoded alike; very long pre-tokens are whole;
an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import documents, text_of, trim

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED = 100_000  # pre-tokens a worker keeps before it starts afresh; of those over LONG characters none
LONG = 64
ROWS = 256  # texts whose ids and bytes a worker holds at once


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {}, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return [out[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank; ranks have no gaps."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialised(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: piece i is token i, and the unknown piece comes last."""
    to = byte_characters()
    pieces = [_field(1, "".join(to[b] for b in t).encode()) + _field(2, -float(i)) + _field(3, 1) for i, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    off = (1 << 64) - 1  # -1: no such id
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(24, 0) + _field(40, len(tokens)) + _field(41, off) + _field(42, off) + _field(43, off)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes with a serialised model; ids are ranks."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.to = byte_characters()
        self.table = {i: c for i, c in enumerate(self.to)}
        back = {ord(c): b for b, c in enumerate(self.to)}
        self.bytes_of = [bytes(back[ord(c)] for c in self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size() - 1)]
        self.known: dict[str, bytes] = {}

    def mapped(self, pretoken: str) -> str:
        return pretoken.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.table)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts, known = self.split(text), self.known
        new = [p for p in dict.fromkeys(parts) if p not in known]
        if new:
            if len(known) + len(new) > REMEMBERED:
                self.known = known = {}
                new = list(dict.fromkeys(parts))
            ids = self.pieces.encode([self.mapped(p) for p in new], num_threads=1)
            known.update(zip(new, [struct.pack(f"<{len(x)}I", *x) for x in ids], strict=True))
        out = b"".join([known[p] for p in parts])
        for p in new:
            if len(p) > LONG:
                del known[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in memoryview(ids).cast("I")])


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text") -> DataFrame:
    """docs with __ids (binary: little-endian unsigned 32-bit ids) and __decoded (binary). The vocabulary is read once, by the driver."""
    import public_tokenizers

    model = serialised(read_ranks(path or public_tokenizers.path(VOCABULARY)))
    pattern = pattern or public_tokenizers.PATTERN
    model = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary: 1 MB
    made: dict[str, Codec] = {}

    def codec() -> Codec:
        if "codec" not in made:
            made["codec"] = Codec(model.value, pattern)
        return made["codec"]

    @F.pandas_udf("struct<ids:binary,decoded:binary>")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec()
        try:
            for texts in batches:
                for b in range(0, len(texts), ROWS):
                    ids = [c.encode(t) for t in texts.iloc[b : b + ROWS]]
                    yield pd.DataFrame({"ids": ids, "decoded": [c.decode(x) for x in ids]})
        finally:
            trim()

    x = docs.withColumn("__both", both(text_of(text)))
    return x.withColumns({"__ids": F.col("__both.ids"), "__decoded": F.col("__both.decoded")}).drop("__both")


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256."""
    x = encoded(docs, text=text)
    n = (F.octet_length("__ids") / 4).cast("long")
    return x.withColumns({"n_tokens": n, "ids_sha256": F.sha2("__ids", 256), "decoded_sha256": F.sha2("__decoded", 256)}).drop("__ids", "__decoded")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


