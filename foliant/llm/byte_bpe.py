"""Byte-level BPE through sentencepiece.

A sentencepiece BPE model is serialised directly from the vocabulary of ranks: every token's bytes are mapped to
printable characters (the usual byte-level mapping), the piece's score is its negative rank, its id is the rank,
and the normaliser is the identity. Merging the adjacent pair of the best score is then merging the pair of the
lowest rank. Texts are split into pre-tokens first and each is encoded separately; a pre-token that is itself in
the vocabulary is that token. Decoding maps ids to pieces and pieces back to bytes.
"""
from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import table

CACHED = 48 << 20  #: bytes, about, that each of a worker's two generations of known pre-tokens may hold
ENTRY = 200  #: bytes of a known pre-token beside its characters and ids
LONG = 1024  #: longer pre-tokens aren't kept


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else one from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary. Ids are ranks, which must run from 0 without gaps; the unknown
    piece that sentencepiece demands comes last and is never produced, as all single bytes must be tokens."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    chars, model = byte_characters(), pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece="".join(chars[b] for b in token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type = pb.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ranks), -1, -1, -1
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix, norm.remove_extra_whitespaces, norm.escape_whitespaces = "identity", False, False, False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes with a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        chars = byte_characters()
        self.to_chars = {b: ord(c) for b, c in enumerate(chars)}
        back = {c: b for b, c in enumerate(chars)}
        self.pieces = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(self.sp.get_piece_size() - 1)]
        self.whole = {p: array("I", [i]).tobytes() for i, p in enumerate(self.pieces)}
        self.cache: dict[str, bytes] = {}  # the pre-tokens met of late
        self.older: dict[str, bytes] = {}  # those of the generation before
        self.held = 0  # bytes of the cache, about

    def _learn(self, new: list[str]) -> None:
        """Encode pre-tokens not yet known, all in one call."""
        rest, mapped = [], []
        for t in new:
            b = t.encode("utf-8", "surrogatepass")
            if (own := self.whole.get(b)) is not None:
                self.cache[t] = own
            else:
                rest.append(t)
                mapped.append(b.decode("latin-1").translate(self.to_chars))
        if rest:
            for t, ids in zip(rest, self.sp.encode(mapped, num_threads=1), strict=True):
                self.cache[t] = array("I", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        words = self.split(text or "")
        if self.held > CACHED:
            self.cache, self.older, self.held = {}, self.cache, 0
        cache, older, new = self.cache, self.older, []
        for t in dict.fromkeys(words):
            if t not in cache:
                if (ids := older.get(t)) is None:
                    new.append(t)
                else:
                    cache[t] = ids
                    self.held += len(t) + len(ids) + ENTRY
        if new:
            self._learn(new)
            self.held += sum(len(t) + len(cache[t]) + ENTRY for t in new if len(t) <= LONG)
        out = b"".join(map(cache.__getitem__, words))
        for t in new:
            if len(t) > LONG:
                del cache[t]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def _codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


def digest_column(spark: SparkSession, ranks: dict[bytes, int], pattern: str, text: Column) -> Column:
    """A struct (n_tokens, ids_sha256, decoded_sha256) of each text. The model's size is the vocabulary's."""
    model = spark.sparkContext.broadcast(serialise(ranks))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        codec, out = _codec(model.value, pattern), []
        for t in texts:
            ids = codec.encode(t)
            out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(text)


def encode_column(spark: SparkSession, ranks: dict[bytes, int], pattern: str, text: Column) -> Column:
    """The ids of each text as array<int>; a null text has none."""
    model = spark.sparkContext.broadcast(serialise(ranks))

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        codec = _codec(model.value, pattern)
        return texts.map(lambda t: np.frombuffer(codec.encode(t), "<u4").astype(np.int32))

    return encode(text)


def decode_column(spark: SparkSession, ranks: dict[bytes, int], pattern: str, ids: Column) -> Column:
    """The bytes of each array of ids; null for null."""
    model = spark.sparkContext.broadcast(serialise(ranks))

    @F.pandas_udf("binary")
    def decode(rows: pd.Series) -> pd.Series:
        codec = _codec(model.value, pattern)
        return rows.map(lambda x: None if x is None else codec.decode(np.asarray(x, "<u4").tobytes()))

    return decode(ids)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256. A null text counts as empty, and an empty one has no
    ids; repeated rows are each encoded; very long texts are encoded whole, pre-token by pre-token; ties between merges
    go to the lower rank, then to the left; an empty table gives no rows; extra columns, whatever their names, are left
    behind."""
    found = digest_column(docs.sparkSession, ranks, pattern, F.col("text"))
    return docs.select("doc_id", "text").select("doc_id", found.alias("x")).select("doc_id", "x.*")


def _vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; digests() says what odd rows give."""
    return digests(table(spark, sf_dir, "documents"), *_vocabulary())


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the columns of op3 for every document that is left, as digests() gives them for null, empty,
    repeated and very long texts and for an empty table; extra columns are left behind."""
    return digests(docs, *_vocabulary())
