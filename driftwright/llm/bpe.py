"""Byte-level BPE encoding and decoding through a SentencePiece model made from a vocabulary of ranks.

Every byte becomes one printable character, so the byte-level vocabulary is an ordinary SentencePiece BPE
vocabulary: a piece's score is its negative rank, the normaliser is the identity, and merging the best-scored
adjacent pair first is merging the lowest rank first. No tokenizer is trained.

Defined results: a null or empty text has no ids and decodes to nothing; texts of any length are encoded whole;
repeated rows give repeated rows; an empty table gives an empty table. Columns of the input whose names clash
with ``n_tokens``, ``ids_le`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from .common import claim, ship, trimmed
from .words import text_slices

#: Distinct pre-tokens that a worker remembers.
MEMO_SIZE = 50_000

#: White space as the vocabulary's own library reads it: the Unicode property, written out.
WHITE_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is printable Latin-1, else from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def build_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised SentencePiece BPE model whose piece ids are the ranks; the id after the last is <unk>."""
    chars = byte_characters()
    model = model_pb2.ModelProto()
    ordered = sorted(ranks.items(), key=lambda item: item[1])
    if [rank for _, rank in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    for token, rank in ordered:
        model.pieces.add(piece="".join(chars[b] for b in token), score=-float(rank))
    unknown = model_pb2.ModelProto.SentencePiece.UNKNOWN
    model.pieces.add(piece="<unk>", score=0.0, type=unknown)
    spec = model.trainer_spec
    spec.model_type = model_pb2.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(ordered), -1, -1, -1
    norm = model.normalizer_spec
    norm.name, norm.add_dummy_prefix = "identity", False
    norm.remove_extra_whitespaces, norm.escape_whitespaces = False, False
    return model.SerializeToString()


def portable_pattern(pattern: str) -> str:
    """The pre-token pattern with white space written out, so that ``regex`` splits as the original library."""
    outside = pattern.replace(r"[^\s", "[^" + WHITE_SPACE)
    return outside.replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]")


class Codec:
    """Encodes and decodes texts by a serialised model; one per Python worker."""

    def __init__(self, model: bytes, pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        chars = byte_characters()
        self._to_chars = {b: c for b, c in enumerate(chars)}
        back = {c: b for b, c in enumerate(chars)}
        size = self.model.get_piece_size() - 1
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.pieces = [bytes(back[c] for c in name) for name in names]
        self._whole = {name: i for i, name in enumerate(names)}
        self._split = regex.compile(portable_pattern(pattern)).findall
        self._memo: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens: a whole vocabulary entry as it is, the others merged by the model, in one batch."""
        mapped = [p.encode("utf-8", "replace").decode("latin-1").translate(self._to_chars) for p in pieces]
        merged = [m for m in mapped if m not in self._whole]
        ids = dict(zip(merged, self.model.encode(merged, num_threads=1), strict=True)) if merged else {}
        return {p: np.asarray([self._whole[m]] if m in self._whole else ids[m], "<u4").tobytes() for p, m in zip(pieces, mapped, strict=True)}

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        pieces = self._split(text)
        missing = set(pieces).difference(self._memo)
        if missing:
            if len(self._memo) > MEMO_SIZE:  # only a memo: emptying it changes no result
                self._memo.clear()
                missing = set(pieces)
            self._memo.update(self._learn(list(missing)))
        return b"".join(map(self._memo.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[int, str], Codec] = {}


def codec(model: bytes, pattern: str) -> Codec:
    key = (hash(model), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, pattern)
    return _codecs[key]


OUTPUTS = {"n_tokens": (T.LongType(), pa.int64()), "ids_le": (T.BinaryType(), pa.binary()), "decoded": (T.BinaryType(), pa.binary())}


def encode_decode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Append ``n_tokens``, ``ids_le`` (packed ids) and ``decoded`` (the bytes that the ids decode to).

    vocabulary: file of base64 tokens and ranks, read on the driver (tens of thousands of entries, so the model
    that goes to the workers has a fixed size). Each document is encoded by itself: no shuffle, no skew.
    """
    ship(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(build_model(read_ranks(vocabulary)))
    kept = [f for f in df.schema.fields if f.name not in OUTPUTS]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, (kind, _) in OUTPUTS.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bpe", _codecs.clear)
        own = codec(model.value, pattern)
        for part in text_slices(batches, text_col):
            ids = [own.encode(x or "") for x in part.column(text_col).to_pylist()]
            made = {"n_tokens": [len(x) // 4 for x in ids], "ids_le": ids, "decoded": [own.decode(x) for x in ids]}
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array(made[n], kind) for n, (_, kind) in OUTPUTS.items()],
                names=[*names, *OUTPUTS],
            )

    return df.mapInArrow(trimmed(run), schema)
