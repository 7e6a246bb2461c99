"""Byte-level BPE through a sentencepiece model written from the rank file.

The vocabulary's ranks become a sentencepiece BPE model directly, without
training: byte ``b`` is written as the character ``chr(256 + b)`` (so a piece
is a string without spaces), a piece's score is its negative rank, and the
normaliser is the identity. A text is cut into pre-tokens by the vocabulary's
pattern; each pre-token is encoded by itself. Decoding maps ids to pieces and
their characters back to bytes.

The rank file is read once on the driver; the serialised model (about 1 MB,
fixed by the vocabulary) is broadcast. Each Python worker keeps a bounded memo
of pre-tokens.

Defined cases: NULL text is empty; an empty text has no ids and the digest of
no bytes; rows are independent, so repeated rows, NULL ids and empty tables
need no rule; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cargoframe.llm.common import Memo, arrow_map, held

_TO_CHARS = {b: chr(256 + b) for b in range(256)}
_MEMO = 300_000  # pre-tokens in each half of a worker's memo


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def to_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARS)


def to_bytes(piece: str) -> bytes:
    return bytes(ord(c) - 256 for c in piece)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece BPE model; piece ``i`` (from 1) is the piece
    of the ``i``-th smallest rank."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type = pb.TrainerSpec.BPE
    m.trainer_spec.vocab_size = len(ranks) + 1
    m.trainer_spec.unk_id, m.trainer_spec.bos_id, m.trainer_spec.eos_id, m.trainer_spec.pad_id = 0, -1, -1, -1
    m.trainer_spec.unk_piece = ""  # outside the byte alphabet
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.add_dummy_prefix = False
    m.normalizer_spec.remove_extra_whitespaces = False
    m.normalizer_spec.escape_whitespaces = False
    m.pieces.add(piece=m.trainer_spec.unk_piece, score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    for data, rank in sorted(ranks.items(), key=lambda x: x[1]):
        m.pieces.add(piece=to_chars(data), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    return m.SerializeToString()


class Codec:
    """Encoder and decoder over one serialised model."""

    def __init__(self, model: bytes, rank_of: np.ndarray, pattern: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank_of = rank_of  # by piece id; [0] is the unknown piece
        self.pattern = regex.compile(pattern)
        self.bytes_of = {int(r): to_bytes(self.sp.id_to_piece(i)) for i, r in enumerate(rank_of) if i}
        self.whole = {d.decode("utf-8", "replace"): np.uint32(r).tobytes() for r, d in self.bytes_of.items()
                      if d.decode("utf-8", "replace").encode() == d}
        self.memo = Memo(self._fresh, _MEMO)

    def _fresh(self, token: str) -> bytes:
        got = self.whole.get(token)  # a pre-token that is itself a piece
        if got is None:
            got = self.rank_of[self.sp.encode(to_chars(token.encode()))].astype("<u4").tobytes()
        return got

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _worker_codec(model: bytes, rank_of: np.ndarray, pattern: str) -> Codec:
    return held(("byte_bpe", hash(model), pattern), lambda: Codec(model, rank_of, pattern))


def model_parts(ranks_path: str) -> tuple[bytes, np.ndarray]:
    ranks = read_ranks(ranks_path)
    return sentencepiece_model(ranks), np.array([0, *sorted(ranks.values())], np.int64)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids binary, decoded binary, n_tokens) of every row."""
    return _map(docs, ranks_path, pattern, id_col, text_col, f"{id_col} long, n_tokens long, ids binary, decoded binary",
                lambda ids, back: (ids, back), ("ids", "decoded"))


def encoding_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of every row."""
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return _map(docs, ranks_path, pattern, id_col, text_col, f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                lambda ids, back: (sha(ids), sha(back)), ("ids_sha256", "decoded_sha256"))


def _map(docs, ranks_path, pattern, id_col, text_col, schema, view, names) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model_parts(ranks_path))

    def run(cols: dict[str, pa.Array]) -> dict:
        codec = _worker_codec(*sent.value, pattern)
        n, first, second = [], [], []
        for text in cols["t"]:
            ids = codec.encode(text.as_py() or "")
            a, b = view(ids, codec.decode(ids))
            n.append(len(ids) // 4)
            first.append(a)
            second.append(b)
        return {id_col: cols["i"], "n_tokens": n, names[0]: first, names[1]: second}

    return arrow_map(docs.selectExpr(f"cast({id_col} as long) as i", f"{text_col} as t"), run, schema)
