"""Byte-level BPE encoding and decoding with a SentencePiece model written from a rank vocabulary.

The model is serialised, never trained: each token's bytes become the printable characters of the usual byte
map, its score is minus its rank (so the pair of lowest rank merges first), and normalisation is the identity.
Pre-tokens are encoded one by one; ids are the ranks.  Decoding joins the bytes of the ids.

Null texts count as empty, empty texts have no ids; rows, repeated ones too, are kept one for one.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from codecs import charmap_decode
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import PIECE, byte_column, pieces, widened

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: White space as Unicode has it; a bare \s of the regex library also takes U+001C to U+001F.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A private-use character; never part of a mapped byte.
UNKNOWN = "\ue000"
#: Distinct pre-tokens a task remembers.
MEMO = 200_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def rust_pattern(pattern: str) -> str:
    """The pattern with white space as the Unicode property, inside and outside of character classes."""
    return pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"(?!\S)", f"(?![^{_WHITE}])").replace(r"\s", f"[{_WHITE}]")


def latin_pattern(pattern: str) -> str:
    """The same matches in texts of U+0000 to U+00FF for the standard library, which is faster but knows no \\p classes."""
    members = lambda kind: "".join(re.escape(c) for c in map(chr, range(256)) if unicodedata.category(c)[0] == kind)
    letters, numbers = members("L"), members("N")
    inside = r"[^\s\p{L}\p{N}]"
    out = pattern.replace(inside, f"[^\\t-\\r \\x85\\xa0{letters}{numbers}]")
    return out.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\S", r"[^\t-\r \x85\xa0]").replace(r"\s", r"[\t-\r \x85\xa0]")


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A serialised SentencePiece BPE model: piece 0 is the unknown piece, piece i + 1 the i-th token by rank."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    chars = byte_characters()
    m = pb.ModelProto()
    t = m.trainer_spec
    t.model_type, t.vocab_size, t.hard_vocab_limit = pb.TrainerSpec.BPE, len(ranks) + 1, False
    t.unk_id, t.bos_id, t.eos_id, t.pad_id, t.byte_fallback, t.unk_piece = 0, -1, -1, -1, False, UNKNOWN
    n = m.normalizer_spec
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces = "identity", False, False, False
    m.pieces.add(piece=UNKNOWN, score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        m.pieces.add(piece="".join(chars[b] for b in token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    return m.SerializeToString()


class Decoder:
    """Bytes of id sequences."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def decode(self, ids: bytes) -> bytes:
        out = []
        for at in range(0, len(ids), PIECE):
            i = np.frombuffer(ids[at:at + PIECE], "<u4")
            n = self.length[i]
            out.append(self.blob[np.repeat(self.start[i] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes())
        return b"".join(out)


class Encoder:
    """Ids of texts; those of a distinct pre-token are found once and remembered."""

    def __init__(self, proto: bytes, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.ranks = ranks
        self.rank_of_piece = np.array([-1, *sorted(ranks.values())], np.int64)
        self.split_any = regex.compile(rust_pattern(pattern)).findall
        self.split_latin = re.compile(latin_pattern(pattern)).findall
        self.table = "".join(byte_characters())
        self.memo: dict[str, bytes] = {}

    def _ids(self, tokens: list[str]) -> list[bytes]:
        """The ids of each pre-token."""
        known, out, rest = self.ranks.get, [], []
        for t in tokens:
            b = t.encode()
            r = known(b)
            if r is None:
                rest.append(charmap_decode(b, "strict", self.table)[0])
            # a whole pre-token in the vocabulary is one id, whether or not merges lead to it
            out.append(None if r is None else r.to_bytes(4, "little"))
        if rest:
            ids = self.model.encode(rest, num_threads=1)
            flat = self.rank_of_piece[np.fromiter(chain.from_iterable(ids), np.int64)].astype("<u4").tobytes()
            end, more = 0, []
            for x in ids:
                more.append(flat[end:(end := end + 4 * len(x))])
            it = iter(more)
            out = [next(it) if x is None else x for x in out]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        tokens = [(self.split_latin if is_latin(t) else self.split_any)(t) if t else [] for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list(set(chain.from_iterable(tokens)).difference(self.memo))
        self.memo.update(zip(new, self._ids(new), strict=True))
        return [b"".join(map(self.memo.__getitem__, t)) for t in tokens]


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the column ``ids`` (binary, little-endian unsigned 32-bit) and, if named, the bytes decoded from them.

    Both names replace columns of the same name.  One pass over the rows, no shuffle; the vocabulary (a file of
    fixed size) is broadcast.
    """
    ranks = load_ranks(vocabulary)
    shared = df.sparkSession.sparkContext.broadcast((model_proto(ranks), ranks))
    names = [ids] + ([decoded] if decoded else [])
    kept = df.drop(*names)
    schema = widened(kept, *((n, "binary") for n in names))

    def run(batches):
        encoder, decoder = Encoder(*shared.value, pattern), Decoder(shared.value[1])
        for b in batches:
            for i, j in pieces(byte_column(b.column(text))[1]):
                part = b.slice(i, j - i)
                coded = encoder.encode(part.column(text).to_pylist())
                cols = [*part.columns, pa.array(coded, pa.binary())]
                if decoded:
                    cols.append(pa.array([decoder.decode(x) for x in coded], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, *names])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the column ``decoded`` (binary) from the ids; null ids give empty bytes."""
    shared = df.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    kept = df.drop(decoded)

    def run(batches):
        decoder = Decoder(shared.value)
        for b in batches:
            out = [decoder.decode(x or b"") for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, decoded])

    return kept.mapInArrow(run, widened(kept, (decoded, "binary")))


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    out = encode(docs.select("doc_id", "text"), vocabulary, pattern, ids="ids", decoded="decoded")
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
