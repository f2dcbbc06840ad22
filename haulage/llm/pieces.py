"""SentencePiece models run by the tokenizers library.

A model file is a protocol buffer: pieces with scores and kinds, the training settings that matter for encoding, and the
normaliser. From these a tokenizers pipeline is rebuilt: normaliser, word marker, BPE merges or unigram scores, byte
fallback and decoder. Encoding gives the ids that the sentencepiece library gives; ``parity`` shows it for any texts.

Supported: unigram and BPE models with normal, unknown, control and byte pieces, the word marker in front of words. A model
with user-defined or unused pieces, or with the marker behind words, is refused with a ValueError.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from haulage.llm.base import id_back, id_text, in_slices, query, table, whole_text
from haulage.llm.words import UnitIds, kept_with

MARKER = "▁"
#: Kinds of pieces in the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Model types in the model file (fixed values of the format).
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def fields_of(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at:at + size], at + size
        else:
            raise ValueError("not a sentencepiece model")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> Model:
    """The parts of a model file that encoding and decoding need; absent fields have the format's defaults."""
    model = Model()
    for number, value in fields_of(data):
        if number == 1:
            piece = dict(fields_of(value))
            model.pieces.append(piece[1].decode())
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(fields_of(value))
            model.model_type = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            if trainer.get(24, 0):
                raise ValueError("a marker behind words is not supported")
        elif number == 3:
            normal = dict(fields_of(value))
            model.charsmap = normal.get(2, b"")
            model.add_prefix, model.squeeze, model.escape = bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(normal.get(5, 1))
    if model.model_type not in (UNIGRAM, BPE) or {USER_DEFINED, UNUSED} & set(model.kinds):
        raise ValueError("this kind of sentencepiece model is not supported")
    return model


def merges_of(model: Model) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best scored result first."""
    known = {p for p, k in zip(model.pieces, model.kinds) if k == NORMAL}
    ranked = sorted((-s, i) for i, (s, k) in enumerate(zip(model.scores, model.kinds)) if k == NORMAL)
    return [(p[:cut], p[cut:]) for p in (model.pieces[i] for _, i in ranked) for cut in range(1, len(p)) if p[:cut] in known and p[cut:] in known]


class Pieces:
    """Encoder and decoder of one model; ``tokenizer`` is the whole pipeline, the rest is the faster way through units."""

    def __init__(self, path: str):
        import tokenizers
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        with open(path, "rb") as file:
            self.model = model = parse(file.read())
        unknown = model.kinds.index(UNKNOWN)
        if model.model_type == BPE:
            core = models.BPE({p: i for i, p in enumerate(model.pieces)}, merges_of(model), unk_token=model.pieces[unknown], fuse_unk=True, byte_fallback=model.byte_fallback)
        else:  # control and byte pieces must not be found in texts, so they score too low to be chosen
            core = models.Unigram([(p, s if k == NORMAL else -1e9) for p, s, k in zip(model.pieces, model.scores, model.kinds)], unk_id=unknown, byte_fallback=model.byte_fallback)
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if model.add_prefix:
            steps.append(normalizers.Prepend(MARKER if model.escape else " "))
        if model.escape:
            steps.append(normalizers.Replace(" ", MARKER))
        self.tokenizer, self.bare = Tokenizer(core), Tokenizer(core)
        if steps:
            self.tokenizer.normalizer = normalizers.Sequence(steps)
        ends = [decoders.Strip(" ", 1, 0)] if model.add_prefix else []
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
        normal = [p for p, k in zip(model.pieces, model.kinds) if k == NORMAL]
        by_word = model.escape and not any(a != MARKER and b == MARKER for p in normal for a, b in zip(p, p[1:]))
        by_line = by_word and model.byte_fallback and not any("\n" in p for p in normal)
        self.pattern = re.compile(f"{MARKER}*[^{MARKER}\n]+|{MARKER}+|\n" if by_line else f"{MARKER}*[^{MARKER}]+|{MARKER}+" if by_word else "(?s).+")
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARKER, " ").encode() for p, k in zip(model.pieces, model.kinds)]
        self.units = UnitIds(lambda units: [e.ids for e in self.bare.encode_batch_fast(units, add_special_tokens=False)], "<u2" if len(model.pieces) <= 65_536 else "<u4")

    def normalised(self, text: str) -> str:
        if self.model.charsmap or self.model.squeeze or not self.model.escape:
            return self.tokenizer.normalizer.normalize_str(text) if text and self.tokenizer.normalizer else text
        text = text.replace(" ", MARKER)
        return MARKER + text if self.model.add_prefix and text else text

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The pieces of a unit never reach beyond it, so a text is the ids of its units in a row."""
        found = self.units.join([self.pattern.findall(self.normalised(t)) for t in texts])
        return [np.frombuffer(ids, self.units.dtype) for ids in found]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of ids: the bytes of the pieces in a row, without the marker in front. Where bytes form no text, the
        library's decoder has the say; ``parity`` holds both against sentencepiece."""
        look, out = self.bytes.__getitem__, []
        for text in (b"".join(map(look, i.tolist())).decode("utf-8", "replace") for i in ids):
            out.append(text[1:] if self.model.add_prefix and text[:1] == " " else text)
        for i, text in enumerate(out):
            if "\ufffd" in text:
                out[i] = self.tokenizer.decode(ids[i].tolist(), skip_special_tokens=False)
        return out


def loaded(path: str) -> Pieces:
    import tokenizers

    return kept_with(tokenizers, f"pieces {path}", lambda: Pieces(path))


def parity(path: str, texts: list[str]) -> list[int]:
    """Numbers of the texts for which ids or decoded texts differ from the sentencepiece library's."""
    import sentencepiece

    ours, theirs = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    ids, wanted = ours.encode(texts), theirs.encode(texts, num_threads=1)
    whole = [e.ids for e in ours.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    back, decoded = ours.decode(ids), theirs.decode(wanted)
    library = ours.tokenizer.decode_batch(wanted, skip_special_tokens=False)
    return [i for i in range(len(texts)) if not ids[i].tolist() == wanted[i] == whole[i] or not back[i] == decoded[i] == library[i]]


def encode_decode(docs: DataFrame, path: str, threads: int = 2) -> DataFrame:
    """Encode every text of ``(doc_id, text)`` with the model at ``path`` and decode the ids again.

    Returns doc_id, ids (array of int), decoded. Null and empty texts have no ids and decode to the empty text. No shuffle:
    each row by itself, in slices of bounded size that the library encodes on ``threads`` threads. Repeated rows and rows
    without an id are kept; other columns are not looked at.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        pieces = loaded(path)
        for frame in in_slices(batches, 1 << 20):
            ids = pieces.encode(frame["text"].tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "ids": [i.astype(np.int32) for i in ids], "decoded": pieces.decode(ids)})

    return id_back(docs.select(id_text("doc_id"), whole_text().alias("text")).mapInPandas(run, "doc_id string, ids array<int>, decoded string"), "doc_id")


def digests(docs: DataFrame, path: str, threads: int = 2) -> DataFrame:
    """What ``encode_decode`` gives, as one small row a document: doc_id, n_ids, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), n_chars and decoded_same (the decoded text is the text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        pieces = loaded(path)
        for frame in in_slices(batches, 1 << 20):
            texts = frame["text"].tolist()
            ids = pieces.encode(texts)
            back = pieces.decode(ids)
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].to_numpy(), "n_ids": [len(i) for i in ids], "ids_crc32": [zlib.crc32(i.astype("<u4")) for i in ids],
                "n_chars": [len(t) for t in texts], "decoded_same": [b == t for b, t in zip(back, texts)]})

    texts = docs.select(id_text("doc_id"), whole_text().alias("text"))
    return id_back(texts.mapInPandas(run, "doc_id string, n_ids long, ids_crc32 long, n_chars long, decoded_same boolean"), "doc_id")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op8_pieces")
def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents", "doc_id", "text"), piece_model())
