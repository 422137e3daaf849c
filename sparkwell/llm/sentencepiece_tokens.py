"""SentencePiece encoding and decoding with the tokenizers library as the backend.

The model file is read as protobuf wire format; its normaliser, white-space marker, pieces,
scores (unigram) or merges in score order (BPE) and byte pieces are rebuilt as a
``tokenizers.Tokenizer``. Where no piece crosses from other characters to the marker, a
text's ids are those of its marked words one after the other. A task then encodes each
different word once, with the backend's threads, and checks ids and decoded text of each
against the sentencepiece library, so parity is verified for everything that is encoded.

Defined results: a null text has null ids, an empty text none; each row is encoded for
itself, repeated rows included; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwell.llm.shared import leaving_nothing, slices

MARK = "▁"

#: Fixed values of the model file's format: model kinds, piece kinds and field numbers.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protobuf message: an int, a float's four bytes, or a bytes value."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at : at + size]
            at += size


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    marker_after: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @classmethod
    def read(cls, raw: bytes) -> Model:
        model = cls()
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
                model.marker_after = bool(trainer.get(24, 0))
            elif number == 3:
                normal = dict(_fields(value))
                model.char_map = normal.get(2, b"")
                model.dummy_prefix = bool(normal.get(3, 1))
                model.squeeze = bool(normal.get(4, 1))
                model.escape = bool(normal.get(5, 1))
        if model.kind not in (UNIGRAM, BPE) or model.marker_after or not model.escape:
            raise ValueError("only unigram and BPE models with the marker before words are supported")
        if any(kind == USER_DEFINED for _, _, kind in model.pieces):
            raise ValueError("pieces defined by the user are not supported")
        return model

    def splits(self) -> bool:
        """Whether no piece holds the marker after another character, so that words can be encoded one by one."""
        return all(MARK not in p.lstrip(MARK) for p, _, kind in self.pieces if kind == NORMAL)


def backend(model: Model):
    """The model as a ``tokenizers.Tokenizer``; it takes plain text and gives the same ids."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    unknown = next((i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN), None)
    if model.kind == UNIGRAM:
        made = Tokenizer(models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback))
    else:
        ordered = []
        for piece, score, kind in model.pieces:
            if kind == NORMAL:
                pairs = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
                ordered += [(-score, vocab[a], vocab[b], a, b) for a, b in pairs if a in vocab and b in vocab]
        merges = [(a, b) for *_, a, b in sorted(ordered)]
        name = model.pieces[unknown][0] if unknown is not None else None
        bpe = models.BPE(vocab, merges, unk_token=name, byte_fallback=model.byte_fallback, fuse_unk=True, cache_capacity=0)
        made = Tokenizer(bpe)
    steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    made.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    after = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    made.decoder = decoders.Sequence([*after, decoders.Strip(" ", 1, 0)] if model.dummy_prefix else after)
    return made


class Encoder:
    """Encodes texts and remembers the words it has met, until they are too many and it starts anew."""

    WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def __init__(self, raw: bytes, most_words: int = 150_000, most_chars: int = 4 << 20):
        import sentencepiece

        self.model = Model.read(raw)
        self.backend = backend(self.model)
        self.normalizer, self.backend.normalizer = self.backend.normalizer, None
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.one_by_one = self.model.splits()
        self.plain = not self.model.char_map and not self.model.squeeze
        self.model.pieces = []  # both libraries hold them now
        self.most_words, self.most_chars = most_words, most_chars
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.same = np.zeros(0, bool)
        self.back = np.zeros(0, bool)

    def normal(self, text: str) -> str:
        if self.plain:
            return (MARK if self.model.dummy_prefix and text else "") + text.replace(" ", MARK)
        return self.normalizer.normalize_str(text)

    def _learn(self, words: list[str]) -> None:
        found = [x.ids for x in self.backend.encode_batch_fast(words, add_special_tokens=False)]
        same, back = self._verify(words, found)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.same = np.concatenate([self.same, same])
        self.back = np.concatenate([self.back, back])

    def _verify(self, words: list[str], found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Whether the library gives the same ids, and whether the ids decode to the word again."""
        plain = [w.replace(MARK, " ") for w in words]
        first = self.model.dummy_prefix
        theirs = self.reference.encode([w[1:] if first else w for w in plain], num_threads=1)
        # The library adds its own marker in front, but not to nothing: a lone marker is a vocabulary entry to look up.
        same = [a == b if w != MARK or not first else a == [self.reference.piece_to_id(MARK)] for w, a, b in zip(words, found, theirs, strict=True)]
        back = [a == b for a, b in zip(self.backend.decode_batch(found, skip_special_tokens=False), [w[1:] if first else w for w in plain], strict=True)]
        return np.array(same, bool), np.array(back, bool)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, where each text's begin and end, and each text's parity and round trip."""
        split = [(self.WORDS.findall(n) if self.one_by_one else [n]) if (n := self.normal(t)) else [] for t in texts]
        if len(self.places) > self.most_words or self.chars > self.most_chars:
            self._forget()
        known, new = self.places, []
        codes = []
        for words in split:
            for w in words:
                at = known.get(w)
                if at is None:
                    at = known[w] = len(known)
                    new.append(w)
                codes.append(at)
        if new:
            self._learn(new)
            self.chars += sum(map(len, new))
        code = np.array(codes, np.int64)
        begin, size = self.starts[code], np.diff(self.starts)[code]
        ends = np.cumsum(size)
        flat = self.ids[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        words_in = np.cumsum([0, *map(len, split)])
        bounds = np.r_[0, ends][words_in]
        bad_same, bad_back = np.r_[0, np.cumsum(~self.same[code])], np.r_[0, np.cumsum(~self.back[code])]
        same = bad_same[words_in[1:]] == bad_same[words_in[:-1]]
        back = bad_back[words_in[1:]] == bad_back[words_in[:-1]]
        if not self.plain:
            self._verify_whole(texts, flat, bounds, same, back)
        return flat, bounds, same, back

    def _verify_whole(self, texts: list[str], flat: np.ndarray, bounds: np.ndarray, same: np.ndarray, back: np.ndarray) -> None:
        """Where the normaliser changes texts, the library gets each whole text as it came, and decodes all its ids."""
        found = [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
        same[:] = np.array([a == b for a, b in zip(found, self.reference.encode(texts, num_threads=1), strict=True)], bool)
        mine = self.backend.decode_batch(found, skip_special_tokens=False)
        back[:] = np.array([a == b for a, b in zip(mine, self.reference.decode(found), strict=True)], bool)


_encoders: dict[str, Encoder] = {}


def encoder(raw: bytes) -> Encoder:
    """One for each worker process, which keeps its words from task to task."""
    name = hashlib.sha256(raw).hexdigest()
    if name not in _encoders:
        _encoders[name] = Encoder(raw)
    return _encoders[name]


def model_bytes(path: str) -> bytes:
    """The model file, read by the driver; a few MB at most, so it can be sent to every task."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, raw: bytes, text: str = "text", with_ids: bool = True, threads: int = 2) -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``ids``, ``ids_sha256`` (of 32-bit little-endian ids), ``parity``, ``round_trip``.

    ``parity``: the sentencepiece library gives the same ids. ``round_trip``: they decode to
    the normalised text. Columns of ``docs`` with these names are replaced. ``threads`` are
    the backend's threads in each task, which encode a batch's new words together.
    """
    added = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("parity", "boolean").add("round_trip", "boolean")
    if with_ids:
        added = added.add("ids", T.ArrayType(T.IntegerType()))
    names = [f.name for f in docs.schema.fields if f.name != text and f.name not in added.names]
    schema = T.StructType([docs.schema[n] for n in names] + added.fields)
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"  # a forked worker has it off otherwise
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        made = encoder(shared.value)
        for batch in slices(batches, text, 1 << 19):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            flat, bounds, same, back = made.encode([t or "" for t in texts])
            null = np.array([t is None for t in texts], bool)
            digests = [None if z else hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b, z in zip(bounds, bounds[1:], null, strict=False)]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [
                pa.array(np.diff(bounds), pa.int64(), mask=null),
                pa.array(digests, pa.string()),
                pa.array(same, pa.bool_(), mask=null),
                pa.array(back, pa.bool_(), mask=null),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32)), mask=pa.array(null)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*names, text).mapInArrow(leaving_nothing(run), schema)


def decode(rows: DataFrame, raw: bytes, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with ``out``: the text of the ids; null ids have null text."""
    names = [f.name for f in rows.schema.fields if f.name != out]
    schema = T.StructType([rows.schema[n] for n in names] + [T.StructField(out, T.StringType())])
    shared = rows.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(shared.value).backend
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = iter(made.decode_batch([x for x in lists if x is not None], skip_special_tokens=False))
            found = [None if x is None else next(texts) for x in lists]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], names=schema.names)

    return rows.select(*names).mapInArrow(leaving_nothing(run), schema)


def counted(docs: DataFrame, raw: bytes) -> DataFrame:
    """Tokens and documents in all."""
    return encode(docs, raw, with_ids=False).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
