"""SentencePiece encoding and decoding with the byte span of every piece.

``Normalizer`` rewrites a text as the model prescribes: at each place the longest key of the
compiled character map that starts there is replaced by its value (one character
is kept where no key fits), white space is trimmed and escaped as the model says, and a dummy
prefix is added. For each normalised byte it records the source byte that it came
from. Pieces partition the normalised text, so their cumulated lengths, sent through that
record, are their spans in the source.

The ids are the library's own. For models of which no piece runs from a letter into another
kind of character or into a following space, and whose normaliser keeps bytes as they are,
the library gets each distinct chunk of text once per process (see ``chunks``); any
other model encodes whole texts.

Null texts count as empty and give no ids. Repeated rows are encoded as they are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import words
from .chunks import ChunkEncoder
from .store import column, ragged, text_slices, with_columns

SPACE = "▁".encode()


class CharacterMap:
    """A compiled character map: a double-array trie of keys, and the NUL-ended values they stand for."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.values = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at this place, and its value."""
        units, found = self.units, None
        node = self._child(0)
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.values[start : self.values.index(b"\0", start)]
        return found

    def _child(self, node: int) -> int:
        return node ^ self._offset(self.units[node])

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normalizer:
    def __init__(self, spec, suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = suffix

    @property
    def keeps_bytes(self) -> bool:
        """Whether nothing happens but the prefix and the escaping of spaces."""
        return self.map is None and not self.trim and self.escape and self.prefix and not self.suffix

    def normalize(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the source position."""
        parts: list[tuple[bytes, int]] = []  # values and where they come from
        at = 0
        while at < len(text):
            hit = self.map.longest(text, at) if self.map else None
            if hit is None:
                step = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                hit = step, text[at : at + step]
            parts.append((hit[1], at))
            at += hit[0]
        end = len(text)
        if self.trim:
            while parts and not parts[0][0].strip(b" "):
                parts.pop(0)
            while parts and not parts[-1][0].strip(b" "):
                end = parts.pop()[1]
        if not parts:
            return b"", np.array([end], dtype=np.int64)
        space = SPACE if self.escape else b" "
        out, source = bytearray(), []
        if self.prefix and not self.suffix:
            out += space
            source += [parts[0][1]] * len(space)
        was_space = self.trim
        for value, origin in parts:
            if self.trim and was_space:
                value = value.lstrip(b" ")
            if not value:
                continue
            was_space = value.endswith(b" ")
            made = value.replace(b" ", space)
            source += [origin] * len(made)
            out += made
        if self.trim:
            while out.endswith(space):
                del out[-len(space) :], source[-len(space) :]
        if self.prefix and self.suffix:
            out += space
            source += [end] * len(space)
        return bytes(out), np.array([*source, end], dtype=np.int64)


class Model:
    """A model of the library with its normaliser; one for each process and path."""

    _loaded: dict[str, Model] = {}

    @classmethod
    def at(cls, path: str) -> Model:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        self.normalizer = Normalizer(proto.normalizer_spec, proto.trainer_spec.treat_whitespace_as_suffix)
        kinds = type(proto.pieces[0])
        self.lengths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in proto.pieces], dtype=np.int64)
        self.chunks = None
        normal = [p.piece for p in proto.pieces if p.type == kinds.NORMAL]
        plain = all(p.type in (kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN) for p in proto.pieces)
        if plain and proto.trainer_spec.byte_fallback and proto.trainer_spec.model_type == 2 and self.normalizer.keeps_bytes and not any(map(_crosses, normal)):
            proto.normalizer_spec.add_dummy_prefix = False
            bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

            def encode_chunks(chunks: list[tuple[str, bool]]) -> list[list[int]]:
                return bare.encode([" " + c if first else c for c, first in chunks], num_threads=1)

            self.chunks = ChunkEncoder(encode_chunks, True)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        if self.chunks:
            return self.chunks.encode(texts)
        got = self.library.encode([t or "" for t in texts.to_pylist()], num_threads=1)
        return np.array([i for x in got for i in x], dtype=np.uint32), np.array([len(x) for x in got], dtype=np.int64)

    def spans(self, texts: pa.Array, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every piece in the bytes of its source text."""
        data, starts = words.text_bytes(texts)
        if self.normalizer.keeps_bytes:
            # a space became three bytes, and each text but an empty one got three in front
            wide = np.where(data == 0x20, 3, 1)
            source = np.repeat(np.arange(len(data), dtype=np.int64), wide)
            filled = starts[1:] > starts[:-1]
            before = np.concatenate([[0], np.cumsum(wide)])[starts]  # normalised bytes before each text, without prefixes
            lengths = self.lengths[ids]
            text = np.repeat(np.arange(len(counts)), counts)
            prefixes = 3 * np.cumsum(filled)[text]
            ends = np.cumsum(lengths)
            if len(ids) and ends[-1] != len(source) + 3 * filled.sum():
                raise ValueError("the pieces don't make up the normalised text")
            source = np.append(source, len(data))
            ends, begins = ends - prefixes, ends - lengths - prefixes
            # within the dummy prefix: the start of the text
            begin = np.where(begins < before[text], starts[text], source[np.maximum(begins, 0)])
            end = np.where(ends >= before[text + 1], starts[text + 1], source[np.maximum(ends, 0)])
            end = np.maximum(end, begin)
            return begin - starts[text], end - starts[text]
        begins, ends, at = [], [], 0
        for i, n in enumerate(counts.tolist()):
            normalised, source = self.normalizer.normalize(data[starts[i] : starts[i + 1]].tobytes())
            own = ids[at : at + n]
            unknown = self.lengths[own].copy()
            if int(unknown.sum()) != len(normalised):
                unknown = np.diff([0, *_by_surface(self, normalised, own)])
            done = np.cumsum(unknown)
            begins.append(source[done - unknown])
            ends.append(source[done])
            at += n
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *begins]), np.concatenate([none, *ends])


def _by_surface(model: Model, normalised: bytes, ids: np.ndarray) -> list[int]:
    """Ends of pieces where some are unknown: an unknown piece reaches to where the next known one is found."""
    ends, at = [], 0
    own = [model.library.id_to_piece(int(i)).encode() for i in ids]
    unknown = model.library.unk_id()
    for k, i in enumerate(ids.tolist()):
        if i != unknown:
            at += int(model.lengths[i])
        elif k + 1 < len(own) and ids[k + 1] != unknown:
            at = normalised.index(own[k + 1], at + 1)
        else:
            at = len(normalised)
        ends.append(at)
    return ends


def _crosses(piece: str) -> bool:
    """Whether a piece runs over a place where ``chunks`` cuts: into a space, from a letter into another
    ASCII character, or from a line feed into a letter."""
    for a, b in zip(piece, piece[1:], strict=False):
        letter = a.isascii() and a.isalpha() or "À" <= a <= "ÿ" and a not in "×÷"
        if b == "▁" and a != "▁" or letter and b.isascii() and not b.isalpha() or a == "\n":
            return True
    return False


def encode(docs: DataFrame, model: str, text_column: str = "text", spans: bool = True, decoded: bool = True) -> DataFrame:
    """All other columns, and ``ids`` (without begin or end ids), ``begins`` and ``ends`` (byte spans of the
    pieces in the source) and ``decoded`` (the library's decoding of the ids).

    ``model`` is the path of the model file, which all executors need. Columns of the input
    with one of these names are replaced.
    """
    made = {"ids": "array<int>"} | ({"begins": "array<int>", "ends": "array<int>"} if spans else {}) | ({"decoded": "string"} if decoded else {})
    keep = [f for f in docs.schema.fields if f.name != text_column and f.name not in made]
    added = T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in made.items())).fields
    schema = T.StructType([*keep, *added])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.at(model)
        for batch in text_slices(batches, text_column, 1 << 20):
            texts = column(batch, text_column)
            ids, counts = own.encode(texts)
            more = {"ids": ragged(ids.astype(np.int32), counts, pa.int32())}
            if spans:
                begin, end = own.spans(texts, ids, counts)
                more["begins"] = ragged(begin.astype(np.int32), counts, pa.int32())
                more["ends"] = ragged(end.astype(np.int32), counts, pa.int32())
            if decoded:
                split = np.split(ids, np.cumsum(counts)[:-1])
                more["decoded"] = pa.array(own.library.decode([x.tolist() for x in split], num_threads=1), pa.string())
            yield with_columns(batch, names, more)

    return docs.select(*names, text_column).mapInArrow(run, schema)


def decode(tokens: DataFrame, model: str, ids_column: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns, and the library's decoding of the ids; null ids decode to null."""
    schema = T.StructType([*(f for f in tokens.schema.fields if f.name != to), T.StructField(to, T.StringType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.at(model)
        for batch in batches:
            got = [None if x is None else own.library.decode(x) for x in column(batch, ids_column).to_pylist()]
            yield with_columns(batch, names, {to: pa.array(got, pa.string())})

    return tokens.select(*{*names, ids_column}).select(*names).mapInArrow(run, schema)
