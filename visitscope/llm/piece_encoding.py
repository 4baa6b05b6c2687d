"""Operator 3: SentencePiece encoding and decoding with source offsets.

The model's compiled character map is walked for the longest prefix at every
position, and each normalised byte records the source byte it came from.
Pieces are cut on the normalised text, so the record projects every piece
back to a span of original UTF-8 bytes.

`encode` returns ids and spans; `encode_digest` takes those ids and spans,
tests that the spans cover the text, decodes the ids, and returns counts and
hashes. A word's ids and spans are remembered relative to its place and shifted
to where it stands. Defined results: null text is the empty text; the empty text
has no pieces; rows that repeat and rows with a null id are encoded like any
other; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import small_batches, texts

SPACE = "▁"
# Words remembered per Python worker; beyond it the memory starts anew.
REMEMBERED_WORDS = 500_000
LONGEST_REMEMBERED = 64


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def proto_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialized protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = 8 if kind == 1 else 4
            value = data[at:at + size]
            at += size
        yield key >> 3, value


class CharMap:
    """Longest-prefix replacement through a compiled character map.

    The map is a double-array trie (little-endian 32-bit units, preceded by
    its size in bytes) followed by the zero-terminated replacements.
    """

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.targets = b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.targets = blob[4 + size:]

    def first_bytes(self) -> bytes:
        """Bytes that some entry begins with."""
        if not self.units:
            return b""
        root = (self.units[0] >> 10) << ((self.units[0] & 0x200) >> 6)
        return bytes(b for b in range(256) if root ^ b < len(self.units) and self.units[root ^ b] & 0x800000FF == b)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest prefix of data[at:], if any."""
        if not self.units:
            return None
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, start = found
        return length, self.targets[start:self.targets.index(b"\0", start)]


class Normalizer:
    """Text to normalised bytes, with the source offset of each byte."""

    def __init__(self, charmap: bytes = b"", dummy_prefix: bool = True, squeeze: bool = True,
                 escape: bool = True):
        self.map = CharMap(charmap)
        self.dummy_prefix, self.squeeze, self.escape = dummy_prefix, squeeze, escape
        # Characters that no entry begins with stand for themselves; runs of them are taken at once.
        self._plain = re.compile(b"[^ " + b"".join(b"\\x%02x" % b for b in self.map.first_bytes()) + b"]+")

    @classmethod
    def of_model(cls, model: bytes) -> Normalizer:
        spec = dict(proto_fields(next((v for f, v in proto_fields(model) if f == 3), b"")))
        return cls(spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)))

    @property
    def is_identity(self) -> bool:
        return not self.map.units and not self.squeeze and self.escape and self.dummy_prefix

    def _step(self, data: bytes, at: int) -> tuple[int, bytes]:
        hit = self.map.longest(data, at)
        if hit:
            return hit
        first = data[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, data[at:at + size]

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes and, for each of them and their end, the source byte offset."""
        data, at = text.encode(), 0
        out, origin = bytearray(), []
        space = SPACE.encode() if self.escape else b" "
        if self.squeeze:
            while at < len(data):
                size, target = self._step(data, at)
                if target != b" ":
                    break
                at += size
        if at == len(data):
            return b"", [0]
        if self.dummy_prefix:
            out += space
            origin += [at] * len(space)
        after_space = self.squeeze
        while at < len(data):
            if run := self._plain.match(data, at):
                out += run[0]
                if run[0].isascii():
                    origin += range(at, run.end())
                else:
                    for here in range(at, run.end()):
                        if data[here] & 0xC0 != 0x80:
                            at = here
                        origin.append(at)
                at, after_space = run.end(), False
                continue
            size, target = self._step(data, at)
            if after_space:
                target = target.lstrip(b" ")
            if target:
                ends_in_space = target.endswith(b" ")
                target = target.replace(b" ", space)
                out += target
                origin += [at] * len(target)
                after_space = self.squeeze and ends_in_space
            at += size
        if self.squeeze:
            while out.endswith(space):
                at = origin[len(out) - len(space)]
                del out[-len(space):]
                del origin[len(out):]
        return bytes(out), [*origin, at]


class Growing:
    """A column of numbers that grows at its end; room doubles, so adding copies little. `data` may be longer than `size`."""

    def __init__(self) -> None:
        self.data, self.size = np.zeros(1024, np.int64), 0

    def extend(self, values) -> None:
        new = np.asarray(values, np.int64)
        end = self.size + len(new)
        if end > len(self.data):
            self.data = np.concatenate([self.data[:self.size], np.zeros(max(end, 2 * len(self.data)) - self.size, np.int64)])
        self.data[self.size:end] = new
        self.size = end

    def __len__(self) -> int:
        return self.size


class PieceEncoder:
    """One model, loaded once per Python worker."""

    def __init__(self, model_path: str):
        import sentencepiece

        with open(model_path, "rb") as f:
            model = f.read()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normalize = Normalizer.of_model(model)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.is_byte = [self.sp.is_byte(i) for i in range(len(names))]
        self.piece_bytes = [1 if b else len(n.encode()) for n, b in zip(names, self.is_byte, strict=True)]
        # Where no piece continues past the end of a word, words are encoded one by one:
        # no merge can cross from a word's last character to the next space.
        self.by_word = self.normalize.is_identity and any(self.is_byte) and not any(
            SPACE in n.lstrip(SPACE) for n in names)
        self.space_id = self.sp.piece_to_id(SPACE)
        self._decimal = list(map(str, range(len(names))))
        self._forget()

    def encode(self, text: str) -> tuple[list[int], list[int], list[int]]:
        """Ids and, for each piece, its first byte and the byte after its last in the text."""
        proto = self.sp.encode(text, return_type="proto")
        ids, lengths = [], []
        for piece in proto.pieces:
            ids.append(piece.id)
            lengths.append(1 if self.is_byte[piece.id] else len(piece.piece.encode()))
        normalised, origin = self.normalize(text)
        edges = self._edges(lengths, normalised, origin)
        return ids, edges[:-1], edges[1:]

    @staticmethod
    def _edges(lengths: list[int], normalised: bytes, origin: list[int]) -> list[int]:
        """Source offsets of the cuts between pieces of these lengths."""
        cuts = [0, *accumulate(lengths)]
        if cuts[-1] != len(normalised):
            raise ValueError("pieces do not cover the normalised text")
        return [origin[c] for c in cuts]

    def _forget(self) -> None:
        self._row: dict[str, int] = {}
        # Of words: first piece, number of pieces, bytes. Of pieces: id, span from the word's first byte; its space is at -1.
        self._first, self._count, self._bytes = Growing(), Growing(), Growing()
        self._id, self._begin, self._end = Growing(), Growing(), Growing()

    def _keep(self, words: int, pieces: int) -> None:
        """Cuts the memory's columns to the first words and pieces."""
        for column in (self._first, self._count, self._bytes):
            column.size = words
        for column in (self._id, self._begin, self._end):
            column.size = pieces

    def _learn(self, words: list[str]) -> None:
        """Ids and spans of words as they stand after one space, added to the memory."""
        space, size = SPACE.encode(), self.piece_bytes
        count, held, begins, ends = [], [], [], []
        for word, ids in zip(words, self.sp.encode(words, num_threads=1), strict=True):
            if word:
                normalised, origin = self.normalize(word)
            else:
                ids, normalised, origin = [self.space_id], space, [0] * (len(space) + 1)
            edges = self._edges([size[i] for i in ids], normalised, [-1] * len(space) + origin[len(space):])
            count.append(len(ids))
            held += ids
            begins += edges[:-1]
            ends += edges[1:]
        rows = self._count.size
        self._row.update(zip(words, range(rows, rows + len(words)), strict=True))
        first = self._id.size + np.cumsum([0, *count[:-1]])
        for column, new in ((self._first, first), (self._count, count), (self._bytes, [len(w.encode()) for w in words]),
                            (self._id, held), (self._begin, begins), (self._end, ends)):
            column.extend(new)

    def _placed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`encode` of remembered words with a space between each two."""
        rows = np.fromiter(map(self._row.__getitem__, words), np.int64, len(words))
        count, size = self._count.data[rows], self._bytes.data[rows]
        upto = np.cumsum(count)
        at = np.arange(upto[-1]) + np.repeat(self._first.data[rows] - (upto - count), count)
        shift = np.repeat(np.cumsum(size + 1) - size - 1, count)
        # The first word's space is not in the text.
        return self._id.data[at], np.maximum(self._begin.data[at] + shift, 0), np.maximum(self._end.data[at] + shift, 0)

    def encode_all(self, batch: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """`encode` of every text."""
        split, fresh = [], set()
        if len(self._row) > REMEMBERED_WORDS:
            self._forget()
        for text in batch:
            words = None
            if text and self.by_word and SPACE not in text:
                words = text.split(" ") if "  " not in text and text[0] != " " else re.split("(?<=[^ ]) ", text)
                fresh.update(words)
            split.append(words)
        fresh = [w for w in fresh if w not in self._row]
        long = [w for w in fresh if len(w) > LONGEST_REMEMBERED]
        if len(fresh) > len(long):
            self._learn([w for w in fresh if len(w) <= LONGEST_REMEMBERED])
        kept = self._count.size, self._id.size
        if long:
            self._learn(long)
        for text, words in zip(batch, split, strict=True):
            if words is not None:
                yield self._placed(words)
            else:
                yield tuple(np.array(c, np.int64) for c in (self.encode(text) if text else ([], [], [])))
        if long:
            for word in long:
                del self._row[word]
            self._keep(*kept)

    def digests(self, batch: list[str]) -> list[tuple[int, str, str]]:
        """(pieces, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text) of every text's `encode`."""
        out = []
        for text, (ids, begins, ends) in zip(batch, self.encode_all(batch), strict=True):
            # Spaces that normalisation strips at the ends of a text belong to no piece.
            if len(ids) and (not np.array_equal(ends[:-1], begins[1:])
                             or self.normalize.is_identity and (begins[0] != 0 or ends[-1] != len(text.encode()))):
                raise ValueError("spans do not cover the text")
            ids = ids.tolist()
            out.append((len(ids), hashlib.sha256(",".join(map(self._decimal.__getitem__, ids)).encode()).hexdigest(),
                        hashlib.sha256((self.sp.decode(ids) if ids else "").encode()).hexdigest()))
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(model_path: str) -> PieceEncoder:
    if model_path not in _ENCODERS:
        _ENCODERS[model_path] = PieceEncoder(model_path)
    return _ENCODERS[model_path]


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, begins, ends): piece ids of each text and their byte spans in it."""
    small_batches(df.sparkSession)
    schema = T.StructType([df.schema[id_col], *(T.StructField(c, T.ArrayType(T.IntegerType(), False), False)
                                                for c in ("ids", "begins", "ends"))])
    ints = pa.list_(pa.field("element", pa.int32(), False))

    def run(batches):
        enc = encoder(model_path)
        for batch in batches:
            rows = list(enc.encode_all(texts(batch.column(1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k].astype(np.int32) for r in rows], ints) for k in range(3))],
                names=schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def encode_digest(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each text, ids and all in one pass."""
    small_batches(df.sparkSession)
    schema = T.StructType([df.schema[id_col], T.StructField("n_tokens", T.LongType(), False),
                           T.StructField("ids_sha256", T.StringType(), False),
                           T.StructField("decoded_sha256", T.StringType(), False)])

    def run(batches):
        enc = encoder(model_path)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = enc.digests(texts(batch.column(1)))
            n, ids, decoded = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)],
                names=schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of each list of ids; null decodes to the empty text."""
    small_batches(df.sparkSession)
    schema = T.StructType([df.schema[id_col], T.StructField("text", T.StringType(), False)])

    def run(batches):
        enc = encoder(model_path)
        for batch in batches:
            out = [enc.sp.decode(ids) if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=schema.names)

    return df.select(id_col, ids_col).mapInArrow(run, schema)
