"""SentencePiece encoding with original byte spans, and decoding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

SPACE = "▁".encode()
#: Piece types of the model file format.
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6


class CharMap:
    """The compiled character map: a double-array trie of byte strings, then their NUL-ended replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.out = blob[4 + size :]
        self.first = np.zeros(256, bool)
        for byte in range(256 if self.units else 0):
            self.first[byte] = self._step(self._offset(self.units[0]), byte) is not None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _step(self, node: int, byte: int) -> tuple[int, int] | None:
        at = node ^ byte
        if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
            return None
        return at ^ self._offset(self.units[at]), self.units[at]

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """(bytes taken, replacement) of the longest entry at start."""
        node, best = self._offset(self.units[0]), None
        for i in range(start, len(text)):
            if (step := self._step(node, text[i])) is None:
                break
            node, unit = step
            if unit >> 8 & 1:
                best = (i + 1 - start, self.units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.out[best[1] : self.out.index(b"\0", best[1])]


@dataclass
class Rules:
    """What a model file says about normalisation."""

    chars: CharMap
    dummy_prefix: bool
    trim: bool
    escape: bool
    suffix: bool
    kept: re.Pattern | None  # user-defined symbols are never normalised

    @classmethod
    def of(cls, model: bytes) -> Rules:
        proto = model_pb2.ModelProto.FromString(model)
        spec = proto.normalizer_spec
        own = sorted((p.piece.encode() for p in proto.pieces if p.type == USER_DEFINED), key=len, reverse=True)
        return cls(CharMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces, proto.trainer_spec.treat_whitespace_as_suffix, re.compile(b"|".join(map(re.escape, own))) if own else None)


def _units(text: bytes, rules: Rules) -> Iterator[tuple[int, int, bytes | None]]:
    """(start, end, replacement) covering text; no replacement: the bytes stand for themselves."""
    if not rules.chars.units and rules.kept is None:
        yield 0, len(text), None
        return
    raw = np.frombuffer(text, np.uint8)
    stops = rules.chars.first[raw] & ((raw & 0xC0) != 0x80)
    kept = {m.start(): m.end() for m in rules.kept.finditer(text)} if rules.kept else {}
    stops[list(kept)] = True
    at = 0
    for i in np.flatnonzero(stops).tolist():
        if i < at:
            continue
        if i in kept:
            end, new = kept[i], text[i : kept[i]]
        elif rules.chars.units and (found := rules.chars.longest(text, i)):
            end, new = i + found[0], found[1]
        else:
            continue
        if at < i:
            yield at, i, None
        yield i, end, new
        at = end
    if at < len(text):
        yield at, len(text), None


def normalise(text: bytes, rules: Rules) -> tuple[bytes, np.ndarray]:
    """Normalised bytes, and for each of them and the end the source byte where its unit starts.

    The longest entry of the character map wins at each place; extra spaces go if
    the model says so; spaces become the meta symbol. An empty text stays empty.
    """
    parts, source = [], []
    for start, end, new in _units(text, rules):
        parts.append(text[start:end] if new is None else new)
        source.append(np.arange(start, end) if new is None else np.full(len(new), start))
    out, align = b"".join(parts), np.concatenate([*source, np.zeros(0, np.int64)])
    raw = np.frombuffer(out, np.uint8)
    tail = len(text)
    if rules.trim and len(raw):
        blank = raw == 0x20
        keep = ~(blank & np.concatenate([[True], blank[:-1]]))
        if blank[-1]:
            last = len(raw) - np.argmin(blank[::-1]) if not blank.all() else 0
            tail = int(align[last]) if last < len(raw) else tail
            keep[last:] = False
        out, align, raw = raw[keep].tobytes(), align[keep], raw[keep]
    if not out:
        return b"", np.zeros(1, np.int64)
    mark = SPACE if rules.escape else b" "
    if rules.escape:
        align = np.repeat(align, np.where(raw == 0x20, len(SPACE), 1))
        out = out.replace(b" ", SPACE)
    if rules.dummy_prefix:
        out, align = (out + mark, np.concatenate([align, np.full(len(mark), tail)])) if rules.suffix else (mark + out, np.concatenate([np.full(len(mark), align[0]), align]))
    return out, np.append(align, tail)


class Encoder:
    """Ids by the library, spans by this module's normaliser."""

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rules = Rules.of(model)
        proto = model_pb2.ModelProto.FromString(model)
        self.width = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces])
        self.unknown = {i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN}
        self.names = [str(i) for i in range(len(proto.pieces))]

    def encode(self, text: str) -> tuple[list[int], np.ndarray | None]:
        """Ids, and (n, 2) spans of source bytes, or no spans where the pieces don't cover the normalised text."""
        ids = self.sp.encode(text, num_threads=1)
        out, align = normalise(text.encode(), self.rules)
        width = self.width[ids] if ids else np.zeros(0, np.int64)
        if not self.unknown.isdisjoint(ids):
            width = np.array([len(p.encode()) if i in self.unknown else w for i, p, w in zip(ids, self.sp.encode(text, out_type=str), width, strict=True)])
        ends = np.cumsum(width)
        if len(out) != (ends[-1] if len(ends) else 0):
            return ids, None
        return ids, np.stack([align[ends - width], align[ends]], 1)


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver and sent to the tasks with their code."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, starts array<int>, ends array<int>), a row for each row of docs.

    Spans are source bytes of the UTF-8 text; starts and ends are null where the
    library's pieces don't cover the normalised text (none is known). A null or empty
    text has no pieces; a very long text is encoded whole; repeated rows stay
    repeated; null ids stay null; an empty table gives an empty result; other
    columns aren't read.
    """

    def run(batches):
        encoder = Encoder(model)
        for batch in batches:
            found = [encoder.encode(text.as_py() or "") for text in batch.column(1)]
            cols = [[np.asarray(ids, np.int32) for ids, _ in found], *([None if s is None else s[:, k].astype(np.int32) for _, s in found] for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.list_(pa.int32())) for c in cols)], ["doc_id", "ids", "starts", "ends"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(pieces: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, text) of rows with ids; null ids give an empty text."""

    def run(batches):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sp.decode(x.as_py() or []) for x in batch.column(1)], pa.string())], ["doc_id", "text"])

    return pieces.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Digests of encoding and decoding, a row for each row of docs.

    n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (the decoded
    text), span_bytes (source bytes from the first span's start to the last one's
    end) and spans_sha256 (little-endian 32-bit starts and ends); with_ids: the ids
    too. The span columns are null where the pieces don't cover the normalised text.
    Null texts count as empty: no pieces; a very long text is encoded whole; repeated
    rows and null ids stay; an empty table gives an empty result; other columns
    aren't read.
    """

    def run(batches):
        encoder = Encoder(model)
        for batch in batches:
            cols = [[] for _ in range(5)]
            all_ids = []
            for text in batch.column(1):
                ids, spans = encoder.encode(text.as_py() or "")
                cols[0].append(len(ids))
                cols[1].append(hashlib.sha256(",".join([encoder.names[i] for i in ids]).encode()).hexdigest())
                cols[2].append(hashlib.sha256(encoder.sp.decode(ids).encode()).hexdigest())
                cols[3].append(None if spans is None else int(spans[-1, 1] - spans[0, 0]) if ids else 0)
                cols[4].append(None if spans is None else hashlib.sha256(spans.astype("<u4").tobytes()).hexdigest())
                if with_ids:
                    all_ids.append(np.array(ids, np.int32))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            out = [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *cols[0]]), pa.int32()), pa.array(np.concatenate([*all_ids, np.zeros(0, np.int32)]))))
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long, spans_sha256 string" + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
