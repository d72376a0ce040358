"""SentencePiece encoding that keeps byte spans, and decoding.

Longest-prefix normalisation walks the model's compiled character map (a double-array trie) and
records, for each normalised character, the source bytes it came from; the normalised text is segmented, and
every piece is projected to a byte span of the original text. Segmentation takes short runs of space-led chunks, which is exact as long
as no piece continues over a space mark; other models are segmented text by text. The pieces of a group of texts
are aligned at once. Decoding takes the ids of a whole text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import text_batches

MARK = "▁"
#: Bytes of a processor's cache that the library's symbols and pairs of a run of chunks may fill, about 100 a character.
CACHE_BYTES = 24 << 10
#: Texts that are taken from a batch and handed on at a time, and characters after which a group of them that is aligned at once ends.
TEXTS, CHARS = 64, 1 << 19


class CharMap:
    """The compiled character map of a model: 4 bytes of trie size, the trie's units, then the replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.replacements = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at a byte, and what replaces it."""
        if not self.units:
            return None
        shift = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node, best = shift(self.units[0]), None
        for i in range(at, len(source)):
            node ^= source[i]
            unit = self.units[node]
            if unit & 0x800000FF != source[i]:
                break
            node ^= shift(unit)
            if unit & 0x100:
                best = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if best is None:
            return None
        end = self.replacements.index(0, best[1])
        return best[0], self.replacements[best[1] : end]


class Encoder:
    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(model, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("models that mark the end of words, or do not mark spaces, are not supported")
        self.trim, self.prefix = spec.remove_extra_whitespaces, spec.add_dummy_prefix
        self.map = CharMap(spec.precompiled_charsmap)
        self.piece = [p.piece for p in proto.pieces]
        self.pieces = pa.array(self.piece, pa.string())
        self.chars = np.array([len(p) for p in self.piece], np.int64)
        #: Pieces that are copied as they stand, the longest first.
        self.fixed = sorted((p.piece.encode() for p in proto.pieces if p.type == 4), key=len, reverse=True)
        #: Chunks segment on their own only if each starts with a piece of its own and none runs on over a space mark.
        self.chunked = self.prefix and MARK in self.piece and not any(MARK in p.lstrip(MARK) for p in self.piece) and not self.fixed
        #: Runs end before the first of a chunk's space marks.
        self.runs = re.compile(f"{MARK}.{{0,{CACHE_BYTES // 100}}}{MARK}*[^{MARK}]*", re.DOTALL).findall
        # the same pieces for text that is normalised already
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.eos, self.unknown = self.segmenter.eos_id(), self.segmenter.unk_id()
        #: The byte that a piece stands for; -1 where it is none.
        self.byte = np.array([int(p.piece[1:-1], 16) if p.type == 6 else -1 for p in proto.pieces], np.int64)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, the byte of the source where it starts."""
        source = text.encode()
        if not self.map.units and not self.fixed and not self.trim:
            raw = np.frombuffer(source, np.uint8)
            starts = np.flatnonzero((raw & 0xC0) != 0x80)
            lead = self.prefix and len(source) > 0
            return (MARK if lead else "") + text.replace(" ", MARK), np.concatenate([starts[:1] if lead else starts[:0], starts, [len(source)]])
        out: list[str] = []
        where: list[int] = []
        at = 0
        if self.trim:
            while at < len(source) and (found := self.prefix_of(source, at))[1] == " ":
                at += found[0]
        if self.prefix and at < len(source):
            out.append(MARK)
            where.append(at)
        ends_in_space = self.trim
        while at < len(source):
            n, new = self.prefix_of(source, at)
            if ends_in_space:
                new = new.lstrip(" ")
            if new:
                out.extend(new.replace(" ", MARK))
                where.extend([at] * len(new))
                ends_in_space = new.endswith(" ")
            at += n
            ends_in_space = ends_in_space and self.trim
        end = len(source)
        while self.trim and out and out[-1] == MARK:
            out.pop()
            end = where.pop()
        return "".join(out), np.array([*where, end], np.int64)

    def prefix_of(self, source: bytes, at: int) -> tuple[int, str]:
        """Length of the longest prefix with a replacement (or of one character) and what it becomes."""
        for piece in self.fixed:
            if source.startswith(piece, at):
                return len(piece), piece.decode()
        found = self.map.longest(source, at)
        if found:
            return found[0], found[1].decode()
        n = next(k for k in range(1, 5) if at + k >= len(source) or source[at + k] & 0xC0 != 0x80)
        return n, source[at : at + n].decode()

    def segments(self, norms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Id, first and end character of every piece of normalised texts, and each text's number of pieces.

        Characters are counted through all texts, each text's end as one more.
        """
        split = [self.runs(t) for t in norms] if self.chunked else [[t] for t in norms]
        of_text = np.fromiter(map(len, split), np.int64, len(split))
        runs = list(chain.from_iterable(split))
        found = self.segmenter.encode(runs, num_threads=1, return_type="numpy")
        ids = np.concatenate([np.zeros(0, np.int32), *found])
        first = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))
        moves, byte = self.chars[ids], self.byte[ids]
        # the bytes of one character share its span: only the last one, which no continuation follows, moves on
        moves[byte >= 0] = ((np.append(byte[1:], -1) & 0xC0) != 0x80)[byte >= 0]
        # a run of unknown characters is one piece
        unknown = np.flatnonzero(ids == self.unknown)
        for r in np.unique(np.searchsorted(first, unknown, "right") - 1).tolist():
            surface = np.array([len(x) for x in self.segmenter.encode(runs[r], out_type=str)], np.int64)
            moves[first[r] : first[r + 1]] = np.where(found[r] == self.unknown, surface, moves[first[r] : first[r + 1]])
        at = np.append(0, np.cumsum(moves))
        if (np.diff(at[first]) != np.fromiter(map(len, runs), np.int64, len(runs))).any():
            raise ValueError("pieces do not cover their text")
        last = np.cumsum(of_text)
        counts = first[last] - first[last - of_text]
        begin = at[:-1] + np.repeat(np.arange(len(norms)), counts)
        return ids, begin, begin + np.where(byte >= 0, 1, moves), counts

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the ids of its pieces and where in the source's bytes each begins and ends."""
        for group in groups(texts):
            norms = [self.normalise(t) for t in group]
            ids, begin, end, counts = self.segments([n for n, _ in norms])
            where = np.concatenate([w for _, w in norms])
            begin, end = where[begin], where[end]
            stop = np.cumsum(counts)
            for a, b in zip((stop - counts).tolist(), stop.tolist(), strict=True):
                yield ids[a:b], begin[a:b], end[a:b]

    def spans(self, text: str) -> list[tuple[int, str, int, int]]:
        """Id, piece and source byte span of every piece; the pieces' spans follow each other over the whole text."""
        ids, begin, end = (x.tolist() for x in next(self.encode([text])))
        return [(i, self.piece[i], b, e) for i, b, e in zip(ids, begin, end, strict=True)]


def groups(texts: list[str]) -> Iterator[list[str]]:
    """Up to TEXTS texts at a time, fewer where they have over CHARS characters."""
    first = size = 0
    for k, text in enumerate(texts, 1):
        size += len(text)
        if k - first == TEXTS or size > CHARS or k == len(texts):
            yield texts[first:k]
            first, size = k, 0


@lru_cache(1)
def encoder(model: str) -> Encoder:
    return Encoder(model)


@lru_cache(1)
def decoder(model: str):
    """The library's processor: a task that only decodes loads nothing else."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def token_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count and digest of the ids of each text (an end id last) and digest of the text decoded from these ids.

    One row per input row. Null or empty text: the end id alone, decoding to the empty string. Texts of
    any length are handled whole; repeated rows give repeated rows; other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text"))
    encoded = encode(source, model, "_text", end=True).select(id_col, F.col("pieces.id").alias("ids"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return decode(encoded, model).select(id_col, F.size("ids").cast("long").alias("n_tokens"), sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))


def encode(docs: DataFrame, model: str, text_col: str = "text", end: bool = False) -> DataFrame:
    """Adds ``pieces``: array of (id, piece, begin, end), spans in bytes of the original text. Null text: no pieces.

    end: an end piece with an empty span comes last, also for null text.
    """
    text_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    names = [*docs.columns, "pieces"]

    def run(batches):
        sp = encoder(model)
        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(k, TEXTS)
                found = []
                for ids, begin, stop in sp.encode([t or "" for t in rows.column(at).to_pylist()]):
                    if end:
                        n = stop[-1:] if len(stop) else np.zeros(1, np.int64)
                        ids, begin, stop = np.append(ids, np.int32(sp.eos)), np.append(begin, n), np.append(stop, n)
                    found.append((ids, begin, stop))
                ids, begin, stop = (pa.array(np.concatenate(x).astype(np.int32), pa.int32()) for x in zip(*found, strict=True))
                pieces = pa.StructArray.from_arrays([ids, sp.pieces.take(ids), begin, stop], ["id", "piece", "begin", "end"])
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x[0]) for x in found], out=offsets[1:])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(pa.array(offsets), pieces)], names)

    pieces = T.ArrayType(T.StructType.fromDDL("id int, piece string, begin int, end int"))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("pieces", pieces)]))


def decode(rows: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded``: the text of an array of ids. Null or no ids: the empty string."""

    at, names = rows.columns.index(ids_col), [*rows.columns, "decoded"]

    def run(batches):
        library = decoder(model)
        for batch in batches:
            ids = batch.column(at)
            flat, edge, valid = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False)
            for k in range(0, batch.num_rows, TEXTS):
                part = batch.slice(k, TEXTS)
                rows = range(k, k + part.num_rows)
                texts = [library.decode(flat[edge[r] : edge[r + 1]].tolist()) if valid[r] and edge[r + 1] > edge[r] else "" for r in rows]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


__all__ = ["CharMap", "Encoder", "decode", "encode", "token_digests"]
