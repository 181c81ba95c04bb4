"""SentencePiece encoding by Viterbi over a trie of distinct words, and decoding.

A text gets a leading space and spaces become U+2581. No piece of the vocabulary goes on after a mark that follows
another character, so the best segmentation of a text is that of its marked words, one after another. The distinct words
of some texts are sorted, which is the depth-first order of their trie, and forward scores of a prefix are kept while the
next word shares it. A piece wins by its score; of equal sums the longer last piece wins. Characters that no piece covers
become their UTF-8 bytes' pieces. The model file is read here; its scores are used as those of a unigram model.

Defined cases: a null or empty text has no ids and decodes to nothing; a text of any length is encoded whole. U+2581 in a
text is a space, as in the library. Rows that repeat, or have no id, are encoded one by one. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table, tidy

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE = 400_000
TEXTS_AT_ONCE = 500


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Vocabulary:
    """Pieces, scores and bytes of a model file without a normalisation table."""

    def __init__(self, path: str):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: dict[str, tuple[float, int]] = {}
        self.bytes = [-1] * 256
        least = 0.0
        with open(path, "rb") as f:
            data = f.read()
        for field, value in wire(data):
            if field == 1:
                parts = dict(wire(value))
                piece, kind = parts[1].decode(), parts.get(3, NORMAL)
                score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
                i = len(self.pieces)
                self.pieces.append(piece)
                self.kinds.append(kind)
                if kind == NORMAL:
                    self.scores[piece] = (score, i)
                    least = min(least, score)
                elif kind == BYTE:
                    self.bytes[int(piece[3:5], 16)] = i
                elif kind == UNKNOWN:
                    self.unknown = i
            elif field == 3:
                parts = dict(wire(value))
                if parts.get(2) or not parts.get(3, 1) or parts.get(4, 1) or not parts.get(5, 1):
                    raise ValueError("only models with identity normalisation and a leading space are supported")
        if any(MARK in p.lstrip(MARK) for p in self.scores):
            raise ValueError("a piece goes on after a mark inside")
        self.unknown_score = least - 10.0
        # By the last two characters of a piece, how long pieces with that end are, the longest first.
        lengths: dict[str, set[int]] = {}
        for p in self.scores:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        self.lengths = {end: sorted(found, reverse=True) for end, found in lengths.items()}
        # What each id decodes to, as bytes.
        self.letters = [bytes([int(p[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else b"" if k == CONTROL else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]

    def fallback(self, char: str) -> list[int]:
        found = [self.bytes[b] for b in char.encode()]
        return [self.unknown] if -1 in found else found


def words(text: str) -> list[str]:
    """Marked words of a text: marks and what follows up to the next mark after another character."""
    if not text:
        return []
    marked = (MARK + text).replace(" ", MARK)
    out, held = [], ""
    for part in marked.split(MARK)[1:]:
        held += MARK
        if part:
            out.append(held + part)
            held = ""
    return out + [held] * bool(held)


def unmarked(text: str) -> list[str]:
    """The marked words of a text, each without its first mark; single spaces need no closer look."""
    if not text or MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return [w[1:] for w in words(text)]
    return text.split(" ")


def segment(distinct: list[str], vocabulary: Vocabulary) -> dict[str, list[int]]:
    """Ids of each of the sorted words, by one walk through their trie."""
    scores, lengths, unknown = vocabulary.scores, vocabulary.lengths, vocabulary.unknown_score
    best: list[float] = [0.0]
    back: list[tuple[int, int]] = [(0, 0)]  # start and piece of the last step; piece -1: bytes
    out: dict[str, list[int]] = {}
    before = ""
    for word in distinct:
        same = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            same += 1
        del best[same + 1 :], back[same + 1 :]
        for end in range(same + 1, len(word) + 1):
            top, step = float("-inf"), (0, 0)
            for n in lengths.get(word[end - 2 : end], ()) if end > 1 else ():
                if n <= end and (piece := scores.get(word[end - n : end])) is not None and best[end - n] + piece[0] > top:
                    top, step = best[end - n] + piece[0], (end - n, piece[1])
            score, one = scores.get(word[end - 1], (unknown, -1))
            if best[end - 1] + score > top:
                top, step = best[end - 1] + score, (end - 1, one)
            best.append(top)
            back.append(step)
        ids: list[int] = []
        at = len(word)
        while at:
            start, piece = back[at]
            ids.extend(reversed(vocabulary.fallback(word[start]))) if piece < 0 else ids.append(piece)
            at = start
        ids.reverse()
        out[word] = ids
        before = word
    return out


class Codec:
    """Encodes and decodes texts; segmented words are remembered, up to ``CACHE`` of them."""

    def __init__(self, path: str | None = None):
        self.vocabulary = Vocabulary(path or model_path())
        self.seen: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.seen) >= CACHE:
            self.seen.clear()
        cut_up = [unmarked(t) for t in texts]
        new = set().union(*cut_up).difference(self.seen.keys())
        for word, ids in segment(sorted(MARK + w for w in new), self.vocabulary).items():
            self.seen[word[1:]] = array("i", ids).tobytes()
        return [np.frombuffer(b"".join(map(self.seen.__getitem__, w)), dtype="<i4") for w in cut_up]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.vocabulary.letters.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encode_documents(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, ids, decoded): whole texts as piece ids; ``decoded`` is read back from the ids if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(low, TEXTS_AT_ONCE)
                found = codec.encode([t or "" for t in part.column(1).to_pylist()])
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype("int32")
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                back = [codec.decode(x.tolist()) for x in found] if decode else [None] * len(found)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(back, type=pa.string())], schema=ENCODED)

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, ids array<int>, decoded string")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            texts = [codec.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, "doc_id long, text string")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and the digest of the text that they decode to."""
    rows = encode_documents(table(spark, sf_dir, "documents"), decode=True)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


