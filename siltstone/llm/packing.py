"""Packing token sequences into windows by non-negative least squares over length combinations.

Documents are tokenised, closed by an end id, and cut into whole windows and a rest; a rest of more than half a window
gives half a window first, since long rests leave gaps that are hard to fill. Whole windows are sequences as they are.
For the rests, the driver has only their histogram by length (at most ``window`` rows, whatever the corpus is): it lists shallow combinations of lengths that fill a window, solves for how often to repeat each so that the histogram is
matched in the least-squares sense without negative counts, rounds down, and packs what is left greedily, largest first.
The plan says which ranks of which length go where; pieces are ranked within their length by bucketed counts.

The ids are those of the ``tokenizers`` file ``byte_bpe_50k.json``: its added token is one id wherever its string stands
in a text. A chunk between single spaces is encoded once in each worker and remembered; new chunks go through the same
vocabulary's rank file, whose ids are the same (tested).

Defined cases: a null text is empty and gives the end id alone. A text of any length is encoded whole and cut into as many
pieces as it takes. Rows that repeat an id, or have none, are packed as documents of their own; pieces that are equal in
all columns (ties) get places of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import cut, dense_rank_in, steps, table, tidy

WINDOW = 2048
END_ID = 1
CACHE = 200_000
TEXTS_AT_ONCE = 200


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts as little-endian uint16 bytes, with a bounded memory of chunks.

    A single space between two characters that aren't white space always begins a token of the vocabulary's splitting
    rule, so a text may be cut in front of it. New chunks of some texts are encoded in one call and told apart by the
    byte lengths of their tokens.
    """

    JOINT = re.compile(r"(?<=\S) (?=\S)")
    #: Two white-space characters in a row, or any but the space and the line feed.
    ODD = ("  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))

    def __init__(self, ranks_path: str | None = None, json_path: str | None = None):
        import public_tokenizers
        import tiktoken

        with open(json_path or tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("only added tokens that stand for their string alone are supported")
        self.added = {t["content"]: np.array([t["id"]], dtype="<u2").tobytes() for t in added}
        self.split = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        with open(ranks_path or tokenizer_path(), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.seen: dict[str, bytes] = {}

    def odd(self, text: str) -> bool:
        return text[:1].isspace() or text[-1:].isspace() or any(x in text for x in self.ODD)

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u2").tobytes()

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of each chunk as it is after a space."""
        ids = self.encoding.encode_to_numpy(" " + " ".join(chunks)).astype("<u2")
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        at = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        low = 0
        for chunk, high in zip(chunks, at.tolist(), strict=True):
            self.seen[chunk] = ids[low:high].tobytes()
            low = high

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; what stands between added tokens is encoded as a text of its own."""
        if not any(token in t for token in self.added for t in texts):
            return self.ordinary(texts)
        parts = [self.split.split(t) for t in texts]
        found = iter(self.ordinary([p for ps in parts for p in ps]))
        out = []
        for text, ps in zip(texts, parts, strict=True):
            between = [self.added[token] for token in self.split.findall(text)]
            out.append(b"".join(x for pair in zip((next(found) for _ in ps), [*between, b""], strict=True) for x in pair))
        return out

    def ordinary(self, texts: list[str]) -> list[bytes]:
        if len(self.seen) >= CACHE:
            self.seen.clear()
        cut_up = [self.JOINT.split(t) if self.odd(t) else t.split(" ") for t in texts]
        seen = self.seen
        new = set().union(*(chunks[1:] for chunks in cut_up)).difference(seen.keys())
        # The last chunk of a text may end in white space; its tokens are not cut off by what follows in a joint call.
        for c in [chunks[-1] for chunks in cut_up if chunks[-1][-1:].isspace()]:
            if c in new:
                new.discard(c)
                seen[c] = self.plain(" " + c)
        if new:
            self.learn(list(new))
        return [self.plain(chunks[0]) + b"".join(map(seen.__getitem__, chunks[1:])) for chunks in cut_up]


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def pieces(docs: DataFrame, window: int = WINDOW, ranks_path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each whole window and each rest of every document."""

    half = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path)
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(low, TEXTS_AT_ONCE)
                out: list[tuple] = []
                for doc_id, found in zip(part.column(0).to_pylist(), encoder.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids = np.append(np.frombuffer(found, dtype="<u2").astype("<u4"), np.array([END_ID], dtype="<u4"))
                    starts = list(range(0, len(ids), window))
                    if len(ids) - starts[-1] > half and len(ids) - starts[-1] < window:
                        starts.append(starts[-1] + half)
                    for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
                        out.append((doc_id, start, end - start, zlib.crc32(ids[start:end].tobytes()), len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*out, strict=True), PIECES.types, strict=True)], schema=PIECES)

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# ---- the plan, on the driver; its size depends on the window only


def combinations(counts: np.ndarray, window: int, slack: int, most: int) -> list[tuple[int, ...]]:
    """Pairs and triples of present lengths that fill the window up to ``slack``; the tightest ``most`` of them."""
    present = np.flatnonzero(counts)
    if not len(present):
        return []
    by_count = sorted(present.tolist(), key=lambda x: (-counts[x], x))
    best = lambda space: int(present[i - 1]) if (i := np.searchsorted(present, space, "right")) else 0
    found: set[tuple[int, ...]] = set()
    for a in present.tolist():
        b = best(window - a)
        if b and window - a - b <= slack:
            found.add(tuple(sorted((a, b), reverse=True)))
    for i, a in enumerate(by_count[:128]):
        for b in by_count[i:128]:
            c = best(window - a - b) if a + b < window else 0
            if c and window - a - b - c <= slack:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, key=lambda x: (window - sum(x), len(x), x))[:most]


def non_negative_least_squares(columns: list[tuple[int, ...]], target: np.ndarray, sweeps: int = 40) -> list[float]:
    """Coordinate descent for min |A x - target|, x >= 0, where column j counts the lengths of combination j."""
    residual = target.astype(float).tolist()
    x = [0.0] * len(columns)
    weights = [{a: c.count(a) for a in set(c)} for c in columns]
    norms = [sum(w * w for w in c.values()) for c in weights]
    for _ in range(sweeps):
        moved = 0.0
        for j, c in enumerate(weights):
            new = max(0.0, x[j] + sum(w * residual[a] for a, w in c.items()) / norms[j])
            step = new - x[j]
            if step:
                x[j] = new
                moved = max(moved, abs(step))
                for a, w in c.items():
                    residual[a] -= w * step
        if moved < 0.25:
            break
    return x


def plan(counts: dict[int, int], window: int = WINDOW, slack: int = 4, most: int = 4000) -> list[tuple[tuple[int, ...], int]]:
    """(combination, how often) pairs that use every piece of ``counts`` (by length, below ``window``) exactly once."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    out: list[tuple[tuple[int, ...], int]] = []

    def use(combo: tuple[int, ...], times: int) -> None:
        for a in combo:
            left[a] -= times
        out.append((combo, times))

    combos = combinations(left, window, slack, most)
    for combo, x in zip(combos, non_negative_least_squares(combos, left), strict=True):
        times = min(int(x), *(int(left[a]) // combo.count(a) for a in combo))
        if times > 0:
            use(combo, times)
    while left.any():
        combo: list[int] = []
        space, free = window, left.copy()
        while (fits := np.flatnonzero(free[: space + 1])).size:
            combo.append(int(fits[-1]))
            free[fits[-1]] -= 1
            space -= int(fits[-1])
        use(tuple(combo), min(int(left[a]) // combo.count(a) for a in combo))
    return out


def placements(steps: list[tuple[tuple[int, ...], int]], first_sequence: int) -> list[tuple[int, int, int, int, int]]:
    """(length, from rank, to rank, sequence of the first, offset) rows."""
    used: dict[int, int] = {}
    out, base = [], first_sequence
    for combo, times in steps:
        offset = 0
        for a in combo:
            low = used.get(a, 0)
            out.append((a, low, low + times, base, offset))
            used[a] = low + times
            offset += a
        base += times
    return out


def pack(docs: DataFrame, window: int = WINDOW, ranks_path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset that each has."""
    spark = docs.sparkSession
    with steps(spark) as result:
        cuts = cut(pieces(docs, window, ranks_path, id_column, text_column))
        counts = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
        whole = counts.pop(window, 0)
        rows = placements(plan(counts, window), whole)
        if whole:
            rows.append((window, 0, whole, 0, 0))
        places = spark.createDataFrame(rows, "at_length long, low long, high long, base long, offset long")
        ranked = dense_rank_in(cuts, ["length"], F.struct("doc_id", "start", "ids_crc32"), whole + sum(counts.values()), "rank")
        on = (ranked["length"] == places["at_length"]) & (ranked["rank"] >= places["low"]) & (ranked["rank"] < places["high"])
        joined = ranked.join(F.broadcast(places), on)
        return result(joined.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack(table(spark, sf_dir, "documents"))
