r"""Removal of passages that repeat, through a compressed FM-index for each shard.

A window is ``window`` neighbouring words of one document. Its anchor is the run of ``ANCHOR`` words in it whose hash is
least, so that equal windows have equal anchors.

1. Anchors of all windows are written down; those that occur once have no repeated window and are left out.
2. Documents give, for each anchor that repeats, the passage of the windows that have this anchor; it goes to the shard of
   the anchor's hash. An anchor that occurs more than ``hot`` times gives its windows one by one, each to the shard of its
   own hash. Tasks send equal passages as one row with all their places, so that what a third of all documents
   share is not gathered.
3. Each shard indexes its passages in order of place (Burrows-Wheeler transform in a wavelet matrix) and streams them
   against the index: backward search, word by word, gives matching statistics, the length of the longest stretch ending at
   a word that has other places, and its suffixes. Where a passage's last word has the whole passage's length at an earlier
   place, all of it repeats. For the windows of the other passages the statistic goes up to ``window``; where it is reached,
   the earliest place among the suffixes says which windows repeat. A search that comes down to the suffixes of the
   passage's own copies has no earlier place. What begins later than the earliest place (smaller id, or same document and
   earlier start) is reported as an interval.
4. Intervals go back to their documents.

Words are compared as they are, hashes only send them to shards. Defined cases: a null or empty text has no words; a text
of any length is cut whole. Rows without an id come after all others, in the order of a hash of their texts, as rows of one
id with different texts do (ties); rows that repeat both id and text are one document stated several times and get the same
answer. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import cut, scratch, sweep, table, tidy, written
from siltstone.llm.fm_index import FMIndex
from siltstone.llm.words import Words, chunks

ANCHOR = 6
#: A task gathers the places of equal passages up to so many before it sends them on; which it does never shows in a result.
REMEMBERED = 100_000
#: An anchor that occurs more often than this gives its windows one by one.
HOT = 60_000
LAST = 2**63 - 1


def anchor_runs(grams: np.ndarray, low: int, high: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of runs of windows with one anchor, for words low .. high - 1; counted from low."""
    if high - low < window:
        return (np.zeros(0, dtype=np.int64),) * 3
    views = sliding_window_view(grams[low : high - ANCHOR + 1], window - ANCHOR + 1)
    at = views.argmin(axis=1) + np.arange(len(views))
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.append(first[1:], len(at)) - 1


ANCHORS = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("pos", pa.int32())])


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for first, w in chunks(batch.column(1), lower=False):
                grams = w.grams(ANCHOR)
                hs, owners, places = [], [], []
                for i, (a, b) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)):
                    at, _, _ = anchor_runs(grams, a, b, window)
                    hs.append(grams[a + at])
                    owners.append(np.full(len(at), keys[first + i]))
                    places.append(at)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(places).astype(np.int32))], schema=ANCHORS)

    return run


ROUTED = pa.schema([("shard", pa.int32()), ("place", pa.int64()), ("key", pa.int64()), ("version", pa.int64()), ("start", pa.int64()), ("words", pa.binary()), ("more", pa.binary())])
ROUTED_DDL = "shard int, place long, key long, version long, start long, words binary, more binary"


def _passages(window: int, shards: int):
    """Documents with the places of repeated anchors (below zero: very many) -> passages, each with its first place and,
    in ``more``, what other places this task has seen: (place, key, version, start) each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}  # words -> shard and places
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for low in range(0, len(held), 20_000):
                rows = []
                for words, (shard, *places) in list(held.items())[low : low + 20_000]:
                    first, *more = sorted(set(places)) if len(places) > 1 else places
                    rows.append((shard, *first, words, np.array(more, dtype=np.int64).tobytes() if more else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(ROUTED.types)], schema=ROUTED)

        for batch in batches:
            keys, places, versions, wanted = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for first, w in chunks(batch.column(3), lower=False):
                grams, whole = w.grams(ANCHOR), None
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []  # shards, first words, stops, row
                for i, (a, b) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)):
                    at, low, high = anchor_runs(grams, a, b, window)
                    asked = np.array(wanted[first + i], dtype=np.int64)
                    runs = np.isin(at, asked)
                    found.append((grams[a + at[runs]], a + low[runs], a + high[runs] + window, first + i))
                    if (asked < 0).any():
                        single = np.isin(at, -1 - asked[asked < 0])
                        whole = w.grams(window) if whole is None else whole
                        each = np.concatenate([np.arange(s, t + 1) for s, t in zip(low[single].tolist(), high[single].tolist(), strict=True)])
                        found.append((whole[a + each], a + each, a + each + window, first + i))
                names, begin, stop = (np.concatenate([f[k] for f in found]) for k in range(3))
                rows = np.repeat([f[3] for f in found], [len(f[0]) for f in found])
                begins = begin - w.bounds[rows - first]
                for words, shard, row, s in zip(w.texts(begin, stop), (names % np.uint64(shards)).tolist(), rows.tolist(), begins.tolist(), strict=True):
                    place = (places[row], keys[row], versions[row], s)
                    seen = held.get(words)
                    if seen is None:
                        held[words] = [shard, place]
                    else:
                        seen.append(place)
                size += len(begin)
                if size > REMEMBERED:
                    yield from sent()
                    held, size = {}, 0
        yield from sent()

    return run


def _earliest(passages: list[tuple], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For passages (place, key, version, start, words, more) in order of place: those that the index has whole at an earlier
    place; and for each window of the others the passage, the window's start in it, a number for its place, and the number
    of the earliest place that the index has of it."""
    data = b"\n".join([p[4] for p in passages])
    w = Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), lower=False)
    # A separator, 0, behind the words of each passage.
    sizes = np.diff(np.concatenate([[0], np.searchsorted(w.starts, np.flatnonzero(w.data == 0x0A)), [len(w.starts)]]))
    owner = np.repeat(np.arange(len(passages)), sizes)
    symbols = np.zeros(len(owner) + len(passages), dtype=np.int64)
    symbols[np.arange(len(owner)) + owner] = w.numbers() + 1
    stops = np.cumsum(sizes + 1) - 1
    offsets = stops - sizes
    index = FMIndex(symbols)
    # Passages of one document (place and version) have one number; places compare as numbers and starts do.
    document = np.cumsum([i > 0 and p[:3:2] != passages[i - 1][:3:2] for i, p in enumerate(passages)])
    here = document << 32 | np.array([p[3] for p in passages], dtype=np.int64)
    # Whole passages first: where the statistic of the last word is the whole length, the passage has other places.
    lengths, lows, _ = index.matching_statistics(symbols, stops, int(sizes.max()), places=2)
    # Passages of one interval and one length are equal; longer ones that hold them are no copies.
    group = np.where(lengths == sizes, lows * (int(sizes.max()) + 1) + sizes, -1 - np.arange(len(sizes)))
    _, same, numbers = np.unique(group, return_inverse=True, return_counts=True)
    copies = numbers[same]
    best = _least_in(group, here)
    later = np.flatnonzero(best < here)
    # Then windows, of passages at the earliest of their places: they go on while there are other places than copies'.
    counts = sizes - window + 1
    counts[later] = 0
    owner = np.repeat(np.arange(len(sizes)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    lengths, lows, _ = index.matching_statistics(symbols, offsets[owner] + inside + window, window, places=copies[owner] + 1)
    code = here[owner] + inside
    first = code.copy()
    several = np.flatnonzero(lengths == window)
    first[several] = _least_in(lows[several], code[several])
    return later, owner, inside, code, first


def _least_in(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each element the least value in its group."""
    out = values.copy()
    if len(group):
        order = np.argsort(group, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]]))
        out[order] = np.repeat(np.minimum.reduceat(values[order], edges), np.diff(np.append(edges, len(order))))
    return out


def repeats(passages: list[tuple], window: int) -> list[tuple]:
    """(key, version, start, stop) of what repeats among (place, key, version, start, words, more), in order of place."""
    later, owner, inside, code, first = _earliest(passages, window)
    out: list[tuple] = [(p[1], p[2], p[3], p[3] + p[4].count(b" ") + 1) for p in (passages[i] for i in later.tolist())]
    found = np.flatnonzero(first < code)
    if len(found):
        o, r = owner[found], inside[found]
        begin = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (r[1:] != r[:-1] + 1)]))
        last = np.append(begin[1:], len(found)) - 1
        for i, s, t in zip(o[begin].tolist(), r[begin].tolist(), r[last].tolist(), strict=True):
            p = passages[i]
            out.append((p[1], p[2], p[3] + s, p[3] + t + window))
    for p in passages:
        if p[5] is not None:
            # The index has the passage at its first place, and that is earlier than any of these, for all its windows.
            n = p[4].count(b" ") + 1
            out += [(key, version, start, start + n) for _, key, version, start in np.frombuffer(p[5], dtype=np.int64).reshape(-1, 4).tolist()]
    return out


INTERVALS = pa.schema([("key", pa.int64()), ("version", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _shards(window: int):
    """Rows come sorted by shard and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], schema=INTERVALS)

        for batch in batches:
            for name, *passage in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != shard:
                    if held:
                        yield frame(repeats(held, window))
                    shard, held = name, []
                held.append(passage)
        if held:
            yield frame(repeats(held, window))

    return run


CLEAN = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]


def _clean(verbatim: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, texts, spans, *carried = batch.columns
            made: list[tuple[int, int, str]] = []
            ends = np.cumsum(np.concatenate([[0], np.fromiter((n or 0 for n in pc.list_value_length(spans).to_pylist()), dtype=np.int64, count=len(spans))]))
            flat = spans.flatten()
            of, start, stop = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for version, text, low, high in zip(versions.to_pylist(), texts, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                raw = text.as_py() or ""
                words = raw.encode().split()
                keep = np.ones(len(words), dtype=bool)
                if high > low:
                    mine = of[low:high] == version
                    open_ = np.bincount(start[low:high][mine], minlength=len(words) + 1) - np.bincount(stop[low:high][mine], minlength=len(words) + 1)
                    keep = np.cumsum(open_)[:-1] == 0
                left = words if keep.all() else list(compress(words, keep.tolist()))
                made.append((len(words), len(words) - len(left), raw if verbatim and left is words else b" ".join(left).decode()))
            out = [ids, *(pa.array([m[i] for m in made], t) for i, (_, t) in enumerate(CLEAN[1:]))]
            yield pa.RecordBatch.from_arrays(out + carried, names=[n for n, _ in CLEAN] + ["carried"] * len(carried))

    return run


def repeated_intervals(base: DataFrame, window: int, shard_passages: int, hot: int) -> DataFrame:
    """(key, version, start, stop) of words to remove, for base (key, doc_id, version, text)."""
    spark = base.sparkSession
    with scratch(spark, "anchors") as path:
        anchors = written(base.select("key", "text").mapInArrow(tidy(_anchors(window)), "h long, key long, pos int"), f"{path}/all")
        often = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("h").alias("g"), (F.col("n") > hot).alias("hot"))
        # Written down, so that the places of an anchor that very many have can be split over tasks when they are joined.
        often = written(often, f"{path}/often")
        pos = F.when(F.col("hot"), -1 - F.col("pos")).otherwise(F.col("pos"))
        places = anchors.join(often, F.col("h") == F.col("g")).groupBy("key").agg(F.collect_list(pos).alias("wanted"))
        places = cut(places.withColumnRenamed("key", "of"))
        total = places.agg(F.coalesce(F.sum(F.size("wanted").cast("long")), F.lit(0))).first()[0]
    # Shuffle files of the step before go as soon as nothing refers to them.
    del anchors, often
    sweep(spark)
    shards = max(1, -(-total // shard_passages))
    place = F.coalesce("doc_id", F.lit(LAST)).alias("place")
    rows = base.join(places, F.col("key") == F.col("of")).select("key", place, "version", "text", "wanted", *(["carried"] if "carried" in base.columns else []))
    routed = rows.mapInArrow(tidy(_passages(window, shards)), ROUTED_DDL)
    return routed.repartition("shard").sortWithinPartitions("shard", "place", "version", "start").mapInArrow(tidy(_shards(window)), "key long, version long, start long, stop long")


def remove_repeats(docs: DataFrame, window: int = 20, shard_passages: int = 20_000, hot: int = HOT, id_column: str = "doc_id", text_column: str = "text", carry: Sequence[str] = (), verbatim: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row: ``kept`` are the words that stay, joined by one space.

    ``carry`` names columns that come along in a struct ``carried``; with ``verbatim``, texts that lose nothing stay as they are.
    """
    if window <= ANCHOR:
        raise ValueError(f"a window has more than {ANCHOR} words")
    text, doc_id = F.coalesce(docs[text_column], F.lit("")), docs[id_column].cast("long")
    # Rows of one id are told apart by a hash of their texts; where no two rows have one id, that says nothing and is left out.
    unique = docs.filter(doc_id.isNotNull()).groupBy(doc_id.alias("i")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
    hashed = F.xxhash64(text)
    version = F.when(doc_id.isNotNull(), F.lit(0).cast("long")).otherwise(hashed) if unique else hashed
    # Both joins below take the same columns, so that Spark shuffles the texts once.
    base = docs.select(F.coalesce(doc_id, hashed).alias("key"), doc_id.alias("doc_id"), version.alias("version"), text.alias("text"), *([F.struct(*[docs[c] for c in carry]).alias("carried")] if carry else []))
    found = repeated_intervals(base, window, shard_passages, hot)
    spans = found.groupBy("key").agg(F.collect_list(F.struct("version", F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"))).alias("spans")).withColumnRenamed("key", "of")
    rows = base.join(spans, F.col("key") == F.col("of"), "left").select("doc_id", "version", "text", "spans", *(["carried"] if carry else []))
    kind = f", carried {base.schema['carried'].dataType.simpleString()}" if carry else ""
    return rows.mapInArrow(tidy(_clean(verbatim)), f"doc_id long, n_words long, n_removed long, kept string{kind}")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows of 20 that start earlier elsewhere."""
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))



SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
repeats AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM repeats),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
