r"""Near-duplicate groups by a chosen-path similarity join over word shingles.

1. Each text becomes its set of hashed shingles, minwise values of the set, and a digest of the set. Equal sets form a
   class; only classes are joined, so copies cost nothing further.
2. Independent trees (as many as ``recall`` asks for) put each class into a node by one minwise token. Members of a node
   of at most ``small`` are compared exhaustively by their minwise values. In a larger one all are compared with its most
   typical member: those that are like it are linked with it and need no comparison among each other. The rest is compared
   with all, block by block, if it is of at most ten blocks. Else the node chooses more tokens, which no other tree and no
   other level has, and branches; what can't be compared after ``depth`` levels shares so many chosen tokens that all of its
   members are candidates of each other. What is found are candidate groups, as forests.
3. Candidate groups are confirmed on full sets by exact intersection sizes: every two members of a group of at most
   ``block``; in a larger one all with the most typical member, and then those that are not linked with it with all, so
   that no task holds more than two blocks. Each comparison keeps a spanning forest of its links, and components of those
   are the result.

Two sets with similarity at the threshold are missed with a probability of at most 1 - ``recall`` by the trees, and of
about 6e-8 by the comparison of minwise values, whose bound lies 5.3 standard deviations below the threshold.

Defined cases: a null or empty text has no set and is linked with nothing; a text of any length is taken whole. A text of
fewer words than a shingle is one shingle. Rows without an id take part in nothing: their component is null and they are
kept. Rows that repeat an id are documents of their own, with that id. Of equal sets, and of a component, the smallest id
stands for all (ties). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import cut, discard, light, sieve, steps, sweep, table, tidy
from siltstone.llm.components import components, forest
from siltstone.llm.words import chunks, mix

#: Minwise values for comparison (16 bits each), of which the first TOKENS are kept with 32 bits to name nodes.
VALUES, TOKENS = 128, 72
BRANCHES = 2
#: In a large node, what is not like its typical member is compared with all members if it is of at most so many blocks.
REST = 10

_rng = np.random.default_rng(64)
_XOR = _rng.integers(0, 2**64, VALUES, dtype=np.uint64)[:, None]
_TIMES = (_rng.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a string column."""
    for _, w in chunks(column, lower=True):
        grams = w.grams(k)
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(grams[a : b - k + 1])
            elif b > a:
                h = np.uint64(b - a)
                for x in w.hashes[a:b]:
                    h = mix(np.array([h * np.uint64(5) + x], dtype=np.uint64))[0]
                yield np.array([h], dtype=np.uint64)
            else:
                yield np.zeros(0, dtype=np.uint64)


def minwise(values: np.ndarray) -> tuple[bytes, bytes]:
    """The least values under each of the random maps: 16 bits of all, and 32 bits of the first ones."""
    best = np.full(VALUES, 2**64 - 1, dtype=np.uint64)
    for low in range(0, len(values), 2048):
        np.minimum(best, ((values[low : low + 2048] ^ _XOR) * _TIMES).min(axis=1), out=best)
    return (best >> np.uint64(16)).astype("<u2").tobytes(), (best[:TOKENS] >> np.uint64(32)).astype("<u4").tobytes()


def digest(values: np.ndarray) -> bytes:
    """Sixteen bytes that stand for a set."""
    with np.errstate(over="ignore"):
        return np.array([mix(values + np.uint64(1)).sum(dtype=np.uint64), mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], dtype="<u8").tobytes()


SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set", pa.binary()), ("mins", pa.binary()), ("tokens", pa.binary())])


def sketches(docs: DataFrame, k: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n, set, mins, tokens) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(len(s), digest(s), *(minwise(s) if len(s) else (None, None))) for s in sets(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in out], SKETCH.types[i + 1]) for i in range(4))], schema=SKETCH)

    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, n long, set binary, mins binary, tokens binary")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(least: int, num: int, den: int):
    """Exhaustive comparison inside nodes, by minwise values; rows come sorted by node."""

    def found(rows: list[tuple[int, list, list, list]]) -> tuple[list[int], list[int]]:
        """Nodes together: all their pairs at once."""
        ids = np.concatenate([r[0] for r in rows])
        sizes = np.concatenate([r[1] for r in rows])
        mins = np.vstack([r[2] for r in rows])
        firsts, seconds, base = [], [], 0
        for r in rows:
            i, j = np.triu_indices(len(r[0]), 1)
            firsts.append(i + base)
            seconds.append(j + base)
            base += len(r[0])
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        near = den * np.minimum(sizes[i], sizes[j]) >= num * np.maximum(sizes[i], sizes[j])
        i, j = i[near], j[near]
        ok = np.zeros(len(i), dtype=bool)
        for low in range(0, len(i), 50_000):
            part = slice(low, low + 50_000)
            ok[part] = (mins[i[part]] == mins[j[part]]).sum(axis=1) >= least
        label = forest(i[ok], j[ok], len(ids))
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return ids[moved].tolist(), ids[label[moved]].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list, list, list]] = []
        pairs, node, ids, sizes, mins = 0, None, [], [], []

        def close() -> None:
            nonlocal pairs
            if len(ids) > 1:
                held.append((np.array(ids), np.array(sizes), np.array(mins)))
                pairs += len(ids) * (len(ids) - 1) // 2

        for batch in batches:
            values = [np.frombuffer(x, dtype=np.uint16) for x in batch.column(3).to_pylist()]
            for key, i, n, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), values, strict=True):
                if key != node:
                    close()
                    node, ids, sizes, mins = key, [], [], []
                    if pairs > 100_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found(held)], schema=LINKS)
                        held, pairs = [], 0
                ids.append(i)
                sizes.append(n)
                mins.append(m)
        close()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found(held)], schema=LINKS)

    return run


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most typical row of each group (grp, mins, ...), whose rows come together: the one that agrees most with the
    minwise values that most of them have. Which one it is bears on the work only, never on the result."""

    def best(rows: list[tuple]) -> tuple:
        mins = np.array([np.frombuffer(r[1], dtype=np.uint16) for r in rows])
        usual = np.zeros(VALUES, dtype=np.uint16)
        for i in range(VALUES):
            values, counts = np.unique(mins[:, i], return_counts=True)
            usual[i] = values[counts.argmax()]
        return rows[int((mins == usual).sum(axis=1).argmax())]

    held: list[tuple] = []
    for batch in batches:
        chosen: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][0] != row[0]:
                chosen.append(best(held))
                held = []
            held.append(row)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in chosen], t) for i, t in enumerate(batch.schema.types)], schema=batch.schema)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(best(held), batch.schema.types, strict=True)], schema=batch.schema)


def pivots(members: DataFrame, *carry: str) -> DataFrame:
    """A typical member (grp, mins, blocks, cls, carried columns) of each group, looked for in the block that ``first`` is in."""
    near = members.filter(F.pmod(F.xxhash64("cls"), F.col("blocks")) == F.pmod(F.xxhash64("first"), F.col("blocks")))
    near = near.select("grp", "mins", "blocks", "cls", *carry)
    return near.repartition("grp").sortWithinPartitions("grp", "cls").mapInArrow(tidy(_pick), near.schema)


ANSWERS = pa.schema([("grp", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("mins", pa.binary())])
ANSWERS_DDL = "grp long, a long, b long, n long, mins binary"


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(ANSWERS.types)], schema=ANSWERS)


def _against(least: int, num: int, den: int, rest: bool):
    """Members (kind 1) of a task against its first rows (kind 0), by minwise values: links (grp, a, b) as a forest; with
    ``rest``, (grp, a, null, n, mins) for members that are linked with none."""

    def found(first: list[tuple], members: list[tuple]) -> list[tuple]:
        ids = np.array([r[3] for r in first + members])
        sizes = np.array([r[4] for r in members])
        mins = np.array([np.frombuffer(r[5], dtype=np.uint16) for r in members])
        ends: list[tuple[np.ndarray, int]] = []
        for i, r in enumerate(first):
            alike = (den * np.minimum(sizes, r[4]) >= num * np.maximum(sizes, r[4])) & ((mins == np.frombuffer(r[5], dtype=np.uint16)).sum(axis=1) >= least)
            ends.append((np.flatnonzero(alike) + len(first), i))
        b = np.concatenate([e for e, _ in ends])
        a = np.repeat([i for _, i in ends], [len(e) for e, _ in ends])
        return _labels(ids, first + members, a, b, len(first) if rest else 0, True)

    return _by_task(found)


def _labels(ids: np.ndarray, rows: list[tuple], a: np.ndarray, b: np.ndarray, first: int, carry: bool) -> list[tuple]:
    """Links of rows (task, grp, kind, cls, ...) as a forest, and those behind the ``first`` that are linked with none."""
    label = forest(a, b, len(ids))
    out = [(rows[i][1], int(ids[i]), int(ids[label[i]]), None, None) for i in np.flatnonzero(ids != ids[label]).tolist()]
    if first:
        linked = np.zeros(len(ids), dtype=bool)
        linked[b] = True
        alone = [i for i in (np.flatnonzero(~linked[first:]) + first).tolist() if ids[i] not in ids[:first]]
        out += [(rows[i][1], int(ids[i]), None, *(rows[i][4:6] if carry else (None, None))) for i in alone]
    return out


def _by_task(found):
    """Rows (task, grp, kind, cls, ...) come sorted by task and kind; ``found`` gets those of kind 0 and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != task:
                    if rows:
                        out += found([r for r in rows if r[2] == 0], [r for r in rows if r[2]])
                    task, rows = row[0], []
                rows.append(row)
            if out:
                yield _answers(out)
        if rows:
            yield _answers(found([r for r in rows if r[2] == 0], [r for r in rows if r[2]]))

    return run


def token(i: Column):
    return F.substring("tokens", i * 4 + 1, 4)


def _own(blocks: str = "blocks") -> Column:
    return F.pmod(F.xxhash64("cls"), F.col(blocks)).cast("int")


def _all(blocks: str) -> Column:
    return F.sequence(F.lit(0), F.col(blocks) - 1)


def _large_nodes(members: DataFrame, least: int, num: int, den: int, small: int) -> tuple[DataFrame, DataFrame]:
    """Links of large nodes, and the nodes (``many``) whose pairs are not all compared by them.

    All members are compared with the node's typical one. Those that are like it are linked, so that no two of them need a
    comparison; the rest, if it is of at most ``REST`` blocks, is compared with all.
    """
    run = lambda rows, rest: rows.repartition("task").sortWithinPartitions("task", "kind", "cls").mapInArrow(tidy(_against(least, num, den, rest)), ANSWERS_DDL)
    columns = (F.xxhash64("grp", "block").alias("task"), "grp", "kind", "cls", "n", "mins")
    ours = members.withColumn("block", _own()).withColumn("kind", F.lit(1)).select(*columns)
    one = cut(pivots(members, "n"))
    marks = cut(run(ours.unionByName(one.withColumn("block", F.explode(_all("blocks"))).withColumn("kind", F.lit(0)).select(*columns)), True))
    left = marks.filter("b IS NULL")
    # A row for each large node at most.
    counts = left.groupBy(F.col("grp").alias("g")).agg(F.count(F.lit(1)).alias("others")).join(light(one.select("grp", "blocks")), F.col("g") == F.col("grp")).select("g", "others", "blocks")
    counts = light(cut(counts))
    few = counts.filter(F.col("others") <= REST * small)
    inside = members.withColumn("block", _own()).withColumn("kind", F.lit(1)).join(few, F.col("grp") == F.col("g"), "left_semi").select(*columns)
    rest = left.join(few, F.col("grp") == F.col("g")).withColumn("block", F.explode(_all("blocks"))).withColumn("kind", F.lit(0)).withColumn("cls", F.col("a")).select(*columns)
    links = marks.filter("b IS NOT NULL").select("a", "b").unionByName(run(inside.unionByName(rest), False).select("a", "b"))
    return links, counts.filter(F.col("others") > REST * small).select("g")


def candidates(classes: DataFrame, num: int, den: int, recall: float, small: int, depth: int) -> DataFrame:
    """Links (a, b), as forests, between classes (cls, n, mins, tokens) that a node of some tree found alike."""
    share = num / den
    # A pair at the threshold stays together in a tree by its first token and, in large nodes, by one of the next ones.
    stays = share * (1 - (1 - share) ** BRANCHES) ** (depth - 1)
    trees = max(1, math.ceil(math.log(1 - recall) / math.log(1 - stays)))
    least = max(1, math.floor(VALUES * share - 5.3 * math.sqrt(VALUES * share * (1 - share))))
    if trees * (1 + (depth - 1) * BRANCHES) > TOKENS:
        raise ValueError("too many trees for the tokens kept")
    keys = F.array(*[F.struct(F.lit(t).alias("tree"), F.xxhash64(F.lit(t), token(F.lit(t))).alias("node")) for t in range(trees)])
    nodes = classes.select("cls", F.explode(keys).alias("at")).select("cls", "at.tree", "at.node")
    links = None
    inner = classes.select(F.col("cls").alias("c"), "n", "mins")
    for level in range(depth):
        x = F.xxhash64("cls"), F.xxhash64("cls", F.lit(1))
        counts = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("members"), F.min("cls").alias("first"), F.bit_xor(x[0]).alias("x"), F.bit_xor(x[1]).alias("y")).filter("members > 1")
        # Nodes of equal members are one node, but for those that branch: each has the tokens of its own tree.
        own = F.when(F.col("members") > small, F.col("node"))
        # Written down, so that a node that many classes are in can be split over tasks when it is joined.
        counts = cut(counts.groupBy("members", "first", "x", "y", own.alias("own")).agg(F.min("node").alias("key")).select("key", "members", "first"))
        shared = cut(nodes.join(counts, F.col("node") == F.col("key")).select("node", "tree", "cls", "members", "first"))
        rows = shared.filter(F.col("members") <= small).join(inner, F.col("cls") == F.col("c")).select("node", "cls", "n", "mins")
        part = rows.repartition("node").sortWithinPartitions("node", "cls").mapInArrow(tidy(_compare(least, num, den)), "a long, b long")
        large = shared.filter(F.col("members") > small)
        over = None
        if not large.isEmpty():
            blocks = F.ceil(F.col("members") / small).cast("int").alias("blocks")
            more = cut(large.join(inner, F.col("cls") == F.col("c")).select(F.col("node").alias("grp"), "tree", "cls", "first", blocks, "n", "mins"))
            found, many = _large_nodes(more, least, num, den, small)
            part = part.unionByName(found)
            if not many.isEmpty():
                over = cut(more.join(many, F.col("grp") == F.col("g"), "left_semi"))
                if level == depth - 1:
                    # Their members share ``depth`` chosen tokens: all are candidates.
                    part = part.unionByName(over.filter("cls != first").select(F.col("cls").alias("a"), F.col("first").alias("b")))
        part = cut(part)
        links = part if links is None else links.unionByName(part)
        if over is None or level == depth - 1:
            break
        at = [F.lit(trees + BRANCHES * level + b) + F.col("tree") * (BRANCHES * (depth - 1)) for b in range(BRANCHES)]
        next_ = F.array(*[F.xxhash64(F.col("grp"), i, token(i)) for i in at])
        named = classes.select(F.col("cls").alias("c"), "tokens")
        nodes = cut(over.select("grp", "tree", "cls").join(named, F.col("cls") == F.col("c")).select("cls", "tree", F.explode(next_).alias("node")))
        sweep(classes.sparkSession)
    return links


def _confirm(num: int, den: int, rest: bool):
    """Exact links inside tasks (task, grp, kind, cls, shingles): those of kind 0 with all others, or all with all where
    there is none of kind 0."""

    def found(first: list[tuple], members: list[tuple]) -> list[tuple]:
        rows = first + members
        sets_ = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
        sizes = np.array([len(m) for m in sets_])
        values, where = np.unique(np.concatenate(sets_), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(where, kind="stable")
        where, owner = where[order], owner[order]
        low_rows = slice(0, len(first) or len(rows))
        common = np.zeros((low_rows.stop, len(rows)), dtype=np.float32)
        step = max(256, 4_000_000 // len(rows))
        for low in range(0, len(values), step):
            a, b = np.searchsorted(where, [low, low + step])
            part = np.zeros((len(rows), min(step, len(values) - low)), dtype=np.float32)
            part[owner[a:b], where[a:b] - low] = 1
            common += part[low_rows] @ part.T
        union = sizes[low_rows, None] + sizes[None, :] - common
        i, j = np.nonzero(den * common.astype(np.int64) >= num * union)
        keep = i != j
        return _labels(np.array([r[3] for r in rows]), rows, i[keep], j[keep], len(first) if rest else 0, False)

    return _by_task(found)


def _full_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cls, grp, tasks, shingles) of the rows whose set is the one that is looked for."""
        for batch in batches:
            keep, raw = [], []
            for i, (want, s) in enumerate(zip(batch.column(3).to_pylist(), sets(batch.column(4), k), strict=True)):
                if digest(s) == want:
                    keep.append(i)
                    raw.append(s.tobytes())
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in range(3)] + [pa.array(raw, pa.binary())], names=["cls", "grp", "tasks", "shingles"])

    return run


def confirmed(docs: DataFrame, classes: DataFrame, groups: DataFrame, k: int, num: int, den: int, block: int, id_column: str, text_column: str) -> DataFrame:
    """Exact links (a, b), as forests, inside candidate groups (node, root).

    A group of at most ``block`` members is one task, all with all. In a larger one all are compared with a typical member,
    and the rest that is not linked with it with all, in tasks of two blocks at most.
    """
    kind = "array<struct<task:bigint,kind:int>>"
    texts = docs.select(docs[id_column].cast("long").alias("text_id"), docs[text_column].alias("text"))

    def compared(wanted: DataFrame, rest: bool) -> DataFrame:
        """``wanted`` (cls, rep, set, grp, tasks): sets are made once for each row and sent to its tasks."""
        wanted = cut(wanted)
        rows = sieve(texts, "text_id", wanted, "rep").join(wanted, F.col("text_id") == F.col("rep")).select("cls", "grp", "tasks", "set", "text")
        full = rows.mapInArrow(tidy(_full_sets(k)), f"cls long, grp long, tasks {kind}, shingles binary")
        dealt = full.select("cls", "grp", F.explode("tasks").alias("t"), "shingles").select("t.task", "grp", "t.kind", "cls", "shingles")
        # One document may have several rows, and a class may come twice: that adds nothing.
        return cut(dealt.repartition("task").sortWithinPartitions("task", "kind", "cls").mapInArrow(tidy(_confirm(num, den, rest)), ANSWERS_DDL))

    roots = groups.select("root").distinct().select(F.col("root").alias("node"), "root")
    members = cut(groups.unionByName(roots))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > block)
    sizes = light(cut(sizes.select(F.col("root").alias("r"), F.ceil(F.col("size") / block).cast("int").alias("parts"))))
    named = members.join(sizes, F.col("root") == F.col("r"), "left").withColumn("blocks", F.coalesce("parts", F.lit(1)))
    mins = F.when(F.col("blocks") > 1, F.col("mins")).alias("mins")
    named = cut(classes.join(light(cut(named)), F.col("node") == F.col("cls")).select("cls", F.col("root").alias("grp"), "blocks", "rep", "set", "n", mins))
    large = named.filter("blocks > 1")
    task = lambda block, kind: F.struct(F.xxhash64("grp", block).alias("task"), F.lit(kind).alias("kind"))
    first = F.when(F.col("blocks") > 1, F.array(task(_own(), 1))).otherwise(F.array(F.struct(F.xxhash64("grp").alias("task"), F.lit(2).alias("kind"))))
    wanted = named.select("cls", "rep", "set", "grp", first.alias("tasks"))
    some = not large.isEmpty()
    if some:
        typical = pivots(large.withColumn("first", F.col("grp")), "rep", "set")
        wanted = wanted.unionByName(typical.select("cls", "rep", "set", "grp", F.transform(_all("blocks"), lambda b: task(b, 0)).alias("tasks")))
    found = compared(wanted, True)
    links = found.filter("b IS NOT NULL").select("a", "b")
    rest = found.filter("b IS NULL").select(F.col("grp").alias("g"), F.col("a").alias("c"))
    if not some or rest.isEmpty():
        return links
    counts = light(cut(rest.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("others")).withColumnRenamed("g", "of")))
    again = large.join(counts, F.col("grp") == F.col("of")).join(rest, (F.col("grp") == F.col("g")) & (F.col("cls") == F.col("c")), "left")
    pair = lambda block, other, kind: F.struct(F.xxhash64("grp", block, other).alias("task"), F.lit(kind).alias("kind"))
    all_ = F.transform(_all("others"), lambda o: pair(_own(), o, 1))
    other = F.transform(_all("blocks"), lambda b: pair(b, _own("others"), 0))
    tasks = F.when(F.col("c").isNull(), all_).otherwise(F.concat(all_, other)).alias("tasks")
    return links.unionByName(compared(again.select("cls", "rep", "set", "grp", tasks), False).select("a", "b"))


def near_groups(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, recall: float = 1 - 1e-7, small: int = 1024, depth: int = 3, block: int = 256, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; sets with den * common >= num * union are linked."""
    spark = docs.sparkSession
    with steps(spark) as result:
        sketched = cut(sketches(docs, k, id_column, text_column).withColumn("uid", F.monotonically_increasing_id()))
        named = sketched.filter("n > 0 AND doc_id IS NOT NULL")
        one = F.min_by(F.struct("uid", "n", "mins", "tokens"), F.struct("doc_id", "uid")).alias("m")
        classes = cut(named.groupBy("set").agg(F.min("doc_id").alias("rep"), one).select(F.col("m.uid").alias("cls"), "rep", "set", "m.n", "m.mins", "m.tokens"))
        rows = cut(sketched.select("doc_id", "n", "set"))
        discard(sketched)
        groups = components(candidates(classes, num, den, recall, small, depth))
        links = confirmed(docs, classes, groups, k, num, den, block, id_column, text_column)
        sweep(spark)
        found = components(links)
        # The smallest id of a component: over its root's class and the classes that hang on it.
        whole = light(cut(found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())))
        ids = cut(classes.select("cls", "rep").join(whole, F.col("node") == F.col("cls")).select("node", "root", "rep"))
        least = light(cut(ids.groupBy("root").agg(F.min("rep").alias("component")).select(F.col("root").alias("r"), "component")))
        of_class = light(cut(ids.join(least, F.col("root") == F.col("r")).select("node", "component")))
        by_set = classes.select("cls", F.col("set").alias("s"), "rep").join(of_class, F.col("cls") == F.col("node"), "left").select("s", F.coalesce("component", "rep").alias("component"))
        joined = rows.join(by_set, rows["set"] == by_set["s"], "left")
        component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")))
        out = joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        return result(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies: shingles of three words, similarity of 0.85 or more."""
    return near_groups(table(spark, sf_dir, "documents"), k=3, num=85, den=100)
