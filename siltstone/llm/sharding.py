"""Sharding by balanced label propagation.

Nodes start in shards by hash. In each round a linked node asks to move to the shard in which most of its neighbours are.
Each link is looked at from one of its ends, which a hash of the hub and the round chooses, so that two ends of a link
never swap. The driver sees requests as counts by pair of shards and bucket of a hash, ``BUCKETS`` for each pair at most,
and lets in as many buckets as there is room for and, into full shards, as many as leave them in the same round (along
cycles of shards). At the end nodes without links fill the shards up and what is over moves, so that the law ``rows``
holds exactly: counts are at most one apart. Groups larger than a shard are split, and those that found neither room nor
an exchange in the rounds.

Defined cases: a null text has no bytes and a size of 1, like an empty one; a text of any length is read whole. Rows that
repeat an id, or have none, are nodes of their own; a node whose neighbours are in equal numbers in several shards stays
where it is if that is one of them, else goes to the first. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import cut, dense_rank_in, steps, table


#: A group's nodes hang on so many hubs at most, which hang on the group's first: no node has all links of a large group.
HUBS = 256
#: Requests from one shard to another are let in by so many parts.
BUCKETS = 1024


def star_links(nodes: DataFrame, group: str) -> DataFrame:
    """Links (a, b), b < a, that join the nodes of each group in a tree of two levels; one fewer than nodes."""
    salt = F.pmod(F.xxhash64("node"), F.lit(HUBS)).cast("int")
    salted = nodes.select(F.col(group).alias("_g"), "node", salt.alias("_s"))
    hubs = salted.groupBy("_g", "_s").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"))
    tops = hubs.groupBy("_g").agg(F.min("hub").alias("top"), F.sum("n").alias("n")).filter("n > 1").select("_g", "top")
    hubs = cut(hubs.join(tops, "_g").select("_g", "_s", "hub", "top"))
    low = salted.join(hubs, ["_g", "_s"]).filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return low.unionByName(hubs.filter("hub != top").select(F.col("hub").alias("a"), F.col("top").alias("b")))


def _votes(links: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """(voter, to, votes): labels of the neighbours that are looked at in a round."""
    down = F.pmod(F.xxhash64("b", F.lit(turn)), F.lit(2)) == 0
    ends = links.select(F.when(down, F.col("a")).otherwise(F.col("b")).alias("voter"), F.when(down, F.col("b")).otherwise(F.col("a")).alias("other"))
    seen = ends.join(labels.select(F.col("node").alias("_n"), "shard"), F.col("other") == F.col("_n"))
    return seen.groupBy("voter", F.col("shard").alias("to")).agg(F.count(F.lit(1)).alias("votes"))


def admitted(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the moves wanted from shard to shard take place: into room, and in cycles that keep all loads."""
    outside = len(room)
    left = dict(wanted) | {(s, outside): n for s, n in enumerate(room)}

    def way(start: int, end: int) -> list[tuple[int, int]] | None:
        came, queue = {start: start}, [start]
        for u in queue:
            for v in range(outside + 1):
                if v not in came and left.get((u, v), 0) > 0:
                    came[v] = u
                    queue.append(v)
        if end not in came:
            return None
        steps, at = [], end
        while at != start:
            steps.append((came[at], at))
            at = came[at]
        return steps

    def push(steps: list[tuple[int, int]]) -> None:
        n = min(left[x] for x in steps)
        for x in steps:
            left[x] -= n

    for s in sorted(range(outside), key=lambda s: room[s]):
        # A shard with room of its own has no need to give it up.
        while room[s] <= 0 and (steps := way(s, outside)):
            push(steps)
    for u, v in sorted(wanted):
        while left[u, v] > 0 and (steps := way(v, u)):
            push([(u, v), *steps])
    for u, v in sorted(wanted):
        n = min(left[u, v], left[v, outside])
        left[u, v] -= n
        left[v, outside] -= n
    return {x: n - left[x] for x, n in wanted.items() if n > left[x]}


def propagate(links: DataFrame, rows: int, shards: int = 8, rounds: int = 8) -> DataFrame:
    """(node, shard) of the nodes that have links; shards are asked to hold no more than their even share of ``rows``."""
    spark = links.sparkSession
    links = cut(links)
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = cut(nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")))
    loads = dict.fromkeys(range(shards), 0) | {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    share, still = rows // shards, 0
    for turn in range(rounds):
        votes = _votes(links, labels, turn).join(labels, F.col("voter") == F.col("node"))
        best = votes.groupBy("voter").agg(F.max(F.struct("votes", F.col("to") == F.col("shard"), -F.col("to"), "shard")).alias("m"))
        asks = best.select("voter", (-F.col("m")["col3"]).alias("to"), F.col("m")["shard"].alias("from")).filter(F.col("to") != F.col("from"))
        asks = cut(asks.withColumn("bucket", F.pmod(F.xxhash64("voter", F.lit(-1 - turn)), F.lit(BUCKETS)).cast("int")))
        # At most shards * shards * BUCKETS counts, whatever the number of rows.
        parts: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for r in sorted(asks.groupBy("from", "to", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()):
            parts.setdefault((r["from"], r["to"]), []).append((r["bucket"], r["n"]))
        still = 0 if parts else still + 1
        if still == 2:
            break
        moves = admitted({x: sum(n for _, n in p) for x, p in parts.items()}, [max(0, share - loads[s]) for s in range(shards)])
        below = []  # (from, to, first bucket that is not let in)
        for (x, y), n in moves.items():
            end = BUCKETS
            for bucket, size in parts[x, y]:
                if size > n:
                    end = bucket
                    break
                n -= size
                loads[x], loads[y] = loads[x] - size, loads[y] + size
            below.append((x, y, end))
        if not any(end for _, _, end in below):
            continue
        # As rows and not as literals: each round's plan has the same code.
        gate = F.broadcast(spark.createDataFrame(below, "x int, y int, below int"))
        let_in = asks.join(gate, (F.col("from") == F.col("x")) & (F.col("to") == F.col("y")) & (F.col("bucket") < F.col("below")))
        labels = cut(labels.join(let_in.select(F.col("voter").alias("node"), "to"), "node", "left").select("node", F.coalesce("to", "shard").alias("shard")))
    return labels


def balance(nodes: DataFrame, links: DataFrame, shards: int = 8, rounds: int = 8) -> DataFrame:
    """``nodes`` (with a unique long ``node``) with a ``shard``; numbers of rows are at most one apart."""
    rows = nodes.count()
    labels = propagate(links, rows, shards, rounds)
    loads = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    fullest = sorted(range(shards), key=lambda s: (-loads.get(s, 0), s))
    quota = {s: rows // shards + (i < rows % shards) for i, s in enumerate(fullest)}
    over = F.array(*[F.lit(max(0, loads.get(s, 0) - quota[s])) for s in range(shards)])
    ranked = dense_rank_in(labels, ["shard"], F.col("node"), rows, "rank")
    stay = ranked.filter(F.col("rank") >= over[F.col("shard")]).select(F.col("node").alias("_n"), F.col("shard").alias("_s"))
    placed = cut(nodes.join(stay, F.col("node") == F.col("_n"), "left").drop("_n"))
    low, to = 0, F.lit(None).cast("int")
    for s in range(shards):
        space = quota[s] - min(quota[s], loads.get(s, 0))
        to = F.when((F.col("rank") >= low) & (F.col("rank") < low + space), F.lit(s)).otherwise(to)
        low += space
    free = dense_rank_in(placed.filter("_s IS NULL").withColumn("_all", F.lit(0)), ["_all"], F.col("node"), rows, "rank")
    fixed = placed.filter("_s IS NOT NULL").withColumnRenamed("_s", "shard")
    return fixed.unionByName(free.withColumn("shard", to).drop("_all", "rank", "_s"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards under the law ``rows``; equal texts are links."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    with steps(spark) as result:
        nodes = cut(docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"), F.monotonically_increasing_id().alias("node"),
        ))
        sharded = cut(balance(nodes.select("node", "doc_id", "size", "text_crc32"), star_links(nodes, "digest")))
        slots = dense_rank_in(sharded, ["shard"], F.col("node"), sharded.count(), "slot")
        return result(slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")))
