"""Prefix trie of conversations with subtree totals, by time-forward processing.

A node is a distinct sequence of first turns. It is named by its depth and 128 bits: the exclusive or over its turns of
two hashes of the turn's place and content (an MD5), which is a running window aggregate, so sequences are never
built.

Totals go from the leaves to the root. Nodes are sorted by level, deepest first; each takes the messages that its
children left for it from a priority queue, which is ordered like the nodes and spills to sorted runs, adds them up and
leaves a message for its parent. To do this in parallel the trie is cut. The turns that members of a node have from it
on are its weight, known without recursion; nodes above a share of all turns are heavy, and they hold the root. What
hangs below them are light subtrees, each a shard of bounded size that one task works through; a task takes many. The
totals of shard roots are added up by parent in Spark, and time-forward processing of the heavy nodes, in bands of
levels, ends at the root.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions.skew import lookup_join
from changeloom.llm.common import staged, with_python
from changeloom.session import shuffle_partitions

#: The contract's rebuilding: conversations share the head of the first one of a family.
FAMILY = 5
HEADS = 9
#: Turns below a node from which it may be heavy, and shards for each shuffle partition from which it is.
SHARD_TURNS = 256
SHARDS_EACH = 4
#: Levels of heavy nodes that are worked through at once, and messages that a queue holds in memory.
BAND = 4096
QUEUE_ROWS = 1 << 16
#: Ids of conversations that one block of an id list spans, as a power of two.
BLOCK_BITS = 14
NODE = ["d", "n1", "n2"]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of rebuilt conversations: ``family``, ``c`` (conversation), ``d`` (place, from 1), ``content`` (MD5 of role
    and text), ``bytes`` (of the text) and ``length`` (turns of c). Each conversation also has a row without content at
    place 0, the turnless ones only this.

    Conversation c is the first h turns of the first conversation of its family, c - c % 5, and its own turns after the
    first h, where h is the CRC-32 of c's decimal digits modulo 9. Turns are ordered by turn (null first), then role,
    then content. Rows without conversation are left out. A family meets in one task, where its turns are sorted; texts
    stay behind.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.expr(f"conv_id - conv_id % {FAMILY}").cast("long").alias("family"),
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        F.unhex(F.md5(marked.cast("binary"))).alias("content"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    own, all_of = Window.partitionBy("family", "conv"), Window.partitionBy("family")
    in_order = own.orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    numbered = (
        turns.repartition("family")
        .withColumn("pos", F.row_number().over(in_order).cast("long"))
        .withColumn("own", F.count(F.lit(1)).over(own))
        .withColumn("convs", F.collect_list(F.when(F.col("pos") == 1, F.struct("conv", "own"))).over(all_of))
        .withColumn("base", F.coalesce(F.max(F.when(F.col("conv") == F.col("family"), F.col("own"))).over(all_of), F.lit(0)))
    )

    def head(conv: str) -> str:
        return f"crc32(cast(cast({conv} AS string) AS binary)) % {HEADS}"

    def row(conv: str, place: str, own_turns: str, content: str = "content", size: str = "bytes") -> str:
        length = f"least({head(conv)}, base) + greatest({own_turns} - {head(conv)}, 0L)"
        return f"named_struct('c', {conv}, 'd', {place}, 'content', {content}, 'bytes', {size}, 'length', {length})"

    rows = f"""concat(
        CASE WHEN pos = 1 THEN array({row("conv", "0L", "own", "cast(null AS binary)", "0L")}) ELSE array() END,
        CASE WHEN pos > {head("conv")} THEN array({row("conv", f"pos - {head('conv')} + least({head('conv')}, base)", "own")}) ELSE array() END,
        CASE WHEN conv = family AND pos < {HEADS}
            THEN transform(filter(convs, x -> pos <= {head("x.conv")}), x -> {row("x.conv", "pos", "x.own")}) ELSE array() END)"""
    return numbered.select("family", F.expr(f"inline({rows})"))


def members(turns: DataFrame) -> DataFrame:
    """One row for each conversation ``c`` and node that it begins with: the node (d, n1, n2), its parent's bits (p1, p2),
    the bytes of the node's last text and the turns of c."""
    up_to = Window.partitionBy("family", "c").orderBy("d")
    bits = turns
    for k in (1, 2):
        own = F.when(F.col("d") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(k), "d", "content"))
        bits = bits.withColumn(f"own{k}", own).withColumn(f"n{k}", F.bit_xor(f"own{k}").over(up_to))
    parents = [F.col(f"n{k}").bitwiseXOR(F.col(f"own{k}")).alias(f"p{k}") for k in (1, 2)]
    return bits.select("c", *NODE, *parents, "bytes", "length")


class SpillingQueue:
    """Least-first queue of tuples that holds at most ``most`` of them in memory, and the rest in sorted runs on disk.

    The runs belong to one attempt of a task, like Spark's own spills, and have no name in the file system: nobody else
    reads them, and a task that runs again begins anew.
    """

    def __init__(self, most: int):
        self.most, self.held, self.runs, self.spills = most, [], [], 0

    def push(self, item: tuple) -> None:
        if len(self.held) >= self.most:
            self._spill()
        heapq.heappush(self.held, item)

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        for item in sorted(self.held):
            pickle.dump(item, file)
        file.seek(0)
        self.held = []
        self.spills += 1
        heapq.heappush(self.runs, (pickle.load(file), self.spills, file))

    def peek(self) -> tuple | None:
        heads = [q[0] for q in (self.held,) if q] + [self.runs[0][0] for _ in self.runs[:1]]
        return min(heads, default=None)

    def pop(self) -> tuple:
        if self.held and not (self.runs and self.runs[0][0] < self.held[0]):
            return heapq.heappop(self.held)
        item, at, file = self.runs[0]
        try:
            heapq.heapreplace(self.runs, (pickle.load(file), at, file))
        except EOFError:
            heapq.heappop(self.runs)
            file.close()
        return item


def time_forward(nodes: Iterator[tuple], queue: SpillingQueue) -> Iterator[tuple[int, int, int]]:
    """Children, leaves and saved tokens of nodes sorted by shard and level, deepest first.

    A node is (shard bits 1 and 2, level of the shard's root, d, n1, n2, p1, p2, own saved tokens, and the children,
    leaves and saved tokens that other shards have for it).
    """
    for s1, s2, top, d, n1, n2, p1, p2, saved, children, leaves, more in nodes:
        at, saved = (s1, s2, -d, n1, n2), saved + more
        while (found := queue.peek()) is not None and found[:5] <= at:
            found = queue.pop()
            if found[:5] != at:
                raise RuntimeError(f"no node for a message to {found[:5]}")
            children, leaves, saved = children + 1, leaves + found[5], saved + found[6]
        leaves = leaves or 1
        if d > top:
            queue.push((s1, s2, 1 - d, p1, p2, leaves, saved))
        yield children, leaves, saved


#: What :func:`time_forward` takes of a row, and what is handed on besides.
_TAKEN = ["s1", "s2", "top", *NODE, "p1", "p2", "own_saved", "in_children", "in_leaves", "in_saved"]
_TOTALS = ["n_children", "n_leaves", "saved_tokens"]


def totals(shards: DataFrame, queue_rows: int) -> DataFrame:
    """Nodes with their totals inside their shard and from what ``in_*`` say hangs below it."""
    rows = with_python(shards.select(*_TAKEN, "conv_id", "n_convs"))
    rows = rows.repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.col("d").desc(), "n1", "n2")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batch = pd.DataFrame()

        def each() -> Iterator[tuple]:
            nonlocal batch
            for batch in batches:
                yield from batch[_TAKEN].itertuples(index=False, name=None)

        found = time_forward(each(), SpillingQueue(queue_rows))
        held = []
        for row in found:
            held.append(row)
            if len(held) == len(batch):
                yield pd.concat([batch, pd.DataFrame(held, columns=_TOTALS)], axis=1)
                held = []

    return rows.mapInPandas(run, schema + "".join(f", {c} long" for c in _TOTALS))


def _to_parents(done: DataFrame) -> DataFrame:
    """What the roots of shards have for their parents, added up."""
    roots = done.filter("d = top AND n1 = s1 AND n2 = s2 AND d > 0")
    return roots.groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count(F.lit(1)).alias("in_children"), F.sum("n_leaves").alias("in_leaves"), F.sum("saved_tokens").alias("in_saved")
    )


def _with_inbox(nodes: DataFrame, messages: DataFrame | None) -> DataFrame:
    names = ["in_children", "in_leaves", "in_saved"]
    if messages is None:
        return nodes.withColumns({c: F.lit(0).cast("long") for c in names})
    summed = messages.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in names])
    return nodes.join(summed, NODE, "left").fillna(0, names)


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending and comma-joined.

    Ids are sorted and joined in blocks of ``2 ** BLOCK_BITS`` neighbouring ids. One task then hashes the blocks of a
    node as they come, as a SHA-256 has to be; it holds one block.
    """
    ended = rows.filter("d = length").withColumn("block", F.shiftright("c", BLOCK_BITS))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",")
    blocks = with_python(ended.groupBy(*NODE, "block").agg(joined.alias("ids")))
    blocks = blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node = state = None
        for batch in batches:
            done = []
            for *at, ids in batch.itertuples(index=False, name=None):
                if at == node:
                    state.update(b",")
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*NODE, "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    return blocks.mapInPandas(run, "d long, n1 long, n2 long, ends_sha256 string")


def trie(rows: DataFrame, *, shard_turns: int = SHARD_TURNS, band: int = BAND, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """The nodes of the trie of all conversations in ``rows`` (of :func:`members`), with their totals.

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and the node's bits n1 and n2. No rows give no node, not even a root.
    """
    spark = rows.sparkSession
    rows = staged(rows, "trie-members")
    share = max(shard_turns, ceil(rows.count() / (SHARDS_EACH * shuffle_partitions(spark))))
    found = rows.groupBy(*NODE).agg(
        F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in ("p1", "p2")],
        ((F.count(F.lit(1)) - 1) * F.min("bytes")).alias("own_saved"),
        F.sum(F.col("length") - F.col("d") + 1).alias("weight"),
    )
    nodes = staged(found, "trie-nodes")
    heavy, light = nodes.filter(F.col("weight") > share), nodes.filter(F.col("weight") <= share)

    # A conversation's first light node is the root of the shard that all its light nodes are in.
    flags = heavy.select(*NODE, F.lit(True).alias("heavy"))
    marked = lookup_join(rows.select("c", *NODE), flags, NODE, salt_by=["c"])
    first = F.min_by(F.when(F.col("heavy").isNull(), F.struct(*NODE)), F.when(F.col("heavy").isNull(), F.col("d")))
    shard_of = marked.groupBy(F.col("c").alias("conv_id")).agg(first.alias("first")).select(
        "conv_id", *[F.col(f"first.{a}").alias(b) for a, b in zip(NODE, ("top", "s1", "s2"), strict=True)]
    )
    done = staged(totals(_with_inbox(light.join(shard_of, "conv_id"), None), queue_rows), "trie-light")
    parts, messages = [done], _to_parents(done)

    deepest = heavy.agg(F.max("d")).first()[0]
    for k in range(-1 if deepest is None else deepest // band, -1, -1):
        within = heavy.filter((F.col("d") >= k * band) & (F.col("d") < (k + 1) * band))
        top = rows.filter(F.col("d") == k * band).select(
            F.col("c").alias("conv_id"), F.col("d").alias("top"), F.col("n1").alias("s1"), F.col("n2").alias("s2")
        )
        done = staged(totals(_with_inbox(within.join(top, "conv_id"), messages), queue_rows), "trie-heavy")
        parts.append(done)
        messages = messages.unionByName(_to_parents(done))

    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    parents = nodes.select((F.col("d") + 1).alias("d"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    every = lookup_join(every.select(*NODE, "p1", "p2", "conv_id", "n_convs", *_TOTALS), parents, ["d", "p1", "p2"], salt_by=["n1"])
    none = F.lit(hashlib.sha256().hexdigest())
    return every.join(digests(rows), NODE, "left").select(
        "conv_id",
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        *_TOTALS,
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
        "n1",
        "n2",
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations.

    Null roles and texts are empty, repeated rows are turns of their own, rows without conversation are left out, other
    columns play no part, and an empty table gives no rows.
    """
    return trie(members(rebuilt(conversations))).drop("n1", "n2")


def _sql_head(conv: str) -> str:
    return f"""xor(list_reduce(list_transform(range(1, length(CAST({conv} AS VARCHAR)) + 1),
                    lambda i: CAST(ascii(substr(CAST({conv} AS VARCHAR), i, 1)) AS BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % {HEADS}"""


SQL = f"""
    WITH step AS (
        SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
    ), turns AS (
        SELECT conv_id, octet_length(encode(coalesce(text, ''))) AS bytes,
               md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS content,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (SELECT conv_id, {_sql_head("conv_id")} AS h FROM (SELECT DISTINCT conv_id FROM turns), step),
    heads AS (
        SELECT c.conv_id AS c, 0 AS part, pos, content, bytes
        FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % {FAMILY} AND pos <= h
        UNION ALL
        SELECT c.conv_id, 1, pos, content, bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos > h
    ), rebuilt AS (
        SELECT c, row_number() OVER w AS d, string_agg(content, '') OVER (w ROWS UNBOUNDED PRECEDING) AS key, bytes FROM heads
        WINDOW w AS (PARTITION BY c ORDER BY part, pos)
        UNION ALL SELECT conv_id, 0, '', 0 FROM convs
    ), nodes AS (
        SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved FROM rebuilt GROUP BY d, key
    ), ends AS (
        SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(key, d) AS key FROM rebuilt GROUP BY c)
        GROUP BY key
    ), counted AS (
        SELECT n.*, p.conv_id AS parent, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND starts_with(k.key, n.key)) AS children
        FROM nodes n LEFT JOIN nodes p ON n.d = p.d + 1 AND starts_with(n.key, p.key)
    ), below AS (
        SELECT n.key, sum(CASE WHEN x.children = 0 THEN 1 ELSE 0 END) AS leaves, sum(x.saved) AS saved
        FROM counted n JOIN counted x ON starts_with(x.key, n.key) GROUP BY n.key
    )
    SELECT conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, children AS n_children,
           CAST(leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM counted JOIN below USING (key) LEFT JOIN ends USING (key)
"""
