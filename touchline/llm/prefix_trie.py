"""Conversation prefix trie (operator 12).

Every distinct beginning of a conversation is a node of a trie; a node knows the
conversations that begin with it. The trie is built in sorted shards:

* Conversations are paths of turn digests (16 bytes a turn, of role and text), and
  their lexicographic order is the trie's order. A bounded sample of the paths'
  heads (the first ``HEAD`` turns) with their ids gives the splitters of a range
  partitioning by (head, conv_id), so equal conversations spread over shards too.
* The trie of the splitters' heads, the skeleton, is sent out: a node that lies in
  several shards is on a splitter's head, or below one of full length. Its size is
  the number of shards times ``16 * HEAD`` bytes at most.
* A shard, sorted by path and id, is walked with a stack. Nodes off the skeleton
  lie in one shard and are finished there, a whole subtree at a time. Of skeleton
  nodes a shard passes on partial aggregates, and the ids that end there in blocks
  of text in ascending order.
* The partials of a skeleton node are added up, its blocks digested in order, and
  what the skeleton's nodes hand up to all their ancestors is added by doubling the
  distance in each round.

A conversation is one value (its digests and lengths, 20 bytes a turn, not its
texts): its rows meet in one task, however many they are.

Cases: a null role or text counts as empty; turns are ordered by turn (null
first), then role, then the digest of role and text, so ties and repeated rows
have one defined order and are all kept; rows with a null conv_id belong to no
conversation and take no part; negative ids have the base that truncation gives
(-1: 0); an empty table gives no rows, not even the root; other columns are
ignored.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import clean_text, ship, stored, table

ship(__name__)

DIGEST = 16
#: Turns of a path's head: what the range partitioning and the skeleton hold.
HEAD = 32
#: Splitters come from at most this many conversations, chosen by a hash.
SAMPLE = 1 << 15
#: Turns that a shard should hold.
SHARD_TURNS = 2_000_000
#: Bytes of a block of ids.
BLOCK = 1 << 16
#: Rows of a skeleton up to which it is broadcast; a larger one is joined by a shuffle.
SMALL = 1 << 19
EMPTY = hashlib.sha256(b"").hexdigest()

SHARD_ROWS = ("kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, length long, ends_sha256 string, shard int, place long, ids binary")


def conversations_of(turns: DataFrame) -> DataFrame:
    """conv_id, codes and lengths of each conversation of ``turns`` (conv_id,
    turn, role, text), in order."""
    role, text = clean_text("role"), clean_text("text")
    code = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return (turns.filter("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
                F.col("turn").cast("long").alias("turn"), role.alias("role"), code.alias("code"),
                F.length(text).alias("length")).alias("t"))
            .withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
            .repartition("base")
            .groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")))


def rebuilt(turns: DataFrame, shared: int = 6) -> DataFrame:
    """conv_id, path, lengths: each conversation c with its first h turns taken
    from conversation ``c - c % 100`` (all if fewer, none if absent),
    h = crc32(decimal c) % ``shared``, then its own turns after its first h. The
    conversations of one base lie in one partition, so the join moves nothing."""
    own = conversations_of(turns)
    heads = own.filter("conv_id = base").select(F.col("base").alias("from"), F.slice("t", 1, shared - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    both = own.join(heads, F.col("base") == F.col("from"), "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), h),
                            F.slice("t", h + 1, F.size("t"))).alias("t"))
    return both.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: x["code"]), "")).alias("path"),
                       F.transform("t", lambda x: x["length"]).alias("lengths"))


def splitters_of(convs: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` (head, conv_id), the first ones of the shards after
    the first, from a sample of at most ``SAMPLE`` conversations."""
    rows = (convs.select(F.substring("path", 1, DIGEST * HEAD).alias("head"), "conv_id")
            .orderBy(F.xxhash64("conv_id"), "conv_id").limit(min(SAMPLE, 64 * shards)).toArrow())
    sample = sorted(zip(rows["head"].to_pylist(), rows["conv_id"].to_pylist(), strict=True))
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []


def skeleton_of(splitters: list[tuple[bytes, int]]) -> dict | None:
    """The trie of the splitters' heads: digest -> subtrie (None without splitters)."""
    root: dict = {}
    for head, _ in splitters:
        at = root
        for i in range(0, len(head), DIGEST):
            at = at.setdefault(head[i:i + DIGEST], {})
    return root if splitters else None


def _shard_numbers(splitters):
    """shard of each conversation: how many splitters are not above it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = splitters.value
        for b in batches:
            keys = zip(b.column(1).to_pylist(), b.column(0).to_pylist(), strict=True)
            n = [bisect_right(own, (path[:DIGEST * HEAD], conv)) for path, conv in keys]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), *b.columns], names=["shard", "conv_id", "path", "lengths"])
    return run


class _Node:
    """A node on the stack: of the subtree only what its ancestors need."""

    __slots__ = ("turn", "length", "n", "least", "children", "leaves", "saved", "ends", "any_end", "finished", "trie", "name",
                 "ids", "size", "blocks")

    def __init__(self, turn: bytes, length: int, trie, name):
        self.turn, self.length, self.trie, self.name = turn, length, trie, name
        self.n, self.least, self.children, self.leaves, self.saved = 0, None, 0, 0, 0
        self.ends, self.any_end = None, False
        self.finished: list[tuple] = []     # children off the skeleton, which wait for ``least``
        self.ids, self.size, self.blocks = [], 0, 0

    @property
    def key(self) -> bytes:
        return self.name.digest()[:DIGEST]


def _walk(skeleton):
    """Final rows (kind 0), partial aggregates of skeleton nodes (1), and blocks
    of the ids that end there (2). The rows come sorted by shard, path, conv_id.

    ``trie`` of a node: its skeleton node; False off the skeleton; True below a
    head of full length, where nodes may lie in several shards as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        stack: list[_Node] = []
        before, shard_now = b"", None

        def row(kind, key=None, parent_key=None, conv=None, depth=None, parent=None, n=None, children=None, leaves=None,
                saved=None, length=None, ends=None, shard=None, place=None, ids=None):
            out.append((kind, key, parent_key, conv, depth, parent, n, children, leaves, saved, length, ends, shard, place, ids))

        def flush(node: _Node) -> None:
            row(2, key=node.key, shard=shard_now, place=node.blocks, ids=",".join(node.ids).encode())
            node.ids, node.size, node.blocks = [], 0, node.blocks + 1

        def close() -> None:
            """Finish the node on top of the stack."""
            node, depth = stack.pop(), len(stack)
            up = stack[-1] if stack else None
            if node.trie is not False:
                if node.ids:
                    flush(node)
                row(1, key=node.key, parent_key=up.key if up else None, conv=node.least, depth=depth, n=node.n,
                    children=node.children, leaves=node.leaves, saved=node.saved, length=node.length)
            else:
                for child in node.finished:
                    row(0, conv=child[0], depth=depth + 1, parent=node.least, n=child[1], children=child[2], leaves=child[3],
                        saved=child[4], ends=child[5])
                leaves = node.leaves if node.children else 1
                saved = node.saved + (node.n - 1) * node.length
                own = (node.least, node.n, node.children, leaves, saved, node.ends.hexdigest() if node.any_end else EMPTY)
                if up is not None:
                    up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
                if up is not None and up.trie is False:
                    up.finished.append(own)
                else:
                    row(0, parent_key=up.key if up else None, conv=own[0], depth=depth, n=own[1], children=own[2], leaves=own[3],
                        saved=own[4], ends=own[5])
            if up is not None:
                up.n += node.n
                up.least = node.least if up.least is None else min(up.least, node.least)

        def open_(turn: bytes, length: int) -> None:
            if not stack:
                trie = False if skeleton.value is None else skeleton.value
                stack.append(_Node(turn, length, trie, hashlib.sha256() if trie is not False else None))
                return
            up = stack[-1]
            if up.trie is True or (up.trie is not False and len(stack) - 1 == HEAD):
                trie = True
            else:
                trie = False if up.trie is False else up.trie.get(turn, False)
            name = None
            if trie is not False:
                name = up.name.copy()
                name.update(turn)
            stack.append(_Node(turn, length, trie, name))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            out.clear()
            kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string(), pa.int32(), pa.int64(), pa.binary()]
            names = [c.split()[0] for c in SHARD_ROWS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for b in batches:
            for shard, conv, path, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard != shard_now:
                    while stack:
                        close()
                    shard_now, before = shard, b""
                turns = len(path) // DIGEST
                if path == before:
                    same = turns
                else:
                    same, most = 0, min(turns, len(before) // DIGEST)
                    while same < most and path[same * DIGEST:same * DIGEST + DIGEST] == stack[same + 1].turn:
                        same += 1
                while len(stack) > same + 1:
                    close()
                if not stack:
                    open_(b"", 0)
                for i in range(same, turns):
                    open_(path[i * DIGEST:i * DIGEST + DIGEST], lengths[i])
                top = stack[-1]
                top.n += 1
                top.least = conv if top.least is None else min(top.least, conv)
                word = str(conv)
                if top.trie is not False:
                    top.ids.append(word)
                    top.size += len(word) + 1
                    if top.size >= BLOCK:
                        flush(top)
                elif top.any_end:
                    top.ends.update(f",{word}".encode())
                else:
                    top.ends, top.any_end = hashlib.sha256(word.encode()), True
                before = path
                if len(out) >= 4096:
                    yield batch()
        while stack:
            close()
        if out:
            yield batch()
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, ends_sha256: blocks sorted by key, shard, place go through one digest."""
    key, digest = None, None

    def one(k: bytes, d) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.binary()), pa.array([d.hexdigest()])], names=["key", "ends_sha256"])

    for b in batches:
        for k, ids in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
            if k != key:
                if digest is not None:
                    yield one(key, digest)
                key, digest = k, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
    if digest is not None:
        yield one(key, digest)


def _handed_up(nodes: DataFrame) -> DataFrame:
    """``nodes`` (key, parent_key, leaves, saved, depth) with leaves and saved summed
    over each node's subtree. After round r a node has what lies fewer than
    2 ** r levels below it, and ``above`` is its ancestor of that distance."""
    state = stored(nodes.select("key", F.col("parent_key").alias("above"), "leaves", "saved"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        below = (state.filter("above IS NOT NULL").groupBy(F.col("above").alias("key"))
                 .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        higher = state.select(F.col("key").alias("above"), F.col("above").alias("next"))
        state = stored(state.join(below, "key", "left").join(higher, "above", "left").select(
            "key", F.col("next").alias("above"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")))
    return state.select("key", "leaves", "saved")


def prefix_trie(convs: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of ``convs`` (conv_id, path, lengths; ids are unique):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    spark = convs.sparkSession
    convs = stored(convs)
    if shards is None:
        turns = convs.agg(F.sum(F.size("lengths") + 1)).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    splitters = splitters_of(convs, shards)
    numbers = spark.sparkContext.broadcast(splitters)
    skeleton = spark.sparkContext.broadcast(skeleton_of(splitters))
    dealt = convs.mapInArrow(_shard_numbers(numbers), "shard int, conv_id long, path binary, lengths array<int>")
    rows = stored(dealt.repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
                  .mapInArrow(_walk(skeleton), SHARD_ROWS))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    final = rows.filter("kind = 0")
    if not splitters:
        return final.select(columns)
    parts = stored(rows.filter("kind = 1").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.first("length").alias("length")))
    children = parts.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("inner"))
    nodes = stored(parts.join(children, "key", "left").select(
        "key", "parent_key", "conv_id", "depth", "n_convs", (F.col("n_children") + F.coalesce("inner", F.lit(0))).alias("n_children"),
        "n_leaves", "saved_tokens", "length"))
    sums = _handed_up(nodes.select(
        "key", "parent_key", "depth", (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length")).alias("saved")))
    ends = (rows.filter("kind = 2").select("key", "shard", "place", "ids").repartition("key")
            .sortWithinPartitions("key", "shard", "place").mapInArrow(_digests, "key binary, ends_sha256 string"))
    small = parts.count() <= SMALL
    ids = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_parent"))
    ids = F.broadcast(ids) if small else ids
    inner = (nodes.drop("n_leaves", "saved_tokens").join(sums, "key").join(ends, "key", "left").join(ids, "parent_key", "left")
             .select("conv_id", "depth", F.col("of_parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                     F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))
    under = (final.filter("parent_key IS NOT NULL").drop("parent_conv_id").join(ids, "parent_key")
             .withColumnRenamed("of_parent", "parent_conv_id"))
    alone = final.filter("parent_key IS NULL")
    return alone.select(columns).unionAll(under.select(columns)).unionAll(inner.select(columns))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt ``conversations``."""
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


#: crc32 goes byte by byte through the table of its polynomial (3988292384, reflected); ids are ASCII.
OP12_SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i, 0, i::UBIGINT FROM range(256) r(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS n,
           md5(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS code
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(code ORDER BY turn NULLS FIRST, role, code) AS codes, list(n ORDER BY turn NULLS FIRST, role, code) AS sizes
    FROM said GROUP BY conv_id
), taken AS (
    SELECT conv_id, codes, sizes, (xor(list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
        lambda c, b: xor(c >> 8, tab[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 6)::BIGINT AS h
    FROM own, tab
), paths AS (
    SELECT c.conv_id, list_concat(coalesce(list_slice(b.codes, 1, h), []), list_slice(c.codes, h + 1, len(c.codes))) AS codes,
           list_concat(coalesce(list_slice(b.sizes, 1, h), []), list_slice(c.sizes, h + 1, len(c.sizes))) AS sizes
    FROM taken c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), steps AS (
    SELECT conv_id, codes, sizes, unnest(range(0, len(codes) + 1)) AS d FROM paths
), members AS (
    SELECT conv_id, d, array_to_string(list_slice(codes, 1, d), '') AS path, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS n, d = len(codes) AS ends
    FROM steps
), nodes AS (
    SELECT path, any_value(d)::BIGINT AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
    FROM members GROUP BY path
), kids AS (
    SELECT substr(path, 1, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.path = k.path
), up AS (
    SELECT path, depth, n_children, (n_convs - 1) * n AS saved, unnest(range(0, depth + 1)) AS step FROM full_nodes
), sums AS (
    SELECT substr(path, 1, 32 * step) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM up GROUP BY 1
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_nodes f JOIN sums s ON f.path = s.path
LEFT JOIN nodes p ON f.depth > 0 AND p.path = substr(f.path, 1, 32 * (f.depth - 1))
"""
