"""N-gram Jaccard join by count-vector R-trees (operator 10).

A document's set holds its distinct ``k``-word shingles as 64-bit Karp-Rabin
hashes (:func:`common.rolling`). Documents with equal sets are one class, known
by the hash of its set; only classes are compared.

* Shingles are hashed into ``groups`` groups; the counts by group are a point.
  The sum of two points' coordinate minima bounds the overlap of their sets.
* With the shingles in one order (by their rarest word, then hash), two sets of
  the wanted similarity have a common shingle among the first of either. Rare
  shingles come first, so a passage that many documents share makes no block. The
  classes that share such a shingle have its smallest one as their hub; a block
  holds all classes of one hub, each once, so a linked pair shares a block, and
  near copies that share hundreds of shingles meet in a few blocks.
* How many of its first shingles a class shares with any other (``met``) bounds a
  pair's overlap too: what lies behind the first ones is less than the wanted
  share of the larger set (:func:`least_met`).
* First, each class is verified against one hub of its blocks, if their points'
  bound allows a link. Links give components, and only blocks with several
  components go on: their points form R-trees (leaves packed by size and
  coordinates, nodes with upper corners), which are descended together; a pair of
  nodes is opened if its corners' bound allows a link, and pairs of points of
  different components that pass the bound are candidates. A block with few of
  them (``FEW`` a row) has them all verified and is done with. The others go through
  at most ``rounds`` rounds (Boruvka's): of every component the pair with the highest
  bound that was not verified before is verified, and components are joined, so a
  round verifies at most as many pairs as there are components. Then all candidates
  that still lie in two components are verified. So a group of n copies costs about n verifications, and
  no link between components is lost.

A block of more than ``chunk`` points is split into chunks, and pairs of chunks
are spread over tasks.

Cases: null or empty text (or white space alone): empty set, linked with
nothing, its component is its own doc_id; fewer than k words: the whole sequence
is one shingle; repeated rows have equal sets; a null doc_id takes part, and a
component's id is the smallest id that is not null (null if there is none); an
empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import (byte_slices, give_back, in_filter, key_filter, rolling, ship, slices, stored, table, word_codes,
                                  word_hashes)

ship(__name__)

GROUPS = 256
#: Points in a leaf of a block's R-tree, and children of its other nodes.
LEAF, FAN = 32, 8
#: Candidate pairs for each row of a block up to which all are verified at once.
FEW = 4
#: Largest count that a point holds; a set with a larger one is bounded by its size alone.
FULL = 32767


def shingle_sets(texts: pa.Array, k: int, rank_of: tuple[pa.Array, np.ndarray] | None = None):
    """For each text its distinct shingle hashes (sorted), and with ``rank_of``
    the frequency of each shingle's rarest word."""
    offsets, codes, words = word_codes(texts)
    hashes = word_hashes(words)[codes] if len(codes) else np.empty(0, np.uint64)
    whole = rolling(hashes, k)
    if rank_of is not None:
        frequent, counts = rank_of
        at = pc.fill_null(pc.index_in(words, frequent), len(counts)).to_numpy(zero_copy_only=False)
        freq = np.append(counts, 0)[at]
        freq = freq[codes] if len(codes) else np.empty(0, np.int64)
        least = freq[:len(whole)].copy()
        for j in range(1, k):
            np.minimum(least, freq[j:j + len(whole)], out=least)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo >= k:
            own, first = np.unique(whole[lo:hi - k + 1], return_index=True)
            yield own, (least[lo + first] if rank_of is not None else None)
        else:
            own = rolling(hashes[lo:hi], hi - lo) if hi > lo else np.empty(0, np.uint64)
            yield own, np.zeros(len(own), np.int64)


def class_hash(own: np.ndarray) -> int | None:
    import xxhash

    return None if not len(own) else int(np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).view(np.int64))


#: Rows of word counts that a task holds before it adds them up.
HELD = 1 << 19


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n: what a task counts is added up before it goes out."""
    held: list[pa.RecordBatch] = []

    def added() -> Iterator[pa.RecordBatch]:
        sums = pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")])
        yield from sums.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks().to_batches(max_chunksize=1 << 16)

    for b in slices(byte_slices(batches, 0), 4096):
        _, codes, words = word_codes(b.column(0))
        held.append(pa.RecordBatch.from_arrays([pc.cast(words, pa.string()), pa.array(np.bincount(codes, minlength=len(words)), pa.int64())],
                                               names=["word", "n"]))
        if sum(x.num_rows for x in held) > HELD:
            yield from added()
            held.clear()
    if held:
        yield from added()


def _points(k: int, groups: int, percent: int, ranks):
    """doc_id, n, cls, point, first of each document; ``first``: the first
    shingles of its set, by the rarity of their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(byte_slices(batches, 1, 2 << 20)):
            n, cls, points, first = [], [], [], []
            for own, freq in shingle_sets(b.column(1), k, ranks.value):
                n.append(len(own))
                cls.append(class_hash(own))
                points.append(np.minimum(np.bincount((own >> np.uint64(40)).astype(np.int64) % groups, minlength=groups), FULL).astype(np.int16))
                probe = len(own) - -(-percent * len(own) // 100) + 1 if len(own) else 0     # n - ceil(t n) + 1
                first.append(own[np.argsort(freq, kind="stable")[:probe]])       # own is in order already
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), lists_of(points, np.int16), lists_of(first, np.uint64, np.int64)],
                names=["doc_id", "n", "cls", "point", "first"])
    return run


def lists_of(rows: list[np.ndarray], kind: type, seen_as: type | None = None) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.empty(0, kind)
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(seen_as or kind)))


def _laid_out(b: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    """shingle, n, cls, indexed: the first shingles of the sets in the rows (n,
    cls, first), a row each. ``indexed``: also within the shorter prefix that
    suffices for the smaller set of a pair."""
    n, lists = b.column(0).to_numpy(), b.column(2)
    at = lists.offsets.to_numpy().astype(np.int64)
    size = np.diff(at)
    index = n - -(-2 * percent * n // (100 + percent)) + 1       # n - ceil(2 t n / (1 + t)) + 1
    place = np.arange(size.sum()) - np.repeat(at[:-1] - at[0], size)
    return pa.RecordBatch.from_arrays(
        [lists.flatten(), pa.array(np.repeat(n, size)), pa.array(np.repeat(b.column(1).to_numpy(), size)), pa.array(place < np.repeat(index, size))],
        names=["shingle", "n", "cls", "indexed"])


def _of_classes(bits, percent: int, several: bool):
    """Of the rows (n, cls, first) those whose class may be in the filter
    (``several``: it may have several rows), or the others, laid out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            b = b.filter(pa.array(in_filter(bits.value, b.column(1).to_numpy()) == several))
            yield b if several else _laid_out(b, percent)
    return run


def _all_laid_out(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield _laid_out(b, percent)
    return run


def first_shingles(points: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """shingle, n, cls, indexed of each class, from one of its rows. Only rows of
    classes with several rows (and those that the fixed-size filter takes for
    such) are shuffled for that."""
    bits = points.sparkSession.sparkContext.broadcast(key_filter(classes.filter("rows > 1"), "cls"))
    rows, out = points.filter(F.col("cls").isNotNull()).select("n", "cls", "first"), "shingle long, n long, cls long, indexed boolean"
    one = (rows.mapInArrow(_of_classes(bits, percent, True), "n long, cls long, first array<bigint>")
           .groupBy("n", "cls").agg(F.min("first").alias("first")))
    return rows.mapInArrow(_of_classes(bits, percent, False), out).unionAll(one.mapInArrow(_all_laid_out(percent), out))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks with two classes or more, each with the block's hub (its
    first row); the rows come sorted by shingle, n, cls."""
    pa.set_memory_pool(pa.system_memory_pool())
    names = ["shingle", "cls", "hub", "indexed"]
    carry: np.ndarray | None = None      # the last row, and its hub, whether its block has had another class
    last_hub, pending = 0, True
    for b in batches:
        if not b.num_rows:
            continue
        s, c = b.column(0).to_numpy(), b.column(2).to_numpy()
        x = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.stack([s, c, x])
        if carry is not None:
            rows = np.concatenate([carry, rows], 1)
        new = np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(rows.shape[1]), 0))
        hub = rows[1][start]
        if carry is not None:
            hub[start == 0] = last_hub          # the block goes on from the batch before
        again = np.concatenate([[False], ~new[1:] & (rows[1, 1:] == rows[1, :-1])])     # a class's second row
        many = rows[1] != hub                    # a row of another class than the hub's
        block = np.cumsum(new) - 1
        has = np.bincount(block, many) > 0
        if carry is not None and not pending:
            has[0] = True
        # the last block may go on: its hub row waits, its other rows are sure
        out = has[block]
        out[-1] = has[block[-1]]
        wait = not has[block[-1]]
        first = 1 if carry is not None and not pending else 0   # the carried row has gone out before
        keep = np.nonzero(out)[0]
        keep = keep[(keep >= first) & ~again[keep]]
        if len(keep):
            yield pa.RecordBatch.from_arrays([pa.array(rows[0][keep]), pa.array(rows[1][keep]), pa.array(hub[keep]),
                                              pa.array(rows[2][keep].astype(bool))], names=names)
        carry, last_hub, pending = rows[:, -1:], int(hub[-1]), wait
    give_back()


def _close_enough(x: Column, y: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether two points' summed coordinate minima allow a link."""
    bound = F.aggregate(F.zip_with(x, y, lambda a, b: F.least(a, b)), F.lit(0), lambda a, v: a + v)
    return (F.greatest(F.array_max(x), F.array_max(y)) >= FULL) | (bound * (100 + percent) >= F.lit(percent) * (n + m))


def least_met(n, m, percent: int):
    """How many of their first shingles linked sets of n and m shingles have in
    common at least. With the shingles in order, let x be the set whose first
    ones end earlier: common ones up to there are among the first of both, and
    behind there x has ceil(t |x|) - 1 others. n and m: columns or arrays."""
    over = lambda x, y: F.ceil(x / F.lit(y)) if isinstance(x, Column) else -(-x // y)
    most = F.greatest(n, m) if isinstance(n, Column) else np.maximum(n, m)
    return over((n + m) * percent, 100 + percent) - over(most * percent, 100) + 1


def tree(points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
    """An R-tree of the rows: its leaves, and for each level, from the leaves to
    the root, the nodes' upper corners, least and largest sizes."""
    order = rows[np.lexsort((points[rows, 1], points[rows, 0], sizes[rows]))]
    leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
    levels = [(np.stack([points[r].max(0) for r in leaves]), np.array([sizes[r].min() for r in leaves]), np.array([sizes[r].max() for r in leaves]))]
    while len(levels[-1][1]) > 1:
        top, lo, hi = levels[-1]
        at = np.arange(0, len(lo), FAN)
        levels.append((np.maximum.reduceat(top, at, 0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)))
    return leaves, levels


def leaf_pairs(points: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i in left, j in right) whose bound allows a link, with the bound,
    from two R-trees that are descended together (the same tree if ``left`` is
    ``right``)."""
    if not len(left) or not len(right):
        return
    same = left is right
    leaves, a = tree(points, sizes, left)
    leaves2, b = (leaves, a) if same else tree(points, sizes, right)
    todo = [(max(len(a), len(b)) - 1, 0, 0)]
    while todo:
        level, i, j = todo.pop()
        if level:
            # the lower tree's root stands for its missing levels
            (top, lo, hi), (top2, lo2, hi2) = a[min(level, len(a)) - 1], b[min(level, len(b)) - 1]
            x, y = np.arange(i * FAN, min(i * FAN + FAN, len(lo))), np.arange(j * FAN, min(j * FAN + FAN, len(lo2)))
            bound = np.minimum(top[x][:, None, :], top2[y][None, :, :]).sum(2)
            ok = percent * np.maximum.outer(lo[x], lo2[y]) <= 100 * np.minimum.outer(hi[x], hi2[y])
            ok &= bound * (100 + percent) >= percent * np.add.outer(lo[x], lo2[y])
            if same and i == j:
                ok = np.triu(ok)
            todo += [(level - 1, int(x[u]), int(y[v])) for u, v in zip(*np.nonzero(ok), strict=True)]
            continue
        r, q = leaves[i], leaves2[j]
        both = np.minimum(points[r][:, None, :], points[q][None, :, :]).sum(2)
        ok = both * 100 >= percent * (sizes[r][:, None] + sizes[q][None, :] - both)
        if same and i == j:
            ok = np.triu(ok, 1)
        x, y = np.nonzero(ok)
        yield r[x], q[y], both[x, y]


def best_of_each(found: Iterator[tuple], comp: np.ndarray, best: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each component the ``best`` pairs of the highest share: component, i,
    j, share. What is held grows with the components, not with the pairs."""
    names, code = np.unique(comp, return_inverse=True)
    held = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.float64))
    waiting, n = [held], 0

    def cut() -> tuple[np.ndarray, ...]:
        c, i, j, share = (np.concatenate(x) for x in zip(*waiting, strict=True))
        order = np.lexsort((j, i, -share, c))
        c = c[order]
        start = np.maximum.accumulate(np.where(np.concatenate([[True], c[1:] != c[:-1]]), np.arange(len(c)), 0)) if len(c) else c
        order = order[np.arange(len(c)) - start < best]
        return tuple(x[order] for x in (np.concatenate([w[0] for w in waiting]), i, j, share))

    for i, j, share in found:
        waiting += [(code[i], i, j, share), (code[j], i, j, share)]
        n += 2 * len(i)
        if n > 1 << 16:
            waiting, n = [cut()], 0
    c, i, j, share = cut()
    yield names[c], i, j, share


def _block_pairs(percent: int, best: int):
    """comp, a, b, bound (of the similarity), open: pairs of classes of different
    components that pass the bounds. A chunk pair with at most ``FEW`` such pairs for
    each of its rows gives them all (open is null); of a larger one, each component's
    ``best`` are given, with the block's hub as open; 0: all, whatever their
    number. The rows of a chunk pair come together."""
    names = ["comp", "a", "b", "bound", "open"]

    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        cls, n, comp = (t.column(i).to_numpy() for i in (3, 4, 5))
        points = t.column(6).flatten().to_numpy().reshape(len(cls), -1).astype(np.int32)
        full = (points >= FULL).any(1)
        points[full] = n[full][:, None]
        indexed = t.column(7).to_numpy(zero_copy_only=False).astype(bool)
        met, chunk, lo, hi = t.column(9).to_numpy(), t.column(8).to_numpy(), t.column(1)[0].as_py(), t.column(2)[0].as_py()
        left = np.nonzero(chunk == lo)[0]
        right = left if lo == hi else np.nonzero(chunk == hi)[0]

        def passing() -> Iterator[tuple]:
            for i, j, bound in leaf_pairs(points, n, left, right, percent):
                ok = (comp[i] != comp[j]) & (indexed[i] | indexed[j]) & (np.minimum(met[i], met[j]) >= least_met(n[i], n[j], percent))
                if ok.any():
                    i, j, bound = i[ok], j[ok], np.minimum(bound[ok], np.minimum(n[i[ok]], n[j[ok]]))
                    yield i, j, bound / (n[i] + n[j] - bound)

        found, held, many = passing(), [], False
        if best:
            count = 0
            for own in found:
                held.append(own)
                count += len(own[0])
                if count > FEW * len(cls):
                    many = True
                    break
        if many:
            given = best_of_each(chain(held, found), comp, best)
        else:
            given = ((comp[i], i, j, share) for i, j, share in (held if best else found))
        for c, i, j, share in given:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x) for x in (c, np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j]), share)),
                 pa.array(np.full(len(c), t.column(0)[0].as_py())) if many else pa.nulls(len(c), pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for b in batches:
            if not b.num_rows:
                continue
            s, lo, hi = (b.column(i).to_numpy() for i in range(3))
            edge = np.nonzero((s[1:] != s[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]))[0] + 1
            for i, j in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows], strict=True):
                own = (s[i], lo[i], hi[i])
                if held and own != key:
                    yield from solve(held)
                    held = []
                held.append(b.slice(i, j - i))
                key = own
        if held:
            yield from solve(held)
        give_back()
    return run


def _kept(b: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """Rows whose doc_id may be in the filter, or is null."""
    ids = b.column(0)
    own = in_filter(bits, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False))
    return b.filter(pa.array(own | ids.is_null().to_numpy(zero_copy_only=False)))


def kept_texts(docs: DataFrame, classes: DataFrame, some: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id may stand for one of ``some`` classes, or
    is null; written, so that later reads are of them alone."""
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(classes.join(some, "cls", "left_semi").filter("rep IS NOT NULL"), "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(byte_slices(batches, 1)):
            yield _kept(b, bits.value)
    return stored(docs.mapInArrow(run, docs.schema))


def _sets(k: int, bits, short: bool):
    """cls, elements of the documents that the filter lets pass; ``short``: of
    each element 16 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(byte_slices(batches, 1)):
            b = _kept(b, bits.value)
            own = [s for s, _ in shingle_sets(b.column(1), k) if len(s)]
            at = np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int32)
            flat = np.concatenate(own) if own else np.empty(0, np.uint64)
            flat = flat.astype(np.uint16).view(np.int16) if short else flat.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([class_hash(s) for s in own], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["id", "elements"])
    return run


def _links(percent: int, short: bool):
    """a, b of the verified pairs; rows are sorted by a, salt, role, and the row
    of role 0 is a's own set. ``short``: the elements of b whose 16 bits a has
    are no fewer than the common ones, so no link is lost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key, size = np.empty(0, np.int64), None, 0
        for b in slices(batches):
            a, salt, role, other = (b.column(i).to_numpy() for i in range(4))
            lists = b.column(4)
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            out = []
            for i in range(b.num_rows):
                members = flat[at[i]:at[i + 1]]
                if role[i] == 0:
                    own, key, size = np.unique(members), (a[i], salt[i]), len(members)
                    continue
                assert key == (a[i], salt[i])
                place = np.searchsorted(own, members)
                place[place == len(own)] = 0
                common = min(int((own[place] == members).sum()), size)
                if 100 * common >= percent * (size + len(members) - common):
                    out.append((a[i], other[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
    return run


def verify(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int, short: bool = False) -> DataFrame:
    """The pairs (a, b) of classes that are linked. The sets are computed anew
    from one document of each class that occurs in a pair; a's set meets its
    partners' in as many tasks as their number asks for. ``short`` moves 16 bits
    of each element and also keeps pairs that only look linked."""
    spark = docs.sparkSession
    ids = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b")).distinct()
    bits = spark.sparkContext.broadcast(key_filter(classes.join(ids, "cls", "left_semi").filter("rep IS NOT NULL"), "rep"))
    sets = docs.mapInArrow(_sets(k, bits, short), f"id long, elements array<{'smallint' if short else 'bigint'}>")
    salted = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("salts")), "a")
    rows = salted.select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), F.col("b").alias("id"))
    hubs = (salted.select("a", "salts").distinct()
            .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("id")))
    met = rows.unionAll(hubs).join(sets, "id").select("a", "salt", "role", "id", "elements")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stored(met.repartition(n, "a", "salt").sortWithinPartitions("a", "salt", "role")
                  .mapInArrow(_links(percent, short), "a long, b long").distinct())


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node that links reach) of the linked nodes, by
    passing on the smallest label and halving paths. Written each round."""
    edges = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("near")))
        better = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("best"))
        up = labels.select(F.col("node").alias("best"), F.col("root").alias("above"))
        moved = stored(better.join(up, "best", "left").select("node", "root", F.least("best", F.coalesce("above", "best")).alias("best")))
        if moved.filter("best <> root").isEmpty():
            return labels
        labels = moved.select("node", F.col("best").alias("root"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, groups: int = GROUPS, frequent: int = 1 << 16,
                    chunk: int = 4096, rounds: int = 3) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with doc_id, n_shingles, component_id.
    ``frequent`` words, the most frequent of all documents, are sent out to order
    the shingles; the order has no effect on the result, nor have ``rounds``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    top = (docs.select("text").mapInArrow(_word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.col("n").desc(), "word").limit(frequent).toArrow())
    ranks = spark.sparkContext.broadcast((pc.cast(top["word"], pa.large_string()).combine_chunks(), top["n"].to_numpy().astype(np.int64)))

    points = stored(docs.mapInArrow(_points(k, groups, percent, ranks), "doc_id long, n long, cls long, point array<smallint>, first array<bigint>"))
    classes = stored(points.filter(F.col("cls").isNotNull()).groupBy("cls", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a row for each class and hub, with the number of shingles for which the class has that hub
    blocks = stored(first_shingles(points, classes, percent).repartition(parts, "shingle").sortWithinPartitions("shingle", "n", "cls")
                    .mapInArrow(_shared, "shingle long, cls long, hub long, indexed boolean")
                    .groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("common"), F.max("indexed").alias("indexed")))
    sizes = classes.select("cls", "n")
    shared = stored(blocks.groupBy("cls").agg(F.sum("common").alias("met")).join(sizes, "cls"))
    near = stored(points.select("cls", "point").join(shared.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.min("point").alias("point")))

    # one hub for each class: of those of a fitting size, the one with most common shingles
    hubs = shared.select(F.col("cls").alias("hub"), F.col("n").alias("m"), F.col("met").alias("hub_met"))
    tried = (blocks.filter("cls <> hub").join(shared, "cls").join(hubs, "hub")
             .filter((F.greatest("n", "m") * percent <= F.least("n", "m") * 100)
                     & (F.least("met", "hub_met") >= least_met(F.col("n"), F.col("m"), percent)))
             .groupBy("cls").agg(F.max(F.struct("common", "hub", "n", "m")).alias("best")).select("cls", "best.hub", "best.n", "best.m"))
    # and of those pairs, the ones that their points' bound allows
    tried = (stored(tried).join(near, "cls").join(near.select(F.col("cls").alias("hub"), F.col("point").alias("other")), "hub")
             .filter(_close_enough(F.col("point"), F.col("other"), F.col("n"), F.col("m"), percent)))
    links = verify(stored(tried.select(F.col("hub").alias("a"), F.col("cls").alias("b"))), docs, classes, k, percent)
    first = components(links)

    def candidates(rows: DataFrame, best: int) -> DataFrame:
        """comp, a, b, bound of the pairs that the blocks' trees find."""
        rows = rows.join(near, "cls")
        small = rows.filter(F.col("members") <= chunk).withColumn("chunk", F.lit(0)).withColumn("chunks", F.lit(1))
        big = rows.filter(F.col("members") > chunk).withColumn("chunks", F.ceil(F.col("members") / chunk).cast("int"))
        big = big.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
        spread = small.unionByName(big).select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with"))
        ready = (spread.select("hub", F.least("chunk", "with").alias("lo"), F.greatest("chunk", "with").alias("hi"),
                               "cls", "n", "comp", "point", "indexed", "chunk", "met")
                 .repartition(parts, "hub", "lo", "hi").sortWithinPartitions("hub", "lo", "hi"))
        return ready.mapInArrow(_block_pairs(percent, best), "comp long, a long, b long, bound double, open long")

    found, tested = first, None
    blocks = blocks.select("hub", "cls", "indexed")
    for best in range(1, rounds + 2):
        known = shared.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "n", "met", F.coalesce("root", "cls").alias("comp"))
        rows = blocks.select("hub", "cls", "indexed").join(known, "cls")
        mixed = (rows.groupBy("hub").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("members"))
                 .filter("x <> y").select("hub", "members"))
        blocks = stored(rows.join(mixed, "hub"))      # a block that lies in one component is done with
        if blocks.isEmpty():
            break
        if best > 1:      # what is left is a small part of the classes
            left = blocks.select("cls").distinct()
            near = stored(near.join(left, "cls", "left_semi"))
            docs = kept_texts(docs, classes, left) if best == 2 else docs
        last = best > rounds
        pairs = stored(candidates(blocks, 0 if last else best).distinct())
        blocks = blocks.join(pairs.filter("open IS NOT NULL").select(F.col("open").alias("hub")).distinct(), "hub", "left_semi")
        sure = pairs.filter("open IS NULL").select("a", "b").distinct()
        some = pairs.filter("open IS NOT NULL").select("comp", "a", "b", "bound").distinct()
        if tested is not None:
            sure, some = (x.join(tested, ["a", "b"], "left_anti") for x in (sure, some))
        some = some.groupBy("comp").agg(F.max(F.struct("bound", "a", "b")).alias("p")).select("p.a", "p.b")
        pairs = stored(sure.unionAll(some).distinct())
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.unionAll(pairs)
        likely = verify(pairs, docs, classes, k, percent, short=True)
        links = stored(links.unionAll(verify(likely, docs, classes, k, percent)))
        found = components(links)

    rooted = points.select("doc_id", "n", "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
        "doc_id", "n", F.coalesce("root", "cls").alias("root"))
    ids = rooted.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(ids, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op10_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents``: doc_id, n_shingles, component_id by links of
    five-word shingle sets with a Jaccard similarity of 0.75 or more."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
