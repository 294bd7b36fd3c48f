"""Byte-level BPE encoding and decoding (operator 9).

The texts are cut by the public split pattern in Spark (Java's regular
expressions). Each Arrow batch encodes its distinct pieces once: per piece a
segment tree over the byte positions stores the leftmost minimum of the pair
ranks; a merge reads the root, joins the two live neighbours and makes three
logarithmic point updates. Pieces of like length share one numpy array of
trees; long pieces use the same tree one at a time.

Cases: null text counts as empty and gives no ids; an empty text gives an empty
binary; repeated rows are encoded alike, each on its own row; other columns
pass unchanged (``ids`` and ``decoded`` are names of this operator and are
replaced); an empty table gives an empty table.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import clean_text, ship

ship(__name__)

NONE = np.int64(1) << 60  # key of a position without a mergeable pair
_WS = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The public split pattern in Java's syntax: white space spelled out, as \s is
#: ASCII only there.
JAVA_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}]+"
                r"|[" + _WS + r"]+(?![^" + _WS + r"])|[" + _WS + r"]+")
#: Pieces with more bytes than this are merged one at a time.
LONG = 128
#: Pieces that are encoded at once; bounds the worker's memory.
SLICE = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """Token -> rank of a rank file (base64 token and rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    """Token of each rank."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Merges:
    """A rank file and its table of mergeable pairs of ids."""

    def __init__(self, path: str) -> None:
        self.ranks = read_ranks(path)
        get = self.ranks.get
        pairs = []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = get(token[:i]), get(token[i:])
                if a is not None and b is not None:
                    pairs.append((a << 32 | b, rank))
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs] + [1 << 62], np.int64)
        self.values = np.array([v for _, v in pairs] + [-1], np.int64)
        self.of_byte = np.array([get(bytes([i]), -1) for i in range(256)], np.int64)
        if (self.of_byte < 0).any():
            raise ValueError("the rank file lacks single bytes")
        self.tokens = tokens_of(self.ranks)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or -1."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)


def merge_many(data: np.ndarray, lengths: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Merge pieces together. ``data``: (n, w) bytes, w a power of two, padded;
    returns (ids (n, w) with -1 at dead positions, count per piece)."""
    n, w = data.shape
    rows = np.arange(n)
    ids = np.full((n, w + 1), -1, np.int64)
    cols = np.arange(w)
    live = cols[None, :] < lengths[:, None]
    ids[:, :w] = np.where(live, merges.of_byte[data], -1)
    nxt = np.tile(np.arange(1, w + 2, dtype=np.int32), (n, 1))   # position w: the end
    prv = np.tile(np.arange(-1, w, dtype=np.int32), (n, 1))
    nxt[:, :w][cols[None, :] + 1 >= lengths[:, None]] = w

    tree = np.full((n, 2 * w), NONE, np.int64)
    pair = cols[None, :] + 1 < lengths[:, None]
    r, c = np.nonzero(pair)
    rank = merges.rank(ids[r, c], ids[r, c + 1])
    tree[r, w + c] = np.where(rank >= 0, rank * w + c, NONE)
    level = w
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level = half

    def put(rw: np.ndarray, pos: np.ndarray, key: np.ndarray) -> None:
        """Point update: the leaf, then the way up to the root."""
        node = pos + w
        tree[rw, node] = key
        while node[0] > 1:
            node = node >> 1
            tree[rw, node] = np.minimum(tree[rw, 2 * node], tree[rw, 2 * node + 1])

    def key_at(rw: np.ndarray, pos: np.ndarray) -> np.ndarray:
        right = nxt[rw, pos]
        rank = merges.rank(ids[rw, pos], np.maximum(ids[rw, right], 0))
        return np.where((right < w) & (rank >= 0), rank * w + pos, NONE)

    act = rows[tree[:, 1] < NONE] if w > 1 else rows[:0]
    while len(act):
        top = tree[act, 1]
        pos = top % w
        right = nxt[act, pos]
        after = nxt[act, right]
        ids[act, pos] = top // w
        ids[act, right] = -1
        nxt[act, pos] = after
        prv[act, after] = pos       # position w takes writes of the last pair
        put(act, right.astype(np.int64), np.full(len(act), NONE))
        put(act, pos, key_at(act, pos))
        left = prv[act, pos].astype(np.int64)
        has = left >= 0
        if has.any():
            put(act[has], left[has], key_at(act[has], left[has]))
        act = act[tree[act, 1] < NONE]
    return ids[:, :w], (ids[:, :w] >= 0).sum(1)


def merge_one(piece: bytes, merges: Merges) -> list[int]:
    """The same tree for one long piece."""
    n = len(piece)
    w = 1 << max(1, (n - 1).bit_length())
    get, tokens, none = merges.ranks.get, merges.tokens, int(NONE)
    ids = [int(merges.of_byte[b]) for b in piece]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * w)

    def key(pos: int) -> int:
        if nxt[pos] >= n:
            return none
        rank = get(tokens[ids[pos]] + tokens[ids[nxt[pos]]])
        return none if rank is None else rank * w + pos

    def put(pos: int, value: int) -> None:
        node = pos + w
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
            node >>= 1

    for i in range(n - 1):
        tree[w + i] = key(i)
    for node in range(w - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] < none:
        pos, rank = tree[1] % w, tree[1] // w
        right = nxt[pos]
        ids[pos], ids[right] = rank, -1
        nxt[pos] = nxt[right]
        if nxt[pos] < n:
            prv[nxt[pos]] = pos
        put(right, none)
        put(pos, key(pos))
        if prv[pos] >= 0:
            put(prv[pos], key(prv[pos]))
    return [i for i in ids if i >= 0]


def encode_pieces(pieces: pa.Array, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after the other, and the pieces' offsets."""
    raw = pc.cast(pieces, pa.large_binary())
    n = len(raw)
    buffers = raw.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[raw.offset:raw.offset + n + 1]
    flat = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    lengths = np.diff(offsets)
    whole = np.fromiter((merges.ranks.get(p, -1) for p in raw.to_pylist()), np.int64, n)
    count = np.where(whole >= 0, 1, 0)
    found: list[tuple[np.ndarray, np.ndarray]] = []   # (piece numbers repeated, ids) in piece order
    rest = np.nonzero(whole < 0)[0]
    known = np.nonzero(whole >= 0)[0]
    found.append((known, whole[known]))
    width = 2
    while len(rest) and width <= LONG:
        own = rest[(lengths[rest] <= width) & (lengths[rest] > width // 2 if width > 2 else True)]
        for part in np.array_split(own, max(1, len(own) * width // (1 << 19))) if len(own) else []:
            size = lengths[part]
            at = np.minimum(offsets[part][:, None] + np.arange(width), max(len(flat) - 1, 0))
            ids, k = merge_many(flat[at], size, merges)
            r, c = np.nonzero(ids >= 0)
            found.append((part[r], ids[r, c]))
            count[part] = k
        width *= 2
    for i in rest[lengths[rest] > LONG]:
        ids = merge_one(flat[offsets[i]:offsets[i + 1]].tobytes(), merges)
        found.append((np.full(len(ids), i), np.array(ids, np.int64)))
        count[i] = len(ids)
    owner = np.concatenate([a for a, _ in found])
    values = np.concatenate([b for _, b in found])
    order = np.argsort(owner, kind="stable")
    return values[order].astype("<u4"), np.concatenate([[0], np.cumsum(count)])


def encode(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids``: the token ids of each whole text as little-endian
    unsigned 32-bit integers (binary). No special tokens."""
    keep = [c for c in docs.columns if c.lower() != ids.lower()]
    piece_col = "__pieces__"
    src = docs.select(*[F.col(f"`{c}`") for c in keep],
                      F.regexp_extract_all(clean_text(F.col(f"`{text}`")), F.lit(JAVA_PATTERN), F.lit(0)).alias(piece_col))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())   # freed batches go back to the machine
        merges = Merges(ranks_path)
        for batch in batches:
            out = _encode_lists(batch.column(len(keep)), merges)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(out, pa.binary())],
                                             names=[*batch.schema.names[:len(keep)], ids])

    return src.mapInArrow(run, schema)


def _encode_lists(lists: pa.ListArray, merges: Merges) -> list[bytes]:
    """Packed ids of each list of pieces; a run of documents of about SLICE
    pieces is laid out at a time."""
    bounds = lists.offsets.to_numpy().astype(np.int64)
    out: list[bytes] = []
    start = 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + SLICE, "right")) - 1)
        encoded = pc.dictionary_encode(lists.values.slice(bounds[start], bounds[stop] - bounds[start]))
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        ids, at = encode_pieces(encoded.dictionary, merges)
        size = at[codes + 1] - at[codes]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(at[codes] - (ends - size), size) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], ends])[bounds[start:stop + 1] - bounds[start]] * 4
        out += [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        start = stop
    return out


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the ids in column ``ids``
    (null: null). An id that the rank file lacks raises."""
    keep = [c for c in encoded.columns if c.lower() != decoded.lower()]
    at = keep.index(ids)
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        tokens = tokens_of(read_ranks(ranks_path))
        for batch in batches:
            out = [None if x is None else b"".join([tokens[i] for i in np.frombuffer(x, "<u4").tolist()])
                   for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(out, pa.binary())],
                                             names=[*batch.schema.names[:len(keep)], decoded])

    return encoded.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """doc_id, number of tokens and digests of ids and decoded bytes."""
    return encoded.select(
        "doc_id", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col(ids), 256).alias("ids_sha256"), F.sha2(F.col(decoded), 256).alias("decoded_sha256"))


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded by the public 50k rank file and
    decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    from touchline.llm.common import table

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(decode(encode(docs, path).drop("text"), path))
