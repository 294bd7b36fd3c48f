"""The conversation prefix trie (operator 12) against a plain version."""
import hashlib
import random
import zlib

import pytest

from touchline.llm import prefix_trie as P

TURNS = "conv_id long, turn long, role string, text string"


def plain_conversations(turns, shared=6):
    code = lambda role, text: hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", code(role or "", text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        base = c - int(c / 100) * 100
        out[c] = own.get(c - base, [])[:h] + ts[h:]
    return out


def plain(convs):
    """Nodes by path, each aggregate taken straight from its definition."""
    members, ends, children = {}, {}, {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), set()).add(c)
            if d:
                children.setdefault(tuple(path[:d - 1]), set()).add(tuple(path[:d]))
        ends.setdefault(tuple(path), []).append(c)
    rows = []
    for path, own in members.items():
        subtree = [q for q in members if q[:len(path)] == path]
        rows.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children.get(path, ())),
                     sum(q not in children for q in subtree), sum((len(members[q]) - 1) * (len(q[-1][1]) if q else 0) for q in subtree),
                     hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()))
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
                   for r in df.collect()), key=str)


def table_of(seed, n=90, hot=25, deep=0):
    rng, turns = random.Random(seed), []
    for c in [*range(n), 100, 107, 155, 203, -1, -100, -155, 1_000_000]:
        for t in range(rng.randint(1, 7)):
            turns.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é日", "", None])))
    for c in range(300, 300 + hot):     # a conversation that many share, and its continuations
        turns += [(c, t, "user", f"hot {t}") for t in range(6 + deep + (c % 5 == 0))]
    turns += [(None, 0, "user", "nobody"), (7, None, "system", "first"), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (8, 1, "a", "tie")]
    rng.shuffle(turns)
    return turns


@pytest.mark.parametrize(("shards", "deep"), [(1, 0), (2, 0), (9, 0), (60, 0), (12, 45)])
def test_trie_equals_a_plain_version(spark, shards, deep):
    turns = table_of(shards, deep=deep)
    df = spark.createDataFrame([(*t, "x", b"k") for t in turns], TURNS + ", path string, key binary")
    assert found(P.prefix_trie(P.rebuilt(df), shards)) == plain(plain_conversations(turns))


def test_rebuilding_takes_the_first_turns_of_the_base(spark):
    turns = table_of(5)
    want = {c: [len(x) for _, x in path] for c, path in plain_conversations(turns).items()}
    got = {r.conv_id: r.lengths for r in P.rebuilt(spark.createDataFrame(turns, TURNS)).collect()}
    assert got == want


def test_turnless_conversations_belong_to_the_root(spark):
    """A conversation whose turns are all replaced by a shorter base has none left."""
    c = next(i for i in range(101, 200) if zlib.crc32(str(i).encode()) % 6 >= 2)
    turns = [(c, 0, "user", "gone"), (c + 1000, 0, "user", "x")]
    rows = found(P.prefix_trie(P.rebuilt(spark.createDataFrame(turns, TURNS)), 3))
    assert rows == plain(plain_conversations(turns))
    assert (c, 0, None, 2) == next(r for r in rows if r[1] == 0)[:4]


def test_a_very_long_conversation_and_an_empty_table(spark):
    turns = [(c, t, "user", f"{t}" * 50) for c in (500, 501) for t in range(700)]
    convs = plain_conversations(turns)
    rows = found(P.prefix_trie(P.rebuilt(spark.createDataFrame(turns, TURNS)), 4))
    assert len(rows) == len({tuple(p[:d]) for p in convs.values() for d in range(len(p) + 1)})
    root = next(r for r in rows if r[1] == 0)
    assert root[3] == 2 and root[6] == sum(len(x) for _, x in convs[500]) == sum(len(x) for _, x in convs[501])
    assert P.prefix_trie(P.rebuilt(spark.createDataFrame([], TURNS))).count() == 0


def test_blocks_of_ids_are_digested_in_order(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 16)
    turns = [(c, 0, "user", "same") for c in range(600, 700)] + [(c, 0, "user", "same") for c in range(-50, 0)]
    assert found(P.prefix_trie(P.rebuilt(spark.createDataFrame(turns, TURNS)), 7)) == plain(plain_conversations(turns))
