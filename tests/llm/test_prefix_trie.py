"""The prefix trie against a dictionary of prefixes, in bands of several heights."""

import hashlib
import random

import pytest

from lexigrid.llm import queries
from lexigrid.llm.prefix_trie import PrefixTrie, digests, turn_items

SCHEMA = "conv_id long, turn long, role string, text string, pos long, item string, node string"
NOBODY = hashlib.sha256(b"").hexdigest()


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def sequences(rows):
    def key(r):
        role, text = (x or "" for x in r[2:4])
        return r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def brute(convs):
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    saved = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    leaves = {p: int(p not in children) for p in members}
    for path in sorted(members, key=len, reverse=True):
        if path:
            saved[path[:-1]] += saved[path]
            leaves[path[:-1]] += leaves[path]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), above, len(m), children.get(p, 0), leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def found(trie):
    rows = trie.nodes().join(digests(trie.ends()), "node", "left").collect()
    kept = [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved, r.digest or NOBODY) for r in rows]
    return sorted(kept, key=repr)


def trie_of(spark, rows, height, more=()):
    frame = table(spark, rows)
    members = frame.where("conv_id IS NOT NULL").select("conv_id").union(spark.createDataFrame([(c,) for c in more], "conv_id long"))
    return PrefixTrie(turn_items(frame), members.distinct(), height)


def draw(seed):
    rng, rows, before = random.Random(seed), [], []
    for c in range(-20, 60):
        turns = [(rng.choice("ua"), rng.choice(["", "ab", "é🙂"])) for _ in range(rng.choice([1, 2, 3, 9, 30]))]
        if c % 4 == 0 and before:
            turns = before[: rng.randrange(1, len(before) + 1)] + turns[:2]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
        before = turns
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 3, 32])
def test_all_values_in_bands_of_any_height(spark, height):
    rows = draw(height)
    assert found(trie_of(spark, rows, height)) == brute(sequences(rows))


def test_nulls_ties_repeated_rows_and_conversations_without_turns(spark):
    rows = [
        (1, None, None, None), (1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "a", "x"), (2, 5, None, ""), (2, 7, "u", "x"),
        (None, 1, "u", "lost"), (3, -1, "", None), (9, 2, "u", "long " * 100_000),
    ]
    convs = sequences(rows) | {77: [], 78: []}
    assert found(trie_of(spark, rows, 4, more=[77, 78])) == brute(convs)


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "u", f"turn {t}") for c in range(3000) for t in range(3)] + [(5000, t, "u", f"turn {t}") for t in range(400)]
    assert found(trie_of(spark, rows, 32)) == brute(sequences(rows))


def test_no_conversation(spark):
    assert found(trie_of(spark, [], 32)) == []


def test_rebuilt_conversations(spark, tmp_path):
    def crc(c):
        import zlib

        return zlib.crc32(str(c).encode()) % 6

    rng = random.Random(5)
    rows = [(c, t, rng.choice("ua"), f"{rng.randrange(3)}") for c in [*range(-3, 40), *range(95, 130), 300, 1234] for t in range(rng.randrange(1, 9))]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    own = sequences(rows)
    convs = {}
    for c, turns in own.items():
        base = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        convs[c] = base[: crc(c)] + turns[crc(c) :]
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = queries.op12_prefix_trie(spark, str(tmp_path)).select(names).collect()
    assert sorted(map(tuple, got), key=repr) == brute(convs)
