"""Conversation trie: brute force, SQL, hot conversations, spilling, odd rows."""

import random

import pytest
from brute import trie as brute_trie
from test_set_operators import same

from seekframe.llm.trie import TRIE_SQL, SpillingQueue, conversations_digest, member_digests, numbered_turns, paths_of, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(spark, turns, parts=3, **more):
    df = spark.createDataFrame(turns, SCHEMA).repartition(parts)
    return sorted(map(tuple, conversations_digest(df, **more).collect()))


def made(seed: int, n: int) -> list[tuple]:
    """Few distinct texts, so that conversations share beginnings of every length; some conversations are missing."""
    rng = random.Random(seed)
    out = []
    for c in range(n):
        if rng.random() < .9:
            for t in range(rng.randint(1, 12)):
                out.append((c, t if t or rng.random() < .8 else None, rng.choice(["user", "user", None]), rng.choice(["a", "é", "", None])))
    return out


def test_trie_against_brute_force(spark):
    turns = made(1, 150)
    assert digest(spark, turns, 7) == brute_trie(turns)


@pytest.mark.parametrize("shard_rows", [0, 6])
def test_heavy_nodes_give_the_same_totals(spark, shard_rows):
    turns = made(2, 90)
    assert digest(spark, turns, 4, shard_rows=shard_rows, room=2) == brute_trie(turns)


def test_one_long_conversation_and_many_copies(spark):
    turns = [(50, t, "user", f"t{t % 7}") for t in range(900)]              # over several tasks
    turns += [(c, t, "user", f"t{t}") for c in range(1000, 1400) for t in range(3)]
    turns += [(c, t, "user", "same" if t < 9 else f"x{c}") for c in range(2000, 2040) for t in range(10)]
    want = brute_trie(turns)
    assert digest(spark, turns, 5) == want
    assert digest(spark, turns, 5, shard_rows=30, room=50) == want


def test_snapshots_after_every_turn(spark):
    turns = [(c, t, "u", f"t{t}") for c in range(40) for t in range(c)]
    df = spark.createDataFrame(turns, SCHEMA)
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie(paths_of(numbered_turns(df)), shard_rows=20).collect()}
    assert len(got) == 40 and got[1, 0]["n_convs"] == 39
    assert all(got[d, d]["n_convs"] == 40 - d and got[d, d]["n_leaves"] == 1 for d in range(1, 40))
    assert got[2, 2]["parent_conv_id"] == 1


def test_trie_sql(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    same(conversations_digest(df), TRIE_SQL, conversations=df)
    turns = spark.createDataFrame(made(3, 60), SCHEMA)
    same(conversations_digest(turns), TRIE_SQL, conversations=turns)


def test_member_lists_in_chunks(spark, monkeypatch):
    import hashlib

    from seekframe.llm import trie
    monkeypatch.setattr(trie, "_IDS", 7)
    turns = [(c, 0, "u", "same" if c % 3 else "other") for c in range(-40, 200)]
    paths = paths_of(numbered_turns(spark.createDataFrame(turns, SCHEMA)))
    got = {r["ends_sha256"] for r in member_digests(paths).collect()}
    assert got == {hashlib.sha256(",".join(str(c) for c in range(-40, 200) if bool(c % 3) == k).encode()).hexdigest() for k in (True, False)}


def test_queue_spills_and_stays_sorted():
    rng = random.Random(0)
    q, out, last = SpillingQueue(room=8), [], 0
    items = sorted((rng.randrange(10**6), bytes([i % 251]), i) for i in range(2000))
    rng.shuffle(items)
    for x in items:
        q.push(x)
    while q.peek() is not None:
        out.append(q.pop())
    assert out == sorted(items) and q.runs > 10
    for x in range(0, 3000, 3):                                             # pushes between pops, as in time-forward processing
        q.push((x + 50,))
        while q.peek() and q.peek()[0] <= x:
            assert last <= (last := q.pop()[0])


def test_trie_odd_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations_digest(empty).collect() == []
    turns = [(None, 1, "u", "x"), (4, None, None, None), (4, None, None, None), (4, 2, "u", "long " * 50_000), (7, 1, "u", ""), (-3, 1, "u", "n"),
             (9, 5, "u", "tie"), (9, 5, "v", "tie"), (9, 5, "u", "tie")]
    clash = spark.createDataFrame([(*t, "x", 1, b"n", b"p", 2, 3) for t in turns],
                                  SCHEMA + ", node string, depth long, parent binary, _by binary, at long, pid int")
    got = sorted(map(tuple, conversations_digest(clash).collect()))
    assert got == sorted(map(tuple, conversations_digest(clash.repartition(5)).collect()))
    root = [r for r in got if r[1] == 0]
    assert len(root) == 1 and root[0][:4] == (-3, 0, None, 4)
    plain = [t for t in turns if t[0] != 9]
    assert digest(spark, plain) == brute_trie(plain)
