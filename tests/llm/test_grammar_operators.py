"""Byte-level BPE and periodic runs: exact against tiktoken and plain versions, odd rows."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from brute import periodic, word_runs
from pyspark.sql import functions as F

from seekframe.llm.bytepair import PATTERN, VOCABULARY, BytePairs, bytepair_digest, decode_ids, encode_texts, load_ranks
from seekframe.llm.grammar import Grammar
from seekframe.llm.periodic import find_runs, periodic_digest, periodic_runs


def by_row(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# byte-level BPE

@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    ranks = load_ranks(public_tokenizers.path(request.param))
    return BytePairs(ranks), tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(pairs, text):
    return np.frombuffer(pairs.encode(text), "<u4").tolist()


def test_same_ids_as_the_library(both):
    pairs, plain = both
    rng = random.Random(11)
    tokens = list(pairs.ranks)
    texts = [b"".join(rng.choices(tokens, k=rng.randint(1, 12))).decode("utf-8", "ignore") for _ in range(1500)]
    for alphabet in ("ab", "abc", "the ", "aein rst", "\u00e9\u00e8\u00e0\u00e7", "\u65e5\u672c\u8a9e\u6587", "\u0430\u0431\u0432", "\n \t x", "!?.-=_'s", "0123"):
        texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 90))) for _ in range(300)]
    texts += ["", "<|endoftext|>", "a" * 30_000, "ab" * 15_000, " " * 5_000 + "x", "\x1c\x85\u2028\u200b\x00"]
    for t in texts:
        got = ids(pairs, t)
        assert got == plain.encode_ordinary(t), t[:100]
        assert pairs.decode(np.array(got, "<u4").tobytes()) == t.encode()


def test_every_code_point_is_split_alike(both):
    pairs, plain = both
    for c in [*range(0xD800, 7), *range(0x1000), *range(0xE000, 0x110000, 397)]:
        t = f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}!{chr(c)} "
        assert ids(pairs, t) == plain.encode_ordinary(t), hex(c)


def test_a_small_table_of_pieces_changes_nothing():
    ranks = load_ranks()
    small, large = BytePairs(ranks, memo=8), BytePairs(ranks)
    for k in range(200):
        t = " ".join(f"w{(k * i) % 37}x" for i in range(40))
        assert small.encode(t) == large.encode(t)


def test_a_whole_piece_that_no_merge_gives_is_one_token():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"xyz": 258, b"abc": 259}
    pairs, plain = BytePairs(ranks), tiktoken.Encoding("p", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert pairs.unreachable == {258}
    for t in ("xyz", "xyza", "axyz", "abc", "abcd", "bcd", "xyzabcxyz", "babcab"):
        assert ids(pairs, t) == plain.encode_ordinary(t)


def test_digest_over_a_table(spark, documents):
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=load_ranks(VOCABULARY), special_tokens={})
    want = []
    for i, t in documents.select("doc_id", "text").collect():
        got = np.array(plain.encode_ordinary(t or ""), "<u4").tobytes()
        want.append((i, len(got) // 4, hashlib.sha256(got).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_row(bytepair_digest(documents)) == sorted(want, key=repr)


def test_bytepair_odd_rows(odd, none):
    encoded = encode_texts(odd)
    assert encoded.columns == ["doc_id", "ids"] and encoded.count() == odd.count()
    back = decode_ids(encoded).select("doc_id", F.col("decoded").cast("string").alias("text"))
    assert by_row(back) == by_row(odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    assert bytepair_digest(none).collect() == []
    got = bytepair_digest(odd).filter("doc_id in (1, 2)").collect()
    assert {(r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == {(0, *[hashlib.sha256(b"").hexdigest()] * 2)}


# grammar and periodic runs

def test_extensions_follow_a_plain_comparison():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.choice([3, 20, 70, 250])
        s = [0, *(1 + rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(n)), 99]
        if rng.random() < .6:
            p = rng.randint(1, 9)
            s[1:-1] = [s[1 + k % min(p, n)] for k in range(n)]
        at = sorted(rng.sample(range(1, n + 1), 2) for _ in range(40))
        i, j = np.array([sorted(x) for x in at]).T
        s = np.array(s)
        g = Grammar(s)
        for a, b, right, left in zip(i, j, g.extend(i, j), g.extend(i, j, -1)):
            assert right == next(k for k in range(n + 2) if s[a + k] != s[b + k])
            assert left == next(k for k in range(n + 2) if s[a - k] != s[b - k])


def test_runs_follow_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 12)):
            n, size = rng.choice([0, 3, 6, 7, 30, 100, 400]), rng.choice([1, 2, 3, 50])
            w = [rng.randrange(size) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n > 10 else 0):
                a, p = rng.randrange(n - 5), rng.randint(1, 12)
                for k in range(a, min(n, a + p * rng.randint(3, 8))):
                    w[k] = w[a + (k - a) % p]
            texts.append(np.array(w, np.int64))
        assert find_runs(texts) == [word_runs(t.tolist()) for t in texts]


def test_nested_and_neighbouring_runs():
    a = "x x x x x x y " * 4 + "z z z z z z"
    w = a.split()
    got = find_runs([np.array([" xyz".index(c) for c in w])])[0]
    assert got == word_runs(w) and (0, 28, 7) in got and (0, 6, 1) in got and (28, 6, 1) in got


def test_periodic_digest_against_brute_force(documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in periodic_digest(documents).collect()}
    want = {i: periodic(i, t) for i, t in documents.select("doc_id", "text").collect()}
    assert got == want and sum(r[0] > 0 for r in got.values()) > 5


def test_groups_do_not_matter_and_texts_collapse(spark):
    line = "buy now cheap " * 9
    df = spark.createDataFrame([(i, f"start{i} {line}end{i}") for i in range(40)], "doc_id long, text string")
    rows = periodic_runs(df, group_words=35).collect()
    assert {r["collapsed"] for r in rows} == {f"start{i} buy now cheap end{i}" for i in range(40)}
    assert {tuple(map(tuple, r["runs"])) for r in rows} == {((1, 27, 3),)}
    assert by_row(periodic_runs(df)) == by_row(periodic_runs(df, group_words=35))


def test_periodic_odd_rows(odd, none):
    got = sorted((tuple(r) for r in periodic_digest(odd).collect()), key=repr)
    want = sorted(((i, *periodic(i, t)) for i, t in odd.select("doc_id", "text").collect()), key=repr)
    assert got == want
    assert periodic_digest(none).collect() == []
