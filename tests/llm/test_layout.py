"""Shards, packing, exact top-k and components against plain versions; the pipeline as a whole."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import sharding, topk
from tidelog.llm.common import components
from tidelog.llm.packing import TokenBytes, best_fit, bin_completion, completions, pack, public_tokenizer
from tidelog.llm.sharding import interleave
from tidelog.llm.topk import exact_top_k


def test_shards_have_the_mixture(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 40)
    rows = [(i, f"t{i}", "big") for i in range(700)] + [(1000 + i, "same", f"s{i % 5}") for i in range(290)]
    rows += [(2000 + i, "x", f"tiny{i}") for i in range(60)] + [(None, None, None), (None, None, None), (7, "é", "big"), (7, "é", "big")]
    table = docs(rows).withColumn("shard", F.lit(1)).withColumn("place", F.lit(1)).withColumn("draw", F.lit(1))
    got = interleave(table, 10).collect()
    assert len(got) == len(rows)
    held = Counter(x.shard for x in got)
    assert set(held) == set(range(10)) and max(held.values()) - min(held.values()) <= 1
    assert all(sorted(x.slot for x in got if x.shard == s) == list(range(n)) for s, n in held.items())
    total = Counter(x.source for x in got)
    for source, n in total.items():
        own = Counter(x.shard for x in got if x.source == source)
        assert all(abs(own[s] - n / 10) <= 2 + 8 * n / len(rows) for s in range(10))
    assert sorted((x.size, x.text_crc32) for x in got if x.doc_id in (7, None))[:2] == [(16, None)] * 2 and (18, zlib.crc32("é".encode())) in {
        (x.size, x.text_crc32) for x in got}
    again = interleave(table.repartition(7), 10).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert interleave(docs([]), 10).count() == 0 and {x.shard for x in interleave(docs(rows[:3]), 10).collect()} == {0, 3, 6}


def fewest(items, limit):
    best = [len(items)]

    def go(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        x = rest[0]
        for room in set(rooms):
            if room >= x:
                k = rooms.index(room)
                go(rest[1:], rooms[:k] + [room - x] + rooms[k + 1:])
        go(rest[1:], [*rooms, limit - x])
    go(sorted(items, reverse=True), [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=10))
def test_bin_completion_finds_the_fewest(items):
    plan = bin_completion(dict(Counter(items)), 20)
    used = Counter()
    for filling, n in plan:
        assert sum(filling) <= 20
        used.update({x: c * n for x, c in Counter(filling).items()})
    assert used == Counter(items) and sum(n for _, n in plan) == fewest(items, 20)


def test_fillings_of_many_short_pieces():
    for held in ({1: 5000}, {24: 3, 1: 5000}, {x: 2000 for x in range(1, 25)}):
        for filling in completions(dict(held), 1024):
            assert sum(filling) <= 1024 and all(held[x] >= c for x, c in Counter(filling).items())
        plan = bin_completion(dict(held), 1024)
        used = Counter()
        for filling, n in plan:
            used.update({x: c * n for x, c in Counter(filling).items()})
        assert used == Counter(held) and sum(n for _, n in plan) == -(-sum(x * n for x, n in held.items()) // 1024)


def test_packing_of_null_and_empty_texts_alone(docs):
    pytest.importorskip("public_tokenizers")
    got = pack(docs([(i, None if i % 2 else "") for i in range(5000)]), public_tokenizer()).toPandas()
    assert len(got) == 5000 and set(got.doc_id) == set(range(5000)) and got.sequence_id.nunique() == 5
    assert not got.duplicated(["sequence_id", "offset"]).any() and got.offset.max() < 1024


@pytest.fixture(scope="module")
def coder():
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public_tokenizer())
    return TokenBytes(public_tokenizer()), lambda x: np.array(t.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=40), st.text("ab '.,!?\n\té1  ’s", max_size=40)))
def test_ids_are_the_tokenizers(coder, text):
    fast, plain = coder
    assert fast(text) == plain(text)


def test_ids_of_odd_and_repeated_parts(coder):
    fast, plain = coder
    words = ["word", "a\nb", "a\n\nb", "", "\n", "\t", "x\r\ny", "a\u00a0", "\u2003b", "it's", "\x1c", "na\u00efve", "12", "long" * 40]
    r = random.Random(5)
    for _ in range(400):
        text = " ".join(r.choice(words[: r.choice([2, 3, 14])]) for _ in range(r.randint(0, 30)))
        assert fast(text) == plain(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b", "a  <|endoftext|><|endoftext|>\nb ", "<|endoftext", " <|endoftext|>x y"])
def test_the_string_of_an_added_token_is_that_token(coder, text):
    fast, plain = coder
    assert fast(text) == plain(text)
    assert (50256 in np.frombuffer(fast(text), "<u4")) == ("<|endoftext|>" in text)


def test_packing_round_trip(docs, coder):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(["alpha", "be", "gamma1", "x.\ny"]) for _ in range(r.choice([3, 90, 900, 2500])))) for i in range(40)]
    rows += [(50, None), (51, ""), (None, "one"), (3, rows[3][1]), (3, rows[3][1]), (52, "y " * 60_000)]
    table = docs(rows).withColumn("length", F.lit(1)).withColumn("rank", F.lit(1)).withColumn("block", F.lit(1))
    got = pack(table, public_tokenizer()).toPandas()
    want = Counter()
    for i, text in rows:
        ids = np.frombuffer(coder[1](text or "") + np.array([2], "<u4").tobytes(), "<u4")
        n = len(ids)
        cut = n if n <= 1024 else n % 1024 or 1024
        edges = [0, *range(cut, n + 1, 1024)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    have = Counter((None if d != d or d is None else int(d), *x) for d, *x in zip(
        got.doc_id.astype(object).where(got.doc_id.notna(), None), got.piece, got.start, got.length, got.ids_crc32))
    assert have == want
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 1024
    by_best_fit = sum(n for _, n in best_fit(dict(Counter(got.length.tolist())), 1024))
    assert -(-got.length.sum() // 1024) <= got.sequence_id.nunique() <= by_best_fit
    assert pack(docs([]), public_tokenizer()).count() == 0


def test_top_k_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "DATA_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "LEAF", 8)
    r = np.random.default_rng(5)
    x = r.normal(size=(400, 8)) + 3 * r.normal(size=(6, 8))[r.integers(0, 6, 400)]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(400 + i, x[0].tolist(), 1) for i in range(130)]  # one vector many times, all ties
    rows += [(600, None, 1), (601, [1.0, None] * 4, 1), (602, [float("nan")] * 8, 1), (603, [float("inf")] * 8, 1), (None, x[1].tolist(), 1),
             (650, [1.0, 2.0], 1), (655, [2.0, 3.0], 1), (700, [], 1), (10, x[10].tolist(), 1), (750, [3e6] * 8, 1), (751, [3e6] * 8, 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim int").withColumn("cell", F.lit("x"))
    got = {}
    for g in exact_top_k(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(g.query_id, []).append((g.rank, g.vec_id, g.score))
    usable = {i: [int(np.floor(256 * c)) for c in v] for i, v, _ in rows
              if i is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    want = {}
    for q, v in usable.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable.items() if i != q and len(w) == len(v))
            want[q] = [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert {q: sorted(v) for q, v in got.items()} == want
    assert exact_top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_scores_are_exact_over_the_whole_range_of_a_long(spark):
    rows = [(0, [3e9 / 256, 0.0]), (1, [-2e9 / 256, 0.0]), (2, [-3e9 / 256, 1.0]), (3, [-1e10 / 256, 0.0]), (4, [1e10 / 256, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(g.query_id, g["rank"]): (g.vec_id, g.score) for g in exact_top_k(table, F.col("vec_id") == 0).collect()}
    assert got == {(0, 1): (4, (1 << 63) - 1), (0, 2): (1, -6 * 10**18), (0, 3): (2, -9 * 10**18), (0, 4): (3, -(1 << 63))}


def clustered(rows, groups, seed=4):
    """Vectors in tight groups, whose neighbours lie within their group."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(groups, 16))
    return 5 * (x / np.linalg.norm(x, axis=1)[:, None])[r.integers(0, groups, rows)] + 0.05 * r.normal(size=(rows, 16))


def test_blocks_of_clustered_vectors_are_pruned_down_the_tree(spark, monkeypatch):
    monkeypatch.setattr(topk, "DATA_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    x = clustered(1500, 40)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    seen = {}
    searched = topk._searched

    def counted(meetings, queries, data, k):
        seen["scored"] = meetings.count()
        seen["all"] = queries.select("q_block").distinct().count() * data.select("block").distinct().count()
        return searched(meetings, queries, data, k)
    monkeypatch.setattr(topk, "_searched", counted)
    got = {(g.query_id, g["rank"]): (g.vec_id, g.score) for g in exact_top_k(table, F.col("vec_id") % 5 == 0).collect()}
    whole = np.floor(256 * x).astype(np.int64)
    want = {}
    for q in range(0, 1500, 5):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:5]
        want.update({(q, n): (int(i), int(scores[i])) for n, i in enumerate(order, 1)})
    assert got == want
    assert seen["scored"] < 0.5 * seen["all"]


def test_components(spark):
    r = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(40)] + [(900, 900), (None, 3), (4, None)]
    edges += [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(90)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a
    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {g.node: g.component for g in got} == {a: find(a) for a in root}
