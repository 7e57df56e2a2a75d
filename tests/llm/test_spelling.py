"""Near words, forms and roots against plain edit distance."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import spelling
from tidelog.llm.spelling import TwoWayIndex, corpus_words, near_pairs, suffix_order, variant_groups


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)):] == b[k + 1:]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=40))
def test_suffix_order(codes):
    text = np.array([*codes, 0])
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=25, unique=True))
def test_two_way_index_finds_every_near_word(words):
    words = sorted(words)
    index, found = TwoWayIndex(words), set()
    for side in "ps":
        q, w = index.near(words, side)
        pairs = list(zip(q.tolist(), w.tolist()))
        assert len(set(pairs)) == len(pairs)
        for a, b in pairs:
            half = len(words[a]) // 2
            assert words[b].startswith(words[a][:half]) if side == "p" else words[b].endswith(words[a][half:])
        found |= set(pairs)
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}


def expected(counts):
    words = sorted(counts)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("chars", [150_000, 900])
def test_groups_against_plain_distance(spark, monkeypatch, chars):
    monkeypatch.setattr(spelling, "INDEX_CHARS", chars)
    r = random.Random(3)
    stems = ["".join(r.choice("abcdeé") for _ in range(r.randrange(5, 10))) for _ in range(40)] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab"]
    words = set(stems)
    while len(words) < 200:
        w = r.choice(sorted(words))
        k = r.randrange(len(w))
        words.add(r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("abcdeéz") + w[k:], w[:k] + r.choice("abcdeéz") + w[k + 1:]]) or "aaaaa")
    words |= {"shared" + "".join(r.choice("xy") for _ in range(6)) for _ in range(30)} | {"q" * 300, "q" * 299}
    counts = {w: r.choice([3, 4, 6, 12, 24, 50]) for w in words}
    table = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, side int")
    got = sorted(map(tuple, variant_groups(table).collect()))
    assert got == expected(counts)
    assert variant_groups(table.limit(0)).count() == 0


def test_words_of_documents(docs):
    rows = [(i, "Straße über ÜBER Naïve2words x " * 3 + f"word{i} Alphabet alphabet ALPHABET") for i in range(60)]
    rows += [(None, "nullid nullid nullid"), (70, None), (71, ""), (5, "twice twice"), (5, "twice twice"), (72, "z" * 90_000 + " ") ]
    counts = Counter()
    import re
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if i is not None:
                h = zlib.crc32(f"{i}:{run}".encode())
                if h % 97 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    table = docs(rows).withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("id", F.lit(3))
    assert {x.word: x.n for x in corpus_words(table).collect()} == want
    assert corpus_words(docs([])).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not mounted")
def test_pairs_are_symmetric_and_distinct(spark):
    vocabulary = corpus_words(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    pairs = [tuple(x) for x in near_pairs(vocabulary).select("word", "near").collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(b, a) for a, b in pairs}
