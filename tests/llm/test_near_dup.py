import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import near_dup
from tidelog.llm.near_dup import drop_near_duplicates, near_duplicates, near_groups, signatures
from tidelog.llm.textbatch import chunks, shingles


def word_shingles(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i: i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, word_shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in sets:
        for j, b in sets:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted([(i, len(s), None if i is None else find(i)) for i, s in sets], key=str)


def corpus(seed):
    """Chains of edits, copies, a common passage, short texts, ties, nulls and repeated rows."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    rows = []
    for _ in range(12):
        words = text(r.randint(60, 200))
        for _ in range(r.randint(1, 8)):
            words = list(words)
            for _ in range(r.randint(0, 2)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            rows.append(" ".join(words))
    passage = text(70)
    rows += [" ".join(passage + text(r.randint(1, 20))) for _ in range(60)]
    rows += ["", " \n\t", None, "One", "one", "one two", "a b c d", "a b c d e", "A  B\nC d E", "é É", "x y z"]
    ids = list(range(5, 5 + len(rows)))
    r.shuffle(ids)
    out = list(zip(ids, rows))
    return out + [out[0], (None, out[1][1]), (None, None), (out[2][0], out[9][1])]


def test_components_are_those_of_all_pairs(spark, docs):
    for seed in (4,):
        rows = corpus(seed)
        got = near_duplicates(docs(rows).withColumn("kept", F.lit(1)).withColumn("component", F.lit("x"))).collect()
        assert sorted([(g.doc_id, g.n_shingles, g.component_id) for g in got], key=str) == brute(rows)
        assert all(g.kept == (g.doc_id is None or g.doc_id == g.component_id) for g in got)


def test_one_row_of_each_group_stays(spark, docs):
    rows = corpus(3)
    kept = drop_near_duplicates(docs(rows))
    assert kept.columns == docs(rows).columns
    group = {k: c for k, _, c in brute([(k, row[1]) for k, row in enumerate(rows)])}  # by row, whatever the ids
    best, blank = {}, 0
    for k, (i, text, *_) in enumerate(rows):
        if not word_shingles(text):
            blank += 1
        elif group[k] not in best or (i is None, i or 0, text) < best[group[k]]:
            best[group[k]] = (i is None, i or 0, text)
    got = [(x.doc_id is None, x.doc_id or 0, x.text) for x in kept.collect()]
    assert sorted(x for x in got if word_shingles(x[2])) == sorted(best.values()) and len(got) == len(best) + blank


def test_unrelated_texts_of_one_id_and_copies_without_an_id(docs):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    got = sorted(((x.doc_id, x.text) for x in drop_near_duplicates(docs([(1, a), (5, a), (5, b), (None, c), (None, c), (None, c)])).collect()), key=str)
    assert got == sorted([(1, a), (5, b), (None, c)], key=str)


def test_rows_of_one_id_are_not_lost_to_unrelated_ones(docs):
    r = random.Random(8)
    text = lambda: " ".join(f"w{r.randrange(400)}" for _ in range(80))
    one, two, three, four = (text() for _ in range(4))
    rows = [(7, one), (7, two), (7, two + " end"), (7, None), (7, " \n"), (8, two), (9, three), (10, three), (10, ""), (11, four)]
    got = sorted(((x.doc_id, x.text) for x in drop_near_duplicates(docs(rows)).collect()), key=str)
    assert got == sorted([(7, one), (7, two), (7, None), (7, " \n"), (9, three), (10, ""), (11, four)], key=str)
    hot = [(5, text()) for _ in range(60)]
    assert sorted(x.text for x in drop_near_duplicates(docs(hot + hot[:5])).collect()) == sorted(t for _, t in hot)


def test_texts_are_numbered_without_a_shuffle(docs, monkeypatch):
    plans = []

    def groups(documents, percent):
        plans.append(documents._jdf.queryExecution().executedPlan().toString())
        return near_groups(documents, percent)
    monkeypatch.setattr(near_dup, "near_groups", groups)
    assert drop_near_duplicates(docs([(1, "a b"), (1, "a b"), (2, "a b"), (3, "c")])).count() == 2
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Join" not in plans[0]


def test_empty_table(spark, docs):
    assert near_duplicates(docs([])).count() == 0 and drop_near_duplicates(docs([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t x ", max_size=40)), max_size=12))
def test_hashed_shingles_count_like_the_words(texts):
    sizes = []
    for _, raw, at in chunks(pa.array(texts, pa.string())):
        _, row = shingles(raw, at)
        sizes += np.bincount(row, minlength=len(at) - 1).tolist()
    assert sizes == [len(word_shingles(t)) for t in texts]


def test_similar_sets_agree_in_as_many_places():
    r = np.random.default_rng(3)
    for n in (20, 100, 2000):
        both = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        a, b = both[: int(n * 0.95)], both[int(n * 0.05):]
        s, row = np.concatenate([np.sort(a), np.sort(b)]), np.repeat([0, 1], [len(a), len(b)])
        _, table = signatures(s, row, 2, 252)
        assert abs((table[0] == table[1]).mean() - len(np.intersect1d(a, b)) / len(both)) < 0.15
