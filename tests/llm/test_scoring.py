"""Toxicity and line quality: held-out accuracy, odd rows, and the maths against plain versions."""

import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm.line_quality import OWN, WIDTH, LineQualityModel, fit, forward_backward, line_columns, line_features, quality
from tidelog.llm.textbatch import chunks
from tidelog.llm.toxicity import drop_toxic, nn_pu, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    words = [a + b for a in "ba ke lo mi nu ra so te".split() for b in "dan fer gil hos jum kip".split()]
    rows, labels = [], []
    for i in range(900):
        text = [" ".join(r.choice(words) for _ in range(12)) + "." for _ in range(r.randint(1, 6))]
        toxic, good = int(r.random() < 0.15), int(r.random() < 0.75)
        if not good:
            text = [" ".join(w.upper() + "$$$" for w in line.split()) for line in text]
        if toxic:
            text[r.randrange(len(text))] += f" vile{r.choice(words)} rotter"
        rows.append((i, "\n".join(text), "en", "src0", 1))
        labels.append((i, good, toxic))
    rows += [(None, None, "en", None, None), (None, "vilekedan rotter", "en", None, 0), (5, "", "en", "src0", 0),
             (7, " \n\n ", "en", "src0", 3), rows[0], rows[0], (8, "kedan " * 40_000 + "rotter vilebadan", "en", "s", 1)]
    labels += [(3, None, None), (4, 0, 1), (4, 1, 0), (None, 1, 1), (10_000, 1, 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return documents.withColumn("score", F.lit("x")).withColumn("id", F.lit(1)), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("scored, truth", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(corpus, scored, truth):
    documents, labels = corpus
    out = scored(documents, labels)
    got = out.toPandas()
    assert len(got) == documents.count() and got.score.between(0, 1).all()
    known = got[got.held_out].merge(labels.toPandas().dropna().query("doc_id < 900"), on="doc_id")
    known = known[~known.doc_id.isin([4, 5, 7, 8])]
    assert len(known) > 200 and (known.predicted == known[truth]).mean() > 0.97
    assert not got[got.doc_id.isna()].held_out.any()


def test_clean_rows_stay(corpus):
    documents, labels = corpus
    kept = drop_toxic(documents, labels)
    assert kept.columns == documents.columns
    texts = [x.text or "" for x in kept.collect()]
    assert sum("rotter" in t for t in texts) < 8 and len(texts) > 700 and "" in texts and " \n\n " in texts


@pytest.mark.parametrize("scored", [toxicity, quality])
def test_without_rows_or_labels(corpus, scored):
    documents, labels = corpus
    assert scored(documents.limit(0), labels).count() == 0
    assert {x.predicted for x in scored(documents.limit(5), labels.limit(0)).collect()} <= {0, 1}


def test_the_unlabelled_risk_recovers_the_prior():
    r = np.random.default_rng(1)
    kind = r.random(4000) < 0.2
    seen = np.where(kind, r.random(4000) < 0.9, r.random(4000) < 0.05)
    positive = np.concatenate([np.ones(500), np.zeros(4000)])
    flags = np.concatenate([r.random(500) < 0.9, seen])
    rows = np.flatnonzero(flags)
    w, b = nn_pu(rows, np.zeros(len(rows), np.int64), np.ones(len(rows)), positive, 1, 0.2)
    high, low = 1 / (1 + np.exp(-(w[0] + b))), 1 / (1 + np.exp(-b))
    assert abs(high - 0.18 / 0.22) < 0.12 and low < 0.1


@pytest.mark.parametrize("span", [1, 2, 3, 512])
def test_marginals_are_those_of_all_paths(span):
    r = np.random.default_rng(2)
    counts, moves = np.array([1, 4, 6]), r.normal(size=(2, 2))
    unary = r.normal(size=counts.sum())
    one, move, whole = forward_backward(unary, moves, counts, span)
    at = 0
    for chain, n in enumerate(counts):
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.exp([sum(unary[at + t] * s for t, s in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:])) for p in paths])
        share = weight / weight.sum()
        assert np.allclose(whole[chain], np.log(weight.sum()))
        assert np.allclose(one[at: at + n], [sum(s for s, p in zip(share, paths) if p[t]) for t in range(n)])
        assert np.isclose(move[chain, 0, 1], sum(s * sum((a, b) == (0, 1) for a, b in zip(p, p[1:])) for s, p in zip(share, paths)))
        at += n


def test_columns_add_up_to_the_features():
    r = np.random.default_rng(3)
    model = LineQualityModel(r.normal(size=WIDTH), r.random(WIDTH) + 0.5, r.normal(size=WIDTH), r.normal(size=(2, 2)), 1.0, 0.0)
    for _, raw, at in chunks(pa.array(["One two.\n\nTWO two!!\nx", None, "", "\n", "last | line"])):
        x, _, counts = line_features(raw, at)
        want = forward_backward(((x - model.centre) / model.scale) @ model.weights, model.moves, counts)[0]
        columns, _, counts = line_columns(raw, at)
        assert x.shape[1] == WIDTH == 3 * OWN + 1 and np.allclose(model.lines(columns, counts), want)


def test_documents_of_two_kinds_of_line():
    r = np.random.default_rng(5)
    y = np.arange(400) % 2
    counts = np.full(400, 6)
    kind = np.repeat(y, 6)
    kind[np.repeat(r.random(400) < 0.4, 6) & (np.arange(2400) % 6 >= 4)] ^= 1  # the last lines of some are of the other kind
    x = np.column_stack([kind + r.normal(size=2400) * 0.1, np.ones(2400)])
    lengths = np.full(2400, 20)
    model = fit(x, lengths, counts, y)
    good = forward_backward(((x - model.centre) / model.scale) @ model.weights, model.moves, counts)[0]
    assert ((model.documents(good, lengths, counts) > 0.5) == y).all()
    assert ((good > 0.5) == kind).mean() > 0.98 and (kind == np.repeat(y, 6)).mean() < 0.9


def test_two_million_line_breaks_fit_an_executor():
    model = LineQualityModel(np.zeros(WIDTH), np.ones(WIDTH), np.full(WIDTH, 0.1), np.zeros((2, 2)), 1.0, 0.0)
    tracemalloc.start()
    for _, raw, at in chunks(pa.array(["ab c.\n" * 1_000_000 + "\n" * 1_000_000])):
        columns, length, counts = line_columns(raw, at)
        good = model.lines(columns, counts)
        score = model.documents(good, length, counts)
        assert counts.tolist() == [2_000_001] and 0 <= score[0] <= 1 and np.isfinite(good).all()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000_000


def test_lines_are_those_of_split():
    texts = ["a b\n\nc", "", None, "\n", "Ünder\nx", "end\n"]
    sizes, lengths = [], []
    for _, raw, at in chunks(pa.array(texts)):
        x, length, counts = line_features(raw, at)
        assert np.isfinite(x).all() and len(x) == len(length) == counts.sum()
        sizes += counts.tolist()
        lengths += length.tolist()
    assert sizes == [len((t or "").split("\n")) for t in texts]
    assert lengths == [len(line.encode()) for t in texts for line in (t or "").split("\n")]


@pytest.mark.parametrize("key", [None, 4])
def test_one_id_neither_fills_nor_empties_the_sample(spark, key):
    from tidelog.llm.common import share_of
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(key).cast("long")).otherwise(F.col("id")).alias("key"), F.concat(F.lit("text "), "id").alias("text"))
    for seed in range(3):
        drawn = rows.filter(share_of(30_000, 10_000, F.col("key"), seed, F.col("text")))
        n, hot = drawn.agg(F.count("*"), F.count(F.when(F.col("key").eqNullSafe(key), 1))).first()
        assert abs(n - 10_000) < 500 and abs(hot - 3333) < 300
