"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

Learnt from confirmed toxic documents and from unlabelled ones; nobody has to confirm that a document is clean.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import held_out, share_of, staged, training_labels

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)


def traits(word: str) -> list[str]:
    """A word and its beginnings, so that an unseen ending of a known stem still counts."""
    return [word, *(f"{word[:k]}-" for k in STEMS if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of traits, added up over a text's distinct words."""

    weights: dict[str, float]
    bias: float
    prior: float

    def score(self, texts: pd.Series) -> np.ndarray:
        weights, known = self.weights, {}
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            total = self.bias
            for word in words_of(text):
                gain = known.get(word)
                if gain is None:
                    if len(known) > 300_000:
                        known.clear()
                    gain = known[word] = sum(weights.get(t, 0.0) for t in traits(word))
                total += gain
            out[i] = total
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def nn_pu(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, positive: np.ndarray, width: int, prior: float,
          steps: int = 400, rate: float = 0.05, ridge: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk with logistic loss, by full-batch Adam.

    Risk: prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]). Where the second term is negative, the step
    climbs back out of it instead, as the method has it: that is what keeps the fit from calling all unlabelled
    rows negative. rows, cols and values are the non-zero entries of the design matrix.
    """
    n = len(positive)
    p, u = positive.astype(bool), ~positive.astype(bool)
    n_p, n_u = max(1, p.sum()), max(1, u.sum())
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        f = np.bincount(rows, weights=values * w[cols], minlength=n) + b
        up = 1 / (1 + np.exp(-np.clip(f, -40, 40)))  # derivative of l(-f); that of l(f) is up - 1
        soft = np.logaddexp(0, f)
        negative_part = soft[u].sum() / n_u - prior * soft[p].sum() / n_p
        slope = np.zeros(n)
        slope[u], slope[p] = up[u] / n_u, -prior * up[p] / n_p
        if negative_part >= 0:
            slope[p] += prior * (up[p] - 1) / n_p
        else:
            slope = -slope
        g = np.append(np.bincount(cols, weights=values * slope[rows], minlength=width) + ridge * w, slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train_toxicity(documents: DataFrame, labels: DataFrame, *, prior: float | None = None, max_positive: int = 6000,
                   max_unlabelled: int = 20_000, max_traits: int = 4096, seed: int = 17) -> ToxicityModel:
    """Fit on the documents (doc_id, text) outside the held-out fold.

    Positives: documents labelled toxic. Unlabelled: documents of the fold drawn without regard to any label. prior is
    the toxic share of all text; by default the share among the labelled rows of the fold. The fit uses at most about
    max_positive and max_unlabelled rows, drawn by a hash, and at most max_traits traits, all by their document
    counts in both samples. Without any toxic label, nothing is toxic.
    """
    spark = documents.sparkSession
    known = staged(training_labels(labels, "toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n_toxic:
        return ToxicityModel({}, -10.0, 0.0)
    prior = min(0.5, max(1e-4, n_toxic / n_known)) if prior is None else prior
    pool = documents.select(F.col("doc_id").alias("id"), "text").filter(~held_out(F.col("id")) & F.col("text").isNotNull())
    toxic = known.filter((F.col("y") == 1) & share_of(n_toxic, max_positive, F.col("id"), seed)).select(
        "id", F.lit(True).alias("hit"))
    joined = pool.join(F.broadcast(toxic), "id", "left")  # at most about max_positive ids
    n_pool, n_hit = joined.agg(F.count("*"), F.count("hit")).first()
    # Drawn by id and text, so that many rows of one id, or of none, neither fill the sample nor are left out together.
    hit = F.col("hit") & share_of(n_hit, max_positive, F.col("id"), seed + 2, F.col("text"))
    sample = (
        joined.withColumn("hit", hit)
        .withColumn("drawn", share_of(n_pool, max_unlabelled, F.col("id"), seed + 1, F.col("text")))
        .filter(F.col("hit") | F.col("drawn"))
        .select("text", F.explode(F.expr("filter(array(if(hit, 1, 0), if(drawn, 0, -1)), "
                                         "(x, i) -> if(i = 0, x = 1, x = 0))")).alias("p"))
        .dropDuplicates(["text", "p"]))
    sample = staged(sample)
    n_p, n_u = (sample.filter(F.col("p") == k).count() for k in (1, 0))
    if n_hit and n_pool and not (n_p and n_u):
        raise ValueError(f"the sample has {n_p} toxic and {n_u} other texts of {n_hit} and {n_pool}; draw it larger")
    if not n_p or not n_u:  # no confirmed document has a text
        return ToxicityModel({}, -10.0, prior)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush() -> pd.DataFrame:
            return pd.DataFrame([(k[1], n if k[0] else 0, 0 if k[0] else n) for k, n in counts.items()],
                                columns=["trait", "in_p", "in_u"])
        counts: Counter = Counter()
        for batch in batches:
            for text, p in zip(batch.text, batch.p):
                counts.update((p, t) for t in {t for w in words_of(text) for t in traits(w)})
                if len(counts) > 300_000:
                    yield flush()
                    counts.clear()
        yield flush()

    total = sample.mapInPandas(counted, "trait string, in_p long, in_u long").groupBy("trait").agg(
        F.sum("in_p").alias("a"), F.sum("in_u").alias("b"))
    a, b = F.col("a"), F.col("b")
    e_p, e_u = (a + b) * F.lit(n_p / (n_p + n_u)), (a + b) * F.lit(n_u / (n_p + n_u))
    part = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    g2 = 2 * (part(a, e_p) + part(b, e_u) + part(n_p - a, n_p - e_p) + part(n_u - b, n_u - e_u))
    # In the unlabelled rows a toxic trait still has its share of toxic documents, so ratios end at 1 / prior.
    chosen = total.filter((a >= 3) & (a * n_u >= 2 * b * n_p)).select("trait", g2.alias("g2")).filter("g2 > 15")
    vocabulary = [r.trait for r in chosen.orderBy(F.desc("g2"), "trait").limit(max_traits).collect()]
    at = {t: i for i, t in enumerate(vocabulary)}

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [[at[t] for w in words_of(text) for t in traits(w) if t in at] for text in batch.text]
            yield pd.DataFrame({"p": batch.p, "ids": ids})

    got = sample.mapInPandas(coded, "p int, ids array<int>").toPandas().sort_values(
        "p", key=None, kind="stable", ignore_index=True)
    order = sorted(range(len(got)), key=lambda i: (got.p[i], tuple(sorted(got.ids[i]))))
    entries = [Counter(int(x) for x in got.ids[i]) for i in order]
    positive = np.array([got.p[i] for i in order])
    rows = np.array([i for i, c in enumerate(entries) for _ in c], dtype=np.int64)
    cols = np.array([k for c in entries for k in c], dtype=np.int64)
    values = np.array([min(3, n) for c in entries for n in c.values()], dtype=float)
    w, bias = nn_pu(rows, cols, values, positive, len(vocabulary), prior)
    return ToxicityModel({t: float(x) for t, x in zip(vocabulary, w)}, bias, prior)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """The probability that a text is toxic; for null and empty text that of a text without any known trait."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))
    return scored(text)


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents, all columns kept, that score below the threshold. Repeated rows share one verdict; rows
    with null id or text are scored as they are."""
    model = train_toxicity(documents, labels)
    return documents.filter(toxicity_score(model, F.col("text")) < threshold)


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of each row. Null ids are scored too; an empty table gives no rows."""
    model = train_toxicity(documents, labels)
    out = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                           toxicity_score(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
