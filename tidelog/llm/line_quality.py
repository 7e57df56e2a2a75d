"""Document quality from its lines: a linear-chain conditional random field, summed up by forward-backward marginals."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import held_out, share_of, staged, training_labels
from tidelog.llm.textbatch import U, chunks, words

# Classes of bytes whose shares describe a line.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_CLASSES = {
    "upper": np.isin(np.arange(256), np.arange(65, 91)),
    "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "blank": np.isin(np.arange(256), [9, 32]),
    "stop": np.isin(np.arange(256), [ord(c) for c in ".,;:'-()\""]),
    "pipe": np.arange(256) == ord("|"),
    "shout": np.arange(256) == ord("!"),
    "angle": np.isin(np.arange(256), [ord(c) for c in "<>{}[]\\/=_"]),
    "symbol": np.isin(np.arange(256), [ord(c) for c in "#$%&*@^~+`?"]),
}
OWN = len(_CLASSES) + 11
WIDTH = 3 * OWN + 1
SPAN = 512


def line_columns(raw: np.ndarray, at: np.ndarray) -> tuple[Iterator[np.ndarray], np.ndarray, np.ndarray]:
    """(own features, column by column, lengths in bytes, lines of each row) of the lines of a chunk of rows, in order."""
    size, rows = len(raw), len(at) - 1
    ends = np.flatnonzero(raw == 10)
    breaks = np.bincount(np.searchsorted(at, ends, "right") - 1, minlength=rows) if len(ends) else np.zeros(rows, int)
    per_row = breaks + 1  # an empty row is one empty line
    row = np.repeat(np.arange(rows), per_row)
    begin = np.empty(len(row), np.int64)
    first = np.cumsum(per_row) - per_row
    begin[first] = at[:-1]
    inner = np.ones(len(row), bool)
    inner[first] = False
    begin[inner] = ends + 1
    stop = np.empty(len(row), np.int64)
    last = first + per_row - 1
    stop[last] = at[1:]
    inner[:] = True
    inner[last] = False
    stop[inner] = ends
    length = stop - begin

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(size + 1, np.int32)
        np.cumsum(flags, out=total[1:])
        return (total[stop] - total[begin]).astype(float)

    # Words: how many, how many differ within the line, and how many were in the row before.
    h, _ = words(raw, at)
    if size:
        solid = ~np.isin(raw, [32, 9, 10, 11, 12, 13])
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        cut = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < size)]
        begins[cut] = solid[cut]
        where = np.flatnonzero(begins)
    else:
        where = np.empty(0, np.int64)
    line_of = np.searchsorted(begin, where, "right") - 1
    # Empty lines share their start with the next one; a word belongs to the last line that starts at or before it.
    total = np.bincount(line_of, minlength=len(row)).astype(float)
    fresh = _first_of(h, line_of)
    new = _first_of(h, row[line_of]) if len(h) else np.empty(0, bool)
    in_line = np.bincount(line_of, weights=fresh, minlength=len(row))
    in_row = np.bincount(line_of, weights=new, minlength=len(row))
    w = np.maximum(total, 1)
    # A line that its row has had already.
    sums = np.zeros(len(h) + 1, U)
    np.cumsum(h, out=sums[1:])
    edge = np.searchsorted(line_of, np.arange(len(row) + 1))
    again = ~_first_of(sums[edge[1:]] - sums[edge[:-1]], row)
    n = np.maximum(length, 1)

    def columns() -> Iterator[np.ndarray]:
        def share(flags: np.ndarray) -> np.ndarray:
            return count(flags) / n if size else np.zeros(len(row))

        letters = share(_LETTER[raw])
        upper = share(_CLASSES["upper"][raw])
        yield np.log1p(length) / 8
        yield letters
        for kind in _CLASSES.values():
            yield share(kind[raw])
        yield upper * n / np.maximum(letters * n, 1)
        twice = np.zeros(size, bool)
        if size > 1:
            odd = ~_LETTER[raw] & ~_CLASSES["blank"][raw] & (raw != 10)
            twice[1:] = odd[1:] & (raw[1:] == raw[:-1])
        yield share(twice)
        yield np.log1p(total) / 6
        yield np.minimum(length / w, 30) / 10
        yield in_line / w
        yield in_row / w
        yield again & (total > 0)
        yield (length > 0) & np.isin(raw[np.maximum(stop - 1, 0)] if size else np.zeros(len(row), np.uint8), [46, 33, 63])
        yield length == 0

    return columns(), length, per_row


def neighbours(per_row: np.ndarray) -> np.ndarray:
    """True for each line but the last of a chunk if the next one belongs to the same row."""
    row = np.repeat(np.arange(len(per_row)), per_row)
    return row[1:] == row[:-1]


def line_features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths in bytes, lines of each row) of the lines of a chunk of rows, in order.

    A line's features are its own, those of the line before and those of the line after (zeros at a row's ends).
    """
    columns, length, per_row = line_columns(raw, at)
    own = np.column_stack(list(columns)).astype(float)
    before, after = np.zeros_like(own), np.zeros_like(own)
    follows = neighbours(per_row)
    before[1:][follows] = own[:-1][follows]
    after[:-1][follows] = own[1:][follows]
    return np.column_stack([own, before, after, np.ones(len(own))]), length, per_row


def _first_of(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """True where a value comes for the first time in its group."""
    order = np.lexsort((np.arange(len(value)), value, group))
    new = np.ones(len(value), bool)
    new[1:] = (value[order][1:] != value[order][:-1]) | (group[order][1:] != group[order][:-1])
    out = np.empty(len(value), bool)
    out[order] = new
    return out


def _forward(unary: np.ndarray, moves: np.ndarray, start: np.ndarray, alive: np.ndarray, alpha: np.ndarray,
             into: np.ndarray) -> np.ndarray:
    """alpha, filled chain by chain from the log weights that each chain's first position gets from what lies before it."""
    for t, k in enumerate(alive):
        at = start[:k] + t
        if t:
            back = alpha[at - 1]
            alpha[at, 0] = np.logaddexp(back[:, 0] + moves[0, 0], back[:, 1] + moves[1, 0])
            alpha[at, 1] = np.logaddexp(back[:, 0] + moves[0, 1], back[:, 1] + moves[1, 1])
        else:
            alpha[at] = into
        alpha[at, 1] += unary[at]
    return alpha


def forward_backward(unary: np.ndarray, moves: np.ndarray, counts: np.ndarray,
                     span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains of two states: (probability of state 1 by position, of each move by chain, log partition by chain).

    unary is the log weight of state 1 against state 0 by position, moves the 2 x 2 log weights, counts the chain
    lengths (at least 1), in whose order the positions lie. Chains are walked in pieces of at most span positions: all
    pieces step together to find how each carries a message from its first state to its end, the messages are
    carried from piece to piece, and all pieces step together again. So a chain of n positions costs about
    2 * span + 2 * n / span steps, not n.
    """
    m, n = len(counts), len(unary)
    chain = np.repeat(np.arange(m), counts)
    cuts = -(-counts // span)
    of = np.repeat(np.arange(m), cuts)  # the chain of each piece
    nth = np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = (np.cumsum(counts) - counts)[of] + nth * span
    held = np.minimum(counts[of] - nth * span, span)
    order = np.argsort(-held, kind="stable")
    start, size = begin[order], held[order]
    alive = np.searchsorted(-size, -np.arange(size[0] if m else 0), "left")  # pieces longer than t
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    into, out = np.zeros((len(of), 2)), np.zeros((len(of), 2))
    if len(of) > m:
        carried = np.empty((len(of), 2, 2))  # log weight from each state at a piece's first position to each at its last
        for a in (0, 1):
            from_one = np.tile([0.0, -np.inf] if a == 0 else [-np.inf, 0.0], (len(of), 1))
            _forward(unary, moves, start, alive, alpha, from_one)
            carried[:, a] = alpha[begin + held - 1]
        first = np.cumsum(cuts) - cuts
        for k in range(1, cuts.max()):
            at = first[cuts > k] + k
            end = np.logaddexp.reduce(into[at - 1][:, :, None] + carried[at - 1], axis=1)
            into[at] = np.logaddexp.reduce(end[:, :, None] + moves, axis=1)
        for k in range(cuts.max() - 2, -1, -1):
            at = first[cuts > k + 1] + k
            ahead = np.logaddexp.reduce(carried[at + 1] + out[at + 1][:, None, :], axis=2)
            out[at] = np.logaddexp.reduce(moves + ahead[:, None, :], axis=2)
    beta[begin + held - 1] = out
    _forward(unary, moves, start, alive, alpha, into[order])
    for t in range(len(alive) - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        ahead = beta[at + 1].copy()
        ahead[:, 1] += unary[at + 1]
        beta[at, 0] = np.logaddexp(moves[0, 0] + ahead[:, 0], moves[0, 1] + ahead[:, 1])
        beta[at, 1] = np.logaddexp(moves[1, 0] + ahead[:, 0], moves[1, 1] + ahead[:, 1])
    end = np.cumsum(counts) - 1
    whole = np.logaddexp(alpha[end, 0], alpha[end, 1])
    one = 1 / (1 + np.exp(np.clip(alpha[:, 0] + beta[:, 0] - alpha[:, 1] - beta[:, 1], -500, 500)))
    move = np.zeros((m, 2, 2))
    inner = np.flatnonzero(chain[1:] == chain[:-1]) if n else np.empty(0, np.int64)
    for a in (0, 1):
        for b in (0, 1):
            weight = alpha[inner, a] + moves[a, b] + beta[inner + 1, b] + b * unary[inner + 1] - whole[chain[inner]]
            move[:, a, b] = np.bincount(chain[inner], weights=np.exp(np.minimum(weight, 0)), minlength=m)
    return one, move, whole


@dataclass(frozen=True)
class LineQualityModel:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    shift: float

    def lines(self, columns: Iterator[np.ndarray], counts: np.ndarray) -> np.ndarray:
        """The probability that each line is good. Columns are added up as they come, so no table of features is held."""
        w = self.weights / self.scale
        unary = np.full(int(counts.sum()), w[-1] - self.centre @ w)
        follows = neighbours(counts)
        for k, own in enumerate(columns):
            unary += own * w[k]
            unary[1:] += follows * own[:-1] * w[OWN + k]
            unary[:-1] += follows * own[1:] * w[2 * OWN + k]
        return forward_backward(unary, self.moves, counts)[0]

    def documents(self, good: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _evidence(good, lengths, counts) + self.shift)))


def _evidence(good: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log odds of the length-weighted mean of the lines' marginals; a text without a letter weighs its lines alike."""
    row = np.repeat(np.arange(len(counts)), counts)
    weight = lengths + 1e-6
    mean = np.bincount(row, weights=good * weight, minlength=len(counts)) / np.bincount(row, weights=weight, minlength=len(counts))
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit(features: np.ndarray, lengths: np.ndarray, counts: np.ndarray, y: np.ndarray, steps: int = 500,
        rate: float = 0.05, ridge: float = 1e-3, strength: float = 0.25) -> LineQualityModel:
    """Maximum likelihood with hidden line labels, both classes weighing the same; then the two numbers that turn a
    document's evidence into a probability, from the same rows unweighted.

    For the first fifth of the steps every line is labelled as its document. From then on a document's label is only
    evidence about its lines: log odds of strength a line on average, dealt out by length. What lines and moves are
    expected to be, given that evidence, is renewed every ten steps (generalised EM). For the last two fifths moves are learnt
    too; earlier they would be those within documents of one label, and no line could turn against its neighbours.
    """
    centre, scale = features.mean(axis=0), features.std(axis=0)
    centre[-1], scale[scale < 1e-9] = 0.0, 1.0
    x = (features - centre) / scale
    row = np.repeat(np.arange(len(counts)), counts)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    # A long document counts as one: its likelihood is divided by its lines.
    per = share / counts
    w, moves = np.zeros(x.shape[1]), np.zeros((2, 2))
    mean, square = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    weight = lengths + 1.0
    told = strength * (2 * y - 1)[row] * weight * (counts / np.bincount(row, weights=weight))[row]
    wanted = y[row].astype(float)
    for step in range(1, steps + 1):
        if 5 * step > steps and step % 10 == 1:
            wanted, seen, _ = forward_backward(x @ w + told, moves, counts)
        good, move, _ = forward_backward(x @ w, moves, counts)
        if 5 * step <= 3 * steps:
            seen = move
        g = np.concatenate([x.T @ ((good - wanted) * per[row]) + ridge * w,
                            ((move - seen) * per[:, None, None]).sum(axis=0).ravel() + ridge * moves.ravel()])
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        change = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, moves = w - change[:-4], moves - change[-4:].reshape(2, 2)
    e = _evidence(forward_backward(x @ w, moves, counts)[0], lengths, counts)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's steps for the two
        p = 1 / (1 + np.exp(-(slope * e + shift)))
        v = p * (1 - p) + 1e-9
        grad = np.array([((p - y) * e).sum() + 0.1 * (slope - 1), (p - y).sum()])
        hess = np.array([[(v * e * e).sum() + 0.1, (v * e).sum()], [(v * e).sum(), v.sum()]])
        change = np.clip(np.linalg.solve(hess + 1e-6 * np.eye(2), grad), -1, 1)
        slope, shift = slope - change[0], shift - change[1]
    return LineQualityModel(centre, scale, w, moves, float(slope), float(shift))


def train_quality(documents: DataFrame, labels: DataFrame, *, max_documents: int = 4000, max_lines: int = 200,
                  seed: int = 23) -> LineQualityModel | float:
    """Fit on labelled documents (doc_id, text) outside the held-out fold: at most about max_documents, drawn by a hash,
    of at most max_lines lines. Without documents of both kinds there is no model but the share of good ones."""
    known = staged(training_labels(labels, "quality"))
    n = known.count()
    drawn = known.filter(share_of(n, max_documents, F.col("id"), seed))
    sample = (
        documents.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(drawn), "id")
        .filter(F.col("text").isNotNull() & (F.size(F.split("text", "\n")) <= max_lines)).select("id", "y", "text"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, at in chunks(batch.column(2)):
                x, length, counts = line_features(raw, at)
                edge = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                m = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, m), batch.column(1).slice(first, m),
                     pa.ListArray.from_arrays(pa.array(edge * WIDTH), pa.array(x.ravel().astype(np.float32))),
                     pa.ListArray.from_arrays(pa.array(edge), pa.array(length))], ["id", "y", "x", "length"])

    got = sample.mapInArrow(described, "id long, y int, x array<float>, length array<long>").toPandas()
    if got.empty or got.y.nunique() < 2:
        return float(got.y.mean()) if len(got) else 0.5
    got = got.assign(n=[len(v) for v in got.length], total=[float(np.sum(v)) for v in got.x])
    got = got.sort_values(["id", "n", "total"], kind="stable")
    return fit(np.concatenate(got.x.tolist()).reshape(-1, WIDTH).astype(float), np.concatenate(got.length.tolist()),
               got.n.to_numpy(), got.y.to_numpy())


def quality(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines and n_good_lines of each row (doc_id, text).

    Null and empty texts count as one empty line. Null and repeated ids are scored row by row, equal texts alike; an empty
    table gives no rows; more columns play no part. Texts of any number of lines are scored whole: a line costs some
    hundreds of bytes while its text is scored, and long chains are walked in pieces.
    """
    model = train_quality(documents, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, at in chunks(batch.column(1)):
                columns, length, counts = line_columns(raw, at)
                if isinstance(model, float):
                    score, good = np.full(len(counts), model), np.full(len(length), model)
                else:
                    good = model.lines(columns, counts)
                    score = model.documents(good, length, counts)
                row = np.repeat(np.arange(len(counts)), counts)
                n_good = np.bincount(row, weights=good >= 0.5, minlength=len(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(counts)), pa.array(score), pa.array(counts.astype(np.int64)),
                     pa.array(n_good)], ["doc_id", "score", "n_lines", "n_good_lines"])

    out = documents.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double, n_lines long, n_good_lines long")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_lines", "n_good_lines")
