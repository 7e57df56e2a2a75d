"""Spelling variants: words one edit apart by search schemes on a bidirectional FM-index, and the form each word goes back to.

A word within one edit shares its first half or its second half unchanged, so a half finds the words that can be near: the vocabulary is
dealt out by halves, each share is one index, and a frequent half is cut into slices that all its queries visit.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
HELD_WORDS = 300_000  # counts that a task holds before it sends them on
INDEX_CHARS = 150_000  # code points of one index, delimiters included
BLOCK = 32  # symbols between two stored counts
QUERIES_AT_ONCE = 4096
END, MARK = 0, 1  # symbols: end of the text, delimiter of words; letters follow


def corpus_words(documents: DataFrame, min_chars: int = 5, min_count: int = 3, slip_every: int | None = 97) -> DataFrame:
    """(word, n) of documents (doc_id, text): the letter runs, A-Z lower-cased, of min_chars code points and min_count occurrences.

    With slip_every, a run loses a code point where slip_every divides the crc32 h of ``<doc_id>:<run>``: the one at h modulo
    the run's length. Runs of a null id lose none; null and empty texts have no runs; each row counts, repeated ones too.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                runs = Counter(LETTERS.findall((text.as_py() or "").encode().lower().decode()))
                start = zlib.crc32(f"{doc_id}:".encode()) if doc_id is not None and slip_every else None
                for run, n in runs.items():
                    if len(run) < min_chars:
                        continue
                    if start is not None:
                        h = zlib.crc32(run.encode(), start)
                        if h % slip_every == 0:
                            cut = h % len(run)
                            run = run[:cut] + run[cut + 1:]
                            if len(run) < min_chars:
                                continue
                    held[run] += n
                if len(held) >= HELD_WORDS:
                    yield sent()
                    held.clear()
        if held:
            yield sent()

    parts = documents.select(F.col("doc_id").cast("string").alias("id"), "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The starts of a text's suffixes in order, by doubling the length that is compared. The last symbol is the least."""
    rank = text.astype(np.int64)
    step, n = 1, len(text)
    while True:
        after = np.zeros(n, np.int64)
        after[:-step or n] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class Ranks:
    """Where an interval of suffixes goes when a symbol is put in front."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = suffix_order(text)
        before = text[self.order - 1]
        blocks = -(-(len(text) + 1) // BLOCK)
        padded = np.full(blocks * BLOCK, 255, np.uint8)
        padded[: len(text)] = before
        self.block = padded.reshape(blocks, BLOCK)
        held = np.zeros((blocks + 1, symbols), np.int32)
        np.add.at(held, (np.arange(len(text)) // BLOCK + 1, before), 1)
        self.count = np.cumsum(held, axis=0, dtype=np.int32)[:blocks]
        self.less = np.zeros((blocks, symbols), np.int32)
        self.less[:, 1:] = np.cumsum(self.count, axis=1)[:, :-1]
        total = np.bincount(text, minlength=symbols)
        self.first = np.cumsum(total) - total
        self.inside = np.arange(BLOCK)[None, :] < np.arange(BLOCK)[:, None]

    def of(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol stands in front of the first at suffixes."""
        k = at // BLOCK
        return self.count[k, symbol] + ((self.block[k] == symbol[:, None]) & self.inside[at % BLOCK]).sum(1)

    def below(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often a lesser symbol does."""
        k = at // BLOCK
        return self.less[k, symbol] + ((self.block[k] < symbol[:, None]) & self.inside[at % BLOCK]).sum(1)

    def every(self, at: np.ndarray) -> np.ndarray:
        """of() for all symbols, a row for each at."""
        k, width = at // BLOCK, self.count.shape[1]
        row, column = np.nonzero(self.inside[at % BLOCK])
        here = np.bincount(row * width + self.block[k[row], column], minlength=len(at) * width)
        return self.count[k] + here.reshape(len(at), width)

    def front(self, symbol: np.ndarray, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.of(symbol, low)
        return self.first[symbol] + start, self.of(symbol, low + size) - start


class TwoWayIndex:
    """Distinct words between delimiters, as suffixes of the text and of its reverse, with intervals kept in step."""

    def __init__(self, words: list[str]):
        points = np.frombuffer(("\0".join(["", *words, ""])).encode("utf-32-le"), "<u4")
        self.letters, codes = np.unique(points, return_inverse=True)
        text = codes.astype(np.int64) + MARK  # the delimiter is the least code point
        symbols = len(self.letters) + MARK + 1  # the last one stands for letters that no word has
        self.size = len(text)
        self.words = words
        self.word_at = np.cumsum(text == MARK) - 1  # at a delimiter: the word that follows
        self.left = Ranks(np.r_[text, END], symbols)
        self.right = Ranks(np.r_[text[::-1], END], symbols)

    def codes(self, word: str) -> np.ndarray:
        points = np.frombuffer(word.encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, len(self.letters)) + MARK

    def near(self, queries: list[str], side: str) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of the words one edit from a query that share its first half (side 'p') or second ('s').

        The half is matched outwards from the word's middle to its delimiter with both intervals; then the other half is
        matched to its delimiter in the other direction, with exactly one edit.
        """
        out = [self._near(queries[at: at + QUERIES_AT_ONCE], side) for at in range(0, len(queries), QUERIES_AT_ONCE)]
        return (np.concatenate([q + k * QUERIES_AT_ONCE for k, (q, _) in enumerate(out)]) if out else np.empty(0, np.int64),
                np.concatenate([w for _, w in out]) if out else np.empty(0, np.int64))

    def _near(self, queries: list[str], side: str) -> tuple[np.ndarray, np.ndarray]:
        ahead, back = (self.left, self.right) if side == "p" else (self.right, self.left)
        halves, rests = [], []
        for word in queries:
            codes, cut = self.codes(word), len(word) // 2
            one, other = (codes[:cut][::-1], codes[cut:]) if side == "p" else (codes[cut:], codes[:cut][::-1])
            halves.append(np.r_[one, MARK])
            rests.append(np.r_[other, MARK])
        m = len(queries)
        size_of = lambda parts: np.array([len(p) for p in parts])
        half, half_n = np.concatenate(halves), size_of(halves)
        rest, rest_n = np.concatenate(rests), size_of(rests)
        half_at, rest_at = np.cumsum(half_n) - half_n, np.cumsum(rest_n) - rest_n
        # The exact half: low is the interval in the direction of the half, other that of the rest, in step.
        low, other, size = np.zeros(m, np.int64), np.zeros(m, np.int64), np.full(m, self.size + 1)
        for t in range(half_n.max()):
            k = np.flatnonzero((half_n > t) & (size > 0))
            symbol = half[half_at[k] + t]
            lesser = ahead.below(symbol, low[k] + size[k]) - ahead.below(symbol, low[k])
            other[k] += lesser
            low[k], size[k] = ahead.front(symbol, low[k], size[k])
        # The rest with an edit at its place t: (query, next place, interval) of every way to make it.
        query, low = np.flatnonzero(size > 0), other[size > 0]
        size = size[size > 0]
        made = []
        t = 0
        while len(query):
            wanted = rest[rest_at[query] + t]
            inner = wanted != MARK  # not yet at the word's end
            start = back.every(low)
            found = back.every(low + size) - start
            found[:, [END, MARK]] = 0
            row, symbol = np.nonzero(found)
            to, n = back.first[symbol] + start[row, symbol], found[row, symbol]
            made.append((query[row], np.full(len(row), t), to, n))  # one code point more
            changed = inner[row] & (symbol != wanted[row])
            made.append((query[row[changed]], np.full(changed.sum(), t + 1), to[changed], n[changed]))
            made.append((query[inner], np.full(inner.sum(), t + 1), low[inner], size[inner]))  # one less
            query, low, size = query[inner], low[inner], size[inner]
            low, size = back.front(wanted[inner], low, size)
            query, low, size = query[size > 0], low[size > 0], size[size > 0]
            t += 1
        if not made:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        query, place, low, size = map(np.concatenate, zip(*made))
        hits = []
        while len(query):  # what is left, without another edit, up to the delimiter
            symbol = rest[rest_at[query] + place]
            low, size = back.front(symbol, low, size)
            done = (size > 0) & (symbol == MARK)
            hits.append((query[done], low[done]))
            going = (size > 0) & (symbol != MARK)
            query, place, low, size = query[going], place[going] + 1, low[going], size[going]
        query, low = (np.concatenate(x) for x in zip(*hits)) if hits else (query, low)
        at = back.order[low]  # words are distinct, so each hit is one suffix
        word = self.word_at[at] if side == "s" else self.word_at[self.size - 1 - at] - 1
        pair = np.unique(query * len(self.words) + word)
        return pair // len(self.words), pair % len(self.words)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways, of the words of vocabulary (word, n) that are one code point apart."""
    length = F.char_length("word")
    chars = vocabulary.agg(F.sum(4 * (length + 1))).first()[0] or 0
    shards = max(1, -(-int(chars) // INDEX_CHARS))

    def key(side: str, size: Column, query: bool) -> Column:
        half = F.left("word", size) if side == "p" else F.right("word", size)
        return F.struct(F.lit(side).alias("side"), half.alias("half"), F.lit(query).alias("query"))
    short, odd = F.floor(length / 2).cast("int"), length % 2
    # A word is looked for by its own halves, and found by those that words of its length and one more or less have.
    keys = F.array(key("p", short, True), key("p", F.when(odd == 1, short + 1).otherwise(short - 1), False),
                   key("s", length - short, True), key("s", F.when(odd == 1, short).otherwise(short + 1), False))
    keyed = vocabulary.select("word", "n", F.explode(keys).alias("k")).select("word", "n", "k.*")
    limit = INDEX_CHARS // 2
    heavy = keyed.groupBy("side", "half").agg(F.sum(length + 1).alias("chars")).filter(F.col("chars") > limit).select(
        "side", "half", F.ceil(F.col("chars") / limit).cast("int").alias("slices"))
    cut = keyed.join(heavy, ["side", "half"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("slices")).cast("int")
    cut = cut.withColumn("own", own).withColumn(
        "slice", F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.col("slices") - 1)).otherwise(F.array("own"))))
    dealt = cut.select(F.pmod(F.xxhash64("side", "half", "slice"), F.lit(shards)).cast("int").alias("shard"), "side", "word", "n", "query",
                       (F.col("slice") == F.col("own")).alias("held"))

    def search(rows: pa.Table) -> pa.Table:
        word, n, side = (np.array(rows.column(c).to_pylist(), dtype=object) for c in ("word", "n", "side"))
        asks, held = (rows.column(c).to_numpy() for c in ("query", "held"))
        count = dict(zip(word[held], n[held]))
        words = sorted(count)
        index = TwoWayIndex(words) if words else None
        texts, sizes = np.array(words, dtype=object), np.array([count[w] for w in words], np.int64)
        found = []
        for one in "ps":
            queries = sorted({w for w in word[asks & (side == one)]})
            if queries and words:
                q, w = index.near(queries, one)
                found.append((np.array(queries, dtype=object)[q], texts[w], sizes[w]))
        columns = zip(*found) if found else ([], [], [])
        a, b, c = (np.concatenate(x) if len(x) else x for x in columns)
        return pa.table({"word": pa.array(a, pa.string()), "near": pa.array(b, pa.string()), "near_n": pa.array(c, pa.int64())})

    return dealt.groupBy("shard").applyInArrow(search, "word string, near string, near_n long").distinct()


def variant_groups(vocabulary: DataFrame, factor: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of vocabulary (word, n): distinct words with their counts.

    n_near counts the words one inserted, deleted or replaced code point away. form is the most frequent of them (ties: the least in
    code-point order) if it has factor times the word's n, else null, with form_n its n. root is where the forms
    from the word end, the word itself without a form. An empty vocabulary gives no rows; further columns are not read.

    An index has about INDEX_CHARS code points, whatever the vocabulary; a half that more words share is cut into slices,
    and its queries go to each. Forms at least double, so following them takes few joins.
    """
    words = staged(vocabulary.select("word", "n"))
    best = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("best.less") >= factor * F.col("n")
    forms = staged(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")))
    ends = staged(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        following = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = staged(ends.join(following, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                  F.col("further").isNotNull().alias("moved")))
        if ends.filter("moved").isEmpty():
            break
        ends = ends.drop("moved")
    return forms.join(ends.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
