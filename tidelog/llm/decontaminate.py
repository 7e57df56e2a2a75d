"""Benchmark decontamination by pigeonhole edit matching: exact pieces find places, bit-parallel distance judges them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged

GROUP_CHARS = 4_000_000
SPACE = re.compile(r"\s+")
WORD = re.compile(r"\w\w")


def plain(text: str | None) -> str:
    """Lower case, with each run of white space as one blank and none at the ends."""
    return SPACE.sub(" ", text.lower()).strip() if text else ""


def budget_of(item: str, error_rate: float) -> int:
    return int(len(item) * error_rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(start, piece): errors + 1 parts of nearly equal length. If errors edits change the item, one part survives."""
    n = errors + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(cuts[k], item[cuts[k]: cuts[k + 1]]) for k in range(n)]


def best_end(item: str, text: str) -> tuple[int, int]:
    """(least edits, smallest end) over all substrings of text, by Myers' bit-parallel columns (1999)."""
    size = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best, end = full, 0, size, size, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = eq | down
        zero = (((x & up) + up) ^ up) | x
        rise, fall = down | (full & ~(zero | up)), up & zero
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        if score < best:
            best, end = score, j
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(zero | rise)), rise & zero
    return best, end


def bounded(text: str, begin: int, end: int) -> bool:
    """True if text[begin:end] neither begins nor ends within a word."""
    return not (begin and WORD.match(text[begin - 1: begin + 1]) or WORD.match(text[end - 1: end + 1]))


class Matcher:
    """The pieces of some items in one automaton.

    Items of fewer than min_chars characters have no error budget, and they are found at word bounds only: what stands before
    and after the place is no letter, digit or underscore, or the item itself has none at that end.
    """

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int = 0):
        self.items = [(i, t, budget_of(t, error_rate) if len(t) >= min_chars else -1) for i, t in items]
        self.automaton = ahocorasick.Automaton()
        for k, (_, item, errors) in enumerate(self.items):
            for start, piece in pieces(item, max(errors, 0)):
                known = self.automaton.get(piece, None)
                if known is None:
                    self.automaton.add_word(piece, [(k, start, len(piece))])
                else:
                    known.append((k, start, len(piece)))
        if self.items:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, least edits, end of the first best place in the plain text) of each item within its budget."""
        if not self.items or not text:
            return []
        spans: dict[int, list[tuple[int, int]]] = {}
        short: dict[int, int] = {}
        for last, hits in self.automaton.iter(text):
            for k, start, length in hits:
                _, item, errors = self.items[k]
                begin = last + 1 - length - start
                if errors < 0:
                    if k not in short and bounded(text, begin, last + 1):
                        short[k] = last + 1
                    continue
                low, high = max(0, begin - errors), begin + len(item) + errors
                own = spans.setdefault(k, [])
                if own and low <= own[-1][1] and own[-1][0] <= low:
                    own[-1] = own[-1][0], max(high, own[-1][1])
                else:
                    own.append((low, high))
        found = [(self.items[k][0], 0, end) for k, end in short.items()]
        for k, own in spans.items():
            key, item, errors = self.items[k]
            best = None
            for low, high in own:
                window = text[low:high]
                at = window.find(item)
                edits, end = (0, at + len(item)) if at >= 0 else best_end(item, window)
                if edits <= errors and (best is None or (edits, low + end) < best):
                    best = edits, low + end
            if best:
                found.append((key, *best))
        return found


def contaminated(documents: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, min_chars: int = 40) -> DataFrame:
    """(doc_id, item_id, edits, end) of each row (doc_id, text) and item (item_id, text) found in it.

    An item is found where some substring of the document is within int(error_rate * item length) edits of it, both in
    plain form. Whole texts are searched. Items of fewer than min_chars plain characters would match by chance within their
    budget; they have to be there exactly, at word bounds. Null and blank items are not searched. The items go out in groups of at most GROUP_CHARS characters (a longer one
    alone), each a pass over the documents, so no task holds more, however large the benchmark is. Null texts match
    nothing; rows with null or repeated ids are searched like others; items of equal text are all reported. More
    columns on either side play no part, whatever their names.
    """
    spark = documents.sparkSession
    sizes = benchmark.select(F.xxhash64("item_id", "text").alias("h"), F.length("text").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = max(1, -(-total * 2 // GROUP_CHARS))
    text = documents.select("doc_id", "text").filter("text is not null")
    kind = "doc_id long, item_id long, edits int, end long"
    out = None
    for g in range(groups):
        part = benchmark.select("item_id", "text").filter(
            F.col("text").isNotNull() & (F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g))
        items = sorted({(r.item_id, plain(r.text)) for r in part.toLocalIterator()}, key=str)
        items = [(i, t) for i, t in items if t]
        if not items:
            continue
        sent = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            matcher = Matcher(sent.value, error_rate, min_chars)
            for batch in batches:
                rows = [(i, *f) for i, t in zip(batch.doc_id, batch.text) for f in matcher.find(plain(t))]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "edits", "end"]).astype(
                    {"doc_id": "Int64", "item_id": "Int64"})

        found = text.mapInPandas(search, kind)
        out = found if out is None else out.union(found)
    return spark.createDataFrame([], kind) if out is None else out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, error_rate: float = 0.05) -> DataFrame:
    """documents, all columns kept, without the rows that hold an item. Rows are told by id and text, so null and
    repeated ids lose only the rows that match."""
    keyed = documents.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("doc_id"), F.col("text"))
    hit = staged(contaminated(keyed.select("doc_id", "text"), benchmark, error_rate).select(F.col("doc_id").alias("hit")).distinct())
    return keyed.join(hit, F.col("doc_id") == F.col("hit"), "left_anti").select("doc.*")
