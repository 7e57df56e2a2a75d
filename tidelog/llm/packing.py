"""Sequences packed by bin completion: token pieces by length, a search over lengths, and a join that deals them out."""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ranked, staged
from tidelog.llm.pieces import Remembered

BLOCK_ROWS = 50_000
SAFE_BLANK = re.compile(r" (?=\S)(?<=\S )")


def public_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class OddSpace(Exception):
    """Raised for a part that is empty or has white space at an end."""


class TokenBytes:
    """The ids of a text as little-endian 32-bit numbers, as the tokenizer gives them without adding special tokens.

    The byte-level pattern never crosses a blank or a line break between two other characters, so a text is encoded blank by
    blank and line by line, and short parts that come again are remembered. An odd part, with white space at an end, is
    never remembered: its text is noticed then, though known parts are not looked at again, and cut at safe blanks only.
    The same vocabulary in its rank form, if it lies beside the file, encodes faster with the same ids. A text that
    holds the string of an added token goes to the tokenizer itself, which gives that token's id for it.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            self.added = [t["content"] for t in json.load(file).get("added_tokens") or ()]
        ranks = re.sub(r"\.json$", ".tiktoken", path)
        try:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.ids = coder.encode_ordinary
        except (ImportError, FileNotFoundError):
            self.ids = self.whole
        self.line_break = self.encode("\n")
        self.lines, self.parts = Remembered(self.line), Remembered(self.part)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        return packed(self.ids(text))

    def line(self, line: str) -> bytes:
        if not line or line[0].isspace() or line[-1].isspace():
            raise OddSpace
        return self.encode(line)

    def part(self, part: str) -> bytes:
        """Of a blank and a part."""
        if not part or part[0].isspace() or part[-1].isspace():
            raise OddSpace
        first, *rest = part.split("\n")
        if rest:
            try:
                return self.line_break.join([self.parts[first], *[self.lines[x] for x in rest]])
            except OddSpace:
                pass
        return self.encode(" " + part)

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return packed(self.whole(text))
        first, *rest = text.split(" ")
        parts = self.parts
        try:
            return self.lines[first] + b"".join([parts[p] for p in rest])
        except OddSpace:
            first, *rest = SAFE_BLANK.split(text)
            last = [self.encode(" " + p) for p in rest[-1:]]
            return self.encode(first) + b"".join([parts[p] for p in rest[:-1]] + last)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def token_bytes(path: str) -> TokenBytes:
    """One per Python worker, which Spark reuses, so its tables and parts serve all tasks that the worker runs."""
    return TokenBytes(path)


def token_pieces(documents: DataFrame, tokenizer: str, limit: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each row's ids and end_id, cut into pieces of limit ids.

    Only documents of more than limit ids are cut; their first piece takes what is left over.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = token_bytes(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                ids = (encode(text) if text else b"") + end
                n = len(ids) // 4
                cut = n if n <= limit else n % limit or limit
                start = piece = 0
                while start < n:
                    part = ids[4 * start: 4 * cut]
                    rows.append((doc_id, piece, start, cut - start, zlib.crc32(part)))
                    start, cut, piece = cut, cut + limit, piece + 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return documents.select("doc_id", "text").mapInPandas(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


Plan = list[tuple[tuple[int, ...], int]]


def best_fit(held: dict[int, int], limit: int) -> Plan:
    """Best-fit decreasing on lengths and their counts: fillings with how often each is made."""
    bins: list[dict[tuple[int, ...], int]] = [{} for _ in range(limit + 1)]  # by room left
    for length in sorted(held, reverse=True):
        left = held[length]
        room = length
        while left and room <= limit:
            if bins[room]:
                filling, n = next(iter(bins[room].items()))
                k = min(n, left)
                if k == n:
                    del bins[room][filling]
                else:
                    bins[room][filling] = n - k
                more = (*filling, length)
                bins[room - length][more] = bins[room - length].get(more, 0) + k
                left -= k
                room = length if room - length >= length else room
            else:
                room += 1
        while left:
            per = min(limit // length, left)
            k = left // per
            filling = (length,) * per
            bins[limit - length * per][filling] = bins[limit - length * per].get(filling, 0) + k
            left -= k * per
    return [(f, n) for by in bins for f, n in by.items()]


def completions(held: dict[int, int], limit: int, width: int = 24) -> list[tuple[int, ...]]:
    """Undominated fillings of a bin that holds the largest length, fullest first.

    A filling is dropped if it leaves room for one more length, or if one of its parts could be replaced by a longer
    one that still fits: both waste more for the same bin. width bounds how many are looked at per level.
    """
    largest = max(held)
    lengths = sorted((x for x, n in held.items() if n - (x == largest) > 0), reverse=True)
    out: list[tuple[int, ...]] = []
    filling, taken, room, steps = [largest], Counter([largest]), limit - largest, 1
    stack = [[0, 0]]  # of each length in filling: where the next one is looked for, and how many were tried after it
    while stack:
        level = stack[-1]
        k, tried = level
        if not (tried >= width or (len(filling) > 1 and tried >= 3)):
            while k < len(lengths) and not (lengths[k] <= room and held[lengths[k]] > taken[lengths[k]]):
                k += 1
            if k < len(lengths):
                level[:] = k + 1, tried + 1
                if len(out) < 4 * width and steps <= 64 * width:
                    steps += 1
                    filling.append(lengths[k])
                    taken[lengths[k]] += 1
                    room -= lengths[k]
                    stack.append([k, 0])
                continue
        if not tried and not any(x <= room and held[x] > taken[x] for x in lengths):
            out.append(tuple(filling))
        stack.pop()
        last = filling.pop()
        taken[last] -= 1
        room += last
    spare = lambda f: {x for x in lengths if held[x] > f.count(x)}
    keep = []
    for f in sorted(set(out), key=lambda f: (limit - sum(f), len(f), f)):
        room = limit - sum(f)
        if not any(y < x <= y + room for y in f[1:] for x in spare(f)):
            keep.append(f)
    return keep[:width] or sorted(set(out), key=lambda f: limit - sum(f))[:1]


def bin_completion(held: dict[int, int], limit: int, nodes: int = 3000) -> Plan:
    """A plan with as few bins as the search finds: bin completion (Korf) by branch and bound over length counts.

    The first incumbent is best-fit decreasing. Each node fills bins around the largest length left with one
    undominated filling, as often as counts allow. A branch ends when what it has wasted, with the ids still to come, cannot
    beat the incumbent. The search stops at the lower bound or after so many nodes; best fit from each node
    gives further incumbents.
    """
    held = {x: n for x, n in held.items() if n}
    if not held:
        return []
    whole = sum(x * n for x, n in held.items())
    bins = lambda plan: sum(n for _, n in plan)
    over_half = sum(n for x, n in held.items() if 2 * x > limit)
    least = max(-(-whole // limit), over_half)
    best, used, left = best_fit(held, limit), 0, nodes
    path: Plan = []  # what is taken out of held; undone on the way back, so one table of counts is all that is kept

    def undo() -> None:
        nonlocal used
        filling, k = path.pop()
        used -= k
        for x in filling:
            held[x] = held.get(x, 0) + k

    branches = None
    while left and bins(best) > least:
        if branches is None:
            branches = [iter(completions(held, limit))]
        if not branches:
            break
        filling = next(branches[-1], None)
        if filling is None:
            branches.pop()
            if path:
                undo()
            continue
        left -= 1
        need = Counter(filling)
        k = min(held[x] // c for x, c in need.items())
        path.append((filling, k))
        used += k
        for x, c in need.items():
            held[x] -= k * c
            if not held[x]:
                del held[x]
        rest = sum(x * n for x, n in held.items())
        if used + max(-(-rest // limit), sum(n for x, n in held.items() if 2 * x > limit)) >= bins(best):
            undo()
            continue
        if not held or left % 50 == 0 or len(held) <= 8:
            tail = best_fit(held, limit)
            if used + bins(tail) < bins(best):
                best = path + tail
        if held:
            branches.append(iter(completions(held, limit)))
        else:
            undo()
    return best


def dealt(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: the first rank, first sequence and offset of each run of ranks that goes into consecutive sequences."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    at: Counter = Counter()
    sequence = 0
    for filling, n in plan:
        offset = 0
        for length in filling:
            runs.setdefault(length, []).append((at[length], sequence, offset))
            at[length] += n
            offset += length
        sequence += n
    return {x: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for x, r in runs.items()}


def pack(documents: DataFrame, tokenizer: str, limit: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every row (doc_id, text).

    Pieces of one length are alike to the packing, so what is searched is the count of each length, limit numbers
    however many rows there are. Each piece then gets its rank within its length, from blocks of a hash (of the
    staged row too, so equal rows fill no block), and its place from the plan. Null and empty texts are the end id alone; null and repeated ids are packed row by row; an
    empty table gives no rows.
    """
    pieces = staged(token_pieces(documents, tokenizer, limit, end_id).withColumn("tag", F.monotonically_increasing_id()))
    held = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most limit rows
    runs = dealt(bin_completion(held, limit))
    blocks = max(1, sum(held.values()) // BLOCK_ROWS)
    block = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "tag"), F.lit(blocks)).cast("int")
    order = ranked(pieces.withColumn("block", block), ["length"], "block", ["doc_id", "piece", "ids_crc32", "start"], "rank")
    sent = documents.sparkSession.sparkContext.broadcast(runs)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch.length.to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for x in np.unique(length):
                mine = np.flatnonzero(length == x)
                first, base, place = sent.value[int(x)]
                run = np.searchsorted(first, rank[mine], "right") - 1
                sequence[mine], offset[mine] = base[run] + rank[mine] - first[run], place[run]
            yield batch.drop(columns=["rank", "block", "tag"]).assign(sequence_id=sequence, offset=offset).astype({"doc_id": "Int64"})

    return order.mapInPandas(
        placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
