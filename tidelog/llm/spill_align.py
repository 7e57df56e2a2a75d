"""Two tokenizers aligned over a corpus: links between their tokens, and each document's share in corpus-wide link counts.

Counts of token pairs are gathered as an external merge would: a task sorts the pair-document records it gathers, cuts them by
a radix of the second tokenizer's id and writes each cut as a zstd run. Runs lie in a table in the shared folder, not on
a machine. A heap merges the runs of a radix, a bounded number at a time, and counts each pair; as pairs come
ordered by the second side's id, that id's highest count is known when its pairs are through. What a pair was
counted goes back to each run that asked, in the run's own order, and there adds up by document.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged
from tidelog.llm.packing import public_tokenizer
from tidelog.llm.pieces import SPACE, Remembered, coder_of, public_pieces

BUCKETS = 64  # radixes of the second side's id
RUN_RECORDS = 1 << 17  # pair-document records of a run
RUN_DOCUMENTS = 1 << 13
RUN_GROUPS = 1 << 26  # bytes of group texts after which a run ends
FAN_IN = 64  # runs that one heap merges
SEGMENT = 1 << 17  # words of a text whose links are held before they are counted
BLOCK = 4096
SHIFT = 20  # a pair is the second side's id, then the first's in so many bits
MASK = (1 << 48) - 1
COUNTED = np.dtype([("pair", "<u8"), ("n", "<u8")])
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_aligners: dict[tuple[str, str], Aligner] = {}

__all__ = ["align", "public_tokenizer", "public_pieces"]


def aligner_of(first: str, second: str) -> Aligner:
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(first, second)
    return _aligners[first, second]


class Aligner:
    """Groups and links of a word (with the blank before it) between byte-level and SentencePiece tokens.

    A single blank between two other characters begins a token on both sides, so a text is aligned word by word and words
    that recur are looked up.
    """

    def __init__(self, first: str, second: str):
        try:
            import public_tokenizers
            import tiktoken
            with open(re.sub(r"\.json$", ".tiktoken", first), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.first_ids = coder.encode_ordinary
            self.first_bytes = {i: b for b, i in ranks.items()}
        except (ImportError, FileNotFoundError):
            from tokenizers import Tokenizer
            coder = Tokenizer.from_file(first)
            coder.encode_special_tokens = True
            self.first_ids = lambda text: coder.encode(text, add_special_tokens=False).ids
            letters = byte_letters()
            self.first_bytes = {i: bytes(letters[c] for c in token) for token, i in coder.get_vocab(False).items()}
        self.first_bytes = [self.first_bytes.get(i, b"") for i in range(max(self.first_bytes) + 1)]
        self.second = coder_of(second)
        self.first_said, self.second_said = ([str(i) for i in range(len(side))] for side in (self.first_bytes, self.second.bytes))
        self.known = Remembered(lambda word: None if not word or word[0].isspace() or word[-1].isspace() else self.aligned(word))

    def aligned(self, word: str) -> tuple[bytes, bytes, int]:
        """Pairs as little-endian 64-bit numbers, groups as text, and the numbers of first tokens, second tokens and groups.

        The numbers share an int, 48 bits each. No groups at all where a side's bytes are not those of the word.
        """
        raw = (" " + word).encode()
        first = self.first_ids(" " + word)
        if " " in word or SPACE in word:
            second = np.frombuffer(self.second.encode(word), "<u4").tolist()
        else:
            second = self.second.part_ids(SPACE + word)
        a_bytes, b_bytes = [self.first_bytes[a] for a in first], [self.second.bytes[b] for b in second]
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return b"", b"", 0
        a_said, b_said = [self.first_said[a] for a in first], [self.second_said[b] for b in second]
        if len(second) == 1:  # one group, whatever the first side has
            pairs, groups, n_groups = [second[0] << SHIFT | a for a in first], f"{','.join(a_said)}|{b_said[0]}", 1
        elif len(first) == 1:
            pairs, groups, n_groups = [b << SHIFT | first[0] for b in second], f"{a_said[0]}|{','.join(b_said)}", 1
        else:
            pairs, cuts = [], []
            i = j = a_from = b_from = 0
            a, b, ahead = first[0], second[0] << SHIFT, len(a_bytes[0]) - len(b_bytes[0])
            while True:
                pairs.append(b | a)
                if ahead == 0:
                    i, j = i + 1, j + 1
                    cuts.append(f"{','.join(a_said[a_from:i])}|{','.join(b_said[b_from:j])}")
                    if i == len(first):
                        break
                    a_from, b_from = i, j
                    a, b, ahead = first[i], second[j] << SHIFT, len(a_bytes[i]) - len(b_bytes[j])
                elif ahead < 0:
                    i += 1
                    a, ahead = first[i], ahead + len(a_bytes[i])
                else:
                    j += 1
                    b, ahead = second[j] << SHIFT, ahead - len(b_bytes[j])
            groups, n_groups = ";".join(cuts), len(cuts)
        return array("Q", pairs).tobytes(), groups.encode(), len(first) | len(second) << 48 | n_groups << 96

    def text(self, text: str) -> Iterator[list[tuple[bytes, bytes, int]]]:
        """The aligned words of a text, SEGMENT at a time."""
        words = text.split(" ")
        known = self.known
        for at in range(0, len(words), SEGMENT):
            found = [known[w] for w in words[at: at + SEGMENT]]
            if None in found:  # blanks beside other white space: cut elsewhere
                break
            yield found
        else:
            return
        words = BETWEEN_WORDS.split(" ".join(words[at:]))
        for at in range(0, len(words), SEGMENT):
            yield [known.get(w) or self.aligned(w) for w in words[at: at + SEGMENT]]


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printing character: itself if it prints, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """The radix of each pair: of its second side's id, mixed, so that frequent ids do not lie together."""
    mixed = (pairs >> np.uint64(SHIFT)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def packed(records: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(records.tobytes())


def unpacked(run: bytes, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(run), kind)


def entries(run: bytes) -> Iterator[tuple[int, int]]:
    """(pair, n) of a run in its order, a block in memory at a time."""
    with zstandard.ZstdDecompressor().stream_reader(run) as reader:
        while block := reader.read(BLOCK * COUNTED.itemsize):
            while len(block) % COUNTED.itemsize:
                block += reader.read(COUNTED.itemsize - len(block) % COUNTED.itemsize)
            yield from np.frombuffer(block, COUNTED).tolist()


def counted(runs: Iterable[bytes]) -> bytes:
    """One run with each pair's sum, by a heap over the runs."""
    out: list[np.ndarray] = []
    pairs, sums = [], []
    for pair, n in heapq.merge(*map(entries, runs)):
        if pairs and pairs[-1] == pair:
            sums[-1] += n
            continue
        if len(pairs) >= 1 << 16:
            out.append(np.rec.fromarrays([pairs, sums], dtype=COUNTED))
            pairs, sums = [], []
        pairs.append(pair)
        sums.append(n)
    out.append(np.rec.fromarrays([np.array(pairs, "<u8"), np.array(sums, "<u8")], dtype=COUNTED))
    return packed(np.concatenate(out))


def highest(total: np.ndarray) -> np.ndarray:
    """For each counted pair, in second-side order, whether no pair of that id has more."""
    side = total["pair"] >> np.uint64(SHIFT)
    first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]]) if len(side) else np.empty(0, np.int64)
    if not len(first):
        return np.empty(0, bool)
    most = np.maximum.reduceat(total["n"], first)
    return total["n"] == np.repeat(most, np.diff(np.r_[first, len(side)]))


RUNS = "run long, bucket int, asked binary, records binary, docs binary"


class Run:
    """The records a task gathers until a run is full."""

    def __init__(self, doc_type: pa.DataType):
        self.type = doc_type
        self.rows, self.pairs, self.counts, self.size, self.bytes = [], [], [], 0, 0

    def add(self, doc_id, aligner: Aligner, text: str, digest: bool) -> None:
        n_a = n_b = n_groups = n_links = 0
        kept, said, sound = [], [], True
        hashed = hashlib.sha256()
        for words in aligner.text(text) if text else ():
            pairs, said_here, numbers = zip(*words)
            if 0 in numbers:
                sound = False
                break
            links, counts = np.unique(np.frombuffer(b"".join(pairs), "<u8"), return_counts=True)
            groups, number = b";".join(said_here), sum(numbers)
            if digest:
                hashed.update(b";" + groups if n_groups else groups)
            else:
                said.append(groups)
            n_a, n_b, n_groups = n_a + (number & MASK), n_b + (number >> 48 & MASK), n_groups + (number >> 96)
            n_links += int(counts.sum())
            kept.append((links, counts))
        if not kept or not sound:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            self.pairs.append(np.empty(0, "<u8"))
            self.counts.append(np.empty(0, "<i8"))
            return
        links, counts = kept[0]
        if len(kept) > 1:
            links, at = np.unique(np.concatenate([k[0] for k in kept]), return_inverse=True)
            counts = np.zeros(len(links), np.int64)
            np.add.at(counts, at, np.concatenate([k[1] for k in kept]))
        groups = hashed.hexdigest() if digest else b";".join(said).decode()
        self.rows.append((doc_id, n_a, n_b, n_groups, n_links, groups))
        self.pairs.append(links)
        self.counts.append(counts)
        self.size += len(links)
        self.bytes += len(groups)

    def full(self) -> bool:
        return self.size >= RUN_RECORDS or len(self.rows) >= RUN_DOCUMENTS or self.bytes >= RUN_GROUPS

    def written(self, number: int, buckets: int) -> pa.RecordBatch:
        """A row for each radix with its pairs and their sums, and one with the records behind them and the documents."""
        pair, n = np.concatenate(self.pairs), np.concatenate(self.counts)
        doc = np.repeat(np.arange(len(self.rows)), [len(p) for p in self.pairs])
        bucket = bucket_of(pair, buckets)
        order = np.lexsort((pair, bucket))
        pair, n, doc, bucket = pair[order], n[order], doc[order], bucket[order]
        new = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.empty(0, np.int64)
        own = np.empty(len(new), COUNTED)
        own["pair"], own["n"] = pair[new], np.add.reduceat(n, new) if len(new) else n
        held = np.diff(np.r_[new, len(pair)]) if len(new) else new
        ends = np.searchsorted(bucket[new], np.arange(buckets + 1))
        asked = [(b, packed(own[ends[b]: ends[b + 1]])) for b in range(buckets) if ends[b] < ends[b + 1]]
        sent = np.concatenate([[len(new)], held, doc, n]).astype("<u4" if len(n) == 0 or n.max() < 1 << 32 else "<u8")
        records = bytes([sent.itemsize]) + packed(sent)
        columns = list(zip(*self.rows))
        docs = pa.RecordBatch.from_arrays(
            [pa.array(columns[0], self.type), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.string())],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(docs)
        rows = [(number, b, run, None, None) for b, run in asked] + [(number, -1, None, records, sink.getvalue().to_pybytes())]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in RUNS.split(", ")])


def align(documents: DataFrame, first: str, second: str, digest: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of documents (doc_id, text).

    first is a byte-level tokenizer file that reads a blank and the text, second a SentencePiece merge model that reads the
    text. groups is the alignment ``a1,a2|b1;a3|b2,b3`` in ids, or with digest its lower-case hex sha256. n_best counts the
    links whose pair is counted as often as any of its second id; count_sum adds the corpus-wide counts over the links.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte (a literal U+2581), have zeros and
    empty groups. Equal counts are all highest. Null and repeated ids and repeated rows are documents by themselves; long
    texts are aligned whole, some words at a time; an empty table gives no rows; further columns are not read.

    Nothing is held whole: a task has one run, a heap merges FAN_IN runs of one radix, and merged runs are merged again until each
    radix has one. That one holds the distinct pairs of the radix's ids, which the two vocabularies bound.
    """
    kept = documents.select("doc_id", "text")
    kind = kept.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        aligner, run = aligner_of(first, second), None
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for k in range(batch.num_rows):
                run = run or Run(batch.column("doc_id").type)
                run.add(ids[k], aligner, batch.column("text")[k].as_py() or "", digest)
                if run.full():
                    yield run.written(number, buckets)
                    number, run = number + 1, None
        if run:
            yield run.written(number, buckets)

    runs = staged(kept.mapInArrow(gather, RUNS))
    n_runs = runs.filter("bucket = -1").count()
    slices = max(1, -(-n_runs // FAN_IN))
    asked = runs.filter("bucket >= 0").select("run", "bucket", F.pmod(F.xxhash64("run"), F.lit(slices)).cast("int").alias("slice"), "asked")

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        one = counted(rows.column("asked").to_pylist())
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32()),
                         "asked": pa.array([one], pa.binary())})

    totals, left = asked.select("bucket", "slice", "asked").groupBy("bucket", "slice").applyInArrow(
        merge, "bucket int, slice int, asked binary"), slices
    while left > 1:
        left = -(-left // FAN_IN)
        totals = totals.select("bucket", F.pmod("slice", F.lit(left)).alias("slice"), "asked").groupBy("bucket", "slice").applyInArrow(
            merge, "bucket int, slice int, asked binary")
    totals = totals.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.col("asked").alias("total"))

    def answer(rows: pa.Table, total: pa.Table) -> pa.Table:
        whole = unpacked(total.column("total")[0].as_py(), COUNTED)
        best = highest(whole)
        back = []
        for run in rows.column("asked"):
            at = np.searchsorted(whole["pair"], unpacked(run.as_py(), COUNTED)["pair"])
            back.append(packed(whole["n"][at] << np.uint64(1) | best[at].astype("<u8")))
        return pa.table({"run": rows.column("run"), "bucket": rows.column("bucket"), "told": pa.array(back, pa.binary())})

    told = asked.groupBy("bucket", "slice").cogroup(totals.groupBy("bucket", "slice")).applyInArrow(
        answer, "run long, bucket int, told binary")

    def add_up(rows: pa.Table, answers: pa.Table) -> pa.Table:
        docs = pa.ipc.open_stream(rows.column("docs")[0].as_py()).read_all()
        records = rows.column("records")[0].as_py()
        sent = unpacked(records[1:], np.dtype(f"<u{records[0]}")).astype(np.int64)
        n_pairs = int(sent[0])
        held, rest = sent[1: 1 + n_pairs], sent[1 + n_pairs:]
        doc, n = rest[: len(rest) // 2], rest[len(rest) // 2:]
        order = np.argsort(answers.column("bucket").to_numpy())
        back = [unpacked(answers.column("told")[int(k)].as_py(), np.dtype("<u8")) for k in order]
        each = np.repeat(np.concatenate(back) if back else np.empty(0, "<u8"), held)
        count, best = (each >> np.uint64(1)).astype(np.int64), (each & np.uint64(1)).astype(np.int64)
        sums, bests = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        np.add.at(sums, doc, count * n)
        np.add.at(bests, doc, best * n)
        return pa.table({"doc_id": docs.column("doc_id"), **{c: docs.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": bests, "count_sum": sums, "groups": docs.column("groups")})

    whole = runs.filter("bucket = -1").select("run", "records", "docs")
    return whole.groupBy("run").cogroup(told.groupBy("run")).applyInArrow(
        add_up, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
