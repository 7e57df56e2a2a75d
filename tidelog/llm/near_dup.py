"""Near-duplicate documents: one-permutation hashing, banded buckets, stars, and an exact check of every link."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import components, same, staged
from tidelog.llm.textbatch import U, chunks, mixed, shingles

BANDS = 36
MISSED = 1e-6
PROBES = 1024


def rows_for(share: float, bands: int = BANDS) -> int:
    """The most rows a band may have for a pair at the threshold to be missed by all bands with probability MISSED at most."""
    rows = 1
    while (1 - share ** (rows + 1)) ** bands <= MISSED:
        rows += 1
    return rows


def _probe(bins: int, attempts: int = PROBES) -> np.ndarray:
    """For each empty bin and attempt, the bin to copy from. The same for all rows, so that equal sets agree."""
    k = np.arange(bins, dtype=np.uint64)[None, :] * U(PROBES) + np.arange(attempts, dtype=np.uint64)[:, None]
    return (mixed(k, 5) % U(bins)).astype(np.int64)


def signatures(s: np.ndarray, row: np.ndarray, n_rows: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows with shingles, their signature of bins values) from distinct shingles in order of row and hash.

    One permutation: a hash's high bits are its bin, and a bin keeps its least hash. An empty bin takes the value of
    the first filled bin in its own random order (optimal densification). A bin that finds none in PROBES attempts
    takes the next filled one.
    """
    bin_of = ((s >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    key = row * bins + bin_of
    least = np.ones(len(key), bool)
    least[1:] = key[1:] != key[:-1]  # in order of hash, so of bin and value
    table = np.zeros((n_rows, bins), U)
    full = np.zeros((n_rows, bins), bool)
    table.reshape(-1)[key[least]] = s[least]
    full.reshape(-1)[key[least]] = True
    some = np.flatnonzero(full.any(axis=1))
    table, full = table[some], full[some]
    r, b = np.nonzero(~full)
    for probe in _probe(bins):
        if not len(r):
            break
        source = probe[b]
        found = full[r, source]
        table[r[found], b[found]] = table[r[found], source[found]]
        r, b = r[~found], b[~found]
    for x, y in zip(r, b):
        filled = np.flatnonzero(full[x])
        table[x, y] = table[x, filled[np.searchsorted(filled, y) % len(filled)]]
    return some, table


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values.view(np.int64)))


def _sketches(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = mixed(np.arange(1, rows + 1, dtype=np.uint64), 11) | U(1)
        for batch in batches:
            for first, raw, at in chunks(batch.column(1)):
                m = len(at) - 1
                s, row = shingles(raw, at)
                n = np.bincount(row, minlength=m)
                a, b = (_sums(mixed(s, salt), row, m) for salt in (21, 22))
                some, table = signatures(s, row, m, bands * rows)
                band = (table.reshape(len(some), bands, rows) * weight).sum(axis=2, dtype=np.uint64)
                band = mixed(band + mixed(np.arange(bands, dtype=np.uint64), 31))
                has = np.zeros(m, np.int64)
                has[some] = bands
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, m), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b),
                     _lists(has, band.reshape(-1))], ["doc_id", "n", "a", "b", "bands"])
    return run


def _sums(values: np.ndarray, row: np.ndarray, m: int) -> np.ndarray:
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values, out=total[1:])
    edge = np.searchsorted(row, np.arange(m + 1))
    return (total[edge[1:]] - total[edge[:-1]]).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, raw, at in chunks(batch.column(1)):
            m = len(at) - 1
            s, row = shingles(raw, at)
            n = np.bincount(row, minlength=m)
            a, b = (_sums(mixed(s, salt), row, m) for salt in (21, 22))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, m), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b),
                 _lists(n, s)], ["doc_id", "n", "a", "b", "set"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full sets meet the threshold. sets: (node, n, set)."""
    left = sets.select(F.col("node").alias("src"), F.col("n").alias("n_l"), F.col("set").alias("set_l"))
    right = sets.select(F.col("node").alias("dst"), F.col("n").alias("n_r"), F.col("set").alias("set_r"))
    both = F.size(F.array_intersect("set_l", "set_r"))
    return (
        pairs.join(left, "src").join(right, "dst")
        .filter(100 * both >= percent * (F.col("n_l") + F.col("n_r") - both)).select("src", "dst"))


def near_groups(documents: DataFrame, percent: int = 85, bands: int = BANDS) -> DataFrame:
    """(doc_id, n, component) of each row (doc_id, text), linked where 100 * intersection >= percent * union.

    1. Documents with equal sets are one class from the start (counted by a 128-bit sum of the set's hashes), so
       exact copies make no candidates. 2. Classes meet in banded buckets of their signature; a bucket gives one
       candidate to each member, with its smallest one, so candidates grow with rows and not with their squares.
       3. Candidates are checked on full sets, and links give components. 4. A star can leave members of a bucket in
       different components though they are similar to each other. All classes of such buckets go through an exact
       prefix filter: with shingles in order of frequency, two similar sets share one of the first
       n - ceil(percent * n / 100) + 1, and after the first in common both have enough left. Those pairs, of
       different components only, are checked too.

    Null and blank texts have n = 0 and their own id as component; a null id has a null component. Rows that
    share an id are one document that has all their links. An empty table gives no rows.
    """
    share = percent / 100
    text = documents.select("doc_id", "text")
    sketched = staged(text.mapInArrow(_sketches(bands, rows_for(share, bands)), "doc_id long, n long, a long, b long, bands array<long>"))
    named = sketched.filter("n > 0 and doc_id is not null")
    classes = staged(named.groupBy("n", "a", "b").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")))
    # A document id in several classes joins them.
    member = named.select("doc_id", "n", "a", "b").distinct()
    twice = member.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    several = member.join(twice, "doc_id").join(classes, ["n", "a", "b"])
    bridges = several.join(several.groupBy("doc_id").agg(F.min("node").alias("src")), "doc_id").select(
        "src", F.col("node").alias("dst")).filter("src != dst")
    # The same id may stand for two classes: nodes that differ in a and b get the same number, which only adds links
    # that the bridge of that id states anyway.
    leaders = named.join(classes.select("n", "a", "b", "node"), ["n", "a", "b"]).filter("doc_id = node")
    in_bucket = leaders.select("node", "n", F.explode("bands").alias("bucket"))
    star = in_bucket.groupBy("bucket").agg(F.min("node").alias("centre"), F.max("node").alias("top"))
    met = staged(in_bucket.join(star.filter("centre < top").drop("top"), "bucket").select("bucket", "centre", "node", "n"))
    sizes = met.select("node", "n").distinct()
    needed = sizes.select(F.col("node").alias("doc_id")).distinct()
    sets = staged(
        text.join(needed, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, n long, a long, b long, set array<long>")
        .join(classes.select("n", "a", "b", "node"), ["n", "a", "b"]).filter("doc_id = node")
        .dropDuplicates(["node", "n", "a", "b"]).select("node", "n", "set"))
    pairs = met.filter("centre < node").select(F.col("centre").alias("src"), F.col("node").alias("dst")).distinct()
    links = staged(_linked(pairs, sets, percent).distinct().union(bridges))
    groups = components(links)

    place = F.coalesce(F.col("g.component"), F.col("m.node")).alias("component")
    placed = met.alias("m").join(groups.alias("g"), F.col("m.node") == F.col("g.node"), "left").select(
        "m.bucket", "m.node", place)
    open_buckets = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    rest = staged(placed.join(open_buckets, "bucket", "left_semi").select("node", "component").distinct())
    more = _prefix_pairs(rest, sets, share)
    found = staged(_linked(more, sets, percent).distinct())
    if not found.isEmpty():
        groups = components(links.union(found))
    labels = classes.alias("c").join(groups.alias("g"), F.col("c.node") == F.col("g.node"), "left").select(
        "c.n", "c.a", "c.b", F.coalesce("g.component", "c.node").alias("component"))
    every = sketched.alias("s").join(
        labels.alias("l"),
        (F.col("s.n") == F.col("l.n")) & (F.col("s.a") == F.col("l.a")) & (F.col("s.b") == F.col("l.b")), "left")
    component = F.when(F.col("s.doc_id").isNotNull(), F.coalesce("l.component", "s.doc_id"))
    return every.select("s.doc_id", "s.n", component.alias("component"))


def _prefix_pairs(rest: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """Every pair (src, dst) of different components among rest (node, component) that can reach the threshold."""
    all_rows = rest.join(sets, "node")
    rows = all_rows.select("node", "component", "n", F.explode("set").alias("s"))
    often = rows.groupBy("s").agg(F.count("*").alias("f")).filter("f > 1")
    # Shingles that no other set has come first in the order and take up places of the prefix.
    common = rows.join(often, "s")
    shared = F.count("*").over(Window.partitionBy("node", "n"))
    at = F.row_number().over(Window.partitionBy("node", "n").orderBy("f", "s"))
    prefix = (
        common.withColumn("p", F.col("n") - shared + at)
        .filter(F.col("p") <= F.col("n") - F.ceil(F.col("n") * F.lit(share) - 1e-9) + 1)
        .select("s", "f", "node", "component", "n", "p"))
    prefix = staged(prefix)
    # Shingles of a shared passage stand in the same sets. Of shingles with equal sets the first in the order will do.
    alike = prefix.groupBy("s", "f").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("held"),
        *[F.sum(F.xxhash64(F.lit(k), "node", "n").cast("decimal(38,0)")).alias(f"of_{k}") for k in (1, 2)])
    kept = alike.filter("lo < hi").groupBy("held", "of_1", "of_2").agg(F.min(F.struct("f", "s")).alias("first")).select("first.s")
    prefix = staged(prefix.join(kept, "s", "left_semi"))
    one, two = prefix.alias("x"), prefix.alias("y")
    # With this as the first shingle in common, both rests have to hold what the overlap needs.
    rest_holds = F.least(F.col("x.n") - F.col("x.p"), F.col("y.n") - F.col("y.p")) + 1
    near = (
        (F.col("x.s") == F.col("y.s")) & (F.col("x.component") < F.col("y.component"))
        & (rest_holds >= (F.col("x.n") + F.col("y.n")) * F.lit(share / (1 + share)) - 1e-9)
        & (F.col("x.n") >= F.lit(share) * F.col("y.n") - 1e-9) & (F.col("y.n") >= F.lit(share) * F.col("x.n") - 1e-9))
    return one.join(two, near).select(F.col("x.node").alias("src"), F.col("y.node").alias("dst")).distinct()


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row; kept where doc_id is its component's smallest."""
    found = near_groups(documents, percent)
    kept = F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def drop_near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """documents with one row of each group of similar texts: the one of the smallest id, null last, and then of the smallest text.

    Texts alone link rows. Rows that share an id, or have none, are judged each by itself, so that no text goes for another that is
    not like it. Blank and null texts stay; of equal rows one stays; an empty table gives no rows; columns are kept as they are.
    """
    # A row's number is fixed by the written table, however often it is read. Rows go by it alone, so that no text is shuffled to number them.
    rows = staged(documents.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")))
    grouped = staged(near_groups(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), percent).filter("n > 0").select(
        F.col("doc_id").alias("row"), "component"))
    several = grouped.groupBy("component").agg(F.count("*").alias("held")).filter("held > 1")
    members = staged(grouped.join(several, "component", "left_semi"))
    if members.isEmpty():
        return rows.select("doc.*")
    # Texts only decide between rows of a group that have its smallest id.
    id_of = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"))
    named = rows.select("row", id_of.alias("id")).join(members, "row")
    least = named.groupBy("component").agg(F.min("id").alias("id"))
    ahead = staged(named.alias("x").join(least.alias("l"), same(["component", "id"], "x", "l"), "left_semi"))
    tied = ahead.groupBy("component").agg(F.count("*").alias("held")).filter("held > 1")
    texts = rows.select("row", F.col("doc.text").alias("text")).join(ahead.join(tied, "component", "left_semi").select("row", "component"), "row")
    decided = texts.groupBy("component").agg(F.min(F.struct("text", (-F.col("row")).alias("last"))).alias("first")).select((-F.col("first.last")).alias("row"))
    first = ahead.join(tied, "component", "left_anti").select("row").union(decided)
    gone = members.join(first, "row", "left_anti").select("row")
    return rows.join(gone, "row", "left_anti").select("doc.*")
