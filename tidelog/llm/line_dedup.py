"""Boilerplate lines that many sites share, found by HyperLogLog sketches of their sites. DataFrame work only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import staged

LG_K = 12


def line_id(line: Column) -> Column:
    """128 bits that stand for a line without its outer blanks."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(7), F.reverse(bare)).alias("b"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, home) of each line id that stands on min_sites distinct sites or more, from (line, site, doc_id).

    home is the smallest document that has it. Sketches of each task's lines merge in one aggregation. Estimates are
    right within three standard errors, so lines further from the threshold are decided by them, and only the lines
    in between have their distinct sites counted. A null site is no site.
    """
    near = max(1.0, 3 * 1.04 / 2 ** (LG_K / 2) * min_sites)
    spread = staged(
        lines.groupBy("line").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"), F.min("doc_id").alias("home"))
        .filter(F.col("sites") >= min_sites - near))
    sure = spread.filter(F.col("sites") > min_sites + near).select("line", "home")
    unsure = spread.filter(F.col("sites") <= min_sites + near).select("line", "home")
    counted = (
        lines.select("line", "site").filter("site is not null").join(unsure, "line").distinct()
        .groupBy("line", "home").agg(F.count("*").alias("sites"))
        .filter(F.col("sites") >= min_sites).select("line", "home"))
    return sure.union(counted)


def drop_boilerplate(documents: DataFrame, min_sites: int = 10, min_chars: int = 1) -> DataFrame:
    """documents (doc_id, text, source, any others) with cross-site lines removed; columns and types as they were.

    A line, compared without outer blanks, is boilerplate if it has min_chars characters and stands on min_sites
    distinct sources. It stays in its home, the document with the smallest id that has it, and goes from all others, so
    no text is lost from the corpus altogether. A document that loses all lines but blank ones is dropped. Others keep
    their row, changed or not. Null texts and texts without such lines stay as they are. Null sources are no site; rows
    with null ids are no home, and lines found under null ids only stay. Repeated rows are treated alike.
    """
    cleaned = clean_lines(documents, min_sites, min_chars).filter("n_removed = 0 or has_rest")
    return cleaned.select(F.col("doc").withField("text", F.col("clean")).alias("doc")).select("doc.*")


def clean_lines(documents: DataFrame, min_sites: int = 10, min_chars: int = 1) -> DataFrame:
    """Of each row: doc (its columns as a struct), n_lines, n_removed, clean (the text left), has_rest (not only blanks)."""
    bare = F.trim("raw")
    rows = documents.select("doc_id", F.col("source").alias("site"), F.xxhash64("doc_id", "text").alias("row_key"),
                            F.explode(lines_of(F.col("text"))).alias("raw"))
    narrow = staged(rows.filter(F.length(bare) >= max(1, min_chars)).select(
        "doc_id", "site", "row_key", line_id(F.col("raw")).alias("line")).distinct())
    bad = staged(boilerplate(narrow, min_sites))
    # Rows that share a hash share their set of lines to remove; each of those lines is to go anyhow.
    hit = (
        narrow.join(bad, "line").filter(F.col("home").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("home")))
        .groupBy("row_key").agg(F.collect_set("line").alias("bad")))
    whole = documents.select(F.struct("*").alias("doc"), F.xxhash64("doc_id", "text").alias("key"))
    joined = whole.join(hit, F.col("key") == F.col("row_key"), "left")
    lines = lines_of(F.col("doc.text"))
    kept = F.when(F.col("bad").isNull(), lines).otherwise(F.filter(lines, lambda x: ~F.array_contains(F.col("bad"), line_id(x))))
    out = joined.select("doc", lines.alias("lines"), kept.alias("kept"))
    n_lines, n_kept = (F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)) for c in ("lines", "kept"))
    out = out.select("doc", "kept", n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_removed"))
    return out.select(
        "doc", "n_lines", "n_removed",
        F.when(F.col("n_removed") == 0, F.col("doc.text")).otherwise(F.array_join("kept", "\n")).alias("clean"),
        F.coalesce(F.exists("kept", lambda x: F.trim(x) != ""), F.lit(False)).alias("has_rest"))
