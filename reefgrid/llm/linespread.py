"""Removal of boilerplate lines by the number of sites they stand on.

A line's spread is its number of distinct sites. HyperLogLog sketches of the
sites, merged per line hash by aggregation, tell lines far below or above the
threshold apart; lines that a sketch's error leaves in doubt are counted
exactly. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.llm.common import stored

MIN_SITES = 10
SKETCH_LOG2 = 12

_BLANKS = " \t\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keyed(documents: DataFrame, site: str) -> DataFrame:
    """Every line that is not blank, by two independent hashes, with its document and place."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col(site).cast("string").alias("site"),
        F.posexplode(_lines(F.col("text"))).alias("place", "line"),
    ).withColumn("line", F.btrim("line", F.lit(_BLANKS))).filter("line <> ''")
    return rows.select("doc_id", "text_key", "site", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(occurrences: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(h1, h2, first_doc)`` of the lines on at least ``min_sites`` distinct sites."""
    key = ["h1", "h2"]
    sketched = stored(occurrences.groupBy(*key).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_LOG2))).alias("sites"), F.min("doc_id").alias("first_doc")), "lines-sketched")
    doubt = math.ceil(4 * 1.04 / math.sqrt(1 << SKETCH_LOG2) * min_sites) + 1
    near = sketched.filter(F.abs(F.col("sites") - min_sites) <= doubt)
    exact = occurrences.join(near.select(*key), key, "left_semi").select(*key, "site").distinct().groupBy(*key).agg(
        F.count("site").alias("exact_sites"))
    spread = F.coalesce("exact_sites", "sites")
    return sketched.join(exact, key, "left").filter(spread >= min_sites).select(*key, "first_doc")


def _between(lines: Column, runs: Column) -> Column:
    """The lines outside the sorted runs, joined again: slices from the end of each run to the next, so each line is touched once."""
    zero, one = F.array(F.lit(0)), F.lit(1)

    def joined(held: Column) -> Column:
        begins = F.concat(zero, F.transform(held["runs"], lambda r: r["end"] + one))
        ends = F.concat(F.transform(held["runs"], lambda r: r["begin"]), F.array(F.size(held["lines"])))
        stretches = F.filter(F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("begin"), (b - a).alias("n"))), lambda e: e["n"] > 0)
        return F.array_join(F.flatten(F.transform(stretches, lambda e: F.slice(held["lines"], e["begin"] + one, e["n"]))), "\n")

    # Lines are bound to a name, or every slice would part the text anew.
    return F.transform(F.array(F.struct(lines.alias("lines"), runs.alias("runs"))), joined)[0]


def remove_boilerplate(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``documents`` with boilerplate lines taken out of ``text``, plus ``n_lines`` and ``n_removed``.

    A line counts without the spaces, tabs and carriage returns around it; blank
    lines never go. A boilerplate line stays in the document with the smallest
    ``doc_id`` that has it, so no text is lost from the corpus. Lines are parted
    by line feeds; what stays is joined by them.

    A null text stays null with no lines. A null site counts for no spread, and
    a document with a null id keeps all its lines. Repeated rows are treated
    alike, of equal lines each counts. Texts of very many lines cost in proportion
    to them. Other columns pass through; ``n_lines`` and ``n_removed`` of the input
    are replaced. An empty table gives no rows.
    """
    keyed = _keyed(documents, site)
    often = keyed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites).select("h1", "h2")
    occurrences = stored(keyed.join(often, ["h1", "h2"]), "lines-often")
    removed = occurrences.join(boilerplate(occurrences, min_sites), ["h1", "h2"]).filter("doc_id <> first_doc").select(
        "doc_id", "text_key", "place").distinct()
    # Neighbouring lines go as one run: a document of removed lines only is one run.
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("place"))
    runs = removed.withColumn("island", F.col("place") - nth).groupBy("doc_id", "text_key", "island").agg(
        F.min("place").alias("begin"), F.max("place").alias("end"))
    runs = runs.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("runs"), F.sum(F.col("end") - F.col("begin") + 1).alias("n_removed"))
    columns = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    packed = documents.select(
        F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"))
    joined = packed.join(runs, ["doc_id", "text_key"], "left")
    lines = _lines(F.col("row.text"))
    text = F.when(F.col("runs").isNull(), F.col("row.text")).otherwise(_between(lines, F.col("runs")))
    return joined.select(
        *[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns],
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
    )


def without_boilerplate(documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``documents`` with boilerplate lines removed, in their own columns; ``n_chars`` follows the text.

    A document that consisted of boilerplate lines only is removed.
    """
    found = remove_boilerplate(documents, site, min_sites)
    bare = (F.col("n_removed") > 0) & (F.btrim("text", F.lit(_BLANKS + "\n")) == "")
    out = found.filter(F.coalesce(~bare, F.lit(True)))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)
