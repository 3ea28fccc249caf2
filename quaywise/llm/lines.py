"""Removing passages that repeat, by overlapping windows of three lines.

Lines that hold more than white space are numbered within their document.
Every three that follow each other are a window; windows that hold the same
three lines, white space at the ends of a line apart, are the same window. Of
each window the first place stays: the smallest document id, then the smallest
line number. All lines under a later place are removed; places that overlap
merge, so a line goes once. Lines of white space stay, as do documents of
fewer than three lines.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.llm.common import bound_batches, stored, table

WIDTH = 3
SPACE = " \t\n\r\x0b\x0c"


def real_lines(docs: DataFrame) -> DataFrame:
    """One row for each document with its real lines, without white space at their ends."""
    lines = F.split("text", "\n", -1)
    return docs.select(
        F.col("doc_id").cast("long"), _row_hash(docs).alias("row_hash"),
        F.transform(lines, lambda x: F.btrim(x, F.lit(SPACE))).alias("trimmed"),
    ).withColumn("trimmed", F.filter("trimmed", lambda x: x != ""))


def _row_hash(docs: DataFrame) -> Column:
    """Tells rows with one id apart."""
    return F.xxhash64(*(docs[c] for c in ("text", "lang", "source") if c in docs.columns))


def windows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``row_hash``, window number ``k`` and 128 bits of hash for every window.

    Hashes are made of the three lines' own hashes, so a line is hashed once.
    """
    hashed = real_lines(docs).where(F.size("trimmed") >= WIDTH).select(
        "doc_id", "row_hash",
        F.transform("trimmed", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("trimmed", lambda x: F.xxhash64(F.lit("second"), x)).alias("b"),
    )
    return hashed.select(
        "doc_id", "row_hash",
        F.posexplode(F.expr(
            f"transform(sequence(0, size(a) - {WIDTH}), k -> struct("
            "xxhash64(a[k], a[k + 1], a[k + 2]) AS a, xxhash64(b[k], b[k + 1], b[k + 2]) AS b))"
        )).alias("k", "h"),
    ).select("doc_id", "row_hash", "k", F.col("h.a").alias("a"), F.col("h.b").alias("b"))


def later_places(docs: DataFrame) -> DataFrame:
    """Window places to remove: one row for each document with the window numbers ``ks``.

    The first place and the count of a window combine before the shuffle, and
    only windows with several places are joined back, in a merge join that
    Spark can split where one window is very common.
    """
    # ids first, then window number, then a hash that tells repeated ids apart;
    # a null id comes last, so that it never takes the place of another
    place = F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row_hash"), F.col("k")
    )
    found = stored(windows(docs), "windows")
    first = found.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    repeated = first.where("n > 1").select("a", "b", "first")
    later = found.join(repeated, ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "row_hash").agg(F.collect_set("k").alias("ks"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with later places of repeated windows cut out of their ``text``.

    A null text stays null; an empty one stays empty. Rows that are repeated
    with the same id, text, language and source count as one place and stay
    alike. Rows without id lose to all others and are told apart by their
    texts. A document that repeats throughout keeps its white-space lines, or
    is left empty. An empty table gives no rows. All columns are kept as they
    are, but for ``n_chars``, which follows a text that was cut.
    """
    bound_batches(docs.sparkSession)
    later = later_places(docs).select(F.struct("doc_id", "row_hash").alias("found"), "ks")
    key = F.struct(docs["doc_id"].cast("long").alias("doc_id"), _row_hash(docs).alias("row_hash"))
    # the given columns are one, so that none of them can meet a name used here
    held = docs.select(key.alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = held.join(later, F.col("key").eqNullSafe(F.col("found")), "left")
    # texts that stay whole go to Python as nulls
    touched = F.when(F.col("ks").isNotNull(), F.col("row.text"))
    text = F.when(F.col("ks").isNull(), F.col("row.text")).otherwise(F.pandas_udf(cut, "string")(touched, "ks"))
    cleaned = joined.select("row", "ks", text.alias("text"))
    length = F.length("text")

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            own = F.col("row.n_chars")
            return F.when(F.col("ks").isNull(), own).otherwise(length.cast(docs.schema[name].dataType)).alias(name)
        return F.col("row").getField(name).alias(name)

    return cleaned.select(*map(column, docs.columns))


def cut(texts: pd.Series, places: pd.Series) -> pd.Series:
    """Texts without the lines of the given windows."""
    return pd.Series([without(t, ks) for t, ks in zip(texts, places, strict=True)], dtype=object)


def without(text: str | None, places: Iterable[int] | None) -> str | None:
    if text is None or places is None:
        return text
    dead = {k + d for k in places for d in range(WIDTH)}
    kept, real = [], 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            real += 1
            if real - 1 in dead:
                continue
        kept.append(line)
    return "\n".join(kept)


def op3_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later places of repeated windows."""
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text")


ORACLE = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM split),
trimmed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM line),
numbered AS (
  SELECT doc_id, pos, body, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS k
  FROM trimmed WHERE body <> ''),
windows AS (
  SELECT doc_id, k, body AS one, lead(body) OVER w AS two, lead(body, 2) OVER w AS three
  FROM numbered WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
places AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY one, two, three ORDER BY doc_id, k) AS nth
  FROM windows WHERE three IS NOT NULL),
dead AS (SELECT DISTINCT doc_id, k + d AS k FROM places, range(3) AS r(d) WHERE nth > 1),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM trimmed LEFT JOIN numbered USING (doc_id, pos)
  WHERE numbered.k IS NULL OR NOT EXISTS (FROM dead WHERE dead.doc_id = trimmed.doc_id AND dead.k = numbered.k)
  GROUP BY doc_id)
SELECT doc_id, CASE WHEN documents.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM documents LEFT JOIN kept USING (doc_id)
"""
