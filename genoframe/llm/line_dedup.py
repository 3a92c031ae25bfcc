"""Cross-site boilerplate lines by distinct-site spread.

A line (trimmed) that occurs on ``min_sites`` or more distinct sites is
boilerplate; a line of under ``short_chars`` characters needs ``short_sites``.
A passage, that is a line of more than ``long_words`` words or at least
``long_chars`` characters, is boilerplate as soon as two documents have it,
whatever their site: for passages, every document is a site.  Its first occurrence, the one with the
smallest (document id, position), stays, so that no text is lost from the
corpus; every other occurrence is removed.

The sites of each line hash meet in one HyperLogLog sketch per line, merged by
a map-side combined aggregation: a line on a third of all rows costs one small
sketch per task.  An estimate far from ``min_sites`` decides; within a factor
``band`` of it the line gets an exact distinct count.

Occurrences meet the list of boilerplate lines by a broadcast of those lines
that hold more than 2^-16 of all occurrences (65,536 lines at most, whatever the
input), and by a shuffle join for all others, behind a bitmap of their hashes.

Defined cases: null text is empty text and stays null, a null site is a site of
its own, blank lines are never boilerplate, an empty table gives an
empty result, rows that repeat both id and text are treated alike, a document
all of whose lines go becomes empty text.  Extra columns are kept; the added ones win over equally named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.session import stored

from . import bits
from .common import packed, parted, text_of

LINE_KEY = ["_a", "_b"]
#: A line with more than 1 / HOT of all occurrences is broadcast.
HOT = 1 << 16


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def line_table(
    docs: DataFrame,
    text: str = "text",
    doc: str = "doc_id",
    site: str = "source",
    min_sites: int = 2,
    short_chars: int = 30,
    short_sites: int = 5,
    long_words: int = 50,
    long_chars: int = 300,
) -> DataFrame:
    """(_doc, _h, _pos, _site, _need, _a, _b): one row per line that is not blank,
    with the number of sites it needs; (_a, _b) are two hashes of the trimmed line."""
    site_key = F.when(F.col(site).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(site).cast("string")))
    lines = docs.select(
        F.col(doc).alias("_doc"),
        F.xxhash64(text_of(text)).alias("_h"),
        site_key.alias("_site"),
        F.posexplode(F.split(text_of(text), "\n")).alias("_pos", "_line"),
    ).withColumn("_line", _trimmed(F.col("_line")))
    chars = F.char_length("_line")
    passage = (chars >= long_chars) | ((chars > 2 * long_words) & (F.size(F.split("_line", " ")) > long_words))
    own = F.concat(F.lit("#"), F.coalesce(F.col("_doc").cast("string"), F.lit("null")))
    return lines.filter("_line <> ''").select(
        "_doc",
        "_h",
        "_pos",
        F.when(passage, own).otherwise(F.col("_site")).alias("_site"),
        F.when(passage, 2).when(chars < short_chars, max(short_sites, min_sites)).otherwise(min_sites).alias("_need"),
        F.xxhash64("_line").alias("_a"),
        F.crc32(F.col("_line").cast("binary")).alias("_b"),
    )


def spread(lines: DataFrame, band: float = 2.0, lg_k: int = 12) -> DataFrame:
    """(_a, _b, _first, _n): the lines on as many distinct sites as they need, and
    how often they occur."""
    sketched = stored(
        lines.groupBy(*LINE_KEY)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.hll_sketch_agg("_site", F.lit(lg_k)).alias("_sketch"),
            F.min(F.struct("_doc", "_h", "_pos")).alias("_first"),
            F.min("_need").alias("_need"),
        )
        .filter(F.col("_n") >= F.col("_need"))
        .select(*LINE_KEY, "_first", "_n", "_need", F.hll_sketch_estimate("_sketch").alias("_sites")),
        "line-spread",
    )
    near = sketched.filter(F.col("_sites").between(F.col("_need") / band, F.col("_need") * band)).select(*LINE_KEY)
    filled = stored(bits.bitmap(near, "_a"), "near-bits")
    exact = (
        bits.marked(lines, F.col("_a"), filled, "_near")
        .filter("_near")
        .select(*LINE_KEY, "_site")
        .distinct()  # combined per task before it meets the list: a hot line is one row a site
        .join(near, LINE_KEY, "left_semi")
        .groupBy(*LINE_KEY)
        .agg(F.count(F.lit(1)).alias("_exact"))
    )
    return (
        sketched.filter(F.col("_sites") >= F.col("_need") / band)
        .join(exact, LINE_KEY, "left")
        .filter(F.coalesce("_exact", "_sites") >= F.col("_need"))
        .select(*LINE_KEY, "_first", "_n")
    )


def occurrences(lines: DataFrame, boiler: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose line is in the stored table ``boiler``, with
    ``_first``; no line sends more than 1 / HOT of all rows to one task."""
    total = lines.count()
    hot = boiler.filter(F.col("_n") * HOT > total).drop("_n")
    rest = stored(boiler.filter(F.col("_n") * HOT <= total).drop("_n"), "boilerplate-rest")
    filled = stored(bits.bitmap(rest, "_a"), "boilerplate-bits")
    maybe = bits.marked(lines, F.col("_a"), filled, "_possible").filter("_possible").drop("_possible")
    return lines.join(F.broadcast(hot), LINE_KEY).unionByName(maybe.join(rest, LINE_KEY))


def remove_boilerplate(
    docs: DataFrame,
    band: float = 2.0,
    text: str = "text",
    doc: str = "doc_id",
    site: str = "source",
    **needs: int,
) -> DataFrame:
    """``docs`` with its boilerplate lines cut out of ``text``, plus ``n_lines``
    (non-blank lines before) and ``n_removed``; ``needs`` goes to :func:`line_table`."""
    lines = stored(line_table(docs, text, doc, site, **needs), "lines")
    boiler = stored(spread(lines, band), "boilerplate")
    gone = (
        occurrences(lines, boiler)
        .filter(~F.struct("_doc", "_h", "_pos").eqNullSafe(F.col("_first")))
        .groupBy(F.col("_doc").alias("_gd"), F.col("_h").alias("_gh"))
        .agg(F.collect_set("_pos").alias("_gone"))
    )
    gone = stored(gone, "line-gone")
    certain, possible = parted(packed(docs, key=F.col(doc), h=F.xxhash64(text_of(text)), t=text_of(text)), "h", gone, "_gh", "line-bits")
    met = possible.join(gone, F.col("key").eqNullSafe(F.col("_gd")) & (F.col("h") == F.col("_gh")), "left").select("row", "t", "_gone")
    rows = certain.select("row", "t", F.lit(None).cast("array<int>").alias("_gone")).union(met)
    parts = F.split("t", "\n")
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("_gone", i)), "\n")
    return rows.select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c not in (text, "n_lines", "n_removed")],
        F.when(F.col("_gone").isNotNull(), kept).otherwise(F.col(f"row.`{text}`")).alias(text),
        F.size(F.filter(parts, lambda x: _trimmed(x) != "")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


ORACLE = r"""
WITH l AS (
  SELECT d.doc_id, d.source, g.i AS pos, trim(string_split(coalesce(d.text, ''), chr(10))[g.i], chr(32) || chr(9) || chr(13)) AS line,
         string_split(coalesce(d.text, ''), chr(10))[g.i] AS raw
  FROM documents d, unnest(range(1, len(string_split(coalesce(d.text, ''), chr(10))) + 1)) g(i)),
b AS (
  SELECT line, min(row(doc_id, pos)) AS first_at FROM l WHERE line <> ''
  GROUP BY line
  HAVING CASE WHEN length(line) >= 300 OR len(string_split(line, ' ')) > 50 THEN count(DISTINCT doc_id) >= 2
              ELSE count(DISTINCT coalesce('=' || source, 'null')) >= CASE WHEN length(line) < 30 THEN 5 ELSE 2 END END),
m AS (SELECT l.*, b.line IS NOT NULL AND row(l.doc_id, l.pos) <> b.first_at AS gone FROM l LEFT JOIN b ON l.line = b.line),
r AS (
  SELECT doc_id, CAST(count(*) FILTER (WHERE line <> '') AS BIGINT) AS n_lines,
         CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
  FROM m GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, CAST(length(text) AS BIGINT) AS kept_chars, sha256(text) AS text_sha256 FROM r
"""
