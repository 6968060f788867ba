"""Operator 8 — line deduplication by distinct-site spread.

Every line that holds a word is hashed (64 + 32 bits, white space at its ends cut);
HyperLogLog sketches of the sites it occurs on are merged by aggregation, so a
line that a third of all documents carry is combined within each task.  A
sketch's estimate decides lines clearly above or below ``min_sites``; lines near
the threshold get an exact distinct count.  A line on ``min_sites`` sites or more
is boilerplate: its first occurrence (smallest document id, then position) stays,
every other goes.  No passage leaves the corpus altogether.

With ``long_sites`` lines of more than LONG_WORDS words have a threshold of their
own (the pipeline: LONG_SITES); without it, as REPORT_SQL has it, all lines share one.

Everything is DataFrame expressions; texts meet only the positions of their own
removed lines.

Defined cases: null text has no lines and stays null; a null site is no site;
null ids come last when the first occurrence is chosen; repeated rows (equal id
and text) are one document, treated alike; lines without a word are kept as they
are; an empty table gives no rows; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import docs_column, stored, whole_rows, word_count

MIN_SITES = 5
LONG_WORDS = 50
LONG_SITES = 2
LG_K = 10  # 1,024 registers: a standard error of about 3 %
BAND = 0.15  # more than four standard errors to either side count as near
_ENDS = " \t\v\f\r"


def lines_of(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int = MIN_SITES, long_sites: int | None = None) -> DataFrame:
    """(doc_id, text_key, site, pos, h1, h2, need) of every line that holds a word; on ``need`` sites it is boilerplate."""
    split = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_key"), docs[site_col].cast("string").alias("site"),
                        F.posexplode(F.split(docs[text_col], "\n")).alias("pos", "line"))
    cut = split.withColumn("line", F.trim("line", F.lit(_ENDS))).where("line <> ''")
    need = F.lit(min_sites) if long_sites is None else F.when(word_count("line") > LONG_WORDS, long_sites).otherwise(min_sites)
    return cut.select("doc_id", "text_key", "site", "pos", F.xxhash64("line").alias("h1"), F.crc32(F.col("line").cast("binary")).alias("h2"), need.alias("need"))


def boilerplate(lines: DataFrame) -> DataFrame:
    """(h1, h2, first) of the lines found on ``need`` sites or more."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "pos")).alias("first")
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"), first,
                                           F.max("need").alias("need"), F.count("site").alias("rows"))
    low, high = F.col("need") * (1 - BAND) - 1, F.col("need") * (1 + BAND) + 1
    # no line is on more sites than it has rows
    spread = stored(spread.where((F.col("sites") >= low) & (F.col("rows") >= F.col("need"))).drop("rows"), "line-spread")
    near = spread.where(F.col("sites") < high).select("h1", "h2")
    exact = (lines.join(near, ["h1", "h2"], "left_semi").select("h1", "h2", "need", "site").distinct()
             .groupBy("h1", "h2").agg(F.count("site").alias("n"), F.max("need").alias("need")).where("n >= need").select("h1", "h2"))
    sure = spread.where(F.col("sites") >= high).select("h1", "h2", "first")
    return sure.union(spread.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def clean(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
          long_sites: int | None = None) -> DataFrame:
    """(row, text, lines, removed) of every row of ``docs``: the row as one column, its text without
    the boilerplate lines, and how many lines with a word it had and lost."""
    lines = stored(lines_of(docs, id_col, text_col, site_col, min_sites, long_sites), "lines")
    found = lines.join(boilerplate(lines), ["h1", "h2"])
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key")) & (F.col("pos") == F.col("first.pos"))
    gone = (found.where(~stays).groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"))
            .agg(F.collect_set("pos").alias("gone")))  # no longer than the document's own list of lines
    rows = whole_rows(docs)
    own_id, own_text = docs_column("row", id_col), docs_column("row", text_col)
    joined = rows.join(gone, own_id.eqNullSafe(F.col("gone_id")) & (F.xxhash64(own_text) == F.col("gone_key")), "left")
    pieces = F.split(own_text, "\n")
    left = F.array_join(F.filter(pieces, lambda _, i: ~F.array_contains("gone", i)), "\n")
    words = F.size(F.filter(pieces, lambda x: F.trim(x, F.lit(_ENDS)) != ""))
    return joined.select("row", F.when(F.col("gone").isNull(), own_text).otherwise(left).alias("text"),
                         F.greatest(words, F.lit(0)).alias("lines"), F.greatest(F.size("gone"), F.lit(0)).alias("removed"))


def report(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """doc_id, n_lines, n_removed, clean_sha256 (null for a null text) of every row."""
    done = clean(docs.select(id_col, text_col, site_col), min_sites, id_col, text_col, site_col)
    return done.select(docs_column("row", id_col).alias("doc_id"), F.col("lines").cast("long").alias("n_lines"), F.col("removed").cast("long").alias("n_removed"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("clean_sha256"))


def dedup(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
          long_sites: int | None = None) -> DataFrame:
    """``docs`` with clean texts; a document that lost every line it had goes."""
    done = clean(docs, min_sites, id_col, text_col, site_col, long_sites)
    left = done.where((F.col("removed") == 0) | (F.col("removed") < F.col("lines")))
    return left.select(*[(F.col("text") if c == text_col else docs_column("row", c)).alias(c) for c in docs.columns])


REPORT_SQL = f"""
WITH l AS (
  SELECT doc_id, source, pos, trim(ls[pos + 1], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, source, ls, unnest(range(len(ls))) AS pos
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
w AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS LAST, pos) AS nth FROM l WHERE line <> ''),
b AS (SELECT line FROM w GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
gone AS (SELECT doc_id, pos FROM w WHERE nth > 1 AND line IN (SELECT line FROM b)),
kept AS (
  SELECT l.doc_id, string_agg(raw, chr(10) ORDER BY l.pos) AS text
  FROM (SELECT doc_id, pos, ls[pos + 1] AS raw
        FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS pos
              FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))) l
  ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
  GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(r.n, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(kept.text, '')) END AS clean_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
