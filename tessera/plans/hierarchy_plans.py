"""Tree flattening queries over the TREE and CHAIN stand-ins.  The oracles
compute the expected elements straight from the flat tables the trees were
built from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import hierarchy as H
from tessera.plans.registry import register
from tessera.sources import standins

# Expected elements of TREE, from region / nation / supplier.
TREE_ELEMENTS_SQL = """
sup AS (
  SELECT s.s_suppkey AS sk, s.s_name, s.s_acctbal, n.n_nationkey AS nk, r.r_regionkey AS rk,
         CAST(floor(s.s_suppkey / 64) AS BIGINT) AS block
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
trees AS (SELECT DISTINCT rk, block FROM sup),
nat AS (SELECT DISTINCT rk, block, nk FROM sup),
el AS (
  SELECT rk * 1000000 + block AS screen_id, -1 AS o1, -1 AS o2, 0 AS depth, 'DecorView' AS element_type,
         (SELECT r_name FROM region WHERE r_regionkey = trees.rk) AS text, 0 AS x1, 0 AS y1, 1080 AS x2, 1920 AS y2
  FROM trees
  UNION ALL
  SELECT rk * 1000000 + block, nk, -1, 1, 'LinearLayout',
         (SELECT n_name FROM nation WHERE n_nationkey = nat.nk), 0, nk * 10, 1080, 1920
  FROM nat
  UNION ALL
  SELECT rk * 1000000 + block, nk, sk, 2,
         CASE WHEN sk % 11 = 1 THEN 'TextView' WHEN sk % 3 = 0 THEN 'TextView' WHEN sk % 3 = 1 THEN 'Button'
              ELSE 'ImageView' END,
         CASE WHEN sk % 5 = 0 THEN s_name WHEN sk % 7 = 3 THEN '' ELSE s_name END,
         CASE WHEN sk % 13 = 0 THEN 0 ELSE (sk % 3) * 360 END,
         CASE WHEN sk % 13 = 0 THEN 0 ELSE (sk % 4) * 200 END,
         CASE WHEN sk % 13 = 0 THEN 0 ELSE CAST(trunc(s_acctbal) AS BIGINT) END,
         CASE WHEN sk % 13 = 0 THEN 0 ELSE (sk % 4) * 200 + 150 END
  FROM sup WHERE sk % 11 <> 0),
elements AS (
  SELECT screen_id, CAST(row_number() OVER (PARTITION BY screen_id ORDER BY o1, o2) - 1 AS BIGINT) AS pos,
         CAST(depth AS BIGINT) AS depth, element_type, text, CAST(x1 AS BIGINT) AS x1, CAST(y1 AS BIGINT) AS y1,
         CAST(x2 AS BIGINT) AS x2, CAST(y2 AS BIGINT) AS y2
  FROM el)"""


def tree_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.elements(standins.tree(spark, sf_dir))


@register("hierarchy_elements", f"""
WITH {TREE_ELEMENTS_SQL}
SELECT screen_id, pos, depth, element_type, text, x1, y1, x2, y2 FROM elements""")
def hierarchy_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept node of every tree, in pre-order, with type/text/bounds."""
    return tree_elements(spark, sf_dir).select("screen_id", "pos", "depth", "element_type", "text",
                                               "x1", "y1", "x2", "y2")


@register("hierarchy_deep", """
SELECT conv_id * 1000 + CAST(floor(turn / 64) AS BIGINT) AS screen_id,
       CAST(turn - 64 * floor(turn / 64) AS BIGINT) AS pos, CAST(turn - 64 * floor(turn / 64) AS BIGINT) AS depth,
       role AS element_type, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text, turn * 100 AS y1
FROM conversations""")
def hierarchy_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains one level per turn: depth and order must survive deep nesting."""
    e = H.elements(standins.chain(spark, sf_dir))
    return e.select("screen_id", "pos", "depth", "element_type", "text", "y1")


@register("reading_order_text", f"""
WITH {TREE_ELEMENTS_SQL}
SELECT screen_id, count(*) FILTER (WHERE text <> '') AS n_elements,
       coalesce(string_agg(text, ' ' ORDER BY y1, x1, pos) FILTER (WHERE text <> ''), '') AS text_rep
FROM elements GROUP BY screen_id""")
def reading_order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible texts per tree, top-to-bottom then left-to-right (stable), built
    in the pass that parses the tree."""
    return H.screen_texts(standins.tree(spark, sf_dir))


@register("reading_order_regrouped", f"""
WITH {TREE_ELEMENTS_SQL}
SELECT screen_id, count(*) FILTER (WHERE text <> '') AS n_elements,
       coalesce(string_agg(text, ' ' ORDER BY y1, x1, pos) FILTER (WHERE text <> ''), '') AS text_rep
FROM elements GROUP BY screen_id""")
def reading_order_regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts regrouped from element rows."""
    return H.reading_order_text(tree_elements(spark, sf_dir))


@register("first_elements", f"""
WITH {TREE_ELEMENTS_SQL}
SELECT screen_id, pos, element_type, text FROM elements WHERE pos < 10""")
def first_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preview: the first ten elements of every tree."""
    return H.first_elements(tree_elements(spark, sf_dir), 10).select("screen_id", "pos", "element_type", "text")


LEVELS = 150


@register("hierarchy_levels", f"""
SELECT CAST(floor(c_custkey / {LEVELS}) AS BIGINT) AS screen_id, row_number() OVER w - 1 AS pos, row_number() OVER w - 1 AS depth,
       c_name AS text, CAST(c_custkey AS BIGINT) AS y1
FROM customer WINDOW w AS (PARTITION BY floor(c_custkey / {LEVELS}) ORDER BY c_custkey)""")
def hierarchy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of up to 150 levels, one customer a level."""
    e = H.elements(standins.levels(spark, sf_dir, LEVELS))
    return e.select("screen_id", "pos", "depth", "text", "y1")


@register("tree_bad_records", f"""
WITH {TREE_ELEMENTS_SQL},
n AS (SELECT screen_id, count(*) AS n FROM elements GROUP BY screen_id)
SELECT screen_id, true AS ok, n AS n_elements FROM n
UNION ALL SELECT screen_id + 100000000, false, 0 FROM n""")
def tree_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tree and a copy cut short: the copies are bad records, the others go on."""
    good = standins.tree(spark, sf_dir).select("screen_id", "hierarchy_json")
    cut = good.select((F.col("screen_id") + 100000000).alias("screen_id"),
                      F.expr("left(hierarchy_json, length(hierarchy_json) - 1)").alias("hierarchy_json"))
    return H.tree_status(good.unionByName(cut)).select("screen_id", "ok", "n_elements")
