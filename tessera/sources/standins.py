"""Stand-in tables for the reference's data model, built by expressions over
the driver tables (no new files, no made-up rows: every stand-in grows with
its source table).

* META  — ``screens_metadata``   from documents ⟕ labels
* EMB   — ``screens_embeddings`` from embeddings (kind text; as kind image
  the whole vector with its first 16 dims once more, a second space)
* RUNS  — ``pipeline_runs``      from events grouped by user
* RESP  — model responses         from events (shape chosen by event_id % 10)
* TREE  — widget trees            from region → nation → supplier, one tree
  per (region, block of 64 supplier keys) so no tree grows with the data
* CHAIN — deep trees              from conversations, turn n+1 the only
  child of turn n, one tree per (conversation, segment of 64 turns)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table

# Fixed values of the stand-ins (must equal the oracle SQL).
IMAGE_REPEAT = 16
SUPPLIER_BLOCK = 64
CHAIN_SEGMENT = 64
TEXT_MODEL = ("hash-text", "v1")
IMAGE_MODEL = ("hash-image", "v1")


def run_of(key) -> F.Column:
    return F.concat(F.lit("run"), (key % 3).cast("string"))


def image_vector() -> F.Column:
    """The second space: the whole vector and its first dims once more."""
    return F.concat(F.col("embedding"), F.slice("embedding", 1, IMAGE_REPEAT))


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(labels, "doc_id", "left")
    has = F.col("quality").isNotNull()
    return j.select(
        F.col("doc_id").alias("screen_id"),
        F.col("source").alias("app_package"),
        F.col("lang").alias("category"),
        F.concat(F.lit("screens/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("png_path"),
        F.concat(F.lit("screens/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("hierarchy_json_path"),
        F.when(has, F.concat(F.lit('{"title": "'), F.col("lang"), F.lit('", "toxic": '),
                             F.col("toxic").cast("string"), F.lit("}"))).alias("extraction_payload"),
        F.when(has, F.lit("v1")).alias("prompt_version"),
        F.when(F.col("quality") == 1, F.lit(0.9)).when(F.col("quality") == 0, F.lit(0.3)).alias("confidence"),
        run_of(F.col("doc_id")).alias("run_id"),
        F.sha2(F.col("text"), 256).alias("source_fingerprint"),
    )


def emb(spark: SparkSession, sf_dir: str, zero_image_label: int | None = None) -> DataFrame:
    """``zero_image_label``: fault injection — image vectors of that
    embeddings label are replaced by zero vectors."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")

    def kind(name, model, vec):
        return e.select(
            F.col("vec_id").alias("screen_id"),
            F.lit(model[0]).alias("model_name"),
            F.lit(model[1]).alias("model_version"),
            F.lit(name).alias("embedding_kind"),
            vec.alias("vector"),
            run_of(F.col("vec_id")).alias("run_id"),
            F.sha2(F.concat(F.lit(name + ":"), F.col("vec_id").cast("string")), 256).alias("source_fingerprint"),
        )

    image = image_vector()
    if zero_image_label is not None:
        image = F.when(F.col("label") == zero_image_label,
                       F.transform(image, lambda x: F.lit(0.0).cast("float"))).otherwise(image)
    return kind("text", TEXT_MODEL, F.col("embedding")).unionByName(kind("image", IMAGE_MODEL, image))


def meta_with_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """META plus a second copy of every labelled row, as a re-run without
    the conflict clause would leave it (duplicate ``screen_id``)."""
    m = meta(spark, sf_dir)
    again = m.where(F.col("prompt_version").isNotNull()).withColumn("run_id", F.lit("rerun"))
    return m.unionByName(again)


def emb_with_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EMB plus a second copy of the rows whose screen has a label
    (duplicate composite key)."""
    e = emb(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("screen_id"))
    again = e.join(labels, "screen_id", "left_semi").withColumn("run_id", F.lit("rerun"))
    return e.unionByName(again)


def emb_with_bad_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EMB plus rows of a kind outside the CHECK list (label 9 as 'audio')."""
    e = table(spark, sf_dir, "embeddings").where(F.col("label") == 9)
    bad = e.select(F.col("vec_id").alias("screen_id"), F.lit("hash-audio").alias("model_name"),
                   F.lit("v1").alias("model_version"), F.lit("audio").alias("embedding_kind"),
                   F.col("embedding").alias("vector"), run_of(F.col("vec_id")).alias("run_id"),
                   F.sha2(F.concat(F.lit("audio:"), F.col("vec_id").cast("string")), 256).alias("source_fingerprint"))
    return emb(spark, sf_dir).unionByName(bad)


def runs_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run table with repeated run ids: one row per (user, event type),
    the run id taken from the user only."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    g = ev.groupBy("user_id", "event_type").agg(F.min("ts").alias("started_at"))
    return g.select(F.concat(F.lit("run"), F.col("user_id").cast("string")).alias("run_id"), "event_type",
                    F.col("started_at").cast("timestamp_ntz").alias("started_at"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "ts")
    g = ev.groupBy("user_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"),
                                  F.count(F.lit(1)).alias("n"))
    return g.select(
        F.concat(F.lit("run"), F.col("user_id").cast("string")).alias("run_id"),
        F.concat(F.lit("dag-"), F.col("user_id").cast("string")).alias("dag_run_id"),
        F.col("started_at").cast("timestamp_ntz").alias("started_at"),
        F.col("ended_at").cast("timestamp_ntz").alias("ended_at"),
        (F.col("n") * 15).cast("int").alias("limit_param"),
    )


def _json_str(c) -> F.Column:
    """JSON string literal of a column (quoted and escaped)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def resp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    k = F.get_json_object(F.col("props"), "$.k")
    core = F.concat(F.lit('{"title": "'), F.col("event_type"), F.lit('", "elements": [{"type": "prop", "text": "'),
                    k, F.lit('"}, {"type": "event", "text": "'), F.col("event_type"), F.lit('"}]'))
    m = F.col("event_id") % 10
    raw = (F.when(m == 0, core)
           .when(m == 1, F.concat(F.lit("```json\n"), core, F.lit(', "confidence": 0.8}\n```')))
           .when(m == 2, F.concat(F.lit("["), core, F.lit(', "confidence": 0.8}]')))
           .when(m == 3, F.concat(core, F.lit(', "confidence": null}')))
           .when(m == 4, F.concat(core, F.lit(', "confidence": "high"}')))
           .when(m == 5, F.concat(core, F.lit(', "confidence": "0.75"}')))
           .when(m == 6, F.concat(core, F.lit("}")))
           .when(m == 7, F.concat(core, F.lit(', "confidence": 0.9} Hope this helps!')))
           .otherwise(F.concat(core, F.lit(', "confidence": 0.9}'))))
    return ev.select(F.col("event_id").alias("screen_id"), run_of(F.col("event_id")).alias("run_id"),
                     raw.alias("raw_output"), F.sha2(core, 256).alias("source_fingerprint"))


def resp_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that break parsers: non-finite and huge numbers, lone surrogates, failed calls."""
    ev = table(spark, sf_dir, "events").select("event_id")
    m = F.col("event_id") % 8
    raw = (F.when(m == 0, F.concat(F.lit('{"confidence": '), F.repeat(F.lit("9"), 400), F.lit("}")))
           .when(m == 1, F.lit('{"confidence": NaN}'))
           .when(m == 2, F.lit('{"confidence": "Infinity", "title": "x"}'))
           .when(m == 3, F.lit('{"title": "\\ud800", "confidence": 0.5}'))
           .when(m == 4, F.lit(None).cast("string"))
           .when(m == 5, F.lit('{"confidence": 0.25, "a": 1, "confidence": 0.5}'))
           .when(m == 6, F.lit('{"confidence": {"value": 1}}'))
           .otherwise(F.lit('{"confidence": 1e400}')))
    return ev.select(F.col("event_id").alias("screen_id"), run_of(F.col("event_id")).alias("run_id"), raw.alias("raw_output"),
                     F.when(m == 4, F.lit("TimeoutError: model call exceeded 120 s")).alias("error"),
                     F.sha2(F.col("event_id").cast("string"), 256).alias("source_fingerprint"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widget trees: DecorView root → LinearLayout per nation → leaf per
    supplier.  Leaves vary on purpose: no class, blank/padded text, 3-entry
    bounds, decimal and numeric-text bounds, tied (y, x) positions; every
    second nation list ends with a null child; odd trees are not wrapped in
    ``activity.root``."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sk = F.col("s_suppkey")
    cls = (F.when(sk % 11 == 0, F.lit(None).cast("string"))
           .when(sk % 11 == 1, F.lit("TextView"))
           .when(sk % 3 == 0, F.lit("android.widget.TextView"))
           .when(sk % 3 == 1, F.lit("android.widget.Button"))
           .otherwise(F.lit("android.widget.ImageView")))
    txt = (F.when(sk % 11 == 0, F.lit(None).cast("string"))
           .when(sk % 5 == 0, F.concat(F.lit("  "), F.col("s_name"), F.lit("\t")))
           .when(sk % 7 == 3, F.lit("   "))
           .otherwise(F.col("s_name")))
    x1 = ((sk % 3) * 360).cast("string")
    y1 = ((sk % 4) * 200).cast("string")
    x2 = F.col("s_acctbal").cast("string")
    y2 = F.when(sk % 17 == 0, F.concat(F.lit('"'), ((sk % 4) * 200 + 150).cast("string"), F.lit('"'))) \
        .otherwise(((sk % 4) * 200 + 150).cast("string"))
    bounds = F.when(sk % 13 == 0, F.concat(F.lit("["), x1, F.lit(","), y1, F.lit(","), x2, F.lit("]"))) \
        .otherwise(F.concat(F.lit("["), x1, F.lit(","), y1, F.lit(","), x2, F.lit(","), y2, F.lit("]")))
    leaf = F.concat(F.lit("{"), F.concat_ws(",",
                                            F.when(cls.isNotNull(), F.concat(F.lit('"class":'), _json_str(cls))),
                                            F.when(txt.isNotNull(), F.concat(F.lit('"text":'), _json_str(txt))),
                                            F.concat(F.lit('"bounds":'), bounds)), F.lit("}"))
    leaves = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
              .select("r_regionkey", "r_name", "n_nationkey", "n_name",
                      (sk / SUPPLIER_BLOCK).cast("long").alias("block"), sk.alias("key"), leaf.alias("node")))
    kids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "node"))), lambda e: e["node"]), ",")
    nations = leaves.groupBy("r_regionkey", "r_name", "block", "n_nationkey", "n_name").agg(kids.alias("kids"))
    nb = F.concat(F.lit("[0,"), (F.col("n_nationkey") * 10).cast("string"), F.lit(",1080,1920]"))
    nation_node = F.concat(
        F.lit('{"class":"android.widget.LinearLayout","text":'), _json_str(F.col("n_name")),
        F.lit(',"bounds":'), nb, F.lit(',"children":['), F.col("kids"),
        F.when(F.col("n_nationkey") % 2 == 0, F.lit(",null")).otherwise(F.lit("")), F.lit("]}"))
    nations = nations.select("r_regionkey", "r_name", "block", F.col("n_nationkey").alias("key"),
                             nation_node.alias("node"))
    roots = nations.groupBy("r_regionkey", "r_name", "block").agg(kids.alias("kids"))
    sid = F.col("r_regionkey").cast("long") * 1_000_000 + F.col("block")
    root = F.concat(F.lit('{"class":"com.android.internal.policy.DecorView","text":'), _json_str(F.col("r_name")),
                    F.lit(',"bounds":[0,0,1080,1920],"children":['), F.col("kids"), F.lit("]}"))
    wrapped = F.when(sid % 2 == 0, F.concat(F.lit('{"activity":{"root":'), root, F.lit("}}"))).otherwise(root)
    return roots.select(sid.alias("screen_id"), wrapped.alias("hierarchy_json"))


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested chain per (conversation, segment of 64 turns)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    seg = (F.col("turn") / CHAIN_SEGMENT).cast("long")
    opener = F.concat(F.lit('{"class":'), _json_str(F.concat(F.lit("chat."), F.col("role"))),
                      F.lit(',"text":'), _json_str(F.col("text")),
                      F.lit(',"bounds":[0,'), (F.col("turn") * 100).cast("string"), F.lit(",1080,"),
                      (F.col("turn") * 100 + 90).cast("string"), F.lit('],"children":['))
    g = (c.select("conv_id", seg.alias("seg"), "turn", opener.alias("open"))
         .groupBy("conv_id", "seg")
         .agg(F.array_sort(F.collect_list(F.struct("turn", "open"))).alias("nodes")))
    body = F.concat(F.array_join(F.transform(F.col("nodes"), lambda e: e["open"]), ""),
                    F.repeat(F.lit("]}"), F.size("nodes")))
    return g.select((F.col("conv_id") * 1000 + F.col("seg")).alias("screen_id"), body.alias("hierarchy_json"))


def levels(spark: SparkSession, sf_dir: str, per_tree: int) -> DataFrame:
    """Deep trees: ``per_tree`` customers each, every one the only child of the one before."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") / per_tree).cast("long").alias("screen_id"), "c_custkey", "c_name")
    head = F.format_string('{"class": "a.b.Level", "text": "%s", "bounds": [0, %d, 1, 1], "children": [', "c_name", F.col("c_custkey").cast("long"))
    g = c.groupBy("screen_id").agg(F.array_sort(F.collect_list(F.struct("c_custkey", head.alias("head")))).alias("s"))
    return g.select("screen_id", F.concat(F.array_join(F.transform("s", lambda x: x["head"]), ""),
                                          F.repeat(F.lit("]}"), F.size("s"))).alias("hierarchy_json"))
