"""Registered queries: each reads the driver's tables and exercises operators.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]`` (DuckDB SQL
over the same tables, same column names). Queries without an oracle are
checked on row counts only, plus unit tests against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frame import Frame, FrameSet
from ..session import scratch_dir
from ..sources.readers import from_options

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str, **kw):
    return from_options(spark, "parquet", {"paths": [f"{sf_dir}/{name}.parquet"]}, **kw)


# ---------------------------------------------------------------------------
# flagship: read, map, join, split rows, back to a DataFrame, aggregate


@register(
    "priority_revenue",
    """
    SELECT o_orderpriority AS priority,
           count(*) AS n_lines,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS revenue
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE l_quantity > 25
    GROUP BY o_orderpriority
    """,
)
def priority_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").apply_mapping(
        [("o_orderkey", "orderkey"), ("o_orderpriority", "priority")])
    lines = table(spark, sf_dir, "lineitem").apply_mapping(
        [("l_orderkey", "l_orderkey"), ("l_quantity", "qty"), ("l_extendedprice", "price", "decimal(15,2)")])
    joined = orders.join(["orderkey"], ["l_orderkey"], lines)
    big = joined.split_rows({"qty": {">": 25}}, "big", "small")["big"]
    return (big.toDF().groupBy("priority")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum("price").cast("decimal(38,2)").alias("revenue")))


def _flat(df: DataFrame) -> DataFrame:
    """Dotted column names to underscores (for comparing nested results)."""
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


# ---------------------------------------------------------------------------
# sources


@register("scan_pushdown", """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'F'
""")
def scan_pushdown(spark, sf_dir):
    f = from_options(spark, "s3", {"paths": [f"{sf_dir}/orders.parquet"], "minPartitions": 4, "targetPartitions": 8},
                     format="parquet", push_down_predicate="o_orderstatus = 'F'")
    return f.select_fields(["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).toDF()


@register("catalog_scan", """
    SELECT o_orderkey, o_orderpriority || '-' || o_orderstatus AS tag
    FROM orders WHERE o_totalprice > 100000
""")
def catalog_scan(spark, sf_dir):
    from ..sources.readers import from_catalog

    table(spark, sf_dir, "orders").df.createOrReplaceTempView("ff_orders")
    f = from_catalog(spark, table_name="ff_orders", push_down_predicate="o_totalprice > 100000")
    return f.toDF().select("o_orderkey", F.expr("concat(o_orderpriority, '-', o_orderstatus)").alias("tag"))


@register("from_rows", "SELECT r_regionkey, r_name FROM region")
def from_rows_query(spark, sf_dir):
    from ..sources.readers import from_rows

    src = table(spark, sf_dir, "region").df
    f = from_rows(spark, src.rdd.map(tuple), "region", schema="r_regionkey int, r_name string")
    return f.with_frame_schema("r_regionkey int, r_name string").toDF()


def _roundtrip(spark, sf_dir, fmt, fmt_opts=None):
    from ..sources.sinks import write_from_options

    src = table(spark, sf_dir, "customer")
    out = scratch_dir(spark, f"roundtrip-{fmt}")
    write_from_options(src, "file", {"path": out, "mode": "overwrite"}, fmt, fmt_opts or {})
    return from_options(spark, "file", {"paths": [out]}, format=fmt, format_options=fmt_opts or {})


_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@register("format_roundtrip_json", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def format_roundtrip_json(spark, sf_dir):
    f = _roundtrip(spark, sf_dir, "json")
    return f.toDF().select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("format_roundtrip_csv", _CUSTOMER)
def format_roundtrip_csv(spark, sf_dir):
    f = _roundtrip(spark, sf_dir, "csv", {"withHeader": True, "separator": "|", "inferSchema": "true"})
    return f.toDF().select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register("format_roundtrip_orc", _CUSTOMER)
def format_roundtrip_orc(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "orc").toDF()


@register("collection_write", """
    SELECT 'expensive' AS name, count(*) AS n FROM orders WHERE o_totalprice > 100000
    UNION ALL
    SELECT 'cheap' AS name, count(*) AS n FROM orders WHERE NOT coalesce(o_totalprice > 100000, false)
""")
def collection_write(spark, sf_dir):
    from ..sources.sinks import write_from_options

    parts = table(spark, sf_dir, "orders").split_rows({"o_totalprice": {">": 100000}}, "expensive", "cheap")
    out = scratch_dir(spark, "collection")
    errs = write_from_options(parts, "file", {"path": out, "mode": "overwrite"}, "parquet")
    assert sorted(errs.keys()) == ["cheap_errors", "expensive_errors"] and len(parts) == 2
    back = [from_options(spark, "file", {"paths": [f"{out}/{k}"]}, format="parquet").df
            .select(F.lit(k).alias("name"), F.lit(1).alias("one")) for k in parts.keys()]
    return back[0].unionByName(back[1]).groupBy("name").agg(F.count("one").alias("n"))


@register("partitioned_write", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def partitioned_write(spark, sf_dir):
    from ..sources.sinks import write_from_options

    out = scratch_dir(spark, "partitioned")
    write_from_options(table(spark, sf_dir, "orders"), "file", {"path": out, "mode": "overwrite", "partitionKeys": ["o_orderstatus"]}, "parquet")
    back = from_options(spark, "file", {"paths": [out]}, format="parquet", push_down_predicate="o_orderstatus IS NOT NULL")
    return back.toDF()


@register("spigot_passthrough", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def spigot_passthrough(spark, sf_dir):
    f = table(spark, sf_dir, "part")
    return f.spigot(scratch_dir(spark, "spigot"), {"prob": 0.1, "topk": 10}).toDF()


@register("kv_scan", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def kv_scan(spark, sf_dir):
    f = table(spark, sf_dir, "customer", push_down_predicate="c_mktsegment = 'BUILDING'")
    return f.select_fields(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).toDF()


@register("keyword_lines", "SELECT DISTINCT p_name AS keyword FROM part")
def keyword_lines_query(spark, sf_dir):
    from ..sources.files import keyword_lines

    part = table(spark, sf_dir, "part").df
    out = scratch_dir(spark, "keywords")
    (part.select(F.concat(F.col("p_name"), F.lit("\r")).alias("value"))
     .unionByName(part.select(F.lit("").alias("value")))
     .write.mode("overwrite").text(out))
    return keyword_lines(spark, out).distinct()


@register("bookmark_incremental", """
    SELECT event_id, user_id, event_type,
           CASE WHEN event_id * 2 <= (SELECT max(event_id) FROM events) THEN 1 ELSE 2 END AS run
    FROM events
""")
def bookmark_incremental(spark, sf_dir):
    from ..sources.bookmark import Job

    events = table(spark, sf_dir, "events").df.select("event_id", "user_id", "event_type")
    landing = scratch_dir(spark, "landing")
    job = Job(spark, bookmark_dir=scratch_dir(spark, "ledger"))
    max_id = events.agg(F.max("event_id")).collect()[0][0]
    events.where(F.col("event_id") * 2 <= max_id).write.mode("append").parquet(landing)
    job.init("bookmark_incremental", {"job-bookmark-option": "job-bookmark-enable"})
    first = from_options(spark, "file", {"paths": [landing]}, format="parquet", transformation_ctx="events_src")
    first_ckpt = first.df.withColumn("run", F.lit(1))
    first_out = scratch_dir(spark, "run1")
    first_ckpt.write.mode("overwrite").parquet(first_out)
    job.commit()
    events.where(F.col("event_id") * 2 > max_id).write.mode("append").parquet(landing)
    job.init("bookmark_incremental", {"job-bookmark-option": "job-bookmark-enable"})
    second = from_options(spark, "file", {"paths": [landing]}, format="parquet", transformation_ctx="events_src")
    job.commit()
    return spark.read.parquet(first_out).unionByName(second.df.withColumn("run", F.lit(2)))


# ---------------------------------------------------------------------------
# projections


def _nested_customer(spark, sf_dir):
    c = table(spark, sf_dir, "customer").df
    nested = c.select(
        F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                 F.struct(F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg")).alias("acct")).alias("c"),
        "c_nationkey")
    return Frame(nested, "customer")


@register("select_nested", "SELECT c_custkey AS c_key, c_mktsegment AS c_acct_seg, c_nationkey FROM customer")
def select_nested(spark, sf_dir):
    f = _nested_customer(spark, sf_dir).select_fields(["c.key", "c.acct.seg", "c_nationkey", "c.missing"])
    return _flat(f.unnest().toDF())


@register("drop_nested", "SELECT c_custkey AS c_key, c_name AS c_name, c_mktsegment AS c_acct_seg, c_nationkey FROM customer")
def drop_nested(spark, sf_dir):
    f = _nested_customer(spark, sf_dir).drop_fields(["c.acct.bal", "nope.x"])
    return _flat(f.unnest().toDF())


@register("rename_nested", "SELECT c_custkey AS c_key, c_name AS c_full_name, c_acctbal AS c_acct_bal, c_mktsegment AS segment, c_nationkey AS nation FROM customer")
def rename_nested(spark, sf_dir):
    f = (_nested_customer(spark, sf_dir)
         .rename_field("c.name", "c.full_name")
         .rename_field("c.acct.seg", "segment")
         .rename_field("c_nationkey", "nation"))
    return _flat(f.unnest().toDF())


@register("split_fields_a", "SELECT p_partkey, p_name FROM part")
def split_fields_a(spark, sf_dir):
    return table(spark, sf_dir, "part").split_fields(["p_partkey", "p_name"], "a", "b")["a"].toDF()


@register("split_fields_b", "SELECT p_brand, p_type, p_size, p_retailprice FROM part")
def split_fields_b(spark, sf_dir):
    return table(spark, sf_dir, "part").split_fields(["p_partkey", "p_name"], "a", "b")["b"].toDF()


@register("mapping_cast", """
    SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS INTEGER) AS qty,
           CAST(l_extendedprice AS DECIMAL(15,2)) AS price, CAST(l_shipdate AS DATE) AS ship_date,
           l_returnflag AS flags_returnflag, l_linestatus AS flags_linestatus
    FROM lineitem
""")
def mapping_cast(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").apply_mapping([
        ("L_ORDERKEY", "order_key"),
        ("l_linenumber", "int", "line", "long"),
        ("l_quantity", "qty", "int"),
        ("l_extendedprice", "price", "decimal(15,2)"),
        ("l_shipdate", "ship_date", "date"),
        ("l_returnflag", "flags.returnflag"),
        ("l_linestatus", "flags.linestatus"),
    ])
    return _flat(f.unnest().toDF())


@register("mapping_errors", """
    SELECT 'good' AS kind, count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NOT NULL) AS n FROM orders
    UNION ALL
    SELECT 'error' AS kind, count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL) AS n FROM orders
""")
def mapping_errors(spark, sf_dir):
    f = table(spark, sf_dir, "orders").apply_mapping([("o_orderkey", "key"), ("o_orderpriority", "prio", "int")])
    good = f.toDF().select(F.lit("good").alias("kind"), F.lit(1).alias("one"))
    bad = f.errorsAsFrame().toDF().select(F.lit("error").alias("kind"), F.lit(1).alias("one"))
    counts = good.unionByName(bad).groupBy("kind").agg(F.count("one").alias("n"))
    kinds = spark.sql("SELECT * FROM VALUES ('good'), ('error') AS t(kind)")
    return kinds.join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


@register("drop_null_fields", """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_name AS info_name FROM supplier
""")
def drop_null_fields(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").df
    wide = s.select("*", F.lit(None).cast("string").alias("s_comment"),
                    F.struct(F.col("s_name").alias("name"), F.lit(None).cast("int").alias("note")).alias("info"))
    return _flat(Frame(wide, "supplier").drop_null_fields().unnest().toDF())


@register("filter_python", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def filter_python(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select_fields(["o_orderkey", "o_totalprice"])
    return f.filter(lambda r: r["o_totalprice"] > 200000).toDF()


@register("filter_column", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000")
def filter_column(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select_fields(["o_orderkey", "o_totalprice"])
    return f.filter(F.col("o_totalprice") > 200000).toDF()


_SPLIT = {"l_quantity": {">": 10, "<=": 30}}


@register("split_rows_hit", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_quantity <= 30")
def split_rows_hit(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").select_fields(["l_orderkey", "l_linenumber", "l_quantity"])
    return f.split_rows(_SPLIT, "hit", "rest")["hit"].toDF()


@register("split_rows_rest", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT coalesce(l_quantity > 10 AND l_quantity <= 30, false)")
def split_rows_rest(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").select_fields(["l_orderkey", "l_linenumber", "l_quantity"])
    return f.split_rows(_SPLIT, "hit", "rest")["rest"].toDF()


# ---------------------------------------------------------------------------
# joins


@register("join_equi", """
    SELECT o_orderkey, o_custkey, l_linenumber, l_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_equi(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select_fields(["o_orderkey", "o_custkey"])
    l = table(spark, sf_dir, "lineitem").select_fields(["l_orderkey", "l_linenumber", "l_quantity"])
    return o.join("o_orderkey", "l_orderkey", l).toDF().select("o_orderkey", "o_custkey", "l_linenumber", "l_quantity")


@register("join_multi_key", """
    SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_partkey AS l_partkey_r
    FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
""")
def join_multi_key(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").select_fields(["l_orderkey", "l_linenumber", "l_partkey"])
    b = table(spark, sf_dir, "lineitem").select_fields(["l_orderkey", "l_linenumber", "l_partkey"])
    j = a.join(["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber"], b)
    return j.toDF().select("l_orderkey", "l_linenumber", "l_partkey", "l_partkey_r")


# ---------------------------------------------------------------------------
# nesting


@register("unnest_struct", """
    SELECT o_orderkey, c_custkey AS cust_key, c_name AS cust_name, c_mktsegment AS cust_seg
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def unnest_struct(spark, sf_dir):
    o = table(spark, sf_dir, "orders").df.select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").df.select(
        "c_custkey", F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg")).alias("cust"))
    j = Frame(o, "o").join("o_custkey", "c_custkey", Frame(c, "c"))
    return _flat(j.drop_fields(["o_custkey", "c_custkey"]).unnest().toDF())


def _nested_part(spark, sf_dir):
    p = table(spark, sf_dir, "part").df
    info = F.struct(
        F.col("p_brand").alias("brand"),
        F.split(F.col("p_name"), " ").alias("words"),
        F.array(F.struct(F.col("p_size").alias("size"), F.split(F.col("p_type"), " ").alias("kinds"))).alias("sizes"))
    return Frame(p.select("p_partkey", info.alias("info")), "part")


@register("relationalize_child", """
    SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS index,
           unnest(string_split(p_name, ' ')) AS word
    FROM part
""")
def relationalize_child(spark, sf_dir):
    tables = _nested_part(spark, sf_dir).relationalize("root", scratch_dir(spark, "relationalize"))
    root = tables["root"].toDF()
    words = tables["root_info.words"].toDF()
    j = root.join(words, root["`info.words`"] == words["id"])
    return j.select("p_partkey", "index", F.col("`info.words.val`").alias("word"))


@register("relationalize_rejoin", """
    SELECT p_partkey, p_size AS size, CAST(generate_subscripts(string_split(p_type, ' '), 1) - 1 AS INTEGER) AS kind_index,
           unnest(string_split(p_type, ' ')) AS kind
    FROM part
""")
def relationalize_rejoin(spark, sf_dir):
    tables = _nested_part(spark, sf_dir).relationalize("root", scratch_dir(spark, "relationalize"))
    assert set(tables.keys()) == {"root", "root_info.words", "root_info.sizes", "root_info.sizes.val.kinds"}, list(tables.keys())
    root = tables["root"].toDF().select("p_partkey", F.col("`info.sizes`").alias("sizes_key"))
    sizes = tables["root_info.sizes"].toDF().select(
        F.col("id").alias("sizes_key"), F.col("index").alias("size_index"),
        F.col("`info.sizes.val.size`").alias("size"), F.col("`info.sizes.val.kinds`").alias("kinds_key"))
    kinds = tables["root_info.sizes.val.kinds"].toDF().select(
        F.col("id").alias("kinds_key"), F.col("index").alias("kind_index"), F.col("`info.sizes.val.kinds.val`").alias("kind"))
    return root.join(sizes, "sizes_key").join(kinds, "kinds_key").select("p_partkey", "size", "kind_index", "kind")


@register("unbox_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def unbox_json(spark, sf_dir):
    f = table(spark, sf_dir, "events").select_fields(["event_id", "props"]).unbox("props", "json")
    return f.toDF().select("event_id", F.col("props.k").alias("k"))


@register("unbox_csv", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS seg FROM customer")
def unbox_csv(spark, sf_dir):
    c = table(spark, sf_dir, "customer").df
    boxed = Frame(c.select(F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("line")), "boxed")
    schema = '{"type":"struct","fields":[{"name":"key","type":"long","nullable":true,"metadata":{}},{"name":"name","type":"string","nullable":true,"metadata":{}},{"name":"seg","type":"string","nullable":true,"metadata":{}}]}'
    f = boxed.unbox("line", "csv", separator="|", withSchema=schema)
    return f.toDF().select("line.key", "line.name", "line.seg")


@register("explode_index", """
    SELECT p_partkey, CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INTEGER) AS index,
           unnest(string_split(p_name, ' ')) AS val
    FROM part
""")
def explode_index(spark, sf_dir):
    from ..functions import explode_with_index

    p = table(spark, sf_dir, "part").df
    return p.select("p_partkey", explode_with_index(F.split("p_name", " ")))


@register("named_struct", "SELECT p_partkey AS key, p_brand AS brand FROM part")
def named_struct_query(spark, sf_dir):
    from ..functions import named_struct

    p = table(spark, sf_dir, "part").df
    return p.select(named_struct([F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand")]).alias("s")).select("s.key", "s.brand")


@register("replace_element", """
    SELECT p_partkey, array_to_string(list_concat(['X'], list_slice(string_split(p_name, ' '), 2, 1000000)), ' ') AS replaced
    FROM part
""")
def replace_element(spark, sf_dir):
    from ..functions import replace_array_element

    p = table(spark, sf_dir, "part").df
    return p.select("p_partkey", F.array_join(replace_array_element(F.split("p_name", " "), "X", 0), " ").alias("replaced"))


# ---------------------------------------------------------------------------
# choices


def _drift(spark, sf_dir) -> Frame:
    c = Frame(table(spark, sf_dir, "customer").df.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), "c")
    n = Frame(table(spark, sf_dir, "nation").df.select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name")), "n")
    return c.merge(n)


@register("merge_drift", """
    SELECT c_custkey AS key_long, CAST(NULL AS VARCHAR) AS key_string, c_name AS name FROM customer
    UNION ALL
    SELECT NULL AS key_long, CAST(n_nationkey AS VARCHAR) AS key_string, n_name AS name FROM nation
""")
def merge_drift(spark, sf_dir):
    f = _drift(spark, sf_dir)
    assert f.choices == {"key": ["long", "string"]}, f.choices
    return _flat(f.resolveChoice(choice="make_struct").toDF().select("key.long", "key.string", "name").toDF("key.long", "key.string", "name"))


_DRIFT_CAST = """
    SELECT c_custkey AS key, c_name AS name FROM customer
    UNION ALL
    SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name FROM nation
"""


@register("resolve_cast", _DRIFT_CAST)
def resolve_cast(spark, sf_dir):
    return _drift(spark, sf_dir).resolveChoice(specs=[("key", "cast:long")]).toDF()


@register("resolve_project", """
    SELECT CAST(NULL AS VARCHAR) AS key, c_name AS name FROM customer
    UNION ALL
    SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation
""")
def resolve_project(spark, sf_dir):
    from ..frame import ResolveOption

    return _drift(spark, sf_dir).toDF([ResolveOption("key", "Project", "string")])


@register("resolve_match_catalog", _DRIFT_CAST)
def resolve_match_catalog(spark, sf_dir):
    target = table(spark, sf_dir, "customer").df.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    target.createOrReplaceTempView("ff_drift_target")
    return _drift(spark, sf_dir).resolveChoice(choice="MATCH_CATALOG", table_name="ff_drift_target").toDF()


@register("json_drift", """
    SELECT event_id AS id,
           CASE WHEN event_type <> 'click' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k_long,
           CASE WHEN event_type = 'click' THEN CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) END AS k_string,
           event_type AS kind
    FROM events WHERE event_type <> 'error'
""")
def json_drift(spark, sf_dir):
    e = table(spark, sf_dir, "events").df
    k = F.get_json_object("props", "$.k")
    line = (F.when(F.col("event_type") == "error", F.lit("{bad"))
            .otherwise(F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"k":'),
                                F.when(F.col("event_type") == "click", F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k),
                                F.lit(',"kind":"'), F.col("event_type"), F.lit('"}'))))
    out = scratch_dir(spark, "drift-json")
    e.select(line.alias("value")).write.mode("overwrite").text(out)
    f = from_options(spark, "file", {"paths": [out]}, format="json")
    assert {k: sorted(v) for k, v in f.choices.items()} == {"k": ["long", "string"]}, f.choices
    df = f.toDF()
    return df.select("id", F.col("k.long").alias("k_long"), F.col("k.string").alias("k_string"), "kind")


@register("json_drift_errors", "SELECT count(*) AS n_errors FROM events WHERE event_type = 'error'")
def json_drift_errors(spark, sf_dir):
    e = table(spark, sf_dir, "events").df
    line = F.when(F.col("event_type") == "error", F.lit("{bad")).otherwise(F.to_json(F.struct("event_id", "props")))
    out = scratch_dir(spark, "drift-json-bad")
    e.select(line.alias("value")).write.mode("overwrite").text(out)
    f = from_options(spark, "file", {"paths": [out]}, format="json")
    return f.errorsAsFrame().toDF().agg(F.count(F.lit(1)).alias("n_errors"))


# ---------------------------------------------------------------------------
# row functions


_EVENTS_SCHEMA = "event_id bigint, user_id bigint, value double"


def _events_small(spark, sf_dir) -> Frame:
    return table(spark, sf_dir, "events").select_fields(["event_id", "user_id", "value"])


@register("map_python", "SELECT event_id, user_id, value * 2 AS value FROM events")
def map_python(spark, sf_dir):
    f = _events_small(spark, sf_dir).map(lambda r: {"event_id": r.event_id, "user_id": r.user_id, "value": r.value * 2},
                                         schema=_EVENTS_SCHEMA)
    return f.toDF()


@register("map_partitions", "SELECT event_id, user_id, value * 2 AS value FROM events")
def map_partitions(spark, sf_dir):
    def double(records):
        for r in records:
            yield {"event_id": r["event_id"], "user_id": r["user_id"], "value": r["value"] * 2}

    return _events_small(spark, sf_dir).mapPartitions(double, schema=_EVENTS_SCHEMA).toDF()


@register("map_index", "SELECT event_id, user_id, value * 3 AS value, true AS has_index FROM events")
def map_index(spark, sf_dir):
    def triple(index, records):
        for r in records:
            yield {"event_id": r["event_id"], "user_id": r["user_id"], "value": r["value"] * 3, "has_index": index >= 0}

    return _events_small(spark, sf_dir).mapPartitionsWithIndex(
        triple, schema=_EVENTS_SCHEMA + ", has_index boolean").toDF()


@register("map_errors", """
    SELECT 'good' AS kind, count(*) FILTER (WHERE CAST(json_extract(props, '$.k') AS BIGINT) <> 5) AS n FROM events
    UNION ALL
    SELECT 'error' AS kind, count(*) FILTER (WHERE CAST(json_extract(props, '$.k') AS BIGINT) = 5) AS n FROM events
""")
def map_errors(spark, sf_dir):
    import json as _json

    f = table(spark, sf_dir, "events").select_fields(["event_id", "props"])

    def ratio(r):
        k = _json.loads(r.props)["k"]
        return {"event_id": r.event_id, "ratio": 10 / (k - 5)}

    m = f.map(ratio, schema="event_id bigint, ratio double")
    good = m.toDF().select(F.lit("good").alias("kind"), F.lit(1).alias("one"))
    bad = m.errorsAsFrame().toDF().select(F.lit("error").alias("kind"), F.lit(1).alias("one"))
    counts = good.unionByName(bad).groupBy("kind").agg(F.count("one").alias("n"))
    kinds = spark.sql("SELECT * FROM VALUES ('good'), ('error') AS t(kind)")
    return kinds.join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("n"))


# ---------------------------------------------------------------------------
# partitions and collections

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@register("repartition", _ORDERS)
def repartition_query(spark, sf_dir):
    f = table(spark, sf_dir, "orders").repartition(16)
    assert f.getNumPartitions() == 16
    return f.toDF()


@register("coalesce", _ORDERS)
def coalesce_query(spark, sf_dir):
    return table(spark, sf_dir, "orders").coalesce(2).toDF()


def _people(spark, sf_dir) -> FrameSet:
    c = table(spark, sf_dir, "customer")
    c.name = "customer"
    s = table(spark, sf_dir, "supplier")
    s.name = "supplier"
    return FrameSet([c, s], spark)


_PEOPLE = """
    SELECT c_custkey AS key, c_name AS name FROM customer
    UNION ALL SELECT s_suppkey AS key, s_name AS name FROM supplier
"""


def _union(frames) -> DataFrame:
    out = None
    for f in frames:
        out = f.toDF() if out is None else out.unionByName(f.toDF())
    return out


@register("collection_map", _PEOPLE)
def collection_map(spark, sf_dir):
    keys = {"customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name")}

    def shape(frame, ctx):
        k, n = keys[frame.name]
        return frame.apply_mapping([(k, "key", "long"), (n, "name")], transformation_ctx=ctx)

    return _union(_people(spark, sf_dir).map(shape, "people").values())


@register("collection_flatmap", """
    SELECT c_custkey AS key, c_name AS name, 'rich' AS part FROM customer WHERE c_acctbal > 5000
    UNION ALL SELECT c_custkey, c_name, 'other' FROM customer WHERE NOT coalesce(c_acctbal > 5000, false)
    UNION ALL SELECT s_suppkey, s_name, 'rich' FROM supplier WHERE s_acctbal > 5000
    UNION ALL SELECT s_suppkey, s_name, 'other' FROM supplier WHERE NOT coalesce(s_acctbal > 5000, false)
""")
def collection_flatmap(spark, sf_dir):
    cols = {"customer": ("c_custkey", "c_name", "c_acctbal"), "supplier": ("s_suppkey", "s_name", "s_acctbal")}

    def split(frame, ctx):
        k, n, b = cols[frame.name]
        shaped = frame.apply_mapping([(k, "key", "long"), (n, "name"), (b, "bal")])
        return shaped.split_rows({"bal": {">": 5000}}, f"{frame.name}_rich", f"{frame.name}_other")

    parts = _people(spark, sf_dir).flatmap(split, "people")
    assert len(parts) == 4
    dfs = [f.drop_fields("bal").toDF().withColumn("part", F.lit(k.split("_")[-1])) for k, f in parts.items()]
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


@register("collection_select", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def collection_select(spark, sf_dir):
    people = _people(spark, sf_dir)
    missing = people.select("no_such_frame")
    assert missing.df.columns == [] and missing.name == "no_such_frame"
    return people.select("supplier").toDF()


# ---------------------------------------------------------------------------
# generation


def card_spec(rows) -> dict:
    return {"tables": [{
        "name": "card_dim_c", "rows": rows, "partitions": ["identifier_type"],
        "columns": [
            {"name": "card_id", "data_type": "Int", "column_type": "Sequential", "start": 0, "step": 1},
            {"name": "card_code", "column_type": "Expression", "expression": "concat('0000000000', card_id)"},
            {"name": "hshd_isba_market_code", "column_type": "Expression", "expression": "concat('isba', card_code)"},
            {"name": "identifier_type", "data_type": "String", "column_type": "Fixed", "value": "card_id"},
            {"name": "spend", "data_type": "Float", "column_type": "Expression", "expression": "card_id * 2 + 0.5"},
        ]}]}


@register("gen_deterministic", """
    SELECT CAST(i AS INTEGER) AS card_id, '0000000000' || i AS card_code, 'isba0000000000' || i AS hshd_isba_market_code,
           'card_id' AS identifier_type, CAST(i * 2 + 0.5 AS DOUBLE) AS spend
    FROM (SELECT row_number() OVER () - 1 AS i FROM customer)
""")
def gen_deterministic(spark, sf_dir):
    from .datagen import generate_and_write

    rows = table(spark, sf_dir, "customer").df.count()
    out = scratch_dir(spark, "gen")
    paths = generate_and_write(spark, card_spec(rows), out)
    return spark.read.parquet(paths["card_dim_c"]).select("card_id", "card_code", "hshd_isba_market_code", "identifier_type", "spend")


def gen_random(spark, sf_dir):
    from .datagen import generate_table

    rows = table(spark, sf_dir, "lineitem").df.count()
    spec = {"name": "transaction_item_fct_data", "rows": rows, "seed": 42, "columns": [
        {"name": "card_id", "data_type": "Int", "column_type": "Random", "min": 0, "max": 10},
        {"name": "item_cost", "data_type": "Float", "column_type": "Random", "min": 1, "max": 5, "decimal_places": 2},
        {"name": "item_qty", "data_type": "Int", "column_type": "Random", "min": 0, "max": 10},
        {"name": "spend_amt", "column_type": "Expression", "expression": "round(item_cost * item_qty, 2)"},
        {"name": "date_id", "data_type": "Date", "column_type": "Random", "min": "2017-01-01 21:16:30.924000", "max": "2018-01-01 20:10:10.924000"},
        {"name": "item_cd", "data_type": "Int", "column_type": "Random", "values": "1,0,2,"},
    ]}
    return generate_table(spark, spec)


# ---------------------------------------------------------------------------
# pages


def _pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").df


@register("page_links", """
    SELECT DISTINCT page_id, link FROM (
      SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
""")
def page_links_query(spark, sf_dir):
    from .pages import page_links

    return page_links(_pages(spark, sf_dir))


@register("page_top_links", """
    WITH items AS (
      SELECT page_id, list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: x <> '') AS items FROM pages),
    chosen AS (
      SELECT page_id, list_slice(list_filter(list_slice(items, 2, greatest(len(items), 1)), lambda x: NOT contains(x, ',')), 1, 3) AS c
      FROM items)
    SELECT page_id, CAST(generate_subscripts(c, 1) - 1 AS INTEGER) AS rank, unnest(c) AS link FROM chosen
""")
def page_top_links(spark, sf_dir):
    from .pages import top_links

    return top_links(_pages(spark, sf_dir), limit=4, offset=2, ok=lambda x: ~x.contains(","))


def _imgpt_pages(spark, sf_dir) -> DataFrame:
    p = _pages(spark, sf_dir)
    esc = lambda c: F.replace(c, F.lit("&"), F.lit("&amp;"))
    q = F.lit("&quot;")
    good = F.concat(F.lit('<a class="imgpt" m="{'), q, F.lit("murl"), q, F.lit(":"), q, esc(F.col("url")), q,
                    F.lit(","), q, F.lit("desc"), q, F.lit(":"), q, F.lit("page "), F.col("page_id").cast("string"), q,
                    F.lit(","), q, F.lit("purl"), q, F.lit(":"), q, esc(F.col("url")), q, F.lit('}" href="#">x</a>'))
    broken = F.concat(F.lit('<a class="imgpt" m="{'), q, F.lit("murl"), q, F.lit(':broken}" href="#">y</a>'))
    return p.select("page_id", F.concat(F.col("html"), good, broken).alias("html"))


@register("page_metadata", """
    SELECT page_id, 0 AS pos,
           regexp_extract(split_part(url, '?', 1), '[^.]*$') AS image_format,
           replace(split_part(url, '?', 1), ' ', '+') AS image_link,
           'page ' || page_id AS image_description, url AS image_host, url AS image_source
    FROM pages
""")
def page_metadata_query(spark, sf_dir):
    from .pages import page_metadata

    return page_metadata(_imgpt_pages(spark, sf_dir))


@register("page_tabs", """
    WITH w AS (
      SELECT page_id, generate_subscripts(ws, 1) - 1 AS pos, unnest(ws) AS word
      FROM (SELECT page_id, regexp_extract_all(html, 'href="/([^"]*)"', 1) AS ws FROM pages)),
    t AS (
      SELECT page_id, pos, replace('/search?q=' || word || ',g_1:' || word || '&amp;usg=z', '&amp;', '&') AS href FROM w),
    n AS (
      SELECT page_id, pos, href, replace(regexp_extract(href, ',g_1:([^:&]*)', 1), '+', ' ') AS name FROM t),
    stop AS (
      SELECT page_id, min(pos) AS first_stop FROM n
      WHERE length(name) > 100 OR name = 'background-color' GROUP BY page_id)
    SELECT n.page_id, name, CAST(min(pos) AS INTEGER) AS pos, arg_max('https://search.example' || href, pos) AS link
    FROM n LEFT JOIN stop ON n.page_id = stop.page_id
    WHERE stop.first_stop IS NULL OR pos < stop.first_stop
    GROUP BY n.page_id, name
""")
def page_tabs_query(spark, sf_dir):
    from .pages import page_tabs

    p = _pages(spark, sf_dir)
    words = F.regexp_extract_all("html", F.lit(r'href="/([^"]*)"'), 1)
    block = lambda w: F.concat(F.lit('<a class="dtviD" href="/search?q='), w, F.lit(",g_1:"), w, F.lit('&amp;usg=z">t</a>'))
    tabs = F.concat(F.array_join(F.transform(words, block), ""), block(F.lit("background-color")), block(F.lit("after")))
    return page_tabs(p.select("page_id", tabs.alias("html")), base_url="https://search.example")


@register("url_parts", """
    SELECT page_id,
           regexp_extract(url, '^([a-zA-Z]+://[^/?#:]+)', 1) AS referer,
           regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1) AS host,
           CASE WHEN contains(regexp_extract(split_part(url, '?', 1), '[^/]*$'), '.')
                THEN lower(regexp_extract(regexp_extract(split_part(url, '?', 1), '[^/]*$'), '[^.]*$'))
                ELSE '' END AS extension
    FROM pages
""")
def url_parts_query(spark, sf_dir):
    from .pages import url_parts

    return url_parts(_pages(spark, sf_dir))


@register("url_filter", """
    SELECT page_id, url FROM pages
    WHERE NOT contains(url, 'ref=') AND NOT contains(url, '#top')
      AND starts_with(url, 'http') AND NOT starts_with(url, 'https://m.')
""")
def url_filter_query(spark, sf_dir):
    from .pages import link_filter, url_filter

    p = _pages(spark, sf_dir)
    return p.where(url_filter(F.col("url"), ignore=["ref=", "#top"]) & link_filter(F.col("url"), "https://m.")).select("page_id", "url")


@register("url_extension_filter", """
    SELECT page_id, url FROM pages
    WHERE lower(regexp_extract(regexp_extract(split_part(url, '?', 1), '[^/]*$'), '[^.]*$')) IN ('html', 'htm')
      AND contains(regexp_extract(split_part(url, '?', 1), '[^/]*$'), '.')
""")
def url_extension_filter(spark, sf_dir):
    from .pages import url_filter

    p = _pages(spark, sf_dir)
    return p.where(url_filter(F.col("url"), formats=["html", "htm"])).select("page_id", "url")


@register("search_terms", """
    WITH k AS (SELECT DISTINCT p_type AS keyword FROM part),
    t AS (
      SELECT keyword, prefix, suffix, trim(prefix || ' ' || keyword || CASE WHEN suffix = '' THEN '' ELSE ' ' || suffix END) AS term
      FROM k, (VALUES ('best'), ('cheap')) p(prefix), (VALUES (''), ('price')) s(suffix))
    SELECT keyword, prefix, suffix, term, 'https://search.example/?q=' || replace(term, ' ', '%20') || '&form=x' AS search_url FROM t
""")
def search_terms_query(spark, sf_dir):
    from .pages import search_terms

    kw = table(spark, sf_dir, "part").df.select(F.col("p_type").alias("keyword")).distinct()
    return search_terms(kw, ["best", "cheap"], ["", "price"], "https://search.example/?q=", "&form=x")


@register("status_totals", """
    SELECT user_id, CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS n_ok,
           CAST(count(*) FILTER (WHERE NOT (event_type <> 'error')) AS BIGINT) AS n_failed
    FROM events GROUP BY ROLLUP (user_id)
""")
def status_totals_query(spark, sf_dir):
    from .pages import status_totals

    e = table(spark, sf_dir, "events").df
    return status_totals(e, "user_id", F.col("event_type") != "error")


@register("link_dedupe", """
    SELECT DISTINCT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS keyword, link FROM (
      SELECT url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
""")
def link_dedupe(spark, sf_dir):
    p = _pages(spark, sf_dir)
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    links = p.select(host.alias("keyword"), F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("link"))
    return links.dropDuplicates(["keyword", "link"])


# ---------------------------------------------------------------------------
# SQL after a frame


@register("sql_after_frame", ORACLES["priority_revenue"])
def sql_after_frame(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    joined = orders.join("o_orderkey", "l_orderkey", lines)
    joined.toDF().createOrReplaceTempView("ff_joined")
    return spark.sql("""
        SELECT o_orderpriority AS priority, count(*) AS n_lines,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(38,2)) AS revenue
        FROM ff_joined WHERE l_quantity > 25 GROUP BY o_orderpriority
    """)


@register("gen_random_bounds", """
    SELECT count(*) AS n, true AS cost_in_range, true AS qty_in_range, true AS date_in_range, true AS cd_in_set
    FROM lineitem
""")
def gen_random_bounds(spark, sf_dir):
    g = gen_random(spark, sf_dir)
    return g.agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min("item_cost") >= 1) & (F.max("item_cost") <= 5)
         & (F.max(F.abs(F.col("item_cost") - F.round("item_cost", 2))) == 0)).alias("cost_in_range"),
        ((F.min("item_qty") >= 0) & (F.max("item_qty") <= 10)).alias("qty_in_range"),
        ((F.min("date_id") >= "2017-01-01 21:16:30.924") & (F.max("date_id") < "2018-01-01 20:10:10.924")).alias("date_in_range"),
        F.coalesce(F.bool_and(F.col("item_cd").isin(0, 1, 2)), F.lit(True)).alias("cd_in_set"))


UNIFORM = "CAST('0x' || substr(md5('{seed}/' || l_orderkey || '/' || l_linenumber), 1, 13) AS BIGINT) / 4503599627370496.0"


@register("gen_beside_random", """
    WITH u AS (SELECT l_orderkey, l_linenumber, l_quantity, %s AS r0, %s AS r1, %s AS r2, %s AS r4 FROM lineitem)
    SELECT l_orderkey, l_linenumber, CAST(round(r0 * 10) AS INTEGER) AS card_id, round(r1 * 4 + 1, 2) AS item_cost,
           CAST(list_extract(['1', '0', '2'], CAST(floor(r2 * 3) AS INTEGER) + 1) AS INTEGER) AS item_cd,
           round(round(r1 * 4 + 1, 2) * l_quantity, 2) AS spend_amt,
           strftime(make_timestamp(1483228800000000 + CAST(floor(r4 * 86400000000) AS BIGINT)), '%%Y-%%m-%%d') AS date_id
    FROM u
""" % tuple(UNIFORM.format(seed=42 + i) for i in (0, 1, 2, 4)))
def gen_beside_random(spark, sf_dir):
    from .datagen import generate_beside

    spec = {"name": "transactions", "seed": 42, "columns": [
        {"name": "card_id", "data_type": "Int", "column_type": "Random", "min": 0, "max": 10},
        {"name": "item_cost", "data_type": "Float", "column_type": "Random", "min": 1, "max": 5, "decimal_places": 2},
        {"name": "item_cd", "data_type": "Int", "column_type": "Random", "values": "1,0,2"},
        {"name": "spend_amt", "column_type": "Expression", "expression": "round(item_cost * l_quantity, 2)"},
        {"name": "date_id", "data_type": "Date", "column_type": "Random", "min": "2017-01-01 00:00:00", "max": "2017-01-02 00:00:00", "unit": "day"},
    ]}
    return generate_beside(table(spark, sf_dir, "lineitem").df, spec, ["l_orderkey", "l_linenumber"], "l_orderkey")


@register("gen_beside_sequence", """
    SELECT c_custkey, CAST(100 + 3 * c_custkey AS INTEGER) AS card_id, 'card_id' AS identifier_type, c_name || '/' || c_mktsegment AS label
    FROM customer
""")
def gen_beside_sequence(spark, sf_dir):
    from .datagen import generate_beside

    spec = {"name": "cards", "columns": [
        {"name": "card_id", "data_type": "Int", "column_type": "Sequential", "start": 100, "step": 3},
        {"name": "identifier_type", "column_type": "Fixed", "value": "card_id"},
        {"name": "label", "column_type": "Expression", "expression": "concat(c_name, '/', c_mktsegment)"},
    ]}
    return generate_beside(table(spark, sf_dir, "customer").df, spec, ["c_custkey"], "c_custkey")


# ---------------------------------------------------------------------------
# nothing is lost: good rows and error records of mixed inputs


def told(frame: Frame, value: str, record: str = "record") -> DataFrame:
    """(kind, value): a text for each good row, and for each error record."""
    good = frame.toDF().select(F.lit("good").alias("kind"), F.expr(value).cast("string").alias("value"))
    return good.unionByName(frame.errorsAsFrame().toDF().select(F.lit("error").alias("kind"), F.expr(record).cast("string").alias("value")))


def _text_files(df: DataFrame, column, label: str) -> str:
    """``df``'s text column as a folder of text files."""
    path = scratch_dir(df.sparkSession, label) + "/text"
    df.select(F.expr(column).alias("value")).write.mode("overwrite").text(path)
    return path


MIXED = """CASE WHEN p_partkey % 5 = 0 THEN concat('[', p_partkey, ',{"k":', p_partkey, '}]')
                WHEN p_partkey % 5 = 1 THEN '{bad'
                WHEN p_partkey % 5 = 2 THEN CAST(p_partkey AS STRING)
                WHEN p_partkey % 5 = 3 THEN concat('[{"k":', p_partkey, '},{"k":1}]')
                ELSE concat('{"k":', p_partkey, '}') END"""


@register("json_mixed_records", """
    SELECT 'good' AS kind, CAST(p_partkey AS VARCHAR) AS value FROM part WHERE p_partkey % 5 IN (0, 3, 4)
    UNION ALL SELECT 'good', '1' FROM part WHERE p_partkey % 5 = 3
    UNION ALL SELECT 'error', CASE p_partkey % 5 WHEN 1 THEN '{bad' ELSE CAST(p_partkey AS VARCHAR) END FROM part WHERE p_partkey % 5 IN (0, 1, 2)
""")
def json_mixed_records(spark, sf_dir):
    path = _text_files(table(spark, sf_dir, "part").df, MIXED, "json-mixed")
    return told(from_options(spark, "file", {"paths": [path]}, format="json"), "k")


@register("json_array_file", "SELECT c_custkey AS k, c_name AS n FROM customer")
def json_array_file(spark, sf_dir):
    c = table(spark, sf_dir, "customer").df.select(F.to_json(F.struct(F.col("c_custkey").alias("k"), F.col("c_name").alias("n"))).alias("j"),
                                                  F.expr("c_custkey div 50").alias("bucket"))
    # arrays over several lines, of 50 records each; a file holds many of them
    arrays = c.groupBy("bucket").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("j"), ",\n"), F.lit("\n]")).alias("value"))
    path = _text_files(arrays, "value", "json-array")
    return from_options(spark, "file", {"paths": [path]}, format="json", format_options={"multiline": True}).toDF().select("k", "n")


@register("json_schema_errors", """
    SELECT CASE WHEN p_partkey % 3 = 0 THEN 'error' ELSE 'good' END AS kind,
           CASE WHEN p_partkey % 3 = 0 THEN '{bad' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS value FROM part
""")
def json_schema_errors(spark, sf_dir):
    text = "CASE WHEN p_partkey % 3 = 0 THEN concat('{bad', p_partkey) ELSE concat('{\"k\":', p_partkey, '}') END"
    path = _text_files(table(spark, sf_dir, "part").df, text, "json-schema")
    return told(from_options(spark, "file", {"paths": [path]}, format="json", schema="k int"), "k")


@register("json_nested_mixed", """
    SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS as_long, CASE WHEN p_partkey % 2 = 0 THEN 'x' END AS as_string FROM part
""")
def json_nested_mixed(spark, sf_dir):
    text = "concat('{\"k\":', p_partkey, ',\"a\":[{\"b\":[', p_size, if(p_partkey % 2 = 0, ',\"x\"', ''), ']}]}')"
    path = _text_files(table(spark, sf_dir, "part").df, text, "json-nested")
    df = from_options(spark, "file", {"paths": [path]}, format="json").toDF()
    inner = F.get(F.get("a", F.lit(0))["b"], F.lit(0))["long"]
    other = F.get(F.get("a", F.lit(0))["b"], F.lit(1))["string"]
    return df.select(F.col("k").cast("int").alias("k"), inner.alias("as_long"), other.alias("as_string"))


@register("resolve_cast_in_array", """
    SELECT CASE WHEN p_partkey % 4 = 0 THEN 'error' ELSE 'good' END AS kind,
           CASE WHEN p_partkey % 4 = 0 THEN '{"a":[{"long":' || p_partkey || '},{"string":"zz"}]}' ELSE p_partkey || '+7' END AS value FROM part
""")
def resolve_cast_in_array(spark, sf_dir):
    text = "concat('{\"a\":[', p_partkey, ',', if(p_partkey % 4 = 0, '\"zz\"', '\"7\"'), ']}')"
    path = _text_files(table(spark, sf_dir, "part").df, text, "json-cast")
    return told(from_options(spark, "file", {"paths": [path]}, format="json").resolveChoice(specs=[("a", "cast:long")]), "array_join(a, '+')")


@register("merge_decimals", """
    SELECT 'good' AS kind, CAST(CAST(s_suppkey AS DECIMAL(7,2)) AS VARCHAR) AS value FROM supplier
    UNION ALL SELECT CASE WHEN o_totalprice < 100000 THEN 'good' ELSE 'error' END, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) FROM orders
""")
def merge_decimals(spark, sf_dir):
    left = table(spark, sf_dir, "supplier").df.select(F.col("s_suppkey").cast("decimal(7,2)").alias("x"))
    right = table(spark, sf_dir, "orders").df.select(F.col("o_totalprice").cast("decimal(12,2)").alias("x"))
    return told(Frame(left, "l").merge(Frame(right, "r")), "x", "cast(get_json_object(record, '$.x') AS decimal(12,2))")


@register("csv_errors", """
    SELECT CASE WHEN p_partkey % 7 = 0 THEN 'error' ELSE 'good' END AS kind,
           p_partkey || ',' || p_size || CASE WHEN p_partkey % 7 = 0 THEN ',5,6' ELSE '' END AS value FROM part
""")
def csv_errors(spark, sf_dir):
    text = "concat(p_partkey, ',', p_size, if(p_partkey % 7 = 0, ',5,6', ''))"
    path = _text_files(table(spark, sf_dir, "part").df, text, "csv-errors")
    return told(from_options(spark, "file", {"paths": [path]}, format="csv", schema="k int, n int"), "concat(k, ',', n)")


@register("unbox_csv_lines", """
    SELECT CASE WHEN p_partkey % 2 = 0 THEN 'error' ELSE 'good' END AS kind,
           CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE p_partkey || ':' || p_size END AS value FROM part
""")
def unbox_csv_lines(spark, sf_dir):
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"))
    boxed = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("a,b\n"), line, F.lit("\n"), line)).otherwise(F.concat(F.lit("a,b\n"), line))
    f = Frame(table(spark, sf_dir, "part").df.select("p_partkey", boxed.alias("box")), "boxed")
    return told(f.unbox("box", "csv", withHeader=True), "concat(box.a, ':', box.b)", "get_json_object(record, '$.p_partkey')")


@register("map_infer", """
    SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS as_string, CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS BIGINT) END AS as_long
    FROM customer
""")
def map_infer(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select_fields(["c_custkey", "c_name", "c_nationkey"])
    out = f.map(lambda r: {"k": r["c_custkey"], "v": r["c_name"] if r["c_custkey"] % 2 == 0 else r["c_nationkey"]}, infer=True)
    return out.toDF().select(F.col("k").cast("int").alias("k"), F.col("v.string").alias("as_string"), F.col("v.long").alias("as_long"))


# ---------------------------------------------------------------------------
# bookmarks, catalog, error counts, choices in mappings, keys, files


def _enabled(name):
    return name, {"job-bookmark-option": "job-bookmark-enable"}


@register("bookmark_partitioned", """
    SELECT event_id, event_type, 2 AS run FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, event_type, 1 FROM events WHERE event_type <> 'error'
""")
def bookmark_partitioned(spark, sf_dir):
    from ..sources.bookmark import Job

    e = table(spark, sf_dir, "events").df.select("event_id", "event_type")
    landing, out = scratch_dir(spark, "landing") + "/d", scratch_dir(spark, "runs")
    job = Job(spark, scratch_dir(spark, "ledger") + "/l")
    for run, part in ((1, e.where("event_type <> 'error'")), (2, e.where("event_type = 'error'"))):
        part.write.partitionBy("event_type").mode("append").parquet(landing)
        job.init(*_enabled("partitioned"))
        new = from_options(spark, "file", {"paths": [landing]}, format="parquet", transformation_ctx="src")
        new.toDF().withColumn("run", F.lit(run)).write.mode("append").parquet(out)
        job.commit()
    return spark.read.parquet(out).select("event_id", "event_type", "run")


@register("bookmark_rewritten_file", "SELECT c_custkey AS k, 2 AS version FROM customer")
def bookmark_rewritten_file(spark, sf_dir):
    import time

    from ..sources.bookmark import Job

    s = table(spark, sf_dir, "customer").df.select(F.col("c_custkey").alias("k"))
    path = scratch_dir(spark, "rewritten") + "/d"
    job = Job(spark, scratch_dir(spark, "ledger") + "/l")
    for version in (1, 2):
        s.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(path)
        job.init(*_enabled("rewritten"))
        seen = from_options(spark, "file", {"paths": [path]}, format="parquet", transformation_ctx="src").toDF()
        if version == 1:
            assert seen.where("version <> 1").isEmpty()
            job.commit()
            time.sleep(1.1)
    return seen


@register("catalog_write", "SELECT c_custkey AS a, c_nationkey AS b FROM customer UNION ALL SELECT c_custkey, c_nationkey FROM customer")
def catalog_write(spark, sf_dir):
    import uuid

    from ..sources.sinks import write_to_catalog

    c = table(spark, sf_dir, "customer").df
    name = f"ff_catalog_{uuid.uuid4().hex}"
    write_to_catalog(Frame(c.select(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("b")), "c"), table_name=name)
    write_to_catalog(Frame(c.select(F.col("c_nationkey").alias("b"), F.col("c_custkey").alias("a")), "c"), table_name=name)
    return spark.table(name)


def _half_bad(spark, sf_dir):
    """Parts whose label is a number for odd keys only."""
    p = table(spark, sf_dir, "part").df
    label = F.when(F.col("p_partkey") % 2 == 1, F.col("p_partkey").cast("string")).otherwise(F.col("p_name"))
    return Frame(p.select("p_partkey", label.alias("label")), "part").apply_mapping([("p_partkey", "k"), ("label", "n", "int")])


BAD_LABELS = "count(*) FILTER (WHERE p_partkey % 2 = 0)"


@register("mapping_both_sides", """
    SELECT CASE WHEN p_partkey % 2 = 0 THEN 'error' ELSE 'good' END AS kind,
           CASE WHEN p_partkey % 2 = 0 THEN p_partkey || ' ' || p_name ELSE CAST(p_partkey AS VARCHAR) END AS value FROM part
""")
def mapping_both_sides(spark, sf_dir):
    return told(_half_bad(spark, sf_dir), "n", "concat(get_json_object(record, '$.p_partkey'), ' ', get_json_object(record, '$.label'))")


@register("errors_total", f"SELECT 'total' AS what, {BAD_LABELS} AS n FROM part")
def errors_total(spark, sf_dir):
    halves = _half_bad(spark, sf_dir).split_rows({"k": {">": 50}}, "high", "low")
    joined = halves["high"].join("k", "k", halves["low"])  # two frames with one history: errors count once
    return spark.range(1).select(F.lit("total").alias("what"), F.lit(joined.errorsCount()).cast("long").alias("n"))


@register("errors_stage", f"SELECT 'stage' AS what, {BAD_LABELS} AS n FROM part")
def errors_stage(spark, sf_dir):
    return spark.range(1).select(F.lit("stage").alias("what"), F.lit(_half_bad(spark, sf_dir).stageErrorsCount()).cast("long").alias("n"))


@register("error_threshold", f"SELECT {BAD_LABELS} >= 3 AS raised FROM part")
def error_threshold(spark, sf_dir):
    from ..errors import ErrorThresholdExceeded

    p = table(spark, sf_dir, "part").df
    label = F.when(F.col("p_partkey") % 2 == 1, F.col("p_partkey").cast("string")).otherwise(F.col("p_name"))
    f = Frame(p.select(label.alias("label")), "part").apply_mapping([("label", "n", "int")], stageThreshold=3)
    try:
        f.assertErrorThreshold()
        raised = False
    except ErrorThresholdExceeded:
        raised = True
    return spark.range(1).select(F.lit(raised).alias("raised"))


@register("mapping_choice", """
    SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS INTEGER) END AS n FROM part
""")
def mapping_choice(spark, sf_dir):
    text = "concat('{\"k\":', p_partkey, ',\"v\":', if(p_partkey % 2 = 0, CAST(p_size AS STRING), concat('\"', p_brand, '\"')), '}')"
    path = _text_files(table(spark, sf_dir, "part").df, text, "json-choice")
    f = from_options(spark, "file", {"paths": [path]}, format="json")
    return f.apply_mapping([("k", "long", "k", "int"), ("v", "long", "n", "int")]).toDF()


@register("mapping_array", """
    SELECT l_orderkey AS k, CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS n FROM lineitem GROUP BY l_orderkey
""")
def mapping_array(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").df.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.col("l_quantity").alias("qty"))).alias("lines"))
    f = Frame(lines, "orders").apply_mapping([("l_orderkey", "k"), ("lines.no", "items.number"), ("lines.qty", "items.amount", "long")])
    return f.toDF().select("k", F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["amount"]).alias("qty"),
                           F.size("items").cast("long").alias("n"))


@register("relationalize_key", """
    SELECT s_suppkey AS child, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_name END AS a, CASE WHEN s_suppkey % 2 = 0 THEN s_name || '|x' END AS b
    FROM supplier
""")
def relationalize_key(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").df
    even = F.col("s_suppkey") % 2 == 0
    df = s.select(F.when(~even, F.col("s_name")).alias("a"), F.when(even, F.concat("s_name", F.lit("|x"))).alias("b"),
                  F.array("s_suppkey").alias("xs"))
    tables = Frame(df, "t").relationalize("r", options={"key": ["a", "b"]})
    root, child = tables["r"].toDF(), tables["r_xs"].toDF()
    return child.join(root, child["id"] == root["xs"]).select(F.col("`xs.val`").alias("child"), "a", "b")


@register("search_url_quoting", """
    SELECT p_partkey AS k, 'https://s.example/?q=' || replace(p_type, ' ', '%20') || '/%2A~' || (p_partkey % 10) AS url FROM part
""")
def search_url_quoting(spark, sf_dir):
    from ..functions.urls import search_url

    p = table(spark, sf_dir, "part").df
    term = F.concat("p_type", F.lit("/*~"), (F.col("p_partkey") % 10).cast("string"))
    return p.select(F.col("p_partkey").alias("k"), search_url(term, "https://s.example/?q=").alias("url"))


@register("spigot_sample", """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE CAST('0x' || substr(md5('11/{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}'), 1, 13) AS BIGINT) < 0.25 * 4503599627370496
""")
def spigot_sample(spark, sf_dir):
    path = scratch_dir(spark, "spigot") + "/sample"
    table(spark, sf_dir, "customer").select_fields(["c_custkey", "c_mktsegment"]).spigot(path, {"prob": 0.25, "seed": 11})
    return spark.read.schema("c_custkey long, c_mktsegment string").json(path)


@register("stream_incremental", ORACLES["bookmark_incremental"])
def stream_incremental(spark, sf_dir):
    from ..streaming.incremental import run_incremental

    events = table(spark, sf_dir, "events").df.select("event_id", "user_id", "event_type")
    half = events.agg(F.max("event_id")).collect()[0][0] / 2
    landing, out, state = (scratch_dir(spark, x) + "/d" for x in ("landing", "streamed", "state"))

    def keep(run):
        return lambda frame, _batch: frame.toDF().withColumn("run", F.lit(run)).write.mode("append").parquet(out)

    for run, part in ((1, events.where(F.col("event_id") <= half)), (2, events.where(F.col("event_id") > half))):
        part.write.mode("append").parquet(landing)
        run_incremental(spark, landing, "parquet", events.schema, "events", keep(run), checkpoint_root=state)
    return spark.read.parquet(out)


from . import accounts  # noqa: E402,F401  registers its queries
