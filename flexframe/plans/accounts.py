"""Queries in which nothing is lost: every good row and every error record of mixed inputs, and what later runs see.

Inputs in text form are built from the given tables; the job is what follows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..frame import Frame
from ..session import scratch_dir
from ..sources.readers import from_options
from .registry import _enabled, _text_files, register, table, told


def _json(spark, path: str, **options) -> Frame:
    return from_options(spark, "file", {"paths": [path]}, format="json", format_options=options)


@register("json_concatenated", "SELECT c_custkey AS k, c_name AS n FROM customer UNION ALL SELECT -c_custkey, c_name FROM customer")
def json_concatenated(spark, sf_dir):
    text = """concat('{"k":', c_custkey, ',"n":"', c_name, '"}{"k":', -c_custkey, ',"n":"', c_name, '"}')"""
    return _json(spark, _text_files(table(spark, sf_dir, "customer").df, text, "json-two")).toDF().select("k", "n")


@register("json_trailing", """
    SELECT 'good' AS kind, CAST(p_partkey AS VARCHAR) AS value FROM part
    UNION ALL SELECT 'error', 'rest ' || p_partkey || '} of it' FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT 'error', '{"open": [' || p_partkey FROM part WHERE p_partkey % 3 = 1
""")
def json_trailing(spark, sf_dir):
    text = """concat('{"k":', p_partkey, '}', CASE p_partkey % 3 WHEN 0 THEN concat(' rest ', p_partkey, '} of it')
                                                             WHEN 1 THEN concat('{"open": [', p_partkey) ELSE '' END)"""
    return told(_json(spark, _text_files(table(spark, sf_dir, "part").df, text, "json-rest")), "k")


@register("json_multiline_values", """
    SELECT 'good' AS kind, o_orderkey || ' ' || o_orderpriority AS value FROM orders
    UNION ALL SELECT 'error', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 5 = 0
""")
def json_multiline_values(spark, sf_dir):
    # values over several lines, some as elements of arrays, with numbers between them that are no records
    value = """concat('{\n  "k": ', o_orderkey, ',\n  "p": {\n    "name": "', o_orderpriority, '"\n  }\n}')"""
    text = f"CASE o_orderkey % 5 WHEN 0 THEN concat({value}, ' ', o_orderkey) WHEN 1 THEN concat('[', {value}, '\n]') ELSE {value} END"
    path = _text_files(table(spark, sf_dir, "orders").df, text, "json-lines")
    return told(_json(spark, path, multiline=True), "concat(k, ' ', p.name)")


@register("json_id_names", "SELECT c_custkey AS k, 'id' || c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation FROM customer")
def json_id_names(spark, sf_dir):
    text = """concat('{"k":', c_custkey, ',"by":{"id', c_custkey, '":{"nation":', c_nationkey, '}}}')"""
    f = _json(spark, _text_files(table(spark, sf_dir, "customer").df, text, "json-ids"), maxFields=50)
    return f.toDF().select("k", F.explode("by").alias("id", "v")).select("k", "id", F.col("v.nation").alias("nation"))


@register("json_case_names", "SELECT CAST(p_partkey AS BIGINT) AS lower_k, CAST(p_size AS BIGINT) AS upper_k FROM part")
def json_case_names(spark, sf_dir):
    text = """concat('{"k":', p_partkey, ',"K":', p_size, '}')"""
    f = _json(spark, _text_files(table(spark, sf_dir, "part").df, text, "json-case"))
    return f.toDF().select(F.col("k_2").alias("lower_k"), F.col("K").alias("upper_k"))


@register("frame_schema_errors", """
    SELECT CASE WHEN p_partkey % 4 = 0 THEN 'error' ELSE 'good' END AS kind, CAST(p_partkey AS VARCHAR) AS value FROM part
""")
def frame_schema_errors(spark, sf_dir):
    p = table(spark, sf_dir, "part").df
    label = F.when(F.col("p_partkey") % 4 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    f = Frame(p.select("p_partkey", F.struct(label.alias("size")).alias("s")), "part").with_frame_schema("p_partkey long, s struct<size:int>")
    return told(f, "if(s.size IS NULL, NULL, p_partkey)", "get_json_object(record, '$.p_partkey')")


@register("map_partitions_errors", """
    SELECT 'good' AS kind, CAST(c_custkey AS VARCHAR) AS value FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT 'error', CASE c_custkey % 4 WHEN 1 THEN 'result does not fit the output schema'
                                   WHEN 2 THEN 'fields not in the output schema: [''extra'']' ELSE 'refused ' || c_custkey END
    FROM customer WHERE c_custkey % 4 <> 0
""")
def map_partitions_errors(spark, sf_dir):
    def run(records):
        for r in records:
            k = r["c_custkey"]
            yield [{"c_custkey": k}, {"c_custkey": f"number {k}"}, {"c_custkey": k, "extra": 1}, {"isError": True, "errorMessage": f"refused {k}"}][k % 4]

    f = table(spark, sf_dir, "customer").select_fields(["c_custkey"]).mapPartitions(run)
    return told(f, "c_custkey", "message")


@register("unbox_csv_quoted", """
    SELECT 'good' AS kind, c_custkey || '|' || c_name || ', "' || c_mktsegment || '"' || chr(10) || 'x' AS value FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL SELECT 'error', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0
""")
def unbox_csv_quoted(spark, sf_dir):
    # a quoted name with a separator, values with quotes and line ends; every third text has an open quote
    text = F.expr("""concat('"name, full",key\n"', c_name, ', ""', c_mktsegment, '""\nx"', if(c_custkey % 3 = 0, ',"', ','), c_custkey)""")
    f = Frame(table(spark, sf_dir, "customer").df.select("c_custkey", text.alias("box")), "boxed").unbox("box", "csv", withHeader=True)
    return told(f, "concat(box.key, '|', box.`name, full`)", "get_json_object(record, '$.c_custkey')")


@register("unnest_clash", "SELECT c_custkey AS k, c_name AS plain, c_mktsegment AS nested FROM customer")
def unnest_clash(spark, sf_dir):
    c = table(spark, sf_dir, "customer").df
    f = Frame(c.select("c_custkey", F.col("c_name").alias("a.b"), F.struct(F.col("c_mktsegment").alias("b")).alias("a")), "c").unnest()
    return f.toDF().select(F.col("c_custkey").alias("k"), F.col("`a.b`").alias("plain"), F.col("`a.b_2`").alias("nested"))


@register("threshold_single_pass", """
    SELECT CASE WHEN c_custkey % 10 = 0 THEN 'error' ELSE 'good' END AS kind, CAST(c_custkey AS VARCHAR) AS value,
           (SELECT count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS n_errors FROM customer
""")
def threshold_single_pass(spark, sf_dir):
    def tenth(r):
        if r["c_custkey"] % 10 == 0:
            raise RuntimeError("tenth")
        return {"c_custkey": r["c_custkey"]}

    f = table(spark, sf_dir, "customer").select_fields(["c_custkey"]).map(tenth, stageThreshold=1 << 40)
    out = scratch_dir(spark, "thresholds") + "/out"
    f.write("file", {"path": out, "mode": "overwrite"}, "parquet")  # the errors were counted as the function ran
    written = Frame(spark.read.parquet(out), "out", f.errors)
    return told(written, "c_custkey", "get_json_object(record, '$.c_custkey')").withColumn("n_errors", F.lit(f.errorsCount()).cast("long"))


@register("rename_out_of_array", """
    SELECT l_orderkey AS k, CAST(sum(l_linenumber) AS BIGINT) AS numbers, CAST(sum(l_quantity) AS BIGINT) AS amounts FROM lineitem GROUP BY l_orderkey
""")
def rename_out_of_array(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").df.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.struct(F.col("l_quantity").alias("qty")).alias("of"))).alias("lines"))
    f = Frame(lines, "orders").rename_field("lines.of.qty", "totals.amounts")
    assert f.toDF().schema.simpleString() == "struct<l_orderkey:bigint,lines:array<struct<no:int>>,totals:struct<amounts:array<double>>>"
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return f.toDF().select(F.col("l_orderkey").alias("k"), total(F.transform("lines", lambda x: x["no"])).alias("numbers"),
                           total("totals.amounts").alias("amounts"))


# ---------------------------------------------------------------------------
# bookmarks and streams


@register("bookmark_two_ctx", """
    SELECT ctx, run, k FROM (SELECT c_custkey AS k FROM customer) JOIN (VALUES ('left', 2), ('right', 2)) AS t(ctx, run) ON true
    UNION ALL SELECT ctx, run, k FROM (SELECT s_suppkey AS k FROM supplier) JOIN (VALUES ('left', 4), ('right', 4)) AS t(ctx, run) ON true
""")
def bookmark_two_ctx(spark, sf_dir):
    from ..sources.bookmark import Job

    landing, out = scratch_dir(spark, "landing") + "/d", scratch_dir(spark, "runs")
    ledger = scratch_dir(spark, "ledger") + "/l"
    customers = table(spark, sf_dir, "customer").df.select(F.col("c_custkey").cast("long").alias("k"))
    suppliers = table(spark, sf_dir, "supplier").df.select(F.col("s_suppkey").cast("long").alias("k"))
    customers.write.parquet(landing)
    # run 1 ends without a commit, so neither ctx has read anything; run 3 finds nothing new
    for run, commit in ((1, False), (2, True), (3, True), (4, True)):
        if run == 4:
            suppliers.write.mode("append").parquet(landing)
        job = Job(spark, ledger).init(*_enabled("two"))
        for ctx in ("left", "right"):
            new = from_options(spark, "file", {"paths": [landing]}, format="parquet", transformation_ctx=ctx).toDF()
            if commit:
                new.select(F.lit(ctx).alias("ctx"), F.lit(run).alias("run"), "k").write.mode("append").parquet(out)
        if commit:
            job.commit()
    return spark.read.parquet(out).select("ctx", "run", "k")


def _drifting(spark, sf_dir, landing: str):
    """Two batches of JSON lines in a landing folder: numbers, then texts, under one name."""
    c = table(spark, sf_dir, "customer").df
    first = c.where("c_custkey % 2 = 0").select(F.expr("""concat('{"k":', c_custkey, ',"v":', c_nationkey, '}')""").alias("value"))
    second = c.where("c_custkey % 2 = 1").select(F.expr("""concat('{"k":', c_custkey, ',"v":"', c_name, '"}')""").alias("value"))
    for batch in (first, second):
        batch.write.mode("append").text(landing)
        yield


@register("bookmark_schema_grows", """
    SELECT CAST(c_custkey AS BIGINT) AS k, CAST(NULL AS BIGINT) AS as_long, c_name AS as_string FROM customer WHERE c_custkey % 2 = 1
""")
def bookmark_schema_grows(spark, sf_dir):
    from ..sources.bookmark import Job

    landing = scratch_dir(spark, "landing") + "/d"
    ledger = scratch_dir(spark, "ledger") + "/l"
    for _ in _drifting(spark, sf_dir, landing):
        job = Job(spark, ledger).init(*_enabled("grows"))
        f = from_options(spark, "file", {"paths": [landing]}, format="json", transformation_ctx="src")
        job.commit()
    # the second run read the new lines only, under the type of both runs
    return f.toDF().select("k", F.col("v.long").alias("as_long"), F.col("v.string").alias("as_string"))


@register("stream_drifting_json", """
    SELECT CAST(c_custkey AS BIGINT) AS k, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE c_name END AS v,
           CASE WHEN c_custkey % 2 = 0 THEN 'bigint' ELSE 'struct<long:bigint,string:string>' END AS type FROM customer
""")
def stream_drifting_json(spark, sf_dir):
    from ..streaming.incremental import run_incremental

    landing, out, state = (scratch_dir(spark, x) + "/d" for x in ("landing", "streamed", "state"))

    def keep(frame, _batch):
        df = frame.toDF()
        kind = df.schema["v"].dataType.simpleString()
        v = F.coalesce(F.col("v.long").cast("string"), F.col("v.string")) if frame.choices else F.col("v").cast("string")
        df.select("k", v.alias("v"), F.lit(kind).alias("type")).write.mode("append").parquet(out)

    for _ in _drifting(spark, sf_dir, landing):
        run_incremental(spark, landing, "json", None, "drifting", keep, checkpoint_root=state)
    return spark.read.parquet(out).select("k", "v", "type")


# ---------------------------------------------------------------------------
# samples, row numbers, hot keys, whole generator jobs, references, frames


_DRAW = """CAST('0x' || substr(md5('7/{"p_partkey":' || p_partkey || ',"p_brand":"' || p_brand || '"}'), 1, 13) AS BIGINT)"""


@register("spigot_prob", f"SELECT p_partkey, p_brand FROM part WHERE {_DRAW} < 0.3 * 4503599627370496")
def spigot_prob(spark, sf_dir):
    return _sampled(spark, sf_dir, prob=0.3)


@register("spigot_topk", f"SELECT p_partkey, p_brand FROM part ORDER BY {_DRAW} LIMIT 25")
def spigot_topk(spark, sf_dir):
    return _sampled(spark, sf_dir, topk=25)


def _sampled(spark, sf_dir, **options):
    path = scratch_dir(spark, "spigot") + "/sample"
    table(spark, sf_dir, "part").select_fields(["p_partkey", "p_brand"]).spigot(path, options)
    return spark.read.schema("p_partkey long, p_brand string").json(path)


@register("row_numbers", "SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS n, true AS known FROM lineitem")
def row_numbers(spark, sf_dir):
    from ..functions import with_row_numbers

    return with_row_numbers(table(spark, sf_dir, "lineitem").df.select("l_orderkey"), "n").select("n", F.col("l_orderkey").isNotNull().alias("known"))


@register("join_hot_key", """
    SELECT l.k, l.line, p_name AS name FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS k, l_orderkey * 10 + l_linenumber AS line FROM lineitem) AS l
    JOIN part ON p_partkey = l.k
""")
def join_hot_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").df.select(
        F.expr("if(l_orderkey % 3 = 0, 1, l_partkey)").alias("k"), F.expr("l_orderkey * 10 + l_linenumber").alias("line"))
    parts = table(spark, sf_dir, "part").df.select("p_partkey", F.col("p_name").alias("name"))
    return Frame(lines, "lines").join("k", "p_partkey", Frame(parts, "parts"), spread=16).toDF().select("k", "line", "name")


@register("gen_job_beside", """
    SELECT c_custkey, CAST(c_custkey * 2 AS INTEGER) AS card_id, 'isba' || c_name AS code, c_mktsegment AS segment FROM customer
""")
def gen_job_beside(spark, sf_dir):
    from .datagen import generate_and_write

    spec = {"tables": [{"name": "cards", "beside": f"{sf_dir}/customer.parquet", "keys": ["c_custkey"], "row": "c_custkey", "partitions": ["segment"], "columns": [
        {"name": "card_id", "data_type": "Int", "column_type": "Sequential", "start": 0, "step": 2},
        {"name": "code", "column_type": "Expression", "expression": "concat('isba', c_name)"},
        {"name": "segment", "column_type": "Expression", "expression": "c_mktsegment"},
    ]}]}
    paths = generate_and_write(spark, spec, scratch_dir(spark, "gen"))
    return spark.read.parquet(paths["cards"]).select("c_custkey", "card_id", "code", "segment")


@register("character_references", """
    SELECT p_partkey AS k, chr(CAST(161 + p_partkey % 500 AS INTEGER)) || '©' || p_partkey || '–é &unknown; ¬it; &lt;' || p_name AS text FROM part
""")
def character_references(spark, sf_dir):
    from .pages import unescape

    text = F.expr("""concat('&#', repeat('0', int(p_partkey % 30)), 161 + p_partkey % 500, if(p_partkey % 2 = 0, ';', ''), '&copy', p_partkey,
                            '&#150;&#xE9; &unknown; &notit; &amp;lt;', p_name)""")
    return table(spark, sf_dir, "part").df.select(F.col("p_partkey").alias("k"), unescape(text).alias("text"))


@register("registered_udf", "SELECT c_custkey, upper(c_name) || '!' AS shout FROM customer")
def registered_udf(spark, sf_dir):
    # a user's function under a name, used in SQL over a frame
    spark.udf.register("ff_shout", lambda s: None if s is None else s.upper() + "!", "string")
    table(spark, sf_dir, "customer").toDF().createOrReplaceTempView("ff_customer")
    return spark.sql("SELECT c_custkey, ff_shout(c_name) AS shout FROM ff_customer")


_SIZES = {"customer": 5, "lineitem": 11, "orders": 6, "part": 6, "supplier": 4, "events": 6}


@register("frame_sizes", " UNION ALL ".join(f"SELECT '{n}' AS name, CAST({k} AS INTEGER) AS n_columns, count(*) AS n_rows FROM {n}" for n, k in _SIZES.items()))
def frame_sizes(spark, sf_dir):
    rows = [(n, len(f.schema().fields), f.count()) for n, f in ((n, table(spark, sf_dir, n)) for n in _SIZES)]
    return spark.createDataFrame(rows, "name string, n_columns int, n_rows long")
