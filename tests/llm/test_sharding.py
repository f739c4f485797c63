import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from flexframe.llm import sharding

from .conftest import EDGES, SF


def check(rows, texts, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.grown_shard in (r.shard, shards) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_contract(spark, docs):
    rows = sharding.assign(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    check(rows, docs, 40)


def test_balance_growth_and_slots_over_groups(spark):
    df = spark.range(200_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    out = sharding.assign(df).cache()
    per = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(per) == 40 and max(per) < 1.1 * 5000 and min(per) > 0.9 * 5000
    moved = out.where("grown_shard != shard")
    assert 0.8 * 200_000 / 41 < moved.count() < 1.2 * 200_000 / 41
    assert moved.where("grown_shard != 40").count() == 0
    worst = out.groupBy("shard").agg(F.countDistinct("slot").alias("d"), F.count("*").alias("n"), F.max("slot").alias("m"))
    assert worst.where("d != n or m != n - 1").count() == 0


def test_place_depends_on_the_id_alone(spark, docs):
    a = sharding.assign(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "shard")
    b = sharding.assign(spark.createDataFrame([(i, "other") for i, _ in docs[:50]], "doc_id long, text string")).select("doc_id", "shard")
    assert set(map(tuple, b.collect())) <= set(map(tuple, a.collect()))


def test_growth_within_a_rack_stays_in_its_subtree(spark):
    old = sharding.tree(40)
    new = sharding.grow(old, region="region1", rack="rack0")
    key = F.col("id").cast("string")
    df = sharding.place(sharding.place(spark.range(50_000), old, "a", key), new, "b", key)
    inside = set(old["region1"]["rack0"]) | set(old["region1"]["rack1"]) | {40}
    moved = df.where("a != b").select("b").distinct()
    assert {r.b for r in moved.collect()} <= inside


def test_edges(spark, edges, empty):
    check(sharding.assign(edges).collect(), EDGES, 40)
    assert sharding.assign(empty).count() == 0


def test_draws_are_recomputed(spark):
    """The descent, draw by draw, in plain Python."""
    import hashlib
    import math

    layout = {"a": {"x": {0: 1.0, 1: 3.0}, "y": {2: 0.5}}, "b": {"z": {3: 2.0, 4: 1.0}}}

    def choose(key, children):  # (path, weight, number)
        def draw(path, weight):
            bits = int(hashlib.md5(f"{key}/{path}".encode()).hexdigest()[:13], 16)
            return math.log((bits + 0.5) / 2 ** 52) / weight
        return max((draw(p, w), n) for p, w, n in children)[1]

    def leaf(key):
        regions = sorted(layout)
        a = regions[choose(key, [(r, sum(w for x in layout[r].values() for w in x.values()), i) for i, r in enumerate(regions)])]
        racks = sorted(layout[a])
        b = racks[choose(key, [(f"{a}/{r}", sum(layout[a][r].values()), i) for i, r in enumerate(racks)])]
        return choose(key, [(f"{a}/{b}/{s}", w, s) for s, w in sorted(layout[a][b].items())])

    df = sharding.place(spark.range(500), layout, "shard", F.col("id").cast("string"))
    assert {r.id: r.shard for r in df.collect()} == {i: leaf(str(i)) for i in range(500)}


def test_a_third_of_all_rows_is_one_row(spark):
    texts = [(7, "same")] * 3000 + [(i, f"t{i}") for i in range(6000)] + [(None, None)] * 5
    check(sharding.assign(spark.createDataFrame(texts, "doc_id long, text string").repartition(6)).collect(), texts, 40)
