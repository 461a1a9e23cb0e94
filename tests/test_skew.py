"""The balanced paths: one key owns a third of the rows or more."""

import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import replay, rules, skew
from tallymark.sources import adapter

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def tight(monkeypatch):
    """Thresholds so low that small tables take the paths of large ones."""
    monkeypatch.setattr(skew, "HOT_ROWS", 40)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)


def skewed(spark, n=6_000, seed=1, ties=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 7 if rng.random() < 0.4 else rng.randrange(300)
        rows.append((i, key, rng.randrange(3 if ties else n), rng.choice("abc")))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id bigint, k bigint, t bigint, v string").repartition(5)


def test_hot_keys_finds_the_heavy_key(spark):
    _, df = skewed(spark)
    hot = skew.hot_keys(df, ["k"], floor=100)
    expected = df.where("k = 7").select(skew.key_hash(["k"])).first()[0]
    assert list(hot.pieces) == [expected] and hot.pieces[expected] > 4
    assert not skew.hot_keys(df, ["id"], floor=100)


@pytest.mark.parametrize("ties", [False, True])
def test_lag_of_a_heavy_group(spark, ties):
    rows, df = skewed(spark, ties=ties)
    hot = skew.hot_keys(df, ["k"], floor=100)
    assert hot
    got = {r["id"]: r["p"] for r in skew.lag_in_group(df, "k", ("t", "id"), "v", "p", hot=hot).collect()}
    last, want = {}, {}
    for id, key, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        want[id] = last.get(key)
        last[key] = v
    assert got == want


def test_lag_among_whole_row_copies(spark):
    rows = [(i, 7, i, "abc"[i % 3]) for i in range(500)] + [(250, 7, 250, "b")] * 3_000 + [(i, i, 0, "x") for i in range(600, 1_600)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "id bigint, k bigint, t bigint, v string").repartition(5)
    hot = skew.hot_keys(df, ["k"], floor=100)
    assert hot
    last, want = {}, []
    for id, key, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        want.append((id, key, t, v, last.get(key)))
        last[key] = v
    got = [tuple(r) for r in skew.lag_in_group(df, "k", ("t", "id"), "v", "p", hot=hot).collect()]
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def test_heavy_group_is_cut_in_even_ranges(spark):
    _, df = skewed(spark, 20_000, ties=True)
    hot = skew.hot_keys(df, ["k"], floor=100)
    sizes = [r["count"] for r in skew.with_hot_segments(df, "k", ("t", "id"), hot).where("k = 7").groupBy("_segment").count().collect()]
    assert len(sizes) > 50 and max(sizes) < 0.1 * sum(sizes)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, how):
    _, df = skewed(spark)
    lookup = spark.range(0, 300, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    lookup = lookup.unionByName(spark.createDataFrame([(7, 70)], "k bigint, x bigint"))
    salted = skew.lookup_join(df, lookup, ["k"], how, hot=skew.hot_keys(df, ["k"], floor=100), broadcast_rows=0)
    plain = df.join(lookup, "k", how)
    assert sorted(salted.select(plain.columns).collect()) == sorted(plain.collect())
    plan = salted._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_join_refuses_keys_of_different_types(spark):
    with pytest.raises(TypeError):
        skew.lookup_join(spark.range(3), spark.createDataFrame([(1,)], "id int"), ["id"])


def test_group_minimum(spark):
    rows, df = skewed(spark)
    want = {}
    for id, key, *_ in rows:
        want[key] = min(id, want.get(key, id))
    for floor in (100, 10**6):
        hot = skew.hot_keys(df, ["k"], floor=floor)
        got = skew.group_minimum(df, ["k"], "id", "m", hot=hot).select("id", "k", "m").collect()
        assert len(got) == len(rows) and all(r["m"] == want[r["k"]] for r in got)


@pytest.mark.parametrize("pieces", [1, 4, 64])
def test_numbering_and_running_totals(spark, pieces):
    rows, df = skewed(spark, 3_000, ties=True)
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    got = {r["id"]: r["n"] for r in skew.dense_number(df, ["t", "id"], "n", pieces=pieces).collect()}
    assert got == {r[0]: i for i, r in enumerate(ordered, 1)}
    total, want = 0, {}
    for r in ordered:
        want[r[0]] = total
        total += r[1]
    assert {r["id"]: r["s"] for r in skew.running_total(df, ["t", "id"], "k", "s", pieces=pieces).collect()} == want


def test_expand(spark):
    df = spark.createDataFrame([("a", 1_000), ("b", 3), ("c", 0)], "k string, n bigint")
    for block in (64, 10_000):
        got = skew.expand(df, "n", "i", block=block)
        assert sorted((r["k"], r["i"]) for r in got.collect()) == [("a", i) for i in range(1_000)] + [("b", i) for i in range(3)]


def test_rules_agree_on_both_paths(spark, tight):
    """All findings of a ledger in which one coupon, code and issuance dominate."""
    led = adapter.ledger(spark, SF_DIR)
    i, h = led.issuances, led.issuance_histories
    owned = F.col("id") % 5 < 2
    heavy = led.with_tables(
        issuances=i.withColumn("coupon_id", F.when(owned, F.lit(199601).cast("bigint")).otherwise(F.col("coupon_id")))
        .withColumn("code", F.when(owned, F.lit("CP1")).otherwise(F.col("code"))),
        issuance_histories=h.withColumn("issuance_id", F.when(F.col("issuance_id") % 5 < 2, F.lit(3).cast("bigint")).otherwise(F.col("issuance_id"))),
    )
    assert heavy.hot("issuance_histories", "issuance_id") and heavy.hot("issuances", "coupon_id", "code")
    fast = sorted(rules.run_rules(heavy, adapter.AS_OF).collect())

    none = lambda *c: skew.Hot(c)
    plain = heavy.with_tables()
    plain._hot.update({("issuance_histories", ("issuance_id",)): none("issuance_id"), ("issuances", ("coupon_id", "code")): none("coupon_id", "code")})
    skew.BROADCAST_ROWS = 10**6
    slow = sorted(rules.run_rules(plain, adapter.AS_OF).collect())
    assert len(fast) > 1_000 and fast == slow


def test_chain_same_under_any_partitioning(spark):
    h = adapter.histories(spark, SF_DIR)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "4", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(replay.chain(h, adapter.AS_OF).select("id", F.coalesce("previous", F.lit(""))).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2]


def test_five_thousand_hot_keys(spark):
    """Every heavy key is found and cut, and results are those of a plain window."""
    from pyspark.sql import Window

    many = spark.range(5_000 * 24).select((F.col("id") % 5_000).alias("k"), "id")
    few = spark.range(10**6, 10**6 + 3_000).select((F.col("id") % 1_500 + 10_000).alias("k"), "id")
    one = spark.range(2 * 10**6, 2 * 10**6 + 20_000).select(F.lit(-1).cast("bigint").alias("k"), "id")
    df = many.unionByName(few).unionByName(one).select("k", "id", F.xxhash64("id").alias("v"))
    hot = skew.hot_keys(df, ["k"], floor=20)
    assert hot and hot.keys.count() == 5_001 and hot.most == 4_000
    assert not skew.hot_keys(df, ["k"], floor=20_000)
    got = skew.lag_in_group(df, "k", ("id",), "v", "p", hot=hot)
    want = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("id")))
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    lookup = df.select("k").distinct().withColumn("x", F.col("k") * 3)
    joined = skew.lookup_join(df, lookup, ["k"], hot=hot, broadcast_rows=0)
    assert joined.where("x <> k * 3").isEmpty() and joined.count() == df.count()
