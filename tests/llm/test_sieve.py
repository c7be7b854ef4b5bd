import numpy as np
from pyspark.sql import functions as F

from shelftide.llm.sieve import sieve_of


def test_holds_all_keys_and_few_others(spark):
    table = spark.range(40_000).select("id", F.xxhash64("id").alias("key"))
    sieve = sieve_of(table.filter("id % 4 = 0").select("key"))
    held = {r.id for r in sieve.sift(table, "key").collect()}
    assert held >= set(range(0, 40_000, 4))
    assert len(held) < 10_000 + 0.15 * 30_000
    rest = {r.id for r in sieve.sift(table, "key", inside=False).collect()}
    assert not held & rest and len(held | rest) == 40_000


def test_bound_on_bits_lets_more_pass(spark):
    table = spark.range(200_000).select(F.xxhash64("id").alias("key"))
    sieve = sieve_of(table, most_bits=1 << 16)
    assert sieve.bits == 1 << 16 and len(sieve.held.value) == 1 << 13
    assert sieve.sift(table, "key").count() == 200_000


def test_nulls_repeats_and_empty_tables(spark):
    keys = spark.createDataFrame([(5,), (5,), (None,), (-7,), (0,)], "key long")
    sieve = sieve_of(keys)
    assert sieve.may_hold(np.array([5, -7, 0, 6])).tolist() == [True, True, True, False]
    assert sorted(r.key for r in sieve.sift(keys, "key").collect()) == [-7, 0, 5, 5]
    assert [r.key for r in sieve.sift(keys, "key", inside=False).collect()] == [None]
    none = sieve_of(keys.limit(0))
    assert none.sift(keys, "key").count() == 0 and none.sift(keys, "key", inside=False).count() == 5
