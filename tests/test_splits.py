import pytest


from canopy.operators.splits import exact_sample, exact_split, hash_split, hash_split_counts, holdout_complement
from canopy.plans.inputs import KEYS, table
from conftest import SF_SMALL


def test_hash_split_is_partition_independent(spark):
    li = table(spark, SF_SMALL, "lineitem").select(*KEYS)
    a, _ = hash_split(li, KEYS, 0.6)
    b, _ = hash_split(li.repartition(7), KEYS, 0.6)
    assert sorted(a.collect()) == sorted(b.collect())
    train, test = hash_split(li, KEYS, 0.6)
    assert train.count() + test.count() == li.count()
    assert train.join(test, KEYS, "inner").count() == 0
    counts = {r["side"]: r["n_rows"] for r in hash_split_counts(li, KEYS, 0.6).collect()}
    assert counts["train"] == train.count()


def test_holdout_complement_semantics(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "b"), (None, "c"), (3, None)],
                               "x int, y string")
    train = spark.createDataFrame([(1, "a"), (None, "c")], "x int, y string")
    out = sorted(holdout_complement(df, train).collect(), key=repr)
    # value-based: both (1,'a') go, NULL row matches null-safely, duplicates not in train stay
    assert [tuple(r) for r in out] == sorted([(2, "b"), (2, "b"), (3, None)], key=repr)
    # neither subtract (dedups) nor exceptAll (multiset) give this
    assert df.subtract(train).count() == 2
    assert df.exceptAll(train).count() == 4


def test_complement_disjoint_from_train(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_quantity", "l_discount", "l_tax")
    train, _ = hash_split(table(spark, SF_SMALL, "lineitem"), KEYS, 0.5)
    train = train.select("l_quantity", "l_discount", "l_tax")
    comp = holdout_complement(li, train)
    assert comp.join(train.distinct(), ["l_quantity", "l_discount", "l_tax"], "inner").count() == 0


def test_xxhash_split_partition_independent(spark):
    li = table(spark, SF_SMALL, "lineitem").select(*KEYS)
    a, _ = hash_split(li, KEYS, 0.3, method="xxhash64")
    b, _ = hash_split(li.repartition(5), KEYS, 0.3, method="xxhash64")
    assert sorted(a.collect()) == sorted(b.collect())
    assert abs(a.count() / li.count() - 0.3) < 0.05


def test_exact_shares(spark):
    """Parts have exactly their share, are the rows together, and are the same on any partitioning; equal rows are split too."""
    rows = [(1, "a")] * 5000 + [(None, "b"), (None, None), (2, None)] * 3 + [(i, "c") for i in range(991)]
    df = spark.createDataFrame(rows, "x int, y string")
    parts = exact_split(df, [1, 2, 0, 1], seed=3)
    assert [p.count() for p in parts] == [1500, 3000, 0, 1500]
    whole = parts[0].unionAll(parts[1]).unionAll(parts[3])
    assert whole.exceptAll(df).isEmpty() and df.exceptAll(whole).isEmpty()
    assert all(0.7 < p.where("x = 1").count() / (5000 * p.count() / 6000) < 1.3 for p in (parts[0], parts[1], parts[3]))
    again = exact_split(df.repartition(7), [1, 2, 0, 1], seed=3)
    assert all(a.exceptAll(b).isEmpty() for a, b in zip(parts, again))
    assert not exact_split(df, [1, 3], seed=4)[0].exceptAll(parts[0]).isEmpty()


def test_exact_sample_edges(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert [exact_sample(df, f).count() for f in (0.0, 0.1, 0.5, 1.0)] == [0, 0, 2, 3]
    assert exact_sample(df.limit(0), 0.5).count() == 0
    with pytest.raises(ValueError):
        exact_split(df, [])
    with pytest.raises(ValueError):
        exact_sample(df, 1.5)
