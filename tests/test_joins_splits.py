import dataclasses

import pytest
from conftest import rows
from pyspark.sql import functions as F

from halfstar.operators import joins as J
from halfstar.operators import split as Z
from halfstar.operators.ids import dense_ids, support_features


def hot_fact(spark):
    keys = [1] * 400 + [None] * 300 + list(range(2, 302))
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")


def value_table(fact):
    return fact.groupBy("k").agg(F.count("*").alias("n"), (F.max("i") * 2.0).alias("v"))


def test_lookup_paths_agree(spark):
    fact = hot_fact(spark)
    small = J.KeyedTable.build(value_table(fact).where("k is null or k < 200"), "k")
    large = dataclasses.replace(small, broadcast_bytes=0)
    assert small.is_small and not large.is_small
    assert rows(J.lookup(fact, large).fillna(-1)) == rows(J.lookup(fact, small).fillna(-1))
    assert rows(J.keep_keys(fact, large).fillna(-1)) == rows(J.keep_keys(fact, small).fillna(-1))


def test_large_lookup_spreads_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT_SHARE", 0.01)
    fact = hot_fact(spark)
    large = dataclasses.replace(J.KeyedTable.build(value_table(fact), "k"), broadcast_bytes=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = J.lookup(fact, large)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        # without salting one of the 4 partitions would hold at least 40 %
        assert len(sizes) == 4 and max(sizes) < 0.35 * 1000
        assert joined.where("v is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_lookup_spreads_hot_keys_the_table_lacks(spark, monkeypatch):
    """Half of the rows have one key, which is not in the table at all."""
    monkeypatch.setattr(J, "HOT_SHARE", 0.01)
    fact = spark.createDataFrame([(1 if i % 2 else i, i) for i in range(4000)], "k int, i int")
    other = value_table(fact.where("k <> 1"))
    large = dataclasses.replace(J.KeyedTable.build(other, "k"), broadcast_bytes=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = J.lookup(fact, large)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2 * 4000 / 4
        assert joined.where("v is null").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_anti_join_is_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, genres string")
    right = spark.createDataFrame([(2, None)], "id int, genres string")
    assert rows(J.anti_join_all(left, right)) == [(1, "a")]


def test_natural_join_multiplies_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, g string")
    assert J.natural_inner_join(df, df).count() == 5


def test_holdout_is_disjoint_complete_and_stable(spark, skewed):
    flagged = Z.flag_holdout(skewed)
    assert flagged.count() == skewed.count()
    train, holdout = flagged.where("not holdout"), flagged.where("holdout")
    assert holdout.count() > 0
    for key in ("userId", "movieId"):
        assert holdout.join(train, key, "left_anti").count() == 0
    again = Z.flag_holdout(skewed.repartition(7, "rating"))
    assert rows(again, "userId", "movieId", "holdout") == rows(flagged, "userId", "movieId", "holdout")
    rest, candidates = Z.split_holdout(skewed)
    assert rows(Z.consistent_holdout(rest, candidates)) == rows(holdout, *skewed.columns)
    assert rows(Z.final_train(rest, candidates)) == rows(train, *skewed.columns)


def test_stratified_exact(spark, skewed):
    picked = {r[0]: r[1] for r in Z.stratified_exact(skewed, "rating", 0.1).groupBy("rating").count().collect()}
    sizes = {r[0]: r[1] for r in skewed.groupBy("rating").count().collect()}
    assert picked == {k: -(-n // 10) for k, n in sizes.items()}


def test_known_unknown_hides_two_per_test_user(spark, skewed):
    split = Z.known_unknown(skewed)
    assert split.count() == skewed.count()
    per_user = split.groupBy("userId").agg(
        F.count_if(F.col("part") == "unknown").alias("hidden"),
        F.count_if(F.col("part") == "train").alias("train"),
        F.count("*").alias("n"),
    )
    for r in per_user.collect():
        assert r["train"] in (0, r["n"])
        assert r["hidden"] == (0 if r["train"] else min(2, r["n"]))


def test_top_k_per_key_is_cut_before_the_shuffle(spark, skewed):
    from halfstar.operators.neighbours import nearest

    pairs = skewed.select(
        F.col("userId").alias("i"), F.col("movieId").alias("j"), F.col("rating").alias("sim"))
    plan = nearest(pairs, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_broadcast_size_is_measured(spark):
    df = spark.createDataFrame([(1, 1, "x" * 1000, [1.0] * 500)], "k int, n int, s string, a array<double>")
    table = J.KeyedTable.build(df, "k")
    assert 5000 <= table.size < 6000
    assert not dataclasses.replace(table, broadcast_bytes=4999).is_small


def test_share_split_and_folds(spark, skewed):
    a, b = Z.share_split(skewed, 0.7, "x")
    assert a.count() + b.count() == skewed.count() and a.intersect(b).count() == 0
    folds = {r[0] for r in skewed.select(Z.fold_of(3)).distinct().collect()}
    assert folds == {0, 1, 2}


def test_pick_user(spark, skewed):
    import pytest

    assert Z.pick_user(skewed) == Z.pick_user(skewed.repartition(5))
    with pytest.raises(ValueError):
        Z.pick_user(skewed.where("false"))


def test_dense_ids_are_sorted_and_gapless(spark, skewed):
    got = rows(dense_ids(skewed.repartition(6), "movieId"), "movieId", "idx")
    assert got == [(k, i + 1) for i, k in enumerate(sorted({r[0] for r in skewed.select("movieId").collect()}))]


def test_support_features(spark, skewed):
    r = support_features(skewed).where("userId = 1 and movieId = 1").first()
    assert (r["n_movies_by_user"], r["n_users_by_movie"]) == (300, 301)


def test_discarded_tables_are_gone(spark):
    import os

    from halfstar.session import CLEANUP_CONF, discard, freed_shuffles, materialise

    with freed_shuffles(spark):
        written = materialise(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "gone")
        assert spark.conf.get(CLEANUP_CONF) == "true"
    assert spark.conf.get(CLEANUP_CONF) == "false" and written.count() == 7
    discard(written, spark.range(3))
    assert not os.path.exists(written.scratch_path)


def test_packed_tables_have_no_more_partitions_than_the_cores_use():
    from halfstar.session import tasks_for

    assert [tasks_for(n, 12) for n in (0, 50_000, 2_000_000, 20_000_000, 120_000_000)] == [1, 3, 24, 24, 120]


def test_splits_shuffle_no_titles(spark, monkeypatch):
    from halfstar.plans import queries as Q

    seen = []
    for name in ("consistent_holdout", "removed_rows", "final_train"):
        real = getattr(Q.Z, name)
        monkeypatch.setattr(Q.Z, name, lambda a, b, real=real: seen.append(set(a.columns) | set(b.columns)) or real(a, b))
    for query in (Q.holdout_consistent, Q.holdout_removed, Q.train_final, Q.rekeyed_removed, Q.rekeyed_anti_join):
        assert query(spark, "/root/testdata/sf0.001").columns == Q.SIX
    assert len(seen) >= 5 and all(c == {"userId", "movieId", "rating", "timestamp"} for c in seen)


def recorded(monkeypatch, module):
    """Labels and plans of what a module writes."""
    seen, write = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, label, *more: (
        seen.append((label, df._jdf.queryExecution().optimizedPlan().toString())), write(df, label, *more))[1])
    return seen


def test_a_chain_of_lookups_counts_keys_before_its_joins(spark, monkeypatch):
    from halfstar.operators import joins as J

    fact = spark.range(60).selectExpr("id % 7 as a", "id % 5 as b", "id as v")
    tables = [J.KeyedTable.build(spark.range(4).selectExpr(f"id as {k}", "1L as n", f"id * 10 as x{k}"), k, broadcast_bytes=0) for k in "ab"]
    seen = recorded(monkeypatch, J)
    found = J.lookup(J.lookup(fact, tables[0]), tables[1])
    assert [label for label, _ in seen] == ["counts-a", "heavy-a", "counts-b", "heavy-b"]
    assert not any("Join" in plan for _, plan in seen)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[2]) == [
        (i % 7, i % 5, i, i % 7 * 10 if i % 7 < 4 else None, i % 5 * 10 if i % 5 < 4 else None) for i in range(60)
    ]


def test_the_split_is_flagged_before_titles_join(spark, monkeypatch):
    from halfstar.operators import split as Z
    from halfstar.plans import prepare as P

    ratings = spark.range(200).selectExpr("int(id % 20) userId", "int(id div 20) movieId", "1.5D rating", "id timestamp")
    movies = spark.range(8).selectExpr("int(id) movieId", "concat('t', id, ' (1990)') title", "'g' genres")
    seen = recorded(monkeypatch, Z)
    p = P.build(spark, ratings, movies)
    assert [label for label, _ in seen] == ["orphans"] and "Join" not in seen[0][1]
    assert p.fact.count() == 200 and p.fact.where("full_title is null").count() == 40


def test_rekeyed_tables_do_not_build_the_plain_ones(spark, monkeypatch):
    from conftest import TESTDATA

    from halfstar.plans import prepare as P
    from halfstar.plans import queries as Q

    built = []
    monkeypatch.setattr(P, "_prepared", {})
    monkeypatch.setattr(P, "build", lambda *given: built.append(given) or len(built))
    assert Q.rekeyed(spark, TESTDATA) == Q.rekeyed(spark, TESTDATA) == 1 and len(built) == 1
    assert P.prepare(spark, TESTDATA) == 2


def test_penalty_sums_meet_by_key_as_rows(spark, monkeypatch):
    """Wide partial sums used to be sent for every key and task."""
    from halfstar.operators import joins as J
    from halfstar.operators import regularise as R

    rows = spark.range(300).selectExpr("if(id < 200, 1, id) as userId", "1 as __n", "1.0D as __s", "double(id) as c1", "2L as n1")
    seen = recorded(monkeypatch, J)
    table = R._grid_sums(rows, "userId", [0.0, 2.0], 0.5)
    plan = dict(seen)["by-userId"]
    assert plan.count("Aggregate") == 2 and plan.rindex("Aggregate") < plan.index("RepartitionByExpression [userId")
    got = {r["userId"]: (r["n"], r["sums"]) for r in table.df.collect()}
    assert got[1][0] == 200 and got[1][1] == pytest.approx([100 - 9950, 100 - 4975.0])
    assert len(got) == 101 and got[250] == (1, [0.5 - 125, 0.5 - 62.5])


def test_a_table_above_the_limit_is_never_broadcast(spark, skewed):
    """Its files may be far smaller than its rows, so Spark would gather it at the driver for each lookup."""
    users = skewed.groupBy("userId").agg(F.count("*").alias("n"), F.lit(1.0).alias("v"))
    found = J.lookup(skewed, J.KeyedTable.build(users, "userId", broadcast_bytes=0), ["v"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert found.where("v = 1.0").count() == skewed.count()
