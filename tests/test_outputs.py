"""Outputs that stop and go on, rewritten samples, matrices, sets inside sets, aliases and what gives an answer away."""

import datetime
from random import Random

import pytest
from pyspark.sql import functions as F
from test_entry import plain, tables  # noqa: F401  a fixture

from retort import registry
from retort.operators import molecules, resolve, validation
from retort.plans import outputs
from retort.streaming import partial

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in vars(outputs)])
def test_query_gives_the_values_of_its_sql(spark, tables, name):  # noqa: F811
    found = tables.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    expected = sorted(tuple(plain(row[names.index(c)]) for c in sorted(names)) for row in found.fetchall())
    df = registry.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(plain(row[c]) for c in sorted(names)) for row in df.collect()) == expected and expected


def test_a_stopped_run_goes_on(spark, tmp_path):
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    tries = []

    def work(rows):
        tries.append(1)
        if len(tries) == 3:
            # As if the driver were lost with a part of the batch written.
            rows.limit(3).withColumn("twice", F.col("id") * 2).write.mode("overwrite").parquet(f"{out}/rows/batch=2")
            raise RuntimeError("killed")
        return rows.withColumn("twice", F.col("id") * 2)

    with pytest.raises(Exception, match="killed"):
        partial.run_resumable(stream(), work, out, mark)
    rows, more = partial.read_partial(spark, out)
    assert more and rows.filter("batch < 2").count() == 20
    partial.run_resumable(stream(), work, out, mark)
    rows, more = partial.read_partial(spark, out)
    assert not more and len(tries) == 5 and sorted(r.twice for r in rows.collect()) == [2 * i for i in range(40)]
    partial.run_resumable(stream(), work, out, mark)
    assert len(tries) == 5 and partial.read_partial(spark, out)[0].count() == 40


def test_rewritten_days_are_whole_sorted_and_few(spark, tmp_path):
    path, start = str(tmp_path / "samples"), datetime.datetime(2026, 1, 1)
    rows = [(start + datetime.timedelta(hours=7 * i), i % 2, i if i % 5 else None, 1.0 * i, None if i % 4 else "down", 0.5 * i) for i in range(20)]
    table = spark.createDataFrame(rows + rows[:1], "created_at timestamp, gpu_index int, memory_used int, utilization double, error string, elapsed_seconds double")
    for i in range(3):
        partial.append_samples(table.filter(F.hour("created_at") % 3 == i).repartition(3), path)
    before = sorted(map(tuple, spark.read.parquet(path).collect()), key=str)
    partial.rewrite_samples(spark, path, ["2026-01-02"])
    files = lambda day: len(list((tmp_path / "samples" / f"day={day}").glob("*.parquet")))
    assert files("2026-01-02") == 1 and files("2026-01-01") > 1
    partial.rewrite_samples(spark, path)
    assert files("2026-01-01") == 1 and sorted(map(tuple, spark.read.parquet(path).collect()), key=str) == before
    day = [r.created_at for r in spark.read.parquet(str(tmp_path / "samples" / "day=2026-01-03")).collect()]
    assert day == sorted(day)
    got = {r.gpu_index: (r.samples, r.errors, r.peak_memory) for r in partial.summarize_samples(spark.read.parquet(path)).collect()}
    assert got == {0: (5, 6, 18), 1: (10, 0, 19)}


def test_matrices_with_holes(spark):
    rows = spark.createDataFrame([(3, [[0, 1, 9], [1, 0, 4], [9, 4, 0]]), (4, [[0, None, 2]]), (1, [[5]]), (0, []), (3, None)], "n int, m array<array<int>>")
    made = rows.withColumn("b", molecules.bonds(F.col("n"), F.col("m"))).withColumn("f", molecules.fragments(F.col("n"), F.col("b"))).collect()
    assert [[(b.bond_type, b.i, b.j) for b in r.b] for r in made] == [[("single", 0, 1), ("aromatic", 1, 2)], [("double", 0, 2)], [], [], []]
    assert [r.f for r in made] == [[0, 0, 0], [0, 1, 0, 3], [0], [], [0, 1, 2]]
    one = spark.createDataFrame([([0.1, 0.7, 0.7],), ([],), (None,)], "s array<double>")
    assert [r[0] for r in one.select(molecules.bond_number(F.col("s"))).collect()] == [1, 0, 0]
    some = spark.createDataFrame([(["C", "O", "N"], [[0.12345, 1.0], [2.0]])], "s array<string>, c array<array<double>>")
    assert [tuple(a) for a in some.select(molecules.atoms(F.col("s"), F.col("c"))).first()[0]] == [("C", 0.123, 1.0), ("O", 2.0, None)]


def test_sets_inside_sets(spark):
    sets = {"a": [1, 2], "b": [2, 1, 1], "c": [1, 2, 3], "d": [3], "e": [4, None], "f": [None]}
    pairs, members = validation.contained_sets(spark.createDataFrame([(k, x) for k, xs in sets.items() for x in xs] + [(None, 1)], "k string, x int"), "k", "x")
    of = {r.k: r.set_id for r in members.collect()}
    assert set(of) == set("abcde") and of["a"] == of["b"]
    assert sorted((r.set_id, r.within) for r in pairs.collect()) == sorted([(of["a"], of["c"]), (of["d"], of["c"])])
    empty = spark.createDataFrame([], "k string, x int")
    assert [df.count() for df in validation.contained_sets(empty, "k", "x")] == [0, 0]


@pytest.mark.parametrize("listed, most", [(10, 20), (3, 20), (2, 3)])
def test_sets_held_are_found_by_their_subsets(spark, monkeypatch, listed, most):
    monkeypatch.setattr(validation, "LISTED", listed)
    monkeypatch.setattr(validation, "LISTED_AT_MOST", most)
    random = Random(1)
    sets = {k: frozenset(random.sample(range(14), random.choice([1, 2, 3, 4, 5, 12]))) for k in range(300)}
    rows = spark.createDataFrame([(k, x) for k, xs in sets.items() for x in xs], "k int, x int")
    expected = {k: sum(xs < ys for ys in set(sets.values())) for k, xs in sets.items()}
    assert {r.k: r.held_by for r in validation.held_by(rows, "k", "x").collect()} == expected
    pairs, members = validation.contained_sets(rows, "k", "x")
    of = {r.set_id: sets[r.k] for r in members.collect()}
    assert sorted((sorted(of[r.set_id]), sorted(of[r.within])) for r in pairs.collect()) == sorted((sorted(a), sorted(b)) for a in of.values() for b in of.values() if a < b)
    if listed == 10:  # subsets are looked up, and no set is laid beside all that share an item with it
        plan = validation.contained_sets(rows.filter("k < 200 AND x < 10"), "k", "x")[0]._jdf.queryExecution().optimizedPlan().toString()
        assert "array_except" not in plan


def test_aliases_with_and_without_inner_words(spark):
    texts = ["see general procedure A for it", "general  procedure A for", "ageneral procedure Afor x", "x", None, ""]
    names = ["general procedure A", "procedure", "A for", " procedure ", "e", None, "general procedure A for", "(general) procedure - A"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    aliases = spark.createDataFrame(list(enumerate(names)), "j int, a string")
    expected = sorted((i, j) for i, x in enumerate(texts) for j, a in enumerate(names) if x is not None and a is not None and a in x)
    for block in (4_000_000, 90):
        assert sorted((r.i, r.j) for r in resolve.contains_join(rows, aliases, "t", "a", block).collect()) == expected
    assert resolve.contains_join(rows, aliases.limit(0), "t", "a").count() == 0
    plan = resolve.contains_join(rows, aliases.filter("j in (0, 6, 7)"), "t", "a")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_customers_are_dealt_for_retry_reasons(spark):
    """A small file of rows with much to do for each would be one task."""
    made = registry.QUERIES["retry_reasons"](spark, "/root/testdata/sf0.001")
    assert "RoundRobinPartitioning" in made._jdf.queryExecution().executedPlan().toString()
