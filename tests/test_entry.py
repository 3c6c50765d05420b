"""The driver's contract."""

import duckdb
import pytest

import __spark_entry__ as entry
from retort import registry
from retort.plans import answers, reactions, screens

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_registry_is_complete():
    assert len(registry.QUERIES) > 70 and set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE_SQL) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["paper", "location"]


OLDER = ["edges_to_summary", "qa_gold_ties", "reason_labelled_filter", "er_to_ee", "two_key_lookup", "asof_page", "greedy_chunk", "usage_grouping_sets", "page_relevance", "unique_suffixes"]
NEWER = [n for n, f in registry.QUERIES.items() if n in vars(reactions) or n in vars(screens) or n in vars(answers)]


def plain(value):
    """Numbers to six digits and arrays by their elements, so that both engines write a value alike."""
    if isinstance(value, float):
        return f"{value:.6g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", OLDER + NEWER)
def test_query_gives_the_values_of_its_sql(spark, tables, name):
    found = tables.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    expected = sorted(tuple(map(plain, (row[names.index(c)] for c in sorted(names)))) for row in found.fetchall())
    df = registry.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(plain(row[c]) for c in sorted(names)) for row in df.collect()) == expected and expected


def test_screens_have_every_reason(spark):
    early, late = ["unknown_reaction_type", "insufficient_objective_options"], ["insufficient_scored_options", "no_rankable_yield_or_ee"]
    conditions = ["missing_product", "duplicate_public_conditions_conflicting_results", "insufficient_distinct_conditions"]
    substrates = ["variable_scaffold_not_unique", "fixed_substrate_mismatch", "duplicate_variable_substrate_conflicting_results", "insufficient_distinct_variable_substrates"]
    for name, own in (("condition_choices_review", conditions), ("substrate_choices_review", substrates)):
        assert {r.reason for r in registry.QUERIES[name](spark, SF).select("reason").distinct().collect()} == {*early, *late, *own}
