import pytest
from oracle import compare

from corpusloom.plans import catalog


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["ep_sft_export", "ep_episodes", "ep_eval_exports", "ep11_evaluation_fields"])
def test_other_texts_are_found(spark, sf, name, monkeypatch):
    """A changed payload makes the query differ from its twin."""
    from corpusloom.operators import episodes

    monkeypatch.setitem(episodes.INSTRUCTIONS, "judgment", "Judge.")
    with pytest.raises(AssertionError):
        compare(spark, sf, catalog.QUERIES[name], catalog.ORACLES[name])
