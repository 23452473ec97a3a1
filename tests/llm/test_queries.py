"""The registered corpus queries against their SQL, and the pipeline against brute force."""

import re

import pytest
from oracle import compare, connect

from tablewright.llm.queries import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(registry.sql))
def test_agrees_with_sql(spark, duck, key):
    difference = compare(spark, duck, registry.queries[key], registry.sql[key], SF)
    assert difference is None, difference


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.queries) == list(range(1, 14))


def test_entry_points_name_the_corpus_queries():
    import __spark_entry__ as driver

    assert {*registry.queries, "pipeline"} <= set(driver.queries())


def test_pipeline_stages_take_effect(spark, documents):
    """Each stage against a brute-force reading of its own input."""
    import corpus_pipeline as P
    from test_near import brute_components
    from tablewright.llm import mixing, quality, tokens
    from tablewright.llm.common import stored

    rows, order = documents, list(quality.RULES)
    def windows(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return words, {n: {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} for n in range(1, 11)}

    forbidden = {n: set() for n in range(1, 11)}
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words, runs = windows(r.text)
        if words:
            forbidden[min(10, len(words))] |= runs[min(10, len(words))]
    for number, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r.text for r in rows.collect()}
        if number == 3:
            kept = {r.doc_id for r in mixing.drawn(rows).where("__kept").collect()}
        rows = stored(stage(spark, rows, SF), "stage")
        after = {r.doc_id for r in rows.collect()}
        if number < 4:
            assert rows.columns == documents.columns and after
        if number == 0:
            assert after == {i for i, t in before.items() if quality.cascade(quality.Measures(t.encode()), order)}
        elif number == 1:
            found = brute_components(before)
            assert after == {i for i, c in found.items() if i == c} and len(after) < len(before)
        elif number == 2:
            hit = {i for i, t in before.items() if any(forbidden[n] & runs for n, runs in windows(t)[1].items())}
            assert hit and after == set(before) - hit
        elif number == 3:
            assert after == kept and len(kept) < len(before)
        else:
            assert after == set(before) and rows.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert tokens.END_ID == 2
