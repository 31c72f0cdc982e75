"""The pipeline's stages by hand, each over what its predecessor kept, and every registered query."""

from __future__ import annotations

import pytest
from conftest import SMALL
from oracle_check import canonical, duckdb_frame

import corpus_pipeline
from ticklake.llm import best_fit, queries
from ticklake.llm.common import stored
from ticklake.llm.line_variants import split_lines, within_one_edit
from test_simhash_pivots import brute_components, plain_fingerprint


@pytest.mark.parametrize("key", list(queries.oracle_sql()))
def test_query_equals_sql(spark, key):
    got = canonical(queries.queries()[key](spark, SMALL).toPandas())
    want = canonical(duckdb_frame(SMALL, queries.oracle_sql()[key]))
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    for name in got.columns:
        assert ((got[name] == want[name]) | (got[name].isna() & want[name].isna())).all(), name


def test_names():
    assert [name.split("_")[0] for name in queries.queries()] == [f"op{n}" for n in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "packing"]


def brute_lines(rows):
    """Texts without later lines equal to, or one word from, an earlier first occurrence."""
    firsts: list[list[bytes]] = []
    seen, out = set(), []
    for row in sorted(rows, key=lambda r: r.doc_id):
        gone = set()
        for number, words in split_lines(row.text):
            near = any(
                max(len(words), len(other)) >= 8 and abs(len(words) - len(other)) <= 1 and within_one_edit(words, other)
                for other in firsts
            )
            if tuple(words) in seen or near:
                gone.add(number)
            if tuple(words) not in seen:
                seen.add(tuple(words))
                firsts.append(words)
        text = "\n".join(line for number, line in enumerate(row.text.split("\n")) if number not in gone)
        if text.strip() or not gone:
            out.append((row.doc_id, text))
    return out


def brute_kept(texts):
    """Least ids of the groups that 64-bit fingerprints at most 4 bits apart join."""
    prints = {doc: plain_fingerprint(text) for doc, text in texts.items()}
    return set(brute_components(prints, 4).values())


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stored(stages["toxicity"](spark, docs, SMALL), "clean")
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    assert clean.exceptAll(docs).isEmpty()
    lines = stored(stages["line_dedup"](spark, clean, SMALL), "lines")
    assert lines.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == brute_lines(clean.collect())
    single = stored(stages["near_dedup"](spark, lines, SMALL), "single")
    assert single.columns == docs.columns and single.exceptAll(lines).isEmpty()
    assert {r.doc_id for r in single.collect()} == brute_kept({r.doc_id: r.text for r in lines.collect()})
    places = stages["packing"](spark, single, SMALL).collect()
    words = {r.doc_id: len(r.text.encode().split()) for r in single.collect()}
    assert sum(r.length for r in places) == sum(words.values())
    assert {r.doc_id for r in places} == {doc for doc, n in words.items() if n}
    whole = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
    assert whole == sorted(map(tuple, places))
    assert {r.capacity for r in places} <= set(best_fit.Lengths().permitted)
