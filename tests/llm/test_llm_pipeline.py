"""The registered queries and the pipeline over the small test tables."""

import os
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from marketlane.llm import decontamination, quality, queries
from marketlane.llm.common import table

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
KEYS = {"op2_redirect_rules": "page_id", "op4_cross_polytope": "query_id", "op7_typed_chat": "conv_id"}
COUNTED = {"op2_redirect_rules": "pages", "op7_typed_chat": None, "op4_cross_polytope": None}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for other in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {other} AS SELECT * FROM '{SMALL}/{other}.parquet'")
    out = queries.queries()[name](spark, SMALL)
    expected = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr) and expected


def words(text):
    return re.findall(r"[^\x00-/:-@\[-^`{-\x7f]+", (text or "").lower())


def bag(text):
    w = words(text)
    return Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else [])


def plainly_judged(spark, docs):
    """Votes of the nearest labelled vectors, one text and one neighbour at a time."""
    labels = table(spark, SMALL, "labels").filter(~quality.held_out())
    model = quality.fit(table(spark, SMALL, "documents"), labels)
    kept = []
    for row in docs:
        place = model.latent(pa.array([row["text"] or ""]))[0]
        near = sorted(((float(v @ place), i) for i, v in enumerate(model.vectors)), reverse=True)[: model.voting.neighbours]
        votes = [(max(c, 0.0) ** 4 * model.weights[i], model.labels[i]) for c, i in near]
        whole = sum(v for v, _ in votes)
        if whole and sum(v * y for v, y in votes) / whole >= 0.7:
            kept.append(row)
    return kept


def plainly_deduplicated(docs):
    kept, classes = [], {}
    bags = {i: bag(r["text"]) for i, r in enumerate(docs)}
    root = {i: i for i in bags}
    for i in bags:
        for j in range(i):
            if bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    for i, r in enumerate(docs):
        classes.setdefault(root[i] if bags[i] else ("own", i), []).append(r)
    for members in classes.values():
        kept.append(min(members, key=lambda r: r["doc_id"]))
    return kept


def plainly_clean(docs, items):
    """Alignments of every item with every window of twice its length."""
    kept = []
    for row in docs:
        w, leak = words(row["text"]), False
        for ask in items:
            common = set(ask) & set(w)
            number = {x: i + 1 for i, x in enumerate(sorted(common))}
            text, pattern = [number.get(x, 0) for x in w], [number.get(x, 0) for x in ask]
            for at in range(0, max(1, len(w) - len(ask)), len(ask)):
                part = text[at : at + 3 * len(ask)]
                share = decontamination.common_length(pattern, part) / len(ask)
                end = pattern[-(-len(ask) * 3 // 4) :]
                told = decontamination.common_length(end, part) / max(1, len(end))
                leak |= share >= 0.8 or (share >= 0.6 and told >= 0.5)
        if not leak:
            kept.append(row)
    return kept


@pytest.fixture(scope="module")
def ran(spark):
    return {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}


def test_pipeline_agrees_with_a_plain_version(spark, ran):
    docs = table(spark, SMALL, "documents").orderBy("doc_id").collect()
    good = plainly_judged(spark, docs)
    unique = plainly_deduplicated(good)
    items = [words(r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    clean = plainly_clean(unique, items)
    assert len(docs) > len(good) > len(unique) > len(clean) > 50
    assert set(ran) == {r["doc_id"] for r in clean}
    secret = re.compile(r"[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}")
    by_id = {r["doc_id"]: r["text"] for r in clean}
    assert not any(secret.search(r["text"]) for r in ran.values())
    assert all(r["text"] == by_id[i] for i, r in ran.items() if "[" not in r["text"])


def test_pipeline_mixes_what_is_left(ran):
    rows = list(ran.values())
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) and r["taken"] <= 2 * r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5


def test_stages_keep_columns_and_handle_nothing(spark):
    docs = table(spark, SMALL, "documents")
    empty = docs.limit(0)
    assert len(corpus_pipeline.STAGES) == 5 and np.all([callable(f) for _, f in corpus_pipeline.STAGES])
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, empty, SMALL)
        assert out.count() == 0, name
        if n < 4:
            assert out.columns == docs.columns, name


def test_queries_return_their_whole_tables(spark):
    docs = table(spark, SMALL, "documents").count()
    for name in ("op5_randomness_secrets", "op6_license_inheritance", "op9_prefix_tokens"):
        assert queries.queries()[name](spark, SMALL).count() == docs
