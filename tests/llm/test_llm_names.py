"""Clashing column names, repeated and null rows, partitions, and threads."""

import re
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import marketlane.llm
from marketlane.functions import frames
from marketlane.llm import (
    decontamination,
    fill_middle,
    licenses,
    mixing,
    near_duplicates,
    packing,
    quality,
    secret_scan,
    spelling,
    token_counts,
)

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
PROSE = "the council met on tuesday and agreed to repair the old bridge over the river before winter "
ITEM = "which famous harbour town was founded by three brothers after the great flood of the northern valley"


def internal_names():
    files = [*Path(marketlane.llm.__file__).parent.glob("*.py"), Path(frames.__file__)]
    found = {n for f in files for n in re.findall(r'"(_[a-z_]*[a-z])"', f.read_text(encoding="utf-8"))}
    assert {"_rank", "_source", "_inherited"} <= found
    return sorted(found)


def documents(spark):
    rows = [(n, PROSE * (n + 1) + f"number {n} " * n, "en", "a") for n in range(4)]
    rows += [(3, PROSE * 4 + "number 3 " * 3, "en", "a"), (4, ITEM + " indeed", "en", None), (5, "", "de", "b"), (6, None, None, "b"), (None, None, None, None)]
    rows += [(7, PROSE * 3 + 'password = "hunter22hunter22"', "en", "b")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return frame.withColumn("n_chars", F.char_length("text").cast("bigint")).select("*", *[F.lit(7).alias(n) for n in internal_names()])


LABELS = [(0, 1), (1, 1), (5, 0), (7, 0), (None, 1), (2, 1), (2, 0)]


@pytest.fixture(scope="module")
def model(spark):
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int")
    return quality.fit(documents(spark), labels)


def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id bigint, text string")


OPERATORS = {
    "quality": lambda s, d, m: quality.scored(d, m),
    "keep_good": lambda s, d, m: quality.keep_good(d, m),
    "near": lambda s, d, m: near_duplicates.drop_near_duplicates(d),
    "classes": lambda s, d, m: near_duplicates.near_duplicate_classes(d, class_column="c"),
    "leaks": lambda s, d, m: decontamination.drop_contaminated(d, benchmark(s)),
    "matches": lambda s, d, m: decontamination.with_matches(d, benchmark(s)),
    "secrets": lambda s, d, m: secret_scan.with_secrets(d),
    "redacted": lambda s, d, m: secret_scan.redacted(d, length="n_chars"),
    "mixed": lambda s, d, m: mixing.mixed(d),
    "licences": lambda s, d, m: licenses.with_licences(d.withColumn("path", F.concat_ws("/", "source", "doc_id"))),
    "prefixes": lambda s, d, m: token_counts.with_prefixes(d, token_counts.Vocabulary.load(PATH)),
    "fill": lambda s, d, m: fill_middle.transformed(d),
}
ROWS = {"keep_good": None, "near": 8, "leaks": 9}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_stand_all_internal_names(spark, model, name):
    docs = documents(spark).repartition(3)
    out = OPERATORS[name](spark, docs, model)
    rows = out.collect()
    assert set(docs.columns) <= set(out.columns)
    assert ROWS.get(name, 10) in (len(rows), None)
    assert all(r[n] == 7 for r in rows for n in internal_names())
    assert OPERATORS[name](spark, docs.limit(0), model).count() == 0


def test_row_changing_operators_stand_them_too(spark):
    docs = documents(spark)
    assert packing.pieces(packing.sequences(docs, PATH)).count() == 10
    assert spelling.variants(docs).count() > 5
    assert mixing.training_order(docs).count() >= 6


def test_the_model_does_not_depend_on_partitions(spark):
    rows = [(n % 12, PROSE * (n % 5) + "zq xv " * (n % 7) + str(n)) for n in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(12)], "doc_id bigint, quality int")
    models = [quality.fit(docs.repartition(n), labels) for n in (1, 3, 7)]
    for other in models[1:]:
        assert (models[0].vectors == other.vectors).all() and (models[0].axes == other.axes).all()
    assert len(models[0].vectors) == 12


def test_the_mix_does_not_depend_on_partitions(spark):
    rows = [(n % 3, "word " * (1 + n % 4) + str(n % 40), "s" if n % 5 else None) for n in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first, *others = [sorted(mixing.mixed(docs.repartition(n)).collect(), key=repr) for n in (1, 3, 7)]
    assert all(first == other for other in others)


def test_two_threads_keep_their_tables(spark):
    docs = documents(spark)
    alone = sorted(near_duplicates.class_rows(docs).collect(), key=repr)

    def run(n):
        if n % 2:
            return sorted(near_duplicates.class_rows(docs).collect(), key=repr)
        return spelling.variants(docs).count()

    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(run, range(4)))
    assert found[1] == found[3] == alone and found[0] == found[2]
