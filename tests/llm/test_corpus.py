"""The registered queries against SQL, and the pipeline against its stages in plain Python."""

from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import compare, connect
from tests.llm.test_groups import components
from tests.llm.test_row_operators import all_spans, contamination, counts
from tillhouse.llm import quality_rules
from tillhouse.llm.oracles import ORACLES
from tillhouse.llm.queries import QUERIES, TOKENIZER

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no sample data")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    difference = compare(QUERIES[name](spark, FOLDER), connect(FOLDER).sql(ORACLES[name]))
    assert not difference, difference[:5]


def test_each_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality_rules"](spark, docs, FOLDER)
    expected = {
        row["row"]["doc_id"] for row in quality_rules.apply_rules(docs).collect()
        if row["kept"] and counts(row["row"]["text"])["n_words"] >= 50
    }
    assert {row["doc_id"] for row in good.collect()} == expected and good.columns == columns

    single = stages["simhash_near_dedup"](spark, good, FOLDER)
    rows = [(row["doc_id"], row["text"]) for row in good.collect()]
    assert {row["doc_id"] for row in single.collect()} == {least for *_, least in components(rows)}
    assert single.columns == columns

    clean = stages["decontamination"](spark, single, FOLDER)
    items = [tuple(row) for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {row["doc_id"]: contamination(row["text"], items, 10)[1] for row in single.collect()}
    assert {row["doc_id"] for row in clean.collect()} == {key for key, n in hit.items() if not n}
    assert clean.columns == columns

    redacted = stages["secret_scans"](spark, clean, FOLDER)
    before = {row["doc_id"]: row for row in clean.collect()}
    after = {row["doc_id"]: row for row in redacted.collect()}
    assert set(before) == set(after) and redacted.schema.names == columns
    for key, row in after.items():
        assert (row["text"] == before[key]["text"]) == (not all_spans(before[key]["text"]))
        assert row["n_chars"] == len(row["text"])

    pieces = stages["packing"](spark, redacted, FOLDER)
    tokens = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("total")).collect()
    assert {row["doc_id"] for row in tokens} == set(after) and all(row["n"] == row["total"] for row in tokens)
    own = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    ids = {}
    for row in pieces.orderBy("doc_id", "start").collect():
        ids.setdefault(row["doc_id"], []).extend(np.frombuffer(row["ids"], dtype="<u4").tolist())
    for key, row in after.items():
        assert ids[key] == [*own.encode(row["text"] or "", add_special_tokens=False).ids, 1]

    whole = corpus_pipeline.run(spark, FOLDER)
    assert {row["doc_id"] for row in whole.select("doc_id").distinct().collect()} == set(after)
