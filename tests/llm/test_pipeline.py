"""The pipeline's stages, each against a plain version on its own input."""

import os
import re

import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.test_groups import plain_fingerprint, plain_roots
from usagelens.llm import queries
from usagelens.llm.common import table
from usagelens.session import materialize

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def shingles(text):
    words = [w.strip(".,;:!?\"'()[]{}<>*#%&$|") for w in text.lower().split()]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage, by doc_id."""
    docs = table(spark, SF_DIR, "documents")
    out = [{r["doc_id"]: r.asDict() for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        docs = materialize(made, name)
        out.append({r["doc_id"]: r.asDict() for r in docs.collect()})
    return out


def test_the_classifier_keeps_the_good(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    good, bad = ({i for i, q in labels.items() if q == k and i in stages[0]} for k in (1, 0))
    kept = set(stages[1])
    assert len(good & kept) >= 0.98 * len(good) and len(bad & kept) <= 0.05 * len(bad)


def test_one_of_each_group_stays(stages):
    fps = {i: plain_fingerprint(d["text"]) for i, d in stages[1].items()}
    pairs = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    assert set(stages[2]) == set(plain_roots(fps, pairs).values())
    assert all(stages[2][i] == stages[1][i] for i in stages[2])


def test_leaking_documents_go(spark, stages):
    items = [shingles(r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    share = {i: max(len(s & shingles(d["text"])) / len(s) for s in items) for i, d in stages[2].items()}
    assert any(s >= 0.95 for s in share.values())
    assert all((i in stages[3]) == (s < 0.5) for i, s in share.items() if s >= 0.95 or s < 0.5)


def test_secrets_are_marked(stages):
    hex_run = re.compile(r"[0-9a-f]{24,}")
    for i, d in stages[3].items():
        clean = stages[4][i]["text"]
        assert not hex_run.search(clean) and stages[4][i]["n_chars"] == len(clean)
        if "token" not in d["text"] and not re.search(r"\d", d["text"]):
            assert clean == d["text"]
    assert set(stages[4]) == set(stages[3])


def test_encoding_of_what_is_left(stages):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    assert set(stages[5]) == set(stages[4])
    for i, d in stages[5].items():
        ids = library.encode(stages[4][i]["text"], add_special_tokens=False).ids
        assert (d["n_tokens"], bytes(d["ids"])) == (len(ids), np.array(ids, "<u4").tobytes())


def test_run_applies_all_stages(spark, stages):
    rows = entry_points.queries()["pipeline"](spark, SF_DIR)
    assert {r["doc_id"]: r.asDict() for r in rows.collect()} == stages[5]


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", ["op1_license_scans", "op4_benchmark_decontamination", "op10_url_filters"])
def test_registered_queries_run(spark, name):
    out = entry_points.queries()[name](spark, SF_DIR)
    key = "page_id" if name.startswith("op10") else "doc_id"
    assert out.count() > 0 and dict(out.dtypes)[key] == "bigint"
