"""The pipeline stage by stage against brute force, on stages' own inputs."""

import math
import re
import struct
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from sluice.llm.common import staged
from sluice.llm.mixing import OP10_SQL
from sluice.llm.quality import classify

from llm_helpers import SF001, make_docs  # noqa: F401

LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        docs = staged(stage(spark, docs, SF001), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_columns(outputs):
    assert all(df.columns == outputs[0].columns for df in outputs[1:-1])
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "exact_dedup", "ngram_join", "mixing", "bpe_codec"]


def test_quality(spark, outputs):
    verdicts = {r["doc_id"]: r["predicted"] for r in classify(outputs[0], spark.read.parquet(f"{SF001}/labels.parquet")).collect()}
    assert rows(outputs[1]) == [r for r in rows(outputs[0]) if verdicts[r[0]]]
    assert 0 < outputs[1].count() < outputs[0].count()


def test_exact(outputs):
    last = {}
    for r in sorted(outputs[1].collect(), key=lambda r: r["doc_id"]):
        last[(r["text"] or "").translate(LOWER)] = tuple(r)
    assert rows(outputs[2]) == sorted(last.values(), key=repr)


def test_near(outputs):
    docs = sorted(outputs[2].collect(), key=lambda r: r["doc_id"])
    sets = []
    for r in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert rows(outputs[3]) == sorted((tuple(r) for i, r in enumerate(docs) if find(i) == i), key=repr)


def test_mixing(outputs):
    con = duckdb.connect()
    documents = outputs[3].toArrow()  # noqa: F841
    con.register("documents", documents)
    want = Counter()
    for doc, size, _, _, taken in con.execute(OP10_SQL).fetchall():
        want[doc] = math.ceil(taken / size) if size else 0
    got = Counter(r["doc_id"] for r in outputs[4].collect())
    assert got == Counter({k: v for k, v in want.items() if v})


def test_encoding(outputs):
    lib = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    want = []
    for r in outputs[4].collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), struct.pack(f"<{len(ids)}I", *ids), lib.decode(ids, skip_special_tokens=False)))
    got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in outputs[5].collect()]
    assert sorted(got) == sorted(want)


def test_run_equals_the_stages(spark, outputs):
    got, want = (Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in df.collect()) for df in (P.run(spark, SF001), outputs[5]))
    assert got == want


def test_odd_rows_pass_every_stage(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "x"), (None, None), (4, "A b c d e f g", None), (5, "a B c d e f g", None)])
    labels = f"{SF001}"
    for _, stage in P.STAGES:
        docs = staged(stage(spark, docs, labels), "test-odd")
    assert docs.count() > 0
    empty = make_docs([])
    for _, stage in P.STAGES:
        empty = staged(stage(spark, empty, labels), "test-empty")
    assert empty.collect() == []
