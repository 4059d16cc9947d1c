"""N-gram join against brute force over the texts."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm.ngram_join import drop_near_copies, least_common, ngram_components, op9_ngram_join, prefix_size, sketch_counts

from llm_helpers import make_docs  # noqa: F401

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(map(repr, out))


def corpus(seed=1, n=220):
    rng = random.Random(seed)
    words = [a + b for a in "bcdfghjklm" for b in "aeiou"]
    passage = [rng.choice(words) for _ in range(60)]
    texts, base = [], [[rng.choice(words) for _ in range(rng.randint(3, 90))] for _ in range(n // 4)]
    for i in range(n):
        t = list(base[0] if i % 3 == 0 else rng.choice(base))  # a third stem from one text
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        if rng.random() < 0.2:
            t[:0] = passage
        texts.append(" ".join(t))
    return texts


EDGE = ["", None, " \n\t", "one", "ONE", "a b c d", "A  b\nc D", "a b c d e", "é É", "word " * 4000, "word " * 5000]


@pytest.mark.parametrize("how", [{}, {"sketch_bits": 6, "run_block": 8}])
def test_equals_brute_force(spark, make_docs, how):
    rows = list(enumerate(corpus() + EDGE)) + [(None, "null id text of seven words here"), (3, "a b c d"), (900, None)]
    rows.append(rows[4])
    got = ngram_components(make_docs(rows), **how).collect()
    assert sorted(map(repr, map(tuple, got))) == brute(rows)


def test_given_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = op9_ngram_join(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(repr, map(tuple, got))) == brute(rows)


def test_no_rows(make_docs):
    assert ngram_components(make_docs([])).collect() == []


def test_stage_keeps_one_of_each(make_docs):
    docs = make_docs([(1, "a b c d e f"), (2, "A b c d e f"), (3, "x y z"), (4, None), (5, None)])
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4, 5]


def test_prefixes_reach_every_similar_pair():
    for x in range(1, 60):
        for y in range(x, 60):
            need = least_common(x, y, 75)
            assert need == next(i for i in range(200) if 100 * i >= 75 * (x + y - i))
            if need <= x:
                assert prefix_size(x, 75) >= x - need + 1 and prefix_size(y, 75) >= y - need + 1


def test_near_copies_cost_rows_in_proportion(spark, make_docs, monkeypatch):
    """One template with a few own words a document: rows between tasks grow with the documents."""
    import random

    from sluice.llm import ngram_join as N

    plain_staged, made = N.staged, {}

    def counted(df, name):
        out = plain_staged(df, name)
        if name in ("ngram-near", "ngram-judged", "ngram-members", "ngram-links", "ngram-clusters"):
            made["rows"] = made.get("rows", 0) + out.count()
        return out

    monkeypatch.setattr(N, "staged", counted)
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    seen = []
    for n in (60, 120, 240):
        rows = []
        for i in range(n):
            words = list(base)
            for k in rnd.sample(range(120), 3):
                words[k] = f"own{i}x{k}"
            rows.append((i, " ".join(words)))
        made.clear()
        got = {r["doc_id"]: r["component_id"] for r in N.ngram_components(make_docs(rows)).collect()}
        assert got == plain_components(rows)
        seen.append(made["rows"])
    assert seen[2] < 3 * seen[1] and seen[1] < 3 * seen[0], seen


def plain_components(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in rows)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if find(i) != find(j) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def test_what_rounds_leave_is_compared_inside_the_tasks(spark, make_docs, monkeypatch):
    """With rounds that verify nothing, small blocks and small comparisons, the links are the same."""
    import random

    from sluice.llm import ngram_join as N

    rnd = random.Random(9)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(60)]
    rows = []
    for i in range(70):
        words = list(base) if i % 3 else [f"v{k}" for k in range(60)]
        for k in rnd.sample(range(60), rnd.randrange(5)):
            words[k] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(N, "COMPARED", 20000)
    monkeypatch.setattr(N, "_verify", lambda pairs, exact, percent: pairs.selectExpr("c1", "c2", "false AS linked"))
    got = {r["doc_id"]: r["component_id"] for r in N.ngram_components(make_docs(rows), run_block=8).collect()}
    assert got == plain_components(rows)


def test_signatures_bound_what_sets_share():
    import numpy as np

    from sluice.llm import ngram_join as N

    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 9000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n, replace=False)) for n in (1, 5, 40, 300, 700, 2500, 6000)]
    sets.append(np.arange(300, dtype=np.uint64) << np.uint64(30))  # all in one bin: no signature
    sigs = N.Signatures([N.signature(s) for s in sets])
    for i in range(len(sets)):
        most = sigs.most_common(i, np.arange(len(sets)))
        assert all(m >= len(np.intersect1d(sets[i], s)) for m, s in zip(most, sets))


def test_clusters_hold_every_allowed_pair():
    import numpy as np

    from sluice.llm import ngram_join as N

    rng = np.random.default_rng(2)
    for _ in range(200):
        n = np.sort(rng.integers(4, 40, rng.integers(2, 12)))
        place = np.array([rng.integers(0, N.prefix_size(int(x), 75)) for x in n])
        cluster = N.allowed_clusters(n, place, 75)
        for i in range(len(n)):
            for j in range(i + 1, len(n)):
                need = N.least_common(int(n[i]), int(n[j]), 75)
                if 75 * n[j] <= 100 * n[i] and place[i] <= n[i] - need and place[j] <= n[j] - need:
                    assert cluster[i] == cluster[j]


def test_sketch_is_fetched_in_few_jobs(spark, make_docs):
    """Not in one job for every partition of the sums: each leaves something in the driver's memory."""
    docs = make_docs([(i, t) for i, t in enumerate(corpus(n=60))]).repartition(8)
    want = sketch_counts(docs, "text", 5, 16)
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    sc = spark.sparkContext
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup("sketch", "sketch")
        got = sketch_counts(docs, "text", 5, 16)
        jobs = len(sc.statusTracker().getJobIdsForGroup("sketch"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got.tolist() == want.tolist() and got.sum() == sum(len(shingles(t)) for t in corpus(n=60))
    assert 0 < jobs < 12


def test_rounds_judge_no_pair_twice(spark, make_docs, monkeypatch):
    """And find what was judged by folders: a list of files has jobs of its own."""
    from sluice.llm import ngram_join as m

    judged = []

    def verify(pairs, exact, percent, f=m._verify):
        judged.extend((r["c1"], r["c2"]) for r in pairs.collect())
        return f(pairs, exact, percent)

    def listed(self):
        raise AssertionError("the files of a round are listed")

    monkeypatch.setattr(m, "_verify", verify)
    monkeypatch.setattr(type(spark.range(0)), "inputFiles", listed)
    rows = [(i, t) for i, t in enumerate(corpus(seed=5))]
    assert sorted(repr(tuple(r)) for r in ngram_components(make_docs(rows)).collect()) == brute(rows)
    assert judged and len(judged) == len(set(judged))


def test_driver_holds_no_counts_of_the_sketch(spark, make_docs, monkeypatch):
    """Its cells' places alone leave the tasks: a byte each, not eight."""
    fetched, frame = [], type(spark.range(0))

    def to_arrow(self, f=frame.toArrow):
        fetched.append(f(self))
        return fetched[-1]

    monkeypatch.setattr(frame, "toArrow", to_arrow)
    rows = [(i, t) for i, t in enumerate(corpus(n=40))]
    assert sorted(repr(tuple(r)) for r in ngram_components(make_docs(rows)).collect()) == brute(rows)
    assert fetched and sum(t.nbytes for t in fetched) < 3 << 20


def test_order_is_that_of_the_counts(spark, make_docs):
    from sluice.llm.ngram_join import sketch_order

    often = [(1000 + i, f"a b c d e {i}") for i in range(40)]
    docs = make_docs([(i, t) for i, t in enumerate(corpus(n=60))] + often).repartition(3)
    counts = sketch_counts(docs, "text", 5, 16)
    order, blocks = sketch_order(docs, "text", 5, 16, 10)
    assert order.dtype == np.uint8
    assert order.tolist() == [min(255, int(8 * np.log2(c + 1))) for c in counts.tolist()]
    usual = np.median(counts[counts > 0])
    assert blocks and set(blocks) == set(np.flatnonzero(counts - usual > 10).tolist())
    assert all(n == -(-(counts[c] - usual) // 10) for c, n in blocks.items())
    order, blocks = sketch_order(docs.where("false"), "text", 5, 16, 10)
    assert not order.any() and blocks == {}


def components(links) -> list[tuple[int, int]]:
    low = {x: x for ab in links for x in ab}
    while any(low[a] != low[b] for a, b in links):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return sorted(low.items())


def test_tasks_join_their_links_first(spark):
    """A long chain that a task holds needs no rounds of joins; links dealt over tasks give the same components."""
    from sluice.llm.common import connected_components

    chain = [(i + 1, i) for i in range(300)] + [(1000 + 2 * i, 1002 + 2 * i) for i in range(50)] + [(2000, 5), (7, 7)]
    random.Random(3).shuffle(chain)
    want = components([(a, b) for a, b in chain if a != b])
    links = spark.createDataFrame(chain, "a long, b long")
    sc = spark.sparkContext
    try:
        sc.setJobGroup("chain", "chain")
        got = connected_components(links)
        jobs = len(sc.statusTracker().getJobIdsForGroup("chain"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(tuple, got.collect())) == want
    assert 0 < jobs < 8
    conf = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert sorted(map(tuple, connected_components(links).collect())) == want
        assert connected_components(links.where("false")).collect() == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_stars_hold_a_bounded_number_of_links(monkeypatch):
    from sluice.llm import common

    monkeypatch.setattr(common, "HELD_LINKS", 8)
    rng = random.Random(8)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(90)]
    links = [(a, b) for a, b in links if a != b]
    batches = [
        pa.RecordBatch.from_pydict({"u": [a for a, _ in links[k : k + 5]], "v": [b for _, b in links[k : k + 5]]})
        for k in range(0, len(links), 5)
    ]
    out = list(common.stars(iter(batches)))
    assert len(out) == -(-len(batches) // 2)
    left = [(a, b) for x in out for a, b in zip(x.column("u").to_pylist(), x.column("v").to_pylist(), strict=True)]
    assert components(left) == components(links) and all(a > b for a, b in left)
    assert list(common.stars(iter([]))) == []
