"""Source divergence against brute force in whole numbers, with odd rows and small slices."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluice.llm import source_divergence as S

from llm_helpers import DOC_SCHEMA

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, min_docs=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]  # (text, lang, source)
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text)]
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        names = sorted(s for a, s in count if a == lang)
        p = {}
        for name in [None, *names]:
            have = sum((count[lang, s] for s in names), Counter()) if name is None else count[lang, name]
            words = sum(have[t] for t in kept)
            p[name] = {t: 1 + 10**9 * (have[t] + 1) // (words + len(kept)) for t in kept}
        for s in names:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in names if o != s]
            terms = [(t, (p[s][t] - p[None][t]) ** 2 // p[None][t]) for t in kept
                     if count[lang, s][t] and p[s][t] > p[None][t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


ROWS = [
    ("The cat sat on the mat", "en", "a"), ("the CAT é x", "en", "b"), ("the cat the dog", "en", "a"), ("dog cat mat", "en", None),
    ("dog, mat; dog-mat", "en", "b"), (None, "en", "empty"), ("", "fr", "one"), ("le chat", "fr", None), ("le chat le chat", None, None),
    ("le chat", None, "x"), ("le chat", None, "x"), ("le chat le", "", "y"), ("déjà vu Ünï", "en", "c"), ("déjà vu", "en", "c"),
    ("déjà VU vu", "en", "a"), ("a1b2c3", "en", "d"), ("lonely", "es", "only"), ("the " * 30 + "dog", "en", "hot"), ("12 34", "de", "n"),
]


def frame(spark, rows):
    full = [(i, r[0], r[1], r[2], None, "t", 7) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, DOC_SCHEMA + ", term string, n int")


def got(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("how", [{}, {"min_docs": 1, "top_terms": 2}])
def test_equals_brute_force(spark, how):
    want = plain(ROWS, how.get("min_docs", 3), how.get("top_terms", 200))
    assert got(S.source_divergence(frame(spark, ROWS), **how)) == want


def test_empty_table(spark):
    assert got(S.source_divergence(frame(spark, []))) == []


def test_random_sources(spark):
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 60), p=None)), f"l{i % 2}", f"s{min(int(rng.zipf(1.4)), 12)}")
            for i in range(300)]
    assert got(S.source_divergence(frame(spark, rows), min_docs=4)) == plain(rows, 4)


def test_slices_and_steps_do_not_matter(monkeypatch):
    rng = np.random.default_rng(5)
    term = np.sort(rng.integers(0, 40, 300))
    group = rng.integers(0, 9, 300).astype(np.int64)
    keep = np.unique(np.stack([term, group]), axis=1)
    term, group = np.unique(keep[0], return_inverse=True)[1], keep[1]
    p, p0 = rng.integers(5, 10**6, len(term)), (group + 1) * 3
    want = defaultdict(int)
    for i in range(len(term)):
        for j in range(len(term)):
            if term[i] == term[j] and group[i] != group[j]:
                f = S.divergence
                want[group[i], group[j]] += int(f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j]))
    for gather in (1 << 20, 7):
        monkeypatch.setattr(S, "GATHER", gather)
        have = {(r, q): v for r, peers, sums in S.accumulate_rows(term, group, p, p0, 9)
                for q, v in zip(peers.tolist(), sums.tolist(), strict=True)}
        assert have == dict(want)


def test_blocks_keep_terms_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(S, "BLOCK", 3)
    rows = [("x", 1, 0), ("x", 2, 1), ("x", 1, 0), ("x", 2, 1), ("x", 1, 0), ("y", 1, 0), ("y", 1, 0)]
    table = pa.table({"lang": [r[0] for r in rows], "nth": [r[1] for r in rows], "gid": [r[2] for r in rows],
                      "p": [5] * 7, "p0": [2] * 7, "size": [2] * 7})
    cut = [(lang, c["nth"].tolist()) for c, lang, _ in S._slices(iter(table.to_batches(max_chunksize=3)))]
    assert sum((n for _, n in cut), []) == [r[1] for r in rows]
    assert all(n[0] == 1 for _, n in cut) and {lang for lang, _ in cut} == {"x", "y"}


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(S, "TEXT_CHUNK", 5)
    text = "ab cdefghijkl  mn,OP é" * 20
    flat = [t for part in S.term_chunks(text.encode()) for t in part]
    assert flat == [t.translate(LOWER).encode() for t in TERM.findall(text)]


def test_smoothing_beyond_the_first_product(spark):
    n, words, kept = 9 * 10**12, 4 * 10**13, 10**6
    row = spark.range(1).select(S.smoothed(f"{n}L", f"{words}L", f"{kept}L").alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 1) // (words + kept)
