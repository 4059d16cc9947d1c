"""Exact dedup and mixing against DuckDB and brute force, with odd rows."""

import duckdb
import pytest

from sluice.llm.exact_dedup import OP3_SQL, drop_copies, exact_dedup, op3_exact_dedup
from sluice.llm.mixing import OP10_SQL, mix_sources, op10_mixing

from llm_helpers import SF001, make_docs  # noqa: F401

LONG = "prefix shared by all " * 400
ROWS = [
    (1, "Same"), (2, "same"), (3, "sAme "), (4, None), (5, ""), (6, LONG + "a"), (7, LONG + "b"), (8, (LONG + "a").upper()),
    (9, "É"), (10, "é"), (11, "same"), (11, "same"), (12, "x" * 31), (13, "x" * 32), (14, "x" * 33), (15, "x" * 33), (None, "same"),
    (None, "only null"), (16, "y" * 200000), (17, "y" * 200000), (18, "y" * 199999 + "z"),
]


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate({c: c + 32 for c in range(65, 91)}), []).append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(map(repr, out))


@pytest.mark.parametrize("how", [{}, {"first_width": 1, "growth": 3}])
def test_exact_equals_brute_force(spark, make_docs, how):
    got = exact_dedup(make_docs(ROWS), **how).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == plain(ROWS)


def test_hot_group(make_docs):
    rows = [(i, LONG if i % 3 == 0 else f"{LONG}{i}") for i in range(300)]
    got = exact_dedup(make_docs(rows)).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(map(repr, map(tuple, got))) == plain(rows)


def test_exact_stage(make_docs):
    docs = make_docs(ROWS)
    left = drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.where("doc_id is not null").collect()) == [3, 5, 7, 8, 9, 10, 11, 12, 13, 15, 17, 18]
    assert left.where("doc_id is null").count() == 2
    assert exact_dedup(make_docs([])).collect() == [] and drop_copies(make_docs([])).collect() == []


def duck(sql, arrow):
    con = duckdb.connect()
    con.register("documents", arrow)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(repr({k: round(v, 6) if isinstance(v, float) else v for k, v in zip(names, r)}) for r in cur.fetchall())


def spark_rows(df, columns):
    return sorted(
        repr({k: round(r[k], 6) if isinstance(r[k], float) else r[k] for k in columns}) for r in df.collect()
    )


def test_given_tables_equal_duckdb(spark):
    arrow = spark.read.parquet(f"{SF001}/documents.parquet").toArrow()
    assert spark_rows(op3_exact_dedup(spark, SF001), ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]) == duck(OP3_SQL, arrow)
    assert spark_rows(op10_mixing(spark, SF001), ["doc_id", "size", "source_size", "target", "taken"]) == duck(OP10_SQL, arrow)


MIX = [
    [(i, "w " * (i % 7), f"s{i % 3}") for i in range(200)],
    [(i, "w " * 10, "big" if i % 3 else "small") for i in range(90)] + [(500, "one two", None), (501, None, None), (502, "", "empty")],
    [(1, "a b c", "s")], [(1, None, "s")], [(1, "a", None), (None, "b c", "t"), (None, "b c", "t"), (1, "a", None)],
    [(i, "w " * (1 + i % 5), chr(97 + i % 26)) for i in range(300)],
]


@pytest.mark.parametrize("rows", MIX)
def test_mixing_equals_duckdb_and_keeps_its_promises(make_docs, rows):
    docs = make_docs(rows)
    got = mix_sources(docs, range_rows=16)
    assert spark_rows(got, ["doc_id", "size", "source_size", "target", "taken"]) == duck(OP10_SQL, docs.toArrow())
    by = {}
    for r in got.collect():
        assert 0 <= r["taken"] <= 2 * r["size"]
        s = by.setdefault(r["source"], [0, r["target"], r["source_size"]])
        s[0] += r["taken"]
    for taken, target, size in by.values():
        assert abs(taken - target) <= 0.5 and target <= 2 * size
    total = sum(s[2] for s in by.values())
    assert sum(s[1] for s in by.values()) == pytest.approx(1.5 * total)


def test_targets_by_repeated_sharing(make_docs):
    """The running-sum level equals dealing the excess again and again."""
    rows = MIX[5] + [(1000 + i, "w " * 400, "zz") for i in range(3)]
    got = {r["source"]: (r["target"], r["source_size"]) for r in mix_sources(make_docs(rows)).collect()}
    names = sorted(got)
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, free, target = 1.5 * sum(s for _, s in got.values()), set(names), dict.fromkeys(names, 0.0)
    while True:
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > 2 * got[n][1]}
        if not over:
            target.update(share)
            break
        for n in over:
            target[n] = 2.0 * got[n][1]
            left -= target[n]
        free -= over
    assert all(target[n] == pytest.approx(got[n][0]) for n in names)


def test_mixing_no_rows(make_docs):
    assert mix_sources(make_docs([])).collect() == []
