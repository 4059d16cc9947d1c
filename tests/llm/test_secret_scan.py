"""Secret scans against brute force: patterns, places, chains and overlaps."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from sluice.llm import secret_scan as S

from llm_helpers import make_docs  # noqa: F401

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base_spans(text):
    out = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return out + [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= 24]


def plain(rows, threshold=S.THRESHOLD):
    texts = [t or "" for _, t in rows]
    secrets, words = set(), set()
    for text in texts:
        for kind, _, _, value in base_spans(text):
            if kind != "assign" or re.search("[0-9]", value):
                secrets |= set(re.findall(r"[A-Za-z0-9+/_=-]+", value))
        for pattern in (S.ASSIGN, S.ACCESS, S.HEX):
            text = re.compile(pattern, re.ASCII).sub(" ", text)
        words |= {w for w in re.findall(r"[A-Za-z0-9+/_-]{8,}", text)
                  if not re.search("[A-Za-z][0-9]|[0-9][A-Za-z]|[a-z][A-Z]", w)}
    chains = []
    for tokens in (secrets, words):
        pairs = Counter(t[i : i + 2] for t in tokens for i in range(len(t) - 1))
        chains.append((pairs, Counter(p[0] for p in pairs.elements())))

    def odds(token):
        total = 0
        for i in range(len(token) - 1):
            pair = token[i : i + 2]
            ps = [(pairs[pair] + 1) / (firsts[pair[0]] + 67) for pairs, firsts in chains]
            total += round(1000 * (math.log(ps[0]) - math.log(ps[1])))
        return total

    order = ("assign", "access", "hex", "random")
    out = []
    for (i, _), text in zip(rows, texts, strict=True):
        base = [s[:3] for s in base_spans(text)]
        added = [("random", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}={0,2}", text)
                 if not any(s < m.end() and m.start() < e for _, s, e in base) and odds(m[0]) > 1000 * threshold]
        show = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], order.index(x[0]))))
        n = Counter(k for k, _, _ in base + added)
        out.append((i, *[n[k] for k in order], hashlib.sha256(show(base).encode()).hexdigest(), show(base + added)))
    return sorted(out, key=repr)


rnd = random.Random(4)
HEXES = ["".join(rnd.choices("0123456789abcdef", k=40)) for _ in range(30)]
TOKENS = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=32)) for _ in range(12)]
WORDS = ["international_exchange", "understanding-of-things", "documentation", "responsibilities", "administrator",
         "configuration", "measurements", "Transportation", "/usr/local/share/doc", "20240310101500", "4111111111111111"]
ROWS = [
    (1, 'token = "' + HEXES[0] + '" then'), (2, "password=b7db7aa4a5fcc78305"), (3, "PassWd' : \"hunter2!\" secret:abc secret: abcdef"),
    (4, None), (5, ""), (6, "token=token:abcdef12"), (7, "API_KEY=" + HEXES[1] + " apikey = x.y=z/123"), (8, "AKIA" + "Q7" * 8 + " AKIAshort"),
    (9, "é" * 5 + " 🙂 " + HEXES[2] + " AKIA" + "Z" * 20), (10, "Key ſecret=abcdefgh toKen=abcdefgh"),
    (11, f"see {TOKENS[0]} and {TOKENS[1]}=="), (11, f"see {TOKENS[0]} and {TOKENS[1]}=="), (None, TOKENS[2]),
    (12, " ".join(WORDS * 3)), (13, "secret=" + TOKENS[3] + "." + TOKENS[4]), (14, "x" * 50000 + " " + TOKENS[5] * 300),
    (15, f"{HEXES[3]}{HEXES[4]}-{TOKENS[6]}"), (16, "ab\nSECRET\n=\nvalue secret = \nvalue9 token:'a" + HEXES[5]),
    (17, " ".join(f"password={h} word {t}" for h, t in zip(HEXES, TOKENS * 3))), (18, "token" + " " * 5000 + "= abc123def"),
    *[(100 + i, f"{w} {h} {w.upper()}") for i, (w, h) in enumerate(zip(WORDS * 2, HEXES[8:]))],
]
COLUMNS = ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("threshold", [12.0, -1000.0])
def test_equals_brute_force(make_docs, threshold):
    assert got(S.scan_secrets(make_docs(ROWS), threshold=threshold)) == plain(ROWS, threshold)


def test_finds_random_strings_and_leaves_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    planted = [(10**9 + i, f"see {''.join(rnd.choices(letters, k=40))} here") for i in range(40)]
    planted += [(10**9 + 40 + i, f"see {''.join(rnd.choices('0123456789abcdef', k=20))} here") for i in range(40)]
    rows = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    found = {r["doc_id"] for r in S.scan_secrets(rows).where("n_random > 0").collect()}
    planted_ids = {i for i, _ in planted}
    assert found <= planted_ids and len(found) >= 0.95 * len(planted_ids)


def test_null_and_empty_texts(make_docs):
    rows = {r["doc_id"]: r for r in S.scan_secrets(make_docs(ROWS)).collect()}
    assert rows[4]["spans"] == rows[5]["spans"] == "" and rows[4]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table_and_no_samples(make_docs):
    assert S.scan_secrets(make_docs([])).collect() == []
    assert [r["spans"] for r in S.scan_secrets(make_docs([(1, "a b c"), (2, None)])).collect()] == ["", ""]


def test_no_python_in_the_plan(make_docs):
    plan = S.scan_secrets(make_docs(ROWS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
