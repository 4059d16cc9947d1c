"""Cell cleaners against the FIXTURES.md tables, ANSI on and off, two zones."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, StringType

from sluice.functions import cells

from conftest import AS_OF

D = dt.datetime


def run(spark, values, fn, in_type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {in_type}")
    out = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]


def ts_full(c):
    clock = cells.as_of_col(AS_OF)
    return cells.timestamp_in_range(cells.to_timestamp_cell(c, StringType(), clock), clock).cast("timestamp_ntz")


TS_CASES = [
    (None, None), ("", None), ("n/a", None), ("abc", None), ("unknown", None), ("999", None),
    ("2024-03-10 01:02:03", D(2024, 3, 10, 1, 2, 3)),
    ("03/10/2024", D(2024, 3, 10)), ("13/10/2024", D(2024, 10, 13)),
    ("Mar 10, 2024", D(2024, 3, 10)), ("March 10, 2024", D(2024, 3, 10)),
    ("10-Mar-24", D(2024, 3, 10)), ("20240310", D(2024, 3, 10)),
    ("2024-03-10 1:02 PM", D(2024, 3, 10, 13, 2)), ("2024-13-45", None), ("2020", D(2020, 1, 1)),
    ("10:30", None), ("1899-12-31", None), ("1900-01-01", D(1900, 1, 1)),
    ("2025-12-31", D(2025, 12, 31)), ("2026-01-01", None),
    ("05-Jan-95", D(1995, 1, 5)), ("3/1/2024 13:02:03", D(2024, 3, 1, 13, 2, 3)),
]


@pytest.mark.parametrize("ansi_on", [True, False])
def test_timestamp_table(spark, ansi, ansi_on):
    ansi(ansi_on)
    got = run(spark, [v for v, _ in TS_CASES], ts_full)
    assert got == [e for _, e in TS_CASES]


def test_timestamp_with_offset_is_converted(spark, zone):
    zone("America/New_York")
    assert run(spark, ["2024-03-10T01:02:03Z"], ts_full) == [D(2024, 3, 9, 20, 2, 3)]
    zone("UTC")
    assert run(spark, ["2024-03-10T01:02:03Z"], ts_full) == [D(2024, 3, 10, 1, 2, 3)]
    # naive text is wall clock in any zone
    assert run(spark, ["03/10/2024"], ts_full) == [D(2024, 3, 10)]


def test_future_policies(spark):
    clock = cells.as_of_col(AS_OF)
    vals = ["2025-12-31 00:00:00", "2024-01-01 00:00:00"]
    for policy, expect in [
        ("keep", [D(2025, 12, 31), D(2024, 1, 1)]),
        ("clamp", [D(2024, 6, 1, 12), D(2024, 1, 1)]),
        ("null", [None, D(2024, 1, 1)]),
    ]:
        got = run(spark, vals, lambda c: cells.apply_future_policy(
            cells.to_timestamp_cell(c, StringType(), clock), clock, policy).cast("timestamp_ntz"))
        assert got == expect, policy


DATE_CASES = [
    ("2024-02-29", dt.date(2024, 2, 29)), ("2023-02-29", None), ("02/29/2024", dt.date(2024, 2, 29)),
    ("2030-01-01", dt.date(2030, 1, 1)), ("01/01/2030", None), ("abc", None), ("", None), ("12", None),
    (None, None), ("Mar 1, 2024", dt.date(2024, 3, 1)),
]


@pytest.mark.parametrize("ansi_on", [True, False])
def test_date_table(spark, ansi, ansi_on):
    ansi(ansi_on)
    clock = cells.as_of_col(AS_OF)
    got = run(spark, [v for v, _ in DATE_CASES], lambda c: cells.to_date_cell(c, StringType(), clock))
    assert got == [e for _, e in DATE_CASES]


NUM_CASES = [
    ("12", Decimal(12), 12.0), ("12.7", Decimal(13), 12.7), ("-12.5", Decimal(-13), -12.5),
    ("1,234", Decimal(1234), 1234.0), (" 7 ", Decimal(7), 7.0), ("12\n", Decimal(12), 12.0),
    ("+5", None, None), (".5", None, None), ("5.", None, None), ("1e3", None, None), ("$5", None, None),
    ("\t9", None, None), ("", None, None), (None, None, None), ("9" * 39, None, 1.0e39),
]


@pytest.mark.parametrize("ansi_on", [True, False])
def test_numbers_from_text(spark, ansi, ansi_on):
    ansi(ansi_on)
    vals = [v for v, _, _ in NUM_CASES]
    dec = run(spark, vals, lambda c: cells.to_number_cell(c, StringType(), DecimalType(38, 0)))
    dbl = run(spark, vals, lambda c: cells.to_number_cell(c, StringType(), DoubleType()))
    assert dec == [d for _, d, _ in NUM_CASES]
    assert dbl == [x for _, _, x in NUM_CASES]


def test_numbers_from_typed_input(spark):
    # a double is not printed and re-parsed (1.0E7 would fail the pattern)
    dec = run(spark, [1.0e7, 0.0005], lambda c: cells.to_number_cell(c, DoubleType(), DecimalType(38, 0)),
              "double")
    dbl = run(spark, [1.0e7, 0.0005], lambda c: cells.to_number_cell(c, DoubleType(), DoubleType()), "double")
    assert dec == [Decimal(10000000), Decimal(0)]
    assert dbl == [1.0e7, 0.0005]


BOOL_CASES = [
    ("TRUE", True, "TRUE"), ("1", True, "TRUE"), ("yes", True, "TRUE"), ("T", True, "TRUE"),
    ("false", False, "FALSE"), ("0", False, "FALSE"), ("No", False, "FALSE"), ("f", False, "FALSE"),
    (" true", None, " true"), ("y", None, "y"), ("n", None, "n"), ("2", None, "2"), ("", None, ""),
    (None, None, None),
]


def test_boolean_and_boolean_text(spark):
    vals = [v for v, _, _ in BOOL_CASES]
    assert run(spark, vals, lambda c: cells.to_boolean_cell(c, StringType())) == [b for _, b, _ in BOOL_CASES]
    assert run(spark, vals, lambda c: cells.boolean_text_cell(c, StringType())) == [s for _, _, s in BOOL_CASES]


JSON_KEPT = ['{"a":1}', "[1,2]", "1", '"x"', "null", '{"a":1,"a":2}', " 1 "]
JSON_NULL = ["{'a':1}", "{a:1}", '{"a":1,}', '{"a":01}', "", "nul", '{"a":1} x', '{"a":1},', "1,2",
             "1],[2", '1}, {"x":2', "NaN", '{"a":NaN}', "-Infinity"]


def test_json_table(spark):
    got = run(spark, JSON_KEPT + JSON_NULL + [None], lambda c: cells.json_text_cell(c, StringType()))
    assert got == JSON_KEPT + [None] * (len(JSON_NULL) + 1)


def _py_json_ok(s):
    try:
        json.loads(s)
    except ValueError:
        return False
    return not any(tok in s for tok in ("NaN", "Infinity"))


def test_json_matches_python_on_generated_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list('{}[]:,"ab01 .-eE'))
    samples = []

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet, min_size=1, max_size=12))
    def collect(s):
        samples.append(s)

    collect()
    got = run(spark, samples, lambda c: cells.json_text_cell(c, StringType()))
    expect = [s if _py_json_ok(s) else None for s in samples]
    mismatches = [(s, g, e) for s, g, e in zip(samples, got, expect) if g != e]
    assert not mismatches, mismatches[:10]


def test_junk_and_garbage_flags(spark):
    got = run(spark, ["abc", "ab1", "12", "2024-01-01"], lambda c: cells.is_junk_time_text(c))
    assert got == [True, True, True, False]


def _py_number(s):
    """Independent model: strip commas, trim spaces, anchored pattern, half-up to scale 0."""
    import re
    from decimal import ROUND_HALF_UP, Decimal as Dec

    if s is None:
        return None, None
    cleaned = s.replace(",", "").strip(" ")
    m = re.search(r"^-?\d+(\.\d+)?$", cleaned)
    if not m:
        return None, None
    text = m.group(0)
    from decimal import localcontext

    with localcontext() as ctx:
        ctx.prec = 80
        dec = Dec(text).quantize(Dec(1), rounding=ROUND_HALF_UP)
    dec = dec if len(dec.as_tuple().digits) <= 38 else None
    return dec, float(text)


def test_numbers_match_python_model_on_generated_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("0123456789,.- +\n\tx5"))
    samples = []

    @settings(max_examples=500, deadline=None)
    @given(st.text(alphabet, min_size=0, max_size=14))
    def collect(s):
        samples.append(s)

    collect()
    samples += ["9" * 38 + ".5", "9" * 38, "-" + "9" * 39]
    dec = run(spark, samples, lambda c: cells.to_number_cell(c, StringType(), DecimalType(38, 0)))
    dbl = run(spark, samples, lambda c: cells.to_number_cell(c, StringType(), DoubleType()))
    bad = []
    for s, d, x in zip(samples, dec, dbl):
        ed, ex = _py_number(s)
        if d != ed or x != ex:
            bad.append((s, d, ed, x, ex))
    assert not bad, bad[:10]


def test_json_from_nested_input(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (2, None)], "i int, m map<string,int>")
    got = [r["r"] for r in df.select("i", cells.json_text_cell(F.col("m"), df.schema["m"].dataType).alias("r"))
           .orderBy("i").collect()]
    assert got == ['{"a":1}', None]
