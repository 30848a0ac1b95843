"""Text rules against plain Python on edge cases and random payloads."""

import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from tallyline.functions import text


def find(pattern, payload):
    match = re.search(pattern, payload or "")
    return match.group(1) if match else ""


def python_string(payload, key):
    return find(rf'"{re.escape(key)}"\s*:\s*"([^"]*)"', payload)


def python_number(payload, key, quotes=True):
    return find(rf'"{re.escape(key)}"\s*:\s*{chr(34) + "?" if quotes else ""}([0-9.\-]+)', payload)


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def evaluated(spark, values, column):
    rows = texts(spark, values).select("i", column.alias("r")).collect()
    return [row["r"] for row in sorted(rows)]


EDGE_CASES = [
    '{"event_id": "evt1", "rate": 3.5}',
    '{"event_id":"", "rate": "3.25"}',
    '{"outer": {"event_id": "nested"}, "event_id": "later", "rate": -1.5}',
    '{"event_id": "broken',
    'not json "event_id" : "found" "rate":"',
    '{"event_id": "stops at \\" the quote", "rate": "abc"}',
    '{"event_id": 12, "rate": 1.2.3-4}',
    '{"event_id"\n:\t"over lines"}',
    '{"event_id": "first", "event_id": "second"}',
    '{"xevent_id": "no", "rate ": 1}',
    "",
    None,
]


@pytest.mark.parametrize("key", ["event_id", "rate", "a.b", "x\\E(", "*"])
def test_strings_and_numbers_on_edge_cases(spark, key):
    cases = EDGE_CASES + [f'{{"{key}": "v", "n": 1}}', f'{{"{key}":7}}']
    assert evaluated(spark, cases, text.json_string("v", key)) == [
        python_string(c, key) for c in cases
    ]
    for quotes in (True, False):
        assert evaluated(spark, cases, text.json_number("v", key, quotes)) == [
            python_number(c, key, quotes) for c in cases
        ]


def test_random_payloads(spark):
    source = random.Random(7)
    pieces = ['"k"', ":", " ", '"', "1", ".", "-", "a", "\t", "\u00a0", "\x1c", "{", "}", ",", "\\"]
    cases = ["".join(source.choices(pieces, k=source.randint(0, 25))) for _ in range(3000)]
    assert evaluated(spark, cases, text.json_string("v", "k")) == [
        python_string(c, "k") for c in cases
    ]
    assert evaluated(spark, cases, text.json_number("v", "k")) == [
        python_number(c, "k") for c in cases
    ]


def test_every_space_python_knows(spark):
    # U+0000 to U+FFFF without the surrogate range, which is no text
    spaces = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i <= 0xDFFF]
    assert sys.maxunicode > 0xFFFF
    assert evaluated(spark, spaces, text.is_blank("v")) == [c.strip() == "" for c in spaces]
    cases = [f'"k"{c}:{c}"v"' for c in spaces if c.isspace()]
    assert set(evaluated(spark, cases, text.json_string("v", "k"))) == {"v"}


def test_blank_and_empty(spark):
    cases = [None, "", " ", "\t\n", "a", " a ", "\n"]
    assert evaluated(spark, cases, text.is_blank("v")) == [
        c is None or c.strip() == "" for c in cases
    ]
    assert evaluated(spark, cases, text.is_empty("v")) == [not c for c in cases]


def python_float(value):
    try:
        return None if value is None else float(value)
    except ValueError:
        return None


def test_parse_rate_agrees_with_python(spark):
    source = random.Random(11)
    cases = ["".join(source.choices("0123456789.-", k=source.randint(0, 6))) for _ in range(2000)]
    cases += ["3.5d", "3.5f", "1e3", "1E-2", " 4.5 ", "\u00a04.5", "+2", "inf", "-Infinity", "0x1", None]
    assert evaluated(spark, cases, text.parse_rate("v")) == [python_float(c) for c in cases]


def test_render_replaces_in_order_and_does_not_escape(spark):
    row = spark.createDataFrame(
        [("<a>{{LOAN_ID}}|{{EVENT_ID}}|{{NEW_RATE}}|{{LOAN_ID}}</a>", "{{EVENT_ID}}<&>", "e{{LOAN_ID}}", None)],
        "t string, loan_id string, event_id string, new_rate string",
    )
    empty = F.lit(None).cast("string")
    out = row.select(
        text.render_template(
            "t", effective_date=empty, amendment_type=empty, new_term_months=empty
        ).alias("r")
    ).first()["r"]
    # the token inside the loan id is filled in later, the one inside the event id is not
    assert out == "<a>e{{LOAN_ID}}<&>|e{{LOAN_ID}}||e{{LOAN_ID}}<&></a>"


def test_render_without_template(spark):
    nothing = F.lit(None).cast("string")
    fields = {name: F.lit("x") for name in text.TEMPLATE_TOKENS.values()}
    assert spark.range(1).select(text.render_template(nothing, **fields).alias("r")).first()["r"] == ""
