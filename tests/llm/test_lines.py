"""Lines that many documents share: against a slow version."""

import random
import re
from collections import Counter

import pytest

from quayside.llm import line_dedup


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def slow(rows, min_docs, min_points=1):
    counts = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")})
    found = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_points or counts[key(x)] < min_docs]
        found.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


ODD = [
    None,
    "",
    "\n",
    "a\n",
    "\na",
    " A \x0b\na\n\n\tb",
    " a\na \n\u0085a",
    "É\né\nÉ",
    "a\x00\na",
    "x\r\nX \r\n x",
    "common line\n" * 3000 + "own",
    "a\na\na",
]


def answers(docs, **options):
    return sorted(map(tuple, line_dedup.line_verdicts(docs, **options).collect()), key=repr)


@pytest.mark.parametrize("min_docs", [1, 2, 4])
def test_odd_texts(docs, min_docs):
    rows = list(enumerate(ODD)) + [(None, "a"), (None, "a"), (3, "a\n"), (3, "b"), (3, "a\n")]
    assert answers(docs(*rows), min_docs=min_docs) == slow(rows, min_docs)


def test_random_texts_and_short_keys(docs):
    pick = random.Random(5)
    words = ["alpha", "Beta ", "\tgamma", "ab", "AB", "", "ö", "same as ever", "x"] + [f"w{i}" for i in range(40)]
    rows = [(i, "\n".join(pick.choice(words) for _ in range(pick.randrange(12)))) for i in range(120)]
    assert answers(docs(*rows)) == slow(rows, 10)
    assert answers(docs(*rows), min_docs=5, min_points=3) == slow(rows, 5, 3)


def test_a_line_of_all_documents_and_a_long_text_that_loses_every_other_line(docs):
    rows = [(i, f"Hot\nown {i}") for i in range(300)]
    rows += [(1000 + i, "\n".join(f"{'hot' if n % 2 else f'line {i} {n}'}" for n in range(20_000))) for i in range(2)]
    assert answers(docs(*rows, parts=7)) == slow(rows, 10)


def test_an_empty_table(docs):
    assert answers(docs()) == []


def test_columns_of_any_name_stay(docs):
    rows = [(i, "Hot\nown") for i in range(10)] + [(77, None), (78, "only")]
    clashing = docs(*rows).selectExpr(
        "doc_id", "text", "doc_id AS row", "1 AS gone", "2 AS name", "3 AS lines", "4 AS row_key", "5 AS at", "6 AS `a.b`"
    )
    kept = line_dedup.drop_common_lines(clashing)
    assert kept.columns == clashing.columns
    found = {r.doc_id: r for r in kept.collect()}
    assert {i: r.text for i, r in found.items()} == {i: "" for i in range(10)} | {77: None, 78: "only"}
    assert all(tuple(r)[2:] == (i, 1, 2, 3, 4, 5, 6) for i, r in found.items())


def test_no_python_in_the_plan(docs):
    plan = line_dedup.line_verdicts(docs((1, "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
