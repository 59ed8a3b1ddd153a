import hashlib

import pytest

from tests.llm import plain
from tidemark.llm import order_minhash as omh


def brute(rows):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].encode()))
    result = []
    for at, (id_, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        changed = omh.edited(text, following)
        one, other, third = map(omh.fingerprint, (text, changed, following))
        result.append((
            id_, len(text), hashlib.sha256(changed.encode()).hexdigest(), omh.as_text(one), omh.as_text(other),
            omh.likeness(one, other), omh.likeness(one, third),
        ))
    return sorted(result, key=str)


@pytest.mark.parametrize("rows", [
    [r[:2] for r in plain.ODD],
    [(1, "abc")],
    [(None, "a"), (None, "b")],
    [(-5, "x" * 40), (3, "y" * 9), (3, "y" * 9), (2**60, "é𝄞 " * 30)],
])
def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, kind string, block int")
    assert sorted(map(tuple, omh.compare_with_next(docs).collect()), key=str) == brute(rows)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(omh, "BLOCK_TEXT", 200)
    rows = [(i * 7 % 997, f"text {i} " * (i % 9)) for i in range(997)]
    found = omh.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_empty_table(spark):
    assert omh.compare_with_next(plain.none(spark)).collect() == []


def test_windows_are_numbered_and_order_counts():
    text = "the quick brown fox jumps over the lazy dog and runs away from it " * 8
    halves = text[len(text) // 2 + 5 :] + text[: len(text) // 2 + 5]
    assert omh.likeness(omh.fingerprint(text), omh.fingerprint(text)) == 1.0
    assert omh.likeness(omh.fingerprint(text), omh.fingerprint(halves)) < 1.0
    assert omh.likeness(omh.fingerprint("a" * 30), omh.fingerprint("a" * 60)) < 1.0
    assert omh.likeness(omh.fingerprint(""), omh.fingerprint("")) == 1.0
    assert omh.likeness(omh.fingerprint(""), omh.fingerprint("a")) == 0.0


def test_likeness_falls_with_edits():
    import random

    random.seed(2)
    text = "".join(random.choice("abcdefghij ") for _ in range(4000))
    previous = 1.0
    for edits in (4, 40, 400):
        changed = list(text)
        for at in random.sample(range(len(text)), edits):
            changed[at] = "Z"
        now = omh.likeness(omh.fingerprint(text), omh.fingerprint("".join(changed)))
        assert now < previous
        previous = now
