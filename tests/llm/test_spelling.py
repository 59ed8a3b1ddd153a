import re
import zlib
from collections import Counter

import pytest

from tests.llm import plain
from tests.llm.test_queries import FOLDER
from tidemark.llm import queries, spelling
from tidemark.llm.tables import table

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_words(rows, edit=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = plain.folded(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if edit and h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    end = max(len(a), len(b)) - start
    return any(a[start + i :] == b[start + j :] for i, j in ((1, 1), (1, 0), (0, 1))) and end > 0


def brute(counts):
    holes = {}  # words that are equal but for one place share a string with that place left out or marked
    for word in counts:
        for i in range(len(word)):
            holes.setdefault(word[:i] + word[i + 1 :], set()).add(word)
        holes.setdefault(word, set()).add(word)
    near = {word: set() for word in counts}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best and counts[best] >= 10 * n else None
    rows = set()
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return rows


def shown(frame):
    rows = [tuple(row) for row in frame.select(COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    rows = [tuple(row) for row in table(spark, folder, "documents").select("doc_id", "text").collect()]
    assert shown(queries.op13_spelling_variants(spark, folder)) == brute(brute_words(rows))


def test_every_single_edit_is_found(spark):
    base = ["abcdefg", "abcdefgh", "aaaaaaa", "äöüßéèê", "abababab", "zzzzzzzzzzz"]
    words = set(base)
    for word in base:
        for i in range(len(word) + 1):
            words |= {word[:i] + "x" + word[i:], word[:i] + word[i : i + 1] + word[i:]}
            words |= {word[:i] + "q" + word[i + 1 :], word[:i] + word[i + 1 :]}
    words = sorted(w for w in words if len(w) >= 7)
    frame = spark.createDataFrame([(w, 2 + i) for i, w in enumerate(words)], "word string, n long")
    found = [(r.a, r.b) for r in spelling.near_pairs(frame).collect()]
    assert len(found) == len({frozenset(pair) for pair in found})
    assert {frozenset(pair) for pair in found} == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_chains_of_forms_and_ties(spark):
    counts = {"letters": 5000, "lettars": 300, "lettarz": 20, "lettbrz": 2, "bananas": 100, "bananaz": 10, "bananbs": 100, "singles": 9}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert shown(spelling.variants(frame)) == brute(counts)


def test_odd_rows(spark):
    docs = plain.odd(spark).union(plain.odd(spark)).withColumnRenamed("kept", "word").withColumnRenamed("score", "n")
    rows = [(r[0], r[1]) for r in plain.ODD] * 2
    assert shown(spelling.variants(spelling.word_counts(docs, edit=spelling.erased))) == brute(brute_words(rows))
    assert shown(spelling.variants(spelling.word_counts(docs))) == brute(brute_words(rows, edit=False))
    assert shown(spelling.variants(spelling.word_counts(plain.none(spark)))) == set()
