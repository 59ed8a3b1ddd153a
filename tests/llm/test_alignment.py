import hashlib
import json
import random
import tracemalloc
from collections import Counter
from itertools import accumulate, pairwise
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from tests.llm import plain
from tests.llm.test_queries import FOLDER
from tidemark.llm import alignment, queries
from tidemark.llm.tables import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
A_BYTES, B_BYTES = alignment.byte_tokens(TOKENIZER), alignment.piece_tokens(PIECES)


def whole(text):
    """Ids, ends and shared ends of a whole text, or None without tokens."""
    if not text:
        return None
    a, b = TOKENIZER.encode(" " + text, add_special_tokens=False).ids, PIECES.encode(text)
    raw = (" " + text).encode()
    if b"".join(A_BYTES[i] for i in a) != raw or b"".join(B_BYTES[i] for i in b) != raw:
        return None
    return a, b, list(accumulate(len(A_BYTES[i]) for i in a)), list(accumulate(len(B_BYTES[i]) for i in b))


def brute(rows):
    held, links_of, result = Counter(), [], []
    for doc_id, text in rows:
        found = whole(text)
        if found is None:
            links_of.append([])
            result.append([doc_id, 0, 0, 0, 0, ""])
            continue
        a, b, a_ends, b_ends = found
        a_spans, b_spans = list(pairwise([0, *a_ends])), list(pairwise([0, *b_ends]))
        links, first = [], 0
        for i, (s, e) in enumerate(a_spans):
            while b_spans[first][1] <= s:
                first += 1
            j = first
            while j < len(b) and b_spans[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted(set(a_ends) & set(b_ends))
        groups = [
            ",".join(str(x) for x, (s, e) in zip(a, a_spans, strict=True) if low <= s and e <= high)
            + "|"
            + ",".join(str(x) for x, (s, e) in zip(b, b_spans, strict=True) if low <= s and e <= high)
            for low, high in pairwise([0, *cuts])
        ] if len(a) < 400 else _groups(a, b, a_ends, b_ends, cuts)
        held.update(set(links))
        links_of.append(links)
        result.append([doc_id, len(a), len(b), len(cuts), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()])
    highest = {}
    for (a, _), n in held.items():
        highest[a] = max(n, highest.get(a, 0))
    return Counter(
        (*row[:5], sum(held[x] == highest[x[0]] for x in links), sum(held[x] for x in links), row[5])
        for row, links in zip(result, links_of, strict=True)
    )


def _groups(a, b, a_ends, b_ends, cuts):
    shown, i, j = [], 0, 0
    for cut in cuts:
        x, y = a_ends.index(cut, i) + 1, b_ends.index(cut, j) + 1
        shown.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return shown


def shown(frame):
    return Counter(
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect()
    )


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    assert shown(queries.op11_token_alignment(spark, folder)) == brute(rows)


ODD_TEXTS = [
    "<|endoftext|> a <s> b </s>", "a\r\nb;\r\n c", "a b  c　d", "x▁y", "▁", "tab\tand\t\t tab", "\n\n  two\n ", "   ",
    "café naïve \U0001f600\U0001f600", "it's we'll I'd", "<0x41> [UNK]", "a\x1cb \x85c", "trailing ", "ﬁ ａ", "0123456789 3.14", "\x00 nul",
    "क्ष 中文字符", "é é", "​ zero", "\r", "\t", "\n", "  line",
]


def test_odd_texts(spark):
    rows = [(i, text) for i, text in enumerate(ODD_TEXTS)] + [(r[0], r[1]) for r in plain.ODD]
    extra = [(i, t, None, None, None, 1, "x", "y", "z") for i, t in rows]
    docs = spark.createDataFrame(extra, plain.SCHEMA.replace("kept", "block").replace("score", "pair"))
    assert shown(alignment.alignments(docs, A, B)) == brute(rows)
    assert alignment.alignments(plain.none(spark), A, B).collect() == []


def test_blocks_of_any_size_agree(spark, monkeypatch):
    rows = [(i, text * (1 + i % 3)) for i, text in enumerate(ODD_TEXTS * 3)]
    encoder = alignment.PairEncoder(open(A).read(), open(B, "rb").read())
    monkeypatch.setattr(alignment, "CACHED_UNITS", 20)
    for _ in range(2):
        found = [alignment.block_row(encoder, 0, [i], [text]) for i, text in rows]
        at_once = alignment.block_row(encoder, 1, [i for i, _ in rows], [text for _, text in rows])
        for i, one in enumerate(found):
            assert [at_once[k][i] for k in ("n_a", "n_b", "n_groups", "sha256")] == [one[k][0] for k in ("n_a", "n_b", "n_groups", "sha256")]
            low, high = at_once["ends"][i - 1] if i else 0, at_once["ends"][i]
            joined = {at_once["pair"][p]: n for p, n in zip(at_once["place"][low:high], at_once["links"][low:high], strict=True)}
            assert joined == {one["pair"][p]: n for p, n in zip(one["place"], one["links"], strict=True)}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é中\n\t\r  ▁'1<|s>;😀"), max_size=24))
def test_units_give_the_tokens_of_the_whole_text(text):
    encoder = ENCODER
    assert not encoder.crossing
    found = whole(text)
    row = alignment.block_row(encoder, 0, [1], [text])
    if found is None:
        assert (row["n_a"][0], row["sha256"][0]) == (0, "")
    else:
        a, b, a_ends, b_ends = found
        cuts = sorted(set(a_ends) & set(b_ends))
        expected = ";".join(_groups(a, b, a_ends, b_ends, cuts))
        assert (row["n_a"][0], row["n_b"][0], row["n_groups"][0]) == (len(a), len(b), len(cuts))
        assert row["sha256"][0] == hashlib.sha256(expected.encode()).hexdigest()


def test_merger_gives_the_ids_of_the_tokenizer(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()] + ODD_TEXTS
    assert ENCODER.merger is not None
    for text in texts:
        assert ENCODER.merger.encode_ordinary(text) == TOKENIZER.encode(text, add_special_tokens=False).ids
    changed = json.loads(open(A).read())
    changed["model"]["merges"][0], changed["model"]["merges"][1] = changed["model"]["merges"][1], changed["model"]["merges"][0]
    assert alignment.merger(json.dumps(changed)) is None


ENCODER = alignment.PairEncoder(open(A).read(), open(B, "rb").read())


@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60))), min_size=1, max_size=5))
def test_groups_end_at_all_shared_cuts(texts):
    a, b, a_stops, b_stops, shared = [], [], [], [], []
    for i, (one, other) in enumerate(texts):
        one, other = one | {61}, other | {61}
        a += [61 * i + x for x in sorted(one)]
        b += [61 * i + x for x in sorted(other)]
        a_stops.append(len(a))
        b_stops.append(len(b))
        shared += [61 * i + x for x in sorted(one & other)]
    passed = alignment.align(np.array(a), np.array(b), np.array(a_stops), np.array(b_stops))
    assert [(a[i - 1], b[j - 1]) for i, j in zip(*passed, strict=True)] == [(cut, cut) for cut in shared]


def _long_texts():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 6))) for _ in range(4000)]
    return [" ".join(rng.choices(words, k=400)) for _ in range(500)]


def test_a_block_takes_little_memory():
    texts, encoder = _long_texts(), alignment.PairEncoder(open(A).read(), open(B, "rb").read())
    tracemalloc.start()
    try:
        row = alignment.block_row(encoder, 0, list(range(len(texts))), texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(row["n_a"]) == sum(len(TOKENIZER.encode(" " + text, add_special_tokens=False).ids) for text in texts)
    assert peak < 28_000_000


def test_documents_of_a_block_are_paired_some_at_a_time(monkeypatch):
    texts = [text * (1 + i % 3) for i, text in enumerate(ODD_TEXTS * 3)]
    at_once = alignment.block_row(ENCODER, 1, list(range(len(texts))), texts)
    for units in (1, 7, 40):
        monkeypatch.setattr(alignment, "PAIRED_UNITS", units)
        some = alignment.block_row(ENCODER, 1, list(range(len(texts))), texts)
        assert all(np.array_equal(at_once[name], some[name]) for name in at_once)


def test_workers_keep_no_units_after_a_task_and_no_vocabularies_where_counts_are_told(monkeypatch):
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(alignment, "BLOCK_CHARACTERS", 20)
    schemas = [to_arrow_schema(StructType.fromDDL(columns)) for columns in (alignment._BLOCK, alignment._DOCUMENTS)]
    vocabularies = open(A).read(), open(B, "rb").read()
    texts = ["one two one two one two", None, "", "three three three"]
    batch = pa.record_batch({"doc_id": pa.array([4, 5, 6, None]), "text": pa.array(texts)})
    rows = pa.Table.from_batches(alignment._block_reader(*vocabularies, *schemas)(iter([batch])))
    encoder = alignment.worker_encoder(*vocabularies)
    assert (rows["block"].to_pylist(), encoder.recent, encoder.former) == ([0, 1], {}, {})
    pairs = rows["pair"][1].values
    counts = pa.table({"pair": pairs, "documents": pa.array([7] * len(pairs)), "best": pa.array([True] * len(pairs))})
    told = alignment._told(rows.slice(1, 1).drop_columns(["holders"]), counts)
    assert alignment.worker_encoder.cache_info().currsize == 0
    expected = {row[0]: row for row in brute([(5, None), (6, ""), (None, texts[3])])}
    assert {r["doc_id"]: (*r.values(),) for r in told.to_pylist()} == {
        i: (*row[:5], row[4], 7 * row[4], row[7]) for i, row in expected.items()
    }


def test_texts_come_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    docs = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('ab cd ', 1000) AS text")
    before = spark.conf.get(alignment.MAX_BATCH_BYTES)
    with alignment.small_batches(spark):
        found = [r["size"] for r in docs.mapInArrow(sizes, "size long").collect()]
    assert sum(found) >= 24_000_000 and max(found) < alignment.BATCH_BYTES + 100_000
    assert spark.conf.get(alignment.MAX_BATCH_BYTES) == before
