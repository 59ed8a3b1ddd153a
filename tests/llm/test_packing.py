import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm import plain
from tidemark.llm import packing, spans, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def check_layout(rows, capacity):
    sequences: dict = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_ids_equal_the_library():
    texts = [r[1] for r in plain.ODD] + ["it's 'six --'s x<|endoftext|>y a\x1cb c\x00d ÉA ΣΣ  İ ǅ é", "don't I'LL we've2you 3.14"]
    encoder = tokens.WordEncoder(open(PATH).read(), 1)
    for row, data, offsets in spans.blocks(pa.array(texts), 500):
        ids, borders = encoder.encode(data, offsets)
        for i in range(len(offsets) - 1):
            expected = TOKENIZER.encode(texts[row + i] or "", add_special_tokens=False).ids + [1]
            assert ids[borders[i] : borders[i + 1]].tolist() == expected


def test_letters_beyond_ascii_need_no_whole_chain(monkeypatch):
    """Words of ASCII and letters up to U+00FF skip the library's chain, all others don't; ids are the library's in any case."""
    random.seed(2)
    letters = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x180), 0x301, 0x3A3, 0x4E2D, 0x1F600]]
    texts = [" ".join("".join(random.choices(letters, k=random.randint(1, 5))) for _ in range(400)) for _ in range(5)]
    texts += ["ÀÉÎÕÜßÿ'S Œ × a×b 2÷3 µ ª x² Ångström's SS-ß e\u0301", "für ÜBER, l'été: ñandú!! ça", "n\u00adn ÿ\u0301 Ã© <|x é<|endoftext|>"]
    encoder = tokens.WordEncoder(open(PATH).read(), 1)
    whole, chained = encoder._others, []
    monkeypatch.setattr(encoder, "_others", lambda words: (chained.extend(words), whole(words))[1])
    for row, data, offsets in spans.blocks(pa.array(texts), 3000):
        ids, borders = encoder.encode(data, offsets)
        for i in range(len(offsets) - 1):
            assert ids[borders[i] : borders[i + 1]].tolist() == TOKENIZER.encode(texts[row + i], add_special_tokens=False).ids + [1]
    assert "a×b" in chained and "e\u0301" in chained and "é<|endoftext|>" in chained
    assert not {"für", "ÜBER,", "l'été:", "ñandú!!", "ça", "ÀÉÎÕÜßÿ'S"} & set(chained)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    monkeypatch.setattr(tokens, "CACHE_PARTS", 2)
    test_ids_equal_the_library()


def test_odd_rows(spark):
    rows = packing.pack_documents(plain.odd(spark), PATH).collect()
    expected = Counter()
    for id_, text, *_ in plain.ODD:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[(id_, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert check_layout(rows, 4096) >= -(-sum(r.length for r in rows) // 4096)
    assert packing.pack_documents(plain.none(spark), PATH).collect() == []


def best_possible(lengths, capacity):
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                at = rooms.index(room)
                place(i + 1, [*rooms[:at], room - lengths[i], *rooms[at + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best


def test_search_reaches_the_optimum_of_small_cases():
    random.seed(3)
    better = 0
    for _ in range(150):
        lengths = sorted((random.randint(1, 60) for _ in range(random.randint(1, 10))), reverse=True)
        found = packing.complete(lengths, 100)
        assert sorted(sum(found, [])) == sorted(lengths)
        assert all(sum(one) <= 100 for one in found)
        assert len(found) == best_possible(lengths, 100)
        better += len(packing.best_fit(lengths, 100)) > len(found)
    assert better


@pytest.mark.parametrize("kind", ["mixed", "large"])
def test_rounds_of_groups(spark, kind):
    random.seed(9)
    low, high = (1, 100) if kind == "mixed" else (51, 100)
    items = spark.createDataFrame([(i // 2, random.randint(low, high)) for i in range(2000)], "doc_id long, length long")
    rows = packing.pack(items, capacity=100, group_rows=300).collect()
    assert Counter((r.doc_id, r.length) for r in rows) == Counter(map(tuple, items.collect()))
    count = check_layout(rows, 100)
    if kind == "mixed":
        assert count <= 1.03 * len(packing.best_fit([r.length for r in rows], 100))
    else:
        assert count == 2000


def test_sequences_hold_the_ids(spark):
    docs = plain.odd(spark).filter("doc_id <> 7 or doc_id is null")
    placed = packing.pack_documents(docs, PATH)
    with_ids = packing.pieces(docs, PATH, keep_ids=True)
    sizes = {r.sequence_id: r.n for r in placed.groupBy("sequence_id").agg({"length": "sum"}).toDF("sequence_id", "n").collect()}
    found = packing.sequences(placed, with_ids).collect()
    assert {r.sequence_id: len(r.ids) for r in found} == sizes


def test_evicted_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    random.seed(8)
    encoder = tokens.WordEncoder(open(PATH).read(), 1)
    for _ in range(30):
        texts = [" ".join(random.choices(["the", "of", "and"] + [f"word{random.randint(0, 99)}" for _ in range(9)], k=12)) for _ in range(2)]
        data = "".join(texts).encode()
        offsets = np.array([0, len(texts[0].encode()), len(data)])
        ids, ends = encoder.encode(np.frombuffer(data, np.uint8), offsets)
        for text, start, end in zip(texts, ends, ends[1:]):
            assert ids[start:end].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids + [1]
        assert len(encoder.places) == encoder.words - 1 <= 60
