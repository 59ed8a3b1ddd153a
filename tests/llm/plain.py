"""Plain Python versions of the corpus operators, and rows that have every odd case."""

from __future__ import annotations

import hashlib

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, score string, chunk string"

ODD = [
    (1, "Alpha beta gamma delta", "en", "a", 22, 9, "x", "y", "z"),
    (2, "ALPHA beta gamma delta", "en", "a", 22, 9, "x", "y", "z"),
    (3, None, None, None, None, None, None, None, None),
    (4, "", "de", "b", 0, 0, "", "", ""),
    (5, "   \t\n ", "de", None, 6, 1, None, None, None),
    (None, "no id here, but text", "fr", "c", 20, 2, None, None, None),
    (6, "ÄÖÜ é straße   x", "de", "c", 16, 2, None, None, None),
    (7, "word " * 9000, "en", "a", 45000, 2, None, None, None),
    (8, "word", "en", "a", 4, 2, None, None, None),
    (8, "word", "en", "a", 4, 2, None, None, None),
    (9, "WORD", "en", "d", 4, 2, None, None, None),
    (10, "x" * 70000, "en", "d", 70000, 2, None, None, None),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def folded(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def simhash(text: str | None) -> int:
    found = words(folded(text))
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(one, 42) for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0


def least_linked(prints: list[int], ids: list, radius: int = 2) -> list:
    """The smallest id of every item's component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(prints):
        for j in range(i):
            if (one ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    known: dict[int, list] = {}
    for i, id_ in enumerate(ids):
        known.setdefault(find(i), []).append(id_)
    return [min((x for x in known[find(i)] if x is not None), default=None) for i in range(len(ids))]


def targets(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Reshare the excess by weight, again and again, until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    result, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), list(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            result[s] += left * weight[s] / total
        left = sum(max(0.0, result[s] - most * sizes[s]) for s in open_)
        result = {s: min(v, most * sizes[s]) for s, v in result.items()}
        open_ = [s for s in open_ if result[s] < most * sizes[s]]
    return result


def without_repeats(rows: list[tuple], length: int = 50) -> list[tuple]:
    """Every string's smallest id, then every byte in turn."""
    least: dict[bytes, float] = {}
    known = [(float("inf") if id_ is None else id_, (text or "").encode()) for id_, text in rows]
    for id_, data in known:
        for p in range(len(data) - length + 1):
            one = data[p : p + length]
            least[one] = min(least.get(one, float("inf")), id_)
    result = []
    for (shown, _), (id_, data) in zip(rows, known, strict=True):
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if least[data[p : p + length]] < id_:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        result.append((shown, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result
