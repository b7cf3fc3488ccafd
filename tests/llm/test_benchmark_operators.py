"""Decontamination and ranked search: brute force and edge cases."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from quire.llm import decontaminate, ranked_search

DOCS = "doc_id bigint, text string, id string, words int, hash int, item string"
ITEMS = "item_id bigint, text string, window int"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(k, t, "x", 1, None, "y") for k, t in rows], DOCS)


def items(spark, rows):
    return spark.createDataFrame([(k, t, 1) for k, t in rows], ITEMS)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_hits(doc_rows, item_rows, window=10):
    out = []
    for k, text in doc_rows:
        w, hit, found = words(text), set(), set()
        for item, item_text in item_rows:
            iw = words(item_text)
            for at in range(max(1, len(iw) - window + 1)) if iw else ():
                piece = iw[at:at + window]
                for p in range(len(w) - len(piece) + 1):
                    if w[p:p + len(piece)] == piece:
                        hit |= set(range(p, p + len(piece)))
                        found |= {str(item)} - {"None"}
        out.append((k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def planted(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "É", "é", "x1", "dd"]
    item_rows = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 10, 11, 25])))) for k in range(8)]
    item_rows += [(100, None), (101, ""), (102, "..."), (None, " ".join(rng.choices(vocabulary, k=12))), item_rows[3],
                  (2, "Other words of a known id, one to ten of them here")]
    doc_rows = [(k, "-".join(rng.choices(vocabulary, k=rng.choice([0, 1, 4, 30, 90])))) for k in range(30)]
    for k in range(30, 60):  # passages of items, from their middle, their start or their end
        own = words(item_rows[rng.randrange(len(item_rows))][1])
        at = rng.randrange(len(own) + 1)
        doc_rows.append((k, " ".join([*rng.choices(vocabulary, k=rng.choice([0, 3])), *own[at:], *own[:at]]).upper()))
    doc_rows += [(200, None), (201, ""), (202, "!?"), (None, item_rows[5][1]), (None, item_rows[5][1]), (31, "other text"),
                 (203, "other words of a known id one to ten of them"), (204, "other words of a known id one to ten of")]
    doc_rows += [(k, item_rows[7][1]) for k in range(300, 340)]  # a hot passage
    return doc_rows, item_rows


@pytest.mark.parametrize("bound", [decontaminate.BROADCAST_SHINGLES, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_equals_brute_force(spark, seed, bound):
    doc_rows, item_rows = planted(seed)
    out = decontaminate.contamination(docs(spark, doc_rows), items(spark, item_rows), broadcast_rows=bound).collect()
    assert sorted(map(tuple, out), key=repr) == brute_hits(doc_rows, item_rows)


def test_contamination_of_a_very_long_text_and_of_empty_tables(spark):
    item = " ".join(f"w{k}" for k in range(14))
    long = " ".join(["w1 w2 w3 w4 w5 x"] * 40_000 + [item])
    rows, known = [(1, long), (2, "w0 w1")], [(7, item)]
    out = {r.doc_id: r for r in decontaminate.contamination(docs(spark, rows), items(spark, known)).collect()}
    assert (out[1].n_words, out[1].n_hit, out[1].n_items, out[2].n_hit) == (240_014, 14, 1, 0)
    assert decontaminate.contamination(docs(spark, rows).limit(0), items(spark, known)).count() == 0
    none = decontaminate.contamination(docs(spark, rows), items(spark, known).limit(0)).collect()
    assert [(r.n_hit, r.contaminated, r.items_sha256) for r in none] == [(0, False, hashlib.sha256(b"").hexdigest())] * 2


def test_occurrences_are_spans(spark):
    found = decontaminate.occurrences(docs(spark, [(1, "x a b c. A, b; c")]), items(spark, [(5, "a b c")])).collect()
    assert sorted((r.doc, r.start, r.length, r.item) for r in found) == [(1, 1, 3, "5"), (1, 4, 3, "5")]


# --- ranked search


def brute_ranks(doc_rows, item_rows, k=20):
    counted = [(key, Counter(words(text))) for key, text in doc_rows]
    documents = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    frequency = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(item_rows):
        scored = []
        for key, c in counted:
            m = 75 + 25 * sum(c.values()) * documents // total
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in words(text) if c[t])
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_items": 2, "tile_terms": 2}, {"exact": 3 * 10 ** 9}, {"k": 3, "exact": 1}])
def test_ranked_search_equals_brute_force(spark, options):
    doc_rows, item_rows = planted(3)
    doc_rows += [(400, "é " * 3000 + "zz"), (401, "zz É"), (401, "zz É"), (None, "zz É")]
    item_rows += [(50, "zz zz qq zz é"), (50, "zz zz qq zz é"), (51, "zz " * 400), (52, "qq unknown")]
    out = ranked_search.rank(docs(spark, doc_rows), items(spark, item_rows), **options).collect()
    assert sorted(map(tuple, out), key=repr) == brute_ranks(doc_rows, item_rows, options.get("k", 20))


def test_ranked_search_of_empty_tables(spark):
    some, known = docs(spark, [(1, "a b"), (2, None)]), items(spark, [(1, "a")])
    assert ranked_search.rank(some.limit(0), known).collect() == []
    assert ranked_search.rank(some, known.limit(0)).collect() == []
    assert ranked_search.rank(some.filter("doc_id = 2"), known).collect() == []


def test_a_factor_beyond_64_bits():
    import numpy as np
    n = np.array([10 ** 8, 1])
    assert ranked_search.lengths_factor(n, 10 ** 13, 10 ** 15).tolist() == [75 + 25 * 10 ** 8 // 100, 75]
