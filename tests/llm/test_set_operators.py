"""Exact dedup, n-gram join, sharding, top-k and the pipeline: brute force and edge cases."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from quire.llm import exact_dedup, ngram_join, secrets, sharding, topk

DOCS = "doc_id bigint, text string, id string, n int, size int"


def docs(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(k, t, "x", 1, None) for k, t in rows], DOCS)


# --- exact dedup


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup(spark, keep):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "long" * 50_000), (7, "long" * 50_000), (8, "long" * 50_000 + "x"),
            (9, "A"), (10, "a "), (None, "a"), (None, "only null"), (None, "only null"), (11, "twice"), (11, "twice")]
    rows += [(k, "hot") for k in range(100, 400)]
    out = exact_dedup.exact_dedup(docs(spark, rows), keep=keep, salts=5).collect()
    assert len(out) == len(rows)
    groups = defaultdict(list)
    for k, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(k)
    kept = defaultdict(list)
    pick = min if keep == "smallest" else max
    for r in out:
        ids = groups[r.text_sha256]
        known = [k for k in ids if k is not None]
        assert r.keep_id == (pick(known) if known else None) and r.group_size == len(ids)
        if r.kept:
            kept[r.text_sha256].append(r.doc_id)
    assert {d: [pick([k for k in ids if k is not None], default=None)] for d, ids in groups.items()} == kept
    assert exact_dedup.exact_dedup(docs(spark, rows).limit(0)).count() == 0


def test_exact_dedup_spreads_a_hot_text(spark):
    from pyspark.sql import functions as F
    data = docs(spark, [(k, "hot") for k in range(4000)])
    key = [F.substring("text", 1, 64), F.xxhash64("text"), F.pmod(F.xxhash64("doc_id"), F.lit(8))]
    parts = data.select("doc_id", *(c.alias(f"k{i}") for i, c in enumerate(key))).repartitionByRange(8, "k0", "k1", "k2")
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 2000


# --- n-gram join


def sets_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]) and both:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[find(i)].append(k)
    return [(k, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None) if sets[i] else k)
            for i, (k, _) in enumerate(rows)]


def near_copies(seed, groups, size, words=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcde") for _ in range(4)) for _ in range(120)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    out = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)] + passage
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                del text[rng.randrange(len(text)):][:2]
            out.append(" ".join(text))
    return out


def test_ngram_join_equals_brute_force(spark):
    texts = near_copies(1, 6, 14) + near_copies(2, 1, 60, 30)
    texts += [None, "", " \t\n", "one", "One", "a b c d", "A b  c\nd", "a b c d e", "x " * 3000, "x " * 2999, "é b c d e", "É b c d e"]
    # chains whose ends are not linked, and sizes at the exact threshold
    chain = [f"w{i}" for i in range(104)]
    texts += [" ".join(chain[s:s + 84]) for s in (0, 8, 16, 20)]
    rows = [(k * 7 % 1000 + 5, t) for k, t in enumerate(texts)]
    rows += [(None, texts[0]), (rows[3][0], texts[40]), (rows[5][0], texts[5])]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(spark, rows)).collect()), key=str)
    assert got == sorted(brute_components(rows), key=str)
    assert ngram_join.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_ngram_join_with_many_fragments(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FRAGMENT_NGRAMS", 500)
    rows = list(enumerate(near_copies(3, 10, 5)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs(spark, rows)).collect())
    assert got == sorted(brute_components(rows))


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"x", b"y")], "a binary, b binary")
    got = {bytes(r.node): bytes(r.component) for r in ngram_join.components(links).collect()}
    assert got == {bytes([i]): bytes([0]) for i in range(41)} | {b"x": b"x", b"y": b"x"}


# --- sharding


def test_sharding(spark):
    rng = random.Random(1)
    rows = [(k, "x" * rng.randint(0, 3000)) for k in range(600)] + [(1000 + k, "copy") for k in range(300)]
    rows += [(None, None), (None, ""), (5000, None), (5001, "é"), (5001, "é")]
    out = sharding.shard(docs(spark, rows), 24).collect()
    assert len(out) == len(rows)
    slots, load, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        homes[r.text_crc32, r.size].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert sorted((r.size, r.text_crc32) for r in out) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in homes.values())
    assert len(load) == 24 and max(load.values()) <= 1.02 * min(load.values())
    assert sharding.shard(docs(spark, rows).limit(0)).count() == 0


def test_longest_processing_time():
    assert sharding.longest_processing_time([], 3) == {}
    placed = sharding.longest_processing_time([("a", 5), ("b", 4), ("c", 3), ("d", 3), ("e", 1)], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


# --- top-k


def brute_top(vectors, k):
    known = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in known:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in known if i != q and len(w) == len(v))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    vectors += [(300 + i, [0.1] * 8) for i in range(60)]  # ties
    vectors += [(400, None), (420, [None] * 8), (440, [float("nan")] * 8), (441, [float("inf")] * 8), (460, [1e4, -1e4]),
                (461, [3.0, 2.0]), (480, []), (481, []), (500, [0.0] * 8)]
    data = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id bigint, embedding array<double>, id string")

    def got(**options):
        return sorted(tuple(r) for r in topk.top_k(data, lambda key: key % 20 == 0, 20, **options).collect())

    assert got() == brute_top(vectors, 20)
    assert got(block_rows=100, chunk_rows=5) == brute_top(vectors, 20)
    assert topk.top_k(data.limit(0), lambda key: key % 20 == 0).count() == 0


def test_top_k_of_wide_values_and_repeated_ids(spark):
    rng = random.Random(9)
    rows = [(0, [1.0, 2.0]), (1, [5e7, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [0.5, 3.0]), (3, [-4e12, 0.25]), (20, [3e9, -2.0])]
    rows += [(k, [rng.uniform(-1, 1) * 10 ** rng.randrange(15), rng.uniform(-9, 9)]) for k in range(100, 160) if k % 20]
    data = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in rows] + [(None, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(data, lambda key: key % 20 == 0, 20).collect())
    assert got == [(*r[:3], min(max(r[3], -2 ** 63), 2 ** 63 - 1)) for r in brute_top(rows, 20)]
    assert sum(r[0] == 0 and r[2] == 2 for r in topk.top_k(data, lambda key: key == 0, 100).collect()) == 3
    huge = spark.createDataFrame([(0, [1e30, -1.0]), (1, [1e300]), (2, [1e20, 1.0]), (3, [-1e25, 0.0])], "vec_id bigint, embedding array<double>")
    out = [tuple(r) for r in topk.top_k(huge, lambda key: key == 0, 20).collect()]  # beyond 64 bits: the nearest number, the rank exact
    assert [(r[1], r[2], r[3]) for r in sorted(out)] == [(1, 2, 2 ** 63 - 1), (2, 3, -2 ** 63)]


# --- pipeline


def test_pipeline_stages(spark, sf001, tmp_path):
    source = spark.read.parquet(f"{sf001}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = ["toxicity", "exact dedup", "n-gram Jaccard join", "secret scans", "packing"]
    assert list(stages) == names
    at = source
    for k, name in enumerate(names[:-1]):
        stages[name](spark, at, sf001).write.parquet(str(tmp_path / str(k)))
        before, at = {r.doc_id: r for r in at.collect()}, spark.read.parquet(str(tmp_path / str(k)))
        after = {r.doc_id: r for r in at.collect()}
        assert at.columns == source.columns and set(after) <= set(before)
        if name == "exact dedup":
            best = defaultdict(int)
            for r in before.values():
                best[r.text or ""] = max(best[r.text or ""], r.doc_id)
            assert set(after) == set(best.values())
        if name == "n-gram Jaccard join":
            wanted = brute_components([(r.doc_id, r.text) for r in before.values()])
            assert set(after) == {c for _, _, c in wanted}
        if name == "secret scans":
            assert set(after) == set(before)
            assert all(r.text == secrets.masked(before[d].text) and not secrets.base_spans(r.text or "") for d, r in after.items())
    packed = stages["packing"](spark, at, sf001)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(after)
    assert packed.groupBy("sequence_id").sum("length").selectExpr("max(`sum(length)`)").first()[0] <= 2048


def test_pipeline_stages_judge_rows_not_identifiers(spark, tmp_path):
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    stages = dict(corpus_pipeline.STAGES)
    kind = "doc_id bigint, text string, n_chars bigint, source string"

    def after(name, rows):
        data = spark.createDataFrame([(k, t, None, "s") for k, t in rows], kind)
        return sorted(((r.doc_id, r.text) for r in stages[name](spark, data, str(tmp_path)).collect()), key=str)

    def words(bad=()):
        text = [rng.choice(stems) for _ in range(60)]
        for w in bad:
            text[rng.randrange(60)] = w
        return " ".join(text)

    # toxicity: a clean text stays beside a toxic one of its identifier, toxic ones go whatever their identifier
    labelled = [(k, words(("vilest", "rotten", "vilest") if k % 6 == 0 else ())) for k in range(600)]
    spark.createDataFrame([(k, int(k % 6 == 0)) for k in range(0, 600, 2)], "doc_id bigint, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    good, bad = words(), words(("vilest", "rotten", "vilest", "rotten"))
    mine = [(9001, good), (9001, bad), (9002, good), (9002, good), (9003, bad), (9003, bad), (None, bad), (None, good), (None, None)]
    got = [r for r in after("toxicity", labelled + mine) if r[0] is None or r[0] > 9000]
    assert got == sorted(((k, t) for k, t in mine if t != bad), key=str)

    # exact dedup: one row of each text
    rows = [(11, "twice"), (11, "twice"), (1, "copy"), (2, "copy"), (1, "other of 1"), (None, "copy"), (None, "null only"),
            (None, "null only"), (None, "null other"), (3, None), (4, ""), (4, None)]
    assert after("exact dedup", rows) in [
        sorted([(11, "twice"), (2, "copy"), (1, "other of 1"), (None, "null only"), (None, "null other"), (4, empty)], key=str)
        for empty in ("", None)]

    # n-gram join: one row of each component, texts without words stay
    text = [f"w{i}" for i in range(100)]
    a, near, nearer = (" ".join([*text[:k], "x", *text[k + 1:]]) for k in (0, 99, 50))
    lone = [" ".join(f"{p}{i}" for i in range(30)) for p in "pqr"]
    rows = [(7, a), (8, near), (8, lone[0]), (7, lone[0]), (7, nearer), (None, near), (9, lone[1]), (9, lone[1]),
            (None, lone[2]), (None, lone[2]), (5, ""), (5, ""), (None, " ")]
    got = after("n-gram Jaccard join", rows)
    least = min((a, nearer), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert got == sorted([(7, least), (7, lone[0]), (9, lone[1]), (None, lone[2]), (5, ""), (5, ""), (None, " ")], key=str)


def test_places_drop_exactly_the_named_rows(spark, tmp_path):
    from pyspark.sql import functions as F
    from quire.llm.common import placed, without
    data = spark.range(1000).selectExpr("id", "id * 2 AS place", "'x' AS bits", "0 AS file_hash", "id AS of_file", "id AS w", "1 AS row_number")
    data.repartition(7).write.parquet(str(tmp_path / "in"))
    for source in (spark.read.parquet(str(tmp_path / "in")), data):
        docs, rows, name, seed = placed(source)
        assert name not in source.columns
        gone = rows.filter("id % 3 = 0 OR id < 200").select(name)
        for words in (10 ** 6, 5):
            out = without(docs, gone.unionByName(gone), name, seed, words)
            assert out.columns == source.columns
            assert sorted(tuple(r) for r in out.collect()) == [(k, 2 * k, "x", 0, k, k, 1) for k in range(200, 1000) if k % 3]
        assert without(docs, gone.limit(0), name, seed).count() == 1000
        assert "BroadcastHashJoin" in without(docs, gone, name, seed)._jdf.queryExecution().executedPlan().toString()
        assert without(docs, rows.select(F.col(name)), name, seed).count() == 0


def test_pipeline_edge_cases(spark, sf001):
    """Clashing extra columns, very long and repeated texts, null identifiers, an empty table."""
    stages = dict(corpus_pipeline.STAGES)
    near = [f"w{k}" for k in range(60)]
    other = [*near[:57], "x", "y", "z"]
    third = [*other[3:], "u", "v", "t"]
    rows = [(1, " ".join(near)), (None, " ".join(other)), (3, " ".join(third)), (4, "same"), (4, "same"), (None, "same"), (5, None), (6, ""),
            (7, "long words " * 60_000), (8, "long words " * 60_000), (9, "a b c d e f g h")]
    schema = "doc_id bigint, text string, place int, key string, _digest string, bits long, id string, row int, file_hash string"
    docs = spark.createDataFrame([(*r, 1, "k", "d", 2, "i", 3, "h") for r in rows], schema)
    kept = stages["exact dedup"](spark, docs, sf001)
    assert sorted(((r.doc_id, r.text[:8] if r.text else r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, "w0 w1 w2"), (None, "w0 w1 w2"), (3, "w3 w4 w5"), (4, "same"), (6, ""), (8, "long wor"), (9, "a b c d ")], key=repr)
    assert kept.columns == docs.columns and {tuple(r)[2:] for r in kept.collect()} == {(1, "k", "d", 2, "i", 3, "h")}
    # 1 and 3 are linked by the text without an identifier alone
    out = stages["n-gram Jaccard join"](spark, kept, sf001).collect()
    assert sorted(r.doc_id for r in out) == [1, 4, 6, 8, 9] and {tuple(r)[2:] for r in out} == {(1, "k", "d", 2, "i", 3, "h")}
    for name in ("exact dedup", "n-gram Jaccard join", "secret scans", "packing"):
        assert stages[name](spark, docs.limit(0), sf001).count() == 0


def test_links_through_a_null_identifier(spark):
    near = [f"w{k}" for k in range(60)]
    other = [*near[:57], "x", "y", "z"]
    rows = [(1, " ".join(near)), (None, " ".join(other)), (3, " ".join([*other[3:], "u", "v", "t"]))]
    out = ngram_join.near_duplicates(docs(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == {1: 1, None: 1, 3: 1}
