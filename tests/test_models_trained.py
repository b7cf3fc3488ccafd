"""The tagger, the lemma rules and the attention model on small data."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import attention as AT
from quire.operators import lemmas as LM
from quire.operators import tagger as TG

# --- tagger


def test_viterbi_equals_all_paths():
    import itertools
    rng = np.random.default_rng(1)
    for n in (1, 2, 4):
        scores, moves = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))
        best, path = -math.inf, None
        for tags in itertools.product(range(3), repeat=n):
            if tags[0] == TG.INSIDE or any(a == TG.OUT and b == TG.INSIDE for a, b in itertools.pairwise(tags)):
                continue
            value = sum(scores[k, t] for k, t in enumerate(tags)) + sum(moves[a, b] for a, b in itertools.pairwise(tags))
            if value > best:
                best, path = value, tags
        assert tuple(TG.viterbi(scores, moves)) == path


def test_tagger_finds_names_without_a_suffix(spark):
    firms = ["Blue River", "Acme", "Nord See Handel", "Oak", "Miller Sons", "Zeta Works", "Kappa", "Grand Hotel"]
    rows = [(k, f"Invoice {k} of {firms[k % 6]} Ltd for {k} parts. Pay to {firms[k % 6]} Ltd soon.") for k in range(120)]
    rows += [(500, None), (501, ""), (502, "no name here")]
    df = spark.createDataFrame(rows, "k int, text string")
    tagger = TG.train(df, "text", passes=3)
    new = spark.createDataFrame([(1, "Invoice 7 of Grand Hotel for 9 parts. Pay to Grand Hotel soon."), (2, None), (3, ""),
                                 (4, "w " * 1000 + "Invoice 3 of Kappa for 2 parts."), (5, "Invoice 7 of Kappa Ltd for 9 parts.")], "k int, text string")
    out = {r.k: (r.first, r.words) for r in new.select("k", TG.first_name("text", tagger).alias("first"), TG.name_words("text", tagger).alias("words")).collect()}
    assert out[1] == ("Grand Hotel", ["Grand", "Hotel"]) and out[2] == (None, []) and out[3] == (None, [])
    assert out[4][0] == "Kappa" and out[5][0] == "Kappa Ltd"
    given = df.withColumn("firm", F.lit("parts"))  # a column may name them as well
    assert {n for r in TG.labelled(given.filter("k = 7"), "text", ["firm"]).collect() for n in r.names} == {"Acme Ltd", "Acme", "parts"}
    nothing = TG.train(df.filter("k >= 500"), "text", passes=1)
    assert nothing.tag("Acme Ltd") == []


# --- lemmas


def test_lemma_rules(spark):
    words = [("walk", 50), ("walks", 9), ("walked", 8), ("talk", 40), ("talks", 7), ("talked", 6), ("jump", 30), ("jumps", 5), ("jumped", 4),
             ("tries", 3), ("tried", 2), ("glass", 20), ("news", 5), ("x9s", 2), ("größe", 9), ("größen", 4), ("bedding", 1)]
    df = spark.createDataFrame(words, "word string, n long")
    rules = LM.suffix_rules(df)
    assert {(r.suffix, r.becomes, r.words, r.weight) for r in rules.collect()} == {("s", "", 3, 21), ("ed", "", 3, 18)}
    out = {r.word: r.lemma for r in LM.lemmas(df, rules).collect()}
    assert {w: l for w, l in out.items() if w != l} == {"walks": "walk", "walked": "walk", "talks": "talk", "talked": "talk", "jumps": "jump", "jumped": "jump"}
    segs = spark.createDataFrame([(1, [["he", "walks"], [], ["walked"]]), (2, [[]]), (3, [["x9s"]])], "k int, segs array<array<string>>")
    got = {r.k: r.segs for r in LM.lemmatise(segs, "k", "segs", LM.lemmas(df, rules)).collect()}
    assert got == {1: [["he", "walk"], [], ["walk"]], 2: [[]], 3: [["x9s"]]}


# --- attention


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    shape = AT.shapes(7, 3, 4)
    flat = rng.normal(0, 0.5, sum(int(np.prod(s)) for s in shape.values()))
    grid = rng.integers(0, 7, (3, 2, 4))
    grid[0, 1] = 0
    grid[2] = 0  # a document without words
    label, weight = np.array([0, 2, 1]), np.array([1.0, 0.5, 2.0])
    loss, g = AT.loss_and_gradient(AT.unpack(flat, shape), grid, label, weight)
    g = np.concatenate([g[n].ravel() for n in AT.NAMES])
    for k in rng.permutation(len(flat))[:60]:
        if k < 4:
            continue  # padding has no vector of its own
        high, low = flat.copy(), flat.copy()
        high[k] += 1e-5
        low[k] -= 1e-5
        slope = (AT.loss_and_gradient(AT.unpack(high, shape), grid, label, weight)[0] - AT.loss_and_gradient(AT.unpack(low, shape), grid, label, weight)[0]) / 2e-5
        assert math.isclose(slope, g[k], rel_tol=1e-4, abs_tol=1e-6), k
    assert math.isclose(loss, -sum(w * AT._log_probabilities(AT.forward(AT.unpack(flat, shape), grid)["logits"])[i, y]
                                   for i, (y, w) in enumerate(zip(label, weight, strict=True))))


@pytest.fixture
def grids(spark):
    rng = np.random.default_rng(3)

    def rows(n, at):
        out = []
        for k in range(n):
            label = k % 3
            grid = rng.integers(4, 30, (4, 5))
            grid[rng.integers(0, 4), rng.integers(0, 5)] = 1 + label  # one word tells the class
            out.append((at + k, grid.tolist(), f"class {label}"))
        return spark.createDataFrame(out, "id long, grid array<array<bigint>>, label string")
    return rows(120, 0), rows(60, 1000)


def test_attention_learns_resumes_and_explains(spark, grids, tmp_path):
    train, held = grids
    model = AT.fit(train, held, 30, max_passes=40)
    out = AT.score(model, held.unionByName(spark.createDataFrame([(5, [[0] * 5] * 4, "class 1")], held.schema))).collect()
    assert sum(r.predicted_label == r.label for r in out if r.id != 5) >= 57
    for r in out:
        assert math.isclose(sum(r.probabilities), 1)
        assert r.id == 5 or math.isclose(sum(r.sentence_weights), 1) and all(math.isclose(sum(w), 1) for w in r.word_weights)
        assert r.id != 5 or r.sentence_weights == [0.0] * 4
    kept = [k for k, h in enumerate(model.history) if h[2]]
    assert len(kept) == 1 and model.history[kept[0]][1] == min(h[1] for h in model.history)
    assert model.history[-1][0] < model.history[0][0]

    class Broken(Exception):
        pass

    def stop(number):
        if number == 2:
            raise Broken

    state = str(tmp_path / "state")
    unbroken = AT.fit(train, held, 30, max_passes=6)
    with pytest.raises(Broken):
        AT.fit(train, held, 30, max_passes=6, state=state, after_pass=stop)
    done = []
    resumed = AT.fit(train, held, 30, max_passes=6, state=state, after_pass=done.append)
    assert done == [3, 4, 5] and resumed.history == unbroken.history and (resumed.flat == unbroken.flat).all()
    assert AT.fit(train, held, 30, max_passes=6, state=state).history == unbroken.history


def test_a_fit_without_gain_stops(spark, grids):
    train, held = grids
    wrong = held.withColumn("label", F.when(F.col("label") == "class 0", "class 1").otherwise("class 0"))
    model = AT.fit(train, wrong, 30, max_passes=60, patience=2)
    kept = next(k for k, h in enumerate(model.history) if h[2])
    assert len(model.history) - 1 - kept <= 2 and len(model.history) < 60


def test_grids_lose_padding_only():
    column = pa.array([[[0, 0, 0, 0]] * 3, [[3, 9, 0, 0], [0, 2, 0, 0], [0] * 4]])
    assert AT._grids(column, 9).tolist() == [[[0, 0]] * 2, [[3, 0], [0, 2]]]
    assert AT._grids(column.slice(0, 1), 9).tolist() == [[[0]]]


def test_a_fits_rows_are_cut_without_gathering_them(spark, grids):
    train, _ = grids
    labels = ["class 0", "class 1", "class 2"]
    taken = AT._dealt(train, labels, "id", "grid", "label", None, 50)
    assert {r.k for r in taken.select("k").collect()} == {r.k for r in train.select(F.xxhash64("id").alias("k")).orderBy("k").limit(50).collect()}
    assert taken.rdd.getNumPartitions() == AT.PARTITIONS
