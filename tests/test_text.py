"""Cleaning rules on hand-written strings (expected values worked out by hand
from the rule tables)."""

import re

import pytest
from pyspark.sql import functions as F

from quire.functions import text as TX

CASES = [
    ("Hello  World\n\nThis is—a test_case~ok", "Hello World This is a test case ok",
     "Hello World This is a test case ok"),
    ("Invoice1234", "Invoicel 234", "Invoicel 234"),
    ("jointExplorationAgreement", "joint Explor at ion Agreement", "joint Explor at ion Agreement"),
    ("internationalandTrade", "intern at ionaland Trade", "intern at ionaland Trade"),
    ("Total:  $1,234.50!!", "Total: l, 234. soii", "Total: l, 234 soii"),
    ("Wait... what,,, ok", "Wait. what, ok", "Wait what, ok"),
    ("“Quoted” ‘text’ ¢ @ |x \\ path", "Quoted text c a lx / p at h",
     "Quoted text c a lx / p at h"),
    ("ABCDEFGHIJKLMNOPQRST", "ABCDEFGHIJKLMNOPQRST", "ABCDEFGHIJKLMNOPQRST"),
    ("see page 12. Next line 3 4 5. ab. The end", "see page l 2. Next line 3 4 s. ab. The end",
     "see page l 2 Next line 34 s The end"),
    ("", "", ""),
    (None, None, None),
    ("12345", "l 234 s", "l 234 s"),
    ("Café déjà vu", "Caf d j vu", "Caf d j vu"),
    ("ﬁne ligature ①", "fine lig at ure l", "fine lig at ure l"),
    ("-- ?? ##", "--", ""),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    rows = df.select("i", TX.clean_text("t").alias("c"), TX.advanced_cleanup("t").alias("a")).collect()
    return {r.i: (r.c, r.a) for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_clean_and_advanced(cleaned, i):
    assert cleaned[i] == (CASES[i][1], CASES[i][2])


def test_cleaned_output_is_ascii(spark, sf001):
    from quire.plans.fixtures import corpus
    d = corpus(spark, sf001).select(TX.clean_text("text").alias("c"))
    assert d.filter(F.col("c").rlike(r"[^\x00-\x7F]")).count() == 0
    assert d.filter(F.col("c").rlike(r"\s{2,}|^\s|\s$")).count() == 0


def test_long_glued_token_split(spark):
    df = spark.createDataFrame([("abcdefgandTransferOK",), ("SHORTandTx",)], "t string")
    out = [r[0] for r in df.select(TX.fix_spacing("t")).collect()]
    # T7 splits camel case first; the small-word pass then runs per long token
    assert out[0] == "abcdefgand Transfer OK"
    assert out[1] == "SHORTand Tx"


def test_accent_fold_and_lengths(spark):
    df = spark.createDataFrame([("Crème brûlée Ça",), (None,)], "t string")
    r = df.select(TX.accent_fold("t").alias("f"), TX.char_length("t").alias("n"),
                  TX.alnum_count("t").alias("a")).collect()
    assert r[0].f == "Creme brulee Ca" and r[0].n == 15 and r[0].a == 13
    assert r[1].f is None and r[1].n == 0


def test_learned_abbreviations(spark):
    import math
    from collections import Counter

    from quire.operators import abbreviations as AB
    letters = [(k, f"See No. {k} of Acme Ltd. Bill. We saw it at 9 a.m. today. Bill, today we (see \"approx. {k}\") it. We see") for k in range(300)]
    df = spark.createDataFrame([*letters, (99, None), (98, "")], "k int, text string")
    tokens = [re.sub(r"^[(\[{\"'«“‘]+", "", re.sub(r"[)\]}\"'»”’,;:!?]+$", "", t)).lower() for _, x in letters for t in x.split()]
    stops, plain = Counter(t[:-1] for t in tokens if t.endswith(".")), Counter(t for t in tokens if not t.endswith("."))
    chance = sum(stops.values()) / len(tokens)
    out = {r.word: r for r in AB.abbreviation_scores(df).collect()}
    assert set(out) == {w for w in stops if re.fullmatch(r"[^\W\d_](\.?[^\W\d_])*", w)}
    for w, r in out.items():
        a, b, inner = stops[w], plain[w], w.count(".")
        ratio = 2 * (a * math.log(0.99) + b * math.log(0.01) - a * math.log(chance) - b * math.log(1 - chance))
        assert math.isclose(r.score, ratio * math.exp(inner - len(w)) * (inner + 1) * float(len(w) - inner) ** -b, rel_tol=1e-9)
    known = AB.abbreviations(df)
    assert {r.word for r in known.collect()} == {"no", "ltd", "a.m", "approx"}
    texts = [(1, "No. 5 of Acme Ltd. Bill. Then it ended. At 9 a.m. Bill came!  He (see \"No.\" approx. 3) left"), (2, None), (3, "no. "), (4, "One. Two.")]
    texts = spark.createDataFrame(texts, "k int, text string")
    for held in (AB.HELD, 1):
        out = {r.k: r.s for r in AB.with_sentences(texts, "text", known, "s", held).collect()}
        assert out[1] == ["No. 5 of Acme Ltd. Bill.", "Then it ended.", "At 9 a.m. Bill came!", "He (see \"No.\" approx. 3) left"]
        assert out[2] == [""] and out[4] == ["One.", "Two."] and [x.strip() for x in out[3]] == ["no."]


def test_the_chain_equals_its_rules_one_after_the_other(spark):
    import random
    rng = random.Random(3)
    signs = [chr(c) for c in range(1, 128)] + list("aabBcCzZ0195") * 4 + ["of", "at", "the", "and", "to", "in", "é", "–", "—", "中", "¢", "“", "\u00a0", " ", "  "]
    rows = [(k, "".join(rng.choices(signs, k=rng.randrange(60)))) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, text string")
    steps = TX.squash_ws(TX.fix_spacing(TX.noise_strip(TX.ocr_substitute(TX.nfkc("text")))))
    assert df.filter(~steps.eqNullSafe(TX.clean_text("text"))).collect() == []


def test_nfkc_holds_a_piece_of_a_batch_at_a_time():
    import tracemalloc

    import pyarrow as pa
    # 13 million characters in one batch; each holds a ligature, a decomposed letter or a full-width sign
    texts = [None if k % 7 == 0 else f"{k} " + "ﬁx e\u0301 Ａ é 中 " * 1000 for k in range(1000)]
    batch, pieces = pa.array(texts, pa.string()), []
    tracemalloc.start()
    try:
        for piece in TX._nfkc.func(iter([batch])):
            pieces.append(piece)  # Arrow's memory, which is not traced
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 8 * TX.PIECE_CHARS < batch.nbytes / 2
    assert max(sum(len(x or "") for x in p.to_pylist()) for p in pieces) < 2 * TX.PIECE_CHARS
    out = [x for p in pieces for x in p.to_pylist()]
    assert out == [None if x is None else x.replace("ﬁ", "fi").replace("e\u0301", "é").replace("Ａ", "A") for x in texts]
    assert all(p.type == pa.large_string() for p in TX._nfkc.func(iter([batch.cast(pa.large_string())])))


def test_nfkc_of_long_texts_keeps_rows_and_their_order(spark):
    texts = [(k, [None, "", "plain", f"{k} ﬁ①Ａ", "e\u0301" * 400_000, "中" * 1_100_000, "\u1100\u1161"][k % 7]) for k in range(28)]
    df = spark.createDataFrame(texts, "k int, t string").coalesce(1)
    out = df.select("k", TX.nfkc("t").alias("n"), F.length(TX.nfkc(F.concat("t", F.lit("ﬂ")))).alias("m")).collect()
    want = {0: None, 1: "", 2: "plain", 4: "é" * 400_000, 5: "中" * 1_100_000, 6: "가"}
    assert [r.k for r in out] == list(range(28))
    for r in out:
        expected = f"{r.k} fi1A" if r.k % 7 == 3 else want[r.k % 7]
        assert r.n == expected and r.m == (None if expected is None else len(expected) + 2)
