"""Queries: segmentation, vocabulary, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import keywords as KW
from quire.functions import segment as SG
from quire.operators import abbreviations as AB
from quire.operators import lemmas as LM
from quire.operators import vocab as V
from quire.plans import oracle as O
from quire.plans.catalog import register
from quire.plans.fixtures import corpus
from quire.session import reliable_checkpoint, staged
from quire.sources.tables import table

SEP = " || "


def _num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _sql_sentences(e: str) -> str:
    return (f"string_split(regexp_replace({e}, {O.q(KW.SENTENCE_BOUNDARY)}, {O.q(chr(92) + '1' + KW.SENT_MARK)}, 'g'), "
            f"{O.q(KW.SENT_MARK)})")


@register("sentences", sql=f"""
WITH s AS (SELECT doc_id, {_sql_sentences('text')} AS s FROM documents)
SELECT doc_id, CAST(len(s) AS INTEGER) AS n_sentences, array_to_string(s, {O.q(SEP)}) AS sentences FROM s
""")
def sentences(spark, sf_dir):
    """K1 on whole documents."""
    d = corpus(spark, sf_dir).select("doc_id", KW.sentences("text").alias("s"))
    return d.select("doc_id", F.size("s").alias("n_sentences"), F.array_join("s", SEP).alias("sentences"))


def _sql_words(s: str) -> str:
    toks = f"string_split_regex({O.strip_ws(f'lower({s})')}, '\\s+')"
    return (f"list_filter(list_transform({toks}, lambda t: regexp_replace(t, {O.q(SG.EDGE_PUNCT)}, '', 'g')), "
            f"lambda t: t <> '')")


def _sql_markers(s: str) -> str:
    items = ", ".join(f"CASE WHEN regexp_matches(lower({s}), {O.q(p)}) THEN {O.q(m)} END" for m, p in SG.MARKER_RULES)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def _sql_segment(text: str) -> str:
    sents = _sql_sentences(O.classifier_normalize(text))
    per = f"list_transform({sents}, lambda s: list_concat({_sql_words('s')}, {_sql_markers('s')}))"
    kept = f"list_filter({per}, lambda w: len(w) > 0)"
    return (f"CASE WHEN {text} IS NULL THEN [['']] WHEN len({kept}) = 0 THEN [['{SG.EMPTY_DOC}']] "
            f"ELSE {kept} END")


def _render_sql(e: str) -> str:
    return f"array_to_string(list_transform({e}, lambda s: array_to_string(s, ' ')), {O.q(SEP)})"


def _render(c):
    return F.array_join(F.transform(c, lambda s: F.array_join(s, " ")), SEP)


@register("han_segment", sql=f"SELECT doc_id, {_render_sql(_sql_segment('text'))} AS segments FROM documents")
def han_segment(spark, sf_dir):
    """K1-K4 + T15: words per sentence with structure markers."""
    d = SG.with_segments(corpus(spark, sf_dir), "text", ["doc_id"])
    return d.select("doc_id", _render(F.col("segs")).alias("segments"))


@register("doc_markers", sql=f"""
WITH s AS (SELECT doc_id, {_sql_sentences(O.classifier_normalize('text'))} AS s FROM documents)
SELECT doc_id, {", ".join(
    f"CAST(len(list_filter(s, lambda x: regexp_matches(lower(x), {O.q(p)}))) AS INTEGER) AS {m.lower()}"
    for m, p in SG.MARKER_RULES)}
FROM s
""")
def doc_markers(spark, sf_dir):
    """K3: sentences per document carrying each structural marker."""
    d = corpus(spark, sf_dir).select("doc_id", KW.sentences(SG.classifier_normalize("text")).alias("s"))

    def matching(p):
        return F.size(F.filter("s", lambda x: F.lower(x).rlike(p)))

    return d.select("doc_id", *[matching(p).alias(m.lower()) for m, p in SG.MARKER_RULES])


# --- hierarchical sequences ---------------------------------------------------------

def lowered_segments(spark, sf_dir):
    """Segmented documents, materialised once: the vocabulary and the encoding
    both read them, and segmentation is the expensive part."""
    d = SG.with_segments(corpus(spark, sf_dir), "text", ["doc_id"])
    segs = F.transform("segs", lambda s: F.transform(s, lambda w: F.lower(w)))
    return staged(d.select("doc_id", segs.alias("segs")), "segments")


HAN_SQL = f"""
WITH seg AS (SELECT doc_id, list_transform({_sql_segment('text')}, lambda s: list_transform(s, lambda w: lower(w))) AS segs
             FROM documents),
sw AS (SELECT doc_id, unnest(segs) AS s, generate_subscripts(segs, 1) AS si FROM seg),
ww AS (SELECT doc_id, si, unnest(s) AS w, generate_subscripts(s, 1) AS wi FROM sw),
voc AS (SELECT w, row_number() OVER (ORDER BY n DESC, fd, fs, fw) AS idx
        FROM (SELECT w, count(*) AS n, arg_min(doc_id, [doc_id, si, wi]) AS fd, arg_min(si, [doc_id, si, wi]) AS fs,
                     arg_min(wi, [doc_id, si, wi]) AS fw FROM ww GROUP BY w)),
enc AS (SELECT ww.doc_id, ww.si, list(voc.idx ORDER BY ww.wi) AS ids
        FROM ww JOIN voc ON ww.w = voc.w WHERE voc.idx < {V.NUM_WORDS} AND ww.si <= {V.MAX_SENTENCES}
        GROUP BY ww.doc_id, ww.si),
grid AS (SELECT seg.doc_id, r.si,
                coalesce(enc.ids[1:{V.MAX_SENTENCE_LENGTH}], []) AS ids
         FROM seg CROSS JOIN range(1, {V.MAX_SENTENCES + 1}) r(si)
         LEFT JOIN enc ON enc.doc_id = seg.doc_id AND enc.si = r.si),
padded AS (SELECT doc_id, si, array_to_string(list_concat(ids, list_transform(range({V.MAX_SENTENCE_LENGTH} - len(ids)), lambda x: 0)), ',') AS row_
           FROM grid)
SELECT doc_id, string_agg(row_, '|' ORDER BY si) AS grid FROM padded GROUP BY doc_id
"""


@register("han_sequences", sql=HAN_SQL)
def han_sequences(spark, sf_dir):
    """K8 + O2 + W2: 15 x 50 id grid over a vocabulary ranked by frequency."""
    segs = lowered_segments(spark, sf_dir)
    vocab = V.rank_vocabulary(segs.select("doc_id", F.flatten("segs").alias("w")), "doc_id", "w", 1)
    grid = V.encode_hierarchical(segs, "doc_id", "segs", vocab)
    return grid.select("doc_id", F.array_join(F.transform("grid", lambda r: F.array_join(r, ",")), "|").alias("grid"))


# --- flat tokens ----------------------------------------------------------------------

FLAT_TOKENS_SQL = (f"list_filter(string_split(translate(lower(coalesce(text, '')), {O.q(SG.TOKEN_FILTERS)}, "
                   f"{O.q(' ' * len(SG.TOKEN_FILTERS))}), ' '), lambda x: x <> '')")
VOCAB_SQL = f"""
t AS (SELECT doc_id, {FLAT_TOKENS_SQL} AS toks FROM documents),
e AS (SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos FROM t),
c AS (SELECT word, count(*) AS n, arg_min(doc_id, [doc_id, pos]) AS fd, arg_min(pos, [doc_id, pos]) AS fp
      FROM e GROUP BY word),
voc AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, fd, fp) + 1 AS idx FROM c)
"""


def flat_tokens(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", SG.flat_tokens("text").alias("toks"))


def flat_vocab(spark, sf_dir):
    return V.rank_vocabulary(flat_tokens(spark, sf_dir), "doc_id", "toks", first_index=2)


@register("vocab", sql=f"WITH {VOCAB_SQL} SELECT word, n, idx FROM voc")
def vocab(spark, sf_dir):
    """A15 + W2 + K5: flat tokenizer vocabulary (OOV holds id 1)."""
    return flat_vocab(spark, sf_dir)


@register("vocab_size", sql=f"WITH {VOCAB_SQL} SELECT count(*) AS n_words, count(*) + 2 AS vocab_size FROM voc")
def vocab_size(spark, sf_dir):
    """Index size + 1 (the index includes the OOV token)."""
    return V.vocabulary_size(flat_tokens(spark, sf_dir), "toks")


@register("encode_tokens", sql=f"""WITH {VOCAB_SQL},
enc AS (SELECT e.doc_id, list(CASE WHEN voc.idx < {V.NUM_WORDS} THEN voc.idx ELSE {V.OOV_INDEX} END ORDER BY e.pos) AS ids
        FROM e JOIN voc ON e.word = voc.word GROUP BY e.doc_id)
SELECT t.doc_id, coalesce(array_to_string(enc.ids, ','), '') AS ids FROM t LEFT JOIN enc ON t.doc_id = enc.doc_id
""")
def encode_tokens(spark, sf_dir):
    """K6: every token of every document to its id (over-cap -> OOV)."""
    toks = flat_tokens(spark, sf_dir)
    enc = V.encode_flat(toks, "doc_id", "toks", flat_vocab(spark, sf_dir), maxlen=None)
    return enc.select("doc_id", F.array_join("ids", ",").alias("ids"))


@register("pad_sequences", sql=f"""WITH {VOCAB_SQL},
enc AS (SELECT e.doc_id, list(CASE WHEN voc.idx < {V.NUM_WORDS} THEN voc.idx ELSE {V.OOV_INDEX} END ORDER BY e.pos) AS ids
        FROM e JOIN voc ON e.word = voc.word GROUP BY e.doc_id),
l AS (SELECT t.doc_id, coalesce(CASE WHEN len(enc.ids) > {V.FLAT_MAXLEN} THEN enc.ids[-{V.FLAT_MAXLEN}:] ELSE enc.ids END, [])
             AS ids FROM t LEFT JOIN enc ON t.doc_id = enc.doc_id)
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range({V.FLAT_MAXLEN} - len(ids)), lambda x: 0)), ',') AS ids
FROM l
""")
def pad_sequences(spark, sf_dir):
    """K7 + O3: last 250 ids, zero-padded after."""
    toks = flat_tokens(spark, sf_dir)
    enc = V.encode_flat(toks, "doc_id", "toks", flat_vocab(spark, sf_dir))
    return enc.select("doc_id", F.array_join("ids", ",").alias("ids"))


# --- sentence borders with learned abbreviations --------------------------------------

LETTERS_SQL = """
SELECT 'order:' || CAST(o_orderkey AS VARCHAR) AS key,
       'Dear customer No. ' || CAST(o_custkey AS VARCHAR) || ', we write about order no. ' || CAST(o_orderkey AS VARCHAR)
       || ' of Acme Ltd. Bill and goods. The goods (approx. ' || CAST(o_orderkey % 90 + 5 AS VARCHAR) || ' pcs. in all) were sent by Mr. Smith of Foo Inc. on '
       || CAST(o_custkey % 28 + 1 AS VARCHAR) || '.5. Smith will call about the order at 9 a.m. or later. We write later about the bill.'
       || chr(10) || 'Customer and bill: ' || CAST(o_custkey AS VARCHAR) || '. All were sent!' AS text
FROM orders
UNION ALL SELECT 'doc:' || CAST(doc_id AS VARCHAR), text FROM documents
"""


def letters(spark, sf_dir):
    """A letter for each order, and the documents; both dealt out evenly, whatever
    the tables' row groups (orders before their letters are written)."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    text = F.concat(F.lit("Dear customer No. "), c, F.lit(", we write about order no. "), k.cast("string"),
                    F.lit(" of Acme Ltd. Bill and goods. The goods (approx. "), (k % 90 + 5).cast("string"),
                    F.lit(" pcs. in all) were sent by Mr. Smith of Foo Inc. on "), (F.col("o_custkey") % 28 + 1).cast("string"),
                    F.lit(".5. Smith will call about the order at 9 a.m. or later. We write later about the bill.\nCustomer and bill: "), c,
                    F.lit(". All were sent!"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").hint("rebalance")
    orders = orders.select(F.concat(F.lit("order:"), k.cast("string")).alias("key"), text.alias("text"))
    return orders.unionByName(corpus(spark, sf_dir).select(F.concat(F.lit("doc:"), F.col("id")).alias("key"), "text").hint("rebalance"))


SCORES_SQL = f"""
WITH l AS ({LETTERS_SQL}),
tok AS (SELECT lower(regexp_replace(regexp_replace(raw, {O.q(AB._LEADING)}, ''), {O.q(AB._TRAILING)}, '')) AS t
        FROM (SELECT unnest(string_split_regex(coalesce(text, ''), '\\s+')) AS raw FROM l)),
cnt AS (SELECT regexp_replace(t, '\\.$', '') AS word, count(*) FILTER (t LIKE '%.') AS a, count(*) FILTER (t NOT LIKE '%.') AS b
        FROM tok WHERE t <> '' GROUP BY 1),
p AS (SELECT sum(a) / sum(a + b) AS p FROM cnt),
sh AS (SELECT word, a, b, p, length(word) - length(replace(word, '.', '')) AS inner_stops FROM cnt, p
       WHERE a > 0 AND regexp_matches(word, {O.q(AB._WORD)})),
sc AS (SELECT word, a AS with_stop, b AS without_stop,
              2 * (a * ln({_num(0.99)}) + b * ln({_num(0.01)}) - a * ln(p) - b * ln(greatest(1 - p, {_num(1e-300)})))
              * exp(-CAST(length(word) - inner_stops AS DOUBLE)) * (inner_stops + 1) * pow(CAST(length(word) - inner_stops AS DOUBLE), -CAST(b AS DOUBLE)) AS score
       FROM sh)
"""


@register("abbreviation_scores", sql=SCORES_SQL + f"""
SELECT word, with_stop, without_stop, CASE WHEN round(score, 6) = 0 THEN 0.0 ELSE round(score, 6) END AS score, score >= {_num(AB.THRESHOLD)} AS is_abbreviation FROM sc
""")
def abbreviation_scores(spark, sf_dir):
    """K1: how far every word's full stop belongs to the word, over letters and documents."""
    s = AB.abbreviation_scores(letters(spark, sf_dir))
    return s.select("word", "with_stop", "without_stop", F.round("score", 6).alias("score"), (F.col("score") >= AB.THRESHOLD).alias("is_abbreviation"))


_LAST_SQL = f"lower(regexp_replace(regexp_replace(regexp_extract(x, '(\\S+)\\s*$', 1), {O.q(AB._LEADING)}, ''), {O.q(AB._TRAILING)}, ''))"


@register("sentences_learned", sql=SCORES_SQL + f""",
ab AS (SELECT coalesce(list(word || '.'), []) AS known FROM sc WHERE score >= {_num(AB.THRESHOLD)}),
pc AS (SELECT key, list_transform({_sql_sentences("coalesce(text, '')")}, lambda x: x || CASE WHEN list_contains(known, {_LAST_SQL}) THEN ' ' ELSE chr(1) END) AS pieces
       FROM l, ab),
j AS (SELECT key, string_split(regexp_replace(array_to_string(pieces, ''), '[ \x01]$', ''), chr(1)) AS s FROM pc)
SELECT key, CAST(len(s) AS INTEGER) AS n_sentences, array_to_string(s, {O.q(SEP)}) AS sentences FROM j
""")
def sentences_learned(spark, sf_dir):
    """K1: sentences of letters and documents; a full stop that belongs to a
    learned abbreviation ends none (``No. 5``, ``Ltd. Bill``)."""
    l = letters(spark, sf_dir)
    known = reliable_checkpoint(AB.abbreviations(l))
    out = AB.with_sentences(l, "text", known, "s")
    return out.select("key", F.size("s").alias("n_sentences"), F.array_join("s", SEP).alias("sentences"))


# --- lemmas ------------------------------------------------------------------------------

LEMMA_SQL = f"""
WITH seg AS (SELECT doc_id, {_sql_segment('text')} AS segs FROM documents),
sw AS (SELECT doc_id, unnest(segs) AS s, generate_subscripts(segs, 1) AS si FROM seg),
ww AS (SELECT doc_id, si, unnest(s) AS word, generate_subscripts(s, 1) AS wi FROM sw),
v AS (SELECT word, count(*) AS n FROM ww GROUP BY word),
cuts AS (SELECT word, n, left(word, length(word) - cut) AS stem, right(word, cut) AS suffix
         FROM v, (SELECT unnest(range({LM.MAX_SUFFIX + 1})) AS cut)
         WHERE regexp_matches(word, '^\\p{{L}}+$') AND length(word) - cut >= {LM.MIN_STEM}),
base AS (SELECT stem, arg_min(suffix, {{'a': -n, 'b': length(word), 'c': word}}) AS becomes, max(n) AS base_n FROM cuts GROUP BY stem),
pr AS (SELECT word, n, suffix, becomes FROM cuts JOIN base USING (stem)
       WHERE suffix <> becomes AND base_n > n AND (suffix = '' OR becomes = '' OR left(suffix, 1) <> left(becomes, 1))),
counted AS (SELECT suffix, becomes, count(*) AS words, CAST(sum(n) AS BIGINT) AS weight FROM pr GROUP BY suffix, becomes HAVING count(*) >= {LM.MIN_WORDS}),
rules AS (SELECT * FROM counted WHERE suffix <> ''
          QUALIFY row_number() OVER (PARTITION BY suffix ORDER BY weight DESC, words DESC, length(becomes), becomes) = 1),
made AS (SELECT cuts.word, length(cuts.suffix) AS len, cuts.stem || rules.becomes AS candidate, cuts.n FROM cuts JOIN rules USING (suffix)),
best AS (SELECT made.word, arg_max(candidate, len) AS lemma FROM made JOIN v ON v.word = made.candidate WHERE v.n > made.n GROUP BY made.word)
"""


def _segments(spark, sf_dir):
    d = corpus(spark, sf_dir).select("doc_id", "text").hint("rebalance")  # segmented by all tasks, whatever the row groups
    return staged(SG.with_segments(d, "text", ["doc_id"]), "segments")


def _counted(segs):
    return segs.select(F.explode_outer(F.flatten("segs")).alias("word")).filter(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@register("lemma_rules", sql=LEMMA_SQL + "SELECT suffix, becomes, words, weight FROM rules")
def lemma_rules(spark, sf_dir):
    """K2: the suffix rules that the vocabulary of all segmented documents teaches."""
    return LM.suffix_rules(_counted(_segments(spark, sf_dir)))


@register("lemma_segments", sql=LEMMA_SQL + f""",
l AS (SELECT doc_id, si, string_agg(coalesce(lemma, word), ' ' ORDER BY wi) AS sentence FROM ww LEFT JOIN best USING (word) GROUP BY doc_id, si)
SELECT doc_id, string_agg(sentence, {O.q(SEP)} ORDER BY si) AS segments FROM l GROUP BY doc_id
""")
def lemma_segments(spark, sf_dir):
    """K2 + K1, K3, K4: the segmented documents with every word's lemma."""
    segs = _segments(spark, sf_dir)
    words = reliable_checkpoint(_counted(segs))
    out = LM.lemmatise(segs, "doc_id", "segs", LM.lemmas(words, LM.suffix_rules(words)))
    return out.select("doc_id", _render(F.col("segs")).alias("segments"))
