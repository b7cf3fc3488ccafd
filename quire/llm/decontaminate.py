"""Benchmark decontamination as a prefix-filtered containment join, on DataFrame
functions only.

A window of an item (``window`` consecutive words; a shorter item is one
window) is the set of its shingles of ``shingle`` words, shorter where the
window is.  Containment must be full, so by the prefix principle one token is
enough to find every candidate: the rarest.

1. Postings: the shingles of whole documents that some item has, with their
   position and the words around it (a window's reach to either side).  Written
   once; all else reads them.
2. Rarity: occurrences of each shingle over all documents.  A window with a
   shingle that no document has is out.
3. Join: postings of a window's rarest shingle.  The positional bound (the
   window starts inside the document) and the length bound (it ends there) cut
   candidates; then the words of the item-sized stretch are compared.
4. Hit words: the union of the verified stretches by a running maximum of
   their ends, per document.

Only tables of the items' windows are broadcast, and only below
``BROADCAST_SHINGLES`` counted rows; beyond that, narrow postings are shuffled by shingle
and the words around the candidates fetched by a second join.

Edge cases: a null or empty text has no words; items without words match
nothing; an item of fewer words than a window must occur whole; rows of items
repeated, or with a null identifier, take part in the hits, and null
identifiers are not listed or counted; every row of the documents gives one
row, repeated and null identifiers included; an empty table on either side
gives no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import LOWER, UPPER, staged

#: What separates words, after A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of an items' table that may be broadcast: 64 MB at 32 bytes each.
BROADCAST_SHINGLES = 2_000_000


def words_of(text) -> Column:
    """The words of a text; none for null."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _hashes(words: str, length: int) -> Column:
    """For each position the hash of the shingle that starts there, null where
    it would end beyond the text."""
    def at(i):
        ends = i + F.lit(length) <= F.size(words)
        return F.when(ends, F.xxhash64(F.lit(length), *(F.get(F.col(words), i + F.lit(k)) for k in range(length))))
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), F.size(words) - 1), at))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 10) -> DataFrame:
    """``item`` and ``words`` of every window of every item."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), words_of(text_col).alias("all")).filter("size(all) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - F.lit(window), F.lit(0)))
    return (rows.select("item", "all", F.explode(starts).alias("at"))
            .select("item", F.slice("all", F.col("at") + 1, F.lit(window)).alias("words")).distinct())


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_id_col: str = "item_id", item_text_col: str = "text", window: int = 10, shingle: int = 5,
                broadcast_rows: int = BROADCAST_SHINGLES) -> DataFrame:
    """Verified occurrences, each once: ``doc`` and ``digest`` (SHA-256 of the
    text) name the document, ``start`` and ``length`` (in words) the stretch,
    ``item`` an item (as string) that has this window."""
    held = staged(item_windows(items, item_id_col, item_text_col, window))
    wanted = held.select("words").distinct().withColumn("window", F.sha2(F.array_join("words", " "), 256))
    size = F.least(F.size("words"), F.lit(shingle))
    lengths = sorted(r[0] for r in wanted.select(size).distinct().collect())  # at most ``shingle`` numbers
    per_length = [wanted.filter(size == n).select("window", "words", F.posexplode(_hashes("words", n)).alias("offset", "hash"))
                  .filter("hash IS NOT NULL") for n in lengths]
    tokens = per_length[0] if per_length else wanted.select("window", "words", F.lit(0).alias("offset"), F.lit(0).cast("long").alias("hash"))
    for more in per_length[1:]:
        tokens = tokens.unionByName(more)
    tokens = staged(tokens)
    small = tokens.limit(broadcast_rows + 1).count() <= broadcast_rows

    def among_items(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    reach = window - min([shingle, *lengths])
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), F.unhex(F.sha2(body, 256)).alias("digest"), words_of(text_col).alias("words"))
    # one array of all lengths, so that a text is cut into words once; place % size is the position.  The outer form keeps
    # Catalyst from adding a filter on the array, which would compute it twice
    hashes = F.concat(*(_hashes("words", n) for n in lengths)) if lengths else F.array().cast("array<bigint>")
    exploded = rows.select("doc", "digest", "words", F.posexplode_outer(hashes).alias("place", "hash")).filter("hash IS NOT NULL")
    at = F.pmod("place", F.size("words"))
    left = F.greatest(at - reach, F.lit(0))
    around = F.slice("words", left + 1, F.lit(2 * window))
    known = tokens.select("hash").distinct()
    if small:  # the words around are cut out after the join, of the few rows that are left
        postings = (exploded.join(F.broadcast(known), "hash")
                    .select("doc", "digest", "hash", at.alias("at"), left.alias("left"), around.alias("around")))
    else:
        postings = exploded.select("doc", "digest", "hash", at.alias("at"), left.alias("left")).join(known, "hash")
    postings = staged(postings)

    rarity = postings.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.join(among_items(rarity), "hash", "left")
    rarest = (ranked.groupBy("window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("least"), F.first("words").alias("words"))
        .filter("least.n > 0").select("window", "words", "least.hash", "least.offset"))
    found = postings.join(among_items(rarest.withColumnRenamed("words", "expected")), "hash").withColumn("start", F.col("at") - F.col("offset")).filter("start >= 0")
    if not small:
        near = found.select("doc", "digest", "start").distinct()
        texts = rows.join(near.select("doc", "digest").distinct().select(F.col("doc").alias("d"), F.col("digest").alias("g")),
                          F.col("doc").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")), "left_semi")
        near = near.select(F.col("doc").alias("d"), F.col("digest").alias("g"), F.col("start").alias("s"))
        cut = texts.dropDuplicates(["doc", "digest"]).join(near, F.col("doc").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g"))).select(
            "d", "g", "s", F.slice("words", F.col("s") + 1, F.lit(window)).alias("around"))
        found = found.join(cut, F.col("doc").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("g")) & (F.col("start") == F.col("s"))
                           ).withColumn("left", F.col("start"))
    skip = F.col("start") - F.col("left")
    verified = (found.filter(skip + F.size("expected") <= F.size("around"))
                .filter(F.slice("around", skip + 1, F.size("expected")) == F.col("expected"))
                .select("doc", "digest", "start", F.size("expected").alias("length"), "window").distinct())
    owners = held.select("item", F.sha2(F.array_join("words", " "), 256).alias("window"))
    return verified.join(among_items(owners), "window").select("doc", "digest", "start", "length", "item")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``<id_col>``, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` and ``contaminated``.  ``options`` go to ``occurrences``."""
    found = staged(occurrences(docs, items, id_col, text_col, **options))
    # words of a stretch that no earlier stretch of the document has reached
    before = Window.partitionBy("doc", "digest").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    stretches = found.select("doc", "digest", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = (stretches.withColumn("fresh", F.greatest(fresh, F.lit(0)))
           .groupBy("doc", "digest").agg(F.sum("fresh").alias("n_hit")))
    listed = (found.select("doc", "digest", "item").distinct().groupBy("doc", "digest")
              .agg(F.count("item").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items")))
    same = F.col("h.doc").eqNullSafe(F.col("l.doc")) & (F.col("h.digest") == F.col("l.digest"))
    judged = hit.alias("h").join(listed.alias("l"), same).select(
        F.col("h.doc").alias("doc"), F.col("h.digest").alias("digest"), "n_hit", "n_items", "items")
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(body, 256)).alias("sha"),
                       F.size(words_of(text_col)).cast("long").alias("n_words"))
    out = rows.join(judged, F.col("id").eqNullSafe(F.col("doc")) & (F.col("sha") == F.col("digest")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p + 1:p + 10], ' ') AS win
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, p, array_to_string(w[p + 1:p + n], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT dw.r, dw.n, dw.p, bw.item FROM dw JOIN bw USING (n, win)),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""
