"""N-gram Jaccard self-join by vertical partitioning.

The n-gram space (64-bit hashes of word 5-grams) is cut into fragments.  Each
fragment sees every text's n-grams of its range, so partial counts are made
fragment by fragment and summed, per text or per pair:

1. Texts with equal sets are one node (a 128-bit digest of the set).
2. Texts without partners go first.  In a fixed part of the n-gram space, the
   n-grams that another node has too are counted per fragment and summed per
   node (a fragment with few of them counts as if it had a third); a node with
   more than ``n - ceil(0.8 n)`` n-grams of its own links with nothing.  Memory of a fragment is bounded by their number.
3. For the rest, document counts give the global order (rare first); n-grams
   that one node has alone cannot overlap and only count for its size.  Two
   linked nodes share an n-gram among the first ``n - ceil(0.8 n) + 1``; a pair
   also has to fit by the n-gram's positions and by the parity bitmaps of the
   two sets, whose differing bits are no more than the sets' differing n-grams.
4. Pairs are not made within a group that is already connected.  First every
   posting list pairs its members with a pivot (as many pairs as there are
   postings); the links found make components; then members of different
   components are paired, so no link between components is missed.
5. A pair's overlap is counted per fragment and summed per pair.  Connected
   components of the links give the result.

Every step is a shuffle by fragment, n-gram, node or pair; nothing is gathered.

Edge cases: words are runs without the six ASCII white-space bytes, A-Z
lowered; a text with one to four words is one n-gram; null and empty texts have
an empty set and are their own component; rows with a null identifier are
returned and never name a component; repeated identifiers are handled by text;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import give_back, staged, tidy
from quire.llm.words import Words, mix, portions

N_WORDS = 5
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: n-grams of one fragment, and the fewest fragments.
FRAGMENT_NGRAMS, LEAST_FRAGMENTS = 2_000_000, 4
#: The first filter counts n-grams whose top three bits are below this: 3/8 of the space.
PART_OF_EIGHT = 3
#: Orders of preference among pivots; a text meets about as many pivots.
PIVOT_ORDERS = 16
#: Bytes of the batches in which texts come to a worker.
BATCH_BYTES = 8 << 20
#: Bits of a set's parity bitmap: each is the parity of the n-grams that fall on it.
BITMAP_BITS = 512
_STEP = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xA24BAED4963EE407, 0xD6E8FEB86659FD93,
                                0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def ngram_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    for _, buffer, bounds in portions(texts):
        words = Words(buffer)
        value = words.hashes()
        first = np.searchsorted(words.starts, bounds)
        grams = np.zeros(max(0, len(value) - N_WORDS + 1), np.uint64)
        for k, step in enumerate(_STEP):
            grams += value[k:k + len(grams)] * step
        grams = mix(grams)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= N_WORDS:
                yield np.unique(grams[a:b - N_WORDS + 1])
            elif b > a:
                whole = np.uint64(b - a) + (value[a:b] * np.array(_STEP[:b - a])).sum(dtype=np.uint64)
                yield mix(np.array([whole], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def _node(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def _part(grams: np.ndarray) -> np.ndarray:
    return grams[:np.searchsorted(grams, np.uint64(PART_OF_EIGHT << 61))]


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, nodes, parts = [], [], []
        for grams in ngram_sets(batch.column("text").to_pylist()):
            sizes.append(len(grams))
            nodes.append(_node(grams))
            parts.append(_part(grams).tobytes())
        others = [c for c in batch.schema.names if c not in ("id", "text")]  # row among them
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(parts, pa.binary()),
             *(batch.column(c) for c in others)], names=["id", "n", "node", "part", *others])


FRAGMENT_SCHEMA = "fragment long, nodes binary, sizes binary, counts binary, grams binary"


def _cut(fragments: int, top: int):
    """Nodes and their packed n-grams to rows (fragment, packed texts): one row
    per batch and fragment, copies of a node left out.  ``top`` is the end of
    the hash range, of 2**61 units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array([(top << 61) * k // fragments for k in range(1, fragments)], np.uint64)
        for batch in batches:
            seen = {}
            for node, n, packed in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "grams")), strict=True):
                seen.setdefault(node, (n, np.frombuffer(packed, np.uint64)))
            if not seen:
                continue
            cuts = np.array([[0, *np.searchsorted(g, bounds), len(g)] for _, g in seen.values()])
            nodes, sizes = list(seen), np.array([n for n, _ in seen.values()], np.int32)
            out = []
            for f in range(fragments):
                counts = (cuts[:, f + 1] - cuts[:, f]).astype(np.int32)
                has = np.flatnonzero(counts)
                if len(has):
                    out.append((f, b"".join(nodes[i] for i in has), sizes[has].tobytes(), counts[has].tobytes(),
                                b"".join(seen[nodes[i]][1][cuts[i, f]:cuts[i, f + 1]].tobytes() for i in has)))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                             names=["fragment", "nodes", "sizes", "counts", "grams"])
    return run


def _fragment(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct nodes of a fragment: nodes, sizes, counts, n-grams and, for
    each n-gram, in how many nodes it is."""
    def flat(name, kind):
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    nodes, grams = flat("nodes", [("a", "<u8"), ("b", "<u8")]), flat("grams", np.uint64)
    sizes, counts = flat("sizes", np.int32), flat("counts", np.int32)
    chosen = np.zeros(len(nodes), bool)
    chosen[np.unique(nodes, return_index=True)[1]] = True
    grams = grams[np.repeat(chosen, counts)]
    nodes, sizes, counts = nodes[chosen], sizes[chosen], counts[chosen]
    order = np.argsort(grams, kind="stable").astype(np.int32)
    ranked = grams[order]
    run = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]), dtype=np.int32)
    among = np.empty(len(grams), np.int32)
    among[order] = np.bincount(run).astype(np.int32)[run]
    return nodes, sizes, counts, grams, among


#: A node's fragment is reported when more than one in so many of its n-grams there are shared.
FEW = 3


def _shared_counts(table):
    """Nodes of which more than a ``FEW``-th of the n-grams in this fragment are
    shared: how many, of how many."""
    nodes, _, counts, _, among = _fragment(table)
    owner = np.repeat(np.arange(len(nodes), dtype=np.int32), counts)
    shared = np.bincount(owner[among > 1], minlength=len(nodes))
    has = np.flatnonzero(shared * FEW > counts)
    del owner
    give_back()
    return pa.table({"node": pa.array([nodes[i].tobytes() for i in has], pa.binary()),
                     "shared": pa.array(shared[has], pa.int64()), "held": pa.array(counts[has], pa.int64())})


def _parities(grams: np.ndarray) -> np.ndarray:
    odd = np.bincount((grams & np.uint64(BITMAP_BITS - 1)).astype(np.int64), minlength=BITMAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _segments(key, table):
    """Per node: its n-grams of this fragment that other nodes have too, and
    the parities of all it has here."""
    nodes, sizes, counts, grams, among = _fragment(table)
    ends = np.cumsum(counts)
    rows = []
    for node, n, end, count in zip(nodes, sizes.tolist(), ends.tolist(), counts.tolist(), strict=True):
        own, both = grams[end - count:end], among[end - count:end]
        keep = both > 1
        rows.append((node.tobytes(), n, key[0].as_py(), own[keep].tobytes(), both[keep].tobytes(), _parities(own).tobytes()))
    del grams, among
    give_back()
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({name: pa.array(c, k) for name, c, k in
                     zip(("node", "n", "fragment", "grams", "among", "bits"), columns, kinds, strict=True)})


def required(n: int) -> int:
    """The least overlap of a set of ``n`` with any partner."""
    return -(-PERCENT * n // 100)


BITS = [f"b{k}" for k in range(BITMAP_BITS // 64)]
POSTING_SCHEMA = "gram bigint, node binary, n bigint, pos bigint, " + ", ".join(f"{b} bigint" for b in BITS)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node: the first n-grams in the global order, rare ones first, with
    their positions; those the node has alone come before all and make no
    posting."""
    for batch in batches:
        out, bits = [], []
        for node, n, segments in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "segments")), strict=True):
            grams = np.concatenate([np.frombuffer(s["grams"], np.uint64) for s in segments])
            among = np.concatenate([np.frombuffer(s["among"], np.int32) for s in segments])
            parities = np.bitwise_xor.reduce([np.frombuffer(s["bits"], np.int64) for s in segments])
            alone = n - len(grams)
            length = n - required(n) + 1 - alone
            if length > 0:
                for pos, gram in enumerate(grams[np.lexsort((grams, among))[:length]].astype(np.int64).tolist(), alone):
                    out.append((gram, node, n, pos))
                    bits.append(parities)
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        bits = np.stack(bits) if bits else np.empty((0, len(BITS)), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)]
            + [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(len(BITS))],
            names=["gram", "node", "n", "pos", *BITS])


#: Pairs that are unpacked at once.
PAIRS_AT_ONCE = 256


def _overlap(a: list[dict], b: list[dict], total: int) -> int:
    """Partial overlaps, fragment by fragment, summed; it stops where what is
    left cannot make a link any more."""
    other = {s["fragment"]: np.frombuffer(s["grams"], np.uint64) for s in b}
    left, overlap = sum(len(s["grams"]) // 8 for s in a), 0
    for s in a:
        own = np.frombuffer(s["grams"], np.uint64)
        left -= len(own)
        if len(own) and s["fragment"] in other:
            overlap += len(np.intersect1d(own, other[s["fragment"]], assume_unique=True))
        if (overlap + left) * (100 + PERCENT) < total * PERCENT:
            break
    return overlap


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PAIRS_AT_ONCE):
            part = batch.slice(at, PAIRS_AT_ONCE)
            total = part.column("total").to_pylist()
            overlaps = [_overlap(*x) for x in zip(part.column("segments_a").to_pylist(), part.column("segments_b").to_pylist(),
                                                  total, strict=True)]
            keep = pa.array([o * (100 + PERCENT) >= t * PERCENT for o, t in zip(overlaps, total, strict=True)])
            yield part.select(["a", "b"]).filter(keep)


def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b, total: sum of the sizes) that are links."""
    grams = F.transform("segments", lambda s: F.struct(s["fragment"].alias("fragment"), s["grams"].alias("grams")))
    left = nodes.select(F.col("node").alias("a"), grams.alias("segments_a"))
    right = nodes.select(F.col("node").alias("b"), grams.alias("segments_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "total", "segments_a", "segments_b").mapInArrow(
        tidy(_links), "a binary, b binary")


def _fit(a, b):
    """Positions and sizes of two postings allow a link: the overlap is at most
    what either set has from the common n-gram on."""
    total = a("n") + b("n")
    return (((a("n") - a("pos")) * (100 + PERCENT) >= total * PERCENT)
            & ((b("n") - b("pos")) * (100 + PERCENT) >= total * PERCENT))


def _alike(a, b):
    """Parities allow a link: the sets differ in no fewer n-grams than their
    bitmaps in bits."""
    differ = sum((F.bit_count(a(k).bitwiseXOR(b(k))) for k in BITS), F.lit(0))
    return differ * (100 + PERCENT) <= (a("n") + b("n")) * (100 - PERCENT)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of the nodes of ``links``; a component is named by its
    least node.  Alternating large-star and small-star, with the edges written
    to the shared folder after each round, until they no longer change."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()

    def around(pairs: DataFrame) -> DataFrame:
        """With the least neighbour ``w`` of each u; a join, which may split a hot u."""
        return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("w")), "u")

    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large-star: the larger neighbours of a node point to the least of all
        large = (around(both).withColumn("m", F.least("u", "w")).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))
        # small-star: a node and its smaller neighbours point to the least of these
        low = around(large).withColumnRenamed("w", "m")
        edges = staged(low.select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _fragments(ngrams: int) -> int:
    return max(LEAST_FRAGMENTS, -(-ngrams // FRAGMENT_NGRAMS))


def candidates(members: DataFrame) -> DataFrame:
    """The nodes that may have partners, each with the ``row`` of one text."""
    nodes = (members.filter("n > 0").groupBy("node").agg(
        F.min("row").alias("row"), F.max("n").alias("n"), F.max(F.octet_length("part") / 8).cast("long").alias("seen")))
    total = nodes.agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("n")).first()["n"]
    cut = (members.filter("n > 0").select("node", "n", F.col("part").alias("grams"))
           .mapInArrow(tidy(_cut(_fragments(total), PART_OF_EIGHT)), FRAGMENT_SCHEMA))
    shared = (cut.groupBy("fragment").applyInArrow(_shared_counts, "node binary, shared bigint, held bigint")
              .groupBy("node").agg(F.sum("shared").alias("shared"), F.sum("held").alias("held")))
    shared_n, held = F.coalesce("shared", F.lit(0)), F.coalesce("held", F.lit(0))
    # n-grams of its own: those known, and at least all but a FEW-th of those in fragments not reported
    own = F.lit(FEW) * (held - shared_n) + F.lit(FEW - 1) * (F.col("seen") - held)
    return (nodes.join(shared, "node", "left")
            .filter(own <= FEW * (F.col("n") - F.ceil(F.col("n") * PERCENT / 100))).select("node", "row", "n"))


def linked(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(node, component) of the nodes that link with another."""
    chosen = staged(candidates(members), BATCH_BYTES)
    total = chosen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(_node(g), len(g), g.tobytes()) for g in ngram_sets(batch.column("text").to_pylist()) if len(g)]
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in
                                              zip(columns, (pa.binary(), pa.int64(), pa.binary()), strict=True)],
                                             names=["node", "n", "grams"])

    texts = docs.select("row", "text").join(chosen.select("row"), "row", "left_semi").select("text")
    fragments = _cut(_fragments(total), 8)
    cut = texts.mapInArrow(tidy(lambda batches: fragments(sets(batches))), FRAGMENT_SCHEMA)
    segments = cut.groupBy("fragment").applyInArrow(
        _segments, "node binary, n bigint, fragment bigint, grams binary, among binary, bits binary")
    nodes = staged(segments.groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("fragment", "grams", "among", "bits"))).alias("segments")), BATCH_BYTES)
    postings = staged(nodes.mapInArrow(tidy(_postings), POSTING_SCHEMA), BATCH_BYTES)

    # pairs with pivots: at most as many as there are postings
    order = F.pmod(F.col("gram"), F.lit(PIVOT_ORDERS))
    lists = postings.select("gram", "node", "n", "pos")
    pivots = lists.groupBy("gram").agg(F.min(F.struct(F.xxhash64("node", order).alias("place"), "node", "n", "pos")).alias("pivot"))
    p = lists.join(pivots, "gram").filter((F.col("node") != F.col("pivot.node"))
                                          & _fit(lambda c: F.col(c), lambda c: F.col(f"pivot.{c}")))
    pairs = p.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b"),
                     (F.col("n") + F.col("pivot.n")).alias("total")).distinct()
    first = staged(verified(pairs, nodes), BATCH_BYTES)

    # members of one posting list that are in different components by now
    stars = staged(components(first))
    named = postings.join(stars, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_lists = named.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("gram")
    named = staged(named.join(open_lists, "gram", "left_semi"))
    x, y = named.alias("x"), named.alias("y")
    crossing = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") < F.col("y.node"))
                      & (F.col("x.component") != F.col("y.component"))
                      & _fit(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))
                      & _alike(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}")))
    pairs = crossing.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"),
                            (F.col("x.n") + F.col("y.n")).alias("total")).distinct()
    second = verified(pairs, nodes)
    return components(stars.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second))


def _labelled(rows: DataFrame, *others: str) -> DataFrame:
    """``id``, ``n``, ``component`` (a node) and ``others`` of every row of
    ``rows`` (id, text and others)."""
    kinds = dict(rows.dtypes)
    # a text is fetched again by this name of its row, which null identifiers have too
    rows = rows.withColumn("row", F.xxhash64("id", "text"))
    schema = [f"id {kinds['id']}, n bigint, node binary, part binary", *(f"{c} {kinds[c]}" for c in others), "row bigint"]
    members = staged(rows.select("id", "text", *others, "row").mapInArrow(tidy(_members), ", ".join(schema)), BATCH_BYTES)
    return (members.select("id", "n", "node", *others).join(linked(rows, members), "node", "left")
            .select("id", "n", F.coalesce("component", "node").alias("component"), *others))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``<id_col>``, ``n_shingles`` and
    ``component_id``, the least identifier reachable by links."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    labelled = _labelled(rows)
    names = labelled.groupBy("component").agg(F.min("id").alias("least"))
    return (labelled.join(names, "component", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id")))


def dropped(docs: DataFrame, key_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<key_col>`` of the rows that go when one row of each component stays:
    that of the least identifier (null is last), then of the least SHA-256 of the text, then of
    the least key.  Texts without words stay.  Keys name rows, so repeated rows are told apart."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.col(key_col).alias("key"),
                       F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)).alias("digest"))
    labelled = staged(_labelled(rows, "key", "digest").filter("n > 0").drop("n"))
    first = F.struct(F.col("id").isNull().alias("last"), "id", "digest", "key")
    best = labelled.groupBy("component").agg(F.min(first).alias("best")).select("component", F.col("best.key").alias("kept"))
    return labelled.join(best, "component").filter(F.col("key") != F.col("kept")).select(F.col("key").alias(key_col))
