"""SimHash near-duplicates: fingerprints that differ in few bits are linked, linked ones are a component.

Candidates come from the strong pigeonring principle. A fingerprint is a ring of five segments; if two
differ in four bits at most, there is a segment from which every chain of l consecutive segments
differs in l * 4 / 5 bits at most: none in the first, one in the first two, and so on. The first two
boxes are the join key (the second in every form with one bit set more), the longer chains and the
whole distance are tested on the candidates.

Equal fingerprints are one node. Large groups are contracted before pairs are made: all fingerprints
of a key meet one hub, and the full search then returns only pairs of different components, so a group
of n copies costs n links and not n^2.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import bound_batches, column, fresh, text_of
from txlake.session import stage

BITS = 64
MAX_DISTANCE = 4
# Widths of the segments from the lowest bit, one more of them than bits may differ.
WIDTHS = (13, 13, 13, 13, 12)
HASH_SEED = 42
SLAB = 1 << 15


def fingerprint(text: str, shingle: int = 4) -> int:
    """A bit is set if it is set in more than half of the hashes of the text's shingles."""
    import xxhash

    # bytes.lower and bytes.split know ASCII only: A-Z and the six white-space characters.
    found = text.encode().lower().split()
    if not found:
        return 0
    whole = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(whole, seed=HASH_SEED)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(found) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(starts), SLAB):
        hashes = np.array([digest(whole[a:b], HASH_SEED) for a, b in zip(starts[lo : lo + SLAB], stops[lo : lo + SLAB])], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def fingerprints(text: Column, shingle: int = 4) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return of(text_of(text))


def _segments() -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    return [(sum(WIDTHS[:i]), w) for i, w in enumerate(WIDTHS)]


def _cut(fp: Column, at: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))


def _chain_ok(a: Column, b: Column, first: Column, limit: int) -> Column:
    """Every chain from segment ``first`` on differs within its share of the bits, the whole ring too."""
    differing = a.bitwiseXOR(b)
    boxes = [F.bit_count(_cut(differing, at, w)) for at, w in _segments()]
    m = len(boxes)
    conds = []
    for start in range(m):
        total, ok = None, F.lit(True)
        for step in range(m):
            box = boxes[(start + step) % m]
            total = box if total is None else total + box
            ok = ok & (total <= (step + 1) * limit // m)
        conds.append((first == start) & ok)
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def _keys(fp: Column, variants: bool) -> Column:
    """Per chain start: the key of the first two segments; with ``variants`` also every key whose
    second segment has one more bit set. (key, start, flipped)"""
    parts = _segments()
    rows = []
    for i, (at, w) in enumerate(parts):
        at2, w2 = parts[(i + 1) % len(parts)]
        lead = F.shiftleft(F.lit(i).cast("long"), 58).bitwiseOR(F.shiftleft(_cut(fp, at, w), 26))
        rows.append(_chain_keys(i, lead, _cut(fp, at2, w2), w2 if variants else 0))
    return F.concat(*rows)


def _chain_keys(i: int, lead: Column, second: Column, flips: int) -> Column:
    def row(box: Column, flipped: bool) -> Column:
        return F.struct(lead.bitwiseOR(box).alias("key"), F.lit(i).alias("first"), F.lit(flipped).alias("flipped"))

    same = F.array(row(second, False))
    if not flips:
        return same
    bits = F.array(*[F.lit(1 << k).cast("long") for k in range(flips)])
    clear = F.filter(bits, lambda bit: second.bitwiseAND(bit) == 0)
    return F.concat(same, F.transform(clear, lambda bit: row(second.bitwiseOR(bit), True)))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star algorithm; edges are (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("of"), F.least("a", "low").alias("low"))
    met = both.join(least, both["a"] == least["of"])
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select(F.col("of").alias("a"), F.col("low").alias("b"))
        )
    return out.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b) but the
    smallest of each component. Alternating large and small stars; each step is written to the
    shared folder, nothing but counts reaches the driver."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stage(edges.select(high.alias("a"), low.alias("b")).where(F.col("a") > F.col("b")).distinct(), "edges")
    mark = _mark(edges)
    while True:
        edges = stage(_star(_star(edges, large=True), large=False), "edges")
        now = _mark(edges)
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now


def _mark(edges: DataFrame) -> tuple:
    """Tells edge sets apart."""
    sums = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(7)))
    )
    return tuple(sums.first())


def link(fps: DataFrame, limit: int = MAX_DISTANCE) -> DataFrame:
    """(fp, component) for the distinct fingerprints of ``fps`` (fp, n); n says how many rows have it.

    Two fingerprints that differ in at most ``limit`` bits (fewer than there are segments) are linked.
    """
    if limit >= len(WIDTHS):
        raise ValueError(f"at most {len(WIDTHS) - 1} bits")
    index = fps.select("fp", "n", F.explode(_keys(F.col("fp"), variants=False)).alias("k")).select("fp", "n", "k.key", "k.first")
    hubs = index.groupBy("key").agg(F.max_by("fp", "n").alias("hub"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= limit
    stars = index.join(hubs, "key").where((F.col("fp") != F.col("hub")) & near).select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    first = components(stars)
    known = stage(
        fps.select("fp").join(first, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("c")), "contracted"
    )
    sought = known.select(F.col("fp").alias("x"), F.col("c").alias("cx"), F.explode(_keys(F.col("fp"), variants=True)).alias("k")).select("x", "cx", "k.*")
    held = known.select(F.col("fp").alias("y"), F.col("c").alias("cy"), F.explode(_keys(F.col("fp"), variants=False)).alias("k")).select(
        "y", "cy", F.col("k.key").alias("held_key")
    )
    pairs = sought.join(
        held,
        (F.col("key") == F.col("held_key")) & (F.col("cx") != F.col("cy")) & (F.col("flipped") | (F.col("x") < F.col("y")))
        & _chain_ok(F.col("x"), F.col("y"), F.col("first"), limit),
    )
    second = components(pairs.select(F.col("cx").alias("a"), F.col("cy").alias("b")))
    return known.join(second, F.col("c") == F.col("node"), "left").select("fp", F.coalesce("component", "c").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, limit: int = MAX_DISTANCE) -> DataFrame:
    """(id, version, fp, component_id): one row per row of ``docs``.

    ``fp`` is the fingerprint as a signed integer, ``version`` a hash of the text, ``component_id`` the
    smallest id that can be reached over links, the row's own included (null if all of them are null).
    Null, empty and blank texts have the fingerprint zero and are linked like any other. Ids are
    integers; other columns play no part, whatever their names. An empty table gives no rows. A very
    long text takes time in proportion to its length and memory for its words.
    """
    bound_batches(docs.sparkSession)
    text = column(docs, text_col)
    rows = stage(
        docs.select(column(docs, id_col).cast("long").alias("id"), F.xxhash64(text_of(text)).alias("version"), fingerprints(text, shingle).alias("fp")),
        "fingerprints",
    )
    fps = stage(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")), "distinct-fingerprints")
    linked = link(fps, limit)
    placed = stage(fps.join(linked, "fp").select("fp", "least", "component"), "placed-fingerprints")
    # Written, so that the join back has an exchange of its own on either side: AQE can then split a
    # component of very many fingerprints, or broadcast a short list.
    least = stage(placed.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    labels = placed.join(least, "component").select(F.col("fp").alias("of"), "component_id", "component")
    return rows.join(labels, F.col("fp") == F.col("of")).select("id", "version", "fp", "component_id", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, limit: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, nulls last, then by hash of the row."""
    found = stage(near_duplicates(docs, id_col, text_col, shingle, limit), "near-duplicates")
    order = F.struct(F.col("id").isNull().alias("absent"), "id", "version")
    best = found.groupBy("component").agg(F.min(order).alias("best"))
    rows = found.groupBy("id", "version").agg(F.count(F.lit(1)).alias("rows"))
    best = best.select(F.col("best.id").alias("best_id"), F.col("best.version").alias("best_version"))
    best = best.join(rows, best["best_id"].eqNullSafe(rows["id"]) & (best["best_version"] == rows["version"])).select("best_id", "best_version", "rows")
    alone, many = fresh(docs, "alone", "nth")
    met = docs.join(
        best,
        column(docs, id_col).cast("long").eqNullSafe(best["best_id"]) & (F.xxhash64(text_of(column(docs, text_col))) == best["best_version"]),
    ).select(*[column(docs, c) for c in docs.columns], (best["rows"] == 1).alias(alone))
    single = met.where(column(met, alone)).drop(alone)
    # Rows that share id and text: the first by the hash of all columns, kept by a partial minimum.
    repeated = met.where(~column(met, alone)).drop(alone)
    everything = [column(repeated, c) for c in docs.columns]
    key = [column(repeated, id_col).alias("k1"), F.xxhash64(text_of(column(repeated, text_col))).alias("k2")]
    one = repeated.groupBy(*key).agg(F.min_by(F.struct(*everything), F.xxhash64(*everything)).alias(many))
    return single.unionByName(one.select(F.col(many + ".*")))
