"""SimHash near-duplicates with pivot distance tables (operator 7).

Fingerprints are computed in place, one narrow row per document.  From then on
only *different* fingerprints are compared.  A pivot table holds their Hamming
distances to a set of reference fingerprints; by the triangle inequality two
fingerprints within ``max_distance`` differ by at most that in every coordinate.

A scan of the pivot table alone would hold all pairs against each other, which
grows with the square of the corpus.  So pairs are first limited exactly: of
``B`` blocks of bits at most ``max_distance`` can differ, so two linked
fingerprints agree on at least ``B - max_distance`` whole blocks and meet in the
bucket of one choice of that many blocks.  Inside the buckets the pivot
coordinates discard pairs and the survivors are verified bit by bit.  A bucket
gives no pairs but a spanning star for what it links; components of these are
the result, so no link between different fingerprints is lost.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import raw_texts, slices
from .common import free_name, materialize, row_hash, table
from .components import connected_components

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
PIVOTS = 16
BUCKET_ROWS = 2048          # larger buckets are compared part by part
FILL = 8                    # fingerprints per bucket that the number of blocks aims at


def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a text (repeats count)."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at:at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, extra: list[Column] = (), text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``extra`` columns and ``fp`` (bigint) for every row; null text: no words."""
    cols = docs.select(*extra, F.col(text_col).alias("_t"))
    kept = cols.columns[:-1]

    def run(batches):
        for batch in batches:
            for rb in slices(batch, "_t"):
                fp = [fingerprint(raw, shingle, seed) for raw in raw_texts(rb.column("_t"))]
                yield pa.RecordBatch.from_arrays([*[rb.column(c) for c in kept], pa.array(fp, pa.int64())],
                                                 names=[*kept, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols.schema.fields[:-1])
    return cols.mapInArrow(run, schema + ", fp bigint")


# ------------------------------------------------------------------ buckets

def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, fixed by a seed."""
    return [int(x) for x in np.random.Generator(np.random.PCG64(7)).integers(
        -(1 << 63), 1 << 63, n, dtype=np.int64)]


def pivot_table(fps: DataFrame, n: int = PIVOTS) -> DataFrame:
    """``fp`` and its distances to ``n`` pivots, eight of them (a byte each) to a
    column ``d0, d1, ...``."""
    refs, cols = pivots(n), []
    for at in range(0, n, 8):
        packed = F.lit(0).cast("bigint")
        for k, p in enumerate(refs[at:at + 8]):
            one = F.bit_count(F.col("fp").bitwiseXOR(F.lit(p).cast("bigint"))).cast("bigint")
            packed = packed.bitwiseOR(F.shiftleft(one, 8 * k))
        cols.append(packed.alias(f"d{at // 8}"))
    return fps.select("fp", *cols)


def n_blocks(different: int, max_distance: int) -> int:
    """Blocks of bits so that buckets of random fingerprints hold about ``FILL``.
    Decides the cost, not the result."""
    b = max_distance + 1
    while b < 4 * max_distance and different > FILL * 2 ** (64 * (b - max_distance) / b):
        b += 1
    return max(b, max_distance + 2)


def bucket_masks(blocks: int, max_distance: int) -> list[int]:
    """One mask per choice of ``blocks - max_distance`` blocks, as signed longs."""
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    out = []
    for keep in combinations(range(blocks), blocks - max_distance):
        m = 0
        for i in keep:
            m |= ((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def _stars(group: np.ndarray, fp: np.ndarray, coords: np.ndarray, side: np.ndarray,
           max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare rows of the same (contiguous) group; returns star edges (centre,
    fingerprint) of what they link.  ``side``: rows with different sides, or with
    side -1, are compared (two parts of a split bucket)."""
    n = len(fp)
    label = np.arange(n)
    links = []
    active = np.arange(n - 1)
    step = 1
    while True:
        active = active[active + step < n]
        active = active[group[active] == group[active + step]]
        if not len(active):
            break
        i, j = active, active + step
        ok = (side[i] < 0) | (side[i] != side[j])
        i, j = i[ok], j[ok]
        for at in range(0, coords.shape[1], 4):         # pivots discard
            near = np.abs(coords[i, at:at + 4] - coords[j, at:at + 4]).max(axis=1) <= max_distance
            i, j = i[near], j[near]
        near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= max_distance      # verify
        if near.any():
            links.append((i[near], j[near]))
        step += 1
    if not links:
        return fp[:0], fp[:0]
    i, j = (np.concatenate(x) for x in zip(*links))
    while True:                                         # smallest position of each component
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    leaf = np.nonzero(label != np.arange(n))[0]
    return fp[label[leaf]], fp[leaf]


def bucket_links(rows: DataFrame, max_distance: int, width: int) -> DataFrame:
    """Rows ``(t, key, part, side, fp, d...)``, co-located and sorted by the first
    three -> star edges ``(u, v)``."""
    dcols = [f"d{k}" for k in range(width)]

    def run(batches):
        held = None
        for rb in batches:
            tb = pa.Table.from_batches([rb])
            tb = tb if held is None else pa.concat_tables([held, tb])
            yield from emit(tb, False)
            held = emit.rest
        if held is not None and held.num_rows:
            yield from emit(held, True)

    def emit(tb, last):
        tb = tb.combine_chunks()
        t, key, part = (tb.column(c).to_numpy() for c in ("t", "key", "part"))
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        end = len(t) if last else int(np.nonzero(new)[0][-1]) if len(t) else 0
        emit.rest = tb.slice(end)
        if end:
            coords = np.ascontiguousarray(np.stack(
                [tb.column(c).to_numpy()[:end] for c in dcols], axis=1)).view(np.int8)
            fp = tb.column("fp").to_numpy()[:end]
            u, v = _stars(np.cumsum(new[:end]), fp, coords, tb.column("side").to_numpy()[:end], max_distance)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return rows.mapInArrow(run, "u bigint, v bigint")


def linked(fps: DataFrame, max_distance: int = MAX_DISTANCE, n_pivots: int = PIVOTS) -> DataFrame:
    """Different fingerprints ``fp`` -> ``(fp, root)`` for those linked to another."""
    tab = materialize(pivot_table(fps, n_pivots), "pivots")
    masks = bucket_masks(n_blocks(tab.count(), max_distance), max_distance)
    width = len(tab.columns) - 1
    rows = tab.select("fp", *[f"d{k}" for k in range(width)], F.explode(F.array(*[
        F.struct(F.lit(t).cast("int").alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("key"))
        for t, m in enumerate(masks)])).alias("b")).select(
        F.col("b.t").alias("t"), F.col("b.key").alias("key"), F.lit(0).alias("part"),
        F.lit(-1).alias("side"), "fp", *[f"d{k}" for k in range(width)])
    large = materialize(
        rows.groupBy("t", "key").count().where(F.col("count") > BUCKET_ROWS)
        .select("t", "key", F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("parts")), "large-buckets")
    if not large.isEmpty():
        # part i of a large bucket meets itself and every later part: one group
        # for each pair of parts, each of a bounded size
        split = (rows.join(large, ["t", "key"])
                 .withColumn("p", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
                 .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                 .withColumn("part", 1 + F.least("p", "q") * F.col("parts") + F.greatest("p", "q"))
                 .withColumn("side", F.when(F.col("p") == F.col("q"), -1)
                             .when(F.col("p") < F.col("q"), 0).otherwise(1)))
        rows = rows.join(large, ["t", "key"], "left_anti").select(rows.columns).unionByName(
            split.select(rows.columns))
    rows = rows.repartition("t", "key", "part").sortWithinPartitions("t", "key", "part", "fp")
    star = connected_components(bucket_links(rows, max_distance, width))
    return star.select(F.col("node").alias("fp"), "root")


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                  extra: list[Column] = ()) -> DataFrame:
    """As ``near_duplicates``, with ``_root``, the smallest fingerprint of the
    component: the component itself, whatever the ids of its documents."""
    rows = materialize(fingerprints(docs, [F.col(id_col).alias("_id"), *extra], text_col, shingle), "fp")
    firsts = rows.groupBy("fp").agg(F.min("_id").alias("_first"))
    roots = linked(firsts.select("fp"), max_distance)
    known = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = materialize(known, "fp-roots")
    smallest = known.groupBy("root").agg(F.min("_first").alias("component_id"))
    of_fp = known.join(smallest, "root").select("fp", "component_id", F.col("root").alias("_root"))
    return rows.join(of_fp, "fp").withColumnRenamed("_id", id_col)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE,
                    extra: list[Column] = ()) -> DataFrame:
    """One row per document: id, ``extra`` columns, ``fp`` and ``component_id``, the
    smallest id among all documents reachable over links (fingerprints that
    differ in at most ``max_distance`` bits).  Texts without words (null, empty)
    have fingerprint zero and are linked like any other.  Null ids never are the
    smallest, unless there is no other; repeated rows stay; empty table: no rows."""
    return components_of(docs, id_col, text_col, shingle, max_distance, extra).drop("_root")


def op7_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near duplicates: of each component one row stays,
    that with the smallest id (then the smallest hash of the row); columns as in
    ``docs``.  Among rows equal in all columns one stays.  Components are told
    apart by their fingerprints, so null and repeated ids join nothing."""
    h = free_name(docs, "_rowhash")
    found = components_of(docs, id_col, text_col, extra=[row_hash(docs).alias("_h")])
    # rows equal in all columns are counted first, then the least of each component
    rows = found.groupBy("_root", F.col(id_col).alias("_i"), "_h").agg(F.count(F.lit(1)).alias("_n"))
    best = materialize(rows.groupBy("_root").agg(
        F.min(F.struct(F.col("_i").isNull().alias("_null"), "_i", "_h", "_n")).alias("b"))
        .select("b._i", "b._h", "b._n"), "keep-one")
    hashed = docs.withColumn(h, row_hash(docs))

    def pick(some):
        same = (hashed[h] == some["_h"]) & hashed[id_col].eqNullSafe(some["_i"])
        return hashed.join(some, same, "left_semi").drop(h)

    once, again = pick(best.where("_n = 1")), best.where("_n > 1")
    return once if again.isEmpty() else once.unionByName(pick(again).distinct())
