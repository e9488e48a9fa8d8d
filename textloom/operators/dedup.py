"""Near-duplicate documents: shingles, MinHash, banded LSH, exact Jaccard, flags, id maps and reports.

Documents with equal shingle sets are one class and are paired by their smallest id, so that a large group of copies
costs one row; pairs between all members are an expansion that is asked for. Candidate pairs are joined on 8-byte
hashes; texts are attached last.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textloom.functions import text as T
from textloom.sources.shared import BROADCAST_IDS, python_batches, semi, snapshot

PRIME = (1 << 31) - 1
SEED = 1


def portable_hash(s: Column) -> Column:
    """The first 60 bits of a string's md5 as a long: slower than xxhash64(), but every SQL engine has it."""
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str = "text", size: int = 5, exclude_empty: bool = False, hashing: str = "xxhash64") -> DataFrame:
    """(id, h sorted distinct shingle hashes, n). Texts without tokens share the one empty shingle unless excluded.

    hashing: "xxhash64", by which stored indexes are kept; "portable", portable_hash() of tokens joined by spaces, so that
    other engines find equal values; "words", the fastest. The last two are computed by functions.kernels."""
    if hashing == "xxhash64":
        return _native_sets(docs, id_col, text_col, size, exclude_empty)
    if hashing not in ("portable", "words"):
        raise ValueError(f"unknown hashing: {hashing}")
    portable = hashing == "portable"
    python_batches(docs.sparkSession)
    rows = docs.where(F.col(text_col) != "").select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        from textloom.functions import kernels

        empty = None if exclude_empty else np.array([kernels.EMPTY_MD5 if portable else 0], np.int64)
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, j in kernels.pieces(texts):
                own = [empty if h is None else h for h in kernels.shingle_sets(texts[i:j], size, portable)]
                keep = [k for k, h in enumerate(own) if h is not None]
                if keep:
                    own = [own[k] for k in keep]
                    ids = b.column("id").slice(i, j - i).take(pa.array(keep)).cast(kind)
                    n = np.array([len(h) for h in own], np.int32)
                    h = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate(own)))
                    yield pa.RecordBatch.from_arrays([ids, h, pa.array(n)], ["id", "h", "n"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, h array<long>, n int")


def _native_sets(docs: DataFrame, id_col: str, text_col: str, size: int, exclude_empty: bool) -> DataFrame:
    tokens = docs.where(F.col(text_col) != "").select(F.col(id_col).alias("id"), T.tokenize(T.canonicalize(text_col)).alias("tk"))
    if exclude_empty:
        tokens = tokens.where(F.size("tk") > 0)

    def hashes(tk: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(tk) - size), lambda i: F.xxhash64(F.slice(tk, i + 1, size)))
        return F.when(F.size(tk) < size, F.array(F.xxhash64(tk))).otherwise(runs)

    # never null, or joins would infer a null check on it and compute the hashes again below every filter
    h = F.coalesce(F.sort_array(F.array_distinct(T.let(F.col("tk"), hashes))), F.array().cast("array<long>"))
    return tokens.select("id", h.alias("h")).withColumn("n", F.size("h"))


def class_keys(sets: DataFrame) -> DataFrame:
    """(id, n, k1, k2): two hashes of each set, which are equal for equal sets. Takes sets or rows that have the keys."""
    if "k1" in sets.columns:
        return sets.select("id", "n", "k1", "k2")
    return sets.select("id", "n", F.xxhash64("h").alias("k1"), F.hash("h", "n").alias("k2"))


def classes(sets: DataFrame) -> DataFrame:
    """(id, h, n, members) of distinct sets: the smallest id stands for its class; members counts it too."""
    keyed = sets.withColumns({"k1": F.xxhash64("h"), "k2": F.hash("h", "n")})
    return keyed.groupBy("k1", "k2", "n").agg(F.min("id").alias("id"), F.first("h").alias("h"), F.count("*").alias("members"))


def membership(sets: DataFrame) -> DataFrame:
    """(id, rep): each document and its class's smallest id. Counted with partial sums, joined on the set's hashes.
    Takes sets or class_keys()."""
    keyed = class_keys(sets)
    return keyed.join(keyed.groupBy("k1", "k2", "n").agg(F.min("id").alias("rep")), ["k1", "k2", "n"]).select("id", "rep")


#: Set members that one side of a cell of verify() holds, about.
CELL = 1_000_000


def verify(pairs: DataFrame, sets: DataFrame | Callable[[DataFrame, int], DataFrame], threshold: float, members: float = 600) -> DataFrame:
    """Of pairs (a < b), those of Jaccard similarity of threshold or more, with the similarity.

    sets: (id, h), or a function from the wanted ids and their number to their sets, which then are made for these alone.
    members: the mean size of a set. Ids are dealt into blocks by their least neighbour, a large neighbourhood into
    several; the pairs of two blocks meet in one task with the sets they need. So a set travels about once, however many
    pairs it has, and a task's memory is bounded."""
    spark = pairs.sparkSession
    python_batches(spark)
    pairs = snapshot(pairs.select("a", "b"), "pairs")
    both = F.explode(F.array(F.struct(F.col("a").alias("id"), "a"), F.struct(F.col("b").alias("id"), "a"))).alias("x")
    ids = snapshot(pairs.select(both).groupBy("x.id").agg(F.min("x.a").alias("lead")), "ids")
    n, most = ids.count(), max(1, int(CELL / max(1.0, members)))
    parts = ids.groupBy("lead").agg(F.ceil(F.count("*") / most).alias("parts"))
    block = F.pmod(F.xxhash64("lead", F.pmod(F.xxhash64("id"), F.col("parts"))), F.lit(max(8, math.ceil(n / most))))
    blocks = ids.join(parts, "lead").select("id", block.alias("block"))
    at_a, at_b = blocks.withColumnsRenamed({"id": "a", "block": "i"}), blocks.withColumnsRenamed({"id": "b", "block": "j"})
    dealt = snapshot(pairs.join(at_a, "a").join(at_b, "b").select("a", "b", (F.col("i") * 2**31 + F.col("j")).alias("cell")), "cells")
    found = (sets(ids.select("id"), n) if callable(sets) else semi(sets, ids.select("id"), "id", n)).select("id", "h")
    need = snapshot(dealt.select(F.col("cell").alias("at"), F.explode(F.array("a", "b")).alias("id")).distinct(), "need")
    need = found.join(F.broadcast(need) if need.count() <= BROADCAST_IDS else need, "id").select("at", "id", "h")

    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, h = right.column("id").combine_chunks(), right.column("h").combine_chunks()
        a, b = (pc.index_in(left.column(c).combine_chunks(), value_set=ids).to_numpy() for c in ("a", "b"))
        off = h.offsets.to_numpy().astype(np.int64)
        names, local = np.unique(h.values.to_numpy(), return_inverse=True)
        length = np.diff(off)
        order = np.argsort(a, kind="stable")
        cuts = np.flatnonzero(np.diff(a[order])) + 1
        common, mark = np.zeros(len(a), np.int64), np.zeros(len(names), bool)
        for rows in np.split(order, cuts):
            mine = local[off[a[rows[0]]] : off[a[rows[0]] + 1]]
            mark[mine] = True
            i = 0
            while i < len(rows):  # so many others at once as hold CELL members
                total = np.cumsum(length[b[rows[i:]]])
                j = i + max(1, int(np.searchsorted(total, CELL, "right")))
                other, begin = b[rows[i:j]], np.concatenate([[0], total[: j - i - 1]])
                at = np.arange(total[j - i - 1]) + np.repeat(off[other] - begin, length[other])
                common[rows[i:j]] = np.add.reduceat(mark[local[at]], begin, dtype=np.int64)
                i = j
            mark[mine] = False
        sim = common / (length[a] + length[b] - common)
        keep = pa.array(sim >= threshold)
        return pa.table([left.column("a"), left.column("b"), pa.array(sim)], ["a", "b", "similarity"]).filter(keep)

    kind = pairs.schema["a"].dataType.simpleString()
    return dealt.groupBy("cell").cogroup(need.groupBy("at")).applyInArrow(of, f"a {kind}, b {kind}, similarity double")


#: frequent() is meant to see one in SHARE documents, and SAMPLE of them at least; it names FREQUENT hashes at most.
SHARE, SAMPLE, FREQUENT = 16, 2_000, 2_000_000


def frequent(sample: DataFrame) -> np.ndarray:
    """Shingle hashes that three or more sets of a sample hold, rarest first. They only set an order, so neither the
    sample nor the bound costs a pair; a sample of a fixed share keeps candidates a key bounded as tables grow."""
    rows = sample.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 2")
    return rows.orderBy(F.desc("n"), "h").limit(FREQUENT).select("h").toArrow().column("h").to_numpy()[::-1].copy()


#: Members of both prefixes that a pair has to share. A passage that two texts have in common seldom gives so many.
MEET = 6


def _prefixes(sets: DataFrame, threshold: float, common: np.ndarray) -> DataFrame:
    """(key, c, np): the first n - ceil(t n) + MEET members of each set with its hash, and its size and the place in one long.
    A set that a task meets again gives nothing."""
    rank = np.array(common, np.int64)
    place = np.argsort(rank)
    known = rank[place]

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            keys, owner, packed = [], [], []
            off, h = b.column("h").offsets.to_numpy(), b.column("h").values.to_numpy()
            for c, i, j in zip(b.column("c").to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                if c in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(c)
                x, n = h[i:j], j - i
                k = min(n, n - math.ceil(n * threshold - 1e-9) + MEET)
                if len(known):  # rare members by hash, then frequent ones, rarest first
                    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
                    hot = known[at] == x
                    x = np.concatenate([x[~hot], rank[np.sort(place[at[hot]])]])
                keys.append(x[:k])
                owner.append(np.full(k, c, np.int64))
                packed.append((n << 32) + np.arange(k, dtype=np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, owner, packed)], ["key", "c", "np"])

    return sets.select("h", F.xxhash64("h").alias("c")).mapInArrow(run, "key long, c long, np long")


def _meeting(threshold: float):
    """Over rows sorted by (key, c): (c, d, k, m) of the sets that share k keys and have to share m. Keys count that leave
    room for an overlap of threshold by the sizes and the key's places; the first MEET members that two near sets share
    do, and stand in both prefixes."""
    share = threshold / (1 + threshold)

    def pairs_of(key, c, packed):
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (c[1:] != c[:-1])
        key, c, packed = key[fresh], c[fresh], packed[fresh]
        n, left = packed >> 32, (packed >> 32) - (packed & 0xFFFFFFFF)
        i, d, found, held = np.arange(len(key)), 1, [], 0
        while True:
            i = i[i + d < len(key)]
            i = i[key[i] == key[i + d]]
            if not len(i):
                break
            j = i + d
            o = np.ceil(share * (n[i] + n[j]) - 1e-9).astype(np.int64)
            ok = (np.minimum(left[i], left[j]) >= o - MEET + 1) & (np.minimum(n[i], n[j]) >= o)
            found.append(np.stack([c[i[ok]], c[j[ok]], np.minimum(o[ok], MEET)], 1))
            held += int(ok.sum())
            if held > 200_000:
                yield np.concatenate(found)
                found, held = [], 0
            d += 1
        if found:
            yield np.concatenate(found)

    def counted(x):
        x, k = np.unique(x, axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([*(pa.array(x[:, i].copy()) for i in (0, 1)), pa.array(k.astype(np.int64)), pa.array(x[:, 2].copy())], ["c", "d", "k", "m"])

    def run(batches):
        rest = None
        for b in batches:
            now = [b.column(x).to_numpy() for x in ("key", "c", "np")]
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            rest = [x[cut:] for x in now]
            for x in pairs_of(*(y[:cut] for y in now)):
                yield counted(x)
        if rest is not None:
            for x in pairs_of(*rest):
                yield counted(x)

    return run


def exact_pairs(sets: DataFrame, threshold: float = 0.8, keys: DataFrame | None = None, common: np.ndarray = (), of: Callable | None = None) -> DataFrame:
    """All pairs (a < b, similarity) of class representatives, by prefix filtering on one order of hashes: two sets of
    Jaccard t share k of their n - ceil(t n) + k first members, or all of an overlap below k.

    keys: class_keys() of the sets, if they are a table already. common: frequent() members, which come last in the order,
    so that what stands in many texts makes no candidates. of: as in verify(), makes the sets of given ids."""
    spark = sets.sparkSession
    python_batches(spark)
    keys = snapshot(class_keys(sets), "keys") if keys is None else keys
    rows = _prefixes(sets, threshold, common).repartition("key").sortWithinPartitions("key", "c")
    met = rows.mapInArrow(_meeting(threshold), "c long, d long, k long, m long").groupBy("c", "d").agg(F.sum("k").alias("k"), F.max("m").alias("m")).where("k >= m").select("c", "d")
    reps = keys.groupBy("k1", "k2", "n").agg(F.min("id").alias("id"))
    near = met.join(reps.select(F.col("k1").alias("c"), F.col("id").alias("x")), "c").join(reps.select(F.col("k1").alias("d"), F.col("id").alias("y")), "d")
    mean = keys.agg(F.avg("n").alias("n")).first().n or 1
    return verify(near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), of or sets, threshold, mean)


@cache
def coefficients(n: int, seed: int = SEED) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n)]


def signature(h: Column, n: int, seed: int = SEED) -> Column:
    """n MinHash values of an array of hashes, by built-in functions only."""
    ab = coefficients(n, seed)
    small = F.transform(h, lambda x: F.pmod(x, F.lit(PRIME)))
    pairs = F.array(*(F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in ab))
    return F.transform(pairs, lambda p: F.array_min(F.transform(small, lambda x: F.pmod(p["a"] * x + p["b"], F.lit(PRIME)))))


def signature_udf(n: int, seed: int = SEED):
    """The same values as signature(), by numpy over Arrow batches: several times faster."""
    ab = coefficients(n, seed)

    @F.arrow_udf("array<long>")
    def of(h: pa.Array) -> pa.Array:
        from textloom.functions import kernels

        off = h.offsets.to_numpy().astype(np.int64)
        out = kernels.signatures(np.mod(h.values.to_numpy(), PRIME).astype(np.uint64), off, ab, PRIME)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1) * n, pa.int32()), pa.array(out.ravel()))

    return of


@cache
def lsh_params(threshold: float, num_perm: int = 128) -> tuple[int, int]:
    """(bands, rows) that minimise the mean of false-positive and false-negative areas of the candidate curve."""

    def area(f, lo, hi, steps=1000):
        w = (hi - lo) / steps
        return w * sum(f(lo + (i + 0.5) * w) for i in range(steps))

    best = (math.inf, 1, 1)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = area(lambda s: 1 - (1 - s**r) ** b, 0.0, threshold, 100)
            fn = area(lambda s: (1 - s**r) ** b, threshold, 1.0, 100)
            best = min(best, (0.5 * fp + 0.5 * fn, b, r))
    return best[1], best[2]


def bucket_hashes(sig: Column, bands: int, rows: int) -> Column:
    """A portable hash of each band of a signature."""
    return F.array(*(portable_hash(F.array_join(F.slice(sig, k * rows + 1, rows).cast("array<string>"), ",")) for k in range(bands)))


def bucket_table(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """(band, bucket, id): the LSH index as a table; written with partitionBy or bucketBy it serves later probes."""
    return signatures.select("id", F.posexplode(bucket_hashes(F.col("sig"), bands, rows)).alias("band", "bucket")).select("band", "bucket", "id")


def lsh_candidates(buckets: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) that share a bucket. buckets is read twice and had better be a table."""
    x, y = buckets.withColumnRenamed("id", "a"), buckets.withColumnRenamed("id", "b")
    return x.join(y, ["band", "bucket"]).where("a < b").select("a", "b").distinct()


def bucketed(sets: DataFrame, threshold: float = 0.8, num_perm: int = 128, native: bool = False) -> DataFrame:
    """(id, n, k1, k2, buckets): the class keys and bucket hashes of each set, a hundred bytes a document."""
    b, r = lsh_params(threshold, num_perm)
    python_batches(sets.sparkSession)
    sig = signature(F.col("h"), b * r) if native else signature_udf(b * r)(F.col("h"))
    rows = sets.select("id", "n", F.xxhash64("h").alias("k1"), F.hash("h", "n").alias("k2"), sig.alias("sig"))
    return rows.select("id", "n", "k1", "k2", bucket_hashes(F.col("sig"), b, r).alias("buckets"))


def bucketed_texts(docs: DataFrame, id_col: str, text_col: str = "text", size: int = 5, threshold: float = 0.8, num_perm: int = 128) -> DataFrame:
    """bucketed() of shingle_sets(hashing="portable") with other class keys, made in the task that reads a text: of a set
    only its size, its digest and its signature leave it."""
    b, r = lsh_params(threshold, num_perm)
    python_batches(docs.sparkSession)
    rows = docs.where(F.col(text_col) != "").select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, ab = to_arrow_type(rows.schema["id"].dataType), coefficients(b * r)

    def run(batches):
        from textloom.functions import kernels

        empty = np.array([kernels.EMPTY_MD5], np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in kernels.pieces(texts):
                own = [empty if h is None else h for h in kernels.shingle_sets(texts[i:j], size, portable=True)]
                n = np.array([len(h) for h in own], np.int32)
                keys = np.frombuffer(b"".join(hashlib.blake2b(h.tobytes(), digest_size=12).digest() for h in own), [("k1", "<i8"), ("k2", "<i4")])
                sig = kernels.signatures(np.mod(np.concatenate(own), PRIME).astype(np.uint64), np.concatenate([[0], np.cumsum(n, dtype=np.int64)]), ab, PRIME)
                sig = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * len(ab), pa.int32()), pa.array(sig.ravel()))
                ids = batch.column("id").slice(i, j - i).cast(kind)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), *(pa.array(keys[k].copy()) for k in ("k1", "k2")), sig], ["id", "n", "k1", "k2", "sig"])

    signed = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n int, k1 long, k2 int, sig array<long>")
    return signed.select("id", "n", "k1", "k2", bucket_hashes(F.col("sig"), b, r).alias("buckets"))


def minhash_index(sets: DataFrame, threshold: float = 0.8, num_perm: int = 128, native: bool = False) -> DataFrame:
    """The bucket table of the classes of sets. Takes sets or bucketed()."""
    rows = sets if "buckets" in sets.columns else bucketed(sets, threshold, num_perm, native)
    reps = rows.groupBy("k1", "k2", "n").agg(F.min("id").alias("id"), F.first("buckets").alias("buckets"))
    return reps.select("id", F.posexplode("buckets").alias("band", "bucket")).select("band", "bucket", "id")


def minhash_pairs(sets: DataFrame, threshold: float = 0.8, num_perm: int = 128, native: bool = False) -> DataFrame:
    """Verified pairs (a < b, similarity) of class representatives among LSH candidates."""
    return verify(lsh_candidates(snapshot(minhash_index(sets, threshold, num_perm, native), "buckets")), sets, threshold)


def expand(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of representatives -> (id, dup_id, similarity) of all documents, both directions, without self-pairs.

    The result is as large as the groups are dense; prefer near_duplicate_flags and membership where they suffice."""
    m = membership(sets)
    own = m.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(1.0).alias("similarity"))
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).union(own)
    rows = both.join(m.select(F.col("rep").alias("a"), "id"), "a").join(m.select(F.col("rep").alias("b"), F.col("id").alias("dup_id")), "b")
    return rows.where("id <> dup_id").select("id", "dup_id", "similarity")


def duplicate_details(expanded: DataFrame, docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, id_text, dup_id, dup_text, similarity): texts are joined to the verified pairs only."""
    t = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("id_text"))
    out = expanded.join(t, "id").join(t.withColumnsRenamed({"id": "dup_id", "id_text": "dup_text"}), "dup_id")
    return out.select("id", "id_text", "dup_id", "dup_text", "similarity")


def duplicate_map(expanded: DataFrame) -> DataFrame:
    """(id, dup_ids sorted distinct)."""
    return expanded.groupBy("id").agg(F.array_sort(F.collect_set("dup_id")).alias("dup_ids"))


def near_duplicate_flags(docs: DataFrame, id_col: str, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, has_duplicate) of every document, without expanding groups into pairs."""
    m = membership(sets)
    linked = pairs.select(F.explode(F.array("a", "b")).alias("rep")).union(m.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep")).distinct()
    flagged = m.join(linked, "rep", "left_semi").select(F.col("id").alias(id_col), F.lit(True).alias("f"))
    return docs.select(id_col).join(flagged, id_col, "left").select(id_col, F.coalesce("f", F.lit(False)).alias("has_duplicate"))


def annotate(docs: DataFrame, id_col: str, flags: DataFrame) -> DataFrame:
    """docs with duplicate.minhash.has_duplicate set; other fields of an existing duplicate struct stay."""
    found = docs.join(flags, id_col, "left").withColumn("has_duplicate", F.coalesce("has_duplicate", F.lit(False)))
    flag = F.struct(F.col("has_duplicate").alias("has_duplicate"))
    if "duplicate" in docs.columns:
        out = F.coalesce(F.col("duplicate"), F.lit(None).cast(docs.schema["duplicate"].dataType)).withField("minhash", flag)
    else:
        out = F.struct(flag.alias("minhash"))
    return found.withColumn("duplicate", out).drop("has_duplicate")


def dedup_report(sets: DataFrame, candidates: DataFrame | None, pairs: DataFrame, threshold: float, num_perm: int, size: int) -> DataFrame:
    """One row: total_docs, candidate_docs, verified_docs, verified_pairs of documents, and the parameters.

    Counts of documents follow the classes: every member of a linked class counts, copies of one set count as candidates
    and as verified."""
    m = membership(sets).groupBy("rep").agg(F.count("*").alias("n"))

    def docs_in(p: DataFrame) -> DataFrame:
        reps = p.select(F.explode(F.array("a", "b")).alias("rep")).union(m.where("n > 1").select("rep")).distinct()
        return m.join(reps, "rep", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("k"))

    na, nb = m.withColumnsRenamed({"rep": "a", "n": "na"}), m.withColumnsRenamed({"rep": "b", "n": "nb"})
    across = pairs.join(na, "a").join(nb, "b").agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).alias("across"))
    within = m.agg(F.sum("n").alias("total_docs"), F.sum((F.col("n") * (F.col("n") - 1) / 2).cast("long")).alias("within"))
    rows = within.crossJoin(across).crossJoin(docs_in(pairs).withColumnRenamed("k", "verified_docs")).crossJoin(docs_in(pairs if candidates is None else candidates).withColumnRenamed("k", "candidate_docs"))  # one row each
    return rows.select(F.coalesce("total_docs", F.lit(0)).alias("total_docs"), "candidate_docs", "verified_docs", (F.coalesce("within", F.lit(0)) + F.col("across")).alias("verified_pairs"), F.lit(threshold).alias("similarity_threshold"), F.lit(num_perm).alias("num_permutations"), F.lit(size).alias("shingle_size"))
