"""MinHash near-duplicates with sequential Bayesian verification.

1. Sets: a text's distinct word shingles as 64-bit hashes, its signature (the
   smallest value of each of ``rows * bands`` permutations, 16 bits kept) and a
   128-bit digest of the set, in one Arrow-batched pass. Equal sets are one
   class from here on, whatever the number of copies.
2. Banding: classes that share a band of ``rows`` values are candidates. At
   the link threshold of 0.8 the production bands (48 of 6) miss a pair with
   probability 5e-7.
3. Sequential verification: the signatures of a candidate pair are compared
   batch by batch. After each batch a pair goes if the posterior probability
   that its similarity reaches the threshold (uniform prior, so a binomial
   tail) is below ``miss``.
4. Survivors are confirmed on their full sets.
5. Links are closed to connected components, distributed.

Pairs within a bucket are never all listed. Two rounds link each member to
one pivot of its bucket (first the smallest class, then one drawn by hash),
which turns a crowd of near copies into one component with a row for each
member. What is still mixed after that - buckets whose members are in several
components - is compared exhaustively, but in blocks of bounded size inside
the tasks, where only pairs of different components are looked at and only
the links of a spanning forest are returned. So no link between components
is lost, and rows grow with the members, not with their square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from .components import components, dropped, saved

SHINGLE = 2
PERCENT = 80
ROWS = 6
BANDS = 48
#: Chosen probability of pruning a pair that reaches the threshold.
MISS = 1e-6
#: Signature values compared at a time.
BATCH = 32
#: Members, and bytes of sets, of one block of an exhaustively compared bucket.
BLOCK = 1024
BLOCK_BYTES = 64 << 20
#: Rows up to which a table that is small by nature is broadcast.
BROADCAST_ROWS = 1_000_000
#: Pairs of one class beyond which its join is spread over several tasks.
HOT = 20_000

_SKETCH = StructType([StructField("n", LongType()), StructField("digest", BinaryType()), StructField("sig", BinaryType())])
_EDGE = StructType([StructField("u", LongType()), StructField("v", LongType())])


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of one text as sorted 64-bit hashes.

    A-Z are lower-cased; words are runs of other than ASCII white space. Fewer
    words than a shingle: the whole sequence is one; no words (or null): none.
    """
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(shingle, len(words))
    acc = np.full(len(h) - k + 1, k, dtype=np.uint64)  # the length keeps short sequences apart
    for j in range(k):
        acc ^= h[j:len(h) - k + 1 + j]
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(31)
    return np.unique(acc)


@lru_cache(maxsize=4)
def _permutations(size: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(size))
    a = r.integers(0, 1 << 32, size, dtype=np.uint32) | np.uint32(1)
    return a[:, None], r.integers(0, 1 << 32, size, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray, size: int = ROWS * BANDS) -> np.ndarray:
    """The low 16 bits of the smallest value under each permutation."""
    a, b = _permutations(size)
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 2048):
        np.minimum(low, (a * x[None, k:k + 2048] + b).min(axis=1), out=low)
    return low.astype("<u2")


def min_matches(size: int, percent: int = PERCENT, miss: float = MISS, batch: int = BATCH) -> list[tuple[int, int]]:
    """``(values compared, fewest matches to go on)`` after each batch.

    With a uniform prior, similarity given m matches of n is Beta(m + 1,
    n - m + 1), so P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in [*range(batch, size, batch), size]:
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the signature rows ``a`` and ``b`` that pass every batch, and their matches."""
    at = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int32)
    start = 0
    for end, least in bounds:
        matches += (a[at, start:end] == b[at, start:end]).sum(axis=1, dtype=np.int32)
        on = matches >= least
        at, matches, start = at[on], matches[on], end
    return at, matches


def is_link(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * |x & y| >= percent * |x | y| for sorted distinct hashes."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # two sorted runs: one merge
    return (100 + percent) * int((both[1:] == both[:-1]).sum()) >= percent * len(both)


def _sketch(text: Column, shingle: int, size: int) -> Column:
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            rows = []
            for t in s:
                x = shingle_set(t, shingle)
                rows.append((len(x), blake2b(x.tobytes(), digest_size=16).digest(), signature(x, size).tobytes()) if len(x)
                            else (0, None, None))
            yield pd.DataFrame(rows, columns=["n", "digest", "sig"])
    return F.pandas_udf(run, _SKETCH)(text)


def _set_with_digest(text: Column, shingle: int) -> Column:
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            sets = [shingle_set(t, shingle).tobytes() for t in s]
            yield pd.DataFrame({"digest": [blake2b(x, digest_size=16).digest() for x in sets], "set": sets})
    return F.pandas_udf(run, StructType([StructField("digest", BinaryType()), StructField("set", BinaryType())]))(text)


def _passes(a: Column, b: Column, bounds: list[tuple[int, int]]) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        out = np.zeros(len(x), dtype=bool)
        size = bounds[-1][0]
        rows = lambda s: np.frombuffer(b"".join(s), dtype="<u2").reshape(-1, size)
        out[survivors(rows(x), rows(y), bounds)[0]] = True
        return pd.Series(out)
    return F.pandas_udf(run, BooleanType())(a, b)


def _confirmed(a: Column, b: Column, percent: int) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        of = lambda v: np.frombuffer(v, dtype=np.uint64)
        return pd.Series([is_link(of(p), of(q), percent) for p, q in zip(x, y)], dtype=bool)
    return F.pandas_udf(run, BooleanType())(a, b)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _attach(pairs: DataFrame, side: str, other: str, rows: DataFrame) -> DataFrame:
    """``pairs`` joined with the columns of ``rows(side, ...)``.

    A class with more than ``HOT`` pairs is split by a salt from the other
    side, with its row repeated for each salt. Only these classes are listed
    for that, at most one for ``HOT`` pairs.
    """
    heat = pairs.groupBy(side).agg(F.ceil(F.count("*") / F.lit(HOT)).cast("int").alias("__parts")).where("__parts > 1")
    n = heat.count()
    if not n or n > BROADCAST_ROWS:
        return pairs.join(rows, side)
    heat = F.broadcast(heat)
    salted = (pairs.join(heat, side, "left")
              .withColumn("__salt", F.pmod(F.xxhash64(other), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts"))
    spread = (rows.join(heat, side, "left")
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts"))
    return salted.join(spread, [side, "__salt"]).drop("__salt")


def _verified(spark: SparkSession, pairs: DataFrame, active: DataFrame, bounds: list, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` that are links, as a saved table."""
    pairs = saved(spark, pairs, "pairs")
    sized = _attach(_attach(pairs, "u", "v", active.select(F.col("uid").alias("u"), F.col("n").alias("nu"), F.col("sig").alias("su"))),
                    "v", "u", active.select(F.col("uid").alias("v"), F.col("n").alias("nv"), F.col("sig").alias("sv")))
    fits = F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent
    near = saved(spark, sized.where(fits).where(_passes(F.col("su"), F.col("sv"), bounds)).select("u", "v"), "survivors")
    sets = _attach(_attach(near, "u", "v", active.select(F.col("uid").alias("u"), F.col("set").alias("x"))),
                   "v", "u", active.select(F.col("uid").alias("v"), F.col("set").alias("y")))
    edges = saved(spark, sets.where(_confirmed(F.col("x"), F.col("y"), percent)).select("u", "v"), "links")
    dropped(spark, pairs, near)
    return edges


def _labelled(members: DataFrame, comp: DataFrame | None) -> DataFrame:
    """``members`` with their component (``root``)."""
    if comp is None:
        return members.withColumn("root", F.col("uid"))
    return (members.join(comp.withColumnRenamed("node", "uid"), "uid", "left")
            .select("key", "uid", F.coalesce("component", "uid").alias("root")))


def _mixed(spark: SparkSession, members: DataFrame, comp: DataFrame | None) -> tuple[DataFrame, int]:
    """Members, with root, of the buckets that span several components, and their number.

    Of buckets with the very same members one is kept (equal counts and two
    equal 64-bit sums over the members).
    """
    marked = _labelled(members, comp)
    mark = [F.count("*"), F.bit_xor(F.xxhash64("uid")), F.bit_xor(F.xxhash64(F.lit(1), "uid"))]
    keys = (marked.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), *[m.alias(f"m{i}") for i, m in enumerate(mark)])
            .where("lo <> hi").groupBy("m0", "m1", "m2").agg(F.min("key").alias("key")).select("key"))
    out = saved(spark, marked.join(keys, "key", "left_semi"), "mixed")
    return out, out.count()


def _forest(bounds: list[tuple[int, int]], percent: int):
    """Spanning links between the components of one block pair of a bucket."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uid", ignore_index=True)
        uid, root = part["uid"].to_numpy(), part["root"].to_numpy()
        left, right = part["left"].to_numpy(), part["right"].to_numpy()
        sig = np.frombuffer(b"".join(part["sig"]), dtype="<u2").reshape(len(part), -1)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in part["set"]]
        size = part["n"].to_numpy()
        parent = {r: r for r in root}

        def find(r):
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        found = []
        for i in range(len(part)):
            ok = (root != root[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
            ok[:i + 1] = False
            ok &= (left[i] & right) | (right[i] & left)
            js = np.nonzero(ok)[0]
            if not len(js):
                continue
            at, matches = survivors(sig[js], np.broadcast_to(sig[i], (len(js), sig.shape[1])), bounds)
            found += [(-int(m), i, int(js[k])) for k, m in zip(at, matches)]
        out = []
        for _, i, j in sorted(found):  # the most alike first: most others are then joined already
            a, b = find(root[i]), find(root[j])
            if a != b and is_link(sets[i], sets[j], percent):
                parent[a] = b
                out.append((uid[i], uid[j]))
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")
    return run


def _blockwise(spark: SparkSession, mixed: DataFrame, active: DataFrame, bounds: list, percent: int, block: int) -> DataFrame:
    """Links between the components of mixed buckets, as a saved table."""
    rows = mixed.join(active, "uid")
    size = mixed.join(active.select("uid", "n"), "uid").groupBy("key").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(block)), F.ceil(F.sum("n") * 8 / F.lit(BLOCK_BYTES))).cast("int").alias("blocks"))
    # A member goes to the pairs (i, j), i <= j, of its own block with every block.
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    dealt = (rows.join(size, "key").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "uid", "root", "n", "sig", "set",
                     (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right")))
    return saved(spark, dealt.groupBy("key", "i", "j").applyInPandas(_forest(bounds, percent), _EDGE).distinct(), "links")


def minhash_near_duplicates(spark: SparkSession, df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS,
                            miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``df``.

    Rows are linked if ``100 * |intersection| >= percent * |union|`` of their
    shingle sets; ``component_id`` is the smallest id reachable, itself
    included; ``kept`` says whether the row's id is that id.

    Shingles are compared as 64-bit hashes, equal sets by a 128-bit digest.
    Candidates come from the bands and pass the sequential test, so a link is
    missed with the small probability that these parameters set.

    Defined results: null, empty and wordless texts have no shingles and are
    linked with nothing, each a component of its own; repeated rows and
    repeated ids each give a row; a null id gives a row with a null id and is
    passed over when the smallest id is sought (null, and kept, if the
    component has no other); an empty input gives an empty result; very long
    texts are hashed whole, in blocks; other columns are not read.
    """
    size = rows * bands
    bounds = min_matches(size, percent, miss)
    text = F.col(f"`{text_col}`")
    marked = saved(spark, df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), _sketch(text, shingle, size).alias("s"))
                   .select("id", "th", "s.*"), "sketches")
    classes = saved(spark, marked.where("n > 0").groupBy("digest").agg(F.min("id").alias("low"), F.min("th").alias("th"),
                                                                       F.first("n").alias("n"), F.first("sig").alias("sig"))
                    .withColumn("uid", F.monotonically_increasing_id()), "classes")

    key = lambda k: F.xxhash64(F.lit(k), F.substring("sig", 1 + 2 * rows * k, 2 * rows))
    filed = classes.select("uid", F.explode(F.array(*[key(k) for k in range(bands)])).alias("key"))
    shared = saved(spark, filed.groupBy("key").agg(F.min("uid").alias("first"), F.count("*").alias("c")).where("c > 1").select("key", "first"), "shared")
    members = saved(spark, filed.join(_small(shared, shared.count()), "key").select("key", "uid", "first"), "members")

    needed = saved(spark, classes.join(members.select("uid").distinct(), "uid", "left_semi").select("uid", "th", "digest", "n", "sig"), "needed")
    hashes = needed.select("th").distinct()
    # Of a class's texts the one with the smallest hash stands for it, once.
    held = (df.select(text.alias("t")).withColumn("th", F.xxhash64("t")).join(_small(hashes, needed.count()), "th", "left_semi")
            .select(_set_with_digest(F.col("t"), shingle).alias("s")).groupBy("s.digest").agg(F.first("s.set").alias("set")))
    active = saved(spark, needed.join(held, "digest").select("uid", "n", "sig", "set"), "active")

    # First round: the smallest class of each bucket.
    pairs = members.where("uid <> first").select(F.col("uid").alias("u"), F.col("first").alias("v")).distinct()
    edges = [_verified(spark, pairs, active, bounds, percent)]
    comp = components(spark, edges[0])
    # Second round: a member drawn by hash, for buckets that are still mixed.
    mixed, n = _mixed(spark, members.select("key", "uid"), comp)
    if n:
        draw = F.struct(F.xxhash64("key", "uid").alias("h"), F.col("uid"), F.col("root"))
        pivots = mixed.groupBy("key").agg(F.min(draw).alias("p")).select("key", F.col("p.uid").alias("v"), F.col("p.root").alias("rv"))
        pairs = mixed.join(pivots, "key").where("root <> rv").select(F.greatest("uid", "v").alias("u"), F.least("uid", "v").alias("v")).distinct()
        edges.append(_verified(spark, pairs, active, bounds, percent))
        dropped(spark, mixed)
        comp = components(spark, edges[0].unionByName(edges[1]))
        mixed, n = _mixed(spark, members.select("key", "uid"), comp)
        if n:  # the rest exhaustively, block by block
            edges.append(_blockwise(spark, mixed, active, bounds, percent, block))
            comp = components(spark, edges[0].unionByName(edges[1]).unionByName(edges[2]))
    dropped(spark, mixed, shared, members, needed, active, *edges)

    rooted = classes.select("uid", "low").join(comp.withColumnRenamed("node", "uid"), "uid", "left")
    low = rooted.groupBy(F.coalesce("component", "uid").alias("root")).agg(F.min("low").alias("component_id"))
    roots = (classes.select("uid", "digest").join(comp.withColumnRenamed("node", "uid"), "uid", "left")
             .select("digest", F.coalesce("component", "uid").alias("root")).join(low, "root").select("digest", "component_id"))
    some = marked.where("n > 0").join(roots, "digest").select("id", "n", "component_id")
    none = marked.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.unionByName(none).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
