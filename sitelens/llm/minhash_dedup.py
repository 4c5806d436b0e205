"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle digests gives two signature values, its
minimum and its maximum, so half as many permutations are evaluated as values
are kept. Three permutations (six values) make a band, and there are so many
bands that two sets at the threshold share none with a chance below 1e-8 (39
bands at 0.85, 61 at 0.8). Whatever shares one is compared on the full sets.

Documents with equal sets form one class first. Of the classes that share a
bucket, each counts the shingles that another one has too. These numbers bound
every similarity: what a and b share is at most the smaller number c, and
their union is at least n_a + n_b - c. Edits that only one document has thus
keep it out of the pairs, however many copies its bucket holds, and no link is
lost.

Within a bucket nothing is paired with everything: first every member meets
the bucket's pivot, its most typical text, which links most of a group of
copies; afterwards only members that are still in different components meet,
the largest component of a bucket never being paired with itself, and only if
their sketches (four bits of every minimum and maximum) agree as far as those
of two sets at the threshold do but for a chance below 1e-8. The result is
that of comparing all pairs that share a band.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import attach_groups, binary_list, materialize, numbered, parts_for, prepare, release_shuffles, select_ids
from sitelens.llm.components import components
from sitelens.llm.meeting import HASH_BITS, shared_hashes
from sitelens.llm.shingles import Hasher, mix, overlap

PER_BAND = 3             # permutations of a band, two values each
MISS = 1e-8              # chance that a pair at the threshold shares no band
SIGNATURE = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"
LINKS = "src long, dst long"
_RNG = np.random.default_rng(8_128)
_DRAWN = _RNG.integers(0, 2 ** 32, (2, 4096), dtype=np.uint32)
_STEP = 1024             # shingles hashed at a time
REST_LOAD = 32           # pairs to look at per member for which no more pivots are tried
# Radix digits in which shared shingles are counted: each gets up to about
# DIGIT_VALUES of them, which a task sorts in some 300 MB.
MIN_DIGITS, DIGIT_VALUES = 12, 4_000_000
BAND_ROWS = 200_000      # bucket rows per partition
_FOLD = np.uint64(0xC2B2AE3D27D4EB4F)


def bands_for(percent: int) -> int:
    """Bands needed so that MISS holds at a threshold of percent / 100. An
    error if the permutations drawn don't suffice for that (below 49)."""
    agree, most = (percent / 100) ** (2 * PER_BAND), _DRAWN.shape[1] // PER_BAND
    if percent >= 100:
        return 1
    bands = max(1, math.ceil(math.log(MISS) / math.log1p(-agree))) if agree > 0 else math.inf
    if bands > most:
        raise ValueError(f"a threshold of {percent} % needs {bands} bands for a miss chance of {MISS}; there are {most}")
    return bands


def least_agreement(percent: int, bands: int) -> int:
    """How many of the sketch's four-bit values two sets at the threshold
    share at least, but for a chance of MISS. They share a value if
    minimum or maximum agree, or else by chance once in 16."""
    n, p = 2 * PER_BAND * bands, percent / 100 + (1 - percent / 100) / 16
    if p >= 1:
        return n
    tail = 0.0
    for k in range(n + 1):
        tail += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
        if tail > MISS:
            return k
    return n


def band_keys(shingles: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit bucket keys of a document, one per band, and its sketch:
    four bits of every minimum and maximum, sixteen in a 64-bit word."""
    a, b = _DRAWN[0, :bands * PER_BAND, None] | np.uint32(1), _DRAWN[1, :bands * PER_BAND, None]
    low = np.full(len(a), 0xFFFFFFFF, np.uint32)
    high = np.zeros(len(a), np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), _STEP):
        h = a * x[at:at + _STEP] + b
        np.minimum(low, h.min(axis=1), out=low)
        np.maximum(high, h.max(axis=1), out=high)
    value = ((low.astype(np.uint64) << np.uint64(32)) | high).reshape(bands, PER_BAND)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(PER_BAND):
        key = mix(key * _FOLD + value[:, i])
    bits = np.concatenate((low, high)) * np.uint32(0x9E3779B1) >> np.uint32(28)
    bits = np.pad(bits, (0, -len(bits) % 16)).astype(np.uint64).reshape(-1, 16)
    sketch = (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)
    return key.view(np.int64), sketch.view(np.int64)


def signatures(docs: DataFrame, bands: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest of the whole set, bands and sketch (these
    null if empty)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sets = [hasher.shingles(t) for t in binary_list(batch.column(1))]
            keys = [band_keys(s, bands) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([k for k, _ in keys], pa.list_(pa.int64())), pa.array([k for _, k in keys], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "bands", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SIGNATURE)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int, block: int = 1000) -> DataFrame:
    """Those (src, dst) whose full sets reach ``percent`` / 100.

    The partners of a src are dealt out in blocks of about ``block``; a block
    gets the src's text once, then streams its partners. So a hub's text
    isn't repeated for each of them, and no task holds more than two sets."""
    counts = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("_n"))
    dealt = pairs.join(counts, "src").select(
        "src", "dst", F.expr(f"pmod(xxhash64(dst), ceil(_n / {block}))").cast("int").alias("part"))
    dealt = materialize(dealt, "pairs-dealt")
    partners = dealt.join(texts, dealt["dst"] == texts["doc_id"]).select("src", "part", F.lit(1).alias("role"), "dst", "text")
    heads = dealt.select("src", "part").distinct()
    heads = heads.join(texts, heads["src"] == texts["doc_id"]).select("src", "part", F.lit(0).alias("role"), F.col("src").alias("dst"), "text")
    rows = heads.unionByName(partners).repartition("src", "part").sortWithinPartitions("src", "part", "role")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, at, sets = Hasher(), None, []
        for batch in batches:
            found = []
            for src, part, role, dst, text in zip(*(batch.column(i).to_pylist() for i in range(4)), binary_list(batch.column(4))):
                shingles = hasher.shingles(text)
                if (src, part) != at:
                    at, sets = (src, part), []
                if role == 0:       # an id may stand for several rows
                    sets.append(shingles)
                elif any(_similar(s, shingles, percent) for s in sets):
                    found.append((src, dst))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["src", "dst"])

    return rows.mapInArrow(run, LINKS)


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = overlap(a, b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per input row.

    Whole texts; null and empty texts, or texts of blanks only, have no
    shingles, link with nothing and are kept. Rows with a null id take no part
    in links; their component is null and they are kept. Rows that repeat id
    and text share their component, and so do rows that repeat an id as far
    as their texts link. An empty table gives no rows. ``rounds`` bounds the
    pivot rounds that come before the rest of the pairs, never the pairs; they
    also end once they link little."""
    spark = docs.sparkSession
    prepare(spark)
    sig = materialize(signatures(docs, bands_for(percent), id_col, text_col), "minhash-signatures")
    sets = sig.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = materialize(sets.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"),
                                                     F.count(F.lit(1)).alias("size")), "minhash-classes")
    buckets = _shared_buckets(sets, classes, bands_for(percent))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    candidates = materialize(buckets.select("id").distinct(), "minhash-found")
    texts = materialize(select_ids(texts, candidates, "left_semi"), "minhash-texts")
    release_shuffles(spark)
    members = _linkable(buckets, texts, percent)
    checked = spark.createDataFrame([], "lo long, hi long")
    links, labels = [], None

    def look_at(pairs: DataFrame) -> float:
        """Confirm pairs not looked at before; the share that links."""
        nonlocal checked
        pairs = pairs.withColumns({"lo": F.least("src", "dst"), "hi": F.greatest("src", "dst")})
        pairs = materialize(pairs.join(checked, ["lo", "hi"], "left_anti"), "minhash-pairs")
        n_pairs = pairs.count()
        if not n_pairs:
            return 0.0
        checked = checked.unionByName(pairs.select("lo", "hi"))
        found = materialize(confirm(pairs.select("src", "dst"), texts, percent), "minhash-links")
        links.append(found)
        return found.count() / n_pairs

    for turn in range(rounds):
        open_members = _unresolved(members, labels)
        n, load = open_members.agg(F.count(F.lit(1)), F.sum(F.expr("IF(comp <> big, total, 0L)"))).first()
        if not n:
            break
        helped = (turn == 0 or load > REST_LOAD * n) and look_at(_pivot_pairs(open_members, percent, turn)) >= 0.1
        if not helped or turn == rounds - 1:
            look_at(_rest_pairs(open_members, _marks(sets, classes, candidates), percent))
            break
        labels = components(functools.reduce(DataFrame.unionByName, links))
        members = open_members.select("key", "band", "id", "n", "c")     # the other buckets are settled
    if links:
        labels = components(functools.reduce(DataFrame.unionByName, links))
    if labels is not None:
        classes = (classes.join(labels, classes["rep"] == labels["node"], "left")
                   .select("digest", "size", F.coalesce("comp", "rep").alias("component_id")))
        classes = materialize(classes, "minhash-components")
    else:
        classes = classes.select("digest", "size", F.col("rep").alias("component_id"))
    rows = sets.select("doc_id", "n_shingles", "digest")
    out = attach_groups(rows, classes, "digest", "size", rows.count()).select("doc_id", "n_shingles", "component_id")
    alone = (sig.filter("doc_id IS NULL OR digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _shared_buckets(sets: DataFrame, classes: DataFrame, bands: int) -> DataFrame:
    """(key, band, id, n): the classes of every bucket that holds more than one."""
    parts = parts_for(sets.sparkSession, classes.count() * bands, BAND_ROWS)
    reps = classes.select("digest", "rep", "n")
    rows = (sets.join(reps, (sets["digest"] == reps["digest"]) & (sets["doc_id"] == reps["rep"]))
             .select(reps["rep"].alias("id"), reps["n"], F.posexplode("bands").alias("band", "key")).repartition(parts, "key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).filter("_lo <> _hi").select("key")
    return materialize(rows.join(shared.hint("shuffle_hash"), "key", "left_semi").distinct(), "minhash-buckets")


def _shingle_hashes():
    """What a task needs to hash the shingles of a text."""
    hasher = Hasher()
    return lambda data: np.unique(hasher.shingles(data) >> np.uint64(64 - HASH_BITS))


def _linkable(buckets: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(key, band, id, n, c): the members that can link at all, with the number c of
    their shingles that another member has, in the buckets that still hold
    more than one. An id that stands for several texts counts as typical."""
    values = buckets.select("id", "n").distinct().agg(F.sum("n")).first()[0] or 0
    digits = max(MIN_DIGITS, math.ceil(values / DIGIT_VALUES))
    once = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"))
    counts = (shared_hashes(texts.select(F.col("doc_id").alias("node"), "text"), _shingle_hashes, digits, count=True)
              .groupBy("node").agg(F.sum("n").alias("c")))
    numbers = materialize(once.join(counts, once["doc_id"] == counts["node"], "left")
                          .select("doc_id", "k", F.coalesce("c", F.lit(0)).alias("c")), "minhash-shared")
    members = (buckets.join(numbers, buckets["id"] == numbers["doc_id"])
               .select("key", "band", "id", "n", F.when(F.col("k") > 1, F.col("n")).otherwise(F.least("c", "n")).alias("c"))
               .filter(100 * F.col("c") >= percent * F.col("n")))
    shared = members.groupBy("key").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi")).filter("_lo <> _hi").select("key")
    return materialize(members.join(shared, "key", "left_semi"), "minhash-members")


def _unresolved(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets with more than one component, with the bucket's
    largest component and its size."""
    if labels is None:
        named = members.withColumn("comp", F.col("id"))
    else:
        named = members.join(labels, members["id"] == labels["node"], "left").select("key", "band", "id", "n", "c", F.coalesce("comp", "id").alias("comp"))
    per = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    whole = per.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("m"), F.count(F.lit(1)).alias("k"), F.sum("m").alias("total"))
    whole = whole.filter("k > 1").select("key", F.col("m.comp").alias("big"), "total")
    return materialize(named.join(whole, "key"), "minhash-open")


def _can_link(percent: int) -> F.Column:
    """The bound on two members' similarity from their numbers alone."""
    both = F.least("c", "_c", "n", "_n")
    return 100 * both >= percent * (F.col("n") + F.col("_n") - both)


def _pivot_pairs(open_members: DataFrame, percent: int, turn: int) -> DataFrame:
    """Every member with its bucket's pivot: the member with the fewest
    shingles of its own, by a hash among equals and in later turns."""
    own = F.when(F.lit(turn) == 0, F.col("n") - F.col("c")).otherwise(0)
    first = F.min(F.struct(own.alias("own"), F.xxhash64("id", F.lit(turn)).alias("h"), "id", "n", "c", "comp")).alias("p")
    pivots = open_members.groupBy("key").agg(first).select(
        "key", F.col("p.id").alias("src"), F.col("p.n").alias("_n"), F.col("p.c").alias("_c"), F.col("p.comp").alias("_comp"))
    return (open_members.join(pivots, "key").filter((F.col("comp") != F.col("_comp")) & _can_link(percent))
            .select("src", F.col("id").alias("dst")).distinct())


def _marks(sets: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, marks, sketch) of the classes among ``ids``: 32 bits of every band's key, and
    the sketch; null for an id that stands for several sets."""
    reps = classes.select("digest", F.col("rep").alias("id"))
    sets = select_ids(sets, ids, "left_semi")
    found = (sets.join(reps, (sets["digest"] == reps["digest"]) & (sets["doc_id"] == reps["id"]))
             .select("id", reps["digest"], F.transform("bands", lambda k: F.shiftright(k, 32).cast("int")).alias("marks"), "sketch"))
    one = F.min("digest") == F.max("digest")
    return found.groupBy("id").agg(*[F.when(one, F.first(c)).alias(c) for c in ("marks", "sketch")])


def _agreement(a: str, b: str) -> F.Column:
    """How many of the four-bit values of two sketches agree."""
    def equal(x: F.Column, y: F.Column) -> F.Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.lit(16) - F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    return F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda n, k: n + k)


def _rest_pairs(open_members: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket that lie in different components: its members
    outside the largest component with everything else. A pair meets in every
    bucket it shares and is told in the first of them, if the sketches agree
    as far as they must. Ids that stand for several texts are always told."""
    bands = bands_for(percent)
    pad = -2 * PER_BAND * bands % 16
    every = materialize(open_members.join(marks, "id"), "minhash-rest")
    few = every.filter("comp <> big").select("key", F.col("id").alias("src"), *[F.col(c).alias("_" + c) for c in ("n", "c", "comp", "marks", "sketch")])
    first = F.array_position(F.zip_with("marks", "_marks", lambda x, y: x == y), True) == F.col("band") + 1
    alike = _agreement("sketch", "_sketch") - pad >= least_agreement(percent, bands)
    pairs = few.join(every, "key").filter(
        (F.col("comp") != F.col("_comp")) & ((F.col("comp") == F.col("big")) | (F.col("src") < F.col("id"))) & _can_link(percent)
        & F.coalesce(first, F.lit(True)) & F.coalesce(alike, F.lit(True)))
    return pairs.select("src", F.col("id").alias("dst")).distinct()


def drop_near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """All columns of the rows that stay: of linked rows the one with the
    smallest doc_id (null last; of equal ids any one).

    Rows are linked by their own texts, whatever their ids: a row doesn't go
    for a namesake, and of equal texts under null or repeated ids one stays.
    Null, empty and blank texts link with nothing and stay. An empty table
    gives no rows. The texts move at most once, to meet the rows to drop."""
    names = docs.columns
    rows, key = numbered(docs, "minhash-rows")
    linked = near_duplicates(rows, percent, id_col=key).select(F.col("doc_id").alias("_key"), "component_id")
    ids = rows.select(F.col(key).alias("_key"), F.col("doc_id").alias("_id"))
    linked = materialize(linked.join(ids, "_key"), "minhash-linked")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_key")).alias("best")
    stay = linked.groupBy("component_id").agg(first).select(F.col("best._key").alias("_key"))
    gone = materialize(linked.join(stay, "_key", "left_anti").select("_key"), "minhash-gone")
    return select_ids(rows, gone, "left_anti", key).select(*names)
