"""Phrase collocations by Toivonen's sampling method, per language.

A sample of the documents proposes phrases: those of up to three words that
occur in it often enough, found level by level. One pass over all documents
then counts, exactly, the proposed phrases and their negative border: every
contiguous phrase whose first and last words-but-one are both proposed (all
words, for single ones). If a border phrase is frequent after all, the
proposal was too small: such phrases join it, and a further pass counts the
border that grew from them, until no new border phrase is frequent. Then no
frequent phrase can have been missed, whatever the sample.

Passes count 64-bit digests of (language, phrase), so nothing but numbers is
shuffled; a last pass finds the texts of the frequent ones, and a second digest
tells whether two of them met in one (then they are counted by their texts).
Proposed phrases are held as a hashed bitmap of bounded size. A false member
only makes more phrases be counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitelens.llm.common import binary_list, materialize, prepare, text_list
from sitelens.llm.shingles import mix
from sitelens.llm.wordids import Tokens, byte_set, gather

MAX_WORDS = 4
SAMPLE = 8               # one document of so many, by a hash of its id
SAMPLE_COUNT = 2         # occurrences in the sample that propose a phrase
# Bits of a bitmap per member. Two of them are asked, so of other phrases one in
# 250 passes as proposed, one in 250,000 as failed and one in 1,000 to be told.
PROPOSED_BITS, FAILED_BITS, TOLD_BITS = 32, 1024, 64
LARGEST = 28             # at most 2 ** 28 bits (32 MB); a fuller bitmap lets more pass
TOLD = 1 << 21           # digests that a worker remembers to have told the text of
# Characters that end a piece, and blanks between words.
BREAKS = (*b".,;:!?", *range(0x0A, 0x0E))
BLANKS = (0x20, 0x09)
_IN_WORD = ~byte_set(*BREAKS, *BLANKS)
_BREAK = byte_set(*BREAKS)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Bitmap:
    """A set of digests, each as two of 2 ** ``power`` bits: by its highest bits
    and by those from the eighth on."""

    def __init__(self, power: int, data: np.ndarray):
        self.power, self.data = power, data

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def has(self, digest: np.ndarray) -> np.ndarray:
        out = self._bit(digest >> np.uint64(64 - self.power))
        maybe = np.flatnonzero(out)
        out[maybe] = self._bit((digest[maybe] >> np.uint64(8)) & np.uint64((1 << self.power) - 1))
        return out


def bitmap(digests: DataFrame, bits: int) -> Bitmap:
    """The bitmap of a written table of digests ``d``. Spark sets the bits, 4 KB at
    a time, and the driver lays the pieces side by side: at most 32 MB."""
    power = int(np.clip(np.ceil(np.log2(max(1, digests.count()) * bits)), 18, LARGEST))
    low = F.shiftrightunsigned("d", 8).bitwiseAND(F.lit((1 << power) - 1).cast("long"))
    at = digests.select(F.explode(F.array(F.shiftrightunsigned("d", 64 - power), low)).alias("at")).select((F.col("at") + 1).alias("at"))
    pieces = at.groupBy(F.bitmap_bucket_number("at").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    data = np.zeros(1 << (power - 3), np.uint8)
    for r in pieces.collect():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        data[(r["piece"] - 1) * 4096:][:len(part)] = part
    return Bitmap(power, data)


# What this Python worker has told in the latest pass: (the pass, sorted digests).
_TOLD: list = ["", np.zeros(0, np.uint64)]


def _start_telling(mark: str) -> None:
    if _TOLD[0] != mark:
        _TOLD[:] = [mark, np.zeros(0, np.uint64)]


def _untold(both: np.ndarray) -> np.ndarray:
    """Which of the sorted ``both`` haven't been told; they count as told then."""
    told = _TOLD[1]
    at = np.searchsorted(told, both)
    new = np.ones(len(both), bool)
    inside = at < len(told)
    new[inside] = told[at[inside]] != both[inside]
    _TOLD[1] = np.sort(np.concatenate([told, both[new]]), kind="stable") if len(told) < TOLD else both
    return new


class _Batch:
    """The words of some texts and the digests of the phrases that start at them."""

    def __init__(self, texts: list[bytes], langs: list[str], bits: int):
        self.names, kind = np.unique(np.array(langs, object), return_inverse=True)
        self.seeds = np.array([xxhash.xxh3_64_intdigest(s) for s in self.names], np.uint64)
        self.tokens = Tokens(texts, _IN_WORD, lower=True)
        self.kind = kind[self.tokens.row]
        self.piece = np.cumsum(_BREAK[self.tokens.bytes], dtype=np.int32)[self.tokens.lo]
        self.word, self.second = self.tokens.digests()
        self.mask = np.uint64((1 << 64) - (1 << 64 - bits))
        self.first = mix(self.word ^ mix(self.seeds)[self.kind]) & self.mask

    def fits(self, k: int) -> np.ndarray:
        """Where phrases of k words lie in one piece."""
        return self.piece[k - 1:] == self.piece[:len(self.piece) - k + 1]

    def longer(self, digest: np.ndarray, k: int) -> np.ndarray:
        """The digests of phrases of k words from those of k - 1."""
        return mix(digest[:-1] * _STEP + self.word[k - 1:]) & self.mask

    def seconds(self, at: np.ndarray, k: int) -> np.ndarray:
        """The second digests of the phrases of k words that start at ``at``."""
        out = self.second[at]
        for i in range(1, k):
            out = mix(out * _STEP + self.second[at + i])
        return out

    def text(self, at: np.ndarray, k: int) -> list[str]:
        t = self.tokens
        return [b" ".join(t.data[lo:hi] for lo, hi in zip(t.lo[i:i + k], t.hi[i:i + k])).decode("utf-8") for i in at.tolist()]


def _border(batch: _Batch, levels: range, proposed: Bitmap | None) -> Iterator[np.ndarray]:
    """The digests of the phrases of ``levels`` words whose shorter parts are both proposed."""
    digest, able = batch.first, np.ones(batch.tokens.n, bool)
    for k in range(1, levels.stop):
        if k > 1:
            member = able & proposed.has(digest)
            able = member[1:] & member[:-1] & batch.fits(k)
            digest = batch.longer(digest, k)
        if k in levels:
            yield digest[able]


def _around(batch: _Batch, failed: Bitmap) -> Iterator[np.ndarray]:
    """The digests of all phrases that contain a failed one."""
    digest, holds = batch.first, np.zeros(batch.tokens.n + 1, bool)
    for k in range(1, MAX_WORDS + 1):
        fits = batch.fits(k)
        digest = batch.longer(digest, k) if k > 1 else digest
        holds = fits & (holds[:-1] | holds[1:] | failed.has(digest))
        yield digest[holds]


def _counted(docs: DataFrame, bits: int, phrases, *shared) -> DataFrame:
    """(d, n): how often ``phrases(batch, *shared)`` yields a digest over all of ``docs``
    (lang, text). Tasks add up a few megabytes of text at a time, Spark the
    rest, map-side first."""
    sent = docs.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gather(batches, 1):
            batch = _Batch(binary_list(rows.column(1)), text_list(rows.column(0)), bits)
            out = [np.unique(d, return_counts=True) for d in phrases(batch, *sent.value)]
            d, n = (np.concatenate([np.zeros(0, t), *c]) for t, c in zip((np.uint64, np.int64), zip(*out)))
            yield pa.RecordBatch.from_arrays([pa.array(d.view(np.int64)), pa.array(n.astype(np.int64))], ["d", "n"])

    return docs.mapInArrow(run, "d long, n long").groupBy("d").agg(F.sum("n").alias("n"))


def _told(docs: DataFrame, bits: int, members: Bitmap, recount: bool = False) -> DataFrame:
    """(d, d2, k, lang, phrase, n): the texts of the phrases in ``members``, and as
    k = 0 the languages with their words. A worker tells a phrase once, with n =
    0, or again after TOLD others, so a phrase told by a task that fails later
    may be missing; to ``recount``, all occurrences are told."""
    sent, mark = docs.sparkSession.sparkContext.broadcast(members), uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = sent.value
        _start_telling(mark)
        for rows in gather(batches, 1):
            batch = _Batch(binary_list(rows.column(1)), text_list(rows.column(0)), bits)
            words = np.bincount(batch.kind, minlength=len(batch.names))
            out = [(batch.seeds, batch.seeds, 0, batch.names, [""] * len(words), words)]
            digest = batch.first
            for k in range(1, MAX_WORDS + 1):
                digest = batch.longer(digest, k) if k > 1 else digest
                at = np.flatnonzero(batch.fits(k) & members.has(digest))
                second = batch.seconds(at, k)
                if recount:
                    _, of, n = np.unique(np.stack([digest[at], second], 1), axis=0, return_index=True, return_counts=True)
                else:
                    both, of = np.unique(mix(digest[at]) ^ second, return_index=True)
                    of = of[_untold(both)]
                    n = np.zeros(len(of), np.int64)
                at, second = at[of], second[of]
                out.append((digest[at], second, k, batch.names[batch.kind[at]], batch.text(at, k), n))
            d, d2 = (np.concatenate([o[i] for o in out]).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(d), pa.array(d2), pa.array(np.repeat([o[2] for o in out], [len(o[0]) for o in out]).astype(np.int32)),
                 pa.array(np.concatenate([o[3] for o in out]), pa.string()), pa.array([t for o in out for t in o[4]], pa.string()),
                 pa.array(np.concatenate([o[5] for o in out]).astype(np.int64))], ["d", "d2", "k", "lang", "phrase", "n"])

    found = docs.mapInArrow(run, "d long, d2 long, k int, lang string, phrase string, n long")
    return found.groupBy("d", "d2", "k", "lang", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, least: int = 30, sample: int = SAMPLE, sample_count: int = SAMPLE_COUNT,
                     bits: int = 64) -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to 4 words with n >= ``least``
    occurrences, and per language the number of all words as k = 0, whatever it is.

    ``docs`` has doc_id, lang, text. A null lang is ``und``, a null text is
    empty. The sample decides how much is counted and ``bits``
    how many phrases meet in a digest, never the result.

    One expansion closes: a frequent phrase that the first pass didn't count has
    a shortest such part, one of whose own parts is frequent, counted and not
    proposed. So it contains a failed phrase, and the expansion counts all of those."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text", "doc_id")
    part = materialize(rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(sample)) == 0).select("lang", "text"), "phrase-sample")
    rows = rows.select("lang", "text")
    proposed, members = None, None
    for k in range(1, MAX_WORDS):
        found = _counted(part, bits, _border, range(k, k + 1), members).filter(F.col("n") >= sample_count)
        found = materialize(found.select("d"), "phrases-proposed")
        proposed = found if proposed is None else proposed.unionByName(found)
        members = bitmap(proposed, PROPOSED_BITS)
    counts = materialize(_counted(rows, bits, _border, range(1, MAX_WORDS + 1), members).filter(F.col("n") >= least), "phrases-counted")
    failed = materialize(counts.join(proposed, "d", "left_anti").select("d"), "phrases-failed")
    if not failed.isEmpty():
        more = materialize(_counted(rows, bits, _around, bitmap(failed, FAILED_BITS)).filter(F.col("n") >= least), "phrases-counted")
        counts = materialize(counts.unionByName(more).distinct(), "phrases-counted")
    return _named(rows, bits, counts, least)


def _named(rows: DataFrame, bits: int, counts: DataFrame, least: int) -> DataFrame:
    """(lang, k, phrase, n) of the counted digests (d, n)."""
    told = materialize(_told(rows, bits, bitmap(counts, TOLD_BITS)), "phrases-told")
    totals = told.filter("k = 0").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    texts = materialize(told.filter("k > 0").groupBy("d").agg(F.count(F.lit(1)).alias("m")), "phrases-texts")
    # digests that several phrases share, or whose text was taken for one told before
    shared = materialize(counts.join(texts, "d", "left").filter("coalesce(m, 0) <> 1").select("d"), "phrases-shared")
    out = told.filter("k > 0").drop("n").join(counts, "d").join(shared, "d", "left_anti").select("lang", "k", "phrase", "n")
    if not shared.isEmpty():
        again = _told(rows, bits, bitmap(shared, TOLD_BITS), recount=True).filter("k > 0").join(shared, "d", "left_semi")
        out = out.unionByName(again.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
    return materialize(totals.unionByName(out), "phrases-frequent")


def _wide(name: str) -> F.Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, cover: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases
    of 2 to 4 words.

    Words are runs without blanks (0x20, 0x09) in the pieces between
    ``.,;:!?`` and 0x0A-0x0D, with A-Z lower-cased. A candidate occurs a >=
    ``least`` times; it is scored at its lowest-scoring cut (ties: the first),
    and dropped if a longer candidate that contains it occurs at least
    ``cover`` percent as often. Order: score, a, then phrase by its bytes.

    A null lang is ``und``; null, empty or blank texts have no words; repeated
    rows and ids count as they stand; a language without candidates and an
    empty table give no rows. Other columns are not read."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "lang", "text")
    counts = frequent_phrases(docs, least)
    totals = counts.filter("k = 0").select("lang", "n")
    known = counts.filter("k > 0").select("lang", "k", "phrase", F.col("n").alias("a"))
    cands = known.filter("k > 1").withColumn("ws", F.split("phrase", " "))

    def words(start, length) -> F.Column:
        return F.array_join(F.slice("ws", start, length), " ")

    cuts = cands.select("lang", "phrase", "a", "ws", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", words(F.lit(1), F.col("cut")).alias("_left"),
                       words(F.col("cut") + 1, F.size("ws") - F.col("cut")).alias("_right"))
    for side, name in (("_left", "l"), ("_right", "r")):
        part = known.select(F.col("lang"), F.col("phrase").alias(side), F.col("a").alias(name))
        cuts = cuts.join(part, ["lang", side])
    # 38 digits hold any product of counts
    cuts = cuts.withColumn("score", F.expr("CAST(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) AS DECIMAL(38,0)) "
                                           "div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    inner = cands.filter("k > 2").select("lang", "ws", "a", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("_m"))
    inner = inner.select("lang", "a", "ws", "_m", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("_m") + 1)).alias("_i"))
    inner = inner.groupBy("lang", words(F.col("_i"), F.col("_m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * _wide("longer") < cover * _wide("a")))
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # a language may hold most candidates: each share of them keeps its best first
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    kept = kept.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).filter(F.col("_r") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
