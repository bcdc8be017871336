"""Documents drawn towards a target: gains of hashed word runs as an array, and the k highest scores by distributed quickselect.

A feature is a word or two words in a row; its bucket is the CRC-32 of its bytes. How much commoner a bucket is in the target than
in the corpus is its gain; a document's weight is the mean gain of its features, and its score is the weight and noise from a hash of
its id, so that the highest scores are a sample by weight without replacement. The k-th highest score is found by random
pivots: each round counts, over all rows that are left, what lies above, at and below each pivot, and goes on between two of them. Only
the rows above it are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.scratch import materialise, ship

#: Buckets; words a document must have to be drawn; share that is drawn, in percent; seed of the noise; pivots of a round.
BUCKETS, LEAST_WORDS, PERCENT, SEED, PIVOTS = 10_000, 20, 25, 7, 15
#: Bytes of a word that are hashed side by side with those of other words; longer words one by one.
_LONG = 64
_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, (_TABLE >> np.uint32(1)) ^ np.uint32(0xEDB88320), _TABLE >> np.uint32(1))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of data[start:end] for each pair, each going on from the checksum before."""
    out = np.zeros(len(starts), np.uint32) if before is None else before.astype(np.uint32)
    size = ends - starts
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(out[i]))
    left = np.flatnonzero((size > 0) & (size <= _LONG))
    left = left[np.argsort(size[left].astype(np.uint8), kind="stable")[::-1]]
    state, at, size = ~out[left], starts[left], size[left]
    for i in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -i))  # words of more than i bytes
        state[:n] = _TABLE[(state[:n] ^ data[at[:n] + i]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[left] = ~state
    return out


def buckets(texts: pa.Array, n_buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (first, end, row, bucket, n_words): features of texts[first:end]; row counts from first."""
    data = _LOWER[words.buffers(texts)[0]]
    space = np.array([32], np.uint8)
    for first, end, _, counts, starts, ends in words.word_spans(texts, words.PUNCT):
        row = np.repeat(np.arange(end - first), counts)
        one = _crc(data, starts, ends)
        zero = np.zeros(max(len(one) - 1, 0), np.int64)
        two = _crc(data, starts[1:], ends[1:], _crc(space, zero, zero + 1, one[:-1])) if len(one) > 1 else one[:0]
        pair = row[1:] == row[:-1]
        key = np.concatenate((one, two[pair])) % np.uint32(n_buckets)
        yield first, end, np.concatenate((row, row[1:][pair])), key.astype(np.int64), counts


def _count(n_buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for _, _, _, key, _ in buckets(batch.column(0), n_buckets):
                total += np.bincount(key, minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return count


def bucket_counts(texts: DataFrame, text_col: str = "text", n_buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket: n_buckets numbers, whatever the number of texts."""
    ship(texts.sparkSession)
    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(_count(n_buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_buckets, np.int64)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the target's share over the corpus's), each count one higher."""
    s, t, of_s, of_t = corpus.astype(float), target.astype(float), float(corpus.sum()), float(target.sum())
    ratio = ((t + 1) * (of_s + len(s))) / ((s + 1) * (of_t + len(t)))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _weigh(gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = ([np.zeros(0, np.int64)] for _ in range(3))
            for first, end, row, key, counts in buckets(batch.column(1), len(gain)):
                n = np.bincount(row, minlength=end - first)
                total = np.zeros(end - first, np.int64)
                np.add.at(total, row, gain[key])
                n_words.append(counts)
                n_features.append(n)
                weight.append(np.where(n > 0, total // np.maximum(n, 1), 0))
            columns = [np.concatenate(x).astype(np.int64) for x in (n_words, n_features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_words", "n_features", "weight"])

    return weigh


def scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", n_buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_features, weight, score. A null id counts as the empty text in the noise."""
    gain = gains(bucket_counts(docs, text_col, n_buckets), bucket_counts(target, target_text_col, n_buckets))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    weighed = rows.mapInArrow(_weigh(gain), "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


#: The order of the draw: the highest score, then the least id (null last), then what tells rows of one id apart.
_ORDER = [("score", True), ("doc_id", False), ("n_features", True), ("n_words", True)]


def _sorted() -> list[Column]:
    return [F.col(c).desc_nulls_last() if high else F.col(c).asc_nulls_last() for c, high in _ORDER]


def _ahead(key: dict) -> Column:
    """The row comes before key in the draw."""
    out, same = F.lit(False), F.lit(True)
    for c, high in _ORDER:
        mine, v = F.col(c), F.lit(key[c]).cast("bigint")
        first = (mine > v) if high else (mine < v)
        if key[c] is None:
            first = mine.isNotNull()
        out, same = out | (same & F.coalesce(first, F.lit(False))), same & mine.eqNullSafe(v)
    return out


def _same(key: dict) -> Column:
    out = F.lit(True)
    for c, _ in _ORDER:
        out = out & F.col(c).eqNullSafe(F.lit(key[c]).cast("bigint"))
    return out


def kth(rows: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> dict | None:
    """The k-th row (from 1) in the order of the draw, by quickselect; None if there are fewer rows or k is 0.

    A round picks some keys by hash from the rows that are left, counts all of these rows ahead of and at each of them in
    one pass, and leaves those between the two keys that the k-th lies between. The driver holds the pivots only.
    """
    columns = [c for c, _ in _ORDER]
    left, ahead, turn = rows.select(*columns), 0, 0
    place = lambda key: tuple((key[c] is None, (-key[c] if high else key[c]) if key[c] is not None else 0) for c, high in _ORDER)
    while k > 0:
        picked = left.orderBy(F.xxhash64(F.lit(seed + turn), *columns)).limit(pivots).collect()
        keys = sorted({r: r.asDict() for r in picked}.values(), key=place)
        sums = [F.sum(which(key).cast("bigint")) for key in keys for which in (_ahead, _same)]
        n, *counts = left.agg(F.count(F.lit(1)), *[x.alias(f"c{i}") for i, x in enumerate(sums)]).first()
        if ahead + n < k:
            return None
        low, top, before = None, None, ahead
        for key, above, at in zip(keys, counts[::2], counts[1::2], strict=True):
            if before + above < k <= before + above + at:
                return key
            if before + above + at < k:
                low, ahead = key, before + above + at
            elif top is None:
                top = key
        if low is not None:
            left = left.where(~_ahead(low) & ~_same(low))
        if top is not None:
            left = left.where(_ahead(top))
        turn += 1
    return None


def ranked(winners: DataFrame) -> DataFrame:
    """winners with rank, from 1 in the order of the draw: sorted by ranges, places within ranges, sums of the ranges before."""
    n = int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = winners.repartitionByRange(n, *_sorted()).sortWithinPartitions(*_sorted())
    placed = materialise(placed.withColumn("place", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # one row for each range
    return placed.withColumn("part", part).join(before, "part").withColumn("rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("part", "before", "place")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, **names) -> DataFrame:
    """One row per row of docs: doc_id, n_features, weight, score, rank (null: not drawn).

    Null and empty texts have no features: weight 0; they have too few words to be drawn. Ties of score go to the smaller
    doc_id, null last; rows that repeat an id to the one of more features; rows alike in all of these stand in for
    one another. Empty docs give no rows; an empty target has equal shares in all buckets. Texts are read whole, a very long one in
    one task; other columns are not read.
    """
    rows = materialise(scores(docs, target, **names), "scores")
    able = rows.where(F.col("n_words") >= least_words)
    n = able.count()
    k = percent * n // 100
    last = kth(able, k)
    names_out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*names_out, F.lit(None).cast("bigint").alias("rank"))
    won = ranked(able.where(_ahead(last) | _same(last)))
    drawn = F.when(F.col("rank") <= k, F.col("rank"))  # of rows alike in all columns only some may be drawn
    lost = rows.where((F.col("n_words") < least_words) | (~_ahead(last) & ~_same(last)))
    return won.select(*names_out, drawn.alias("rank")).unionByName(lost.select(*names_out, F.lit(None).cast("bigint").alias("rank")))


ORACLE = """
WITH tab AS (
  SELECT list(list_reduce(range(0, 8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t FROM range(0, 256) r(b)
), words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), goal AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), runs AS (
  SELECT doc_id, unnest(ws || list_transform(range(1, CAST(len(ws) AS BIGINT)), lambda i: ws[i] || ' ' || ws[i + 1])) AS f FROM words
), aims AS (
  SELECT unnest(ws || list_transform(range(1, CAST(len(ws) AS BIGINT)), lambda i: ws[i] || ' ' || ws[i + 1])) AS f FROM goal
), hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_transform(range(1, CAST(octet_length(encode(f)) AS BIGINT) + 1), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT f FROM runs UNION SELECT f FROM aims), tab
), s AS (SELECT bucket, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aims JOIN hashed USING (f) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t),
gain AS (
  SELECT s.bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (sums.s + 10000)) / ((s.n + 1)::DOUBLE * (sums.t + 10000)))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (bucket), sums
), w AS (
  SELECT doc_id, CAST(floor(sum(g) / count(*)::DOUBLE) AS BIGINT) AS weight FROM runs JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY doc_id
), d AS (
  SELECT doc_id, CAST(CASE WHEN len(ws) > 0 THEN 2 * len(ws) - 1 ELSE 0 END AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, len(ws) >= 20 AS able,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN w USING (doc_id)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS n FROM d
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank FROM r
"""
