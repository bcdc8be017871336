"""Phrases that stand together more often than their parts: counts by multikey quicksort over suffixes of word sequences.

Every word begins a suffix of at most five words, which ends with its piece. Suffixes are routed by their leading words, so
that all suffixes with the same beginning meet in one task. There three-way partitioning by the word at one depth after the
other, down to the greatest depth, brings equal beginnings together: the weight of each equal partition is the count of a
phrase, and a partition of too few suffixes is left as it stands. A leading word that very many suffixes share is routed
by two words, a pair that very many share by three, and so on; the parts' counts are then added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.scratch import materialise, ship

#: Most words of a phrase; least occurrences; phrases reported for each language.
DEPTH, LEAST, TOP = 5, 100, 2000
#: Words that a task handles at once; bytes of text whose suffixes share a bucket; suffixes with one beginning that a bucket may hold.
BLOCK, BUCKET, ROUTED = 1 << 19, 4_000_000, 1 << 17
#: At most 2 ** HOT_BITS beginnings (and a third more) are routed by more words: the bound of what tasks are sent, 8 bytes each.
HOT_BITS = 17
#: Words that have a number in routed suffixes, the most frequent ones: the bound of what tasks are sent, 12 bytes each. Any other word goes by its hash.
NUMBERED, BY_HASH = (1 << 20) - 1, 1 << 20
_PIECE = np.zeros(256, bool)
_PIECE[[*b".,;:!?", *range(10, 14)]] = True
_GAP = _PIECE.copy()
_GAP[[9, 32]] = True
_SALTS = 16


class _Words:
    """Words of some texts: hash, does the word begin a piece, number of its language among langs."""

    def __init__(self, hashes: np.ndarray, begins: np.ndarray, lang: np.ndarray, langs: list[str], strings: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.hashes, self.begins, self.lang, self.langs, self._strings = hashes, begins, lang, langs, strings

    def __len__(self) -> int:
        return len(self.hashes)

    def text(self, at: np.ndarray) -> list[str]:
        """The words at these ascending places, A-Z lower-cased."""
        out, before = [], 0
        for data, starts, ends in self._strings:
            some = at[(at >= before) & (at < before + len(starts))] - before
            out += [data[a:b].tobytes().lower().decode() for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]
            before += len(starts)
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    """The task's words in blocks of whole texts; columns: lang, text."""
    codes: dict[str, int] = {}
    held: list[tuple] = []

    def block() -> _Words:
        parts = [np.concatenate(x) for x in list(zip(*held, strict=True))[:3]]
        return _Words(*parts, list(codes), [x[3] for x in held])

    n = 0
    for batch in batches:
        of_row = np.array([codes.setdefault(x, len(codes)) for x in batch.column(0).to_pylist()], np.int32)
        data = words.buffers(batch.column(1))[0]
        for first, end, h, counts, starts, ends in words.word_spans(batch.column(1), _GAP):
            if not len(h):
                continue
            begins = np.ones(len(h), bool)
            breaks = np.flatnonzero(_PIECE[data[starts[0] : ends[-1]]]) + starts[0]
            begins[1:] = np.searchsorted(breaks, starts[1:]) != np.searchsorted(breaks, ends[:-1])
            firsts = np.cumsum(counts) - counts
            begins[firsts[counts > 0]] = True
            held.append((np.maximum(h, np.uint64(1)), begins, np.repeat(of_row[first:end], counts), (data, starts, ends)))
            n += len(h)
            if n >= BLOCK:
                yield block()
                held, n = [], 0
    if held:
        yield block()


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.concatenate([h for _, _, h, _ in words.word_hashes(pa.array([f"#{x.encode().hex()}" for x in langs]), np.zeros(256, bool))])


def _suffixes(hashes: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """For 0 to DEPTH - 1 the word so many places on, for each place; 0 where it lies in another piece."""
    n = len(hashes)
    ends = np.append(np.flatnonzero(begins), n)
    left = ends[np.searchsorted(ends, np.arange(n), side="right")] - np.arange(n)
    out = []
    for d in range(DEPTH):
        word = np.zeros(n, np.uint64)
        word[: n - d] = hashes[d:]
        word[left <= d] = 0
        out.append(word)
    return out


def _beginnings(lang: np.ndarray, suffixes: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For depth 1 to DEPTH the hashes of language and first words of all suffixes."""
    total = lang.copy()
    for d, word in enumerate(suffixes):
        total += word * words._PLACES[d]
        yield words.mix(total)


def _count(often: float):
    """Tasks' rows: kind 0: a word's occurrences; kind d: a beginning of d words with over 1 / often of a block's suffixes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            suffixes = _suffixes(block.hashes, block.begins)
            beginnings = _beginnings(_lang_hashes(block.langs)[block.lang], suffixes[:-1])
            own, at, of, n = np.unique(next(beginnings), return_index=True, return_inverse=True, return_counts=True)
            order = np.argsort(at)
            langs, at = pa.array(block.langs), at[order]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(at), np.int32)), langs.take(pa.array(block.lang[at])), pa.array(block.text(at)), pa.array(block.hashes[at].view(np.int64)), pa.array(n[order])],
                names=["kind", "lang", "word", "key", "n"],
            )
            left = np.arange(len(block))
            for d in range(1, DEPTH):  # a frequent beginning begins with a frequent one
                if d > 1:
                    left = left[suffixes[d - 1][left] > 0]
                    own, of, n = np.unique(next(beginnings)[left], return_inverse=True, return_counts=True)
                heavy = n * often > len(block)
                none = pa.nulls(int(heavy.sum()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(none), d, np.int32)), none, none, pa.array(own[heavy].view(np.int64)), pa.array(n[heavy])], names=["kind", "lang", "word", "key", "n"])
                left = left[heavy[of]]

    return count


def _has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(keys), bool)
    return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys


def _packed(codes: np.ndarray, n: np.ndarray, depth: np.ndarray, hashes: np.ndarray) -> bytes:
    """Columns of bytes: of codes (uint32, the fourth byte is 0), of n (uint32), depth (uint8); hashes of the codes BY_HASH, row by row."""
    planes = [np.ascontiguousarray(x.astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :k].T.tobytes() for x, k in [*((c, 3) for c in codes.T), (n, 4)]]
    raw = b"".join([*planes, depth.tobytes(), hashes.astype("<u8").tobytes()])
    return len(codes).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows, size = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    raw = np.frombuffer(pa.decompress(data[16:], size, "zstd", asbytes=True), np.uint8)
    columns, at = [], 0
    for k in (*[3] * DEPTH, 4):
        wide = np.zeros((rows, 4), np.uint8)
        wide[:, :k] = raw[at : at + k * rows].reshape(k, rows).T
        columns.append(wide.view("<u4")[:, 0])
        at += k * rows
    return np.stack(columns[:-1], 1), columns[-1], raw[at : at + rows], np.frombuffer(raw[at + rows :].tobytes(), "<u8")


def _route(numbered: np.ndarray, number: np.ndarray, hot: list[np.ndarray], buckets: int):
    """numbered: sorted hashes of the words with a number, number: theirs, from 1; hot: for depth 1 to 4 the beginnings that are routed by one word more."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            suffixes = _suffixes(block.hashes, block.begins)
            at = np.flatnonzero(suffixes[1])  # words alone are counted already
            if not len(at):
                continue
            code = np.full(len(block), BY_HASH, np.uint32)
            if len(numbered):
                place = np.minimum(np.searchsorted(numbered, block.hashes), len(numbered) - 1)
                code = np.where(numbered[place] == block.hashes, number[place], np.uint32(BY_HASH))
            suffixes, lang = [x[at] for x in suffixes], block.lang[at]
            depth, whole, routed = np.ones(len(at), np.uint8), None, None
            for d, key in enumerate(_beginnings(_lang_hashes(block.langs)[lang], suffixes), 1):
                here = depth == d
                routed = key if d == 1 else np.where(here, key, routed)
                if d < DEPTH:
                    depth[here & _has(hot[d - 1], key)] += 1
                whole = key
            group = (routed % np.uint64(buckets)).astype(np.int64) * len(block.langs) + lang
            codes = np.stack([np.where(x > 0, code[np.minimum(at + d, len(code) - 1)], np.uint32(0)) for d, x in enumerate(suffixes)], 1)
            near = (codes[:, 0].astype(np.uint64) << np.uint64(43)) | (codes[:, 1].astype(np.uint64) << np.uint64(22)) | (whole >> np.uint64(42))
            order = np.lexsort((near, group))
            group, whole = group[order], whole[order]
            first = np.flatnonzero(np.append(True, (whole[1:] != whole[:-1]) | (group[1:] != group[:-1])))  # equal suffixes travel once
            n, order, group = np.diff(np.append(first, len(order))).astype("<u4"), order[first], group[first]
            codes, depth = codes[order], depth[order]
            by_hash = codes == BY_HASH
            hashes, upto = np.stack([x[order] for x in suffixes], 1)[by_hash], np.append(0, np.cumsum(by_hash.sum(1)))
            cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group)).tolist()
            rows: list[list] = [[], [], []]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows[0].append(int(group[a]) // len(block.langs))
                rows[1].append(block.langs[int(group[a]) % len(block.langs)])
                rows[2].append(_packed(codes[a:b], n[a:b], depth[a:b], hashes[upto[a] : upto[b]]))
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, (pa.int64(), pa.string(), pa.binary()), strict=True)], names=["bucket", "lang", "suffixes"])

    return route


def equal_partitions(ids: np.ndarray, weight: np.ndarray, partial: np.ndarray, least: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of pointers to the rows of ids (n, depth; 0 ends a row), all partitions of a round at once.

    partial: a row's beginnings of fewer than so many words are counted elsewhere too. Returns (row, depth, weight) of every
    equal partition that weighs at least least, or is partial: ids[row, :depth] has that weight here. Lighter
    partitions are abandoned.
    """
    rng = np.random.default_rng(seed)
    pointer, depth, start = np.arange(len(ids)), np.zeros(min(1, len(ids)), np.int64), np.zeros(min(1, len(ids)), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(pointer):
        size = np.diff(np.append(start, len(pointer)))
        part = np.repeat(np.arange(len(size)), size)
        key = ids[pointer, depth[part]]
        pivot = key[start + (rng.random(len(size)) * size).astype(np.int64)]
        side = (key > pivot[part]).astype(np.int64) + (key >= pivot[part])
        # a stable place for each pointer: what is less, equal, greater within its partition
        new = part * 3 + side
        count = np.bincount(new, minlength=3 * len(size))
        place = np.empty(len(pointer), np.int64)
        for s in range(3):
            mine = np.flatnonzero(side == s)
            before = np.cumsum(count[s::3]) - count[s::3]
            place[mine] = np.arange(len(mine)) - before[part[mine]] + (np.cumsum(count) - count)[new[mine]]
        moved = np.empty_like(pointer)
        moved[place] = pointer
        heavy = np.bincount(new, weight[pointer], minlength=3 * len(size)).astype(np.int64)
        first = np.cumsum(count) - count
        deep = np.repeat(depth, 3) + np.tile([0, 1, 0], len(size))
        shared = np.zeros(3 * len(size), bool)
        shared[new[partial[pointer] > depth[part] + 1]] = True
        keep = (count > 0) & ((heavy >= least) | shared)
        equal = np.zeros(3 * len(size), bool)
        equal[1::3] = True
        ended = equal.copy()
        ended[1::3] &= pivot == 0
        keep &= ~ended
        hit = np.flatnonzero(keep & equal)
        found.append((moved[first[hit]], deep[hit], heavy[hit]))
        keep &= ~equal | (deep < ids.shape[1])
        pointer = moved[np.repeat(keep, count)]
        depth, kept = deep[keep], count[keep]
        start = np.cumsum(kept) - kept
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _phrases(words_of: np.ndarray, least: int):
    """words_of: the hash of each number, 0 for number 0."""

    def phrases(table: pa.Table) -> pa.Table:
        codes, weight, depths, hashes = (np.concatenate(x) for x in zip(*map(_unpacked, table["suffixes"].to_pylist()), strict=True))
        own, place = np.unique(hashes, return_inverse=True)
        codes[codes == BY_HASH] = BY_HASH + place
        # beginnings of fewer words than the suffix was routed by are in other buckets too
        row, depth, n = equal_partitions(codes, weight, depths, least)
        row, depth, n = row[depth > 1], depth[depth > 1], n[depth > 1]
        found = codes[row][np.arange(DEPTH) < depth[:, None]]
        spelled = words_of[np.where(found < BY_HASH, found, 0)]
        spelled[found >= BY_HASH] = own[found[found >= BY_HASH] - BY_HASH]
        lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(depth)).astype(np.int32), pa.array(spelled.view(np.int64)))
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(row), pa.string()), "words": lists, "n": pa.array(n, pa.int64())})

    return phrases


def count_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, numbered_words: int = NUMBERED, bucket: int = BUCKET, routed: int = ROUTED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, frequent, phrases) of docs.

    totals: lang, n (all words). frequent: lang, word, key (the word's 64-bit hash), n: words of at least least occurrences.
    phrases: lang, words (hashes of 2 to DEPTH words), n: phrases of at least least occurrences. Two words of one language with one
    hash raise an error.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).where("length(text) > 0")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    most = size // 2 + 1  # words of one byte and a gap
    too_many = max(routed, most >> HOT_BITS)
    # what a block does not report adds up to less than a quarter of too_many
    found = rows.mapInArrow(_count(4 * most / too_many), "kind int, lang string, word string, key bigint, n bigint")
    counts = materialise(found.groupBy("kind", "lang", "word", "key").agg(F.sum("n").alias("n")), "counts")
    of_words = counts.where("kind = 0")
    totals = materialise(of_words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    frequent = materialise(of_words.where(F.col("n") >= least).drop("kind"), "frequent")
    if not frequent.groupBy("lang", "key").count().where("count > 1").isEmpty():
        raise RuntimeError("two words have one hash")
    # bounded: NUMBERED words, and under 4 / 3 * 2 ** HOT_BITS beginnings of each length
    top = of_words.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(numbered_words).select("key").toArrow()["key"].to_numpy().astype(np.int64).view(np.uint64)
    by_hash = np.argsort(top)
    heavy = counts.where("kind > 0").where(F.col("n") >= too_many * 3 // 4).select("kind", "key").toArrow()
    kinds, keys = heavy["kind"].to_numpy(), heavy["key"].to_numpy().astype(np.int64).view(np.uint64)
    hot = [np.sort(keys[kinds == d]) for d in range(1, DEPTH)]
    routed_rows = rows.mapInArrow(_route(top[by_hash], (by_hash + 1).astype(np.uint32), hot, size // bucket + 1), "bucket bigint, lang string, suffixes binary")
    parts = routed_rows.groupBy("bucket", "lang").applyInArrow(_phrases(np.append(np.uint64(0), top), least), "lang string, words array<bigint>, n bigint")
    phrases = materialise(parts.groupBy("lang", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "phrases")
    return totals, frequent, phrases


def _cuts(totals: DataFrame, frequent: DataFrame, phrases: DataFrame) -> DataFrame:
    """lang, words, a, k, left, right, l, r, score: every cut of every phrase. Counts of single words, which many phrases share, are found under one of _SALTS numbers."""
    single = frequent.select("lang", F.array("key").alias("part"), "n", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    counts = single.unionByName(phrases.select("lang", F.col("words").alias("part"), "n", F.lit(0).alias("salt")))
    size = F.size("words")
    cuts = phrases.select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("right"))
    for part, name in (("left", "l"), ("right", "r")):
        salt = F.when(F.size(part) == 1, F.pmod(F.xxhash64("words"), F.lit(_SALTS)).cast("int")).otherwise(F.lit(0))
        found = counts.select("lang", F.col("part").alias(part), F.col("salt").alias("at"), F.col("n").alias(name))
        cuts = cuts.withColumn("at", salt).join(found, ["lang", part, "at"]).drop("at")
    cuts = cuts.join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(18,0)")
    # whole numbers of up to 38 digits; div throws the rest away
    top, below = F.lit(1000).cast("decimal(4,0)") * big("a") * big("n"), big("l") * big("r")
    return cuts.withColumn("top", top).withColumn("below", below).withColumn("score", F.expr("top div below")).drop("top", "below")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, **sizes) -> DataFrame:
    """Each language's first phrases by score: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts are split at `[.,;:!?\\x0A-\\x0D]` and at spaces and tabs. The score is floor(1000 * a * n / (l * r)) at
    the cut where it is least, the first of equal ones. A phrase is left out if a longer one that holds it occurs as often: one of
    one word more does then, too. Null and empty texts have no words; a null lang is `und`; repeated rows count as often as they
    stand there; ties of score and count are ordered by the phrase's bytes; no words give no rows; texts are read whole, a very long one
    in one task; columns other than the two are not read.
    """
    totals, frequent, phrases = count_phrases(docs, text_col, lang_col, least, **sizes)
    cuts = materialise(_cuts(totals, frequent, phrases), "cuts")
    last = F.size("words") - 1
    covered = cuts.where((F.col("k") == last) & (F.col("l") == F.col("a"))).select("lang", F.col("left").alias("words"))
    covered = covered.unionByName(cuts.where("k = 1 and r = a").select("lang", F.col("right").alias("words"))).where("size(words) > 1").distinct()
    best = cuts.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.join(covered, ["lang", "words"], "left_anti").select("lang", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a")]
    # the first of each part, then of the language; ties at the end stay until phrases are spelled
    for by in (["lang", F.pmod(F.xxhash64("words"), F.lit(64))], ["lang"]):
        best = best.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= top)
    best = materialise(best.drop("place"), "best")
    spelled = best.select("lang", "words", F.posexplode("words").alias("at", "key")).join(frequent.select("lang", "key", "word"), ["lang", "key"])
    spelled = spelled.groupBy("lang", "words").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = best.join(spelled, ["lang", "words"]).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("bigint"))
    return named.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p
), g AS (
  SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k: list_transform(range(1, CAST(len(ws) AS BIGINT) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))))) AS phrase FROM w
), f AS MATERIALIZED (
  SELECT lang, phrase, count(*) AS n FROM g GROUP BY lang, phrase HAVING count(*) >= 100
), t AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE phrase LIKE '% %'
), k AS (
  SELECT lang, phrase, a, ws, unnest(range(1, CAST(len(ws) AS BIGINT))) AS k FROM c
), s AS (
  SELECT k.lang, k.phrase, k.a, k.k, x.n AS l, y.n AS r, t.n, CAST((1000::HUGEINT * k.a * t.n) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(ws[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(ws[k.k + 1:], ' ') JOIN t ON t.lang = k.lang
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT DISTINCT i.lang, i.phrase FROM c o, (SELECT unnest(range(1, 6)) AS at) u, (SELECT unnest(range(2, 5)) AS long) v, c i
  WHERE v.long < len(o.ws) AND u.at + v.long - 1 <= len(o.ws) AND i.lang = o.lang AND i.phrase = array_to_string(o.ws[u.at:u.at + v.long - 1], ' ') AND 100 * o.a >= 100 * i.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b ANTI JOIN held USING (lang, phrase)
) WHERE rank <= 2000
"""
