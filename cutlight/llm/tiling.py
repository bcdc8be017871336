"""Benchmark passages in documents, in whatever order: greedy string tiling with running Karp-Rabin hashes.

A pair of a document and a benchmark item that share a seed (a run of MATCH words) is tiled: of all matches of unmarked
words the longest is marked, again and again, until none of MATCH words is left. An item of which the tiles cover enough
is in the document, even if its parts stand in another order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.scratch import free, materialise, ship

#: Least words of a tile (an item with fewer words is one tile of its own length); least words of an item: one or two words name nothing;
#: least share of an item's words.
MATCH, SHORTEST, COVERAGE = 5, 3, 0.5
#: Words of benchmark items that one pass over the documents carries along; more items mean more passes.
BLOCK = 2_000_000


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> int:
    """Words of item that greedy tiles cover; doc and item are word hashes."""
    if len(item) < least or len(doc) < least:
        return 0
    places: dict[int, list[int]] = {}
    for j, h in enumerate(words.windows(item, least).tolist()):
        places.setdefault(h, []).append(j)
    runs = words.windows(doc, least).tolist()
    found = []
    for i, h in enumerate(runs):
        for j in places.get(h, ()):
            if i and j and doc[i - 1] == item[j - 1]:
                continue  # inside a longer match
            n = least
            while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]:
                n += 1
            found.append((n, i, j))
    in_doc, in_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    # longest first; what an earlier tile has marked is cut off, and the rest waits its turn
    import heapq

    heap = [(-n, i, j) for n, i, j in found]
    heapq.heapify(heap)
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = ~(in_doc[i : i + n] | in_item[j : j + n])
        if free.all():
            in_doc[i : i + n] = in_item[j : j + n] = True
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(heap, (a - b, i + a, j + a))
    return int(in_item.sum())


def _match(items: list[tuple[int, np.ndarray]], least: int):
    """Tile each document against the items with which it shares a seed."""
    sizes = sorted({min(least, len(h)) for _, h in items})
    seeds, owners = {}, {}
    for k in sizes:
        pairs = [(s, n) for n, (_, h) in enumerate(items) if min(least, len(h)) == k for s in np.unique(words.windows(h, k)).tolist()]
        pairs.sort()
        seeds[k], owners[k] = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids = [], batch.column(0)
            for first, end, h, counts in words.word_hashes(batch.column(1), words.PUNCT):
                ends = np.cumsum(counts)
                pairs = set()
                for k in sizes:
                    s = words.windows(h, k)
                    lo = np.searchsorted(seeds[k], s)
                    at = np.flatnonzero(seeds[k][np.minimum(lo, len(seeds[k]) - 1)] == s)
                    of = np.searchsorted(ends, at, side="right")
                    inside = at + k <= ends[of]  # not over the end of a document
                    for p, d in zip(at[inside].tolist(), of[inside].tolist(), strict=True):
                        q = lo[p]
                        while q < len(seeds[k]) and seeds[k][q] == s[p]:
                            pairs.add((d, int(owners[k][q])))
                            q += 1
                for d, n in sorted(pairs):
                    item_id, item = items[n]
                    covered = tile(h[ends[d] - counts[d] : ends[d]], item, min(least, len(item)))
                    if covered:
                        rows.append((ids[first + d].as_py(), first + d, item_id, covered, len(item)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 2, 3, 4)], names=["row", "item_id", "covered", "item_words"])

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: int = MATCH) -> DataFrame:
    """(doc_id, item_id, covered, item_words) of all pairs with a tile.

    Items go along with the tasks in blocks of at most BLOCK words, each block one pass over the documents, so what a task
    holds is bounded whatever the benchmark's size; the driver holds the hashes of all items, 8 bytes a word. Words are runs of characters other than ASCII punctuation and white space,
    A-Z lower-cased. Null or empty items and texts match nothing, and neither do items of fewer than SHORTEST words; items
    that repeat an item_id are matched each. Of matches of one length the one that begins first in the document, then in the item, is marked first.
    A pair that shares frequent runs only is tiled like any other. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("row"), F.col(text_col).cast("string").alias("text"))
    listed = benchmark.select(F.col(item_col).cast("bigint"), F.col(item_text_col).cast("string")).toLocalIterator()
    blocks, block, held = [], [], 0
    for item_id, text in listed:
        h = np.concatenate([x[2] for x in words.word_hashes(pa.array([text], pa.string()), words.PUNCT)] or [np.zeros(0, np.uint64)])
        if len(h) >= SHORTEST:
            block.append((item_id, h))
            held += len(h)
            if held >= BLOCK:
                blocks.append(block)
                block, held = [], 0
    if block:
        blocks.append(block)
    ship(docs.sparkSession)
    kind = "row bigint, item_id bigint, covered bigint, item_words bigint"
    out = docs.sparkSession.createDataFrame([], kind)
    for b in blocks:
        out = out.union(rows.mapInArrow(_match(b, least), kind))
    return out.withColumnRenamed("row", "doc_id")


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **names) -> DataFrame:
    """One row per doc_id that holds a benchmark item: doc_id, item_ids (ascending), coverage (of the best one)."""
    share = F.col("covered") / F.col("item_words")
    hits = overlaps(docs, benchmark, **names).withColumn("share", share).where(F.col("share") >= coverage)
    return hits.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("coverage"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", coverage: float = COVERAGE, **names) -> DataFrame:
    """One row per row of docs: doc_id, contaminated, item_ids, coverage (0 and no items where there is nothing)."""
    found = materialise(contamination(docs, benchmark, coverage, id_col=id_col, **names), "contamination").withColumnRenamed("doc_id", "of")
    joined = docs.select(F.col(id_col).cast("bigint").alias("doc_id")).join(found, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return joined.select("doc_id", F.col("coverage").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", coverage: float = COVERAGE, **names) -> DataFrame:
    """Rows of docs without those that hold a benchmark item; rows that share a null or repeated doc_id go together."""
    of = free(docs, "_bad")
    bad = materialise(contamination(docs, benchmark, coverage, id_col=id_col, **names), "contamination").select(F.col("doc_id").alias(of))
    return docs.join(bad, docs[id_col].cast("bigint").eqNullSafe(F.col(of)), "left_anti")
