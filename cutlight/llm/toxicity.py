"""Toxicity by a factorization machine over hashed terms: weights of terms and of their pairs.

Terms are words (letters and digits, A-Z lower-cased) and the beginnings of words, as 64-bit hashes, so that no two terms share
a weight. Every term of enough training rows, toxic or clean, is in the machine: whether a term counts, alone or in pairs, is
found by the fit, which draws weights and factors without evidence to zero and then fits the others freely.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.scratch import materialise, ship

#: Bytes of a word's beginning that are terms of their own.
PREFIXES = (4, 5, 6)
#: Labelled rows that the fit uses of each class, picked by a hash of doc_id: the bound of the sample.
MOST_TOXIC, MOST_CLEAN = 3000, 6000
#: A term is in the machine if so many training rows have it.
LEAST_ROWS = 5
#: Standard errors of its gradient by which a weight, or a factor, is drawn to zero in the first PICKING epochs.
DRAWN_W, DRAWN_V, PICKING = 4.0, 6.0, 15
FACTORS, EPOCHS, RATE, DECAY, SEED = 6, 40, 0.1, 1e-4, 7
_FILTER = 1 << 20


@dataclass
class Model:
    """terms: sorted hashes; w and v: a weight and a factor row for each; bias."""

    terms: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def score(self, rows: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of n documents; (rows[i], of[i]): document rows[i] holds term number of[i], each pair once."""
        z = self.bias + np.bincount(rows, self.w[of], minlength=n)
        for f in range(self.v.shape[1]):
            x = self.v[of, f]
            z += (np.bincount(rows, x, minlength=n) ** 2 - np.bincount(rows, x * x, minlength=n)) / 2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _present(texts: pa.Array, terms: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, rows, of): the distinct pairs of documents first..end (counted from first) and terms they hold."""
    maybe = np.zeros(_FILTER, bool)
    maybe[(terms & np.uint64(_FILTER - 1)).astype(np.int64)] = True
    for first, end, h, counts in words.word_hashes(texts, words.PUNCT, PREFIXES):
        ends = np.cumsum(counts)
        which, at = np.nonzero(maybe[(h & np.uint64(_FILTER - 1)).astype(np.int64)])
        some = h[which, at]
        place = np.minimum(np.searchsorted(terms, some), max(len(terms) - 1, 0))
        good = terms[place] == some if len(terms) else np.zeros(len(some), bool)
        rows = np.searchsorted(ends, at[good], side="right")
        pairs = np.unique(rows.astype(np.int64) * max(len(terms), 1) + place[good])
        yield first, end, pairs // max(len(terms), 1), pairs % max(len(terms), 1)


#: Rows that a task scores and hands on at once.
ROWS = 2000


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): in how many of the task's documents each term is."""
    total: np.ndarray = np.zeros(0, np.uint64)
    count: np.ndarray = np.zeros(0, np.int64)
    for batch in batches:
        found = []
        for _, _, h, counts in words.word_hashes(batch.column(0), words.PUNCT, PREFIXES):
            at = 0
            for n in counts.tolist():
                own = np.unique(h[:, at : at + n])
                found.append(own[own != 0])
                at += n
        total, back = np.unique(np.concatenate([total, *found]), return_inverse=True)
        count = np.bincount(back, np.concatenate([count, np.ones(len(back) - len(count))]), minlength=len(total)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(total.view(np.int64)), pa.array(count)], names=["term", "n"])


def _encode(terms: np.ndarray):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[bytes] = []
            for first, end, rows, of in _present(batch.column(0), terms):
                cuts = np.searchsorted(rows, np.arange(end - first + 1)).tolist()
                lists += [of[a:b].astype("<i4").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.binary()), batch.column(1)], names=["terms", "toxic"])

    return encode


def _fit(lists: list[np.ndarray], y: np.ndarray, terms: np.ndarray) -> Model:
    """Stochastic gradients with Adagrad steps on the logistic loss; a bounded number of rows.

    In the first epochs each step is proximal, by a threshold in standard errors of the gradient of a term without evidence,
    so that frequent and rare terms are held alike; what is not zero then is fitted without it.
    """
    rng = np.random.default_rng(SEED)
    base = (y.sum() + 0.5) / (len(y) + 1)
    bias, w, v = float(np.log(base / (1 - base))), np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), FACTORS))
    if not len(terms) or y.min() == y.max():
        return Model(terms, bias, w, v)
    lists = [np.asarray(x, np.int32) for x in lists]
    share = np.bincount(np.concatenate(lists), minlength=len(terms)) / len(y)
    error = np.sqrt(share * base * (1 - base) / len(y) * np.maximum(1 - share, 0.05))
    for picking in (True, False):
        if not picking:  # terms that are left, and their numbers
            left = np.flatnonzero((w != 0) | (v != 0).any(1))
            number = np.full(len(terms), -1)
            number[left] = np.arange(len(left))
            lists = [n[n >= 0] for n in (number[x] for x in lists)]
            all_w, all_v, w, v, share, error = w, v, w[left], v[left], share[left], error[left]
            free_w, free_v = w != 0, v != 0
        gw, gv, gb = np.full(len(w), 1e-4), np.full(v.shape, 1e-4), 1e-4
        for _ in range(PICKING if picking else EPOCHS - PICKING):
            order = rng.permutation(len(y))
            for part in np.array_split(order, max(1, len(order) // 256)):
                n = np.array([len(lists[i]) for i in part])
                of = np.concatenate([lists[i] for i in part])
                some, first = n > 0, (np.cumsum(n) - n)[n > 0]
                sums, z = np.zeros((len(part), FACTORS)), np.full(len(part), bias)
                if len(of):
                    sums[some] = np.add.reduceat(v[of], first, axis=0)
                    z[some] += np.add.reduceat((w - (v**2).sum(1) / 2)[of], first)
                z += (sums**2).sum(1) / 2
                e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]
                seen = np.bincount(of, minlength=len(w))
                used = np.flatnonzero(seen)
                raw = np.bincount(of, np.repeat(e, n), minlength=len(w))[used]
                inner = np.stack([np.bincount(of, np.repeat(e * sums[:, f], n), minlength=len(w))[used] for f in range(FACTORS)], 1)
                dw, dv = raw / len(part), (inner - v[used] * raw[:, None]) / len(part)
                if not picking:
                    dw, dv = (dw + DECAY * w[used]) * free_w[used], (dv + DECAY * v[used]) * free_v[used]
                gw[used] += dw**2
                gv[used] += dv**2
                step_w, step_v = RATE / np.sqrt(gw[used]), RATE / 4 / np.sqrt(gv[used])
                w[used] -= step_w * dw
                v[used] -= step_v * dv
                if picking:
                    drawn = error[used] * seen[used] / len(part) / share[used]
                    size_w, size_v = step_w * DRAWN_W * drawn, step_v * DRAWN_V * drawn[:, None] * np.sqrt((sums**2).mean(0))
                    w[used] -= np.clip(w[used], -size_w, size_w)
                    v[used] -= np.clip(v[used], -size_v, size_v)
                db = e.mean()
                gb += db**2
                bias -= RATE * db / np.sqrt(gb)
    all_w[left], all_v[left] = w, v
    return Model(terms, float(bias), all_w, all_v)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from: crc32 of the doc_id as text is a multiple of 5 (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most MOST_TOXIC and MOST_CLEAN labelled rows that are not held out.

    A doc_id with several labels is toxic if one of them says so, one with several rows is one row of the sample; null labels and ids are left out. Without rows of both classes every
    score is the share of toxic rows.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out("doc_id"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    present = known.join(rows.select(F.col("doc_id").alias("of")).distinct(), F.col("doc_id") == F.col("of"), "left_semi")
    pick = lambda toxic, n: present.where((F.col("toxic") > 0) == F.lit(toxic)).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(n)
    picked = pick(True, MOST_TOXIC).union(pick(False, MOST_CLEAN)).withColumnRenamed("doc_id", "of")  # at most MOST_TOXIC + MOST_CLEAN rows
    # rows that share a picked doc_id are one row of the sample, so that its bound holds
    known_rows = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("of")).groupBy("doc_id", "toxic").agg(F.max_by("text", F.xxhash64("text")).alias("text"))
    sample = materialise(known_rows.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")), "sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    terms = np.zeros(0, np.uint64)
    if n_toxic and n_clean:
        kind = "term bigint, n bigint"
        often = sample.select("text").mapInArrow(_terms, kind).groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_ROWS)
        terms = np.sort(often.select("term").toArrow()["term"].to_numpy().astype(np.int64).view(np.uint64))
    # the bounded sample is fitted in one task; only the model comes to the driver
    fitted = sample.mapInArrow(_encode(terms), "terms binary, toxic int").repartition(1).mapInArrow(_fit_sample(terms), "model binary").toArrow()["model"]
    with np.load(io.BytesIO(fitted[0].as_py())) as m:
        return Model(m["terms"], float(m["bias"]), m["w"], m["v"])


def _fit_sample(terms: np.ndarray):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come in no certain order: sort them, so that every run fits the same model
        keyed = sorted((y, len(t), t) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        lists, y = [np.frombuffer(t, "<i4") for _, _, t in keyed], np.array([y for y, _, _ in keyed], np.float64)
        model = _fit(lists, y, terms)
        left = np.flatnonzero((model.w != 0) | (model.v != 0).any(1))
        out = io.BytesIO()
        np.savez(out, terms=model.terms[left], bias=model.bias, w=model.w[left], v=model.v[left])
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    return fit


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            parts = [model.score(rows, of, end - first) for first, end, rows, of in _present(batch.column(batch.num_columns - 1), model.terms)]
            names = [*batch.schema.names[:-1], "score"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=names)

    return score


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted. Null and empty texts have no terms: their score is the bias alone."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(_score(model), "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Rows of docs that the model does not call toxic, with all their columns."""
    ship(docs.sparkSession)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    kind = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True))
    with_text = docs.select("*", docs[text_col].cast("string")).toDF(*names, "_text")
    return with_text.mapInArrow(_score(model), f"{kind}, score double").where("score < 0.5").select(*names).toDF(*docs.columns)
