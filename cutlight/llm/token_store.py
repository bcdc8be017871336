"""Token ids in shards compressed by Re-Pair grammars.

A shard holds the ids of consecutive documents. Rounds replace the shard's most frequent pairs of neighbours by new
symbols, all pairs of a round at once, from left to right; no pair reaches over the end of a document, so a document's
symbols stand alone and can be expanded alone. The shard stores the rules and the length that each expands to.

Layout, little-endian: b"RPR1"; uint32 documents, terminals, rules, rounds; uint64 symbols, ids; rounds+1 uint32 first
rule of each round; rules uint16 left, right; rules uint32 expansion length; documents int64 id, uint8 id is null,
uint32 symbols, uint32 ids; symbols uint16.

Shards are written by Spark, one row a shard, so any store that Spark writes to will do and lost tasks are redone.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.scratch import new_path, ship

MAGIC = b"RPR1"
#: Id that ends a document; ids of a shard; pairs that a round replaces at most, and the least count at which a pair pays: each place
#: saves 2 bytes, a rule takes 8.
END, SHARD, PAIRS, LEAST = 1, 1 << 21, 2300, 5
_SLOTS = 18
#: Distinct words that a task keeps before it begins anew.
CACHE = 500_000


def _slot(key: np.ndarray) -> np.ndarray:
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)


def compress(ids: np.ndarray, counts: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols uint16, symbols of each document, rules (n, 2), first rule of each round) of ids < terminals.

    Rounds go on until no pair pays or all 65,536 symbols are in use. Of two pairs in one slot of a round's counts the
    commoner is counted exactly and replaced; the other one has its turn in a later round.
    """
    x = ids.astype(np.uint16)
    last = np.zeros(len(x), bool)
    last[np.cumsum(counts) - 1] = True
    rules, firsts, top = [np.zeros((0, 2), np.uint16)], [0], terminals
    while len(x) > 1 and top < 1 << 16:
        room = min(PAIRS, (1 << 16) - top)
        key = (x[:-1].astype(np.uint32) << np.uint32(16)) | x[1:]
        slot = _slot(key)
        count = np.bincount(slot, minlength=1 << _SLOTS) - np.bincount(slot[np.flatnonzero(last[:-1])], minlength=1 << _SLOTS)
        # pairs of the fullest slots, counted exactly; of two in one slot the commoner
        full = np.zeros(1 << _SLOTS, bool)
        fullest = np.argpartition(count, -room)[-room:]
        full[fullest[count[fullest] >= LEAST]] = True
        some = np.flatnonzero(full[slot] & ~last[:-1]).astype(np.int32)
        keys = key[some]
        ordered = np.sort(keys)
        at = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        pair, n = ordered[at], np.diff(np.append(at, len(ordered)))
        pair, n = pair[n >= LEAST], n[n >= LEAST]
        order = np.lexsort((pair, -n))
        pair = pair[order]
        pair = pair[np.sort(np.unique(_slot(pair), return_index=True)[1])][:room]
        if not len(pair):
            break
        known, name = np.zeros(1 << _SLOTS, np.uint32), np.zeros(1 << _SLOTS, np.uint16)
        taken = np.zeros(1 << _SLOTS, bool)
        known[_slot(pair)], taken[_slot(pair)] = pair, True
        name[_slot(pair)] = top + np.arange(len(pair))
        slots = slot[some]
        hit = some[(known[slots] == keys) & taken[slots]]
        # of neighbours that overlap every second one, from the left
        start = np.concatenate(([True], np.diff(hit) > 1))
        run = np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        x[hit] = name[slot[hit]]
        last[hit] = last[hit + 1]
        keep = np.ones(len(x), bool)
        keep[hit + 1] = False
        x, last = x[keep], last[keep]
        rules.append(np.stack((pair >> np.uint32(16), pair & np.uint32(0xFFFF)), 1).astype(np.uint16))
        top += len(pair)
        firsts.append(top - terminals)
    return x, np.diff(np.concatenate(([-1], np.flatnonzero(last)))), np.concatenate(rules), np.array(firsts, np.uint32)


def expansions(rules: np.ndarray, firsts: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat, offset, length): symbol s stands for flat[offset[s] : offset[s] + length[s]]."""
    flat, offset, length = np.arange(terminals, dtype=np.uint16), np.arange(terminals), np.ones(terminals, np.int64)
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        pairs = rules[a:b].reshape(-1)
        more = expand(pairs, (flat, offset, length))
        n = length[pairs].reshape(-1, 2).sum(1)
        offset = np.concatenate((offset, len(flat) + np.cumsum(n) - n))
        length, flat = np.concatenate((length, n)), np.concatenate((flat, more))
    return flat, offset, length


def expand(symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    flat, offset, length = table
    n = length[symbols]
    return flat[np.repeat(offset[symbols] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def pack(doc_ids: list, ids: np.ndarray, counts: np.ndarray, terminals: int) -> bytes:
    symbols, per_doc, rules, firsts = compress(ids, counts, terminals)
    length = expansions(rules, firsts, terminals)[2][terminals:]
    null = np.array([d is None for d in doc_ids], np.uint8)
    head = struct.pack("<4sIIIIQQ", MAGIC, len(doc_ids), terminals, len(rules), len(firsts) - 1, len(symbols), len(ids))
    parts = [firsts, rules[:, 0], rules[:, 1], length.astype(np.uint32), np.array([d or 0 for d in doc_ids], np.int64), null, per_doc.astype(np.uint32), counts.astype(np.uint32), symbols]
    return head + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


class Shard:
    """A packed shard; document(i) expands that document only."""

    def __init__(self, data: bytes):
        size = struct.calcsize("<4sIIIIQQ")
        magic, docs, self.terminals, rules, rounds, symbols, self.n_ids = struct.unpack("<4sIIIIQQ", data[:size])
        if magic != MAGIC:
            raise ValueError("not a shard")
        self._at, self._data = size, data
        take = self._take
        self.firsts = take(np.uint32, rounds + 1)
        self.rules = np.stack((take(np.uint16, rules), take(np.uint16, rules)), 1)
        self.lengths = take(np.uint32, rules)
        ids, null = take(np.int64, docs), take(np.uint8, docs)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null, strict=True)]
        self.symbol_counts, self.counts, self.symbols = take(np.uint32, docs).astype(np.int64), take(np.uint32, docs).astype(np.int64), take(np.uint16, symbols)
        self.symbol_starts = np.cumsum(self.symbol_counts) - self.symbol_counts
        self.table = expansions(self.rules, self.firsts, self.terminals)

    def _take(self, kind, n: int) -> np.ndarray:
        end = self._at + n * np.dtype(kind).itemsize
        out = np.frombuffer(self._data[self._at : end], kind)
        self._at = end
        return out

    def document(self, i: int) -> np.ndarray:
        a = self.symbol_starts[i]
        return expand(self.symbols[a : a + self.symbol_counts[i]], self.table)

    def all(self) -> np.ndarray:
        return expand(self.symbols, self.table)


#: Settings of a tokenizer under which a text's ids are those of its words, A-Z lower-cased, one after the other (fixed values).
_LOWER_WORDS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)


class Encoder:
    """Ids of texts by a tokenizers file.

    Where the file says that white space only separates words and letters are lower-cased (_LOWER_WORDS), each distinct
    word is encoded once and found again by its 64-bit hash; texts that hold "<|", which may begin a special token, and files
    with other settings go through the library text by text.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.terminals = self.tokenizer.get_vocab_size()
        if self.terminals > 1 << 16:
            raise ValueError("the file format holds ids of 16 bits")
        said = json.loads(self.tokenizer.to_str())
        special = all("<|" in t["content"] for t in said.get("added_tokens") or [])
        self.by_word = (said["normalizer"], said["pre_tokenizer"]) == _LOWER_WORDS and said["post_processor"] is None and said["model"]["type"] == "BPE" and not said["model"].get("dropout") and special
        suffix = said["model"].get("end_of_word_suffix")
        self.by_word = self.by_word and bool(suffix)
        if self.by_word:
            # the same model behind a splitter that knows white space only; a run of letters ends with a token that says so
            self.letters = Tokenizer.from_str(json.dumps(said | {"normalizer": None}))
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.last = np.zeros(self.terminals, bool)
            self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.pool, self.offset, self.length = np.zeros(0, np.uint16), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def _learn(self, keys: np.ndarray, new: list[bytes], plain: np.ndarray) -> None:
        """Ids of words not met before. plain: runs of letters that the normaliser would only lower-case skip it and the splitter."""
        order = np.argsort(~plain, kind="stable").tolist()
        n_plain = int(plain.sum())
        simple, rest = [new[i] for i in order[:n_plain]], [new[i].decode() for i in order[n_plain:]]
        ids, n = np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if simple:
            ids = np.array(self.letters.encode_batch_fast([b" ".join(simple).lower().decode()], add_special_tokens=False)[0].ids, np.uint16)
            n = np.diff(np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1)))
        if rest:
            got = self.tokenizer.encode(" ".join(rest), add_special_tokens=False)
            begins = np.cumsum([0, *[len(w) + 1 for w in rest[:-1]]])
            n = np.concatenate((n, np.bincount(np.searchsorted(begins, np.array([a for a, _ in got.offsets], np.int64), side="right") - 1, minlength=len(rest))))
            ids = np.concatenate((ids, np.array(got.ids, np.uint16)))
        if len(n) != len(new):
            raise RuntimeError("the tokenizer does not end runs of letters as its settings say")
        self.slots.update(zip(keys[order].tolist(), range(len(self.slots), len(self.slots) + len(new)), strict=True))
        self.offset = np.concatenate((self.offset, (len(self.pool) + np.cumsum(n) - n).astype(np.int32)))
        self.length = np.concatenate((self.length, n.astype(np.int32)))
        self.pool = np.concatenate((self.pool, ids))

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Yield (first, end, ids uint16, counts): texts[first:end] have these ids, counts[i] of them text first+i. Null counts as empty."""
        if not self.by_word:
            for at in range(0, len(texts), 200):
                got = [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch([t or "" for t in texts.slice(at, 200).to_pylist()], add_special_tokens=False)]
                yield at, at + len(got), np.concatenate(got), np.array([len(g) for g in got], np.int64)
            return
        data = words.buffers(texts)[0]
        for first, end, h, counts, starts, ends in words.word_spans(texts, tails=True):
            if len(starts) and ((data[starts[0] : ends[-1] - 1] == 60) & (data[starts[0] + 1 : ends[-1]] == 124)).any():
                got = [self._ids(t or "") for t in texts.slice(first, end - first).to_pylist()]
                yield first, end, np.concatenate(got), np.array([len(g) for g in got], np.int64)
                continue
            if len(self.slots) > CACHE:
                self._forget()
            u, at, inverse = np.unique(h, return_index=True, return_inverse=True)
            slot = np.fromiter(map(self.slots.get, u.tolist(), repeat(-1)), np.int64, len(u))
            missing = np.flatnonzero(slot < 0)
            if len(missing):
                a, b = starts[at[missing]], ends[at[missing]]
                letters = words.letters(data[starts[0] : ends[-1]])
                plain = letters[b - starts[0]] - letters[a - starts[0]] == b - a
                self._learn(u[missing], [data[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)], plain)
                slot[missing] = np.fromiter(map(self.slots.__getitem__, u[missing].tolist()), np.int64, len(missing))
            slot = slot[inverse]
            n = self.length[slot]
            upto = np.concatenate(([0], np.cumsum(n)))
            ids = self.pool[np.repeat(self.offset[slot] - upto[:-1].astype(np.int32), n) + np.arange(int(upto[-1]), dtype=np.int32)]
            yield first, end, ids, np.diff(upto[np.concatenate(([0], np.cumsum(counts)))])


def _ended(ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """ids with end behind those of each text."""
    out = np.empty(len(ids) + len(counts), np.uint16)
    ends = np.cumsum(counts + 1) - 1
    text = np.ones(len(out), bool)
    text[ends] = False
    out[ends], out[text] = end, ids
    return out


#: The encoder that a worker process has loaded, with the words it has learned; the next task finds it here.
_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _write(tokenizer_path: str, end: int, shard: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        task, number = TaskContext.get().partitionId(), 0
        docs: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, parts, sizes, held, number
            counts = np.concatenate(sizes)
            data = pack(docs, np.concatenate(parts), counts, encoder.terminals)
            row = [pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([int(counts.sum())], pa.int64()), pa.array([data], pa.binary())]
            docs, parts, sizes, held, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(row, names=["part", "shard", "n_ids", "data"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, last, ids, counts in encoder.encode(batch.column(1)):
                docs += keys[first:last]
                parts.append(_ended(ids, counts, end))
                sizes.append(counts + 1)
                held += len(parts[-1])
                if held >= shard:
                    yield flush()
        if docs:
            yield flush()

    return write


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, shard: int = SHARD) -> None:
    """Encode every text, end each with id end, and write shards under path in ascending order of ids (null first).

    Null and empty texts hold the end id only. Rows that repeat a doc_id stay rows of their own, next to each other.
    """
    spark = docs.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(_write(tokenizer_path, end, shard), "part int, shard int, n_ids bigint, data binary").write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            s = Shard(data.as_py())
            raw = s.all().astype("<u4").tobytes()
            ends = np.cumsum(s.counts)
            starts = ends - s.counts
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(s.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(s.counts, pa.int64()), pa.array(sums, pa.int64())],
                names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_index(spark, path: str) -> DataFrame:
    """One row per document of the shards under path, decoded: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ship(spark)
    shards = spark.read.schema("part int, shard int, n_ids bigint, data binary").parquet(path)
    docs = shards.select("part", "shard", "data").mapInArrow(_read, "part int, shard int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    upto = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")
    places = shards.select("part", "shard", "n_ids").withColumn("inside", upto).join(parts, F.col("part") == F.col("p")).select(F.col("part").alias("p"), F.col("shard").alias("s"), (F.col("before") + F.col("inside")).alias("base"))
    return docs.join(places, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s"))).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenize(docs: DataFrame, tokenizer_path: str, path: str | None = None, **names) -> DataFrame:
    """write_tokens and read_index: to path, or to a new folder in the shared one."""
    path = path or new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, **names)
    return read_index(docs.sparkSession, path)
