"""Documents packed into sequences of a fixed length: first-fit decreasing in randomised groups of documents.

A hash deals documents into groups of about GROUP bytes of text. In each group every document is encoded and ended; whole sequences are
cut from its front, and what is left goes, the longest first, into the first sequence with enough room, which a tournament
tree over the room of all sequences finds. Documents may be cut anywhere, so the emptiest sequences are then taken apart to fill
the gaps of the others, and the one sequence that stays open is cut into lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.scratch import materialise, ship

#: Ids of a sequence; the id that ends a document; bytes of text of a group; seed of the groups.
LENGTH, END, GROUP, SEED = 1024, 0, 8_000_000, 7
#: Bytes of text that are split at once; distinct tokens of text that a worker keeps before it begins anew.
SLICE, CACHE = 1 << 19, 500_000
_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4
_VALUE = words.mix((np.arange(1, 257, dtype=np.uint64) * np.uint64(words._BASE)))
_ALNUM = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
#: Settings under which a text's ids are those of its tokens of text, one after the other (fixed values).
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


class Encoder:
    """Ids of texts by a tokenizers file.

    Where the file is a byte-level BPE behind the usual splitting pattern (_BYTE_LEVEL), a text is split here, by classes of its
    characters that the library is asked for once, and each distinct token of text is encoded once and found again by its
    64-bit hash. Texts that hold an added token, and files with other settings, go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        said = json.loads(self.tokenizer.to_str())
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("sequences hold ids of 16 bits")
        model = said["model"]
        self.added = [t["content"].encode() for t in said.get("added_tokens") or []]
        plain = not any(t.get(k) for t in said.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word")) and not any(b" " in t for t in self.added)
        self.split = plain and said["normalizer"] is None and said["pre_tokenizer"] == _BYTE_LEVEL and said["post_processor"] is None and model["type"] == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        self.classes = np.zeros(0x110000, np.uint8)
        if self.split:
            # the same model behind a splitter that knows null characters only: tokens of text are learned in one call
            self.joined = Tokenizer.from_str(json.dumps(said))
            self.joined.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\0", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.null = self.joined.encode("\0", add_special_tokens=False).ids
            self.split = len(self.null) == 1
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.pool, self.offset, self.length = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _class(self, code: int) -> int:
        c, splits = chr(code), self.tokenizer.pre_tokenizer.pre_tokenize_str
        return next((k for k, before in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "#")) if len(splits(before + c)) == 1), _SPACE)

    def _starts(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Bytes of data where a token of text begins; firsts: ascending bytes where another text begins."""
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        code = data.astype(np.uint32) if len(chars) == len(data) else np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        kind = self.classes[code]
        if not kind.all():
            new = np.unique(code[kind == 0])
            self.classes[new] = [self._class(c) for c in new.tolist()]
            kind = self.classes[code]
        n = len(code)
        begins = np.zeros(n + 1, bool)  # a text begins
        begins[np.searchsorted(chars, firsts)] = begins[n] = True
        run = begins[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        token = run.copy()
        # a space before a run of another kind joins it, any other white space stands alone there
        after = np.flatnonzero(run[1:] & ~begins[1:n] & (kind[:-1] == _SPACE)) + 1
        token[after - 1] = True
        token[after[code[after - 1] == 32]] = False
        # 's 't 'm 'd 're 've 'll
        alone = np.flatnonzero((code == 39) & token[:n])
        alone = alone[(alone + 1 < n)]
        alone = alone[(kind[alone + 1] == _LETTER) & ~begins[alone + 1]]
        one, two = code[alone + 1], np.where(begins[np.minimum(alone + 2, n)], 0, code[np.minimum(alone + 2, n - 1)])
        short = np.isin(one, [115, 116, 109, 100])
        long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        for cut, width in ((alone[short], 2), (alone[long & ~short], 3)):
            token[cut + 1] = False
            token[(cut + width)[cut + width < n]] = True
        return chars[token]

    def _learn(self, keys: np.ndarray, new: list[bytes]) -> None:
        null = np.array([b"\0" in t for t in new])
        order = np.argsort(null, kind="stable")
        plain = int((~null).sum())
        ids, n = np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if plain:
            text = b"\0".join([new[i] for i in order[:plain].tolist()]).decode()
            ids = np.array(self.joined.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
            cuts = np.append(np.flatnonzero(ids == self.null[0]), len(ids))
            n, ids = np.diff(cuts, prepend=-1) - 1, np.delete(ids, cuts[:-1])
        for i in order[plain:].tolist():
            own = self.tokenizer.encode(new[i].decode(), add_special_tokens=False).ids
            ids, n = np.append(ids, np.array(own, np.uint16)), np.append(n, len(own))
        if len(n) != len(new):
            raise RuntimeError("null characters part tokens of text in another way than the settings say")
        self.slots.update(zip(keys[order].tolist(), range(len(self.slots), len(self.slots) + len(new)), strict=True))
        self.offset = np.concatenate((self.offset, len(self.pool) + np.cumsum(n) - n))
        self.length = np.concatenate((self.length, n))
        self.pool = np.concatenate((self.pool, ids))

    def _whole(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]
        return np.concatenate(got), np.array([len(g) for g in got], np.int64)

    def _part(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of the texts data[offsets[i]:offsets[i + 1]]."""
        raw = data.tobytes()
        if not self.split or any(t in raw for t in self.added):
            return self._whole([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        if len(self.slots) > CACHE:
            self._forget()
        inner = np.unique(offsets[:-1])
        starts = self._starts(data, inner[inner < len(data)])
        ends = np.append(starts[1:], len(data))
        power, back = words._tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * power[: len(data)], out=total[1:])
        h = words.mix((total[ends] - total[starts]) * back[starts])
        u, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        slot = np.fromiter(map(self.slots.get, u.tolist(), repeat(-1)), np.int64, len(u))
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            self._learn(u[missing], [raw[a:b] for a, b in zip(starts[at[missing]].tolist(), ends[at[missing]].tolist(), strict=True)])
            slot[missing] = np.fromiter(map(self.slots.__getitem__, u[missing].tolist()), np.int64, len(missing))
        slot = slot[inverse]
        n = self.length[slot]
        upto = np.concatenate(([0], np.cumsum(n)))
        ids = self.pool[np.repeat(self.offset[slot] - upto[:-1], n) + np.arange(int(upto[-1]))]
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yield (ids, ids of each text) of some texts after others. Null counts as empty; a very long text is split in parts, before a space behind a letter or digit."""
        data, off = words.buffers(texts)
        n, i = len(off) - 1, 0
        while i < n:
            j = int(np.searchsorted(off, off[i] + SLICE, side="right")) - 1
            if j > i:
                yield self._part(data[off[i] : off[j]], off[i : j + 1] - off[i])
                i = j
                continue
            at, end, found = int(off[i]), int(off[i + 1]), []
            while at < end:
                to = min(at + SLICE, end)
                while to < end:
                    room = np.flatnonzero((data[at + 1 : to] == 32) & _ALNUM[data[at : to - 1]])
                    if len(room):
                        to = at + 1 + int(room[-1])
                        break
                    to = min(2 * to - at, end)
                found.append(self._part(data[at:to], np.array([0, to - at]))[0])
                at = to
            ids = np.concatenate(found)
            yield ids, np.array([len(ids)])
            i += 1


#: The encoder that a worker process has loaded; the next task finds it here.
_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of item numbers: each item, the longest first and of equal ones the first, in the first bin with room for it."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [length] * (2 * leaves)  # room[i]: the most of bins below node i; bins are the leaves
    bins: list[list[int]] = [[] for _ in sizes]
    for i in order:
        size, node = sizes[i], 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[node - leaves].append(i)
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return [b for b in bins if b]


def pack(counts: list[int], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, ids) for documents of so many ids: all of length ids but the last ones, whose lengths are powers of two."""
    full: list[list[tuple[int, int, int]]] = []
    rest: list[tuple[int, int, int]] = []
    for doc, n in enumerate(counts):
        full += [[(doc, at, length)] for at in range(0, n - length + 1, length)]
        if n % length:
            rest.append((doc, n - n % length, n % length))
    bins = [[rest[i] for i in b] for b in first_fit_decreasing([n for _, _, n in rest], length)]
    used = [sum(n for _, _, n in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: -used[i])
    to, donor = 0, len(order) - 1
    while to < donor:
        gap, giver = length - used[order[to]], bins[order[donor]]
        if not gap:
            to += 1
            continue
        doc, start, n = giver.pop()
        part = min(gap, n)
        bins[order[to]].append((doc, start, part))
        if part < n:
            giver.append((doc, start + part, n - part))
        used[order[to]] += part
        used[order[donor]] -= part
        donor -= not giver
    out = full
    for i in order:
        pieces, left, size = bins[i], used[i], length
        if left == length:
            out.append(pieces)
            continue
        while left:
            size = 1 << (left.bit_length() - 1)
            taken: list[tuple[int, int, int]] = []
            room = size
            while room:
                doc, start, n = pieces.pop(0)
                part = min(room, n)
                taken.append((doc, start, part))
                if part < n:
                    pieces.insert(0, (doc, start + part, n - part))
                room -= part
            out.append(taken)
            left -= size
    return out


_PIECE = "struct<doc_id: bigint, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>"


def _pack(tokenizer_path: str, end: int, length: int):
    piece = pa.struct([(x, pa.int64()) for x in ("doc_id", "start", "length", "doc_tokens", "offset")])

    def packed(table: pa.Table) -> pa.Table:
        group = table["group"][0].as_py()
        encoder = _encoder(tokenizer_path)
        docs: list[np.ndarray] = []
        for ids, counts in encoder.encode(table["text"].combine_chunks()):
            ends = np.cumsum(counts)
            docs += [np.append(ids[a:b], np.uint16(end)) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
        names = table["doc_id"].to_pylist()
        order = sorted(range(len(docs)), key=lambda i: (names[i] is None, names[i] or 0, len(docs[i]), zlib.crc32(docs[i].tobytes())))  # rows come in no certain order
        docs, names = [docs[i] for i in order], [names[i] for i in order]
        rows: list[list] = [[], [], []]
        for number, pieces in enumerate(pack([len(d) for d in docs], length)):
            offsets = np.cumsum([0] + [n for _, _, n in pieces]).tolist()
            rows[0].append((group << 32) + number)
            rows[1].append(np.concatenate([docs[d][a : a + n] for d, a, n in pieces]).astype("<u2").tobytes())
            rows[2].append([{"doc_id": names[d], "start": a, "length": n, "doc_tokens": len(docs[d]), "offset": o} for (d, a, n), o in zip(pieces, offsets[:-1], strict=True)])
        return pa.table({"sequence_id": pa.array(rows[0], pa.int64()), "ids": pa.array(rows[1], pa.binary()), "pieces": pa.array(rows[2], pa.list_(piece))})

    return packed


def sequences(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, length: int = LENGTH, group: int = GROUP, seed: int = SEED) -> DataFrame:
    """The packed sequences: sequence_id, ids (binary, 16 bits little-endian each), pieces (doc_id, start, length, doc_tokens, offset).

    Every id of every document, its end among them, lies in one piece. Null and empty texts are their end alone. Rows that repeat a
    doc_id stay documents of their own; a null doc_id stays null. Empty docs give no rows. A sequence shorter than length has a power
    of two for its length. A very long text is encoded in one task. Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(size // group + 1)))
    return dealt.groupBy("group").applyInArrow(_pack(tokenizer_path, end, length), f"sequence_id bigint, ids binary, pieces array<{_PIECE}>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        rows = []
        for sequence, ids, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
            rows += [(p["doc_id"], p["start"], p["length"], zlib.crc32(raw[4 * p["offset"] : 4 * (p["offset"] + p["length"])]), p["doc_tokens"], sequence, p["offset"]) for p in pieces]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(names))], names=names)


def pieces(packed: DataFrame) -> DataFrame:
    """One row per piece of sequences(): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ship(packed.sparkSession)
    return packed.select("sequence_id", "ids", "pieces").mapInArrow(_digest, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def packed_pieces(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """sequences() written to the shared folder, and its pieces read back from there."""
    return pieces(materialise(sequences(docs, tokenizer_path, **options), "sequences"))
