"""Similarity self-join on sets of word shingles, by prefix filters under several global token orders.

Two sets of sizes a and b with Jaccard similarity t or more share a token within the first a - ceil(t a) + 1 tokens of
the one and the first b - ceil(t b) + 1 of the other, under any one order of all tokens. Three orders are used. All of
them put tokens that only one set holds first: those can be shared with nobody, so a set with that many tokens of its own
has no partner and leaves the join before any pair is made. Order 1 goes on by how many sets hold a token, rarest
first; orders 2 and 3 by two independent hashes. A pair is verified if it shares a prefix token under all three.

Stages:
1. each task turns its texts into shingle hashes, one set per class of equal sets, packs them in blocks of sets, and deals each block's
   distinct tokens out by hash bucket;
2. each bucket counts the sets of each token and keeps tokens of two sets or more (of a token that many sets of a block hold only the number
   goes through the bucket, so a token that every set holds costs its bucket a few bytes a block);
3. each block gets its shared tokens back and keeps those sets that can have a partner, with their three prefixes;
4. pairs of sets that share a prefix token under the first order are cut down by bounds and by the other two orders, and verified on their
   shared tokens.

Groups of near copies are not expanded into all pairs: rounds of stars (every set of a token against one leader) link
most of a group, then only pairs across different components are left, and all of those are tried. Before a pair leaves
the join of its token, bitmaps of both sets bound what they can share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutlight.llm import words
from cutlight.llm.graph import connected_components
from cutlight.llm.scratch import free, materialise, ship

#: Words of a shingle, and the similarity in hundredths.
SHINGLE, PERCENT = 5, 75
#: Shingle hashes that a task holds before it deals them out, and that one bucket should get.
FLUSH, BUCKET = 1_500_000, 1_500_000
#: A token is its bucket's number and this many further bits of its hash.
REST = 40
#: 64-bit words of a set's bitmap.
BITS = 8
#: Leaders that a set is tried against in a round of stars; rounds go on until one adds under a fiftieth of all links, or so many.
LEADERS, STAR_ROUNDS = 4, 8
#: A token of more sets of one block leaves their places with the block.
OFTEN = 64
#: Tokens of a prefix that a row of the last round carries at most.
LISTED = 64

_IN = "bucket int, block bigint, lo binary, hi binary, many binary, idx binary, often binary"
_DICT = "ids array<bigint>, id_cls binary, id_n binary, id_new binary, cls binary, n binary, hot binary, hot_many binary, hot_idx binary"
_BLOCK = f"{_IN}, {_DICT}"
_SHARED = f"doc_id bigint, doc_cls bigint, doc_n int, block bigint, bucket int, lo binary, hi binary, many binary, idx binary, df binary, {_DICT.split(', ', 4)[4]}"
_SETS = "cls bigint, n int, s int, bits array<bigint>, toks array<bigint>, p1 array<bigint>, p2 array<bigint>, p3 array<bigint>"


def _names(kind: str) -> list[str]:
    return [x.split()[0] for x in kind.split(", ")]


def _types(kind: str) -> list[pa.DataType]:
    of = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return [of[x.split()[1]] for x in kind.split(", ")]


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _signature(s: np.ndarray) -> int:
    """One number for a set; equal sets have equal numbers."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        return int(words.mix(np.array([words.mix(s).sum() + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal neighbours."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    return at, np.diff(np.append(at, len(x)))


def _sums(x: np.ndarray) -> np.ndarray:
    """Sum of all that stands before each place, and at last of everything."""
    return np.concatenate(([0], np.cumsum(x, dtype=np.int64)))


def _planes(x: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers of 40 bits as their low four bytes and their high one."""
    return x.astype(np.uint32).tobytes(), (x >> np.uint64(32)).astype(np.uint8).tobytes()


def _numbers(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return lo.astype(np.uint64) | (hi.astype(np.uint64) << np.uint64(32))


def _blocks(n_buckets: int, k: int):
    """Texts to blocks of sets: for each bucket the block's distinct tokens, sorted, with the places of the sets that hold them."""
    bits = np.uint64(n_buckets.bit_length() - 1)
    names, kinds = _names(_BLOCK), _types(_BLOCK)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        task, turn = TaskContext.get().partitionId(), 0
        ids, id_cls, id_n, id_new, sets, held = [], [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, id_cls, id_n, id_new, sets, held, turn
            cls = np.array([c for c, _ in sets], np.int64)
            sizes = np.array([len(s) for _, s in sets], np.int64)
            classes = np.array(id_cls, np.int64)
            # a block that another run of the task would fill otherwise has another number
            block = _signature(np.concatenate((classes.view(np.uint64), np.array([task, turn], np.uint64))))
            tok = np.concatenate([s for _, s in sets]) if sets else np.zeros(0, np.uint64)
            key = ((tok & np.uint64(n_buckets - 1)) << np.uint64(REST)) | ((tok >> bits) & np.uint64((1 << REST) - 1))
            order = np.argsort(key, kind="stable")
            key, idx = key[order], np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)[order]
            at, many = _runs(key)
            key, hot = key[at], many > OFTEN
            cold = np.repeat(~hot, many)
            hot_row = [key[hot].tobytes(), many[hot].astype(np.uint32).tobytes(), idx[~cold].tobytes()]
            bucket, rest = (key >> np.uint64(REST)).astype(np.int64), key & np.uint64((1 << REST) - 1)
            gap = rest.copy()
            gap[1:] -= np.where(bucket[1:] == bucket[:-1], rest[:-1], np.uint64(0))
            lo, hi = _planes(gap)
            few = np.where(hot, 0, many)
            upto, hots = _sums(few), _sums(hot)
            few, often, idx = few.astype(np.uint8).tobytes(), many[hot].astype(np.uint32).tobytes(), idx[cold].tobytes()
            starts, lengths = _runs(bucket)
            rows = []
            for x, n in zip(starts.tolist(), lengths.tolist(), strict=True):
                y = x + n
                rows.append([int(bucket[x]), block, lo[4 * x : 4 * y], hi[x:y], few[x:y], idx[2 * upto[x] : 2 * upto[y]], often[4 * hots[x] : 4 * hots[y]], *[None] * 9])
            own = [ids, classes.tobytes(), np.array(id_n, np.uint32).tobytes(), np.array(id_new, bool).tobytes(), cls.tobytes(), sizes.astype(np.uint32).tobytes(), *hot_row]
            rows.append([(task + turn) % n_buckets, block, *[None] * 5, *own])
            ids, id_cls, id_n, id_new, sets, held, turn = [], [], [], [], [], 0, turn + 1
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, end, h, counts in words.word_hashes(batch.column(1)):
                at = 0
                for i in range(first, end):
                    s = words.shingle_set(h[at : at + counts[i - first]], k)
                    at += counts[i - first]
                    c = _signature(s)
                    ids.append(keys[i])
                    id_cls.append(c)
                    id_n.append(len(s))
                    id_new.append(len(s) > 0 and c not in seen)
                    if id_new[-1]:
                        seen.add(c)
                        sets.append((c, s))
                        held += len(s)
                    if held >= FLUSH or len(ids) >= 60_000:
                        yield flush()
        if ids:
            yield flush()

    return deal


def _arrays(table: pa.Table, *columns: tuple[str, type]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each column's bytes as one array of numbers, and how many of them each row has."""
    out = []
    for name, kind in columns:
        parts = table[name].to_pylist()
        out.append((np.frombuffer(b"".join(parts), kind), np.array([len(p) // np.dtype(kind).itemsize for p in parts], np.int64)))
    return out


def _shared(bucket: pa.Table) -> pa.Table:
    """Of all blocks' tokens in a bucket those that two sets or more hold, with their count; blocks' own rows pass through."""
    own = bucket.filter(pc.is_valid(bucket["ids"]))
    has = bucket.filter(pc.is_null(bucket["ids"]))
    (lo, n), (hi, _), (many, _), (idx, n_idx), (often, _) = _arrays(has, ("lo", np.uint32), ("hi", np.uint8), ("many", np.uint8), ("idx", np.uint16), ("often", np.uint32))
    run = np.cumsum(_numbers(lo, hi))  # gaps to tokens; sums wrap around and differences are right again
    first = _sums(n)[:-1]
    tok = run - np.repeat(np.where(first > 0, run[first - 1], np.uint64(0)), n) if len(run) else run
    count = many.astype(np.int64)
    count[many == 0] = often
    order = np.argsort(tok, kind="stable")
    at, same = _runs(tok[order])
    df = np.zeros(len(tok), np.int64)
    if len(tok):
        df[order] = np.repeat(np.add.reduceat(count[order], at), same)
    keep = df > 1
    held, held_idx = keep, np.repeat(keep, many)
    cuts, idx_cuts = _sums(keep)[_sums(n)], _sums(held_idx)[_sums(n_idx)]
    lo, hi = _planes(tok[held])
    many, df, idx = many[held].tobytes(), np.minimum(df[held], (1 << 32) - 1).astype(np.uint32).tobytes(), idx[held_idx].tobytes()
    rows, number = [], bucket["bucket"][0].as_py()
    for block, x, y, a, b in zip(has["block"].to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), idx_cuts[:-1].tolist(), idx_cuts[1:].tolist(), strict=True):
        if x < y:
            rows.append([None, None, None, block, number, lo[4 * x : 4 * y], hi[x:y], many[x:y], idx[2 * a : 2 * b], df[4 * x : 4 * y], *[None] * 5])
    for r in own.select(["block", "cls", "n", "hot", "hot_many", "hot_idx"]).to_pylist():
        rows.append([None, None, None, r["block"], *[None] * 6, r["cls"], r["n"], r["hot"], r["hot_many"], r["hot_idx"]])
    kinds = _types(_SHARED)
    packed = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
    (cls, per), (size, _), (new, _) = _arrays(own, ("id_cls", np.int64), ("id_n", np.uint32), ("id_new", bool))
    blocks = np.repeat(np.array(own["block"].to_pylist(), np.int64), per)
    members = [pc.list_flatten(own["ids"].combine_chunks()), pa.array(cls), pa.array(size.astype(np.int32)), pa.array(blocks, mask=~new)]
    members += [pa.nulls(len(cls), t) for t in kinds[4:]]
    return pa.Table.from_arrays([pa.chunked_array([a, b]) for a, b in zip(packed, members, strict=True)], names=_names(_SHARED))


def _prefixes(n_buckets: int, percent: int):
    """A block's sets that can have a partner: their shared tokens, a bitmap of these, and their prefixes under three orders."""
    bits = np.uint64(n_buckets.bit_length() - 1)

    def cut(table: pa.Table) -> pa.Table:
        again = table.filter(pc.is_valid(table["times"]))
        own = table.filter(pc.is_valid(table["cls"]))
        has = table.filter(pc.is_valid(table["lo"]))
        if len(own) != 1:
            raise RuntimeError("a block was lost between two runs of its task; run the join again over rows in a fixed order")
        (cls, _), (size, _), (hot, _), (hot_many, _), (hot_idx, _) = _arrays(own, ("cls", np.int64), ("n", np.uint32), ("hot", np.uint64), ("hot_many", np.uint32), ("hot_idx", np.uint16))
        (lo, n), (hi, _), (many, _), (idx, _), (df, _) = _arrays(has, ("lo", np.uint32), ("hi", np.uint8), ("many", np.uint8), ("idx", np.uint16), ("df", np.uint32))
        size, bucket = size.astype(np.int64), np.repeat(np.array(has["bucket"].to_pylist(), np.uint64), n)
        rest = _numbers(lo, hi)
        tok = (rest << bits) | bucket
        # sets' places: those that came along, and those of the block's frequent tokens
        often = np.flatnonzero(many == 0)
        place = np.searchsorted(hot, (bucket[often] << np.uint64(REST)) | rest[often])
        where = np.concatenate([np.repeat(np.arange(len(tok)), many), np.repeat(often, hot_many[place])])
        ends = _sums(hot_many)
        owners = np.concatenate([idx, *[hot_idx[ends[p] : ends[p + 1]] for p in place.tolist()]]).astype(np.int64)
        # a set that stands in several blocks is not its own partner, and counts in the first of them
        times, first = np.ones(len(cls), np.int64), np.ones(len(cls), bool)
        if len(again):
            known = {c: (t, f) for c, t, f in zip(again["again"].to_pylist(), again["times"].to_pylist(), again["first"].to_pylist(), strict=True)}
            for i, c in enumerate(cls.tolist()):
                if c in known:
                    times[i], first[i] = known[c]
        keep = (df[where] > times[owners]) & first[owners]
        where, owners = where[keep], owners[keep]
        order = np.argsort(owners, kind="stable")
        where, owners = where[order], owners[order]
        at, m = _runs(owners)
        room = prefix_length(size[owners[at]], percent) - (size[owners[at]] - m)
        rows = []
        for x, m_, k, o in zip(at.tolist(), m.tolist(), room.tolist(), owners[at].tolist(), strict=True):
            if k > 0:
                t, d = tok[where[x : x + m_]], df[where[x : x + m_]]
                orders = (np.lexsort((words.mix(t), d)), np.argsort(words.mix(t ^ np.uint64(0xA5A5A5A5))), np.argsort(words.mix(t ^ np.uint64(0x5C5C5C5C3C3C))))
                spot = words.mix(t ^ np.uint64(0x3333333377777777)) & np.uint64(64 * BITS - 1)
                bitmap = np.zeros(BITS, np.uint64)
                np.bitwise_or.at(bitmap, (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))
                rows.append([int(cls[o]), int(size[o]), m_, bitmap.view(np.int64), t.view(np.int64), *(t[o_[:k]].view(np.int64) for o_ in orders)])
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_types(_SETS))], names=_names(_SETS))

    return cut


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b), distinct and written: those that share a prefix token under orders 2 and 3 too, and whose similarity is enough.

    The prefixes of the pairs come first; all tokens only move for pairs that pass under every order.
    """
    side = lambda x, *more: sets.select(F.col("cls").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in more))
    pairs = pairs.join(side("a", "p2", "p3"), "a").join(side("b", "p2", "p3"), "b").where(F.arrays_overlap("p2_a", "p2_b") & F.arrays_overlap("p3_a", "p3_b")).select("a", "b")
    both = F.size(F.array_intersect("toks_a", "toks_b"))
    return pairs.join(side("a", "n", "toks"), "a").join(side("b", "n", "toks"), "b").where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def _alike(percent: int) -> F.Column:
    """Can a and b be similar enough, by their sizes n and the place pos of a common token in order 1?

    For the first common token all others follow it, so a later one may fail this for a pair, the first one never does.
    """
    after = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    return ((100 + percent) * after >= percent * (F.col("n_a") + F.col("n_b"))) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))


def _bounded(percent: int) -> F.Column:
    """Can they be, by the numbers s of tokens shared with anyone, and bitmaps? A bit that only a has stands for a token at least that b lacks."""

    def most(x: str, y: str) -> F.Column:
        lacks = sum((F.bit_count(F.get(f"bits_{x}", i).bitwiseAND(F.bitwise_not(F.get(f"bits_{y}", i)))) for i in range(BITS)), F.lit(0))
        return F.col(f"s_{x}") - lacks

    return (100 + percent) * F.least(most("a", "b"), most("b", "a")) >= percent * (F.col("n_a") + F.col("n_b"))


def _side(rows: DataFrame, x: str, *names: str) -> DataFrame:
    return rows.select("tok", F.col("cls").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in names))


def _star_pairs(now: DataFrame, sets: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each set of a token against a leader in another component; each turn and each residue of tokens has leaders of its own."""
    rows = now.withColumn("r", F.xxhash64(F.lit(turn), F.pmod("tok", F.lit(LEADERS)), "cls"))
    # numbers only, so that hash aggregation does for it
    heads = rows.groupBy("tok").agg(*[F.min_by(c, "r").alias(x) for c, x in (("cls", "b"), ("n", "n_b"), ("pos", "pos_b"), ("comp", "comp_b"))], F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").drop("lo", "hi")
    pairs = _side(now, "a", "n", "pos", "comp").join(heads, "tok").where((F.col("comp_a") != F.col("comp_b")) & _alike(percent)).select("a", "b").distinct()
    for x in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("cls").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "s", "bits"))), x)
    return pairs.where(_bounded(percent)).select("a", "b")


def _open_pairs(now: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of each token's sets those outside its commonest component against all that lie elsewhere.

    A pair meets on the first of its common tokens alone: rows carry what stands before their token in the prefix. Prefixes
    of more than LISTED tokens do without; their pairs may meet more than once.
    """
    sizes = now.groupBy("tok", "comp").agg(F.count("*").alias("c"))
    tokens = sizes.groupBy("tok").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps")).where("comps > 1")
    rows = now.join(tokens.select("tok", F.col("m.comp").alias("major")), "tok").withColumn("in", F.col("comp") == F.col("major")).drop("major")
    before = F.when(F.size("p1") <= LISTED, F.slice("p1", F.lit(1), F.col("pos") - (F.col("n") - F.col("s")))).otherwise(F.array().cast("array<bigint>"))
    rows = materialise(rows.join(sets.select("cls", "p1"), "cls").withColumn("before", before).drop("p1"), "open")
    names = ("n", "s", "bits", "pos", "comp", "in", "before")
    apart = (F.col("comp_a") != F.col("comp_b")) & (F.col("in_b") | (F.col("a") < F.col("b"))) & ~F.arrays_overlap("before_a", "before_b")
    joined = _side(rows.where(~F.col("in")), "a", *names).join(_side(rows, "b", *names), "tok")
    return joined.where(apart & _alike(percent) & _bounded(percent)).select("a", "b").distinct()


def links_and_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(members, components).

    members (doc_id, cls, n): every row of docs, the class of its shingle set and the set's size; components (cls,
    component): for every class with a link to another one, the least class that links reach.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_buckets = 1 << max(3, int(np.ceil(np.log2(max(1, chars / 6 / BUCKET)))))  # a word has about six characters; only sizes hang on this
    found = materialise(rows.mapInArrow(_blocks(n_buckets, k), _BLOCK).groupBy("bucket").applyInArrow(_shared, _SHARED), "shared")
    members = found.where("doc_cls is not null").select("doc_id", F.col("doc_cls").alias("cls"), F.col("doc_n").alias("n"), "block")
    places = members.where("block is not null").select("cls", "block")  # where a set was dealt, once for each task that met it
    several = places.groupBy("cls").agg(F.count("*").alias("times"), F.min("block").alias("least")).where("times > 1")
    again = places.join(several, "cls").select("block", F.col("cls").alias("again"), "times", (F.col("block") == F.col("least")).alias("first"))
    packed = found.where("doc_cls is null").drop("doc_id", "doc_cls", "doc_n").unionByName(again, allowMissingColumns=True)
    sets = materialise(packed.groupBy("block").applyInArrow(_prefixes(n_buckets, percent), _SETS), "sets")
    tokens = materialise(sets.select(F.posexplode("p1").alias("at", "tok"), "cls", "n", "s", "bits").withColumn("pos", F.col("n") - F.col("s") + F.col("at")).drop("at"), "prefix")
    component = links = None

    def labelled() -> DataFrame:
        if component is None:
            return tokens.withColumn("comp", F.col("cls"))
        return tokens.join(component.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")

    total, turn, stars = 0, 0, True
    while True:
        pairs = _star_pairs(labelled(), sets, turn, percent) if stars else _open_pairs(labelled(), sets, percent)
        new = materialise(_verified(materialise(pairs, "pairs"), sets, percent), "links")
        found = new.count()
        links = new if links is None else links.union(new)
        total, turn, last = total + found, turn + 1, not stars
        stars = stars and turn < STAR_ROUNDS and found * 50 > total
        # the few links of the last stars may wait: finer components only mean that the last round tries some pairs again
        if total and (stars or last):
            component = materialise(connected_components(links, "a", "b"), "components")
        if last:
            break
    if component is None:
        component = spark.createDataFrame([], "node bigint, component bigint")
    return members.drop("block"), component.select(F.col("node").alias("cls"), "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles (size of its set of distinct k-word shingles), component_id.

    component_id is the least doc_id that links reach, its own included. Rows of equal sets are linked whatever their
    texts. Null or empty texts have no shingles and are linked with nothing: their component is their own doc_id. A null
    doc_id is kept; it never becomes the component of a row that has a doc_id among its links. Other columns of docs
    are not read.
    """
    members, components = links_and_classes(docs, id_col, text_col, k, percent)
    classes = members.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    classes = classes.join(components, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    classes = classes.withColumn("clash", F.when(F.col("lo") != F.col("hi"), F.raise_error(F.lit("two sets have one hash"))).cast("boolean"))
    group = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    label = materialise(classes.join(group, "component").select("cls", "component_id", "clash"), "labels")
    joined = members.join(label.withColumnRenamed("cls", "of"), (F.col("cls") == F.col("of")) & (F.col("n") > 0), "left")
    return joined.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near duplicates: of each component the row with the least doc_id stays (all rows without text or id stay)."""
    groups = near_duplicates(docs, id_col, text_col)
    of = free(docs, "_drop")
    drop = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(of)).distinct()
    return docs.join(drop, docs[id_col].cast("bigint") == F.col(of), "left_anti")
