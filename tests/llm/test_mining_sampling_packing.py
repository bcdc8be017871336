import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import rows_of, rows_of_sql
from pyspark.sql import functions as F

from cutlight.llm import collocations, packing, queries, resampling

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 977}" for i in range(150_000))
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "The old, the new. The old house", "en", "a", 1), (5, "THE OLD HOUSE; the old house" * 3, "en", "b", 1),
    (6, "été où ça\x1c ſ été où", "fr", "a", 1), (7, LONG, "en", "b", 1), (8, "one\ttwo  one two\x0bone two", None, "b", 1), (9, "one two", "und", "c", 1), (4, "The old, the new. The old house", "en", "a", 1), (None, "The old house", "en", "a", 1),
]


def docs(spark, rows=ODD):
    """With columns named like those that the operators use inside."""
    df = spark.createDataFrame(rows, DOCS)
    for name in ("n", "score", "words", "word", "key", "group", "bucket", "rank", "place", "kind", "h", "part"):
        df = df.withColumn(name, F.lit(5))
    return df


def test_equal_partitions_count_all_beginnings():
    rng = np.random.default_rng(3)
    ids = rng.integers(1, 4, (400, 5)).astype(np.uint64)
    for row, n in zip(ids, rng.integers(1, 6, 400), strict=True):
        row[n:] = 0
    weight = rng.integers(1, 4, 400)
    want = collections.Counter()
    for row, w in zip(ids.tolist(), weight.tolist(), strict=True):
        row = [x for x in row if x]
        for d in range(1, len(row) + 1):
            want[tuple(row[:d])] += w
    row, depth, n = collocations.equal_partitions(ids, weight, np.ones(400, np.uint8), 7)
    assert {tuple(ids[r, :d].tolist()): w for r, d, w in zip(row, depth.tolist(), n.tolist(), strict=True)} == {k: w for k, w in want.items() if w >= 7}
    row, depth, n = collocations.equal_partitions(ids, weight, np.full(400, 3, np.uint8), 7)  # beginnings of fewer than three words are parts of a count
    assert {tuple(ids[r, :d].tolist()) for r, d in zip(row, depth.tolist(), strict=True)} == {k for k, w in want.items() if w >= 7 or len(k) < 3}
    assert [len(x) for x in collocations.equal_partitions(ids[:0], weight[:0], np.zeros(0, np.uint8), 7)] == [0, 0, 0]


def plain_collocations(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    hidden = {(lang, p[i:j]) for (lang, p), a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and a >= f[lang, p[i:j]]}
    scored = []
    for (lang, p), a in found.items():
        if (lang, p) not in hidden:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            scored.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out = []
    for lang in sorted(n):
        mine = sorted((r for r in scored if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine)]
    return out


@pytest.mark.parametrize("sizes", [{}, {"routed": 2, "numbered_words": 3, "bucket": 50}, {"routed": 40}])
def test_collocations_equal_plain_counts(spark, monkeypatch, sizes):
    rng = random.Random(5)
    rows = ODD[:6] + ODD[7:] + [(20 + i, " ".join(rng.choice(["The", "a", "b", "c,", "d", "e", "Of"]) for _ in range(60)), rng.choice(["en", "de", None]), "s", 1) for i in range(40)]
    rows += [(90, "of the same line again " * 50, "en", "s", 1)] * 3
    for least, top in ((3, 50), (2, 7)):
        got = collocations.collocations(docs(spark, rows).repartition(5), least=least, top=top, **sizes)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == sorted(plain_collocations(rows, least, top))


def test_collocations_of_long_and_no_texts(spark):
    rows = [ODD[6], ODD[0], ODD[1]]
    assert sorted(map(tuple, collocations.collocations(docs(spark, rows), top=30).collect())) == sorted(plain_collocations(rows, 100, 30))
    assert collocations.collocations(docs(spark, ODD[:3])).count() == 0
    assert collocations.collocations(docs(spark, ODD).limit(0)).count() == 0


def plain_resample(rows, goals, percent=25, least=20):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]

    number = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (collections.Counter(number(f) for x in texts for f in features(x)[1]) for texts in ([r[1] for r in rows], goals))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (ns + 10_000)) / ((s[b] + 1) * (nt + 10_000))))
    out = []
    for r in rows:
        n_words, fs = features(r[1])
        weight = sum(gain(number(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1], -r[5]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling_equals_a_plain_sort(spark):
    rng = random.Random(4)
    rows = ODD + [(100 + i // 2, " ".join(rng.choice(["Alpha", "beta9", "gamma", "x" * 90, "ça"]) for _ in range(rng.randint(0, 50))), "en", "s", 1) for i in range(150)]
    rows += [(7, "same text for many rows " * 9, "en", "s", 1)] * 60 + [(None, "same text for many rows " * 9, "en", "s", 1)] * 20
    goals = ["alpha beta9 alpha", None, "", "ça ira"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(goals)], "item_id int, text string")
    for percent in (25, 90, 0, 100):
        got = resampling.resample(docs(spark, rows).repartition(4), target, percent=percent)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, goals, percent)
    assert resampling.resample(docs(spark, rows).limit(0), target).count() == 0
    assert sorted(map(tuple, resampling.resample(docs(spark, rows), target.limit(0)).collect()), key=repr) == plain_resample(rows, [])


def test_quickselect_finds_every_place(spark):
    rng = random.Random(9)
    rows = [(rng.randint(-5, 5), rng.choice([None, *range(30)]), 1, 1) for _ in range(200)]
    df = spark.createDataFrame(rows, "score bigint, doc_id bigint, n_features bigint, n_words bigint")
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    for k in (1, 2, 50, 117, 200):
        assert tuple(resampling.kth(df, k, pivots=3).values()) == order[k - 1]
    assert resampling.kth(df, 0) is None and resampling.kth(df, 201) is None


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(queries.tokenizer_path("byte_bpe_50k.json"))


def test_encoder_gives_the_ids_of_the_library(encoder):
    rng = random.Random(5)
    some = ["'", "'s", "'re", "'ll", "'ve", "'v", "'m", "'d't", "a", "B", "é", "1", "²", " ", "  ", "\n", "\t", "#", "—", "中", "ſ", "\x1c", "\x00", "́", "\x85", "١", "𝒜", "😀", "don't", " 's", "​", "<|endof"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + ["<|endoftext|> a", None, LONG, " " * 600_000, "é" * 300_000]
    assert encoder.split
    got = [x for ids, n in encoder.encode(pa.array(texts)) for x in np.split(ids, np.cumsum(n)[:-1])]
    want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert len(got) == len(want) and all(g.tolist() == w.ids for g, w in zip(got, want, strict=True))


def test_first_fit_decreasing_equals_the_plain_rule():
    rng = random.Random(2)
    for n in (0, 1, 2, 7, 300):
        sizes = [rng.randint(1, 100) for _ in range(n)]
        bins, room = [], []
        for i in sorted(range(n), key=lambda i: -sizes[i]):
            at = next((b for b in range(len(bins)) if room[b] >= sizes[i]), len(bins))
            if at == len(bins):
                bins.append([])
                room.append(100)
            bins[at].append(i)
            room[at] -= sizes[i]
        assert packing.first_fit_decreasing(sizes, 100) == bins


def test_packing_holds_every_id_once(spark, encoder):
    rows = ODD + [(50 + i, "word " * (i * 37 % 1500), "en", "s", 1) for i in range(60)]
    packed = packing.sequences(docs(spark, rows).repartition(3), queries.tokenizer_path("byte_bpe_50k.json"), group=20_000).collect()
    want = collections.Counter((r[0], tuple(encoder.tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in rows)
    parts, sizes = collections.defaultdict(dict), []
    assert len({s.sequence_id for s in packed}) == len(packed)
    for s in packed:
        ids, at = np.frombuffer(s.ids, "<u2").tolist(), 0
        sizes.append(len(ids))
        for p in s.pieces:
            assert p.offset == at and p.length > 0
            at += p.length
            parts[p.doc_id, p.doc_tokens].setdefault(p.start, []).append(ids[p.offset : at])
        assert at == len(ids)
    assert all(n == 1024 or n & (n - 1) == 0 and n < 1024 for n in sizes)
    whole = sum(len(ids) * n for (_, ids), n in want.items())
    assert sum(sizes) == whole
    once = {k: ids for (k, ids), n in want.items() if n == 1 and sum(m for (j, x), m in want.items() if j == k and len(x) == len(ids)) == 1}
    for k, ids in once.items():
        pieces = parts[k, len(ids)]
        assert sum((pieces[a][0] for a in sorted(pieces)), []) == list(ids)
    got = packing.packed_pieces(docs(spark, rows), queries.tokenizer_path("byte_bpe_50k.json"))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for r in got.collect():
        if r.doc_id in once:
            assert r.ids_crc32 == zlib.crc32(np.array(once[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert packing.packed_pieces(docs(spark, rows).limit(0), queries.tokenizer_path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_importance_resampling"])
def test_sql_gives_the_same_rows(spark, name):
    assert rows_of(queries.QUERIES[name](spark, SF)) == rows_of_sql(SF, queries.SQL[name])
