"""Secrets in texts, and who owns them: a string that many owners hold is an example, one that few hold looks alive."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutlight.llm.scratch import materialise, ship

KINDS = ("assign", "access", "hex", "entropy")
#: Case counts for nothing in the ASCII letters of the key only, so the class of each letter is spelled out.
_KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = re.compile(rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones need not be matched to be dropped
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: A long string is a candidate from this entropy (bits a character) on, with all three kinds of characters.
ENTROPY = 3.5
#: A candidate that more owners than this, or more repositories than that, hold is a copied example.
MOST_OWNERS, MOST_REPOSITORIES = 2, 20

_FOUND = "row bigint, doc_id bigint, owner string, repository string, kinds array<int>, starts array<bigint>, ends array<bigint>, keys array<string>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, secret) of all base matches, by start and kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(0, m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def long_strings(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """High-entropy strings that no base span touches."""
    out = []
    for m in _LONG.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s) and entropy(s) >= ENTROPY:
            if not any(a < m.end() and m.start() < b for _, a, b, _ in base):
                out.append((3, m.start(), m.end(), s))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    names = [x.split()[0] for x in _FOUND.split(", ")]
    for batch in batches:
        spans = []
        for text in batch.column(4).to_pylist():
            base = base_spans(text or "")
            spans.append(base + long_strings(text or "", base))
        lists = [pa.array([[s[i] for s in x] for x in spans], pa.list_(kind)) for i, kind in ((0, pa.int32()), (1, pa.int64()), (2, pa.int64()))]
        keys = pa.array([[hashlib.sha256(s[3].encode("utf-8", "replace")).hexdigest()[:32] for s in x] for x in spans], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *lists, keys], names=names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str | None = None, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> DataFrame:
    """One row per row of docs: doc_id, spans: array of struct(start, kind, end, owners, repositories, live), by start and kind.

    kind is a place in KINDS; start and end are code points, end exclusive. owners and repositories are the numbers of
    distinct holders of the same secret (of an assignment: its value) over the whole corpus; live says that they are few
    enough for a credential of its owner. Base spans (the first three kinds) are always there; long high-entropy
    strings only where they look alive. A null text counts as empty, null owners or repositories as one more holder. repository_col:
    by default each doc_id is a repository of its own.
    """
    ship(docs.sparkSession)
    repository = F.col(repository_col).cast("string") if repository_col else F.col(id_col).cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), repository.alias("repository"), F.col(text_col).cast("string").alias("text"))
    found = materialise(rows.mapInArrow(_scan, _FOUND), "secrets")
    each = found.where(F.size("keys") > 0).select("row", "owner", "repository", F.explode(F.arrays_zip("kinds", "starts", "ends", "keys")).alias("s"))
    each = each.select("row", F.coalesce("owner", F.lit("\x00")).alias("owner"), F.coalesce("repository", F.lit("\x00")).alias("repository"), "s.*")
    # holders first, then secrets: a copied example is summed up in each task before it moves
    holders = each.groupBy("keys", "owner", "repository").agg(F.lit(1).alias("one"))
    per_owner = holders.groupBy("keys", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    owners = per_owner.groupBy("keys").agg(F.count(F.lit(1)).alias("owners"))
    repos = holders.groupBy("keys", "repository").agg(F.lit(1).alias("one")).groupBy("keys").agg(F.count(F.lit(1)).alias("repositories"))
    known = materialise(owners.join(repos, "keys"), "holders").withColumnRenamed("keys", "key")
    live = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    judged = each.join(known, F.col("keys") == F.col("key")).withColumn("live", live).where(F.col("live") | (F.col("kinds") < 3))
    spans = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.col("starts").alias("start"), F.col("kinds").alias("kind"), F.col("ends").alias("end"), "owners", "repositories", "live"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.select("row", "doc_id").join(spans.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example of scan's rows."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("bigint")
    return scanned.select(
        "doc_id", *(count(i).alias(f"n_{KINDS[i]}") for i in range(3)), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"), F.size(F.filter("spans", lambda s: ~s["live"])).cast("bigint").alias("n_example"),
    )
