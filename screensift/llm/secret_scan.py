"""Secret scan with corpus-wide ownership frequency (operator 2).

Patterns give candidates (kind, span, hash of the secret value) per document;
candidate hashes are then counted over the whole corpus by distinct
repositories and owners. A value that many owners hold is a copied example;
one that stays with its owner is live-looking. Patterned candidates are always
reported, with that verdict; opaque high-entropy tokens, which no pattern names, are
reported only where ownership says they are live-looking.

Only candidates shuffle, never texts, and they are reduced to distinct (hash,
owner, repository) before the count.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screensift.llm.frames import chunks, materialise, text_of

#: Kinds in report order; the first three are the base patterns, the last is added by ownership.
KINDS = ("assign", "access", "hex", "opaque")
#: Owners from which on a value counts as a copied example; owners up to which it is live-looking.
EXAMPLE_OWNERS, LIVE_OWNERS, LIVE_REPOSITORIES = 3, 1, 2
#: Bits per character from which on an opaque token is a candidate.
MIN_ENTROPY = 3.5

# The base patterns, and the least lengths of what they match.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
ASSIGN_LENGTH = 6
# the greedy runs of 20 and 24 characters that `AKIA[A-Z0-9]+` and `[0-9a-f]+` would match and keep
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
_OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}+")


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _union(found: list[tuple[int, int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the candidates cover, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted(c[1:3] for c in found):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def _overlaps(taken: tuple[list[int], list[int]], start: int, end: int) -> bool:
    i = bisect_right(taken[1], start)  # the first stretch that ends after the start
    return i < len(taken[0]) and taken[0][i] < end


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind number, start, end, secret value) sorted by start, then kind."""
    out = []
    if ":" in text or "=" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                out.append((0, m.start(), m.end(), m[2]))
    out += [(1, m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(2, m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    taken = _union(out)
    for m in _OPAQUE.finditer(text):
        v = m[0]
        if (re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v) and entropy(v) >= MIN_ENTROPY
                and not _overlaps(taken, m.start(), m.end())):
            out.append((3, m.start(), m.end(), v))
    return sorted(out, key=lambda c: (c[1], c[0]))


def _scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository: Column | None) -> DataFrame:
    """(seq, id, owner, repository, found array<struct<kind, start, end, hash>>), one row per document."""
    repository = F.col(f"`{owner_col}`") if repository is None else repository
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{owner_col}`").cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), text_of(f"`{text_col}`").alias("text"))
    found_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            found = [[{"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()}
                      for k, s, e, v in candidates(t)] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("owner"), b.column("repository"), pa.array(found, found_type)],
                                             ["id", "owner", "repository", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, owner string, repository string, "
                                "found array<struct<kind:int,start:int,end:int,hash:string>>")


def ownership(found: DataFrame, example_owners: int = EXAMPLE_OWNERS, live_owners: int = LIVE_OWNERS,
              live_repositories: int = LIVE_REPOSITORIES) -> DataFrame:
    """(hash, owner, repository) -> (hash, owners, repositories, verdict) over the whole corpus."""
    held = found.select("hash", "owner", "repository").distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    counts = by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    verdict = F.when(F.col("owners") >= example_owners, F.lit("example")).when(
        (F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories), F.lit("live")).otherwise(F.lit("shared"))
    return counts.withColumn("verdict", verdict)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repository: Column | None = None, **limits) -> DataFrame:
    """``id_col`` plus ``secrets``: array of (start, kind, end, hash, owners, repositories, verdict), one row per input row.

    Sorted by start, then kind. NULL text is empty; a NULL owner (repository) is one
    unknown owner; repeated rows are scanned each and count once towards
    ownership; an empty table gives an empty result.
    """
    # the row number tells repeated rows apart; it is written with the scan, so every reader sees the same one
    scans = materialise(_scan(docs, id_col, text_col, owner_col, repository).withColumn("seq", F.monotonically_increasing_id()), "secret-scan")
    each = scans.where(F.size("found") > 0).select("seq", "owner", "repository", F.explode("found").alias("f")).select(
        "seq", "owner", "repository", "f.*")
    judged = each.join(ownership(each, **limits), "hash").where((F.col("kind") < 3) | (F.col("verdict") == "live"))
    secrets = judged.groupBy("seq").agg(F.sort_array(F.collect_list(
        F.struct("start", "kind", "end", "hash", "owners", "repositories", "verdict"))).alias("secrets"))
    none = F.array().cast(secrets.schema["secrets"].dataType)
    return scans.join(secrets, "seq", "left").select(F.col("id").alias(id_col), F.coalesce("secrets", none).alias("secrets"))


def spans_text(secrets: Column) -> Column:
    """kind:start:end of the given secrets, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(secrets: Column, kind: str) -> Column:
    return F.size(F.filter(secrets, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def count_verdict(secrets: Column, verdict: str) -> Column:
    return F.size(F.filter(secrets, lambda s: s["verdict"] == verdict)).cast("bigint")
