"""Operators 11 to 13 against plain versions, and on nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from screensift.llm import conversations, merkle, ngram_join

from .test_operators import SCHEMA, edge_rows, roots

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


# Merkle manifest -----------------------------------------------------------------------------------------

def plain_manifest(rows, shown, fanout):
    """Rows (doc_id, source, ..) -> the manifest's rows, by recursion over lists; ``shown`` is what is verified."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    leaves = [(r[0], r[1], H(*map(field, r)), H(*map(field, s))) for r, s in zip(rows, shown)]

    def climb(level):
        paths, groups = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            up, members = [], []
            for at in range(0, len(level), fanout):
                run = level[at:at + fanout]
                for k in range(len(run)):
                    for i in groups[at + k]:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
                up.append(H(*run))
                members.append([i for g in groups[at:at + fanout] for i in g])
            level, groups = up, members
        return level[0], paths

    by = defaultdict(list)
    for i, s, leaf, other in leaves:
        by[s].append((i, leaf, other))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: climb([x[1] for x in by[s]]) for s in names}
    root, above = climb([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (i, leaf, other), path in zip(by[s], trees[s][1]):
            node = other
            for left, right in path + up:
                node = H(left, node, right)
            out.append((i, leaf, trees[s][0], root, H(*[a + b for a, b in path + up]), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest_equals_plain_trees(spark, fanout):
    rng = random.Random(fanout)
    rows = [(i, f"Text {i}\néA" if i % 7 else None, rng.choice(["en", None]), rng.choice(["b", "a", "é", None, "b", "b"]), i) for i in range(90)]
    rows += [(500, "Alone", "en", "lonely", 5), (None, "no id", "en", "a", 5), (None, "No id", "en", "a", 5), (7, "again", None, "a", 1), rows[3]]
    order = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, grp string").repartition(5)
    tampered = F.col("doc_id") % 5 == 0
    got = merkle.manifest(docs, fanout=fanout, presented={"text": F.when(tampered, F.lower("text")).otherwise(F.col("text"))})
    shown = [(*o[:4], o[4].lower() if o[4] and o[0] is not None and o[0] % 5 == 0 else o[4]) for o in order]
    assert sorted(map(tuple, got.collect()), key=str) == plain_manifest(order, shown, fanout)
    assert {r.verified for r in got.collect()} == {True, False}


def test_manifest_edges(spark, edge):
    got = merkle.manifest(edge)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.count() == edge.count() and got.where("NOT verified").count() == 0 and got.select("root").distinct().count() == 1
    again = merkle.manifest(edge.repartition(7).select(*reversed(edge.columns)))
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert merkle.manifest(edge.limit(0)).count() == 0
    one = merkle.manifest(edge.where("doc_id = 1").limit(1)).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == H("")


# conversation repair ----------------------------------------------------------------------------------------

PATTERN = re.compile("(s?(ua)+)?")


def brute_repair(initials, faults):
    """(cost, audit) by trying all edits, up to three inserts in a row, cheapest cost and ASCII-least audit."""
    best = [None]

    def go(i, out, cost, audit, inserts):
        if best[0] is not None and cost > best[0][0]:
            return
        if i == len(faults) and PATTERN.fullmatch(out):
            offer = (cost, audit)
            best[0] = offer if best[0] is None else min(best[0], offer)
        if inserts < 3:
            for r in "ua":
                go(i, out + r, cost + 2, audit + "I", inserts + 1)
        if i < len(faults):
            go(i + 1, out, cost + 3, audit + "D", 0)
            if faults[i] >= conversations.CUT:
                stays = int(faults[i] == conversations.CUT)
                go(i + 1, out + initials[i], cost + stays, audit + "K", 0)
                for r in "ua":
                    go(i + 1, out + r, cost + 2 + stays, audit + "R", 0)

    best[0] = (3 * len(faults), "D" * len(faults))
    go(0, "", 0, "", 0)
    return best[0]


def test_search_equals_all_edits():
    for n in range(4):
        for initials in product("sua ", repeat=n):
            for faults in product((1, 2, 3), repeat=n):
                text = "".join(initials)
                assert conversations.cheapest_audit(text.encode(), bytes(faults)) == brute_repair(text, faults), (text, faults)
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(4, 6)
        text, faults = "".join(rng.choice("suauax") for _ in range(n)), [rng.choice((0, 1, 2, 3, 3, 3)) for _ in range(n)]
        assert conversations.cheapest_audit(text.encode(), bytes(faults)) == brute_repair(text, faults), (text, faults)


def table_repair(initials, faults):
    """(cost, audit) row by row over the four states, inserts as closures."""
    takes = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    adds = {0: [(0, 0, ""), (2, 2, "I"), (3, 4, "II")], 1: [(1, 0, ""), (2, 2, "I"), (3, 4, "II")], 2: [(2, 0, ""), (3, 2, "I")], 3: [(3, 0, ""), (2, 2, "I")]}
    now = {0: (0, "")}
    for c, fault in zip(initials, faults):
        nxt = {}
        for s, (cost, audit) in now.items():
            for t, price, edits in adds[s]:
                moves = [(t, 3, "D")]
                if fault >= 2:
                    moves.append((3 if t == 2 else 2, 2 + (fault == 2), "R"))
                    if (t, c) in takes:
                        moves.append((takes[t, c], int(fault == 2), "K"))
                for to, more, edit in moves:
                    offer = (cost + price + more, audit + edits + edit)
                    nxt[to] = min(nxt.get(to, offer), offer)
        now = nxt
    return min((cost + price, audit + edits) for s, (cost, audit) in now.items() for t, price, edits in adds[s] if t in (0, 3))


def test_search_equals_a_table_on_long_conversations():
    rng = random.Random(4)
    for n in (50, 300, 5000):
        text, faults = "".join(rng.choice("uauauas ") for _ in range(n)), [rng.choice((0, 1, 2, 3, 3, 3, 3)) for _ in range(n)]
        assert conversations.cheapest_audit(text.encode(), bytes(faults)) == table_repair(text, faults)


def plain_conversations(rows):
    """Damage and repair of (conv_id, turn, role, text) rows by the contract, with the search above."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        read = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{read(conv)}:{read(turn)}".encode()) % 20
        role, text = read(role), read(text)
        made = groups[conv]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        if kind:
            made += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, made in groups.items():
        made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in made:
            last = text.rstrip(" \t\n\x0b\f\r")[-1:]
            faults.append(0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else 3)
            seen.add((role, text))
        initials = "".join((r[1][:1] if r[1][:1].isascii() else "") or "\0" for r in made)
        cost, audit = conversations.cheapest_audit(initials.encode("latin-1"), bytes(faults))
        kept, left, state = [], list(made), ""
        for edit in audit:
            put = "assistant" if state == "u" else "user"
            role, text = (None, None) if edit == "I" else left.pop(0)[1:]
            if edit != "D":
                kept.append((put, "") if edit == "I" else (put, text) if edit == "R" else (role, text))
                state = kept[-1][0][:1]
        turns = [t for t, *_ in made if t is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(0), faults.count(1), faults.count(2),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, H("\n".join(f"{r}:{t}" for r, t in kept)))
    return out


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def test_conversations_equal_plain_repair(spark):
    rng = random.Random(8)
    texts = ["Fine.", "Is it?", "cut off", "", None, " \n\t", "é!", "Fine.", "spaces after. \x0b", "non breaking "]
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "élan", "", None]), rng.choice(texts))
            for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(None, 1, "user", "Hello."), (None, None, "assistant", "Yes."), (99, None, "user", "a."), (99, None, "user", "b."), (99, 3, "assistant", "c.")]
    rows += [rows[0], rows[0], (100, -5, "user", "x."), (100, 2**62, "assistant", "y.")]
    rows += [(101, t, "user" if t % 2 else "assistant", "z" * 20 + ".") for t in range(400)]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], CONVERSATIONS + ", conv string, audit string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(df, edits=conversations.damage()).collect()}
    want = plain_conversations(rows)
    assert got == want
    gone = [(i, t, "user", "Gone.") for i in range(300, 400) for t in range(50) if zlib.crc32(f"{i}:{t}".encode()) % 20 == 0][:3]
    lost = conversations.repair(spark.createDataFrame(gone, CONVERSATIONS), edits=conversations.damage()).collect()
    assert {tuple(r)[1:] for r in lost} == {(0, 0, 0, 0, 0, 0, "", H(""))} and {r.conv_id for r in lost} == {g[0] for g in gone}
    assert conversations.repair(df.limit(0)).count() == 0
    clean = conversations.repair(spark.createDataFrame([(1, 0, "user", "A."), (1, 1, "assistant", "B.")], CONVERSATIONS)).first()
    assert clean.audit == "KK" and clean.repaired_sha256 == H("user:A.\nassistant:B.")


# n-gram Jaccard join ------------------------------------------------------------------------------------------

def plain_sets(rows, words_each=5):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[i:i + words_each]) for i in range(max(1, len(w) - words_each + 1))} if w else set())
    return out


def plain_join(rows, share=80):
    """{id: (size, component)} by comparing all pairs; rows have distinct ids."""
    sets = plain_sets(rows)
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j])]
    root = roots(len(rows), pairs)
    least = defaultdict(list)
    for r, (i, _) in zip(root, rows):
        least[r].append(i)
    return {i: (len(s), min(least[r])) for (i, _), s, r in zip(rows, sets, root)}


def family_rows(seed=3):
    """Near copies at many distances, long and short texts, exact copies, a passage that most share, texts below five words."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(60)]
    texts = ["", " \n", None, "one", "One", "one two three four", "one two three four five", "one two three four five six", "1 2 3 4 5 6 7"]
    for length, members in ((12, 15), (40, 30), (120, 60), (900, 12)):
        base = [word() for _ in range(length)]
        texts.append(" ".join(base))
        for m in range(members):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + length // 45)):
                copy[rng.randrange(length)] = word()
            texts.append(" ".join(copy).upper() if m % 9 == 0 else "\t".join(copy))
        texts += [" ".join(base)] * 5
    texts += [" ".join(passage + [word() for _ in range(rng.randint(5, 80))]) for _ in range(60)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("cell,counters", [(1 << 12, 1 << 16), (7, 16)])
def test_join_equals_all_pairs(spark, cell, counters):
    rows = family_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, n long").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, cell=cell, counters=counters).collect()}
    want = plain_join(rows)
    assert got == want
    assert max(sum(c == x for _, c in want.values()) for x in got) > 20


def test_sketch_blocks_keep_every_link():
    """Linked sets of any sizes share a block under a band that both send, whatever counts as frequent."""
    rng, bands = np.random.default_rng(1), ngram_join.Bands()
    for trial in range(300):
        n = int(rng.integers(5, 400))
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        most = bands.most(len(base))
        extra = np.unique(rng.integers(0, 1 << 63, rng.integers(0, most - len(base) + 1), dtype=np.uint64))
        other = np.unique(np.concatenate([base, extra]))
        drop = rng.integers(0, 1 + max(0, (100 * len(base) - 80 * len(other)) // 100))
        other = np.setdiff1d(other, rng.choice(base, drop, replace=False))
        union, both = len(np.union1d(base, other)), len(np.intersect1d(base, other))
        assert 100 * both >= 80 * union
        if np.array_equal(base, other):
            continue
        heavy = rng.choice(base, int(rng.integers(0, len(base) + 1)), replace=False)
        keys = []
        for s in (base, other):
            mine = set()
            for band in bands.sketches(len(s)):
                _, key = ngram_join.block_keys(s, ~np.isin(s, heavy), np.array([len(s)]), np.array([band]), np.array([bands.differing(band)]))
                mine |= set(key.tolist())
            keys.append(mine)
        assert keys[0] & keys[1]
        words = ngram_join.folded([ngram_join.dense_sketch(base), ngram_join.dense_sketch(other)])
        assert np.bitwise_count(words[0] ^ words[1]).sum() <= union - both


def test_frequent_summary_finds_what_is_frequent():
    rng = np.random.default_rng(0)
    summary, stream = ngram_join.Frequent(50), np.concatenate([np.repeat(np.arange(5, dtype=np.uint64), 900), rng.integers(100, 1 << 40, 40_000, dtype=np.uint64)])
    rng.shuffle(stream)
    for part in np.array_split(stream, 80):
        summary.add(part)
    summary.settle()
    assert len(summary.token) <= 50 and set(range(5)) <= set(summary.token.tolist()) and summary.count.max() <= 900


def test_join_edges(spark, edge):
    got = ngram_join.jaccard_components(edge)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == edge.count()
    assert got.where("doc_id IS NOT NULL AND component_id > doc_id").count() == 0
    assert got.where("n_shingles = 0 AND NOT component_id <=> doc_id").count() == 0
    assert ngram_join.jaccard_components(edge.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (5, "A b c d e f"), (None, "x y"), (5, "q r")], "doc_id long, text string")
    assert sorted(map(str, ngram_join.jaccard_components(nulls).collect())) == sorted(
        f"Row(doc_id={i}, n_shingles={n}, component_id={c})" for i, n, c in ((None, 2, 5), (5, 2, 5), (None, 1, None), (5, 1, 5)))
