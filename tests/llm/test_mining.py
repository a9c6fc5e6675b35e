"""Collocations, conversation repair and SuperMinHash groups against brute force, and on odd input."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.llm import collocations, repair, superminhash

TALK = "conv_id long, turn long, role string, text string"


def lowered(value):
    return re.sub("[A-Z]", lambda m: m.group().lower(), value or "")


# ---- collocations


def brute_collocations(rows, top, least):
    count, n = defaultdict(Counter), Counter()
    for _, words, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(words)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                count[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in count.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        wide = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    wide[p[i : i + size]] = max(wide[p[i : i + size]], a)
        kept = []
        for p, a in candidates.items():
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            if 100 * wide[p] < 80 * a:
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def spoken():
    draw = random.Random(5)
    words = [a + b for a in "ba Ke mi no".split() for b in "lan mer nos".split()]
    fixed = ["as far as we know", "once upon a time", "in spite of", "be that as it may now"]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(draw.randint(0, 25)):
            parts.append(draw.choice(fixed) if draw.random() < 0.3 else " ".join(draw.choices(words, k=draw.randint(1, 6))))
            parts.append(draw.choice([". ", ", ", " ", "\n", "\t", "; "]))
        rows.append((i, "".join(parts), ["en", "fr", None][i % 3]))
    return rows


@pytest.mark.parametrize("top,least,start,more", [(10, 3, 1, 2), (2000, 5, 4, 8)])
def test_collocations_equal_brute_force(documents, spoken, top, least, start, more):
    """Small ranks make the search lower its limits several times; the result must not depend on it."""
    got = collocations.collocations(documents(spoken), top, least, start, more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_collocations(spoken, top, least)


def test_long_text_is_counted_in_runs(documents, spoken, monkeypatch):
    whole = [(1, "\n".join(t for _, t, _ in spoken), "en"), (2, "x " * 50 + "one word. too", "en"), *spoken[:9]]
    monkeypatch.setattr(collocations.text, "GROUP_BYTES", 700)
    batch = documents(whole).select("lang", "text").toArrow().to_batches()[0]
    assert len(list(collocations._runs(batch.take([0])))) > 5
    assert sorted(map(tuple, collocations.collocations(documents(whole), 50, 3).collect())) == brute_collocations(whole, 50, 3)


def test_counts_are_merged_and_handed_on():
    held, total = collocations._Counts(), Counter()
    draw = np.random.default_rng(3)
    for _ in range(40):
        names = draw.integers(0, 300, 500).astype(np.uint64)
        held.add(names, names)
        total.update(names.tolist())
    name, n, other = held.drain()
    assert dict(zip(name.tolist(), n.tolist())) == total and (name == other).all() and held.rows == 0


def test_bloom_has_every_name(spark):
    names = spark.range(5000).select(F.xxhash64("id").alias("id"))
    ids = names.toArrow()["id"].to_numpy().view(np.uint64)
    bits = collocations._bloom(names)
    assert collocations._hits(bits, ids).all()
    other = spark.range(10_000, 30_000).select(F.xxhash64("id").alias("id")).toArrow()["id"].to_numpy().view(np.uint64)
    assert collocations._hits(bits, other).mean() < 0.05
    assert not collocations._hits(None, ids).any()


def test_collocations_of_odd_rows(documents, odd_rows):
    got = collocations.collocations(documents(odd_rows), 20, 2)
    assert sorted(map(tuple, got.collect())) == brute_collocations([(*r, None, None)[:3] for r in odd_rows], 20, 2)
    assert collocations.collocations(documents([])).count() == 0
    extra = documents(odd_rows).withColumns({c: F.lit(1) for c in ("id", "f", "prefix", "phrase", "new", "n", "rank")})
    assert sorted(map(tuple, collocations.collocations(extra, 20, 2).collect())) == sorted(map(tuple, got.collect()))


def test_score_beyond_64_bits(spark):
    big = spark.createDataFrame([(9 * 10**15, 9 * 10**15)], "f long, w long")
    assert big.select(collocations._ratio(F.col("f"), F.col("w").cast("decimal(20,0)") + F.col("w").cast("decimal(20,0)"))).first()[0] == 1_000_000


# ---- conversation repair


def damaged_rows(rows):
    """Rows after damage by conversation, in order."""
    out = defaultdict(list)
    for conv, turn, role, words in rows:
        out[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, words = (" " if x is None else x for x in (role, words))
        if kind == 0:
            continue
        words = "" if kind == 1 else re.sub("[.!?]", "", words) if kind == 2 else words
        out[conv] += [(turn, "user" if kind == 4 else role, words)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def faults_of(rows):
    seen, out = set(), []
    for _, role, words in rows:
        bare = words.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, words) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, words))
    return out


def brute_repair(rows):
    """Cheapest edits by a search over whole audits: all strings per (row, roles so far) state are kept apart by their texts."""
    faults = faults_of(rows)
    accepted = re.compile(r"(s?(ua)+)?")
    best = {("", ""): (0, ())}  # (audit, initials) -> cost, lines
    open_ = re.compile(r"s?(ua)*u?")
    inserts = lambda held: {
        (a + "I", i + r): (c + 5, (*lines, f"{name}:"))
        for (a, i), (c, lines) in held.items()
        for r, name in (("u", "user"), ("a", "assistant"))
        if open_.fullmatch(i + r)
    }
    for (_, role, words), fault in zip(rows, faults):
        for _ in range(2):
            best = inserts(best) | best
        after = {}
        for (a, i), (c, lines) in best.items():
            moves = [("D", "", 2, ())]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                moves += [("K", role[:1], extra, (f"{role}:{words}",))] if role[:1] else []
                moves += [("R", n[0], extra + 1, (f"{n}:{words}",)) for n in ("user", "assistant")]
            for e, r, cost, line in moves:
                if open_.fullmatch(i + r) and (a + e, i + r) not in after or after.get((a + e, i + r), (1e9,))[0] > c + cost:
                    if open_.fullmatch(i + r):
                        after[(a + e, i + r)] = (c + cost, (*lines, *line))
        best = after
    for _ in range(2):
        best = inserts(best) | best
    ended = [(c, a, lines) for (a, i), (c, lines) in best.items() if accepted.fullmatch(i)]
    cost, audit, lines = min(ended)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials)), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def talks():
    draw, rows = random.Random(11), []
    for conv in range(120):
        for turn in range(draw.randint(0, 5)):
            role = draw.choice(["user", "assistant", "assistant", "system", "user", "tool", "", None])
            words = draw.choice(["Yes.", "no", "Fine!", " ", None, "Is it?\n", "Yes.", "a b c.", "cut o"])
            rows.append((conv, draw.choice([turn, turn, turn, None, turn + 3]), role, words))
    return rows


@pytest.mark.parametrize("chunk", [4096, 1])
def test_repair_equals_brute_force(spark, talks, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(talks, TALK).repartition(7)).collect()}
    assert got == {c: brute_repair(rows) for c, rows in damaged_rows(talks).items()}


def test_one_conversation_over_many_slices(spark, monkeypatch):
    """A conversation that is most of the table leaves chunks in several slices; chunks of one size agree with another."""
    rows = [(1, t, ["user", "assistant", "tool"][t * 7 % 11 % 3], f"w{t % 5}" + "." * (t % 3 > 0)) for t in range(900)] + [(c, 0, "user", "x.") for c in range(2, 40)]
    table = spark.createDataFrame(rows, TALK).repartition(6)
    whole = sorted(map(tuple, repair.repair(table).collect()))
    monkeypatch.setattr(repair, "CHUNK_ROWS", 17)
    assert sorted(map(tuple, repair.repair(table).collect())) == whole
    expected = damaged_rows(rows)[1]
    edits = repair.Edits()
    chunk = repair.Chunk(1)
    for (turn, role, words), fault in zip(expected, faults_of(expected)):
        chunk.add(turn, role, words, ["", "blank", "duplicate", "truncated"].index(fault))
    cost, node, _ = repair._closed(edits, chunk.fronts(edits, [0])[0])
    assert dict((r[0], (r[6], r[7])) for r in whole)[1] == (cost, "".join(edits.spelled(node)))


def test_prefixes_compare_like_strings():
    draw = random.Random(2)
    edits, nodes = repair.Edits(), [0]
    for _ in range(400):
        nodes.append(edits.add(draw.choice(nodes[-6:]), draw.choice("DIKR")))
    for a, b in zip(draw.choices(nodes, k=600), draw.choices(nodes, k=600)):
        assert edits.less(a, b) == (edits.spelled(a) < edits.spelled(b))


def test_equal_hashes_are_verified(monkeypatch):
    """With one hash for all prefixes every comparison falls back on the prefixes themselves."""
    monkeypatch.setattr(repair.Edits, "_mixed", lambda self, before, edit: 1)
    test_prefixes_compare_like_strings()


def test_repair_of_odd_tables(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (7, 1, "user", "x" * 200_000 + "."), (7, 1, "user", "x" * 200_000 + "."), (7, 2, "assistant", "é!")]
    table = spark.createDataFrame(rows, TALK)
    want = sorted(((c, *brute_repair(r)) for c, r in damaged_rows(rows).items()), key=str)
    assert sorted(map(tuple, repair.repair(table).collect()), key=str) == want
    clashing = table.withColumns({c: F.lit(0) for c in ("_kind", "_conv", "copies", "place", "fault", "open", "cost")})
    assert sorted(map(tuple, repair.repair(clashing).collect()), key=str) == want
    assert repair.repair(spark.createDataFrame([], TALK)).count() == 0
    dropped = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    gone = repair.repair(spark.createDataFrame([(1, dropped, "user", "x.")], TALK)).first()
    assert tuple(gone) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# ---- SuperMinHash


def shingles(value, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(value))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_groups(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    root = list(range(len(rows)))
    for x, y in itertools.combinations(range(len(rows)), 2):
        (_, a), (_, b) = sets[x], sets[y]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            root = [root[x] if r == root[y] else r for r in root]
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(rows)) if root[j] == root[k] and sets[j][0] is not None]
        least = min(ids, default=None) if s else i
        out.append((i, len(s), least, least is None or i == least))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def near():
    draw, rows = random.Random(4), []
    words = [a + b for a in "ba ke mi no pu".split() for b in "lan mer nos pit".split()]
    for g in range(5):
        base = [draw.choice(words) + draw.choice(words) for _ in range(draw.choice([30, 90, 140]))]
        for c in range(9):
            w = base.copy()
            for _ in range(c):
                w[draw.randrange(len(w))] = f"n{draw.random()}"
            rows.append((100 * g + c, " ".join(w)))
            base = w if c % 3 == 2 else base  # chains: near the previous one, far from the first
    return rows + [(900, rows[0][1]), (901, rows[0][1].upper()), (902, "ab cd"), (903, "AB  cd"), (904, "ab cd ef")]


@pytest.mark.parametrize("block", [2048, 2])
def test_groups_equal_brute_force(documents, near, monkeypatch, block):
    monkeypatch.setattr(superminhash, "BLOCK_ROWS", block)
    got = sorted(map(tuple, superminhash.near_duplicates(documents(near)).collect()), key=str)
    assert got == brute_groups(near)


def test_groups_of_odd_rows(documents, odd_rows, near):
    rows = [*odd_rows, (70, near[0][1]), (70, near[9][1]), (None, near[0][1]), (71, near[9][1])]
    want = brute_groups(rows)
    assert sorted(map(tuple, superminhash.near_duplicates(documents(rows)).collect()), key=str) == want
    clashing = documents(rows).withColumns({c: F.lit(1) for c in ("id", "key", "node", "n", "kept", "component_id", "band")})
    assert sorted(map(tuple, superminhash.near_duplicates(clashing).collect()), key=str) == want
    assert superminhash.near_duplicates(documents([])).count() == 0


def test_signatures_estimate_similarity():
    """Slots agree at the rate of the similarity, with less spread than independent hashes on small sets."""
    draw, slots, found = np.random.default_rng(1), 64, []
    for _ in range(300):
        both = draw.integers(0, 1 << 62, 30).astype(np.uint64)
        one, two = np.unique(both[:24]), np.unique(both[6:])
        owner = np.repeat([0, 1], [len(one), len(two)])
        a, b = superminhash.super_minhash(np.concatenate([one, two]), owner, 2, slots)
        found.append((a == b).mean())
    assert abs(np.mean(found) - 18 / 30) < 0.02
    assert np.var(found) < 0.85 * 0.6 * 0.4 / slots


def test_signature_of_a_set_does_not_depend_on_its_neighbours():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 3, 40, 700, 5000)]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    together = superminhash.super_minhash(np.concatenate(sets), owner, len(sets), 100)
    for k, s in enumerate(sets):
        alone = superminhash.super_minhash(s, np.zeros(len(s), int), 1, 100)[0]
        assert (alone == together[k]).all() and len(np.unique(alone >> np.uint64(56))) >= 1


def test_forest_connects_what_all_pairs_connect():
    draw = np.random.default_rng(7)
    for trial in range(30):
        base = np.arange(40, dtype=np.uint64)
        sets = [np.unique(np.where(draw.random(40) < 0.08, draw.integers(50, 90, 40).astype(np.uint64), base)) for _ in range(14)]
        groups = draw.integers(0, 10, 14)
        side = draw.random(14) < 0.5 if trial % 2 else np.zeros(14, bool)
        pairs = [
            (i, j) for i, j in itertools.combinations(range(14), 2)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])) and (trial % 2 == 0 or side[i] != side[j])
        ]

        def parts(links):
            root = np.unique(groups, return_inverse=True)[1]
            for i, j in links:
                root = np.where(root == root[j], root[i], root)
            return [tuple(root == r) for r in root]

        links = superminhash._forest(sets, groups, side, 80)
        assert set(map(tuple, map(sorted, links))) <= set(pairs) and parts(links) == parts(pairs)
