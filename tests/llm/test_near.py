"""N-gram join, passages and decontamination against brute force, and on odd input."""

import random
import re

import numpy as np
import pytest

from lakerisk.llm import decontamination, ngram_join, passages
from lakerisk.llm.graph import components

WORDS = [a + b for a in "ba ke mi no pu ra se ti vo zu".split() for b in "lan mer nos pit dal gru".split()]


def prose(seed, n):
    draw = random.Random(seed)
    return [draw.choice(WORDS) + draw.choice(WORDS) for _ in range(n)]


def words_of(value):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), value or ""))


def grams(value, n=5):
    w = words_of(value)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.fixture(scope="module")
def near_rows():
    rows = []
    for g in range(6):
        base = prose(g, 120)
        for c in range(6):
            w = base.copy()
            for k in range(c):
                w[(17 * k + 5 * c) % 120] = f"new{g}{c}{k}"
            rows.append((100 * g + c, " ".join(w)))
    rows += [(900, rows[0][1]), (901, rows[0][1].upper()), (902, "ab cd"), (903, "ab cd"), (904, "ab cd ef")]
    return rows


def brute_links(rows):
    sets = {i: grams(t) for i, t in rows}
    return {(i, j) for i in sets for j in sets if i != j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}


def test_join_equals_brute_force(documents, near_rows):
    links = brute_links(near_rows)
    parent = {i: i for i, _ in near_rows}
    for _ in parent:
        for i, j in links:
            parent[i] = parent[j] = min(parent[i], parent[j])
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in ngram_join.jaccard_join(documents(near_rows)).collect()}
    assert got == {i: (parent[i], sum(a == i for a, _ in links)) for i, _ in near_rows}


def test_blocks_of_one_component_add_up(documents, near_rows, monkeypatch):
    whole = sorted(map(tuple, ngram_join.jaccard_join(documents(near_rows)).collect()))
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 2)
    assert sorted(map(tuple, ngram_join.jaccard_join(documents(near_rows)).collect())) == whole


def test_join_on_odd_rows_and_empty_table(documents, odd_rows):
    docs = documents(odd_rows)
    got = ngram_join.jaccard_join(docs).collect()
    assert len(got) == len(odd_rows)
    assert {(r["class_id"], r["n_links"]) for r in got if r["id"] == 5} == {(5, 1)}
    kept = ngram_join.keep_one(docs, ngram_join.jaccard_join(docs))
    assert kept.columns == docs.columns and kept.count() == len(odd_rows) - 1
    assert ngram_join.jaccard_join(documents([])).count() == 0


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= ngram_join.MAX_HASHES


def test_overlaps_equal_set_sizes():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 300, draw.integers(1, 200))).astype(np.uint64) for _ in range(30)]
    got = ngram_join._overlaps(sets[:12], sets[12:])
    assert (got == [[len(np.intersect1d(x, y)) for y in sets[12:]] for x in sets[:12]]).all()


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, k) for k in range(1001, 1040)] + [(7000, 7000), (8001, 8000)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[k] == 1000 for k in range(1000, 1040)) and got[8001] == 8000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def passage_rows():
    shared, other = prose(50, 80), prose(51, 60)
    fuzzy = shared.copy()
    fuzzy[20], fuzzy[45] = "changed", "changed"
    del fuzzy[60]
    return [
        (1, " ".join(prose(1, 40) + shared + prose(2, 30))), (2, " ".join(prose(3, 25) + shared)), (3, " ".join(fuzzy + prose(4, 40))),
        (4, " ".join(prose(5, 200))), (5, " ".join(prose(6, 60) + other[:45] + prose(7, 60))), (6, " ".join(other + prose(8, 10))),
        (7, "\n".join(shared)), (8, " ".join(["same"] * 200)), (9, " ".join(["same"] * 200)),
    ]


def test_passages_are_found_whole(documents, passage_rows):
    got = {(r["id"], r["other"]): r for r in passages.repeated_passages(documents(passage_rows)).collect()}
    assert set(got) == {(2, 1), (3, 1), (7, 1)}
    assert (got[2, 1]["start"], got[2, 1]["n_words"], got[2, 1]["edits"]) == (25, 80, 0)
    assert (got[7, 1]["start"], got[7, 1]["n_words"]) == (0, 80)
    assert got[3, 1]["start"] == 0 and got[3, 1]["n_words"] == 79 and got[3, 1]["edits"] == 3


def covered(found, ident):
    return {k for r in found if r["id"] == ident for k in range(r["start"], r["start"] + r["n_words"])}


def test_passages_whose_parts_stand_in_earlier_documents(documents):
    one, two = prose(60, 40), prose(61, 40)
    rows = [(1, " ".join(prose(62, 30) + one)), (2, " ".join(two + prose(63, 30))), (3, " ".join(prose(64, 20) + one + two)), (4, " ".join(one + two + prose(65, 20)))]
    found = passages.repeated_passages(documents(rows)).collect()
    assert covered(found, 4) == set(range(80)) and {(r["id"], r["other"]) for r in found} == {(4, 3)}


def test_passages_that_cycle(documents):
    for period in (2, 3, 7, 40):
        cycle = prose(66, period) * 120
        rows = [(1, " ".join(prose(67, 9) + cycle[:200])), (2, " ".join(prose(68, 5) + cycle[1:160] + prose(69, 60)))]
        found = passages.repeated_passages(documents(rows)).collect()
        assert covered(found, 2) >= set(range(5, 164)), period


def test_edited_passages_are_found(documents):
    rows, wanted = [], set()
    for k, every in enumerate((6, 7, 8, 10, 12) * 4):
        base, draw = prose(100 + k, 62), random.Random(k)
        edited = base.copy()
        for at in range(60 - every // 2, 0, -every):  # similar to at least 5 words in 6
            edited[at : at + 1] = {"s": [f"n{k}x{at}"], "d": [], "i": [base[at], f"n{k}x{at}"]}["s" if k < 10 else draw.choice("sdi")]
        rows += [(2 * k + 1, " ".join(prose(200 + k, 40) + base + prose(300 + k, 40))), (2 * k + 2, " ".join(prose(400 + k, 40) + edited + prose(500 + k, 40)))]
        wanted.add((2 * k + 2, 2 * k + 1))
    got = {(r["id"], r["other"]) for r in passages.repeated_passages(documents(rows)).collect()}
    assert got <= wanted and len(got) >= 19


def test_edited_passages_whose_parts_stand_in_earlier_documents(documents):
    rows, wanted = [], set()
    for k in range(12):
        one, two, draw = prose(900 + k, 32), prose(930 + k, 32), random.Random(k)
        edited = [f"n{k}x{i}" if i % 9 == draw.randrange(9) else w for i, w in enumerate(one + two)]
        texts = [prose(960 + k, 30) + one, two + prose(990 + k, 30), prose(1020 + k, 20) + one + two, edited + prose(1050 + k, 20)]
        rows += [(4 * k + i, " ".join(words)) for i, words in enumerate(texts)]
        wanted.add((4 * k + 3, 4 * k + 2))
    got = {(r["id"], r["other"]) for r in passages.repeated_passages(documents(rows)).collect()}
    assert got == wanted


def test_extensions_side_by_side_equal_those_of_one_pair():
    draw = np.random.default_rng(8)
    pairs = []
    for _ in range(300):
        x = draw.integers(0, 40, draw.integers(0, 70)).astype(np.uint64)
        y = np.delete(x, draw.integers(0, max(len(x), 1), 4) % max(len(x), 1)) if len(x) else x
        y = np.where(draw.random(len(y)) < draw.random() / 3, 99, y).astype(np.uint64)
        pairs.append((x, np.concatenate([y, draw.integers(0, 40, draw.integers(0, 30)).astype(np.uint64)])))
    for cost in (2, 3):
        assert passages._extents([x for x, _ in pairs], [y for _, y in pairs], cost) == [passages._extent(x, y, cost) for x, y in pairs]


def test_minimisers_of_many_texts_equal_those_of_each():
    draw = np.random.default_rng(9)
    texts = [draw.integers(0, 3 if k % 2 else 1 << 60, n).astype(np.uint64) for k, n in enumerate((60, 39, 0, 41, 40, 200, 3, 90))]
    texts[0][-5:] = texts[3][:5] = 7
    places = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    grams, at = passages.text_minimisers(np.concatenate(texts), places)
    want = [p + i for p, x in zip(places, texts) if len(x) >= 40 for i in passages.minimisers(passages.text.gram_hashes(x, 4)).tolist()]
    assert at.tolist() == want


def test_first_holders_of_seeds_over_many_batches():
    draw = random.Random(2)
    rows = sorted((draw.randrange(25) ** 2, draw.randrange(6), k) for k in range(200))
    for size in (1, 3, 50, 200):
        batches = [passages.pa.RecordBatch.from_pylist([dict(zip(("seed", "id", "at"), r)) for r in rows[i : i + size]]) for i in range(0, 200, size)]
        got = sorted(tuple(r.values()) for b in passages._met(iter(batches)) for r in b.to_pylist())
        held = {s: [r[1:] for r in rows if r[0] == s] for s, _, _ in rows}
        assert got == sorted((s, i, k, *held[s][0]) for s, i, k in rows if len({x for x, _ in held[s]}) > 1)


def test_a_chance_seed_beside_a_passage_does_not_spoil_it():
    draw = np.random.default_rng(6)
    x, y = (draw.integers(0, 1 << 60, 160).astype(np.uint64) for _ in range(2))
    y[30:85], y[115:119] = x[30:85], x[115:119]
    places = np.array([*range(30, 82, 3), 115])
    assert passages.align(x, 0, y, 0, places, places) == [(30, 55, 30, 55, 0)]


def test_runs_left_out_stand_in_no_other_document():
    draw = np.random.default_rng(4)
    for n in (50, 51, 70):
        for _ in range(40):
            texts = [draw.integers(0, 1 << 60, 150).astype(np.uint64) for _ in range(2)]
            texts[1][30 : 30 + n] = texts[0][60 : 60 + n]
            grams = [passages.text.gram_hashes(x, passages.SEED_WORDS) for x in texts]
            chosen = [passages.minimisers(g) for g in grams]
            shared = [c[np.isin(g[c], h[d])] for g, c, h, d in zip(grams, chosen, grams[::-1], chosen[::-1])]
            (x, _), (y, at) = (passages.whole_runs(t, s) for t, s in zip(texts, shared))
            assert at[np.isin(y, x)].tolist() == list(range(30, 30 + n - 49))


def test_repeats_are_cut_from_later_documents(documents, passage_rows):
    docs = documents(passage_rows)
    left = {r["doc_id"]: r for r in passages.remove_repeats(docs, passages.repeated_passages(docs)).collect()}
    assert set(left) == {1, 2, 3, 4, 5, 6, 8, 9}
    assert left[1]["text"] == passage_rows[0][1]
    assert left[2]["text"] == " ".join(prose(3, 25)) and left[2]["n_chars"] == len(left[2]["text"])
    assert left[3]["text"] == " ".join(prose(4, 40))


def test_chain_equals_quadratic_search():
    draw = random.Random(3)
    for _ in range(30):
        n = draw.randrange(2, 25)
        b, a = np.array([draw.randrange(60) for _ in range(n)]), np.array([draw.randrange(60) for _ in range(n)])
        order, score = sorted(range(n), key=lambda i: (b[i], -a[i])), {}
        for i in order:
            ahead = [score[j] - passages.GAP_COST * (b[i] - b[j] + a[i] - a[j]) for j in score if b[j] < b[i] and a[j] < a[i]]
            score[i] = passages.SEED_WORDS + max([0.0, *ahead])
        members = passages.chain(b, a)
        assert sorted(np.concatenate(members).tolist()) == list(range(n))
        for m in members:
            assert (np.diff(b[m]) > 0).all() and (np.diff(a[m]) > 0).all()
        top = max(members, key=lambda m: len(m) * passages.SEED_WORDS)
        assert len(top) * passages.SEED_WORDS >= 0.5 * max(score.values())


def test_minimisers_leave_no_window_empty():
    draw = np.random.default_rng(0)
    for n in (1, 5, 16, 17, 300):
        values = draw.integers(0, 1 << 60, n).astype(np.uint64)
        chosen, width = passages.minimisers(values), min(passages.WINDOW, n)
        want = {int(i + values[i : i + width].argmin()) for i in range(n - width + 1)}
        assert set(chosen.tolist()) == want


def test_passages_on_odd_rows_and_empty_table(documents, odd_rows):
    docs = documents(odd_rows)
    found = passages.repeated_passages(docs)
    assert found.count() == 0
    left = passages.remove_repeats(docs, found)
    assert left.columns == docs.columns and left.count() == len(odd_rows)
    assert passages.repeated_passages(documents([])).count() == 0


def test_cut_keeps_the_rest():
    assert passages.cut("a b\nc  d e", [(1, 3)]) == "a\nd e"
    assert passages.cut(" a b ", [(0, 2)]) == ""
    assert passages.cut("é b c", [(2, 9)]) == "é b"


ITEM = "The quick brown fox jumps over the lazy dog while seven wizards boil fresh parsnips and count the silver coins twice"


def edit_distance_in(piece, value):
    row = [0] * (len(value) + 1)
    for i, p in enumerate(piece):
        new = [i + 1]
        for j, c in enumerate(value):
            new.append(min(row[j] + (p != c), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def plain(value):
    return re.sub(r"[^0-9a-zé]+", " ", (value or "").lower()).strip()


def test_decontamination_equals_brute_force(spark, documents):
    draw = random.Random(5)
    rows = [(0, ITEM), (1, None), (2, ""), (3, "before " + ITEM.upper() + "! after"), (4, ITEM.replace(" ", " -- ")), (5, " ".join(prose(1, 300)))]
    for k in range(40):
        value = list(ITEM)
        for _ in range(draw.randrange(14)):
            at = draw.randrange(len(value))
            value[at : at + 1] = draw.choice(["", "q", value[at] + "z"])
        rows.append((10 + k, " ".join(prose(k, 20)) + " " + "".join(value) + " " + " ".join(prose(k + 99, 20))))
    items = [(1, ITEM), (2, None), (3, "too short"), (4, " ".join(prose(77, 30)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.passages(documents(rows), benchmark).collect()}
    budget = int(len(plain(ITEM)) * decontamination.EDIT_RATE)
    distance = {i: edit_distance_in(plain(ITEM), plain(t)) for i, t in rows}
    assert set(got) == {(i, 1) for i, d in distance.items() if d <= budget}
    assert all(r["edits"] == distance[i] for (i, _), r in got.items())
    r = got[3, 1]
    assert rows[3][1][r["start"] : r["end"]] == ITEM.upper()
    kept = decontamination.decontaminate(documents(rows), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in got}


def test_decontamination_on_odd_rows_and_blocks(spark, documents, odd_rows, monkeypatch):
    docs, none = documents(odd_rows), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.passages(docs, none).count() == 0
    assert decontamination.decontaminate(docs, none).count() == len(odd_rows)
    monkeypatch.setattr(decontamination, "BLOCK_CHARACTERS", 10)
    two = spark.createDataFrame([(1, ITEM), (2, ITEM[::-1])], "item_id long, text string")
    found = decontamination.passages(documents([(1, ITEM), (2, ITEM[::-1]), *odd_rows[2:]]), two)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (2, 2)}
