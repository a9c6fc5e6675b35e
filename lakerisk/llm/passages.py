"""Operator 10, substring dedup: collinear chains of shared k-mer seeds, aligned.

Seeds are window minimisers of word 4-grams, so every exact run of 7 words holds one. Each seed
points to its first occurrence in the corpus (smallest document id); an occurrence elsewhere is a
match with that document, so a passage held by very many documents gives one match per
occurrence and no pairs. The matches of two documents are chained by a Fenwick tree with linear
gap costs, cut at wide gaps, freed of links that cost more edits than they win words, and
extended with gaps at the ends. A passage of at
least `LEAST_WORDS` words and `LEAST_SIMILARITY` counts as repeated from the first document.

The seeds of one passage can have different first documents, none of which holds it whole, and a
passage that cycles gives them places out of order. So every run of exactly `LEAST_WORDS` words
is looked up as well, and points to the first document that holds all of it. A run held twice
has only shared seeds away from its edges; runs with another seed there are left out beforehand,
which loses none.

An edited passage has no run of that length. Where two near seeds of a document do not stand near
each other in the first document of both, the two count as one seed with a first document of its own
(a crossing), and links from crossings outside the passages found so far are aligned in a second round.

Defined cases: null, empty and short texts hold no passage; rows that share an id are one
document; rows without id are ignored; repeats inside a document do not count, nor does a run of
one repeated word, which has no inner order to chain; an empty table
gives an empty result; `remove_repeats` keeps all columns and drops a text only when
no word is left of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import text
from lakerisk.session import drop_staged, stage_table

SEED_WORDS = 4
WINDOW = 4
LEAST_WORDS = 50
LEAST_SIMILARITY = 0.8
GAP_COST = 0.05
WIDEST_GAP = 32
FLANK = 64
EDIT, DROP = 3, 12
# Shared seeds ahead that a seed is crossed with.
REACH = 4
# Extensions up to this many words are taken side by side, this many at a time.
WIDE, EXTENTS = 2 * FLANK, 2048
# Bytes of a word's hash that are stored for the alignment of two texts.
WORD_BYTES = 6


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` over every window of `width` entries, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def minimisers(grams: np.ndarray) -> np.ndarray:
    """Places of the n-grams that are smallest in some window."""
    width = min(WINDOW, len(grams))
    if not width:
        return np.zeros(0, np.int64)
    lowest = _slide(grams, width, np.minimum)
    # The largest of the minima of all windows over a place equals its own value if it was one.
    zero = np.zeros(width - 1, np.uint64)
    reach = _slide(np.concatenate([zero, lowest, zero]), width, np.maximum)
    chosen = reach == grams
    chosen[1:] &= grams[1:] != grams[:-1]
    return np.flatnonzero(chosen)


def run_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of every run of `LEAST_WORDS` words, from runs of 1, 2, 4 and so on."""
    if len(words) < LEAST_WORDS:
        return np.zeros(0, np.uint64)
    base, piece, size = 0x9E3779B97F4A7C15, text.mix(words), 1
    total, done, left = np.zeros(len(words) + 1, np.uint64), 0, LEAST_WORDS
    while left:
        if left & 1:  # the runs of `done` words, followed by the pieces of `size`
            n = len(words) - done - size + 1
            total, done = total[:n] * np.uint64(pow(base, size, 1 << 64)) + piece[done : done + n], done + size
        left >>= 1
        if left:
            piece, size = piece[:-size] * np.uint64(pow(base, size, 1 << 64)) + piece[size:], 2 * size
    return text.mix(total)


def whole_runs(words: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the runs of `LEAST_WORDS` words that may stand in another document.

    `shared` are the places of seeds that another document has. Seeds at least a window away from the
    edges of a run depend on the run alone, so all of them are shared if the run is.
    """
    hashes = run_hashes(words)
    lone = np.zeros(len(words) + 1, np.int64)
    lone[np.setdiff1d(minimisers(text.gram_hashes(words, SEED_WORDS)), shared) + 1] = 1
    lone = np.cumsum(lone)
    change = np.concatenate([[0], np.cumsum(words[1:] != words[:-1])])
    at = np.arange(len(hashes))
    inner = lone[at + LEAST_WORDS - SEED_WORDS - WINDOW + 2] - lone[at + WINDOW - 1]
    at = at[(inner == 0) & (change[at + LEAST_WORDS - 1] > change[at])]
    return hashes[at], at


def text_minimisers(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes and the places of the minimisers of texts whose words follow each other.

    Text i has the words from places[i] to places[i + 1]; no window goes beyond its text, and texts
    too short for a passage have none.
    """
    grams = text.gram_hashes(words, SEED_WORDS)
    if len(grams) < WINDOW:
        return grams, np.zeros(0, np.int64)
    long = np.diff(places) >= LEAST_WORDS * LEAST_SIMILARITY
    begins, ends = places[:-1][long], places[1:][long] - (SEED_WORDS + WINDOW - 2)
    edge = np.bincount(begins, minlength=len(words) + 1) - np.bincount(ends, minlength=len(words) + 1)
    lowest = _slide(grams, WINDOW, np.minimum)
    lowest[np.cumsum(edge)[: len(lowest)] == 0] = 0
    zero = np.zeros(WINDOW - 1, np.uint64)
    reach = _slide(np.concatenate([zero, lowest, zero]), WINDOW, np.maximum)
    chosen = (reach == grams) & (reach > 0)
    again = np.concatenate([[False], grams[1:] == grams[:-1]])
    again[begins] = False
    return grams, np.flatnonzero(chosen & ~again)


def seeds(docs: DataFrame) -> DataFrame:
    """(seed, id, at): the minimisers of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole):
                words, _, _, places = text.word_hashes(*_lowered(batch))
                grams, at = text_minimisers(words, places)
                owner = np.searchsorted(places, at, "right") - 1
                columns = [grams[at].view(np.int64), batch.column("id").to_numpy()[owner], (at - places[owner]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seed", "id", "at"])

    return _identified(docs).mapInArrow(run, "seed long, id long, at int")


def _lowered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text.buffers(batch.column("text"))
    return text.lower(data), offsets


def _identified(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")


def chain(b: np.ndarray, a: np.ndarray) -> list[np.ndarray]:
    """Best collinear chains of matches (b, a), as index lists; every match is in one at most.

    With a linear gap cost the best predecessor maximises score + cost * (b + a) among matches
    before it in both texts: a prefix maximum, kept in a Fenwick tree over the order of a.
    """
    order = np.lexsort((-a, b))
    ranks = np.searchsorted(np.unique(a), a) + 1
    size = int(ranks.max()) + 1
    best: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)
    score, before = np.zeros(len(b)), np.full(len(b), -1)
    for i in order.tolist():
        lead, k, top = GAP_COST * (b[i] + a[i]), int(ranks[i]) - 1, (-np.inf, -1)
        while k > 0:
            top = max(top, best[k])
            k -= k & -k
        joined = top[0] - lead
        score[i] = SEED_WORDS + max(0.0, joined)
        before[i] = top[1] if joined > 0 else -1
        entry, k = (score[i] + lead, i), int(ranks[i])
        while k <= size:
            best[k] = max(best[k], entry)
            k += k & -k
    used, chains = np.zeros(len(b), dtype=bool), []
    for i in np.argsort(-score, kind="stable").tolist():
        members = []
        while i >= 0 and not used[i]:
            used[i] = True
            members.append(i)
            i = int(before[i])
        if members:
            members = np.array(members[::-1])
            wide = (np.diff(b[members]) > WIDEST_GAP) | (np.diff(a[members]) > WIDEST_GAP)
            chains += np.split(members, np.flatnonzero(wide) + 1)
    return chains


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, other, b, a): the chains of two or more places that each document has with one other."""
    for batch in batches:
        column = batch.column("shared")
        held, row = column.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
        b, other, a = (held.field(c).to_numpy().astype(np.int64) for c in ("at", "other", "other_at"))
        ids = batch.column("id").to_numpy()[row]
        order = np.lexsort((a, b, other, row))
        order = order[ids[order] != other[order]]
        row, ids, other, b, a = (c[order] for c in (row, ids, other, b, a))
        if not len(b):
            continue
        joined = (row[1:] == row[:-1]) & (other[1:] == other[:-1])
        fresh = np.concatenate([[True], ~(joined & (b[1:] == b[:-1]) & (a[1:] == a[:-1]))])
        first = np.concatenate([[True], ~joined])[fresh]
        ids, other, b, a = (c[fresh] for c in (ids, other, b, a))
        begins = np.flatnonzero(first)
        sizes = np.diff(np.append(begins, len(b)))
        steps = first[1:] | (np.diff(b) > 0) & (np.diff(a) > 0) & (np.diff(b) <= WIDEST_GAP) & (np.diff(a) <= WIDEST_GAP)
        # Places that ascend by narrow steps are one chain; two that do not are none.
        straight = np.bincount((np.cumsum(first) - 1)[1:][~steps], minlength=len(begins)) == 0
        whole = straight & (sizes > 1)
        taken = np.repeat(whole, sizes)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes[whole])]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c[taken].astype(np.int32))) for c in (b, a)]
        yield pa.RecordBatch.from_arrays([pa.array(ids[begins[whole]]), pa.array(other[begins[whole]]), *lists], names=["id", "other", "b", "a"])
        out: list[tuple] = []
        for i in np.flatnonzero(~straight & (sizes > 2)).tolist():
            k = begins[i]
            x, y = b[k : k + sizes[i]], a[k : k + sizes[i]]
            for members in chain(x, y):
                if len(members) > 1:
                    out.append((ids[k], other[k], x[members].tolist(), y[members].tolist()))
        columns = list(zip(*out)) if out else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "other", "b", "a"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the asked piece of each text, or its whole runs where `held` lists its shared
    seeds; rows of one text (`row`) follow each other."""
    for whole in batches:
        for batch in text.groups(whole):
            row = batch.column("row").to_numpy()
            first = np.concatenate([[True], row[1:] != row[:-1]])
            words, _, _, places = text.word_hashes(*_lowered(batch.filter(pa.array(first))))
            owner = np.cumsum(first) - 1
            asked = batch.column("held").is_null().to_numpy(zero_copy_only=False)
            low, high = (np.minimum(places[owner] + batch.column(c).to_numpy(), places[owner + 1])[asked] for c in ("low", "high"))
            ends = np.concatenate([[0], np.cumsum(high - low)])
            taken = words[np.arange(ends[-1]) + np.repeat(low - ends[:-1], high - low)]
            short = np.ascontiguousarray(taken.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES])
            held = [pa.py_buffer((WORD_BYTES * ends).astype(np.int32).tobytes()), pa.py_buffer(short.tobytes())]
            yield _keyed(batch.filter(pa.array(asked)), pa.Array.from_buffers(pa.binary(), len(low), [None, *held]))
            if not asked.all():
                batch, owner = batch.filter(pa.array(~asked)), owner[~asked]
                column = batch.column("held")
                hashes, at = whole_runs(words, column.flatten().to_numpy() + np.repeat(places[owner], np.diff(column.offsets.to_numpy())))
                within = np.searchsorted(places, at, "right") - 1
                inside = at + LEAST_WORDS <= places[within + 1]
                hashes, at, within = hashes[inside], (at - places[within])[inside].astype(np.int32), within[inside]
                ranges = zip(np.searchsorted(within, owner).tolist(), np.searchsorted(within, owner, "right").tolist())
                yield _keyed(batch, pa.array([hashes[x:y].tobytes() + at[x:y].tobytes() for x, y in ranges], pa.binary()))


def _keyed(batch: pa.RecordBatch, words: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("link", "side", "low")), words], names=["link", "side", "low", "words"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ident, packed in zip(batch.column("link").to_pylist(), batch.column("words").to_pylist()):
            if n := len(packed) // 12:
                columns = [np.frombuffer(packed, np.int64, n), np.full(n, ident), np.frombuffer(packed, np.int32, n, 8 * n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seed", "id", "at"])


def joined_runs(b: np.ndarray, a: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, other start, length) of joined runs at b here and at a there; of those that overlap, enough to cover the same words."""
    order = np.lexsort((a, b))
    b, a = b[order], a[order]
    first = np.concatenate([[0], np.flatnonzero((np.diff(b) != 1) | (np.diff(a) != 1)) + 1])
    last = np.append(first[1:], len(b)) - 1
    out: list[tuple[int, int, int]] = []
    reached, best = -1, None
    for start, other, end in zip(b[first].tolist(), a[first].tolist(), (b[last] + LEAST_WORDS).tolist()):
        if best and start > reached:  # the farthest of those that begin within what is covered
            out.append(best)
            reached, best = best[0] + best[2], None
        if end > reached and (best is None or end > best[0] + best[2]):
            best = (start, other, end - start)
    return [*out, best] if best else out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "start", "n_words", "other", "other_start", "other_words", "edits"]
    for batch in batches:
        out = []
        for ident, other, b, a in zip(*(batch.column(c).to_pylist() for c in ("id", "other", "b", "a"))):
            out += [(ident, s, n, other, t, n, 0) for s, t, n in joined_runs(np.array(b), np.array(a))]
        columns = list(zip(*out)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _extent(x: np.ndarray, y: np.ndarray, cost: float = EDIT) -> tuple[int, int, int]:
    """How far an extension with gaps goes in both, and its edits: the best place before the score drops."""
    n = min(len(x), len(y))
    differs = np.flatnonzero(x[:n] != y[:n])
    n = int(differs[0]) if len(differs) else n
    x, y = x[n:], y[n:]
    lane = np.arange(len(y) + 1)
    row, best, reached = lane, 0.0, (n, n, 0)
    for i, word in enumerate(x):
        row = _next_row(row, word, y, lane)
        score = (i + 1 + lane) / 2 - cost * row
        k = int(score.argmax())
        if score[k] > best:
            best, reached = score[k], (n + i + 1, n + k, int(row[k]))
        elif score[k] < best - DROP:
            break
    return reached


def _extents(x: list[np.ndarray], y: list[np.ndarray], cost: int) -> list[tuple[int, int, int]]:
    """`_extent` of many pairs; the tables of usual ones are filled side by side."""
    out: list = [None] * len(x)
    usual = []
    for i, (v, w) in enumerate(zip(x, y)):
        if max(len(v), len(w)) > WIDE:
            out[i] = _extent(v, w, cost)
        else:
            usual.append(i)
    usual.sort(key=lambda i: len(y[i]))
    for at in range(0, len(usual), EXTENTS):
        some = usual[at : at + EXTENTS]
        for i, found in zip(some, _side_by_side([x[i] for i in some], [y[i] for i in some], cost)):
            out[i] = found
    return out


def _padded(values: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(v) for v in values])
    table = np.zeros((len(values), width), np.uint64)
    table[np.arange(width) < sizes[:, None]] = np.concatenate(values)
    return table, sizes


def _side_by_side(x: list[np.ndarray], y: list[np.ndarray], cost: int) -> list[tuple[int, int, int]]:
    width = max(max(map(len, x)), max(map(len, y)))
    (x, nx), (y, ny) = _padded(x, width), _padded(y, width)
    lane = np.arange(width + 1)
    differs = np.column_stack([x != y, np.ones(len(x), bool)]) | (lane >= np.minimum(nx, ny)[:, None])
    same = differs.argmax(axis=1)
    shifted = np.minimum(lane[:-1] + same[:, None], width - 1)
    x, y, nx, ny = np.take_along_axis(x, shifted, 1), np.take_along_axis(y, shifted, 1), nx - same, ny - same
    reached = np.column_stack([same, same, np.zeros_like(same)])
    best, lane = np.zeros(len(x), np.int16), lane.astype(np.int16)
    live = np.flatnonzero(nx > 0)
    x, y = x[live], y[live]
    # Scores are doubled, which keeps them whole.
    row = np.repeat(lane[None], len(live), axis=0)
    outside = np.where(lane > ny[live, None], np.int16(1 << 14), np.int16(0))
    for i in range(width):
        if not len(live):
            break
        step = np.empty_like(row)
        step[:, 0] = row[:, 0] + 1
        np.minimum(row[:, :-1] + (y != x[:, i, None]), row[:, 1:] + 1, out=step[:, 1:])
        row = np.minimum.accumulate(step - lane, axis=1) + lane
        score = lane + (i + 1) - 2 * cost * row - outside
        k = score.argmax(axis=1)
        at = np.arange(len(live))
        top = score[at, k]
        more = top > best[live]
        to = live[more]
        best[to] = top[more]
        reached[to] = np.column_stack([same[to] + i + 1, same[to] + k[more], row[at, k][more]])
        stays = (more | (top >= best[live] - 2 * DROP)) & (nx[live] > i + 1)
        if not stays.all():
            live, row, outside, x, y = live[stays], row[stays], outside[stays], x[stays], y[stays]
    return list(map(tuple, reached.tolist()))


def _next_row(row: np.ndarray, word: np.uint64, y: np.ndarray, lane: np.ndarray) -> np.ndarray:
    """The next row of the table of edit distances, one more word on its side."""
    step = np.empty_like(row)
    step[0] = row[0] + 1
    step[1:] = np.minimum(row[:-1] + (y != word), row[1:] + 1)
    return np.minimum.accumulate(step - lane) + lane


def _edits(x: np.ndarray, y: np.ndarray) -> int:
    """Edit distance of two short word runs (a gap between seeds)."""
    if not len(x) or not len(y):
        return max(len(x), len(y))
    if len(x) == len(y) and (x == y).all():
        return 0
    lane = np.arange(len(y) + 1)
    row = lane
    for word in x:
        row = _next_row(row, word, y, lane)
    return int(row[-1])


def align(b_words: np.ndarray, b_low: int, a_words: np.ndarray, a_low: int, b: np.ndarray, a: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(start, length, other start, other length, edits) of the passages around a chain."""
    found = _extended([(b_words, a_words, *part) for part in _parts(b_words, a_words, (b - b_low).tolist(), (a - a_low).tolist())])
    return [(start + b_low, n, other + a_low, m, edits) for start, n, other, m, edits in found]


def _parts(b_words: np.ndarray, a_words: np.ndarray, b: list[int], a: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(b, a, end of b, end of a, edits) of the parts of a chain that win words."""
    first, reached, links = [0], (b[0] + SEED_WORDS, a[0] + SEED_WORDS), [(0.0, 0)]
    for k in range(1, len(b)):
        skip = max(0, reached[0] - b[k], reached[1] - a[k])  # seeds may overlap
        if skip < SEED_WORDS:
            x, y = b_words[reached[0] : b[k] + skip], a_words[reached[1] : a[k] + skip]
            gained = (b[k] - reached[0] + a[k] - reached[1]) / 2 + SEED_WORDS
            if len(b) == 2 and gained <= EDIT * (max(len(x), len(y)) - len(set(x.tolist()) & set(y.tolist())) - _repeats(x)):
                return []  # even if all words of both were in the same order
            edits = _edits(x, y)
            links.append((gained - EDIT * edits, edits))
            first.append(k)
            reached = (b[k] + SEED_WORDS, a[k] + SEED_WORDS)
    return [(b[first[i]], a[first[i]], b[first[j]] + SEED_WORDS, a[first[j]] + SEED_WORDS, sum(e for _, e in links[i + 1 : j + 1]))
            for i, j in _best_parts([w for w, _ in links], 0, len(links))]


def _repeats(x: np.ndarray) -> int:
    return len(x) - len(set(x.tolist()))


def _best_parts(weights: list[float], low: int, high: int) -> list[tuple[int, int]]:
    """First and last seed of the part that wins most, and likewise of what is left on both sides."""
    out, asked = [], [(low, high)]
    while asked:
        low, high = asked.pop()
        best, part, total, since = 0.0, (low, low), 0.0, low
        for k in range(low + 1, high):
            total, since = (total + weights[k], since) if total + weights[k] > 0 else (0.0, k)
            if total > best:
                best, part = total, (since, k)
        if best > 0:
            out.append(part)
            asked += [(low, part[0]), (part[1] + 1, high)]
    return out


def _extended(parts: list[tuple]) -> list[tuple[int, int, int, int, int]]:
    """(start, length, other start, other length, edits) of each part (words, other words, b, a, ends, edits), extended at both ends."""
    found: list[list] = [[] for _ in parts]
    out: list = [None] * len(parts)
    for cost in (EDIT, EDIT - 1):  # the second for what has its edits near the ends
        asked = [i for i in range(len(parts)) if out[i] is None]
        if not asked:
            break
        lefts = [(parts[i][0][: parts[i][2]][::-1], parts[i][1][: parts[i][3]][::-1]) for i in asked]
        rights = [(parts[i][0][parts[i][4] :], parts[i][1][parts[i][5] :]) for i in asked]
        ends = _extents([x for x, _ in lefts + rights], [y for _, y in lefts + rights], cost)
        for i, left, right in zip(asked, ends[: len(asked)], ends[len(asked) :]):
            _, _, b, a, b_last, a_last, edits = parts[i]
            for x, y in ((left, right), (left, (0, 0, 0)), ((0, 0, 0), right)):
                n, m = b_last + y[0] - b + x[0], a_last + y[1] - a + x[1]
                found[i].append((b - x[0], n, a - x[1], m, edits + x[2] + y[2]))
            like = [f for f in found[i] if 1 - f[4] / max(f[1], f[3]) >= LEAST_SIMILARITY]
            if cost != EDIT or like and max(f[1] for f in like) >= LEAST_WORDS:
                out[i] = max(like or found[i], key=lambda f: f[1])
    return out


def _widened(column: pa.Array) -> list[np.ndarray]:
    """The stored word hashes of every row."""
    _, where, held = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    words = np.zeros(((offsets[-1] - offsets[0]) // WORD_BYTES, 8), np.uint8)
    if len(words):
        words[:, :WORD_BYTES] = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]].reshape(-1, WORD_BYTES)
    places = ((offsets - offsets[0]) // WORD_BYTES).tolist()
    flat = words.view(np.uint64)[:, 0]
    return [flat[x:y] for x, y in zip(places[:-1], places[1:])]


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "start", "n_words", "other", "other_start", "other_words", "edits"]
    for batch in batches:
        parts, owners, out = [], [], []
        if not batch.num_rows:
            continue
        rows = batch.drop_columns(["b_words", "a_words"]).to_pylist()
        for r, *words in zip(rows, *(_widened(batch.column(c)) for c in ("b_words", "a_words"))):
            for part in _parts(*words, [k - r["b_low"] for k in r["b"]], [k - r["a_low"] for k in r["a"]]):
                parts.append((*words, *part))
                owners.append((r["id"], r["other"], r["b_low"], r["a_low"]))
        for (ident, other, b_low, a_low), (start, n, other_start, m, edits) in zip(owners, _extended(parts)):
            if n >= LEAST_WORDS and 1 - edits / max(n, m) >= LEAST_SIMILARITY:
                out.append((ident, start + b_low, n, other, other_start + a_low, m, edits))
        columns = list(zip(*out)) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


PASSAGE = "id long, start long, n_words long, other long, other_start long, other_words long, edits long"


def _first_holders(found: DataFrame) -> DataFrame:
    """(seed, id, at, other, other_at): the places of every seed that two documents have, with its first one."""
    kind = found.schema["at"].dataType.simpleString()
    near = found.repartition("seed").sortWithinPartitions("seed", "id", "at")
    return near.mapInArrow(_met, f"seed long, id long, at {kind}, other long, other_at {kind}")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of seed, id and place: those whose seed two documents have, with its first place.

    Rows of the first document wait for a second one; a seed that goes on in the next batch keeps its first place.
    """
    wait: list[np.ndarray] | None = None  # rows of the last seed, which no second document has so far
    first: tuple | None = None  # the last seed and its first place, once two documents have it
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in ("seed", "id", "at")]
        if wait is not None:
            rows = [np.concatenate(pair) for pair in zip(wait, rows)]
        seed, ident, at = rows
        begins = np.concatenate([[0], np.flatnonzero(seed[1:] != seed[:-1]) + 1])
        ends = np.append(begins[1:], len(seed))
        others, others_at = ident[begins].copy(), at[begins].copy()
        met = others != ident[ends - 1]
        if first is not None and first[0] == seed[0]:
            others[0], others_at[0], met[0] = first[1], first[2], True
        first = (seed[-1], others[-1], others_at[-1]) if met[-1] else None
        wait = None if met[-1] else [c[begins[-1] :] for c in rows]
        sizes = ends - begins
        taken = np.repeat(met, sizes)
        columns = [c[taken] for c in rows] + [np.repeat(c[met], sizes[met]) for c in (others, others_at)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seed", "id", "at", "other", "other_at"])


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, id, at): two shared seeds of a document that stand near each other there but not in the first
    document of both, as one seed; `at` is the place of the first, times 64, and the way to the second."""
    for batch in batches:
        column = batch.column("shared")
        sizes = np.diff(column.offsets.to_numpy())
        row, held = np.repeat(np.arange(len(sizes)), sizes), column.flatten()
        at, seed, other, other_at = (held.field(i).to_numpy() for i in range(4))
        order = np.lexsort((seed, at, row))
        row, at, seed, other, other_at = (c[order] for c in (row, at.astype(np.int64), seed.view(np.uint64), other, other_at.astype(np.int64)))
        for k in range(1, REACH + 1):
            way, back = at[k:] - at[:-k], other_at[k:] - other_at[:-k]
            near = (row[k:] == row[:-k]) & (way > 0) & (way <= WIDEST_GAP)
            near &= seed[k:] != seed[:-k]
            i = np.flatnonzero(near & ~((other[k:] == other[:-k]) & (back > 0) & (back <= WIDEST_GAP)))
            both = text.mix(seed[i] + text.mix(seed[i + k])).view(np.int64)
            columns = [both, batch.column("id").to_numpy()[row[i]], at[i] * 64 + way[i]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seed", "id", "at"])


def _crossed(shared: DataFrame, known: DataFrame) -> DataFrame:
    """(id, other, at, other_at): both places of the crossings that an earlier document has as well and that
    no passage of `known` holds."""
    met = _first_holders(shared.mapInArrow(_crossings, "seed long, id long, at long")).filter("id <> other")
    ends = [F.struct(*[(F.shiftright(c, 6) + way * F.col(c).bitwiseAND(63)).cast("int").alias(c) for c in ("at", "other_at")]) for way in (0, 1)]
    begin, end = F.shiftright("at", 6), F.shiftright("at", 6) + F.col("at").bitwiseAND(63) + SEED_WORDS
    return _unknown(met, known, begin, end).select("id", "other", F.inline(F.array(*ends)))


def _unknown(rows: DataFrame, known: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows (id, ...) whose words from `start` to `end` are not all in one passage of `known`."""
    spans = known.groupBy("id").agg(F.collect_set(F.struct("start", (F.col("start") + F.col("n_words")).alias("end"))).alias("known"))
    inside = F.exists("known", lambda k: (k["start"] <= start) & (k["end"] >= end))
    return rows.join(spans, "id", "left").filter(F.col("known").isNull() | ~inside).drop("known")


def _by_document(matches: DataFrame, *columns: str) -> DataFrame:
    return matches.groupBy("id").agg(F.collect_list(F.struct(*columns)).alias("shared"))


def _paired(matches: DataFrame) -> DataFrame:
    """(id, other, b, a): the places of all matches of two documents."""
    listed = matches.filter("id <> other").groupBy("id", "other").agg(F.collect_list(F.struct("at", "other_at")).alias("m"))
    return listed.select("id", "other", F.col("m.at").alias("b"), F.col("m.other_at").alias("a"))


def _chained(shared: DataFrame) -> DataFrame:
    link = F.struct("id", "other", F.element_at("b", 1), F.element_at("a", 1))
    chains = shared.mapInArrow(_chains, "id long, other long, b array<int>, a array<int>")
    return stage_table(chains.withColumn("link", F.xxhash64(link)), "chains")


def _asked(docs: DataFrame, chained: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(link, side, low, words): the words around both ends of every chain; with `held` the whole runs of its texts too."""

    def asked(side: str, ident: str, places: str) -> DataFrame:
        low = F.greatest(F.element_at(places, 1) - FLANK, F.lit(0))
        high = F.element_at(places, -1) + FLANK + SEED_WORDS
        return chained.select(F.col(ident).alias("id"), "link", F.lit(side).alias("side"), low.alias("low"), high.alias("high"), F.lit(None).cast("array<int>").alias("held"))

    wanted = asked("b", "id", "b").union(asked("a", "other", "a"))
    if held is not None:
        wanted = wanted.union(held.select("id", F.col("id").alias("link"), F.lit("run").alias("side"), F.lit(0).alias("low"), F.lit(0).alias("high"), "held"))
    # The merge hint keeps one plan at every size, and puts the rows of one text side by side.
    numbered = _identified(docs).withColumn("row", F.monotonically_increasing_id())
    return stage_table(numbered.join(wanted.hint("merge"), "id").mapInArrow(_pieces, "link long, side string, low int, words binary"), "pieces")


def _passages(chained: DataFrame, pieces: DataFrame) -> DataFrame:
    side = lambda s: pieces.filter(F.col("side") == s).select("link", F.col("low").alias(f"{s}_low"), F.col("words").alias(f"{s}_words"))
    both = chained.join(side("b"), "link").join(side("a"), "link").drop("link")
    return stage_table(both.mapInArrow(_aligned, PASSAGE), "aligned")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(id, start, n_words, other, other_start, other_words, edits): passages, in words, that an
    earlier document (`other`) of `docs` (doc_id, text) holds as well."""
    shared = stage_table(_by_document(_first_holders(seeds(docs)), "at", "seed", "other", "other_at"), "shared")
    chained = _chained(shared)
    pieces = _asked(docs, chained, shared.select("id", F.col("shared.at").alias("held")))
    aligned = _passages(chained, pieces)
    runs = pieces.filter("side = 'run'").mapInArrow(_unpacked, "seed long, id long, at int")
    exact = _paired(_first_holders(runs)).mapInArrow(_runs, PASSAGE)
    end = F.col("start") + F.col("n_words")
    found = stage_table(aligned.union(_unknown(exact, aligned, F.col("start"), end)), "found")
    drop_staged(chained, pieces, aligned)
    chained = _chained(_by_document(_crossed(shared, found), "at", "other", "other_at"))
    drop_staged(shared)
    pieces = _asked(docs, chained)
    aligned = _passages(chained, pieces)
    repeats = stage_table(found.union(_unknown(aligned, found, F.col("start"), end)), "repeats")
    drop_staged(chained, pieces, aligned, found)
    return repeats


def remove_repeats(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """`docs` without the repeated passages; an n_chars column follows the new text."""
    spans = stage_table(repeats.groupBy(F.col("id").alias("_id")).agg(F.collect_set(F.struct("start", "n_words")).alias("_spans")), "spans")
    marked = docs.join(spans.hint("merge"), F.col("doc_id") == F.col("_id"), "left").drop("_id")
    schema, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, stays = batch.column("text").to_pylist(), np.ones(batch.num_rows, dtype=bool)
            for i, spans in enumerate(batch.column("_spans").to_pylist()):
                if spans:
                    values[i] = cut(values[i], [(s["start"], s["start"] + s["n_words"]) for s in spans])
                    stays[i] = bool(values[i])
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(values, batch.schema.field("text").type)}
            if "n_chars" in columns:
                counted = [len(v) if s else n for v, s, n in zip(values, batch.column("_spans").to_pylist(), batch.column("n_chars").to_pylist())]
                columns["n_chars"] = pa.array(counted, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_pydict(columns).filter(pa.array(stays))

    return marked.mapInArrow(run, schema)


def cut(value: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; empty if no word is left."""
    raw = np.frombuffer(value.encode(), np.uint8)
    starts, ends, _ = text.word_bounds(raw, np.array([0, len(raw)]))
    gone = np.zeros(len(starts) + 1, dtype=bool)
    for a, b in spans:
        gone[a:b] = True
    gone[-1] = True
    if gone.all():
        return ""
    kept, pieces = ~gone, []
    firsts = np.flatnonzero(kept[:-1] & np.concatenate([[True], gone[:-2]]))
    lasts = np.flatnonzero(kept[:-1] & gone[1:])
    pieces = [raw[starts[i] : ends[j]].tobytes().decode() for i, j in zip(firsts, lasts)]
    return "\n".join(pieces)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every passage that an earlier document holds as well."""
    found = repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumnsRenamed({"id": "doc_id", "other": "other_doc_id"})
