"""Classifiers, language model, mixing, line rules and HTML: fixtures, odd input, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lakerisk.llm import hmm, html, language, line_rules, mixing, quality, rows, toxicity


def auc(scores, marks):
    rank = np.argsort(np.argsort(scores, kind="stable"), kind="stable") + 1
    pos = np.array(marks, bool)
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.fixture(scope="module")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, label int")


GOOD = "The meeting went on for hours and nobody could say how it would end, but the mood in room {0} was calm."
BAD = "BUY!! {0} BUY!! NOW*** ### ${0}$ | | | NOW!! BUY!! BUY!!"


def test_quality_separates_and_takes_odd_rows(documents, labels, odd_rows):
    docs = documents([(i, (GOOD if i % 2 else BAD).format(i) * (1 + i % 5)) for i in range(80)])
    model = quality.fit(docs, labels([(i, i % 2) for i in range(80)]))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in got)
    odd = quality.score(documents(odd_rows), model)
    assert odd.count() == len(odd_rows) and odd.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality.score(documents([]), model).count() == 0


def test_quality_without_both_classes(documents, labels):
    docs = documents([(1, "a b"), (2, "c")])
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, labels([(1, 1)]))).collect()} == {1.0}
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, labels([]))).collect()} == {0.5}


def test_extra_columns_with_clashing_names_pass_or_are_replaced(documents, labels):
    from pyspark.sql import functions as F

    docs = documents([(1, "a b")]).withColumns({"score": F.lit("old"), "label": F.lit(3), "id": F.lit(9)})
    scored = quality.score(docs, quality.fit(docs.select("doc_id", "text"), labels([])))
    assert scored.first()["score"] == 0.5 and scored.first()["label"] == 3 and scored.columns.count("score") == 1


def test_label_majority(spark):
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (2, 1), (3, None), (None, 1)], "doc_id long, quality int")
    assert {r["doc_id"]: r["label"] for r in rows.labelled(marks, "quality").collect()} == {1: 1, 2: 0}


@pytest.mark.parametrize(("module", "name", "least"), [(quality, "quality", 0.97), (toxicity, "toxic", 0.7)])
def test_held_out_ranking(spark, module, name, least):
    folder = "/root/testdata/sf0.01"
    got = module.query(spark, folder).toPandas()
    marked = got.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id")
    held = marked[marked["held_out"]]
    assert auc(held["score"].to_numpy(), held[name].to_numpy()) > least
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all() and got["doc_id"].is_unique


def test_fold_matches_zlib(documents):
    got = {r["doc_id"]: r["r"] for r in documents([(i, "x") for i in (0, 7, 12345, None)]).select("doc_id", rows.remainder(7).alias("r")).collect()}
    assert got == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 for i in (0, 7, 12345, None)}


def test_folding_and_longest_match_outside_exceptions():
    assert toxicity.fold("1D10T! Іdiоt, fool$$$ café") == " idiot idiot fool café "
    lexicon = toxicity.Lexicon({"idio": 2.0, "idiot": 3.0, "trash": 4.0}, frozenset({"trash can"}))
    found = toxicity.matches(toxicity.fold("an idiot, idiom; the trash can, trash here; mytrash"), lexicon.automaton())
    assert sorted(found.values()) == [2.0, 3.0, 4.0]


def test_toxicity_learns_terms_and_exceptions(documents, labels, odd_rows):
    base = "the wind over the hills was mild and the road {0} went on"
    docs = [(i, (base + " you awful scumbag of route").format(i)) for i in range(30)] + [(100 + i, (base + " with a scumbag filter fitted").format(i)) for i in range(6)]
    docs += [(200 + i, base.format(i)) for i in range(200)]
    lexicon = toxicity.fit(documents(docs), labels([(i, int(i < 100)) for i, _ in docs]))
    assert any("scumbag".startswith(t) for t in lexicon.weights) and "scumbag filter" in lexicon.exceptions
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents([*docs, (999, "you ѕcumb4g of route")]), lexicon).collect()}
    assert min(got[i] for i in range(30)) > 0.5 > max(got[i] for i in got if 100 <= i < 900) and got[999] > 0.5
    odd = toxicity.score(documents(odd_rows), lexicon)
    assert odd.count() == len(odd_rows) and odd.filter("score is null").count() == 0
    assert {r["score"] for r in toxicity.score(documents(odd_rows), toxicity.fit(documents([]), labels([]))).collect()} == {0.0}


def test_language_held_out_and_odd_rows(spark, documents, odd_rows):
    folder = "/root/testdata/sf0.01"
    got = language.query(spark, folder).toPandas()
    true = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got.merge(true, on="doc_id")[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()
    model = language.fit(documents([(1, "one two three", "en"), (2, "eins zwei drei", "de"), (3, "x", None), (4, None, "fr")]))
    named = {(r["doc_id"], r["lang_pred"]) for r in language.identify(documents([*odd_rows, (9, "12 34 !"), (10, "zwei drei")]), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "und"), (10, "de")} <= named
    nothing = language.fit(documents([]))
    assert {r["lang_pred"] for r in language.identify(documents(odd_rows), nothing).collect()} == {"und"}


def test_language_sample_is_the_smallest_hashes(documents):
    docs = documents([(i % 900, f"text {i % 700}", "a" if i % 10 else "b") for i in range(3000)])
    keyed = docs.withColumn("order", language._order()).select("lang", "order", "doc_id").collect()
    for most in (1, 40, 5000):
        got = sorted((r["lang"], r["order"], r["doc_id"]) for r in language._chosen(docs, most).collect())
        assert got == sorted(t for lang in "ab" for t in sorted(tuple(r) for r in keyed if r["lang"] == lang)[:most])
    assert language._chosen(documents([]), 5).count() == 0


def test_mix_holds_targets_and_limits(documents, odd_rows):
    docs = documents([(i, "w " * (1 + i % 37), None, ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(4000)])
    got = mixing.mix(docs).toPandas()
    assert got["copies"].between(0, 2).all() and len(got) == 4000
    by = got.assign(taken=got["copies"] * got["size"]).groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by["taken"] - by["target"]) <= 40).all()
    assert by["target"].sum() == pytest.approx(1.5 * got["size"].sum())
    again = mixing.mix(docs.repartition(5)).toPandas()
    key = ["doc_id"]
    assert (got.sort_values(key)["copies"].to_numpy() == again.sort_values(key)["copies"].to_numpy()).all()
    odd = mixing.mix(documents(odd_rows))
    assert odd.count() == len(odd_rows) and odd.filter("target is null or copies is null").count() == 0
    assert mixing.mix(documents([])).count() == 0
    assert mixing.mixture(docs, mixing.mix(docs)).count() == got["copies"].sum()


def test_targets_reshare_what_is_above_the_limit(spark):
    sizes = spark.createDataFrame([("aa", 10), ("ab", 100), ("ac", 1000), ("n", 50)], "host string, size long")
    got = {r["host"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got == pytest.approx({"aa": 20, "ab": 200, "ac": 1420, "n": 100})


def test_flight_keeps_both_totals():
    draw = np.random.default_rng(2)
    share, size = draw.random(500), draw.integers(0, 90, 500).astype(float)
    moved = mixing._flight(share, size, np.random.default_rng(1))
    assert ((moved > 1e-9) & (moved < 1 - 1e-9)).sum() <= 2
    assert moved.sum() == pytest.approx(share.sum()) and (moved * size).sum() == pytest.approx((share * size).sum())


def test_line_rules_equal_sql(documents, odd_rows):
    boiler = "Read more on our site today and follow us for daily news and offers of the week"
    docs = [(i, f"{boiler}\n{'own words ' * (i % 4)}{i} and some more unlike words {i * 7} here to fill the text up", None, "h" if i % 9 else None) for i in range(60)]
    odd = [(300 + k, *r[1:]) for k, r in enumerate(odd_rows[:4])]
    docs += [(100 + i, f"{boiler} \n {boiler.upper()}\n{i}", None, "h") for i in range(5)] + [(200, "a b c d e f g h " * 9, None, "h"), (201, "x\nx\n \nx # $", None, "h")] + odd
    frame = documents(docs)
    got = line_rules.line_rules(frame).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    want = con.sql(line_rules.SQL).df().sort_values("doc_id").reset_index(drop=True)[list(got.columns)]
    assert (got.astype("int64") == want.astype("int64")).all().all()
    assert not got[got["doc_id"].between(100, 104)]["kept"].any() and got[got["doc_id"] < 60]["kept"].sum() > 40
    assert line_rules.line_rules(documents([])).count() == 0


def test_hmm_equals_sums_over_paths_and_counts():
    draw = np.random.default_rng(4)
    model = hmm.Model(draw.dirichlet(np.ones(hmm.STATES)), draw.dirichlet(np.ones(hmm.STATES), hmm.STATES), draw.dirichlet(np.ones(hmm.SYMBOLS), hmm.STATES))
    parts = [draw.integers(0, 9, n) for n in (1, 4, 2, 7)]
    lengths = np.array([len(p) for p in parts])
    got = hmm.log10_likelihood(np.concatenate(parts), lengths, model)
    for value, part in zip(got, parts):
        a = model.start * model.emit[:, part[0]]
        for s in part[1:]:
            a = (a @ model.move) * model.emit[:, s]
        assert value == pytest.approx(math.log10(a.sum()))
    counts = hmm.expected(np.concatenate(parts), lengths, model)
    starts, moves, emissions = np.split(counts, [hmm.STATES, hmm.STATES + hmm.STATES**2])
    assert starts.sum() == pytest.approx(4) and moves.sum() == pytest.approx(lengths.sum() - 4) and emissions.sum() == pytest.approx(lengths.sum())
    better = hmm.maximise(counts)
    assert hmm.log10_likelihood(np.concatenate(parts), lengths, better).sum() > got.sum()


@pytest.mark.parametrize("frequent", [1_000_000, 50])
def test_hmm_query_equals_brute_force_base(spark, sf, monkeypatch, frequent):
    monkeypatch.setattr(hmm, "FREQUENT", frequent)
    monkeypatch.setattr(hmm, "ROUNDS", 1)
    monkeypatch.setattr(hmm, "START_ROUNDS", 3)
    got = hmm.query(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    split = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total, distinct = sum(c.values()), len(c)
    assert len(got) == len(texts)
    for r in got:
        ws = split[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in ws))
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])


def test_hmm_on_odd_rows_and_no_training(documents, odd_rows):
    from lakerisk.session import stage_table

    for training in (odd_rows, []):
        docs = documents(odd_rows)
        counted = stage_table(hmm.token_counts(documents(training)))
        words = hmm.vocabulary(counted)
        got = hmm.score(docs, counted, words, hmm.train(documents(training), words, 1))
        assert got.count() == len(odd_rows) and got.filter("score is null or score > 0").count() == 0
        assert {r["n_tokens"] for r in got.collect() if r["doc_id"] in (1, 2, 3)} == {1}


PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="ad">Buy now</div><article><h1>Head &amp; line</h1><p><b>First   para<br>goes on<p>Second &eacute;</p><aside>not this</aside>
<form><input name=q>find</form></article><div class="comments"><p>nice one</p></div><footer>&copy; x</footer></body></html"""


def test_html_extracts_the_article(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "<p"), (1, "u", PAGE)], "page_id long, url string, html string")
    model = html.fit(pages)
    got = html.extract(pages, model).collect()
    assert len(got) == 5
    assert {r["text"] for r in got if r["page_id"] == 1} == {"Head & line\n\nFirst para goes on\n\nSecond é"}
    assert {r["text"] for r in got if r["page_id"] != 1} == {""}
    empty = pages.limit(0)
    assert html.extract(empty, html.fit(empty)).count() == 0


def test_html_reads_malformed_pages():
    """Declarations, sections and quotes left open, and very deep nesting, are read and what follows them is kept."""
    words = lambda page: "".join(t for _, t in html.Tree(page).texts)
    for odd in ("<![foo[bar]]>", "<![if IE]>", "<![endif]>", "<![]>", "<![", "<!x>", "<?php x ?>", "<!-- a -->", "<![CDATA[c]]>", "<!DOCTYPE html>"):
        assert "kept" in words(f"<p>kept</p>{odd}"), odd
        if odd.endswith(">"):
            assert "after" in words(f"{odd}<p>after</p>"), odd
    for open_end in ("<!", "<?", "<", "</", "<!--", '<p class="x', "<![CDATA[", "<![foo[", "&#", "&"):
        assert "kept" in words(f"<p>kept</p>{open_end}"), open_end
    deep = html.Tree("<div>" * 50_000 + "deep")
    assert len(deep.tag) == 50_001 and "deep" in "".join(t for _, t in deep.texts)
    assert len(deep.evidence()) == 50_001


def test_html_marginals_equal_enumeration():
    model = html.potentials(sum((html.observed(t, y) for t, y in html.layouts()), Counter()))
    tree = html.Tree("<div class=content><p>some text<b>x</b></p><ul class=menu><li>a</li></ul></div>")
    size, total, mass = len(tree.tag), 0.0, np.zeros(len(tree.tag))
    evidence = [sum(model.evidence.get(n, 0.0) for n in seen) for seen in tree.evidence()]
    root = math.exp(model.evidence.get("#page", 0.0))
    for code in range(1 << size):
        y = [(code >> i) & 1 for i in range(size)]
        p = root if y[0] else 1.0
        for i in range(size):
            p *= math.exp(evidence[i]) if y[i] else 1.0
            if i:
                p *= model.edges.get(tree.tag[i], model.edges[""])[y[tree.parent[i]]][y[i]]
        total += p
        mass += p * np.array(y)
    assert model.marginals(tree) == pytest.approx((mass / total).tolist())


def test_html_whole_table_against_the_article_markup(spark):
    import html as entities

    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in html.query(spark, folder).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S).group(1)
        parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])
