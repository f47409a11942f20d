"""Language, quality rules, quality model and language-model scores."""

import collections
import math
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationcast import session
from stationcast.llm import lang_id, lm_scoring, quality_gam, quality_rules
from stationcast.llm.tables import documents, fold, labels
from tests.llm.fixtures import awkward_rows, frame, plain_rows, text_of
from tests.llm.test_text import WORD, base_counts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return lang_id.train(frame(spark, plain_rows()))


def test_fold_is_crc32_of_the_decimal_id(spark):
    rows = spark.range(-5, 200).select(F.col("id").alias("doc_id")).select("doc_id", fold(5).alias("f"))
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows.collect())


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SF)
    held_out = fold(5) == 0
    found = lang_id.identify(docs.where(held_out), lang_id.train(docs.where(~held_out))).collect()
    right = [r.lang_pred == r.lang for r in found]
    assert len(right) > 100 and sum(right) / len(right) > 0.99
    assert sum(r.lang_rejected for r in found) <= 0.01 * len(found)


def test_centroids(model):
    assert set(model.languages) == {"de", "en", "fr"}
    assert np.allclose((model.centroids**2).sum(axis=1), 1, atol=1e-4)
    assert max(collections.Counter(model.languages).values()) <= lang_id.Training().centroids


def test_awkward_languages(spark, model):
    rows = awkward_rows()
    docs = frame(spark, rows, clash=True)
    found = lang_id.identify(docs, model, prefix="found").collect()
    assert len(found) == len(rows)
    for r in found:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.found_pred, r.found_score, r.found_rejected) == ("und", 0.0, True)
        else:
            assert r.found_pred in model.languages and 0 <= r.found_score <= 1
    assert lang_id.identify(frame(spark, []), model).count() == 0
    short = frame(spark, [(1, "жук", None, None, None)])
    assert not lang_id.identify(short, model).first().lang_rejected
    strange = frame(spark, [(1, "жукови тримають щось зовсім інше " * 20, None, None, None)])
    assert lang_id.identify(strange, model).first().lang_rejected


SPANISH = "la casa que estaba sobre la colina era vieja y nadie sabía quién la había construido allí antes".split()
DUTCH = "het huis dat op de heuvel stond was oud en niemand wist wie het daar vroeger had gebouwd waarom".split()


def test_unlearned_latin_languages_are_rejected(spark, model):
    """Held back from the model, and written with the letters of the learned ones."""
    drawn = np.random.default_rng(3)
    rows = [
        (i, " ".join(drawn.choice(words, 60)), lang, None, None)
        for i, (words, lang) in enumerate([(SPANISH, "es"), (DUTCH, "nl")] * 15)
    ]
    found = lang_id.identify(frame(spark, rows), model).collect()
    assert sum(r.lang_rejected for r in found) >= 0.9 * len(found)
    known = lang_id.identify(frame(spark, [(i, text_of(k, 60, 900 + i), k, None, None) for i in range(20) for k in ("de", "en", "fr")]), model)
    assert not any(r.lang_rejected for r in known.collect())


def test_one_odd_text_does_not_set_the_bound():
    bins = np.full(200, 9)
    seen = {"lang": ["a"] * 200 + ["b"] * 200, "bin": np.concatenate([bins, bins])}
    near, far = np.linspace(0.8, 0.9, 200), np.linspace(0.2, 0.3, 200)
    cosines = np.concatenate([np.stack([near, far], axis=1), np.stack([far, near], axis=1)])
    plain = lang_id.least_cosines(pd.DataFrame(seen | {"cosines": cosines.tolist()}), ["a", "b"], lang_id.Training())
    cosines[0, 0] = 0.01
    odd = lang_id.least_cosines(pd.DataFrame(seen | {"cosines": cosines.tolist()}), ["a", "b"], lang_id.Training(lost=0.01))
    assert (plain > 0.3).all() and (plain < 0.8).all() and np.allclose(plain, odd, atol=0.02)


def test_sample_equals_ranking_of_all_rows(spark, monkeypatch):
    rows = [(i % 900, text_of("en", 5, i % 1000), "en" if i % 10 else "de", None, None) for i in range(3000)]
    rows += [(None, f"only {i}", "fr", None, None) for i in range(7)] + [(5, "again", "xx", None, None)] * 400
    docs = frame(spark, rows)
    for wanted in (1, 40, 5000):
        found = sorted((r.lang, r.text) for r in lang_id._sample(docs, wanted).collect())
        keyed = docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("h")).distinct().collect()
        expected = []
        for lang in ("en", "de", "fr", "xx"):
            own = sorted((r.h, r.text) for r in keyed if r.lang == lang)[:wanted]
            expected += [(lang, text) for _, text in own]
        assert found == sorted(expected)


def test_vectors_and_cosines_against_plain_loops(spark, model):
    """Grams, places, weights, norm, cosine and the nearest centroid, one text after the other."""
    def place(gram):
        if len(gram) == 2:
            return ((gram[0] << 8 | gram[1]) + 1) * 0x9E3779B1 % (1 << 32) >> 19
        return (gram[0] << 16 | gram[1] << 8 | gram[2]) * 0x85EBCA6B % (1 << 32) >> 19

    def grams(text):
        data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode())
        data = b"  " + data + b"  "
        two = [data[i : i + 2] for i in range(len(data) - 1) if data[i : i + 2] != b"  "]
        three = [data[i : i + 3] for i in range(len(data) - 2)]
        return collections.Counter(map(place, two + [g for g in three if g[:2] != b"  " and g[1:] != b"  "]))

    rows = plain_rows(9)
    trained = [grams(r[1]) for r in plain_rows()]
    for k in range(0, lang_id.PLACES, 37):
        held = sum(k in g for g in trained)
        assert model.weights[k] == pytest.approx(math.log((1 + len(trained)) / (1 + held)) + 1, rel=1e-5)
    found = {r.doc_id: r for r in lang_id.identify(frame(spark, rows), model).collect()}
    for row in rows:
        vector = {k: math.log1p(n) * float(model.weights[k]) for k, n in grams(row[1]).items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * float(c[k]) for k, v in vector.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        assert found[row[0]].lang_pred == model.languages[best]
        assert found[row[0]].lang_score == pytest.approx(cosines[best], abs=1e-4)


def test_documents_without_an_id_are_not_held_out(spark, tmp_path):
    rows = [*plain_rows(), (None, text_of("de", 60, 5), "de", None, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, i % 2, 0) for i in range(60)] + [(None, 1, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (lang_id.op7_language_id, quality_gam.op9_quality_gam):
        found = {r.doc_id: r.held_out for r in query(spark, str(tmp_path)).collect()}
        assert found[None] is False and None not in found.values() and len(found) == 61


def test_no_training_rows(spark):
    model = lang_id.train(frame(spark, []))
    found = lang_id.identify(frame(spark, plain_rows(3)), model).collect()
    assert [(r.lang_pred, r.lang_rejected) for r in found] == [("und", True)] * 3


def test_prediction_looks_at_the_text_only(spark, model):
    docs = frame(spark, plain_rows(12))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    first, second = (
        sorted((r.doc_id, r.lang_pred, r.lang_score) for r in lang_id.identify(d, model).collect())
        for d in (docs, other)
    )
    assert first == second


def test_rules_on_awkward_rows(spark):
    rows = awkward_rows()
    found = quality_rules.quality_verdicts(frame(spark, rows, clash=True)).collect()
    assert len(found) == len(rows)
    expected = collections.Counter((r[0], *base_counts(r[1] or "")[:5]) for r in rows)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert collections.Counter(tuple(r[n] for n in names) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert 0 <= r.posterior <= 1 and not (r.base_failed and r.kept)
    assert quality_rules.quality_verdicts(frame(spark, [])).count() == 0


def test_verdicts_agree_with_labels(spark):
    verdicts = quality_rules.quality_verdicts(documents(spark, SF))
    found = verdicts.join(labels(spark, SF), "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in found if r.quality == 1]
    bad = [r.kept for r in found if r.quality == 0]
    assert len(good) > 100 and sum(good) >= 0.99 * len(good)
    assert len(bad) > 10 and sum(bad) <= 0.1 * len(bad)


def test_estimated_accuracies():
    """Votes drawn with known rates give these rates back, at every size alike."""
    rng = np.random.default_rng(4)
    n = 20000
    rates_good, rates_bad = [0.95, 0.9, 0.98, 0.85, 0.97, 0.93], [0.7, 0.8, 0.4, 0.6, 0.75, 0.5]
    good = rng.random(n) < 0.8
    votes = []
    for g, b in zip(rates_good, rates_bad, strict=True):
        right = rng.random(n) < np.where(good, g, b)
        vote = np.where(right == good, "+", "-")
        votes.append(np.where(rng.random(n) < 0.1, "0", vote))
    seen = collections.Counter("".join(v) for v in zip(*votes, strict=True))
    patterns = sorted(seen)
    counts = np.array([seen[p] for p in patterns], float)
    found = quality_rules.estimate(patterns, counts)
    assert abs(found.prior - 0.8) < 0.06
    assert np.allclose(found.right_on_good, rates_good, atol=0.06)
    assert np.allclose(found.right_on_bad, rates_bad, atol=0.15)
    again = quality_rules.estimate(patterns, counts * 1000)
    assert np.allclose(found.posterior(patterns), again.posterior(patterns))
    assert quality_rules.estimate([], np.zeros(0)).prior == quality_rules.START.prior


def test_estimation_and_posterior_against_plain_loops():
    """Every round by loops: each rule's votes weighted with the chance that the text is good."""
    patterns, counts = ["++0", "+-+", "--0", "0-+", "+++", "-0-"], [50.0, 9.0, 12.0, 3.0, 70.0, 4.0]
    start, trust = quality_rules.START, 0.02
    prior, good, bad = start.prior, [0.99] * 3, [0.3] * 3

    def chance(pattern):
        on_good, on_bad = prior, 1 - prior
        for vote, g, b in zip(pattern, good, bad, strict=True):
            if vote != "0":
                on_good *= g if vote == "+" else 1 - g
                on_bad *= 1 - b if vote == "+" else b
        return on_good / (on_good + on_bad)

    total, weight = sum(counts), trust * sum(counts)
    for _ in range(200):
        shares = [n * chance(p) for p, n in zip(patterns, counts, strict=True)]
        new_good, new_bad = [], []
        for r in range(3):
            cast = [(s, n - s, p[r]) for s, n, p in zip(shares, counts, patterns, strict=True) if p[r] != "0"]
            g = (sum(s for s, _, v in cast if v == "+") + weight * 0.99) / (sum(s for s, _, _ in cast) + weight)
            b = (sum(t for _, t, v in cast if v == "-") + weight * 0.3) / (sum(t for _, t, _ in cast) + weight)
            g = min(max(g, 0.6), 0.999)
            new_good.append(g)
            new_bad.append(min(max(b, 2 * (1 - g), 0.02), 0.999))
        moved = max(abs(x - y) for x, y in zip(new_good + new_bad, good + bad, strict=True))
        fresh = min(max((sum(shares) + weight * start.prior) / (total + weight), 0.01), 0.99)
        moved, prior, good, bad = max(moved, abs(fresh - prior)), fresh, new_good, new_bad
        if moved < 1e-9:
            break
    found = quality_rules.estimate(patterns, np.array(counts))
    assert found.prior == pytest.approx(prior) and found.right_on_good == pytest.approx(good)
    assert found.right_on_bad == pytest.approx(bad)
    assert found.posterior(patterns) == pytest.approx([chance(p) for p in patterns])


def test_kept_follows_the_posterior(spark):
    found = quality_rules.quality_verdicts(documents(spark, SF)).select("votes", "posterior", "base_failed", "kept").collect()
    seen = collections.Counter(r.votes for r in found)
    patterns = sorted(seen)
    chances = quality_rules.estimate(patterns, np.array([seen[p] for p in patterns], float)).posterior(patterns)
    by_pattern = dict(zip(patterns, chances, strict=True))
    for r in found:
        assert r.posterior == pytest.approx(by_pattern[r.votes], rel=1e-12)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def plain_cut(slope, weight, smooth):
    """The best gain of any cut in two, and where."""
    part = lambda a, b: sum(slope[a:b]) ** 2 / (sum(weight[a:b]) + smooth)
    gains = [part(0, k) + part(k, len(slope)) - part(0, len(slope)) for k in range(1, len(slope))]
    return max(gains), 1 + gains.index(max(gains))


def test_boosting_step_against_plain_loops():
    """One round on one feature: bins by edges, a tree of two leaves, and the scores it gives."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 6, (60, 1)).astype(float)
    y = ((x[:, 0] >= 3) ^ (rng.random(60) < 0.2)).astype(float)
    how = quality_gam.Boosting(rounds=1, pairs=0, pair_rounds=0, leaves=2)
    model = quality_gam.fit(x, y, how)
    share = (sum(y) + 1) / 62
    edges = sorted(set(np.quantile(x[:, 0], np.arange(1, how.bins) / how.bins).tolist()))
    of = [sum(v >= e for e in edges) for v in x[:, 0].tolist()]
    slope, weight = [0.0] * (len(edges) + 1), [0.0] * (len(edges) + 1)
    for k, target in zip(of, y.tolist(), strict=True):
        slope[k] += target - share
        weight[k] += share * (1 - share)
    _, cut = plain_cut(slope, weight, how.smooth)
    step = [
        how.rate * sum(slope[a:b]) / (sum(weight[a:b]) + how.smooth)
        for a, b in [(0, cut) if k < cut else (cut, len(slope)) for k in range(len(slope))]
    ]
    assert model.tables[0] == pytest.approx(step)
    start = math.log(share / (1 - share))
    expected = [1 / (1 + math.exp(-(start + step[k]))) for k in of]
    assert model.score(x) == pytest.approx(expected)


def test_pair_tree_against_plain_loops():
    """All trees of a first cut of one feature and a cut of the other on each side."""
    rng = np.random.default_rng(12)
    slope, weight, smooth = rng.normal(size=(4, 5)), rng.random((4, 5)) + 0.1, 2.0
    best = 0.0
    for turned in (False, True):
        s, w = (slope.T, weight.T) if turned else (slope, weight)
        for at in range(1, len(s)):
            gain = -s.sum() ** 2 / (w.sum() + smooth)
            for rows in (range(at), range(at, len(s))):
                sides = []
                for cut in range(1, s.shape[1]):
                    total = 0.0
                    for columns in (range(cut), range(cut, s.shape[1])):
                        cells = [(i, j) for i in rows for j in columns]
                        total += sum(s[c] for c in cells) ** 2 / (sum(w[c] for c in cells) + smooth)
                    sides.append(total)
                gain += max(sides)
            best = max(best, gain)
    gain, step = quality_gam._pair_tree(slope, weight, smooth)
    assert gain == pytest.approx(best)
    assert (slope * step).sum() > 0 and len(np.unique(step.round(9))) <= 4


def test_score_adds_up_tables_of_bins():
    model = quality_gam.Gam(
        0.25, [np.array([1.0, 2.0]), np.array([0.5])], [np.array([0.1, 0.2, 0.3]), np.array([-1.0, 1.0])],
        [np.array([1.5]), np.array([])], [(0, 1)], [np.array([[0.05], [0.07]])],
    )
    x = np.array([[0.0, 0.5], [1.0, 0.0], [2.5, 9.0]])
    totals = [0.25 + 0.1 + 1 + 0.05, 0.25 + 0.2 - 1 + 0.05, 0.25 + 0.3 + 1 + 0.07]
    assert model.score(x) == pytest.approx([1 / (1 + math.exp(-t)) for t in totals])


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.random((6000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:4000], y[:4000], quality_gam.Boosting(rounds=20, pairs=1))
    assert model.pairs == [(0, 1)]
    assert ((model.score(x[4000:]) > 0.5) == y[4000:]).mean() > 0.95


def test_gam_learns_a_curve():
    rng = np.random.default_rng(8)
    x = rng.random((4000, 2))
    y = (abs(x[:, 0] - 0.5) < 0.25).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000], quality_gam.Boosting(rounds=60))
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


def test_gam_without_or_with_one_class():
    assert quality_gam.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    one_class = quality_gam.fit(np.zeros((8, 3)), np.ones(8))
    assert one_class.score(np.zeros((1, 3)))[0] == pytest.approx(0.9)


def test_quality_of_held_out_documents(spark):
    held_out = fold(4) == 2
    docs, marks = documents(spark, SF), labels(spark, SF)
    model = quality_gam.train(docs, marks.where(~held_out))
    found = quality_gam.score(docs, model).join(marks.where(held_out), "doc_id").collect()
    right = [(r.score >= 0.7) == (r.quality == 1) for r in found]
    assert len(right) > 50 and sum(right) / len(right) > 0.95


def test_awkward_scores(spark):
    rows = awkward_rows()
    marks = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (103, 1), (999, 0), (4, 0)], "doc_id long, quality int"
    )
    model = quality_gam.train(frame(spark, rows, clash=True), marks)
    found = quality_gam.score(frame(spark, rows, clash=True), model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert quality_gam.score(frame(spark, []), model).count() == 0


def expected_scores(rows, order, backoff, least):
    lists = [WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")) for r in rows]
    counts = collections.Counter()
    for words in lists:
        for k in range(1, order + 1):
            counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    total = sum(map(len, lists))
    out = []
    for row, words in zip(rows, lists, strict=True):
        score = 0.0
        for i in range(len(words)):
            for k in range(min(order, i + 1), 0, -1):
                gram = tuple(words[i + 1 - k : i + 1])
                if k == 1:
                    score += math.log(counts[gram] / total)
                elif counts[gram] >= least:
                    score += math.log(counts[gram] / counts[gram[:-1]])
                    break
                else:
                    score += math.log(backoff)
        out.append((row[0], len(words), score))
    return out


@pytest.mark.parametrize("order, passes", [(1, 1), (2, 3), (3, 4), (4, 1), (5, 2)])
def test_scores_against_loops(spark, order, passes):
    rows = awkward_rows()
    how = lm_scoring.Backoff(order=order, passes=passes)
    found = lm_scoring.corpus_scores(frame(spark, rows, clash=True), how).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted([(r.doc_id, r.n_words, r.log_score) for r in found], key=key)
    for a, b in zip(got, sorted(expected_scores(rows, order, 0.4, 2), key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9, abs=1e-9)
    for r in found:
        assert r.mean_log_score == pytest.approx(r.log_score / r.n_words if r.n_words else 0)
    assert lm_scoring.corpus_scores(frame(spark, []), how).count() == 0


def test_min_count_of_one_and_a_hot_gram(spark):
    """A pair that all documents hold has one row per document; with a bound of one all grams score."""
    rows = [(i, f"of the {text_of('en', 20, i)} of the of the", None, None, None) for i in range(50)]
    for least in (1, 3):
        how = lm_scoring.Backoff(order=3, min_count=least, passes=2)
        found = lm_scoring.corpus_scores(frame(spark, rows), how).collect()
        expected = {r[0]: r[2] for r in expected_scores(rows, 3, 0.4, least)}
        assert all(r.log_score == pytest.approx(expected[r.doc_id], rel=1e-9) for r in found) and len(found) == 50
    pairs = lm_scoring._document_rows(
        frame(spark, rows).selectExpr("doc_id AS row", "text"), lm_scoring.Backoff(passes=1), 0
    )
    assert pairs.groupBy("gram").count().agg({"count": "max"}).first()[0] == 50


def test_backoff_keeps_no_texts_or_counts(spark, tmp_path, monkeypatch):
    """N-grams are moved in a row for each bucket that a batch has, and only gains and sums stay stored."""
    rows = awkward_rows()
    how = lm_scoring.Backoff()
    texts = frame(spark, rows).selectExpr("coalesce(doc_id, -1) AS row", "coalesce(text, '') AS text").coalesce(1)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for moved in (lm_scoring._batch_grams(texts, how, 0), lm_scoring._document_grams(texts, how, 0)):
        assert moved.groupBy("bucket").count().count() == buckets
        assert moved.count() <= 5 * buckets
    monkeypatch.setattr(session, "shared_folder", lambda spark: f"file://{tmp_path}")
    lm_scoring.corpus_scores(frame(spark, rows), how).collect()
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"gains", "sums"}


def test_bounds_of_numbers_in_rows(spark):
    """What is dealt to buckets comes back whole and in order, also from slices of a batch."""
    hashes = lm_scoring.mix(np.arange(1, 1000, dtype=np.uint64))
    dealt = lm_scoring._dealt(lm_scoring._bucket(hashes, 7), 7, {"grams": hashes, "times": np.arange(999, dtype=np.int32)})
    assert dealt["bucket"].tolist() == list(range(7))
    for a, b in ((0, 7), (2, 5), (3, 3)):
        some = hashes[(lm_scoring._bucket(hashes, 7) >= a) & (lm_scoring._bucket(hashes, 7) < b)]
        piece = lm_scoring._numbers(dealt["grams"].slice(a, b - a))
        assert sorted(piece.tolist()) == sorted(some.tolist())
        assert lm_scoring._ends(dealt["grams"].slice(a, b - a))[-1] == len(some)
        times = lm_scoring._numbers(dealt["times"].slice(a, b - a), np.int32)
        assert (hashes[times] == piece).all()
