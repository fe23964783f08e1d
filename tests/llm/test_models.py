"""Models learned here: held-out accuracy and odd rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import ODD, empty, odd
from tracewright.llm import features, language, resampling, toxicity
from tracewright.llm.common import table
from tracewright.llm.queries import QUERIES


@pytest.fixture(scope="module")
def medium():
    return "/root/testdata/sf0.01"


def test_tokens_are_hashed_alike_wherever_they_stand():
    texts = ["The cat, the CAT", None, "", "cat", "a " * features.WINDOW_CHARS + "cat"]
    by_text = {}
    for docs, hashes in features.tokens(texts, marks=False):
        for d, h in zip(docs.tolist(), hashes.tolist(), strict=True):
            by_text.setdefault(d, []).append(h)
    the, cat = by_text[0][:2]
    assert by_text[0] == [the, cat, the, cat] and by_text[3] == [cat] and by_text[4][-1] == cat
    assert len(by_text[4]) == features.WINDOW_CHARS + 1 and 1 not in by_text and 2 not in by_text


def test_pairs_go_over_window_ends():
    text = "x y " * (features.WINDOW_CHARS // 2)
    n = sum(len(d) for d, _ in features.word_pairs(features.tokens([text], marks=True)))
    assert n == 2 * features.WINDOW_CHARS - 1


def test_language_accuracy_on_held_out_documents(spark, medium):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, medium, "documents").collect()}
    got = QUERIES["op7_language_id"](spark, medium).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def by_hand(labelled, texts):
    """Naive Bayes by plain loops: the language and posterior of each text."""
    counts, prior = {}, {}
    for text, lang in labelled:
        prior[lang] = prior.get(lang, 0) + 1
    for text, lang in sorted(set(labelled)):
        own = counts.setdefault(lang, np.full(1 << language.BITS, language.SMOOTHING))
        for _, buckets in features.char_ngrams([text], language.ORDERS, language.BITS):
            np.add.at(own, buckets, 1)
    names = sorted(counts)
    logs = {x: np.log(counts[x] / counts[x].sum()) for x in names}
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            yield "und", 0.0
            continue
        score = {x: np.log(prior[x] / sum(prior.values())) for x in names}
        for _, buckets in features.char_ngrams([text], language.ORDERS, language.BITS):
            for x in names:
                score[x] += logs[x][buckets].sum()
        best = max(names, key=lambda x: (score[x], [-ord(c) for c in x]))
        yield best, 1 / sum(np.exp(v - score[best]) for v in score.values())


def test_language_query_matches_brute_force(spark, sf):
    docs = table(spark, sf, "documents").collect()
    labelled = [(r["text"], r["lang"]) for r in docs if r["text"] is not None and r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    want = dict(zip([r["doc_id"] for r in docs], by_hand(labelled, [r["text"] for r in docs]), strict=True))
    got = QUERIES["op7_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["lang_pred"] == want[r["doc_id"]][0] and abs(r["score"] - want[r["doc_id"]][1]) < 1e-6


def test_languages_are_never_left_out(spark):
    rows = [("ein text aus vielen kopien", "de")] * 40 + [(f"text number {i} of this language", f"l{i % 7}") for i in range(70)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    assert language.fit(labelled, rows_per_language=1).languages == sorted({x for _, x in rows})
    model = language.fit(labelled, rows_per_language=1)
    assert np.allclose(np.exp(model.log_prior), [40 / 110] + [10 / 110] * 7) and (np.ptp(model.log_probability, axis=1) > 0).all()
    with pytest.raises(ValueError, match="languages"):
        language.fit(labelled, most_languages=7)


def test_language_of_odd_rows(spark):
    docs = odd(spark)
    model = language.fit(docs)
    got = docs.select("doc_id", "text", language.language_of(spark, model).alias("l")).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert (r["l"]["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    nothing = language.fit(empty(spark))
    assert {r["l"]["lang_pred"] for r in docs.select(language.language_of(spark, nothing).alias("l")).collect()} == {"und"}


def test_toxicity_on_held_out_documents(spark):
    large = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in table(spark, large, "labels").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, large).collect()}
    held = [(truth[d], r["score"]) for d, r in got.items() if r["held_out"] and d in truth]
    ones, zeros = [s for y, s in held if y], [s for y, s in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros]) > 0.9
    assert np.mean([s >= 0.5 for s in zeros]) < 0.02
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in got.values())


SIGNS = "\u0e00-\u0eff\u1000-\u10bf\u1780-\u17ff\u3000-\u9fff"


def terms_of(text):
    """Whole words of ASCII letters, digits and all that is not ASCII; of scripts without spaces pairs of neighbours."""
    out = []
    for run in re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower()):
        for part in re.findall(f"[{SIGNS}]+|[^{SIGNS}]+", run):
            signs = re.match(f"[{SIGNS}]", part)
            out += [part[i : i + 2] for i in range(len(part) - 1)] if signs and len(part) > 1 else [part]
    return out


def test_terms_are_whole_words_and_pairs_of_signs():
    texts = ["nationalism nationality", "превосходный превратный", "我喜欢学习中文。", "中", "ภาษาไทย and ខ្មែរ", "über-all ÄÖ1 café", "한국어 단어", "x" * 300_000 + " " + "漢字" * 200_000, "", None, "a\n中b"]
    seen = {}
    for text in texts:
        own = [tuple(np.concatenate([h for _, h in features.tokens([text], marks=False, signs=True)] or [np.zeros(0, np.uint64)]).tolist())]
        want = terms_of(text)
        assert len(own[0]) == len(want)
        for h, n in Counter(own[0]).items():
            seen.setdefault(h, set()).add((text, n))
        assert sorted(Counter(own[0]).values()) == sorted(Counter(want).values())
    assert len(seen) == len({w for t in texts for w in terms_of(t)})


def test_toxicity_query_matches_brute_force(spark, sf):
    """Scores again from dense vectors: all words, plain counts, every cosine."""
    docs, labels = table(spark, sf, "documents").collect(), table(spark, sf, "labels").collect()
    words = lambda t: Counter(terms_of(t))
    held = {d: zlib.crc32(str(d).encode()) % 5 for d in (r["doc_id"] for r in docs)}
    text_of = {r["doc_id"]: r["text"] for r in docs}
    label = {r["doc_id"]: r["toxic"] for r in labels if r["toxic"] is not None and held.get(r["doc_id"])}
    seen, sample = set(), []
    for d in sorted(label):
        if (text_of[d], label[d]) not in seen:
            seen.add((text_of[d], label[d]))
            sample.append(d)
    n, n1 = len(sample), sum(label[d] for d in sample)
    place = {w: i for i, w in enumerate(sorted({w for d in sample for w in words(text_of[d])}))}
    df, every, ones = np.zeros(len(place)), np.zeros(len(place)), np.zeros(len(place))
    for r in docs:
        df[[place[w] for w in words(r["text"]) if w in place]] += 1
    for d in sample:
        own = [place[w] for w in words(text_of[d])]
        every[own] += 1
        ones[own] += label[d]
    phi = np.abs(n * ones - every * n1) / np.sqrt(np.maximum(every * (n - every) * n1 * (n - n1), 1e-300))
    weight = (np.log((1 + len(docs)) / (1 + df)) + 1) * (toxicity.FLOOR + np.where(every < n, phi, 0))

    def vector(text):
        v = np.zeros(len(place))
        for w, k in words(text).items():
            if w in place:
                v[place[w]] = (1 + np.log(k)) * weight[place[w]]
        return v / max(np.sqrt(v @ v), 1e-300)

    known = np.array([d for d in sample if held[d] != 1])
    matrix, toxic = np.array([vector(text_of[d]) for d in known]), np.array([label[d] for d in known], float)
    empty = ~matrix.any(axis=1)
    prior = (toxic[empty].sum() + toxic.mean()) / (empty.sum() + 1)

    def vote(text):
        cosine = matrix @ vector(text)
        best = np.argsort(-cosine, kind="stable")[: toxicity.NEIGHBOURS]
        w = np.where(cosine[best] > 0, cosine[best], 0) ** 2
        return (w @ toxic[best] + prior) / (w.sum() + 1)

    aside = [d for d in sample if held[d] == 1]
    raw, share = toxicity.isotonic(np.array([vote(text_of[d]) for d in aside]), np.array([label[d] for d in aside], float), np.ones(len(aside)))
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, sf).collect()}
    off = [d for d, t in text_of.items() if abs(got[d]["score"] - np.interp(vote(t), raw, share)) > 1e-6]
    assert len(got) == len(docs) and len(off) <= 0.02 * len(docs), off  # of equal cosines at the k-th place others can be taken


def test_examples_are_bounded(spark):
    docs = spark.createDataFrame([(i % 50, " ".join(f"w{(i * j) % 997}" for j in range(200))) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    rows, scale = toxicity.examples(docs, labels, F.lit(True), 4_000, 5_000)
    assert 0 < sum(len(t) // 8 for t in rows["term"]) < 10_000 and scale[0] == scale[1] < 0.1
    assert toxicity.fit(docs, labels, F.lit(True), entries=5_000).index.doc_id.size > 0


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(500):
        terms = np.sort(rng.choice(80, rng.integers(0, 9), replace=False))
        vectors.append(toxicity.unit(terms, rng.random(len(terms)) + 0.1))
    index = toxicity.Index.build(vectors, rng.integers(0, 2, 500).astype(float), np.arange(500), np.ones(500), 80)
    dense = np.zeros((500, 80))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for t, w in vectors[:80]:
        q = np.zeros(80)
        q[t] = w
        rows, cosine = index.nearest(t, w, 10)
        assert np.allclose(cosine, np.sort((dense @ q)[dense @ q > 0])[::-1][:10])
        assert np.allclose(dense[index.doc_id[rows]] @ q, cosine)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (3, 1, 0), (None, 0, 1), (6, 1, None), (99, 0, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = toxicity.score_documents(odd(spark), some).collect()
        assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_documents(empty(spark), labels).count() == 0


def test_isotonic_shares_do_not_fall():
    rng = np.random.default_rng(1)
    vote = rng.random(200)
    raw, share = toxicity.isotonic(vote, (rng.random(200) < vote).astype(float), np.ones(200))
    assert (np.diff(raw) > 0).all() and (np.diff(share) >= -1e-12).all() and share.min() > 0 and share.max() < 1


def test_resampling_prefers_target_like_text(spark, medium):
    truth = {r["doc_id"]: r["quality"] for r in table(spark, medium, "labels").collect()}
    got = QUERIES["op1_importance_resampling"](spark, medium).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, len(got) + 1))
    assert sum(r["selected"] for r in got) == int(np.ceil(resampling.KEEP * len(got)))
    by_key = sorted(got, key=lambda r: (-r["gumbel_key"], r["doc_id"]))
    assert [r["rank"] for r in by_key] == list(range(1, len(got) + 1))
    weight = lambda q: np.median([r["log_weight"] for r in got if truth.get(r["doc_id"]) == q])
    assert weight(1) > weight(0)
    share = lambda q: np.mean([r["selected"] for r in got if truth.get(r["doc_id"]) == q])
    assert share(1) > 0.9 > 0.5 > share(0)


def test_log_ratio_matches_brute_force(spark):
    docs = odd(spark)
    ratio = resampling.log_ratio(docs, spark.createDataFrame([(1,)], "doc_id long"))
    raw, target = np.ones(resampling.BUCKETS), np.ones(resampling.BUCKETS)
    for doc_id, text, *_ in ODD:
        for _, buckets in resampling._features([text]):
            np.add.at(raw, buckets, 1)
            if doc_id == 1:
                np.add.at(target, buckets, 1)
    assert np.allclose(ratio, np.log(target / target.sum()) - np.log(raw / raw.sum()))


def test_resampling_query_matches_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    good = {r["doc_id"] for r in table(spark, sf, "labels").collect() if r["quality"] == 1}
    raw, target = np.ones(resampling.BUCKETS), np.ones(resampling.BUCKETS)
    found = {d: np.concatenate([b for _, b in resampling._features([t])] or [np.zeros(0, int)]) for d, t in docs.items()}
    for d, buckets in found.items():
        np.add.at(raw, buckets, 1)
        if d in good:
            np.add.at(target, buckets, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    noise = {r["doc_id"]: r["h"] for r in table(spark, sf, "documents").select("doc_id", F.xxhash64("doc_id", F.lit(7)).alias("h")).collect()}
    key = {d: ratio[b].sum() - np.log(-np.log(((noise[d] % 2**64 >> 11) + 0.5) / 2**53)) for d, b in found.items()}
    got = {r["doc_id"]: r for r in QUERIES["op1_importance_resampling"](spark, sf).collect()}
    assert got.keys() == key.keys()
    assert all(abs(r["log_weight"] - ratio[found[d]].sum()) < 1e-6 and r["n_features"] == len(found[d]) and abs(r["gumbel_key"] - key[d]) < 1e-6 for d, r in got.items())
    chosen = sorted(key, key=lambda d: (-key[d], d))[: int(np.ceil(resampling.KEEP * len(key)))]
    assert {d for d, r in got.items() if r["selected"]} == set(chosen)


def test_resampling_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = resampling.resample(odd(spark), labels).collect()
    assert len(got) == len(ODD) and all(r["log_weight"] == 0 for r in got if r["n_features"] == 0)
    assert resampling.resample(odd(spark), labels.limit(0)).count() == len(ODD)
    assert resampling.resample(empty(spark), labels).count() == 0
