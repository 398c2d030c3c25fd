"""Language identification, toxicity and language-model scores: held-out accuracy and exact parts."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import in_fold, messy, table, words_of

from flowsieve.llm import language, lm, toxicity
from flowsieve.llm.lattice import Vocabulary
from flowsieve.llm.queries import piece_vocabulary

SYLLABLES = {"aa": ["the", "and", "ing", "er"], "bb": ["sch", "ung", "ein", "ä"], "cc": ["ción", "que", "los"]}


def _spoken(n, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 40)))
        rows.append((i, text, lang))
    return rows


def test_language_of_held_out_documents(spark):
    data = [*_spoken(200), (900, None, "aa"), (901, "", "aa"), (902, "12 345 !", "bb"), (903, "zzz", None), (None, "the and", "aa")]
    docs = table(spark, data)
    rows = language.predict(docs, language.learn(docs)).collect()
    assert len(rows) == len(data)
    truth = {i: lang for i, _, lang in data if i is not None and i < 900}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == in_fold(r.doc_id, 4, 2) for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 20
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert by[903].lang_pred in SYLLABLES and all(0 <= r.score <= 1 for r in rows)


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(1, "the and"), (2, None)])
    assert language.learn(docs) is None
    assert [r.lang_pred for r in language.predict(docs, None).collect()] == ["und", "und"]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {r.predicted for r in toxicity.score_texts(docs, model).collect()} == {0}


def test_bit_sliced_filters_have_no_false_negatives():
    rng = np.random.default_rng(0)
    planes = {size: np.zeros((2, 1 << language.SLOT_BITS), np.uint8) for size in language.SIZES}
    languages = [f"l{k}" for k in range(11)]
    texts = [bytes(rng.integers(97, 123, 60).tolist()) for _ in languages]
    for k, text in enumerate(texts):
        for size in language.SIZES:
            _, hashes = language.ngrams([text], size)
            for h in range(language.HASHES):
                planes[size][k // 8, language.slots(hashes, h)] |= 1 << (k % 8)
    best, score = language.Filters(languages, planes, 0).predict(texts)
    assert best.tolist() == list(range(11)) and score.min() > 0.8


def _abuse(n, seed=8):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("bcdfgaeiou", k=rng.randrange(3, 8))) for _ in range(400)]
    rude = ["nastyword", "vileterm", *[f"grumph{s}" for s in ("a", "en", "ich", "os", "ung", "era")]]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = rng.choices(plain, k=rng.randrange(20, 80))
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(rude)
        docs.append((i, " ".join(words).capitalize() + "."))
        if rng.random() < 0.9:
            labels.append((i, int(toxic) if rng.random() > 0.03 else int(not toxic)))
    return docs, labels, {i for i, t in docs if any(r in t.lower() for r in rude)}


def test_toxicity_of_held_out_documents(spark):
    docs, labels, truth = _abuse(900)
    odd = [(5000, None), (5001, ""), (None, "nothing")]
    data = table(spark, docs + odd)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), labels[0]], "doc_id long, toxic int")
    model = toxicity.fit(data, marks)
    rows = toxicity.score_texts(data, model).collect()
    assert len(rows) == len(docs) + 3
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 5000]
    assert all(r.held_out == in_fold(r.doc_id, 3, 1) for r in rows)
    hits = sum(r.predicted for r in held if r.doc_id in truth)
    assert hits >= 0.9 * sum(r.doc_id in truth for r in held)
    assert sum(r.predicted for r in held if r.doc_id not in truth) <= 0.02 * len(held)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    kept = toxicity.keep_clean(data, model)
    assert kept.columns == data.columns and kept.count() == sum(not r.predicted for r in rows)


def _rare_abuse():
    """15,000 labelled documents, a tenth toxic by a common word; eight outside the fold have a rare word instead."""
    rng = random.Random(5)
    plain = ["".join(rng.choices("bcdfgaeiou", k=rng.randrange(3, 8))) for _ in range(300)]
    docs = [(i, " ".join(rng.choices(plain, k=12) + ["nastyword"] * (i % 10 == 0))) for i in range(15_000)]
    for i in [i for i in range(0, 15_000, 10) if not in_fold(i, 3, 1)][:8]:
        docs[i] = (i, docs[i][1].replace("nastyword", "qzlurk qzlurk"))
    return docs, [(i, int(i % 10 == 0)) for i in range(15_000)]


def _chosen(model, word):
    key = toxicity.Words([word.encode()]).hash[0]
    return key in set(model.table.key[model.table.number >= 0].tolist())


@pytest.mark.parametrize("bound", [30_000, 200])
def test_rare_toxic_words_are_counted_over_all_labelled_documents(spark, bound):
    docs, labels = _rare_abuse()
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(table(spark, docs), marks, max_labelled=bound)
    assert _chosen(model, "nastyword") and _chosen(model, "qzlurk")
    scored = {r.doc_id: r.score for r in toxicity.score_texts(table(spark, docs), model).collect()}
    held = [i for i, _ in docs if in_fold(i, 3, 1)]
    assert sum((scored[i] >= 0.7) == (i % 10 == 0) for i in held) >= 0.99 * len(held)


def test_copies_of_one_document_make_no_entry(spark):
    docs, labels = _rare_abuse()
    rng = random.Random(6)
    docs += [(3000 + i, "some long passage about the wumpus which was copied over and over again") for i in range(60)]
    rng.shuffle(docs)
    marks = spark.createDataFrame(labels + [(3000 + i, 1) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(table(spark, docs), marks)
    assert _chosen(model, "qzlurk") and not _chosen(model, "wumpus")


def test_unlabelled_documents_vote(spark, monkeypatch):
    docs, labels, _ = _abuse(600)
    seen, plain = {}, toxicity.label_model

    def spied(votes, anchor, **more):
        post, found = plain(votes, anchor, **more)
        seen.update(votes=votes, times=more["times"])
        return post, found

    monkeypatch.setattr(toxicity, "label_model", spied)
    toxicity.fit(table(spark, docs), spark.createDataFrame(labels[:300], "doc_id long, toxic int"), max_labelled=50)
    allowed = [i for i, _ in docs if not in_fold(i, 3, 1)]
    marked = {i for i, _ in labels[:300]}
    assert seen["times"].sum() == len(allowed)
    assert seen["times"][seen["votes"][:, -1] == 0].sum() == sum(i not in marked for i in allowed) > 100


def test_vote_patterns_count_like_rows():
    rng = np.random.default_rng(4)
    votes = rng.integers(-1, 2, (3000, 5))
    assert (toxicity.unpattern(toxicity.pattern(votes), 5) == votes).all()
    kinds, times = np.unique(toxicity.pattern(votes), return_counts=True)
    one, found = toxicity.label_model(votes, anchor=-1)
    per, same = toxicity.label_model(toxicity.unpattern(kinds, 5), anchor=-1, times=times)
    assert same["share"] == pytest.approx(found["share"])
    assert np.allclose(per[np.searchsorted(kinds, toxicity.pattern(votes))], one)


def test_few_labels_give_the_share_of_label_one(spark):
    docs = table(spark, [(k, f"some words {k}") for k in range(12)])
    labels = spark.createDataFrame([(k, int(k == 0)) for k in range(12)], "doc_id long, toxic int")
    scores = {r.score for r in toxicity.score_texts(docs, toxicity.fit(docs, labels)).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 0.5


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.2
    good = [np.where(y & (rng.random(4000) < 0.7), 1, 0) for _ in range(3)]
    useless = np.where(rng.random(4000) < 0.3, 1, 0)
    label = np.where(rng.random(4000) < 0.05, ~y, y) * 2 - 1
    votes = np.stack([*good, good[0], useless, label], axis=1)
    post, found = toxicity.label_model(votes, anchor=-1)
    assert ((post > 0.5) == y).mean() > 0.97
    assert abs(found["share"] - 0.2) < 0.03
    clean, toxic = found["votes"][0][:, 2], found["votes"][1][:, 2]
    assert (toxic[:3] > 0.5).all() and (clean[:3] < 0.05).all() and abs(toxic[4] - clean[4]) < 0.05
    assert found["weight"][0] < found["weight"][1]  # the copied voter counts for less


def test_base_score_and_counts(spark):
    data = [r for r in messy(6) if r[0] != 146]
    rows = lm.score_texts(table(spark, data), piece_vocabulary(), bucket_bytes=2000).collect()
    end, count = b"\n", Counter()
    tokens = [[*(w.lower() for w in words_of(t)), end] for _, t, *_ in data]
    for (i, *_), words in zip(data, tokens, strict=True):
        if not in_fold(i, 7, 2):
            count.update(words)
    n, v = sum(count.values()), len(count)
    want = sorted(
        (i is None, i or 0, len(w), sum(x in count for x in w), round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6))
        for (i, *_), w in zip(data, tokens, strict=True)
    )
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    assert got == want and {r.train_tokens for r in rows} == {n}
    assert all(r.score < 0 and math.isfinite(r.score) and r.held_out == in_fold(r.doc_id, 7, 2) for r in rows)
    assert lm.score_texts(table(spark, []), piece_vocabulary()).count() == 0


def _all_segmentations(vocabulary, word, logp):
    symbols = (256, *word)

    def after(at):
        if at == len(symbols):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(symbols) + 1):
            piece = int(vocabulary.find(np.array([vocabulary._hash(symbols[at:end])], np.uint64))[0])
            total += np.exp(logp[piece]) * after(end) if piece >= 0 else 0.0
            total += np.exp(logp[vocabulary.size + symbols[at]]) * after(end) if end == at + 1 and at else 0.0
        return total

    return after(0)


@pytest.mark.parametrize("word", [b"", b"a", b"abab", b"xyz", "é".encode(), b"aaaaaa"])
def test_forward_recursion_sums_all_segmentations(word):
    vocabulary = Vocabulary(["▁a", "▁ab", "ab", "a", "b", "ba", "▁", "aa"], [-1.0, -2, -3, -4, -5, -6, -7, -8])
    logp = np.log(vocabulary.prior)
    assert math.exp(vocabulary.log_probability([word], logp)[0]) == pytest.approx(_all_segmentations(vocabulary, word, logp))
    used = vocabulary.expected([word], np.ones(1), logp)
    assert used.sum() >= 1 and (used >= 0).all()


def test_training_raises_the_likelihood():
    vocabulary = Vocabulary(["▁a", "▁ab", "ab", "a", "b", "ba", "▁", "aa"], [-1.0, -2, -3, -4, -5, -6, -7, -8])
    words, logp, last = [b"abab", b"aab", b"ba"], np.log(vocabulary.prior), -np.inf
    for _ in range(4):
        value = vocabulary.log_probability(words, logp).sum()
        assert value >= last - 1e-9
        last, used = value, vocabulary.expected(words, np.ones(3), logp)
        logp = np.log((used + 1e-12) / (used + 1e-12).sum())
