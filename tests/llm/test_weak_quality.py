import numpy as np

from millrace.llm.weak_quality import BAD, GOOD, LABELLERS, Block, fit_label_model, fit_quality, pattern_of, pattern_votes, score_quality, votes_of, weak_votes


def block_of(texts):
    raw = [t.encode() for t in texts]
    return Block(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))


def test_statistics_of_small_texts():
    texts = ["ab ab ab cd", "A!! | b%% c", "", "one two three one two three"]
    got = {n: block_of(texts).statistics()[:, k] for k, (n, _, _) in enumerate(LABELLERS)}
    assert got["stutter"].tolist() == [0.5, 0, 0, 0]
    assert got["bars"].tolist() == [0, 0.25, 0, 0] and got["listed"].tolist() == [0, 0.5, 0, 0]
    assert got["marked_words"][1] == 0.5 and got["shouts"][1] == 0.5 and got["capitals"][1] == 1 / 3
    assert got["repeated_trios"].tolist() == [0, 0, 0, 0.25]
    assert np.allclose(got["odd_marks"], [0, 2 / 11, 0, 0])


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.85
    votes = np.where(rng.random((20_000, len(LABELLERS))) < 0.01, BAD, GOOD)
    caught = rng.random((20_000, len(LABELLERS))) < 0.6
    votes[~good] = np.where(caught[~good], BAD, GOOD)
    patterns, counts = np.unique(pattern_of(votes), return_counts=True)
    assert (pattern_votes(pattern_of(votes)) == votes).all()
    model = fit_label_model(patterns, counts)
    assert abs(model.good_share - good.mean()) < 0.02
    assert np.abs(model.chances[:, BAD, BAD] - 0.6).max() < 0.05
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.99


def brute_em(rows, rounds):
    """Every document on its own, every sum by hand; the documented prior on votes and on false alarms."""
    n, k, start = len(rows), len(LABELLERS), {GOOD: [0.80, 0.004, 0.196], BAD: [0.45, 0.35, 0.20]}
    share, chance = 0.8, [{c: list(start[c]) for c in (GOOD, BAD)} for _ in range(k)]
    p = []
    for _ in range(rounds + 1):
        p = []
        for votes in rows:
            a, b = share, 1 - share
            for j, v in enumerate(votes):
                a, b = a * chance[j][GOOD][v], b * chance[j][BAD][v]
            p.append(a / (a + b))
        mass = {GOOD: sum(p), BAD: n - sum(p)}
        share, before = (mass[GOOD] + 1) / (n + 2), (share, chance)
        chance = []
        for j in range(k):
            new = {c: [(sum(q if c == GOOD else 1 - q for q, votes in zip(p, rows) if votes[j] == v) + start[c][v]) / (mass[c] + 1) for v in range(3)] for c in (GOOD, BAD)}
            alarm = (new[GOOD][BAD] * mass[GOOD] + start[GOOD][BAD] * n) / (mass[GOOD] + n)
            others = [v for v in range(3) if v != BAD]
            rest = sum(new[GOOD][v] for v in others)
            new[GOOD] = [alarm if v == BAD else new[GOOD][v] / rest * (1 - alarm) for v in range(3)]
            chance.append(new)
    return before, p


def test_em_equals_a_document_by_document_version():
    rng = np.random.default_rng(7)
    bad = rng.random(150) < 0.3
    votes = np.where(rng.random((150, len(LABELLERS))) < np.where(bad, 0.5, 0.02)[:, None], BAD, rng.choice([v for v in range(3) if v != BAD], (150, len(LABELLERS))))
    patterns, counts = np.unique(pattern_of(votes), return_counts=True)
    for rounds in (1, 6):
        model = fit_label_model(patterns, counts, rounds=rounds)
        (share, chance), posterior = brute_em(votes.tolist(), rounds)
        assert abs(model.good_share - share) < 1e-9
        assert np.allclose(model.chances, [[c[GOOD], c[BAD]] for c in chance]) and np.allclose(model.posterior(votes), posterior)


def test_scores_against_a_sum_over_words(spark):
    docs, _ = corpus(spark, 60)
    model = fit_quality(docs, most_fitted=40)
    texts = [r["text"] for r in docs.collect()[:10]]
    for t in texts:
        whole = block_of([t])
        doc, feature = whole.features()
        z = model.bias + sum(model.weights[f] for f in feature.tolist()) / max(1, int(whole.n_words[0]))
        assert abs(model.scores(block_of([*texts, t]))[-1] - 1 / (1 + np.exp(-z))) < 1e-9


def corpus(spark, n=300):
    rng = np.random.default_rng(1)
    words = ["tree", "Lamp", "green,", "over", "the", "house.", "river", "stone", "quiet", "walks", "into", "evening."]
    rows = []
    for i in range(n):
        w = rng.choice(words, 120).tolist()
        kind = i % 10
        if kind == 0:
            w = [x + "%%%" for x in w]
        elif kind == 1:
            w = [x.upper() + "!!" for x in w]
        elif kind == 2:
            w = [y for x in w for y in (x, "|")]
        rows.append((i, " ".join(w), int(kind > 2)))
    return spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows], "doc_id long, text string, score double"), {i: g for i, _, g in rows}


def test_scores_hold_on_unseen_documents(spark):
    docs, truth = corpus(spark)
    model = fit_quality(docs.where("doc_id % 3 > 0"), most_fitted=150)
    got = score_quality(docs, model).collect()
    held = [r for r in got if r["doc_id"] % 3 == 0]
    assert np.mean([r["keep"] == bool(truth[r["doc_id"]]) for r in held]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "stone river " * 50_000), (3, "stone river " * 50_000)], "doc_id long, text string")
    rows = score_quality(odd, model).orderBy("doc_id").collect()
    assert len(rows) == 4 and rows[0]["score"] == rows[1]["score"] == 0.0
    assert score_quality(docs.limit(0), fit_quality(docs.limit(0))).count() == 0


def test_votes_cover_every_row(spark):
    docs, _ = corpus(spark, 40)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["votes"] for r in weak_votes(docs).collect()}
    assert got == {i: int(pattern_of(votes_of(block_of([t]).statistics()))[0]) for i, t in texts.items()}
