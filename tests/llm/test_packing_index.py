"""The index of a shard: common terms laid out, used documents forgotten, terms by
sorting; scores and orders stay those of the plain sums."""

import numpy as np

from flowforge.llm import packing as P


def _docs(n=120, seed=3):
    rng = np.random.default_rng(seed)
    docs = [np.concatenate([rng.integers(0, 30, 40), rng.integers(30, 5000, int(k))]).astype(np.uint16)
            for k in rng.integers(0, 300, n)]
    return [*docs, np.zeros(0, np.uint16), docs[0], np.full(P.Terms.LONG + 5, 7, np.uint16)]


def test_terms_of_short_and_long_documents():
    for ids in [*_docs(), np.random.default_rng(0).integers(0, 1 << 16, 3 * P.Terms.LONG).astype(np.uint16)]:
        want, n = np.unique(ids, return_counts=True)
        terms, counts = P.Terms().counted(ids)
        assert terms.tolist() == want.tolist() == P.Terms().of(ids).tolist() and counts.tolist() == n.tolist()


def test_scores_of_documents_that_are_left():
    docs = _docs()
    df = np.zeros(P.VOCABULARY)
    for d in docs:
        df[np.unique(d)] += 1
    idf = np.log1p((len(docs) - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = np.mean([len(d) for d in docs])
    index = P.Index(docs, idf, mean)
    assert 0 < len(index.rows) < len(np.flatnonzero(df))  # some terms are common, others are not

    def plain(seed):
        out = np.zeros(len(docs))
        for i, d in enumerate(docs):
            tf = np.bincount(d, minlength=P.VOCABULARY)
            t = np.intersect1d(np.unique(docs[seed]), np.unique(d))
            out[i] = (idf[t] * tf[t] * (P.K1 + 1) / (tf[t] + P.K1 * (1 - P.B + P.B * len(d) / mean))).sum()
        return out

    used = np.zeros(len(docs), bool)
    for seed in (0, 50, len(docs) - 2, len(docs) - 1):
        assert np.allclose(index.scores(seed)[~used], plain(seed)[~used], rtol=1e-5)
        used[seed::7] = True
        held = len(index.post_doc) + index.rows.size
        index.forget(used)
        assert len(index.post_doc) + index.rows.size < held  # a later seed does not meet them again
    index.forget(np.ones(len(docs), bool))
    assert not index.scores(5).any()
