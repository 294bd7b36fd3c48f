"""The threshold walk's scores: doubles while they are exact, integers beyond."""
import numpy as np

from touchline.llm import topk


def brute(ids, vectors, query_id, q, k):
    scores = [(-sum(int(a) * int(b) for a, b in zip(v, q, strict=True)), int(i)) for i, v in zip(ids, vectors, strict=True) if i != query_id]
    return [(-s, i) for s, i in sorted(scores)[:k]]


def test_scores_are_exact_on_both_sides_of_two_to_the_53():
    r = np.random.default_rng(3)
    ids = r.permutation(200)
    for scale, few in ((1, 3), (1, 500), (2 ** 24, 30), (2 ** 25, 3)):
        v = r.integers(-few, few + 1, (200, 6)) * scale + r.integers(0, 2, (200, 6))
        part = topk.Lists(ids, v)
        for i in range(0, 200, 20):
            assert part.top(int(ids[i]), v[i], 4) == brute(ids, v, ids[i], v[i], 4)
        order = np.argsort(ids, kind="stable")
        assert part.scores(np.arange(200), v[0]).tolist() == [sum(int(a) * int(b) for a, b in zip(x, v[0], strict=True)) for x in v[order]]
