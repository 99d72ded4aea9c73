"""Units of several lengths that go through the arrays together."""

import random

import numpy as np

from lotledger.llm import nbest_pieces as NP


def test_lengths_share_a_pass(vocabulary, monkeypatch):
    rng = random.Random(8)
    names = sorted({" " + "".join(rng.choices("aeinrsté\U0001f600", k=rng.randint(1, 20))) for _ in range(1500)})
    names += [" " + "long" * 20, " " + "\x00a"]
    rng.shuffle(names)
    encoder, passes = NP.Encoder(vocabulary, 4), []
    run = NP.Encoder._viterbi
    monkeypatch.setattr(NP.Encoder, "_viterbi", lambda self, *a: passes.append(1) or run(self, *a))
    encoder.prepare(set(names))
    assert len(passes) == 1
    for name in names:
        score, gap, ids = encoder.cache[name]
        best = NP.lattice_nbest(name, vocabulary, 2)
        assert abs(score - best[0][0]) < 1e-9
        assert abs(gap - (best[0][0] - best[1][0])) < 1e-9 if len(best) > 1 else gap == np.inf
        assert b"".join(vocabulary.bytes_of[i] for i in ids) == name.encode()


def test_known_units_keep_their_rows(vocabulary):
    known = NP.Known(NP.Encoder(vocabulary, 4))
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(300)]
    seen = {}
    for _ in range(6):
        units = NP.Units([" ".join(rng.choices(words, k=80)) for _ in range(5)])
        for key, row, at in zip(units.key.tolist(), known.rows(units).tolist(), units.shown.tolist()):
            assert seen.setdefault(key, row) == row
            name, c = units.text(at), known.columns
            ids = known.pool[c["begin"][row]: c["begin"][row] + c["size"][row]].tolist()
            assert b"".join(known.encoder.vocabulary.bytes_of[i] for i in ids) == name.encode() and c["exact"][row]
            assert abs(c["score"][row] - NP.lattice_nbest(name, vocabulary, 1)[0][0]) < 1e-9
    assert sorted(seen.values()) == list(range(len(seen)))
