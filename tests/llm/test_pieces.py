"""The encoder's lattice in blocks against the fold of single words."""

import random

import numpy as np

from epigrid.llm import pieces


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def edges_of(word, vocab, table):
    """The lattice of one word as numbers, by start, then end."""
    out = []
    for s in range(len(word)):
        for n in range(1, min(vocab.longest, len(word) - s) + 1):
            i = table.get(word[s:s + n], pieces.CHARACTER + ord(word[s]) if n == 1 else None)
            if i is not None:
                out.append((s + n << 40) + (s << 24) + i)
    return out


def test_blocks_of_words_like_single_ones():
    vocab = pieces.Vocabulary()
    table = {p: i for p, i, _ in vocab.rows}
    fold = pieces.Fold(vocab.rows, vocab.fallback, vocab.byte_id)
    scores = np.array([*vocab.scores, vocab.fallback])
    rng = random.Random(3)
    words = ["".join(rng.choice("abeinrst" if k % 3 else "eé漢😀▁x") for _ in range(rng.randint(1, 1 + k % 40))) for k in range(400)] + ["the" * 64]
    for size in (1, 7, len(words)):
        for k in range(0, len(words), size):
            block = words[k: k + size]
            e = [edges_of(w, vocab, table) for w in block]
            first = np.cumsum([0] + [len(x) for x in e])[:-1]
            ids, count = pieces.spelled(*pieces.viterbi(first, np.array(sum(e, []), np.int64), scores), vocab.byte_id)
            assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == [fold(w).tolist() for w in block]


def test_encoder_plan_and_ids(spark):
    vocab = pieces.Vocabulary()
    fold = pieces.Fold(vocab.rows, vocab.fallback, vocab.byte_id)
    rng = random.Random(5)
    letters = "abcdeghilmnorstuéß漢😀"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts += ["", None, " lead", "two  gaps", "▁ a▁b ▁▁", "tail ", "z" * 200 + " z " + "y" * 193, "same", "same"]
    got = pieces.encode(docs_of(spark, texts))
    plan = got._jdf.queryExecution().toString()
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan       # edges are neither shuffled nor folded row by row
    for r in got.collect():
        want = []
        for key in pieces.words_of(texts[r.doc_id] or ""):
            want += [vocab.byte_id[b] for b in key.encode()] if key == pieces.SPACE else fold(pieces.lattice_word(key)).tolist()
        assert r.token_ids == want and r.n_tokens == len(want) and r.round_trip, texts[r.doc_id]
