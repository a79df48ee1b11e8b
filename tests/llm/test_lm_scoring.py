import math
from collections import Counter

import numpy as np
import pyarrow as pa

from seasonmart.llm import lm_scoring, masked_model
from seasonmart.llm.lm_scoring import fit_model, lm_scores, token_scores, vocabulary, with_log_probability, word_counts
from seasonmart.llm.masked_model import (
    CLASSES,
    FREQUENT,
    OFFSETS,
    PAD,
    RADIUS,
    MaskedModel,
    Tokens,
    Trainer,
    examples,
    text_scores,
)
from tests.llm.conftest import ODD_ROWS


def plain_score(model, tokens):
    """Each token's log-probability from both sides, with loops."""
    line, total = [PAD] * RADIUS + list(tokens) + [PAD] * RADIUS, 0.0
    for at in range(RADIUS, len(line) - RADIUS):
        state = sum(model.inputs[i][line[at + o]].astype(float) for i, o in enumerate(OFFSETS))
        logits = np.tanh(state) @ model.outputs.astype(float) + model.bias
        total += logits[line[at]] - math.log(np.exp(logits).sum())
    return total


def test_scores_equal_plain_loops(prose):
    words = [w for w, _ in Counter(prose(400).split()).most_common(50)]
    tokens, model = Tokens(words), MaskedModel.start(3)
    texts = [tokens.of(prose(n)) for n in (0, 1, 2, 30)] + [b""]
    assert np.allclose(text_scores(model, texts), [plain_score(model, t) for t in texts], rtol=1e-4, atol=1e-4)


def test_gradient():
    rng = np.random.default_rng(1)
    model = MaskedModel.start()
    text = [bytes(rng.integers(0, PAD, 50).astype(np.uint8))]
    target, context = examples(text)
    trainer = Trainer(model, rate=1.0)
    trainer.squares = [np.full_like(x, 1e12) for x in trainer.squares]  # plain steps of slope / 1e6
    trainer.step(target, context)
    for name, at in (("outputs", (3, target[0])), ("bias", (target[1],)), ("inputs", (0, int(context[5, 0]), 2))):
        slope = (getattr(model, name)[at].astype(float) - getattr(trainer.model, name)[at].astype(float)) * 1e6
        losses = []
        for step in (-1e-2, 1e-2):
            values = {k: getattr(model, k).astype(np.float64) for k in ("inputs", "outputs", "bias")}
            values[name][at] += step
            losses.append(-plain_score(MaskedModel(**values), text[0]) / 50)
        assert np.isclose(slope, (losses[1] - losses[0]) / 2e-2, rtol=0.1, atol=2e-2)


def test_words_are_those_of_split():
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = ["", None, " ", "one", "\u200bnot white\ufeff", "ÄÖ 日本 😀  end\r\n", *(f"{c}a{c}{c}b c{c}" for c in spaces)]
    words, sizes = lm_scoring.split_words(pa.array(texts, pa.string()))
    expected = [(t or "").split() for t in texts]
    assert words.to_pylist() == [w for found in expected for w in found] and sizes.tolist() == list(map(len, expected))


def test_a_batch_has_the_classes_of_its_texts():
    tokens = Tokens(["a", "the"])
    asked, classes = [], tokens.classes
    tokens.classes = lambda words: asked.append(len(words)) or classes(words)
    texts = [" a the other ", "", None, "a a a thing", "\n"] * 20
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    found = list(lm_scoring._groups([batch, batch.slice(0, 0)], tokens))
    assert asked == [4]  # each different word once
    assert found == [[classes((t or "").split()) for t in texts]]


def test_counts_are_handed_on(monkeypatch):
    monkeypatch.setattr(lm_scoring, "COUNTED", 3)
    texts = [f"often w{i % 9} w{i} often " for i in range(50)] + [None, ""]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array([t], pa.string())}) for t in texts]
    found, rows = Counter(), list(lm_scoring._count_words(iter(batches)))
    for batch in rows:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            found[word] += n
    assert found == Counter(" ".join(t or "" for t in texts).split()) and len(rows) > 5
    assert max(batch.num_rows for batch in rows) < 12
    assert sum(b.num_rows for b in lm_scoring._count_words(iter([]))) == 0


def test_counts_cover_all_documents(documents, monkeypatch):
    monkeypatch.setattr(lm_scoring, "COUNTED", 2)
    found = {r.word: r.n for r in word_counts(documents(ODD_ROWS).repartition(4)).collect()}
    assert found == Counter(w for _, t in ODD_ROWS for w in (t or "").split())


def test_classes():
    tokens = Tokens(["a", "b"])
    assert list(tokens.of("a b a")) == [0, 1, 0]
    rare = tokens.of("xyz wyz other")
    assert rare[0] == rare[1] and all(FREQUENT <= c < PAD for c in rare)
    assert CLASSES - 1 == PAD


def test_text_in_order_scores_higher_than_shuffled(documents, prose):
    rng = np.random.default_rng(2)
    line = "the cat sat on a mat and the dog ran to a tree".split()
    rows = [(i, " ".join(line * 30)) for i in range(40)]
    docs = documents(rows).repartition(3)
    words = vocabulary(docs)
    model = fit_model(docs, words)
    mixed = documents([(1, " ".join(line * 5)), (2, " ".join(rng.permutation(line * 5)))])
    found = {r.doc_id: r._n_tokens and r.log_prob for r in with_log_probability(mixed, words, model).collect()}
    assert found[1] > found[2] + 20


def test_odd_rows(documents):
    found = lm_scores(documents(ODD_ROWS)).collect()
    assert len(found) == len(ODD_ROWS)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[1].n_tokens, by_id[1].log_prob, by_id[1].mean_log_prob) == (0, 0.0, None)
    assert by_id[3].n_tokens == 0 and by_id[7].n_tokens == 1 and by_id[8].n_tokens == 20_000
    assert np.allclose([r.log_prob for r in found if r.doc_id == 6], by_id[5].log_prob) and by_id[5].log_prob < 0
    assert lm_scores(documents([])).collect() == []


def test_words_count_within_their_classes(documents, prose, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_WORDS", 30)
    texts = [(i, prose(40 + i) + " ä 日本") for i in range(20)] + [(20, None), (21, "")]
    docs = documents(texts).repartition(3)
    counts, model = word_counts(docs), MaskedModel.start(3)
    seen = {r.word: r.n for r in counts.collect()}
    words = sorted(seen, key=lambda w: (-seen[w], w))[:10]
    tokens, sums = Tokens(words), Counter()
    for word, n in seen.items():
        sums[tokens[word]] += n
    more = docs.union(documents([(22, "zzz unseenka " + texts[0][1])]))

    def within(text):
        return sum(math.log(seen.get(w, 1) / (sums[tokens[w]] + 1)) for w in text.split() if w not in words)

    classes = {r.doc_id: r.log_prob for r in with_log_probability(more.select("doc_id", "text"), words, model).collect()}
    found = token_scores(more, words, model, counts).collect()
    assert sorted(r.doc_id for r in found) == list(range(23))
    text = {**dict(texts), 22: "zzz unseenka " + texts[0][1]}
    for r in found:
        assert np.isclose(r.log_prob, classes[r.doc_id] + within(text[r.doc_id] or ""), rtol=1e-6, atol=1e-6)
        assert r.n_tokens == len((text[r.doc_id] or "").split())


def test_rare_words_with_the_same_ending_differ(documents):
    # 191 common words, then a word of 60 documents and one of a single document in the same class.
    common = " ".join(f"w{i}" for i in range(FREQUENT)) + " "
    rows = [(i, common * 70 + "planetka") for i in range(60)] + [(60, common * 70 + "qxqxka")]
    found = {r.doc_id: r.log_prob for r in lm_scores(documents(rows)).collect()}
    assert abs(found[0] - found[60] - math.log(60)) < 0.1


def test_a_step_keeps_its_numbers_in_the_cache(monkeypatch):
    # The numbers of all classes of a step's 4,096 tokens are 4 MB; a block's are an eighth.
    rng = np.random.default_rng(4)
    target, context = examples([bytes(rng.integers(0, PAD, 4_000).astype(np.uint8))])
    trained, taken = [], []
    real = np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: (taken.append(x.size), real(x, *a, **k))[1])
    for block in (masked_model.BLOCK, 4_000):
        monkeypatch.setattr(masked_model, "BLOCK", block)
        trainer = Trainer(MaskedModel.start(5))
        trainer.step(target, context)
        trainer.model.log_probabilities(target, context)
        trained.append(trainer.model.flat())
        assert max(taken) == block * CLASSES
    assert np.allclose(trained[0], trained[1], rtol=1e-4, atol=1e-5)


def test_large_logits_neither_overflow_nor_lose_a_token():
    model = MaskedModel.start(6)
    model = MaskedModel(model.inputs, model.outputs * 200, model.bias + np.linspace(-60, 60, CLASSES, dtype=np.float32))
    tokens = bytes(range(0, 250, 5))
    assert np.isclose(text_scores(model, [tokens])[0], plain_score(model, tokens), rtol=1e-4)
    trainer = Trainer(model)
    trainer.step(*examples([tokens]))
    assert np.isfinite(trainer.model.flat()).all()
