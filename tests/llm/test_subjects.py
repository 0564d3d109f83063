import random

import numpy as np
import pytest

from tidemark.llm.subjects import MASS, _Reader, factor, sentences, solve, solved, subject_sentences
from tidemark.sources.tables import table


def test_sentences():
    assert sentences(None) == sentences("") == sentences(" . ! ") == []
    s = sentences("<p>The ward was full. Item 5. ABCD closed at 3.5 today!\nEl paciente mejora hoy</p>")
    assert [x[0] for x in s] == ["the", "closed", "el"] and "the ward" in s[0] and "closed at" in s[1] and "abcd closed" not in s[1]
    assert len(sentences("one two three. " * 20_000)) == 20_000
    assert "all caps" in sentences("ALL CAPS HERE.")[0]


def test_updates_never_raise_the_divergence():
    rng = np.random.default_rng(0)
    keys = [tuple(rng.integers(0, 40, rng.integers(1, 9)).tolist()) for _ in range(30)]
    h = rng.random((4, 40))
    h /= h.sum(axis=1, keepdims=True)
    last = np.inf
    for rounds in (1, 2, 5, 20, 60):
        w = solve(h, keys, rounds, 0)
        d = w.sum() - sum(np.log(w[i] @ h[:, j]) for i, k in enumerate(keys) for j in k)
        assert d <= last + 1e-9
        last = d
    assert w.sum(axis=1) == pytest.approx([len(k) for k in keys])


def test_a_sentence_is_solved_alike_in_any_company():
    rng = np.random.default_rng(1)
    keys = [tuple(rng.integers(0, 60, rng.integers(1, 12)).tolist()) for _ in range(200)]
    h = rng.random((6, 60)) ** 4
    h /= h.sum(axis=1, keepdims=True)
    w, rests = solved(h, keys)
    assert rests.all()
    for i in (0, 17, 99, 199):
        assert np.allclose(solve(h, [keys[i]])[0], w[i], atol=1e-9)
        assert np.allclose(solve(h, keys[i : i + 20])[0], w[i], atol=1e-9)
    # decided as if solved to the end
    reader = _Reader([f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)], h, 5)
    names = list(reader.voc)
    texts = [" ".join([names[i] for i in k] + ["x", "y", "z"]) for k in keys]
    far = solve(h, [tuple(sorted(k)) for k in keys], 100_000, 1e-9)[:, :5]
    got = [x[0] for x in reader.read(texts)[0]]
    assert got == [int(m.argmax()) if m.max() >= MASS else -1 for m in far] and len(set(got)) > 3
    assert not solved(h, keys, rounds=2)[1].all()


def test_mixtures_of_made_up_subjects():
    r = random.Random(0)
    words = {k: [f"{k}{c}" for c in "abcdefgh"] for k in ("law", "sea", "sun")}
    filler = [f"the{c}" for c in "abcdefghij"]

    def sentence(k):
        own = r.sample(words[k], 3) if k else []
        x = own + r.sample(filler, 4)
        r.shuffle(x)
        return x

    subjects = list(words)
    docs = []
    for _ in range(200):
        own = set(r.sample(range(3), r.choice([1, 1, 2])))
        s = [sentence(subjects[k]) for k in own for _ in range(3)] + [sentence(None) for _ in range(4)]
        docs.append((s, {(k + 1) % 3 for k in own} if r.random() < 0.03 else own))  # a few wrong labels
    terms, h = factor(docs, 3)
    reader = _Reader(terms, h, 3)
    assert all((h[k] > 0).sum() >= 8 for k in range(3))
    voc = reader.voc
    for k in (0, 1, 2, -1):
        for _ in range(20):
            ids = [voc[x] for x in sentence(subjects[k] if k >= 0 else None) if x in voc]
            m = solve(h, [tuple(ids)])[0, :3]
            assert (int(m.argmax()) if m.max() >= MASS else -1) == k


SCHEMA = "doc_id bigint, text string, found string"
AREAS = [("law", "courts and judges"), ("sea", "ships and harbours")]


def run(spark, docs, labels):
    d, l = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, subject string")
    return {r.doc_id: (r.n_sentences, r.found) for r in subject_sentences(d, l, spark.createDataFrame(AREAS, "subject string, description string")).collect()}


def test_one_sentence_counts_in_short_texts_only(spark):
    law, sea, chat = "Judges overturned the old ruling here.", "Sailors towed the grey tanker home.", "Prices moved a bit today again."
    docs = [(i, " ".join([law] * 3 + [chat] * 5), "x") for i in range(20)] + [(i, " ".join([sea] * 3 + [chat] * 5), None) for i in range(20, 40)]
    docs += [(100, law, ""), (101, " ".join([chat] * 5 + [law]), ""), (102, " ".join([chat] * 5 + [law] * 2), ""), (103, "", ""), (104, None, ""), (105, f"{law} {sea} {chat}", ""), (106, chat, ""), (107, (chat + " ") * 9000 + law + " " + law, "")]
    labels = [(i, "law") for i in range(20)] + [(i, "sea") for i in range(20, 40)] + [(0, "law"), (999, "law"), (1, "unknown")]
    out = run(spark, docs, labels)
    assert out[100] == (1, ["law"]) and out[101] == (6, []) and out[102] == (7, ["law"]) and out[103] == out[104] == (0, [])
    assert out[105] == (3, ["law", "sea"]) and out[106] == (1, []) and out[107] == (9002, ["law"]) and out[0] == (8, ["law"])


def test_empty_tables(spark):
    assert run(spark, [], []) == {}
    assert run(spark, [(1, "Some words here.", "")], [])[1] == (1, [])


def test_held_out_labels(spark):
    """Fitted on half of the labelled documents, measured on the rest; a few labels are wrong."""
    sf = "/root/testdata/sf0.1"
    docs, labels, areas = (table(spark, sf, x) for x in ("documents", "doc_labels", "subject_areas"))
    got = subject_sentences(docs.join(labels, "doc_id", "left_semi"), labels.filter("doc_id % 2 = 0"), areas)
    pred = {(r.doc_id, s) for r in got.filter("doc_id % 2 = 1").collect() for s in r.found}
    true = {(r.doc_id, r.subject) for r in labels.filter("doc_id % 2 = 1").collect()}
    hit = len(pred & true)
    assert hit / len(pred) > 0.94 and hit / len(true) > 0.94
