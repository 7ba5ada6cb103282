"""Log-probabilities and gradients against plain formulas, what training gains, and rows out of the ordinary."""

import re

import numpy as np
import pyarrow as pa
import pytest

from tidegrid.llm import pseudolm as lm


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    network, words = lm.train(docs)
    return network, [np.frombuffer(bytes(r["words"]), "<u2") for r in words.limit(200).collect()], words


def plainly(net, line, k):
    offsets = [o for o in range(-lm.REACH, lm.REACH + 1) if o]
    h = np.tanh(sum(net.near[j][line[k + o]] for j, o in enumerate(offsets)) + net.base)
    c, i = divmod(int(line[k]), lm.PER_CLASS)
    a = h @ net.to_class + net.class_bias
    b = h @ net.to_word[c] + net.word_bias[c]
    return a[c] - np.log(np.exp(a).sum()) + b[i] - np.log(np.exp(b).sum())


def test_log_probabilities_equal_the_formula(trained):
    net, arrays, _ = trained
    line, places, _ = lm.padded(arrays[:20])
    got = net.log_probabilities(line[places], lm.windows(line, places))
    assert np.allclose(got, [plainly(net, line, k) for k in places], atol=1e-4)


def test_probabilities_add_up_to_one(trained):
    net, arrays, _ = trained
    line, places, _ = lm.padded(arrays[:1])
    around = np.repeat(lm.windows(line, places[:1]), lm.WORDS, axis=0)
    assert abs(np.exp(net.log_probabilities(np.arange(lm.WORDS), around)).sum() - 1) < 1e-4


def test_scores_of_documents_are_sums_over_their_words(trained):
    net, _, words = trained
    rows = {r["doc_id"]: np.frombuffer(bytes(r["words"]), "<u2") for r in words.collect()}
    for r in lm.score(words, net).limit(60).collect():
        line, places, _ = lm.padded([rows[r["doc_id"]]])
        assert r["n_words"] == len(places)
        assert r["score"] == pytest.approx(net.log_probabilities(line[places], lm.windows(line, places)).sum(), rel=1e-4)


def test_training_beats_frequencies_and_order_matters(trained):
    net, arrays, _ = trained

    def mean(model, some):
        line, places, _ = lm.padded(some)
        return model.log_probabilities(line[places], lm.windows(line, places)).mean()

    frequencies = lm.Network.start(np.bincount(np.concatenate(arrays), minlength=lm.WORDS))
    rng = np.random.default_rng(0)
    assert mean(net, arrays) > mean(frequencies, arrays) + 0.1
    assert mean(net, arrays) > mean(net, [rng.permutation(a) for a in arrays]) + 0.05


def test_a_step_climbs_along_the_gradient():
    rng = np.random.default_rng(3)
    net = lm.Network.start(rng.random(lm.WORDS) * 50)
    for p in net.parts():
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.1
    words, around = rng.integers(0, lm.WORDS, 64), rng.integers(0, lm.WORDS + 1, (64, 2 * lm.REACH))
    seen = [np.zeros_like(p) for p in net.parts()]
    before = net.flat().astype(np.float64)
    net.step(words, around, seen)
    # of the first step, Adagrad leaves the sign and the squares the size of the slope
    slope = np.sqrt(np.concatenate([s.ravel() for s in seen])) * np.sign(net.flat() - before)
    for at in rng.choice(np.flatnonzero(slope), 25):
        ends = []
        for d in (1e-3, -1e-3):
            moved = before.copy()
            moved[at] += d
            ends.append(net.filled(moved).log_probabilities(words, around).astype(np.float64).mean())
        assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(slope[at], rel=0.05, abs=2e-4)


def test_odd_rows(docs_of):
    rows = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (None, None), (3, ""), (4, " \n"), (5, "one"), (6, "word " * 70_000)]
    docs = docs_of(rows, "n_words")
    net, words = lm.train(docs)
    got = {(r["doc_id"], r["n_words"], r["score"], r["mean_score"]) for r in lm.score(words, net).collect()}
    assert len(got) == len(rows) - 1
    assert {(None, 0, 0.0, None), (3, 0, 0.0, None), (4, 0, 0.0, None)} <= got
    assert {g[1] for g in got} == {0, 1, 10, 70_000} and all(g[2] <= 0 for g in got)
    net, words = lm.train(docs.limit(0))
    assert lm.score(words, net).collect() == []


def test_every_word_is_a_target_once(docs_of):
    rows = [(n, " ".join(f"w{(n * k) % 50}" for k in range(n))) for n in range(1, 40)]
    net, words = lm.train(docs_of(rows))
    seen = [lm.trained_parts(words, net, turn).filter("at = -1").first() for turn in range(lm.ROUNDS)]
    assert sum(r["value"] for r in seen if r) == sum(n for n, _ in rows)


def test_words_of_a_place_share_its_probability(docs_of):
    rows = [(n, " ".join([f"often{k}" for k in range(lm.KNOWN)] * 3)) for n in range(2)]
    rows += [(2, "rare " * 5), (3, "rare seldom"), (4, "often1 gibberish"), (4, "often1 gibberish"), (None, None), (6, "")]
    counts, words, frequency = lm.prepared(docs_of(rows))
    n = {"rare": 6, "seldom": 1, "gibberish": 2}
    hashes = {w: lm.Places()[w] for w in n}
    assert {r["hash"] % 2**64 for r in counts.filter("word IN ('rare', 'seldom', 'gibberish')").select(lm.hash_of("word").alias("hash")).collect()} == set(hashes.values())
    in_place = np.zeros(lm.SHARED)
    for w, h in hashes.items():
        in_place[h % lm.SHARED] += n[w]
    assert np.array_equal(frequency[lm.KNOWN :], in_place)
    share = {w: np.log(n[w] / (in_place[h % lm.SHARED] + 1)) for w, h in hashes.items()}
    net = lm.Network.start(frequency)
    of_places = {r["doc_id"]: r["score"] for r in lm.score(words, net).collect()}
    extra = {0: 0, 1: 0, 2: 5 * share["rare"], 3: share["rare"] + share["seldom"], 4: share["gibberish"], None: 0, 6: 0}
    got = lm.word_scores(words, net, counts, frequency).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(of_places[r["doc_id"]] + extra[r["doc_id"]])
        assert r["mean_score"] == (r["score"] / r["n_words"] if r["n_words"] else None)
    # a word that the corpus does not have costs as much as one seen once
    others = counts.filter("word <> 'gibberish'")
    unseen = {r["doc_id"]: r["score"] for r in lm.word_scores(words, net, others, frequency).collect()}
    assert unseen[4] == pytest.approx(of_places[4] - np.log(in_place[hashes["gibberish"] % lm.SHARED] + 1))


def test_a_step_leaves_words_alone_that_are_nobodys_neighbour():
    rng = np.random.default_rng(5)
    net = lm.Network.start(rng.random(lm.WORDS) * 50)
    seen = [np.zeros_like(p) for p in net.parts()]
    seen[0][:, 500:] = np.nan  # would spread to all parameters that are gone through
    before = net.near.copy()
    for n in (700, 30):
        net.step(rng.integers(0, lm.WORDS, n), rng.integers(0, 500, (n, 2 * lm.REACH)), seen)
    assert np.array_equal(net.near[:, 500:], before[:, 500:])
    assert np.isfinite(net.flat()).all() and (net.near[:, :500] != before[:, :500]).any()


def test_words_are_those_of_the_pattern_and_asked_for_once():
    texts = [None, "", " ", "\n\t a  b\x0b\x0cc a\r\n", "\x1c\x1f x\x85y\u2028z a\u3000a\xa0", "\xe9\x00 \x00", "a"]
    wanted = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    words, lengths = lm.split_words(pa.array(texts))
    assert words.to_pylist() == sum(wanted, []) and lengths.tolist() == [len(w) for w in wanted]
    asked = []
    numbers = lm.places_of(pa.array(texts), lambda word: asked.append(word) or len(asked))
    assert len(asked) == len({w for ws in wanted for w in ws})
    assert [[asked[n - 1] for n in of.tolist()] for of in numbers] == wanted


def test_texts_are_split_in_slices(monkeypatch):
    monkeypatch.setattr(lm, "SPLIT_BYTES", 10)
    batch = pa.record_batch({"text": pa.array([None, "abc", "", "d" * 25, "e f g", None, "h"] * 3)})
    parts = [p["text"].to_pylist() for p in lm.parts_of(batch)]
    assert len(parts) > 3 and sum(parts, []) == batch["text"].to_pylist()
    assert sum((p["text"].to_pylist() for p in lm.parts_of(batch.slice(0, 0))), []) == []


def test_only_counts_of_words_that_are_not_often_are_joined(docs_of, monkeypatch):
    rows = [(n, " ".join([f"often{k}" for k in range(lm.KNOWN)] * 30)) for n in range(2)]
    rows += [(n, " ".join(f"rare{k}" for k in range(n))) for n in range(2, 20)] + [(None, None), (30, "rare0 " * 9)]
    counts, words, frequency = lm.prepared(docs_of(rows))
    net = lm.Network.start(frequency)
    found = []
    for often in (1, lm.KNOWN + 5, 1 << 17):
        monkeypatch.setattr(lm, "OFTEN", often)
        of = lm.Often.of(counts, frequency)
        left = lm.shares(words, counts, of).count()
        found.append((left, {r["doc_id"]: r["score"] for r in lm.word_scores(words, net, counts, frequency).collect()}))
    assert [f[0] for f in found] == [19, 14, 0]
    assert all(f[1] == pytest.approx(found[0][1]) for f in found)
