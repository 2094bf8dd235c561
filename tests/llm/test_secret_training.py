"""The judge of secrets learns from all findings: none left out, of any length, in any number of slices."""

import random

import brute_new
import numpy as np
import pytest
from test_secret_scan import findings

from airseries.llm import char_cnn, common, secret_scan


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    common.reach_workers(spark)


def scanned(spark, texts):
    return secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_thresholds_come_from_all_findings(spark):
    """More than 4,000 findings of each label: the threshold is that of the whole held-out fifth."""
    found = scanned(spark, findings(1, 5000, lambda key: f' token = "{key[: 16 + int(key[0], 16)]}"'))
    judge = secret_scan.train(found)
    each = found.selectExpr("inline(candidates)").selectExpr("*", "xxhash64(window, before) AS hash")
    rows = {(r.window, r.before): r for r in each.where("label >= 0").collect()}
    assert min(sum(r.label == k for r in rows.values()) for k in (0, 1)) > 4500
    held = [r for r in rows.values() if (r.hash >> 7) % 5 == 0 and secret_scan.assigned(r.window, r.before)]
    chances = judge.chances([char_cnn.encode(r.window, r.before, r.before + r.end - r.start) for r in held])
    secret = np.sort(chances[[r.label == 1 for r in held]])[::-1]
    wanted = int(np.ceil(0.95 * len(secret)))
    assert secret[wanted - 1] > 0.5
    assert abs(int((secret >= judge.thresholds[True] - 1e-7).sum()) - wanted) <= 1


def test_long_findings_are_learned_from(spark):
    """Findings of over 512 characters only: keys of hex digits against runs of letters."""
    rng = random.Random(4)
    draw = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(600, 9000)))
    texts = ["token = " + draw("0123456789abcdef") for _ in range(60)] + [draw("klmnopqrstuvwxyz") for _ in range(60)]
    judge = secret_scan.train(scanned(spark, texts))
    windows = [char_cnn.encode(w, 0, len(w)) for w in (draw("0123456789abcdef"), draw("klmnopqrstuvwxyz"))]
    key, word = judge.chances(windows)
    assert key > 0.8 and word < 0.2


def test_slices_learn_as_one_does(spark, monkeypatch):
    """Dealt into many slices and averaged in several levels, it still finds what it was not shown."""
    monkeypatch.setattr(secret_scan, "SLICE_FINDINGS", 400)
    monkeypatch.setattr(secret_scan, "FAN", 3)
    texts = findings(1, 600, lambda key: f' token = "{key}"') + findings(3, 100, lambda key: " nothing here")
    found = scanned(spark, texts)
    sliced = []
    fit = secret_scan.fit
    monkeypatch.setattr(secret_scan, "fit", lambda rows, n: sliced.append((rows, n)) or fit(rows, n))
    judge = secret_scan.train(found)
    (rows, slices), = sliced
    assert slices > 9 and rows.count() == slices
    each = found.selectExpr("inline(candidates)").where("label >= 0").selectExpr("window", "before", "xxhash64(window, before) AS h")
    assert rows.agg({"findings": "sum"}).first()[0] == sum((r.h >> 7) % 5 != 0 for r in each.distinct().collect())
    hit = 0
    for text in findings(9, 200, lambda key: f' token = "{key}"'):
        start, _, end = brute_new.base_spans(text)[0]
        start += len('token = "')
        window = text[start - 24 : end + 24]
        hit += judge.chances([char_cnn.encode(window, 24, 24 + end - start)])[0] >= judge.thresholds[True]
    assert hit >= 170
    plain = [char_cnn.encode(w, 0, 20) for w in ("etaoinshretaoinshret", "12345678901234567890")]
    assert (judge.chances(plain) < 0.5).all()


def test_slopes_of_long_windows_are_whole(monkeypatch):
    rng = np.random.default_rng(3)
    network = char_cnn.Network.random(2)
    codes, wanted = char_cnn.padded([rng.integers(0, char_cnn.CODES, n) for n in (40, 90)]), np.array([1.0, 0.0])
    whole = network.gradients(codes, wanted)[1]
    monkeypatch.setattr(char_cnn, "SLICE", 7)
    for a, b in zip(network.gradients(codes, wanted)[1], whole, strict=True):
        assert np.allclose(a, b, atol=1e-7)


def test_a_window_is_judged_alike_in_any_company():
    network = char_cnn.Network.random(5)
    rng = np.random.default_rng(5)
    windows = [rng.integers(0, char_cnn.CODES, n).astype(np.int16) for n in (1, 3, 30, 31, 200)]
    together = char_cnn.all_logits(network, windows)
    assert np.allclose(together, [char_cnn.all_logits(network, [w])[0] for w in windows], atol=1e-6)


def test_a_learner_survives_as_numbers():
    learner = char_cnn.Learner.fresh()
    windows = [np.arange(5, 25, dtype=np.int16), np.arange(140, 190, dtype=np.int16)]
    learner.epoch(windows, np.array([0.0, 1.0]), np.random.default_rng(1))
    again = char_cnn.Learner.of(learner.vector())
    assert learner.step == again.step == 1
    assert all(np.array_equal(a, b) for a, b in zip(learner.network.parameters(), again.network.parameters(), strict=True))
