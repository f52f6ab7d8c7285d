"""Viterbi against brute force, both ways of solving against each other, long texts, the round trip."""

import random
import time

import pytest

from quarrymill.llm import pieces

BYTES = [f"<0x{i:02X}>" for i in range(256)]


def small_model(rng):
    names = list({"▁"} | {"▁" + "".join(rng.choices("abc", k=rng.randrange(4))) for _ in range(6)} | {"".join(rng.choices("abcé", k=rng.randrange(1, 5))) for _ in range(14)})
    scores = [-rng.choice([1.0, 1.5, 2.0, 2.5, 4.0]) * len(n) ** rng.choice([0.5, 1]) for n in names]
    return pieces.Model(BYTES + names, [0.0] * 256 + scores, ["byte"] * 256 + ["piece"] * len(names))


def brute(model, text):
    """Scores of the best segmentation of a short text, by all segmentations."""
    score = {n: s for n, s, k in zip(model.pieces, model.scores, model.kinds, strict=True) if k == "piece"}
    unknown = min(score.values()) - 10
    text = "▁" + text.replace(" ", "▁")
    best = [0.0] + [float("-inf")] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            s = score.get(text[i:j], unknown if j == i + 1 else None)
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


def own_score(model, ids):
    """The sum of the pieces' scores; a run of byte pieces is its characters."""
    score, unknown = 0.0, min(s for s, k in zip(model.scores, model.kinds, strict=True) if k == "piece") - 10
    run = b""
    for i in [*ids, None]:
        if i is not None and model.kinds[i] == "byte":
            run += bytes([i])
            continue
        score += unknown * len(run.decode())
        run = b""
        score += 0 if i is None else model.scores[i]
    return score


@pytest.mark.parametrize("together", [1, 10**9])
def test_best_segmentation(monkeypatch, together):
    monkeypatch.setattr(pieces, "TOGETHER", together)
    rng = random.Random(7)
    for _ in range(60):
        model = small_model(rng)
        codec = pieces.Codec(model)
        for _ in range(12):
            text = "".join(rng.choices("abcé x", k=rng.randrange(1, 14)))
            ids = codec.encode(text)
            assert codec.decode(ids) == text
            assert own_score(model, ids) == pytest.approx(brute(model, text))


def test_both_ways_agree(monkeypatch):
    codec = pieces.Codec(pieces.Model.read())
    rng = random.Random(8)
    parts = ["▁" + "".join(rng.choices("abcdefgh the of Ünïcödé中文\n", k=rng.randrange(1, 300))).replace(" ", "_") for _ in range(60)]
    coded = [p.encode() for p in parts]
    assert codec.viterbi(coded) == [codec.walk(c) for c in coded]


def test_letting_go_changes_nothing(monkeypatch):
    """A long part cut at places that no piece crosses has the ids of its pieces."""
    codec = pieces.Codec(pieces.Model.read())
    rng = random.Random(9)
    part = ("▁" + "".join(rng.choice(["word", "中", "\t", "é", "zq"]) for _ in range(1500))).encode()
    whole = codec.walk(part)
    monkeypatch.setattr(pieces, "LONG", 40)
    assert codec.walk(part) == whole


def test_long_text_without_spaces():
    codec = pieces.Codec(pieces.Model.read())
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz中文字é", k=1_000_000))
    began = time.time()
    ids = codec.encode(text)
    assert codec.decode(ids) == text
    assert time.time() - began < 60  # a few seconds where the machine is free
    assert not codec.memory


def test_slices(monkeypatch):
    codec = pieces.Codec(pieces.Model.read())
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab  \n", k=rng.randrange(1, 400))) for _ in range(80)] + [" " * 90, "a" * 90, "a" + " " * 90]
    whole = [codec.encode(t) for t in texts]
    monkeypatch.setattr(pieces, "SLICE", 17)
    assert [codec.encode(t) for t in texts] == whole
