"""Personal data in formats that no base rule knows."""

import numpy as np

from tidewell.llm import pii


def _card(rng):
    digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
    digits += next(str(d) for d in range(10) if pii.luhn(digits + str(d)))
    return " ".join(digits[i:i + 4] for i in range(0, 16, 4))


def _texts(rng, n):
    number = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    for i in range(n):
        yield (f"mail me: user{i}@host{i % 7}.com or call +49 {number(3)} {number(4)} {number(3)} now. "
               f"Pay by card {_card(rng)} today. Built on 20{number(2)}-{number(2)}-{number(2)}, "
               f"part {number(4)}.{number(4)}.{number(2)} of {number(3)} {number(3)} {number(3)} {number(3)}.")
        yield (f"mail me: user{i} [at] host{i % 7} [dot] com or call 49 {number(3)} {number(4)} {number(3)} now. "
               f"Pay by card {_card(rng).replace(' ', '.')} today.")


def test_rewritten_spans_are_found_and_others_are_not():
    rng = np.random.default_rng(9)
    model = pii.fit_texts(list(_texts(rng, 600)))
    card = _card(rng).replace(" ", ".")
    hidden = f"mail me: ann [at] host [dot] com or call 49 301 2345 678 now. Pay by card {card} today."
    clean = "Built on 2019-04-17, part 1234.5678.90 of 123 456 789 012."
    (base, spans), (_, none) = pii.finder(model)([hidden, clean])
    assert base == [] and none == []
    assert {(k, hidden[s:e]) for k, s, e in spans} == {
        ("email", "ann [at] host [dot] com"), ("phone", "49 301 2345 678"), ("card", card)}
