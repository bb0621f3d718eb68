"""Labelled personal data in forms that the fixed patterns miss, planted in real text.

For training and measuring the network of `pii.py`: addresses with spelled-out or
bracketed signs, numbers with unusual separators, letters in place of digits; and
lookalikes that are no personal data. Everything is drawn from a seeded generator.
"""

from __future__ import annotations

import numpy as np

SYLLABLES = "ba den fo gri hol ka lu mar nit or pel ras sun tov ul wen xi yor zek am".split()
ENDINGS = "com org net de fr io info co".split()
SHARES = (0.3, 0.12, 0.15, 0.13, 0.3)  # of the kinds of `FORMS`, and of lookalikes


def _word(rng, low=1, high=4) -> str:
    return "".join(rng.choice(SYLLABLES, rng.integers(low, high)))


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _email(rng) -> str:
    local = rng.choice(["", _word(rng) + ".", _word(rng) + "_"]) + _word(rng) + rng.choice(["", _digits(rng, 2)])
    at, dot = (" at ", " dot ")
    style = rng.integers(5)
    if style == 1:
        at, dot = rng.choice([" (at) ", "(at)", " [at] ", "[at]"]), rng.choice([" (dot) ", "(dot)", "[dot]", "."])
    elif style == 2:
        at, dot = " @ ", " . "
    elif style == 3:
        at, dot = "@", rng.choice([" dot ", "(dot)", "[.]", "[dot]"])
    elif style == 4:
        at, dot = " AT ", " DOT "
    return local + at + _word(rng, 1, 3) + dot + rng.choice(ENDINGS)


def _ip(rng) -> str:
    return rng.choice([" . ", "[.]", "(.)", " dot ", "[dot]"]).join(map(str, rng.integers(0, 256, 4)))


def _card(rng) -> str:
    body = str(rng.choice([3, 4, 5, 6])) + _digits(rng, 14)
    twice = (2 * int(d) - 9 * (d > "4") for d in body[::2])
    body += str(-(sum(twice) + sum(map(int, body[1::2]))) % 10)
    return rng.choice([".", "/", "_", "  ", " - ", ":"]).join(body[i : i + 4] for i in range(0, 16, 4))


def _phone(rng) -> str:
    parts = [str(rng.integers(20, 99)), _digits(rng, 3), _digits(rng, 3), _digits(rng, rng.integers(2, 5))]
    style = rng.integers(3)
    if style == 0:
        return "+" + rng.choice(["/", "_", " / "]).join(parts)
    if style == 1:
        return f"(0{parts[1]}) {parts[0]}{parts[2]}{rng.choice(['-', ' ', '/'])}{parts[3]}"
    # letters for digits
    return "+" + " ".join([parts[0], "O" + parts[1][1:], "l" + parts[2][1:], parts[3]])


def _lookalike(rng) -> str:
    a, b, c = (str(x) for x in rng.integers(1, 60, 3))
    return rng.choice(
        [
            f"20{rng.integers(10, 30)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}",
            f"at {a}:{rng.integers(10, 60)}",
            f"{a}.{b}",
            f"v{a}.{b}.{c}",
            f"{a}/{b}/20{rng.integers(10, 30)}",
            f"{_digits(rng, rng.integers(1, 9))}",
            f"({a}) {b}",
            f"{a}, {b}, {c}",
            f"{a}-{b}",
            f"{a} dot {b}",
            f"{_word(rng)} at {_word(rng)}",
            f"the dot {_word(rng)}",
            f"@{_word(rng)}",
            f"{_word(rng)} @ {a}",
            f"id_{_digits(rng, 6)}_{_digits(rng, 4)}",
            _digits(rng, rng.integers(20, 26)),
        ]
    )


FORMS = (_email, _ip, _card, _phone)


def planted(texts: list[str], count: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """`count` pieces of the texts with one form in each, and its `start, kind, end`.

    Three in ten pieces have a lookalike, and no span; as many an address, the hardest kind.
    """
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        text = texts[rng.integers(len(texts))]
        at = int(rng.integers(len(text) + 1))
        words = text[max(0, at - int(rng.integers(20, 140))) : at + int(rng.integers(20, 140))].split(" ")
        cut = int(rng.integers(len(words) + 1))
        before, after = " ".join([*words[:cut], ""]), " ".join(["", *words[cut:]])
        kind = int(rng.choice(5, p=SHARES))
        form = str(FORMS[kind](rng)) if kind < 4 else _lookalike(rng)
        spans = [(len(before), kind, len(before) + len(form))] if kind < 4 else []
        out.append((before + form + rng.choice(["", "", ",", ".", ";"]) + after, spans))
    return out
