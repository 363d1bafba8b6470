"""Generated training examples for the field that finds personal data.

Sentences of invented words hold entities in many forms, announced or not, and numbers that look alike but are none:
dates, versions, prices, order numbers, card numbers with a wrong check digit. Everything follows from the seed.
"""

from __future__ import annotations

import random

_PARTS = "an be ca do el fi go hu in jo ka lu ma no or pe qu re si tu un ve wi za tion ment the che".split()
_CUES = {
    "phone": ("call", "phone:", "tel.", "fax", "mobile"),
    "card": ("card", "visa", "credit card:"),
    "ip": ("host", "server", "ip:", "from"),
    "email": ("mail", "email:", "write to", "contact"),
    "secret": ("token =", "api key:", "secret =", "password:", "key ="),
}


def _word(r: random.Random) -> str:
    return "".join(r.choice(_PARTS) for _ in range(r.randint(1, 3)))


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _number_with_check(r: random.Random, n: int, right: bool = True) -> str:
    head = str(r.randint(1, 9)) + _digits(r, n - 2)
    total = sum((d := int(c) * (2 - k % 2)) - 9 * (d > 9) for k, c in enumerate(reversed(head)))
    check = -total % 10
    return head + str(check if right else (check + r.randint(1, 9)) % 10)


def _grouped(number: str, mark: str) -> str:
    return mark.join(number[k : k + 4] for k in range(0, len(number), 4))


def _email(r: random.Random) -> str:
    name = r.choice([_word(r), f"{_word(r)}.{_word(r)}", f"{_word(r)}.{_digits(r, 2)}", f"{_word(r)}_{_word(r)}"])
    host = f"{_word(r)}{r.choice(['', _digits(r, 1)])}"
    return f"{name}@{host}.{r.choice(['com', 'org', 'net', 'example.com', 'co.uk'])}"


def _phone(r: random.Random) -> str:
    area, first, last = str(r.randint(200, 989)), _digits(r, 3), _digits(r, 4)
    forms = (f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}", f"+1 ({area}) {first}-{last}")
    more = (f"+{r.randint(20, 99)} {r.randint(10, 99)} {_digits(r, 4)} {last}", f"+{r.randint(1, 99)}{area}{first}{last}")
    return r.choice(forms + more)


def _secret(r: random.Random) -> str:
    if r.random() < 0.6:
        return "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 40, 64])))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return _digits(r, 2) + "".join(r.choice(letters) for _ in range(r.randint(22, 40)))


def _card(r: random.Random) -> str:
    number = _number_with_check(r, 16)
    return r.choice([number, number, _grouped(number, " "), _grouped(number, "-")])


def _ip(r: random.Random) -> str:
    return ".".join(str(r.randint(0, 255)) for _ in range(4))


_MAKERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "secret": _secret}


def _lookalike(r: random.Random) -> str:
    """A number that is no personal data."""
    wrong = _number_with_check(r, 16, right=False)
    return r.choice(
        [
            f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}",
            f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1900, 2030)}",
            f"v{r.randint(0, 9)}.{r.randint(0, 30)}.{r.randint(0, 30)}",
            f"{r.randint(1, 9)}.{r.randint(0, 99)}.{r.randint(300, 999)}.{r.randint(300, 999)}",
            f"{r.randint(1, 999)},{_digits(r, 3)},{_digits(r, 3)}.{_digits(r, 2)}",
            _digits(r, r.randint(7, 13)),
            wrong,
            _grouped(wrong, " "),
            _digits(r, r.randint(20, 30)),
            f"{_digits(r, 2)}:{_digits(r, 2)}:{_digits(r, 2)}.{_digits(r, 3)}",
            f"{_word(r)}-{_digits(r, 4)}-{_word(r)}-{_digits(r, 4)}",
            " ".join(str(r.randint(1, 9999)) for _ in range(r.randint(3, 7))),
            " | ".join(str(r.randint(100, 9999)) for _ in range(r.randint(3, 5))),
            f"{_word(r)}@{_word(r)}",
            f"http://{_word(r)}.com/{_digits(r, 8)}",
        ]
    )


def examples(size: int, seed: int) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """``size`` texts with their entities: begin, end (excluded) and kind."""
    r = random.Random(seed)
    out = []
    for _ in range(size):
        text, entities = " ".join(_word(r) for _ in range(r.randint(0, 3))), []
        for _ in range(r.choice([1, 1, 1, 2])):
            text += " " if text else ""
            if r.random() < 0.5:
                kind = r.choice(list(_MAKERS))
                value = _MAKERS[kind](r)
                # A secret is only known by what announces it, or by being long hexadecimal in quotes.
                if kind == "secret" or r.random() < 0.4:
                    text += r.choice(_CUES[kind]) + " "
                quote = '"' if kind == "secret" and r.random() < 0.6 else ""
                entities.append((len(text) + len(quote), len(text) + len(quote) + len(value), kind))
                text += quote + value + quote
            else:
                text += r.choice(["", "", "no. ", "on ", "version "]) + _lookalike(r)
            text += r.choice(["", ".", ",", " " + _word(r), ". " + _word(r)])
        out.append((text, entities))
    return out
