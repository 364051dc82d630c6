"""Texts with the odd cases that every operator has to take."""

import random

SPACES = " \t\n\x0b\x0c\r"

ODD = [
    None, "", " ", "\n", " \t\n\x0b\x0c\r ", "one", "One  two", "One\x0b\ttwo", "one two ", " one two", "a\x1cb\x85c\xa0d e",
    "Ä́ é ́x", "naïve ΣΑΣ ǅ İ ß", "𝒳 😀😀 👩‍👩‍👧", "don't I'LL we've 's 'S it''s", "x" * 3000, "ab" * 700 + " tail",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|> c", "1234567890 12.5 $3,000", "tab\tand　wide", "line\n\n\nline\n", "\x00\x01 zero",
    "</s>[INST] ok [/INST]", "word " * 5000, "​‍", "混合 text 日本語 テキスト", "%25 %3C % < [", "ẓ̀ q",
]


def texts(count: int = 40, seed: int = 3) -> list[str | None]:
    rng = random.Random(seed)
    alphabet = "etaoin shrdlu ETA\n\t.,;:'\"<>|[]{}%$#0123456789éüßñ—😀́日"
    found = list(ODD)
    for _ in range(count):
        found.append("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))))
    return found + found[:10] + [" ".join(rng.choice(["the", "of", "retion", "er.", "x1"]) for _ in range(30_000))]
