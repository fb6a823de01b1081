"""Names shared by the tests of this folder."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "a b c",
    "same text twice, same text twice",
    "same text twice, same text twice",
    "naïve Ünïcode 日本語 😀 words\nand lines\n\nmore",
    "long " * 30_000,
    "x" * 50_000,
]


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
