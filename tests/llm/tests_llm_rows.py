"""Awkward documents that several tests read."""

import random

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def some_text(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(words))


def awkward_rows() -> list[tuple]:
    """Nulls, empty and blank texts, a very long one, copies, one id with several texts, repeats, many letters."""
    copy, long = some_text(0, 120), some_text(1, 40_000)
    return [
        (1, copy, "en", "a", 1), (2, copy, "en", "a", 1), (3, copy + " end", "en", "a", 1), (4, None, "en", "a", None), (5, "", None, None, 0), (6, " \n\t ", "en", "b", 4),
        (7, long, "en", "b", len(long)), (None, some_text(2, 60), None, "b", 1), (None, None, None, None, None), (8, some_text(3, 80), "en", "c", 1), (8, some_text(3, 80), "en", "c", 1),
        (8, some_text(4, 80), "en", "c", 1), (9, "x", "en", "c", 1), (10, "x", "fr", "c", 1), (11, "same " * 3000, "fr", "d", 1), (13, "éß日本 😀 \U0001f600 a‍b ▁ <|endoftext|> <0x41>", "fr", None, 1),
    ]
