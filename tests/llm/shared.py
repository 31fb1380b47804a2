"""Small tables and plain versions that the operators are held against."""

from __future__ import annotations

import random
import re

ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "a",
    "A b",
    "é É ß 한글 😀",
    "one two three four five six seven eight nine ten eleven",
    "x" * 5000,
    "word " * 3000,
    "line one\nline two\nline one\nline two\nline three",
    "tab\tand\x00nul\x1funit",
]

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first: int = 0):
    rows = [
        (None if i % 11 == 10 else first + i, t, None if i % 7 == 6 else "en", None if i % 5 == 4 else f"s{i % 3}", None)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENT)


def spaced(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def alphanumeric(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def shingles(text: str | None, size: int) -> frozenset:
    words = spaced(text)
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def joined(sets: list[frozenset], percent: int) -> list[int]:
    """The component of each set, as the index of its first member, by comparing all pairs."""
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(sets))]


def near_copies(seed: int = 5) -> list[str]:
    """A crowd of copies with up to five changes, and texts that share a passage only."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    passage = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(120):
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    return texts + [" ".join(passage + [rng.choice(words) for _ in range(rng.randrange(5, 60))]) for _ in range(40)]
