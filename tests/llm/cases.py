"""Small tables with awkward rows, and plain Python versions of what they should give."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, kept string, digest string, _file string, size long, bucket string, region string, node long, n long, features string"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text: str | None, n: int) -> set[tuple[str, ...]]:
    w = words(lowered(text))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def corpus(seed: int = 1, n: int = 120) -> list[tuple]:
    """Texts with copies, near copies, shared passages, odd white space, nulls and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(k: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(k)]

    passage, base = prose(30), prose(90)
    texts: list[str | None] = [None, "", "  \n\t ", "one", "One", "one two", "a b c", "a  b\nc", "X" * 5000, "é\x0bü\x0cß\x1fñ"]
    for i in range(n):
        kind = i % 6
        if kind == 0:
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
        elif kind == 1:
            texts.append(" ".join(prose(40) + passage + prose(10)))
        elif kind == 2:
            texts.append("\n".join(" ".join(prose(8)) for _ in range(rng.randint(1, 9))))
        elif kind == 3:
            texts.append((" \n" if i % 2 else "  ").join(base) + "\n" * (i % 3))
        elif kind == 4:
            line = " ".join(prose(6))
            texts.append("\n".join([line] * rng.randint(2, 5) + [" ".join(prose(7))]).upper())
        else:
            texts.append(" ".join(w + rng.choice(["###", "$$$", "", "!"]) for w in prose(rng.randint(1, 60))))
    texts.append(" ".join(prose(30_000)))
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[5], rows[5], (None, base[0]), (None, None), (None, " ".join(base))]
    return [(d, t, "en", rng.choice(["a", "b", "hot", "hot", "hot", None, "", "é"]), len(t or ""), 7, "x", "d", "f", 1, "b", "r", 9, 2, "z") for d, t in rows]


def components(rows: list[tuple], n: int, num: int) -> dict[int, int | None]:
    """Least id reachable by links, for each row by its place; brute force over all pairs."""
    sets = [shingles(r[1], n) for r in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= num * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, r in enumerate(rows):
        k = root(i)
        least[k] = r[0] if least.get(k) is None else least[k] if r[0] is None else min(least[k], r[0])
    return {i: least[root(i)] for i in range(len(rows))}


def repeated_words(text: str | None, k: int = 5) -> int:
    w = words(text)
    windows = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    count: dict[tuple, int] = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    covered = {i + d for i, x in enumerate(windows) if count[x] > 1 for d in range(k)}
    return len(covered)


def duplicate_lines(text: str | None) -> int:
    seen, n = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            n += line in seen
            seen.add(line)
    return n
