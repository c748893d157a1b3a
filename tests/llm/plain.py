"""Plain versions of the operators, and a table of odd rows."""

import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def low_words(text):
    return words((text or "").translate(LOWER))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def vocabulary(n, prefix="w"):
    return [f"{prefix}{i}" for i in range(n)]


def odd_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, repeats, ties."""
    import random

    rng = random.Random(5)
    some = vocabulary(400)
    base = [rng.choice(some) for _ in range(120)]
    passage = [f"p{i}" for i in range(30)]
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n ", None, "b"),
        (4, "one", "en", None),
        (5, "One", "de", "b"),
        (6, " ".join(base), "en", "a"),
        (7, " ".join(base), "en", "a"),
        (7, " ".join(base), "en", "a"),
        (8, " ".join(base[:60] + ["changed"] + base[61:]), "de", "c"),
        (9, " ".join(base + [rng.choice(some) for _ in range(20)]), "de", None),
        (10, "Été 你好 \U0001f600 naïve \x0b\x0c end", "fr", "c"),
        (None, " ".join(base), "en", "a"),
        (None, "no id at all", None, None),
        (11, " ".join(rng.choice(some) for _ in range(30_000)), "en", "long"),
        (12, "x" * 200_000, "en", "long"),
        (13, " ".join(passage + [rng.choice(some) for _ in range(70)]), "en", "c"),
        (14, " ".join([rng.choice(some) for _ in range(50)] + passage), "en", "c"),
        (15, "a b c " * 300, "en", "b"),
        (16, "same line\nsame line\n" * 50, "en", "b"),
    ]
    return rows


def shingles(text, size):
    w = low_words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def components(texts, size, percent=80):
    """{doc_id: least id reachable} from (doc_id, text) pairs, ids not null."""
    sets = [(i, shingles(t, size)) for i, t in texts]
    least = {i: i for i, _ in sets}
    links = [
        (i, j) for a, (i, x) in enumerate(sets) for j, y in sets[a + 1 :]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            if least[i] != low or least[j] != low:
                least[i] = least[j] = low
                changed = True
    return least


def without_repeats(texts, width=13):
    """[(doc_id, words, kept words)] of (doc_id, text) rows."""
    least = {}
    for i, t in texts:
        w = words(t)
        if i is not None:
            for k in range(len(w) - width + 1):
                key = tuple(w[k : k + width])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, t in texts:
        w, gone = words(t), set()
        if i is not None:
            for k in range(len(w) - width + 1):
                if least[tuple(w[k : k + width])] < i:
                    gone.update(range(k, k + width))
        out.append((i, w, [x for k, x in enumerate(w) if k not in gone]))
    return out


def contamination(text, items, window=10):
    """(words, hit words, sorted items) of one text."""
    w, hit, found = alnum_words(text), set(), set()
    for name, body in items:
        b = alnum_words(body)
        m = min(window, len(b))
        if name is None or not m:
            continue
        patterns = {tuple(b[i : i + m]) for i in range(len(b) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i : i + m]) in patterns:
                hit.update(range(i, i + m))
                found.add(str(name))
    return len(w), len(hit), sorted(found)


def quality_counts(text):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            repeated.update((i, i + 1, i + 2))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)
