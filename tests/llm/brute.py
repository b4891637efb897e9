"""Plain versions of the operators, and documents that have every odd case."""

import hashlib
import random
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, key string, node string, id string, words string, a int, label string, _text string, row int, _row int, own int, removed_lines int, _gone int, _gone_from int, component_id int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows(texts):
    """Rows of documents with extra columns whose names the operators use themselves."""
    return [(i, t, "en", "s", len(t or ""), 7, "k", "n", "i", "w", 1, "l", "t", 1, 2, 3, 4, 5, 6, 7) for i, t in texts]


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    names = [f"w{i}x" for i in range(vocabulary)]
    return "\n".join(" ".join(r.choice(names) for _ in range(min(12, words - k))) for k in range(0, words, 12))


def edited(text, seed, changes):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = f"edit{r.randrange(10**6)}"
    return " ".join(words)


def odd_texts():
    base, other = prose(1, 240), prose(2, 300)
    out = [(None, base), (900, None), (901, ""), (902, " \n\t "), (903, "é ß 日本"), (904, "one"), (905, "ONE"), (906, "a b c d"), (907, "a b c d"), (908, "x " * 60), (909, "\n\n" + "tie line\n" * 30)]
    out += [(i, base) for i in (10, 11, 12)] + [(20 + i, edited(base, i, 2)) for i in range(8)] + [(13, base), (13, base)]
    out += [(40, other), (41, other + " " + base[:400]), (42, "Start " + other), (43, base[300:900] + "\n" + other[200:700])]
    out += [(50, prose(5, 30_000, 5_000)), (51, prose(5, 30_000, 5_000) + " tail"), (52, "a" * 300_000), (53, ("p q r s t " * 40).strip())]
    return out


def repeated_phrases(docs):
    seen, out = set(), {}
    for i, text in sorted({(i, t) for i, t in docs if i is not None and t is not None}):
        words = WORDS(text)
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repetition(text):
    words = WORDS(text or "")
    count = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def contaminated(docs, items):
    windows = defaultdict(set)
    for i, text in items:
        words = ITEM_WORDS(lower(text))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add("null" if i is None else str(i))
    sizes, out = {len(w) for w in windows}, []
    for _, text in docs:
        words, hit, found = ITEM_WORDS(lower(text)), set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(words[k : k + n])]
        out.append((len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


class Groups:
    def __init__(self, names):
        self.up = {n: n for n in names}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def shingles(text):
    words = WORDS(lower(text))
    return frozenset(zip(*(words[i:] for i in range(4)), strict=False)) if len(words) >= 4 else frozenset([tuple(words)] if words else [])


def jaccard(docs):
    """(set size, smallest linked id) of each (id, text)."""
    rows = sorted({d for d in docs if d[0] is not None}, key=repr)
    sets = [shingles(t) for _, t in rows]
    groups = Groups(range(len(rows)))
    for k in range(len(rows)):
        for j in range(k):
            both = len(sets[k] & sets[j])
            if both and 100 * both >= 85 * len(sets[k] | sets[j]):
                groups.link(k, j)
    lowest = {}
    for k, (i, _) in enumerate(rows):
        lowest[groups.root(k)] = min(lowest.get(groups.root(k), i), i)
    return {d: (len(sets[k]), lowest[groups.root(k)]) for k, d in enumerate(rows)}


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


def fuzzy_lines(docs, order, percent=80):
    """Lines that go, by (id, text); `order` of documents with the same id."""
    places = defaultdict(list)
    for i, text in {(i, t) for i, t in docs if i is not None and t is not None}:
        for k, line in enumerate(text.split("\n")):
            words = tuple(ITEM_WORDS(lower(line)))
            if words:
                places[words].append((i, order(i, text), k, text))
    lines = sorted(places)
    groups = Groups(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if groups.root(i) != groups.root(j):
                most = max(len(lines[i]), len(lines[j]))
                if 100 * abs(len(lines[i]) - len(lines[j])) <= (100 - percent) * most and 100 * (most - distance(lines[i], lines[j])) >= percent * most:
                    groups.link(i, j)
    members, gone = defaultdict(list), defaultdict(list)
    for k, words in enumerate(lines):
        members[groups.root(k)] += places[words]
    for group in members.values():
        for place in group:
            if place != min(group):
                gone[place[0], place[3]].append(place[2])
    return {d: sorted(v) for d, v in gone.items()}
