"""Plain versions of the operators, document by document in Python, for the tests."""
import collections
import math
import re

import numpy as np

#: The base patterns, as the contract has them, and identifier-like tokens.
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
TOKEN = r"(?<![A-Za-z0-9._@+-])[A-Za-z._@+-]*+[0-9][A-Za-z0-9._@+-]*+"
SPACES = " \t\n\r\x0b\x0c"
KINDS = [k for k, _ in BASE]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, match):
    d = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in match.split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def plain(word):
    return "#" if re.search("[0-9]", word) else word.lower()


def telling(word):
    return any(c.isalpha() or c in "0123456789" for c in word)


def patterns(left, right):
    """The patterns of a match that stands between two pieces of text."""
    before = re.split(f"[{SPACES}]+", " ".join(left.rstrip(SPACES).split(" ")[-3:]))
    after = re.split(f"[{SPACES}]+", " ".join(right.lstrip(SPACES).split(" ")[:2]))
    skip = 0 if left[-1:] and left[-1] in SPACES else 1
    at = lambda x, i: x[i] if -len(x) <= i < len(x) else ""
    word, further = at(before, -1 - skip), at(before, -2 - skip)
    out = []
    if telling(word):
        out.append(("L", plain(word)))
    elif word and further:
        out.append(("L", plain(further) + " " + word))
    joint = before[-1] if skip else ""
    if any(c.isalpha() for c in joint) and not re.search("[0-9]", joint):
        out.append(("P", joint.lower()))
    follows = at(after, 0 if right[:1] and right[0] in SPACES else 1)
    if follows:
        out.append(("R", plain(follows)))
    return out


def matches(pattern, text):
    """(start, end, match, patterns) of all matches, each with what lies between it and its neighbours."""
    found = list(re.finditer(pattern, text))
    edges = [0, *[m.end() for m in found]], [*[m.start() for m in found], len(text)]
    return [(m.start(), m.end(), m[0], patterns(text[edges[0][i] : m.start()], text[m.end() : edges[1][i + 1]])) for i, m in enumerate(found)]


def pii(texts, rounds=3, support=5, reliable=0.6, lift=5, digits=5):
    """Per text: spans (kind, start, end) by kind as listed, then start; discovered ones last."""
    base, tokens, links, seeds, counts, n_words = [], [], collections.Counter(), {}, collections.Counter(), 0
    kinds = collections.Counter()
    for text in texts:
        text = text or ""
        own, missed = [], []
        for kind, p in BASE:
            for s, e, m, at in matches(p, text):
                if valid(kind, m):
                    own.append((kind, s, e))
                    kinds[kind] += 1
                    seeds.setdefault(m, set()).add(kind)
                    for x in at:
                        links[x, m, False] += 1
                elif kind != "card" or 13 <= len(re.sub("[^0-9]", "", m)) <= 19:
                    missed.append((s, e))
        over = lambda s, e, spans: any(a < e and s < b for a, b in spans)
        free = []
        for s, e, m, at in matches(TOKEN, text):
            if len(re.sub("[^0-9]", "", m)) >= digits and not over(s, e, [x[1:] for x in own]):
                bad = over(s, e, missed)
                free.append((s, e, m, at, bad))
                for x in at:
                    links[x, m, bad] += 1
        base.append(own)
        tokens.append(free)
        words = re.split(f"[{SPACES}]+", text)
        n_words += text.count(" ") + 1
        for i, w in enumerate(words):
            if w:
                counts["LR", plain(w)] += 1
            if w and not telling(w):
                counts["LR", plain(words[i - 1] if i else "") + " " + w] += 1
    total = collections.Counter()
    for (x, _, _), n in links.items():
        if x[0] == "P":
            total[x] += n
        else:
            total[x] = counts["LR", x[1]]
    belief = {(m, k): 1.0 for m, ks in seeds.items() for k in ks}
    good = {}
    for _ in range(rounds):
        mass, values = collections.Counter(), collections.defaultdict(set)
        for (x, m, bad), n in links.items():
            for k in KINDS:
                if not bad and (m, k) in belief:
                    mass[x, k] += belief[m, k] * n
                    values[x, k].add(m)
        good = {}
        for (x, k), b in mass.items():
            score = b / (total[x] + 1)
            if len(values[x, k]) >= support and score >= reliable and score >= lift * kinds[k] / max(1, n_words):
                good[x, k] = score
        doubt = collections.Counter()
        for (x, m, bad), _ in links.items():
            for k in KINDS:
                if not bad and m not in seeds and (x, k) in good:
                    doubt[m, k] += math.log(1.000001 - min(1.0, good[x, k]))
        belief = {(m, k): 1.0 for m, ks in seeds.items() for k in ks} | {mk: 1 - math.exp(d) for mk, d in doubt.items() if 1 - math.exp(d) >= reliable}
    out = []
    for own, free in zip(base, tokens, strict=True):
        added = []
        for s, e, _, at, bad in free:
            known = [(-good[x, k], i, k) for x in at for i, k in enumerate(KINDS) if not bad and (x, k) in good]
            if known:
                _, i, k = min(known)
                added.append((i, s, e, f"context_{k}"))
        out.append(own + [(k, s, e) for _, s, e, k in sorted(added)])
    return out


def masked(text, spans):
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def rates(n, p, goal, most, rounds, tolerance=0.01, stalled=6):
    """Projected gradient with momentum over plain arrays."""
    full = (p * n[:, None]).sum(0)
    eta = 1 / np.linalg.eigvalsh((p * n[:, None]).T @ p / np.sqrt(np.outer(full, full)))[-1]
    totals = lambda r: (p * (n * r)[:, None]).sum(0)
    off = lambda r: ((totals(r) - goal) ** 2 / full).sum()
    worst = lambda r: np.abs((totals(r) - goal) / np.maximum(goal, 1e-3 * full.sum())).max()
    r = before = np.ones(len(n))
    pace, best, falls, k = 1.0, (worst(r), r), [off(r)], 0
    while best[0] > tolerance and k < rounds and (len(falls) <= stalled or falls[-1] < 0.99 * falls[-1 - stalled]):
        nxt = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        y = r + (pace - 1) / nxt * (r - before)
        before, r, pace = r, np.clip(y - eta * p @ ((totals(y) - goal) / full), 0, most), nxt
        if off(r) > off(before):
            pace = 1.0
        falls.append(min(falls[-1], off(r)))
        best = min(best, (worst(r), r), key=lambda x: x[0])
        k += 1
    return best[1]
