"""Plain-Python versions of the operators, written from their contracts alone."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets_base(text):
    text, found = text or "", []
    found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    names = ("assign", "access", "hex")
    joined = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))
    return [sum(f[1] == k for f in found) for k in range(3)], sha(joined), joined


def quality_base(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def luhn(digits):
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if place % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_base(text):
    text, found = text or "", []

    def every(kind, pattern, good):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if good(m[0], digits):
                found.append((kind, m.start(), m.end()))

    every(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s, d: True)
    every(1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s, d: all(int(x) <= 255 for x in s.split(".")))
    every(2, r"[0-9]([\x20-]?[0-9])+", lambda s, d: 13 <= len(d) <= 19 and luhn(d))
    every(3, r"\+[0-9][\x20().0-9-]+[0-9]", lambda s, d: 9 <= len(d) <= 15)
    names = ("email", "ip", "card", "phone")
    text = ",".join(f"{names[k]}:{a}:{b}" for k, a, b in sorted(found))
    return [sum(f[0] == k for f in found) for k in range(4)], sha(text), text


def dedup_lines(docs, min_words):
    """{doc_id: (kept text, deleted places)}: every earlier start is compared with every later one."""
    flat, starts = [], {}
    texts = dict(docs)
    for doc in sorted(texts):
        counted = [(i, line) for i, line in enumerate(texts[doc].split("\n")) if words(line)]
        for place, (i, line) in enumerate(counted):
            starts.setdefault(line, []).append(len(flat))
            flat.append((doc, place, i, line))
        flat.append((doc, -1, -1, None))
    gone = {doc: set() for doc in texts}
    for at, (doc, place, _, line) in enumerate(flat):
        if line is None:
            continue
        for before in starts[line]:
            if before >= at:
                break
            n = count = 0
            while flat[at + n][3] is not None and flat[at + n][3] == flat[before + n][3]:
                count += len(words(flat[at + n][3]))
                n += 1
            if count >= min_words:
                gone[doc].update(range(place, place + n))
    out = {}
    for doc, text in texts.items():
        lines = text.split("\n")
        counted = [i for i, line in enumerate(lines) if words(line)]
        away = {counted[p] for p in gone[doc]}
        kept = "\n".join(line for i, line in enumerate(lines) if i not in away)
        out[doc] = ("" if counted and len(away) == len(counted) else kept, sorted(gone[doc]))
    return out


def shingle_set(text, n):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = words((text or "").translate(table))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(rows, n, percent):
    """[(number of shingles, component id)] of (doc_id, text) rows; every pair is compared."""
    sets = [shingle_set(text, n) for _, text in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * either:
                label[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def sainte_lague(votes, seats):
    """Seats one by one to the highest quotient, ties to the smaller place."""
    won = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def poured(sizes, weights, share, limit):
    """Targets: pour by weight, cap, and pour the excess again."""
    total, caps = share * sum(sizes), [limit * s for s in sizes]
    full = [False] * len(sizes)
    while True:
        free = sum(w for w, f in zip(weights, full) if not f)
        left = total - sum(c for c, f in zip(caps, full) if f)
        target = [c if f else w * left / free for c, w, f in zip(caps, weights, full)]
        over = [not f and t > c for f, t, c in zip(full, target, caps)]
        if not any(over):
            return target
        full = [f or o for f, o in zip(full, over)]
        if all(full):
            return caps
